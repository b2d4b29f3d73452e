"""Operator 1: suffix-array dedup by longest-previous-factor arrays.

A byte string of LENGTH bytes (a *window*) that starts at two places is a repeat.  To sort suffixes in
parallel, windows are dealt by content: the window's anchor is the GRAM-byte string of least hash
in it (the first of equal ones), so equal windows have equal anchors at equal distances.
Consecutive windows with one anchor are a *run*; it is a short stretch of text.

* Runs that are equal as a whole (same anchor, same stretch) are repeats window by window; they are
  counted side by side, in the task that has the anchor, and never compared further.
* Of the different stretches of an anchor one holder each is fetched, and a task builds the suffix
  order of their windows: ranks of 8-byte words, doubled to 16 ... 256 bytes and joined to LENGTH.
  Suffixes with an equal prefix of LENGTH bytes are ordered by position, so the previous smaller
  position of a suffix is its neighbour whenever its longest previous factor reaches LENGTH, and the next
  suffix of the class is the later copy.
* An anchor with more than LOCAL different stretches is dealt further, window by window, by the
  windows' own digests, and compared by aggregation.

With ``passage`` (less than LENGTH) the dealt windows have that many bytes, and each stretch goes on until its last window would have
LENGTH: equal strings of LENGTH bytes begin with equal short ones, so one dealing finds the repeats of both lengths.

``keep_first=True`` removes the later copies and keeps the first place (least doc_id, then offset);
``keep_first=False`` removes every byte of every repeat, as the query's contract has it.

Defined results: matches never cross documents; NULL is the empty text; texts shorter than LENGTH
keep all bytes; repeated rows are copies of each other (with ``keep_first`` rows equal in id and text count as
one place); rows with NULL doc_id are rows like others (their order is that of a digest of their text); an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from portal_metrics.llm import common as C

LENGTH, GRAM = 400, 64
#: Bytes that passages of over 50 words have at least, at 5 bytes a word with its space.
PASSAGE = 256
#: Most different stretches of an anchor that one task sorts (about 5 MB of text).
LOCAL = 8192
#: Bytes of text that a task hashes at a time (the arrays made of them take up to a hundred times that).
SLICE = 256 << 10
#: Bytes of the stretches of several anchors that are sorted together.
GROUPS = 64 << 10
#: Longer texts are read in parts of this many windows.
PART = 1 << 20
_AT = np.uint64((1 << 28) - 1)


def least_in_window(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values, by minima from both ends of blocks of w."""
    n = len(x) - w + 1
    top = np.uint64(np.iinfo(np.uint64).max)
    blocks = np.concatenate([x, np.full(-len(x) % w, top, np.uint64)]).reshape(-1, w)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[w - 1:w - 1 + n])


def runs_of(data: np.ndarray, offsets: np.ndarray, length: int, gram: int, reach: int = 0, most: int | None = None):
    """(row, start in the row, windows, anchor's distance, anchor, stretch digest, bytes of the stretch) of the runs of each row.

    A stretch goes ``reach`` bytes (at least ``length``) from the start of its last window, if its row does; windows start before ``most``.
    """
    n = len(data)
    if n < length:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64, np.uint64, np.int64))
    h, down = C.prefix_hash(data)
    grams = C.mix((h[gram:] - h[:-gram]) * down[:n - gram + 1])
    at = (least_in_window((grams & ~_AT) | np.arange(len(grams), dtype=np.uint64), length - gram + 1) & _AT).astype(np.int64)
    # windows that end within their row
    row_end = np.repeat(offsets[1:], np.diff(offsets))[:len(at)]
    inside = np.arange(len(at)) + length <= row_end
    if most is not None:
        inside[most:] = False
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (row_end[1:] != row_end[:-1]) | ~inside[:-1]
    starts = np.flatnonzero(new & inside)
    count = np.add.reduceat(inside, np.flatnonzero(new))[inside[np.flatnonzero(new)]] if len(starts) else starts
    ends = np.minimum(starts + count - 1 + max(length, reach), row_end[starts])
    left = at[starts] - starts
    stretch = C.mix((h[ends] - h[starts]) * down[starts] + left.astype(np.uint64) * C._GRAM[0] + count.astype(np.uint64) * C._GRAM[1]
                    + (ends - starts - count).astype(np.uint64) * C._GRAM[2])
    row = np.searchsorted(offsets, starts, side="right") - 1
    return row, starts - offsets[row], count, left, grams[at[starts]], stretch, ends - starts


def _parts(offsets: np.ndarray, length: int, reach: int = 0):
    """(first row, last row, [(byte range, bytes before it in its row)]): rows together, or the parts of a very long row."""
    reach = max(length, reach)
    for i, j in C.slices(offsets, SLICE):
        if j - i == 1 and offsets[j] - offsets[i] > PART + reach:
            yield i, j, [(s, min(int(offsets[j]), s + PART + reach - 1), s - int(offsets[i]))
                         for s in range(int(offsets[i]), int(offsets[j]) - length + 1, PART)]
        else:
            yield i, j, [(int(offsets[i]), int(offsets[j]), 0)]


def _digest(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row's bytes."""
    h, down = C.prefix_hash(data)
    s, e = offsets[:-1], offsets[1:]
    return C.mix((h[e] - h[s]) * down[s] + (e - s).astype(np.uint64)).view(np.int64)


def _fields(lists: pa.ListArray) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Fields of the structs of a list column, NULL numbers as 0, and the row of each struct."""
    flat = lists.flatten()
    size = np.asarray(pc.fill_null(pc.list_value_length(lists), 0))
    return ({f.name: pc.fill_null(flat.field(f.name), 0).to_numpy(zero_copy_only=False) for f in flat.type}, np.repeat(np.arange(len(lists)), size))


def all_runs(docs: DataFrame, length: int, gram: int, reach: int) -> DataFrame:
    """(doc_id, digest, start, n, size, anchor, stretch): the runs of every text, of n windows and size bytes; digest: of the text."""
    def work(batches):
        for b in batches:
            data, offsets = C.text_bytes(b.column(1))
            for i, j, parts in _parts(offsets, length, reach):
                text = _digest(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                for s, e, skipped in parts:
                    own = np.array([0, e - s]) if j - i == 1 else offsets[i:j + 1] - s
                    row, start, n, _, anchor, stretch, size = runs_of(data[s:e], own, length, gram, reach, PART if len(parts) > 1 else None)
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).slice(i).take(pa.array(row)), pa.array(text[row]), pa.array(start + skipped), pa.array(n.astype(np.int32)),
                         pa.array(size.astype(np.int32)), pa.array(anchor.view(np.int64)), pa.array(stretch.view(np.int64))],
                        ["doc_id", "digest", "start", "n", "size", "anchor", "stretch"])
    return docs.mapInArrow(work, "doc_id long, digest long, start long, n int, size int, anchor long, stretch long")


def suffix_ranks(data: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Ranks, in suffix order, of the ``length``-byte prefixes of the suffixes at ``at``, by prefix doubling."""
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    word = np.zeros(n, np.uint64)
    for i in range(8):
        word = word << np.uint64(8) | padded[i:i + n]
    rank = np.unique(word, return_inverse=True)[1]
    size = 8
    while size * 2 <= length:
        rank = _joined(rank, np.append(rank[size:], np.zeros(min(size, n), rank.dtype)))
        size *= 2
    return _joined(rank[at], rank[at + length - size])


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.unique(a.astype(np.int64) * (int(b.max(initial=0)) + 1) + b, return_inverse=True)[1]


def window_classes(spans: list[bytes], windows: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows (numbered over the spans) that equal another one, class by class and inside a class by place; where classes start.

    Places are in the order of the spans, so the caller sorts them by position.
    """
    data = np.frombuffer(b"".join(spans), np.uint8)
    first = np.concatenate([[0], np.cumsum([len(s) for s in spans])])[:-1]
    per = np.concatenate([[0], np.cumsum(windows)])
    owner = np.repeat(np.arange(len(spans)), windows)
    at = np.arange(per[-1]) - per[owner] + first[owner]
    h, down = C.prefix_hash(data)
    _, inverse, count = np.unique((h[at + length] - h[at]) * down[at], return_inverse=True, return_counts=True)
    maybe = np.flatnonzero(count[inverse] > 1)  # equal windows have equal digests: only these need the exact order
    if not len(maybe):
        return maybe, maybe
    used = np.unique(owner[maybe])
    kept = np.concatenate([data[first[u]:first[u] + len(spans[u])] for u in used])
    moved = np.concatenate([[0], np.cumsum([len(spans[u]) for u in used])])
    place = at[maybe] - first[owner[maybe]] + moved[np.searchsorted(used, owner[maybe])]
    rank = suffix_ranks(kept, place, length)
    order = np.lexsort((place, rank))  # the suffix array of these windows
    same = rank[order][1:] == rank[order][:-1]
    before = np.append(False, same)    # the previous smaller position has a common prefix of the full length
    shared = before | np.append(same, False)
    return maybe[order][shared], np.flatnonzero(~before[shared])


def repeated_windows(spans: list[bytes], windows: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(has an equal window at another place, has one at an earlier place) of all windows of the spans, in order."""
    at, starts = window_classes(spans, windows, length)
    any_ = np.zeros(int(windows.sum()), bool)
    any_[at] = True
    earlier = any_.copy()
    earlier[at[starts]] = False
    return any_, earlier


def _intervals(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate([[0], flags.view(np.int8), [0]]))
    s, e = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return s, e - s


def _kinds(at: np.ndarray, first: np.ndarray, owner: np.ndarray, doc: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray]:
    """(kind of every window, shares): a window of kind 0 equals no other, else shares[(kind - 1) // 2] is the least document that
    holds it and an even kind tells that there is another one."""
    docs_at = doc[owner]
    least, most = np.minimum.reduceat(docs_at, first), np.maximum.reduceat(docs_at, first)
    size = np.diff(np.append(first, len(at)))
    shares, kind = np.unique(np.where(least < most, least, most), return_inverse=True)
    kinds = np.zeros(total, np.int64)
    kinds[at] = 1 + 2 * np.repeat(kind, size) + np.repeat(least < most, size)
    return kinds, shares


def repeated_intervals(docs: DataFrame, keep_first: bool, length: int = LENGTH, gram: int = GRAM, local: int = LOCAL, passage: int | None = None) -> DataFrame:
    """(doc_id, digest, start, n, short, share): windows of ``length`` bytes that start at start ... start + n - 1 of the text are to be
    removed, those of ``passage`` bytes at start ... start + short - 1 are in other documents too; share: the least document that
    holds them, NULL where no other one does."""
    deal = passage or length
    place = F.struct("doc_id", "digest", "start")
    alike, anchored = Window.partitionBy("anchor", "stretch"), Window.partitionBy("anchor")
    runs = (all_runs(docs, deal, gram, length).repartition("anchor")
            .select("*", F.count("*").over(alike).alias("copies"), F.min(place).over(alike).alias("holder"),
                    F.min("doc_id").over(alike).alias("least"), F.max("doc_id").over(alike).alias("most"))
            .select("*", F.sum((place == F.col("holder")).cast("long")).over(anchored).alias("kinds")))
    # a run alone with its anchor holds no repeat
    runs = C.saved(runs.where("copies > 1 or kinds > 1"))
    across = F.when(F.col("least") < F.col("most"), F.col("least"))
    fits = F.greatest(F.least(F.col("n"), F.col("size") - (length - 1)), F.lit(0))  # windows of the full length
    if keep_first:
        fits = F.when(place == F.col("holder"), 0).otherwise(fits)
    whole = (runs.where("copies > 1")
             .select("doc_id", "digest", "start", fits.cast("int").alias("n"), (F.col("n") if passage else F.lit(0)).alias("short"), across.alias("share"))
             .where("n > 0 or short > 0 and share is not null"))
    wanted = (runs.where("kinds > 1").where(place == F.col("holder")).groupBy("doc_id")
              .agg(F.collect_list(F.struct("anchor", "kinds", "digest", "start", "n", "size")).alias("wanted")))

    def fetch(batches):
        names = ["anchor", "kinds", "doc_id", "digest", "start", "n", "span"]
        for b in batches:
            data, offsets = C.text_bytes(b.column("text"))
            ids = b.column("doc_id").to_numpy()
            want, row = _fields(b.column("wanted"))
            for i, j in C.slices(offsets, SLICE):
                text = _digest(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                own = np.arange(*np.searchsorted(row, [i, j]))
                own = own[want["digest"][own] == text[row[own] - i]]
                s = offsets[row[own]] + want["start"][own]
                span = [data[x:y].tobytes() for x, y in zip(s, s + want["size"][own], strict=True)]
                yield pa.RecordBatch.from_arrays([*(pa.array(x) for x in (want["anchor"][own], want["kinds"][own], ids[row[own]], want["digest"][own], want["start"][own], want["n"][own])),
                                                  pa.array(span, pa.binary())], names)

    schema = "anchor long, kinds long, doc_id long, digest long, start long, n int, span binary"
    spans = docs.join(wanted.hint("shuffle_hash"), "doc_id").mapInArrow(fetch, schema)

    def compare(batches):
        for t in C.runs(batches, ["anchor"]):
            anchor, _, doc, digest, start, n = (t.column(i).to_numpy() for i in range(6))
            # a place met twice (repeated rows) is one place
            new = np.append(True, (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1]) | (digest[1:] != digest[:-1]) | (start[1:] != start[:-1]))
            held = t.column(6).filter(pa.array(new)).to_pylist()
            anchor, doc, digest, start, n = (x[new] for x in (anchor, doc, digest, start, n))
            # whole groups together, as equal windows have equal anchors
            cut = np.append(np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1])), len(anchor))
            out = []
            for i, j in C.slices(np.append(0, np.cumsum([len(x) for x in held]))[cut], GROUPS):
                own = slice(cut[i], cut[j])
                for size in sorted({deal, length}):
                    count = np.clip([len(x) - size + 1 for x in held[own]], 0, n[own]).astype(np.int64)
                    at, first = window_classes(held[own], count, size)
                    if not len(at):
                        break
                    per = np.concatenate([[0], np.cumsum(count)])
                    owner = np.repeat(np.arange(len(count)), count)
                    kinds, shares = _kinds(at, first, owner[at], doc[own], int(per[-1]))
                    if size < length:
                        kinds[kinds % 2 == 1] = 0  # in one document alone
                    elif keep_first:
                        kinds[at[first]] = 0
                    a = np.flatnonzero(np.append(True, (kinds[1:] != kinds[:-1]) | (owner[1:] != owner[:-1])))
                    m = np.diff(np.append(a, len(kinds))).astype(np.int32)
                    some = kinds[a] > 0
                    a, m, code = a[some], m[some], kinds[a[some]] - 1
                    k, none = owner[a], np.zeros(len(a), np.int32)
                    out.append((doc[own][k], digest[own][k], start[own][k] + a - per[k], *((none, m) if size < length else (m, none)), shares[code // 2], code % 2 == 1))
            if out:
                *cols, share, other = (np.concatenate(c) for c in zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([*map(pa.array, cols), pa.array(share, mask=~other)], ["doc_id", "digest", "start", "n", "short", "share"])

    found = "doc_id long, digest long, start long, n int, short int, share long"
    near = (spans.where(F.col("kinds") <= local).repartition("anchor").sortWithinPartitions("anchor", "doc_id", "digest", "start").mapInArrow(compare, found))

    def dealt(batches):
        for b in batches:
            for row in b.to_pylist():
                data = np.frombuffer(row["span"], np.uint8)
                h, down = C.prefix_hash(data)
                for size in sorted({deal, length}):
                    m = min(row["n"], len(data) - size + 1)
                    if m > 0:
                        at = np.arange(m)
                        one = C.mix((h[at + size] - h[at]) * down[at]).view(np.int64)
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(m, row["anchor"])), pa.array(np.full(m, size)), pa.array(one), pa.array(np.full(m, row["doc_id"])),
                                                          pa.array(np.full(m, row["digest"])), pa.array(row["start"] + at)], ["anchor", "size", "window", "doc_id", "digest", "start"])

    single = spans.where(F.col("kinds") > local).mapInArrow(dealt, "anchor long, size long, window long, doc_id long, digest long, start long").distinct()
    shared = (single.groupBy("anchor", "size", "window")
              .agg(F.count("*").alias("places"), F.min(place).alias("first"), F.when(F.min("doc_id") < F.max("doc_id"), F.min("doc_id")).alias("share"))
              .where((F.col("places") > 1) & ((F.col("size") == length) | F.col("share").isNotNull())))
    far = single.join(shared, ["anchor", "size", "window"])
    if keep_first:
        far = far.where((place != F.col("first")) | (F.col("size") < length))
    is_long = (F.col("size") == length).cast("int")
    return whole.union(near).union(far.select("doc_id", "digest", "start", is_long.alias("n"), (1 - is_long).alias("short"), "share"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_first: bool = True,
                   length: int = LENGTH, gram: int = GRAM, local: int = LOCAL, passage: int | None = None) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (removed byte ranges), kept (remaining bytes), shared_with, passages_with of every row.

    shared_with: the least id among the holders of each string removed that several documents hold, each once in ascending
    order (a document without an id goes by the hash of its text); documents with a common string hang together by common
    numbers.  With ``keep_first`` the first holder of a string does not lose it and so has no number from it.
    passages_with: the same for the strings of ``passage`` bytes, which are not removed; each document that holds such a string of
    another one has a number from it.  Empty without ``passage``.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("own"), F.col(text_col).alias("text"))
    # rows without an id go by a digest of their text: places also hold the text's digest, so an equal id does no harm
    docs = docs.select(F.coalesce("own", F.xxhash64("text")).alias("doc_id"), "text", "own")
    gone = (repeated_intervals(docs, keep_first, length, gram, local, passage)
            .groupBy("doc_id").agg(F.collect_list(F.struct("digest", "start", "n", "short", "share")).alias("gone")))
    schema = "doc_id long, n_bytes long, n_removed long, spans array<struct<start:bigint,end:bigint>>, kept binary, shared_with array<bigint>, passages_with array<bigint>"

    def work(batches):
        for b in batches:
            data, offsets = C.text_bytes(b.column("text"))
            gone, row = _fields(b.column("gone"))
            per = np.searchsorted(row, np.arange(b.num_rows + 1))
            known = np.asarray(pc.is_valid(b.column("gone").flatten().field("share")))
            sizes, removed, spans, kept, shares, passages = [], [], [], [], [], []
            for r in range(b.num_rows):
                own = data[offsets[r]:offsets[r + 1]]
                edge = np.zeros(len(own) + 1, np.int64)
                shared, short = [], []
                if per[r] < per[r + 1]:
                    mine = np.arange(per[r], per[r + 1])
                    mine = mine[gone["digest"][mine] == _digest(own, np.array([0, len(own)]))[0]]
                    short = np.unique(gone["share"][mine[(gone["short"][mine] > 0) & known[mine]]]).tolist()
                    mine = mine[gone["n"][mine] > 0]
                    shared = np.unique(gone["share"][mine[known[mine]]]).tolist()
                    start, n = gone["start"][mine], gone["n"][mine]
                    np.add.at(edge, start, 1)
                    np.add.at(edge, start + n - 1 + length, -1)
                out = np.cumsum(edge)[:-1] > 0
                s, n = _intervals(out)
                sizes.append(len(own))
                removed.append(int(out.sum()))
                spans.append([{"start": int(a), "end": int(a + m)} for a, m in zip(s, n, strict=True)])
                kept.append(own[~out].tobytes())
                shares.append(shared)
                passages.append(short)
            yield pa.RecordBatch.from_arrays(
                [b.column("own"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary()),
                 pa.array(shares, pa.list_(pa.int64())), pa.array(passages, pa.list_(pa.int64()))],
                ["doc_id", "n_bytes", "n_removed", "spans", "kept", "shared_with", "passages_with"])

    # the texts have been dealt by doc_id for the spans: the same exchange serves both joins
    return docs.join(gone.hint("shuffle_hash"), "doc_id", "left").mapInArrow(work, schema)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, shared_with: every byte of every repeated 400-byte string removed; passages_with:
    which documents hold common passages, below that length too."""
    out = remove_repeats(C.documents(spark, sf_dir), keep_first=False, passage=PASSAGE)
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
                      "shared_with", "passages_with")
