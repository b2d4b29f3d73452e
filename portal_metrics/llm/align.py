"""Operator 13: cross-tokenizer alignment by whitespace-token anchors.

Each text is tokenised in full by A (byte-level BPE, over space + text) and by B (piece BPE with byte fallback,
which adds the space itself).  Anchors are byte offsets where a token of both ends and the next token of both
is space-marked; they split a document into windows of token ids.  A window's alignment (its groups and links)
depends on its ids alone, so it is memoised by the pair of id tuples.  Inside a window, offsets where tokens of both end
cut groups; the A and B token that end together there are a link.

Links are counted over the corpus in two passes without moving documents to the keys of their links (a frequent
pair is linked in most documents): the first pass numbers the distinct pairs of a bucket (some MB of text of one
task) and writes documents with pair numbers, and one row a pair of the bucket; the second joins the corpus counts to those
rows and brings them to the documents by bucket.

Defined results: texts that are NULL, empty, or that either tokenizer does not give back byte for byte have no
tokens, no groups and an empty groups string; rows are independent, so NULL and repeated ids are reported as they are;
an empty table gives an empty table; columns not named in ``keep`` are ignored, whatever their names.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portal_metrics.llm import common as C
from portal_metrics.llm.bpe import PATTERN

#: Bytes of text worked on at a time, and of one bucket.
CHUNK, BUCKET = 1 << 20, 8 << 20
#: Window alignments remembered per worker, and the longest window remembered (tokens of both).
MEMO, MEMO_TOKENS = 200_000, 64
#: Links of alignments held per worker, remembered or not.
HELD_LINKS = 2_000_000
#: Texts of these characters are split alike by both public implementations of A; others go to the file's own library.
COMMON = re.compile(r"[\u0000-\u052f\u2000-\u206f\u20a0-\u20bf\u3040-\u30ff\u4e00-\u9fef\uac00-\ud7a3]*")


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 for itself, the rest from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


def a_tokens(model: dict) -> dict[int, bytes]:
    """id -> bytes of a byte-level vocabulary file; special tokens stand for their own text."""
    byte = _byte_of()
    special = {t["id"]: t["content"].encode() for t in model.get("added_tokens", [])}
    return {i: special[i] if i in special else bytes(byte[c] for c in k) for k, i in model["model"]["vocab"].items()} | special


def b_tokens(pieces) -> list[bytes]:
    """Bytes of each piece: U+2581 is a space, <0xHH> a byte."""
    out = []
    for i in range(pieces.get_piece_size()):
        p = pieces.id_to_piece(i)
        out.append(bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode())
    return out


class Tokenizers:
    """Both tokenizers, from the contents of their files."""

    def __init__(self, a_file: bytes, b_file: bytes):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a_file, model = a_file, json.loads(a_file)
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        tokens = a_tokens(model)
        special = {t["id"] for t in model.get("added_tokens", [])}
        self.library = Tokenizer.from_str(a_file.decode())
        self.library.encode_special_tokens = True
        # where ids follow the order of the merges, the ids are ranks and the faster library gives the same ids
        merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["model"]["merges"]]
        vocab = model["model"]["vocab"]
        ordered = all(vocab[m] == 256 + i for i, m in enumerate(merged)) and not model["model"].get("ignore_merges") and not model.get("normalizer")
        self.fast = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks={t: i for i, t in tokens.items() if i not in special},
                                      special_tokens={}) if ordered else None
        self.tokens = [tokens.get(i, b"") for i in range(max(tokens) + 1)], b_tokens(self.pieces)
        self.length = tuple(np.array([len(t) for t in x], np.int64) for x in self.tokens)
        self.spaced = tuple(np.array([t[:1] == b" " for t in x], bool) for x in self.tokens)
        self.blob = tuple(np.frombuffer(b"".join(x), np.uint8) for x in self.tokens)
        self.start = tuple(np.concatenate([[0], np.cumsum(x)[:-1]]) for x in self.length)

    def encode(self, texts: list[str | None]) -> tuple[list, list]:
        """Ids of each text by A and by B; none for an empty text."""
        a = []
        for t in texts:
            if not t:
                a.append([])
            elif self.fast is not None and COMMON.fullmatch(t):
                a.append(self.fast.encode_to_numpy(" " + t, disallowed_special=()))
            else:
                a.append(self.library.encode(" " + t, add_special_tokens=False).ids)
        return a, self.pieces.encode([t or "" for t in texts], num_threads=1)

    def gives_back(self, which: int, ids: np.ndarray, per: np.ndarray, want: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Whether the tokens of each text join to its bytes; want: all bytes in a row, ends: where each text's end."""
        n = self.length[which][ids]
        at = np.concatenate([[0], np.cumsum(n)])
        right = at[per[1:]] - at[per[:-1]] == np.diff(ends)
        if not right.all():
            # a text of another length would shift all bytes after it
            keep = np.repeat(right, np.diff(per))
            ids, n, want = ids[keep], n[keep], want[np.repeat(right, np.diff(ends))]
            at = np.concatenate([[0], np.cumsum(n)])
        got = self.blob[which][np.arange(at[-1]) + np.repeat(self.start[which][ids] - at[:-1], n)]
        wrong = np.flatnonzero(got != want)
        if len(wrong):
            sure = np.flatnonzero(right)
            right[sure[np.searchsorted(np.cumsum(np.diff(ends)[sure]), wrong, side="right")]] = False
        return right


def _flat(ids: list) -> tuple[np.ndarray, np.ndarray]:
    per = np.concatenate([[0], np.cumsum([len(x) for x in ids], dtype=np.int64)])
    return np.fromiter(chain.from_iterable(ids), np.int64, int(per[-1])), per


def _only(ids: np.ndarray, per: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of some rows; the others have none."""
    n = np.diff(per)
    return ids[np.repeat(rows, n)], np.concatenate([[0], np.cumsum(np.where(rows, n, 0))])


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, one after another."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


class Aligner:
    """Alignments of texts, with a bounded memory of window alignments."""

    def __init__(self, tokenizers: Tokenizers):
        self.t = tokenizers
        # a token's text inside its group, and at its end
        self.said = tuple(tuple(np.array([f"{i}{c}" for i in range(len(x))], object) for c in ends)
                          for x, ends in zip(tokenizers.tokens, (",|", ",;"), strict=True))
        self._clear()

    def _clear(self):
        #: Window -> its number; texts of the windows; their links one after another, and where each window's start.
        self.memo: dict[tuple[bytes, bytes], int] = {}
        self.texts: list[str] = []
        self.links, self.link_at = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def shared_ends(self, a: np.ndarray, b: np.ndarray, a_there: np.ndarray | None = None, b_there: np.ndarray | None = None):
        """Token numbers of A and of B that end at one byte; only those that are ``there``."""
        a_end, b_end = np.cumsum(self.t.length[0][a]), np.cumsum(self.t.length[1][b])
        i = np.arange(len(a)) if a_there is None else np.flatnonzero(a_there)
        j = np.arange(len(b)) if b_there is None else np.flatnonzero(b_there)
        mark = np.zeros(int(a_end[-1]) + 1, bool)
        mark[b_end[j]] = True
        i = i[mark[a_end[i]]]
        mark[b_end[j]] = False
        mark[a_end[i]] = True
        return i, j[mark[b_end[j]]]

    def windows(self, a: np.ndarray, b: np.ndarray, a_per: np.ndarray, b_per: np.ndarray):
        """Window ends in A's and in B's tokens: anchors and the ends of the documents."""
        a_cut, b_cut = np.zeros(len(a), bool), np.zeros(len(b), bool)
        a_cut[:-1] = self.t.spaced[0][a[1:]]
        b_cut[:-1] = self.t.spaced[1][b[1:]]
        # the end of a document is one of both, whatever comes after
        a_cut[a_per[1:][np.diff(a_per) > 0] - 1] = True
        b_cut[b_per[1:][np.diff(b_per) > 0] - 1] = True
        i, j = self.shared_ends(a, b, a_cut, b_cut)
        return i + 1, j + 1

    def _learn(self, a: np.ndarray, b: np.ndarray, a_from, a_n, b_from, b_n) -> None:
        """Align windows that are not in memory, side by side: groups end where tokens of both end."""
        a, b = a[_ranges(a_from, a_n)], b[_ranges(b_from, b_n)]
        i, j = self.shared_ends(a, b)
        links = a[i] << 32 | b[j]
        # a group's text is its A tokens, then its B tokens
        a_last, b_last = np.zeros(len(a), bool), np.zeros(len(b), bool)
        a_last[i] = b_last[j] = True
        a_group, b_group = np.searchsorted(i, np.arange(len(a))), np.searchsorted(j, np.arange(len(b)))
        out = np.empty(len(a) + len(b), object)
        out[np.arange(len(a)) + np.concatenate([[0], j + 1])[a_group]] = np.where(a_last, self.said[0][1][a], self.said[0][0][a])
        out[np.arange(len(b)) + (i + 1)[b_group]] = np.where(b_last, self.said[1][1][b], self.said[1][0][b])
        pieces = out.tolist()
        cuts = np.cumsum(a_n + b_n).tolist()
        self.texts += ["".join(pieces[s:e]) for s, e in zip([0, *cuts[:-1]], cuts, strict=True)]
        self.link_at = np.concatenate([self.link_at, len(self.links) + np.searchsorted(i, np.cumsum(a_n))])
        self.links = np.concatenate([self.links, links])

    def align(self, texts: list[str | None]):
        """n_a, n_b, groups texts, links of all texts in a row, and their ends in it."""
        if len(self.memo) > MEMO or len(self.links) > HELD_LINKS:
            self._clear()
        a_ids, b_ids = self.t.encode(texts)
        (a, a_per), (b, b_per) = _flat(a_ids), _flat(b_ids)
        full = np.array([bool(t) for t in texts], bool)
        want = [b" " + t.encode() for t in texts if t]
        ends = np.concatenate([[0], np.cumsum([len(t.encode()) + 1 if t else 0 for t in texts], dtype=np.int64)])
        want = np.frombuffer(b"".join(want), np.uint8)
        (b, b_per) = _only(b, b_per, full)
        full &= self.t.gives_back(0, a, a_per, want, ends) & self.t.gives_back(1, b, b_per, want, ends)
        (a, a_per), (b, b_per) = _only(a, a_per, full), _only(b, b_per, full)
        if not len(a):
            return np.diff(a_per), np.diff(b_per), [""] * len(texts), np.zeros(0, np.int64), a_per
        a_to, b_to = self.windows(a, b, a_per, b_per)
        kind = "<u2" if max(map(len, self.t.tokens)) < 1 << 16 else "<u4"
        size = int(kind[2])
        a_pack, b_pack = a.astype(kind).tobytes(), b.astype(kind).tobytes()
        a_at, b_at = [0, *(size * a_to).tolist()], [0, *(size * b_to).tolist()]
        own, new, n = [], [], len(self.texts)
        memo = self.memo
        for w, (k, l, p, q) in enumerate(zip(a_at, a_at[1:], b_at, b_at[1:])):
            key = a_pack[k:l], b_pack[p:q]
            at = memo.get(key)
            if at is None:
                at = n + len(new)
                new.append(w)
                if l - k + q - p <= size * MEMO_TOKENS:
                    memo[key] = at
            own.append(at)
        if new:
            a_from, b_from = np.concatenate([[0], a_to[:-1]]), np.concatenate([[0], b_to[:-1]])
            new = np.array(new)
            self._learn(a, b, a_from[new], (a_to - a_from)[new], b_from[new], (b_to - b_from)[new])
        cuts = np.searchsorted(a_to, a_per, side="right")  # windows before each document's end
        said, ends = self.texts, cuts.tolist()
        groups = ["".join(map(said.__getitem__, own[s:e]))[:-1] for s, e in zip(ends, ends[1:])]
        own = np.array(own)
        sizes = self.link_at[own + 1] - self.link_at[own]
        links = self.links[_ranges(self.link_at[own], sizes)]
        return np.diff(a_per), np.diff(b_per), groups, links, np.concatenate([[0], np.cumsum(sizes)])[cuts]


_ALIGNERS: dict[tuple[int, int], Aligner] = {}


def _aligner(files: Broadcast) -> Aligner:
    a, b = files.value
    key = hash(a), hash(b)
    if key not in _ALIGNERS:
        _ALIGNERS.clear()
        _ALIGNERS[key] = Aligner(Tokenizers(a, b))
    return _ALIGNERS[key]


class _Numbers:
    """The distinct pairs of a bucket, numbered as they come, with their counts."""

    def __init__(self, no: int):
        self.no, self.of, self.counts, self.bytes = no, {}, [], 0

    def number(self, links: np.ndarray) -> np.ndarray:
        pairs, inverse, n = np.unique(links, return_inverse=True, return_counts=True)
        at = np.empty(len(pairs), np.uint32)
        for k, (p, c) in enumerate(zip(pairs.tolist(), n.tolist())):
            i = self.of.setdefault(p, len(self.counts))
            if i == len(self.counts):
                self.counts.append(0)
            self.counts[i] += c
            at[k] = i
        return at[inverse]


def alignments(docs: DataFrame, a_path: str, b_path: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
               chunk: int = CHUNK, bucket: int = BUCKET) -> DataFrame:
    """First pass.  Document rows: kept columns, bucket, n_a, n_b, n_groups, groups (text ``a1,a2|b1;...``), links (pair numbers,
    little-endian unsigned 32 bits; a group's last A and B token each).  Pair rows (``pair`` is not NULL): bucket, pair (A id << 32 |
    B id), at (its number in the bucket), n (its links there).  Kept columns are named k0, k1, ...
    """
    spark = docs.sparkSession
    with open(a_path, "rb") as a, open(b_path, "rb") as b:
        files = spark.sparkContext.broadcast((a.read(), b.read()))
    rows = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(text_col).cast("string").alias("t"))
    kept = rows.schema.fields[:-1]
    schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in kept], *T.StructType.fromDDL(
        "bucket long, pair long, at int, n long, n_a long, n_b long, n_groups long, groups string, links binary").fields])
    arrow_names = [f.name for f in schema.fields]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al = _aligner(files)
        first = TaskContext.get().partitionId() << 32
        now = _Numbers(first)

        def nothing(n, kind):
            return pa.nulls(n, kind)

        def pairs(kinds):
            n = len(now.counts)
            return pa.RecordBatch.from_arrays([*(nothing(n, k) for k in kinds), pa.array(np.full(n, now.no)), pa.array(list(now.of), pa.int64()),
                                               pa.array(np.arange(n, dtype=np.int32)), pa.array(now.counts, pa.int64()), *(nothing(n, pa.int64()),) * 3,
                                               nothing(n, pa.string()), nothing(n, pa.binary())], arrow_names)

        kinds = None
        for b in batches:
            kinds = [b.column(i).type for i in range(len(kept))]
            col = b.column(len(kept))
            size = np.asarray(pc.fill_null(pc.binary_length(col), 0)).astype(np.int64)
            for i, j in C.slices(np.concatenate([[0], np.cumsum(size)]), chunk):
                n_a, n_b, groups, links, per = al.align(col.slice(i, j - i).to_pylist())
                packed = now.number(links).astype("<u4").tobytes()
                at = (4 * per).tolist()
                n, none = j - i, nothing(j - i, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(k).slice(i, n) for k in range(len(kept))), pa.array(np.full(n, now.no)), none, nothing(n, pa.int32()), none,
                     pa.array(n_a), pa.array(n_b), pa.array(np.diff(per)), pa.array(groups, pa.string()),
                     pa.array([packed[s:e] for s, e in zip(at, at[1:])], pa.binary())], arrow_names)
                now.bytes += int(size[i:j].sum())
                if now.bytes >= bucket:
                    yield pairs(kinds)
                    now = _Numbers(now.no + 1)
        if kinds is not None and now.counts:
            yield pairs(kinds)

    return rows.mapInArrow(work, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, count, best): links of each id pair in the corpus, and whether no other pair of its B id has more.  aligned: saved."""
    counts = aligned.where("pair IS NOT NULL").groupBy("pair").agg(F.sum("n").alias("count"))
    b_id = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).alias("b_id")
    most = counts.groupBy(b_id).agg(F.max("count").alias("most"))
    return counts.withColumn("b_id", b_id).join(most, "b_id").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def scored(aligned: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Document rows of ``alignments`` (saved) with n_links, n_best and count_sum; columns: those to carry along."""
    rated = C.saved(pair_counts(aligned))
    words = aligned.where("pair IS NOT NULL").join(rated, "pair").select("bucket", "at", "count", "best")
    docs = aligned.where("pair IS NULL").select("bucket", *columns, "links")
    both = words.unionByName(docs, allowMissingColumns=True).repartition("bucket").sortWithinPartitions("bucket", F.col("at").asc_nulls_last())
    both = both.select(*columns, "bucket", "at", "count", "best", "links")
    schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in docs.select(*columns).schema.fields],
                           *T.StructType.fromDDL("n_links long, n_best long, count_sum long").fields])
    names = [f.name for f in schema.fields]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, counts, best = None, np.zeros(0, np.int64), np.zeros(0, bool)
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        for b in batches:
            if not b.num_rows:
                continue
            k = len(columns)
            buckets, is_doc = np.asarray(b.column(k)), np.asarray(b.column(k + 1).is_null())
            # runs of rows of one bucket and kind
            cuts = np.flatnonzero((buckets[1:] != buckets[:-1]) | (is_doc[1:] != is_doc[:-1])) + 1
            for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), b.num_rows]):
                if buckets[i] != bucket:
                    bucket, parts, counts, best = buckets[i], [], np.zeros(0, np.int64), np.zeros(0, bool)
                if not is_doc[i]:
                    parts.append((np.asarray(b.column(k + 2).slice(i, j - i)), np.asarray(b.column(k + 3).slice(i, j - i), dtype=bool)))
                    continue
                if parts:
                    counts, best = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
                    parts = []
                links = [np.frombuffer(x or b"", "<u4") for x in b.column(k + 4).slice(i, j - i).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c).slice(i, j - i) for c in range(k)), pa.array([len(x) for x in links], pa.int64()),
                     pa.array([int(best[x].sum()) for x in links], pa.int64()), pa.array([int(counts[x].sum()) for x in links], pa.int64())], names)

    return both.mapInArrow(work, schema)


def op13_cross_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document."""
    import public_tokenizers

    found = alignments(C.documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    digest = F.when(F.col("groups") == "", "").when(F.col("groups").isNotNull(), F.sha2(F.col("groups"), 256))
    saved = C.saved(found.withColumn("groups_sha256", digest).drop("groups"))
    out = scored(saved, ("k0", "n_a", "n_b", "n_groups", "groups_sha256"))
    return out.select(F.col("k0").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
