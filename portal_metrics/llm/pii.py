"""Operator 5: personal data by base patterns and bootstrapped contextual extraction, in DataFrame functions only.

Base spans come from four patterns.  They seed the bootstrap: an occurrence of a
seed, or of another identifier-like token (whole token of at least 6 characters with
a digit), gives an edge between its value and the pattern "the two words before
it".  Rounds alternate over that graph: a pattern's confidence is the share of all
fillers of its slot, in the whole corpus, that are known values; a value's score is
1 - prod(1 - confidence) over its confident patterns; values above the threshold become
known.  Occurrences of discovered values are added as spans of kind ``id``; base spans
always stay.

Edges, slots and scores stay in Spark tables, aggregated before each join; a pattern is dropped early only
where no round could admit it, and its slots are counted in the first round that has enough of its values.

Slots are counted over nested samples of the texts, each about four times the one before, the first of FIRST rows, the last of all.
Slots seen so far never exceed the slots of the corpus, so a pattern that already has too many for its confidence, were all
its identifiers known, is dropped without loss.  One that stays has at most its identifiers / CONFIDENCE slots in a
sample, so what the next one joins grows with the identifiers, not with the pairs of words.  Pairs of words are looked up in
a bitmap of the patterns' hashes of fixed size before they become rows.  The patterns of a sample are broadcast up to SMALL
bytes, measured; beyond, its pairs of words are aggregated and shuffled.

Work on a text grows with its length and, where running sums are needed, with the power 1.5 of its matches.

The patterns are written so that Java's regex engine neither backtracks nor recurses:
possessive repeats where nothing that follows could use the characters given back, and
starts only where a leftmost match can start (after a character outside the class, or
where the last match ended).

Positions are code points, end exclusive.  Defined results: NULL and empty texts have no
spans and an empty digest string; repeated rows are reported each; ties in start are ordered by kind;
an identifier with fewer than two words before it in its text has no pattern; an empty table gives an empty table;
other columns are ignored by ``find_pii`` unless named in ``keep``.
"""

from __future__ import annotations

import math
import struct

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from portal_metrics.llm import common as C

KINDS = ("email", "ip", "card", "phone")
ADDED = "id"
#: The base patterns (fixed values, in possessive form).
PATTERNS_OF = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Shortest identifier-like token.
TOKEN = 6
#: Fewest distinct known values of a pattern, its least confidence, a value's least score.
SUPPORT, CONFIDENCE, SCORE = 3, 0.8, 0.8
#: A rise of a score that asks for no further round; most bytes of the patterns that are broadcast.
SETTLED, SMALL = 1e-6, 8 << 20
#: Rows of the first sample; samples grow by GROWTH.
FIRST, GROWTH = 4096, 4
#: Bits of the marks of a sample's patterns, a multiple of Spark's bitmap size.
_BITMAP = 32_768
MARKS = 16 * _BITMAP
#: Code points of the pieces that a text is cut into before spans are cut out of it.
PIECE = 1024


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(m: Column) -> Column:
    digits = F.split(F.reverse(_digits(m)), "")
    doubled = F.transform(digits, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        parts = F.transform(F.split(m, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.substring(p, 1, 3).cast("int") <= 255))
    n = F.length(_digits(m))
    if kind == "card":
        return F.when(n.between(12, 19), _luhn(m)).otherwise(False)
    return n.between(9, 15)


def _words(text: Column) -> Column:
    """The words of a text; the first and the last item are empty where it starts or ends with a blank."""
    return F.split(text, r"\s+")


def _blanks(piece: Column) -> Column:
    """Runs of blanks in a piece of text."""
    return F.size(F.split(piece, r"\s+")) - 1


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _before(values: Column, merge, zero: Column) -> Column:
    """For each item the merge of the items before it: by blocks of about sqrt(n) items, so n ** 1.5 merges."""
    def fold(items, start=zero):
        return F.aggregate(items, start, merge)

    def blocks(v, width):
        count = F.ceil(F.size(v) / width).cast("int")
        cut = F.transform(F.sequence(F.lit(0), count - 1), lambda k: F.slice(v, k * width + 1, width))
        return _let(cut, lambda parts: _let(F.transform(parts, lambda p: fold(p)), lambda sums: F.flatten(F.transform(
            parts, lambda p, k: _let(fold(F.slice(sums, F.lit(1), k)), lambda start: F.transform(p, lambda _, j: fold(F.slice(p, F.lit(1), j), start)))))))

    def whole(v):
        return _let(F.ceil(F.sqrt(F.size(v))).cast("int"), lambda width: blocks(v, width))

    return F.when(F.size(values) > 0, _let(values, whole)).otherwise(F.slice(values, F.lit(1), F.lit(0)))


def _sum_before(lengths: Column) -> Column:
    return _before(lengths, lambda a, x: a + x, F.lit(0).cast("long"))


_SPAN = "array<struct<start:bigint,end:bigint,value:string,before:struct<w1:string,w2:string>,word:int,last:int>>"


def _word(at: Column) -> Column:
    return F.lower(F.coalesce(F.get("_words", at), F.lit("")))


def _span(start: Column, value: Column, word: Column, last: Column) -> Column:
    before = F.struct(_word(word - 2).alias("w1"), _word(word - 1).alias("w2"))
    return F.struct(start.cast("long").alias("start"), (start + F.length(value)).cast("long").alias("end"), value.alias("value"), before.alias("before"),
                    word.cast("int").alias("word"), last.cast("int").alias("last"))


def _located(matches: Column, pieces: Column) -> Column:
    """start, end, value, words before, and numbers of the first and last word of each match, from the text between the matches.

    Matches neither start nor end with a blank, so the runs of blanks before a match number the word it starts in
    (an item of ``_words``); the words before are the whole words before that one.
    """
    zipped = F.arrays_zip(matches.alias("m"), F.slice(pieces, F.lit(1), F.size(matches)).alias("p"))
    starts = _sum_before(F.transform(zipped, lambda x: (F.length(x["p"]) + F.length(x["m"])).cast("long")))
    words = _sum_before(F.transform(zipped, lambda x: (_blanks(x["p"]) + _blanks(x["m"])).cast("long")))

    def at(x):
        word = x["w"] + _blanks(x["p"])
        return _span(x["s"] + F.length(x["p"]), x["m"], word, word + _blanks(x["m"]))

    found = F.transform(F.arrays_zip(F.transform(zipped, lambda x: x["m"]).alias("m"), F.transform(zipped, lambda x: x["p"]).alias("p"),
                                     starts.alias("s"), words.alias("w")), at)
    return F.when(F.size(matches) > 0, found).otherwise(F.array()).cast(_SPAN)


def _tokens(base: Column) -> Column:
    """Identifier-like words that no base span touches; ``_words`` and ``_gaps`` (the blanks between them) are columns."""
    like = F.array_compact(F.transform("_words", lambda w, i: F.when((F.length(w) >= TOKEN) & w.rlike("[0-9]"), i)))
    touched = F.flatten(F.transform(base, lambda s: F.sequence(s["word"], s["last"])))

    def all_(kept):
        # what lies between the start of a token and that of the one before; the sums of all gaps are one walk over the words
        def step(i, k):
            first = F.when(k == 0, F.lit(0)).otherwise(F.get(kept, k - 1))
            lengths = F.transform(F.slice("_words", first + 1, i - first), lambda w: F.length(w).cast("long"))
            gaps = F.transform(F.slice("_gaps", first + 1, i - first), lambda g: F.length(g).cast("long"))
            zero = F.lit(0).cast("long")
            return F.aggregate(lengths, zero, lambda a, x: a + x) + F.aggregate(gaps, zero, lambda a, x: a + x)

        steps = F.transform(kept, step)
        return _let(steps, lambda st: F.transform(F.arrays_zip(kept.alias("i"), st.alias("d"), _sum_before(st).alias("s")), lambda x: _span(
            x["d"] + x["s"], F.get("_words", x["i"]), x["i"], x["i"])))

    return F.when(F.size(like) > 0, _let(F.array_except(like, touched), all_)).otherwise(F.array()).cast(_SPAN)


def _tagged(kind_no: int, kind: str) -> Column:
    """The valid spans of a kind, with its name and number."""
    return F.transform(F.filter(f"_s_{kind}", lambda s: _valid(kind, s["value"])), lambda s: F.struct(
        s["start"].alias("start"), F.lit(kind_no).alias("kind_no"), s["end"].alias("end"), F.lit(kind).alias("kind"),
        s["value"].alias("value"), s["before"].alias("before"), s["word"].alias("word"), s["last"].alias("last")))


def _count(kind: str) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def base_spans(docs: DataFrame, id_col: str, text_col: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """(row, id, kept columns, base, tokens): base spans of each row, and its identifier-like tokens beside them."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    # inside, kept columns go by number: theirs may be named like ours
    kept = [f"_k{i}" for i in range(len(keep))]
    df = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_id"), text.alias("_text"),
                     *[F.col(c).alias(k) for c, k in zip(keep, kept, strict=True)])
    carried = ["_row", "_id", *kept]
    # kinds that need a rare character are only searched in texts that hold it
    needs = {"email": "@", "phone": "+"}
    none = F.array().cast("array<string>")
    found, split = {}, {}
    for kind, p in PATTERNS_OF.items():
        all_ = F.regexp_extract_all("_text", F.lit(p), F.lit(0))
        found[kind] = F.when(F.contains("_text", F.lit(needs[kind])), all_).otherwise(none) if kind in needs else all_
    df = df.select(*carried, "_text", *[v.alias(f"_m_{k}") for k, v in found.items()])
    for kind, p in PATTERNS_OF.items():
        split[kind] = F.when(F.size(f"_m_{kind}") > 0, F.split("_text", p, -1)).otherwise(none)
    some = F.rlike("_text", F.lit("[0-9@]"))
    words = F.when(some, _words(F.col("_text"))).otherwise(none).alias("_words")
    gaps = F.when(some, F.regexp_extract_all("_text", F.lit(r"\s+"), F.lit(0))).otherwise(none).alias("_gaps")
    df = df.select(*carried, words, gaps, *[f"_m_{k}" for k in PATTERNS_OF], *[v.alias(f"_p_{k}") for k, v in split.items()])
    df = df.select(*carried, "_words", "_gaps", *[_located(F.col(f"_m_{k}"), F.col(f"_p_{k}")).alias(f"_s_{k}") for k in PATTERNS_OF])
    spans = [_tagged(i, kind) for i, kind in enumerate(KINDS)]
    df = df.select(*carried, "_words", "_gaps", F.array_sort(F.concat(*spans)).alias("base"))
    df = df.select(*carried, "base", _tokens(F.col("base")).alias("tokens"))
    return df.select("_row", "_id", *[F.col(k).alias(c) for c, k in zip(keep, kept, strict=True)], "base", "tokens")


def _noisy_or(confidence: Column) -> Column:
    return 1 - F.exp(F.sum(F.log(F.greatest(1 - confidence, F.lit(1e-9)))))


def _samples(texts: DataFrame, rows: int) -> list[DataFrame]:
    """The texts dealt into parts, from the smallest to the largest: the first parts together are a sample, each about
    GROWTH times the one before."""
    levels = max(0, math.ceil(math.log(max(rows, 1) / FIRST, GROWTH)))
    level = F.least(F.floor(-F.log(1 - F.rand(1)) / math.log(GROWTH)), F.lit(levels)).cast("int")
    dealt = C.saved(texts.withColumn("level", level), partition_by="level")
    return [dealt.where(F.col("level") == k).select("text") for k in range(levels, -1, -1)]


def _mark(w1: Column, w2: Column) -> Column:
    """A number below MARKS for two words."""
    return F.pmod(F.xxhash64(w1, w2), F.lit(MARKS))


def _marks(patterns: DataFrame) -> Column:
    """The marks of the patterns as bits of an array of longs, which holds MARKS bits however many they are."""
    no = _mark(F.col("w1"), F.col("w2")) + 1  # bitmaps number from 1
    parts = patterns.groupBy(F.bitmap_bucket_number(no).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(no)).alias("bits")).collect()
    of = {r["b"]: bytes(r["bits"]) for r in parts}
    bits = b"".join(of.get(b + 1, bytes(_BITMAP // 8)) for b in range(MARKS // _BITMAP))
    return F.from_json(F.lit(str(list(struct.unpack(f"<{MARKS // 64}q", bits)))), "array<bigint>")


def _slots(texts: DataFrame, patterns: DataFrame, small: int) -> DataFrame:
    """(w1, w2, slots): how often each pattern is followed by anything.  patterns: saved; broadcast up to ``small`` bytes of words.

    Pairs of words whose mark no pattern has are dropped inside their text; those left meet the patterns themselves.
    """
    words = texts.select(_words(F.lower(F.btrim(F.col("text"), F.lit(" \t\n\x0b\f\r")))).alias("w"))
    n = F.greatest(F.size("w") - 2, F.lit(0))
    pairs = F.arrays_zip(F.slice("w", F.lit(1), n).alias("w1"), F.slice("w", F.lit(2), n).alias("w2"))
    marks = _marks(patterns)

    def marked(p):
        mark = _mark(p["w1"], p["w2"])
        return F.bit_get(F.get(marks, F.shiftright(mark, 6).cast("int")), (mark % 64).cast("int")) == 1

    pairs = words.select(F.explode(F.filter(pairs, marked)).alias("p")).select("p.w1", "p.w2")
    size = patterns.agg(F.coalesce(F.sum(F.octet_length("w1") + F.octet_length("w2") + 32), F.lit(0))).first()[0]
    if size <= small:
        return pairs.join(F.broadcast(patterns), ["w1", "w2"]).groupBy("w1", "w2").agg(F.count("*").alias("slots"))
    # counted map-side before the shuffle; the join then meets one row a pair
    return pairs.groupBy("w1", "w2").agg(F.count("*").alias("slots")).join(patterns, ["w1", "w2"])


def _counted(samples: list[DataFrame], due: DataFrame, confidence: float, small: int) -> DataFrame:
    """(w1, w2, slots) of the patterns (w1, w2, most: saved) that could reach the confidence if all their identifiers were known."""
    left = due.withColumn("slots", F.lit(0).cast("long"))
    for part in samples:
        seen = _slots(part, left.select("w1", "w2"), small).withColumnRenamed("slots", "more")
        slots = F.col("slots") + F.coalesce("more", F.lit(0))
        left = C.saved(left.join(seen, ["w1", "w2"], "left").select("w1", "w2", "most", slots.alias("slots"))
                       .where(F.col("most") >= confidence * F.greatest("slots", "most")))
    return left.select("w1", "w2", "slots")


def discovered(spans: DataFrame, texts: DataFrame, support: int = SUPPORT, confidence: float = CONFIDENCE,
               score: float = SCORE, small: int = SMALL) -> DataFrame:
    """(value): identifier-like values that confident patterns find.  spans: of ``base_spans``, saved; texts: (text)."""
    seen = spans.select(F.explode(F.concat(
        F.transform("base", lambda s: F.struct(F.lower(s["value"]).alias("value"), s["before"].alias("before"), F.lit(1.0).alias("seed"))),
        F.transform("tokens", lambda s: F.struct(F.lower(s["value"]).alias("value"), s["before"].alias("before"), F.lit(0.0).alias("seed"))))).alias("s"))
    edges = C.saved(seen.select("s.value", "s.before.w1", "s.before.w2", "s.seed")
                    .groupBy("value", "w1", "w2").agg(F.count("*").alias("n"), F.max("seed").alias("seed")))
    seeds = C.saved(edges.where("seed > 0").select("value", F.lit(1.0).alias("score")).distinct())
    # what no round can admit is out: patterns of too few values, and those that hold nothing but seeds
    candidates = C.saved(edges.where("w1 <> ''").groupBy("w1", "w2")
                         .agg(F.sum("seed").alias("seeds"), F.count("*").alias("values"), F.sum("n").alias("most"))
                         .where((F.col("values") >= support) & (F.col("values") > F.col("seeds"))).select("w1", "w2", "most"))
    edges = C.saved(edges.join(candidates, ["w1", "w2"]))
    asked = candidates.where("false").select("w1", "w2")
    slots = asked.withColumn("slots", F.lit(0).cast("long"))
    graph, new = edges.join(slots, ["w1", "w2"]), seeds.where("false")
    samples = _samples(texts, spans.count())
    while True:
        # slots are counted for the patterns that have enough known values now and had not before (one not counted is out for good)
        due = C.saved(edges.join(seeds.union(new), "value").groupBy("w1", "w2").agg(F.count("*").alias("known"), F.first("most").alias("most"))
                      .where(F.col("known") >= support).join(asked, ["w1", "w2"], "left_anti").select("w1", "w2", "most"))
        if due.limit(1).count():
            asked = asked.union(due.select("w1", "w2"))
            slots = slots.union(_counted(samples, due, confidence, small))
            graph = C.saved(edges.join(slots, ["w1", "w2"]))
        held = graph.join(seeds.union(new), "value", "left").withColumn("score", F.coalesce("score", F.lit(0.0)))
        rated = (held.groupBy("w1", "w2").agg((F.sum(F.col("n") * F.col("score")) / F.greatest(F.max("slots"), F.sum("n"))).alias("confidence"),
                                              F.sum(F.when(F.col("score") > 0, 1).otherwise(0)).alias("known"))
                 .where((F.col("confidence") >= confidence) & (F.col("known") >= support)).select("w1", "w2", "confidence"))
        rating = held.join(rated, ["w1", "w2"]).groupBy("value").agg(F.max("score").alias("before"), _noisy_or(F.col("confidence")).alias("score"))
        rating = C.saved(rating.where(F.col("score") >= score).join(seeds, "value", "left_anti"))
        # scores never fall from round to round, so the rounds end
        grown = rating.where((F.col("before") == 0) | (F.col("score") - F.col("before") > SETTLED)).limit(1).count()
        new = rating.select("value", "score")
        if not grown:
            return new.select("value")


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), **bounds) -> DataFrame:
    """(id, kept columns, base, spans) of every row: arrays of (start, kind_no, end, kind), ordered by start, then kind."""
    spans = C.saved(base_spans(docs, id_col, text_col, keep))
    new = discovered(spans, docs.select(F.col(text_col).alias("text")), **bounds)
    tokens = spans.select("_row", F.explode("tokens").alias("t")).select("_row", F.col("t.start"), F.col("t.end"), F.lower("t.value").alias("value"))
    added = tokens.join(new, "value", "left_semi").groupBy("_row").agg(F.collect_list(F.struct(
        "start", F.lit(len(KINDS)).alias("kind_no"), "end", F.lit(ADDED).alias("kind"))).alias("added"))
    plain = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind_no"].alias("kind_no"), s["end"].alias("end"), s["kind"].alias("kind")))
    return (spans.join(added, "_row", "left").withColumn("base", plain)
            .withColumn("spans", F.array_sort(F.when(F.col("added").isNull(), F.col("base")).otherwise(F.concat("base", "added"))))
            .select(F.col("_id").alias(id_col), *keep, "base", "spans"))


def spans_text(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _cut(pieces: Column, start: Column, end: Column) -> Column:
    """Code points [start, end) of a text given as pieces of PIECE code points: each cut reads the pieces that it meets."""
    first, last = F.floor(start / PIECE).cast("int"), F.floor(end / PIECE).cast("int")
    head = F.coalesce(F.get(pieces, first), F.lit(""))
    off = (start % PIECE + 1).cast("int")
    inner = F.array_join(F.slice(pieces, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
    tail = F.substring(F.coalesce(F.get(pieces, last), F.lit("")), F.lit(1), (end % PIECE).cast("int"))
    return F.when(first == last, F.substring(head, off, (end - start).cast("int"))).otherwise(F.concat(F.substring(head, off, F.lit(PIECE)), inner, tail))


def masked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars", **bounds) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; overlapping spans become the first one's mark."""
    # inside, columns go by number: theirs may be named like ours
    safe = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    text = safe[text_col]
    found = find_pii(docs.toDF(*safe.values()), safe[id_col], text, keep=tuple(v for c, v in safe.items() if c != id_col), **bounds)
    some = F.size("spans") > 0
    at = _before(F.transform("spans", lambda s: s["end"]), lambda a, x: F.greatest(a, x), F.lit(0).cast("long"))
    # a span that starts inside an earlier one has no mark of its own
    marked = F.filter(F.arrays_zip(F.col("spans").alias("s"), at.alias("at")), lambda x: x["s"]["start"] >= x["at"])
    out = found.withColumn("_end", F.array_max(F.transform("spans", lambda s: s["end"])))

    def masked_text(pieces):
        body = F.transform(marked, lambda x: F.concat(_cut(pieces, x["at"], x["s"]["start"]), F.lit("["), F.upper(x["s"]["kind"]), F.lit("]")))
        return F.concat(F.array_join(body, ""), _cut(pieces, F.col("_end"), F.length(text).cast("long")))

    out = out.withColumn(text, F.when(some, _let(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)), masked_text)).otherwise(F.col(text)))
    if length_col in safe:
        n = safe[length_col]
        out = out.withColumn(n, F.when(some, F.length(text).cast(docs.schema[length_col].dataType)).otherwise(F.col(n)))
    return out.select(*[F.col(v).alias(c) for c, v in safe.items()])


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of every document."""
    found = find_pii(C.documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", *[_count(k) for k in KINDS], F.sha2(spans_text("base"), 256).alias("base_sha256"), spans_text("spans").alias("spans"))
