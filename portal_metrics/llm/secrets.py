"""Operator 6: secret scans, with a guess-cost dynamic program over credential values.

Base spans come from three patterns.  Besides, the value in a credential context (a
credential word, a separator, a value) is cut at least cost into dictionary words, dates, repeats,
keyboard walks and brute-force characters; costs are log10 of the guesses of a segment, plus a
constant a segment.  A value whose least cost reaches ``COST`` is a span of kind ``value``,
unless a base span covers part of it.

The dictionary is a list of common words of passwords and the words of the documents themselves: Spark counts in how many
texts each word stands outside of credential values, and the KEPT most frequent of those in at least two texts are guessed in that order.
Only this list, whose size is fixed, goes through the driver.

Positions are code points, end exclusive.  Defined results: NULL and empty texts have no spans and an
empty digest string; ties in start are ordered by kind; repeated rows are reported each; an
empty table gives an empty table; other columns pass through, except that columns named
like an output (base, spans) are replaced.  Texts and values are read whole, at any length.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portal_metrics.llm import common as C

KINDS = ("assign", "access", "hex", "value")
#: Base patterns (fixed values); ``a`` keeps the letters of the words in ASCII.
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # the runs of [0-9a-f]+ that are long enough
#: Words that announce a credential value, and the value.
CONTEXT = re.compile(r"""(?ai:\b(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_-]?key|credentials?|auth[_-]?key|private[_-]?key|login)\b["']?\x20*(?:[:=]|\bis\b|\bwas\b)\x20*["']?([^\s"'<>,;]{4,}))""")
#: The same for Spark's own functions, which count words.
VALUES = r"""(?i)\b(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_-]?key|credentials?|auth[_-]?key|private[_-]?key|login)\b["']?\x20*(?:[:=]|\bis\b|\bwas\b)\x20*["']?[^\s"'<>,;]{4,}"""
HINTS = ("pass", "pwd", "secret", "token", "api", "credential", "key", "login")
#: Least log10 of the guesses of a value that is a secret, and the cost of one more segment.
COST, SEGMENT = 8.0, 0.3

#: Common words of passwords, most common first (fixed values).
WORDS = """password pass word admin login welcome secret master dragon monkey shadow sunshine princess football baseball
letmein trustno hello freedom whatever qwerty abc love iloveyou michael jordan superman batman test user guest root default
changeme example sample none null true false required enter your here value string token key reset forgot invalid missing
protected strong weak account email name the and for with this that from not are was must should will can""".split()
#: Words of the documents that are kept, and the longest of them.
KEPT, LONGEST_WORD = 50_000, 32
RANK = {w: math.log10(i + 2) for i, w in enumerate(dict.fromkeys(WORDS))}
ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
_BESIDE = {(a, b) for row in ROWS for x, y in zip(row, row[1:], strict=False) for a, b in ((x, y), (y, x))}
_DATE = re.compile(r"(?:19|20)\d\d[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:(?:19|20)\d\d|\d\d)|(?:19|20)\d\d")
_DATE_COST = {4: 2.1, 6: 4.4}


def _brute(c: str) -> float:
    return 1.0 if c.isdigit() else math.log10(26) if c.islower() or c.isupper() else math.log10(33)


def learned_words(docs: DataFrame, text_col: str = "text", kept: int = KEPT, least: int = 2) -> list[str]:
    """The words of at least ``least`` texts, credential values left out, by the number of texts, most first."""
    plain = F.lower(F.regexp_replace(F.col(text_col).cast("string"), VALUES, " "))
    words = F.array_distinct(F.regexp_extract_all(plain, F.lit(rf"(?<!\p{{L}})\p{{L}}{{3,{LONGEST_WORD}}}(?!\p{{L}})"), F.lit(0)))
    counted = docs.select(F.explode(words).alias("word")).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    return [r["word"] for r in counted.orderBy(F.desc("n"), "word").limit(kept).select("word").collect()]


def ranks_of(words: list[str]) -> dict[str, float]:
    """log10 of the guesses of each word: the common words of passwords and ``words``, each at its better place."""
    out = {w: math.log10(i + 2) for i, w in enumerate(words)}
    return {**out, **{w: min(r, out.get(w, r)) for w, r in RANK.items()}}


def guess_cost(value: str, ranks: dict[str, float] = RANK) -> float:
    """log10 of the guesses of the cheapest segmentation, in time linear in the length."""
    n, low = len(value), value.lower()
    best = [0.0] + [math.inf] * n
    brute = [math.inf] * (n + 1)  # least cost of a segmentation that ends in a brute-force segment
    dates: dict[int, list[int]] = {}
    for i in range(n):
        for size in (4, 6, 8, 10):
            if value[i:i + 1].isdigit() and _DATE.fullmatch(value, i, min(n, i + size)):
                dates.setdefault(i, []).append(size)
    for i in range(n):
        here = best[i] + SEGMENT
        brute[i + 1] = min(brute[i], here) + _brute(value[i])
        best[i + 1] = min(best[i + 1], brute[i + 1])
        for size in range(2, min(LONGEST_WORD, n - i) + 1):
            rank = ranks.get(low[i:i + size])
            if rank is not None:
                best[i + size] = min(best[i + size], here + rank + (0.0 if value[i:i + size] == low[i:i + size] else 0.5))
        for size in dates.get(i, ()):
            if i + size <= n:
                best[i + size] = min(best[i + size], here + _DATE_COST.get(size, 4.6))
        # a run is entered at its first character; a shorter end of it is cheaper by brute force
        if i + 2 < n and low[i + 1] == low[i] and (i == 0 or low[i - 1] != low[i]):
            j = i + 1
            while j < n and low[j] == low[i]:
                j += 1
            if j - i > 2:
                best[j] = min(best[j], here + _brute(value[i]) + math.log10(j - i))
        if i + 2 < n and (low[i], low[i + 1]) in _BESIDE and (i == 0 or (low[i - 1], low[i]) not in _BESIDE):
            j = i + 1
            while j < n and (low[j - 1], low[j]) in _BESIDE:
                j += 1
            if j - i > 2:
                best[j] = min(best[j], here + math.log10(47) + math.log10(j - i) + 0.3)
    return best[n]


def find_spans(text: str, has_hex: bool = True, cost: float = COST, ranks: dict[str, float] = RANK) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of every span of a text, in order."""
    low = text.lower()
    hinted = any(h in low for h in HINTS)
    out = []
    if hinted or "ſ" in text or "K" in text:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    if has_hex:
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    if hinted:
        base = list(out)
        for m in CONTEXT.finditer(text):
            s, e = m.span(1)
            e -= len(m[1]) - len(m[1].rstrip(".:!?)]}"))
            if e - s >= 4 and not any(a < e and b > s for a, _, b in base) and guess_cost(text[s:e], ranks) >= cost:
                out.append((s, 3, e))
    return sorted(out)


_HEX_BYTES = np.zeros(256, bool)
_HEX_BYTES[[*range(48, 58), *range(97, 103)]] = True


def _rows_with_hex(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows that hold 16 hex digits in a row, or might: a run over a row's edge counts for both."""
    edge = np.diff(np.concatenate([[0], _HEX_BYTES[data].view(np.int8), [0]]))
    s, e = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long = e - s >= 16
    out = np.zeros(len(offsets) - 1, bool)
    first = np.searchsorted(offsets, s[long], side="right") - 1
    last = np.searchsorted(offsets, e[long], side="left") - 1
    for a, b in zip(first, last, strict=True):
        out[a:b + 1] = True
    return out


def scan(docs: DataFrame, text_col: str = "text", cost: float = COST, words: list[str] | None = None) -> DataFrame:
    """``docs`` with base and spans: arrays of (start, kind_no, end, kind).  words: the dictionary; learned from ``docs`` if None."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks_of(learned_words(docs, text_col) if words is None else words))
    docs = docs.drop(*[c for c in docs.columns if c.lower() in ("base", "spans")])
    kind = "array<struct<start:bigint,kind_no:int,end:bigint,kind:string>>"
    schema = T.StructType([*docs.schema.fields, *T._parse_datatype_string(f"base {kind}, spans {kind}").fields])
    arrow = pa.list_(pa.struct([("start", pa.int64()), ("kind_no", pa.int32()), ("end", pa.int64()), ("kind", pa.string())]))

    def work(batches):
        ranks = shared.value
        for b in batches:
            col = b.column(b.schema.get_field_index(text_col))
            data, offsets = C.text_bytes(col)
            hexed = np.concatenate([_rows_with_hex(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]) for i, j in C.slices(offsets)] or [np.zeros(0, bool)])
            found = [[{"start": s, "kind_no": k, "end": e, "kind": KINDS[k]} for s, k, e in find_spans(t or "", bool(h), cost, ranks)]
                     for t, h in zip(col.to_pylist(), hexed, strict=True)]
            base = [[s for s in x if s["kind_no"] < 3] for x in found]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(base, arrow), pa.array(found, arrow)], [*b.schema.names, "base", "spans"])

    return docs.mapInArrow(work, schema)


def _joined(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _count(kind: str) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every document."""
    found = scan(C.documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", *[_count(k) for k in KINDS[:3]], F.sha2(_joined("base"), 256).alias("base_sha256"), _joined("spans").alias("spans"))
