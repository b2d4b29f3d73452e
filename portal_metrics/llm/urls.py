"""Operator 8: URL filters by a sorted digest array.

Rules and blocked prefixes are full strings ``host`` + ``path prefix``.  A block of them is an
array of 64-bit xxhash digests in sorted order beside the strings; on an executor it is
a file that is memory-mapped.  A url is probed with every suffix of its host (cut at dots) joined to
the path prefixes of the lengths that the list holds; digests are found by a vectorised binary
search, and a hit counts only if the stored string is equal.  Of the hits the longest wins, rules
before blocked prefixes.  The list is taken in blocks of at most BLOCK entries, one
after the other in the same scan, so what is sent to the executors is bounded.

Defined results: NULL urls and urls without ``://`` have an empty host and path, no rule and the
default verdict (allow); repeated rows are judged each; an empty table gives an empty table; other
columns pass through, except that columns named like an output are replaced.
"""

from __future__ import annotations

import os
import re
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rules (host, path prefix, verdict) of the query (fixed values).
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))
#: Prefixes blocked by the method where no rule speaks: hosts and parts of hosts known for spam.
BLOCKED = (("spam-farm.example.com", ""), ("spam-farm.example.net", ""), ("spam-farm.example.org", ""))
BLOCK = 500_000

_URL = re.compile(r"^.*?://([^/?#]*)([^?#]*)", re.S)
_UPPER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def parts(url: str | None) -> tuple[str, str]:
    """(host, path) of a url; both empty without ``://``."""
    m = _URL.match(url or "")
    return (m[1].translate(_UPPER), m[2]) if m else ("", "")


def digests(keys: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(k) for k in keys), np.uint64, len(keys))


def pack(entries: Iterable[tuple[str, str, str]]) -> tuple[bytes, list[str], list[int]]:
    """(sorted digests, their ``host`` + tab + ``path`` + tab + verdict, lengths of the paths) of one block."""
    entries = sorted(set(entries))
    d = digests([f"{h}\t{p}".encode() for h, p, _ in entries])
    order = np.argsort(d, kind="stable")
    return d[order].tobytes(), ["\t".join(entries[i]) for i in order], sorted({len(p) for _, p, _ in entries})


class Index:
    """A block as a memory-mapped digest file of the task, with the stored strings."""

    def __init__(self, packed: tuple[bytes, list[str], list[int]], folder: str):
        path = os.path.join(folder, "digests")
        with open(path, "wb") as f:
            f.write(packed[0])
        self.digests = np.memmap(path, np.uint64, "r") if packed[0] else np.zeros(0, np.uint64)
        self.strings, self.lengths = packed[1], packed[2]

    def find(self, keys: list[str]) -> list[tuple[int, str]]:
        """(key number, verdict) of the keys ``host`` + tab + ``path`` that the block holds."""
        if not keys or not len(self.digests):
            return []
        d = digests([k.encode() for k in keys])
        lo, hi = np.searchsorted(self.digests, d, side="left"), np.searchsorted(self.digests, d, side="right")
        out = []
        for i in np.flatnonzero(hi > lo):
            for at in range(lo[i], hi[i]):  # equal digests: only the equal string counts
                key, _, verdict = self.strings[at].rpartition("\t")
                if key == keys[i]:
                    out.append((int(i), verdict))
        return out


def probes(host: str, path: str, lengths: list[int]) -> Iterator[str]:
    if not host and not path:
        return
    at = 0
    while at >= 0:
        for n in lengths:
            if n <= len(path):
                yield f"{host[at:]}\t{path[:n]}"
        at = host.find(".", at) + 1 or -1


def _blocks(entries: list[tuple[str, str, str]]) -> Iterator[list[tuple[str, str, str]]]:
    for i in range(0, len(entries), BLOCK):
        yield entries[i:i + BLOCK]


def judge(pages: DataFrame, url_col: str = "url", rules: Iterable[tuple[str, str, str]] = RULES,
          blocked: Iterable[tuple[str, str]] = BLOCKED) -> DataFrame:
    """``pages`` with host, path, rule and verdict of the url."""
    sc = pages.sparkSession.sparkContext
    pages = pages.drop(*[c for c in pages.columns if c.lower() in ("host", "path", "rule", "verdict")])
    entries = [*rules, *((h, p, "blocked") for h, p in blocked)]
    shared = [sc.broadcast(pack(x)) for x in _blocks(entries)]
    string = T.StringType()
    schema = T.StructType([*pages.schema.fields, *(T.StructField(n, string) for n in ("host", "path", "rule", "verdict"))])

    def work(batches):
        with tempfile.TemporaryDirectory() as top:
            indexes = []
            for i, s in enumerate(shared):
                os.mkdir(folder := os.path.join(top, str(i)))
                indexes.append(Index(s.value, folder))
            for b in batches:
                urls = [parts(u) for u in b.column(b.schema.get_field_index(url_col)).to_pylist()]
                rule: list[str | None] = [None] * len(urls)
                verdict = ["allow"] * len(urls)
                for index in indexes:
                    keys, owner = [], []
                    for i, (host, path) in enumerate(urls):
                        own = list(probes(host, path, index.lengths))
                        keys += own
                        owner += [i] * len(own)
                    for at, found in index.find(keys):
                        i, name = owner[at], keys[at].replace("\t", "")
                        if found == "blocked":
                            if rule[i] is None:
                                verdict[i] = "block"
                        elif rule[i] is None or len(name) > len(rule[i]):
                            rule[i], verdict[i] = name, found
                yield pa.RecordBatch.from_arrays(
                    [*b.columns, *(pa.array(x, pa.string()) for x in ([h for h, _ in urls], [p for _, p in urls], rule, verdict))],
                    [*b.schema.names, "host", "path", "rule", "verdict"])

    return pages.mapInArrow(work, schema)


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, host, path, rule, verdict of every page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge(pages).select("page_id", "host", "path", "rule", "verdict")


_FITS = " OR ".join(f"(n = {i} AND ('.' || host) LIKE '%.{h}' AND path LIKE '{p}%')" for i, (h, p, _) in enumerate(RULES))
OP8_SQL = f"""
WITH u AS (SELECT page_id, row_number() OVER () AS r,
  CASE WHEN strpos(url, '://') > 0 THEN translate(regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
  CASE WHEN strpos(url, '://') > 0 THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path FROM pages),
rules(n, name, says) AS (VALUES {", ".join(f"({i}, '{h}{p}', '{v}')" for i, (h, p, v) in enumerate(RULES))}),
f AS (SELECT r, arg_max(name, length(name)) AS rule, arg_max(says, length(name)) AS says FROM u JOIN rules ON {_FITS} GROUP BY r)
SELECT page_id, host, path, rule, CASE WHEN rule IS NOT NULL THEN says
  WHEN {" OR ".join(f"('.' || host) LIKE '%.{h}'" for h, _ in BLOCKED)} THEN 'block' ELSE 'allow' END AS verdict
FROM u LEFT JOIN f USING (r)
"""
