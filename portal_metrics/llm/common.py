"""Helpers shared by the operators: scratch tables, Arrow text buffers, word shingles."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

SHINGLE = 5
#: Bytes of text worked on at a time inside a task (numpy temporaries are ~10x this).
CHUNK_BYTES = 2 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_U = np.uint64


# ---------------------------------------------------------------- Spark side

def scratch_dir(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir`` (shared by all executors).

    Only a local master may run without that setting (tests): it gets a temporary folder.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def saved(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared scratch folder and read it back.

    Cuts the lineage: a lost executor costs no recomputation of what was written.
    """
    path = scratch_dir(df.sparkSession)
    schema = df.schema
    (df.write.partitionBy(partition_by) if partition_by else df.write).parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


# ---------------------------------------------------------- inside the tasks

def text_bytes(col: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; NULL is empty. No Python string is made."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col, pa.scalar("", col.type))
    if lower:
        col = pc.utf8_lower(col)
    col = col.cast(pa.large_binary())
    _, offsets, data = col.buffers()
    if len(col) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[col.offset:col.offset + len(col) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes each (a longer row is alone)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Powers:
    """Powers of the hash base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inv = _U(base), _U(pow(base, -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            m = max(n, 2 * len(self.up), (CHUNK_BYTES >> 3) + 1024)
            for name, b in (("up", self.base), ("down", self.inv)):
                p = np.full(m, b, np.uint64)
                p[0] = 1
                setattr(self, name, np.multiply.accumulate(p))
        return self.up, self.down


_POWERS: dict[int, _Powers] = {}


def prefix_hash(data: np.ndarray, base: int = int(_BASE)) -> tuple[np.ndarray, np.ndarray]:
    """(H, down): bytes [s, e) hash to (H[e] - H[s]) * down[s], modulo 2**64."""
    up, down = _POWERS.setdefault(base, _Powers(base)).get(len(data) + 1)
    h = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + _U(1)) * up[:len(data)], out=h[1:])
    return h, down


#: Word bytes: ASCII letters and digits, and every byte of a non-ASCII character.
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, per-row word offsets) of the words of each row."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    inside = _WORD[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of the words of each row, their per-row offsets, and their spans."""
    starts, ends, per = word_spans(data, offsets)
    h, down = prefix_hash(data)
    return mix((h[ends] - h[starts]) * down[starts] + (ends - starts).astype(np.uint64)), per, starts, ends


_GRAM = [_U(pow(0xD1342543DE82EF95, i + 1, 1 << 64)) for i in range(32)]


def shingles(words: np.ndarray, per: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of each row's runs of ``k`` words and their per-row offsets.

    A row of 1 to k-1 words has one shingle (all its words); an empty row has none.
    """
    n = np.diff(per)
    count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    out = np.concatenate([[0], np.cumsum(count)]).astype(np.int64)
    padded = np.concatenate([words, np.zeros(k, np.uint64)])
    rows = np.repeat(np.arange(len(n)), count)
    at = np.arange(out[-1]) - out[rows] + per[rows]
    total = np.zeros(len(at), np.uint64)
    short = n[rows] < k
    for i in range(k):
        w = padded[at + i]
        if short.any():
            w = np.where(short & (i >= n[rows]), _U(0), w)
        total += w * _GRAM[i]
    return mix(total), out


def text_shingles(data: np.ndarray, offsets: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    words, per, _, _ = word_hashes(data, offsets)
    return shingles(words, per, k)


def seeds(n: int) -> np.ndarray:
    """``n`` odd multipliers, the same in every task."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _BASE) | _U(1)


def minhashes(grams: np.ndarray, per: np.ndarray, n: int) -> np.ndarray:
    """(rows, n) signatures; a row without shingles gets the largest value."""
    rows = len(per) - 1
    out = np.full((rows, n), np.iinfo(np.uint64).max, np.uint64)
    full = np.flatnonzero(np.diff(per))
    if len(full):
        for i, a in enumerate(seeds(n)):
            out[full, i] = np.minimum.reduceat(grams * a, per[:-1][full])
    return out


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """(documents, bands) 64-bit keys, different for each band."""
    n, k = signature.shape
    b = k // rows
    key = np.zeros((n, b), np.uint64)
    for r in range(rows):
        key = mix(key * _GRAM[0] + signature[:, r:b * rows:rows])
    return mix(key + np.arange(1, b + 1, dtype=np.uint64) * _GRAM[1])


def bands_for(threshold: float, rows: int, recall: float) -> int:
    """Least number of bands with P(a pair at the threshold collides) >= recall."""
    miss = 1.0 - threshold ** rows
    return int(np.ceil(np.log(1.0 - recall) / np.log(miss)))


def text_digest(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each row's bytes."""
    out = []
    for base in (int(_BASE), 0xC2B2AE3D27D4EB4F):
        h, down = prefix_hash(data, base)
        s, e = offsets[:-1], offsets[1:]
        out.append(mix((h[e] - h[s]) * down[s] + (e - s).astype(np.uint64)))
    return out[0], out[1]


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows of equal ``keys`` of a partition that is sorted by them, several whole groups at a time."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        cols = [np.asarray(b.column(b.schema.get_field_index(k))) for k in keys]
        new = np.zeros(b.num_rows, bool)
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        cuts = np.flatnonzero(new)
        if held:
            last = held[-1]
            same = all(np.asarray(last.column(last.schema.get_field_index(k)))[-1] == c[0] for k, c in zip(keys, cols, strict=True))
            if not same:
                yield pa.Table.from_batches(held)
                held = []
        if len(cuts):
            held.append(b.slice(0, int(cuts[-1])))
            yield pa.Table.from_batches(held)
            held = [b.slice(int(cuts[-1]))]
        else:
            held.append(b)
    if held:
        yield pa.Table.from_batches(held)
