"""Operator 7: byte-level BPE encoding and decoding.

Every match of the split pattern is encoded separately.  A segment tree over
the byte positions of a match holds, at the leaf of each live part, the rank of
the pair that starts there; its root is the leftmost pair of least rank.  A
merge unlinks the right part and updates three leaves (the merged part, its
left neighbour, the dead part), so a match of n bytes takes O(n log n) however
long it is.  Short matches of a batch have their trees side by side in one
array, one merge of each a round; long ones have a tree of their own.

Defined results: NULL and empty texts have no tokens and decode to no bytes;
rows are independent, so repeated rows and ties of ``doc_id`` change nothing;
an empty table gives an empty table; columns of the input are kept, and the
output columns (``ids`` by default) replace columns of the same name.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Split pattern of the public rank files (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Matches remembered per Python worker in each of two generations; a match met again moves to the younger one.
CACHE_ENTRIES = 75_000
#: Longer matches are not remembered (they hardly repeat).
CACHE_BYTES = 64
#: Matches of at most so many bytes share one array of trees, so many matches at a time.
SIDE_BY_SIDE_BYTES = 64
SIDE_BY_SIDE = 8192

_NONE = 1 << 62
_SHIFT = 32
_MASK = (1 << _SHIFT) - 1


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a file of lines ``base64(token) rank``."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def _put(tree: list[int], k: int, value: int) -> None:
    """Set leaf ``k``; its ancestors change up to the first whose least child stays the same."""
    if tree[k] == value:
        return
    tree[k] = value
    k >>= 1
    while k:
        least = tree[2 * k]
        other = tree[2 * k + 1]
        if other < least:
            least = other
        if tree[k] == least:
            return
        tree[k] = least
        k >>= 1


def encode_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one match, by merging the leftmost pair of least rank until none is left."""
    get = ranks.get
    whole = get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    size = 1 << (n - 1).bit_length()
    tree = [_NONE] * (2 * size)
    for i in range(n - 1):
        rank = get(piece[i:i + 2])
        if rank is not None:
            tree[size + i] = rank << _SHIFT | i
    for k in range(size - 1, 0, -1):
        a, b = tree[2 * k], tree[2 * k + 1]
        tree[k] = a if a < b else b
    after = list(range(1, n + 2))
    before = list(range(-1, n))
    while tree[1] != _NONE:
        i = tree[1] & _MASK
        dead = after[i]
        end = after[dead]
        after[i] = end
        before[end] = i
        _put(tree, size + dead, _NONE)
        rank = get(piece[i:after[end]]) if end < n else None
        _put(tree, size + i, _NONE if rank is None else rank << _SHIFT | i)
        left = before[i]
        if left >= 0:
            rank = get(piece[left:end])
            _put(tree, size + left, _NONE if rank is None else rank << _SHIFT | left)
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:after[i]]])
        i = after[i]
    return out


class Pairs:
    """Rank of two adjacent tokens, for arrays: every split of a token into two tokens, as sorted keys."""

    def __init__(self, ranks: dict[bytes, int]):
        get = ranks.get
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("the ranks must hold every single byte")
        rank_of = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = get(token[:i]), get(token[i:])
                if left is not None and right is not None:
                    rank_of[left << _SHIFT | right] = rank
        keys = np.fromiter(rank_of, np.int64, len(rank_of))
        order = np.argsort(keys)
        self.keys = np.append(keys[order], _NONE)
        self.ranks = np.append(np.fromiter(rank_of.values(), np.int64, len(rank_of))[order], 0)
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)

    def leaf(self, left: np.ndarray, right: np.ndarray, at: np.ndarray, there: np.ndarray) -> np.ndarray:
        """What the leaves at positions ``at`` hold: rank and position of the pair, or nothing."""
        key = left << _SHIFT | right
        k = np.searchsorted(self.keys, key)
        return np.where(there & (self.keys[k] == key), self.ranks[k] << _SHIFT | at, _NONE)


def encode_side_by_side(pieces: list[bytes], size: int, pairs: Pairs) -> list[bytes]:
    """Packed ids of matches of 2 to ``size`` bytes (a power of two), all trees in one array."""
    m = len(pieces)
    n = np.fromiter(map(len, pieces), np.int64, m)
    ids = pairs.of_byte[np.frombuffer(b"".join(p.ljust(size, b"\0") for p in pieces), np.uint8).reshape(m, size)]
    at = np.arange(size)
    after = np.tile(np.arange(1, size + 2), (m, 1))
    before = np.tile(np.arange(-1, size), (m, 1))
    tree = np.full((m, 2 * size), _NONE, np.int64)
    tree[:, size:-1] = pairs.leaf(ids[:, :-1], ids[:, 1:], at[:-1], at[1:] < n[:, None])
    k = size
    while k > 1:
        tree[:, k // 2:k] = np.minimum(tree[:, k:2 * k:2], tree[:, k + 1:2 * k:2])
        k //= 2
    live = at < n[:, None]
    row = np.arange(m)
    while True:
        row = row[tree[row, 1] != _NONE]
        if not len(row):
            break
        i = tree[row, 1] & _MASK
        ids[row, i] = tree[row, 1] >> _SHIFT
        dead = after[row, i]
        end = after[row, dead]
        after[row, i] = end
        before[row, end] = i
        live[row, dead] = False
        left = before[row, i]
        first = left < 0
        left = np.where(first, i, left)
        tree[row, size + dead] = _NONE
        tree[row, size + left] = pairs.leaf(ids[row, left], ids[row, i], left, ~first)
        tree[row, size + i] = pairs.leaf(ids[row, i], ids[row, np.minimum(end, size - 1)], i, end < n[row])
        nodes = [size + dead, size + left, size + i]
        for _ in range(size.bit_length() - 1):
            nodes = [k >> 1 for k in nodes]
            for k in nodes:
                tree[row, k] = np.minimum(tree[row, 2 * k], tree[row, 2 * k + 1])
    packed = ids[live].astype("<u4").tobytes()
    ends = (4 * np.cumsum(live.sum(axis=1))).tolist()
    return [packed[s:e] for s, e in zip([0, *ends[:-1]], ends, strict=True)]


class Encoder:
    """Texts -> ids packed as little-endian unsigned 32-bit integers, with a bounded memory of past matches."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks, self.findall = ranks, regex.compile(pattern).findall
        self.pairs = Pairs(ranks)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def merged(self, matches: list[str]) -> Iterator[tuple[str, bytes]]:
        """(match, packed ids) of every match, in any order."""
        classes: dict[int, list[tuple[str, bytes]]] = {}
        for match in matches:
            piece = match.encode()
            if piece in self.ranks:
                yield match, np.array([self.ranks[piece]], "<u4").tobytes()
            elif len(piece) > SIDE_BY_SIDE_BYTES:
                yield match, np.array(encode_piece(piece, self.ranks), "<u4").tobytes()
            else:
                classes.setdefault(1 << (len(piece) - 1).bit_length(), []).append((match, piece))
        for size, some in classes.items():
            for s in range(0, len(some), SIDE_BY_SIDE):
                part = some[s:s + SIDE_BY_SIDE]
                yield from zip([m for m, _ in part], encode_side_by_side([p for _, p in part], size, self.pairs), strict=True)

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        found = [self.findall(t) if t else [] for t in texts]
        known: dict[str, bytes] = {}
        new = []
        for match in set().union(*found):
            packed = self.young.get(match)
            if packed is None:
                packed = self.old.get(match)
                if packed is None:
                    new.append(match)
                    continue
                self.young[match] = packed
            known[match] = packed
        for match, packed in self.merged(new):
            known[match] = packed
            if len(match) <= CACHE_BYTES:
                self.young[match] = packed
        if len(self.young) > CACHE_ENTRIES:
            self.old, self.young = self.young, {}
        return [b"".join(map(known.__getitem__, matches)) for matches in found]


_ENCODERS: dict[int, Encoder] = {}
_TOKENS: dict[int, dict[int, bytes]] = {}


def _encoder(shared: Broadcast, pattern: str) -> Encoder:
    """One encoder per worker process, kept between its tasks."""
    key = hash((id(shared), pattern)) if shared._jbroadcast is not None else hash((shared._path, pattern))
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(shared.value, pattern)
    return _ENCODERS[key]


def _replaced(df: DataFrame, name: str) -> tuple[DataFrame, T.StructType]:
    df = df.drop(*[c for c in df.columns if c.lower() == name.lower()])
    return df, T.StructType([*df.schema.fields, T.StructField(name, T.BinaryType())])


def _with(batch: pa.RecordBatch, name: str, values: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.binary())], [*batch.schema.names, name])


def _small(batches: Iterator[pa.RecordBatch], column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut so that one holds about ``most`` bytes of the column."""
    for b in batches:
        each = max(1, int(most * b.num_rows / max(1, b.column(b.schema.get_field_index(column)).nbytes)))
        for i in range(0, b.num_rows, each):
            yield b.slice(i, each)


def broadcast_ranks(spark: SparkSession, path: str) -> Broadcast:
    """The rank file (a fixed vocabulary of some 50,000 tokens), sent once to each executor."""
    return spark.sparkContext.broadcast(read_ranks(path))


def encode(df: DataFrame, ranks: Broadcast, text_col: str = "text", out: str = "ids", pattern: str = PATTERN) -> DataFrame:
    """``df`` with ``out``: the ids of the text packed as little-endian unsigned 32-bit integers."""
    df, schema = _replaced(df, out)

    def work(batches):
        enc = _encoder(ranks, pattern)
        for b in _small(batches, text_col):
            yield _with(b, out, enc.encode_all(b.column(b.schema.get_field_index(text_col)).to_pylist()))

    return df.mapInArrow(work, schema)


def decode(df: DataFrame, ranks: Broadcast, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with ``out``: the bytes that the packed ids stand for."""
    df, schema = _replaced(df, out)

    def work(batches):
        tokens = [b""] * (max(ranks.value.values()) + 1)
        for token, rank in ranks.value.items():
            tokens[rank] = token
        for b in _small(batches, ids_col):
            packed = b.column(b.schema.get_field_index(ids_col)).to_pylist()
            yield _with(b, out, [b"".join(map(tokens.__getitem__, np.frombuffer(p or b"", "<u4").tolist())) for p in packed])

    return df.mapInArrow(work, schema)


def encode_decode(df: DataFrame, ranks: Broadcast, text_col: str = "text", ids: str = "ids", decoded: str = "decoded",
                  pattern: str = PATTERN, keep_text: bool = True) -> DataFrame:
    """``encode`` and ``decode`` in one Python worker a task: ``df`` with the packed ids and the bytes they stand for."""
    df, _ = _replaced(df, ids)
    df, _ = _replaced(df, decoded)
    kept = [f for f in df.schema.fields if keep_text or f.name != text_col]
    schema = T.StructType([*kept, T.StructField(ids, T.BinaryType()), T.StructField(decoded, T.BinaryType())])
    names = [f.name for f in kept]

    def work(batches):
        enc = _encoder(ranks, pattern)
        tokens = [b""] * (max(enc.ranks.values()) + 1)
        for token, rank in enc.ranks.items():
            tokens[rank] = token
        for b in _small(batches, text_col, 1 << 20):
            packed = enc.encode_all(b.column(b.schema.get_field_index(text_col)).to_pylist())
            back = [b"".join(map(tokens.__getitem__, np.frombuffer(p, "<u4").tolist())) for p in packed]
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(n)) for n in names), pa.array(packed, pa.binary()), pa.array(back, pa.binary())],
                                             [*names, ids, decoded])

    return df.mapInArrow(work, schema)


def n_tokens(ids_col: str = "ids") -> Column:
    return (F.octet_length(ids_col) / 4).cast("long")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    import public_tokenizers

    from portal_metrics.llm.common import documents

    ranks = broadcast_ranks(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    df = encode_decode(documents(spark, sf_dir).select("doc_id", "text"), ranks, keep_text=False)
    return df.select("doc_id", n_tokens().alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                     F.sha2("decoded", 256).alias("decoded_sha256"))
