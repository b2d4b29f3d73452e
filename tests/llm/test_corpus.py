"""Operators 11, 12 and 13 against brute force and round trips."""
import glob
import gzip
import hashlib
import heapq
import json
import math
import random
import re
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T
from tokenizers import Tokenizer

from portal_metrics.llm import align, common, lexical, warc
from conftest_llm import frame

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# ------------------------------------------------------------------ operator 13

@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B), align.a_tokens(json.load(open(A)))


def ends(tokens):
    at, out = 0, {}
    for k, t in enumerate(tokens):
        at += len(t)
        out[at] = k
    return out


def alignment_brute(texts, libraries):
    a_lib, b_lib, a_bytes = libraries
    b_bytes = align.b_tokens(b_lib)
    found, counts = [], Counter()
    for i, t in texts:
        a = a_lib.encode(" " + t, add_special_tokens=False).ids if t else []
        b = b_lib.encode(t) if t else []
        whole = (" " + (t or "")).encode()
        if b"".join(a_bytes[x] for x in a) != whole or b"".join(b_bytes[x] for x in b) != whole:
            a, b = [], []
        a_end, b_end = ends([a_bytes[x] for x in a]), ends([b_bytes[x] for x in b])
        groups, links, p, q = [], [], 0, 0
        for e in sorted(a_end.keys() & b_end.keys()):
            k, m = a_end[e] + 1, b_end[e] + 1
            groups.append(",".join(map(str, a[p:k])) + "|" + ",".join(map(str, b[q:m])))
            links.append((a[k - 1], b[m - 1]))
            p, q = k, m
        counts.update(links)
        found.append((i, len(a), len(b), ";".join(groups), links))
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return sorted(((i, n_a, n_b, len(links), groups, len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links))
                   for i, n_a, n_b, groups, links in found), key=str)


TRICKY = ["<|endoftext|> plain", "<s></s><unk> <0x41>", " two  spaces   ", "tab\tline\n\nend\r\n", "日本語のテキスト 漢字", "👍🏽 emoji👩‍👩‍👧 \U0001fae8", "▁low ▁",
          "é è ê", "word " * 3000, "x" * 5000, "\x00null\x00", "ᏣᎳᎩ ꮳ ⱥ ẞ", "price 12,345.67 $9", " wide blank", "don't we'll I'd"]


@pytest.mark.parametrize("chunk,bucket", [(1 << 20, 8 << 20), (200, 500)])
def test_alignment(spark, texts, libraries, chunk, bucket):
    rows = [*texts, *((200 + i, t) for i, t in enumerate(TRICKY)), (None, "no id"), (None, "no id")]
    found = common.saved(align.alignments(frame(spark, rows).repartition(3), A, B, chunk=chunk, bucket=bucket))
    columns = ("k0", "n_a", "n_b", "n_groups", "groups")
    got = align.scored(found, columns).select(*columns, "n_links", "n_best", "count_sum").collect()
    assert sorted(map(tuple, got), key=str) == alignment_brute(rows, libraries)
    pairs = found.where("pair IS NOT NULL")
    assert (pairs.select("bucket").distinct().count() > 3) == (bucket == 500)


def test_alignment_memory_is_bounded(libraries, monkeypatch):
    monkeypatch.setattr(align, "MEMO", 5)
    monkeypatch.setattr(align, "MEMO_TOKENS", 4)
    al = align.Aligner(align.Tokenizers(open(A, "rb").read(), open(B, "rb").read()))
    texts = [(i, t) for i, t in enumerate(TRICKY)]
    want = {i: (n_a, n_b, groups) for i, n_a, n_b, _, groups, *_ in alignment_brute(texts, libraries)}
    for _ in range(2):
        for i, t in texts:
            n_a, n_b, groups, _, _ = al.align([t])
            assert (int(n_a[0]), int(n_b[0]), groups[0]) == want[i]


def test_alignment_of_an_empty_table(spark, empty):
    found = common.saved(align.alignments(empty, A, B, keep=("doc_id", "ids", "value")))
    assert align.scored(found, ("k0", "k1", "k2")).collect() == []


# ------------------------------------------------------------------ operator 12

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(t):
    return [x.translate(FOLD) for x in WORD.findall(t or "")]


def ranking_brute(texts, items, k):
    found = [(i, Counter(terms(t))) for i, t in texts]
    found = [(i, c, sum(c.values())) for i, c in found if c]
    n_docs, n_terms = len(found), sum(n for _, _, n in found)
    df = Counter(t for _, c, _ in found for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c, n in found:
            m = 50 + 50 * n * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def item_frame(spark, items):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in items], "item_id long, text string, score string, doc_id string")


@pytest.mark.parametrize("k,width,limits", [(50, 1024, {}), (3, 4, {"ROWS": 4, "ROUND": 2, "LOOKUPS": 7, "FAN_IN": 1}),
                                            (2, 1, {"ROWS": 8, "ROUND": 3, "BLOCK_ITEMS": 2, "BLOCK_TERMS": 12})])
def test_lexical_search(spark, texts, monkeypatch, k, width, limits):
    for name, value in limits.items():
        monkeypatch.setattr(lexical, name, value)
    rng = random.Random(11)
    vocabulary = ["Été", "ÉTÉ", "alpha1", "Alpha1", "日本", "x", "foo_bar", "K"]
    rows = [*texts, *((300 + i, " ".join(rng.choices(vocabulary, k=rng.randrange(1, 30)))) for i in range(40)), (None, "alpha1 x"), (None, "alpha1 x"), (7, "alpha1 x"), (900, "x " * 9000)]
    items = [(0, "alpha1 été x"), (1, "K foo"), (1, "K foo"), (2, ""), (3, None), (None, "日本 ALPHA1 alpha1"), (4, "absent words"), (5, texts[4][1])]
    got = lexical.ranked(frame(spark, rows).repartition(4), item_frame(spark, items), k=k, width=width).collect()
    assert sorted(map(tuple, got), key=str) == ranking_brute(rows, items, k)


def test_lexical_search_of_empty_tables(spark, texts, empty):
    some = item_frame(spark, [(1, "x")])
    assert lexical.ranked(empty, some).collect() == []
    assert lexical.ranked(frame(spark, texts), item_frame(spark, [(1, None)])).collect() == []
    assert lexical.ranked(frame(spark, [(1, None), (2, "--")]), some).collect() == []


# ------------------------------------------------------------------ operator 11

PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType()),
                      *[T.StructField(n, T.StringType()) for n in ("payload", "digest", "id", "record_type", "value")]])
LONG = "<p>é " + "copy " * 40
FAKE = "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 4
ROWS = [(9, "http://B.example.com/x?q=1#f", LONG), (3, "http://b.example.com/x", LONG), (4, "https://a.example.com/", LONG), (3, "http://b.example.com/x", LONG),
        (None, "http://b.example.com/x", LONG), (5, "http://z.example.org", FAKE), (6, None, FAKE), (7, "no scheme", None), (8, "http://s/ a\r\nb\tc\x01", ""),
        (10, "http://s/", "short"), (11, "http://s/", "short"), (None, "http://n/", "n" * 200), (None, "http://n/", "n" * 200), (12, "http://l/", "é" * 300_000),
        (13, "http://s/", "x" * 99), (14, "http://s/", "x" * 99), (15, "http://s/", "y" * 100), (16, "http://s/", "y" * 100), (-2, "http://s/é", "y" * 100)]


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, *["x"] * 5) for i, u, h in rows], PAGES)


def captures_brute(rows):
    first, n = {}, Counter((h or "") for _, _, h in rows)
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= 100 and n[h] > 1:
            first[h] = min(i, first.get(h, i))
    out = []
    for i, _, h in rows:
        p = (h or "").encode()
        refers = first[h] if h in first and first[h] != i else None
        out.append((i, len(p), hashlib.sha256(p).hexdigest(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


def records(path):
    """Every record of the archive's files, read by its Content-Length alone."""
    for name in glob.glob(f"{path}/records/part-*"):
        data = (gzip.open if name.endswith(".gz") else open)(name, "rb").read()
        while data:
            head, rest = data.split(b"\r\n\r\n", 1)
            fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
            assert head.startswith(b"WARC/1.1\r\n")
            n = int(fields["Content-Length"])
            assert rest[n:n + 4] == b"\r\n\r\n"
            yield fields, rest[:n]
            data = rest[n + 4:]


@pytest.mark.parametrize("compression", ["gzip", None])
def test_archive_round_trip(spark, compression):
    path = common.scratch_dir(spark)
    archive = warc.write_archive(pages(spark, ROWS).repartition(3), path, compression=compression)
    back = warc.read_archive(spark, path, archive).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in back), key=str) == captures_brute(ROWS)
    of = {(i, u): h or "" for i, u, h in ROWS}
    for r in back:
        if r.page_id not in (None, 7, 8):
            assert r.payload is None if r.record_type == "revisit" else r.payload == of[r.page_id, r.url]
    raw = list(records(path.replace("file:", "")))
    assert len(raw) == len(ROWS) and len({f["WARC-Record-ID"] for f, _ in raw}) == len({(i, h or "") for i, _, h in ROWS})
    assert {f["WARC-Refers-To"] for f, _ in raw if f["WARC-Type"] == "revisit"} <= {f["WARC-Record-ID"] for f, _ in raw if f["WARC-Type"] == "response"}
    for f, block in raw:
        http, payload = block.split(b"\r\n\r\n", 1)
        said = f["WARC-Payload-Digest"].removeprefix("sha256:")
        assert f["WARC-Warcinfo-ID"] == f"<urn:uuid:{archive}>"
        if f["WARC-Type"] == "revisit":
            assert payload == b"" and f["WARC-Profile"] == warc.PROFILE and "WARC-Refers-To-Page-ID" in f
        else:
            assert hashlib.sha256(payload).hexdigest() == said and f"Content-Length: {len(payload)}".encode() in http


def test_a_changed_archive_is_refused(spark, tmp_path):
    path = str(tmp_path / "w")
    archive = warc.write_archive(pages(spark, ROWS[:3]).coalesce(1), path, compression=None)
    lines = spark.read.option("lineSep", "\x00").text(f"{path}/records")
    for before, after, said in (("copy copy", "copy cop", "Content-Length"), ("copy copy", "copy cOpy", "digest")):
        changed = str(tmp_path / said)
        lines.selectExpr(f"regexp_replace(value, '{before}', '{after}') AS value").write.option("lineSep", "\x00").text(f"{changed}/records")
        with pytest.raises(Exception, match=said):
            warc.read_archive(spark, changed, archive).collect()


@pytest.mark.parametrize("run_rows,range_rows", [(50_000, 50_000), (2, 3)])
def test_capture_index_is_in_order(spark, run_rows, range_rows):
    path = common.scratch_dir(spark)
    archive = warc.write_archive(pages(spark, ROWS).repartition(3), path)
    got = warc.capture_index(warc.read_archive(spark, path, archive), run_rows, range_rows).orderBy("place").collect()
    assert [r.place for r in got] == list(range(len(ROWS)))
    keys = [(r.url_key, r.captured, r.page_id is None, r.page_id or 0) for r in got]
    assert keys == sorted(keys)
    assert {r.url_key for r in got if r.page_id in (9, 3)} == {"com,example,b)/x?q=1#f", "com,example,b)/x"}
    assert [r.url_key for r in got if r.page_id in (6, 7)] == [")", ")"]


def test_archive_of_an_empty_table(spark):
    path = common.scratch_dir(spark)
    archive = warc.write_archive(pages(spark, []), path)
    assert warc.capture_index(warc.read_archive(spark, path, archive)).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 20))))
def test_loser_tree(sources):
    sources = [[(x,) for x in sorted(s)] for s in sources]
    got = list(warc.LoserTree(sources))
    assert got == list(heapq.merge(*([(x, i) for x in s] for i, s in enumerate(sources))))
