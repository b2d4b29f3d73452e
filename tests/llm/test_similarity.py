"""Operators 1, 2, 4, 9 and 10 against brute force."""
import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from portal_metrics.llm import ann, common, decontam, graph, minhash, ngram_join, paragraph_dedup, suffix_dedup
from conftest_llm import frame, sentence

WORD = re.compile("[a-z0-9\x80-\U0010ffff]+")


def words(t):
    return WORD.findall((t or "").lower())


def grams(t):
    w = words(t)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def jaccard_brute(texts):
    sets = [grams(t) for _, t in texts]
    n = len(texts)
    linked = [[j for j in range(n) if j != i and sets[i] and sets[j] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8] for i in range(n)]
    root = list(range(n))
    for _ in range(n):
        for i in range(n):
            for j in linked[i]:
                root[i] = root[j] = min(root[i], root[j])
    least = {r: min(texts[i][0] for i in range(n) if root[i] == r) for r in set(root)}
    return sorted((texts[i][0], least[root[i]], len(linked[i])) for i in range(n))


def test_jaccard_join(docs, texts, empty):
    got = ngram_join.jaccard_classes(docs)
    assert sorted(map(tuple, got.collect())) == jaccard_brute(texts)
    assert ngram_join.jaccard_classes(empty).collect() == []
    kept = ngram_join.one_per_class(docs, got)
    assert kept.columns == docs.columns and {4, 7, 40} & {r.doc_id for r in kept.collect()} >= {4, 7}


def test_jaccard_join_with_null_and_repeated_ids(spark):
    rng = random.Random(9)
    a, b, c = (sentence(rng, 60) for _ in range(3))
    rows = [(None, a), (None, a + " more"), (5, a + " more words"), (None, b), (None, b), (7, c), (7, c), (7, b + " x"), (None, None), (None, None), (8, "")]
    got = [tuple(r) for r in ngram_join.jaccard_classes(frame(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted([(None, 5, 2), (None, 5, 2), (5, 5, 2), (None, 7, 2), (None, 7, 2), (7, 7, 1), (7, 7, 1), (7, 7, 2),
                                           (None, None, 0), (None, None, 0), (8, 8, 0)], key=str)
    only = [(None, a), (None, a), (None, c)]
    assert sorted(map(str, map(tuple, ngram_join.jaccard_classes(frame(spark, only)).collect()))) == ["(None, None, 0)", "(None, None, 1)", "(None, None, 1)"]


def test_one_row_of_each_class_with_null_and_repeated_ids(spark):
    rng = random.Random(5)
    a, b, c, d = (sentence(rng, 60) for _ in range(4))
    rows = [(1, a), (1, a), (2, a + " more"), (1, b), (0, b), (None, c), (None, d), (None, d), (3, d), (None, None), (None, ""), (4, " ")]
    kept = ngram_join.first_rows(frame(spark, rows))
    key = lambda x: (x[0] is None, x[0] or 0, x[1] or "", x[1] is None)
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=key) == sorted(
        [(1, a), (0, b), (None, c), (3, d), (None, None), (None, ""), (4, " ")], key=key)


def test_jaccard_join_with_many_tiles(docs, texts, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 3)  # the near copies span several tiles
    assert sorted(map(tuple, ngram_join.jaccard_classes(docs).collect())) == jaccard_brute(texts)


def test_bands_reach_the_recall():
    b = common.bands_for(0.8, 5, 0.9995)
    assert 1 - (1 - 0.8 ** 5) ** b >= 0.9995 > 1 - (1 - 0.8 ** 5) ** (b - 1)


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(300 + i, 301 + i) for i in range(40)]
    label = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in range(len(label)):
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    assert dict(map(tuple, graph.components(spark.createDataFrame(edges, "a long, b long")).collect())) == label


def test_leaks(spark, docs, texts, empty):
    rng = random.Random(1)
    items = [(1, " ".join(texts[11][1].split()[2000:2030])), (2, texts[8][1][50:400]), (3, "one"), (4, None), (5, ""), (6, "quite other words that are in no text at all")]
    items.append((7, " ".join(texts[11][1].split()[100:140]) + " " + " ".join(str(rng.random()) for _ in range(2))))
    brute = sorted((i, k, len(grams(u)), len(grams(t) & grams(u))) for i, t in texts for k, u in items
                   if grams(u) and len(grams(t) & grams(u)) / len(grams(u)) >= 0.8)
    bench = spark.createDataFrame([(k, u, "x") for k, u in items], "item_id long, text string, doc_id string")
    got = sorted((r.doc_id, r.item_id, r.n_item, r.n_found) for r in decontam.find_leaks(docs, bench).collect())
    assert got == brute and {x[1] for x in brute} >= {1, 2, 3}
    left = decontam.without_leaks(docs, bench)
    assert left.columns == docs.columns and left.count() == docs.count() - len({(i, t) for i, t in texts if any(b[0] == i for b in brute) and t})
    assert decontam.find_leaks(empty, bench).collect() == [] and decontam.find_leaks(docs, bench.limit(0)).collect() == []


def test_leaks_in_blocks(spark, docs, monkeypatch):
    bench = spark.createDataFrame([(k, f"one {k}") for k in range(9)] + [(9, "one")], "item_id long, text string")
    monkeypatch.setattr(decontam, "BLOCK_ITEMS", 3)
    assert [(r.doc_id, r.item_id) for r in decontam.find_leaks(docs, bench).collect()] == [(3, 9)]


def suffix_brute(texts, keep_first=False):
    data = [(t or "").encode() for _, t in texts]
    seen = Counter(x[j:j + 400] for x in data for j in range(len(x) - 399))
    out = []
    for (i, _), x in zip(texts, data, strict=True):
        gone = np.zeros(len(x) + 1, int)
        for j in range(len(x) - 399):
            if seen[x[j:j + 400]] > 1:
                gone[j] += 1
                gone[j + 400] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        kept = bytes(b for b, g in zip(x, gone, strict=True) if not g)
        out.append((i, len(x), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("local", [suffix_dedup.LOCAL, 1])
def test_suffix_dedup(docs, texts, empty, local):
    got = suffix_dedup.remove_repeats(docs, keep_first=False, local=local).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in got) == suffix_brute(texts)
    assert suffix_dedup.remove_repeats(empty).collect() == []


@pytest.mark.parametrize("local", [suffix_dedup.LOCAL, 1])
def test_suffix_dedup_names_the_documents_that_share(spark, texts, local):
    """Documents with a common 400-byte string hang together by their numbers; without one they have none."""
    rng = random.Random(5)
    a, b = sentence(rng, 110), sentence(rng, 110)
    rows = [(i, t) for i, t in dict(texts).items() if t] + [(100 + i, sentence(rng, 20) + x + sentence(rng, 5 + i)) for i, x in enumerate((a, a, b, b + a, sentence(rng, 90)))]
    rows.append((110, sentence(rng, 3) + b + " " + b))          # a repeat of its own as well
    rows.append((111, " ".join([sentence(random.Random(1), 100)] * 2)))
    got = {r.doc_id: set(r.shared_with) for r in suffix_dedup.remove_repeats(frame(spark, rows), keep_first=False, local=local).collect()}
    held = {i: {t.encode()[k:k + 400] for k in range(len(t.encode()) - 399)} for i, t in rows}
    common = {(i, j) for i in held for j in held if i < j and held[i] & held[j]}
    root = {i: i for i in held}
    for _ in held:
        for i in held:
            for j in held:
                if i != j and got[i] & got[j]:
                    root[i] = root[j] = min(root[i], root[j])
    assert all(root[i] == root[j] for i, j in common)
    assert {i for i in held if got[i]} == {i for pair in common for i in pair} and 111 not in {i for p in common for i in p}
    assert all(x in held for shared in got.values() for x in shared)


@pytest.mark.parametrize("local", [suffix_dedup.LOCAL, 1])
def test_suffix_dedup_names_the_documents_with_common_passages(spark, texts, local):
    """Passages below 400 bytes, at starts, inside and at ends of texts: named, and no byte of them removed."""
    rng = random.Random(9)
    short = [sentence(rng, 60)[:n] for n in (257, 300, 399)]
    long, own = sentence(rng, 110), sentence(rng, 60)[:300]
    assert all(suffix_dedup.PASSAGE <= len(x) < 400 for x in (*short, own))
    rows = [(i, t) for i, t in dict(texts).items() if t]
    rows += [(100, short[0] + sentence(rng, 40)), (101, sentence(rng, 30) + short[0]), (102, sentence(rng, 9) + short[1] + sentence(rng, 90)),
             (103, short[1]), (104, sentence(rng, 7) + long + short[2]), (105, long[1:] + sentence(rng, 3)), (106, sentence(rng, 20) + short[2] + sentence(rng, 50)),
             (107, own + sentence(rng, 30) + own), (108, sentence(rng, 120)), (109, short[0][:255] + "#"), (110, short[1])]
    got = suffix_dedup.remove_repeats(frame(spark, rows), keep_first=False, local=local, passage=suffix_dedup.PASSAGE).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in got) == suffix_brute(rows)
    for size, column in ((400, "shared_with"), (suffix_dedup.PASSAGE, "passages_with")):
        named = {r.doc_id: set(r[column]) for r in got}
        held = {i: {t.encode()[k:k + size] for k in range(len(t.encode()) - size + 1)} for i, t in rows}
        common = {(i, j) for i in held for j in held if i < j and held[i] & held[j]}
        root = {i: i for i in held}
        for _ in held:
            for i in held:
                for j in held:
                    if i != j and named[i] & named[j]:
                        root[i] = root[j] = min(root[i], root[j])
        assert all(root[i] == root[j] for i, j in common)
        assert {i for i in held if named[i]} == {i for pair in common for i in pair}
    assert {r.doc_id for r in got if r.doc_id >= 100 and r.passages_with} == {100, 101, 102, 103, 104, 105, 106, 110}


def test_parts_of_a_long_text_have_each_window_once(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SLICE", 500)
    monkeypatch.setattr(suffix_dedup, "PART", 700)
    data = np.random.default_rng(3).integers(97, 123, 5000).astype(np.uint8)
    offsets = np.array([0, 300, 4700, 5000])
    found = Counter()
    for i, j, parts in suffix_dedup._parts(offsets, 100, 160):
        for s, e, skipped in parts:
            own = np.array([0, e - s]) if j - i == 1 else offsets[i:j + 1] - s
            row, start, n, _, _, _, size = suffix_dedup.runs_of(data[s:e], own, 100, 16, 160, suffix_dedup.PART if len(parts) > 1 else None)
            for r, a, m, z in zip(row, start + skipped, n, size, strict=True):
                found.update((i + r, a + k) for k in range(m))
                assert z == min(m - 1 + 160, offsets[i + r + 1] - offsets[i + r] - a)
    assert found == Counter((r, k) for r in range(3) for k in range(int(offsets[r + 1] - offsets[r]) - 99))


@pytest.mark.parametrize("local", [suffix_dedup.LOCAL, 1])
def test_suffix_dedup_keeps_the_first(docs, texts, local):
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(docs, keep_first=True, local=local).where("doc_id in (4, 5, 8, 9)").collect()}
    assert got[4].n_removed == 0 and got[5].n_removed == got[5].n_bytes and got[8].n_removed == 0 and got[9].n_removed >= 400


@pytest.mark.parametrize("local", [suffix_dedup.LOCAL, 1])
def test_suffix_dedup_with_null_ids(spark, local):
    rng = random.Random(11)
    shared = sentence(rng, 100)
    rows = [(None, "x" + sentence(rng, 20) + shared), (5, sentence(rng, 30) + shared + sentence(rng, 9)), (6, shared + sentence(rng, 50)),
            (None, sentence(rng, 90)), (None, None)]
    rows.append(rows[3])
    got = suffix_dedup.remove_repeats(frame(spark, rows), keep_first=False, local=local).collect()
    out = [(-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in got]
    assert sorted(out) == suffix_brute([(-1 if i is None else i, t) for i, t in rows])


@settings(max_examples=40, deadline=None)
@given(st.lists(st.binary(min_size=20, max_size=60).map(lambda b: bytes(x % 3 for x in b)), min_size=1, max_size=5))
def test_repeated_windows(spans):
    length = 18
    windows = np.array([len(s) - length + 1 for s in spans])
    flat = [s[j:j + length] for s in spans for j in range(len(s) - length + 1)]
    seen, first = Counter(flat), {}
    for i, w in enumerate(flat):
        first.setdefault(w, i)
    any_, earlier = suffix_dedup.repeated_windows(spans, windows, length)
    assert any_.tolist() == [seen[w] > 1 for w in flat] and earlier.tolist() == [first[w] < i for i, w in enumerate(flat)]


def test_paragraphs(docs, texts, empty, spark):
    parts, _ = paragraph_dedup.repeats(docs)
    classes = {}
    for r in parts.collect():
        classes.setdefault(r.doc_id, set()).add(r.keeper)
    runs = {}
    for i, t in texts:
        w = words(t)
        for j in range(len(w) - 49):
            runs.setdefault(tuple(w[j:j + 50]), set()).add(i)
    for group in runs.values():
        for a in group if len(group) > 1 else ():
            assert classes[a] & classes[min(group)], (a, group)
    assert not {20, 21, 22, 12} & classes.keys() and 8 in classes[8] & classes[9] and 7 in classes[7]
    assert paragraph_dedup.repeats(empty)[0].collect() == []


def wrapped(text, width):
    w = text.split(" ")
    return "\n".join(" ".join(w[i:i + width]) for i in range(0, len(w), width))


@pytest.mark.parametrize("width", [4, 5, 6, 7, 8, 10, 12])
def test_paragraphs_wrapped_otherwise_hang_together(spark, width):
    """Passages of 56 words, wrapped in lines of some words: in both documents alike, from another word on, or in one line."""
    rng = random.Random(width)
    rows, pairs = [], []
    for k in range(12):
        passage, before, after = sentence(rng, 56), sentence(rng, 20 + k), sentence(rng, 15)
        rows += [(10 * k, wrapped(passage, width) + "\n" + sentence(rng, 30)), (10 * k + 1, wrapped(before, 9) + "\n" + wrapped(passage, width)),
                 (10 * k + 2, wrapped(before[::-1] + " " + passage + " " + after, width)), (10 * k + 3, sentence(rng, 8) + " " + passage + " " + sentence(rng, 40))]
        pairs += [(10 * k, 10 * k + i) for i in (1, 2, 3)]
    got = {r.doc_id: set(r.classes) for r in paragraph_dedup.paragraph_repeats(frame(spark, rows)).collect()}
    assert all(got[a] & got[b] for a, b in pairs)
    assert all(not got[a] & got[b] for a in got for b in got if a // 10 != b // 10)


def test_paragraph_columns(spark):
    """Every column both ways, with NULL and repeated ids, a phrase repeated in a line, and documents that share nothing."""
    rng = random.Random(3)
    line, other, phrase = sentence(rng, 30), sentence(rng, 30), "buy now cheap " * 20
    near = line.split(" ")
    near[29] = "changed"
    rows = [(4, line + "\n" + other), (9, sentence(rng, 40) + "\n" + line), (5, " ".join(near) + "\nshort line"), (None, other), (None, other), (6, sentence(rng, 25)),
            (7, phrase + "\n" + sentence(rng, 12)), (8, sentence(rng, 14) + "\n" + phrase), (None, None), (3, ""), (6, "one two"), (None, sentence(rng, 25))]
    got = paragraph_dedup.paragraph_repeats(frame(spark, rows)).collect()
    assert len(got) == 7 + 3
    of = {r.doc_id: r for r in got if r.doc_id is not None}
    count = lambda t: sum(len(grams(x)) >= 6 for x in (t or "").split("\n"))
    assert {i: r.n_paragraphs for i, r in of.items()} == {i: sum(count(t) for j, t in rows if j == i) for i in of}
    assert of[4].n_repeated == 0 and of[4].repeated == "" and 4 in of[4].classes
    assert "line 1" in of[9].repeated.split(",") and 4 in of[9].classes and "line 0" in of[5].repeated.split(",") and 4 in of[5].classes
    assert of[7].n_repeated == 0 and of[8].n_repeated == 1 and list(of[7].classes) == list(of[8].classes) == [7]
    assert all(not of[i].classes and not of[i].n_repeated for i in (3, 6))
    # the repeated row repeats its own pieces too, and no document with an id holds all of those
    nulls = sorted((r.n_paragraphs, r.n_repeated > 0, 4 in r.classes) for r in got if r.doc_id is None)
    assert nulls == [(0, False, False), (1, False, False), (2, True, True)]


def test_nearest(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=16).astype(np.float32)]) for i in range(300)]
    rows += [(400 + i, rows[7][1]) for i in range(30)] + [rows[20], (500, None), (520, [0.0] * 16), (540, [math.nan] + [1.0] * 15), (560, [None] + [1.0] * 15),
             (580, [math.inf] * 16), (600, [1.0] * 3), (None, [1.0] * 16), (-20, rows[3][1])]
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], "vec_id long, embedding array<float>, id string, score string")
    usable = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    brute = []
    for q, x in usable:
        if q % 20 == 0:
            scored = []
            for c, y in usable:
                if c != q and len(x) == len(y):
                    total = 0.0
                    for a, b in zip(x, y, strict=True):
                        total += a * b
                    scored.append((-total, c))
            brute += [(q, k + 1, c, -s) for k, (s, c) in enumerate(sorted(scored)[:20])]
    got = [tuple(r) for r in ann.nearest(df).collect()]
    assert sorted(got) == sorted(brute)
    assert ann.nearest(df.limit(0)).collect() == []
