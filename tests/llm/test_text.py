"""Operators 3, 5, 6, 7 and 8, and the pipeline, against brute force, round trips and held-out accuracy."""
import hashlib
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from portal_metrics.llm import bpe, pii, queries, secrets, toxicity, urls
from conftest_llm import frame

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.read_ranks(PATH), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_bpe_is_the_library(encoder, library, text):
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode_ordinary(text)


def test_bpe_long_pieces(encoder, library):
    for text in ("ab" * 20_000, " " * 5000 + "x", "日本" * 3000):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode_ordinary(text)


def test_bpe_round_trip(spark, docs, texts, empty, library):
    ranks = bpe.broadcast_ranks(spark, PATH)
    got = bpe.decode(bpe.encode(docs, ranks), ranks).collect()
    key = lambda x: (x[0], x[1])
    assert sorted(((r.doc_id, bytes(r.decoded)) for r in got), key=key) == sorted(((i, (t or "").encode()) for i, t in texts), key=key)
    assert {(r.doc_id, bytes(r.ids)) for r in got} == {(i, np.array(library.encode_ordinary(t or ""), "<u4").tobytes()) for i, t in texts}
    assert bpe.encode(empty, ranks).collect() == []


PII = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
       "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(int(c) if i % 2 == 0 else (2 * int(c) - 9 * (int(c) > 4)) for i, c in enumerate(reversed(d))) % 10 == 0


def pii_brute(t):
    out = []
    for k, p in PII.items():
        for m in re.finditer(p, t or ""):
            d = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if k == "ip" else 0, "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[k]:
                out.append((m.start(), list(PII).index(k), m.end(), k))
    return sorted(out)


TRICKY = ["a@b.c%d@e.f x@y x@y.z.", "1.2.3.4.5 001.02.3.4 256.1.1.1 1.2.3", "4111 1111 1111 1111 and 4111-1111-1111-1112 4111111111111111",
          "+1 (555) 010-9999, +12 345 +49 (0) 30 123456-", "é👍 a.b@c-d.org 10.0.0.1é", "a@" + "b." * 3000 + "c", "9" * 5000, "x" * 20_000 + "@", "1 2 3 4 5 6 7 8 9 0 1 2 3"]


def test_pii_base(spark, texts, empty):
    rows = [*texts, *((100 + i, t) for i, t in enumerate(TRICKY))]
    got = pii.find_pii(frame(spark, rows)).collect()
    key = lambda x: (x[0], str(x[1]))
    assert sorted(((r.doc_id, [tuple(s) for s in r.base]) for r in got), key=key) == sorted(((i, pii_brute(t)) for i, t in rows), key=key)
    assert pii.find_pii(empty).collect() == []


def test_pii_discovers_in_context(spark):
    rows = [(i, f"Some words here, reach me at user{i}@mail.example.com today") for i in range(8)]
    rows += [(50, "and please reach me at handle-77x41 then"), (51, "the code handle-77x41 again"), (52, "meet at room12345 there")]
    df = frame(spark, rows)
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in pii.find_pii(df).collect()}
    assert got[50] == [("id", 23, 35)] and got[51] == [("id", 9, 21)] and got[52] == [] and got[3][0][0] == "email"
    masked = {r.doc_id: r for r in pii.masked(df).collect()}
    assert masked[50].text == "and please reach me at [ID] then" and masked[50].n_chars == len(masked[50].text)
    assert masked[3].text == "Some words here, reach me at [EMAIL] today" and pii.masked(df).columns == df.columns


def pii_words_before(text, start):
    """The two whole words before the word that holds the position."""
    words = [w for w in re.finditer(r"[^ \t\n\x0b\f\r]+", text) if w.end() <= start]
    return tuple(w.group().lower() for w in words[-2:]) if len(words) > 1 else None


def test_pii_words_before_cross_matches_and_blanks(spark):
    texts = ["My passport number:\nAB123456", "  2024-05-01 account AB123456\tname a@b.c d@e.f X1234567", "to<a@b.c>,<d@e.f> X1234567 of\r\n Y7654321",
             "one " * 40 + "w" * 90 + " " + "v" * 90 + "\tZ1234567", "AB123456 CD123456 EF123456", "\n\tAB123456 +44 20 7946 0958 is CD123456"]
    rows = pii.base_spans(frame(spark, list(enumerate(texts))), "doc_id", "text").collect()
    assert sum(len(r.base) + len(r.tokens) for r in rows) == 17
    for r in rows:
        for s in [*r.base, *r.tokens]:
            got = (s.before.w1, s.before.w2) if s.before.w1 else None
            assert got == pii_words_before(texts[r._id], s.start), (texts[r._id], s)


def test_pii_discovers_in_lines_and_records(spark):
    rows = [(i, f"Passport holder:\nuser{i}@mail.example.com") for i in range(8)] + [(50, "passport holder:\tAB123456")]
    rows += [(60 + i, f"2024-05-01 account user{i}@mail.example.com") for i in range(8)] + [(70, "2024-05-01 account CD123456")]
    got = {r.doc_id: [(s.kind, s.start) for s in r.spans] for r in pii.find_pii(frame(spark, rows)).collect()}
    assert got[50] == [("id", 17)] and got[70] == [("id", 19)]


@pytest.mark.parametrize("small", [8 << 20, 0])
def test_pii_bootstrap_goes_on_until_nothing_is_new(spark, small):
    """Each context's values are only known through the one before it; the first holds the base seeds, frequent contexts fail."""
    rows = [f"reach me at user{i}@mail.example.com" for i in range(20)]
    for g, context in enumerate(("reach me at", "badge no", "file ref", "case id")):
        rows += [f"{context} gen{g}-{i}xyz" for i in range(3)] + [f"{context} gen{g - 1}-{i}xyz" for i in range(3) for _ in range(12) if g]
    rows += [f"one of the x{i}@mail.example.com of the day" for i in range(60)] + [f"out of the room{i}00" for i in range(60)]
    got = pii.find_pii(frame(spark, list(enumerate(rows))), small=small).collect()
    ids = {rows[r.doc_id][s.start:s.end] for r in got for s in r.spans if s.kind == "id"}
    assert ids == {f"gen{g}-{i}xyz" for g in range(4) for i in range(3)}


@pytest.mark.parametrize("first,growth", [(2, 4), (1, 2), (4096, 4)])
def test_pii_samples_lose_no_pattern(spark, monkeypatch, first, growth):
    """The same values are found whatever the samples, and a pattern whose fillers are mostly unknown is dropped on the way."""
    monkeypatch.setattr(pii, "FIRST", first)
    monkeypatch.setattr(pii, "GROWTH", growth)
    rows = [f"write to u{i}@mail.example.com now" for i in range(30)] + ["write to agent-77 now", "old agent-77 left"]
    rows += [f"out of m{i}@mail.example.com" for i in range(5)] + [f"out of the{i % 9} way" for i in range(200)] + ["out of gate-1234 now"]
    got = pii.find_pii(frame(spark, list(enumerate(rows)))).collect()
    assert {rows[r.doc_id][s.start:s.end] for r in got for s in r.spans if s.kind == "id"} == {"agent-77"}


def test_pii_slots_of_samples_are_lower_bounds(spark):
    texts = spark.createDataFrame([("a b c " * (i % 5 + 1),) for i in range(60)], "text string")
    due = spark.createDataFrame([("a", "b", 170), ("b", "c", 10), ("x", "y", 3)], "w1 string, w2 string, most long")
    got = {(r.w1, r.w2): r.slots for r in pii._counted([texts.limit(10), texts], due, 0.8, 1 << 20).collect()}
    assert set(got) == {("a", "b"), ("x", "y")} and got["x", "y"] == 0


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(st.integers(0, 50), max_size=40), min_size=1, max_size=8))
def test_pii_sums_before(spark, rows):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, v array<long>")
    got = df.select("i", pii._sum_before(F.col("v")).alias("s"), pii._before(F.col("v"), lambda a, x: F.greatest(a, x), F.lit(0).cast("long")).alias("m")).collect()
    for r in got:
        v = rows[r.i]
        assert r.s == [sum(v[:k]) for k in range(len(v))] and r.m == [max([0, *v[:k]]) for k in range(len(v))]


def test_pii_in_a_long_text(spark):
    """Many spans and tokens in one text of over 100,000 words: positions, marks and length."""
    words = [("10.0.0.%d" % (i % 256)) if i % 3 == 0 else (f"id{i}x77" if i % 3 == 1 else "é👍") for i in range(102_000)]
    text = " ".join(words)
    r, = pii.masked(frame(spark, [(1, text)])).collect()
    assert r.text == " ".join("[IP]" if i % 3 == 0 else w for i, w in enumerate(words)) and r.n_chars == len(r.text)
    at, = pii.base_spans(frame(spark, [(1, text)]), "doc_id", "text").select("base", "tokens").collect()
    assert all(text[s.start:s.end] == s.value for s in [*at.base[::997], *at.tokens[::997]]) and len(at.base) == len(at.tokens) == 34_000


def test_pii_keeps_columns_named_like_its_own(spark):
    df = spark.createDataFrame([(1, "a@b.c", "r", "t", "w", "k", "g")], "doc_id long, text string, _row string, _text string, _words string, _k0 string, base string")
    r, = pii.masked(df, length_col=None).collect()
    assert r.text == "[EMAIL]" and (r._row, r._text, r._words, r._k0, r.base) == ("r", "t", "w", "k", "g")
    got, = pii.base_spans(df, "doc_id", "text", keep=("_text", "_words")).select("base").collect()
    assert [s.value for s in got.base] == ["a@b.c"]


def test_pii_plan_is_native(docs):
    plan = pii.find_pii(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


SECRETS = {"assign": r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", "access": r"AKIA[A-Z0-9]+", "hex": r"[0-9a-f]+"}


def secrets_brute(t):
    out = []
    for no, (k, p) in enumerate(SECRETS.items()):
        for m in re.finditer(p, t or "", re.I | re.A if k == "assign" else 0):
            if len(m[2]) >= 12 if k == "assign" else len(m[0]) >= {"access": 18, "hex": 16}[k]:
                out.append((m.start(), no, m.end(), k))
    return sorted(out)


def test_secrets(spark, texts, empty):
    rows = [*texts, (200, 'PassWord = "abc.DEF/123+456" token:short é AKIA' + "A1" * 9), (201, "deadbeef" * 700), (202, "x" + "0f" * 8 + "g" + "0f" * 7),
            (203, "api_key='k" + "9" * 30), (204, "my login: Tr0ub4dor&3xQ! and password is password123 ok"), (205, "0123456789abcde"), (206, "f0123 pwd: qwertyuiop")]
    got = {(r.doc_id, tuple(map(tuple, r.base))): [s.kind for s in r.spans] for r in secrets.scan(frame(spark, rows).repartition(2)).collect()}
    assert set(got) == {(i, tuple(secrets_brute(t))) for i, t in rows}
    assert got[204, ()] == ["value"] and got[206, ()] == []
    assert secrets.scan(empty).collect() == []


def test_secrets_in_prose_are_words_of_the_documents(spark):
    """Plain words after a credential word are no secrets where other documents use them; generated values are."""
    prose = ["The password is important", "My login is necessary", "token: available", "the secret is generosity", "Das Passwort ist da, password: Schlüsselbund"]
    rows = [(i, t) for i, t in enumerate(prose)] + [(20 + i, f"It is important and necessary that generosity is available, der Schlüsselbund too {i}") for i in range(3)]
    made = ["pwd: kT9#vQ2!mZ", "login was Xy7$pLq0wR", "passphrase = hjQWzkvbPmnt", "password is importantX9$kq#2"]
    rows += [(50 + i, t) for i, t in enumerate(made)]
    got = {r.doc_id: [(s.kind, s.start) for s in r.spans] for r in secrets.scan(frame(spark, rows)).collect()}
    assert all(got[i] == [] for i in range(len(prose)))
    assert all([k for k, _ in got[50 + i]] == ["value"] for i in range(len(made)))
    plain = {r.doc_id: len(r.spans) for r in secrets.scan(frame(spark, rows), words=[]).collect()}
    assert plain[0] == plain[1] == 1          # without the documents' words, brute force


def test_learned_words(spark):
    rows = [(1, "Alpha alpha beta"), (2, "alpha, Beta2 gamma"), (3, None), (4, ""), (5, "password: gamma token=delta delta"), (6, "beta it's été"), (7, "été"), (8, "x" * 40), (9, "x" * 40)]
    assert secrets.learned_words(frame(spark, rows)) == ["beta", "alpha", "été"]
    assert secrets.learned_words(frame(spark, rows), kept=1) == ["beta"] and secrets.learned_words(frame(spark, [])) == []


def segments_brute(v):
    """The same program over all segmentations, for short values."""
    low, best = v.lower(), [0.0] + [math.inf] * len(v)
    for j in range(1, len(v) + 1):
        for i in range(j):
            s, costs = v[i:j], [sum(map(secrets._brute, v[i:j]))]
            if low[i:j] in secrets.RANK and len(s) > 1:
                costs.append(secrets.RANK[low[i:j]] + (0 if s == low[i:j] else 0.5))
            best[j] = min(best[j], best[i] + secrets.SEGMENT + min(costs))
    return best[-1]


@pytest.mark.parametrize("v", ["password", "passWordX7", "zebra", "9k!xQ2", "secretdragon"])
def test_guess_cost_is_the_cheapest_cut(v):
    assert secrets.guess_cost(v) == pytest.approx(segments_brute(v))


def test_guess_cost_knows_patterns():
    assert secrets.guess_cost("aaaaaaaaaaaa") < 5 and secrets.guess_cost("qwertyuiop") < 5 and secrets.guess_cost("19841231") < 6
    assert secrets.guess_cost("x9$Kq2!mZr") > 12 and secrets.guess_cost("v" + "1z" * 5000) > 5000


def test_urls(spark):
    rows = [None, "", "no scheme", "http://A.Example.ORG/es/1?q", "x://example.org/en/123#t", "http://org/", "http://org", "http://sub.COM/de/x", "http://a.com/fr/",
            "http://notorg/x", "http://spam-farm.example.net/x", "http://a.spam-farm.example.net", "://h/p", "a://b://c/d", "http://notexample.org/es/"]
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(rows)], "page_id long, url string, verdict string")

    def brute(u):
        host, path = ("", "") if not u or "://" not in u else (re.split("[/?#]", u.split("://", 1)[1])[0].lower(), "")
        if host or (u and "://" in u):
            path = re.split("[?#]", u.split("://", 1)[1][len(host):])[0]
        fits = [(len(h + p), h + p, v) for h, p, v in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        spam = any(host == h or host.endswith("." + h) for h, _ in urls.BLOCKED)
        return (host, path, max(fits)[1] if fits else None, max(fits)[2] if fits else "block" if spam else "allow")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(df).collect()}
    assert got == {i: brute(u) for i, u in enumerate(rows)}
    assert urls.judge(df.limit(0)).collect() == []


def test_urls_in_blocks_and_collisions(spark, monkeypatch):
    monkeypatch.setattr(urls, "BLOCK", 2)
    monkeypatch.setattr(urls, "digests", lambda keys: np.zeros(len(keys), np.uint64))  # every digest collides
    df = spark.createDataFrame([(1, "http://example.org/es/1"), (2, "http://e.com/xx")], "page_id long, url string")
    index = [urls.pack(x) for x in urls._blocks([*urls.RULES])]
    assert len(index) == 3 and df.count() == 2
    import tempfile
    with tempfile.TemporaryDirectory() as folder:
        assert urls.Index(urls.pack([*urls.RULES]), folder).find(["org\t/", "net\t/", "com\t/de/"]) == [(0, "allow"), (2, "block")]


def test_toxicity(spark, docs, empty):
    rows, labels = [], []
    for i in range(400):
        toxic = i % 5 == 0
        rows.append((i, f"word{i} some plain text number{i * 7} goes here. You are a grumblefrog{'a' * (i % 3)} indeed." if toxic else f"word{i} some plain text number{i * 7} goes here. A fine day."))
        labels.append((i, 1, int(toxic)))
    df = frame(spark, rows)
    y = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.fit(df, y)
    got = toxicity.score(df, model).withColumn("held_out", toxicity.held_out()).collect()
    assert all((r.score >= toxicity.THRESHOLD) == (r.doc_id % 5 == 0) for r in got if r.held_out) and {r.held_out for r in got} == {True, False}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    # labels of the held-out fold are never read
    flipped = y.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.fit(df, flipped)
    assert again.arcs == model.arcs and np.allclose(again.coefficients, model.coefficients)
    assert all(0 <= r.score < toxicity.THRESHOLD for r in toxicity.score(docs, model).collect())
    assert toxicity.score(empty, model).collect() == [] and toxicity.fit(empty, y).arcs == {}


def test_toxicity_grammar():
    m = toxicity.Model()
    plain, targeted, negated, reported = (m.paths(t).tolist() for t in ("What an idiot today.", "You utter idiot!", "He is far from here. Not an idiot.", "They said idiot"))
    assert plain[0] and targeted[1] and negated[2] and reported[3]
    assert m.score("You utter idiot!") > m.score("Not an idiot.") > m.score("A fine day.") and m.paths("I will kill you")[1] > 0 == m.paths("kill the lights").sum()


def test_pipeline_rows(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    toxic = {r.doc_id for r in queries.QUERIES["op3_toxicity"](spark, sf).where("predicted = 1").collect()}
    clean = docs.where(~F.col("doc_id").isin(*toxic)) if toxic else docs
    from portal_metrics.llm import decontam, ngram_join
    least = {r.doc_id for r in ngram_join.jaccard_classes(clean).where("doc_id = class_id").collect()}
    leaked = {r.doc_id for r in decontam.find_leaks(docs, spark.read.parquet(f"{sf}/benchmark.parquet")).collect()}
    assert set(got) == least - leaked and len(corpus_pipeline.STAGES) == 5
    text = {r.doc_id: r.text for r in docs.collect()}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})
    for i, r in got.items():
        at, out = 0, ""
        for s, _, e, k in pii_brute(text[i]):
            if s >= at:
                out += text[i][at:s] + f"[{k.upper()}]"
            at = max(at, e)
        out += text[i][at:]
        if "[ID]" not in r.text:
            assert r.text == out
        assert r.n_chars == len(r.text) and np.frombuffer(r.ids, "<u4").tolist() == library.encode_ordinary(r.text)
        assert r.decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest()
