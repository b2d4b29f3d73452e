"""Sessionization and paths vs a brute-force pandas computation.

A tiny time bucket forces sessions and paths across bucket edges, which
is where the skew-safe windowing carries state."""

import datetime as dt
import random

import pandas as pd

from portal_metrics.operators import journeys as J


def _events(n=400, users=4, seed=7):
    rnd = random.Random(seed)
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        u = rnd.randrange(users) if rnd.random() > 0.5 else 0      # user 0 is hot
        rows.append((i, u, t0 + dt.timedelta(minutes=rnd.randrange(0, 3000)), str(rnd.randrange(5))))
    return rows


def _brute(rows, gap=30):
    df = pd.DataFrame(rows, columns=["event_id", "user_id", "ts", "page"]).sort_values(["user_id", "ts", "event_id"])
    out = []
    for u, g in df.groupby("user_id"):
        s, prev = 0, None
        for r in g.itertuples():
            if prev is None or (r.ts - prev).total_seconds() > gap * 60:
                s += 1
            prev = r.ts
            out.append((r.event_id, u, s, r.page))
    return pd.DataFrame(out, columns=["event_id", "user_id", "session_no", "page"])


def test_sessions_and_paths_match_brute_force(spark):
    rows = _events()
    ev = spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp, page string")
    sess = J.sessionize(ev, gap_minutes=30, bucket_seconds=600)
    got = {r["event_id"]: r["session_no"] for r in sess.select("event_id", "session_no").collect()}
    b = _brute(rows)
    assert got == dict(zip(b.event_id, b.session_no))

    for length in (2, 3, 4):
        p = J.paths(sess, length).collect()
        exp = []
        for (u, s), g in b.sort_values("event_id").merge(
                pd.DataFrame(rows, columns=["event_id", "user_id", "ts", "page"])[["event_id", "ts"]], on="event_id"
        ).sort_values(["user_id", "ts", "event_id"]).groupby(["user_id", "session_no"]):
            pages = list(g.page)
            exp += [tuple(pages[i:i + length]) for i in range(len(pages) - length + 1)]
        assert sorted(tuple(r[2:]) for r in p) == sorted(exp)


def test_depth_counts(spark):
    rows = _events(120, 3, 1)
    ev = spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp, page string")
    sess = J.sessionize(ev, bucket_seconds=900)
    d = {r["depth"]: r["sessions"] for r in J.session_depth(sess).collect()}
    b = _brute(rows).groupby(["user_id", "session_no"]).size().value_counts().to_dict()
    assert d == b


def test_a_users_hot_hour_is_sliced(spark):
    """A third of all events are one user's in one hour, many at one time: same sessions, spread buckets."""
    rnd = random.Random(3)
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, rnd.randrange(1, 9), t0 + dt.timedelta(minutes=rnd.randrange(0, 3000)), str(rnd.randrange(5))) for i in range(600)]
    rows += [(1000 + i, 0, t0 + dt.timedelta(milliseconds=rnd.randrange(0, 3_600_000)), str(rnd.randrange(5))) for i in range(280)]
    rows += [(2000 + i, 0, t0 + dt.timedelta(minutes=7), str(rnd.randrange(5))) for i in range(20)]
    ev = spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp, page string").repartition(4)
    for gap in (30, 1):
        sess = J.sessionize(ev, gap_minutes=gap, hot_rows=50)
        b = _brute(rows, gap)
        assert {r["event_id"]: r["session_no"] for r in sess.select("event_id", "session_no").collect()} == dict(zip(b.event_id, b.session_no))
        largest = sess.where("user_id = 0").groupBy("_bucket").count().agg({"count": "max"}).first()[0]
        assert largest <= 24 and sess.where("user_id > 0 AND _bucket.slice > 0").count() == 0
        plain = J.sessionize(ev, gap_minutes=gap, hot_rows=10 ** 9)
        for length in (2, 4):
            got, want = (sorted(map(tuple, J.paths(s, length).collect())) for s in (sess, plain))
            assert got == want
