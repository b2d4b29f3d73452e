import shutil

from portal_metrics.sources.store import StarStore
from portal_metrics.streaming.extracts import stream_fact_extracts
from tests.test_merge_store import _fact_csv


def test_stream_merges_each_extract(spark, tmp_path):
    drop = tmp_path / "drop"
    drop.mkdir()
    store = StarStore(spark, str(tmp_path / "store"))
    _fact_csv(str(drop / "a.csv"), [(20251001, 1), (20251002, 1), (20251003, 1)])
    q = stream_fact_extracts(spark, str(drop), store, checkpoint=str(tmp_path / "ck"))
    q.awaitTermination(120)
    assert store.fact().count() == 3
    # second extract covers 01..03 without 02: day 02 vanishes (MRG-2), once per file
    _fact_csv(str(drop / "b.csv"), [(20251001, 5), (20251003, 5)])
    q = stream_fact_extracts(spark, str(drop), store, checkpoint=str(tmp_path / "ck"))
    q.awaitTermination(120)
    got = sorted((r[0], r[1]) for r in store.fact().select("visitdatekey", "views").collect())
    assert got == [(20251001, 5), (20251003, 5)]
