from portal_metrics.operators.quality import duplicate_keys, key_stats, orphans, unmatched_visitors, validate
from portal_metrics.schemas import FACT_KEY
from tests.fixtures import fixture_model


def test_fixture_quality(spark):
    m = fixture_model(spark)
    d = duplicate_keys(m.fact, FACT_KEY).collect()
    assert len(d) == 1 and d[0]["cnt"] == 2
    ks = key_stats(m.fact, FACT_KEY).first()
    assert (ks["unique_keys"], ks["total_rows"], ks["duplicate_key_groups"]) == (6, 7, 1)
    o = orphans(m.fact, m.page_inventory, "marketingpageid").first()
    assert (o["orphaned_keys"], o["orphaned_rows"]) == (1, 1)
    u = unmatched_visitors(m.fact, m.employee_contact).first()
    assert (u["unmatched_visitors"], u["unmatched_rows"]) == (1, 1)
    rep = validate(m)
    assert not rep.valid and rep.fact_duplicate_groups == 1
    assert any("duplicate composite keys" in x for x in rep.lines())


def test_duplicate_page_key_fans_out(spark):
    from tests.fixtures import PAGE_ROWS
    from portal_metrics.plans.reports import summary
    m = fixture_model(spark, pages=PAGE_ROWS + [PAGE_ROWS[0]])
    assert duplicate_keys(m.page_inventory, ["marketingpageid"]).first()["cnt"] == 2
    base = summary(fixture_model(spark)).first()["total_views"]
    assert summary(m).first()["total_views"] > base        # M8: joins are not deduped silently
