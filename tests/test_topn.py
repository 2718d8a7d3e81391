from flowstat.operators import topn
from flowstat.plans import tables

from .conftest import SF0001, at, rows


def test_ties_by_key_and_report(spark):
    df = spark.createDataFrame([(at(300), 7, 2), (at(300), 3, 2), (at(300), 5, 9), (at(600), 1, 1)],
                               "window_end timestamp_ntz, item_id long, cnt long")
    ranked = topn.top_n(df, "window_end", "item_id", "cnt", 2)
    assert rows(ranked, "window_end", "rn", "item_id") == [(at(300), 1, 5), (at(300), 2, 3), (at(600), 1, 1)]
    rep = dict(rows(topn.report(ranked, "window_end", "item_id", "cnt", "rn"), "window_end", "report"))
    assert rep[at(300)] == "window_end=2024-01-01 00:05:00 | 1: item_id=5 cnt=9 | 2: item_id=3 cnt=2"


def test_ranking_changelog(spark):
    df = spark.createDataFrame([(at(300), 1, 1), (at(600), 1, 1), (at(600), 2, 2)],
                               "window_end timestamp_ntz, item_id long, rn int")
    out = rows(topn.ranking_changelog(df, "window_end", "item_id", 300_000_000), "window_end", "item_id", "rn", "op")
    assert out == [(at(300), 1, 1, "+"), (at(600), 2, 2, "+"), (at(900), 1, 1, "-"), (at(900), 2, 2, "-")]


def test_marketing_flags(spark):
    from flowstat.plans import catalog
    mk = tables.market_behavior(spark, SF0001)
    written = catalog.marketing_counts(mk, as_written=True)
    aimed = catalog.marketing_counts(mk, as_written=False)
    assert written.where("behavior = 'error'").count() > 0
    assert aimed.where("behavior = 'error'").count() == 0
    assert set(r[0] for r in mk.select("channel").distinct().collect()) <= set(tables.CHANNELS)
