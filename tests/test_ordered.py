import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from flowstat.operators.ordered import neighbour, running_total
from flowstat.plans import tables

from .conftest import SF0001, rows


@pytest.fixture(autouse=True, params=[50, 1 << 20], ids=["heavy keys", "light keys"])
def heavy_rows(request, monkeypatch):
    """Both ways: keys of more than 50 rows are split, or none is."""
    monkeypatch.setattr("flowstat.operators.ordered.HEAVY_ROWS", request.param)


def _ev(spark):
    return tables.table(spark, SF0001, "events").select("event_id", "user_id", "value", "ts")


def test_running_total_chunks_exact(spark):
    ev = _ev(spark)
    w = Window.partitionBy("user_id").orderBy("event_id")
    ref = rows(ev.withColumn("r", F.sum("value").over(w.rowsBetween(Window.unboundedPreceding, 0))), "event_id", "r")
    for chunk in (7, 100, 1 << 30):
        got = running_total(ev, "user_id", "event_id", "value", "r", chunk_col="event_id", chunk=chunk)
        assert [(a, round(b, 6)) for a, b in rows(got, "event_id", "r")] == [(a, round(b, 6)) for a, b in ref]


def test_running_max_exclusive_global(spark):
    ev = _ev(spark)
    w = Window.orderBy("event_id").rowsBetween(Window.unboundedPreceding, -1)
    ref = rows(ev.withColumn("m", F.max("value").over(w)), "event_id", "m")
    got = running_total(ev, [], "event_id", "value", "m", chunk_col="event_id", chunk=13, agg="max", exclusive=True)
    assert rows(got, "event_id", "m") == ref


def test_suffix_min(spark):
    ev = _ev(spark)
    w = Window.partitionBy("user_id").orderBy(F.col("event_id").desc()).rowsBetween(Window.unboundedPreceding, -1)
    ref = rows(ev.withColumn("m", F.min("value").over(w)), "event_id", "m")
    got = running_total(ev, "user_id", "event_id", "value", "m", chunk_col="event_id", chunk=11, agg="min",
                        exclusive=True, descending=True)
    assert rows(got, "event_id", "m") == ref


def test_neighbour_lag_lead(spark):
    ev = _ev(spark)
    w = Window.partitionBy("user_id").orderBy("event_id")
    ref_lag = rows(ev.withColumn("p", F.lag("value").over(w)), "event_id", "p")
    ref_lead = rows(ev.withColumn("p", F.lead("value").over(w)), "event_id", "p")
    got_lag = neighbour(ev, "user_id", "event_id", ["value"], chunk_col="event_id", chunk=5, prefix="p_")
    got_lead = neighbour(ev, "user_id", "event_id", ["value"], chunk_col="event_id", chunk=5, prefix="p_",
                         direction="lead")
    assert rows(got_lag, "event_id", "p_value") == ref_lag
    assert rows(got_lead, "event_id", "p_value") == ref_lead


def test_sessionize_matches_lag_cumsum(spark):
    from flowstat.operators.ordered import sessionize
    ev = _ev(spark).withColumn("t", F.unix_micros(F.col("ts").cast("timestamp")))
    gap = 6 * 3600 * 1_000_000

    def starts(prev, cur):
        return prev["t"].isNull() | (cur["t"] - prev["t"] > gap)

    w = Window.partitionBy("user_id").orderBy("t", "event_id")
    ref = (ev.withColumn("p", F.lag("t").over(w))
             .withColumn("s", (F.col("p").isNull() | (F.col("t") - F.col("p") > gap)).cast("long"))
             .withColumn("session", F.sum("s").over(w.rowsBetween(Window.unboundedPreceding, 0))))
    want = rows(ref, "event_id", "session")
    for chunk in (3600 * 1_000_000, 1 << 60):
        got = sessionize(ev, "user_id", ["t", "event_id"], ["t"], starts, chunk_col="t", chunk=chunk)
        assert rows(got, "event_id", "session") == want
