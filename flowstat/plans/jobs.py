"""The behaviour-log jobs, end to end: read a log, apply the operators,
return the outputs (batch) or start labelled streaming queries.

Batch: ``job(spark, paths...)`` returns ``{label: DataFrame}``.
Stream: ``job(spark, paths..., stream=True, sink=...)`` starts one query per
output and returns ``{label: StreamingQuery}``.  ``sink`` is ``"console"``
(prints every row), ``"memory"``, a folder (every row as Parquet, a sub-folder
for each output, a partition for each micro-batch), or callables ``(df,
epoch_id)``: one, or a dictionary of one for each output.

    python -m flowstat.plans.jobs login_fail /data/LoginLog.csv --out /data/result
"""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import duration_us, is_asset
from ..operators import capping, distinct, joins, patterns, topn, windows
from ..operators.late import late_flag, watermark_before
from ..session import written
from ..sources import arrival_order, parse_access_log, read_access_log, read_records
from ..streaming import jobs as sj
from ..streaming import ranking, stateful
from ..streaming.sinks import checkpoint_location, epoch_folder, fan_out_per_batch, print_batch, print_rows, write_stream


def _name(label: str) -> str:
    return label.replace(" ", "_")


def _target(label: str, sink):
    """Where a micro-batch of an output goes: a callable ``(df, epoch_id)``."""
    if isinstance(sink, dict):
        return sink[label]
    if callable(sink):
        return sink
    return print_batch(label) if sink == "console" else epoch_folder(f"{sink.rstrip('/')}/{_name(label)}")


def _emit(outputs: dict[str, DataFrame], sink, identity: str, mode: str = "append"):
    def start(label, df):
        if sink == "memory":
            return write_stream(df, _name(label), fmt="memory", mode=mode)
        return write_stream(df, _name(label), mode=mode, foreach_batch=_target(label, sink), identity=identity)
    return {label: start(label, df) for label, df in outputs.items()}


def _emit_split(tagged: DataFrame, label: str, channel: str, outputs: dict, sink, identity: str):
    """One query for a tagged stream; its channels (value -> label) go to sinks of their own."""
    if sink == "memory":
        return {label: write_stream(tagged, _name(label), fmt="memory")}
    split = fan_out_per_batch(channel, {value: _target(name, sink) for value, name in outputs.items()})
    return {label: write_stream(tagged, _name(label), foreach_batch=split, identity=identity)}


def _emit_ranked(counts: DataFrame, label: str, key: str, n: int, sink, identity: str, mode: str = "update"):
    """Rank each micro-batch of window counts (top-n per window end) and hand it to
    ``sink`` (``"memory"`` keeps the counts themselves)."""
    if sink == "memory":
        return {label: write_stream(counts, _name(label), fmt="memory", mode=mode)}
    cb = sj.top_n_per_batch("window_end", key, n, _target(label, sink))
    return {label: write_stream(counts, _name(label), mode=mode, foreach_batch=cb, identity=identity)}


def _emit_running(firsts: DataFrame, label: str, sink, identity: str):
    """The running distinct count of each micro-batch (``"memory"`` keeps the first sightings)."""
    if sink == "memory":
        return {label: write_stream(firsts, _name(label), fmt="memory")}
    state = checkpoint_location(firsts.sparkSession, _name(label), identity) + "/totals"
    cb = sj.running_distinct_per_batch("seq", state, _target(label, sink))
    return {label: write_stream(firsts, _name(label), foreach_batch=cb, identity=identity)}


def _arrival(df: DataFrame) -> str:
    """The column by which the rows of a key are in the order of their arrival."""
    return "arrival" if "arrival" in df.columns else "seq"


def _seq(df: DataFrame, stream: bool) -> DataFrame:
    # a number for rules in event time, where it decides between rows of one time only
    return df.withColumn("seq", F.unix_micros("ts")) if stream and "seq" not in df.columns else df


def hot_items(spark: SparkSession, path: str, n: int = 5, size="1 hour", slide="5 minutes",
              stream: bool = False, sink: str = "console"):
    """Top-n viewed items per sliding window, with its text report."""
    ub, pv = read_records(spark, path, "user_behavior", stream=stream), F.col("behavior") == "pv"
    if stream:
        # a window's counts come out together when it closes; the batch ranking keeps n rows per task
        counts = sj.sliding_count_stream(ub, "ts", "item_id", size, slide, where=pv)
        return _emit_ranked(counts, "hot items", "item_id", n, sink, f"{path} {size} {slide} {n}", mode="append")
    counts = windows.sliding_count(ub.where(pv), "ts", "item_id", size, slide)
    ranked = topn.top_n(counts, "window_end", "item_id", "cnt", n)
    return {"hot items": ranked, "report": topn.report(ranked, "window_end", "item_id")}


def hot_items_sql(spark: SparkSession, path: str, n: int = 5, stream: bool = False, sink="console"):
    """Hourly item views and the top-n per hour, in SQL over named views.
    On a stream (e.g. ``kafka://servers/hotitems``) the hourly counts are
    the SQL aggregate over a watermarked view (update mode) and the output is
    the retract stream of the top-n per hour: +/- rows as items enter and
    leave it (``row_number`` is not allowed on a stream)."""
    ub = read_records(spark, path, "user_behavior", stream=stream)
    if stream:
        sj.with_event_time(ub, "ts").select("item_id", "behavior", "ts").createOrReplaceTempView("data_table")
        # the condition names the event time, so it stays above the watermark
        counts = spark.sql(hourly_items_sql("data_table", "if(ts IS NOT NULL, behavior = 'pv', false)"))
        label, identity = "hot items sql", f"{path} {n}"
        state = checkpoint_location(spark, _name(label), identity) + "/topn_state"
        cb = sj.top_n_retract_per_batch("window_end", "item_id", n, state, _target(label, sink))
        return {label: write_stream(counts, _name(label), mode="update", foreach_batch=cb, identity=identity)}
    ub.select("item_id", "behavior", "ts").createOrReplaceTempView("data_table")
    counts = spark.sql(hourly_items_sql("data_table", "behavior = 'pv'"))
    counts.createOrReplaceTempView("agg")
    return {"counts": counts, "top": spark.sql(top_items_sql("agg", n))}


def hourly_items_sql(view: str, condition: str) -> str:
    """Views per item and hour of the rows that satisfy ``condition``."""
    return (f"SELECT item_id, window.end AS window_end, count(item_id) AS cnt FROM {view} "
            f"WHERE {condition} GROUP BY item_id, window(ts, '1 hour')")


def top_items_sql(view: str, n: int) -> str:
    """The first ``n`` items of each hour by count, then id."""
    ranked = f"SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, item_id) AS row_num FROM {view}"
    return f"SELECT * FROM ({ranked}) WHERE row_num <= {int(n)}"


def hot_pages(spark: SparkSession, path: str, n: int = 5, size="10 minutes", slide="5 seconds",
              lateness="1 minute", disorder="1 second", stream: bool = False, sink: str = "console"):
    """Top-n GET urls (static assets dropped) per sliding window; late rows
    go to a side output."""
    log = read_access_log(spark, path, stream=stream)
    wanted = (F.col("method") == "GET") & ~is_asset("url")
    if stream:
        # delay = disorder + allowed lateness; a window's ranking comes out whenever it changes, from the
        # latest counts of all its urls, until the watermark drops the window
        identity = f"{path} {size} {slide} {n} {lateness} {disorder}"
        pages = ranking.top_n_updates_stream(log, "ts", "url", size, slide, n, where=wanted,
                                             delay=f"{_secs(disorder) + _secs(lateness)} seconds")
        flagged = stateful.split_late_stream(log, "ts", size, slide, lateness, disorder)
        late = flagged.where(F.col("late") & wanted).drop("late", "spread_key", "t_us")
        return _emit({"hot pages": pages, "late": late}, sink, identity)
    # arrival order of a log is the order of its files and lines; every request moves the
    # watermark, GETs are counted in the windows still open on their arrival
    lines = arrival_order(spark.read.text(path))
    log = written(parse_access_log(lines, keep=["seq"]), "access-log")
    # read by both outputs
    gets = written(watermark_before(log, "ts", "seq", "seq", disorder).where(wanted), "seen-gets")
    late_rows = gets.where(late_flag(gets, "ts", "watermark", size, slide, lateness))
    counts = windows.sliding_count_open(gets, "ts", "url", size, slide, "watermark", lateness)
    return {"hot pages": topn.top_n(counts, "window_end", "url", "cnt", n), "late": late_rows}


def _secs(d) -> int:
    return duration_us(d) // 1_000_000


def page_views(spark: SparkSession, path: str, stream: bool = False, sink: str = "console"):
    """Hourly page views (plain and two-stage salted)."""
    ub, pv = read_records(spark, path, "user_behavior", stream=stream), F.col("behavior") == "pv"
    if stream:
        ev = sj.after_watermark(sj.with_event_time(ub, "ts"), "ts", pv)
        return _emit({"pv": windows.tumbling_count(ev, "ts", None, "1 hour", out="pv"),
                      "pv salted": windows.salted_count(ev, "ts", "1 hour", "user_id", 10, out="pv")}, sink, path)
    ub = ub.where(pv)
    return {"pv": windows.tumbling_count(ub, "ts", None, "1 hour", out="pv"),
            "pv salted": windows.salted_count(ub, "ts", "1 hour", "user_id", 10, out="pv")}


def unique_visitors(spark: SparkSession, path: str, stream: bool = False, sink: str = "console"):
    """Hourly unique visitors: exact, bitmap, approximate, and per event."""
    ub, pv = read_records(spark, path, "user_behavior", stream=stream), F.col("behavior") == "pv"
    if stream:
        firsts = stateful.first_sightings_stream(_seq(ub, True), "ts", "seq", "user_id", "1 hour", where=pv)
        return (_emit({"uv": sj.uv_stream(ub, "ts", "user_id", "1 hour", where=pv)}, sink, path)
                | _emit_running(firsts, "uv running", sink, path))
    ub = ub.where(pv)
    return {"uv": distinct.distinct_per_window(ub, "ts", "user_id", "1 hour", "exact"),
            "uv bitmap": distinct.distinct_per_window(ub, "ts", "user_id", "1 hour", "bitmap"),
            "uv approx": distinct.distinct_per_window(ub, "ts", "user_id", "1 hour", "approx"),
            "uv running": distinct.running_distinct(ub, "ts", "seq", "user_id", "1 hour")}


def marketing(spark: SparkSession, path: str, size="1 hour", slide="5 seconds", as_written: bool = True,
              stream: bool = False, sink: str = "console"):
    """Counts per (channel, behaviour) and the uninstall total per window."""
    mk = read_records(spark, path, "market", stream=stream)
    gone = F.col("behavior") == "UNINSTALL"
    counted: Column | None = None if as_written else ~gone
    if stream:
        return _emit({"channel": sj.sliding_count_stream(mk, "ts", ["channel", "behavior"], size, slide, where=counted),
                      "total": sj.sliding_count_stream(mk, "ts", None, size, slide, where=gone)},
                     sink, f"{path} {size} {slide} {as_written}")
    by_channel, total = mk if as_written else mk.where(counted), mk.where(gone)
    t = windows.sliding_count(total, "ts", None, size, slide)
    return {"channel": windows.sliding_count(by_channel, "ts", ["channel", "behavior"], size, slide),
            "total": t.select(F.concat_ws(",", F.date_format("window_end", "yyyy-MM-dd HH:mm:ss.S"),
                                          F.col("cnt").cast("string")).alias("line"))}


def ad_clicks(spark: SparkSession, path: str, limit: int = 100, zone: str = "Asia/Shanghai",
              size="1 hour", slide="5 seconds", stream: bool = False, sink: str = "console"):
    """Click cap with blacklist side output, and clicks (all of them) per province."""
    ads = _seq(read_records(spark, path, "ad_click", stream=stream), stream)
    if stream:
        tagged = stateful.cap_and_flag_stream(ads, ["user_id", "ad_id"], "ts", _arrival(ads), limit, zone)
        identity = f"{path} {limit} {zone} {size} {slide}"
        return (_emit_split(tagged, "ad clicks", "channel", {"passed": "passed", "blacklist": "black list"}, sink, identity)
                | _emit({"province": sj.sliding_count_stream(ads, "ts", "province", size, slide)}, sink, identity))
    passed, warned = capping.cap_and_flag(ads, ["user_id", "ad_id"], "ts", "seq", limit, zone)
    return {"passed": passed, "black list": warned,
            "province": windows.sliding_count(ads, "ts", "province", size, slide)}


def login_fail(spark: SparkSession, path: str, bound="2 seconds", stream: bool = False, sink: str = "console"):
    """Consecutive failures (arrival order), the strict sequence (event
    time) and the timer-based burst."""
    lg = _seq(read_records(spark, path, "login", stream=stream), stream)
    fail = F.col("event_type") == "fail"
    if stream:
        return _emit({"consecutive": stateful.consecutive_stream(lg, "user_id", fail, "ts", _arrival(lg), bound),
                      "sequence": stateful.match_next_stream(lg, "user_id", fail, fail, "ts", "seq", bound),
                      "burst": stateful.burst_stream(lg, "user_id", fail, ~fail, "ts", "seq", bound)},
                     sink, f"{path} {bound}")
    return {"consecutive": patterns.consecutive(lg, "user_id", fail, "ts", "seq", bound),
            "sequence": patterns.match_next(lg, "user_id", fail, fail, "ts", "seq", bound),
            "burst": patterns.burst(lg, "user_id", fail, ~fail, "ts", "seq", bound)}


def order_timeout(spark: SparkSession, path: str, within="15 minutes", stream: bool = False,
                  sink: str = "console"):
    """Create followed by pay within the bound (paid / timeout side output)
    and the state-based order status."""
    od = _seq(read_records(spark, path, "order", stream=stream), stream)
    c, p = F.col("event_type") == "create", F.col("event_type") == "pay"
    if stream:
        identity = f"{path} {within}"
        tagged = stateful.followed_by_stream(od, "order_id", c, p, "ts", "seq", within)
        return (_emit_split(tagged, "orders", "kind", {"matched": "payed", "timeout": "order timeout"}, sink, identity)
                | _emit({"status": stateful.pair_status_stream(od, "order_id", c, p, "ts", within)}, sink, identity))
    paid, timeout = patterns.followed_by(od, "order_id", c, p, "ts", "seq", within)
    return {"payed": paid, "order timeout": timeout,
            "status": patterns.pair_status(od, "order_id", c, p, "ts", within)}


def tx_match(spark: SparkSession, orders: str, receipts: str, lower="-3 seconds", upper="5 seconds",
             stream: bool = False, sink: str = "console"):
    """Payment-receipt reconciliation: matched pairs and both unmatched sides.
    A record is named by its place in the log; transaction ids may repeat or be null."""
    od, paid = read_records(spark, orders, "order", stream=stream), F.col("event_type") == "pay"
    rc = read_records(spark, receipts, "receipt", stream=stream)
    if stream:
        joined = sj.interval_join_stream(od.select("tx_id", "order_id", "event_type", F.col("ts").alias("pay_ts")),
                                         rc.select("tx_id", "pay_channel", F.col("ts").alias("receipt_ts")), "tx_id",
                                         "pay_ts", "receipt_ts", lower, upper, "full_outer", left_where=paid).drop("event_type")
        side = (F.when(F.col("receipt_ts").isNull(), "pay").when(F.col("pay_ts").isNull(), "receipt").otherwise("matched"))
        outputs = {"matched": "matched", "pay": "unmatched pays", "receipt": "unmatched receipts"}
        return _emit_split(joined.withColumn("side", side), "transactions", "side", outputs, sink, f"{orders} {receipts} {lower} {upper}")
    pays = od.where(paid).select("tx_id", "order_id", F.col("ts").alias("pay_ts"), F.col("seq").alias("pay_key"))
    recs = rc.select("tx_id", "pay_channel", F.col("ts").alias("receipt_ts"), F.col("seq").alias("receipt_key"))
    m, lu, ru = joins.interval_match(pays, recs, "tx_id", "pay_ts", "receipt_ts", "pay_key", "receipt_key", lower, upper)
    return {"matched": m.drop("pay_key", "receipt_key"), "unmatched pays": lu.drop("pay_key"),
            "unmatched receipts": ru.drop("receipt_key")}


JOBS = {"hot_items": hot_items, "hot_items_sql": hot_items_sql, "hot_pages": hot_pages, "page_views": page_views,
        "unique_visitors": unique_visitors, "marketing": marketing, "ad_clicks": ad_clicks,
        "login_fail": login_fail, "order_timeout": order_timeout, "tx_match": tx_match}


def main(argv: list[str]) -> None:
    """``job path [path2] [--stream] [--out folder] [--preview n]``.

    With ``--out`` every row of each output is written there as Parquet; without
    it every row is printed, or with ``--preview n`` the first n rows of each
    output.  With ``--stream`` the job's queries run until stopped (paths may then
    be folders, ``socket://host:port`` or ``kafka://servers/topic``)."""
    from ..session import get_session
    args, out, preview, stream = list(argv), None, None, "--stream" in argv
    if stream:
        args.remove("--stream")
    for flag in ("--out", "--preview"):
        if flag in args:
            i = args.index(flag)
            value = args.pop(i + 1)
            args.pop(i)
            out, preview = (value, preview) if flag == "--out" else (out, int(value))
    if not args or args[0] not in JOBS:
        print("usage: python -m flowstat.plans.jobs {" + ",".join(JOBS) + "} path [path2] [--stream] [--out folder] [--preview n]")
        raise SystemExit(2)
    spark = get_session()
    if stream:
        JOBS[args[0]](spark, *args[1:], stream=True, sink=out or "console")
        spark.streams.awaitAnyTermination()
        return
    for label, df in JOBS[args[0]](spark, *args[1:]).items():
        if out:
            df.write.mode("overwrite").parquet(f"{out.rstrip('/')}/{_name(label)}")
        else:
            print(f"== {label}\n{' | '.join(df.columns)}")
            print_rows(df, preview)


if __name__ == "__main__":
    main(sys.argv[1:])
