"""Registered queries: one per operator of the inventory, each reading the
whole driver tables, with the equivalent DuckDB SQL as an independent oracle.

Every query is ``fn(spark, sf_dir) -> DataFrame``; computed columns carry the
same names in Spark and in the SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ASSET_PATTERN, duration_us, floor_to, from_micros, is_asset, json_long, to_micros, to_utc_wallclock
from ..operators import aggregate, capping, distinct, joins, late, patterns, topn, windows
from ..session import written
from ..sources import parse_access_log
from . import tables as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn
    return deco


# -------------------------------------------------------------- SQL fragments
def _end(us: int, size_us: int | None = None, step: str = "0") -> str:
    """DuckDB: end of the epoch-aligned window of length ``size`` starting at
    the slide-aligned pane of ``t`` shifted by ``step`` slides."""
    size_us = size_us or us
    return f"make_timestamp((t // {us}) * {us} + ({step}) * {us} + {size_us})"


_ITEM = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
_HASH = ("list_reduce(list_prepend(0::BIGINT, list_transform(string_split(user_id::VARCHAR, ''), "
         "lambda c: ascii(c)::BIGINT)), lambda a, c: (a * 67 + c) & 536870911)")
_VIEWS = f"SELECT {_ITEM} AS item_id, user_id, event_id, epoch_us(ts) AS t FROM events WHERE event_type = 'view'"

H = duration_us("1 hour")
M5 = duration_us("5 minutes")


def _sliding_sql(src: str, keys: str, size_us: int, slide_us: int) -> str:
    ratio = size_us // slide_us
    k = f"{keys}, " if keys else ""
    return (f"SELECT {k}make_timestamp((t // {slide_us}) * {slide_us} + (i + 1) * {slide_us}) AS window_end, "
            f"count(*) AS cnt FROM ({src}) s, range({ratio}) r(i) GROUP BY ALL")


# ================================================================ hot items
def _hot_item_counts(spark, sf_dir):
    views = T.behavior(spark, sf_dir).where(F.col("behavior") == T.PV)
    return windows.sliding_count(views, "ts", "item_id", "60 minutes", "5 minutes")


_HOT_ITEMS_SQL = _sliding_sql(_VIEWS, "item_id", H, M5)
_HOT_ITEMS_TOP_SQL = (f"SELECT window_end, CAST(row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, item_id) AS INTEGER) AS rn, "
                      f"item_id, cnt FROM ({_HOT_ITEMS_SQL}) c QUALIFY rn <= 5")


@register("hot_items_sliding", _HOT_ITEMS_SQL)
def hot_items_sliding(spark, sf_dir):
    """A2: item views per 60 min window sliding by 5 min."""
    return _hot_item_counts(spark, sf_dir)


@register("hot_items_topn", _HOT_ITEMS_TOP_SQL)
def hot_items_topn(spark, sf_dir):
    """Top 5 items per window end, count desc, item asc."""
    return topn.top_n(_hot_item_counts(spark, sf_dir), "window_end", "item_id", "cnt", 5) \
        .select("window_end", "rn", "item_id", "cnt")


@register("hot_items_report", f"""
SELECT window_end, 'window_end=' || strftime(window_end, '%Y-%m-%d %H:%M:%S') || ' | ' ||
       string_agg(rn || ': item_id=' || item_id || ' cnt=' || cnt, ' | ' ORDER BY rn) AS report
FROM ({_HOT_ITEMS_TOP_SQL}) t GROUP BY window_end""")
def hot_items_report(spark, sf_dir):
    """The top-N as one text line per window."""
    return topn.report(hot_items_topn(spark, sf_dir), "window_end", "item_id", "cnt", "rn")


@register("hot_items_topn_changelog", f"""
WITH top AS ({_HOT_ITEMS_TOP_SQL}),
cur AS (SELECT window_end, item_id, rn FROM top),
prev AS (SELECT window_end + INTERVAL 5 MINUTE AS window_end, item_id, rn FROM top)
SELECT c.*, '+' AS op FROM cur c WHERE NOT EXISTS
  (SELECT 1 FROM prev p WHERE p.window_end = c.window_end AND p.item_id = c.item_id AND p.rn = c.rn)
UNION ALL
SELECT p.*, '-' AS op FROM prev p WHERE NOT EXISTS
  (SELECT 1 FROM cur c WHERE p.window_end = c.window_end AND p.item_id = c.item_id AND p.rn = c.rn)""")
def hot_items_topn_changelog(spark, sf_dir):
    """K3: retract stream of the top-N between successive windows."""
    ranked = hot_items_topn(spark, sf_dir)
    return topn.ranking_changelog(ranked, "window_end", "item_id", M5).select("window_end", "item_id", "rn", "op")


_TUMBLE_ITEMS_SQL = f"SELECT item_id, {_end(H)} AS window_end, count(item_id) AS cnt FROM ({_VIEWS}) v GROUP BY ALL"


@register("hot_items_sql_counts", _TUMBLE_ITEMS_SQL)
def hot_items_sql_counts(spark, sf_dir):
    """A4: item views per tumbling hour, written in Spark SQL."""
    T.behavior(spark, sf_dir).select("item_id", "behavior", F.col("ts")).createOrReplaceTempView("flowstat_user_behavior")
    return spark.sql("""
        SELECT item_id, window.end AS window_end, count(item_id) AS cnt
        FROM flowstat_user_behavior WHERE behavior = 'view'
        GROUP BY item_id, window(ts, '1 hour')""")


@register("hot_items_sql", f"""
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, item_id) AS INTEGER) AS row_num
FROM ({_TUMBLE_ITEMS_SQL}) c) WHERE row_num <= 5""")
def hot_items_sql(spark, sf_dir):
    """Top 5 per hour by SQL over a named view."""
    hot_items_sql_counts(spark, sf_dir).createOrReplaceTempView("flowstat_item_hour_counts")
    return spark.sql("""
        SELECT * FROM (
          SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, item_id) AS row_num
          FROM flowstat_item_hour_counts) WHERE row_num <= 5""")


# ================================================================ PV / UV
def _views(spark, sf_dir):
    return T.behavior(spark, sf_dir).where(F.col("behavior") == T.PV)


_PV_SQL = f"SELECT {_end(H)} AS window_end, count(*) AS pv FROM ({_VIEWS}) v GROUP BY ALL"


@register("pv_hourly", _PV_SQL)
def pv_hourly(spark, sf_dir):
    """Page views per tumbling hour."""
    return windows.tumbling_count(_views(spark, sf_dir), "ts", None, "1 hour", out="pv")


@register("pv_hourly_salted", _PV_SQL)
def pv_hourly_salted(spark, sf_dir):
    """The same by a two-stage salted count (10 salts over the user)."""
    return windows.salted_count(_views(spark, sf_dir), "ts", "1 hour", salt_col="user_id", n=10, out="pv")


@register("uv_hourly", f"SELECT {_end(H)} AS window_end, count(DISTINCT user_id) AS uv FROM ({_VIEWS}) v GROUP BY ALL")
def uv_hourly(spark, sf_dir):
    """Exact distinct visitors per hour."""
    return distinct.distinct_per_window(_views(spark, sf_dir), "ts", "user_id", "1 hour", "exact")


@register("uv_hourly_bitmap", f"SELECT {_end(H)} AS window_end, count(DISTINCT {_HASH}) AS uv FROM ({_VIEWS}) v GROUP BY ALL")
def uv_hourly_bitmap(spark, sf_dir):
    """Distinct one-hash bitmap positions per hour."""
    return distinct.distinct_per_window(_views(spark, sf_dir), "ts", "user_id", "1 hour", "bitmap")


@register("uv_hourly_bitmap_agg", f"SELECT {_end(H)} AS window_end, count(DISTINCT {_HASH}) AS uv FROM ({_VIEWS}) v GROUP BY ALL")
def uv_hourly_bitmap_agg(spark, sf_dir):
    """Set bits of the two-level bitmaps of each hour."""
    return distinct.bitmap_distinct(_views(spark, sf_dir), "ts", "user_id", "1 hour")


@register("uv_sliding_bitmap_agg", f"""
SELECT {_end(H, step="i")} AS window_end, count(DISTINCT {_HASH}) AS uv FROM ({_VIEWS}) v, range(6) r(i) GROUP BY ALL""")
def uv_sliding_bitmap_agg(spark, sf_dir):
    """A9 over sliding windows (6 hours by 1 hour): the hours' bitmaps merged by OR."""
    return distinct.bitmap_distinct(_views(spark, sf_dir), "ts", "user_id", "6 hours", "1 hour")


@register("uv_hourly_approx")
def uv_hourly_approx(spark, sf_dir):
    """A9 (scalable form): HyperLogLog distinct visitors per hour."""
    return distinct.distinct_per_window(_views(spark, sf_dir), "ts", "user_id", "1 hour", "approx")


@register("uv_running", f"""
WITH v AS (SELECT event_id AS seq, {_end(H)} AS window_end, {_HASH} AS hv FROM ({_VIEWS}) x),
f AS (SELECT window_end, hv, min(seq) AS fs FROM v GROUP BY ALL)
SELECT v.seq, v.window_end,
       CAST(sum(CASE WHEN v.seq = f.fs THEN 1 ELSE 0 END) OVER (PARTITION BY v.window_end ORDER BY v.seq) AS BIGINT) AS uv
FROM v JOIN f USING (window_end, hv)""")
def uv_running(spark, sf_dir):
    """Per view event, distinct bitmap positions so far in its hour."""
    return distinct.running_distinct(_views(spark, sf_dir), "ts", "seq", "user_id", "1 hour", hashed=True)


# ================================================================ hot pages

M1 = duration_us("1 minute")
M10 = duration_us("10 minutes")
_GETS = (f"SELECT p.url, e.event_id, epoch_us(e.ts) AS t FROM events e JOIN pages p ON {_ITEM} = p.page_id "
         f"WHERE e.event_type = 'view' AND NOT regexp_matches(p.url, '{ASSET_PATTERN}')")
_HOT_PAGES_SQL = _sliding_sql(_GETS, "url", M10, M1)


def _hot_page_counts(spark, sf_dir):
    # count GETs per (page, pane) first, then attach urls to the pane counts:
    # the join sees one row per page and minute instead of every request
    gets = T.page_requests(spark, sf_dir).where(F.col("method") == "GET")
    panes = windows.pane_counts(gets, "ts", "page_id", "10 minutes", "1 minute")
    pages = T.pages(spark, sf_dir).where(~is_asset("url"))
    return windows.sliding_count(panes.join(pages, "page_id"), "ts", "url", "10 minutes", "1 minute", weight="cnt")


@register("hot_pages_sliding", _HOT_PAGES_SQL)
def hot_pages_sliding(spark, sf_dir):
    """GETs per url (assets dropped), 10 min sliding by 1 min."""
    return _hot_page_counts(spark, sf_dir)


@register("hot_pages_topn", f"""
SELECT window_end, CAST(row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, url) AS INTEGER) AS rn, url, cnt
FROM ({_HOT_PAGES_SQL}) c QUALIFY rn <= 5""")
def hot_pages_topn(spark, sf_dir):
    """Top 5 urls per window end (latest count per url wins)."""
    return topn.top_n(_hot_page_counts(spark, sf_dir), "window_end", "url", "cnt", 5) \
        .select("window_end", "rn", "url", "cnt")


# ================================================================ late rows
_ARRIVAL_SQL = "epoch_us(ts) + ((event_id * 7919) % 1500) * 1000000"


def _arrivals(spark, sf_dir):
    """Events with a derived arrival time: ts + (event_id * 7919 mod 1500) s,
    a deterministic disorder of up to 25 minutes."""
    ev = T.table(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), "ts")
    delay = F.pmod(F.col("seq") * F.lit(7919), F.lit(1500))
    return ev.withColumn("arrival", F.timestamp_add("SECOND", delay, F.col("ts")))


@register("late_rows", f"""
WITH a AS (SELECT event_id, ts, epoch_us(ts) AS t, {_ARRIVAL_SQL} AS arr FROM events),
w AS (SELECT *, max(t) OVER (ORDER BY arr, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 1000000 AS wm FROM a)
SELECT event_id AS seq, ts, make_timestamp(wm) AS watermark FROM w
WHERE (t // 5000000) * 5000000 + 600000000 - 1000 + 60000000 <= wm""")
def late_rows(spark, sf_dir):
    """Rows too late for every 10 min / 5 s window even with 1 min of
    allowed lateness (watermark = max earlier event time - 1 s)."""
    _, late_df = late.split_late(_arrivals(spark, sf_dir), "ts", "arrival", "seq", "1 second",
                                 "10 minutes", "5 seconds", "1 minute")
    return late_df.select("seq", "ts", "watermark")


@register("hot_pages_with_lateness", f"""
WITH log AS (SELECT e.event_id, e.event_type, p.url, epoch_us(e.ts) AS t,
                    epoch_us(e.ts) + ((e.event_id * 7919) % 1500) * 1000000 AS arr
             FROM events e JOIN pages p ON {_ITEM} = p.page_id),
w AS (SELECT *, max(t) OVER (ORDER BY arr, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 1000000 AS wm
      FROM log),
x AS (SELECT url, (t // {M1}) * {M1} + (i + 1) * {M1} AS e, wm FROM w, range(10) r(i)
      WHERE event_type = 'view' AND NOT regexp_matches(url, '{ASSET_PATTERN}'))
SELECT url, make_timestamp(e) AS window_end, count(*) AS cnt FROM x
WHERE wm IS NULL OR e - 1000 + 60000000 > wm GROUP BY ALL""")
def hot_pages_with_lateness(spark, sf_dir):
    """T6/T7 with A5: GETs per url, 10 min sliding by 1 min, on a log that
    arrives out of order (derived arrival as in ``late_rows``); watermark =
    max earlier event time - 1 s; a row counts only in the windows still open
    (end - 1 ms + 1 min of allowed lateness > watermark) when it arrives."""
    log = T.page_views(spark, sf_dir)
    delay = F.pmod(F.col("seq") * F.lit(7919), F.lit(1500))
    log = log.withColumn("arrival", F.timestamp_add("SECOND", delay, F.col("ts")))
    # the watermark moves with every request; only GETs are counted.  The joined log is
    # written, so that requests and urls are read and joined once
    seen = late.watermark_before(written(log.select("seq", "ts", "arrival", "method", "url"), "arrivals"), "ts", "arrival", "seq", "1 second")
    gets = seen.where((F.col("method") == "GET") & ~is_asset("url"))
    return windows.sliding_count_open(gets, "ts", "url", "10 minutes", "1 minute", "watermark", "1 minute")


# ================================================================ marketing / ads
_MARKET = (f"SELECT user_id, event_type AS behavior, "
           f"['app store', 'wechat', 'weibo', 'tieba'][({_ITEM} % 4) + 1] AS channel, epoch_us(ts) AS t FROM events")
_MARKET_TOTAL_SQL = _sliding_sql(f"SELECT * FROM ({_MARKET}) m WHERE behavior = 'error'", "", H, M5)


def _market_total(spark, sf_dir):
    mk = T.market_behavior(spark, sf_dir).where(F.col("behavior") == T.FAIL)
    return windows.sliding_count(mk, "ts", None, "1 hour", "5 minutes")


@register("marketing_total", _MARKET_TOTAL_SQL)
def marketing_total(spark, sf_dir):
    """One global sliding count of uninstalls (as the job is
    written; the behaviour kept is a parameter)."""
    return _market_total(spark, sf_dir)


@register("marketing_total_text", f"""
SELECT window_end, strftime(window_end, '%Y-%m-%d %H:%M:%S') || '.0,' || cnt AS line FROM ({_MARKET_TOTAL_SQL}) c""")
def marketing_total_text(spark, sf_dir):
    """``windowEnd,count`` as one text line per window."""
    c = _market_total(spark, sf_dir)
    return c.select("window_end", F.concat_ws(",", F.date_format("window_end", "yyyy-MM-dd HH:mm:ss.S"),
                                              F.col("cnt").cast("string")).alias("line"))


@register("marketing_by_channel", _sliding_sql(_MARKET, "channel, behavior", H, M5))
def marketing_by_channel(spark, sf_dir):
    """Counts per (channel, behaviour).  As written the job's
    filter compares the channel with a behaviour name and keeps every row;
    ``as_written=False`` in :func:`marketing_counts` drops uninstalls."""
    return marketing_counts(T.market_behavior(spark, sf_dir), as_written=True)


@register("marketing_by_channel_no_uninstall",
          _sliding_sql(f"SELECT * FROM ({_MARKET}) m WHERE behavior <> 'error'", "channel, behavior", H, M5))
def marketing_by_channel_no_uninstall(spark, sf_dir):
    """P6, the evident aim of the channel job: uninstalls dropped."""
    return marketing_counts(T.market_behavior(spark, sf_dir), as_written=False)


def marketing_counts(df, as_written: bool = True, uninstall: str = T.FAIL, size="1 hour", slide="5 minutes"):
    if not as_written:
        df = df.where(F.col("behavior") != uninstall)
    return windows.sliding_count(df, "ts", ["channel", "behavior"], size, slide)


_ADS = (f"SELECT n.n_name AS province, epoch_us(e.ts) AS t FROM events e JOIN customer c ON e.user_id = c.c_custkey "
        f"JOIN nation n ON c.c_nationkey = n.n_nationkey")


@register("ad_clicks_by_province", _sliding_sql(_ADS, "province", H, M5))
def ad_clicks_by_province(spark, sf_dir):
    """Ad clicks per province, 1 h sliding by 5 min."""
    # a user rarely clicks twice in one pane, so pre-aggregating per (user,
    # pane) would not shrink the join input - join rows, then count
    return windows.sliding_count(T.ad_clicks(spark, sf_dir), "ts", "province", "1 hour", "5 minutes")


_CAPPED = ("SELECT event_id AS seq, user_id, event_type AS ad_id, strftime(ts, '%Y-%m-%d') AS day, ts, "
           "row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY event_id) AS n FROM events")


def _cap(spark, sf_dir):
    ev = T.table(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), "user_id",
                                                 F.col("event_type").alias("ad_id"), "ts")
    return capping.cap_and_flag(ev, ["user_id", "ad_id"], "ts", "seq", limit=3, zone="UTC")


@register("ad_clicks_filtered", f"SELECT seq, user_id, ad_id, day, ts FROM ({_CAPPED}) c WHERE n <= 3")
def ad_clicks_filtered(spark, sf_dir):
    """Clicks passing a cap of 3 per (user, ad, day)."""
    return _cap(spark, sf_dir)[0].select("seq", "user_id", "ad_id", F.col("day").cast("string").alias("day"), "ts")


@register("ad_click_blacklist", f"SELECT user_id, ad_id, day, seq, 'abnormal click' AS warning FROM ({_CAPPED}) c WHERE n = 4")
def ad_click_blacklist(spark, sf_dir):
    """One blacklist warning per (user, ad, day) at click 4."""
    return _cap(spark, sf_dir)[1].withColumn("day", F.col("day").cast("string"))


# ================================================================ login failures
H2 = duration_us("2 hours")


def _logins(spark, sf_dir):
    return T.table(spark, sf_dir, "events").select("user_id", "ts", F.col("event_id").alias("seq"), "event_type")


@register("login_fail_consecutive", f"""
WITH e AS (SELECT user_id, ts, event_id, event_type = 'error' AS f, lag(event_type = 'error') OVER w AS pf, lag(ts) OVER w AS pts
           FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
SELECT user_id, pts AS first_fail, ts AS last_fail, event_id AS seq, 'login fail' AS warning FROM e
WHERE f AND pf AND epoch_us(ts) - epoch_us(pts) <= {H2}""")
def login_fail_consecutive(spark, sf_dir):
    """A failure right after a failure (arrival order) within 2 h."""
    return patterns.consecutive(_logins(spark, sf_dir), "user_id", F.col("event_type") == T.FAIL,
                                "ts", "seq", "2 hours", inclusive=True)


@register("login_fail_sequence", f"""
WITH e AS (SELECT user_id, ts, event_id, event_type = 'error' AS a, lead(event_type = 'error') OVER w AS nb,
                  lead(ts) OVER w AS nts, lead(event_id) OVER w AS nseq
           FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, ts AS first_fail, nts AS last_fail, nseq AS seq, 'login fail' AS warning FROM e
WHERE a AND nb AND epoch_us(nts) - epoch_us(ts) < {H2}""")
def login_fail_sequence(spark, sf_dir):
    """begin(fail).next(fail).within(2 h) in event-time order."""
    fail = F.col("event_type") == T.FAIL
    return patterns.match_next(_logins(spark, sf_dir), "user_id", fail, fail, "ts", "seq", "2 hours")


@register("login_fail_burst", f"""
WITH RECURSIVE p AS (SELECT user_id, ts, event_id, event_type = 'error' AS f,
                            lag(event_type = 'error') OVER w AS pf, lag(ts) OVER w AS pts
                     FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
fl AS (SELECT user_id, epoch_us(ts) AS t, event_id AS s,
              sum(CASE WHEN pf IS NULL OR NOT pf OR epoch_us(ts) - epoch_us(pts) > {H2} THEN 1 ELSE 0 END)
              OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM p WHERE f),
anchors AS (SELECT user_id, run, min(t) AS a FROM fl GROUP BY ALL
            UNION ALL
            SELECT an.user_id, an.run, (SELECT min(fl.t) FROM fl WHERE fl.user_id = an.user_id AND fl.run = an.run AND fl.t > an.a + {H2})
            FROM anchors an WHERE an.a IS NOT NULL),
bursts AS (SELECT user_id, a, min(s) FILTER (WHERE t = a) AS aseq, max(t) AS l, count(*) AS n
           FROM anchors JOIN fl USING (user_id, run) WHERE a IS NOT NULL AND t BETWEEN a AND a + {H2}
           GROUP BY user_id, run, a HAVING count(*) >= 2)
SELECT user_id, make_timestamp(a) AS first_fail, make_timestamp(l) AS last_fail, n AS n_fails, 'login fail' AS warning
FROM bursts b WHERE NOT EXISTS (
  SELECT 1 FROM events r WHERE r.user_id = b.user_id AND r.event_type <> 'error'
    AND epoch_us(r.ts) BETWEEN b.a AND b.a + {H2} AND (epoch_us(r.ts) > b.a OR r.event_id > b.aseq))""")
def login_fail_burst(spark, sf_dir):
    """>= 2 failures within 2 h of the first, no success between."""
    fail = F.col("event_type") == T.FAIL
    return patterns.burst(_logins(spark, sf_dir), "user_id", fail, ~fail, "ts", "seq", "2 hours")


# ================================================================ orders
D1 = duration_us("1 day")
_ORDER_NEXT = f"""
WITH b AS (SELECT user_id, event_id AS seq, ts, epoch_us(ts) AS t, event_type = 'click' AS a, event_type = 'purchase' AS p
           FROM events WHERE event_type IN ('click', 'purchase')),
n AS (SELECT *, min(CASE WHEN p THEN {{'t': t, 's': seq}} END) OVER (PARTITION BY user_id ORDER BY t, seq
                 ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nx FROM b)"""


def _orders(spark, sf_dir):
    ev = _logins(spark, sf_dir)
    return patterns.followed_by(ev, "user_id", F.col("event_type") == T.CREATE, F.col("event_type") == T.PAY,
                                "ts", "seq", "1 day")


@register("order_pay_paid", _ORDER_NEXT + f"""
SELECT user_id, seq, ts, nx.s AS pay_seq, make_timestamp(nx.t) AS pay_ts FROM n WHERE a AND nx IS NOT NULL AND nx.t - t < {D1}""")
def order_pay_paid(spark, sf_dir):
    """C4 main output: create followed by its first pay within 1 day."""
    return _orders(spark, sf_dir)[0].select("user_id", "seq", "ts", F.col("then_seq").alias("pay_seq"),
                                            F.col("then_ts").alias("pay_ts"))


@register("order_pay_timeout", _ORDER_NEXT + f"""
SELECT user_id, seq, ts FROM n WHERE a AND (nx IS NULL OR nx.t - t >= {D1})""")
def order_pay_timeout(spark, sf_dir):
    """C4 side output: creates with no pay within 1 day."""
    return _orders(spark, sf_dir)[1]


@register("order_status", f"""
WITH b AS (SELECT user_id, epoch_us(ts) AS t, event_type FROM events),
f AS (SELECT user_id, min(t) FILTER (WHERE event_type = 'click') AS ct, min(t) FILTER (WHERE event_type = 'purchase') AS pt0
      FROM b GROUP BY user_id),
a AS (SELECT f.user_id, min(b.t) AS p1 FROM f JOIN b ON b.user_id = f.user_id AND b.event_type = 'purchase' AND b.t >= f.ct
      GROUP BY f.user_id)
SELECT user_id, CASE WHEN p1 IS NOT NULL AND p1 < ct + {D1} THEN 'payed' ELSE 'timeout' END AS status
FROM f LEFT JOIN a USING (user_id) WHERE ct IS NOT NULL
UNION ALL
SELECT user_id, 'pay_without_create' AS status FROM f WHERE pt0 IS NOT NULL AND (ct IS NULL OR pt0 < ct)""")
def order_status(spark, sf_dir):
    """Per order payed / timeout / pay_without_create."""
    return patterns.pair_status(_logins(spark, sf_dir), "user_id", F.col("event_type") == T.CREATE,
                                F.col("event_type") == T.PAY, "ts", "1 day")


# ================================================================ payment reconciliation
def _tx_sides(spark, sf_dir):
    ev = T.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    pays = ev.where(F.col("event_type") == T.CREATE).select("user_id", F.col("event_id").alias("pay_id"),
                                                          F.col("ts").alias("pay_ts"))
    receipts = ev.where(F.col("event_type") == T.PAY).select("user_id", F.col("event_id").alias("receipt_id"),
                                                           F.col("ts").alias("receipt_ts"))
    return pays, receipts


_TX_P = "(SELECT user_id, event_id AS pay_id, ts AS pay_ts FROM events WHERE event_type = 'click')"
_TX_R = "(SELECT user_id, event_id AS receipt_id, ts AS receipt_ts FROM events WHERE event_type = 'purchase')"
_TX_ON = "p.user_id = r.user_id AND r.receipt_ts BETWEEN p.pay_ts - INTERVAL 1 HOUR AND p.pay_ts + INTERVAL 2 HOUR"


@register("tx_match_interval", f"""
SELECT p.user_id, pay_id, pay_ts, receipt_id, receipt_ts FROM {_TX_P} p JOIN {_TX_R} r ON {_TX_ON}""")
def tx_match_interval(spark, sf_dir):
    """Interval join, receipt in [pay - 1 h, pay + 2 h]."""
    p, r = _tx_sides(spark, sf_dir)
    return joins.interval_join(p, r, "user_id", "pay_ts", "receipt_ts", "-1 hour", "2 hours")


@register("tx_match_full", f"""
SELECT coalesce(p.user_id, r.user_id) AS user_id, pay_id, pay_ts, receipt_id, receipt_ts
FROM {_TX_P} p FULL JOIN {_TX_R} r ON {_TX_ON}""")
def tx_match_full(spark, sf_dir):
    """Two-sided match with waits = full outer interval join."""
    p, r = _tx_sides(spark, sf_dir)
    return joins.full_outer_interval(p, r, "user_id", "pay_ts", "receipt_ts", "pay_id", "receipt_id",
                                     "-1 hour", "2 hours")


@register("tx_pay_unmatched", f"""
SELECT user_id, pay_id, pay_ts FROM {_TX_P} p WHERE NOT EXISTS (SELECT 1 FROM {_TX_R} r WHERE {_TX_ON})""")
def tx_pay_unmatched(spark, sf_dir):
    """J2 side output: pays with no receipt in time."""
    p, r = _tx_sides(spark, sf_dir)
    return joins.interval_match(p, r, "user_id", "pay_ts", "receipt_ts", "pay_id", "receipt_id",
                                "-1 hour", "2 hours")[1]


@register("tx_receipt_unmatched", f"""
SELECT user_id, receipt_id, receipt_ts FROM {_TX_R} r WHERE NOT EXISTS (SELECT 1 FROM {_TX_P} p WHERE {_TX_ON})""")
def tx_receipt_unmatched(spark, sf_dir):
    """J2 side output: receipts with no pay in time."""
    p, r = _tx_sides(spark, sf_dir)
    return joins.interval_match(p, r, "user_id", "pay_ts", "receipt_ts", "pay_id", "receipt_id",
                                "-1 hour", "2 hours")[2]


# ================================================================ access log


def access_log_lines(spark, sf_dir):
    """The requests written as space-separated access-log lines
    (ip user - dd/MM/yyyy:HH:mm:ss +0000 method url)."""
    req = T.page_views(spark, sf_dir)
    u = F.col("user_id")
    ip = F.concat_ws(".", F.lit("10"), *[F.pmod(F.floor(u / F.lit(d)), F.lit(256)).cast("string")
                                         for d in (65536, 256, 1)])
    line = F.concat_ws(" ", ip, u.cast("string"), F.lit("-"), F.date_format("ts", "dd/MM/yyyy:HH:mm:ss"),
                       F.lit("+0000"), F.col("method"), F.col("url"))
    return req.select(line.alias("value"))


@register("hot_pages_from_log", _HOT_PAGES_SQL)
def hot_pages_from_log(spark, sf_dir):
    """The hot-page counts computed from parsed log lines (the
    log keeps whole seconds, which never moves a row across a minute-aligned
    window border)."""
    log = parse_access_log(access_log_lines(spark, sf_dir))
    log = log.withColumn("ts", to_utc_wallclock("ts", log.schema["ts"].dataType))
    gets = log.where((F.col("method") == "GET") & ~is_asset("url"))
    return windows.sliding_count(gets, "ts", "url", "10 minutes", "1 minute")


# ================================================================ features that the keys above do not reach
_KEY = "CASE WHEN event_id % 11 <> 0 THEN user_id % 7 END"


@register("tx_match_repeated", f"""
WITH p AS (SELECT {_KEY} AS tx, event_id AS pay_id, ts AS pay_ts FROM events WHERE event_type = 'click'),
     r AS (SELECT {_KEY} AS tx, event_id AS receipt_id, ts AS receipt_ts FROM events WHERE event_type = 'purchase')
SELECT coalesce(p.tx, r.tx) AS tx, pay_id, receipt_id FROM p FULL JOIN r
ON p.tx = r.tx AND r.receipt_ts BETWEEN p.pay_ts - INTERVAL 3 MINUTE AND p.pay_ts + INTERVAL 5 MINUTE""")
def tx_match_repeated(spark, sf_dir):
    """J2 with transaction ids that repeat and are sometimes null: every row is
    matched or unmatched on its own, and no row is lost."""
    ev = T.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    ev = ev.withColumn("tx", F.when(F.pmod("event_id", F.lit(11)) != 0, F.pmod("user_id", F.lit(7))))
    pays = ev.where(F.col("event_type") == T.CREATE).select("tx", F.col("event_id").alias("pay_id"), F.col("ts").alias("pay_ts"))
    receipts = ev.where(F.col("event_type") == T.PAY).select("tx", F.col("event_id").alias("receipt_id"), F.col("ts").alias("receipt_ts"))
    return joins.full_outer_interval(pays, receipts, "tx", "pay_ts", "receipt_ts", "pay_id", "receipt_id",
                                     "-3 minutes", "5 minutes").select("tx", "pay_id", "receipt_id")


@register("hot_pages_top2", f"""
SELECT window_end, CAST(row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, url) AS INTEGER) AS rn, url, cnt
FROM ({_sliding_sql(_GETS, "url", H, M5)}) c QUALIFY rn <= 2""")
def hot_pages_top2(spark, sf_dir):
    """R5 with a cut that bites: the two top urls of an hour, every five minutes."""
    gets = T.page_requests(spark, sf_dir).where(F.col("method") == "GET")
    panes = windows.pane_counts(gets, "ts", "page_id", "1 hour", "5 minutes")
    pages = T.pages(spark, sf_dir).where(~is_asset("url"))
    counts = windows.sliding_count(panes.join(pages, "page_id"), "ts", "url", "1 hour", "5 minutes", weight="cnt")
    return topn.top_n(counts, "window_end", "url", "cnt", 2).select("window_end", "rn", "url", "cnt")


_WITH_ASSETS = ("SELECT page_id, url || CASE WHEN page_id % 3 = 0 THEN '.css' WHEN page_id % 5 = 0 THEN '.png' "
                "WHEN page_id % 7 = 0 THEN '.css.html' ELSE '' END AS url FROM pages")


@register("hot_pages_without_assets", f"""
SELECT url, {_end(H)} AS window_end, count(*) AS cnt
FROM (SELECT p.url, epoch_us(e.ts) AS t FROM events e JOIN ({_WITH_ASSETS}) p ON {_ITEM.replace("props", "e.props")} = p.page_id
      WHERE e.event_type = 'view' AND NOT regexp_matches(p.url, '{ASSET_PATTERN}')) x GROUP BY ALL""")
def hot_pages_without_assets(spark, sf_dir):
    """P4 on urls of which a third and more are assets (suffixes by a rule)."""
    n = F.col("page_id")
    suffix = (F.when(n % 3 == 0, ".css").when(n % 5 == 0, ".png").when(n % 7 == 0, ".css.html").otherwise(""))
    pages = T.pages(spark, sf_dir).withColumn("url", F.concat("url", suffix)).where(~is_asset("url"))
    gets = T.page_requests(spark, sf_dir).where(F.col("method") == "GET")
    return windows.tumbling_count(gets.join(pages, "page_id"), "ts", "url", "1 hour")


@register("ad_clicks_by_province_5s", f"""
SELECT province, strftime(window_end, '%Y-%m-%d') AS day, count(*) AS windows, CAST(sum(cnt) AS BIGINT) AS total, max(cnt) AS most
FROM ({_sliding_sql(_ADS, "province", H, 5_000_000)}) c GROUP BY ALL""")
def ad_clicks_by_province_5s(spark, sf_dir):
    """A13/A5 at the job's own slide (1 h / 5 s, the difference method), folded per day."""
    counts = windows.sliding_count(T.ad_clicks(spark, sf_dir), "ts", "province", "1 hour", "5 seconds")
    return (counts.groupBy("province", F.date_format("window_end", "yyyy-MM-dd").alias("day"))
            .agg(F.count(F.lit(1)).alias("windows"), F.sum("cnt").alias("total"), F.max("cnt").alias("most")))


_SHANGHAI = _CAPPED.replace("strftime(ts, '%Y-%m-%d')", "strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d')").replace(
    "CAST(ts AS DATE)", "CAST(ts + INTERVAL 8 HOUR AS DATE)")


@register("ad_click_blacklist_shanghai", f"SELECT user_id, ad_id, day, seq FROM ({_SHANGHAI}) c WHERE n = 4")
def ad_click_blacklist_shanghai(spark, sf_dir):
    """B1 with the daily reset at midnight of UTC+8."""
    ev = T.table(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), "user_id", F.col("event_type").alias("ad_id"), "ts")
    warned = capping.cap_and_flag(ev, ["user_id", "ad_id"], "ts", "seq", limit=3, zone="Asia/Shanghai")[1]
    return warned.select("user_id", "ad_id", F.col("day").cast("string").alias("day"), "seq")


_LATE_SEQ = f"(({_ARRIVAL_SQL}) // 1000000) * 100000000 + event_id % 100000000"


@register("login_fail_disordered", f"""
WITH e AS (SELECT user_id, event_type = 'error' AS f, epoch_us(ts) AS t, {_LATE_SEQ} AS seq FROM events),
l AS (SELECT *, lag(f) OVER w AS pf, lag(t) OVER w AS pt FROM e WINDOW w AS (PARTITION BY user_id ORDER BY seq))
SELECT user_id, seq, make_timestamp(pt) AS first_fail, make_timestamp(t) AS last_fail FROM l WHERE f AND pf AND t - pt <= {H2}""")
def login_fail_disordered(spark, sf_dir):
    """C1 in arrival order where it differs from event time (negative gaps count)."""
    ev = T.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts").join(
        _arrivals(spark, sf_dir).select(F.col("seq").alias("event_id"), "arrival"), "event_id")
    seconds = F.floor(to_micros("arrival", ev.schema["arrival"].dataType) / F.lit(1_000_000))
    ev = ev.withColumn("seq", seconds.cast("long") * 100_000_000 + F.pmod("event_id", F.lit(100_000_000)))
    found = patterns.consecutive(ev.select("user_id", "event_type", "ts", "seq"), "user_id", F.col("event_type") == T.FAIL,
                                 "ts", "seq", "2 hours", chunk=3600 * 100_000_000)
    return found.select("user_id", "seq", "first_fail", "last_fail")


@register("uv_hourly_approx_error", f"SELECT {_end(H)} AS window_end, TRUE AS close FROM ({_VIEWS}) v GROUP BY ALL")
def uv_hourly_approx_error(spark, sf_dir):
    """Whether each hour's sketch is within three times the standard error it is built for, or one visitor, of the exact count."""
    rsd = 0.01
    exact = distinct.distinct_per_window(_views(spark, sf_dir), "ts", "user_id", "1 hour", "exact")
    approx = distinct.distinct_per_window(_views(spark, sf_dir), "ts", "user_id", "1 hour", "approx", rsd=rsd)
    both = exact.join(approx.select("window_end", F.col("uv").alias("guess")), "window_end")
    return both.select("window_end", (F.abs(F.col("uv") - F.col("guess")) <= F.greatest(F.lit(1.0), 3 * rsd * F.col("uv"))).alias("close"))


_PANES_SQL = f"""
    SELECT item_id, (t // {H}) * {H} + {H} AS we, (t // {M5}) * {M5} + {M5} AS pe, count(*) AS c FROM ({_VIEWS}) v GROUP BY ALL"""


@register("hot_items_retract_panes", f"""
WITH s AS (SELECT item_id, we, pe + i * {M5} AS pe, CAST(sum(c) AS BIGINT) AS cnt FROM ({_PANES_SQL}) p, range(12) r(i)
           WHERE pe + i * {M5} <= we GROUP BY ALL),
top AS (SELECT *, CAST(row_number() OVER (PARTITION BY we, pe ORDER BY cnt DESC, item_id) AS INTEGER) AS rn FROM s QUALIFY rn <= 5),
d AS (SELECT we, pe, item_id, cnt, rn, 1 AS d FROM top
      UNION ALL SELECT we, pe + {M5}, item_id, cnt, rn, -1 FROM top WHERE pe + {M5} <= we)
SELECT make_timestamp(we) AS window_end, make_timestamp(pe) AS pane_end, item_id, cnt, rn, CASE WHEN sum(d) > 0 THEN '+' ELSE '-' END AS op
FROM d GROUP BY we, pe, item_id, cnt, rn HAVING sum(d) <> 0""")
def hot_items_retract_panes(spark, sf_dir):
    """K3: the retract stream of the top five items of one tumbling hour as its
    five-minute panes arrive: rows leave and enter as the counts of the window grow."""
    views = _views(spark, sf_dir)
    t = to_micros("ts", views.schema["ts"].dataType)
    panes = (views.select("item_id", (floor_to(t, H) + H).alias("we"), (floor_to(t, M5) + M5).alias("pe"))
             .groupBy("item_id", "we", "pe").agg(F.count(F.lit(1)).alias("c")))
    # a pane's views count in it and in the later panes of its hour
    so_far = (panes.select("item_id", "we", F.explode(F.sequence("pe", "we", F.lit(M5))).alias("pe"), "c")
              .groupBy("we", "pe", "item_id").agg(F.sum("c").alias("cnt")))
    ranked = topn.top_n(so_far, ["we", "pe"], "item_id", "cnt", 5)
    # each ranked row enters at its pane and leaves at the next; what stays cancels out
    steps = ranked.select("we", "item_id", "cnt", "rn", F.explode(F.array(
        F.struct(F.col("pe").alias("pe"), F.lit(1).alias("d")), F.struct((F.col("pe") + M5).alias("pe"), F.lit(-1).alias("d")))).alias("x"))
    net = (steps.select("we", "x.pe", "item_id", "cnt", "rn", "x.d").where("pe <= we")
           .groupBy("we", "pe", "item_id", "cnt", "rn").agg(F.sum("d").alias("d")).where("d <> 0"))
    ts = views.schema["ts"].dataType
    return net.select(from_micros("we", ts).alias("window_end"), from_micros("pe", ts).alias("pane_end"), "item_id", "cnt", "rn",
                      F.when(F.col("d") > 0, "+").otherwise("-").alias("op"))


@register("item_price_spread", f"""
SELECT item_id, {_end(H, step="i")} AS window_end, count(*) AS n, min(value) AS low, max(value) AS high
FROM (SELECT {_ITEM} AS item_id, value, epoch_us(ts) AS t FROM events WHERE event_type = 'view' AND value IS NOT NULL) v, range(2) r(i) GROUP BY ALL""")
def item_price_spread(spark, sf_dir):
    """U: a user aggregate (number, least and largest value of an item's views) over 2 hours sliding by 1 hour."""
    spread = aggregate.Aggregate(
        "n bigint, low double, high double", "struct<n:bigint,low:double,high:double>", lambda: (0, float("inf"), float("-inf")),
        lambda a, rows: (a[0] + len(rows), min(a[1], float(rows["value"].min())), max(a[2], float(rows["value"].max()))),
        lambda a, b: (a[0] + b[0], min(a[1], b[1]), max(a[2], b[2])), lambda a: {"n": a[0], "low": a[1], "high": a[2]})
    views = (T.table(spark, sf_dir, "events").where((F.col("event_type") == "view") & F.col("value").isNotNull())
             .select(json_long("props", "k").alias("item_id"), "ts", "value"))
    return (aggregate.aggregate_windows(views, "ts", "item_id", spread, ["value"], "2 hours", "1 hour", out="spread")
            .select("item_id", "window_end", "spread.n", "spread.low", "spread.high"))
