"""Views of the driver tables in the shape of the behaviour logs.

``events(event_id, ts, user_id, event_type, value, props)`` plays every log:
user <- user_id, item <- props.k, behaviour <- event_type, arrival order
(``seq``) <- event_id.  Only the columns a query needs are selected, so the
parquet scan reads just those (column pruning) and filters on them are pushed
into the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import json_long

# ---------------------------------------------------------------- fixed values
# Behaviour names of the driver's events that stand for the logs' event kinds.
PV = "view"            # page view / item view ("pv"), HTTP GET
FAIL = "error"         # login failure; also the marketing "UNINSTALL"
CREATE = "click"       # order create / payment side of the reconciliation
PAY = "purchase"       # order pay / receipt side of the reconciliation
# Channel names of the marketing job, indexed by item % 4.
CHANNELS = ["app store", "wechat", "weibo", "tieba"]
# ------------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def behavior(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_id, item_id, behavior, ts, seq."""
    ev = table(spark, sf_dir, "events")
    return ev.select("user_id", json_long("props", "k").alias("item_id"),
                     F.col("event_type").alias("behavior"), "ts", F.col("event_id").alias("seq"))


def page_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Access-log requests: seq, ts, user_id, method ('GET' for views), page_id."""
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("event_id").alias("seq"), "ts", "user_id",
                     F.when(F.col("event_type") == PV, F.lit("GET")).otherwise(F.lit("POST")).alias("method"),
                     json_long("props", "k").alias("page_id"))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page dimension (page_id, url).  It grows with the data, so it is
    joined by whatever the size check allows: broadcast while Spark's size
    estimate (or AQE's runtime size) is under the threshold, else a shuffle."""
    return table(spark, sf_dir, "pages").select("page_id", "url")


def page_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests joined to their url (row level, for row-level consumers)."""
    return page_requests(spark, sf_dir).join(pages(spark, sf_dir), "page_id")


def market_behavior(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_id, behavior, channel, ts."""
    ev = table(spark, sf_dir, "events")
    names = F.array(*[F.lit(c) for c in CHANNELS])
    k = json_long("props", "k")
    return ev.select("user_id", F.col("event_type").alias("behavior"),
                     F.element_at(names, (F.pmod(k, F.lit(len(CHANNELS))) + 1).cast("int")).alias("channel"),
                     "ts", F.col("event_id").alias("seq"))


def customer_province(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer key -> province (nation name).  nation has a fixed 25 rows
    at every scale, so broadcasting it is bounded; customer grows with the
    data and is left to the size-checked join selection."""
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (cust.join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
                .select(F.col("c_custkey").alias("user_id"), F.col("n_name").alias("province")))


def ad_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ad clicks with the clicking customer's nation as province (row level)."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props")
    return (ev.join(customer_province(spark, sf_dir), "user_id")
              .select(F.col("event_id").alias("seq"), "ts", "user_id",
                      json_long("props", "k").alias("ad_id"), "province", "event_type"))
