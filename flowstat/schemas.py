"""Record schemas of the behaviour logs (explicit, positional, no inference)."""

from pyspark.sql import types as T

USER_BEHAVIOR = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("item_id", T.LongType()),
    T.StructField("category_id", T.IntegerType()),
    T.StructField("behavior", T.StringType()),
    T.StructField("timestamp", T.LongType()),      # epoch seconds
])

LOGIN_EVENT = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("ip", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("timestamp", T.LongType()),      # epoch seconds
])

AD_CLICK = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("ad_id", T.LongType()),
    T.StructField("province", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("timestamp", T.LongType()),      # epoch seconds
])

ORDER_EVENT = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("tx_id", T.StringType()),
    T.StructField("timestamp", T.LongType()),      # epoch seconds
])

RECEIPT_EVENT = T.StructType([
    T.StructField("tx_id", T.StringType()),
    T.StructField("pay_channel", T.StringType()),
    T.StructField("timestamp", T.LongType()),      # epoch seconds
])

MARKET_BEHAVIOR = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("behavior", T.StringType()),
    T.StructField("channel", T.StringType()),
    T.StructField("timestamp", T.LongType()),      # epoch milliseconds
])

# name -> (schema, unit of the `timestamp` field)
RECORDS = {
    "user_behavior": (USER_BEHAVIOR, "s"),
    "login": (LOGIN_EVENT, "s"),
    "ad_click": (AD_CLICK, "s"),
    "order": (ORDER_EVENT, "s"),
    "receipt": (RECEIPT_EVENT, "s"),
    "market": (MARKET_BEHAVIOR, "ms"),
}

ACCESS_LOG = T.StructType([
    T.StructField("ip", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("method", T.StringType()),
    T.StructField("url", T.StringType()),
])
