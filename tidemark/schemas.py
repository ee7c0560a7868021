"""Record types as explicit StructTypes (nothing is inferred)."""

from pyspark.sql import types as T

# user_id, item_id, category_id, behavior, ts_s (seconds)
USER_BEHAVIOR = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("item_id", T.LongType()),
    T.StructField("category_id", T.IntegerType()),
    T.StructField("behavior", T.StringType()),
    T.StructField("ts_s", T.LongType()),
])

# user_id, ad_id, province, city, ts_s (seconds)
AD_CLICK = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("ad_id", T.LongType()),
    T.StructField("province", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("ts_s", T.LongType()),
])

# user_id, ip, state ('success' / 'fail'), ts_s (seconds)
LOGIN_EVENT = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("ip", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("ts_s", T.LongType()),
])

# user_id, behavior, channel, ts (event time)
MARKETING_EVENT = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("behavior", T.StringType()),
    T.StructField("channel", T.StringType()),
    T.StructField("ts", T.TimestampType()),
])

# order_id, event ('create' / 'pay'), tx_id (null on create), ts_s
ORDER_EVENT = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("event", T.StringType()),
    T.StructField("tx_id", T.StringType()),
    T.StructField("ts_s", T.LongType()),
])

# tx_id, pay_channel, ts_s
RECEIPT = T.StructType([
    T.StructField("tx_id", T.StringType()),
    T.StructField("pay_channel", T.StringType()),
    T.StructField("ts_s", T.LongType()),
])

# Parsed access-log line.
ACCESS_LOG = T.StructType([
    T.StructField("ip", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("method", T.StringType()),
    T.StructField("url", T.StringType()),
])

# Driver table `events`.
EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])
