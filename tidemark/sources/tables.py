"""Driver tables and the record views the operators consume.

The ``events`` table (event_id, ts, user_id, event_type, value, props)
stands in for the clickstream inputs:

=================  ==============================================
role               column
=================  ==============================================
page view          ``event_type = 'view'``
login failure      ``event_type = 'error'`` (anything else: success)
ad click           ``event_type = 'click'``
item / ad / url    ``cast(get_json_object(props, '$.k') as bigint)``
arrival order      ``event_id``
=================  ==============================================
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import as_instant

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def prop_k() -> Column:
    return F.get_json_object(F.col("props"), "$.k").cast("bigint")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with ``ts`` as an instant (session zone UTC)."""
    return read_table(spark, sf_dir, "events").withColumn("ts", as_instant("ts"))


def behaviors(ev: DataFrame) -> DataFrame:
    """user_id, item_id, category_id, behavior (= event_type; 'view' is a
    page view), ts, seq. Filters on ``behavior`` reach the parquet scan."""
    k = prop_k()
    return ev.select("user_id", k.alias("item_id"), (k % 10).cast("int").alias("category_id"),
                     F.col("event_type").alias("behavior"), "ts", F.col("event_id").alias("seq"))


def logins(ev: DataFrame) -> DataFrame:
    """user_id, state ('fail' / 'success'), ts, seq."""
    state = F.when(F.col("event_type") == "error", F.lit("fail")).otherwise(F.lit("success"))
    return ev.select("user_id", state.alias("state"), "ts", F.col("event_id").alias("seq"))


def ad_clicks(ev: DataFrame) -> DataFrame:
    """user_id, ad_id, province, ts, seq for ``click`` rows; province = ad_id % 5."""
    k = prop_k()
    return (ev.filter(F.col("event_type") == "click")
            .select("user_id", k.alias("ad_id"), (k % 5).alias("province"), "ts",
                    F.col("event_id").alias("seq")))


def marketing(ev: DataFrame) -> DataFrame:
    """user_id, behavior (= event_type), channel (= k % 5), ts."""
    return ev.select("user_id", F.col("event_type").alias("behavior"),
                     (prop_k() % 5).alias("channel"), "ts", F.col("event_id").alias("seq"))
