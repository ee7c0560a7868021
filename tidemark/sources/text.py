"""Text sources: delimited records, access-log lines, message buses.

Bad input fails the job, as in the reference: delimited files are read
in ``FAILFAST`` mode and a log line with too few fields raises.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.time import millis_to_ts, seconds_to_ts


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",",
                   trim: bool | list[str] = True, time_col: str | None = "ts_s",
                   time_unit: str = "s", with_seq: bool = True) -> DataFrame:
    """Headerless delimited text -> typed records (+ ``ts`` instant).

    ``trim`` strips blanks around all fields (``True``), none, or only the
    named ones (e.g. the numbers of the behaviour log, keeping blanks in
    its text field): those are read as text, trimmed and cast, and a
    value that does not convert fails the job. ``seq`` is the line order of
    the input (files by path; see ``with_line_order``),
    used as the arrival order and the tie-breaker of equal event times.
    """
    raw = (spark.read.schema(_as_text(schema)).option("sep", sep).option("mode", "FAILFAST").option("columnPruning", False)
           .option("ignoreLeadingWhiteSpace", trim is True).option("ignoreTrailingWhiteSpace", trim is True).csv(path))
    return _typed(_checked(raw, schema, trim), time_col, time_unit, with_seq)


def _as_text(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])


def _checked(raw: DataFrame, schema: T.StructType, trim: bool | list[str]) -> DataFrame:
    """Text fields -> typed columns. A value that does not convert fails the job whatever columns
    are read later: the check is a filter over all fields, and a filter is not pruned."""
    named = trim if isinstance(trim, (list, tuple)) else []
    text = {f.name: F.trim(F.col(f.name)) if f.name in named else F.col(f.name) for f in schema.fields}
    good = F.lit(True)
    for f in schema.fields:
        if not isinstance(f.dataType, T.StringType):
            good = good & (text[f.name].isNull() | text[f.name].try_cast(f.dataType).isNotNull())
    line = F.concat_ws(" | ", *text.values())
    kept = raw.filter(F.when(good, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("bad line: "), line)).cast("boolean")))
    return kept.select(*[_strict_cast(text[f.name], f) for f in schema.fields])


def _strict_cast(c, field: T.StructField):
    """Cast that raises on bad text whatever the ANSI setting."""
    if isinstance(field.dataType, T.StringType):
        return c.alias(field.name)
    cast = c.try_cast(field.dataType)
    return F.when(c.isNotNull() & cast.isNull(),
                  F.raise_error(F.concat(F.lit(f"bad value for {field.name}: "), c))) \
        .otherwise(cast).cast(field.dataType).alias(field.name)


def parse_delimited(lines: DataFrame, schema: T.StructType, sep: str = ",",
                    trim: bool | list[str] = True, value: str = "value",
                    time_col: str | None = "ts_s", time_unit: str = "s") -> DataFrame:
    """Delimited text lines (e.g. message values from ``read_kafka_stream`` or
    ``read_socket_stream``) -> typed records. Too few fields or a value
    that does not convert fails the job."""
    trimmed = [f.name for f in schema.fields] if trim is True else list(trim or [])
    parts = F.split(F.col(value), re.escape(sep))
    checked = F.when(F.size(parts) < len(schema.fields),
                     F.raise_error(F.concat(F.lit("malformed line: "), F.col(value)))).otherwise(parts)
    cols = []
    for i, f in enumerate(schema.fields):
        raw = checked[i]
        raw = F.trim(raw) if f.name in trimmed else raw
        cols.append(_strict_cast(raw, f))
    return _typed(lines.select(*cols), time_col, time_unit, with_seq=False)


def read_delimited_stream(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",",
                          trim: bool = True, time_col: str | None = "ts_s", time_unit: str = "s",
                          max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming form of ``read_delimited`` over a folder of files."""
    r = (spark.readStream.schema(_as_text(schema)).option("sep", sep).option("mode", "FAILFAST").option("columnPruning", False)
         .option("ignoreLeadingWhiteSpace", trim).option("ignoreTrailingWhiteSpace", trim))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return _typed(_checked(r.csv(path), schema, trim), time_col, time_unit, with_seq=False)


def _typed(df: DataFrame, time_col: str | None, unit: str, with_seq: bool) -> DataFrame:
    if time_col:
        conv = seconds_to_ts if unit == "s" else millis_to_ts
        df = df.withColumn("ts", conv(time_col))
    return with_line_order(df, "seq") if with_seq else df


def with_line_order(df: DataFrame, name: str) -> DataFrame:
    """``df``, as read from text files, with the position of each line: files by path, then blocks
    of a file by offset, then lines of a block. Spark's own row numbers follow the order of splits
    (largest file first), so they only count within a block; the blocks - one row a split - are
    numbered apart and joined back (a table that the planner broadcasts by its size)."""
    mask = (1 << 33) - 1  # row number within a partition
    keyed = df.select("*", F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at")).alias("_split"),
                      F.monotonically_increasing_id().alias("_row"))
    splits = df.select(F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at")).alias("_of")).distinct()
    splits = splits.select("_of", (F.row_number().over(Window.orderBy("_of")) - 1).cast("long").alias("_place"))
    return (keyed.join(splits, F.col("_split") == F.col("_of"))
            .select(*df.columns, F.shiftleft("_place", 33).bitwiseOR(F.col("_row").bitwiseAND(F.lit(mask))).alias(name)))


def parse_access_log(lines: DataFrame, tz: str = "+08:00", value: str = "value",
                     skip_blank: bool = True) -> DataFrame:
    """Space-delimited access-log lines -> ip, user_id, ts, method, url.

    Fields: 0 ip, 1 user, 3 time ``dd/MM/yyyy:HH:mm:ss`` read as wall-clock
    time at ``tz``, 5 method, 6 url. Other input columns are kept.
    """
    if skip_blank:
        lines = lines.filter(F.trim(F.col(value)) != "")
    f = F.split(F.col(value), " ")
    checked = F.when(F.size(f) < 7, F.raise_error(F.concat(F.lit("malformed log line: "),
                                                            F.col(value)))).otherwise(f)
    wall = F.to_timestamp(checked[3], "dd/MM/yyyy:HH:mm:ss")
    keep = [c for c in lines.columns if c != value]
    return lines.select(*keep, checked[0].alias("ip"), f[1].alias("user_id"),
                        F.to_utc_timestamp(wall, tz).alias("ts"), f[5].alias("method"),
                        f[6].alias("url"))


def read_access_log(spark: SparkSession, path: str, tz: str = "+08:00") -> DataFrame:
    """Access-log text file(s); ``arrival`` is the line order."""
    lines = with_line_order(spark.read.text(path), "arrival")
    return parse_access_log(lines, tz)


def read_socket_stream(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Newline-delimited text from a socket (``value`` column)."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def read_kafka_stream(spark: SparkSession, servers: str, topic: str,
                      starting_offsets: str = "latest", **options) -> DataFrame:
    """Message values of a Kafka topic as text (needs the Kafka connector
    on the classpath)."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", starting_offsets))
    for k, v in options.items():
        r = r.option(k, v)
    return r.load().select(F.col("value").cast("string").alias("value"))


def publish_text(spark: SparkSession, path: str, servers: str, topic: str) -> None:
    """Publish each line of a text file as one keyless message."""
    (spark.read.text(path).write.format("kafka").option("kafka.bootstrap.servers", servers)
     .option("topic", topic).save())


def seconds_records(df: DataFrame, col: str = "ts_s") -> DataFrame:
    return df.withColumn("ts", seconds_to_ts(col))
