"""Top-N per window and its text report."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import format_java_timestamp


def top_n_per_window(counts: DataFrame, n: int, key: str, count: str,
                     window: str = "window_end", rank_name: str = "rank") -> DataFrame:
    """Keep the ``n`` largest ``count`` rows of each window.

    Ties are broken by ``key`` ascending. ``row_number() <= n`` is planned
    with a partial ``WindowGroupLimit`` before the exchange, so each map
    task ships at most ``n`` rows per window however many keys it holds.
    """
    w = Window.partitionBy(window).orderBy(F.col(count).desc(), F.col(key).asc())
    return counts.withColumn(rank_name, F.row_number().over(w)).filter(F.col(rank_name) <= n)


def top_n_report(top: DataFrame, key: str, count: str, window: str = "window_end",
                 rank_name: str = "rank", header: str = "window end: ",
                 line: str = "Top{rank}: {key_label}={key}, {count_label}={count}",
                 key_label: str = "item_id", count_label: str = "pv",
                 rule: str = "-" * 32, tz: str = "UTC") -> DataFrame:
    """One text block per window: header with the end time (in
    ``Timestamp.toString`` form), one line per rank, a dashed rule. Groups
    hold at most n rows (input is a top-n)."""
    # Positional specifiers: the template may place the fields in any order.
    text = F.format_string(
        line.format(rank="%1$d", key_label=key_label, key="%2$s", count_label=count_label,
                    count="%3$d"),
        F.col(rank_name), F.col(key).cast("string"), F.col(count))
    end_text = format_java_timestamp(F.timestamp_seconds(F.col(window)), tz)
    lines = F.array_sort(F.collect_list(F.struct(F.col(rank_name).alias("r"), text.alias("t"))))
    return (top.groupBy(window)
            .agg(lines.alias("_lines"))
            .select(window,
                    F.concat_ws("\n", F.concat(F.lit(header), end_text),
                                F.concat_ws("\n", F.col("_lines.t")), F.lit(rule)).alias("report")))
