"""Detection operators over ordered event histories (batch).

* ``match_sequence`` - strict chain of predicates on consecutive rows
  within a time bound (login-failure pair, sequence pattern).
* ``fail_pairs``     - two consecutive failures of a key, bound inclusive.
* ``fail_sequences`` - pattern ``fail`` then immediately ``fail`` within
  a strict bound, keyed or across all keys.
* ``fail_bursts``    - failure groups anchored at their first failure.
* ``click_cap``      - per-day click cap with a single warning.

Consecutive rows of a key are found with ``with_neighbors``, in (user, time bucket)
partitions, those of the whole stream in range partitions - so no key is ever
forced into one task, and a crowded minute is not either.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import (BURST_MESSAGE, CLICK_CAP_MESSAGE, PAIR_MESSAGE, SEQUENCE_MESSAGE,
                              window_seconds_text)
from ..functions.time import MICROS_PER_SECOND, day_index, epoch_micros
from .bursts import SPAN, burst_groups
from .global_order import match_in_order
from .ordered import number_bucket, time_bucket, with_neighbors

# A key is windowed per bucket of this many seconds: its share of one
# task is its rate times the bucket; its summary holds one row per touched
# bucket. Pass a smaller bucket for very dense keys.
DEFAULT_BUCKET_SECONDS = 60
DEFAULT_BUCKET_ROWS = 1 << 20


def _order(order: str, bucket_seconds: int, bucket_rows: int,
           arrival: Sequence[str] = ("seq",)):
    if order == "event":
        return ["ts", "seq"], time_bucket("ts", bucket_seconds)
    if order == "arrival":
        return list(arrival), number_bucket(arrival[0], bucket_rows)
    raise ValueError("order must be 'event' or 'arrival'")


def match_sequence(df: DataFrame, keys: Sequence[str], predicates: Sequence[Column],
                   within_s: float, inclusive: bool = False, order: str = "event",
                   bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
                   bucket_rows: int = DEFAULT_BUCKET_ROWS,
                   arrival: Sequence[str] = ("seq",)) -> DataFrame:
    """Rows ending a strict-contiguity match of ``predicates`` (p0 on the
    row k-1 places back, ..., p_{k-1} on this row) whose span from the
    first row is below ``within_s`` (or equal, with ``inclusive``).

    Adds ``first_ts``, ``first_user`` (id column of the first row, for
    matches across keys) and ``first_seq`` to the last row of each match.
    One neighbour pass per link of the chain; without keys one pass over range
    partitions (``global_order``).
    """
    if len(predicates) < 2:
        raise ValueError("a sequence needs at least two predicates")
    if not keys and order == "event":
        return match_in_order(df, predicates, int(round(within_s * MICROS_PER_SECOND)), inclusive)
    order_cols, bucket = _order(order, bucket_seconds, bucket_rows, arrival)
    id_col = "user_id" if "user_id" in df.columns else None
    x = df.select("*", predicates[0].alias("_ok"), F.col("ts").alias("_first_ts"),
                  F.col("seq").alias("_first_seq"),
                  (F.col(id_col) if id_col else F.lit(None)).alias("_first_user"))
    carried = ["_ok", "_first_ts", "_first_seq", "_first_user"]
    for i, p in enumerate(predicates[1:]):
        if i:  # later links read the previous link's output twice: materialise it
            x = x.checkpoint(eager=True)
        x = with_neighbors(x, keys, order_cols, bucket, lag=carried)
        base = [c for c in x.columns if c not in carried and not c.startswith("prev_")]
        x = x.select(*base, (p & F.coalesce(F.col("prev__ok"), F.lit(False))).alias("_ok"),
                     *[F.col(f"prev_{c}").alias(c) for c in carried[1:]])
    span = epoch_micros("ts") - epoch_micros("_first_ts")
    bound = F.lit(int(round(within_s * MICROS_PER_SECOND)))
    hit = F.col("_ok") & ((span <= bound) if inclusive else (span < bound))
    keep = [c for c in x.columns if c not in carried]
    return x.filter(hit).select(*keep, *[F.col(c).alias(c[1:]) for c in carried[1:]])


def fail_pairs(logins: DataFrame, within_s: float = 2, max_fails: int = 2, order: str = "event",
               keys: Sequence[str] = ("user_id",), bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
               bucket_rows: int = DEFAULT_BUCKET_ROWS,
               arrival: Sequence[str] = ("seq",)) -> DataFrame:
    """Two consecutive failures of a user with last - first <= within.

    ``order='arrival'`` follows input order (``arrival`` columns, default
    ``seq``; the first must be numeric), where a failure that arrives
    after a later one yields a negative span and also warns.
    Returns user_id, first_fail_ts, last_fail_ts, warning_msg.
    """
    is_fail = F.col("state") == "fail"
    m = match_sequence(logins, keys, [is_fail, is_fail], within_s, inclusive=True, order=order,
                       bucket_seconds=bucket_seconds, bucket_rows=bucket_rows, arrival=arrival)
    msg = PAIR_MESSAGE.format(max=max_fails, s=window_seconds_text(within_s))
    return m.select("user_id", F.col("first_ts").alias("first_fail_ts"),
                    F.col("ts").alias("last_fail_ts"), F.lit(msg).alias("warning_msg"))


def fail_sequences(logins: DataFrame, within_s: float = 2, keyed: bool = True,
                   bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """Pattern: a failure, then immediately a failure, span < within.

    ``keyed=False`` matches over the whole stream in event-time order, so
    a pair may join two users; the warning carries the first user's id.
    """
    is_fail = F.col("state") == "fail"
    keys = ["user_id"] if keyed else []
    m = match_sequence(logins, keys, [is_fail, is_fail], within_s, inclusive=False,
                       bucket_seconds=bucket_seconds)
    msg = SEQUENCE_MESSAGE.format(s=window_seconds_text(within_s))
    return m.select(F.col("first_user").alias("user_id"), F.col("first_ts").alias("first_fail_ts"),
                    F.col("ts").alias("last_fail_ts"), F.lit(msg).alias("warning_msg"))


def fail_bursts(logins: DataFrame, within_s: float = 2, min_fails: int = 2,
                span: int = SPAN) -> DataFrame:
    """Failure bursts per user in (ts, seq) order.

    The first failure at t0 opens a group; failures with ts <= t0 + within
    join it; a success after t0 and at or before t0 + within cancels it;
    otherwise the group is emitted (if it holds >= ``min_fails``) and the
    next failure opens a new group. ``(user_id, seq)`` must identify a row.

    Plan: transfer tables over buckets of ``span`` times the bound, see
    ``bursts``; runs of any length take the same way.
    """
    groups = burst_groups(logins, int(round(within_s * MICROS_PER_SECOND)), min_fails, span)
    msg = F.format_string(BURST_MESSAGE.format(n="%d", s=window_seconds_text(within_s)),
                          F.col("fail_count"))
    return groups.select("user_id", F.timestamp_micros("first_us").alias("first_fail_ts"),
                         F.timestamp_micros("last_us").alias("last_fail_ts"), "fail_count",
                         msg.alias("warning_msg"))


def click_cap(clicks: DataFrame, max_clicks: int = 100, keys: Sequence[str] = ("user_id", "ad_id"),
              day_tz: str = "UTC") -> tuple[DataFrame, DataFrame]:
    """Per (keys, calendar day): the first ``max_clicks + 1`` clicks pass,
    the next one raises the single warning, later ones are dropped.

    ``row_number() <= max+2`` is planned with a partial ``WindowGroupLimit``
    ahead of the exchange: a (user, ad, day) holding a third of all rows
    ships at most max+2 rows per map task. Returns (passed, warnings).
    """
    w = Window.partitionBy(*keys, "_day").orderBy("ts", "seq")
    ranked = (clicks.withColumn("_day", day_index("ts", day_tz))
              .withColumn("click_no", F.row_number().over(w))
              .filter(F.col("click_no") <= max_clicks + 2))
    passed = ranked.filter(F.col("click_no") <= max_clicks + 1).drop("_day", "click_no")
    warnings = (ranked.filter(F.col("click_no") == max_clicks + 2)
                .select(*keys, "ts", F.lit(CLICK_CAP_MESSAGE.format(max=max_clicks)).alias("msg")))
    return passed, warnings
