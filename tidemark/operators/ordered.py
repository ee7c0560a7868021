"""Neighbour values along an order, without one task per key.

A plain ``lag(x) over (partition by user order by ts)`` sends every row of
a user to one task: a user holding a third of all rows stalls the job.
``with_neighbors`` partitions by (keys, bucket), for every key alike and
null keys included, where ``bucket`` is a
coarse, non-decreasing function of the order (a time bucket, or an
arrival-number bucket). Inside a bucket the window functions run as
usual; the rows at bucket edges are completed from a per-bucket summary
(one row per key and bucket, aggregated map-side from the input) ordered
by bucket. A hot key is thereby spread over all of its buckets; only the
summary - bounded by the number of touched buckets, not rows - is ordered
per key. The input is shuffled in full once (for the bucket windows); the
summary is a second, pruned read of the input.

Callers that chain passes should materialise the input of a later pass
(``checkpoint``), as each pass reads its input twice.

Outputs, per requested column ``c``:

* ``prev_c``  - value on the previous row of the same key (lag)
* ``next_c``  - value on the next row of the same key (lead)
* ``ffill_c`` - last non-null value at or before this row
* ``pmax_c``  - maximum over all earlier rows of the same key
* ``bfill_c`` - first non-null value at or after this row
* ``prior_count`` (name given) - number of earlier rows of the same key
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.time import MICROS_PER_SECOND, epoch_micros, floor_div

_UNB = Window.unboundedPreceding
_UNF = Window.unboundedFollowing


def time_bucket(ts: str, bucket_seconds: int) -> Column:
    return floor_div(epoch_micros(ts), bucket_seconds * MICROS_PER_SECOND)


def number_bucket(col: str, bucket_rows: int) -> Column:
    return floor_div(F.col(col).cast("long"), bucket_rows)


def _filler(dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return F.lit("")
    if isinstance(dtype, T.BooleanType):
        return F.lit(False)
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.lit(0).cast("timestamp").cast(dtype)
    if isinstance(dtype, T.NumericType):
        return F.lit(0).cast(dtype)
    raise TypeError(f"with_neighbors keys must be atomic, got {dtype.simpleString()}")


def with_neighbors(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column,
                   lag: Sequence[str] = (), lead: Sequence[str] = (), ffill: Sequence[str] = (),
                   prior_max: Sequence[str] = (), bfill: Sequence[str] = (),
                   prior_count: str | None = None) -> DataFrame:
    """``df`` with the neighbour columns asked for; no keys: one global order.
    One plan for all keys; nothing runs while it is built."""
    keys, order = list(keys), list(order)
    # Null-free key columns (is-null flag + filled value): the windows and
    # the edge join then use the very same plain columns, so the join reuses
    # the windows' partitioning instead of re-shuffling the input for a
    # null-safe join.
    kcols = []
    for i, c in enumerate(keys):
        kcols += [F.col(c).isNull().alias(f"_kn{i}"),
                  F.coalesce(F.col(c), _filler(df.schema[c].dataType)).alias(f"_kv{i}")]
    part = [f"_kn{i}" for i in range(len(keys))] + [f"_kv{i}" for i in range(len(keys))] + ["_bkt"]
    w = Window.partitionBy(*part).orderBy(*order)
    x = df.select("*", *kcols, bucket.alias("_bkt"))
    inner = [F.lag(c).over(w).alias(f"prev_{c}") for c in lag]
    inner += [F.lead(c).over(w).alias(f"next_{c}") for c in lead]
    inner += [F.last(c, ignorenulls=True).over(w.rowsBetween(_UNB, 0)).alias(f"ffill_{c}")
              for c in ffill]
    inner += [F.max(c).over(w.rowsBetween(_UNB, -1)).alias(f"pmax_{c}") for c in prior_max]
    inner += [F.first(c, ignorenulls=True).over(w.rowsBetween(0, _UNF)).alias(f"bfill_{c}")
              for c in bfill]
    if prior_count:
        inner.append((F.row_number().over(w) - 1).cast("long").alias(prior_count))
    if lag:
        inner.append(F.lag(F.lit(1)).over(w).isNull().alias("_is_first"))
    if lead:
        inner.append(F.lead(F.lit(1)).over(w).isNull().alias("_is_last"))
    main = x.select("*", *inner)

    # Per (keys, bucket) summary straight from the input: aggregates with
    # map-side partial aggregation, so only about one row per (key, bucket)
    # and task is shuffled, and the input is shuffled in full only once.
    ordkey = F.struct(*order)
    aggs = []
    if lag:
        aggs.append(F.max_by(F.struct(*lag), ordkey).alias("_tail"))
    if lead:
        aggs.append(F.min_by(F.struct(*lead), ordkey).alias("_head"))
    aggs += [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), ordkey)).alias(f"_lnn_{c}")
             for c in ffill]
    aggs += [F.max(c).alias(f"_bmax_{c}") for c in prior_max]
    aggs += [F.min_by(F.col(c), F.when(F.col(c).isNotNull(), ordkey)).alias(f"_fnn_{c}")
             for c in bfill]
    if prior_count:
        aggs.append(F.count(F.lit(1)).alias("_cnt"))
    summary = x.groupBy(*part).agg(*aggs)

    kpart = part[:-1]
    w2 = Window.partitionBy(*kpart).orderBy("_bkt") if kpart else Window.orderBy("_bkt")
    before = w2.rowsBetween(_UNB, -1)
    sel = [F.col(c).alias(f"_s_{c}") for c in part]
    if lag:
        sel.append(F.lag("_tail").over(w2).alias("_prev_tail"))
    if lead:
        sel.append(F.lead("_head").over(w2).alias("_next_head"))
    sel += [F.last(f"_lnn_{c}", ignorenulls=True).over(before).alias(f"_pf_{c}") for c in ffill]
    sel += [F.max(f"_bmax_{c}").over(before).alias(f"_pm_{c}") for c in prior_max]
    sel += [F.first(f"_fnn_{c}", ignorenulls=True).over(w2.rowsBetween(1, _UNF)).alias(f"_pb_{c}")
            for c in bfill]
    if prior_count:
        sel.append(F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_pc"))
    edges = summary.select(*sel).repartition(*[f"_s_{c}" for c in part])

    cond = [main[c] == edges[f"_s_{c}"] for c in part]
    y = main.join(edges, on=cond, how="inner")
    fixed = {}
    for c in lag:
        fixed[f"prev_{c}"] = F.when(F.col("_is_first"), F.col(f"_prev_tail.{c}")).otherwise(
            F.col(f"prev_{c}"))
    for c in lead:
        fixed[f"next_{c}"] = F.when(F.col("_is_last"), F.col(f"_next_head.{c}")).otherwise(
            F.col(f"next_{c}"))
    for c in ffill:
        fixed[f"ffill_{c}"] = F.coalesce(F.col(f"ffill_{c}"), F.col(f"_pf_{c}"))
    for c in prior_max:
        fixed[f"pmax_{c}"] = F.greatest(F.col(f"pmax_{c}"), F.col(f"_pm_{c}"))
    for c in bfill:
        fixed[f"bfill_{c}"] = F.coalesce(F.col(f"bfill_{c}"), F.col(f"_pb_{c}"))
    if prior_count:
        fixed[prior_count] = (F.col(prior_count) + F.col("_pc")).cast("long")
    out = list(df.columns) + list(fixed)
    return y.select(*[fixed[c].alias(c) if c in fixed else F.col(c) for c in out])
