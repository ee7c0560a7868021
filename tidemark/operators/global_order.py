"""Patterns over consecutive rows of one global order, spread over tasks by rows.

Rows are dealt by ``repartitionByRange`` on (ts, seq): Spark's own quantile splitters, so every task gets
about as many rows whether they come evenly or all in one minute (or at one instant: the arrival number
splits those too). A task sees its rows in order and finds the matches that lie within it in one Arrow pass.
It also gives its first and last rows (one less than the pattern is long); these edges, a few
rows a task, are put in order once more and complete the matches that cross from one task to the next.

The pass is read once: edges and matches leave it together, since a second reading could be cut at other
places. Nothing runs while the plan is built.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.time import epoch_micros

_MARKS = ("_edge", "_part", "_at", "_size", "_first_ts", "_first_seq", "_first_user")


def _pass(k: int, within_us: int, inclusive: bool, columns: list[str], schema: pa.Schema):
    def marked(table: pa.Table, edge: bool, at: np.ndarray, size: int, first: pa.Table | None) -> list[pa.RecordBatch]:
        n = table.num_rows
        marks = [pa.array(np.full(n, edge)), pa.array(np.full(n, TaskContext.get().partitionId()), pa.int32()), pa.array(at, pa.int64()), pa.array(np.full(n, size), pa.int64())]
        firsts = [first.column(c) if first is not None else pa.nulls(n, schema.field(f"_first_{c}" if c != "_user" else "_first_user").type) for c in ("ts", "seq", "_user")]
        arrays = [*(table.column(c) for c in columns), *marks, *firsts]
        return pa.Table.from_arrays(arrays, schema=schema).combine_chunks().to_batches()

    def run(batches):
        head, tail, seen = None, None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            own = pa.Table.from_batches([batch])
            if head is None:
                head = own.slice(0, k - 1)
            elif head.num_rows < k - 1:
                head = pa.concat_tables([head, own]).slice(0, k - 1)
            table = own if tail is None else pa.concat_tables([tail, own])
            seen += batch.num_rows
            n = table.num_rows
            if n >= k:
                us = table.column("_us").fill_null(0).to_numpy()
                known = table.column("_us").is_valid().to_numpy()
                hit = known[k - 1:] & known[:n - k + 1]
                for j in range(k):
                    hit &= table.column(f"_p{j}").to_numpy()[j:n - k + 1 + j].astype(bool)
                span = us[k - 1:] - us[:n - k + 1]
                at = np.flatnonzero(hit & ((span <= within_us) if inclusive else (span < within_us)))
                if len(at):
                    yield from marked(table.take(pa.array(at + k - 1)), False, at, 0, table.take(pa.array(at)))
            tail = table.slice(max(0, n - k + 1))
        if seen:
            yield from marked(head, True, np.arange(head.num_rows), seen, None)
            from_ = max(seen - tail.num_rows, head.num_rows)  # rows that are not in the head already
            rest = tail.slice(tail.num_rows - (seen - from_))
            if rest.num_rows:
                yield from marked(rest, True, np.arange(from_, seen), seen, None)
    return run


def match_in_order(df: DataFrame, predicates: Sequence[Column], within_us: int, inclusive: bool = False) -> DataFrame:
    """Rows of ``df`` (with ts, seq) that end a match of ``predicates`` on consecutive rows in (ts, seq) order
    whose span is below ``within_us`` (or equal, with ``inclusive``), with first_ts, first_seq and first_user."""
    k = len(predicates)
    has_user = "user_id" in df.columns
    flags = [F.coalesce(p, F.lit(False)).alias(f"_p{j}") for j, p in enumerate(predicates)]
    x = df.select("*", epoch_micros("ts").alias("_us"), (F.col("user_id") if has_user else F.lit(None).cast("long")).alias("_user"), *flags)
    user = x.schema["_user"].dataType.simpleString()
    seq = x.schema["seq"].dataType.simpleString()
    out = x.limit(0).select("*", *(F.lit(None).cast(t).alias(c) for c, t in zip(_MARKS, ("boolean", "int", "long", "long", "timestamp", seq, user)))).schema
    dealt = x.repartitionByRange("ts", "seq").sortWithinPartitions("ts", "seq")
    found = dealt.mapInArrow(_pass(k, within_us, inclusive, x.columns, to_arrow_schema(out)), out)

    # Edges: consecutive if neighbours in one task, or the last row of a task and the first of the next.
    lane = F.when(F.col("_edge"), F.lit(-1)).otherwise(F.pmod(F.xxhash64("seq"), F.lit(1 << 20)))
    w = Window.partitionBy("_lane").orderBy("ts", "seq", "_at")

    def back(c, j):
        return F.lag(c, j).over(w) if j else F.col(c)

    chain = F.col("_edge")
    for j in range(k - 1):
        inside = (back("_part", j) == back("_part", j + 1)) & (back("_at", j) == back("_at", j + 1) + 1)
        across = (back("_part", j) != back("_part", j + 1)) & (back("_at", j) == 0) & (back("_at", j + 1) == back("_size", j + 1) - 1)
        chain = chain & (inside | across)
    for j in range(k):
        chain = chain & back(f"_p{j}", k - 1 - j)
    span = F.col("_us") - back("_us", k - 1)
    chain = chain & (back("_part", k - 1) != F.col("_part")) & ((span <= within_us) if inclusive else (span < within_us))
    y = (found.withColumn("_lane", lane)
         .select("*", F.coalesce(chain, F.lit(False)).alias("_hit"), back("ts", k - 1).alias("_e_ts"),
                 back("seq", k - 1).alias("_e_seq"), back("_user", k - 1).alias("_e_user")))
    y = y.filter(~F.col("_edge") | F.col("_hit"))

    def first(c):
        return F.when(F.col("_edge"), F.col(f"_e_{c}")).otherwise(F.col(f"_first_{c}")).alias(f"first_{c}")

    return y.select(*df.columns, first("ts"), first("seq"), first("user"))
