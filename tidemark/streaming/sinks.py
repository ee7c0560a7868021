"""Sinks: split outputs, fan-out, keyed upserts (all via ``foreachBatch``).

Every writer is idempotent per ``batch_id`` so that a micro-batch
replayed after a lost executor or driver restart rewrites the same files
instead of adding duplicates.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def path_exists(spark, path: str) -> bool:
    """Existence check through the Hadoop file system of ``path`` (works
    for shared cluster storage, not only local folders)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def batch_path(root: str, batch_id: int) -> str:
    return os.path.join(root, f"batch_id={batch_id}")


def write_batch(root: str, fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """Write each micro-batch to its own folder ``root/batch_id=N``
    (overwrite: a replay of batch N replaces its own output)."""
    def run(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").format(fmt).save(batch_path(root, batch_id))
    return run


def split_by_kind(outputs: dict[str, Callable[[DataFrame, int], None]],
                  kind_col: str = "kind") -> Callable[[DataFrame, int], None]:
    """Route rows to one writer per value of ``kind_col`` (side outputs)."""
    def run(df: DataFrame, batch_id: int) -> None:
        df = df.persist()
        try:
            for kind, write in outputs.items():
                write(df.filter(F.col(kind_col) == kind).drop(kind_col), batch_id)
        finally:
            df.unpersist()
    return run


def fan_out(*writers: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """Send one micro-batch to several writers, computing it once."""
    def run(df: DataFrame, batch_id: int) -> None:
        df = df.persist()
        try:
            for w in writers:
                w(df, batch_id)
        finally:
            df.unpersist()
    return run


def touched_values(df: DataFrame, col: str) -> list:
    """Distinct values of a partition column in one micro-batch (e.g. the
    windows it touched) - a short list that lets the read of stored
    partitions be pruned statically."""
    return [r[0] for r in df.select(col).distinct().collect()]


def upsert_partitions(root: str, keys: Sequence[str], partition_col: str,
                      ) -> Callable[[DataFrame, int], None]:
    """Keyed upsert into a parquet table partitioned by ``partition_col``
    (e.g. ``window_end``): only partitions touched by the batch are
    rewritten (dynamic partition overwrite). The merge of stored and new
    rows is checkpointed (to the shared ``spark.checkpoint.dir``) before
    the rewrite, since the same partitions are read and written. Rows are
    dealt by partition first, so a batch writes a file a partition and not
    one for each of its tasks (not by a rebalance hint: without adaptive
    execution, as in a stateful query's batches, that does nothing). One
    partition's rows are one task's."""
    keys = list(keys)

    def run(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        new = df.persist()
        try:
            touched = touched_values(new, partition_col)
            if path_exists(spark, root):
                old = spark.read.parquet(root).filter(F.col(partition_col).isin(touched))
                kept = old.join(new.select(*keys, partition_col), keys + [partition_col], "left_anti")
                merged = kept.unionByName(new).repartition(F.col(partition_col)).checkpoint(eager=True)
            else:
                merged = new.repartition(F.col(partition_col))
            (merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(partition_col).parquet(root))
        finally:
            new.unpersist()
    return run
