"""Run a streaming query over a stored table, one micro-batch per cut.

The table is cut along an order column into files that a file stream reads: cut 0 is written, the query
runs until it has read it (``availableNow``) and stops, then cut 1, and so on, each run taking up the
query's checkpoint. So the order of arrival is that of the cuts by construction and every cut but the first
is a restart. Closing rows, far in the future, come last: a stream has no end-of-input flush, they push the
watermark past all windows. When ``replay`` returns nothing is left running.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import checkpoint_path

NOW = {"availableNow": True}
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _stream_session(spark: SparkSession) -> SparkSession:
    """A session of the same application whose settings are the streams' own."""
    own = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled",
                "spark.sql.execution.arrow.pyspark.enabled"):
        own.conf.set(key, spark.conf.get(key))
    own.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)
    return own


def replay(table: DataFrame, order: Column, start: Callable[[DataFrame, str, str], StreamingQuery],
           cuts: int = 3, closing: Sequence[DataFrame] = (), near: tuple[str, int] | None = None,
           fmt: str = "parquet", read: Callable[[SparkSession, str], DataFrame] | None = None) -> str:
    """``start(stream, root, name)`` starts the query with ``trigger=NOW`` on a stream of ``table``'s rows
    and writes below ``root``; returns ``root``.

    ``order`` is a number that rises with arrival. ``near`` = (column, slack): a stored column that
    ``order`` exceeds by 0 to ``slack``, so that a cut's scan is pruned by the column's statistics.
    ``read`` opens the stream over the folder (default: files of ``fmt`` with the table's schema)."""
    spark = _stream_session(table.sparkSession)
    name = f"replay_{uuid.uuid4().hex}"
    root = checkpoint_path(table.sparkSession, f"replays/{name}")
    source = os.path.join(root, "source")
    low, high = table.agg(F.min(order), F.max(order)).first()
    low, high = (0, 0) if low is None else (int(low), int(high))
    step = (high - low) // cuts + 1
    parts = []
    for i in range(cuts):
        a, b = low + i * step, low + (i + 1) * step
        inside = (order >= a) & (order < b)
        if near:
            inside = inside & F.col(near[0]).between(a - near[1], b)
        parts.append(table.filter(inside))

    def files(s: SparkSession, folder: str) -> DataFrame:
        return s.readStream.schema(table.schema).format(fmt).load(folder)

    for part in [*parts, *closing]:
        part.write.mode("append").format(fmt).save(source)
        query = start((read or files)(spark, source), os.path.join(root, "result"), name)
        query.awaitTermination()
    return os.path.join(root, "result")
