"""Approximate nearest neighbours (largest inner product) by a permutation index.

Vectors may have any norms: each is indexed with one more component, sqrt(M^2 - |v|^2) with M the largest
norm, and a query with 0 there, so that the order by angle is the order by inner product.

Pivots are vectors drawn from the rows, PIVOTS at most. A vector is represented by its LENGTH nearest
pivots in order, with its place in the files of these pivots. Vectors are cut into blocks of about
BLOCK by a hash, each block with files of its own. A query opens the files of its own pivots: two
orders are the nearer by Spearman's footrule (a pivot missing on one side counts as position LENGTH)
the larger the sum of LENGTH - max(place, place) over the pivots they share, so adding that up over the
files ranks the block (a file is a row of the block, read whole). The nearest SHARE of it (LEAST at the least) is reranked by the exact inner product
in double precision, and a (query, block) pair gives back at most k + 1 rows (ties: the smaller smallest vec_id).

The stated query set meets all rows in blocks: a task holds one block and one chunk of at most about
CHUNK queries, so its memory does not depend on the table. Equal vectors are one: index and queries
hold distinct vectors, and of the ids of an equal vector only the k + 1 smallest can be among
anyone's k nearest, so a vector that a third of all rows share is no hot key.

Every row is indexed. Recall against brute force is measured in the tests, on equal and on widely
unequal norms, and 0.9 or more: without
structure in 64 dimensions, orders of 256 pivots are what it takes.

Defined cases: null, empty or zero vectors, and those with a null or non-finite component, take no
part, neither do null ids; vectors of another length than the first pivot's neither. Rows that repeat
an id and vector count once. Fewer candidates than k: all. No rows: empty result. Other columns are
not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import staged

PIVOTS, LENGTH = 256, 96
BLOCK, CHUNK = 4096, 8192
SHARE, LEAST = 0.12, 256


def usable(vector):
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0)


def lengthened(matrix: np.ndarray, bound: float | None) -> np.ndarray:
    """Rows with one more component that brings them to the squared norm ``bound``; 0 for queries (None)."""
    last = np.zeros(len(matrix)) if bound is None else np.sqrt(np.maximum(0.0, bound - (matrix * matrix).sum(1)))
    return np.column_stack([matrix, last])


def orders(matrix: np.ndarray, pivots: np.ndarray, length: int) -> np.ndarray:
    """The nearest pivots of each row, nearest first (ties: smaller pivot)."""
    unit = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.argsort(-(unit @ pivots.T), axis=1, kind="stable")[:, :length].astype(np.int16)


class Files:
    """Files of a block, a row a pivot: how far before the end each vector's order holds it (0: not at all)."""

    def __init__(self, order: np.ndarray, n_pivots: int):
        self.n, self.length = order.shape
        self.held = np.zeros((n_pivots, self.n), np.int16)
        self.held[order.T, np.arange(self.n)] = np.arange(self.length, 0, -1)[:, None]

    def closeness(self, order: np.ndarray) -> np.ndarray:
        """Largest footrule distance less the distance, halved, of one query's order to every vector's."""
        own = np.arange(self.length, self.length - len(order), -1, np.int16)[:, None]
        return np.minimum(self.held[order], own).sum(0, dtype=np.int32).astype(np.float64)


def _arrays(column) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


def _represent(pivots: np.ndarray, bound: float | None):
    """(name, low, v) -> with the vector's order and its bytes; ``bound`` as in ``lengthened``."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                matrix = _arrays(batch.column(2))
                order = orders(lengthened(matrix, bound), pivots, LENGTH)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array([x.tobytes() for x in order], pa.binary()), pa.array([x.tobytes() for x in matrix], pa.binary())],
                    names=["name", "low", "ord", "vec"])
    return run


def _side(table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    name = table.column("name").to_numpy()
    return (name, table.column("low").to_numpy(), np.frombuffer(b"".join(table.column("ord").to_pylist()), np.int16).reshape(len(name), -1),
            np.frombuffer(b"".join(table.column("vec").to_pylist()), np.float64).reshape(len(name), -1))


def _search(k: int, n_pivots: int):
    """A block and a chunk of queries -> the block's nearest of each query."""
    def run(key, left, right):
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float64))]
        if left.num_rows and right.num_rows:
            name, low, order, matrix = _side(left)
            files = Files(order, n_pivots)
            most = min(len(name), max(LEAST, int(SHARE * len(name))))
            for q, _, q_order, q_vector in zip(*_side(right)):
                some = np.argpartition(-files.closeness(q_order), most - 1)[:most] if most < len(name) else np.arange(len(name))
                score = matrix[some] @ q_vector
                best = np.lexsort((name[some], low[some], -score))[:k + 1]
                found.append((np.full(len(best), q), name[some][best], score[best]))
        return pa.table(dict(zip(("query", "name", "score"), (pa.array(np.concatenate(x)) for x in zip(*found)))))
    return run


def nearest(spark: SparkSession, vectors: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    """vectors (vec_id, embedding) -> (query_id, rank, vec_id, score); queries are the rows whose id
    is divisible by ``every``, candidates every row but the query's own."""
    vector = F.transform("embedding", lambda x: x.cast("double"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("v")).where(F.col("vec_id").isNotNull() & usable(F.col("v")))
    rows = staged(spark, rows.withColumn("name", F.xxhash64("v")), "ann-rows")
    first = rows.select(F.size("v").alias("n")).groupBy("n").count().orderBy(F.desc("count"), "n").first()
    if first is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.size("v") == first["n"])
    distinct = rows.groupBy("name").agg(F.min_by("v", "vec_id").alias("v"), F.min("vec_id").alias("low"))
    distinct = staged(spark, distinct, "ann-vectors")
    squares = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    n, bound = distinct.agg(F.count("*"), F.max(squares)).first()
    sample = [r["v"] for r in distinct.orderBy(F.xxhash64("name", F.lit(7)), "name").select("v").limit(PIVOTS).collect()]
    pivots = lengthened(np.array(sample, np.float64), bound)
    pivots /= np.linalg.norm(pivots, axis=1, keepdims=True)
    asked = rows.where(F.col("vec_id") % every == 0).select("name").distinct().join(distinct, "name")
    blocks, chunks = max(1, -(-n // BLOCK)), max(1, -(-n // every // CHUNK))
    shape = "name long, low long, ord binary, vec binary"
    index = distinct.select("name", "low", "v").mapInArrow(_represent(pivots, bound), shape).withColumn("block", F.pmod(F.xxhash64("name", F.lit(1)), F.lit(blocks)))
    index = index.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))))
    asked = asked.select("name", "low", "v").mapInArrow(_represent(pivots, None), shape).withColumn("chunk", F.pmod(F.xxhash64("name", F.lit(2)), F.lit(chunks)))
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    found = index.groupBy("block", "chunk").cogroup(asked.groupBy("block", "chunk")).applyInArrow(_search(k, len(pivots)), "query long, name long, score double")
    found = staged(spark, found, "ann-found")
    return _answer(rows, found, k, every)


def _answer(rows: DataFrame, found: DataFrame, k: int, every: int) -> DataFrame:
    """Nearest vectors of distinct query vectors -> nearest ids of every query row."""
    by_name = Window.partitionBy("name").orderBy("vec_id")
    ids = rows.select("name", "vec_id").distinct().withColumn("r", F.row_number().over(by_name)).where(F.col("r") <= k + 1)
    top = Window.partitionBy("query").orderBy(F.desc("score"), "low", "name")
    low = ids.where("r = 1").select("name", F.col("vec_id").alias("low"))
    best = found.groupBy("query", "name").agg(F.max("score").alias("score")).join(low, "name")
    best = best.withColumn("t", F.row_number().over(top)).where(F.col("t") <= k + 1).select("query", "name", "score")
    near = best.join(ids.select("name", "vec_id"), "name")  # at most (k + 1)^2 rows a distinct query
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    near = near.withColumn("t", F.row_number().over(order)).where(F.col("t") <= k + 1).groupBy("query").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))).alias("near"))
    queries = rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), F.col("name").alias("query")).distinct()
    own = queries.join(near, "query").select("query_id", F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k).alias("near"))
    flat = own.select("query_id", F.posexplode("near").alias("pos", "x"))
    return flat.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.s")).alias("score"))
