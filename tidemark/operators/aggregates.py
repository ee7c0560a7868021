"""Window aggregates: counts, exact distinct, hashed-bitmap distinct."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import BITMAP_BITS, BITMAP_HASH_SEED, bitmap_mask, bitmap_word, poly_hash
from ..functions.time import col_, epoch_seconds


def _tumbling(ts: str, size_s: int):
    return F.window(col_(ts), f"{size_s} seconds").alias("w")


def _bounds():
    return [epoch_seconds(F.col("w.start")).alias("window_start"),
            epoch_seconds(F.col("w.end")).alias("window_end")]


def distinct_count(df: DataFrame, ts: str, value: str, size_s: int,
                   keys: Sequence[str] = (), name: str = "uv_count") -> DataFrame:
    """Exact distinct ``value`` per tumbling window (batch).

    Planned as two aggregations (window, keys, value) -> (window, keys),
    both with map-side partial aggregation, so a window holding most rows
    still leaves each task with its own slice of values.
    """
    return (df.groupBy(_tumbling(ts, size_s), *keys)
            .agg(F.countDistinct(value).alias(name))
            .select(*_bounds(), *keys, name))


def distinct_count_chained(df: DataFrame, ts: str, value: str, size_s: int,
                           keys: Sequence[str] = (), name: str = "uv_count") -> DataFrame:
    """Exact distinct as a chain of two counts; the only exact form a
    streaming query accepts (append mode, watermark required upstream)."""
    first = df.groupBy(_tumbling(ts, size_s), *keys, value).agg(F.count(F.lit(1)).alias("_n"))
    return (first.groupBy("w", *keys).agg(F.count(F.lit(1)).alias(name))
            .select(*_bounds(), *keys, name))


def bitmap_offset(value: str, seed: int = BITMAP_HASH_SEED, bits: int = BITMAP_BITS):
    return poly_hash(value, seed, bits)


def bitmap_distinct_count(df: DataFrame, ts: str, value: str, size_s: int,
                          keys: Sequence[str] = (), name: str = "uv_count",
                          seed: int = BITMAP_HASH_SEED, bits: int = BITMAP_BITS) -> DataFrame:
    """Visitors per window counted as set bits of a hashed bitmap.

    offset = poly_hash(str(value)) mod 2**bits, one hash function, so two
    values with the same offset count once (as in a one-hash Bloom bitmap).
    The bitmap is kept as the 64-bit words that hold a set bit, one row
    (window, word, bits) OR-merged with map-side partial aggregation: a
    sparse window moves one row per visitor, as the exact count does, a
    dense one a row per 64 offsets, and no buffer is ever larger than a row.
    """
    off = bitmap_offset(value, seed, bits)
    words = (df.select(_tumbling(ts, size_s), *keys, off.alias("_o"))
             .groupBy("w", *keys, bitmap_word("_o").alias("_word"))
             .agg(F.bit_or(bitmap_mask("_o")).alias("_bits")))
    return (words.groupBy("w", *keys)
            .agg(F.coalesce(F.sum(F.bit_count("_bits")), F.lit(0)).cast("long").alias(name))
            .select(*_bounds(), *keys, name))


def approx_distinct_count(df: DataFrame, ts: str, value: str, size_s: int,
                          keys: Sequence[str] = (), name: str = "uv_count",
                          rsd: float = 0.01) -> DataFrame:
    """HyperLogLog++ estimate; accepted by streaming queries in any mode."""
    return (df.groupBy(_tumbling(ts, size_s), *keys)
            .agg(F.approx_count_distinct(value, rsd).alias(name))
            .select(*_bounds(), *keys, name))
