"""Helpers shared by the operators of this subpackage.

Texts reach Python as Arrow batches; the helpers below look at them as one
UTF-8 byte array plus offsets, so word splitting and hashing are numpy
passes over a whole slice of documents instead of loops over strings.
"""

from __future__ import annotations

import os
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidemark.session import ensure_checkpoint_dir

U64 = np.uint64
#: Bytes of text that one numpy pass takes at a time (a longer document is a pass of its own).
SLICE_BYTES = 2 << 20


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    """Reducers of a blob exchange: the session's shuffle partitions (at most 65,536, the finest cut of a hash)."""
    return max(1, min(65536, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def staged(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the shared checkpoint folder and read it back: lineage ends at
    files every executor can read, and later consumers do not repeat the work. Shuffle files of
    what has been written are dropped at once."""
    path = os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def discard(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete staged tables that no later step reads."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for table in tables:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table.staged_path)
        path.getFileSystem(conf).delete(path, True)


def fresh(taken: list[str], *names: str) -> list[str]:
    """The names, each with underscores added until it clashes with none of ``taken``."""
    low, out = {c.lower() for c in taken}, []
    for name in names:
        while name.lower() in low:
            name += "_"
        out.append(name)
    return out


# -- documents as bytes ------------------------------------------------------

def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null has no bytes."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batches, column: str, max_bytes: int = SLICE_BYTES, max_rows: int = 50_000):
    """Cut Arrow batches into slices of at most ``max_bytes`` of text (one longer text stands alone)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, offsets = utf8(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(offsets, offsets[at] + max_bytes, "right")) - 1
            to = min(max(to, at + 1), batch.num_rows, at + max_rows)
            yield batch.slice(at, to - at)
            at = to


def blocks(offsets: np.ndarray, max_bytes: int = 1 << 17):
    """(first, end) of runs of documents of about ``max_bytes``: arrays of that size stay in the CPU's cache."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = min(max(int(np.searchsorted(offsets, offsets[at] + max_bytes, "right")) - 1, at + 1), n)
        yield at, to
        at = to


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
# Odd 64-bit multipliers and byte values drawn once from a fixed seed.
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_BASE = U64(0x9E3779B97F4A7C15)
_STEP = U64(0xD6E8FEB86659FD93)


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix)."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U64(27))
    h = h * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def lowered(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document) of every word ``[^\\x20\\x09-\\x0D]+``; words end with their document."""
    word = ~_SPACE[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    last = word.copy()
    last[:-1] &= ~word[1:]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    first[cut] = word[cut]
    last[cut - 1] = word[cut - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word's bytes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lens = ends - starts
    at = np.concatenate([[0], np.cumsum(lens)])
    pos = np.arange(at[-1]) - np.repeat(at[:-1], lens)
    inside = pos + np.repeat(starts, lens)
    table = powers(_BASE, int(lens.max()))
    return mix(np.add.reduceat(_BYTE[data[inside]] * table[pos], at[:-1]) + lens.astype(np.uint64))


def shingle_hashes(words: np.ndarray, doc: np.ndarray, n_docs: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of every run of ``size`` words; a document with fewer words is one run as a whole."""
    table = powers(_STEP, size)
    n = np.bincount(doc, minlength=n_docs)
    first = np.concatenate([[0], np.cumsum(n)])[:-1]
    hashes, owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if len(words) >= size:
        acc = words[:len(words) - size + 1] * table[0]
        for j in range(1, size):
            acc = acc + words[j:len(words) - size + 1 + j] * table[j]
        whole = doc[:len(acc)] == doc[size - 1:]
        hashes, owner = mix(acc[whole] + U64(size)), doc[:len(acc)][whole]
    short = np.flatnonzero((n > 0) & (n < size))
    if len(short):
        extra = np.zeros(len(short), np.uint64)
        for j in range(size - 1):
            has = n[short] > j
            extra[has] += words[first[short[has]] + j] * table[j]
        hashes = np.concatenate([hashes, mix(extra + n[short].astype(np.uint64))])
        owner = np.concatenate([owner, short])
        order = np.argsort(owner, kind="stable")
        hashes, owner = hashes[order], owner[order]
    return hashes, owner


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one blob: their lengths, then their bytes. The reader names the types."""
    return np.array([a.nbytes for a in arrays], np.int64).tobytes() + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)


def unpack(blob: bytes, *types) -> list[np.ndarray]:
    sizes, at, out = np.frombuffer(blob, np.int64, len(types)), 8 * len(types), []
    for size, kind in zip(sizes, types):
        out.append(np.frombuffer(blob, kind, int(size) // np.dtype(kind).itemsize, at))
        at += int(size)
    return out


def ranges(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Concatenation of arange(start, start + len)."""
    at = np.concatenate([[0], np.cumsum(lens)])
    return np.arange(at[-1]) - np.repeat(at[:-1], lens) + np.repeat(starts, lens)
