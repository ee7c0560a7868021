"""Target-distribution importance resampling with hashed n-grams.

Documents are weighed by how much likelier their n-grams are in a target corpus than in the raw one, and
a share of them is drawn without replacement by the weights (Gumbel top-k).

- Features: a text is normalised (A-Z lower-cased; words are runs of digits, a-z and characters beyond
  ASCII; one space after each) and scanned once, which leaves the running CRC-32 before each word. The
  CRC of any n-gram then is CRC(before its end) xor shift(CRC(before its start)): appending k bytes acts on
  a CRC as a linear map over GF(2), tabulated by k (``Shifts``), that cancels all that came before. Its
  remainder by ``buckets`` is the feature.
- Counts: a task sums the features of its documents to one row a bucket, so a hot word is one row a task.
- Gains: floor(1000 ln((t+1)(S+buckets) / ((s+1)(T+buckets)))) by bucket. They are ``buckets`` whole
  numbers, a parameter and not a measure of the corpus, and go to the tasks with the code.
- Weight: floored mean of the gains of a document's features. Score: weight plus Gumbel noise in
  thousandths, drawn from sha256 of the seed and the id.
- Draw: scores are whole numbers of a bounded range (some 80,000 values: logarithms of counts and of a
  32-bit draw, times 1000). Their histogram gives the least score drawn and how many rows lie above each
  score; only rows at or above it are ranked, within equal scores. No global sort, no single task.

Defined cases: null and empty texts have no features and weight 0. A null id has no score and takes no
part in the draw, but counts in the corpus. Equal scores go to the smaller id; rows that repeat are drawn
one by one. Empty documents: empty result; an empty target: gains are those of counts of 0.
Other columns pass through.
"""

from __future__ import annotations

import math
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.llm.common import fresh, slices, staged, utf8

BUCKETS = 10_000
#: Words of the shortest and the longest n-gram; least words of a document that may be drawn; percent drawn; seed of the noise.
NGRAMS = (1, 1)
LEAST_WORDS, PERCENT, SEED = 20, 10, 2024
SLICE = 1 << 20
_U32 = np.uint32
# Each byte of a text as the normalised text has it.
_NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_STEP = np.array([crc32(bytes([b])) ^ crc32(b"\0") for b in range(256)], _U32)  # one byte's part in a CRC; linear, so it is the table of the CRC
_SPACE = _U32(crc32(b" "))


class Shifts:
    """What ``k`` further bytes do to a CRC: a linear map, as four tables of 256 entries."""

    NEAR = 64

    def __init__(self):
        ident = np.arange(256, dtype=np.uint32)
        table = np.stack([ident << _U32(8 * j) for j in range(4)])
        near = [table]
        for _ in range(self.NEAR - 1):
            table = (table >> _U32(8)) ^ _STEP[table & _U32(255)]
            near.append(table)
        self.near = np.stack(near)  # k, byte of the CRC, its value
        self.far = [(table >> _U32(8)) ^ _STEP[table & _U32(255)]]  # by 64, 128, 256, ... bytes
        self.before = np.zeros(256, np.uint32)  # by the highest byte of a CRC: the lowest before its last byte
        self.before[_STEP >> _U32(24)] = ident

    @staticmethod
    def apply(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
        return table[0][crc & _U32(255)] ^ table[1][(crc >> _U32(8)) & _U32(255)] ^ table[2][(crc >> _U32(16)) & _U32(255)] ^ table[3][crc >> _U32(24)]

    def by(self, crc: np.ndarray, k: np.ndarray) -> np.ndarray:
        low = k % self.NEAR
        out = np.zeros(len(crc), np.uint32)
        for j in range(4):
            out ^= self.near[low, j, (crc >> _U32(8 * j)) & _U32(255)]
        high, m = k // self.NEAR, 0
        while (bit := np.flatnonzero(high >> m)).size:
            if m == len(self.far):
                self.far.append(self.apply(self.far[-1], self.far[-1].ravel()).reshape(4, 256))
            bit = bit[(high[bit] >> m) & 1 == 1]
            out[bit] = self.apply(self.far[m], out[bit])
            m += 1
        return out

    def back(self, crc: np.ndarray) -> np.ndarray:
        """The inverse of one byte's shift."""
        low = self.before[crc >> _U32(24)]
        return ((crc ^ _STEP[low]) << _U32(8)) | low


def ngram_crcs(texts: list[bytes], ngrams: tuple[int, int], shifts: Shifts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(CRC-32, text) of every n-gram, and the number of words of each text."""
    def scan(crc: int, piece: bytes) -> int:
        return crc32(piece, crc)

    count, lens, running = [], [], []
    for text in texts:
        words = text.translate(_NORMAL).split()
        count.append(len(words))
        lens.extend(map(len, words))
        running.extend(accumulate([w + b" " for w in words], scan, initial=0))
    count, size = np.array(count, np.int64), np.array(lens, np.int64)
    doc = np.repeat(np.arange(len(texts)), count)
    crc = np.array(running, np.uint32)
    at = np.arange(len(doc)) + doc  # a text has one running CRC more than words
    start, end = crc[at], shifts.back(crc[at + 1] ^ _SPACE)
    until = np.cumsum(size + 1)
    crcs, owner = [], []
    for n in range(ngrams[0], ngrams[1] + 1):
        k = max(0, len(doc) - n + 1)
        i = np.flatnonzero(doc[:k] == doc[n - 1:])
        j = i + n - 1
        crcs.append(end[j] ^ shifts.by(start[i], until[j] - until[i] + size[i]))
        owner.append(doc[i])
    return np.concatenate(crcs), np.concatenate(owner), count


def _texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    data, offsets = utf8(batch.column(batch.schema.get_field_index(column)))
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]


def bucket_counts(texts: DataFrame, ngrams=NGRAMS, buckets: int = BUCKETS, column: str = "text") -> DataFrame:
    """(bucket, n): n-grams of all texts by bucket, none for a bucket without any."""
    def count(batches):
        total, shifts = np.zeros(buckets, np.int64), Shifts()
        for batch in slices(batches, column, SLICE):
            crcs, _, _ = ngram_crcs(_texts(batch, column), ngrams, shifts)
            total += np.bincount(crcs % _U32(buckets), minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    return texts.select(column).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Two tables of bucket counts -> the gain of each bucket."""
    both = raw.select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t")).unionByName(target.select("bucket", F.lit(0).cast("long").alias("s"), F.col("n").alias("t")))
    held = np.zeros((buckets, 2))
    for bucket, s, t in both.groupBy("bucket").agg(F.sum("s"), F.sum("t")).collect():  # at most ``buckets`` rows
        held[bucket] = s, t
    s_all, t_all = held.sum(0).tolist()
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + buckets) / ((s + 1) * (t_all + buckets)))) for s, t in held.tolist()], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, ngrams=NGRAMS, column: str = "text", names=("n_features", "n_words", "weight")) -> DataFrame:
    """``docs`` with, instead of ``column``, its numbers of features and words and its weight."""
    from pyspark.sql.pandas.types import to_arrow_schema

    out = StructType([f for f in docs.schema.fields if f.name != column] + StructType.fromDDL(", ".join(f"`{n}` long" for n in names)).fields)
    schema = to_arrow_schema(out)

    def run(batches):
        shifts = Shifts()
        for batch in slices(batches, column, SLICE):
            crcs, owner, count = ngram_crcs(_texts(batch, column), ngrams, shifts)
            total = np.zeros(batch.num_rows, np.int64)
            np.add.at(total, owner, gain[crcs % _U32(len(gain))])
            n = np.bincount(owner, minlength=batch.num_rows)
            rest = [c for name, c in zip(batch.schema.names, batch.columns) if name != column]
            yield pa.RecordBatch.from_arrays([*rest, *(pa.array(x.astype(np.int64)) for x in (n, count, np.where(n > 0, total // np.maximum(n, 1), 0)))], schema=schema)

    return docs.mapInArrow(run, out)


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, from the first 32 bits of sha256("seed:id")."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")), 256), 1, 8)
    h = F.conv(digits, 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample_sql(buckets: int = BUCKETS, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED) -> str:
    """The resampling by single words in DuckDB SQL, over tables documents and benchmark; CRCs byte by byte."""
    letters = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
    words = f"regexp_extract_all(translate(coalesce(text, ''), {letters}), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents),
one AS (SELECT r, unnest(w) AS word FROM d),
goal AS (SELECT unnest({words}) AS word FROM benchmark),
steps AS (SELECT list_transform(range(256), lambda n: list_reduce([n::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
bytes AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM one UNION SELECT word FROM goal)),
crcs AS (SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
            lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % {buckets} AS bucket FROM bytes, steps),
raw AS (SELECT bucket, count(*) AS n FROM one JOIN crcs USING (word) GROUP BY bucket),
want AS (SELECT bucket, count(*) AS n FROM goal JOIN crcs USING (word) GROUP BY bucket),
sizes AS (SELECT coalesce((SELECT sum(n) FROM raw), 0)::DOUBLE AS s, coalesce((SELECT sum(n) FROM want), 0)::DOUBLE AS t),
gains AS (SELECT raw.bucket, floor(1000 * ln((coalesce(want.n, 0) + 1)::DOUBLE * (sizes.s + {buckets}) / ((raw.n + 1)::DOUBLE * (sizes.t + {buckets}))))::BIGINT AS gain
          FROM raw LEFT JOIN want USING (bucket), sizes),
means AS (SELECT r, floor(sum(gain) / count(*))::BIGINT AS weight FROM one JOIN crcs USING (word) JOIN gains USING (bucket) GROUP BY r),
scored AS (SELECT r, doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
             coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{seed}:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
           FROM d LEFT JOIN means USING (r)),
ranked AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id, n_features, weight) AS rank, count(*) OVER () AS n FROM scored WHERE n_features >= {least_words} AND score IS NOT NULL)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= {percent} * n // 100 THEN rank END AS rank FROM scored LEFT JOIN ranked USING (r)"""


def draw(spark: SparkSession, scored: DataFrame, may: Column, percent: int, id_column: str = "doc_id", score: str = "score", rank: str = "rank") -> DataFrame:
    """``scored`` with the rank of those drawn: of the n rows that ``may``, the floor(percent * n / 100) of
    highest score, ties to the smaller id. ``scored`` is read several times, so it should be a written table."""
    over, = fresh([*scored.columns, rank], "__over")
    may = may & F.col(score).isNotNull()
    histogram = sorted(scored.where(may).groupBy(score).count().collect(), reverse=True)  # one row a whole-number score, see above
    wanted = percent * sum(n for _, n in histogram) // 100
    above, total = [], 0
    for value, n in histogram:
        if total >= wanted:
            break
        above.append((value, total))
        total += n
    if not above:
        return scored.withColumn(rank, F.lit(None).cast("long"))
    floor, = fresh([*scored.columns, rank, over], "__score")
    high = F.coalesce(may & (F.col(score) >= above[-1][0]), F.lit(False))
    places = F.broadcast(spark.createDataFrame(above, f"`{floor}` long, `{over}` long"))  # at most a row a score
    among = Window.partitionBy(score).orderBy(id_column, *(c for c in scored.columns if c != id_column))
    top = scored.where(high).join(places, F.col(score) == F.col(floor)).withColumn(rank, F.col(over) + F.row_number().over(among))
    top = top.withColumn(rank, F.when(F.col(rank) <= wanted, F.col(rank)))
    return top.select(*scored.columns, rank).unionByName(scored.where(~high).withColumn(rank, F.lit(None).cast("long")))


def resample(spark: SparkSession, docs: DataFrame, target: DataFrame, ngrams=NGRAMS, buckets: int = BUCKETS, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """documents (doc_id, text, ...) and target texts (text) -> documents without the text, with
    n_features, n_words, weight, score and rank (null if not drawn); the added names give way to columns
    of the documents by underscores at their end."""
    n_features, n_words, weight, score, rank = fresh(docs.columns, "n_features", "n_words", "weight", "score", "rank")
    gain = gains(bucket_counts(docs, ngrams, buckets), bucket_counts(target, ngrams, buckets), buckets)
    weighed = weigh(docs, gain, ngrams, names=(n_features, n_words, weight))
    scored = staged(spark, weighed.withColumn(score, F.col(weight) + noise(F.col("doc_id"), seed)), "importance-scores")
    return draw(spark, scored, F.col(n_words) >= least_words, percent, "doc_id", score, rank)
