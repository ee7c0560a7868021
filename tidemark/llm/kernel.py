"""Quality classifier: random Fourier features of document statistics, ridge regression, isotonic calibration.

- Statistics: some twenty shares and logarithms of a whole text (characters by class, words by form, lines,
  repetition), in numpy passes over slices of documents.
- Random Fourier features: ``FEATURES`` cosines of random projections of the standardised statistics; their
  inner products approximate a Gaussian kernel, so a linear fit on them is a kernel ridge regression
  whose size does not grow with the rows.
- Fit: each task sums the normal equations (Z'Z and Z'y) of its rows, by fold; the sums are added by
  key (fold, block of rows) in a shuffle. The driver solves the ``FEATURES`` + 1 equations: once for all folds,
  and once for each fold without its part, which is the sum less that part.
- Calibration: scores of each fold by the fit that has not seen it, made monotone against the labels by
  pool-adjacent-violators; between blocks the curve is a straight line.

The labelled rows that teach are bounded by ``SAMPLE`` (first by hash of their id); everything the driver
gathers has that bound or the model's size. Scoring is one map over whole texts.

Defined cases: null and empty texts have all statistics 0 and are scored like any text. No labelled
rows: every score is 0.5; one class only: its share. Repeated labels of a document: the highest
counts; of several texts under a labelled id the smallest teaches. Null labels or ids teach nothing.
Empty table: empty result. Other columns pass through; an added name that clashes gets underscores.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tidemark.llm.common import blocks, fresh, mix, pack, slices, staged, unpack, utf8, word_bounds, word_hashes, U64

#: Labelled documents that teach at most, and random features.
SAMPLE, FEATURES = 20_000, 256
FOLDS = 5
#: Width of the kernel in units of the root of the number of statistics, and the ridge per row.
WIDTH, RIDGE = 1.0, 1e-4
CLIP = 4.0
SEED = 7
#: Rows of the normal equations in one key of the sum.
BLOCK = 64
# Classes of bytes.
_KIND = np.full(256, 6, np.uint8)  # symbols
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[[9, 11, 12, 13, 32]], _KIND[10] = 0, 1, 2, 3, 4
_KIND[list(b".,;:!?'\"()-")] = 5
_KIND[128:192] = 8  # a continuation byte is no character of its own
_KIND[192:] = 7
STATISTICS = ("words", "characters", "lower", "upper", "digit", "space", "line", "punctuation", "symbol", "beyond_ascii", "exclamation", "bar",
              "word_length", "word_spread", "all_caps", "no_letter", "ends_symbol", "distinct", "repeated", "words_a_line")


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """UTF-8 bytes of documents -> one row of STATISTICS a document."""
    n = len(offsets) - 1
    starts, ends, doc = word_bounds(data, offsets)
    owner = np.repeat(np.arange(n), np.diff(offsets))
    kind = _KIND[data]
    chars = np.bincount(owner * 9 + kind, minlength=n * 9).reshape(n, 9)[:, :8].astype(np.float64)
    points = chars.sum(1)
    words = np.bincount(doc, minlength=n).astype(np.float64)
    some, any_char = np.maximum(words, 1), np.maximum(points, 1)

    def per_word(x):
        return np.bincount(doc, x, minlength=n) / some

    letter = (kind == 0) | (kind == 1) | (kind >= 7)
    letters, lower = np.append(0, np.cumsum(letter)), np.append(0, np.cumsum(kind == 0))
    size = (ends - starts).astype(np.float64)
    mean = per_word(size)
    has = letters[ends] > letters[starts]
    caps = has & (lower[ends] == lower[starts]) & (kind[starts] == 1)
    out = np.zeros((n, len(STATISTICS)))
    out[:, 0], out[:, 1], out[:, 2:10] = np.log1p(words), np.log1p(points), chars / any_char[:, None]
    for at, mark in ((10, b"!"), (11, b"|")):
        out[:, at] = np.bincount(owner[data == mark[0]], minlength=n) / any_char
    out[:, 12], out[:, 13] = np.log1p(mean), np.log1p(np.sqrt(np.maximum(per_word(size * size) - mean * mean, 0)))
    out[:, 14], out[:, 15] = per_word(caps), per_word(~has)
    if len(starts):
        out[:, 16] = per_word(kind[ends - 1] == 6)
        keys = word_hashes(data, starts, ends) ^ mix(doc.astype(np.uint64) + U64(3))  # words of each document apart
        _, at = np.unique(keys, return_index=True)
        out[:, 17] = np.bincount(doc[at], minlength=n) / some
        again = np.zeros(len(starts), bool)
        again[1:] = keys[1:] == keys[:-1]
        out[:, 18] = per_word(again)
    out[:, 19] = np.log1p(words / (chars[:, 4] + 1))
    out[points == 0] = 0
    return out


@dataclass
class Model:
    """Standardisation, projections, linear weights (the constant last) and the calibration curve."""
    mean: np.ndarray
    spread: np.ndarray
    turn: np.ndarray
    phase: np.ndarray
    weight: np.ndarray
    at: np.ndarray
    share: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.spread, -CLIP, CLIP)
        z = np.sqrt(2 / self.turn.shape[1]) * np.cos(x @ self.turn + self.phase)
        return np.append(z, np.ones((len(z), 1)), 1)

    def scores(self, stats: np.ndarray) -> np.ndarray:
        if len(self.at) < 2:
            return np.full(len(stats), self.share[0])
        return np.clip(np.interp(self.features(stats) @ self.weight, self.at, self.share), 0.0, 1.0)


def projections(d: int, features: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.normal(size=(d, features)) / (WIDTH * np.sqrt(d)), rng.uniform(0, 2 * np.pi, features)


def isotonic(score: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: (mean score, share of label 1) of the blocks, both increasing."""
    order = np.argsort(score, kind="stable")
    at, first = np.unique(score[order], return_index=True)
    count = np.diff(np.append(first, len(score)))
    ones = np.add.reduceat(label[order].astype(np.float64), first) if len(first) else np.zeros(0)
    pooled: list[list[float]] = []  # count, ones, sum of scores
    for n, k, x in zip(count.tolist(), ones.tolist(), at.tolist()):
        pooled.append([n, k, n * x])
        while len(pooled) > 1 and pooled[-2][1] * pooled[-1][0] >= pooled[-1][1] * pooled[-2][0]:
            n, k, x = pooled.pop()
            pooled[-1] = [pooled[-1][0] + n, pooled[-1][1] + k, pooled[-1][2] + x]
    n, k, x = np.array(pooled).T if pooled else np.zeros((3, 0))
    return x / n, k / n


def teaching(docs: DataFrame, labels: DataFrame, column: str) -> DataFrame:
    """(doc_id, text, label) of the labelled documents that teach."""
    marks = labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull()).groupBy("doc_id").agg(F.max(column).cast("int").alias("label"))
    chosen = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    met = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # SAMPLE rows at most
    return met.groupBy("doc_id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"), F.first("label").alias("label"))


def _measure(batches):
    for batch in slices(batches, "text", 1 << 18):
        stats = statistics(*utf8(batch.column(batch.schema.get_field_index("text"))))
        fold = batch.column(batch.schema.get_field_index("fold"))
        rows = pa.ListArray.from_arrays(pa.array(np.arange(0, stats.size + 1, stats.shape[1]), pa.int32()), pa.array(stats.ravel()))
        yield pa.RecordBatch.from_arrays([fold, batch.column(batch.schema.get_field_index("label")), rows], names=["fold", "label", "stats"])


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.array(batch.column(batch.schema.get_field_index("stats")).to_pylist(), np.float64).reshape(-1, len(STATISTICS))


def _equations(model: Model):
    """Rows (fold, label, stats) -> one blob for each fold and block of rows of [Z'Z | Z'y], summed over the task."""
    size = model.turn.shape[1] + 1

    def run(batches):
        sums = np.zeros((FOLDS, size, size + 1))
        for batch in batches:
            z = model.features(_matrix(batch))
            fold = np.array(batch.column(0).to_pylist(), np.int64)
            y = np.array(batch.column(1).to_pylist(), np.float64)
            for k in np.unique(fold):
                own = z[fold == k]
                sums[k] += own.T @ np.append(own, y[fold == k, None], 1)
        rows = [(k, a, pack(sums[k, a:a + BLOCK])) for k in range(FOLDS) if sums[k].any() for a in range(0, size, BLOCK)]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.binary()))], names=["fold", "at", "blob"])
    return run


def _add(batches):
    """Blobs of a key added up."""
    sums: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for fold, at, blob in zip(*(c.to_pylist() for c in batch.columns)):
            x, = unpack(blob, np.float64)
            sums[fold, at] = sums[fold, at] + x if (fold, at) in sums else x
    rows = [(*key, pack(x)) for key, x in sums.items()]
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.binary()))], names=["fold", "at", "blob"])


def _solve(equations: np.ndarray, rows: float) -> np.ndarray:
    size = len(equations)
    ridge = np.full(size, RIDGE * max(rows, 1.0))
    ridge[-1] = 1e-9 * max(rows, 1.0)  # the constant is hardly shrunk
    return np.linalg.solve(equations[:, :size] + np.diag(ridge), equations[:, size])


def learn(spark: SparkSession, docs: DataFrame, labels: DataFrame, column: str = "quality", features: int = FEATURES) -> Model:
    """documents (doc_id, text) and labels (doc_id, ``column`` 0 or 1) -> model of label 1."""
    turn, phase = projections(len(STATISTICS), features)
    fold = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(FOLDS)).cast("int")
    taught = teaching(docs, labels, column).select(fold.alias("fold"), "label", "text")
    measured = staged(spark, taught.mapInArrow(_measure, "fold int, label int, stats array<double>"), "kernel-statistics")
    d = len(STATISTICS)
    sums = measured.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0)), *(f(F.col("stats")[i]) for i in range(d) for f in (F.avg, F.stddev_pop))).first()
    n, ones = sums[0], sums[1]
    if n == 0 or ones in (0, n):
        nothing = np.zeros(0)
        return Model(np.zeros(d), np.ones(d), turn, phase, np.zeros(features + 1), nothing, np.array([ones / n if n else 0.5]))
    mean, spread = np.array(sums[2::2], np.float64), np.array(sums[3::2], np.float64)
    model = Model(mean, np.where(spread > 1e-9, spread, 1.0), turn, phase, np.zeros(0), np.zeros(0), np.zeros(0))
    kinds = "fold int, at int, blob binary"
    added = measured.mapInArrow(_equations(model), kinds).repartition("fold", "at").mapInArrow(_add, kinds)
    size = features + 1
    parts = np.zeros((FOLDS, size, size + 1))
    for k, at, blob in added.collect():  # FOLDS times the model's equations
        x, = unpack(blob, np.float64)
        parts[k, at:at + BLOCK] = x.reshape(-1, size + 1)
    whole = parts.sum(0)
    model.weight = _solve(whole, whole[-1, -2])
    unseen = np.stack([_solve(whole - p, (whole - p)[-1, -2]) for p in parts], 1)

    def apart(batches):
        for batch in batches:
            folds = np.array(batch.column(0).to_pylist(), np.int64)
            guess = (model.features(_matrix(batch)) @ unseen)[np.arange(len(folds)), folds]
            yield pa.RecordBatch.from_arrays([pa.array(guess), batch.column(1)], names=["guess", "label"])

    guesses = np.array(measured.mapInArrow(apart, "guess double, label int").collect(), np.float64).reshape(-1, 2)  # SAMPLE rows at most
    model.at, model.share = isotonic(guesses[:, 0], guesses[:, 1])
    if len(model.at) == 1:
        model.share = np.array([ones / n])
    return model


def score(docs: DataFrame, model: Model, column: str = "score", text: str = "text") -> DataFrame:
    """``docs`` without its text, with ``column``: the calibrated share of label 1 among such documents."""
    from pyspark.sql.pandas.types import to_arrow_schema

    column, = fresh([c for c in docs.columns if c != text], column)
    out = StructType([f for f in docs.schema.fields if f.name != text] + [StructField(column, DoubleType())])
    schema = to_arrow_schema(out)

    def run(batches):
        for batch in slices(batches, text, 1 << 21):
            data, offsets = utf8(batch.column(batch.schema.get_field_index(text)))
            stats = [statistics(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]) for a, b in blocks(offsets, 1 << 18)]
            rest = [c for name, c in zip(batch.schema.names, batch.columns) if name != text]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(model.scores(np.concatenate(stats)))], schema=schema)

    return docs.mapInArrow(run, out)
