"""Quality rules by distribution divergence.

Two histograms of a document are compared with those of its language: its characters by class
(lower case, upper case, digits, spaces, line ends, punctuation, symbols, letters beyond ASCII) and its
words among the language's common words. The measure is the Jensen-Shannon distance (base 2, 0 to 1).
Short texts have noisy histograms, so each distance counts only from a least length on
(``LEAST_CHARS``, ``LEAST_WORDS``), and a text below both is judged by the base rules alone.

The language references are sums over all documents of a language, and so is the choice of the common
words: the ``COMMON`` most frequent of each language. Words are counted in a numpy pass that gives one
row for each word of a slice, then by partial aggregation; a document meets its language's words by a
plain join, so there may be any number of languages. Histograms are made in numpy passes over slices of
documents and written once; sums, joins and distances are DataFrame expressions.

Base rules: fewer than 50 words, or more than half of the words in repeated 3-word windows.

Defined cases: a null text has no words and fails the base. A null lang counts as ''. A text
that holds none of the common words has an all-"other" histogram. Repeated rows count each in the
references. Empty table: empty result. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import blocks, lowered, mix, slices, staged, utf8, word_bounds, word_hashes, U64

COMMON = 32
LEAST_CHARS, LEAST_WORDS = 200, 100
MOST_CHAR_DISTANCE, MOST_WORD_DISTANCE = 0.25, 0.35
LEAST_BASE_WORDS, MOST_REPEATED = 50, 50
# Classes of bytes and the symbols counted.
SYMBOLS = b"#*$%&|<>"
PUNCTUATION = b".,;:!?'\"()-"
CLASSES = 8
_CLASS = np.full(256, 6, np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[32], _CLASS[10] = 0, 1, 2, 3, 4
_CLASS[list(PUNCTUATION)] = 5
_CLASS[128:192] = CLASSES  # a continuation byte is no character of its own
_CLASS[192:] = 7
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True

_FEATURES = ("doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
             "chars array<long>, common array<long>")


def languages_of(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, list[str], np.ndarray]:
    """(language number of each row, languages, first row of each)."""
    names = batch.column(batch.schema.get_field_index(column)).to_pylist()
    first: dict[str, int] = {}
    for i, x in enumerate(names):
        first.setdefault(x, i)
    number = {x: i for i, x in enumerate(first)}
    return np.array([number[x] for x in names], np.int64), list(first), np.array(list(first.values()), np.int64)


def _salts(n: int) -> np.ndarray:
    """One 64-bit value a language of a slice, to tell its words from those of the others."""
    return mix(np.arange(1, n + 1).astype(np.uint64))


def _count_words(batches):
    """(text, lang) -> (lang, w, n), one row for each language and lower-cased word of a slice."""
    for batch in slices(batches, "text"):
        data, offsets = utf8(batch.column(0))
        data = lowered(data)
        starts, ends, doc = word_bounds(data, offsets)
        if not len(starts):
            continue
        lang, names, _ = languages_of(batch, "lang")
        _, at, count = np.unique(word_hashes(data, starts, ends) ^ _salts(len(names))[lang[doc]], return_index=True, return_counts=True)
        raw = data.tobytes()
        words = [raw[a:b].decode() for a, b in zip(starts[at].tolist(), ends[at].tolist())]
        yield pa.RecordBatch.from_arrays([pa.array([names[i] for i in lang[doc[at]].tolist()], pa.string()), pa.array(words, pa.string()), pa.array(count.astype(np.int64))], names=["lang", "w", "n"])


def common_words(docs: DataFrame) -> DataFrame:
    """documents (text, lang) -> (lang, words): the most frequent lower-cased words of each language, most frequent first."""
    texts = docs.where("text is not null").select("text", F.coalesce("lang", F.lit("")).alias("lang"))
    counts = texts.mapInArrow(_count_words, "lang string, w string, n long").groupBy("lang", "w").agg(F.sum("n").alias("n"))
    top = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "w"))
    best = counts.withColumn("top", top).where(F.col("top") <= COMMON)
    return best.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("top", "w"))).alias("words")).select("lang", F.col("words.w").alias("words"))


def dup_lines(text: str | None) -> int:
    """Lines with a word that equal an earlier line."""
    if not text or "\n" not in text:
        return 0
    lines = [x for x in text.split("\n") if x.strip("\x20\x09\x0a\x0b\x0c\x0d")]
    return len(lines) - len(set(lines))


def repeat_words(words: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """Words of each document inside 3-word windows that it holds twice or more."""
    if len(words) < 3:
        return np.zeros(n_docs, np.int64)
    whole = np.flatnonzero(doc[:-2] == doc[2:])
    a, b, c = (mix(words[whole + j] + U64(j)) for j in range(3))
    window = mix(a + b * U64(3) + c * U64(5)) ^ mix(doc[whole].astype(np.uint64) + U64(11))
    order = np.argsort(window)
    window = window[order]
    same = window[1:] == window[:-1]
    twice = np.zeros(len(window), bool)
    twice[1:], twice[:-1] = same, twice[:-1] | same
    twice[1:] |= same
    at = whole[order[twice]]
    inside = np.zeros(len(words), bool)
    for j in range(3):
        inside[at + j] = True
    return np.bincount(doc[inside], minlength=n_docs)


def _known(names: list[str], words: list[list[str] | None]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted salted hashes of the common words of a slice's languages, and each one's place among its language's words."""
    raw = [w.encode() for x in words for w in x or ()]
    if not raw:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    lens = np.array([len(w) for w in raw], np.int64)
    ends = np.cumsum(lens)
    sizes = np.array([len(x or ()) for x in words], np.int64)
    keys = word_hashes(np.frombuffer(b"".join(raw), np.uint8), ends - lens, ends) ^ np.repeat(_salts(len(names)), sizes)
    order = np.argsort(keys)
    return keys[order], (np.arange(len(raw)) - np.repeat(np.cumsum(sizes) - sizes, sizes))[order]


def _features():
    def part(batch):
        data, offsets = utf8(batch.column(1))
        n = batch.num_rows
        starts, ends, doc = word_bounds(data, offsets)
        words = word_hashes(data, starts, ends)
        count = np.bincount(doc, minlength=n)
        kind = _CLASS[data]
        owner = np.repeat(np.arange(n), np.diff(offsets))
        chars = np.bincount(owner * (CLASSES + 1) + kind, minlength=n * (CLASSES + 1)).reshape(n, CLASSES + 1)[:, :CLASSES]
        lead = (data & 0xC0) != 0x80
        points = np.append(0, np.cumsum(lead))
        word_chars = np.bincount(doc, points[ends] - points[starts], minlength=n).astype(np.int64)
        symbols = np.bincount(owner[_SYMBOL[data]], minlength=n)
        common = np.zeros((n, COMMON + 1), np.int64)
        lang, names, first = languages_of(batch, "lang")
        known, place = _known(names, batch.column(3).take(pa.array(first)).to_pylist())
        if len(known) and len(words):
            low = word_hashes(lowered(data), starts, ends) ^ _salts(len(names))[lang[doc]]
            at = np.minimum(np.searchsorted(known, low), len(known) - 1)
            hit = np.flatnonzero(known[at] == low)
            np.add.at(common, (doc[hit], place[at[hit]]), 1)
        common[:, COMMON] = count - common.sum(1)
        lines = [dup_lines(x) for x in batch.column(1).to_pylist()]
        return count, word_chars, symbols, np.array(lines), repeat_words(words, doc, n), chars, common

    def run(batches):
        for batch in slices(batches, "text", 1 << 18):
            count, word_chars, symbols, lines, repeated, chars, common = part(batch)
            arrays = [batch.column(0), batch.column(2), *(pa.array(x.astype(np.int64)) for x in (count, word_chars, symbols, lines, repeated))]
            for x in (chars, common):
                arrays.append(pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1]), pa.int32()), pa.array(x.astype(np.int64).ravel())))
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "chars", "common"])
    return run


def js_distance(a: Column, b: Column) -> Column:
    """Jensen-Shannon distance of two arrays of counts; 0 if either is empty."""
    def total(x):
        return F.aggregate(x, F.lit(0.0), lambda s, v: s + v)

    def term(p, q):
        m = (p + q) / 2
        return F.when(p > 0, p * F.log2(p / m)).otherwise(0.0) / 2 + F.when(q > 0, q * F.log2(q / m)).otherwise(0.0) / 2

    ta, tb = total(a), total(b)
    divergence = F.aggregate(F.zip_with(a, b, lambda x, y: term(x / ta, y / tb)), F.lit(0.0), lambda s, v: s + v)
    return F.when((ta > 0) & (tb > 0), F.sqrt(F.greatest(F.lit(0.0), divergence))).otherwise(0.0)


def judge(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """documents (doc_id, text, lang) -> base counts, distances and verdict, one row a document."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce("lang", F.lit("")).alias("lang"))
    vocabulary = staged(spark, common_words(docs), "quality-words")
    met = docs.join(vocabulary, "lang", "left").select("doc_id", "text", "lang", "words")
    features = staged(spark, met.mapInArrow(_features(), _FEATURES), "quality-features")
    summed = features.groupBy("lang").agg(F.array(*(F.sum(F.col("chars")[i]) for i in range(CLASSES))).alias("ref_chars"),
                                          F.array(*(F.sum(F.col("common")[i]) for i in range(COMMON + 1))).alias("ref_common"))
    both = features.join(summed, "lang")
    both = both.withColumns({"char_distance": js_distance(F.col("chars"), F.col("ref_chars")), "word_distance": js_distance(F.col("common"), F.col("ref_common"))})
    base = (F.col("n_words") < LEAST_BASE_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    length = F.aggregate("chars", F.lit(0).cast("long"), lambda s, v: s + v)
    odd = ((length >= LEAST_CHARS) & (F.col("char_distance") > MOST_CHAR_DISTANCE)) | ((F.col("n_words") >= LEAST_WORDS) & (F.col("word_distance") > MOST_WORD_DISTANCE))
    return both.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), (~base & ~odd).alias("kept"), "char_distance", "word_distance")
