"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text is built. A text is parsed against each of them:
from where it stands, the longest string that occurs in the language's text is one phrase, and the
parse goes on behind it. The fewer phrases a text needs, the more it is like that language; phrases
are normalised by the text's length. The language with the fewest wins.

Learning takes a bounded sample of each language that occurs (``SAMPLE_DOCS`` documents, first by hash of
their id, a stretch of ``STRETCH`` characters from the middle of each, ``TRAIN_CHARS`` in all), so an
automaton has at most 32,767 states. Each language has its own alphabet. The transitions by its ``DENSE``
most frequent letters are a table of 16-bit numbers, small enough for a CPU's cache; in it the step from
a state that cannot go on is already the step from the start, marked as the beginning of a phrase, so
parsing is one look-up a character. Transitions by its other letters (Chinese has thousands) are a
sorted list of (state, letter), searched for those letters only. A letter above U+FFFF counts as the two
16-bit units of its UTF-16 form.

Texts are cut into lanes of ``LANE`` characters, a phrase ending with its lane, and all lanes of a slice
step through a table together in numpy, whole texts. The score is the margin between the best and the
second language. Tables are made for ``BLOCK_LANGUAGES`` languages at a time: with more languages than that
the texts are passed once for each block, carrying their best languages along in staged tables, so
memory does not grow with the number of languages.

Defined cases: null text, or one without a letter: ``und`` with score 0. No labelled text: ``und``. A tie
goes to the language first in the alphabet. One language learnt: it, with score 1. Extra columns are
not read; rows that repeat get the same answer.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import discard, slices, staged

SAMPLE_DOCS, STRETCH, TRAIN_CHARS = 64, 512, 16_000
BLOCK_LANGUAGES = 64
DENSE = 254
LANE = 256
UNKNOWN = "und"


def fold_table() -> np.ndarray:
    """Code point -> lower-cased letter, or a space for anything that is no letter (first 65,536)."""
    out = np.full(65536, 32, np.uint32)
    for point in range(65536):
        c = chr(point)
        if c.isalpha():
            low = c.lower()
            out[point] = ord(low) if len(low) == 1 and ord(low) < 65536 else point
    return out


_FOLD: list[np.ndarray] = []


def _with_pairs(points: np.ndarray, out: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Letters above U+FFFF as two 16-bit units each, as in UTF-16; other characters there are no letters."""
    known, which = np.unique(points[high], return_inverse=True)
    low = [c.lower() if len(c.lower()) == 1 else c for c in map(chr, known.tolist())]
    folded_to = np.array([ord(c) if c.isalpha() else 32 for c in low], np.uint32)[which]
    pair = folded_to > 65535
    out[high] = np.where(pair, 0xD800 + ((folded_to - 0x10000) >> np.uint32(10)), folded_to)
    count = np.ones(len(out), np.int64)
    count[high[pair]] = 2
    second = np.cumsum(count)[high[pair]] - 1
    out = np.repeat(out, count)
    out[second] = 0xDC00 + ((folded_to[pair] - 0x10000) & np.uint32(0x3FF))
    return out


def folded(text: str) -> np.ndarray:
    """Letters in lower case, each run of other characters one space."""
    if not _FOLD:
        _FOLD.append(fold_table())
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    out = _FOLD[0][np.minimum(points, 65535)]
    high = np.flatnonzero(points > 65535)
    if len(high):
        out = _with_pairs(points, out, high)
    blank = out == 32
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    return out[keep]


def suffix_automaton(text: list[int]) -> tuple[list[dict[int, int]], int]:
    """Transitions of the smallest automaton of all substrings of ``text``; state 0 is the start."""
    nxt: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                copy = len(nxt)
                nxt.append(dict(nxt[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = copy
                    p = link[p]
                link[q] = link[cur] = copy
        last = cur
    return nxt, len(nxt)


@dataclass
class Automaton:
    letters: np.ndarray  # code point -> class: 0 for a letter that the language does not have, DENSE + 1 for one in the list
    table: np.ndarray    # [state, class] -> state, or -1 - state if this character opens a phrase
    keys: np.ndarray     # sorted state * 65536 + letter of the listed letters
    to: np.ndarray       # where they lead

    def listed(self, state: np.ndarray, point: np.ndarray) -> np.ndarray:
        """Steps by listed letters; like the table's."""
        point = point.astype(np.int64)
        key = np.where(state == 0, -1, state * 65536 + point)  # the start itself is left by the opening step only
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        opening = self.to[np.searchsorted(self.keys, point)]  # state 0
        return np.where(self.keys[at] == key, self.to[at], -1 - opening)


@dataclass
class Model:
    languages: list[str]
    automata: list[Automaton]

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(phrases [text, language], characters of each text)."""
        parts = [folded(t).astype(np.uint16) for t in texts]
        lens = np.array([len(x) for x in parts])
        flat = np.concatenate(parts) if parts else np.zeros(0, np.uint16)
        lanes = -(-lens // LANE)
        first = np.cumsum(lens) - lens
        owner = np.repeat(np.arange(len(texts)), lanes)
        rank = np.arange(len(owner)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        start = first[owner] + rank * LANE
        size = np.minimum(LANE, first[owner] + lens[owner] - start)
        order = np.argsort(-size, kind="stable")  # lanes that end first stand last
        owner, start, size = owner[order], start[order], size[order]
        grid = np.zeros((LANE, len(start)), np.uint16)
        alive = np.searchsorted(-size, -np.arange(LANE), "left")  # lanes longer than each column
        for j in range(LANE):
            grid[j, :alive[j]] = flat[start[:alive[j]] + j]
        out = np.zeros((len(texts), len(self.languages)), np.int64)
        for k, one in enumerate(self.automata):
            cells, width = one.table.ravel(), one.table.shape[1]
            kinds = one.letters[grid]
            state = np.full(len(start), len(one.table) - 1, np.int32)
            count = np.zeros(len(start), np.int64)
            for j in range(LANE):
                n = alive[j]
                if not n:
                    break
                kind = kinds[j, :n]
                if len(one.keys):
                    rare = np.flatnonzero(kind > DENSE)
                    kind[rare] = 0
                    step = cells[state[:n] * width + kind].astype(np.int32)
                    step[rare] = one.listed(state[rare].astype(np.int64), grid[j, rare])
                else:
                    step = cells[state[:n] * width + kind].astype(np.int32)
                ended = step < 0
                count[:n] += ended
                state[:n] = np.where(ended, -1 - step, step)
            out[:, k] = np.bincount(owner, count, minlength=len(texts)).astype(np.int64)
        return out, lens

    def rank(self, texts: list[str | None]) -> tuple[list[str | None], np.ndarray, np.ndarray]:
        """(best language, its phrases a character, those of the second) of each text; infinite where there is none."""
        counts, lens = self.phrases([t or "" for t in texts])
        if not self.languages:
            return [None] * len(texts), np.full(len(texts), np.inf), np.full(len(texts), np.inf)
        rates = counts / np.maximum(lens, 1)[:, None]
        best = rates.argmin(1)
        low = rates.min(1)
        rates[np.arange(len(texts)), best] = np.inf
        return [self.languages[b] for b in best], low, rates.min(1)


def verdict(texts: list[str | None], best: list[str | None], low: np.ndarray, second: np.ndarray) -> tuple[list[str], np.ndarray]:
    """(language, score) of texts from what ``rank`` gives."""
    known = np.array([b is not None and any(c.isalpha() for c in t or "") for t, b in zip(texts, best)], bool)
    score = np.ones(len(texts))
    two = np.isfinite(second)
    score[two] = 1 - low[two] / np.maximum(second[two], 1e-12)
    return [b if k else UNKNOWN for b, k in zip(best, known)], np.where(known, np.clip(score, 0, 1), 0.0)


@dataclass
class Learnt:
    """Training text of each language, as folded letters."""
    texts: dict[str, np.ndarray]

    @property
    def languages(self) -> list[str]:
        return list(self.texts)

    def models(self):
        """Models of BLOCK_LANGUAGES languages each; at least one."""
        for at in range(0, max(len(self.texts), 1), BLOCK_LANGUAGES):
            yield build({x: self.texts[x] for x in self.languages[at:at + BLOCK_LANGUAGES]})


def gather(samples: dict[str, list[str]]) -> Learnt:
    """Stretches of text -> ``TRAIN_CHARS`` characters of each language."""
    texts = {}
    for lang in sorted(samples):
        parts = [x for x in (folded(t) for t in samples[lang]) if len(x)]
        if parts:
            texts[lang] = np.concatenate([np.append(x, np.uint32(32)) for x in parts])[:TRAIN_CHARS]
    return Learnt(texts)


def build(texts: dict[str, np.ndarray]) -> Model:
    automata = []
    for text in texts.values():
        points, often = np.unique(text, return_counts=True)
        dense = points if len(points) <= DENSE else np.sort(points[np.argsort(-often, kind="stable")[:DENSE]])
        letters = np.zeros(65536, np.uint8)
        letters[points] = DENSE + 1
        letters[dense] = np.arange(1, len(dense) + 1)
        kind = letters.tolist()
        nxt, n = suffix_automaton(text.tolist())
        # One more state, n, stands between phrases: after a letter that the language does not have.
        start = np.full(len(dense) + 1, n, np.int16)
        listed = []
        for c, to in nxt[0].items():
            if kind[c] <= DENSE:
                start[kind[c]] = to
        table = np.tile(-1 - start, (n + 1, 1)).astype(np.int16)  # cannot go on: the character opens a phrase
        for state, row in enumerate(nxt):
            for c, to in row.items():
                if kind[c] > DENSE:
                    listed.append((state * 65536 + c, to))
                elif state:
                    table[state, kind[c]] = to
        listed.sort()
        automata.append(Automaton(letters, table, np.array([x for x, _ in listed], np.int64), np.array([x for _, x in listed], np.int32)))
    return Model(list(texts), automata)


def fit(samples: dict[str, list[str]]) -> Model:
    """One model of all the languages."""
    return build(gather(samples).texts)


def learn(spark: SparkSession, docs: DataFrame) -> Learnt:
    """docs (doc_id, text, lang): rows without lang, text or id teach nothing. Every label that occurs is learnt;
    at most SAMPLE_DOCS stretches a label reach the driver."""
    middle = F.greatest(F.lit(1), ((F.length("text") - STRETCH) / 2).cast("int"))
    rows = docs.where("lang is not null and text is not null and doc_id is not null").select(
        "lang", F.xxhash64("doc_id").alias("h"), F.col("doc_id").cast("long").alias("doc_id"), F.substring("text", middle, F.lit(STRETCH)).alias("part"))
    first = Window.partitionBy("lang").orderBy("h", "doc_id", "part")
    rows = rows.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= SAMPLE_DOCS)
    rows = rows.orderBy("rank", "lang").collect()
    samples: dict[str, list[str]] = {}
    for r in rows:
        samples.setdefault(r["lang"], []).append(r["part"])
    return gather(samples)


def _pass(model: Model, last: bool):
    """(doc_id, text[, best, low, second of earlier blocks]) -> those with this block's, or the verdict."""
    def run(batches):
        for batch in slices(batches, "text", 1 << 20):
            texts = batch.column(1).to_pylist()
            best, low, second = model.rank(texts)
            if batch.num_columns > 2:
                best0 = batch.column(2).to_pylist()
                low0, second0 = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 4))
                earlier = low0 <= low  # a tie goes to the language first in the alphabet
                second = np.where(earlier, np.minimum(second0, low), np.minimum(low0, second))
                best = [a if e else b for a, b, e in zip(best0, best, earlier)]
                low = np.where(earlier, low0, low)
            if last:
                lang, score = verdict(texts, best, low, second)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"])
            else:
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(best, pa.string()), pa.array(low, pa.float64()), pa.array(second, pa.float64())], names=["doc_id", "text", "best", "low", "second"])
    return run


def identify(docs: DataFrame, learnt: Learnt) -> DataFrame:
    """docs (doc_id, text) -> (doc_id, lang_pred, score)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    spark, now, before = docs.sparkSession, docs.select("doc_id", "text"), None
    left = -(-max(len(learnt.texts), 1) // BLOCK_LANGUAGES)
    for model in learnt.models():
        left -= 1
        if not left:
            return now.mapInArrow(_pass(model, True), f"doc_id {kind}, lang_pred string, score double")
        now = staged(spark, now.mapInArrow(_pass(model, False), f"doc_id {kind}, text string, best string, low double, second double"), "language-ranks")
        if before is not None:
            discard(spark, before)
        before = now
