"""Toxicity by a learnt lexicon, Levenshtein automata and context windows.

Learning (labelled rows only, bounded samples): a word, or a stem (a word beginning that many words
share), enters the lexicon if documents labelled toxic hold it far more often than others. The
lexicon is a trie; a Levenshtein automaton (``edits_for`` errors) runs along it, and the pair is
made one deterministic table: a word goes through it character by character and ends with the
closest entry, or dies after a few characters as nearly all words do. How much a hit weighs, by
entry and by number of errors, is the log ratio of its counts in the two samples, so a misspelling
that also is an ordinary word weighs nothing. A logistic curve turns summed weights into a score.

Scoring: the distinct hit words of a whole text are weighed by their context. A hit within quotation
marks or after a reporting word is quotation and weighs ``QUOTED`` of its own; one next to an
address (second person) weighs ``ADDRESSED`` times.

All words of a slice of documents step through the table together in numpy; texts are scored whole.
The model is a few hundred entries and a table of a few thousand states: its size does not depend on
the corpus. Lexicon counts run in Spark on the sample; the driver sees only the entries.

Defined cases: null and empty texts score as texts without a hit. No labelled rows, or none of a
class: an empty lexicon, every score is BASE. Repeated labels of a document: the highest counts. Null labels or
ids teach nothing. Extra columns pass through untouched.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tidemark.llm.common import slices, staged

#: Labelled documents that teach, of each class, first by hash of their id.
SAMPLE_TOXIC, SAMPLE_CLEAN = 2000, 4000
#: An entry is in at least this share of the toxic sample (and LEAST documents) and is toxic this surely.
SHARE, LEAST, SURE = 0.03, 5, 0.9
STEM_LENGTHS = (4, 5, 6, 7, 8)
STEM_WORDS = 4
MAX_ENTRIES = 300
BASE = 0.01
QUOTED, ADDRESSED = 0.3, 1.5
#: A misspelling that the samples never met weighs this share of the entry itself, by errors; and the most that any weighs.
UNSEEN, MOST = (1.0, 0.8, 0.5), 8.0
WINDOW = 60
# Words and marks of quotation and address.
REPORTING = frozenset("said says called quote quoted quotes word term phrase insult wrote reported".split())
ADDRESS = frozenset("you your yours yourself thou du dich dein ihr euch toi vous usted eres".split())
QUOTES = frozenset("\"“”„«»‘’‹›")
_NONE = 1 << 30
SCORE = "__toxicity"


def edits_for(length: int) -> int:
    return 0 if length < 4 else 1 if length < 8 else 2


# -- lexicon trie x Levenshtein automata --------------------------------------

@dataclass
class Automaton:
    """table[state, class] -> state (0 is dead, 1 the start); codes are errors * 1000 + entry."""
    classes: np.ndarray  # of the first 65,536 code points; 0 ends a word
    high: dict[str, int]  # of lower-cased letters above them
    table: np.ndarray
    at_end: np.ndarray   # best entry if the word ends here
    inside: np.ndarray   # best stem met by what was read so far
    n: int


def build_automaton(entries: list[tuple[str, bool]]) -> Automaton:
    """entries: (text, is stem). Subset construction over (trie node, errors)."""
    letters = sorted({c for text, _ in entries for c in text})
    number = {c: i + 1 for i, c in enumerate(letters)}
    other = len(letters) + 1
    classes = np.zeros(65536, np.uint16 if other < 65536 else np.uint32)
    for point in range(65536):
        c = chr(point)
        if c.isalnum():
            low = c.lower()
            classes[point] = number.get(low if len(low) == 1 else c, other)
    children: list[dict[int, int]] = [{}]
    word_at, stem_at, budget = {}, {}, [0]
    for i, (text, stem) in enumerate(entries):
        node, most = 0, edits_for(len(text))
        budget[0] = max(budget[0], most)
        for c in text:
            nxt = children[node].get(number[c])
            if nxt is None:
                nxt = children[node][number[c]] = len(children)
                children.append({})
                budget.append(0)
            node = nxt
            budget[node] = max(budget[node], most)
        (stem_at if stem else word_at)[node] = i
    most_of = [edits_for(len(t)) for t, _ in entries]

    def closure(states: dict[int, int]) -> tuple:
        """Least errors by node, with letters of the trie left out by the word."""
        todo = list(states.items())
        while todo:
            node, e = todo.pop()
            if e > states[node]:
                continue
            for nxt in children[node].values():
                if e + 1 <= budget[nxt] and e + 1 < states.get(nxt, 99):
                    states[nxt] = e + 1
                    todo.append((nxt, e + 1))
        return tuple(sorted(states.items()))

    def step(states: tuple, c: int) -> tuple:
        out: dict[int, int] = {}

        def put(node, e):
            if e <= budget[node] and e < out.get(node, 99):
                out[node] = e
        for node, e in states:
            put(node, e + 1)  # an extra letter
            for letter, nxt in children[node].items():
                put(nxt, e + (letter != c))
        return closure(out) if out else ()

    def best(states: tuple, table: dict[int, int]) -> int:
        return min((e * 1000 + table[node] for node, e in states if node in table and e <= most_of[table[node]]), default=_NONE)

    start = closure({0: 0})
    ids, queue, rows = {(): 0, start: 1}, [start], [np.zeros(other + 1, np.int32)]
    at_end, inside = [_NONE], [_NONE]

    def number_of(states: tuple) -> int:
        if states not in ids:
            ids[states] = len(ids)
            queue.append(states)
        return ids[states]

    for states in queue:
        # Letters that no branch here asks for lead where any unknown letter leads.
        row = np.full(other + 1, number_of(step(states, other)), np.int32)
        row[0] = 0
        for c in sorted({letter for node, _ in states for letter in children[node]}):
            row[c] = number_of(step(states, c))
        rows.append(row)
        at_end.append(best(states, word_at))
        inside.append(best(states, stem_at))
    return Automaton(classes, {c: i for c, i in number.items() if ord(c) > 65535}, np.array(rows, np.int32), np.array(at_end), np.array(inside), len(entries))


def hits_of(texts: list[str], a: Automaton) -> tuple[np.ndarray, ...]:
    """(text, first character, end, code) of every word that meets the lexicon."""
    lens = np.array([len(t) for t in texts])
    first = np.cumsum(lens + 1) - lens - 1
    points = np.frombuffer("\n".join(texts).encode("utf-32-le", "replace"), np.uint32)
    if not len(points):
        return (np.zeros(0, np.int64),) * 4
    kind = a.classes[np.minimum(points, 65535)]
    high = np.flatnonzero(points > 65535)
    if len(high):
        known, which = np.unique(points[high], return_inverse=True)
        other = a.table.shape[1] - 1
        kind[high] = np.array([a.high.get(c.lower(), other) if c.isalnum() else 0 for c in map(chr, known.tolist())], kind.dtype)[which]
    inside = kind != 0
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edge = np.append(0, edge)
    if inside[-1]:
        edge = np.append(edge, len(inside))
    starts, ends = edge[::2], edge[1::2]
    code = np.full(len(starts), _NONE)
    state, word, at = np.ones(len(starts), np.int32), np.arange(len(starts)), starts.copy()
    while len(word):
        state = a.table[state, kind[at]]
        alive = np.flatnonzero(state)
        word, state, at = word[alive], state[alive], at[alive] + 1
        code[word] = np.minimum(code[word], a.inside[state])
        over = at >= ends[word]
        code[word[over]] = np.minimum(code[word[over]], a.at_end[state[over]])
        go = ~over
        word, state, at = word[go], state[go], at[go]
    met = np.flatnonzero(code < _NONE)
    text = np.searchsorted(first, starts[met], "right") - 1
    return text, starts[met] - first[text], ends[met] - first[text], code[met]


def context(text: str, a: int, b: int) -> tuple[bool, bool]:
    """(quoted, addressed) of the hit text[a:b], from a window on both sides."""
    left, right = text[max(0, a - WINDOW):a], text[b:b + WINDOW]
    left, right = left.rpartition("\n")[2], right.partition("\n")[0]
    before, after = left.lower().split()[-6:], right.lower().split()[:6]
    marked = any(c in QUOTES for w in before for c in w) or left[-1:] in QUOTES
    marked = marked and (any(c in QUOTES for w in after for c in w) or right[:1] in QUOTES)
    words = {w.strip(".,;:!?\"“”„«»()") for w in before[-4:]}
    quoted = marked or bool(words & REPORTING)
    return quoted, bool((words | {w.strip(".,;:!?\"“”„«»()") for w in after[:4]}) & ADDRESS)


@dataclass
class Model:
    entries: list[tuple[str, bool]]
    automaton: Automaton | None
    weight: dict[int, float]  # of a distinct hit word, by code
    curve: tuple[float, float] = (0.0, float(np.log(BASE / (1 - BASE))))

    def evidence(self, texts: list[str]) -> np.ndarray:
        total = np.zeros(len(texts))
        if self.automaton is None:
            return total
        seen: dict[tuple[int, str], float] = {}
        for i, a, b, code in zip(*(x.tolist() for x in hits_of(texts, self.automaton))):
            w = self.weight[code]
            key = (i, texts[i][a:b].lower())
            if w <= 0 or seen.get(key, 0) >= w * ADDRESSED:
                continue
            quoted, addressed = context(texts[i], a, b)
            seen[key] = max(seen.get(key, 0), w * QUOTED if quoted else w * ADDRESSED if addressed else w)
        for (i, _), w in sorted(seen.items()):
            total[i] += w
        return total

    def scores(self, texts: list[str]) -> np.ndarray:
        a, b = self.curve
        return 1 / (1 + np.exp(-np.clip(a * self.evidence(texts) + b, -30, 30)))


def fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Logistic regression on one feature by Newton's method, lightly regularised; slope not below 0."""
    a, b = 0.1, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        r, g = weight * (p - y), weight * p * (1 - p)
        grad = np.array([(r * x).sum() + 1e-2 * a, r.sum() + 1e-2 * b])
        hess = np.array([[(g * x * x).sum() + 1e-2, (g * x).sum()], [(g * x).sum(), g.sum() + 1e-2]])
        step = np.linalg.solve(hess, grad)
        a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -1, 1)
        if np.abs(step).max() < 1e-9:
            break
    return max(float(a), 0.0), float(b)


# -- learning -------------------------------------------------------------------

def choose_entries(counts: dict[str, tuple[int, int]]) -> list[tuple[str, bool]]:
    """Lexicon from keys that passed the test, each with (toxic documents, words): a word is "=word",
    a beginning is "beginning~" and becomes a stem if at least STEM_WORDS words begin with it."""
    stems: list[str] = []
    for k in sorted((k[:-1] for k, (_, n) in counts.items() if k[0] != "=" and n >= STEM_WORDS), key=lambda k: (len(k), k)):
        if not k.startswith(tuple(stems)):
            stems.append(k)
    rest = [k[1:] for k in counts if k[0] == "=" and not k[1:].startswith(tuple(stems))]
    found = [(counts["=" + w][0], w, False) for w in rest] + [(counts[s + "~"][0], s, True) for s in stems]
    return sorted((w, stem) for _, w, stem in sorted(found, key=lambda x: (-x[0], x[1]))[:MAX_ENTRIES])


def learn(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> Model:
    """docs (doc_id, text), labels (doc_id, toxic): only rows of ``labels`` teach."""
    marks = (labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    ids = [marks.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for k, n in ((1, SAMPLE_TOXIC), (0, SAMPLE_CLEAN))]
    chosen = ids[0].unionByName(ids[1])  # at most SAMPLE_TOXIC + SAMPLE_CLEAN rows of two numbers
    sample = docs.where("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    sample = staged(spark, sample.select("text", "toxic").dropDuplicates(["text"]), "toxic-sample")
    of_all = {r["toxic"]: r["count"] for r in marks.groupBy("toxic").count().collect()}
    n = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = n.get(1, 0), n.get(0, 0)
    if not n_toxic or not n_clean:
        return Model([], None, {})
    word = F.explode(F.array_distinct(F.filter(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"), lambda w: w != "")))
    words = sample.select("toxic", F.monotonically_increasing_id().alias("row"), word.alias("w"))
    keys = F.concat(F.array(F.concat(F.lit("="), "w")), F.filter(F.array(*(F.when(F.length("w") >= k, F.concat(F.substring("w", 1, k), F.lit("~"))) for k in STEM_LENGTHS)), lambda x: x.isNotNull()))
    held = words.select("toxic", "row", "w", F.explode(keys).alias("key")).groupBy("key", "row", "toxic").agg(F.min("w").alias("lo"), F.max("w").alias("hi"))
    counts = held.groupBy("key").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"), F.size(F.array_distinct(F.concat(F.collect_set("lo"), F.collect_set("hi")))).alias("words"))
    least = max(LEAST, SHARE * n_toxic)
    rows = counts.where((F.col("t") >= least) & (F.col("t") / n_toxic >= SURE * (F.col("t") / n_toxic + F.col("c") / n_clean))).orderBy(F.desc("t"), "key").limit(20 * MAX_ENTRIES).collect()
    entries = choose_entries({r["key"]: (r["t"], r["words"]) for r in rows})
    if not entries:
        return Model([], None, {})
    automaton = build_automaton(entries)

    def count(batches):
        for batch in slices(batches, "text"):
            texts = batch.column(0).to_pylist()
            text, start, end, code = hits_of(texts, automaton)
            toxic = batch.column(1).to_numpy()
            seen = Counter((c, int(toxic[i])) for i, c, _ in {(i, c, texts[i][a:b].lower()) for i, a, b, c in zip(*(x.tolist() for x in (text, start, end, code)))})
            yield pa.RecordBatch.from_arrays([pa.array([k[j] for k in seen], pa.int64()) for j in (0, 1)] + [pa.array(list(seen.values()), pa.int64())], names=["code", "toxic", "n"])

    met = sample.mapInArrow(count, "code long, toxic long, n long").groupBy("code", "toxic").agg(F.sum("n").alias("n")).collect()
    t, c = ({r["code"]: r["n"] for r in met if r["toxic"] == k} for k in (1, 0))
    weight = {}
    for code in (e * 1000 + i for e in range(3) for i in range(len(entries))):
        if code in t or code in c:
            weight[code] = min(float(np.log((t.get(code, 0) + 0.5) / (n_toxic + 1) * (n_clean + 1) / (c.get(code, 0) + 0.5))), MOST)
        else:
            weight[code] = UNSEEN[code // 1000] * weight.get(code % 1000, 0.0)
    model = Model(entries, automaton, weight)

    def weigh(batches):
        for batch in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(model.evidence(batch.column(0).to_pylist()))], names=["toxic", "x"])

    # Equal sums are one row, so what is collected is no larger than the sample and mostly far smaller.
    found = sample.mapInArrow(weigh, "toxic int, x double").groupBy("toxic", F.round("x", 3).alias("x")).count().collect()
    y, x, k = (np.array([float(r[j]) for r in found]) for j in range(3))
    share = {k: of_all.get(k, 1) / max(n[k], 1) for k in (0, 1)}  # the sample holds the classes in other shares than the labels
    model.curve = fit_curve(x, y, k * np.where(y == 1, share[1], share[0]))
    return model


def score(docs: DataFrame, model: Model, column: str = SCORE) -> DataFrame:
    """``docs`` with one more column, the score of its text."""
    def run(batches):
        for batch in slices(batches, "text"):
            texts = ["" if x is None else x for x in batch.column(batch.schema.get_field_index("text")).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.scores(texts), pa.float64())], names=[*batch.schema.names, column])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(column, DoubleType())]))


def held_out(doc_id="doc_id", folds: int = 5, fold: int = 0):
    """Rows that must not teach: crc32 of the id as text falls into this fold."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == fold, F.lit(False))
