"""Periodic runs, the kernel classifier and importance resampling against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import importance, kernel, runs
from tidemark.llm.queries import QUERIES

MID = "/root/testdata/sf0.01"


def written(df, folder, name):
    df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")


# -- periodic runs


def brute_lyndon(x):
    return [max(k for k in range(1, len(x) - i + 1) if all(x[i:i + k] < x[i + j:i + k] for j in range(1, k))) for i in range(len(x))]


def brute_runs(x, least=12):
    found = []
    for q in range(1, len(x) // 2 + 1):
        i = 0
        while i + q < len(x):
            j = i
            while j + q < len(x) and x[j] == x[j + q]:
                j += 1
            w = x[i:j + q]
            if len(w) >= max(least, 2 * q) and not any(w[p:] == w[:-p] for p in range(1, q)):
                found.append((i, len(w), q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def test_lyndon_arrays_and_runs_equal_brute_force():
    rng = random.Random(1)
    for _ in range(1200):
        x = [rng.randint(0, rng.choice([1, 2, 3])) for _ in range(rng.randint(0, 40))]
        assert runs.lyndon_array(x) == brute_lyndon(x)
        for least in (2, 3, 5, 12):
            start, end, period = runs.runs_of(np.array(x, np.int64), np.zeros(len(x), np.int64), least)
            assert list(zip(start.tolist(), (end - start).tolist(), period.tolist())) == brute_runs(x, least)


def test_runs_of_structured_words_and_of_documents_side_by_side():
    rng = random.Random(2)
    fibonacci = [[0], [0, 1]]
    while len(fibonacci[-1]) < 200:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    thue = [bin(i).count("1") % 2 for i in range(256)]
    period = [rng.randrange(50) for _ in range(37)]
    texts = [fibonacci[-1], thue, period * 7 + period[:5], [3] * 100, list(range(60)) * 2, [], [1], [5] * 12, [5] * 11, (list(range(7)) * 3 + [9]) * 4, [5] * 6]
    words = np.array([w for t in texts for w in t], np.int64)
    doc = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    base = np.cumsum([0] + [len(t) for t in texts])
    start, end, q = runs.runs_of(words, doc)
    for d, t in enumerate(texts):
        own = [(int(a - base[d]), int(b - a), int(p)) for a, b, p in zip(start, end, q) if base[d] <= a < base[d + 1]]
        assert own == brute_runs(t), d


def brute_op11(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute_runs(w)
    kept = [x for i, x in enumerate(w) if not any(s + q <= i < s + k for s, k, q in found)]
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else None
    lines = "".join(f"{s},{k},{q}\n" for s, k, q in found)
    return (doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(" ".join(kept).encode()).hexdigest())


def test_runs_query_equals_brute_force(spark, docs, no_docs, rows, scratch):
    rng = random.Random(3)
    more = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 80))) if i % 7 else "the same line again\n" * rng.randint(1, 9)) for i in range(1000, 1300)]
    table = docs.unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    written(table, scratch, "documents")
    got = Counter(map(tuple, QUERIES["op11_runs"](spark, scratch).collect()))
    expected = Counter(brute_op11(x, t) for x, t in [(r[0], r[1]) for r in rows] + more)
    assert got == expected and sum(n for r, n in got.items() if r[1]) > 20
    assert runs.collapse_runs(no_docs).count() == 0


def test_runs_pass_other_columns_through(spark):
    table = spark.createDataFrame([(1, "x y " * 9, "k", [1]), (2, None, None, None)], "doc_id int, text string, runs string, n_words array<int>")
    got = {r["doc_id"]: r for r in runs.collapse_runs(table).collect()}
    assert got[1]["runs"] == "k" and got[1]["n_words"] == [1] and got[1]["runs_"] == [(0, 18, 2)] and got[1]["collapsed"] == "x y" and got[1]["n_words_"] == 18
    assert got[2]["runs_"] == [] and got[2]["collapsed"] == "" and got[2]["n_words_"] == 0


# -- quality classifier


def test_statistics_of_single_texts():
    texts = ["", "   \n", "Hello WORLD hello hello $$$ 12!\nüber | x", "a b"]
    data = "".join(texts).encode()
    offsets = np.cumsum([0] + [len(t.encode()) for t in texts])
    got = kernel.statistics(np.frombuffer(data, np.uint8), offsets)
    for row, text in zip(got, texts):
        w = text.split()
        n = len(w)
        named = dict(zip(kernel.STATISTICS, row))
        if not text:
            assert not row.any()
            continue
        assert named["words"] == pytest.approx(math.log1p(n)) and named["characters"] == pytest.approx(math.log1p(len(text)))
        assert named["upper"] == pytest.approx(sum("A" <= c <= "Z" for c in text) / len(text)) and named["symbol"] == pytest.approx(sum(c in "$|" for c in text) / len(text))
        assert named["exclamation"] == pytest.approx(text.count("!") / len(text)) and named["bar"] == pytest.approx(text.count("|") / len(text))
        if n:
            assert named["distinct"] == pytest.approx(len(set(w)) / n) and named["repeated"] == pytest.approx(sum(a == b for a, b in zip(w, w[1:])) / n)
            assert named["word_length"] == pytest.approx(math.log1p(np.mean([len(x.encode()) for x in w])))
            assert named["no_letter"] == pytest.approx(sum(not any(c.isalpha() for c in x) for x in w) / n)
            assert named["all_caps"] == pytest.approx(sum(x.isupper() for x in w) / n) and named["ends_symbol"] == pytest.approx(sum(x[-1] in "$|" for x in w) / n)


def test_features_approximate_the_gaussian_kernel():
    rng = np.random.default_rng(3)
    d = len(kernel.STATISTICS)
    turn, phase = kernel.projections(d, 20_000)
    model = kernel.Model(np.zeros(d), np.ones(d), turn, phase, *(np.zeros(0),) * 3)
    x = rng.normal(size=(12, d))
    z = model.features(x)[:, :-1]
    apart = ((x[:, None] - x[None]) ** 2).sum(-1)
    assert np.abs(z @ z.T - np.exp(-apart / (2 * kernel.WIDTH ** 2 * d))).max() < 0.05


def test_isotonic_equals_brute_force():
    rng = np.random.default_rng(4)
    for _ in range(200):
        n = int(rng.integers(1, 12))
        x, y = rng.integers(0, 8, n) / 8, rng.integers(0, 2, n)
        at, share = kernel.isotonic(x, y)
        assert (np.diff(at) > 0).all() and (np.diff(share) > 0).all()
        levels = np.unique(x)
        means, counts = np.array([y[x == v].mean() for v in levels]), np.array([(x == v).sum() for v in levels])
        # min-max formula of isotonic regression
        fit = [max(min(np.average(means[a:b + 1], weights=counts[a:b + 1]) for b in range(i, len(levels))) for a in range(i + 1)) for i in range(len(levels))]
        assert np.unique(np.round(fit, 9)).tolist() == pytest.approx(np.round(share, 9).tolist())


def test_sums_over_tasks_give_the_ridge_fit(spark, monkeypatch):
    docs = spark.read.parquet(f"{MID}/documents.parquet").repartition(7)
    labels = spark.read.parquet(f"{MID}/labels.parquet")
    model = kernel.learn(spark, docs, labels, features=32)
    rows = kernel.teaching(docs, labels, "quality").collect()
    raw = [r["text"].encode() for r in rows]
    stats = kernel.statistics(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(t) for t in raw]))
    assert model.mean == pytest.approx(stats.mean(0)) and model.spread[:2] == pytest.approx(stats.std(0)[:2])
    z, y = model.features(stats), np.array([r["label"] for r in rows], float)
    ridge = np.full(z.shape[1], kernel.RIDGE * len(y))
    ridge[-1] = 1e-9 * len(y)
    assert model.weight == pytest.approx(np.linalg.solve(z.T @ z + np.diag(ridge), z.T @ y), rel=1e-4, abs=1e-6)


def test_quality_on_held_out_labels(spark):
    got = QUERIES["op12_classifier"](spark, MID)
    docs = spark.read.parquet(f"{MID}/documents.parquet")
    assert got.count() == docs.count() and got.where("score < 0 or score > 1 or predicted <> cast(score >= 0.3 as int)").count() == 0
    held = got.where("held_out").join(spark.read.parquet(f"{MID}/labels.parquet"), "doc_id").collect()
    right = [r["predicted"] == r["quality"] for r in held]
    low = [r["predicted"] == 0 for r in held if r["quality"] == 0]
    print("held out", len(held), np.mean(right), "low quality found", np.mean(low), "clean kept", np.mean([r["predicted"] for r in held if r["quality"] == 1]))
    assert np.mean(right) > 0.95
    assert {r["doc_id"] for r in got.where("held_out").collect()} == {x for x in (r["doc_id"] for r in docs.collect()) if zlib.crc32(str(x).encode()) % 5 == 0}


def test_classifier_cases(spark, docs, no_docs):
    clean = [(i, " ".join(f"word{j % 9}" for j in range(30 + i)), 1) for i in range(40)]
    junk = [(100 + i, "### $$$ " * (10 + i), 0) for i in range(40)]
    table = spark.createDataFrame(clean + junk + [(3, None, 1), (None, "###", 0)], "doc_id long, text string, quality int")
    labels = table.select("doc_id", "quality").unionByName(spark.createDataFrame([(None, 1), (5, None), (100, 0)], "doc_id long, quality int"))
    model = kernel.learn(spark, table.select("doc_id", "text"), labels, features=64)
    got = kernel.score(docs, model)
    assert got.columns == [*(c for c in docs.columns if c != "text"), "score_"] and got.where("score_ is null or score_ < 0 or score_ > 1").count() == 0 and got.count() == docs.count()
    seen = {r["doc_id"]: r["score"] for r in kernel.score(table.select("doc_id", "text").where("text is not null and doc_id is not null"), model).collect()}
    assert min(seen[i] for i, _, y in clean if y) > max(seen[i] for i, _, y in junk)
    assert kernel.score(no_docs, model).count() == 0
    for part, share in (("quality = 1", 1.0), ("quality > 5", 0.5)):
        one = kernel.learn(spark, table, labels.where(part), features=16)
        assert {r["score_"] for r in kernel.score(docs, one).collect()} == {share}
    again = kernel.learn(spark, table.select("doc_id", "text").repartition(5), labels, features=64)
    assert np.allclose(again.weight, model.weight, atol=1e-5)


# -- importance resampling


def test_crcs_of_ngrams_come_from_two_prefixes():
    rng = random.Random(2)
    texts = ["".join(rng.choice("abcXYZ09 .,-éß日\n\0") for _ in range(rng.randint(0, 300))).encode() for _ in range(80)] + [b"x" * 70_000 + b" " + b"y" * 700 + b" z", b""]
    for low, high in ((1, 1), (1, 3), (2, 4)):
        crcs, owner, count = importance.ngram_crcs(texts, (low, high), importance.Shifts())
        words = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t.decode())) for t in texts]
        expected = [(zlib.crc32(" ".join(w[i:i + n]).encode()), d) for n in range(low, high + 1) for d, w in enumerate(words) for i in range(len(w) - n + 1)]
        assert list(zip(crcs.tolist(), owner.tolist())) == expected and count.tolist() == [len(w) for w in words]


def brute_resample(rows, targets, percent=10, least=20, ngrams=(1, 1), buckets=10_000):
    def features(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return len(w), [zlib.crc32(" ".join(w[i:i + n]).encode()) % buckets for n in range(ngrams[0], ngrams[1] + 1) for i in range(len(w) - n + 1)]

    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(features(text)[1])
    for text in targets:
        t.update(features(text)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    out = []
    for x, text in rows:
        n, f = features(text)
        gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets)))) for b in f]
        weight = sum(gain) // len(gain) if gain else 0
        score = None
        if x is not None:
            h = int(hashlib.sha256(f"2024:{x}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([x, len(f), weight, score, None, n])
    may = sorted((r for r in out if r[5] >= least and r[3] is not None), key=lambda r: (-r[3], r[0], r[1], r[2]))
    for k, r in enumerate(may[:percent * len(may) // 100]):
        r[4] = k + 1
    return Counter(tuple(r[:5]) for r in out)


def test_resampling_equals_brute_force(spark, docs, no_docs, rows, scratch):
    small = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select((F.col("doc_id") + 1000).alias("doc_id"), "text")
    target = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").unionByName(spark.createDataFrame([(None, None)], "item_id long, text string"), allowMissingColumns=True)
    written(docs.unionByName(small, allowMissingColumns=True), scratch, "documents")
    written(target, scratch, "benchmark")
    held = [(r["doc_id"], r["text"]) for r in small.collect()] + [(r[0], r[1]) for r in rows]
    goal = [r["text"] for r in target.collect()]
    got = QUERIES["op13_resampling"](spark, scratch)
    assert [f.dataType.simpleString() for f in got.schema.fields] == ["bigint"] * 5
    assert Counter(map(tuple, got.collect())) == brute_resample(held, goal)
    wide = importance.resample(spark, docs.unionByName(small, allowMissingColumns=True), target, ngrams=(1, 2), percent=35)
    assert wide.columns == [*(c for c in docs.columns if c != "text"), "n_features", "n_words", "weight", "score_", "rank"]
    assert Counter(map(tuple, wide.select("doc_id", "n_features", "weight", "score_", "rank").collect())) == brute_resample(held, goal, 35, ngrams=(1, 2))
    assert importance.resample(spark, no_docs, target).count() == 0
    assert importance.resample(spark, docs, target.limit(0)).count() == docs.count()


def test_draw_of_ties(spark):
    scored = spark.createDataFrame([(i, 5) for i in range(50)] + [(i, 6) for i in range(50, 53)] + [(None, 9), (60, None)], "doc_id long, score long")
    got = importance.draw(spark, scored, F.col("doc_id").isNotNull(), 20)
    assert sorted((r["rank"], r["doc_id"]) for r in got.where("rank is not null").collect()) == list(enumerate([50, 51, 52, *range(7)], 1)) and got.count() == 55
