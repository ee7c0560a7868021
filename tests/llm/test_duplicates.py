"""Jaccard join and suffix de-duplication against brute force."""

import hashlib
import re

import numpy as np
import pytest

from tidemark.llm import jaccard, suffixes
from tidemark.llm.components import connected_components


def shingles(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_components(rows):
    sets = [(r[0], shingles(r[1])) for r in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                parent[root(i)] = root(j)
    out = []
    for i, (x, s) in enumerate(sets):
        ids = [y for j, (y, _) in enumerate(sets) if root(j) == root(i) and y is not None]
        out.append((x, len(s), (min(ids) if ids else None) if s else x))
    return sorted(out, key=repr)


def test_near_duplicates_equal_brute_force(spark, docs, rows):
    got = jaccard.near_duplicates(spark, docs).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=repr) == brute_components(rows)


def test_blocks_smaller_than_a_family(spark, docs, rows, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 2)
    got = jaccard.near_duplicates(spark, docs).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=repr) == brute_components(rows)


def test_long_common_passages_without_links(spark):
    """Texts with one long passage in common and ends of their own, of many lengths: some link, most do not."""
    rng = np.random.default_rng(9)
    passage = " ".join(f"p{i}" for i in range(80))
    rows = []
    for i in range(90):
        own = " ".join(f"w{i}x{j}" for j in range(int(rng.choice([0, 3, 9, 12, 20, 24, 40, 70]))))
        rows.append((i, passage + " " + own))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard.near_duplicates(spark, docs).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=repr) == brute_components(rows)


def test_sets_too_long_for_their_overlap_do_not_meet(spark):
    """3,000 sets of 100 shingles, all with the same 76: nine million pairs if they met at a common shingle."""
    met = spark.range(3000).selectExpr("7L AS token", "76L AS rest", "id AS class", "id AS comp", "100L AS n", "1L AS size", "0L AS block")
    short = spark.range(3000, 3002).selectExpr("7L AS token", "76L AS rest", "id AS class", "id AS comp", "76L AS n", "1L AS size", "0L AS block")
    assert jaccard.askers(met, 75).join(jaccard.answerers(met), ["token", "band"]).count() == 0
    both = met.unionByName(short)
    assert {(r.g_comp, r.g_block) for r in jaccard.candidates(both, 75).where("class < 3000").collect()} == {(3000, 0), (3001, 0)}
    assert jaccard.candidates(both, 75).where("class < 3000").count() == 6000


@pytest.mark.parametrize("edges", [(1, 400)])
def test_size_bands_rise(spark, edges):
    bands = [r[0] for r in spark.range(*edges).select(jaccard.size_band(jaccard.F.col("id"))).collect()]
    assert bands == sorted(bands) and len(set(bands)) < 60


def test_near_duplicates_empty(spark, no_docs):
    assert jaccard.near_duplicates(spark, no_docs).count() == 0


def test_overlaps_of_a_block():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 300, rng.integers(1, 200))).astype(np.uint64) for _ in range(20)]
    got = jaccard.overlaps(sets, columns=16)
    for i in range(20):
        for j in range(20):
            assert i == j or got[i, j] == len(np.intersect1d(sets[i], sets[j])) == jaccard.overlap_of(sets[i], sets[j])


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7), (None, 3)], "a long, b long")
    got = {r["node"]: r["root"] for r in connected_components(spark, edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def brute_removed(rows, length=50):
    first = {}
    for x, text, *_ in rows:
        if x is not None:
            data = (text or "").encode()
            for i in range(len(data) - length + 1):
                s = data[i:i + length]
                first[s] = min(first.get(s, x), x)
    out = []
    for x, text, *_ in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        if x is not None:
            for i in range(len(data) - length + 1):
                if first[data[i:i + length]] < x:
                    gone[i:i + length] = True
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((x, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_remove_repeats_equals_brute_force(spark, docs, rows):
    got = suffixes.remove_repeats(spark, docs).collect()
    assert sorted(map(tuple, got), key=repr) == brute_removed(rows)


def test_remove_repeats_empty(spark, no_docs):
    assert suffixes.remove_repeats(spark, no_docs).count() == 0


def test_kept_texts_are_what_is_left(spark, docs, rows):
    kept = suffixes.kept_texts(spark, docs).collect()
    found = {x[0]: x for x in brute_removed(rows)}
    assert len(kept) == len(rows)
    for r in kept:
        if r["doc_id"] is None:
            assert r["__left"] is None
        else:
            _, _, removed, _, digest = found[r["doc_id"]]
            assert (r["__left"] is not None) == (removed > 0)
            if r["__left"] is not None and "é" not in r["text"]:
                assert hashlib.sha256(r["__left"].encode()).hexdigest() == digest


@pytest.mark.parametrize("length", [26, 50, 64])
def test_equal_groups_and_anchors(length):
    rng = np.random.default_rng(length)
    base = rng.integers(97, 100, 300, dtype=np.uint8).tobytes()
    texts = [base[:150], base[40:220] + b"z" + base[:90], b"", base, b"ab" * 150, b"q" + b"ab" * 90]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0] + [len(t) for t in texts])
    doc, value, first, last = suffixes.anchors(data, offsets, length)
    starts = np.concatenate([np.arange(a, b + 1) for a, b in zip(first, last)])
    expected = [o + i for o, t in zip(offsets, texts) for i in range(len(t) - length + 1)]
    assert starts.tolist() == expected
    of = {}
    for a, b, v in zip(first, last, value):
        for i in range(a, b + 1):
            assert of.setdefault(data[i:i + length].tobytes(), v) == v
    groups = suffixes.equal_groups(data, starts, length)
    strings = [data[i:i + length].tobytes() for i in starts]
    assert len(set(groups.tolist())) == len(set(strings)) == len(set(zip(groups.tolist(), strings)))
