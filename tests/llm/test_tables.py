"""Neighbours, url reputation, mixing and the pipeline."""

import hashlib
import os
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import mixing, neighbours, reputation, suffixes
from tidemark.llm.queries import FRACTION, QUERIES, SQL, TARGETS

SMALL = "/root/testdata/sf0.001"


def brute_nearest(ids, matrix, k, every):
    out = {}
    for i in range(len(ids)):
        if ids[i] % every == 0:
            score = matrix @ matrix[i]
            order = [j for j in np.lexsort((ids, -score)) if ids[j] != ids[i]]
            out[int(ids[i])] = [(int(ids[j]), score[j]) for j in order[:k]]
    return out


def test_recall_on_embeddings(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    got = {}
    for r in neighbours.nearest(spark, table).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    rows = table.collect()
    expected = brute_nearest(np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], np.float64), 20, 20)
    assert got.keys() == expected.keys() and all(len(v) == 20 for v in got.values())
    assert np.mean([len({x for x, _ in got[q]} & {x for x, _ in expected[q]}) / 20 for q in got]) >= 0.9
    exact = {(q, x): s for q, v in expected.items() for x, s in v}
    assert all(abs(s - exact[q, x]) < 1e-12 for q, v in got.items() for x, s in v if (q, x) in exact)


def test_neighbours_with_awkward_rows(spark):
    rng = np.random.default_rng(4)
    vectors = [rng.normal(size=8).tolist() for _ in range(60)]
    rows = [(i, v) for i, v in enumerate(vectors)] + [(i, vectors[0]) for i in range(100, 160)] + [(20, vectors[20])]
    odd = [(200, None), (201, []), (202, [0.0] * 8), (203, [float("nan")] + [1.0] * 7), (204, [1.0, None] + [1.0] * 6), (None, vectors[1]), (220, [float("inf")] * 8)]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")
    got = {}
    for r in neighbours.nearest(spark, table, k=5).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    held = dict(rows)
    ids = np.array(sorted(held))
    expected = brute_nearest(ids, np.array([held[i] for i in ids]), 5, 20)
    assert got == {q: [x for x, _ in v] for q, v in expected.items()}
    assert neighbours.nearest(spark, table.where("vec_id >= 200")).count() == 0


@pytest.mark.parametrize("sigma", [0.3, 1.0])
def test_recall_on_unequal_norms(spark, sigma):
    rng = np.random.default_rng(12)
    matrix = rng.normal(size=(2000, 64))
    matrix *= (np.exp(sigma * rng.normal(size=2000)) / np.linalg.norm(matrix, axis=1))[:, None]
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(matrix)], "vec_id long, embedding array<double>")
    got = {}
    for r in neighbours.nearest(spark, table).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    expected = brute_nearest(np.arange(2000), matrix, 20, 20)
    recall = np.mean([len(got[q] & {x for x, _ in v}) / 20 for q, v in expected.items()])
    print("recall", sigma, recall)
    assert recall >= 0.9


def test_tied_scores_go_to_the_smallest_ids(spark):
    rows = [(0, [1.0, 0.0, 0.0])] + [(i, [1.0, float(i), 0.0]) for i in range(1, 100) if i % 20] + [(i, [1.0, 0.0, float(i)]) for i in range(101, 120)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [r["vec_id"] for r in neighbours.nearest(spark, table, k=5).where("query_id = 0").orderBy("rank").collect()]
    assert got == [1, 2, 3, 4, 5]


def test_closeness_is_the_footrule():
    rng = np.random.default_rng(0)
    q, d = (np.array([rng.permutation(30)[:6] for _ in range(n)], np.int16) for n in (5, 7))
    files = neighbours.Files(d, 30)
    for i in range(5):
        for j, c in enumerate(files.closeness(q[i])):
            a, b = ({p: k for k, p in enumerate(x)} for x in (q[i].tolist(), d[j].tolist()))
            assert 42 - 2 * c == sum(abs(a.get(p, 6) - b.get(p, 6)) for p in a.keys() | b.keys())


def test_hosts_paths_and_rules(spark):
    urls = ["https://A.Example.ORG/en/12?x#y", "http://b.com", "http://b.com?q=/fr/1", "nothing", None, "", "x://h.net/de/1#a", "http://example.org/es/1", "http://notexample.org/es/1",
            "http://c.com/de/2", "http://com/fr/", "http://D.COM/FR/1", "https://example.org/en/2", "a://b://c/d"]
    table = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)] + [(0, urls[0], None), (None, urls[9], 1)], "page_id long, url string, good int")
    got = {r["page_id"]: tuple(r)[1:5] for r in reputation.judge(table).collect()}
    assert got[0] == ("a.example.org", "/en/12", "example.org/en/1", "block") and got[1] == ("b.com", "", None, "allow") and got[2] == ("b.com", "", None, "allow")
    assert got[3] == got[4] == got[5] == ("", "", None, "allow") and got[6] == ("h.net", "/de/1", None, "allow")
    assert got[7][2:] == ("example.org/es/", "block") and got[8][2:] == ("org/", "allow") and got[9][2:] == ("com/de/", "block")
    assert got[10][2:] == ("com/fr/", "allow") and got[11] == ("d.com", "/FR/1", None, "allow") and got[12][2:] == ("org/", "allow") and got[13] == ("b:", "//c/d", None, "allow")
    assert reputation.judge(table.limit(0)).count() == 0


def test_bad_hosts_are_blocked_and_small_ones_follow_their_domain(spark):
    rows = [(i, f"http://good{i % 5}.fine.net/x", 1) for i in range(100)] + [(200 + i, "http://bad.spam.net/x", 0) for i in range(60)] + [(300, "http://new.spam.net/x", 0), (301, "http://new.fine.net/x", 0), (302, "http://none.spam.net/x", None)]
    got = {r["page_id"]: r for r in reputation.judge(spark.createDataFrame(rows, "page_id long, url string, good int")).collect()}
    assert got[200]["verdict"] == "block" and got[0]["verdict"] == "allow" and got[301]["verdict"] == "allow"
    assert got[300]["reputation"] < got[301]["reputation"] and got[300]["verdict"] == "block" and got[302]["verdict"] == "block"


def brute_reputation(rows):
    """{host: (rate, upper)} by the same estimates, in plain Python."""
    def split(host):
        labels = host.split(".")
        size = 2 if ".".join(labels[-2:]) in reputation.SUFFIXES else 1
        return ".".join(labels[-size - 1:]), ".".join(labels[-size:])

    def strength(children, parent):
        num = den = 0.0
        for p in set(parent.values()):
            own = [children[c] for c in children if parent[c] == p and children[c][0]]
            n, k = sum(x for x, _ in own), sum(y for _, y in own)
            if n:
                q = k / n * (1 - k / n)
                num += sum(x * (y / x - k / n) ** 2 for x, y in own) - q * (len(own) - 1)
                den += q * (n - sum(x * x for x, _ in own) / n - (len(own) - 1))
        return reputation.STRENGTH if den <= 1e-12 else reputation.STRONGEST if num / den <= 0 else min(max(den / num - 1, reputation.WEAKEST), reputation.STRONGEST)

    hosts = {}
    for host, good in rows:
        n, k = hosts.get(host, (0, 0))
        hosts[host] = (n + (good is not None), k + (good or 0))

    def up(children, parent):
        out = {}
        for c, (n, k) in children.items():
            a, b = out.get(parent[c], (0, 0))
            out[parent[c]] = (a + n, b + k)
        return out

    of_host = {h: split(h) for h in hosts}
    domains = up(hosts, of_host)
    of_domain = {d: d[1] for d in domains}
    tops = up(domains, of_domain)
    of_top = dict.fromkeys(tops, "all")
    n, k = up(tops, of_top)["all"]
    rate = {"all": (k + 1) / (n + 2)}
    for children, parent in ((tops, of_top), (domains, of_domain), (hosts, of_host)):
        s = strength(children, parent)
        rate = {c: (k + s * rate[parent[c]]) / (n + s) for c, (n, k) in children.items()}
    return {h: (r, r + reputation.Z * (r * (1 - r) / (hosts[h][0] + s + 1)) ** 0.5) for h, r in rate.items()}


def test_strengths_and_bounds_equal_brute_force(spark):
    rng = np.random.default_rng(8)
    rows = []
    for d in range(30):
        name = f"d{d}." + ["net", "com", "co.uk", "org"][d % 4]
        good = rng.beta(0.5, 0.5)
        for h in range(int(rng.integers(1, 8))):
            share = rng.beta(8 * good + 0.01, 8 * (1 - good) + 0.01)
            n = int(rng.choice([0, 1, 3, 20, 60]))
            rows += [(f"h{h}.{name}", int(rng.random() < share)) for _ in range(n)] + [(f"h{h}.{name}", None)]
    rows += [("", None), ("com", 1), ("co.uk", 0)]
    expected = brute_reputation(rows)
    got = {r["host"]: r for r in reputation.reputations(spark.createDataFrame(rows, "host string, good int").repartition(4)).collect()}
    assert got.keys() == expected.keys()
    for host, (rate, upper) in expected.items():
        assert got[host]["rate"] == pytest.approx(rate, rel=1e-9, abs=1e-12) and got[host]["upper"] == pytest.approx(upper, rel=1e-9, abs=1e-12)
    assert any(r["bad"] and r["labelled"] == 0 for r in got.values()) and any(not r["bad"] and r["labelled"] == 0 for r in got.values())


def test_verdicts_equal_their_sql_where_the_method_blocks(spark):
    rng = np.random.default_rng(5)
    rows, page = [], 0
    for d in range(12):
        for h in range(4):
            for i in range(int(rng.choice([1, 5, 40]))):
                rows.append((page, f"http://h{h}.site{d}.{['net', 'co.uk'][d % 2]}/p", None if h == 3 else int(d % 3 > 0)))
                page += 1
    table = spark.createDataFrame(rows, "page_id long, url string, good int")
    got = {r["page_id"]: tuple(r)[:5] for r in reputation.judge(table).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t (page_id BIGINT, url VARCHAR, good DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?)", rows)
    sql = reputation.verdict_sql("SELECT page_id, regexp_extract(url, '://([^/?#]*)', 1) AS host, regexp_extract(url, '://[^/?#]*([^?#]*)', 1) AS path, good FROM t")
    assert got == {r[0]: r for r in con.execute(sql).fetchall()}
    blocked = {r[1].split(".", 1)[1] for r in got.values() if r[4] == "block"}
    assert blocked == {f"site{d}.{['net', 'co.uk'][d % 2]}" for d in range(0, 12, 3)} and any(r[1].startswith("h3.") and r[4] == "block" for r in got.values())


def brute_rake(cells, goals, sweeps=200):
    total = sum(cells.values())
    w = {c: v / total for c, v in cells.items()}
    for _ in range(sweeps):
        for axis, goal in enumerate(goals):
            sums = Counter()
            for c, v in w.items():
                sums[c[axis]] += v
            w = {c: v * goal[c[axis]] / sums[c[axis]] for c, v in w.items()}
    return w


def test_raking_meets_targets_like_brute_force(spark):
    rng = np.random.default_rng(6)
    cells = {(s, lang, t): float(rng.integers(1, 100)) for s in "abc" for lang in ("x", "y") for t in ("p", "q")}
    table = spark.createDataFrame([(*c, v) for c, v in cells.items()], "source string, lang string, topic string, held double")
    targets = {"source": {"a": 0.2}, "lang": {"x": 0.7, "y": 0.3}, "topic": {"p": 0.5, "missing": 0.1}}
    got = {(r["source"], r["lang"], r["topic"]): r["weight"] for r in mixing.rake(spark, table, targets, sweeps=60, tolerance=1e-10).collect()}
    total = sum(cells.values())
    of = {s: sum(v for c, v in cells.items() if c[0] == s) / total for s in "abc"}
    source = {"a": 0.2, **{s: 0.8 * of[s] / (of["b"] + of["c"]) for s in "bc"}}
    topic = {"p": 0.5 / 0.9, "q": 0.4 / 0.9}
    expected = brute_rake(cells, [source, {"x": 0.7, "y": 0.3}, topic])
    assert got == pytest.approx(expected, abs=1e-7)


def test_mix_of_awkward_rows(spark, docs, no_docs):
    targets = {"lang": {"en": 0.5, "de": 0.3, "": 0.2}}
    got = mixing.mix(spark, docs, targets)
    assert got.columns[:len(docs.columns)] == docs.columns
    every = Counter(map(repr, docs.collect()))
    kept = Counter(repr(r) for r in got.select(*docs.columns).collect())
    assert not kept - every and 0 < sum(kept.values()) <= sum(every.values())
    assert all(kept[r] in (0, every[r]) for r in every)  # rows that repeat draw alike
    assert kept == Counter(repr(r) for r in mixing.mix(spark, docs, targets).select(*docs.columns).collect())
    assert mixing.mix(spark, no_docs, targets).count() == 0


def test_mix_comes_near_its_targets(spark):
    rows = [(i, "word " * 50, "en" if i % 4 else "de", f"s{i % 3}") for i in range(20_000)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = mixing.mix(spark, table, {"lang": {"en": 0.5, "de": 0.5}, "source": {"s0": 0.2}}).groupBy("lang", "source").count().collect()
    total = sum(r["count"] for r in got)
    assert abs(sum(r["count"] for r in got if r["lang"] == "de") / total - 0.5) < 0.03
    assert abs(sum(r["count"] for r in got if r["source"] == "s0") / total - 0.2) < 0.03


def test_unnamed_languages_keep_their_share(spark):
    langs = ["en", "de", "fr", "es", None, "it"]
    rows = [(i, f"some words of text {i % 10}", langs[i % 6], f"src{i // 6 % 4}") for i in range(6000)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = mixing.mix(spark, table, {"lang": TARGETS["lang"]}).groupBy("lang").count().collect()
    kept = {r["lang"]: r["count"] for r in got}
    total = sum(kept.values())
    for lang, share in {None: 1 / 6, "it": 1 / 6, **{k: v * 4 / 6 for k, v in TARGETS["lang"].items()}}.items():
        assert abs(kept.get(lang, 0) / total - share) < 0.03
    registered = mixing.mix(spark, table, TARGETS, FRACTION).groupBy("lang").count().collect()
    assert {r["lang"] for r in registered} == set(langs)


def test_registered_mix_meets_its_targets_where_there_are_tokens(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    keyed = docs.select("source", "lang", mixing.topic_of(F.col("text")).alias("topic"), mixing.tokens_of(F.col("text")).alias("tokens"))
    cells = [r.asDict() for r in mixing.sampling_rates(spark, keyed.fillna("", ["source", "lang"]), TARGETS, FRACTION).collect()]
    held = sum(c["held"] for c in cells)
    kept = sum(c["held"] * c["rate"] for c in cells)
    assert kept / held == pytest.approx(FRACTION, abs=1e-3)
    for key, wanted in TARGETS.items():
        share = {x: sum(c["held"] * c["rate"] for c in cells if c[key] == x) / kept for x in wanted}
        most = {x: sum(c["held"] for c in cells if c[key] == x) / held / FRACTION for x in wanted}
        for x in wanted:  # the target, or all that the category holds
            assert share[x] >= min(wanted[x], most[x]) - 2e-3
    every = [c["rate"] for c in cells if c["source"] == "src0"]
    assert every and min(every) == pytest.approx(1.0, abs=1e-3)  # holds less than its target


def test_fill_stops_at_caps(spark):
    rows = [("a", i, float(f), float(c)) for i, (f, c) in enumerate([(1, 1), (5, 2), (2, 9), (0, 3)])] + [("b", i, 1.0, 0.1) for i in range(3)]
    table = spark.createDataFrame(rows, "g string, i int, v double, cap double")
    got = mixing.fill(table, "v", F.lit(6.0), ["g"], ["i"]).orderBy("g", "i").collect()
    assert [min(r["v"], r["cap"]) for r in got if r["g"] == "a"] == pytest.approx([1.0, 2.0, 3.0, 0.0])
    assert [min(r["v"], r["cap"]) for r in got if r["g"] == "b"] == pytest.approx([0.1] * 3)


def test_queries_equal_their_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "pages", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{os.path.join(SMALL, name)}.parquet')")
    for name, sql in SQL.items():
        rel = con.sql(sql)
        df = QUERIES[name](spark, SMALL)
        assert sorted(df.columns) == sorted(rel.columns)
        assert Counter(map(tuple, df.collect())) == Counter(rel.select(*[f'"{c}"' for c in df.columns]).fetchall())


def test_pipeline_stages(spark, docs, rows):
    """Every stage on the awkward table: columns stay, and what is kept is what brute force keeps."""
    from test_duplicates import brute_components, brute_removed
    columns = docs.columns
    clean = corpus_pipeline.drop_toxic(spark, docs, SMALL)
    assert clean.columns == columns and clean.count() == docs.count()  # nothing toxic in it
    unique = corpus_pipeline.drop_near_duplicates(spark, docs, SMALL)
    named = {x: c for x, _, c in brute_components(rows) if x is not None}
    assert unique.columns == columns
    assert sorted(r["doc_id"] for r in unique.where("doc_id is not null").collect()) == sorted({c for c in named.values()})
    assert unique.where("doc_id is null").count() == 2
    unique = unique.cache()
    cut = corpus_pipeline.cut_repeats(spark, unique, SMALL)
    assert cut.columns == columns
    left = {r["doc_id"]: r for r in cut.where("doc_id is not null").collect()}
    for x, n, removed, _, _ in brute_removed([tuple(r) for r in unique.collect()]):
        if x is not None:
            assert (x in left) == (n == 0 or removed < n)
            if x in left and removed:
                assert left[x]["n_chars"] == len(left[x]["text"]) and len(left[x]["text"].encode()) <= n - removed
    mixed = corpus_pipeline.mix_sources(spark, unique, SMALL)
    assert mixed.columns == columns and mixed.count() <= unique.count()
    assert corpus_pipeline.pack(spark, unique, SMALL).count() >= unique.count()


def clashing_rows():
    """Rows that share an id: different texts, a null, empty ones, near copies under one id, repeated rows."""
    line = "a passage that several documents hold word for word, well over fifty bytes long"
    near = " ".join(f"n{i}" for i in range(60))
    rows = [(10, "first text of the id with words of its own one two three"), (10, "second text under the same id and nothing like the first"), (10, None), (10, ""), (10, ""),
            (11, near), (11, near + " tail"), (12, near + " other"), (13, "only here " * 3 + line), (14, "x1 x2 " + line + " y1"), (14, "z1 " + line + " z2 z3 z4"),
            (15, "alone on this id"), (15, "alone on this id"), (None, near), (None, line)]
    return [(x, t, "en", f"s{i}", len(t or "")) for i, (x, t) in enumerate(rows)]


def test_texts_under_one_id_are_documents_of_their_own(spark):
    from test_duplicates import brute_removed
    rows = clashing_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    unique = corpus_pipeline.drop_near_duplicates(spark, docs, SMALL).cache()
    kept = Counter((r["doc_id"], r["text"]) for r in unique.collect())
    assert unique.columns == docs.columns
    assert kept == Counter({(10, rows[0][1]): 1, (10, rows[1][1]): 1, (10, None): 1, (10, ""): 2, (13, rows[8][1]): 1, (14, rows[9][1]): 1, (14, rows[10][1]): 1, (15, rows[11][1]): 1,
                            (None, rows[13][1]): 1, (None, rows[14][1]): 1, **{(11, t): 1 for x, t in kept if x == 11}})
    assert sum(n for (x, _), n in kept.items() if x == 11) == 1
    got = suffixes.remove_repeats(spark, docs).collect()
    assert sorted(map(tuple, got), key=repr) == brute_removed(rows)
    cut = {(r["doc_id"], r["text"]): r["__left"] for r in suffixes.kept_texts(spark, docs).collect()}
    for y, t, *_ in rows:
        (x, n, removed, _, digest), = {r for r in brute_removed(rows) if r[0] == y and r[1] == len((t or "").encode()) and (r[2] or r[4] == hashlib.sha256((t or "").encode()).hexdigest())}
        assert (cut[y, t] is not None) == (removed > 0) and (removed == 0 or hashlib.sha256(cut[y, t].encode()).hexdigest() == digest)
    repeats = corpus_pipeline.cut_repeats(spark, docs, SMALL)
    assert repeats.columns == docs.columns and sorted(len(r["text"] or "") for r in repeats.collect()) == sorted(n - g for _, n, g, _, _ in brute_removed(rows) if not n or g < n)


def test_pipeline_runs(spark):
    got = corpus_pipeline.run(spark, SMALL).collect()
    room = Counter()
    for r in got:
        room[r["sequence_id"]] += r["length"]
    assert got and max(room.values()) <= 2048
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "repeats", "mixing", "packing"]


def test_a_query_gathers_no_entries_of_its_files():
    """Scratch of one query on a whole block: small numbers row by row, not indices and places of 150,000 entries."""
    import tracemalloc

    rng = np.random.default_rng(3)
    order = np.argsort(rng.random((neighbours.BLOCK, neighbours.PIVOTS)), axis=1)[:, :neighbours.LENGTH].astype(np.int16)
    files = neighbours.Files(order[1:], neighbours.PIVOTS)
    tracemalloc.start()
    files.closeness(order[0])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2_500_000
