"""Packing, language id, toxicity, licences and quality."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import divergence, langid, licences, packing, toxicity
from tidemark.llm.queries import tokenizer_path

# -- packing


def test_best_fit_decreasing_equals_a_linear_search():
    rng = random.Random(3)
    for _ in range(100):
        lengths = sorted((rng.randint(1, 64) for _ in range(rng.randint(0, 60))), reverse=True)
        sequence, offset, used = packing.best_fit_decreasing(lengths, 64)
        rooms, fill = [], [0] * used
        for n in lengths:
            fits = [r for r in rooms if r >= n]
            if fits:
                rooms[rooms.index(min(fits))] -= n
            else:
                rooms.append(64 - n)
        for n, s, o in zip(lengths, sequence, offset):
            assert fill[s] == o
            fill[s] += n
        assert sorted(rooms) == sorted(64 - f for f in fill)


def test_word_tokens_equal_the_tokenizer(rows):
    tokens = packing.WordTokens(tokenizer_path())
    odd = ["Hello, it's  'S we're <|endoftext|> É e\u0301 ß ΑΣ. Σ' İx a.,b!? x...'s ...,,  a b\u0085c\x1cd 12,3. 日本語。テ foo.,", "á.", "»a«, x'd, 'll. \u0301,"]
    texts = [r[1] or "" for r in rows] + odd
    expected = [np.array(x.ids, "<u4").tobytes() for x in tokens.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert tokens.encode(texts) == expected
    assert tokens.encode(texts) == expected  # from what it has learnt


def test_word_cache_starts_anew(rows, monkeypatch):
    monkeypatch.setattr(packing, "WORD_CACHE", 50)
    tokens = packing.WordTokens(tokenizer_path())
    texts = [r[1] or "" for r in rows]
    expected = [np.array(x.ids, "<u4").tobytes() for x in tokens.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [tokens.encode([t])[0] for t in texts] == expected


def test_a_known_word_is_looked_up_once():
    class Counting(dict):
        asked = 0

        def get(self, k):
            self.asked += 1
            return super().get(k)

        def __contains__(self, k):
            self.asked += 1
            return super().__contains__(k)

        def __getitem__(self, k):
            self.asked += 1
            return super().__getitem__(k)

    tokens = packing.WordTokens(tokenizer_path())
    tokens.known = Counting()
    text = "one two three, two one"
    first = tokens.encode([text])
    tokens.known.asked = 0
    assert tokens.encode([text]) == first and tokens.known.asked == 5


def test_latin_words_need_only_the_model(monkeypatch):
    tokens = packing.WordTokens(tokenizer_path())
    texts = ["Straße élève, (übungen)*** 12:30 naïve-été x2y", "Ça «va»? mañana... a_b#c", "²³ ¼ ŒUVRE \x85x"]
    expected = tokens._ids(texts)
    monkeypatch.setattr(tokens, "_ids", lambda words: pytest.fail(f"whole tokenizer for {words}") if words != ["\x85x"] else [expected[2][-4:]])
    assert tokens.encode(texts) == expected


def test_letters_composed_in_lower_case_only():
    tokens = packing.WordTokens(tokenizer_path())
    texts = ["T\u0308 aT\u0308b", "J\u030c J\u030c", "t\u0308 e\u0301 E\u0301"]
    assert tokens.encode(texts) == tokens._ids(texts)


def test_a_worker_keeps_few_words_after_a_task(monkeypatch):
    class Task:
        get = staticmethod(lambda: Task)
        partitionId = staticmethod(lambda: 0)

    monkeypatch.setattr(packing, "TaskContext", Task)
    monkeypatch.setattr(packing, "WORDS_KEPT", 20, raising=False)
    monkeypatch.setattr(packing, "_LOADED", {})
    texts = [f"common word{chr(97 + i % 26)}{chr(97 + i // 26)}, and" for i in range(300)]
    batch = packing.pa.RecordBatch.from_pydict({"doc_id": list(range(300)), "text": texts})
    run = packing._pieces(tokenizer_path(), packing.SIZE, packing.END_ID, 1, True)
    first, second = [[b.to_pydict() for b in run([batch])] for _ in range(2)]
    assert first == second and len(packing._LOADED[tokenizer_path()].known) <= 20


def test_equal_rows_are_dealt_to_all_packers(spark):
    n = 40_000
    docs = spark.range(n).selectExpr("if(id % 2 = 0, -5L, id) AS doc_id", "if(id % 4 = 0, cast(null AS string), 'same words again') AS text")
    packed = packing.pack_documents(spark, docs, tokenizer_path())
    sizes = {r[0]: r[1] for r in packed.where("doc_id = -5").selectExpr("sequence_id >> 32 AS packer").groupBy("packer").count().collect()}
    assert sum(sizes.values()) == n // 2
    assert len(sizes) == -(-n // packing.PACKER_ROWS) and max(sizes.values()) < 2 * (n // 2) / len(sizes)
    assert packed.count() == n
    assert packed.groupBy("sequence_id").agg({"length": "sum"}).where(f"`sum(length)` > {packing.SIZE}").count() == 0


def test_pack_round_trip(spark, docs, rows):
    packed = packing.pack_documents(spark, docs, tokenizer_path(), with_ids=True)
    got = [r.asDict() for r in packed.collect()]
    tokenizer = packing.WordTokens(tokenizer_path()).tokenizer
    expected = Counter()
    for x, text, *_ in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for start in range(0, len(ids), 2048):
            expected[x, start, np.array(ids[start:start + 2048], "<u4").tobytes(), len(ids)] += 1
    assert Counter((r["doc_id"], r["start"], bytes(r["ids"]), r["doc_tokens"]) for r in got) == expected
    room = {}
    for r in sorted(got, key=lambda r: r["offset"]):
        assert r["offset"] == room.get(r["sequence_id"], 0) and r["ids_crc32"] == zlib.crc32(bytes(r["ids"])) and 4 * r["length"] == len(r["ids"])
        room[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(room.values()) <= 2048
    whole = {r["sequence_id"]: r for r in packing.sequences(packed).collect()}
    assert {s: r["length"] for s, r in whole.items()} == room and all(len(r["ids"]) == r["length"] for r in whole.values())


def test_pack_empty(spark, no_docs):
    assert packing.pack_documents(spark, no_docs, tokenizer_path()).count() == 0


# -- language id


def test_parse_equals_brute_force():
    trained = {"a": "abracadabra banana", "b": "hello world yellow"}
    model = langid.fit({k: [v] for k, v in trained.items()})
    rng = random.Random(2)

    def brute(text, train):
        folded, n = "".join(map(chr, langid.folded(text))), 0
        for at in range(0, len(folded), langid.LANE):
            lane, i = folded[at:at + langid.LANE], 0
            while i < len(lane):
                k = 0
                while i + k < len(lane) and lane[i:i + k + 1] in train:
                    k += 1
                i, n = i + max(k, 1), n + 1
        return n

    texts = ["".join(rng.choice("abrcdnhelowy zq.") for _ in range(rng.randint(0, 600))) for _ in range(100)]
    counts, _ = model.phrases(texts)
    assert counts.tolist() == [[brute(t, trained[k] + " ") for k in model.languages] for t in texts]


def test_alphabets_of_thousands_of_letters():
    rng = random.Random(5)
    samples = {x: "".join(chr(at + min(rng.randrange(900), rng.randrange(900))) for _ in range(6000)) for x, at in (("a", 0x4E00), ("b", 0x5200))}
    model = langid.fit({k: [v] for k, v in samples.items()})
    assert all(len(a.keys) for a in model.automata)
    text = samples["a"][1000:1000 + langid.LANE] + samples["a"][50:60] + samples["b"][7:19]
    counts, _ = model.phrases([text])

    def brute(train):
        n = 0
        for at in range(0, len(text), langid.LANE):
            lane, i = text[at:at + langid.LANE], 0
            while i < len(lane):
                k = 0
                while i + k < len(lane) and lane[i:i + k + 1] in train:
                    k += 1
                i, n = i + max(k, 1), n + 1
        return n

    assert counts.tolist() == [[brute(samples[k] + " ") for k in "ab"]]


def test_letters_above_the_first_plane(spark):
    deseret, gothic = range(0x10400, 0x10428), range(0x10330, 0x1034B)
    assert langid.folded("a\U00010400😀\U00010428").tolist() == [97, 0xD801, 0xDC28, 32, 0xD801, 0xDC28]  # upper and lower case are one
    rng = random.Random(8)

    def words(letters, n=60):
        known = ["".join(chr(rng.choice(letters)) for _ in range(4)) for _ in range(12)]
        return lambda: " ".join(rng.choice(known) for _ in range(n))

    makers = {"aa": words([ord(c) for c in "abcdefgh"]), "ds": words(deseret), "gt": words(gothic), "cj": words(range(0x20000, 0x20400))}
    rows = [(i, makers[x](), x) for i, x in enumerate(list(makers) * 6)] + [(90, "😀😀 \U0001F600", None), (91, "\U00010330" * 3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.learn(spark, docs.where("doc_id < 12"))
    assert model.languages == sorted(makers)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify(docs, model).collect()}
    assert all(got[i][0] == x for i, _, x in rows if x) and got[90] == ("und", 0.0) and got[91][0] == "gt"


def test_ties_go_to_the_first_in_the_alphabet():
    model = langid.fit({"b": ["one two"], "a": ["one two"]})
    counts, _ = model.phrases(["two one", "zzz"])
    assert model.languages == ["a", "b"] and (counts[:, 0] == counts[:, 1]).all()


def test_every_label_is_learnt(spark, monkeypatch):
    rng = random.Random(6)
    own = {f"l{i:02d}": ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(30)] for i in range(70)}
    rows = [(i, " ".join(rng.choice(w) for _ in range(60)), lang) for i, (lang, w) in enumerate(list(own.items()) * 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learnt = langid.learn(spark, docs.where("doc_id < 70"))
    assert learnt.languages == sorted(own)
    got = sorted(map(tuple, langid.identify(docs, learnt).collect()))
    assert [(x, lang) for x, lang, _ in got] == [(x, lang) for x, _, lang in rows]
    monkeypatch.setattr(langid, "BLOCK_LANGUAGES", 100)
    assert sorted(map(tuple, langid.identify(docs, learnt).collect())) == got  # blocks change nothing


def test_identify_cases(spark, no_docs):
    rows = [(1, "der hund und die katze liegen in dem garten", "de"), (2, "the dog and the cat lie in the garden", "en"), (3, None, None), (4, "", "en"), (5, "123 !?", "en"),
            (6, "THE GARDEN AND THE DOG", None), (6, "THE GARDEN AND THE DOG", None), (None, "die katze und der garten", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.learn(spark, docs)
    assert model.languages == ["de", "en"]
    got = sorted(((r["doc_id"], r["lang_pred"]) for r in langid.identify(docs, model).collect()), key=repr)
    assert got == sorted([(1, "de"), (2, "en"), (3, "und"), (4, "und"), (5, "und"), (6, "en"), (6, "en"), (None, "de")], key=repr)
    none = langid.learn(spark, no_docs)
    assert {(r["lang_pred"], r["score"]) for r in langid.identify(docs, none).collect()} == {("und", 0.0)}
    assert langid.identify(no_docs, model).count() == 0


def test_language_accuracy_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.learn(spark, docs.where("crc32(cast(doc_id as string)) % 4 <> 2"))
    held = docs.where("crc32(cast(doc_id as string)) % 4 = 2")
    got = langid.identify(held, model).join(held.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.97


# -- toxicity


def distances(a, b):
    row = list(range(len(b) + 1))
    for x in a:
        new = [row[0] + 1]
        for j, y in enumerate(b):
            new.append(min(new[-1] + 1, row[j + 1] + 1, row[j] + (x != y)))
        row = new
    return row


def test_automaton_equals_edit_distance():
    entries = [("idiot", False), ("lowei", True), ("scum", False), ("worthless", False)]
    automaton = toxicity.build_automaton(entries)
    rng = random.Random(1)
    for _ in range(1500):
        w = list(rng.choice(entries)[0])
        for _ in range(rng.randint(0, 3)):
            i = rng.randrange(len(w) + 1)
            kind = rng.random()
            if kind < 0.4:
                w.insert(i, rng.choice("abeiowx"))
            elif i < len(w) and kind < 0.7:
                w[i] = rng.choice("abeiowx")
            elif i < len(w) > 1:
                del w[i]
        w = "".join(w) + rng.choice(["", "abc"])
        best = None
        for j, (e, stem) in enumerate(entries):
            d = min(distances(w[:k], e)[-1] for k in range(1, len(w) + 1)) if stem else distances(w, e)[-1]
            if d <= toxicity.edits_for(len(e)) and (best is None or d * 1000 + j < best):
                best = d * 1000 + j
        assert toxicity.hits_of([w], automaton)[3].tolist() == ([best] if best is not None else []), w


def test_automaton_of_a_thousand_letters():
    rng = random.Random(7)
    letters = [chr(0x4E00 + i) for i in range(900)] + [chr(0x20000 + i) for i in range(200)]
    entries = [("".join(rng.sample(letters, rng.choice([3, 4, 6]))), rng.random() < 0.3) for _ in range(150)]
    automaton = toxicity.build_automaton(entries)
    assert automaton.table.shape[1] > 300
    for _ in range(150):
        w = list(rng.choice(entries)[0])
        if rng.random() < 0.6:
            w[rng.randrange(len(w))] = rng.choice(letters)
        w = "".join(w)
        found = []
        for j, (e, stem) in enumerate(entries):
            d = min(distances(w[:k], e)[-1] for k in range(1, len(w) + 1)) if stem else distances(w, e)[-1]
            if d <= toxicity.edits_for(len(e)):
                found.append(d * 1000 + j)
        text, a, b, code = (x.tolist() for x in toxicity.hits_of(["x " + w + " 😀y"], automaton))
        assert (code, a, b) == (([min(found)], [2], [2 + len(w)]) if found else ([], [], []))


def test_context_tells_quotation_from_abuse():
    model = toxicity.Model([("idiot", False)], toxicity.build_automaton([("idiot", False)]), {0: 5.0, 1000: 4.0, 2000: 0.0}, (1.0, -3.0))
    plain, quoted, called, told = model.scores(["such an idiot here", 'the note had "idiot" on it', "they said idiot again", "you idiot"])
    assert told > plain > 0.5 > quoted and called < 0.5
    assert model.scores(["such an idi0t here"])[0] > 0.5 > model.scores(["", "clean words only"]).max()


def test_learn_and_score(spark, docs, no_docs):
    rng = random.Random(5)
    clean = [(i, " ".join(rng.choice(["sun", "tree", "road", "house", "cloud"]) for _ in range(30)) + f" n{i}", 0) for i in range(60)]
    toxic = [(100 + i, "sun tree " + rng.choice(["grobian", "lumpenx"]) + f" road m{i} house", 1) for i in range(40)]
    table = spark.createDataFrame(clean + toxic, "doc_id long, text string, toxic int")
    labels = table.select("doc_id", "toxic").unionByName(spark.createDataFrame([(None, 1), (5, None), (100, 0)], "doc_id long, toxic int"))
    model = toxicity.learn(spark, table.select("doc_id", "text"), labels)
    assert model.entries == [("grobian", False), ("lumpenx", False)]
    got = {r["doc_id"]: r[toxicity.SCORE] for r in toxicity.score(table, model).collect()}
    assert all((got[i] >= 0.5) == bool(t) for i, _, t in clean + toxic)
    scored = toxicity.score(docs, model)
    assert scored.columns == [*docs.columns, toxicity.SCORE] and scored.where(f"{toxicity.SCORE} is null").count() == 0
    assert toxicity.score(no_docs, model).count() == 0
    empty = toxicity.learn(spark, table, labels.where("toxic = 0"))
    assert np.allclose([r[0] for r in toxicity.score(table, empty).select(toxicity.SCORE).collect()], toxicity.BASE)


# -- licences


def test_licences_equal_brute_force(spark, docs, no_docs):
    extra = spark.createDataFrame([(1, "x\nReleased under the MIT License.\nAll rights reserved"), (1, "x\nReleased under the MIT License.\nAll rights reserved"),
                                   (2, "Note. licensed under the  APACHE license version 2.0! And more."), (3, None), (4, ""), (None, "all rights reserved"), (5, "Released under the MIT")], "doc_id long, text string")
    table = extra.unionByName(docs.select("doc_id", "text"))
    expected = Counter()
    for x, text in table.collect():
        for i, part in enumerate(re.sub(r"([.!?])[ \t\r\n]+", r"\1\n", text).split("\n") if text is not None else []):
            b = set(licences.bigrams_of(part))
            if len(licences.normal(part).split(" ")) < 2:
                continue
            scores = [(-2 * len(b & set(licences.bigrams_of(t))) / (len(b) + len(licences.bigrams_of(t))), n) for n, t in licences.TEMPLATES]
            if -min(scores)[0] >= licences.THRESHOLD:
                expected[x, i, min(scores)[1], round(-min(scores)[0], 6)] += 1
    assert Counter(map(tuple, licences.scan(table).collect())) == expected and len(expected) >= 5
    assert licences.scan(no_docs).count() == 0


# -- quality


def test_quality_base_equals_brute_force(spark, docs, rows):
    got = {}
    for r in divergence.judge(spark, docs).collect():
        got.setdefault(r["doc_id"], set()).add(tuple(r)[1:7])
    for x, text, *_ in rows:
        text = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
        inside = {j for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
        lines = [y for y in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", y)]
        base = len(w) < 50 or 100 * len(inside) > 50 * len(w)
        assert (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside), base) in got[x]


def test_quality_verdicts(spark, no_docs):
    rng = random.Random(9)
    prose = [" ".join(rng.choice(["the", "of", "and", "house", "river", "stone", "light", "walk"]) + rng.choice(["", "", "s"]) for _ in range(120)) for _ in range(30)]
    junk = " ".join("#%" * 3 for _ in range(60)) + " " + " ".join(f"{i}${i}" for i in range(90))
    table = spark.createDataFrame([(i, t, "en") for i, t in enumerate(prose)] + [(99, junk, "en"), (98, None, "en"), (97, "short text", None)], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in divergence.judge(spark, table).collect()}
    assert not got[99]["kept"] and got[98]["base_failed"] and not got[97]["kept"]
    assert all(got[i]["kept"] for i in range(30) if not got[i]["base_failed"])
    assert divergence.judge(spark, no_docs).count() == 0


def test_common_words_are_counted_over_all_documents(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice("ABCDEFGH") + str(min(rng.randrange(30), rng.randrange(30))) for _ in range(20)), ["en", None][i % 2]) for i in range(2400)]
    rows += [(i, "copy of one text " * 4, "en") for i in range(5000, 5900)] + [(None, "null\tId", "en"), (1, None, "de"), (2, "", "fr")]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    expected = {}
    for _, text, lang in rows:
        expected.setdefault(lang or "", Counter()).update((text or "").lower().split())
    got = {r["lang"]: r["words"] for r in divergence.common_words(table).collect()}
    assert got == {x: [w for w, _ in sorted(c.items(), key=lambda y: (-y[1], y[0]))[:divergence.COMMON]] for x, c in expected.items() if c}


def test_every_language_has_a_word_histogram(spark):
    rows = [(2 * i + j, " ".join([f"word{i}"] * (30 + 40 * j) + [f"other{i}"] * (70 - 40 * j)), f"lang{i:03d}") for i in range(80) for j in (0, 1)]
    got = divergence.judge(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    p, m = [.3, .7], [.5, .5]  # each language: 30 and 70 of two words, the other way round in its second text
    mid = [(a + b) / 2 for a, b in zip(p, m)]
    apart = math.sqrt(sum(a * math.log2(a / c) + b * math.log2(b / c) for a, b, c in zip(p, m, mid)) / 2)
    assert len(got) == 160 and [r["word_distance"] for r in got] == pytest.approx([apart] * 160)


def test_js_distance(spark):
    from pyspark.sql import functions as F
    one = spark.createDataFrame([([4, 0], [0, 4]), ([1, 1], [3, 3]), ([0, 0], [1, 2]), ([1, 3], [3, 1])], "a array<long>, b array<long>")
    got = [r[0] for r in one.select(divergence.js_distance(F.col("a"), F.col("b"))).collect()]
    p, q, m = [.25, .75], [.75, .25], [.5, .5]
    last = math.sqrt(sum(x * math.log2(x / z) + y * math.log2(y / z) for x, y, z in zip(p, q, m)) / 2)
    assert got == pytest.approx([1.0, 0.0, 0.0, last])
