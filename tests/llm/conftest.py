"""Small tables with the awkward rows of every contract: nulls, empty and long texts, ties, repeats, clashing columns."""

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, class string, __rate string"


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}x" for _ in range(n))


def corpus():
    rng = random.Random(11)
    texts = {}
    base = words(rng, 60)
    line = "a boilerplate line that many of the documents carry word for word, longer than fifty bytes."
    for i in range(40):
        texts[i] = words(rng, rng.randrange(20, 90))
    for i in range(40, 52):  # near copies
        w = base.split()
        w[rng.randrange(len(w))] = f"edit{i}"
        texts[i] = " ".join(w)
    for i in range(52, 58):  # exact copies, other case
        texts[i] = base if i % 2 else base.upper()
    for i in range(58, 66):
        texts[i] = words(rng, 30) + "\n" + line + "\n" + words(rng, 10)
    texts[66], texts[67], texts[68], texts[69] = "", "   \n\t ", "one two", "One TWO"
    texts[70] = words(rng, 4000)
    texts[71] = texts[70] + " tail"
    texts[72] = "ab" * 300
    texts[73] = "xy" + "ab" * 200
    texts[74] = "naïve café – " * 12 + "日本語テキスト" * 8
    texts[75] = "prefix " + "naïve café – " * 12
    rows = [(i, t, ["en", "de", None][i % 3], f"s{i % 4}", len(t), 1.5, "x", "y") for i, t in texts.items()]
    rows += [(80, None, "en", "s1", None, None, None, None), (81, None, None, None, None, None, None, None),
             (None, base, "en", "s0", len(base), 0.0, "z", None), (None, line, None, None, 5, None, None, None)]
    rows += [rows[3], rows[3], rows[45]]  # repeated rows
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
