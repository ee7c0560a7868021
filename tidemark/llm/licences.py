"""Licence scans by Dice coefficient over word bigrams.

A text is cut into its lines and sentences; each is normalised (lower case, every run of characters
other than a-z and 0-9 one space) and turned into its set of word bigrams. It is compared with the
licence templates, normalised alike: Dice = 2 |A n B| / (|A| + |B|). A template can only reach the
threshold if the sizes of the two sets are within a factor of (2 - t) / t of each other, and that
bound is tested first, so most segments are compared with no template at all. The best template
of a segment is reported (ties: the name first in the alphabet).

One map over the documents in DataFrame functions: no shuffle, nothing grouped, whole texts. The
templates are a parameter; they are literals of the plan, so it suits hundreds, not millions.

Defined cases: null and empty texts, and segments of fewer than two words, match nothing. Repeated
segments are reported each with its number. Empty table: empty result. A null doc_id is kept.
Other columns are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8
# Short notices by licence.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3"),
    ("MIT", "Released under the MIT License"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("proprietary", "All rights reserved"),
)


def normal(text: str) -> str:
    return re.sub(r"[^a-z0-9]+", " ", text.lower()).strip()


def bigrams_of(text: str) -> list[str]:
    words = normal(text).split(" ")
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def segments(text: Column) -> Column:
    """Lines and sentences, in order."""
    return F.split(F.regexp_replace(text, r"([.!?])[ \t\r\n]+", "$1\n"), "\n")


def words_of(segment: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.lower(segment), r"[^a-z0-9]+", " ")), " ")


def once(column: Column) -> Column:
    """The value as a generator's output: what is built on it reads it and does not compute it again."""
    return F.explode(F.array(column))


def scan(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """documents (doc_id, text) -> (doc_id, segment, licence, dice), one row a matching segment."""
    cut = docs.where("text is not null").select("doc_id", F.posexplode(segments(F.col("text"))).alias("segment", "words"))
    sets = [(name, bigrams_of(text)) for name, text in sorted(templates)]
    factor = (2 - threshold) / threshold
    least, most = min(len(b) for _, b in sets) / factor, max(len(b) for _, b in sets) * factor
    found = cut.select("doc_id", F.col("segment").cast("long").alias("segment"), once(words_of(F.col("words"))).alias("w")).where(F.size("w") > least)
    pairs = F.zip_with(F.slice("w", F.lit(1), F.size("w") - 1), F.slice("w", F.lit(2), F.size("w") - 1), lambda a, b: F.concat_ws(" ", a, b))
    found = found.select("doc_id", "segment", once(F.array_distinct(pairs)).alias("b")).where(F.size("b").between(least, most))

    def dice(known):
        n = F.size("b")
        score = 2.0 * F.size(F.array_intersect("b", F.array(*map(F.lit, known)))) / (n + len(known))
        return F.when(n.between(len(known) / factor, len(known) * factor), score).otherwise(0.0)

    scored = found.select("doc_id", "segment", once(F.array(*(F.struct(dice(b).alias("dice"), F.lit(-i).alias("order"), F.lit(name).alias("licence")) for i, (name, b) in enumerate(sets)))).alias("all"))
    best = scored.select("doc_id", "segment", F.array_max("all").alias("best")).where(F.col("best.dice") >= threshold)
    return best.select("doc_id", "segment", F.col("best.licence").alias("licence"), F.round("best.dice", 6).alias("dice"))


def scan_sql(templates=TEMPLATES, threshold: float = THRESHOLD) -> str:
    """The scan in DuckDB SQL, without the pruning."""
    rows = ", ".join("('" + name.replace("'", "''") + f"', {i}, '" + b.replace("'", "''") + "')" for i, (name, text) in enumerate(sorted(templates)) for b in bigrams_of(text))
    return f"""
WITH t(licence, place, b) AS (VALUES {rows}),
sizes AS (SELECT licence, place, count(*) AS n FROM t GROUP BY ALL),
cut AS (SELECT doc_id, string_split(regexp_replace(text, '([.!?])[ \\t\\r\\n]+', '\\1' || chr(10), 'g'), chr(10)) AS parts FROM documents WHERE text IS NOT NULL),
seg AS (SELECT doc_id, i AS segment, string_split(trim(regexp_replace(lower(parts[i + 1]), '[^a-z0-9]+', ' ', 'g')), ' ') AS w
        FROM (SELECT doc_id, parts, unnest(range(len(parts))) AS i FROM cut)),
sets AS (SELECT doc_id, segment, list_distinct(list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1])) AS b FROM seg WHERE len(w) > 1),
one AS (SELECT doc_id, segment, len(b) AS n, unnest(b) AS b FROM sets),
met AS (SELECT one.doc_id, one.segment, one.n, t.licence, t.place, count(*) AS k FROM one JOIN t ON one.b = t.b GROUP BY ALL),
scored AS (SELECT doc_id, segment, met.licence, met.place, 2.0 * k / (met.n + sizes.n) AS dice FROM met JOIN sizes USING (licence)),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id, segment ORDER BY dice DESC, place) AS r FROM scored WHERE dice >= {threshold})
SELECT doc_id, segment, licence, round(dice, 6) AS dice FROM best WHERE r = 1"""
