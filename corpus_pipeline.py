"""Corpus pipeline: documents -> clean, unique, mixed and packed training sequences.

Five stages, each a whole pass over what its predecessor kept:

1. ``toxicity``: documents scored 0.5 or more go. Labels teach as in op4 (the held-out fold does not).
2. ``near_duplicates``: of each component of the 5-word-shingle Jaccard join (0.75 or more) the document of
   smallest id stays; documents without shingles are all kept. Rows that repeat an id with another text
   are documents of their own: of those in one component one stays, those in others stay too.
3. ``repeats``: bytes of 50-byte strings that a document of smaller id also holds are cut out (a
   character that a cut goes through is dropped); n_chars is counted anew; a document that loses all
   of its text goes.
4. ``mixing``: documents are sampled to the target weights by source, language and topic.
5. ``packing``: one row a piece of the packed sequences.

All but the last return the columns of their input, extra ones included. A null doc_id is never
removed as a duplicate. Null or empty texts are clean, unique and kept by the rate of their cell. An
empty table gives empty results.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import mixing, toxicity
from tidemark.llm.common import fresh, read_table, staged
from tidemark.llm.jaccard import near_duplicates
from tidemark.llm.packing import pack_documents
from tidemark.llm.queries import FRACTION, TARGETS, tokenizer_path
from tidemark.llm.suffixes import kept_texts
from tidemark.session import settle

#: SQL cannot express the stages; tests hold them against brute-force versions.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = read_table(spark, sf_dir, "labels")
    model = toxicity.learn(spark, docs.select("doc_id", "text"), labels.where(~toxicity.held_out()))
    score, = fresh(docs.columns, toxicity.SCORE)
    return toxicity.score(docs, model, score).where(F.col(score) < 0.5).drop(score)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    stay, key, times, rank = fresh(docs.columns, "__stay", "__key", "__times", "__rank")
    found = near_duplicates(spark, docs.select("doc_id", "text"))
    named = found.where("class is not null and doc_id = component_id").groupBy("root", "doc_id", "text_key").agg(F.count("*").alias("times"))
    kept = named.groupBy("root").agg(F.min(F.struct("doc_id", "text_key", "times")).alias("one")).select("one.*")
    kept = staged(spark, kept.toDF(stay, key, times), "pipeline-kept")
    alone = staged(spark, found.where("class is null and doc_id is not null").select("doc_id", "text_key").distinct().toDF(stay, key), "pipeline-alone")
    same = (F.col("doc_id") == F.col(stay)) & (F.xxhash64("text") == F.col(key))

    def of(table):
        return docs.join(table, same, "left_semi")

    # Rows that repeat an id and its text are one document.
    first = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy(F.xxhash64(*(f"`{f.name}`" for f in docs.schema.fields if "map<" not in f.dataType.simpleString())))
    repeated = of(kept.where(F.col(times) > 1)).withColumn(rank, F.row_number().over(first)).where(F.col(rank) == 1).drop(rank)
    once = of(kept.where(F.col(times) == 1).select(stay, key).unionByName(alone))
    return once.unionByName(repeated).unionByName(docs.where("doc_id is null"))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    left, = fresh(docs.columns, "__left")
    both = kept_texts(spark, docs, column=left)
    text = F.coalesce(F.col(left), F.col("text"))
    both = both.where((F.coalesce(F.col("text"), F.lit("")) == "") | (text != ""))
    count = F.when(F.col(left).isNotNull(), F.length(left).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    change = {"text": text.alias("text"), "n_chars": count.alias("n_chars")}
    return both.select(*(change.get(c, F.col(f"`{c}`")) for c in docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed, = fresh(docs.columns, "__mix")
    return mixing.mix(spark, docs, TARGETS, FRACTION, column=mixed).drop(mixed)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(spark, docs, tokenizer_path())


def settled(stage):
    """A stage that first gives the session the settings the library relies on."""
    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        settle(spark)
        return stage(spark, docs, sf_dir)
    return run_stage


STAGES = [("toxicity", settled(drop_toxic)), ("near_duplicates", settled(drop_near_duplicates)), ("repeats", settled(cut_repeats)),
          ("mixing", settled(mix_sources)), ("packing", settled(pack))]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder and read again by the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
