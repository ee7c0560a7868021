"""Registered queries of this subpackage: one ``opN_<name>`` per operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import read_table
from tidemark.llm.jaccard import near_duplicates
from tidemark.llm.packing import pack_documents
from tidemark.llm import divergence, importance, kernel, langid, licences, mixing, neighbours, reputation, runs, toxicity
from tidemark.llm.suffixes import remove_repeats


def tokenizer_path() -> str:
    """The public vocabulary file that the registered packing query uses."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All `documents` packed best-fit decreasing into sequences of at most 2,048 tokens."""
    return pack_documents(spark, read_table(spark, sf_dir, "documents"), tokenizer_path())


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text of `documents`, learnt from rows outside the held-out fold."""
    docs = read_table(spark, sf_dir, "documents")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    model = langid.learn(spark, docs.where(~held))
    return langid.identify(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every row of `embeddings` whose vec_id is divisible by 20, by inner product."""
    return neighbours.nearest(spark, read_table(spark, sf_dir, "embeddings"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text of `documents`, learnt from labelled rows outside the held-out fold."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = toxicity.learn(spark, docs, labels.where(~toxicity.held_out()))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), F.col(toxicity.SCORE).alias("score"), (F.col(toxicity.SCORE) >= 0.5).cast("int").alias("predicted"))


def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and sentences of `documents` that match a licence notice."""
    return licences.scan(read_table(spark, sf_dir, "documents"))


def op6_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every url of `pages`. A page's outcome is the label of the document that its path
    names by number: good if labelled of quality and not toxic."""
    pages, labels = read_table(spark, sf_dir, "pages"), read_table(spark, sf_dir, "labels")
    marks = labels.groupBy("doc_id").agg(F.min(F.when((F.col("quality") == 1) & (F.col("toxic") == 0), 1).when(F.col("quality").isNotNull() & F.col("toxic").isNotNull(), 0)).alias("good"))
    numbered = pages.select("page_id", "url", F.regexp_extract(reputation.path_of(F.col("url")), r"/([0-9]{1,18})(?:[^0-9]|$)", 1).alias("named"))
    numbered = numbered.withColumn("doc_id", F.when(F.col("named") != "", F.col("named").cast("long")))
    judged = reputation.judge(numbered.join(marks, "doc_id", "left").select("page_id", "url", "good"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


#: Targets of the mixing query and stage: the hot source is held at a quarter, languages other than English are raised.
TARGETS = {"source": {"src0": 0.25}, "lang": {"en": 0.5, "de": 0.17, "fr": 0.17, "es": 0.16}, "topic": {"prose": 0.7}}
FRACTION = 0.6


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`documents` sampled to TARGETS by source, language and topic."""
    mixed = mixing.mix(spark, read_table(spark, sf_dir, "documents"), TARGETS, FRACTION)
    return mixed.select("doc_id", "source", "lang", "__mix.topic", F.col("__mix.tokens").cast("long").alias("tokens"), "__mix.rate")


def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of `documents` (5-word shingles, Jaccard >= 0.75)."""
    return near_duplicates(spark, read_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality verdict on every document of `documents` by base rules and distribution divergence."""
    return divergence.judge(spark, read_table(spark, sf_dir, "documents"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of `documents` in 50-byte strings that a document of smaller id also holds, removed."""
    return remove_repeats(spark, read_table(spark, sf_dir, "documents"))


def recurring(doc_id, text):
    """The text of op11: of the tenth of the ids whose CRC-32 h is divisible by ten, the words from word
    g % n on repeat with period p, where g = h / 10; all others as they are."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def turned(w):
        n, g = F.size(w), F.floor(h / 10)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        return F.array_join(F.concat(F.slice(w, F.lit(1), a), F.transform(F.sequence(F.lit(0), n - a - 1), lambda i: F.get(w, a + i % p))), " ")

    # One element or none: the words are computed once.
    changed = F.transform(F.filter(F.array(words), lambda w: F.size(w) > 0), turned)
    return F.when(h % 10 == 0, F.coalesce(F.get(changed, F.lit(0)), F.lit(""))).otherwise(text)


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every whole text of `documents`, with the digests of all runs and of the text without them."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", recurring(F.col("doc_id"), F.col("text")).alias("text"))
    found = runs.collapse_runs(docs)
    ranked = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("finer")))
    best = F.array_max(ranked)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, F.lit("\n")).otherwise(""))
    found = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
                         F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
    length, period = F.col("best.length"), -F.col("best.finer")
    return found.select("doc_id", "n_runs", (-F.col("best.before")).alias("start"), length.alias("length"), period.alias("period"),
                        F.floor(1000 * length / period).cast("long").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def op12_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every whole text of `documents`, learnt from labelled rows outside the held-out fold."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = kernel.learn(spark, docs, labels.where(~toxicity.held_out()))
    scored = kernel.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of `documents` of 20 words or more, drawn by how like `benchmark` they are; every document with its weight and rank."""
    docs, target = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    drawn = importance.resample(spark, docs.select("doc_id", "text"), target.select("text"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {f.__name__: f for f in (op1_packing, op2_language, op3_neighbours, op4_toxicity, op5_licences, op6_urls, op7_mixing, op8_jaccard, op9_quality, op10_suffix_dedup,
                                  op11_runs, op12_classifier, op13_resampling)}
_PAGES = """SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages"""

#: DuckDB SQL of the queries that SQL can express.
SQL: dict[str, str] = {
    "op5_licences": licences.scan_sql(),
    "op13_resampling": importance.resample_sql(),
    "op6_urls": reputation.verdict_sql(f"""SELECT p.page_id, p.host, p.path, marks.good FROM ({_PAGES}) p
    LEFT JOIN (SELECT doc_id, min(CASE WHEN quality = 1 AND toxic = 0 THEN 1.0 WHEN quality IS NOT NULL AND toxic IS NOT NULL THEN 0.0 END) AS good FROM labels GROUP BY doc_id) marks
    ON marks.doc_id = try_cast(regexp_extract(p.path, '/([0-9]{{1,18}})([^0-9]|$)', 1) AS BIGINT)"""),
}
