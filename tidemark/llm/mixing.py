"""Mixing sources to target weights by iterative proportional fitting.

The corpus is summed to cells (source, language, topic) of tokens: a partial aggregation, so a source
with a third of all rows is one row a task and cell. Raking then scales the cells' weights in turn
until the sums by source, by language and by topic meet their targets. What a cell is to
hold over what it holds is its calibrated sampling rate; a document stays if a hash of its id, as a
number in [0, 1), is below its cell's rate. By default the rates are scaled so that the highest is
one: the largest sample with exactly the mix. With ``fraction`` of the tokens asked for, no cell may
give more than it has: that bound is part of the raking, so a cell that is used up stays at rate one
and the others of its source, language and topic make up for it. A category that holds less than its
target asks for gives all it has, and the others of its key take over the rest in the proportion of
their targets. The fraction is kept; where the targets cannot all be met together, the topics are met.

DataFrame operations only. The cells - one row for each combination that occurs - are raked by window
sums over their three keys; each sweep is written to the shared folder, so that the plan stays short
and a lost executor costs one sweep. Documents meet their cell's rate by a plain join (broadcast by
size, split where skewed).

Defined cases: a null source or language is a category of its own ('' names it in targets). A
category without a target keeps its natural share of what the named ones leave; where their targets
add up to one or more they leave nothing to share, and then it keeps its natural share of the whole and
the named ones mix the rest. A target without documents is left out and the others scaled up. Null or empty text has weight 0 and is kept by the
rate of its cell; a cell of weight 0 has rate 1. A null doc_id draws by its text. Rows that repeat
draw alike. Empty table: empty result. All columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, staged

KEYS = ("source", "lang", "topic")
SWEEPS = 25
TOLERANCE = 1e-6
#: Targets whose sum is short of one by no more leave nothing.
ROUNDING = 1e-9
SEED = 17


def topic_of(text: Column) -> Column:
    """A coarse topic from plain marks of the text, the first that fits."""
    text = F.coalesce(text, F.lit(""))
    return (F.when(text.contains("icense"), "legal").when(text.contains("@"), "contact")
            .when(text.contains(" | "), "table").when(F.upper(text) == text, "caps").otherwise("prose"))


def tokens_of(text: Column) -> Column:
    """Estimated tokens: characters over four, at least one for a text with any."""
    return F.ceil(F.coalesce(F.length(text), F.lit(0)) / 4).cast("double")


def fill(table: DataFrame, free: str, goal: Column, keys: list[str], ties: list[str]) -> DataFrame:
    """``free`` times the one factor of its group by which least(free, cap) adds up to ``goal``, or all caps if they are less.

    The sum grows with the factor along straight lines, a new one whenever a row reaches its cap, and lies on
    the lowest of them; so the factor is the largest at which one of the lines meets the goal."""
    group, pull = Window.partitionBy(*keys), F.col(free) / F.col("cap")
    before = group.orderBy(pull.desc(), *map(F.desc, ties)).rowsBetween(Window.unboundedPreceding, -1)
    behind = group.orderBy(pull.asc(), *map(F.asc, ties)).rowsBetween(Window.unboundedPreceding, 0)
    used_up, still = F.coalesce(F.sum("cap").over(before), F.lit(0.0)), F.sum(free).over(behind)
    table = table.withColumn("__line", F.when(still > 0, (goal - used_up) / still))
    return table.withColumn(free, F.col(free) * F.coalesce(F.max("__line").over(group), F.lit(0.0))).drop("__line")


def target_table(cells: DataFrame, key: str, wanted: dict[str, float], fraction: float | None = None) -> DataFrame:
    """(key, goal): shares of the categories that occur, adding up to one.

    Named categories get their share; the rest of the whole goes to the others by their natural weight.
    Where no rest is left, the others keep their natural share and the named ones mix what remains.
    With ``fraction`` a share is at most what the category holds."""
    named = F.lit(None).cast("double")
    for name, share in wanted.items():
        named = F.when(F.col(key) == name, F.lit(float(share))).otherwise(named)
    sums = cells.groupBy(key).agg(F.sum("held").alias("held")).where("held > 0").withColumn("named", named)
    every = Window.partitionBy()  # of the categories of one key
    sums = sums.withColumn("free", F.sum(F.when(F.col("named").isNull(), F.col("held"))).over(every))
    rest = 1.0 - sum(wanted.values())
    if rest > ROUNDING:
        goal = F.coalesce(F.col("named"), F.col("held") / F.col("free") * rest)
    else:
        whole, shares = F.sum("held").over(every), F.sum("named").over(every)
        mixed = F.when(shares > 0, F.col("named") / shares * (1 - F.coalesce("free", F.lit(0.0)) / whole)).otherwise(0.0)
        goal = F.when(F.col("named").isNotNull(), mixed).otherwise(F.col("held") / whole)
    sums = sums.withColumn("goal", goal)
    goals = sums.select(key, (F.col("goal") / F.sum("goal").over(every)).alias(f"goal_{key}"), (F.col("held") / F.sum("held").over(every)).alias("held"))
    if fraction is None:
        return goals.drop("held")
    goals = fill(goals.withColumn("cap", F.col("held") / fraction), f"goal_{key}", F.lit(1.0), [], [key])
    return goals.select(key, F.least(f"goal_{key}", "cap").alias(f"goal_{key}"))


def rake(spark: SparkSession, cells: DataFrame, targets: dict[str, dict[str, float]], sweeps: int = SWEEPS, tolerance: float = TOLERANCE, fraction: float | None = None) -> DataFrame:
    """cells (source, lang, topic, held) -> with ``weight``, raked to the targets, total one.

    With ``fraction`` a cell's weight is at most its part of the whole over ``fraction``."""
    now = cells.where("held > 0")
    for key in KEYS:
        now = now.join(target_table(cells, key, targets.get(key, {}), fraction), key)
    now = now.withColumn("weight", F.col("held") / F.sum("held").over(Window.partitionBy()))
    weight = F.col("weight")
    if fraction is not None:
        now, weight = now.withColumn("cap", F.col("weight") / fraction), F.least("weight", "cap")
    now = staged(spark, now.coalesce(1), "mixing-cells")
    for _ in range(sweeps):
        fitted = now
        for key in KEYS:
            if fraction is not None:
                fitted = fill(fitted, "weight", F.col(f"goal_{key}"), [key], list(KEYS))
                continue
            share = F.sum("weight").over(Window.partitionBy(key))
            fitted = fitted.withColumn("weight", F.when(share > 0, F.col("weight") * F.col(f"goal_{key}") / share).otherwise(0.0))
        now = staged(spark, fitted.coalesce(1), "mixing-cells")
        off = [now.groupBy(key).agg(F.abs(F.sum(weight) - F.first(f"goal_{key}")).alias("off")) for key in KEYS]
        worst = off[0].select("off").unionByName(off[1].select("off")).unionByName(off[2].select("off")).agg(F.max("off")).first()[0]
        if worst is None or worst <= tolerance:
            break
    return now.withColumn("weight", weight).drop("cap")


def sampling_rates(spark: SparkSession, docs: DataFrame, targets: dict[str, dict[str, float]], fraction: float | None = None) -> DataFrame:
    """docs (source, lang, topic, tokens) -> (source, lang, topic, held, weight, rate).

    ``fraction``: share of all tokens to keep; by default as many as the exact mix allows."""
    cells = docs.groupBy(*KEYS).agg(F.sum("tokens").alias("held"))
    raked = rake(spark, cells, targets, fraction=None if fraction is None else float(fraction))
    every = Window.partitionBy()
    ratio = F.col("weight") / (F.col("held") / F.sum("held").over(every))
    raked = raked.withColumn("ratio", ratio)
    highest = F.max("ratio").over(every)
    scale = 1 / highest if fraction is None else F.lit(float(fraction))
    return raked.select(*KEYS, "held", "weight", F.least(F.lit(1.0), F.col("ratio") * scale).alias("rate"))


def draw(doc_id: Column, text: Column, seed: int = SEED) -> Column:
    """A number in [0, 1) from the document's id (its text if that is null)."""
    key = F.when(doc_id.isNotNull(), F.xxhash64(doc_id, F.lit(seed))).otherwise(F.xxhash64(text, F.lit(seed)))
    return F.pmod(key, F.lit(1 << 52)) / float(1 << 52)


def mix(spark: SparkSession, docs: DataFrame, targets: dict[str, dict[str, float]], fraction: float | None = None, seed: int = SEED, column: str = "__mix") -> DataFrame:
    """``docs`` (with doc_id, text, source, lang) -> the rows sampled, all columns, and ``column``, a
    struct of the document's topic, tokens and rate."""
    names = ("source", "lang", "topic", "rate")
    own, *cell = fresh([*docs.columns, column], "__cell", *(f"__cell_{k}" for k in names))
    keyed = docs.withColumn(own, F.struct(F.coalesce("source", F.lit("")).alias("source"), F.coalesce("lang", F.lit("")).alias("lang"),
                                          topic_of(F.col("text")).alias("topic"), tokens_of(F.col("text")).alias("tokens")))
    rates = sampling_rates(spark, keyed.select(f"{own}.*"), targets, fraction).select(*(F.col(k).alias(c) for k, c in zip(names, cell)))
    same = [F.col(f"{own}.{k}") == F.col(c) for k, c in zip(KEYS, cell)]
    rate = F.coalesce(F.col(cell[3]), F.lit(1.0))
    met = keyed.join(rates, same[0] & same[1] & same[2], "left")
    met = met.where(draw(F.col("doc_id"), F.col("text"), seed) < rate)
    return met.select(*(F.col(f"`{c}`") for c in docs.columns), F.struct(f"{own}.topic", f"{own}.tokens", rate.alias("rate")).alias(column))
