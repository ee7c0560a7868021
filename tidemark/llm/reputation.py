"""URL filters: explicit rules, then empirical-Bayes reputation of the host.

The share of good pages of a host is estimated from labelled pages through three beta-binomial
levels: a suffix (last label of the host, or a longer suffix of ``SUFFIXES``) shrinks to the whole
table, a registered domain (one label more) to its suffix, a host to its domain. The prior of a level has
the mean of the level above and a strength, in pages, that is estimated from the data: the method of
moments of the beta-binomial (how much more the children of a parent differ than their numbers of pages
explain), pooled over all parents of a level. So a host with few labelled pages, or none, speaks with its
domain's voice, the louder the more alike the domain's hosts are. A host is blocked if it is bad for
certain: if even the upper bound of its posterior share (normal approximation, ``Z`` standard
deviations) stays below ``LEAST_GOOD`` of the table's share.

Everything is DataFrame expressions: three partial aggregations to tables of hosts, domains and
suffixes, and joins of the pages to the hosts' verdicts. A host with a third of all pages costs one
row per task in the aggregation; the join of pages and hosts is a plain one, which adaptive
execution broadcasts when the hosts are few and splits where a host is skewed.

Defined cases: null url, or none with ``://``: host and path are empty, no rule fits, and the host ''
is judged like any other. No labelled pages at all: every page that no rule blocks is allowed. A level
whose parents have one child each, or only good or only bad pages, has strength ``STRENGTH``. Null labels
are no outcome. Repeated pages count each. Empty table: empty result. Other columns are not read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Strength of a level of which the data say nothing, and the bounds of an estimate.
STRENGTH, WEAKEST, STRONGEST = 10.0, 1.0, 1000.0
# Public suffixes of two labels that are told from registered domains.
SUFFIXES = ("ac.uk", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.au", "com.br", "com.cn", "com.mx", "com.tr", "gov.uk", "ne.jp", "net.au", "or.jp", "org.au", "org.uk")
Z = 1.645
LEAST_GOOD = 0.5
#: A longest fitting rule decides: (verdict, host and path).
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, or null: its host or a subdomain of it, its path a beginning of the path."""
    out = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: len(r[1])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def levels(host: Column, suffixes=SUFFIXES) -> tuple[Column, Column]:
    """(registered domain, suffix); a host that is a suffix itself is both."""
    two = F.substring_index(host, ".", -2)
    long = two.isin(*suffixes)
    return F.when(long, F.substring_index(host, ".", -3)).otherwise(two), F.when(long, two).otherwise(F.substring_index(host, ".", -1))


def _summed(children: DataFrame, keys: list[str], n: str, k: str, level: int) -> DataFrame:
    """A level's parents: pages, good ones, children with pages, and the sums that its strength needs."""
    share = F.when(F.col(n) > 0, F.col(k) * F.col(k) / F.col(n))
    return children.groupBy(*keys).agg(F.sum(n).alias(f"n{level}"), F.sum(k).alias(f"k{level}"), F.count(share).alias("g"),
                                       F.sum(F.col(n).cast("double") * F.col(n)).alias("squares"), F.coalesce(F.sum(share), F.lit(0.0)).alias("shares"))


def _moments(level: int) -> tuple[Column, Column]:
    """(excess spread of a parent's children, what full spread would be): their ratio is the correlation within children."""
    n, k = F.col(f"n{level}").cast("double"), F.col(f"k{level}")
    q, more = k / n * (1 - k / n), F.col("g") - 1
    some = F.col(f"n{level}") > 0
    return (F.when(some, F.col("shares") - k * k / n - q * more).otherwise(0.0), F.when(some, q * (n - F.col("squares") / n - more)).otherwise(0.0))


def _strength(parents: DataFrame, level: int, name: str, *more: Column) -> DataFrame:
    """One row: the strength of the prior of the children of these parents."""
    excess, full = _moments(level)
    sums = parents.agg(F.sum(excess).alias("excess"), F.sum(full).alias("full"), *more)
    rho = F.col("excess") / F.col("full")
    value = (F.when(F.coalesce(F.col("full") <= 0, F.lit(True)), STRENGTH).when(rho <= 1 / (1 + STRONGEST), STRONGEST)
             .when(rho >= 1 / (1 + WEAKEST), WEAKEST).otherwise((1 - rho) / rho))
    return sums.withColumn(name, value).drop("excess", "full")


def reputations(pages: DataFrame, suffixes=SUFFIXES) -> DataFrame:
    """pages (host, good: 1, 0 or null) -> one row a host: (host, labelled, rate, upper, bad)."""
    domain, suffix = levels(F.col("host"), suffixes)
    hosts = pages.groupBy("host").agg(F.count("good").alias("n"), F.coalesce(F.sum(F.col("good").cast("double")), F.lit(0.0)).alias("k"))
    hosts = hosts.withColumns({"domain": domain, "suffix": suffix})
    domains = _summed(hosts, ["domain", "suffix"], "n", "k", 2)
    tops = _summed(domains, ["suffix"], "n2", "k2", 1)
    whole = _summed(tops, [], "n1", "k1", 0)
    base = F.sum("n0").alias("pages"), ((F.sum("k0") + 1) / (F.sum("n0") + 2)).alias("base")
    # Each of these is one row.
    one = _strength(whole, 0, "s1", *base).join(F.broadcast(_strength(tops, 1, "s2"))).join(F.broadcast(_strength(domains, 2, "s3")))

    def shrunk(k, n, prior, strength):
        return (F.col(k) + F.col(strength) * F.col(prior)) / (F.col(n) + F.col(strength))

    tops = tops.join(F.broadcast(one)).withColumn("rate1", shrunk("k1", "n1", "base", "s1"))
    domains = domains.join(tops.select("suffix", "pages", "base", "s2", "s3", "rate1"), "suffix").withColumn("rate2", shrunk("k2", "n2", "rate1", "s2"))
    hosts = hosts.join(domains.select("domain", "suffix", "pages", "base", "s3", "rate2"), ["domain", "suffix"]).withColumn("rate", shrunk("k", "n", "rate2", "s3"))
    spread = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("n") + F.col("s3") + 1))
    hosts = hosts.withColumn("upper", F.col("rate") + Z * spread)
    return hosts.select("host", F.col("n").alias("labelled"), "rate", "upper",
                        ((F.col("pages") > 0) & (F.col("upper") < LEAST_GOOD * F.col("base"))).alias("bad"))


def verdict_sql(pages: str) -> str:
    """The verdicts in DuckDB SQL; ``pages`` selects (page_id, host, path, good)."""
    two = ", ".join(f"'{x}'" for x in SUFFIXES)

    def moments(level, source, by, n, k):
        return f"""SELECT {by}sum({n}) AS n, sum({k}) AS k, count(*) FILTER ({n} > 0) AS g, sum({n}::DOUBLE * {n}) AS squares, coalesce(sum({k} * {k} / {n}) FILTER ({n} > 0), 0.0) AS shares
    FROM {source}{' GROUP BY ' + by.rstrip(', ') if by else ''}"""

    strength = f"""(SELECT CASE WHEN coalesce(sum(den), 0) <= 0 THEN {STRENGTH} WHEN sum(num) / sum(den) <= {1 / (1 + STRONGEST)!r} THEN {STRONGEST}
        WHEN sum(num) / sum(den) >= {1 / (1 + WEAKEST)!r} THEN {WEAKEST} ELSE (1 - sum(num) / sum(den)) / (sum(num) / sum(den)) END
        FROM (SELECT shares - k * k / n - q * (g - 1) AS num, q * (n - squares / n - (g - 1)) AS den FROM (SELECT *, k / n * (1 - k / n) AS q FROM {{}} WHERE n > 0)))"""
    return f"""
WITH o AS ({pages}),
h AS (SELECT host, count(good) AS n, coalesce(sum(good), 0.0) AS k, string_split(host, '.') AS labels, list_aggregate(list_slice(labels, -2, -1), 'string_agg', '.') AS two FROM o GROUP BY host),
hosts AS (SELECT host, n, k, CASE WHEN two IN ({two}) THEN list_aggregate(list_slice(labels, -3, -1), 'string_agg', '.') ELSE two END AS domain,
            CASE WHEN two IN ({two}) THEN two ELSE labels[-1] END AS suffix FROM h),
domains AS ({moments(2, 'hosts', 'domain, suffix, ', 'n', 'k')}),
tops AS ({moments(1, 'domains', 'suffix, ', 'n', 'k')}),
whole AS ({moments(0, 'tops', '', 'n', 'k')}),
s AS (SELECT n AS pages, (k + 1) / (n + 2) AS base, {strength.format('whole')} AS s1, {strength.format('tops')} AS s2, {strength.format('domains')} AS s3 FROM whole),
t AS (SELECT suffix, (k + s1 * base) / (n + s1) AS rate1 FROM tops, s),
d AS (SELECT domain, suffix, (k + s2 * rate1) / (n + s2) AS rate2 FROM domains JOIN t USING (suffix), s),
r AS (SELECT host, n, (k + s3 * rate2) / (n + s3) AS rate FROM hosts JOIN d USING (domain, suffix), s),
v AS (SELECT host, pages > 0 AND rate + {Z} * sqrt(rate * (1 - rate) / (n + s3 + 1)) < {LEAST_GOOD} * base AS bad FROM r, s),
rules(verdict, rule) AS (VALUES {", ".join(f"('{a}', '{b}')" for a, b in RULES)}),
f AS (SELECT DISTINCT host, path, arg_max(struct_pack(rule := rule, verdict := verdict), length(rule)) OVER (PARTITION BY host, path) AS best
        FROM (SELECT DISTINCT host, path FROM o) x, rules
        WHERE (host = string_split(rule, '/')[1] OR ends_with(host, '.' || string_split(rule, '/')[1])) AND starts_with(path, substr(rule, strpos(rule, '/'))))
SELECT o.page_id, o.host, o.path, best.rule AS rule, coalesce(best.verdict, CASE WHEN bad THEN 'block' ELSE 'allow' END) AS verdict
FROM o JOIN v USING (host) LEFT JOIN f ON f.host = o.host AND f.path = o.path"""


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """pages (page_id, url, good: 1, 0 or null) -> page_id, host, path, rule, verdict, reputation."""
    url = F.col("url")
    pages = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), "good")
    found = (pages.select("page_id", "host", "path").join(reputations(pages).select("host", "rate", "bad"), "host", "left")
             .withColumn("rule", rule_of(F.col("host"), F.col("path"), rules)))
    ruled = F.lit(None).cast("string")
    for verdict, rule in rules:
        ruled = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(ruled)
    method = F.when(F.col("bad"), F.lit("block")).otherwise(F.lit("allow"))
    return found.select("page_id", "host", "path", "rule", F.coalesce(ruled, method).alias("verdict"), F.col("rate").alias("reputation"))
