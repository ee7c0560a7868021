"""N-gram Jaccard join with a token-group matrix.

A document is its set of distinct 5-word shingles (64-bit hashes). Documents with equal sets are
one *class*; two classes link when their Jaccard similarity reaches the threshold. The result
gives each document its class, its component and the smallest doc_id reachable by links.

1. Exchange (``sharing``): which shingles of a document occur elsewhere. The shingles that two
   documents have in common are among these, so a document with fewer shared shingles than
   ``threshold`` of its set has no partner and is settled. Nothing is approximated by this.
2. Groups: what remains is sorted by min-hash and cut into blocks of at most ``BLOCK`` classes, whose
   links a product of the block's token matrix gives; three rounds with different min-hashes. A
   family of a million near copies mostly becomes one component here, in blocks, without its pairs.
   A component, cut into parts of about ``BLOCK`` classes, is a group set of the matrix.
3. Matrix: each group stores the union of its members' shingles. A class only queries groups of
   *other* components that share one of its prefix shingles (rarest first; a linked pair must
   share one, with enough of both left behind it; the sizes that leaves a partner are part of the
   join's key, so documents that share a long passage without linking do not meet). The group is opened only if ``|query n union| >= threshold * |query|`` and some
   member's size fits; opened, the members are verified exactly.
4. Components over the links found.

Defined cases: null or blank text: no shingles, class null, alone. Fewer than five words: the
whole sequence is one shingle. A null doc_id takes part in links but never names a component (a
component of only null ids has a null name). Repeated rows fall into one class. Empty table:
empty result. Other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import discard, lowered, pack, partitions, shingle_hashes, staged, unpack, utf8, word_bounds, word_hashes, mix, U64
from tidemark.llm.components import connected_components
from tidemark.llm.sharing import shared_tokens

SHINGLE_WORDS = 5
#: Similarity 75 / 100, compared in whole numbers.
PERCENT = 75
#: Classes in a block of the grouping rounds, and members of a group of the matrix.
BLOCK = 128
ROUNDS = 3
_SIGNS = [U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F), U64(0x165667B19E3779F9)]

_DOCS = ("doc_id long, text_key long, n_shingles long, class long, "
         "sign0 long, sign1 long, sign2 long, tokens binary")


def least_overlap(n, percent: int = PERCENT):
    """Shared shingles that any link of a set of ``n`` needs."""
    return -(-percent * n // 100)


def linked(overlap, n, m, percent: int = PERCENT):
    return 100 * overlap >= percent * (n + m - overlap)


def _extract(size: int):
    def run(batch):
        data, offsets = utf8(batch.column(1))
        data = lowered(data)
        starts, ends, doc = word_bounds(data, offsets)
        hashes, owner = shingle_hashes(word_hashes(data, starts, ends), doc, batch.num_rows, size)
        cuts = np.searchsorted(owner, np.arange(batch.num_rows + 1))
        n, name = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
        tokens, owners, seen = [], [], set()
        for i in range(batch.num_rows):
            if cuts[i] == cuts[i + 1]:
                continue
            own = np.sort(hashes[cuts[i]:cuts[i + 1]])
            own = own[np.append(True, own[1:] != own[:-1])]
            n[i] = len(own)
            name[i] = int.from_bytes(hashlib.blake2b(own.tobytes(), digest_size=8).digest(), "little", signed=True)
            if name[i] not in seen:  # one entry a class and slice
                seen.add(name[i])
                tokens.append(own)
                owners.append(np.full(len(own), i))
        ids = batch.column(0)
        meta = pack(ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), ids.is_valid().to_numpy(zero_copy_only=False), batch.column(2).to_numpy(), n, name)
        if not tokens:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), meta
        return np.concatenate(tokens), np.concatenate(owners), meta
    return run


def _finish(percent: int):
    def run(meta, token, row, held):
        ids, valid, keys, n, name = unpack(meta, np.int64, np.bool_, np.int64, np.int64, np.int64)
        count = np.bincount(row, minlength=len(n))
        live = np.flatnonzero((count > 0) & (count >= least_overlap(n, percent)))
        signs, blobs = [np.zeros(len(n), np.int64) for _ in _SIGNS], [None] * len(n)
        alive = np.zeros(len(n), bool)
        alive[live] = True
        mine = alive[row]
        token, row, held = token[mine], row[mine], held[mine]
        order = np.lexsort((token, held, row))  # rarest first
        token, row, held = token[order], row[order], held[order]
        cuts = np.searchsorted(row, np.append(live, len(n)))
        for j, i in enumerate(live):
            own = token[cuts[j]:cuts[j + 1]]
            blobs[i] = own.tobytes()
            for sign, factor in zip(signs, _SIGNS):
                sign[i] = mix(own * factor).min().astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64(), mask=~valid), pa.array(keys), pa.array(n), pa.array(name, pa.int64(), mask=n == 0),
             *(pa.array(s) for s in signs), pa.array(blobs, pa.binary())],
            names=["doc_id", "text_key", "n_shingles", "class", "sign0", "sign1", "sign2", "tokens"])
    return run


def _tokens(blob: bytes) -> np.ndarray:
    return np.sort(np.frombuffer(blob, np.uint64))


def overlap_of(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(b):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def overlaps(sets: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of all intersections of a bounded block of sets, by products of their token matrix."""
    token, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    order = np.argsort(token)
    token, owner = token[order], owner[order]
    new = np.append(True, token[1:] != token[:-1])
    column = np.cumsum(new) - 1
    common = np.bincount(column) > 1  # a token of one set meets nobody
    kept = common[column]
    column, owner = (np.cumsum(common) - 1)[column[kept]], owner[kept]
    out = np.zeros((len(sets), len(sets)), np.int64)
    for first in range(0, int(common.sum()), columns):
        part = (column >= first) & (column < first + columns)
        matrix = np.zeros((len(sets), columns), np.float32)
        matrix[owner[part], column[part] - first] = 1
        out += (matrix @ matrix.T).astype(np.int64)
    return out


def _group(sign: str, percent: int):
    """Blocks of neighbouring rows with the same min-hash -> (class, leader): the smallest class
    that links inside the block reach."""
    def close(rows):
        names, n = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
        leader = names.copy()
        if len(rows) > 1:
            both = overlaps([np.frombuffer(r[2], np.uint64) for r in rows])
            link = linked(both, n[:, None], n[None, :], percent)
            while True:  # smallest name along links, at most a block's length of rounds
                low = np.where(link, leader[None, :], np.iinfo(np.int64).max).min(1)
                low = np.minimum(low, leader)
                if (low == leader).all():
                    break
                leader = low
        return pa.RecordBatch.from_arrays([pa.array(names), pa.array(leader)], names=["class", "leader"])

    def run(batches):
        current, rows = None, []
        for batch in batches:
            for s, name, n, blob in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (sign, "class", "n", "tokens"))):
                if rows and (s != current or len(rows) == BLOCK):
                    yield close(rows)
                    rows = []
                current = s
                rows.append((name, n, blob))
        if rows:
            yield close(rows)
    return run


def _prefix(percent: int):
    """Rows (token, rest, ...) of the shingles of which a linked pair must share one; ``rest``
    counts the shingles from this one to the end of the order."""
    def run(batches):
        for batch in batches:
            names, comps, ns, blobs = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("class", "comp", "n", "tokens"))
            for name, comp, n, blob in zip(names, comps, ns, blobs):
                own = np.frombuffer(blob, np.int64)
                size = n - least_overlap(n, percent) + 1 - (n - len(own))  # unshared shingles come first and find nobody
                rest = len(own) - np.arange(max(min(size, len(own)), 0))
                if len(rest):
                    yield pa.RecordBatch.from_arrays([pa.array(own[:len(rest)]), pa.array(rest), *(pa.array(np.full(len(rest), x)) for x in (name, comp, n))],
                                                     names=["token", "rest", "class", "comp", "n"])
    return run


def _matrix_row(key, table):
    """A group's token union and its members, both as blobs."""
    blobs = [_tokens(x) for x in table.column("tokens").to_pylist()]
    members = pack(np.array(table.column("class").to_pylist(), np.int64), np.array(table.column("n").to_pylist(), np.int64),
                   np.array([len(x) for x in blobs], np.int64), np.concatenate(blobs))
    return pa.table({"comp": pa.array([key[0].as_py()], pa.int64()), "block": pa.array([key[1].as_py()], pa.int64()),
                     "token_union": pa.array([np.unique(np.concatenate(blobs)).tobytes()], pa.binary()), "members": pa.array([members], pa.binary())})


def _open(percent: int):
    """Candidate (query, group) rows: bound by the union, then verify members; -> links."""
    def run(batches):
        for batch in batches:
            out = []
            cols = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("class", "n", "tokens", "token_union", "members"))
            for name, n, blob, union, members in zip(*cols):
                own = _tokens(blob)
                if overlap_of(own, np.frombuffer(union, np.uint64)) < least_overlap(n, percent):
                    continue
                names, sizes, lens, tokens = unpack(members, np.int64, np.int64, np.int64, np.uint64)
                at = np.concatenate([[0], np.cumsum(lens)])
                fits = 100 * np.minimum(sizes, n) >= percent * np.maximum(sizes, n)
                for j in np.flatnonzero(fits):
                    if linked(overlap_of(own, tokens[at[j]:at[j + 1]]), n, int(sizes[j]), percent):
                        out.append((name, int(names[j])))
                        break  # the members are connected already: one link joins the components
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], names=["a", "b"])
    return run


def size_band(n):
    """Number of a band of set sizes; rises with ``n``, each band is a tenth wide."""
    n = n.cast("double")
    return F.when(n < 20, n).otherwise(20 + F.floor(F.log(n / 20) / math.log(1.1))).cast("long")


def askers(met: DataFrame, percent: int) -> DataFrame:
    """Prefix rows, once a band of sizes that a partner first met at this shingle can have. Beside the size
    bound, no more than what is left of the row's own set can be common: long sets with a common passage at
    the end of their prefix ask for short partners only, not for one another."""
    least = F.floor((F.col("n") * percent + 99) / 100)
    most = F.least(F.floor(F.col("n") * 100 / percent), F.floor(F.col("rest") * (100 + percent) / percent) - F.col("n"))
    return (met.select("token", "rest", "class", "comp", "size", "n", least.alias("least"), most.alias("most")).where("least <= most")
            .withColumn("band", F.explode(F.sequence(size_band(F.col("least")), size_band(F.col("most"))))))


def answerers(met: DataFrame) -> DataFrame:
    """Groups at each shingle of a prefix, by band of their members' sizes."""
    return (met.groupBy("token", size_band(F.col("n")).alias("band"), F.col("comp").alias("g_comp"), F.col("block").alias("g_block"))
            .agg(F.first("size").alias("g_size"), F.max("rest").alias("g_rest"), F.min("n").alias("g_least"), F.max("n").alias("g_most")))


def candidates(met: DataFrame, percent: int) -> DataFrame:
    """(class, g_comp, g_block): which class has to ask which group."""
    fits = ((F.least("rest", "g_rest") * (100 + percent) >= percent * (F.col("n") + F.col("g_least")))
            & (F.col("least") <= F.col("g_most")) & (F.col("g_least") <= F.col("most")))
    return (askers(met, percent).join(answerers(met), ["token", "band"])
            .where("struct(size, comp) < struct(g_size, g_comp)").where(fits).select("class", "g_comp", "g_block").distinct())


def near_duplicates(spark: SparkSession, docs: DataFrame, shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """documents (doc_id, text) -> (doc_id, text_key, n_shingles, class, root, component_id), one row a document.

    text_key is xxhash64 of the text, which tells rows of one id apart; root names the component even
    where several have the same smallest id or none."""
    parts = partitions(spark)
    every = staged(spark, shared_tokens(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_key")), _extract(shingle_words), _finish(percent), _DOCS, parts), "jaccard-docs")
    classes = staged(spark, every.where("tokens is not null").select("class", F.col("n_shingles").alias("n"), "sign0", "sign1", "sign2", "tokens")
                     .dropDuplicates(["class"]), "jaccard-classes")
    led = None
    for r in range(ROUNDS):
        sign, then = f"sign{r}", f"sign{(r + 1) % ROUNDS}"
        one = (classes.select("class", "n", sign, then, "tokens").repartitionByRange(parts, sign, then, "class").sortWithinPartitions(sign, then, "class")
               .mapInArrow(_group(sign, percent), "class long, leader long"))
        one = staged(spark, one.where("class <> leader"), "jaccard-groups")
        led = one if led is None else led.unionByName(one)
    roots = connected_components(spark, led.select(F.col("class").alias("a"), F.col("leader").alias("b")))
    label = classes.select("class").join(roots.withColumnRenamed("node", "class"), "class", "left").select("class", F.coalesce("root", "class").alias("comp"))
    label = staged(spark, label, "jaccard-labels")

    sizes = label.groupBy("comp").agg(F.count("*").alias("size"))
    known = classes.join(label, "class").join(sizes, "comp").withColumn("block", F.pmod(F.xxhash64("class"), F.ceil(F.col("size") / BLOCK)).cast("long"))
    known = staged(spark, known.select("class", "n", "tokens", "comp", "size", "block"), "jaccard-known")
    prefix = known.select("class", "comp", "n", "tokens").mapInArrow(_prefix(percent), "token long, rest long, class long, comp long, n long")
    place = known.select("class", "size", "block")
    met = prefix.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("token")
    met = staged(spark, prefix.join(met, "token").join(place, "class"), "jaccard-prefix")
    asked = candidates(met, percent)
    wanted = asked.select(F.col("g_comp").alias("comp"), F.col("g_block").alias("block")).distinct()
    matrix = (known.select("comp", "block", "class", "n", "tokens").join(wanted, ["comp", "block"], "left_semi")
              .groupBy("comp", "block").applyInArrow(_matrix_row, "comp long, block long, token_union binary, members binary"))
    found = (asked.join(known.select("class", "n", "tokens"), "class")
             .join(matrix.withColumnsRenamed({"comp": "g_comp", "block": "g_block"}), ["g_comp", "g_block"])
             .select("class", "n", "tokens", "token_union", "members").mapInArrow(_open(percent), "a long, b long"))
    found = staged(spark, found, "jaccard-links")
    name = label.select(F.col("class").alias("a"), F.col("comp").alias("x")), label.select(F.col("class").alias("b"), F.col("comp").alias("y"))
    links = found.join(name[0], "a").join(name[1], "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    roots = connected_components(spark, links)
    label = label.join(roots.withColumnRenamed("node", "comp"), "comp", "left").select("class", F.coalesce("root", "comp").alias("root"))

    first = every.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("first")).join(label, "class", "left")
    first = first.select("class", "first", F.coalesce("root", "class").alias("root"))
    lowest = first.groupBy("root").agg(F.min("first").alias("component_id"))
    named = first.join(lowest, "root").select("class", "root", "component_id")
    out = (every.select("doc_id", "text_key", "n_shingles", "class").join(named, "class", "left")
           .select("doc_id", "text_key", "n_shingles", "class", "root", F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")))
    out = staged(spark, out, "jaccard-result")
    discard(spark, every, classes, known, met)
    return out
