"""Suffix-array de-duplication of long repeated byte strings, sorted deep-shallow.

Every byte covered by a ``LENGTH``-byte string that also starts in a document with a smaller id is
removed. Sorting all suffixes of a corpus would move each byte many times, so the work is cut by
*anchors*: of the hashes of all 18-byte strings inside a 50-byte string, the smallest names its
anchor. Equal strings have equal anchors at equal places, so

1. an exchange (``sharing``) finds the anchors that two or more documents hold (8 bytes for each
   anchor, about one per 17 bytes, one entry a slice however many documents hold it);
2. only around those, runs of suffixes with the same anchor travel together as one short piece of
   text to the reducer of that anchor. Equal pieces of one slice of documents are answered on
   the spot and only the one of its smallest id travels;
3. a reducer orders its suffixes to depth ``LENGTH``: multikey quicksort on 8-byte characters to
   depth 16, then, in groups that still agree, blind tries: a group takes its first string as spine,
   each string leaves the spine where it first differs, (depth, byte) names the branch, and branches
   go on in the same way. Tries of all groups are built breadth-first in one numpy pass a level;
4. within a group of equal strings, holders above the smallest doc_id lose them; the spans come back
   to the documents, which cut them out.

Exact copies share their fate: a copy with a larger id than the first loses all bytes, and only the
first takes part in 2-4. Counts, spans and hashes are those of the input bytes, exactly.

Defined cases: null text is empty. A document shorter than ``LENGTH`` loses nothing. A null doc_id is
smaller and larger than nothing: its row loses nothing and takes nothing from others. Rows with
the same doc_id take nothing from each other. Empty table: empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.llm.common import U64, blocks, discard, fresh, mix, pack, partitions, powers, ranges, slices, staged, unpack, utf8
from tidemark.llm.sharing import ROW, batch_of, part_of, shared_tokens

LENGTH = 50
ANCHOR = 18
#: Depth, in bytes, of the multikey quicksort; and suffixes ordered in one pass.
SHALLOW = 16
PASS = 1 << 20
_PIECES, _DONE = 0, 1
_B = U64(0x9FB21C651E98DF25)


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(document, anchor, first start, last start) of every run of ``length``-byte strings of
    one document with the same anchor."""
    found = []
    for a, b in blocks(offsets):
        base = offsets[a]
        doc, value, first, last = _anchors(data[base:offsets[b]], offsets[a:b + 1] - base, length)
        found.append((doc + a, value, first + base, last + base))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else _NONE


_NONE = (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))


def _anchors(data, offsets, length):
    width = length - ANCHOR + 1
    n = len(data) - ANCHOR + 1
    sizes = np.diff(offsets)
    if n < width or sizes.max() < length:
        return _NONE
    step = powers(_B, ANCHOR)
    double, span = data.astype(np.uint64), 1  # hashes of all strings of 1, 2, 4, ... bytes
    double += U64(1)
    hashes, done = None, 0
    while span <= ANCHOR:
        if ANCHOR & span:
            if hashes is None:
                hashes = double
            else:
                hashes = hashes[:len(double) - done] * step[span]
                hashes += double[done:][:len(hashes)]
            done += span
        if 2 * span <= ANCHOR:
            nxt = double[:-span] * step[span]
            nxt += double[span:]
            double = nxt
        span *= 2
    low = hashes[:n] * U64(0xBF58476D1CE4E5B9)
    low ^= low >> U64(32)
    low *= U64(0x94D049BB133111EB)
    span = 1  # smallest hash of each window, by doubling
    while 2 * span <= width:
        low = np.minimum(low[:len(low) - span], low[span:])
        span *= 2
    low = np.minimum(low[:n - width + 1], low[width - span:][:n - width + 1])
    ends = offsets[1:][sizes >= length] - length + 1
    cuts = np.unique(np.concatenate([np.flatnonzero(low[1:] != low[:-1]) + 1, offsets[:-1], ends]))
    doc = np.searchsorted(offsets, cuts, "right") - 1
    valid = np.flatnonzero(cuts < offsets[np.minimum(doc + 1, len(sizes))] - length + 1)
    first = cuts[valid]
    return doc[valid], mix(low[first]), first, cuts[valid + 1] - 1  # mixed: smallest hashes crowd at zero, and the hash deals the work


def _extract(length: int):
    def run(batch):
        data, offsets = utf8(batch.column(1))
        ids = batch.column(0).to_pylist()
        sha = [hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(offsets[:-1], offsets[1:])]
        doc, value, _, _ = anchors(data, offsets, length)
        best: dict[str, int] = {}
        for i, (x, s) in enumerate(zip(ids, sha)):
            if x is not None and (s not in best or x < ids[best[s]]):
                best[s] = i
        mine = np.zeros(len(ids) + 1, bool)
        mine[list(best.values())] = True
        kept = mine[doc]
        value, doc = value[kept], doc[kept]
        order = np.lexsort((value, doc))
        value, doc = value[order], doc[order]
        new = np.ones(len(value), bool)
        new[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
        return value[new], doc[new], _meta(ids, sha)
    return run


def _meta(ids, sha) -> bytes:
    valid = np.array([x is not None for x in ids], bool)
    return pack(np.array([x or 0 for x in ids], np.int64), valid, np.frombuffer("".join(sha).encode(), np.uint8))


def _finish(meta, token, row, held):
    ids, valid, sha = unpack(meta, np.int64, np.bool_, np.uint8)
    sha = sha.tobytes().decode()
    order = np.lexsort((token, row))
    token, row = token[order], row[order]
    holders = np.unique(row)
    cuts = np.searchsorted(row, np.append(holders, len(ids)))
    yield pa.RecordBatch.from_arrays(
        [pa.array(ids[holders]), pa.array([sha[64 * i:64 * i + 64] for i in holders], pa.string()),
         pa.array([token[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())],
        names=["doc_id", "sha", "anchors"])


def _pieces(parts: int, length: int):
    """Documents with their shared anchors -> pieces of text by anchor, and answers found on the spot."""
    def run(batches):
        for number, batch in enumerate(slices(batches, "text")):
            ids = batch.column(batch.schema.get_field_index("doc_id")).to_numpy(zero_copy_only=False)
            batch = batch.take(pa.array(np.argsort(ids, kind="stable")))
            ids, which = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("doc_id", "which"))
            data, offsets = utf8(batch.column(batch.schema.get_field_index("text")))
            doc, value, first, last = anchors(data, offsets, length)
            cuts = np.searchsorted(doc, np.arange(len(ids) + 1))
            shared = np.zeros(len(doc), bool)
            for i, blob in enumerate(batch.column(batch.schema.get_field_index("anchors")).to_pylist()):
                known, own = np.frombuffer(blob, np.uint64), value[cuts[i]:cuts[i + 1]]
                if len(known):
                    shared[cuts[i]:cuts[i + 1]] = known[np.minimum(np.searchsorted(known, own), len(known) - 1)] == own
            doc, value, first, last = doc[shared], value[shared], first[shared], last[shared]
            flat = data.tobytes()
            owner, which, seen = ids[doc], which[doc], {}
            send, done = np.ones(len(doc), bool), np.zeros(len(doc), bool)
            for i, (x, a, b) in enumerate(zip(owner.tolist(), first.tolist(), (last + length).tolist())):
                had = seen.setdefault(flat[a:b], x)
                if had < x:
                    send[i], done[i] = False, True
            rows, start = [], first - offsets[doc]
            part = part_of(value, parts)
            order = np.flatnonzero(send)
            order = order[np.argsort(value[order], kind="stable")]
            cuts = np.searchsorted(part[order], np.arange(parts + 1))
            lens = last - first + length
            for p in range(parts):
                pick = order[cuts[p]:cuts[p + 1]]
                if len(pick):
                    rows.append((p, _PIECES, 0, pack(value[pick], owner[pick], which[pick], start[pick], lens[pick].astype(np.int32), data[ranges(first[pick], lens[pick])])))
            if done.any():
                rows += _spans(owner[done], which[done], start[done], start[done] + lens[done], parts)
            yield batch_of(rows)
    return run


def _home(ids: np.ndarray, parts: int) -> np.ndarray:
    return part_of(mix(ids.astype(np.uint64)), parts)


def _spans(doc, which, start, end, parts):
    """Spans as rows by the reducer of their document."""
    home = _home(doc, parts)
    order = np.argsort(home, kind="stable")
    doc, which, start, end, home = doc[order], which[order], start[order], end[order], home[order]
    cuts = np.append(np.flatnonzero(np.append(True, home[1:] != home[:-1])), len(home))
    return [(int(home[a]), _DONE, 0, pack(doc[a:b], which[a:b], start[a:b], end[a:b])) for a, b in zip(cuts[:-1], cuts[1:])]


def equal_groups(flat: np.ndarray, at: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Number of the group of strings equal to ``length`` bytes, for every start in ``at``.

    Multikey quicksort to SHALLOW bytes, then blind tries for the groups that still agree."""
    window = np.lib.stride_tricks.sliding_window_view(flat, 8)

    def character(places, depth):
        return window[places + depth].view(">u8").ravel().astype(np.uint64)

    def runs(*keys):
        new = np.zeros(len(keys[0]), bool)
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
        return np.cumsum(new)

    group = np.zeros(len(at), np.int64)
    order = np.arange(len(at))
    for depth in range(0, min(SHALLOW, length - 7), 8):  # shallow: only runs that still agree are looked at again
        key = character(at[order], depth)
        step = np.lexsort((key, group)) if depth else np.argsort(key, kind="stable")
        order, key, group = order[step], key[step], group[step]
        group = runs(group, key)
    out = np.empty(len(at), np.int64)
    depths = [*range(min(SHALLOW, length - 8), length - 7, 8)]
    if depths[-1] != length - 8:
        depths.append(length - 8)
    number = 0
    while len(order):
        new = np.append(True, group[1:] != group[:-1])
        spine = np.repeat(order[new], np.diff(np.append(np.flatnonzero(new), len(group))))
        place = np.full(len(order), length)  # of the first difference from the spine
        byte = np.zeros(len(order), np.uint8)
        for depth in reversed(depths):
            differ = character(at[order], depth) ^ character(at[spine], depth)
            hit = np.flatnonzero(differ)
            if len(hit):
                lead = differ[hit].astype(">u8").view(np.uint8).reshape(-1, 8).astype(bool).argmax(1)
                place[hit] = depth + lead
        equal = place == length
        rank = np.cumsum(new) - 1
        out[order[equal]] = number + rank[equal]
        number += int(rank[-1]) + 1
        rest = np.flatnonzero(~equal)
        order, rank, place = order[rest], rank[rest], place[rest]
        byte = flat[at[order] + place]
        step = np.lexsort((byte, place, rank))
        order = order[step]
        group = runs(rank[step], place[step], byte[step]) if len(step) else rank
    return out


def _order(parts: int, length: int):
    """Pieces of a reducer -> spans that a smaller document also holds."""
    def run(batches):
        held = []
        for batch in batches:
            for part, kind, _, blob in zip(*(c.to_pylist() for c in batch.columns)):
                if kind == _DONE:
                    yield batch_of([(part, kind, 0, blob)])
                else:
                    held.append(unpack(blob, np.uint64, np.int64, np.int64, np.int64, np.int32, np.uint8))
        if not held:
            return
        value, doc, which, start, lens, flat = (np.concatenate(x) for x in zip(*held))
        held.clear()
        lens = lens.astype(np.int64)
        at = np.cumsum(lens) - lens
        order = np.argsort(value, kind="stable")
        many = (lens - length + 1)[order]
        total = np.cumsum(many)
        new = np.append(True, value[order][1:] != value[order][:-1])
        firsts = np.append(np.flatnonzero(new), len(order))
        a = 0
        while a < len(order):  # whole anchors, about PASS suffixes at a time
            base = total[a - 1] if a else 0
            b = int(np.searchsorted(total, base + PASS, "right"))
            b = int(firsts[np.searchsorted(firsts, max(b, a + 1))])
            pick = order[a:b]
            a = b
            piece = np.repeat(pick, lens[pick] - length + 1)
            inside = ranges(np.zeros(len(pick), np.int64), lens[pick] - length + 1)
            group = equal_groups(flat, at[piece] + inside, length)
            least = np.full(int(group.max()) + 1, np.iinfo(np.int64).max)
            np.minimum.at(least, group, doc[piece])
            gone = np.flatnonzero(doc[piece] > least[group])
            if not len(gone):
                continue
            piece, inside = piece[gone], inside[gone]
            new = np.append(True, (piece[1:] != piece[:-1]) | (inside[1:] != inside[:-1] + 1))
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(new)) - 1
            own = piece[first]
            yield batch_of(_spans(doc[own], which[own], start[own] + inside[first], start[own] + inside[last] + length, parts))
    return run


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of spans: maximal runs, touching ones joined."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.append(True, start[1:] > end[:-1])
    first = np.flatnonzero(new)
    return start[first], end[np.append(first[1:], len(new)) - 1]


def _collect(batches):
    """Spans of a reducer's documents -> (doc_id, which, spans blob), one row a text."""
    held = [unpack(blob, np.int64, np.int64, np.int64, np.int64) for batch in batches for blob in batch.column(3).to_pylist()]
    if not held:
        return
    doc, which, start, end = (np.concatenate(x) for x in zip(*held))
    order = np.lexsort((which, doc))
    doc, which, start, end = doc[order], which[order], start[order], end[order]
    cuts = np.append(np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (which[1:] != which[:-1]))), len(doc))
    for a in range(0, len(cuts) - 1, 1000):
        some = cuts[a:a + 1001]
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc[some[:-1]]), pa.array(which[some[:-1]]), pa.array([pack(*merged(start[x:y], end[x:y])) for x, y in zip(some[:-1], some[1:])], pa.binary())],
            names=["doc_id", "which", "spans"])


def cut(data: bytes, blob: bytes) -> tuple[bytes, int, int]:
    """(what is left, bytes removed, spans)."""
    start, end = unpack(blob, np.int64, np.int64)
    kept = b"".join(data[a:b] for a, b in zip([0, *end.tolist()], [*start.tolist(), len(data)]))
    return kept, len(data) - len(kept), len(start)


def _digest(batches):
    """First copies and their spans -> counts and hash of what is left."""
    for batch in batches:
        texts, blobs = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("text", "spans"))
        left = [cut(text.encode(), blob) for text, blob in zip(texts, blobs)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(batch.schema.get_field_index("sha")), pa.array([x[1] for x in left], pa.int64()), pa.array([x[2] for x in left], pa.int64()),
             pa.array([hashlib.sha256(x[0]).hexdigest() for x in left], pa.string())], names=["sha", "cut_removed", "cut_spans", "cut_sha256"])


def repeated_spans(spark: SparkSession, docs: DataFrame, length: int = LENGTH) -> tuple[DataFrame, DataFrame, DataFrame]:
    """documents (doc_id, text) -> three staged tables.

    marks: (doc_id, n_bytes, sha, first_id, which), one row a document, first_id the smallest id of its exact copies;
    spans: (doc_id, which, spans) of first copies that lose bytes;
    texts: (sha, doc_id, which, text, anchors), the first copies that were searched. ``which`` tells the texts
    of an id that has several apart (64 bits of the hash); it is 0 where an id has one."""
    if length < max(ANCHOR, SHALLOW) + 8:
        raise ValueError(f"length must be at least {max(ANCHOR, SHALLOW) + 8}")
    parts = partitions(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    marks = staged(spark, docs.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.col("text"), 256).alias("sha")), "suffix-marks")
    key = F.xxhash64("sha")
    several = marks.groupBy("doc_id").agg(F.min(key).alias("a"), F.max(key).alias("b")).where("a <> b").select(F.col("doc_id").alias("first_id"), F.lit(True).alias("several"))
    firsts = marks.groupBy("sha").agg(F.min("doc_id").alias("first_id")).join(several, "first_id", "left")
    bits = F.conv(F.substring("sha", 1, 15), 16, 10).cast("long")
    firsts = staged(spark, firsts.select("sha", "first_id", F.when(F.col("several"), bits).otherwise(0).cast("long").alias("which")), "suffix-firsts")
    held = shared_tokens(docs, _extract(length), _finish, "doc_id long, sha string, anchors binary", parts)
    held = held.join(firsts.withColumnRenamed("first_id", "doc_id"), ["sha", "doc_id"])
    texts = docs.withColumn("sha", F.sha2(F.col("text"), 256))
    texts = staged(spark, texts.join(held, ["sha", "doc_id"]).dropDuplicates(["sha", "doc_id"]).select("sha", "doc_id", "which", "text", "anchors"), "suffix-texts")
    pieces = texts.select("doc_id", "which", "text", "anchors").mapInArrow(_pieces(parts, length), ROW).repartitionById(parts, F.col("part"))
    spans = pieces.mapInArrow(_order(parts, length), ROW).repartitionById(parts, F.col("part")).mapInArrow(_collect, "doc_id long, which long, spans binary")
    return marks.join(firsts, "sha"), staged(spark, spans, "suffix-spans"), texts


def remove_repeats(spark: SparkSession, docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256), one row a document."""
    marks, spans, texts = repeated_spans(spark, docs, length)
    cuts = texts.select("sha", "doc_id", "which", "text").join(spans, ["doc_id", "which"]).select("sha", "text", "spans")
    cuts = staged(spark, cuts.mapInArrow(_digest, "sha string, cut_removed long, cut_spans long, cut_sha256 string"), "suffix-cuts")
    discard(spark, texts, spans)
    both = marks.join(cuts, "sha", "left")
    copy = (F.col("doc_id") > F.col("first_id")) & (F.col("n_bytes") >= length)
    done = F.col("cut_removed").isNotNull() & F.col("doc_id").isNotNull()

    def pick(of_copy, of_cut, of_rest):
        return F.when(copy, of_copy).when(done, of_cut).otherwise(of_rest)

    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return both.select("doc_id", "n_bytes", pick(F.col("n_bytes"), F.col("cut_removed"), F.lit(0)).cast("long").alias("n_removed"),
                       pick(F.lit(1), F.col("cut_spans"), F.lit(0)).cast("long").alias("n_spans"),
                       pick(nothing, F.col("cut_sha256"), F.col("sha")).alias("kept_sha256"))


def kept_texts(spark: SparkSession, docs: DataFrame, length: int = LENGTH, column: str = "__left") -> DataFrame:
    """``docs`` with one more column: what is left of the text, null where nothing was removed. A
    character that a cut goes through is dropped."""
    marks, spans, texts = repeated_spans(spark, docs.select("doc_id", "text"), length)
    discard(spark, texts)
    key, copy, of, blob = fresh([*docs.columns, column], "__key", "__copy", "__of", "__blob")
    # One small table says what happens to a document: its spans, or that it is a later copy.
    copies = marks.where((F.col("doc_id") > F.col("first_id")) & (F.col("n_bytes") >= length)).select("doc_id", "sha", F.lit(True).alias("copy"), F.lit(None).cast("binary").alias("spans"))
    firsts = marks.where("doc_id = first_id").select("doc_id", "sha", "which").distinct().join(spans, ["doc_id", "which"]).select("doc_id", "sha", F.lit(False).alias("copy"), "spans")
    fate = copies.distinct().unionByName(firsts).select(F.col("doc_id").alias(of), F.col("sha").alias(key), F.col("copy").alias(copy), F.col("spans").alias(blob))
    sha = F.sha2(F.coalesce(docs["text"], F.lit("")), 256)
    both = docs.join(fate, (docs["doc_id"] == F.col(of)) & (sha == F.col(key)), "left").select(*(F.col(f"`{c}`") for c in docs.columns), copy, blob)

    def run(batches):
        for batch in batches:
            texts, is_copy, blobs = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("text", copy, blob))
            left = ["" if c else None if b is None else cut(t.encode(), b)[0].decode(errors="ignore") for t, c, b in zip(texts, is_copy, blobs)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(left, pa.string())], names=[*batch.schema.names[:-2], column])

    return both.mapInArrow(run, StructType([*docs.schema.fields, StructField(column, StringType())]))
