"""Which tokens of a document also occur elsewhere: the exchange below the duplicate operators.

A token is a 64-bit hash (a shingle, an anchor). Almost all tokens of a corpus occur once, so
the exchange moves each as 8 bytes inside blobs: a map task takes a slice of documents, keeps
one entry per distinct token of the slice (a token that a third of all rows hold is sent once per
slice, not once per row) and deals the entries to reducers by hash range. A reducer finds the
tokens with two or more holders and answers the slices that asked. Back at the slice, answers
are spread over its documents. No token, hot or not, gathers more than one entry per slice.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import U64, pack, slices, unpack

META, LOCAL, ENTRIES, ANSWERS = 0, 1, 2, 3
#: Owner of an entry that several documents of its slice hold.
SEVERAL = 0xFFFF
ROW = "part int, kind int, slice long, blob binary"
_SCHEMA = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("slice", pa.int64()), ("blob", pa.binary())])


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[], [], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _SCHEMA)], schema=_SCHEMA)


def edges_of(parts: int) -> np.ndarray:
    """First of the 65,536 hash cells of each reducer, and the end."""
    return -(-np.arange(parts + 1) * 65536 // parts)


def part_of(tokens: np.ndarray, parts: int) -> np.ndarray:
    return ((tokens >> U64(48)) * U64(parts) >> U64(16)).astype(np.int64)


def slice_id(number: int) -> int:
    """Unique for each slice, the same when a lost task is run again."""
    return (TaskContext.get().partitionId() << 32) + number


def _scatter(extract, parts: int, column: str):
    edges = edges_of(parts)

    def run(batches):
        for number, batch in enumerate(slices(batches, column)):
            tokens, owner, meta = extract(batch)
            me = slice_id(number)
            home = me % parts if parts > 1 else 0
            order = np.argsort(tokens)
            tokens, owner = tokens[order], owner[order].astype(np.uint16)
            new = np.ones(len(tokens), bool)
            new[1:] = tokens[1:] != tokens[:-1]
            at = np.flatnonzero(new)
            count = np.diff(np.append(at, len(tokens)))
            many = np.repeat(count > 1, count)
            rows = [(home, META, me, meta)]
            if many.any():
                rows.append((home, LOCAL, me, pack(tokens[many], owner[many])))
            one = tokens[at]
            who = np.where(count > 1, SEVERAL, owner[at]).astype(np.uint16)
            cell = (one >> U64(48)).astype(np.int64)
            cuts = np.searchsorted(cell, edges)
            low, mid = one.astype(np.uint32), (one >> U64(32)).astype(np.uint16)
            for p in range(parts):
                a, b = cuts[p], cuts[p + 1]
                if a < b:
                    per = np.bincount(cell[a:b] - edges[p], minlength=edges[p + 1] - edges[p]).astype(np.uint32)
                    rows.append((p, ENTRIES, me, pack(per, low[a:b], mid[a:b], who[a:b])))
            yield batch_of(rows)
        pa.default_memory_pool().release_unused()  # the worker stays for later tasks
    return run


def _count(parts: int):
    edges = edges_of(parts)

    def run(batches):
        tokens, owners, asked = [], [], []
        for batch in batches:
            for part, kind, me, blob in zip(*(c.to_pylist() for c in batch.columns)):
                if kind != ENTRIES:
                    yield batch_of([(part, kind, me, blob)])
                    continue
                per, low, mid, who = unpack(blob, np.uint32, np.uint32, np.uint16, np.uint16)
                cell = np.repeat(np.arange(edges[part], edges[part + 1]).astype(np.uint64), per)
                tokens.append(cell << U64(48) | mid.astype(np.uint64) << U64(32) | low)
                owners.append(who)
                asked.append(np.full(len(who), me))
        if not tokens:
            return
        token = np.concatenate(tokens)
        tokens.clear()
        owner = np.concatenate(owners)
        owners.clear()
        me = np.concatenate(asked)
        asked.clear()
        order = np.argsort(token)
        token = token[order]
        new = np.ones(len(token), bool)
        new[1:] = token[1:] != token[:-1]
        at = np.flatnonzero(new)
        held = np.add.reduceat(np.where(owner[order] == SEVERAL, 2, 1), at)
        held = np.repeat(held, np.diff(np.append(at, len(token))))
        kept = held > 1
        token, order, held = token[kept], order[kept], np.minimum(held[kept], 0xFFFFFFFF).astype(np.uint32)
        owner, me = owner[order], me[order]
        back = np.argsort(me, kind="stable")
        token, owner, held, me = token[back], owner[back], held[back], me[back]
        cuts = np.append(np.flatnonzero(np.append(True, me[1:] != me[:-1])), len(me)) if len(me) else [0]
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield batch_of([(0, ANSWERS, int(me[a]), pack(token[a:b], owner[a:b], held[a:b]))])
        pa.default_memory_pool().release_unused()
    return run


def _gather(finish):
    def close(rows):
        meta, local, answers = None, [np.zeros(0, np.uint64), np.zeros(0, np.uint16)], []
        for kind, blob in rows:
            if kind == META:
                meta = blob
            elif kind == LOCAL:
                local = unpack(blob, np.uint64, np.uint16)
            else:
                answers.append(unpack(blob, np.uint64, np.uint16, np.uint32))
        token, owner, held = (np.concatenate(x) for x in zip(*answers)) if answers else (np.zeros(0, t) for t in (np.uint64, np.uint16, np.uint32))
        several = owner == SEVERAL
        asked, count = token[several], held[several]
        order = np.argsort(asked)
        asked, count = asked[order], count[order]
        spread = count[np.searchsorted(asked, local[0])] if len(asked) else np.zeros(0, np.uint32)
        return finish(meta, np.concatenate([token[~several], local[0]]), np.concatenate([owner[~several], local[1]]).astype(np.int64),
                      np.concatenate([held[~several], spread]))

    def run(batches):
        current, rows = None, []
        for batch in batches:
            _, kinds, ids, blobs = (c.to_pylist() for c in batch.columns)
            for kind, me, blob in zip(kinds, ids, blobs):
                if me != current and rows:
                    yield from close(rows)
                    rows = []
                current = me
                rows.append((kind, blob))
        if rows:
            yield from close(rows)
    return run


def shared_tokens(docs: DataFrame, extract, finish, schema: str, parts: int, column: str = "text") -> DataFrame:
    """``extract(batch)`` gives (tokens, row of each, meta) of a slice, a row's tokens distinct;
    ``finish(meta, tokens, rows, holders)`` gets those of them that two or more rows hold, with a
    count of holders that is the same for every asker, and yields Arrow batches of ``schema``."""
    asked = docs.mapInArrow(_scatter(extract, parts, column), ROW).repartitionById(parts, F.col("part"))
    answered = asked.mapInArrow(_count(parts), ROW)
    return answered.repartition(parts, "slice").sortWithinPartitions("slice").mapInArrow(_gather(finish), schema)
