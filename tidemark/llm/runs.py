"""Periodic runs of words: stretches in which a text repeats itself back to back.

A run is a stretch of consecutive words with smallest period q, at least ``least`` words and two periods
long, that neither neighbour extends. By the runs theorem every run has a Lyndon root, a word of length
q that is the longest Lyndon word beginning at its place under the order of words or under the opposite
one. So the longest Lyndon words under both orders, each extended to both sides as far as words q apart
are equal, give all runs and nothing but runs.

- ``lyndon_array``: phase one of Baier's suffix sorter. Places are grouped by the word they begin with;
  groups are taken from the greatest down, and a place left of members of the group taken moves to a new
  group just above its own, by the number of members it absorbs. What a group shares when it is taken is the
  longest Lyndon word of its places, so no suffix array is finished. Linear.
- ``extension``: the longest common extension by binary search over prefix hashes (two 31-bit primes).
- Only stretches that hold a run at all are sorted: a run of ``least`` words repeats ``least // 2`` words
  at the distance of its period, so it lies within words covered by strings of that many words that
  their document holds twice. All other words can be in no run.

Documents are independent: one map, nothing is shuffled and no group gathered; a task holds a slice of
documents of half a megabyte (a longer document stands alone).

Defined cases: a null text, an empty one or one of white space has no words, no runs and an empty
collapsed text. A null doc_id and repeated rows are kept as they are. Empty table: empty result. Other
columns pass through; added names that clash with them get underscores.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from tidemark.llm.common import U64, fresh, mix, powers, slices, utf8

LEAST = 12
SLICE = 1 << 19
_STEP = U64(0xA0761D6478BD642F)
_PRIMES = (2147483647, 2147483629)
_BASES = (1103515245, 1664525019)


def lyndon_array(x: list[int]) -> list[int]:
    """Length of the longest Lyndon word that begins at each place of ``x``."""
    n = len(x)
    number = {s: k for k, s in enumerate(sorted(set(x)))}
    group = [number[s] for s in x]
    members: list[list[int]] = [[] for _ in number]
    for i, g in enumerate(group):
        members[g].append(i)
    shared = [1] * len(number)  # length of what all members of a group begin with
    below = list(range(-1, len(number) - 1))
    above = list(range(1, len(number) + 1))
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))  # places whose group is still to come
    longest = [0] * n
    taken = len(number) - 1
    while taken >= 0:
        size = shared[taken]
        absorbs: dict[int, int] = {}
        for i in members[taken]:
            if group[i] != taken:
                continue  # has moved up meanwhile
            longest[i] = size
            p, r = left[i], right[i]
            if r < n:
                left[r] = p
            if p >= 0:
                right[p] = r
                absorbs[p] = absorbs.get(p, 0) + 1
        if absorbs:
            split: dict[tuple[int, int], list[int]] = {}
            for p, k in absorbs.items():
                split.setdefault((k, group[p]), []).append(p)
            for k, old in sorted(split, reverse=True):  # most absorbed first: it ends up the highest
                new, over = len(members), above[old]
                members.append(split[k, old])
                shared.append(shared[old] + k * size)
                below.append(old)
                above.append(over)
                above[old] = new
                if over < len(below):
                    below[over] = new
                for p in members[new]:
                    group[p] = new
        taken = below[taken]
    return longest


def stretches(words: np.ndarray, doc: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, end) of the maximal stretches covered by strings of ``size`` words that their document holds twice."""
    none = np.zeros(0, np.int64)
    if len(words) <= size:
        return none, none
    table = powers(_STEP, size)
    ids = mix(words.astype(np.uint64) + U64(1))
    n = len(words) - size + 1
    key = ids[:n] * table[0]
    for j in range(1, size):
        key = key + ids[j:n + j] * table[j]
    whole = np.flatnonzero(doc[:n] == doc[size - 1:])
    key = mix(key[whole]) ^ mix(doc[whole].astype(np.uint64) + U64(7))
    order = np.argsort(key)
    key = key[order]
    same = key[1:] == key[:-1]
    twice = np.zeros(len(key), bool)
    twice[1:] = same
    twice[:-1] |= same
    change = np.zeros(len(words) + 1, np.int64)
    at = whole[order[twice]]
    np.add.at(change, at, 1)
    np.add.at(change, at + size, -1)
    held = np.cumsum(change[:-1]) > 0
    opens, closes = held.copy(), held.copy()
    new = doc[1:] != doc[:-1]
    opens[1:] &= ~held[:-1] | new
    closes[:-1] &= ~held[1:] | new
    return np.flatnonzero(opens), np.flatnonzero(closes) + 1


class Prefixes:
    """Prefix hashes of a sequence; ``extension`` compares its parts."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        self.sums, self.power = [], []
        for p, base in zip(_PRIMES, _BASES):
            power = np.ones(1, np.uint64)
            step = U64(base)
            while len(power) <= n:
                power = np.concatenate([power, power * step % U64(p)])
                step = step * step % U64(p)
            value = mix(words.astype(np.uint64) + U64(base)) % U64(p)
            sums = np.zeros(n + 1, np.uint64)
            sums[1:] = np.cumsum(value * power[:n] % U64(p)) % U64(p)
            self.sums.append(sums)
            self.power.append(power)

    def equal(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the parts of that length at a and at b (a < b) are equal."""
        same = np.ones(len(a), bool)
        for p, sums, power in zip(_PRIMES, self.sums, self.power):
            p = U64(p)
            one = (sums[a + length] + p - sums[a]) % p * power[b - a] % p
            same &= one == (sums[b + length] + p - sums[b]) % p
        return same

    def extension(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, back: bool = False) -> np.ndarray:
        """Words that agree from a and b on (``back``: before a and b), at most ``most``."""
        low, high = np.zeros(len(a), np.int64), most.copy()
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                return low
            mid = (low[open_] + high[open_] + 1) // 2
            shift = mid if back else 0
            fits = self.equal(a[open_] - shift, b[open_] - shift, mid)
            low[open_[fits]] = mid[fits]
            high[open_[~fits]] = mid[~fits] - 1


def runs_of(words: np.ndarray, doc: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word numbers and their documents -> (start, end, period) of every run, by start, then period."""
    none = np.zeros(0, np.int64)
    first, end = stretches(words, doc, max(1, least // 2))
    long = end - first >= least
    first, end = first[long], end[long]
    if not len(first):
        return none, none, none
    # The stretches side by side, so that nothing is kept for the words between them.
    lens = end - first
    at = np.concatenate([[0], np.cumsum(lens)])
    place = np.arange(at[-1]) - np.repeat(at[:-1], lens) + np.repeat(first, lens)
    own = words[place]
    prefixes, found = Prefixes(own), []
    begins, ends = np.repeat(at[:-1], lens), np.repeat(at[1:], lens)
    for order in (own, -own):
        longest = np.array([y for a, b in zip(at[:-1].tolist(), at[1:].tolist()) for y in lyndon_array(order[a:b].tolist())], np.int64)
        i = np.arange(len(own))
        i = i[i + longest < ends]
        i = i[own[i] == own[i + longest[i]]]  # the first root of a run is followed by its own first word
        q = longest[i]
        right = prefixes.extension(i, i + q, ends[i] - i - q)
        left = prefixes.extension(i, i + q, i - begins[i], back=True)
        start, stop = i - left, i + q + right
        run = stop - start >= np.maximum(2 * q, least)
        found.append(np.stack([place[start[run]], place[stop[run] - 1] + 1, q[run]], 1))
    found = np.unique(np.concatenate(found), axis=0)
    order = np.lexsort((found[:, 2], found[:, 0]))
    return found[order, 0], found[order, 1], found[order, 2]


def _find(schema: pa.Schema, column: str, least: int):
    def run(batches):
        for batch in slices(batches, column, SLICE):
            data, offsets = utf8(batch.column(batch.schema.get_field_index(column)))
            raw = data.tobytes()
            texts = [raw[a:b].split() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            count = np.array([len(t) for t in texts], np.int64)
            number: dict[bytes, int] = {}
            words = np.array([number.setdefault(w, len(number)) for t in texts for w in t], np.int64)
            doc = np.repeat(np.arange(len(texts)), count)
            base = np.concatenate([[0], np.cumsum(count)])
            start, end, period = runs_of(words, doc, least)
            change = np.zeros(len(words) + 1, np.int64)
            np.add.at(change, start + period, 1)
            np.add.at(change, end, -1)
            kept = np.cumsum(change[:-1]) == 0
            lean = [b" ".join(t) for t in texts]
            of = doc[start] if len(start) else np.zeros(0, np.int64)
            for d in np.unique(of).tolist():
                lean[d] = b" ".join(w for w, k in zip(texts[d], kept[base[d]:base[d + 1]].tolist()) if k)
            per = np.bincount(of, minlength=len(texts))
            spans = pa.StructArray.from_arrays([pa.array(x) for x in (start - base[of], end - start, period)], names=["start", "length", "period"])
            runs = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per)]), pa.int32()), spans)
            rest = [c for name, c in zip(batch.schema.names, batch.columns) if name != column]
            text = pa.array(lean, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*rest, pa.array(count), runs, text], schema=schema)
    return run


def collapse_runs(docs: DataFrame, column: str = "text", least: int = LEAST, names=("n_words", "runs", "collapsed")) -> DataFrame:
    """``docs`` with, instead of ``column``, its number of words, its runs (array of start, length and
    period in words, by start, then period) and its text without what repeats: a word that any run holds
    after its first period is dropped, those kept are joined by one space."""
    from pyspark.sql.pandas.types import to_arrow_schema

    names = fresh([c for c in docs.columns if c != column], *names)
    added = f"`{names[0]}` long, `{names[1]}` array<struct<start: long, length: long, period: long>>, `{names[2]}` string"
    schema = StructType([f for f in docs.schema.fields if f.name != column] + StructType.fromDDL(added).fields)
    return docs.mapInArrow(_find(to_arrow_schema(schema), column, least), schema)
