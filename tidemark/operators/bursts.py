"""Failure bursts: a greedy anchored fold, cut into time buckets.

Per user, rows in (ts, seq) order: a failure with no open group opens one at its time (the anchor); later
failures up to anchor + within join it; a success closes and cancels it; the first row later than
anchor + within closes it for good, and if that row is a failure it is the next anchor.

What a bucket of rows does to the open group it is entered with depends on the anchor alone, and only
through the first row later than anchor + within. So a bucket is a step function, its *transfer table*:
rows (reach, exit anchor), an entry anchor a takes the first row with reach > a + within. Buckets are
``SPAN`` times ``within`` wide, hence an anchor that is still open after a bucket without anchors is out of
reach of the next one and counts as none. Tables compose like functions, as in a prefix scan:

1. rows -> table of each (user, bucket); most are one row, whatever comes in
2. tables -> table of each (user, ``SPAN`` buckets) -> anchor on entry to each of those, per user
3. entries of the wide buckets + tables -> entries of the buckets
4. entries + rows -> groups, in parts by bucket, added up by anchor

Each step is a shuffle by (user, bucket), a sort and one pass of numpy over whole sorted partitions. No
task holds more of a user than one bucket's rows, or tables of ``SPAN`` buckets, or one row for each wide
bucket; there is no switch by length, and nothing runs while the plan is built. Null users are a user.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..functions.time import MICROS_PER_SECOND, epoch_micros, floor_div

SPAN = 64
_NEVER = np.iinfo(np.int64).max


def _codes(table: pa.Table, *names: str) -> np.ndarray:
    """True where a row differs from the one before in any of the columns."""
    new = np.ones(table.num_rows, bool)
    if table.num_rows > 1:
        new[1:] = False
        for name in names:
            column = table.column(name).combine_chunks()
            code = column.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
            new[1:] |= code[1:] != code[:-1]
    return new


def _whole_groups(batches, *names: str) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted batches -> (table of whole groups, first row of each and the end)."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        if rest and not _codes(pa.Table.from_batches([rest[-1].slice(rest[-1].num_rows - 1), batch]), *names)[1:].any():
            rest.append(batch)  # the group goes on to the batch's end
            continue
        table = pa.Table.from_batches([*rest, batch])
        first = np.flatnonzero(_codes(table, *names))
        cut = int(first[-1])
        if cut:
            yield table.slice(0, cut), first
        rest = table.slice(cut).combine_chunks().to_batches()
    if rest:
        table = pa.Table.from_batches(rest)
        yield table, np.append(np.flatnonzero(_codes(table, *names)), table.num_rows)


def _long(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).fill_null(0).to_numpy()


class _Bucket:
    """Rows of whole (user, bucket) groups: where the next anchor after each failure is."""

    def __init__(self, table: pa.Table, first: np.ndarray, within: int, width: int):
        self.us, self.seq = _long(table, "us"), _long(table, "seq")
        fail = table.column("fail").to_numpy(zero_copy_only=False).astype(bool)
        n = len(self.us)
        sizes = np.diff(first)
        self.first, self.group = first, np.repeat(np.arange(len(sizes)), sizes)
        self.end = first[1:][self.group]
        self.begin_us = _long(table, "bucket")[first[:-1]] * width
        self.within, self.wide = within, width + within + 1
        self.key = self.group * self.wide + self.us - self.begin_us[self.group]
        places = np.arange(n)
        self.next_fail = np.minimum.accumulate(np.where(fail, places, n)[::-1])[::-1] if n else places
        self.next_fail = np.append(self.next_fail, n)
        success = np.minimum.accumulate(np.where(fail, n, places)[::-1])[::-1] if n else places
        self.next_success = np.append(success, n)
        late = np.minimum(np.searchsorted(self.key, self.key + within, "right"), self.end)  # first row after place's own bound
        self.closes = np.minimum(late, self.next_success[places])  # right only for failures
        self.cancelled = self.next_success[places] < late
        after = self.next_fail[self.closes]
        self.after = np.where(after < self.end, after, -1)

    def reach(self, group: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        """First row of the group later than the anchor's bound; an anchor lies before the bucket."""
        at = np.searchsorted(self.key, group * self.wide + np.maximum(anchor + self.within - self.begin_us[group], -1), "right")
        return np.clip(at, self.first[group], self.first[group + 1])


def _tables(within: int, width: int, schema: pa.Schema):
    def run(batches):
        for table, first in _whole_groups(batches, "kn", "kv", "bucket"):
            b = _Bucket(table, first, within, width)
            n, groups = len(b.us), len(first) - 1
            last = np.where(b.after < 0, np.arange(n), b.after)  # last anchor of the chain, by doubling
            while True:
                further = last[last]
                if (further == last).all():
                    break
                last = further
            stop = np.minimum(np.searchsorted(b.key, np.arange(groups) * b.wide + within, "left"), first[1:])
            stop = np.minimum(stop, b.next_success[first[:-1]])  # a success leaves nothing of what came in
            lens = stop - first[:-1] + 1
            at = np.cumsum(lens) - lens
            group = np.repeat(np.arange(groups), lens)
            k = np.arange(lens.sum()) - at[group] + first[:-1][group]
            reach = np.where(k == stop[group], _NEVER, b.us[np.minimum(k, n - 1)])
            start = b.next_fail[k]
            some = start < first[1:][group]
            end = last[np.where(some, start, 0)]
            open_ = some & (b.next_success[end] >= b.end[end])
            out_us, out_seq = np.where(open_, b.us[end], 0), np.where(open_, b.seq[end], 0)
            keep = np.ones(len(k), bool)  # of neighbours with the same exit the last
            keep[:-1] = (group[1:] != group[:-1]) | (open_[1:] != open_[:-1]) | (out_us[1:] != out_us[:-1]) | (out_seq[1:] != out_seq[:-1])
            rows = first[:-1][group[keep]]
            none = ~open_[keep]
            yield pa.RecordBatch.from_arrays(
                [*(table.column(c).combine_chunks().take(pa.array(rows)) for c in ("kn", "kv", "bucket")),
                 pa.array(reach[keep]), pa.array(out_us[keep], pa.int64(), mask=none), pa.array(out_seq[keep], pa.int64(), mask=none)], schema=schema)
    return run


def _exit(reaches: list[int], exits: list, entry: tuple | None, within: int):
    return exits[0 if entry is None else min(bisect_right(reaches, entry[0] + within), len(exits) - 1)]


def _steps(table: pa.Table, a: int, b: int) -> Iterator[tuple[int, list[int], list]]:
    """Rows a..b of one group as (bucket, reaches, exits)."""
    part = table.slice(a, b - a)
    bucket = _long(part, "bucket")
    cuts = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket)).tolist()
    reach, us, seq = (part.column(c).to_pylist() for c in ("reach", "us", "seq"))
    exits = [None if u is None else (u, s) for u, s in zip(us, seq)]
    for x, y in zip(cuts[:-1], cuts[1:]):
        yield int(bucket[x]), reach[x:y], exits[x:y]


def _composed(within: int, schema: pa.Schema):
    """Tables of the buckets of a wide bucket -> its table."""
    def run(batches):
        for table, first in _whole_groups(batches, "kn", "kv", "wide"):
            rows, reach, exits = [], [], []
            for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
                own: tuple[list[int], list] | None = None
                for _, r, e in _steps(table, a, b):
                    own = (r, e) if own is None else (own[0], [_exit(r, e, x, within) for x in own[1]])
                for i, (r, e) in enumerate(zip(*own)):
                    if i + 1 == len(own[0]) or own[1][i + 1] != e:
                        rows.append(a)
                        reach.append(r)
                        exits.append(e)
            keys = [table.column(c).combine_chunks().take(pa.array(rows)) for c in ("kn", "kv", "wide")]
            yield pa.RecordBatch.from_arrays([*keys, pa.array(reach, pa.int64()), *(pa.array([e and e[i] for e in exits], pa.int64()) for i in (0, 1))], schema=schema)
    return run


def _entries(within: int, schema: pa.Schema, *names: str):
    """Tables of a group's buckets, before them perhaps its own entry (a row without reach) -> the entry of each that has one."""
    def run(batches):
        for table, first in _whole_groups(batches, *names):
            rows, entries = [], []
            for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
                entry, at = None, a
                if table.column("reach")[a].as_py() is None:
                    entry, at = (table.column("us")[a].as_py(), table.column("seq")[a].as_py()), a + 1
                for _, r, e in _steps(table, at, b):
                    if entry is not None:
                        rows.append(at)
                        entries.append(entry)
                    entry, at = _exit(r, e, entry, within), at + len(r)
            keys = [table.column(c).combine_chunks().take(pa.array(rows, pa.int64())) for c in ("kn", "kv", "bucket")]
            yield pa.RecordBatch.from_arrays([*keys, *(pa.array([e[i] for e in entries], pa.int64()) for i in (0, 1))], schema=schema)
    return run


def _parts(within: int, width: int, schema: pa.Schema):
    """Rows of buckets, before them perhaps the entry (a row without ``fail``) -> parts of groups."""
    def run(batches):
        for table, first in _whole_groups(batches, "kn", "kv", "bucket"):
            is_row = table.column("fail").is_valid().to_numpy()
            entered = ~is_row[first[:-1]]
            entry = first[:-1][entered]
            e_us, e_seq = _long(table, "us")[entry], _long(table, "seq")[entry]
            table = table.filter(pa.array(is_row))
            sizes = np.diff(first) - entered
            has = sizes > 0
            e_us, e_seq, entered = e_us[has[entered]], e_seq[has[entered]], entered[has]
            first = np.concatenate([[0], np.cumsum(sizes[has])])
            if not table.num_rows:
                continue
            b = _Bucket(table, first, within, width)
            n, groups = len(b.us), len(first) - 1
            begins = first[:-1].copy()
            who = np.flatnonzero(entered)
            begins[who] = np.minimum(b.reach(who, e_us), np.minimum(b.next_success[first[:-1][who]], first[1:][who]))
            anchor = np.zeros(n, bool)  # the chain from the first anchor of each group, all groups in step
            at = b.next_fail[begins]
            at = at[at < first[1:]]
            while len(at):
                anchor[at] = True
                at = b.after[at]
                at = at[at >= 0]
            at = np.flatnonzero(anchor)
            # failures from the anchor to where it closes
            count = b.closes[at] - at
            rows = np.concatenate([at, first[:-1][who]])
            joined = begins[who] - first[:-1][who]
            reach = b.reach(who, e_us)
            cancelled = np.concatenate([b.cancelled[at] & (b.next_success[at] < b.end[at]), (b.next_success[first[:-1][who]] < reach)])
            last = np.concatenate([b.us[b.closes[at] - 1], np.where(joined > 0, b.us[np.maximum(begins[who] - 1, 0)], e_us)])
            yield pa.RecordBatch.from_arrays(
                [*(table.column(c).combine_chunks().take(pa.array(rows)) for c in ("kn", "kv")),
                 pa.array(np.concatenate([b.us[at], e_us])), pa.array(np.concatenate([b.seq[at], e_seq])),
                 pa.array(np.concatenate([count, joined])), pa.array(last), pa.array(cancelled)], schema=schema)
    return run


def burst_groups(logins: DataFrame, within_us: int, min_fails: int, span: int = SPAN) -> DataFrame:
    """logins (user_id, state, ts, seq) -> (user_id, first_us, last_us, fail_count), one row a burst."""
    width = span * within_us
    user = logins.schema["user_id"].dataType.simpleString()
    keys = f"kn boolean, kv {user}"
    # kn tells a null user from the value that stands for it, so that no null-safe comparison is needed.
    rows = logins.select(F.col("user_id").isNull().alias("kn"), F.col("user_id").alias("kv"),
                         epoch_micros("ts").alias("us"), "seq", (F.col("state") == "fail").alias("fail"))
    rows = rows.withColumn("fail", F.coalesce("fail", F.lit(False))).withColumn("bucket", floor_div(F.col("us"), width))

    def dealt(df, by, order):
        return df.repartition(*by).sortWithinPartitions(*by, *order)

    def ddl(text):
        return to_arrow_schema(StructType.fromDDL(text))

    kind = f"{keys}, bucket long, reach long, us long, seq long"
    tables = dealt(rows, ["kn", "kv", "bucket"], ["us", "seq"]).mapInArrow(_tables(within_us, width, ddl(kind)), kind)
    tables = tables.withColumn("wide", floor_div(F.col("bucket"), span))
    kind = f"{keys}, wide long, reach long, us long, seq long"
    composed = dealt(tables, ["kn", "kv", "wide"], ["bucket", "reach"]).mapInArrow(_composed(within_us, ddl(kind)), kind)
    entry = f"{keys}, bucket long, us long, seq long"
    wide = composed.withColumnRenamed("wide", "bucket")
    wide = dealt(wide, ["kn", "kv"], ["bucket", "reach"]).mapInArrow(_entries(within_us, ddl(entry), "kn", "kv"), entry)
    wide = wide.select("kn", "kv", F.lit(None).cast("long").alias("bucket"), F.lit(None).cast("long").alias("reach"), "us", "seq", F.col("bucket").alias("wide"))
    entries = dealt(tables.unionByName(wide), ["kn", "kv", "wide"], [F.asc_nulls_first("bucket"), "reach"])
    entries = entries.mapInArrow(_entries(within_us, ddl(entry), "kn", "kv", "wide"), entry)
    both = rows.unionByName(entries.withColumn("fail", F.lit(None).cast("boolean")))
    part = f"{keys}, first_us long, seq long, n long, last_us long, cancelled boolean"
    both = dealt(both.withColumn("is_row", F.col("fail").isNotNull()), ["kn", "kv", "bucket"], ["is_row", "us", "seq"]).drop("is_row")
    parts = both.mapInArrow(_parts(within_us, width, ddl(part)), part)
    groups = parts.groupBy("kn", "kv", "first_us", "seq").agg(F.sum("n").alias("n"), F.max("last_us").alias("last_us"), F.max("cancelled").alias("cancelled"))
    return (groups.filter((F.col("n") >= min_fails) & ~F.col("cancelled"))
            .select(F.col("kv").alias("user_id"), "first_us", "last_us", F.col("n").alias("fail_count")))
