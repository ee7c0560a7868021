"""Keyed stateful detectors on streams (``transformWithStateInPandas``).

Rows of a user reach the processor in micro-batches, not in event-time
order. The login detectors therefore keep rows in a map of time slots (one
blob of rows a slot) and take them up once the watermark has passed them (no
earlier row can still arrive: Spark drops rows behind the watermark), in
(ts, seq) order. A micro-batch rewrites the slots of its own rows only, and a
timer one millisecond after a row wakes the key up. This makes the stream
result equal the batch result of ``tidemark.operators.detect`` whenever no
row is dropped as late.

A key of the state is a group of users (``groups`` of them, by hash), not one
user: each state call and each result frame costs about a millisecond whatever
it holds, so with a key a user they, not the rows, set the time. A group's rows
are worked on as arrays sorted by user. ``groups`` belongs to a checkpoint as
the shuffle partitions do, and a group's rows behind the watermark must fit a task.

State ends with the watermark: a slot goes when its rows are taken up, and
what a detector carries (last failures, open groups) when the watermark
has passed its time bound. A user who is not seen again leaves nothing.

The click cap processes rows as they arrive (sorted within a batch), as a
fraud filter should not wait for the watermark; its per-day state is
cleared by a timer at the end of the event-time day.

All processors need a watermark on ``ts`` and ``timeMode="EventTime"``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions.text import (BURST_MESSAGE, CLICK_CAP_MESSAGE, PAIR_MESSAGE, SEQUENCE_MESSAGE,
                              window_seconds_text)

US_PER_MS = 1000
US_PER_DAY = 86_400_000_000

USER_GROUPS = 256

# One row of a slot's blob; ``nobody`` marks rows without a user, who are a user of their own.
_ROW = np.dtype([("nobody", "?"), ("user", "<i8"), ("us", "<i8"), ("seq", "<i8"), ("is_fail", "?")])
# A failure that is carried on: the last one, or the first of an open group with the group's size and last time.
_CARRY = np.dtype([("nobody", "?"), ("user", "<i8"), ("us", "<i8"), ("n", "<i8"), ("last", "<i8")])

WARNING_SCHEMA = ("user_id long, first_fail_us long, last_fail_us long, fail_count long, "
                  "warning_msg string")


def _prepare_logins(df: DataFrame, groups: int) -> DataFrame:
    user = F.col("user_id").cast("long")
    return df.select(F.pmod(F.xxhash64(user), F.lit(groups)).alias("user_group"), user.isNull().alias("nobody"),
                     F.coalesce(user, F.lit(0)).alias("user"), "ts", F.unix_micros("ts").alias("us"), "seq",
                     F.coalesce(F.col("state") == "fail", F.lit(False)).alias("is_fail"))


class _OrderedBuffer(StatefulProcessor):
    """Keeps rows by time slot; feeds those behind the watermark to ``step`` by user, in order."""

    def __init__(self, within_s: float):
        self.within_us = int(round(within_s * 1_000_000))
        self.slot_us = max(self.within_us, 1_000_000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.slots = handle.getMapState("slots", "slot long", "rows binary")
        self.carried = handle.getValueState("carried", "failures binary")

    def step(self, rows: np.ndarray, n: np.ndarray, last: np.ndarray, wm_us: int):
        """``rows`` by user, in order, those carried on first; ``n`` and ``last`` are a row's failures and
        last time (more than its own for a group carried on). Every row before ``wm_us`` has then been fed.
        Returns what to carry on and the warnings: rows that begin them, last us, failures, texts."""
        raise NotImplementedError

    def _wake_after(self, us: int) -> None:
        self.handle.registerTimer(us // US_PER_MS + 1)

    def _rows(self, slot: int) -> np.ndarray:
        return np.frombuffer(bytes(self.slots.getValue((slot,))[0]), _ROW)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = np.concatenate([np.rec.fromarrays([x[c] for c in _ROW.names], dtype=_ROW) for x in rows])
        place = new["us"] // self.slot_us
        order = np.argsort(place, kind="stable")
        new, place = new[order], place[order]
        for part in np.split(new, np.flatnonzero(np.diff(place)) + 1):
            slot = int(part["us"][0]) // self.slot_us
            held = self.slots.getValue((slot,))
            self.slots.updateValue((slot,), ((b"" if held is None else bytes(held[0])) + part.tobytes(),))
        self._wake_after(int(new["us"].min()))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        wm_us = timerValues.getCurrentWatermarkInMs() * US_PER_MS
        rows = self._take(wm_us)
        had = self.carried.get() if self.carried.exists() else None
        held = np.frombuffer(b"" if had is None else bytes(had[0]), _CARRY)
        # Failures carried on are before all rows of their user: these were behind no earlier watermark.
        first = np.empty(len(held), _ROW)
        for c in ("nobody", "user", "us"):
            first[c] = held[c]
        first["seq"], first["is_fail"] = np.iinfo(np.int64).min, True
        rows = np.concatenate([first, rows])
        if not len(rows):
            return
        n, last = np.ones(len(rows), np.int64), rows["us"].copy()
        n[:len(held)], last[:len(held)] = held["n"], held["last"]
        order = np.lexsort((rows["seq"], rows["us"], rows["user"], rows["nobody"]))
        rows = rows[order]
        carry, begin, end_us, fails, texts = self.step(rows, n[order], last[order], wm_us)
        if len(carry):
            self.carried.update((carry.tobytes(),))
            self._wake_after(int(carry["us"].min()) + self.within_us)
        elif had is not None:
            self.carried.clear()
        if len(begin):
            user = pd.array(rows["user"][begin], dtype="Int64")
            user[rows["nobody"][begin]] = pd.NA
            yield pd.DataFrame({"user_id": user, "first_fail_us": rows["us"][begin], "last_fail_us": end_us,
                                "fail_count": fails, "warning_msg": texts})

    def _take(self, wm_us: int) -> np.ndarray:
        """The rows behind the watermark, taken out; a timer for the first that stays."""
        slots = sorted(int(k[0]) for k in self.slots.keys())
        edge = wm_us // self.slot_us
        ready = [np.empty(0, _ROW)]
        for slot in slots:
            rows = self._rows(slot)
            if slot > edge:
                self._wake_after(int(rows["us"].min()))
                break
            behind = rows["us"] < wm_us
            ready.append(rows[behind])
            if behind.all():
                self.slots.removeKey((slot,))
            else:
                if behind.any():
                    self.slots.updateValue((slot,), (rows[~behind].tobytes(),))
                self._wake_after(int(rows["us"][~behind].min()))
                break
        return np.concatenate(ready)

    def close(self) -> None:
        pass


def _same_user(rows: np.ndarray) -> np.ndarray:
    """Whether each row but the first is of the user of the row before."""
    return (rows["user"][1:] == rows["user"][:-1]) & (rows["nobody"][1:] == rows["nobody"][:-1])


def _carry(rows: np.ndarray, at: np.ndarray, n: np.ndarray, last: np.ndarray) -> np.ndarray:
    out = np.empty(len(at), _CARRY)
    for c in ("nobody", "user", "us"):
        out[c] = rows[c][at]
    out["n"], out["last"] = n, last
    return out


class FailPairProcessor(_OrderedBuffer):
    """Two consecutive failures of a user within ``within_s`` (inclusive);
    with ``strict=True`` the span must stay below the bound (the keyed
    sequence pattern)."""

    def __init__(self, within_s: float = 2, max_fails: int = 2, strict: bool = False):
        super().__init__(within_s)
        self.reach_us = self.within_us - 1 if strict else self.within_us
        self.msg = (SEQUENCE_MESSAGE.format(s=window_seconds_text(within_s)) if strict
                    else PAIR_MESSAGE.format(max=max_fails, s=window_seconds_text(within_s)))

    def step(self, rows, n, last, wm_us):
        us, fail, same = rows["us"], rows["is_fail"], _same_user(rows)
        hit = np.flatnonzero(same & fail[1:] & fail[:-1] & (np.diff(us) <= self.reach_us))
        # a user's last row stays if it is a failure still in reach
        end = np.flatnonzero(np.append(~same, True) & fail & (us + self.within_us >= wm_us))
        return _carry(rows, end, n[end], last[end]), hit, us[hit + 1], np.full(len(hit), 2), self.msg


class FailBurstProcessor(_OrderedBuffer):
    """Failure groups anchored at their first failure (see ``fail_bursts``)."""

    def __init__(self, within_s: float = 2, min_fails: int = 2):
        super().__init__(within_s)
        self.min_fails = min_fails
        self.within_text = window_seconds_text(within_s)

    def step(self, rows, n, last, wm_us):
        """A group ends at the first row past its bound, or is cancelled by a success before that; where
        the next group begins is looked up for all rows at once, then groups follow one another."""
        us, fail, same = rows["us"], rows["is_fail"], _same_user(rows)
        total = len(rows)
        spots = np.arange(total)
        # from each row on: the next success and the next failure (the row count: none)
        success = np.append(np.minimum.accumulate(np.where(fail, total, spots)[::-1])[::-1], total)
        failure = np.append(np.minimum.accumulate(np.where(fail, spots, total)[::-1])[::-1], total)
        run = np.cumsum(np.append(0, ~same))
        run_end = np.append(np.flatnonzero(~same) + 1, total)[run]
        # the first row of the user past each row's bound: rows merged with their bounds, bounds after equal rows
        order = np.lexsort((np.repeat([0, 1], total), np.append(us, us + self.within_us), np.append(run, run)))
        bound = order >= total
        past = np.empty(total, np.int64)
        past[order[bound] - total] = np.cumsum(~bound)[bound]
        cancelled = success[:-1] < past
        follow = failure[np.where(cancelled, success[:-1] + 1, past)].tolist()
        at, begins = int(failure[0]), []
        while at < total:
            begins.append(at)
            at = follow[at]
        begin = np.array(begins, np.int64)
        begin = begin[~cancelled[begin]]
        end = past[begin]
        fails = n[begin] + end - begin - 1
        end_us = np.where(end - begin > 1, us[end - 1], last[begin])
        closed = (end < run_end[begin]) | (us[begin] + self.within_us < wm_us)
        found = closed & (fails >= self.min_fails)
        texts = [BURST_MESSAGE.format(n=x, s=self.within_text) for x in fails[found].tolist()]
        carry = _carry(rows, begin[~closed], fails[~closed], end_us[~closed])
        return carry, begin[found], end_us[found], fails[found], texts


def fail_pairs_stream(logins: DataFrame, within_s: float = 2, max_fails: int = 2,
                      delay: str = "3 seconds", groups: int = USER_GROUPS) -> DataFrame:
    """Streaming D2. ``logins``: user_id, state, ts, seq (a stream)."""
    src = _prepare_logins(logins, groups).withWatermark("ts", delay)
    return src.groupBy("user_group").transformWithStateInPandas(
        FailPairProcessor(within_s, max_fails), WARNING_SCHEMA, "append", "EventTime")


def fail_sequences_stream(logins: DataFrame, within_s: float = 2,
                          delay: str = "3 seconds", groups: int = USER_GROUPS) -> DataFrame:
    """Streaming D3, keyed by user (fail then fail, span < within). The
    unkeyed form would put the whole stream in one task; use the batch
    ``detect.fail_sequences(keyed=False)`` over stored rows instead."""
    src = _prepare_logins(logins, groups).withWatermark("ts", delay)
    return src.groupBy("user_group").transformWithStateInPandas(
        FailPairProcessor(within_s, strict=True), WARNING_SCHEMA, "append", "EventTime")


def fail_bursts_stream(logins: DataFrame, within_s: float = 2, min_fails: int = 2,
                       delay: str = "3 seconds", groups: int = USER_GROUPS) -> DataFrame:
    """Streaming D1."""
    src = _prepare_logins(logins, groups).withWatermark("ts", delay)
    return src.groupBy("user_group").transformWithStateInPandas(
        FailBurstProcessor(within_s, min_fails), WARNING_SCHEMA, "append", "EventTime")


CAP_SCHEMA = "user_id long, ad_id long, province string, us long, seq long, kind string, msg string"


class ClickCapProcessor(StatefulProcessor):
    """Per (user, ad, event-time day): pass the first max+1 clicks, warn once on the next, drop the
    rest. Each day has a count of its own, so clicks of an earlier day that arrive late neither
    reset nor use up another day's cap. Rows of one batch are taken in (ts, seq) order. A timer
    clears the count when the watermark passes the end of the day."""

    def __init__(self, max_clicks: int = 100):
        self.max_clicks = max_clicks
        self.msg = CLICK_CAP_MESSAGE.format(max=max_clicks)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.count = handle.getValueState("count", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows), ignore_index=True).sort_values(["us", "seq"], kind="mergesort", ignore_index=True)
        if self.count.exists():
            before = self.count.get()[0]
        else:
            before = 0
            self.handle.registerTimer((int(key[2]) + 1) * US_PER_DAY // US_PER_MS)
        self.count.update((before + len(pdf),))
        n = before + 1 + pdf.index
        out = pdf[n <= self.max_clicks + 2].assign(user_id=key[0], ad_id=key[1], kind="pass", msg=None)
        if len(out):
            last = n[:len(out)] == self.max_clicks + 2
            out.loc[last, "kind"], out.loc[last, "msg"] = "warn", self.msg
            yield out[["user_id", "ad_id", "province", "us", "seq", "kind", "msg"]]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.count.clear()
        return iter([])

    def close(self) -> None:
        pass


def click_cap_stream(clicks: DataFrame, max_clicks: int = 100, delay: str = "1 day") -> DataFrame:
    """Streaming D4: tagged rows (kind 'pass' / 'warn'); split them with
    ``tidemark.streaming.sinks.split_by_kind``. Output does not wait for the watermark; ``delay``
    only says how late a click may come before its day's count is gone."""
    src = (clicks.select("user_id", "ad_id", F.col("province").cast("string").alias("province"),
                         "ts", F.unix_micros("ts").alias("us"), "seq",
                         F.floor(F.unix_micros("ts") / US_PER_DAY).alias("day"))
           .withWatermark("ts", delay))
    return src.groupBy("user_id", "ad_id", "day").transformWithStateInPandas(
        ClickCapProcessor(max_clicks), CAP_SCHEMA, "append", "EventTime")
