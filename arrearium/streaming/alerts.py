"""Streaming forms of the look-back rules: same results as the batch forms, in event-time order.

An event waits in its account's state until the watermark has passed it, so arrival order does not
matter; then it is judged against what the rule carries for the account. State per account is the
waiting events plus, for the rule: the times of the last window (contact cap), a falling list of
score maxima (score drop), or one value (broken promises). Timers, all in event time, wake an account when its next
event is due and when the last of what it carries has left the window, so an account without events leaves no state; of
broken promises the last one stays, as any later one may follow it.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

# Tasks get these helpers with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DAY = 86_400_000_000

#: What a query with such state must run on.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# A rule takes the carried (times, values), one moment and its events' values, and returns the new
# carried lists and one (number, flag) per event.
Rule = Callable[[list, list, int, list], tuple[list, list, list]]


def cap_rule(max_contacts: int, days: int) -> Rule:
    def judge(times, values, at, events):
        # Moments and how many contacts each had: a moment of very many is one entry.
        kept = [(t, n) for t, n in zip(times, values) if t >= at - days * DAY] + [(at, len(events))]
        number = sum(n for _, n in kept)
        return [t for t, _ in kept], [n for _, n in kept], [(number, int(number > max_contacts))] * len(events)
    return judge


def drop_rule(points: int, days: int) -> Rule:
    def judge(times, values, at, events):
        kept = [(t, v) for t, v in zip(times, values) if t >= at - days * DAY]
        top = max(events)
        # an older score that is not above a newer one can never be the maximum again
        kept = [(t, v) for t, v in kept if v > top] + [(at, top)]
        best = kept[0][1]
        return [t for t, _ in kept], [v for _, v in kept], [(best - v, int(best - v >= points)) for v in events]
    return judge


def promise_rule() -> Rule:
    def judge(times, values, at, events):
        last, out = (values or [1])[0], []
        for kept in events:
            out.append((last, int(kept == 0 and last == 0)))
            last = kept
        return [at], [last], out
    return judge


class InEventOrder(StatefulProcessor):
    """Holds events until the watermark passes, then applies the rule moment by moment.

    keep: microseconds after which a carried entry is of no use; None: for ever.
    """

    def __init__(self, rule: Rule, keep: int | None) -> None:
        self.rule, self.keep = rule, keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "t bigint, id bigint, v bigint")
        self.carried = handle.getListState("carried", "t bigint, v bigint")

    def _wake(self, micros: int) -> None:
        self.handle.registerTimer(micros // 1000 + 1)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        new = [(int(t), int(i), int(v)) for pdf in rows for t, i, v in zip(pdf["t"], pdf["event_id"], pdf["v"])]
        self.waiting.appendList(new)
        self._wake(min(new)[0])
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = sorted(tuple(w) for w in self.waiting.get())
        ready = [w for w in waiting if w[0] < mark]
        carried = [tuple(c) for c in self.carried.get()]
        times, values, rows, at = [c[0] for c in carried], [c[1] for c in carried], [], 0
        while at < len(ready):
            end = at
            while end < len(ready) and ready[end][0] == ready[at][0]:
                end += 1
            times, values, judged = self.rule(times, values, ready[at][0], [w[2] for w in ready[at:end]])
            rows += [(None if key[1] else int(key[0]), w[1], n, flag) for w, (n, flag) in zip(ready[at:end], judged)]
            at = end
        left = waiting[len(ready):]
        if ready:
            self.waiting.put(left) if left else self.waiting.clear()
        if left:
            self._wake(left[0][0])
        # No event before the mark will be judged any more, so what none after it can look back to goes.
        kept = [(t, v) for t, v in zip(times, values) if self.keep is None or t >= mark - self.keep]
        if kept != carried:
            self.carried.put(kept) if kept else self.carried.clear()
        if kept and self.keep is not None:
            self._wake(kept[-1][0] + self.keep)
        if rows:
            yield pd.DataFrame(rows, columns=["account_id", "event_id", "measure", "alert"]).astype("Int64")


def _stateful(events: DataFrame, ts: str, value, rule: Rule, keep_days: int | None, delay: str) -> DataFrame:
    """Sets the session's state store to STATE_STORE, the one that has timers and lists.

    Events without an account are an account of their own, told by a flag: a NULL in the key would mix with its neighbour.
    """
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    at = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    account = F.col("account_id").cast("long")
    flat = at.select(F.coalesce(account, F.lit(0).cast("long")).alias("account_id"), account.isNull().alias("none"), ts, F.unix_micros(ts).alias("t"), F.col("event_id").cast("long").alias("event_id"),
                     value.cast("long").alias("v"))
    return flat.groupBy("account_id", "none").transformWithStateInPandas(
        InEventOrder(rule, None if keep_days is None else keep_days * DAY),
        "account_id bigint, event_id bigint, measure bigint, alert bigint", "Append", "EventTime")


def contact_cap_stream(contacts: DataFrame, max_contacts: int = 3, days: int = 7, delay: str = "1 day") -> DataFrame:
    """measure = contacts in the window; alert = over the cap."""
    return _stateful(contacts, "contact_ts", F.lit(1), cap_rule(max_contacts, days), days, delay)


def score_drop_stream(scores: DataFrame, points: int = 35, days: int = 90, delay: str = "1 day") -> DataFrame:
    """measure = points below the best score of the window; alert = large drop."""
    return _stateful(scores, "score_ts", F.col("score"), drop_rule(points, days), days, delay)


def broken_promise_stream(promises: DataFrame, delay: str = "1 day") -> DataFrame:
    """measure = the previous promise (1 kept or none before, 0 broken); alert = second broken in a row."""
    return _stateful(promises, "promise_ts", F.col("kept"), promise_rule(), None, delay)
