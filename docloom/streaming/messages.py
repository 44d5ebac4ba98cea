"""Console messages: decoding, routing, throttling and the latest scripts, on streams and on tables."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from docloom.checkpoints import materialise

MESSAGE = (
    "messageID int, message string, error string, guid string, returnValue string, "
    "scriptStates array<struct<name: string, guid: string, script: string, ui: string>>"
)
#: Message numbers of the protocol.
KINDS = {0: "scripts", 1: "scripts", 2: "print", 3: "error", 5: "return", 7: "created"}


def read_messages(raw: DataFrame, text: str = "value") -> tuple[DataFrame, DataFrame]:
    """SRC-13: decoded messages and, apart, the rows that aren't one. For streams and tables alike."""
    told = raw.withColumn("m", F.from_json(F.col(text), MESSAGE))
    good = F.col("m.messageID").isNotNull()
    return told.where(good).select(*(c for c in raw.columns if c != text), "m.*"), told.where(~good | F.col("m").isNull()).drop("m")


def route_messages(messages: DataFrame, kind: str = "message_id") -> DataFrame:
    """STR-1: messages with `route`; those of other ids are left out."""
    table = F.create_map(*(F.lit(x) for kv in KINDS.items() for x in kv))
    return messages.withColumn("route", F.try_element_at(table, F.col(kind))).where("route is not null")


def throttle_errors(errors: DataFrame, window_seconds: float, key: str = "body", ts: str = "ts") -> DataFrame:
    """STR-2 on a table: (key, ts) of the errors printed: a text again only when more than the window has passed since
    it was last printed; suppressed ones don't extend the window.

    Each time points to the one printed after it, if it is printed itself: the first beyond its window. Times that come more
    than the window after the one before are printed whatever was; what their pointers lead to is found by doubling: after
    k rounds all that is up to 2**k steps away. Rows are dealt by text and stretch of time, so the times of one text spread
    over tasks; a stretch is as long as the window, and a time's pointer ends in its own stretch or the next two. (If the next is
    empty, then what comes after it begins anew.) Rounds are written down, each about as large as what still has that many
    steps before it. Null times are left out; a null text is a text.
    """
    gap = int(window_seconds * 1_000_000)
    stretch = lambda at: F.floor(at / F.lit(gap + 1)).cast("bigint")
    times = errors.select(F.col(key).cast("string").alias("k"), F.unix_micros(F.col(ts).cast("timestamp")).alias("t")).where("t is not null").distinct()
    times = materialise(times.withColumn("b", stretch(F.col("t"))), "times")
    ends = times.groupBy("k", "b").agg(F.min("t").alias("first"), F.max("t").alias("last"))
    beside = lambda df, to, column: df.join(ends.select(F.col("k").alias("k2"), (F.col("b") - to).alias("b2"), column), F.col("k").eqNullSafe(F.col("k2")) & (F.col("b") == F.col("b2")), "left").drop("k2", "b2")
    lagged = beside(times.withColumn("p", F.lag("t").over(Window.partitionBy("k", "b").orderBy("t"))), -1, "last")
    starts = lagged.where(F.coalesce(F.col("t") - F.coalesce("p", "last") > gap, F.lit(True))).select("k", "t")
    # elements and the ends of windows in one order, from the latest: the last element seen is the next one
    asked = times.select("k", stretch(F.col("t") + gap).alias("b"), (F.col("t") + gap).alias("at"), F.col("t").alias("origin"))
    both = asked.unionAll(times.select("k", "b", F.col("t").alias("at"), F.lit(None).cast("bigint").alias("origin")))
    seen = F.last(F.when(F.col("origin").isNull(), F.col("at")), ignorenulls=True)
    down = Window.partitionBy("k", "b").orderBy(F.col("at").desc(), F.col("origin").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    after = beside(both.withColumn("n", seen.over(down)).where("origin is not null"), 1, "first")
    steps = after.select("k", F.col("origin").alias("t"), F.coalesce("n", "first").alias("n")).where("n is not null")
    printed, steps = materialise(starts, "printed"), materialise(steps, "steps")
    while not steps.isEmpty():
        by = steps.select(F.col("k").alias("k2"), F.col("t").alias("t2"), F.col("n").alias("n2"))
        reached = printed.join(by, F.col("k").eqNullSafe(F.col("k2")) & (F.col("t") == F.col("t2"))).select("k", F.col("n2").alias("t"))
        printed = materialise(printed.unionAll(reached).distinct(), "printed")
        twice = steps.join(by, F.col("k").eqNullSafe(F.col("k2")) & (F.col("n") == F.col("t2"))).select("k", "t", F.col("n2").alias("n"))
        steps = materialise(twice, "steps")
    return printed.select(F.col("k").alias(key), F.timestamp_micros("t").alias(ts))


def throttle_error_stream(errors: DataFrame, window_seconds: float, key: str = "body", ts: str = "ts", watermark: str = "1 hour") -> DataFrame:
    """STR-2 on a stream: the same rule with the last printed time of each text as state, dropped once the watermark is
    past the window. Within a micro-batch, times are taken in order."""
    gap = int(window_seconds * 1_000_000)

    def step(k: tuple, frames: Iterable[pd.DataFrame], state: Any) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        times = sorted(int(t.value // 1000) for f in frames for t in f[ts])
        last, printed = (state.get[0] if state.exists else None), []
        for t in times:
            if last is None or t - last > gap:
                last = t
                printed.append(t)
        state.update((last,))
        if (at := last // 1000 + gap // 1000 + 1) > state.getCurrentWatermarkMs():
            state.setTimeoutTimestamp(at)
        else:
            state.remove()
        if printed:
            yield pd.DataFrame({key: [k[0]] * len(printed), ts: pd.to_datetime(printed, unit="us")})

    from pyspark.sql.streaming.state import GroupStateTimeout

    return (
        errors.withWatermark(ts, watermark).groupBy(key).applyInPandasWithState(step, f"`{key}` string, `{ts}` timestamp", "last long", "append", GroupStateTimeout.EventTimeTimeout)
    )


def script_entries(messages: DataFrame) -> DataFrame:
    """STR-3: messages (ts, messageID, target, scriptStates) to (ts, guid, script). Message 0 brings its first entry whatever
    the target, message 1 the entries of the target. Narrow, for streams and tables alike."""
    own = F.filter("scriptStates", lambda s: s["guid"] == F.col("target"))
    states = F.when(F.col("messageID") == 0, F.slice("scriptStates", 1, 1)).when(F.col("messageID") == 1, own)
    return messages.select("ts", F.explode(states).alias("s")).select("ts", "s.guid", "s.script")


def latest_scripts(messages: DataFrame) -> DataFrame:
    """STR-3: (guid, script) of the latest script of each object."""
    return script_entries(messages).groupBy("guid").agg(F.max_by("script", "ts").alias("script"))


def missing_targets(messages: DataFrame) -> DataFrame:
    """STR-3: (ts, target, received) of the messages 1 none of whose entries is the target's."""
    found = F.exists("scriptStates", lambda s: s["guid"] == F.col("target"))
    return messages.where((F.col("messageID") == 1) & ~F.coalesce(found, F.lit(False))).select("ts", "target", F.size("scriptStates").alias("received"))


def told_apart(raw: DataFrame, text: str = "value") -> DataFrame:
    """SRC-13, STR-1: raw messages (ts, target and a JSON text) to (kind, key, ts, text): scripts by object, errors by text,
    prints, returned values and created objects as they come. What isn't a message, or of no known kind, is left out."""
    good, _ = read_messages(raw, text)
    routed = route_messages(good, "messageID")
    scripts = script_entries(routed.where("route = 'scripts'")).select(F.lit("script").alias("kind"), F.col("guid").alias("key"), "ts", F.col("script").alias("text"))
    said = F.when(F.col("route") == "error", F.col("error")).when(F.col("route") == "print", F.col("message")).when(F.col("route") == "return", F.col("returnValue"))
    rest = routed.where("route <> 'scripts'").select(F.col("route").alias("kind"), F.when(F.col("route") == "error", said).otherwise(F.col("guid")).alias("key"), "ts", said.alias("text"))
    return scripts.unionAll(rest)


def console_table(raw: DataFrame, window_seconds: float, text: str = "value") -> DataFrame:
    """SRC-13 to STR-3 on a table: (kind, key, ts, text): the latest script of each object (of one time, the largest text),
    the errors printed, and all other messages."""
    told = told_apart(raw, text)
    latest = told.where("kind = 'script'").groupBy("kind", "key").agg(F.max(F.struct("ts", "text")).alias("x")).select("kind", "key", "x.ts", "x.text")
    printed = throttle_errors(told.where("kind = 'error'"), window_seconds, "key").select(F.lit("error").alias("kind"), "key", "ts", F.col("key").alias("text"))
    return latest.unionAll(printed).unionAll(told.where("kind not in ('script', 'error')"))


class Console(StatefulProcessor):
    """The state of one object or error text: its latest script, or the times that wait for the watermark and the time last
    printed. Errors are decided in the order of their times once the watermark has passed them, so rows that come late, or
    again after a restart, change nothing; what is past its window is dropped."""

    def __init__(self, window_seconds: float):
        self.gap = int(window_seconds * 1_000_000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "ts long, text string")
        self.waiting = handle.getListState("waiting", "ts long")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803 (Spark's names)
        kind, own = key
        found = [(int(t.value // 1000), x) for f in rows for t, x in zip(f["ts"], f["text"], strict=True)]
        if kind == "script":
            newest = max(found, key=lambda x: (x[0], x[1] or ""))
            if not self.last.exists() or (newest[0], newest[1] or "") > (self.last.get()[0], self.last.get()[1] or ""):
                self.last.update(newest)
                yield self._row(kind, own, [newest])
            return
        times = sorted({t for t, _ in found})
        self.waiting.appendList([(t,) for t in times])
        for t in times:
            self.handle.registerTimer(t // 1000 + 1)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        now = timerValues.getCurrentWatermarkInMs() * 1000
        times = sorted({t for (t,) in self.waiting.get()})
        last, printed = self.last.get()[0] if self.last.exists() else None, []
        for t in (t for t in times if t < now):
            if last is None or t - last > self.gap:
                last = t
                printed.append((t, key[1]))
        left = [(t,) for t in times if t >= now]
        self.waiting.clear()
        if left:
            self.waiting.appendList(left)
        if last is not None and (left or last + self.gap >= now):
            self.last.update((last, None))
            self.handle.registerTimer(max((last + self.gap) // 1000, now // 1000) + 1)
        else:
            self.last.clear()
        if printed:
            yield self._row(key[0], key[1], printed)

    @staticmethod
    def _row(kind: str, own: str, found: list[tuple[int, str]]) -> pd.DataFrame:
        return pd.DataFrame({"kind": kind, "key": own, "ts": pd.to_datetime([t for t, _ in found], unit="us"), "text": [x for _, x in found]})

    def close(self) -> None:
        pass


def console_stream(raw: DataFrame, window_seconds: float, text: str = "value", lateness: str = "1 hour") -> DataFrame:
    """SRC-13 to STR-3 on a stream (ts, target and a JSON text), one stateful operator: (kind, key, ts, text) as in
    `console_table`. An object's script comes whenever a newer one does, so its last row is the latest; an error once the
    watermark, `lateness` behind the newest message, has passed it. Rows later than that may be lost.

    The session's state store must be RocksDB (spark.sql.streaming.stateStore.providerClass).
    """
    told = told_apart(raw.withWatermark("ts", lateness), text)
    shape = "kind string, key string, ts timestamp, text string"
    kept = told.where("kind in ('script', 'error')").groupBy("kind", "key").transformWithStateInPandas(Console(window_seconds), shape, "Update", "EventTime")
    return kept.unionAll(told.where("kind not in ('script', 'error')"))


def last_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """The latest row of each key."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy(F.col(order).desc()))).where("__n = 1").drop("__n")
