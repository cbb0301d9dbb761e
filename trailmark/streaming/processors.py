"""State of streams: rolling counts; and typed, presence, visits and idle users, with a state of its own for each key and event-time timers.

What a processor gives when time has passed a point does not depend on how rows fell into batches, as long as they come within
the watermark. Rolling counts come out as the steps of each id, which Spark's own windows make, and are added up by `totals`.

State lives in RocksDB; `flows.run_to_end` sets the provider where a stream asks for it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

LATE = "10 minutes"
GAP_MS = 600_000
DAY_MS, ZONE_MS = 86_400_000, 28_800_000


def frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])


def aligned(time: Column, step_ms: int) -> Column:
    """The end of the step that holds a time: times after an end belong to the next one."""
    return (F.ceil(time / step_ms) * step_ms).cast("long")


class Timed(StatefulProcessor):
    """A processor that is called when event time has passed points of its keys: rows up to a point in milliseconds have then all come."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle

    def call_after(self, *points: int) -> None:
        for p in points:
            self.handle.registerTimer(p + 1)

    def passed(self, key: tuple, point: int, watermark: int) -> list[tuple]:
        """The rows to give when a point has passed."""
        raise NotImplementedError

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        out = self.passed(key, expiredTimerInfo.getExpiryTimeInMs() - 1, timerValues.getCurrentWatermarkInMs())
        if out:
            yield frame(out, self.schema)

    def close(self) -> None:
        pass


# --- X1, X9: rolling counts --------------------------------------------------------------------------------------------


def stepped(events: DataFrame, step_ms: int, late: str) -> DataFrame:
    """events with their step as a window w. A time at the end of a step belongs to it, so windows are of times less a millisecond."""
    at = events.withColumn("_at", F.timestamp_millis(F.col("time") - 1)).withWatermark("_at", late)
    return at.withColumn("w", F.window("_at", f"{step_ms} milliseconds"))


def rolling(events: DataFrame, key: str, ids: dict[str, str], size_ms: int, step_ms: int, counted: Column | None = None, late: str = LATE) -> DataFrame:
    """Steps (key, kind, id, end, n, size_ms) of the rows of each id of each key, by kind of id (kind: column), when they have passed.

    counted tells which rows n counts, all if it is None. Rows of a step count from its end on, for size_ms; `totals` adds up what
    steps have come by then. An id of a step is a row of state of its own, so a hot key is in no one place.
    """
    n = F.lit(1) if counted is None else counted.cast("int")
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).cast("string").alias("id")) for k, c in ids.items()])
    rows = stepped(events, step_ms, late).select("w", F.col(key).cast("string").alias("key"), n.cast("long").alias("n"), F.inline(kinds))
    steps = rows.groupBy("w", "key", "kind", "id").agg(F.sum("n").alias("n"))
    return steps.select("key", "kind", "id", F.unix_millis("w.end").alias("end"), "n", F.lit(size_ms).cast("long").alias("size_ms"))


def totals(steps: DataFrame, kinds: list[str]) -> DataFrame:
    """(key, end, n, each kind): rolling totals at each end at which rows come or go, from all steps that a stream gave.

    An id counts once while any step of the window has it: it comes with a step if its step before is out of the window, and goes
    size_ms after a step if its next one is later still.
    """
    from pyspark.sql import Window as W

    w = W.partitionBy("key", "kind", "id").orderBy("end")
    known = F.col("id").isNotNull()
    comes = known & F.coalesce(F.col("end") - F.lag("end").over(w) > F.col("size_ms"), F.lit(True))
    goes = known & F.coalesce(F.lead("end").over(w) - F.col("end") > F.col("size_ms"), F.lit(True))
    both = steps.where("key is not null").withColumns({"comes": comes.cast("long"), "goes": goes.cast("long")})
    change = lambda end, n, ids: F.struct(end.alias("end"), n.alias("n"), ids.alias("ids"))
    both = both.select("key", "kind", F.inline(F.array(change(F.col("end"), F.col("n"), F.col("comes")), change(F.col("end") + F.col("size_ms"), -F.col("n"), -F.col("goes")))))
    rows = F.coalesce(F.sum(F.when(F.col("kind") == kinds[0], F.col("n"))), F.lit(0)).alias("n")
    each = both.groupBy("key", "end").agg(rows, *[F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("ids"))), F.lit(0)).alias(k) for k in kinds])
    upto = W.partitionBy("key").orderBy("end")
    return each.select("key", "end", *[F.sum(c).over(upto).alias(c) for c in ["n", *kinds]])


# --- X9: who is there --------------------------------------------------------------------------------------------------

PRESENCE = "venue string, mac string, end long, entered int, time long"


class Presence(Timed):
    """A device enters a venue at the end of the first step with a reading of it and leaves at the end of the first step without one.

    entered is 1 or -1; time is the earliest reading of the step it entered with, or that step again when it leaves. A device has one
    timer, for its next point; when it is called, all points that have passed are gone through at once.
    """

    schema = PRESENCE

    def __init__(self, step_ms: int):
        self.step_ms = step_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.waiting = handle.getListState("waiting", "end long, first long")
        self.stay = handle.getValueState("stay", "since long, last long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        steps: dict[int, int] = dict(self.waiting.get()) if self.waiting.exists() else {}
        for b in rows:
            for end, t in zip(b["end"].tolist(), b["time"].tolist(), strict=True):
                steps[end] = min(t, steps.get(end, t))
        self.waiting.put(sorted(steps.items()))
        self.call_after(min(steps))
        return iter(())

    def passed(self, key: tuple, point: int, watermark: int) -> list[tuple]:
        steps = sorted(self.waiting.get()) if self.waiting.exists() else []
        was = self.stay.get() if self.stay.exists() else None
        now, out = was, []
        for end, first in (x for x in steps if x[0] < watermark):
            if now and end - now[1] > self.step_ms:
                out.append((*key, now[1] + self.step_ms, -1, now[0]))
                now = None
            if not now:
                out.append((*key, end, 1, first))
            now = (now[0] if now else first, end)
        if now and now[1] + self.step_ms < watermark:
            out.append((*key, now[1] + self.step_ms, -1, now[0]))
            now = None
        left = [x for x in steps if x[0] >= watermark]
        if len(left) < len(steps):
            self.waiting.clear()
            if left:
                self.waiting.put(left)
        if now:
            self.stay.update(now)
        elif was:
            self.stay.clear()
        if left or now:
            self.call_after(min([x[0] for x in left[:1]] + ([now[1] + self.step_ms] if now else [])))
        return out


def presence(readings: DataFrame, step_ms: int, late: str = LATE) -> DataFrame:
    """Devices that enter and leave venues, a key of state for each (venue, mac)."""
    rows = readings.withWatermark("ts", late).select("ts", F.col("venue").cast("string").alias("venue"), "mac", "time", aligned(F.col("time"), step_ms).alias("end"))
    return rows.groupBy("venue", "mac").transformWithStateInPandas(Presence(step_ms), PRESENCE, "append", "eventTime")


def online(changes: DataFrame) -> DataFrame:
    """(venue, end, entered, left, online) at each end at which a device entered or left."""
    from pyspark.sql import Window as W

    each = changes.where("venue is not null").groupBy("venue", "end").agg(F.sum(F.when(F.col("entered") > 0, 1).otherwise(0)).alias("entered"), F.sum(F.when(F.col("entered") < 0, 1).otherwise(0)).alias("left"))
    return each.withColumn("online", F.sum(F.col("entered") - F.col("left")).over(W.partitionBy("venue").orderBy("end")))


# --- X3, X4: visits ----------------------------------------------------------------------------------------------------

VISITS = "appid string, uuid string, visit long, start long, end long, pages long, stay long, changed boolean"


class Visits(Timed):
    """Visits of one user of an app, with the stays of their pages, while they go on.

    A row more than GAP_MS after the visit's last page, or its first row, opens a visit. Where pages are timed when they open, a
    page gives the page before it its stay. Where they are timed when they close, a page begins at the end of the page before it,
    the first one at the last foreground row or its own time, and stays until its own time. Each batch gives the visits it
    changed; when event time is GAP_MS past the last row, the last visit comes with changed = false and the state goes.
    """

    schema = VISITS

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.visit = handle.getValueState("visit", "n long, start long, end long, pages long, stay long, page long, front long, last long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        n, start, end, pages, stay, page, front, last = self.visit.get() if self.visit.exists() else (0, 0, 0, 0, 0, -1, -1, 0)
        out = []
        for t, _, kind, closes in sorted((t, e, k, c) for b in rows for t, e, k, c in zip(b["time"].tolist(), b["event_id"].tolist(), b["logtype"].tolist(), b["closes"].tolist(), strict=True)):
            if n == 0 or t - end > GAP_MS:
                if n:
                    out.append((*key, n, start, end, pages, stay, True))
                n, start, end, pages, stay, page, front = n + 1, t, t, 0, 0, -1, -1
            if kind == "50":
                if closes:
                    began = page if page >= 0 else front if front >= 0 else t
                    stay += t - began
                elif page >= 0:
                    stay += t - page
                pages, page, end = pages + 1, t, t
            elif kind == "10":
                front = t
            last = max(last, t)
        out.append((*key, n, start, end, pages, stay, True))
        self.visit.update((n, start, end, pages, stay, page, front, last))
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        self.call_after(max(timerValues.getCurrentWatermarkInMs(), last + GAP_MS))
        yield frame(out, VISITS)

    def passed(self, key: tuple, point: int, watermark: int) -> list[tuple]:
        n, start, end, pages, stay, *_ = self.visit.get()
        self.visit.clear()
        return [(*key, n, start, end, pages, stay, False)]


def visits(events: DataFrame, closes: Column, late: str = LATE) -> DataFrame:
    """Changed visits of each app and user; closes: true for rows of apps that time pages when they close. Rows of logtype 10 are foreground ones."""
    rows = events.withWatermark("ts", late).select("ts", "appid", "uuid", "time", "event_id", "logtype", closes.alias("closes"))
    return rows.groupBy("appid", "uuid").transformWithStateInPandas(Visits(), VISITS, "append", "eventTime")


# --- X10: idle users ---------------------------------------------------------------------------------------------------

IDLE = "uuid string, appid string, day long, pages long, stay long, last_time long"


class Idle(Timed):
    """One push row a day for a user on its first day who has been idle for GAP_MS, within the hours, without a lead and not pushed yet.

    Rows wait in the state until the watermark has passed them, so they count in order of time. When a user is idle, what it did is
    forgotten, but not that it was pushed; that goes when its first day is over.
    """

    schema = IDLE

    def __init__(self, hours: tuple[int, int]):
        self.hours = hours

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.waiting = handle.getListState("waiting", "time long, event_id long, page int, lead int")
        self.done = handle.getValueState("done", "first long, last long, pages long, lead int, pushed int, over long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = [x for b in rows for x in zip(b["time"].tolist(), b["event_id"].tolist(), b["page"].tolist(), b["lead"].tolist(), strict=True)]
        self.waiting.appendList(new)
        over = (new[0][0] + ZONE_MS) // DAY_MS * DAY_MS + DAY_MS - ZONE_MS + GAP_MS
        if not self.done.exists():
            self.done.update((-1, -1, 0, 0, 0, over))
        self.call_after(over, *{p for x in new for p in (x[0], x[0] + GAP_MS)})
        return iter(())

    def passed(self, key: tuple, point: int, watermark: int) -> list[tuple]:
        if not self.done.exists():
            return []
        first, last, pages, lead, pushed, over = self.done.get()
        waiting = sorted(self.waiting.get()) if self.waiting.exists() else []
        out = []
        if last >= 0 and point - last >= GAP_MS:  # idle before what comes at this very point
            if not lead and not pushed and self.hours[0] <= (last + GAP_MS + ZONE_MS) % DAY_MS // 3_600_000 <= self.hours[1]:
                pushed = 1
                out.append((*key, (last + ZONE_MS) // DAY_MS + 1, pages, last - first, last))
            first, last, pages, lead = -1, -1, 0, 0
        for t, _, page, is_lead in (x for x in waiting if x[0] <= point):
            first, last, pages, lead = first if first >= 0 else t, t, pages + page, max(lead, is_lead)
        waiting = [x for x in waiting if x[0] > point]
        self.waiting.clear()
        if waiting:
            self.waiting.put(waiting)
        if point >= over:
            self.done.clear()
        else:
            self.done.update((first, last, pages, lead, pushed, over))
        return out


def idle(events: DataFrame, first_seen: DataFrame, lead: Column, hours: tuple[int, int] = (8, 20), late: str = LATE) -> DataFrame:
    """Push rows (uuid, appid, day, pages, stay, last_time); first_seen: appid, uuid, first_time of every user, kept by the batch side."""
    day = lambda c: F.floor((F.col(c) + ZONE_MS) / DAY_MS)
    rows = events.withWatermark("ts", late).join(first_seen.select("appid", "uuid", "first_time"), ["appid", "uuid"]).where(day("time") == day("first_time"))
    rows = rows.select("ts", "uuid", "appid", "time", "event_id", (F.col("logtype") == "50").cast("int").alias("page"), F.coalesce(lead, F.lit(False)).cast("int").alias("lead"))
    return rows.groupBy("uuid", "appid").transformWithStateInPandas(Idle(hours), IDLE, "append", "eventTime")
