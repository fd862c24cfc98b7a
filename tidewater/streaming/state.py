"""Keyed state in streaming form.

Micro-batches are taken as they come; inside one, a key's rows are taken in event-time
order and not as a shuffle happened to deliver them. So on input whose micro-batches
follow each other in event time the results are those of the batch forms, however many
files and tasks a micro-batch has. Where only a first row counts, the rows stream through
and the smallest is kept; a day flag keeps one row per new day.

A row that is left out because the watermark has passed it comes out marked and is counted
before it goes (streaming.monitor reads the counts).
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date, timedelta

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


def millis(ttl: str) -> int:
    """Length in milliseconds of a text like '60 seconds'."""
    count, unit = ttl.split()
    per = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]
    return int(count) * per * 1000


def _rank(row: Row, order: list[str]) -> tuple:
    """What rows are ordered by; nulls come first."""
    return tuple((row[c] is not None, row[c]) for c in order)


LATE = "_late"


def _with_late(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(LATE, T.BooleanType())])


def _late(named: Row, values: list, at: int, ms: int, watermark: int, *more) -> Row:
    """A row that is too late, at a time that may still come out, marked."""
    values[at] = values[at] + timedelta(milliseconds=watermark + 1 - ms)
    return named(*values, *more, True)


def without_late(df: DataFrame, name: str) -> DataFrame:
    """The rows that are not late, the others counted under the name."""
    counted = df.observe(name, F.count_if(LATE).alias("late"))
    return counted.where(~F.col(LATE)).drop(LATE)


class _DayFlag(StatefulProcessor):
    """Passes the first row of each new day of a key, with the day before it.

    A row behind the watermark is left out here, as it would be by a window.
    """

    def __init__(self, columns: list[str], order: list[str], time: str):
        self.columns, self.order, self.time = columns, order, columns.index(time)
        self.named = Row(*columns, "_prev_day", LATE)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last_day", "day date")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        stored = self.last.get()[0] if self.last.exists() else None
        watermark = timerValues.getCurrentWatermarkInMs()
        days = {}  # of this batch only, the first row of each
        for row in rows:
            day, rank = row["_day"], _rank(row, self.order)
            if row["_ms"] <= watermark:
                yield _late(self.named, [row[c] for c in self.columns], self.time, row["_ms"], watermark, None)
            elif day != stored and (day not in days or rank < days[day][0]):
                days[day] = rank, row
        newest = stored
        for day in sorted(days):
            yield self.named(*[days[day][1][c] for c in self.columns], newest, False)
            newest = day if newest is None else max(newest, day)
        if newest != stored:
            self.last.update((newest,))

    def close(self) -> None:
        pass


def day_visits(df: DataFrame, keys: list[str], order: list[str] = [],
               time: str = "et") -> DataFrame:
    """First row of each key and day, with the key's previous day, null for none."""
    daily = df.withColumn("_day", F.to_date(time))
    schema = _with_late(T.StructType([*daily.schema.fields, T.StructField("_prev_day", T.DateType())]))
    flagged = daily.withColumn("_ms", F.unix_millis(time)).groupBy(*keys).transformWithState(
        _DayFlag(daily.columns, ["_ms", *order], time), schema, "append", "eventTime", eventTimeColumnName=time)
    return without_late(flagged, f"late_day_of_{'_'.join(keys)}")


def first_of_day(df: DataFrame, keys: list[str], order: list[str] = [],
                 time: str = "et") -> DataFrame:
    """First row of each key and day."""
    return day_visits(df, keys, order, time).drop("_day", "_prev_day")


class _Expiring(StatefulProcessor):
    """One value per key that is forgotten a TTL after it was written, or never.

    By the event clock the value goes when the watermark has passed its time plus the
    TTL. That can be replayed, and windows can follow in the same query. By the
    processing clock Spark drops it a TTL after the write; windows over the result
    then have to be a query of their own, since no watermark passes such an operator.
    """

    def __init__(self, name: str, schema: str, ttl_ms: int | None, clock: str):
        self.name, self.schema, self.ttl_ms, self.clock = name, schema, ttl_ms, clock

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        by_wall = self.clock == "processing"
        self.value = handle.getValueState(self.name, f"{self.schema}, _ms bigint, _timer bigint",
                                          self.ttl_ms if by_wall else None)

    def watermark(self, timerValues) -> int:
        """Rows at or before this are late. By the processing clock none is."""
        return timerValues.getCurrentWatermarkInMs() if self.clock == "event" else -1

    def load(self) -> tuple | None:
        """The value, its time last but one, its timer last."""
        return tuple(self.value.get()) if self.value.exists() else None

    def expired(self, value: tuple, now_ms: int) -> bool:
        return self.clock == "event" and self.ttl_ms is not None and now_ms > value[-2] + self.ttl_ms

    def store(self, old: tuple | None, new: tuple, ms: int, watermark: int) -> None:
        timer = None
        if self.clock == "event" and self.ttl_ms is not None:
            timer = max(ms + self.ttl_ms, watermark + 1)
            if old is not None and old[-1] != timer:
                self.handle.deleteTimer(old[-1])
            self.handle.registerTimer(timer)
        self.value.update((*new, ms, timer))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.value.clear()
        yield from ()

    def close(self) -> None:
        pass


def _by_clock(df: DataFrame, key: str, processor: _Expiring, out: T.StructType,
              time: str) -> DataFrame:
    """Run a processor by its clock. The result keeps its watermark by the event clock."""
    by_event = processor.clock == "event"
    assert by_event or processor.clock == "processing"
    rows = df.withColumn("_ms", F.unix_millis(time)).groupBy(key).transformWithState(
        processor, _with_late(out), "append", "eventTime" if by_event else "processingTime",
        eventTimeColumnName=time if by_event else "")
    return without_late(rows, f"late_{processor.name}_of_{key}")


class _FirstSeen(_Expiring):
    """Passes a key's first row, and again the first after it was forgotten."""

    def __init__(self, columns: list[str], order: list[str], ttl_ms: int | None, clock: str, time: str):
        super().__init__("first", "seen boolean", ttl_ms, clock)
        self.columns, self.order, self.time = columns, order, columns.index(time)
        self.named = Row(*columns, LATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        old = value = self.load()
        watermark = self.watermark(timerValues)
        fresh = []
        for row in rows:
            if row["_ms"] <= watermark:
                yield _late(self.named, [row[c] for c in self.columns], self.time, row["_ms"], watermark)
            elif old is None or self.expired(old, row["_ms"]):
                fresh.append(row)
                if self.ttl_ms is None:  # nothing comes after the first: one row is held
                    fresh = [min(fresh, key=lambda row: _rank(row, self.order))]
        for row in sorted(fresh, key=lambda row: _rank(row, self.order)):
            if value is None or self.expired(value, row["_ms"]):
                value = (True, row["_ms"], None)
                yield self.named(*[row[c] for c in self.columns], False)
        if value is not None and value is not old:
            self.store(old, value[:-2], value[-2], watermark)


def first_of_session(df: DataFrame, key: str, ttl: str | None, order: list[str] = [],
                     time: str = "et", clock: str = "event") -> DataFrame:
    """First row of each session id, a session being forgotten a TTL after it began, or
    never."""
    processor = _FirstSeen(df.columns, ["_ms", *order], millis(ttl) if ttl else None, clock, time)
    return _by_clock(df, key, processor, df.schema, time)


class _FirstSeenOfMany(StatefulProcessor):
    """Like _FirstSeen by the event clock, for all keys of a bucket: the times of the keys are a
    map, of which a micro-batch reads and writes the keys it has. New keys are also appended to
    a queue, which a timer goes through, about once in a TTL, to remove what the watermark has
    left a TTL behind."""

    def __init__(self, columns: list[str], order: list[str], ttl_ms: int, time: str):
        self.columns, self.order, self.ttl_ms, self.time = columns, order, ttl_ms, columns.index(time)
        self.named = Row(*columns, LATE)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getMapState("seen", "key string", "ms bigint")
        self.queue = handle.getListState("queue", "key string, ms bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        by_key: dict[str, list] = {}
        for row in rows:
            if row["_ms"] > watermark:
                by_key.setdefault(row["_key"], []).append(row)
            else:
                yield _late(self.named, [row[c] for c in self.columns], self.time, row["_ms"], watermark)
        known, fresh = self.seen.exists(), []
        for name, mine in by_key.items():
            stored = self.seen.getValue((name,)) if known else None
            last = first = None if stored is None else stored[0]
            for row in sorted(mine, key=lambda row: _rank(row, self.order)) if len(mine) > 1 else mine:
                if last is None or row["_ms"] > last + self.ttl_ms:
                    last = row["_ms"]
                    yield self.named(*[row[c] for c in self.columns], False)
            if last != first:
                self.seen.updateValue((name,), (last,))
                fresh.append((name, last))
        if fresh:
            self.queue.appendList(fresh)
            if not known:
                self.due(fresh, watermark)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        watermark, stay = timerValues.getCurrentWatermarkInMs(), []
        for name, ms in self.queue.get() if self.queue.exists() else ():
            if ms + self.ttl_ms >= watermark:
                stay.append((name, ms))
            else:
                held = self.seen.getValue((name,))
                if held is not None and held[0] == ms:  # not seen again since
                    self.seen.removeKey((name,))
        if stay:
            self.queue.put(stay)
            self.due(stay, watermark)
        else:
            self.queue.clear()
        yield from ()

    def due(self, held: list[tuple], watermark: int) -> None:
        """A bucket that holds keys has one timer, at the end of the TTL's length of time in
        which the first of them is to go."""
        first = min(ms for _, ms in held) + self.ttl_ms
        self.handle.registerTimer(max((first // self.ttl_ms + 1) * self.ttl_ms, watermark + 1))

    def close(self) -> None:
        pass


# Groups that the keys of first_of_keys are dealt over.
BUCKETS = 512


def first_of_keys(df: DataFrame, keys: list[str], ttl: str, order: list[str],
                  time: str = "et", buckets: int = BUCKETS) -> DataFrame:
    """First row of each key, a key being forgotten a TTL after it. For short-lived keys in
    large numbers, where a group for each would cost more than all else."""
    key = F.to_json(F.struct(*keys))
    keyed = (df.withColumn("_key", key).withColumn("_ms", F.unix_millis(time))
             .withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets))))
    found = keyed.groupBy("_bucket").transformWithState(
        _FirstSeenOfMany(df.columns, ["_ms", *order], millis(ttl), time), _with_late(df.schema), "append",
        "eventTime", eventTimeColumnName=time)
    return without_late(found, f"late_first_of_{'_'.join(keys)}")


class _VisitorRepair(StatefulProcessor):
    """Adds the visitor's stored first day to each record."""

    def __init__(self, columns: list[str], order: list[str]):
        self.columns, self.order = columns, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.first = handle.getValueState("first_day", "day date")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        named = Row(*self.columns, "_stored")
        stored = self.first.get()[0] if self.first.exists() else None
        if stored is None:  # only in a visitor's first batch are its rows held
            rows = list(rows)
            first = min(rows, key=lambda row: _rank(row, self.order))
            today: date = first["_today"]
            stored = today if first["common"]["is_new"] == "1" else today - timedelta(days=1)
            self.first.update((stored,))
        for row in rows:
            yield named(*[row[c] for c in self.columns], stored)

    def close(self) -> None:
        pass


def repair_new_visitor(log: DataFrame, order: list[str] = ["ts", "seq"]) -> DataFrame:
    """common.is_new corrected by the visitor's first day. A known visitor's records
    stream through; only the first day is kept."""
    from ..operators.state import repaired_common
    keyed = (log.withColumn("_mid", F.col("common.mid"))
             .withColumn("_today", F.to_date(F.timestamp_millis("ts"))))
    schema = T.StructType([*log.schema.fields, T.StructField("_stored", T.DateType())])
    repaired = keyed.groupBy("_mid").transformWithState(
        _VisitorRepair(log.columns, order), schema, "append", "none")
    return repaired.withColumn("common", repaired_common()).drop("_stored")


class _Delta(_Expiring):
    """Turns repeated rows of a key into corrections on the row before."""

    def __init__(self, amounts: list[str], carry: list[str], order: list[str], schema: str,
                 ttl_ms: int, clock: str):
        super().__init__("last", schema, ttl_ms, clock)
        self.amounts, self.carry, self.order = amounts, carry, order

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        named = Row(*self.amounts, *self.carry, LATE)
        watermark = self.watermark(timerValues)
        old = prev = self.load()
        at = len(self.amounts)  # the carried time comes first
        n, width = len(self.amounts), len(self.amounts) + len(self.carry)
        for row in sorted(rows, key=lambda row: _rank(row, self.order)):
            current = (*[row[a] for a in self.amounts], *[row[c] for c in self.carry],
                       row["_ms"], None)
            # A row goes to the window of the carried time. Behind the watermark that
            # window is closed and the row is dropped; the state moves on all the same.
            if prev is None or self.expired(prev, row["_ms"]):
                out, ms = list(current[:width]), current[-2]
            else:
                out, ms = [*[c - p for c, p in zip(current[:n], prev[:n])], *prev[n:width]], prev[-2]
            yield named(*out, False) if ms > watermark else _late(named, out, at, ms, watermark)
            prev = current
        if prev is not None and prev is not old:
            self.store(old, prev[:width], prev[-2], watermark)


def delta_correct(df: DataFrame, key: str, amounts: list[str], ttl: str, time: str = "et",
                  clock: str = "event") -> DataFrame:
    """The delta correction on a stream. The row before is forgotten a TTL after it
    was last written."""
    carry = [time, "sku_id"]
    fields = {f.name: f for f in df.schema.fields}
    wide = {a: T.DecimalType(fields[a].dataType.precision + 1, fields[a].dataType.scale)
            for a in amounts}
    out = T.StructType([*[T.StructField(a, wide[a]) for a in amounts],
                        *[fields[c] for c in carry]])
    state = ", ".join(f"{c} {fields[c].dataType.simpleString()}" for c in (*amounts, *carry))
    processor = _Delta(amounts, carry, [*carry, *amounts], state, millis(ttl), clock)
    return _by_clock(df, key, processor, out, time)
