"""Dimensions and configuration that change while a stream runs.

Facts and changes are one tagged stream, shuffled by key; the state of a key is what its changes
have made of it so far. So a change counts from its micro-batch on, also in plans that
aggregate afterwards, and a restart goes on with the state it stopped with.

Changes are copied to every share of a key (a dimension row) or to every bucket (a
configuration row), and facts are dealt over the shares and buckets. So a key that a third of
all facts have is no burden to one task; what is copied are changes only.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions import scalars as S
from .state import millis

#: Shares of a dimension key, buckets of a log.
SHARES, BUCKETS = 8, 64

DELETE, DELETED = "delete", ""

CELLS = "columns array<string>, vals array<string>, ts array<bigint>, seq array<bigint>"


def share(df: DataFrame, n: int) -> Column:
    """A number below n by the row's content. Maps have no hash and are left out."""
    plain = [c for c, f in zip(df.columns, df.schema.fields) if not isinstance(f.dataType, T.MapType)]
    return F.pmod(F.xxhash64(*plain), F.lit(n)).cast("int")


def copies(n: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))


# --- dimensions -----------------------------------------------------------------------

class _Lookup(StatefulProcessor):
    """Adds columns of the key's dimension row to its facts.

    The row is held as its newest cells, with the newest deletion as the cell DELETED; a
    change that comes again, or after a newer one, has no effect. The changes of a
    micro-batch count for all its facts. A fact without a row waits for one, if it may."""

    def __init__(self, columns: list[str], wanted: list[str], time: str | None, wait_ms: int | None, waiting: str):
        self.columns, self.wanted, self.time = columns, wanted, time
        self.wait_ms, self.waiting_schema = wait_ms, waiting
        self.named = Row(*columns, *[f"_got_{c}" for c in wanted], *(["_at"] if wait_ms is not None else []))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.cells = handle.getValueState("cells", CELLS)
        if self.wait_ms is not None:
            self.waiting = handle.getListState("waiting", self.waiting_schema)

    def load(self) -> dict[str, tuple]:
        if not self.cells.exists():
            return {}
        return {c: (ts, seq, v) for c, v, ts, seq in zip(*self.cells.get())}

    def store(self, cells: dict[str, tuple]) -> None:
        names = list(cells)
        self.cells.update((names, [cells[c][2] for c in names], [cells[c][0] for c in names], [cells[c][1] for c in names]))

    def written(self, cells: dict[str, tuple], change: Row) -> bool:
        """Take a change in; whether it had an effect."""
        at, changed = (change["_ts"], change["_seq"]), False
        data = {DELETED: None} if change["_op"] == DELETE else dict(change["_data"] or ())
        for column, value in data.items():
            if (column == DELETED or value is not None and column in self.wanted) and (
                    column not in cells or cells[column][:2] < at):
                cells[column] = (*at, value)
                changed = True
        # A row exists by any change to it, also one of columns that nobody asked for.
        if change["_op"] != DELETE and ("exists" not in cells or cells["exists"][:2] < at):
            cells["exists"], changed = (*at, None), True
        return changed

    @staticmethod
    def values(cells: dict[str, tuple], wanted: list[str]) -> tuple | None:
        """The wanted columns of the row, or None if there is no row."""
        gone = cells.get(DELETED, (None,))[:2] if DELETED in cells else None
        alive = {c: x for c, x in cells.items() if c != DELETED and (gone is None or x[:2] > gone)}
        return tuple(alive[c][2] if c in alive else None for c in wanted) if "exists" in alive else None

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs() if self.time else None
        cells, facts, changed = self.load(), [], False
        for row in rows:
            if row["_op"] is not None:
                changed |= self.written(cells, row)
            elif watermark is None or row["_ms"] > watermark:
                facts.append(row)
        if changed:
            self.store(cells)
        values = self.values(cells, self.wanted)
        if self.wait_ms is None:
            for row in facts:
                yield self.row([row[c] for c in self.columns], values)
            return
        if values is None:
            for row in facts:
                self.waiting.appendValue((*[row[c] for c in self.columns], row["_ms"]))
                self.handle.registerTimer(row["_ms"] + self.wait_ms)
            return
        for row in facts:
            yield self.late([row[c] for c in self.columns], row["_ms"], values, watermark)
        if changed and self.waiting.exists():
            for held in self.waiting.get():
                yield self.late(list(held)[:-1], held[-1], values, watermark)
            self.waiting.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.waiting.exists():
            return
        due, watermark = expiredTimerInfo.getExpiryTimeInMs() - self.wait_ms, timerValues.getCurrentWatermarkInMs()
        stay = []
        for held in self.waiting.get():
            if held[-1] <= due:
                yield self.late(list(held)[:-1], held[-1], None, watermark)
            else:
                stay.append(tuple(held))
        if stay:
            self.waiting.put(stay)
        else:
            self.waiting.clear()

    def row(self, values: list, found: tuple | None, *more) -> Row:
        return self.named(*values, *(found or (None,) * len(self.wanted)), *more)

    def late(self, values: list, ms: int, found: tuple | None, watermark: int) -> Row:
        """A row that waited goes out at a time the watermark has not passed, and tells its own."""
        at = self.columns.index(self.time)
        own = values[at]
        values[at] = own + timedelta(milliseconds=max(0, watermark + 1 - ms))
        return self.row(values, found, own)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        cells = self.load()
        for c, v, ts, seq in zip(initialState["columns"], initialState["vals"], initialState["ts"], initialState["seq"]):
            if c == DELETED or c in self.wanted:
                cells[c] = (ts, seq, v)
            if c != DELETED and cells.get("exists", (-1, -1))[:2] < (ts, seq):
                cells["exists"] = (ts, seq, None)
        self.store(cells)

    def close(self) -> None:
        pass


def lookup(facts: DataFrame, changes: DataFrame, key: str, add: dict[str, str], time: str | None = None,
           wait: str | None = None, shares: int = SHARES, preload: DataFrame | None = None) -> DataFrame:
    """Facts with columns of their dimension row as it is when they come; null without a row.

    changes: a stream of row_key, op_type, data (a map), ts and seq, as routed dimension
    changes are. preload: the newest cells of the same table, as stored dimension tables hold
    them, which changes then overrule.

    With a time column the facts must be watermarked, and windows can follow. A fact without a
    row can then wait for one until the watermark has passed its time by `wait`; since it may be
    behind the watermark by then, it goes out at a later time, its own being in _at."""
    assert wait is None or time is not None
    added, columns = list(add), facts.columns
    wanted = list(dict.fromkeys(add.values()))
    spec = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in facts.schema.fields) + ", _ms bigint"
    tagged = facts.select(
        *columns, F.col(key).cast("string").alias("_key"), share(facts, shares).alias("_share"),
        (F.unix_millis(time) if time else F.lit(None)).cast("bigint").alias("_ms"), F.lit(None).cast("string").alias("_op"),
        F.lit(None).cast("map<string,string>").alias("_data"), F.lit(None).cast("bigint").alias("_ts"),
        F.lit(None).cast("bigint").alias("_seq"))
    only = F.map_filter("data", lambda k, v: k.isin(wanted) & v.isNotNull())
    news = changes.where("row_key is not null").select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in facts.schema.fields],
        F.col("row_key").alias("_key"), copies(shares).alias("_share"), F.lit(None).cast("bigint").alias("_ms"),
        F.col("op_type").alias("_op"), only.alias("_data"), F.col("ts").cast("bigint").alias("_ts"),
        F.col("seq").cast("bigint").alias("_seq"))
    out = T.StructType([*facts.schema.fields, *[T.StructField(f"_got_{c}", T.StringType()) for c in wanted]])
    if wait is not None:
        out = out.add("_at", facts.schema[time].dataType)
    processor = _Lookup(columns, wanted, time, millis(wait) if wait is not None else None, spec)
    initial = None
    if preload is not None:
        initial = (preload.groupBy(F.col("row_key").alias("_key"))
                   .agg(*[F.collect_list(F.struct("column", "value", "ts", "seq")).alias("c")])
                   .select("_key", copies(shares).alias("_share"), F.col("c.column").alias("columns"),
                           F.col("c.value").alias("vals"), F.col("c.ts").alias("ts"), F.col("c.seq").alias("seq"))
                   .groupBy("_key", "_share"))
    found = tagged.unionByName(news).groupBy("_key", "_share").transformWithState(
        processor, out, "append", "eventTime" if time else "none", initialState=initial,
        eventTimeColumnName=time or "")
    return found.select(*columns, *[F.col(f"_got_{add[c]}").alias(c) for c in added],
                        *(["_at"] if wait is not None else []))


def own_window(rows: DataFrame, size: str) -> DataFrame:
    """_start, the start of the window that the row's own time is in."""
    step = millis(size)
    return rows.withColumn("_start", F.timestamp_millis(F.floor(F.unix_millis("_at") / step) * step)).drop("_at")


def stamped(table: DataFrame, size: str, day_format: str = S.PARTITION_DATE) -> DataFrame:
    """A windowed table with bounds and day from _start. Rows that waited are rows of
    their own there, which add to the others of their window."""
    end = F.col("_start") + F.expr(f"interval {size}")
    return table.withColumns({"stt": F.date_format("_start", S.DATETIME), "edt": F.date_format(end, S.DATETIME),
                              "cur_date": F.date_format("_start", day_format)}).drop("_start")


# --- configuration --------------------------------------------------------------------

class _Rules(StatefulProcessor):
    """Adds the rule that is in effect to log rows; a row without one is left out."""

    def __init__(self, columns: list[str]):
        self.columns = columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rules = handle.getMapState("rules", "name string", "seq bigint, rule string")

    def rule(self, name: str) -> tuple | None:
        return tuple(self.rules.getValue((name,))) if self.rules.containsKey((name,)) else None

    def put(self, name: str, seq: int, rule: str | None) -> None:
        """A removed rule stays as a null one, so that an older change cannot bring it back."""
        held = self.rule(name)
        if held is None or held[0] < seq:
            self.rules.updateValue((name,), (seq, rule))

    def handleInitialState(self, key, initialState, timerValues) -> None:
        for name, rule in zip(initialState["names"], initialState["rules"]):
            self.put(name, -1, rule)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        log = []
        for row in rows:
            if row["_seq"] is not None:
                self.put(row["_name"], row["_seq"], row["_rule"])
            else:
                log.append(row)
        named = Row(*self.columns, "_rule")
        known: dict[str, str | None] = {}
        for row in log:
            name = row["_name"]
            if name not in known:
                held = self.rule(name)
                known[name] = held and held[1]
            if known[name] is not None:
                yield named(*[row[c] for c in self.columns], known[name])

    def close(self) -> None:
        pass


def configured(log: DataFrame, changes: DataFrame, on: dict[str, str], preload: DataFrame | None = None,
               buckets: int = BUCKETS) -> DataFrame:
    """Log rows with the columns of the configuration row in effect for them.

    changes: a stream of op, seq and configuration columns; `on` gives the log's column for
    each configuration column that is part of the key. Every change and the preloaded rows
    reach each bucket of the log; what changes say overrules what was preloaded. A
    configuration has one row for each table or table and type, which bounds the copies."""
    fields = [f for f in changes.schema.fields if f.name not in ("op", "seq")]
    rule = F.to_json(F.struct(*[f.name for f in fields]))
    def name(columns):
        return F.to_json(F.struct(*[F.col(c).cast("string").alias(f"k{i}") for i, c in enumerate(columns)]))
    none = F.lit(None)
    tagged = log.select("*", share(log, buckets).alias("_bucket"), name(on.values()).alias("_name"),
                        none.cast("bigint").alias("_seq"), none.cast("string").alias("_rule"))
    news = changes.select(
        *[none.cast(f.dataType).alias(f.name) for f in log.schema.fields], copies(buckets).alias("_bucket"),
        name(on).alias("_name"), F.col("seq").cast("bigint").alias("_seq"),
        F.when(F.col("op") != "d", rule).alias("_rule"))
    initial = None
    if preload is not None:
        rows = preload.select(F.struct(name(on).alias("name"), rule.alias("rule")).alias("r"))
        initial = (rows.agg(F.collect_list("r").alias("r"))
                   .select(copies(buckets).alias("_bucket"), F.col("r.name").alias("names"), F.col("r.rule").alias("rules"))
                   .groupBy("_bucket"))
    out = T.StructType([*log.schema.fields, T.StructField("_rule", T.StringType())])
    found = tagged.unionByName(news).groupBy("_bucket").transformWithState(
        _Rules(log.columns), out, "append", "none", initialState=initial)
    rules = F.from_json("_rule", T.StructType(fields))
    return found.withColumn("_rule", rules).select(*log.columns, "_rule.*")


# --- left joins that do not wait ---------------------------------------------------------

class _EarlyLeft(StatefulProcessor):
    """Passes left rows at once with what is known of the right sides, and again when more is."""

    def __init__(self, columns: list[str], sides: list[list[str]], left: str, right: str, ttl_ms: int | None):
        self.columns, self.sides, self.left, self.right, self.ttl_ms = columns, sides, left, right, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rows = handle.getListState("left", self.left, self.ttl_ms)
        self.known = [handle.getValueState(f"right{i}", self.right, self.ttl_ms) for i in range(len(self.sides))]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        fresh, told = [], set()
        for row in rows:
            side = row["_side"]
            if side < 0:
                fresh.append(tuple(row[c] for c in self.columns))
            else:
                self.known[side].update(([row[c] for c in self.sides[side]],))
                told.add(side)
        found, version = [], 0
        for names, held in zip(self.sides, self.known):
            there = held.exists()
            version += there
            found += held.get()[0] if there else [None] * len(names)
        named = Row(*self.columns, *[c for names in self.sides for c in names], "_version")
        if told and self.rows.exists():
            for old in self.rows.get():
                yield named(*old, *found, version)
        for values in fresh:
            yield named(*values, *found, version)
        if fresh:
            self.rows.appendList(fresh)

    def close(self) -> None:
        pass


def early_left(left: DataFrame, key: str, sides: list[tuple[DataFrame, str]], ttl: str | None) -> DataFrame:
    """Left rows with the columns of the right rows of the same key, at once and, when a right row
    comes later, once more. _version, the number of sides that are known, orders the
    rows of one left row; a table that keeps the last is the left join. Both sides are
    forgotten a TTL of processing time after they were written.

    sides: (rows, key column); their other columns are strings. A key has few rows: of several
    right rows of a side the newest counts."""
    names = [[c for c in rows.columns if c != on] for rows, on in sides]
    every = [c for part in names for c in part]
    none = F.lit(None)
    tagged = left.select("*", F.col(key).alias("_key"), F.lit(-1).alias("_side"),
                         *[none.cast("string").alias(c) for c in every])
    for i, (rows, on) in enumerate(sides):
        tagged = tagged.unionByName(rows.select(
            *[none.cast(f.dataType).alias(f.name) for f in left.schema.fields], F.col(on).alias("_key"), F.lit(i).alias("_side"),
            *[(F.col(c) if c in names[i] else none).cast("string").alias(c) for c in every]))
    spec = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in left.schema.fields)
    out = T.StructType([*left.schema.fields, *[T.StructField(c, T.StringType()) for c in every],
                        T.StructField("_version", T.IntegerType())])
    return tagged.where("_key is not null").groupBy("_key").transformWithState(
        _EarlyLeft(left.columns, names, spec, "vals array<string>", millis(ttl) if ttl else None), out, "append",
        "processingTime" if ttl else "none")
