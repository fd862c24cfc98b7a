"""Aggregates that a user defines: create, add, merge, result.

Each task adds its rows to one accumulator per key, batch by batch, and sends accumulators;
those of a key meet after a shuffle and are merged. So a key that has most of the rows
sends one small row from each task. A task that meets more keys than it should hold hands over
what it has and starts anew, which changes nothing in the result.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Keys that a task holds accumulators of.
HELD = 50_000


class Aggregate(ABC):
    """What a user writes. An accumulator is a tuple with the fields of `state`."""

    state: str
    output: str

    @abstractmethod
    def create(self) -> tuple:
        """The accumulator of no rows."""

    @abstractmethod
    def add(self, accumulator: tuple, rows: pd.DataFrame) -> tuple:
        """The accumulator after some rows of its key."""

    @abstractmethod
    def merge(self, one: tuple, other: tuple) -> tuple:
        """The accumulator of both, in whatever order."""

    @abstractmethod
    def result(self, accumulator: tuple) -> tuple:
        """The values of `output`."""


def _fields(df: DataFrame, keys: list[str], ddl: str) -> T.StructType:
    own = {f.name: f for f in df.schema.fields}
    return T.StructType([*[own[k] for k in keys], *T.StructType.fromDDL(ddl).fields])


def _tables(held: dict, keys: list[str], values, schema: T.StructType) -> pd.DataFrame:
    rows = [(*key, *value) for key, value in zip(held, values)]
    return pd.DataFrame(rows, columns=schema.names, dtype=object)


def _grouped(rows: pd.DataFrame, keys: list[str]):
    """(key, rows), with None for a null key."""
    clean = rows[keys].astype(object).where(rows[keys].notna(), None)
    for key, part in rows.groupby([clean[k] for k in keys], dropna=False, sort=False):
        yield tuple(None if pd.isna(k) else k for k in (key if isinstance(key, tuple) else (key,))), part


def aggregate(df: DataFrame, keys: list[str], columns: list[str], user: Aggregate) -> DataFrame:
    """One row per key with the user's result over the given columns."""
    partial, final = _fields(df, keys, user.state), _fields(df, keys, user.output)
    state = partial.names[len(keys):]

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, tuple] = {}
        for rows in batches:
            for key, part in _grouped(rows, keys):
                held[key] = user.add(held.get(key) or user.create(), part[columns])
            if len(held) > HELD:
                yield _tables(held, keys, held.values(), partial)
                held = {}
        if held:
            yield _tables(held, keys, held.values(), partial)

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Sorted by key, so one key is held at a time.
        last, total = None, None
        def done():
            return _tables({last: total}, keys, [user.result(total)], final)
        for rows in batches:
            finished: dict[tuple, tuple] = {}
            for row in rows.itertuples(index=False, name=None):
                key = tuple(None if pd.isna(k) else k for k in row[:len(keys)])
                value = tuple(row[len(keys):])
                if last is not None and key == last:
                    total = user.merge(total, value)
                    continue
                if last is not None:
                    finished[last] = user.result(total)
                last, total = key, value
            if finished:
                yield _tables(finished, keys, finished.values(), final)
        if last is not None:
            yield done()

    partials = df.select(*dict.fromkeys([*keys, *columns])).mapInPandas(add, partial)
    return partials.repartition(*keys).sortWithinPartitions(*keys).select(*keys, *state).mapInPandas(merge, final)


class Count(Aggregate):
    """How many rows."""

    state, output = "n bigint", "n bigint"

    def create(self) -> tuple:
        return (0,)

    def add(self, accumulator: tuple, rows: pd.DataFrame) -> tuple:
        return (accumulator[0] + len(rows),)

    def merge(self, one: tuple, other: tuple) -> tuple:
        return (one[0] + other[0],)

    def result(self, accumulator: tuple) -> tuple:
        return accumulator


class Spread(Aggregate):
    """Number, mean and population variance of a column's values, by sums about a shifting
    mean, so that large values cost no precision."""

    state, output = "n bigint, mean double, m2 double", "n bigint, mean double, variance double"

    def create(self) -> tuple:
        return (0, 0.0, 0.0)

    def add(self, accumulator: tuple, rows: pd.DataFrame) -> tuple:
        values = rows.iloc[:, 0].dropna().astype(float)
        if values.empty:
            return accumulator
        mean = float(values.mean())
        return self.merge(accumulator, (len(values), mean, float(((values - mean) ** 2).sum())))

    def merge(self, one: tuple, other: tuple) -> tuple:
        n = one[0] + other[0]
        if not n:
            return one
        step = other[1] - one[1]
        return (n, one[1] + step * other[0] / n, one[2] + other[2] + step * step * one[0] * other[0] / n)

    def result(self, accumulator: tuple) -> tuple:
        n, mean, m2 = accumulator
        return (n, mean, m2 / n) if n else (0, None, None)
