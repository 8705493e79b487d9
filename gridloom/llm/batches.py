"""Whole texts, a bounded number at a time."""

from __future__ import annotations

import weakref
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

ROWS = 256


class Memo(dict):
    """Results of a function of short strings; starts afresh once full, so its size is bounded."""

    live: list[weakref.ref] = []

    def __init__(self, make: Callable, limit: int, group: str, longest: int = 64) -> None:
        super().__init__()
        self.make, self.limit, self.group, self.longest = make, limit, group, longest
        Memo.live.append(weakref.ref(self))

    def __missing__(self, key):
        value = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.limit:
                self.clear()
            self[key] = value
        return value


class Recent:
    """Results for short strings, worked out for many at once; the older half is dropped when full, so what is in use
    stays."""

    def __init__(self, make: Callable[[list], Iterable], limit: int, group: str, longest: int = 64) -> None:
        self.make, self.limit, self.group, self.longest = make, limit, group, longest
        self.now: dict = {}
        self.before: dict = {}
        self.long: list = []
        Memo.live.append(weakref.ref(self))

    def clear(self) -> None:
        self.now, self.before, self.long = {}, {}, []

    def of(self, keys: set) -> dict:
        """A dictionary that holds the results of ``keys``, until the next call."""
        # Long strings are kept for one call.
        for key in self.long:
            del self.now[key]
        if len(self.now) > self.limit // 2:
            self.before, self.now = self.now, {}
        new = []
        for key in keys.difference(self.now):
            if (value := self.before.get(key)) is not None:
                self.now[key] = value
            else:
                new.append(key)
        self.now.update(zip(new, self.make(new)))
        self.long = [k for k in new if len(k) > self.longest]
        return self.now


def holding(group: str) -> None:
    """Drop what other operators remember: a Python worker serves one operator after another."""
    for memo in [x() for x in Memo.live]:
        if memo is not None and memo.group != group:
            memo.clear()


def slices(batches: Iterable[pa.RecordBatch]) -> Iterator[dict[str, list]]:
    """Columns of at most ``ROWS`` rows as Python lists."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            yield batch.slice(start, ROWS).to_pydict()


def map_texts(df: DataFrame, make: Callable[[], Callable[[list, list], dict[str, list]]], schema: str,
              key: str = "doc_id", text: str = "text") -> DataFrame:
    """Apply a function of keys and whole texts (null: empty) in tasks.

    ``make()`` is called once in each task and returns the function, which gives the columns of ``schema``.
    """

    def run(batches):
        call = make()
        for part in slices(batches):
            keys, texts = part["k"], [x or "" for x in part["t"]]
            yield pa.RecordBatch.from_pydict(call(keys, texts))

    columns = df.select(df[key].cast("long").alias("k"), df[text].cast("string").alias("t"))
    return columns.mapInArrow(typed(run, schema), schema)


def typed(run: Callable, schema: str) -> Callable:
    """Casts what ``run`` yields to the Arrow types of a Spark schema in DDL form."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    wanted = to_arrow_schema(StructType.fromDDL(schema))

    def cast(batches):
        for batch in run(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column(f.name).cast(f.type) for f in wanted], schema=wanted
            )

    return cast
