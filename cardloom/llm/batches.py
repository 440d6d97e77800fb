"""Shared plumbing of the operators whose inner loop is Python: Arrow batches in, Arrow batches out."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

ROWS = 512  # rows of one result batch, so that a batch of long texts is never held twice


class Memo(dict):
    """A bounded memo of ``make``, in two generations: when the newer one is full it becomes the older one, which is dropped. What
    is asked for again moves to the newer one, so frequent keys stay; results never depend on it.

    Keys beyond ``longest`` are made anew each time."""

    def __init__(self, make: Callable, limit: int = 300_000, longest: int | None = None) -> None:
        self.make, self.limit, self.longest, self.older = make, limit, longest, {}

    def __missing__(self, key):
        if self.longest is not None and len(key) > self.longest:
            return self.make(key)
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit // 2:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


def texts_as_bytes(column: pa.Array) -> Iterator[bytes | None]:
    """UTF-8 bytes of a string column, one at a time."""
    for value in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()):
        yield value.as_py()


def row_map(make_rows: Callable[[pa.RecordBatch], Iterable[tuple]], schema: pa.Schema) -> Callable:
    """A ``mapInArrow`` function from one that yields result tuples for a batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for row in make_rows(batch):
                rows.append(row)
                if len(rows) >= ROWS:
                    yield to_batch(rows, schema)
                    rows = []
            if rows:
                yield to_batch(rows, schema)
    return run


def to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


def arrow_fields(df: DataFrame, columns: list[str]) -> list[pa.Field]:
    """Columns of a DataFrame as Arrow fields."""
    return [pa.field(c, to_arrow_type(df.schema[c].dataType)) for c in columns]


def ddl(df: DataFrame, columns: list[str]) -> str:
    """The same as a Spark schema string."""
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns)
