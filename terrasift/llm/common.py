"""Shared helpers of the training-data operators: sizing, bounded broadcasts, Arrow plumbing."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most rows of a key table that is broadcast; beyond it the same join is a shuffle.
BROADCAST_ROWS = 500_000


def bounded(df: DataFrame) -> DataFrame:
    """A narrow table marked for broadcast where it has few rows by count, as it is otherwise. Its input should be at rest."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def unused(name: str, *tables: DataFrame) -> str:
    """The name, with underscores before it until no column of the tables is called so."""
    taken = {c.lower() for t in tables for c in t.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


#: What a Python worker keeps between tasks, by owner, and how to let it go.
_held: dict[str, Callable[[], None]] = {}


def hold(owner: str, release: Callable[[], None]) -> None:
    """Keep state in this worker until a task of another owner starts: workers serve one operator after the other."""
    _held[owner] = release


def tidy(cycles: bool = True) -> None:
    """Give freed memory back to the system; the executor's limit counts all its workers, idle ones too."""
    if cycles:
        gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def tidied(fn: Callable[..., pa.Table]) -> Callable[..., pa.Table]:
    """A function of a group's tables that tidies up behind itself."""
    if fn.__code__.co_argcount == 1:

        def one(table: pa.Table) -> pa.Table:
            out = fn(table)
            tidy(cycles=False)
            return out

        return one

    def two(left: pa.Table, right: pa.Table) -> pa.Table:
        out = fn(left, right)
        tidy(cycles=False)
        return out

    return two


def let_go(owner: str = "") -> None:
    """Called as a task starts: state of other owners goes."""
    others = [o for o in _held if o != owner]
    for o in others:
        _held.pop(o)()
    if others:
        tidy()


#: Rows of an Arrow batch that become Python objects at once.
ROWS_AT_ONCE = 1500


def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in smaller pieces; tidies up at the end of the task."""
    for batch in batches:
        for at in range(0, max(1, batch.num_rows), ROWS_AT_ONCE):
            yield batch.slice(at, ROWS_AT_ONCE)
        del batch
    tidy()


def map_rows(df: DataFrame, schema: str, make: Callable[[], Callable[[list[list]], Iterable[list]]], owner: str = "") -> DataFrame:
    """Row-wise Arrow map: ``make()`` runs once per task and returns a function from input columns to output columns."""
    from pyspark.sql.types import _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_schema

    out = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go(owner)
        fn = make()
        for batch in small(batches):
            columns = fn([c.to_pylist() for c in batch.columns])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, out.types, strict=True)], schema=out)

    return df.mapInArrow(run, schema)
