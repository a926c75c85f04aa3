"""Helpers for Arrow batch operators: bounded slices of a batch, and adding columns to it."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Hashable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Bytes of text that one slice holds at most, unless a single row is longer.
SLICE_BYTES = 1_000_000

#: Of the C library, where it has it.
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None

#: What this Python worker keeps between tasks, at most one thing: see ``held``.
_HELD: dict[Hashable, object] = {}


def held(key: Hashable, make: Callable[[], object]):
    """What ``make`` made for ``key`` in this worker, kept for later tasks of the same operator; anything else is let go.

    Workers outlive queries, so without this the vocabularies and caches of all operators would add up.
    """
    release(key)
    if key not in _HELD:
        _HELD[key] = make()
        trim()
    return _HELD[key]


def release(but: Hashable = None) -> None:
    """Let go of what earlier operators kept in this worker."""
    if any(k != but for k in _HELD):
        for k in [k for k in _HELD if k != but]:
            del _HELD[k]
        trim()


def trim() -> None:
    """Give memory that isn't used back to the system: workers live on after a task, and there are several on a machine."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def slices(batches: Iterable[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the named string or binary column has at most ``most`` bytes in each part."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        start = held = 0
        for i, size in enumerate(sizes):
            if i > start and held + size > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(size)
        if start < batch.num_rows:
            yield batch.slice(start)


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """The column as Python strings; null counts as empty."""
    return [x if x is not None else "" for x in batch.column(column).to_pylist()]


def map_slices(
    df: DataFrame,
    columns: list[str],
    text: str,
    fields: list[T.StructField],
    make: Callable[[], Callable[[pa.RecordBatch], list]],
    most: int = SLICE_BYTES,
    keeps: Hashable = None,
) -> DataFrame:
    """Keep ``columns`` of ``df`` (without the text unless listed) and add one value per row for each field.

    ``make`` runs once in each task and returns the function from a slice to the lists of new values; it may use
    what the worker has ``held`` for ``keeps``.
    Only ``columns`` and ``text`` go to Python. New fields take names that ``columns`` may not have.
    """
    kept = [df.schema[c] for c in columns]
    schema = T.StructType(kept + fields)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release(keeps)
        apply = make()
        for part in slices(batches, text, most):
            made = apply(part)
            arrays = [part.column(c).cast(arrow.field(i).type) for i, c in enumerate(columns)]
            arrays += [pa.array(v, type=arrow.field(len(columns) + i).type) for i, v in enumerate(made)]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)
        trim()

    return df.select(*dict.fromkeys([*columns, text])).mapInArrow(run, schema)
