"""Counts over the letters of reads, in Arrow batches that are combined before anything is shuffled.

Splitting strings into arrays and walking them with lambdas is interpreted letter by letter in the JVM. Here a batch's
letters are one byte buffer, so counting is a few vector operations, and a batch gives one row for each group, position
and letter that occur in it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Cells of a dense table of counts for one batch; sparser ones are counted by sorting.
DENSE = 1 << 22


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The letters of a string column as bytes, one string after the other, and where each begins; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    text = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
    held = text.buffers()[2]
    data = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held is not None and len(text) else np.empty(0, np.uint8)
    return data, offsets - offsets[0]


def _groups(batch: pa.RecordBatch, by: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A number for each row's group, and the first row of each group."""
    codes = np.zeros(batch.num_rows, np.int64)
    for name in by:
        own = batch.column(name).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        codes = codes * (int(own.max(initial=0)) + 1) + own
        _, codes = np.unique(codes, return_inverse=True)
    _, first, codes = np.unique(codes, return_index=True, return_inverse=True)
    return codes, first


def letter_counts(reads: DataFrame, by: list[str], column: str, first: int | None = None, from_end: bool = False) -> DataFrame:
    """``by``, ``pos`` (from 0), ``code`` (the letter's byte) and ``n``: letters by position, counted once a group and batch.

    ``first`` bounds the positions; they count from the end with ``from_end``. Position -1 counts the group's rows, those
    without letters too. Rows of the result still have to be summed.
    """
    schema = T.StructType([reads.schema[c] for c in by] + [T.StructField("pos", T.LongType()), T.StructField("code", T.IntegerType()), T.StructField("n", T.LongType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            data, offsets = bytes_of(batch.column(column))
            sizes, (group, firsts) = np.diff(offsets), _groups(batch, by)
            row = np.repeat(np.arange(batch.num_rows), sizes)
            pos = np.arange(len(data)) - offsets[row]
            if from_end:
                pos = sizes[row] - 1 - pos
            if first is not None:
                kept = pos < first
                data, row, pos = data[kept], row[kept], pos[kept]
            width = int(pos.max(initial=-1)) + 1
            key = (group[row] * width + pos) * 256 + data
            if len(firsts) * width * 256 <= DENSE:
                counts = np.bincount(key, minlength=1)
                key = np.flatnonzero(counts)
                counts = counts[key]
            else:
                key, counts = np.unique(key, return_counts=True)
            place, width = key >> 8, max(1, width)
            own = [batch.column(c).take(pa.array(np.concatenate([firsts, firsts[place // width]]))) for c in by]
            none = np.full(len(firsts), -1)
            columns = [np.concatenate([none, place % width]), np.concatenate([none, key & 255]).astype(np.int32), np.concatenate([np.bincount(group), counts])]
            yield pa.RecordBatch.from_arrays([*(c.cast(arrow.field(i).type) for i, c in enumerate(own)), *map(pa.array, columns)], schema=arrow)

    return reads.select(*by, column).mapInArrow(run, schema)


_CODE = np.full(256, 5, np.int64)
for _i, _b in enumerate("ACGTN"):
    _CODE[[ord(_b), ord(_b.lower())]] = _i


def _plain_scores(seq: str) -> tuple[float, float]:
    """Complexity and entropy of one sequence with letters beyond ACGTN."""
    upper = seq.upper()
    counts = [n for b in "ACGT" if (n := upper.count(b))]
    total = sum(counts)
    return len({upper[i : i + 2] for i in range(len(upper) - 1)}) / 16, -sum(n / total * math.log2(n / total) for n in counts)


def gate_scores(seq: pa.Array, qual: pa.Array | None) -> dict[str, np.ndarray]:
    """``length``, ``quality`` (mean Phred score, 0 without any), ``complexity`` and ``entropy`` of each read."""
    data, offsets = bytes_of(seq)
    n, sizes = len(seq), np.diff(offsets)
    row, code = np.repeat(np.arange(n), sizes), _CODE[data]
    counts = np.bincount(row * 6 + code, minlength=6 * n).reshape(n, 6)[:, :4]
    total = counts.sum(axis=1, keepdims=True)
    with np.errstate(divide="ignore", invalid="ignore"):
        share = counts / total
        entropy = -np.where(counts > 0, share * np.log2(share), 0.0).sum(axis=1)
    joined = row[:-1] == row[1:]
    seen = np.zeros(n * 25, bool)
    usual = joined & (code[:-1] < 5) & (code[1:] < 5)
    seen[row[:-1][usual] * 25 + code[:-1][usual] * 5 + code[1:][usual]] = True
    complexity = seen.reshape(n, 25).sum(axis=1) / 16.0
    length = sizes.astype(np.int64)
    for i in np.unique(row[code == 5]).tolist():
        text = seq[i].as_py()
        length[i] = len(text)
        complexity[i], entropy[i] = _plain_scores(text)
    out = {"length": length, "complexity": complexity, "entropy": entropy}
    if qual is not None:
        marks, at = bytes_of(qual)
        sums = np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])
        many = np.diff(at)
        out["quality"] = np.where(many > 0, (sums[at[1:]] - sums[at[:-1]]) / np.maximum(many, 1) - 33, 0.0)
    return out


def first_broken(seq: Column, qual: Column | None, least: dict[str, float], names: dict[str, str]) -> Column:
    """The name of the first rule (``length``, ``quality``, ``complexity``, ``entropy``) that a read falls below, or kept."""

    def reasons(*parts: pa.Array) -> pa.Array:
        found = gate_scores(parts[0], parts[1] if len(parts) > 1 else None)
        rules = [(names[k], found[k] < v) for k, v in least.items() if k in found]
        chosen = np.select([x for _, x in rules], np.arange(len(rules)), len(rules))
        return pa.array([*(name for name, _ in rules), "kept"]).take(pa.array(chosen))

    made = F.arrow_udf(reasons, "string")
    return made(seq) if qual is None else made(seq, qual)
