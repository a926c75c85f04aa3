"""Overlap operators on mates: merging and adapter removal, vectorised over Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tarnflow.operators.letters import bytes_of

LEAST_OVERLAP, MOST_SHARE = 10, 0.1
_COMPLEMENT = np.arange(256, dtype=np.uint8)
for _a, _b in zip(b"ACGTNacgtn", b"TGCANtgcan", strict=True):
    _COMPLEMENT[_a] = _b
_UPPER = np.frombuffer(bytes(range(256)).upper(), np.uint8)


def insert_lengths(a: np.ndarray, b: np.ndarray, least: int = LEAST_OVERLAP, share: float = MOST_SHARE) -> np.ndarray:
    """Lengths of the fragments that pairs of mates come from, by their best overlaps; -1 without one.

    ``a`` has the first mates' letters, a row each, ``b`` those of the second mates turned round, all of one length.
    The overlap with the fewest differences for its length counts, the longest among equals. A fragment
    shorter than a read means that the read runs into the adapter. All pairs are compared at once, size by size.
    """
    n, la, lb = len(a), a.shape[1], b.shape[1]
    best, longest, found = np.full(n, share + 1e-9), np.zeros(n, np.int64), np.full(n, -1)
    for size in range(least, la + lb - least + 1):
        start = size - lb  # where b begins on a
        low, high = max(0, start), min(la, size)
        over = high - low
        if over < least:
            continue
        rate = (a[:, low:high] != b[:, low - start : high - start]).sum(axis=1) / over
        better = (rate < best) | (rate == best) & (over > longest)
        best[better], longest[better], found[better] = rate[better], over, size
    return found


def merged_mates(a: np.ndarray, b: np.ndarray, qa: np.ndarray, qb: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Fragments of one size and their qualities, with the base of higher quality where the mates differ; the first's among equals."""
    start, n = size - b.shape[1], len(a)
    low, high = max(0, start), min(a.shape[1], size)
    seq, qual = np.zeros((n, size), np.uint8), np.zeros((n, size), np.uint8)
    seq[:, max(0, start) :], qual[:, max(0, start) :] = b[:, max(0, -start) :], qb[:, max(0, -start) :]
    front = slice(0, low)
    seq[:, front], qual[:, front] = a[:, front], qa[:, front]
    own = qa[:, low:high] >= qb[:, low - start : high - start]
    seq[:, low:high] = np.where(own, a[:, low:high], seq[:, low:high])
    qual[:, low:high] = np.where(own, qa[:, low:high], qual[:, low:high])
    return seq, qual


def _matrix(held: tuple[np.ndarray, np.ndarray], which: np.ndarray, width: int) -> np.ndarray:
    data, at = held
    return data[at[which][:, None] + np.arange(width)]


def _by_shape(*columns: np.ndarray):
    """Rows that agree in all the numbers: the numbers and the rows."""
    keys, group = np.unique(np.stack(columns, axis=1), axis=0, return_inverse=True)
    order = np.argsort(group, kind="stable")
    cuts = np.flatnonzero(np.diff(group[order])) + 1
    return zip(keys.tolist(), np.split(order, cuts), strict=True) if len(order) else ()


def _insert_lengths(first: pa.Array, second: pa.Array) -> pa.Array:
    one, two = bytes_of(first), bytes_of(second)
    out = np.full(len(first), -1, np.int32)
    for (la, lb), rows in _by_shape(np.diff(one[1]), np.diff(two[1])):
        if la and lb:
            for at in range(0, len(rows), 4096):
                part = rows[at : at + 4096]
                out[part] = insert_lengths(_UPPER[_matrix(one, part, la)], _COMPLEMENT[_UPPER[_matrix(two, part, lb)]][:, ::-1])
    return pa.array(out)


def _merge(a: pa.Array, b: pa.Array, qa: pa.Array, qb: pa.Array, sizes: pa.Array) -> pa.Array:
    held = [bytes_of(x) for x in (a, b, qa, qb)]
    lengths, found = [np.diff(h[1]) for h in held], sizes.to_numpy(zero_copy_only=False)
    out = np.empty((2, len(a)), object)
    for (la, lb, ka, kb, size), rows in _by_shape(*lengths, found):
        if (la, lb) != (ka, kb):
            raise ValueError("a read's letters and qualities differ in number")
        one, two = (_matrix(held[i], rows, la) for i in (0, 2))
        back, back_q = _COMPLEMENT[_matrix(held[1], rows, lb)][:, ::-1], _matrix(held[3], rows, lb)[:, ::-1]
        for i, made in enumerate(merged_mates(one, back, two, back_q, size)):
            out[i, rows] = made.view(f"S{size}").ravel()
    return pa.StructArray.from_arrays([pa.array(x, pa.binary()).cast(pa.string()) for x in out], ["seq", "qual"])


def _inserts(pairs: DataFrame) -> DataFrame:
    return pairs.withColumn("insert_len", F.arrow_udf(_insert_lengths, "int")("seq1", "seq2"))


def merge_pairs(pairs: DataFrame) -> DataFrame:
    """Pairs that overlap as one read each: ``seq`` and ``qual``; pairs without an overlap drop out."""
    join = F.arrow_udf(_merge, "seq string, qual string")
    keys = [c for c in pairs.columns if c not in ("seq1", "seq2", "qual1", "qual2")]
    found = _inserts(pairs).where("insert_len > 0")
    made = found.withColumn("m", join("seq1", "seq2", "qual1", "qual2", "insert_len"))
    return made.select(*keys, "insert_len", "m.seq", "m.qual")


def without_adapters(pairs: DataFrame) -> DataFrame:
    """Mates cut to their fragment where that is shorter than they are; other pairs stay as they are."""
    found = _inserts(pairs)
    cut = lambda c: F.when(F.col("insert_len") > 0, F.substr(F.col(c), F.lit(1), F.col("insert_len"))).otherwise(F.col(c))
    return found.withColumns({c: cut(c) for c in ("seq1", "qual1", "seq2", "qual2")}).drop("insert_len")


def without_adapter(reads: DataFrame, adapter: str, seed: int = 12) -> DataFrame:
    """Single reads cut where the adapter's first letters begin."""
    at = F.instr(F.upper("seq"), adapter[:seed].upper())
    cut = lambda c: F.when(at > 0, F.substr(F.col(c), F.lit(1), at - 1)).otherwise(F.col(c))
    found = reads.withColumns({"__seq": cut("seq"), "__qual": cut("qual")})
    return found.withColumns({"seq": F.col("__seq"), "qual": F.col("__qual")}).drop("__seq", "__qual")


def merge_quality(counts: DataFrame) -> DataFrame:
    """Whether to go on with the first mates alone: half as many again as the unmerged outnumber the merged."""
    return counts.withColumn("forward_only", F.col("unmerged") * 1.5 > F.col("merged"))
