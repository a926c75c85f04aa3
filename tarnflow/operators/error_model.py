"""Denoising by an error model: the divisive partition of DADA (Rosen et al., 2012; Callahan et al., 2016).

All unique sequences of a group start with its most abundant one as their centre. A sequence that is more abundant
than errors of its centre explain becomes a centre itself; sequences move to the centre that most likely made
them; substitution rates are learned again from the new assignment. Rounds go on until no sequence stands out.
Only sequences of one length are compared, without gaps, and qualities are not used.

Groups are never gathered: pairs of sequence and centre are rows, and rates are 16 sums.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tarnflow.operators.letters import bytes_of
from tarnflow.session import drop_staged, stage

OMEGA = 1e-40
START = 0.002  # substitution rate before any is learned
BASES = "ACGT"


def abundance_p(size: np.ndarray, expected: np.ndarray) -> np.ndarray:
    """Probability of at least ``size`` reads, given that there is one, where errors make ``expected`` (Poisson).

    The tail is summed for all values at once until it no longer changes; far below what is expected it is 1.
    """
    size, expected = np.asarray(size, float), np.asarray(expected, float)
    out = np.where(expected <= 0, 0.0, 1.0)
    todo = (size > 1) & (expected > 0) & (expected < size + 12 * np.sqrt(expected) + 60)
    s, e = size[todo], expected[todo]
    first = s * np.log(e) - e - np.array([math.lgamma(x + 1) for x in s.tolist()])
    total, term, k = np.ones_like(s), np.ones_like(s), 0
    while len(s) and (term > total * 1e-18).any():
        k += 1
        term = term * (e / (s + k))
        total = total + term
    out[todo] = np.minimum(1.0, np.exp(first + np.log(total)) / -np.expm1(-e))
    out[size <= 1] = 1.0
    return out


_CODE = np.full(256, 4, np.int64)
_CODE[[ord(c) for c in BASES]] = range(4)


def _pair_counts(a: pa.Array, b: pa.Array) -> pa.Array:
    """Counts of letter pairs of each two strings of one length, as 16 numbers a row."""
    (x, at), (y, _) = bytes_of(a), bytes_of(b)
    i, j, row = _CODE[x], _CODE[y], np.repeat(np.arange(len(a)), np.diff(at))
    good = (i < 4) & (j < 4)
    counts = np.bincount(row[good] * 16 + 4 * i[good] + j[good], minlength=16 * len(a))
    return pa.ListArray.from_arrays(np.arange(0, 16 * len(a) + 1, 16, dtype=np.int32), pa.array(counts))


def _substitutions(pairs: DataFrame) -> DataFrame:
    """Counts of letter pairs between ``centre_seq`` and ``seq`` as an array of 16, row by centre's letter."""
    return pairs.withColumn("subs", F.arrow_udf(_pair_counts, "array<long>")("centre_seq", "seq"))


def _rates(assigned: DataFrame) -> list[float]:
    """Substitution rates from reads and their centres: 16 sums over all groups, with a small prior."""
    sums = assigned.agg(*[F.sum(F.col("subs")[k] * F.col("size")).alias(f"s{k}") for k in range(16)]).first()
    table = np.array([float(x or 0) for x in sums]).reshape(4, 4) + np.eye(4) * 100 + 0.1
    return (table / table.sum(axis=1, keepdims=True)).ravel().tolist()


def _likelihood(pairs: DataFrame, rates: list[float]) -> DataFrame:
    """``log_p``: logarithm of the probability that a read of the centre becomes the sequence."""
    terms = [F.col("subs")[k] * math.log(r) for k, r in enumerate(rates)]
    return pairs.withColumn("log_p", sum(terms[1:], terms[0]))


def denoise(seqs: DataFrame, by: list[str], omega: float = OMEGA) -> DataFrame:
    """``seqs`` (``id``, ``seq``, ``size``) with ``centre``, the id of the sequence that each is taken to come from.

    Sequences of another length than any centre are centres of their own. In each round each centre's sequences
    give one new centre at most, the one with the least p-value, so centres of a group may double in a round. Rounds go
    on until no sequence stands out, however many that takes. The result doesn't depend on row order.
    """
    rows = stage(seqs.select(*by, "id", F.upper("seq").alias("seq"), "size").withColumn("len", F.length("seq")), "error-model")
    lane = [*by, "len"]
    most = rows.groupBy(*lane).agg(F.min_by(F.struct("id", "seq"), F.struct(-F.col("size"), "id")).alias("top"), F.count(F.lit(1)).alias("all"))
    most = stage(most, "error-lanes")
    first = most.select(*lane, F.col("top.id").alias("centre"), F.col("top.seq").alias("centre_seq"))
    rates = [1 - 3 * START if k % 5 == 0 else START for k in range(16)]
    pairs = stage(_substitutions(rows.join(first, lane)), "error-pairs")
    # A centre is always its own: letters beyond ACGT don't count, so another centre may fit it better than it does itself.
    own = Window.partitionBy(*lane, "id").orderBy(F.desc(F.col("id") == F.col("centre")), F.desc("log_p"), "centre")
    p_value = F.arrow_udf(lambda size, expected: pa.array(abundance_p(size.to_numpy(zero_copy_only=False), expected.to_numpy(zero_copy_only=False))), "double")

    while True:
        best = stage(_likelihood(pairs, rates).withColumn("n", F.row_number().over(own)).where("n = 1").drop("n"), "error-best")
        rates = _rates(best)
        reads = best.groupBy(*lane, "centre").agg(F.sum("size").alias("reads"))
        tested = best.where("id <> centre").join(reads, [*lane, "centre"])
        tested = _likelihood(tested.drop("log_p"), rates).withColumn("p", p_value("size", F.col("reads") * F.exp("log_p")))
        odd = tested.join(most.select(*lane, "all"), lane).where(F.col("p") * F.col("all") < omega)
        chosen = odd.groupBy(*lane, "centre").agg(F.min_by(F.struct("id", "seq"), F.struct("p", -F.col("size"), "id")).alias("new"))
        new = stage(chosen.select(*lane, F.col("new.id").alias("centre"), F.col("new.seq").alias("centre_seq")), "error-new")
        if not new.head(1):
            return best.select(*by, "id", "seq", "size", "centre")
        more = stage(pairs.unionByName(_substitutions(rows.join(new, lane))), "error-pairs")
        for old in (pairs, best):
            drop_staged(old)
        pairs = more


def variants(denoised: DataFrame, by: list[str]) -> DataFrame:
    """The centres with the reads that are taken to come from them."""
    reads = denoised.groupBy(*by, F.col("centre").alias("id")).agg(F.sum("size").alias("reads"))
    return denoised.where("id = centre").select(*by, "id", "seq").join(reads, [*by, "id"])
