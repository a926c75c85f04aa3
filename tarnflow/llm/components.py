"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tarnflow.llm.hot_keys import joined
from tarnflow.session import drop_staged, stage


def _large_star(edges: DataFrame, total: int, tag: str) -> tuple[DataFrame, DataFrame]:
    """Each node links its larger neighbours to the least of its neighbourhood; a node of many is joined by broadcast.

    Second, the staged frame that the result reads.
    """
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = stage(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("n")), f"{tag}-least")
    return joined(both.where("v > u"), least, ["u"], 2 * total).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), least


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links itself and its smaller neighbours to the least of them; edges have u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    inner = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return inner.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    """Number of edges and an order-independent sum over them; equal in two rounds at the fixed point."""
    r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    return tuple(r)


def _least(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of the edges that aren't their own root, and their roots: hooking to the lesser label, then jumping."""
    nodes, codes = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b, label = codes[: len(u)], codes[len(u) :], np.arange(len(nodes))
    while (label[a] != label[b]).any():
        of_a, of_b = label[a], label[b]
        np.minimum.at(label, np.maximum(of_a, of_b), np.minimum(of_a, of_b))
        while (label[label] != label).any():
            label = label[label]
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _at_once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = list(batches)
    if held:
        u, v = (np.concatenate([x.column(c).to_numpy(zero_copy_only=False) for x in held]) for c in ("u", "v"))
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in _least(u, v)], names=["node", "root"])


def components(edges: DataFrame, tag: str = "components", at_once: int = 0) -> DataFrame:
    """``node`` and ``root``, the least node it reaches, for every node of an edge that isn't its own root.

    ``edges`` has whole numbers ``u`` and ``v`` in any direction, repeats and loops allowed; edges with a
    null end count for nothing. Rounds grow with the logarithm of the components' size. A step moves
    each edge a bounded number of times, aggregates before it shuffles, and is written to the shared
    folder, so no node's neighbours are ever gathered in one place; but up to ``at_once`` distinct edges are taken by one
    task, which some rounds over as many files cost more than. No edges give an empty result.
    """
    clean = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now = stage(clean, tag)
    was = _state(now)
    if 0 < was[0] <= at_once:
        found = stage(now.coalesce(1).mapInArrow(_at_once, "node long, root long"), tag)
        drop_staged(now)
        return found
    while was[0]:
        large, least = _large_star(now, was[0], tag)
        new = stage(_small_star(large), tag)
        drop_staged(now)
        drop_staged(least)
        now, state = new, _state(new)
        if state == was:
            break
        was = state
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
