"""Joins in which one key may hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: Share of all rows above which a key is joined by broadcast: at most 1 / SHARE keys are.
SHARE = 1 / 4096
LEAST = 1000  # rows of a key that are never worth it


def joined(rows: DataFrame, side: DataFrame, keys: list[str], total: int) -> DataFrame:
    """Inner join of ``rows`` with ``side``, which is staged and has one row a key and ``n``, that key's number of rows.

    Keys with more than ``SHARE`` of the ``total`` rows, of which there are few, are broadcast, so their rows stay where
    they are read. All other keys have groups of a bounded share and are joined by one ordinary shuffle.
    """
    bound = max(total * SHARE, LEAST)
    hot, cold = side.where(F.col("n") > bound).drop("n"), side.where(F.col("n") <= bound).drop("n")
    if not hot.head(1):
        return rows.join(side.drop("n"), keys)
    light = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    return rows.join(F.broadcast(hot), keys).unionByName(light.join(cold, keys))
