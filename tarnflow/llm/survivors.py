"""Dropping rows by a decision made on ids and hashes alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tarnflow.session import broadcast_if_small, stage


def surviving(docs: DataFrame, id_col: str, key: Column, made: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose (id, key) is kept in ``made``, with all columns.

    ``made`` has one row per row of ``docs``: ``id``, ``key`` (the same expression, never null) and
    ``kept``. Of rows that repeat the id and key of a kept row one stays. Whole rows are joined with the lost
    ids only, usually the smaller side; few enough of them are broadcast, so that texts stay where they are.
    """
    lost = broadcast_if_small(stage(made.where(~F.col("kept")).select("id", F.xxhash64("key").alias("key")).distinct(), "survivors-lost"))
    both = made.where("kept").select("id", F.xxhash64("key").alias("key")).distinct()
    match = F.col("a.id").eqNullSafe(F.col("b.id")) & (F.col("a.key") == F.col("b.key"))
    again = lost.alias("a").join(both.alias("b"), match, "left_semi").select("a.id", "a.key")
    # The row as one column: no name of its own columns can clash with the two beside it.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("own_id"), F.xxhash64(key).alias("own_key"))
    same = F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_key") == F.col("key"))
    kept = rows.join(lost, same, "left_anti")
    if again.head(1):
        kept = kept.unionByName(rows.join(again, same, "left_semi").dropDuplicates(["own_id", "own_key"]))
    return kept.select("row.*")
