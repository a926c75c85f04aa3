"""Exact de-duplication of texts, with frequent digests taken out before the shuffle. JVM-side only.

``freqItems`` (the Misra-Gries counters of Karp, Schenker and Papadimitriou) names at most 1 / support
digests and misses none that is more frequent than that share of the rows. Their winners are found by a
map-side combined aggregate, which also verifies them, and are broadcast, so rows of hot groups are
decided where they are read. All other digests have groups of a bounded share and use one ordinary shuffle.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window, functions as F

from tarnflow.llm.survivors import surviving
from tarnflow.session import stage

#: Share of all rows above which a digest is surely split off; 1 / SUPPORT digests are broadcast at most.
SUPPORT = 1 / 4096


def normalised(text: Column) -> Column:
    """The text with A-Z lower-cased and nothing else changed; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def decisions(docs: DataFrame, id_col: str = "doc_id", text: str = "text", support: float = SUPPORT) -> DataFrame:
    """One row per row of ``docs``: the id, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Texts are equal if they are identical after lower-casing A-Z; a null text equals an empty one. The
    row with the largest id of a group stays, of equal ids the one read last; a null id ranks lowest. Texts of any length are digested whole. Of rows that repeat both the text
    and the winning id exactly one is kept. ``group_size`` counts rows. An empty table gives an empty
    result. Other columns of ``docs`` are not read.
    """
    found = stage(
        docs.select(F.col(id_col).alias("id"), F.sha2(normalised(F.col(text)), 256).alias("d")).withColumn("r", F.monotonically_increasing_id()),
        "exact-digests",
    )
    frequent = found.stat.freqItems(["d"], support).select(F.explode("d_freqItems").alias("d"))
    best = F.max(F.struct("id", "r"))
    winners = (  # 1 / support rows at most
        found.join(F.broadcast(frequent), "d", "left_semi").groupBy("d").agg(best.alias("w"), F.count(F.lit(1)).alias("n")).where("n > 1")
    )
    hot = stage(winners, "exact-winners")
    group = Window.partitionBy("d")
    marked = found.join(F.broadcast(hot), "d", "left")
    light = marked.where("w is null").select("id", "r", "d", best.over(group).alias("w"), F.count(F.lit(1)).over(group).alias("n"))
    both = marked.where("w is not null").select("id", "r", "d", "w", "n").unionByName(light)
    return both.select(
        F.col("id").alias(id_col),
        F.col("w.id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("r") == F.col("w.r")).alias("kept"),
        F.col("d").alias("text_sha256"),
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text: str = "text", support: float = SUPPORT) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, by the rules of ``decisions``.

    Only ids and digests take part in the decision; whole rows move once, by id and digest, to drop losers.
    """
    made = stage(decisions(docs, id_col, text, support), "exact-decisions")
    key = F.sha2(normalised(F.col(text)), 256)
    return surviving(docs, id_col, key, made.select(F.col(id_col).alias("id"), F.col("text_sha256").alias("key"), "kept"))
