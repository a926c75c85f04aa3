"""Phases with staged results: a phase whose result is there is read instead of run again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tarnflow.operators import features as T, metadata as M, taxonomy as N
from tarnflow.sources import sinks


class Phases:
    """Named results below a folder; each is written once and complete or not at all."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.ran = spark, folder, []

    def run(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        path = f"{self.folder}/{name}"
        if not sinks._exists(self.spark, f"{path}/_SUCCESS"):
            make().write.mode("overwrite").parquet(path)
            self.ran.append(name)
        return self.spark.read.parquet(path)


def milestones(done: int, before: int, total: int, step: int = 25) -> list[int]:
    """The percentages, by steps, that a count passed on its way from ``before`` to ``done``."""
    at = lambda n: n * 100 // total // step
    return [k * step for k in range(at(before) + 1, at(done) + 1)] if total else []


def outcome_counts(log: DataFrame) -> DataFrame:
    """Data sets by outcome, one row; skipped ones have a state of their own."""
    return log.agg(*[F.count_if(F.col("status") == s).alias(s) for s in ("success", "failed", "skipped", "low_quality")])


def harvest(phases: Phases, ids: DataFrame, sra: DataFrame, samples: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Run metadata of the asked projects joined with their samples and standardized, and a state for each id.

    ``ids`` has ``id``; ``sra`` has at least Run, BioProject and BioSample; ``samples`` has ``BioSample``.
    """
    kinds = ids.select("id", M.classify(F.col("id")).alias("kind"))
    asked = kinds.where("kind in ('ncbi', 'cncb')").select(F.col("id").alias("BioProject"))
    joined = phases.run("joined", lambda: M.full_join(sra.join(asked, "BioProject", "left_semi"), samples, "BioSample").where("Run is not null"))
    clean = phases.run("standardized", lambda: M.priority_first(M.standardized(joined)))
    valid = M.has_runs(clean, ["BioProject"])
    states = kinds.join(valid.withColumnRenamed("BioProject", "id"), "id", "left")
    status = F.when(F.col("kind") == "unknown", "invalid_format").when(F.col("valid"), "has_data").when(~F.col("valid"), "no_run_info").otherwise("no_data")
    return clean, states.select("id", status.alias("status"))


def combine(phases: Phases, table: DataFrame, references: DataFrame, tips: DataFrame | None = None, confidence: float = N.CONFIDENCE) -> dict[str, DataFrame]:
    """Merge data sets, orient and classify their sequences, and split by what a tree has.

    ``table`` has ``feature_id``, ``sample_id``, ``count`` and ``seq``; ``references`` have ``seq`` and ``taxon``.
    Without tips there is no split, as a failed placement is no failure of the rest.
    """
    merged = phases.run("merged", lambda: T.merge_tables([table.select("feature_id", "sample_id", "count")]))
    seqs = phases.run("sequences", lambda: T.merge_sequences([table]))
    turned = phases.run("oriented", lambda: N.oriented(seqs.withColumnRenamed("feature_id", "id"), references).select("id", "seq"))
    kept = phases.run("kept", lambda: merged.join(turned.select(F.col("id").alias("feature_id")), "feature_id", "left_semi"))
    taxa = phases.run("taxonomy", lambda: N.classify(turned, N.train(references), confidence=confidence))
    out = {"table": kept, "sequences": turned, "taxonomy": taxa, "summary": T.summary(kept)}
    if tips is not None:
        out["placed"], out["unplaced"] = N.split_by_placement(kept, tips)
    return out
