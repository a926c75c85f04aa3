"""Older selections and rules that users of earlier versions still run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Standard names of the second archive's columns (fixed values).
STANDARD_NAMES = {"Accession": "Run", "BioProject accession": "BioProject", "BioSample accession": "BioSample", "Sample name": "SampleName", "Organism": "ScientificName"}


def route_by_prefix(value: Column) -> Column:
    return F.when(value.startswith("PRJCA") | value.startswith("CRA"), "cncb").when(value.startswith("PRJNA") | value.startswith("PRJEB") | value.startswith("PRJDB"), "ncbi").otherwise("unknown")


def standard_union(tables: dict[str, DataFrame]) -> DataFrame:
    """All sources under the standard names, each row with its ``source``."""
    out = None
    for source, table in tables.items():
        own = table.withColumnsRenamed({k: v for k, v in STANDARD_NAMES.items() if v not in table.columns}).withColumn("source", F.lit(source))
        out = own if out is None else out.unionByName(own, allowMissingColumns=True)
    return out


def source_tally(table: DataFrame, source: str = "source") -> DataFrame:
    return table.groupBy(source).agg(F.count(F.lit(1)).alias("n"))


def synonyms(attributes: DataFrame) -> DataFrame:
    """Sorted different synonyms of each standard name (``name``, ``synonym``); a name has a bounded few."""
    return attributes.groupBy("name").agg(F.array_sort(F.collect_set("synonym")).alias("synonyms"))


def joined_stats(left: DataFrame, right: DataFrame, key: str = "sample_id") -> DataFrame:
    """Two statistics tables side by side, with the samples of either."""
    return left.join(right, key, "full")


def trim_length(counts: DataFrame, by: list[str], least: int = 9000) -> DataFrame:
    """The first position that fewer than ``least`` reads reach, else the last position."""
    found = F.coalesce(F.min(F.when(F.col("reads") < least, F.col("pos"))), F.max("pos"))
    return counts.groupBy(*by).agg(found.alias("trim"))


def nearest_anchor(hits: DataFrame, anchors: DataFrame, by: list[str]) -> DataFrame:
    """Modal start of the hits by group, the nearest anchor to it, and the median cut of hits at the modal start.

    Of equal counts and distances the smaller position counts. ``anchors`` is a short fixed list.
    """
    counts = hits.groupBy(*by, "start").agg(F.count(F.lit(1)).alias("n"), F.percentile("cut", 0.5).alias("cut"))
    mode = counts.groupBy(*by).agg(F.max_by(F.struct("start", "cut"), F.struct("n", -F.col("start"))).alias("m")).select(*by, F.col("m.start").alias("start"), F.col("m.cut").alias("cut"))
    near = mode.crossJoin(F.broadcast(anchors.select("anchor")))
    return near.groupBy(*by, "start", "cut").agg(F.min_by("anchor", F.struct(F.abs(F.col("anchor") - F.col("start")), "anchor")).alias("anchor"))


def first_of_first_files(seqs: DataFrame, files: int = 3, per_file: int = 20) -> DataFrame:
    """The first sequences of the first files by name."""
    names = seqs.select("file").distinct().orderBy("file").limit(files)
    order = Window.partitionBy("file").orderBy("read_idx")
    return seqs.join(F.broadcast(names), "file", "left_semi").withColumn("__n", F.row_number().over(order)).where(F.col("__n") <= per_file).drop("__n")


def plain_file_name(name: Column) -> Column:
    """``PROJECT_RUN_RUN_1`` as ``PROJECT_RUN_1``."""
    return F.regexp_replace(name, r"^([^_]+)_([^_]+)_\2(_|\.|$)", "$1_$2$3")


def layout_by_counts(counts: DataFrame) -> DataFrame:
    """paired for twice as many files as runs, single for as many, else error."""
    return counts.withColumn("layout", F.when(F.col("files") == 2 * F.col("runs"), "paired").when(F.col("files") == F.col("runs"), "single").otherwise("error"))
