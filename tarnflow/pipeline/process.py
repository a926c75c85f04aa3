"""Reads of many data sets to feature tables, each data set by the route of its platform.

Data sets are never looped over: a phase takes all data sets of a route at once, and everything that is decided for a
data set (layout, quality, primers, route, retention) is a row of a table that its reads are joined with.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, functions as F

from tarnflow.operators import error_model as E, features as T, metadata as M, pairs as Q, primers as P, reads as R, similarity as Y, trimming as C
from tarnflow.pipeline.runner import Phases, outcome_counts
from tarnflow.schema import FORWARD_PRIMERS, FULL_LENGTH_PRIMERS, REGION_LENGTHS, REGION_PRIMERS, REVERSE_PRIMERS

# The common adapter of single reads, lengths of full-length amplicons, the front that Ion Torrent reads lose.
ADAPTER = "AGATCGGAAGAGCACACGTCTGAACTCCAGTCA"
FULL_LENGTHS, ION_FRONT = (1000, 1600), 10
SUPPORTED = ("illumina", "illumina_degraded", "ls454", "ion_torrent", "pacbio")


def plan(reads: DataFrame, platforms: DataFrame, by: str = "dataset_id") -> DataFrame:
    """One row a data set: ``platform``, ``layout`` (PE or SE), ``degraded``, ``raw_reads`` and ``route``.

    ``reads`` have ``sample_id``, ``file``, ``mate`` (null for single reads), ``read_idx``, ``seq`` and ``qual``; quality
    is judged by the first mates.
    """
    files = reads.select(by, F.col("sample_id").alias("sample"), F.coalesce("mate", F.lit(0)).alias("mate")).distinct()
    kinds = M.majority_layout(files, [by])
    quality = R.distinct_qualities(_first_mates(reads), [by], "file").select(by, "degraded")
    counts = R.total_raw_reads_by(reads, [by])
    rows = counts.join(kinds, by).join(quality, by).join(platforms.select(by, M.platform(F.col("platform")).alias("platform")), by, "left")
    return rows.withColumn("route", M.route(F.coalesce("platform", F.lit("")), F.col("degraded")))


def _first_mates(reads: DataFrame) -> DataFrame:
    return reads.where(F.coalesce("mate", F.lit(1)) == 1)


def mates(reads: DataFrame, plans: DataFrame, by: str) -> tuple[DataFrame, DataFrame]:
    """Pairs of the data sets that have mates, and the single reads of the others, both without adapters."""
    keys = [by, "sample_id", "read_idx"]
    of = lambda layout: reads.join(plans.where(F.col("layout") == layout).select(by), by, "left_semi")
    two = of("PE")
    pairs = R.paired(two.where("mate = 1"), two.where("mate = 2"), keys)
    return Q.without_adapters(pairs), Q.without_adapter(_first_mates(of("SE")), ADAPTER).select(*keys, "file", "seq", "qual")


def primer_trimmed(pairs: DataFrame, singles: DataFrame, by: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pairs and single reads without their primers, and one row of decisions a data set.

    Modes: PE (each mate by its own primer), PE_mixed (first mates of both directions: majority and minority by theirs,
    pairs turned), SE. Data sets without a primer stay as they are.
    """
    spark, keys = pairs.sparkSession, [by]
    forward, reverse = P.primer_table(spark, FORWARD_PRIMERS), P.primer_table(spark, REVERSE_PRIMERS)
    first = R.quality_gate(pairs.select(*pairs.columns, F.col("seq1").alias("seq"), F.col("qual1").alias("qual")))
    second = R.quality_gate(pairs.select(by, F.col("seq2").alias("seq"), F.col("qual2").alias("qual")))
    mixed = P.mixed_orientation(R.base_frequencies(first, keys), keys)
    split = P.split_orientation(first, mixed, keys)

    def trims(rows: DataFrame, primers: DataFrame, side: str) -> DataFrame:
        found = P.detect(R.base_frequencies(rows.select(by, "seq"), keys), keys, primers)
        return found.select(by, F.col("trim").alias(f"{side}_trim"), F.col("primer").alias(f"{side}_primer"), F.col("consensus").alias(f"{side}_consensus"))

    is_mixed = F.coalesce("mixed", F.lit(False))
    plain = second.join(mixed.where(~is_mixed).select(by), by, "left_semi").select(by, "seq")
    turned = split.where("minority").join(mixed.where(is_mixed).select(by), by, "left_semi").select(by, "seq")
    ones = trims(split.where("not minority"), forward, "forward")
    twos = trims(plain.unionByName(turned), reverse, "reverse")
    decided = mixed.join(ones, by, "left").join(twos, by, "left").withColumn("mode", F.when(is_mixed, "PE_mixed").otherwise("PE"))
    single = trims(R.quality_gate(singles), forward, "forward").withColumn("mode", F.lit("SE"))
    info = decided.drop("ratio").unionByName(single, allowMissingColumns=True)
    cuts = info.select(by, "mixed", "best_pos", "major", *[F.coalesce(f"{s}_trim", F.lit(0)).cast("int").alias(f"{s}_trim") for s in ("forward", "reverse")])
    paired = P.trim_mixed_pairs(pairs.join(cuts.select(by, "forward_trim", "reverse_trim"), by), cuts, keys, F.col("forward_trim"), F.col("reverse_trim"))
    cut = R.cut_front(singles.join(cuts.select(by, "forward_trim"), by), F.col("forward_trim"))
    return paired.drop("forward_trim", "reverse_trim", "flipped"), cut.drop("forward_trim"), info


def _unique(reads: DataFrame, by: str, least: int = 1) -> DataFrame:
    return R.dereplicate(reads.withColumn("header", F.lit("")), [by], least).select(by, F.md5("seq").alias("id"), "seq", "size", "first_idx")


def error_model_table(phases: Phases, name: str, reads: DataFrame, by: str) -> DataFrame:
    """Counts of the variants that the error model finds, without chimeras: each read counts for its centre."""
    keys = [by]
    unique = phases.run(f"{name}-unique", lambda: _unique(reads, by))
    found = phases.run(f"{name}-denoised", lambda: E.denoise(unique, keys))

    def table() -> DataFrame:
        sizes = E.variants(found, keys).withColumnRenamed("reads", "size")
        good = Y.non_chimeras(sizes, keys).select(by, F.col("id").alias("feature_id"), "seq")
        own = reads.groupBy(by, F.md5(F.upper("seq")).alias("id"), "sample_id").agg(F.count(F.lit(1)).alias("n"))
        counted = own.join(found.select(by, "id", F.col("centre").alias("feature_id")), [by, "id"]).groupBy(by, "feature_id", "sample_id").agg(F.sum("n").alias("count"))
        return counted.join(good, [by, "feature_id"])

    return phases.run(f"{name}-table", table)


def mapped_table(phases: Phases, name: str, reads: DataFrame, by: str, otus: bool, least: int = 2) -> DataFrame:
    """Counts by mapping all reads at 97 % to denoised sequences, or to OTUs of sequences that are no chimeras."""
    keys = [by]
    unique = phases.run(f"{name}-unique", lambda: _unique(reads, by, 1 if otus else 2))

    def centroids() -> DataFrame:
        if otus:
            found = Y.cluster_otus(Y.non_chimeras(unique.select(by, "id", "seq", "size"), keys), keys)
            return found.where("id = centroid").select(by, "id", "seq", "size")
        return Y.non_chimeras(Y.denoise(unique, keys), keys, 16.0)

    chosen = phases.run(f"{name}-centroids", centroids)
    counts = phases.run(f"{name}-mapped", lambda: Y.map_reads(reads, chosen, keys))

    def table() -> DataFrame:
        frequent = counts.groupBy(by, "feature_id").agg(F.sum("count").alias("n")).where(F.col("n") >= least)
        return counts.join(frequent.drop("n"), [by, "feature_id"], "left_semi").join(chosen.select(by, F.col("id").alias("feature_id"), "seq"), [by, "feature_id"])

    return phases.run(f"{name}-table", table)


def process_study(phases: Phases, reads: DataFrame, platforms: DataFrame, by: str = "dataset_id") -> dict[str, DataFrame]:
    """``table`` (data set, ``feature_id``, ``sample_id``, ``count``, ``seq``), ``outcomes``, ``summary`` and ``primers`` of a study.

    Paired Illumina data whose merged pairs keep less than half of the raw pairs are done again with first mates alone;
    if those keep less than half too, the outcome is low_quality. Full-length PacBio data are cut between their primers
    and reduced to the V3-V4 region; shorter ones and unsupported platforms are skipped.
    """
    plans = phases.run("plans", lambda: plan(reads, platforms, by))
    routes = {r[0] for r in plans.select("route").distinct().collect()}  # seven at most
    of = lambda rows, *names: rows.join(plans.where(F.col("route").isin(*names)).select(by), by, "left_semi")
    long = plans.where("route = 'pacbio'").select(by)
    short = reads.join(long, by, "left_anti")
    pairs, singles = mates(short, plans, by)
    pairs, singles = phases.run("pairs", lambda: pairs), phases.run("singles", lambda: singles)
    info = phases.run("primers", lambda: primer_trimmed(pairs, singles, by)[2])
    paired, single, _ = primer_trimmed(pairs, singles, by)
    paired, single = phases.run("pairs-cut", lambda: paired), phases.run("singles-cut", lambda: single)
    first = paired.select(by, "sample_id", "read_idx", F.lit("1").alias("file"), F.col("seq1").alias("seq"), F.col("qual1").alias("qual"))
    tables = []

    if "illumina" in routes:
        good = of(paired, "illumina")
        merged = phases.run("merged", lambda: Q.merge_pairs(R.sanitized_pairs(good)).select(by, "sample_id", "read_idx", "seq", "qual"))
        by_pairs = error_model_table(phases, "paired", merged, by)
        verdicts = phases.run("paired-retention", lambda: _retained(plans.where("route = 'illumina' and layout = 'PE'"), by_pairs, None, by))
        again = verdicts.where("verdict <> 'paired'").select(by)
        forward = phases.run("forward", lambda: R.sanitized(first.join(again, by, "left_semi")).select(by, "sample_id", "read_idx", "seq", "qual"))
        by_first = error_model_table(phases, "forward", forward, by)
        ready = phases.run("single", lambda: R.sanitized(of(single, "illumina")).select(by, "sample_id", "read_idx", "seq", "qual"))
        tables += [by_pairs.join(again, by, "left_anti"), by_first, error_model_table(phases, "single", ready, by)]
        final = phases.run("retention", lambda: _retained(plans.where("route = 'illumina' and layout = 'PE'"), by_pairs, by_first, by))
    else:
        final = None
    if "illumina_degraded" in routes:
        rows = of(first.unionByName(single.select(*first.columns)), "illumina_degraded")
        cut = phases.run("degraded", lambda: C.degraded_preprocess(rows, [by], "file").where("verdict = 'kept'").drop("verdict", "trunc"))
        tables.append(mapped_table(phases, "degraded", cut, by, otus=False))
    if "ls454" in routes:
        tailed = phases.run("ls454-trimmed", lambda: R.filtered_for(C.adaptive_tail_trim(of(first.unionByName(single.select(*first.columns)), "ls454"), [by])[0], "ls454", [by]))
        tables.append(mapped_table(phases, "ls454", tailed, by, otus=True))
    if "ion_torrent" in routes:
        rows = of(first.unionByName(single.select(*first.columns)), "ion_torrent")
        ion = phases.run("ion-filtered", lambda: R.cut_front(R.filtered_for(rows, "ion_torrent", [by]), ION_FRONT).where("seq <> ''"))
        tables.append(error_model_table(phases, "ion", ion, by))
    skipped = plans.where(~F.col("route").isin(*SUPPORTED)).select(by)
    if "pacbio" in routes:
        own = Q.without_adapter(_first_mates(reads.join(long, by, "left_semi")), ADAPTER)
        full = phases.run("full-length", lambda: R.long_read_share(own, [by]).select(by, "full_length"))
        skipped = skipped.unionByName(full.where("not full_length").select(by))
        rows = own.join(full.where("full_length").select(by), by, "left_semi")

        def between() -> DataFrame:
            found = P.extract_region(rows, FULL_LENGTH_PRIMERS["27F"], FULL_LENGTH_PRIMERS["1492R"], FULL_LENGTHS)
            return found.select(by, "sample_id", "read_idx", F.col("region").alias("seq"))

        whole = phases.run("ccs", between)
        variants = error_model_table(phases, "ccs", whole, by)
        regions = P.extract_region(variants, *REGION_PRIMERS, REGION_LENGTHS)
        named = regions.select(by, F.md5("region").alias("feature_id"), "sample_id", "count", F.col("region").alias("seq"))
        tables.append(phases.run("ccs-region", lambda: named.groupBy(by, "feature_id", "sample_id", "seq").agg(F.sum("count").alias("count"))))

    columns = [by, "feature_id", "sample_id", "count", "seq"]
    empty = phases.spark.createDataFrame([], f"{by} string, feature_id string, sample_id string, count long, seq string")
    table = phases.run("features", lambda: functools.reduce(DataFrame.unionByName, [t.select(*columns) for t in tables], empty))
    log = phases.run("outcomes", lambda: _outcomes(plans, table, skipped, final, by))
    return {"table": table, "outcomes": log, "counts": outcome_counts(log), "summary": _summary(reads, table, by), "primers": info, "samples": T.summary(table)}


def _retained(plans: DataFrame, by_pairs: DataFrame, by_first: DataFrame | None, by: str) -> DataFrame:
    """Which counts keep half of the raw pairs; raw reads count both mates."""
    sums = lambda t, name: t.groupBy(by).agg(F.sum("count").alias(name))
    rows = plans.select(by, F.floor(F.col("raw_reads") / 2).alias("raw_pairs")).join(sums(by_pairs, "paired_final"), by, "left")
    rows = rows.join(sums(by_first, "single_final"), by, "left") if by_first is not None else rows.withColumn("single_final", F.lit(0))
    return M.retention(rows.na.fill(0, ["paired_final", "single_final"])).select(by, "verdict")


def _outcomes(plans: DataFrame, table: DataFrame, skipped: DataFrame, final: DataFrame | None, by: str) -> DataFrame:
    """success, low_quality, skipped or failed for each data set, by what it ended with."""
    rows = plans.select(by, "route").join(table.groupBy(by).agg(F.sum("count").alias("reads")), by, "left")
    rows = rows.join(skipped.withColumn("skipped", F.lit(True)), by, "left")
    rows = rows.join(final, by, "left") if final is not None else rows.withColumn("verdict", F.lit(None).cast("string"))
    status = F.when(F.col("route") == "failed", "failed").when(F.col("skipped"), "skipped").when(F.col("verdict") == "low_quality", "low_quality")
    return rows.select(by, "route", F.coalesce("reads", F.lit(0)).alias("reads"), status.when(F.col("reads") > 0, "success").otherwise("failed").alias("status"))


def _summary(reads: DataFrame, table: DataFrame, by: str) -> DataFrame:
    """Raw and final reads of each sample; a pair counts once."""
    raw = _first_mates(reads).groupBy(by, "sample_id").agg(F.count(F.lit(1)).alias("raw_reads"))
    final = table.groupBy(by, "sample_id").agg(F.sum("count").alias("final_reads"))
    return raw.join(final, [by, "sample_id"], "left").na.fill(0, ["final_reads"])
