"""Trim positions, adaptive tail trim and the preprocessing of reads with degraded qualities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tarnflow.functions import sequence as S
from tarnflow.operators import reads as R

# Thresholds of the trim calculator: quality, smoothing width and run, least retained length, least end.
QUALITY, WIDTH, RETAINED, LEAST_END = 25, 5, 50, 40
# Of the tail trim: background offsets, its factor, the least threshold, the longest cut.
BACKGROUND, FACTOR, LEAST_SHARE, LONGEST = (25, 44), 3, 0.01, 30
# Of the degraded preprocessing: cut at the front, most N, least length, files and reads that set the length.
FRONT, MOST_N, LEAST, FILES, PER_FILE = 15, 1, 50, 5, 2000


def trim_positions(quantiles: DataFrame, by: list[str]) -> DataFrame:
    """``start`` and ``end`` of the good stretch from per-position counts and 25 % quantiles; null if there is none.

    The outer bound is the first position whose count falls below min(9000, 70 % of the largest), position 40
    at least, the last one at most. Quantiles are smoothed forward over five positions; five good ones in a
    row open the stretch, the last such five close it.
    """
    own = Window.partitionBy(*by)
    order = own.orderBy("pos")
    bound = F.least(F.lit(9000.0), F.max("reads").over(own) * 0.7)
    rows = quantiles.withColumns({"__low": F.col("reads") < bound, "__last": F.max("pos").over(own)})
    outer = F.least(F.greatest(F.coalesce(F.min(F.when(F.col("__low"), F.col("pos"))).over(own), F.col("__last")), F.lit(LEAST_END)), F.col("__last"))
    ahead = order.rowsBetween(0, WIDTH - 1)
    smooth = F.when(F.count("q25").over(ahead) == WIDTH, F.avg("q25").over(ahead))
    rows = rows.withColumns({"__outer": outer, "__smooth": smooth})
    good = lambda frame: (F.count("__smooth").over(frame) == WIDTH) & (F.min("__smooth").over(frame) >= QUALITY)
    rows = rows.withColumns({"__opens": good(ahead), "__closes": good(order.rowsBetween(1 - WIDTH, 0))})
    first = F.min(F.when(F.col("__opens") & (F.col("pos") <= F.col("__outer") - WIDTH), F.col("pos")))
    last = F.max(F.when(F.col("__closes") & (F.col("pos") <= F.least(F.col("__outer"), F.col("__last") + 1 - WIDTH)) & (F.col("pos") >= WIDTH), F.col("pos")))
    found = rows.groupBy(*by).agg(first.alias("start"), last.alias("end"))
    whole = F.col("end") - F.col("start") >= RETAINED
    return found.select(*by, F.when(whole, F.col("start")).alias("start"), F.when(whole, F.col("end")).alias("end"))


def tail_trim(profile: DataFrame, by: list[str]) -> DataFrame:
    """Length to cut at the 3' end of each group: the leading run of positions with more N than three times the background."""
    inner = (F.col("pos").between(*BACKGROUND)) & (F.col("coverage") > 0)
    ground = profile.groupBy(*by).agg(F.coalesce(F.avg(F.when(inner, F.col("n_freq"))), F.lit(0.0)).alias("background"))
    limit = ground.withColumn("threshold", F.greatest(F.col("background") * FACTOR, F.lit(LEAST_SHARE)))
    run = profile.join(limit, by).groupBy(*by).agg(
        F.first("background").alias("background"),
        F.first("threshold").alias("threshold"),
        F.least(F.coalesce(F.min(F.when(F.col("n_freq") <= F.col("threshold"), F.col("pos"))), F.count(F.lit(1))), F.lit(LONGEST)).alias("trim"),
    )
    return run


def cut_tail(reads: DataFrame, n: Column) -> DataFrame:
    """Reads longer than ``n`` lose so many letters at the end."""
    cut = lambda c: F.when(F.length(c) > n, F.substr(F.col(c), F.lit(1), F.length(c) - n)).otherwise(F.col(c))
    return reads.withColumns({c: cut(c) for c in ("seq", "qual")})


def adaptive_tail_trim(reads: DataFrame, by: list[str]) -> tuple[DataFrame, DataFrame]:
    """The trimmed reads, and by group the cut and ``max_ambiguous``, the whole part of the 95th percentile of N."""
    trims = tail_trim(R.tail_profile(reads, by), by)
    trimmed = cut_tail(reads.join(trims.select(*by, "trim"), by), F.col("trim")).drop("trim")
    counts = trimmed.groupBy(*by, S.count_letter(F.col("seq"), "N").alias("n")).agg(F.count(F.lit(1)).alias("reads"))
    most = counts.groupBy(*by).agg(F.floor(F.percentile("n", 0.95, F.col("reads")) + 1e-9).alias("max_ambiguous"))
    return trimmed, trims.join(most, by)


def truncation_length(reads: DataFrame, by: list[str], file: str) -> DataFrame:
    """The whole part of the 10th percentile of what is left behind the front, over the first reads of the first files."""
    ranked = reads.select(*by, file).distinct().withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(file))).where(F.col("rank") <= FILES)
    first = R.first_reads(reads.join(ranked.drop("rank"), [*by, file], "left_semi"), [*by, file], PER_FILE)
    left = first.withColumn("left", F.length("seq") - FRONT).where("left > 0")
    return left.groupBy(*by).agg(F.floor(F.percentile("left", 0.1) + 1e-9).alias("trunc"))


def degraded_verdict(trunc: Column) -> Column:
    """short, ambiguous or kept: the rules in their order."""
    cut = F.substr(F.col("seq"), F.lit(FRONT + 1), F.greatest(trunc, F.lit(0)))
    short = F.length("seq") - FRONT < F.greatest(trunc, F.lit(LEAST))
    return F.when(short, "short").when(S.count_letter(cut, "N") > MOST_N, "ambiguous").otherwise("kept")


def degraded_preprocess(reads: DataFrame, by: list[str], file: str) -> DataFrame:
    """Reads cut at the front and truncated to their group's length; ``verdict`` says why others are to go."""
    lengths = truncation_length(reads, by, file)
    rows = reads.join(lengths, by).withColumn("verdict", degraded_verdict(F.col("trunc")))
    kept = lambda c: F.when(F.col("verdict") == "kept", F.substr(F.col(c), F.lit(FRONT + 1), F.col("trunc").cast("int")))
    return rows.withColumns({"seq": kept("seq"), "qual": kept("qual")})
