"""Operators over reads: ``seq`` and ``qual`` strings with keys. Groups are datasets, samples or files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tarnflow.functions import sequence as S
from tarnflow.operators import letters as L

#: Least length, mean quality, complexity and entropy of a read that counts for primer detection.
LEAST_LENGTH, LEAST_QUALITY, LEAST_COMPLEXITY, LEAST_ENTROPY = 50, 20, 0.3, 1.0


def scored(reads: DataFrame) -> DataFrame:
    """``reads`` with length, mean quality, complexity, entropy and number of N."""
    seq, qual = F.col("seq"), F.col("qual")
    return reads.withColumns(
        {
            "seq_len": F.length(seq).cast("long"),
            "avg_q": S.mean_quality(qual),
            "complexity": S.complexity(seq),
            "entropy": S.entropy(seq),
            "n_count": S.count_letter(seq, "N").cast("long"),
        }
    )


#: The gate's rules in the order in which they are tried: least value and name of what falls below it.
RULES = {"length": (LEAST_LENGTH, "short"), "quality": (LEAST_QUALITY, "low_quality"), "complexity": (LEAST_COMPLEXITY, "low_complexity"), "entropy": (LEAST_ENTROPY, "low_entropy")}


def reject_reason(check_quality: bool = True) -> Column:
    """The first rule that a read breaks, or kept. The rules are tried in the order length to entropy.

    The scores are those of ``scored``, counted over whole Arrow batches at once.
    """
    least, names = ({k: v[i] for k, v in RULES.items()} for i in (0, 1))
    return L.first_broken(F.col("seq"), F.col("qual") if check_quality else None, least, names)


def quality_gate(reads: DataFrame, check_quality: bool = True) -> DataFrame:
    return reads.where(reject_reason(check_quality) == "kept")


def reject_histogram(reads: DataFrame, by: list[str], check_quality: bool = True) -> DataFrame:
    return reads.groupBy(*by, reject_reason(check_quality).alias("reason")).agg(F.count(F.lit(1)).alias("reads"))


def dereplicate(reads: DataFrame, by: list[str], least: int = 1) -> DataFrame:
    """Unique upper-cased sequences with their number, the header of the first read, and those of at least ``least`` reads."""
    label = F.min_by("header", F.struct("read_idx", "header")).alias("header")
    found = reads.groupBy(*by, F.upper("seq").alias("seq")).agg(F.count(F.lit(1)).alias("size"), F.min("read_idx").alias("first_idx"), label)
    return found.where(F.col("size") >= least) if least > 1 else found


def base_frequencies(reads: DataFrame, by: list[str], first: int = 60) -> DataFrame:
    """Shares of A, C, G and T at each of the first positions; 0.25 each where no read has one of them."""
    is_base = lambda b: F.col("code").isin(ord(b), ord(b.lower()))
    counts = L.letter_counts(reads, by, "seq", first).groupBy(*by, "pos").agg(*[F.coalesce(F.sum(F.when(is_base(b), F.col("n"))), F.lit(0)).alias(f"n_{b}") for b in "ACGT"])
    grid = counts.where("pos = -1").select(*by).withColumn("pos", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(first - 1).cast("long"))))
    total = F.nullif(F.expr("n_A + n_C + n_G + n_T"), F.lit(0))
    shares = [F.coalesce(F.col(f"n_{b}") / total, F.lit(0.25)).alias(f"f_{b}") for b in "ACGT"]
    return _on_grid(grid, counts, by).select(*by, "pos", *shares)


def _on_grid(grid: DataFrame, counts: DataFrame, by: list[str]) -> DataFrame:
    """``counts`` at all places of the grid, also where a group's key is null."""
    same = [F.col(f"g.{c}").eqNullSafe(F.col(f"c.{c}")) for c in (*by, "pos")]
    rest = [c for c in counts.columns if c not in (*by, "pos")]
    return grid.alias("g").join(counts.alias("c"), same, "left").select("g.*", *[f"c.{c}" for c in rest])


def tail_profile(reads: DataFrame, by: list[str], window: int = 50) -> DataFrame:
    """Coverage and share of N at each position from the 3' end, 0 without coverage."""
    n = F.when(F.col("code").isin(ord("N"), ord("n")), F.col("n")).otherwise(0)
    counts = L.letter_counts(reads, by, "seq", window, from_end=True).groupBy(*by, "pos").agg(F.sum("n").alias("coverage"), F.sum(n).alias("n"))
    grid = counts.where("pos = -1").select(*by).withColumn("pos", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(window - 1).cast("long"))))
    return _on_grid(grid, counts, by).select(*by, "pos", F.coalesce("coverage", F.lit(0)).alias("coverage"), F.coalesce(F.col("n") / F.col("coverage"), F.lit(0.0)).alias("n_freq"))


def quality_quantiles(reads: DataFrame, by: list[str]) -> DataFrame:
    """Exact quantiles of the Phred scores at each position (linear interpolation), and the reads that reach it."""
    # Scores are small whole numbers: percentiles over counts by score keep the shuffle at a bounded number of rows.
    counted = L.letter_counts(reads, by, "qual").where("pos >= 0").groupBy(*by, "pos", (F.col("code") - 33).alias("q")).agg(F.sum("n").alias("n"))
    named = {"q02": 0.02, "q09": 0.09, "q25": 0.25, "q50": 0.5, "q75": 0.75, "q91": 0.91, "q98": 0.98}
    quantiles = F.percentile("q", F.array(*map(F.lit, named.values())), F.col("n")).alias("all")
    out = counted.groupBy(*by, "pos").agg(F.sum("n").alias("reads"), quantiles)
    return out.select(*by, "pos", "reads", *[F.col("all")[i].alias(k) for i, k in enumerate(named)])


def distinct_qualities(reads: DataFrame, by: list[str], file: str, files: int = 3, per_file: int = 1000) -> DataFrame:
    """Different quality letters in the first reads of the first files by name; degraded data have one at most."""
    ranked = reads.select(*by, file).distinct().withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(file))).where(F.col("rank") <= files)
    order = Window.partitionBy(*by, file).orderBy("read_idx")
    first = reads.join(ranked.drop("rank"), [*by, file], "left_semi").withColumn("n", F.row_number().over(order)).where(F.col("n") <= per_file)
    letters = first.select(*by, F.explode(F.array_distinct(F.split("qual", ""))).alias("c")).where("c <> ''")
    found = letters.groupBy(*by).agg(F.count_distinct("c").alias("letters"))
    return reads.select(*by).distinct().join(found, by, "left").select(*by, F.coalesce("letters", F.lit(0)).alias("letters"), (F.coalesce("letters", F.lit(0)) <= 1).alias("degraded"))


def first_reads(reads: DataFrame, by: list[str], n: int) -> DataFrame:
    """The first ``n`` reads of each group in file order; all if ``n`` is 0."""
    if not n:
        return reads
    return reads.withColumn("__n", F.row_number().over(Window.partitionBy(*by).orderBy("read_idx"))).where(F.col("__n") <= n).drop("__n")


def numbered(reads: DataFrame, sample: str = "sample_id") -> DataFrame:
    """Labels ``sample_n;sample=sample;`` by the order of each sample's reads from 1."""
    n = F.row_number().over(Window.partitionBy(sample).orderBy("read_idx"))
    return reads.withColumn("label", F.concat(F.col(sample), F.lit("_"), n.cast("string"), F.lit(";sample="), F.col(sample), F.lit(";")))


def sanitized(reads: DataFrame, least: int = LEAST_LENGTH) -> DataFrame:
    return reads.where(F.length("seq") >= least)


def paired(first: DataFrame, second: DataFrame, keys: list[str]) -> DataFrame:
    """Mates with the same keys: ``seq1``, ``qual1``, ``seq2``, ``qual2``. Reads without a mate drop out."""
    a = first.select(*keys, F.col("seq").alias("seq1"), F.col("qual").alias("qual1"))
    return a.join(second.select(*keys, F.col("seq").alias("seq2"), F.col("qual").alias("qual2")), keys)


def sanitized_pairs(pairs: DataFrame, least: int = LEAST_LENGTH) -> DataFrame:
    """A pair stays if both mates are long enough."""
    return pairs.where((F.length("seq1") >= least) & (F.length("seq2") >= least))


def cut_front(reads: DataFrame, n: Column | int) -> DataFrame:
    n = F.lit(n) if isinstance(n, int) else n
    return reads.withColumns({c: F.substr(F.col(c), n + 1, F.length(c)) for c in ("seq", "qual")})


def quality_filtered(reads: DataFrame, least_q: int, share: float, most_n: int, window: int = 3) -> DataFrame:
    """Truncation before the first run of more than ``window`` scores below ``least_q``; a read stays if at least
    ``share`` of it is left and it has ``most_n`` N at most."""
    low = F.transform(F.split("qual", ""), lambda c: F.when(F.ascii(c) - 33 < least_q, "l").otherwise("h"))
    at = F.instr(F.array_join(low, ""), "l" * (window + 1))
    kept = F.when((at == 0) | (F.length("qual") == 0), F.length("seq")).otherwise(at - 1)
    cut = reads.withColumns({"__len": F.length("seq"), "__keep": kept})
    cut = cut.withColumns({c: F.substr(F.col(c), F.lit(1), F.col("__keep")) for c in ("seq", "qual")})
    return cut.where((F.col("__keep") >= F.col("__len") * share) & (S.count_letter(F.col("seq"), "N") <= most_n)).drop("__len", "__keep")


#: Least score, least share of the length and most N by route (fixed values).
FILTERS = {"ls454": (0, 0.85, None), "ion_torrent": (0, 0.85, 0), "illumina_degraded": (0, 0.85, 1), "pacbio": (0, 0.9, None), "illumina": (20, 0.75, 0)}


def filtered_for(reads: DataFrame, route: str, by: list[str]) -> DataFrame:
    """``quality_filtered`` with a route's values; where no number of N is fixed it is the group's 95th percentile."""
    least, share, most = FILTERS[route]
    if most is not None:
        return quality_filtered(reads, least, share, most)
    counts = reads.groupBy(*by, S.count_letter(F.col("seq"), "N").alias("n")).agg(F.count(F.lit(1)).alias("reads"))
    limits = counts.groupBy(*by).agg(F.floor(F.percentile("n", 0.95, F.col("reads")) + 1e-9).alias("__most"))
    kept = quality_filtered(reads, least, share, 1 << 30).join(limits, by)
    return kept.where(S.count_letter(F.col("seq"), "N") <= F.col("__most")).drop("__most")


def fastq_integrity(lines: DataFrame, file: str = "file") -> DataFrame:
    """Files of text lines: their number, and whether it is positive and a multiple of four."""
    n = F.count(F.lit(1))
    return lines.groupBy(file).agg(n.alias("lines"), ((n > 0) & (n % 4 == 0)).alias("whole"))


def raw_counts(reads: DataFrame, sample: str = "sample_id") -> DataFrame:
    return reads.groupBy(sample).agg(F.count(F.lit(1)).alias("raw_reads"))


def total_raw_reads(counts: DataFrame) -> DataFrame:
    """All raw reads of the samples' counts, one row."""
    return counts.agg(F.coalesce(F.sum("raw_reads"), F.lit(0)).alias("total_raw_reads"))


def total_raw_reads_by(reads: DataFrame, by: list[str]) -> DataFrame:
    """Raw reads by group, mates counted each."""
    return reads.groupBy(*by).agg(F.count(F.lit(1)).alias("raw_reads"))


def n_histogram(reads: DataFrame, by: list[str], first: int = 10) -> DataFrame:
    """Reads by their number of N for the ``first`` numbers that occur, with their share in percent."""
    counts = reads.groupBy(*by, S.count_letter(F.col("seq"), "N").cast("long").alias("n_count")).agg(F.count(F.lit(1)).alias("reads"))
    own = Window.partitionBy(*by)
    ranked = counts.withColumns({"rank": F.row_number().over(own.orderBy("n_count")), "share": F.round(F.col("reads") * 100 / F.sum("reads").over(own), 4)})
    return ranked.where(F.col("rank") <= first).drop("rank")


def long_read_share(reads: DataFrame, by: list[str], first: int = 1000, length: int = 1400) -> DataFrame:
    """Of each group's first reads, the share of those longer than ``length``; full-length data have above half."""
    share = F.avg((F.length("seq") > length).cast("double"))
    return first_reads(reads, by, first).groupBy(*by).agg(share.alias("share"), (share > 0.5).alias("full_length"))
