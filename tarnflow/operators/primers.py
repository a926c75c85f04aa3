"""Primer detection from base frequencies, and trimming with mates in mixed orientation.

All is grouped by data set: a data set's matrix has 60 rows, so after the first aggregation the data are
small and the decision ladder is one projection over many data sets at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tarnflow.functions import sequence as S
from tarnflow.schema import BASES, COMPLEMENT

MATRIX, CEILING, LEAST = 60, 30, 10
IDENTITY, INFORMATIVE, D_SHARE = 0.85, 0.5, 0.25
MIXED_POSITIONS, MIXED_SHARE = 15, 0.5


def frequencies() -> Column:
    return F.array(*[F.col(f"f_{b}") for b in BASES])


def position_states(matrix: DataFrame, by: list[str]) -> DataFrame:
    """Class and most frequent base of each position."""
    return matrix.select(*by, "pos", S.position_class(frequencies()).alias("state"), S.top_base(frequencies()).alias("top"), *[f"f_{b}" for b in BASES])


def profiles(matrix: DataFrame, by: list[str]) -> DataFrame:
    """Each group's ``states`` as a string, and its ``consensus`` of the first 30 positions with N where not conserved."""
    rows = position_states(matrix, by)
    letter = F.when(F.col("state") == "C", F.col("top")).otherwise("N")
    cells = F.array_sort(F.collect_list(F.struct("pos", "state", letter.alias("letter"))))  # 60 rows a group
    found = rows.groupBy(*by).agg(cells.alias("cells"))
    text = lambda f: F.array_join(F.transform("cells", lambda c: c[f]), "")
    return found.select(*by, text("state").alias("states"), F.left(text("letter"), F.lit(CEILING)).alias("consensus"))


def boundary(states: Column) -> Column:
    """Length of the primer at the front: C and D, and runs of one or two V between three others on each side.

    Scanning stops at position 30, but a tolerated run that begins before it counts whole. Below 10: 0.
    """
    run = F.length(F.regexp_extract(states, r"^(?:[CD]|(?<=[CD]{3})V{1,2}(?=[CD]{3}))*", 0))
    beyond = F.when(F.substring(states, CEILING, 2) == "VV", F.lit(CEILING + 1)).otherwise(F.lit(CEILING))
    end = F.when(run > CEILING, beyond).otherwise(run)
    return F.when(end < LEAST, F.lit(0)).otherwise(end)


def d_share(states: Column, length: Column) -> Column:
    """Share of degenerate positions in the front part."""
    front = F.substr(states, F.lit(1), length)
    return (length - F.length(F.replace(front, F.lit("D"), F.lit("")))) / F.nullif(length, F.lit(0))


def primer_table(spark: SparkSession, primers: list[tuple[str, str]]) -> DataFrame:
    """The primers both ways: ``ord`` for ties, ``name`` (with _RC when reversed) and ``primer``."""
    rows = spark.createDataFrame([(i, n, p) for i, (n, p) in enumerate(primers)], "i int, name string, primer string")
    forward = rows.select((F.col("i") * 2).alias("ord"), "name", "primer")
    reverse = rows.select((F.col("i") * 2 + 1).alias("ord"), F.concat("name", F.lit("_RC")).alias("name"), S.reverse_complement(F.col("primer")).alias("primer"))
    return forward.unionAll(reverse)


def match_primers(found: DataFrame, by: list[str], primers: DataFrame) -> DataFrame:
    """The best primer for each group's consensus, at any offset, if its identity is high enough.

    Positions where the consensus has N don't count; at least half the primer must count. Of equal
    identities the first in order of primer, direction and offset wins. ``primers`` is a fixed small table.
    """
    rows = found.select(*by, "consensus").crossJoin(F.broadcast(primers))  # a row a data set by some twenty primers
    offsets = F.sequence(F.lit(0), F.length("consensus") - F.length("primer"))
    rows = rows.where(F.length("consensus") >= F.length("primer")).withColumn("offset", F.explode(offsets))
    pairs = F.transform(
        F.sequence(F.lit(1), F.length("primer")),
        lambda i: F.struct(F.substr(F.col("consensus"), F.col("offset") + i, F.lit(1)).alias("c"), F.substr(F.col("primer"), i, F.lit(1)).alias("p")),
    )
    counted = F.filter(pairs, lambda x: x["c"] != "N")
    same = F.filter(counted, lambda x: S.iupac_mask(x["c"]).bitwiseAND(S.iupac_mask(x["p"])) != 0)
    rows = rows.withColumns({"informative": F.size(counted), "identity": F.size(same) / F.nullif(F.size(counted), F.lit(0))})
    good = rows.where((F.col("informative") >= INFORMATIVE * F.length("primer")) & (F.col("identity") >= IDENTITY))
    best = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("identity"), "ord", "offset"))
    return good.withColumn("__n", best).where("__n = 1").select(*by, "name", "primer", F.col("offset").cast("long").alias("offset"), "identity", (F.col("offset") + F.length("primer")).cast("long").alias("trim"))


def detect(matrix: DataFrame, by: list[str], primers: DataFrame) -> DataFrame:
    """By group ``detected``, ``primer``, ``trim`` and ``reason``; every group gets a row.

    A known primer decides; else a boundary at the ceiling, or too many degenerate positions, mean that the
    front is conserved for another reason; else the boundary is an unknown primer's length, if there is one.
    """
    found = profiles(matrix, by)
    known = match_primers(found, by, primers)
    rows = found.join(known, by, "left").withColumn("boundary", boundary(F.col("states")).cast("long"))
    rows = rows.withColumn("d_share", F.coalesce(d_share(F.col("states"), F.col("boundary").cast("int")), F.lit(0.0)))
    reason = (
        F.when(F.col("name").isNotNull(), "known")
        .when(F.col("boundary") >= CEILING, "ceiling")
        .when(F.col("d_share") > D_SHARE, "degenerate")
        .when(F.col("boundary") > 0, "unknown")
        .otherwise("none")
    )
    rows = rows.withColumn("reason", reason)
    trim = F.when(F.col("reason") == "known", F.col("trim")).when(F.col("reason") == "unknown", F.col("boundary")).otherwise(0)
    name = F.when(F.col("reason") == "known", F.col("name")).when(F.col("reason") == "unknown", "unknown")
    return rows.select(*by, F.col("reason").isin("known", "unknown").alias("detected"), name.alias("primer"), trim.cast("long").alias("trim"), "reason", "boundary", "consensus")


def mixed_orientation(matrix: DataFrame, by: list[str]) -> DataFrame:
    """Whether reads of both directions are mixed: most of the first 15 positions have two bases.

    ``best_pos`` is where the second base is most frequent, the first such position; its two bases are ``major``
    and ``minor``.
    """
    order = F.sort_array(frequencies(), asc=False)
    front = matrix.where(F.col("pos") < MIXED_POSITIONS).withColumns({"two": S.is_bimodal(frequencies()), "second": order[1]})
    ranked = F.array_sort(F.array(*[F.struct((-F.col(f"f_{b}")).alias("f"), F.lit(i).alias("i")) for i, b in enumerate(BASES)]))
    letters = F.array(*map(F.lit, BASES))
    front = front.withColumns({"major": F.get(letters, ranked[0]["i"]), "minor": F.get(letters, ranked[1]["i"])})
    best = F.max_by(F.struct("pos", "major", "minor"), F.struct(F.when(F.col("two"), F.col("second")).otherwise(-1.0), -F.col("pos")))
    share = F.avg(F.col("two").cast("double"))
    found = front.groupBy(*by).agg(share.alias("ratio"), best.alias("b"))
    mixed = F.col("ratio") > MIXED_SHARE
    return found.select(*by, F.round("ratio", 6).alias("ratio"), mixed.alias("mixed"), *[F.when(mixed, F.col(f"b.{c}")).alias(n) for c, n in (("pos", "best_pos"), ("major", "major"), ("minor", "minor"))])


def split_orientation(reads: DataFrame, mixed: DataFrame, by: list[str]) -> DataFrame:
    """``reads`` with ``minority``: whether the base at the best position is the second one; short reads are not."""
    rows = reads.join(mixed.select(*by, "best_pos", "minor"), by)
    return rows.withColumn("minority", F.coalesce(S.base_at(F.upper("seq"), F.col("best_pos").cast("int")) == F.col("minor"), F.lit(False))).drop("best_pos", "minor")


def trim_mixed_pairs(pairs: DataFrame, mixed: DataFrame, by: list[str], forward: Column | int, reverse: Column | int) -> DataFrame:
    """Pairs whose first mate has another base than the majority's at the best position are swapped, then both are cut.

    A first mate that doesn't reach the position is not swapped.
    """
    rows = pairs.join(mixed.select(*by, "best_pos", "major"), by)
    long_enough = F.length("seq1") > F.col("best_pos")
    flip = F.coalesce(long_enough & (S.base_at(F.upper("seq1"), F.col("best_pos").cast("int")) != F.col("major")), F.lit(False))
    rows = rows.withColumn("flipped", flip)

    def pick(a: str, b: str, n: Column | int) -> Column:
        chosen = F.when(F.col("flipped"), F.col(b)).otherwise(F.col(a))
        return F.substr(chosen, F.lit(n) + 1 if isinstance(n, int) else n + 1, F.length(chosen))

    cut = {"seq1": pick("seq1", "seq2", forward), "qual1": pick("qual1", "qual2", forward), "seq2": pick("seq2", "seq1", reverse), "qual2": pick("qual2", "qual1", reverse)}
    return rows.withColumns(cut).drop("best_pos", "major")


def primer_info(found: DataFrame, by: list[str], mode: str) -> DataFrame:
    """The decision as JSON, also where no primer was found."""
    primer = F.struct(F.col("primer").alias("name"), "consensus", F.col("trim").alias("length"), "detected")
    return found.select(*by, F.to_json(F.struct(F.lit(mode).alias("mode"), primer.alias("forward_primer"))).alias("primer_info"))


def extract_region(seqs: DataFrame, forward: str, reverse: str, lengths: tuple[int, int]) -> DataFrame:
    """The stretch between a forward primer and the reverse complement of the reverse one, on either strand.

    Sequences without both primers, or with a stretch of another length, drop out; ``region`` is the stretch.
    """
    pattern = f"{S.iupac_regex(forward)}([A-Za-z]*?){S.iupac_regex(_reverse_complement(reverse))}"
    plus = F.regexp_extract(F.upper("seq"), pattern, 1)
    minus = F.regexp_extract(F.upper(S.reverse_complement(F.col("seq"))), pattern, 1)
    region = F.when(plus != "", plus).otherwise(minus)
    return seqs.withColumn("region", region).where(F.length("region").between(*lengths))


def _reverse_complement(primer: str) -> str:
    return primer.translate(str.maketrans(*COMPLEMENT))[::-1]
