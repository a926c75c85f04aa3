"""Operators over metadata tables: identifiers, column cleaning, joins of sources, states and selections.

Metadata are tables of strings whose columns come and go, so operators that look at all columns use one
aggregate over the table and then a plain projection.
"""

from __future__ import annotations

import functools
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tarnflow.functions.text import camel, norm_null
from tarnflow.schema import CONTENT_PATTERNS, PRIORITY_COLUMNS, ROUTES, RUN, SOURCE_PREFIXES, SOURCE_SUFFIXES
from tarnflow.session import broadcast_if_small, stage

# ---- identifiers -----------------------------------------------------------------------------------------------


def classify(value: Column) -> Column:
    """biosample, cncb, ncbi or unknown, by the first pattern that the trimmed identifier follows."""
    rule = F
    for name, pattern in ROUTES.items():
        rule = rule.when(F.trim(value).rlike(pattern), name)
    return rule.otherwise("unknown")


def has_runs(table: DataFrame, by: list[str], run: str = "Run") -> DataFrame:
    """Whether any row of a group has a run accession."""
    return table.groupBy(*by).agg(F.coalesce(F.bool_or(F.trim(run).rlike(RUN)), F.lit(False)).alias("valid"))


def keep_first(table: DataFrame, keys: list[str], order: str = "ord") -> DataFrame:
    """The first row of each key by an explicit order, found by an aggregate that combines before it shuffles."""
    row = F.struct(*[F.col(f"`{c}`") for c in table.columns])
    return table.groupBy(*keys).agg(F.min_by(row, order).alias("__row")).select("__row.*")


def id_list(lines: DataFrame) -> DataFrame:
    """Identifiers of text lines (``file``, ``ord``, ``value``): trimmed, without blanks and comments, first ones kept."""
    bare = lines.withColumn("id", F.trim("value")).where((F.col("id") != "") & ~F.col("id").startswith("#"))
    first = bare.groupBy("id").agg(F.min(F.struct("file", "ord")).alias("at"))
    return first.select("id", F.col("at.file").alias("file"), F.col("at.ord").alias("ord"))


def stripped(table: DataFrame, columns: list[str]) -> DataFrame:
    """Without any space, line break or tab in the key columns."""
    return table.withColumns({c: F.regexp_replace(c, r"[ \n\t]", "") for c in columns})


def rename_key(project: Column, biosample: Column, run: Column) -> Column:
    """``project_biosample``, or ``project_run`` without a biosample."""
    return F.concat(project, F.lit("_"), F.coalesce(norm_null(biosample), run))


def accessions(table: DataFrame, column: str = "accession") -> DataFrame:
    return table.where(F.col(column).isNotNull() & F.col(column).startswith("PRJ"))


def tagged(table: DataFrame, project: str, source: str) -> DataFrame:
    """The requested project in place of the table's own, and the source's name."""
    return table.withColumns({"BioProject": F.lit(project), "Source_Database": F.lit(source)})


#: Platforms by words of the upper-cased text, in the order in which they are tried (fixed values).
PLATFORM_WORDS = [
    ("ILLUMINA", ["ILLUMINA", "HISEQ", "NOVASEQ", "MISEQ"]),
    ("OXFORD_NANOPORE", ["NANOPORE", "MINION", "PROMETHION"]),
    ("PACBIO_SMRT", ["PACBIO", "SEQUEL"]),
    ("ION_TORRENT", ["ION", "TORRENT"]),
    ("LS454", ["454", "ROCHE"]),
]


def platform(*texts: Column) -> Column:
    """The platform that the first non-null text names, or the text itself in upper case."""
    text = F.upper(F.coalesce(*texts))
    rule = F
    for name, words in PLATFORM_WORDS:
        rule = rule.when(functools.reduce(lambda a, b: a | b, [F.contains(text, F.lit(w)) for w in words]), name)
    return rule.otherwise(text)


def route(platform_name: Column, degraded: Column) -> Column:
    """The processing that a platform's data take."""
    return (
        F.when((platform_name == "ILLUMINA") & degraded, "illumina_degraded")
        .when(platform_name == "ILLUMINA", "illumina")
        .when(platform_name == "LS454", "ls454")
        .when(platform_name == "ION_TORRENT", "ion_torrent")
        .when(platform_name == "PACBIO_SMRT", "pacbio")
        .when(platform_name == "OXFORD_NANOPORE", "unsupported")
        .otherwise("failed")
    )


# ---- columns ---------------------------------------------------------------------------------------------------


def column_profile(table: DataFrame, id_col: str | None = None) -> dict[str, dict]:
    """For each column, by one aggregate over the table: values that aren't blank, a content fingerprint, and the
    accession patterns that all of them follow. ``id_col`` names rows for the fingerprint; else the row's hash does."""
    row = F.xxhash64(F.col(f"`{id_col}`")) if id_col else F.xxhash64(*[F.col(f"`{c}`") for c in table.columns])
    parts = []
    for i, c in enumerate(table.columns):
        value = norm_null(F.col(f"`{c}`"))
        cell = F.xxhash64(row, F.coalesce(F.trim(F.col(f"`{c}`").cast("string")), F.lit("nan")))
        parts += [F.count(value).alias(f"n{i}"), F.bit_xor(cell).alias(f"x{i}"), F.sum(F.shiftright(cell, 16)).alias(f"s{i}")]
        parts += [F.coalesce(F.bool_and(value.rlike(p)), F.lit(False)).alias(f"p{i}_{k}") for k, p in enumerate(CONTENT_PATTERNS.values())]
    got = table.agg(*parts).first()
    names = list(CONTENT_PATTERNS)
    return {c: {"values": got[f"n{i}"], "print": (got[f"x{i}"], got[f"s{i}"]), "follows": [names[k] for k in range(len(names)) if got[f"p{i}_{k}"]]} for i, c in enumerate(table.columns)}


def without_empty_and_repeated(table: DataFrame, id_col: str | None = None) -> DataFrame:
    """Without columns of blanks only, and without columns whose content an earlier one has."""
    seen, kept = set(), []
    for c, p in column_profile(table, id_col).items():
        if p["values"] and p["print"] not in seen:
            seen.add(p["print"])
            kept.append(c)
    return table.select(*[F.col(f"`{c}`") for c in kept])


def cleaned_names(profile: dict[str, dict]) -> list[tuple[str, str]]:
    """(old, new) names: source prefixes and suffixes go, a leading ID column goes, content that follows an accession
    pattern names its column, and accession columns come first."""
    kept, seen = [], set()
    for c, p in profile.items():
        if p["values"] and p["print"] not in seen:
            seen.add(p["print"])
            kept.append((c, re.sub(SOURCE_SUFFIXES, "", re.sub(SOURCE_PREFIXES, "", c))))
    if kept and kept[0][1] == "ID":
        kept = kept[1:]
    used = {new for _, new in kept}
    named = []
    for old, new in kept:
        for name in profile[old]["follows"]:
            if name not in used:
                used.add(name)
                new = name
                break
        named.append((old, new))
    first = [x for name in PRIORITY_COLUMNS for x in named if x[1] == name]
    return first + [x for x in named if x not in first]


def merged_value(target: Column, source: Column) -> Column:
    """One of two columns of one name: the one that isn't blank, the target if they agree in any case, else both."""
    a, b = norm_null(target), norm_null(source)
    return F.when(a.isNull(), b).when(b.isNull() | (F.lower(a) == F.lower(b)), a).otherwise(F.concat(a, F.lit("_"), b))


def standardized(table: DataFrame, dictionary: dict[str, str] | None = None, id_col: str | None = None) -> DataFrame:
    """The cleaned table: names by content, by dictionary (any case, unless taken) and in CamelCase; columns that end
    up with one name are merged."""
    names = cleaned_names(column_profile(table, id_col))
    known = {k.lower(): v for k, v in (dictionary or {}).items()}
    taken = {new for _, new in names}
    groups: dict[str, list[str]] = {}
    for old, new in names:
        standard = known.get(new.lower())
        if standard and standard not in taken:
            taken.add(standard)
            new = standard
        groups.setdefault(camel(new), []).append(old)
    merge = lambda cols: functools.reduce(merged_value, [F.col(f"`{c}`") for c in cols])
    return table.select(*[merge(cols).alias(name) for name, cols in groups.items()])


# ---- joins -----------------------------------------------------------------------------------------------------


PAIRS_A_TASK = 10_000_000  # of rows without a key


def full_join(left: DataFrame, right: DataFrame, key: str, suffix: str = "_biosample") -> DataFrame:
    """Full outer join in which null keys match each other; the right side's clashing columns take the suffix.

    Rows without a key are all pairs of such rows, which are dealt over tasks; as one key of a join they would be one task's.
    """
    clash = set(left.columns) & set(right.columns) - {key}
    renamed = right.select(F.col(key).alias("__key"), *[F.col(c).alias(c + suffix if c in clash else c) for c in right.columns if c != key])
    joined = left.where(F.col(key).isNotNull()).join(renamed.where("__key is not null"), F.col(key) == F.col("__key"), "full")
    a, b = stage(left.where(F.col(key).isNull()), "no-key-left"), stage(renamed.where("__key is null"), "no-key-right")
    pairs = a.count() * b.count()
    nulls = a.repartition(-(-pairs // PAIRS_A_TASK)).crossJoin(broadcast_if_small(b)) if pairs else a.unionByName(b, allowMissingColumns=True)
    joined = joined.unionByName(nulls)
    return joined.withColumn(key, F.coalesce(key, "__key")).drop("__key")


def dual_strategy_merge(left: DataFrame, right: DataFrame, order: str) -> tuple[DataFrame, str]:
    """Full join on BioSample, or on BioProject and BioSample, whichever matches more rows (ties: the former).

    ``origin`` tells both, left_only or right_only. The two counts come from one pass each.
    """
    a = left.withColumns({"__l": F.lit(True), "__pair": F.concat_ws("_", "bioproject", "biosample")})
    b = right.select(*[F.col(c).alias(c if c == "biosample" else f"{c}_r") for c in right.columns]).withColumns({"__r": F.lit(True), "__pair_r": F.concat_ws("_", "bioproject_r", "biosample")})
    simple = a.join(b.withColumnRenamed("biosample", "biosample_r"), a["biosample"].eqNullSafe(F.col("biosample_r")), "full")
    paired = a.join(b.withColumnRenamed("biosample", "biosample_r"), a["__pair"] == F.col("__pair_r"), "full")
    both = F.col("__l").isNotNull() & F.col("__r").isNotNull()
    counts = [x.agg(F.count_if(both)).first()[0] for x in (simple, paired)]
    chosen, name = (simple, "simple") if counts[0] >= counts[1] else (paired, "composite")
    origin = F.when(both, "both").when(F.col("__l").isNotNull(), "left_only").otherwise("right_only")
    return chosen.withColumns({"origin": origin, "biosample": F.coalesce("biosample", "biosample_r")}).drop("__l", "__r", "__pair", "__pair_r", "biosample_r"), name


def numbered(table: DataFrame, order: str, name: str = "pos") -> DataFrame:
    """Row numbers from 1 in a global order, without one task that gets all rows: range partitions, then offsets.

    The sorted table is written out once, so that row numbers within partitions and the offsets (one row a
    partition) agree whatever the range sampling does in another run.
    """
    spread = table.repartitionByRange(F.col(order)).sortWithinPartitions(order).withColumn("__m", F.monotonically_increasing_id())
    held = stage(spread, "numbered")
    part = F.shiftright("__m", 33)
    sizes = held.groupBy(part.alias("__p")).agg(F.count(F.lit(1)).alias("__c"))
    before = sizes.select("__p", F.coalesce(F.sum("__c").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__b"))
    joined = held.withColumn("__p", part).join(F.broadcast(before), "__p")
    return joined.withColumn(name, F.col("__b") + F.col("__m").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("__p", "__m", "__b")


def zipped(left: DataFrame, right: DataFrame, left_order: str, right_order: str) -> DataFrame:
    """Rows side by side by their position in each order; the longer side goes on alone."""
    a = numbered(left, left_order)
    b = numbered(right, right_order).withColumnRenamed("pos", "__pos")
    return a.join(b, a["pos"] == b["__pos"], "full").withColumn("pos", F.coalesce("pos", "__pos")).drop("__pos")


def zipped_if_equal(left: DataFrame, right: DataFrame, left_order: str, right_order: str) -> DataFrame:
    """``zipped`` if both have as many rows, else the left side alone."""
    return zipped(left, right, left_order, right_order) if left.count() == right.count() else numbered(left, left_order)


def looked_up(table: DataFrame, mapping: DataFrame, key: str, value: str) -> DataFrame:
    """The mapping's value of the key, or the key itself."""
    return table.join(mapping.select(key, F.col(value).alias("__v")), key, "left").withColumn(value, F.coalesce("__v", key)).drop("__v")


def cached_or_missing(runs: DataFrame, cache: DataFrame, key: str, value: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose value the cache has, and those that have to be asked for."""
    joined = runs.join(cache.select(key, value), key, "left")
    return joined.where(F.col(value).isNotNull()), joined.where(F.col(value).isNull()).drop(value)


def status_report(ids: DataFrame, states: DataFrame, key: str = "id", status: str = "status") -> DataFrame:
    """Every asked id with its state, unknown without one."""
    return ids.join(states.select(key, status), key, "left").withColumn(status, F.coalesce(status, F.lit("unknown")))


def status_counts(report: DataFrame, status: str = "status") -> DataFrame:
    return report.groupBy(status).agg(F.count(F.lit(1)).alias("n"))


def id_differences(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """How many ids only one side has."""
    a, b = left.select(key).distinct(), right.select(key).distinct()
    only = lambda x, y, name: x.join(y, key, "left_anti").agg(F.count(F.lit(1)).alias(name))  # noqa: E731  one row each
    return only(a, b, "left_only").crossJoin(only(b, a, "right_only"))


class InconsistentIds(ValueError):
    """Ids that should agree between two tables don't."""


def require_same_ids(left: DataFrame, right: DataFrame, key: str, subset: bool = False) -> None:
    """Raise if an id of the left side is missing on the right, or, unless ``subset``, the other way round."""
    got = id_differences(left, right, key).first()
    if got["left_only"] or (got["right_only"] and not subset):
        raise InconsistentIds(f"{got['left_only']} ids are only on the left, {got['right_only']} only on the right")


def semi(table: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return table.join(ids.select(key), key, "left_semi")


def split_by_ids(table: DataFrame, ids: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows with and without a listed id."""
    return semi(table, ids, key), table.join(ids.select(key), key, "left_anti")


def run_summary(runs: DataFrame, raw: DataFrame, final: DataFrame, paired: Column) -> DataFrame:
    """Runs with raw and final read counts, 0 where missing; pairs count once. The first raw count of a sample holds."""
    first = raw.groupBy("sample").agg(F.min_by("raw_reads", "ord").alias("raw_reads"))
    rows = runs.join(first, "sample", "left").join(final, "sample", "left")
    raw_reads = F.coalesce("raw_reads", F.lit(0))
    return rows.withColumns({"raw_reads": F.when(paired, F.floor(raw_reads / 2)).otherwise(raw_reads).cast("long"), "final_reads": F.coalesce("final_reads", F.lit(0)).cast("long")})


def pe_manifest(files: DataFrame) -> DataFrame:
    """Samples with a file for both mates; the last path of a mate in name order wins."""
    path = lambda m: F.max(F.when(F.col("mate") == m, F.col("path")))
    return files.groupBy("sample").agg(path(1).alias("forward"), path(2).alias("reverse")).where("forward is not null and reverse is not null")


def se_manifest(files: DataFrame) -> DataFrame:
    """Samples with their first file in order."""
    return keep_first(files, ["sample"]).select("sample", "path")


def keyword_product(spark: SparkSession, fields: list[str], organisms: list[str], options: list[str] | None = None) -> DataFrame:
    """Search expressions of every combination; the lists are a user's keywords."""
    part = lambda values, name: spark.createDataFrame([(v,) for v in values], f"{name} string")
    rows = part(fields, "field").crossJoin(part(organisms, "organism"))
    quoted = lambda c: F.concat(F.lit('("'), F.col(c), F.lit('")'))
    if options:
        rows = rows.crossJoin(part(options, "opt"))
    return rows.withColumn("query", F.concat_ws(" AND ", *[quoted(c) for c in rows.columns]))


def run_or_first(table: DataFrame, asked: DataFrame, group: str, run: str, order: str) -> DataFrame:
    """By group the row of the asked run, or its first row if the run isn't there."""
    joined = table.join(asked.select(group, F.col(run).alias("__run")), group)
    best = F.row_number().over(Window.partitionBy(group).orderBy(F.when(F.col(run) == F.col("__run"), 0).otherwise(1), order))
    return joined.withColumn("__n", best).where("__n = 1").drop("__n", "__run")


def last_project_of_run(table: DataFrame, answers: DataFrame, run: str, project: str, order: str) -> DataFrame:
    """Answers by run, with the last project that lists the run."""
    owner = table.where(F.col(run).isNotNull()).groupBy(run).agg(F.max_by(project, order).alias(project))
    return answers.join(owner, run)


# ---- selections ------------------------------------------------------------------------------------------------


def dataset_list(table: DataFrame, project: str, order: str = "ord") -> DataFrame:
    """Projects by their first appearance; rows without one don't count."""
    found = table.where(norm_null(F.col(project)).isNotNull()).groupBy(F.col(project)).agg(F.min(order).alias("first_ord"))
    return numbered(found, "first_ord", "rank")


def first_per_group(table: DataFrame, group: str, order: str = "ord", n: int = 2) -> DataFrame:
    """The first ``n`` rows of each group that isn't null."""
    rank = F.row_number().over(Window.partitionBy(group).orderBy(order))
    return table.where(F.col(group).isNotNull()).withColumn("__n", rank).where(F.col("__n") <= n).drop("__n")


def first_run(table: DataFrame, project: str, run: str, order: str = "ord") -> DataFrame:
    return table.where(F.col(project).isNotNull()).groupBy(project).agg(F.min_by(run, order).alias(run))


def distinct_submissions(table: DataFrame, submission: str, run: str) -> DataFrame:
    """The submissions of runs of the second archive, each once, whose checksum lists have to be asked for."""
    return table.where(F.col(run).startswith("CRR") & F.col(submission).isNotNull()).select(submission).distinct()


def union_by_name(tables: list[DataFrame], required: str | None = None) -> DataFrame:
    """All rows with all columns, missing ones null; tables without the required column don't take part."""
    own = [t for t in tables if required is None or required in t.columns]
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), own)


def priority_first(table: DataFrame) -> DataFrame:
    first = [c for c in PRIORITY_COLUMNS if c in table.columns]
    return table.select(*first, *[c for c in table.columns if c not in first])


# ---- project states --------------------------------------------------------------------------------------------

#: Stage of a failure to the project's state; others are download errors (fixed values).
STATES = {"validation": "invalid_format", "no_run": "no_run_info", "no_data": "no_data"}


def failure_state(stage: Column) -> Column:
    rule = F
    for name, state in STATES.items():
        rule = rule.when(stage == name, state)
    return rule.otherwise("download_error")


def completed(states: DataFrame, files: DataFrame, key: str = "id") -> DataFrame:
    """Projects that are both recorded as complete and have their file."""
    return states.join(files.select(key).distinct(), key, "left_semi")


def resume_layout(counts: DataFrame) -> DataFrame:
    """paired if both mates have reads and the second has at least nine tenths of the first's; else single."""
    both = (F.col("r1") > 0) & (F.col("r2") > 0) & (F.col("r2") >= F.floor(F.col("r1") * 9 / 10))
    return counts.withColumn("layout", F.when(both, "paired").otherwise("single"))


def majority_layout(files: DataFrame, by: list[str]) -> DataFrame:
    """PE or SE by what most samples are, PE among equals. A sample is paired if it has both mates."""
    samples = files.groupBy(*by, "sample").agg((F.count_distinct("mate") == 2).alias("pe"))
    return samples.groupBy(*by).agg(F.when(F.count_if("pe") * 2 >= F.count(F.lit(1)), "PE").otherwise("SE").alias("layout"))


def retention(rows: DataFrame) -> DataFrame:
    """paired, single or low_quality: which counts keep at least half of the raw pairs, tried in this order."""
    enough = lambda c: F.col(c) >= 0.5 * F.col("raw_pairs")
    return rows.withColumn("verdict", F.when(enough("paired_final"), "paired").when(enough("single_final"), "single").otherwise("low_quality"))
