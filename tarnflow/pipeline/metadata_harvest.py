"""Metadata of a study from the archives: keyword search, projects, samples, states and resuming.

Every step is a table over all ids at once. What is finished for a project is recorded with its state and its folder, and
a later run asks only for the rest.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession, functions as F

from tarnflow.operators import metadata as M
from tarnflow.schema import RUN
from tarnflow.session import stage
from tarnflow.sources import archives as A, sinks, texts
from tarnflow.sources.archives import ArchiveClient

#: The name under which samples that were asked for one by one are processed.
SAMPLES = "BIOSAMPLE_INPUT"


def _answers(bodies: DataFrame, group: str) -> DataFrame:
    """Rows of CSV answers, by the header of each; headers are few, as archives have a fixed form."""
    clean = stage(bodies.where(F.col("body").isNotNull()).select(group, F.regexp_replace("body", "\r", "").alias("body")).withColumn("head", F.trim(F.substring_index("body", "\n", 1))), "answers")
    heads = [r[0] for r in clean.where("head <> ''").select("head").distinct().orderBy("head").collect()]
    parts = []
    for head in heads:
        names = head.split(",")
        lines = clean.where(F.col("head") == head).select(group, F.explode(F.split("body", "\n")).alias("line")).where((F.trim("line") != "") & (F.col("line") != head))
        parsed = lines.select(group, F.from_csv("line", ", ".join(f"`{n}` string" for n in names)).alias("r"))
        parts.append(parsed.select(group, *[F.col(f"r.`{n}`").alias(n) for n in names if n != group]))
    empty = clean.select(group).limit(0)
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts, empty)


def ncbi_projects(projects: DataFrame, client: ArchiveClient) -> tuple[DataFrame, DataFrame]:
    """Runs joined with their samples for each project (``project``), and the errors by project."""
    of = lambda db, form: stage(A.searched(projects.select("project", F.format_string(form, "project").alias("term")), client, db), f"search-{db}")
    sra, records = of("sra", "%s[BioProject]"), of("bioproject", "%s[Project Accession]")
    runs = stage(A.fetched_texts(sra, client, "sra", "runinfo", "project"), "runinfo")
    links = stage(A.linked(records.withColumn("uids", F.slice("uids", 1, 1)), client, "bioproject", "biosample", "project"), "links")
    samples = stage(A.fetched_texts(links, client, "biosample", "full", "project"), "biosample")
    errors = functools.reduce(DataFrame.unionByName, [x.where("error is not null").select("project", "error") for x in (sra, records, runs, links, samples)])
    return _joined(_answers(runs, "project"), samples, "project"), errors.groupBy("project").agg(F.min("error").alias("error"))


def _joined(runs: DataFrame, texts_of_samples: DataFrame, group: str) -> DataFrame:
    """Runs with the attributes of their samples; what only one side has stays. Attributes are a column each."""
    blocks = texts.biosample_blocks(texts_of_samples.where("body is not null").select(group, "body"), "body", [group])
    named = blocks.select(group, F.col("biosample").alias("BioSample"), F.col("title").alias("sample_title"), "organism", "attributes").dropDuplicates([group, "BioSample"])
    held = stage(named, "samples")
    names = [r[0] for r in held.select(F.explode(F.map_keys("attributes")).alias("k")).distinct().orderBy("k").collect()]  # as many as columns in the end
    taken = {c.lower() for c in (*runs.columns, *held.columns)}
    wide = held.select(group, "BioSample", "sample_title", "organism", *[F.try_element_at("attributes", F.lit(n)).alias(n if n.lower() not in taken else f"{n}_biosample") for n in names])
    if "BioSample" not in runs.columns:
        runs = runs.withColumn("BioSample", F.lit(None).cast("string"))
    return runs.join(wide, [group, "BioSample"], "full")


def cncb_projects(projects: DataFrame, client: ArchiveClient) -> tuple[DataFrame, DataFrame]:
    """Runs of the second archive's projects, with its further sheets side by side, and the errors by project."""
    asked = projects.select("project", F.array("project").alias("uids"))
    runs = stage(A.fetched_texts(asked, client, "cncb", "runinfo", "project"), "cncb-runs")
    errors = runs.where("error is not null").select("project", "error")
    return _answers(runs.where(F.length("body") - F.length(F.replace("body", F.lit("\n"), F.lit(""))) >= 1), "project"), errors


def sample_first(accessions: DataFrame, client: ArchiveClient) -> tuple[DataFrame, DataFrame]:
    """Runs and attributes of samples that are asked for by accession (``id``), under the accessions that were asked for.

    Second, the accessions with ``uid``, null where none of the records that are found is the sample itself.
    """
    uids = stage(A.verified_uids(accessions, client), "verified")
    known = uids.where("uid is not null").select(F.lit(SAMPLES).alias("project"), F.array("uid").alias("uids"), F.col("id").alias("asked"))
    all_ = known.groupBy("project").agg(F.flatten(F.array_sort(F.collect_list("uids"))).alias("uids"))
    bodies = stage(A.fetched_texts(all_, client, "biosample", "full", "project"), "sample-texts")
    runs = _answers(stage(A.fetched_texts(A.linked(all_, client, "biosample", "sra", "project"), client, "sra", "runinfo", "project"), "sample-runs"), "project")
    blocks = texts.biosample_blocks(bodies.where("body is not null").select("body"), "body").select("biosample", "uid")
    own = blocks.join(uids.where("uid is not null"), "uid").where("biosample <> id").select(F.col("biosample").alias("BioSample"), F.col("id").alias("asked_as"))
    table = _joined(runs, bodies, "project").join(F.broadcast(own) if own.count() < 100_000 else own, "BioSample", "left")
    return table.withColumn("BioSample", F.coalesce("asked_as", "BioSample")).drop("asked_as"), uids.select("id", "uid")


def keyword_search(spark: SparkSession, client: ArchiveClient, fields: list[str], organisms: list[str], options: list[str] | None = None) -> DataFrame:
    """Projects that any combination of the keywords finds in either archive: accession, title, description, organism and source.

    Of a project that several queries or both archives find, the first by query stays.
    """
    queries = M.keyword_product(spark, fields, organisms, options).select("query")
    found = stage(A.searched(queries, client, "bioproject", "query"), "keyword-ncbi")
    records = A.fetched_texts(found, client, "bioproject", "xml", "query")
    ncbi = texts.bioproject_answers(records.where("body is not null"), "body", ["query"]).withColumn("source", F.lit("NCBI"))
    tables = A.fetched_texts(queries.withColumn("uids", F.array("query")), client, "cncb", "search", "query")
    cncb = texts.keyword_answers(tables.where("body is not null"), "body", ["query"]).withColumn("source", F.lit("CNCB"))
    both = M.accessions(ncbi.unionByName(cncb)).withColumn("ord", F.struct("query", F.col("source") == "CNCB"))
    return M.keep_first(both, ["accession"]).drop("ord")


def harvest_study(spark: SparkSession, client: ArchiveClient, ids: DataFrame, out: str) -> dict[str, DataFrame]:
    """Processed tables of all ids (``id``), with states; a second run asks only for what isn't complete.

    ``table`` has all projects' rows, cleaned and in the order of priority, ``status`` a state for each id. Below ``out``
    are a folder for each project, the states, the merged table and the report.
    """
    state = sinks.StateTable(spark, f"{out}/states")
    kinds = stage(ids.select("id").distinct().withColumn("kind", M.classify(F.col("id"))), "kinds")
    done = state.complete(f"{out}/processed")
    todo = stage(kinds.join(done, "id", "left_anti"), "todo")
    of = lambda kind: todo.where(F.col("kind") == kind).select(F.col("id").alias("project"))
    parts, errors = [], []
    for kind, source, ask in (("ncbi", "NCBI", ncbi_projects), ("cncb", "CNCB", cncb_projects)):
        if of(kind).head(1):
            rows, failed = ask(of(kind), client)
            parts.append((rows, source))
            errors.append(failed)
    samples = todo.where("kind = 'biosample'").select("id")
    if samples.head(1):
        rows, uids = sample_first(samples, client)
        parts.append((rows, "NCBI"))
        uids = stage(uids, "uids")
    else:
        uids = None
    for rows, source in parts:
        # The asked project takes the place of the archive's own, which may be one that it cross-refers to.
        own = rows.withColumn("asked", F.col("project")).withColumn("Source_Database", F.lit(source))
        renamed = own.withColumn("BioProject", F.when(F.col("project") == SAMPLES, F.col("BioProject")).otherwise(F.col("project")) if "BioProject" in own.columns else F.col("project")).drop("project")
        valid = renamed.groupBy("asked").agg(F.coalesce(F.bool_or(F.trim("Run").rlike(RUN)), F.lit(False)).alias("valid")) if "Run" in renamed.columns else renamed.select("asked").distinct().withColumn("valid", F.lit(False))
        kept = renamed.join(valid.where("valid").select("asked"), "asked", "left_semi").withColumn("BioProject_asked", F.col("asked")).drop("asked")
        if kept.head(1):
            sinks.processed(kept, f"{out}/processed", "BioProject_asked")
        counts = renamed.groupBy("asked").agg(F.count(F.lit(1)).alias("rows")).join(valid, "asked")
        state.record(counts.select(F.col("asked").alias("id"), F.when(F.col("valid"), "has_data").otherwise(M.failure_state(F.lit("no_run"))).alias("status"), F.lit(source).alias("source"), "rows", F.concat(F.lit("BioProject_asked="), "asked").alias("file")))
    _record_rest(state, todo, errors, uids)
    merged = spark.read.option("mergeSchema", "true").parquet(f"{out}/processed") if sinks._exists(spark, f"{out}/processed") else None
    asked = kinds.select(F.when(F.col("kind") == "biosample", SAMPLES).otherwise(F.col("id")).alias("BioProject_asked")).distinct()
    table = None
    if merged is not None:  # folders of other studies don't take part
        table = M.priority_first(M.standardized(merged.withColumn("BioProject_asked", F.col("BioProject_asked").cast("string")).join(asked, "BioProject_asked", "left_semi").drop("BioProject_asked")))
        sinks.merged_csv(table, f"{out}/all_metadata_merged")
    status = M.status_report(kinds.select("id"), state.read().select("id", "status"))
    sinks.status_tsv(status, f"{out}/status")
    return {"table": table, "status": status, "counts": M.status_counts(status)}


def _record_rest(state: sinks.StateTable, todo: DataFrame, errors: list[DataFrame], uids: DataFrame | None) -> None:
    """States of the ids that gave no table: wrong form, no data, or an error of the archive; samples one by one."""
    known = state.read().where("status in ('has_data', 'no_run_info')").select("id")
    failed = functools.reduce(DataFrame.unionByName, errors).groupBy("project").agg(F.min("error").alias("error")) if errors else None
    rest = todo.where("kind <> 'biosample'").join(known, "id", "left_anti")
    rest = rest.join(failed.withColumnRenamed("project", "id"), "id", "left") if failed is not None else rest.withColumn("error", F.lit(None).cast("string"))
    stages = F.when(F.col("kind") == "unknown", "validation").when(F.col("error").isNotNull(), "network").otherwise("no_data")
    state.record(stage(rest.select("id", M.failure_state(stages).alias("status"), "error"), "rest"))
    if uids is not None:
        state.record(uids.select("id", F.when(F.col("uid").isNotNull(), "has_data").otherwise("no_data").alias("status"), F.when(F.col("uid").isNotNull(), F.lit(f"BioProject_asked={SAMPLES}")).alias("file")))
