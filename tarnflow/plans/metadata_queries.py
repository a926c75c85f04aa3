"""Queries of the metadata operators, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarnflow.functions import text as X
from tarnflow.operators import metadata as M
from tarnflow.pipeline.runner import outcome_counts
from tarnflow.plans.derived import BIOSAMPLE, META, frame, sql
from tarnflow.session import read_table


def _meta(spark, sf_dir):
    return frame(spark, sf_dir, META)


def _biosample(spark, sf_dir):
    return frame(spark, sf_dir, BIOSAMPLE)


def classify_ids(spark, sf_dir):
    ids = _meta(spark, sf_dir).select("ord", F.explode(F.array("run", "bioproject", "biosample", F.replace("bioproject", F.lit("PRJN"), F.lit("PRJC")))).alias("id"))
    return ids.where("id is not null").groupBy(M.classify(F.col("id")).alias("kind")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("ids"))


def validate_run(spark, sf_dir):
    odd = _meta(spark, sf_dir).withColumn("run", F.when(F.col("bioproject").isin("PRJNA7", "PRJNA9"), F.concat(F.lit("X"), "run")).otherwise(F.col("run")))
    return M.has_runs(odd.where("bioproject is not null"), ["bioproject"], "run")


def keep_first(spark, sf_dir):
    return M.keep_first(_meta(spark, sf_dir).where("biosample is not null"), ["biosample"]).select("biosample", "ord", "run")


def id_list(spark, sf_dir):
    lines = read_table(spark, sf_dir, "events").select((F.col("user_id") % 7).cast("string").alias("file"), F.col("event_id").alias("ord"), F.when(F.col("event_id") % 13 == 0, "# note").when(F.col("event_id") % 17 == 0, "  ").otherwise(F.concat(F.lit(" PRJNA"), F.col("user_id").cast("string"), F.lit(" "))).alias("value"))
    return M.id_list(lines)


def strip_keys(spark, sf_dir):
    rows = _meta(spark, sf_dir).withColumn("run", F.concat(F.lit(" "), F.left("run", F.lit(3)), F.lit("\t"), F.substring("run", 4, 100), F.lit("\n")))
    return M.stripped(rows, ["run"]).select("ord", "run")


def rename_key(spark, sf_dir):
    return _meta(spark, sf_dir).where("bioproject is not null").select("ord", M.rename_key(F.col("bioproject"), F.col("biosample"), F.col("run")).alias("name"))


def accession_filter(spark, sf_dir):
    rows = _meta(spark, sf_dir).withColumn("accession", F.when(F.col("ord") % 5 == 0, F.col("run")).otherwise(F.col("bioproject")))
    return M.accessions(rows).select("ord", "accession")


def tag_source(spark, sf_dir):
    rows = M.tagged(_meta(spark, sf_dir).withColumnRenamed("bioproject", "BioProject"), "PRJNA1", "NCBI")
    return rows.groupBy(F.col("BioProject").alias("project"), F.col("Source_Database").alias("source")).agg(F.count(F.lit(1)).alias("n"))


_TEXTS = ["Illumina HiSeq 2500", "MinION", "Sequel II", "Ion Torrent PGM", "454 GS FLX", "BGISEQ-500", "unspecified"]


def platform_rules(spark, sf_dir):
    text = F.get(F.array(*map(F.lit, _TEXTS)), (F.col("ord") % len(_TEXTS)).cast("int"))
    rows = _meta(spark, sf_dir).select("ord", F.when(F.col("ord") % 3 == 0, text).alias("platform"), text.alias("model"))
    named = rows.select(M.platform(F.col("platform"), F.col("model")).alias("name"), (F.col("ord") % 2 == 0).alias("degraded"))
    return named.groupBy("name", M.route(F.col("name"), F.col("degraded")).alias("route")).agg(F.count(F.lit(1)).alias("n"))


def column_cleanup(spark, sf_dir):
    """One row per column of the standardized table: its name, its values, and a checksum of them."""
    wide = _meta(spark, sf_dir).select(
        F.col("ord").cast("string").alias("ID"), F.col("priority").alias("Sample_host_x"), F.col("run").alias("Acc_sra"), F.lit(" ").alias("blank"), F.col("priority").alias("again"),
        F.col("status").alias("geo_loc"), F.when(F.col("ord") % 2 == 0, F.lower("status")).alias("geo-loc"), F.col("bioproject").alias("proj"), F.lit(None).cast("string").alias("nothing"),
    )
    clean = M.standardized(wide, {"HOST": "host_name"})
    cells = clean.select(F.explode(F.array(*[F.struct(F.lit(i).alias("place"), F.lit(c).alias("name"), F.col(c).alias("value")) for i, c in enumerate(clean.columns)])).alias("x"))
    return cells.groupBy(F.col("x.place").cast("long").alias("place"), F.col("x.name").alias("name")).agg(F.count("x.value").alias("filled"), F.sum(F.length("x.value")).alias("letters"))


def empty_dup_columns(spark, sf_dir):
    wide = _meta(spark, sf_dir).select("ord", "run", "status", F.col("status").alias("status_again"), F.lit("").alias("empty"), "priority")
    kept = M.without_empty_and_repeated(wide)
    return spark.range(1).select(F.posexplode(F.array(*map(F.lit, kept.columns))).alias("place", "name")).withColumn("place", F.col("place").cast("long"))


def camel_merge(spark, sf_dir):
    a = F.when(F.col("ord") % 4 == 0, F.lit(" ")).otherwise(F.col("status"))
    b = F.when(F.col("ord") % 3 == 0, F.lower("status")).when(F.col("ord") % 5 == 0, F.col("priority"))
    return _meta(spark, sf_dir).select("ord", M.merged_value(a, b).alias("merged"))


def camel_names(spark, sf_dir):
    return read_table(spark, sf_dir, "part").select("p_partkey", X.camel_column(F.concat("p_type", F.lit("_"), "p_brand")).alias("name"))


def file_names(spark, sf_dir):
    return read_table(spark, sf_dir, "part").select("p_partkey", X.safe_name(F.concat(F.lit("[x] "), "p_name", F.lit(" / "), "p_type", F.lit("!!"))).alias("name"))


def formatted(spark, sf_dir):
    row = _meta(spark, sf_dir)
    return row.select("ord", X.percent(F.col("ord") % 997, F.lit(997)).alias("share"), X.minutes_seconds(F.col("ord") % 7200).alias("took"), F.md5("run").alias("digest"), X.url_quoted(F.concat("run", F.lit(" a/b"))).alias("quoted"))


def biosample_full_join(spark, sf_dir):
    sra = _meta(spark, sf_dir).select("ord", "run", "bioproject", "biosample")
    joined = M.full_join(sra, _biosample(spark, sf_dir).select("biosample", "bioproject", "title"), "biosample")
    return joined.select("ord", "run", "biosample", "bioproject", "bioproject_biosample", "title")


def dual_strategy_merge(spark, sf_dir):
    left = _meta(spark, sf_dir).select("ord", "run", "bioproject", "biosample").where("biosample is not null and bioproject is not null")
    right = _biosample(spark, sf_dir).select("biosample", "bioproject", "title").where("biosample is not null")
    merged, name = M.dual_strategy_merge(left, right, "ord")
    return merged.groupBy("origin").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("title_r").alias("titles")).withColumn("strategy", F.lit(name))


def uid_lookup(spark, sf_dir):
    mapping = _biosample(spark, sf_dir).where("biosample is not null and ord % 2 = 0").select("biosample", F.concat(F.lit("UID"), F.col("ord").cast("string")).alias("uid"))
    return M.looked_up(_meta(spark, sf_dir).where("biosample is not null").select("ord", "biosample"), mapping, "biosample", "uid")


def zip_by_position(spark, sf_dir):
    left = _meta(spark, sf_dir).select("ord", "run")
    right = _biosample(spark, sf_dir).select(F.col("ord").alias("ord_r"), "title")
    return M.zipped(left, right, "ord", "ord_r").select("pos", "run", "title")


def guarded_zip(spark, sf_dir):
    left = _meta(spark, sf_dir).select("ord", "run")
    return M.zipped_if_equal(left, left.select(F.col("ord").alias("ord_r"), F.lower("run").alias("sheet_run")), "ord", "ord_r").select("pos", "run", "sheet_run")


def id_set_check(spark, sf_dir):
    left = _meta(spark, sf_dir).select("biosample").where("biosample is not null")
    return M.id_differences(left, _biosample(spark, sf_dir).select("biosample").where("biosample is not null"), "biosample")


def semi_filter(spark, sf_dir):
    return M.semi(_meta(spark, sf_dir), _biosample(spark, sf_dir), "biosample").select("ord", "biosample")


def anti_split(spark, sf_dir):
    kept, removed = M.split_by_ids(_meta(spark, sf_dir).where("biosample is not null"), _biosample(spark, sf_dir).where("biosample is not null"), "biosample")
    tally = lambda x, name: x.agg(F.count(F.lit(1)).alias("n"), F.sum("ord").alias("ords")).withColumn("part", F.lit(name))
    return tally(kept, "kept").unionByName(tally(removed, "removed"))


def run_summary(spark, sf_dir):
    runs = _meta(spark, sf_dir).where("bioproject is not null").select("bioproject", "run", F.coalesce("biosample", "run").alias("sample"), "ord")
    raw = read_table(spark, sf_dir, "lineitem").select(F.concat(F.lit("SAMN"), F.col("l_partkey").cast("string")).alias("sample"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("ord"), F.floor(F.col("l_quantity") * 10).alias("raw_reads"))
    final = _biosample(spark, sf_dir).where("biosample is not null").groupBy(F.col("biosample").alias("sample")).agg(F.sum("ord").alias("final_reads"))
    return M.run_summary(runs, raw, final, F.col("ord") % 2 == 0).select("bioproject", "run", "sample", "raw_reads", "final_reads")


def _files(spark, sf_dir):
    rows = read_table(spark, sf_dir, "lineitem").select(F.concat(F.lit("S"), (F.col("l_orderkey") % 4000).cast("string")).alias("sample"), (1 + F.col("l_linenumber") % 2).alias("mate"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("ord"))
    return rows.withColumn("path", F.concat(F.lit("/data/"), "sample", F.lit("_"), F.col("ord").cast("string"), F.lit(".fastq")))


def pe_manifest(spark, sf_dir):
    return M.pe_manifest(_files(spark, sf_dir))


def se_manifest(spark, sf_dir):
    return M.se_manifest(_files(spark, sf_dir))


def status_report(spark, sf_dir):
    ids = _meta(spark, sf_dir).where("bioproject is not null").select(F.col("bioproject").alias("id")).distinct()
    stage = F.element_at(F.array(*map(F.lit, ("validation", "no_run", "no_data", "network"))), (F.col("user_id") % 4 + 1).cast("int"))
    states = read_table(spark, sf_dir, "events").select(F.concat(F.lit("PRJNA"), F.col("user_id").cast("string")).alias("id"), M.failure_state(stage).alias("status")).distinct()
    return M.status_report(ids, states)


def status_counts(spark, sf_dir):
    return M.status_counts(status_report(spark, sf_dir))


def platform_cache(spark, sf_dir):
    cache = _biosample(spark, sf_dir).where("ord % 3 = 0").select("biosample", "host")
    hit, miss = M.cached_or_missing(_meta(spark, sf_dir).where("biosample is not null").select("ord", "biosample"), cache, "biosample", "host")
    return hit.groupBy("host").agg(F.count(F.lit(1)).alias("n")).unionByName(miss.agg(F.count(F.lit(1)).alias("n")).withColumn("host", F.lit("missing")))


def keyword_product(spark, sf_dir):
    fields = [r[0] for r in read_table(spark, sf_dir, "region").select("r_name").collect()]
    organisms = [r[0] for r in read_table(spark, sf_dir, "nation").select("n_name").collect()]
    return M.keyword_product(spark, fields, organisms).select("field", "organism", "query")


def run_fallback(spark, sf_dir):
    table = _meta(spark, sf_dir).where("bioproject is not null").select("bioproject", "run", "ord")
    asked = table.groupBy("bioproject").agg(F.max("ord").alias("m")).select("bioproject", F.when(F.col("m") % 2 == 0, F.concat(F.lit("SRR"), F.col("m").cast("string"))).otherwise("none").alias("run"))
    return M.run_or_first(table, asked, "bioproject", "run", "ord")


def batch_platform(spark, sf_dir):
    table = _meta(spark, sf_dir).select((F.col("ord") % 500).alias("run_no"), "bioproject", "ord").where("bioproject is not null")
    answers = read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("run_no"), F.col("c_mktsegment").alias("platform"))
    return M.last_project_of_run(table, answers, "run_no", "bioproject", "ord")


def dataset_list(spark, sf_dir):
    return M.dataset_list(_meta(spark, sf_dir), "bioproject")


def subset_two_per_project(spark, sf_dir):
    return M.first_per_group(_meta(spark, sf_dir), "bioproject").select("bioproject", "run", "ord")


def subset_tally(spark, sf_dir):
    return M.first_per_group(_meta(spark, sf_dir), "bioproject").agg(F.count_distinct("bioproject").alias("projects"), F.count(F.lit(1)).alias("rows"))


def first_run_of_dataset(spark, sf_dir):
    return M.first_run(_meta(spark, sf_dir), "bioproject", "run")


def distinct_submissions(spark, sf_dir):
    return M.distinct_submissions(_meta(spark, sf_dir), "bioproject", "run")


def union_by_name(spark, sf_dir):
    a = _meta(spark, sf_dir).select(F.col("run").alias("Run"), F.col("bioproject").alias("BioProject"))
    b = _biosample(spark, sf_dir).select(F.concat(F.lit("SRR"), F.col("ord").cast("string")).alias("Run"), "title")
    c = _biosample(spark, sf_dir).select("title")
    return M.union_by_name([a, b, c], "Run").select(F.col("Run").alias("run"), F.col("BioProject").alias("bioproject"), "title")


def keyword_union(spark, sf_dir):
    a = _meta(spark, sf_dir).select(F.col("bioproject").alias("accession"), F.lit("NCBI").alias("source"), "ord")
    b = _biosample(spark, sf_dir).select(F.replace("bioproject", F.lit("NA"), F.lit("CA")).alias("accession"), F.lit("CNCB").alias("source"), (F.col("ord") + 10_000_000).alias("ord"))
    return M.keep_first(M.accessions(M.union_by_name([a, b])), ["accession"]).select("accession", "source", "ord")


def resume_layout(spark, sf_dir):
    counts = read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), (F.col("o_custkey") % 100).alias("r1"), (F.col("o_orderkey") % 100).alias("r2"))
    return M.resume_layout(counts)


def majority_layout(spark, sf_dir):
    return M.majority_layout(_files(spark, sf_dir).withColumn("g", F.col("ord") % 5), ["g"])


def retention_gates(spark, sf_dir):
    rows = read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.lit(100).alias("raw_pairs"), (F.col("o_custkey") % 100).alias("paired_final"), (F.col("o_orderkey") % 100).alias("single_final"))
    return M.retention(rows).groupBy("verdict").agg(F.count(F.lit(1)).alias("n"))


def run_outcomes(spark, sf_dir):
    kinds = ("success", "failed", "skipped", "low_quality")
    log = read_table(spark, sf_dir, "events").select(F.element_at(F.array(*map(F.lit, kinds)), (F.col("event_id") % 4 + 1).cast("int")).alias("status"))
    return outcome_counts(log)


NAMES = (
    "classify_ids validate_run keep_first id_list strip_keys rename_key accession_filter tag_source platform_rules column_cleanup empty_dup_columns camel_merge "
    "camel_names file_names formatted biosample_full_join dual_strategy_merge uid_lookup zip_by_position guarded_zip id_set_check semi_filter anti_split run_summary "
    "pe_manifest se_manifest status_report status_counts platform_cache keyword_product run_fallback batch_platform dataset_list subset_two_per_project subset_tally "
    "first_run_of_dataset distinct_submissions union_by_name keyword_union resume_layout majority_layout retention_gates run_outcomes"
).split()
QUERIES = {n: globals()[n] for n in NAMES}

_M, _B = sql(META), sql(BIOSAMPLE)
_KIND = "case when regexp_full_match(trim(id), 'SAM[CEDN][A-Z]?\\d+') then 'biosample' when regexp_full_match(trim(id), 'PRJC[A-Z]\\d+') then 'cncb' when regexp_full_match(trim(id), 'PRJ[EDN][A-Z]\\d+') then 'ncbi' else 'unknown' end"
_SUBSET = f"(select * from {_M} where bioproject is not null qualify row_number() over (partition by bioproject order by ord) <= 2)"
_STATUS = f"""
    select i.id, coalesce(s.status, 'unknown') as status from (select distinct bioproject as id from {_M} where bioproject is not null) i
    left join (select distinct 'PRJNA' || user_id as id, ['invalid_format', 'no_run_info', 'no_data', 'download_error'][user_id % 4 + 1] as status from events) s on s.id = i.id"""
_FILES = "(select *, '/data/' || sample || '_' || ord || '.fastq' as path from (select 'S' || (l_orderkey % 4000) as sample, 1 + l_linenumber % 2 as mate, l_orderkey * 8 + l_linenumber as ord from lineitem))"
_LEFT = f"(select * from {_M} where biosample is not null and bioproject is not null)"
_RIGHT = f"(select * from {_B} where biosample is not null)"


def _dual(on: str) -> str:
    return f"""select case when l.ord is not null and r.ord is not null then 'both' when l.ord is not null then 'left_only' else 'right_only' end as origin, r.title
        from {_LEFT} l full join {_RIGHT} r on {on}"""


_SIMPLE, _COMPOSITE = _dual("l.biosample = r.biosample"), _dual("l.biosample = r.biosample and l.bioproject = r.bioproject")

ORACLE_SQL = {
    "classify_ids": f"""
        select kind, count(*) as n, count(distinct id) as ids from (
          select id, {_KIND} as kind from (select unnest([run, bioproject, biosample, replace(bioproject, 'PRJN', 'PRJC')]) as id from {_M}) where id is not null) group by kind""",
    "validate_run": f"""
        select bioproject, bool_or(regexp_full_match(case when bioproject in ('PRJNA7', 'PRJNA9') then 'X' || run else run end, '[CEDS]RR\\d+')) as valid
        from {_M} where bioproject is not null group by bioproject""",
    "keep_first": f"select biosample, ord, run from {_M} where biosample is not null qualify row_number() over (partition by biosample order by ord) = 1",
    "id_list": """
        with l as (select cast(user_id % 7 as varchar) as file, event_id as ord, 'PRJNA' || user_id as id from events where event_id % 13 <> 0 and event_id % 17 <> 0)
        select id, file, ord from l qualify row_number() over (partition by id order by file, ord) = 1""",
    "strip_keys": f"select ord, run from {_M}",
    "rename_key": f"select ord, bioproject || '_' || coalesce(biosample, run) as name from {_M} where bioproject is not null",
    "accession_filter": f"select ord, bioproject as accession from {_M} where ord % 5 <> 0 and bioproject like 'PRJ%'",
    "tag_source": f"select 'PRJNA1' as project, 'NCBI' as source, count(*) as n from {_M}",
    "platform_rules": f"""
        with t as (select {_TEXTS}[ord % {len(_TEXTS)} + 1] as text, ord % 2 = 0 as degraded from {_M}),
        p as (select degraded, case when regexp_matches(upper(text), 'ILLUMINA|HISEQ|NOVASEQ|MISEQ') then 'ILLUMINA' when regexp_matches(upper(text), 'NANOPORE|MINION|PROMETHION') then 'OXFORD_NANOPORE'
              when regexp_matches(upper(text), 'PACBIO|SEQUEL') then 'PACBIO_SMRT' when regexp_matches(upper(text), 'ION|TORRENT') then 'ION_TORRENT' when regexp_matches(upper(text), '454|ROCHE') then 'LS454' else upper(text) end as name from t)
        select name, case when name = 'ILLUMINA' and degraded then 'illumina_degraded' when name = 'ILLUMINA' then 'illumina' when name = 'LS454' then 'ls454' when name = 'ION_TORRENT' then 'ion_torrent'
               when name = 'PACBIO_SMRT' then 'pacbio' when name = 'OXFORD_NANOPORE' then 'unsupported' else 'failed' end as route, count(*) as n from p group by all""",
    "column_cleanup": f"""
        with w as (select *, case when ord % 2 = 0 then lower(status) end as other from {_M})
        select 0 as place, 'Run' as name, count(run) as filled, cast(sum(length(run)) as bigint) as letters from w
        union all select 1, 'BioProject', count(bioproject), cast(sum(length(bioproject)) as bigint) from w
        union all select 2, 'HostName', count(priority), cast(sum(length(priority)) as bigint) from w
        union all select 3, 'GeoLoc', count(status), cast(sum(length(status)) as bigint) from w""",
    "empty_dup_columns": "select cast(place as bigint) as place, name from (values (0, 'ord'), (1, 'run'), (2, 'status'), (3, 'priority')) t(place, name)",
    "camel_merge": f"""
        with v as (select ord, case when ord % 4 = 0 then null else status end as a, case when ord % 3 = 0 then lower(status) when ord % 5 = 0 then priority end as b from {_M})
        select ord, case when a is null then b when b is null or lower(a) = lower(b) then a else a || '_' || b end as merged from v""",
    "camel_names": """
        select p_partkey, list_aggregate(list_transform(string_split(trim(regexp_replace(p_type || '_' || p_brand, '[\\s_\\-]+', ' ', 'g')), ' '), lambda w: upper(w[1]) || lower(w[2:])), 'string_agg', '') as name from part""",
    "file_names": """
        select p_partkey, regexp_replace(left(regexp_replace(regexp_replace('[x] ' || p_name || ' / ' || p_type || '!!', '[^A-Za-z0-9.\\-]+', '_', 'g'), '_+', '_', 'g'), 80), '^_+|_+$', '', 'g') as name from part""",
    "formatted": f"""
        select ord, format('{{:.1f}}', round((ord % 997) * 100.0 / 997, 1)) || '%' as share, ((ord % 7200) // 60) || 'm ' || ((ord % 7200) % 60) || 's' as took, md5(run) as digest, run || '%20a%2Fb' as quoted
        from {_M}""",
    "biosample_full_join": f"""
        select m.ord, m.run, coalesce(m.biosample, b.biosample) as biosample, m.bioproject, b.bioproject as bioproject_biosample, b.title
        from {_M} m full join {_B} b on m.biosample is not distinct from b.biosample""",
    "dual_strategy_merge": f"""
        with s as ({_SIMPLE}), c as ({_COMPOSITE}), w as (select (select count(*) from s where origin = 'both') >= (select count(*) from c where origin = 'both') as simple)
        select origin, count(*) as n, count(distinct title) as titles, case when w.simple then 'simple' else 'composite' end as strategy
        from (select *, true as own from s union all select *, false from c) x join w on x.own = w.simple group by origin, w.simple""",
    "uid_lookup": f"""
        select m.ord, m.biosample, coalesce('UID' || b.ord, m.biosample) as uid from {_M} m left join (select * from {_B} where biosample is not null and ord % 2 = 0) b on b.biosample = m.biosample
        where m.biosample is not null""",
    "zip_by_position": f"""
        select coalesce(a.pos, b.pos) as pos, run, title from (select run, row_number() over (order by ord) as pos from {_M}) a
        full join (select title, row_number() over (order by ord) as pos from {_B}) b on a.pos = b.pos""",
    "guarded_zip": f"select row_number() over (order by ord) as pos, run, lower(run) as sheet_run from {_M}",
    "id_set_check": f"""
        with l as (select distinct biosample from {_M} where biosample is not null), r as (select distinct biosample from {_B} where biosample is not null)
        select (select count(*) from l where biosample not in (select biosample from r)) as left_only, (select count(*) from r where biosample not in (select biosample from l)) as right_only""",
    "semi_filter": f"select ord, biosample from {_M} where biosample in (select biosample from {_B} where biosample is not null)",
    "anti_split": f"""
        with r as (select biosample from {_B} where biosample is not null)
        select case when biosample in (select biosample from r) then 'kept' else 'removed' end as part, count(*) as n, cast(sum(ord) as bigint) as ords from {_M} where biosample is not null group by all""",
    "run_summary": f"""
        with runs as (select bioproject, run, coalesce(biosample, run) as sample, ord from {_M} where bioproject is not null),
        raw as (select 'SAMN' || l_partkey as sample, arg_min(cast(floor(l_quantity * 10) as bigint), l_orderkey * 8 + l_linenumber) as raw_reads from lineitem group by l_partkey),
        fin as (select biosample as sample, cast(sum(ord) as bigint) as final_reads from {_B} where biosample is not null group by biosample)
        select bioproject, run, runs.sample, cast(case when ord % 2 = 0 then coalesce(raw_reads, 0) // 2 else coalesce(raw_reads, 0) end as bigint) as raw_reads, coalesce(final_reads, 0) as final_reads
        from runs left join raw on raw.sample = runs.sample left join fin on fin.sample = runs.sample""",
    "pe_manifest": f"""
        select sample, max(path) filter (where mate = 1) as forward, max(path) filter (where mate = 2) as reverse from {_FILES} group by sample
        having count(*) filter (where mate = 1) > 0 and count(*) filter (where mate = 2) > 0""",
    "se_manifest": f"select sample, path from {_FILES} qualify row_number() over (partition by sample order by ord) = 1",
    "status_report": _STATUS,
    "status_counts": f"select status, count(*) as n from ({_STATUS}) group by status",
    "platform_cache": f"""
        select coalesce(b.host, 'missing') as host, count(*) as n from {_M} m left join (select * from {_B} where ord % 3 = 0) b on b.biosample = m.biosample where m.biosample is not null group by all""",
    "keyword_product": "select r_name as field, n_name as organism, '(\"' || r_name || '\") AND (\"' || n_name || '\")' as query from region, nation",
    "run_fallback": f"""
        with t as (select bioproject, run, ord from {_M} where bioproject is not null),
        a as (select bioproject, case when max(ord) % 2 = 0 then 'SRR' || max(ord) else 'none' end as asked from t group by bioproject)
        select t.bioproject, run, ord from t join a on a.bioproject = t.bioproject qualify row_number() over (partition by t.bioproject order by case when run = asked then 0 else 1 end, ord) = 1""",
    "batch_platform": f"""
        select o.run_no, bioproject, c_mktsegment as platform from (select ord % 500 as run_no, arg_max(bioproject, ord) as bioproject from {_M} where bioproject is not null group by ord % 500) o
        join customer on c_custkey = run_no""",
    "dataset_list": f"select bioproject, first_ord, row_number() over (order by first_ord) as rank from (select bioproject, min(ord) as first_ord from {_M} where bioproject is not null group by bioproject)",
    "subset_two_per_project": f"select bioproject, run, ord from {_SUBSET}",
    "subset_tally": f"select count(distinct bioproject) as projects, count(*) as rows from {_SUBSET}",
    "first_run_of_dataset": f"select bioproject, arg_min(run, ord) as run from {_M} where bioproject is not null group by bioproject",
    "distinct_submissions": f"select distinct bioproject from {_M} where run like 'CRR%' and bioproject is not null",
    "union_by_name": f"select run, bioproject, null as title from {_M} union all select 'SRR' || ord, null, title from {_B}",
    "keyword_union": f"""
        select accession, source, ord from (select bioproject as accession, 'NCBI' as source, ord from {_M} union all select replace(bioproject, 'NA', 'CA'), 'CNCB', ord + 10000000 from {_B})
        where accession like 'PRJ%' qualify row_number() over (partition by accession order by ord) = 1""",
    "resume_layout": "select o_orderkey as k, o_custkey % 100 as r1, o_orderkey % 100 as r2, case when o_custkey % 100 > 0 and o_orderkey % 100 > 0 and o_orderkey % 100 >= (o_custkey % 100) * 9 // 10 then 'paired' else 'single' end as layout from orders",
    "majority_layout": f"""
        with s as (select ord % 5 as g, sample, count(distinct mate) = 2 as pe from {_FILES} group by all)
        select g, case when count(*) filter (where pe) * 2 >= count(*) then 'PE' else 'SE' end as layout from s group by g""",
    "retention_gates": "select case when o_custkey % 100 >= 50 then 'paired' when o_orderkey % 100 >= 50 then 'single' else 'low_quality' end as verdict, count(*) as n from orders group by all",
    "run_outcomes": "select " + ", ".join(f"count(*) filter (where event_id % 4 = {i}) as {k}" for i, k in enumerate(("success", "failed", "skipped", "low_quality"))) + " from events",
}
