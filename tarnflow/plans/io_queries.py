"""Round trips of the sources and sinks: a table is written, read back, and compared with what it was made of."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tarnflow.operators import reads as R
from tarnflow.plans.derived import BIOSAMPLE, FEATURES, META, READS, frame, sql, unstaged_reads
from tarnflow.session import read_table, shared_folder
from tarnflow.sources import connectors, formats, sinks, texts


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _lines(table: DataFrame, path: str) -> str:
    """Text files of the column ``value``."""
    table.select("value").write.text(path)
    return path


def _meta(spark, sf_dir):
    return frame(spark, sf_dir, META)


def _reads(spark, sf_dir):
    return frame(spark, sf_dir, READS)


def csv_round_trip(spark, sf_dir):
    """Merged metadata as one CSV with a byte order mark, read back as strings."""
    path = _folder(spark, "merged")
    sinks.merged_csv(_meta(spark, sf_dir).select("run", "bioproject", "biosample", F.concat(F.lit('a "quoted", '), "priority").alias("priority"), "ord"), path)
    table = texts.metadata_csv(spark, path)
    return table.select(F.col("ord").cast("long").alias("ord"), "run", "bioproject", "biosample", "priority")


def run_info_batches(spark, sf_dir):
    """Answers in batches of 500, each with a header line of its own."""
    rows = _meta(spark, sf_dir).where("bioproject is not null").select(F.floor(F.col("ord") / 500).alias("b"), "ord", F.concat_ws(",", "run", "bioproject", F.col("ord").cast("string")).alias("line"))
    heads = rows.select("b", F.lit(-1).cast("long").alias("ord"), F.lit("Run,BioProject,Order").alias("line")).distinct()
    path = _lines(rows.unionByName(heads).repartitionByRange(8, "b").sortWithinPartitions("b", "ord").withColumnRenamed("line", "value"), _folder(spark, "runinfo"))
    named = spark.read.schema("Run string, BioProject string, Order string").csv(path).where("Run is not null and Run <> 'Run'")
    assert texts.run_info(spark, path).columns == ["Run", "BioProject", "Order"]
    return named.select(F.col("Run").alias("run"), F.col("BioProject").alias("bioproject"), F.col("Order").cast("long").alias("ord"))


def biosample_text(spark, sf_dir):
    """Numbered text blocks of 100 samples an answer."""
    rows = frame(spark, sf_dir, BIOSAMPLE).where("biosample is not null").select("ord", "biosample", "title", "host", "bioproject")
    block = F.format_string(
        '%d: %s\nIdentifiers: BioSample: %s; SRA: SRS%d\nOrganism: org %s\nAttributes:\n    /host="%s"\n    /project="%s"\n    /host="again"\nAccession: %s\tID: %d\n',
        "ord", "title", "biosample", "ord", "host", "host", "bioproject", "biosample", "ord",
    )
    answers = rows.groupBy(F.floor(F.col("ord") / 100)).agg(F.array_join(F.array_sort(F.collect_list(F.struct("ord", block.alias("b"))))["b"], "\n").alias("value"))  # 100 samples
    found = texts.attribute_columns(texts.biosample_blocks(answers), ["host", "project"])
    return found.select("biosample", "title", "organism", "host", "project")


def bioproject_records(spark, sf_dir):
    rows = _meta(spark, sf_dir).where("bioproject is not null").select("bioproject").distinct()
    record = F.format_string(
        "<Project><ProjectID><ArchiveID accession='%s'/></ProjectID><ProjectDescr><Title>T %s</Title><Description>D</Description></ProjectDescr>"
        "<ProjectType><ProjectTypeSubmission><Target><Organism><OrganismName>soil</OrganismName></Organism></Target></ProjectTypeSubmission></ProjectType></Project>",
        "bioproject", "bioproject",
    )
    answer = F.concat(F.lit("<Set>"), F.array_join(F.collect_list(record), "\n"), F.lit("</Set>"))
    answers = rows.groupBy(F.pmod(F.xxhash64("bioproject"), F.lit(7)).alias("g")).agg(answer.alias("value")).repartition(7, "g")  # a document has one root
    path = _folder(spark, "xml")
    answers.write.partitionBy("g").text(path)
    return texts.bioproject_xml(spark, f"{path}/*")


def keyword_results(spark, sf_dir):
    part = read_table(spark, sf_dir, "part")
    good = part.select(F.concat_ws("\t", F.concat(F.lit("PRJCA"), F.col("p_partkey").cast("string")), "p_name", "p_type", "p_brand").alias("value"))
    odd = part.select(F.concat_ws("\t", F.lit("broken"), "p_name").alias("value")).unionAll(spark.createDataFrame([("Accession\tTitle\tDescription\tSpecies",)], "value string"))
    return texts.keyword_tsv(spark, _lines(good.unionAll(odd), _folder(spark, "keyword")))


def run_csv_answers(spark, sf_dir):
    """One CSV answer a project, in a column; an answer without rows has none."""
    rows = _meta(spark, sf_dir).where("bioproject is not null")
    body = F.concat(F.lit("Run,Title\n"), F.array_join(F.array_sort(F.collect_list(F.concat("run", F.lit(',"x, '), "status", F.lit('"')))), "\n"), F.lit("\n"))
    answers = rows.groupBy("bioproject").agg(body.alias("body")).unionByName(spark.createDataFrame([("PRJNA-none", "Run,Title\n")], "bioproject string, body string"))
    return texts.run_csv_text(answers, "body", ["Run", "Title"]).select("bioproject", F.col("Run").alias("run"), F.col("Title").alias("title"))


def sheets_side_by_side(spark, sf_dir):
    a = _meta(spark, sf_dir).select("ord", "run")
    b = frame(spark, sf_dir, BIOSAMPLE).select("ord", "title")
    return texts.sheets({"Run": a, "Sample": b}).select(F.col("Run_run").alias("run"), F.col("Sample_title").alias("title"), "pos")


def fastq_round_trip(spark, sf_dir):
    """Reads written as gzip text and read by Spark's own reader: numbers within files are by order."""
    path = _folder(spark, "fastq")
    sinks.write_fastq(_reads(spark, sf_dir).select("header", "seq", "qual"), path)
    return formats.read_fastq(spark, path).select("header", "seq", "qual")


def fastq_source(spark, sf_dir):
    """The ``fastq`` source and writer."""
    formats.register(spark)
    path = _folder(spark, "fastq-source")
    _reads(spark, sf_dir).select("header", "seq", "qual").write.format("fastq").mode("append").save(path)
    return spark.read.format("fastq").load(path).select("header", "seq", "qual")


def fasta_round_trip(spark, sf_dir):
    """Unique sequences with their abundance in the label."""
    formats.register(spark)
    path = _folder(spark, "fasta")
    seqs = R.dereplicate(_reads(spark, sf_dir), ["project"]).select(F.concat("project", F.lit("_"), F.md5("seq")).alias("name"), "seq", "size")
    sinks.write_fasta(seqs, path, "size")
    back = spark.read.text(path, lineSep=">").where("value <> ''")
    parts = F.split("value", "\n")
    own = back.select(F.regexp_extract(parts[0], "^([^;]*)", 1).alias("name"), F.regexp_extract(parts[0], ";size=([0-9]+)", 1).cast("long").alias("size"), parts[1].alias("seq"))
    return own


def otu_text(spark, sf_dir):
    """The wide table in text, with a comment before its header and abundances in the names, back in long form.

    Reads are counted by the names that the sink counts by, so its rows need not be shuffled for that again.
    """
    named = unstaged_reads(spark, sf_dir).select(F.concat(F.md5(F.upper("seq")), F.lit(";size=7")).alias("feature_id"), "sample_id")
    table = named.groupBy("feature_id", "sample_id").agg(F.count(F.lit(1)).alias("count"))
    path = _folder(spark, "otu")
    sinks.otu_tsv(table, path, "made", compression="lz4")
    return texts.otu_tsv(spark, path).withColumnRenamed("count", "n")


def seven_number_text(spark, sf_dir):
    """Quantiles by position of one project, as the tool's table of seven numbers."""
    found = R.quality_quantiles(_reads(spark, sf_dir).where("project = 'PRJNA3'"), []).orderBy("pos").collect()  # a row a position
    rows = [("", [r.pos for r in found]), ("count", [r.reads for r in found])] + [(f"{int(k[1:])}%", [r[k] for r in found]) for k in ("q02", "q09", "q25", "q50", "q75", "q91", "q98")]
    path = f"{_folder(spark, 'seven')}.tsv"
    sinks.write_text(spark, path, "".join("\t".join([name, *map(str, values)]) + "\n" for name, values in rows))
    back = texts.seven_numbers(spark, path)
    return back.select("pos", "reads", *[F.round(c, 4).alias(c) for c in ("q02", "q09", "q25", "q50", "q75", "q91", "q98")])


def biom_round_trip(spark, sf_dir):
    """The feature table in the JSON layout of BIOM 1.0, written by the sink and read back."""
    table = frame(spark, sf_dir, FEATURES).groupBy("feature_id", "sample_id").agg(F.sum("n").alias("count"))
    path = _folder(spark, "biom")
    sinks.biom_json(table, path)
    return texts.biom_json(spark, path).withColumnRenamed("count", "n")


def file_links(spark, sf_dir):
    """Links of a report's cells, those of runs with both mates only."""
    run = F.concat(F.lit("SRR"), F.col("o_orderkey").cast("string"))
    links = F.when(F.col("o_orderkey") % 3 == 0, F.array(F.lit(""), F.lit("_1"), F.lit("_2"))).when(F.col("o_orderkey") % 3 == 1, F.array(F.lit(""))).otherwise(F.array(F.lit(""), F.lit("_1")))
    cell = lambda form: F.array_join(F.transform(links, form), ";")
    rows = read_table(spark, sf_dir, "orders").select(run.alias("run_accession"), cell(lambda x: F.concat(F.lit("ftp/"), run, x, F.lit(".fastq.gz"))).alias("fastq_ftp"), cell(lambda x: F.md5(F.concat(run, x))).alias("fastq_md5"))
    path = _folder(spark, "report")
    rows.write.csv(path, sep="\t", header=True)
    return texts.chosen_files(texts.file_report(spark, path)).select("run", "url", "md5")


def verified_files(spark, sf_dir):
    """Contents against listed checksums, every seventh of which is wrong and every eleventh missing."""
    rows = read_table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("/d/f"), F.col("p_partkey").cast("string"), F.lit(".gz")).alias("path"), F.col("p_name").cast("binary").alias("content"))
    sums = rows.where("p_partkey % 11 <> 0").select(F.element_at(F.split("path", "/"), -1).alias("file"), F.upper(F.when(F.col("p_partkey") % 7 == 0, F.md5(F.lit("x"))).otherwise(F.md5("content"))).alias("md5"))
    return texts.checked_files(rows.select("path", "content"), sums)


def download_routes(spark, sf_dir):
    runs = _meta(spark, sf_dir).select(F.when(F.col("ord") % 13 == 0, F.concat(F.lit("X"), "run")).otherwise(F.col("run")).alias("run"), F.coalesce("bioproject", F.lit("none")).alias("submission")).distinct()
    return connectors.accession_folders(connectors.download_plan(runs)).select("run", "submission", "archive", F.col("rank").cast("long").alias("rank"))


def found_datasets(spark, sf_dir):
    """Data sets with all their parts."""
    path, rows = _folder(spark, "datasets"), read_table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_nationkey").alias("dataset_id"))
    for part, kept in (("table", rows), ("sequences", rows.where("k % 3 <> 0"))):
        for r in kept.collect():  # 25 nations
            sinks.write_text(spark, f"{path}/dataset_id={r.dataset_id}/{part}/x", "x")
    return texts.dataset_folders(spark, path, ["table", "sequences"])


def processed_projects(spark, sf_dir):
    """A folder for each project; a second run replaces those of its own projects only."""
    path = _folder(spark, "processed")
    rows = _meta(spark, sf_dir).where("bioproject is not null").select(F.col("bioproject").alias("BioProject"), "run", "ord", F.lit(1).alias("version"))
    sinks.processed(rows, path)
    sinks.processed(rows.where("BioProject like 'PRJNA1%'").withColumn("version", F.lit(2)), path)
    return spark.read.parquet(path).groupBy(F.col("BioProject").cast("string").alias("bioproject"), "version").agg(F.count(F.lit(1)).alias("runs"), F.sum("ord").alias("ords"))


def status_file(spark, sf_dir):
    rows = _meta(spark, sf_dir).where("bioproject is not null").groupBy(F.col("bioproject").alias("id")).agg(F.min("status").alias("status"))
    path = _folder(spark, "status")
    sinks.status_tsv(rows, path)
    return spark.read.csv(path, sep="\t", header=True)


def search_files(spark, sf_dir):
    """The list of accessions of a search, as it is read for the next step."""
    found = _meta(spark, sf_dir).where("bioproject is not null").select(F.col("bioproject").alias("accession"), "run", F.when(F.col("run").startswith("CRR"), "CNCB").otherwise("NCBI").alias("source"))
    path = _folder(spark, "search")
    sinks.search_results(found, path)
    table = spark.read.csv(f"{path}/combined_results", header=True).groupBy("accession").agg(F.count(F.lit(1)).alias("runs"))
    return spark.read.text(f"{path}/bioproject_ids").select(F.col("value").alias("accession")).join(table, "accession")


def run_list_files(spark, sf_dir):
    rows = _meta(spark, sf_dir).where("bioproject is not null").select(F.col("bioproject").alias("dataset_id"), "run", F.coalesce("biosample", "run").alias("sample_name"))
    path = _folder(spark, "lists")
    sinks.run_lists(rows, path)
    return spark.read.option("sep", "\t").schema("run string, sample_name string, dataset_id string").csv(path).select("dataset_id", "run", "sample_name")


def primer_files(spark, sf_dir):
    rows = read_table(spark, sf_dir, "nation").select(F.to_json(F.struct(F.col("n_name").alias("name"), F.col("n_nationkey").alias("length"))).alias("primer_info"))
    path = _folder(spark, "primer")
    sinks.primer_json(rows, path)
    return spark.read.schema("name string, length long").json(path)


def summary_rows(spark, sf_dir):
    """A summary in two appends."""
    path = _folder(spark, "summary")
    rows = _meta(spark, sf_dir).select("bioproject", "run", F.col("biosample").alias("sample"), F.col("ord").alias("raw_reads"), (F.col("ord") % 100).alias("final_reads"))
    for part in (rows.where("raw_reads % 2 = 0"), rows.where("raw_reads % 2 = 1")):
        sinks.append_summary(part, path)
    return spark.read.parquet(path)


def raw_count_file(spark, sf_dir):
    path = _folder(spark, "raw")
    sinks.raw_count_tsv(R.raw_counts(_reads(spark, sf_dir)), path)
    return spark.read.schema("sample_id string, raw_reads long").csv(path, sep="\t")


def feature_table_files(spark, sf_dir):
    """A checked table and its sequences, put in their final place."""
    table = frame(spark, sf_dir, FEATURES).groupBy("feature_id", "sample_id").agg(F.sum("n").alias("count"))
    seqs = _reads(spark, sf_dir).select(F.md5(F.upper("seq")).alias("feature_id"), F.upper("seq").alias("seq")).distinct()
    staging, final = _folder(spark, "staging"), _folder(spark, "final")
    sinks.feature_table(table, seqs, f"{staging}/final")
    sinks.finalize(spark, staging, final)
    return spark.read.parquet(f"{final}/table").join(spark.read.parquet(f"{final}/sequences"), "feature_id").groupBy("feature_id", "seq").agg(F.sum("count").alias("n"), F.count(F.lit(1)).alias("samples"))


def project_states(spark, sf_dir):
    """States written twice: the last of a project holds, and only those with a file are complete."""
    path, out = _folder(spark, "states"), _folder(spark, "outputs")
    state = sinks.StateTable(spark, path)
    rows = read_table(spark, sf_dir, "nation").select(F.concat(F.lit("PRJNA"), F.col("n_nationkey").cast("string")).alias("id"), "n_nationkey")
    state.record(rows.select("id", F.lit("no_data").alias("status")))
    state.record(rows.where("n_nationkey % 2 = 0").select("id", F.lit("has_data").alias("status"), F.concat("id", F.lit(".csv")).alias("file")))
    for r in rows.where("n_nationkey % 4 = 0").collect():  # 25 nations
        sinks.write_text(spark, f"{out}/{r.id}.csv", "x")
    return state.read().select("id", "status").join(state.complete(out).withColumn("complete", F.lit(True)), "id", "left").select("id", "status", F.coalesce("complete", F.lit(False)).alias("complete"))


NAMES = (
    "csv_round_trip run_info_batches biosample_text bioproject_records keyword_results run_csv_answers sheets_side_by_side fastq_round_trip fastq_source fasta_round_trip otu_text "
    "seven_number_text biom_round_trip file_links verified_files download_routes found_datasets processed_projects status_file search_files run_list_files primer_files summary_rows "
    "raw_count_file feature_table_files project_states"
).split()
QUERIES = {n: globals()[n] for n in NAMES}

_M, _B, _R, _F = (sql(t) for t in (META, BIOSAMPLE, READS, FEATURES))
_TABLE = f"(select feature_id, sample_id, cast(sum(n) as bigint) as n from {_F} group by all)"
_Q = ", ".join(f"round(quantile_cont(q, {p}), 4) as {c}" for c, p in (("q02", 0.02), ("q09", 0.09), ("q25", 0.25), ("q50", 0.5), ("q75", 0.75), ("q91", 0.91), ("q98", 0.98)))
_RUNS = f"(select distinct case when ord % 13 = 0 then 'X' || run else run end as run, coalesce(bioproject, 'none') as submission from {_M})"
ORACLE_SQL = {
    "csv_round_trip": f"select ord, run, bioproject, biosample, 'a \"quoted\", ' || priority as priority from {_M}",
    "run_info_batches": f"select run, bioproject, ord from {_M} where bioproject is not null",
    "biosample_text": f"select biosample, title, 'org ' || host as organism, host, bioproject as project from {_B} where biosample is not null",
    "bioproject_records": f"select distinct bioproject as accession, 'T ' || bioproject as title, 'D' as description, 'soil' as organism from {_M} where bioproject is not null",
    "keyword_results": "select 'PRJCA' || p_partkey as accession, p_name as title, p_type as description, p_brand as organism from part",
    "run_csv_answers": f"select bioproject, run, 'x, ' || status as title from {_M} where bioproject is not null",
    "sheets_side_by_side": f"""
        select coalesce(a.pos, b.pos) as pos, run, title from (select run, row_number() over (order by ord) as pos from {_M}) a
        full join (select title, row_number() over (order by ord) as pos from {_B}) b on a.pos = b.pos""",
    "fastq_round_trip": f"select header, seq, qual from {_R}",
    "fastq_source": f"select header, seq, qual from {_R}",
    "fasta_round_trip": f"select project || '_' || md5(upper(seq)) as name, upper(seq) as seq, count(*) as size from {_R} group by project, upper(seq)",
    "otu_text": f"select * from {_TABLE}",
    "seven_number_text": f"""
        select pos, count(*) as reads, {_Q} from (select pos, ascii(substr(qual, cast(pos + 1 as int), 1)) - 33 as q from {_R}, (select unnest(range(120)) as pos) where project = 'PRJNA3' and pos < length(qual)) group by pos""",
    "biom_round_trip": f"select * from {_TABLE}",
    "file_links": """
        with f as (select 'SRR' || o_orderkey as run, unnest(case when o_orderkey % 3 = 0 then ['_1', '_2'] when o_orderkey % 3 = 1 then [''] else ['', '_1'] end) as x from orders)
        select run, 'ftp/' || run || x || '.fastq.gz' as url, md5(run || x) as md5 from f""",
    "verified_files": "select 'f' || p_partkey || '.gz' as file, p_partkey % 11 <> 0 and p_partkey % 7 <> 0 as whole from part",
    "download_routes": f"""
        select run, submission, case when run like 'CRR%' then 'cncb' when regexp_matches(run, '^[SED]RR') then 'ena' else 'unknown' end as archive, row_number() over (partition by submission order by run) as rank from {_RUNS}""",
    "found_datasets": "select cast(n_nationkey as varchar) as dataset_id, n_nationkey % 3 <> 0 as whole from nation",
    "processed_projects": f"""
        select bioproject, case when bioproject like 'PRJNA1%' then 2 else 1 end as version, count(*) as runs, cast(sum(ord) as bigint) as ords from {_M} where bioproject is not null group by all""",
    "status_file": f"select bioproject as id, min(status) as status from {_M} where bioproject is not null group by bioproject",
    "search_files": f"select bioproject as accession, count(*) as runs from {_M} where bioproject is not null group by bioproject",
    "run_list_files": f"select bioproject as dataset_id, run, coalesce(biosample, run) as sample_name from {_M} where bioproject is not null",
    "primer_files": "select n_name as name, cast(n_nationkey as bigint) as length from nation",
    "summary_rows": f"select bioproject, run, biosample as sample, ord as raw_reads, ord % 100 as final_reads from {_M}",
    "raw_count_file": f"select sample_id, count(*) as raw_reads from {_R} group by sample_id",
    "feature_table_files": f"""
        select md5(upper(seq)) as feature_id, upper(seq) as seq, count(*) as n, count(distinct sample_id) as samples from {_R} group by upper(seq)""",
    "project_states": """
        select 'PRJNA' || n_nationkey as id, case when n_nationkey % 2 = 0 then 'has_data' else 'no_data' end as status, n_nationkey % 4 = 0 as complete from nation""",
}
