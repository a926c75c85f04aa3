"""Sinks: processed tables, reports, sequence files and the state of projects."""

from __future__ import annotations

import functools
import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tarnflow.operators import features as T
from tarnflow.operators.metadata import numbered
from tarnflow.session import broadcast_if_small, drop_staged, stage


def _files(spark: SparkSession, name: str) -> tuple:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One small file, by a temporary name and a rename, on any file system that Spark writes."""
    temporary, files = _files(spark, f"{path}.tmp")
    out = files.create(temporary, True)
    out.write(bytearray(text.encode()))
    out.close()
    final, _ = _files(spark, path)
    files.delete(final, False)
    if not files.rename(temporary, final):
        raise OSError(f"{path} can't be replaced")


def processed(table: DataFrame, path: str, project: str = "BioProject") -> None:
    """Parquet with a folder for each project; only the folders of projects in the table are replaced."""
    table.repartition(project).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(project).parquet(path)


def merged_csv(table: DataFrame, path: str, bom: bool = True) -> None:
    """One CSV file for people, its header marked with a byte order mark; for tables of a person's size."""
    named = table.select(*[F.col(f"`{c}`").alias(("\ufeff" + c) if bom and i == 0 else c) for i, c in enumerate(table.columns)])
    named.coalesce(1).write.mode("overwrite").csv(path, header=True, encoding="UTF-8", escape=chr(34))


def status_tsv(report: DataFrame, path: str) -> None:
    report.coalesce(1).write.mode("overwrite").csv(path, sep="\t", header=True)


def search_results(found: DataFrame, path: str) -> None:
    """The table, the list of its accessions, and a summary; only the list is ever read as identifiers."""
    found.write.mode("overwrite").csv(f"{path}/combined_results", header=True)
    found.select("accession").distinct().orderBy("accession").coalesce(1).write.mode("overwrite").text(f"{path}/bioproject_ids")
    counts = {r[0]: r[1] for r in found.groupBy("source").count().collect()}  # a row a source
    write_text(found.sparkSession, f"{path}/search_summary.txt", "".join(f"{k}: {v}\n" for k, v in sorted(counts.items())))


def run_lists(runs: DataFrame, path: str) -> None:
    """Run and sample name by data set, tab-separated without a header."""
    runs.select("dataset_id", "run", "sample_name").repartition("dataset_id").write.mode("overwrite").partitionBy("dataset_id").csv(path, sep="\t", header=False)


def fastq_text(header: Column, seq: Column, qual: Column) -> Column:
    return F.concat_ws("\n", header, seq, F.lit("+"), qual)


def fasta_text(name: Column, seq: Column, size: Column | None = None) -> Column:
    """A record, with the abundance in the label if it is given."""
    label = F.concat(F.lit(">"), name) if size is None else F.concat(F.lit(">"), name, F.lit(";size="), size.cast("string"))
    return F.concat_ws("\n", label, seq)


def write_fastq(reads: DataFrame, path: str) -> None:
    """Gzip text on any file system; a file for each partition of the reads."""
    reads.select(fastq_text(F.col("header"), F.col("seq"), F.col("qual")).alias("value")).write.mode("overwrite").option("compression", "gzip").text(path)


def write_fasta(seqs: DataFrame, path: str, size: str | None = None) -> None:
    seqs.select(fasta_text(F.col("name"), F.col("seq"), F.col(size) if size else None).alias("value")).write.mode("overwrite").text(path)


def primer_json(info: DataFrame, path: str) -> None:
    info.write.mode("overwrite").text(path) if info.columns == ["value"] else info.select(F.col("primer_info").alias("value")).write.mode("overwrite").text(path)


def append_summary(rows: DataFrame, path: str) -> None:
    """More rows of the summary; the committer takes the place of a lock."""
    rows.select("bioproject", "run", "sample", "raw_reads", "final_reads").write.mode("append").parquet(path)


def raw_count_tsv(counts: DataFrame, path: str) -> None:
    counts.write.mode("overwrite").csv(path, sep="\t", header=False)


def feature_table(table: DataFrame, seqs: DataFrame, path: str) -> None:
    """A checked table and its sequences."""
    T.checked(table, seqs).write.mode("overwrite").parquet(f"{path}/table")
    T.same_features(seqs, table).write.mode("overwrite").parquet(f"{path}/sequences")


def otu_tsv(table: DataFrame, path: str, note: str, compression: str | None = None) -> None:
    """A feature table as text, a column a sample, below a comment and a header.

    The folder's parts in the order of their names make up the text; the first holds the header. Its zeros grow with
    features times samples, so the parts of large tables should have a ``compression`` that the reader knows by their names.
    """
    places = T.sample_places(table)
    names = places.agg(F.sort_array(F.collect_list(F.struct("place", "sample_id"))).alias("x"))
    header = names.select(F.concat(F.lit(f"# {note}\n"), F.array_join(F.concat(F.array(F.lit("#OTU ID")), F.col("x")["sample_id"]), "\t")).alias("value"))
    rows = T.pivoted(table, places).select(F.concat("feature_id", F.lit("\t"), T.dense(places.count(), "\t")).alias("value"))
    header.coalesce(1).unionAll(rows).write.mode("overwrite").text(path, compression=compression)


#: In the ``generated_by`` of a document whose rows, columns and cells have a line each, in this order.
BIOM_BY_LINES = "tarnflow, an item a line"


def biom_json(table: DataFrame, path: str) -> None:
    """A feature table (``feature_id``, ``sample_id``, ``count``) in the sparse JSON layout of BIOM 1.0, for other tools.

    The folder's parts in the order of their names make up one document, of a line for each row, column and cell, so that
    no task holds more than its own lines. A comma goes before every item but a list's first.
    """
    ids = {k: stage(numbered(table.select(k).where(F.col(k).isNotNull()).distinct(), k, "pos").select(k, (F.col("pos") - 1).alias(at)), f"biom-{k}") for k, at in (("feature_id", "i"), ("sample_id", "j"))}
    placed = table.join(broadcast_if_small(ids["sample_id"]), "sample_id").join(broadcast_if_small(ids["feature_id"]), "feature_id")
    cells = stage(placed.select("i", "j", F.col("count").cast("long").alias("n"), F.monotonically_increasing_id().alias("r")), "biom-cells")
    first = cells.agg(F.min("r")).first()[0]
    one = cells.sparkSession.range(1, numPartitions=1)
    mark = {"id": None, "format": "Biological Observation Matrix 1.0.0", "type": "OTU table", "generated_by": BIOM_BY_LINES, "matrix_type": "sparse", "matrix_element_type": "int"}
    head = json.dumps(mark | {"shape": [ids["feature_id"].count(), ids["sample_id"].count()]})[:-1]

    def items(k: str, at: str) -> DataFrame:
        text = F.to_json(F.struct(F.col(k).alias("id")))
        return ids[k].repartitionByRange(at).sortWithinPartitions(at).select(F.concat(F.when(F.col(at) > 0, ",").otherwise(""), text).alias("value"))

    cell = F.to_json(F.array("i", "j", "n"))
    parts = [
        one.select(F.lit(f'{head}, "rows": [').alias("value")), items("feature_id", "i"),
        one.select(F.lit('], "columns": [').alias("value")), items("sample_id", "j"),
        one.select(F.lit('], "data": [').alias("value")), cells.where(F.col("r") == first).select(cell.alias("value")).coalesce(1),
        cells.where(F.col("r") != first).select(F.concat(F.lit(","), cell).alias("value")), one.select(F.lit("]}").alias("value")),
    ]
    functools.reduce(DataFrame.unionAll, parts).write.mode("overwrite").text(path)
    for old in (*ids.values(), cells):
        drop_staged(old)


def finalize(spark: SparkSession, staging: str, final: str) -> None:
    """Put a finished folder in its place and drop the staging folder's rest."""
    source, files = _files(spark, f"{staging}/final")
    target, _ = _files(spark, final)
    files.delete(target, True)
    files.mkdirs(target.getParent())
    if not files.rename(source, target):
        raise OSError(f"{final} can't be put in place")
    files.delete(_files(spark, staging)[0], True)


class StateTable:
    """States of projects in a folder with a part for each project: the last write of a project holds."""

    SCHEMA = "status string, source string, rows long, file string, stage string, error string, updated timestamp, id string"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def record(self, states: DataFrame) -> None:
        """Replace the states of the given ids (``id`` and any of the columns)."""
        given = set(states.columns)
        names = [x.split() for x in self.SCHEMA.split(", ")]
        filled = states.select(*[F.col(n).cast(t).alias(n) if n in given else (F.current_timestamp() if n == "updated" else F.lit(None).cast(t)).alias(n) for n, t in names])
        filled.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("id").parquet(self.path)

    def read(self) -> DataFrame:
        path, files = _files(self.spark, self.path)
        if not files.exists(path):
            return self.spark.createDataFrame([], self.SCHEMA)
        return self.spark.read.schema(self.SCHEMA).parquet(self.path)

    def complete(self, folder: str) -> DataFrame:
        """Ids that are recorded as having data and whose file is there."""
        done = self.read().where("status = 'has_data'").select("id", "file")
        path, files = _files(self.spark, folder)
        if not files.exists(path):
            return done.select("id").limit(0)
        # The folder is listed once, with its folders by project, however many ids there are.
        names = [(s.getPath().getName(),) for s in files.listStatus(path)]
        listed = self.spark.createDataFrame(names, "file string")
        return done.join(listed, "file", "left_semi").select("id")


def _exists(spark: SparkSession, name: str) -> bool:
    path, files = _files(spark, name)
    return files.exists(path)
