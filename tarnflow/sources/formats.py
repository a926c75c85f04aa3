"""FASTQ and FASTA as Spark data sources: ``spark.read.format("fastq").load(folder)``.

A file is one partition: compressed sequence files can't be split, and the number of a read in its file
matters. The reads of a file are streamed in bounded batches. The path must be open to Python on the
executors; for stores that only Spark reads, and for large plain files, use ``read_fastq``.
"""

from __future__ import annotations

import glob
import gzip
import io
import os
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tarnflow.schema import FASTA, READS
from tarnflow.session import stage

BATCH = 10_000


class DamagedFile(ValueError):
    """A sequence file that breaks off or doesn't follow its format."""


def opened(path: str) -> io.TextIOBase:
    return gzip.open(path, "rt", encoding="ascii", errors="replace") if path.endswith(".gz") else open(path, encoding="ascii", errors="replace")


def fastq_records(lines: Iterable[str], name: str) -> Iterator[tuple[str, str, str]]:
    """(header, seq, qual) of each record; raises DamagedFile for records that aren't whole."""
    rows = iter(lines)
    for header in rows:
        header = header.rstrip("\r\n")
        if not header:
            continue
        seq, plus, qual = (next(rows, "").rstrip("\r\n") for _ in range(3))
        if not header.startswith("@") or not plus.startswith("+") or len(seq) != len(qual):
            raise DamagedFile(f"{name}: a record at {header[:40]!r} isn't whole")
        yield header, seq, qual


def fasta_records(lines: Iterable[str]) -> Iterator[tuple[str, str]]:
    """(name, upper-cased sequence); sequences may stand on several lines."""
    name, parts = None, []
    for line in lines:
        line = line.strip()
        if line.startswith(">"):
            if name is not None:
                yield name, "".join(parts).upper()
            name, parts = line[1:], []
        elif line and name is not None:
            parts.append(line)
    if name is not None:
        yield name, "".join(parts).upper()


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _Reader(DataSourceReader):
    kind: StructType
    patterns: tuple[str, ...] = ()

    def __init__(self, options: dict):
        self.path, self.limit, self.file = options["path"], None, None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Takes over limits on the number of a read, so that a file is left once enough are read, and file names."""
        for f in filters:
            if isinstance(f, (LessThan, LessThanOrEqual)) and f.attribute == (self.counter,) and isinstance(f.value, int):
                limit = f.value + isinstance(f, LessThanOrEqual)
                self.limit = limit if self.limit is None else min(limit, self.limit)
            elif isinstance(f, EqualTo) and f.attribute == ("file",):
                self.file = f.value
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        path = self.path.removeprefix("file://")
        found = sorted(x for p in self.patterns for x in glob.glob(os.path.join(path, p))) if os.path.isdir(path) else sorted(glob.glob(path))
        return [_File(x) for x in found if self.file in (None, os.path.basename(x))]

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        arrow, rows, name = to_arrow_schema(self.kind), [], os.path.basename(partition.path)
        with opened(partition.path) as f:
            for i, record in enumerate(self.records(f, name)):
                if self.limit is not None and i >= self.limit:
                    break
                rows.append((name, i, *record))
                if len(rows) == BATCH:
                    yield _batch(rows, arrow)
                    rows = []
        if rows:
            yield _batch(rows, arrow)


def _batch(rows: list[tuple], arrow: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), arrow.types, strict=True)], schema=arrow)


class _FastqReader(_Reader):
    kind, patterns, counter = READS, ("*.fastq", "*.fastq.gz", "*.fq", "*.fq.gz"), "read_idx"

    def records(self, lines, name):
        return fastq_records(lines, name)


class _FastaReader(_Reader):
    kind, patterns, counter = FASTA, ("*.fa", "*.fas", "*.fasta", "*.fna", "*.fa.gz", "*.fasta.gz"), "ord"

    def records(self, lines, name):
        return fasta_records(lines)


class _Writer(DataSourceWriter):
    """One gzip file for each task, under a temporary name until the whole job has succeeded."""

    def __init__(self, options: dict, schema: StructType, form):
        self.path, self.names, self.form, self.suffix = options["path"].removeprefix("file://"), schema.names, form, options.get("suffix", ".gz")

    def write(self, rows) -> WriterCommitMessage:
        from pyspark import TaskContext

        task = TaskContext.get()
        os.makedirs(self.path, exist_ok=True)
        name = os.path.join(self.path, f"part-{task.partitionId():05d}{self.suffix}")
        temporary = f"{name}.{task.taskAttemptId()}.tmp"
        with gzip.open(temporary, "wt", compresslevel=4) as f:
            for row in rows:
                f.write(self.form(row))
        return _Written(name, temporary)

    def commit(self, messages) -> None:
        for m in messages:
            if m is not None:
                os.replace(m.temporary, m.name)

    def abort(self, messages) -> None:
        for m in messages:
            if m is not None and os.path.exists(m.temporary):
                os.remove(m.temporary)


class _Written(WriterCommitMessage):
    def __init__(self, name: str, temporary: str):
        self.name, self.temporary = name, temporary


def _fastq_text(row) -> str:
    return f"{row['header']}\n{row['seq']}\n+\n{row['qual']}\n"


def _fasta_text(row) -> str:
    return f">{row['name']}\n{row['seq']}\n"


class FastqSource(DataSource):
    """Columns: file, read_idx (from 0), header, seq, qual. Writing takes header, seq and qual."""

    @classmethod
    def name(cls) -> str:
        return "fastq"

    def schema(self) -> StructType:
        return READS

    def reader(self, schema: StructType) -> DataSourceReader:
        return _FastqReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return _Writer({"suffix": ".fastq.gz"} | dict(self.options), schema, _fastq_text)


class FastaSource(DataSource):
    """Columns: file, ord (from 0), name, seq. Writing takes name and seq."""

    @classmethod
    def name(cls) -> str:
        return "fasta"

    def schema(self) -> StructType:
        return FASTA

    def reader(self, schema: StructType) -> DataSourceReader:
        return _FastaReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return _Writer({"suffix": ".fasta.gz"} | dict(self.options), schema, _fasta_text)


def register(spark: SparkSession) -> None:
    """Make the formats known to a session, with filters pushed into them."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    for source in (FastqSource, FastaSource):
        spark.dataSource.register(source)


def _whole_records(lines: DataFrame) -> DataFrame:
    """Reads of files that are one split each: their lines follow each other, so four are a record. Streamed in batches."""
    arrow = to_arrow_schema(READS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, name, number, held = None, None, 0, []

        def records(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal number, held
            whole = len(held) if last else len(held) // 4 * 4
            part, held = held[:whole], held[whole:]
            rows = [(name, number + i, *r) for i, r in enumerate(fastq_records(part, name))]
            number += len(rows)
            if rows:
                yield _batch(rows, arrow)

        for batch in batches:
            files, values = batch.column("file"), batch.column("value").to_pylist()
            marks = batch.column("path").dictionary_encode()
            codes = marks.indices.to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(np.diff(codes)) + 1).tolist(), len(codes)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                own = marks.dictionary[int(codes[a])].as_py()
                if own != path:
                    yield from records(True)
                    path, name, number = own, files[a].as_py(), 0
                held += values[a:b]
                if len(held) >= 4 * BATCH:
                    yield from records(False)
        yield from records(True)

    return lines.select("path", "file", "value").mapInArrow(run, READS)


def _cut_records(lines: DataFrame, blocks: DataFrame) -> DataFrame:
    """Reads of files that are cut into splits: a line's number is its place in the split and the lines of the splits before."""
    before = F.sum("n").over(Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    offsets = blocks.withColumn("before", F.coalesce(before, F.lit(0))).drop("n")
    numbered = lines.join(F.broadcast(offsets), ["path", "block"]).withColumn("n", F.col("r") - F.col("first") + F.col("before"))
    at = lambda k: F.max(F.when(F.col("n") % 4 == k, F.rtrim("value", F.lit("\r")))).alias(f"v{k}")
    found = numbered.groupBy("path", "file", F.floor(F.col("n") / 4).alias("read_idx")).agg(*[at(k) for k in range(4)])
    whole = F.col("v0").startswith("@") & F.col("v2").startswith("+") & (F.length("v1") == F.length("v3"))
    blank = (F.coalesce("v0", F.lit("")) == "") & (F.coalesce("v1", "v2", "v3", F.lit("")) == "")
    broken = F.raise_error(F.concat("file", F.lit(": record "), F.col("read_idx").cast("string"), F.lit(" isn't whole")))
    checked = F.when(F.coalesce(whole, F.lit(False)), F.col("v0")).otherwise(broken.cast("string"))
    return found.where(~blank).select("file", "read_idx", checked.alias("header"), F.col("v1").alias("seq"), F.col("v3").alias("qual"))


def read_fastq(spark: SparkSession, path: str) -> DataFrame:
    """FASTQ files, plain or gzip, by Spark's own reader, from any store and of any size.

    A gzip file is one stream and is read in order by one task. Plain files are split like any text; their lines are
    numbered by the splits before theirs, so that large files are read by many tasks. Blank lines are only allowed at the
    end of such a file. Two files of one name count as one in ``file``, but not in ``read_idx``.
    """
    text = spark.read.text(path)
    lines = text.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value", F.monotonically_increasing_id().alias("r"))
    blocks = stage(lines.groupBy("path", "block").agg(F.min("r").alias("first"), F.count(F.lit(1)).alias("n")), "fastq-blocks")
    cut = blocks.groupBy("path").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("path")
    if not cut.head(1):
        return _whole_records(lines)
    rest = _whole_records(lines.join(F.broadcast(cut), "path", "left_anti"))
    return rest.unionByName(_cut_records(lines.join(F.broadcast(cut), "path", "left_semi"), blocks.join(cut, "path", "left_semi")))


def intact(path: str) -> bool:
    """Whether a file exists, isn't empty, inflates to its end, and has a number of lines that four divides."""
    if not os.path.exists(path) or not os.path.getsize(path):
        return False
    try:
        with opened(path) as f:
            n = sum(1 for _ in f)
    except (OSError, EOFError, zlib.error):
        return False
    return n > 0 and n % 4 == 0
