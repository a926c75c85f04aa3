"""Sources of metadata: identifier lists, archive responses and tables of older tools."""

from __future__ import annotations

import functools
import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tarnflow.functions import sequence as S
from tarnflow.operators import metadata as M
from tarnflow.operators.letters import bytes_of
from tarnflow.session import broadcast_if_small, stage
from tarnflow.sources.sinks import BIOM_BY_LINES


def id_lists(spark: SparkSession, folder: str) -> DataFrame:
    """Identifiers of all text files of a folder, in the order of files and lines, the first of equals."""
    whole = spark.read.text(f"{folder}/*.txt", wholetext=True).select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file"), F.posexplode(F.split("value", "\n")).alias("ord", "value"))
    return M.id_list(whole.withColumn("value", F.regexp_replace("value", "\r", "")))


def metadata_csv(spark: SparkSession, path: str) -> DataFrame:
    """A table of strings with its header; quotes may hold line breaks."""
    return spark.read.csv(path, header=True, inferSchema=False, multiLine=True, escape='"')


def run_info(spark: SparkSession, path: str) -> DataFrame:
    """Run tables that were fetched in batches: the header lines of later batches drop out."""
    return metadata_csv(spark, path).where("Run is not null and Run <> 'Run'")


def keyword_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Search results of the second archive under common names; lines of another width are skipped."""
    names = ["Accession", "Title", "Description", "Species"]
    lines = spark.read.text(path).where(F.size(F.split("value", "\t")) == len(names))
    cells = F.split("value", "\t")
    rows = lines.select(*[F.trim(cells[i]).alias(n) for i, n in enumerate(("accession", "title", "description", "organism"))])
    return rows.where(F.col("accession") != names[0])


def run_csv_text(responses: DataFrame, text: str, columns: list[str]) -> DataFrame:
    """Rows of CSV responses held in a column; a response without a line below its header has none."""
    lines = responses.where(F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) >= 2)
    rows = lines.select(*[c for c in responses.columns if c != text], F.posexplode(F.split(text, "\r?\n")).alias("line", "row")).where("line > 0 and trim(row) <> ''")
    parsed = F.from_csv("row", ", ".join(f"`{c}` string" for c in columns))
    return rows.withColumn("r", parsed).select(*[c for c in responses.columns if c != text], "line", "r.*")


def bioproject_xml(spark: SparkSession, path: str) -> DataFrame:
    """Accession, title, description and organism of each project record."""
    parts = {
        "ProjectID": "struct<ArchiveID: struct<_accession: string>>",
        "ProjectDescr": "struct<Title: string, Description: string>",
        "ProjectType": "struct<ProjectTypeSubmission: struct<Target: struct<Organism: struct<OrganismName: string>>>>",
    }
    inner = ", ".join(f"{k}: {v}" for k, v in parts.items())
    rows = spark.read.format("xml").option("rowTag", "Project").schema(", ".join(f"{k} {v}" for k, v in parts.items()) + f", Project struct<{inner}>").load(path)
    pick = lambda p: F.coalesce(F.col(p), F.col(f"Project.{p}"))  # noqa: E731  records may be wrapped once more
    return rows.select(
        pick("ProjectID.ArchiveID._accession").alias("accession"), pick("ProjectDescr.Title").alias("title"), pick("ProjectDescr.Description").alias("description"),
        pick("ProjectType.ProjectTypeSubmission.Target.Organism.OrganismName").alias("organism"),
    ).where("accession is not null")


def bioproject_answers(answers: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """``keep`` columns with accession, title, description and organism of each project record in XML answers."""
    record = F.explode(F.slice(F.split(text, "(?=<ProjectID>)"), 2, 1 << 20))
    rows = answers.select(*keep, record.alias("x"))

    def plain(pattern: str):
        found = F.regexp_extract("x", pattern, 1)
        for mark, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
            found = F.replace(found, F.lit(mark), F.lit(sign))
        return F.nullif(F.trim(found), F.lit(""))

    return rows.select(
        *keep, plain(r"""<ArchiveID[^>]*accession=["']([^"']+)""").alias("accession"), plain("(?s)<Title>(.*?)</Title>").alias("title"),
        plain("(?s)<Description>(.*?)</Description>").alias("description"), plain("(?s)<OrganismName>(.*?)</OrganismName>").alias("organism"),
    ).where("accession is not null")


def keyword_answers(answers: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """``keep`` columns with the common names' values of tab-separated search answers; lines of another width are skipped."""
    lines = answers.select(*keep, F.explode(F.split(text, "\r?\n")).alias("line"))
    cells = F.split("line", "\t")
    rows = lines.where(F.size(cells) == 4).select(*keep, *[F.trim(cells[i]).alias(n) for i, n in enumerate(("accession", "title", "description", "organism"))])
    return rows.where("accession <> 'Accession'")


def biosample_blocks(texts: DataFrame, text: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Records of BioSample text responses: accession, title, identifiers, organism, a map of attributes, the record's
    ``uid``, its description and its keywords, beside the ``keep`` columns.

    A record begins with its number and a colon at the start of a line. An attribute that repeats keeps its first value.
    """
    keep = keep or []
    blocks = texts.select(*keep, F.explode(F.split(F.regexp_replace(text, "\r", ""), r"\n(?=\d+:\s+)")).alias("b")).where(F.trim("b") != "")
    b = F.col("b")
    keys = F.regexp_extract_all(b, F.lit(r'(?m)^\s*/([^=\n]+)="([^"]*)"'), F.lit(1))
    values = F.regexp_extract_all(b, F.lit(r'(?m)^\s*/([^=\n]+)="([^"]*)"'), F.lit(2))
    pairs = F.arrays_zip(keys.alias("k"), values.alias("v"))
    first = F.filter(pairs, lambda x, i: (i == 0) | ~F.exists(F.slice(pairs, F.lit(1), F.greatest(i, F.lit(1))), lambda y: y["k"] == x["k"]))
    found = lambda p: F.nullif(F.trim(F.regexp_extract(b, p, 1)), F.lit(""))
    ids = found(r"(?m)^\s*Identifiers:\s*(.*)$")
    accession = F.coalesce(found(r"Accession:\s*(SAM\w+)"), found(r"BioSample:\s*(SAM\w+)"))
    return blocks.select(
        *keep, accession.alias("biosample"), found(r"^\s*\d+:\s+(.*)").alias("title"), ids.alias("identifiers"), found(r"(?m)^\s*Organism:\s*(.*)$").alias("organism"),
        F.map_from_entries(F.transform(first, lambda x: F.struct(F.trim(x["k"]), F.trim(x["v"])))).alias("attributes"),
        found(r"(?m)\bID:\s*(\d+)\s*$").alias("uid"), found(r"(?ms)^Description:\s*(.*?)(?=^\S+:|\z)").alias("description"), found(r"(?m)^Keywords:\s*(.*)$").alias("keywords"),
    )


def attribute_columns(samples: DataFrame, names: list[str]) -> DataFrame:
    """The wide form for a sink: a column for each listed attribute."""
    return samples.select("biosample", "title", "organism", *[F.try_element_at("attributes", F.lit(n)).alias(n) for n in names])


def sheets(tables: dict[str, DataFrame], order: str = "ord") -> DataFrame:
    """Sheets side by side by row position, their columns prefixed with the sheet's name."""
    out = None
    for name, table in tables.items():
        own = table.select(F.col(order).alias(f"__{name}_ord"), *[F.col(c).alias(f"{name}_{c}") for c in table.columns if c != order])
        out = M.numbered(own, f"__{name}_ord").drop(f"__{name}_ord") if out is None else M.zipped(out, own, "pos", f"__{name}_ord").drop(f"__{name}_ord")
    return out


_SHEET = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def workbook_rows(content: bytes) -> dict[str, list[list[str | None]]]:
    """The cells of each sheet of a workbook as text, row by row; cells that a row leaves out are null."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        part = lambda name: ElementTree.fromstring(book.read(name))
        joined = lambda e: "".join(t.text or "" for t in e.iter(f"{_SHEET}t"))
        shared = [joined(e) for e in part("xl/sharedStrings.xml")] if "xl/sharedStrings.xml" in book.namelist() else []
        targets = {e.get("Id"): e.get("Target").lstrip("/").removeprefix("xl/") for e in part("xl/_rels/workbook.xml.rels")}
        out = {}
        for sheet in part("xl/workbook.xml").iter(f"{_SHEET}sheet"):
            rows = []
            for row in part(f"xl/{targets[sheet.get(f'{_REL}id')]}").iter(f"{_SHEET}row"):
                cells: list[str | None] = []
                for cell in row.iter(f"{_SHEET}c"):
                    letters = re.match("[A-Z]*", cell.get("r", ""))[0]
                    place = functools.reduce(lambda n, x: 26 * n + ord(x) - 64, letters, 0) - 1 if letters else len(cells)
                    cells += [None] * (place - len(cells))
                    value = cell.find(f"{_SHEET}v")
                    if cell.get("t") == "inlineStr":
                        cells.append(joined(cell))
                    elif value is None or value.text is None:
                        cells.append(None)
                    else:
                        cells.append(shared[int(value.text)] if cell.get("t") == "s" else value.text)
                rows.append(cells)
            out[sheet.get("name")] = rows
    return out


def excel_sheets(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The sheets of one workbook as tables of strings with ``ord``, by the names in its first row.

    A workbook is a project's answer of some thousand rows; it is read by the driver, from any file system.
    """
    content = bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])
    out = {}
    for name, rows in workbook_rows(content).items():
        names = [c or f"column{i}" for i, c in enumerate(rows[0])] if rows else []
        schema = T.StructType([T.StructField("ord", T.LongType()), *(T.StructField(n, T.StringType()) for n in names)])
        cells = [(i, *(r + [None] * len(names))[: len(names)]) for i, r in enumerate(rows[1:])]
        out[name] = spark.createDataFrame(cells, schema)
    return out


def attribute_dictionary(answers: DataFrame, text: str = "value") -> DataFrame:
    """``name`` and ``synonym`` of each attribute in XML dictionaries: its harmonized name, its display name and synonyms."""
    blocks = answers.select(F.explode(F.regexp_extract_all(text, F.lit("(?s)<Attribute>(.*?)</Attribute>"), F.lit(1))).alias("b"))
    one = lambda tag: F.regexp_extract("b", f"(?s)<{tag}>(.*?)</{tag}>", 1)
    words = F.concat(F.array(one("Name")), F.regexp_extract_all("b", F.lit("(?s)<Synonym>(.*?)</Synonym>"), F.lit(1)))
    return blocks.select(one("HarmonizedName").alias("name"), F.explode(words).alias("synonym")).where("name <> '' and synonym <> ''")


#: Runs of zeros in a line of a wide table and the line breaks that stand for them, as no line holds any itself.
_ZEROS = (("\t0" * 64, "\n"), ("\n" * 64, "\r"))
#: Cells that begin at a byte.
_CELLS = np.zeros(256, np.int64)
_CELLS[[9, 10, 13]] = 1, 64, 64 * 64


def _strings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The bytes between each start and end as strings."""
    at = np.concatenate([[0], np.cumsum(end - start)])
    own = data[np.arange(at[-1]) + np.repeat(start - at[:-1], end - start)]
    return pa.Array.from_buffers(pa.large_string(), len(start), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(own)])


def filled_cells(lines: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array, np.ndarray]:
    """Of folded lines the first cells, the places and texts of the others that aren't 0, and which lines can't be read
    folded: those where the last zero of a run was only the beginning of a cell, as in 0.5."""
    data, offsets = bytes_of(lines)
    seps = np.flatnonzero(_CELLS.astype(bool)[data])
    first = np.searchsorted(seps, offsets)
    row = np.repeat(np.arange(len(lines)), np.diff(first))
    end = np.minimum(np.append(seps, len(data))[1:], offsets[row + 1])
    before = np.concatenate([[0], np.cumsum(_CELLS[data[seps]])])
    place = before[1:] - before[first[row]]
    tab, size = data[seps] == 9, end - seps - 1
    odd = np.zeros(len(lines), bool)
    odd[row[~tab & (size > 0)]] = True
    kept = np.flatnonzero(tab & ~((size == 1) & (np.append(data, 0)[seps + 1] == 48)))
    named = np.minimum(np.append(seps, len(data))[first[:-1]], offsets[1:])
    at = pa.array(np.searchsorted(row[kept], np.arange(len(lines) + 1)).astype(np.int32))
    lists = (pa.array(place[kept].astype(np.int32)), _strings(data, seps[kept] + 1, end[kept]).cast(pa.string()))
    return _strings(data, offsets[:-1], named).cast(pa.string()), *(pa.ListArray.from_arrays(at, x) for x in lists), odd


def _wide_rows(lines: DataFrame) -> DataFrame:
    """The first cell of each ``line`` and the ``places`` and ``texts`` of the others that aren't 0, beside the other columns.

    Zeros are folded in the JVM, so that few bytes of a wide line go to Python.
    """
    kept = [c for c in lines.columns if c != "line"]
    made = [T.StructField("name", T.StringType()), T.StructField("places", T.ArrayType(T.IntegerType())), T.StructField("texts", T.ArrayType(T.StringType()))]
    schema = T.StructType([lines.schema[c] for c in kept] + made)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(batch: pa.RecordBatch, found: tuple) -> pa.RecordBatch:
            columns = [*(batch.column(c) for c in kept), *found]
            return pa.RecordBatch.from_arrays([c.cast(arrow.field(i).type) for i, c in enumerate(columns)], schema=arrow)

        for batch in batches:
            *found, odd = filled_cells(batch.column("line"))
            plain = pa.array(~odd)
            yield out(batch.filter(plain), [x.filter(plain) for x in found])
            for i in np.flatnonzero(odd).tolist():  # one at a time, as they are as long as they were
                text = batch.column("line")[i].as_py()
                for run_of, mark in reversed(_ZEROS):
                    text = text.replace(mark, run_of)
                yield out(batch.slice(i, 1), filled_cells(pa.array([text]))[:3])

    folded = functools.reduce(lambda c, x: F.replace(c, F.lit(x[0]), F.lit(x[1])), _ZEROS, F.col("line"))
    return lines.select(*kept, folded.alias("line")).mapInArrow(run, schema)


def otu_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Long form of a feature table in text, with or without comment lines before its header.

    The text may be one file or parts of one table; parts without a header have the first part's columns. Files are read
    by lines, so tables may be larger than a cell, and once, as their zeros may be many times the rest.
    """
    at = F.struct(F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("n"))
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), at.alias("at"), F.col("value").alias("line")).where("trim(line) <> ''")
    is_header = functools.reduce(Column.__or__, (F.col("line").startswith(f"{mark}{name}\t") for mark in ("#", "") for name in ("OTU ID", "OTU", "Feature ID")))
    needed = lines.where(is_header | ~F.col("line").startswith("#"))
    rows = stage(_wide_rows(needed.select("file", "at", F.when(is_header, F.col("line")).alias("names"), "line")), "otu-rows")
    heads = stage(rows.where("names is not null").groupBy("file").agg(F.min_by("names", "at").alias("names"), F.min("at").alias("head")), "otu-heads")
    first = heads.agg(F.min("file")).first()[0]
    names = heads.select(F.col("file").alias("table"), F.posexplode(F.split("names", "\t")).alias("place", "sample_id")).where("place > 0")
    below = rows.where(~F.col("name").startswith("#")).join(F.broadcast(heads.select("file", "head")), "file", "left").where("head is null or at > head")
    table = F.coalesce(F.when(F.col("head").isNotNull(), F.col("file")), F.lit(first))
    named = below.select(table.alias("table"), S.header_id(F.col("name")).alias("feature_id"), F.explode(F.arrays_zip("places", "texts")).alias("c"))
    long = named.select("table", "feature_id", F.col("c.places").alias("place"), F.col("c.texts").cast("double").cast("long").alias("count")).where("count > 0")
    return long.join(broadcast_if_small(stage(names, "otu-names")), ["table", "place"]).select("feature_id", "sample_id", "count")


def biom_json(spark: SparkSession, path: str) -> DataFrame:
    """Long form of feature tables in the JSON layout of BIOM 1.0, sparse or dense, one file a table.

    The document of ``sinks.biom_json``, which may be in parts and larger than a cell, is read by lines.
    """
    by_lines = F.col("value").startswith("{") & F.col("value").contains(f'"generated_by": "{BIOM_BY_LINES}"') & F.col("value").endswith("[")
    if spark.read.text(path).where(by_lines).count() == 1:
        return _biom_lines(spark, path)
    schema = "rows array<struct<id: string>>, columns array<struct<id: string>>, data array<array<double>>, matrix_type string"
    table = spark.read.text(path, wholetext=True).select(F.from_json("value", schema).alias("t")).select("t.*")
    cells = table.select("rows", "columns", "matrix_type", F.posexplode("data").alias("i", "d"))
    sparse = cells.where("matrix_type = 'sparse'").select("rows", "columns", F.col("d")[0].cast("int").alias("r"), F.col("d")[1].cast("int").alias("c"), F.col("d")[2].alias("v"))
    dense = cells.where("matrix_type = 'dense'").select("rows", "columns", F.col("i").alias("r"), F.posexplode("d").alias("c", "v"))
    long = sparse.unionByName(dense).where("v > 0")
    return long.select(F.get("rows", F.col("r"))["id"].alias("feature_id"), F.get("columns", F.col("c"))["id"].alias("sample_id"), F.col("v").cast("long").alias("count"))


def _biom_lines(spark: SparkSession, path: str) -> DataFrame:
    """Long form of one document of a line for each row, column and cell; places are those of the lines."""
    at = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("n"))
    lines = spark.read.text(path).select(at.alias("at"), "value")
    is_cell = F.col("value").rlike(r"^,?\[")
    # All other lines in one numbering: the head, the rows, the line between, the columns, and two more.
    others = stage(M.numbered(lines.where(~is_cell), "at", "pos").drop("at"), "biom-lines")
    between = others.where(F.col("value").startswith('], "columns"')).agg(F.min("pos")).first()[0]
    items = others.where(F.col("value").rlike(r"^,?\{")).select("pos", F.get_json_object(F.ltrim(F.col("value"), F.lit(",")), "$.id").alias("id"))
    rows = items.where((F.col("pos") > 1) & (F.col("pos") < between)).select((F.col("pos") - 2).alias("r"), F.col("id").alias("feature_id"))
    columns = items.where(F.col("pos") > between).select((F.col("pos") - between - 1).alias("c"), F.col("id").alias("sample_id"))
    cell = F.from_json(F.ltrim(F.col("value"), F.lit(",")), "array<double>")
    cells = lines.where(is_cell).select(cell.alias("d")).select(F.col("d")[0].cast("long").alias("r"), F.col("d")[1].cast("long").alias("c"), F.col("d")[2].cast("long").alias("count"), F.col("d")[2].alias("v")).where("v > 0")
    named = cells.join(broadcast_if_small(stage(columns, "biom-columns")), "c").join(broadcast_if_small(stage(rows, "biom-rows")), "r")
    return named.select("feature_id", "sample_id", "count")


def seven_numbers(spark: SparkSession, path: str) -> DataFrame:
    """``pos``, ``reads`` and quantiles of a seven-number table, whose first line has the positions."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\r?\n")).alias("n", "line")).where("trim(line) <> ''")
    cells = lines.select("n", F.posexplode(F.split("line", "\t")).alias("c", "v"))
    label = {"count": "reads", "2%": "q02", "9%": "q09", "25%": "q25", "50%": "q50", "75%": "q75", "91%": "q91", "98%": "q98"}
    rows = cells.where("c = 0 and n > 0").select("n", F.col("v").alias("stat"))
    heads = cells.where("n = 0 and c > 0").select("c", F.col("v").cast("double").cast("long").alias("pos"))
    long = cells.where("n > 0 and c > 0").join(rows, "n").join(heads, "c").select("pos", "stat", F.col("v").cast("double").alias("value"))
    return long.groupBy("pos").pivot("stat", list(label)).agg(F.first("value")).select("pos", *[F.col(f"`{k}`").cast("long" if v == "reads" else "double").alias(v) for k, v in label.items()])


def file_report(spark: SparkSession, path: str) -> DataFrame:
    """One row per file of a run from a tab-separated report with several links in a cell."""
    rows = spark.read.csv(path, sep="\t", header=True)
    pair = F.arrays_zip(F.split("fastq_ftp", ";").alias("url"), F.split("fastq_md5", ";").alias("md5")) if "fastq_md5" in rows.columns else F.transform(F.split("fastq_ftp", ";"), lambda u: F.struct(u.alias("url"), F.lit(None).cast("string").alias("md5")))
    return rows.select("run_accession", F.explode(pair).alias("f")).select(F.col("run_accession").alias("run"), "f.url", "f.md5").where("url <> ''")


def chosen_files(files: DataFrame) -> DataFrame:
    """Of each run the two mates if both are there, else all its files; the rest of a paired run is left out."""
    mate = S.mate_of_path(F.col("url"))
    rows = files.withColumn("mate", mate)
    both = F.count_distinct("mate")
    paired = rows.groupBy("run").agg((both == 2).alias("paired"))
    return rows.join(paired, "run").where("not paired or mate is not null").drop("paired")


def fastq_files(paths: DataFrame, path: str = "path") -> DataFrame:
    """``sample``, ``mate`` and layout of files: PE where a sample has both mates, else SE."""
    rows = paths.select(path, S.sample_of_path(F.col(path)).alias("sample"), S.mate_of_path(F.col(path)).alias("mate"))
    both = F.max(F.col("mate")).over(Window.partitionBy("sample")) != F.min("mate").over(Window.partitionBy("sample"))
    return rows.withColumn("layout", F.when(F.coalesce(both, F.lit(False)), "PE").otherwise("SE"))


def checked_files(files: DataFrame, sums: DataFrame) -> DataFrame:
    """``file`` and whether its content's MD5 is the listed one; unlisted files are not."""
    own = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.md5("content").alias("got"))
    return own.join(sums.select("file", F.lower("md5").alias("md5")), "file", "left").select("file", F.coalesce(F.col("got") == F.col("md5"), F.lit(False)).alias("whole"))


def dataset_folders(spark: SparkSession, folder: str, needed: list[str]) -> DataFrame:
    """Data sets below a folder that have all the needed parts, by the layout ``dataset_id=X/part``."""
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    top = path_of(folder)
    files = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in files.listStatus(top) if s.isDirectory()] if files.exists(top) else []
    rows = [(n.removeprefix("dataset_id="), all(files.exists(path_of(f"{folder}/{n}/{p}")) for p in needed)) for n in sorted(names) if n.startswith("dataset_id=")]
    return spark.createDataFrame(rows, "dataset_id string, whole boolean")
