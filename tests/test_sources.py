"""Round trips and hand-made fixtures of the sources and sinks."""

import gzip
import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from tarnflow.operators import features as T
from tarnflow.sources import connectors, formats, sinks, texts


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


FASTQ = "@r0 x\nACGT\n+\nIIII\n@r1\nGG\n+\n!!\n@r2\n\n+\n\n"


def test_fastq_source(spark, tmp_path):
    formats.register(spark)
    put(tmp_path / "in" / "b_1.fastq", FASTQ)
    with gzip.open(tmp_path / "in" / "a_R1.fastq.gz", "wt") as f:
        f.write(FASTQ)
    reads = spark.read.format("fastq").load(str(tmp_path / "in"))
    rows = reads.orderBy("file", "read_idx").collect()
    assert [(r.file, r.read_idx, r.seq, r.qual) for r in rows[:3]] == [("a_R1.fastq.gz", 0, "ACGT", "IIII"), ("a_R1.fastq.gz", 1, "GG", "!!"), ("a_R1.fastq.gz", 2, "", "")]
    assert reads.where("read_idx < 1").count() == 2
    assert formats.read_fastq(spark, str(tmp_path / "in")).orderBy("file", "read_idx").collect() == rows
    out = str(tmp_path / "out")
    reads.where("file = 'b_1.fastq'").coalesce(1).write.format("fastq").mode("append").save(out)
    assert [r.seq for r in spark.read.format("fastq").load(out).orderBy("read_idx").collect()] == ["ACGT", "GG", ""]
    sinks.write_fastq(reads.where("file = 'b_1.fastq'"), str(tmp_path / "text"))
    assert sum(1 for _ in spark.read.text(str(tmp_path / "text")).collect()) == 12


def test_large_plain_files_are_split(spark, tmp_path):
    """Plain files over many splits, beside a gzip file; a broken record is an error."""
    rows = [(f"@r{i}", "ACGT" * (i % 9), "I" * (4 * (i % 9))) for i in range(4000)]
    whole = "".join(f"{h}\n{s}\n+\n{q}\n" for h, s, q in rows)
    put(tmp_path / "in" / "a.fastq", whole)
    with gzip.open(tmp_path / "in" / "b.fastq.gz", "wt") as f:
        f.write(whole)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        got = formats.read_fastq(spark, str(tmp_path / "in")).collect()
        for name in ("a.fastq", "b.fastq.gz"):
            assert [(r.header, r.seq, r.qual) for r in sorted((r for r in got if r.file == name), key=lambda r: r.read_idx)] == rows
        put(tmp_path / "bad" / "c.fastq", whole + "@x\nAC\n+\nI\n")
        with pytest.raises(Exception, match="isn't whole"):
            formats.read_fastq(spark, str(tmp_path / "bad")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_broken_fastq(spark, tmp_path):
    with pytest.raises(formats.DamagedFile):
        list(formats.fastq_records(["@r", "ACG", "+", "II"], "x"))
    good, empty = put(tmp_path / "g.fastq", FASTQ), put(tmp_path / "e.fastq", "")
    cut = tmp_path / "c.fastq.gz"
    cut.write_bytes(gzip.compress(FASTQ.encode() * 100)[:-20])
    assert [formats.intact(p) for p in (good, empty, str(cut), str(tmp_path / "none"))] == [True, False, False, False]


def test_fasta_source(spark, tmp_path):
    formats.register(spark)
    put(tmp_path / "p.fas", ">27F one\nagrg\nTTYG\n>x\nAC\n")
    rows = spark.read.format("fasta").load(str(tmp_path)).orderBy("ord").collect()
    assert [(r.name, r.seq) for r in rows] == [("27F one", "AGRGTTYG"), ("x", "AC")]


def test_id_lists(spark, tmp_path):
    put(tmp_path / "a.txt", "PRJNA2\n# note\n\n PRJNA1 \r\nPRJNA2\n")
    put(tmp_path / "b.txt", "PRJNA1\nPRJNA3")
    assert [r.id for r in texts.id_lists(spark, str(tmp_path)).orderBy("file", "ord").collect()] == ["PRJNA2", "PRJNA1", "PRJNA3"]


def test_run_info_drops_later_headers(spark, tmp_path):
    path = put(tmp_path / "r.csv", "Run,BioProject\nSRR1,PRJNA1\nRun,BioProject\nSRR2,PRJNA1\n")
    assert [r.Run for r in texts.run_info(spark, path).orderBy("Run").collect()] == ["SRR1", "SRR2"]


def test_keyword_tsv(spark, tmp_path):
    path = put(tmp_path / "k.tsv", "Accession\tTitle\tDescription\tSpecies\nPRJCA1\tt\td\ts\nbad line\n")
    assert [tuple(r) for r in texts.keyword_tsv(spark, path).collect()] == [("PRJCA1", "t", "d", "s")]


def test_run_csv_text(spark):
    rows = spark.createDataFrame([("p", "Run,Title\nCRR1,a\n\nCRR2,\"b, c\"\n"), ("q", "Run,Title\n")], "project string, body string")
    assert [(r.project, r.Run, r.Title) for r in texts.run_csv_text(rows, "body", ["Run", "Title"]).orderBy("line").collect()] == [("p", "CRR1", "a"), ("p", "CRR2", "b, c")]


def test_bioproject_xml(spark, tmp_path):
    path = put(tmp_path / "x.xml", "<Set><Project><ProjectID><ArchiveID accession='PRJNA5'/></ProjectID><ProjectDescr><Title>T</Title><Description>D</Description></ProjectDescr></Project></Set>")
    assert tuple(texts.bioproject_xml(spark, path).first()) == ("PRJNA5", "T", "D", None)


def test_biosample_blocks(spark):
    text = '1: Soil sample\nIdentifiers: BioSample: SAMN01; SRA: SRS1\nOrganism: soil metagenome\nAttributes:\n    /host="none"\n    /geo="A, B"\n    /host="again"\nAccession: SAMN01\tID: 1\n\n2: Water\nIdentifiers: BioSample: SAMN02\nAccession: SAMN02\n'
    rows = texts.biosample_blocks(spark.createDataFrame([(text,)], "value string")).orderBy("biosample").collect()
    assert [(r.biosample, r.title, r.organism, r.attributes) for r in rows] == [("SAMN01", "Soil sample", "soil metagenome", {"host": "none", "geo": "A, B"}), ("SAMN02", "Water", None, {})]


def test_otu_and_seven_numbers(spark, tmp_path):
    otu = put(tmp_path / "o.tsv", "# made\n#OTU ID\tS1\tS2\nf1;size=3\t2.0\t0\nf2\t0\t5\n")
    assert sorted(map(tuple, texts.otu_tsv(spark, otu).collect())) == [("f1", "S1", 2), ("f2", "S2", 5)]
    seven = put(tmp_path / "s.tsv", "\t0\t1\ncount\t10\t9\n2%\t2\t2\n9%\t3\t3\n25%\t30\t29\n50%\t35\t35\n75%\t37\t37\n91%\t38\t38\n98%\t39\t39\n")
    assert [(r.pos, r.reads, r.q25) for r in texts.seven_numbers(spark, seven).orderBy("pos").collect()] == [(0, 10, 30.0), (1, 9, 29.0)]


def many_samples(spark):
    """More samples than a plan bears as columns, and the counts by feature and sample."""
    rows = [(f"f{i % 50:02d}", f"S{i * 37 % 6000:04d}", 1 + i % 9) for i in range(9000)]
    want = {}
    for f, s, n in rows:
        want[f, s] = want.get((f, s), 0) + n
    return spark.createDataFrame(rows, "feature_id string, sample_id string, count long"), want


def test_wide_rows_of_many_samples(spark):
    table, want = many_samples(spark)
    samples = sorted({s for _, s in want})
    wide = T.pivoted(table, T.sample_places(table))
    text = {r[0]: r[1] for r in wide.select("feature_id", T.dense(len(samples), " ")).collect()}
    assert text == {f: " ".join(str(want.get((f, s), 0)) for s in samples) for f in {f for f, _ in want}}


def test_wide_text_of_many_samples(spark, tmp_path):
    """Parts of one text, the first of which has the header."""
    table, want = many_samples(spark)
    sinks.otu_tsv(table.repartition(3), str(tmp_path / "otu"), "made")
    parts = sorted((tmp_path / "otu").glob("part-*"))
    assert len(parts) > 1 and parts[0].read_text().startswith("# made\n#OTU ID\tS0000\t")
    assert {(r[0], r[1]): r[2] for r in texts.otu_tsv(spark, str(tmp_path / "otu")).collect()} == want


def test_long_form_of_many_samples(spark):
    table, want = many_samples(spark)
    places = T.sample_places(table)
    assert {(r[0], r[1]): r[2] for r in T.unpivoted(T.pivoted(table, places), places, "feature_id").collect()} == want


def test_biom_json(spark, tmp_path):
    head = '"rows": [{"id": "f1"}, {"id": "f2"}], "columns": [{"id": "S1"}, {"id": "S2"}]'
    put(tmp_path / "a.biom", '{%s, "matrix_type": "sparse", "data": [[0, 1, 5], [1, 0, 2.0]]}' % head)
    put(tmp_path / "b.biom", '{%s, "matrix_type": "dense", "data": [[0, 5], [2, 0]]}' % head)
    for name in "ab":
        assert sorted(map(tuple, texts.biom_json(spark, str(tmp_path / f"{name}.biom")).collect())) == [("f1", "S2", 5), ("f2", "S1", 2)]


def test_biom_in_parts(spark, tmp_path):
    """The sink's document is valid as a whole, is written and read by lines, and bears odd names, repeats and nulls."""
    names = [f'f "{i}", {{[{i % 7}]}}\n' for i in range(60)]
    rows = [(names[i % 60], f"S{i * 37 % 900:03d},", 1 + i % 9) for i in range(3000)] + [(names[0], None, 3), (None, "S000,", 3), (names[1], "S001,", None), ("zero", "S000,", 0)]
    table = spark.createDataFrame(rows, "feature_id string, sample_id string, count long")
    sinks.biom_json(table.repartition(3), str(tmp_path / "biom"))
    parts = sorted((tmp_path / "biom").glob("part-*"))
    lines = "".join(p.read_text() for p in parts).split("\n")
    whole = json.loads("\n".join(lines))
    assert len(parts) > 1 and max(map(len, lines)) < 300 and whole["shape"] == [len(whole["rows"]), len(whole["columns"])]
    feature, sample = ([x["id"] for x in whole[k]] for k in ("rows", "columns"))
    want = sorted(r for r in rows if r[0] and r[1] and r[2])
    assert feature == sorted({r[0] for r in rows if r[0]}) and sample == sorted({r[1] for r in rows if r[1]})
    assert sorted((feature[i], sample[j], n) for i, j, n in whole["data"] if n) == want
    assert sorted(map(tuple, texts.biom_json(spark, str(tmp_path / "biom")).collect())) == want
    one = put(tmp_path / "one.biom", "\n".join(lines))
    assert sorted(map(tuple, texts.biom_json(spark, one).collect())) == want
    sinks.biom_json(table.limit(0), str(tmp_path / "none"))
    assert texts.biom_json(spark, str(tmp_path / "none")).count() == 0


def test_file_report(spark, tmp_path):
    path = put(tmp_path / "f.tsv", "run_accession\tfastq_ftp\nSRR1\th/SRR1.fastq.gz;h/SRR1_1.fastq.gz;h/SRR1_2.fastq.gz\nSRR2\th/SRR2.fastq.gz\n")
    files = texts.chosen_files(texts.file_report(spark, path))
    assert sorted(r.url for r in files.collect()) == ["h/SRR1_1.fastq.gz", "h/SRR1_2.fastq.gz", "h/SRR2.fastq.gz"]


def test_layout_and_checksums(spark, tmp_path):
    paths = spark.createDataFrame([("a_R1.fastq.gz",), ("a_R2.fastq.gz",), ("b.fastq",), ("c_1.fq",), ("d_f1.gz",)], "path string")
    assert {r.path: (r.sample, r.mate, r.layout) for r in texts.fastq_files(paths).collect()}["a_R2.fastq.gz"] == ("a", 2, "PE")
    put(tmp_path / "x.bin", "abc")
    files = spark.read.format("binaryFile").load(str(tmp_path))
    sums = spark.createDataFrame([("x.bin", hashlib.md5(b"abc").hexdigest().upper())], "file string, md5 string")
    assert texts.checked_files(files, sums).first()["whole"]


def test_workbook(spark, tmp_path):
    """A workbook put together by hand: shared, inline and plain cells, and cells that are left out."""
    import zipfile

    main, rel = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    row = lambda n, *cells: f'<row r="{n}">' + "".join(cells) + "</row>"
    sheet = f'<worksheet xmlns="{main}"><sheetData>' + row(1, '<c r="A1" t="s"><v>0</v></c>', '<c r="C1" t="inlineStr"><is><t>Size</t></is></c>') + row(2, '<c r="A2" t="s"><v>1</v></c>', '<c r="C2"><v>12</v></c>') + row(3, '<c r="C3"><v>7</v></c>') + "</sheetData></worksheet>"
    with zipfile.ZipFile(tmp_path / "a.xlsx", "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets><sheet name="Run" sheetId="1" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="x"><Relationship Id="r1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}"><si><t>Name</t></si><si><r><t>so</t></r><r><t>il</t></r></si></sst>')
        z.writestr("xl/worksheets/sheet1.xml", sheet)
    table = texts.excel_sheets(spark, str(tmp_path / "a.xlsx"))["Run"]
    assert table.columns == ["ord", "Name", "column1", "Size"]
    assert [tuple(r) for r in table.orderBy("ord").collect()] == [(0, "soil", None, "12"), (1, None, None, "7")]


def test_attribute_dictionary(spark):
    text = "<BioSampleAttributes><Attribute><Name>host age</Name><HarmonizedName>host_age</HarmonizedName><Synonym>age</Synonym><Synonym>HostAge</Synonym></Attribute><Attribute><Name>x</Name></Attribute></BioSampleAttributes>"
    rows = texts.attribute_dictionary(spark.createDataFrame([(text,)], "value string")).collect()
    assert sorted(map(tuple, rows)) == [("host_age", "HostAge"), ("host_age", "age"), ("host_age", "host age")]


def test_sheets_side_by_side(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "ord long, v string")
    b = spark.createDataFrame([(5, "p")], "ord long, w string")
    assert [(r.A_v, r.B_w) for r in texts.sheets({"A": a, "B": b}).orderBy("pos").collect()] == [("x", "p"), ("y", None)]


def test_connector_batches_and_retries(spark, tmp_path):
    (tmp_path / "summary.json").write_text(json.dumps({f"S{i}": f"answer {i}" for i in range(5)}))
    ids = spark.createDataFrame([(f"S{i}", i) for i in range(5)], "id string, ord long")
    requests = connectors.batched(ids, 2)
    assert [r.query for r in requests.orderBy("batch").collect()] == ["S0 OR S1", "S2 OR S3", "S4"]
    client = connectors.FailingClient(connectors.RecordedClient(str(tmp_path)), 2)
    got = connectors.fetched(requests.coalesce(1), client, "summary", pause=0.0).orderBy("batch").collect()
    assert [r.value for r in got] == ["answer 0\nanswer 1", "answer 2\nanswer 3", "answer 4"]
    with pytest.raises(ConnectionError):
        connectors.FailingClient(client, 9).fetch("summary", ["S1"])


def test_sinks(spark, tmp_path):
    table = spark.createDataFrame([("PRJNA1", "SRR1"), ("PRJNA2", "SRR2")], "BioProject string, Run string")
    sinks.processed(table, str(tmp_path / "p"))
    sinks.processed(table.where("Run = 'SRR2'").withColumn("Run", F.lit("SRR9")), str(tmp_path / "p"))
    assert sorted(r.Run for r in spark.read.parquet(str(tmp_path / "p")).collect()) == ["SRR1", "SRR9"]
    sinks.merged_csv(table, str(tmp_path / "m"))
    assert next((tmp_path / "m").glob("*.csv")).read_bytes().startswith(b"\xef\xbb\xbf")
    sinks.search_results(table.withColumns({"accession": F.col("BioProject"), "source": F.lit("NCBI")}), str(tmp_path / "s"))
    assert (tmp_path / "s" / "search_summary.txt").read_text() == "NCBI: 2\n"
    states = sinks.StateTable(spark, str(tmp_path / "state"))
    assert states.read().count() == 0
    states.record(spark.createDataFrame([("PRJNA1", "no_data", None), ("PRJNA2", "has_data", "p")], "id string, status string, file string"))
    states.record(spark.createDataFrame([("PRJNA1", "has_data", "gone")], "id string, status string, file string"))
    assert {r.id: r.status for r in states.read().collect()} == {"PRJNA1": "has_data", "PRJNA2": "has_data"}
    assert [r.id for r in states.complete(str(tmp_path)).collect()] == ["PRJNA2"]
    (tmp_path / "staging" / "final").mkdir(parents=True)
    (tmp_path / "staging" / "final" / "t").write_text("x")
    sinks.finalize(spark, str(tmp_path / "staging"), str(tmp_path / "done"))
    assert (tmp_path / "done" / "t").exists() and not (tmp_path / "staging").exists()


def test_dataset_folders(spark, tmp_path):
    for name, parts in (("a", ("table", "sequences")), ("b", ("table",))):
        for part in parts:
            (tmp_path / f"dataset_id={name}" / part).mkdir(parents=True)
    assert {r.dataset_id: r.whole for r in texts.dataset_folders(spark, str(tmp_path), ["table", "sequences"]).collect()} == {"a": True, "b": False}


def test_wide_text_zeros_take_little_room(spark, tmp_path):
    """The parts of a compressed wide table hold its whole text in a small part of the bytes, and are read by their names."""
    rows = [(f"f{i:04d}", f"S{i * 7 % 3000:04d}", 1 + i % 9) for i in range(3000)]
    table = spark.createDataFrame(rows, "feature_id string, sample_id string, count long")
    plain, packed = str(tmp_path / "plain"), str(tmp_path / "packed")
    sinks.otu_tsv(table, plain, "made")
    sinks.otu_tsv(table, packed, "made", compression="lz4")
    size = lambda p: sum(x.stat().st_size for x in (tmp_path / p).glob("part-*"))
    assert size("plain") > 18_000_000 and size("packed") < size("plain") / 50
    text = lambda p: sorted(r[0] for r in spark.read.text(p).collect())
    assert text(plain) == text(packed)
    assert sorted(map(tuple, texts.otu_tsv(spark, packed).collect())) == sorted(rows)


def test_wide_text_of_any_cells(spark, tmp_path):
    """Runs of zeros around the lengths that are folded, beside cells that only begin like them and odd names."""
    samples = [f"S{i}" for i in range(9000)]
    rng = random.Random(5)
    lines, want = [], []
    for n, gap in enumerate([0, 1, 62, 63, 64, 65, 127, 128, 129, 4095, 4096, 4097, 4160, 8191, 8192, 8999]):
        for v in ("7", "05", "0.9", "0.0", "3.0", "1e2", "10"):
            cells = ["0"] * 9000
            for at in {gap, 8999, *rng.sample(range(9000), n % 3)} - {9000}:
                cells[at] = v
                want += [(f"f'{n}_{v}", samples[at], int(float(v)))] * (float(v) >= 1)
            lines.append("\t".join([f"f'{n}_{v};size=3", *cells]))
    lines += ["\t".join(["zeros", *["0"] * 9000]), "name only", "\t".join(["OTU", "4"]), "\t".join(["0", "0", "0.5", "6"])]
    want += [("OTU", "S0", 4), ("0", "S2", 6)]
    path = put(tmp_path / "o.tsv", "\n".join(["# made", "before\t5", "\t".join(["#OTU ID", *samples]), *lines, "# end\t3"]) + "\n")
    assert sorted(map(tuple, texts.otu_tsv(spark, path).collect())) == sorted(want)


def test_wide_text_query_writes_no_reads_and_no_plain_zeros(spark, tmp_path, monkeypatch):
    """On large tables the staged reads and the plain zeros of the wide text outgrew the disk."""
    from conftest import DATA

    from tarnflow.plans import derived, io_queries

    monkeypatch.setattr(derived, "_STAGED", {})
    monkeypatch.setattr(derived, "stage", lambda *_: pytest.fail("the reads are staged"))
    monkeypatch.setattr(io_queries, "_folder", lambda _, name: str(tmp_path / name))
    assert io_queries.otu_text(spark, DATA).count() > 0
    parts = sorted(p.name for p in (tmp_path / "otu").glob("part-*"))
    assert parts and all(p.endswith(".lz4") for p in parts)
