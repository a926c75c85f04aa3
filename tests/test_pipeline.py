"""The drivers from end to end, resuming, and the streaming ingestion."""

import random

import pytest
from pyspark.sql import functions as F

from tarnflow.operators import metadata as M, reads as R
from tarnflow.pipeline import cli
from tarnflow.pipeline.process import process_study
from tarnflow.pipeline.runner import Phases, combine, harvest, milestones, outcome_counts
from tarnflow.streaming import ingest


def test_harvest(spark, tmp_path):
    ids = spark.createDataFrame([("PRJNA1",), ("PRJNA2",), ("PRJNA3",), ("what",)], "id string")
    sra = spark.createDataFrame([("SRR1", "PRJNA1", "SAMN1", "x"), ("SRR2", "PRJNA1", None, "y"), ("bad", "PRJNA2", "SAMN3", "z"), ("SRR7", "PRJNA9", "SAMN4", "z")], "Run string, BioProject string, BioSample string, lib_name string")
    samples = spark.createDataFrame([("SAMN1", "soil"), ("SAMN8", "sea")], "BioSample string, env string")
    phases = Phases(spark, str(tmp_path))
    table, states = harvest(phases, ids, sra, samples)
    assert table.columns == ["Run", "BioProject", "BioSample", "LibName", "env"]
    assert {r.id: r.status for r in states.collect()} == {"PRJNA1": "has_data", "PRJNA2": "no_run_info", "PRJNA3": "no_data", "what": "invalid_format"}
    again = Phases(spark, str(tmp_path))
    harvest(again, ids, sra, samples)
    assert phases.ran == ["joined", "standardized"] and again.ran == []


@pytest.fixture(scope="module")
def reads(spark):
    r = random.Random(3)
    dna = lambda n: "".join(r.choice("ACGT") for _ in range(n))
    true = [dna(120) for _ in range(5)]
    rows = []
    for i in range(600):
        seq = "CCAGCAGCCGCGGTAA" + true[i % 5 if i % 5 < 4 or i % 3 else 0]
        if i % 20 == 7:
            at = r.randrange(20, 130)  # errors differ, as errors do
            seq = seq[:at] + ("A" if seq[at] != "A" else "C") + seq[at + 1 :]
        rows.append(("ds", f"S{i % 3}", f"S{i % 3}.fastq", i, f"@r{i}", seq, "".join(r.choice("FGHI") for _ in seq)))
    return true, spark.createDataFrame(rows, "dataset_id string, sample_id string, file string, read_idx long, header string, seq string, qual string")


@pytest.mark.parametrize("platform", ["ILLUMINA", "LS454"])
def test_reads_to_features_to_taxa(spark, tmp_path, reads, platform):
    true, frame = reads
    platforms = spark.createDataFrame([("ds", platform)], "dataset_id string, platform string")
    table = process_study(Phases(spark, str(tmp_path / "p")), frame.withColumn("mate", F.lit(None).cast("int")), platforms)["table"]
    assert table.agg(F.sum("count")).first()[0] == 600
    assert {r.seq for r in table.select("seq").distinct().collect()} == set(true)
    refs = spark.createDataFrame([(s, f"d__B;g__{i}") for i, s in enumerate(true)], "seq string, taxon string")
    out = combine(Phases(spark, str(tmp_path / "c")), table, refs, tips=table.limit(1))
    assert {r.taxon for r in out["taxonomy"].collect()} == {f"d__B;g__{i}" for i in range(5)}
    assert out["placed"].count() + out["unplaced"].count() == out["table"].count()


def test_progress_and_outcomes(spark):
    assert milestones(30, 20, 100) == [25] and milestones(100, 0, 100) == [25, 50, 75, 100] and milestones(0, 0, 0) == []
    log = spark.createDataFrame([("a", "success"), ("b", "skipped"), ("c", "success")], "dataset_id string, status string")
    assert tuple(outcome_counts(log).first()) == (2, 0, 1, 0)


def test_route_filters(spark):
    reads = spark.createDataFrame([("g", i, "A" * 20 + "N" * (i % 3), "I" * (20 + i % 3)) for i in range(30)], "g string, read_idx int, seq string, qual string")
    assert {r: R.filtered_for(reads, r, ["g"]).count() for r in ("ls454", "ion_torrent", "illumina_degraded")} == {"ls454": 30, "ion_torrent": 10, "illumina_degraded": 20}


def test_command_line_checks():
    with pytest.raises(SystemExit):
        cli.parser().parse_args(["process", "--reads", "r", "--out", "o"])
    with pytest.raises(SystemExit):
        cli.parser().parse_args(["combine", "--tables", "t", "--references", "r", "--out", "o", "--confidence", "1.5"])


def test_process_command(spark, tmp_path, reads):
    from tarnflow.sources import sinks

    _, frame = reads
    frame.where("sample_id = 'S1'").select(F.concat_ws("\n", "header", "seq", F.lit("+"), "qual").alias("value")).coalesce(1).write.option("compression", "gzip").text(str(tmp_path / "raw"))
    (tmp_path / "in").mkdir()
    next((tmp_path / "raw").glob("*.gz")).rename(tmp_path / "in" / "S1.fastq.gz")
    (tmp_path / "runs.csv").write_text("dataset_id,sample_id,platform\nds,S1,454\n")
    cli.main(["process", "--reads", str(tmp_path / "in"), "--runs", str(tmp_path / "runs.csv"), "--out", str(tmp_path / "out")])
    assert spark.read.parquet(str(tmp_path / "out" / "tables")).agg(F.sum("count")).first()[0] == 200
    assert spark.read.csv(str(tmp_path / "out" / "outcomes"), sep="\t", header=True).first()["status"] == "success"
    assert sinks.StateTable(spark, str(tmp_path / "none")).read().count() == 0


def test_streaming_takes_each_file_once(spark, tmp_path, reads):
    _, frame = reads
    frame.coalesce(2).write.parquet(str(tmp_path / "in"))
    stream = lambda: ingest.arriving(spark, str(tmp_path / "in"), frame.schema)
    for _ in range(2):
        ingest.append_gated(stream(), str(tmp_path / "c"), str(tmp_path / "out")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 600
    seen = []
    ingest.each_batch(stream(), str(tmp_path / "c2"), lambda df, n: seen.append(df.count())).awaitTermination()
    assert sum(seen) == 600


def test_consistency_errors(spark):
    a, b = spark.createDataFrame([("x",), ("y",)], "id string"), spark.createDataFrame([("x",)], "id string")
    with pytest.raises(M.InconsistentIds):
        M.require_same_ids(a, b, "id")
    M.require_same_ids(b, a, "id", subset=True)


def test_rows_without_keys_are_dealt_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(M, "PAIRS_A_TASK", 100)
    left = spark.range(40).selectExpr("cast(null as string) as k", "id as a").unionAll(spark.createDataFrame([("x", 100)], "k string, a long"))
    right = spark.range(30).selectExpr("cast(null as string) as k", "id as b")
    joined = M.full_join(left, right, "k")
    assert sorted(joined.collect(), key=str) == sorted([(None, a, b) for a in range(40) for b in range(30)] + [("x", 100, None)], key=str)
    assert joined.where("k is null").groupBy(F.spark_partition_id()).count().count() > 4
    assert sorted(M.full_join(left, right.limit(0), "k").collect(), key=str) == sorted([(None, a, None) for a in range(40)] + [("x", 100, None)], key=str)


def test_null_keys_match_in_full_join(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    right = spark.createDataFrame([(None, 3), ("b", 4)], "k string, v int")
    assert sorted(M.full_join(left, right, "k").collect(), key=str) == sorted([(None, 1, 3), ("a", 2, None), ("b", None, 4)], key=str)


def test_empty_metadata(spark):
    empty = spark.createDataFrame([], "ord long, Run string, BioProject string")
    assert M.dataset_list(empty, "BioProject").count() == 0
    assert M.standardized(empty).columns == []
    assert M.zipped(empty, empty.select(F.col("ord").alias("o2"), F.lit(1).alias("w")), "ord", "o2").count() == 0
