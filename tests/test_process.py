"""The process driver: every route with reads whose true sequences are known."""

import random

import pytest
from pyspark.sql import functions as F

from tarnflow.pipeline.process import process_study
from tarnflow.pipeline.runner import Phases
from tarnflow.schema import COMPLEMENT

FORWARD, REVERSE = "CCAGCAGCCGCGGTAA", "GGACTACCAGGGTATCTAAT"
FULL = ("AGAGTTTGATCATGGCTCAG", "GGTTACCTTGTTACGACTT")
REGION = ("CCTACGGGAGGCAGCAG", "GACTACCAGGGTATCTAATCC")


def flipped(seq):
    return seq.translate(str.maketrans(*COMPLEMENT))[::-1]


@pytest.fixture(scope="module")
def study(spark, tmp_path_factory):
    draw = random.Random(8)
    dna = lambda n: "".join(draw.choice("ACGT") for _ in range(n))
    good = lambda n: "".join(draw.choice("FGHI") for _ in range(n))
    rows, true = [], {}

    def add(ds, i, mate, seq, qual):
        rows.append((ds, f"S{i % 2}", f"{ds}_S{i % 2}_R{mate or 1}.fastq", mate, i, f"@{ds}.{i}", seq, qual))

    for ds, mixed in (("ill_pe", False), ("ill_mixed", True), ("ill_far", False), ("degraded", False)):
        true[ds] = [dna(120) for _ in range(3)]
        for i in range(150):
            body = true[ds][i % 3]
            fragment = FORWARD + body + flipped(REVERSE)
            first, second = fragment[:95], flipped(fragment)[:95]
            if ds == "ill_far":
                second = REVERSE + dna(75)
            if mixed and i % 5 < 2:
                first, second = second, first
            for mate, seq in ((1, first), (2, second)):
                add(ds, i, mate, seq, "I" * 95 if ds == "degraded" else good(95))
    for ds, n in (("ill_se", 120), ("roche", 200), ("ion", 150)):
        true[ds] = [dna(n) for _ in range(3)]
        for i in range(150):
            seq = FORWARD + true[ds][i % 3]
            add(ds, i, None, seq, good(len(seq)))
    true["pacbio"] = [dna(400) for _ in range(2)]
    long = [FULL[0] + dna(300) + REGION[0] + x + flipped(REGION[1]) + dna(720) + flipped(FULL[1]) for x in true["pacbio"]]
    for i in range(60):
        seq = long[i % 2] if i % 3 else flipped(long[i % 2])
        add("pacbio", i, None, seq, good(len(seq)))
    for ds in ("pacbio_short", "nanopore", "unknown"):
        for i in range(20):
            add(ds, i, None, dna(300), good(300))
    names = {"degraded": "HiSeq", "roche": "454 GS", "ion": "Ion Torrent PGM", "pacbio": "PacBio Sequel", "pacbio_short": "PacBio RS", "nanopore": "MinION", "unknown": "BGISEQ"}
    reads = spark.createDataFrame(rows, "dataset_id string, sample_id string, file string, mate int, read_idx long, header string, seq string, qual string")
    platforms = spark.createDataFrame([(d, names.get(d, "Illumina MiSeq")) for d in {r[0] for r in rows}], "dataset_id string, platform string")
    folder = str(tmp_path_factory.mktemp("study"))
    phases = Phases(spark, folder)
    out = process_study(phases, reads, platforms)
    table = {}
    for r in out["table"].collect():
        table.setdefault(r.dataset_id, {}).setdefault(r.seq, 0)
        table[r.dataset_id][r.seq] += r["count"]
    return true, out, table, (folder, reads, platforms, phases)


def test_outcomes(study):
    _, out, _, _ = study
    got = {r.dataset_id: (r.route, r.status) for r in out["outcomes"].collect()}
    assert got == {
        "ill_pe": ("illumina", "success"), "ill_mixed": ("illumina", "success"), "ill_far": ("illumina", "success"), "ill_se": ("illumina", "success"),
        "degraded": ("illumina_degraded", "success"), "roche": ("ls454", "success"), "ion": ("ion_torrent", "success"), "pacbio": ("pacbio", "success"),
        "pacbio_short": ("pacbio", "skipped"), "nanopore": ("unsupported", "skipped"), "unknown": ("failed", "failed"),
    }
    assert tuple(out["counts"].first()) == (8, 1, 2, 0)


def test_primers_and_modes(study):
    _, out, _, _ = study
    info = {r.dataset_id: (r.mode, r.forward_trim, r.reverse_trim) for r in out["primers"].collect()}
    assert info["ill_pe"] == ("PE", 16, 20) and info["ill_mixed"] == ("PE_mixed", 16, 20) and info["ill_se"] == ("SE", 16, None)


def test_paired_routes(study):
    true, _, table, _ = study
    for ds in ("ill_pe", "ill_mixed"):
        assert table[ds] == {s: 50 for s in true[ds]}
    assert table["ill_far"] == {s[:79]: 50 for s in true["ill_far"]}  # first mates alone


def test_single_routes(study):
    true, _, table, _ = study
    assert table["ill_se"] == {s: 50 for s in true["ill_se"]}
    assert table["degraded"] == {s[15:79]: 50 for s in true["degraded"]}
    assert table["roche"] == {s: 50 for s in true["roche"]}
    assert table["ion"] == {s[10:]: 50 for s in true["ion"]}
    assert table["pacbio"] == {s: 30 for s in true["pacbio"]}


def test_summary_and_resuming(study, spark):
    _, out, _, (folder, reads, platforms, phases) = study
    sums = {r[0]: (r[1], r[2]) for r in out["summary"].groupBy("dataset_id").agg(F.sum("raw_reads"), F.sum("final_reads")).collect()}
    assert sums["ill_pe"] == (150, 150) and sums["nanopore"] == (20, 0)
    again = Phases(spark, folder)
    process_study(again, reads, platforms)
    assert phases.ran and again.ran == []
