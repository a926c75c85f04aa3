"""Goldens by hand for the scalar functions and the domain rules."""

import math

import pytest
from pyspark.sql import functions as F

from tarnflow.functions import sequence as S, text as X
from tarnflow.operators import primers as P, reads as R, trimming as T


def value(spark, column, **data):
    row = spark.createDataFrame([tuple(data.values())], ", ".join(f"{k} string" for k in data))
    return row.select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(("seq", "want"), [("", 0.0), ("A", 0.0), ("AA", 1 / 16), ("ACGT", 3 / 16), ("acgtACGT", 4 / 16), ("ANNA", 3 / 16)])
def test_complexity(spark, seq, want):
    assert value(spark, S.complexity(F.col("s")), s=seq) == pytest.approx(want)


@pytest.mark.parametrize(("seq", "want"), [("", 0.0), ("NNN", 0.0), ("AAAA", 0.0), ("AACC", 1.0), ("ACGTN", 2.0), ("aacg", 1.5)])
def test_entropy(spark, seq, want):
    assert value(spark, S.entropy(F.col("s")), s=seq) == pytest.approx(want)


@pytest.mark.parametrize(("qual", "want"), [("", 0.0), ("I", 40.0), ("!I", 20.0)])
def test_mean_quality(spark, qual, want):
    assert value(spark, S.mean_quality(F.col("q")), q=qual) == pytest.approx(want)


def test_reverse_complement_is_its_own_inverse(spark):
    seq = "ACGTRYSWKMBDHVNacgt"
    assert value(spark, S.reverse_complement(F.col("s")), s="AACGTN") == "NACGTT"
    assert value(spark, S.reverse_complement(S.reverse_complement(F.col("s"))), s=seq) == seq


def test_iupac(spark):
    assert value(spark, S.iupac_mask(F.col("s")), s="r") == 5
    assert value(spark, S.iupac_mask(F.col("s")), s="-") == 0
    assert S.iupac_regex("ACRN") == "AC[AG][ACGT]"
    assert S.matches_primer("YCAGCMGCCGCGGTAA", "CCAGCAGCCGCGGTAA")


@pytest.mark.parametrize(
    ("shares", "want"), [((0.8, 0.1, 0.1, 0.0), "C"), ((0.6, 0.3, 0.1, 0.0), "D"), ((0.75, 0.06, 0.1, 0.09), "D"), ((0.4, 0.3, 0.2, 0.1), "V"), ((0.78, 0.05, 0.05, 0.12), "D"), ((0.25,) * 4, "V")]
)
def test_position_class(spark, shares, want):
    assert spark.range(1).select(S.position_class(F.array(*map(F.lit, shares)))).first()[0] == want


@pytest.mark.parametrize(
    ("states", "want"),
    [
        ("C" * 9 + "V" * 51, 0), ("C" * 10 + "V" * 50, 10), ("CCCVCCC" + "C" * 8 + "V" * 45, 15), ("CCCVVCCC" + "DDD" + "V" * 49, 11), ("CCCVVVCCCCCCC" + "V" * 47, 0),
        ("CCVCCCCCCCCCC" + "V" * 47, 0), ("C" * 60, 30), ("C" * 29 + "VV" + "C" * 29, 31), ("C" * 28 + "VV" + "C" * 30, 30), ("C" * 29 + "V" + "C" * 30, 30),
    ],
)
def test_boundary(spark, states, want):
    assert value(spark, P.boundary(F.col("s")), s=states) == want


def matrix(spark, letters, dominant=1.0):
    rest = (1 - dominant) / 3
    rows = [("d", i, *[dominant if b == c else rest for b in "ACGT"]) if c in "ACGT" else ("d", i, 0.25, 0.25, 0.25, 0.25) for i, c in enumerate(letters)]
    return spark.createDataFrame(rows, "g string, pos long, f_A double, f_C double, f_G double, f_T double")


def test_detection_ladder(spark):
    from tarnflow.schema import FORWARD_PRIMERS

    table = P.primer_table(spark, FORWARD_PRIMERS)
    run = lambda letters: P.detect(matrix(spark, letters), ["g"], table).first()
    known = run("CCAGCAGCCGCGGTAA" + "N" * 44)
    assert (known["reason"], known["primer"], known["trim"]) == ("known", "515F518F", 16)
    assert run("TTTTTTTTTTTT" + "N" * 48)["reason"] == "unknown"
    assert run("TTTTTTTTTTTT" + "N" * 48)["trim"] == 12
    assert run("T" * 60)["reason"] == "ceiling"
    assert run("N" * 60)["reason"] == "none"


def test_frequencies_sum_to_one(spark):
    reads = spark.createDataFrame([("g", "ACGTN"), ("g", "acc"), ("g", "")], "g string, seq string")
    rows = R.base_frequencies(reads, ["g"]).collect()
    assert len(rows) == 60
    assert all(math.isclose(r.f_A + r.f_C + r.f_G + r.f_T, 1) for r in rows)
    assert {r.pos: r.f_A for r in rows}[4] == 0.25


def test_trim_positions(spark):
    good = [("g", p, 10000, 30.0) for p in range(100)]
    bad = [("g", p, 10000, 10.0) for p in range(100, 120)]
    rows = spark.createDataFrame(good + bad, "g string, pos long, reads long, q25 double")
    found = T.trim_positions(rows, ["g"]).first()
    assert (found["start"], found["end"]) == (0, 96)  # the mean of positions 96 to 100 is 26, of 97 to 101 it is 22
    low = spark.createDataFrame([("g", p, 10000, 20.0) for p in range(120)], "g string, pos long, reads long, q25 double")
    assert T.trim_positions(low, ["g"]).first()["start"] is None


def test_tail_trim(spark):
    rows = [("g", p, 100, 0.5 if p < 4 else 0.0) for p in range(50)]
    assert T.tail_trim(spark.createDataFrame(rows, "g string, pos long, coverage long, n_freq double"), ["g"]).first()["trim"] == 4
    full = [("g", p, 100, 0.5 if p < 31 else 0.0) for p in range(50)]  # background 0.15
    assert T.tail_trim(spark.createDataFrame(full, "g string, pos long, coverage long, n_freq double"), ["g"]).first()["trim"] == 30


def test_text_helpers(spark):
    assert X.camel("BioSample_ID") == "BiosampleId"
    assert X.camel("geo-loc name") == "GeoLocName"
    assert X.camel("Title") == "Title"
    assert value(spark, X.url_quoted(F.col("s")), s="a b/c") == "a%20b%2Fc"
    assert value(spark, X.norm_null(F.col("s")), s=" NaN ") is None


def test_retries_grow():
    waits, calls = [], []

    def call():
        calls.append(1)
        if len(calls) < 4:
            raise ConnectionError
        return "done"

    assert X.with_retries(call, sleep=waits.append) == "done"
    assert waits == [1.5, 3.0, 6.0]


def test_empty_tables(spark):
    reads = spark.createDataFrame([], "g string, read_idx long, header string, seq string, qual string, file string")
    assert R.dereplicate(reads, ["g"]).count() == R.quality_gate(reads).count() == R.base_frequencies(reads, ["g"]).count() == R.quality_quantiles(reads, ["g"]).count() == 0
