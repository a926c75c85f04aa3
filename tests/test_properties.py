"""Properties over the derived reads and over drawn values."""

import pyarrow as pa
from conftest import DATA
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tarnflow.functions import text as X
from tarnflow.operators import features as T, metadata as M, pairs as Q, reads as R
from tarnflow.plans.derived import FEATURES, READS, frame
from tarnflow.schema import COMPLEMENT
from tarnflow.sources.formats import fasta_records, fastq_records

DNA = st.text("ACGT", min_size=30, max_size=120)


def flipped(seq):
    return seq.translate(str.maketrans(*COMPLEMENT))[::-1]


@given(st.text("ACGTRYSWKMBDHVNacgtn", max_size=60))
def test_complement_is_an_involution(seq):
    assert flipped(flipped(seq)) == seq


@settings(max_examples=60, deadline=None)
@given(DNA, st.integers(20, 60))
def test_insert_length_of_exact_mates(whole, n):
    size = min(n, len(whole))
    first, second = whole[:size].encode(), flipped(whole)[:size].encode()
    found = Q._insert_lengths(pa.array([first.decode()]), pa.array([second.decode()]))[0].as_py()
    if 2 * size - len(whole) >= Q.LEAST_OVERLAP:
        assert found > 0
        a, b = whole[:size], whole[len(whole) - size :]
        assert found == len(whole) or a[max(0, found - size) :][: 2 * size - found] == b[: 2 * size - found][: len(a[max(0, found - size) :])]


@given(st.lists(st.tuples(st.text("abc1", min_size=1, max_size=5), st.text("ACGTN", max_size=20)), max_size=8))
def test_sequence_records_round_trip(rows):
    lines = [x for name, seq in rows for x in (f"@{name}", seq, "+", "I" * len(seq))]
    assert list(fastq_records(lines, "f")) == [(f"@{n}", s, "I" * len(s)) for n, s in rows]
    assert list(fasta_records(x for n, s in rows for x in (f">{n}", s[:7], s[7:]))) == rows


@given(st.text("ab_- C", max_size=20))
def test_camel_is_stable(name):
    once = X.camel(name)
    assert X.camel(once) == once or " " in once or "_" in once or "-" in once


def test_sizes_add_up_to_reads(spark):
    reads = frame(spark, DATA, READS)
    assert R.dereplicate(reads, ["project"]).agg(F.sum("size")).first()[0] == reads.count()
    table = frame(spark, DATA, FEATURES).withColumnRenamed("n", "count").drop("project")
    assert T.merge_tables([table, table]).agg(F.sum("count")).first()[0] == 2 * reads.count()


def test_semi_and_anti_partition_the_table(spark):
    table = frame(spark, DATA, FEATURES)
    kept, removed = M.split_by_ids(table, table.where("n > 2"), "feature_id")
    assert kept.count() + removed.count() == table.count()
    assert kept.join(removed, "feature_id", "left_semi").count() == 0


def test_row_numbers_are_gapless(spark):
    rows = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("k")).repartition(9)
    got = M.numbered(rows, "k").orderBy("k").collect()
    assert [r.pos for r in got] == list(range(1, 1001))
