"""The registered queries: names, columns and types, SQL, and the pipeline against its parts."""

import hashlib
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from conftest import DATA
from oracle import connection, same

import corpus_pipeline
from tarnflow.llm import packing, queries, quality_gam, secret_scan
from tarnflow.llm.exact_dedup import exact_dedup
from tarnflow.session import read_table

COLUMNS = {
    "op1_token_counts": {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"},
    "op3_exact_dedup": {"doc_id": "bigint", "keep_id": "bigint", "group_size": "bigint", "kept": "boolean", "text_sha256": "string"},
    "op4_warc": {"page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string", "record_type": "string", "refers_to": "bigint"},
    "op5_simhash": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op6_tiff": {"doc_id": "bigint", "n_bytes": "bigint", "payload_bytes": "bigint", "payload_sha256": "string", "tail_crc32": "bigint", "media_bytes": "bigint", "media_sha256": "string", "feature": "string"},
    "op7_byte_bpe": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op8_quality_gam": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op9_packing": {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint"},
    "op10_secret_scan": {"doc_id": "bigint", "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "base_sha256": "string", "spans": "string"},
    "op2_substring_dedup": {"doc_id": "bigint", "kind": "string", "from_word": "int", "to_word": "int", "class_id": "bigint", "kept": "boolean"},
}


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_columns(spark, name):
    frame = queries.QUERIES[name](spark, DATA)
    assert COLUMNS[name].items() <= dict(frame.dtypes).items()
    if name != "op2_substring_dedup":
        assert frame.count() >= read_table(spark, DATA, "pages" if name == "op4_warc" else "documents").count()


@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_sql(spark, name):
    same(queries.QUERIES[name](spark, DATA), connection(DATA), queries.ORACLE_SQL[name])


def test_native_queries_run_no_python(spark):
    for name in ("op3_exact_dedup", "op10_secret_scan"):
        plan = queries.QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_pipeline_follows_its_stages(spark):
    """Each stage on what the one before kept, by plain Python where that is short."""
    docs = read_table(spark, DATA, "documents")
    model = quality_gam.train(docs, read_table(spark, DATA, "labels"))
    rows = {r.doc_id: r.text or "" for r in docs.collect()}
    good = {r.doc_id for r in quality_gam.score(docs, model, ["doc_id"]).collect() if r.predicted}
    best = {}
    for i in sorted(good):
        best[hashlib.sha256(rows[i].translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).encode()).digest()] = i
    unique = set(best.values())
    first = corpus_pipeline.STAGES[0][1](spark, docs, DATA)
    assert first.columns == docs.columns and {r.doc_id for r in first.collect()} == good
    assert {r.doc_id for r in exact_dedup(first).collect()} == unique
    near = corpus_pipeline.STAGES[2][1](spark, docs.where(docs.doc_id.isin(*unique)), DATA)
    survivors = {r.doc_id for r in near.collect()}
    final = corpus_pipeline.run(spark, DATA)
    assert {r.doc_id for r in final.collect()} == survivors
    clean = corpus_pipeline.STAGES[3][1](spark, near, DATA)
    assert clean.columns == docs.columns
    assert secret_scan.scan(clean, ["doc_id"]).where("n_assign + n_access + n_hex > 0").count() == 0
    lengths = sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in final.collect())
    assert lengths == sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in packing.pack(clean, queries.public_tokenizers.path("word_bpe_49k.json")).collect())


def test_entry_has_all(spark):
    import __spark_entry__ as entry

    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(queries.ORACLE_SQL) <= set(entry.oracle_sql())


def test_secret_sql_on_a_fixture(spark, tmp_path):
    """The SQL recounts each window; the operator moves counts along."""
    import random

    import pandas as pd
    from test_corpus_ops import SECRETS, odd_texts

    draw = random.Random(4)
    many = [*SECRETS, None, "", " ".join(SECRETS), *[" ".join(draw.sample(SECRETS, 4)) for _ in range(60)], *odd_texts(60)]
    pd.DataFrame({"doc_id": range(len(many)), "text": many}).to_parquet(tmp_path / "documents.parquet")
    same(queries.QUERIES["op10_secret_scan"](spark, str(tmp_path)), connection(str(tmp_path)), queries.ORACLE_SQL["op10_secret_scan"])
