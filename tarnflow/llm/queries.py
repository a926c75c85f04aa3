"""The queries of this subpackage over the corpus tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tarnflow.llm import byte_bpe, exact_dedup, packing, quality_gam, secret_scan, simhash, substring_dedup, tiff, token_counts, warc
from tarnflow.session import read_table

#: Documents with more tokens than this are over the limit in op1.
TOKEN_LIMIT = 512


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), ["doc_id"])
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeats(read_table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decisions(read_table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read_table(spark, sf_dir, "pages"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op6_tiff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiff.text_media(read_table(spark, sf_dir, "documents"), ["doc_id"])


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), ["doc_id"])


def op8_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = quality_gam.train(docs, read_table(spark, sf_dir, "labels"))
    return quality_gam.score(docs, model, ["doc_id"]).select("doc_id", quality_gam.held_out().alias("held_out"), "score", "predicted")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(read_table(spark, sf_dir, "documents"), ["doc_id"])
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans", "n_entropy")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_counts,
        op2_substring_dedup,
        op3_exact_dedup,
        op4_warc,
        op5_simhash,
        op6_tiff,
        op7_byte_bpe,
        op8_quality_gam,
        op9_packing,
        op10_secret_scan,
    )
}


def _matches(pattern: str, group: int, least: int) -> str:
    """Spans of a pattern's matches by the texts between them: a list of start, end and matched text."""
    p = "'" + pattern.replace("'", "''") + "'"
    return f"""(
        select doc_id, list_filter(list_transform(range(1, len(m) + 1), lambda i: {{
                   's': cast(list_sum(list_transform(b[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) as bigint), 'm': m[i], 'g': g[i]}}),
                 lambda x: length(x.g) >= {least}) as found
        from (select doc_id, regexp_extract_all(text, {p}) as m, regexp_extract_all(text, {p}, {group}) as g, string_split_regex(text, {p}) as b from docs))"""


def _secret_sql() -> str:
    kinds = {"assign": (secret_scan.ASSIGN, 2, secret_scan.ASSIGN_LEAST), "access": (secret_scan.ACCESS, 0, 0), "hex": (secret_scan.HEX, 0, 0)}
    base = " union all ".join(f"select doc_id, {k} as rank, '{n}' as kind, unnest(found) as x from {_matches(*v)}" for k, (n, v) in enumerate(kinds.items()))
    hexes, mixed = secret_scan.CLASSES["hex"], secret_scan.CLASSES["mixed"]
    allowed = secret_scan.ALLOWED.replace(r"|^(.)\1+$", "").replace("'", "''")  # one letter alone has no digit beside it
    counts = "list_transform(list_distinct(w), lambda c: len(list_filter(w, lambda y: y = c)))"
    entropy = f"list_sum(list_transform({counts}, lambda n: -(n / cast(width as double)) * log2(n / cast(width as double))))"
    return f"""
        with docs as (select doc_id, coalesce(text, '') as text from documents),
        base as (select doc_id, rank, kind, x.s as s, x.s + length(x.m) as e from ({base})),
        strings as (
          select doc_id, x.s as s, x.m as m, regexp_matches(x.m, '{hexes[0]}') as hex from (select doc_id, unnest(found) as x from {_matches(secret_scan.CANDIDATE, 0, 0)})
          where regexp_matches(x.m, '[A-Za-z]') and regexp_matches(x.m, '[0-9]') and not regexp_matches(x.m, '{allowed}')),
        free as (select *, case when hex then {hexes[1]} else {mixed[1]} end as width, case when hex then {hexes[2]} else {mixed[2]} end as bits from strings c
          where not exists (select 1 from base b where b.doc_id = c.doc_id and b.s < c.s + length(c.m) and c.s < b.e)),
        windows as (select doc_id, s, width, bits, i, string_split(substr(m, cast(i + 1 as int), width), '') as w from (select *, unnest(range(0, length(m) - width + 1)) as i from free)),
        added as (select doc_id, 3 as rank, 'entropy' as kind, s + min(i) as s, s + max(i) + any_value(width) as e from windows where {entropy} >= bits - 1e-9 group by doc_id, s),
        spans as (select * from base union all select * from added),
        joined as (select doc_id, string_agg(kind || ':' || s || ':' || e, ',' order by s, rank) filter (where rank < 3) as base, string_agg(kind || ':' || s || ':' || e, ',' order by s, rank) as spans,
                          {", ".join(f"count(*) filter (where kind = '{k}') as n_{k}" for k in (*kinds, "entropy"))} from spans group by doc_id)
        select d.doc_id, {", ".join(f"coalesce(n_{k}, 0) as n_{k}" for k in (*kinds, "entropy"))}, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
        from docs d left join joined j on j.doc_id = d.doc_id"""


ORACLE_SQL: dict[str, str] = {
    "op10_secret_scan": _secret_sql(),
    "op3_exact_dedup": """
        with t as (
            select doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) as text_sha256
            from documents
        )
        select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
               row_number() over (partition by text_sha256 order by doc_id desc nulls last) = 1 as kept, text_sha256
        from t window w as (partition by text_sha256)
    """,
    "op4_warc": """
        with p as (
            select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha1(coalesce(html, '')) as payload_digest from pages
        ),
        w as (select *, case when payload_bytes >= 1000 then max(page_id) over (partition by payload_digest) else page_id end as stored from p)
        select page_id, cast(payload_bytes as bigint) as payload_bytes, payload_digest,
               case when stored = page_id then 'response' else 'revisit' end as record_type,
               case when stored <> page_id then stored end as refers_to
        from w
    """,
}
