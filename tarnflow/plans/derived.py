"""Domain relations derived from the driver's tables, in SQL that Spark and DuckDB both read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tarnflow.session import read_table, stage

HEX = "0123456789abcdef"
_DNA = "ACGTACGTACGTACGT"
_PHRED = "!$,5:;<=?@ABCDEF"


def _hash(key: str, tag: str, to: str) -> str:
    return f"translate(md5(cast({key} as string) || '{tag}'), '{HEX}', '{to}')"


#: Reads: a shared primer, a body that few or single reads have, N at some tails, and a quality string as long.
READS = f"""
select project, sample_id, file, read_idx, '@' || sample_id || '.' || cast(read_idx as string) as header, seq, substr(phred, 1, cast(length(seq) as int)) as qual
from (
  select *, case when read_idx % 7 = 0 then substr(plain, 1, cast(length(plain) - 3 as int)) || 'NNN'
                 when read_idx % 41 = 0 then lower(plain) else plain end as seq
  from (
    select 'PRJNA' || cast(l_suppkey % 10 as string) as project, 'S' || cast(l_suppkey as string) as sample_id,
           'S' || cast(l_suppkey as string) || '_R' || cast(1 + l_orderkey % 2 as string) || '.fastq.gz' as file,
           l_orderkey * 8 + l_linenumber as read_idx,
           'CCAGCAGCCGCGGTAA' || substr({_hash("k", "a", _DNA)} || {_hash("k", "b", _DNA)} || {_hash("k", "c", _DNA)}, 1, cast(24 + k % 73 as int)) as plain,
           {_hash("r", "q", _PHRED)} || {_hash("r", "s", _PHRED)} || {_hash("r", "t", _PHRED)} || {_hash("r", "u", _PHRED)} as phred
    from (
      select *, case when l_orderkey % 20 = 0 then 1000000 + l_orderkey * 8 + l_linenumber else l_partkey % 500 end as k,
             l_orderkey * 8 + l_linenumber as r
      from {{lineitem}}
    )
  )
)
"""

#: Two mates by order: the first mate is a read, the second its reverse complement's front; every third pair is swapped.
MATES = """
select project, read_idx, case when read_idx % 3 = 0 then b else a end as seq1, case when read_idx % 3 = 0 then a else b end as seq2
from (
  select project, read_idx, upper(seq) as a, 'GGACTACGCGGGTATCTAAT' || reverse(translate(upper(seq), 'ACGTN', 'TGCAN')) as b from {reads}
)
"""

#: Long reads: a front, the amplified region between two primers' sites, and a back; every third is turned round.
LONG = f"""
select project, sample_id, sample_id || '.fastq.gz' as file, read_idx, '@' || sample_id || '.' || cast(read_idx as string) as header,
       case when read_idx % 3 = 0 then reverse(translate(plain, 'ACGT', 'TGCA')) else plain end as seq, substr(repeat('I', 2100), 1, cast(length(plain) as int)) as qual
from (
  select 'PRJNA' || cast(o_custkey % 10 as string) as project, 'L' || cast(o_custkey % 50 as string) as sample_id, o_orderkey as read_idx,
         substr({_hash("o_custkey", "f", _DNA)} || {_hash("o_custkey", "g", _DNA)}, 1, cast(20 + o_orderkey % 40 as int))
         || case when o_orderkey % 7 = 0 then 'CCTACGGGNGGCTGCAG' when o_orderkey % 2 = 0 then 'CCTACGGGAGGCAGCAG' else 'CCTACGGGTGGCTGCAG' end
         || substr(repeat({_hash("o_custkey", "m", _DNA)} || {_hash("o_orderkey", "n", _DNA)} || {_hash("o_custkey", "o", _DNA)}, 6), 1, cast(280 + o_custkey % 260 as int))
         || 'GGATTAGATACCCTGGTAGTC' || substr(repeat({_hash("o_orderkey", "t", _DNA)}, 50), 1, cast(o_orderkey % 1600 as int)) as plain
  from {{orders}}
)
"""

#: Feature table: dereplicated sequences of samples, long form.
FEATURES = """
select project, md5(upper(seq)) as feature_id, sample_id, count(*) as n from {reads} group by project, md5(upper(seq)), sample_id
"""

META = """
select o_orderkey as ord, case when o_orderkey % 11 = 0 then 'CRR' else 'SRR' end || cast(o_orderkey as string) as run,
       case when o_custkey % 97 = 0 then null else 'PRJNA' || cast(o_custkey % 50 as string) end as bioproject,
       case when o_custkey % 89 = 0 then null else 'SAMN' || cast(o_custkey as string) end as biosample,
       o_orderstatus as status, o_orderpriority as priority, o_totalprice as price
from {orders}
"""

BIOSAMPLE = """
select case when c_custkey % 83 = 0 then null else 'SAMN' || cast(c_custkey + 20 as string) end as biosample, 'PRJNA' || cast(c_custkey % 50 as string) as bioproject, c_name as title, c_mktsegment as host, c_custkey as ord
from {customer}
"""


def sql(template: str) -> str:
    """DuckDB's form of a relation: tables are views, derived ones are nested in."""
    named = {t: t for t in ("lineitem", "orders", "customer")}
    if "{reads}" in template:
        named["reads"] = f"({READS.format(**named)})"
    return f"({template.format(**named)})"


def unstaged_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spark's form of ``READS``, made as they are read: for a query that needs few of their columns, and those once."""
    return spark.sql(READS, lineitem=read_table(spark, sf_dir, "lineitem"))


_STAGED: dict[tuple, DataFrame] = {}


def frame(spark: SparkSession, sf_dir: str, template: str) -> DataFrame:
    """Spark's form of a relation. Reads are written to Parquet once a session and folder, as reads come from files
    in real use; otherwise the optimizer would push operators into the long expressions that make them up."""
    key = (spark.sparkContext.applicationId, sf_dir, template)
    if key in _STAGED:
        return _STAGED[key]
    named = {t: read_table(spark, sf_dir, t) for t in ("lineitem", "orders", "customer") if f"{{{t}}}" in template}
    if "{reads}" in template:
        named["reads"] = frame(spark, sf_dir, READS)
    made = spark.sql(template, **named)
    if template in (READS, MATES, LONG):
        made = _STAGED[key] = stage(made, "derived-reads")
    return made
