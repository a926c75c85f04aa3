"""Queries of the read operators, with their SQL."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession, functions as F

from tarnflow.functions import sequence as S
from tarnflow.operators import primers as P, reads as R, trimming as T
from tarnflow.plans.derived import LONG, MATES, READS, frame, sql
from tarnflow.schema import FORWARD_PRIMERS, REGION_LENGTHS, REGION_PRIMERS

BY = ["project"]


def _reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame(spark, sf_dir, READS)


def _mates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame(spark, sf_dir, MATES).withColumns({"qual1": F.col("seq1"), "qual2": F.col("seq2")})


def dereplicate(spark, sf_dir):
    return R.dereplicate(_reads(spark, sf_dir), BY)


def singleton_filter(spark, sf_dir):
    return R.dereplicate(_reads(spark, sf_dir), BY, least=2).select("project", "seq", "size")


def read_scores(spark, sf_dir):
    rows = R.scored(_reads(spark, sf_dir))
    rounded = {c: F.round(c, 6) for c in ("avg_q", "complexity", "entropy")}
    return rows.withColumns(rounded).select("read_idx", "seq_len", *rounded, "n_count")


def read_quality_gate(spark, sf_dir):
    return R.quality_gate(_reads(spark, sf_dir)).select("read_idx", "sample_id")


def reject_histogram(spark, sf_dir):
    return R.reject_histogram(_reads(spark, sf_dir), BY)


def reverse_complement(spark, sf_dir):
    return _reads(spark, sf_dir).select("read_idx", S.reverse_complement(F.col("seq")).alias("rc"))


def position_base_freq(spark, sf_dir):
    rows = R.base_frequencies(_reads(spark, sf_dir), BY)
    return rows.select("project", "pos", *[F.round(f"f_{b}", 6).alias(f"f_{b.lower()}") for b in "ACGT"])


def cdv_states(spark, sf_dir):
    return P.position_states(R.base_frequencies(_reads(spark, sf_dir), BY), BY).select("project", "pos", "state", "top")


def primer_boundary(spark, sf_dir):
    rows = P.profiles(R.base_frequencies(_reads(spark, sf_dir), BY), BY)
    return rows.select("project", "states", "consensus", P.boundary(F.col("states")).cast("long").alias("boundary"))


def primer_db_match(spark, sf_dir):
    rows = P.profiles(R.base_frequencies(_reads(spark, sf_dir), BY), BY)
    found = P.match_primers(rows, BY, P.primer_table(spark, FORWARD_PRIMERS))
    return found.select("project", "name", "offset", F.round("identity", 6).alias("identity"), "trim")


def primer_detection(spark, sf_dir):
    matrix = R.base_frequencies(R.quality_gate(_reads(spark, sf_dir)), BY)
    return P.detect(matrix, BY, P.primer_table(spark, FORWARD_PRIMERS)).select("project", "detected", "primer", "trim", "reason")


def primer_info(spark, sf_dir):
    matrix = R.base_frequencies(R.quality_gate(_reads(spark, sf_dir)), BY)
    return P.primer_info(P.detect(matrix, BY, P.primer_table(spark, FORWARD_PRIMERS)), BY, "SE")


def primer_trimmed(spark, sf_dir):
    reads = _reads(spark, sf_dir)
    matrix = R.base_frequencies(R.quality_gate(reads), BY)
    trims = P.detect(matrix, BY, P.primer_table(spark, FORWARD_PRIMERS)).select("project", "trim")
    return R.cut_front(reads.join(trims, "project"), F.col("trim").cast("int")).select("read_idx", "seq", F.length("qual").cast("long").alias("qual_len"))


def orientation_bimodal(spark, sf_dir):
    pairs = _mates(spark, sf_dir).withColumn("seq", F.col("seq1"))
    return P.mixed_orientation(R.base_frequencies(pairs, BY), BY).withColumn("best_pos", F.col("best_pos").cast("long"))


def orientation_split(spark, sf_dir):
    pairs = _mates(spark, sf_dir).withColumn("seq", F.col("seq1"))
    mixed = P.mixed_orientation(R.base_frequencies(pairs, BY), BY)
    return P.split_orientation(pairs, mixed, BY).groupBy("project").agg(F.count_if("minority").alias("minority"), F.count(F.lit(1)).alias("reads"))


def mixed_pair_trim(spark, sf_dir):
    pairs = _mates(spark, sf_dir)
    mixed = P.mixed_orientation(R.base_frequencies(pairs.withColumn("seq", F.col("seq1")), BY), BY)
    return P.trim_mixed_pairs(pairs, mixed, BY, 16, 20).select("project", "read_idx", "flipped", "seq1", "seq2")


def tail_n_profile(spark, sf_dir):
    return R.tail_profile(_reads(spark, sf_dir), BY).withColumn("n_freq", F.round("n_freq", 6))


def adaptive_trim(spark, sf_dir):
    trimmed, trims = T.adaptive_tail_trim(_reads(spark, sf_dir), BY)
    bases = trimmed.groupBy("project").agg(F.sum(F.length("seq")).alias("bases"))
    return trims.join(bases, "project").select("project", F.round("threshold", 6).alias("threshold"), F.col("trim").cast("long").alias("trim"), "max_ambiguous", "bases")


def quality_quantiles(spark, sf_dir):
    rows = R.quality_quantiles(_reads(spark, sf_dir), BY)
    return rows.select("project", "pos", "reads", *[F.round(c, 4).alias(c) for c in ("q02", "q09", "q25", "q50", "q75", "q91", "q98")])


def trim_positions(spark, sf_dir):
    better = _reads(spark, sf_dir).withColumn("qual", F.translate("qual", "!$,5", "GHIJ"))
    return T.trim_positions(R.quality_quantiles(better, BY), BY)


def quality_diversity(spark, sf_dir):
    return R.distinct_qualities(_reads(spark, sf_dir), BY, "file")


def degraded_preprocess(spark, sf_dir):
    rows = T.degraded_preprocess(_reads(spark, sf_dir), BY, "file")
    return rows.groupBy("project", "trunc", "verdict").agg(F.count(F.lit(1)).alias("reads"), F.coalesce(F.sum(F.length("seq")), F.lit(0)).alias("bases"))


def sanitize_reads(spark, sf_dir):
    return R.sanitized(_reads(spark, sf_dir)).groupBy("sample_id").agg(F.count(F.lit(1)).alias("reads"))


def sanitize_pairs(spark, sf_dir):
    return R.sanitized_pairs(_mates(spark, sf_dir)).groupBy("project").agg(F.count(F.lit(1)).alias("pairs"))


def pair_reads(spark, sf_dir):
    reads = _reads(spark, sf_dir).withColumn("n", F.floor(F.col("read_idx") / 16)).withColumn("mate", F.floor(F.col("read_idx") / 8) % 2)
    keyed = reads.withColumn("k", F.col("read_idx") % 8)
    return R.paired(keyed.where("mate = 0"), keyed.where("mate = 1"), ["n", "k"]).select("n", "k", "seq1", "seq2")


def n_histogram(spark, sf_dir):
    return R.n_histogram(_reads(spark, sf_dir), BY)


def quality_filter(spark, sf_dir):
    kept = R.quality_filtered(_reads(spark, sf_dir), 20, 0.85, 1)
    return kept.select("read_idx", F.length("seq").cast("long").alias("kept_len"))


def raw_read_counts(spark, sf_dir):
    return R.raw_counts(_reads(spark, sf_dir))


def read_numbering(spark, sf_dir):
    return R.numbered(_reads(spark, sf_dir)).select("read_idx", "label")


def first_reads(spark, sf_dir):
    return R.first_reads(_reads(spark, sf_dir), ["file"], 5).select("file", "read_idx")


def long_read_gate(spark, sf_dir):
    rows = R.long_read_share(frame(spark, sf_dir, LONG), BY)
    return rows.withColumn("share", F.round("share", 6))


def fastq_integrity(spark, sf_dir):
    lines = _reads(spark, sf_dir).withColumn("line", F.explode(F.sequence(F.lit(1), F.lit(4)))).where("not (read_idx % 1000 = 1 and line = 4)")
    return R.fastq_integrity(lines)


def mate_layout(spark, sf_dir):
    files = _reads(spark, sf_dir).select("file").distinct()
    return files.select("file", S.sample_of_path(F.col("file")).alias("sample_id"), S.mate_of_path(F.col("file")).cast("long").alias("mate"))


def amplicon_region(spark, sf_dir):
    return P.extract_region(frame(spark, sf_dir, LONG), *REGION_PRIMERS, REGION_LENGTHS).select("read_idx", "region")


def total_raw_reads(spark, sf_dir):
    return R.total_raw_reads(R.raw_counts(_reads(spark, sf_dir)))


def route_filters(spark, sf_dir):
    """Each route's filter over all reads."""
    kept = [R.filtered_for(_reads(spark, sf_dir), route, BY).groupBy("project").agg(F.count(F.lit(1)).alias("reads"), F.sum(F.length("seq")).alias("bases")).withColumn("route", F.lit(route)) for route in R.FILTERS]
    return functools.reduce(DataFrame.unionByName, kept)


NAMES = (
    "dereplicate singleton_filter read_scores read_quality_gate reject_histogram reverse_complement position_base_freq cdv_states primer_boundary "
    "primer_db_match primer_detection primer_info primer_trimmed orientation_bimodal orientation_split mixed_pair_trim tail_n_profile adaptive_trim "
    "quality_quantiles trim_positions quality_diversity degraded_preprocess sanitize_reads sanitize_pairs pair_reads n_histogram quality_filter "
    "raw_read_counts read_numbering first_reads long_read_gate fastq_integrity mate_layout amplicon_region total_raw_reads route_filters"
).split()
QUERIES = {n: globals()[n] for n in NAMES}

READS_SQL, MATES_SQL, LONG_SQL = sql(READS), sql(MATES), sql(LONG)
_N = "length(seq) - length(replace(upper(seq), 'N', ''))"


def _count(base: str) -> str:
    return f"(length(seq) - length(replace(upper(seq), '{base}', '')))"


_ACGT = "(" + " + ".join(map(_count, "ACGT")) + ")"
_ENTROPY = " + ".join(f"(case when {_count(b)} > 0 then -({_count(b)} / cast({_ACGT} as double)) * log2({_count(b)} / cast({_ACGT} as double)) else 0 end)" for b in "ACGT")
_SCORES = f"""
select *, length(seq) as seq_len, list_sum(list_transform(string_split(qual, ''), lambda c: ascii(c))) / length(qual) - 33 as avg_q,
       len(list_distinct(list_transform(range(1, length(seq)), lambda i: substr(upper(seq), i, 2)))) / 16.0 as complexity, {_ENTROPY} as entropy, {_N} as n_count
from {READS_SQL}
"""
_REASON = "case when seq_len < 50 then 'short' when avg_q < 20 then 'low_quality' when complexity < 0.3 then 'low_complexity' when entropy < 1.0 then 'low_entropy' else 'kept' end"


def _matrix(reads: str) -> str:
    """Frequencies by project and position."""
    letters = f"select project, p as pos, substr(upper(seq), cast(p + 1 as int), 1) as base from {reads}, (select unnest(range(60)) as p)"
    counts = ", ".join(f"count(*) filter (where base = '{b}') as n_{b}" for b in "acgt".upper())
    shares = ", ".join(f"case when n_A + n_C + n_G + n_T = 0 then 0.25 else n_{b} / cast(n_A + n_C + n_G + n_T as double) end as f_{b.lower()}" for b in "ACGT")
    return f"(select project, pos, {shares} from (select project, pos, {counts} from ({letters}) group by project, pos))"


def _states(reads: str) -> str:
    """States and top bases by project and position."""
    ordered = "list_reverse_sort([f_a, f_c, f_g, f_t])"
    return f"""(
    select *, case when o[1] >= 0.8 then 'C' when o[1] + o[2] >= 0.8 and o[2] >= 0.1 then 'D' else 'V' end as state,
           case when f_a = o[1] then 'A' when f_c = o[1] then 'C' when f_g = o[1] then 'G' else 'T' end as top
    from (select *, {ordered} as o from {_matrix(reads)}))"""


def _profile(reads: str) -> str:
    return f"""(
    select project, string_agg(state, '' order by pos) as states, left(string_agg(case when state = 'C' then top else 'N' end, '' order by pos), 30) as consensus
    from {_states(reads)} group by project)"""


def _boundary(reads: str) -> str:
    """By the first V that isn't within a tolerated run."""
    plain = "translate(states, 'D', 'C')"
    tolerated = " or ".join(
        f"(i >= {back} and substr({plain}, cast(i + 1 - {back} as int), {len(shape)}) = '{shape}')" for back, shape in ((3, "CCCVCCC"), (3, "CCCVVCCC"), (4, "CCCVVCCC"))
    )
    return f"""(
    select project, states, consensus, case when e < 10 then 0 else e end as boundary from (
      select project, states, consensus, coalesce(min(i) filter (where substr(states, cast(i + 1 as int), 1) = 'V' and not ({tolerated})),
             case when substr(states, 30, 2) = 'VV' then 31 else 30 end) as e
      from {_profile(reads)}, (select unnest(range(30)) as i) group by project, states, consensus))"""


_IUPAC_ROWS = ", ".join(f"('{k}', {v})" for k, v in {"A": 1, "C": 2, "G": 4, "T": 8, "R": 5, "Y": 10, "S": 6, "W": 9, "K": 12, "M": 3, "B": 14, "D": 13, "H": 11, "V": 7, "N": 15}.items())
_PRIMER_ROWS = ", ".join(f"({i}, '{n}', '{p}')" for i, (n, p) in enumerate(FORWARD_PRIMERS))


def _match(reads: str) -> str:
    """The best known primer by project."""
    return f"""(
    with masks(letter, mask) as (values {_IUPAC_ROWS}), given(i, name, primer) as (values {_PRIMER_ROWS}),
    both_ways as (
      select 2 * i as ord, name, primer from given
      union all select 2 * i + 1, name || '_RC', reverse(translate(primer, 'ACGTRYSWKMBDHVN', 'TGCAYRSWMKVHDBN')) from given),
    cells as (
      select project, ord, name, primer, o as "offset", substr(consensus, cast(o + k + 1 as int), 1) as c, substr(primer, cast(k + 1 as int), 1) as p
      from (select project, consensus, ord, name, primer, unnest(range(length(consensus) - length(primer) + 1)) as o from {_profile(reads)}, both_ways), (select unnest(range(30)) as k)
      where k < length(primer)),
    scored as (
      select project, ord, name, primer, "offset", count(*) filter (where c <> 'N') as informative, count(*) filter (where c <> 'N' and (a.mask & b.mask) <> 0) as same
      from cells join masks a on a.letter = c join masks b on b.letter = p group by project, ord, name, primer, "offset"),
    good as (
      select *, same / cast(informative as double) as identity from scored where informative >= 0.5 * length(primer) and informative > 0 and same / cast(informative as double) >= 0.85)
    select project, name, primer, "offset", identity, "offset" + length(primer) as trim
    from good qualify row_number() over (partition by project order by identity desc, ord, "offset") = 1)"""


_GATED = f"(select project, sample_id, read_idx, seq, qual from ({_SCORES}) where {_REASON} = 'kept')"
_DETECTED = f"""(
  select b.project, b.consensus, reason in ('known', 'unknown') as detected, case reason when 'known' then name when 'unknown' then 'unknown' end as primer,
         case reason when 'known' then m.trim when 'unknown' then boundary else 0 end as trim, reason
  from (select *, case when boundary = 0 then 0.0 else (boundary - length(replace(substr(states, 1, cast(boundary as int)), 'D', ''))) / cast(boundary as double) end as share from {_boundary(_GATED)}) b
  left join {_match(_GATED)} m on m.project = b.project,
  lateral (select case when m.name is not null then 'known' when boundary >= 30 then 'ceiling' when share > 0.25 then 'degenerate' when boundary > 0 then 'unknown' else 'none' end as reason))"""
_DETECT = f"select project, detected, primer, trim, reason from {_DETECTED}"
_FIRST = f"(select project, read_idx, seq1, seq2, seq1 as seq from {MATES_SQL})"
_MIXED = f"""(
  with m as (select project, pos, list_reverse_sort([f_a, f_c, f_g, f_t]) as o, f_a, f_c, f_g, f_t from {_matrix(_FIRST)} where pos < 15),
  t as (
    select *, o[1] + o[2] > 0.85 and o[2] > 0.15 and o[1] < 0.85 as two,
           list_sort([{{'f': -f_a, 'b': 'A'}}, {{'f': -f_c, 'b': 'C'}}, {{'f': -f_g, 'b': 'G'}}, {{'f': -f_t, 'b': 'T'}}]) as r from m),
  b as (select project, pos, r[1].b as major, r[2].b as minor from t where two qualify row_number() over (partition by project order by o[2] desc, pos) = 1),
  s as (select project, avg(case when two then 1.0 else 0.0 end) as ratio from t group by project)
  select s.project, round(ratio, 6) as ratio, ratio > 0.5 as mixed, case when ratio > 0.5 then b.pos end as best_pos,
         case when ratio > 0.5 then major end as major, case when ratio > 0.5 then minor end as minor
  from s left join b on b.project = s.project)"""
_TAIL = f"""(
  select project, pos, coverage, case when coverage = 0 then 0.0 else n / cast(coverage as double) end as n_freq
  from (
    select project, pos, count(*) filter (where length(seq) > pos) as coverage, count(*) filter (where substr(reverse(upper(seq)), cast(pos + 1 as int), 1) = 'N') as n
    from {READS_SQL}, (select unnest(range(50)) as pos) group by project, pos))"""
_TAIL_TRIM = f"""(
  with b as (select project, coalesce(avg(n_freq) filter (where pos between 25 and 44 and coverage > 0), 0) as background from {_TAIL} group by project),
  t as (select project, greatest(background * 3, 0.01) as threshold from b)
  select p.project, threshold, least(coalesce(min(pos) filter (where n_freq <= threshold), 50), 30) as trim from {_TAIL} p join t on t.project = p.project group by p.project, threshold)"""
_BETTER = f"(select project, seq, translate(qual, '!$,5', 'GHIJ') as qual from {READS_SQL})"


def _quantiles(reads: str, points: dict[str, float]) -> str:
    shares = ", ".join(f"quantile_cont(q, {p}) as {n}" for n, p in points.items())
    return f"(select project, pos, count(*) as reads, {shares} from (select project, pos, ascii(substr(qual, cast(pos + 1 as int), 1)) - 33 as q from {reads}, (select unnest(range(120)) as pos) where pos < length(qual)) group by project, pos)"


_POINTS = {"q02": 0.02, "q09": 0.09, "q25": 0.25, "q50": 0.5, "q75": 0.75, "q91": 0.91, "q98": 0.98}
_FILES = f"(select project, file, row_number() over (partition by project order by file) as f from (select distinct project, file from {READS_SQL}))"


def _first(files: int, reads: int) -> str:
    return f"""(
    select r.* from (select *, row_number() over (partition by project, file order by read_idx) as n from {READS_SQL}) r
    join {_FILES} f on f.project = r.project and f.file = r.file where f.f <= {files} and n <= {reads})"""


_DEGRADED = f"""
  with t as (select project, cast(floor(quantile_cont(length(seq) - 15, 0.1) + 1e-9) as bigint) as trunc from {_first(5, 2000)} where length(seq) > 15 group by project),
  v as (
    select r.project, trunc, substr(seq, 16, cast(trunc as int)) as cut,
           case when length(seq) - 15 < greatest(trunc, 50) then 'short'
                when trunc - length(replace(upper(substr(seq, 16, cast(trunc as int))), 'N', '')) > 1 then 'ambiguous' else 'kept' end as verdict
    from {READS_SQL} r join t on t.project = r.project)
  select project, trunc, verdict, count(*) as reads, cast(coalesce(sum(case when verdict = 'kept' then length(cut) end), 0) as bigint) as bases from v group by project, trunc, verdict
"""
_QFILTER = f"""
  with r as (select read_idx, seq, qual, length(seq) as n, instr(regexp_replace(qual, '[!-4]', '!', 'g'), '!!!!') as bad from {READS_SQL}),
  k as (select *, case when bad = 0 then n else bad - 1 end as keep from r)
  select read_idx, keep as kept_len from k
  where keep >= n * 0.85 and keep - length(replace(upper(substr(seq, 1, cast(keep as int))), 'N', '')) <= 1
"""

_REGION = "'CCTACGGG[ACGT]GGC[AT]GCAG([A-Za-z]*?)GGATTAGATACCC[CGT][AGT]GTAGTC'"


def _route_filter(route: str, least: int, share: float, most: int | None) -> str:
    """Reads cut before four scores in a row below ``least``, if enough is left and N are few."""
    at = f"instr(array_to_string(list_transform(string_split(qual, ''), lambda c: case when ascii(c) - 33 < {least} then 'l' else 'h' end), ''), 'llll')"
    cut = f"select project, length(seq) as whole, left(seq, cast(case when {at} = 0 then length(seq) else {at} - 1 end as int)) as seq from {READS_SQL}"
    kept = f"select project, seq, {_N} as n from ({cut}) where length(seq) >= whole * {share}"
    limit = f"(select project, floor(quantile_cont({_N}, 0.95) + 1e-9) as most from {READS_SQL} group by project)" if most is None else f"(select distinct project, {most} as most from {READS_SQL})"
    return f"select k.project, count(*) as reads, cast(sum(length(seq)) as bigint) as bases, '{route}' as route from ({kept}) k join {limit} l on l.project = k.project where n <= most group by k.project"


ORACLE_SQL = {
    "dereplicate": f"select project, upper(seq) as seq, count(*) as size, min(read_idx) as first_idx, (list(header order by read_idx, header))[1] as header from {READS_SQL} group by project, upper(seq)",
    "singleton_filter": f"select project, upper(seq) as seq, count(*) as size from {READS_SQL} group by project, upper(seq) having count(*) >= 2",
    "read_scores": f"select read_idx, seq_len, round(avg_q, 6) as avg_q, round(cast(complexity as double), 6) as complexity, round(entropy, 6) as entropy, n_count from ({_SCORES})",
    "read_quality_gate": f"select read_idx, sample_id from {_GATED}",
    "reject_histogram": f"select project, {_REASON} as reason, count(*) as reads from ({_SCORES}) group by all",
    "reverse_complement": f"select read_idx, reverse(translate(seq, 'ACGTNacgtn', 'TGCANtgcan')) as rc from {READS_SQL}",
    "position_base_freq": f"select project, pos, round(f_a, 6) as f_a, round(f_c, 6) as f_c, round(f_g, 6) as f_g, round(f_t, 6) as f_t from {_matrix(READS_SQL)}",
    "cdv_states": f"select project, pos, state, top from {_states(READS_SQL)}",
    "primer_boundary": f"select project, states, consensus, boundary from {_boundary(READS_SQL)}",
    "primer_db_match": f'select project, name, "offset", round(identity, 6) as identity, trim from {_match(READS_SQL)}',
    "primer_detection": _DETECT,
    "primer_info": f"""
        select project, '{{"mode":"SE","forward_primer":{{' || coalesce('"name":"' || primer || '",', '') || '"consensus":"' || consensus || '","length":' || trim || ',"detected":' || detected || '}}}}' as primer_info from {_DETECTED}""",
    "primer_trimmed": f"select read_idx, substr(seq, cast(trim + 1 as int)) as seq, length(substr(qual, cast(trim + 1 as int))) as qual_len from {READS_SQL} r join ({_DETECT}) d on d.project = r.project",
    "orientation_bimodal": f"select * from {_MIXED}",
    "orientation_split": f"select f.project, count(*) filter (where substr(upper(seq), cast(best_pos + 1 as int), 1) = minor) as minority, count(*) as reads from {_FIRST} f join {_MIXED} m on m.project = f.project group by f.project",
    "mixed_pair_trim": f"""
        select project, read_idx, flipped, substr(case when flipped then seq2 else seq1 end, 17) as seq1, substr(case when flipped then seq1 else seq2 end, 21) as seq2
        from (select f.project, read_idx, seq1, seq2, coalesce(length(seq1) > best_pos and substr(upper(seq1), cast(best_pos + 1 as int), 1) <> major, false) as flipped
              from {_FIRST} f join {_MIXED} m on m.project = f.project)""",
    "tail_n_profile": f"select project, pos, coverage, round(n_freq, 6) as n_freq from {_TAIL}",
    "adaptive_trim": f"""
        select r.project, round(threshold, 6) as threshold, cast(trim as bigint) as trim, cast(floor(quantile_cont(n, 0.95) + 1e-9) as bigint) as max_ambiguous, cast(sum(length(cut)) as bigint) as bases
        from (select *, length(cut) - length(replace(upper(cut), 'N', '')) as n
              from (select r.project, threshold, trim, case when length(seq) > trim then substr(seq, 1, cast(length(seq) - trim as int)) else seq end as cut from {READS_SQL} r join {_TAIL_TRIM} t on t.project = r.project)) r
        group by r.project, threshold, trim""",
    "quality_quantiles": f"select project, pos, reads, {', '.join(f'round({c}, 4) as {c}' for c in _POINTS)} from {_quantiles(READS_SQL, _POINTS)}",
    "trim_positions": f"""
        with q as (select * from {_quantiles(_BETTER, {"q25": 0.25})}),
        a as (select *, max(pos) over (partition by project) as last, reads < least(9000.0, 0.7 * max(reads) over (partition by project)) as low from q),
        o as (select *, least(greatest(coalesce(min(pos) filter (where low) over (partition by project), last), 40), last) as outer1,
              case when count(q25) over w = 5 then avg(q25) over w end as sm from a window w as (partition by project order by pos rows between current row and 4 following)),
        g as (select *, count(sm) over f = 5 and min(sm) over f >= 25 as opens, count(sm) over b = 5 and min(sm) over b >= 25 as closes from o
              window f as (partition by project order by pos rows between current row and 4 following), b as (partition by project order by pos rows between 4 preceding and current row)),
        e as (select project, min(pos) filter (where opens and pos <= outer1 - 5) as s, max(pos) filter (where closes and pos <= least(outer1, last - 4) and pos >= 5) as t from g group by project)
        select project, case when t - s >= 50 then s end as start, case when t - s >= 50 then t end as "end" from e""",
    "quality_diversity": f"select project, count(distinct c) as letters, count(distinct c) <= 1 as degraded from (select project, unnest(string_split(qual, '')) as c from {_first(3, 1000)}) group by project",
    "degraded_preprocess": _DEGRADED,
    "sanitize_reads": f"select sample_id, count(*) as reads from {READS_SQL} where length(seq) >= 50 group by sample_id",
    "sanitize_pairs": f"select project, count(*) as pairs from {MATES_SQL} where length(seq1) >= 50 and length(seq2) >= 50 group by project",
    "pair_reads": f"""
        with r as (select *, read_idx // 16 as n, (read_idx // 8) % 2 as mate, read_idx % 8 as k from {READS_SQL})
        select a.n, a.k, a.seq as seq1, b.seq as seq2 from r a join r b on a.n = b.n and a.k = b.k where a.mate = 0 and b.mate = 1""",
    "n_histogram": f"""
        select project, n_count, reads, share from (
          select *, row_number() over (partition by project order by n_count) as rank, round(reads * 100.0 / sum(reads) over (partition by project), 4) as share
          from (select project, {_N} as n_count, count(*) as reads from {READS_SQL} group by all)) where rank <= 10""",
    "quality_filter": _QFILTER,
    "raw_read_counts": f"select sample_id, count(*) as raw_reads from {READS_SQL} group by sample_id",
    "read_numbering": f"select read_idx, sample_id || '_' || row_number() over (partition by sample_id order by read_idx) || ';sample=' || sample_id || ';' as label from {READS_SQL}",
    "first_reads": f"select file, read_idx from {READS_SQL} qualify row_number() over (partition by file order by read_idx) <= 5",
    "long_read_gate": f"""
        select project, round(avg(case when length(seq) > 1400 then 1.0 else 0.0 end), 6) as share, avg(case when length(seq) > 1400 then 1.0 else 0.0 end) > 0.5 as full_length
        from (select * from {LONG_SQL} qualify row_number() over (partition by project order by read_idx) <= 1000) group by project""",
    "fastq_integrity": f"select file, count(*) as lines, count(*) % 4 = 0 as whole from {READS_SQL}, (select unnest([1, 2, 3, 4]) as line) where not (read_idx % 1000 = 1 and line = 4) group by file",
    "mate_layout": f"select distinct file, sample_id, cast(regexp_extract(file, '_R([12])', 1) as bigint) as mate from {READS_SQL}",
    "amplicon_region": f"""
        select read_idx, region from (
          select read_idx, coalesce(nullif(regexp_extract(upper(seq), {_REGION}, 1), ''), regexp_extract(reverse(translate(upper(seq), 'ACGTN', 'TGCAN')), {_REGION}, 1)) as region from {LONG_SQL})
        where length(region) between 300 and 500""",
    "total_raw_reads": f"select count(*) as total_raw_reads from {READS_SQL}",
    "route_filters": " union all ".join(_route_filter(*x) for x in (("ls454", 0, 0.85, None), ("ion_torrent", 0, 0.85, 0), ("illumina_degraded", 0, 0.85, 1), ("pacbio", 0, 0.9, None), ("illumina", 20, 0.75, 0))),
}
