"""Queries of the feature-table, similarity, taxonomy and legacy operators, with their SQL."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from tarnflow.functions import sequence as S
from tarnflow.operators import error_model as E, features as T, legacy as L, pairs as Q, reads as R, similarity as Y, taxonomy as N
from tarnflow.pipeline.process import plan
from tarnflow.plans.derived import FEATURES, MATES, META, READS, frame, sql
from tarnflow.session import read_table, stage

BY = ["project"]
_PLATFORMS = ["Illumina MiSeq", "454 GS FLX", "Ion Torrent PGM", "PacBio Sequel II", "MinION", "BGISEQ-500"]


def _table(spark, sf_dir):
    return frame(spark, sf_dir, FEATURES).withColumnRenamed("n", "count")


def _parts(spark, sf_dir):
    """The table cut in two that overlap."""
    table = _table(spark, sf_dir)
    return [table.where("sample_id < 'S5'").drop("project"), table.where("sample_id > 'S3'").drop("project")]


def _unique(spark, sf_dir, least=1):
    found = R.dereplicate(frame(spark, sf_dir, READS), BY, least)
    return stage(found.select("project", F.md5("seq").alias("id"), "seq", "size", "first_idx"), "unique")


def feature_totals(spark, sf_dir):
    return T.totals(_table(spark, sf_dir), ["project"])


def sample_totals(spark, sf_dir):
    return T.totals(_table(spark, sf_dir), ["sample_id"]).select("sample_id", "reads", "features")


def merge_feature_tables(spark, sf_dir):
    return T.merge_tables(_parts(spark, sf_dir)).withColumnRenamed("count", "n")


def overlapping_samples(spark, sf_dir):
    return T.overlapping_samples(_parts(spark, sf_dir))


def merge_rep_seqs(spark, sf_dir):
    reads = frame(spark, sf_dir, READS)
    parts = [reads.where(f"read_idx % 2 = {i}").select(F.md5(F.upper("seq")).alias("feature_id"), F.when(F.lit(i == 1), F.lower("seq")).otherwise(F.upper("seq")).alias("seq")) for i in (0, 1)]
    return T.merge_sequences(parts)


def min_freq_filter(spark, sf_dir):
    return T.frequent_features(_table(spark, sf_dir), 2).select("project", "feature_id", "sample_id", F.col("count").alias("n"))


def synced_rep_seqs(spark, sf_dir):
    seqs = frame(spark, sf_dir, READS).select(F.md5(F.upper("seq")).alias("feature_id"), F.upper("seq").alias("seq")).distinct()
    return T.same_features(seqs, T.frequent_features(_table(spark, sf_dir), 2))


def table_summary(spark, sf_dir):
    by_sample, by_feature = (T.summary(_table(spark, sf_dir), c).withColumn("of", F.lit(c)) for c in ("sample_id", "feature_id"))
    return by_sample.unionByName(by_feature)


def otu_pivot(spark, sf_dir):
    places = T.sample_places(_table(spark, sf_dir))
    return T.pivoted(_table(spark, sf_dir), places).select("feature_id", T.dense(places.count(), " ").alias("counts"))


def otu_unpivot(spark, sf_dir):
    places = T.sample_places(_table(spark, sf_dir))
    wide = T.pivoted(_table(spark, sf_dir), places).select(F.concat("feature_id", F.lit(";size=3")).alias("#OTU ID"), "cells")
    return T.unpivoted(wide, places).withColumnRenamed("count", "n")


def feature_prefix(spark, sf_dir):
    return T.prefixed(_table(spark, sf_dir), "ds1_").groupBy("feature_id").agg(F.sum("count").alias("n"))


def abundance_order(spark, sf_dir):
    return T.by_abundance(R.dereplicate(frame(spark, sf_dir, READS), BY), BY).select("project", "rank", "size", "first_idx")


def prefix_primer(spark, sf_dir):
    return T.prefix_share(frame(spark, sf_dir, READS), BY)


def heavy_prefixes(spark, sf_dir):
    return T.heavy_prefixes(frame(spark, sf_dir, READS), BY)


def similar_pairs(spark, sf_dir):
    seqs = _unique(spark, sf_dir, 2)
    changed = seqs.withColumn("seq", F.concat(F.left("seq", F.lit(30)), F.lit("A"), F.substring("seq", 32, 1000)))
    pairs = Y.similar_pairs(changed, seqs, BY, 0.97)
    return pairs.select("project", "q", "t", F.col("edits").cast("long").alias("edits"), F.round("identity", 6).alias("identity"))


def read_mapping97(spark, sf_dir):
    return Y.map_reads(frame(spark, sf_dir, READS), _unique(spark, sf_dir, 2), BY).withColumnRenamed("count", "n")


def otu_cluster97(spark, sf_dir):
    return Y.cluster_otus(_unique(spark, sf_dir), BY).select("project", "id", "size", "centroid")


def unoise(spark, sf_dir):
    return Y.denoise(_unique(spark, sf_dir), BY)


def error_model(spark, sf_dir):
    return E.variants(E.denoise(_unique(spark, sf_dir, 2), BY), BY).select("project", "id", "reads")


def chimera(spark, sf_dir):
    seqs = _unique(spark, sf_dir)
    top = stage(seqs.select("project", "id", "seq", "size").withColumn("k", F.row_number().over(Window.partitionBy("project").orderBy(F.desc("size"), "id"))), "top")
    a, b = top.where("k % 2 = 1"), top.where("k % 2 = 0").select("project", (F.col("k") - 1).alias("k"), F.col("seq").alias("other"))
    made = a.join(b, ["project", "k"]).select("project", F.concat(F.left("seq", F.lit(30)), F.right("other", F.lit(25))).alias("seq")).select("project", F.md5("seq").alias("id"), "seq", F.lit(1).cast("long").alias("size"))
    both = top.select("project", "id", "seq", "size").unionByName(made.join(top.select("project", "id"), ["project", "id"], "left_anti").distinct())
    return Y.chimeras(both, BY).select("project", "id", "size", "chimera")


def _overlapping(spark, sf_dir):
    rows = frame(spark, sf_dir, MATES).select("read_idx", F.substring("seq2", 21, 1000).alias("whole"))
    flipped = F.reverse(F.translate("whole", "ACGTN", "TGCAN"))
    return rows.select("read_idx", F.left("whole", F.lit(45)).alias("seq1"), F.left(flipped, F.lit(45)).alias("seq2")).withColumns({"qual1": F.repeat(F.lit("I"), F.length("seq1")), "qual2": F.repeat(F.lit("H"), F.length("seq2"))})


def merge_pairs(spark, sf_dir):
    return Q.merge_pairs(_overlapping(spark, sf_dir)).select("read_idx", "insert_len", "seq")


def adapter_removal(spark, sf_dir):
    pairs = _overlapping(spark, sf_dir)
    short = pairs.select("read_idx", *[F.concat(F.left(c, F.lit(30)) if i == 0 else F.left(F.reverse(F.translate(F.left("seq1", F.lit(30)), "ACGTN", "TGCAN")), F.lit(30)), F.lit("GATCGGAAGAGC")).alias(c) for i, c in enumerate(("seq1", "seq2"))])
    cut = Q.without_adapters(short.withColumns({"qual1": F.repeat(F.lit("I"), F.length("seq1")), "qual2": F.repeat(F.lit("I"), F.length("seq2"))}))
    return cut.select("read_idx", "seq1", "seq2")


def adapter_search(spark, sf_dir):
    reads = frame(spark, sf_dir, READS).withColumn("seq", F.when(F.col("read_idx") % 3 == 0, F.concat(F.left("seq", F.lit(40)), F.lit("AGATCGGAAGAGCACACG"))).otherwise(F.col("seq")))
    return Q.without_adapter(reads, "AGATCGGAAGAGCACACGTCTG").select("read_idx", "seq", F.length("qual").cast("long").alias("qual_len"))


def merge_gate(spark, sf_dir):
    counts = read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), (F.col("o_custkey") % 100).alias("merged"), (F.col("o_orderkey") % 100).alias("unmerged"))
    return Q.merge_quality(counts).groupBy("forward_only").agg(F.count(F.lit(1)).alias("n"))


def orient(spark, sf_dir):
    reads = frame(spark, sf_dir, READS).select(F.col("read_idx").alias("id"), F.upper("seq").alias("seq"))
    mixed = reads.withColumn("seq", F.when(F.col("id") % 3 == 0, F.reverse(F.translate("seq", "ACGTN", "TGCAN"))).otherwise(F.col("seq")))
    return N.oriented(mixed, reads.where("id % 16 = 1")).select("id", "plus", "minus", "seq")


def nb_taxonomy(spark, sf_dir):
    unique = _unique(spark, sf_dir, 2).select("seq").distinct().withColumn("taxon", F.concat(F.lit("d__B;p__"), F.substring("seq", 17, 1), F.lit(";g__"), F.substring("seq", 17, 3)))
    reads = frame(spark, sf_dir, READS).groupBy(F.upper("seq").alias("seq")).agg(F.count(F.lit(1)).alias("reads")).withColumn("id", F.md5("seq"))
    return N.classify(reads, N.train(unique)).join(reads.select("id", "reads"), "id")


def study_plan(spark, sf_dir):
    """Layout, quality, platform and route of each data set; the platform's name is by the project's digit."""
    reads = frame(spark, sf_dir, READS).withColumns({"dataset_id": F.col("project"), "mate": S.mate_of_path(F.col("file"))})
    texts = F.array(*map(F.lit, _PLATFORMS))
    platforms = reads.select("dataset_id").distinct().withColumn("platform", F.get(texts, (F.right("dataset_id", F.lit(1)).cast("int") % len(_PLATFORMS)).cast("int")))
    return plan(reads, platforms)


def placement_split(spark, sf_dir):
    table = _table(spark, sf_dir)
    kept, removed = N.split_by_placement(table, table.where("count > 1").select("feature_id"))
    tally = lambda x, n: x.agg(F.count(F.lit(1)).alias("rows"), F.sum("count").alias("reads")).withColumn("part", F.lit(n))
    return tally(kept, "kept").unionByName(tally(removed, "removed"))


def nearest_tip(spark, sf_dir):
    seqs = _unique(spark, sf_dir).select("id", "seq").distinct()
    return N.place_near(seqs, seqs.where("length(seq) > 90"))


def source_tally(spark, sf_dir):
    meta = frame(spark, sf_dir, META)
    tables = {"NCBI": meta.select(F.col("run").alias("Run"), F.col("bioproject").alias("BioProject")).where("Run like 'SRR%'"), "CNCB": meta.where("run like 'CRR%'").select(F.col("run").alias("Accession"), "status")}
    union = L.standard_union(tables)
    return L.source_tally(union.where("Run is not null"))


def prefix_routes(spark, sf_dir):
    ids = frame(spark, sf_dir, META).select(F.explode(F.array("run", "bioproject", F.replace("bioproject", F.lit("PRJNA"), F.lit("PRJCA")))).alias("id")).where("id is not null")
    return ids.groupBy(L.route_by_prefix(F.col("id")).alias("route")).agg(F.count(F.lit(1)).alias("n"))


def attribute_synonyms(spark, sf_dir):
    rows = read_table(spark, sf_dir, "part").select(F.col("p_brand").alias("name"), F.col("p_type").alias("synonym"))
    return L.synonyms(rows).select("name", F.array_join("synonyms", "|").alias("synonyms"))


def joined_stats(spark, sf_dir):
    reads = frame(spark, sf_dir, READS)
    a = R.raw_counts(reads.where("length(seq) > 60"))
    b = R.raw_counts(reads.where("read_idx % 7 = 3")).withColumnRenamed("raw_reads", "kept")
    return L.joined_stats(a, b)


def count_trim(spark, sf_dir):
    by = ["mate"]
    return L.trim_length(R.quality_quantiles(frame(spark, sf_dir, READS).withColumn("mate", S.mate_of_path(F.col("file"))), by), by)


def anchor_trim(spark, sf_dir):
    hits = read_table(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 10).alias("g"), (F.col("l_partkey") % 40).alias("start"), (F.col("l_orderkey") % 25).alias("cut"))
    anchors = spark.createDataFrame([(8,), (19,), (27,)], "anchor long")
    return L.nearest_anchor(hits, anchors, ["g"])


def first_of_first_files(spark, sf_dir):
    return L.first_of_first_files(frame(spark, sf_dir, READS)).select("file", "read_idx")


def plain_file_names(spark, sf_dir):
    run = frame(spark, sf_dir, META).where("bioproject is not null")
    name = F.when(F.col("ord") % 2 == 0, F.concat_ws("_", "bioproject", "run", "run", F.lit("1.fastq"))).otherwise(F.concat_ws("_", "bioproject", "run", F.lit("1.fastq")))
    return run.select("ord", L.plain_file_name(name).alias("name"))


def layout_by_counts(spark, sf_dir):
    return L.layout_by_counts(read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), (F.col("o_orderkey") % 5).alias("files"), (F.col("o_custkey") % 3).alias("runs")))


NAMES = (
    "feature_totals sample_totals merge_feature_tables overlapping_samples merge_rep_seqs min_freq_filter synced_rep_seqs table_summary otu_pivot otu_unpivot "
    "feature_prefix abundance_order prefix_primer heavy_prefixes similar_pairs read_mapping97 otu_cluster97 unoise error_model chimera merge_pairs adapter_removal adapter_search "
    "merge_gate orient nb_taxonomy study_plan placement_split nearest_tip source_tally prefix_routes attribute_synonyms joined_stats count_trim anchor_trim first_of_first_files "
    "plain_file_names layout_by_counts"
).split()
QUERIES = {n: globals()[n] for n in NAMES}

_R, _F, _P, _M = sql(READS), sql(FEATURES), sql(MATES), sql(META)
_A, _B = f"(select feature_id, sample_id, n from {_F} where sample_id < 'S5')", f"(select feature_id, sample_id, n from {_F} where sample_id > 'S3')"
_UNIQUE = f"(select project, md5(upper(seq)) as id, upper(seq) as seq, count(*) as size from {_R} group by project, upper(seq))"
_FREQUENT = f"(select feature_id from {_F} group by feature_id having sum(n) >= 2)"


def _summary(by: str) -> str:
    q = ", ".join(f"quantile_cont(n, {p}) as {c}" for c, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75)))
    return f"select '{by}' as of, count(*) as groups, cast(sum(n) as bigint) as reads, min(n) as least, {q}, max(n) as most from (select {by}, cast(sum(n) as bigint) as n from {_F} group by {by})"


_OVER = f"""(select read_idx, left(whole, 45) as seq1, left(reverse(translate(whole, 'ACGTN', 'TGCAN')), 45) as seq2 from (select read_idx, substr(seq2, 21) as whole from {_P}))"""


def _prefixes(length: int, least: int) -> str:
    counts = f"select project, left(upper(seq), {length}) as prefix, count(*) as n from {_R} where length(seq) >= {least} group by project, left(upper(seq), {length})"
    return f"(select *, sum(n) over (partition by project) as total from ({counts}))"


ORACLE_SQL = {
    "feature_totals": f"select project, cast(sum(n) as bigint) as reads, count(distinct feature_id) as features, count(distinct sample_id) as samples from {_F} group by project",
    "sample_totals": f"select sample_id, cast(sum(n) as bigint) as reads, count(distinct feature_id) as features from {_F} group by sample_id",
    "merge_feature_tables": f"select feature_id, sample_id, cast(sum(n) as bigint) as n from (select * from {_A} union all select * from {_B}) group by all",
    "overlapping_samples": f"select sample_id, 2 as tables from (select sample_id from {_A} intersect select sample_id from {_B})",
    "merge_rep_seqs": f"select md5(upper(seq)) as feature_id, case when bool_or(read_idx % 2 = 0) then upper(seq) else lower(seq) end as seq from {_R} group by upper(seq), lower(seq)",
    "min_freq_filter": f"select project, feature_id, sample_id, n from {_F} where feature_id in {_FREQUENT}",
    "synced_rep_seqs": f"select distinct md5(upper(seq)) as feature_id, upper(seq) as seq from {_R} where md5(upper(seq)) in {_FREQUENT}",
    "table_summary": f"{_summary('sample_id')} union all {_summary('feature_id')}",
    "otu_pivot": f"""
        with t as (select feature_id, sample_id, cast(sum(n) as bigint) as n from {_F} group by all), s as (select distinct sample_id from t), f as (select distinct feature_id from t)
        select f.feature_id, string_agg(coalesce(t.n, 0), ' ' order by s.sample_id) as counts from f cross join s left join t on t.feature_id = f.feature_id and t.sample_id = s.sample_id group by f.feature_id""",
    "otu_unpivot": f"select feature_id, sample_id, cast(sum(n) as bigint) as n from {_F} group by all",
    "feature_prefix": f"select 'ds1_' || feature_id as feature_id, cast(sum(n) as bigint) as n from {_F} group by feature_id",
    "abundance_order": f"""
        select project, row_number() over (partition by project order by size desc, first_idx) as rank, size, first_idx
        from (select project, count(*) as size, min(read_idx) as first_idx from {_R} group by project, upper(seq))""",
    "prefix_primer": f"""
        select project, prefix, round(n / cast(total as double), 6) as share, cast(case when n / cast(total as double) > 0.5 then 20 else 0 end as bigint) as cut from {_prefixes(20, 20)}
        qualify row_number() over (partition by project order by n desc, prefix desc) = 1""",
    "heavy_prefixes": f"select project, prefix, n from {_prefixes(40, 15)} where n > 0.01 * total",
    "similar_pairs": f"""
        with t as (select * from {_UNIQUE} where size >= 2), q as (select project, id, left(seq, 30) || 'A' || substr(seq, 32) as seq from t),
        p as (select q.project, q.id as q, t.id as t, q.seq as qs, t.seq as ts, greatest(length(q.seq), length(t.seq)) as n from q join t on t.project = q.project and abs(length(q.seq) - length(t.seq)) <= 4)
        select project, q, t, levenshtein(qs, ts) as edits, round(1 - levenshtein(qs, ts) / cast(n as double), 6) as identity from p where levenshtein(qs, ts) <= floor(n * (1 - 0.97) + 1e-9)""",
    "read_mapping97": f"""
        with u as (select * from {_UNIQUE}), t as (select * from u where size >= 2),
        p as (select u.project, u.id as q, t.id as t, u.seq as qs, t.seq as ts, greatest(length(u.seq), length(t.seq)) as n from u join t on t.project = u.project and abs(length(u.seq) - length(t.seq)) <= 3),
        d as (select project, q, t, n, levenshtein(qs, ts) as e from p),
        b as (select project, q, t from d where e <= floor(n * (1 - 0.97) + 1e-9) qualify row_number() over (partition by project, q order by 1 - e / cast(n as double) desc, t) = 1)
        select f.project, b.t as feature_id, f.sample_id, cast(sum(f.n) as bigint) as n from {_F} f join b on b.project = f.project and b.q = f.feature_id group by all""",
    "chimera": f"""
        with top as (select project, id, seq, size, row_number() over (partition by project order by size desc, id) as k from {_UNIQUE}),
        made as (select distinct a.project, left(a.seq, 30) || right(b.seq, 25) as seq from top a join top b on b.project = a.project and b.k = a.k + 1 where a.k % 2 = 1),
        s as (select project, id, seq, size from top union all select project, md5(seq), seq, 1 from made where (project, md5(seq)) not in (select (project, id) from top)),
        r as (select *, unnest(range(1, length(seq) + 1)) as l from s),
        fronts as (select project, left(seq, cast(l as int)) as part, arg_max(id, {{'s': size, 'i': id}}) as parent, max(size) as psize from r group by all),
        backs as (select project, right(seq, cast(l as int)) as part, arg_max(id, {{'s': size, 'i': id}}) as parent, max(size) as psize from r group by all),
        front as (select r.project, r.id, arg_max(parent, l) as fp, max(l) as fl from r join fronts f on f.project = r.project and f.part = left(r.seq, cast(l as int)) where psize >= 2 * size group by all),
        back as (select r.project, r.id, arg_max(parent, l) as bp, max(l) as bl from r join backs b on b.project = r.project and b.part = right(r.seq, cast(l as int)) where psize >= 2 * size group by all)
        select s.project, s.id, s.size, coalesce(fl + bl >= length(s.seq) and fp <> bp, false) as chimera
        from s left join front f on f.project = s.project and f.id = s.id left join back b on b.project = s.project and b.id = s.id""",
    "adapter_removal": f"select read_idx, left(seq1, 30) as seq1, reverse(translate(left(seq1, 30), 'ACGTN', 'TGCAN')) as seq2 from {_OVER}",
    "nearest_tip": f"""
        with u as (select distinct id, seq, list_distinct(list_transform(range(1, length(seq) - 10), lambda i: substr(seq, i, 12))) as words from {_UNIQUE}),
        q as (select id, len(words) as size, unnest(words) as word from u), i as (select id as tip, unnest(words) as word from u where length(seq) > 90),
        c as (select q.id, tip, count(*) / cast(size as double) as share from q join i on i.word = q.word group by q.id, tip, size)
        select id as feature_id, tip, round(share, 6) as share from c where share >= 0.5 qualify row_number() over (partition by id order by share desc, tip) = 1""",
    "adapter_search": f"""
        with r as (select read_idx, qual, case when read_idx % 3 = 0 then left(seq, 40) || 'AGATCGGAAGAGCACACG' else seq end as seq from {_R}), c as (select *, instr(upper(seq), 'AGATCGGAAGAG') as hit from r)
        select read_idx, case when hit > 0 then left(seq, cast(hit - 1 as int)) else seq end as seq, case when hit > 0 then least(length(qual), hit - 1) else length(qual) end as qual_len from c""",
    "merge_gate": "select (o_orderkey % 100) * 1.5 > o_custkey % 100 as forward_only, count(*) as n from orders group by all",
    "orient": f"""
        with r as (select read_idx as id, upper(seq) as seq from {_R}), m as (select id, case when id % 3 = 0 then reverse(translate(seq, 'ACGTN', 'TGCAN')) else seq end as seq from r),
        k as (select distinct unnest(list_transform(range(1, length(seq) - 10), lambda i: substr(seq, i, 12))) as word from r where id % 16 = 1),
        b as (select id, '+' as strand, seq as s from m union all select id, '-', reverse(translate(seq, 'ACGTN', 'TGCAN')) from m),
        w as (select id, strand, unnest(list_distinct(list_transform(range(1, length(s) - 10), lambda i: substr(s, i, 12)))) as word from b),
        v as (select id, count(*) filter (where strand = '+') as plus, count(*) filter (where strand = '-') as minus from w where word in (select word from k) group by id)
        select m.id, plus, minus, case when minus > plus then reverse(translate(seq, 'ACGTN', 'TGCAN')) else seq end as seq from m join v on v.id = m.id""",
    "nb_taxonomy": f"""
        with all_reads as (select md5(upper(seq)) as id, upper(seq) as seq, count(*) as reads from {_R} group by upper(seq)), refs as (select distinct seq, 'd__B;p__' || substr(seq, 17, 1) || ';g__' || substr(seq, 17, 3) as taxon from {_UNIQUE} where size >= 2),
        rw as (select taxon, word, count(*) as n from (select taxon, unnest(list_transform(range(1, length(seq) - 6), lambda i: substr(seq, i, 8))) as word from refs) group by all),
        sums as (select taxon, sum(n) as total, ln(0.01 / (sum(n) + 0.01 * 65536)) as other from rw group by taxon),
        gains as (select rw.taxon, word, ln((n + 0.01) / (total + 0.01 * 65536)) - other as gain from rw join sums on sums.taxon = rw.taxon),
        q as (select id, word, count(*) as m from (select id, unnest(list_transform(range(1, length(seq) - 6), lambda i: substr(seq, i, 8))) as word from all_reads) group by all),
        sizes as (select id, sum(m) as size from q group by id),
        scored as (select g.id, g.taxon, g.total + size * other as lp from (select id, taxon, sum(m * gain) as total from q join gains on gains.word = q.word group by all) g join sizes on sizes.id = g.id join sums on sums.taxon = g.taxon),
        p as (select id, taxon, exp(lp - max(lp) over (partition by id)) as w from scored),
        r as (select id, depth, array_to_string(string_split(taxon, ';')[1:depth], ';') as name, sum(w) / total as p from (select *, sum(w) over (partition by id) as total, unnest([1, 2, 3]) as depth from p) group by id, depth, name, total),
        b as (select id, name, p from r where p >= 0.7 qualify row_number() over (partition by id order by depth desc, p desc, name desc) = 1)
        select i.id, i.reads, coalesce(name, 'Unassigned') as taxon, round(coalesce(p, 0.0), 6) as confidence from all_reads i left join b on b.id = i.id""",
    "study_plan": f"""
        with r as (select *, cast(regexp_extract(file, '_R([12])', 1) as int) as mate from {_R}),
        s as (select project, sample_id, count(distinct mate) = 2 as pe from r group by all), l as (select project, case when count(*) filter (where pe) * 2 >= count(*) then 'PE' else 'SE' end as layout from s group by project),
        f as (select project, file, row_number() over (partition by project order by file) as k from (select distinct project, file from r where mate = 1)),
        o as (select r.*, row_number() over (partition by r.project, r.file order by read_idx) as n from r join f on f.project = r.project and f.file = r.file where k <= 3),
        q as (select project, count(distinct c) <= 1 as degraded from (select project, unnest(string_split(qual, '')) as c from o where n <= 1000) group by project),
        p as (select project, ['ILLUMINA', 'LS454', 'ION_TORRENT', 'PACBIO_SMRT', 'OXFORD_NANOPORE', 'BGISEQ-500'][cast(right(project, 1) as int) % 6 + 1] as platform from l)
        select r.project as dataset_id, count(*) as raw_reads, layout, degraded, platform,
               case when platform = 'ILLUMINA' and degraded then 'illumina_degraded' when platform = 'ILLUMINA' then 'illumina' when platform = 'LS454' then 'ls454' when platform = 'ION_TORRENT' then 'ion_torrent'
                    when platform = 'PACBIO_SMRT' then 'pacbio' when platform = 'OXFORD_NANOPORE' then 'unsupported' else 'failed' end as route
        from r join l on l.project = r.project join q on q.project = r.project join p on p.project = r.project group by r.project, layout, degraded, platform""",
    "placement_split": f"""
        with p as (select distinct feature_id from {_F} where n > 1)
        select case when feature_id in (select feature_id from p) then 'kept' else 'removed' end as part, count(*) as rows, cast(sum(n) as bigint) as reads from {_F} group by all""",
    "source_tally": f"select case when run like 'SRR%' then 'NCBI' else 'CNCB' end as source, count(*) as n from {_M} group by all",
    "prefix_routes": f"""
        select case when id like 'PRJCA%' or id like 'CRA%' then 'cncb' when id like 'PRJNA%' or id like 'PRJEB%' or id like 'PRJDB%' then 'ncbi' else 'unknown' end as route, count(*) as n
        from (select unnest([run, bioproject, replace(bioproject, 'PRJNA', 'PRJCA')]) as id from {_M}) where id is not null group by all""",
    "attribute_synonyms": "select p_brand as name, string_agg(distinct p_type, '|' order by p_type) as synonyms from part group by p_brand",
    "joined_stats": f"""
        select coalesce(a.sample_id, b.sample_id) as sample_id, raw_reads, kept from (select sample_id, count(*) as raw_reads from {_R} where length(seq) > 60 group by sample_id) a
        full join (select sample_id, count(*) as kept from {_R} where read_idx % 7 = 3 group by sample_id) b on a.sample_id = b.sample_id""",
    "count_trim": f"""
        select mate, coalesce(min(pos) filter (where reads < 9000), max(pos)) as trim
        from (select cast(regexp_extract(file, '_R([12])', 1) as int) as mate, pos, count(*) as reads from {_R}, (select unnest(range(120)) as pos) where pos < length(qual) group by all) group by mate""",
    "anchor_trim": """
        with c as (select l_suppkey % 10 as g, l_partkey % 40 as start, count(*) as n, quantile_cont(l_orderkey % 25, 0.5) as cut from lineitem group by all),
        m as (select g, start, cut from c qualify row_number() over (partition by g order by n desc, start) = 1)
        select g, start, cut, anchor from m, (values (8), (19), (27)) a(anchor) qualify row_number() over (partition by g order by abs(anchor - start), anchor) = 1""",
    "first_of_first_files": f"""
        select file, read_idx from {_R} where file in (select distinct file from {_R} order by file limit 3) qualify row_number() over (partition by file order by read_idx) <= 20""",
    "plain_file_names": f"select ord, bioproject || '_' || run || '_1.fastq' as name from {_M} where bioproject is not null",
    "layout_by_counts": "select o_orderkey as k, o_orderkey % 5 as files, o_custkey % 3 as runs, case when o_orderkey % 5 = 2 * (o_custkey % 3) then 'paired' when o_orderkey % 5 = o_custkey % 3 then 'single' else 'error' end as layout from orders",
}
