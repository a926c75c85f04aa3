"""Operators on similar sequences: candidates by exact words, verification by edit distance, greedy choices by rounds.

Two sequences within e edits share a whole part if one of them is cut into e + 1 parts, at places that differ by e at most.
Queries are cut into words of 16, or shorter ones if that gives fewer than e + 2 parts; the e + 1 words that fewest targets
have are enough, so words that all sequences of a gene share don't bring pairs. Candidates are verified with the JVM's bounded edit distance.
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from tarnflow.functions import sequence as S
from tarnflow.session import broadcast_if_small, drop_staged, stage

WORD = 16


def _edits(length: Column, identity: float) -> Column:
    """Most edits within the identity; the small addend keeps products like 0.03 * 100 whole."""
    return F.floor(length * (1 - identity) + 1e-9).cast("int")


def _allowed(length: Column, identity: float, most_edits: int | None) -> Column:
    return _edits(length, identity) if most_edits is None else F.least(_edits(length, identity), F.lit(most_edits))


def candidates(queries: DataFrame, targets: DataFrame, by: list[str], identity: float, same: bool = False, most_edits: int | None = None) -> DataFrame:
    """``q`` and ``t`` of all pairs that may be similar: the target has one of the query's e + 1 rarest parts, at most e
    letters away from the part's own place, and is at most e letters shorter or longer.

    There is a spare part at least, so a word of the conserved region is only looked for if all parts are frequent. Words
    are looked up by their hashes; a target is indexed at places where a part can be, for lengths of part that queries of about
    its size have.
    """
    size = F.length("seq")
    most = _allowed(size / identity, identity, most_edits)
    cut = queries.select(*by, F.col("id").alias("q"), "seq", size.alias("size"), most.alias("most"))
    cut = cut.withColumn("k", F.greatest(F.lit(1), F.least(F.lit(WORD), F.floor(F.col("size") / (F.col("most") + 2)).cast("int"))))
    asked = cut.groupBy(*by, "k").agg(F.max("most").alias("e"), F.min(F.col("size") - F.col("most")).alias("low"), F.max(F.col("size") + F.col("most")).alias("high"))
    asked = broadcast_if_small(stage(asked, "parts-asked"))
    sized = targets.select(*by, F.col("id").alias("t"), "seq", size.alias("t_size"))
    sized = (sized.join(asked, by) if by else sized.crossJoin(asked)).where("t_size between low and high")
    hashed = lambda step: F.posexplode(F.transform(S.words(F.col("seq"), F.col("k"), step), lambda w: F.xxhash64(w))).alias("place", "word")
    index = sized.select(*by, "t", "t_size", "k", "e", hashed(F.lit(1))).where(F.pmod(F.col("place") + F.col("e"), F.col("k")) <= 2 * F.col("e")).drop("k", "e")
    held = index.groupBy(*by, "word").agg(F.count(F.lit(1)).alias("n"))
    parts = cut.select(*by, "q", "size", "most", "k", hashed(F.col("k"))).withColumn("place", F.col("place") * F.col("k")).drop("k")
    ranked = parts.join(held, [*by, "word"], "left").withColumn("rank", F.row_number().over(Window.partitionBy(*by, "q").orderBy(F.coalesce("n", F.lit(0)), "place")))
    seeds = ranked.where((F.col("rank") <= F.col("most") + 1) & F.col("n").isNotNull()).select(*by, "q", "size", "most", "word", F.col("place").alias("q_place"))
    met = seeds.join(index, [*by, "word"]).where((F.abs(F.col("size") - F.col("t_size")) <= F.col("most")) & (F.abs(F.col("place") - F.col("q_place")) <= F.col("most")))
    if same:
        met = met.where("q <> t")
    return met.select(*by, "q", "t").distinct()


def similar_pairs(queries: DataFrame, targets: DataFrame, by: list[str], identity: float, same: bool = False, most_edits: int | None = None) -> DataFrame:
    """``q``, ``t`` and ``edits`` of all pairs with at least the identity, 1 - edits / the longer length, and, if it is
    given, at most ``most_edits``.

    Both sides have ``by`` columns, ``id`` and ``seq``. No pair is missed: each query has more
    parts than it may have edits. ``same`` leaves out pairs of a sequence with itself.
    """
    pairs = candidates(queries, targets, by, identity, same, most_edits)
    a = queries.select(*by, F.col("id").alias("q"), F.upper("seq").alias("qs"))
    b = targets.select(*by, F.col("id").alias("t"), F.upper("seq").alias("ts"))
    longer = F.greatest(F.length("qs"), F.length("ts"))
    rows = pairs.join(a, [*by, "q"]).join(b, [*by, "t"]).withColumn("most", _allowed(longer, identity, most_edits)).where(F.abs(F.length("qs") - F.length("ts")) <= F.col("most"))
    close = F.call_function("levenshtein", F.col("qs"), F.col("ts"), F.col("most"))  # -1 beyond the bound
    return rows.withColumn("edits", close).where("edits >= 0").select(*by, "q", "t", "edits", (1 - F.col("edits") / longer).alias("identity"))


def best_hits(pairs: DataFrame, by: list[str]) -> DataFrame:
    """Each query's most similar target, the least id among equals."""
    rank = F.row_number().over(Window.partitionBy(*by, "q").orderBy(F.desc("identity"), "t"))
    return pairs.withColumn("__n", rank).where("__n = 1").drop("__n")


def map_reads(reads: DataFrame, centroids: DataFrame, by: list[str], identity: float = 0.97) -> DataFrame:
    """Feature counts: each read (``read_idx``, ``sample_id``, ``seq``) counts for its best centroid.

    Equal reads are aligned once. Only reads with a centroid are counted, by its number instead of its name.
    """
    unique = stage(reads.select(*by, F.upper("seq").alias("seq")).distinct().withColumn("id", F.md5("seq")), "mapped-unique")
    hits = best_hits(similar_pairs(unique, centroids, by, identity), by).select(*by, F.col("q").alias("id"), F.col("t").alias("feature_id"))
    hits = stage(hits.join(unique, [*by, "id"]).select(*by, "seq", "feature_id"), "mapped-hits")
    features = broadcast_if_small(stage(hits.select("feature_id").distinct().withColumn("f", F.monotonically_increasing_id()), "mapped-features"))
    known = broadcast_if_small(stage(hits.join(features, "feature_id").select(*by, "seq", "f"), "mapped-known"))
    counted = reads.select(*by, F.upper("seq").alias("seq"), "sample_id").join(known, [*by, "seq"]).groupBy(*by, "f", "sample_id").agg(F.count(F.lit(1)).alias("count"))
    return counted.join(features, "f").select(*by, "feature_id", "sample_id", "count")


def greedy_centroids(nodes: DataFrame, links: DataFrame, by: list[str], tag: str) -> DataFrame:
    """Greedy choice along ``rank``: a node joins its best earlier centroid, or becomes one.

    ``nodes`` has ``by``, ``id`` and ``rank``; ``links`` has ``by``, ``u`` and ``v``: u may join v, which ranks
    before it, with ``edits``. The result has ``centroid`` for each node. It equals the sequential algorithm:
    in each round the nodes are decided whose best decided neighbour comes before all open ones. Only links of
    nodes that are still open are carried on, with what is known of their ends; rounds are written out.
    """
    ends = nodes.select(*by, F.col("id").alias("v"), F.col("rank").alias("vr"))
    edges = stage(links.select(*by, "u", "v", "edits").join(ends, [*by, "v"]).withColumn("is_centroid", F.lit(None).cast("boolean")), f"{tag}-links")
    free = nodes.join(edges.select(*by, F.col("u").alias("id")).distinct(), [*by, "id"], "left_anti")
    new = stage(free.select(*by, "id", F.col("id").alias("centroid")), tag)
    decided = [new]
    while True:
        left = edges.join(new.select(*by, F.col("id").alias("u")), [*by, "u"], "left_anti").join(new.withColumnRenamed("id", "v"), [*by, "v"], "left")
        more = stage(left.select(*by, "u", "v", "edits", "vr", F.coalesce("is_centroid", F.col("centroid") == F.col("v")).alias("is_centroid")), f"{tag}-links")
        drop_staged(edges)
        edges = more
        if not edges.head(1):
            break
        best = F.min(F.when(F.col("is_centroid"), F.struct("edits", "vr", "v"))).alias("best")
        open_ = F.min(F.when(F.col("is_centroid").isNull(), F.struct("edits", "vr"))).alias("open")
        verdict = edges.groupBy(*by, "u").agg(best, open_)
        sure = F.col("open").isNull() | F.coalesce(F.struct("best.edits", "best.vr") < F.col("open"), F.lit(False)) & F.col("best").isNotNull()
        new = stage(verdict.where(sure).select(*by, F.col("u").alias("id"), F.coalesce("best.v", "u").alias("centroid")), tag)
        decided.append(new)
    return nodes.join(functools.reduce(DataFrame.unionAll, decided), [*by, "id"])


def _ranked(seqs: DataFrame, by: list[str]) -> DataFrame:
    """``rank`` orders by size, largest first, then by id; no group has to be sorted for it."""
    return seqs.withColumn("rank", F.struct((-F.col("size")).alias("smaller"), F.col("id").alias("name")))


def cluster_otus(seqs: DataFrame, by: list[str], identity: float = 0.97) -> DataFrame:
    """De-novo clusters of unique sequences (``id``, ``seq``, ``size``), most abundant first: ``centroid`` for each."""
    ranked = stage(_ranked(seqs, by), "otu-ranked")
    order = ranked.select(*by, "id", "rank")
    links = similar_pairs(ranked, ranked, by, identity, same=True).select(*by, F.col("q").alias("u"), F.col("t").alias("v"), "edits")
    links = links.join(order.withColumnsRenamed({"id": "u", "rank": "ur"}), [*by, "u"]).join(order.withColumnsRenamed({"id": "v", "rank": "vr"}), [*by, "v"]).where("vr < ur")
    return ranked.join(greedy_centroids(order, links, by, "otu").drop("rank"), [*by, "id"])


def denoise(seqs: DataFrame, by: list[str], least: int = 2, alpha: float = 2.0, precluster: float = 0.99) -> DataFrame:
    """Denoised sequences with their reads: sizes of at least ``least``, a 99 % precluster, then merging of each sequence
    into an earlier one from which it may have come by error.

    With d edits the abundance ratio has to be 1 / 2 ** (alpha * d + 1) at most (Edgar, 2016).
    """
    kept = seqs.where(F.col("size") >= least)
    near = cluster_otus(kept, by, precluster)
    merged = near.groupBy(*by, F.col("centroid").alias("id")).agg(F.sum("size").alias("total"))
    first = stage(_ranked(near.select(*by, "id", "seq").join(merged, [*by, "id"]).withColumnRenamed("total", "size"), by), "denoise-first")
    order = first.select(*by, "id", "rank", "size")
    largest, smallest = first.agg(F.max("size"), F.min("size")).first()
    # No pair's ratio is beyond that of the largest to the smallest, which bounds the edits that can be errors.
    bound = int(max(0.0, (math.log2(largest / smallest) - 1) / alpha)) if largest else 0
    pairs = similar_pairs(first, first, by, 0.9, same=True, most_edits=bound).select(*by, F.col("q").alias("u"), F.col("t").alias("v"), "edits")
    sized = pairs.join(order.withColumnsRenamed({"id": "u", "rank": "ur", "size": "us"}), [*by, "u"]).join(order.withColumnsRenamed({"id": "v", "rank": "vr", "size": "vs"}), [*by, "v"])
    links = sized.where((F.col("vr") < F.col("ur")) & (F.col("us") / F.col("vs") <= F.pow(F.lit(2.0), -(F.col("edits") * alpha + 1))))
    found = first.join(greedy_centroids(order.drop("size"), links, by, "denoise").drop("rank"), [*by, "id"])
    sizes = found.groupBy(*by, F.col("centroid").alias("id")).agg(F.sum("size").alias("size"))
    return found.where("id = centroid").select(*by, "id", "seq").join(sizes, [*by, "id"])


def chimeras(seqs: DataFrame, by: list[str], skew: float = 2.0) -> DataFrame:
    """``seqs`` (``id``, ``seq``, ``size``) with ``chimera``: whether a front of one and a back of another, both
    ``skew`` times as abundant, make up the whole sequence (the exact two-parent model of Edgar, 2011 and 2016).

    Parents are found by grouping those that can be any's parents on each of their fronts and backs, not by pairing them.
    A front and a back that make up a sequence don't both end before its middle, and a part of a parent's front is one
    too, so only sequences that share a half with a parent are looked at in full.
    """
    rows = stage(seqs.select(*by, "id", F.upper("seq").alias("seq"), "size").withColumn("len", F.length("seq")), "chimera-rows")
    smallest = rows.agg(F.min("size")).first()[0]
    parents = rows.where(F.col("size") >= (smallest or 0) * skew)

    def cut(frame: DataFrame, side: str, n: Column) -> DataFrame:
        part = F.substr(F.col("seq"), F.lit(1), F.col("n")) if side == "front" else F.substr(F.col("seq"), F.col("len") - F.col("n") + 1, F.col("n"))
        return frame.where("len > 0").withColumn("n", n).select(*by, "id", "size", "n", F.xxhash64(part, F.lit(1)).alias("h1"), F.xxhash64(part, F.lit(2)).alias("h2"))

    key = [*by, "n", "h1", "h2"]
    each = F.explode(F.sequence(F.lit(1), F.col("len")))
    tops = {s: stage(cut(parents, s, each).groupBy(*key).agg(F.max(F.struct("size", "id")).alias("top")), f"chimera-{s}") for s in ("front", "back")}
    above = (F.col("top.id") != F.col("id")) & (F.col("top.size") >= F.col("size") * skew)
    open_ = rows
    if skew > 1:
        halves = [cut(rows, s, F.ceil(F.col("len") / 2).cast("int")).join(tops[s].hint("merge"), key).where(above).select(*by, "id") for s in tops]
        open_ = stage(rows.join(halves[0].unionAll(halves[1]).distinct(), [*by, "id"], "left_semi"), "chimera-open")

    def reach(side: str) -> DataFrame:
        # Files of exploded parts look small enough for a broadcast, their rows are not.
        good = cut(open_, side, each).join(tops[side].hint("merge"), key).where(above)
        return good.groupBy(*by, "id").agg(F.max(F.struct("n", F.col("top.id").alias("parent"))).alias(side))

    both = rows.join(reach("front"), [*by, "id"], "left").join(reach("back"), [*by, "id"], "left")
    made = (F.col("front.n") + F.col("back.n") >= F.col("len")) & (F.col("front.parent") != F.col("back.parent"))
    return both.select(*by, "id", "seq", "size", F.coalesce(made, F.lit(False)).alias("chimera"), F.when(made, F.col("front.parent")).alias("parent_a"), F.when(made, F.col("back.parent")).alias("parent_b"))


def non_chimeras(seqs: DataFrame, by: list[str], skew: float = 2.0) -> DataFrame:
    return chimeras(seqs, by, skew).where("not chimera").select(*by, "id", "seq", "size")
