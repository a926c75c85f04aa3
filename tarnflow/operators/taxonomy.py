"""Orientation against references and naive Bayes classification by k-mers.

The classifier is the multinomial model over k-mers: its tables are counts by k-mer and taxon. Small models are
broadcast as a matrix, larger ones joined, so neither the reference nor the k-mers have to fit one machine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from tarnflow.functions import sequence as S
from tarnflow.operators.letters import bytes_of
from tarnflow.operators.similarity import map_reads
from tarnflow.session import broadcast_if_small, stage

K_ORIENT, K_CLASS = 12, 8
CONFIDENCE = 0.7
USUAL, MOST_USUAL = 8, 200_000  # words of more tips are looked for last, as far as they are among the most usual ones
SPARE = 3  # further words
MODEL_CELLS = 8_000_000  # words by taxa of a model that is broadcast: 64 MB


def oriented(seqs: DataFrame, references: DataFrame, k: int = K_ORIENT) -> DataFrame:
    """``seqs`` (``id``, ``seq``) turned the way that shares more words with the references; without any: dropped.

    Equal votes keep the given direction. Equal sequences are looked at once; votes of an id that repeats add up.
    """
    known = references.select(F.explode(F.array_distinct(S.words(F.col("seq"), k))).alias("word")).distinct()
    both = F.array(F.struct(F.lit("+").alias("strand"), F.col("seq").alias("s")), F.struct(F.lit("-").alias("strand"), S.reverse_complement(F.col("seq")).alias("s")))
    unique = seqs.select("seq").distinct()
    words = unique.select("seq", F.explode(both).alias("x")).select("seq", F.col("x.strand").alias("strand"), F.explode(F.array_distinct(S.words(F.col("x.s"), k))).alias("word"))
    votes = words.join(known, "word", "left_semi").groupBy("seq").agg(F.count_if(F.col("strand") == "+").alias("plus"), F.count_if(F.col("strand") == "-").alias("minus"))
    rows = seqs.join(seqs.select("id", "seq").join(votes, "seq").groupBy("id").agg(F.sum("plus").alias("plus"), F.sum("minus").alias("minus")), "id")
    return rows.withColumn("seq", F.when(F.col("minus") > F.col("plus"), S.reverse_complement(F.col("seq"))).otherwise(F.col("seq")))


def train(references: DataFrame, k: int = K_CLASS, smoothing: float = 0.01) -> tuple[DataFrame, DataFrame]:
    """Tables of the model from ``seq`` and ``taxon`` (ranks joined by semicolons): log weights of words that a taxon
    has, and by taxon the log weight of any other word and the log prior (uniform, so 0 by default)."""
    words = references.select("taxon", F.explode(S.words(F.col("seq"), k)).alias("word")).groupBy("taxon", "word").agg(F.count(F.lit(1)).alias("n"))
    vocabulary = float(4**k)
    sums = words.groupBy("taxon").agg(F.sum("n").alias("all")).withColumn("other", F.log(F.lit(smoothing) / (F.col("all") + smoothing * vocabulary)))
    gains = words.join(sums, "taxon").select("taxon", "word", (F.log((F.col("n") + smoothing) / (F.col("all") + smoothing * vocabulary)) - F.col("other")).alias("gain"))
    return gains, sums.select("taxon", "other")


def _gained_by_product(seqs: DataFrame, gains: DataFrame, sums: DataFrame, k: int) -> DataFrame:
    """``seq``, ``taxon`` and ``p`` (its probability, those above 1e-9) of each sequence that shares a word with the references.

    The model is a matrix of words by taxa, small enough to be broadcast; a batch is scored by adding rows of it.
    """
    # The caller checks the size. Cells come to the driver by numbers, 16 bytes each, not by names.
    number = lambda x, name, n: stage(x.withColumn(n, F.row_number().over(Window.orderBy(name)) - 1), "model-numbers")
    by_taxon, by_word = number(sums, "taxon", "t"), number(gains.select("word").distinct(), "word", "w")
    others = by_taxon.orderBy("t").toPandas()
    taxa, words = others["taxon"].to_numpy(), by_word.orderBy("w").toPandas()["word"].to_numpy(str)
    weights = np.zeros((len(words) + 1, len(taxa)))
    for cells in gains.join(broadcast_if_small(by_taxon), "taxon").join(broadcast_if_small(by_word), "word").select("w", "t", "gain").toArrow().to_batches():
        w, t, gain = (c.to_numpy(zero_copy_only=False) for c in cells.columns)
        weights[w, t] = gain
    held = seqs.sparkSession.sparkContext.broadcast((words.astype(f"S{k}"), weights, taxa, others["other"].to_numpy(float)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, weights, taxa, other = held.value
        at_once = max(1, min(1024, 4_000_000 // (300 * max(1, len(taxa)))))  # some 4 million cells
        for batch in batches:
            for start in range(0, batch.num_rows, at_once):
                part = batch.slice(start, at_once)
                data, at = bytes_of(pc.utf8_upper(part.column("seq")))
                sizes = np.maximum(np.diff(at) - k + 1, 0)
                row = np.repeat(np.arange(part.num_rows), sizes)
                place = at[row] + np.arange(len(row)) - (np.cumsum(sizes) - sizes)[row]
                own = data[place[:, None] + np.arange(k)].reshape(-1, k).view(f"S{k}").ravel()
                found = np.searchsorted(words, own)
                known = words[np.minimum(found, len(words) - 1)] == own if len(words) else np.zeros(len(own), bool)
                found = np.where(known, found, len(weights) - 1)
                some = np.bincount(row, known, part.num_rows) > 0
                score = np.zeros((part.num_rows, len(taxa)))
                full = sizes > 0
                if len(row):
                    score[full] = np.add.reduceat(weights[found], (np.cumsum(sizes) - sizes)[full], axis=0)
                score = score[some] + sizes[some, None] * other
                p = np.exp(score - score.max(axis=1, keepdims=True)) if len(score) else score
                p = p / p.sum(axis=1, keepdims=True)
                i, j = np.nonzero(p > 1e-9)
                seq = part.column("seq").take(pa.array(np.flatnonzero(some)[i]))
                yield pa.RecordBatch.from_arrays([seq, pa.array(taxa[j], pa.string()), pa.array(p[i, j])], ["seq", "taxon", "p"])

    return seqs.select("seq").mapInArrow(run, "seq string, taxon string, p double")


def _gained_by_join(seqs: DataFrame, gains: DataFrame, sums: DataFrame, k: int) -> DataFrame:
    """The same by joins, for models of any size."""
    words = seqs.select("seq", F.explode(S.words(F.col("seq"), k)).alias("word")).groupBy("seq", "word").agg(F.count(F.lit(1)).alias("m"))
    sizes = words.groupBy("seq").agg(F.sum("m").alias("size"))
    gained = words.join(gains, "word").groupBy("seq", "taxon").agg(F.sum(F.col("m") * F.col("gain")).alias("g"))
    scored = gained.join(sizes, "seq").join(sums, "taxon").select("seq", "taxon", (F.col("g") + F.col("size") * F.col("other")).alias("log"))
    own = Window.partitionBy("seq")
    return scored.withColumn("w", F.exp(F.col("log") - F.max("log").over(own))).select("seq", "taxon", (F.col("w") / F.sum("w").over(own)).alias("p"))


def classify(seqs: DataFrame, model: tuple[DataFrame, DataFrame], k: int = K_CLASS, confidence: float = CONFIDENCE, cells: int = MODEL_CELLS) -> DataFrame:
    """``id``, ``taxon`` and ``confidence``: the deepest rank whose probability, summed over taxa, is high enough.

    Sequences that share no word with the references are Unassigned. Equal sequences are scored once. A model of at
    most ``cells`` words by taxa is broadcast; a larger one is joined.
    """
    gains, sums = (stage(x, "model") for x in model)
    n_words, n_taxa = gains.agg(F.count_distinct("word")).first()[0], sums.count()
    unique = seqs.select(F.upper("seq").alias("seq")).distinct()
    by = _gained_by_product if (n_words + 1) * n_taxa <= cells else _gained_by_join
    weight = by(unique, gains, sums, k)
    ranks = F.split("taxon", ";")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(ranks)), lambda i: F.struct(i.alias("depth"), F.array_join(F.slice(ranks, F.lit(1), i), ";").alias("name")))
    by_rank = weight.select("seq", "p", F.explode(prefixes).alias("r")).groupBy("seq", "r.depth", "r.name").agg(F.sum("p").alias("p"))
    best = by_rank.where(F.col("p") >= confidence).groupBy("seq").agg(F.max(F.struct("depth", "p", "name")).alias("b"))
    out = seqs.select("id", F.upper("seq").alias("seq")).join(best, "seq", "left")
    return out.select("id", F.coalesce("b.name", F.lit("Unassigned")).alias("taxon"), F.round(F.coalesce("b.p", F.lit(0.0)), 6).alias("confidence"))


def split_by_placement(table: DataFrame, tips: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of the feature table that a tree has, and those that it hasn't; ``tips`` lists placed features."""
    placed = tips.select("feature_id").distinct()
    return table.join(placed, "feature_id", "left_semi"), table.join(placed, "feature_id", "left_anti")


def closed_reference(reads: DataFrame, references: DataFrame, tips: DataFrame | None = None, identity: float = 0.97) -> tuple[DataFrame, DataFrame]:
    """Counts of reads (``sample_id``, ``read_idx``, ``seq``) by the reference that each is most similar to, and the references' taxa.

    ``references`` have ``id``, ``seq`` and ``taxon``. Reads without a similar reference drop out, and with ``tips`` those
    of references that the tree doesn't have.
    """
    table = map_reads(reads, references.select("id", "seq"), [], identity)
    kept = split_by_placement(table, tips)[0] if tips is not None else table
    return kept, references.join(kept.select(F.col("feature_id").alias("id")).distinct(), "id", "left_semi").select(F.col("id").alias("feature_id"), "taxon")


def place_near(seqs: DataFrame, tips: DataFrame, k: int = K_ORIENT, least: float = 0.5) -> DataFrame:
    """``feature_id`` and the ``tip`` with which each sequence shares most words, if it shares enough of its own.

    A sequence of n words that shares m of them with a tip shares one of any n - m + 1 of them, and one more with each
    further word; only so many look for candidates, words that very many tips have last. A sequence that is a tip itself
    can only be equalled by tips that have all of its words, so one word and the further ones are enough. Words are looked up by their hashes, candidates are compared by the
    words. A stand-in for placement in a tree's likelihood: it attaches to tips only.
    """
    own = stage(seqs.select("id", F.upper("seq").alias("seq")).withColumn("q", F.monotonically_increasing_id()), "place-sequences")
    known = stage(tips.select(F.col("id").alias("tip"), F.upper("seq").alias("seq")).withColumn("t", F.monotonically_increasing_id()), "place-tips")
    hashed = F.transform(F.array_distinct(S.words(F.col("seq"), k)), lambda w: F.xxhash64(w))
    index = known.select("t", F.explode(hashed).alias("word"))
    usual = index.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > USUAL).orderBy(F.desc("n"), "word").limit(MOST_USUAL).orderBy("word").toArrow()
    held = seqs.sparkSession.sparkContext.broadcast(tuple(np.append(usual.column(c).to_numpy(), 0) for c in ("word", "n")))
    exact = known.select(F.xxhash64("seq").alias("h"), F.col("seq").alias("same")).distinct()
    asked = own.join(exact, (F.xxhash64("seq") == F.col("h")) & (F.col("seq") == F.col("same")), "left").select("q", F.col("h").isNotNull().alias("is_tip"), hashed.alias("words"))

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed, times = held.value
        for batch in batches:
            at = batch.column("words").offsets.to_numpy()
            words = batch.column("words").values.to_numpy()[at[0] : at[-1]]
            row = np.repeat(np.arange(batch.num_rows), np.diff(at))
            place = np.searchsorted(listed[:-1], words)
            n = np.where((listed[place] == words) & (place < len(listed) - 1), times[place], 0)
            order = np.lexsort((n, row))
            size = np.diff(at)
            needed = np.where(batch.column("is_tip").to_numpy(zero_copy_only=False), 1, np.minimum(size, size - np.ceil(size * least) + 1)).astype(np.int64)
            spare = np.minimum(SPARE, size - needed)
            first = (np.arange(len(row)) - (at[:-1] - at[0])[row]) < (needed + spare)[row]
            yield pa.RecordBatch.from_arrays([pa.array(batch.column("q").to_numpy()[row[first]]), pa.array(words[order][first]), pa.array(spare[row[first]] + 1)], ["q", "word", "hits"])

    seeds = asked.mapInArrow(rarest, "q long, word long, hits long")
    pairs = seeds.join(index, "word").groupBy("q", "t").agg(F.count(F.lit(1)).alias("n"), F.max("hits").alias("hits")).where("n >= hits").select("q", "t")
    both = pairs.join(own, "q").join(known.withColumnRenamed("seq", "tip_seq"), "t").select("id", "tip", F.array_distinct(S.words(F.col("seq"), k)).alias("words"), F.array_distinct(S.words(F.col("tip_seq"), k)).alias("tip_words"))
    shared = both.select("id", "tip", (F.size(F.array_intersect("words", "tip_words")) / F.size("words")).alias("share")).where(F.col("share") >= least)
    best = shared.groupBy("id").agg(F.min(F.struct((-F.col("share")).alias("less"), "tip")).alias("b"))
    return best.select(F.col("id").alias("feature_id"), "b.tip", F.round(-F.col("b.less"), 6).alias("share"))
