"""SimHash near-duplicates by multi-index hashing of the fingerprints.

A fingerprint has two segments of 32 bits. Fingerprints at distance 2 or less agree in one segment but
for one bit at most. So each segment has a table keyed by its value, and each fingerprint probes it with
the segment values at distance 0 and 1; of two values at distance 1 only the one with the unset bit
probes. Matches are verified over all 64 bits. Only distinct fingerprints take part.

A segment value that more than ``FULL`` distinct fingerprints share would give candidates with the square
of their number. The fingerprints that meet such a table entry are instead indexed by whole values: each
lists the 65 values within distance 1, and two of them are linked exactly if they list a common value
(those within distance 2 always do). A value is listed by 65 fingerprints at most, all of them within
distance 2 of each other, so it is enough to link them to the least.

A distance of 2 only finds copies with very few edits. De-duplication at a given Jaccard similarity therefore has a wider
radius: ``near_dedup`` looks up six segments of 12 bits by balls of radius 1 on either side, so segments within two bits
meet, and verifies candidates exactly.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tarnflow.llm import similar_sets
from tarnflow.llm.batches import map_slices
from tarnflow.llm.components import components
from tarnflow.llm.similar_sets import SHINGLE_BY, SIMILARITY, mixed, odd, shingled
from tarnflow.llm.survivors import surviving
from tarnflow.session import BROADCAST_ROWS, broadcast_if_small, stage

SHINGLE, SEED, DISTANCE, FULL = 3, 42, 2, 64
SEGMENTS, BITS = 6, 12  # neighbours share some bits; of the fingerprint over distinct five-word shingles
NEAR_FULL, NEAR_BLOCK = 16, 1024  # in ``near_dedup``: rows of a key that are all paired, rows of a block of a larger key's
ORDER_BY, ORDER_ADD = odd("order by", SEGMENTS), odd("order add", SEGMENTS)
#: For each byte value, its bits in the eight bytes of a word, so that sums of up to 255 bytes don't overflow.
SPREAD = np.array([sum(((b >> i) & 1) << 8 * i for i in range(8)) for b in range(256)], np.uint64)


def fingerprint(text: bytes, hashed=xxhash.xxh64_intdigest) -> int:
    """The signed 64-bit fingerprint of a UTF-8 text; 0 if it has no words."""
    words = text.lower().split()  # bytes: A-Z only, and the six ASCII white space characters
    if not words:
        return 0
    a, b, c = words, words[1:], words[2:]
    shingles = [x + b" " + y + b" " + z for x, y, z in zip(a, b, c, strict=False)] if c else [b" ".join(words)]
    found = np.array([hashed(s, SEED) for s in shingles], np.uint64)
    lanes = SPREAD[found.view(np.uint8).reshape(-1, 8)]
    groups = np.add.reduceat(lanes, np.arange(0, len(lanes), 255), axis=0)
    ones = groups.view(np.uint8).reshape(len(groups), 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(found), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns of every row with the signed ``fp`` of its whole text; null counts as empty."""

    def make():
        def apply(part: pa.RecordBatch) -> list:
            return [[fingerprint(t or b"") for t in part.column(text).cast(pa.binary()).to_pylist()]]

        return apply

    return map_slices(docs, keep, text, [T.StructField("fp", T.LongType())], make)


def _segments(fp: Column) -> Column:
    return F.array(F.shiftrightunsigned(fp, 32), fp.bitwiseAND(F.lit(0xFFFFFFFF)))


def links(fps: DataFrame, full: int = FULL) -> DataFrame:
    """Edges ``u``, ``v`` between the ``rep`` of fingerprints within the distance; ``fps`` has distinct ``fp``.

    Every two linked fingerprints are connected by the edges, if not always by an edge of their own.
    """
    table = fps.select("fp", "rep", F.posexplode(_segments(F.col("fp"))).alias("segment", "value"))
    crowded = stage(table.groupBy("segment", "value").count().where(F.col("count") > full).select("segment", "value"), "simhash-crowded")
    bits = F.sequence(F.lit(0), F.lit(31))
    near = F.transform(
        F.filter(bits, lambda i: F.col("value").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), i)) == 0),
        lambda i: F.col("value").bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)),
    )
    probes = table.select("fp", "rep", "segment", F.explode(F.concat(F.array("value"), near)).alias("value"))
    key = ["segment", "value"]
    hot = bool(crowded.head(1))
    sparse_table, sparse_probes = (x.join(crowded, key, "left_anti") if hot else x for x in (table, probes))
    right = sparse_table.select(*key, F.col("fp").alias("fp2"), F.col("rep").alias("rep2"))
    found = sparse_probes.join(right, key).where((F.col("fp") != F.col("fp2")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("fp2"))) <= DISTANCE))
    edges = found.select(F.col("rep").alias("u"), F.col("rep2").alias("v"))
    if hot:
        meet = probes.join(crowded, key, "left_semi").select("fp", "rep").distinct()
        flips = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)))
        listed = meet.select("fp", "rep", F.explode(F.concat(F.array("fp"), flips)).alias("value"))
        least = F.min(F.struct("rep", "fp")).over(Window.partitionBy("value"))
        star = listed.withColumn("w", least).where((F.col("rep") != F.col("w.rep")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("w.fp"))) <= DISTANCE))
        edges = edges.unionAll(star.select(F.col("rep").alias("u"), F.col("w.rep").alias("v")))
    return edges


def _grouped(found: DataFrame, full: int) -> DataFrame:
    """``found`` (``id``, ``fp`` and more) with ``component``; rows of one fingerprint share it."""
    fps = stage(found.groupBy("fp").agg(F.min("id").alias("rep")), "simhash-distinct")
    roots = components(links(fps.where("rep is not null"), full), "simhash-components")
    classes = fps.join(roots, fps["rep"] == roots["node"], "left").select("fp", F.coalesce("root", "rep").alias("component"))
    return found.join(classes, "fp")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", full: int = FULL) -> DataFrame:
    """The id, ``fingerprint`` (16 lower-case hexadecimal digits) and ``component_id`` of every row.

    A text's A-Z are lower-cased, words end at ASCII white space, and shingles of three words with repeats
    are hashed; a shorter text is one shingle, a text without words (null, empty) has fingerprint zero and is
    linked like any other. ``component_id`` is the least id that links reach, the row's own included; rows
    with a null id have the component of their fingerprint, null if no row with an id shares it. Very long texts are
    fingerprinted whole; a bit that just half of the hashes have set is 0. Repeated
    rows repeat their result, an empty table has an empty one, and other columns are not read.
    """
    found = stage(fingerprints(docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")), ["id"]), "simhash-fingerprints")
    return _grouped(found, full).select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def _kept(docs: DataFrame, id_col: str, key: Column, grouped: DataFrame) -> DataFrame:
    """Of each ``component`` of ``grouped`` (``id``, ``key``, ``r``) the row with the least id, with all columns of ``docs``."""
    best = grouped.groupBy("component").agg(F.min(F.struct(F.coalesce("id", F.lit(2**63 - 1)).alias("id"), "r")).alias("w"))
    made = grouped.join(best, grouped["component"].eqNullSafe(best["component"])).select("id", "key", (F.col("r") == F.col("w.r")).alias("kept"))
    return surviving(docs, id_col, key, stage(made, "simhash-decisions"))


def _source(docs: DataFrame, id_col: str, text: str) -> tuple[DataFrame, Column]:
    key = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    return docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"), key.alias("key"), F.monotonically_increasing_id().alias("r")), key


def fingerprint_dedup(docs: DataFrame, id_col: str = "doc_id", text: str = "text", full: int = FULL) -> DataFrame:
    """The rows of ``docs`` that stay, with all columns: of each component of ``near_duplicates`` the row with the least id."""
    source, key = _source(docs, id_col, text)
    return _kept(docs, id_col, key, _grouped(stage(fingerprints(source, ["id", "key", "r"]), "simhash-fingerprints"), full))


def _hashed_words(text: bytes) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w) for w in text.lower().split()], np.uint64)


def _shingle_set(words: np.ndarray) -> np.ndarray:
    """Distinct shingles; a shorter text is one shingle, a text without words has none."""
    if not len(words):
        return words
    found = shingled(words)
    return np.unique(found) if len(found) else mixed(np.add.reduce(words * SHINGLE_BY[: len(words)], keepdims=True))


def neighbourhoods(words: np.ndarray) -> tuple[int, int, np.ndarray]:
    """The fingerprint, the number of distinct shingles and the keys of a text: for each segment of its fingerprint, the values within one bit of it, with the segment's anchor.

    The fingerprint is made of the distinct shingles. A segment's anchor is the shingle that comes first in the
    segment's own order: a segment alone has too few values to keep unrelated documents apart, whatever their number.
    """
    found = _shingle_set(words)
    if not len(found):
        return 0, 0, np.empty(0, np.int64)
    lanes = SPREAD[found.view(np.uint8).reshape(-1, 8)]
    groups = np.add.reduceat(lanes, np.arange(0, len(lanes), 255), axis=0)
    ones = groups.view(np.uint8).reshape(len(groups), 64).sum(axis=0, dtype=np.int64)
    value = np.packbits(ones * 2 > len(found), bitorder="little").view("<u8")[0]
    shifts = np.linspace(0, 64 - BITS, SEGMENTS).astype(np.uint64)
    segments = (value >> shifts) & np.uint64((1 << BITS) - 1)
    balls = segments[:, None] ^ np.concatenate([[0], 1 << np.arange(BITS)]).astype(np.uint64)
    anchors = np.array([mixed(found * by + add).min() for by, add in zip(ORDER_BY, ORDER_ADD, strict=True)])
    return int(value.view(np.int64)), len(found), mixed(anchors[:, None] + mixed(balls + np.uint64(1))).view(np.int64).ravel()


def _most_distance(similarity: float) -> int:
    """Differing bits that fingerprints of similar sets have at most, but for one pair in some 100,000 at the bound."""
    bit = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return math.ceil(64 * bit + 4.5 * math.sqrt(64 * bit * (1 - bit)))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, full: int = NEAR_FULL) -> DataFrame:
    """The rows of ``docs`` that stay, with all columns: of each group of near-duplicates the row with the least id.

    Documents are linked whose sets of five-word shingles (A-Z lower-cased, words end at ASCII white space) have a Jaccard
    similarity of ``similarity`` or more. Two candidates have segments of their fingerprints within two bits and one
    anchor; candidates are verified by the distance of their whole fingerprints and the sizes of their sets, then on their whole sets, and groups are
    the components of the links. At a similarity of 0.8 a pair becomes a candidate with probability 0.995, more above.

    Texts of the same words are one group, texts without words (null, empty) are too; a text of fewer than five
    words is one shingle. Rows with a null id rank last in their group, repeated rows are in one group, of which one
    row stays. Very long texts are read whole. Columns of ``docs`` may have any names; an empty table gives an empty one.
    """
    source, key = _source(docs, id_col, text)

    def make():
        def apply(part: pa.RecordBatch) -> list:
            words = [_hashed_words(t or b"") for t in part.column("text").cast(pa.binary()).to_pylist()]
            digests = [xxhash.xxh3_128_intdigest(w.tobytes()) for w in words]
            made = [neighbourhoods(w) for w in words]
            return [[(d >> 64) - (1 << 63) for d in digests], [(d & (1 << 64) - 1) - (1 << 63) for d in digests], *map(list, zip(*made, strict=True))]

        return apply

    def make_sets():
        return lambda part: [[_shingle_set(_hashed_words(t or b"")).view(np.int64) for t in part.column("text").cast(pa.binary()).to_pylist()]]

    fields = [T.StructField("d1", T.LongType()), T.StructField("d2", T.LongType()), T.StructField("fp", T.LongType()), T.StructField("size", T.IntegerType()), T.StructField("keys", T.ArrayType(T.LongType()))]
    found = stage(map_slices(source, ["id", "key", "r"], "text", fields, make), "near-keys")
    first = F.min(F.struct("r", "id", "key", "fp")).alias("first")
    nodes = stage(found.groupBy("d1", "d2").agg(first).select("d1", "d2", F.col("first.r").alias("rep"), "first.id", "first.key", "first.fp"), "near-nodes")
    keyed = found.select(F.col("r").alias("rep"), "keys", F.struct("fp", "size").alias("sketch")).join(nodes.select("rep"), "rep", "left_semi")

    def sets_of(asked: DataFrame) -> DataFrame:
        wanted = stage(nodes.join(asked, "rep", "left_semi").select("rep", F.col("id").alias("own_id"), F.col("key").alias("own_key")), "near-asked")
        rows = source.drop("r").join(broadcast_if_small(wanted), F.col("id").eqNullSafe(F.col("own_id")) & (F.col("key") == F.col("own_key")))
        return map_slices(rows, ["rep"], "text", [T.StructField("shingles", T.ArrayType(T.LongType()))], make_sets)

    def likely(a: Column, b: Column) -> Column:
        near = F.bit_count(a["fp"].bitwiseXOR(b["fp"])) <= _most_distance(similarity)
        return near & (F.least(a["size"], b["size"]) >= similarity * F.greatest(a["size"], b["size"]))

    roots = similar_sets.roots(keyed, sets_of, similarity, BITS + 1, "near", full, likely, BROADCAST_ROWS, NEAR_BLOCK)
    classes = nodes.join(roots, F.col("rep") == F.col("node"), "left").select("d1", "d2", F.coalesce("root", "rep").alias("component"))
    return _kept(docs, id_col, key, found.drop("keys", "fp", "size").join(classes, ["d1", "d2"]))
