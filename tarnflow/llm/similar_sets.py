"""Links between similar sets of shingles, from rows that share keys: bands of MinHash values, or the neighbourhoods of
fingerprint segments.

Rows that share a key are candidates. The rows whose own key it is are first verified against two of them. Pairs that
this leaves in different components are verified as well: one by one for keys of few rows, and for crowded keys, which
more than ``FULL`` rows share, in salted blocks of bounded size. So no candidate pair is left out, no key's rows are ever
gathered in one task, and pairs inside a component are not made. Whole sets are made for candidates only.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tarnflow.llm.components import components
from tarnflow.llm.hot_keys import joined
from tarnflow.session import BROADCAST_ROWS, drop_staged, stage

SHINGLE, SIMILARITY = 5, 0.8
FULL, LEADERS, BLOCK, CHUNK = 32, 2, 256, 4096


def odd(name: str, n: int) -> np.ndarray:
    """Odd multipliers that hang on their name alone: Python workers import the modules in the order of their tasks."""
    return np.random.default_rng([20240229, *name.encode()]).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


SHINGLE_BY = odd("shingle", SHINGLE)


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: every bit of the result hangs on every bit of the input."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingled(words: np.ndarray) -> np.ndarray:
    """Hashes of the runs of ``SHINGLE`` words, from the words' hashes; none for fewer words."""
    n = max(0, len(words) - SHINGLE + 1)
    return mixed(sum((words[i : i + n] * SHINGLE_BY[i] for i in range(SHINGLE)), np.zeros(n, np.uint64)))


def jaccard(a: Column, b: Column) -> Column:
    common = F.size(F.array_intersect(a, b))
    return common / (F.size(a) + F.size(b) - common)


def roots(
    keyed: DataFrame, sets_of: Callable[[DataFrame], DataFrame], similarity: float, per_band: int, tag: str, full: int = FULL,
    likely: Callable[[Column, Column], Column] | None = None, at_once: int = 0, block: int | None = None,
) -> DataFrame:
    """``node`` and ``root``, the least ``rep`` that links reach, for every row that is linked to a lesser one.

    ``keyed`` has distinct ``rep`` and ``keys`` (array<long>, ``per_band`` distinct keys after another belong to one
    band, the row's own first; bands have keys of their own). Rows that share a key are linked if the Jaccard similarity of their sets is at
    least ``similarity``. ``sets_of`` gives, for a frame of ``rep``, their ``shingles`` (array<long>, distinct);
    ``likely`` tells of two values of the column ``sketch``, which ``keyed`` has then, whether their sets can be similar.
    Up to ``at_once`` links are made components of by one task. Crowded keys are cut in blocks of ``block`` rows.
    """
    known = ["sketch"] if likely else []
    can = (lambda a, b: likely(F.col(a), F.col(b))) if likely else (lambda a, b: F.lit(True))
    rows = keyed.select("rep", *known, F.posexplode("keys").alias("place", "key"))
    buckets = stage(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").withColumn("size", F.col("n")), f"{tag}-buckets")
    held = buckets.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    met = rows.join(F.broadcast(buckets.drop("size")), "key") if held[0] <= BROADCAST_ROWS else joined(rows, buckets, ["key"], held[1]).withColumnRenamed("size", "n")
    met = stage(met, f"{tag}-bands")
    drop_staged(buckets)
    # Rows of one own key are compared with a few of them first: copies of one text, however many, are linked by that.
    own = met.where(F.col("place") % per_band == 0).select("key", "rep", *known)
    leaders = [F.min_by(c, F.xxhash64("rep", F.lit(i))).alias(f"{name}{i}") for i in range(LEADERS) for c, name in (("rep", "l"), ("sketch", "s"))[: 1 + len(known)]]
    lead = stage(own.groupBy("key").agg(*leaders, F.count(F.lit(1)).alias("n")).where("n > 1"), f"{tag}-leaders")
    led = joined(own, lead, ["key"], met.count())
    with_one = [led.where(f"rep <> l{i}").where(can("sketch", f"s{i}")).select(F.least("rep", f"l{i}").alias("u"), F.greatest("rep", f"l{i}").alias("v")) for i in range(LEADERS)]
    pairs = stage(functools.reduce(DataFrame.unionAll, with_one).distinct(), f"{tag}-led")
    found = components(_alike(pairs, sets_of, similarity, tag), f"{tag}-components", at_once)
    drop_staged(lead)

    def closed(more: DataFrame) -> DataFrame:
        links = found.select(F.col("node").alias("u"), F.col("root").alias("v")).unionAll(more.select("u", "v"))
        return components(links, f"{tag}-components", at_once)

    # Other pairs of a key's rows only matter where they are in different components.
    placed = met.where(F.col("n") <= full).join(found, F.col("rep") == F.col("node"), "left").select("key", "rep", *known, F.coalesce("root", "rep").alias("root"))
    side = lambda at: placed.select("key", F.col("rep").alias(at), F.col("root").alias(f"r{at}"), *[F.col(c).alias(f"s{at}") for c in known])
    rest = side("u").join(side("v"), "key").where("u < v and ru <> rv").where(can("su", "sv")).select("u", "v").distinct().join(pairs, ["u", "v"], "left_anti")
    found = closed(_alike(rest, sets_of, similarity, tag))
    drop_staged(pairs)
    crowded = met.where(F.col("n") > full)
    # One band first: its links leave the other bands little to verify.
    for part in (F.col("place") < per_band, F.col("place") >= per_band) if crowded.head(1) else ():
        found = closed(_rest(crowded.where(part).select("key", "n", "rep"), found, sets_of, similarity, tag, block or BLOCK))
    drop_staged(met)
    return found


def _alike(pairs: DataFrame, sets_of: Callable[[DataFrame], DataFrame], similarity: float, tag: str) -> DataFrame:
    """The ``pairs`` ``u``, ``v`` whose sets have the similarity, staged."""
    pairs = stage(pairs, f"{tag}-pairs")
    sets = _sets(pairs.select(F.col("u").alias("rep")).unionAll(pairs.select(F.col("v").alias("rep"))), sets_of, tag)
    left, right = sets.select(F.col("rep").alias("u"), F.col("shingles").alias("a")), sets.select(F.col("rep").alias("v"), F.col("shingles").alias("b"))
    made = stage(pairs.join(left, "u").join(right, "v").where(jaccard(F.col("a"), F.col("b")) >= similarity).select("u", "v"), f"{tag}-alike")
    drop_staged(pairs)
    drop_staged(sets)
    return made


def _sets(reps: DataFrame, sets_of: Callable[[DataFrame], DataFrame], tag: str) -> DataFrame:
    """The sets of ``rep``, one row each, staged; they are only moved to drop repeats where there are any."""
    asked = stage(reps.distinct(), f"{tag}-asked")
    sets = stage(sets_of(asked), f"{tag}-sets")
    if sets.count() > asked.count():
        once = stage(sets.dropDuplicates(["rep"]), f"{tag}-sets")
        drop_staged(sets)
        sets = once
    drop_staged(asked)
    return sets


def _linked(block: pd.DataFrame, similarity: float) -> pd.DataFrame:
    """Links ``u``, ``v`` of roots that connect what the similar pairs between the two blocks connect."""
    left, right = (block[block["block"] == block[side].iat[0]] for side in ("i", "j"))
    if left.empty or right.empty:  # salts may leave a block without rows
        return pd.DataFrame({"u": [], "v": []}, dtype="int64")
    roots, codes = np.unique(np.concatenate([left["root"], right["root"]]), return_inverse=True)
    sets = [*left["shingles"], *right["shingles"]]
    sizes = np.array([len(x) for x in sets])
    _, token, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner, shared = np.repeat(np.arange(len(sets)), sizes), times[token] > 1
    _, token = np.unique(token[shared], return_inverse=True)
    order = np.argsort(token, kind="stable")
    token, owner, n = token[order], owner[shared][order], len(left)
    common = np.zeros((n, len(right)), np.float32)
    for start in range(0, len(token) and int(token[-1]) + 1, CHUNK):
        a, b = np.searchsorted(token, [start, start + CHUNK])
        has = np.zeros((len(sets), CHUNK), np.float32)
        has[owner[a:b], token[a:b] - start] = 1
        common += has[:n] @ has[n:].T
    common = common.astype(np.float64)
    alike = common / (sizes[:n, None] + sizes[None, n:] - common) >= similarity
    label, was = np.arange(len(roots)), None
    while was is None or (label != was).any():
        was, own = label.copy(), label[codes]
        own = np.concatenate([np.where(alike, own[None, n:], own[:n, None]).min(axis=1), np.where(alike, own[:n, None], own[None, n:]).min(axis=0)])
        np.minimum.at(label, codes, own)
    moved = label != np.arange(len(roots))
    return pd.DataFrame({"u": roots[moved], "v": roots[label[moved]]})


def _rest(crowded: DataFrame, found: DataFrame, sets_of: Callable[[DataFrame], DataFrame], similarity: float, tag: str, block: int) -> DataFrame:
    """Links ``u``, ``v`` of roots by the pairs of crowded keys that are in different components so far.

    ``crowded`` has ``key``, ``rep`` and ``n``, the key's number of rows. The rows of a key's most frequent component are
    only compared with the others.
    """
    key = ["key"]
    rows = stage(crowded.join(found, F.col("rep") == F.col("node"), "left").select(*key, "n", "rep", F.coalesce("root", "rep").alias("root")), f"{tag}-crowded")
    one, more = rows.where(F.col("n") <= block), rows.where(F.col("n") > block)
    # A key of one block's rows is compared at once, each row in one place: nothing of the key is joined to its rows.
    mixed_keys = one.groupBy(*key).agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    zero = F.lit(0).cast("long")
    one = one.join(mixed_keys, key, "left_semi").select(*key, "rep", "root", F.lit(False).alias("is_main"), (zero + 1).alias("others"), zero.alias("mains"))
    # A larger key gets the numbers of blocks of its most frequent component and of the others, by one join.
    held = more.groupBy(*key, "n", "root").agg(F.count(F.lit(1)).alias("c")).groupBy(*key, "n")
    most = held.agg(F.max_by("root", F.struct("c", "root")).alias("main"), F.max("c").alias("c"), F.count(F.lit(1)).alias("roots")).where("roots > 1")
    most = most.select(*key, "main", F.ceil((F.col("n") - F.col("c")) / block).alias("others"), F.ceil(F.col("c") / block).alias("mains"))
    more = more.join(most, key).select(*key, "rep", "root", (F.col("root") == F.col("main")).alias("is_main"), "others", "mains")
    left = stage(one.unionByName(more), f"{tag}-open")
    salt = F.pmod(F.xxhash64("rep"), F.when(F.col("is_main"), F.col("mains")).otherwise(F.col("others")))
    met = F.col("others") + F.when(F.col("is_main"), 0).otherwise(F.col("mains"))
    dealt = left.where("mains > 0").withColumn("block", salt + F.when(F.col("is_main"), F.col("others")).otherwise(0))
    dealt = dealt.withColumn("with", F.explode(F.sequence(zero, met - 1))).select(*key, F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "block", "rep", "root")
    dealt = dealt.unionByName(left.where("mains = 0").select(*key, zero.alias("i"), zero.alias("j"), zero.alias("block"), "rep", "root"))
    sets = _sets(left.select("rep"), sets_of, tag)
    whole = dealt.join(sets, "rep").select(*key, "i", "j", "block", "root", "shingles")

    def linked(block: pd.DataFrame) -> pd.DataFrame:
        return _linked(block, similarity)

    made = stage(whole.groupBy(*key, "i", "j").applyInPandas(linked, "u long, v long"), f"{tag}-rest")
    for old in (rows, left, sets):
        drop_staged(old)
    return made
