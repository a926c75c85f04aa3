"""Passages that repeat across documents: paragraph MinHash with banding, and anchored windows inside paragraphs.

Paragraphs are the lines of at least ``MIN_WORDS`` words. Their five-word shingles are min-hashed; bands
of three values bring paragraphs of Jaccard similarity 0.8 together with probability 0.997. Colliding
paragraphs are verified on their whole shingle sets (64-bit hashes), made for them in a second pass, and links
are closed to components. Equal paragraphs are one node, so copies are never paired.

A passage may also stand inside longer paragraphs that differ around it, where paragraphs don't collide. Therefore
each text's words are winnowed (Schleimer, Wilkerson and Aiken, 2003): of every 20 neighbouring shingles the one of
least hash is an anchor, and the 32 words from each anchor are a window. A passage of 51 words or more holds a whole
window wherever it stands, with the same anchor. Windows are equal if two independent 64-bit hashes of their words are.
Where stretches of shared windows are short, a second pass looks at every run of 51 words in and around them, and only
such runs count that another document has as well.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from tarnflow.llm import similar_sets
from tarnflow.llm.batches import release, slices, texts_of
from tarnflow.llm.hot_keys import joined
from tarnflow.llm.similar_sets import FULL, SHINGLE, SIMILARITY, mixed, odd, shingled
from tarnflow.session import BROADCAST_ROWS, broadcast_if_small, stage

#: Shorter lines aren't paragraphs of their own; repeated ones are found as parts of a run.
MIN_WORDS = 40
BANDS, IN_BAND = 8, 3
WINNOW, WINDOW = 20, 32
RUN = WINNOW + WINDOW - 1  # words of a run that surely holds a window
PERMUTE, SHIFT, BAND_BY = odd("permute", BANDS * IN_BAND), odd("shift", BANDS * IN_BAND), odd("band", IN_BAND)
WINDOW_BY, RUN_BY = odd("window", 2 * WINDOW).reshape(2, WINDOW), odd("run", 2 * RUN).reshape(2, RUN)
_SCHEMA = "kind string, uid long, doc long, `from` int, `to` int, d1 long, d2 long, bands array<long>"


def words_of(text: str) -> list[list[bytes]]:
    """The lower-cased words of each line."""
    return [line.split() for line in text.lower().encode().split(b"\n")]


def run_hashes(words: np.ndarray, at: np.ndarray, by: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of the run of words from each place in ``at``."""
    hashes = np.zeros((2, len(at)), np.uint64)
    for k in range(by.shape[1]):
        hashes += words[at + k] * by[:, k : k + 1]
    return mixed(hashes[0]).view(np.int64), mixed(hashes[1]).view(np.int64)


class Units:
    """Paragraphs and windows of some texts, as columns."""

    def __init__(self, texts: list[str]):
        lines = [words_of(t) for t in texts]
        per_line = [len(line) for doc in lines for line in doc]
        self.line_doc = np.repeat(np.arange(len(texts)), [len(doc) for doc in lines])
        self.line_to = np.cumsum(per_line, dtype=np.int64) if per_line else np.empty(0, np.int64)
        self.line_from = self.line_to - np.array(per_line, np.int64)
        per_doc = np.bincount(self.line_doc, per_line, len(texts)).astype(np.int64)
        self.doc_to = np.cumsum(per_doc)
        self.doc_from = self.doc_to - per_doc
        hashed = xxhash.xxh64_intdigest
        self.words = np.array([hashed(w) for doc in lines for line in doc for w in line], np.uint64)
        self.shingles = shingled(self.words)

    def paragraphs(self) -> dict:
        which = np.flatnonzero(self.line_to - self.line_from >= MIN_WORDS)
        a, b = self.line_from[which], self.line_to[which]
        digests = [xxhash.xxh3_128_intdigest(self.words[i:j].tobytes()) for i, j in zip(a, b, strict=True)]
        bounds = np.stack([a, b - SHINGLE + 1], axis=1).ravel()
        bounds = bounds[:-1] if len(bounds) and bounds[-1] == len(self.shingles) else bounds
        bands = np.zeros((len(which), BANDS), np.uint64)
        for band in range(BANDS if len(which) else 0):
            for k in range(IN_BAND):
                p = band * IN_BAND + k
                least = np.minimum.reduceat(mixed(self.shingles * PERMUTE[p] + SHIFT[p]), bounds)[::2]
                bands[:, band] += least * BAND_BY[k]
        return {"doc": self.line_doc[which], "from": a, "to": b, "d1": [(d >> 64) - (1 << 63) for d in digests], "d2": [(d & (1 << 64) - 1) - (1 << 63) for d in digests], "bands": mixed(bands).view(np.int64)}

    def windows(self) -> dict:
        """The window at every anchor."""
        if len(self.shingles) < WINNOW:
            at = np.empty(0, np.int64)
        else:
            view = np.lib.stride_tricks.sliding_window_view(self.shingles, WINNOW)
            at = np.unique(view.argmin(axis=1) + np.arange(len(view)))
        doc = np.searchsorted(self.doc_to, at, "right")
        whole = at + WINDOW <= self.doc_to[doc] if len(at) else np.empty(0, bool)
        at, doc = at[whole], doc[whole]
        d1, d2 = run_hashes(self.words, at, WINDOW_BY)
        return {"doc": doc, "from": at, "to": at + WINDOW, "d1": d1, "d2": d2}


def units(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """All paragraphs and windows with ids of their own; word positions count from the document's first word."""
    fields = [pa.field("kind", pa.string()), *(pa.field(n, t) for n, t in (("uid", pa.int64()), ("doc", pa.int64()), ("from", pa.int32()), ("to", pa.int32()), ("d1", pa.int64()), ("d2", pa.int64())))]
    arrow = pa.schema([*fields, pa.field("bands", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        release()
        next_id = TaskContext.get().partitionId() << 40
        for part in slices(batches, "text"):
            ids = part.column("doc")
            made = Units(texts_of(part, "text"))
            for kind, found in (("paragraph", made.paragraphs()), ("window", made.windows())):
                n = len(found["doc"])
                if not n:
                    continue
                start = made.doc_from[found["doc"]]
                bands = pa.array(list(found["bands"]), arrow.field(7).type) if kind == "paragraph" else pa.nulls(n, arrow.field(7).type)
                columns = [pa.array([kind] * n), pa.array(np.arange(next_id, next_id + n)), ids.take(pa.array(found["doc"])).cast(pa.int64())]
                columns += [pa.array((found[x] - start).astype(np.int32)) for x in ("from", "to")]
                columns += [pa.array(found[x], pa.int64()) for x in ("d1", "d2")]
                next_id += n
                yield pa.RecordBatch.from_arrays([*columns, bands], schema=arrow)

    return docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text).alias("text")).mapInArrow(run, _SCHEMA)


def _with_asked(docs: DataFrame, asked: DataFrame, id_col: str, text: str) -> DataFrame:
    """``doc``, ``text`` and the list ``asked`` of all documents that ``asked`` (``doc`` and more) names."""
    items = stage(asked, "repeats-asked")
    by_doc = items.groupBy("doc").agg(F.collect_list(F.struct(*[c for c in items.columns if c != "doc"])).alias("asked"))
    by_doc = F.broadcast(by_doc) if items.count() <= BROADCAST_ROWS else by_doc
    return docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text).alias("text")).join(by_doc, "doc")


def paragraph_sets(docs: DataFrame, lines: DataFrame, id_col: str, text: str) -> DataFrame:
    """``rep`` and ``shingles`` (distinct 64-bit hashes) of the paragraphs ``lines`` (``rep``, ``doc``, ``from``, ``to``, digests)."""
    schema = pa.schema([("rep", pa.int64()), ("shingles", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for part in slices(batches, "text"):
            reps, sets = [], []
            for t, asked in zip(texts_of(part, "text"), part.column("asked").to_pylist(), strict=True):
                words = np.array([xxhash.xxh64_intdigest(w) for w in t.lower().encode().split()], np.uint64)
                shingles = shingled(words)
                for x in asked:
                    a, b = x["from"], x["to"]
                    digest = xxhash.xxh3_128_intdigest(words[a:b].tobytes())
                    if ((digest >> 64) - (1 << 63), (digest & (1 << 64) - 1) - (1 << 63)) == (x["d1"], x["d2"]):  # ids may repeat
                        reps.append(x["rep"])
                        sets.append(np.unique(shingles[a : b - SHINGLE + 1]).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(reps, pa.int64()), pa.array(sets, schema.field(1).type)], schema=schema)

    return _with_asked(docs, lines.select("doc", "rep", "from", "to", "d1", "d2"), id_col, text).mapInArrow(run, "rep long, shingles array<long>")


def runs_in(docs: DataFrame, zones: DataFrame, id_col: str, text: str) -> DataFrame:
    """Every run of ``RUN`` words in the ``zones`` (``doc``, ``from``, ``to``): ``doc``, ``from`` and its digest."""
    schema = pa.schema([("doc", pa.int64()), ("from", pa.int32()), ("d1", pa.int64()), ("d2", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for part in slices(batches, "text"):
            for doc, t, asked in zip(part.column("doc").to_pylist(), texts_of(part, "text"), part.column("asked").to_pylist(), strict=True):
                words = np.array([xxhash.xxh64_intdigest(w) for w in t.lower().encode().split()], np.uint64)
                spans = [np.arange(max(0, x["from"]), min(len(words), x["to"]) - RUN + 1) for x in asked]
                at = np.unique(np.concatenate(spans)).astype(np.int64)
                d1, d2 = run_hashes(words, at, RUN_BY)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), doc)), pa.array(at.astype(np.int32)), pa.array(d1), pa.array(d2)], schema=schema)

    return _with_asked(docs, zones, id_col, text).mapInArrow(run, "doc long, `from` int, d1 long, d2 long")


def _islands(hits: DataFrame, own: list[str]) -> DataFrame:
    """``hits`` (``from``, ``to``) with ``island``: stretches without a gap among the rows that agree in ``own``, a document's."""
    order = Window.partitionBy(*own).orderBy("from", "to")
    reach = F.max("to").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return hits.withColumn("new", F.coalesce(F.col("from") > reach, F.lit(True)).cast("int")).withColumn("island", F.sum("new").over(order)).drop("new")


def _shared(runs: DataFrame, words: int) -> DataFrame:
    """The runs that several documents have, with ``kept``; each digest is looked up by its least and largest document."""
    digest = ["d1", "d2"]
    found = runs.groupBy(*digest).agg(F.min("doc").alias("low"), F.max("doc").alias("high"), F.count(F.lit(1)).alias("n"))
    shared = stage(found.where("low < high").drop("high"), "repeats-shared")
    return joined(runs, shared, digest, runs.count()).select("doc", "from", (F.col("from") + words).alias("to"), *digest, (F.col("doc") == F.col("low")).alias("kept"))


def repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, full: int = FULL) -> DataFrame:
    """One row per repeated passage: the id, ``kind``, ``from_word``, ``to_word``, ``class_id`` and ``kept``.

    ``kind`` paragraph: a line of at least 40 words in a component of such lines, linked at the similarity,
    that reaches another document. ``kind`` window: a longest stretch of words covered by runs that other documents
    have as well, 51 words or longer each; where shared windows of 32 words join up to 70 words or more, by these.
    A passage that stands in a document several times is listed each time. Words count from 0 over the whole
    lower-cased text, however long, and the end is exclusive.
    ``class_id`` is the least paragraph of the component, or the least hash of the stretch's runs. ``kept`` is true in
    the document with the least id of the class, whose passage stays; ties can't arise, as an id that repeats is one
    document. Null texts are empty; rows with a null id have no passages. A passage that only its own document repeats
    is not reported. No other column is read; an empty table gives no rows.
    """
    known_ids = docs.where(F.col(id_col).isNotNull())
    made = stage(units(known_ids, id_col, text), "repeats-units", by="kind")
    span = [F.min("doc").alias("low"), F.max("doc").alias("high")]
    digest = ["d1", "d2"]

    lines = made.where("kind = 'paragraph'")
    place = F.min(F.struct("uid", "doc", "from", "to")).alias("at")
    nodes = stage(lines.groupBy(*digest).agg(place, *span, F.count(F.lit(1)).alias("n")).select(F.col("at.uid").alias("rep"), "at.doc", "at.from", "at.to", *digest, "low", "high", "n"), "repeats-nodes")
    banded = lines.select(F.col("uid").alias("rep"), F.col("bands").alias("keys")).join(nodes.select("rep"), "rep", "left_semi")

    def sets_of(asked: DataFrame) -> DataFrame:
        return paragraph_sets(known_ids, nodes.join(asked, "rep", "left_semi"), id_col, text)

    roots = similar_sets.roots(banded, sets_of, similarity, 1, "repeats", full)
    named = nodes.join(roots, F.col("rep") == F.col("node"), "left").select(*digest, F.coalesce("root", "rep").alias("class"), "low", "high", "n")
    classes = named.groupBy("class").agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low < high").select("class", F.col("low").alias("keeper"))
    known = stage(named.select(*digest, "n", "class").join(classes, "class"), "repeats-known")
    paragraphs = joined(lines.select("doc", "from", "to", *digest), known, digest, lines.count())
    out = paragraphs.select(F.col("doc").alias(id_col), F.lit("paragraph").alias("kind"), F.col("from").alias("from_word"), F.col("to").alias("to_word"), F.col("class").alias("class_id"), (F.col("doc") == F.col("keeper")).alias("kept"))

    hits = stage(_islands(_shared(made.where("kind = 'window'").select("doc", "from", *digest), WINDOW), ["doc"]), "repeats-hits")
    islands = hits.groupBy("doc", "island").agg(F.min("from").alias("first"), F.max("to").alias("end"))
    short = F.col("end") - F.col("first") < RUN + WINNOW - 1
    # A window of a short stretch is looked at in all documents that have it, whatever stands around it there.
    asked = stage(hits.join(islands.where(short).select("doc", "island"), ["doc", "island"], "left_semi").select(*digest).distinct(), "repeats-short")
    near = hits.join(broadcast_if_small(asked), digest, "left_semi").select("doc", (F.col("from") - WINNOW).alias("from"), (F.col("to") + WINNOW).alias("to"))
    zones = _islands(near, ["doc"]).groupBy("doc", "island").agg(F.min("from").alias("from"), F.max("to").alias("to")).drop("island")
    runs = stage(runs_in(known_ids, zones, id_col, text), "repeats-runs")
    long = hits.join(islands.where(~short).select("doc", "island"), ["doc", "island"], "left_semi").drop("island")
    own = ["doc", "kept"]
    merged = _islands(long.unionByName(_shared(runs, RUN)), own).groupBy(*own, "island").agg(F.min("from").alias("from_word"), F.max("to").alias("to_word"), F.min("d1").alias("class_id"))
    return out.unionByName(merged.select(F.col("doc").alias(id_col), F.lit("window").alias("kind"), "from_word", "to_word", "class_id", "kept"))


def without_repeats(docs: DataFrame, passages: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with the passages of ``repeats`` that aren't kept cut out of the text.

    Words between cuts keep their line breaks as single ones and their spaces as single spaces; texts without
    a cut stay as they are, null too. Rows that repeat an id are each cut at the same words. Columns of ``docs`` may
    have any names; an empty table gives an empty result.
    """
    cuts = passages.where("not kept").groupBy(F.col(id_col).alias("id")).agg(F.sort_array(F.collect_list(F.array("from_word", "to_word"))).alias("cuts"))
    gone = F.udf(cut_words, "string", useArrow=True)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    joined = rows.join(cuts, F.col(f"row.`{id_col}`") == F.col("id"), "left")
    new = F.when(F.col("cuts").isNull(), F.col(f"row.`{text}`")).otherwise(gone(F.col(f"row.`{text}`"), "cuts"))
    return joined.select(*[(new if c == text else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def cut_words(text: str | None, cuts) -> str | None:
    """The text without the words in the (from, to) ranges."""
    if text is None or cuts is None:
        return text
    lines = [line.encode().split() for line in text.split("\n")]
    stays = np.ones(sum(map(len, lines)), bool)
    for first, end in cuts:
        stays[first:end] = False
    out, at = [], 0
    for line, words in zip(text.split("\n"), lines, strict=True):
        own = stays[at : at + len(words)]
        at += len(words)
        if own.all():
            out.append(line)
        elif own.any():
            out.append(b" ".join(w for w, s in zip(words, own.tolist(), strict=True) if s).decode())
    return "\n".join(out)
