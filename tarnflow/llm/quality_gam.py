"""Quality classifier: a generalised additive model with pairwise interactions (Lou et al., 2013).

Shallow trees are boosted in cycles, one feature at a time; each adds its leaves to the feature's lookup
table over bins, so the model ends as one table a feature and one two-dimensional table for each of the
best pairs. Scoring looks up and adds. Features are counted over whole texts.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tarnflow.llm.batches import map_slices, release, slices

#: Rows that a model is fitted on at most, picked by a hash of the id among all labelled rows that may be used.
SAMPLE = 20_000
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3
NAMES = (
    "log_bytes", "log_words", "word_length", "line_words", "upper", "digit", "space", "beyond_ascii", "punctuation", "symbol",
    "symbol_words", "distinct_words", "repeated_neighbours", "distinct_lines", "sentence_ends", "longest_word",
)


def _table(chars: str) -> np.ndarray:
    return np.isin(np.arange(256), list(chars.encode()))


_UPPER, _DIGIT = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _table("0123456789")
_SPACE, _ENDS = _table(" \t\n\r\x0b\x0c"), _table(".?")
_POINTS, _SYMBOLS = _table(",;:'\"-()!"), _table("#$%&*+/<=>@[\\]^_`{|}~")
_BEYOND = np.arange(256) >= 128
_TRAILING = frozenset(b"#$%&*+/<=>@[\\]^_`{|}~!")


def features(text: bytes) -> list[float]:
    """The values of NAMES for a UTF-8 text; an empty one has zeros."""
    size = len(text)
    if not size:
        return [0.0] * len(NAMES)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    words = text.split()
    n = max(1, len(words))
    lines = [x for x in text.split(b"\n") if x]
    letters = size - int(counts[_SPACE].sum())
    share = lambda which: float(counts[which].sum()) / size
    return [
        float(np.log1p(size)),
        float(np.log1p(len(words))),
        letters / n,
        len(words) / max(1, len(lines)),
        share(_UPPER),
        share(_DIGIT),
        share(_SPACE),
        share(_BEYOND),
        share(_POINTS),
        share(_SYMBOLS),
        sum(w[-1] in _TRAILING for w in words) / n,
        len(set(words)) / n,
        sum(map(operator.eq, words, words[1:])) / n,
        len(set(lines)) / max(1, len(lines)),
        float(counts[_ENDS].sum()) / n,
        float(np.log1p(max(map(len, words), default=0))),
    ]


@dataclass
class Model:
    """Lookup tables: ``edges`` and ``tables`` by feature, and ``pairs`` of features with coarse edges and a grid."""

    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for rows of feature values."""
        total = np.full(len(x), self.base)
        for i, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += table[np.searchsorted(edges, x[:, i], "right")]
        for i, j, a, b, grid in self.pairs:
            total += grid[np.searchsorted(a, x[:, i], "right"), np.searchsorted(b, x[:, j], "right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    """Inner bounds of about equally filled bins."""
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1])) if len(values) else np.empty(0)


def _cut(g: np.ndarray, h: np.ndarray, least: float) -> tuple[float, int]:
    """Gain and place of the best split of bins; place 0 if none gains."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = np.where((hl > least) & (hr > least), gl**2 / (hl + 1) + gr**2 / (hr + 1) - g.sum() ** 2 / (h.sum() + 1), 0)
    if not len(gain) or gain.max() <= 1e-12:
        return 0.0, 0
    return float(gain.max()), int(gain.argmax()) + 1


def _tree(g: np.ndarray, h: np.ndarray, leaves: int, least: float) -> np.ndarray:
    """Values by bin of a tree with up to so many leaves, grown best first, for gradients and hessians by bin."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        options = [(*_cut(g[a:b], h[a:b], least), a, b) for a, b in parts]
        gain, at, a, b = max(options)
        if not at:
            break
        parts.remove((a, b))
        parts += [(a, a + at), (a + at, b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + 1)
    return out


def _grid_tree(g: np.ndarray, h: np.ndarray, least: float) -> tuple[float, np.ndarray]:
    """Gain and values by cell of a tree that splits one axis once and each side once on the other."""
    best, out = 0.0, np.zeros(g.shape)
    for axis in (0, 1):
        gs, hs = (g, h) if axis == 0 else (g.T, h.T)
        for at in range(1, len(gs)):
            gain, values = 0.0, np.zeros(gs.shape)
            for part in (slice(0, at), slice(at, None)):
                a, b = gs[part].sum(axis=0), hs[part].sum(axis=0)
                more, where = _cut(a, b, least)
                gain += more + a.sum() ** 2 / (b.sum() + 1)
                for side in (slice(0, where), slice(where, None)) if where else (slice(None),):
                    values[part, side] = a[side].sum() / (b[side].sum() + 1)
            if gain > best:
                best, out = gain, values if axis == 0 else values.T
    return best - g.sum() ** 2 / (h.sum() + 1), out


def fit(x: np.ndarray, y: np.ndarray, bins: int = 48, cells: int = 10, rounds: int = 120, pair_rounds: int = 40, pairs: int = 6, rate: float = 0.15) -> Model:
    """A model of labels 0 and 1. No rows give score 0.5; rows of one label give nearly that label's score."""
    ones = float(y.sum())
    model = Model(base=float(np.log((ones + 1) / (len(y) - ones + 1))))
    model.edges = [_edges(x[:, i], bins) for i in range(x.shape[1])]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    if not 0 < ones < len(y):
        return model
    least = max(1.0, len(y) / 2000) * 0.1
    binned = [np.searchsorted(e, x[:, i], "right") for i, e in enumerate(model.edges)]
    total = np.full(len(y), model.base)
    gradient = lambda: ((p := 1 / (1 + np.exp(-total))), y - p, p * (1 - p))[1:]
    for _ in range(rounds):
        for table, at in zip(model.tables, binned, strict=True):
            g, h = gradient()
            step = rate * _tree(np.bincount(at, g, len(table)), np.bincount(at, h, len(table)), 4, least)
            table += step
            total += step[at]
    coarse = [_edges(x[:, i], cells) for i in range(x.shape[1])]
    placed = [np.searchsorted(e, x[:, i], "right") for i, e in enumerate(coarse)]

    def on_grid(i: int, j: int, values: np.ndarray) -> np.ndarray:
        a, b = len(coarse[i]) + 1, len(coarse[j]) + 1
        return np.bincount(placed[i] * b + placed[j], values, a * b).reshape(a, b)

    g, h = gradient()
    gains = sorted(((_grid_tree(on_grid(i, j, g), on_grid(i, j, h), least)[0], i, j) for i in range(x.shape[1]) for j in range(i)), reverse=True)
    model.pairs = [(i, j, coarse[i], coarse[j], np.zeros((len(coarse[i]) + 1, len(coarse[j]) + 1))) for _, i, j in gains[:pairs]]
    for _ in range(pair_rounds):
        for i, j, _a, _b, grid in model.pairs:
            g, h = gradient()
            step = rate * _grid_tree(on_grid(i, j, g), on_grid(i, j, h), least)[1]
            grid += step
            total += step[placed[i], placed[j]]
    return model


def held_out(doc_id: str = "doc_id"):
    """Whether a row's label may not be learned from: crc32 of the id as text leaves remainder 0 by 5."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, text: str = "text", doc_id: str = "doc_id", label: str = "quality") -> Model:
    """Fit on up to ``sample`` labelled rows that aren't held out; features are counted on the executors.

    Rows with a null id or label don't count; of several labels of an id the largest holds, of several texts of an id
    the least value of each feature, so the driver gets ``sample`` rows at most.
    """
    usable = labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull() & ~held_out(doc_id))
    picked = usable.groupBy(F.col(doc_id).alias("id")).agg(F.max(label).alias("y")).orderBy(F.xxhash64("id"), "id").limit(sample)
    few = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(F.broadcast(picked), "id")  # ``sample`` ids at most
    found = _with_features(few, ["id", "y"], "text").groupBy("id", "y").agg(*[F.min(n).alias(n) for n in NAMES])  # an id may repeat
    rows = found.orderBy("id").select("y", *NAMES).toPandas()
    return fit(rows[list(NAMES)].to_numpy(float), (rows["y"] > 0).to_numpy(float))


def _with_features(docs: DataFrame, keep: list[str], text: str) -> DataFrame:
    def make():
        def apply(part: pa.RecordBatch) -> list:
            rows = [features(t or b"") for t in part.column(text).cast(pa.binary()).to_pylist()]
            return list(zip(*rows, strict=True)) or [[]] * len(NAMES)

        return apply

    return map_slices(docs, keep, text, [T.StructField(n, T.DoubleType()) for n in NAMES], make)


def _probabilities(model: Model, texts: pa.Array) -> np.ndarray:
    x = np.array([features(t or b"") for t in texts.cast(pa.binary()).to_pylist()], float).reshape(-1, len(NAMES))
    return model.score(x)


def accepted(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, with all columns, that score at least the threshold; by the rules of ``score``.

    Only texts go to Python and only verdicts come back; rows wait in the JVM, whatever their columns' names.
    """
    table = docs.sparkSession.sparkContext.broadcast(model)

    def good(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        release()
        own = table.value
        for batch in batches:
            named = pa.RecordBatch.from_arrays([batch], ["text"])
            yield pa.array(np.concatenate([np.empty(0, bool), *(_probabilities(own, part.column(0)) >= threshold for part in slices([named], "text"))]))

    return docs.where(F.arrow_udf(good, "boolean")(F.col(text)))


def score(docs: DataFrame, model: Model, keep: list[str], text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``keep`` columns of every row with ``score`` (0 to 1) and ``predicted`` (1 from the threshold on).

    Null counts as empty, and empty texts are scored like others; features are counted over whole texts, however long.
    A value at a bin's edge belongs to the bin above, a score at the threshold is 1. Rows are independent: repeated rows repeat
    their score, an empty table gives an empty result. Columns not in ``keep`` are not read.
    """
    table = docs.sparkSession.sparkContext.broadcast(model)  # a few thousand numbers

    def make():
        own = table.value

        def apply(part: pa.RecordBatch) -> list:
            p = _probabilities(own, part.column(text))
            return [p, (p >= threshold).astype(np.int32)]

        return apply

    return map_slices(docs, keep, text, [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())], make)
