"""Token counts of whole texts, by a two-tier lookup of pre-token lengths without a shuffle of pre-tokens.

Tier one is a broadcast table with the lengths of the corpus' frequent pre-tokens. It comes from a pass
over all texts: every partition keeps a bounded Misra-Gries summary of its pre-tokens, and the summaries
(never the pre-tokens) are merged in a tree. Tier two is a cache in each Python worker; what neither
tier knows goes to the tokenizer library in batches.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from tarnflow.llm.batches import held, map_slices, release, slices, texts_of

#: The pattern of byte-level pre-tokens (fixed value). \s is spelled as the Unicode property.
PRETOKEN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
#: Code points up to here have the same classes in every Unicode version that the libraries use.
STABLE = 0x377
FREQUENT = 16_384  # entries of the broadcast table
CACHED = 600_000  # entries of a worker's cache, some 75 MB; when it is full, its longer half goes
LONGEST = 64  # characters of a pre-token that is worth remembering
FAN_IN = 32  # summaries that one merge task reads


def _split(text: str, find) -> list[str] | None:
    """The text's pre-tokens; None if characters are new enough for class tables to differ."""
    if not text.isascii():
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            if ord(max(text)) > STABLE and _UNSURE.search(text):
                return None
    return find(text)


def _unsure_class() -> str:
    import unicodedata

    spans, start = [], None
    for cp in range(0x110000):
        new = unicodedata.category(chr(cp)) == "Cn"
        if new and start is None:
            start = cp
        elif not new and start is not None:
            spans.append((start, cp - 1))
            start = None
    if start is not None:
        spans.append((start, 0x10FFFF))
    return "[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in spans) + "]"


class _Lazy:
    """Code points that this Python's Unicode tables don't assign, compiled when first needed."""

    compiled = None

    def search(self, text: str):
        if _Lazy.compiled is None:
            _Lazy.compiled = regex.compile(_unsure_class())
        return _Lazy.compiled.search(text)


_UNSURE = _Lazy()


class Summary:
    """Misra-Gries counts: every item seen more than n / size times is among the ``size`` kept."""

    def __init__(self, size: int):
        self.size, self.counts = size, Counter()

    def add(self, items) -> None:
        self.counts.update(items)
        if len(self.counts) > 8 * self.size:
            self.cut()

    def cut(self) -> None:
        """Lower all counts by the first one that finds no room, as a run of decrements would; long items go."""
        if any(len(x) > LONGEST for x in self.counts):
            self.counts = Counter({k: v for k, v in self.counts.items() if len(k) <= LONGEST})
        if len(self.counts) > self.size:
            least = sorted(self.counts.values(), reverse=True)[self.size]
            self.counts = Counter({k: v - least for k, v in self.counts.items() if v > least})


def frequent_pretokens(docs: DataFrame, text: str = "text", size: int = FREQUENT) -> list[str]:
    """Up to ``size`` frequent pre-tokens of all texts; the driver gets FAN_IN summaries at most."""
    schema = "node long, item array<string>, n array<long>"
    arrow = pa.schema([("node", pa.int64()), ("item", pa.list_(pa.string())), ("n", pa.list_(pa.int64()))])

    def row(node: int, summary: Summary) -> pa.RecordBatch:
        summary.cut()
        items = list(summary.counts)
        return pa.RecordBatch.from_pylist([{"node": node, "item": items, "n": [summary.counts[x] for x in items]}], arrow)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        release()
        summary, find = Summary(size), regex.compile(PRETOKEN).findall
        for part in slices(batches, "t"):
            for t in texts_of(part, "t"):
                summary.add(find(t))
        yield row(TaskContext.get().partitionId(), summary)

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        summary = Summary(size)
        for items, counts in zip(table.column("item").to_pylist(), table.column("n").to_pylist(), strict=True):
            summary.add(dict(zip(items, counts, strict=True)))
        return pa.Table.from_batches([row(key[0].as_py(), summary)])

    source = docs.select(F.col(text).alias("t"))
    n = source.rdd.getNumPartitions()
    level = source.mapInArrow(read, schema)
    while n > FAN_IN:
        n = -(-n // FAN_IN)
        level = level.withColumn("node", F.col("node") % n).groupBy("node").applyInArrow(merge, schema)
    top = Summary(size)
    for r in level.collect():  # FAN_IN rows of ``size`` entries at most
        top.add(dict(zip(r["item"], r["n"], strict=True)))
    top.cut()
    return sorted(top.counts)


def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _bare(description: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_str(description)


class Counting:
    """Lengths of texts in tokens, with the two tiers; one of these lives in each Python worker."""

    def __init__(self, path: str, frequent: dict[str, int]):
        self.library, self.frequent, self.cache = _tokenizer(path), frequent, {}
        self.find, self.line = regex.compile(PRETOKEN).findall, None
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None

    @classmethod
    def of(cls, path: str, frequent: dict[str, int], token: str) -> Counting:
        return held(cls.key(path, token), lambda: cls(path, frequent))

    @staticmethod
    def key(path: str, token: str) -> tuple:
        return ("lengths", path, token)

    def encode(self, items: list[str]) -> list[int]:
        """Tokens of each text, by the library alone."""
        out = []
        for i in range(0, len(items), 2000):
            out += [len(e.ids) for e in self.library.encode_batch_fast(items[i : i + 2000], add_special_tokens=False)]
        return out

    def encode_pretokens(self, items: list[str]) -> list[int]:
        """Tokens of each pre-token. Many go to the library in one text, a line each: a line break always stands alone
        between pre-tokens that aren't white space, so its id marks their ends."""
        if self.line is None:
            ids = self.library.encode("\n", add_special_tokens=False).ids
            self.line = ids[0] if len(ids) == 1 else -1
        if self.line < 0 or any(x.isspace() for x in items):
            return self.encode(items)
        out = []
        for i in range(0, len(items), 500):
            text = "\n".join(["", *items[i : i + 500], ""])
            ids = np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids)
            out += (np.diff(np.flatnonzero(ids == self.line)) - 1).tolist()
        return out

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text. Special strings in a text count as one token, as is the library's default."""
        totals, missed, first, second = [0] * len(texts), [], self.frequent.get, self.cache.get
        whole: list[int] = []
        for i, text in enumerate(texts):
            parts = [text]
            if self.cut is not None and any(s in text for s in self.special):
                parts = self.cut.split(text)
                totals[i] += len(parts) - 1
            for part in parts:
                items = _split(part, self.find)
                if items is None:
                    whole.append(i)
                    break
                lengths = list(map(first, items))
                k = -1
                for _ in range(lengths.count(None)):
                    k = lengths.index(None, k + 1)
                    known = second(items[k])
                    if known is None:
                        missed.append((i, items[k]))
                        known = 0
                    lengths[k] = known
                totals[i] += sum(lengths)
        new = list(dict.fromkeys(x for _, x in missed))
        blank = [x for x in new if x.isspace()]
        found = dict(zip(blank, self.encode(blank), strict=True))
        words = [x for x in new if x not in found]
        found |= zip(words, self.encode_pretokens(words), strict=True)
        for i, x in missed:
            totals[i] += found[x]
        for i in dict.fromkeys(whole):
            totals[i] = self.encode([texts[i]])[0]
        if len(self.cache) + len(found) > CACHED:  # short pre-tokens recur most
            middle = sorted(map(len, self.cache))[len(self.cache) // 2] if self.cache else 0
            kept = {x: n for x, n in self.cache.items() if len(x) < middle}
            self.cache.clear()
            self.cache.update(kept)
        self.cache.update((x, n) for x, n in found.items() if len(x) <= LONGEST)
        return totals


def token_counts(docs: DataFrame, vocabulary: str, keep: list[str], text: str = "text", size: int = FREQUENT) -> DataFrame:
    """``keep`` columns of every row with ``n_bytes`` (UTF-8) and ``n_tokens`` of its whole text.

    ``vocabulary`` is the path, on every machine, of a byte-level BPE file of the tokenizers library.
    Null and empty texts have 0 bytes and 0 tokens. Whole texts count, however long; a long one is a slice of its own.
    Rows are independent, so there are no ties, and repeated rows are counted each. An empty table gives
    an empty result. Columns of ``docs`` that are not in ``keep`` are not read, so their names don't matter.
    The work is one map over the texts after one map for the frequent pre-tokens; no text is shuffled.
    """
    frequent = frequent_pretokens(docs, text, size)
    lengths = dict(zip(frequent, Counting(vocabulary, {}).encode(frequent), strict=True))
    table = docs.sparkSession.sparkContext.broadcast(lengths)  # ``size`` entries at most
    token = f"{id(table)}-{len(lengths)}-{hash(tuple(frequent))}"

    def make():
        counting = Counting.of(vocabulary, table.value, token)

        def apply(part: pa.RecordBatch) -> list:
            texts = texts_of(part, text)
            return [[len(t.encode()) for t in texts], counting.count(texts)]

        return apply

    fields = [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())]
    return map_slices(docs, keep, text, fields, make, keeps=Counting.key(vocabulary, token))
