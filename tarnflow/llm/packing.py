"""Best-fit packing of tokenised documents into sequences, locally and then up a tree of residual bins.

Each task tokenises its documents and packs their pieces best-fit decreasing. Nearly full bins are final;
the others travel, as items of their used length, to fewer tasks, which pack them again. A level's task
gets a bounded number of bins. The last level closes what is left.
"""

from __future__ import annotations

import json
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tarnflow.llm.batches import held, slices, texts_of, trim
from tarnflow.llm.token_counts import _UNSURE, STABLE, _bare, _tokenizer
from tarnflow.session import stage

CAPACITY, END = 4096, 1
SLICE = 500_000  # bytes of text that are tokenised at once
NEARLY = 0.98  # of the capacity: fuller bins are final at every level
ITEMS = 100_000  # bins that one task of a level gets, about
CACHED, LONGEST = 300_000, 40  # words that a worker keeps: some 50 MB, 110 MB if all are of the longest
#: The pattern of pre-tokens that the fast path is for (fixed value of the vocabulary).
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
POINTS = frozenset(",.;:!?")  # marks that, after letters only, are pre-tokens of their own
_FIND = regex.compile(PRETOKEN).findall
#: Separators that Python's split takes for white space and the Unicode property doesn't (fixed values).
ODD_SPACES = "\x1c\x1d\x1e\x1f"


class WordIds:
    """Ids of texts by a vocabulary that drops white space: ids of words are cached, whole texts never are."""

    def __init__(self, path: str):
        self.path, self.cache, self.full = path, {}, None
        with open(path, encoding="utf-8") as f:
            held = json.load(f)
        self.special = [t["content"] for t in held["added_tokens"]]
        model, steps = held["model"], (held["pre_tokenizer"] or {}).get("pretokenizers", [])
        suffix = model.get("end_of_word_suffix")
        self.bare = None
        if suffix and [s["type"] for s in steps] == ["Split", "ByteLevel"] and steps[0]["pattern"] == {"Regex": PRETOKEN}:
            # The same merges without the steps before them: pre-tokens come lower-cased, with spaces between.
            steps = [{"type": "WhitespaceSplit"}, steps[1]]
            held |= {"normalizer": None, "added_tokens": [], "pre_tokenizer": {"type": "Sequence", "pretokenizers": steps}}
            self.bare = _bare(json.dumps(held))
            self.ends = np.zeros(max(model["vocab"].values()) + 1, bool)
            self.ends[[i for w, i in model["vocab"].items() if w.endswith(suffix)]] = True

    @property
    def library(self):
        """The whole library, for what only it can tell; most workers never load it."""
        if self.full is None:
            self.full = _tokenizer(self.path)
        return self.full

    def words(self, text: str) -> list[str] | None:
        """Lower-cased words of the normalised text; None if only the library can tell."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                if "Σ" in text or ord(max(text)) > STABLE and _UNSURE.search(text):
                    return None
        if any(c in text for c in ODD_SPACES) or any(s in text for s in self.special):
            return None
        return text.lower().split()

    def whole(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts, by the library alone."""
        out = []
        for i in range(0, len(texts), 2000):
            made = self.library.encode_batch_fast(texts[i : i + 2000], add_special_tokens=False)
            out += [np.array(e.ids, "<u4").tobytes() for e in made]
        return out

    def singly(self, words: list[str]) -> list[bytes]:
        """Ids of lower-cased words without white space. Many go to the merges in one text; the last id of a pre-token marks its end."""
        if self.bare is None:
            return self.whole(words)
        out = []
        for i in range(0, len(words), 1000):
            part, spaced, counts = words[i : i + 1000], [], []
            for w in part:
                if w.isalpha():
                    spaced.append(w)
                    counts.append(1)
                elif w[-1] in POINTS and w[:-1].isalpha():
                    spaced.append(f"{w[:-1]} {w[-1]}")
                    counts.append(2)
                else:
                    found = _FIND(w)
                    spaced.append(" ".join(found))
                    counts.append(len(found))
            ids = np.array(self.bare.encode_batch_fast([" ".join(spaced)], add_special_tokens=False)[0].ids, "<u4")
            ends, last = np.flatnonzero(self.ends[ids]), np.cumsum(counts) - 1
            if len(ends) != last[-1] + 1:
                out += self.whole(part)
                continue
            cuts, code = (ends[last] * 4 + 4).tolist(), ids.tobytes()
            out += [code[a:b] for a, b in zip([0, *cuts], cuts, strict=False)]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        get, parts, new = self.cache.get, [], {}
        for text in texts:
            words = self.words(text)
            found = None if words is None else list(map(get, words))
            gaps = [k for k, x in enumerate(found) if x is None] if found and None in found else []
            new.update(dict.fromkeys([words[k] for k in gaps]))
            parts.append((words, found, gaps))
        odd = {w for w in new if not w.isascii() and not unicodedata.is_normalized("NFC", w)}
        ask = list(new)
        new = dict(zip(ask, self.singly(ask), strict=True))
        out = []
        for text, (words, found, gaps) in zip(texts, parts, strict=True):
            if found is None or odd and any(words[k] in odd for k in gaps):
                out.append(self.whole([text])[0])
            else:
                for k in gaps:
                    found[k] = new[words[k]]
                out.append(b"".join(found))
        if len(self.cache) + len(new) > CACHED:  # short words recur most
            middle = sorted(map(len, self.cache))[len(self.cache) // 2] if self.cache else 0
            self.cache = {k: v for k, v in self.cache.items() if len(k) < middle}
        self.cache.update((w, x) for w, x in new.items() if len(w) <= LONGEST and w not in odd)
        return out


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, and the used length of each bin: longest items first, into the fullest bin that has room."""
    bins, offsets, used = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), []
    room: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by what is left in them
    free = 0  # bit r is set if a bin has r left
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fitting = free >> size
        if fitting:
            left = size + (fitting & -fitting).bit_length() - 1
            b = room[left].pop()
            if not room[left]:
                free &= ~(1 << left)
        else:
            b, left = len(used), capacity
            used.append(0)
        bins[i], offsets[i] = b, used[b]
        used[b] += size
        if left - size:
            room[left - size].append(b)
            free |= 1 << left - size
    return bins, offsets, np.array(used, np.int64)


_PIECE = [("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()), ("ids_crc32", T.LongType()), ("sequence_id", T.LongType()), ("offset", T.LongType())]


def _local(docs: DataFrame, vocabulary: str, text: str, capacity: int, nearly: int, items: int) -> DataFrame:
    """Pieces of all documents in the bins of their task: best fit over rounds of some ``items`` pieces.

    A round's pieces are columns of numbers, so a task's memory doesn't grow with its partition.
    """
    schema = T.StructType([docs.schema[0], *(T.StructField(n, t) for n, t in _PIECE), T.StructField("used", T.LongType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = held(("words", vocabulary), lambda: WordIds(vocabulary))
        end, name = np.array([END], "<u4").tobytes(), _first_name(0)
        ids, pieces, waiting = [], [], 0
        for part in slices(batches, text, SLICE):
            rows, of = [], []
            for k, code in enumerate(coder.encode(texts_of(part, text))):
                code += end
                for p, at in enumerate(range(0, len(code), 4 * capacity)):
                    cut = code[at : at + 4 * capacity]
                    of.append(k)
                    rows.append((p, at // 4, len(cut) // 4, zlib.crc32(cut)))
            ids.append(part.column(0).take(pa.array(of, pa.int64())))
            pieces.append(np.array(rows, np.int64).reshape(-1, 4))
            waiting += len(rows)
            if waiting >= items:
                yield from packed(ids, pieces, name)
                ids, pieces, name, waiting = [], [], name + waiting, 0
        if waiting:
            yield from packed(ids, pieces, name)
        trim()

    def packed(ids: list, pieces: list, name: int) -> Iterator[pa.RecordBatch]:
        table = np.concatenate(pieces)
        bins, offsets, used = best_fit(table[:, 2], capacity)
        columns = [pa.concat_arrays(ids), table[:, 0].astype(np.int32), table[:, 1], table[:, 2], table[:, 3], name + bins, offsets, used[bins]]
        whole = pa.RecordBatch.from_arrays([c if i == 0 else pa.array(c, arrow.field(i).type) for i, c in enumerate(columns)], schema=arrow)
        for at in range(0, whole.num_rows, 20_000):
            yield whole.slice(at, 20_000)

    return docs.mapInArrow(run, schema)


def _first_name(level: int) -> int:
    """The least name of a task's bins: names are made of the level, the partition and a running number."""
    from pyspark import TaskContext

    return (level << 56) + (TaskContext.get().partitionId() << 32)


def _merged(bins: DataFrame, level: int, capacity: int) -> DataFrame:
    """Where each bin (``bin``, ``used``) goes: ``to``, the bin that holds it, ``at`` in it, and ``to_used`` of that one."""
    schema = "bin long, to long, at long, to_used long"
    arrow = pa.schema([(n, pa.int64()) for n in ("bin", "to", "at", "to_used")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches([b for b in batches if b.num_rows], schema=pa.schema([("bin", pa.int64()), ("used", pa.int64())]))
        if not table.num_rows:  # two numbers for each of some ``items`` bins
            return
        table = table.sort_by("bin")
        at_bin, at, used = best_fit(table.column("used").to_numpy(), capacity)
        columns = [table.column("bin").combine_chunks(), _first_name(level) + at_bin, at, used[at_bin]]
        yield from pa.table(dict(zip(arrow.names, columns, strict=True)), schema=arrow).to_batches(20_000)

    return bins.select("bin", "used").mapInArrow(run, schema)


def pack(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text: str = "text", capacity: int = CAPACITY, items: int = ITEMS) -> DataFrame:
    """One row per piece: the id, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id`` and ``offset``.

    A document is the ids of its whole text (null: empty) and id 1, so each has a piece at least. Longer ones,
    however long, are cut into pieces of ``capacity``. Pieces of one sequence lie without gaps from offset 0. Rows
    are packed each on its own, repeated or not, whatever their id, null too; an empty table gives an empty result
    and other columns are not read. Pieces of equal length keep the order in which a task reads them.

    Only bins, two numbers each, go up the tree; pieces are joined to the bin that holds theirs at the end.
    """
    nearly = int(capacity * NEARLY)
    local = stage(_local(docs.select(id_col, text), vocabulary, text, capacity, nearly, items), "packing-0")
    open_ = F.col("used") < nearly
    left = local.where(open_ & (F.col("offset") == 0)).select(F.col("sequence_id").alias("bin"), "used")
    where, level, before = None, 1, None
    while True:
        bins = left.count()
        if not bins:
            break
        groups = -(-bins // items)
        last = groups == 1 or before is not None and bins > 0.95 * before
        spread = left.repartition(groups, F.xxhash64("bin") % groups) if groups > 1 else left.repartition(1)
        made = stage(_merged(spread, level, capacity), f"packing-{level}")
        step = made.select(F.col("bin").alias("from"), F.col("to").alias("next"), F.col("at").alias("more"), "to_used")
        if where is None:
            where = made
        else:  # bins that were full at the level below stay where they are
            moved = where.join(step.drop("to_used"), F.col("to") == F.col("from"), "left")
            where = moved.select("bin", F.coalesce("next", "to").alias("to"), (F.col("at") + F.coalesce("more", F.lit(0))).alias("at"))
        left = made.where((F.col("at") == 0) & (F.col("to_used") < nearly)).select(F.col("to").alias("bin"), F.col("to_used").alias("used"))
        level, before = level + 1, bins
        if last:
            break
    columns = [id_col, *(n for n, _ in _PIECE[:-2])]
    done = local.where(~open_).select(*columns, "sequence_id", "offset")
    if where is None:
        return done
    rest = local.where(open_).join(where.select("bin", "to", "at"), F.col("sequence_id") == F.col("bin"))
    return done.unionAll(rest.select(*columns, F.col("to").alias("sequence_id"), (F.col("offset") + F.col("at")).alias("offset")))
