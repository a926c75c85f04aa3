"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

Texts of a slice are laid end to end as code points and mapped to classes by an array lookup. A small
automaton decides where pre-tokens start. Its transitions are functions from state to state; the
functions that can arise by composition form a finite monoid, so composing two of them is one lookup in
a table. Block totals are composed for all blocks at once, scanned, and replayed to give the state
before every code point. No regular expression runs. The slices between starts go through a cache of
merged ids; token offsets are kept, and decoding gathers bytes by them.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import sys
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from tarnflow.llm.batches import held, map_slices, texts_of

O, L, N, J, W, E, A1, A2, SEP = range(9)  # other, letter, number, joining space, white space, last white space, contractions
# States: nothing open, in letters, in numbers, in others, after a joining space, in white space, in a contraction with 2 or 1 letters to come.
FREE, LETTERS, NUMBERS, OTHERS, JOINED, WHITE, TWO, ONE = range(8)
BLOCK = 512
CACHED = 400_000  # pre-tokens that a worker keeps: some 65 MB, 150 MB if all are of the longest
LONGEST = 48
#: White space code points (fixed values of the Unicode property).
WHITE_SPACE = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

#: Letters and numbers that Unicode 16 added to 15.1, first and last of each run (fixed values of the Unicode property).
NEW_LETTERS = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7),
    (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C),
    (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
]
NEW_NUMBERS = [
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9),
    (0x1E5F1, 0x1E5FA),
]


@functools.cache
def code_point_classes() -> np.ndarray:
    """Class of each code point: O, L, N or W, as of Unicode 16. Unassigned ones are O."""
    kind = {"L": L, "N": N}
    table = np.fromiter((kind.get(unicodedata.category(chr(c))[0], O) for c in range(sys.maxunicode + 1)), np.uint8, sys.maxunicode + 1)
    for runs, new in ((NEW_LETTERS, L), (NEW_NUMBERS, N)):
        for first, last in runs:
            table[first : last + 1] = new
    table[WHITE_SPACE] = W
    return table


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """The next state, and whether a pre-token starts at the symbol."""
    if symbol == SEP:
        return FREE, True
    if symbol in (L, N, O):
        inside = {L: LETTERS, N: NUMBERS, O: OTHERS}[symbol]
        if state == TWO:
            return ONE, False
        if state == ONE:
            return FREE, False
        return inside, state not in (inside, JOINED)
    if symbol in (A1, A2):
        if state in (OTHERS, JOINED):
            return OTHERS, False
        return (ONE if symbol == A1 else TWO), True
    if symbol == J:
        return JOINED, True
    if symbol == E:
        return FREE, True
    return WHITE, state != WHITE


@functools.cache
def automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Next states, starts, each symbol's monoid element, the monoid's product table, and elements applied to FREE."""
    states, symbols = range(8), range(9)
    delta = np.array([[_step(s, x)[0] for x in symbols] for s in states], np.uint8)
    begins = np.array([[_step(s, x)[1] for x in symbols] for s in states], bool)
    generators = [tuple(int(delta[s, x]) for s in states) for x in symbols]
    members: dict[tuple, int] = {tuple(states): 0}
    queue = [tuple(states)]
    for f in queue:
        for g in generators:
            made = tuple(g[s] for s in f)
            if made not in members:
                members[made] = len(members)
                queue.append(made)
    product = np.array([[members[tuple(g[s] for s in f)] for g in members] for f in members], np.uint16)
    return delta, begins, np.array([members[g] for g in generators], np.uint16), product, np.array([f[FREE] for f in members], np.uint8)


def symbols_of(points: np.ndarray, separators: np.ndarray) -> np.ndarray:
    """The automaton's symbols: classes, refined by the one or two code points that follow."""
    kinds = code_point_classes()[points]
    kinds[separators] = W  # to what comes before it, a text's end looks like white space
    white = kinds == W
    last = white.copy()
    last[:-1] &= ~white[1:]
    last[-1] = False
    out = kinds.copy()
    out[last] = E
    out[last & (points == 0x20)] = J
    quotes = np.flatnonzero(points[:-2] == 0x27)
    a, b = points[quotes + 1], points[quotes + 2]
    out[quotes[np.isin(a, [ord(c) for c in "stmd"])]] = A1
    e, l, r, v = map(ord, "elrv")
    out[quotes[((a == r) | (a == v)) & (b == e) | (a == l) & (b == l)]] = A2
    out[separators] = SEP
    return out


def starts_of(symbols: np.ndarray) -> np.ndarray:
    """Whether a pre-token starts at each position, by a scan over composed transition functions."""
    delta, begins, element, product, applied = automaton()
    n = len(symbols)
    rows = -(-n // BLOCK)
    padded = np.full(rows * BLOCK, SEP, np.uint8)
    padded[:n] = symbols
    columns = np.ascontiguousarray(padded.reshape(rows, BLOCK).T)
    width, flat = len(product), product.ravel()
    total = np.zeros(rows, np.intp)
    for column in columns:
        total = flat[total * width + element[column]].astype(np.intp)
    before = np.empty(rows, np.intp)  # of each block, what all earlier blocks compose to
    held = 0
    for i, block in enumerate(total.tolist()):
        before[i] = held
        held = int(product[held, block])
    state = applied[before].astype(np.intp)
    out = np.empty((BLOCK, rows), bool)
    moves, opens = delta.ravel().astype(np.intp), begins.ravel()
    for j, column in enumerate(columns):
        at = state * 9 + column
        out[j] = opens[at]
        state = moves[at]
    return out.T.ravel()[:n]


def pretokens(texts: list[str]) -> list[list[str]]:
    """The pre-tokens of each text."""
    joined = "\n".join([*texts, ""])
    if not texts:
        return []
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    separators = np.cumsum([len(t) + 1 for t in texts]) - 1
    if len(points) < 3:
        points = np.concatenate([points, np.zeros(3, np.uint32)])
    begin = starts_of(symbols_of(points, separators))
    begin[separators] = True
    at = np.flatnonzero(begin[: separators[-1] + 1])
    cuts = at.tolist()
    pieces = [joined[a:b] for a, b in zip(cuts, cuts[1:], strict=False)] + ["\n"]
    ends = np.searchsorted(at, separators).tolist()
    return [pieces[a:b] for a, b in zip([0, *(e + 1 for e in ends)], ends, strict=False)]


class Ranks:
    """A vocabulary of byte sequences by rank, with a cache of merged pre-tokens."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        size = max(self.ranks.values()) + 1
        words = [b""] * size
        for word, rank in self.ranks.items():
            words[rank] = word
        self.lengths = np.array([len(w) for w in words], np.int64)
        self.begins = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.bytes = np.frombuffer(b"".join(words), np.uint8)
        self.cache: dict[str, bytes] = {}

    @classmethod
    def of(cls, path: str) -> Ranks:
        return held(cls.key(path), lambda: cls(path))

    @staticmethod
    def key(path: str) -> tuple:
        return ("ranks", path)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token: the adjacent pair of least rank, the leftmost of equals, merges first."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        return self._merge_short(piece) if len(piece) <= 100 else self._merge_long(piece)

    def _merge_short(self, piece: bytes) -> list[int]:
        rank, none = self.ranks.get, 1 << 40
        cuts = list(range(len(piece) + 1))
        pairs = [rank(piece[i : i + 2], none) for i in range(len(piece) - 1)]
        while pairs:
            least = min(pairs)
            if least == none:
                break
            i = pairs.index(least)
            del cuts[i + 1], pairs[i]
            if i < len(pairs):
                pairs[i] = rank(piece[cuts[i] : cuts[i + 2]], none)
            if i:
                pairs[i - 1] = rank(piece[cuts[i - 1] : cuts[i + 1]], none)
        return [self.ranks[piece[a:b]] for a, b in zip(cuts, cuts[1:], strict=False)]

    def _merge_long(self, piece: bytes) -> list[int]:
        rank, n = self.ranks.get, len(piece)
        end = list(range(1, n + 1))  # of the part that starts at each place; 0 once it is merged away
        prev = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            if not end[i] or end[i] >= n or end[end[i]] != stop:
                continue
            end[end[i]] = 0
            end[i] = stop
            if stop < n:
                prev[stop] = i
                if (r := rank(piece[i : end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (p := prev[i]) >= 0 and (r := rank(piece[p:stop])) is not None:
                heapq.heappush(heap, (r, p, stop))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[piece[i : end[i]]])
            i = end[i]
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids (unsigned 32-bit) of each whole text."""
        get, out = self.cache.get, []
        for items in pretokens(texts):
            parts = list(map(get, items))
            if None in parts:
                for i, part in enumerate(parts):
                    if part is None:
                        item = items[i]
                        part = parts[i] = get(item) or np.array(self.merge(item.encode()), "<u4").tobytes()
                        if len(item) <= LONGEST:
                            self.cache[item] = part
            out.append(np.frombuffer(b"".join(parts), "<u4"))
        if len(self.cache) > CACHED:  # short pre-tokens recur most
            middle = sorted(map(len, self.cache))[len(self.cache) // 3]
            self.cache = {k: v for k, v in self.cache.items() if len(k) < middle}
        return out

    def offsets(self, ids: np.ndarray) -> np.ndarray:
        """Where each token begins in the text's bytes, and the bytes' number at the end."""
        return np.concatenate([[0], np.cumsum(self.lengths[ids])])

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> bytes:
        """The bytes of the ids, gathered from the vocabulary by the offsets."""
        return self.bytes[np.repeat(self.begins[ids] - offsets[:-1], self.lengths[ids]) + np.arange(offsets[-1])].tobytes()


def encode(docs: DataFrame, ranks: str, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns of every row with ``ids`` and ``offsets`` (array<long>, bytes) of its whole text.

    ``ranks`` is the path, on every machine, of a rank file. Null and empty texts have no ids and the one
    offset 0. Whole texts are encoded, however long; of pairs of equal rank the leftmost merges first. Rows are
    independent, so repeated rows give repeated results and an empty table an empty
    one. Columns that are not in ``keep`` are not read. One map, no shuffle.
    """

    def make():
        coder = Ranks.of(ranks)

        def apply(part: pa.RecordBatch) -> list:
            ids = coder.encode(texts_of(part, text))
            return [[x.tolist() for x in ids], [coder.offsets(x).tolist() for x in ids]]

        return apply

    whole = T.ArrayType(T.LongType(), False)
    return map_slices(docs, keep, text, [T.StructField("ids", whole), T.StructField("offsets", whole)], make, keeps=Ranks.key(ranks))


def decode(encoded: DataFrame, ranks: str, keep: list[str], ids: str = "ids") -> DataFrame:
    """``keep`` columns of every row with ``decoded``, the bytes of its ids; null ids give no bytes."""
    schema = T.StructType([*(encoded.schema[c] for c in keep), T.StructField("decoded", T.BinaryType())])

    def run(batches):
        coder = Ranks.of(ranks)
        for batch in batches:
            lists = [np.array(x or [], np.int64) for x in batch.column(ids).to_pylist()]
            decoded = pa.array([coder.decode(x, coder.offsets(x)) for x in lists], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), decoded], [*keep, "decoded"])

    return encoded.select(*dict.fromkeys([*keep, ids])).mapInArrow(run, schema)


def round_trip(docs: DataFrame, ranks: str, keep: list[str], text: str = "text") -> DataFrame:
    """As ``encode`` then ``decode`` in one map: ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of every row.

    Null, empty, very long and repeated texts and empty tables are as in ``encode``.
    """

    def make():
        coder = Ranks.of(ranks)

        def apply(part: pa.RecordBatch) -> list:
            ids = coder.encode(texts_of(part, text))
            back = [coder.decode(x, coder.offsets(x)) for x in ids]
            return [[len(x) for x in ids], [hashlib.sha256(x.tobytes()).hexdigest() for x in ids], [hashlib.sha256(x).hexdigest() for x in back]]

        return apply

    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    return map_slices(docs, keep, text, fields, make, keeps=Ranks.key(ranks))
