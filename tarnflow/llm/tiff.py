"""TIFF media columns: a page decoder for classic and big files, and a writer for lossless byte payloads.

The decoder walks the chain of image directories and reads strips or tiles that are stored plain, with
PackBits, LZW or deflate, undoes the horizontal and floating-point predictors, and gives one array a page.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from tarnflow.llm.batches import map_slices, slices

# Fixed values of the format: tags, compressions and the sizes of field types.
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, STRIP_AT, SAMPLES, ROWS, STRIP_BYTES, PLANAR = 256, 257, 258, 259, 262, 273, 277, 278, 279, 284
PREDICTOR, TILE_WIDTH, TILE_HEIGHT, TILE_AT, TILE_BYTES, SAMPLE_FORMAT = 317, 322, 323, 324, 325, 339
PLAIN, LZW, DEFLATE, OLD_DEFLATE, PACKBITS = 1, 5, 8, 32946, 32773
#: Field types as they are written, and those that hold whole numbers as they are read.
TYPES = {3: "H", 4: "I"}
WHOLE = {1: "u1", 3: "u2", 4: "u4", 6: "i1", 8: "i2", 9: "i4", 13: "u4", 16: "u8", 17: "i8", 18: "u8"}
#: Tags that the decoder looks at.
KNOWN = {WIDTH, HEIGHT, BITS, COMPRESSION, STRIP_AT, SAMPLES, ROWS, STRIP_BYTES, PLANAR, PREDICTOR, TILE_WIDTH, TILE_HEIGHT, TILE_AT, TILE_BYTES, SAMPLE_FORMAT}
#: Bytes of a page's pixels at most: a cell can't hold much more.
MOST_PIXELS = 1 << 30
#: Payloads are filled up to a multiple of this many bytes, the width of a stored page.
UNIT = 576
PAGE_ROWS, STRIP_ROWS = 4096, 64


class DamagedImage(ValueError):
    """A file that doesn't follow the format, or uses what this decoder doesn't know."""


@dataclass
class Page:
    number: int
    width: int
    height: int
    samples: int
    bits: int
    compression: int
    pixels: np.ndarray  # height x width x samples


def unpack_bits(data: bytes, need: int) -> bytes:
    """PackBits: a length byte n below 128 is followed by n + 1 bytes, above 128 by one to repeat 257 - n times.

    This and the other decoders stop once they have the bytes that are needed.
    """
    out, i = bytearray(), 0
    while i < len(data) and len(out) < need:
        n = data[i]
        if n < 128:
            out += data[i + 1 : i + n + 2]
            i += n + 2
        else:
            if n > 128:
                out += data[i + 1 : i + 2] * (257 - n)
            i += 2 if n > 128 else 1
    return bytes(out)


def unpack_lzw(data: bytes, need: int) -> bytes:
    """LZW with the most significant bit first, and codes that grow one code early."""
    clear, end = 256, 257
    table: list[bytes] = []
    out, last, made = [], b"", 0
    width, held, bits = 9, 0, 0
    for byte in data:
        held, bits = (held << 8) | byte, bits + 8
        if bits < width:
            continue
        bits -= width
        code, held = held >> bits, held & ((1 << bits) - 1)
        if code == end:
            break
        if code == clear:
            table, width, last = [bytes([i]) for i in range(256)] + [b"", b""], 9, b""
            continue
        if not table or code > len(table) or code == len(table) and not last:
            raise DamagedImage("an LZW code out of range")
        word = table[code] if code < len(table) else last + last[:1]
        out.append(word)
        made += len(word)
        if made >= need:
            break
        if last:
            table.append(last + word[:1])
        last = word
        size = len(table) + 1
        width = 12 if size >= 2048 else 11 if size >= 1024 else 10 if size >= 512 else 9
    return b"".join(out)


def pack_bits(data: bytes) -> bytes:
    """The PackBits form, for writing."""
    out, i = bytearray(), 0
    while i < len(data):
        run = 1
        while run < 128 and data[i : i + 1] * (run + 1) == data[i : i + run + 1]:
            run += 1
        if run > 1:
            out += bytes([257 - run, data[i]])
            i += run
            continue
        j = i + 1
        while j < len(data) and j - i < 128 and data[j] != data[j - 1 if j > i + 1 else i]:
            j += 1
        out += bytes([j - i - 1]) + data[i:j]
        i = j
    return bytes(out)


def pack_lzw(data: bytes) -> bytes:
    """The LZW form, for writing."""
    held, bits, out = 0, 0, bytearray()

    def put(code: int, width: int) -> None:
        nonlocal held, bits
        held, bits = (held << width) | code, bits + width
        while bits >= 8:
            bits -= 8
            out.append(held >> bits)
            held &= (1 << bits) - 1

    width_of = lambda size: 12 if size >= 2048 else 11 if size >= 1024 else 10 if size >= 512 else 9
    put(256, 9)
    table, word = {bytes([i]): i for i in range(256)}, b""
    size = 258
    for byte in data:
        longer = word + bytes([byte])
        if longer in table:
            word = longer
            continue
        put(table[word], width_of(size))
        table[longer] = size
        size += 1
        word = longer[-1:]
        if size >= 4094:
            put(table[word], width_of(size))
            put(256, width_of(size + 1))
            table, size, word = {bytes([i]): i for i in range(256)}, 258, b""
    if word:
        put(table[word], width_of(size))
        size += 1
    put(257, width_of(size))
    if bits:
        put(0, 8 - bits)
    return bytes(out)


_PACK = {PLAIN: bytes, PACKBITS: pack_bits, LZW: pack_lzw, DEFLATE: lambda x: zlib.compress(x, 6)}


def _inflate(data: bytes, need: int) -> bytes:
    return zlib.decompressobj().decompress(data, max(1, need))


_UNPACK = {PLAIN: lambda x, need: x, PACKBITS: unpack_bits, LZW: unpack_lzw, DEFLATE: _inflate, OLD_DEFLATE: _inflate}
#: Bytes that a byte of each form can stand for at most.
RATIO = {PLAIN: 1, PACKBITS: 64, LZW: 2732, DEFLATE: 1040, OLD_DEFLATE: 1040}


def write_tiff(pages: list[np.ndarray], compression: int = DEFLATE, predictor: int = 2, tile: int = 0, strip_rows: int = STRIP_ROWS, order: str = "<") -> bytes:
    """A classic file of 8 or 16-bit pages (height x width, or x samples), in strips or in square tiles."""
    out = bytearray(struct.pack(order + "2sHI", b"II" if order == "<" else b"MM", 42, 0))
    link = 4
    for image in pages:
        image = image[..., None] if image.ndim == 2 else image
        height, width, samples = image.shape
        ats, sizes = [], []
        step_y, step_x = (tile, tile) if tile else (strip_rows, width)
        for y in range(0, height, step_y):
            for x in range(0, width, step_x):
                block = image[y : y + step_y, x : x + step_x]
                if tile:
                    block = np.pad(block, ((0, tile - block.shape[0]), (0, tile - block.shape[1]), (0, 0)))
                if predictor == 2:
                    block = np.concatenate([block[:, :1], block[:, 1:] - block[:, :-1]], axis=1)
                data = _PACK[compression](block.astype(block.dtype.newbyteorder(order)).tobytes())
                ats.append(len(out))
                sizes.append(len(data))
                out += data + b"\0" * (len(data) % 2)
        where, much = (TILE_AT, TILE_BYTES) if tile else (STRIP_AT, STRIP_BYTES)
        tags: dict[int, tuple[int, list[int]]] = {
            WIDTH: (4, [width]), HEIGHT: (4, [height]), BITS: (3, [image.dtype.itemsize * 8] * samples), COMPRESSION: (3, [compression]),
            PHOTOMETRIC: (3, [1]), where: (4, ats), SAMPLES: (3, [samples]), much: (4, sizes), PLANAR: (3, [1]), PREDICTOR: (3, [predictor]),
        }
        tags |= {TILE_WIDTH: (4, [tile]), TILE_HEIGHT: (4, [tile])} if tile else {ROWS: (4, [strip_rows])}
        entries = []
        for tag, (kind, values) in sorted(tags.items()):
            data = struct.pack(f"{order}{len(values)}{TYPES[kind]}", *values)
            if len(data) > 4:
                entries.append(struct.pack(order + "HHII", tag, kind, len(values), len(out)))
                out += data + b"\0" * (len(data) % 2)
            else:
                entries.append(struct.pack(order + "HHI4s", tag, kind, len(values), data))
        struct.pack_into(order + "I", out, link, len(out))
        out += struct.pack(order + "H", len(entries)) + b"".join(entries)
        link = len(out)
        out += struct.pack(order + "I", 0)
    return bytes(out)


def _directories(data: bytes) -> Iterator[tuple[str, dict[int, list]]]:
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if order is None or len(data) < 8:
        raise DamagedImage("no byte order mark")
    big = struct.unpack_from(order + "H", data, 2)[0] == 43
    count, size, entry, room = ("Q", "Q", 20, 8) if big else ("H", "I", 12, 4)
    at, seen = struct.unpack_from(order + size, data, 8 if big else 4)[0], set()
    step = struct.calcsize("=" + size)
    while at:
        if at in seen or at >= len(data):
            raise DamagedImage("the chain of directories is broken")
        seen.add(at)
        n = struct.unpack_from(order + count, data, at)[0]
        at += struct.calcsize("=" + count)
        if n > (len(data) - at) // entry:
            raise DamagedImage("a directory is longer than the file")
        tags = {}
        for i in range(at, at + n * entry, entry):
            tag, kind = struct.unpack_from(order + "HH", data, i)
            length = struct.unpack_from(order + size, data, i + 4)[0]
            if kind not in WHOLE or tag not in KNOWN:
                continue
            form, place = np.dtype(order + WHOLE[kind]), i + 4 + step
            if length * form.itemsize > room:
                place = struct.unpack_from(order + size, data, place)[0]
            if place + length * form.itemsize > len(data):
                raise DamagedImage(f"the values of tag {tag} are beyond the file's end")
            tags[tag] = np.frombuffer(data, form, length, place).tolist()
        yield order, tags
        at = struct.unpack_from(order + size, data, at + n * entry)[0]


def _block(raw: bytes, height: int, width: int, samples: int, kind: np.dtype, predictor: int, order: str) -> np.ndarray:
    need = height * width * samples * kind.itemsize
    if len(raw) < need:
        raise DamagedImage("a strip or tile is too short")
    if predictor == 3:
        rows = np.frombuffer(raw, np.uint8, need).reshape(height, -1)
        summed = np.cumsum(rows.reshape(height, -1, samples), axis=1, dtype=np.uint8).reshape(height, -1)
        planes = summed.reshape(height, kind.itemsize, width * samples).transpose(0, 2, 1)
        return np.ascontiguousarray(planes).view(kind.newbyteorder(">")).reshape(height, width, samples).astype(kind)
    if predictor == 2:  # differences are of the stored bits, whatever they stand for
        plain = np.dtype(f"u{kind.itemsize}")
        values = np.frombuffer(raw, plain.newbyteorder(order), height * width * samples).astype(plain).reshape(height, width, samples)
        return np.cumsum(values, axis=1, dtype=plain).view(kind)
    return np.frombuffer(raw, kind.newbyteorder(order), height * width * samples).astype(kind).reshape(height, width, samples)


def read_tiff(data: bytes) -> Iterator[Page]:
    """The pages of a file in the order of its directories; ``DamagedImage`` at the first that can't be read.

    What a file claims is checked before anything is allocated for it.
    """
    try:
        for number, (order, tags) in enumerate(_directories(data)):
            yield _page(number, order, tags, data)
    except (struct.error, zlib.error) as e:
        raise DamagedImage(str(e)) from e


def _page(number: int, order: str, tags: dict[int, list[int]], data: bytes) -> Page:
    def one(tag: int, other: int | None = None) -> int:
        found = tags.get(tag) or [other]
        if found[0] is None:
            raise DamagedImage(f"tag {tag} is missing")
        return found[0]

    width, height, samples, compression = one(WIDTH), one(HEIGHT), one(SAMPLES, 1), one(COMPRESSION, PLAIN)
    bits, predictor, planar, form = one(BITS, 1), one(PREDICTOR, 1), one(PLANAR, 1), one(SAMPLE_FORMAT, 1)
    if compression not in _UNPACK or bits not in (8, 16, 32, 64) or len(set(tags.get(BITS, []))) > 1 or form not in (1, 2, 3) or form == 3 and bits == 8:
        raise DamagedImage(f"compression {compression} with samples of {bits} bits and format {form} isn't supported")
    if predictor not in (1, 2, 3) or predictor == 3 and form != 3 or planar not in (1, 2):
        raise DamagedImage(f"predictor {predictor} with format {form} and layout {planar} isn't supported")
    kind = np.dtype(f"{'uif'[form - 1]}{bits // 8}")
    tiled = TILE_AT in tags
    ats, sizes = (tags.get(TILE_AT, []), tags.get(TILE_BYTES, [])) if tiled else (tags.get(STRIP_AT, []), tags.get(STRIP_BYTES, []))
    step_y, step_x = (one(TILE_HEIGHT), one(TILE_WIDTH)) if tiled else (min(one(ROWS, height), height), width)
    if min(width, height, samples, step_y, step_x) < 1 or min([*ats, *sizes], default=0) < 0:
        raise DamagedImage("sizes that aren't positive")
    planes, inner = (samples, 1) if planar == 2 else (1, samples)
    down, across = -(-height // step_y), -(-width // step_x)
    if not len(ats) == len(sizes) == planes * down * across:
        raise DamagedImage("another number of strips or tiles than the page needs")
    need, block = height * width * samples * kind.itemsize, step_y * step_x * inner * kind.itemsize
    stored = sum(min(size, max(0, len(data) - at)) for at, size in zip(ats, sizes, strict=True))
    if max(need, block) > min(MOST_PIXELS, RATIO[compression] * stored + 1):
        raise DamagedImage("more pixels than the stored bytes can hold, or than a page may have")
    pixels, blocks = np.empty((height, width, samples), kind), iter(zip(ats, sizes, strict=True))
    for plane in range(planes):
        for y in range(0, height, step_y):
            for x in range(0, width, step_x):
                at, size = next(blocks)
                rows = step_y if tiled else min(step_y, height - y)
                raw = _UNPACK[compression](data[at : at + size], rows * step_x * inner * kind.itemsize)
                got = _block(raw, rows, step_x, inner, kind, predictor, order)
                into = pixels[y : y + step_y, x : x + step_x, plane : plane + inner]
                into[:] = got[: into.shape[0], : into.shape[1]]
    return Page(number, width, height, samples, bits, compression, pixels)


def decode_pages(media: DataFrame, keep: list[str], content: str = "content") -> DataFrame:
    """One row per page: ``keep`` columns, the page's number, sizes, compression and its ``pixels`` as bytes.

    Null or empty content has no pages; a damaged file, or one whose page has more than ``MOST_PIXELS`` bytes, gives the
    pages before the damage and one row with ``error`` and no page. Files of any length are read whole, may repeat, an
    empty table gives an empty result, and columns not in ``keep`` are not read.
    """
    fields = "page int, width int, height int, samples int, bits int, compression int, pixels binary, error string"
    schema = T.StructType([media.schema[c] for c in keep] + list(T._parse_datatype_string(fields)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, content):
            for i, cell in enumerate(part.column(content).to_pylist()):
                own = [part.column(c).slice(i, 1) for c in keep]
                try:
                    pages = read_tiff(cell) if cell else ()
                    for p in pages:
                        row = [p.number, p.width, p.height, p.samples, p.bits, p.compression]
                        yield pa.RecordBatch.from_arrays(
                            [*own, *(pa.array([x], pa.int32()) for x in row), pa.array([p.pixels.tobytes()], pa.binary()), pa.array([None], pa.string())], schema.names
                        )
                except DamagedImage as e:
                    yield pa.RecordBatch.from_arrays([*own, *(pa.array([None], pa.int32()) for _ in range(6)), pa.array([None], pa.binary()), pa.array([str(e)])], schema.names)

    return media.select(*dict.fromkeys([*keep, content])).mapInArrow(run, schema)


def store_bytes(payload: bytes) -> bytes:
    """A file that holds a payload of whole units as 8-bit samples, one row a unit, a page per 4096 rows."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, UNIT)
    return write_tiff([rows[i : i + PAGE_ROWS] for i in range(0, len(rows), PAGE_ROWS)])


def features(pages: list[Page]) -> str:
    """Pages, rows, the sum of the samples, of their squares, and counts of samples by their upper four bits."""
    counts = np.zeros(256, np.int64)
    for p in pages:
        counts += np.bincount(p.pixels.ravel(), minlength=256)
    values = np.arange(256, dtype=np.int64)
    upper = ",".join(map(str, counts.reshape(16, 16).sum(axis=1)))
    return f"pages={len(pages)};rows={sum(p.height for p in pages)};sum={counts @ values};squares={counts @ values**2};upper={upper}"


def text_media(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns of every row with sizes, digests and features of its whole text stored as a TIFF file.

    The text's UTF-8 bytes (null: none) are filled up with bytes 255 to a positive multiple of 576, stored,
    and read back by the page decoder; payload digests and features come from what was read. Equal texts have
    equal values, repeated rows too; very long ones have more pages. An empty table gives an empty result; other
    columns are not read.
    """

    def row(t: bytes) -> tuple:
        media = store_bytes(t + b"\xff" * (-len(t) % UNIT or UNIT * (not t)))
        pages = list(read_tiff(media))
        back = b"".join(p.pixels.tobytes() for p in pages)
        return len(t), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-32:]), len(media), hashlib.sha256(media).hexdigest(), features(pages)

    def make():
        return lambda part: list(zip(*(row(t or b"") for t in part.column(text).cast(pa.binary()).to_pylist()), strict=True))

    names = {"n_bytes": T.LongType(), "payload_bytes": T.LongType(), "payload_sha256": T.StringType(), "tail_crc32": T.LongType(), "media_bytes": T.LongType(), "media_sha256": T.StringType(), "feature": T.StringType()}
    return map_slices(docs, keep, text, [T.StructField(n, t) for n, t in names.items()], make)
