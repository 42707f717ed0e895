"""TIFF media columns: pages out of files with plain, PackBits, LZW or deflate strips and tiles.

``pages`` walks a file's image directories, decodes the strips or tiles of each, undoes horizontal differencing and gives one row
a page. Samples have 1, 2, 4, 8 or 16 bits, side by side or in planes; those below 8 bits come out as bytes. A page that can't be
read gives a row with an error, and the next directory is read; only where a directory has no readable link does the file end.
Sizes are checked against what the data can hold before anything is decoded, and decoders stop at the size of their strip, so a
malformed file costs no more memory than its bytes account for. ``encode`` writes grey 8-bit pages of any of these forms.

Null and empty files give one row with an error and no page; repeated rows and null ids are kept; an empty table gives an empty
result; clashing column names give way to the operator's own.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import tidy

# Fixed values of the format: compression schemes, field types' sizes in bytes, tags.
NONE, LZW, DEFLATE, OLD_DEFLATE, PACKBITS = 1, 5, 8, 32946, 32773
SIZES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8}
CODES = {1: "B", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d"}
WIDTH, HEIGHT, DEPTH, SCHEME, PHOTOMETRIC, STRIPS, SAMPLES, ROWS, STRIP_BYTES, PLANAR = 256, 257, 258, 259, 262, 273, 277, 278, 279, 284
PREDICTOR, TILE_WIDTH, TILE_HEIGHT, TILES, TILE_BYTES = 317, 322, 323, 324, 325
SHORT = {DEPTH, SCHEME, PHOTOMETRIC, SAMPLES, PREDICTOR}

# Bytes that one byte of a strip can stand for at most.
MOST = {NONE: 1, LZW: 4_096, DEFLATE: 1_040, OLD_DEFLATE: 1_040, PACKBITS: 128}
#: Forms (scheme, predictor, tile) in which texts are stored, chosen by a checksum of the content.
FORMS = ((PACKBITS, 1, None), (DEFLATE, 2, None), (LZW, 1, None), (DEFLATE, 1, (96, 16)), (PACKBITS, 1, (96, 16)), (DEFLATE, 1, None), (LZW, 2, (96, 16)), (DEFLATE, 2, (96, 16)))
#: Bytes of decoded pages that a worker gathers before it hands them on.
GATHERED = 4 << 20

PAGE = T.StructType(
    [
        T.StructField("page", T.IntegerType()),
        T.StructField("width", T.IntegerType()),
        T.StructField("height", T.IntegerType()),
        T.StructField("samples", T.IntegerType()),
        T.StructField("bits", T.IntegerType()),
        T.StructField("scheme", T.IntegerType()),
        T.StructField("predictor", T.IntegerType()),
        T.StructField("least", T.IntegerType()),
        T.StructField("greatest", T.IntegerType()),
        T.StructField("levels", T.IntegerType()),
        T.StructField("total", T.LongType()),
        T.StructField("pixels", T.BinaryType()),
        T.StructField("error", T.StringType()),
    ]
)


def unpack_bits(data: bytes, most: int = 1 << 62) -> bytes:
    out, i, n = bytearray(), 0, len(data)
    while i < n and len(out) < most:
        c = data[i]
        i += 1
        if c < 128:
            out += data[i : i + c + 1]
            i += c + 1
        elif c > 128 and i < n:
            out += data[i : i + 1] * (257 - c)
            i += 1
    return bytes(out)


def pack_bits(data: bytes) -> bytes:
    """Runs of three or more equal bytes, and what lies between them as it is."""
    out, n = bytearray(), len(data)
    if not n:
        return b""
    a = np.frombuffer(data, dtype=np.uint8)
    begins = np.concatenate(([0], np.flatnonzero(a[1:] != a[:-1]) + 1, [n])).tolist()
    plain = 0

    def literal(upto):
        for at in range(plain, upto, 128):
            part = data[at : min(upto, at + 128)]
            out.append(len(part) - 1)
            out.extend(part)

    for b, e in zip(begins[:-1], begins[1:], strict=True):
        if e - b >= 3:
            literal(b)
            while e - b >= 2:
                k = min(128, e - b)
                out += bytes((257 - k, data[b]))
                b += k
            plain = b
    literal(n)
    return bytes(out)


def lzw_decode(data: bytes, most: int = 1 << 62) -> bytes:
    """Most significant bit first; codes widen one early; 256 clears, 257 ends."""
    out, width, held, have, last, made = [], 9, 0, 0, b"", 0
    base = [bytes([i]) for i in range(256)] + [b"", b""]
    table = base.copy()
    for byte in data:
        held = (held << 8 | byte) & 0xFFFFFF
        have += 8
        if have < width:
            continue
        have -= width
        code = held >> have & (1 << width) - 1
        if code == 257:
            break
        if code == 256:
            table, width, last = base.copy(), 9, b""
            continue
        if not last:
            entry = table[code]
        else:
            if code > len(table) or len(table) > 4_096:
                raise ValueError(f"code {code} of {len(table)}")
            entry = table[code] if code < len(table) else last + last[:1]
            table.append(last + entry[:1])
        out.append(entry)
        made += len(entry)
        if made >= most:
            break
        last = entry
        width = 9 if len(table) < 511 else 10 if len(table) < 1023 else 11 if len(table) < 2047 else 12
    return b"".join(out)


def lzw_encode(data: bytes) -> bytes:
    out, held, have = bytearray(), 0, 0
    table = {bytes([i]): i for i in range(256)}
    size, width = 258, 9

    def put(code):
        nonlocal held, have
        held, have = held << width | code, have + width
        while have >= 8:
            have -= 8
            out.append(held >> have & 255)
        held &= (1 << have) - 1

    put(256)
    word = b""
    for i in range(len(data)):
        longer = word + data[i : i + 1]
        if longer in table:
            word = longer
            continue
        put(table[word])
        table[longer] = size
        size += 1
        if size == 4094:
            width = 12
            put(256)
            table = {bytes([k]): k for k in range(256)}
            size, width = 258, 9
        else:
            width = 9 if size < 512 else 10 if size < 1024 else 11 if size < 2048 else 12
        word = data[i : i + 1]
    if word:
        put(table[word])
        size += 1
        width = 9 if size < 512 else 10 if size < 1024 else 11 if size < 2048 else 12
    put(257)
    if have:
        out.append(held << 8 - have & 255)
    return bytes(out)


def expand(data: bytes, scheme: int, most: int = 1 << 62) -> bytes:
    """The bytes of a strip or tile, ``most`` or a little more of them."""
    if scheme == NONE:
        return data
    if scheme in (DEFLATE, OLD_DEFLATE):
        return zlib.decompressobj().decompress(data, min(most, 1 << 31))
    if scheme == PACKBITS:
        return unpack_bits(data, most)
    if scheme == LZW:
        return lzw_decode(data, most)
    raise ValueError(f"compression {scheme}")


def shrink(data: bytes, scheme: int) -> bytes:
    return {NONE: bytes, DEFLATE: lambda x: zlib.compress(x, 1), PACKBITS: pack_bits, LZW: lzw_encode}[scheme](data)


def encode(images: list[np.ndarray], scheme: int = DEFLATE, predictor: int = 2, rows: int = 256, tile: tuple[int, int] | None = None) -> bytes:
    """A little-endian file of grey 8-bit pages; ``tile`` (width, height, multiples of 16) or strips of ``rows`` rows."""
    out = bytearray(b"II*\0\0\0\0\0")
    link = 4
    for image in images:
        height, width = image.shape
        if tile:
            w, h = tile
            cells = []
            for y in range(0, height, h):
                for x in range(0, width, w):
                    cell = np.zeros((h, w), dtype=np.uint8)
                    part = image[y : y + h, x : x + w]
                    cell[: part.shape[0], : part.shape[1]] = part
                    cells.append(cell)
        else:
            cells = [image[y : y + rows] for y in range(0, height, rows)]
        places, sizes = [], []
        for cell in cells:
            if predictor == 2:
                cell = np.concatenate((cell[:, :1], cell[:, 1:] - cell[:, :-1]), axis=1)
            packed = shrink(np.ascontiguousarray(cell).tobytes(), scheme)
            places.append(len(out))
            sizes.append(len(packed))
            out += packed + b"\0" * (len(packed) & 1)
        tags = {WIDTH: [width], HEIGHT: [height], DEPTH: [8], SCHEME: [scheme], PHOTOMETRIC: [1], SAMPLES: [1], PREDICTOR: [predictor]}
        tags |= {TILE_WIDTH: [tile[0]], TILE_HEIGHT: [tile[1]], TILES: places, TILE_BYTES: sizes} if tile else {STRIPS: places, ROWS: [rows], STRIP_BYTES: sizes}
        fields = []
        for tag, values in sorted(tags.items()):
            value = struct.pack(f"<{len(values)}I", *values)
            if len(values) > 1:
                value, at = struct.pack("<I", len(out)), value
                out += at
            fields.append(struct.pack("<HHI", tag, 3 if tag in SHORT else 4, len(values)) + value)
        out[link : link + 4] = struct.pack("<I", len(out))
        out += struct.pack("<H", len(fields)) + b"".join(fields)
        link = len(out)
        out += b"\0\0\0\0"
    return bytes(out)


def directories(data: bytes):
    """(byte order, fields, error) of each image directory; fields that can't be read make an error, which doesn't end the walk."""
    order = {b"II": "<", b"MM": ">"}.get(bytes(data[:2]))
    if order is None or len(data) < 8 or struct.unpack(order + "H", data[2:4])[0] != 42:
        raise ValueError("not a TIFF file")
    at, seen = struct.unpack(order + "I", data[4:8])[0], set()
    if not at:
        raise ValueError("no image directory")
    while at:
        if at in seen:
            raise ValueError("directories form a ring")
        seen.add(at)
        fields, error = {}, None
        (n,) = struct.unpack_from(order + "H", data, at)
        for i in range(n):
            try:
                tag, kind, count = struct.unpack_from(order + "HHI", data, at + 2 + 12 * i)
                if kind not in CODES:
                    continue
                place, size = at + 2 + 12 * i + 8, SIZES[kind] * count
                if size > 4:
                    (place,) = struct.unpack_from(order + "I", data, place)
                if not count or place + size > len(data):
                    raise ValueError(f"field {tag} has {count} values")
                fields[tag] = struct.unpack_from(f"{order}{count}{CODES[kind]}", data, place)
            except (ValueError, struct.error) as e:
                error = error or e
        yield order, fields, error
        (at,) = struct.unpack_from(order + "I", data, at + 2 + 12 * n)


def _samples(raw: bytes, rows: int, row: int, bits: int, order: str) -> np.ndarray:
    """Rows of ``row`` samples each; a row begins at a byte."""
    if bits >= 8:
        return np.frombuffer(raw, dtype=np.uint8 if bits == 8 else np.dtype(order + "u2"), count=rows * row).reshape(rows, row)
    held = -(-row * bits // 8)
    ones = np.unpackbits(np.frombuffer(raw, dtype=np.uint8, count=rows * held).reshape(rows, held), axis=1)
    return (ones.reshape(rows, -1, bits) @ (1 << np.arange(bits - 1, -1, -1))).astype(np.uint8)[:, :row]


def read_page(data: bytes, order: str, fields: dict) -> tuple:
    """(width, height, samples, bits, scheme, predictor, least, greatest, levels, total, pixels) of one directory; samples side by side."""
    one = lambda tag, default=None: fields[tag][0] if default is None or tag in fields else default
    width, height, samples, bits = one(WIDTH), one(HEIGHT), one(SAMPLES, 1), one(DEPTH, 1)
    scheme, predictor, planes = one(SCHEME, 1), one(PREDICTOR, 1), one(PLANAR, 1)
    if bits not in (1, 2, 4, 8, 16) or len({*fields.get(DEPTH, ())}) > 1 or planes not in (1, 2) or predictor not in (1, 2) or predictor == 2 and bits < 8:
        raise ValueError(f"{fields.get(DEPTH)} bits, planes {planes}, predictor {predictor}")
    if scheme not in MOST:
        raise ValueError(f"compression {scheme}")
    tiled = TILES in fields
    w, h = (one(TILE_WIDTH), one(TILE_HEIGHT)) if tiled else (width, min(height, one(ROWS, height)))
    places, sizes = (fields[TILES], fields[TILE_BYTES]) if tiled else (fields[STRIPS], fields[STRIP_BYTES])
    if min(width, height, samples, w, h) < 1:
        raise ValueError(f"{width} x {height}, {samples} samples, cells of {w} x {h}")
    across, down = -(-width // w), -(-height // h)
    apart = samples if planes == 2 else 1  # planes, each with cells of its own
    side = samples // apart
    if len(places) != across * down * apart or len(sizes) != len(places):
        raise ValueError(f"{len(places)} places and {len(sizes)} sizes of {across * down * apart} cells")
    row = -(-w * side * bits // 8)
    for place, size in zip(places, sizes, strict=True):
        if place < 0 or size < 0 or place + size > len(data):
            raise ValueError("a cell lies outside the file")
    most = MOST[scheme] * sum(sizes)
    if (h * down if tiled else height) * across * row * apart > most:
        raise ValueError(f"{width} x {height} pixels of {sum(sizes)} bytes")
    image = np.zeros((height, width, samples), dtype=np.uint16 if bits == 16 else np.uint8)
    for i, (place, size) in enumerate(zip(places, sizes, strict=True)):
        plane, cell = divmod(i, across * down)
        y, x = cell // across * h, cell % across * w
        deep = h if tiled else min(h, height - y)
        raw = expand(data[place : place + size], scheme, deep * row)
        found = _samples(raw, deep, w * side, bits, order).reshape(deep, w, side)
        if predictor == 2:
            found = np.cumsum(found, axis=1, dtype=image.dtype)
        image[y : y + deep, x : x + w, plane : plane + side] = found[: height - y, : width - x]
    seen = np.bincount(image.ravel())
    return width, height, samples, bits, scheme, predictor, int(image.min()), int(image.max()), int((seen > 0).sum()), int(image.sum(dtype=np.int64)), image.tobytes()


def _pages_of(data: bytes | None):
    """A tuple of the columns of PAGE for each page, or for what can't be read."""
    k, lost = 0, len(PAGE) - 2
    caught = (ValueError, KeyError, IndexError, OverflowError, MemoryError, struct.error, zlib.error)
    walk = directories(data or b"")
    while True:
        try:
            order, fields, error = next(walk)
        except StopIteration:
            return
        except caught as e:  # no way on from here
            yield (k, *[None] * lost, f"{type(e).__name__}: {e}")
            return
        try:
            if error:
                raise error
            yield (k, *read_page(data, order, fields), None)
        except caught as e:
            yield (k, *[None] * lost, f"{type(e).__name__}: {e}")
        k += 1


def pages(df: DataFrame, media_col: str = "media", keep: list[str] | tuple = ("id",)) -> DataFrame:
    """The kept columns and one row a page (the columns of PAGE)."""
    held = [c for c in keep if c not in PAGE.names]
    first = df.select(*dict.fromkeys([*held, media_col]))
    schema = T.StructType([first.schema[c] for c in held] + PAGE.fields)
    kinds = to_arrow_schema(PAGE).types
    pixels = PAGE.names.index("pixels")

    def run(batches):
        for batch in batches:
            rows, of, gathered = [], [], 0

            def packed():
                kept = [batch.column(c).take(pa.array(of, pa.int64())) for c in held]
                made = [pa.array(list(c), type=t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * len(kinds), kinds, strict=True)]
                return pa.RecordBatch.from_arrays(kept + made, names=held + PAGE.names)

            for i, data in enumerate(batch.column(media_col)):
                for page in _pages_of(data.as_py()):
                    rows.append(page)
                    of.append(i)
                    gathered += len(page[pixels] or b"")
                    if gathered > GATHERED:
                        yield packed()
                        rows, of, gathered = [], [], 0
            yield packed()
        tidy()

    return first.mapInArrow(run, schema)


def text_media(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 192, forms: tuple = FORMS, rows: int = 256) -> DataFrame:
    """id, n_bytes and media: each text as UTF-8, padded with blanks to a positive multiple of ``width``, as a grey page in one of
    the forms, so that equal texts give equal files."""
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        for batch in batches:
            sizes, files, gathered = [], [], 0

            def packed(upto):
                return pa.RecordBatch.from_arrays([batch.column("id").slice(upto - len(sizes), len(sizes)), pa.array(sizes, pa.int64()), pa.array(files, pa.binary())], names=["id", "n_bytes", "media"])

            for i, text in enumerate(batch.column("text")):
                data = (text.as_py() or "").encode("utf-8", "surrogatepass")
                sizes.append(len(data))
                data += b" " * (-len(data) % width or (0 if data else width))
                scheme, predictor, tile = forms[zlib.crc32(data) % len(forms)]
                files.append(encode([np.frombuffer(data, dtype=np.uint8).reshape(-1, width)], scheme, predictor, rows, tile))
                gathered += len(files[-1])
                if gathered > GATHERED:
                    yield packed(i + 1)
                    sizes, files, gathered = [], [], 0
            yield packed(batch.num_rows)
        tidy()

    return docs.mapInArrow(run, T.StructType([docs.schema["id"], T.StructField("n_bytes", T.LongType()), T.StructField("media", T.BinaryType())]))
