"""Byte-level BPE encoding and decoding.

Encoding: a text is cut into overlapping chunks that are pre-tokenised apart. Two neighbouring chunks are stitched at the first
position of their overlap where both see a pre-token begin after a character that isn't white space: from there on a scan depends
only on what follows, so the scans agree. The pieces between the stitches are then encoded. Where an overlap has no such position
(one pre-token as long as an overlap), the two chunks are joined and scanned as one. Chunks of a text up to ``CHUNK`` and an overlap
are small ones, scanned and stitched by one worker where the text is read; those of a longer text are spread over workers.
Decoding concatenates the bytes of the ids.

Pieces repeat, so their ids are remembered in a bounded table in each worker. Texts up to U+024F are split with fixed character
classes; any other text is stitched only after ASCII characters, where tables of Unicode classes can't differ, and the pieces are
split by the library itself, whose tables are the measure.

Null texts count as empty; empty texts have no ids; null ids and repeated rows are kept as they are; an empty table gives an
empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import re
import struct
from functools import cached_property
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import append_columns, held

#: Code points of a chunk and of the overlap after it: of chunks that are spread over workers, and of those within one.
CHUNK, OVERLAP = 65_536, 2_048
SMALL, SMALL_OVERLAP = 4_096, 256
#: Pieces that a worker remembers.
REMEMBERED = 150_000

# Fixed character classes up to U+024F: letters, numbers, white space.
_L, _N, _S = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾", "\t-\r \x85\xa0"
_PIECE = re.compile(rf" ?[{_L}]+| ?[{_N}]+|'(?:[stmd]|re|ve|ll)| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
_BEYOND = re.compile("[^\x00-ɏ]")


class _Ids(dict):
    """Piece -> its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, encoding):
        super().__init__()
        self.encoding = encoding

    def __missing__(self, piece):
        ids = self.encoding.encode_ordinary(piece)
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(self) >= REMEMBERED:
            self.clear()
        self[piece] = packed
        return packed


class Codec:
    """One vocabulary: a file of ranks and the pattern that splits texts."""

    def __init__(self, path: str, pattern: str):
        import public_tokenizers

        with open(path, "rb") as file:
            self.bytes = {int(b): base64.b64decode(a) for a, b in map(bytes.split, file)}
        self.pattern = pattern
        self.fast = pattern == public_tokenizers.PATTERN

    @cached_property
    def encoding(self):
        import tiktoken

        return tiktoken.Encoding("own", pat_str=self.pattern, mergeable_ranks={v: k for k, v in self.bytes.items()}, special_tokens={})

    @cached_property
    def ids(self):
        return _Ids(self.encoding)

    def encode(self, text: str | None) -> bytes:
        """The ids of one piece of text."""
        text = text or ""
        if self.fast and not _BEYOND.search(text):
            get = self.ids.__getitem__
            return b"".join([get(x) for x in _PIECE.findall(text)])
        ids = self.encoding.encode_ordinary(text)
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode_chunks(self, text: str | None, chunk: int = SMALL, overlap: int = SMALL_OVERLAP) -> bytes:
        """The ids of a text by overlapping chunks, stitched and encoded here."""
        text = text or ""
        if len(text) <= chunk + overlap or not self.fast:
            return self.encode(text)
        plain = not _BEYOND.search(text)
        if plain:
            scan, get = _PIECE.findall, self.ids.__getitem__
            done = lambda pieces: out.extend([get(x) for x in pieces])
        else:
            import regex

            scan = regex.compile(self.pattern).findall
            done = lambda pieces: out.append(self.encode("".join(pieces)))
        out, begin, own = [], 0, scan(text[: chunk + overlap])
        for at in range(chunk, len(text), chunk):
            more = scan(text[at : at + chunk + overlap])
            ahead = dict(zip(accumulate(map(len, more), initial=at), range(len(more)), strict=False))
            end, cut = begin + sum(map(len, own)), None
            for k in range(len(own) - 1, -1, -1):  # from the end of the overlap to its begin
                end -= len(own[k])
                if end <= at:
                    break
                if end in ahead and not text[end - 1].isspace() and (plain or text[end - 1] < "\x80"):
                    cut = k, end
            if cut is None:
                own = scan(text[begin : at + chunk + overlap])
                continue
            done(own[: cut[0]])
            begin, own = cut[1], more[ahead[cut[1]] :]
        done(own)
        return b"".join(out)

    def decode(self, packed: bytes | None) -> bytes:
        packed = packed or b""
        return b"".join(map(self.bytes.__getitem__, struct.unpack(f"<{len(packed) // 4}I", packed)))

    def starts(self, text: str) -> list[int]:
        """Positions where pre-tokens begin, by the library's own pattern semantics."""
        if self.fast and not _BEYOND.search(text):
            return [m.start() for m in _PIECE.finditer(text)]
        import regex

        return [m.start() for m in regex.finditer(self.pattern, text)]


def codec(path: str | None = None, pattern: str | None = None) -> Codec:
    """The codec of a rank file, made once a worker; by default the vocabulary for many languages."""
    import public_tokenizers

    key = (path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), pattern or public_tokenizers.PATTERN)
    return held(("codec", *key), lambda: Codec(*key))


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, pattern: str | None = None, chunk: int = CHUNK, overlap: int = OVERLAP, small: int = SMALL, small_overlap: int = SMALL_OVERLAP, decoded: bool = False) -> DataFrame:
    """id, n_tokens and ids (little-endian unsigned 32-bit integers) of each row; ``decoded`` adds bytes, what the ids decode to.

    The worker that encodes a text then decodes its ids, too: a step of its own would take a second worker a task, with a vocabulary.
    """
    docs = df.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    long = F.char_length("text") > chunk + overlap

    def make():
        own = codec(path, pattern)

        def run(texts):
            ids = [own.encode_chunks(t, small, small_overlap) for t in texts]
            return [ids, [own.decode(x) for x in ids]] if decoded else [ids]

        return run

    made = ["ids", "bytes"] if decoded else ["ids"]
    short = append_columns(docs.filter(~long), ["text"], ["id"], [(c, T.BinaryType()) for c in made], make)
    rest = _encode_long(docs.filter(long), path, pattern, chunk, overlap)
    out = short.unionByName(decode(rest, ["id", "ids"], path=path, pattern=pattern) if decoded else rest)
    return out.select("id", (F.length("ids") / 4).cast("long").alias("n_tokens"), *made)


def _encode_long(docs: DataFrame, path, pattern, chunk, overlap) -> DataFrame:
    """ids of long texts, equal rows once: chunks are scanned apart, stitched with their neighbours, and encoded apart."""
    rows = docs.groupBy("id", "text").count()
    starts = F.sequence(F.lit(0), F.ceil(F.char_length("text") / chunk).cast("int") - 1)
    parts = F.transform(starts, lambda i: F.substr("text", (i * chunk + 1).cast("int"), F.lit(chunk + overlap)))
    parts = rows.select("id", F.sha2("text", 256).alias("digest"), "count", F.posexplode(parts).alias("at", "part")).repartition("id", "digest", "at")

    def scan():
        work = codec(path, pattern)

        def run(texts):
            first, last = [], []
            for text in texts:
                plain = not _BEYOND.search(text)
                fit = [p for p in work.starts(text) if p and not text[p - 1].isspace() and (plain or text[p - 1] < "\x80")]
                first.append([p for p in fit if p < overlap])
                last.append([p - chunk for p in fit if p > chunk])
            return [first, last]

        return run

    places = T.ArrayType(T.IntegerType())
    scanned = append_columns(parts, ["part"], parts.columns, [("first", places), ("last", places)], scan)
    order = Window.partitionBy("id", "digest").orderBy("at")
    cut = F.array_min(F.array_intersect("last", F.lead("first").over(order)))
    cut = scanned.withColumn("end", cut).withColumn("more", F.lead("at").over(order).isNotNull())
    cut = cut.withColumn("begin", F.lag("end").over(order)).withColumn("piece", F.sum(F.when(F.col("begin").isNotNull(), 1).otherwise(0)).over(order))
    upto = F.when(F.col("end").isNotNull(), chunk + F.col("end")).when(F.col("more"), chunk).otherwise(chunk + overlap)
    begin = F.coalesce("begin", F.lit(0))
    cut = cut.select("id", "digest", "count", "at", "piece", F.substr("part", begin + 1, upto - begin).alias("part"))

    def make():
        work = codec(path, pattern).encode
        return lambda texts: [[work(t) for t in texts]]

    ordered = lambda name, *by: F.transform(F.array_sort(F.collect_list(F.struct(*by, name))), lambda x: x[name])
    keys = ["id", "digest", "count", "piece"]
    pieces = cut.repartition(*keys).groupBy(*keys).agg(F.array_join(ordered("part", "at"), "").alias("part"))
    packed = append_columns(pieces, ["part"], keys, [("ids", T.BinaryType())], make)
    whole = packed.groupBy("id", "digest", "count").agg(F.unhex(F.array_join(F.transform(ordered("ids", "piece"), F.hex), "")).alias("ids"))
    return whole.select("id", "ids", F.explode(F.sequence(F.lit(1).cast("long"), "count"))).select("id", "ids")


def decode(df: DataFrame, keep: list[str], ids_col: str = "ids", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """The kept columns and bytes, the concatenated bytes of each row's ids; they needn't be valid UTF-8 if the ids are cut."""

    def make():
        work = codec(path, pattern).decode
        return lambda packed: [[work(p) for p in packed]]

    return append_columns(df, [ids_col], keep, [("bytes", T.BinaryType())], make)
