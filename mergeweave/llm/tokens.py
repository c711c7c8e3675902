"""Token ids as fixed-width bits.

A shard is a run of documents in order. Its image holds a header, the offset of
each block of ids, and the blocks: every id takes the minimum number of bits for
the vocabulary, most significant bit first, and a block of 1,024 ids starts at a
whole byte. So numpy unpacks any block alone, and any document of a shard can be
read without the others. Images are rows of a Parquet table, which Spark's
writers commit task by task in any store; ``dump`` gives plain files.

Image: b"MWTK", u8 version, u8 width, u16 ids in a block / 8, u64 ids,
u32 blocks, (blocks + 1) x u64 byte offsets into the payload, payload.
"""

from __future__ import annotations

import struct
import zlib
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import slices, stored, texts_of

BLOCK = 1024
END = 2
_HEAD = struct.Struct("<4sBBHQI")
#: A shard is closed once it has so many ids (a longer document makes a longer shard).
SHARD = 1 << 20
#: Different parts of texts whose ids a worker keeps, and half as many pieces of them.
CACHE = 400_000


def width_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """The image of ``ids``; each must be below 2 ** width, with width 1 to 32."""
    ids = np.asarray(ids, dtype=np.uint32)
    if width < 32 and len(ids) and int(ids.max()) >> width:
        raise ValueError(f"an id needs more than {width} bits")
    blocks = -(-len(ids) // BLOCK)
    offsets = np.minimum(np.arange(blocks + 1, dtype=np.int64) * (BLOCK * width // 8), -(-len(ids) * width // 8))
    body = []
    for at in range(0, len(ids), BLOCK * 64):
        octets = ids[at : at + BLOCK * 64].astype(">u4").view(np.uint8).reshape(-1, 4)
        body.append(octets[:, 2:].tobytes() if width == 16 else np.packbits(np.unpackbits(octets, axis=1)[:, 32 - width :]).tobytes())
    return _HEAD.pack(b"MWTK", 1, width, BLOCK // 8, len(ids), blocks) + offsets.astype("<u8").tobytes() + b"".join(body)


class Shard:
    """Random access to the ids of an image."""

    def __init__(self, image: bytes):
        magic, version, self.width, eighth, self.ids, self.blocks = _HEAD.unpack_from(image)
        if magic != b"MWTK" or version != 1:
            raise ValueError("not an image of token ids")
        self.block = eighth * 8
        self.offsets = np.frombuffer(image, dtype="<u8", count=self.blocks + 1, offset=_HEAD.size).astype(np.int64)
        self.payload = memoryview(image)[_HEAD.size + 8 * (self.blocks + 1) :]

    def read(self, start: int, count: int) -> np.ndarray:
        """Ids ``start`` to ``start + count``; only the blocks that hold them are unpacked."""
        count = min(count, self.ids - start)
        if count <= 0:
            return np.zeros(0, dtype=np.uint32)
        first, last = start // self.block, (start + count - 1) // self.block
        raw = np.frombuffer(self.payload[self.offsets[first] : self.offsets[last + 1]], dtype=np.uint8)
        n = min((last + 1) * self.block, self.ids) - first * self.block
        if self.width == 16:
            out = raw.view(">u2")[:n].astype(np.uint32)
        else:
            bits = np.unpackbits(raw)[: n * self.width].reshape(n, self.width)
            out = np.packbits(np.concatenate([np.zeros((n, 32 - self.width), dtype=np.uint8), bits], axis=1), axis=1).view(">u4")[:, 0].astype(np.uint32)
        return out[start - first * self.block :][:count]


#: White space that a text which is cut may not hold, beside pairs of spaces or line feeds.
_ODD = [" " * 2, " \n", "\n ", "\n\n", *"\t\r\x0b\x0c\x1c\x1d\x1e\x1f"]
_ODD_WIDE = [*"\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000", *map(chr, range(0x2000, 0x200B))]


#: Fixed value: how byte-level tokenizers of this kind cut a text into pieces.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class _Known(dict):
    """Ids of parts; those not known yet are encoded, and kept while there is room."""

    def __init__(self, encode, room: int):
        super().__init__()
        self.encode, self.room = encode, room

    def __missing__(self, part: str) -> bytes:
        ids = self.encode(part)
        if len(self) < self.room:
            self[part] = ids
        return ids


class Encoder:
    """Encodes whole texts with a byte-level BPE of the tokenizers library.

    Such a tokenizer cuts a text into pieces that its model encodes one by one,
    and always cuts before a line feed, after it, and before a space, where
    these stand alone between characters that are not white space. So a text
    without other white space is cut there, each part is cut into pieces and
    goes through the library's model once, and its ids are kept. All other texts,
    those that hold a special token such as ``<|endoftext|>`` among them, are
    encoded whole. Results are those of encoding whole texts (tests compare
    them). Only for tokenizers whose pre-tokenizer cuts by ``PIECES``.
    """

    def __init__(self, path: str, cache: int = CACHE):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        #: Contents of tokens that the library looks for before it cuts.
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        model, pieces = self.tokenizer.model.tokenize, regex.compile(PIECES).findall
        # the byte-level alphabet: printable Latin-1 characters stand for themselves, other bytes for U+0100 on
        own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
        letters = dict(zip([b for b in range(256) if b not in own], range(0x100, 0x200), strict=False))
        space = chr(letters[0x20])

        def of_piece(piece: str) -> bytes:
            plain = piece.isascii() and piece.isprintable()
            return array("I", [t.id for t in model(piece.replace(" ", space) if plain else piece.encode().decode("latin-1").translate(letters))]).tobytes()

        known = _Known(of_piece, cache // 2)

        def of_part(part: str) -> bytes:
            """A part that begins with a line feed stands for itself, any other for itself after a space; of letters alone it is one piece."""
            if part.isascii() and part.isalpha():
                return known[" " + part]
            return b"".join([known[p] for p in pieces(part if part[:1] == "\n" else " " + part)])

        self.known = _Known(of_part, cache)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        out, ids_of = [], self.known.__getitem__
        for text in texts:
            if not text or text[0] in " \n" or text[-1] in " \n" or any(c in text for c in _ODD) or any(c in text for c in self.added) or not text.isascii() and any(c in text for c in _ODD_WIDE):
                out.append(array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes())
            else:
                # the line feed before the first part is one id of four bytes
                out.append(b"".join(map(ids_of, f"\n{text}".replace("\n", " \n")[1:].split(" ")))[4:])
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for each worker process; what it has encoded serves the tasks that follow."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


_SHARDS = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("n_ids", pa.int64()), ("image", pa.binary())])
_SHARDS_DDL = "part int, seq int, doc_ids array<long>, counts array<long>, n_ids long, image binary"


def shards(docs: DataFrame, path: str, vocabulary: int, end: int | None = END, ordered: bool = True, shard: int = SHARD) -> DataFrame:
    """The texts of ``docs(doc_id, text, ...)`` as a stored table of shards ``(part, seq, doc_ids, counts, n_ids, image)``.

    ordered: by ascending doc_id (null first; equal ids by a hash of the text, then by text), else in the
    order in which Spark reads the rows. (part, seq) is the order of shards.
    Every document ends with the id ``end`` if there is one. A null text counts
    as empty. Rows that repeat are written as often. An empty table gives none.
    path: the tokenizer's file, the same on every machine.
    """
    width = width_for(max(vocabulary, (end or 0) + 1))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    if ordered:
        # the hash lets rows that share a doc_id, or have none, go to several parts
        rows = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")

    def run(batches):
        part, seq = TaskContext.get().partitionId(), 0
        encode = encoder(path).encode
        tail = b"" if end is None else np.array([end], dtype="<u4").tobytes()
        ids, docs_, counts, held = [], [], [], 0

        def close():
            image = pack(np.frombuffer(b"".join(ids), dtype="<u4"), width)
            return pa.RecordBatch.from_pylist([{"part": part, "seq": seq, "doc_ids": docs_, "counts": counts, "n_ids": held, "image": image}], schema=_SHARDS)

        for batch in batches:
            for piece in slices(batch, "text"):
                for doc, own in zip(piece.column(0).to_pylist(), encode(texts_of(piece.column(1))), strict=True):
                    ids += (own, tail)
                    docs_.append(doc)
                    counts.append((len(own) + len(tail)) // 4)
                    held += counts[-1]
                    if held >= shard:
                        yield close()
                        ids, docs_, counts, held, seq = [], [], [], 0, seq + 1
        if docs_:
            yield close()

    return stored(rows.mapInArrow(run, _SHARDS_DDL), "shards")


def read_back(table: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of each document, from the images of a table of shards.

    start counts the ids of all documents before it. The only thing that meets
    in one place is a number for each part. Rows that were written from a null or
    empty text have the end id alone; rows that repeat, or lack a doc_id, each
    have a result. A document of any length lies in one shard. An empty table gives an empty result.
    """
    from pyspark.sql import Window

    sums = table.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = sums.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    inside = table.select("part", "seq", "n_ids").select(
        "part", "seq", (F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_ids")).alias("inner")
    )
    starts = inside.join(parts, "part").select("part", "seq", (F.col("before") + F.col("inner")).alias("base"))

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                counts = np.array(row["counts"], dtype=np.int64)
                image, at = Shard(row["image"]), np.cumsum(counts) - counts
                ids = image.read(0, image.ids).astype("<u4")
                crc = [zlib.crc32(ids[a : a + n]) for a, n in zip(at, counts, strict=True)]
                yield pa.record_batch(
                    [pa.array([row["part"]] * len(at), pa.int32()), pa.array([row["seq"]] * len(at), pa.int32()), pa.array(row["doc_ids"], pa.int64()), pa.array(at), pa.array(counts), pa.array(crc, pa.int64())],
                    ["part", "seq", "doc_id", "at", "n_tokens", "ids_crc32"],
                )

    digests = table.select("part", "seq", "doc_ids", "counts", "image").mapInArrow(run, "part int, seq int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return digests.join(starts, ["part", "seq"]).select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def dump(table: DataFrame, folder: str) -> None:
    """Write each image as ``<part>-<seq>.mwtk`` to a folder that all executors share."""
    import os

    def write(rows):
        for row in rows:
            to = f"{folder}/{row['part']:06d}-{row['seq']:06d}.mwtk"
            with open(f"{to}.{os.getpid()}", "wb") as f:
                f.write(row["image"])
            os.replace(f.name, to)

    os.makedirs(folder, exist_ok=True)
    table.select("part", "seq", "image").foreachPartition(write)
