"""Web pages as WARC records in seekable Zstandard bundles.

Each page becomes one WARC 1.1 record. Of pages with equal payloads the one with
the smallest id is a ``response``; the others are ``revisit`` records that name
it and carry no payload. Records go into bundles as they are read, without a
shuffle of their texts. A bundle is a series of independent Zstandard frames, a
skippable frame that maps record ids to (frame, offset in the frame, length),
and a skippable frame with the seek table of the public seekable format, whose
last bytes say where all frames begin. So one record is read by decompressing
one frame. Bundles are rows of a Parquet table, which Spark's committer writes in
any store; ``dump`` and ``load`` exchange them with plain files.
"""

from __future__ import annotations

import hashlib
import struct
import uuid

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import slices, stored

#: A frame is closed once its records have so many bytes, a bundle once its frames have (a longer record makes a longer one).
FRAME, BUNDLE = 1 << 20, 16 << 20
#: Payloads below so many bytes are never revisited.
LEAST = 100
#: Up to so many groups of equal payloads (100 bytes each) go to all tasks; beyond, they are joined by a shuffle.
BROADCAST_GROUPS = 200_000
#: Fixed values of the seekable format and of this index.
_SKIPPABLE, _SEEK, _MAGIC, _INDEX = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, b"MWWI"
_ENTRY = np.dtype([("id", "V16"), ("frame", "<u4"), ("offset", "<u4"), ("length", "<u4")])
_SEEKS = np.dtype([("packed", "<u4"), ("plain", "<u4"), ("check", "<u4")])
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ODD = {c: f"%{c:02X}" for c in [*range(33), 127]}


def record_id(page_id: int | None, url: bytes, digest: bytes, nth: str = "first") -> uuid.UUID:
    """Of the first page with a payload it follows from the page alone, so a revisit can name it; nth tells others apart."""
    said = b"|".join([str(page_id).encode(), url, digest, nth.encode()])
    return uuid.UUID(bytes=hashlib.sha256(said).digest()[:16], version=5)


def record(kind: str, own: uuid.UUID, page_id: int | None, url: str | None, digest: bytes, size: int, payload: bytes, refers: tuple[uuid.UUID, int] | None, date: str) -> bytes:
    """The bytes of one record. Control characters and white space of a url are percent-encoded, a missing url is the record's id."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = head if kind == "revisit" else head + payload
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<{own.urn}>"), ("WARC-Date", date), ("WARC-Target-URI", url.translate(_ODD) if url else own.urn), ("WARC-Payload-Digest", f"sha256:{digest.hex()}")]
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if refers is not None:
        fields += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", f"<{refers[0].urn}>"), ("X-Refers-To-Page-ID", str(refers[1]))]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return "".join(["WARC/1.1\r\n", *[f"{k}: {v}\r\n" for k, v in fields], "\r\n"]).encode("utf-8", "replace") + block + b"\r\n\r\n"


def _skippable(magic: int, body: bytes) -> bytes:
    return struct.pack("<II", magic, len(body)) + body


class Writer:
    """Frames of one bundle."""

    def __init__(self, frame: int = FRAME, level: int = 3):
        self.limit = frame
        self.compressor = zstandard.ZstdCompressor(level=level, write_content_size=True)
        self.frames, self.seeks, self.entries = [], [], []
        self.held, self.plain, self.size = [], 0, 0

    def add(self, own: uuid.UUID, raw: bytes) -> None:
        self.entries.append((own.bytes, len(self.frames), self.plain, len(raw)))
        self.held.append(raw)
        self.plain += len(raw)
        if self.plain >= self.limit:
            self._close_frame()

    def _close_frame(self) -> None:
        raw = b"".join(self.held)
        packed = self.compressor.compress(raw)
        self.frames.append(packed)
        self.seeks.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.size += len(packed)
        self.held, self.plain = [], 0

    def image(self) -> bytes:
        if self.held:
            self._close_frame()
        index = _skippable(_SKIPPABLE, _INDEX + np.array(self.entries, dtype=_ENTRY).tobytes())
        # the index is an entry of the table too, as readers of the format add up sizes of frames
        seeks = np.array([*self.seeks, (len(index), 0, 0)], dtype=_SEEKS)
        footer = struct.pack("<IBI", len(seeks), 0x80, _MAGIC)
        return b"".join([*self.frames, index, _skippable(_SEEK, seeks.tobytes() + footer)])


class Bundle:
    """Random access to the records of an image."""

    def __init__(self, image: bytes):
        self.image = memoryview(image)
        n, flags, magic = struct.unpack("<IBI", self.image[-9:])
        if magic != _MAGIC or not flags & 0x80:
            raise ValueError("not a seekable bundle with checksums")
        seeks = np.frombuffer(self.image[-9 - n * _SEEKS.itemsize : -9], dtype=_SEEKS)
        self.seeks, self.starts = seeks, np.cumsum(seeks["packed"].astype(np.int64)) - seeks["packed"]
        index = self.image[int(self.starts[-1]) :][: int(seeks["packed"][-1])]
        if bytes(index[8:12]) != _INDEX:
            raise ValueError("a bundle without an index")
        self.entries = np.frombuffer(index[12:], dtype=_ENTRY)

    def frame(self, k: int) -> bytes:
        """Frame ``k``, checked; no other is touched."""
        packed = self.image[int(self.starts[k]) :][: int(self.seeks["packed"][k])]
        raw = zstandard.ZstdDecompressor().decompress(packed, max_output_size=int(self.seeks["plain"][k]))
        if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != int(self.seeks["check"][k]):
            raise ValueError(f"frame {k} is damaged")
        return raw

    def read(self, at: int) -> bytes:
        """The record of entry ``at``."""
        e = self.entries[at]
        return self.frame(int(e["frame"]))[int(e["offset"]) :][: int(e["length"])]


def parsed(raw: bytes) -> dict:
    """A record's fields by lower-case name, and its ``payload``; that of a revisit is None."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if first != "WARC/1.1":
        raise ValueError("not a record")
    out: dict = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}
    block = rest[: int(out["content-length"])]
    if len(rest) != len(block) + 4 or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("a record of another length than it says")
    http, _, payload = block.partition(b"\r\n\r\n")
    out["size"] = int(http.rpartition(b"Content-Length: ")[2])
    out["payload"] = payload if out["warc-type"] == "response" else None
    return out


def planned(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """``(kind, page_id, url, digest, size, html, first_id, first_url, referred)`` of every page's record; html of revisits is null.

    Which payloads are shared is found by digests alone; texts are shuffled only
    if there are too many groups of equal payloads to tell all tasks.
    """
    bits = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    url = F.col("url").cast("string")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), url.alias("url"), bits.alias("html")).select(
        "*", F.unhex(F.sha2("html", 256)).alias("digest"), F.octet_length("html").cast("long").alias("size"), F.unhex(F.sha2(F.coalesce("url", F.lit("")).cast("binary"), 256)).alias("url_sha")
    )
    # equal rows first, then equal payloads; both sum within tasks before anything is sent
    equal = rows.where((F.col("size") >= least) & F.col("page_id").isNotNull()).groupBy("digest", "page_id", "url_sha").agg(F.count("*").alias("n"))
    named = equal.groupBy("digest").agg(F.sum("n").alias("named"), F.min(F.struct("page_id", "url_sha", "n")).alias("first"))
    nameless = rows.where((F.col("size") >= least) & F.col("page_id").isNull()).groupBy("digest").agg(F.count("*").alias("lacking"))
    shared = named.join(nameless, "digest", "left").where("named + coalesce(lacking, 0) > 1")
    groups = stored(shared.select("digest", F.col("first.page_id").alias("first_id"), F.col("first.url_sha").alias("first_url"), F.col("first.n").alias("n_first")), "groups")
    small = groups.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS
    joined = rows.join(F.broadcast(groups) if small else groups, "digest", "left")
    own = (F.col("page_id") == F.col("first_id")) & (F.col("url_sha") == F.col("first_url"))
    alone = F.col("first_id").isNull() | (F.col("size") < least)
    kind = F.when(alone, "response").when(~F.coalesce(own, F.lit(False)), "revisit").when(F.col("n_first") == 1, "response").otherwise("tied")
    marked = joined.withColumn("kind", kind).withColumn("referred", ~alone)
    out = ["page_id", "url", "digest", "size", "html", "url_sha", "first_id", "first_url", "referred"]
    single = marked.where("kind <> 'tied'").withColumn("html", F.when(F.col("kind") == "response", F.col("html")))
    # rows equal in id, url and payload, the first of their group: one of them is the response; the others are made anew, by as many as each task read
    tied = marked.where("kind = 'tied'").withColumn("task", F.spark_partition_id())
    keys = [c for c in out if c != "html"]
    response = tied.groupBy(*keys).agg(F.any_value("html").alias("html")).withColumn("kind", F.lit("response"))
    by_task = tied.groupBy(*keys, "task").agg(F.count("*").alias("n"))
    least_task = by_task.groupBy("digest").agg(F.min("task").alias("least_task"))
    more = by_task.join(least_task, "digest").select(*keys, (F.col("n") - (F.col("task") == F.col("least_task")).cast("long")).alias("n")).where("n > 0")
    again = more.select(*keys, F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).drop("col").withColumn("html", F.lit(None).cast("binary")).withColumn("kind", F.lit("revisit"))
    return single.select("kind", *out).unionByName(response.select("kind", *out)).unionByName(again.select("kind", *out))


_BUNDLES = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("n_records", pa.int32()), ("image", pa.binary())])


def bundles(pages: DataFrame, least: int = LEAST, date: str = "1970-01-01T00:00:00Z", frame: int = FRAME, bundle: int = BUNDLE) -> DataFrame:
    """The records of ``pages(page_id, url, html, ...)`` as a stored table of bundles ``(part, seq, n_records, image)``.

    Of pages with equal payloads of ``least`` bytes or more the one with the
    smallest page_id, then the smallest hash of its url, is the response; the
    others revisit it, rows equal to it among them. Pages without page_id are
    never revisited, unless a page with an id has their payload; then they
    revisit that. A null html is empty; texts of any length are taken whole.
    Each row has its record. Other columns are ignored, whatever their names. An
    empty table gives none. date: WARC-Date of all records, which pages lack. frame,
    bundle: bytes after which these are closed.
    """
    rows = planned(pages, least)

    def run(batches):
        part, seq, k, out = TaskContext.get().partitionId(), 0, 0, Writer(frame)

        def closed():
            return pa.RecordBatch.from_pylist([{"part": part, "seq": seq, "n_records": len(out.entries), "image": out.image()}], schema=_BUNDLES)

        for batch in batches:
            for piece in slices(batch, "html"):
                for r in piece.to_pylist():
                    first = r["referred"] and r["kind"] == "response"
                    own = record_id(r["page_id"], r["url_sha"], r["digest"], "first" if first else f"{part}.{seq}.{k}")
                    refers = (record_id(r["first_id"], r["first_url"], r["digest"]), r["first_id"]) if r["kind"] == "revisit" else None
                    out.add(own, record(r["kind"], own, r["page_id"], r["url"], r["digest"], r["size"], r["html"] or b"", refers, date))
                    k += 1
                    if out.size >= bundle:
                        yield closed()
                        seq, k, out = seq + 1, 0, Writer(frame)
        if out.entries:
            yield closed()

    return stored(rows.mapInArrow(run, "part int, seq int, n_records int, image binary"), "bundles")


def index(table: DataFrame) -> DataFrame:
    """``(part, seq, record_id, frame, offset, length)`` of every record; no frame is decompressed."""

    def run(batches):
        for batch in batches:
            for part, seq, image in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                e = Bundle(image).entries
                same = lambda v: pa.array(np.full(len(e), v, dtype=np.int32))
                ids = pa.array([str(uuid.UUID(bytes=x.tobytes())) for x in e["id"]], pa.string())
                yield pa.record_batch([same(part), same(seq), ids, *[pa.array(e[c].astype(np.int64)) for c in ("frame", "offset", "length")]], ["part", "seq", "record_id", "frame", "offset", "length"])

    return table.select("part", "seq", "image").mapInArrow(run, "part int, seq int, record_id string, frame long, offset long, length long")


_RECORDS = "record_id string, record_type string, page_id long, url string, payload_bytes long, payload_digest string, refers_to long, refers_to_record string, payload binary"
_RECORD_NAMES = [x.split()[0] for x in _RECORDS.split(", ")]
_RECORD_TYPES = [{"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[x.split()[1]] for x in _RECORDS.split(", ")]


def _bare(urn: str | None) -> str | None:
    return urn and urn.strip("<>").rpartition(":")[2]


def _row(raw: bytes, payloads: bool) -> tuple:
    r = parsed(raw)
    digest, payload = r["warc-payload-digest"].removeprefix("sha256:"), r["payload"]
    if payload is not None and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != r["size"]):
        raise ValueError(f"record {r['warc-record-id']} is not what its digest says")
    whole = lambda name: int(r[name]) if name in r else None
    return (_bare(r["warc-record-id"]), r["warc-type"], whole("x-page-id"), r["warc-target-uri"], r["size"], digest, whole("x-refers-to-page-id"), _bare(r.get("warc-refers-to")), payload if payloads else None)


def _batches(rows, limit: int = 8_000_000):
    """Rows as Arrow batches of about ``limit`` bytes of payload, 10,000 rows at most."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[-1] or b"")
        if size >= limit or len(held) >= 10_000:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*held, strict=True), _RECORD_TYPES, strict=True)], _RECORD_NAMES)
            held, size = [], 0
    if held:
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*held, strict=True), _RECORD_TYPES, strict=True)], _RECORD_NAMES)


def records(table: DataFrame, payloads: bool = True) -> DataFrame:
    """All records of a table of bundles, frame by frame, checked against their digests: record_id, record_type, page_id, url,
    payload_bytes and payload_digest (of the full payload, for revisits too), refers_to and refers_to_record, payload (null for revisits, or unless ``payloads``)."""

    def run(batches):
        def rows():
            for batch in batches:
                for image in batch.column(0):
                    b = Bundle(image.as_buffer())
                    for k in range(len(b.seeks) - 1):
                        raw, own = b.frame(k), b.entries[b.entries["frame"] == k]
                        for e in own:
                            yield _row(raw[int(e["offset"]) :][: int(e["length"])], payloads)

        yield from _batches(rows())

    return table.select("image").mapInArrow(run, _RECORDS)


def fetch(table: DataFrame, wanted: DataFrame) -> DataFrame:
    """The records, as ``records`` gives them, that ``wanted(record_id)`` names; only frames that hold one are decompressed. Ids that no record has are left out, repeated ones count once."""
    found = index(table).join(wanted.select("record_id").distinct(), "record_id")
    frames = found.groupBy("part", "seq").agg(F.sort_array(F.collect_list(F.struct("frame", "offset", "length"))).alias("wanted"))

    def run(batches):
        def rows():
            for batch in batches:
                for image, asked in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                    b, k, raw = Bundle(image.as_buffer()), None, b""
                    for e in asked:
                        if e["frame"] != k:
                            k, raw = e["frame"], b.frame(e["frame"])
                        yield _row(raw[e["offset"] :][: e["length"]], True)

        yield from _batches(rows())

    return table.join(frames, ["part", "seq"]).select("image", "wanted").mapInArrow(run, _RECORDS)


def dump(table: DataFrame, folder: str) -> None:
    """Write each bundle as ``<part>-<seq>.warc.zst`` to a folder that all executors share."""
    import os

    def write(rows):
        for row in rows:
            to = f"{folder}/{row['part']:06d}-{row['seq']:06d}.warc.zst"
            with open(f"{to}.{os.getpid()}", "wb") as f:
                f.write(row["image"])
            os.replace(f.name, to)

    os.makedirs(folder, exist_ok=True)
    table.select("part", "seq", "image").foreachPartition(write)


def load(spark: SparkSession, folder: str) -> DataFrame:
    """A table of bundles ``(part, seq, image)`` of the files that ``dump`` wrote, in any store."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    part, seq = (F.regexp_extract("path", r"(\d+)-(\d+)\.warc\.zst$", k).cast("int") for k in (1, 2))
    return files.select(part.alias("part"), seq.alias("seq"), F.col("content").alias("image"))


def revisits(table: DataFrame) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` of each record, read back from the bundles."""
    return records(table, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
