"""Gzipped newline-delimited JSON as lines."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

GLOB = "*.{json,jsonl,ndjson}.gz"


def lines(spark: SparkSession, root: str, glob: str = GLOB) -> DataFrame:
    """``(value, path)`` of all lines below ``root``. Of a damaged file the lines before the damage count."""
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).option("ignoreCorruptFiles", "true").option("lineSep", "\n")
    return reader.text(root).select("value", F.col("_metadata.file_path").alias("path"))


def within_budget(rows: DataFrame, budget: int, line: str = "value") -> DataFrame:
    """Lines of each file up to its ``budget``-th malformed one, in one pass.

    A gzipped file is read by one task, in order, so a counter that goes along
    the lines of a task is all that is needed: nothing is sorted or shuffled.
    ``rows(value, path, ...)`` must come as ``lines`` or ``checked`` give them.
    """
    from ..functions.coerce import parsed

    blank = F.trim(F.col(line)) == ""
    flagged = rows.withColumn("__bad", F.coalesce(~blank & parsed(F.col(line)).isNull(), F.lit(False)))

    def run(batches):
        now, seen = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            path, bad = batch.column(batch.schema.get_field_index("path")), np.asarray(batch.column(batch.schema.get_field_index("__bad")).to_numpy(zero_copy_only=False))
            code = np.asarray(pc.dictionary_encode(path).indices)
            starts = np.concatenate([[0], np.flatnonzero(np.diff(code)) + 1])
            keep = np.empty(len(bad), dtype=bool)
            for at, to in zip(starts, [*starts[1:], len(bad)], strict=True):
                name = path[int(at)].as_py()
                seen = seen if name == now else 0
                now = name
                total = seen + np.cumsum(bad[at:to])
                keep[at:to] = total - bad[at:to] < budget
                seen = int(total[-1])
            yield batch.filter(pa.array(keep)).drop_columns(["__bad"])

    return flagged.mapInArrow(run, rows.schema)


def checked(spark: SparkSession, root: str, glob: str = GLOB) -> DataFrame:
    """``(value, path, damage)`` of all lines below ``root``, as ``lines`` has them, and after those of a damaged file a row without value: ``damage`` has the bytes that came out of it before, and why it ended.

    Files are decompressed by tasks, a piece at a time; a task holds one file as
    it lies in the store, so archives are to be of a size that an executor can hold
    (an hour of events has some 100 MB). Use ``lines`` for others. Files of no
    bytes have no rows, as Spark doesn't open them.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root).select("path", "content")

    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for values, damage in _decompressed(memoryview(content.as_buffer())):
                    n = len(values)
                    yield pa.record_batch([pa.array(values, pa.binary()).cast(pa.binary()), pa.array([path] * n, pa.string()), pa.array([damage] * n, _DAMAGE)], ["raw", "path", "damage"])

    rows = files.mapInArrow(run, "raw binary, path string, damage struct<at: long, reason: string>")
    return rows.select(F.col("raw").cast("string").alias("value"), "path", "damage")


_DAMAGE = pa.struct([("at", pa.int64()), ("reason", pa.string())])


def _fed(member, data: bytes, most: int = 8_000_000):
    """What comes of compressed ``data``, some megabytes at a time."""
    while True:
        out = member.decompress(data, most)
        data = member.unconsumed_tail
        if out:
            yield out
        if member.eof or not data and len(out) < most:
            return


def _plain(content: memoryview, piece: int):
    """All bytes that come out of a gzipped file, then why no more do: None if it is whole."""
    at, member = 0, None
    while at < len(content):
        if member is None:
            if content[at] == 0:  # zeros may pad a file between members
                at += 1
                continue
            member = zlib.decompressobj(31)
        data, before = bytes(content[at : at + piece]), member.copy()
        try:
            # kept until all of the piece was right: it is fed again byte by byte otherwise
            for out in list(_fed(member, data)):
                yield out, None
        except zlib.error:
            member = before
            for k in range(len(data)):
                try:
                    for out in list(_fed(member, data[k : k + 1])):
                        yield out, None
                except zlib.error as e:
                    yield b"", str(e)
                    return
        at += len(data) - len(member.unused_data)
        if member.eof:
            member = None
    yield b"", "truncated" if member is not None else None


def _decompressed(content: memoryview, piece: int = 1 << 18):
    """Lists of complete lines, each with None; after those of a damaged file, [None] and what is known of the damage."""
    made, left, reason = 0, b"", None
    for out, reason in _plain(content, piece):
        made += len(out)
        *done, left = (left + out).split(b"\n")
        if done:
            yield done, None
    if reason is not None:
        yield [None], {"at": made, "reason": reason}
    elif left:
        yield [left], None


def damaged_files(rows: DataFrame) -> DataFrame:
    """``(path, lines, at, reason)`` of each file of ``checked`` that is damaged; lines: how many came out of it."""
    per = rows.groupBy("path").agg(F.count("value").alias("lines"), F.max("damage").alias("damage"))
    return per.where("damage is not null").select("path", "lines", "damage.at", "damage.reason")


def line_statistics(rows: DataFrame, line: str = "value") -> DataFrame:
    """One row: lines that aren't blank, and malformed ones among them."""
    from ..functions.coerce import parsed

    some = F.trim(F.col(line)) != ""
    return rows.where(some).agg(F.count("*").alias("lines"), F.count(F.when(parsed(F.col(line)).isNull(), 1)).alias("bad_lines"))
