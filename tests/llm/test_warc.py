import hashlib
import uuid

import pytest
from pyspark.sql import functions as F

from mergeweave.llm import warc
from mergeweave.llm.queries import op13_warc

LONG = "<html>" + "é\U0001f600 text " * 30


def brute(rows):
    payloads = [(i, (h or "").encode()) for i, _, h in rows]
    out, done = [], set()
    first = {}
    for i, p in payloads:
        if len(p) >= 100 and i is not None:
            first[p] = min(first.get(p, i), i)
    for i, p in sorted(payloads, key=lambda x: (x[0] is None, x[0] or 0)):
        ref = first.get(p)
        whole = ref is None or (i == ref and p not in done)
        if i == ref:
            done.add(p)
        out.append((i, len(p), hashlib.sha256(p).hexdigest(), "response" if whole else "revisit", None if whole else ref))
    return sorted(out, key=str)


ROWS = [
    (5, "http://a/x", LONG), (3, "http://a/y\r\nWARC-Type: bad", LONG), (3, "http://a/y\r\nWARC-Type: bad", LONG), (3, "http://a/y\r\nWARC-Type: bad", LONG), (3, None, LONG), (9, "u", LONG + "!"), (None, "v", LONG), (None, "v", "n" * 200), (None, "v", "n" * 200),
    (1, "s", "short"), (2, "s", "short"), (2, "s", "short"), (4, None, None), (6, "", ""), (7, "w", "\r\n\r\nWARC/1.1\r\n\r\n" * 20), (8, "w", "\r\n\r\nWARC/1.1\r\n\r\n" * 20), (10, "b", "x" * 3_000_000), (11, "b", "x" * 3_000_000),
    (12, "e", "a" * 99), (13, "e", "a" * 99), (14, "e", "a" * 100), (15, "e", "a" * 100), (-1, "e", "a" * 100),
]


def table(spark, rows, parts=4):
    return spark.createDataFrame([(*r, "x", "y", 1) for r in rows], "page_id long, url string, html string, kind string, digest string, size long").repartition(parts)


def shown(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("bound", [None, 0])
def test_as_by_brute_force(spark, monkeypatch, bound):
    if bound is not None:  # too many groups for a broadcast
        monkeypatch.setattr(warc, "BROADCAST_GROUPS", bound)
    assert shown(warc.revisits(warc.bundles(table(spark, ROWS)))) == brute(ROWS)


def test_payloads_and_references(spark):
    made = warc.bundles(table(spark, ROWS))
    rows = warc.records(made).collect()
    by_id = {r.record_id: r for r in rows}
    assert len(by_id) == len(rows) == len(ROWS)
    for r in rows:
        assert "\n" not in r.url and r.url
        if r.record_type == "revisit":
            to = by_id[r.refers_to_record]
            assert r.payload is None and to.page_id == r.refers_to and to.record_type == "response" and to.payload_digest == r.payload_digest
        else:
            assert hashlib.sha256(r.payload).hexdigest() == r.payload_digest


def test_random_access_and_files(spark, tmp_path):
    pages = table(spark, [(i, "u", f"{i} " * (i * 7 % 900)) for i in range(300)], 3)
    made = warc.bundles(pages, frame=4000, bundle=4000)
    assert made.count() > 3
    warc.dump(made, str(tmp_path / "w"))
    loaded = warc.load(spark, f"file://{tmp_path}/w")
    assert shown(warc.revisits(loaded)) == shown(warc.revisits(made))
    all_ = {r.record_id: r for r in warc.records(made).collect()}
    some = sorted(all_)[::17]
    wanted = spark.createDataFrame([(i,) for i in [*some, some[0], str(uuid.uuid4())]], "record_id string")
    got = {r.record_id: r for r in warc.fetch(loaded, wanted).collect()}
    assert got == {i: all_[i] for i in some}
    assert warc.index(made).agg(F.max("frame")).first()[0] >= 1


def test_frames_are_independent_and_checked():
    w = warc.Writer()
    own = [uuid.uuid4() for _ in range(5)]
    raws = [warc.record("response", o, k, "u", hashlib.sha256(b"p" * k).digest(), k, b"p" * k, None, "d") for k, o in enumerate(own)]
    for k, (o, raw) in enumerate(zip(own, raws, strict=True)):
        w.add(o, raw)
        if k % 2:
            w._close_frame()
    image = w.image()
    b = warc.Bundle(image)
    assert [b.read(k) for k in range(5)] == raws and len(b.seeks) == 4
    # a plain decompressor of the format reads all frames, and passes over index and table
    import io

    import zstandard

    assert zstandard.ZstdDecompressor().stream_reader(io.BytesIO(image), read_across_frames=True).read() == b"".join(raws)
    # damage of one frame leaves the others readable
    bad = bytearray(image)
    bad[int(b.starts[1]) + 12] ^= 0xFF
    again = warc.Bundle(bytes(bad))
    assert again.read(0) == raws[0] and again.read(4) == raws[4]
    with pytest.raises((ValueError, zstandard.ZstdError)):
        again.frame(1)


def test_hot_payload_and_hot_row(spark):
    rows = [(k, "u", LONG) for k in range(2000)] + [(0, "u", LONG)] * 1500 + [(k, "u", f"{k}" * 100) for k in range(10, 500)]
    assert shown(warc.revisits(warc.bundles(table(spark, rows, 6)))) == brute(rows)


def test_empty_and_given_table(spark, data):
    assert warc.revisits(warc.bundles(table(spark, []).limit(0))).count() == 0
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/pages.parquet").select("page_id", "url", "html").collect()]
    assert shown(op13_warc(spark, data)) == brute(rows)
