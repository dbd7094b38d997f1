"""Archives: exact round trips, the container's layout, lookups by record."""

import hashlib
import io
import os

import pytest
import zstandard

from tributary.llm import archive, warc
from tributary.session import scratch_path


def plain(rows):
    first = {}
    for i, html in rows:
        data = (html or "").encode()
        if len(data) >= 100:
            first.setdefault(data, []).append(i)
    out = []
    for i, html in rows:
        data = (html or "").encode()
        known = [x for x in first.get(data, []) if x is not None]
        least = min(known, default=None)
        kind = "response" if least is None or i == least else "revisit"
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), kind, least if kind == "revisit" else None))
    return sorted(out, key=repr)


def got(df):
    return sorted(map(tuple, df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr)


def test_whole_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    assert got(archive.archived(spark, pages)) == plain([tuple(r) for r in pages.select("page_id", "html").collect()])


@pytest.fixture(scope="module")
def odd_pages(spark):
    body, other = "<p>é\r\n\r\nWARC/1.1\r\n</p>" * 9, "x" * 100
    rows = [
        (5, "http://a/\r\nX: 1", body, True), (3, None, body, None), (3, "http://b", body, False), (None, "http://c", body, None), (9, "", body, None),
        (1, "u", other, None), (2, "u", other, None), (4, "u", "x" * 99, None), (6, "u", "x" * 99, None), (7, None, None, None), (8, "u", "", None),
        (None, "u", "y" * 200, None), (None, "v", "y" * 200, None), (10, "w", "long " * 300_000, None), (11, "w", "\x00\x85  é", None),
    ]
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest boolean").repartition(3).cache()


def test_odd_pages(spark, odd_pages):
    rows = [tuple(r) for r in odd_pages.select("page_id", "html").collect()]
    assert got(archive.archived(spark, odd_pages)) == plain(rows)
    assert got(archive.archived(spark, odd_pages.limit(0))) == []


def test_payloads_come_back_whole_from_many_bundles(spark, odd_pages):
    folder = scratch_path(spark, "warc")
    index = archive.write_archives(archive.with_revisits(odd_pages), folder, frame_size=256, bundle_size=512)
    assert index.select("file").distinct().count() > 3
    read = archive.read_archives(index, folder).collect()
    stored = sorted(bytes(r["payload"]) for r in read if r["record_type"] == "response")
    kept = {(r["page_id"], r["html"] or "") for r in odd_pages.collect()}
    assert set(stored) == {h.encode() for _, h in kept}
    assert sorted((r["record_id"], r["file"], r["frame"], r["offset"]) for r in read) == sorted(
        (r["record_id"], r["file"], r["frame"], r["offset"]) for r in index.collect()
    )


def test_lookup_reads_the_named_records(spark, odd_pages):
    folder = scratch_path(spark, "warc")
    index = archive.write_archives(archive.with_revisits(odd_pages), folder, frame_size=256)
    wanted = spark.createDataFrame([("urn:page:9",), ("urn:page:10",), ("urn:page:77",), ("urn:page:9",)], "record_id string")
    found = {r["record_id"]: r for r in archive.look_up(index, folder, wanted).collect()}
    assert set(found) == {"urn:page:9", "urn:page:10"}
    assert found["urn:page:9"]["refers_to"] == "urn:page:3" and found["urn:page:9"]["payload"] is None
    assert bytes(found["urn:page:10"]["payload"]) == ("long " * 300_000).encode()


def test_container_opens_with_any_zstandard_reader_and_by_its_table(tmp_path):
    out = io.BytesIO()
    bundle = warc.Bundle(out.write, frame_size=1000)
    data = [warc.record("response", f"urn:{i}", b"p" * i, "d", i, None, None, "1970-01-01T00:00:00Z") for i in range(0, 900, 90)]
    places = [bundle.add(d) for d in data]
    bundle.close()
    # The skippable frame holds no data, so a plain reader sees the records one after another.
    plain_reader = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(out.getvalue()), read_across_frames=True)
    assert plain_reader.read() == b"".join(data)
    table = warc.seek_table(out)
    assert len(table) > 2 and sum(t[2] for t in table) == sum(map(len, data))
    for d, (frame, offset, length) in zip(data, places):
        assert warc.read_frame(out, table[frame])[offset : offset + length] == d
    assert [r.length for t in table for r in warc.records(warc.read_frame(out, t))] == list(range(0, 900, 90))
    with pytest.raises(ValueError):
        warc.seek_table(io.BytesIO(b"0" * 50))


def test_a_damaged_payload_is_an_error(spark):
    pages = spark.createDataFrame([(1, "u", "z" * 500)], "page_id long, url string, html string")
    folder = scratch_path(spark, "warc")
    bad = archive.with_revisits(pages).withColumn("digest", archive.F.lit("0" * 64))
    index = archive.write_archives(bad, folder)
    with pytest.raises(Exception, match="does not match its digest"):
        archive.read_archives(index, folder).collect()
    assert len(os.listdir(folder)) == 1
