"""WARC archives in seekable Zstandard bundles: written, indexed, read back and looked up by record.

Pages with equal payloads of ``SMALLEST`` bytes or more are stored once: the record with the smallest id is a
response, the others are revisits that name it. Which pages repeat is decided by a map-side aggregate over payload
digests; only repeated digests are joined back to the pages.

Each task streams its pages into bundles in the shared folder and returns one index row per record: record id, file,
frame, offset in the frame, length. A task holds one frame and one record at most. Bundle names carry a fresh
identifier, and only the files named by the staged index count, so a task that runs twice does no harm.
Reading back cuts the work by frame: the seek table of each bundle gives byte ranges, a task reads its frames alone.

Defined cases: a null payload is empty; a null id sorts last, writes an empty record id and is read back as null;
rows that repeat the smallest id of their group are all responses; a null url has no target header, and control
characters in a url are percent-encoded; a payload longer than a frame has a frame of its own; an empty table writes
no bundle and gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm import warc
from tributary.llm.common import stage
from tributary.session import scratch_path

#: Payloads below this length are always stored.
SMALLEST = 100
FRAME = 256 * 1024
#: Compressed bytes after which a task begins another bundle.
BUNDLE = 64 * 1024 * 1024
DATE = "1970-01-01T00:00:00Z"
#: Uncompressed bytes of frames that one reading task takes.
READ_BYTES = 128 * 1024 * 1024
#: Record ids of pages.
NAME = "urn:page:"

INDEX = "record_id string, file string, frame long, offset long, length long"
READ = "record_id string, record_type string, refers_to string, payload_digest string, payload_bytes long, url string, payload binary, file string, frame long, offset long"


def _filesystem(path: str):
    """The Arrow file system of a path or URI and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def with_revisits(pages: DataFrame, page_id: str = "page_id", payload: str = "html", url: str = "url") -> DataFrame:
    """``page_id``, ``url``, ``payload``, ``digest`` and ``first``, the id of the response with that payload."""
    data = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    light = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), data.alias("payload"))
    digested = light.withColumn("digest", F.sha2("payload", 256))
    # min() leaves nulls out, so a null id is first only among nulls; a group is kept where a row might revisit another.
    repeated = (
        digested.filter(F.octet_length("payload") >= SMALLEST)
        .groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("copies"))
        .filter("copies > 1").select("digest", "first")
    )
    return digested.join(repeated, "digest", "left")


def write_archives(records: DataFrame, folder: str, frame_size: int = FRAME, bundle_size: int = BUNDLE, date: str = DATE) -> DataFrame:
    """Write the rows of ``with_revisits`` as bundles below ``folder``; the staged index of what was written."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _filesystem(folder)
        fs.create_dir(base, recursive=True)
        name = sink = bundle = None
        for batch in batches:
            rows = []
            for own, url, payload, digest, first in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "first"))):
                if bundle is None:
                    name = f"{uuid.uuid4().hex}.warc.zst"
                    sink = fs.open_output_stream(f"{base}/{name}", compression=None)
                    bundle = warc.Bundle(sink.write, frame_size)
                kind = "response" if first is None or own == first else "revisit"
                record_id = NAME + ("" if own is None else str(own))
                data = warc.record(kind, record_id, payload, digest, len(payload), url, f"{NAME}{first}", date)
                rows.append((record_id, name, *bundle.add(data)))
                if bundle.written >= bundle_size:
                    bundle.close()
                    sink.close()
                    bundle = None
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()])],
                ["record_id", "file", "frame", "offset", "length"],
            )
        if bundle is not None:
            bundle.close()
            sink.close()

    return stage(records.select("page_id", "url", "payload", "digest", "first").mapInArrow(write, INDEX), "warc-index")


def _frames_of(folder: str, with_payload: bool):
    """Read the wanted frames of bundles; rows name a file and a frame."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _filesystem(folder)
        name = file = table = None
        for batch in batches:
            for wanted, frame in zip(batch.column("file").to_pylist(), batch.column("frame").to_pylist()):
                if wanted != name:
                    if file is not None:
                        file.close()
                    name, file = wanted, fs.open_input_file(f"{base}/{wanted}")
                    table = warc.seek_table(file)
                out = []
                for r in warc.records(warc.read_frame(file, table[frame])):
                    kind, digest = r.headers["WARC-Type"], r.headers["WARC-Payload-Digest"].removeprefix("sha256:")
                    if kind == "response" and hashlib.sha256(r.payload).hexdigest() != digest:
                        raise ValueError(f"payload of {r.headers['WARC-Record-ID']} does not match its digest")
                    refers = r.headers.get("WARC-Refers-To")
                    out.append((
                        r.headers["WARC-Record-ID"].strip("<>"), kind, refers.strip("<>") if refers else None, digest, r.length,
                        r.headers.get("WARC-Target-URI"), r.payload if with_payload and kind == "response" else None, name, frame, r.offset,
                    ))
                types = [pa.string()] * 4 + [pa.int64(), pa.string(), pa.binary(), pa.string(), pa.int64(), pa.int64()]
                names = [f.split()[0] for f in READ.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
        if file is not None:
            file.close()

    return read


def read_archives(index: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """All records of the bundles that ``index`` names, a row each; responses are checked against their digests."""
    frames = index.groupBy("file", "frame").agg(F.sum("length").alias("length"))
    # The rows are tiny and the work behind them is not, so the number of tasks follows the bytes to be read.
    tasks = (frames.agg(F.sum("length")).first()[0] or 0) // READ_BYTES + 1
    ordered = frames.repartition(tasks, "file", "frame").sortWithinPartitions("file", "frame").select("file", "frame")
    return ordered.mapInArrow(_frames_of(folder, with_payload), READ)


def look_up(index: DataFrame, folder: str, record_ids: DataFrame) -> DataFrame:
    """The named records (column ``record_id``), reading only the frames that hold them."""
    places = index.join(record_ids.select("record_id").distinct(), "record_id", "left_semi")
    found = read_archives(places, folder)
    return found.join(places.select("file", "frame", "offset"), ["file", "frame", "offset"], "left_semi")


def page_ids(records: DataFrame) -> DataFrame:
    """Digest columns of records read back: one row per record."""
    ids = {n: F.nullif(F.substring(c, len(NAME) + 1, 1 << 20), F.lit("")).cast("long") for n, c in (("page_id", "record_id"), ("refers_to", "refers_to"))}
    return records.select(
        ids["page_id"].alias("page_id"), "payload_bytes", "payload_digest", "record_type", ids["refers_to"].alias("refers_to")
    )


def archived(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write every page, read the archives back and say what they hold."""
    folder = scratch_path(spark, "warc")
    index = write_archives(with_revisits(pages), folder)
    return page_ids(read_archives(index, folder, with_payload=False))
