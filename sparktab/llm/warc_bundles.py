"""Web pages as WARC records in seekable Zstandard bundles.

A record has a WARC header and an HTTP block. Of pages with equal payloads the one with the
largest page_id is a ``response``; the others are ``revisit`` records that carry the HTTP
header alone and name it. Records of about ``FRAME_BYTES`` make a Zstandard frame of its
own, frames follow each other in a bundle, and a skippable frame with the seek table ends
it, as in the public seekable format: per frame its compressed size, its size and the low
32 bits of the XXH64 of its content. A bundle is therefore a valid ``.warc.zst`` file that
any decompressor reads whole, and any frame can be read alone.

A folder holds one row of a Parquet table per bundle: its name, the bytes and the map from
record identifiers to (frame, offset in the frame, bytes). Spark's own writer commits them,
so lost tasks run again without leaving parts. ``records`` reads all of a folder,
``fetched`` decodes the frames of wanted records only, ``exported`` writes plain files.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktab.llm.common import FILE, ROW, arrow, positions
from sparktab.operators.support import lookup, pinned
from sparktab.session import fresh_path, settled

#: Fixed values of the seekable format.
SKIPPABLE, SEEKABLE, HAS_CHECKSUM = 0x184D2A5E, 0x8F92EAB1, 0x80
SKIP_HEAD, SEEK_ENTRY, SEEK_FOOT = struct.Struct("<II"), struct.Struct("<III"), struct.Struct("<IBI")
FRAME_BYTES, BUNDLE_BYTES = 256 << 10, 16 << 20
DATE = "1970-01-01T00:00:00Z"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BUNDLE = "bundle string, payload binary, ids array<string>, frames array<int>, offsets array<long>, sizes array<long>"
RECORD = "record_id string, record_type string, page_id long, url string, payload_bytes long, payload_digest string, refers_to long, payload binary"
ID = re.compile(r"<urn:page:(-?\d*):")
END = b"\r\n\r\n"


def record_id(page_id: int | None, mark: int) -> str:
    """The identifier of one page's record. ``mark`` tells repeated page_ids apart."""
    return f"<urn:page:{'' if page_id is None else page_id}:{mark % 2**64:016x}>"


def page_of(identifier: str) -> int | None:
    number = ID.match(identifier)[1]
    return int(number) if number else None


def line(text: str) -> str:
    """A header's value: no line may end in it."""
    return re.sub(r"[\r\n]+", " ", text)


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(identifier: str, url: str | None, payload: bytes, refers_to: str | None = None, date: str = DATE) -> bytes:
    """A response's bytes, or a revisit's if ``refers_to`` names a response with this payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}".encode() + END
    block = http + payload if refers_to is None else http
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {identifier}", f"WARC-Date: {date}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {line(url)}")
    head.append(f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}")
    if refers_to is not None:
        head += [f"WARC-Profile: {SAME_PAYLOAD}", f"WARC-Refers-To: {refers_to}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + END + block + END


def _fields(head: bytes) -> dict[str, str]:
    return dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])


def parsed(data: bytes) -> tuple:
    """A record's bytes as a row of ``RECORD``. A response's size and digest are those of the
    payload found, which must be what its header says; a revisit's are those it states."""
    at = data.index(END)
    head, block = _fields(data[:at]), data[at + len(END) : -len(END)]
    if not data.startswith(b"WARC/1.1\r\n") or len(block) != int(head["Content-Length"]) or not data.endswith(END):
        raise ValueError("not a WARC record")
    cut = block.index(END)
    size, stated = int(_fields(block[:cut])["Content-Length"]), head["WARC-Payload-Digest"].removeprefix("sha1:")
    payload, refers_to = None, None
    if head["WARC-Type"] == "response":
        payload = block[cut + len(END) :]
        if len(payload) != size or sha1_base32(payload) != stated:
            raise ValueError(f"the payload of {head['WARC-Record-ID']} is not the one written")
    else:
        refers_to = page_of(head["WARC-Refers-To"])
    identifier = head["WARC-Record-ID"]
    return identifier, head["WARC-Type"], page_of(identifier), head.get("WARC-Target-URI"), size, stated, refers_to, payload


class Bundler:
    """Gathers records into frames, and frames into one bundle."""

    def __init__(self, level: int = 3) -> None:
        self.squeeze = zstandard.ZstdCompressor(level=level)
        self.frames, self.entries, self.places = [], [], []
        self.held: list[bytes] = []
        self.held_bytes, self.bytes = 0, 0

    def add(self, identifier: str, data: bytes) -> None:
        self.places.append((identifier, len(self.frames), self.held_bytes, len(data)))
        self.held.append(data)
        self.held_bytes += len(data)
        self.bytes += len(data)

    def close_frame(self) -> None:
        if self.held:
            content = b"".join(self.held)
            self.frames.append(self.squeeze.compress(content))
            self.entries.append(SEEK_ENTRY.pack(len(self.frames[-1]), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))
            self.held, self.held_bytes = [], 0

    def payload(self) -> bytes:
        self.close_frame()
        table = b"".join([*self.entries, SEEK_FOOT.pack(len(self.entries), HAS_CHECKSUM, SEEKABLE)])
        return b"".join([*self.frames, SKIP_HEAD.pack(SKIPPABLE, len(table)), table])


@dataclass
class Bundle:
    """A bundle's bytes with its seek table: frames are decoded alone."""

    data: bytes

    def __post_init__(self) -> None:
        n, flags, magic = SEEK_FOOT.unpack_from(self.data, len(self.data) - SEEK_FOOT.size)
        if magic != SEEKABLE or flags != HAS_CHECKSUM:
            raise ValueError("no seek table")
        at = len(self.data) - SEEK_FOOT.size - n * SEEK_ENTRY.size
        if SKIP_HEAD.unpack_from(self.data, at - SKIP_HEAD.size) != (SKIPPABLE, len(self.data) - at):
            raise ValueError("the seek table has no frame of its own")
        self.entries = [SEEK_ENTRY.unpack_from(self.data, at + k * SEEK_ENTRY.size) for k in range(n)]
        self.starts = np.cumsum([0, *(e[0] for e in self.entries)]).tolist()
        if self.starts[-1] != at - SKIP_HEAD.size:
            raise ValueError("the seek table doesn't fit the frames")

    def frame(self, k: int) -> bytes:
        size, content, check = self.entries[k]
        out = zstandard.ZstdDecompressor().decompress(self.data[self.starts[k] : self.starts[k] + size], max_output_size=max(content, 1))
        if len(out) != content or xxhash.xxh64_intdigest(out) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {k} is damaged")
        return out


def _bundles(frame_bytes: int, bundle_bytes: int, date: str):
    kinds = arrow(BUNDLE)

    def row(bundle: Bundler, name: str) -> pa.RecordBatch:
        ids, frames, offsets, sizes = (list(x) for x in zip(*bundle.places))
        cells = [name, bundle.payload(), ids, frames, offsets, sizes]
        return pa.RecordBatch.from_arrays([pa.array([c], type=f.type) for c, f in zip(cells, kinds)], schema=kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, bundle = TaskContext.get().partitionId(), 0, Bundler()
        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "mark", "url", "payload", "first", "first_mark")]
            for i in range(batch.num_rows):
                page, mark, url, payload, first, first_mark = (c[i].as_py() for c in columns)
                name = record_id(page, mark)
                data = record(name, url, payload, None if first_mark is None else record_id(first, first_mark), date)
                if bundle.held and bundle.held_bytes + len(data) > frame_bytes:
                    bundle.close_frame()
                    if bundle.bytes >= bundle_bytes:
                        yield row(bundle, f"part-{part:06d}-{number:06d}.warc.zst")
                        number, bundle = number + 1, Bundler()
                bundle.add(name, data)
        if bundle.places:
            yield row(bundle, f"part-{part:06d}-{number:06d}.warc.zst")

    return run


def archived(pages: DataFrame, path: str, min_bytes: int = 0, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES, date: str = DATE, scan: bool = False) -> None:
    """Writes a record for every page (page_id, url, html) to bundles in a folder.

    NULL html is the empty payload, a NULL url has no target header. Among equal payloads of
    at least ``min_bytes`` bytes the largest page_id (NULL the smallest; then the last row) is the
    response. A page of more than ``frame_bytes`` has a frame of its own. Groups of
    equal payloads of any size are counted before they meet: only the response's place
    travels to the others, and a payload that many pages share is spread over tasks.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    mark = F.xxhash64(F.col(FILE), F.col(ROW)).alias("mark")
    rows = positions(pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload")), scan)
    rows = rows.select("page_id", mark, "url", "payload", F.sha2("payload", 256).alias("same"))
    me = F.struct(F.col("page_id").isNotNull().alias("named"), "page_id", "mark")
    groups = rows.where(F.length("payload") >= min_bytes).groupBy("same").agg(F.max(me).alias("last"), F.count("*").alias("n")).where("n > 1")
    firsts, few = pinned(settled(groups.select("same", F.col("last.page_id").alias("first"), F.col("last.mark").alias("first_mark")), "responses"))
    placed = lookup(rows, firsts, ["same"], few, "left", spread=F.col("mark"))
    mine = F.col("first_mark") == F.col("mark")
    refers = [F.when(~mine, F.col(c)).alias(c) for c in ("first", "first_mark")]
    sent = placed.select("page_id", "mark", "url", "payload", *refers)
    sent.mapInArrow(_bundles(frame_bytes, bundle_bytes, date), BUNDLE).write.option("compression", "none").parquet(path)


def _bundle_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BUNDLE).parquet(path)


def places(spark: SparkSession, path: str) -> DataFrame:
    """(record_id, bundle, frame, offset, size) of every record; the bundles' bytes are not read."""
    zipped = F.arrays_zip(F.col("ids"), F.col("frames"), F.col("offsets"), F.col("sizes"))
    one = _bundle_rows(spark, path).select("bundle", F.explode(zipped).alias("r"))
    return one.select(F.col("r.ids").alias("record_id"), "bundle", F.col("r.frames").alias("frame"), F.col("r.offsets").alias("offset"), F.col("r.sizes").alias("size"))


def _read(with_payload: bool):
    kinds = arrow(RECORD)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                bundle, at = Bundle(batch.column("payload")[i].as_py()), -1
                frames, offsets, sizes = (batch.column(c)[i].values.to_numpy() for c in ("frames", "offsets", "sizes"))
                for k in np.unique(frames).tolist():  # one frame's records at a time
                    content, rows = bundle.frame(k), []
                    for at in np.flatnonzero(frames == k).tolist():
                        found = parsed(content[offsets[at] : offsets[at] + sizes[at]])
                        rows.append(found if with_payload else (*found[:-1], None))
                    yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], type=f.type) for j, f in enumerate(kinds)], schema=kinds)

    return run


def records(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """All records of a folder, one row of ``RECORD`` each, decoded frame by frame.

    ``payload`` is NULL in revisits, and everywhere unless asked for.
    """
    rows = _bundle_rows(spark, path).select("payload", "frames", "offsets", "sizes")
    return rows.mapInArrow(_read(with_payload), RECORD)


def fetched(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """The records whose ``record_id`` is in ``wanted``; no other frames are decoded."""
    hits = places(spark, path).join(wanted.select("record_id").distinct(), "record_id", "left_semi")
    lists = hits.groupBy("bundle").agg(F.sort_array(F.collect_list(F.struct("frame", "offset", "size"))).alias("at"))  # of one bundle, whose size is bounded
    slim = lists.select("bundle", F.col("at.frame").alias("frames"), F.col("at.offset").alias("offsets"), F.col("at.size").alias("sizes"))
    rows = _bundle_rows(spark, path).select("bundle", "payload").join(slim, "bundle").select("payload", "frames", "offsets", "sizes")
    return rows.mapInArrow(_read(True), RECORD)


def exported(spark: SparkSession, path: str, folder: str) -> DataFrame:
    """Writes each bundle as a plain ``.warc.zst`` file into ``folder`` (a URI that Arrow
    opens); gives (bundle, bytes). A file is written under another name and then moved, so a task
    that runs again only replaces it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        for batch in batches:
            for name, data in zip(batch.column("bundle").to_pylist(), batch.column("payload").to_pylist()):
                task = TaskContext.get().taskAttemptId()
                with system.open_output_stream(f"{base}/.{name}.{task}") as out:
                    out.write(data)
                system.move(f"{base}/.{name}.{task}", f"{base}/{name}")
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(data)], type=pa.int64())], names=["bundle", "bytes"])

    return _bundle_rows(spark, path).select("bundle", "payload").mapInArrow(run, "bundle string, bytes long")


def page_table(pages: DataFrame, scan: bool = False) -> DataFrame:
    """Writes all pages to the shared folder and reads them back: page_id, payload_bytes,
    payload_digest, record_type and refers_to of every row.

    An empty table writes no bundles and gives no rows. Repeated rows are records of their
    own: all but one revisit it, so ``refers_to`` may equal the row's own page_id.
    """
    path = fresh_path(pages.sparkSession, "warc")
    archived(pages, path, scan=scan)
    found = records(pages.sparkSession, path, with_payload=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
