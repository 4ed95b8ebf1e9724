"""WARC archives as seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each with some whole records; then an index in a skippable frame, which
maps record identifiers to a frame and an offset within it; and last the seek table of the seekable format, also a skippable
frame, with the sizes and checksums of all frames before it. Ordinary Zstandard tools read a bundle from start to end;
``fetch`` reads the end of it and then only the frames that hold what it was asked for.

Pages are first staged in bounded batches with digests of their payloads, numbered once and for all. Equal payloads are told
by SHA-256: a batch asks once per distinct payload, so a payload that a third of all pages share is one row per batch.
Payloads are shuffled compressed, a batch at a time, to meet what is known of their copies. Spark's text writer with the
last four bytes of the format as the end of its only line writes the files, so any store that Spark writes to will do, and a
task that is lost leaves nothing half done.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumetra.llm.asking import forget, kept

#: Fixed values of the formats.
SKIPPABLE_SEEK_TABLE, SKIPPABLE_INDEX = 0x184D2A5E, 0x184D2A5D
SEEKABLE_MAGIC = 0x8F92EAB1
WITH_CHECKSUMS = 0x80
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

STAGED = ("batch long, ids array<long>, urls array<string>, sizes array<long>, which array<int>, keys array<binary>, "
          "digests array<binary>, least array<int>, copies array<long>, payloads binary")
RECORDS = ("page_id long, url string, record_id string, record_type string, refers_to long, payload_bytes long, "
           "payload_digest string, payload binary, file string, frame int, offset long")
INDEX = "file string, record_id string, page_id long, frame int, frame_start long, frame_bytes long, offset long, length long"


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


# ---- records ----


def record_id(page_id: int | None, batch: int, at: int) -> str:
    """Unique by the place of the row, so that repeated page ids keep records of their own."""
    return f"<urn:x-page:{'null' if page_id is None else page_id}:{batch}.{at}>"


def page_of(record: str) -> int | None:
    page = record.removeprefix("<urn:x-page:").split(":")[0]
    return None if page == "null" else int(page)


def record(page_id: int | None, url: str | None, place: tuple[int, int], payload: bytes | memoryview | None, size: int,
           digest: str, first: str | None, date: str) -> bytes:
    """One record. With ``first``, the id of the response with an equal payload, it is a revisit without the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    body = b"" if first else bytes(payload)
    fields = [
        "WARC/1.1", f"WARC-Type: {'revisit' if first else 'response'}", f"WARC-Record-ID: {record_id(page_id, *place)}",
        f"WARC-Date: {date}",
    ]
    if url is not None:
        # a field is one line, without spaces within
        fields.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f-\xa0]", lambda c: "".join(f"%{b:02X}" for b in c[0].encode()), url))
    fields.append(f"WARC-Payload-Digest: sha1:{digest}")
    if first:
        fields += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {first}"]
    fields += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(http) + len(body)}"]
    return "\r\n".join(fields).encode() + b"\r\n\r\n" + http + body + b"\r\n\r\n"


def parse(data: bytes, at: int) -> tuple[dict, int]:
    """The record at ``at`` as a row of ``RECORDS`` (without its place), and where the next one starts.

    The payload of a response has to agree with its digest.
    """
    end = data.index(b"\r\n\r\n", at)
    first, *lines = data[at:end].decode().split("\r\n")
    if first != "WARC/1.1":
        raise ValueError(f"no record at {at}")
    fields = dict(line.split(": ", 1) for line in lines)
    start, length = end + 4, int(fields["Content-Length"])
    block = data[start : start + length]
    if data[start + length : start + length + 4] != b"\r\n\r\n" or len(block) != length:
        raise ValueError(f"the record at {at} is cut off")
    split = block.index(b"\r\n\r\n") + 4
    http = dict(line.split(": ", 1) for line in block[: split - 4].decode().split("\r\n")[1:])
    payload: bytes | None = block[split:]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    refers_to = fields.get("WARC-Refers-To")
    if fields["WARC-Type"] == "revisit":
        payload = None
    elif base32(hashlib.sha1(payload).digest()) != digest or len(payload) != int(http["Content-Length"]):
        raise ValueError(f"the payload of {fields['WARC-Record-ID']} does not agree with its digest")
    return {
        "page_id": page_of(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "record_id": fields["WARC-Record-ID"],
        "record_type": fields["WARC-Type"], "refers_to": page_of(refers_to) if refers_to else None,
        "payload_bytes": int(http["Content-Length"]), "payload_digest": digest, "payload": payload,
    }, start + length + 4


# ---- bundles ----


def _skippable(magic: int, content: bytes) -> bytes:
    return struct.pack("<II", magic, len(content)) + content


class BundleWriter:
    """Takes records in turn and gives the bytes of a bundle; memory holds one open frame and what is compressed."""

    def __init__(self, frame_bytes: int, level: int):
        self.frame_bytes, self.compress = frame_bytes, zstandard.ZstdCompressor(level=level).compress
        self.frames, self.entries, self.index, self.open = [], [], [], bytearray()

    def add(self, name: str, data: bytes) -> None:
        if self.open and len(self.open) + len(data) > self.frame_bytes:
            self._close()
        self.index.append(f"{name}\t{len(self.entries)}\t{len(self.open)}\t{len(data)}\n")
        self.open += data

    def _close(self) -> None:
        raw = bytes(self.open)
        self.frames.append(self.compress(raw))
        self.entries.append((len(self.frames[-1]), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.open = bytearray()

    def finish(self) -> bytes:
        if self.open:
            self._close()
        index = _skippable(SKIPPABLE_INDEX, self.compress("".join(self.index).encode()))
        entries = [*self.entries, (len(index), 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF)]
        table = b"".join(struct.pack("<III", *e) for e in entries) + struct.pack("<IBI", len(entries), WITH_CHECKSUMS, SEEKABLE_MAGIC)
        return b"".join([*self.frames, index, _skippable(SKIPPABLE_SEEK_TABLE, table)])


def seek_table(tail: bytes) -> list[tuple[int, int, int]]:
    """(compressed size, size, checksum) of each frame from the end of a bundle; the last is that of the index."""
    n, descriptor, magic = struct.unpack("<IBI", tail[-9:])
    if magic != SEEKABLE_MAGIC or descriptor != WITH_CHECKSUMS:
        raise ValueError("not a bundle: no seek table at its end")
    if len(tail) < 9 + 12 * n:
        raise ValueError("the seek table is longer than what was read")
    return list(struct.iter_unpack("<III", tail[len(tail) - 9 - 12 * n : -9]))


def frame(data: bytes, size: int, checksum: int) -> bytes:
    raw = zstandard.ZstdDecompressor().decompress(data, max_output_size=size) if size else b""
    if len(raw) != size or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != checksum:
        raise ValueError("a frame does not agree with its checksum")
    return raw


def _index_rows(file: str, content: bytes, table: list[tuple[int, int, int]]) -> Iterator[tuple]:
    """Rows of ``INDEX`` of a whole bundle."""
    starts = [0]
    for size, _, _ in table:
        starts.append(starts[-1] + size)
    raw = zstandard.ZstdDecompressor().decompressobj().decompress(content[starts[-2] + 8 : starts[-1]])
    for line in raw.decode().splitlines():
        name, number, offset, length = line.split("\t")
        k = int(number)
        yield file, name, page_of(name), k, starts[k], table[k][0], int(offset), int(length)


# ---- writing ----


def _staged(pages: DataFrame, bundle_bytes: int) -> DataFrame:
    """Batches of about ``bundle_bytes`` of payloads, stored. ``keys`` and ``digests`` are those of the batch's distinct
    payloads, ``which`` says which one a page has, ``least`` which of its pages in the batch comes first."""
    names = [c.split()[0] for c in STAGED.split(", ")]
    types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.int32()),
             pa.list_(pa.binary()), pa.list_(pa.binary()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.binary()]

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        ids, urls, sizes, which, known, digests, least, copies, chunks = [], [], [], [], {}, [], [], [], []
        packer, held = zstandard.ZstdCompressor(level=1).compressobj(), 0

        def flush() -> pa.RecordBatch:
            columns = [[part << 34 | made], [ids], [urls], [sizes], [which], [list(known)], [digests], [least], [copies],
                       [b"".join([*chunks, packer.flush()])]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        for batch in batches:
            for page, url, body in zip(*(batch.column(c) for c in ("page_id", "url", "body")), strict=True):
                page, url, data = page.as_py(), url.as_py(), body.as_buffer() if body.is_valid else b""
                key = hashlib.sha256(data).digest()
                k = known.setdefault(key, len(known))
                if k == len(digests):
                    digests.append(hashlib.sha1(data).digest())
                    least.append(len(ids))
                    copies.append(0)
                before = ids[least[k]] if least[k] < len(ids) else page
                if page is not None and (before is None or page < before):
                    least[k] = len(ids)
                copies[k] += 1
                ids.append(page)
                urls.append(url)
                sizes.append(len(data))
                which.append(k)
                chunks.append(packer.compress(data))
                held += len(data) + 200
                if held >= bundle_bytes:
                    yield flush()
                    made += 1
                    ids, urls, sizes, which, known, digests, least, copies, chunks = [], [], [], [], {}, [], [], [], []
                    packer, held = zstandard.ZstdCompressor(level=1).compressobj(), 0
        if ids:
            yield flush()

    return kept(pages.mapInArrow(start, STAGED), "staged")


def _marks(staged: DataFrame, revisit_from: int) -> DataFrame:
    """``batch`` and ``marks``: for each of its distinct payloads that other pages have too, which page comes first."""
    asked = staged.select("batch", "ids", "sizes", "which", F.posexplode(F.arrays_zip("keys", "least", "copies"))).select(
        "batch", F.col("pos").alias("k"), F.col("col.keys").alias("key"), F.col("col.copies").alias("copies"),
        F.col("col.least").alias("at"), F.get("ids", "col.least").alias("page_id"), F.get("sizes", "col.least").alias("size"),
    ).where(F.col("size") >= revisit_from)
    place = F.struct(F.col("page_id").isNull().alias("unknown"), "page_id", "batch", "at")
    first = asked.groupBy("key").agg(F.min(place).alias("first"), F.sum("copies").alias("n")).where("n > 1").select(
        "key", "first.page_id", F.col("first.batch").alias("first_batch"), F.col("first.at").alias("first_at")
    )
    mark = F.struct("k", first["page_id"].alias("page_id"), "first_batch", "first_at")
    return asked.join(first, "key").groupBy("batch").agg(F.collect_list(mark).alias("marks"))


def write(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", body_col: str = "html",
          date: str = "1970-01-01T00:00:00Z", revisit_from: int = 0, bundle_bytes: int = 64 << 20, frame_bytes: int = 256 << 10,
          level: int = 3) -> None:
    """One record per row of ``pages``, in bundles of about ``bundle_bytes`` of payloads below ``path``.

    The payload is the body in UTF-8; a null body is the empty payload. Of records with equal payloads of at least
    ``revisit_from`` bytes the one with the smallest id is the response; of repeated ids one of the rows is, and null ids come
    last. The others are revisits, which refer to it. Smaller payloads are all responses. A null url gives a record without
    a target; white space and control characters in a url are percent-encoded. ``date`` goes into every record. A record larger
    than a frame or a bundle has one to itself. An empty table gives an archive without bundles. Other columns are not read.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(body_col).cast("binary").alias("body")
    )

    def bundle(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        first = {m["k"]: m for marks in right.column("marks").to_pylist() for m in marks}
        out, batch = BundleWriter(frame_bytes, level), row["batch"]
        data = zstandard.ZstdDecompressor().stream_reader(row["payloads"])
        digests = [base32(d) for d in row["digests"]]
        for at, (page, url, size, k) in enumerate(zip(row["ids"], row["urls"], row["sizes"], row["which"], strict=True)):
            payload, mark = data.read(size) if size else b"", first.get(k)
            old = mark is not None and (mark["first_batch"], mark["first_at"]) != (batch, at)
            refers_to = record_id(mark["page_id"], mark["first_batch"], mark["first_at"]) if old else None
            out.add(record_id(page, batch, at), record(page, url, (batch, at), payload, size, digests[k], refers_to, date))
        return pa.table({"bundle": pa.array([out.finish()], pa.binary())})

    staged = _staged(rows, bundle_bytes)
    marks = kept(_marks(staged, revisit_from), "marks")
    bundles = staged.groupBy("batch").cogroup(marks.groupBy("batch")).applyInArrow(bundle, "bundle binary")
    magic = struct.pack("<I", SEEKABLE_MAGIC).decode("latin-1")  # ends the file in place of a line break
    (
        bundles.select(F.expr("substring(bundle, 1, length(bundle) - 4)").cast("string").alias("value"))
        .write.option("maxRecordsPerFile", 1).option("lineSep", magic).option("encoding", "ISO-8859-1").text(path)
    )
    forget(staged, marks)


# ---- reading ----


def _bundles(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.where("length > 0").select("path", "content")


def _mapped(files: DataFrame, rows_of, schema: str, rows_per_batch: int) -> DataFrame:
    """``rows_of(file, content)`` of every bundle."""
    names = [c.split()[0] for c in schema.split(", ")]
    types = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    arrow = pa.schema([(c.split()[0], types[c.split()[1]]) for c in schema.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

        for batch in batches:
            for file, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                rows = []
                for row in rows_of(file, content.as_buffer()):
                    rows.append(row if isinstance(row, tuple) else tuple(row[n] for n in names))
                    if len(rows) >= rows_per_batch:
                        yield out(rows)
                        rows = []
                if rows:
                    yield out(rows)

    return files.mapInArrow(run, schema)


def read(spark: SparkSession, path: str) -> DataFrame:
    """All records below ``path`` (``RECORDS``): what they say, their payload (null for revisits) and their place.

    Every frame is checked against the seek table and every payload against its digest; the job fails if they differ.
    """

    def rows(file: str, content: pa.Buffer) -> Iterator[dict]:
        data = memoryview(content)
        table = seek_table(bytes(data[-9 - 12 * struct.unpack("<I", data[-9:-5])[0] :]))
        start = 0
        for k, (packed, size, checksum) in enumerate(table[:-1]):
            raw, at = frame(bytes(data[start : start + packed]), size, checksum), 0
            while at < len(raw):
                found, after = parse(raw, at)
                yield found | {"file": file, "frame": k, "offset": at}
                at = after
            start += packed

    return _mapped(_bundles(spark, path), rows, RECORDS, 1000)


def index(spark: SparkSession, path: str) -> DataFrame:
    """Where each record is (``INDEX``): file, frame, the frame's place in the file, the record's place in the frame."""

    def rows(file: str, content: pa.Buffer) -> Iterator[tuple]:
        data = content.to_pybytes()
        yield from _index_rows(file, data, seek_table(data[-9 - 12 * struct.unpack("<I", data[-9:-5])[0] :]))

    return _mapped(_bundles(spark, path), rows, INDEX, 10_000)


def fetch(places: DataFrame) -> DataFrame:
    """The records at some rows of ``index`` (``RECORDS``), each from its own frame alone.

    Files are opened in place, by the file system that pyarrow knows for their address.
    """
    names = [c.split()[0] for c in RECORDS.split(", ")]
    types = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    arrow = pa.schema([(c.split()[0], types[c.split()[1]]) for c in RECORDS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: tuple | None = None
        last: tuple | None = None
        raw = b""
        for batch in batches:
            for at in batch.to_pylist():
                if opened is None or opened[0] != at["file"]:
                    where = at["file"].replace("file:/", "file:///", 1) if at["file"].startswith("file:/") and not at["file"].startswith("file://") else at["file"]
                    system, name = pyarrow.fs.FileSystem.from_uri(where)
                    opened, last = (at["file"], system.open_input_file(name)), None
                if last != (at["file"], at["frame"]):
                    opened[1].seek(at["frame_start"])
                    packed = opened[1].read(at["frame_bytes"])
                    raw = zstandard.ZstdDecompressor().decompressobj().decompress(packed)
                    last = (at["file"], at["frame"])
                found, _ = parse(raw, at["offset"])
                found |= {"file": at["file"], "frame": at["frame"], "offset": at["offset"]}
                yield pa.RecordBatch.from_arrays([pa.array([found[n]], f.type) for n, f in zip(names, arrow)], schema=arrow)

    near = places.repartition("file").sortWithinPartitions("file", "frame", "offset")
    return near.mapInArrow(run, RECORDS)
