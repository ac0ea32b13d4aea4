"""WARC archives in Zstandard: one frame a record, the dictionary in a leading frame.

An archive begins with a skippable frame that holds the dictionary of all its other frames.
Each of these is one record, so a reader can start at any record whose offset it knows.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerstats.llm.common import dealt_to_tasks, new_folder, ship, written

# Fixed values of the formats.
DICTIONARY_FRAME = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
FRAME = 0xFD2FB528
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REFERS = {"WARC-Refers-To", "Refers-To-Page"}
NEEDED = {"WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length"}

#: Payloads of fewer bytes are always stored whole.
LEAST_BYTES = 100
#: An archive is closed once it has so many bytes.
ARCHIVE_BYTES = 64 * 1024**2
#: Archives that a task reads, about, where there are many.
ARCHIVES_PER_TASK = 4
#: Rows and bytes the dictionary is trained on, at most, and its size.
DICTIONARY_ROWS, DICTIONARY_SAMPLE, DICTIONARY_BYTES = 512, 8 * 1024**2, 32 * 1024
#: Bytes read at a time; what follows a frame among them is copied when it ends.
READ_BYTES = 1 << 16
DATE = "1970-01-01T00:00:00Z"  # the pages carry no date


class BadArchive(ValueError):
    """An archive that breaks the format."""


def trained_dictionary(payloads: list[bytes]) -> bytes:
    """A dictionary of a bounded sample; none where the sample is too small for one."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, payloads).as_bytes()
    except zstandard.ZstdError:
        return b""


def record(fields: dict[str, str], block: bytes) -> bytes:
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in fields.items())]
    lines.append(b"Content-Length: %d" % len(block))
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def record_id(key: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, key)}>"


def record_keys(folder: str, path: str, number: int, row: dict) -> dict[str, str]:
    """What the ids of a record and of the one it refers to are made of: the page and its
    payload, so that a revisit in any archive names the record that holds it. Rows that repeat
    a page and its payload are one record, written again. A page without id has its place."""
    page = f"{folder}#{{}}#{row['payload_digest']}"
    own = f"{folder}/{path}#{number}" if row["page_id"] is None else page.format(row["page_id"])
    return {"record_key": own, "refers_key": page.format(row["refers_to"])}


def page_record(row: dict) -> bytes:
    """A response with the payload, or a revisit with the payload's headers alone."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nContent-Length: %d\r\n\r\n"
    block = http % row["payload_bytes"]
    url = "".join(c if c.isprintable() else "%%%02X" % ord(c) for c in row["url"] or "about:blank")
    fields = {
        "WARC-Type": row["record_type"],
        "WARC-Record-ID": record_id(row["record_key"]),
        "WARC-Date": DATE,
        "WARC-Target-URI": url,
        "Content-Type": "application/http; msgtype=response",
        "WARC-Payload-Digest": f"sha256:{row['payload_digest']}",
    }
    if row["page_id"] is not None:
        fields["Page-ID"] = str(row["page_id"])
    if row["record_type"] == "revisit":
        fields["WARC-Profile"] = PROFILE
        fields["WARC-Refers-To"] = record_id(row["refers_key"])
        fields["Refers-To-Page"] = str(row["refers_to"])
        return record(fields, block)
    return record(fields, block + row["payload"])


def dictionary_frame(dictionary: bytes) -> bytes:
    return struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary


def read_frames(stream) -> Iterator[bytes]:
    """The content of each frame after the dictionary's, one in memory at a time."""
    decompressor, pending, first = zstandard.ZstdDecompressor(), b"", True

    def more(n: int) -> bytes:
        nonlocal pending
        while len(pending) < n and (got := stream.read(READ_BYTES)):
            pending += got
        return pending

    while more(4):
        if len(pending) < 4:
            raise BadArchive("a frame is cut short")
        (magic,) = struct.unpack_from("<I", pending)
        if magic in SKIPPABLE:
            if len(more(8)) < 8:
                raise BadArchive("a skippable frame is cut short")
            (length,) = struct.unpack_from("<I", pending, 4)
            if len(more(8 + length)) < 8 + length:
                raise BadArchive("a skippable frame is cut short")
            content, pending = pending[8 : 8 + length], pending[8 + length :]
            if first and magic == DICTIONARY_FRAME and content:
                if content[:4] == struct.pack("<I", FRAME):
                    content = zstandard.ZstdDecompressor().decompress(content)
                data = zstandard.ZstdCompressionDict(content)
                decompressor = zstandard.ZstdDecompressor(dict_data=data)
        elif magic == FRAME:
            frame, parts = decompressor.decompressobj(), []
            while True:
                parts.append(frame.decompress(pending))
                pending = frame.unused_data if frame.eof else b""
                if frame.eof:
                    break
                if not more(1):
                    raise BadArchive("a frame is cut short")
            yield b"".join(parts)
        else:
            raise BadArchive(f"no frame begins with {magic:#x}")
        first = False


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of one frame, which must hold one record and no more."""
    head, found, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not found or lines[0] not in (VERSION, b"WARC/1.0"):
        raise BadArchive("a frame does not begin with a record's header")
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.decode().partition(":")
        if not colon or name in fields:
            raise BadArchive(f"bad header line {line[:80]!r}")
        fields[name] = value.strip()
    if missing := NEEDED - fields.keys():
        raise BadArchive(f"a record lacks {sorted(missing)}")
    length = fields["Content-Length"]
    if not length.isdigit() or len(rest) != int(length) + 4 or not rest.endswith(b"\r\n\r\n"):
        raise BadArchive("a record's length is not that of its block")
    return fields, rest[:-4]


def page_of(data: bytes) -> dict:
    """A page's row from its record, the payload checked against its digest and length."""
    fields, block = parse_record(data)
    head, found, payload = block.partition(b"\r\n\r\n")
    lengths = [x[15:] for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    if not found or len(lengths) != 1 or not lengths[0].strip().isdigit():
        raise BadArchive("a record's block is not one response's headers and payload")
    n, digest = int(lengths[0]), fields["WARC-Payload-Digest"].removeprefix("sha256:")
    kind = fields["WARC-Type"]
    if kind == "response":
        if len(payload) != n or hashlib.sha256(payload).hexdigest() != digest:
            raise BadArchive("a payload does not have its digest or length")
    elif kind != "revisit" or payload or not REFERS <= fields.keys():
        raise BadArchive(f"a {kind} record that is no revisit without payload")
    return {
        "page_id": int(fields["Page-ID"]) if "Page-ID" in fields else None,
        "payload_bytes": n,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": int(fields["Refers-To-Page"]) if kind == "revisit" else None,
        "url": fields["WARC-Target-URI"],
        "payload": payload if kind == "response" else None,
    }


def plan_records(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """Each page's payload and whether it is stored whole or refers to an equal one.

    Only digests that occur twice or more are joined back, and adaptive execution splits
    the pages of a frequent one over tasks.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        F.coalesce(F.encode(F.col("html"), "UTF-8"), F.lit(b"")).alias("payload"),
    ).select(
        "*",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"),
    )
    known = rows.filter(F.col("page_id").isNotNull() & (F.col("payload_bytes") >= least))
    firsts = (
        known.groupBy("payload_digest")
        .agg(F.min("page_id").alias("_first"), F.max("page_id").alias("_last"))
        .filter("_first < _last")
        .drop("_last")
    )
    again = (F.col("payload_bytes") >= least) & (F.col("page_id") != F.col("_first"))
    refers_to = F.when(again, F.col("_first"))
    return rows.join(firsts, "payload_digest", "left").select(
        "page_id",
        "url",
        "payload_bytes",
        "payload_digest",
        F.when(refers_to.isNotNull(), "revisit").otherwise("response").alias("record_type"),
        refers_to.alias("refers_to"),
        F.when(refers_to.isNull(), F.col("payload")).alias("payload"),
    )


ARCHIVES = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("records", T.LongType()),
        T.StructField("bytes", T.LongType()),
    ]
)


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record for each page below `folder`, a URI that all executors can write to.

    Returns the archives that count: one path, number of records and bytes a row. A task
    that is tried again writes under another name, so what a lost attempt left behind is
    in no row. The list itself is written before it is used.
    """
    sample = pages.select(F.substring("html", 1, DICTIONARY_SAMPLE // DICTIONARY_ROWS))
    texts = [(r[0] or "").encode() for r in sample.limit(DICTIONARY_ROWS).collect()]
    dictionary = trained_dictionary(texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
        compressor = zstandard.ZstdCompressor(level=3, **options)
        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        out, path, done, size = None, "", [], 0

        def close():
            nonlocal out
            if out is not None:
                out.close()
                done[-1] = (f"{folder}/{path}", done[-1][1], size)
                out = None

        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    path = f"{uuid.uuid4().hex}.warc.zst"
                    # By the name alone pyarrow would compress the whole archive once more.
                    out = system.open_output_stream(f"{base}/{path}", compression=None)
                    size = 0
                    size += out.write(dictionary_frame(dictionary))
                    done.append((path, 0, 0))
                keys = record_keys(folder, path, done[-1][1], row)
                size += out.write(compressor.compress(page_record(row | keys)))
                done[-1] = (path, done[-1][1] + 1, size)
                if size >= archive_bytes:
                    close()
        close()
        rows = [dict(zip(("path", "records", "bytes"), x)) for x in done]
        yield pa.RecordBatch.from_pylist(rows, schema=to_arrow_schema(ARCHIVES))

    ship(pages.sparkSession)
    return written(plan_records(pages).mapInArrow(run, ARCHIVES), "archives")


RECORDS = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("refers_to", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("payload", T.BinaryType()),
    ]
)


def read_archives(archives: DataFrame) -> DataFrame:
    """The records of the archives in column `path`, each frame, header, length, payload and
    number of records checked; a fault fails the job. An archive is read as a stream."""
    names = [f.name for f in RECORDS.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(RECORDS)
        for batch in batches:
            for archive in batch.to_pylist():
                system, path = fs.FileSystem.from_uri(archive["path"])
                rows, held, n = [], 0, 0
                with system.open_input_stream(
                    path, compression=None, buffer_size=1 << 20
                ) as stream:
                    for data in read_frames(stream):
                        rows.append(page_of(data))
                        held, n = held + len(data), n + 1
                        if held > 1 << 23:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, held = [], 0
                if n != archive["records"]:
                    raise BadArchive(f"{archive['path']} has {n} records")
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    ship(archives.sparkSession)
    spread = dealt_to_tasks(archives.select("path", "records"), ARCHIVES_PER_TASK)
    return spread.mapInArrow(run, RECORDS).select(*names)


def archive_pages(pages: DataFrame) -> DataFrame:
    """Write all pages to archives in the shared folder, and read these back.

    A null html has an empty payload and a null url is written as about:blank. A page without
    page_id is stored whole, as nothing can refer to it. Repeated rows with one page_id and
    payload all hold the payload. An empty table gives no archives and no rows.
    """
    folder = new_folder(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder))
