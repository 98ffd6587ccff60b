"""WARC archives compressed record by record with a Zstandard dictionary of their own.

Each archive begins with a skippable frame that holds a dictionary, itself compressed, trained on
records of that archive; every record after it is one frame compressed with that dictionary. So a
record can be read on its own, and an archive needs nothing else to be read.

Of records with equal payloads one is a response and the others are revisits that refer to it
without payload. Which is decided on digests: a grouped maximum, pre-aggregated before its shuffle,
and a join that AQE can split where a payload is very common.

Tasks write archives below one folder through Arrow's file systems, under names with the task
attempt in them. What counts is the manifest, a written table of the archives of the attempts that
ended well; whatever a lost or repeated attempt leaves is never read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.session import materialize, scratch_path

# Fixed values of the archive format.
DICTIONARY_MAGIC = 0x184D2A5D
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_ID = "urn:shelfwise:page:"

#: Uncompressed bytes after which a task begins the next archive; bounds a task's memory.
ARCHIVE_BYTES = 16 << 20
DICTIONARY_BYTES = 64 << 10
#: The dictionary is trained on records taken evenly from the archive, of so many bytes at most.
TRAINING_BYTES = 100 * DICTIONARY_BYTES // 4
LEVEL = 3
STEP = 16 << 10
DATE = "2024-01-01T00:00:00Z"
LEAST_REVISIT = 1000


def sha1_name(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def write_record(page_id, url, payload: bytes, refers_to, digest: bytes, date: str = DATE) -> bytes:
    """One record: a response with its payload, or a revisit (``refers_to`` given) without."""
    revisit = refers_to is not None
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Date", date),
        ("WARC-Payload-Digest", sha1_name(digest)), ("X-Payload-Length", str(len(payload))),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    fields.append(("WARC-Record-ID", f"<{RECORD_ID}{page_id}>" if page_id is not None else f"<urn:uuid:{uuid.uuid4()}>"))
    if url is not None:
        fields.append(("WARC-Target-URI", " ".join(url.split())))
    if revisit:
        fields += [("WARC-Refers-To", f"<{RECORD_ID}{refers_to}>"), ("WARC-Profile", PROFILE)]
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + (b"" if revisit else payload)
    fields.append(("Content-Length", str(len(body))))
    head = "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    return VERSION + b"\r\n" + head + b"\r\n" + body + b"\r\n\r\n"


def read_record(data: bytes) -> dict:
    """The fields of a record, and its payload (None for a revisit)."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if version != VERSION:
        raise ValueError("not a WARC record")
    fields = dict(line.decode().split(": ", 1) for line in lines)
    body = rest[:int(fields["Content-Length"])]
    payload = body.partition(b"\r\n\r\n")[2]
    return fields | {"payload": None if fields["WARC-Type"] == "revisit" else payload}


def train(records: list[bytes]) -> bytes:
    """A dictionary from records spread evenly over the archive; empty where there are too few."""
    size = sum(map(len, records))
    step = max(1, -(-size // TRAINING_BYTES))
    samples = records[::step]
    while sum(map(len, samples)) > TRAINING_BYTES and len(samples) > 8:
        samples = samples[::2]
    if len(samples) < 8 or size < 4 * DICTIONARY_BYTES:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:  # records too uniform to train on
        return b""


def write_archive(records: list[bytes]) -> bytes:
    dictionary = train(records)
    kept = zstandard.ZstdCompressor(level=LEVEL).compress(dictionary)
    using = {}
    if dictionary:
        using["dict_data"] = zstandard.ZstdCompressionDict(dictionary)
        using["dict_data"].precompute_compress(level=LEVEL)
    compressor = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True, write_checksum=True, **using)
    return b"".join([struct.pack("<II", DICTIONARY_MAGIC, len(kept)), kept, *map(compressor.compress, records)])


def read_archive(data: bytes) -> Iterator[bytes]:
    """The records of an archive, one frame at a time."""
    magic, size = struct.unpack_from("<II", data)
    if magic != DICTIONARY_MAGIC:
        raise ValueError("the archive does not begin with a dictionary frame")
    view = memoryview(data)
    dictionary = zstandard.ZstdDecompressor().decompress(view[8:8 + size])
    using = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
    decompressor, at = zstandard.ZstdDecompressor(**using), 8 + size
    while at < len(view):
        reader, parts = decompressor.decompressobj(), []
        while not reader.eof:
            if at >= len(view):
                raise ValueError("the archive ends inside a record")
            parts.append(reader.decompress(view[at:at + STEP]))
            at += min(STEP, len(view) - at) - len(reader.unused_data)
        yield b"".join(parts)


def _writer(folder: str):
    def run(batches):
        from pyarrow import fs

        context = TaskContext.get()
        system, root = fs.FileSystem.from_uri(folder)
        records: list[bytes] = []
        size = number = 0
        names: list[tuple[str, int, int]] = []

        def flush():
            nonlocal records, size, number
            name = f"part-{context.partitionId():05d}-{context.taskAttemptId()}-{number:04d}.warc.zst"
            data = write_archive(records)
            with system.open_output_stream(f"{root}/{name}", compression=None) as out:
                out.write(data)
            names.append((name, len(records), len(data)))
            records, size, number = [], 0, number + 1

        for batch in batches:
            for page_id, url, html, refers_to in zip(*(batch[c] for c in ("page_id", "url", "html", "refers_to"))):
                payload = html.as_buffer().to_pybytes() if html.is_valid else b""
                record = write_record(page_id.as_py(), url.as_py(), payload, refers_to.as_py(), hashlib.sha1(payload).digest())
                records.append(record)
                size += len(record)
                if size >= ARCHIVE_BYTES:
                    flush()
        if records:
            flush()
        if names:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*names)], ["name", "records", "bytes"])

    return run


def _reader(batches):
    for batch in batches:
        for content in batch["content"]:
            rows = []
            for data in read_archive(content.as_buffer()):
                record = read_record(data)
                payload = record["payload"]
                digest = base64.b32decode(record["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                if payload is not None and hashlib.sha1(payload).hexdigest() != digest:
                    raise ValueError(f"damaged record {record['WARC-Record-ID']}")
                rows.append((
                    _page(record["WARC-Record-ID"]), record.get("WARC-Target-URI"), record["WARC-Type"], _page(record.get("WARC-Refers-To")),
                    int(record["X-Payload-Length"]) if payload is None else len(payload), digest,
                    None if payload is None else payload.decode(),
                ))
                if len(rows) == 1000:
                    yield _rows(rows)
                    rows = []
            yield _rows(rows)


def _page(name: str | None) -> int | None:
    return int(name[len(RECORD_ID) + 1:-1]) if name and name.startswith(f"<{RECORD_ID}") else None


_READ = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                   ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.string())])


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(_READ)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _READ)], schema=_READ)


def with_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, html, refers_to): which page each revisit refers to, null for a response."""
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    # Small payloads take part under a key of their own, so they meet nothing.
    key = F.when(F.octet_length("html") >= LEAST_REVISIT, F.sha2(F.col("html").cast("binary"), 256)).otherwise(
        F.concat(F.lit("small:"), F.xxhash64("page_id", "html").cast("string")))
    rows = rows.withColumn("key", key)
    first = materialize(
        rows.filter(F.octet_length("html") >= LEAST_REVISIT).groupBy("key")
        .agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1 and first is not null").select("key", "first"), "payloads")
    return rows.join(first.hint("shuffle_hash"), "key", "left").select(
        "page_id", "url", "html", F.when(F.col("page_id").eqNullSafe(F.col("first")), None).otherwise(F.col("first")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, **columns: str) -> DataFrame:
    """Write ``pages`` as archives below ``folder``; the manifest: (name, records, bytes).

    The payload is the html in UTF-8, nothing for null. Of records with equal payloads of at least
    1000 bytes the one with the largest id is a response, the others revisit it; smaller payloads
    are always responses. A page without an id never leads pages with one, and among pages without
    any id all are responses; so are all rows that repeat the leading id. An empty table gives no
    archives. Other columns are not written.
    """
    rows = with_revisits(pages, **columns)
    jvm = pages.sparkSession.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(pages.sparkSession.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)
    return materialize(rows.mapInArrow(_writer(folder), "name string, records long, bytes long"), "manifest")


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """The records of a manifest's archives.

    (page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload); a revisit has the
    size and digest of the payload it refers to, and no payload. A damaged archive is an error.
    The driver handles the names of the archives only, as it does in any listing of files.
    """
    spark = manifest.sparkSession
    names = [f"{folder}/{r['name']}" for r in manifest.select("name").collect()]
    schema = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload string"
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.format("binaryFile").load(names).select("content").mapInArrow(_reader, schema)


def round_trip(pages: DataFrame, **columns: str) -> DataFrame:
    """Archive ``pages`` in the shared scratch folder and read the archives back."""
    folder = scratch_path(pages.sparkSession, "archives")
    return read_archives(write_archives(pages, folder, **columns), folder)
