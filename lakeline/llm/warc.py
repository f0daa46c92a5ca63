"""WARC archives with a Zstandard dictionary.

Each archive begins with a skippable frame that holds a dictionary built from its own first records;
then each record is a frame of its own, compressed with that dictionary. A reader takes the dictionary
from the leading frame and can begin at any record.

Of records with equal payloads of at least ``REVISIT_BYTES`` the one with the largest page_id is a
response and the others are revisits of it; rows that tie on the largest page_id are all responses.
A null page_id counts as the smallest, null html as empty.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeline.llm.files import new_name, reading, writing
from lakeline.llm.words import slices
from lakeline.session import stored, work_folder
from lakeline.sources.files import table

REVISIT_BYTES = 1000
ARCHIVE_BYTES = 64 << 20
SAMPLE_BYTES = 2 << 20
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
SKIPPABLE = 0x184D2A5D
DICTIONARY_MAGIC = 0xEC30A437


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC/1.1 record. A revisit has its own payload's digest but no payload."""
    kind = "response" if refers_to is None else "revisit"
    body = payload if refers_to is None else b""
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {quote(url or '', safe=':/?#[]@!$&()*+,;=%~')}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{hashlib.sha1(payload).hexdigest()}",
        f"X-Payload-Length: {len(payload)}", "Content-Type: text/html; charset=utf-8",
        f"Content-Length: {len(body)}",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and body of a record; the lengths must agree."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    size = int(fields["Content-Length"])
    if version != "WARC/1.1" or rest[size:] != b"\r\n\r\n":
        raise ValueError("damaged record")
    return fields, rest[:size]


def dictionary_of(samples: list[bytes]) -> bytes:
    """A trained dictionary; too few or too equal samples give their last bytes instead."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=512, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:].ljust(8, b" ")


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict:
    trained = int.from_bytes(data[:4], "little") == DICTIONARY_MAGIC
    kind = zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT
    return zstandard.ZstdCompressionDict(data, dict_type=kind)


class Archive:
    """Writes records to one file; the first ones are held until the dictionary is built."""

    def __init__(self, file):
        self.file, self.packer, self.held, self.size, self.waiting = file, None, [], 0, 0

    def add(self, data: bytes) -> None:
        if self.packer is not None:
            self._put(data)
            return
        self.held.append(data)
        self.waiting += len(data)
        if self.waiting >= SAMPLE_BYTES:
            self.begin()

    def _put(self, data: bytes) -> None:
        frame = self.packer.compress(data)
        self.file.write(frame)
        self.size += len(frame)

    def begin(self) -> None:
        data = dictionary_of(self.held)
        self.file.write(SKIPPABLE.to_bytes(4, "little") + len(data).to_bytes(4, "little") + data)
        self.packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(data), write_checksum=True)
        for held in self.held:
            self._put(held)
        self.held = []

    def close(self) -> None:
        if self.packer is None:
            self.begin()


def records(file) -> Iterator[bytes]:
    """Each record of an archive, one frame at a time."""
    if int.from_bytes(file.read(4), "little") != SKIPPABLE:
        raise ValueError("an archive begins with a dictionary frame")
    dictionary = _dictionary(file.read(int.from_bytes(file.read(4), "little")))
    unpacker, data = zstandard.ZstdDecompressor(dict_data=dictionary), b""
    part, found = unpacker.decompressobj(), io.BytesIO()
    while data or (data := file.read(1 << 20)):
        found.write(part.decompress(data))
        data = b""
        if part.eof:
            yield found.getvalue()
            data = part.unused_data
            part, found = unpacker.decompressobj(), io.BytesIO()


def with_revisits(pages: DataFrame) -> DataFrame:
    """``page_id, url, html, refers_to`` of each page."""
    rows = pages.selectExpr(
        "CAST(page_id AS bigint) AS page_id", "CAST(url AS string) AS url",
        "coalesce(CAST(html AS string), '') AS html",
    ).withColumn("size", F.octet_length("html"))
    named = rows.withColumn("digest", F.when(
        F.col("size") >= REVISIT_BYTES, F.concat(F.sha1("html"), F.lit("-"), F.col("size"))))
    groups = named.where("digest IS NOT NULL").groupBy("digest").agg(
        F.max("page_id").alias("largest"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    joined = named.join(groups, "digest", "left")
    revisit = F.col("largest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("largest"))
    return joined.select("page_id", "url", "html", F.when(revisit, F.col("largest")).alias("refers_to"))


_WRITTEN = pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])


def _written(folder: str, archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = (part for batch in batches for part in slices(batch, "html"))
        rows = (row for part in parts for row in part.to_pylist())
        row = next(rows, None)
        while row is not None:
            name, count = new_name(folder, "warc.zst"), 0
            with writing(name) as file:
                archive = Archive(file)
                while row is not None and archive.size < archive_bytes:
                    archive.add(record(row["page_id"], row["url"], row["html"].encode(), row["refers_to"]))
                    count += 1
                    row = next(rows, None)
                archive.close()
            yield pa.RecordBatch.from_pylist(
                [{"path": name, "records": count, "bytes": archive.size}], schema=_WRITTEN)

    return run


def write_archives(pages: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``pages (page_id, url, html)``; returns the manifest ``path, records, bytes``."""
    folder = work_folder(pages.sparkSession, "warc")
    return stored(with_revisits(pages).mapInArrow(
        _written(folder, archive_bytes), "path string, records bigint, bytes bigint"), "archives")


_RECORDS = pa.schema([
    ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
])


def _page(name: str | None) -> int | None:
    number = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def _read(payloads: bool):
    schema = _RECORDS if payloads else pa.schema(list(_RECORDS)[:-1])

    def row_of(data: bytes) -> dict:
        fields, body = parsed(data)
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        kind = fields["WARC-Type"]
        if kind == "response" and hashlib.sha1(body).hexdigest() != digest:
            raise ValueError("payload and digest differ")
        return {
            "page_id": _page(fields["WARC-Record-ID"]), "payload_bytes": int(fields["X-Payload-Length"]),
            "payload_digest": digest, "record_type": kind, "refers_to": _page(fields.get("WARC-Refers-To")),
            "payload": body if kind == "response" else None,
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with reading(path) as file:
                    rows, held = [], 0
                    for data in records(file):
                        rows.append(row_of(data))
                        held += len(data)
                        if held > 1 << 22:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, held = [], 0
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return run


def read_archives(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """One row for each record of the archives, in no order."""
    files = manifest.select("path").repartition(
        manifest.sparkSession.sparkContext.defaultParallelism * 2, "path")
    ddl = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    return files.mapInArrow(_read(payloads), ddl + (", payload binary" if payloads else ""))


def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Archive every page and read all records back."""
    return read_archives(write_archives(table(spark, folder, "pages", "page_id", "url", "html")), False)


OP7_SQL = """
WITH rows AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
           sha1(coalesce(html, '')) AS payload_digest
    FROM pages),
groups AS (
    SELECT payload_digest, payload_bytes, max(page_id) AS largest FROM rows
    WHERE payload_bytes >= 1000 GROUP BY ALL)
SELECT r.page_id, CAST(r.payload_bytes AS BIGINT) AS payload_bytes, r.payload_digest,
       CASE WHEN g.largest <> r.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN g.largest <> r.page_id THEN g.largest END AS refers_to
FROM rows r LEFT JOIN groups g USING (payload_digest, payload_bytes)
"""
