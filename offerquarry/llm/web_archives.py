"""Legacy ARC archives converted to WARC (operator 4).

``write_arc`` packs pages into ARC files, ``convert`` reads ARC files (version 1 and 2
record lines, by the version their file headers declare; contents by declared lengths)
and synthesises WARC records, ``write_warc`` writes them and ``read_warc`` reads them
back.  Archives are text tables with a record per row: the separator Spark writes after
each row is the one the format asks for, so tasks write straight to shared storage.

Of records with equal payloads (by SHA-1 and length) of at least ``least_bytes`` bytes
the one with the smallest page id is a response, the others are revisits that refer to
it and carry no payload.  Record ids are derived from page id, address, date and digest,
so converting again gives the same ids.

Special cases: null html is an empty payload; a null or blank address becomes ``urn:none``,
blanks in an address are escaped; a row without a page id is a revisit if a row with an id
has its payload, else a response; rows repeated with the smallest page id are all responses;
no rows give an archive without pages.
An archive whose record ends early raises an error that names the file.

A task reads one archive at a time as a whole, so ``write_arc`` cuts archives small
(``ARCHIVE_BYTES``); a page of any size is one record, and needs the memory for it.
Payloads pass from step to step a few megabytes at a time.  Archives are written as gzip
files; those read may be plain, or gzip files with one member or one for each record.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerquarry.llm.common import read_table
from offerquarry.sources.shared import drop_stored, free_shuffles, new_path, ship_code, write_and_read

CAPTURED = "20200101000000"  # the pages have no date
ARCHIVE_BYTES = 4 << 20  # aimed at for one file
BATCH_BYTES = 4 << 20  # of payloads that a step hands on at once
LEAST_BYTES = 0  # payloads this long or longer become revisits

# Field names in the record lines of the two ARC versions.
ARC_FIELDS = {
    b"1": b"URL IP-address Archive-date Content-type Archive-length",
    b"2": b"URL IP-address Archive-date Content-type Result-code Checksum Location Offset "
    b"Filename Archive-length",
}
ID_HEADER = "X-Page-Id"


class BrokenArchive(ValueError):
    """An archive's record has no proper head or ends before its declared length."""


def _batched(
    rows: Iterable[tuple[tuple, int]], names: list[str], kinds: list[pa.DataType]
) -> Iterator[pa.RecordBatch]:
    """Rows with their sizes in bytes, in batches of about ``BATCH_BYTES``."""
    held, total = [], 0
    for row, size in rows:
        held.append(row)
        total += size + 100
        if total >= BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)
            held, total = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of batches, one by one: a batch is never turned into Python values whole."""
    for batch in batches:
        for values in zip(*batch.columns):
            yield tuple(v.as_py() for v in values)


# --- pages to ARC --------------------------------------------------------------------


def _arc_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """File number, part, page id, address and html to ARC records; part 0 is a head."""

    def rows() -> Iterator[tuple[tuple, int]]:
        for file, part, page_id, url, html in _each(batches):
            record = _arc_record(file, page_id, url, html) if part else _arc_header(file, file % 2 + 1)
            yield (file, part, record), len(record)

    return _batched(rows(), ["file", "part", "record"], [pa.int32(), pa.int32(), pa.binary()])


def _arc_record(file: int, page_id: int | None, url: str, html: bytes) -> bytes:
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if page_id is not None:
        head += f"{ID_HEADER}: {page_id}\r\n".encode()
    body = head + f"Content-Length: {len(html)}\r\n\r\n".encode() + html
    fields = [url.encode(), b"0.0.0.0", CAPTURED.encode(), b"text/html"]
    if file % 2 + 1 == 2:
        check = hashlib.md5(html).hexdigest().encode()
        fields += [b"200", check, b"-", b"0", f"{file}.arc".encode()]
    return b" ".join([*fields, str(len(body)).encode()]) + b"\n" + body


def _arc_header(file: int, version: int) -> bytes:
    block = f"{version} 0 -\n".encode() + ARC_FIELDS[str(version).encode()] + b"\n"
    line = f"filedesc://{file}.arc 0.0.0.0 {CAPTURED} text/plain"
    if version == 2:
        line += f" 200 - - 0 {file}.arc"
    return line.encode() + f" {len(block)}\n".encode() + block


def address(url: Column) -> Column:
    shown = F.regexp_replace(F.trim(F.coalesce(url.cast("string"), F.lit(""))), r"[\x00-\x20]+", "%20")
    return F.when(shown == "", F.lit("urn:none")).otherwise(shown)


def write_arc(pages: DataFrame, path: str, compression: str = "gzip") -> None:
    """ARC files of about ``ARCHIVE_BYTES`` before compression, versions 1 and 2 in turn."""
    ship_code(pages.sparkSession)
    page = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        address(F.col("url")).alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("html"),
    )
    size = page.agg(F.sum(F.octet_length("html") + 400)).first()[0] or 0
    files = max(1, -(-size // ARCHIVE_BYTES))
    spread = F.pmod(F.xxhash64("page_id", "url", "html"), F.lit(files)).cast("int")
    dealt = page.select(spread.alias("file"), F.lit(1).alias("part"), "page_id", "url", "html")
    heads = pages.sparkSession.range(files).select(
        F.col("id").cast("int").alias("file"), F.lit(0).alias("part"),
        F.lit(None).cast("long").alias("page_id"), F.lit("").alias("url"),
        F.lit(b"").alias("html"),
    )
    records = heads.unionByName(dealt).mapInArrow(_arc_rows, "file int, part int, record binary")
    both = records.repartitionById(files, F.col("file")).sortWithinPartitions("file", "part")
    both.select(F.col("record").cast("string").alias("value")).write.option(
        "lineSep", "\n"
    ).text(path, compression=compression)


# --- ARC to WARC ---------------------------------------------------------------------


def arc_records(data: bytes, name: str) -> Iterator[tuple[dict[bytes, bytes], bytes]]:
    """Fields of the record line and the content, for every record of an ARC file.

    A ``filedesc`` record declares the version and the field names of what follows.
    """
    at, names = 0, ARC_FIELDS[b"1"].split()
    while at < len(data):
        if data[at : at + 1] in (b"\n", b"\r"):
            at += 1
            continue
        end = data.find(b"\n", at)
        line = data[at:end].rstrip(b"\r").split(b" ") if end >= 0 else []
        heading = bool(line) and line[0].startswith(b"filedesc:")
        if not heading and len(line) != len(names):
            raise BrokenArchive(f"{name}: no record line at {at}")
        try:
            length = int(line[-1])
        except ValueError:
            raise BrokenArchive(f"{name}: no length at {at}") from None
        content = data[end + 1 : end + 1 + length]
        if length < 0 or len(content) < length:
            raise BrokenArchive(f"{name}: the record at {at} ends early")
        at = end + 1 + length
        if heading:
            version, _, described = content.partition(b"\n")
            names = described.split(b"\n")[0].split() or ARC_FIELDS[version.split(b" ")[0]].split()
        else:
            yield dict(zip(names, line)), content


def _payload(content: bytes) -> tuple[bytes, bytes]:
    """Head and payload of an HTTP message."""
    head, _, payload = content.partition(b"\r\n\r\n")
    return head, payload


def _header(head: bytes, name: str) -> str | None:
    for line in head.split(b"\r\n")[1:]:
        key, _, value = line.partition(b":")
        if key.strip().lower() == name.lower().encode():
            return value.strip().decode("utf-8", "replace")
    return None


def sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def unpacked(data: bytes) -> bytes:
    """An archive as it is, or all members of a gzip file."""
    parts = []
    while data.startswith(b"\x1f\x8b"):
        member = zlib.decompressobj(wbits=31)
        parts.append(member.decompress(data))
        data = member.unused_data
    return b"".join(parts) if parts else data


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "url", "date", "ip", "head", "payload", "payload_bytes", "digest"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary(), pa.binary(), pa.int64(), pa.string()]

    def rows() -> Iterator[tuple[tuple, int]]:
        for path, data in _each(batches):
            for fields, content in arc_records(unpacked(data), path):
                head, payload = _payload(content)
                page_id = _header(head, ID_HEADER)
                row = (
                    None if page_id is None else int(page_id),
                    fields[b"URL"].decode("utf-8", "replace"),
                    fields[b"Archive-date"].decode(), fields[b"IP-address"].decode(),
                    head, payload, len(payload), sha1(payload),
                )
                yield row, len(content)

    return _batched(rows(), names, kinds)


_RECORD = "page_id long, url string, date string, ip string, head binary, payload binary, payload_bytes long, digest string"


def convert(spark: SparkSession, path: str, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """The records of ARC files, and which of them become revisits of which page.

    First narrow columns are stored to find the first page of each payload; then the
    files are read again and joined with the stored table of repeated payloads, which
    Spark broadcasts if that is small enough.
    """
    ship_code(spark)
    archives = spark.read.format("binaryFile").load(path).select("path", "content")
    records = archives.mapInArrow(_parsed, _RECORD)
    narrow = write_and_read(records.select("page_id", "digest", "payload_bytes"), "payloads")
    first = narrow.groupBy("digest", "payload_bytes").agg(
        F.min("page_id").alias("first"), F.count("*").alias("n")
    )
    shared = first.where(f"n > 1 AND payload_bytes >= {least_bytes}").drop("n")
    shared = write_and_read(shared, "shared")
    judged = records.join(shared, ["digest", "payload_bytes"], "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return judged.withColumn("revisit", revisit)


def _warc_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple[tuple, int]]:
        for batch in batches:
            for values in zip(*batch.columns):
                record = warc_record(dict(zip(batch.schema.names, (v.as_py() for v in values))))
                yield (record,), len(record)

    return _batched(rows(), ["record"], [pa.binary()])


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {digest}')}>"


def warc_record(row: dict) -> bytes:
    """A WARC 1.0 record; the text table adds the two line ends that close it."""
    head = row["head"] + b"\r\n\r\n"
    block = head if row["revisit"] else head + row["payload"]
    d = row["date"].ljust(14, "0")
    fields = [
        ("WARC-Type", "revisit" if row["revisit"] else "response"),
        ("WARC-Record-ID", _record_id(row["page_id"], row["digest"])),
        ("WARC-Date", f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"),
        ("WARC-Target-URI", row["url"]),
        ("WARC-IP-Address", row["ip"]),
        ("WARC-Payload-Digest", f"sha1:{row['digest']}"),
        ("WARC-Block-Digest", f"sha1:{sha1(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if row["revisit"]:
        profile = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
        fields += [
            ("WARC-Profile", profile),
            ("WARC-Refers-To", _record_id(row["first"], row["digest"])),
            ("X-Refers-To-Page-Id", str(row["first"])),
        ]
    fields.append(("Content-Length", str(len(block))))
    lines = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return b"WARC/1.0\r\n" + lines.encode() + b"\r\n" + block


def write_warc(records: DataFrame, path: str, compression: str = "gzip") -> None:
    rows = records.mapInArrow(_warc_rows, "record binary")
    rows.select(F.col("record").cast("string").alias("value")).write.option(
        "lineSep", "\r\n\r\n"
    ).text(path, compression=compression)


def warc_records(data: bytes, name: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of every record of a WARC file."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise BrokenArchive(f"{name}: no record head at {at}")
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        fields = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        length = int(fields["content-length"])
        block = data[end + 4 : end + 4 + length]
        if len(block) < length:
            raise BrokenArchive(f"{name}: the record at {at} ends early")
        yield fields, block
        at = end + 4 + length + 4


def _restored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "record_type", "refers_to", "declared", "payload_bytes", "payload_digest", "url", "record_id"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]

    def rows() -> Iterator[tuple[tuple, int]]:
        for path, data in _each(batches):
            for fields, block in warc_records(unpacked(data), path):
                head, payload = _payload(block)
                page_id, refers = _header(head, ID_HEADER), fields.get("x-refers-to-page-id")
                response = fields["warc-type"] == "response"
                row = (
                    None if page_id is None else int(page_id),
                    fields["warc-type"], None if refers in (None, "None") else int(refers),
                    fields["warc-payload-digest"].removeprefix("sha1:"),
                    len(payload) if response else int(_header(head, "Content-Length")),
                    sha1(payload) if response else None,
                    fields["warc-target-uri"], fields["warc-record-id"],
                )
                yield row, 200

    return _batched(rows(), names, kinds)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, record_type, refers_to, declared`` (payload digest in the record's
    head), ``payload_bytes``, ``payload_digest`` (computed; null in revisits), ``url``,
    ``record_id``; a row per record."""
    ship_code(spark)
    kinds = (
        "page_id long, record_type string, refers_to long, declared string, "
        "payload_bytes long, payload_digest string, url string, record_id string"
    )
    archives = spark.read.format("binaryFile").load(path).select("path", "content")
    return archives.mapInArrow(_restored, kinds)


def op4_web_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages to ARC, converted to WARC, read back."""
    arc, warc = new_path(spark, "arc"), new_path(spark, "warc")
    write_arc(read_table(spark, sf_dir, "pages"), arc)
    free_shuffles(spark)
    write_warc(convert(spark, arc), warc)
    drop_stored(spark, arc)
    return read_warc(spark, warc).select(
        "page_id",
        "payload_bytes",
        F.coalesce("payload_digest", "declared").alias("payload_digest"),
        "record_type",
        "refers_to",
    )


ORACLE = f"""
WITH payloads AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), coded AS (
    SELECT *, array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               (((('0x' || substr(h, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31) + 1)::BIGINT, 1)
               FOR i IN range(32)], '') AS payload_digest,
           CASE WHEN payload_bytes >= {LEAST_BYTES} THEN min(page_id) OVER (PARTITION BY h, payload_bytes) END AS first
    FROM payloads
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first IS NULL OR first IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to
FROM coded"""
