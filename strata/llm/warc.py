"""WARC archives: write captures, read records back, and assemble transactions.

Writing: every page becomes a request, a response and a metadata record that are
concurrent to each other; of pages with the same payload (by SHA-1 and length) only the
one with the smallest id is stored as response, the others as revisit records that refer
to it. Records are text, so Spark's text writer writes them, with the two line ends that
close a WARC record as its line separator and gzip over each file.

Reading: each archive is parsed as a stream by the lengths its records state, so memory
holds one record beside the compressed file. Digests are computed again from the payload.

Assembly: request, response and metadata records are joined through their concurrent-to
identifiers, whichever side states them, and give one nested row per capture; revisits
then meet the response they refer to. Payload texts take one shuffle on the way to the
archive and none after it. A prefix sum of bytes deals captures into files of ``FILE_BYTES``,
so a file never outgrows what one row of a reader can hold.

Defined cases: a NULL payload is empty; rows that repeat a page id are captures of their
own, numbered by payload digest and address, the first of them the smallest; control
characters and blanks in addresses are percent-encoded, a NULL address is ``unknown:``; an
empty table gives an archive without records; other columns are not written; a record
shorter than it states, or one that does not start like a record, raises an error; a
request or metadata record without its response is left out, one response without them
has empty lists.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.session import cut_lineage

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CRAWL_DATE = "2026-01-01T00:00:00Z"
FILE_BYTES = 128 << 20  # of records in a file before compression, plus at most one capture
HEAD_BYTES = 2000  # allowed for the heads of a capture's three records, addresses not counted
END = "\r\n\r\n"
RECORDS = (
    "record_id string, record_type string, concurrent_to string, refers_to string, target_uri string, "
    "date string, stated_digest string, payload_digest string, payload_bytes long, payload binary")


def base32_sha1(text: Column) -> Column:
    """Base32 of the SHA-1 of a text's UTF-8 bytes: eight groups of five hexadecimal digits."""
    digest = F.sha1(text.cast("binary"))
    letters = []
    for i in range(0, 40, 5):
        group = F.conv(F.substring(digest, i + 1, 5), 16, 10).cast("int")
        letters += [F.substr(F.lit(BASE32), F.shiftright(group, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*letters)


def _record_id(kind: str, page: Column, number: Column) -> Column:
    name = F.md5(F.concat_ws("/", F.lit(kind), F.coalesce(page.cast("string"), F.lit("")), number.cast("string")))
    parts = [F.substring(name, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def captures_to_store(pages: DataFrame, least_bytes: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Pages with ``digest, bytes, number``, for revisits the id and number of the response, and
    the ``file`` they belong to.

    All of this is found on rows without payloads. Payloads then meet these rows by page id,
    digest and address, so pages that share an id, or have none, are spread like others, and of
    rows that are equal in all three one payload travels.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    digest = base32_sha1(payload)
    page, url = F.col("page_id").cast("long"), F.col("url").cast("string")
    # Hexadecimal digits: one call of the hash for every row, on both sides.
    unit = F.concat(F.coalesce(page.cast("string"), F.lit("")), F.lit("/"), F.sha1(payload.cast("binary")), F.lit("/"),
                    F.coalesce(F.concat(F.lit("="), url), F.lit("")))
    narrow = cut_lineage(pages.select(
        page.alias("page_id"), url.alias("url"), digest.alias("digest"),
        F.octet_length(payload).cast("long").alias("bytes"), unit.alias("unit")), "warc-digests")
    numbered = narrow.withColumn("number", F.row_number().over(Window.partitionBy("page_id").orderBy("digest", "url")))
    first = narrow.filter(F.col("bytes") >= least_bytes).groupBy("digest", "bytes").agg(
        F.min("page_id").alias("least"), F.count(F.lit(1)).alias("n"), F.count("page_id").alias("ids"))
    # NULL is smaller than every id. Rows of one page and digest are numbered by address, so
    # the response is the one with the least number.
    shared = first.filter("n > 1").select("digest", "bytes", F.when(F.col("ids") == F.col("n"), F.col("least")).alias("owner"),
                                          F.lit(True).alias("shared"))
    linked = numbered.join(shared, ["digest", "bytes"], "left")
    at_owner = F.col("shared") & F.col("page_id").eqNullSafe(F.col("owner"))
    owners = linked.filter(at_owner).groupBy("digest", "bytes").agg(F.min("number").alias("owner_number"))
    linked = linked.join(owners, ["digest", "bytes"], "left")
    revisit = F.coalesce("shared", F.lit(False)) & ~(
        F.col("page_id").eqNullSafe(F.col("owner")) & (F.col("number") == F.col("owner_number")))
    linked = cut_lineage(linked.select(
        "unit", "page_id", "url", "digest", "bytes", "number",
        F.when(revisit, F.struct(F.col("owner").alias("page_id"), F.col("owner_number").alias("number"))).alias("first")),
        "warc-captures")
    placed = _into_files(linked, file_bytes)
    copies = Window.partitionBy("unit").orderBy("bytes")
    payloads = pages.select(unit.alias("unit"), payload.alias("html"), F.octet_length(payload).alias("bytes"))
    payloads = payloads.withColumn("__copy", F.row_number().over(copies)).filter("__copy = 1").select("unit", "html")
    return placed.join(payloads, "unit").drop("unit")


def _into_files(captures: DataFrame, file_bytes: int) -> DataFrame:
    """Captures with the ``file`` that a prefix sum of their bytes gives.

    Sums run within the shuffle partitions that the payloads will have, in the order in which
    they will be there, and start with the bytes of the partitions before.
    """
    own = F.when(F.col("first").isNull(), F.col("bytes")).otherwise(0)
    size = own + HEAD_BYTES + 3 * F.octet_length(F.coalesce("url", F.lit("")))
    tasks = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sized = captures.withColumn("__size", size).withColumn("__task", F.pmod(F.hash("unit"), F.lit(tasks)))
    totals = sized.groupBy("__task").agg(F.sum("__size").alias("__total"))
    before = Window.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)  # a row per task
    shift = totals.select("__task", F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__before"))
    so_far = Window.partitionBy("__task").orderBy("unit", "number").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.sum("__size").over(so_far), F.lit(0)) + F.col("__before")
    return sized.join(F.broadcast(shift), "__task").withColumn(
        "file", F.floor(reached / F.lit(file_bytes)).cast("long")).drop("__task", "__size", "__before")


def _record(kind: str | Column, record_id: Column, fields: dict[str, Column | str], block: Column) -> Column:
    """One record without the line ends that close it; fields that are NULL are left out."""
    lines = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), F.lit(kind) if isinstance(kind, str) else kind),
             F.concat(F.lit("WARC-Record-ID: "), record_id)]
    lines += [F.concat(F.lit(f"{name}: "), F.lit(v) if isinstance(v, str) else v) for name, v in fields.items()]
    lines.append(F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    return F.concat(F.concat_ws("\r\n", *lines), F.lit(END), block)


def write_archive(pages: DataFrame, path: str, least_bytes: int = 0, date: str = CRAWL_DATE,
                  file_bytes: int = FILE_BYTES) -> None:
    """Write the three records of every page; see the module's text."""
    stored = captures_to_store(pages, least_bytes, file_bytes)
    page, number, first = F.col("page_id"), F.col("number"), F.col("first")
    revisit = first.isNotNull()
    encoded = F.col("url")
    for code in (*range(33), 127):
        encoded = F.replace(encoded, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    stored = stored.withColumn("address", F.coalesce(
        F.when(F.col("url").rlike(r"[\x00-\x20\x7f]"), encoded).otherwise(F.col("url")), F.lit("unknown:")))
    address = F.col("address")
    response_id = _record_id("response", page, number)
    same = {"WARC-Date": date, "WARC-Target-URI": address}
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("bytes").cast("string"), F.lit(END))
    host = F.coalesce(F.regexp_extract(address, "^[a-z]+://([^/?#]*)", 1), F.lit(""))
    target = F.regexp_replace(address, "^[a-z]+://[^/?#]*", "")
    request = _record("request", _record_id("request", page, number),
                      same | {"WARC-Concurrent-To": response_id, "Content-Type": "application/http; msgtype=request"},
                      F.concat(F.lit("GET "), target, F.lit(" HTTP/1.1\r\nHost: "), host, F.lit(END)))
    response = _record(
        F.when(revisit, "revisit").otherwise("response"), response_id,
        same | {"WARC-Payload-Digest": F.concat(F.lit("sha1:"), F.col("digest")),
                "WARC-Refers-To": F.when(revisit, _record_id("response", first["page_id"], first["number"])),
                "WARC-Profile": F.when(revisit, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                "Content-Type": "application/http; msgtype=response"},
        F.concat(head, F.when(revisit, "").otherwise(F.col("html"))))
    notes = F.concat(F.lit("page-id: "), F.coalesce(page.cast("string"), F.lit("")), F.lit("\r\n"))
    metadata = _record("metadata", _record_id("metadata", page, number),
                       same | {"WARC-Concurrent-To": response_id, "Content-Type": "application/warc-fields"}, notes)
    records = stored.select("file", F.explode(F.array(request, response, metadata)).alias("value"))
    (records.write.mode("errorifexists").option("lineSep", END).option("compression", "gzip")
     .partitionBy("file").text(path))


def parse(stream: io.BufferedIOBase, payloads: bool) -> Iterator[tuple]:
    """Records of one archive, as rows of ``RECORDS``."""
    while line := stream.readline():
        if line in (b"\r\n", b"\n"):
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record starts with {line[:40]!r}")
        fields: dict[str, str] = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        length = int(fields.get("content-length", "0"))
        block = stream.read(length)
        if len(block) < length:
            raise ValueError(f"record {fields.get('warc-record-id')} ends after {len(block)} of {length} bytes")
        payload = block.partition(b"\r\n\r\n")[2] if "application/http" in fields.get("content-type", "") else block
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        yield (
            fields.get("warc-record-id"), fields.get("warc-type"), fields.get("warc-concurrent-to"),
            fields.get("warc-refers-to"), fields.get("warc-target-uri"), fields.get("warc-date"),
            fields.get("warc-payload-digest", "").removeprefix("sha1:") or None, digest, len(payload),
            payload if payloads or fields.get("warc-type") == "metadata" else None)


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of all archives in a folder, plain or gzipped (also one member per record).

    Without ``payloads`` only those of metadata records are kept.
    """
    kinds = [pa.string()] * 8 + [pa.int64(), pa.binary()]
    names = [field.split()[0] for field in RECORDS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                raw = io.BytesIO(content.as_buffer())
                zipped = raw.read(2) == b"\x1f\x8b"
                raw.seek(0)
                stream = io.BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 16) if zipped else raw
                rows: list[tuple] = []
                size = 0
                for record in parse(stream, payloads):
                    rows.append(record)
                    size += 500 + len(record[-1] or b"")
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("content").mapInArrow(run, RECORDS)


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: its ``capture`` record, lists of ``requests`` and ``metadata``, and
    ``original``, the response a revisit refers to."""
    is_capture = F.col("record_type").isin("response", "revisit")
    captures = records.filter(is_capture)
    parts = records.filter(F.col("record_type").isin("request", "metadata"))
    links = parts.select(F.col("concurrent_to").alias("__capture"), F.col("record_id").alias("__part")).unionByName(
        captures.select(F.col("record_id").alias("__capture"), F.col("concurrent_to").alias("__part"))
    ).dropna().distinct()
    entry = F.struct("record_id", "target_uri", "date", "payload_bytes", "payload")
    beside = parts.join(links, F.col("record_id") == F.col("__part")).groupBy("__capture").agg(
        *[F.array_sort(F.collect_list(F.when(F.col("record_type") == kind, entry))).alias(name)
          for kind, name in (("request", "requests"), ("metadata", "metadata"))])
    originals = captures.filter(F.col("record_type") == "response").select(
        F.col("record_id").alias("__original"), F.struct("record_id", "payload_digest", "payload_bytes").alias("original"))
    empty = F.array().cast(parts.select(F.array(entry).alias("x")).schema["x"].dataType)
    return (
        captures.select("record_id", "refers_to", F.struct(*records.columns).alias("capture"))
        .join(beside, F.col("record_id") == F.col("__capture"), "left")
        .join(originals, F.col("refers_to") == F.col("__original"), "left")
        .select("capture", F.coalesce("requests", empty).alias("requests"),
                F.coalesce("metadata", empty).alias("metadata"), "original"))


def page_index(spark: SparkSession, path: str) -> DataFrame:
    """Per page of the archive: ``page_id, payload_bytes, payload_digest, record_type, refers_to``."""
    records = cut_lineage(read_records(spark, path, payloads=False), "warc-records")
    note = F.decode(F.get("metadata", F.lit(0))["payload"], "UTF-8")
    number = F.regexp_extract(note, r"page-id: (-?\d+)", 1)
    rows = assemble(records).select(
        F.when(number != "", number.cast("long")).alias("page_id"), "capture.record_id", "capture.record_type",
        F.coalesce("original.payload_bytes", "capture.payload_bytes").alias("payload_bytes"),
        F.coalesce("original.payload_digest", "capture.payload_digest").alias("payload_digest"),
        F.col("original.record_id").alias("__original"))
    pages = rows.filter("record_type = 'response'").select(
        F.col("record_id").alias("__id"), F.col("page_id").alias("refers_to"))
    return rows.join(pages, F.col("__original") == F.col("__id"), "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
