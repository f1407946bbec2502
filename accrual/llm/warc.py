"""WARC archives with revisit resolution.

Payload digests are computed where the pages lie. The headers (digest, length, page) are aggregated by
digest to find each payload's first page, pages are joined with that on the digest, and every page is
written as one WARC/1.1 record with fresh headers: a ``response`` with its payload, or a ``revisit``
that refers to the response and repeats only its HTTP header. The archives are written by Spark's text
writer, whose line separator is the end-of-record mark, so any file system Spark knows will do; each
file holds whole records, and files are as large as the partitions are.

Reading unpacks each archive file part by part and takes it apart by the lengths its headers state, so a
task holds the packed file and one record, however much the file unpacks to. Payloads are checked against
their digests, and revisits joined with the responses they refer to. A page of any length is one record.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from accrual.llm.common import BATCH_BYTES, new_folder, salted_join, stored

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CRLF = "\r\n"
RECORD_END = CRLF * 2
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
WARC_DATE = "2024-01-01T00:00:00Z"
RECORDS_PER_FILE = 5_000
FED, PART = 1 << 16, 1 << 20


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1 of ``payload`` (32 characters)."""
    digest = F.sha1(payload)
    letters = []
    for part in range(8):  # 5 hex digits are 20 bits, which are 4 letters
        bits = F.conv(F.substring(digest, 5 * part + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            at = F.shiftright(bits, shift).bitwiseAND(31) + 1
            letters.append(F.substring(F.lit(ALPHABET), at, F.lit(1)))
    return F.concat(*letters)


def _record_id(page: Column, digest: Column) -> Column:
    """A urn:uuid made from the page and its payload, the same on every run."""
    h = F.md5(F.concat_ws("|", F.coalesce(page.cast("string"), F.lit("")), digest).cast("binary"))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (14, 3), (18, 3), (21, 12))]
    return F.concat(
        F.lit("<urn:uuid:"), cut[0], F.lit("-"), cut[1], F.lit("-5"), cut[2], F.lit("-8"), cut[3],
        F.lit("-"), cut[4], F.lit(">"),
    )


def resolve_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``page_id, url, payload, payload_bytes, payload_digest, first_page, record_type``.

    Of the pages with equal payloads of at least ``min_bytes`` that with the smallest ``page_id`` is
    the response and the others revisit it. A NULL html is an empty payload. Rows that repeat the
    response's own page are responses too; a page without an id is a response only if no page with
    that payload has one.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    held = pages.select(
        "page_id",
        "url",
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        base32_sha1(payload).alias("payload_digest"),
    )
    first = held.groupBy("payload_digest").agg(
        F.min("page_id").alias("first_page"), F.count(F.lit(1)).alias("_rows")
    )
    first = stored(first, "payloads")
    revisit = (F.col("payload_bytes") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("first_page"))
    joined = salted_join(held, first, "payload_digest", "_rows", F.monotonically_increasing_id())
    return joined.withColumn(
        "record_type", F.when(revisit, "revisit").otherwise("response")
    )


def _header(name: str, value: Column) -> Column:
    """A header line, or nothing where ``value`` is NULL."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))


def warc_records(resolved: DataFrame, date: str = WARC_DATE) -> DataFrame:
    """One WARC record per row, without its end mark, in column ``value``."""
    is_revisit = F.col("record_type") == "revisit"
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit(RECORD_END),
    )
    block = F.when(is_revisit, http).otherwise(F.concat(http, F.col("payload")))
    # A URL with line breaks would end the header early.
    url = F.regexp_replace(F.col("url"), r"[\x00-\x20]+", "")
    revisit_only = lambda c: F.when(is_revisit, c)
    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        _header("WARC-Type", F.col("record_type")),
        _header("WARC-Record-ID", _record_id(F.col("page_id"), F.col("payload_digest"))),
        _header("WARC-Date", F.lit(date)),
        _header("WARC-Target-URI", url),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _header("WARC-Profile", revisit_only(F.lit(PROFILE))),
        _header(
            "WARC-Refers-To",
            revisit_only(_record_id(F.col("first_page"), F.col("payload_digest"))),
        ),
        _header("WARC-Refers-To-Date", revisit_only(F.lit(date))),
        _header("X-Page-Id", F.col("page_id").cast("string")),
        _header("Content-Type", F.lit("application/http; msgtype=response")),
        _header("Content-Length", F.octet_length(block).cast("string")),
        F.lit(CRLF),
    )
    return resolved.select(F.concat(head, block).alias("value"))


def write_archives(records: DataFrame, folder: str, per_file: int = RECORDS_PER_FILE) -> None:
    """Write records as gzipped WARC files of at most ``per_file`` records each."""
    records.write.option("lineSep", RECORD_END).option("compression", "gzip").option(
        "maxRecordsPerFile", per_file
    ).text(folder)


READ_SCHEMA = (
    "page_id long, url string, record_type string, record_id string, refers_to_record string, "
    "stated_digest string, payload_bytes long, payload_digest string, payload binary"
)


def parse_stream(parts: Iterable[bytes]) -> Iterator[dict]:
    """The records of one archive, taken apart by their stated lengths; one record is held at a time."""
    parts, held, at = iter(parts), bytearray(), 0

    def more() -> bool:
        part = next(parts, None)
        held.extend(part or b"")
        return part is not None

    while held or more():
        looked = 0
        while (end := held.find(b"\r\n\r\n", max(0, looked - 3))) < 0:
            looked = len(held)
            if not more():
                raise ValueError(f"broken WARC record at byte {at}")
        lines = held[:end].decode("utf-8").split(CRLF)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        start = end + 4
        stop = start + int(headers["Content-Length"])
        while len(held) < stop + 4 and more():
            pass
        if held[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"broken WARC record at byte {at}")
        body = held.index(b"\r\n\r\n", start) + 4
        yield headers | {"payload": bytes(held[body:stop])}
        del held[: stop + 4]
        at += stop + 4


def parse_records(data: bytes) -> Iterator[dict]:
    """The records of an archive that is there as a whole."""
    return parse_stream([data] if data else [])


def unpacked_parts(content: bytes) -> Iterator[bytes]:
    """All gzip members of an archive, one after another, in parts of at most ``PART`` bytes.

    Archives often have a member for each record. Zero bytes after the last member are padding. An
    archive that ends within a member is an error.
    """
    at = 0
    while at < len(content):
        member = zlib.decompressobj(wbits=47)
        while not member.eof:
            given = member.unconsumed_tail
            if not given:
                given = content[at : at + FED]
                at += len(given)
            part = member.decompress(given, PART)
            if part:
                yield part
            elif not given and not member.eof:
                raise ValueError("the archive ends within a gzip member")
        at -= len(member.unused_data)
        while at < len(content) and content[at] == 0:
            at += 1


def unpacked(content: bytes) -> bytes:
    """All of an archive's members as one."""
    return b"".join(unpacked_parts(content))


def _frame(rows: list[tuple]) -> pd.DataFrame:
    made = pd.DataFrame(rows, columns=[c.split()[0] for c in READ_SCHEMA.split(", ")], dtype=object)
    for name in ("page_id", "payload_bytes"):
        made[name] = made[name].astype("Int64")
    return made


def _read(frames: Iterator[pd.DataFrame], with_payload: bool) -> Iterator[pd.DataFrame]:
    out, held = [], 0
    for frame in frames:
        for content in frame["content"]:
            for r in parse_stream(unpacked_parts(content)):
                response = r["WARC-Type"] == "response"
                body = r["payload"]
                out.append((
                    int(r["X-Page-Id"]) if "X-Page-Id" in r else None,
                    r.get("WARC-Target-URI"),
                    r["WARC-Type"],
                    r["WARC-Record-ID"],
                    r.get("WARC-Refers-To"),
                    r["WARC-Payload-Digest"].removeprefix("sha1:"),
                    len(body) if response else None,
                    base64.b32encode(hashlib.sha1(body).digest()).decode() if response else None,
                    body if response and with_payload else None,
                ))
                held += len(body) if with_payload else 0
                if held >= BATCH_BYTES or len(out) == RECORDS_PER_FILE:
                    yield _frame(out)
                    out, held = [], 0
    yield _frame(out)


def read_archives(spark: SparkSession, folder: str, with_payload: bool = False) -> DataFrame:
    """The records of all archives in ``folder``; digest and length of responses are measured.

    A response whose payload does not have the digest its header states is an error.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder)
    read = files.select("content").mapInPandas(
        lambda frames: _read(frames, with_payload), READ_SCHEMA
    )
    wrong = F.raise_error(F.concat(F.lit("payload does not match its digest: "), F.col("record_id")))
    return read.withColumn(
        "payload_digest",
        F.when(F.col("payload_digest") == F.col("stated_digest"), F.col("payload_digest"))
        .when(F.col("payload_digest").isNull(), None)
        .otherwise(wrong),
    )


def join_revisits(records: DataFrame) -> DataFrame:
    """Every record with its full payload's length and digest and, for revisits, ``refers_to``.

    ``records`` must give the same rows on every read. Repeated responses of one record id count once;
    a revisit whose response is missing has no length and digest.
    """
    is_revisit = F.col("record_type") == "revisit"
    revisits = records.where(is_revisit)
    wanted = revisits.groupBy("refers_to_record").agg(F.count(F.lit(1)).alias("_rows"))
    originals = (
        records.where(~is_revisit)
        .groupBy(F.col("record_id").alias("refers_to_record"))
        .agg(
            F.min("page_id").alias("refers_to"),
            F.min("payload_bytes").alias("_bytes"),
            F.min("payload_digest").alias("_digest"),
        )
    )
    originals = stored(wanted.join(originals, "refers_to_record", "left"), "revisited")
    resolved = salted_join(
        revisits, originals, "refers_to_record", "_rows", F.monotonically_increasing_id()
    ).select(
        "page_id",
        F.col("_bytes").alias("payload_bytes"),
        F.col("_digest").alias("payload_digest"),
        "record_type",
        "refers_to",
        "url",
    )
    own = records.where(~is_revisit).select(
        "page_id",
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.lit(None).cast("long").alias("refers_to"),
        "url",
    )
    return own.union(resolved)


def deduplicate_pages(pages: DataFrame, folder: str | None = None, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as deduplicated archives and return what reading them back gives.

    ``folder`` defaults to a new one in the shared folder. An empty table writes no archive and gives
    no rows. Columns other than page_id, url and html are not archived.
    """
    spark = pages.sparkSession
    folder = folder or new_folder(spark, "warc")
    write_archives(warc_records(resolve_revisits(pages, min_bytes)), folder)
    headers = stored(read_archives(spark, folder).drop("payload"), "warc-headers")
    return join_revisits(headers)
