import base64
import gzip
import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from corpora import prepared  # noqa: F401

from accrual.llm.common import hot_counts, new_folder, salted_join
from accrual.llm.warc import (
    deduplicate_pages, parse_records, parse_stream, read_archives, resolve_revisits, unpacked, unpacked_parts,
)

SCHEMA = "page_id long, url string, html string, extra string"
TRICKY = "x\r\n\r\nWARC/1.1\r\n\r\ny é"
PAGES = [
    (5, "http://a/", TRICKY), (2, None, TRICKY), (9, "http://c/\r\nX: y", TRICKY), (1, "u", ""), (3, "u", None),
    (None, "u", "lone"), (7, "u", "z" * 300_000), (8, "u", "same"), (8, "u", "same"), (4, "u", "\n"),
]


def pages(spark):
    return spark.createDataFrame([(*p, "e") for p in PAGES], SCHEMA)


def brute(min_bytes):
    first, out = {}, []
    for page, _, html in PAGES:
        digest = base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()
        if page is not None:
            first[digest] = min(first.get(digest, page), page)
    for page, _, html in PAGES:
        data = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        to = first.get(digest)
        revisit = len(data) >= min_bytes and page != to
        out.append((page, len(data), digest, "revisit" if revisit else "response", to if revisit else None))
    return sorted(out, key=repr)


def test_against_brute_force(spark):
    for min_bytes in (0, 10):
        out = deduplicate_pages(pages(spark), min_bytes=min_bytes)
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        assert sorted((tuple(r) for r in out.select(names).collect()), key=repr) == brute(min_bytes)


def test_archives_are_warc_and_payloads_come_back(spark):
    folder = new_folder(spark, "test-warc")
    deduplicate_pages(pages(spark), folder).count()
    records = []
    for file in Path(folder.removeprefix("file:")).glob("*.gz"):
        records += parse_records(gzip.decompress(file.read_bytes()))
    assert len(records) == len(PAGES)
    assert len({r["WARC-Record-ID"] for r in records if r["WARC-Type"] == "response"}) == 6
    revisits = [r for r in records if r["WARC-Type"] == "revisit"]
    assert all(r["payload"] == b"" and "WARC-Refers-To" in r and "WARC-Profile" in r for r in revisits)
    back = read_archives(spark, folder, with_payload=True).where("record_type = 'response'")
    kept = {bytes(r["payload"]).decode() for r in back.collect()}
    assert kept == {h or "" for _, _, h in PAGES}


def test_archives_of_many_members(spark, tmp_path):
    """One gzip member per record, as most writers have it, and padding at the end."""
    folder = new_folder(spark, "test-warc")
    deduplicate_pages(pages(spark), folder).count()
    whole = b"".join(gzip.decompress(f.read_bytes()) for f in sorted(Path(folder.removeprefix("file:")).glob("*.gz")))
    ends, at = [], 0
    for r in parse_records(whole):
        at = whole.index(b"\r\n\r\n", at) + 4 + int(r["Content-Length"]) + 4
        ends.append(at)
    members = [gzip.compress(whole[a:b]) for a, b in zip([0, *ends], ends)]
    (tmp_path / "many.warc.gz").write_bytes(b"".join(members) + b"\x00" * 8)
    back = read_archives(spark, str(tmp_path))
    assert back.count() == len(PAGES) == len(members)
    (tmp_path / "empty.warc.gz").write_bytes(b"")
    assert read_archives(spark, str(tmp_path)).count() == len(PAGES)
    with pytest.raises(ValueError):
        unpacked(members[0][:-9])


def test_parts_cut_anywhere():
    """Records and members come whole however the parts fall, and a large one among small ones."""
    record = b"WARC/1.1\r\nContent-Length: %d\r\n\r\nHTTP/1.1 200 OK\r\n\r\n%b\r\n\r\n"
    bodies = [b"a\r\n\r\n\r", b"", b"x" * 50_000_000, b"\r\n"]
    data = [record % (len(b) + 19, b) for b in bodies]
    packed = b"".join(map(gzip.compress, data))
    parts = list(unpacked_parts(packed))
    assert max(map(len, parts)) <= 1 << 20
    assert [r["payload"] for r in parse_stream(parts)] == bodies
    short = data[0] + data[1] + data[3]
    for n in (1, 2, 3, 5):
        cut = [short[i : i + n] for i in range(0, len(short), n)]
        assert [r["payload"] for r in parse_stream(cut)] == [bodies[0], bodies[1], bodies[3]]
    for bad in (short[:-1], short[:-30], b"text\r\n\r\n"):
        with pytest.raises(ValueError):
            list(parse_stream([bad]))


def test_resolution_keeps_rows(spark):
    assert resolve_revisits(pages(spark)).count() == len(PAGES)


def test_empty(spark):
    assert deduplicate_pages(pages(spark).limit(0)).count() == 0


def test_salted_join_cuts_hot_keys(spark):
    left = spark.range(3000).select(F.when(F.col("id") < 1000, 0).otherwise(F.col("id")).alias("k"), "id")
    right = left.groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("top"))
    hot = hot_counts(right, "k", "n").collect()
    assert [(r["k"], r["_k"] > 50) for r in hot] == [(0, True)]
    out = salted_join(left, right, "k", "n", F.col("id"))
    assert out.count() == 3000 and out.where("k = 0 and top = 999").count() == 1000
