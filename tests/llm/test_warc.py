import gzip
import random

import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F

from fairway.llm import warc


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def brute(rows):
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(first.get(html or "", i), i)
    out = []
    for i, _, html in rows:
        f = first.get(html or "")
        revisit = f is not None and f != i
        data = (html or "").encode()
        out.append((i, len(data), warc.payload_digest(data), "revisit" if revisit else "response", f if revisit else None))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    some = [None, "", "<html>é漢</html>", "x" * 200_000, "\x1f\x08 magic", "WARC/1.1\r\n\r\nnot a record"]
    return [(i, rng.choice([None, "http://a/b", "http://c/\r\nX: y"]), rng.choice(some + [f"<p>{rng.random()}</p>" * rng.randint(1, 90)]))
            for i in range(300)] + [(7, "http://a", "same"), (7, "http://a", "same"), (None, "u", ""), (None, "u", "alone")]


def test_round_trip(spark, rows):
    got = sorted((tuple(r) for r in warc.archived_pages(pages(spark, rows)).collect()), key=str)
    assert got == brute(rows)


@pytest.mark.parametrize("size", [1, 37, 1000, 10**9])
def test_any_range_size_reads_every_record_once(spark, tmp_path, rows, size):
    few = rows[:25] if size == 1 else rows
    few = [r for r in few if len(r[2] or "") < 1000] if size == 1 else few
    folder = f"file://{tmp_path}/a"
    manifest = warc.write_archives(pages(spark, few).coalesce(1), folder)
    found = []
    for m in manifest.collect():
        fs, place = pafs.FileSystem.from_uri(m.path)
        with fs.open_input_file(place) as file:
            for start in range(0, m.bytes, size):
                found += [data for _, data in warc.records_in(file, start, min(start + size, m.bytes))]
        with fs.open_input_file(place) as file:  # any gzip reader gives the same bytes
            assert gzip.decompress(file.read()) == b"".join(found[-m.records:])
    assert len(found) == len(few)


def test_records_have_the_standard_fields(rows):
    fields, block = warc.parse(warc.record(3, "http://x/\n", b"body", None))
    assert fields["warc-type"] == "response" and fields["warc-target-uri"] == "http://x/%0A"
    assert block.endswith(b"\r\n\r\nbody")
    fields, block = warc.parse(warc.record(4, None, b"body", 3))
    assert fields["warc-type"] == "revisit" and fields["warc-refers-to"] == "<urn:x-page:3>" and b"body" not in block


def test_small_payloads_are_not_deduplicated(spark):
    rows = [(1, "u", "a"), (2, "u", "a"), (3, "u", "long enough"), (4, "u", "long enough")]
    manifest = warc.write_archives(pages(spark, rows), least_bytes=5)
    assert sorted(r.type for r in warc.read_archives(spark, manifest).collect()) == ["response"] * 3 + ["revisit"]


def test_many_tasks_read_the_archives(spark):
    rng = random.Random(9)
    rows = [(i, "u", "".join(rng.choices("abcdefgh", k=3000))) for i in range(400)]
    manifest = warc.write_archives(pages(spark, rows).coalesce(1))
    size = manifest.first().bytes
    records = warc.read_archives(spark, manifest, -(-size // 12))
    per_task = records.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(per_task) == 12 and sum(r["count"] for r in per_task) == 400


def test_empty(spark):
    assert warc.archived_pages(pages(spark, [])).count() == 0
