import io as stdio
import json
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fairway.sources import ingest, json_split, testdata
from tests.conftest import SF001
from tests.test_ingest import EVENT_LIST, payload


class File(stdio.BytesIO):
    def read_at(self, n, at):
        self.seek(at)
        return self.read(n)


def split(text, size, monkeypatch=None):
    """Documents found by reading ``text`` in ranges of ``size`` bytes."""
    data, file = text.encode(), File(text.encode())
    if not data:
        return []
    starts = list(range(0, len(data), size))
    maps = [json_split.chunk_maps(np.frombuffer(data[a:a + size], np.uint8)) for a in starts]
    end, change, low = json_split.prefix_scan([np.stack(x) for x in zip(*maps)])
    first = data.removeprefix(b"\xef\xbb\xbf").strip(b" \t\r\n")[:1]
    out = []
    for i, a in enumerate(starts):
        state, depth = (0, 0) if not i else (int(end[i - 1, 0]), int(max(change[i - 1, 0], change[i - 1, 0] - low[i - 1, 0])))
        got = json_split.documents_in(file, a, min(a + size, len(data)), len(data), state, depth, int(first == b"["))
        out += [(p, d.decode()) for p, d in got]
    assert [p for p, _ in out] == sorted({p for p, _ in out})   # each once, in order
    return [d for _, d in out]


def value(rng, depth=0):
    kind = rng.randint(0, 5 if depth < 3 else 2)
    if kind < 3:
        return rng.choice(["", 'a"b', "\\", "\\\\", '\\"', "{", "]}", "é漢👍", "a, b", 1.5, None, True, -3, "\n\t"])
    if kind == 3:
        return [value(rng, depth + 1) for _ in range(rng.randint(0, 3))]
    return {rng.choice(["k", "\\", '"', "{"]) + str(i): value(rng, depth + 1) for i in range(rng.randint(0, 3))}


@pytest.mark.parametrize("size", [1, 2, 3, 7, 50, 10**6])
def test_any_range_size_gives_every_document_once(monkeypatch, size):
    monkeypatch.setattr(json_split, "CHUNK", 16)
    rng = random.Random(size)
    for n in range(25):
        docs = [{"d": value(rng)} for _ in range(rng.randint(0, 6))]
        texts = [json.dumps(d, indent=rng.choice([None, 2]), ensure_ascii=rng.random() < 0.5) for d in docs]
        forms = {"array": "[" + " ,\n".join(texts) + "]\n", "lines": "\n".join(texts), "run": "".join(texts),
                 "marked": "﻿ [" + ",".join(texts) + "]"}
        for name, text in forms.items():
            assert split(text, size) == texts, name


@pytest.mark.parametrize("size", [1, 4, 1000])
def test_what_is_no_document_is_kept(size):
    assert split('[{"a": 1}, 7, "x, y", {"b": 2} oops {"c": 3}]', size) == [
        '{"a": 1}', "7", '"x, y"', '{"b": 2}', "oops", '{"c": 3}']
    assert split('[{"a": 1}, {"b": [2', size) == ['{"a": 1}', '{"b": [2']
    assert split('{"a": 1}}} {"b": 2}', size) == ['{"a": 1}', '{"b": 2}']
    assert split(" \n\t ", size) == [] and split("[]", size) == []
    assert split('[[1, {"a": 2}], {"b": 3}]', size) == ['[1, {"a": 2}]', '{"b": 3}']


def test_composed_maps_equal_one_map():
    rng = np.random.default_rng(2)
    data = rng.choice(np.frombuffer(b'{}[]"\\a, ', np.uint8), 4000)
    whole = json_split.chunk_maps(data)
    parts = [json_split.chunk_maps(x) for x in np.array_split(data, 37)]
    scanned = json_split.prefix_scan([np.stack(x) for x in zip(*parts)])
    assert all((a[-1] == b).all() for a, b in zip(scanned, whole))


def test_a_range_is_read_once_and_little_beyond_it():
    docs = [payload(dg_id=i) for i in range(1500)]
    text = json.dumps(docs, indent=2).encode()
    assert len(text) > json_split.CHUNK   # ranges are much smaller than that

    class Counted(File):
        taken = 0

        def read_at(self, n, at):
            data = super().read_at(n, at)
            Counted.taken += len(data)
            return data

    file, size, found = Counted(text), 1 << 15, []
    maps = [json_split.chunk_maps(np.frombuffer(text[a:a + size], np.uint8)) for a in range(0, len(text), size)]
    end, change, low = json_split.prefix_scan([np.stack(x) for x in zip(*maps)])
    for i, a in enumerate(range(0, len(text), size)):
        state, depth = (0, 0) if not i else (int(end[i - 1, 0]), int(max(change[i - 1, 0], change[i - 1, 0] - low[i - 1, 0])))
        found += [json.loads(d) for _, d in json_split.documents_in(file, a, min(a + size, len(text)), len(text), state, depth, 1)]
    assert found == docs
    assert Counted.taken < 1.5 * len(text)


@pytest.mark.parametrize("size", [1, 2, 3, 4, 100])
def test_a_byte_order_mark_is_no_document_in_ranges_of_any_size(size):
    assert split('\ufeff7 {"a": 1}', size) == ["7", '{"a": 1}']
    assert split('\ufeff{"a": 1} x', size) == ['{"a": 1}', "x"]


def test_array_files_are_written_by_many_tasks_in_large_batches(spark):
    rows = spark.range(100).coalesce(1)   # one row group is one task
    assert rows.rdd.getNumPartitions() == 1
    dealt = testdata.spread(rows, 25)
    assert dealt.rdd.getNumPartitions() == 4 and dealt.count() == 100
    assert testdata.spread(rows, 1).rdd.getNumPartitions() == 8   # shuffle partitions
    assert testdata.spread(rows.where("id < 0")).rdd.getNumPartitions() == 1
    texts = [json.dumps({"a": i, "b": ["é"]}) for i in range(3000)]
    batches = [pa.record_batch([pa.array(x)], names=["value"]) for x in (texts[:1000], texts[1000:2999], [], texts[2999:])]
    out = list(testdata._as_array(iter(batches)))
    assert len(out) <= len(batches) + 1
    assert json.loads("\n".join(v for b in out for v in b.column("value").to_pylist())) == [json.loads(t) for t in texts]
    assert json.loads(next(testdata._as_array(iter([]))).column("value")[0].as_py()) == []


def test_a_generated_document_formats_its_tee_time_once(spark, capsys):
    events = testdata.table(spark, SF001, "events")
    testdata.mixed_documents(events).explain()
    assert capsys.readouterr().out.count("h:mma") == 1


def test_one_large_array_is_read_by_many_tasks_like_the_reader(spark, tmp_path):
    docs = [payload(dg_id=i) if i % 9 else payload("2023-09-06", dg_id=i) for i in range(300)]
    docs[7]["tour"] = "euro"
    folder = tmp_path / "landing place"
    folder.mkdir()
    (folder / "all.json").write_text(json.dumps(docs, indent=4))
    size = (folder / "all.json").stat().st_size
    found = json_split.read_documents(spark, str(folder), -(-size // 24))
    per_task = found.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(per_task) >= 8 and sum(r["count"] for r in per_task) == 300
    events = ingest.pga_events(ingest.parse_event_list(spark.createDataFrame([(json.dumps(EVENT_LIST),)], "value string")))
    mine, theirs = (ingest.rounds_from_payloads(p, events) for p in (
        ingest.read_split_payloads(spark, str(folder), 5000), ingest.read_payloads(spark, str(folder))))
    n = mine.rounds.count()
    assert sorted(map(str, mine.rounds.collect())) == sorted(map(str, theirs.rounds.collect())) != []
    names = [c for c in theirs.quarantine.columns if c != "document"]
    assert sorted(map(str, mine.quarantine.select(names).collect())) == sorted(map(str, theirs.quarantine.select(names).collect())) != []

    # a document of the wrong shape is one quarantined row; the reader gives up the whole file
    docs[5]["scores"] = "none"
    (folder / "all.json").write_text(json.dumps(docs, indent=4))
    again = ingest.rounds_from_payloads(ingest.read_split_payloads(spark, str(folder), 5000), events)
    assert again.rounds.count() == n - 4
    assert [r.reason for r in again.quarantine.where("document IS NOT NULL").collect()] == ["unreadable document"]
