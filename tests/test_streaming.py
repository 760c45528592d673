import json

from fairway.sources import ingest, io
from fairway.streaming.landing import open_quarantine, start_ingest
from tests.test_ingest import EVENT_LIST, ROUNDS, payload, text_df


def test_incremental_landing_ingest(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "harbour-2023.json").write_text(json.dumps(payload()))
    events = ingest.pga_events(ingest.parse_event_list(text_df(spark, [EVENT_LIST])))
    out, quarantine, ckpt = (str(tmp_path / n) for n in ("rounds", "quarantine", "ckpt"))

    q = start_ingest(spark, str(landing), events, out, quarantine, ckpt)
    q.awaitTermination(120)
    assert io.read_rounds(spark, out).count() == 4

    # a re-run skips processed documents; a new (bad) document is quarantined
    (landing / "harbour-2023-wed.json").write_text(json.dumps(payload("2023-09-06")))
    q = start_ingest(spark, str(landing), events, out, quarantine, ckpt)
    q.awaitTermination(120)
    assert io.read_rounds(spark, out).count() == 4
    assert spark.read.parquet(quarantine).count() == 4


def test_replayed_batches_are_idempotent(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.json").write_text(json.dumps(payload()))
    (landing / "b.json").write_text(json.dumps(payload("2023-09-06")))
    events = ingest.pga_events(ingest.parse_event_list(text_df(spark, [EVENT_LIST])))
    out, quarantine = str(tmp_path / "rounds"), str(tmp_path / "quarantine")
    for ckpt in ("ckpt1", "ckpt2"):   # a lost checkpoint replays every document
        q = start_ingest(spark, str(landing), events, out, quarantine, str(tmp_path / ckpt))
        q.awaitTermination(120)
        assert io.read_rounds(spark, out).count() == 4
        assert spark.read.parquet(quarantine).count() == 4


def test_two_documents_of_one_event_in_two_batches(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.json").write_text(json.dumps(payload()))
    (landing / "b.json").write_text(json.dumps(payload(dg_id=5000)))
    (landing / "c.json").write_text("{broken")
    events = ingest.pga_events(ingest.parse_event_list(text_df(spark, [EVENT_LIST])))
    out, quarantine, ckpt = (str(tmp_path / n) for n in ("rounds", "quarantine", "ckpt"))
    q = start_ingest(spark, str(landing), events, out, quarantine, ckpt, max_files_per_trigger=1)
    q.awaitTermination(180)
    rounds = io.read_rounds(spark, out)
    assert sorted((r.dg_id, r["round"]) for r in rounds.collect()) == [(d, i) for d in (4077, 5000) for i in range(1, 5)]
    assert [r.reason for r in spark.read.parquet(quarantine).collect()] == ["unreadable document"]

    # a corrected document closes its quarantined rows
    bad = [(r[:7] + ("soon",)) for r in ROUNDS]
    (landing / "d.json").write_text(json.dumps(payload(rounds=bad, dg_id=6000)))
    start_ingest(spark, str(landing), events, out, quarantine, ckpt).awaitTermination(180)
    assert open_quarantine(spark.read.parquet(quarantine), io.read_rounds(spark, out)).count() == 5
    (landing / "e.json").write_text(json.dumps(payload(dg_id=6000)))
    start_ingest(spark, str(landing), events, out, quarantine, ckpt).awaitTermination(180)
    rounds = io.read_rounds(spark, out)
    assert rounds.count() == 12
    assert open_quarantine(spark.read.parquet(quarantine), rounds).count() == 1
