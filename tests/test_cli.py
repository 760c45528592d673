import json

from fairway import cli
from fairway.sources import io
from tests.test_ingest import EVENT_LIST, ROUNDS, payload


def test_cli_ingest_metrics_extracts(spark, tmp_path):
    (tmp_path / "events.json").write_text(json.dumps(EVENT_LIST))
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.json").write_text(json.dumps(payload()))
    (landing / "b.json").write_text(json.dumps(payload("2023-09-06")))
    rounds, quarantine, out = (str(tmp_path / n) for n in ("rounds", "quarantine", "out"))
    cli.main(["ingest", "--event-list", str(tmp_path / "events.json"), "--landing", str(landing),
              "--rounds", rounds, "--quarantine", quarantine])
    assert io.read_rounds(spark, rounds).count() == 4
    assert spark.read.parquet(quarantine).count() == 4
    # landed events are skipped: a rerun writes nothing
    before = sorted((p, p.stat().st_mtime_ns) for p in (tmp_path / "rounds").rglob("*.parquet"))
    cli.main(["ingest", "--event-list", str(tmp_path / "events.json"), "--landing", str(landing),
              "--rounds", rounds, "--quarantine", quarantine])
    assert before == sorted((p, p.stat().st_mtime_ns) for p in (tmp_path / "rounds").rglob("*.parquet"))
    cli.main(["metrics", "--rounds", rounds, "--out", out, "--periods", "2,3"])
    assert io.read_form_index(spark, out + "/form_index", 2).count() == 3
    cli.main(["extracts", "--out", out, "--period", "2", "--year", "2023", "--player", "4077"])
    assert io.read_csv(spark, out + "/form_player").count() == 3


def test_split_ingest_and_maintained_stream(spark, tmp_path, monkeypatch):
    from fairway.operators.difficulty import event_difficulty
    from fairway.sources import io
    from fairway.streaming.maintained import MaintainedDifficulty, MaintainedIndex

    monkeypatch.setattr(cli, "get_spark", lambda: spark)
    (tmp_path / "events.json").write_text(json.dumps(EVENT_LIST))
    (tmp_path / "arrays").mkdir()
    (tmp_path / "arrays" / "all.json").write_text(json.dumps([payload(), payload(dg_id=5000)], indent=2))
    (tmp_path / "landing").mkdir()
    no_score = [(None, *r[1:]) for r in ROUNDS]
    (tmp_path / "landing" / "one.json").write_text(json.dumps(payload(dg_id=5000), indent=2))
    (tmp_path / "landing" / "team.json").write_text(json.dumps(payload(rounds=no_score), indent=2))
    for out, more in (("a", ["--landing", f"{tmp_path}/arrays", "--split"]),
                      ("b", ["--landing", f"{tmp_path}/landing", "--stream", "--checkpoint", f"{tmp_path}/c", "--difficulty",
                             f"{tmp_path}/d", "--index", f"{tmp_path}/i", "--periods", "2"])):
        cli.main(["ingest", "--event-list", f"{tmp_path}/events.json", "--rounds", f"{tmp_path}/{out}", "--quarantine",
                  f"{tmp_path}/q{out}", *more])
        rounds = io.read_rounds(spark, f"{tmp_path}/{out}", f"{tmp_path}/footers-{out}")
        assert sorted((r.dg_id, r["round"]) for r in rounds.collect()) == [(d, i) for d in (4077, 5000) for i in range(1, 5)]
    # rounds without a score land and stay; they count as rounds, never as scores
    assert sorted({r.dg_id for r in rounds.where("score IS NULL").collect()}) == [4077]
    got = MaintainedDifficulty(spark, f"{tmp_path}/d").difficulty().collect()
    assert sorted(map(str, got)) == sorted(map(str, event_difficulty(rounds).collect()))
    assert {r.dg_id for r in MaintainedIndex(spark, f"{tmp_path}/i", (2,)).index(2).collect()} == {5000}
