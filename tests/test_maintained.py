import datetime as dt
import random

import pytest
from pyspark.sql import types as T

from fairway.operators import form
from fairway.operators.difficulty import course_factor, event_difficulty
from fairway.operators.joins import run_scope
from fairway.sources import io
from fairway.sources.schemas import LANDED, ROUNDS
from fairway.streaming.landing import latest_rounds, merge_rounds
from fairway.streaming.maintained import MaintainedDifficulty, MaintainedIndex
from tests.conftest import same


def landing(spark, rows):
    """Rounds with the given ``at`` (seconds) as the time of their file."""
    names = [f.name for f in ROUNDS.fields]
    data = [(*(r.get(n) for n in names), None if r.get("at") is None else (
        dt.datetime(2024, 1, 1) + dt.timedelta(seconds=r["at"]), r.get("file", "f"), 0)) for r in rows]
    return spark.createDataFrame(data, T.StructType([*ROUNDS.fields, LANDED]))


def round_of(event, player, no, score, at=0, **more):
    return {"year": 2024, "event_id": event, "event_name": f"e{event}", "dg_id": player, "player_name": f"p{player}", "round": no,
            "course_num": event % 3, "course_name": "c", "score": score, "sg_total": None if score is None else score / 10,
            "teetime": dt.datetime(2024, 1, 1 + event, 8 + no), "at": at, **more}


def stored(spark, root):
    return sorted(((r.event_id, r.dg_id, r.player_name, r["round"], r.score) for r in io.read_rounds(spark, root).collect()), key=str)


def test_replayed_batches_leave_each_round_once(spark, tmp_path):
    root = str(tmp_path / "r")
    batch = landing(spark, [
        round_of(1, None, 1, 70, player_name="no id"), round_of(1, None, 1, 71, player_name="another"),
        round_of(1, None, 2, 72, player_name=None), round_of(1, 5, 1, 73, at=1, file="a"), round_of(1, 5, 1, 74, at=2, file="b"),
        round_of(1, 6, 1, None)])
    for _ in range(3):
        with run_scope():
            merge_rounds(batch, root)
        assert stored(spark, root) == sorted([(1, None, "no id", 1, 70), (1, None, "another", 1, 71), (1, None, None, 2, 72),
                                              (1, 5, "p5", 1, 74), (1, 6, "p6", 1, None)], key=str)


def test_one_rule_within_and_across_batches(spark, tmp_path):
    rows = [round_of(e, p, 1, 60 + s, at=a, file=f) for e in (1, 2) for p in (None, 1, 2)
            for s, (a, f) in enumerate([(5, "a"), (5, "b"), (9, "a"), (None, None)])]
    want = None
    for seed in range(2):
        order = rows[:]
        random.Random(seed).shuffle(order)
        root = str(tmp_path / f"r{seed}")
        for a in range(0, len(order), 10):
            with run_scope():
                merge_rounds(landing(spark, order[a:a + 10]), root)
        assert want is None or stored(spark, root) == want
        want = stored(spark, root)
    assert len(want) == 6 and {x[4] for x in want} == {62}
    assert sorted(str(r.score) for r in latest_rounds(landing(spark, rows)).collect()) == ["62"] * 6


def test_merge_reads_only_the_folders_of_its_events(spark, tmp_path):
    from fairway.streaming import landing as module

    root = str(tmp_path / "r")
    with run_scope():
        merge_rounds(landing(spark, [round_of(e, 1, 1, 70) for e in range(6)]), root)
    events = spark.createDataFrame([(2024, 3)], "year long, event_id long")
    got = module.stored_rounds(spark, root, events)
    assert [r.event_id for r in got.collect()] == [3]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "event_id" in plan.split("PartitionFilters: [")[1].split("]")[0]


def full(spark, rounds, periods):
    factors = course_factor(event_difficulty(rounds))
    return factors, form.rolling_index_multi(rounds, factors, periods)


def same_rows(got, want):
    key = lambda r: str([r[c] for c in ("period", "dg_id", "player_name", "teetime", "score", "event_name")])
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert len(got) == len(want) > 0
    for a, b in zip(got, want):
        assert all(same(a[c], b[c]) for c in b.asDict()), (a, b)


@pytest.mark.parametrize("seed,skewed", [(1, False), (3, True)])
def test_index_and_difficulty_after_increments_equal_a_full_run(spark, tmp_path, monkeypatch, seed, skewed):
    if skewed:
        monkeypatch.setattr(form, "max_group_rows", lambda spark: 1)
        monkeypatch.setattr(form, "_block_rows", lambda p: 7)
    rng = random.Random(seed)
    periods, root = (2, 5), str(tmp_path)
    index, sums = MaintainedIndex(spark, f"{root}/i", periods, 4), MaintainedDifficulty(spark, f"{root}/d", 4)

    def some(events, at):
        return [round_of(e, p, n, rng.randint(64, 84) if rng.random() < 0.95 else None, at,
                         player_name=f"p{p}" + "x" * (rng.random() < 0.05))
                for e in events for p in (None, *range(1, 9)) if rng.random() < 0.8 for n in (1, 2)]

    for step, events in enumerate(([0, 1, 2, 3], [5, 6], [4], [1, 6, 7])):
        with run_scope():
            merged = merge_rounds(landing(spark, some(events, step)), f"{root}/r")
            sums.update(merged.events, merged.rounds)
            index.update(*merged, sums.factors())
            rounds = io.read_rounds(spark, f"{root}/r")
            factors, want = full(spark, rounds, periods)
            same_rows(index.index().collect(), want.collect())
            got = {r.course_num: r for r in sums.factors().collect()}
            for r in factors.collect():
                assert all(same(got[r.course_num][c], r[c]) for c in r.asDict())
            assert sorted(map(str, sums.difficulty().collect())) == sorted(map(str, event_difficulty(rounds).collect()))


def test_update_reads_and_writes_only_the_touched_players(spark, tmp_path):
    periods, root = (2,), str(tmp_path)
    index = MaintainedIndex(spark, f"{root}/i", periods, 64)
    factors = spark.createDataFrame([(c, 1.0) for c in range(3)], "course_num long, course_factor_star double")
    with run_scope():
        first = merge_rounds(landing(spark, [round_of(e, p, 1, 60 + p) for e in range(3) for p in range(40)]), f"{root}/r")
        every = index.update(*first, factors)
    before = index.store.versions()
    with run_scope():
        merged = merge_rounds(landing(spark, [round_of(8, p, 1, 70) for p in (3, 4)]), f"{root}/r")
        assert sorted(r.dg_id for r in merged.touched.collect()) == [3, 4]
        buckets = index.update(*merged, factors)
        rounds = io.read_rounds(spark, f"{root}/r")
        same_rows(index.index().collect(), form.rolling_index_multi(rounds, factors, periods).collect())
    after = index.store.versions()
    assert len(buckets) <= 2 < len(every) and {b for b in after if after[b] != before.get(b)} == set(buckets)
    # framing starts p - 1 rounds before the first change
    inputs = index.store.read(__import__("fairway.streaming.maintained", fromlist=["INPUTS"]).INPUTS, "inputs")
    touched = spark.createDataFrame([(3, dt.datetime(2024, 1, 9))], "dg_id long, since timestamp_ntz")
    with run_scope():
        framed = index._framed(inputs, touched, factors)
        assert [(r.dg_id, r.event_name) for r in framed.collect()] == [(3, "e8")]


def test_a_moved_factor_recomputes_the_players_of_its_course(spark, tmp_path):
    index = MaintainedIndex(spark, f"{tmp_path}/i", (2,), 8)
    table = lambda x: spark.createDataFrame([(0, 1.0), (1, x), (2, 1.0)], "course_num long, course_factor_star double")
    with run_scope():
        merged = merge_rounds(landing(spark, [round_of(e, p, 1, 60 + p) for e in range(4) for p in range(4)]), f"{tmp_path}/r")
        index.update(*merged, table(1.0))
        none = merged.events.where("false"), merged.rounds.where("false"), merged.touched.where("false")
        assert index.update(*none, table(1.0)) == []
        index.update(*none, table(5.0))
        same_rows(index.index().collect(), form.rolling_index_multi(merged.rounds, table(5.0), (2,)).collect())
