import math
import random

import pytest
from pyspark.sql import functions as F

from fairway.functions.rules import wave
from fairway.operators import form
from fairway.operators.sequence import global_row_number
from tests.conftest import make_rounds, same, ts

FACTOR_COLS = "course_num long, course_factor_star double"


def factors(spark, pairs):
    return spark.createDataFrame(pairs, FACTOR_COLS)


def hand_rounds(spark):
    # two players, one event, same wave each round (FIXTURES rolling hand case)
    rows = []
    for rnd, course, p1, p2 in [(1, 1, (70, 1.0), (74, -0.5)), (2, 2, (72, 0.0), (70, -0.5))]:
        for dg, (score, sg) in ((1, p1), (2, p2)):
            rows.append(dict(year=2021, event_id=10, event_name="ev", dg_id=dg,
                             player_name=f"p{dg}", round=rnd, course_num=course, score=score,
                             sg_total=sg, teetime=ts(2021, 6, 16 + rnd, 8, dg)))
    return make_rounds(spark, rows)


def test_hand_case_period_2(spark):
    out = {r.dg_id: r for r in form.rolling_index(
        hand_rounds(spark), factors(spark, [(1, 2.0), (2, 1.0)]), period=2).collect()}
    assert set(out) == {1, 2}
    assert same(out[1].ppi, 1.0) and same(out[1].sg_total, 0.5)
    assert out[1].category == "Proper Player" and same(out[1].ppi_sg_diff, 0.5)
    assert same(out[2].ppi, -1.0) and same(out[2].sg_total, -0.5)
    assert out[2].category == "Mule" and same(out[2].ppi_sg_diff, -0.5)
    assert out[1].first_tee_time_in_group == ts(2021, 6, 17, 8, 1)
    assert out[1].wave_average == 71.0 and out[1].score == 72


def test_fewer_rounds_than_period(spark):
    assert form.rolling_index(hand_rounds(spark), factors(spark, [(1, 2.0), (2, 1.0)]),
                              period=3).count() == 0


def test_weights_zero_null_inf(spark):
    base = hand_rounds(spark)
    zero = form.rolling_index(base, factors(spark, [(1, 0.0), (2, 0.0)]), 2).collect()
    assert all(math.isnan(r.ppi) for r in zero)
    # NaN counts as largest: sg >= 0 -> Proper Player, sg < 0 -> Gamer
    assert {r.dg_id: r.category for r in zero} == {1: "Proper Player", 2: "Gamer"}
    inf = form.rolling_index(base, factors(spark, [(1, math.inf), (2, 1.0)]), 2).collect()
    assert all(math.isnan(r.ppi) for r in inf)
    # unmatched course: NULL factor leaves both sums but still counts as a round
    unmatched = {r.dg_id: r for r in form.rolling_index(
        base, factors(spark, [(2, 1.0)]), 2).collect()}
    assert same(unmatched[1].ppi, (71 - 72) * 1.0 / 1.0)
    assert unmatched[1].course_factor_star == 1.0


def test_null_strokes_gained_is_mule(spark):
    rows = [dict(year=2021, event_id=1, event_name="e", dg_id=1, player_name="a", round=i,
                 course_num=1, score=70, sg_total=None, teetime=ts(2021, 1, i, 9))
            for i in (1, 2)]
    out = form.rolling_index(make_rounds(spark, rows), factors(spark, [(1, 1.0)]), 2).collect()
    assert len(out) == 1 and out[0].category == "Mule" and out[0].ppi_sg_diff is None


def test_interleaved_names_range_frame(spark):
    # one id, names A A B A A A in time order, period 3: the frame runs over
    # index values, so only the last row has 3 same-name rounds in it
    names = ["A", "A", "B", "A", "A", "A"]
    rows = [dict(year=2021, event_id=1, event_name="e", dg_id=7, player_name=n, round=1,
                 course_num=1, score=70, sg_total=0.0, teetime=ts(2021, 1, i + 1, 9))
            for i, n in enumerate(names)]
    out = form.rolling_index(make_rounds(spark, rows), factors(spark, [(1, 1.0)]), 3).collect()
    assert [(r.player_name, r.teetime) for r in out] == [("A", ts(2021, 1, 6, 9))]


def test_wave_split(spark):
    df = spark.createDataFrame([(ts(2021, 1, 1, 11, 59),), (ts(2021, 1, 1, 12, 0),), (None,),
                                (ts(2021, 1, 1, 0, 0),)], "teetime timestamp_ntz")
    assert [r[0] for r in df.select(wave("teetime")).collect()] == [
        "morning", "afternoon", "afternoon", "morning"]


def brute_force(rows, cf, period):
    """Per-row reference computation straight from the definition."""
    scored = [r for r in rows if r["score"] is not None]
    for r in scored:
        r["wave"] = "morning" if r["teetime"].hour < 12 else "afternoon"
    waves = {}
    for r in scored:
        waves.setdefault((r["event_id"], r["year"], r["round"], r["wave"]), []).append(r["score"])
    order = sorted(scored, key=lambda r: (r["dg_id"], r["teetime"], r["year"], r["event_id"],
                                          r["round"], r["player_name"], r["course_num"],
                                          r["score"]))
    out = {}
    for i, r in enumerate(order):
        key = (r["event_id"], r["year"], r["round"], r["wave"])
        r["wa"] = sum(waves[key]) / len(waves[key])
        r["idx"] = i
    for r in order:
        frame = [q for q in order if q["dg_id"] == r["dg_id"]
                 and q["player_name"] == r["player_name"] and r["idx"] - period < q["idx"] <= r["idx"]]
        if len(frame) != period:
            continue
        num = sum((q["wa"] - q["score"]) * cf[q["course_num"]] for q in frame)
        den = sum(cf[q["course_num"]] for q in frame)
        sgs = [q["sg_total"] for q in frame if q["sg_total"] is not None]
        out[(r["dg_id"], r["teetime"])] = (num / den if den else math.nan,
                                           sum(sgs) / len(sgs) if sgs else None)
    return out


@pytest.fixture
def skewed_rows():
    rnd = random.Random(7)
    rows = []
    # player 1 holds about a third of all rounds
    for i in range(900):
        dg = 1 if i % 3 == 0 else rnd.randint(2, 12)
        rows.append(dict(year=2024, event_id=rnd.randint(1, 6), event_name="e", dg_id=dg,
                         player_name=f"p{dg}" if (dg != 5 or i % 2) else "p5b",
                         round=rnd.randint(1, 4), course_num=rnd.randint(1, 4),
                         score=rnd.choice([None] + list(range(64, 84))),
                         sg_total=rnd.choice([None, -1.5, 0.25, 2.0]),
                         teetime=ts(2024, 1, 1 + i // 40, rnd.randint(6, 17), i % 40)))
    return rows


@pytest.mark.parametrize("skew_safe", [True, False])
def test_both_plans_match_brute_force(spark, skewed_rows, monkeypatch, skew_safe):
    # tiny blocks force many block boundaries (halo copies) inside hot players
    monkeypatch.setattr(form, "MIN_BLOCK_ROWS", 16)
    monkeypatch.setattr(form, "_block_rows", lambda p: 16)
    cf = {1: 0.5, 2: 1.0, 3: 2.0, 4: 0.0}
    df = make_rounds(spark, skewed_rows)
    for period in (3, 10):
        want = brute_force([dict(r) for r in skewed_rows], cf, period)
        got = form.rolling_index(df, factors(spark, list(cf.items())), period,
                                 skew_safe=skew_safe).collect()
        assert len(got) == len(want)
        for r in got:
            ppi, sg = want[(r.dg_id, r.teetime)]
            assert same(r.ppi, ppi) and same(r.sg_total, sg)


def test_multi_period_equals_single(spark, skewed_rows):
    df = make_rounds(spark, skewed_rows)
    cf = factors(spark, [(1, 0.5), (2, 1.0), (3, 2.0), (4, 0.0)])
    multi = form.rolling_index_multi(df, cf, (3, 10))
    for p in (3, 10):
        a = {(r.dg_id, r.player_name, r.teetime): r.ppi
             for r in form.rolling_index(df, cf, p).collect()}
        b = {(r.dg_id, r.player_name, r.teetime): r.ppi
             for r in multi.filter(F.col("period") == p).collect()}
        assert a.keys() == b.keys()
        assert all(same(a[k], b[k]) for k in a)


def test_global_row_number_is_dense_and_ordered(spark):
    # one key holds a third of the rows; numbering must be 1..n in order
    data = [(0 if i % 3 == 0 else i % 97, i) for i in range(3000)]
    df = spark.createDataFrame(data, "k long, v long")
    out = global_row_number(df, ["k", "v"], "index", partitions=7).collect()
    got = sorted((r["index"], r.k, r.v) for r in out)
    want = [(i + 1, k, v) for i, (k, v) in enumerate(sorted(data))]
    assert got == want


def test_weighted_index_in_groupby(spark):
    prepared = spark.createDataFrame([(1, 70, 72.0, 2.0), (1, 74, 72.0, 1.0), (2, 70, 71.0, None)],
                                     "g long, score long, wave_average double, cf double")
    out = {r.g: r.ppi for r in prepared.groupBy("g").agg(form.weighted_index(
        F.col("score"), F.col("wave_average"), F.col("cf")).alias("ppi")).collect()}
    assert same(out[1], (2 * 2.0 - 2 * 1.0) / 3.0) and math.isnan(out[2])


def test_plan_choice_follows_largest_player(spark, skewed_rows):
    df = make_rounds(spark, skewed_rows)
    cf = factors(spark, [(1, 0.5), (2, 1.0), (3, 2.0), (4, 0.0)])
    prepared = form.scored_rounds(df, cf)
    assert form.largest_player(prepared) == 300 - sum(
        1 for i, r in enumerate(skewed_rows) if r["dg_id"] == 1 and r["score"] is None)
    spark.conf.set("spark.fairway.maxWindowGroupRows", "50")
    try:
        blocked = form.rolling_index(df, cf, 10)
        assert "rangepartitioning" not in form.rolling_index(df, cf, 10, skew_safe=False) \
            ._jdf.queryExecution().executedPlan().toString()
        by_player = form.rolling_index(df, cf, 10, skew_safe=False)
        assert sorted(blocked.collect()) == sorted(by_player.collect())
    finally:
        spark.conf.unset("spark.fairway.maxWindowGroupRows")


def test_row_number_checked_both_ways(spark):
    from fairway.operators.sequence import row_number_checked

    data = [(i % 5, i) for i in range(200)]
    df = spark.createDataFrame(data, "k long, v long")
    want = [(i + 1, k, v) for i, (k, v) in enumerate(sorted(data, key=lambda x: (-x[0], x[1])))]
    for limit in (10, 1000):      # distributed numbering, then the single window
        out = row_number_checked(df, [F.col("k").desc(), "v"], "rank", max_rows=limit).collect()
        assert sorted((r["rank"], r.k, r.v) for r in out) == want
