import math

from pyspark.sql import functions as F

from fairway.functions.rules import whole_days_between
from fairway.operators.difficulty import course_factor
from fairway.plans import reports
from fairway.sources.schemas import EVENT_DIFFICULTY, FORM_INDEX
from tests.conftest import make_rounds, same, ts
from tests.test_difficulty import golden_difficulty


def difficulty_rows(spark):
    return spark.createDataFrame([
        (2021, 14, "Masters", "A", 1, 5, 10, 80, 72.0, 0.5, True),
        (2022, 26, "US Open", "B", 2, 9, 3, 70, 74.0, 3.0, True),
        (2022, 33, "PGA", "C", 3, 0, 40, 90, 69.0, 0.0, True),
        (2021, 7, "Other", "D", 4, 0, 55, 100, 68.0, 0.0, False),
        (2021, 8, "Other2", "D", 4, 0, 55, 60, 68.5, 0.0, False),
    ], EVENT_DIFFICULTY)


def test_overall_shares_and_easiest(spark):
    d = difficulty_rows(spark)
    s = reports.overall_shares(d).collect()[0]
    assert (s.pct_over_80, s.pct_sub_70) == (3.5, 40.8)   # one decimal, ties to even
    assert s.zero_high_events == 3
    e = reports.easiest_event(d).collect()
    assert [(r.year, r.event_id) for r in e] == [(2021, 7)]   # tie on sub_70 -> earlier id


def test_majors(spark):
    d = difficulty_rows(spark)
    ranked = {r.event_id: r["rank"] for r in reports.majors_ranked(d).collect()}
    assert ranked == {26: 1, 14: 2, 33: 3}
    ext = {r.kind: r.event_id for r in reports.major_extremes(d).collect()}
    assert ext == {"hardest": 26, "easiest": 33}


def test_venue_extremes_golden(spark):
    cf = course_factor(golden_difficulty(spark))
    v = reports.venue_extremes(cf).collect()[0]
    assert v.hardest_course_num == 697 and v.easiest_course_num == 776
    assert v.factor_ratio == 1954
    assert round(v.hardest_pct_over_80, 1) == 8.3 and round(v.hardest_pct_sub_70, 1) == 6.4
    ranks = {r.course_num: r["rank"] for r in reports.venue_rank(cf).collect()}
    assert ranks[697] == 1 and ranks[773] == 5


def test_score_distribution_and_median(spark):
    rows = [dict(course_num=c, score=s) for c, s in
            [(1, 70), (1, 70), (1, 72), (1, None), (2, 65), (2, 67), (2, 69)]]
    r = make_rounds(spark, rows)
    cf = spark.createDataFrame([(1, 3.0), (2, None)], "course_num long, course_factor double") \
        .select("course_num", "course_factor")
    dist = {(x.course_num, x.score): x for x in reports.score_distribution(r, cf).collect()}
    assert dist[(1, 70)].rounds == 2 and same(dist[(1, 70)].pct_of_rounds, 50.0)
    assert dist[(1, None)].rounds == 1
    assert dist[(1, 70)]["rank"] == 1 and same(dist[(1, 70)].log_course_factor, math.log10(4.0))
    assert dist[(2, 65)]["rank"] is None
    med = {x.course_num: x.median_score for x in reports.venue_median(r).collect()}
    assert med == {1: 70.0, 2: 67.0}
    med2 = {x.course_num: x.median_score for x in reports.venue_median(
        make_rounds(spark, [dict(course_num=1, score=s) for s in (70, 71, 74, 80)])).collect()}
    assert med2 == {1: 72.5}


def form_rows(spark):
    names = [f.name for f in FORM_INDEX.fields]
    data = [
        (1, "a", 1.0, ts(2025, 3, 1, 9), ts(2023, 1, 1, 23), 0.5, 64, "E1", 70.0, 0.0, "x", 0.5),
        (1, "a", 2.0, ts(2025, 1, 1, 1), ts(2023, 1, 1, 23), 0.5, 66, "E2", 70.0, 1.0, "x", 1.5),
        (2, "b", -1.0, ts(2025, 1, 1, 1), ts(2023, 1, 1, 23), 1.0, 63, "E3", 70.0, 0.0, "x", -2.0),
        (3, "c", math.nan, ts(2024, 12, 31, 9), ts(2024, 1, 1, 9), 1.0, 61, "E4", 70.0, 0.0,
         "x", math.nan),
    ]
    return spark.createDataFrame(data, FORM_INDEX).select(*names)


def test_whole_days(spark):
    df = spark.createDataFrame([(ts(2023, 1, 1, 23), ts(2025, 1, 1, 1))],
                               "a timestamp_ntz, b timestamp_ntz")
    assert df.select(whole_days_between("a", "b")).collect()[0][0] == 730


def test_standings_no_impact_trend(spark):
    f = form_rows(spark)
    st = {r.dg_id: r for r in reports.current_standings(f, 2025, 730).collect()}
    # player 1's latest row is 2025-03-01 but its window spans 790 days -> out;
    # player 2 spans exactly 730 whole days -> in; player 3 is in 2024 -> out
    assert set(st) == {2}
    gap = reports.largest_gap(reports.latest_per_player(f)).collect()
    assert [r.dg_id for r in gap] == [2]
    top = reports.no_impact_top(f, 2025, 10).collect()
    assert [(r.Name, r.Score) for r in top] == [("b", 63), ("a", 64)]
    assert reports.no_impact_count(f, 2025, 65).collect()[0].rounds_below == 2
    trend = reports.player_trend(f, 1).collect()
    assert [r.teetime for r in trend] == [ts(2025, 1, 1, 1), ts(2025, 3, 1, 9)]
    assert same(trend[0].weighted_score, (70.0 - 66) * 1.0)
    b = reports.trend_bounds(reports.player_trend(f, 1)).collect()[0]
    assert b.start == ts(2025, 1, 1, 1) and b.end == ts(2025, 6, 29, 9)


def test_year_as_text(spark):
    out = reports.year_as_text(difficulty_rows(spark))
    assert dict(out.dtypes)["year"] == "string"
    assert out.filter(F.col("year") == "2022").count() == 2


def test_score_share_rows(spark):
    rows = [dict(course_num=c, score=s) for c, s in
            [(1, 70), (1, 70), (1, 72), (1, None), (3, 66)]]
    r = make_rounds(spark, rows)
    cf = spark.createDataFrame([(1, 3.0)], "course_num long, course_factor double")
    out = reports.score_share_rows(r, cf).collect()
    assert len(out) == 5                      # every round kept
    by = {(x.course_num, x.score): x for x in out}
    assert same(by[(1, 70)]["count"], 50.0) and same(by[(1, None)]["count"], 25.0)
    assert by[(1, 72)]["rank"] == 1 and by[(3, 66)]["rank"] is None
    assert same(by[(3, 66)]["count"], 100.0)


def test_standings_frame_once_and_never_sort_form_rows(spark):
    from pyspark.sql import functions as F

    from fairway.operators import joins
    from fairway.plans import catalog, reports
    from tests.conftest import SF001

    form = catalog.form_of(spark, SF001)
    for rows in (1_000_000, 0):   # broadcast, and beyond its bound
        spark.conf.set("spark.fairway.broadcastMaxRows", rows)
        try:
            with joins.run_scope():
                plan = reports.latest_per_player(form)._jdf.queryExecution().executedPlan().toString()
                assert "rolling" not in plan and "Window" not in plan and "SortMergeJoin" not in plan
                assert ("BroadcastHashJoin" if rows else "ShuffledHashJoin") in plan
                got = reports.latest_per_player(form).select("dg_id", "teetime").collect()
        finally:
            spark.conf.unset("spark.fairway.broadcastMaxRows")
        want = form.groupBy("dg_id").agg(F.max("teetime").alias("teetime")).collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, want)) != []


def test_sketched_median_is_within_its_error(spark):
    from pyspark.sql import functions as F

    from fairway.plans import reports

    # a million different values, one group with a third of them, and odd ones
    rows = spark.range(1_000_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("g"),
        (F.col("id") % 2).alias("batch"), (F.col("id") * 1.000001).alias("v"))
    odd = spark.createDataFrame([("odd", 0, None), ("odd", 1, float("nan")), ("two", 0, 1.0), ("two", 1, 3.0)], "g string, batch long, v double")
    rows = rows.unionByName(odd)
    parts = reports.quantile_sketches(rows, "v", "g", "batch")
    for q in (0.1, 0.5, 0.99):
        found = reports.sketched_quantile(reports.merged_sketches(parts, "g"), q, "x").persist()
        placed = reports.rank_of(rows, "v", found, "x", "g").collect()
        assert len(placed) == 9 and sum(r.n for r in placed) == 1_000_002
        for r in placed:
            assert r.below <= q + reports.RANK_ERROR and r.up_to >= q - reports.RANK_ERROR
