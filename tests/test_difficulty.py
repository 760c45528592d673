import math

from fairway.operators.difficulty import course_factor, event_difficulty
from fairway.sources.schemas import COURSE_FACTOR, EVENT_DIFFICULTY
from tests.conftest import make_rounds, same


def _rounds(spark, groups):
    rows = []
    for (year, event_id, course), scores in groups.items():
        for s in scores:
            rows.append(dict(year=year, event_id=event_id, event_name="fake",
                             course_name="fake", course_num=course, score=s))
    return make_rounds(spark, rows)


def by_key(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_difficulty_two_events(spark):
    df = _rounds(spark, {(2019, 5, 8): [83, 81, 74, 69, 68], (2020, 6, 9): [66, 71, 69]})
    out = by_key(event_difficulty(df), "event_id")
    assert set(out) == {(5,), (6,)}
    a, b = out[(5,)], out[(6,)]
    assert (a.over_80, a.sub_70, a.total_rounds, a.scoring_average, a.pti) == (2, 2, 5, 75.0, 1.0)
    assert (b.over_80, b.sub_70, b.total_rounds, b.pti) == (0, 2, 3, 0.0)
    assert same(b.scoring_average, 206 / 3)
    assert a.major_championship is False and b.major_championship is False
    assert [f.name for f in event_difficulty(df).schema] == [f.name for f in EVENT_DIFFICULTY]


def test_difficulty_zero_division_and_nulls(spark):
    df = _rounds(spark, {
        (2021, 3, 3): [72, 75],            # 0/0 -> dropped
        (2021, 4, 4): [81, 75],            # 1/0 -> inf kept
        (2021, 5, 5): [None, None],        # all null -> 0/0 dropped
        (2021, 6, 6): [81, 65, None],      # null counts as a round only
        (2021, 7, 7): [80] + [60] * 16,    # 1/16 = 0.0625 -> 0.062 half-even
    })
    out = by_key(event_difficulty(df), "event_id")
    assert set(out) == {(4,), (6,), (7,)}
    assert out[(4,)].pti == math.inf
    r = out[(6,)]
    assert (r.over_80, r.sub_70, r.total_rounds, r.scoring_average, r.pti) == (1, 1, 3, 73.0, 1.0)
    assert out[(7,)].pti == 0.062


def test_majors_flag(spark):
    ids = [14, 536, 33, 26, 100, 7, None]
    df = _rounds(spark, {(2021, i, k): [81, 65] for k, i in enumerate(ids)})
    out = {r.course_num: r.major_championship for r in event_difficulty(df).collect()}
    assert [out[k] for k in range(len(ids))] == [True] * 5 + [False, False]


def test_course_factor_two_courses(spark):
    pti = spark.createDataFrame(
        [(2019, 5, "e", "north", 8, 2, 2, 5, 75.0, 1.0, False),
         (2020, 6, "f", "south", 9, 1, 5, 20, 70.0, 0.2, False),
         (2020, 7, "g", "north", 8, 4, 1, 10, 76.5, 4.0, False)], EVENT_DIFFICULTY)
    cf = course_factor(pti)
    assert [f.name for f in cf.schema] == [f.name for f in COURSE_FACTOR]
    out = by_key(cf, "course_num")
    north, south = out[(8,)], out[(9,)]
    assert (north.total_over_80, north.total_sub_70, north.total_rounds) == (6, 3, 15)
    assert same(north.scoring_average, (75.0 * 5 + 76.5 * 10) / 15)
    assert (north.other_over_80, north.other_sub_70) == (1, 5)
    assert same(north.course_factor, 100 * ((6 / 3) / (1 / 5)))
    assert same(north.course_factor_star, math.log10(1 + 100 * 10))
    assert (south.other_over_80, south.other_sub_70) == (6, 3)
    assert same(south.course_factor, 100 * ((1 / 5) / (6 / 3)))


def test_course_factor_edge_cases(spark):
    # single course: others are 0/0 -> NaN factor
    lone = spark.createDataFrame([(2021, 1, "e", "c", 1, 2, 3, 9, 70.0, 0.667, False)],
                                 EVENT_DIFFICULTY)
    assert math.isnan(course_factor(lone).collect()[0].course_factor)
    # a course without sub-70 rounds while others are normal -> inf, log inf
    two = spark.createDataFrame([(2021, 1, "e", "c", 1, 2, 0, 9, 77.0, math.inf, False),
                                 (2021, 2, "e", "d", 2, 1, 5, 9, 70.0, 0.2, False)],
                                EVENT_DIFFICULTY)
    out = by_key(course_factor(two), "course_num")
    assert out[(1,)].course_factor == math.inf and out[(1,)].course_factor_star == math.inf


def test_course_name_from_hardest_event(spark):
    df = spark.createDataFrame([(2021, 1, "e", "Old Name", 1, 1, 9, 10, 70.0, 0.1, False),
                                (2022, 2, "e", "New Name", 1, 9, 10, 20, 72.0, 0.9, False),
                                (2022, 3, "e", "Other", 2, 1, 1, 5, 71.0, 1.0, False)],
                               EVENT_DIFFICULTY)
    assert by_key(course_factor(df), "course_num")[(1,)].course_name == "New Name"


# Four rows of the published course table plus one filler
# course holding the remaining counts (totals 1,575 / 58,277 / 156,672).
GOLDEN = [  # course_num, over_80, sub_70, rounds, factor, factor_star
    (697, 39, 30, 472, 4929.759114583334, 3.6929137861931527),
    (608, 52, 88, 887, 2257.6762370918646, 3.353853982792206),
    (776, 1, 1432, 2394, 2.5219967630418885, 0.5467889524848378),
    (773, 0, 205, 275, 0.0, 0.0),
]


def golden_difficulty(spark):
    rows = [(2024, n, "e", f"course {n}", n, o, s, t, 70.0, 0.0, False)
            for n, o, s, t, _, _ in GOLDEN]
    filler = (1575 - sum(g[1] for g in GOLDEN), 58277 - sum(g[2] for g in GOLDEN),
              156672 - sum(g[3] for g in GOLDEN))
    rows.append((2024, 1, "e", "filler", 1, *filler, 70.0, 0.0, False))
    return spark.createDataFrame(rows, EVENT_DIFFICULTY)


def test_golden_course_table(spark):
    out = by_key(course_factor(golden_difficulty(spark)), "course_num")
    for n, o, s, t, factor, star in GOLDEN:
        r = out[(n,)]
        assert (r.total_over_80, r.total_sub_70, r.total_rounds) == (o, s, t)
        assert (r.other_over_80, r.other_sub_70) == (1575 - o, 58277 - s)
        assert same(r.course_factor, factor, 1e-12)
        assert same(r.course_factor_star, star, 1e-12)
