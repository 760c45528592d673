import math

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from fairway.functions.numeric import ieee_div, round_half_even, sum0
from tests.conftest import same

special = st.sampled_from([0.0, 1.0, -1.0, 2.5, math.inf, -math.inf, math.nan, None])
values = st.one_of(special, st.floats(allow_nan=True, allow_infinity=True, width=64))
denominators = st.one_of(special, st.floats(allow_nan=True, allow_infinity=True, width=64)
                         .filter(lambda x: not (x == 0 and math.copysign(1, x) < 0)))


def expected(a, b):
    if a is None or b is None:
        return None
    with np.errstate(all="ignore"):
        return float(np.float64(a) / np.float64(b))


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(values, denominators), min_size=1, max_size=40))
def test_ieee_div_matches_numpy(spark, pairs):
    df = spark.createDataFrame(pairs, "a double, b double")
    got = [r[0] for r in df.select(ieee_div("a", "b")).collect()]
    assert all(same(g, expected(a, b), 0.0) for g, (a, b) in zip(got, pairs))


def test_sum0_and_half_even(spark):
    df = spark.createDataFrame([(None, 0.0625), (None, 0.0635), (None, math.inf)],
                               "x long, y double")
    assert df.agg(sum0("x")).collect()[0][0] == 0
    assert [r[0] for r in df.select(round_half_even("y", 3)).collect()] == [0.062, 0.064, math.inf]
