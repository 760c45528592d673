import datetime as dt
import math
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fairway.session import get_spark  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[*]", app_name="fairway-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    yield s


def ts(*a):
    return dt.datetime(*a)


def same(a, b, tol=1e-9):
    """Float-aware equality: NaN == NaN, inf == inf, NULL == NULL."""
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, float) or isinstance(b, float):
        if math.isnan(a) or math.isnan(b):
            return math.isnan(a) and math.isnan(b)
        if math.isinf(a) or math.isinf(b):
            return a == b
        return abs(a - b) <= tol * max(1.0, abs(a), abs(b))
    return a == b


ROUND_COLS = ("year long, event_id long, event_name string, dg_id long, player_name string, "
              "round long, course_name string, course_num long, course_par long, score long, "
              "sg_app double, sg_arg double, sg_ott double, sg_putt double, sg_t2g double, "
              "sg_total double, teetime timestamp_ntz")


def make_rounds(spark, rows):
    """rows: dicts with any subset of round columns (others NULL)."""
    names = [c.split()[0] for c in ROUND_COLS.split(", ")]
    data = [tuple(r.get(n) for n in names) for r in rows]
    return spark.createDataFrame(data, ROUND_COLS)
