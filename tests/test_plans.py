"""Plan-shape checks: pruning, pushdown, exchanges, no one-task windows over rounds."""

import re

from pyspark.sql import functions as F

from fairway.operators import form
from fairway.operators.difficulty import event_difficulty
from fairway.plans import reports
from fairway.plans.catalog import course_factor_of
from fairway.sources.testdata import rounds
from tests.conftest import SF001


def plan(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "10000")
    return df._jdf.queryExecution().executedPlan().toString()


def test_difficulty_partial_aggregation_and_pruning(spark):
    p = plan(event_difficulty(rounds(spark, SF001)))
    assert "partial_count" in p
    scan = re.search(r"ReadSchema: struct<([^>]*)>", p).group(1)
    assert "props" not in scan


def test_rolling_index_exchanges(spark):
    df = form.rolling_index(rounds(spark, SF001), course_factor_of(spark, SF001), 25)
    p = plan(df)
    # score filter reaches the scan; small dims are broadcast after a size check
    assert "BroadcastHashJoin" in p
    # the frames run on (dg_id, player_name, block): one hash exchange for the
    # window over the checkpointed, range-partitioned rounds
    assert len(re.findall(r"Exchange hashpartitioning\(dg_id", p)) == 1
    assert "SinglePartition" not in p.split("BroadcastExchange")[0]


def test_year_filter_is_pushed(spark, tmp_path):
    from fairway.sources import io

    long = form.rolling_index_multi(rounds(spark, SF001), course_factor_of(spark, SF001), (10,))
    io.write_form_index(long, str(tmp_path / "f"))
    f = io.read_form_index(spark, str(tmp_path / "f"), 10)
    p = plan(reports.no_impact_rounds(f, 2024))
    assert "PushedFilters: [IsNotNull(course_factor_star), IsNotNull(teetime)," in p
    assert "GreaterThanOrEqual(teetime" in p


def test_latest_per_player_is_an_aggregate(spark):
    long = form.rolling_index(rounds(spark, SF001), course_factor_of(spark, SF001), 10)
    p = plan(reports.latest_per_player(long).filter(F.lit(True)))
    assert "max_by" in p


def test_score_filter_pushed_on_stored_rounds(spark, tmp_path):
    from fairway.sources import io

    io.write_rounds(rounds(spark, SF001), str(tmp_path / "r"))
    stored = io.read_rounds(spark, str(tmp_path / "r"))
    scored = form.scored_rounds(stored, course_factor_of(spark, SF001))
    p = plan(scored)
    assert "PushedFilters: [IsNotNull(score)]" in p
    scan = re.search(r"ReadSchema: struct<([^>]*)>", p).group(1)
    assert "sg_app" not in scan and "course_par" not in scan   # pruned columns


def test_skew_safe_plan_shape(spark):
    src = rounds(spark, SF001)
    df = form.rolling_index(src, course_factor_of(spark, SF001), 10, skew_safe=True)
    p = plan(df)
    # frames run on (dg_id, player_name, block); the frozen ordered table is
    # scanned, not re-sorted, and the partition offsets are broadcast
    assert re.search(r"Exchange hashpartitioning\(dg_id#\d+L, player_name#\d+, __blk#\d+L", p)
    assert not re.search(r"Exchange hashpartitioning\(dg_id#\d+L, \d+\)", p)
    assert "rangepartitioning" not in p
    assert "fairway-tables/ordered-" in p
    assert "BroadcastExchange" in p


def test_join_small_falls_back_to_shuffle_join(spark):
    from fairway.operators.joins import join_small

    big = spark.range(1000).selectExpr("id % 10 AS k", "id AS v")
    small = spark.range(10).selectExpr("id AS k", "id * 2 AS w")
    assert "BroadcastHashJoin" in plan(join_small(big, small, ["k"]))
    spark.conf.set("spark.fairway.broadcastMaxBytes", "100")   # 10 rows * 32 bytes > 100
    try:
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = join_small(big, small, ["k"])
        p = plan(joined)
        assert "SortMergeJoin" in p and "BroadcastHashJoin" not in p
        assert joined.count() == 1000
    finally:
        spark.conf.unset("spark.fairway.broadcastMaxBytes")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
