import math

import pytest
from pyspark.sql import functions as F

from fairway.sources import io
from fairway.sources.schemas import EVENT_DIFFICULTY, SchemaMismatch
from fairway.sources.testdata import rounds
from tests.conftest import SF001


def test_rounds_parquet_roundtrip(spark, tmp_path):
    src = rounds(spark, SF001)
    io.write_rounds(src, str(tmp_path / "r"))
    back = io.read_rounds(spark, str(tmp_path / "r"))
    assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in src.schema]
    assert back.exceptAll(src).count() == 0 and src.exceptAll(back).count() == 0
    io.write_rounds(src, str(tmp_path / "y"), by_event=False)
    assert io.read_rounds(spark, str(tmp_path / "y")).count() == src.count()


def test_landing_an_event_keeps_the_others(spark, tmp_path):
    src, root = rounds(spark, SF001), str(tmp_path / "r")
    for day in (2, 4):
        io.write_rounds(src.where(F.col("event_id") == day), root)
    assert io.read_rounds(spark, root).count() == src.where("event_id IN (2, 4)").count()
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").upper() == "STATIC"


def test_one_bad_file_among_several_is_detected(spark, tmp_path):
    src, root = rounds(spark, SF001), str(tmp_path / "r")
    io.write_rounds(src, root)
    src.limit(5).drop("score").write.mode("append").partitionBy("year", "event_id").parquet(root)
    with pytest.raises(SchemaMismatch, match="score"):
        io.read_rounds(spark, root)


def test_missing_column_is_detected(spark, tmp_path):
    rounds(spark, SF001).drop("sg_total").write.partitionBy("year").parquet(str(tmp_path / "r"))
    with pytest.raises(SchemaMismatch, match="sg_total"):
        io.read_rounds(spark, str(tmp_path / "r"))


def test_csv_keeps_inf_and_reads_foreign_inf(spark, tmp_path):
    df = spark.createDataFrame([(2021, 1, "e", "c", 1, 1, 0, 2, 80.0, math.inf, False)],
                               EVENT_DIFFICULTY)
    io.write_csv(df, str(tmp_path / "ours"))
    assert io.read_csv(spark, str(tmp_path / "ours"), EVENT_DIFFICULTY).collect()[0].pti == math.inf
    foreign = tmp_path / "foreign.csv"
    foreign.write_text("year,event_id,event_name,course_name,course_num,over_80,sub_70,"
                       "total_rounds,scoring_average,pti,major_championship\n"
                       "2021,1,e,c,1,1,0,2,80.0,inf,false\n")
    row = io.read_csv(spark, str(foreign), EVENT_DIFFICULTY).collect()[0]
    assert row.pti == math.inf


def test_form_index_partitions(spark, tmp_path):
    from fairway.operators import form
    from fairway.plans.catalog import course_factor_of

    long = form.rolling_index_multi(rounds(spark, SF001), course_factor_of(spark, SF001), (10, 25))
    io.write_form_index(long, str(tmp_path / "f"))
    ten = io.read_form_index(spark, str(tmp_path / "f"), 10)
    assert ten.count() == long.filter(F.col("period") == 10).count() > 0
    plan = ten._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(period" in plan


def test_rerun_replaces_requested_periods_and_sorts_files(spark, tmp_path):
    from fairway.operators import form
    from fairway.plans.catalog import course_factor_of

    src, root = rounds(spark, SF001), tmp_path / "f"
    long = form.rolling_index_multi(src, course_factor_of(spark, SF001), (2, 10))
    io.write_form_index(long, str(root), (2, 10))
    for file in root.rglob("*.parquet"):
        rows = spark.read.parquet(str(file)).select("dg_id", "player_name", "teetime").collect()
        keys = [(r.dg_id, r.player_name, r.teetime) for r in rows]
        assert keys == sorted(keys, reverse=True)
    io.write_form_index(long.where("period = 2"), str(root), (2, 10))
    assert not (root / "period=10").exists()
    assert io.read_form_index(spark, str(root), 2).count() > 0


def test_a_second_scan_reads_no_footer(spark, tmp_path):
    import os

    src, root = rounds(spark, SF001), str(tmp_path / "r")
    io.write_rounds(src.where("event_id < 5"), root)
    io.read_rounds(spark, root)
    known = io.dataset_footers(spark, root).count()
    # spoil every file without changing its size or time: opening one would fail
    for file in (tmp_path / "r").rglob("year=*/**/*.parquet"):
        stat, size = file.stat(), file.stat().st_size
        file.write_bytes(b"x" * size)
        os.utime(file, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    assert [f.name for f in io.read_rounds(spark, root).schema] == src.columns
    assert io.dataset_footers(spark, root).count() == known > 3
    # new files are opened, and only they
    io.write_rounds(src.where("event_id = 9"), root)
    more = io.dataset_footers(spark, root)
    assert more.where("rows IS NOT NULL").count() == more.count() > known


def test_statistics_follow_the_files(spark, tmp_path):
    src, root = rounds(spark, SF001), str(tmp_path / "r")
    io.write_rounds(src, root)
    got = {r["name"]: r for r in io.dataset_statistics(spark, root).collect()}
    want = src.agg(F.min("score").alias("low"), F.max("score").alias("high"), F.count_if(F.col("score").isNull()).alias("nulls")).first()
    assert (got["score"].low, got["score"].high, got["score"].nulls) == (want.low, want.high, want.nulls)
    assert got["sg_app"].low is None and got["sg_app"].nulls == src.count() and got["player_name"].low is None
    # replaced events are counted once
    io.write_rounds(src.where("event_id = 4 AND year = 2024").limit(1), root)
    rows = io.dataset_statistics(spark, root).where("name = 'score'").first()["rows"]
    assert rows == src.where("event_id <> 4 OR year <> 2024").count() + 1
