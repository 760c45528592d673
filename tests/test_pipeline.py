import json

import pytest
from pyspark.sql import functions as F

from fairway.plans import catalog, pipeline
from fairway.sources import ingest, io
from fairway.sources.schemas import COURSE_FACTOR, EVENT_DIFFICULTY
from fairway.sources.testdata import rounds
from tests.conftest import SF001
from tests.test_ingest import EVENT_LIST, text_df


def test_run_metrics_and_extracts(spark, tmp_path):
    root = str(tmp_path / "rounds")
    io.write_rounds(rounds(spark, SF001), root)
    out = str(tmp_path / "out")
    paths = pipeline.run_metrics(spark, root, out, periods=(10, 25))
    pti = io.read_csv(spark, paths["pti"], EVENT_DIFFICULTY)
    want = catalog.difficulty_of(spark, SF001)
    assert pti.count() == want.count() > 400
    assert pti.filter(F.col("pti") == float("inf")).count() == want.filter(F.col("pti") == float("inf")).count() > 0
    cf = io.read_csv(spark, paths["course_factor"], COURSE_FACTOR)
    assert cf.count() == 38 and cf.filter(F.col("course_factor") == 0).count() == 5   # 37 and the missing one
    for period in (10, 25):
        assert io.read_form_index(spark, paths["form_index"], period).count() == \
            catalog.rolling_of(spark, SF001, period).count() > 0
    ext = pipeline.run_extracts(spark, out, period=25, year=2024, max_days=30, player=7)
    assert io.read_csv(spark, ext["form_current"]).count() > 0


def test_event_list_sink(spark, tmp_path):
    events = ingest.pga_events(ingest.parse_event_list(text_df(spark, [EVENT_LIST])))
    io.write_event_list(events, str(tmp_path / "events"))
    back = io.read_event_list_lines(spark, str(tmp_path / "events")).collect()
    assert [r.asDict() for r in back] == [EVENT_LIST[1]]
    assert json.loads(json.dumps(back[0].asDict()))["tour"] == "pga"


def test_round_statistics_path_equals_standalone(spark):
    from fairway.operators import difficulty as d
    from fairway.operators import form
    from tests.conftest import SF01

    src = rounds(spark, SF01)
    stats = form.RoundStatistics(src)
    a = d.difficulty_from_counts(stats.event_counts())
    b = d.event_difficulty(src)
    assert a.count() == b.count() > 1000
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    factors = d.course_factor(b)
    x = form.rolling_index_multi(src, factors, (10, 25), stats=stats)
    y = form.rolling_index_multi(src, factors, (10, 25))
    assert x.count() == y.count() > 5000
    assert x.exceptAll(y).count() == 0


def test_pipeline_skew_safe_plan_same_output(spark, tmp_path):
    root = str(tmp_path / "rounds")
    io.write_rounds(rounds(spark, SF001), root)
    default = pipeline.run_metrics(spark, root, str(tmp_path / "a"), periods=(10,))
    spark.conf.set("spark.fairway.maxWindowGroupRows", "1")
    try:
        forced = pipeline.run_metrics(spark, root, str(tmp_path / "b"), periods=(10,))
    finally:
        spark.conf.unset("spark.fairway.maxWindowGroupRows")
    a = io.read_form_index(spark, default["form_index"], 10)
    b = io.read_form_index(spark, forced["form_index"], 10)
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0


def test_runs_release_only_their_own(spark, tmp_path):
    """A frame of another run survives run_metrics, and no folder of the run stays."""
    import os

    from fairway.operators import joins
    from fairway.session import ensure_checkpoint_dir

    root = str(tmp_path / "rounds")
    io.write_rounds(rounds(spark, SF001), root)
    folder = ensure_checkpoint_dir(spark).removeprefix("file:") + "/fairway-tables"
    older = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    with joins.run_scope():
        live = catalog.rolling_of(spark, SF001, 10)
        before = set(os.listdir(folder))
        assert before - older
        pipeline.run_metrics(spark, root, str(tmp_path / "out"), periods=(10,))
        assert set(os.listdir(folder)) == before
        assert live.count() > 0
    assert set(os.listdir(folder)) <= older


def test_null_course_has_no_factor(spark):
    form = catalog.form.scored_rounds(rounds(spark, SF001), catalog.course_factor_of(spark, SF001))
    nulls = form.where("course_num IS NULL")
    assert nulls.count() > 0 and nulls.where("course_factor_star IS NOT NULL").count() == 0


def test_shared_folder_is_required_off_local(monkeypatch):
    from fairway import session

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(dict)

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
