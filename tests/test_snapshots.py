import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fairway.operators import form
from fairway.plans.catalog import course_factor_of
from fairway.sources import io
from fairway.sources.snapshots import MANIFESTS, Snapshots
from fairway.sources.testdata import rounds
from tests.conftest import SF001

ROW = T.StructType([T.StructField("x", T.LongType())])


def rows(store):
    return sorted((r.p, r.x) for r in store.read(ROW).collect())


def table(spark, *pairs):
    return spark.createDataFrame(list(pairs), "p long, x long")


def test_partitions_are_replaced_by_one_manifest(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path / "s"), "p")
    assert rows(store) == [] and store.versions() == {}
    v = store.write(table(spark, (1, 10), (2, 20)))
    assert rows(store) == []                       # written, not shown
    store.commit({1: v, 2: v})
    assert rows(store) == [(1, 10), (2, 20)]
    store.commit({2: store.write(table(spark, (2, 21))), 3: None})
    assert rows(store) == [(1, 10), (2, 21)]
    store.commit({1: None})
    assert rows(store) == [(2, 21)]
    assert [r.x for r in store.read(ROW, values=[1, 2]).collect()] == [21]


def test_a_job_killed_before_its_manifest_changes_nothing(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path / "s"), "p")
    store.commit({1: store.write(table(spark, (1, 10)))})
    with pytest.raises(Exception, match="broken row"):
        store.write(table(spark, (1, 11), (1, 12)).withColumn(
            "x", F.when(F.col("x") == 12, F.raise_error(F.lit("broken row")).cast("long")).otherwise(F.col("x"))))
    orphan = store.write(table(spark, (1, 99)))    # killed after writing, before commit
    assert rows(store) == [(1, 10)]
    gone = store.vacuum()
    assert orphan in gone and rows(store) == [(1, 10)]


def test_a_manifest_cut_short_is_passed_over(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path / "s"), "p")
    store.commit({1: store.write(table(spark, (1, 10)))})
    whole = json.dumps({"versions": {"1": "nowhere"}, "before": []})
    for n, text in ((2, ""), (3, whole[:-3])):
        (tmp_path / "s" / MANIFESTS / f"{n:08d}.json").write_text(text)
    assert rows(store) == [(1, 10)]
    store.commit({2: store.write(table(spark, (2, 20)))})
    assert rows(store) == [(1, 10), (2, 20)]


def test_writers_side_by_side_keep_each_others_partitions(spark, tmp_path, monkeypatch):
    one, two = (Snapshots(spark, str(tmp_path / "s"), "p") for _ in range(2))
    a, b = one.write(table(spark, (1, 10))), two.write(table(spark, (2, 20)))
    plain = Snapshots._create

    def late(self, number, manifest):
        if self is one and number == 1:
            two.commit({2: b})   # the other writer takes the number first
        return plain(self, number, manifest)

    monkeypatch.setattr(Snapshots, "_create", late)
    one.commit({1: a})
    assert rows(one) == [(1, 10), (2, 20)]


def test_old_versions_go_two_manifests_later(spark, tmp_path):
    store, versions = Snapshots(spark, str(tmp_path / "s"), "p"), []
    for x in range(4):
        versions.append(store.write(table(spark, (1, x))))
        store.commit({1: versions[-1]})
    left = {f.name[8:] for f in (tmp_path / "s").iterdir() if f.name.startswith("version=")}
    assert left == set(versions[-2:]) and rows(store) == [(1, 3)]


@pytest.fixture(scope="module")
def long(spark):
    return form.rolling_index_multi(rounds(spark, SF001), course_factor_of(spark, SF001), (2, 10)).persist()


def test_form_index_survives_a_killed_replacement(spark, tmp_path, long):
    root = str(tmp_path / "f")
    io.write_form_index(long, root, (2, 10))
    before = {p: sorted(map(str, io.read_form_index(spark, root, p).collect())) for p in (2, 10)}
    broken = long.withColumn("score", F.when(F.col("dg_id") == 3, F.raise_error(F.lit("killed")).cast("long"))
                             .otherwise(F.col("score")))
    with pytest.raises(Exception, match="killed"):
        io.write_form_index(broken, root, (2, 10))
    assert {p: sorted(map(str, io.read_form_index(spark, root, p).collect())) for p in (2, 10)} == before


def test_form_index_killed_between_data_and_manifest(spark, tmp_path, long, monkeypatch):
    root = str(tmp_path / "f")
    io.write_form_index(long, root, (2, 10))
    n = io.read_form_index(spark, root, 10).count()

    def killed(*_, **__):
        raise KeyboardInterrupt

    monkeypatch.setattr(Snapshots, "commit", killed)
    with pytest.raises(KeyboardInterrupt):
        io.write_form_index(long.where("dg_id = 1"), root, (10,))
    monkeypatch.undo()
    assert io.read_form_index(spark, root, 10).count() == n
    io.write_form_index(long.where("dg_id < 0"), root, (10,))   # a period without rows now
    assert io.read_form_index(spark, root, 10).count() == 0 and io.read_form_index(spark, root, 2).count() > 0


def test_form_index_files_in_name_order_are_sorted(spark, tmp_path, long):
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "9"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        io.write_form_index(long, str(tmp_path / "f"), (2, 10))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    for folder in (tmp_path / "f").rglob("period=*"):
        files = sorted(folder.glob("*.parquet"), key=lambda f: f.name)
        assert len(files) >= 3
        keys, places = [], {}
        for i, file in enumerate(files):
            own = [(r.dg_id, r.player_name, r.teetime) for r in
                   spark.read.parquet(str(file)).select("dg_id", "player_name", "teetime").collect()]
            keys += own
            for k in own:
                places.setdefault(k[0], set()).add(i)
        assert keys == sorted(keys, reverse=True)
        assert max(map(len, places.values())) <= 2
    player = keys[0][0]
    got = io.read_form_index(spark, str(tmp_path / "f"), 2, player)
    assert got.count() == long.where(f"period = 2 AND dg_id = {player}").count() > 0
    assert "PushedFilters: [IsNotNull(dg_id), EqualTo(dg_id" in got._jdf.queryExecution().executedPlan().toString()
