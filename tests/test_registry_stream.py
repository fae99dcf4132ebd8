"""Registry publication by several writers, the stream that follows it, and
scoring that keeps every row without a shuffle."""

from __future__ import annotations

import threading

import pytest
from pyspark.sql import functions as F

from loam.plans import models as md
from loam.plans import scoring as sc
from loam.plans.registry import AlreadyExists, ModelRegistry, SharedFolder
from loam.streaming.scoring import follow_registry, read_scores, score_batch


@pytest.fixture(scope="module")
def train(spark):
    return spark.createDataFrame([(float(i % 7), "ab"[i % 2], float((i % 7 > 3) ^ (i % 11 == 0))) for i in range(200)], "x double, g string, y double")


@pytest.fixture(scope="module")
def models(train):
    return [md.fit_logit(train, f) for f in ("y ~ x", "y ~ x + g")]


def test_one_of_many_publishers(spark, models, tmp_path):
    reg = ModelRegistry(spark, str(tmp_path / "reg"))
    done, refused, gate = [], [], threading.Barrier(4)

    def publish(k):
        mine = ModelRegistry(spark, str(tmp_path / "reg"))
        gate.wait()
        try:
            done.append(mine.save(models[0], "m", "1", modeler=str(k)))
        except ValueError:
            refused.append(k)
    threads = [threading.Thread(target=publish, args=(k,)) for k in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(done) == 1 and len(refused) == 3
    assert [r.path for r in reg.table().collect()] == done
    assert len(list((tmp_path / "reg" / "m" / "1").iterdir())) == 1           # the losers' files are gone
    assert not list((tmp_path / "reg" / "_new").iterdir())
    reg.load("m")


def test_concurrent_updates_all_stay(spark, models, tmp_path):
    reg = ModelRegistry(spark, str(tmp_path / "reg"))
    threads = [threading.Thread(target=reg.save, args=(models[0], "m", "1"), kwargs={"update": True, "modeler": str(k)}) for k in range(3)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(r.modeler for r in reg.table().collect()) == ["0", "1", "2"]


def test_half_written_model_is_not_listed(spark, models, tmp_path):
    class Broken:
        def write(self):
            return self

        def overwrite(self):
            return self

        def save(self, path):
            models[0].write().save(path)
            raise OSError("lost")
    reg = ModelRegistry(spark, str(tmp_path / "reg"))
    with pytest.raises(OSError):
        reg.save(Broken(), "m", "1")
    assert reg.table().count() == 0
    with pytest.raises(KeyError):
        reg.entry("m")
    reg.save(models[0], "m", "1")                                              # the version is still free
    assert reg.entry("m")["version"] == "1"


def test_names_and_lookup(spark, models, tmp_path):
    reg = ModelRegistry(spark, str(tmp_path / "reg"))
    for name, version in (("a/b c", "1.0"), ("_x", "v=2/é"), ("a", "1"), ("a", "1.0"), ("a", "0")):
        reg.save(models[0], name, version, params={"k": 1})
    assert {(r.name, r.version) for r in reg.table().collect()} == {("a/b c", "1.0"), ("_x", "v=2/é"), ("a", "1"), ("a", "1.0"), ("a", "0")}
    assert reg.entry("a")["version"] == "0" and reg.entry("a", "1")["version"] == "1"    # the latest publication
    assert [r.version for r in reg.versions("a/b c").collect()] == ["1.0"]
    with pytest.raises(KeyError):
        reg.entry("b")


def test_rename_form_creates_once(spark, tmp_path):
    f = SharedFolder(spark, str(tmp_path / "s"))
    f.fs.mkdirs(f.path(f.root))
    for k in range(2):
        out = f.fs.create(f.path(f"{f.root}/t{k}"), True)
        out.write(bytearray(b"%d" % k))
        out.close()
    f._rename(f"{f.root}/t0", f"{f.root}/v")
    with pytest.raises(AlreadyExists):
        f._rename(f"{f.root}/t1", f"{f.root}/v")
    assert f.read(f"{f.root}/v") == "0" and f.read(f"{f.root}/none") is None


NEW = [(1, 2.0, "a"), (2, None, "b"), (3, 4.0, "zz"), (4, 5.0, None), (5, float("nan"), "a"), (6, 6.0, "b")]


def test_scores_keep_rows_without_exchange(spark, models):
    df = spark.createDataFrame(NEW, "id int, x double, g string").withColumn("__rowok", F.lit(7))
    out = sc.score_label_raw_prob(models[1], df, ["id", "x", "g", "__rowok"])
    rows = {r.id: r for r in out.collect()}
    assert {k for k, r in rows.items() if r.Probability is None} == {2, 3, 4, 5} and len(rows) == 6
    assert rows[3].g == "zz" and rows[4].g is None and rows[2].x is None and rows[1]["__rowok"] == 7
    for k in (1, 6):
        want = models[1].transform(df.where(F.col("id") == k)).first()
        assert rows[k].Probability == pytest.approx(want.prediction)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    many = sc.score_many({"a": models[0], "b": models[1]}, df, ["id"])
    assert "Exchange" not in many._jdf.queryExecution().executedPlan().toString()
    got = {r.id: (r.Score_a is None, r.Score_b is None) for r in many.collect()}
    assert got == {1: (False, False), 2: (True, True), 3: (False, True), 4: (False, True), 5: (True, True), 6: (False, False)}


def test_stream_follows_the_registry(spark, models, tmp_path):
    reg = ModelRegistry(spark, str(tmp_path / "reg"))
    reg.save(models[0], "m", "1")
    schema = spark.createDataFrame([], "id int, x double, g string").schema
    src, sink, ckpt = (str(tmp_path / n) for n in ("src", "sink", "ckpt"))

    def arrive(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)

    def run():
        follow_registry(spark, reg, "m", src, schema, ["id"], sink, ckpt).awaitTermination()
    arrive(NEW)
    run()
    reg.save(models[1], "m", "2")
    arrive([(k + 10, x, g) for k, x, g in NEW])
    run()
    run()                                                                      # nothing new
    rows = read_scores(spark, sink).collect()
    assert sorted(r.id for r in rows) == [1, 2, 3, 4, 5, 6, 11, 12, 13, 14, 15, 16]
    assert {r.model_version for r in rows if r.id < 10} == {"1"} and {r.model_version for r in rows if r.id > 10} == {"2"}
    assert {r.id for r in rows if r.Probability is None} == {2, 5, 12, 13, 14, 15}


def test_replayed_batch_adds_no_row(spark, models, tmp_path):
    reg = ModelRegistry(spark, str(tmp_path / "reg"))
    reg.save(models[0], "m", "1")
    df = spark.createDataFrame(NEW, "id int, x double, g string")
    sink = str(tmp_path / "sink")
    score_batch(reg, "m", sink, ["id"])(df, 0)
    before = sorted(read_scores(spark, sink).collect())
    reg.save(models[1], "m", "2")
    again = score_batch(reg, "m", sink, ["id"])                                # a new driver after a failure
    again(df, 0)
    assert sorted(read_scores(spark, sink).collect()) == before
    again(df, 1)
    assert read_scores(spark, sink).count() == 12
