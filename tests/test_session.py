"""The shared folder: demanded on a cluster, made on one machine, cleared by one call."""

import os
from types import SimpleNamespace

import pytest

from leasemill import session as S


def stand_in(master, conf):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: conf.get("dir"), setCheckpointDir=lambda d: conf.update(dir=d))
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=conf.get, set=conf.__setitem__))


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[2,1,1024]", "k8s://host"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        S.shared_dir(stand_in(master, {}))
    assert S.shared_dir(stand_in(master, {"spark.checkpoint.dir": "hdfs://x/y"})) == "hdfs://x/y"


def test_one_machine_makes_its_own():
    conf = {}
    assert S.shared_dir(stand_in("local[4]", conf)).startswith("file:") and conf["dir"] == conf["spark.checkpoint.dir"]


def test_intermediate_tables_are_dropped_and_stores_stay(spark, tmp_path):
    folder = S.shared_dir(spark).removeprefix("file:").replace("//", "/")
    store = S.store_path(spark, "kept")
    spark.range(3).write.mode("overwrite").parquet(store)
    t = S.persist_table(spark.range(5).toDF("x"), "t")
    assert t.count() == 5 and os.listdir(f"{folder}/leasemill")
    S.drop_intermediate(spark)
    assert not os.path.exists(f"{folder}/leasemill/{spark.sparkContext.applicationId}") and spark.read.parquet(store).count() == 3


def test_small_tables_come_to_the_driver(spark, monkeypatch):
    df = spark.range(10).selectExpr("id", "cast(NULL AS STRING) AS s", "date'2024-01-01' AS d")
    small, rows = S.small_or_stored(df, "t")
    monkeypatch.setattr(S, "MOST_LOCAL_ROWS", 9)
    stored, none = S.small_or_stored(df, "t")
    assert none is None and rows.num_rows == 10 and sorted(small.collect()) == sorted(stored.collect()) == sorted(df.collect())
