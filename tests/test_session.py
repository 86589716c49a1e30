from __future__ import annotations

import os

import pytest

from barweave.session import RUNTIME_SETTINGS, materialize, pin_runtime, shared_folder


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, name, default):
        assert name == "spark.checkpoint.dir"
        return self.value or default


class _Context:
    master = "spark://host:7077"

    def getCheckpointDir(self):
        return None


class _Session:
    def __init__(self, value):
        self.conf, self.sparkContext = _Conf(value), _Context()


def test_cluster_needs_a_shared_folder():
    assert shared_folder(_Session("hdfs:///shared")) == "hdfs:///shared"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(_Session(None))


def test_materialized_rows_are_read_from_the_folder(spark):
    folder = shared_folder(spark)
    assert shared_folder(spark) == folder
    told = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert folder == told
    df = materialize(spark.range(5).selectExpr("id", "cast(id as string) as text"))
    assert sorted(r.id for r in df.collect()) == [0, 1, 2, 3, 4]
    assert folder.split("/")[-1] in df.inputFiles()[0]
    assert materialize(spark.range(0)).count() == 0
    assert os.path.isdir(folder.removeprefix("file:"))


def test_runtime_settings(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Taipei")
    pin_runtime(spark)
    assert all(spark.conf.get(name) == value for name, value in RUNTIME_SETTINGS.items())
