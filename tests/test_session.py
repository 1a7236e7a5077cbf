"""Staging: where tables go, and that they come back."""

import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from textprep import session


def fake(conf, master, folder=None):
    context = SimpleNamespace(master=master, applicationId=f"{master}-{conf}", getCheckpointDir=lambda: folder)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: conf), sparkContext=context)


def test_staging_folder_is_the_shared_one():
    assert session.staging_root(fake("hdfs:///shared", "yarn")) == "hdfs:///shared"
    assert session.staging_root(fake(None, "yarn", "hdfs:///set")) == "hdfs:///set"


def test_a_cluster_without_a_shared_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.staging_root(fake(None, "spark://host:7077"))


def test_local_runs_fall_back_to_one_new_folder():
    local = fake(None, "local[2]")
    root = session.staging_root(local)
    assert os.path.isdir(root) and session.staging_root(local) == root


def test_stage_round_trip(spark):
    df = spark.range(10).select("id", F.array("id").alias("a"))
    staged = session.stage(df, "test")
    assert staged.dtypes == df.dtypes
    assert sorted(staged.collect()) == sorted(df.collect())


def test_spread_leaves_wide_inputs_alone(spark):
    wide = spark.range(0, 100, 1, 32)
    assert session.spread(wide, "id") is wide
    assert session.spread(spark.range(0, 100, 1, 1), "id").rdd.getNumPartitions() == 8
