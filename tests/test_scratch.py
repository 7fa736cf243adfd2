"""Where intermediate tables go."""

from __future__ import annotations

from types import SimpleNamespace

import pytest

from shoplens.scratch import materialize, release, scratch_path, shared_folder


def session(master, setting=None, context=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: setting or default),
        sparkContext=SimpleNamespace(master=master, applicationId="app-1", getCheckpointDir=lambda: context),
    )


def test_the_configured_folder_is_used():
    assert shared_folder(session("spark://host:1", "hdfs://nn/shared/")) == "hdfs://nn/shared"
    assert shared_folder(session("yarn", None, "s3a://bucket/c")) == "s3a://bucket/c"
    path = scratch_path(session("yarn", "hdfs://nn/shared"), "csv")
    assert path.startswith("hdfs://nn/shared/shoplens-app-1/csv-")


def test_a_cluster_without_a_shared_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session("yarn"))


def test_local_mode_falls_back_to_one_local_folder():
    assert shared_folder(session("local[2]")) == shared_folder(session("local[2]"))


def test_materialize_cuts_the_plan(spark):
    df = spark.range(100).selectExpr("id % 7 AS k", "id AS v").groupBy("k").sum("v")
    stored = materialize(df, "sums")
    assert sorted(stored.collect()) == sorted(df.collect())
    assert "Aggregate" not in stored._jdf.queryExecution().optimizedPlan().toString()


def test_release_deletes_own_paths_only(spark, tmp_path):
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    release(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    with pytest.raises(ValueError):
        release(spark, str(tmp_path))
