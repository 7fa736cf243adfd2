"""Shared folder for intermediate tables and stream checkpoints."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir`` (or set on the context).

    A folder of this machine is used only when Spark itself runs on this machine alone.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="shoplens-")
    return _local_folders[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path that nothing else uses, in this application's part of the shared folder."""
    return f"{shared_folder(spark)}/shoplens-{spark.sparkContext.applicationId}/{label}-{uuid4().hex}"


def release(spark: SparkSession, path: str | None = None) -> None:
    """Delete a path of ``scratch_path``, or all that this application has stored. Results still unread are lost with it."""
    own = f"{shared_folder(spark)}/shoplens-{spark.sparkContext.applicationId}"
    path = path or own
    if path != own and not path.startswith(f"{own}/"):
        raise ValueError(f"{path} is not in this application's scratch folder {own}")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage before iterative work: a lost executor then costs a re-read of
    some files instead of a re-run of the joins behind them.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
