"""Batch sinks."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame

from shoplens.sources.readers import QUOTED, STORED_CSV, TIMES, without_line_breaks

# The CSV writer strips blanks and escapes with a backslash unless told otherwise.
CSV_WRITE = {
    "header": True,
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "emptyValue": '""',
    **QUOTED,
    **STORED_CSV,
}


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    **options,
) -> str:
    """Write ``df`` from the executors as Parquet, CSV or JSON and return the path.

    CSV keeps one row per line: line breaks in text are escaped, and NULL is told from empty text. Read it with
    ``read_csv(..., stored=True)``. Times keep six digits in both text formats.
    """
    settings = {"csv": {**CSV_WRITE, **options}, "json": {**TIMES, **options}}.get(fmt, options)
    writer = (without_line_breaks(df) if fmt == "csv" else df).write.format(fmt).mode(mode).options(**settings)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def land_in_order(
    df: DataFrame, path: str, ts: str, slots: int = 8, fmt: str = "parquet", tie: Sequence[str] = (), mode: str = "append"
) -> str:
    """Lay ``df`` out as ``slots`` files of successive times for replay, in one parallel sorted write.

    A file stream takes files by their modification time, and a parallel write ends them in any order. So the files
    get times a second apart afterwards, in the order of their ranges and up to now: rows come in the order of time, to
    a slot, and a watermark can stay on. Slots hold about as many rows each; choose so many that one fits a task.
    ``tie`` splits rows that share one time over slots. Rows without time are in the first slot. The file system must
    keep the times that it is told, as HDFS and local ones do.
    """
    before = {name for name, _ in _part_files(df, path)} if mode == "append" else set()
    order = [ts, *tie]
    df.repartitionByRange(slots, *order).sortWithinPartitions(*order).write.mode(mode).format(fmt).save(path)
    new = sorted(((name, file) for name, file in _part_files(df, path) if name not in before), key=lambda f: int(f[0].split("-")[1]))
    files, now = _file_system(df, path), int(time.time()) * 1000
    for i, (_, file) in enumerate(new):
        files.setTimes(file, now - (len(new) - 1 - i) * 1000, -1)
    return path


def _file_system(df: DataFrame, path: str):
    spark = df.sparkSession
    return spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())


def _part_files(df: DataFrame, path: str) -> list[tuple]:
    """Names and paths of the data files in a folder, if it is there."""
    files, folder = _file_system(df, path), df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
    found = files.listStatus(folder) if files.exists(folder) else []
    return [(f.getPath().getName(), f.getPath()) for f in found if f.getPath().getName().startswith("part-")]


def write_event_landing(
    df: DataFrame, path: str, ts: str = "event_time", tie: str = "event_id", files: int = 20
) -> str:
    """Lay events out as ``files`` JSON-lines files, each one slice of time, for replay.

    ``tie`` splits a slice whose rows share one timestamp.
    """
    return land_in_order(df, path, ts, files, "json", [tie], "overwrite")
