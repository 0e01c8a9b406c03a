"""Tables that cut a plan in two: written to the folder that all executors see, and gone when the driver ends."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; where it is unset and all is one machine, one of our own."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="clausemill-")
        context.setCheckpointDir(named)
    return named.rstrip("/")


def delete_folder(spark: SparkSession, path: str) -> None:
    try:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # at the driver's end the session may have gone first
        return


def _write(df: DataFrame, name: str) -> tuple[str, DataFrame]:
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return path, df.sparkSession.read.schema(df.schema).parquet(path)


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """The same rows from a table that stays until the driver ends: what several branches of a plan read is made once, and a lost
    executor costs no more than its tasks."""
    path, table = _write(df, name)
    atexit.register(delete_folder, df.sparkSession, path)
    return table


@contextmanager
def held(*dfs: DataFrame) -> Iterator:
    """As ``written``, for as long as the block lasts: one table, or a list of them."""
    made: list[tuple[str, DataFrame]] = []
    try:
        for df in dfs:
            made.append(_write(df, "held"))
        yield made[0][1] if len(made) == 1 else [table for _, table in made]
    finally:
        for path, _ in made:
            delete_folder(dfs[0].sparkSession, path)
