"""Helpers that the operators here share: scratch tables, hidden column names, word counts."""

from __future__ import annotations

import atexit
import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..sources.scratch import delete_folder, shared_folder

#: Words are maximal runs of anything but these six characters.
WORD = r"[^\x20\x09-\x0D]+"


class Scratch:
    """Tables written to the shared folder, so that a lost executor costs no recomputation.

    What a returned DataFrame still reads stays until the driver ends; drop() removes the rest earlier.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        self.names: set[str] = set()
        self.tables: list[str] = []
        atexit.register(self._clear)

    def _clear(self) -> None:
        delete_folder(self.spark, self.root)

    def keep(self, df: DataFrame, name: str, *by: str) -> DataFrame:
        path = f"{self.root}/{name}"
        self.names.add(name)
        df.write.mode("overwrite").option("compression", "zstd").partitionBy(*by).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def bucketed(self, df: DataFrame, name: str, key: str) -> DataFrame:
        """A table written by hash of ``key``, so that joins on it leave its rows in place."""
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        title = f"scratch_{uuid.uuid4().hex}"
        self.names.add(name)
        self.tables.append(title)
        df.repartition(n, key).write.bucketBy(n, key).sortBy(key).format("parquet").option("compression", "zstd").option("path", f"{self.root}/{name}").saveAsTable(title)
        return self.spark.table(title)

    def drop(self, *names: str) -> None:
        for name in names:
            delete_folder(self.spark, f"{self.root}/{name}")
            self.names.discard(name)

    def drop_but(self, *names: str) -> None:
        for title in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {title}")
        self.tables.clear()
        self.drop(*(self.names - set(names)))


def small_batches(spark: SparkSession) -> None:
    """Batches to and from Python of a few megabytes: rows here are whole texts, and ten thousand long ones are too many for a task.

    The setting is the session's, as batches are cut when a result is read; a smaller one stays.
    """
    name, most = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20
    now = spark._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch()
    if not 0 < now <= most:
        spark.conf.set(name, str(most))


def rows_of(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few rows that the driver has; by Arrow, as other ways start Python workers that stay."""
    kind = T.StructType.fromDDL(schema)
    columns = list(zip(*rows, strict=True)) or [()] * len(kind)
    arrow = to_arrow_schema(kind)
    return spark.createDataFrame(pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow), kind)


def trim() -> None:
    """Gives freed memory back to the system: workers wait for their next task beside others, and keep what they once had."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        return


def trimmed(read: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function of batches that gives its memory back at its end."""

    def wrapped(batches: Iterator) -> Iterator:
        yield from read(batches)
        trim()

    return wrapped


def by_key(work: Callable[[int, list[bytes]], Iterator[pa.RecordBatch]], key: str, data: str = "data") -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Batches whose rows are sorted by an integer key -> what ``work`` makes of each key's data."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for b in batches:
            for k, d in zip(b.column(key).to_pylist(), b.column(data), strict=True):
                if k != now and held:
                    mine, held = held, []
                    yield from work(now, mine)
                now = k
                held.append(d.as_py())
        if held:
            yield from work(now, held)

    return trimmed(read)


def dealt(df: DataFrame, key: str, sort: bool = True) -> DataFrame:
    """Rows by an integer key, key by key: keys go round the partitions, where a hash would put many on one."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = df.repartitionById(n, F.pmod(F.col(key), F.lit(n)).cast("int"))
    return out.sortWithinPartitions(key) if sort else out


def hidden(df: DataFrame, names: list[str]) -> tuple[list[Column], list[tuple[str, str]]]:
    """Columns under names that can't clash with ours, and how to name them back."""
    pairs = [(f"__c{i}", name) for i, name in enumerate(names)]
    return [df[f"`{name}`"].alias(inner) for inner, name in pairs], pairs


def shown(pairs: list[tuple[str, str]], *results: str) -> list[Column]:
    """The hidden columns by their names, but for those that a result has."""
    return [F.col(inner).alias(name) for inner, name in pairs if name not in results]


def word_count(text: Column) -> Column:
    """Number of words, long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def id_text(name: str) -> Column:
    return F.col(name).cast("string")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
