"""Stored intermediate tables, which cut lineage and survive lost executors."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator
from contextlib import ExitStack, contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.session import scratch_dir

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Where rows hold MBs each: what a Python worker is given at a time, in bytes; rows that a
#: reader of tables holds at a time; rows after which a writer looks at the size of its pages.
LARGE = {"spark.sql.execution.arrow.maxBytesPerBatch": str(1 << 20), "spark.sql.parquet.columnarReaderBatchSize": "4"}
PAGES = {"parquet.page.size.row.check.min": "1", "parquet.block.size.row.check.min": "1", "parquet.block.size": str(16 << 20)}


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the length of a block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def give_back() -> None:
    """Return freed memory to the system. Python workers outlive their task; without this
    each keeps its largest batch."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def giving_back(batches: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function on batches which gives memory back when it is through."""

    @functools.wraps(batches)
    def through(given: Iterator) -> Iterator:
        yield from batches(given)
        give_back()

    return through


class Scratch:
    """Tables of one operator below the shared folder of `spark.checkpoint.dir`.

    The shuffle files of a step go as soon as its table is written, so the disk holds one
    step at a time; `drop` removes tables that later steps do not read.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = scratch_dir(spark, label)

    def store(self, df: DataFrame, name: str, batch: int = 10_000, large: bool = False) -> DataFrame:
        """`df` as a written table; Python functions in it see at most `batch` rows at a time.
        `large`: rows of MBs are read, given to Python and written about one by one."""
        path = f"{self.root}/{name}"
        with ExitStack() as held:
            for key, value in ({CLEANUP: "true", BATCH: str(batch)} | (LARGE if large else {})).items():
                held.enter_context(setting(self.spark, key, value))
            df.write.options(**(PAGES if large else {})).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ids_are_unique(df: DataFrame, column: str) -> bool:
    """Whether no two rows share an id (null counts as one)."""
    return df.groupBy(column).count().where("count > 1").isEmpty()


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column), F.lit(""))
