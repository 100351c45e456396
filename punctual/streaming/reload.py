"""Day files as a stream.

The stream only finds new files; every micro-batch is handed to the same load that the
batch build uses. A re-fetched day arrives as a new or changed file and replaces its day
as a whole, within the reload window. A ledger keeps the batches that were loaded.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from punctual import schemas
from punctual.plans import bronze
from punctual.plans.build import BRONZE, TRAINS
from punctual.sources.day_files import DAY_FILES, DAY_PATTERN, day_of
from punctual.sources.landing import read_landed
from punctual.sources.tables import DAY, Warehouse


BATCHES, BATCH = "stream_batches", "stream string, batch_id bigint, days array<date>"
FILE = "path string, modificationTime timestamp, length bigint, content binary"
#: Files of a batch: bounds what a batch plans and loads at once.
MAX_FILES = 1_000


def train_stream(
    spark: SparkSession, root: str, since: dt.date | None = None, max_files: int = MAX_FILES
) -> DataFrame:
    """New finished day files as a stream of trains; late files before `since` drop out."""
    raw = spark.readStream.schema(schemas.TRAIN).option("multiLine", True).option("mode", "FAILFAST")
    raw = raw.option("maxFilesPerTrigger", max_files)
    name = F.col("_metadata.file_name")
    trains = raw.json(f"{root}/{DAY_FILES}").where(name.rlike(DAY_PATTERN))
    if since is not None:
        trains = trains.where(day_of(name) >= F.lit(since))
    return trains.select("*", F.col("_metadata.file_path").alias(bronze.SOURCE_PATH))


def run_available(
    stream: DataFrame, load: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    """Process everything that is there and stop. The checkpoint folder must be shared
    by all executors; a restart continues after the last finished batch."""
    writer = stream.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint)
    query = writer.foreachBatch(load).start()
    query.awaitTermination()
    return query


class Ledger:
    """The batches of a stream that have been loaded, so that a batch which comes again after
    a failure does nothing. A failure between the load and its entry brings the batch again;
    it then replaces the same days with the same rows."""

    def __init__(self, warehouse: Warehouse, stream: str):
        self.warehouse, self.stream = warehouse, stream

    def loaded(self) -> DataFrame:
        if not self.warehouse.has(BRONZE, BATCHES):
            return self.warehouse.spark.createDataFrame([], BATCH)
        return self.warehouse.read(BRONZE, BATCHES).where(F.col("stream") == self.stream)

    def has(self, batch_id: int) -> bool:
        return not self.loaded().where(F.col("batch_id") == batch_id).isEmpty()

    def enter(self, batch_id: int, days: list[dt.date]) -> None:
        row = self.warehouse.spark.createDataFrame([(self.stream, batch_id, days)], BATCH)
        self.warehouse.append(row, BRONZE, BATCHES)

    def once(self, load: Callable[[DataFrame], list[dt.date]]) -> Callable[[DataFrame, int], None]:
        """`load`, which returns the days it replaced, for batches that are not entered yet."""

        def run(batch: DataFrame, batch_id: int) -> None:
            if not self.has(batch_id):
                self.enter(batch_id, load(batch))

        return run


def load_new_days(
    spark: SparkSession,
    root: str,
    warehouse: Warehouse,
    checkpoint: str,
    run_id: str,
    since: dt.date | None = None,
    max_files: int = MAX_FILES,
) -> None:
    """Load new day files into the bronze table, at most `max_files` to a batch. A file is
    parsed once, by the write of its batch."""

    def load(batch: DataFrame) -> list[dt.date]:
        return warehouse.replace_days(bronze.train_departures(batch, run_id), BRONZE, TRAINS)

    stream = train_stream(spark, root, since, max_files)
    run_available(stream, Ledger(warehouse, checkpoint).once(load), checkpoint)


def load_landed_days(
    spark: SparkSession, landed: str, warehouse: Warehouse, checkpoint: str, run_id: str, max_files: int = MAX_FILES
) -> None:
    """The same for a landing zone with one folder per day. A day may consist of several
    files, so a batch only tells which days changed: their names stand in the folders of the
    new files, none of which is opened for it. Those days are read once, as a whole."""

    def load(batch: DataFrame) -> list[dt.date]:
        day = F.regexp_extract("path", f"/{DAY}=([^/]+)/", 1).try_cast("date")
        changed = [row[0] for row in batch.select(day).distinct().collect()]  # calendar days
        whole_days = read_landed(spark, landed).where(F.col(DAY).isin(changed))
        return warehouse.replace_days(bronze.train_departures(whole_days, run_id), BRONZE, TRAINS)

    names = spark.readStream.format("binaryFile").schema(FILE).option("maxFilesPerTrigger", max_files)
    stream = names.option("recursiveFileLookup", True).load(landed).select("path")
    run_available(stream, Ledger(warehouse, checkpoint).once(load), checkpoint)
