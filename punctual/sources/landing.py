"""The landing zone: one folder per departure day, written and tidied by Spark."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctual import schemas
from punctual.plans.bronze import SOURCE_PATH
from punctual.sources import files
from punctual.sources.day_files import DAY_FILES, DAY_PATTERN, day_of

DAY = "departureDate"
CORRUPT, BAD = "_corrupt_record", "_unreadable"
QUARANTINE = "quarantine"
PLAIN_DAY_FILES = "train_departure_date/*/*/*.json"


def land(trains: DataFrame, path: str, compress: bool = True) -> None:
    """Write trains as JSON lines, one folder per day. A day in the batch replaces the
    landed day, so a day never exists in two formats; other days stay untouched. The
    committer makes the new files visible only when the job has finished.

    Rows are rebalanced by day, which splits a large day over several tasks.
    """
    spread = trains.hint("rebalance", F.col(DAY))
    writer = spread.write.partitionBy(DAY).mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.option("compression", "gzip" if compress else "none").json(path)


def land_per_train(trains: DataFrame, path: str) -> None:
    """The same with one folder per day and train number."""
    spread = trains.hint("rebalance", F.col(DAY), F.col("trainNumber"))
    writer = spread.write.partitionBy(DAY, "trainNumber").mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").option("compression", "gzip").json(path)


def read_landed(spark: SparkSession, path: str, schema: str = schemas.TRAIN) -> DataFrame:
    """Landed trains with their file in _path; a filter on departureDate prunes folders."""
    rows = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return rows.select("*", F.col("_metadata.file_path").alias(SOURCE_PATH))


def list_day_files(spark: SparkSession, root: str) -> DataFrame:
    """Finished day files of the raw layout: path, name, size, day, is_gzip."""
    listing = files.list_files(spark, f"{root}/{DAY_FILES}")
    named = listing.where(F.col("name").rlike("^" + DAY_PATTERN))
    return named.select("*", day_of(F.col("name")).alias("day"), F.col("name").endswith(".gz").alias("is_gzip"))


def redundant_files(day_files: DataFrame) -> DataFrame:
    """Plain files beside a gzipped one of the same day and folder; the gzipped one counts."""
    folder = F.regexp_extract("path", r"^(.*)/[^/]+$", 1)
    zipped = F.max("is_gzip").over(Window.partitionBy(folder, "day"))
    return day_files.withColumn("_zipped", zipped).where("_zipped AND NOT is_gzip").drop("_zipped")


def expired_files(day_files: DataFrame, cutoff: dt.date) -> DataFrame:
    return day_files.where(F.col("day") < F.lit(cutoff))


def staging_report(day_files: DataFrame) -> DataFrame:
    """Days kept, files and megabytes."""
    return day_files.agg(
        F.countDistinct("day").alias("days_kept"),
        F.count(F.lit(1)).alias("files"),
        (F.coalesce(F.sum("size"), F.lit(0)) / 1e6).alias("size_mb"),
    )


def read_permissive(spark: SparkSession, paths: str | list[str], schema: str, multi_line: bool = True) -> DataFrame:
    """Rows of JSON files with the text of unreadable records in _corrupt_record and
    the file in _path."""
    reader = spark.read.schema(f"{schema}, {CORRUPT} string").option("multiLine", multi_line)
    rows = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(paths)
    return rows.select("*", F.col("_metadata.file_path").alias(SOURCE_PATH))


def bad_files(rows: DataFrame) -> DataFrame:
    """One row (_path, n_bad) per file that holds an unreadable record."""
    data = next(c for c in rows.columns if c not in (CORRUPT, SOURCE_PATH))
    # always true; Spark refuses to read the corrupt text without any data column
    reads_data = F.coalesce(F.col(data).cast("string"), F.lit("")) >= F.lit("")
    unreadable = rows.where(F.col(CORRUPT).isNotNull() & reads_data)
    return unreadable.groupBy(SOURCE_PATH).agg(F.count(F.lit(1)).alias("n_bad"))


def split_readable(rows: DataFrame, parsed: str) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the files with an unreadable record. Every row of such a file is
    held back: half a file is not a day.

    The files are parsed once: rows go to the folder `parsed`, unreadable ones apart, and both
    results come from there.
    """
    rows.withColumn(BAD, F.col(CORRUPT).isNotNull()).write.partitionBy(BAD).parquet(parsed)
    # the schema is known, also where one of the parts is empty
    schema = T.StructType([*rows.schema.fields, T.StructField(BAD, T.BooleanType())])
    kept = rows.sparkSession.read.schema(schema).parquet(parsed)
    bad = kept.where(F.col(BAD)).groupBy(SOURCE_PATH).agg(F.count(F.lit(1)).alias("n_bad"))
    good = kept.where(~F.col(BAD)).join(bad, SOURCE_PATH, "left_anti")
    return good.drop(CORRUPT, BAD), bad


def unreadable_files(spark: SparkSession, root: str) -> DataFrame:
    """Plain day files that do not parse: _path, n_bad."""
    pattern = f"{root}/{PLAIN_DAY_FILES}"
    if not files.exists(spark, pattern):
        return spark.createDataFrame([], "_path string, n_bad bigint")
    rows = read_permissive(spark, pattern, schemas.TRAIN)
    name = F.regexp_extract(SOURCE_PATH, r"([^/]+)$", 1)
    return bad_files(rows.where(name.rlike("^" + DAY_PATTERN)))


def compress_plain_days(spark: SparkSession, root: str, dry_run: bool = False) -> DataFrame:
    """Gzip the plain day files that have no gzipped twin and parse; one row with the
    number of files and the bytes before and after.

    Tasks compress whole files side by side into a folder of their own; each result is
    then renamed into place and the plain file goes. A dry run only counts.
    """
    day_files = list_day_files(spark, root)
    twins = redundant_files(day_files).select("path")
    broken = unreadable_files(spark, root).select(F.col(SOURCE_PATH).alias("path"))
    plain = day_files.where(~F.col("is_gzip") & F.col("day").isNotNull())
    plain = plain.join(twins, "path", "left_anti").join(broken, "path", "left_anti")
    todo = {r.name: r for r in plain.collect()}  # file names, bounded by the listing
    after = 0
    if todo and not dry_run:
        staged = f"{root}/_compressing-{uuid.uuid4().hex}"
        texts = spark.read.option("wholetext", True).text([r.path for r in todo.values()])
        named = texts.select("value", F.col("_metadata.file_name").alias("name"))
        named.write.partitionBy("name").option("compression", "gzip").text(staged)
        for row in files.list_files(spark, f"{staged}/*/part-*").collect():
            source = todo[row.path.split("/name=", 1)[1].split("/", 1)[0]].path
            files.rename(spark, row.path, f"{source}.gz")
            files.delete(spark, [source])
            after += row.size
        files.delete(spark, [staged])
    before = sum(r.size for r in todo.values())
    return spark.createDataFrame(
        [(len(todo), before, after)], "files bigint, bytes_before bigint, bytes_after bigint"
    )


def tidy(spark: SparkSession, root: str, cutoff: dt.date, dry_run: bool = False) -> DataFrame:
    """Housekeeping before a load: drop days before `cutoff` (landed and quarantined),
    drop plain twins of gzipped days, quarantine unreadable files. Returns one row per
    affected file: path, day, size, action. A dry run changes nothing.
    """
    quarantine = f"{root}/{QUARANTINE}"
    day_files = list_day_files(spark, root)
    held = files.list_files(spark, f"{quarantine}/*.json*")
    held = held.select("*", day_of(F.col("name")).alias("day"))
    kept = day_files.where(F.col("day") >= F.lit(cutoff))
    twins = redundant_files(kept)
    unreadable = unreadable_files(spark, root).select(F.col(SOURCE_PATH).alias("path"))
    broken = kept.join(twins.select("path"), "path", "left_anti").join(unreadable, "path", "left_semi")

    columns = ["path", "day", "size"]
    actions = (
        expired_files(day_files, cutoff)
        .select(*columns, F.lit("delete").alias("action"))
        .unionByName(expired_files(held, cutoff).select(*columns, F.lit("delete").alias("action")))
        .unionByName(twins.select(*columns, F.lit("drop_twin").alias("action")))
        .unionByName(broken.select(*columns, F.lit("quarantine").alias("action")))
    )
    planned = actions.collect()  # names of files to touch, bounded by the listing
    if not dry_run:
        files.delete(spark, [r.path for r in planned if r.action != "quarantine"])
        files.move_into(spark, [r.path for r in planned if r.action == "quarantine"], quarantine)
    return spark.createDataFrame(planned, "path string, day date, size bigint, action string")


def load_summary(
    trains: DataFrame,
    start: dt.date | None,
    end: dt.date,
    station: str | None = None,
    compress: bool = True,
) -> DataFrame:
    """One row that records a load: range (no start for everything), days, trains,
    options, time."""
    requested = None if start is None else (end - start).days + 1
    return trains.agg(
        F.lit(start).cast("date").alias("start_date"),
        F.lit(end).alias("end_date"),
        F.lit(requested).cast("int").alias("days_requested"),
        F.countDistinct(DAY).alias("days_loaded"),
        F.count(F.lit(1)).alias("total_trains"),
        F.lit(station).cast("string").alias("station_filter"),
        F.lit(compress).alias("compress"),
        F.current_timestamp().alias("load_time"),
    )


def coverage_record(trains: DataFrame) -> DataFrame:
    """First day, last day and number of days."""
    return trains.agg(
        F.min(DAY).alias("data_from"), F.max(DAY).alias("data_through"), F.countDistinct(DAY).alias("days")
    )
