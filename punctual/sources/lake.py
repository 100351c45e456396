"""Lake files in three formats."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctual.sources import files

READERS = 16  # first lines read at a time


def read_csv(spark: SparkSession, path: str | list[str], schema: str | T.StructType | None = None) -> DataFrame:
    """CSV with a header. With a schema nothing is inferred; the files must then have
    its column order, which the header is checked against."""
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).option("enforceSchema", False).option("mode", "FAILFAST").csv(path)


def _headers(spark: SparkSession, pattern: str) -> dict[str, list[str]]:
    """The files that match, by their first line. Of each file only that line is read."""
    paths = sorted(row.path for row in files.list_files(spark, pattern).select("path").collect())
    with ThreadPoolExecutor(READERS) as pool:
        headers = list(pool.map(partial(files.first_line, spark), paths))
    found: dict[str, list[str]] = {}
    for path, header in zip(paths, headers, strict=True):
        found.setdefault(header, []).append(path)
    return found


def _columns(spark: SparkSession, headers: list[str]) -> dict[str, list[str]]:
    """Column names of each header, as the CSV parser splits it."""
    width = max(h.count(",") for h in headers) + 1
    rows = spark.createDataFrame([(h,) for h in headers], "header string")
    parsed = F.from_csv("header", ", ".join(f"c{i} string" for i in range(width))).alias("names")
    return {r.header: [c for c in r.names if c is not None] for r in rows.select("header", parsed).collect()}


def read_csv_by_name(spark: SparkSession, pattern: str, types: dict[str, str]) -> DataFrame:
    """CSV files whose columns may differ in order or be missing, aligned by name.

    Spark aligns the files of one CSV read by position. So the first line of every file is
    read, the files are grouped by it, each group is read at once with its own column order,
    and the groups are united by name. `types` gives the type of every wanted column; the
    driver holds file names and headers only.
    """
    by_header = _headers(spark, pattern)
    if not by_header:
        raise FileNotFoundError(pattern)
    names = _columns(spark, list(by_header))
    parts = []
    for header, paths in by_header.items():
        columns = names[header]
        schema = T.StructType([T.StructField(c, _parsed_type(types.get(c, "string"))) for c in columns])
        wanted = [F.col(f"`{c.replace('`', '``')}`") for c in columns if c in types]
        parts.append(read_csv(spark, paths, schema).select(*wanted))
    united = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return united.select(*[f"`{c.replace('`', '``')}`" for c in types if c in united.columns])


def _parsed_type(text: str) -> T.DataType:
    return T.StructType.fromDDL(f"c {text}")[0].dataType


def read_json_array(spark: SparkSession, path: str | list[str], schema: str | None = None) -> DataFrame:
    """JSON arrays of objects; nested fields are inferred when no schema is given."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.parquet(*paths)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
