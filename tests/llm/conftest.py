import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from llm_tables import DOCUMENT, TABLES  # noqa: E402


@pytest.fixture
def documents(spark):
    """Documents from texts (numbered) or from (id, text) pairs, with a clashing extra column."""

    def build(texts):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        full = [(i, t, "en" if n % 2 else None, f"src{n % 3}", len(t or "")) for n, (i, t) in enumerate(rows)]
        return spark.createDataFrame(full, DOCUMENT).withColumn("score", F.lit("own")).withColumn("part", F.lit(1))

    return build


@pytest.fixture
def scratch(spark):
    from punctual.llm.common import Scratch

    return Scratch(spark, "test")


@pytest.fixture
def folder(spark, tmp_path):
    """A folder of tables, from rows and a schema or from DataFrames."""

    def build(**tables):
        for name, (rows, schema) in tables.items():
            spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)

    return build


@pytest.fixture
def given(spark):
    """Rows of a given table."""
    return lambda name: [tuple(r) for r in spark.read.parquet(f"{TABLES}/{name}.parquet").collect()]


@pytest.fixture
def sql_difference():
    """What differs between a query and its SQL over the tables that a folder has."""
    import duckdb
    from compare import canonical

    def compare(frame, folder, sql):
        con = duckdb.connect()
        for path in Path(folder).glob("*.parquet"):
            files = f"{path}/*.parquet" if path.is_dir() else path
            con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{files}')")
        found = con.execute(sql)
        expected = canonical([d[0] for d in found.description], found.fetchall())
        actual = canonical(frame.columns, [tuple(r) for r in frame.collect()])
        if actual[0] != expected[0]:
            return f"columns {actual[0]} instead of {expected[0]}"
        extra, missing = actual[1] - expected[1], expected[1] - actual[1]
        return (list(extra.items())[:3], list(missing.items())[:3]) if extra or missing else None

    return compare
