"""Every registered query against its SQL."""

import os

import pytest
from compare import difference

from punctual.verification.oracle import ORACLE
from punctual.verification.queries import registered

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = registered()


@pytest.fixture(autouse=True, scope="module")
def code_generation(spark):
    changed = {"spark.sql.codegen.wholeStage": "true", "spark.sql.codegen.factoryMode": "FALLBACK"}
    before = {key: spark.conf.get(key) for key in changed}
    for key, value in changed.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_sql(spark, name):
    assert difference(QUERIES[name](spark, FOLDER), FOLDER, ORACLE[name]) is None


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
