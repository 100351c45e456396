import pytest

from punctual.operators.quality import (
    WARN,
    DataTestError,
    ReferenceTest,
    TableTests,
    UniqueTest,
    accepted_values,
    enforce,
    expression_is_true,
    not_null,
    run_tests,
)


@pytest.fixture
def tables(spark):
    rows = [(1, "a", 5), (1, "b", None), (None, "b", 9), (None, "c", 9)]
    known = [("a",), ("b",)]
    return {"t": spark.createDataFrame(rows, "k int, v string, n int"), "known": spark.createDataFrame(known, "v string")}


def results(tables, **tests):
    return {r.test: r.failures for r in run_tests(tables, {"t": TableTests(**tests)}).collect()}


def test_row_tests(tables):
    tests = [not_null("k"), accepted_values("v", ["a", "b"]), accepted_values("n", [9]), expression_is_true("n > 5")]
    assert list(results(tables, rows=tests).values()) == [2, 1, 1, 1]  # NULLs pass all but not_null


def test_uniqueness(tables):
    assert results(tables, unique=[UniqueTest(("k",), skip_nulls=True)]) == {"unique(k)": 1}
    assert results(tables, unique=[UniqueTest(("k",))]) == {"unique_combination(k)": 2}
    assert results(tables, unique=[UniqueTest(("k", "v"))]) == {"unique_combination(k, v)": 0}


def test_references(tables):
    assert results(tables, references=[ReferenceTest("v", "known")]) == {"references(v, known)": 1}
    with pytest.raises(KeyError, match="absent"):
        results(tables, rows=[not_null("v")], references=[ReferenceTest("v", "absent")])
    with pytest.raises(KeyError, match="t"):
        run_tests({"known": tables["known"]}, {"t": TableTests(rows=[not_null("k")])})


def test_severity(tables):
    warned = run_tests(tables, {"t": TableTests(rows=[not_null("k", WARN)])})
    assert [r.severity for r in enforce(warned)] == ["warn"]
    with pytest.raises(DataTestError, match=r"t: not_null\(k\) failed 2 times"):
        enforce(run_tests(tables, {"t": TableTests(rows=[not_null("k"), not_null("v")])}))
