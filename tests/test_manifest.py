import datetime as dt
import shutil

import pytest

from punctual.sources import manifest as module
from punctual.sources.manifest import Manifest


@pytest.fixture
def dataset(spark, tmp_path):
    manifest = Manifest(spark, str(tmp_path / "manifest"))
    manifest.register_dataset("w", "Weather", str(tmp_path / "data"), "archive")

    def add(rows, schema="day date, v int, s string", **stats):
        df = spark.createDataFrame(rows, schema).coalesce(1)
        df.write.mode("append").parquet(str(tmp_path / "data"))
        return manifest.register_files("w", **({"stats": ["day", "v"], "distinct": ["s"]} | stats))

    return manifest, add


def values(df):
    return sorted(r.v for r in df.collect())


def data_files(tmp_path):
    return sorted((tmp_path / "data").glob("part-*"))


def test_register(dataset, tmp_path):
    manifest, add = dataset
    add([(dt.date(2024, 1, 1), 5, "a"), (dt.date(2024, 1, 2), None, "a"), (None, 7, "b")])
    assert manifest.dataset("w").dataset_name == "Weather"
    assert [d.dataset_id for d in manifest.datasets()] == ["w"]
    part = manifest.file_stats("w", "day").head()
    assert (part.row_count, part.partition_key) == (3, "all")
    assert part.size == data_files(tmp_path)[0].stat().st_size
    stats = {
        c: tuple(manifest.file_stats("w", c).head()[c2] for c2 in ("min_value", "max_value", "null_count", "distinct_count"))
        for c in ("day", "v", "s")
    }
    assert stats == {
        "day": (dt.date(2024, 1, 1), dt.date(2024, 1, 2), 1, None),
        "v": (5, 7, 1, None),
        "s": ("a", "b", 0, 2),
    }
    with pytest.raises(ValueError, match="registered already"):
        manifest.register_dataset("w", "again", "x")
    with pytest.raises(KeyError):
        manifest.dataset("other")


def test_snapshots_and_schema_versions(dataset):
    manifest, add = dataset
    add([(dt.date(2024, 1, 1), 1, "a")])
    add([(dt.date(2024, 2, 1), 2, "b")])
    assert manifest.schema_versions("w").count() == 1
    add([(dt.date(2024, 3, 1), 3, "c", True)], schema="day date, v int, s string, extra boolean")
    listed = manifest.snapshots("w").collect()
    assert [(r.number, r.files, r.rows) for r in listed] == [(1, 1, 1), (2, 2, 2), (3, 3, 3)]
    assert [(r.schema_version, r.number) for r in manifest.schema_versions("w").collect()] == [(1, 1), (2, 3)]
    assert values(manifest.read_snapshot("w", 1)) == [1]
    assert values(manifest.read_snapshot("w", 2)) == [1, 2]
    assert values(manifest.read("w")) == [1, 2, 3]
    assert manifest.read_snapshot("w", 2).columns == ["day", "v", "s"]
    assert manifest.read("w").columns == ["day", "v", "s", "extra"]
    for unknown in (0, 4):
        with pytest.raises(KeyError):
            manifest.read_snapshot("w", unknown)


def test_an_empty_dataset_has_a_snapshot(dataset):
    manifest, add = dataset
    assert manifest.snapshots("w").count() == 0
    manifest.register_files("w")
    assert [(r.number, r.files, r.rows) for r in manifest.snapshots("w").collect()] == [(1, 0, 0)]
    assert manifest.read("w").collect() == [] and manifest.read_snapshot("w", 1).collect() == []
    assert manifest.register_files("w").number == 1  # nothing changed
    add([(None, 1, "a")])
    assert values(manifest.read("w")) == [1]


def test_many_registrations_stay_linear(dataset, tmp_path, monkeypatch):
    """Entries written over n registrations are about twice the files; every state reads right."""
    manifest, add = dataset
    monkeypatch.setattr(module, "FEW", 2)
    for d in range(1, 10):
        add([(dt.date(2024, 1, d), d, "a")], stats=["v"], distinct=[])
    home = tmp_path / "manifest" / "w"
    written = sum(manifest.spark.read.parquet(str(f)).count() for f in [*home.glob("state-*"), *home.glob("changes-*")])
    assert 9 < written <= 3 * 9
    assert len(list(home.glob("state-*"))) == 3  # after 2, 4 and 8 files
    for n in (1, 2, 5, 8, 9):
        assert values(manifest.read_snapshot("w", n)) == list(range(1, n + 1))


def test_a_damaged_known_file_does_not_stop_a_new_one(dataset, tmp_path):
    manifest, add = dataset
    add([(dt.date(2024, 1, 1), 1, "a")])
    known = data_files(tmp_path)[0]
    before, stat = known.read_bytes(), known.stat()
    known.write_bytes(b"x" * len(before))
    import os

    os.utime(known, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    add([(dt.date(2024, 1, 2), 2, "b")])
    assert manifest.file_stats("w", "v").count() == 2


def test_only_new_files_are_opened_and_gone_ones_leave(dataset, tmp_path):
    manifest, add = dataset
    add([(dt.date(2024, 1, 1), 1, "a")])
    add([(dt.date(2024, 1, 2), 2, "b")])
    first = data_files(tmp_path)[0]
    gone = manifest.spark.read.parquet(str(first)).head().v
    first.unlink()
    commit = manifest.register_files("w", operation="DELETE")
    assert (commit.files, commit.rows) == (1, 1)
    assert values(manifest.read("w")) == [v for v in (1, 2) if v != gone]
    assert [r.operation for r in manifest.snapshots("w").collect()] == ["INSERT", "INSERT", "DELETE"]


def test_files_without_rows_are_known(dataset):
    manifest, add = dataset
    add([])
    assert manifest.snapshots("w").head().files == 1
    assert manifest.register_files("w", stats=["day"]).number == 1
    assert manifest.prune("w", "v", 1, 2).count() == 0 and manifest.read_range("w", "v", 1, 2).collect() == []


def test_pruning(dataset):
    manifest, add = dataset
    add([(dt.date(2024, 1, d), d, "a") for d in (1, 9)])
    add([(dt.date(2024, 2, d), 100 + d, "a") for d in (1, 9)])
    add([(None, 5, "a")])
    assert manifest.prune("w", "day", "2024-01-05", "2024-01-31").count() == 1
    assert manifest.prune("w", "v", 9, 101).count() == 2  # compared as numbers, not as text
    rows = manifest.read_range("w", "day", "2024-01-05", "2024-02-05")
    assert len(rows.inputFiles()) == 2
    assert sorted(r.v for r in rows.collect()) == [9, 101]
    assert manifest.read_range("w", "day", "2025-01-01", "2025-02-01").collect() == []


def test_a_column_without_ranges_prunes_nothing(dataset):
    manifest, add = dataset
    add([(dt.date(2024, 1, 1), 1, "a")], stats=[], distinct=[])
    assert manifest.prune("w", "v", 50, 60).count() == 1
    add([(dt.date(2024, 1, 2), 2, "b")], stats=["v"], distinct=[])
    assert manifest.prune("w", "v", 50, 60).count() == 1  # the second file is known now


def test_a_rewritten_file_is_not_pruned_by_its_old_range(spark, dataset, tmp_path):
    manifest, add = dataset
    add([(dt.date(2024, 1, 1), 1, "a")])
    add([(dt.date(2024, 1, 2), 2, "b")])
    path = data_files(tmp_path)[0]
    spark.createDataFrame([(None, 77, "new"), (None, 78, "new")], "day date, v int, s string").coalesce(1).write.parquet(str(tmp_path / "other"))
    shutil.copy(next((tmp_path / "other").glob("part-*")), path)
    path.with_name(f".{path.name}.crc").unlink()  # the checksum of the old file
    assert values(manifest.read_range("w", "v", 70, 80)) == [77, 78]
    commit = manifest.register_files("w", stats=["day", "v"], operation="REWRITE")
    assert (commit.files, commit.rows) == (2, 3)
    assert manifest.prune("w", "v", 70, 80).count() == 1


def test_ranges_do_not_depend_on_the_time_zone(spark, tmp_path):
    manifest = Manifest(spark, str(tmp_path / "manifest"))
    manifest.register_dataset("t", "Times", str(tmp_path / "data"))
    for hour in (0, 6, 12):
        row = spark.sql(f"SELECT timestamp_seconds({hour} * 3600) AS at, {hour} AS v").coalesce(1)
        row.write.mode("append").parquet(str(tmp_path / "data"))
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        manifest.register_files("t", stats=["at"])
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        found = manifest.read_range("t", "at", "1970-01-01 00:00:00", "1970-01-01 02:00:00")
        assert values(found) == [6]
        assert len(found.inputFiles()) == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_a_changed_type_is_a_new_range(dataset):
    manifest, add = dataset
    add([(dt.date(2024, 1, 1), 1, "a")], stats=["v"], distinct=[])
    add([(dt.date(2024, 1, 2), 1 << 40, "b")], schema="day date, v bigint, s string", stats=["v"], distinct=[])
    # the range of the first file is of another type, so it is kept
    assert manifest.prune("w", "v", 5, 6).count() == 1
    assert values(manifest.read_range("w", "v", 1, 1 << 41)) == [1, 1 << 40]
