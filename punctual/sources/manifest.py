"""A dataset manifest: which files a dataset has, what is in them, how they changed.

Each dataset has a log. A registration lists the files of the dataset and compares path, size
and time with what the log knows; it opens the new ones only and writes what was added and
removed. A commit, a small numbered file, then names the folders that make up the state: one
with all files at some earlier commit and the changes since. Once the changes are as many as
the files of that state, a new one is written, so n registrations write some 2 n entries, and a
lookup reads no more than twice the files there are.

Ranges of columns are kept in the columns' own types, so they compare as the values do, in any
session time zone. They hold for a file of that size and time; a file that was rewritten since
is read whole.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctual.sources import files

ALL = "all"
LISTING = "path string, size bigint, modified timestamp"
ENTRY = f"{LISTING}, added boolean, number bigint, folder string, rows bigint"
#: Changes that are kept without writing a new state, at least.
FEW = 8


@dataclass(frozen=True)
class Commit:
    """One state of a dataset."""

    number: int = 0
    time: str = ""
    operation: str = ""
    folders: tuple[str, ...] = ()  # a state, then changes
    state_files: int = 0  # files of that state
    changes: int = 0  # entries of the changes
    files: int = 0
    rows: int = 0
    schema_version: int = 0
    schema: str = T.StructType().json()
    #: columns with ranges as (name, type); position i is field `c{i}` of the entries
    ranged: tuple[tuple[str, str], ...] = ()
    counted: tuple[str, ...] = ()

    @classmethod
    def parse(cls, text: str) -> Commit:
        values = json.loads(text)
        lists = {k: tuple(values[k]) for k in ("folders", "counted")}
        return cls(**values | lists | {"ranged": tuple(map(tuple, values["ranged"]))})

    def struct(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))

    def field_of(self, column: str) -> str | None:
        """The entry field with ranges of the column as it is typed now."""
        key = (column, self.struct()[column].dataType.simpleString())
        return f"c{self.ranged.index(key)}" if key in self.ranged else None

    def entry_schema(self) -> str:
        parts = [ENTRY]
        if self.ranged:
            own = [(f"c{i}", kind) for i, (_, kind) in enumerate(self.ranged)]
            parts += [f"{name} struct<{', '.join(f'{f}: {kind}' for f, kind in own)}>" for name in ("low", "high")]
            parts.append(f"nulls struct<{', '.join(f'{f}: bigint' for f, _ in own)}>")
        if self.counted:
            parts.append(f"uniques struct<{', '.join(f'u{i}: bigint' for i in range(len(self.counted)))}>")
        return ", ".join(parts)


@dataclass(frozen=True)
class Dataset:
    dataset_id: str
    dataset_name: str
    location: str
    description: str = ""
    file_format: str = "parquet"


class Manifest:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _home(self, dataset_id: str) -> str:
        return f"{self.root}/{dataset_id}"

    # registering

    def register_dataset(
        self, dataset_id: str, name: str, location: str, description: str = "", file_format: str = "parquet"
    ) -> None:
        found = Dataset(dataset_id, name, location.rstrip("/"), description, file_format)
        if not files.write_new(self.spark, f"{self._home(dataset_id)}/dataset.json", json.dumps(asdict(found))):
            raise ValueError(f"dataset {dataset_id} is registered already")

    def dataset(self, dataset_id: str) -> Dataset:
        path = f"{self._home(dataset_id)}/dataset.json"
        if not files.exists(self.spark, path):
            raise KeyError(f"no dataset {dataset_id}")
        return Dataset(**json.loads(files.read_text(self.spark, path)))

    def datasets(self) -> list[Dataset]:
        """All datasets, by their ids."""
        return [self.dataset(name) for name in sorted(files.subfolders(self.spark, self.root))]

    def register_files(
        self, dataset_id: str, stats: Sequence[str] = (), distinct: Sequence[str] = (), operation: str = "INSERT"
    ) -> Commit:
        """Register what changed since the last time: files that are new, were rewritten, or
        are gone. Only new and rewritten files are opened, once each, for their rows, the range
        and NULLs of the `stats` columns, and the exact number of values of the `distinct`
        columns. Nothing changed: no new snapshot."""
        found, before = self.dataset(dataset_id), self._commit(dataset_id)
        listed = self._listing(found.location)
        known = self._state(dataset_id, before).select("path", "size", "modified", "folder", "rows")
        identity = ["path", "size", "modified"]
        # names of new files only; what is scanned and what is written are then the same files
        new = (listed.join(known, identity, "left_anti") if before.number else listed).collect()
        gone = known.join(listed, identity, "left_anti") if before.number else known
        after = replace(
            before,
            number=before.number + 1,
            time=dt.datetime.now(dt.UTC).isoformat(),
            operation=operation,
            counted=tuple(dict.fromkeys([*before.counted, *distinct])),
        )
        marks = [F.lit(False).alias("added"), F.lit(after.number).cast("long").alias("number")]
        removed = gone.select(*identity, *marks, "folder", "rows")
        if new:
            data = self._reader(found).load([row.path for row in new])
            after = _with_columns(after, data.schema, [*stats, *distinct])
            fresh = self.spark.createDataFrame(new, listed.schema)
            added = _entries(data, fresh, after, [*stats, *distinct], distinct)
            changes = added.unionByName(removed, allowMissingColumns=True)
        else:
            changes = removed
        folder = f"changes-{uuid.uuid4().hex}"
        changes.write.parquet(f"{self._home(dataset_id)}/{folder}")
        written = self.spark.read.schema(after.entry_schema()).parquet(f"{self._home(dataset_id)}/{folder}")
        sign = F.when(F.col("added"), 1).otherwise(-1)
        n, files_more, rows_more = written.agg(
            F.count(F.lit(1)), F.coalesce(F.sum(sign), F.lit(0)), F.coalesce(F.sum(sign * F.col("rows")), F.lit(0))
        ).head()
        if not n and before.number:
            files.delete(self.spark, [f"{self._home(dataset_id)}/{folder}"])
            return before
        after = replace(
            after,
            folders=(*before.folders, folder),
            changes=before.changes + n,
            files=before.files + files_more,
            rows=before.rows + rows_more,
        )
        if after.changes >= max(FEW, after.state_files):
            whole = f"state-{uuid.uuid4().hex}"
            self._state(dataset_id, after).write.parquet(f"{self._home(dataset_id)}/{whole}")
            after = replace(after, folders=(whole,), state_files=after.files, changes=0)
        if not files.write_new(self.spark, self._commit_file(dataset_id, after.number), json.dumps(asdict(after))):
            raise OSError(f"{dataset_id} was registered by someone else meanwhile")
        return after

    def _listing(self, location: str) -> DataFrame:
        """Path, size and time of the files below `location`; no file is opened."""
        if not files.exists(self.spark, location):
            return self.spark.createDataFrame([], f"{LISTING}, file_path string")
        found = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(location)
        time = F.col("modificationTime").alias("modified")
        return found.select("path", F.col("length").alias("size"), time, _file_path().alias("file_path"))

    def _reader(self, found: Dataset):
        return self.spark.read.format(found.file_format).option("basePath", found.location)

    # the log

    def _commit_file(self, dataset_id: str, number: int) -> str:
        return f"{self._home(dataset_id)}/commits/{number:012d}.json"

    def _commit(self, dataset_id: str, number: int | None = None) -> Commit:
        """The commit of that number, or the last one; number 0 before the first."""
        if number is None:
            known = [n for n in files.names(self.spark, f"{self._home(dataset_id)}/commits") if n[0].isdigit()]
            if not known:
                return Commit()
            number = max(int(n.removesuffix(".json")) for n in known)
        path = self._commit_file(dataset_id, number)
        if not files.exists(self.spark, path):
            raise KeyError(f"dataset {dataset_id} has no snapshot {number}")
        return Commit.parse(files.read_text(self.spark, path))

    def _state(self, dataset_id: str, commit: Commit) -> DataFrame:
        """An entry for each file of the dataset as of a commit."""
        paths = [f"{self._home(dataset_id)}/{f}" for f in commit.folders]
        if not paths:
            return self.spark.createDataFrame([], commit.entry_schema())
        entries = self.spark.read.schema(commit.entry_schema()).parquet(*paths)
        if len(paths) == 1:  # a whole state, or the first changes
            return entries.where("added")
        # a rewritten file is removed and added in one commit
        last = F.max_by(F.struct(*entries.columns), F.struct("number", "added")).alias("last")
        return entries.groupBy("path").agg(last).select("last.*").where("added")

    # looking up

    def schema(self, dataset_id: str) -> T.StructType:
        return self._commit(dataset_id).struct()

    def snapshots(self, dataset_id: str) -> DataFrame:
        """One row per snapshot, in order, with its number of files and rows."""
        columns = "number bigint, time timestamp, operation string, files bigint, rows bigint"
        return self._commits(dataset_id, columns).orderBy("number")

    def schema_versions(self, dataset_id: str) -> DataFrame:
        """Each schema of the dataset with the first snapshot that has it."""
        commits = self._commits(dataset_id, "number bigint, schema_version bigint, schema string")
        versions = commits.groupBy("schema_version", "schema").agg(F.min("number").alias("number"))
        return versions.orderBy("schema_version")

    def _commits(self, dataset_id: str, columns: str) -> DataFrame:
        self.dataset(dataset_id)
        path = f"{self._home(dataset_id)}/commits"
        if not files.names(self.spark, path):
            return self.spark.createDataFrame([], columns)
        return self.spark.read.schema(columns).json(f"{path}/[0-9]*.json")

    def file_stats(self, dataset_id: str, column: str, snapshot: int | None = None) -> DataFrame:
        """Files of a dataset with the range of one column, in the column's type."""
        commit = self._commit(dataset_id, snapshot)
        state, own = self._state(dataset_id, commit), commit.field_of(column)
        kind = commit.struct()[column].dataType
        part = lambda name, type_: F.col(f"{name}.{own}") if own else F.lit(None).cast(type_)
        unique = f"uniques.u{commit.counted.index(column)}" if column in commit.counted else None
        return state.select(
            "path",
            "size",
            "modified",
            F.col("folder").alias("partition_key"),
            F.col("rows").alias("row_count"),
            part("low", kind).alias("min_value"),
            part("high", kind).alias("max_value"),
            part("nulls", "bigint").alias("null_count"),
            (F.col(unique) if unique else F.lit(None).cast("bigint")).alias("distinct_count"),
        )

    def prune(self, dataset_id: str, column: str, low: object, high: object) -> DataFrame:
        """Files that may hold a value of the column between low and high. What is not known
        of a file keeps it: it has no range, or it is not the file that was registered."""
        stats = self.file_stats(dataset_id, column)
        kind = stats.schema["min_value"].dataType
        now = self._listing(self.dataset(dataset_id).location)
        now = now.select("path", F.col("size").alias("_size"), F.col("modified").alias("_modified"))
        rewritten = (F.col("size") != F.col("_size")) | (F.col("modified") != F.col("_modified"))
        meets = (F.col("max_value") >= F.lit(low).cast(kind)) & (F.col("min_value") <= F.lit(high).cast(kind))
        no_range = F.col("min_value").isNull() & (F.col("null_count") < F.col("row_count"))
        unknown = (F.col("null_count").isNull() & (F.col("row_count") > 0)) | no_range
        kept = F.greatest(*[F.coalesce(c, F.lit(False)) for c in (rewritten, meets, unknown)])
        return stats.join(now, "path", "left").where(kept).drop("_size", "_modified")

    # reading

    def _scan(self, dataset_id: str, commit: Commit, chosen: DataFrame) -> DataFrame:
        """Scan the chosen files; only their names pass through the driver."""
        paths = [r.path for r in chosen.select("path").collect()]
        if not paths:
            return self.spark.createDataFrame([], commit.struct())
        return self._reader(self.dataset(dataset_id)).schema(commit.struct()).load(paths)

    def read(self, dataset_id: str) -> DataFrame:
        commit = self._commit(dataset_id)
        return self._scan(dataset_id, commit, self._state(dataset_id, commit))

    def read_range(self, dataset_id: str, column: str, low: object, high: object) -> DataFrame:
        """Rows with the column between low and high, from the files that may have them."""
        rows = self._scan(dataset_id, self._commit(dataset_id), self.prune(dataset_id, column, low, high))
        type_ = rows.schema[column].dataType
        return rows.where(F.col(column).between(F.lit(low).cast(type_), F.lit(high).cast(type_)))

    def read_snapshot(self, dataset_id: str, number: int) -> DataFrame:
        """The dataset as of a snapshot; a `KeyError` for one that does not exist."""
        self.dataset(dataset_id)
        commit = self._commit(dataset_id, number)
        return self._scan(dataset_id, commit, self._state(dataset_id, commit))


def _file_path() -> Column:
    return F.col("_metadata.file_path")


def _with_columns(commit: Commit, new: T.StructType, ranged: Sequence[str]) -> Commit:
    """The commit with columns and types of new files, and ranges for more columns."""
    fields = {f.name: f for f in commit.struct().fields} | {f.name: f for f in new.fields}
    merged = T.StructType(list(fields.values()))
    pairs = [(c, merged[c].dataType.simpleString()) for c in dict.fromkeys(ranged)]
    changed = json.loads(merged.json()) != json.loads(commit.schema) or not commit.schema_version
    return replace(
        commit,
        schema=merged.json() if changed else commit.schema,
        schema_version=commit.schema_version + changed,
        ranged=tuple(dict.fromkeys([*commit.ranged, *pairs])),
    )


def _entries(
    data: DataFrame, listed: DataFrame, commit: Commit, ranged: Sequence[str], distinct: Sequence[str]
) -> DataFrame:
    """An entry for each of the new files, from one pass over them; files without rows too."""
    measures, fields = [F.count(F.lit(1)).alias("rows")], {}
    for column in dict.fromkeys(ranged):
        at, value = commit.field_of(column), F.col(column)
        fields[at] = column
        measures += [F.min(value).alias(f"low_{at}"), F.max(value).alias(f"high_{at}")]
        measures.append(F.count_if(value.isNull()).alias(f"nulls_{at}"))
    unique = {f"u{commit.counted.index(c)}": c for c in dict.fromkeys(distinct)}
    measures += [F.countDistinct(c).alias(f"uniques_{at}") for at, c in unique.items()]
    per_file = data.groupBy(_file_path().alias("file_path")).agg(*measures)
    folder = F.regexp_extract("file_path", r"((?:[^/=]+=[^/]+/)+)[^/]*$", 1)
    parts = []
    for name in ("low", "high", "nulls"):
        values = [F.col(f"{name}_{at}").alias(at) for at in fields]
        parts += [F.struct(*values).alias(name)] if values else []
    if unique:
        parts.append(F.struct(*[F.col(f"uniques_{at}").alias(at) for at in unique]).alias("uniques"))
    return listed.join(per_file, "file_path", "left").select(
        "path",
        "size",
        "modified",
        F.lit(True).alias("added"),
        F.lit(commit.number).cast("long").alias("number"),
        F.when(folder == "", ALL).otherwise(F.rtrim(folder, F.lit("/"))).alias("folder"),
        F.coalesce("rows", F.lit(0)).alias("rows"),
        *parts,
    )
