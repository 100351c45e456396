"""Parquet tables below one root folder, by layer and name.

A table is a folder of versions and a pointer. Every write makes a folder `_version=...` of its
own; a pointer file then lists the folders that make up the table, whole versions or single
days of them, and the table's schema. Pointers are numbered, and the one with the highest
number counts. So a reader sees the table before a write or after it, however many days the
write replaces, and a failed write leaves only a folder that nothing points to. The folders of
the last pointer but one are kept for readers that hold them; older ones go.

Since the schema is stored, no file is opened to find it: days that lack a column read as NULL.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctual.sources import files

DAY = "departureDate"
NO_DAY = "__HIVE_DEFAULT_PARTITION__"  # Spark's folder for rows without a day
VERSION, POINTERS = "_version", "_pointers"


@dataclass(frozen=True)
class Pointer:
    """The state of a table: its schema and the folders that hold it."""

    number: int = 0
    schema: T.StructType = field(default_factory=T.StructType)
    folders: tuple[str, ...] = ()

    def text(self) -> str:
        return json.dumps({"schema": self.schema.jsonValue(), "folders": self.folders})

    @classmethod
    def parse(cls, number: int, text: str) -> Pointer:
        values = json.loads(text)
        return cls(number, T.StructType.fromJson(values["schema"]), tuple(values["folders"]))


def day_of(folder: str) -> str | None:
    """The day that a folder holds, as text; None for a folder of any days."""
    last = folder.rsplit("/", 1)[-1]
    return last.removeprefix(f"{DAY}=") if last.startswith(f"{DAY}=") else None


def widened(old: T.StructType, new: T.StructType) -> T.StructType:
    """The columns of `old`, then those that only `new` has."""
    known = {f.name: f for f in old.fields}
    for f in new.fields:
        if f.name in known and f.dataType != known[f.name].dataType:
            held, comes = known[f.name].dataType.simpleString(), f.dataType.simpleString()
            raise ValueError(f"column {f.name} is {held} in the table and {comes} in the new rows")
    fields = [*old.fields, *(f for f in new.fields if f.name not in known)]
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in fields])


class Warehouse:
    """Paths and write modes of the bronze, silver and gold tables."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def has(self, layer: str, name: str) -> bool:
        return self.pointer(layer, name).number > 0

    # reading

    def pointer(self, layer: str, name: str) -> Pointer:
        """The current state; number 0 for a table that was never written."""
        folder = f"{self.path(layer, name)}/{POINTERS}"
        numbers = self._numbers(folder)
        if not numbers:
            return Pointer()
        newest = self._pointer_file(folder, numbers[-1])
        if not files.exists(self.spark, newest):  # two writes since the listing
            return self.pointer(layer, name)
        return Pointer.parse(numbers[-1], files.read_text(self.spark, newest))

    def _numbers(self, folder: str) -> list[int]:
        names = files.names(self.spark, folder)
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit())

    @staticmethod
    def _pointer_file(folder: str, number: int) -> str:
        return f"{folder}/{number:012d}.json"

    def read(self, layer: str, name: str) -> DataFrame:
        """The table as of now; a later write does not change what the frame reads."""
        state = self.pointer(layer, name)
        if not state.number:
            raise FileNotFoundError(f"no table {layer}/{name} below {self.root}")
        if not state.folders:
            return self.spark.createDataFrame([], state.schema)
        path = self.path(layer, name)
        reader = self.spark.read.schema(state.schema).option("basePath", path)
        return reader.parquet(*[f"{path}/{f}" for f in state.folders]).select(*state.schema.names)

    read_days = read

    def days(self, layer: str, name: str) -> list[dt.date]:
        """Days of a day-partitioned table, from its pointer."""
        found = {day_of(f) for f in self.pointer(layer, name).folders}
        return sorted(dt.date.fromisoformat(d) for d in found if d not in (None, NO_DAY))

    # writing

    def overwrite(self, df: DataFrame, layer: str, name: str) -> None:
        """Replace the table."""
        before = self.pointer(layer, name)
        self._commit(layer, name, before, df.schema, [self._write(df.write, layer, name)])

    def overwrite_days(self, df: DataFrame, layer: str, name: str) -> None:
        """Replace a day-partitioned table."""
        before = self.pointer(layer, name)
        self._commit(layer, name, before, df.schema, self._write_days(df, layer, name))

    def replace_days(self, df: DataFrame, layer: str, name: str, since: dt.date | None = None) -> list[dt.date]:
        """Replace exactly the days that `df` holds; other days stay, but for days from
        `since` on, which go if `df` does not hold them. All at once; loading the same batch
        twice leaves the same table. Returns the days written, as their folders tell."""
        before = self.pointer(layer, name)
        new = self._write_days(df, layer, name)
        written = {day_of(f) for f in new}

        def stays(folder: str) -> bool:
            day = day_of(folder)
            return day not in written and (since is None or day is None or day == NO_DAY or day < since.isoformat())

        kept = [f for f in before.folders if stays(f)]
        self._commit(layer, name, before, widened(before.schema, df.schema), [*kept, *new])
        return sorted(dt.date.fromisoformat(d) for d in written if d not in (None, NO_DAY))

    def append(self, df: DataFrame, layer: str, name: str) -> None:
        before = self.pointer(layer, name)
        new = self._write(df.write, layer, name)
        self._commit(layer, name, before, widened(before.schema, df.schema), [*before.folders, new])

    def drop_days_before(self, cutoff: dt.date, layer: str, name: str) -> list[dt.date]:
        """Retention: remove the days before `cutoff`."""
        old = [d for d in self.days(layer, name) if d < cutoff]
        self.drop_days(old, layer, name)
        return old

    def drop_days(self, days: Iterable[dt.date], layer: str, name: str) -> None:
        gone = {d.isoformat() for d in days}
        if gone:
            before = self.pointer(layer, name)
            kept = [f for f in before.folders if day_of(f) not in gone]
            self._commit(layer, name, before, before.schema, kept)

    def _write(self, writer, layer: str, name: str) -> str:
        version = f"{VERSION}={uuid.uuid4().hex}"
        target = f"{self.path(layer, name)}/{version}"
        try:
            writer.parquet(target)
        except BaseException:
            files.delete(self.spark, [target])
            raise
        return version

    def _write_days(self, df: DataFrame, layer: str, name: str) -> list[str]:
        # rebalancing keeps files large and splits a day that is too big for one task
        version = self._write(df.hint("rebalance", F.col(DAY)).write.partitionBy(DAY), layer, name)
        days = files.subfolders(self.spark, f"{self.path(layer, name)}/{version}")
        return [f"{version}/{d}" for d in days if d.startswith(f"{DAY}=")]

    def _commit(self, layer: str, name: str, before: Pointer, schema: T.StructType, folders: list[str]) -> None:
        """Point to `folders`; an error if another writer was faster."""
        path = self.path(layer, name)
        after = Pointer(before.number + 1, schema, tuple(folders))
        target = self._pointer_file(f"{path}/{POINTERS}", after.number)
        if not files.write_new(self.spark, target, after.text()):
            raise OSError(f"{layer}/{name} was written by someone else meanwhile")
        self._clean(path, before, after)

    def _clean(self, path: str, before: Pointer, after: Pointer) -> None:
        """Remove what only pointers before `before` list, and those pointers."""
        pointers = f"{path}/{POINTERS}"
        old = [n for n in self._numbers(pointers) if n < before.number]
        kept = {*before.folders, *after.folders}
        gone: set[str] = set()
        for number in old:  # one, unless a writer was stopped here
            state = Pointer.parse(number, files.read_text(self.spark, self._pointer_file(pointers, number)))
            gone |= {f for f in state.folders if f not in kept}
        versions = {f.split("/", 1)[0] for f in kept}
        whole = {f.split("/", 1)[0] for f in gone} - versions
        single = [f for f in gone if f.split("/", 1)[0] not in whole]
        files.delete(self.spark, [f"{path}/{f}" for f in [*whole, *single]])
        files.delete(self.spark, [self._pointer_file(pointers, n) for n in old])
