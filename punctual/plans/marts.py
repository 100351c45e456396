"""The named tables that reports read, derived on demand or read back from storage."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame

from punctual.plans import gold

FACT, STATIONS = "fact_timetable_events", "dim_stations"

# table name -> function of the fact
ROLLUPS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "daily_performance": gold.daily_performance,
    "hourly_delay_categories": gold.hourly_delay_categories,
    "delay_histogram": gold.delay_histogram,
    "train_spans": gold.train_spans,
    "station_presence": gold.station_presence,
    "pair_station_daily": gold.pair_station_daily,
    "pair_hourly_daily": gold.pair_hourly_daily,
    "timetable_coverage": gold.timetable_coverage,
    "on_time_performance": gold.on_time_performance,
    "pair_comparison": gold.pair_comparison,
}
STATION_ROLLUP = "station_performance"
GOLD_TABLES = [*ROLLUPS, STATION_ROLLUP]


class Marts:
    """`marts[name]` gives the table as a DataFrame; nothing is computed until used."""

    def __init__(self, load: Callable[[str], DataFrame], names: Iterable[str]):
        self._load = load
        self._names = list(names)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(f"no table {name!r}; known: {', '.join(self._names)}")
        return self._load(name)

    @classmethod
    def from_fact(cls, fact: DataFrame, stations: DataFrame | None = None) -> Marts:
        """Derive every roll-up from the fact when a report asks for it."""

        def load(name: str) -> DataFrame:
            if name == FACT:
                return fact
            if name == STATIONS:
                return stations
            if name == STATION_ROLLUP:
                return gold.station_performance(fact, stations)
            return ROLLUPS[name](fact)

        station_tables = [] if stations is None else [STATIONS, STATION_ROLLUP]
        return cls(load, [FACT, *ROLLUPS, *station_tables])

    @classmethod
    def from_tables(cls, read: Callable[[str], DataFrame]) -> Marts:
        """Read every table from storage with `read(name)`."""
        return cls(read, [FACT, STATIONS, *GOLD_TABLES])
