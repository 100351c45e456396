"""Rows and files that tests are built from."""

import datetime as dt
import gzip
import json
from pathlib import Path


def event(**values):
    """An event row; actual time follows from scheduled time and delay unless given."""
    scheduled = values.pop("at", dt.datetime(2024, 1, 3, 12))
    delay = values.pop("delay", 0)
    row = {
        "trainNumber": 1,
        "departureDate": scheduled.date(),
        "trainType": "IC",
        "trainCategory": "Long-distance",
        "stationShortCode": "HKI",
        "event_type": "ARRIVAL",
        "commercial_stop": True,
        "scheduled_time": scheduled,
        "actual_time": scheduled + dt.timedelta(minutes=delay or 0),
        "delay_minutes": delay,
    }
    return row | values


def timetable_row(station, kind, scheduled, delay=0, **values):
    text = lambda t: t.strftime("%Y-%m-%dT%H:%M:%S.") + f"{t.microsecond // 1000:03d}Z"
    row = {
        "stationShortCode": station,
        "stationUICCode": 1,
        "type": kind,
        "commercialStop": True,
        "trainStopping": True,
        "cancelled": False,
        "scheduledTime": text(scheduled),
    }
    if delay is not None:
        row |= {"actualTime": text(scheduled + dt.timedelta(minutes=delay)), "differenceInMinutes": delay}
    return row | values


def train(number, day, rows, **values):
    return {
        "trainNumber": number,
        "departureDate": day.isoformat(),
        "operatorUICCode": 10,
        "operatorShortCode": "vr",
        "trainType": "IC",
        "trainCategory": "Long-distance",
        "cancelled": False,
        "version": 1,
        "timeTableRows": rows,
    } | values


STATIONS = [
    {
        "stationShortCode": code,
        "stationName": name,
        "stationUICCode": i,
        "latitude": 60.0 + i,
        "longitude": 24.0,
        "passengerTraffic": code != "XXX",
        "type": kind,
        "countryCode": "FI",
    }
    for i, (code, name, kind) in enumerate(
        [
            ("HKI", "Helsinki", "STATION"),
            ("TPE", "Tampere", "STATION"),
            ("JY", "Jyväskylä", "STOPPING_POINT"),
            ("XXX", "Somewhere", "TURNOUT_IN_THE_OPEN_LINE"),
        ],
        start=1,
    )
]


class Staging:
    """Writes raw input files."""

    def __init__(self, root: Path):
        self.root = root
        (root / "stations").mkdir(parents=True)
        (root / "stations" / "stations.json").write_text(json.dumps(STATIONS), encoding="utf-8")

    def path(self, day, suffix=".json"):
        folder = self.root / "train_departure_date" / f"{day:%Y}" / f"{day:%m}"
        folder.mkdir(parents=True, exist_ok=True)
        return folder / f"{day.isoformat()}{suffix}"

    def write(self, day, trains, compress=False):
        text = json.dumps(trains, ensure_ascii=False)
        if compress:
            with gzip.open(self.path(day, ".json.gz"), "wt", encoding="utf-8") as out:
                out.write(text)
        else:
            self.path(day).write_text(text, encoding="utf-8")
