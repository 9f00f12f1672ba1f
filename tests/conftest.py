"""Session and a small hand-made record."""

from __future__ import annotations

import datetime as dt

import pytest

from medloom.session import local_session
from medloom.sources.codes import Codes
from medloom.sources.record import RECORD_TABLES, Record
from medloom.sources.schemas import SOURCE_SCHEMAS
from oracle.recast import IDS

CODES = Codes(IDS)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, shuffle_partitions=4, spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


def day(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def frame(spark, table: str, rows: list[dict]):
    names = [f.strip().split(" ")[0] for f in SOURCE_SCHEMAS[table].split(",")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], SOURCE_SCHEMAS[table])


class Chart:
    """Writes a record entry by entry."""

    def __init__(self):
        self.rows = {t: [] for t in RECORD_TABLES}
        self._obs = 0

    def patient(self, pid: int, born="1980-01-01", **kw):
        self.rows["person"].append({"person_id": pid, "gender": "F", "birthdate": dt.date.fromisoformat(born), "voided": 0})
        self.rows["patient"].append({"patient_id": pid, "date_created": day("2000-01-01"), "voided": 0})
        self.rows["person_name"].append(
            {"person_id": pid, "given_name": "A", "family_name": "B", "creator": 1, "date_created": day("2000-01-01"), "voided": 0, **kw}
        )

    def visit(self, vid: int, pid: int, when: str, kind: str, voided=0, encounter_voided=0, location=1, code=None):
        """A visit with one encounter of the same id."""
        self.rows["visit"].append(
            {"visit_id": vid, "patient_id": pid, "date_started": day(when), "location_id": location, "date_created": day(when), "voided": voided}
        )
        self.rows["encounter"].append(
            {"encounter_id": vid, "encounter_type": code or CODES.encounter(kind)[0], "patient_id": pid, "location_id": location,
             "encounter_datetime": day(when), "visit_id": vid, "voided": encounter_voided}
        )

    def obs(self, vid: int, concept: int, coded=None, group=None, when=None, number=None, text=None, at=None, voided=0, created=None, comments=None):
        self._obs += 1
        visit = next(v for v in self.rows["visit"] if v["visit_id"] == vid)
        self.rows["obs"].append(
            {"obs_id": self._obs, "person_id": visit["patient_id"], "concept_id": concept, "encounter_id": vid,
             "obs_datetime": day(at) if at else visit["date_started"], "location_id": visit["location_id"], "obs_group_id": group,
             "value_coded": coded, "value_datetime": day(when) if when else None, "value_numeric": number, "value_text": text,
             "comments": comments, "date_created": day(created) if created else visit["date_started"], "voided": voided}
        )
        return self._obs

    def dispense(self, vid: int, drug: int, next_day: str | None = None, rx: int | None = None, voided=0):
        head = self.obs(vid, 163711)
        self.obs(vid, 1282, drug, group=head, voided=voided)
        self.obs(vid, 1276, group=head)
        if next_day:
            self.obs(vid, 162549, when=next_day)
        if rx:
            order = self.obs(vid, 1442)
            self.obs(vid, 1282, drug, group=order)
            self.obs(vid, 160742, rx, group=order)

    def record(self, spark) -> Record:
        return Record(**{t: frame(spark, t, self.rows[t]) for t in RECORD_TABLES}, codes=CODES)


@pytest.fixture
def chart():
    return Chart()


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())
