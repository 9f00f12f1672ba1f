"""Lookup dimensions as DataFrames, built from the fixed values shipped with the package.

Every one of them has a known, small number of rows (at most 122), so joins may broadcast them.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from medloom.sources import fixed_values as fv

SUSPECTED, CONFIRMED = 159393, 159392

_SCHEMAS = {
    "regimen": "reg_id int, name string, drug1 int, drug2 int, drug3 int, short_name string, reg_group string",
    "drug_lookup": "lookup_id int, drug_number int, concept_id int, name string, label string, "
    "drug_group string, standard_dose string, short_name string",
    "arv_drugs": "drug_id int, drug_name string",
    "arv_status": "id int, name_en string, name_fr string",
    "alert_lookup": "id int, message_en string, message_fr string",
    "vaccine": "id int, vaccine_name string, uuid string",
    "report_type": "id int, name_fr string, name_en string",
    "indicator": "rule_id int, written_type int, answer_concept_id int, answer_uuid string, "
    "certainty int, label string",
}

_TEXTS = {
    "regimen": fv.REGIMENS,
    "drug_lookup": fv.DRUGS,
    "arv_drugs": fv.ARV_DRUGS,
    "arv_status": fv.STATUSES,
    "alert_lookup": fv.ALERTS,
    "vaccine": fv.VACCINES,
    "report_type": fv.REPORT_TYPES,
}


def _cells(text: str) -> list[list[str]]:
    return [[c.strip() for c in line.split(" | ")] for line in (x + " " for x in text.strip().splitlines())]


def _typed(cells: list[str], schema: str) -> tuple:
    kinds = [f.strip().split(" ")[1] for f in schema.split(",")]
    return tuple((int(c) if k == "int" else c) if c else None for c, k in zip(cells, kinds, strict=True))


def indicator_rows() -> list[tuple]:
    """One row per (indicator, answer concept); a uuid answer is resolved later against the dictionary."""
    certainty = {"suspected": SUSPECTED, "confirmed": CONFIRMED, "": None}
    rows = []
    for rule, written, answers, sure, label in _cells(fv.INDICATORS):
        by_uuid = "-" in answers
        for answer in [answers] if by_uuid else answers.split():
            concept, uuid = (None, answer) if by_uuid else (int(answer), None)
            rows.append((int(rule), int(written), concept, uuid, certainty[sure], label))
    return rows


def rows(name: str) -> list[tuple]:
    """The rows of a lookup dimension as plain tuples."""
    if name == "indicator":
        return indicator_rows()
    return [_typed(c, _SCHEMAS[name]) for c in _cells(_TEXTS[name])]


def dimension(spark: SparkSession, name: str) -> DataFrame:
    """A lookup dimension as a DataFrame. `name` is one of `names()`."""
    fields = [f.strip().split(" ") for f in _SCHEMAS[name].split(",")]
    kinds = {"int": pa.int32(), "string": pa.string()}
    columns = {
        n: pa.array(values, kinds[k]) for (n, k), values in zip(fields, zip(*rows(name)), strict=True)
    }
    return spark.createDataFrame(pa.table(columns))


def names() -> list[str]:
    return list(_SCHEMAS)


ARV_DRUG_IDS = [r[0] for r in rows("arv_drugs")]
