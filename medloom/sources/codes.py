"""Code dictionary: which integer id a site gave to each coded encounter type, concept or attribute.

Records address codes by UUID; the integer ids differ from site to site. `Codes.resolve` looks the
UUIDs up once, in one bounded query (at most one row per UUID listed here), so that every rule can
then filter on plain integer literals, which Spark pushes down to the Parquet scan.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Encounter types.
ENCOUNTER_TYPES = {
    "first_hiv": "17536ba6-dd7c-4f58-8014-08c7cb798ac7",
    "followup_hiv": "204ad066-c5c2-4229-9a62-644bc5617ca2",
    "ped_first_hiv": "349ae0b4-65c1-4122-aa06-480f186c8350",
    "ped_followup_hiv": "33491314-c352-42d0-bd5d-a9d0bffc9bf1",
    "lab": "f037e97b-471e-4898-a07c-b8e169e0ddc4",
    "discontinuation": "9d0113c6-f23a-4461-8428-7e9a7344f2ba",
    "dispensing": "10d73929-54b6-4d18-a647-8b7316bc1ae3",
    "ped_dispensing": "a9392241-109f-4d67-885b-57cc4b8c638f",
    "adult_initial": "12f4d7c3-e047-4455-a607-47a40fe32460",
    "adult_followup": "a5600919-4dde-4eb8-a45b-05c204af8284",
    "ped_initial": "709610ff-5e39-4a47-9c27-a60e740b0944",
    "ped_followup": "fdb5b14f-555f-4282-b4c1-9286addf0aae",
    "obgyn_initial": "5c312603-25c1-4dbe-be18-1a167eb85f97",
    "obgyn_followup": "49592bec-dd22-4b6c-a97f-4dd2af6f2171",
    "labor_delivery": "d95b3540-a39f-4d1e-a301-8ee0e03d5eab",
    "imaging": "a4cab59f-f0ce-46c3-bd76-416db36ec719",
}

# Concepts known by uuid only.
CONCEPTS = {
    "ddp": "c2aacdc8-156e-4527-8934-a8fb94162419",
    "first_care_date": "d9885523-a923-474b-88df-f3294d422c3c",
    "tb_group": "30d2b9eb-0a2f-4b0a-9ae9-31476ec13ed6",
    "mdr_tb_group": "b148cd09-496d-4a97-8cd5-75500f2d684f",
    "posology_alt": "ca8bc9c3-7f97-450a-8f33-e98f776b90e1",
    "pregnancy_group_1": "3fea18d4-88f1-40c1-aadc-41dca3449f9d",
    "pregnancy_group_2": "73da2a29-a035-41b5-8891-717ba99a3081",
    "pregnancy_group_3": "361bd482-59a9-4ee8-80f0-e7e39b1d1827",
    "pregnancy_group_4": "fd7987b1-d551-4451-b8e2-59a998adf1d5",
    "pregnancy_group_5": "ee6c7fd3-6a2f-4af0-8978-e1c5e06a9a62",
    "pregnancy_group_6": "6e639f6c-1b62-41c4-8cfd-fb76b3205313",
    "pregnancy_group_7": "f9d52515-6c56-41b3-881a-1b40f355144c",
    "pregnancy_group_8": "1dfb560d-6627-441e-a8e2-d1517b51c8b4",
    "pregnancy_group_9": "756f00e4-b1b6-40cd-b5ab-d5cce8a571fb",
    "pregnancy_group_10": "22be1344-65f9-4310-9be3-1d300e57820b",
    "pregnancy_group_11": "cb4d6c75-c218-4a26-9046-41e0939e55c4",
    "pcr_group_1": "eaa7f684-1473-4f59-acb4-686bada87846",
    "pcr_group_2": "9a05c0d5-2c03-4c3a-a810-6bc513ae7ee7",
    "pcr_group_3": "535b63e9-0773-4f4e-94af-69ff8f412411",
    "serology_group_1": "28e8ffc8-1b65-484c-baa1-929f0b8901a6",
    "serology_group_2": "6e3aa01c-8a70-42b6-94fe-6ac465b620d9",
    "serology_group_3": "2a66236f-d84b-4cc8-a552-15b12238e7ea",
    "serology_group_4": "121d7ed6-c039-465d-9663-4ab631232ba9",
    "serology_group_5": "ec6e3a54-3e4b-4647-b9bd-baf0d06a98d2",
    "serology_group_6": "99f7b98e-8900-4898-9772-a88f4783babd",
    "breast_feeding": "7e0f24aa-4f8e-42d0-8649-282bc3c867e3",
    "key_population": "b2726cc7-df4b-463c-919d-1c7a600fef87",
    "first_line": "dd69cffe-d7b8-4cf1-bc11-3ac302763d48",
    "second_line": "77488a7b-957f-4ebc-892a-e53e7c910363",
    "third_line": "99d88c3e-00ad-4122-a300-a88ff5c125c9",
    "genexpert": "4cbdc90a-e007-4a48-af54-5dd204edadd9",
    "viral_load_type": "6b41328f-48bc-497c-8977-283feaa9cea6",
    "viral_load_targeted": "5c4fb18a-70f1-4a0b-924c-0b595d7dbb90",
    "viral_load_routine": "71e6fd5c-1544-4c9d-a452-32fdba8efc82",
    "tb_positive_1": "36d6616b-8c7c-4768-9f38-2be4b704fccd",
    "tb_positive_2": "f4ee3bcc-947c-4390-9190-a335c2cd5868",
    "isoniazid_group": "fee8bd39-2a95-47f9-b1f5-3f9e9b3ee959",
    "rifampicin_group": "2b2053bd-37f3-429d-be0b-f1f8952fe55e",
}

# Patient identifier types.
IDENTIFIER_TYPES = {
    "st_code": "d059f6d0-9e42-4760-8de1-8316b48bc5f1",
    "pc_code": "b7a154fd-0097-4071-ac09-af11ee7e0310",
    "national_id": "9fb4533d-4fd5-4276-875b-2ab41597f5dd",
    "main_id": "05a29f94-c0ed-11e2-94be-8c13b969e334",
    "legacy_id": "0e0c7cc2-3491-4675-b705-746e372ff346",
}

# Person attribute types.
PERSON_ATTRIBUTE_TYPES = {
    "birthplace": "8d8718c2-c2cc-11de-8d13-0010c6dffd0f",
    "telephone": "14d4f066-15f5-102d-96e4-000c29c2a5d7",
    "mother_name": "8d871d18-c2cc-11de-8d13-0010c6dffd0f",
}

# Location attribute types.
LOCATION_ATTRIBUTE_TYPES = {"site_code": "0e52924e-4ebb-40ba-9b83-b198b532653b"}

CATALOGUE = {
    "encounter_type": ENCOUNTER_TYPES,
    "concept": CONCEPTS,
    "identifier_type": IDENTIFIER_TYPES,
    "person_attribute_type": PERSON_ATTRIBUTE_TYPES,
    "location_attribute_type": LOCATION_ATTRIBUTE_TYPES,
}


@dataclass(frozen=True)
class Codes:
    """Resolved ids by name. A code the site does not have is absent and never matches."""

    ids: dict[str, dict[str, int]] = field(default_factory=dict)

    def _of(self, kind: str, names: tuple[str, ...]) -> list[int]:
        unknown = [n for n in names if n not in CATALOGUE[kind]]
        if unknown:
            raise KeyError(f"no {kind} code named {unknown}")
        known = self.ids.get(kind, {})
        return [known[n] for n in names if n in known]

    def encounter(self, *names: str) -> list[int]:
        return self._of("encounter_type", names)

    def concept(self, *names: str) -> list[int]:
        return self._of("concept", names)

    def concepts_like(self, prefix: str) -> list[int]:
        return self.concept(*[n for n in CONCEPTS if n.startswith(prefix)])

    def identifier(self, *names: str) -> list[int]:
        return self._of("identifier_type", names)

    def person_attribute(self, *names: str) -> list[int]:
        return self._of("person_attribute_type", names)

    def location_attribute(self, *names: str) -> list[int]:
        return self._of("location_attribute_type", names)

    @staticmethod
    def resolve(**dictionaries: DataFrame) -> "Codes":
        """Look the catalogue up in the site's dictionaries.

        Each keyword is a kind of `CATALOGUE`; each value a DataFrame whose first column is the id and
        which has a `uuid` column. One query; its result has at most one row per catalogued UUID.
        """
        parts = []
        for kind, df in dictionaries.items():
            wanted = list(CATALOGUE[kind].values())
            parts.append(
                df.filter(F.col("uuid").isin(wanted))
                .groupBy(F.lit(kind).alias("kind"), "uuid")
                .agg(F.min(df.columns[0]).cast("long").alias("id"))
            )
        found = reduce(DataFrame.unionByName, parts).collect()
        by_uuid = {(r["kind"], r["uuid"]): r["id"] for r in found}
        return Codes(
            {
                kind: {n: by_uuid[kind, u] for n, u in CATALOGUE[kind].items() if (kind, u) in by_uuid}
                for kind in dictionaries
            }
        )


def is_any(column: str | Column, ids: list[int]) -> Column:
    """`column IN ids`; false when no id is known, so that an unresolved code matches nothing."""
    c = F.col(column) if isinstance(column, str) else column
    return c.isin(list(ids)) if ids else F.lit(False)


def resolve(df: DataFrame, dictionary: DataFrame, uuid_col: str, id_col: str) -> DataFrame:
    """Add `id_col` to a lookup dimension by its UUID. The dimension is small; the dictionary may not be."""
    ids = dictionary.select(
        F.col("uuid").alias(uuid_col), F.col(dictionary.columns[0]).alias(id_col)
    ).join(df.select(uuid_col).distinct(), uuid_col, "left_semi")
    return df.join(ids, uuid_col, "left")
