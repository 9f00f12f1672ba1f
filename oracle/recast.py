"""The driver's tables seen as a medical record.

Customers become patients, orders become visits with one or two encounters each, and each encounter gets
the observations that a form template lists for its type. One SQL text per table serves both engines.
Everything is arithmetic on the order and customer keys, so the record grows with the given tables.
"""

from __future__ import annotations

from medloom.sources.codes import CATALOGUE, Codes
from medloom.sources.dimensions import rows as dimension_rows

AS_OF = "2001-08-01"

# Ids of this record. Types 1 to 16 are the known kinds of encounter, 17 is one no rule knows.
IDS = {
    "encounter_type": {n: i for i, n in enumerate(CATALOGUE["encounter_type"], 1)},
    "concept": {n: 900001 + i for i, n in enumerate(CATALOGUE["concept"])},
    "identifier_type": {n: i for i, n in enumerate(CATALOGUE["identifier_type"], 1)},
    "person_attribute_type": {n: i for i, n in enumerate(CATALOGUE["person_attribute_type"], 1)},
    "location_attribute_type": {n: i for i, n in enumerate(CATALOGUE["location_attribute_type"], 1)},
}
CODES = Codes(IDS)
C = IDS["concept"]
E = IDS["encounter_type"]
# Indicator answers known by uuid, in this record.
UUID_ANSWERS = {r[3]: 910001 + i for i, r in enumerate(r for r in dimension_rows("indicator") if r[3])}

HIV = ["first_hiv", "followup_hiv", "ped_first_hiv", "ped_followup_hiv"]
PRIMARY = ["adult_initial", "adult_followup", "ped_initial", "ped_followup"]
OBGYN = ["obgyn_initial", "obgyn_followup"]
PHARMACY = ["dispensing", "ped_dispensing"]
LINES = [C["first_line"], C["second_line"], C["third_line"]]

_DIAGNOSES = sorted({r[2] for r in dimension_rows("indicator") if r[2]}) + list(UUID_ANSWERS.values())


class _Form:
    """Collects template rows for some encounter types; slots are numbered as questions are added."""

    rows: list[tuple] = []
    slots: dict[int, int] = {}

    def __init__(self, *types: str):
        self.types = [E[t] if t in E else int(t) for t in types]

    def ask(self, concept, codes=(None,), every=2, group=None, date=None, number=None, text=None, header=False):
        """A question present on one of `every` forms, its answer cycling through `codes`.

        date: (first day, spread) after the visit; number: (base, spread); group: slot of the header.
        Returns the slot, to be used as `group` of the answers that belong to it.
        """
        out = None
        for t in self.types:
            slot = _Form.slots.get(t, 0)
            _Form.slots[t] = slot + 1
            out = slot if out is None else out
            assert out == slot and slot < 128, (t, slot, out)
            cycle = every * len(codes)
            d0, dn = date or (None, 1)
            n0, nn = number or (None, 1)
            for i, code in enumerate(codes):
                _Form.rows.append((t, slot, concept, code, group, cycle, i * every, d0, dn, n0, nn, text))
        return out

    def group(self, concept, *members, every=1):
        """A header and its members; members are (concept, kwargs)."""
        head = self.ask(concept, every=every)
        for member, kw in members:
            self.ask(member, group=head, **{"every": 1, **kw})


def _template() -> list[tuple]:
    _Form.rows, _Form.slots = [], {}
    # The forms of one call get the same slots, so each call keeps types with the same history together.
    hiv = _Form(*HIV)
    hiv.ask(5096, date=(20, 120), every=2)
    hiv.ask(1659, (160567, 1662, 1663, 142177, 1660), every=2)
    hiv.ask(159614, (159799, 122496, 113377, 460, 163740), every=2)
    hiv.ask(6042, (159355, 42, 118890, 5042, 116128, 160148, 160155), every=2)
    hiv.ask(6097, (42, 116128, 160148, 159355), every=3)
    hiv.ask(159786, (159791, 160035, 159874, 160031, 160034, 5240, 159492, 5), every=2)
    for concept in (1113, 159431, 163284, 160082, 159599):
        hiv.ask(concept, date=(-60, 200), every=4)
    hiv.ask(C["first_care_date"], date=(-400, 200), every=4)
    hiv.ask(374, (780, 190, 1359, 5279, 163759, 1), every=2)
    hiv.ask(5089, number=(41, 50), every=1)
    hiv.ask(5090, number=(150, 40), every=1)
    hiv.ask(163710, number=(50.5, 40), every=3)
    hiv.ask(160592, (113489, 1), every=4)
    hiv.ask(160749, (1065, 1066), every=4)
    hiv.ask(1061, (163290, 105, 5567, 1), every=2)
    hiv.ask(123160, (1065, 1066), every=3)
    hiv.ask(160579, (1065, 1066), every=3)
    hiv.ask(1941, number=(100, 700), every=2)
    hiv.ask(163544, number=(5, 40), every=3)
    hiv.ask(159936, (5622, 1), every=6)
    hiv.ask(1054, (1057, 5555, 1059), every=2)
    hiv.ask(1542, (1538, 1539), every=2)
    hiv.group(165210, (163258, dict(text="Contact", every=1)), every=3)
    hiv.ask(160704, (1115, 1116, 1117), every=3)
    hiv.ask(1651, (162812, 162810, 163408, 151185), every=3)
    hiv.ask(C["breast_feeding"], (1065,), every=5)
    hiv.ask(C["key_population"], (160578, 160579, 162277, 124275, 105), date=(0, 3), every=3)
    hiv.ask(5632, (1065, 1066), every=4)
    hiv.ask(164432, tuple(LINES), every=3)
    hiv.ask(1592, (1910, 1), every=9)
    hiv.ask(162225, (1434, 1), every=9)
    hiv.ask(1401, (1405, 163717, 664, 1, 2, 3), every=2)
    hiv.ask(163776, (1065, 1066), every=2)
    hiv.ask(5665, (1065, 1066), every=2)
    hiv.ask(1030, (664, 703, 664), every=2)
    hiv.ask(C["genexpert"], (1301, 1302), every=4)
    hiv.ask(307, (1362, 1365, 664), every=4)
    hiv.ask(159984, (162204, 1), every=6)
    hiv.ask(159982, (C["tb_positive_1"], C["tb_positive_2"], 1), every=6)
    hiv.ask(C["ddp"], (1065, 1066), every=9)
    hiv.ask(1667, (127750, 159, 5622, 162591), every=8)
    hiv.ask(5314, number=(1, 5), every=5)
    hiv.group(C["isoniazid_group"], (1282, dict(codes=(78280,))), (159367, dict(codes=(1065, 1065, 1066))), every=2)
    hiv.group(C["rifampicin_group"], (1282, dict(codes=(767,))), (159367, dict(codes=(1065, 1066, 1065))), every=1)
    for group in ("pcr_group_1", "pcr_group_3"):
        hiv.group(
            C[group], (162087, dict(codes=(1030, 1))), (1030, dict(codes=(664, 703, 1138, 5))),
            (163540, dict(number=(1, 20))), (163541, dict(codes=(1072, 1074, 1))),
        )
    for group in ("serology_group_2", "serology_group_6"):
        hiv.group(
            C[group], (162087, dict(codes=(163722, 1042, 1))), (163722, dict(codes=(664, 703))),
            (163540, dict(number=(1, 20))), (163541, dict(codes=(1072, 1074, 1))),
        )

    lab = _Form("lab")
    for test in (856, 1305, 844, 1040, 1042, 1366, 1643):
        lab.ask(1271, (test,), every=1)
    lab.ask(856, number=(0, 2400), every=2)
    lab.ask(856, text="1500 copies", every=7)
    lab.ask(1305, (1301, 1306, 1302), every=2)
    lab.ask(844, (1301, 1302, 1300, 1304, 1), every=2)
    lab.ask(1040, (703, 664), every=2)
    lab.ask(1042, (703, 664), every=2)
    lab.ask(45, (703, 664), every=12)
    lab.ask(160632, text="Labo", every=2)
    lab.ask(C["viral_load_type"], (C["viral_load_targeted"], C["viral_load_routine"], 1), every=2)
    lab.ask(1366, (1365, 664, 1364), every=2)
    lab.ask(1643, (161246, 161248, 161247, 703), every=2)

    stop = _Form("discontinuation")
    stop.ask(161555, (159, 159492, 1667, 5240, 1067, 160415), every=1)
    stop.ask(1667, (115198, 159737, 1754, 160415, 5622, 165439), every=1)
    stop.ask(1667, (115198, 5622, 159737), every=2)

    pharmacy = _Form(*PHARMACY)
    for drugs in (
        (84795, 86663, 70056, 630, 817, 84309), (78643, 75628, 78643, 78280), (165085, 75523, 767, 80586, 159809),
    ):
        pharmacy.group(
            163711, (1282, dict(codes=drugs)), (1276, dict(codes=(None,), every=2)),
            (1444, dict(text="2 fois par jour", every=2)), (159368, dict(number=(20.5, 70), every=2)),
            (1443, dict(number=(30, 60), every=2)),
        )
    for drugs, uses in (((84795, 86663, 70056, 78280, 767), (138405, 163768, 138405)), ((78643, 78280, 630), (138405, 138405, 163768))):
        pharmacy.group(
            1442, (1282, dict(codes=drugs)), (160742, dict(codes=uses)), (1444, dict(text="matin", every=2)),
            (159368, dict(number=(10, 60), every=2)), (C["posology_alt"], dict(text="soir", every=3)),
        )
    pharmacy.ask(162549, date=(30, 240), every=1)
    pharmacy.ask(1755, (1065, 1066), every=2)
    pharmacy.ask(C["ddp"], (1065, 1066), every=3)
    pharmacy.ask(164432, tuple(LINES), every=2)

    primary = _Form(*PRIMARY)
    primary.ask(5089, number=(3, 80), every=2)
    primary.ask(5090, number=(50, 130), every=1)
    primary.ask(159614, (460, 159799, 163740, 122496, 159937), every=2)
    primary.ask(163515, (1115, 164131, 123815, 1), every=2)
    primary.ask(1343, number=(10.5, 20), every=3)
    # Cycles of 13 and 17 answers meet every certainty, whose cycle is 6.
    spare = _DIAGNOSES * 2
    for block in (spare[:13], spare[13:30], spare[30:43]):
        primary.group(
            159947, (1284, dict(codes=tuple(block))), (159394, dict(codes=(159393, 159392, 1), every=2)),
            (159946, dict(codes=(159943, 159944))),
        )
    primary.group(C["tb_group"], (1284, dict(codes=(112141, 1, 112141))), every=2)
    primary.group(C["mdr_tb_group"], (1284, dict(codes=(159345, 1))), every=3)
    primary.group(C["pregnancy_group_4"], (1284, dict(codes=(46, 1, 1449, 2, 3, 4), every=2)), every=2)
    # The basic set is usually complete on a form, so that complete schedules occur.
    for vaccines, dose in (
        ((783,), 1), ((1423, 1423, 781), 1), ((83531,), 1), ((159701, 162586), 1),
        ((783,), 2), ((1423, 1423, 782), 2), ((83531,), 2), ((159701, 886), 2), ((783,), 3), ((1423, 5261), 3),
    ):
        primary.group(
            1421, (984, dict(codes=vaccines)), (1418, dict(number=(dose, 1))), (1410, dict(date=(-30, 30))), every=1
        )
    primary.group(1421, (984, dict(codes=(886, 82215))), (1418, dict(number=(0, 9))), (1410, dict(date=(-30, 30))), every=2)
    primary.ask(1282, (73300, 82521, 83023, 5843), every=2)
    primary.ask(1271, (1366, 1643, 1), every=2)
    primary.ask(1366, (1365, 664, 1364), every=2)
    primary.ask(1643, (161246, 161248, 161247, 703), every=2)
    primary.ask(1272, (5485, 1), every=4)
    primary.ask(160168, (160152, 1), every=4)
    primary.ask(160040, (42, 5042, 111967, 159167, 111946, 115753, 111873, 161355, 5622), every=1)
    primary.ask(163752, (307, 12, 1), every=2)
    primary.ask(1111, (75948, 160093, 1), every=2)
    primary.ask(1169, (1402, 664, 703), every=2)
    primary.ask(1109, (105281, 1), every=2)
    primary.ask(160117, (160119, 1461, 1), every=2)
    for concept in (166136, 166134, 165978, 165999, 165804):
        primary.group(concept, (307, dict(codes=(703, 664, 1))), every=2)
    primary.ask(6042, (42, 159355, 116128), every=5)
    primary.ask(1659, (1662, 1663, 160567), every=5)

    obgyn = _Form(*OBGYN)
    obgyn.ask(1343, number=(20.5, 12), every=2)
    obgyn.ask(160288, (1622, 160456, 1623, 5483), every=2)
    obgyn.ask(5096, date=(20, 90), every=2)
    obgyn.ask(5596, date=(30, 200), every=3)
    obgyn.ask(163764, (1065, 1066), every=3)
    obgyn.ask(160112, (1065, 1066), every=3)
    obgyn.ask(160079, (1107, 148834, 460, 1), every=2)
    obgyn.ask(1438, number=(0, 40), every=3)
    obgyn.ask(1282, (5843, 76613, 78218, 1), every=1)
    obgyn.ask(984, (84879, 886), every=2)
    obgyn.ask(7957, (1589, 1), every=4)
    obgyn.ask(163749, (5141, 5139, 1), every=4)
    obgyn.ask(160090, (160001, 139814, 1), every=4)
    obgyn.ask(163750, (163748, 1), every=4)
    obgyn.ask(163732, (1065,), every=3)
    obgyn.ask(1427, date=(-90, 80), every=3)
    obgyn.ask(5085, number=(110, 30), every=2)
    obgyn.ask(5086, number=(60, 40), every=1)
    obgyn.group(
        159947, (1284, dict(codes=(117399, 142473, 134612))), (159394, dict(codes=(159393, 159392))),
        (159946, dict(codes=(159943, 159944))),
    )

    birth = _Form("labor_delivery")
    birth.ask(1572, (163266, 1501, 1502, 5622, 1), every=1)
    birth.ask(5599, date=(0, 2), every=2)

    imaging = _Form("imaging")
    for concept in (12, 309, 307):
        imaging.ask(concept, (703, 664, 1115), every=2)

    noise = _Form("17")
    noise.ask(999901, (1,), every=1)
    noise.ask(159614, (159799, 163740), every=2)
    noise.ask(1401, (1405,), every=2)
    return list(_Form.rows)


TEMPLATE = _template()


def _value(v) -> str:
    if v is None:
        return "NULL"
    return f"'{v}'" if isinstance(v, str) else str(v)


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(_value(v) for v in r) + ")" for r in rows)


def _dictionary(kind: str, id_col: str) -> str:
    found = [(i, n, CATALOGUE[kind][n]) for n, i in IDS[kind].items()]
    return f"SELECT CAST(a AS BIGINT) AS {id_col}, b AS name, c AS uuid FROM (VALUES {_values(found)}) AS t(a, b, c)"


def _concepts() -> str:
    known = [(i, CATALOGUE["concept"][n]) for n, i in C.items()]
    known += [(i, u) for u, i in UUID_ANSWERS.items()]
    # Vaccine uuids start with the concept id, padded with the letter A.
    known += [(int(r[2].rstrip("A")), r[2]) for r in dimension_rows("vaccine")]
    return f"SELECT CAST(a AS BIGINT) AS concept_id, b AS uuid FROM (VALUES {_values(known)}) AS t(a, b)"


# Columns that are NULL on the first row need a type in both engines.
_CAST = "CAST({0} AS {1})"

TABLES: dict[str, str] = {
    "person": """
        SELECT c_custkey AS person_id, CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
               CASE WHEN c_custkey % 7 = 0 THEN DATE '2000-01-01' + CAST(c_custkey % 700 AS INT)
                    WHEN c_custkey % 7 = 1 THEN DATE '1996-01-01' + CAST(c_custkey % 1400 AS INT)
                    ELSE DATE '1950-01-01' + CAST((c_custkey * 37) % 12000 AS INT) END AS birthdate,
               0 AS voided
        FROM customer""",
    "patient": """
        SELECT c_custkey AS patient_id, TIMESTAMP_AS_OF - INTERVAL '1' DAY * CAST(c_custkey % 40 AS INT) AS date_created,
               0 AS voided
        FROM customer""",
    "person_name": """
        SELECT c_custkey AS person_id, c_mktsegment AS given_name, c_name AS family_name, CAST(c_nationkey AS BIGINT) AS creator,
               TIMESTAMP_AS_OF - INTERVAL '1' DAY * CAST(c_custkey % 40 AS INT) AS date_created,
               CASE WHEN c_custkey % 31 = 0 THEN 1 ELSE 0 END AS voided
        FROM customer
        UNION ALL
        SELECT c_custkey, 'MAIDEN', c_name, CAST(c_nationkey AS BIGINT),
               TIMESTAMP_AS_OF - INTERVAL '1' DAY * CAST(50 + c_custkey % 40 AS INT), 0
        FROM customer""",
    "person_address": """
        SELECT c_custkey AS person_id, CASE WHEN c_custkey % 5 = 0 THEN '' WHEN c_custkey % 5 = 1 THEN NULL ELSE c_name END AS address1,
               CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 4 = 0 THEN '' ELSE c_mktsegment END AS address2, 0 AS voided
        FROM customer""",
    "person_attribute": """
        SELECT c_custkey AS person_id, CAST(1 + c_custkey % 3 AS BIGINT) AS person_attribute_type_id, c_mktsegment AS value, 0 AS voided
        FROM customer
        UNION ALL
        SELECT c_custkey, CAST(1 + (c_custkey + c_nationkey) % 3 AS BIGINT), c_name, 0 FROM customer""",
    "patient_identifier": """
        SELECT c_custkey AS patient_id, c_name AS identifier, CAST(1 + c_custkey % 5 AS BIGINT) AS identifier_type,
               CAST(c_nationkey AS BIGINT) AS location_id, CASE WHEN c_custkey % 11 = 0 THEN 1 ELSE 0 END AS voided
        FROM customer
        UNION ALL
        SELECT c_custkey, c_name, CAST(1 + (c_custkey + 3) % 5 AS BIGINT), CAST(c_nationkey AS BIGINT), 0
        FROM customer""",
    "location": "SELECT CAST(n_nationkey AS BIGINT) AS location_id, n_name AS name FROM nation",
    "location_attribute": """
        SELECT CAST(n_nationkey AS BIGINT) AS location_id, CAST(1 + n_nationkey % 2 AS BIGINT) AS attribute_type_id,
               n_name AS value_reference
        FROM nation""",
    "visit": """
        SELECT o_orderkey AS visit_id, o_custkey AS patient_id, o_orderdate AS date_started,
               o_orderdate + INTERVAL '1' DAY AS date_stopped, o_custkey % 25 AS location_id, o_orderkey % 7 AS creator,
               o_orderdate + INTERVAL '1' HOUR AS date_created,
               CASE WHEN o_orderkey % 20 = 0 THEN 1 WHEN o_orderkey % 97 = 0 THEN NULL ELSE 0 END AS voided
        FROM orders""",
    "encounter": """
        SELECT o_orderkey * 2 + s AS encounter_id,
               CASE WHEN s = 0 THEN o_orderkey % 17 + 1
                    ELSE CAST(floor(o_orderkey / 5) AS BIGINT) % 17 + 1 END AS encounter_type,
               o_custkey AS patient_id, o_custkey % 25 AS location_id, o_orderkey % 9 AS form_id,
               CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate ELSE o_orderdate + INTERVAL '9' HOUR END AS encounter_datetime,
               o_orderkey AS visit_id,
               CASE WHEN o_orderkey % 20 = 0 THEN 1 WHEN (o_orderkey + s) % 89 = 0 THEN NULL ELSE 0 END AS voided,
               CAST(floor(o_orderkey / 17) AS BIGINT) AS form_number, o_orderkey AS k, o_orderdate AS d
        FROM orders JOIN (VALUES (0), (1)) AS t(s) ON s = 0 OR o_orderkey % 3 = 0""",
    "encounter_provider": """
        SELECT o_orderkey * 2 AS encounter_id, o_orderkey % 40 + 1 AS provider_id,
               CASE WHEN o_orderkey % 13 = 0 THEN 1 ELSE 0 END AS voided
        FROM orders
        UNION ALL
        SELECT o_orderkey * 2, o_orderkey % 31 + 1, CASE WHEN o_orderkey % 6 = 0 THEN 0 ELSE 1 END FROM orders""",
    "obs": """
        SELECT encounter_id * 128 + slot AS obs_id, patient_id AS person_id, CAST(concept AS BIGINT) AS concept_id,
               encounter_id, encounter_datetime AS obs_datetime, location_id,
               encounter_id * 128 + grp AS obs_group_id, CAST(code AS BIGINT) AS value_coded,
               CASE WHEN date0 IS NOT NULL THEN d + INTERVAL '1' DAY * CAST(date0 + (k * 13) % daten AS INT) END AS value_datetime,
               CASE WHEN num0 IS NOT NULL THEN CAST(num0 AS DOUBLE) + CAST((k * 7) % numn AS DOUBLE) END AS value_numeric,
               CASE WHEN txt IS NOT NULL THEN txt END AS value_text,
               CASE WHEN k % 4 = 0 THEN 'note' WHEN k % 4 = 1 THEN '' END AS comments,
               CASE WHEN d >= TIMESTAMP_AS_OF - INTERVAL '90' DAY AND k % 4 <> 0 THEN TIMESTAMP_AS_OF + INTERVAL '8' HOUR
                    ELSE d + INTERVAL '10' HOUR END AS date_created,
               CASE WHEN (k + slot) % 29 = 0 THEN 1 WHEN (k + slot) % 83 = 0 THEN NULL ELSE 0 END AS voided
        FROM encounter JOIN form_template ON encounter_type = form AND (form_number + slot) % cyc = pos""",
    "form_template": f"""
        SELECT form, slot, concept, {_CAST.format('code', 'BIGINT')} AS code, {_CAST.format('grp', 'BIGINT')} AS grp, cyc, pos,
               {_CAST.format('date0', 'BIGINT')} AS date0, daten, {_CAST.format('num0', 'DOUBLE')} AS num0, numn,
               {_CAST.format('txt', 'VARCHAR(40)')} AS txt
        FROM (VALUES {_values(TEMPLATE)})
             AS t(form, slot, concept, code, grp, cyc, pos, date0, daten, num0, numn, txt)""",
    "concept": _concepts(),
    "concept_name": """
        SELECT CAST(a AS BIGINT) AS concept_id, b AS locale, c AS name, v AS voided
        FROM (VALUES (856, 'fr', 'Charge virale', 0), (856, 'en', 'Viral load', 0), (1305, 'fr', 'Charge virale qualitative', 0),
              (844, 'fr', 'PCR', 0), (844, 'fr', 'Ancien nom', 1), (1040, 'fr', 'Test VIH', 0)) AS t(a, b, c, v)""",
    "encounter_type": _dictionary("encounter_type", "encounter_type_id"),
    "patient_identifier_type": _dictionary("identifier_type", "patient_identifier_type_id"),
    "person_attribute_type": _dictionary("person_attribute_type", "person_attribute_type_id"),
    "location_attribute_type": _dictionary("location_attribute_type", "location_attribute_type_id"),
    "legacy_status": """
        SELECT c_name AS patientid, 1 + c_custkey % 11 AS patientstatus,
               TIMESTAMP_AS_OF - INTERVAL '1' DAY * CAST(c_custkey % 90 AS INT) AS insertdate
        FROM customer
        UNION ALL
        SELECT c_name, c_custkey % 4, TIMESTAMP_AS_OF - INTERVAL '1' DAY * CAST(c_custkey % 90 AS INT)
        FROM customer""",
}
