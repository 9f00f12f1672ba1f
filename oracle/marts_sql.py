"""Reference SQL for DuckDB, one entry per table. Written from the rules, with the engine's own idioms.

Entries may read the record tables and each other by name; `oracle.compose` puts the needed ones in front.
Ties follow one rule everywhere: the latest observation by (obs_datetime, obs_id).
"""

from __future__ import annotations

from oracle.recast import AS_OF, CODES
from medloom.sources.dimensions import ARV_DRUG_IDS, rows as dimension_rows

TODAY = f"DATE '{AS_OF}'"


def c(*names: str) -> str:
    return ", ".join(str(i) for i in CODES.concept(*names))


def like(prefix: str) -> str:
    return ", ".join(str(i) for i in CODES.concepts_like(prefix))


def e(*names: str) -> str:
    return ", ".join(str(i) for i in CODES.encounter(*names))


def last(expr: str, cond: str, order: str = "obs_datetime, obs_id") -> str:
    return f"last({expr} ORDER BY {order}) FILTER (WHERE {cond})"


def flag(cond: str) -> str:
    return f"max(1) FILTER (WHERE {cond})"


def case(col: str, mapping: dict, other: str = "NULL") -> str:
    arms = " ".join(f"WHEN {k} THEN {v!r}" for k, v in mapping.items())
    return f"CASE {col} {arms} ELSE {other} END"


def _span(a: str, b: str) -> str:
    return (
        f"(date_part('year', {b}) * 12 + date_part('month', {b}) - date_part('year', {a}) * 12 - date_part('month', {a}) "
        f"- CASE WHEN date_part('day', {b}) < date_part('day', {a}) THEN 1 ELSE 0 END)"
    )


def months(a: str, b: str) -> str:
    """Whole months from day a to day b; negative when b comes first."""
    return f"CASE WHEN {b} >= {a} THEN {_span(a, b)} ELSE -{_span(b, a)} END"


def months_ts(a: str, b: str) -> str:
    """Whole months from moment a to the start of day b."""
    return f"(date_part('year', {b}) * 12 + date_part('month', {b}) - date_part('year', {a}) * 12 - date_part('month', {a}) - CASE WHEN date_part('day', {b}) < date_part('day', {a}) OR (date_part('day', {b}) = date_part('day', {a}) AND {a}::TIME > TIME '00:00:00') THEN 1 ELSE 0 END)"


def years(a: str, b: str) -> str:
    return f"CAST(trunc(({months(a, b)}) / 12) AS INT)"


def num(col: str) -> str:
    """Leading number of a text, else 0."""
    return f"CASE WHEN {col} IS NULL THEN NULL ELSE coalesce(TRY_CAST(regexp_extract({col}, '^\\s*([+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?)', 1) AS DOUBLE), 0) END"


ARV = ", ".join(str(i) for i in ARV_DRUG_IDS)
Q: dict[str, str] = {}

# ------------------------------------------------------------------------------------------ shared pieces
Q["ctx"] = """
SELECT e.*, v.visit_id IS NOT NULL AS seen, v.patient_id AS vp, v.location_id AS vl, v.date_started AS vd,
       v.date_stopped AS vstop, v.creator AS vcreator, v.date_created AS vcreated, v.voided AS vvoid
FROM encounter e LEFT JOIN visit v USING (visit_id)"""

# Every drug named in a group next to its header; has1: any dispensing detail, has2: any order detail.
Q["drug_rows"] = f"""
SELECT ch.obs_id, ch.person_id, ch.encounter_id, ch.location_id, ch.obs_group_id, ch.value_coded AS drug_id,
       ch.obs_datetime, ch.voided, h.concept_id AS head,
       h.person_id = ch.person_id AND h.encounter_id = ch.encounter_id AS same,
       EXISTS (FROM obs s WHERE s.obs_group_id = ch.obs_group_id AND s.concept_id IN (1444, 159368, 1443, 1276)) AS has1,
       EXISTS (FROM obs s WHERE s.obs_group_id = ch.obs_group_id AND s.concept_id IN (1444, 159368, 1443, 1276, 160742)) AS has2
FROM obs ch JOIN obs h ON h.obs_id = ch.obs_group_id AND h.concept_id IN (163711, 1442)
WHERE ch.concept_id = 1282"""
# Drugs of any group, with or without a known header.
Q["drug_members"] = f"""
SELECT ch.encounter_id, ch.person_id, ch.location_id, ch.value_coded AS drug_id, h.concept_id AS head,
       s.concept_id AS part, s.value_coded, s.value_text, s.value_numeric, s.obs_datetime, s.obs_id
FROM obs ch JOIN obs s USING (obs_group_id)
LEFT JOIN obs h ON h.obs_id = ch.obs_group_id AND h.concept_id IN (163711, 1442)
WHERE ch.concept_id = 1282 AND s.voided = 0 AND s.concept_id IN (1276, 160742, 1444, 159368, {c('posology_alt')})"""
Q["form_facts"] = f"""
SELECT encounter_id, {last('value_datetime::DATE', 'concept_id = 162549')} AS next_dispensation_date,
       {flag('concept_id = 1755 AND value_coded = 1065')} AS community,
       {flag(f"concept_id IN ({c('ddp')}) AND value_coded = 1065")} * 1065 AS ddp
FROM obs WHERE voided = 0 GROUP BY encounter_id"""
Q["handed_amounts"] = f"""
SELECT h.encounter_id, last(s.value_numeric ORDER BY s.obs_datetime, s.obs_id) FILTER (WHERE s.concept_id = 159368) AS days,
       last(s.value_numeric ORDER BY s.obs_datetime, s.obs_id) FILTER (WHERE s.concept_id = 1443) AS pills
FROM obs s JOIN obs h ON h.obs_id = s.obs_group_id AND h.concept_id = 163711 AND h.encounter_id = s.encounter_id
WHERE s.voided = 0 AND s.concept_id IN (159368, 1443) GROUP BY h.encounter_id"""

# ---------------------------------------------------------------------------------------------- people
Q["location_mart"] = f"""
SELECT location_id, any_value(name) AS name, max(value_reference) AS site_code
FROM location JOIN location_attribute USING (location_id)
WHERE attribute_type_id = {CODES.location_attribute('site_code')[0]} GROUP BY location_id"""

_ident = {n: CODES.identifier(n)[0] for n in ("st_code", "pc_code", "national_id", "main_id", "legacy_id")}
_attr = {n: CODES.person_attribute(n)[0] for n in ("birthplace", "telephone", "mother_name")}
Q["hiv_pos"] = f"""
SELECT patient_id FROM encounter WHERE voided = 0 AND encounter_type IN ({e('first_hiv', 'followup_hiv', 'ped_first_hiv', 'ped_followup_hiv')})
UNION
SELECT patient_id FROM encounter n WHERE voided = 0 AND encounter_type = {e('lab')} AND EXISTS (
  FROM obs o WHERE o.encounter_id = n.encounter_id AND o.person_id = n.patient_id AND o.voided = 0
  AND o.concept_id IN (1040, 1042) AND o.value_coded = 703)"""
Q["patient_mart"] = f"""
WITH nm AS (SELECT * FROM person_name QUALIFY row_number() OVER (PARTITION BY person_id ORDER BY date_created DESC, given_name DESC) = 1),
ids AS (SELECT patient_id, max(identifier) FILTER (WHERE identifier_type = {_ident['st_code']} AND voided = 0) AS st_id,
   max(identifier) FILTER (WHERE identifier_type = {_ident['pc_code']} AND voided = 0) AS pc_id,
   max(identifier) FILTER (WHERE identifier_type = {_ident['national_id']}) AS national_id,
   max(identifier) FILTER (WHERE identifier_type = {_ident['main_id']}) AS identifier,
   max(identifier) FILTER (WHERE identifier_type = {_ident['legacy_id']}) AS legacy_id,
   max(location_id) FILTER (WHERE identifier_type = {_ident['main_id']}) AS location_id
   FROM patient_identifier GROUP BY ALL),
att AS (SELECT person_id, max(value) FILTER (WHERE person_attribute_type_id = {_attr['birthplace']}) AS place_of_birth,
   max(value) FILTER (WHERE person_attribute_type_id = {_attr['telephone']}) AS telephone,
   max(value) FILTER (WHERE person_attribute_type_id = {_attr['mother_name']}) AS mother_name
   FROM person_attribute GROUP BY ALL),
adr AS (SELECT person_id, max(CASE WHEN coalesce(address1, '') = '' THEN address2
   WHEN coalesce(address2, '') = '' THEN address1 ELSE address1 || ' ' || address2 END) AS last_address FROM person_address GROUP BY ALL),
ob AS (SELECT person_id, {last('value_coded', 'concept_id = 1054')} AS marital_status,
   {last('value_coded', 'concept_id = 1542')} AS occupation,
   max(value_datetime::DATE) FILTER (WHERE concept_id IN (5096, 162549) AND voided = 0) AS next_visit_date,
   {flag('concept_id = 159936 AND value_coded = 5622')} AS transferred_in,
   {last('value_datetime::DATE', f"concept_id = {c('first_care_date')} AND value_datetime IS NOT NULL")} AS date_transferred_in,
   {last('value_datetime::DATE', 'concept_id = 159599 AND value_datetime IS NOT NULL')} AS date_started_arv_other_site
   FROM obs GROUP BY person_id),
ct AS (SELECT o.person_id, last(o.value_text ORDER BY o.obs_datetime, o.obs_id) AS contact_name FROM obs o
   JOIN obs h ON h.obs_id = o.obs_group_id AND h.person_id = o.person_id AND h.concept_id = 165210
   WHERE o.concept_id = 163258 AND o.value_text <> '' GROUP BY 1),
vs AS (SELECT patient_id, min(date_started) AS a, max(date_started) AS z FROM visit GROUP BY 1),
arv AS (SELECT person_id, min(obs_datetime) AS date_started_arv FROM drug_rows
   WHERE head = 163711 AND has1 AND voided = 0 AND drug_id IN ({ARV}) GROUP BY 1)
SELECT p.patient_id, ids.identifier, st_id, pc_id, national_id, legacy_id, ids.location_id, lm.site_code, nm.given_name, nm.family_name,
  pe.gender, pe.birthdate, telephone, last_address, mother_name, contact_name, occupation, marital_status, place_of_birth,
  nm.creator, nm.date_created::DATE AS date_created,
  CASE WHEN EXISTS (FROM visit v WHERE v.patient_id = p.patient_id AND v.voided = 0 AND v.date_started = vs.a) THEN vs.a END AS first_visit_date,
  CASE WHEN EXISTS (FROM visit v WHERE v.patient_id = p.patient_id AND v.voided = 0 AND v.date_started = vs.z) THEN vs.z END AS last_visit_date,
  next_visit_date, date_started_arv, transferred_in, date_transferred_in, date_started_arv_other_site,
  CASE WHEN p.patient_id IN (FROM hiv_pos) THEN 1 ELSE 0 END AS vih_status, nm.voided
FROM patient p JOIN person pe ON pe.person_id = p.patient_id JOIN nm ON nm.person_id = p.patient_id
LEFT JOIN ids ON ids.patient_id = p.patient_id LEFT JOIN att ON att.person_id = p.patient_id
LEFT JOIN adr ON adr.person_id = p.patient_id LEFT JOIN ob ON ob.person_id = p.patient_id
LEFT JOIN ct ON ct.person_id = p.patient_id LEFT JOIN vs ON vs.patient_id = p.patient_id
LEFT JOIN arv ON arv.person_id = p.patient_id LEFT JOIN location_mart lm ON lm.location_id = ids.location_id"""
Q["patient_visit"] = f"""
SELECT vp AS patient_id, x.encounter_id, vl AS location_id, visit_id, vd::DATE AS visit_date, vd::DATE AS start_date,
  vstop::DATE AS stop_date, vcreator AS creator, encounter_type, form_id, o.value_datetime::DATE AS next_visit_date, vvoid AS voided
FROM ctx x JOIN obs o ON o.encounter_id = x.encounter_id AND o.person_id = x.patient_id AND o.concept_id = 5096 AND o.voided = 0
WHERE seen AND vp = x.patient_id
QUALIFY row_number() OVER (PARTITION BY vp, x.encounter_id, vl ORDER BY o.obs_datetime DESC, o.obs_id DESC) = 1"""

# -------------------------------------------------------------------------------------------- pharmacy
Q["line_of_form"] = f"""
SELECT encounter_id, person_id, {case("last(value_coded ORDER BY obs_datetime, obs_id)", dict(zip(CODES.concept('first_line', 'second_line', 'third_line'), ('FIRST_LINE', 'SECOND_LINE', 'THIRD_LINE'))))} AS line
FROM obs WHERE concept_id = 164432 AND value_coded IN ({c('first_line', 'second_line', 'third_line')}) GROUP BY ALL"""
Q["presc_spine"] = """
SELECT encounter_id, location_id, drug_id, first(person_id ORDER BY obs_id) AS patient_id,
  coalesce(max(obs_id) FILTER (WHERE hand), max(obs_id)) AS obs_id,
  CASE WHEN bool_or(hand) THEN last(obs_group_id ORDER BY obs_id) FILTER (WHERE hand) ELSE last(obs_group_id ORDER BY obs_id) END AS obs_group_id,
  CASE WHEN bool_or(hand) THEN last(voided ORDER BY obs_id) FILTER (WHERE hand) ELSE last(voided ORDER BY obs_id) END AS voided,
  CASE WHEN bool_or(hand) THEN 1065 ELSE first(CASE WHEN head = 163711 THEN 1065 ELSE 1066 END ORDER BY obs_id) END AS dispense,
  last(detail::DATE ORDER BY obs_id) FILTER (WHERE hand) AS detail_day
FROM (SELECT d.*, head = 163711 AND has1 AS hand,
        (SELECT last(s.obs_datetime ORDER BY s.obs_datetime, s.obs_id) FROM obs s WHERE s.obs_group_id = d.obs_group_id
           AND s.concept_id IN (1444, 159368, 1443, 1276)) AS detail FROM drug_rows d WHERE same AND has2)
GROUP BY ALL"""
Q["removed_groups"] = """
SELECT p.obs_group_id FROM presc_spine p JOIN obs o ON o.encounter_id = p.encounter_id AND o.obs_group_id = p.obs_group_id AND o.voided = 0
GROUP BY 1 HAVING count(*) <= 1"""
Q["patient_prescription"] = f"""
WITH det AS (SELECT encounter_id, drug_id, {last('value_coded', 'part = 160742 AND head = 1442')} AS rx_or_prophy,
   {last('value_text', 'part = 1444 AND head = 1442')} AS posology,
   {last('value_text', f"part = {c('posology_alt')} AND head = 1442")} AS posology_alt,
   {last('value_text', 'part = 1444 AND head = 163711')} AS posology_alt_disp,
   {last('value_numeric', 'part = 159368 AND head IS NOT NULL')} AS number_day,
   {last('obs_datetime::DATE', 'part = 1276 AND head = 163711')} AS handed FROM drug_members GROUP BY ALL),
pr AS (SELECT encounter_id, max(provider_id) AS provider_id FROM encounter_provider GROUP BY 1)
SELECT s.patient_id, s.encounter_id, s.location_id, CASE WHEN x.seen THEN x.visit_id END AS visit_id, x.vd AS visit_date, s.obs_id, s.obs_group_id, provider_id, s.drug_id,
  coalesce(handed, detail_day) AS dispensation_date, next_dispensation_date, CASE WHEN community = 1 THEN 1755 ELSE 0 END AS dispensation_location,
  CASE WHEN s.drug_id IN ({ARV}) THEN 1065 ELSE 1066 END AS arv_drug, dispense, rx_or_prophy, posology, posology_alt, posology_alt_disp,
  number_day, CAST(round(days) AS INT) AS number_day_dispense, pills AS pills_amount_dispense,
  CASE WHEN s.voided <> 1 AND s.obs_group_id IN (FROM removed_groups) THEN 1 ELSE s.voided END AS voided
FROM presc_spine s LEFT JOIN det USING (encounter_id, drug_id) LEFT JOIN form_facts USING (encounter_id)
LEFT JOIN handed_amounts USING (encounter_id) LEFT JOIN pr USING (encounter_id) LEFT JOIN ctx x USING (encounter_id)"""
Q["patient_dispensing"] = f"""
WITH sp AS (SELECT encounter_id, location_id, drug_id, first(person_id ORDER BY d.obs_id) AS patient_id, max(d.obs_id) AS obs_id,
    last(obs_group_id ORDER BY d.obs_id) AS obs_group_id, last(voided ORDER BY d.obs_id) AS voided,
    last((SELECT last(s.obs_datetime::DATE ORDER BY s.obs_datetime, s.obs_id) FROM obs s WHERE s.obs_group_id = d.obs_group_id
       AND s.concept_id IN (1444, 159368, 1443, 1276)) ORDER BY d.obs_id) AS detail_day
  FROM drug_rows d WHERE same AND has1 AND head = 163711 GROUP BY ALL),
hd AS (SELECT ch.encounter_id, ch.value_coded AS drug_id, last(s.obs_datetime::DATE ORDER BY s.obs_datetime, s.obs_id) AS handed
  FROM obs ch JOIN obs s USING (obs_group_id) JOIN obs h ON h.obs_id = ch.obs_group_id AND h.concept_id IN (163711, 1442)
  WHERE ch.concept_id = 1282 AND s.concept_id = 1276 AND s.voided = 0 GROUP BY ALL),
rx AS (SELECT encounter_id, drug_id, person_id AS patient_id, location_id, {last('value_coded', 'part = 160742 AND head = 1442')} AS rx_or_prophy
  FROM drug_members GROUP BY ALL),
pr AS (SELECT encounter_id, max(provider_id) AS provider_id FROM encounter_provider WHERE voided = 0 GROUP BY 1)
SELECT sp.patient_id, sp.encounter_id, sp.location_id, CASE WHEN x.seen THEN x.visit_id END AS visit_id, x.vd AS visit_date, sp.obs_id, sp.obs_group_id, provider_id, sp.drug_id,
  CAST(round(days) AS INT) AS dose_day, pills AS pills_amount, coalesce(handed, detail_day) AS dispensation_date, next_dispensation_date,
  CASE WHEN community = 1 THEN 1755 ELSE 0 END AS dispensation_location, CASE WHEN sp.drug_id IN ({ARV}) THEN 1065 ELSE 1066 END AS arv_drug,
  ddp, rx_or_prophy, CASE WHEN sp.drug_id IN ({ARV}) THEN line END AS treatment_regime_lines,
  CASE WHEN sp.voided <> 1 AND sp.obs_group_id IN (FROM removed_groups) THEN 1 ELSE sp.voided END AS voided
FROM sp LEFT JOIN hd USING (encounter_id, drug_id) LEFT JOIN rx USING (encounter_id, drug_id, patient_id, location_id)
LEFT JOIN form_facts USING (encounter_id) LEFT JOIN handed_amounts USING (encounter_id) LEFT JOIN pr USING (encounter_id)
LEFT JOIN ctx x ON x.encounter_id = sp.encounter_id
LEFT JOIN line_of_form l ON l.encounter_id = sp.encounter_id AND l.person_id = sp.patient_id"""
Q["patient_on_arv"] = """
SELECT patient_id, arg_max(visit_id, (-epoch(visit_date::DATE::TIMESTAMP), visit_id)) AS visit_id, min(visit_date::DATE) AS visit_date
FROM patient_dispensing WHERE arv_drug = 1065 AND voided <> 1 AND coalesce(rx_or_prophy, 138405) = 138405 GROUP BY 1"""

# ------------------------------------------------------------------------------------------ laboratory
_NUMBER_TEXT = "CASE WHEN value_numeric = floor(value_numeric) THEN CAST(CAST(value_numeric AS BIGINT) AS VARCHAR) ELSE CAST(value_numeric AS VARCHAR) END"
Q["lab_orders"] = f"""
SELECT patient_id, encounter_id, test_id, first(location_id ORDER BY step, obs_id) AS location_id, last(voided ORDER BY step, obs_id) AS voided
FROM (SELECT o.person_id AS patient_id, o.encounter_id, value_coded AS test_id, o.location_id, o.voided, 1 AS step, obs_id
      FROM obs o JOIN encounter n USING (encounter_id) WHERE n.encounter_type = {e('lab')} AND concept_id = 1271
      UNION ALL
      SELECT o.person_id, o.encounter_id, concept_id, o.location_id, o.voided, 2, obs_id
      FROM obs o JOIN encounter n USING (encounter_id) WHERE n.encounter_type IN ({e('first_hiv', 'ped_first_hiv')}) AND concept_id IN (1941, 163544))
GROUP BY ALL"""
Q["patient_laboratory"] = f"""
WITH res AS (SELECT encounter_id, concept_id AS test_id, coalesce(CAST(value_coded AS VARCHAR), {_NUMBER_TEXT}, value_text) AS test_result,
   obs_datetime::DATE AS date_test_done, comments AS comment_test_done
   FROM obs WHERE voided = 0 AND (value_coded IS NOT NULL OR value_numeric IS NOT NULL OR value_text IS NOT NULL)
   QUALIFY row_number() OVER (PARTITION BY encounter_id, concept_id ORDER BY obs_datetime DESC, obs_id DESC) = 1),
pr AS (SELECT encounter_id, max(provider_id) AS provider_id FROM encounter_provider WHERE voided = 0 GROUP BY 1),
dest AS (SELECT encounter_id, last(value_text ORDER BY obs_datetime, obs_id) AS order_destination FROM obs WHERE concept_id = 160632 AND voided = 0 GROUP BY 1),
kind AS (SELECT encounter_id, person_id AS patient_id, last(value_coded ORDER BY obs_datetime, obs_id) AS load_kind FROM obs
   WHERE concept_id = {c('viral_load_type')} AND value_coded IN ({c('viral_load_routine', 'viral_load_targeted')}) GROUP BY ALL),
nm AS (SELECT concept_id AS test_id, max(name) AS test_name FROM concept_name WHERE locale = 'fr' AND voided = 0 GROUP BY 1)
SELECT l.patient_id, l.encounter_id, l.test_id, l.location_id, CASE WHEN x.vvoid = 0 THEN x.visit_id END AS visit_id,
  CASE WHEN x.vvoid = 0 THEN x.vd END AS visit_date, CASE WHEN x.vvoid = 0 THEN x.vcreated END AS creation_date, provider_id,
  CASE WHEN res.encounter_id IS NULL THEN 0 ELSE 1 END AS test_done, test_result, date_test_done, comment_test_done, order_destination, test_name,
  CASE WHEN l.test_id IN (856, 1305) THEN CASE WHEN load_kind = {c('viral_load_targeted')} THEN 2 ELSE 1 END END AS viral_load_target_or_routine, l.voided
FROM lab_orders l LEFT JOIN res USING (encounter_id, test_id) LEFT JOIN pr USING (encounter_id) LEFT JOIN dest USING (encounter_id)
LEFT JOIN kind USING (encounter_id, patient_id) LEFT JOIN nm USING (test_id) LEFT JOIN ctx x ON x.encounter_id = l.encounter_id"""


def _grouped_tests(headers: str, answers: str, result: int, live_forms: bool) -> str:
    form = "AND n.voided = 0" if live_forms else ""
    return f"""
WITH t AS (SELECT o.encounter_id, o.location_id, o.obs_group_id, o.concept_id AS test_id, first(o.person_id ORDER BY o.obs_id) AS patient_id,
   first(h.concept_id ORDER BY o.obs_id) AS concept_group, first(o.value_coded ORDER BY o.obs_id) AS answer_concept_id, last(o.voided ORDER BY o.obs_id) AS voided
   FROM obs o JOIN obs h ON h.obs_id = o.obs_group_id AND h.person_id = o.person_id AND h.encounter_id = o.encounter_id AND h.concept_id IN ({headers})
   WHERE o.concept_id = 162087 AND o.value_coded IN ({answers}) GROUP BY ALL),
g AS (SELECT obs_group_id, {last('value_coded', f'concept_id = {result}')} AS test_result,
   CAST(round({last('value_numeric', 'concept_id = 163540')}) AS INT) AS age, {last('value_coded', 'concept_id = 163541')} AS age_unit
   FROM obs WHERE voided = 0 AND obs_group_id IS NOT NULL GROUP BY 1),
j AS (SELECT t.*, n.encounter_datetime::DATE AS encounter_date, g.test_result, g.age, g.age_unit, p.birthdate AS b, p.person_id IS NOT NULL AS known
   FROM t LEFT JOIN g USING (obs_group_id) LEFT JOIN encounter n ON n.encounter_id = t.encounter_id AND n.location_id = t.location_id {form}
   LEFT JOIN (SELECT * FROM person WHERE person_id IN (SELECT patient_id FROM patient)) p ON p.person_id = t.patient_id)
SELECT patient_id, encounter_id, location_id, encounter_date, concept_group, obs_group_id, test_id, answer_concept_id, test_result, age, age_unit,
  CASE WHEN NOT known THEN NULL WHEN age_unit = 1072 AND b + age < {TODAY} THEN b + age
       WHEN age_unit = 1074 AND (b + to_months(age))::DATE < {TODAY} THEN (b + to_months(age))::DATE ELSE encounter_date END AS test_date, voided
FROM j"""


Q["virological_tests"] = _grouped_tests(like("pcr_group_"), "1030", 1030, True)
Q["serological_tests"] = _grouped_tests(like("serology_group_"), "163722, 1042", 163722, False)
Q["patient_pcr"] = f"""
SELECT DISTINCT patient_id, encounter_id, location_id, visit_date::DATE AS visit_date, CAST({num('test_result')} AS BIGINT) AS pcr_result, date_test_done AS test_date
FROM patient_laboratory WHERE test_id = 844 AND test_done = 1 AND {num('test_result')} IN (1300, 1301, 1302, 1304)
UNION ALL
SELECT DISTINCT patient_id, encounter_id, location_id, encounter_date, test_result, test_date FROM virological_tests WHERE test_result IN (664, 703, 1138)"""

# -------------------------------------------------------------------------------------------- clinical
_TB_EVAL = "160265, 1659, 1110, 163283, 162320, 163284, 1633, 1389, 163951, 159431, 1113, 159798, 159398"
Q["health_qual_patient_visit"] = f"""
WITH o AS (SELECT o.*, x.visit_id FROM obs o JOIN ctx x ON x.encounter_id = o.encounter_id AND x.patient_id = o.person_id AND x.seen AND x.vp = x.patient_id WHERE o.voided = 0),
v AS (SELECT visit_id, {last('value_numeric', 'concept_id = 5089')} AS w, {last('value_numeric', 'concept_id = 5090')} AS h,
   {last('value_numeric', 'concept_id = 163710 AND value_numeric IS NOT NULL')} AS adh,
   coalesce({flag('concept_id = 374 AND value_coded IS NOT NULL')}, 0) AS fp, coalesce({flag(f'concept_id IN ({_TB_EVAL}) AND value_coded IS NOT NULL')}, 0) AS tb
   FROM o GROUP BY 1),
f AS (SELECT encounter_id, coalesce({flag('concept_id IN (5314, 1343)')}, 0) AS nutr,
   coalesce({flag('(concept_id = 160592 AND value_coded = 113489) OR (concept_id = 160749 AND value_coded = 1065)')}, 0) AS act FROM o GROUP BY 1)
SELECT vp AS patient_id, x.encounter_id, vl AS location_id, x.visit_id, vd::DATE AS visit_date, encounter_type, w / (h * h / 10000) AS patient_bmi,
  CAST(round(adh) AS INT) AS adherence_evaluation, fp AS family_planning_method_used, tb AS evaluated_of_tb, nutr AS nutritional_assessment_completed,
  act AS is_active_tb, {years('birthdate', 'vd::DATE')} AS age_in_years, vvoid AS voided
FROM ctx x JOIN f USING (encounter_id) JOIN v ON v.visit_id = x.visit_id LEFT JOIN person p ON p.person_id = x.patient_id"""
Q["health_qual_intended"] = Q["health_qual_patient_visit"].replace(
    f"coalesce({flag('concept_id IN (5314, 1343)')}, 0) AS nutr",
    "CASE WHEN bool_or(concept_id IN (5314, 1343)) OR (bool_or(concept_id = 5089) AND bool_or(concept_id = 5090)) THEN 1 ELSE 0 END AS nutr",
)

_KIND = "42, 159355, 118890, 5042"
_tb_class = {
    "tb_class_pulmonary": 42, "tb_class_extrapulmonary": 5042, "tb_extra_meningitis": 111967, "tb_extra_genital": 159167,
    "tb_extra_pleural": 111946, "tb_extra_miliary": 115753, "tb_extra_gangliponic": 111873, "tb_extra_intestinal": 161355, "tb_extra_other": 5622,
}
_tb_month = {"mon_0": 166136, "mon_2": 166134, "mon_3": 165978, "mon_5": 165999, "end": 165804}
Q["patient_tb_diagnosis"] = f"""
WITH src AS (
  SELECT o.*, 1 AS step FROM obs o JOIN obs h ON h.obs_id = o.obs_group_id AND h.person_id = o.person_id AND h.encounter_id = o.encounter_id
    AND h.concept_id IN ({c('tb_group', 'mdr_tb_group')}) WHERE o.concept_id = 1284 AND o.value_coded IN (112141, 159345)
  UNION ALL SELECT *, 2 FROM obs WHERE concept_id = 1659 AND value_coded IN (160567, 1662, 1663)
  UNION ALL SELECT *, 3 FROM obs WHERE concept_id = 159614 AND value_coded = 159799
  UNION ALL SELECT *, 4 FROM obs WHERE concept_id = 159786 AND value_coded IN (159791, 160035, 159874, 160031, 160034)
  UNION ALL SELECT *, 5 FROM obs WHERE concept_id IN (6042, 6097) AND value_coded IN ({_KIND})),
sp AS (SELECT encounter_id, location_id, first(person_id ORDER BY step, obs_id) AS patient_id, last(voided ORDER BY step, obs_id) AS voided FROM src GROUP BY ALL),
grp AS (SELECT o.encounter_id, max(1) FILTER (WHERE h.concept_id = {c('tb_group')} AND o.value_coded = 112141) AS tb_diag,
   max(1) FILTER (WHERE h.concept_id = {c('mdr_tb_group')} AND o.value_coded = 159345) AS mdr_tb_diag
   FROM obs o JOIN obs h ON h.obs_id = o.obs_group_id WHERE o.concept_id = 1284 AND o.voided = 0 GROUP BY 1),
ctl AS (SELECT o.encounter_id, {', '.join(f"max(CASE o.value_coded WHEN 703 THEN 1 WHEN 664 THEN 2 END) FILTER (WHERE h.concept_id = {i}) AS tb_test_result_{n}" for n, i in _tb_month.items())}
   FROM obs o JOIN obs h ON h.obs_id = o.obs_group_id WHERE o.concept_id = 307 GROUP BY 1),
pastvoid AS (SELECT DISTINCT encounter_id FROM obs WHERE concept_id = 6042 AND value_coded IN (42, 159355, 118890)),
f AS (SELECT encounter_id, {flag('concept_id IN (6042, 6097) AND value_coded = 42')} AS tb_pulmonaire,
   {flag('concept_id IN (6042, 6097) AND value_coded = 159355')} AS tb_multiresistante,
   {flag('concept_id IN (6042, 6097) AND value_coded IN (118890, 5042)')} AS tb_extrapul_ou_diss,
   {flag('concept_id = 1659 AND value_coded = 160567')} AS tb_new_diag, {flag('concept_id = 1659 AND value_coded = 1662')} AS tb_follow_up_diag,
   {flag('concept_id = 159614 AND value_coded = 159799')} AS cough_for_2wks_or_more, {flag('concept_id = 159614 AND value_coded = 122496')} AS dyspnea,
   {last('value_datetime::DATE', 'concept_id = 1113')} AS tb_treatment_start_date, {last('value_datetime::DATE', 'concept_id = 159431')} AS tb_treatment_stop_date,
   {flag('concept_id = 1113 AND value_datetime IS NOT NULL')} AS started,
   {flag('concept_id = 163752 AND value_coded = 307')} AS tb_diag_sputum, {flag('concept_id = 163752 AND value_coded = 12')} AS tb_diag_xray,
   {flag('concept_id = 1111 AND value_coded IN (75948, 160093, 160096, 160095, 160092, 84360, 163753, 160094, 82900)')} AS tb_medication_provided,
   max(CASE value_coded WHEN 703 THEN 4 WHEN 664 THEN 2 END) FILTER (WHERE concept_id = 1169) AS tb_hiv_test_result,
   {flag('concept_id = 1109 AND value_coded = 105281')} AS tb_prophy_cotrimoxazole,
   max(CASE WHEN value_coded = 160119 THEN 1 ELSE 2 END) FILTER (WHERE concept_id = 160117 AND value_coded IN (160119, 1461)) AS on_arv,
   {', '.join(f"{flag(f'concept_id = 160040 AND value_coded = {i}')} AS {n}" for n, i in _tb_class.items())},
   count(*) FILTER (WHERE concept_id = 1659) AS n1659, max(CASE value_coded WHEN 1663 THEN 2 WHEN 1662 THEN 6 END) FILTER (WHERE concept_id = 1659) AS s1659,
   count(*) FILTER (WHERE concept_id = 6042 AND value_coded IN (42, 159355, 118890)) AS nact, count(*) FILTER (WHERE concept_id = 6097 AND value_coded IN ({_KIND})) AS ncure,
   count(*) FILTER (WHERE value_coded IN ({_KIND})) AS nkind, count(*) FILTER (WHERE concept_id = 6042 AND value_coded IN ({_KIND})) AS npres,
   count(*) FILTER (WHERE concept_id = 159786) AS nout,
   max(CASE value_coded WHEN 159791 THEN 1 WHEN 160035 THEN 2 WHEN 159874 THEN 4 WHEN 5240 THEN 8 WHEN 160031 THEN 8 WHEN 160034 THEN 5 WHEN 159492 THEN 16 END) FILTER (WHERE concept_id = 159786) AS sout
   FROM obs WHERE voided = 0 GROUP BY 1),
pr AS (SELECT encounter_id, max(provider_id) AS provider_id FROM encounter_provider WHERE voided = 0 GROUP BY 1)
SELECT sp.patient_id, sp.encounter_id, sp.location_id, CASE WHEN x.vvoid = 0 THEN x.visit_id END AS visit_id, CASE WHEN x.vvoid = 0 THEN x.vd END AS visit_date,
  CASE WHEN x.voided = 0 THEN x.encounter_type END AS encounter_type_id, provider_id, tb_diag, mdr_tb_diag, tb_new_diag, tb_follow_up_diag, cough_for_2wks_or_more, dyspnea,
  tb_diag_sputum, tb_diag_xray, {', '.join(f'tb_test_result_{n}' for n in _tb_month)}, {', '.join(_tb_class)},
  CASE WHEN x.vvoid = 0 THEN {years('p.birthdate', 'x.vd::DATE')} END AS age_at_visit_years,
  CASE WHEN x.vvoid = 0 THEN {months('p.birthdate', 'x.vd::DATE')} END AS age_at_visit_months,
  tb_pulmonaire, tb_multiresistante, tb_extrapul_ou_diss, tb_treatment_start_date, coalesce(started, dyspnea) AS tb_started_treatment, tb_medication_provided,
  CASE WHEN n1659 > 0 THEN s1659 WHEN nact > 0 THEN 6 WHEN ncure > 0 THEN 1
       WHEN nkind > 0 AND sp.encounter_id IN (FROM pastvoid) THEN CASE WHEN npres > 0 THEN 6 END
       WHEN nout > 0 THEN sout ELSE 0 END AS status_tb_treatment,
  tb_hiv_test_result, tb_prophy_cotrimoxazole, on_arv, tb_treatment_stop_date, sp.voided
FROM sp LEFT JOIN f USING (encounter_id) LEFT JOIN grp USING (encounter_id) LEFT JOIN ctl USING (encounter_id) LEFT JOIN pr USING (encounter_id)
LEFT JOIN ctx x ON x.encounter_id = sp.encounter_id LEFT JOIN person p ON p.person_id = sp.patient_id"""

_FORM = "n.patient_id, n.encounter_type AS encounter_type_id, n.encounter_id, n.location_id, n.visit_id, n.encounter_datetime::DATE AS visit_date"
Q["patient_nutrition"] = f"""
WITH f AS (SELECT encounter_id, {last('value_numeric', 'concept_id = 5089')} AS weight, {last('value_numeric', 'concept_id = 5090')} AS height,
   max(CASE WHEN concept_id = 159614 AND value_coded = 460 THEN 1 ELSE 0 END) AS edema,
   max(CASE value_coded WHEN 1115 THEN 1 WHEN 164131 THEN 2 WHEN 123815 THEN 2 END) FILTER (WHERE concept_id = 163515) AS weight_for_height FROM obs WHERE voided = 0 GROUP BY 1),
j AS (SELECT {_FORM}, n.voided, f.* EXCLUDE (encounter_id), f.encounter_id IS NOT NULL AS answered, p.birthdate AS b FROM encounter n
   LEFT JOIN f USING (encounter_id) LEFT JOIN person p ON p.person_id = n.patient_id
   WHERE n.encounter_type IN ({e('adult_initial', 'adult_followup', 'ped_initial', 'ped_followup')})),
a AS (SELECT *, CASE WHEN answered THEN {months('b', 'visit_date')} END AS m FROM j)
SELECT patient_id, encounter_type_id, encounter_id, location_id, visit_id, visit_date, CAST(trunc(m / 12) AS INT) AS age_at_visit_years, m AS age_at_visit_months,
  weight, height, CASE WHEN trunc(m / 12) >= 20 AND voided = 0 THEN round(weight / (height / 100 * height / 100), 1) END AS bmi, edema, weight_for_height, voided
FROM a"""
Q["patient_ob_gyn"] = f"""
WITH f AS (SELECT encounter_id, CAST(round({last('value_numeric', 'concept_id = 1343')}) AS INT) AS muac, {flag('concept_id = 160288 AND value_coded = 1622')} AS pregnant,
   {last('value_datetime::DATE', 'concept_id = 5096')} AS next_visit_date, {last('value_datetime::DATE', 'concept_id = 5596')} AS edd,
   {flag('concept_id IN (163764, 161007, 160112, 163765, 163766) AND value_coded = 1065')} AS birth_plan,
   {flag('concept_id = 160079 AND value_coded IN (1107, 145777, 148834, 119476, 460, 1053, 163119, 163120)')} AS high_risk,
   {flag('concept_id = 1438 AND value_numeric >= 12')} AS gestation_greater_than_12_wks, {flag('concept_id = 1282 AND value_coded = 5843')} AS iron_supplement,
   {flag('concept_id = 1282 AND value_coded = 76613')} AS folic_acid_supplement, {flag('concept_id = 1282 AND value_coded = 78218')} AS prescribed_iron,
   {flag('concept_id = 984 AND value_coded = 84879')} AS tetanus_toxoid_vaccine, {flag('concept_id = 160079 AND value_coded = 148834')} AS iron_defiency_anemia
   FROM obs WHERE voided = 0 GROUP BY 1)
SELECT {_FORM}, f.* EXCLUDE (encounter_id), folic_acid_supplement AS prescribed_folic_acid, NULL::INT AS elevated_blood_pressure, n.voided
FROM encounter n LEFT JOIN f USING (encounter_id) WHERE n.encounter_type IN ({e('obgyn_initial', 'obgyn_followup')})"""
Q["ob_gyn_intended"] = Q["patient_ob_gyn"].replace(
    "NULL::INT AS elevated_blood_pressure",
    "CASE WHEN EXISTS (FROM obs s WHERE s.encounter_id = n.encounter_id AND s.voided = 0 AND s.concept_id = 5085 AND s.value_numeric BETWEEN 120 AND 129) "
    "AND EXISTS (FROM obs s WHERE s.encounter_id = n.encounter_id AND s.voided = 0 AND s.concept_id = 5086 AND s.value_numeric < 80) THEN 1 END AS elevated_blood_pressure",
)
Q["patient_imagerie"] = f"""
SELECT first(o.person_id ORDER BY obs_id) AS patient_id, o.location_id, x.visit_id, o.encounter_id, x.vd AS visit_date,
  CASE WHEN count(*) FILTER (WHERE concept_id = 12 AND o.voided = 0) = 0 THEN 0 ELSE {last('value_coded', 'concept_id = 12 AND o.voided = 0')} END AS radiographie_pul,
  {last('value_coded', 'concept_id = 309 AND o.voided = 0')} AS radiographie_autre, {last('value_coded', 'concept_id = 307 AND o.voided = 0')} AS crachat_barr, x.vvoid AS voided
FROM obs o JOIN ctx x USING (encounter_id) WHERE x.seen AND x.encounter_type = {e('imaging')} AND concept_id IN (12, 309, 307)
GROUP BY o.location_id, x.visit_id, o.encounter_id, x.vd, x.vvoid"""
_mal = {
    "fever_for_less_than_2wks": "voided = 0 AND concept_id = 159614 AND value_coded = 163740",
    "suspected_malaria": "concept_id = 6042 OR (concept_id = 6097 AND value_coded = 116128 AND voided = 0)",
    "confirmed_malaria": "voided = 0 AND concept_id IN (6042, 6097) AND value_coded = 160148",
    "treated_with_chloroquine": "voided = 0 AND concept_id = 1282 AND value_coded = 73300",
    "treated_with_primaquine": "voided = 0 AND concept_id = 1282 AND value_coded = 82521",
    "treated_with_quinine": "voided = 0 AND concept_id = 1282 AND value_coded = 83023",
    "microscopic_test": "voided = 0 AND concept_id = 1271 AND value_coded = 1366",
    "positive_microscopic_test_result": "voided = 0 AND concept_id = 1366 AND value_coded IN (1362, 1363, 1364, 1365)",
    "negative_microscopic_test_result": "voided = 0 AND concept_id = 1366 AND value_coded = 664",
    "positive_plasmodium_falciparum_test_result": "voided = 0 AND concept_id = 1643 AND value_coded = 161246",
    "mixed_positive_test_result": "voided = 0 AND concept_id = 1643 AND value_coded = 161248",
    "positive_plasmodium_vivax_test_result": "voided = 0 AND concept_id = 1643 AND value_coded = 161247",
    "rapid_test": "voided = 0 AND concept_id = 1271 AND value_coded = 1643",
    "positve_rapid_test_result": "voided = 0 AND concept_id = 1643 AND value_coded = 703",
    "severe_malaria": "voided = 0 AND concept_id = 6042 AND value_coded = 160155",
    "hospitallized": "voided = 0 AND concept_id = 1272 AND value_coded = 5485",
    "confirmed_malaria_preganancy": "voided = 0 AND concept_id = 160168 AND value_coded = 160152",
}
Q["patient_malaria"] = f"""
WITH n AS (SELECT * FROM encounter WHERE encounter_type IN ({e('adult_initial', 'adult_followup', 'ped_initial', 'ped_followup', 'obgyn_initial', 'obgyn_followup', 'first_hiv', 'followup_hiv', 'ped_first_hiv', 'lab')})
  QUALIFY row_number() OVER (PARTITION BY patient_id ORDER BY encounter_datetime DESC, encounter_id DESC) = 1),
f AS (SELECT encounter_id, {', '.join(f'{flag(k)} AS {n}' for n, k in _mal.items())} FROM obs GROUP BY 1)
SELECT {_FORM}, {', '.join(_mal)}, n.voided FROM n LEFT JOIN f USING (encounter_id)"""
Q["visit_type"] = """
SELECT first(o.person_id ORDER BY obs_id) AS patient_id, o.encounter_id, o.location_id, any_value(n.visit_id) AS visit_id, concept_id, value_coded AS v_type,
  any_value(n.encounter_datetime)::DATE AS encounter_date, last(o.voided ORDER BY obs_id) AS voided
FROM obs o JOIN encounter n USING (encounter_id) WHERE concept_id = 160288 AND value_coded IN (160456, 1622, 1623, 5483)
GROUP BY o.encounter_id, o.location_id, concept_id, value_coded"""


def _form_mart(types: str, concepts: str, extra: str, codes: str = "", key: str = "o.person_id") -> str:
    return f"""
SELECT {key + ' AS patient_id' if key == 'o.person_id' else 'first(o.person_id ORDER BY obs_id) AS patient_id'}, o.encounter_id, o.location_id, {extra},
  any_value(n.encounter_datetime)::DATE AS encounter_date, last(o.voided ORDER BY obs_id) AS voided
FROM obs o JOIN encounter n USING (encounter_id) WHERE n.encounter_type IN ({types}) AND concept_id IN ({concepts}) {codes}
GROUP BY o.encounter_id, o.location_id{', o.person_id' if key == 'o.person_id' else ''}"""


def _sub(col: str, concept: int) -> str:
    return (
        f"(SELECT last(s.{col} ORDER BY s.obs_datetime, s.obs_id) FROM obs s WHERE s.encounter_id = o.encounter_id "
        f"AND s.location_id = o.location_id AND s.concept_id = {concept} AND s.voided = 0)"
    )


Q["patient_delivery"] = _form_mart(
    e("labor_delivery"), "1572", f"last(value_coded ORDER BY obs_id) AS delivery_location, {_sub('value_datetime', 5599)} AS delivery_date",
    "AND value_coded IN (163266, 1501, 1502, 5622)", key="",
)
Q["pediatric_hiv_visit"] = _form_mart(
    e("ped_first_hiv", "ped_followup_hiv"), "163776, 5665, 1401",
    f"{_sub('value_coded', 163776)} AS ptme, {_sub('value_coded', 5665)} AS prophylaxie72h, {_sub('value_coded', 1401)} AS actual_vih_status",
)
Q["patient_menstruation"] = _form_mart(
    e("obgyn_initial", "obgyn_followup"), "163732, 160597, 1427", f"{_sub('value_datetime', 1427)}::DATE AS ddr"
)
Q["vih_risk_factor"] = f"""
SELECT person_id AS patient_id, encounter_id, location_id, f AS risk_factor, any_value(d) AS encounter_date, last(voided ORDER BY step, obs_id) AS voided
FROM (SELECT o.person_id, o.encounter_id, o.location_id, CASE WHEN concept_id IN (1061, 160581) THEN value_coded ELSE concept_id END AS f,
        n.encounter_datetime::DATE AS d, o.voided, CASE WHEN concept_id IN (1061, 160581) THEN 1 ELSE 2 END AS step, obs_id
      FROM obs o JOIN encounter n USING (encounter_id) WHERE n.encounter_type IN ({e('first_hiv', 'ped_first_hiv')})
      AND ((concept_id IN (1061, 160581) AND value_coded IN (163290, 163291, 105, 1063, 163273, 163274, 163289, 163275, 5567, 159218))
        OR (concept_id IN (123160, 156660, 163276, 163278, 160579, 160580) AND value_coded = 1065)))
GROUP BY ALL"""
Q["key_populations"] = f"""
SELECT person_id AS patient_id, encounter_id, value_coded AS key_population, voided, first(location_id ORDER BY obs_id) AS location_id,
  first(value_datetime ORDER BY obs_id) AS encounter_date
FROM obs WHERE concept_id = {c('key_population')} AND value_coded IS NOT NULL AND voided IS NOT NULL GROUP BY ALL"""
_PLAN = {780: "PILLS", 190: "CONDOM", 1359: "IMPLANTS", 5279: "INJECT", 163759: "NECKLACE"}
Q["family_planning"] = f"""
WITH m AS (SELECT person_id AS patient_id, encounter_id, first(location_id ORDER BY obs_id) AS location_id, value_coded AS planning,
  first(obs_datetime ORDER BY obs_id) AS encounter_date, voided FROM obs WHERE concept_id = 374 AND voided = 0 AND value_coded IN ({', '.join(map(str, _PLAN))}) GROUP BY person_id, encounter_id, value_coded, voided)
SELECT *, {case('planning', _PLAN)} AS family_planning_method_name,
  CASE WHEN encounter_date::DATE = min(encounter_date) OVER (PARTITION BY patient_id)::DATE THEN 1 ELSE 2 END AS accepting_or_using_fp FROM m"""
