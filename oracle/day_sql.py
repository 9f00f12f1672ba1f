"""Reference SQL for the incremental run."""

from __future__ import annotations

import re

from oracle.marts_sql import ARV, Q, TODAY, e
from oracle.rules_sql import _best


def today_only(text: str) -> str:
    """The same statement over today's observations."""
    for name in ("obs", "drug_rows", "drug_members", "patient_prescription", "patient_laboratory", "stop_answers"):
        text = re.sub(rf"\b{name}\b", {"patient_prescription": "prescription_day", "patient_laboratory": "lab_day"}.get(name, f"{name}_day"), text)
    return text


Q["obs_day"] = f"SELECT * FROM obs WHERE date_created::DATE = {TODAY}"
Q["high_water_day"] = "SELECT max(obs_id) AS obs_id FROM obs_day"
Q["drug_rows_day"] = today_only(Q["drug_rows"])
Q["drug_members_day"] = today_only(Q["drug_members"])
Q["patients_day"] = f"""
WITH nm AS (SELECT * FROM person_name WHERE person_id IN (SELECT patient_id FROM patient WHERE date_created::DATE = {TODAY})
  QUALIFY row_number() OVER (PARTITION BY person_id ORDER BY date_created DESC, given_name DESC) = 1),
m AS (SELECT p.* REPLACE (CASE WHEN nm.person_id IS NULL THEN p.given_name ELSE nm.given_name END AS given_name,
   CASE WHEN nm.person_id IS NULL THEN p.family_name ELSE nm.family_name END AS family_name,
   CASE WHEN nm.person_id IS NULL THEN p.creator ELSE nm.creator END AS creator,
   CASE WHEN nm.person_id IS NULL THEN p.date_created ELSE nm.date_created::DATE END AS date_created,
   CASE WHEN nm.person_id IS NULL THEN p.voided ELSE nm.voided END AS voided) FROM patient_mart p LEFT JOIN nm ON nm.person_id = p.patient_id)
SELECT * REPLACE (CASE WHEN date_created = {TODAY} AND patient_id IN (SELECT patient_id FROM encounter WHERE voided = 0
   AND encounter_type IN ({e('first_hiv', 'followup_hiv', 'ped_first_hiv', 'ped_followup_hiv')})) THEN 1 ELSE vih_status END AS vih_status) FROM m"""
_RX = "last(value_coded ORDER BY obs_datetime, obs_id) FILTER (WHERE part = 160742 AND head = 1442)"
_ARV = f"CASE WHEN s.drug_id IN ({ARV}) THEN 1065 ELSE 1066 END AS arv_drug"
Q["dispensing_day"] = f"""
WITH s AS (SELECT encounter_id, location_id, drug_id, first(person_id ORDER BY d.obs_id) AS patient_id, last(voided ORDER BY d.obs_id) AS voided,
    last((SELECT last(z.obs_datetime::DATE ORDER BY z.obs_datetime, z.obs_id) FROM obs_day z WHERE z.obs_group_id = d.obs_group_id
       AND z.concept_id IN (1444, 159368, 1443, 1276)) ORDER BY d.obs_id) AS dispensation_date FROM drug_rows_day d WHERE same AND has1 AND head = 163711 GROUP BY ALL),
rx AS (SELECT encounter_id, drug_id, person_id AS patient_id, location_id, {_RX} AS rx_or_prophy FROM drug_members_day GROUP BY ALL),
nx AS (SELECT encounter_id, last(value_datetime::DATE ORDER BY obs_datetime, obs_id) AS next_dispensation_date FROM obs_day WHERE concept_id = 162549 AND voided = 0 GROUP BY 1)
SELECT s.patient_id, s.encounter_id, s.location_id, x.visit_id, x.vd AS visit_date, s.drug_id, dispensation_date, next_dispensation_date, {_ARV}, rx_or_prophy, s.voided
FROM s LEFT JOIN rx USING (encounter_id, drug_id, patient_id, location_id) LEFT JOIN nx USING (encounter_id) LEFT JOIN ctx x ON x.encounter_id = s.encounter_id"""
Q["presc_spine_day"] = today_only(Q["presc_spine"])
Q["prescription_day"] = f"""
WITH rx AS (SELECT encounter_id, drug_id, {_RX} AS rx_or_prophy FROM drug_members_day GROUP BY ALL)
SELECT s.patient_id, s.encounter_id, s.location_id, x.visit_id, x.vd AS visit_date, s.drug_id, detail_day AS dispensation_date, {_ARV}, dispense, rx_or_prophy, s.voided
FROM presc_spine_day s LEFT JOIN rx USING (encounter_id, drug_id) LEFT JOIN ctx x ON x.encounter_id = s.encounter_id"""
_NUMBER_TEXT = "CASE WHEN value_numeric = floor(value_numeric) THEN CAST(CAST(value_numeric AS BIGINT) AS VARCHAR) ELSE CAST(value_numeric AS VARCHAR) END"
Q["lab_day"] = f"""
WITH n AS (SELECT o.person_id AS patient_id, o.encounter_id, value_coded AS test_id, first(o.location_id ORDER BY obs_id) AS location_id, last(o.voided ORDER BY obs_id) AS voided
   FROM obs_day o JOIN encounter en USING (encounter_id) WHERE en.encounter_type = {e('lab')} AND concept_id = 1271 GROUP BY ALL),
r AS (SELECT encounter_id, concept_id AS test_id, CASE WHEN value_coded <> 0 THEN CAST(value_coded AS VARCHAR) WHEN value_numeric <> 0 THEN {_NUMBER_TEXT}
   WHEN value_text <> '' THEN value_text END AS v, obs_datetime::DATE AS d, comments AS k FROM obs_day WHERE voided = 0
   QUALIFY row_number() OVER (PARTITION BY encounter_id, concept_id ORDER BY obs_datetime DESC, obs_id DESC) = 1),
m AS (SELECT patient_id, encounter_id, test_id, CASE WHEN o.patient_id IS NULL THEN n.location_id ELSE o.location_id END AS location_id,
   CASE WHEN o.patient_id IS NULL THEN CASE WHEN x.vvoid = 0 THEN x.visit_id END ELSE o.visit_id END AS visit_id,
   CASE WHEN o.patient_id IS NULL THEN CASE WHEN x.vvoid = 0 THEN x.vd END ELSE o.visit_date END AS visit_date,
   o.creation_date, o.provider_id, o.order_destination, o.test_name, o.viral_load_target_or_routine, coalesce(o.test_done, 0) AS test_done, o.test_result, o.date_test_done, o.comment_test_done, CASE WHEN n.patient_id IS NULL THEN o.voided ELSE n.voided END AS voided
   FROM patient_laboratory o FULL JOIN n USING (patient_id, encounter_id, test_id) LEFT JOIN ctx x USING (encounter_id))
SELECT m.* REPLACE (CASE WHEN r.encounter_id IS NULL THEN test_done ELSE 1 END AS test_done, CASE WHEN r.encounter_id IS NULL THEN test_result ELSE r.v END AS test_result,
  CASE WHEN r.encounter_id IS NULL THEN date_test_done ELSE r.d END AS date_test_done, CASE WHEN r.encounter_id IS NULL THEN comment_test_done ELSE r.k END AS comment_test_done)
FROM m LEFT JOIN r USING (encounter_id, test_id)"""
# Today's tests were already part of the full load, so merging them again changes nothing.
Q["virology_day"] = "SELECT * FROM virological_tests"
Q["infants_infected_day"] = today_only(Q["infants_infected"]).replace("obs_day o JOIN", "obs o JOIN").replace(
    "obs_day o JOIN (SELECT * FROM encounter", "obs o JOIN (SELECT * FROM encounter"
)
_ANY = "encounter n USING (encounter_id)"
_LIVE = "(SELECT * FROM encounter WHERE voided <> 1) n USING (encounter_id)"
_head, _tail = Q["infants_infected_day"].rsplit("UNION", 1)
Q["infants_infected_day"] = _head + "UNION" + _tail.replace(_LIVE, _ANY)
Q["infants_day"] = f"""
SELECT * FROM (
  SELECT * FROM infant_candidates WHERE condition <> 4
  UNION ALL
  SELECT DISTINCT patient_id, location_id, encounter_id, visit_date::DATE, 4 FROM (
    SELECT *, max(visit_date) OVER (PARTITION BY patient_id) AS latest FROM patient_dispensing WHERE voided <> 1 AND arv_drug = 1065)
  WHERE visit_date = latest AND rx_or_prophy = 163768)
WHERE patient_id NOT IN (FROM infants_infected_day)
UNION ALL
SELECT DISTINCT o.person_id, o.location_id, o.encounter_id, n.encounter_datetime::DATE, 5 FROM obs o JOIN {_ANY}
WHERE n.encounter_type = {e('discontinuation')} AND concept_id = 1667 AND value_coded = 165439 AND o.voided <> 1"""
Q["stop_answers_any"] = Q["stop_answers"].replace("x.voided <> 1 AND ", "")
Q["stop_answers_day"] = re.sub(r"\bobs\b", "obs_day", Q["stop_answers"])
Q["day_left_before"] = (
    Q["status_left_before"].replace("FROM stop_answers s", "FROM stop_answers_any s").replace("vih_status = 1 AND voided = 0", "vih_status = 1").replace("patient_mart", "patients_day")
)
Q["day_refill"] = _best(f"""
SELECT d.patient_id, CASE WHEN {TODAY} <= nd THEN 6 WHEN {TODAY} - nd <= 30 THEN 8 ELSE 9 END AS id_status, visit_date::DATE AS start_date, encounter_id
FROM (SELECT *, next_dispensation_date AS nd FROM dispensing_day) d
WHERE nd = (SELECT max(next_dispensation_date) FROM dispensing_day m WHERE m.patient_id = d.patient_id AND m.voided <> 1 AND m.arv_drug = 1065)
AND (arv_drug = 1065 OR {TODAY} - nd BETWEEN 1 AND 30) AND (d.patient_id IN (SELECT patient_id FROM patients_day) OR {TODAY} - nd > 30)
AND EXISTS (FROM encounter n WHERE n.visit_id = d.visit_id AND n.encounter_type IN ({e('dispensing', 'ped_dispensing')})
  AND n.patient_id NOT IN (SELECT patient_id FROM discontinuation_reason WHERE reason IN (159, 1667, 159492))
  AND (NOT {TODAY} - nd BETWEEN 1 AND 30 OR n.patient_id IN (SELECT patient_id FROM patient_on_arv)))""")
Q["day_before"] = Q["status_before"].replace("seen AND voided <> 1 AND vvoid <> 1", "seen").replace("patient_mart", "patients_day")
Q["day_left_on"] = re.sub(r"\bobs z\b", "obs_day z", Q["status_left_on"].replace("stop_answers s", "stop_answers_day s"))
Q["statuses_day"] = f"""
WITH u AS (FROM day_left_before UNION ALL FROM day_refill UNION ALL FROM day_before UNION ALL FROM day_left_on)
SELECT u.*, (SELECT arg_min(reason, (visit_date, reason)) FROM discontinuation_reason r WHERE r.patient_id = u.patient_id AND r.visit_date >= u.start_date) AS dis_reason,
  {TODAY} AS date_started_status FROM u WHERE patient_id NOT IN (SELECT patient_id FROM infants_day)"""
Q["history_day"] = """
SELECT s.* FROM statuses s WHERE NOT EXISTS (FROM statuses_day n WHERE n.patient_id = s.patient_id AND n.id_status = s.id_status
  AND n.start_date = s.start_date AND n.date_started_status = s.date_started_status)
UNION ALL
SELECT * FROM statuses_day QUALIFY row_number() OVER (PARTITION BY patient_id
  ORDER BY list_position([4, 5, 6, 8, 9, 10, 7, 11, 1, 2, 3], id_status) DESC, start_date DESC) = 1"""
Q["regimen_hits_day"] = Q["regimen_hits"].replace("patient_prescription", "prescription_day").replace("patient_mart", "patients_day")
Q["fresh_regimens_day"] = Q["regimens"].replace("regimen_hits", "regimen_hits_day")
Q["regimens_day"] = """
SELECT location_id, patient_id, visit_date, regimen, CASE WHEN n.patient_id IS NULL THEN o.rx_or_prophy ELSE n.rx_or_prophy END AS rx_or_prophy
FROM regimens o FULL JOIN fresh_regimens_day n USING (location_id, patient_id, visit_date, regimen)"""
