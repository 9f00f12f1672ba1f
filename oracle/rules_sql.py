"""Reference SQL for the programme, surveillance, status and alert rules."""

from __future__ import annotations

from medloom.sources.dimensions import rows as dimension_rows
from oracle.marts_sql import ARV, Q, TODAY, c, case, e, flag, last, like, months, months_ts, num
from oracle.recast import UUID_ANSWERS

# ------------------------------------------------------------------------------------------- programme
_DETAIL = {1754: "ARVs non-disponibles", 160415: "Patient a déménagé", 115198: "Adhérence inadéquate", 159737: "Préférence du patient", 5622: "Autre raison, préciser"}
_REASON = {5240: "Perdu de vue", 159492: "Transfert", 159: "Décès", 1667: "Discontinuations", 1067: "Inconnue"}
Q["stopping_reason"] = f"""
SELECT vp AS patient_id, visit_id, vd::DATE AS visit_date, value_coded AS reason, {case('value_coded', _DETAIL)} AS reason_name, o.comments AS other_reason
FROM ctx x JOIN obs o ON o.encounter_id = x.encounter_id
WHERE seen AND encounter_type = {e('discontinuation')} AND concept_id = 1667 AND o.voided = 0 AND value_coded IN ({', '.join(map(str, _DETAIL))})
QUALIFY row_number() OVER (PARTITION BY vp, value_coded ORDER BY vd DESC, visit_id DESC, obs_id DESC) = 1"""
Q["discontinuation_reason"] = f"""
SELECT * FROM (
  SELECT vp AS patient_id, visit_id, vd::DATE AS visit_date, value_coded AS reason, {case('value_coded', _REASON)} AS reason_name
  FROM ctx x JOIN obs o ON o.encounter_id = x.encounter_id
  WHERE seen AND encounter_type = {e('discontinuation')} AND concept_id = 161555 AND o.voided = 0 AND x.voided <> 1
  QUALIFY row_number() OVER (PARTITION BY vp, value_coded ORDER BY vd DESC, visit_id DESC, obs_id DESC) = 1)
WHERE reason <> 1667 OR visit_id IN (SELECT visit_id FROM stopping_reason WHERE reason IN (115198, 159737))"""

_OG = e("obgyn_initial", "obgyn_followup")
Q["pregnancy_signs"] = f"""
SELECT o.person_id AS patient_id, o.encounter_id, o.obs_id, o.voided, CASE
    WHEN concept_id = 162225 AND value_coded = 1434 THEN 2
    WHEN concept_id = 1592 AND value_coded IN (1910, 162186, 5486, 5576, 163106, 1622) THEN 3
    WHEN concept_id IN (1945, 45) AND value_coded = 703 THEN 6
    WHEN concept_id IN (163764, 161007, 163765, 163766) AND value_coded = 1065 THEN 7
    WHEN concept_id = 159614 AND value_coded IN (113377, 159937) THEN 8 END AS step, obs_datetime::DATE AS s, NULL::DATE AS z
FROM obs o WHERE step IS NOT NULL
UNION ALL
SELECT o.person_id, o.encounter_id, o.obs_id, o.voided, 1, o.obs_datetime::DATE, NULL
FROM obs o JOIN obs h ON h.obs_id = o.obs_group_id AND h.concept_id IN ({like('pregnancy_group_')})
WHERE o.concept_id = 1284 AND o.value_coded IN (46, 129251, 132678, 47, 163751, 1449, 118245, 129211, 141631, 158489, 490, 118744)
UNION ALL
SELECT o.person_id, o.encounter_id, o.obs_id, o.voided, CASE
    WHEN concept_id = 160288 AND value_coded = 1622 THEN 4
    WHEN concept_id = 5596 AND value_datetime IS NOT NULL THEN 5
    WHEN concept_id IN (7957, 159758) AND value_coded = 1589 AND coalesce(comments, '') <> '' THEN 10
    WHEN concept_id IN (1438, 1439, 1440) AND value_numeric > 0 THEN 11
    WHEN concept_id = 163749 AND value_coded IN (5139, 5141) THEN 12
    WHEN concept_id = 160090 AND value_coded IN (160001, 139814, 112259) THEN 13
    WHEN concept_id = 163750 AND value_coded IN (163747, 163748) THEN 14 END AS step, n.encounter_datetime::DATE, NULL
FROM obs o JOIN encounter n USING (encounter_id) WHERE n.encounter_type IN ({_OG}) AND step IS NOT NULL
UNION ALL
SELECT o.person_id, o.encounter_id, o.obs_id, o.voided, 9, (n.encounter_datetime::DATE - INTERVAL 9 MONTH)::DATE, n.encounter_datetime::DATE
FROM obs o JOIN encounter n USING (encounter_id) WHERE n.encounter_type = {e('labor_delivery')}"""
Q["patient_pregnancy"] = f"""
WITH sp AS (SELECT patient_id, encounter_id, first(s ORDER BY step, obs_id) AS s, first(z ORDER BY step, obs_id) AS z, last(voided ORDER BY step, obs_id) AS voided
   FROM pregnancy_signs GROUP BY ALL),
due AS (SELECT DISTINCT person_id AS patient_id, value_datetime::DATE AS d FROM obs WHERE concept_id = 5596 AND voided = 0 AND value_datetime IS NOT NULL),
born AS (SELECT DISTINCT patient_id, encounter_datetime::DATE AS d FROM encounter WHERE encounter_type = {e('labor_delivery')} AND voided = 0),
cyc AS (SELECT DISTINCT person_id AS patient_id, ((((value_datetime::DATE - INTERVAL 3 MONTH)::DATE + 7) + INTERVAL 12 MONTH))::DATE AS d FROM obs
   WHERE concept_id = 1427 AND voided = 0 AND value_datetime IS NOT NULL),
seen AS (SELECT patient_id, max(encounter_datetime::DATE) AS d FROM encounter GROUP BY 1),
steps AS (SELECT sp.*, (SELECT min(d) FROM due WHERE due.patient_id = sp.patient_id AND d > sp.s) AS e1,
   (SELECT min(d) FROM born WHERE born.patient_id = sp.patient_id AND d > sp.s) AS e2,
   CASE WHEN sp.s <= seen.d THEN coalesce((SELECT min(d) FROM cyc WHERE cyc.patient_id = sp.patient_id AND d > sp.s), (SELECT max(d) FROM cyc WHERE cyc.patient_id = sp.patient_id)) END AS e3,
   CASE WHEN ({months('sp.s', TODAY)}) >= 9 THEN (sp.s + INTERVAL 9 MONTH)::DATE END AS e4
   FROM sp LEFT JOIN seen USING (patient_id))
SELECT patient_id, encounter_id, s AS start_date, coalesce(z, e1, e2, e3, e4) AS end_date, voided FROM steps"""

_SETS = {"a": "783, 1423, 83531", "al": "783, 1423", "b": "781, 782, 783, 5261, 83531", "bl": "781, 782, 783, 5261"}
Q["vaccination"] = f"""
WITH t AS (SELECT ob.encounter_id, ob.value_coded AS code, CAST(round(q.value_numeric) AS INT) AS dose FROM obs ob JOIN obs q USING (obs_group_id)
   WHERE q.concept_id = 1418 AND ob.concept_id = 984 AND ob.voided = 0),
k AS (SELECT encounter_id, count(*) FILTER (WHERE dose = 1 AND code IN ({_SETS['a']})) AS a1, count(*) FILTER (WHERE dose = 2 AND code IN ({_SETS['a']})) AS a2,
   count(*) FILTER (WHERE dose = 2 AND code IN ({_SETS['al']})) AS l2, count(*) FILTER (WHERE dose = 3 AND code IN ({_SETS['al']})) AS l3,
   count(*) FILTER (WHERE dose = 1 AND code IN ({_SETS['b']})) AS b1, count(*) FILTER (WHERE dose = 2 AND code IN ({_SETS['b']})) AS b2,
   count(*) FILTER (WHERE dose = 3 AND code IN ({_SETS['bl']})) AS b3,
   bool_or(dose = 1 AND code = 159701) AS r1, bool_or(dose = 2 AND code = 159701) AS r2, bool_or(dose = 1 AND code = 162586) AS m1 FROM t GROUP BY 1),
sp AS (SELECT o.person_id AS patient_id, o.encounter_id, o.location_id, any_value(n.encounter_datetime)::DATE AS encounter_date, last(o.voided ORDER BY obs_id) AS voided
   FROM obs o JOIN encounter n USING (encounter_id) WHERE concept_id = 984 GROUP BY o.person_id, o.encounter_id, o.location_id),
g AS (SELECT sp.*, CASE WHEN encounter_date - p.birthdate BETWEEN 0 AND 45 THEN 45 WHEN encounter_date - p.birthdate BETWEEN 46 AND 75 THEN 75
   WHEN encounter_date - p.birthdate BETWEEN 76 AND 105 THEN 105 WHEN encounter_date - p.birthdate BETWEEN 106 AND 270 THEN 270 END AS age_range
   FROM sp LEFT JOIN (SELECT * FROM person WHERE person_id IN (SELECT patient_id FROM patient)) p ON p.person_id = sp.patient_id)
SELECT patient_id, g.encounter_id, location_id, encounter_date, age_range, CASE WHEN
   (age_range = 45 AND (a1 = 3 OR b1 = 5)) OR (age_range = 75 AND ((a1 = 3 AND a2 = 3) OR (b1 = 5 AND b2 = 5)))
   OR (age_range = 105 AND ((a1 = 3 AND a2 = 3 AND l2 = 2) OR (b1 = 5 AND b2 = 5 AND b3 = 4)))
   OR (age_range = 270 AND (r1 OR m1) AND ((r1 AND r2) OR m1) AND ((a1 = 3 AND a2 = 3 AND l3 = 2) OR (b1 = 5 AND b2 = 5 AND b3 = 4)))
   THEN 1 ELSE 0 END AS vaccination_done, voided
FROM g LEFT JOIN k USING (encounter_id)"""

_D = "obs_datetime::DATE"
_PLAN = {780: "PILLS", 190: "CONDOM", 1359: "IMPLANTS", 5279: "INJECT", 163759: "NECKLACE"}
_KEYPOP = {160578: "MSM", 160579: "SEX PROFESSIONAL", 162277: "CAPTIVE", 124275: "TRANSGENDER", 105: "DRUG USER"}
_NON = {127750: "VOLUNTARY", 160432: "DIED", 159: "DIED", 160036: "REFERRED", 159492: "REFERRED", 162591: "MEDICAL", 155891: "DENIAL", 5622: "OTHER"}


def _labelled(cond: str, mapping: dict) -> str:
    return last(case("value_coded", mapping), cond)


Q["patient_on_art"] = f"""
WITH f AS (SELECT person_id AS patient_id, {flag('voided = 0 AND concept_id = 1040 AND value_coded = 703')} AS t1040,
   {last(_D, 'voided = 0 AND concept_id = 1040 AND value_coded = 703')} AS d1040, {flag('concept_id = 1271 AND value_coded IN (1040, 1042)')} AS ordered,
   {flag('voided = 0 AND concept_id = 160082')} AS entered, first(value_datetime::DATE ORDER BY obs_id) FILTER (WHERE voided = 0 AND concept_id = 160082) AS dentered,
   {last('value_datetime::DATE', 'voided = 0 AND concept_id = 163284')} AS prev, {last('value_datetime::DATE', 'voided = 0 AND concept_id = 509166326')} AS prevnew,
   {_labelled(f"voided = 0 AND concept_id = {c('key_population')}", _KEYPOP)} AS key_population,
   {_labelled('voided = 0 AND concept_id IN (1667, 161555)', _NON)} AS reason_non_enrollment, {last(_D, 'voided = 0 AND concept_id IN (1667, 161555)')} AS date_non_enrollment,
   {last('value_datetime::DATE', 'voided = 0 AND concept_id = 1113')} AS date_enrolled_on_tb_treatment,
   {flag('concept_id = 1659 AND value_coded IN (142177, 1660)')} AS tb_screened, {last(_D, 'concept_id = 1659 AND value_coded IN (142177, 1660)')} AS date_tb_screened,
   {_labelled('concept_id = 1659', {142177: 'POSTIVE', 1660: 'NEGATIVE'})} AS tb_status,
   {flag(f"voided = 0 AND concept_id = {c('genexpert')}")} AS tb_genexpert_test, {last(_D, f"voided = 0 AND concept_id = {c('genexpert')}")} AS dgx,
   {_labelled(f"voided = 0 AND concept_id = {c('genexpert')}", {1301: 'POSTIVE'})} AS sgx,
   {flag('voided = 0 AND concept_id = 307')} AS tb_crachat_test, {last(_D, 'voided = 0 AND concept_id = 307')} AS dsp,
   {_labelled('voided = 0 AND concept_id = 307', {1362: 'POSTIVE', 1363: 'POSTIVE', 1364: 'POSTIVE'})} AS ssp,
   {flag('voided = 0 AND concept_id IN (159984, 159982)')} AS tb_other_test, {last(_D, 'voided = 0 AND concept_id IN (159984, 159982)')} AS dot,
   {flag(f"voided = 0 AND ((concept_id = 159982 AND value_coded IN ({c('tb_positive_1', 'tb_positive_2')})) OR (concept_id = 159984 AND value_coded IN (162203, 162204)))")} AS sot,
   max(CASE value_coded WHEN {c('first_line')} THEN 1 WHEN {c('second_line')} THEN 2 WHEN {c('third_line')} THEN 3 END) FILTER (WHERE voided = 0 AND concept_id = 164432) AS line,
   max({_D}) FILTER (WHERE voided = 0 AND concept_id = 164432 AND value_coded IN ({c('first_line', 'second_line', 'third_line')})) AS date_started_regime_treatment,
   {flag(f"voided = 0 AND concept_id = {c('viral_load_type')} AND value_coded = {c('viral_load_targeted')}")} AS viral_load_targeted,
   {_labelled('voided = 0 AND concept_id = 374', _PLAN)} AS plan, {last(_D, 'voided = 0 AND concept_id = 374')} AS dplan, min({_D}) FILTER (WHERE voided = 0 AND concept_id = 374) AS dplan1,
   {_labelled('voided = 0 AND concept_id = 160704', {1115: 'NEGATIVE', 1116: 'POSTIVE', 1117: 'UNKNOWN'})} AS cervical_cancer_status,
   {last(_D, 'voided = 0 AND concept_id = 160704')} AS date_started_cervical_cancer_status,
   {_labelled('voided = 0 AND concept_id = 1651', {162812: 'CRYOTHERAPY', 162810: 'LEEP', 163408: 'THERMOCOAGULATION'})} AS cervical_cancer_treatment,
   {last(_D, 'voided = 0 AND concept_id = 1651')} AS date_cervical_cancer_treatment,
   {last('CASE WHEN value_coded = 1065 THEN 1 ELSE 0 END', 'voided = 0 AND concept_id = 5632')} AS breast_feeding, {last(_D, 'voided = 0 AND concept_id = 5632')} AS date_breast_feeding,
   {last(_D, f"voided = 0 AND concept_id = {c('breast_feeding')}")} AS date_started_breast_feeding,
   {last('CASE WHEN value_coded = 160415 THEN 1 ELSE 0 END', 'concept_id = 161555')} AS migrated
   FROM obs GROUP BY 1),
ids AS (SELECT patient_id, TRUE AS known FROM patient_on_arv UNION SELECT patient_id, TRUE FROM f WHERE ordered = 1
   UNION SELECT patient_id, FALSE FROM f WHERE entered = 1 AND ordered IS NULL AND patient_id NOT IN (SELECT patient_id FROM patient_on_arv)),
h AS (SELECT patient_id, max(encounter_datetime::DATE) FILTER (WHERE voided = 0 AND encounter_type IN ({e('followup_hiv', 'ped_followup_hiv')})) AS first_vist_date,
   max(encounter_datetime::DATE) FILTER (WHERE voided = 0 AND encounter_type IN ({e('first_hiv', 'ped_first_hiv')})) AS last_folowup_vist_date,
   max(encounter_datetime) FILTER (WHERE voided = 0 AND encounter_type IN ({e('first_hiv', 'ped_first_hiv')}) AND encounter_datetime <>
     (SELECT max(encounter_datetime) FROM encounter WHERE voided = 0 AND encounter_type IN ({e('first_hiv', 'ped_first_hiv')})))::DATE AS second_last_folowup_vist_date,
   min(encounter_datetime::DATE) AS f0 FROM encounter WHERE encounter_type IN ({e('first_hiv', 'followup_hiv', 'ped_first_hiv', 'ped_followup_hiv')}) GROUP BY 1),
tr AS (SELECT o.person_id AS patient_id, max({_D}) AS date_started_arv_for_transfered FROM obs o JOIN encounter n USING (encounter_id)
   WHERE n.encounter_type = {e('first_hiv')} AND concept_id = 159599 AND o.voided = 0 GROUP BY 1)
SELECT ids.patient_id, coalesce(prevnew, prev) AS date_completed_preventive_tb_treatment, key_population, CASE WHEN known THEN t1040 ELSE 1 END AS tested_hiv_postive,
  coalesce(f0, CASE WHEN known THEN d1040 ELSE dentered END) AS date_tested_hiv_postive, reason_non_enrollment, date_non_enrollment, date_enrolled_on_tb_treatment, tb_screened,
  date_tb_screened, tb_status, tb_genexpert_test, tb_other_test, tb_crachat_test, coalesce(dot, dsp, dgx) AS date_sample_sent_for_diagnositic_tb,
  CASE WHEN sot = 1 THEN 'POSTIVE' WHEN tb_crachat_test = 1 THEN ssp ELSE sgx END AS tb_bacteriological_test_status,
  CASE line WHEN 1 THEN 'FIRST_LINE' WHEN 2 THEN 'SECOND_LINE' WHEN 3 THEN 'THIRD_LINE' END AS treatment_regime_lines, date_started_regime_treatment, viral_load_targeted,
  plan AS accepted_family_planning_method, dplan1 AS date_accepted_family_planning_method, plan AS using_family_planning_method, dplan AS date_using_family_planning_method,
  first_vist_date, second_last_folowup_vist_date, last_folowup_vist_date, date_started_arv_for_transfered, NULL::INT AS screened_cervical_cancer,
  NULL::DATE AS date_screened_cervical_cancer, cervical_cancer_status, date_started_cervical_cancer_status, cervical_cancer_treatment, date_cervical_cancer_treatment,
  breast_feeding, date_breast_feeding, date_started_breast_feeding, prev AS date_full_6_months_of_inh_has_px, migrated
FROM ids LEFT JOIN f USING (patient_id) LEFT JOIN h USING (patient_id) LEFT JOIN tr USING (patient_id)"""
Q["art_intended"] = Q["patient_on_art"].replace("NULL::INT AS screened_cervical_cancer", "scr AS screened_cervical_cancer").replace(
    "NULL::DATE AS date_screened_cervical_cancer", "dscr AS date_screened_cervical_cancer"
).replace(
    "FROM obs GROUP BY 1),", f", {flag('voided = 0 AND concept_id = 1651 AND value_coded = 151185')} AS scr, "
    f"{last(_D, 'voided = 0 AND concept_id = 1651 AND value_coded = 151185')} AS dscr FROM obs GROUP BY 1),", 1,
)

# ---------------------------------------------------------------------------------------- surveillance
_rules = ", ".join(
    f"({r[0]}, {r[1]}, {r[2] or UUID_ANSWERS[r[3]]}, {r[4] or 'NULL'}, '{r[5]}')" for r in dimension_rows("indicator")
)
Q["rules"] = f"SELECT rule_id, written_type, answer::BIGINT AS answer, sure::BIGINT AS sure, label FROM (VALUES {_rules}) AS t(rule_id, written_type, answer, sure, label)"
Q["patient_diagnosis"] = f"""
WITH d AS (SELECT o.*, h.concept_id AS grp, n.encounter_datetime, n.voided AS nv, n.location_id AS nl
  FROM obs o JOIN obs h ON h.obs_id = o.obs_group_id AND h.person_id = o.person_id AND h.encounter_id = o.encounter_id JOIN encounter n ON n.encounter_id = o.encounter_id
  WHERE o.concept_id = 1284 AND o.value_coded IS NOT NULL AND n.encounter_type IN ({e('obgyn_initial', 'obgyn_followup', 'adult_initial', 'adult_followup', 'ped_initial', 'ped_followup')})),
k AS (SELECT encounter_id, location_id, grp, value_coded AS a, first(person_id ORDER BY obs_id) AS p, first(obs_group_id ORDER BY obs_id) AS g,
  first(CASE WHEN nv = 0 AND nl = location_id THEN encounter_datetime::DATE END ORDER BY obs_id) AS d, last(voided ORDER BY obs_id) AS v FROM d GROUP BY ALL),
s AS (SELECT obs_group_id AS g, {last('value_coded', 'concept_id = 159394 AND value_coded IN (159392, 159393)')} AS sc,
  {last('value_coded', 'concept_id = 159946 AND value_coded IN (159943, 159944)')} AS ps FROM obs WHERE voided = 0 GROUP BY 1)
SELECT p AS patient_id, encounter_id, location_id, d AS encounter_date, grp AS concept_group, g AS obs_group_id, 1284 AS concept_id, a AS answer_concept_id,
  sc AS suspected_confirmed, ps AS primary_secondary, v AS voided FROM k LEFT JOIN s USING (g)"""
Q["events_found"] = """
SELECT r.rule_id, r.written_type, r.label, d.* FROM patient_diagnosis d JOIN rules r ON r.answer = d.answer_concept_id AND (r.sure IS NULL OR r.sure = d.suspected_confirmed)
WHERE d.voided <> 1 AND d.patient_id IN (SELECT patient_id FROM patient_mart)"""
Q["indicators"] = """
SELECT first(rule_id ORDER BY rule_id, encounter_id, location_id) AS rule_id, written_type AS indicator_type_id, patient_id,
  first(location_id ORDER BY rule_id, encounter_id, location_id) AS location_id, first(encounter_id ORDER BY rule_id, encounter_id, location_id) AS encounter_id,
  encounter_date AS indicator_date, last(voided ORDER BY rule_id, encounter_id, location_id) AS voided
FROM events_found WHERE encounter_date IS NOT NULL GROUP BY written_type, patient_id, encounter_date"""
Q["weekly_indicators"] = """
SELECT rule_id, label, location_id, date_trunc('week', encounter_date)::DATE AS week_start, count(DISTINCT patient_id) AS patients,
  count(DISTINCT (patient_id, encounter_date)) AS patient_days
FROM events_found WHERE encounter_date IS NOT NULL GROUP BY ALL"""
Q["indicator_totals"] = """
SELECT rule_id, label, count(*) AS events, count(DISTINCT patient_id) AS patients FROM events_found GROUP BY ALL"""

# ---------------------------------------------------------------------------------------- immunisation
Q["patient_immunization"] = f"""
WITH g AS (SELECT obs_group_id, {last('value_numeric', 'concept_id = 1418')} AS dose, {last('value_datetime', 'concept_id = 1410')} AS vaccine_date FROM obs GROUP BY 1)
SELECT o.person_id AS patient_id, first(o.location_id ORDER BY o.obs_id) AS location_id, first(o.encounter_id ORDER BY o.obs_id) AS encounter_id, o.obs_group_id AS vaccine_obs_group_id,
  o.value_coded AS vaccine_concept_id, any_value(g.dose) AS dose, any_value(g.vaccine_date) AS vaccine_date, first(o.obs_datetime ORDER BY o.obs_id) AS encounter_date,
  any_value(k.uuid) AS vaccine_uuid, last(o.voided ORDER BY o.obs_id) AS voided
FROM obs o JOIN obs h ON h.obs_id = o.obs_group_id AND h.concept_id = 1421 JOIN concept k ON k.concept_id = o.value_coded LEFT JOIN g ON g.obs_group_id = o.obs_group_id
WHERE o.concept_id = 984 GROUP BY o.person_id, o.obs_group_id, o.value_coded"""
Q["immunization_dose"] = f"""
SELECT patient_id, vaccine_concept_id, {', '.join(f'max(vaccine_date) FILTER (WHERE CAST(round(dose) AS INT) = {n}) AS dose{n}' for n in range(9))}
FROM patient_immunization WHERE voided <> 1 GROUP BY ALL"""
_vacc = ", ".join(f"({r[0]}, '{r[1]}', '{r[2]}')" for r in dimension_rows("vaccine"))
Q["vaccine_dictionary"] = f"""
SELECT id, concept_id AS vaccine_concept_id, vaccine_name, t.uuid FROM (VALUES {_vacc}) AS t(id, vaccine_name, uuid) LEFT JOIN concept k ON k.uuid = t.uuid"""

# --------------------------------------------------------------------------------------------- infants
_LIVE = "(SELECT * FROM encounter WHERE voided <> 1)"
_PED = e("ped_first_hiv", "ped_followup_hiv")
Q["infant_candidates"] = f"""
WITH pcr AS (SELECT o.*, n.patient_id, n.encounter_datetime, max(n.encounter_datetime) OVER (PARTITION BY n.patient_id) AS latest
  FROM obs o JOIN {_LIVE} n USING (encounter_id) WHERE o.concept_id IN (1030, 844) AND o.voided <> 1 AND n.encounter_type IN ({e('ped_first_hiv', 'lab')})),
disp AS (SELECT *, max(visit_date) OVER (PARTITION BY patient_id) AS latest FROM patient_dispensing WHERE voided <> 1)
SELECT patient_id, location_id, encounter_id, encounter_datetime::DATE AS visit_date, 1 AS condition FROM pcr
WHERE person_id = patient_id AND encounter_datetime::DATE = latest::DATE AND (concept_id, value_coded) IN ((1030, 664), (844, 1302))
UNION ALL
SELECT DISTINCT o.person_id, o.location_id, o.encounter_id, n.encounter_datetime::DATE, 3 FROM obs o JOIN {_LIVE} n USING (encounter_id)
WHERE n.encounter_type IN ({_PED}) AND concept_id = 1401 AND value_coded = 1405 AND o.voided <> 1
UNION ALL
SELECT DISTINCT patient_id, location_id, encounter_id, visit_date::DATE, 4 FROM disp WHERE visit_date = latest AND rx_or_prophy = 163768 AND arv_drug = 1065"""
Q["infants_infected"] = f"""
SELECT o.person_id AS patient_id FROM obs o JOIN {_LIVE} n ON n.encounter_id = o.encounter_id AND n.patient_id = o.person_id
WHERE o.voided <> 1 AND (n.encounter_type, o.concept_id, o.value_coded) IN (({e('ped_first_hiv')}, 1030, 703), ({e('lab')}, 844, 1301))
UNION
SELECT l.patient_id FROM patient_laboratory l JOIN patient_mart p USING (patient_id)
WHERE l.test_id = 1040 AND l.test_done = 1 AND {num('l.test_result')} = 703 AND l.voided <> 1 AND ({months('p.birthdate', TODAY)}) >= 18
UNION
SELECT o.person_id FROM obs o JOIN {_LIVE} n USING (encounter_id) WHERE n.encounter_type IN ({_PED}) AND concept_id = 1401 AND value_coded = 163717 AND o.voided <> 1"""
Q["exposed_infants"] = f"""
SELECT * FROM infant_candidates WHERE patient_id NOT IN (FROM infants_infected)
UNION ALL
SELECT DISTINCT o.person_id, o.location_id, o.encounter_id, n.encounter_datetime::DATE, 5 FROM obs o JOIN {_LIVE} n USING (encounter_id)
WHERE n.encounter_type = {e('discontinuation')} AND concept_id = 1667 AND value_coded = 165439 AND o.voided <> 1"""

# ---------------------------------------------------------------------------------------------- status
Q["last_day"] = "SELECT patient_id, max(date_started::DATE) AS d FROM visit WHERE voided = 0 GROUP BY 1"
Q["stop_answers"] = f"""
SELECT x.*, o.value_coded AS why FROM ctx x JOIN obs o ON o.encounter_id = x.encounter_id AND o.person_id = x.patient_id
WHERE x.voided <> 1 AND x.encounter_type = {e('discontinuation')} AND o.concept_id = 161555 AND o.voided <> 1"""


def _best(rows: str) -> str:
    """Latest day and highest encounter of it, per patient and status."""
    return (
        "SELECT patient_id, id_status, max(start_date) AS start_date, arg_max(encounter_id, (start_date, encounter_id)) AS encounter_id "
        f"FROM ({rows}) GROUP BY ALL"
    )


Q["status_left_before"] = _best(f"""
SELECT vp AS patient_id, CASE why WHEN 159 THEN 4 ELSE 5 END AS id_status, vd::DATE AS start_date, encounter_id FROM stop_answers s
WHERE seen AND why IN (159, 159492) AND EXISTS (FROM last_day l WHERE l.patient_id = vp AND l.d = vd::DATE)
AND vp IN (SELECT patient_id FROM patient_mart WHERE vih_status = 1 AND voided = 0) AND patient_id NOT IN (SELECT patient_id FROM patient_on_arv)""")
Q["status_refill"] = _best(f"""
SELECT d.patient_id, CASE WHEN {TODAY} <= nd THEN 6 WHEN {TODAY} - nd <= 30 THEN 8 ELSE 9 END AS id_status, visit_date::DATE AS start_date, encounter_id
FROM (SELECT *, next_dispensation_date AS nd FROM patient_dispensing WHERE voided <> 1) d
WHERE nd = (SELECT max(next_dispensation_date) FROM patient_dispensing m WHERE m.patient_id = d.patient_id AND m.voided <> 1 AND m.arv_drug = 1065)
AND (arv_drug = 1065 OR {TODAY} - nd BETWEEN 1 AND 30) AND (d.patient_id IN (SELECT patient_id FROM patient_mart) OR {TODAY} - nd > 30)
AND (d.patient_id IN (SELECT patient_id FROM patient_on_arv) OR nd < {TODAY})
AND EXISTS (FROM encounter n WHERE n.voided <> 1 AND n.visit_id = d.visit_id AND n.encounter_type IN ({e('dispensing', 'ped_dispensing')})
  AND n.patient_id NOT IN (SELECT patient_id FROM discontinuation_reason WHERE reason IN (159, 1667, 159492))
  AND (nd >= {TODAY} OR n.patient_id IN (SELECT patient_id FROM patient_on_arv)))""")
Q["status_before"] = _best(f"""
SELECT vp AS patient_id, CASE WHEN encounter_type IN ({e('first_hiv', 'ped_first_hiv')}) THEN CASE WHEN m <= 12 THEN 7 END
  WHEN encounter_type IN ({e('followup_hiv', 'ped_followup_hiv', 'dispensing', 'ped_dispensing', 'lab')}) THEN CASE WHEN m <= 12 THEN 11 END
  WHEN m > 12 THEN 10 END AS id_status, vd::DATE AS start_date, encounter_id
FROM (SELECT *, {months_ts('vd', TODAY)} AS m FROM ctx WHERE seen AND voided <> 1 AND vvoid <> 1) x
WHERE id_status IS NOT NULL AND EXISTS (FROM last_day l WHERE l.patient_id = vp AND l.d = vd::DATE)
AND vp IN (SELECT patient_id FROM patient_mart WHERE vih_status = 1) AND vp NOT IN (SELECT patient_id FROM patient_on_arv)
AND patient_id NOT IN (SELECT patient_id FROM discontinuation_reason WHERE reason IN (159, 159492))""")
Q["status_left_on"] = _best("""
SELECT patient_id, CASE why WHEN 159 THEN 1 WHEN 159492 THEN 2 ELSE 3 END AS id_status, encounter_datetime::DATE AS start_date, encounter_id FROM stop_answers s
WHERE patient_id IN (SELECT patient_id FROM patient_on_arv) AND (why IN (159, 159492) OR (why = 1667 AND EXISTS (
  FROM obs z WHERE z.encounter_id = s.encounter_id AND z.concept_id = 1667 AND z.value_coded IN (115198, 159737) AND z.voided <> 1)))""")
Q["statuses"] = f"""
WITH u AS (FROM status_left_before UNION ALL FROM status_refill UNION ALL FROM status_before UNION ALL FROM status_left_on)
SELECT u.*, (SELECT arg_min(reason, (visit_date, reason)) FROM discontinuation_reason r WHERE r.patient_id = u.patient_id AND r.visit_date >= u.start_date) AS dis_reason,
  {TODAY} AS date_started_status FROM u WHERE patient_id NOT IN (SELECT patient_id FROM exposed_infants)"""
_WRITTEN = "list_position([4, 5, 6, 8, 9, 10, 7, 11, 1, 2, 3], id_status)"
Q["current_status"] = f"SELECT patient_id, arg_max(id_status, (date_started_status, {_WRITTEN})) AS arv_status FROM statuses GROUP BY 1"
Q["patient_now"] = "SELECT p.*, s.arv_status FROM patient_mart p LEFT JOIN current_status s USING (patient_id)"
Q["status_counts"] = "SELECT id_status, count(*) AS patients, min(start_date) AS first_start, max(start_date) AS last_start FROM statuses GROUP BY 1"

# -------------------------------------------------------------------------------------------- regimens
_reg = ", ".join(f"({r[2]}, {r[3]}, {r[4]}, '{r[5]}')" for r in dimension_rows("regimen"))
Q["regimen_hits"] = f"""
WITH cat AS (SELECT DISTINCT * FROM (VALUES {_reg}) AS t(d1, d2, d3, short)),
ok AS (SELECT * FROM patient_prescription WHERE voided <> 1 AND visit_date IS NOT NULL)
SELECT a.location_id, a.patient_id, a.visit_date AS moment, short, a.rx_or_prophy, d1 FROM ok a JOIN cat ON cat.d1 = a.drug_id
WHERE a.arv_drug = 1065 AND a.patient_id IN (SELECT patient_id FROM patient_mart)
AND (d2 = 0 OR EXISTS (FROM ok b WHERE b.location_id = a.location_id AND b.patient_id = a.patient_id AND b.visit_date = a.visit_date AND b.drug_id = d2))
AND (d3 = 0 OR EXISTS (FROM ok b WHERE b.location_id = a.location_id AND b.patient_id = a.patient_id AND b.visit_date = a.visit_date AND b.drug_id = d3))"""
Q["regimens"] = """
SELECT location_id, patient_id, moment::DATE AS visit_date, short AS regimen, last(rx_or_prophy ORDER BY moment, coalesce(rx_or_prophy, 0), d1) AS rx_or_prophy
FROM regimen_hits GROUP BY ALL"""
_stat = ", ".join(f"({r[0]}, '{r[2]}')" for r in dimension_rows("arv_status"))
Q["patient_summary"] = f"""
WITH r AS (SELECT patient_id, arg_max(regimen, (visit_date, regimen, location_id)) AS arv_regimen FROM regimens GROUP BY 1),
k AS (SELECT patient_id, l.fr AS arv_status, date_started_arv::DATE AS date_started_arv, next_visit_date FROM patient_now p
  LEFT JOIN (VALUES {_stat}) AS l(id, fr) ON l.id = p.arv_status WHERE p.arv_status IS NOT NULL OR next_visit_date IS NOT NULL OR date_started_arv IS NOT NULL)
SELECT patient_id, arv_status, arv_regimen, date_started_arv, next_visit_date FROM k FULL JOIN r USING (patient_id)"""

# ---------------------------------------------------------------------------------------------- alerts
Q["stop_form_any"] = f"SELECT DISTINCT patient_id FROM encounter WHERE voided <> 1 AND encounter_type = {e('discontinuation')}"
Q["stop_form_why"] = "SELECT patient_id FROM stop_form_any WHERE patient_id IN (SELECT patient_id FROM discontinuation_reason)"
Q["arv_first"] = "SELECT patient_id, min(encounter_id) AS encounter_id, min(visit_date::DATE) AS d FROM patient_dispensing WHERE arv_drug = 1065 AND voided <> 1 GROUP BY 1"
Q["vl_done"] = "SELECT DISTINCT patient_id FROM patient_laboratory WHERE test_id IN (856, 1305) AND test_done = 1 AND voided <> 1 AND test_result <> ''"
Q["refill_rows"] = """
SELECT * FROM patient_dispensing d WHERE next_dispensation_date = (SELECT max(next_dispensation_date) FROM patient_dispensing m
  WHERE m.patient_id = d.patient_id AND m.arv_drug = 1065 AND m.voided <> 1 AND coalesce(m.rx_or_prophy, 0) <> 163768)"""
_IN_CARE = "patient_id IN (SELECT patient_id FROM patient_now WHERE arv_status NOT IN (1, 2, 3))"
_POS_CARE = "patient_id IN (SELECT patient_id FROM patient_now WHERE arv_status NOT IN (1, 2, 3) AND vih_status = 1)"
_TDAY = "coalesce(date_test_done, visit_date::DATE)"


def _since_start(code: int, test: str, stop: str, more: str = "TRUE", first: str = "arv_first", done: str = "vl_done") -> str:
    return f"""
SELECT DISTINCT f.patient_id, {code} AS id_alert, f.encounter_id, f.d AS date_alert FROM {first} f JOIN patient_now p USING (patient_id)
WHERE p.date_started_arv = f.d::TIMESTAMP AND {months_ts('p.date_started_arv', TODAY)} {test} AND p.vih_status = 1 AND {more}
AND f.patient_id NOT IN (FROM {done}) AND f.patient_id NOT IN (FROM {stop})"""


_PREG = "f.patient_id IN (SELECT patient_id FROM patient_pregnancy)"
A: dict[str, str] = {
    "alert_1": _since_start(1, ">= 6", "stop_form_why"),
    "alert_2": _since_start(2, "= 5", "stop_form_any"),
    "alert_3": _since_start(3, ">= 4", "stop_form_why", _PREG),
    "alert_4": f"""
SELECT DISTINCT patient_id, 4 AS id_alert, encounter_id, {_TDAY} AS date_alert FROM patient_laboratory l
WHERE {_TDAY} = (SELECT max({_TDAY}) FROM patient_laboratory m WHERE m.patient_id = l.patient_id AND m.test_id IN (856, 1305) AND {num('m.test_result')} > 0 AND m.voided <> 1)
AND ({months(_TDAY, TODAY)}) >= 12 AND ((test_id = 856 AND {num('test_result')} < 1000) OR (test_id = 1305 AND {num('test_result')} = 1306))
AND {_POS_CARE} AND patient_id IN (SELECT patient_id FROM patient_on_arv)""",
    "alert_5": f"""
SELECT DISTINCT patient_id, 5 AS id_alert, encounter_id, d AS date_alert FROM (
  SELECT person_id AS patient_id, *, obs_datetime::DATE AS d, max(obs_datetime::DATE) OVER (PARTITION BY person_id) AS z FROM obs WHERE concept_id IN (856, 1305) AND voided <> 1)
WHERE d = z AND ((concept_id = 856 AND value_numeric > 1000) OR (concept_id = 1305 AND value_coded = 1301)) AND ({months('d', TODAY)}) >= 3 AND {_IN_CARE}""",
    "alert_6": f"""
SELECT DISTINCT patient_id, 6 AS id_alert, encounter_id, {_TDAY} AS date_alert FROM patient_laboratory l
WHERE {_TDAY} = (SELECT max({_TDAY}) FROM patient_laboratory m WHERE m.patient_id = l.patient_id AND m.test_id = 856 AND m.test_done = 1 AND m.voided <> 1 AND m.test_result <> '')
AND test_id = 856 AND {num('test_result')} > 1000 AND patient_id IN (SELECT patient_id FROM patient_on_arv)
AND patient_id IN (SELECT patient_id FROM patient_now WHERE vih_status = 1) AND patient_id NOT IN (FROM stop_form_why)""",
    "alert_7": f"SELECT DISTINCT patient_id, 7 AS id_alert, encounter_id, visit_date::DATE AS date_alert FROM refill_rows WHERE next_dispensation_date - {TODAY} BETWEEN 0 AND 30 AND {_IN_CARE}",
    "alert_8": f"SELECT DISTINCT patient_id, 8 AS id_alert, encounter_id, visit_date::DATE AS date_alert FROM refill_rows WHERE next_dispensation_date < {TODAY} AND {_IN_CARE}",
    "alert_9_dispensed": f"""
SELECT patient_id, 9 AS id_alert, encounter_id, visit_date::DATE AS date_alert FROM patient_dispensing d
WHERE voided <> 1 AND patient_id IN (SELECT patient_id FROM patient_on_arv) AND {_IN_CARE}
AND visit_date::DATE = (SELECT max(m.visit_date::DATE) FROM patient_dispensing m WHERE m.patient_id = d.patient_id AND m.voided <> 1)
GROUP BY patient_id, encounter_id, visit_date::DATE HAVING bool_or(drug_id = 78280 AND rx_or_prophy = 138405) AND bool_or(drug_id = 767)""",
    "alert_9_form": f"""
WITH n AS (SELECT *, max(encounter_datetime) OVER (PARTITION BY patient_id)::DATE AS z FROM encounter WHERE voided <> 1 AND encounter_type IN ({e('first_hiv', 'followup_hiv', 'ped_first_hiv', 'ped_followup_hiv')}))
SELECT o.person_id AS patient_id, 9 AS id_alert, o.encounter_id, n.encounter_datetime::DATE AS date_alert
FROM obs o JOIN obs h ON h.obs_id = o.obs_group_id AND h.voided <> 1 JOIN n ON n.encounter_id = o.encounter_id AND n.patient_id = o.person_id
WHERE o.voided <> 1 AND o.concept_id = 1282 AND (h.concept_id, o.value_coded) IN (({c('isoniazid_group')}, 78280), ({c('rifampicin_group')}, 767))
AND EXISTS (FROM obs t WHERE t.obs_group_id = o.obs_group_id AND t.concept_id = 159367 AND t.value_coded = 1065 AND t.voided <> 1)
AND n.encounter_datetime::DATE = n.z AND {_IN_CARE}
GROUP BY o.person_id, o.encounter_id, n.encounter_datetime::DATE HAVING count(DISTINCT o.value_coded) = 2""",
    "alert_10": f"""
SELECT f.patient_id, 10 AS id_alert, f.encounter_id, f.d AS date_alert FROM arv_first f JOIN patient_now p USING (patient_id)
WHERE ({months('f.d', TODAY)}) >= 3 AND p.arv_status NOT IN (1, 2, 3, 4) AND p.vih_status = 1
AND EXISTS (FROM patient_dispensing d WHERE d.patient_id = f.patient_id AND d.visit_date::DATE = f.d AND d.voided <> 1)
AND NOT EXISTS (FROM patient_laboratory l WHERE l.patient_id = f.patient_id AND l.voided <> 1
  AND ((l.test_id = 856 AND l.test_result <> '') OR (l.test_id = 1305 AND {num('l.test_result')} IN (1301, 1306))))""",
    "alert_11": f"""
SELECT DISTINCT patient_id, 11 AS id_alert, encounter_id, visit_date::DATE AS date_alert FROM patient_dispensing d WHERE arv_drug = 1065 AND rx_or_prophy <> 163768 AND {_POS_CARE}
AND NOT EXISTS (FROM obs o JOIN encounter n ON n.encounter_id = o.encounter_id AND n.patient_id = o.person_id WHERE n.patient_id = d.patient_id
  AND n.voided <> 1 AND n.encounter_type IN ({e('dispensing', 'ped_dispensing')}) AND o.concept_id = 1282 AND o.value_coded = 78280 AND o.voided <> 1)""",
    "alert_12": f"SELECT DISTINCT person_id AS patient_id, 12 AS id_alert, encounter_id, obs_datetime::DATE AS date_alert FROM obs WHERE concept_id = {c('ddp')} AND value_coded = 1065 AND voided <> 1",
}
Q |= A
Q["alerts"] = " UNION ALL ".join(f"FROM {n}" for n in A)

# The earlier rule set: discontinuation forms of any state, dispensations of any state.
Q["stop_any_state"] = f"SELECT DISTINCT patient_id FROM encounter WHERE encounter_type = {e('discontinuation')}"
Q["stop_why_state"] = "SELECT patient_id FROM stop_any_state WHERE patient_id IN (SELECT patient_id FROM discontinuation_reason)"
Q["arv_first_any"] = "SELECT patient_id, max(encounter_id) AS encounter_id, min(visit_date::DATE) AS d FROM patient_dispensing WHERE arv_drug = 1065 GROUP BY 1"
Q["vl_any"] = "SELECT DISTINCT patient_id FROM patient_laboratory WHERE test_id IN (856, 1305) AND test_done = 1 AND voided <> 1 AND test_result IS NOT NULL"
Q["vl_latest"] = f"""
SELECT *, {_TDAY} AS td FROM patient_laboratory l WHERE td = (SELECT max({_TDAY}) FROM patient_laboratory m WHERE m.patient_id = l.patient_id
  AND m.test_id IN (856, 1305) AND m.test_done = 1 AND m.voided <> 1 AND m.test_result IS NOT NULL)
AND patient_id IN (SELECT patient_id FROM patient_on_arv) AND patient_id IN (SELECT patient_id FROM patient_now WHERE vih_status = 1) AND patient_id NOT IN (FROM stop_why_state)"""
_OLD = dict(first="arv_first_any", done="vl_any")
Q["first_alerts"] = " UNION ALL ".join(
    f"SELECT * FROM ({q})"
    for q in (
        _since_start(1, ">= 6", "stop_why_state", **_OLD),
        _since_start(2, ">= 4", "stop_why_state", _PREG, **_OLD),
        f"SELECT DISTINCT patient_id, 3, encounter_id, td FROM vl_latest WHERE ({months('td', TODAY)}) >= 12",
        f"SELECT DISTINCT patient_id, 4, encounter_id, td FROM vl_latest WHERE ({months('td', TODAY)}) > 3 AND {num('test_result')} > 1000",
        f"SELECT DISTINCT patient_id, 5, encounter_id, td FROM vl_latest WHERE {num('test_result')} > 1000",
        f"SELECT DISTINCT patient_id, 7, encounter_id, visit_date::DATE FROM refill_rows WHERE next_dispensation_date - {TODAY} BETWEEN 0 AND 30 AND patient_id IN (SELECT patient_id FROM patient_mart) AND patient_id NOT IN (FROM stop_why_state)",
        f"SELECT DISTINCT patient_id, 7, encounter_id, visit_date::DATE FROM refill_rows WHERE next_dispensation_date < {TODAY} AND patient_id IN (SELECT patient_id FROM patient_mart) AND patient_id NOT IN (FROM stop_any_state)",
        _since_start(8, "= 5", "stop_any_state", **_OLD),
    )
)
