"""Registry jobs over the sample tables seen as a registry snapshot, with the SQL that checks them.

An order is a study; its customer the lead sponsor; its lines the interventions, conditions and collaborators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators.snapshot import Snapshot, labeled_summary, match_summary
from tidemark.plans import base as B

#: The snapshot's tables as expressions that both engines read alike.
STUDIES = {
    "nct_id": "concat('T', o_orderkey)",
    "study_type": "CASE WHEN o_orderkey % 10 = 0 THEN ' Observational' ELSE 'Interventional ' END",
    "overall_status": "CASE o_orderstatus WHEN 'F' THEN 'Terminated' WHEN 'O' THEN 'Completed' ELSE CASE o_orderkey % 3 WHEN 0 THEN 'Withdrawn' WHEN 1 THEN 'Active, not recruiting' ELSE 'not yet recruiting' END END",
    "phase": "CASE o_custkey % 6 WHEN 0 THEN 'Phase 1' WHEN 1 THEN 'Phase 1/Phase  2' WHEN 2 THEN 'phase 2' WHEN 3 THEN 'PHASE3' WHEN 4 THEN 'Phase 4' END",
    "start_date": "CASE WHEN o_orderkey % 13 <> 0 THEN concat(year(o_orderdate) + 10, '-', lpad(CAST(month(o_orderdate) AS STRING), 2, '0'), '-01') END",
    "completion_date": "CASE WHEN o_orderstatus <> 'P' AND o_orderkey % 7 <> 0 THEN concat(year(o_orderdate) + 12, '-06-30') END",
    "why_stopped": "CASE left(o_orderpriority, 1) WHEN '1' THEN 'Safety concerns' WHEN '2' THEN 'Slow accrual' WHEN '3' THEN 'Business decision; no safety concerns' WHEN '4' THEN ' ' END",
    "number_of_arms": "CASE WHEN o_orderkey % 11 = 0 THEN 'x' ELSE CAST(o_orderkey % 5 AS STRING) END",
    "has_dmc": "CASE o_orderkey % 3 WHEN 0 THEN 'T' WHEN 1 THEN 'no' ELSE '?' END",
    "brief_title": "concat('brief ', o_orderkey)",
    "official_title": "CASE WHEN o_orderkey % 4 = 0 THEN concat('Official ', o_orderkey) END",
}
DESIGNS = {
    "nct_id": STUDIES["nct_id"],
    "allocation": "CASE WHEN o_orderkey % 5 <> 0 THEN 'Randomized' END",
    "intervention_model": "CASE WHEN o_orderkey % 2 = 0 THEN 'Single Group Assignment' ELSE 'Parallel Assignment__' END",
    "primary_purpose": "CASE WHEN o_orderkey % 6 = 0 THEN 'Educational/Counseling/Training' ELSE 'Treatment' END",
    "masking": "CASE o_orderkey % 7 WHEN 0 THEN 'None (Open Label)' WHEN 1 THEN 'Double' WHEN 2 THEN 'Participant, Investigator, Outcomes Assessor' WHEN 3 THEN 'Double Blind' WHEN 4 THEN 'Unclear ' END",
    "subject_masked": "CASE o_orderkey % 3 WHEN 0 THEN 't' WHEN 1 THEN 'f' END",
    "investigator_masked": "CASE WHEN o_orderkey % 2 = 0 THEN 'yes' END",
}
LEADS = {
    "nct_id": STUDIES["nct_id"],
    "agency_class": "CASE o_custkey % 4 WHEN 0 THEN 'Industry' WHEN 1 THEN 'NIH' WHEN 2 THEN 'U.S. Fed' END",
    "lead_or_collaborator": "'Lead'",
    "name": "concat('S', o_custkey)",
}
SECOND = LEADS | {"agency_class": "'OTHER'", "name": "concat('A', o_custkey)"}
HELPERS = {"nct_id": "concat('T', l_orderkey)", "agency_class": "'OTHER'", "lead_or_collaborator": "'collaborator'", "name": "concat('C', l_suppkey)"}
INTERVENTIONS = {
    "nct_id": "concat('T', l_orderkey)",
    "id": "l_orderkey * 10 + l_linenumber",
    "intervention_type": "CASE l_partkey % 4 WHEN 0 THEN 'Drug' WHEN 1 THEN ' biological' WHEN 2 THEN 'Device' ELSE 'Procedure' END",
    "name": "concat('d', l_partkey)",
}
COUNTRIES = {"nct_id": "concat('T', l_orderkey)", "name": "CASE WHEN l_suppkey % 3 <> 0 THEN 'United States' ELSE concat('Land', l_suppkey % 5) END"}
ELIGIBILITIES = {
    "nct_id": STUDIES["nct_id"],
    "gender": "CASE o_orderkey % 3 WHEN 0 THEN 'Both' WHEN 1 THEN 'Female' END",
    "minimum_age": "concat(o_orderkey % 90, CASE o_orderkey % 4 WHEN 0 THEN ' Years' WHEN 1 THEN ' Months' WHEN 2 THEN ' weeks' ELSE ' Days' END)",
    "maximum_age": "CASE WHEN o_orderkey % 2 = 0 THEN '65.5 Years' ELSE 'N/A' END",
    "healthy_volunteers": "CASE o_orderkey % 3 WHEN 0 THEN 'Accepts Healthy Volunteers' WHEN 1 THEN 'No' END",
    "criteria": "CASE WHEN o_orderkey % 5 <> 0 THEN concat('Inclusion Criteria:~ adults~~age ', o_orderkey % 90, '~Exclusion criteria ~none') END",
}
TERMS = [*S.AREAS.values(), "Other"]
CONDITIONS = {"nct_id": "concat('T', l_orderkey)", "mesh_term": f"CASE l_partkey % 15 {' '.join(f"WHEN {k} THEN '{t}'" for k, t in enumerate(TERMS))} END"}
PARTIES = {"nct_id": STUDIES["nct_id"], "responsible_party_type": "CASE o_custkey % 3 WHEN 0 THEN 'Sponsor' WHEN 1 THEN 'Sponsor-Investigator' ELSE 'Principal Investigator' END"}
KEYWORDS = {"nct_id": "concat('T', l_orderkey)", "name": "concat('k', l_partkey % 50)"}
SUMMARIES = {"nct_id": STUDIES["nct_id"], "description": "concat('About ', o_orderkey, '. It was halted. Then on.')"}
#: name: table, rows, columns
TABLES = {
    "studies": [("orders", "true", STUDIES)],
    "designs": [("orders", "o_orderkey % 4 <> 1", DESIGNS)],
    "sponsors": [("orders", "o_orderkey % 19 <> 0", LEADS), ("orders", "o_orderkey % 17 = 0", SECOND), ("lineitem", "l_suppkey % 4 = 0", HELPERS)],
    "interventions": [("lineitem", "true", INTERVENTIONS)],
    "countries": [("lineitem", "l_linenumber < 4 AND l_partkey % 9 <> 0", COUNTRIES)],
    "eligibilities": [("orders", "o_orderkey % 8 <> 0", ELIGIBILITIES)],
    "browse_conditions": [("lineitem", "l_linenumber <> 2", CONDITIONS)],
    "responsible_parties": [("orders", "o_orderkey % 3 <> 0", PARTIES), ("orders", "o_orderkey % 21 = 1", PARTIES | {"responsible_party_type": "'Agency'"})],
    "keywords": [("lineitem", "l_linenumber % 2 = 1", KEYWORDS)],
    "brief_summaries": [("orders", "o_orderkey % 6 <> 0", SUMMARIES)],
}


def snapshot(spark: SparkSession, d: str) -> Snapshot:
    def rows(source: str, where: str, columns: dict[str, str]) -> DataFrame:
        return B.table(spark, d, source).where(where).select(*[F.expr(e).alias(c) for c, e in columns.items()])

    made = {}
    for name, parts in TABLES.items():
        made[name] = rows(*parts[0])
        for part in parts[1:]:
            made[name] = made[name].unionByName(rows(*part))
    return Snapshot(**made)


def eligible_trials(spark: SparkSession, d: str) -> DataFrame:
    return snapshot(spark, d).eligible()


def trial_drugs(spark: SparkSession, d: str) -> DataFrame:
    s = snapshot(spark, d)
    return s.drugs(s.eligible())


def sponsor_ended(spark: SparkSession, d: str) -> DataFrame:
    return snapshot(spark, d).ended()


def sponsor_begun(spark: SparkSession, d: str) -> DataFrame:
    return snapshot(spark, d).begun()


def trial_attributes(spark: SparkSession, d: str) -> DataFrame:
    s = snapshot(spark, d)
    return s.attributes(s.eligible())


def trial_texts(spark: SparkSession, d: str) -> DataFrame:
    s = snapshot(spark, d)
    return s.texts(s.eligible())


def trials_summary(spark: SparkSession, d: str) -> DataFrame:
    out = labeled_summary(snapshot(spark, d).eligible())
    return out.withColumn("termination_rate", F.round("termination_rate", 6))


def drug_match_rate(spark: SparkSession, d: str) -> DataFrame:
    """Substances are the drugs whose number is even."""
    s = snapshot(spark, d)
    trials = s.eligible()
    found = s.drugs(trials).where("right(name, 1) IN ('0', '4', '8')").select("nct_id", F.col("name").alias("substance"))
    return match_summary(trials, found).withColumn("match_rate", F.round("match_rate", 6))


QUERIES = {f.__name__: f for f in (eligible_trials, trial_drugs, sponsor_ended, sponsor_begun, trial_attributes, trial_texts, trials_summary, drug_match_rate)}


def _cte(name: str) -> str:
    parts = [f"SELECT {', '.join(f'{e} AS {c}' for c, e in columns.items())} FROM {source} WHERE {where}" for source, where, columns in TABLES[name]]
    return f"{name} AS ({' UNION ALL '.join(parts)})"


def _enum(x: str) -> str:
    return rf"regexp_replace(regexp_replace(upper(trim({x})), 'PHASE\s+', 'PHASE', 'g'), '[^A-Z0-9/]+', '_', 'g')"


def _design(x: str) -> str:
    bare = f"regexp_replace(regexp_replace({_enum(x)}, '_+$', ''), '_ASSIGNMENT$', '')"
    return f"CASE {bare} WHEN 'N/A' THEN 'NA' WHEN 'EDUCATIONAL/COUNSELING/TRAINING' THEN 'ECT' ELSE {bare} END"


def _truth(x: str) -> str:
    w = f"lower(trim({x}))"
    return f"CASE WHEN {w} IN ('t', 'true', 'yes', 'y', '1') OR starts_with({w}, 'accepts') THEN true WHEN {w} IN ('f', 'false', 'no', 'n', '0') THEN false END"


def _years(x: str) -> str:
    return rf"round(try_cast(nullif(regexp_extract({x}, '\d+(\.\d+)?'), '') AS DOUBLE) / CASE lower(regexp_extract({x}, '(?i)year|month|week|day')) WHEN 'year' THEN 1.0 WHEN 'month' THEN 12.0 WHEN 'week' THEN 52.0 WHEN 'day' THEN 365.0 END, 2)"


_LEADS = f"""leads AS (
  SELECT nct_id, name AS sponsor_name, class AS sponsor_class FROM (
    SELECT *, row_number() OVER (PARTITION BY nct_id ORDER BY name NULLS FIRST, class) AS n FROM (
      SELECT nct_id, name, CASE WHEN {_enum('agency_class')} = 'INDUSTRY' THEN 'INDUSTRY' WHEN {_enum('agency_class')} IN ('NIH', 'FED', 'OTHER_GOV', 'U_S_FED') THEN 'GOVERNMENT' ELSE 'OTHER' END AS class
      FROM sponsors WHERE lower(lead_or_collaborator) = 'lead')) WHERE n = 1
)"""
_LEVELS = "['SINGLE', 'DOUBLE', 'TRIPLE', 'QUADRUPLE']"
_FIELDS = f"""x AS (
  SELECT *, {_enum('masking')} AS word, coalesce(({_truth('subject_masked')})::INT, 0) + coalesce(({_truth('investigator_masked')})::INT, 0) AS parties FROM designs
), y AS (
  SELECT *, (word LIKE '%PARTICIPANT%')::INT + (word LIKE '%CARE_PROVIDER%')::INT + (word LIKE '%INVESTIGATOR%')::INT + (word LIKE '%OUTCOMES_ASSESSOR%')::INT AS named, regexp_extract(word, '^(SINGLE|DOUBLE|TRIPLE|QUADRUPLE)') AS lead FROM x
), z AS (
  SELECT nct_id, CASE WHEN allocation IS NULL AND {_design('intervention_model')} = 'SINGLE_GROUP' THEN 'NA' ELSE {_design('allocation')} END AS allocation,
    {_design('intervention_model')} AS intervention_model, {_design('primary_purpose')} AS primary_purpose,
    CASE WHEN word LIKE '%BLIND%' AND parties > 0 THEN {_LEVELS}[parties] WHEN regexp_matches(word, '^(NONE|OPEN_LABEL|NO_MASKING)') THEN 'NONE' WHEN lead <> '' THEN lead WHEN named > 0 THEN {_LEVELS}[named] ELSE regexp_replace(word, '_+$', '') END AS masking
  FROM y
), e AS (
  SELECT s.nct_id, {_enum('overall_status')} AS status, {_enum('phase')} AS phase, start_date::DATE AS start_date, try_cast(number_of_arms AS INT) AS number_of_arms, brief_title, {_truth('has_dmc')} AS has_dmc,
    allocation, intervention_model, primary_purpose, masking, sponsor_name, sponsor_class, why_stopped, CASE {_enum('overall_status')} WHEN 'TERMINATED' THEN 1 WHEN 'COMPLETED' THEN 0 END AS label
  FROM studies s LEFT JOIN z USING (nct_id) LEFT JOIN leads USING (nct_id)
  WHERE {_enum('study_type')} = 'INTERVENTIONAL' AND {_enum('phase')} IN ('PHASE1', 'PHASE1/PHASE2', 'PHASE2', 'PHASE2/PHASE3', 'PHASE3')
), eligible AS (
  SELECT nct_id, status, phase, start_date, number_of_arms, brief_title, has_dmc, allocation, intervention_model, primary_purpose, masking, sponsor_name, sponsor_class, label,
    CASE WHEN label = 1 THEN CASE why_stopped WHEN 'Safety concerns' THEN 'safety' WHEN 'Slow accrual' THEN 'enrollment' WHEN 'Business decision; no safety concerns' THEN 'business' END END AS stop_reason
  FROM e WHERE ((label IS NOT NULL AND start_date >= DATE '2008-01-01') OR status IN ('NOT_YET_RECRUITING', 'RECRUITING', 'ACTIVE_NOT_RECRUITING', 'ENROLLING_BY_INVITATION'))
    AND nct_id IN (SELECT nct_id FROM interventions WHERE {_enum('intervention_type')} IN ('DRUG', 'BIOLOGICAL'))
)"""
_ELIGIBLE = f"WITH {', '.join(map(_cte, ('studies', 'designs', 'sponsors', 'interventions')))}, {_LEADS}, {_FIELDS}"
_DRUGS = f"drugs AS (SELECT nct_id, id AS intervention_id, name FROM interventions WHERE {_enum('intervention_type')} IN ('DRUG', 'BIOLOGICAL') AND nct_id IN (SELECT nct_id FROM eligible))"
_SPONSORED = f"WITH {_cte('studies')}, {_cte('sponsors')}, {_LEADS}"
_HEADING = r"criteria\s*:?$"
SQL = {
    "eligible_trials": f"{_ELIGIBLE} SELECT * FROM eligible",
    "trial_drugs": f"{_ELIGIBLE}, {_DRUGS} SELECT * FROM drugs",
    "sponsor_ended": f"{_SPONSORED} SELECT nct_id, ({_enum('overall_status')} = 'TERMINATED')::INT AS terminated, start_date::DATE AS start_date, completion_date::DATE AS completion_date, sponsor_name FROM studies JOIN leads USING (nct_id) WHERE {_enum('study_type')} = 'INTERVENTIONAL' AND {_enum('overall_status')} IN ('COMPLETED', 'TERMINATED') AND completion_date IS NOT NULL",
    "sponsor_begun": f"{_SPONSORED} SELECT nct_id, start_date::DATE AS start_date, sponsor_name FROM studies JOIN leads USING (nct_id) WHERE {_enum('study_type')} = 'INTERVENTIONAL' AND {_enum('overall_status')} <> 'WITHDRAWN' AND start_date IS NOT NULL",
    "trial_attributes": f"""{_ELIGIBLE}, {', '.join(map(_cte, ('countries', 'eligibilities', 'browse_conditions', 'responsible_parties', 'keywords')))},
      geo AS (SELECT nct_id, count(DISTINCT name) AS n, bool_and(name = 'United States') AS us FROM countries GROUP BY 1), areas AS (SELECT nct_id, {', '.join(f"bool_or(mesh_term = '{t}') AS area_{k}" for k, t in S.AREAS.items())} FROM browse_conditions GROUP BY 1),
      party AS (SELECT nct_id, min({_design('responsible_party_type')}) AS party FROM responsible_parties GROUP BY 1), helpers AS (SELECT nct_id, count_if(lower(lead_or_collaborator) = 'collaborator') AS n FROM sponsors GROUP BY 1), words AS (SELECT nct_id, count(*) AS n FROM keywords GROUP BY 1)
      SELECT t.nct_id, coalesce(g.n, 0)::BIGINT AS n_countries, coalesce(us, false) AS us_only, {_years('minimum_age')} AS min_age_years, {_years('maximum_age')} AS max_age_years, {_truth('healthy_volunteers')} AS healthy_volunteers,
        CASE WHEN upper(gender) = 'BOTH' THEN 'ALL' ELSE upper(gender) END AS sex,
        CASE WHEN i.nct_id IS NOT NULL THEN len(list_filter(string_split(coalesce(criteria, ''), '~'), lambda x: trim(x) <> '' AND NOT regexp_matches(lower(trim(x)), '{_HEADING}')))::INT END AS criteria_count,
        CASE WHEN i.nct_id IS NOT NULL THEN length(coalesce(criteria, ''))::INT END AS criteria_chars, party AS responsible_party,
        {', '.join(f'coalesce(area_{k}, false) AS area_{k}' for k in S.AREAS)}, coalesce(h.n, 0)::BIGINT AS n_collaborators, coalesce(w.n, 0)::BIGINT AS n_keywords
      FROM eligible t LEFT JOIN geo g USING (nct_id) LEFT JOIN eligibilities i USING (nct_id) LEFT JOIN areas a USING (nct_id) LEFT JOIN party p USING (nct_id) LEFT JOIN helpers h USING (nct_id) LEFT JOIN words w USING (nct_id)""",
    "trial_texts": f"""{_ELIGIBLE}, {', '.join(map(_cte, ('eligibilities', 'keywords', 'brief_summaries')))}, words AS (SELECT nct_id, string_agg(name, ', ' ORDER BY name) AS words FROM keywords GROUP BY 1)
      SELECT t.nct_id, concat_ws(chr(10), coalesce(s.official_title, s.brief_title), replace(description, ' It was halted.', ' '), replace(criteria, '~', ' '), words) AS text
      FROM eligible t JOIN studies s USING (nct_id) LEFT JOIN brief_summaries USING (nct_id) LEFT JOIN eligibilities USING (nct_id) LEFT JOIN words USING (nct_id)""",
    "trials_summary": f"{_ELIGIBLE} SELECT count(label) AS labeled, round(avg(label), 6) AS termination_rate, count_if(label IS NULL)::BIGINT AS active FROM eligible",
    "drug_match_rate": f"""{_ELIGIBLE}, {_DRUGS}, m AS (SELECT DISTINCT nct_id, name AS substance FROM drugs WHERE right(name, 1) IN ('0', '4', '8')), a AS (SELECT nct_id FROM eligible WHERE label IS NOT NULL AND start_date < DATE '2021-01-01'), n AS (SELECT count(*) AS labeled_trials, (SELECT count(*) FROM a WHERE nct_id IN (SELECT nct_id FROM m)) AS matched FROM a)
      SELECT labeled_trials, matched, round(coalesce(matched / nullif(labeled_trials, 0), 0), 6) AS match_rate, (SELECT count(DISTINCT substance) FROM m) AS substances FROM n""",
}
