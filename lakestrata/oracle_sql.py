"""Independent DuckDB SQL for each registered query key.

The fixture relations are written as CTEs over the pre-registered views
(customer, nation, supplier, orders, events, ...). Each key's SQL is
``WITH <the CTEs it needs> SELECT ...``. Guards for engine differences:
integer casts only of integer-looking text (Spark's TRY_CAST of '25025.0'
to INT is NULL), sums cast to BIGINT, truncating bigint casts via trunc().
"""

from __future__ import annotations

AS_OF_TS = "TIMESTAMP '2024-06-30 00:00:00'"
AS_OF_DATE = "DATE '2024-06-30'"
RUNS_AS_OF_TS = "TIMESTAMP '2001-08-01 12:00:00'"

CTE: dict[str, str] = {}

CTE["pat_raw"] = """
SELECT
  CAST(c_custkey AS VARCHAR) AS Id,
  'ssn-' || CAST(c_custkey AS VARCHAR) AS SSN,
  CASE WHEN c_custkey % 97 = 0 THEN '' WHEN c_custkey % 89 = 0 THEN 'not-a-date'
       ELSE CAST(DATE '1930-01-01' + CAST(c_custkey * 7919 % 32000 AS INT) AS VARCHAR) END AS BIRTHDATE,
  CASE WHEN c_custkey % 11 = 0 THEN CAST(DATE '2018-01-01' + CAST(c_custkey % 2000 AS INT) AS VARCHAR) END AS DEATHDATE,
  CASE WHEN c_custkey % 53 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS GENDER,
  c_mktsegment AS RACE,
  CASE WHEN c_custkey % 5 = 0 THEN 'hispanic' ELSE 'nonhispanic' END AS ETHNICITY,
  CASE WHEN snap = 1 THEN 'S' WHEN snap = 2 THEN 'M' ELSE 'D' END AS MARITAL,
  CASE WHEN c_custkey % 3 = 0 THEN 'Dr.' END AS PREFIX,
  'First' || CAST(c_custkey AS VARCHAR) AS FIRST,
  CASE WHEN c_custkey % 4 = 0 THEN 'Mid' END AS MIDDLE,
  c_name AS LAST,
  CAST(NULL AS VARCHAR) AS SUFFIX,
  CAST(NULL AS VARCHAR) AS MAIDEN,
  CAST(c_custkey AS VARCHAR) || ' Main St' AS ADDRESS,
  'City' || CAST(c_custkey % 40 AS VARCHAR) AS CITY,
  lower(n_name) AS STATE,
  'County' || CAST(n_regionkey AS VARCHAR) AS COUNTY,
  n_name AS BIRTHPLACE,
  CASE WHEN c_custkey % 43 = 0 THEN 'bad' ELSE CAST(10000 + c_custkey % 80000 AS VARCHAR) END AS ZIP,
  CASE WHEN c_custkey % 2 = 0 THEN '25025.0' ELSE '25025' END AS FIPS,
  CASE WHEN c_custkey % 71 = 0 THEN NULL ELSE CAST(c_custkey % 90 AS VARCHAR) END AS LAT,
  CASE WHEN c_custkey % 73 = 0 THEN NULL ELSE CAST(-(c_custkey % 180) AS VARCHAR) END AS LON,
  CASE WHEN c_custkey % 41 = 0 THEN 'n/a' ELSE CAST(1000 + c_custkey * 37 % 90000 AS VARCHAR) END AS INCOME,
  CAST(c_acctbal AS VARCHAR) AS HEALTHCARE_EXPENSES,
  CAST(c_nationkey * 100 AS VARCHAR) AS HEALTHCARE_COVERAGE,
  CAST(NULL AS VARCHAR) AS DRIVERS,
  CAST(NULL AS VARCHAR) AS PASSPORT,
  CASE WHEN c_custkey % 61 = 0 THEN '{"EXTRA":"x"}' END AS _rescued_data,
  'patients' || CAST(snap AS VARCHAR) || '.csv' AS source_file,
  CASE WHEN snap = 3 THEN TIMESTAMP '2024-06-29 20:00:00' ELSE TIMESTAMP '2024-06-28 00:00:00' END AS ingestion_timestamp
FROM customer
JOIN nation ON c_nationkey = n_nationkey
CROSS JOIN (SELECT 1 AS snap UNION ALL SELECT 2 UNION ALL SELECT 3) s
WHERE snap <= 1 + c_custkey % 3
"""

CTE["obs_raw"] = """
SELECT
  ts AS obs_ts,
  CASE WHEN event_id % 211 = 0 THEN NULL
       WHEN event_id % 101 = 0 THEN CAST(user_id + 1000000 AS VARCHAR)
       ELSE CAST(user_id AS VARCHAR) END AS PATIENT,
  'enc-' || CAST(event_id % 3000 AS VARCHAR) AS ENCOUNTER,
  CASE WHEN event_type = 'purchase' THEN 'laboratory' WHEN event_id % 13 = 0 THEN 'survey' ELSE 'vital-signs' END AS CATEGORY,
  CASE event_type WHEN 'view' THEN '39156-5' WHEN 'click' THEN '8480-6' WHEN 'error' THEN '8462-4'
                  WHEN 'signup' THEN '8867-4' ELSE '8310-5' END AS CODE,
  'desc ' || event_type AS DESCRIPTION,
  CASE WHEN event_id % 10 = 0 THEN 'Never smoker' ELSE CAST(value + resend AS VARCHAR) END AS VALUE,
  CASE event_type WHEN 'view' THEN 'kg/m2' WHEN 'signup' THEN '/min' WHEN 'purchase' THEN 'degF' ELSE 'mm[Hg]' END AS UNITS,
  CASE WHEN event_id % 10 = 0 THEN 'text' ELSE 'numeric' END AS TYPE,
  CASE WHEN event_id % 307 = 0 THEN '{"EXTRA":"x"}' END AS _rescued_data,
  CASE WHEN resend = 1 THEN 'observations2.csv' ELSE 'observations1.csv' END AS source_file,
  CASE WHEN resend = 1 THEN TIMESTAMP '2024-06-29 20:00:00' ELSE TIMESTAMP '2024-06-28 00:00:00' END AS ingestion_timestamp
FROM events
CROSS JOIN (SELECT 0 AS resend UNION ALL SELECT 1) r
WHERE resend = 0 OR event_id % 15 = 1
"""

CTE["org_raw"] = """
SELECT
  CAST(s_suppkey AS VARCHAR) AS Id,
  CASE WHEN s_suppkey % 31 = 30 THEN '  ' ELSE s_name END AS NAME,
  CAST(s_suppkey AS VARCHAR) || ' High St' AS ADDRESS,
  'City' || CAST(s_suppkey % 40 AS VARCHAR) AS CITY,
  lower(n_name) AS STATE,
  CAST(10000 + s_suppkey AS VARCHAR) AS ZIP,
  CASE WHEN s_suppkey % 17 = 0 THEN NULL ELSE CAST(s_suppkey % 90 AS DOUBLE) END AS LAT,
  CAST(-(s_suppkey % 180) AS DOUBLE) AS LON,
  '(555) ' || CAST(100 + s_suppkey % 900 AS VARCHAR) || '-0199' AS PHONE,
  s_acctbal AS REVENUE,
  CAST(s_suppkey * 7 % 250 AS INT) AS UTILIZATION,
  CASE WHEN s_suppkey % 61 = 5 THEN '{"EXTRA":"x"}' END AS _rescued_data,
  'organizations1.csv' AS source_file,
  TIMESTAMP '2024-06-29 20:00:00' AS ingestion_timestamp
FROM supplier
JOIN nation ON s_nationkey = n_nationkey
"""

CTE["pat_org"] = """
SELECT CAST(c_custkey AS VARCHAR) AS Id, CAST(first_org AS VARCHAR) AS organization_id
FROM customer
LEFT JOIN (SELECT s_nationkey, MIN(s_suppkey) AS first_org FROM supplier GROUP BY s_nationkey) f
  ON c_nationkey = s_nationkey
"""

CTE["runs"] = """
SELECT
  CAST(o_orderkey AS VARCHAR) AS run_id,
  'p' || CAST(o_orderkey % 3 AS VARCHAR) AS pipeline_id,
  CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'FAILED' ELSE 'CANCELED' END AS state,
  o_orderdate AS start_time,
  o_orderdate + INTERVAL '1' MINUTE * CAST(1 + o_orderkey % 50 AS INT) AS end_time
FROM orders
"""


def int_guard(x: str) -> str:
    return f"CASE WHEN regexp_full_match(trim({x}), '[+-]?[0-9]+') THEN TRY_CAST(trim({x}) AS INTEGER) END"


def date_parse(x: str) -> str:
    return f"CAST(TRY_STRPTIME({x}, '%Y-%m-%d') AS DATE)"


def exact_sum(x: str) -> str:
    """Sum of the values taken to 9 decimals, as an integer count of 1e-9 units."""
    return f"CAST(SUM(CAST({x} AS DECIMAL(38,9))) * 1000000000 AS HUGEINT)"


def half_up(num: str, den: str, n: int) -> str:
    """num / den rounded half away from zero to n decimals (exact integer arithmetic)."""
    k = 10 ** n
    return (f"(CAST(sign({num}) * sign({den}) * ((abs({num}) * {2 * k} + abs({den})) // (2 * abs({den}))) AS DOUBLE)"
            f" / {k}.0)")


def xavg(x: str, n: int) -> str:
    """Mean from an exact decimal sum, rounded half-up in integer arithmetic."""
    big = f"CAST(SUM(CAST({x} AS DECIMAL(38,9))) * 1000000000 AS HUGEINT)"
    den = f"(COUNT({x}) * {10 ** (9 - n)})"
    return f"(CAST(sign({big}) * ((abs({big}) * 2 + {den}) // (2 * {den})) AS DOUBLE) / {10 ** n}.0)"


def sround(x: str, n: int) -> str:
    """Spark's ROUND of a double: half-up on the shortest decimal text of the value."""
    return f"CAST(ROUND(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), {n}) AS DOUBLE)"


def hours(later: str, earlier: str) -> str:
    return f"((CAST(floor(epoch({later})) AS BIGINT) - CAST(floor(epoch({earlier})) AS BIGINT)) / 3600.0)"


def age(birth: str, at: str) -> str:
    return f"CAST(date_sub('year', {birth}, {at}) AS BIGINT)"


CTE["pat"] = f"""
SELECT Id, SSN, BIRTHDATE, DEATHDATE, GENDER, RACE, ETHNICITY, MARITAL, PREFIX, FIRST, MIDDLE, LAST, SUFFIX, MAIDEN,
  ADDRESS, CITY, STATE, COUNTY, BIRTHPLACE, ZIP, FIPS, LAT, LON, INCOME, HEALTHCARE_EXPENSES, HEALTHCARE_COVERAGE,
  DRIVERS, PASSPORT,
  CASE WHEN _rescued_data IS NOT NULL OR BIRTHDATE IS NULL OR GENDER IS NULL THEN 1 ELSE 0 END AS data_quality_flag,
  {AS_OF_TS} AS processing_timestamp, {AS_OF_DATE} AS processing_date,
  source_file, ingestion_timestamp
FROM (
  SELECT * REPLACE (
    {date_parse('BIRTHDATE')} AS BIRTHDATE,
    {date_parse('DEATHDATE')} AS DEATHDATE,
    {int_guard('ZIP')} AS ZIP,
    {int_guard('FIPS')} AS FIPS,
    {int_guard('INCOME')} AS INCOME,
    TRY_CAST(LAT AS DOUBLE) AS LAT,
    TRY_CAST(LON AS DOUBLE) AS LON,
    TRY_CAST(HEALTHCARE_EXPENSES AS DOUBLE) AS HEALTHCARE_EXPENSES,
    TRY_CAST(HEALTHCARE_COVERAGE AS DOUBLE) AS HEALTHCARE_COVERAGE)
  FROM pat_raw
  QUALIFY row_number() OVER (PARTITION BY Id ORDER BY ingestion_timestamp DESC NULLS LAST, source_file DESC NULLS LAST) = 1
) t
"""

CTE["obs"] = """
SELECT observation_date, patient_id, encounter_id, observation_code, observation_description, observation_value,
  units, observation_type, category, missing_date, missing_patient, missing_value, missing_code,
  CASE WHEN missing_date = 1 OR missing_patient = 1 OR missing_value = 1 OR missing_code = 1 THEN 1 ELSE 0 END AS has_quality_issue
FROM (
  SELECT obs_ts AS observation_date, PATIENT AS patient_id, ENCOUNTER AS encounter_id, CODE AS observation_code,
    DESCRIPTION AS observation_description, TRY_CAST(VALUE AS DOUBLE) AS observation_value, UNITS AS units,
    TYPE AS observation_type, CATEGORY AS category, ingestion_timestamp AS _ingested, source_file AS _file,
    CASE WHEN obs_ts IS NULL THEN 1 ELSE 0 END AS missing_date,
    CASE WHEN PATIENT IS NULL THEN 1 ELSE 0 END AS missing_patient,
    CASE WHEN TRY_CAST(VALUE AS DOUBLE) IS NULL THEN 1 ELSE 0 END AS missing_value,
    CASE WHEN CODE IS NULL THEN 1 ELSE 0 END AS missing_code
  FROM obs_raw
  QUALIFY row_number() OVER (PARTITION BY PATIENT, obs_ts, CODE ORDER BY ingestion_timestamp DESC NULLS LAST,
    source_file DESC NULLS LAST, ENCOUNTER ASC NULLS FIRST, DESCRIPTION ASC NULLS FIRST,
    TRY_CAST(VALUE AS DOUBLE) DESC NULLS LAST, UNITS ASC NULLS FIRST, TYPE ASC NULLS FIRST, CATEGORY ASC NULLS FIRST) = 1
) t
"""

# DuckDB forms of the rule catalogue at the fixed clock (tier, name, predicate).
DUCK_RULES: dict[str, list[tuple[str, str, str]]] = {
    "bronze_patients": [
        ("fail", "valid_patient_id", "Id IS NOT NULL"),
        ("drop", "valid_birthdate", "BIRTHDATE IS NOT NULL"),
        ("drop", "valid_gender", "GENDER IN ('M', 'F')"),
        ("warn", "birthdate_in_past", f"TRY_CAST(BIRTHDATE AS DATE) <= {AS_OF_DATE}"),
        ("warn", "no_schema_drift", "_rescued_data IS NULL"),
    ],
    "bronze_organizations": [
        ("fail", "valid_org_id", "Id IS NOT NULL"),
        ("drop", "valid_org_name", "NAME IS NOT NULL AND LENGTH(TRIM(NAME)) > 0"),
        ("warn", "non_negative_revenue", "REVENUE IS NULL OR REVENUE >= 0"),
        ("warn", "no_schema_drift", "_rescued_data IS NULL"),
    ],
    "bronze_observations": [
        ("fail", "valid_patient_ref", "PATIENT IS NOT NULL"),
        ("drop", "valid_observation_date", '"DATE" IS NOT NULL'),
        ("drop", "valid_observation_code", "CODE IS NOT NULL"),
        ("warn", "has_observation_value", "VALUE IS NOT NULL"),
        ("warn", "observation_in_past", f'"DATE" <= {AS_OF_TS}'),
        ("warn", "no_schema_drift", "_rescued_data IS NULL"),
    ],
    "silver_patients": [
        ("fail", "valid_patient_id", "patient_id IS NOT NULL"),
        ("drop", "valid_birthdate_range", f"birth_date >= DATE '1900-01-01' AND birth_date <= {AS_OF_DATE}"),
        ("warn", "has_name", "first_name IS NOT NULL AND last_name IS NOT NULL"),
        ("warn", "valid_gender", "gender IN ('M', 'F')"),
        ("warn", "valid_state", "state IS NOT NULL"),
    ],
    "silver_organizations": [
        ("fail", "valid_org_id", "organization_id IS NOT NULL"),
        ("fail", "valid_org_name", "organization_name IS NOT NULL"),
    ],
    "silver_observations": [
        ("fail", "valid_patient_reference", "patient_id IS NOT NULL"),
        ("drop", "valid_observation_date", f"observation_timestamp IS NOT NULL AND observation_timestamp <= {AS_OF_TS}"),
    ],
}


def passes(table: str, tiers: tuple[str, ...]) -> str:
    return " AND ".join(f"COALESCE(({p}), false)" for t, _, p in DUCK_RULES[table] if t in tiers)


CTE["pat_unchecked"] = f"""
SELECT Id AS patient_id, concat_ws(' ', PREFIX, FIRST, MIDDLE, LAST) AS full_name, FIRST AS first_name, LAST AS last_name,
  GENDER AS gender, {date_parse('BIRTHDATE')} AS birth_date, {age(date_parse('BIRTHDATE'), AS_OF_DATE)} AS age,
  RACE AS race, ETHNICITY AS ethnicity, MARITAL AS marital_status, ADDRESS AS address, CITY AS city,
  upper(STATE) AS state, ZIP AS zip_code, LAT AS latitude, LON AS longitude,
  HEALTHCARE_EXPENSES AS healthcare_expenses, HEALTHCARE_COVERAGE AS healthcare_coverage, INCOME AS income,
  ingestion_timestamp AS silver_timestamp, source_file
FROM pat_raw
QUALIFY row_number() OVER (PARTITION BY Id ORDER BY ingestion_timestamp DESC NULLS LAST, source_file DESC NULLS LAST) = 1
"""

CTE["org_unchecked"] = """
SELECT Id AS organization_id, NAME AS organization_name, ADDRESS AS address, CITY AS city, upper(STATE) AS state,
  ZIP AS zip_code, LAT AS latitude, LON AS longitude, regexp_replace(PHONE, '[^0-9]', '', 'g') AS phone,
  REVENUE AS revenue, UTILIZATION AS utilization, COALESCE(UTILIZATION > 100, false) AS high_utilization_flag,
  ingestion_timestamp AS silver_timestamp
FROM org_raw
"""

CTE["obs_unchecked"] = """
SELECT obs_ts AS observation_timestamp, CAST(obs_ts AS DATE) AS observation_date, PATIENT AS patient_id,
  ENCOUNTER AS encounter_id, lower(CATEGORY) AS category,
  CASE WHEN contains(lower(CATEGORY), 'vital') THEN 'vital_signs' WHEN contains(lower(CATEGORY), 'lab') THEN 'laboratory'
       ELSE 'other' END AS observation_type,
  CODE AS loinc_code, DESCRIPTION AS description, VALUE AS value_raw,
  CASE WHEN TYPE = 'numeric' THEN TRY_CAST(VALUE AS DOUBLE) END AS numeric_value,
  UNITS AS units, TYPE AS value_type, ingestion_timestamp AS silver_timestamp
FROM obs_raw
"""

for _name, _rules in (("pat_pipeline", "silver_patients"), ("org_silver", "silver_organizations"), ("obs_pipeline", "silver_observations")):
    CTE[_name] = f"SELECT * FROM {_name.split('_')[0]}_unchecked WHERE {passes(_rules, ('fail', 'drop'))}"

CTE["g1"] = """
SELECT GENDER, RACE, ETHNICITY, MARITAL, STATE, COUNTY, COUNT(Id) AS patient_count, COUNT(DISTINCT Id) AS unique_patients,
  AVG(INCOME) AS avg_income, MIN(BIRTHDATE) AS oldest_birthdate, MAX(BIRTHDATE) AS youngest_birthdate,
  COUNT(*) FILTER (WHERE DEATHDATE IS NOT NULL) AS deceased_count
FROM pat GROUP BY GENDER, RACE, ETHNICITY, MARITAL, STATE, COUNTY
"""

CTE["g2"] = f"""
SELECT GENDER, STATE, COUNT(Id) AS patient_count, AVG(INCOME) AS avg_income, MIN(INCOME) AS min_income,
  MAX(INCOME) AS max_income, STDDEV_SAMP(INCOME) AS stddev_income,
  AVG(HEALTHCARE_EXPENSES) AS avg_healthcare_expenses, SUM(HEALTHCARE_EXPENSES) AS total_healthcare_expenses,
  MIN(HEALTHCARE_EXPENSES) AS min_healthcare_expenses, MAX(HEALTHCARE_EXPENSES) AS max_healthcare_expenses,
  AVG(HEALTHCARE_COVERAGE) AS avg_healthcare_coverage, SUM(HEALTHCARE_COVERAGE) AS total_healthcare_coverage,
  COUNT(*) FILTER (WHERE data_quality_flag = 1) AS quality_issues_count,
  {half_up(f"{exact_sum('HEALTHCARE_EXPENSES')} * COUNT(INCOME)", f"NULLIF({exact_sum('INCOME')}, 0) * COUNT(HEALTHCARE_EXPENSES)", 4)} AS expense_to_income_ratio,
  {half_up(f"{exact_sum('HEALTHCARE_EXPENSES')} * COUNT(HEALTHCARE_COVERAGE) - {exact_sum('HEALTHCARE_COVERAGE')} * COUNT(HEALTHCARE_EXPENSES)", "COUNT(HEALTHCARE_EXPENSES) * COUNT(HEALTHCARE_COVERAGE) * 1000000000", 2)} AS coverage_gap
FROM pat GROUP BY GENDER, STATE
"""

CTE["g3"] = f"""
SELECT GENDER, RACE, patient_status, COUNT(Id) AS patient_count,
  AVG(current_age) AS avg_current_age, MIN(current_age) AS min_current_age, MAX(current_age) AS max_current_age,
  AVG(age_at_death) AS avg_age_at_death, MIN(age_at_death) AS min_age_at_death, MAX(age_at_death) AS max_age_at_death,
  STDDEV_SAMP(age_at_death) AS stddev_age_at_death
FROM (
  SELECT *, CASE WHEN DEATHDATE IS NULL THEN {age('BIRTHDATE', AS_OF_DATE)} END AS current_age,
    CASE WHEN DEATHDATE IS NOT NULL THEN {age('BIRTHDATE', 'DEATHDATE')} END AS age_at_death,
    CASE WHEN DEATHDATE IS NOT NULL THEN 'deceased' ELSE 'living' END AS patient_status
  FROM pat) t
GROUP BY GENDER, RACE, patient_status
"""

CTE["g4"] = f"""
SELECT COUNT(*) AS total_records, COUNT(DISTINCT Id) AS unique_patients,
  COUNT(*) FILTER (WHERE data_quality_flag = 1) AS quality_issues,
  COUNT(*) FILTER (WHERE data_quality_flag = 0) AS clean_records,
  COUNT(*) FILTER (WHERE BIRTHDATE IS NULL) AS missing_birthdate,
  COUNT(*) FILTER (WHERE GENDER IS NULL) AS missing_gender,
  COUNT(*) FILTER (WHERE RACE IS NULL) AS missing_race,
  COUNT(*) FILTER (WHERE INCOME IS NULL) AS missing_income,
  COUNT(*) FILTER (WHERE HEALTHCARE_EXPENSES IS NULL) AS missing_expenses,
  COUNT(*) FILTER (WHERE HEALTHCARE_COVERAGE IS NULL) AS missing_coverage,
  COUNT(*) FILTER (WHERE LAT IS NULL) AS missing_lat,
  COUNT(*) FILTER (WHERE LON IS NULL) AS missing_lon,
  MIN(processing_timestamp) AS earliest_processing_timestamp,
  MAX(processing_timestamp) AS latest_processing_timestamp,
  {sround('CAST(COUNT(*) FILTER (WHERE data_quality_flag = 0) AS DOUBLE) / NULLIF(COUNT(*), 0) * 100.0', 2)} AS overall_completeness_pct
FROM pat
"""

CTE["overview"] = """
SELECT a.patient_id, p.patient_name, o.organization_name, a.total_observations, a.first_observation_date,
  a.most_recent_observation_date
FROM (SELECT patient_id, COUNT(*) AS total_observations, MIN(observation_date) AS first_observation_date,
        MAX(observation_date) AS most_recent_observation_date
      FROM obs WHERE patient_id IS NOT NULL GROUP BY patient_id) a
LEFT JOIN (SELECT Id AS patient_id, concat_ws(' ', FIRST, LAST) AS patient_name FROM pat) p ON a.patient_id = p.patient_id
LEFT JOIN (SELECT m.Id AS patient_id, s.organization_name FROM pat_org m
           LEFT JOIN org_silver s ON m.organization_id = s.organization_id) o ON a.patient_id = o.patient_id
"""

# Dependencies between CTEs (emitted in this order).
DEPS: dict[str, list[str]] = {
    "pat_raw": [], "obs_raw": [], "org_raw": [], "pat_org": [], "runs": [],
    "pat": ["pat_raw"], "obs": ["obs_raw"], "pat_unchecked": ["pat_raw"], "org_unchecked": ["org_raw"],
    "obs_unchecked": ["obs_raw"], "pat_pipeline": ["pat_unchecked"], "org_silver": ["org_unchecked"],
    "obs_pipeline": ["obs_unchecked"],
    "g1": ["pat"], "g2": ["pat"], "g3": ["pat"], "g4": ["pat"],
    "overview": ["obs", "pat", "pat_org", "org_silver"],
}


def with_ctes(names: list[str], body: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        for dep in DEPS.get(n, []):
            visit(dep)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body
    ctes = ",\n".join(f"{n} AS ({CTE[n]})" for n in order)
    return f"WITH {ctes}\n{body}"


SQL: dict[str, str] = {}


def sql(key: str, uses: list[str], body: str) -> None:
    SQL[key] = with_ctes(uses, body)


# --- silver ----------------------------------------------------------------
sql("silver_patients_pipeline", ["pat_pipeline"], "SELECT * FROM pat_pipeline")
sql("silver_patients_batch", ["pat"], "SELECT * EXCLUDE (processing_timestamp, processing_date) FROM pat")
sql("silver_organizations", ["org_silver"], "SELECT * FROM org_silver")
sql("silver_observations_pipeline", ["obs_pipeline"], "SELECT * FROM obs_pipeline")
sql("silver_observations_batch", ["obs"], "SELECT * FROM obs")
sql("silver_observation_summary", ["obs"], f"""
SELECT COUNT(*) AS total_observations, COUNT(DISTINCT patient_id) AS unique_patients,
  COUNT(DISTINCT observation_code) AS unique_observation_types, CAST(SUM(has_quality_issue) AS BIGINT) AS quality_issues,
  {xavg('observation_value', 2)} AS avg_value FROM obs""")
sql("silver_observation_type_breakdown", ["obs"], """
SELECT observation_type, COUNT(*) AS count FROM obs GROUP BY observation_type ORDER BY count DESC, observation_type""")
sql("silver_patient_verification", ["pat"], """
SELECT COUNT(*) AS total_patients, COUNT(DISTINCT Id) AS unique_ids,
  COUNT(*) FILTER (WHERE data_quality_flag = 1) AS quality_issues FROM pat""")
sql("silver_patient_summary", ["pat"], """
SELECT 'Total Patients' AS metric, COUNT(*) AS value FROM pat
UNION ALL SELECT 'Deceased Patients', COUNT(*) FROM pat WHERE DEATHDATE IS NOT NULL
UNION ALL SELECT 'Quality Issues', COUNT(*) FROM pat WHERE data_quality_flag = 1
UNION ALL SELECT 'Avg Healthcare Expenses', CAST(trunc(AVG(HEALTHCARE_EXPENSES)) AS BIGINT) FROM pat
UNION ALL SELECT 'Avg Income', CAST(trunc(AVG(INCOME)) AS BIGINT) FROM pat""")

# --- gold ------------------------------------------------------------------
sql("gold_demographics", ["g1"], "SELECT * FROM g1")
sql("gold_financial", ["g2"], "SELECT * FROM g2")
sql("gold_lifetime", ["g3"], "SELECT * FROM g3")
sql("gold_quality", ["g4"], "SELECT * FROM g4")
sql("gold_clinical_summary", ["obs", "pat"], f"""
SELECT a.*, p.GENDER, p.RACE, p.ETHNICITY, p.STATE, p.COUNTY, p.BIRTHDATE, p.DEATHDATE, p.current_age,
  CASE WHEN a.observation_span_days > 0 THEN {sround('a.total_observations / (a.observation_span_days / 365.25)', 2)}
       ELSE CAST(a.total_observations AS DOUBLE) END AS observations_per_year,
  CASE WHEN p.DEATHDATE IS NULL THEN 'Living' ELSE 'Deceased' END AS patient_status
FROM (
  SELECT patient_id, COUNT(*) AS total_observations, COUNT(DISTINCT observation_code) AS unique_observation_types,
    COUNT(DISTINCT observation_type) AS unique_observation_categories,
    MIN(observation_date) AS first_observation_date, MAX(observation_date) AS last_observation_date,
    CAST(datediff('day', CAST(MIN(observation_date) AS DATE), CAST(MAX(observation_date) AS DATE)) AS INTEGER) AS observation_span_days,
    COUNT(*) FILTER (WHERE observation_type = 'numeric') AS numeric_observations,
    COUNT(*) FILTER (WHERE observation_type = 'text') AS text_observations,
    COUNT(*) FILTER (WHERE category = 'vital-signs') AS vital_sign_observations,
    CAST(SUM(has_quality_issue) AS BIGINT) AS observation_quality_issues
  FROM obs GROUP BY patient_id) a
LEFT JOIN (SELECT Id AS patient_id, GENDER, RACE, ETHNICITY, STATE, COUNTY, BIRTHDATE, DEATHDATE,
             {age('BIRTHDATE', AS_OF_DATE)} AS current_age FROM pat) p
  ON a.patient_id = p.patient_id""")
sql("gold_vital_signs", ["obs", "pat"], f"""
SELECT GENDER, age_group, observation_code, observation_description, units,
  COUNT(*) AS observation_count, COUNT(DISTINCT patient_id) AS patient_count,
  {xavg('observation_value', 2)} AS avg_value, {sround('MIN(observation_value)', 2)} AS min_value,
  {sround('MAX(observation_value)', 2)} AS max_value, {sround('STDDEV_SAMP(observation_value)', 2)} AS stddev_value,
  {sround('quantile_disc(observation_value, 0.25)', 2)} AS p25_value,
  {sround('quantile_disc(observation_value, 0.5)', 2)} AS median_value,
  {sround('quantile_disc(observation_value, 0.75)', 2)} AS p75_value
FROM (
  SELECT o.*, p.GENDER,
    CASE WHEN p.age < 18 THEN '0-17' WHEN p.age < 35 THEN '18-34' WHEN p.age < 50 THEN '35-49'
         WHEN p.age < 65 THEN '50-64' ELSE '65+' END AS age_group
  FROM obs o JOIN (SELECT Id AS patient_id, GENDER, {age('BIRTHDATE', AS_OF_DATE)} AS age FROM pat) p
    ON o.patient_id = p.patient_id
  WHERE o.category = 'vital-signs' AND o.observation_value IS NOT NULL) t
GROUP BY GENDER, age_group, observation_code, observation_description, units""")
sql("gold_observation_types", ["obs", "pat"], f"""
SELECT *, {sround('CAST(total_observations AS DOUBLE) / NULLIF(unique_patients, 0)', 1)} AS observations_per_patient,
  {sround('CAST(unique_patients AS DOUBLE) / NULLIF((SELECT COUNT(*) FROM pat), 0) * 100.0', 1)} AS patient_coverage_pct,
  {sround('CAST(non_null_values AS DOUBLE) / NULLIF(total_observations, 0) * 100.0', 1)} AS value_completeness_pct
FROM (
  SELECT category, observation_code, observation_description, observation_type, units,
    COUNT(*) AS total_observations, COUNT(DISTINCT patient_id) AS unique_patients,
    MIN(observation_date) AS first_recorded, MAX(observation_date) AS last_recorded,
    {xavg('observation_value', 2)} AS avg_value,
    COUNT(*) FILTER (WHERE observation_value IS NOT NULL) AS non_null_values
  FROM obs GROUP BY category, observation_code, observation_description, observation_type, units) t
ORDER BY total_observations DESC""")
sql("gold_risk_indicators", ["obs", "pat"], f"""
SELECT o.patient_id, p.GENDER, p.age, p.RACE, p.STATE, risk_flag, observation_code, observation_description,
  COUNT(*) AS risk_occurrence_count, {xavg('observation_value', 2)} AS avg_risk_value,
  {sround('MIN(observation_value)', 2)} AS min_value, {sround('MAX(observation_value)', 2)} AS max_value,
  MAX(observation_date) AS last_risk_observation_date, MIN(units) AS units,
  CASE WHEN COUNT(*) >= 10 THEN 'High' WHEN COUNT(*) >= 5 THEN 'Medium' ELSE 'Low' END AS risk_severity
FROM (
  SELECT *, CASE
    WHEN observation_code = '39156-5' AND (observation_value < 18.5 OR observation_value > 30) THEN 'BMI Abnormal'
    WHEN observation_code = '8480-6' AND (observation_value < 90 OR observation_value > 140) THEN 'Blood Pressure High/Low'
    WHEN observation_code = '8462-4' AND (observation_value < 60 OR observation_value > 90) THEN 'Blood Pressure High/Low'
    WHEN observation_code = '8867-4' AND (observation_value < 60 OR observation_value > 100) THEN 'Heart Rate Abnormal'
    WHEN observation_code = '8310-5' AND (observation_value < 97 OR observation_value > 99.5) THEN 'Temperature Abnormal'
  END AS risk_flag
  FROM obs WHERE observation_value IS NOT NULL) o
JOIN (SELECT Id AS patient_id, GENDER, RACE, STATE, {age('BIRTHDATE', AS_OF_DATE)} AS age FROM pat) p
  ON o.patient_id = p.patient_id
WHERE risk_flag IS NOT NULL
GROUP BY o.patient_id, p.GENDER, p.age, p.RACE, p.STATE, risk_flag, observation_code, observation_description""")
sql("gold_patient_overview", ["overview"], "SELECT * FROM overview")
sql("org_rollup", ["overview"], """
SELECT organization_name, COUNT(DISTINCT patient_id) AS patient_count, CAST(SUM(total_observations) AS BIGINT) AS total_obs
FROM overview WHERE organization_name IS NOT NULL GROUP BY organization_name ORDER BY patient_count DESC""")
sql("verify_demographics", ["g1"], f"""
SELECT GENDER, STATE, CAST(SUM(patient_count) AS BIGINT) AS total_patients, {sround('AVG(avg_income)', 0)} AS avg_income,
  CAST(SUM(deceased_count) AS BIGINT) AS deceased
FROM g1 GROUP BY GENDER, STATE ORDER BY total_patients DESC, GENDER NULLS FIRST, STATE NULLS FIRST LIMIT 10""")
sql("verify_financial", ["g2"], f"""
SELECT GENDER, STATE, patient_count, {sround('avg_income', 0)} AS avg_income, {sround('avg_healthcare_expenses', 0)} AS avg_expenses,
  expense_to_income_ratio, {sround('coverage_gap', 0)} AS coverage_gap
FROM g2 ORDER BY patient_count DESC, GENDER NULLS FIRST, STATE NULLS FIRST LIMIT 10""")
sql("verify_lifetime", ["g3"], f"""
SELECT GENDER, RACE, patient_status, patient_count, {sround('avg_current_age', 1)} AS avg_age,
  {sround('avg_age_at_death', 1)} AS avg_age_at_death FROM g3 ORDER BY patient_count DESC""")
sql("verify_quality", ["g4"], """
SELECT total_records, unique_patients, quality_issues, clean_records, overall_completeness_pct, missing_birthdate,
  missing_gender, missing_income FROM g4""")


# --- F: scalar functions ---------------------------------------------------
sql("fn_parse_date", ["pat_raw"], f"""
SELECT Id, source_file, BIRTHDATE, {date_parse('BIRTHDATE')} AS birth_date, {date_parse('DEATHDATE')} AS death_date FROM pat_raw""")
sql("fn_to_date", ["obs_raw"], "SELECT PATIENT, CODE, source_file, obs_ts, CAST(obs_ts AS DATE) AS obs_date FROM obs_raw")
sql("fn_try_int", ["pat_raw"], f"""
SELECT Id, source_file, {int_guard('ZIP')} AS zip, {int_guard('FIPS')} AS fips, {int_guard('INCOME')} AS income FROM pat_raw""")
sql("fn_try_double", ["pat_raw"], """
SELECT Id, source_file, TRY_CAST(LAT AS DOUBLE) AS lat, TRY_CAST(LON AS DOUBLE) AS lon,
  TRY_CAST(HEALTHCARE_EXPENSES AS DOUBLE) AS expenses, TRY_CAST(INCOME AS DOUBLE) AS income FROM pat_raw""")
sql("fn_cast_guarded", ["obs_raw"], """
SELECT PATIENT, obs_ts, CODE, source_file, VALUE, TYPE,
  CASE WHEN TYPE = 'numeric' THEN TRY_CAST(VALUE AS DOUBLE) END AS numeric_value FROM obs_raw""")
sql("fn_cast_bigint", ["pat"], """
SELECT STATE, CAST(trunc(AVG(HEALTHCARE_EXPENSES)) AS BIGINT) AS avg_expenses_int,
  CAST(trunc(AVG(INCOME)) AS BIGINT) AS avg_income_int FROM pat GROUP BY STATE""")
sql("fn_age_years", ["pat"], f"""
SELECT Id, BIRTHDATE, DEATHDATE, {age('BIRTHDATE', AS_OF_DATE)} AS age, {age('BIRTHDATE', 'DEATHDATE')} AS age_at_death FROM pat""")
sql("fn_datediff_days", ["obs_raw"], """
SELECT PATIENT, obs_ts, CODE, source_file,
  CAST(datediff('day', CAST(obs_ts AS DATE), CAST(ingestion_timestamp AS DATE)) AS INTEGER) AS days_to_ingest FROM obs_raw""")
sql("fn_hours_between", ["obs_raw"], f"""
SELECT PATIENT, obs_ts, CODE, source_file, {sround(hours('ingestion_timestamp', 'obs_ts'), 2)} AS hours_to_ingest FROM obs_raw""")
sql("fn_hours_whole", ["obs_raw"], """
SELECT PATIENT, obs_ts, CODE, source_file, date_sub('hour', obs_ts, ingestion_timestamp) AS whole_hours FROM obs_raw""")
sql("fn_year", ["pat"], "SELECT Id, BIRTHDATE, CAST(year(BIRTHDATE) AS INTEGER) AS birth_year FROM pat")
sql("fn_now", ["pat_raw"], f"SELECT Id, source_file, {AS_OF_TS} AS processing_timestamp, {AS_OF_DATE} AS processing_date FROM pat_raw")
sql("fn_upper_lower", ["org_raw"], "SELECT Id, upper(STATE) AS state, lower(NAME) AS name_lower FROM org_raw")
sql("fn_digits_only", ["org_raw"], "SELECT Id, PHONE, regexp_replace(PHONE, '[^0-9]', '', 'g') AS phone_digits FROM org_raw")
sql("fn_concat_ws", ["pat_raw"], "SELECT Id, source_file, concat_ws(' ', PREFIX, FIRST, MIDDLE, LAST) AS full_name FROM pat_raw")
sql("fn_contains", ["obs_raw"], """
SELECT PATIENT, obs_ts, CODE, source_file, CATEGORY, contains(CATEGORY, 'vital') AS is_vital, contains(CATEGORY, 'lab') AS is_lab
FROM obs_raw""")
sql("fn_trim_length", ["org_raw"], "SELECT Id, NAME, (NAME IS NOT NULL AND length(trim(NAME)) > 0) AS name_present FROM org_raw")
sql("fn_round", ["obs"], f"""
SELECT patient_id, observation_date, observation_code, {sround('observation_value', 1)} AS value_r1,
  {sround('observation_value / 3', 2)} AS third_r2 FROM obs""")
sql("fn_floor", ["pat"], """
SELECT Id, CAST(floor(LAT / 7) AS BIGINT) AS lat_band, CAST(floor(HEALTHCARE_EXPENSES) AS BIGINT) AS expenses_floor FROM pat""")
sql("fn_null_tests", ["pat"], """
SELECT Id, BIRTHDATE IS NULL AS birthdate_missing, GENDER IS NOT NULL AS gender_present, INCOME IS NULL AS income_missing FROM pat""")
sql("fn_boolean_logic", ["obs"], """
SELECT patient_id, observation_date, observation_code,
  ((observation_value > 100 AND category = 'vital-signs') OR observation_type = 'text') AS flagged,
  (NOT (observation_value < 50)) AS not_low FROM obs""")
sql("fn_between_dates", ["pat"], f"""
SELECT Id, BIRTHDATE, (BIRTHDATE >= DATE '1900-01-01' AND BIRTHDATE <= {AS_OF_DATE}) AS birth_in_range FROM pat""")
sql("fn_flag", ["org_raw"], """
SELECT Id, UTILIZATION, CASE WHEN UTILIZATION > 100 THEN 1 ELSE 0 END AS high_util_int,
  COALESCE(UTILIZATION > 100, false) AS high_util_bool FROM org_raw""")

# --- P: projections and filters -------------------------------------------
sql("project_rename", ["org_raw"], """
SELECT Id AS organization_id, NAME AS organization_name, CITY AS city, REVENUE AS revenue FROM org_raw""")
sql("derive_column", ["obs_raw"], "SELECT * EXCLUDE (_rescued_data) REPLACE (lower(CATEGORY) AS CATEGORY) FROM obs_raw")
sql("derive_columns", ["obs_raw"], """
SELECT PATIENT, obs_ts, CODE, source_file, VALUE,
  CASE WHEN PATIENT IS NULL THEN 1 ELSE 0 END AS missing_patient,
  CASE WHEN TRY_CAST(VALUE AS DOUBLE) IS NULL THEN 1 ELSE 0 END AS missing_value,
  CASE WHEN CODE IS NULL THEN 1 ELSE 0 END AS missing_code FROM obs_raw""")
sql("drop_column", ["pat_raw"], "SELECT * EXCLUDE (_rescued_data, SUFFIX, MAIDEN, DRIVERS, PASSPORT) FROM pat_raw")
sql("filter_rows", ["obs"], "SELECT * FROM obs WHERE category = 'vital-signs' AND observation_value IS NOT NULL")
sql("filter_in_set", ["pat_raw"], "SELECT Id, source_file, GENDER FROM pat_raw WHERE GENDER IN ('M', 'F')")
sql("filter_threshold", ["overview"], "SELECT * FROM overview WHERE total_observations > 20")
sql("case_banding", ["pat"], f"""
SELECT Id, age, CASE WHEN age < 18 THEN '0-17' WHEN age < 35 THEN '18-34' WHEN age < 50 THEN '35-49'
  WHEN age < 65 THEN '50-64' ELSE '65+' END AS age_group
FROM (SELECT Id, {age('BIRTHDATE', AS_OF_DATE)} AS age FROM pat) t""")
sql("scalar_subquery", ["pat_raw", "pat_pipeline"], """
SELECT (SELECT COUNT(*) FROM pat_raw) AS bronze_count, (SELECT COUNT(*) FROM pat_pipeline) AS silver_count,
  (SELECT COUNT(*) FROM pat_raw) - (SELECT COUNT(*) FROM pat_pipeline) AS duplicates_removed""")
sql("constant_column", ["pat"], "SELECT 'silver' AS layer, 'patients' AS entity, Id FROM pat")

# --- A: aggregations -------------------------------------------------------
sql("agg_global", [], """
SELECT COUNT(*) AS row_count, SUM(l_quantity) AS sum_qty, AVG(l_extendedprice) AS avg_price,
  MIN(l_shipdate) AS first_ship, MAX(l_shipdate) AS last_ship FROM lineitem""")
sql("agg_grouped", [], """
SELECT l_returnflag, l_linestatus, SUM(l_quantity) AS sum_qty, SUM(l_extendedprice) AS sum_base_price,
  SUM(l_extendedprice * (1 - l_discount)) AS sum_disc_price, AVG(l_quantity) AS avg_qty, AVG(l_discount) AS avg_disc,
  COUNT(*) AS count_order FROM lineitem GROUP BY l_returnflag, l_linestatus""")
sql("agg_count", ["obs"], """
SELECT COUNT(*) AS rows, COUNT(observation_value) AS values_present, COUNT(patient_id) AS patients_present FROM obs""")
sql("agg_count_distinct", ["obs"], """
SELECT observation_code, COUNT(DISTINCT patient_id) AS unique_patients, COUNT(DISTINCT encounter_id) AS unique_encounters
FROM obs GROUP BY observation_code""")
sql("agg_min_max", [], """
SELECT o_orderpriority, MIN(o_totalprice) AS min_price, MAX(o_totalprice) AS max_price, MIN(o_orderdate) AS first_order,
  MAX(o_orderdate) AS last_order FROM orders GROUP BY o_orderpriority""")
sql("agg_avg_sum", [], """
SELECT o_orderstatus, AVG(o_totalprice) AS avg_price, SUM(o_totalprice) AS total_price FROM orders GROUP BY o_orderstatus""")
sql("agg_stddev", [], """
SELECT l_returnflag, STDDEV_SAMP(l_quantity) AS stddev_qty, STDDEV_SAMP(l_discount) AS stddev_disc FROM lineitem GROUP BY l_returnflag""")
sql("agg_conditional_sum", ["obs"], """
SELECT category, CAST(SUM(CASE WHEN observation_type = 'numeric' THEN 1 ELSE 0 END) AS BIGINT) AS numeric_rows,
  COUNT(*) FILTER (WHERE observation_type = 'text') AS text_rows,
  COUNT(*) FILTER (WHERE has_quality_issue = 1) AS issue_rows FROM obs GROUP BY category""")
sql("agg_percentile", [], """
SELECT l_linestatus, quantile_disc(l_extendedprice, 0.25) AS p25, quantile_disc(l_extendedprice, 0.5) AS median,
  quantile_disc(l_extendedprice, 0.75) AS p75 FROM lineitem GROUP BY l_linestatus""")
sql("agg_first", ["obs"], "SELECT observation_code, MIN(units) AS units FROM obs GROUP BY observation_code")
sql("agg_span_days", ["obs"], """
SELECT patient_id, CAST(datediff('day', CAST(MIN(observation_date) AS DATE), CAST(MAX(observation_date) AS DATE)) AS INTEGER) AS span_days
FROM obs GROUP BY patient_id""")
sql("agg_ratio_post", ["pat"], f"""
SELECT STATE, {sround('AVG(HEALTHCARE_EXPENSES) / NULLIF(AVG(INCOME), 0)', 4)} AS expense_to_income,
  {sround('CAST(COUNT(*) FILTER (WHERE data_quality_flag = 0) AS DOUBLE) / NULLIF(COUNT(*), 0) * 100.0', 2)} AS clean_pct
FROM pat GROUP BY STATE""")
sql("agg_value_counts", ["obs"], "SELECT observation_type, COUNT(*) AS count FROM obs GROUP BY observation_type ORDER BY count DESC")
sql("agg_having", ["pat_raw"], "SELECT Id, COUNT(*) AS duplicate_count FROM pat_raw GROUP BY Id HAVING COUNT(*) > 1")
sql("agg_reaggregate", ["g1"], """
SELECT GENDER, STATE, CAST(SUM(patient_count) AS BIGINT) AS total_patients, AVG(avg_income) AS avg_of_avg_income
FROM g1 GROUP BY GENDER, STATE""")
sql("agg_distinct_rows", ["obs_raw"], """
SELECT (SELECT COUNT(*) FROM (SELECT DISTINCT CATEGORY FROM obs_raw)) AS distinct_categories,
  (SELECT COUNT(*) FROM (SELECT DISTINCT PATIENT FROM obs_raw)) AS distinct_patients""")

# --- J: joins --------------------------------------------------------------
sql("join_inner", ["obs", "pat"], """
SELECT o.patient_id, o.observation_date, o.observation_code, o.observation_value, p.GENDER, p.STATE
FROM obs o JOIN pat p ON o.patient_id = p.Id""")
sql("join_left_agg", ["obs", "pat"], """
SELECT a.patient_id, a.n_obs, p.GENDER, p.STATE
FROM (SELECT patient_id, COUNT(*) AS n_obs FROM obs GROUP BY patient_id) a LEFT JOIN pat p ON a.patient_id = p.Id""")
sql("join_semi_in", ["pat_raw"], """
SELECT Id, source_file, MARITAL FROM pat_raw WHERE Id IN (SELECT Id FROM pat_raw GROUP BY Id HAVING COUNT(*) > 1)""")

# --- W: windows ------------------------------------------------------------
sql("dedup_latest", ["pat_raw"], """
SELECT Id, source_file, MARITAL, ingestion_timestamp FROM pat_raw
QUALIFY row_number() OVER (PARTITION BY Id ORDER BY ingestion_timestamp DESC NULLS LAST, source_file DESC NULLS LAST) = 1""")
sql("dedup_composite", [], """
SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
  l_returnflag, l_linestatus FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS LAST,
  l_partkey NULLS FIRST, l_suppkey NULLS FIRST, l_quantity NULLS FIRST, l_extendedprice NULLS FIRST,
  l_discount NULLS FIRST, l_tax NULLS FIRST, l_returnflag NULLS FIRST, l_linestatus NULLS FIRST) = 1""")
sql("duplicate_rank", ["pat_raw"], """
SELECT Id, FIRST, LAST, BIRTHDATE, source_file, ingestion_timestamp,
  row_number() OVER (PARTITION BY Id ORDER BY ingestion_timestamp DESC NULLS LAST, source_file DESC NULLS LAST) AS dup_rank
FROM pat_raw WHERE Id IN (SELECT Id FROM pat_raw GROUP BY Id HAVING COUNT(*) > 1)""")
sql("dedup_stats", ["pat_raw", "pat"], f"""
SELECT b AS total_records, a AS unique_records, b - a AS duplicates_removed,
  {sround('CAST(b - a AS DOUBLE) / NULLIF(b, 0) * 100.0', 2)} AS duplicate_pct
FROM (SELECT (SELECT COUNT(*) FROM pat_raw) AS b, (SELECT COUNT(*) FROM pat) AS a) t""")

# --- L: sort and limit -----------------------------------------------------
sql("sort_desc", ["obs"], "SELECT observation_code, COUNT(*) AS n FROM obs GROUP BY observation_code ORDER BY n DESC, observation_code")
sql("top_k", ["overview"], "SELECT * FROM overview ORDER BY total_observations DESC, patient_id LIMIT 10")
sql("limit_sample", ["pat"], "SELECT Id, FIRST, LAST, BIRTHDATE, INCOME FROM pat ORDER BY Id LIMIT 5")

# --- U: set operations -----------------------------------------------------
sql("union_all_metrics", ["pat_pipeline", "org_silver", "obs_pipeline"], """
SELECT 'Patients' AS entity, COUNT(*) AS record_count, COUNT(DISTINCT patient_id) AS unique_keys,
  MAX(silver_timestamp) AS latest_refresh FROM pat_pipeline
UNION ALL SELECT 'Organizations', COUNT(*), COUNT(DISTINCT organization_id), MAX(silver_timestamp) FROM org_silver
UNION ALL SELECT 'Observations', COUNT(*), COUNT(DISTINCT patient_id), MAX(silver_timestamp) FROM obs_pipeline""")
sql("distinct_values", ["obs_raw"], "SELECT DISTINCT CATEGORY FROM obs_raw")
_misfit = {"BIRTHDATE": "TRY_CAST(BIRTHDATE AS DATE)", "LAT": "TRY_CAST(LAT AS DOUBLE)", "INCOME": int_guard("INCOME")}
sql("schema_diff", ["pat_raw"], "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, {want} AS expected_type, {have} AS actual_type, "
    f"{f'COUNT({c})' if have != 'NULL' else 'COUNT(NULL)'} AS value_count, {m} AS misfit_count, {status} AS status FROM pat_raw"
    for c, want, have, m, status in [
        ("Id", "'string'", "'string'", "0", "'OK'"), ("GENDER", "NULL", "'string'", "0", "'EXTRA'"),
        ("FAX", "'string'", "NULL", "0", "'MISSING'"),
        *((c, f"'{t}'", "'string'", m, f"CASE WHEN {m} > 0 THEN 'TYPE_CHANGED' ELSE 'CASTABLE' END") for c, t, m in [
            (c, t, f"COUNT(*) FILTER (WHERE {c} IS NOT NULL AND {_misfit[c]} IS NULL)")
            for c, t in (("BIRTHDATE", "date"), ("LAT", "double"), ("INCOME", "int"))])]))


# --- E: expectations -------------------------------------------------------
CTE["obs_bronze"] = 'SELECT * EXCLUDE (obs_ts), obs_ts AS "DATE" FROM obs_raw'
DEPS["obs_bronze"] = ["obs_raw"]


def metrics_sql(src: str, table: str, tiers: tuple[str, ...] = ("fail", "drop", "warn")) -> str:
    parts = []
    for tier, name, pred in DUCK_RULES[table]:
        if tier not in tiers:
            continue
        bad = f"COUNT(*) FILTER (WHERE ({pred}) IS NOT TRUE)"
        parts.append(
            f"SELECT '{table}' AS table_name, '{tier}' AS tier, '{name}' AS rule, COUNT(*) AS total_records, "
            f"COUNT(*) - {bad} AS passed_records, {bad} AS failed_records, "
            f"{sround(f'CAST({bad} AS DOUBLE) / NULLIF(COUNT(*), 0)', 4)} AS failure_rate FROM {src}"
        )
    return "\nUNION ALL ".join(parts)


CTE["bmetrics"] = "\nUNION ALL ".join([
    metrics_sql("pat_raw", "bronze_patients"),
    metrics_sql("org_raw", "bronze_organizations"),
    metrics_sql("obs_bronze", "bronze_observations"),
])
DEPS["bmetrics"] = ["pat_raw", "org_raw", "obs_bronze"]

sql("expect_or_fail", ["pat_raw"], "SELECT Id, source_file, GENDER FROM pat_raw WHERE Id IS NOT NULL")
sql("expect_or_drop", ["pat_raw"], f"""
SELECT Id, source_file, BIRTHDATE, GENDER FROM pat_raw WHERE {passes('bronze_patients', ('fail', 'drop'))}""")
sql("expect_monitor", ["pat_raw"], metrics_sql("pat_raw", "bronze_patients", ("warn",)))
sql("expect_all", ["pat_unchecked"], metrics_sql("pat_unchecked", "silver_patients", ("warn",)))
sql("expectation_metrics", ["bmetrics"], "SELECT * FROM bmetrics")
sql("expectation_breach", ["bmetrics"], "SELECT * FROM bmetrics WHERE failure_rate > 0.05")
sql("quarantine_rows", ["pat_raw"], """
SELECT Id, source_file, concat_ws(',', CASE WHEN (BIRTHDATE IS NOT NULL) IS NOT TRUE THEN 'valid_birthdate' END,
  CASE WHEN (GENDER IN ('M', 'F')) IS NOT TRUE THEN 'valid_gender' END) AS violated_rules
FROM pat_raw WHERE (BIRTHDATE IS NOT NULL) IS NOT TRUE OR (GENDER IN ('M', 'F')) IS NOT TRUE""")

# --- M: monitoring ---------------------------------------------------------


def drift_sql(src: str, name: str) -> str:
    k = "COUNT(*) FILTER (WHERE _rescued_data IS NOT NULL)"
    return (f"SELECT '{name}' AS table_name, COUNT(*) AS total_records, {k} AS records_with_schema_drift, "
            f"{sround(f'CAST({k} AS DOUBLE) / NULLIF(COUNT(*), 0) * 100.0', 2)} AS schema_drift_pct, "
            f"MAX(ingestion_timestamp) AS latest_ingestion, "
            f"CASE WHEN {k} = 0 THEN 'NO DRIFT' ELSE 'DRIFT DETECTED' END AS drift_status FROM {src}")


def fresh_sql(src: str, name: str) -> str:
    h = hours(AS_OF_TS, "MAX(ingestion_timestamp)")
    return (f"SELECT '{name}' AS table_name, MAX(ingestion_timestamp) AS latest_ingestion, {sround(h, 2)} AS hours_since_ingestion, "
            f"CASE WHEN MAX(ingestion_timestamp) IS NULL THEN 'EMPTY' WHEN {h} <= 6 THEN 'FRESH' WHEN {h} <= 24 THEN 'STALE' "
            f"ELSE 'CRITICAL' END AS freshness_status FROM {src}")


CTE["drifts"] = "\nUNION ALL ".join([drift_sql("pat_raw", "Patients"), drift_sql("org_raw", "Organizations"),
                                     drift_sql("obs_raw", "Observations")])
DEPS["drifts"] = ["pat_raw", "org_raw", "obs_raw"]
CTE["fresh"] = "\nUNION ALL ".join([fresh_sql("pat_raw", "Patients"), fresh_sql("org_raw", "Organizations"),
                                    fresh_sql("obs_raw", "Observations")])
DEPS["fresh"] = ["pat_raw", "org_raw", "obs_raw"]
_rh = hours(RUNS_AS_OF_TS, "MAX(end_time)")
CTE["rec"] = f"""
SELECT pipeline_id, MAX(end_time) AS last_successful_update, {sround(_rh, 2)} AS hours_since_last_update,
  CASE WHEN {_rh} <= 24 THEN 'ON SCHEDULE' WHEN {_rh} <= 48 THEN 'DELAYED' ELSE 'CRITICAL' END AS update_status
FROM runs WHERE state = 'COMPLETED' GROUP BY pipeline_id"""
DEPS["rec"] = ["runs"]
_rate = sround("CAST(COUNT(*) FILTER (WHERE state = 'COMPLETED') AS DOUBLE) / NULLIF(COUNT(*), 0) * 100.0", 2)
CTE["succ"] = f"""
SELECT pipeline_id, COUNT(*) AS total_runs, COUNT(*) FILTER (WHERE state = 'COMPLETED') AS completed_runs,
  COUNT(*) FILTER (WHERE state = 'FAILED') AS failed_runs, {_rate} AS success_rate_pct,
  CASE WHEN {_rate} < 90.0 THEN 'WARNING' ELSE 'OK' END AS status
FROM runs WHERE start_time > {RUNS_AS_OF_TS} - INTERVAL 30 DAY AND start_time <= {RUNS_AS_OF_TS}
GROUP BY pipeline_id"""
DEPS["succ"] = ["runs"]

sql("schema_drift", ["drifts"], "SELECT * FROM drifts")
sql("dedup_effectiveness", ["pat_raw", "pat_pipeline"], f"""
SELECT 'Patients' AS entity, b AS bronze_records, s AS silver_records, b - s AS records_deduplicated,
  {sround('CAST(b - s AS DOUBLE) / NULLIF(b, 0) * 100.0', 2)} AS deduplication_pct,
  CASE WHEN b - s > 0 THEN 'DEDUPLICATED' ELSE 'NO DEDUPLICATION' END AS status
FROM (SELECT (SELECT COUNT(*) FROM pat_raw) AS b, (SELECT COUNT(*) FROM pat_pipeline) AS s) t""")
sql("layer_counts", ["pat_pipeline", "org_silver", "obs_pipeline"], """
SELECT 'Patients' AS entity, COUNT(*) AS record_count, COUNT(DISTINCT patient_id) AS unique_keys,
  MAX(silver_timestamp) AS latest_refresh FROM pat_pipeline
UNION ALL SELECT 'Organizations', COUNT(*), COUNT(DISTINCT organization_id), MAX(silver_timestamp) FROM org_silver
UNION ALL SELECT 'Observations', COUNT(*), COUNT(DISTINCT patient_id), MAX(silver_timestamp) FROM obs_pipeline
ORDER BY entity""")
sql("freshness", ["fresh"], "SELECT * FROM fresh ORDER BY table_name")
sql("update_recency", ["rec"], "SELECT * FROM rec")
_fh = hours(AS_OF_TS, "latest_ingestion")
_uh = hours(RUNS_AS_OF_TS, "last_successful_update")
sql("alerts", ["fresh", "drifts", "bmetrics", "rec", "succ"], f"""
SELECT 'WARNING' AS severity,
  CASE WHEN latest_ingestion IS NULL THEN table_name || ': no rows were ever ingested'
       ELSE table_name || ': newest row is ' || printf('%.1f', {sround(_fh, 1)}) || ' h old, limit 6 h' END AS alert,
  'Find out whether new files arrived and the ingest job ran' AS action
FROM fresh WHERE latest_ingestion IS NULL OR {_fh} > 6
UNION ALL
SELECT 'WARNING', table_name || ': ' || CAST(records_with_schema_drift AS VARCHAR) || ' rows carry values that the declared columns do not hold',
  'Compare the rescued keys with the declared columns; declare those that should stay' FROM drifts WHERE records_with_schema_drift > 0
UNION ALL
SELECT 'CRITICAL', 'rule ' || rule || ' of ' || table_name || ' fails for ' || printf('%.1f', {sround('failure_rate * 100', 1)}) || '% of rows, limit 5%',
  'Read the rejected rows, then mend the source or the rule' FROM bmetrics WHERE failure_rate > 0.05
UNION ALL
SELECT 'CRITICAL', pipeline_id || ': last completed run was ' || printf('%.1f', {sround(_uh, 1)}) || ' h ago, limit 24 h',
  'See whether the job was started and why its last run ended' FROM rec WHERE {_uh} > 24
UNION ALL
SELECT 'WARNING', pipeline_id || ': ' || printf('%.1f', {sround('success_rate_pct', 1)}) || '% of runs completed, limit 90%',
  'Go through the errors of the failed runs' FROM succ WHERE success_rate_pct < 90.0""")
sql("run_success_rate", ["succ"], "SELECT pipeline_id, total_runs, completed_runs, failed_runs, success_rate_pct, status FROM succ")
sql("run_duration_trend", ["runs"], f"""
SELECT CAST(start_time AS DATE) AS run_date, COUNT(*) AS runs,
  {sround('AVG((epoch(end_time) - epoch(start_time)) / 60.0)', 2)} AS avg_duration_min,
  MIN((epoch(end_time) - epoch(start_time)) / 60.0) AS min_duration_min,
  MAX((epoch(end_time) - epoch(start_time)) / 60.0) AS max_duration_min
FROM runs GROUP BY CAST(start_time AS DATE)""")
_silver_ok = passes('silver_patients', ('fail', 'drop'))
CTE["pat_latest"] = CTE["pat_unchecked"].replace("FROM pat_raw", f"FROM pat_raw WHERE {passes('bronze_patients', ('drop',))}")
DEPS["pat_latest"] = ["pat_raw"]
_obs_bronze_ok = passes('bronze_observations', ('fail', 'drop')).replace('DATE', 'obs_ts')
_obs_silver_ok = passes('silver_observations', ('fail', 'drop'))
CTE["obs_kept"] = CTE["obs_unchecked"].replace("FROM obs_raw", f"FROM obs_raw WHERE {_obs_bronze_ok}")
DEPS["obs_kept"] = ["obs_raw"]
sql("layer_reconciliation", ["pat_raw", "org_raw", "pat_latest", "obs_raw", "obs_kept"], f"""
SELECT 'Patients' AS entity, b AS bronze_records, r AS rejected_records, sr AS silver_rejected_records,
  b - r - sr - s AS deduplicated_records, s AS silver_records
FROM (SELECT (SELECT COUNT(*) FROM pat_raw) AS b,
             (SELECT COUNT(*) FROM pat_raw WHERE NOT ({passes('bronze_patients', ('drop',))})) AS r,
             (SELECT COUNT(*) FROM pat_latest WHERE NOT ({_silver_ok})) AS sr,
             (SELECT COUNT(*) FROM pat_latest WHERE {_silver_ok}) AS s) t
UNION ALL
SELECT 'Organizations', b, r, 0, b - r - s, s
FROM (SELECT (SELECT COUNT(*) FROM org_raw) AS b,
             (SELECT COUNT(*) FROM org_raw WHERE NOT ({passes('bronze_organizations', ('drop',))})) AS r,
             (SELECT COUNT(*) FROM org_raw WHERE {passes('bronze_organizations', ('drop',))}) AS s) t
UNION ALL
SELECT 'Observations', b, r, sr, b - r - sr - s, s
FROM (SELECT (SELECT COUNT(*) FROM obs_raw) AS b,
             (SELECT COUNT(*) FROM obs_raw WHERE NOT ({_obs_bronze_ok})) AS r,
             (SELECT COUNT(*) FROM obs_kept WHERE NOT ({_obs_silver_ok})) AS sr,
             (SELECT COUNT(*) FROM obs_kept WHERE {_obs_silver_ok}) AS s) t""")

# --- R / B7 / B8 -----------------------------------------------------------
sql("null_key_check", ["obs_bronze"], """
SELECT column_name, null_count, CASE WHEN null_count > 0 THEN 'WARN' ELSE 'PASS' END AS status FROM (
  SELECT 'PATIENT' AS column_name, COUNT(*) FILTER (WHERE PATIENT IS NULL) AS null_count FROM obs_bronze
  UNION ALL SELECT 'DATE', COUNT(*) FILTER (WHERE "DATE" IS NULL) FROM obs_bronze
  UNION ALL SELECT 'CODE', COUNT(*) FILTER (WHERE CODE IS NULL) FROM obs_bronze
  UNION ALL SELECT 'ENCOUNTER', COUNT(*) FILTER (WHERE ENCOUNTER IS NULL) FROM obs_bronze) t""")
sql("orphan_rows", ["obs", "pat"], """
SELECT patient_id, observation_date, observation_code, observation_value FROM obs
WHERE patient_id IS NOT NULL AND patient_id NOT IN (SELECT Id FROM pat WHERE Id IS NOT NULL)""")
sql("remaining_duplicates", ["pat"], "SELECT Id, COUNT(*) AS dup_count FROM pat GROUP BY Id HAVING COUNT(*) > 1")
sql("ingest_verification", ["pat_raw"], """
SELECT COUNT(*) AS total_records, COUNT(DISTINCT Id) AS unique_keys, MIN(ingestion_timestamp) AS first_ingestion,
  MAX(ingestion_timestamp) AS last_ingestion, COUNT(DISTINCT source_file) AS source_files,
  true AS has_source_file, true AS has_ingestion_timestamp FROM pat_raw""")
_np = []
for _c in ["BIRTHDATE", "DEATHDATE", "SSN", "GENDER", "INCOME", "_rescued_data"]:
    _k = f"COUNT(*) FILTER (WHERE {_c} IS NULL)"
    _np.append(f"SELECT '{_c}' AS column_name, COUNT(*) AS total_rows, {_k} AS null_count, "
               f"{sround(f'CAST({_k} AS DOUBLE) / NULLIF(COUNT(*), 0) * 100.0', 2)} AS null_pct FROM pat_raw")
sql("null_profile", ["pat_raw"], "\nUNION ALL ".join(_np))
sql("monitored_tables", ["pat_raw", "org_raw", "obs_raw", "pat_pipeline", "org_silver", "obs_pipeline"], """
SELECT 'bronze_patients' AS table_name, 'BRONZE' AS layer, COUNT(*) AS row_count, 31 AS column_count FROM pat_raw
UNION ALL SELECT 'bronze_organizations', 'BRONZE', COUNT(*), 14 FROM org_raw
UNION ALL SELECT 'bronze_observations', 'BRONZE', COUNT(*), 12 FROM obs_raw
UNION ALL SELECT 'silver_patients', 'SILVER', COUNT(*), 21 FROM pat_pipeline
UNION ALL SELECT 'silver_organizations', 'SILVER', COUNT(*), 13 FROM org_silver
UNION ALL SELECT 'silver_observations', 'SILVER', COUNT(*), 13 FROM obs_pipeline""")


# --- S / K / B / ST: file and table round trips -----------------------------
CTE["org_inferred"] = """
SELECT CAST(Id AS INTEGER) AS Id, NAME, ADDRESS, CITY, STATE, CAST(ZIP AS INTEGER) AS ZIP, LAT, LON, PHONE, REVENUE,
  UTILIZATION FROM org_raw"""
DEPS["org_inferred"] = ["org_raw"]
CTE["pat_strings"] = """
SELECT * EXCLUDE (_rescued_data, source_file, ingestion_timestamp) REPLACE (NULLIF(BIRTHDATE, '') AS BIRTHDATE),
  replace(source_file, '.csv', '') AS source_dir FROM pat_raw"""
DEPS["pat_strings"] = ["pat_raw"]
OBS_COLS = "obs_ts, PATIENT, ENCOUNTER, CATEGORY, CODE, DESCRIPTION, VALUE, UNITS, TYPE"
ORG_COLS = "Id, NAME, ADDRESS, CITY, STATE, ZIP, LAT, LON, PHONE, REVENUE, UTILIZATION"


def rescued_json(parts: list[tuple[str, str, str]]) -> str:
    """JSON object of rescued values; parts are (key, raw, typed) in key order."""
    items = [f"CASE WHEN {raw} IS NOT NULL AND {typed} IS NULL THEN '\"{k}\":' || CAST(to_json({raw}) AS VARCHAR) END"
             for k, raw, typed in sorted(parts)]
    body = f"concat_ws(',', {', '.join(items)})"
    return f"CASE WHEN {body} = '' THEN NULL ELSE '{{' || {body} || '}}' END"


_bd = "NULLIF(BIRTHDATE, '')"
_PAT_TYPED = {
    "BIRTHDATE": (_bd, f"TRY_CAST({_bd} AS DATE)"),
    "DEATHDATE": ("DEATHDATE", "TRY_CAST(DEATHDATE AS DATE)"),
    "LAT": ("LAT", "TRY_CAST(LAT AS DOUBLE)"),
    "LON": ("LON", "TRY_CAST(LON AS DOUBLE)"),
    "INCOME": ("INCOME", int_guard("INCOME")),
    "HEALTHCARE_EXPENSES": ("HEALTHCARE_EXPENSES", "TRY_CAST(HEALTHCARE_EXPENSES AS DOUBLE)"),
    "HEALTHCARE_COVERAGE": ("HEALTHCARE_COVERAGE", "TRY_CAST(HEALTHCARE_COVERAGE AS DOUBLE)"),
}
_pat_parts = [(k, raw, typed) for k, (raw, typed) in _PAT_TYPED.items()]

sql("scan_csv_batch", ["org_inferred"], "SELECT * FROM org_inferred")
sql("scan_csv_incremental", ["org_inferred"], """
SELECT *, CASE WHEN Id % 2 = 1 THEN '{"EXTRA":"x"}' END AS _rescued_data FROM org_inferred""")
sql("scan_csv_strings", ["pat_strings"], """
SELECT * EXCLUDE (source_dir), CASE WHEN source_dir = 'patients2' THEN '{"EXTRA":"x"}' END AS _rescued_data FROM pat_strings""")
sql("lineage_file", ["pat_raw"], "SELECT Id, replace(source_file, '.csv', '') AS source_dir FROM pat_raw")
sql("lineage_time", ["pat_raw"], f"SELECT Id, MARITAL, {AS_OF_TS} AS ingestion_timestamp FROM pat_raw")
_drift_parts = _pat_parts + [("EXTRA", "CASE WHEN source_file = 'patients2.csv' THEN 'x' END", "NULL")]
sql("rescue_data", ["pat_raw"], f"""
SELECT Id, replace(source_file, '.csv', '') AS source_dir, {_PAT_TYPED['BIRTHDATE'][1]} AS BIRTHDATE,
  {_PAT_TYPED['INCOME'][1]} AS INCOME, {_PAT_TYPED['LAT'][1]} AS LAT, ZIP, {rescued_json(_drift_parts)} AS _rescued_data
FROM pat_raw""")
sql("scan_table", ["obs"], "SELECT * FROM obs")
sql("scan_table_stream", ["org_silver"], "SELECT * FROM org_silver")
sql("sink_overwrite", ["obs"], "SELECT * FROM obs WHERE observation_value IS NOT NULL")
sql("sink_append_stream", ["obs_raw"], f"SELECT {OBS_COLS} FROM obs_raw")
sql("streaming_table", ["org_raw"], f"""
SELECT {ORG_COLS} FROM org_raw WHERE {passes('bronze_organizations', ('drop',))}""")
sql("materialized_table", ["pat_pipeline"], "SELECT * FROM pat_pipeline")
sql("guarded_write", ["pat"], """
SELECT true AS table_existed, n AS current_rows, n AS new_rows, CAST(0 AS BIGINT) AS row_delta, false AS schema_changed,
  true AS written, n AS rows_after FROM (SELECT COUNT(*) AS n FROM pat) t""")
sql("compact_table", ["pat"], "SELECT * EXCLUDE (processing_timestamp, processing_date) FROM pat")
sql("table_properties", [], """
SELECT * FROM (VALUES ('quality', 'silver'), ('layer', 'silver'), ('description', 'Silver layer: validated organizations'))
  t(key, value)""")
sql("create_schema", ["org_silver"], "SELECT * FROM org_silver")
sql("list_tables", ["pat_pipeline", "org_silver", "obs_pipeline"], """
SELECT 'patients' AS table_name, COUNT(*) AS row_count FROM pat_pipeline
UNION ALL SELECT 'organizations', COUNT(*) FROM org_silver
UNION ALL SELECT 'observations', COUNT(*) FROM obs_pipeline""")
_V2_TYPES = {"BIRTHDATE": "date", "DEATHDATE": "date", "ZIP": "int", "FIPS": "int", "LAT": "double", "LON": "double",
             "INCOME": "int", "HEALTHCARE_EXPENSES": "double", "HEALTHCARE_COVERAGE": "double",
             "data_quality_flag": "int", "ingestion_timestamp": "timestamp_ntz"}
_V2_COLS = ["Id", "SSN", "BIRTHDATE", "DEATHDATE", "GENDER", "RACE", "ETHNICITY", "MARITAL", "PREFIX", "FIRST", "MIDDLE",
            "LAST", "SUFFIX", "MAIDEN", "ADDRESS", "CITY", "STATE", "COUNTY", "BIRTHPLACE", "ZIP", "FIPS", "LAT", "LON",
            "INCOME", "HEALTHCARE_EXPENSES", "HEALTHCARE_COVERAGE", "DRIVERS", "PASSPORT", "data_quality_flag",
            "source_file", "ingestion_timestamp"]
sql("describe_table", ["pat"], "SELECT * FROM (VALUES " + ", ".join(
    f"('{c}', '{_V2_TYPES.get(c, 'string')}')" for c in _V2_COLS) + ") t(col_name, data_type) WHERE (SELECT COUNT(*) FROM pat) >= 0")

_b1_cols = ", ".join(
    f"{_PAT_TYPED[c][1]} AS {c}" if c in _PAT_TYPED else c
    for c in ["Id", "SSN", "BIRTHDATE", "DEATHDATE", "GENDER", "RACE", "ETHNICITY", "MARITAL", "PREFIX", "FIRST",
              "MIDDLE", "LAST", "SUFFIX", "MAIDEN", "ADDRESS", "CITY", "STATE", "COUNTY", "BIRTHPLACE", "ZIP", "FIPS",
              "LAT", "LON", "INCOME", "HEALTHCARE_EXPENSES", "HEALTHCARE_COVERAGE", "DRIVERS", "PASSPORT"])
sql("bronze_patients_stream", ["pat_raw"], f"""
SELECT {_b1_cols}, {rescued_json(_pat_parts)} AS _rescued_data, replace(source_file, '.csv', '') AS source_dir
FROM pat_raw WHERE {_PAT_TYPED['BIRTHDATE'][1]} IS NOT NULL AND COALESCE(GENDER IN ('M', 'F'), false)""")
sql("bronze_organizations_stream", ["org_raw"], f"""
SELECT {ORG_COLS}, CAST(NULL AS VARCHAR) AS _rescued_data,
  CASE WHEN CAST(Id AS BIGINT) % 2 = 0 THEN 'organizations1' ELSE 'organizations2' END AS source_dir
FROM org_raw WHERE {passes('bronze_organizations', ('drop',))}""")
sql("bronze_observations_stream", ["obs_raw"], """
SELECT obs_ts AS "DATE", PATIENT, ENCOUNTER, CATEGORY, CODE, DESCRIPTION, VALUE, UNITS, TYPE,
  CAST(NULL AS VARCHAR) AS _rescued_data, replace(source_file, '.csv', '') AS source_dir
FROM obs_raw WHERE PATIENT IS NOT NULL""")
sql("bronze_patients_batch", ["pat_raw"], """
SELECT total_rows, unique_ids, null_ids, null_birthdates, null_genders, total_rows <> unique_ids AS has_duplicates,
  null_ids > 0 AS has_null_ids
FROM (SELECT COUNT(*) AS total_rows, COUNT(DISTINCT Id) AS unique_ids, COUNT(*) FILTER (WHERE Id IS NULL) AS null_ids,
        COUNT(*) FILTER (WHERE TRY_CAST(NULLIF(BIRTHDATE, '') AS DATE) IS NULL) AS null_birthdates,
        COUNT(*) FILTER (WHERE GENDER IS NULL) AS null_genders FROM pat_raw) t""")
sql("bronze_observations_batch", ["obs_raw"], """
SELECT COUNT(*) AS total_rows, COUNT(DISTINCT PATIENT) AS unique_patients, COUNT(DISTINCT ENCOUNTER) AS unique_encounters,
  COUNT(*) FILTER (WHERE PATIENT IS NULL) AS null_patients, COUNT(*) FILTER (WHERE obs_ts IS NULL) AS null_dates,
  COUNT(*) FILTER (WHERE VALUE IS NULL) AS null_values, COUNT(*) FILTER (WHERE CATEGORY IS NULL) AS null_categories
FROM obs_raw""")
sql("bronze_patients_auto", ["pat_strings"], "SELECT *, CAST(NULL AS VARCHAR) AS _rescued_data FROM pat_strings")
sql("stream_ingest", ["org_inferred"], "SELECT *, CAST(NULL AS VARCHAR) AS _rescued_data FROM org_inferred")
sql("stream_table_to_table", ["org_inferred"], """
SELECT Id AS organization_id, NAME AS organization_name, ADDRESS AS address, CITY AS city, upper(STATE) AS state,
  ZIP AS zip_code, LAT AS latitude, LON AS longitude, regexp_replace(PHONE, '[^0-9]', '', 'g') AS phone,
  REVENUE AS revenue, UTILIZATION AS utilization, COALESCE(UTILIZATION > 100, false) AS high_utilization_flag
FROM org_inferred""")
sql("stream_exactly_once", ["obs_raw"], f"SELECT {OBS_COLS} FROM obs_raw")
SQL["stream_dedup_latest"] = SQL["dedup_latest"]
sql("gold_incremental_refresh", ["obs_pipeline"], """
SELECT patient_id, COUNT(*) AS total_observations, MIN(observation_timestamp) AS first_observation,
  MAX(observation_timestamp) AS last_observation, COUNT(*) FILTER (WHERE value_type = 'numeric') AS numeric_observations
FROM obs_pipeline GROUP BY patient_id""")
