"""Gold aggregate tables.

Plans are written so that the heavy side is reduced before it is joined:
per-patient observation aggregates are computed first and then joined
(G5, G8, G9). Where the grouping needs patient attributes and raw values
(G6: percentiles), the join comes first and the rows of hot patients are
salted over sub-keys (``skew_join``). Scalar inputs such as the patient
total (G7) are scalar subqueries, not joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.functions import scalars as S
from lakestrata.operators.joins import skew_join
from lakestrata.operators.quantiles import group_quantiles
from lakestrata.session import scratch_table

# Risk rules (code, low, high, label[, unit]); a value strictly
# outside [low, high] is a risk. First matching rule wins. A rule with a unit
# applies only to observations recorded in that unit (the temperature limits
# are Fahrenheit); without a unit it applies to every unit, as published.
RISK_RULES: list[tuple] = [
    ("39156-5", 18.5, 30.0, "BMI Abnormal"),
    ("8480-6", 90.0, 140.0, "Blood Pressure High/Low"),
    ("8462-4", 60.0, 90.0, "Blood Pressure High/Low"),
    ("8867-4", 60.0, 100.0, "Heart Rate Abnormal"),
    ("8310-5", 97.0, 99.5, "Temperature Abnormal"),
]

# Age bands (upper bound exclusive, label), default band "65+".
AGE_BANDS: list[tuple[int, str]] = [(18, "0-17"), (35, "18-34"), (50, "35-49"), (65, "50-64")]

def _cnt(cond: Column) -> Column:
    return F.count_if(cond)


def demographics(pat: DataFrame, as_of: str | None = None, stamps: bool = False) -> DataFrame:
    """G1: counts, mean income, birth-date range, deceased per demographic cell."""
    out = pat.groupBy("GENDER", "RACE", "ETHNICITY", "MARITAL", "STATE", "COUNTY").agg(
        F.count("Id").alias("patient_count"),
        F.count_distinct("Id").alias("unique_patients"),
        F.avg("INCOME").alias("avg_income"),
        F.min("BIRTHDATE").alias("oldest_birthdate"),
        F.max("BIRTHDATE").alias("youngest_birthdate"),
        _cnt(F.col("DEATHDATE").isNotNull()).alias("deceased_count"),
    )
    return S.stamps(out, as_of, "snapshot_timestamp", "processing_date") if stamps else out


def financial(pat: DataFrame, as_of: str | None = None, stamps: bool = False) -> DataFrame:
    """Income, expense and coverage statistics per gender and state."""
    out = pat.groupBy("GENDER", "STATE").agg(
        F.count("Id").alias("patient_count"),
        F.avg("INCOME").alias("avg_income"),
        F.min("INCOME").alias("min_income"),
        F.max("INCOME").alias("max_income"),
        F.stddev_samp("INCOME").alias("stddev_income"),
        F.avg("HEALTHCARE_EXPENSES").alias("avg_healthcare_expenses"),
        F.sum("HEALTHCARE_EXPENSES").alias("total_healthcare_expenses"),
        F.min("HEALTHCARE_EXPENSES").alias("min_healthcare_expenses"),
        F.max("HEALTHCARE_EXPENSES").alias("max_healthcare_expenses"),
        F.avg("HEALTHCARE_COVERAGE").alias("avg_healthcare_coverage"),
        F.sum("HEALTHCARE_COVERAGE").alias("total_healthcare_coverage"),
        _cnt(F.col("data_quality_flag") == 1).alias("quality_issues_count"),
        # exact (decimal) means for the two rounded business metrics, so a
        # value on a rounding tie does not depend on summation order
        S.exact_mean("HEALTHCARE_EXPENSES").cast("decimal(24,10)").alias("_exp"),
        S.exact_mean("INCOME").cast("decimal(24,10)").alias("_inc"),
        S.exact_mean("HEALTHCARE_COVERAGE").cast("decimal(24,10)").alias("_cov"),
    ).withColumns({
        "expense_to_income_ratio": F.round(F.try_divide(F.col("_exp"), F.col("_inc")), 4).cast("double"),
        "coverage_gap": F.round(F.col("_exp") - F.col("_cov"), 2).cast("double"),
    }).drop("_exp", "_inc", "_cov")
    return S.stamps(out, as_of, "snapshot_timestamp", "processing_date") if stamps else out


def lifetime(pat: DataFrame, as_of: str | None = None, stamps: bool = False) -> DataFrame:
    """Current age of the living, age at death of the deceased."""
    dead = F.col("DEATHDATE").isNotNull()
    x = pat.withColumns({
        "current_age": F.when(~dead, S.age_years("BIRTHDATE", S.today(as_of))),
        "age_at_death": F.when(dead, S.age_years("BIRTHDATE", "DEATHDATE")),
        "patient_status": F.when(dead, F.lit("deceased")).otherwise(F.lit("living")),
    })
    out = x.groupBy("GENDER", "RACE", "patient_status").agg(
        F.count("Id").alias("patient_count"),
        F.avg("current_age").alias("avg_current_age"),
        F.min("current_age").alias("min_current_age"),
        F.max("current_age").alias("max_current_age"),
        F.avg("age_at_death").alias("avg_age_at_death"),
        F.min("age_at_death").alias("min_age_at_death"),
        F.max("age_at_death").alias("max_age_at_death"),
        F.stddev_samp("age_at_death").alias("stddev_age_at_death"),
    )
    return S.stamps(out, as_of, "snapshot_timestamp", "processing_date") if stamps else out


def quality(pat: DataFrame, as_of: str | None = None, stamps: bool = False) -> DataFrame:
    """One row of totals, flags, missing counts and the clean percentage."""
    out = pat.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_distinct("Id").alias("unique_patients"),
        _cnt(F.col("data_quality_flag") == 1).alias("quality_issues"),
        _cnt(F.col("data_quality_flag") == 0).alias("clean_records"),
        _cnt(F.col("BIRTHDATE").isNull()).alias("missing_birthdate"),
        _cnt(F.col("GENDER").isNull()).alias("missing_gender"),
        _cnt(F.col("RACE").isNull()).alias("missing_race"),
        _cnt(F.col("INCOME").isNull()).alias("missing_income"),
        _cnt(F.col("HEALTHCARE_EXPENSES").isNull()).alias("missing_expenses"),
        _cnt(F.col("HEALTHCARE_COVERAGE").isNull()).alias("missing_coverage"),
        _cnt(F.col("LAT").isNull()).alias("missing_lat"),
        _cnt(F.col("LON").isNull()).alias("missing_lon"),
        F.min("processing_timestamp").alias("earliest_processing_timestamp"),
        F.max("processing_timestamp").alias("latest_processing_timestamp"),
    )
    if stamps:
        out = S.stamps(out, as_of, "measurement_timestamp", "measurement_date")
    return out.withColumn("overall_completeness_pct", S.ratio("clean_records", "total_records", 2, 100.0))


def _patient_dim(pat: DataFrame, cols: Sequence[str], as_of: str | None, age_col: str | None = None) -> DataFrame:
    sel = [F.col("Id").alias("patient_id"), *cols]
    if age_col:
        sel.append(S.age_years("BIRTHDATE", S.today(as_of)).alias(age_col))
    return pat.select(*sel)


def clinical_summary(obs: DataFrame, pat: DataFrame, as_of: str | None = None) -> DataFrame:
    """Per-patient activity, aggregated first, then left-joined to patients.

    A NULL patient_id group is kept and matches no patient; observations of
    unknown patients are labelled Living, as they have no death date.
    """
    per = obs.groupBy("patient_id").agg(
        F.count(F.lit(1)).alias("total_observations"),
        F.count_distinct("observation_code").alias("unique_observation_types"),
        F.count_distinct("observation_type").alias("unique_observation_categories"),
        F.min("observation_date").alias("first_observation_date"),
        F.max("observation_date").alias("last_observation_date"),
        F.datediff(F.max("observation_date"), F.min("observation_date")).alias("observation_span_days"),
        _cnt(F.col("observation_type") == "numeric").alias("numeric_observations"),
        _cnt(F.col("observation_type") == "text").alias("text_observations"),
        _cnt(F.col("category") == "vital-signs").alias("vital_sign_observations"),
        F.sum("has_quality_issue").alias("observation_quality_issues"),
    )
    dim = _patient_dim(pat, ["GENDER", "RACE", "ETHNICITY", "STATE", "COUNTY", "BIRTHDATE", "DEATHDATE"], as_of, "current_age")
    j = per.join(dim, "patient_id", "left")
    span = F.col("observation_span_days")
    return j.withColumns({
        "observations_per_year": F.when(
            span > 0, F.round(F.col("total_observations") / (span / F.lit(365.25)), 2)
        ).otherwise(F.col("total_observations").cast("double")),
        "patient_status": F.when(F.col("DEATHDATE").isNull(), F.lit("Living")).otherwise(F.lit("Deceased")),
    })


def age_band(age: Column, null_band: str | None = None) -> Column:
    """Age group label; NULL age falls into the last band unless ``null_band``."""
    branches = [(age < lim, label) for lim, label in AGE_BANDS]
    if null_band is not None:
        branches = [(age.isNull(), null_band)] + branches
    return S.case_when(branches, "65+")


def vital_signs(obs: DataFrame, pat: DataFrame, as_of: str | None = None, null_band: str | None = None,
                rows_per_salt: int = 500_000) -> DataFrame:
    """Vital-sign value statistics per gender, age band and code (quartiles are exact)."""
    v = obs.filter((F.col("category") == "vital-signs") & F.col("observation_value").isNotNull())
    dim = _patient_dim(pat, ["GENDER"], as_of, "age")
    # raw values are needed for the percentiles, so this join cannot be
    # pre-aggregated: rows of hot patients are salted over sub-keys (skew_join)
    j = skew_join(v, dim, "patient_id", "inner", rows_per_salt).withColumn("age_group", age_band(F.col("age"), null_band))
    x = F.col("observation_value")
    keys = ["GENDER", "age_group", "observation_code", "observation_description", "units"]
    # read by three aggregations
    j = scratch_table(j.select(*keys, "patient_id", "observation_value"), "vital-signs")
    stats = j.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("observation_count"),
        S.exact_avg(x, 2).alias("avg_value"),
        F.round(F.min(x), 2).alias("min_value"),
        F.round(F.max(x), 2).alias("max_value"),
        F.round(F.stddev_samp(x), 2).alias("stddev_value"),
    )
    patients = j.select(*keys, "patient_id").distinct().groupBy(*keys).agg(F.count("patient_id").alias("patient_count"))
    quartiles = group_quantiles(j, keys, "observation_value", {"p25": 0.25, "p50": 0.5, "p75": 0.75})

    def also(left: DataFrame, right: DataFrame) -> DataFrame:
        other = right.withColumnsRenamed({k: f"_{k}" for k in keys})
        same = F.lit(True)
        for k in keys:
            same = same & left[k].eqNullSafe(other[f"_{k}"])
        return left.join(other, same).drop(*[f"_{k}" for k in keys])

    return also(also(stats, patients), quartiles).select(
        *keys, "observation_count", "patient_count", "avg_value", "min_value", "max_value", "stddev_value",
        F.round("p25", 2).alias("p25_value"), F.round("p50", 2).alias("median_value"), F.round("p75", 2).alias("p75_value"),
    )


def observation_types(obs: DataFrame, pat: DataFrame) -> DataFrame:
    """Volume, coverage and completeness per observation kind.

    The patient total is a scalar subquery (one number), not a join.
    """
    total_patients = pat.select(F.count(F.lit(1))).scalar()
    g = obs.groupBy("category", "observation_code", "observation_description", "observation_type", "units").agg(
        F.count(F.lit(1)).alias("total_observations"),
        F.count_distinct("patient_id").alias("unique_patients"),
        F.min("observation_date").alias("first_recorded"),
        F.max("observation_date").alias("last_recorded"),
        S.exact_avg("observation_value", 2).alias("avg_value"),
        _cnt(F.col("observation_value").isNotNull()).alias("non_null_values"),
    )
    return g.withColumns({
        "observations_per_patient": S.ratio("total_observations", "unique_patients", 1),
        "patient_coverage_pct": S.ratio(F.col("unique_patients"), total_patients, 1, 100.0),
        "value_completeness_pct": S.ratio("non_null_values", "total_observations", 1, 100.0),
    }).orderBy(F.desc("total_observations"), "category", "observation_code", "observation_description",
               "observation_type", "units")


def risk_flag(code: Column, value: Column, rules: Sequence[tuple] = RISK_RULES, units: Column | None = None) -> Column:
    branches = []
    for rule in rules:
        c, lo, hi, label = rule[:4]
        cond = (code == c) & ((value < lo) | (value > hi))
        if len(rule) > 4 and rule[4] is not None and units is not None:
            cond = cond & (units == rule[4])
        branches.append((cond, label))
    return S.case_when(branches)


def risk_indicators(obs: DataFrame, pat: DataFrame, as_of: str | None = None,
                    rules: Sequence[tuple] = RISK_RULES) -> DataFrame:
    """Out-of-range occurrences per patient, risk and code.

    The risk flag depends on the observation only, so observations are
    aggregated per (patient, risk, code, description) *before* the join;
    the patient attributes in the grouping are functions of patient_id.
    The unit is the smallest unit of the group (deterministic).
    """
    x = F.col("observation_value")
    flagged = obs.filter(x.isNotNull() & F.col("patient_id").isNotNull()).withColumn(
        "risk_flag", risk_flag(F.col("observation_code"), x, rules, F.col("units"))
    ).filter(F.col("risk_flag").isNotNull())
    per = flagged.groupBy("patient_id", "risk_flag", "observation_code", "observation_description").agg(
        F.count(F.lit(1)).alias("risk_occurrence_count"),
        F.sum(x.cast(S.EXACT)).alias("_sum"),
        F.min(x).alias("_min"),
        F.max(x).alias("_max"),
        F.max("observation_date").alias("last_risk_observation_date"),
        F.min("units").alias("units"),
    )
    dim = _patient_dim(pat, ["GENDER", "RACE", "STATE"], as_of, "age")
    j = per.join(dim, "patient_id", "inner")
    n = F.col("risk_occurrence_count")
    return j.select(
        "patient_id", "GENDER", "age", "RACE", "STATE", "risk_flag", "observation_code", "observation_description",
        n,
        F.round(F.col("_sum") / n, 2).cast("double").alias("avg_risk_value"),
        F.round(F.col("_min"), 2).alias("min_value"),
        F.round(F.col("_max"), 2).alias("max_value"),
        "last_risk_observation_date",
        "units",
        S.case_when([(n >= 10, "High"), (n >= 5, "Medium")], "Low").alias("risk_severity"),
    )


def patient_overview(obs: DataFrame, pat: DataFrame, pat_org: DataFrame, org: DataFrame) -> DataFrame:
    """Per patient name, organization, observation total, first and last date.

    Observations are aggregated per patient first; the organization name is
    looked up through the patient-to-organization mapping.
    """
    per = obs.filter(F.col("patient_id").isNotNull()).groupBy("patient_id").agg(
        F.count(F.lit(1)).alias("total_observations"),
        F.min("observation_date").alias("first_observation_date"),
        F.max("observation_date").alias("most_recent_observation_date"),
    )
    names = pat.select(F.col("Id").alias("patient_id"), S.full_name("FIRST", "LAST").alias("patient_name"))
    orgs = pat_org.select(F.col("Id").alias("patient_id"), "organization_id").join(
        org.select("organization_id", "organization_name"), "organization_id", "left"
    ).drop("organization_id")
    return per.join(names, "patient_id", "left").join(orgs, "patient_id", "left").select(
        "patient_id", "patient_name", "organization_name", "total_observations",
        "first_observation_date", "most_recent_observation_date",
    )


def org_rollup(overview: DataFrame) -> DataFrame:
    """Distinct patients and total observations per organization."""
    return overview.filter(F.col("organization_name").isNotNull()).groupBy("organization_name").agg(
        F.count_distinct("patient_id").alias("patient_count"),
        F.sum("total_observations").alias("total_obs"),
    ).orderBy(F.desc("patient_count"), "organization_name")


def demographics_top(g1: DataFrame, k: int = 10) -> DataFrame:
    """Gender x state roll-up of G1, top k by patients."""
    r = g1.groupBy("GENDER", "STATE").agg(
        F.sum("patient_count").alias("total_patients"),
        F.round(F.avg("avg_income"), 0).alias("avg_income"),
        F.sum("deceased_count").alias("deceased"),
    )
    return r.orderBy(F.desc("total_patients"), F.asc_nulls_first("GENDER"), F.asc_nulls_first("STATE")).limit(k)


def financial_view(g2: DataFrame, k: int = 10) -> DataFrame:
    """Rounded projection of G2, top k by patient count."""
    return g2.select(
        "GENDER", "STATE", "patient_count",
        F.round("avg_income", 0).alias("avg_income"),
        F.round("avg_healthcare_expenses", 0).alias("avg_expenses"),
        "expense_to_income_ratio",
        F.round("coverage_gap", 0).alias("coverage_gap"),
    ).orderBy(F.desc("patient_count"), F.asc_nulls_first("GENDER"), F.asc_nulls_first("STATE")).limit(k)


def lifetime_view(g3: DataFrame) -> DataFrame:
    """Rounded projection of G3 ordered by patient count."""
    return g3.select(
        "GENDER", "RACE", "patient_status", "patient_count",
        F.round("avg_current_age", 1).alias("avg_age"),
        F.round("avg_age_at_death", 1).alias("avg_age_at_death"),
    ).orderBy(F.desc("patient_count"), F.asc_nulls_first("GENDER"), "RACE", "patient_status")


def quality_view(g4: DataFrame) -> DataFrame:
    """Headline columns of G4."""
    return g4.select(
        "total_records", "unique_patients", "quality_issues", "clean_records", "overall_completeness_pct",
        "missing_birthdate", "missing_gender", "missing_income",
    )
