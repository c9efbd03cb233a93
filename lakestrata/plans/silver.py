"""Silver layer tables (V1-V7): typing, latest-record dedup, quality flags.

All functions take bronze DataFrames and return DataFrames; clocks come
from ``as_of`` (None means the session clock). Dedup orders are total, so
the survivor is the same on every run, partition count and input order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.functions import scalars as S
from lakestrata.operators.dedup import dedup_latest

# Fixed column order of the typed patient table (V2).
PATIENT_TYPED_COLUMNS = [
    "Id", "SSN", "BIRTHDATE", "DEATHDATE", "GENDER", "RACE", "ETHNICITY", "MARITAL",
    "PREFIX", "FIRST", "MIDDLE", "LAST", "SUFFIX", "MAIDEN",
    "ADDRESS", "CITY", "STATE", "COUNTY", "BIRTHPLACE", "ZIP", "FIPS", "LAT", "LON",
    "INCOME", "HEALTHCARE_EXPENSES", "HEALTHCARE_COVERAGE", "DRIVERS", "PASSPORT",
    "data_quality_flag", "processing_timestamp", "processing_date", "source_file", "ingestion_timestamp",
]

# Fixed column list of the typed observation table (V5).
OBSERVATION_TYPED_COLUMNS = [
    "observation_date", "patient_id", "encounter_id", "observation_code", "observation_description",
    "observation_value", "units", "observation_type", "category",
    "missing_date", "missing_patient", "missing_value", "missing_code", "has_quality_issue",
]


def silver_patients_typed(bronze: DataFrame, as_of: str | None = None, time_col: str = "ingestion_timestamp",
                          file_col: str = "source_file") -> DataFrame:
    """V2: typed columns, newest snapshot per Id, data-quality flag.

    Order: ingestion time desc, then source file desc (files loaded in one
    batch share the ingestion time). The flag is computed after dedup.
    """
    typed = bronze.withColumns({
        "BIRTHDATE": S.parse_date("BIRTHDATE"),
        "DEATHDATE": S.parse_date("DEATHDATE"),
        "FIPS": S.try_int("FIPS"),
        "ZIP": S.try_int("ZIP"),
        "INCOME": S.try_int("INCOME"),
        "LAT": S.try_double("LAT"),
        "LON": S.try_double("LON"),
        "HEALTHCARE_EXPENSES": S.try_double("HEALTHCARE_EXPENSES"),
        "HEALTHCARE_COVERAGE": S.try_double("HEALTHCARE_COVERAGE"),
    })
    latest = dedup_latest(typed, ["Id"], [F.desc_nulls_last(time_col)], [F.desc_nulls_last(file_col)])
    rescued = F.col("_rescued_data").isNotNull() if "_rescued_data" in bronze.columns else F.lit(False)
    flagged = S.stamps(latest, as_of).withColumn(
        "data_quality_flag",
        S.flag(rescued | F.col("BIRTHDATE").isNull() | F.col("GENDER").isNull()),
    )
    if file_col != "source_file" or time_col != "ingestion_timestamp":
        flagged = flagged.withColumnsRenamed({file_col: "source_file", time_col: "ingestion_timestamp"})
    return flagged.select(*PATIENT_TYPED_COLUMNS)


def silver_patients(bronze: DataFrame, as_of: str | None = None, time_col: str = "ingestion_timestamp",
                    file_col: str = "source_file") -> DataFrame:
    """V1: newest row per Id, age, full name, upper-case state (21 columns; names and order are fixed)."""
    latest = dedup_latest(bronze, ["Id"], [F.desc_nulls_last(time_col)], [F.desc_nulls_last(file_col)])
    birth = F.col("BIRTHDATE")
    if dict(bronze.dtypes).get("BIRTHDATE") == "string":
        birth = S.parse_date("BIRTHDATE")
    return latest.select(
        F.col("Id").alias("patient_id"),
        S.full_name("PREFIX", "FIRST", "MIDDLE", "LAST").alias("full_name"),
        F.col("FIRST").alias("first_name"),
        F.col("LAST").alias("last_name"),
        F.col("GENDER").alias("gender"),
        birth.alias("birth_date"),
        S.age_years(birth, S.today(as_of)).alias("age"),
        F.col("RACE").alias("race"),
        F.col("ETHNICITY").alias("ethnicity"),
        F.col("MARITAL").alias("marital_status"),
        F.col("ADDRESS").alias("address"),
        F.col("CITY").alias("city"),
        S.upper("STATE").alias("state"),
        F.col("ZIP").alias("zip_code"),
        F.col("LAT").alias("latitude"),
        F.col("LON").alias("longitude"),
        F.col("HEALTHCARE_EXPENSES").alias("healthcare_expenses"),
        F.col("HEALTHCARE_COVERAGE").alias("healthcare_coverage"),
        F.col("INCOME").alias("income"),
        F.col(time_col).alias("silver_timestamp"),
        F.col(file_col).alias("source_file"),
    )


def silver_organizations(bronze: DataFrame, time_col: str = "ingestion_timestamp") -> DataFrame:
    """V3: upper-case state, digits-only phone, utilization > 100 flag. Stateless (stream-safe)."""
    return bronze.select(
        F.col("Id").alias("organization_id"),
        F.col("NAME").alias("organization_name"),
        F.col("ADDRESS").alias("address"),
        F.col("CITY").alias("city"),
        S.upper("STATE").alias("state"),
        F.col("ZIP").alias("zip_code"),
        F.col("LAT").alias("latitude"),
        F.col("LON").alias("longitude"),
        S.digits_only("PHONE").alias("phone"),
        F.col("REVENUE").alias("revenue"),
        F.col("UTILIZATION").alias("utilization"),
        S.flag(F.col("UTILIZATION") > 100, as_int=False).alias("high_utilization_flag"),
        F.col(time_col).alias("silver_timestamp"),
    )


def observation_class(category) -> F.Column:
    """vital_signs / laboratory / other from the (lower-case) category."""
    return S.case_when(
        [(S.contains(category, "vital"), "vital_signs"), (S.contains(category, "lab"), "laboratory")], "other"
    )


def silver_observations(bronze: DataFrame, date_col: str = "DATE", time_col: str = "ingestion_timestamp") -> DataFrame:
    """V4: guarded numeric value, lower-case category, date, class. Stateless (stream-safe); names and order are fixed."""
    cat = S.lower("CATEGORY")
    return bronze.select(
        F.col(date_col).alias("observation_timestamp"),
        S.to_date(date_col).alias("observation_date"),
        F.col("PATIENT").alias("patient_id"),
        F.col("ENCOUNTER").alias("encounter_id"),
        cat.alias("category"),
        observation_class(cat).alias("observation_type"),
        F.col("CODE").alias("loinc_code"),
        F.col("DESCRIPTION").alias("description"),
        F.col("VALUE").alias("value_raw"),
        S.numeric_if("VALUE", "TYPE").alias("numeric_value"),
        F.col("UNITS").alias("units"),
        F.col("TYPE").alias("value_type"),
        F.col(time_col).alias("silver_timestamp"),
    )


def silver_observations_typed(bronze: DataFrame, date_col: str = "DATE", time_col: str = "ingestion_timestamp",
                              file_col: str = "source_file") -> DataFrame:
    """V5: safe typed value, four missing flags, overall flag, composite dedup.

    Dedup key (patient, date, code); the newest ingestion wins, then the
    source file, then the remaining output columns, so ties are resolved the
    same way on every run.
    """
    typed = bronze.select(
        F.col(date_col).alias("observation_date"),
        F.col("PATIENT").alias("patient_id"),
        F.col("ENCOUNTER").alias("encounter_id"),
        F.col("CODE").alias("observation_code"),
        F.col("DESCRIPTION").alias("observation_description"),
        S.try_double("VALUE").alias("observation_value"),
        F.col("UNITS").alias("units"),
        F.col("TYPE").alias("observation_type"),
        F.col("CATEGORY").alias("category"),
        F.col(time_col).alias("_ingested"),
        F.col(file_col).alias("_file"),
    )
    flags = {
        "missing_date": S.flag(F.col("observation_date").isNull()),
        "missing_patient": S.flag(F.col("patient_id").isNull()),
        "missing_value": S.flag(F.col("observation_value").isNull()),
        "missing_code": S.flag(F.col("observation_code").isNull()),
    }
    q = typed.withColumns(flags).withColumn(
        "has_quality_issue",
        S.flag(S.any_of([F.col(c) == 1 for c in flags])),
    )
    ties = [
        F.desc_nulls_last("_file"),
        F.asc_nulls_first("encounter_id"),
        F.asc_nulls_first("observation_description"),
        F.desc_nulls_last("observation_value"),
        F.asc_nulls_first("units"),
        F.asc_nulls_first("observation_type"),
        F.asc_nulls_first("category"),
    ]
    out = dedup_latest(q, ["patient_id", "observation_date", "observation_code"], [F.desc_nulls_last("_ingested")], ties)
    return out.select(*OBSERVATION_TYPED_COLUMNS)


def observation_summary(obs: DataFrame) -> DataFrame:
    """V6: totals, unique patients and codes, quality issues, mean value."""
    return obs.agg(
        F.count(F.lit(1)).alias("total_observations"),
        F.count_distinct("patient_id").alias("unique_patients"),
        F.count_distinct("observation_code").alias("unique_observation_types"),
        F.sum("has_quality_issue").alias("quality_issues"),
        S.exact_avg("observation_value", 2).alias("avg_value"),
    )


def observation_type_breakdown(obs: DataFrame) -> DataFrame:
    """V6: rows per observation type, most frequent first."""
    return obs.groupBy("observation_type").agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "observation_type")


def patient_summary(pat: DataFrame) -> DataFrame:
    """V7: metric/value rows (one aggregate, unpivoted; the metric labels are fixed values)."""
    one = pat.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("DEATHDATE").isNotNull()).alias("deceased"),
        F.count_if(F.col("data_quality_flag") == 1).alias("issues"),
        S.trunc_bigint(F.avg("HEALTHCARE_EXPENSES")).alias("avg_exp"),
        S.trunc_bigint(F.avg("INCOME")).alias("avg_income"),
    )
    return one.selectExpr(
        "stack(5, 'Total Patients', total, 'Deceased Patients', deceased, 'Quality Issues', issues, "
        "'Avg Healthcare Expenses', avg_exp, 'Avg Income', avg_income) AS (metric, value)"
    )


def patient_verification(pat: DataFrame) -> DataFrame:
    """V7: total rows, unique ids, quality issues."""
    return pat.agg(
        F.count(F.lit(1)).alias("total_patients"),
        F.count_distinct("Id").alias("unique_ids"),
        F.count_if(F.col("data_quality_flag") == 1).alias("quality_issues"),
    )
