"""Bronze layer (B1-B6): incremental and batch CSV ingestion.

Streaming bronze tables (B1-B3) read each micro-batch of new files by header,
so files whose columns were added, dropped or reordered are mapped by name,
then types are applied with rescue (S6), lineage is added (S4, S5) and
expectations run (E1-E3) before an idempotent write of the batch.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakestrata.operators import expectations as E
from lakestrata.sources.files import read_csv, read_csv_by_header, rescue, with_lineage
from lakestrata.streaming.ingest import csv_batches, ingest_available, write_expected


def _schema(spec: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(k, v, True) for k, v in spec.items()])


S, D, DT, I, TS = T.StringType(), T.DoubleType(), T.DateType(), T.IntegerType(), T.TimestampNTZType()

@dataclass(frozen=True)
class BronzeSpec:
    """Declared bronze columns and the rule-catalogue entry of one entity."""

    name: str
    glob: str
    schema: T.StructType
    rules: str
    key: str = "Id"
    extra: dict = field(default_factory=dict)


# Fixed column lists of the source extracts with their bronze types.
PATIENTS = BronzeSpec("bronze_patients", "patients*.csv", _schema({
    "Id": S, "SSN": S, "BIRTHDATE": DT, "DEATHDATE": DT, "GENDER": S, "RACE": S, "ETHNICITY": S, "MARITAL": S,
    "PREFIX": S, "FIRST": S, "MIDDLE": S, "LAST": S, "SUFFIX": S, "MAIDEN": S, "ADDRESS": S, "CITY": S, "STATE": S,
    "COUNTY": S, "BIRTHPLACE": S, "ZIP": S, "FIPS": S, "LAT": D, "LON": D, "INCOME": I,
    "HEALTHCARE_EXPENSES": D, "HEALTHCARE_COVERAGE": D, "DRIVERS": S, "PASSPORT": S,
}), "bronze_patients")

ORGANIZATIONS = BronzeSpec("bronze_organizations", "organizations*.csv", _schema({
    "Id": S, "NAME": S, "ADDRESS": S, "CITY": S, "STATE": S, "ZIP": S, "LAT": D, "LON": D, "PHONE": S,
    "REVENUE": D, "UTILIZATION": I,
}), "bronze_organizations")

OBSERVATIONS = BronzeSpec("bronze_observations", "observations*.csv", _schema({
    "DATE": TS, "PATIENT": S, "ENCOUNTER": S, "CATEGORY": S, "CODE": S, "DESCRIPTION": S, "VALUE": S,
    "UNITS": S, "TYPE": S,
}), "bronze_observations", key="PATIENT")


def bronze_frame(raw: DataFrame, spec: BronzeSpec, as_of: str | None = None, file_col: str = "source_file",
                 time_col: str = "ingestion_timestamp") -> DataFrame:
    """Lineage + typed columns with rescue for a string-read CSV frame."""
    lineage = with_lineage(raw, None if file_col in raw.columns else file_col, time_col, as_of)
    return rescue(lineage, spec.schema, keep=(file_col, time_col))


def bronze(spark: SparkSession, spec: BronzeSpec, src_dir: str, target: str, checkpoint: str,
           as_of: str | None = None, metrics_path: str | None = None, max_files_per_trigger: int = 1000,
           glob: str | None = None, timeout_s: float | None = None, quarantine: bool = False) -> StreamingQuery:
    """Incremental bronze table with lineage, rescue and expectations.

    A broken fail rule stops the job before the batch is written; with
    ``quarantine`` the rows that break it are set aside like those of drop
    rules, and the metrics count them.
    """
    rules = E.catalogue(spec.rules, as_of)
    if quarantine:
        rules = E.quarantined(rules)

    def write(raw: DataFrame, key: str) -> None:
        write_expected(bronze_frame(raw, spec, as_of), rules, target, key, metrics_path, spec.name)

    return csv_batches(spark, src_dir, glob or spec.glob, checkpoint, write, max_files_per_trigger, timeout_s, spec.schema.names)


def _load(spark: SparkSession, path: str, glob: str | None, as_of: str | None, spec: BronzeSpec | None) -> DataFrame:
    """With a spec: one pass by header, declared types and rescue. Without: types are inferred in a pass of its own."""
    if spec is not None:
        return bronze_frame(read_csv_by_header(spark, path, glob, declared=spec.schema.names), spec, as_of)
    return with_lineage(read_csv(spark, path, glob=glob), as_of=as_of)


def load_patients(spark: SparkSession, path: str, glob: str | None = None, as_of: str | None = None,
                  spec: BronzeSpec | None = None) -> tuple[DataFrame, DataFrame]:
    """Full load with a one-pass validation row (types of ``spec``, or inferred)."""
    df = _load(spark, path, glob, as_of, spec)
    checks = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct("Id").alias("unique_ids"),
        F.count_if(F.col("Id").isNull()).alias("null_ids"),
        F.count_if(F.col("BIRTHDATE").isNull()).alias("null_birthdates"),
        F.count_if(F.col("GENDER").isNull()).alias("null_genders"),
    ).withColumns({
        "has_duplicates": F.col("total_rows") != F.col("unique_ids"),
        "has_null_ids": F.col("null_ids") > 0,
    })
    return df, checks


def load_observations(spark: SparkSession, path: str, glob: str | None = None, as_of: str | None = None,
                      spec: BronzeSpec | None = None) -> tuple[DataFrame, DataFrame]:
    """Full load with a one-pass validation row (types of ``spec``, or inferred)."""
    df = _load(spark, path, glob, as_of, spec)
    checks = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct("PATIENT").alias("unique_patients"),
        F.count_distinct("ENCOUNTER").alias("unique_encounters"),
        F.count_if(F.col("PATIENT").isNull()).alias("null_patients"),
        F.count_if(F.col("DATE").isNull()).alias("null_dates"),
        F.count_if(F.col("VALUE").isNull()).alias("null_values"),
        F.count_if(F.col("CATEGORY").isNull()).alias("null_categories"),
    )
    return df, checks


def auto_patients(spark: SparkSession, src_dir: str, target: str, checkpoint: str, schema_location: str,
                  glob: str = "patients*.csv", as_of: str | None = None) -> StreamingQuery:
    """All-string incremental load with a persisted schema, rescue and lineage."""
    return ingest_available(spark, src_dir, glob, target, checkpoint, schema_location=schema_location, as_of=as_of)
