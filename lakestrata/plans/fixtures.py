"""Fixture relations derived from the given Parquet tables.

Bronze-shaped patients, observations and organizations, a patient to
organization mapping and a pipeline run log, each a pure DataFrame
expression over the source tables so its size grows with them. Snapshot
fan-out uses ``explode(sequence(...))`` (a Generate, no join).

Fixed values (must equal the fixture definition):
  ingestion times: snapshots 1 and 2 and first sends at 2024-06-28 00:00:00,
  snapshot 3 and re-sends at 2024-06-29 20:00:00
  birth dates: 1930-01-01 + (key * 7919 % 32000) days; death dates 2018-01-01 + key % 2000 days
  observation codes by event type: view 39156-5, click 8480-6, error 8462-4, signup 8867-4, other 8310-5
  units by event type: view kg/m2, signup /min, purchase degF, other mm[Hg]
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

T_FIRST = "2024-06-28 00:00:00"
T_LATER = "2024-06-29 20:00:00"


def read(spark: SparkSession, sf_dir: str, name: str, cols: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def _s(c):
    return c.cast("string")


def pat_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze patients, all text, one to three snapshots per id."""
    c = read(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])
    n = read(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    base = c.join(n, c.c_nationkey == n.n_nationkey, "inner").withColumn(
        "snap", F.explode(F.sequence(F.lit(1), (F.lit(1) + F.col("c_custkey") % 3).cast("int")))
    )
    return base.selectExpr(
        "CAST(c_custkey AS STRING) AS Id",
        "'ssn-' || CAST(c_custkey AS STRING) AS SSN",
        "CASE WHEN c_custkey % 97 = 0 THEN '' WHEN c_custkey % 89 = 0 THEN 'not-a-date' "
        "ELSE CAST(date_add(DATE'1930-01-01', CAST(c_custkey * 7919 % 32000 AS INT)) AS STRING) END AS BIRTHDATE",
        "CASE WHEN c_custkey % 11 = 0 THEN CAST(date_add(DATE'2018-01-01', CAST(c_custkey % 2000 AS INT)) AS STRING) END"
        " AS DEATHDATE",
        "CASE WHEN c_custkey % 53 = 0 THEN CAST(NULL AS STRING) WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS GENDER",
        "c_mktsegment AS RACE",
        "CASE WHEN c_custkey % 5 = 0 THEN 'hispanic' ELSE 'nonhispanic' END AS ETHNICITY",
        "CASE WHEN snap = 1 THEN 'S' WHEN snap = 2 THEN 'M' ELSE 'D' END AS MARITAL",
        "CASE WHEN c_custkey % 3 = 0 THEN 'Dr.' END AS PREFIX",
        "'First' || CAST(c_custkey AS STRING) AS FIRST",
        "CASE WHEN c_custkey % 4 = 0 THEN 'Mid' END AS MIDDLE",
        "c_name AS LAST",
        "CAST(NULL AS STRING) AS SUFFIX",
        "CAST(NULL AS STRING) AS MAIDEN",
        "CAST(c_custkey AS STRING) || ' Main St' AS ADDRESS",
        "'City' || CAST(c_custkey % 40 AS STRING) AS CITY",
        "lower(n_name) AS STATE",
        "'County' || CAST(n_regionkey AS STRING) AS COUNTY",
        "n_name AS BIRTHPLACE",
        "CASE WHEN c_custkey % 43 = 0 THEN 'bad' ELSE CAST(10000 + c_custkey % 80000 AS STRING) END AS ZIP",
        "CASE WHEN c_custkey % 2 = 0 THEN '25025.0' ELSE '25025' END AS FIPS",
        "CASE WHEN c_custkey % 71 = 0 THEN CAST(NULL AS STRING) ELSE CAST(c_custkey % 90 AS STRING) END AS LAT",
        "CASE WHEN c_custkey % 73 = 0 THEN CAST(NULL AS STRING) ELSE CAST(-(c_custkey % 180) AS STRING) END AS LON",
        "CASE WHEN c_custkey % 41 = 0 THEN 'n/a' ELSE CAST(1000 + c_custkey * 37 % 90000 AS STRING) END AS INCOME",
        "CAST(c_acctbal AS STRING) AS HEALTHCARE_EXPENSES",
        "CAST(c_nationkey * 100 AS STRING) AS HEALTHCARE_COVERAGE",
        "CAST(NULL AS STRING) AS DRIVERS",
        "CAST(NULL AS STRING) AS PASSPORT",
        "CASE WHEN c_custkey % 61 = 0 THEN '{\"EXTRA\":\"x\"}' END AS _rescued_data",
        "'patients' || CAST(snap AS STRING) || '.csv' AS source_file",
        f"CASE WHEN snap = 3 THEN TIMESTAMP_NTZ'{T_LATER}' ELSE TIMESTAMP_NTZ'{T_FIRST}' END AS ingestion_timestamp",
    )


def obs_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze observations; every 15th event (id % 15 = 1) is re-sent."""
    e = read(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    fan = F.when(F.col("event_id") % 15 == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return e.withColumn("resend", F.explode(fan)).selectExpr(
        "ts AS obs_ts",
        "CASE WHEN event_id % 211 = 0 THEN CAST(NULL AS STRING) "
        "WHEN event_id % 101 = 0 THEN CAST(user_id + 1000000 AS STRING) ELSE CAST(user_id AS STRING) END AS PATIENT",
        "'enc-' || CAST(event_id % 3000 AS STRING) AS ENCOUNTER",
        "CASE WHEN event_type = 'purchase' THEN 'laboratory' WHEN event_id % 13 = 0 THEN 'survey' ELSE 'vital-signs' END"
        " AS CATEGORY",
        "CASE event_type WHEN 'view' THEN '39156-5' WHEN 'click' THEN '8480-6' WHEN 'error' THEN '8462-4' "
        "WHEN 'signup' THEN '8867-4' ELSE '8310-5' END AS CODE",
        "'desc ' || event_type AS DESCRIPTION",
        "CASE WHEN event_id % 10 = 0 THEN 'Never smoker' ELSE CAST(value + resend AS STRING) END AS VALUE",
        "CASE event_type WHEN 'view' THEN 'kg/m2' WHEN 'signup' THEN '/min' WHEN 'purchase' THEN 'degF' "
        "ELSE 'mm[Hg]' END AS UNITS",
        "CASE WHEN event_id % 10 = 0 THEN 'text' ELSE 'numeric' END AS TYPE",
        "CASE WHEN event_id % 307 = 0 THEN '{\"EXTRA\":\"x\"}' END AS _rescued_data",
        "CASE WHEN resend = 1 THEN 'observations2.csv' ELSE 'observations1.csv' END AS source_file",
        f"CASE WHEN resend = 1 THEN TIMESTAMP_NTZ'{T_LATER}' ELSE TIMESTAMP_NTZ'{T_FIRST}' END AS ingestion_timestamp",
    )


def org_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze organizations."""
    s = read(spark, sf_dir, "supplier", ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"])
    n = read(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    return s.join(n, s.s_nationkey == n.n_nationkey, "inner").selectExpr(
        "CAST(s_suppkey AS STRING) AS Id",
        "CASE WHEN s_suppkey % 31 = 30 THEN '  ' ELSE s_name END AS NAME",
        "CAST(s_suppkey AS STRING) || ' High St' AS ADDRESS",
        "'City' || CAST(s_suppkey % 40 AS STRING) AS CITY",
        "lower(n_name) AS STATE",
        "CAST(10000 + s_suppkey AS STRING) AS ZIP",
        "CASE WHEN s_suppkey % 17 = 0 THEN CAST(NULL AS DOUBLE) ELSE CAST(s_suppkey % 90 AS DOUBLE) END AS LAT",
        "CAST(-(s_suppkey % 180) AS DOUBLE) AS LON",
        "'(555) ' || CAST(100 + s_suppkey % 900 AS STRING) || '-0199' AS PHONE",
        "s_acctbal AS REVENUE",
        "CAST(s_suppkey * 7 % 250 AS INT) AS UTILIZATION",
        "CASE WHEN s_suppkey % 61 = 5 THEN '{\"EXTRA\":\"x\"}' END AS _rescued_data",
        "'organizations1.csv' AS source_file",
        f"TIMESTAMP_NTZ'{T_LATER}' AS ingestion_timestamp",
    )


def pat_org(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patient to organization: the first supplier of the patient's nation."""
    c = read(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    first = (
        read(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"])
        .groupBy("s_nationkey")
        .agg(F.min("s_suppkey").alias("first_org"))
    )
    return c.join(first, c.c_nationkey == first.s_nationkey, "left").select(
        _s(F.col("c_custkey")).alias("Id"), _s(F.col("first_org")).alias("organization_id")
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pipeline run log."""
    o = read(spark, sf_dir, "orders", ["o_orderkey", "o_orderstatus", "o_orderdate"])
    k = F.col("o_orderkey")
    st = F.col("o_orderstatus")
    return o.select(
        _s(k).alias("run_id"),
        F.concat(F.lit("p"), _s(k % 3)).alias("pipeline_id"),
        F.when(st == "F", F.lit("COMPLETED")).when(st == "O", F.lit("FAILED")).otherwise(F.lit("CANCELED")).alias("state"),
        F.col("o_orderdate").alias("start_time"),
        (F.col("o_orderdate") + F.make_dt_interval(mins=(1 + k % 50).cast("int"))).alias("end_time"),
    )
