"""Registered queries for sources, sinks, table management, bronze loads and
streams (S, K, B, ST keys).

Each query stages fixture relations as CSV or Parquet in a fresh folder
under the shared checkpoint root, runs the operator (batch or
availableNow stream), and returns the resulting table. Path and clock
columns are replaced by the source folder name or left out, so the content
is comparable with the source relation.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.catalog import checked, obs, obs_pipeline, obs_raw, org_raw, org_silver, pat, pat_pipeline, pat_raw, register
from lakestrata.operators import expectations as E
from lakestrata.plans import bronze as B
from lakestrata.plans import silver as V
from lakestrata.session import AS_OF, scratch_dir
from lakestrata.sources import files as SF
from lakestrata.sources import tables as TB
from lakestrata.streaming import ingest as ST

LINEAGE = ["source_file", "ingestion_timestamp"]


def _dir_of(col: str = "source_file"):
    """Name of the folder holding the source file (the snapshot name)."""
    return F.regexp_extract(F.col(col), r"/([^/]+)/[^/]+$", 1)


def _pat_csv(spark, d, root: str, snaps=(1, 2, 3), drift: bool = False) -> None:
    """Stage patient snapshots as CSV folders patients1..3 (strings, no lineage)."""
    raw = pat_raw(spark, d)
    cols = [c for c in raw.columns if c not in LINEAGE and c != "_rescued_data"]
    for s in snaps:
        part = raw.filter(F.col("source_file") == f"patients{s}.csv").select(*cols)
        if drift and s == 2:
            part = part.withColumn("EXTRA", F.lit("x"))
        if drift and s == 3:
            part = part.select(*reversed(cols))
        SF.write_csv(part, f"{root}/patients{s}")


def _obs_csv(spark, d, root: str, which=(1, 2), date_name: str = "obs_ts") -> None:
    raw = obs_raw(spark, d)
    cols = [c for c in raw.columns if c not in LINEAGE and c != "_rescued_data"]
    for w in which:
        part = raw.filter(F.col("source_file") == f"observations{w}.csv").select(*cols)
        SF.write_csv(part.withColumnRenamed("obs_ts", date_name), f"{root}/observations{w}")


def _org_csv(spark, d, root: str, split: bool = False) -> None:
    raw = org_raw(spark, d)
    cols = [c for c in raw.columns if c not in LINEAGE and c != "_rescued_data"]
    if split:
        SF.write_csv(raw.filter(F.col("Id").cast("bigint") % 2 == 0).select(*cols), f"{root}/organizations1")
        SF.write_csv(raw.filter(F.col("Id").cast("bigint") % 2 == 1).select(*cols), f"{root}/organizations2")
    else:
        SF.write_csv(raw.select(*cols), f"{root}/organizations1")


def _obs_schema(spark, d):
    return obs_raw(spark, d).drop(*LINEAGE, "_rescued_data").schema


def _org_schema(spark, d):
    return org_raw(spark, d).drop(*LINEAGE, "_rescued_data").schema


def _pat_schema(spark, d):
    return pat_raw(spark, d).drop(*LINEAGE, "_rescued_data").schema


def _schema_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


def _fresh_schema(spark, prefix: str) -> str:
    name = _schema_name(prefix)
    TB.ensure_schema(spark, name, f"{prefix} layer", f"{scratch_dir(spark, 'wh', keep=True)}/{name}")
    return name


# --- S: sources ------------------------------------------------------------


@register("scan_csv_batch")
def q_s1(spark, d):
    root = scratch_dir(spark, "s1")
    _org_csv(spark, d, root)
    return SF.read_csv(spark, f"{root}/organizations*", glob="*.csv")


@register("scan_csv_incremental")
def q_s2(spark, d):
    """Two runs; the second file is reordered and has a column more."""
    root = scratch_dir(spark, "s2")
    src, out, ck, sl = f"{root}/in", f"{root}/out", f"{root}/ck", f"{root}/schema"
    raw = org_raw(spark, d)
    cols = [c for c in raw.columns if c not in LINEAGE and c != "_rescued_data"]

    def run():
        ST.ingest_available(spark, f"{src}/organizations*", "*.csv", out, ck, schema_location=sl, infer_types=True, as_of=AS_OF)

    SF.write_csv(raw.filter(F.col("Id").cast("bigint") % 2 == 0).select(*cols), f"{src}/organizations1")
    run()
    SF.write_csv(raw.filter(F.col("Id").cast("bigint") % 2 == 1).select(*reversed(cols), F.lit("x").alias("EXTRA")),
                 f"{src}/organizations 2")
    run()
    return ST.read_batches(spark, out).drop(*LINEAGE)


@register("scan_csv_strings")
def q_s3(spark, d):
    root = scratch_dir(spark, "s3")
    _pat_csv(spark, d, f"{root}/in", drift=True)
    ST.ingest_available(spark, f"{root}/in/patients*", "*.csv", f"{root}/out", f"{root}/ck", schema=_pat_schema(spark, d), as_of=AS_OF)
    return ST.read_batches(spark, f"{root}/out").drop(*LINEAGE)


@register("lineage_file")
def q_s4(spark, d):
    root = scratch_dir(spark, "s4")
    _pat_csv(spark, d, root)
    df = SF.with_lineage(SF.read_csv(spark, f"{root}/patients*", schema=_pat_schema(spark, d), glob="*.csv"), as_of=AS_OF)
    return df.select("Id", _dir_of().alias("source_dir"))


@register("lineage_time")
def q_s5(spark, d):
    root = scratch_dir(spark, "s5")
    _pat_csv(spark, d, root)
    df = SF.with_lineage(SF.read_csv(spark, f"{root}/patients*", schema=_pat_schema(spark, d), glob="*.csv"), as_of=AS_OF)
    return df.select("Id", "MARITAL", "ingestion_timestamp")


@register("rescue_data")
def q_s6(spark, d):
    root = scratch_dir(spark, "s6")
    _pat_csv(spark, d, root, drift=True)
    raw = SF.read_csv_by_header(spark, f"{root}/patients*", "*.csv")
    typed = SF.rescue(raw, B.PATIENTS.schema, keep=("source_file",))
    return typed.select("Id", _dir_of().alias("source_dir"), "BIRTHDATE", "INCOME", "LAT", "ZIP", "_rescued_data")


@register("scan_table")
def q_s7(spark, d):
    db = _fresh_schema(spark, "silver")
    TB.write_table(obs(spark, d), f"{db}.observations")
    return SF.scan_table(spark, f"{db}.observations")


@register("scan_table_stream")
def q_s8(spark, d):
    root = scratch_dir(spark, "s8")
    org_silver(spark, d).write.parquet(f"{root}/silver_orgs")
    ST.run_available(SF.stream_table(spark, f"{root}/silver_orgs"), f"{root}/copy", f"{root}/ck")
    return spark.read.parquet(f"{root}/copy")


# --- K: sinks and table management ----------------------------------------


@register("sink_overwrite")
def q_k1(spark, d):
    db = _fresh_schema(spark, "silver")
    name = f"{db}.observations"
    TB.write_table(obs(spark, d), name)
    # Rewrite the table from a plan that reads it (staged version swap).
    TB.write_table(spark.table(name).filter(F.col("observation_value").isNotNull()), name)
    return spark.table(name)


@register("sink_append_stream")
def q_k2(spark, d):
    root = scratch_dir(spark, "k2")
    _obs_csv(spark, d, f"{root}/in")
    s = SF.stream_csv(spark, f"{root}/in/observations*", "*.csv", schema=_obs_schema(spark, d))
    ST.run_available(s, f"{root}/out", f"{root}/ck")
    return spark.read.parquet(f"{root}/out")


@register("streaming_table")
def q_k3(spark, d):
    root = scratch_dir(spark, "k3")
    _org_csv(spark, d, f"{root}/in", split=True)
    s = SF.stream_csv(spark, f"{root}/in/organizations*", "*.csv", schema=_org_schema(spark, d), max_files_per_trigger=1)
    s = s.withColumn("_rescued_data", F.lit(None).cast("string"))
    ST.streaming_table(s, E.catalogue("bronze_organizations", AS_OF), f"{root}/out", f"{root}/ck",
                       f"{root}/metrics", "bronze_organizations")
    return ST.read_batches(spark, f"{root}/out").drop("_rescued_data")


@register("materialized_table")
def q_k4(spark, d):
    db = _fresh_schema(spark, "bronze")
    TB.write_table(pat_raw(spark, d), f"{db}.patients")

    def build():
        return V.silver_patients(spark.table(f"{db}.patients"), AS_OF)

    return TB.materialized_table(spark, f"{db}.patients_silver", build, rules=E.catalogue("silver_patients", AS_OF))


@register("guarded_write")
def q_k5(spark, d):
    db = _fresh_schema(spark, "silver")
    name = f"{db}.patients"
    df = pat(spark, d).drop("processing_timestamp", "processing_date")
    TB.guarded_write(df, name, enabled=True)
    return TB.guarded_write(df, name, enabled=True)


@register("compact_table")
def q_k6(spark, d):
    db = _fresh_schema(spark, "silver")
    name = f"{db}.patients"
    TB.write_table(pat(spark, d).drop("processing_timestamp", "processing_date"), name)
    TB.compact(spark, name, cluster_by=["STATE"])
    return spark.table(name)


@register("table_properties")
def q_k7(spark, d):
    db = _fresh_schema(spark, "silver")
    name = f"{db}.organizations"
    TB.write_table(org_silver(spark, d), name)
    return TB.set_properties(spark, name, {"quality": "silver", "layer": "silver",
                                           "description": "Silver layer: validated organizations"})


@register("create_schema")
def q_k8(spark, d):
    db = _schema_name("gold")
    TB.ensure_schema(spark, db, "Gold layer: business aggregates", f"{scratch_dir(spark, 'wh', keep=True)}/{db}")
    TB.ensure_schema(spark, db, "Gold layer: business aggregates")  # idempotent
    TB.write_table(org_silver(spark, d), f"{db}.organizations")
    return spark.table(f"{db}.organizations")


@register("list_tables")
def q_k9a(spark, d):
    db = _fresh_schema(spark, "silver")
    TB.write_table(pat_pipeline(spark, d), f"{db}.patients")
    TB.write_table(org_silver(spark, d), f"{db}.organizations")
    TB.write_table(obs_pipeline(spark, d), f"{db}.observations")
    names = [r["tableName"] for r in TB.layer_tables(spark, db).collect()]  # table names only
    counts = [spark.table(f"{db}.{n}").agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("row_count")) for n in names]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


@register("describe_table")
def q_k9b(spark, d):
    db = _fresh_schema(spark, "silver")
    TB.write_table(pat(spark, d).drop("processing_timestamp", "processing_date"), f"{db}.patients")
    return TB.describe(spark, f"{db}.patients")


# --- B: bronze loads ---------------------------------------------------------


def _bronze_out(spark, path):
    return ST.read_batches(spark, path).withColumn("source_dir", _dir_of()).drop(*LINEAGE)


@register("bronze_patients_stream")
def q_b1(spark, d):
    root = scratch_dir(spark, "b1")
    _pat_csv(spark, d, f"{root}/in")
    B.bronze(spark, B.PATIENTS, f"{root}/in/patients*", f"{root}/out", f"{root}/ck", AS_OF, f"{root}/metrics",
             glob="*.csv")
    return _bronze_out(spark, f"{root}/out")


@register("bronze_organizations_stream")
def q_b2(spark, d):
    root = scratch_dir(spark, "b2")
    _org_csv(spark, d, f"{root}/in", split=True)
    B.bronze(spark, B.ORGANIZATIONS, f"{root}/in/organizations*", f"{root}/out", f"{root}/ck", AS_OF,
             f"{root}/metrics", glob="*.csv")
    return _bronze_out(spark, f"{root}/out")


@register("bronze_observations_stream")
def q_b3(spark, d):
    root = scratch_dir(spark, "b3")
    _obs_csv(spark, d, f"{root}/in", date_name="DATE")
    B.bronze(spark, B.OBSERVATIONS, f"{root}/in/observations*", f"{root}/out", f"{root}/ck", AS_OF,
             f"{root}/metrics", glob="*.csv", quarantine=True)
    return _bronze_out(spark, f"{root}/out")


@register("bronze_patients_batch")
def q_b4(spark, d):
    root = scratch_dir(spark, "b4")
    _pat_csv(spark, d, root)
    _, checks = B.load_patients(spark, f"{root}/patients*", "*.csv", AS_OF, B.PATIENTS)
    return checks


@register("bronze_observations_batch")
def q_b5(spark, d):
    root = scratch_dir(spark, "b5")
    raw = obs_raw(spark, d).withColumnRenamed("obs_ts", "DATE").drop(*LINEAGE, "_rescued_data")
    SF.write_csv(raw, f"{root}/observations1")
    _, checks = B.load_observations(spark, f"{root}/observations*", "*.csv", AS_OF, B.OBSERVATIONS)
    return checks


@register("bronze_patients_auto")
def q_b6(spark, d):
    root = scratch_dir(spark, "b6")
    _pat_csv(spark, d, f"{root}/in")
    B.auto_patients(spark, f"{root}/in/patients*", f"{root}/out", f"{root}/ck", f"{root}/schema", glob="*.csv", as_of=AS_OF)
    return _bronze_out(spark, f"{root}/out")


# --- ST: streams -------------------------------------------------------------


@register("stream_ingest")
def q_st1(spark, d):
    root = scratch_dir(spark, "st1")
    _org_csv(spark, d, f"{root}/in", split=True)
    ST.ingest_available(spark, f"{root}/in/organizations*", "*.csv", f"{root}/out", f"{root}/ck",
                        schema_location=f"{root}/schema", infer_types=True, as_of=AS_OF)
    return ST.read_batches(spark, f"{root}/out").drop(*LINEAGE)


@register("stream_table_to_table")
def q_st2(spark, d):
    root = scratch_dir(spark, "st2")
    _org_csv(spark, d, f"{root}/in", split=True)
    ST.ingest_available(spark, f"{root}/in/organizations*", "*.csv", f"{root}/bronze", f"{root}/ck1",
                        schema_location=f"{root}/schema", infer_types=True, as_of=AS_OF)
    ST.transform_stream(spark, f"{root}/bronze", V.silver_organizations, f"{root}/silver", f"{root}/ck2",
                        rules=E.catalogue("silver_organizations", AS_OF))
    return spark.read.parquet(f"{root}/silver").drop("silver_timestamp")


@register("stream_exactly_once")
def q_st3(spark, d):
    root = scratch_dir(spark, "st3")
    schema = _obs_schema(spark, d)
    src, out, ck = f"{root}/in", f"{root}/out", f"{root}/ck"

    def run():
        ST.run_available(SF.stream_csv(spark, f"{src}/observations*", "*.csv", schema=schema), out, ck)

    _obs_csv(spark, d, src, which=(1,))
    run()
    run()  # nothing new: adds no rows
    _obs_csv(spark, d, src, which=(2,))
    run()  # only the new file's rows
    return spark.read.parquet(out)


@register("stream_dedup_latest")
def q_st4(spark, d):
    root = scratch_dir(spark, "st4")
    raw = pat_raw(spark, d).drop("_rescued_data")
    schema = raw.schema
    order, ties = [F.desc_nulls_last("ingestion_timestamp")], [F.desc_nulls_last("source_file")]
    for s in (1, 2, 3):
        SF.write_csv(raw.filter(F.col("source_file") == f"patients{s}.csv"), f"{root}/in/patients{s}")
        stream = SF.stream_csv(spark, f"{root}/in/patients*", "*.csv", schema=schema)
        ST.dedup_stream(stream, ["Id"], order, f"{root}/out", f"{root}/ck", ties)
    return ST.read_latest(spark, f"{root}/out", ["Id"], order, ties).select("Id", "source_file", "MARITAL", "ingestion_timestamp")


def _activity(df: DataFrame) -> DataFrame:
    return df.groupBy("patient_id").agg(
        F.count(F.lit(1)).alias("total_observations"),
        F.min("observation_timestamp").alias("first_observation"),
        F.max("observation_timestamp").alias("last_observation"),
        F.count_if(F.col("value_type") == "numeric").alias("numeric_observations"),
    )


ACTIVITY_MERGE = {"total_observations": "sum", "first_observation": "min", "last_observation": "max",
                  "numeric_observations": "sum"}


@register("gold_incremental_refresh")
def q_st5(spark, d):
    root = scratch_dir(spark, "st5")
    schema = _obs_schema(spark, d)
    for w in (1, 2):
        _obs_csv(spark, d, f"{root}/in", which=(w,))
        s = SF.with_lineage(SF.stream_csv(spark, f"{root}/in/observations*", "*.csv", schema=schema), as_of=AS_OF)
        silver = checked(V.silver_observations(s, date_col="obs_ts"), "silver_observations")
        ST.refresh_groups(silver, ["patient_id"], _activity, ACTIVITY_MERGE, f"{root}/silver", f"{root}/gold", f"{root}/ck")
    return ST.read_groups(spark, f"{root}/gold", ["patient_id"], ACTIVITY_MERGE)
