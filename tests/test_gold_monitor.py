import datetime as dt

from pyspark.sql import functions as F

from lakestrata.plans import gold as G
from lakestrata.plans import monitor as M

AS_OF = "2024-06-30 00:00:00"
PAT_SCHEMA = ("Id string, BIRTHDATE date, DEATHDATE date, GENDER string, RACE string, STATE string, INCOME int, "
              "HEALTHCARE_EXPENSES double, HEALTHCARE_COVERAGE double, data_quality_flag int, ETHNICITY string, "
              "COUNTY string")
OBS_SCHEMA = ("observation_date timestamp_ntz, patient_id string, observation_code string, observation_description string,"
              " observation_value double, units string, observation_type string, category string, has_quality_issue int")


def _pat(spark):
    return spark.createDataFrame([
        ("p1", dt.date(1990, 1, 1), None, "F", "A", "S1", 1000, 10.0, 5.0, 0, "e", "c"),
        ("p2", dt.date(1950, 1, 1), dt.date(2020, 1, 1), "M", "A", "S1", 0, 20.0, 5.0, 1, "e", "c"),
    ], PAT_SCHEMA)


def _obs(spark, code, values):
    t = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([(t + dt.timedelta(days=i), "p1", code, "d", v, "u", "numeric", "vital-signs", 0)
                                  for i, v in enumerate(values)], OBS_SCHEMA)


def test_single_row_group_stats(spark):
    out = G.vital_signs(_obs(spark, "8867-4", [72.5]), _pat(spark), AS_OF).first()
    assert out["stddev_value"] is None
    assert out["p25_value"] == out["median_value"] == out["p75_value"] == 72.5


def test_risk_limits_and_severity(spark):
    # on the limit -> no risk; 5 and 10 occurrences -> Medium, High
    assert G.risk_indicators(_obs(spark, "8867-4", [60.0, 100.0]), _pat(spark), AS_OF).count() == 0
    five = G.risk_indicators(_obs(spark, "8867-4", [101.0] * 5), _pat(spark), AS_OF).first()
    assert five["risk_severity"] == "Medium" and five["risk_flag"] == "Heart Rate Abnormal"
    ten = G.risk_indicators(_obs(spark, "39156-5", [31.0] * 10), _pat(spark), AS_OF).first()
    assert ten["risk_severity"] == "High" and ten["risk_flag"] == "BMI Abnormal"


def test_financial_zero_income_ratio_is_null(spark):
    rows = {r["GENDER"]: r for r in G.financial(_pat(spark)).collect()}
    assert rows["M"]["expense_to_income_ratio"] is None
    assert rows["F"]["expense_to_income_ratio"] == 0.01


def test_clinical_summary_orphans_are_living(spark):
    o = _obs(spark, "8867-4", [70.0]).withColumn("patient_id", F.lit("ghost"))
    r = G.clinical_summary(o, _pat(spark), AS_OF).first()
    assert r["patient_status"] == "Living" and r["GENDER"] is None and r["observations_per_year"] == 1.0


def test_freshness_limits_and_empty(spark):
    def fresh(ts):
        df = spark.createDataFrame([(ts,)], "ingestion_timestamp timestamp_ntz")
        return M.freshness([("t", df)], AS_OF).first()["freshness_status"]

    assert fresh(dt.datetime(2024, 6, 29, 18, 0, 0)) == "FRESH"   # exactly 6.0 h
    assert fresh(dt.datetime(2024, 6, 29, 0, 0, 0)) == "STALE"    # exactly 24.0 h
    assert fresh(dt.datetime(2024, 6, 28, 23, 59, 59)) == "CRITICAL"
    empty = spark.createDataFrame([], "ingestion_timestamp timestamp_ntz")
    f = M.freshness([("e", empty)], AS_OF)
    assert f.first()["freshness_status"] == "EMPTY"
    alerts = M.alerts(fresh=f, as_of=AS_OF).collect()
    assert len(alerts) == 1 and alerts[0]["severity"] == "WARNING"


def test_drift_and_dedup_on_empty_tables(spark):
    empty = spark.createDataFrame([], "_rescued_data string, ingestion_timestamp timestamp_ntz")
    d = M.drift(empty, "e").first()
    assert d["total_records"] == 0 and d["records_with_schema_drift"] == 0 and d["schema_drift_pct"] is None
    assert d["drift_status"] == "NO DRIFT"
    e = M.dedup_effect(empty, empty, "e").first()
    assert e["deduplication_pct"] is None and e["status"] == "NO DEDUPLICATION"


def test_update_recency_and_success_rate(spark):
    runs = spark.createDataFrame([
        ("p", "COMPLETED", dt.datetime(2001, 7, 31, 0, 0), dt.datetime(2001, 7, 31, 1, 0)),
        ("p", "FAILED", dt.datetime(2001, 7, 30, 0, 0), dt.datetime(2001, 7, 30, 1, 0)),
    ], "pipeline_id string, state string, start_time timestamp_ntz, end_time timestamp_ntz")
    r = M.update_recency(runs, "2001-08-01 12:00:00").first()
    assert r["hours_since_last_update"] == 35.0 and r["update_status"] == "DELAYED"
    s = M.success_rate(runs, "2001-08-01 12:00:00").first()
    assert s["success_rate_pct"] == 50.0 and s["status"] == "WARNING"
    a = M.alerts(recency=M.update_recency(runs, "2001-08-01 12:00:00"), success=M.success_rate(runs, "2001-08-01 12:00:00"),
                 as_of="2001-08-01 12:00:00").collect()
    assert sorted(x["severity"] for x in a) == ["CRITICAL", "WARNING"]


def test_risk_rule_with_unit(spark):
    rules = [("8310-5", 97.0, 99.5, "Temperature Abnormal", "degF")]
    celsius = _obs(spark, "8310-5", [37.0]).withColumn("units", F.lit("Cel"))
    assert G.risk_indicators(celsius, _pat(spark), AS_OF, rules).count() == 0
    assert G.risk_indicators(celsius, _pat(spark), AS_OF).count() == 1  # published rules ignore the unit
