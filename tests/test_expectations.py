import pytest
from pyspark.sql import functions as F

from lakestrata.operators import expectations as E

SCHEMA = "Id string, GENDER string, BIRTHDATE string, _rescued_data string"
ROWS = [("1", "M", "2000-01-01", None), ("2", None, "2001-01-01", None), ("3", "X", None, '{"a":"b"}'),
        ("4", "F", "2002-02-02", None)]


def test_drop_rules_and_null_predicate(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    rules = E.catalogue("bronze_patients", "2024-06-30 00:00:00", ("fail", "drop"))
    kept = E.expect(df, rules)
    assert sorted(r["Id"] for r in kept.collect()) == ["1", "4"]  # NULL gender is not a pass
    rej = E.rejects(df, rules)
    assert {r["Id"]: r["violated_rules"] for r in rej.collect()} == {"2": "valid_gender",
                                                                       "3": "valid_birthdate,valid_gender"}
    assert kept.count() + rej.count() == df.count()


def test_fail_rule_raises_when_consumed(spark):
    df = spark.createDataFrame(ROWS + [(None, "M", "2000-01-01", None)], SCHEMA)
    out = E.expect(df, fail={"valid_patient_id": "Id IS NOT NULL"})
    with pytest.raises(Exception, match="valid_patient_id"):
        out.count()


def test_metrics_one_pass(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    m = {r["rule"]: r for r in E.expectation_metrics(df, E.catalogue("bronze_patients", "2024-06-30 00:00:00"),
                                                      "bronze_patients").collect()}
    assert m["valid_gender"]["failed_records"] == 2
    assert m["no_schema_drift"]["failed_records"] == 1
    assert m["valid_patient_id"]["failure_rate"] == 0.0
    assert m["valid_gender"]["failure_rate"] == 0.5
    assert E.breaches(E.expectation_metrics(df, E.catalogue("bronze_patients"), "t"), 0.3).count() == 1  # valid_gender 50%


def test_empty_table_metrics(spark):
    df = spark.createDataFrame([], SCHEMA)
    m = E.expectation_metrics(df, E.catalogue("bronze_patients"), "t").collect()
    assert all(r["total_records"] == 0 and r["failure_rate"] is None for r in m)


def test_observed_counts_on_action(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    obs_df, obs = E.observed(df, E.catalogue("bronze_patients"))
    obs_df.write.format("noop").mode("overwrite").save()
    assert obs.get["total_records"] == 4
    assert obs.get["valid_gender"] == 2
