"""Registered queries for expectations, monitoring, integrity checks and
profiling (E, M, R, B7, B8 keys)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakestrata.catalog import obs, obs_pipeline, obs_raw, org_raw, org_silver, pat, pat_pipeline, pat_raw, pat_unchecked, register
from lakestrata.operators import expectations as E
from lakestrata.operators import quality as Q
from lakestrata.plans import fixtures as X
from lakestrata.plans import monitor as M
from lakestrata.session import AS_OF, RUNS_AS_OF, scratch_table


def _obs_bronze(spark, d):
    """Bronze observations with the source column name DATE."""
    return obs_raw(spark, d).withColumnRenamed("obs_ts", "DATE")


def _bronze_metrics(spark, d):
    return Q.stack_metrics(
        E.expectation_metrics(pat_raw(spark, d), E.catalogue("bronze_patients", AS_OF), "bronze_patients"),
        E.expectation_metrics(org_raw(spark, d), E.catalogue("bronze_organizations", AS_OF), "bronze_organizations"),
        E.expectation_metrics(_obs_bronze(spark, d), E.catalogue("bronze_observations", AS_OF), "bronze_observations"),
    )


# --- E: expectations -------------------------------------------------------


@register("expect_or_fail")
def q_e1(spark, d):
    return E.expect(pat_raw(spark, d), E.catalogue("bronze_patients", AS_OF, ("fail",))).select("Id", "source_file", "GENDER")


@register("expect_or_drop")
def q_e2(spark, d):
    rules = E.catalogue("bronze_patients", AS_OF, ("fail", "drop"))
    return E.expect(pat_raw(spark, d), rules).select("Id", "source_file", "BIRTHDATE", "GENDER")


@register("expect_monitor")
def q_e3(spark, d):
    return E.expectation_metrics(pat_raw(spark, d), E.catalogue("bronze_patients", AS_OF, ("warn",)), "bronze_patients")


@register("expect_all")
def q_e4(spark, d):
    return E.expectation_metrics(pat_unchecked(spark, d), E.catalogue("silver_patients", AS_OF, ("warn",)), "silver_patients")


@register("expectation_metrics")
def q_e5(spark, d):
    return _bronze_metrics(spark, d)


@register("expectation_breach")
def q_e6(spark, d):
    return E.breaches(_bronze_metrics(spark, d), M.FAILURE_RATE_LIMIT)


@register("quarantine_rows")
def q_e7(spark, d):
    rules = E.catalogue("bronze_patients", AS_OF, ("drop",))
    return E.rejects(pat_raw(spark, d), rules).select("Id", "source_file", "violated_rules")


# --- M: monitoring ---------------------------------------------------------


def _drifts(spark, d):
    return Q.stack_metrics(
        M.drift(pat_raw(spark, d), "Patients"),
        M.drift(org_raw(spark, d), "Organizations"),
        M.drift(obs_raw(spark, d), "Observations"),
    )


def _fresh(spark, d):
    return M.freshness(
        [("Patients", pat_raw(spark, d)), ("Organizations", org_raw(spark, d)), ("Observations", obs_raw(spark, d))], AS_OF
    )


@register("schema_drift")
def q_m1(spark, d):
    return _drifts(spark, d)


@register("dedup_effectiveness")
def q_m2(spark, d):
    return M.dedup_effect(pat_raw(spark, d), pat_pipeline(spark, d), "Patients")


@register("layer_counts")
def q_m3(spark, d):
    return M.layer_counts([
        ("Patients", pat_pipeline(spark, d), "patient_id"),
        ("Organizations", org_silver(spark, d), "organization_id"),
        ("Observations", obs_pipeline(spark, d), "patient_id"),
    ])


@register("freshness")
def q_m4(spark, d):
    return _fresh(spark, d)


@register("update_recency")
def q_m5(spark, d):
    return M.update_recency(X.runs(spark, d), RUNS_AS_OF)


@register("alerts")
def q_m6(spark, d):
    runs = X.runs(spark, d)
    health = scratch_table(Q.stack_metrics(*[  # one pass over each table, one row each
        M.table_health(df, label, table, E.catalogue(table, AS_OF)) for df, label, table in (
            (pat_raw(spark, d), "Patients", "bronze_patients"),
            (org_raw(spark, d), "Organizations", "bronze_organizations"),
            (_obs_bronze(spark, d), "Observations", "bronze_observations"))]), "health")
    return M.alerts(
        fresh=M.freshness_of(health),
        drifts=M.drift_of(health),
        metrics=M.metrics_of(health),
        as_of=AS_OF,
    ).unionByName(M.alerts(
        recency=M.update_recency(runs, RUNS_AS_OF), success=M.success_rate(runs, RUNS_AS_OF), as_of=RUNS_AS_OF,
    ))


@register("monitored_tables")
def q_m7(spark, d):
    return M.inventory([
        ("bronze_patients", "BRONZE", pat_raw(spark, d)),
        ("bronze_organizations", "BRONZE", org_raw(spark, d)),
        ("bronze_observations", "BRONZE", obs_raw(spark, d)),
        ("silver_patients", "SILVER", pat_pipeline(spark, d)),
        ("silver_organizations", "SILVER", org_silver(spark, d)),
        ("silver_observations", "SILVER", obs_pipeline(spark, d)),
    ])


@register("run_success_rate")
def q_m8(spark, d):
    return M.success_rate(X.runs(spark, d), RUNS_AS_OF)


@register("run_duration_trend")
def q_m9(spark, d):
    return M.duration_trend(X.runs(spark, d))


@register("layer_reconciliation")
def q_m10(spark, d):
    pr = pat_raw(spark, d)
    prules = E.catalogue("bronze_patients", AS_OF, ("drop",))
    orr = org_raw(spark, d)
    orules = E.catalogue("bronze_organizations", AS_OF, ("drop",))
    # silver is computed from the rows that pass the drop rules
    from lakestrata.plans import silver as V

    srules = E.quarantined(E.catalogue("silver_patients", AS_OF))
    p_latest = V.silver_patients(E.expect(pr, prules), AS_OF)
    o_silver = V.silver_organizations(E.expect(orr, orules))
    ob = _obs_bronze(spark, d)
    obrules, osrules = (E.quarantined(E.catalogue(t, AS_OF, ("fail", "drop"))) for t in ("bronze_observations", "silver_observations"))
    o_all = V.silver_observations(E.expect(ob, obrules))
    return Q.stack_metrics(
        M.reconcile("Patients", pr, E.expect(p_latest, srules), E.rejects(pr, prules), E.rejects(p_latest, srules)),
        M.reconcile("Organizations", orr, o_silver, E.rejects(orr, orules)),
        M.reconcile("Observations", ob, E.expect(o_all, osrules), E.rejects(ob, obrules), E.rejects(o_all, osrules)),
    )


# --- R / B7 / B8: integrity and profiling -----------------------------------


@register("null_key_check")
def q_r1(spark, d):
    return Q.null_keys(_obs_bronze(spark, d), ["PATIENT", "DATE", "CODE", "ENCOUNTER"])


@register("orphan_rows")
def q_r2(spark, d):
    return Q.orphans(obs(spark, d), pat(spark, d), "patient_id", "Id").select(
        "patient_id", "observation_date", "observation_code", "observation_value"
    )


@register("remaining_duplicates")
def q_r3(spark, d):
    from lakestrata.operators.dedup import remaining_duplicates

    return remaining_duplicates(pat(spark, d), ["Id"])


@register("ingest_verification")
def q_b7(spark, d):
    return Q.verify_ingest(pat_raw(spark, d), "Id")


@register("null_profile")
def q_b8(spark, d):
    return Q.null_profile(pat_raw(spark, d), ["BIRTHDATE", "DEATHDATE", "SSN", "GENDER", "INCOME", "_rescued_data"])
