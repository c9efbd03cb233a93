"""Registered queries: one callable per operator key, ``(spark, sf_dir) -> DataFrame``.

Inputs are the fixture relations of ``plans.fixtures`` over the given
tables, so every query's work grows with the data. Clocks are fixed
(``AS_OF`` for data tables, ``RUNS_AS_OF`` for the run log).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.functions import scalars as S
from lakestrata.operators import dedup as W
from lakestrata.operators import expectations as E
from lakestrata.operators import quality as Q
from lakestrata.plans import fixtures as X
from lakestrata.plans import gold as G
from lakestrata.plans import silver as V
from lakestrata.session import AS_OF, RUNS_AS_OF

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(key: str):
    def deco(fn: Query) -> Query:
        REGISTRY[key] = fn
        return fn

    return deco


# --- shared inputs ---------------------------------------------------------

def pat_raw(spark, d):
    return X.pat_raw(spark, d)


def obs_raw(spark, d):
    return X.obs_raw(spark, d)


def org_raw(spark, d):
    return X.org_raw(spark, d)


def pat(spark, d):
    """Silver typed patients (V2) at the fixed clock."""
    return V.silver_patients_typed(X.pat_raw(spark, d), AS_OF)


def obs(spark, d):
    """Silver typed observations (V5)."""
    return V.silver_observations_typed(X.obs_raw(spark, d), date_col="obs_ts")


def pat_unchecked(spark, d):
    return V.silver_patients(X.pat_raw(spark, d), AS_OF)


def checked(silver: DataFrame, table: str) -> DataFrame:
    """The silver rule set of a table; rows that break a fail rule are set aside (the stop itself is tested on its own)."""
    return E.expect(silver, E.quarantined(E.catalogue(table, AS_OF)))


def pat_pipeline(spark, d):
    return checked(pat_unchecked(spark, d), "silver_patients")


def org_silver(spark, d):
    return checked(V.silver_organizations(X.org_raw(spark, d)), "silver_organizations")


def obs_pipeline(spark, d):
    return checked(V.silver_observations(X.obs_raw(spark, d), date_col="obs_ts"), "silver_observations")


def _no_stamps(df: DataFrame) -> DataFrame:
    return df.drop("processing_timestamp", "processing_date")


# --- silver ----------------------------------------------------------------

@register("silver_patients_pipeline")
def q_v1(spark, d):
    return pat_pipeline(spark, d)


@register("silver_patients_batch")
def q_v2(spark, d):
    return _no_stamps(pat(spark, d))


@register("silver_organizations")
def q_v3(spark, d):
    return org_silver(spark, d)


@register("silver_observations_pipeline")
def q_v4(spark, d):
    return obs_pipeline(spark, d)


@register("silver_observations_batch")
def q_v5(spark, d):
    return obs(spark, d)


@register("silver_observation_summary")
def q_v6(spark, d):
    return V.observation_summary(obs(spark, d))


@register("silver_observation_type_breakdown")
def q_v6b(spark, d):
    return V.observation_type_breakdown(obs(spark, d))


@register("silver_patient_verification")
def q_v7b(spark, d):
    return V.patient_verification(pat(spark, d))


@register("silver_patient_summary")
def q_v7(spark, d):
    return V.patient_summary(pat(spark, d))


# --- gold ------------------------------------------------------------------

@register("gold_demographics")
def q_g1(spark, d):
    return G.demographics(pat(spark, d))


@register("gold_financial")
def q_g2(spark, d):
    return G.financial(pat(spark, d))


@register("gold_lifetime")
def q_g3(spark, d):
    return G.lifetime(pat(spark, d), AS_OF)


@register("gold_quality")
def q_g4(spark, d):
    return G.quality(pat(spark, d), AS_OF)


@register("gold_clinical_summary")
def q_g5(spark, d):
    return G.clinical_summary(obs(spark, d), pat(spark, d), AS_OF)


@register("gold_vital_signs")
def q_g6(spark, d):
    return G.vital_signs(obs(spark, d), pat(spark, d), AS_OF)


@register("gold_observation_types")
def q_g7(spark, d):
    return G.observation_types(obs(spark, d), pat(spark, d))


@register("gold_risk_indicators")
def q_g8(spark, d):
    return G.risk_indicators(obs(spark, d), pat(spark, d), AS_OF)


def _overview(spark, d):
    return G.patient_overview(obs(spark, d), pat(spark, d), X.pat_org(spark, d), org_silver(spark, d))


@register("gold_patient_overview")
def q_g9(spark, d):
    return _overview(spark, d)


@register("org_rollup")
def q_g10(spark, d):
    return G.org_rollup(_overview(spark, d))


@register("verify_demographics")
def q_g11(spark, d):
    return G.demographics_top(G.demographics(pat(spark, d)))


@register("verify_financial")
def q_g12a(spark, d):
    return G.financial_view(G.financial(pat(spark, d)))


@register("verify_lifetime")
def q_g12b(spark, d):
    return G.lifetime_view(G.lifetime(pat(spark, d), AS_OF))


@register("verify_quality")
def q_g12c(spark, d):
    return G.quality_view(G.quality(pat(spark, d), AS_OF))
