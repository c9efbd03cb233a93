"""Row-quality expectations.

Three tiers: ``fail`` stops the run, ``drop`` removes the row, ``warn`` only
counts. A row passes a rule only when the predicate IS TRUE (a NULL result
is a violation). Everything stays lazy:

* fail rules become a ``raise_error`` inside the filter, so the job that
  consumes the frame (a write, a count) fails before anything is committed
  and no extra pass over the data is made;
* drop rules are a plain filter;
* counts come from one aggregate over all rules (``expectation_metrics``),
  or from ``DataFrame.observe`` on the consuming action (``observed``).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakestrata.functions.scalars import ratio

TIERS = ("fail", "drop", "warn")


@dataclass(frozen=True)
class Rule:
    name: str
    predicate: str
    tier: str = "warn"

    def passed(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))


def rules_from(fail: Mapping[str, str] | None = None, drop: Mapping[str, str] | None = None,
               warn: Mapping[str, str] | None = None) -> list[Rule]:
    out: list[Rule] = []
    for tier, m in (("fail", fail), ("drop", drop), ("warn", warn)):
        for name, pred in (m or {}).items():
            out.append(Rule(name, pred, tier))
    return out


def quarantined(rules: Sequence[Rule]) -> list[Rule]:
    """The same rules with fail rules as drop rules: breakers are set aside (``rejects``) instead of stopping the run."""
    return [Rule(r.name, r.predicate, "drop") if r.tier == "fail" else r for r in rules]


def _tier(rules: Iterable[Rule], tier: str) -> list[Rule]:
    return [r for r in rules if r.tier == tier]


def expect(df: DataFrame, rules: Sequence[Rule] = (), *, fail: Mapping[str, str] | None = None,
           drop: Mapping[str, str] | None = None, warn: Mapping[str, str] | None = None) -> DataFrame:
    """Apply expectations: raise on fail rules, remove drop-rule violators.

    Warn rules do not change the rows; count them with
    ``expectation_metrics`` or ``observed``.
    """
    rules = list(rules) + rules_from(fail, drop, warn)
    out = df
    fails = _tier(rules, "fail")
    if fails:
        cond = None
        for r in fails:
            c = F.when(~r.passed(), F.raise_error(F.lit(f"expectation '{r.name}' failed: {r.predicate}")))
            cond = c if cond is None else F.coalesce(cond, c)
        out = out.filter(F.coalesce(cond.cast("boolean"), F.lit(True)))
    drops = _tier(rules, "drop")
    if drops:
        keep = drops[0].passed()
        for r in drops[1:]:
            keep = keep & r.passed()
        out = out.filter(keep)
    return out


def violated_rules(rules: Sequence[Rule]) -> Column:
    """Array of names of the rules a row breaks."""
    arr = F.array(*[F.when(~r.passed(), F.lit(r.name)) for r in rules])
    return F.filter(arr, lambda x: x.isNotNull())


def rejects(df: DataFrame, rules: Sequence[Rule], col: str = "violated_rules", as_text: bool = True) -> DataFrame:
    """Rows removed by drop rules with the rules they broke (E7 quarantine)."""
    drops = _tier(rules, "drop") or list(rules)
    v = violated_rules(drops)
    out = df.withColumn(col, v).filter(F.size(F.col(col)) > 0)
    if as_text:
        out = out.withColumn(col, F.array_join(F.col(col), ","))
    return out


def split(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(passing rows, rejected rows); together they are the input minus fail-rule stops."""
    return expect(df, rules), rejects(expect(df, _tier(rules, "fail")), rules)


def expectation_metrics(df: DataFrame, rules: Sequence[Rule], table: str) -> DataFrame:
    """Per rule: table, tier, rule, total, passed, failed, failure_rate (E5).

    One aggregate computes every counter in a single pass; the one-row
    result is unpivoted with ``stack``.
    """
    aggs = [F.count(F.lit(1)).alias("_total")]
    for i, r in enumerate(rules):
        aggs.append(F.count_if(~r.passed()).alias(f"_f{i}"))
    one = df.agg(*aggs)
    parts = ", ".join(f"'{r.tier}', '{r.name}', _f{i}" for i, r in enumerate(rules))
    return _rates(one.selectExpr("_total", f"stack({len(rules)}, {parts}) AS (tier, rule, failed)"), table)


def observed_metrics(spark: SparkSession, counts: Mapping[str, int], rules: Sequence[Rule], table: str) -> DataFrame:
    """The rows of ``expectation_metrics`` from the counters that ``observed`` has filled: a row for each rule."""
    rows = [(counts["total_records"], r.tier, r.name, counts[r.name]) for r in rules]
    return _rates(spark.createDataFrame(rows, "_total long, tier string, rule string, failed long"), table)


def _rates(counted: DataFrame, table: str) -> DataFrame:
    """Metrics rows of (_total, tier, rule, failed)."""
    return counted.select(
        F.lit(table).alias("table_name"),
        "tier",
        "rule",
        F.col("_total").alias("total_records"),
        (F.col("_total") - F.col("failed")).alias("passed_records"),
        F.col("failed").alias("failed_records"),
        ratio("failed", "_total", 4).alias("failure_rate"),
    )


def breaches(metrics: DataFrame, limit: float = 0.05) -> DataFrame:
    """Rules whose failure rate is above ``limit``."""
    return metrics.filter(F.col("failure_rate") > F.lit(limit))


def observed(df: DataFrame, rules: Sequence[Rule], name: str = "expectations") -> tuple[DataFrame, Observation]:
    """Attach violation counters that are filled by the consuming action.

    Works on batch and streaming frames (metrics of a stream arrive in
    ``recentProgress``); costs no extra pass.
    """
    obs = Observation(name)
    exprs = [F.count(F.lit(1)).alias("total_records")] + [F.count_if(~r.passed()).alias(r.name) for r in rules]
    return df.observe(obs, *exprs), obs


# ---------------------------------------------------------------------------
# Rule catalogue (fixed values: tier, name and predicate of each rule).
# ``{today}`` and ``{now}`` are replaced by CURRENT_DATE() / CURRENT_TIMESTAMP()
# or by literals of a fixed clock.
# ---------------------------------------------------------------------------
CATALOGUE: dict[str, list[tuple[str, str, str]]] = {
    "bronze_patients": [
        ("fail", "valid_patient_id", "Id IS NOT NULL"),
        ("drop", "valid_birthdate", "BIRTHDATE IS NOT NULL"),
        ("drop", "valid_gender", "GENDER IN ('M', 'F')"),
        ("warn", "birthdate_in_past", "try_to_date(BIRTHDATE) <= {today}"),
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
        ("drop", "valid_observation_date", "DATE IS NOT NULL"),
        ("drop", "valid_observation_code", "CODE IS NOT NULL"),
        ("warn", "has_observation_value", "VALUE IS NOT NULL"),
        ("warn", "observation_in_past", "DATE <= {now}"),
        ("warn", "no_schema_drift", "_rescued_data IS NULL"),
    ],
    "silver_patients": [
        ("fail", "valid_patient_id", "patient_id IS NOT NULL"),
        ("drop", "valid_birthdate_range", "birth_date >= DATE'1900-01-01' AND birth_date <= {today}"),
        ("warn", "has_name", "first_name IS NOT NULL AND last_name IS NOT NULL"),
        ("warn", "valid_gender", "gender IN ('M', 'F')"),
        ("warn", "valid_state", "state IS NOT NULL"),
    ],
    "silver_organizations": [
        ("fail", "valid_org_id", "organization_id IS NOT NULL"),
        ("fail", "valid_org_name", "organization_name IS NOT NULL"),
        ("warn", "valid_state", "state IS NOT NULL"),
        ("warn", "valid_city", "city IS NOT NULL"),
        ("warn", "complete_location", "latitude IS NOT NULL AND longitude IS NOT NULL"),
    ],
    "silver_observations": [
        ("fail", "valid_patient_reference", "patient_id IS NOT NULL"),
        ("drop", "valid_observation_date", "observation_timestamp IS NOT NULL AND observation_timestamp <= {now}"),
        ("warn", "has_category", "category IS NOT NULL"),
        ("warn", "has_code", "loinc_code IS NOT NULL"),
        ("warn", "has_description", "description IS NOT NULL"),
        ("warn", "numeric_values_present", "value_type != 'numeric' OR (value_type = 'numeric' AND value_raw IS NOT NULL)"),
    ],
}


def catalogue(table: str, as_of: str | None = None, tiers: Sequence[str] = TIERS) -> list[Rule]:
    """Rules of one catalogue table, with the clock fixed when ``as_of`` is given."""
    if as_of is None:
        today, now = "CURRENT_DATE()", "CURRENT_TIMESTAMP()"
    else:
        today, now = f"DATE'{as_of[:10]}'", f"TIMESTAMP_NTZ'{as_of}'"
    return [Rule(n, p.format(today=today, now=now), t) for t, n, p in CATALOGUE[table] if t in tiers]
