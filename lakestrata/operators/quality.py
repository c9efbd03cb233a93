"""Profiling and integrity checks (B7, B8, U3, R1, R2) and result helpers
(U1, A13, A15, L1-L3).

Each check is a single aggregate over the input; multi-row reports are the
one-row aggregate unpivoted with ``stack``, so no per-check job is run and
nothing but the final report is small enough to look at on the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.functions.scalars import ratio


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def null_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Null count and percent of rows for each column, one pass."""
    aggs = [F.count(F.lit(1)).alias("_total")] + [F.count_if(F.col(_q(c)).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)]
    one = df.agg(*aggs)
    parts = ", ".join(f"'{c}', _n{i}" for i, c in enumerate(cols))
    st = one.selectExpr("_total", f"stack({len(cols)}, {parts}) AS (column_name, null_count)")
    return st.select(
        "column_name",
        F.col("_total").alias("total_rows"),
        "null_count",
        ratio("null_count", "_total", 2, 100.0).alias("null_pct"),
    )


def null_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows with a NULL in each key column and PASS / WARN."""
    return null_profile(df, cols).select(
        "column_name",
        "null_count",
        F.when(F.col("null_count") > 0, F.lit("WARN")).otherwise(F.lit("PASS")).alias("status"),
    )


def orphans(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Fact rows whose non-NULL key has no dimension row (R2).

    ``left_anti`` through ``skew_join``: the rows of a fact key holding a
    large share of the rows are salted over sub-keys, so no task gets all
    of them.
    """
    from lakestrata.operators.joins import skew_join

    d = dim.select(F.col(dim_key).alias(fact_key)).distinct()
    f = fact.filter(F.col(fact_key).isNotNull())
    return skew_join(f, d, [fact_key], "left_anti")


def verify_ingest(df: DataFrame, key: str, file_col: str = "source_file", time_col: str = "ingestion_timestamp") -> DataFrame:
    """Rows, unique keys, first/last ingestion, file count, lineage presence."""
    cols = set(df.columns)
    has_file = file_col in cols
    has_time = time_col in cols
    aggs = [F.count(F.lit(1)).alias("total_records"), F.count_distinct(F.col(key)).alias("unique_keys")]
    aggs.append(F.min(time_col).alias("first_ingestion") if has_time else F.lit(None).cast("timestamp").alias("first_ingestion"))
    aggs.append(F.max(time_col).alias("last_ingestion") if has_time else F.lit(None).cast("timestamp").alias("last_ingestion"))
    aggs.append(F.count_distinct(F.col(file_col)).alias("source_files") if has_file else F.lit(0).cast("bigint").alias("source_files"))
    return df.agg(*aggs).withColumns(
        {"has_source_file": F.lit(has_file), "has_ingestion_timestamp": F.lit(has_time)}
    )


def schema_diff(df: DataFrame, expected: Mapping[str, str]) -> DataFrame:
    """Columns and their values against a declared schema.

    ``expected`` maps names to types. One row per column: column_name,
    expected_type, actual_type, value_count (non-NULL values), misfit_count
    (values that do not cast to the declared type) and status: MISSING, EXTRA,
    OK, CASTABLE (another type, but every value fits) or TYPE_CHANGED. All
    counts come from one aggregate over the table.
    """
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    names = [*expected, *(c for c in actual if c not in expected)]
    aggs, rows = [], []
    for i, name in enumerate(names):
        want, have = expected.get(name), actual.get(name)
        col = F.col(f"`{name}`") if have else F.lit(None)
        misfit = F.lit(0) if not (want and have) or want == have else F.when(col.isNotNull() & col.try_cast(want).isNull(), 1).otherwise(0)
        aggs += [F.count(col).alias(f"_v{i}"), F.coalesce(F.sum(misfit), F.lit(0)).cast("long").alias(f"_m{i}")]
        changed = F.when(F.col(f"_m{i}") > 0, "TYPE_CHANGED").otherwise("CASTABLE")
        status = (F.lit("MISSING") if have is None else F.lit("EXTRA") if want is None else F.lit("OK") if want == have else changed)
        rows.append(F.struct(F.lit(name).alias("column_name"), F.lit(want).cast("string").alias("expected_type"),
                             F.lit(have).cast("string").alias("actual_type"), F.col(f"_v{i}").alias("value_count"),
                             F.col(f"_m{i}").alias("misfit_count"), status.alias("status")))
    return df.agg(*aggs).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def stack_metrics(*dfs: DataFrame) -> DataFrame:
    """UNION ALL of per-table metric rows; names from the first, types widened."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.union(d)
    return out


def value_counts(df: DataFrame, col: str, count_col: str = "count") -> DataFrame:
    """Frequency of each value, most frequent first."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(count_col)).orderBy(F.desc(count_col), F.asc_nulls_first(col))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct values of one column."""
    return df.select(col).distinct()


def sort_desc(df: DataFrame, col: str, ties: Sequence[Column] = ()) -> DataFrame:
    """Order by a measure descending with explicit tie-breaks (L1)."""
    return df.orderBy(F.desc_nulls_last(col), *ties)


def top_k(df: DataFrame, k: int, by: Sequence[Column], ties: Sequence[Column] = ()) -> DataFrame:
    """Largest k rows (L2): a bounded top-k per partition, then a merge."""
    return df.orderBy(*by, *ties).limit(k)


def preview(df: DataFrame, n: int, by: Sequence[Column]) -> DataFrame:
    """First n rows under a key order (L3), deterministic."""
    return df.orderBy(*by).limit(n)
