"""Latest-record deduplication and duplicate inspection.

``dedup_latest`` keeps the ``row_number() = 1`` form on purpose: Catalyst
turns it into a partial ``WindowGroupLimit`` that runs *before* the shuffle
by key, so a key holding a third of all rows is cut to one row per partition
before it is exchanged. That limit sorts whole rows, and an input partition
may hold many times its bytes on disk, so rows are rebalanced first.

``duplicate_rank`` numbers every copy of a duplicated key without sending
a whole key group to one task, with JVM functions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.functions.scalars import ratio


def _cols(xs) -> list:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


#: Shuffle partitions up to which Spark writes rows to their files at once; beyond, a task first gathers and sorts them.
DIRECT_PARTITIONS = 200


def rebalanced(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same rows in partitions of about ``advisoryPartitionSizeInBytes``, equal keys together unless they fill several.

    The hash of the keys is no partitioning by the keys to Spark, so adaptive
    execution may split a hot partition; operators on whole keys shuffle again.
    """
    n = min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), DIRECT_PARTITIONS)
    return df.withColumn("_bucket", F.xxhash64(*_cols(keys))).hint("rebalance", n, "_bucket").drop("_bucket")


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column], ties: Sequence[Column] = ()) -> DataFrame:
    """Keep the first row per ``keys`` under ``order`` then ``ties``.

    Pass tie-break columns that make the order total within a key, or the
    survivor among exact ties is whichever row Spark meets first.
    """
    w = Window.partitionBy(*keys).orderBy(*order, *ties)
    return rebalanced(df, keys).withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def duplicate_keys(df: DataFrame, keys: Sequence[str], min_count: int = 2, count_col: str = "duplicate_count") -> DataFrame:
    """Keys occurring at least ``min_count`` times with their count.

    Partial aggregation combines map-side, so hot keys cost one row per
    map partition in the shuffle.
    """
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col)).filter(F.col(count_col) >= min_count)


def remaining_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Duplicate keys after dedup; the expected result is empty."""
    return duplicate_keys(df, keys, 2, "dup_count")


def dedup_stats(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: rows before, survivors, removed, percent removed.

    Both counts are scalar subqueries of one projection; nothing is
    collected to the driver.
    """
    b = before.select(F.count(F.lit(1))).scalar()
    a = after.select(F.count(F.lit(1))).scalar()
    spark = before.sparkSession
    return spark.range(1).select(
        b.alias("total_records"),
        a.alias("unique_records"),
        (b - a).alias("duplicates_removed"),
        ratio(b - a, b, 2, 100.0).alias("duplicate_pct"),
    )


def duplicate_rank(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    rank_col: str = "dup_rank",
    num_partitions: int | None = None,
) -> DataFrame:
    """All copies of duplicated keys with their 1-based rank under ``order``.

    Ties are ranked by a hash of the whole row, so only equal rows can swap.
    Skew-safe: rows are range-partitioned on (key, order, row hash), so even a
    hot key whose rows all tie spans many partitions; the numbered partitions
    are written once, and each (partition, key) start offset comes from a
    small count table.
    """
    from lakestrata.operators.joins import skew_join
    from lakestrata.session import scratch_table

    row, pid = "_row_hash", "_pid"
    dup = duplicate_keys(df, keys).select(*keys)
    rows = skew_join(df, dup, list(keys), "left_semi")
    rows = rows.withColumn(row, F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]))
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # both branches below must see the same range bounds
    ranged = scratch_table(rows.repartitionByRange(n, *_cols(keys), *order, row).withColumn(pid, F.spark_partition_id()), "dup-rank")
    counts = ranged.groupBy(pid, *keys).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    local = F.row_number().over(Window.partitionBy(pid, *keys).orderBy(*order, row))
    ranked = ranged.withColumn("_local", local).join(offsets, [pid, *keys], "inner")
    return ranked.withColumn(rank_col, F.col("_local") + F.col("_offset")).drop(pid, row, "_local", "_offset")
