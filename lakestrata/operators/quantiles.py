"""Exact group quantiles by narrowing.

One pass takes each group's row count and, from a mergeable sketch, two values
around each wanted rank (the sketch's error is known). The next pass counts the
rows below each of these brackets and the rows of each distinct value inside
it: only a few hundredths of the values are shuffled, summed per task first. A
bracket is right if the wanted rank lies inside by these exact counts, and the
answer is then the value at that rank; the sketch decides the cost, never the
result. Groups for which a bracket misses, and tables of more groups than the
brackets of which may be broadcast, go the full way: all (group, value) counts
are range-partitioned and written once, and a partition's rows before it in its
group come from the sums of the earlier partitions, so a hot group is numbered
by many tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.session import scratch_table

#: The sketch's error as a share of a group's rows is one over this; brackets are twice as wide on both sides.
ACCURACY = 500
#: Groups whose brackets are kept in the plan and broadcast; distinct values in brackets that one window may order.
FEW_GROUPS, FEW_VALUES = 10_000, 1_000_000


def group_quantiles(df: DataFrame, groups: Sequence[str], value: str, probs: Mapping[str, float],
                    num_partitions: int | None = None) -> DataFrame:
    """``groups`` and one column for each prob: the least value with at least that share of the group's rows at or below it."""
    groups, names = list(groups), list(probs)
    known = df.where(F.col(value).isNotNull())
    margin = 2 / ACCURACY
    ends = [x for p in probs.values() for x in (max(0.0, p - margin), min(1.0, p + margin))]
    sketch = known.groupBy(*groups).agg(F.count(F.lit(1)).alias("_total"), F.percentile_approx(value, ends, F.lit(ACCURACY)).alias("_ends"))
    spark, first = df.sparkSession, sketch.limit(FEW_GROUPS + 1).toArrow()  # bounded by FEW_GROUPS
    if first.num_rows > FEW_GROUPS:
        return _all_counted(known, groups, value, probs, num_partitions)
    brackets = spark.createDataFrame(first, sketch.schema)
    counts = _bracket_counts(known, groups, value, brackets, len(names))
    if sum(first["_total"].to_pylist()) * 4 * margin * len(names) > FEW_VALUES:
        counts = scratch_table(counts, "quantiles")
        if counts.count() > FEW_VALUES:
            return _all_counted(known, groups, value, probs, num_partitions)
    order = Window.partitionBy(*groups).orderBy("_gap", F.asc_nulls_first("_v")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counts.withColumn("_upto", F.sum("_n").over(order))

    def at(p: float) -> Column:
        """The value at the wanted rank; NULL where that row is one of a gap."""
        rank = F.ceil(F.col("_total") * F.lit(p))
        return F.max(F.when((F.col("_upto") >= rank) & (F.col("_upto") - F.col("_n") < F.greatest(rank, F.lit(1))), F.col("_v")))

    got = ranked.groupBy(*groups).agg(*[at(p).alias(n) for n, p in probs.items()])
    table = got.dropna(subset=names).toArrow()  # as many rows as brackets at most
    found = spark.createDataFrame(table, got.schema)
    if table.num_rows == first.num_rows:
        return found
    rest = brackets.select(*groups).toDF(*_aliases(groups)).join(found, _same(groups), "left_anti")
    again = known.join(F.broadcast(rest), _same(groups), "left_semi")
    return found.unionByName(_all_counted(again, groups, value, probs, num_partitions))


def _aliases(groups: Sequence[str]) -> list[str]:
    return [f"_g{i}" for i in range(len(groups))]


def _same(groups: Sequence[str]) -> Column:
    same = F.lit(True)
    for g, a in zip(groups, _aliases(groups)):
        same = same & F.col(g).eqNullSafe(F.col(a))
    return same


def _bracket_counts(known: DataFrame, groups: Sequence[str], value: str, brackets: DataFrame, n: int) -> DataFrame:
    """(groups, _gap, _v, _n, _total): rows of each value inside a bracket, and with a NULL ``_v`` the rows between brackets.

    ``_gap`` is the number of brackets that end below; inside it, the rows before the next bracket come first.
    """
    v, ends = F.col(value), F.col("_ends")
    inside, gap = F.lit(False), F.lit(0)
    for k in range(n):
        inside = inside | ((v >= ends[2 * k]) & (v <= ends[2 * k + 1]))
        gap = gap + (v > ends[2 * k + 1]).cast("int")
    wide = known.join(F.broadcast(brackets.toDF(*_aliases(groups), "_total", "_ends")), _same(groups))
    return wide.groupBy(*groups, gap.alias("_gap"), F.when(inside, v).alias("_v")).agg(
        F.count(F.lit(1)).alias("_n"), F.first("_total").alias("_total"))


def _all_counted(known: DataFrame, groups: Sequence[str], value: str, probs: Mapping[str, float], num_partitions: int | None) -> DataFrame:
    """The same over all values: no group or value stands in one task."""
    counts = known.groupBy(*groups, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    n = num_partitions or int(known.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = scratch_table(counts.repartitionByRange(n, *groups, "_v").withColumn("_pid", F.spark_partition_id()), "quantiles")
    parts = rows.groupBy("_pid", *groups).agg(F.sum("_n").alias("_sum"))
    whole = Window.partitionBy(*groups)
    before = whole.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)], F.col("_pid").alias("_p"),
                         F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"), F.sum("_sum").over(whole).alias("_total"))
    upto = Window.partitionBy("_pid", *groups).orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = rows.withColumn("_upto", F.sum("_n").over(upto))
    placed = local.join(parts, (F.col("_pid") == F.col("_p")) & _same(groups)).withColumn("_upto", F.col("_upto") + F.col("_before"))
    return placed.groupBy(*groups).agg(*[
        F.min(F.when(F.col("_upto") >= F.ceil(F.col("_total") * F.lit(p)), F.col("_v"))).alias(name) for name, p in probs.items()])
