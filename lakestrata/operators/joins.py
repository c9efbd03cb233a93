"""Joins that stay balanced when one key holds a large share of the rows.

AQE splits a skewed join partition only when both inputs come straight from a
shuffle. A dimension already partitioned on the key (for example the output of
a dedup window on that key) is joined without a new shuffle, so AQE cannot
split a hot key there: a key with a third of the fact rows would be one task.

``skew_join`` salts hot keys instead. A key is hot when it has more than
``rows_per_salt`` rows, which is what one task should take; there is no fixed
number of hot keys. A pass over the key columns alone counts the rows of each
key (map-side first). Without a hot key the join is the plain one: nothing is
written and pruning reaches the scan. Otherwise fact rows of a hot key go round
robin over its sub-keys, one for each ``rows_per_salt`` rows, so equal rows are
spread as well; dimension rows of a hot key are repeated once for each sub-key.
Many fact rows with a NULL key match nothing and go round robin too. The join on
(key, sub-key) then has no group larger than about ``rows_per_salt`` fact rows.
Results equal the plain join for inner, left, semi and anti joins.

The turns of the round robin are drawn in the scan of the facts. They must come
out alike when a task runs again, which holds for scans, filters and
projections; facts that come out of a shuffle are written to the shared folder
first, but only where a key is hot. Up to ``broadcast_keys`` hot keys are kept
as rows of the plan and broadcast; more are written and joined through repeated
copies of the hot-key table.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.session import scratch_table

SUPPORTED = ("inner", "left", "left_semi", "left_anti")
SALT = "_salt"
HOT = "_hot"
#: Sub-keys for NULL keys, and copies of the hot-key table where it is not broadcast.
SPREAD = 64


def _any_null(keys: Sequence[str]) -> Column:
    return F.greatest(*[F.col(k).isNull() for k in keys]) if len(keys) > 1 else F.col(keys[0]).isNull()


def _large(big: DataFrame, keys: Sequence[str], rows_per_salt: int) -> DataFrame:
    """Keys (NULL ones as well) with more than ``rows_per_salt`` rows and their number of sub-keys (``_hot``)."""
    counts = big.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return counts.filter(F.col("_n") > rows_per_salt).select(
        *keys, F.ceil(F.col("_n") / F.lit(rows_per_salt)).cast("int").alias(HOT))


def hot_keys(big: DataFrame, keys: Sequence[str], rows_per_salt: int = 500_000) -> DataFrame:
    """Non-NULL keys with more than ``rows_per_salt`` rows and their number of sub-keys (``_hot``)."""
    return _large(big, keys, rows_per_salt).dropna(subset=list(keys))


def _repeatable(df: DataFrame) -> bool:
    """Whether a task that runs again meets the same rows in the same order: no shuffle feeds it."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return not re.search(r"^[\s:+-]*(?:\w*Join|\w*Aggregate|Window\w*|\w*Sort|\w*Repartition\w*|RebalancePartitions|\w*Limit|\w*Distinct|Sample|Intersect|Except"
                         r"|FlatMap(?:Co)?Groups\w*)\b", plan, re.M)


def skew_join(big: DataFrame, small: DataFrame, keys: Sequence[str] | str, how: str = "inner",
              rows_per_salt: int = 500_000, broadcast_keys: int = 100_000) -> DataFrame:
    """``big.join(small, keys, how)`` with the hot keys of ``big`` salted."""
    if how not in SUPPORTED:
        raise ValueError(f"skew_join supports {SUPPORTED}, not {how!r}")
    keys = [keys] if isinstance(keys, str) else list(keys)
    spark, large = big.sparkSession, _large(big, keys, rows_per_salt)
    first = large.limit(broadcast_keys + 1).collect()  # bounded by broadcast_keys
    if not first:
        return big.join(small, keys, how)
    few = len(first) <= broadcast_keys
    hot = (spark.createDataFrame(first, large.schema) if few else scratch_table(large, "hot-keys")).dropna(subset=keys)
    if not _repeatable(big):
        big = scratch_table(big, "skew-join")
    turn = F.monotonically_increasing_id()
    if few:
        b = big.withColumn("_turn", turn).join(F.broadcast(hot), keys, "left")
    else:
        copies = hot.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
        b = (big.withColumn("_turn", turn).withColumn("_copy", F.pmod("_turn", F.lit(SPREAD)).cast("int"))
             .join(copies, [*keys, "_copy"], "left").drop("_copy"))
    b = b.withColumn(SALT, F.when(_any_null(keys), F.pmod("_turn", F.lit(SPREAD)))
                     .otherwise(F.pmod("_turn", F.coalesce(F.col(HOT), F.lit(1)))).cast("int")).drop(HOT, "_turn")
    s = small.join(F.broadcast(hot) if few else hot, keys, "left").withColumn(
        SALT, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(HOT), F.lit(1)) - 1))).drop(HOT)
    return b.join(s, [*keys, SALT], how).drop(SALT)
