import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from lakestrata.operators import dedup as W


def _rows(n_keys=30, skew=400, seed=7):
    rnd = random.Random(seed)
    rows = []
    for k in range(n_keys):
        for j in range(rnd.randint(1, 4)):
            rows.append((f"k{k}", rnd.randint(0, 5), f"f{j}", rnd.random()))
    for j in range(skew):  # one hot key holding most rows
        rows.append(("hot", j % 7, f"f{j:04d}", float(j)))
    rows.append((None, 1, "fx", 0.5))
    rows.append((None, 2, "fy", 0.6))
    return rows


SCHEMA = "k string, ts int, f string, v double"


def test_dedup_latest_one_row_per_key_and_order_independent(spark):
    rows = _rows()
    results = []
    for parts in (1, 4, 16):
        shuffled = rows[:]
        random.Random(parts).shuffle(shuffled)
        df = spark.createDataFrame(shuffled, SCHEMA).repartition(parts)
        out = W.dedup_latest(df, ["k"], [F.desc("ts")], [F.desc("f")])
        got = sorted(out.collect(), key=lambda r: str(r["k"]))
        results.append(got)
    assert results[0] == results[1] == results[2]
    keys = [r["k"] for r in results[0]]
    assert len(keys) == len(set(keys))


def test_dedup_is_idempotent(spark):
    df = spark.createDataFrame(_rows(), SCHEMA)
    once = W.dedup_latest(df, ["k"], [F.desc("ts")], [F.desc("f")])
    twice = W.dedup_latest(once, ["k"], [F.desc("ts")], [F.desc("f")])
    assert sorted(once.collect(), key=str) == sorted(twice.collect(), key=str)


def test_dedup_plan_limits_before_shuffle(spark):
    df = spark.createDataFrame(_rows(), SCHEMA)
    plan = W.dedup_latest(df, ["k"], [F.desc("ts")], [F.desc("f")])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_dedup_sorts_rebalanced_rows(spark):
    """Wide rows that compress well: one input partition must not be sorted in one task."""
    df = spark.range(0, 200_000, 1, 1).select((F.col("id") % 150_000).cast("string").alias("k"), F.col("id").alias("ts"),
                                              F.repeat(F.lit("x"), 200).alias("wide"))
    out = W.dedup_latest(df, ["k"], [F.desc("ts")])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("Sort [") < plan.index("REBALANCE_PARTITIONS_BY_COL")  # no sort below the rebalancing
    assert out.columns == ["k", "ts", "wide"] and out.agg(F.count(F.lit(1)), F.min("ts")).first()[:] == (150_000, 50_000)


def test_duplicate_rank_matches_window_on_skewed_key(spark):
    df = spark.createDataFrame(_rows(), SCHEMA).repartition(5)
    order = [F.desc("ts"), F.asc("f")]
    got = W.duplicate_rank(df, ["k"], order, num_partitions=6)
    w = Window.partitionBy("k").orderBy(*order)
    dup = df.groupBy("k").count().filter("count > 1").select("k")
    exp = df.join(dup, "k", "left_semi").withColumn("dup_rank", F.row_number().over(w))
    a = sorted(got.select("k", "ts", "f", "v", "dup_rank").collect(), key=str)
    b = sorted(exp.select("k", "ts", "f", "v", "dup_rank").collect(), key=str)
    assert a == b
    assert got.filter("k = 'hot'").count() == 400


def test_dedup_stats_and_remaining_duplicates(spark):
    df = spark.createDataFrame(_rows(), SCHEMA)
    latest = W.dedup_latest(df, ["k"], [F.desc("ts")], [F.desc("f")])
    st = W.dedup_stats(df, latest).first()
    assert st["total_records"] == df.count()
    assert st["unique_records"] == latest.count()
    assert st["duplicates_removed"] == st["total_records"] - st["unique_records"]
    assert W.remaining_duplicates(latest, ["k"]).count() == 0
    empty = spark.createDataFrame([], SCHEMA)
    st0 = W.dedup_stats(empty, empty).first()
    assert st0["duplicate_pct"] is None


def test_duplicate_rank_keeps_values_and_spreads_ties(spark):
    import datetime as dt

    big = 2**53 + 1
    rows = [("a", big, dt.date(9999, 12, 31), 1), ("a", None, None, 1), ("b", 5, None, 1), ("b", 5, None, 1)]
    rows += [("hot", k, None, 7) for k in range(500)]
    df = spark.createDataFrame(rows, "k string, n long, d date, ts int").repartition(3)
    out = W.duplicate_rank(df, ["k"], [F.desc("ts")], num_partitions=6).collect()
    assert sorted(((r.k, r.n, r.d, r.ts) for r in out), key=repr) == sorted(rows, key=repr)
    for k, n in (("a", 2), ("b", 2), ("hot", 500)):
        assert sorted(r.dup_rank for r in out if r.k == k) == list(range(1, n + 1))
    again = W.duplicate_rank(df.repartition(5), ["k"], [F.desc("ts")], num_partitions=4).collect()
    assert {(r.k, r.n, r.dup_rank) for r in out if r.k != "b"} == {(r.k, r.n, r.dup_rank) for r in again if r.k != "b"}
    plan = W.duplicate_rank(df, ["k"], [F.desc("ts")])._jdf.queryExecution().toString()
    assert "Python" not in plan and "MapInPandas" not in plan
