"""A key holding a third of all rows in joins that cannot be pre-aggregated:
its rows are salted, and results equal the plain join."""
from pyspark.sql import functions as F

from lakestrata.catalog import obs, pat
from lakestrata.operators.joins import hot_keys, skew_join
from lakestrata.plans import gold as G

AS_OF = "2024-06-30 00:00:00"
CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def _skewed(spark, sf_dir):
    o = obs(spark, sf_dir)
    hot = pat(spark, sf_dir).select("Id").orderBy("Id").first()["Id"]
    return o.withColumn("patient_id", F.when(F.xxhash64("encounter_id", "observation_date") % 3 == 0, F.lit(hot))
                        .otherwise(F.col("patient_id")))


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_hot_patient_is_salted(spark, sf_dir):
    old = {k: spark.conf.get(k, None) for k in CONF}
    try:
        for k, v in CONF.items():
            spark.conf.set(k, v)
        o = _skewed(spark, sf_dir)
        hot = pat(spark, sf_dir).select("Id").orderBy("Id").first()["Id"]
        assert max(hot_keys(o, ["patient_id"], 40).collect(), key=lambda r: r["_hot"])[0] == hot
        dim = pat(spark, sf_dir).selectExpr("Id AS patient_id", "GENDER")
        for keys_at_once in (100_000, 0):  # broadcast hot keys, and the other way
            for how in ("inner", "left", "left_semi", "left_anti"):
                j = skew_join(o, dim, "patient_id", how, rows_per_salt=40, broadcast_keys=keys_at_once)
                assert _rows(j) == _rows(o.join(dim, "patient_id", how)), how
        j = skew_join(o, dim, "patient_id", "inner", rows_per_salt=40)
        j.write.format("noop").mode("overwrite").save()
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(patient_id" in plan and "_salt" in plan.split("SortMergeJoin")[1].split("\n")[0]
        plain = o.filter((F.col("category") == "vital-signs") & F.col("observation_value").isNotNull()).join(
            pat(spark, sf_dir).selectExpr("Id AS patient_id"), "patient_id")
        g = G.vital_signs(o, pat(spark, sf_dir), AS_OF, rows_per_salt=40)
        assert g.agg(F.sum("observation_count")).first()[0] == plain.count()
        code = g.select("observation_code").first()[0]
        want = plain.filter(F.col("observation_code") == code).agg(F.min("observation_value"), F.max("observation_value")).first()
        got = g.filter(F.col("observation_code") == code).agg(F.min("min_value"), F.max("max_value")).first()
        assert [round(x, 2) for x in want] == list(got)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_equal_rows_and_null_keys_are_spread(spark):
    big = spark.createDataFrame([(1, "x")] * 3000 + [(None, "y")] * 3000 + [(2, "z")], "k int, v string").coalesce(1)
    small = spark.createDataFrame([(1, "a"), (3, "c")], "k int, w string")
    for how in ("inner", "left", "left_semi", "left_anti"):
        j = skew_join(big, small, "k", how, rows_per_salt=500)
        assert _rows(j) == _rows(big.join(small, "k", how)), how
    assert [r["_hot"] for r in hot_keys(big, ["k"], 500).collect()] == [6]


def test_no_hot_key_writes_nothing(spark, monkeypatch):
    """Without a hot key the join is the plain one; with one, scans are salted in place and shuffled facts are written once."""
    from lakestrata.operators import joins as J

    written = []
    real = J.scratch_table
    monkeypatch.setattr(J, "scratch_table", lambda df, name: written.append(name) or real(df, name))
    big = spark.range(3000).selectExpr("CAST(id % 3 AS INT) AS k", "id AS v", "id AS w")
    small = spark.createDataFrame([(1, "a"), (3, "c")], "k int, s string")
    plain = skew_join(big, small, "k", rows_per_salt=5000)
    assert "_salt" not in plain._jdf.queryExecution().toString() and written == []
    salted = skew_join(big, small, "k", rows_per_salt=300)
    assert "_salt" in salted._jdf.queryExecution().toString() and written == []
    assert _rows(salted) == _rows(big.join(small, "k"))
    counted = big.groupBy("k", "v").count()
    assert _rows(skew_join(counted, small, "k", rows_per_salt=300)) == _rows(counted.join(small, "k")) and written == ["skew-join"]


def test_vital_signs_under_skew_are_the_same_in_every_column(spark, sf_dir):
    o, p = _skewed(spark, sf_dir), pat(spark, sf_dir)
    assert _rows(G.vital_signs(o, p, AS_OF, rows_per_salt=40)) == _rows(G.vital_signs(o, p, AS_OF))


def _quantile_rows():
    import random

    rnd = random.Random(3)
    return [(rnd.choice(["a", None, "hot", "hot", "hot"]), rnd.choice([1.5, 2.0, rnd.random(), rnd.lognormvariate(0, 9), None])) for _ in range(4000)]


def _sorted_quantiles(rows, probs):
    import math

    out = {}
    for g in {k for k, _ in rows}:
        v = sorted(x for k, x in rows if k == g and x is not None)
        if v:
            out[g] = tuple(v[max(0, math.ceil(len(v) * p) - 1)] for p in probs)
    return out


def test_group_quantiles_match_sorting(spark, monkeypatch):
    from lakestrata.operators import quantiles as Q

    rows = _quantile_rows()
    probs = {"p0": 0.001, "p25": 0.25, "p50": 0.5, "p100": 1.0}
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    want = _sorted_quantiles(rows, probs.values())

    def got():
        return {r["g"]: tuple(r)[1:] for r in Q.group_quantiles(df, ["g"], "v", probs, 7).collect()}

    assert got() == want
    monkeypatch.setattr(Q, "FEW_VALUES", 10)  # the brackets hold more values than one window may order
    assert got() == want
    monkeypatch.setattr(Q, "FEW_GROUPS", 1)  # more groups than may be broadcast
    assert got() == want


def test_brackets_that_miss_are_counted_in_full(spark, monkeypatch):
    from lakestrata.operators import quantiles as Q

    rows = _quantile_rows()
    df = spark.createDataFrame(rows, "g string, v double").repartition(3)
    real = Q._bracket_counts

    def wrong(known, groups, value, brackets, n):  # one group's brackets lie above all its values, another's below
        ends = F.when(F.col("g") == "a", F.transform("_ends", lambda x: x + 1e30)).when(F.col("g") == "hot", F.transform("_ends", lambda x: x * 0 - 1))
        return real(known, groups, value, brackets.withColumn("_ends", F.coalesce(ends, "_ends")), n)

    monkeypatch.setattr(Q, "_bracket_counts", wrong)
    got = {r["g"]: tuple(r)[1:] for r in Q.group_quantiles(df, ["g"], "v", {"p25": 0.25, "p50": 0.5}).collect()}
    assert got == _sorted_quantiles(rows, (0.25, 0.5))
    empty = df.where("false")
    assert Q.group_quantiles(empty, ["g"], "v", {"p50": 0.5}).collect() == []
