"""Tables kept as runs: replays, several writers, folding, lost commits."""
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from lakestrata.operators.dedup import dedup_latest
from lakestrata.streaming import ingest as ST
from lakestrata.streaming import runs as R

MERGE = {"n": "sum", "top": "max"}


def _agg(df):
    return df.groupBy("g").agg(F.count("*").alias("n"), F.max("v").alias("top"))


def _lose_commit(ck, batch):
    for name in (f"{ck}/commits/{batch}", f"{ck}/commits/.{batch}.crc"):
        if os.path.exists(name):
            os.remove(name)


def test_replay_after_another_writer(spark):
    """Writer a, then writer b, then a's batch once more after a lost commit."""
    root = tempfile.mkdtemp(prefix="ledger-")
    schema = "g string, v int"
    spark.createDataFrame([("x", 1)], schema).write.parquet(f"{root}/a/b0")
    spark.createDataFrame([("x", 2), ("y", 3)], schema).write.parquet(f"{root}/b/b0")

    def run(who):
        stream = spark.readStream.schema(schema).parquet(f"{root}/{who}/b*")
        ST.refresh_groups(stream, ["g"], _agg, MERGE, f"{root}/silver", f"{root}/gold", f"{root}/ck-{who}")
        return sorted(map(tuple, ST.read_groups(spark, f"{root}/gold", ["g"], MERGE).collect()))

    assert run("a") == [("x", 1, 1)]
    want = [("x", 2, 2), ("y", 1, 3)]
    assert run("b") == want
    _lose_commit(f"{root}/ck-a", 0)
    assert run("a") == want
    _lose_commit(f"{root}/ck-b", 0)
    assert run("b") == want
    assert spark.read.parquet(f"{root}/silver").count() == 3
    assert R.load_state(spark, f"{root}/gold").applied == {ST._writer(f"{root}/ck-{w}"): 0 for w in "ab"}


def _files(path):
    return {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names}


def test_a_small_batch_leaves_the_table_as_it_is(spark):
    root = tempfile.mkdtemp(prefix="runs-")
    merge = ST._latest(["k"], [F.desc("ts")], [])
    big = spark.range(200_000).select((F.col("id") % 150_000).alias("k"), F.col("id").alias("ts"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    assert R.append(dedup_latest(big, ["k"], [F.desc("ts")]), root, "w", 0, merge)
    before = _files(f"{root}/runs")
    small = spark.createDataFrame([(5, 10**9, "new"), (7, -1, "late"), (10**7, 1, "added")], "k long, ts long, v string")
    assert R.append(small, root, "w", 1, merge)
    after = _files(f"{root}/runs")
    assert {f: after[f] for f in before} == before  # not a file is rewritten
    assert sum(after.values()) - sum(before.values()) < 10_000 < sum(before.values()) / 100
    now = {r.k: r.v for r in R.read_runs(spark, root, merge).where("k IN (5, 7, 10000000)").collect()}
    assert now[5] == "new" and now[7] not in ("late", None) and now[10**7] == "added"
    assert R.read_runs(spark, root, merge).count() == 150_001
    state = R.load_state(spark, root)
    assert not R.append(small, root, "w", 1, merge) and not R.append(small, root, "w", 0, merge)  # replays
    assert R.load_state(spark, root) == state and _files(f"{root}/runs") == after


def test_runs_grow_geometrically_and_folded_ones_go(spark):
    root = tempfile.mkdtemp(prefix="fold-")
    rng, merge = random.Random(1), ST._latest(["k"], [F.desc("ts")], [])
    latest = {}
    for batch in range(18):
        rows = [(k, batch * 100 + j, f"v{batch}-{k}" * 20) for j, k in enumerate(rng.sample(range(400), 60))]
        latest |= {k: (ts, v) for k, ts, v in rows}
        R.append(spark.createDataFrame(rows, "k int, ts int, v string").coalesce(1), root, f"w{batch % 2}", batch // 2, merge)
        runs = R.load_state(spark, root).runs
        assert all(a["bytes"] >= R.RATIO * b["bytes"] for a, b in zip(runs, runs[1:]))
    assert len(runs) <= 5
    got = {r.k: (r.ts, r.v) for r in R.read_runs(spark, root, merge).collect()}
    assert got == latest
    state = R.load_state(spark, root)
    assert set(os.listdir(f"{root}/runs")) == {r["name"].split("/")[1] for r in state.runs} | {x.split("/")[1] for x in state.dropped}
    assert len([x for x in os.listdir(f"{root}/_state") if x.endswith(".json") and not x.startswith(".")]) == 2


def test_a_failed_attempt_and_a_lost_race_change_nothing(spark):
    root = tempfile.mkdtemp(prefix="race-")
    merge = ST._merged(["g"], MERGE)
    one = spark.createDataFrame([("x", 1, 5)], "g string, n long, top int")
    one.write.parquet(f"{root}/runs/w-0-dead")  # an attempt that never committed
    assert R.append(one, root, "w", 0, merge)
    state = R.load_state(spark, root)
    assert not R._commit(spark, root, state)  # the version is taken
    assert R.load_state(spark, root) == state

    other = spark.createDataFrame([("y", 2, 7)], "g string, n long, top int")
    first, real = [True], R._commit

    def raced(s, path, new):
        if first.pop() if first else False:
            R._commit = real
            assert R.append(other, root, "other", 0, merge)  # another writer is faster
        return real(s, path, new)

    R._commit = raced
    try:
        assert R.append(one, root, "w", 1, merge)
    finally:
        R._commit = real
    assert sorted(map(tuple, R.read_runs(spark, root, merge).collect())) == [("x", 2, 5), ("y", 2, 7)]
    assert R.load_state(spark, root).applied == {"w": 1, "other": 0}
    with pytest.raises(ValueError, match="no batch"):
        R.read_runs(spark, f"{root}/none", merge)


def test_equal_rows_keep_the_first(spark):
    root = tempfile.mkdtemp(prefix="ties-")
    schema = "Id string, ts int, v string"

    def run(k, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{root}/in/b{k}")
        ST.dedup_stream(spark.readStream.schema(schema).parquet(f"{root}/in/b*"), ["Id"], [F.desc("ts")], f"{root}/out", f"{root}/ck")

    run(0, [("a", 1, "first"), ("b", 1, "b"), (None, 1, "null")])
    run(1, [("a", 1, "second"), (None, 2, "later null")])
    got = sorted(map(tuple, ST.read_latest(spark, f"{root}/out", ["Id"], [F.desc("ts")]).collect()), key=repr)
    assert got == [("a", 1, "first"), ("b", 1, "b"), (None, 2, "later null")]
