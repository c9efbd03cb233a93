"""Interleaved clustering, tables by name, rule counters without a pass of their own."""
import glob
import tempfile
import uuid

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from lakestrata.operators import expectations as E
from lakestrata.sources import files as SF
from lakestrata.sources import tables as TB
from lakestrata.streaming import ingest as ST


def _ranges(spark, name, column):
    """(least, greatest) of a column in each file, from the footers."""
    out = []
    for f in glob.glob(f"{TB.table_location(spark, name).removeprefix('file:')}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        at = meta.schema.names.index(column)
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        out.append((min(s.min for s in stats), max(s.max for s in stats)))
    return out


def test_a_filter_on_any_cluster_column_skips_files(spark):
    name = f"clustered_{uuid.uuid4().hex[:8]}"
    df = spark.range(40_000).select(F.xxhash64("id").alias("v"), F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(1000)).alias("a"),
                                    F.concat(F.lit("s"), F.lpad(F.pmod(F.xxhash64(F.lit(2), "id"), F.lit(1000)).cast("string"), 4, "0")).alias("b"))
    df = df.withColumn("a", F.when(F.col("a") > 20, F.col("a")))  # with NULLs
    TB.write_table(df, name)
    want = df.agg(F.count("*"), F.sum(F.col("v") % 1000), F.count("a"), F.countDistinct("b")).first()
    size = TB._files(spark, TB.table_location(spark, name))[1]
    TB.compact(spark, name, target_bytes=size // 16 + 1, cluster_by=["a", "b"])
    assert spark.table(name).agg(F.count("*"), F.sum(F.col("v") % 1000), F.count("a"), F.countDistinct("b")).first() == want
    assert spark.table(name).columns == ["v", "a", "b"]
    for column, probe in (("a", 500), ("b", "s0500")):
        ranges = _ranges(spark, name, column)
        assert len(ranges) >= 12 and sum(lo <= probe <= hi for lo, hi in ranges) <= len(ranges) // 2, column
    TB.compact(spark, name, cluster_by=["a", "b"])
    spark.sql(f"DROP TABLE {name}")


def test_clustered_rewrite_sorts_bounded_parts(spark, monkeypatch):
    """Rows that compress well: the bytes on disk make one file, the bytes in memory several."""
    monkeypatch.setattr(TB, "SORT_BYTES", 1 << 20, raising=False)
    name = f"clustered_{uuid.uuid4().hex[:8]}"
    df = spark.range(20_000).select("id", F.repeat(F.lit("x"), 200).alias("wide"), F.array(F.lit("y")).alias("list"))
    TB.write_table(df.withColumn("k", F.when(F.col("id") % 7 > 0, F.col("id") % 100)), name)
    assert TB.compact(spark, name, cluster_by=["k"]).first()["files_after"] >= 4
    assert spark.table(name).agg(F.count("*"), F.sum("id"), F.count("k"), F.max("wide")).first()[:] == (
        20_000, sum(range(20_000)), 20_000 - len(range(0, 20_000, 7)), "x" * 200)
    spark.table(name).where("id < 0").write.mode("overwrite").saveAsTable(f"{name}_empty")
    TB.compact(spark, f"{name}_empty", cluster_by=["k"])
    assert spark.table(f"{name}_empty").count() == 0
    for t in (name, f"{name}_empty"):
        spark.sql(f"DROP TABLE {t}")


def test_streams_by_table_name(spark):
    root = tempfile.mkdtemp(prefix="names-")
    a, b = (f"t_{uuid.uuid4().hex[:8]}" for _ in range(2))
    TB.write_table(spark.range(5), a)
    ST.run_available(SF.stream_table(spark, a), b, f"{root}/ck")
    assert SF.scan_table(spark, b).count() == 5
    TB.write_table(spark.range(5, 8), a, mode="append")
    ST.run_available(SF.stream_table(spark, a), b, f"{root}/ck")
    ST.run_available(SF.stream_table(spark, a), b, f"{root}/ck")  # nothing new
    assert sorted(r.id for r in spark.table(b).collect()) == list(range(8))
    for t in (a, b):
        spark.sql(f"DROP TABLE {t}")


def test_rule_counters_come_with_the_write(spark):
    root = tempfile.mkdtemp(prefix="observe-")
    rules = [E.Rule("has_k", "k IS NOT NULL", "fail"), E.Rule("small", "v < 10", "drop"), E.Rule("even", "v % 2 = 0", "warn")]
    df = spark.createDataFrame([("a", 1), ("b", 12), ("c", 4), ("d", None)], "k string, v int")
    reads = spark.sparkContext.accumulator(0)

    def seen(x):
        reads.add(1)
        return x

    counted = df.select(F.udf(seen, "string").asNondeterministic()("k").alias("k"), "v")
    ST.write_expected(counted, rules, f"{root}/out", "key-0", f"{root}/metrics", "t")
    assert reads.value == 4  # each row is computed once
    got = spark.read.parquet(f"{root}/metrics").drop("_batch_id")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, E.expectation_metrics(df, rules, "t").collect()))
    assert sorted(r.k for r in ST.read_batches(spark, f"{root}/out").collect()) == ["a", "c"]
    ST.write_expected(df.where("false"), rules, f"{root}/none", "key-1", f"{root}/m0", "t")
    assert {r.total_records for r in spark.read.parquet(f"{root}/m0").collect()} == {0}
