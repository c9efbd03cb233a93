import os
import tempfile

import pytest
from pyspark.sql import functions as F

from lakestrata.operators import expectations as E
from lakestrata.plans import bronze as B
from lakestrata.sources import files as SF
from lakestrata.sources import tables as TB
from lakestrata.streaming import ingest as ST


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def test_rescue_header_and_type_drift(spark):
    root = tempfile.mkdtemp(prefix="rescue-")
    _write(f"{root}/a/patients1.csv", "Id,INCOME,LAT\n1,100,1.5\n2,xx,2.5\n")
    _write(f"{root}/b/patients2.csv", "Id,EXTRA,INCOME,LAT\n3,e,300,3.5\n")    # extra column in the middle
    _write(f"{root}/c/patients3.csv", "LAT,Id,INCOME,NEWCOL\n4.5,4,400,z\n")   # reordered + extra at the end
    raw = SF.read_csv_by_header(spark, f"{root}/*/", "*.csv")
    schema = "Id string, INCOME int, LAT double"
    from pyspark.sql.types import _parse_datatype_string
    out = {r["Id"]: r for r in SF.rescue(raw, _parse_datatype_string(schema)).collect()}
    assert out["1"]["INCOME"] == 100 and out["1"]["_rescued_data"] is None
    assert out["2"]["INCOME"] is None and out["2"]["_rescued_data"] == '{"INCOME":"xx"}'
    assert out["3"]["_rescued_data"] == '{"EXTRA":"e"}' and out["3"]["LAT"] == 3.5
    assert out["4"]["LAT"] == 4.5 and out["4"]["INCOME"] == 400 and out["4"]["_rescued_data"] == '{"NEWCOL":"z"}'
    assert out["4"]["source_file"].endswith("patients3.csv")


def test_stream_rerun_adds_nothing_and_new_file_adds_its_rows(spark):
    root = tempfile.mkdtemp(prefix="st3-")
    _write(f"{root}/in/p1.csv", "Id,V\n1,a\n2,b\n")
    schema = "Id string, V string"

    def run():
        ST.ingest_available(spark, f"{root}/in", "*.csv", f"{root}/out", f"{root}/ck",
                            schema=SF.read_csv(spark, f"{root}/in", schema=schema).schema, as_of="2024-06-30 00:00:00")
        return ST.read_batches(spark, f"{root}/out").count()

    assert run() == 2
    assert run() == 2
    _write(f"{root}/in/p2.csv", "Id,V\n3,c\n")
    assert run() == 3


def test_streaming_table_fail_rule_commits_nothing(spark):
    root = tempfile.mkdtemp(prefix="k3-")
    _write(f"{root}/in/o1.csv", "Id,NAME\n1,a\n,b\n")
    s = SF.stream_csv(spark, f"{root}/in", "*.csv", schema=SF.read_csv(spark, f"{root}/in", schema="Id string, NAME string").schema)
    with pytest.raises(Exception, match="valid_org_id"):
        ST.streaming_table(s, E.rules_from(fail={"valid_org_id": "Id IS NOT NULL"}), f"{root}/out", f"{root}/ck")
    assert not os.path.exists(f"{root}/out")


def test_dedup_stream_equals_batch(spark):
    root = tempfile.mkdtemp(prefix="st4-")
    schema = "Id string, ts int, v string"
    batches = [[("a", 1, "x"), ("b", 1, "y")], [("a", 3, "z"), ("c", 2, "w")], [("a", 2, "old"), ("b", 5, "new")]]
    allrows = []
    for i, rows in enumerate(batches):
        allrows += rows
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{root}/in/b{i}")
        stream = spark.readStream.schema(schema).parquet(f"{root}/in/b*")
        ST.dedup_stream(stream, ["Id"], [F.desc("ts")], f"{root}/out", f"{root}/ck")
    got = sorted(tuple(r) for r in ST.read_latest(spark, f"{root}/out", ["Id"], [F.desc("ts")]).select("Id", "ts", "v").collect())
    assert got == [("a", 3, "z"), ("b", 5, "new"), ("c", 2, "w")]


def test_versioned_overwrite_of_self_and_properties(spark):
    db = "t_" + os.urandom(4).hex()
    TB.ensure_schema(spark, db, "test", tempfile.mkdtemp(prefix="wh-"))
    name = f"{db}.t"
    TB.write_table(spark.range(10).withColumn("x", F.col("id") * 2), name)
    TB.set_properties(spark, name, {"quality": "silver"})
    TB.write_table(spark.table(name).filter("id < 5"), name)  # reads itself
    assert spark.table(name).count() == 5
    props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    assert props.get("quality") == "silver"
    rep = TB.compact(spark, name).first()
    assert rep["files_after"] == 1
    g = TB.guarded_write(spark.table(name).withColumn("y", F.lit(1)), name, enabled=False).first()
    assert g["schema_changed"] and not g["written"] and g["new_rows"] == 5


def test_bronze_stream_maps_columns_by_name(spark):
    root = tempfile.mkdtemp(prefix="b2-")
    _write(f"{root}/in/organizations1.csv", "Id,NAME,REVENUE,UTILIZATION\n1,A,10.5,120\n2,  ,1,1\n")
    _write(f"{root}/in/organizations2.csv", "UTILIZATION,NAME,Id,REVENUE,EXTRA\n5,C,3,-1,q\n")
    B.bronze(spark, B.ORGANIZATIONS, f"{root}/in", f"{root}/out", f"{root}/ck", "2024-06-30 00:00:00",
             f"{root}/metrics")
    out = {r["Id"]: r for r in ST.read_batches(spark, f"{root}/out").collect()}
    assert set(out) == {"1", "3"}  # blank name dropped
    assert out["3"]["UTILIZATION"] == 5 and out["3"]["REVENUE"] == -1.0 and out["3"]["_rescued_data"] == '{"EXTRA":"q"}'
    m = spark.read.parquet(f"{root}/metrics").groupBy("rule").agg(F.sum("failed_records").alias("f"))
    fails = {r["rule"]: r["f"] for r in m.collect()}
    assert fails["valid_org_name"] == 1 and fails["non_negative_revenue"] == 1


def test_partitioned_table_reads_back_and_changes_schema(spark):
    db = "t_" + os.urandom(4).hex()
    root = tempfile.mkdtemp(prefix="wh-")
    TB.ensure_schema(spark, db, "test", root)
    name = f"{db}.p"
    df = spark.range(10).withColumn("part", F.col("id") % 3)
    TB.write_table(df, name, partition_by=["part"])
    assert sorted(map(tuple, spark.table(name).select("id", "part").collect())) == [(k, k % 3) for k in range(10)]
    assert spark.table(name).filter("part = 1").count() == 3
    TB.write_table(spark.table(name).filter("id < 6").withColumn("x", F.lit("a")), name, partition_by=["part"])
    assert spark.table(name).count() == 6 and "x" in spark.table(name).columns
    TB.compact(spark, name, cluster_by=["id"])
    assert spark.table(name).filter("part = 2").count() == 2
    for k in range(4):
        TB.write_table(spark.range(k + 1), f"{db}.q")
    assert len([x for x in os.listdir(f"{root}/q") if x.startswith("v-")]) == 2  # the current and the one before
    assert spark.table(f"{db}.q").count() == 4


def test_two_checkpoints_keep_each_others_rows(spark):
    root = tempfile.mkdtemp(prefix="two-")
    for k in (1, 2):
        spark.createDataFrame([(k, "a"), (k, "b")], "id int, v string").write.parquet(f"{root}/in{k}")
        stream = spark.readStream.schema("id int, v string").parquet(f"{root}/in{k}")
        ST.streaming_table(stream, [], f"{root}/out", f"{root}/ck{k}")
    assert ST.read_batches(spark, f"{root}/out").count() == 4


def test_silver_fail_rules_stop_writes(spark):
    db = "t_" + os.urandom(4).hex()
    TB.ensure_schema(spark, db, "test", tempfile.mkdtemp(prefix="wh-"))
    good = spark.createDataFrame([("1", "A"), ("2", "B")], "organization_id string, organization_name string")
    rules = [r for r in E.catalogue("silver_organizations") if r.tier == "fail"]
    TB.materialized_table(spark, f"{db}.o", lambda: good, rules=rules)
    bad = good.unionByName(spark.createDataFrame([(None, "C")], good.schema))
    with pytest.raises(Exception, match="valid_org_id"):
        TB.materialized_table(spark, f"{db}.o", lambda: bad, rules=rules)
    assert spark.table(f"{db}.o").count() == 2
    root = tempfile.mkdtemp(prefix="st2-")
    bad.write.parquet(f"{root}/in")
    with pytest.raises(Exception, match="valid_org_id"):
        ST.transform_stream(spark, f"{root}/in", lambda x: x, f"{root}/out", f"{root}/ck", rules=rules)
    assert not os.path.exists(f"{root}/out") or spark.read.schema(bad.schema).parquet(f"{root}/out").count() == 0


def test_bronze_fail_rule_stops_or_sets_aside(spark):
    root = tempfile.mkdtemp(prefix="b3-")
    _write(f"{root}/in/observations1.csv", "DATE,PATIENT,CODE,VALUE\n2024-01-01T00:00:00.000000,p,c,1\n2024-01-01T00:00:00.000000,,c,2\n")
    with pytest.raises(Exception, match="valid_patient_ref"):
        B.bronze(spark, B.OBSERVATIONS, f"{root}/in", f"{root}/out", f"{root}/ck1", "2024-06-30 00:00:00")
    assert not os.path.exists(f"{root}/out")
    B.bronze(spark, B.OBSERVATIONS, f"{root}/in", f"{root}/out", f"{root}/ck2", "2024-06-30 00:00:00", f"{root}/m", quarantine=True)
    assert ST.read_batches(spark, f"{root}/out").count() == 1
    assert spark.read.parquet(f"{root}/m").filter("rule = 'valid_patient_ref'").first()["failed_records"] == 1


def test_a_cluster_needs_the_shared_folder():
    from types import SimpleNamespace

    from lakestrata.session import checkpoint_root

    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: None),
                           sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(fake)


def test_csv_files_of_any_layout_and_name(spark):
    root = tempfile.mkdtemp(prefix="layout-")
    _write(f"{root}/in/a 1.csv", "Id,FIRST\n1,x\n")
    _write(f"{root}/in/b%20[2].csv", "FIRST,EXTRA,Id\ny,e,2\n")
    _write(f"{root}/in/c{{3}}.csv", "Id,FIRST\n3,z,surplus\n4\n")
    _write(f"{root}/in/d.csv", 'Id,"GEN\nDER"\n5,w\n')
    raw = SF.read_csv_by_header(spark, f"{root}/in", "*.csv")
    from pyspark.sql.types import _parse_datatype_string
    out = {r["Id"]: r for r in SF.rescue(raw, _parse_datatype_string("Id string, FIRST string")).collect()}
    assert {k: r["FIRST"] for k, r in out.items()} == {"1": "x", "2": "y", "3": "z", "4": None, "5": None}
    assert out["2"]["_rescued_data"] == '{"EXTRA":"e"}'
    assert out["3"]["_rescued_data"] == '{"_corrupt_record":"3,z,surplus"}'
    assert out["5"]["_rescued_data"] == '{"GEN\\nDER":"w"}'
    assert out["1"]["_rescued_data"] is None and out["4"]["_rescued_data"] is None
    os.makedirs(f"{root}/empty")
    assert SF.read_csv_by_header(spark, f"{root}/empty").count() == 0


def test_headers_that_clash_are_rescued(spark):
    """Names that differ by case, repeated and missing names: one row each, nothing lost."""
    from pyspark.sql.types import _parse_datatype_string

    root = tempfile.mkdtemp(prefix="clash-")
    _write(f"{root}/in/a.csv", "id,ID,x\n1,one,y\n")
    _write(f"{root}/in/b.csv", "x,ID\nz,two\n")
    _write(f"{root}/in/c.csv", "id,x,x,,Source_File\n3,first,second,none,mine\n")
    raw = SF.read_csv_by_header(spark, f"{root}/in", "*.csv", declared=["id", "x"])
    out = {r["x"]: r for r in SF.rescue(raw, _parse_datatype_string("id int, x string")).collect()}
    assert {k: r["id"] for k, r in out.items()} == {"y": 1, "z": None, "first": 3}
    assert out["y"]["_rescued_data"] == '{"ID":"one"}' and out["z"]["_rescued_data"] == '{"ID":"two"}'
    assert out["first"]["_rescued_data"] == '{"Source_File":"mine","_c3":"none","x#3":"second"}'
    other = SF.rescue(SF.read_csv_by_header(spark, f"{root}/in", "*.csv", declared=["ID"]), _parse_datatype_string("ID string"))
    assert sorted((r["ID"] or "", r["_rescued_data"]) for r in other.collect()) == [
        ("", '{"Source_File":"mine","_c3":"none","id":"3","x":"first","x#3":"second"}'), ("one", '{"id":"1","x":"y"}'), ("two", '{"x":"z"}')]
    bad = SF.rescue(raw, _parse_datatype_string("id int, x int"))  # values that don't cast beside extra fields
    assert {r["_rescued_data"] for r in bad.collect()} == {
        '{"ID":"one","x":"y"}', '{"ID":"two","x":"z"}', '{"Source_File":"mine","_c3":"none","x":"first","x#3":"second"}'}


def test_ingest_of_a_clashing_header(spark):
    root = tempfile.mkdtemp(prefix="clash-")
    _write(f"{root}/in/a.csv", "id,ID,x,v1\n1,one,y,7\n")
    for k, infer in enumerate((False, True)):
        ST.ingest_available(spark, f"{root}/in", "*.csv", f"{root}/out{k}", f"{root}/ck{k}", schema_location=f"{root}/schema{k}", infer_types=infer)
        row = ST.read_batches(spark, f"{root}/out{k}").collect()
        assert [(str(r["id"]), r["x"], str(r["v1"]), r["_rescued_data"]) for r in row] == [("1", "y", "7", '{"ID":"one"}')]


def test_ingest_maps_later_files_by_name(spark):
    root = tempfile.mkdtemp(prefix="st1-")
    _write(f"{root}/in/p1.csv", "Id,FIRST,LAST\n1,f1,l1\n")

    def run():
        ST.ingest_available(spark, f"{root}/in", "*.csv", f"{root}/out", f"{root}/ck", schema_location=f"{root}/schema")
        return {r["Id"]: r for r in ST.read_batches(spark, f"{root}/out").collect()}

    run()
    _write(f"{root}/in/p 2.csv", "LAST,EXTRA,Id,FIRST\nl2,e2,2,f2\n")
    out = run()
    assert (out["2"]["FIRST"], out["2"]["LAST"], out["2"]["_rescued_data"]) == ("f2", "l2", '{"EXTRA":"e2"}')
    assert set(out) == {"1", "2"} and out["2"]["source_file"].endswith("p%202.csv")


def test_a_stream_by_position_stops_at_another_header(spark):
    root = tempfile.mkdtemp(prefix="pos-")
    _write(f"{root}/in/p1.csv", "B,A\n1,2\n")
    schema = SF.read_csv(spark, f"{root}/in", schema="A string, B string").schema
    with pytest.raises(Exception):
        ST.run_available(SF.stream_csv(spark, f"{root}/in", "*.csv", schema=schema), f"{root}/out", f"{root}/ck")


def test_refresh_merges_partials_and_ignores_a_replay(spark):
    root = tempfile.mkdtemp(prefix="st5-")
    schema = "g string, v int"
    agg = lambda df: df.groupBy("g").agg(F.count("*").alias("n"), F.max("v").alias("top"))

    def run():
        stream = spark.readStream.schema(schema).parquet(f"{root}/in/b*")
        ST.refresh_groups(stream, ["g"], agg, {"n": "sum", "top": "max"}, f"{root}/silver", f"{root}/gold", f"{root}/ck")
        return sorted(map(tuple, ST.read_groups(spark, f"{root}/gold", ["g"], {"n": "sum", "top": "max"}).collect()), key=repr)

    spark.createDataFrame([("a", 1), ("a", 5), (None, 2)], schema).write.parquet(f"{root}/in/b0")
    assert run() == [("a", 2, 5), (None, 1, 2)]
    spark.createDataFrame([("a", 3), ("b", 9)], schema).coalesce(1).write.parquet(f"{root}/in/b1")
    want = [("a", 3, 5), ("b", 1, 9), (None, 1, 2)]
    assert run() == want
    os.remove(f"{root}/ck/commits/1")  # the batch is handed out again
    crc = f"{root}/ck/commits/.1.crc"
    if os.path.exists(crc):
        os.remove(crc)
    assert run() == want
