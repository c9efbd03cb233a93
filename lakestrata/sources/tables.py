"""Table sinks and table management (K1, K4-K9).

Tables are external Parquet tables (the format is a parameter, so Delta can
be passed where installed) in the session catalog. Every overwrite writes a
new version directory and then points the table at it
(``ALTER TABLE ... SET LOCATION``): a table can be rewritten from a plan
that reads it (Parquet alone refuses that), readers never see a half
written table, and a failed write leaves the old version in place.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.operators.expectations import Rule, expect


def _q(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def ensure_schema(spark: SparkSession, name: str, comment: str | None = None, location: str | None = None) -> None:
    """K8: CREATE SCHEMA IF NOT EXISTS with comment (and location)."""
    sql = f"CREATE SCHEMA IF NOT EXISTS {_q(name)}"
    if comment:
        sql += " COMMENT '" + comment.replace("'", "\\'") + "'"
    if location:  # else the schema lies in spark.sql.warehouse.dir
        sql += f" LOCATION '{location}'"
    spark.sql(sql)


def table_root(spark: SparkSession, name: str) -> str:
    """Folder of a table: in its schema's location (by default under spark.sql.warehouse.dir)."""
    db = name.split(".")[0] if "." in name else "default"
    base = spark.sql(f"DESCRIBE SCHEMA {_q(db)}").filter("info_name = 'Location'").first()["info_value"]
    return f"{base.rstrip('/')}/{name.split('.')[-1]}"


def table_location(spark: SparkSession, name: str) -> str | None:
    if not spark.catalog.tableExists(name):
        return None
    row = spark.sql(f"DESCRIBE TABLE EXTENDED {_q(name)}").filter("col_name = 'Location'").first()
    return row["data_type"] if row else None


def write_table(df: DataFrame, name: str, mode: str = "overwrite", fmt: str = "parquet",
                partition_by: Sequence[str] = (), location: str | None = None) -> str:
    """K1: write ``df`` as table ``name``; overwrite replaces data and schema.

    Overwrite = new version directory + location swap; append adds files to
    the current version. Returns the data location.
    """
    spark = df.sparkSession
    exists = spark.catalog.tableExists(name)
    if mode == "append" and exists:
        loc = table_location(spark, name)
        w = df.write.mode("append").format(fmt)
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.save(loc)
        spark.sql(f"REFRESH TABLE {_q(name)}")
        return loc
    root = (location or table_root(spark, name)).rstrip("/")
    loc = f"{root}/v-{uuid.uuid4().hex[:12]}"
    w = df.write.mode("errorifexists").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(loc)
    before = table_location(spark, name)
    if exists and not partition_by and not _partitions(spark, name) and \
            spark.table(name).schema.simpleString() == df.schema.simpleString():
        spark.sql(f"ALTER TABLE {_q(name)} SET LOCATION '{loc}'")
        spark.sql(f"REFRESH TABLE {_q(name)}")
    else:
        # the data is complete by now; only the catalog entry is made anew
        props = {}
        if exists:
            props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {_q(name)}").collect()
                     if not r["key"].startswith(("transient_", "spark."))}
            spark.sql(f"DROP TABLE {_q(name)}")
        parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
        columns = f" ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in df.schema.fields)})" if partition_by else ""
        spark.sql(f"CREATE TABLE {_q(name)}{columns} USING {fmt}{parts} LOCATION '{loc}'")
        if partition_by:
            spark.catalog.recoverPartitions(name)
        if props:
            set_properties(spark, name, props)
    _drop_old_versions(spark, root, {loc, before})
    return loc


def _partitions(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def _drop_old_versions(spark: SparkSession, root: str, keep: set) -> None:
    """Remove version folders but the current one and the one before it (for plans that still read it)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = {k.rstrip("/").split("/")[-1] for k in keep if k}
    for status in fs.listStatus(path):
        if status.getPath().getName().startswith("v-") and status.getPath().getName() not in names:
            fs.delete(status.getPath(), True)


def materialized_table(spark: SparkSession, name: str, fn, *args, rules: Sequence[Rule] = (), **kwargs) -> DataFrame:
    """K4: recompute a table from its full input and overwrite it; ``rules`` are met by every row written.

    A broken fail rule ends the write, and the table keeps its old version.
    """
    df = expect(fn(*args, **kwargs), rules)
    write_table(df, name)
    return spark.table(name)


def guarded_write(df: DataFrame, name: str, enabled: bool = True, fmt: str = "parquet") -> DataFrame:
    """K5: preview or write with a report.

    Report row: table_existed, current_rows, new_rows, row_delta,
    schema_changed, written, rows_after. The new row count is observed on
    the write itself (no second pass); in preview mode it is one count.
    """
    spark = df.sparkSession
    existed = spark.catalog.tableExists(name)
    current_rows = spark.table(name).count() if existed else None
    schema_changed = existed and spark.table(name).schema.simpleString() != df.schema.simpleString()
    if enabled:
        obs = Observation("guarded_write")
        write_table(df.observe(obs, F.count(F.lit(1)).alias("n")), name, fmt=fmt)
        new_rows = obs.get["n"]
        rows_after = spark.table(name).count()
    else:
        new_rows = df.count()
        rows_after = current_rows
    delta = None if current_rows is None else new_rows - current_rows
    return spark.createDataFrame(
        [(bool(existed), current_rows, int(new_rows), delta, bool(schema_changed), bool(enabled), rows_after)],
        "table_existed boolean, current_rows bigint, new_rows bigint, row_delta bigint, schema_changed boolean, "
        "written boolean, rows_after bigint",
    )


#: Bits of a column's range rank in an interleaved key, and rows (about) from which the ranges are taken.
RANK_BITS, RANK_ROWS = 6, 20_000


def interleaved(df: DataFrame, columns: Sequence[str]) -> Column:
    """One sort key whose bits are those of the columns' range ranks in turn.

    A column's rank is the number of its range ends at or below the value, and
    the ends are quantiles of a hash share of the rows (about RANK_ROWS of
    them). Rows close in the key are close in every column, so files that hold
    a range of keys hold a narrow range of each column, not of the first alone.
    NULLs have rank 0.
    """
    n = df.count()
    share = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(max(1, n // RANK_ROWS))) == 0
    rows = df.where(share).select(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(columns)]).limit(4 * RANK_ROWS).toArrow()
    key = F.lit(0).cast("long")
    for i, c in enumerate(columns):
        values = sorted(v for v in rows[f"_{i}"].to_pylist() if v is not None)
        ends = sorted({values[k * len(values) >> RANK_BITS] for k in range(1, 1 << RANK_BITS)}) if values else []
        rank = F.lit(0)
        for end in ends:
            rank = rank + F.coalesce(F.col(f"`{c}`") >= F.lit(end), F.lit(False)).cast("int")
        for bit in range(RANK_BITS):
            key = key.bitwiseOR(F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1)).cast("long"), bit * len(columns) + len(columns) - 1 - i))
    return key


#: Bytes of rows in memory that a task of a clustered rewrite sorts (about): a small file may hold very many.
SORT_BYTES = 512 << 20


def memory_bytes(df: DataFrame) -> int:
    """About the bytes that the rows of ``df`` take in a sort: 8 for each column and 24 for a row, and the texts and nested values."""
    wide = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            wide.append(F.octet_length(c))
        elif isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            wide.append(F.octet_length(F.to_json(F.struct(c))))
    each = F.lit(24 + 8 * len(df.columns)).cast("long")
    for size in wide:
        each = each + F.coalesce(size, F.lit(0))
    return df.agg(F.sum(each)).first()[0] or 0


def compact(spark: SparkSession, name: str, target_bytes: int = 256 << 20, cluster_by: Sequence[str] = ()) -> DataFrame:
    """K6: rewrite a table into files of about ``target_bytes``, optionally clustered.

    The number of files follows from the table's bytes. Clustering by one column
    range-partitions on it (so each file holds a range, which narrows min/max
    statistics) and sorts within files; by several, on their interleaved range
    ranks, so that a filter on any of them skips files. A row hash is the last
    range key, so one value holding a large share of the rows is spread over
    several files instead of one writer task. A clustered table whose rows take
    far more memory than bytes on disk gets more files, so that the sort of one
    has about SORT_BYTES of rows.
    Returns (files_before, files_after).
    """
    before, size = _files(spark, table_location(spark, name))
    n = max(1, -(-size // target_bytes))
    df = spark.table(name)
    if cluster_by:
        n = max(n, -(-memory_bytes(df) // SORT_BYTES))
        spread = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
        key = F.col(f"`{cluster_by[0]}`")
        if len(cluster_by) > 1:
            key = F.col("_cluster")
            df = df.withColumn("_cluster", interleaved(df, cluster_by))
        out = df.repartitionByRange(n, key, spread).sortWithinPartitions(key).drop("_cluster")
    else:
        out = df.repartition(n)
    write_table(out, name, partition_by=_partitions(spark, name))
    after, _ = _files(spark, table_location(spark, name))
    return spark.createDataFrame([(before, after)], "files_before long, files_after long")


def _files(spark: SparkSession, location: str) -> tuple[int, int]:
    """Data files and bytes below a folder, counted by the file system (no list of names)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    walk, n, size = fs.listFiles(path, True), 0, 0
    while walk.hasNext():
        f = walk.next()
        if not f.getPath().getName().startswith(("_", ".")):
            n, size = n + 1, size + f.getLen()
    return n, size


def set_properties(spark: SparkSession, name: str, props: Mapping[str, str], comment: str | None = None) -> DataFrame:
    """K7: set table properties (and comment); returns the properties set."""
    kv = ", ".join("'{}' = '{}'".format(k, str(v).replace("'", "\\'")) for k, v in props.items())
    spark.sql(f"ALTER TABLE {_q(name)} SET TBLPROPERTIES ({kv})")
    if comment is not None:
        spark.sql(f"ALTER TABLE {_q(name)} SET TBLPROPERTIES ('comment' = '" + comment.replace("'", "\\'") + "')")
    keys = list(props) + (["comment"] if comment is not None else [])
    return spark.sql(f"SHOW TBLPROPERTIES {_q(name)}").filter(F.col("key").isin(keys))


def layer_tables(spark: SparkSession, schema: str) -> DataFrame:
    """K9: tables of a layer schema."""
    return spark.sql(f"SHOW TABLES IN {_q(schema)}")


def describe(spark: SparkSession, name: str) -> DataFrame:
    """K9: column names and types of a table."""
    return spark.sql(f"DESCRIBE TABLE {_q(name)}").filter(~F.col("col_name").startswith("#")).select("col_name", "data_type")
