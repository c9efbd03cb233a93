"""File sources (S1-S6): CSV batch and incremental reads, lineage columns,
schema persistence and rescue of unexpected data.

Streams need a schema up front (open-source file streams do not infer):
it is inferred once from a batch read (optionally sampled) or taken from
the header as all-string, and persisted as JSON at ``schema_location`` so
restarts reuse it.
"""

from __future__ import annotations

import csv
import io
import json
import re
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.functions.scalars import now

# Timestamps are written and read with microseconds so CSV round trips are exact.
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
#: Raw text of rows that have more values than their header.
CORRUPT_COL = "_corrupt_record"
#: Fields whose header name another column has already (but for its case), by name.
EXTRA_COL = "_extra_fields"
CSV_OPTIONS = {"header": "true", "timestampNTZFormat": TS_FORMAT, "timestampFormat": TS_FORMAT}


def _reader(spark: SparkSession, glob: str | None, options: dict | None, stream: bool = False):
    r = spark.readStream if stream else spark.read
    r = r.format("csv").options(**CSV_OPTIONS)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if options:
        r = r.options(**options)
    return r


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None,
             glob: str | None = None, sampling_ratio: float = 1.0, options: dict | None = None) -> DataFrame:
    """CSV with header; types inferred (sampled) unless ``schema`` is given."""
    r = _reader(spark, glob, options)
    if schema is not None:
        r = r.schema(schema)
    else:
        r = r.option("inferSchema", "true").option("samplingRatio", str(sampling_ratio))
    return r.load(path)


def header_schema(spark: SparkSession, path: str, glob: str | None = None) -> T.StructType:
    """All-string schema from the header (reads only enough to see the header)."""
    fields = _reader(spark, glob, {"inferSchema": "false"}).load(path).schema.fields
    return T.StructType([T.StructField(f.name, T.StringType(), True) for f in fields])


def _as_in_header(spark: SparkSession, path: str, glob: str | None, schema: T.StructType) -> T.StructType:
    """The schema with the header's own names: Spark appends the place to names that clash; the first of them stays."""
    base = [f.name.removesuffix(str(i)).lower() for i, f in enumerate(schema.fields)]
    clash = [base.count(b) > 1 and b != f.name.lower() for b, f in zip(base, schema.fields)]
    if not any(clash):
        return schema
    headers = [header_names(h) for h in file_headers(spark, list_files(spark, path, glob))]
    out: dict[str, T.StructField] = {}
    for i, f in enumerate(schema.fields):
        own = any(len(h) > i and h[i] == f.name for h in headers)
        name = f.name if own or not clash[i] else f.name.removesuffix(str(i))
        out.setdefault(name.lower(), T.StructField(name, f.dataType, True))
    return T.StructType(list(out.values()))


def save_schema(spark: SparkSession, schema: T.StructType, location: str) -> None:
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(location)


def load_schema(spark: SparkSession, location: str) -> T.StructType | None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return None  # nothing saved yet; any other error is one
    row = spark.read.text(location).first()
    return T.StructType.fromJson(json.loads(row[0])) if row else None


def resolve_schema(spark: SparkSession, path: str, glob: str | None = None, schema_location: str | None = None,
                   infer_types: bool = True, sampling_ratio: float = 1.0) -> T.StructType:
    """Saved schema if present, else inferred (or header strings) and saved."""
    if schema_location:
        saved = load_schema(spark, schema_location)
        if saved is not None:
            return saved
    if infer_types:
        schema = read_csv(spark, path, glob=glob, sampling_ratio=sampling_ratio).schema
    else:
        schema = header_schema(spark, path, glob)
    schema = _as_in_header(spark, path, glob, schema)
    if schema_location:
        save_schema(spark, schema, schema_location)
    return schema


def stream_csv(spark: SparkSession, path: str, glob: str | None = None, schema: T.StructType | None = None,
               schema_location: str | None = None, infer_types: bool = True, max_files_per_trigger: int | None = None,
               options: dict | None = None) -> DataFrame:
    """Incremental CSV file stream with one layout; only files not seen before are read.

    Columns go by position, so a file whose header is not the schema's stops
    the stream. For files whose layout may change use
    ``streaming.ingest.ingest_available``.
    """
    if schema is None:
        schema = resolve_schema(spark, path, glob, schema_location, infer_types)
    r = _reader(spark, glob, {"enforceSchema": "false", **(options or {})}, stream=True).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def is_path(name_or_path: str) -> bool:
    """Whether a table is named by its folder; catalog names hold no slash."""
    return "/" in name_or_path


def stream_table(spark: SparkSession, name_or_path: str, schema: T.StructType | None = None, fmt: str = "parquet") -> DataFrame:
    """Read a catalog table or a table folder incrementally as a stream.

    A table by name is followed at its present location: rows appended to it
    arrive in later batches, an overwrite (another version folder) does not.
    """
    if not is_path(name_or_path):
        return spark.readStream.table(name_or_path)
    if schema is None:
        schema = spark.read.format(fmt).load(name_or_path).schema
    return spark.readStream.format(fmt).schema(schema).load(name_or_path)


def scan_table(spark: SparkSession, name_or_path: str, fmt: str = "parquet") -> DataFrame:
    """Batch read of a catalog table or a table directory."""
    if is_path(name_or_path):
        return spark.read.format(fmt).load(name_or_path)
    return spark.table(name_or_path)


def with_lineage(df: DataFrame, file_col: str | None = "source_file", time_col: str | None = "ingestion_timestamp",
                 as_of: str | None = None) -> DataFrame:
    """Source file path (hidden ``_metadata``) and ingestion time."""
    cols: dict[str, Column] = {}
    if file_col:
        cols[file_col] = F.col("_metadata.file_path")
    if time_col:
        cols[time_col] = now(as_of)
    return df.withColumns(cols)


def rescue(df: DataFrame, schema: T.StructType, rescued_col: str = "_rescued_data",
           keep: Sequence[str] = ("source_file", "ingestion_timestamp")) -> DataFrame:
    """Cast string columns to ``schema``; keep what does not fit.

    Declared columns get their declared type (``try_cast``). Values that do
    not cast, columns not in the schema and the fields of EXTRA_COL (whose names
    differ from a column's by case only, or are repeated) go to ``rescued_col``
    as a JSON object (keys in alphabetical order); it is NULL when nothing was
    rescued. The row is always kept.
    """
    declared = {f.name: f.dataType for f in schema.fields}
    present = set(df.columns)
    out = []
    entries: list[tuple[str, Column]] = []
    for name, dtype in declared.items():
        if name in present:
            raw = F.col(f"`{name}`")
            if isinstance(dtype, T.StringType):
                out.append(raw.alias(name))
            else:
                typed = raw.try_cast(dtype)
                out.append(typed.alias(name))
                entries.append((name, F.when(raw.isNotNull() & typed.isNull(), raw.cast("string"))))
        else:
            out.append(F.lit(None).cast(dtype).alias(name))
    for name in df.columns:
        if name not in declared and name not in keep and name not in (rescued_col, EXTRA_COL):
            entries.append((name, F.col(f"`{name}`").cast("string")))
    entries.sort(key=lambda e: e[0])
    m = F.create_map(*[x for k, v in entries for x in (F.lit(k), v)]).cast("map<string,string>")
    if EXTRA_COL in present:
        fields = F.concat(F.map_entries(m), F.coalesce(F.map_entries(EXTRA_COL), F.array()))
        m = F.map_from_entries(F.array_sort(F.filter(fields, lambda e: e["value"].isNotNull())))
    m = F.map_filter(m, lambda k, v: v.isNotNull())
    rescued = F.when(F.size(m) > 0, F.to_json(m)) if entries or EXTRA_COL in present else F.lit(None).cast("string")
    kept = [F.col(k) for k in keep if k in present]
    return df.select(*out, rescued.alias(rescued_col), *kept)


def file_headers(spark: SparkSession, paths: Iterable[str]) -> dict[str, list[str]]:
    """Header record -> files that have it.

    Opens each file through Spark's own file system layer (any store that
    Spark reads, compressed or not) and reads its first CSV record, which may
    hold quoted line ends. Headers and file names are metadata: they are as
    many as the files that Spark itself lists on the driver.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def header(path: str) -> str:
        p = jvm.org.apache.hadoop.fs.Path(path)
        stream = p.getFileSystem(conf).open(p)
        try:
            codec = codecs.getCodec(p)
            body = codec.createInputStream(stream) if codec is not None else stream
            lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(body, "UTF-8"))
            record = lines.readLine() or ""
            while record.count('"') % 2:
                more = lines.readLine()
                if more is None:
                    break
                record += "\n" + more
            return record.lstrip("\ufeff")
        finally:
            stream.close()

    out: dict[str, list[str]] = {}
    paths = list(paths)
    with ThreadPoolExecutor(16) as pool:
        for path, record in zip(paths, pool.map(header, paths)):
            out.setdefault(record, []).append(path)
    return out


def _plain_path(path: str) -> str:
    """A path as a literal for ``load``: glob characters are escaped."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def list_files(spark: SparkSession, path: str | Sequence[str], glob: str | None = None) -> list[str]:
    b = spark.read.format("binaryFile")
    if glob:
        b = b.option("pathGlobFilter", glob)
    return sorted(unquote(r["path"]) for r in b.load(path).select(F.col("_metadata.file_path").alias("path")).toLocalIterator())


def header_names(header: str) -> list[str]:
    """Field names of a header record; nameless fields are named by place."""
    return [name or f"_c{i}" for i, name in enumerate(next(csv.reader(io.StringIO(header)), []))]


def column_names(headers: Iterable[Sequence[str]], declared: Sequence[str] = (), reserved: Sequence[str] = ()) -> dict[str, str | None]:
    """Lower-case name -> the name that becomes the column.

    Column names go without case, so of the spellings in some headers one is
    the column: the declared one, else the first in order. Reserved names are
    no file's column.
    """
    out: dict[str, str | None] = {r.lower(): None for r in reserved}
    for name in [*declared, *sorted({n for names in headers for n in names})]:
        out.setdefault(name.lower(), name)
    return out


def read_csv_by_header(spark: SparkSession, path: str | Sequence[str], glob: str | None = None,
                       file_col: str | None = "source_file", declared: Sequence[str] = ()) -> DataFrame:
    """All-string read of CSV files whose headers differ (added, removed or
    reordered columns): see ``read_csv_files``."""
    return read_csv_files(spark, list_files(spark, path, glob), file_col, declared)


def read_csv_files(spark: SparkSession, paths: Sequence[str], file_col: str | None = "source_file",
                   declared: Sequence[str] = ()) -> DataFrame:
    """Files of one header are read by place, named by that header, and the
    groups are combined by column name. Of header names that are alike but for
    their case the ``declared`` one is the column; the others, and repeats of a
    name (marked by their place), are kept in the map EXTRA_COL. A row with more
    values than its header has its whole text in CORRUPT_COL, so nothing is
    lost. The source file path is added as ``file_col``. No files give an empty
    frame."""
    groups = sorted(file_headers(spark, paths).items())
    reserved = [c for c in (CORRUPT_COL, EXTRA_COL, file_col) if c]
    columns = column_names([header_names(h) for h, _ in groups], declared, reserved)
    frames = []
    for header, files in groups:
        names = header_names(header)
        schema = T.StructType([T.StructField(c, T.StringType(), True) for c in (*[f"_{i}" for i in range(len(names))], CORRUPT_COL)])
        options = {"columnNameOfCorruptRecord": CORRUPT_COL, "multiLine": str("\n" in header).lower()}
        f = _reader(spark, None, options).schema(schema).load([_plain_path(x) for x in files])
        wide = ", ".join(f"c{i} string" for i in range(len(names) + 1))  # short rows are marked too; only long ones matter
        long_row = F.when(F.from_csv(CORRUPT_COL, wide)[f"c{len(names)}"].isNotNull(), F.col(CORRUPT_COL)).alias(CORRUPT_COL)
        kept: dict[str, Column] = {}
        extra: dict[str, Column] = {}
        for i, name in enumerate(names):
            if columns[name.lower()] == name and name not in kept:
                kept[name] = F.col(f"_{i}")
            else:
                extra[name if name not in kept and name not in extra else f"{name}#{i + 1}"] = F.col(f"_{i}")
        out = [c.alias(name) for name, c in kept.items()] + [long_row]
        if extra:
            out.append(F.create_map(*[x for name, c in extra.items() for x in (F.lit(name), c)]).alias(EXTRA_COL))
        frames.append(f.select(*out, *([F.col("_metadata.file_path").alias(file_col)] if file_col else [])))
    if not frames:
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in (CORRUPT_COL, file_col) if c]))
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), frames)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", partitions: int | None = None) -> None:
    """Write CSV with header (used to stage inputs of ingest jobs)."""
    if partitions:
        df = df.repartition(partitions)
    (df.write.mode(mode).options(**CSV_OPTIONS).option("ignoreLeadingWhiteSpace", "false")
     .option("ignoreTrailingWhiteSpace", "false").csv(path))
