"""Helpers shared by the operators of this package.

Everything here works on one bounded Arrow slice at a time: an operator maps
over the partitions of a DataFrame with ``mapInArrow`` and cuts each incoming
batch into slices of a few MB of text, so memory does not depend on the size
of a partition. One text is never cut; a very long text is a slice of its own.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.session import scratch_dir, ship_package

SLICE_BYTES = 2 << 20
#: Bytes that end a word: space and \t \n \v \f \r.
SPACE_BYTES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def prepare(spark: SparkSession) -> None:
    """Ship the package, and keep the Arrow batches between the JVM and Python small (long texts make large rows)."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_remainder(id_col: str = "doc_id"):
    """crc32 of the id as text, modulo 5: the fold of a document."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder (spark.checkpoint.dir) and read it back.

    Cuts the lineage, survives lost executors, and gives every reader the same
    rows in the same files.
    """
    path = f"{scratch_dir(df.sparkSession, name)}/{uuid.uuid4().hex[:8]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of a slice have ``limit`` bytes, or are one text."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        start, done = 0, 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield batch.slice(start, stop - start)
            start, done = stop, int(ends[stop - 1])
    pa.default_memory_pool().release_unused()  # workers are reused: give back what the task no longer needs


def text_of(batch: pa.RecordBatch, column: str) -> pa.Array:
    """The column without nulls (null text counts as empty)."""
    return pc.fill_null(batch.column(batch.schema.get_field_index(column)), "")


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts one after the other, and n + 1 offsets."""
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    kind = np.int64 if wide else np.int32
    if len(texts) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    off = np.frombuffer(offsets, kind)[texts.offset: texts.offset + len(texts) + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8)[off[0]: off[-1]] if data is not None else np.zeros(0, np.uint8)
    return body, off - off[0]


def rebuilt(body: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A string array over changed bytes at the same offsets."""
    return pa.StringArray.from_buffers(
        len(offsets) - 1, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(body)))


_UPPER = np.arange(256, dtype=np.uint8)
_UPPER[0x41:0x5B] += 32


def lower_ascii(texts: pa.Array) -> pa.Array:
    """A-Z in lower case, every other character as it is."""
    body, offsets = raw(texts)
    return rebuilt(_UPPER[body], offsets)


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words (runs without white space) and the row of each."""
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    row = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    keep = pc.greater(pc.binary_length(flat), 0)
    mask = keep.to_numpy(zero_copy_only=False)
    return (flat, row) if mask.all() else (flat.filter(keep), row[mask])


def codes(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Dictionary codes (int64) and the distinct values."""
    d = values.dictionary_encode()
    return d.indices.to_numpy(zero_copy_only=False).astype(np.int64), d.dictionary


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (wrapping arithmetic) that spreads all bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def repeated(*keys: np.ndarray) -> np.ndarray:
    """Mask of the rows whose key tuple occurs twice or more (exact).

    A hash in the high bits and the row in the low bits are sorted together;
    only rows whose hash meets another are compared in full.
    """
    n = len(keys[0])
    out = np.zeros(n, bool)
    if n < 2:
        return out
    bits = np.uint64(int(n - 1).bit_length())
    h = np.zeros(n, np.uint64)
    for k in keys:
        h = mix(h + k.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    packed = np.sort((h >> bits << bits) | np.arange(n, dtype=np.uint64))
    top, row = packed >> bits, (packed & np.uint64((1 << int(bits)) - 1)).astype(np.int64)
    same = top[1:] == top[:-1]
    near = np.zeros(n, bool)
    near[1:] |= same
    near[:-1] |= same
    some = row[near]
    if len(some) == 0:
        return out
    some = some[np.lexsort([k[some] for k in keys])]
    equal = np.ones(len(some) - 1, bool)
    for k in keys:
        equal &= k[some[1:]] == k[some[:-1]]
    hit = np.zeros(len(some), bool)
    hit[1:] |= equal
    hit[:-1] |= equal
    out[some[hit]] = True
    return out


def spans(lengths: np.ndarray) -> np.ndarray:
    """0 .. l-1 for each l, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)


def fresh(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def annotated(docs: DataFrame, text_col: str, name: str, fields: str, fn, limit: int = SLICE_BYTES) -> DataFrame:
    """``docs`` with one more struct column that ``fn(texts) -> arrays`` computes in Arrow batches.

    Every column of ``docs`` passes through unchanged; ``fn`` gets the texts of
    a slice without nulls and returns one array for each field.
    """
    from pyspark.sql import types as T

    kind = T.StructType.fromDDL(fields)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, kind)])
    names = [f.name for f in kind.fields]

    def run(batches):
        for part in slices(batches, text_col, limit):
            got = pa.StructArray.from_arrays(fn(text_of(part, text_col)), names=names)
            yield pa.RecordBatch.from_arrays([*part.columns, got], names=[*part.schema.names, name])

    return docs.mapInArrow(run, schema)
