"""Keyed tables that grow by batches: runs merged on read, one commit a batch.

A batch is written as a run, a folder of its own, already reduced to one row a
key. A small state file lists the runs that count, oldest first, and the last
batch that each writer has applied. Creating the next state file, which fails
if another writer has created it first, is the only commit: a batch counts in
full or not at all, a replayed batch is known by its writer and number however
many other writers came in between, and a run that no state lists is no part
of the table.

Readers merge the rows of a key over the runs. So that there are few, a commit
folds the newest runs into one while the run before them is not at least
``RATIO`` times as large: the runs grow geometrically, a row is rewritten once
for each doubling of the table, and a batch that is small against the table
leaves all older runs as they are. Nothing depends on a number of buckets that
was guessed when the table was small.

Runs that a commit folds are removed by the commit after it, so a reader of the
state before still finds its files.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AGE_COL = "_age"
RATIO = 2.0


@dataclass
class State:
    version: int = 0
    runs: list[dict] = field(default_factory=list)  # {"name", "bytes"}, oldest first
    applied: dict[str, int] = field(default_factory=dict)
    dropped: list[str] = field(default_factory=list)  # folded by this version


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _state_file(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/_state/{version:012d}.json"


def load_state(spark: SparkSession, path: str) -> State:
    """The latest state of the table at ``path``; version 0 is a table without one."""
    fs, folder = _fs(spark, f"{path.rstrip('/')}/_state")
    if not fs.exists(folder):
        return State()
    names = sorted(x.getPath().getName() for x in fs.listStatus(folder) if x.getPath().getName().endswith(".json"))
    if not names:
        return State()
    jvm = spark.sparkContext._jvm
    stream = fs.open(jvm.org.apache.hadoop.fs.Path(folder, names[-1]))
    try:
        return State(**json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
    finally:
        stream.close()


def _commit(spark: SparkSession, path: str, state: State) -> bool:
    """Create the state file, whole; False if the version exists already."""
    sc, target = spark.sparkContext, _state_file(path, state.version)
    fs, final = _fs(spark, target)
    _, draft = _fs(spark, f"{target}.{uuid.uuid4().hex[:8]}")
    out = fs.create(draft, False)
    try:
        out.write(bytearray(json.dumps(state.__dict__).encode()))
    finally:
        out.close()
    files = sc._jvm.org.apache.hadoop.fs
    context = files.FileContext.getFileContext(final.toUri(), sc._jsc.hadoopConfiguration())
    keep = sc._gateway.new_array(files.Options.Rename, 1)
    keep[0] = getattr(files.Options.Rename, "NONE")  # never over an existing file
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(final), keep)
        return True
    except Exception:  # noqa: BLE001 - the file exists, or the store failed: told apart below
        if not fs.exists(final):
            raise
        fs.delete(draft, False)
        return False


def _size(spark: SparkSession, path: str) -> int:
    fs, p = _fs(spark, path)
    return int(fs.getContentSummary(p).getLength())


def _read(spark: SparkSession, path: str, runs: list[dict]) -> DataFrame:
    """Rows of some runs; AGE_COL orders the runs, oldest first."""
    frames = [spark.read.parquet(f"{path}/{r['name']}").withColumn(AGE_COL, F.lit(k)) for k, r in enumerate(runs)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def append(df: DataFrame, path: str, writer: str, batch: int, merge: Callable[[DataFrame], DataFrame]) -> bool:
    """Add one batch, already reduced to a row a key; False if ``writer`` has applied it before.

    ``merge`` takes rows of several runs with AGE_COL and gives one row a key, without it.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    if load_state(spark, path).applied.get(writer, -1) >= batch:
        return False
    # Spark's own job commit makes the folder whole; its name is new, so another attempt's files never mix in
    name = f"runs/{writer}-{batch}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(f"{path}/{name}")
    new = {"name": name, "bytes": _size(spark, f"{path}/{name}")}
    while True:
        old = load_state(spark, path)
        if old.applied.get(writer, -1) >= batch:
            remove(spark, f"{path}/{name}")
            return False
        runs, total = [*old.runs, new], new["bytes"]
        first = len(runs) - 1
        while first > 0 and runs[first - 1]["bytes"] < RATIO * total:
            first -= 1
            total += runs[first]["bytes"]
        folded = runs[first:] if first < len(runs) - 1 else []
        if folded:
            whole = f"runs/{writer}-{batch}-{uuid.uuid4().hex[:8]}"
            merge(_read(spark, path, folded)).write.parquet(f"{path}/{whole}")
            runs = [*runs[:first], {"name": whole, "bytes": _size(spark, f"{path}/{whole}")}]
        state = State(old.version + 1, runs, old.applied | {writer: batch}, [r["name"] for r in folded])
        if _commit(spark, path, state):
            for gone in old.dropped:
                remove(spark, f"{path}/{gone}")
            if old.version > 1:
                remove(spark, _state_file(path, old.version - 1))
            return True
        if folded:
            remove(spark, f"{path}/{whole}")


def read_runs(spark: SparkSession, path: str, merge: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The table as of its latest state: one row a key."""
    path = path.rstrip("/")
    runs = load_state(spark, path).runs
    if not runs:
        raise ValueError(f"no batch has been committed to {path}")
    if len(runs) == 1:
        return spark.read.parquet(f"{path}/{runs[0]['name']}")  # already merged
    return merge(_read(spark, path, runs))
