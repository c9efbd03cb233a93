"""Session construction and shared scratch locations."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Fixed clocks used by tests and registered queries instead of now().
AS_OF = "2024-06-30 00:00:00"
RUNS_AS_OF = "2001-08-01 12:00:00"


def get_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "lakestrata") -> SparkSession:
    """Local/test session with AQE on and the UI off.

    On a cluster the session comes from the launcher: when a session is
    active and no master is given, it is returned unchanged.
    """
    active = SparkSession.getActiveSession()
    if active is not None and master is None:
        # the launcher's session (cluster): keep its partitioning and AQE settings
        ship_package(active)
        return active
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session. Where it is unset, a local run (a ``local`` master,
    as in tests) gets a fresh local folder; on a cluster that would leave
    every executor with its own part of the files, so it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that driver and executors share (master is {master})")
        root = tempfile.mkdtemp(prefix="lakestrata-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        try:
            spark.conf.set("spark.checkpoint.dir", root)
        except Exception:  # noqa: BLE001 - core conf may be read-only; the context dir is set
            pass
    return root


_SCOPE: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def _hadoop(spark: SparkSession, path: str):
    """(path, its file system) as Spark's own layer knows them, in any store."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def scratch_dir(spark: SparkSession, name: str = "run", keep: bool = False) -> str:
    """A new, unique folder under the shared checkpoint root.

    It is deleted when the enclosing ``scratch_scope`` ends, or else with the
    application; ``keep`` leaves it, as tables of a catalog need.
    """
    path = f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    p, fs = _hadoop(spark, path)
    fs.mkdirs(p)
    if not keep:
        fs.deleteOnExit(p)
        paths = _SCOPE.get()
        if paths is not None:
            paths.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the scratch folders made inside the block when it ends, also by an error.

    For long-lived sessions. Operators return lazy frames that may read
    scratch tables, so results must be written or collected inside the block.
    Blocks may be nested; each deletes its own folders.
    """
    token = _SCOPE.set([])
    try:
        yield
    finally:
        paths = _SCOPE.get()
        _SCOPE.reset(token)
        for path in paths:
            p, fs = _hadoop(spark, path)
            fs.delete(p, True)
            fs.cancelDeleteOnExit(p)


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: one computation for several readers."""
    path = scratch_dir(df.sparkSession, name) + "/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``lakestrata`` importable in Python workers (once per application).

    Operators that run Python inside tasks (``mapInPandas``) refer to
    helpers of this package; the package is zipped and added with
    ``addPyFile`` so executors can import it wherever the driver runs from.
    """
    import hashlib
    import io
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for root, dirs, files in os.walk(pkg):
            dirs[:] = [d for d in dirs if d != "__pycache__"]
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    data = buf.getvalue()
    name = f"lakestrata-{hashlib.sha1(data).hexdigest()[:12]}.zip"
    # the zip goes to the shared folder (spark.checkpoint.dir), never to a
    # machine-local temporary folder; executors fetch it from there
    root = checkpoint_root(spark)
    path = f"{root.rstrip('/')}/pyfiles/{name}"
    if "://" not in root or root.startswith("file:"):
        local = path.replace("file://", "").replace("file:", "")
        os.makedirs(os.path.dirname(local), exist_ok=True)
        if not os.path.exists(local):
            with open(local, "wb") as fh:
                fh.write(data)
    else:
        jvm = sc._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        fs = target.getFileSystem(sc._jsc.hadoopConfiguration())
        if not fs.exists(target):
            out = fs.create(target, True)
            try:
                out.write(bytearray(data))
            finally:
                out.close()
    sc.addPyFile(path)
    _SHIPPED.add(app)
