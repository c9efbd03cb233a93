"""Scratch folders go with their block or with the application."""
import glob
import os
import subprocess
import sys

import pytest

from lakestrata.session import checkpoint_root, scratch_dir, scratch_scope, scratch_table


def _folders(spark, name):
    return glob.glob(f"{checkpoint_root(spark).removeprefix('file:')}/{name}-*")


def test_a_scope_deletes_what_was_made_inside(spark):
    before = scratch_table(spark.range(5), "scope-before")
    with scratch_scope(spark):
        kept = scratch_dir(spark, "scope-kept", keep=True)
        assert scratch_table(spark.range(7), "scope-outer").count() == 7
        with scratch_scope(spark):
            assert scratch_table(spark.range(3), "scope-inner").count() == 3
        assert not _folders(spark, "scope-inner") and len(_folders(spark, "scope-outer")) == 1
    assert not _folders(spark, "scope-outer") and os.path.isdir(kept)
    assert before.count() == 5  # made outside


def test_a_scope_that_fails_deletes_too(spark):
    with pytest.raises(ValueError):
        with scratch_scope(spark):
            scratch_table(spark.range(2), "scope-failed")
            raise ValueError
    assert not _folders(spark, "scope-failed")
    scratch_dir(spark, "scope-after")
    assert len(_folders(spark, "scope-after")) == 1


def test_the_application_deletes_the_rest_when_it_ends(tmp_path):
    code = f"""
import sys
sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", {str(tmp_path)!r}).getOrCreate())
from lakestrata.session import scratch_dir, scratch_table
assert scratch_table(spark.range(4), "gone").count() == 4
scratch_dir(spark, "kept", keep=True)
spark.stop()
"""
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120)
    import time
    for _ in range(100):  # the JVM's last steps
        if not glob.glob(f"{tmp_path}/gone-*"):
            break
        time.sleep(0.1)
    assert not glob.glob(f"{tmp_path}/gone-*") and len(glob.glob(f"{tmp_path}/kept-*")) == 1
