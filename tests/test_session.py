"""Where intermediates are written."""

from __future__ import annotations

import os
import time

import pytest
from pyspark.sql import functions as F

from reviewmill.session import cut_lineage, scratch_path, shared_folder, tidy_disks


class Context:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class Session:
    """Stands in for a session whose configuration lacks or has the setting."""

    def __init__(self, master, setting=None):
        self.sparkContext, self.setting = Context(master), setting
        self.conf = self

    def get(self, key, default):
        return self.setting or default


def test_cluster_without_the_setting_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session("spark://host:7077"))


def test_local_session_keeps_one_folder():
    session = Session("local[2]")
    assert shared_folder(session) == shared_folder(session)


def test_setting_is_used():
    session = Session("spark://host:7077", "/shared/points")
    assert shared_folder(session) == "/shared/points" == session.sparkContext.folder


def test_written_rows_come_back(spark):
    written = cut_lineage(spark.range(100))
    assert written.count() == 100 and written.columns == ["id"]
    assert scratch_path(spark, "a") != scratch_path(spark, "a")


def test_shuffle_files_of_finished_steps_go(spark):
    """They stayed until the driver's memory happened to be tidied up twice."""
    tidy_disks(spark)
    folders = [str(f) for f in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]

    def shuffled():
        return [f for top in folders for _, _, names in os.walk(top) for f in names if f.startswith("shuffle_") and f.endswith(".data")]

    before = set(shuffled())
    written = cut_lineage(spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count())
    assert set(shuffled()) - before
    tidy_disks(spark)
    for _ in range(50):
        if not set(shuffled()) - before:
            break
        time.sleep(0.1)
    assert not set(shuffled()) - before and written.count() == 100
