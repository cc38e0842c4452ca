"""Checkpoint folder rules: a cluster must name a shared folder; a local
session without one gets no files from the registered queries."""

import os
import tempfile

import pytest

import __spark_entry__ as E
from kinrank.session import ensure_checkpoint_dir, materialize, parallelism


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, current=None):
        self.master, self.current, self.set_to = master, current, None
        self.applicationId = "app-1"

    def getCheckpointDir(self):
        return self.current or self.set_to

    def setCheckpointDir(self, d):
        self.set_to = d


class _Session:
    def __init__(self, master, conf=None, current=None):
        self.sparkContext = _Context(master, current)
        self.conf = _Conf(conf or {})


def test_cluster_without_shared_folder_is_refused():
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(_Session("yarn"))


def test_cluster_uses_the_named_folder():
    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert ensure_checkpoint_dir(s) == "hdfs:///shared/ckpt"


def test_existing_folder_is_kept():
    assert ensure_checkpoint_dir(_Session("yarn", current="s3://bucket/ckpt")) == "s3://bucket/ckpt"


def test_local_session_gets_one_scratch_folder():
    s = _Session("local[2]")
    assert ensure_checkpoint_dir(s) == ensure_checkpoint_dir(s)
    assert s.sparkContext.set_to is None


def test_materialize_on_a_cluster_without_a_folder_is_refused():
    class _Frame:
        sparkSession = _Session("yarn")

    with pytest.raises(RuntimeError):
        materialize(_Frame())


LAZY = ["ratings_load", "split_train", "split_test", "user_means", "user_profiles", "item_profiles", "constant_raters", "biased_raters"]


def test_queries_write_no_files_of_ours(spark, monkeypatch):
    from kinrank import session

    monkeypatch.setattr(session.tempfile, "mkdtemp", lambda *a, **k: pytest.fail("a scratch folder was made"))
    monkeypatch.setattr(session, "named_folder", lambda spark: None)
    before = {x for x in os.listdir(tempfile.gettempdir()) if x.startswith("kinrank")}
    for key in ("recommend_top_n", "rmse", "predict_nbcf", "user_history", "similarity_overlap"):
        E.queries()[key](spark, "/root/testdata/sf0.001").count()
    assert {x for x in os.listdir(tempfile.gettempdir()) if x.startswith("kinrank")} == before


@pytest.mark.parametrize("key", LAZY)
def test_single_read_queries_run_no_job_while_built(spark, key):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(f"build-{key}", key)
    spark.read.parquet("/root/testdata/sf0.001/orders.parquet")      # reading a footer may be a job
    seen = len(tracker.getJobIdsForGroup(f"build-{key}"))
    E.queries()[key](spark, "/root/testdata/sf0.001")
    footers = 2 * max(seen, 1)
    assert len(tracker.getJobIdsForGroup(f"build-{key}")) - seen <= footers
    spark.sparkContext.setJobGroup("", "")


def test_parallelism_follows_shuffle_partitions():
    assert parallelism(_Session("local", {"spark.sql.shuffle.partitions": "64"})) == 64
