"""The shared folder comes from the session; a private one is made only for a local session
that has none; a cluster session without one is refused."""

import pytest

from tidewater.session import scratch_path, shared_root


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, ckpt=None):
        self.master, self.ckpt = master, ckpt

    def getCheckpointDir(self):
        return self.ckpt

    def setCheckpointDir(self, path):
        self.ckpt = "file:" + path + "/uuid"


class _Session:
    def __init__(self, master, ckpt=None, conf=None):
        self.sparkContext = _Context(master, ckpt)
        self.conf = _Conf(conf or {})


def test_reads_the_session_setting():
    assert shared_root(_Session("yarn", "hdfs://nn/ckpt/abc/")) == "hdfs://nn/ckpt/abc"
    assert shared_root(_Session("yarn", conf={"spark.checkpoint.dir": "s3a://b/ckpt"})) == "s3a://b/ckpt"


def test_sets_a_private_folder_only_for_local_sessions():
    local = _Session("local[8]")
    root = shared_root(local)
    assert root.startswith("file:") and local.sparkContext.getCheckpointDir() is not None
    with pytest.raises(RuntimeError):
        shared_root(_Session("yarn"))


def test_scratch_paths_are_unique(spark):
    a, b = scratch_path(spark, "stage", "x"), scratch_path(spark, "stage", "x")
    assert a != b and "/tidewater-stage/x-" in a
