"""The shared checkpoint folder: read from the session, invented only locally."""

import pytest

from tillroll.session import checkpoint_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, current=None):
        self.master = master
        self.current = current

    def getCheckpointDir(self):
        return self.current

    def setCheckpointDir(self, path):
        self.current = path


class _Session:
    def __init__(self, master, conf=None, current=None):
        self.sparkContext = _Context(master, current)
        self.conf = _Conf(conf or {})


def test_cluster_without_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir is not set"):
        checkpoint_dir(_Session("yarn"))


def test_configured_folder_is_used():
    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert checkpoint_dir(s) == "hdfs:///shared/ckpt"
    assert s.sparkContext.getCheckpointDir() == "hdfs:///shared/ckpt"


def test_local_session_gets_a_private_folder():
    s = _Session("local[2]")
    assert checkpoint_dir(s).startswith("/") and s.sparkContext.getCheckpointDir()


def test_submitted_settings_are_kept(monkeypatch):
    from tillroll import session

    monkeypatch.delenv("PYSPARK_GATEWAY_PORT", raising=False)
    monkeypatch.setenv("PYSPARK_SUBMIT_ARGS", "--driver-memory 4g --conf spark.sql.adaptive.enabled=false pyspark-shell")
    assert session.submitted("spark.driver.memory") and session.submitted("spark.sql.adaptive.enabled")
    assert not session.submitted("spark.sql.adaptive.advisoryPartitionSizeInBytes")
