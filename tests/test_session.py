"""The checkpoint folder comes from the cluster; a local temp folder is
created only for local-mode sessions."""

import pytest

from tessera.session import checkpoint_dir


class _Conf(dict):
    def get(self, key, default=None):
        return super().get(key, default)


class _Context:
    def __init__(self, master, current=None, conf=None):
        self.master = master
        self._dir = current
        self._conf = _Conf(conf or {})

    def getCheckpointDir(self):
        return self._dir

    def setCheckpointDir(self, d):
        self._dir = d

    def getConf(self):
        return self._conf


class _Session:
    def __init__(self, ctx, conf=None):
        self.sparkContext = ctx
        self.conf = _Conf(conf or {})


def test_cluster_without_checkpoint_dir_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(_Session(_Context("yarn")))


def test_configured_dir_is_used():
    s = _Session(_Context("yarn"), {"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert checkpoint_dir(s) == "hdfs:///shared/ckpt"


def test_existing_dir_wins():
    s = _Session(_Context("k8s://x", current="s3a://b/ckpt"), {"spark.checkpoint.dir": "other"})
    assert checkpoint_dir(s) == "s3a://b/ckpt"


def test_local_session_gets_temp_dir():
    assert checkpoint_dir(_Session(_Context("local[2]"))).startswith("/")


def test_package_is_shipped_once(spark):
    from tessera.session import PACKAGE_ZIP, ship_package

    ship_package(spark)
    ship_package(spark)
    assert sum(f.endswith(PACKAGE_ZIP) for f in spark.sparkContext.listFiles) == 1
    got = spark.range(4).rdd.mapPartitions(lambda _: [__import__("tessera.functions.columns").__name__]).collect()
    assert set(got) == {"tessera"}
