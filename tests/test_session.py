"""Session helpers: checkpoint folder policy and cluster sizing."""

import pytest

from carewatch import session as S


class _SC:
    def __init__(self, master, d=None):
        self.master, self._d = master, d

    def getCheckpointDir(self):
        return self._d

    def setCheckpointDir(self, d):
        self._d = d


class _Conf:
    def get(self, k, default=None):
        return default


class _Spark:
    def __init__(self, master, d=None):
        self.sparkContext, self.conf = _SC(master, d), _Conf()


def test_cluster_without_checkpoint_dir_is_an_error():
    with pytest.raises(RuntimeError):
        S.ensure_checkpoint_dir(_Spark("yarn"))


def test_configured_checkpoint_dir_is_used_and_local_gets_scratch():
    assert S.ensure_checkpoint_dir(_Spark("yarn", "hdfs:///ckpt")) == "hdfs:///ckpt"
    local = _Spark("local[4]")
    d = S.ensure_checkpoint_dir(local)
    assert d and local.sparkContext.getCheckpointDir() == d


def test_recommended_conf_scales_and_caps():
    small = S.recommended_conf(10 ** 9, 8)
    big = S.recommended_conf(100 * 2 ** 40, 8000)
    assert small["spark.sql.shuffle.partitions"] == "16"
    assert big["spark.sql.shuffle.partitions"] == "102400"
    assert int(S.recommended_conf(10 ** 18, 8)["spark.sql.shuffle.partitions"]) == -(-10 ** 18 // 2 ** 30)
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"
