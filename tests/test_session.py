"""Checkpoint folder rules: the session's setting wins; a local folder only
in local mode; on a cluster a missing setting is an error."""

import types

import pytest

from repforge.session import ensure_checkpoint_dir


class _Ctx:
    def __init__(self, master, current=None):
        self.master, self._dir = master, current

    def getCheckpointDir(self):
        return self._dir

    def setCheckpointDir(self, path):
        self._dir = path


def _session(master, configured=None, current=None):
    conf = types.SimpleNamespace(get=lambda key, default=None: configured or default)
    return types.SimpleNamespace(sparkContext=_Ctx(master, current), conf=conf)


def test_existing_dir_is_kept():
    assert ensure_checkpoint_dir(_session("yarn", current="hdfs:///ck")) == "hdfs:///ck"


def test_configured_dir_is_used():
    assert ensure_checkpoint_dir(_session("yarn", configured="s3a://b/ck")) == "s3a://b/ck"


def test_local_fallback_only_in_local_mode():
    assert ensure_checkpoint_dir(_session("local[4]")).startswith("/tmp/")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_session("spark://cluster:7077"))
