"""Scratch folders: shared folder first, a local fallback for a local master only."""

import types

import pytest

from tractlake import session


class _Conf(dict):
    def set(self, k, v):
        self[k] = v


def _fake(master, conf=None, checkpoint=None):
    sc = types.SimpleNamespace(master=master, dir=checkpoint)
    sc.getCheckpointDir = lambda: sc.dir
    sc.setCheckpointDir = lambda d: setattr(sc, "dir", d)
    return types.SimpleNamespace(sparkContext=sc, conf=_Conf(conf or {}))


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[2,1,1024]", "k8s://x"])
def test_cluster_without_shared_folder_raises(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(_fake(master))


def test_named_folder_is_used_as_it_is():
    fake = _fake("yarn", {"spark.checkpoint.dir": "hdfs://nn/ckpt/"})
    a, b = session.scratch_dir(fake, "x"), session.scratch_dir(fake, "x")
    assert a != b and a.startswith("hdfs://nn/ckpt/x-")


@pytest.mark.parametrize("master", ["local", "local[4]", "local[*]"])
def test_local_master_gets_one_fallback(master):
    fake = _fake(master)
    assert session.ensure_checkpoint_dir(fake) == session.ensure_checkpoint_dir(fake)
