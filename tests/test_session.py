"""Where intermediate tables go."""

from __future__ import annotations

from types import SimpleNamespace

import pytest

from wattline.session import CHECKPOINT_KEY, fresh_dir, shared_dir


class FakeContext:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def fake(master, configured=None):
    conf = {CHECKPOINT_KEY: configured} if configured else {}
    return SimpleNamespace(sparkContext=FakeContext(master), conf=conf)


def test_the_clusters_folder_is_used():
    session = fake("yarn", "hdfs:///shared")
    assert shared_dir(session) == "hdfs:///shared" == session.sparkContext.folder
    assert fresh_dir(session, "x").startswith("hdfs:///shared/x-")


def test_a_cluster_without_a_folder_is_refused():
    with pytest.raises(ValueError, match=CHECKPOINT_KEY):
        shared_dir(fake("yarn"))


def test_a_local_master_makes_its_own():
    session = fake("local[2]")
    assert shared_dir(session) == shared_dir(session) == session.sparkContext.folder


def test_the_real_session_has_one(spark):
    assert shared_dir(spark) and spark.range(3).checkpoint().count() == 3
