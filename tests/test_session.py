"""The scratch area: shared on a cluster, private only for local masters."""

import pytest

from layercake import session


class _Conf:
    def get(self, key, default=None):
        return default


class _Context:
    applicationId = "app"

    def __init__(self, master):
        self.master, self.dir = master, None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, path):
        self.dir = path


class _Session:
    def __init__(self, master):
        self.conf, self.sparkContext = _Conf(), _Context(master)


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://x", "local-cluster[2,1,1024]"])
def test_cluster_without_shared_folder_is_refused(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_path(_Session(master), "x")


def test_local_master_gets_a_private_folder():
    s = _Session("local[4]")
    first, second = session.scratch_path(s, "x"), session.scratch_path(s, "x")
    assert first != second and first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0]


def test_scratch_area_is_removed(spark):
    df = session.materialize(spark.range(5), "kept")
    files = df.inputFiles()
    assert df.count() == 5 and files
    session.clear_scratch(spark)
    import os

    assert not any(os.path.exists(f.removeprefix("file://")) for f in files)
