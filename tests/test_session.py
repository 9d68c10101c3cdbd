import pytest

from lakestar import session


class _Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return None

    def getConf(self):
        return self

    def get(self, key, default=None):
        return default


class _Spark:
    def __init__(self, master):
        self.sparkContext = _Context(master)


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://x"])
def test_cluster_without_shared_folder_is_an_error(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(_Spark(master))
