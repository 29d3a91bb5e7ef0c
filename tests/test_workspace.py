import pytest

from fieldtally.workspace import run_folder


class Session:
    def __init__(self, **settings):
        self.conf = self
        self.settings = {key.replace("_", "."): value for key, value in settings.items()}

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_the_shared_folder_of_the_session_is_used():
    folder = run_folder(Session(spark_checkpoint_dir="hdfs://data/shared/"), "landed")
    assert folder.startswith("hdfs://data/shared/landed-")
    assert folder != run_folder(Session(spark_checkpoint_dir="hdfs://data/shared/"), "landed")


def test_only_a_local_session_may_go_without():
    assert "fieldtally-" in run_folder(Session(spark_master="local[2]"), "landed")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        run_folder(Session(spark_master="spark://host:7077"), "landed")
