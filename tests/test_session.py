"""Where intermediate tables go."""

import pytest

from chalkline import session


class FakeContext:
    def __init__(self, master, current=None):
        self.master, self.current = master, current

    def getCheckpointDir(self):
        return self.current

    def setCheckpointDir(self, path):
        self.current = f"{path}/some-uuid"


class FakeSession:
    def __init__(self, master, configured=None, current=None):
        self.sparkContext = FakeContext(master, current)
        self.conf = {"spark.checkpoint.dir": configured} if configured else {}


def test_the_named_folder_is_used():
    spark = FakeSession("spark://head", configured="hdfs://shared/steps")
    assert session.shared_dir(spark) == "hdfs://shared/steps"
    assert session.scratch_path(spark, "x").startswith("hdfs://shared/steps/chalkline-x-")


def test_a_folder_set_on_the_context_is_used():
    assert session.shared_dir(FakeSession("spark://head", current="hdfs://other/uuid")) == "hdfs://other"


def test_a_cluster_without_a_folder_is_an_error():
    with pytest.raises(RuntimeError):
        session.shared_dir(FakeSession("spark://head"))


def test_local_sessions_get_their_own(spark):
    assert session.scratch_path(spark, "a") != session.scratch_path(spark, "a")
    df = session.materialized(spark.range(5).withColumnRenamed("id", "n"))
    assert df.columns == ["n"] and df.count() == 5
