from types import SimpleNamespace

import pytest

from wattlake.session import JIT_METHOD_LIMIT, shared_root, tune, work_path


def stub(master, configured=None):
    class Context:
        def __init__(self):
            self.master, self.dir = master, None

        def getCheckpointDir(self):
            return self.dir

        def setCheckpointDir(self, folder):
            self.dir = f"file:{folder}/1"

    return SimpleNamespace(sparkContext=Context(), conf=SimpleNamespace(get=lambda key, default=None: configured))


def test_configured_folder_is_used():
    assert shared_root(stub("spark://host:7077", "hdfs://lake/checkpoints/")) == "hdfs://lake/checkpoints"


def test_cluster_without_folder_is_an_error():
    with pytest.raises(ValueError):
        shared_root(stub("spark://host:7077"))


def test_local_master_gets_one_folder():
    session = stub("local[2]")
    assert shared_root(session) == shared_root(session)


def test_real_session(spark):
    assert spark.sparkContext.applicationId in work_path(spark, "x")
    assert tune(spark).conf.get("spark.sql.codegen.hugeMethodLimit") == JIT_METHOD_LIMIT
