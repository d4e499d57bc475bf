"""Where intermediate tables go, and when."""

import gc
import os
import time

import pytest

from pagelode import session as S


def _gone(spark, path):
    for _ in range(50):
        gc.collect()
        spark.sparkContext._jvm.java.lang.System.gc()
        S.sweep(spark)
        if not os.path.exists(path):
            return True
        time.sleep(0.1)
    return False


def test_tables_go_with_the_last_plan_that_reads_them(spark):
    df = S.materialize(spark.range(10), "probe")
    path = df.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    view = df.filter("id > 3").groupBy().count()
    del df
    S.sweep(spark)
    assert os.path.exists(path) and view.first()[0] == 6
    del view
    assert _gone(spark, path)


class _Context:
    """A cluster's context as far as it is asked here."""

    def __init__(self, master, named=None, set_dir=None):
        self.master, self._named, self._set = master, named, set_dir
        self.sparkContext, self.conf = self, self

    def get(self, key, default=None):
        return self._named or default

    def getConf(self):
        return self

    def getCheckpointDir(self):
        return self._set


def test_a_cluster_needs_a_shared_folder():
    for master in ("spark://h:7077", "yarn", "local-cluster[3,2,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            S.shared_dir(_Context(master))
    assert S.shared_dir(_Context("local[4]")).startswith("file:///")


def test_named_folders_are_honoured():
    assert S.shared_dir(_Context("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    assert S.shared_dir(_Context("yarn", None, "hdfs:///set/uuid")) == "hdfs:///set/uuid"
    assert S.shared_dir(_Context("yarn", "hdfs:///shared", "hdfs:///set/uuid")) == "hdfs:///shared"
