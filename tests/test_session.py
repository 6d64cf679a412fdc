from __future__ import annotations

import pytest

from filingspark import session


class Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class Session:
    def __init__(self, master, **conf):
        self.sparkContext, self._values = Context(master), conf
        self.conf = self

    def get(self, key, default):
        return self._values.get(key, default)


def test_named_folder_is_used():
    s = Session("spark://m:7077", **{"spark.checkpoint.dir": "s3://shared/state/"})
    assert session.shared_dir(s) == "s3://shared/state"
    assert s.sparkContext.folder == "s3://shared/state/"
    assert session.scratch(s, "x").startswith("s3://shared/state/filingspark/x-")


def test_cluster_without_folder_is_refused():
    with pytest.raises(ValueError):
        session.shared_dir(Session("yarn"))


def test_checkpoint_cuts_lineage(spark):
    df = spark.range(10).selectExpr("id * 2 AS x")
    kept = session.checkpoint(df)
    assert kept.count() == 10
    assert "Range" not in kept._jdf.queryExecution().optimizedPlan().toString()
