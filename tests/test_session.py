import pytest

from tslines.session import is_small, prepare, scratch_path, scratch_root, sql_conf, staged


class FakeSession:
    """A session whose settings a test can choose; the real one is fixed at start."""

    def __init__(self, master, settings, checkpoint=None):
        self.conf = self.sparkContext = self
        self.master, self.applicationId = master, "app"
        self.settings, self.checkpoint = settings, checkpoint

    def get(self, key, default=None):
        return self.settings.get(key, default)

    def getCheckpointDir(self):
        return self.checkpoint


def test_scratch_folder_is_the_one_the_session_names():
    named = FakeSession("spark://host:7077", {"spark.checkpoint.dir": "/shared/a"}, "/shared/b")
    assert scratch_root(named) == "/shared/a"
    assert scratch_root(FakeSession("spark://host:7077", {}, "/shared/b")) == "/shared/b"
    assert scratch_path(named, "x") != scratch_path(named, "x")
    assert scratch_path(named, "x").startswith("/shared/a/x-")


def test_a_cluster_without_a_shared_folder_is_an_error():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(FakeSession("spark://host:7077", {}))


def test_staged_rows_are_read_from_storage(spark):
    df = staged(spark.range(3).withColumnRenamed("id", "v"))
    assert sorted(r.v for r in df.collect()) == [0, 1, 2]
    assert "Range" not in df._jdf.queryExecution().executedPlan().toString()


def test_settings_are_applied_and_put_back(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    assert prepare(spark).conf.get("spark.sql.session.timeZone") == "UTC"
    with sql_conf(spark, {"spark.sql.session.timeZone": "Asia/Tokyo", "my.own": "1"}):
        assert spark.conf.get("my.own") == "1"
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("my.own", None) is None


def test_is_small(spark):
    assert is_small(spark.range(3), 3)
    assert not is_small(spark.range(4), 3)
