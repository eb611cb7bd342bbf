import pytest

from peopleflow import session


def test_shared_dir_is_the_named_one(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert session.shared_dir(spark) == named.rstrip("/")


class FakeSpark:
    def __init__(self, **conf):
        self.conf = conf


def test_a_cluster_must_name_its_folder():
    with pytest.raises(RuntimeError):
        session.shared_dir(FakeSpark(**{"spark.master": "yarn"}))


def test_local_mode_makes_its_own_folder():
    local = FakeSpark(**{"spark.master": "local[2]", "spark.app.id": "test-app"})
    assert session.shared_dir(local) == session.shared_dir(local)


def test_settings_are_put_back(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with session.session_conf(spark, {"spark.sql.shuffle.partitions": "3", "x.unset": "1"}):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert spark.conf.get("x.unset", None) is None


def test_staged_table_reads_back(spark):
    staged = session.stage(spark.range(10), "test")
    assert staged.count() == 10 and "peopleflow-" in staged.inputFiles()[0]
