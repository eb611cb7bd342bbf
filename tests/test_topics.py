from conftest import SF_DIR, plan_of
from peopleflow.plans import inputs
from peopleflow.schemas import LOG_SCHEMA
from peopleflow.sources.topics import read_replay, write_replay


def test_a_log_by_topic_reads_back(spark, tmp_path):
    log = inputs.full_log(spark, SF_DIR)
    write_replay(log, str(tmp_path / "log"), by_topic=True)
    back = read_replay(spark, str(tmp_path / "log"))
    assert back.columns == LOG_SCHEMA.names
    assert sorted(map(repr, back.collect())) == sorted(map(repr, log.collect()))


def test_one_topic_is_one_folder(spark, tmp_path):
    write_replay(inputs.people_log(spark, SF_DIR), str(tmp_path / "log"), by_topic=True)
    plan = plan_of(read_replay(spark, str(tmp_path / "log")).where("topic = 'empleos'"))
    assert "PartitionFilters: [isnotnull(topic" in plan
