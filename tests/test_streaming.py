from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from peopleflow.operators.merge import merge_messages
from peopleflow.operators.synth import generate_people
from peopleflow.plans import catalogue, inputs
from peopleflow.operators.messages import fanout
from peopleflow.schemas import KEY
from peopleflow.sources.topics import (
    read_replay,
    stream_replay,
    stream_topics,
    topic_options,
    write_replay,
)
from peopleflow import versions
from peopleflow.session import child_session, stage
from peopleflow.streaming import generate, live, progress, sinks
from peopleflow.streaming.expiry import merge_expiring
from peopleflow.streaming.merge import merge_session, merged_records, start_merge
from conftest import SF_DIR


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture
def replay(spark, tmp_path):
    path = str(tmp_path / "log")
    write_replay(inputs.full_log(spark, SF_DIR), path, 4)
    return path


@pytest.mark.parametrize("per_trigger, batches", [(1, 4), (4, 1)])
def test_merge_stream_equals_batch(spark, replay, tmp_path, per_trigger, batches):
    out, noted = str(tmp_path / "out"), str(tmp_path / "noted")
    with progress.progress_table(spark, noted) as table:
        query = start_merge(stream_replay(spark, replay, per_trigger), out, str(tmp_path / "cp"))
        query.awaitTermination()
        table.wait(query)
    assert progress.progress_report(spark, noted).count() == batches
    assert rows(merged_records(spark, out)) == rows(merge_messages(read_replay(spark, replay)))


def test_progress_knows_more_batches_than_spark_remembers(spark, tmp_path):
    path, out, cp, noted = (str(tmp_path / name) for name in ("log", "out", "cp", "noted"))
    assert progress.progress_report(spark, noted).count() == 0
    spark.range(0, 700, 1, 7).write.parquet(path)
    own = child_session(spark, {"spark.sql.streaming.numRecentProgressUpdates": "2"})
    with progress.progress_table(own, noted) as table:
        query = sinks.start_append(stream_replay(own, path, 1), out, cp)
        query.awaitTermination()
        table.wait(query)
    rows = progress.progress_report(spark, noted).orderBy("batch_id").collect()
    assert len(query.recentProgress) <= 2
    assert [(r.batch_id, r.input_rows, r.malformed) for r in rows] == [(i, 100, None) for i in range(7)]
    assert [r.rows_per_second > 0 for r in progress.rates(spark, noted).collect()] == [True] * 7


def test_progress_counts_messages_while_they_are_read(spark, log, tmp_path):
    path, out, cp, noted = (str(tmp_path / name) for name in ("log", "out", "cp", "noted"))
    with progress.progress_table(spark, noted) as table:
        for texts in (['{"id_persona":1}', "broken"], ['{"id_persona":2}', '{"id_persona":3} x', "{}"]):
            write_replay(log([(1, "personas", text) for text in texts]), path)
            counts = live.live_people_by_state(progress.observed(stream_replay(spark, path)))
            query = sinks.start_versions(counts, out, cp, "complete")
            query.awaitTermination()
            table.wait(query)
    rows = progress.progress_report(spark, noted).orderBy("batch_id").collect()
    assert [tuple(r) for r in rows] == [(0, 2, 2, 0, 0, 1), (1, 3, 3, 0, 0, 1)]


def test_restart_goes_on_and_reads_nothing_twice(spark, tmp_path):
    path, out, cp = (str(tmp_path / name) for name in ("log", "out", "cp"))

    def run():
        query = start_merge(stream_replay(spark, path), out, cp)
        query.awaitTermination()
        return sum(p["numInputRows"] for p in query.recentProgress)

    first, second = inputs.people_log(spark, SF_DIR), inputs.income_log(spark, SF_DIR)
    write_replay(first, path)
    assert run() == first.count()
    write_replay(second, path)
    assert run() == second.count()
    assert run() == 0
    assert rows(merged_records(spark, out)) == rows(merge_messages(first.unionByName(second)))


def test_partial_ids_survive_a_restart(spark, tmp_path):
    path, out, cp = (str(tmp_path / name) for name in ("log", "out", "cp"))
    log = inputs.people_log(spark, SF_DIR)
    for topics in ("topic = 'personas'", "topic <> 'personas'"):
        write_replay(log.where(topics), path)
        start_merge(stream_replay(spark, path), out, cp).awaitTermination()
    assert merged_records(spark, out).count() == log.count() // 3


@pytest.mark.parametrize("per_trigger", [1, 4])
def test_live_report_equals_batch(spark, replay, tmp_path, per_trigger):
    result = live.live_people_by_state(stream_replay(spark, replay, per_trigger))
    out = str(tmp_path / "out")
    sinks.start_versions(result, out, str(tmp_path / "cp"), "complete").awaitTermination()
    snapshot = sinks.last_snapshot(spark, out, result.schema)
    assert rows(snapshot) == rows(live.live_people_by_state(read_replay(spark, replay)))


def test_sorted_stream_needs_complete_mode(spark, replay, tmp_path):
    counts = live.ranked(live.live_people_by_state(stream_replay(spark, replay)), "estado")
    with pytest.raises(AnalysisException):
        sinks.start_versions(counts, str(tmp_path / "o"), str(tmp_path / "cp"), "update")


def test_console_report_runs(spark, replay):
    counts = live.live_people_by_state(stream_replay(spark, replay))
    query = sinks.start_console(live.ranked(counts, "estado"), every=None)
    query.awaitTermination()
    assert query.exception() is None


def test_generated_stream_resumes_after_the_last_id(spark, tmp_path):
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")

    def run(last_batch):
        sent = generate.message_stream(generate.id_stream(spark, per_batch=5, last_id=100))
        query = sinks.start_append(sent, out, cp, every="100 milliseconds")
        while query.isActive and (query.lastProgress is None or query.lastProgress["batchId"] < last_batch):
            query.awaitTermination(1)
        query.stop()

    run(2)
    seen = spark.read.parquet(out).count()
    assert seen >= 30 and seen % 15 == 0
    run(6)
    sent = spark.read.parquet(out)
    ids = sorted(r[0] for r in sent.select(KEY).distinct().collect())
    assert ids == list(range(101, 101 + len(ids))) and len(ids) * 15 > seen
    expected = fanout(generate_people(spark, ids[-1], last_id=100), keep=[KEY])
    assert rows(sent) == rows(expected)


def many_batches(spark, path, batches=50, ids=40):
    """A log whose files each change a share of the records once more."""
    for k in range(batches):
        rows = [("personas", 0, k * ids + i, k, f'{{"id":{i},"a":"v{k}","b":"{i}"}}') for i in range(k % 4, ids, 4)]
        df = spark.createDataFrame(rows, "topic string, partition int, offset bigint, s bigint, value string")
        write_replay(df.selectExpr("topic", "partition", "offset", "timestamp_seconds(s) AS timestamp", "value").coalesce(1), path)


PAIR = "id bigint, a string, b string"


def start_pairs(spark, path, out, cp):
    schema = spark.createDataFrame([], PAIR).schema
    merged = merge_messages(stream_replay(spark, path, 1), schema, "id")
    return sinks.start_versions(merged, out, cp, "update", key="id"), schema


def test_bytes_read_stay_bounded_after_many_batches(spark, tmp_path, monkeypatch):
    path, out, cp = (str(tmp_path / name) for name in ("log", "out", "cp"))
    many_batches(spark, path)
    broken = []

    def breaks_once(spark, folder):
        if not broken:
            broken.append(folder)
            raise OSError("lost between the two steps")
        finish(spark, folder)

    finish = versions.finish
    monkeypatch.setattr(versions, "finish", breaks_once)
    query, schema = start_pairs(spark, path, out, cp)
    with pytest.raises(Exception, match="lost between"):
        query.awaitTermination()
    # The snapshot that is not marked does not count, and what it was made of is still there.
    assert versions.finished(spark, f"{out}/snapshots", "upto") == [] and versions.exists(spark, broken[0])
    expected = merge_messages(read_replay(spark, path).where("second(timestamp) + 60 * minute(timestamp) < 8"), schema, "id")
    assert rows(sinks.last_rows(spark, out, schema, "id")) == rows(expected)
    query, schema = start_pairs(spark, path, out, cp)
    query.awaitTermination()
    assert rows(sinks.last_rows(spark, out, schema, "id")) == rows(merge_messages(read_replay(spark, path), schema, "id"))
    kept = versions.numbers(spark, f"{out}/changes", "batch_id")
    snapshots = versions.numbers(spark, f"{out}/snapshots", "upto")
    assert len(snapshots) == 2 and min(kept) > snapshots[0] and len(kept) < 50
    read = sinks.last_rows(spark, out, schema, "id").inputFiles()
    assert len({f.rsplit("/", 1)[0] for f in read}) <= 1 + 3 * sinks.COMPACT_AFTER


def test_a_complete_result_keeps_its_last_versions_only(spark, replay, tmp_path):
    result = live.live_people_by_state(stream_replay(spark, replay, 1))
    sinks.start_versions(result, str(tmp_path / "out"), str(tmp_path / "cp"), "complete").awaitTermination()
    assert versions.numbers(spark, str(tmp_path / "out" / "changes"), "batch_id") == [2, 3]
    assert sinks.last_snapshot(spark, str(tmp_path / "none"), result.schema).count() == 0


HOURS = [
    [(0, 1, '"a":"old"'), (0, 2, '"a":"x","b":"y"')],
    [(2, 3, '"a":"x"'), (2, 3, '"b":"y"')],
    [(4, 4, '"a":"x","b":null')],
    [(5, 1, '"b":"late"'), (5, 2, '"a":"new"')],
]


@pytest.mark.parametrize("expires", [False, True])
def test_incomplete_ids_can_expire(spark, log, tmp_path, expires):
    """Without expiry id 1 is completed after five hours; with it, its first message is forgotten by then."""
    path, out, cp = (str(tmp_path / name) for name in ("log", "out", "cp"))
    schema, rows_kept = spark.createDataFrame([], PAIR).schema, []
    for k, batch in enumerate(HOURS):
        write_replay(log([(90_000 + 3600 * h, "t", f'{{"id":{i},{body}}}') for h, i, body in batch]).withColumn("offset", F.col("offset") + 10 * k), path)
        replayed = stream_replay(merge_session(spark), path)
        merged = merge_expiring(replayed, "1 hour", schema, "id") if expires else merge_messages(replayed, schema, "id")
        query = sinks.start_versions(merged, out, cp, "update", key="id")
        query.awaitTermination()
        rows_kept.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    found = {tuple(r) for r in sinks.last_rows(spark, out, schema, "id").collect()}
    complete = {(2, "new", "y"), (3, "x", "y"), (4, "x", None)}
    assert found == (complete if expires else complete | {(1, "old", "late")})
    # State rows after each run: id 1 leaves when the watermark is two hours past its message, and comes back.
    assert rows_kept == ([2, 3, 3, 4] if expires else [2, 3, 4, 4])


def test_merge_session_leaves_the_other_alone(spark, tmp_path):
    path = str(tmp_path / "log")
    write_replay(inputs.people_log(spark, SF_DIR), path)
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    own = merge_session(spark)
    query = start_merge(stream_replay(own, path), str(tmp_path / "out"), str(tmp_path / "cp"))
    query.awaitTermination()
    assert "RocksDB" in own.conf.get("spark.sql.streaming.stateStore.providerClass")
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before
    assert own.conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")
    assert any("rocksdb" in k.lower() for k in query.lastProgress["stateOperators"][0]["customMetrics"])


def test_a_batch_admits_bytes_of_many_files(spark, tmp_path):
    path, noted = str(tmp_path / "log"), str(tmp_path / "noted")
    write_replay(inputs.people_log(spark, SF_DIR), path, rows_per_file=20)
    share = versions.stored_bytes(spark, path) // 3 + 1
    with progress.progress_table(spark, noted) as table:
        log = stream_replay(spark, path, bytes_per_trigger=share)
        query = sinks.start_append(log, str(tmp_path / "out"), str(tmp_path / "cp"))
        query.awaitTermination()
        table.wait(query)
    batches = [r.input_rows for r in progress.progress_report(spark, noted).collect()]
    assert 3 <= len(batches) <= 5 and sum(batches) == 450 and max(batches) > 20


def test_kafka_options():
    assert topic_options("b1:9092,b2:9092", ["x", "y"], "latest", max_per_trigger=7) == {
        "kafka.bootstrap.servers": "b1:9092,b2:9092",
        "subscribe": "x,y",
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "7",
    }
    batch = topic_options("b", ["x"], ending="latest", kafka__security__protocol="SSL")
    assert batch["endingOffsets"] == "latest" and batch["kafka.security.protocol"] == "SSL"


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        stream_topics(spark, "localhost:9092", ["x"])


def test_a_replayed_log_has_bounded_files_and_no_batch_for_the_rest(spark, tmp_path, monkeypatch):
    """Files do not grow with the log, as tasks would, and a last batch for a few files is not worth its state."""
    monkeypatch.setattr(catalogue, "REPLAY_ROWS", 50, raising=False)
    stored = str(tmp_path / "log")
    monkeypatch.setattr(catalogue, "new_path", lambda spark, label: stored)
    log = spark.range(0, 4000, 1, 3).selectExpr(
        "'t' AS topic", "0 AS partition", "id AS offset", "timestamp_seconds(id) AS timestamp", "sha2('' || id, 512) AS value"
    )
    messages = catalogue._replayed(spark, log)
    files = spark.read.parquet(stored).groupBy(F.input_file_name()).count().collect()
    assert len(files) >= 80 and max(n for _, n in files) <= 50
    query = sinks.start_append(messages, str(tmp_path / "out"), str(tmp_path / "cp"))
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p.numInputRows]) == catalogue.REPLAY_BATCHES
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4000
    assert sinks.LARGE_STATE["spark.sql.files.maxPartitionBytes"] == "16m"
