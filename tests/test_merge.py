"""The merge against a plain dictionary that is updated message by message."""

from __future__ import annotations

import json
import random
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from conftest import plan_of
from peopleflow import versions
from peopleflow.functions.json_text import END, field_texts, is_message
from peopleflow.operators.completion import completions, first_n_records
from peopleflow.operators.merge import (
    field_messages,
    join_topics,
    latest_states,
    merge_fields,
    merge_messages,
    schema_fields,
    sent_together,
    typed,
)
from peopleflow.operators.messages import fanout
from peopleflow.operators.synth import generate_people
from peopleflow.schemas import KEY, PEOPLE_COLUMNS, POSITION
from peopleflow.sources.snapshot import log_ends, pinned_options
from peopleflow.streaming.target import resume_target

THREE = StructType(
    [StructField("id", LongType())] + [StructField(n, StringType()) for n in ("a", "b", "c")]
)


def random_messages(count: int, ids: int, seed: int) -> list[tuple[int, str, str]]:
    """Partial messages with explicit nulls, bad text, one id with a third of all rows."""
    rng = random.Random(seed)
    messages = []
    for _ in range(count):
        key = 1 if rng.random() < 0.34 else rng.randrange(ids)
        body = {"id": key}
        for name in rng.sample("abc", rng.randrange(1, 3)):
            body[name] = None if rng.random() < 0.1 else f"{name}{rng.randrange(1000)}"
        if rng.random() < 0.05:
            body.pop("id")
        text = "broken {" if rng.random() < 0.05 else json.dumps(body)
        messages.append((rng.randrange(50), rng.choice(["t1", "t2"]), text))
    return messages


def model(messages, stop_after: int | None = None) -> dict[int, dict]:
    """Complete records after all messages, or after the N-th id became complete."""
    ordered = sorted(enumerate(messages), key=lambda m: (m[1][0], m[1][1], 0, m[0]))
    state: dict[int, dict] = {}
    complete = 0
    for _, (_, _, text) in ordered:
        try:
            body = json.loads(text)
        except ValueError:
            continue
        if "id" not in body:
            continue
        record = state.setdefault(body["id"], {})
        before = len(record)
        record.update(body)
        complete += before < 4 <= len(record)
        if complete == stop_after:
            break
    return {key: record for key, record in state.items() if len(record) == 4}


def as_model(df) -> dict[int, dict]:
    return {r.id: r.asDict() for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_merge_equals_dictionary_updates(spark, log, seed):
    messages = random_messages(400, 40, seed)
    merged = merge_messages(log(messages).repartition(5), THREE, "id")
    assert as_model(merged) == model(messages)


def test_incomplete_ids_can_be_kept(spark, log):
    merged = merge_messages(
        log([(1, "t", '{"id":1,"a":"x"}'), (2, "t", '{"id":1,"b":null}')]), THREE, "id",
        complete_only=False,
    )
    assert [tuple(r) for r in merged.collect()] == [(1, "x", None, None)]


def test_last_of_two_equal_keys_in_one_message(spark, log):
    merged = merge_messages(log([(1, "t", '{"id":1,"a":"x","a":"y","b":"1","c":"2"}')]), THREE, "id")
    assert merged.first().a == "y"


@pytest.mark.parametrize("n", [1, 2, 5, 15, 39, 1000])
def test_first_n_as_of_the_nth_completion(spark, log, n):
    messages = random_messages(300, 40, 7)
    first = as_model(first_n_records(log(messages), n, THREE, "id"))
    assert first == model(messages, n)
    assert len(first) == min(n, len(model(messages)))


def test_first_n_leaves_out_later_updates(spark, log):
    full = '{{"id":{},"a":"old","b":"1","c":"2"}}'
    messages = [(1, "t", full.format(7)), (2, "t", full.format(2)), (3, "t", full.format(9))]
    messages.insert(2, (4, "t", '{"id":7,"a":"late"}'))
    first = as_model(first_n_records(log(messages), 2, THREE, "id"))
    assert {key: r["a"] for key, r in first.items()} == {7: "old", 2: "old"}


def test_fields_sent_together_share_a_position(spark, log):
    """Whole groups, parts of groups and single fields, in any order, against the dictionary."""
    messages = random_messages(400, 40, 9)
    parsed = field_messages(log(messages).repartition(5), THREE, "id")
    fields = schema_fields(THREE, "id")
    expected = model(messages)
    for together in ([], [["a", "b"]], [["a", "b", "c"]], [["b", "c"], ["a"]]):
        merged = merge_fields(parsed, "id", fields, together=together)
        assert as_model(typed(merged, THREE)) == expected
        done = completions(parsed, "id", fields, together=together)
        assert {r.id for r in done.collect()} == set(expected)
        assert rows_of(done) == rows_of(completions(parsed, "id", fields))


def rows_of(df):
    return sorted(map(repr, df.collect()))


def test_state_has_a_position_for_a_message(spark):
    """Three states for the topics, and one for each field that comes without the others."""
    states = latest_states(schema_fields(), POSITION, sent_together())
    assert len(states) == 3 + 11


NOT_MESSAGES = [
    '{"id":1,"a":"x"} trailing', '{"id":1}{"id":2}', '{"id":1},', '{"id":1,}', '[{"id":1}]', "broken }", '{"id":1',
    '{"a":{"id":1}', '{"id":1} }', "null", "", " ", None, '{"peopleflow_end":7} {}', "{,}",
]
MESSAGES = [' {"id": 1 }\n', "{}", "{ }", '{"a":"}"}', '{"a":"x}{"}', '{"a":[{"b":{}}],"id":2}', '{"a":"\\"}"}', '{"x":null}']


@pytest.mark.parametrize("good, texts", [(False, NOT_MESSAGES), (True, MESSAGES)])
def test_one_rule_for_what_is_a_message(spark, good, texts):
    df = spark.createDataFrame([(x,) for x in texts], "value string")
    assert [r[0] for r in df.select(is_message("value")).collect()] == [good] * len(texts)
    parsed = df.select(field_texts("value", ["id"])).collect()
    assert [r[f"text_{END}"] is not None for r in parsed] == [good] * len(texts)


def test_ids_are_whole_numbers(spark, log):
    texts = ['{"id":3.0,"a":"1"}', '{"id":3,"b":"2"}', '{"id":3e0,"c":"3"}', '{"id":3.5,"a":"no"}', '{"id":"x","a":"no"}']
    texts += ['{"id":3,"a":"no"} trailing', '{"id":null,"a":"no"}']
    merged = merge_messages(log([(k, "t", x) for k, x in enumerate(texts)]), THREE, "id")
    assert [tuple(r) for r in merged.collect()] == [(3, "1", "2", "3")]


def growing(spark, path):
    """A log that is read anew, with all there is by then, in every job, like a topic."""

    def read(_):
        for file in sorted(Path(path).glob("*.parquet")):
            yield from pq.ParquetFile(file).iter_batches()

    schema = "topic string, partition int, offset bigint, second bigint, value string"
    rows = spark.range(0, 1, 1, 1).mapInArrow(read, schema)
    return rows.selectExpr("topic", "partition", "offset", "timestamp_seconds(second) AS timestamp", "value")


def append(path, number, messages, first=0):
    rows = [{"topic": t, "partition": 0, "offset": first + k, "second": s, "value": v} for k, (s, t, v) in enumerate(messages)]
    kinds = [("topic", pa.string()), ("partition", pa.int32()), ("offset", pa.int64()), ("second", pa.int64()), ("value", pa.string())]
    pq.write_table(pa.Table.from_pylist(rows, pa.schema(kinds)), f"{path}/{number}.parquet")


def test_what_arrives_between_the_passes_does_not_count(spark, tmp_path):
    full = '{{"id":{},"a":"{}","b":"1","c":"2"}}'
    append(tmp_path, 0, [(k, "t", full.format(k, "old")) for k in range(1, 6)])
    log = growing(spark, tmp_path)
    first = first_n_records(log, 3, THREE, "id")  # the first pass has run
    append(tmp_path, 1, [(0, "t", full.format(k, "late")) for k in (9, 1)] + [(0, "new", full.format(8, "late"))], first=5)
    assert {key: r["a"] for key, r in as_model(first).items()} == {1: "old", 2: "old", 3: "old"}
    ends = {(r.topic, r.last, r.messages) for r in log_ends(log).collect()}
    assert ends == {("t", 6, 7), ("new", 7, 1)}
    now = as_model(first_n_records(log, 3, THREE, "id"))
    assert set(now) == {8, 9, 1} and now[1]["a"] == "late"


def test_kafka_is_read_up_to_the_ends(spark):
    ends = spark.createDataFrame([("x", 0, 4, 5), ("x", 2, 7, 1), ("y", 0, 0, 1)], "topic string, partition int, last bigint, messages bigint")
    options = {k: json.loads(v) for k, v in pinned_options(ends).items()}
    assert options == {"assign": {"x": [0, 2], "y": [0]}, "endingOffsets": {"x": {"0": 5, "2": 8}, "y": {"0": 1}}}


def test_target_over_several_runs(spark, log, tmp_path):
    """Runs over a growing log give what one run over all of it gives."""
    messages = sorted(random_messages(500, 40, 11), key=lambda m: m[0])
    messages = [(k, t, v) for k, (_, t, v) in enumerate(messages)]
    whole = log(messages)
    cp = str(tmp_path / "cp")
    for size, n in ((120, 3), (300, 3), (300, 6), (500, 60), (500, 60)):
        got = as_model(resume_target(whole.where(F.col("offset") < size), cp, n, THREE, "id"))
        assert got == model(messages[:size], n), (size, n)
    assert len(versions.numbers(spark, cp, "run")) == 2


def test_a_run_that_broke_off_is_done_again(spark, log, tmp_path, monkeypatch):
    full = '{{"id":{},"a":"x","b":"1","c":"2"}}'
    messages = log([(k, "t", full.format(k)) for k in range(1, 9)])
    cp = str(tmp_path / "cp")
    assert set(as_model(resume_target(messages, cp, 2, THREE, "id"))) == {1, 2}
    with monkeypatch.context() as patched:
        patched.setattr(versions, "finish", None)
        with pytest.raises(TypeError):
            resume_target(messages, cp, 5, THREE, "id")
    assert versions.finished(spark, cp, "run") == [0]
    assert set(as_model(resume_target(messages, cp, 6, THREE, "id"))) == set(range(1, 7))


def test_late_messages_move_the_cut(spark, log, tmp_path):
    full = '{{"id":{},"a":"x","b":"1","c":"2"}}'
    messages = log([(10 * k, "t", full.format(k)) for k in range(1, 6)] + [(5, "t", full.format(9))])
    cp = str(tmp_path / "cp")
    assert set(as_model(resume_target(messages.where("offset < 5"), cp, 3, THREE, "id"))) == {1, 2, 3}
    assert set(as_model(resume_target(messages, cp, 3, THREE, "id"))) == {9, 1, 2}
    assert set(as_model(resume_target(messages, cp, 4, THREE, "id"))) == {9, 1, 2, 3}


def person(key: int, **changed) -> dict:
    body = {
        "id_persona": key, "nombre": "Ana", "apellido": "Lopez", "edad": 30, "genero": "F",
        "ciudad": "Leon", "estado": "Guanajuato", "ocupacion": "Chef",
        "nivel_estudios": "Primaria", "ingreso_mensual": 3000.5, "activo": True,
        "fecha_registro": "2024-02-29",
    }
    return {**body, **changed}


PARTS = {
    "personas": PEOPLE_COLUMNS[:7],
    "empleos": ["id_persona", *PEOPLE_COLUMNS[7:10]],
    "actividad": ["id_persona", *PEOPLE_COLUMNS[10:]],
}


def sent(second: int, topic: str, body: dict) -> tuple[int, str, str]:
    return second, topic, json.dumps({k: body[k] for k in PARTS[topic] if k in body})


def test_people_fixture(spark, log):
    messages = [sent(1, topic, person(key)) for key in (1, 3, 4, 5) for topic in PARTS]
    messages += [sent(1, "personas", person(2)), sent(1, "empleos", person(2))]
    messages += [sent(2, "personas", person(3, nombre="Rosa"))]
    messages += [(3, "empleos", '{"id_persona":4,"ocupacion":"Doctor"}')]
    messages += [(3, "personas", '{"id_persona":5,"ciudad":null}')]
    rows = {r[KEY]: r.asDict() for r in merge_messages(log(messages)).collect()}
    assert set(rows) == {1, 3, 4, 5}
    assert rows[3]["nombre"] == "Rosa" and rows[3]["apellido"] == "Lopez"
    assert rows[4]["ocupacion"] == "Doctor" and rows[4]["nivel_estudios"] == "Primaria"
    assert rows[5]["ciudad"] is None and rows[5]["estado"] == "Guanajuato"
    assert rows[1]["ingreso_mensual"] == 3000.5 and rows[1]["activo"] is True


def test_text_that_does_not_fit_is_null_in_that_field(spark, log):
    messages = [sent(1, topic, person(1, edad="x", fecha_registro="soon")) for topic in PARTS]
    row = merge_messages(log(messages)).first()
    assert (row.edad, row.fecha_registro, row.nombre) == (None, None, "Ana")


def test_join_keeps_ids_on_all_topics_with_the_last_message(spark, log):
    messages = [sent(1, topic, person(key)) for key in (1, 2) for topic in PARTS]
    messages += [sent(1, "personas", person(3)), sent(1, "empleos", person(3))]
    messages += [sent(5, "empleos", person(2, ocupacion="Doctor"))]
    rows = {r[KEY]: r.ocupacion for r in join_topics(log(messages)).collect()}
    assert rows == {1: "Chef", 2: "Doctor"}


def test_join_equals_merge_when_messages_are_whole(spark, tmp_path):
    people = generate_people(spark, 300)
    log = fanout(people, keep=[KEY]).selectExpr(
        "topic", "1 AS partition", f"{KEY} AS offset", "timestamp_seconds(1) AS timestamp", "value"
    )
    expected = sorted(map(tuple, people.collect()))
    assert sorted(map(tuple, join_topics(log).select(PEOPLE_COLUMNS).collect())) == expected
    assert sorted(map(tuple, merge_messages(log).collect())) == expected


def test_merge_shuffles_once_and_parses_once(spark, log, tmp_path):
    log([(1, "t", "{}")]).write.parquet(str(tmp_path / "log"))
    plan = plan_of(merge_messages(spark.read.parquet(str(tmp_path / "log"))))
    assert plan.count("Exchange") == 1
    assert plan.count("Generate json_tuple") == 1
    assert "from_json" not in plan and "Python" not in plan
    assert "partial_max" in plan


def test_topics_are_joined_in_one_shuffle(spark, log, tmp_path):
    log([(1, "personas", "{}")]).write.parquet(str(tmp_path / "log"))
    plan = plan_of(join_topics(spark.read.parquet(str(tmp_path / "log"))))
    assert (plan.count("Exchange"), plan.count("FileScan")) == (1, 1)
    assert "Join" not in plan and "In(topic" in plan


def test_cut_is_pushed_into_the_second_scan(spark, log, tmp_path):
    messages = random_messages(300, 40, 7)
    log(messages).write.parquet(str(tmp_path / "log"))
    first = first_n_records(spark.read.parquet(str(tmp_path / "log")), 5, THREE, "id")
    plan = first._jdf.queryExecution().executedPlan().toString()
    pushed = [line for line in plan.splitlines() if "value" in line and "PushedFilters" in line]
    assert "timestamp" in pushed[0].split("DataFilters")[1]
    formatted = first._sc._jvm.PythonSQLUtils.explainString(first._jdf.queryExecution(), "formatted")
    assert "LessThanOrEqual(timestamp,ScalarSubquery" in formatted
