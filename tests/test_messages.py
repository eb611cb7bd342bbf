from conftest import SF_DIR
from peopleflow.functions.json_text import is_message
from peopleflow.operators.messages import fanout, parse_messages
from peopleflow.operators.synth import generate_people
from peopleflow.schemas import TOPIC_FIELDS, topic_schema
from peopleflow.streaming.live import live_people_by_state

PERSON = topic_schema("personas")


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_malformed_text_is_a_row_of_nulls(spark):
    rows = parse_messages(texts(spark, "not json", None, "[1]"), PERSON).collect()
    assert [set(r) for r in rows] == [{None}] * 3


def test_a_bad_field_is_null_alone(spark):
    values = ['{"id_persona":2,"edad":5.7}', '{"id_persona":3,"edad":"x"}', '{"id_persona":4,"edad":9}']
    rows = parse_messages(texts(spark, *values), PERSON).collect()
    assert [(r.id_persona, r.edad) for r in rows] == [(2, None), (3, None), (4, 9)]


def test_drop_malformed_keeps_bad_fields(spark):
    values = ["not json", None, '{"id_persona":3,"edad":"x"}', "{}"]
    rows = parse_messages(texts(spark, *values), PERSON, drop_malformed=True).collect()
    assert [r.id_persona for r in rows] == [3, None]


def test_binary_values_are_decoded(spark):
    raw = texts(spark, '{"id_persona":1,"nombre":"José"}').selectExpr("CAST(value AS BINARY) value")
    assert parse_messages(raw, PERSON).first().nombre == "José"


def test_fanout_and_back(spark):
    people = generate_people(spark, 50)
    sent = fanout(people)
    assert sent.count() == 150
    for topic, fields in TOPIC_FIELDS.items():
        back = parse_messages(sent.where(f"topic = '{topic}'"), topic_schema(topic))
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, people.select(fields).collect()))


def test_fanout_writes_nulls(spark):
    people = generate_people(spark, 1).selectExpr("* EXCEPT (nombre)", "NULL AS nombre")
    value = fanout(people).where("topic = 'personas'").first().value
    assert '"nombre":null' in value


def test_live_report_counts_bad_messages_under_null(spark, log):
    messages = log(
        [
            (1, "personas", '{"id_persona":1,"edad":20,"estado":"CDMX"}'),
            (2, "personas", '{"id_persona":2,"edad":21,"estado":"CDMX"}'),
            (3, "personas", "not json"),
            (4, "empleos", '{"id_persona":2}'),
            (5, "personas", '{"id_persona":3,"edad":"x","estado":"Jalisco"}'),
        ]
    )
    rows = {r.estado: (r.n, r.avg_edad) for r in live_people_by_state(messages).collect()}
    assert rows == {"CDMX": (2, 20.5), None: (1, None), "Jalisco": (1, None)}
    kept = {r.estado for r in live_people_by_state(messages, drop_malformed=True).collect()}
    assert kept == {"CDMX", "Jalisco"}


def test_blanks_around_the_last_brace_do_not_matter(spark):
    good = ["{}", "{ }", "{\n}\r", '{"a":1}', '{"a":1 }', '{"a":1}\t ', '{"a":{}}', '{"a":{}\n}']
    bad = ["}", "", "{", "{}}", '{"a":1}}', '{"a":1} x', '{"a":1}{}', '{"a":1,}', "[{}]"]
    rows = texts(spark, *good, *bad, None).select("value", is_message("value").alias("whole")).collect()
    assert {r.value for r in rows if r.whole} == set(good)
