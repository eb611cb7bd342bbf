from conftest import plan_of
from peopleflow.operators.monitor import first_messages, monitor_lines, raw_lines, topic_counters


def sample(log):
    return log(
        [
            (1, "personas", '{"id_persona":7,"nombre":"Ana","apellido":"Lopez","edad":30,"ciudad":"Leon","estado":"Guanajuato"}'),
            (2, "empleos", '{"id_persona":7,"ocupacion":"Chef","nivel_estudios":"Primaria","ingreso_mensual":12345.5}'),
            (3, "actividad", '{"id_persona":7,"activo":true,"fecha_registro":"2024-01-02"}'),
            (4, "actividad", '{"id_persona":1234567}'),
            (5, "empleos", "{}"),
            (6, "otros", '{"x": 1}'),
            (7, "personas", "broken"),
            (8, "empleos", None),
            (9, "actividad", '["no", "object"]'),
        ]
    )


def test_lines(spark, log):
    lines = {r.offset: r.line for r in monitor_lines(sample(log), 0).collect()}
    assert lines == {
        0: "[personas ] p0/o0      id=7      | Ana Lopez        | 30 años | Leon, Guanajuato",
        1: "[empleos  ] p0/o1      id=7      | Chef           | Primaria     | $12,345.50",
        2: "[actividad] p0/o2      id=7      | ✔ Activo   | Registro: 2024-01-02",
        3: "[actividad] p0/o3      id=1234567 | ✘ Inactivo | Registro: ",
        4: "[empleos  ] p0/o4      id=?      |                |              | $0.00",
        5: '[otros    ] p0/o5      {"x": 1}',
        6: "[personas ] p0/o6      broken",
        7: "[empleos  ] p0/o7      null",
        8: '[actividad] p0/o8      ["no", "object"]',
    }


def test_limit_takes_the_first_in_arrival_order(spark, log):
    assert [r.offset for r in monitor_lines(sample(log), 2).collect()] == [0, 1]
    assert first_messages(sample(log), 0).count() == 9


def test_raw_lines(spark, log):
    lines = [r.line for r in raw_lines(sample(log), 8).collect()]
    assert lines[5] == '[     otros] {"x": 1}'
    assert lines[7] == "[   empleos] null"
    assert lines[2].startswith('[ actividad] {"id_persona":7')


def test_counters(spark, log):
    rows = {r.topic: (r.messages, r.malformed, r.total) for r in topic_counters(sample(log), value="value").collect()}
    assert rows == {"personas": (2, 1, 9), "empleos": (3, 1, 9), "actividad": (3, 1, 9), "otros": (1, 0, 9)}
    assert "Window" not in plan_of(topic_counters(sample(log)))
