from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from conftest import plan_of
from peopleflow.operators.reports import schema_report
from peopleflow.operators.synth import generate_people
from peopleflow.schemas import PEOPLE_COLUMNS
from peopleflow.sinks.exports import export_people
from peopleflow.sinks import exports
from peopleflow.sinks.files import export_sizes, rendered_bytes, write_csv, write_json
from peopleflow.sinks.sql_dump import insert_statements, literal_rows, sql_statements, write_sql
from peopleflow.sources.files import read_csv, read_json

NASTY = ["plain", "O'Hara", 'say "hi"', "a,b", " padded ", "back\\slash", "ñandú ✔", "null", "", None]


def nasty(spark):
    return spark.createDataFrame(list(enumerate(NASTY)), "id bigint, s string")


def text_of(folder: str) -> str:
    return "".join(p.read_text() for p in sorted(Path(folder).glob("part-*")))


@pytest.mark.parametrize("write, read, suffix", [(write_json, read_json, "json"), (write_csv, read_csv, "csv")])
def test_round_trip(spark, tmp_path, write, read, suffix):
    path = str(tmp_path / suffix)
    df = nasty(spark)
    write(df, path)
    assert sorted(read(spark, path, df.schema).collect()) == sorted(df.collect())


def test_csv_with_line_breaks(spark, tmp_path):
    path = str(tmp_path / "lines")
    df = spark.createDataFrame([(1, "two\nlines"), (2, "one")], "id bigint, s string")
    write_csv(df, path)
    assert sorted(read_csv(spark, path, df.schema, multiline=True).collect()) == sorted(df.collect())


def test_json_keeps_null_fields(spark, tmp_path):
    write_json(nasty(spark).where("s IS NULL"), str(tmp_path / "j"))
    assert text_of(tmp_path / "j") == '{"id":9,"s":null}\n'


def test_csv_form(spark, tmp_path):
    path = str(tmp_path / "people")
    write_csv(generate_people(spark, 1).coalesce(1), path)
    header, row = text_of(path).splitlines()
    assert header == ",".join(PEOPLE_COLUMNS)
    assert row.split(",")[10] in ("true", "false")


def test_inferred_schemas(spark, tmp_path):
    people = generate_people(spark, 20)
    write_json(people, str(tmp_path / "j"))
    write_csv(people, str(tmp_path / "c"))
    in_json = {r.column: r.type for r in schema_report(read_json(spark, str(tmp_path / "j"), None)).collect()}
    in_csv = {r.column: r.type for r in schema_report(read_csv(spark, str(tmp_path / "c"), None)).collect()}
    assert (in_json["edad"], in_json["fecha_registro"]) == ("bigint", "string")
    assert (in_csv["edad"], in_csv["fecha_registro"], in_csv["activo"]) == ("int", "date", "boolean")


def test_sql_literals(spark):
    df = spark.sql(
        """SELECT * FROM VALUES
        (1, true, 'O''Hara', 1.5D, DATE '2024-01-02', 7.10BD),
        (2, false, NULL, 1.0E7D, NULL, NULL),
        (3, NULL, '', 12345678.9D, NULL, 0BD),
        (4, true, 'x', double('NaN'), NULL, 1BD) AS t(id, b, s, d, day, dec)"""
    )
    values = {r.id: r.sql_values for r in literal_rows(df, "id").collect()}
    assert values == {
        1: "1, TRUE, 'O''Hara', 1.5, '2024-01-02', 7.10",
        2: "2, FALSE, NULL, 10000000.0, NULL, NULL",
        3: "3, NULL, '', 12345678.9, NULL, 0.00",
        4: "4, TRUE, 'x', 'NaN', NULL, 1.00",
    }


@pytest.mark.parametrize("rows, batches", [(0, []), (1, [1]), (500, [500]), (501, [500, 1]), (1000, [500, 500])])
def test_batch_sizes(spark, rows, batches):
    statements = sql_statements(generate_people(spark, rows)).orderBy("batch").collect()
    assert statements[0].statement.startswith("CREATE TABLE IF NOT EXISTS personas (\n    id_persona      INT PRIMARY KEY,\n")
    assert [s.n_rows for s in statements[1:]] == batches
    assert [s.batch for s in statements] == list(range(len(batches) + 1))
    assert [s.statement.count("\n    (") for s in statements[1:]] == batches


def test_dump_loads_into_a_database(spark, tmp_path):
    people = generate_people(spark, 1234)
    write_sql(people.repartition(7), str(tmp_path / "sql"))
    db = duckdb.connect()
    db.execute(text_of(tmp_path / "sql"))
    loaded = db.execute("SELECT id_persona, nombre, ingreso_mensual::DOUBLE, activo, fecha_registro FROM personas ORDER BY 1").fetchall()
    wanted = people.select("id_persona", "nombre", "ingreso_mensual", "activo", "fecha_registro")
    assert loaded == [tuple(r) for r in wanted.orderBy("id_persona").collect()]


def test_script_is_in_key_order(spark, tmp_path):
    write_sql(generate_people(spark, 1100).repartition(7), str(tmp_path / "sql"))
    lines = [x for x in text_of(tmp_path / "sql").splitlines() if x.startswith("    (")]
    assert [int(x.split(",")[0].strip(" (")) for x in lines] == list(range(1, 1101))


@pytest.mark.parametrize("rows, per_insert", [(0, 500), (1, 500), (500, 500), (1234, 500), (7, 1), (7, 3)])
def test_script_is_its_statements(spark, tmp_path, rows, per_insert):
    people = generate_people(spark, rows)
    write_sql(people, str(tmp_path / "sql"), rows_per_insert=per_insert)
    statements = sql_statements(people, rows_per_insert=per_insert).orderBy("batch").collect()
    assert text_of(tmp_path / "sql") == "".join(s.statement + "\n" for s in statements)
    for part in (tmp_path / "sql").glob("part-*"):
        assert not part.read_text() or part.read_text().endswith(";\n\n")


def test_statements_are_grouped_without_a_second_shuffle(spark):
    plan = plan_of(insert_statements(generate_people(spark, 10), "t"))
    assert plan.count("Exchange rangepartitioning") == 1
    assert plan.count("Exchange hashpartitioning(batch") == 0


def test_export_orders_rows_once(spark, tmp_path, monkeypatch):
    """One range shuffle for all three formats, no cache, and no shuffle between the formats."""
    ranged, plans = [], []
    frame = type(spark.range(1))
    by_range = frame.repartitionByRange
    monkeypatch.setattr(frame, "repartitionByRange", lambda df, *a: ranged.append(a) or by_range(df, *a))
    monkeypatch.setattr(frame, "persist", None)
    rows_of = exports.in_blocks
    monkeypatch.setattr(exports, "in_blocks", lambda *a: plans.append(rows_of(*a)) or plans[-1])
    people = generate_people(spark, 2600).repartition(7)
    export_people(people, str(tmp_path / "out"))
    assert len(ranged) == 1
    assert "Exchange" not in plan_of(plans[0]) and "Scan ExistingRDD" in plan_of(plans[0])
    for kind, first in (("json", '{"id_persona":'), ("csv", ""), ("sql", "    (")):
        lines = text_of(tmp_path / "out" / f"personas.{kind}").splitlines()
        ids = [line.removeprefix(first).split(",")[0] for line in lines]
        assert [int(x) for x in ids if x.isdigit()] == list(range(1, 2601))
    for part in (tmp_path / "out" / "personas.sql").glob("part-*"):
        assert part.read_text().endswith(";\n\n")


def test_rendered_bytes_equal_the_files(spark, tmp_path):
    df = nasty(spark).coalesce(1)
    write_json(df, str(tmp_path / "json"))
    write_csv(df, str(tmp_path / "csv"))
    sizes = {r.format: r.bytes for r in rendered_bytes(df).collect()}
    listed = {r.format: r.bytes for r in export_sizes(spark, {k: str(tmp_path / k) for k in ("json", "csv")}).collect()}
    assert sizes == {"json": listed["json"], "csv": listed["csv"] - len("id,s\n")}


def test_numbers_have_one_rendering(spark):
    values = [1.5e-4, -2.5e-10, 1e7, 12345678.9, 1e22, 123456789012345680.0, 5e-324, 0.001, -0.0, 3000.5]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "id bigint, v double")
    texts = [r.sql_values.split(", ")[1] for r in literal_rows(df, "id").orderBy("id").collect()]
    assert [float(x) for x in texts] == values and not any("E" in x for x in texts)
    assert texts[0] == "0.00015" and texts[3] == "12345678.9" and texts[5] == "123456789012345680.0"


def test_export_of_nothing_fails_before_writing(spark, tmp_path):
    with pytest.raises(ValueError):
        export_people(generate_people(spark, 0), str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()


def test_export_reports_the_sizes_on_disk(spark, tmp_path):
    report = export_people(generate_people(spark, 700), str(tmp_path / "out")).collect()
    for row in report:
        found = (tmp_path / "out" / f"personas.{row.format}").glob("part-*")
        parts = [p for p in found if p.stat().st_size]
        assert (row.files, row.bytes) == (len(parts), sum(p.stat().st_size for p in parts))
    assert {r.format for r in report} == {"json", "csv", "sql"}
    back = read_json(spark, str(tmp_path / "out" / "personas.json"))
    assert sorted(back.collect()) == sorted(generate_people(spark, 700).collect())
