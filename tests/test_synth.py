from pyspark.sql import functions as F

from conftest import plan_of
from peopleflow import domains as d
from peopleflow.operators.synth import generate_people, people_of
from peopleflow.schemas import PEOPLE_SCHEMA


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_schema_and_ids(spark):
    people = generate_people(spark, 100)
    assert people.dtypes == [(f.name, f.dataType.simpleString()) for f in PEOPLE_SCHEMA]
    assert [r[0] for r in rows(people)] == list(range(1, 101))


def test_resume_gives_the_same_people(spark):
    glued = generate_people(spark, 40).unionByName(generate_people(spark, 100, last_id=40))
    assert rows(glued) == rows(generate_people(spark, 100))


def test_partitioning_does_not_matter(spark):
    ids = spark.range(1, 101).repartition(13)
    assert rows(people_of(ids, "id")) == rows(generate_people(spark, 100))


def test_seed_matters(spark):
    assert rows(generate_people(spark, 20, seed=1)) != rows(generate_people(spark, 20, seed=2))


def test_values_cover_their_domains(spark):
    people = generate_people(spark, 20_000)
    row = people.agg(
        F.min("edad"), F.max("edad"), F.min("ingreso_mensual"), F.max("ingreso_mensual"),
        F.countDistinct("nombre"), F.countDistinct("apellido"), F.countDistinct("ciudad", "estado"),
        F.countDistinct("ocupacion"), F.countDistinct("nivel_estudios"),
        F.min("fecha_registro").cast("string"), F.max("fecha_registro").cast("string"),
    ).first()
    assert (row[0], row[1]) == (18, 80)
    assert 3000 <= row[2] < 3100 and 79_900 < row[3] <= 80_000
    assert tuple(row[4:9]) == (36, 24, 16, 16, 6)
    assert (row[9], row[10]) == ("2024-01-01", "2026-06-01")


def test_names_follow_gender_and_city_its_state(spark):
    people = generate_people(spark, 5000)
    names = {(r.genero, r.nombre) for r in people.select("genero", "nombre").distinct().collect()}
    assert names == {("M", n) for n in d.MALE_NAMES} | {("F", n) for n in d.FEMALE_NAMES}
    places = {tuple(r) for r in people.select("ciudad", "estado").distinct().collect()}
    assert places == set(d.CITIES)


def test_generation_needs_no_shuffle(spark):
    plan = plan_of(generate_people(spark, 100))
    assert "Exchange" not in plan and "Python" not in plan
