"""Generated people: a row is a pure function of (seed, id)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from peopleflow import domains as d
from peopleflow.functions.picks import DRAWS_PER_DIGEST, choose, digest, draw
from peopleflow.schemas import KEY, PEOPLE_COLUMNS

# The draws of a person in order; ciudad decides estado, genero which names nombre is from.
DRAWN_FIELDS = [
    "genero", "nombre", "apellido", "ciudad", "ocupacion", "nivel_estudios", "edad",
    "ingreso_mensual", "activo", "fecha_registro",
]
_AGES = d.MAX_AGE - d.MIN_AGE + 1
_CENTS = d.MAX_INCOME_CENTS - d.MIN_INCOME_CENTS + 1

# Each column from the draws r_<field>.
FIELD_SQL = {
    "id_persona": KEY,
    "nombre": f"""CASE WHEN r_genero % 2 = {d.GENDERS.index("F")}
                  THEN {choose(d.FEMALE_NAMES, "r_nombre")}
                  ELSE {choose(d.MALE_NAMES, "r_nombre")} END""",
    "apellido": choose(d.SURNAMES, "r_apellido"),
    "edad": f"cast({d.MIN_AGE} + r_edad % {_AGES} AS int)",
    "genero": choose(d.GENDERS, "r_genero"),
    "ciudad": choose([city for city, _ in d.CITIES], "r_ciudad"),
    "estado": choose([state for _, state in d.CITIES], "r_ciudad"),
    "ocupacion": choose(d.OCCUPATIONS, "r_ocupacion"),
    "nivel_estudios": choose(d.EDUCATION, "r_nivel_estudios"),
    "ingreso_mensual": f"({d.MIN_INCOME_CENTS} + r_ingreso_mensual % {_CENTS}) / 100D",
    "activo": "r_activo % 2 = 0",
    "fecha_registro": f"date_add(DATE '{d.FIRST_DAY}', cast(r_fecha_registro % {d.DAYS} AS int))",
}


def people_of(ids: DataFrame, key: str = KEY, seed: int = 42) -> DataFrame:
    """One person per id, in the partition that holds the id; works on streams too."""
    n_digests = -(-len(DRAWN_FIELDS) // DRAWS_PER_DIGEST)
    digests = ids.selectExpr(
        f"cast({key} AS bigint) AS {KEY}",
        *[f"{digest(seed, i, key)} AS d{i}" for i in range(n_digests)],
    )
    draws = digests.selectExpr(
        KEY,
        *[
            f"{draw(f'd{i // DRAWS_PER_DIGEST}', i % DRAWS_PER_DIGEST)} AS r_{field}"
            for i, field in enumerate(DRAWN_FIELDS)
        ],
    )
    return draws.selectExpr(*[f"{FIELD_SQL[name]} AS {name}" for name in PEOPLE_COLUMNS])


def generate_people(
    spark: SparkSession, total: int, last_id: int = 0, seed: int = 42
) -> DataFrame:
    """People ``last_id + 1 .. total``: pass the last id already sent to resume after it."""
    return people_of(spark.range(last_id + 1, total + 1), "id", seed)
