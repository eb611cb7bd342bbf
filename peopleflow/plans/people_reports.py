"""Reports over the people table, shared by the jobs and the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peopleflow.operators import reports
from peopleflow.schemas import KEY

# The groups that the reports are about.
GRADUATE_LEVELS = ["Maestria", "Doctorado"]
TECH_OCCUPATIONS = ["Ingeniero", "Programador"]


def best_paid_graduates(people: DataFrame, top: int = 10) -> DataFrame:
    """Active people with a higher degree, best paid first."""
    shown = [KEY, "nombre", "apellido", "nivel_estudios", "ocupacion", "ingreso_mensual"]
    wanted = F.col("activo") & F.col("nivel_estudios").isin(GRADUATE_LEVELS)
    return reports.filtered_top(people, wanted, shown, [F.desc("ingreso_mensual"), KEY], top)


def pay_by_occupation_and_gender(people: DataFrame) -> DataFrame:
    """Head count and average income."""
    income = F.round(F.avg("ingreso_mensual"), 2)
    keys = ["ocupacion", "genero"]
    return reports.group_report(people, keys, n=F.count("*"), avg_ingreso_mensual=income)


def tech_cities(people: DataFrame, top: int = 5) -> DataFrame:
    """Where most people with a technical occupation live."""
    keys = ["ciudad", "estado"]
    wanted = F.col("ocupacion").isin(TECH_OCCUPATIONS)
    return reports.group_report(people, keys, wanted, [F.desc("n"), *keys], top, n=F.count("*"))
