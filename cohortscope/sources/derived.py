"""Raw inputs derived from the order tables, for tests and benchmarks (see FIXTURES.md).

Orders stand for enrolments (a customer's first order of a year) and line items for population
counts, so every query below grows with those tables.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cohortscope.schemas import WIDE_COLUMNS
from cohortscope.settings import (
    BOTH_SEXES,
    FOCUS_REGION,
    NATIONAL_TOTALS,
    POPULATION_BANDS,
    SEX_BLOCKS,
    Settings,
)

SETTINGS = Settings(years=tuple(range(1995, 2002)), benchmark_year=1997)

# Band of each of twenty customer classes, and region of each of the first population codes.
_STUDENT_BANDS = (
    ["20-24 ans"] * 2 + ["25-29 ans"] * 4 + ["30-34 ans"] * 5 + ["35-39 ans"] * 3 + ["40-44 ans"] * 2
    + ["45-49 ans", "50-54 ans", "55-59 ans", "60 ans ou plus"]
)
_POPULATION_REGIONS = (
    FOCUS_REGION, "Centre-Val-de-Loire", "Corse", "Guadeloupe", "Martinique", "Guyane",
    "La Réunion", "Mayotte", "DOM",
)


def _quoted(labels) -> str:
    return ", ".join(f"'{label}'" for label in labels)


def _at(labels, index: str) -> str:
    """SQL for the label at a zero-based index."""
    return f"element_at(array({_quoted(labels)}), CAST({index} AS INT) + 1)"


@cache
def _schema(spark: SparkSession, path: str) -> StructType:
    return spark.read.parquet(path).schema


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    return spark.read.schema(_schema(spark, path)).parquet(path)


_IDENTIFIED = "ck % 211 != 7"
_USER_ID = "'u' || ck"


def _as_students(rows: DataFrame, user_id: str) -> DataFrame:
    """Raw enrolment columns from customer key `ck`, nation key `nk` and year `y`."""
    return rows.selectExpr(
        f"{user_id} AS USER_ID",
        "'Data' AS PATH_CATEGORY_NAME",
        f"' ' || {_at(_STUDENT_BANDS, 'ck % 20')} || ' ' AS AGE_GROUP",
        """CASE WHEN (ck + y) % 10 >= 2001 - y THEN if(ck % 3 = 0, 'F ', ' M')
                WHEN ck % 2 = 1 THEN '  ' END AS GENDER""",
        f"""CASE WHEN nk % 19 IN (0, 2) THEN '{FOCUS_REGION}'
                 WHEN nk % 19 = 1 THEN 'Centre-Val de Loire'
                 WHEN nk % 19 <= 8 THEN 'DROM'
                 ELSE 'NATION_' || nk % 19 END AS REGION""",
        "y AS YEAR_PATH_STARTED",
    )


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").selectExpr("o_custkey AS ck", "year(o_orderdate) AS y")


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "customer").selectExpr("c_custkey AS ck", "c_nationkey AS nk")


def students_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct enrolments.

    Orders shrink to (customer, year) before the join, so a customer with very many orders sends
    only its years. With one row per customer, identified enrolments are distinct already; only
    those without identifier need another pass, which a reader that drops them never plans.
    """
    rows = _orders(spark, sf_dir).distinct().join(_customers(spark, sf_dir), "ck")
    anonymous = _as_students(rows.where(f"NOT ({_IDENTIFIED})"), "CAST(NULL AS STRING)").distinct()
    return _as_students(rows.where(_IDENTIFIED), _USER_ID).unionByName(anonymous)


def damaged_students(students: DataFrame) -> DataFrame:
    """Enrolments with faults of every kind that checks look for: missing regions, an unknown gender, years out of
    range, repeated rows, and in 1998 so many regions that rounded shares do not add up."""
    number = "CAST(substr(USER_ID, 2) AS INT)"
    faulty = students.selectExpr(
        "USER_ID", "PATH_CATEGORY_NAME", "AGE_GROUP",
        f"IF({number} % 11 = 0, 'X', GENDER) AS GENDER",
        f"CASE WHEN {number} % 7 = 0 THEN NULL WHEN YEAR_PATH_STARTED = 1998 THEN 'Zone ' || USER_ID ELSE REGION END AS REGION",
        f"IF({number} % 13 = 0, YEAR_PATH_STARTED + 100, YEAR_PATH_STARTED) AS YEAR_PATH_STARTED",
    )
    copies = F.sequence(F.lit(1), F.when(F.expr(f"{number} % 17 = 0"), 2).otherwise(1))
    return faulty.withColumn("_copy", F.explode(copies)).drop("_copy")


def enrolments_per_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User and year of every order, so a user can repeat within a year."""
    return (
        _orders(spark, sf_dir).where(f"ck IS NOT NULL AND {_IDENTIFIED}")
        .selectExpr(f"{_USER_ID} AS USER_ID", "y AS year_started")
    )


def population_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Population by region, sex, band and year, with the both-sexes rows.

    Line items are added up by supplier before the join, so a supplier with very many lines sends
    a few hundred sums, and by nation code after it. Labels and the both-sexes rows are made from
    the few thousand sums that are left.
    """
    lines = _table(spark, sf_dir, "lineitem").selectExpr(
        "l_suppkey AS sk",
        "l_partkey % 20 AS band",
        "l_linenumber % 2 AS odd",
        "year(l_shipdate) AS ANNEE",
        "CAST(l_quantity AS BIGINT) AS quantity",
    )
    suppliers = _table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS sk", "s_nationkey % 19 AS code")
    quantity = F.sum("quantity").alias("quantity")
    by_sex = (
        lines.groupBy("sk", "odd", "band", "ANNEE").agg(quantity)
        .join(suppliers, "sk")
        .groupBy("code", "odd", "band", "ANNEE").agg(quantity)
    )
    known = len(_POPULATION_REGIONS)
    return (
        by_sex.selectExpr(
            f"CASE WHEN code < {known} THEN {_at(_POPULATION_REGIONS, f'code % {known}')} "
            "ELSE 'NATION_' || code END AS REGION",
            f"explode(array(if(odd = 0, 'Femmes', 'Hommes'), '{BOTH_SEXES}')) AS SEXE",
            f"{_at(POPULATION_BANDS, 'band')} AS AGE_GROUP",
            "quantity",
            "ANNEE",
        )
        .groupBy("REGION", "SEXE", "AGE_GROUP", "ANNEE")
        .agg(F.sum("quantity").cast("bigint").alias("POPULATION"))
        .select("REGION", "SEXE", "AGE_GROUP", "POPULATION", "ANNEE")
    )


def population_wide(population: DataFrame) -> DataFrame:
    """Yearly sheets of the long population: one row per region, plus the rows that sheets carry
    around the data (five header lines, national totals, a blank region, notes), and their `line`. Cells are text with
    decimals, as a spreadsheet saves them; the fourth line holds a number.

    Each long row goes to all the sheet rows it adds to, so one aggregation makes the sheets.
    """
    heading = {name: "Total" for name in WIDE_COLUMNS}
    slots = []
    for sex, first in SEX_BLOCKS.items():
        total = first + len(POPULATION_BANDS)
        cell = f"'c' || ({first - 1} + array_position(array({_quoted(POPULATION_BANDS)}), AGE_GROUP))"
        slots.append(f"WHEN SEXE = '{sex}' THEN array({cell}, 'c{total}')")
        heading.update({f"c{first + i}": band for i, band in enumerate(POPULATION_BANDS)})

    header = ("Estimation de population", "Population au 1er janvier", "Territoire", "Édition", "Régions")
    notes = ("Source : état civil", "Champ : France", "Note : révisé")
    text_rows = (*header, *notes)
    entries = population.selectExpr(
        f"explode(array(REGION, {_quoted((*NATIONAL_TOTALS, '', *text_rows))})) AS region",
        f"CASE {' '.join(slots)} END AS slots", "POPULATION", "ANNEE AS year",
    ).selectExpr(
        "region", "year", "explode(slots) AS slot",
        f"if(region IN ({_quoted(text_rows)}), NULL, POPULATION) AS POPULATION",
    )
    sheets = entries.groupBy("region", "year").pivot("slot", WIDE_COLUMNS).agg(F.sum("POPULATION"))
    cells = [
        f"CASE region WHEN 'Régions' THEN '{heading[c]}' WHEN 'Édition' THEN '2023.5' ELSE {c} || '.7' END AS {c}"
        for c in WIDE_COLUMNS
    ]
    place = f"array_position(array({_quoted(header)}), region)"
    body = f"row_number() OVER (PARTITION BY year ORDER BY {place} > 0, region LIKE '% : %', region)"
    return sheets.selectExpr("region", *cells, "year", f"CAST(if({place} > 0, {place}, 5 + {body}) AS INT) AS line")
