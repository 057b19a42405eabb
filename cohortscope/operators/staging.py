"""Cleaned enrolments and the harmonised population."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortscope.functions import blank_to, relabel
from cohortscope.settings import NON_RESPONSE, Settings


def standardise(students_raw: DataFrame, non_response: str = NON_RESPONSE) -> DataFrame:
    """Trim the three labels, name the missing gender, rename the year. Keeps every row."""
    return students_raw.select(
        "USER_ID",
        "PATH_CATEGORY_NAME",
        F.trim("AGE_GROUP").alias("age_group"),
        blank_to(F.col("GENDER"), non_response).alias("gender"),
        F.trim("REGION").alias("region"),
        F.col("YEAR_PATH_STARTED").alias("year_started"),
    )


def clean_enrolments(students_raw: DataFrame, non_response: str = NON_RESPONSE) -> DataFrame:
    """Standardised enrolments that carry an identifier."""
    return standardise(students_raw, non_response).where(F.col("USER_ID").isNotNull())


def harmonise_population(population_raw: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Population in enrolment labels, summed again because several labels become one.

    Unlisted regions pass through, unlisted sexes become null and unlisted bands are dropped; with a small mapping
    the last is a filter on the raw label, so it reaches the scan. Maps may also be tables (source, target).
    """
    rows = relabel(population_raw, "AGE_GROUP", settings.band_labels, "__age_group", drop_unknown=True)
    if settings.drop_regions:
        rows = rows.where(F.col("REGION").isNull() | ~F.col("REGION").isin(*settings.drop_regions))
    rows = relabel(rows, "REGION", settings.region_labels, "__region", keep_unknown=True)
    rows = relabel(rows, "SEXE", settings.sex_labels, "__sexe")
    return (
        rows.groupBy(
            F.col("__region").alias("region"), F.col("__sexe").alias("sexe"),
            F.col("__age_group").alias("age_group"), F.col("ANNEE").alias("annee"),
        )
        .agg(F.sum("POPULATION").cast("bigint").alias("population"))
        .select("region", "sexe", "age_group", "population", "annee")
    )
