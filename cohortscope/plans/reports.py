"""The verification reports: small ordered results that a user reads after a build."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortscope.operators import counts, marts
from cohortscope.plans.build import Models
from cohortscope.settings import FEMALE, Settings


def _by_year(report: DataFrame, *then: Column) -> DataFrame:
    return report.orderBy(F.asc_nulls_last("year_started"), *then)


def gender_counts(students: DataFrame) -> DataFrame:
    """Rows per gender, most frequent first."""
    return (
        counts.count_by(students, "gender").withColumnRenamed(counts.COUNT, "nb")
        .orderBy(F.col("nb").desc())
    )


def headcounts(headcount: DataFrame) -> DataFrame:
    return _by_year(headcount.select("year_started", "nb_students", "nb_students_distincts"))


def gender_shares(genders: DataFrame) -> DataFrame:
    return _by_year(genders.select("year_started", "gender", "pct_of_year"), F.asc_nulls_last("gender"))


def female_share(genders: DataFrame) -> DataFrame:
    """Women among respondents, by year."""
    women = genders.where(F.col("gender") == FEMALE)
    return _by_year(women.select("year_started", "pct_among_declared"))


def age_comparison(comparison: DataFrame) -> DataFrame:
    return (
        comparison.where(F.col("dimension") == "age")
        .select(F.col("detail").alias("age_group"), "pct_oc", "pct_insee", "ecart_pts")
        .orderBy(F.col("pct_oc").desc_nulls_first())
    )


def top_bands(ages: DataFrame, k: int) -> DataFrame:
    """The leading bands of each year by share."""
    top = counts.top_per_group(ages, k).select("year_started", "age_group", "pct_of_year")
    return _by_year(top, F.desc_nulls_first("pct_of_year"))


def region_comparison(comparison: DataFrame) -> DataFrame:
    """Regions by enrolment share; those without enrolments last."""
    return (
        comparison.where(F.col("dimension") == "region")
        .select(F.col("detail").alias("region"), "pct_oc", "pct_insee", "ecart_pts", "ratio")
        .orderBy(F.col("pct_oc").desc_nulls_last())
    )


def block_counts(blocks: DataFrame) -> DataFrame:
    return marts.block_counts(blocks).orderBy("slide")


def reports(models: Models, settings: Settings = Settings()) -> dict[str, DataFrame]:
    """Every report of a finished build by name. All read small tables."""
    genders, regions = models["gender_evolution"], models["region_distribution"]
    comparison, focus = models["comparison_mart"], settings.focus_region
    return {
        "returning_users": models["returning_users"],
        "gender_counts": gender_counts(models["cells"]),
        "headcounts": headcounts(models["students_by_year"]),
        "gender_shares": gender_shares(genders),
        "female_share": female_share(genders),
        "age_comparison": age_comparison(comparison),
        "top_bands": top_bands(models["age_distribution"], settings.top_bands),
        "region_comparison": region_comparison(comparison),
        "focus_share": _by_year(marts.focus_share(regions, focus)),
        "headline_synthesis": marts.headline_synthesis(comparison, settings),
        "block_counts": block_counts(models["block_export"]),
    }
