"""Yearly indicators of the enrolments."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortscope.functions import share
from cohortscope.operators.counts import (
    COUNT,
    count_by,
    rank_within,
    share_of_total,
    with_banded_mean,
)
from cohortscope.settings import (
    BAND_MIDPOINTS,
    FEMALE,
    FOCUS_REGION,
    FOCUS_ZONE,
    MALE,
    NON_RESPONSE,
    OTHER_ZONE,
)


def _with_rates(headcount: DataFrame) -> DataFrame:
    """Add the non-response rate and the women's share among respondents."""
    female, male = F.col("nb_female"), F.col("nb_male")
    return headcount.select(
        "year_started", COUNT, "nb_students_distincts", "nb_male", "nb_female", "nb_nr",
        share(F.col("nb_nr"), F.col(COUNT)).alias("taux_non_reponse"),
        share(female, male + female).alias("pct_female_among_declared"),
    )


def students_by_year(students: DataFrame, non_response: str = NON_RESPONSE) -> DataFrame:
    """Rows, distinct users and genders per year in one scan; tasks combine a user's rows before
    the one shuffle by (year, user), so neither a year nor a user can be hot."""
    gender = F.col("gender")
    return _with_rates(students.groupBy("year_started").agg(
        F.count(F.lit(1)).alias(COUNT),
        F.count_distinct("USER_ID").alias("nb_students_distincts"),
        F.count_if(gender == MALE).alias("nb_male"),
        F.count_if(gender == FEMALE).alias("nb_female"),
        F.count_if(gender == non_response).alias("nb_nr"),
    ))


def users_by_year(students: DataFrame) -> DataFrame:
    """Distinct users of each year, and how many of them have several rows in it."""
    return (
        students.groupBy("year_started", "USER_ID").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("year_started")
        .agg(
            F.count("USER_ID").alias("nb_students_distincts"),
            F.count_if(F.col("n") > 1).alias("nb_repeated_keys"),
        )
    )


def headcount_of_cells(cells: DataFrame, users: DataFrame, non_response: str = NON_RESPONSE) -> DataFrame:
    """The yearly headcount from counted cells and `users_by_year`, where both are at hand: the
    shuffle of the users then carries no gender counts."""

    def of(gender: str) -> Column:
        counted = F.when(F.col("gender") == gender, F.col(COUNT)).otherwise(0)
        return F.sum(counted).cast("bigint")

    by_gender = cells.groupBy("year_started").agg(
        F.sum(COUNT).cast("bigint").alias(COUNT),
        of(MALE).alias("nb_male"),
        of(FEMALE).alias("nb_female"),
        of(non_response).alias("nb_nr"),
    )
    same_year = F.col("year_started").eqNullSafe(F.col("year"))
    return _with_rates(by_gender.join(users.withColumnRenamed("year_started", "year"), same_year))


def category_evolution(
    df: DataFrame, category: str = "gender", non_response: str = NON_RESPONSE
) -> DataFrame:
    """Each category's share of its year, and among respondents (null for non-response)."""
    answered = F.col(category) != non_response
    respondents = F.sum(F.when(answered, F.col(COUNT)).otherwise(0)).over(Window.partitionBy("year_started"))
    return share_of_total(count_by(df, "year_started", category)).withColumn(
        "pct_among_declared", F.when(answered, share(F.col(COUNT), respondents))
    )


def distribution(df: DataFrame, category: str) -> DataFrame:
    """Count, yearly total, share and rank of each label; rows without a year take no part."""
    counts = count_by(df.where(F.col("year_started").isNotNull()), "year_started", category)
    return rank_within(share_of_total(counts))


def age_distribution(df: DataFrame, midpoints: Mapping[str, int] = BAND_MIDPOINTS) -> DataFrame:
    """Age bands per year with the year's estimated mean age."""
    return with_banded_mean(distribution(df, "age_group"), midpoints)


def region_distribution(df: DataFrame, focus_region: str = FOCUS_REGION) -> DataFrame:
    """Regions per year, split into the focus region's zone and the rest."""
    zone = F.when(F.col("region") == focus_region, F.lit(FOCUS_ZONE)).otherwise(F.lit(OTHER_ZONE))
    return distribution(df, "region").select(
        "year_started", "region", COUNT, "total_year", "pct_of_year", zone.alias("zone"), "rang"
    )
