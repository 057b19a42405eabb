"""Distinct users by bitmaps: yearly, overall and returning users from one shuffle of the users.

A task combines a user's rows before the shuffle, so a user is one row whatever the number of its enrolments. After
it every user gets a dense id, and each year is a set of bits, 32,768 users a row. Bitmaps of several years merge
by a bitwise or, so the distinct users of any set of years follow without another look at the enrolments.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

YEAR, RETURNING, UNCLEAR = "year", "returning", "unclear"


def user_bitmaps(students: DataFrame, years: Sequence[int]) -> DataFrame:
    """Bitmaps of the users by kind, year and bucket, with their rows and the users that have several rows.

    Kind `year` holds the users of a year, listed or not or missing; `returning` those with more than one row. Rows
    are counted by listed year in columns. A user with rows in several unlisted years is `unclear`: those rows show
    up under no year, and `counts.returning_users` and `indicators.users_by_year` must be used instead.
    """
    year = F.col("year_started")
    other = year.isNotNull() & ~year.isin(*years)
    users = students.where(F.col("USER_ID").isNotNull()).groupBy("USER_ID").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(year == y).alias(f"n_{i}") for i, y in enumerate(years)],
        F.count_if(year.isNull()).alias("n_null"),
        F.count_if(other).alias("n_other"),
        F.min(F.when(other, year)).alias("first_other"),
        F.max(F.when(other, year)).alias("last_other"),
    )
    several = F.col("first_other") < F.col("last_other")

    def entry(kind, of, n):
        kind = F.lit(kind) if isinstance(kind, str) else kind
        return F.struct(kind.alias("kind"), of.cast("int").alias("year_started"), n.alias("n"))

    entries = F.array(
        *[entry(YEAR, F.lit(y), F.col(f"n_{i}")) for i, y in enumerate(years)],
        entry(YEAR, F.lit(None), F.col("n_null")),
        entry(F.when(several, UNCLEAR).otherwise(YEAR), F.when(~several, F.col("first_other")), F.col("n_other")),
        entry(RETURNING, F.lit(None), F.when(F.col("n") > 1, F.col("n")).otherwise(0)),
    )
    numbered = users.select((F.monotonically_increasing_id() + 1).alias("id"), entries.alias("entries"))
    return (
        numbered.select("id", F.inline(F.filter("entries", lambda e: e["n"] > 0)))
        .groupBy("kind", "year_started", F.bitmap_bucket_number("id").alias("bucket"))
        .agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("users"),
            F.sum("n").alias("nb_rows"),
            F.count_if(F.col("n") > 1).alias("nb_repeated_keys"),
        )
    )


def by_year(bitmaps: DataFrame) -> DataFrame:
    """What `indicators.users_by_year` counts: distinct users of each year, and how many have several rows in it."""
    return bitmaps.where(F.col("kind") == YEAR).groupBy("year_started").agg(
        F.sum(F.bitmap_count("users")).alias("nb_students_distincts"),
        F.sum("nb_repeated_keys").alias("nb_repeated_keys"),
    )


def _merged(bitmaps: DataFrame) -> DataFrame:
    """Users in any row, by bucket."""
    return bitmaps.groupBy("bucket").agg(F.bitmap_or_agg("users").alias("users"))


def distinct_over(bitmaps: DataFrame, years: Sequence[int]) -> DataFrame:
    """The number of distinct users who enrolled in any of the years."""
    chosen = bitmaps.where((F.col("kind") == YEAR) & F.col("year_started").isin(*years))
    return _merged(chosen).agg(F.coalesce(F.sum(F.bitmap_count("users")), F.lit(0)).alias("nb_distincts"))


def returning(bitmaps: DataFrame) -> DataFrame:
    """What `counts.returning_users` counts: rows, distinct users and users with more than one row."""
    in_years = F.col("kind") == YEAR
    return (
        bitmaps.groupBy("bucket").agg(
            F.sum(F.when(in_years, F.col("nb_rows"))).alias("nb_rows"),
            F.bitmap_count(F.bitmap_or_agg(F.when(in_years, F.col("users")))).alias("n"),
            F.sum(F.when(F.col("kind") == RETURNING, F.bitmap_count("users"))).alias("n_returning"),
        )
        .agg(
            F.coalesce(F.sum("nb_rows"), F.lit(0)).cast("bigint").alias("total"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("nb_distincts"),
            F.coalesce(F.sum("n_returning"), F.lit(0)).alias("nb_reinscrits"),
        )
    )
