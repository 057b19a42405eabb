"""Counting rows by label, and what follows from counts: shares, ranks, means, top k.

Every window below runs over counted rows (one per year and label), never over raw rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortscope.functions import COUNT_TYPE, SHARE_TYPE, recode, share
from cohortscope.operators.staging import standardise
from cohortscope.settings import NON_RESPONSE

COUNT = "nb_students"
CELL_KEYS = ("year_started", "gender", "age_group", "region")


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per key. A frame that is already counted is summed, so detail and cells both work."""
    measure = F.sum(COUNT) if COUNT in df.columns else F.count(F.lit(1))
    return df.groupBy(*keys).agg(measure.cast("bigint").alias(COUNT))


def enrolment_cells(students_raw: DataFrame, non_response: str = NON_RESPONSE) -> DataFrame:
    """Raw enrolments counted by every label at once, with and without identifier.

    One scan and one small shuffle: tasks send at most one row per label combination. All
    indicators but the distinct count, and the null and label checks, sum over these cells.
    """
    rows = standardise(students_raw, non_response)
    return count_by(rows.withColumn("identified", F.col("USER_ID").isNotNull()), "identified", *CELL_KEYS)


def population_cells(population_raw: DataFrame) -> DataFrame:
    """Raw population added up by every label, rows without a number apart, with the number of rows in `nb_rows`.

    The null checks and the harmonised population both follow from it, so the raw rows are read once.
    """
    keys = ("REGION", "SEXE", "AGE_GROUP", "ANNEE")
    return (
        population_raw.groupBy(*keys, F.col("POPULATION").isNull().alias("unknown"))
        .agg(F.sum("POPULATION").cast("bigint").alias("POPULATION"), F.count(F.lit(1)).alias("nb_rows"))
        .select("REGION", "SEXE", "AGE_GROUP", "POPULATION", "ANNEE", "nb_rows")
    )


def identified_cells(cells: DataFrame) -> DataFrame:
    """Cells of the cleaned enrolments."""
    return cells.where("identified").drop("identified")


def share_of_total(
    counts: DataFrame,
    within: Sequence[str] = ("year_started",),
    measure: str = COUNT,
    base: str | None = None,
    total: str = "total_year",
    pct: str = "pct_of_year",
) -> DataFrame:
    """Add the total of `base` (default: the measure) within the keys, and the measure's share.

    Without keys the total is over the whole frame. It is then a subquery that adds up the tasks'
    sums and reads the frame's own shuffle again, where a window would move all rows to one task.
    """
    base = F.sum(base or measure)
    whole = base.over(Window.partitionBy(*within)) if within else counts.agg(base).scalar()
    return counts.withColumn(total, whole).withColumn(pct, share(F.col(measure), F.col(total)))


def rank_within(
    counts: DataFrame, within: Sequence[str] = ("year_started",), measure: str = COUNT, rank: str = "rang"
) -> DataFrame:
    """Rank by descending measure within the keys; ties share a rank and leave a gap."""
    window = Window.partitionBy(*within).orderBy(F.col(measure).desc_nulls_first())
    return counts.withColumn(rank, F.rank().over(window).cast("bigint"))


def top_per_group(ranked: DataFrame, k: int, rank: str = "rang") -> DataFrame:
    """Rows ranked k or better; ties at the edge are all kept."""
    return ranked.where(F.col(rank) <= k)


def _mean(weighted: Column, weight: Column) -> Column:
    mean = weighted.cast(COUNT_TYPE) / F.nullif(weight.cast(COUNT_TYPE), F.lit(0))
    return F.round(mean, 1).cast(SHARE_TYPE)


def _midpoint_sums(band: str, midpoints: Mapping[str, int]) -> tuple[Column, Column]:
    midpoint = recode(F.col(band), midpoints)
    return F.sum(midpoint * F.col(COUNT)), F.sum(F.when(midpoint.isNotNull(), F.col(COUNT)))


def banded_mean(
    df: DataFrame, midpoints: Mapping[str, int], by: str = "year_started",
    band: str = "age_group", mean: str = "age_moyen_approx",
) -> DataFrame:
    """Mean of band midpoints per key to one decimal; bands without midpoint are left out."""
    weighted, weight = _midpoint_sums(band, midpoints)
    return count_by(df, by, band).groupBy(by).agg(_mean(weighted, weight).alias(mean))


def with_banded_mean(
    counts: DataFrame, midpoints: Mapping[str, int], within: Sequence[str] = ("year_started",),
    band: str = "age_group", mean: str = "age_moyen_approx",
) -> DataFrame:
    """The banded mean of each group as a column of its counted rows."""
    window = Window.partitionBy(*within)
    weighted, weight = _midpoint_sums(band, midpoints)
    return counts.withColumn(mean, _mean(weighted.over(window), weight.over(window)))


def returning_users(df: DataFrame) -> DataFrame:
    """Total rows, distinct users and users with more than one row, in one pass over the users."""
    return (
        df.groupBy("USER_ID").agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total"),
            F.count("USER_ID").alias("nb_distincts"),
            F.count_if(F.col("n") > 1).alias("nb_reinscrits"),
        )
    )


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per distinct value of each column, and the row count of the frame (attribute '*')."""
    pairs = [F.struct(F.lit(c).alias("attribute"), F.col(c).cast("string").alias("value")) for c in columns]
    overall = F.struct(F.lit("*").alias("attribute"), F.lit(None).cast("string").alias("value"))
    return (
        df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
        .select("n", F.inline(F.array(overall, *pairs)))
        .groupBy("attribute", "value")
        .agg(F.sum("n").alias("nb_rows"))
    )
