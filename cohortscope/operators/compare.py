"""Enrolment profile against the reference population.

The enrolment side covers all years, the population side one benchmark year. Output names ending
in `_oc` are the enrolments, those ending in `_insee` the population.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortscope.functions import gap, ratio, share
from cohortscope.operators.counts import COUNT, count_by, share_of_total
from cohortscope.settings import BOTH_SEXES, FEMALE, MALE, WOMEN, Settings

KEYS = ("dimension", "detail")


def global_share(df: DataFrame, key: str) -> DataFrame:
    """Share of each label in all enrolments."""
    counts = count_by(df, key).withColumnRenamed(COUNT, "nb_oc")
    return share_of_total(counts, (), "nb_oc", total="total_oc", pct="pct_oc").drop("total_oc")


def _benchmark_rows(population: DataFrame, year: int) -> DataFrame:
    return population.where(F.col("annee") == year)


def benchmark_share(population: DataFrame, key: str, year: int) -> DataFrame:
    """Share of each label in the benchmark year's population of both sexes."""
    sums = (
        _benchmark_rows(population, year)
        .where(F.col("sexe") == BOTH_SEXES)
        .groupBy(key)
        .agg(F.sum("population").cast("bigint").alias("pop_insee"))
    )
    return share_of_total(sums, (), "pop_insee", total="total_insee", pct="pct_insee").drop("total_insee")


def compare_distributions(observed: DataFrame, benchmark: DataFrame, on: Sequence[str]) -> DataFrame:
    """Full outer match of two share frames: gap in points and ratio, null for a one-sided label.

    The sides are joined on plain equality, so a null label stays unmatched on both.
    """
    o, b = observed.alias("o"), benchmark.alias("b")
    condition = [F.col(f"o.{key}") == F.col(f"b.{key}") for key in on]
    values = [f"o.{c}" for c in observed.columns if c not in on]
    values += [f"b.{c}" for c in benchmark.columns if c not in on]
    return o.join(b, condition, "full_outer").select(
        *[F.coalesce(f"o.{key}", f"b.{key}").alias(key) for key in on],
        *values,
        gap(F.col("o.pct_oc"), F.col("b.pct_insee")).alias("ecart_pts"),
        ratio(F.col("o.pct_oc"), F.col("b.pct_insee")).alias("ratio"),
    )


def _entry(dimension: str, detail: Column | str, part: Column, whole: Column) -> Column:
    detail = F.lit(detail) if isinstance(detail, str) else detail
    return F.struct(
        F.lit(dimension).alias("dimension"),
        detail.cast("string").alias("detail"),
        part.cast("bigint").alias("part"),
        whole.cast("bigint").alias("whole"),
    )


def _profile(entries: DataFrame, part: str, pct: str) -> DataFrame:
    """Shares of all dimensions at once: parts by label over the wholes of the dimension."""
    sums = entries.groupBy(*KEYS).agg(
        F.sum("part").cast("bigint").alias(part), F.sum("whole").cast("bigint").alias("whole")
    )
    return share_of_total(sums, ("dimension",), part, base="whole", total="total", pct=pct).drop("whole", "total")


def observed_profile(df: DataFrame) -> DataFrame:
    """Enrolment shares by region and age band, and women among respondents.

    Enrolments are counted by the three labels together, then each counted row goes to its
    dimensions, so the detail rows are scanned once for all of them.
    """
    n, gender = F.col(COUNT), F.col("gender")
    women = _entry(
        "genre", WOMEN,
        F.when(gender == FEMALE, n).otherwise(0),
        F.when(gender.isin(MALE, FEMALE), n).otherwise(0),
    )
    entries = count_by(df, "region", "age_group", "gender").select(
        F.inline(F.array(_entry("region", F.col("region"), n, n), women, _entry("age", F.col("age_group"), n, n)))
    )
    # The women's line is there even without any enrolment.
    no_women = df.sparkSession.range(0, 1, 1, 1).select(F.inline(F.array(_entry("genre", WOMEN, F.lit(0), F.lit(0)))))
    return _profile(entries.unionByName(no_women), "nb_oc", "pct_oc")


def benchmark_profile(population: DataFrame, year: int) -> DataFrame:
    """The same shares in the benchmark year's population; women are a share of both sexes."""
    n, sex = F.col("population"), F.col("sexe")
    both, female = sex == BOTH_SEXES, sex == FEMALE
    women = _entry("genre", WOMEN, F.when(female, n), F.when(both, n))
    region = _entry("region", F.col("region"), n, n)
    age = _entry("age", F.col("age_group"), n, n)
    entries = _benchmark_rows(population, year).select(
        F.inline(F.when(both, F.array(region, women, age)).when(female, F.array(women)))
    )
    return _profile(entries, "pop_insee", "pct_insee")


def comparison(df: DataFrame, population: DataFrame, year: int) -> DataFrame:
    """All three dimensions side by side, with the counts behind the shares."""
    return compare_distributions(observed_profile(df), benchmark_profile(population, year), KEYS)


def compare_share(df: DataFrame, population: DataFrame, year: int) -> DataFrame:
    """The women's line alone: share among respondents against share of the population.

    Each side is one aggregate over the columns it needs, and the two lines meet on a constant key.
    """

    def of(measure: str, condition: Column) -> Column:
        return F.sum(F.when(condition, F.col(measure))).cast("bigint")

    gender, sex = F.col("gender"), F.col("sexe")
    observed = count_by(df, "gender").agg(
        of(COUNT, gender == FEMALE).alias("part"), of(COUNT, gender.isin(MALE, FEMALE)).alias("whole")
    ).select(F.lit(1).alias("line"), share(F.coalesce("part", F.lit(0)), F.col("whole")).alias("pct_f_oc"))
    benchmark = _benchmark_rows(population, year).agg(
        of("population", sex == FEMALE).alias("part"), of("population", sex == BOTH_SEXES).alias("whole")
    ).select(F.lit(1).alias("line"), share(F.col("part"), F.col("whole")).alias("pct_f_insee"))
    return observed.join(benchmark, "line").select(
        "pct_f_oc", "pct_f_insee", gap(F.col("pct_f_oc"), F.col("pct_f_insee")).alias("ecart_pts"))


def comparison_mart(df: DataFrame, population: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Dimension, label, both shares, gap, and the ratio of regions."""
    return comparison(df, population, settings.benchmark_year).select(
        *KEYS, "pct_oc", "pct_insee", "ecart_pts",
        F.when(F.col("dimension") == "region", F.col("ratio")).alias("ratio"),
    )
