"""The annual synthesis and the block export, assembled from finished indicators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortscope.operators.counts import top_per_group
from cohortscope.settings import BLOCKS, WOMEN, Settings

_VALUE_TYPE = "decimal(20,1)"
_BLOCK_COLUMNS = ("slide", "source_table", "dimension", "detail", "valeur", "valeur_2", "ecart", "rang")


def focus_share(region_distribution: DataFrame, focus_region: str) -> DataFrame:
    """The focus region's share of each year."""
    return region_distribution.where(F.col("region") == focus_region).select(
        "year_started", F.col("pct_of_year").alias("pct_idf")
    )


def annual_synthesis(
    headcount: DataFrame, ages: DataFrame, regions: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Headcount of each year with its leading region and band and the focus region's share.

    Every year stays; a tie for the lead gives one row per leader.
    """
    top_region = top_per_group(regions, 1).select(
        "year_started", F.col("region").alias("top_region"), F.col("pct_of_year").alias("pct_top_region")
    )
    top_age = top_per_group(ages, 1).select(
        "year_started", F.col("age_group").alias("top_age_group"), F.col("pct_of_year").alias("pct_top_age")
    )
    return (
        headcount.join(top_region, "year_started", "left")
        .join(focus_share(regions, settings.focus_region), "year_started", "left")
        .join(top_age, "year_started", "left")
        .select(
            *headcount.columns, "top_region", "pct_top_region", "pct_idf", "top_age_group", "pct_top_age"
        )
    )


def key_bands_line(comparison: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The key bands as one line: sums of their shares and the gap of the sums. Always one row."""
    observed, benchmark = F.sum("pct_oc"), F.sum("pct_insee")
    bands = (F.col("dimension") == "age") & F.col("detail").isin(*settings.key_bands)
    return comparison.where(bands).agg(
        F.lit("age").alias("dimension"),
        F.lit(settings.key_bands_label).alias("detail"),
        F.round(observed, 1).alias("pct_oc"),
        F.round(benchmark, 1).alias("pct_insee"),
        F.round(observed - benchmark, 1).alias("ecart_pts"),
    )


def headline_lines(comparison: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The women's and the focus region's line of the comparison."""
    dimension, detail = F.col("dimension"), F.col("detail")
    women = (dimension == "genre") & (detail == WOMEN)
    focus = (dimension == "region") & (detail == settings.focus_region)
    return comparison.where(women | focus).select("dimension", "detail", "pct_oc", "pct_insee", "ecart_pts")


def headline_synthesis(comparison: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The three lines of the conclusion: women, focus region, key bands."""
    return headline_lines(comparison, settings).unionByName(key_bands_line(comparison, settings))


def _block(
    df: DataFrame,
    name: str,
    dimension: Column | str,
    detail: Column | str | None,
    value: str,
    value_2: str | None = None,
    gap: str | None = None,
    group: str | None = None,
    order: tuple[str | None, str | None, str | None] = (None, None, None),
    rank: int | None = None,
) -> DataFrame:
    """One block in the common columns. Lines are numbered later, within `group`, by the three
    `order` columns: a year ascending, a share descending, a label ascending."""

    def column(source: str | None, kind: str) -> Column:
        return (F.lit(None) if source is None else F.col(source)).cast(kind)

    year, pct, label = order
    return df.select(
        F.lit(BLOCKS[name]).alias("slide"),
        F.lit(name).alias("source_table"),
        (F.lit(dimension) if isinstance(dimension, str) else dimension).cast("string").alias("dimension"),
        (detail if isinstance(detail, Column) else F.lit(detail)).cast("string").alias("detail"),
        column(value, _VALUE_TYPE).alias("valeur"),
        column(value_2, _VALUE_TYPE).alias("valeur_2"),
        column(gap, _VALUE_TYPE).alias("ecart"),
        column(group, "int").alias("_group"),
        column(year, "int").alias("_year"),
        column(pct, _VALUE_TYPE).alias("_share"),
        column(label, "string").alias("_label"),
        F.lit(rank).cast("bigint").alias("_rank"),
    )


def block_export(
    headcount: DataFrame,
    genders: DataFrame,
    ages: DataFrame,
    regions: DataFrame,
    comparison: DataFrame,
    settings: Settings = Settings(),
) -> DataFrame:
    """Seven tagged blocks in one table.

    All blocks are numbered by one window after the union, so they share a shuffle instead of
    each sorting in a single task. Equal shares are numbered by label.
    """
    dimension, year, detail = F.col("dimension"), F.col("year_started"), F.col("detail")
    focus = settings.focus_region
    shares = ("pct_oc", "pct_insee", "ecart_pts")
    synthesis = "S14_S16_comparaison_insee_synthese"
    blocks = [
        _block(headcount, "S08_effectifs_par_annee", year, None, "nb_students",
               order=("year_started", None, None)),
        _block(genders, "S09_parite_homme_femme", year, F.col("gender"), "nb_students", "pct_of_year",
               group="year_started", order=(None, None, "gender")),
        _block(comparison.where(dimension == "age"), "S10_distribution_age", "global", detail, *shares,
               order=(None, None, "detail")),
        _block(top_per_group(ages, settings.top_bands), "S11_evolution_age_top5", year,
               F.col("age_group"), "pct_of_year", order=("year_started", "pct_of_year", "age_group")),
        _block(comparison.where(dimension == "region"), "S12_repartition_geographique", "global", detail,
               *shares, order=(None, "pct_oc", "detail")),
        _block(focus_share(regions, focus), "S13_evolution_pct_idf", year, focus, "pct_idf",
               order=("year_started", None, None)),
        _block(headline_lines(comparison, settings), synthesis, dimension, detail, *shares,
               order=(None, None, "dimension")),
        _block(key_bands_line(comparison, settings), synthesis, dimension, detail, *shares, rank=3),
    ]
    numbered = Window.partitionBy("slide", "_group", "_rank").orderBy(
        F.col("_year").asc_nulls_last(), F.col("_share").desc_nulls_last(), F.col("_label").asc_nulls_last()
    )
    return (
        reduce(DataFrame.unionByName, blocks)
        .withColumn("rang", F.coalesce("_rank", F.row_number().over(numbered)).cast("bigint"))
        .select(*_BLOCK_COLUMNS)
    )


def block_counts(blocks: DataFrame) -> DataFrame:
    """Lines per block."""
    return blocks.groupBy("slide", "source_table").agg(F.count(F.lit(1)).alias("nb_lignes"))
