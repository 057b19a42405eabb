from decimal import Decimal as D

import pytest
from helpers import rows
from pyspark.sql import functions as F

from cohortscope.operators import compare, indicators, marts
from cohortscope.settings import NON_RESPONSE, Settings

SETTINGS = Settings()
FOCUS = SETTINGS.focus_region


def enrol(n, start, age="25-29 ans", gender="M", region="DROM", year=2022):
    return [(f"u{start + i}", age, gender, region, year) for i in range(n)]


def synthesis(df):
    return marts.annual_synthesis(
        indicators.students_by_year(df), indicators.age_distribution(df), indicators.region_distribution(df))


def test_synthesis_keeps_every_year_and_the_focus_share(students):
    df = students(*enrol(3, 0, region=FOCUS), *enrol(1, 3), *enrol(2, 0, age="30-34 ans", year=2023))
    columns = ("year_started", "nb_students", "top_region", "pct_top_region", "pct_idf", "top_age_group", "pct_top_age")
    assert rows(synthesis(df), *columns) == [
        (2022, 4, FOCUS, D("75.0"), D("75.0"), "25-29 ans", D("100.0")),
        (2023, 2, "DROM", D("100.0"), None, "30-34 ans", D("100.0")),
    ]


def test_tied_leaders_give_a_row_each(students):
    df = students(*enrol(2, 0, region="a"), *enrol(2, 2, region="b"), *enrol(1, 4, region="c"))
    assert rows(synthesis(df), "year_started", "nb_students", "top_region") == [(2022, 5, "a"), (2022, 5, "b")]


def test_a_row_without_year_stays_unmatched(students):
    found = rows(synthesis(students(*enrol(2, 0), *enrol(1, 5, year=None))), "year_started", "top_region", "pct_idf")
    assert found == [(None, None, None), (2022, "DROM", None)]


@pytest.fixture
def comparison(spark):
    return spark.createDataFrame([
        ("age", "25-29 ans", D("20.1"), D("6.3"), D("13.8"), None),
        ("age", "30-34 ans", D("25.2"), D("6.5"), D("18.7"), None),
        ("age", "35-39 ans", D("15.0"), None, None, None),
        ("age", "40-44 ans", D("9.0"), D("5.0"), D("4.0"), None),
        ("genre", "Femmes", D("31.1"), D("52.4"), D("-21.3"), None),
        ("region", FOCUS, D("45.6"), D("17.4"), D("28.2"), D("2.62")),
        ("region", "Corse", None, D("0.5"), None, None),
        ("region", "b", D("5.0"), D("9.0"), D("-4.0"), D("0.56")),
        ("region", "a", D("5.0"), D("9.0"), D("-4.0"), D("0.56")),
    ], "dimension string, detail string, pct_oc decimal(12,1), pct_insee decimal(12,1), ecart_pts decimal(12,1), ratio decimal(14,2)")


def test_headline_synthesis(comparison):
    assert rows(marts.headline_synthesis(comparison)) == [
        ("age", "25-39 ans", D("60.3"), D("12.8"), D("47.5")),
        ("genre", "Femmes", D("31.1"), D("52.4"), D("-21.3")),
        ("region", FOCUS, D("45.6"), D("17.4"), D("28.2")),
    ]


def test_the_key_bands_line_is_there_without_bands(comparison):
    none = comparison.where("dimension = 'region'")
    assert rows(marts.key_bands_line(none)) == [("age", "25-39 ans", None, None, None)]


@pytest.fixture
def blocks(students, comparison):
    df = students(
        *enrol(4, 0, "25-29 ans", "M", FOCUS, 2023), *enrol(3, 4, "30-34 ans", "F", "DROM", 2023),
        *enrol(3, 7, "20-24 ans", NON_RESPONSE, "DROM", 2023), *enrol(2, 10, "35-39 ans", "M", "DROM", 2023),
        *enrol(1, 12, "40-44 ans", "M", "DROM", 2023), *enrol(1, 13, "45-49 ans", "M", "DROM", 2023),
        *enrol(1, 0, "25-29 ans", "F", FOCUS, 2022),
    )
    return marts.block_export(
        indicators.students_by_year(df), indicators.category_evolution(df), indicators.age_distribution(df),
        indicators.region_distribution(df), comparison)


def block(blocks, slide):
    listed = blocks.where(F.col("slide") == slide).orderBy("dimension", "rang").collect()
    return [(r.dimension, r.detail, r.valeur, r.valeur_2, r.ecart, r.rang) for r in listed]


def test_block_columns(blocks):
    assert blocks.columns == ["slide", "source_table", "dimension", "detail", "valeur", "valeur_2", "ecart", "rang"]
    assert rows(marts.block_counts(blocks)) == sorted([
        (10, "S10_distribution_age", 4), (11, "S11_evolution_age_top5", 7), (12, "S12_repartition_geographique", 4),
        (13, "S13_evolution_pct_idf", 2), (14, "S14_S16_comparaison_insee_synthese", 3),
        (8, "S08_effectifs_par_annee", 2), (9, "S09_parite_homme_femme", 4)], key=str)


def test_headcount_blocks(blocks):
    assert block(blocks, 8) == [("2022", None, D("1.0"), None, None, 1), ("2023", None, D("14.0"), None, None, 2)]
    assert block(blocks, 9) == [
        ("2022", "F", D("1.0"), D("100.0"), None, 1),
        ("2023", "F", D("3.0"), D("21.4"), None, 1),
        ("2023", "M", D("8.0"), D("57.1"), None, 2),
        ("2023", NON_RESPONSE, D("3.0"), D("21.4"), None, 3),
    ]


def test_age_blocks_number_by_label_and_by_share(blocks):
    assert [(detail, rank) for _, detail, *_, rank in block(blocks, 10)] == [
        ("25-29 ans", 1), ("30-34 ans", 2), ("35-39 ans", 3), ("40-44 ans", 4)]
    # A tie at rank five keeps six bands of 2023; equal shares are numbered by label.
    assert [(year, detail, value, rank) for year, detail, value, _, _, rank in block(blocks, 11)] == [
        ("2022", "25-29 ans", D("100.0"), 1), ("2023", "25-29 ans", D("28.6"), 2), ("2023", "20-24 ans", D("21.4"), 3),
        ("2023", "30-34 ans", D("21.4"), 4), ("2023", "35-39 ans", D("14.3"), 5), ("2023", "40-44 ans", D("7.1"), 6),
        ("2023", "45-49 ans", D("7.1"), 7)]


def test_region_blocks_put_missing_shares_last(blocks):
    assert [(detail, rank) for _, detail, *_, rank in block(blocks, 12)] == [(FOCUS, 1), ("a", 2), ("b", 3), ("Corse", 4)]
    assert block(blocks, 13) == [
        ("2022", FOCUS, D("100.0"), None, None, 1), ("2023", FOCUS, D("28.6"), None, None, 2)]


def test_synthesis_block_order(blocks):
    assert sorted((rank, dimension, detail, value, second, gap) for dimension, detail, value, second, gap, rank in block(blocks, 14)) == [
        (1, "genre", "Femmes", D("31.1"), D("52.4"), D("-21.3")),
        (2, "region", FOCUS, D("45.6"), D("17.4"), D("28.2")),
        (3, "age", "25-39 ans", D("60.3"), D("12.8"), D("47.5")),
    ]


def test_blocks_are_numbered_in_one_shuffle(blocks):
    text = blocks._jdf.queryExecution().executedPlan().toString()
    assert "row_number()" in text
    assert "Window [row_number() windowspecdefinition(slide" in text


def test_comparison_feeds_the_blocks_with_its_own_names(students, population):
    mart = compare.comparison_mart(
        students(*enrol(1, 0, region=FOCUS, gender="F")), population((FOCUS, "Ensemble", "25-29 ans", 4, 2023)))
    assert rows(marts.headline_lines(mart), "detail", "pct_oc") == [("Femmes", D("100.0")), (FOCUS, D("100.0"))]
