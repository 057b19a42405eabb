from helpers import plan, rows

from cohortscope.operators.staging import clean_enrolments, harmonise_population, standardise
from cohortscope.schemas import POPULATION_RAW
from cohortscope.settings import NON_RESPONSE, POPULATION_BANDS, Settings
from cohortscope.sources.shared import land


def test_clean_enrolments_trims_three_columns_and_drops_missing_ids(raw_students):
    raw = raw_students(
        (" u1 ", " Data ", " 20-24 ans", " M ", "DROM ", 2022),
        ("u2", "Data", "25-29 ans", "", "Corse", 2023),
        ("u3", "Data", "25-29 ans", None, None, None),
        (None, "Data", "25-29 ans", "F", "Corse", 2023),
    )
    assert rows(clean_enrolments(raw)) == sorted([
        (" u1 ", " Data ", "20-24 ans", "M", "DROM", 2022),
        ("u2", "Data", "25-29 ans", NON_RESPONSE, "Corse", 2023),
        ("u3", "Data", "25-29 ans", NON_RESPONSE, None, None),
    ])
    assert standardise(raw).count() == 4


def test_missing_ids_are_filtered_in_the_scan(spark, raw_students):
    raw = land(raw_students(("u1", "Data", "a", "M", "r", 2022)), "students")
    assert "PushedFilters: [IsNotNull(USER_ID)]" in plan(clean_enrolments(raw))[1]


def population_raw(spark, *entries):
    return spark.createDataFrame(list(entries), POPULATION_RAW)


def test_population_is_summed_after_mapping(spark):
    raw = population_raw(
        spark,
        ("Guadeloupe", "Femmes", "60 à 64 ans", 10, 2023),
        ("DOM", "Femmes", "95 ans et plus", 5, 2023),
        ("Centre-Val-de-Loire", "Hommes", "20 à 24 ans", 3, 2023),
        ("X", "Ensemble", "20 à 24 ans", 4, 2022),
    )
    assert rows(harmonise_population(raw)) == [
        ("Centre-Val de Loire", "M", "20-24 ans", 3, 2023),
        ("DROM", "F", "60 ans ou plus", 15, 2023),
        ("X", "Ensemble", "20-24 ans", 4, 2022),
    ]


def test_unknown_sex_forms_its_own_group_and_unknown_band_is_dropped(spark):
    raw = population_raw(
        spark,
        ("X", "Autre", "20 à 24 ans", 1, 2023),
        ("X", "?", "20 à 24 ans", 2, 2023),
        ("X", "Femmes", "0 à 4 ans", 4, 2023),
        ("X", "Femmes", None, 8, 2023),
        (None, "Femmes", "20 à 24 ans", 16, 2023),
    )
    assert rows(harmonise_population(raw)) == [
        (None, "F", "20-24 ans", 16, 2023),
        ("X", None, "20-24 ans", 3, 2023),
    ]


def test_a_subtotal_region_can_be_left_out(spark):
    raw = population_raw(
        spark,
        ("Mayotte", "Femmes", "20 à 24 ans", 1, 2023),
        ("DOM", "Femmes", "20 à 24 ans", 1, 2023),
        (None, "Femmes", "20 à 24 ans", 7, 2023),
    )
    kept = harmonise_population(raw, Settings(drop_regions=("DOM",)))
    assert rows(kept, "region", "population") == [(None, 7), ("DROM", 1)]


def test_full_cube_has_the_expected_grain(spark):
    regions = ["R%d" % i for i in range(12)] + ["Corse", "Guadeloupe", "Martinique", "Guyane", "La Réunion", "Mayotte", "DOM"]
    raw = population_raw(spark, *[
        (r, s, b, 1, y) for r in regions for s in ("Hommes", "Femmes", "Ensemble")
        for b in POPULATION_BANDS for y in (2022, 2023, 2024, 2025)
    ])
    assert raw.count() == 4560
    assert harmonise_population(raw).count() == 14 * 3 * 9 * 4


def test_band_filter_reaches_the_scan(spark):
    raw = land(population_raw(spark, ("X", "Femmes", "0 à 4 ans", 4, 2023)), "population")
    assert "In(AGE_GROUP, [20 à 24 ans" in plan(harmonise_population(raw))[1]
