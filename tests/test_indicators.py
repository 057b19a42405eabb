from decimal import Decimal as D

import pytest
from helpers import rows, values
from pyspark.sql import functions as F

from cohortscope.operators import counts, indicators
from cohortscope.settings import BAND_MIDPOINTS, NON_RESPONSE


def enrol(n, start, age="25-29 ans", gender="M", region="DROM", year=2022):
    return [(f"u{start + i}", age, gender, region, year) for i in range(n)]


@pytest.fixture
def sample(students):
    return students(
        *enrol(5, 0, "30-34 ans", "M", "Île-de-France", 2022),
        *enrol(3, 5, "25-29 ans", "F", "DROM", 2022),
        *enrol(4, 8, "25-29 ans", NON_RESPONSE, "Corse", 2022),
        *enrol(2, 0, "60 ans ou plus", "F", "Île-de-France", 2023),
        *enrol(1, 2, "18-19 ans", "M", "DROM", 2023),
    )


def test_count_by_detail_equals_count_by_cells(sample):
    cells = counts.count_by(sample, *counts.CELL_KEYS)
    for keys in (("year_started",), ("year_started", "gender"), ("region",)):
        assert rows(counts.count_by(cells, *keys)) == rows(counts.count_by(sample, *keys))


def test_cells_cover_every_raw_row(raw_students):
    raw = raw_students(
        ("u1", "Data", " a ", "M", "r", 2022), ("u2", "Data", "a", " M", "r ", 2022),
        (None, "Data", "a", "M", "r", 2022), ("u3", "Data", None, None, None, None),
    )
    cells = counts.enrolment_cells(raw)
    assert {tuple(r) for r in cells.collect()} == {
        (True, None, NON_RESPONSE, None, None, 1), (False, 2022, "M", "a", "r", 1), (True, 2022, "M", "a", "r", 2)}
    assert counts.identified_cells(cells).agg(F.sum("nb_students")).first()[0] == 3


def test_students_by_year(sample):
    assert rows(indicators.students_by_year(sample)) == [
        (2022, 12, 12, 5, 3, 4, D("33.3"), D("37.5")),
        (2023, 3, 3, 1, 2, 0, D("0.0"), D("66.7")),
    ]


def test_distinct_users_and_repeated_keys(students):
    df = students(*enrol(3, 0), *enrol(1, 0), *enrol(2, 0, gender="F"), *enrol(2, 0, year=2023), *enrol(1, 7, year=None))
    assert rows(indicators.users_by_year(df)) == [(None, 1, 0), (2022, 3, 2), (2023, 2, 0)]
    assert rows(indicators.students_by_year(df), "year_started", "nb_students", "nb_students_distincts") == [
        (None, 1, 1), (2022, 6, 3), (2023, 2, 2)]


def test_headcount_of_cells_equals_headcount_of_rows(sample, students):
    for df in (sample, students(*enrol(3, 0), *enrol(2, 5, gender="m"), *enrol(1, 9, gender=None, year=None))):
        cells = counts.count_by(df, *counts.CELL_KEYS)
        headcount = indicators.headcount_of_cells(cells, indicators.users_by_year(df))
        assert headcount.columns == indicators.students_by_year(df).columns
        assert rows(headcount) == rows(indicators.students_by_year(df))


def test_year_without_respondents_has_null_share(students):
    df = students(*enrol(3, 0, gender=NON_RESPONSE))
    assert rows(indicators.students_by_year(df), "taux_non_reponse", "pct_female_among_declared") == [(D("100.0"), None)]
    assert rows(indicators.category_evolution(df)) == [(2022, NON_RESPONSE, 3, 3, D("100.0"), None)]


def test_category_evolution(sample):
    assert rows(indicators.category_evolution(sample)) == [
        (2022, "F", 3, 12, D("25.0"), D("37.5")),
        (2022, "M", 5, 12, D("41.7"), D("62.5")),
        (2022, NON_RESPONSE, 4, 12, D("33.3"), None),
        (2023, "F", 2, 3, D("66.7"), D("66.7")),
        (2023, "M", 1, 3, D("33.3"), D("33.3")),
    ]


def test_unlisted_gender_is_a_respondent_but_null_gender_is_not(students):
    df = students(*enrol(1, 0, gender="m"), *enrol(1, 1, gender=None), *enrol(2, 2, gender="F"))
    assert values(indicators.category_evolution(df), "gender", "pct_among_declared") == {
        "m": D("33.3"), None: None, "F": D("66.7")}


def test_age_distribution_with_rank_and_mean(sample):
    columns = ("year_started", "age_group", "nb_students", "total_year", "pct_of_year", "rang", "age_moyen_approx")
    assert rows(indicators.age_distribution(sample), *columns) == [
        (2022, "25-29 ans", 7, 12, D("58.3"), 1, D("29.1")),
        (2022, "30-34 ans", 5, 12, D("41.7"), 2, D("29.1")),
        (2023, "18-19 ans", 1, 3, D("33.3"), 2, D("65.0")),
        (2023, "60 ans ou plus", 2, 3, D("66.7"), 1, D("65.0")),
    ]


def test_banded_mean_alone_and_as_column_agree(sample):
    alone = values(counts.banded_mean(sample, BAND_MIDPOINTS), "year_started", "age_moyen_approx")
    column = values(indicators.age_distribution(sample), "year_started", "age_moyen_approx")
    assert alone == column == {2022: D("29.1"), 2023: D("65.0")}


def test_banded_mean_without_any_midpoint_is_null(students):
    assert rows(counts.banded_mean(students(*enrol(2, 0, age="?")), BAND_MIDPOINTS)) == [(2022, None)]


def test_region_distribution_zones(sample):
    found = rows(indicators.region_distribution(sample), "year_started", "region", "zone", "rang")
    assert found == [
        (2022, "Corse", "Province", 2), (2022, "DROM", "Province", 3), (2022, "Île-de-France", "IDF", 1),
        (2023, "DROM", "Province", 2), (2023, "Île-de-France", "IDF", 1),
    ]


def test_rows_without_year_leave_the_distributions_only(students):
    df = students(*enrol(2, 0), *enrol(3, 5, year=None))
    assert rows(indicators.age_distribution(df), "year_started") == [(2022,)]
    assert rows(indicators.region_distribution(df), "year_started") == [(2022,)]
    assert rows(indicators.category_evolution(df), "year_started", "nb_students") == [(None, 3), (2022, 2)]
    assert rows(indicators.students_by_year(df), "year_started", "nb_students") == [(None, 3), (2022, 2)]


def test_null_region_is_a_label_outside_the_focus_zone(students):
    df = students(*enrol(1, 0, region=None), *enrol(1, 1))
    assert rows(indicators.region_distribution(df), "region", "zone", "pct_of_year") == [
        (None, "Province", D("50.0")), ("DROM", "Province", D("50.0"))]


def test_ties_share_a_rank_and_leave_a_gap(students):
    df = students(*enrol(3, 0, region="a"), *enrol(3, 3, region="b"), *enrol(1, 6, region="c"))
    assert values(indicators.distribution(df, "region"), "region", "rang") == {"a": 1, "b": 1, "c": 3}


def test_a_tie_at_the_edge_of_the_top_k_is_kept_whole(students):
    sizes = (9, 8, 7, 6, 2, 2, 1)
    df = students(*[row for i, n in enumerate(sizes) for row in enrol(n, 100 * i, age=f"b{i}")])
    top = counts.top_per_group(indicators.distribution(df, "age_group"), 5)
    assert rows(top, "age_group") == [(f"b{i}",) for i in range(6)]


def test_share_of_grand_total(students):
    df = students(*enrol(1, 0, region="a"), *enrol(7, 1, region="b"))
    shares = counts.share_of_total(counts.count_by(df, "region"), within=())
    assert rows(shares) == [("a", 1, 8, D("12.5")), ("b", 7, 8, D("87.5"))]


def test_returning_users(students):
    df = students(*enrol(5, 0), *enrol(2, 0, year=2023), *enrol(1, 0, year=2024))
    assert rows(counts.returning_users(df)) == [(8, 5, 2)]
    assert rows(counts.returning_users(df.limit(0))) == [(0, 0, 0)]


def test_distinct_values(students):
    df = students(*enrol(2, 0), *enrol(1, 5, region=None, year=2023))
    assert rows(counts.distinct_values(df, ["region", "year_started"])) == [
        ("*", None, 3), ("region", None, 1), ("region", "DROM", 2),
        ("year_started", "2022", 2), ("year_started", "2023", 1)]


def test_one_user_with_a_third_of_all_rows_is_combined_before_the_shuffle(students):
    df = students(*(enrol(1, 0) * 500), *enrol(1000, 1)).repartition(4)
    users = indicators.users_by_year(df)
    assert rows(users) == [(2022, 1001, 1)]
    lines = users._jdf.queryExecution().executedPlan().toString().splitlines()
    shuffle = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line and "USER_ID" in line)
    assert "partial_count(1)" in lines[shuffle + 1]
