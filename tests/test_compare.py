from decimal import Decimal as D

from helpers import plan, rows

from cohortscope.operators import compare, counts
from cohortscope.settings import NON_RESPONSE, Settings

SETTINGS = Settings()


def enrol(students, *groups):
    listed, n = [], 0
    for size, age, gender, region in groups:
        listed += [(f"u{n + i}", age, gender, region, 2022 + i % 4) for i in range(size)]
        n += size
    return students(*listed)


def people(population, *groups):
    """Men, women and both of each (region, band, men, women) in 2023, and noise in 2024."""
    listed = []
    for region, band, men, women in groups:
        listed += [(region, "M", band, men, 2023), (region, "F", band, women, 2023),
                   (region, "Ensemble", band, men + women, 2023), (region, "Ensemble", band, 999, 2024)]
    return population(*listed)


def test_comparison_keeps_one_sided_labels(students, population):
    enrolled = enrol(students, (6, "25-29 ans", "F", "Île-de-France"), (3, "25-29 ans", "M", "DROM"),
                     (1, "18 ans", NON_RESPONSE, "Ailleurs"))
    resident = people(population, ("Île-de-France", "25-29 ans", 10, 10), ("DROM", "30-34 ans", 30, 40), ("Corse", "25-29 ans", 5, 5))
    assert rows(compare.comparison_mart(enrolled, resident, SETTINGS)) == sorted([
        ("age", "18 ans", D("10.0"), None, None, None),
        ("age", "25-29 ans", D("90.0"), D("30.0"), D("60.0"), None),
        ("age", "30-34 ans", None, D("70.0"), None, None),
        ("genre", "Femmes", D("66.7"), D("55.0"), D("11.7"), None),
        ("region", "Ailleurs", D("10.0"), None, None, None),
        ("region", "Corse", None, D("10.0"), None, None),
        ("region", "DROM", D("30.0"), D("70.0"), D("-40.0"), D("0.43")),
        ("region", "Île-de-France", D("60.0"), D("20.0"), D("40.0"), D("3.00")),
    ])


def test_single_comparisons_agree_with_the_mart(students, population):
    enrolled = enrol(students, (6, "25-29 ans", "F", "a"), (3, "30-34 ans", "M", "b"), (5, "30-34 ans", NON_RESPONSE, "c"))
    resident = people(population, ("a", "25-29 ans", 11, 10), ("b", "30-34 ans", 30, 41), ("d", "35-39 ans", 5, 5))
    mart = compare.comparison_mart(enrolled, resident, SETTINGS)
    for dimension, key in (("region", "region"), ("age", "age_group")):
        alone = compare.compare_distributions(
            compare.global_share(enrolled, key), compare.benchmark_share(resident, key, 2023), [key])
        assert rows(alone, key, "pct_oc", "pct_insee", "ecart_pts") == rows(
            mart.where(f"dimension = '{dimension}'"), "detail", "pct_oc", "pct_insee", "ecart_pts")
    assert rows(compare.compare_share(enrolled, resident, 2023)) == rows(
        mart.where("dimension = 'genre'"), "pct_oc", "pct_insee", "ecart_pts")


def test_counts_behind_the_shares_are_kept(students, population):
    enrolled = enrol(students, (3, "25-29 ans", "F", "a"))
    resident = people(population, ("a", "25-29 ans", 1, 1))
    both = compare.compare_distributions(
        compare.global_share(enrolled, "region"), compare.benchmark_share(resident, "region", 2023), ["region"])
    assert both.columns == ["region", "nb_oc", "pct_oc", "pop_insee", "pct_insee", "ecart_pts", "ratio"]
    assert rows(both) == [("a", 3, D("100.0"), 2, D("100.0"), D("0.0"), D("1.00"))]


def test_null_labels_never_match(students, population):
    enrolled = enrol(students, (1, "25-29 ans", "F", None))
    resident = people(population, (None, "25-29 ans", 1, 1))
    mart = compare.comparison_mart(enrolled, resident, SETTINGS).where("dimension = 'region'")
    assert rows(mart, "detail", "pct_oc", "pct_insee") == [(None, None, D("100.0")), (None, D("100.0"), None)]


def test_women_are_a_share_of_the_both_sexes_total(students, population):
    enrolled = enrol(students, (1, "25-29 ans", "F", "a"))
    resident = population(("a", "F", "25-29 ans", 30, 2023), ("a", "M", "25-29 ans", 50, 2023), ("a", "Ensemble", "25-29 ans", 100, 2023))
    assert rows(compare.compare_share(enrolled, resident, 2023)) == [(D("100.0"), D("30.0"), D("70.0"))]


def test_the_womens_line_survives_empty_inputs(students, population):
    nobody, none = enrol(students, (1, "a", "F", "b")).limit(0), population(("a", "F", "b", 1, 2023)).limit(0)
    assert rows(compare.compare_share(nobody, none, 2023)) == [(None, None, None)]
    silent = enrol(students, (2, "25-29 ans", NON_RESPONSE, "a"))
    without_women = population(("a", "Ensemble", "25-29 ans", 10, 2023))
    assert rows(compare.compare_share(silent, without_women, 2023)) == [(None, None, None)]


def test_comparison_of_cells_equals_comparison_of_rows(students, population):
    enrolled = enrol(students, (6, "25-29 ans", "F", "a"), (3, "30-34 ans", "M", "b"))
    resident = people(population, ("a", "25-29 ans", 11, 10))
    cells = counts.count_by(enrolled, *counts.CELL_KEYS)
    assert rows(compare.comparison_mart(cells, resident)) == rows(compare.comparison_mart(enrolled, resident))


def test_each_side_is_scanned_once_and_nothing_is_cross_joined(students, population):
    enrolled = enrol(students, (6, "25-29 ans", "F", "a"))
    resident = people(population, ("a", "25-29 ans", 11, 10))
    physical = plan(compare.comparison_mart(enrolled, resident))[1]
    assert physical.count("Scan ExistingRDD") == 2
    assert "NestedLoop" not in physical and "Cartesian" not in physical
