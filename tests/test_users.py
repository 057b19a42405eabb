"""Distinct users by bitmaps against exact distinct counts."""

import random

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from cohortscope.operators import counts, indicators, users
from cohortscope.operators.staging import clean_enrolments
from cohortscope.plans import build
from cohortscope.sources import derived
from cohortscope.sources.shared import land

YEARS = (2022, 2023, 2024)


@pytest.fixture
def random_students(students):
    rng = random.Random(4)
    listed = [(f"u{rng.randrange(150)}", "a", "M", "r", rng.choice([*YEARS, 2022, None])) for _ in range(400)]
    listed += [("hot", "a", "M", "r", 2023)] * 300 + [("once", "a", "F", "r", 2040), ("twice", "a", "F", "r", 2040)] * 1
    return students(*listed, ("twice", "a", "F", "r", 2040), (None, "a", "M", "r", 2022))


def test_three_figures_equal_exact_counts(random_students):
    staged = random_students.where("USER_ID IS NOT NULL")
    bitmaps = land(users.user_bitmaps(staged, YEARS).repartition(3), "bitmaps")
    assert rows(users.by_year(bitmaps)) == rows(indicators.users_by_year(staged))
    assert rows(users.returning(bitmaps)) == rows(counts.returning_users(staged))
    for years in ([2022], [2022, 2024], list(YEARS), [2040], [1990]):
        exact = staged.where(F.col("year_started").isin(years)).agg(F.count_distinct("USER_ID")).first()[0]
        assert users.distinct_over(bitmaps, years).first()[0] == exact


def test_more_users_than_a_bitmap_holds(spark):
    staged = spark.range(100_000).selectExpr("concat('u', id % 70000) AS USER_ID", "CAST(2022 + id % 3 AS INT) AS year_started")
    bitmaps = land(users.user_bitmaps(staged, YEARS), "bitmaps")
    assert bitmaps.where("kind = 'year'").select("bucket").distinct().count() >= 3
    assert rows(users.by_year(bitmaps)) == rows(indicators.users_by_year(staged))
    assert rows(users.returning(bitmaps)) == [(100_000, 70_000, 30_000)]


def test_no_enrolments(students):
    bitmaps = land(users.user_bitmaps(students().limit(0), YEARS), "bitmaps")
    assert rows(users.by_year(bitmaps)) == [] and rows(users.returning(bitmaps)) == [(0, 0, 0)]
    assert users.distinct_over(bitmaps, YEARS).first()[0] == 0


def test_rows_are_read_once_and_users_shuffled_once(spark, sf_dir):
    table = land(derived.students_raw(spark, sf_dir), "students_raw")
    physical = plan(users.user_bitmaps(clean_enrolments(table), YEARS))[1]
    assert physical.count("FileScan") == 1
    assert physical.count("hashpartitioning(USER_ID") == 1 and physical.count("Exchange") == 2
    assert "Python" not in physical and "partial_count_if" in physical.replace("partial_count(if", "partial_count_if")


def test_users_with_several_unlisted_years_are_counted_one_by_one(raw_students, spark):
    listed = [("a", "Data", "20-24 ans", "M", "DROM", y) for y in (2030, 2031, 2031, 2022)]
    listed += [("b", "Data", "20-24 ans", "F", "DROM", 2030)]
    models = build.student_models(raw_students(*listed))
    staged = clean_enrolments(raw_students(*listed))
    assert rows(models["users"]) == rows(indicators.users_by_year(staged))
    assert rows(models["returning_users"]) == [(5, 2, 1)]
    found = {line[:3]: line[3] for line in models.lines}
    assert found["repeated_keys", "unique", "USER_ID, year_started"] == 1
