"""The shape of the physical plans at scale."""

import re

import pytest
from helpers import plan

import __spark_entry__ as registry
from cohortscope.operators import counts, indicators, marts
from cohortscope.operators.staging import clean_enrolments
from cohortscope.sources import derived
from cohortscope.sources.shared import land

LAZY = [
    "stg_students", "stg_population", "counts", "students_by_year", "gender_evolution", "age_distribution",
    "region_distribution", "returning_users", "compare_region", "compare_all", "check_unique", "filter_footnotes",
]


@pytest.fixture(scope="module")
def table(spark, sf_dir):
    return land(derived.students_raw(spark, sf_dir), "students_raw")


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    physical = plan(registry.queries()[name](spark, sf_dir))[1]
    for slow in ("Python", "Pandas", "NestedLoop", "Cartesian"):
        assert slow not in physical


def test_order_tables_are_read_once_each(spark, sf_dir):
    for name in ("students_by_year", "age_distribution", "compare_all", "filter_footnotes", "load_summary"):
        physical = plan(registry.queries()[name](spark, sf_dir))[1]
        assert physical.count("lineitem.parquet") <= 1
        # `load_summary` also counts the enrolments without identifier, a second, disjoint filter.
        assert physical.count("orders.parquet") <= (2 if name == "load_summary" else 1)


def test_facts_shrink_before_their_join(spark, sf_dir):
    for df, keys in (
        (clean_enrolments(derived.students_raw(spark, sf_dir)), "HashAggregate(keys=[ck"),
        (derived.population_raw(spark, sf_dir), "HashAggregate(keys=[sk"),
    ):
        physical = plan(df)[1]
        join = re.search(r"\w*HashJoin|SortMergeJoin", physical).start()
        assert keys in physical[join:]


def test_headcount_reads_three_columns(table):
    physical = plan(indicators.students_by_year(clean_enrolments(table)))[1]
    assert "ReadSchema: struct<USER_ID:string,GENDER:string,YEAR_PATH_STARTED:int>" in physical
    assert "PushedFilters: [IsNotNull(USER_ID)]" in physical
    assert physical.count("Exchange hashpartitioning") == 2


def test_focus_filter_and_year_filter_reach_the_scan(table):
    students = clean_enrolments(table)
    regions = indicators.region_distribution(students)
    physical = plan(marts.focus_share(regions, "Île-de-France"))[1]
    assert "IsNotNull(YEAR_PATH_STARTED)" in physical


def test_raw_rows_are_combined_before_every_shuffle(table):
    students = clean_enrolments(table)
    frames = [
        counts.enrolment_cells(table), indicators.students_by_year(students), counts.returning_users(students),
        indicators.category_evolution(students), indicators.age_distribution(students),
    ]
    for df in frames:
        lines = plan(df)[1].splitlines()
        lowest = max(i for i, line in enumerate(lines) if "Exchange" in line)
        assert "partial_" in lines[lowest + 1] or "HashAggregate" in lines[lowest + 1]


def test_top_k_is_limited_before_the_window(table):
    top = counts.top_per_group(indicators.distribution(clean_enrolments(table), "age_group"), 5)
    assert "WindowGroupLimit" in plan(top)[1]


def test_global_shares_read_the_rows_once_and_move_none_to_one_task(spark, sf_dir):
    for name in ("global_share", "benchmark_share"):
        df = registry.queries()[name](spark, sf_dir)
        df.collect()
        final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert "Window" not in final
        assert "ReusedExchange" in final
