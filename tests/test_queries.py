"""Every registered query against its SQL counterpart, and invariants of the derived data."""

import sys
from pathlib import Path

import duckdb
import pytest
from helpers import rows
from pyspark.sql import functions as F

import __spark_entry__ as registry
from cohortscope.operators import compare
from cohortscope.operators.counts import count_by, enrolment_cells
from cohortscope.sources import derived

QUERIES, ORACLES = registry.own_queries(), registry.oracles.oracle_sql()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def oracle(sf_dir):
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, sf_dir, oracle, name):
    df = QUERIES[name](spark, sf_dir)
    result = oracle.execute(ORACLES[name])
    types = {column[0]: str(column[1]) for column in result.description}
    assert {column: TYPES[kind] for column, kind in df.dtypes} == types
    columns = list(types)
    expected = sorted(map(repr, result.fetchall()))
    assert sorted(repr(tuple(r)) for r in df.select(*columns).collect()) == expected
    assert expected


def test_entry(spark):
    df = registry.entry(spark)
    assert "top_region" in df.columns and df.count() >= 7


def test_entry_module_finds_its_neighbours():
    assert str(Path(registry.__file__).resolve().parent) in sys.path


def test_derived_enrolments_are_distinct(spark, sf_dir):
    raw = derived.students_raw(spark, sf_dir)
    assert raw.count() == raw.distinct().count()
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    assert customers.count() == customers.select("c_custkey").distinct().count()


def test_cells_add_up_to_the_rows(spark, sf_dir):
    raw = derived.students_raw(spark, sf_dir)
    assert enrolment_cells(raw).agg(F.sum("nb_students")).first()[0] == raw.count()


@pytest.mark.parametrize("name", ["age_distribution", "region_distribution", "gender_evolution"])
def test_yearly_shares_add_up(spark, sf_dir, name):
    sums = QUERIES[name](spark, sf_dir).groupBy("year_started").agg(F.sum("pct_of_year").alias("s"))
    assert all(99 <= r.s <= 101 for r in sums.collect())


def test_men_and_women_add_up_to_both(spark, sf_dir):
    population = QUERIES["stg_population"](spark, sf_dir)
    sums = population.groupBy("region", "age_group", "annee").agg(
        F.sum(F.when(F.col("sexe") == "Ensemble", F.col("population")).otherwise(-F.col("population"))).alias("d"))
    assert sums.where("d != 0").isEmpty()


def test_gap_is_the_difference_of_the_shares(spark, sf_dir):
    mart = compare.comparison_mart(
        registry._students(spark, sf_dir), registry._population(spark, sf_dir), registry.SETTINGS)
    assert mart.where("ecart_pts != pct_oc - pct_insee").isEmpty()
    assert mart.where("(pct_oc IS NULL OR pct_insee IS NULL) != (ecart_pts IS NULL)").isEmpty()


def test_row_export_counts_every_enrolment(spark, sf_dir):
    exported = QUERIES["export_staging"](spark, sf_dir)
    assert rows(count_by(exported, "year_started")) == rows(count_by(registry._students(spark, sf_dir), "year_started"))


def test_damaged_enrolments_fail_a_check_of_every_kind(spark, sf_dir):
    failed = QUERIES["gate_failing"](spark, sf_dir).where("NOT passed")
    assert {r["kind"] for r in failed.select("kind").distinct().collect()} == {
        "not_null", "accepted_values", "range", "unique", "sum_100"}
