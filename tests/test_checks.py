import dataclasses
from decimal import Decimal as D

import pytest
from helpers import rows
from pyspark.sql import functions as F

from cohortscope.operators import checks, indicators
from cohortscope.plans import build, reports
from cohortscope.schemas import POPULATION_RAW
from cohortscope.settings import NON_RESPONSE, POPULATION_BANDS, Settings
from cohortscope.sources import derived
from cohortscope.sources.files import read_csv
from cohortscope.sources.versions import Versions


def enrol(n, start, age="25-29 ans", gender="M", region="DROM", year=2022):
    return [(f"u{start + i}", age, gender, region, year) for i in range(n)]


def test_not_null(students):
    df = students(*enrol(2, 0), (None, "a", "M", "r", 2022), ("x", "a", None, None, 2022))
    assert rows(checks.not_null(df, ["USER_ID", "gender"]), "age_group") == [("a",), ("a",)]
    assert rows(checks.null_counts(df, ["USER_ID", "region", "year_started"])) == [
        ("USER_ID", 1), ("region", 1), ("year_started", 0)]


def test_accepted_values_ignores_null(students):
    df = students(*enrol(2, 0), *enrol(3, 5, gender="m"), *enrol(1, 9, gender=None))
    assert rows(checks.accepted_values(df, "gender", ["M", "F", NON_RESPONSE])) == [("m", 3)]
    assert checks.accepted_values(df, "year_started", [2022]).isEmpty()


def test_unique(students):
    df = students(*enrol(2, 0), *enrol(1, 0), *enrol(2, 0, year=2023))
    assert rows(checks.unique(df, ["USER_ID", "year_started"])) == [("u0", 2022, 2)]
    assert rows(checks.unique(df, ["USER_ID"])) == [("u0", 3), ("u1", 2)]


def test_range(students):
    df = students(*[row for i, y in enumerate((2021, 2022, 2025, 2026, 9999, None)) for row in enrol(1, i, year=y)])
    assert rows(checks.in_range(df, "year_started", 2022, 2025), "year_started") == [(2021,), (2026,), (9999,)]


def test_shares_that_do_not_sum(spark):
    df = spark.createDataFrame(
        [(2022, D("40.0")), (2022, D("40.0")), (2023, D("99.9")), (2024, D("98.5")), (2025, D("101.5"))],
        "year_started int, pct_of_year decimal(12,1)")
    assert rows(checks.sums_to_100(df)) == [(2022, D(80)), (2025, D(102))]


def test_there_are_forty_declared_checks():
    declared = checks.declared_checks()
    kinds = [check.kind for check in declared]
    assert len(declared) == 40
    assert {kind: kinds.count(kind) for kind in set(kinds)} == {
        "not_null": 28, "accepted_values": 8, "range": 1, "unique": 1, "sum_100": 2}
    assert len({(c.model, c.kind, c.column) for c in declared}) == 40


def test_weighted_and_plain_failures(spark, students):
    checked = {
        "stg_students": spark.createDataFrame(
            [("id", "m", 2030, "a", None, 5), ("id", "M", 2022, "a", "r", 2)],
            "USER_ID string, gender string, year_started int, age_group string, region string, nb_students bigint"),
        "gender_evolution": indicators.category_evolution(students(*enrol(1, 0, gender="m"))),
    }
    failed = checks.summarise(checked, checks.declared_checks()).where("NOT passed")
    assert rows(failed, "model", "kind", "column", "nb_failures", "example") == [
        ("gender_evolution", "accepted_values", "gender", 1, "m"),
        ("stg_students", "accepted_values", "gender", 5, "m"),
        ("stg_students", "accepted_values", "year_started", 5, "2030"),
        ("stg_students", "not_null", "region", 5, None),
        ("stg_students", "range", "year_started", 5, "2030"),
    ]


def test_an_empty_model_passes(spark):
    empty = spark.createDataFrame([], "USER_ID string, AGE_GROUP string, REGION string, YEAR_PATH_STARTED int, nb_students bigint")
    assert rows(checks.summarise({"students_raw": empty}, checks.declared_checks()), "nb_failures") == [(0,)] * 4


def test_gate(spark):
    schema = "model string, kind string, column string, nb_failures bigint, example string, passed boolean"
    checks.gate(spark.createDataFrame([("m", "range", "c", 0, None, True)], schema))
    failing = [("m", "range", "c", 3, "2021", False), ("m", "unique", "d", 0, None, True)]
    with pytest.raises(checks.GateFailure, match=r"range\(m\.c\): 3, such as 2021$"):
        checks.gate(spark.createDataFrame(failing, schema))


def test_reconcile(spark):
    actual = spark.createDataFrame([("a", 4), ("b", 12), ("x", 1)], "metric string, value bigint")
    assert rows(checks.reconcile(actual, {"a": 4, "b": 9, "c": 2})) == [
        ("a", 4, 4, True), ("b", 12, 9, False), ("c", None, 2, False), ("x", 1, None, False)]


@pytest.fixture
def raw_population(spark):
    return spark.createDataFrame([
        (region, sex, band, n * (2 if sex == "Ensemble" else 1), 2023)
        for n, region in enumerate(("Île-de-France", "Corse", "Mayotte"), 1)
        for sex in ("Hommes", "Femmes", "Ensemble") for band in POPULATION_BANDS
    ], POPULATION_RAW)


def raw_enrolments(raw_students, *extra):
    base = [
        (f"u{i}", "Data", f" {20 + 5 * (i % 8)}-{24 + 5 * (i % 8)} ans", (" M", "F ", "", None)[i % 4],
         ("Île-de-France", "DROM ")[i % 2], 2022 + i % 4)
        for i in range(64)
    ]
    return raw_students(*base, *extra)


def test_build_writes_checked_marts(spark, raw_students, raw_population, tmp_path):
    out = str(tmp_path / "out")
    models = build.build(raw_enrolments(raw_students), raw_population, out)
    for name in build.MARTS:
        assert rows(Versions(spark, out).read(name)) == rows(models[name])
    assert models["annual_synthesis"].count() >= 4
    summary = build.check_summary(models)
    assert summary.count() == 40 and summary.where("NOT passed").isEmpty()

    assert [r.rang for r in models["block_export"].where("slide = 8").collect()] == [1, 2, 3, 4]
    found = reports.reports(models)
    assert len(found) == 11 and not any(df.isEmpty() for df in found.values())
    assert [r.region for r in found["region_comparison"].collect()][-1] == "Corse"
    assert rows(found["returning_users"]) == [(64, 64, 0)]

    models.register_views({"comparison_mart": "mart_benchmark"})
    assert spark.sql("SELECT count(*) FROM stg_students").first()[0] == 64
    assert spark.sql("SELECT detail FROM mart_benchmark WHERE dimension = 'region' AND pct_oc IS NULL").first()[0] == "Corse"

    build.export(models, out, rows=True)
    exported = read_csv(spark, f"{out}/stg_students_csv", models["stg_students"].schema)
    assert rows(exported) == rows(models["stg_students"])
    assert spark.read.option("header", True).csv(f"{out}/block_export.csv").count() == models["block_export"].count()


@pytest.mark.parametrize("bad, message", [
    ((None, "Data", "20-24 ans", "M", "DROM", 2022), r"not_null\(students_raw\.USER_ID\): 1"),
    (("u0", "Data", "20-24 ans", "M", "DROM", 2022), r"unique\(repeated_keys\.USER_ID, year_started\): 1"),
    (("w", "Data", "20-24 ans", "x", "DROM", 2022), r"accepted_values\(stg_students\.gender\): 1"),
    (("w", "Data", "20-24 ans", "M", "DROM", 2031), r"range\(stg_students\.year_started\): 1"),
    (("w", "Data", None, "M", "DROM", 2022), r"not_null\(stg_students\.age_group\): 1"),
])
def test_a_bad_input_stops_the_build_before_any_mart(raw_students, raw_population, tmp_path, bad, message):
    out = tmp_path / "out"
    with pytest.raises(checks.GateFailure, match=message):
        build.build(raw_enrolments(raw_students, bad), raw_population, str(out))
    assert not out.exists()


def test_settings_change_what_is_accepted(raw_students, raw_population, tmp_path):
    later = Settings(years=(2022, 2023, 2024, 2025, 2031))
    extra = ("w", "Data", "20-24 ans", "M", "DROM", 2031)
    models = build.build(raw_enrolments(raw_students, extra), raw_population, str(tmp_path / "out"), later)
    assert models["students_by_year"].count() == 5


def test_marts_that_fail_replace_nothing(spark, raw_students, raw_population, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    good = rows(build.build(raw_enrolments(raw_students), raw_population, out)["block_export"])
    declared = checks.declared_checks

    def stricter(settings):
        return [*declared(settings), checks.Check("block_export", "range", "slide", F.col("slide") > 13, None, "slide")]

    monkeypatch.setattr(build.checks, "declared_checks", stricter)
    changed = raw_enrolments(raw_students, ("w", "Data", "20-24 ans", "M", "DROM", 2022))
    with pytest.raises(checks.GateFailure, match=r"range\(block_export\.slide\): 3, such as 14"):
        build.build(changed, raw_population, out)
    assert rows(Versions(spark, out).read("block_export")) == good


def test_a_missing_benchmark_year_stops_the_build(spark, sf_dir, tmp_path):
    settings = dataclasses.replace(derived.SETTINGS, benchmark_year=2030)
    with pytest.raises(ValueError, match="2030"):
        build.build(derived.students_raw(spark, sf_dir), derived.population_raw(spark, sf_dir), str(tmp_path), settings)
