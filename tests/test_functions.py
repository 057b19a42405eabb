import random
import time
from decimal import Decimal
from fractions import Fraction

import pytest
from helpers import plan, rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortscope.functions import blank_to, gap, ratio, recode, relabel, share
from cohortscope.functions import labels as labels_module
from cohortscope.settings import BAND_LABELS, NON_RESPONSE, POPULATION_BANDS, REGION_LABELS, SEX_LABELS


def one_column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def test_blank_to_labels_null_and_spaces_only(spark):
    nbsp = " "
    df = one_column(spark, [" M ", "", "  ", None, "m", nbsp, "\t"])
    labels = [r.y for r in df.select(blank_to(F.col("x"), NON_RESPONSE).alias("y")).collect()]
    assert labels == ["M", NON_RESPONSE, NON_RESPONSE, NON_RESPONSE, "m", nbsp, "\t"]


def test_open_recode_passes_unknown_labels_through(spark):
    df = one_column(spark, ["Mayotte", "DOM", "Centre-Val-de-Loire", "Corse", "X", None])
    mapped = [r.y for r in df.select(recode(F.col("x"), REGION_LABELS, keep_unknown=True).alias("y")).collect()]
    assert mapped == ["DROM", "DROM", "Centre-Val de Loire", "Corse", "X", None]


def test_closed_recode_makes_unknown_labels_null(spark):
    df = one_column(spark, ["Hommes", "Femmes", "Ensemble", "Autre", None])
    assert [r.y for r in df.select(recode(F.col("x"), SEX_LABELS).alias("y")).collect()] == [
        "M", "F", "Ensemble", None, None]


def test_recode_with_no_labels(spark):
    df = one_column(spark, ["a"])
    closed, opened = df.select(recode(F.col("x"), {}).alias("c"), recode(F.col("x"), {}, True).alias("o")).first()
    assert (closed, opened) == (None, "a")


def test_bands_collapse_to_nine_labels_from_twenty():
    assert len(POPULATION_BANDS) == 20
    assert [b for b in POPULATION_BANDS if b not in BAND_LABELS] == list(POPULATION_BANDS[:4])
    assert len(set(BAND_LABELS.values())) == 9
    assert sum(label == "60 ans ou plus" for label in BAND_LABELS.values()) == 8


def half_up(value: Fraction, digits: int) -> Decimal:
    scaled = value * 10**digits
    whole = (2 * scaled.numerator + scaled.denominator) // (2 * scaled.denominator)
    return Decimal(whole) / 10**digits


def test_share_rounds_exact_halves_up(spark):
    rng = random.Random(7)
    pairs = [(n, t) for t in (8, 16, 40, 80, 200, 400, 2000) for n in range(t + 1)]
    pairs += [(rng.randrange(t + 1), t) for t in (rng.randrange(1, 10**11) for _ in range(3000))]
    df = spark.createDataFrame(pairs, "n bigint, t bigint")
    for n, t, pct in df.select("n", "t", share(F.col("n"), F.col("t"))).collect():
        assert pct == half_up(Fraction(100 * n, t), 1), (n, t)


def test_share_of_nothing_is_null(spark):
    assert spark.range(1).select(share(F.lit(0), F.lit(0))).first()[0] is None


def test_ratio_and_gap_take_rounded_shares(spark):
    df = spark.createDataFrame(
        [(Decimal("0.3"), Decimal("0.8")), (Decimal("45.6"), Decimal("17.4")), (Decimal("1.0"), Decimal("0.0")),
         (None, Decimal("6.7"))],
        "a decimal(12,1), b decimal(12,1)",
    )
    assert [tuple(r) for r in df.select(ratio(F.col("a"), F.col("b")), gap(F.col("a"), F.col("b"))).collect()] == [
        (Decimal("0.38"), Decimal("-0.5")), (Decimal("2.62"), Decimal("28.2")), (None, Decimal("1.0")), (None, None)]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1000), st.integers(1, 1000)), min_size=1, max_size=200))
def test_ratio_matches_exact_arithmetic(spark, pairs):
    df = spark.createDataFrame(
        [(Decimal(a).scaleb(-1), Decimal(b).scaleb(-1), a, b) for a, b in pairs],
        "a decimal(12,1), b decimal(12,1), x int, y int",
    )
    for value, x, y in df.select(ratio(F.col("a"), F.col("b")), "x", "y").collect():
        assert value == half_up(Fraction(x, y), 2)


def map_frame(spark, *pairs):
    return spark.createDataFrame(list(pairs), "source string, target string")


@pytest.mark.parametrize("as_table", [False, True])
def test_relabel_by_mapping_and_by_table(spark, as_table, monkeypatch):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("x", 4), ("a", 5)], "source string, n int")
    labels = map_frame(spark, ("a", "A"), ("b", "A"), (None, "never")) if as_table else {"a": "A", "b": "A"}
    assert rows(relabel(df, "source", labels, "label"), "n", "label") == [(1, "A"), (2, "A"), (3, None), (4, None), (5, "A")]
    kept = relabel(df, "source", labels, "label", keep_unknown=True)
    assert kept.columns == ["source", "n", "label"] and rows(kept, "n", "label")[2:4] == [(3, None), (4, "x")]
    assert rows(relabel(df, "source", labels, "label", drop_unknown=True), "n") == [(1,), (2,), (5,)]
    monkeypatch.setattr(labels_module, "MAX_BROADCAST_LABELS", 0)
    assert rows(relabel(df, "source", labels, "label", drop_unknown=True), "n") == [(1,), (2,), (5,)]


def test_labels_that_are_mapped_twice_are_refused(spark):
    df = spark.createDataFrame([("a",)], "x string")
    for pairs in ([("a", "A"), ("a", "B")], [("a", "A"), ("a", "A"), ("b", "B")]):
        with pytest.raises(ValueError, match="more than once: a"):
            relabel(df, "x", map_frame(spark, *pairs), "y")


def test_a_large_map_plans_in_seconds(spark):
    df = spark.range(10).selectExpr("concat('s', id) AS x")
    labels = {f"s{i}": f"t{i % 7}" for i in range(100_000)}
    table = spark.createDataFrame(list(labels.items()), "source string, target string").cache()
    table.count()
    start = time.perf_counter()
    planned = relabel(df, "x", table, "y")
    assert "BroadcastHashJoin" in plan(planned)[1] and time.perf_counter() - start < 15
    assert rows(planned, "x", "y") == rows(relabel(df, "x", labels, "y"), "x", "y") == [(f"s{i}", f"t{i % 7}") for i in range(10)]
    table.unpersist()


def test_a_map_table_harmonises_like_its_mapping(spark, population_raw_rows):
    import dataclasses

    from cohortscope.operators.staging import harmonise_population
    from cohortscope.settings import Settings

    plain = Settings()
    tables = dataclasses.replace(plain, **{
        name: map_frame(spark, *getattr(plain, name).items()) for name in ("region_labels", "sex_labels", "band_labels")})
    assert rows(harmonise_population(population_raw_rows, tables)) == rows(harmonise_population(population_raw_rows, plain))


@pytest.fixture
def population_raw_rows(spark, sf_dir):
    from cohortscope.sources import derived
    from cohortscope.sources.shared import land

    return land(derived.population_raw(spark, sf_dir), "population_raw")
