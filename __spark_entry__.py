"""Registered queries over the order tables, and their SQL counterparts (`oracles.py`)."""

from __future__ import annotations

import os
import sys
import warnings
from collections.abc import Callable
from dataclasses import replace
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

sys.path.insert(0, str(Path(__file__).resolve().parent))

import oracles  # noqa: E402
from cohortscope.functions import blank_to, recode, share  # noqa: E402
from cohortscope.operators import checks, compare, counts, indicators, marts, reshape, users  # noqa: E402
from cohortscope.operators.staging import clean_enrolments, harmonise_population  # noqa: E402
from cohortscope.plans import build, reports  # noqa: E402
from cohortscope.schemas import LABELS, POPULATION_RAW, STUDENTS_RAW  # noqa: E402
from cohortscope.settings import BLOCKS, BOTH_SEXES, FEMALE, SEX_LABELS  # noqa: E402
from cohortscope.sources import catalog, derived, files  # noqa: E402
from cohortscope.sources.shared import land, land_all, scratch_path  # noqa: E402
from cohortscope.sources.versions import Versions  # noqa: E402

try:  # the training-data operators are a part that can be left out, as can the libraries that only they use
    import corpus_pipeline
    from cohortscope.llm import oracles as llm_oracles
    from cohortscope.llm import queries as llm_queries
except ModuleNotFoundError as missing:
    if not (missing.name or "").startswith(("corpus_pipeline", "cohortscope.llm")):
        warnings.warn(f"the training-data operators are left out: no module {missing.name}", stacklevel=1)
    llm_queries = None

SETTINGS = derived.SETTINGS
SHEET_YEARS = oracles.SHEET_YEARS
_BENCHMARK = SETTINGS.benchmark_year

Query = Callable[[SparkSession, str], DataFrame]


# --- Inputs ---------------------------------------------------------------------------------


def _students(spark: SparkSession, sf: str) -> DataFrame:
    return clean_enrolments(derived.students_raw(spark, sf))


def _population(spark: SparkSession, sf: str) -> DataFrame:
    return harmonise_population(derived.population_raw(spark, sf), SETTINGS)


def _student_models(spark: SparkSession, sf: str) -> build.Models:
    """The derived enrolments go to a table first: the models scan them twice."""
    return build.student_models(land(derived.students_raw(spark, sf), "students_raw"), SETTINGS)


def _base_models(spark: SparkSession, sf: str) -> build.Models:
    raw = land_all({
        "students_raw": derived.students_raw(spark, sf), "population_raw": derived.population_raw(spark, sf)
    })
    return build.base_models(raw["students_raw"], raw["population_raw"], SETTINGS)


def _block_export(spark: SparkSession, sf: str) -> DataFrame:
    base = _base_models(spark, sf)
    return build.block_mart(base, land(build.comparison_mart(base, SETTINGS), "comparison_mart"), SETTINGS)


# --- Sources and sinks ----------------------------------------------------------------------


def src_students(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "students_csv")
    files.write_csv(derived.students_raw(spark, sf), path)
    return files.read_students(spark, path)


def src_population(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "population_csv")
    files.write_csv(derived.population_raw(spark, sf), path)
    return files.read_population(spark, path)


def unpivot_population(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "sheets")
    files.write_sheets(derived.population_wide(derived.population_raw(spark, sf)), path)
    return reshape.unpivot_population(files.read_population_wide(spark, path, SHEET_YEARS), SHEET_YEARS)


def filter_footnotes(spark: SparkSession, sf: str) -> DataFrame:
    wide = derived.population_wide(derived.population_raw(spark, sf))
    return reshape.filter_footnotes(wide).select("region", "year", "c1", "c26", "c62", "c21", "c42", "c63")


def load_summary(spark: SparkSession, sf: str) -> DataFrame:
    students = counts.distinct_values(derived.students_raw(spark, sf), ["YEAR_PATH_STARTED"])
    population = counts.distinct_values(derived.population_raw(spark, sf), ["REGION", "SEXE", "ANNEE"])
    named = [
        df.select(F.lit(name).alias("table_name"), "attribute", "value", "nb_rows")
        for name, df in (("students_raw", students), ("population_raw", population))
    ]
    return named[0].unionByName(named[1])


def load_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """Rows, present values and ranges of both raw tables, from the footers of their files."""
    raw = {"students_raw": derived.students_raw(spark, sf), "population_raw": derived.population_raw(spark, sf)}
    paths = {name: scratch_path(spark, name) for name in raw}
    land_all(raw, lambda df, name: files.write_table(df, paths[name]))
    named = [
        files.footer_summary(spark, path).select(F.lit(name).alias("table_name"), "*") for name, path in paths.items()
    ]
    return named[0].unionByName(named[1])


def source_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """Yearly enrolments of a catalog table that a setting names."""
    path = scratch_path(spark, "enrolments")
    table = f"enrolments_{path.rsplit('-', 1)[1]}"
    catalog.save(derived.students_raw(spark, sf), table, path)
    spark.conf.set(f"{catalog.SETTING}enrolments", table)
    try:
        students = clean_enrolments(catalog.source("enrolments"))
    finally:
        spark.conf.unset(f"{catalog.SETTING}enrolments")
    return counts.count_by(students, "year_started")


def publish_marts(spark: SparkSession, sf: str) -> DataFrame:
    """The comparison as a reader finds it after two builds."""
    out = scratch_path(spark, "published")
    raw = land_all({
        "students_raw": derived.students_raw(spark, sf).where("USER_ID IS NOT NULL"),
        "population_raw": derived.population_raw(spark, sf),
    })
    later = raw["students_raw"].where("YEAR_PATH_STARTED > 1995")
    build.build(later, raw["population_raw"], out, SETTINGS)
    build.build(raw["students_raw"], raw["population_raw"], out, SETTINGS)
    return Versions(spark, out).read("comparison_mart")


def export_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that an export's manifest lists, rows that are read back, and parts that do not match."""
    students = _students(spark, sf)
    path = scratch_path(spark, "stg_students_csv")
    files.export_rows(students, path, build.EXPORT_KEYS)
    figures = {
        "listed": files.read_manifest(spark, path).agg(F.coalesce(F.sum("nb_rows"), F.lit(0)).alias("value")),
        "read": files.read_csv(spark, path, students.schema).agg(F.count(F.lit(1)).alias("value")),
        "problems": files.verify_export(spark, path, students.schema).agg(F.count(F.lit(1)).alias("value")),
    }
    named = [df.select(F.lit(name).alias("metric"), "value") for name, df in figures.items()]
    return named[0].unionByName(named[1]).unionByName(named[2])


def sink_csv(spark: SparkSession, sf: str) -> DataFrame:
    """The long table made from the wide sheets, written as CSV and read back."""
    wide = derived.population_wide(derived.population_raw(spark, sf))
    path = scratch_path(spark, "long_csv")
    files.write_csv(reshape.unpivot_population(wide, SETTINGS.years), path)
    return files.read_csv(spark, path, POPULATION_RAW)


def sink_table(spark: SparkSession, sf: str) -> DataFrame:
    return files.write_table(_compare_all(spark, sf), scratch_path(spark, "comparison_mart"))


def export_staging(spark: SparkSession, sf: str) -> DataFrame:
    students = _students(spark, sf)
    path = scratch_path(spark, "stg_students_csv")
    files.export_rows(students, path, build.EXPORT_KEYS)
    return files.read_csv(spark, path, students.schema)


def export_blocks(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "block_export_csv")
    files.export_blocks(_block_export(spark, sf), path)
    schema = ("slide int, source_table string, dimension string, detail string, "
              "valeur string, valeur_2 double, ecart double, rang bigint")
    return spark.read.schema(schema).option("header", True).csv(path)


# --- Staging --------------------------------------------------------------------------------


def blank_recode(spark: SparkSession, sf: str) -> DataFrame:
    raw = derived.students_raw(spark, sf)
    labelled = raw.select(
        F.col("GENDER").alias("raw_gender"), blank_to(F.col("GENDER"), SETTINGS.non_response).alias("gender")
    )
    return counts.count_by(labelled, "raw_gender", "gender")


def label_map(spark: SparkSession, sf: str) -> DataFrame:
    sums = (
        derived.population_raw(spark, sf)
        .groupBy(F.col("REGION").alias("raw_region"), F.col("SEXE").alias("raw_sexe"))
        .agg(F.sum("POPULATION").cast("bigint").alias("population"))
    )
    return sums.select(
        "raw_region",
        recode(F.col("raw_region"), SETTINGS.region_labels, keep_unknown=True).alias("region"),
        "raw_sexe",
        recode(F.col("raw_sexe"), SEX_LABELS).alias("sexe"),
        "population",
    )


def band_map(spark: SparkSession, sf: str) -> DataFrame:
    sums = (
        derived.population_raw(spark, sf)
        .groupBy(F.col("AGE_GROUP").alias("raw_age_group"))
        .agg(F.sum("POPULATION").cast("bigint").alias("population"))
    )
    band = recode(F.col("raw_age_group"), SETTINGS.band_labels)
    return sums.select("raw_age_group", band.alias("age_group"), "population").where("age_group IS NOT NULL")


def label_table(spark: SparkSession, sf: str) -> DataFrame:
    """The harmonised population, with its three label maps as tables."""
    maps = {
        name: spark.createDataFrame(list(getattr(SETTINGS, name).items()), LABELS)
        for name in ("region_labels", "sex_labels", "band_labels")
    }
    return harmonise_population(derived.population_raw(spark, sf), replace(SETTINGS, **maps))


def filters(spark: SparkSession, sf: str) -> DataFrame:
    benchmark = (F.col("sexe") == BOTH_SEXES) & (F.col("annee") == _BENCHMARK)
    women = (F.col("sexe") == FEMALE) & (F.col("region") == SETTINGS.focus_region)
    return _population(spark, sf).where(F.col("age_group").isin(*SETTINGS.key_bands) & (benchmark | women))


# --- Indicators -----------------------------------------------------------------------------


def share_declared(spark: SparkSession, sf: str) -> DataFrame:
    gender = F.col("gender")
    by_year = _students(spark, sf).groupBy("year_started").agg(
        F.count_if(gender == FEMALE).alias("nb_female"),
        F.count_if(gender != SETTINGS.non_response).alias("nb_declared"),
    )
    return by_year.withColumn(
        "pct_female_among_declared", share(F.col("nb_female"), F.col("nb_declared"))
    )


def female_share(spark: SparkSession, sf: str) -> DataFrame:
    return reports.female_share(indicators.category_evolution(_students(spark, sf)))


def focus_share(spark: SparkSession, sf: str) -> DataFrame:
    focus = SETTINGS.focus_region
    return marts.focus_share(indicators.region_distribution(_students(spark, sf), focus), focus)


def _region_counts(spark: SparkSession, sf: str) -> DataFrame:
    return counts.count_by(_students(spark, sf), "year_started", "region")


def top_per_group(spark: SparkSession, sf: str) -> DataFrame:
    ages = indicators.distribution(_students(spark, sf), "age_group")
    return counts.top_per_group(ages, SETTINGS.top_bands).select("year_started", "age_group", "pct_of_year", "rang")


def _user_bitmaps(spark: SparkSession, sf: str) -> DataFrame:
    return land(users.user_bitmaps(_students(spark, sf), SETTINGS.years), "user_bitmaps")


# --- Comparison -----------------------------------------------------------------------------


def _compare_by(spark: SparkSession, sf: str, key: str) -> DataFrame:
    observed = compare.global_share(_students(spark, sf), key)
    benchmark = compare.benchmark_share(_population(spark, sf), key, _BENCHMARK)
    return compare.compare_distributions(observed, benchmark, [key])


def compare_age(spark: SparkSession, sf: str) -> DataFrame:
    return _compare_by(spark, sf, "age_group").select("age_group", "pct_oc", "pct_insee", "ecart_pts")


def _compare_all(spark: SparkSession, sf: str) -> DataFrame:
    return compare.comparison_mart(_students(spark, sf), _population(spark, sf), SETTINGS)


def band_group_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return marts.headline_synthesis(land(_compare_all(spark, sf), "comparison_mart"), SETTINGS)


# --- Reports --------------------------------------------------------------------------------


def report_top_bands(spark: SparkSession, sf: str) -> DataFrame:
    return reports.top_bands(indicators.distribution(_students(spark, sf), "age_group"), SETTINGS.top_bands)


# --- Marts ----------------------------------------------------------------------------------


def annual_synthesis(spark: SparkSession, sf: str) -> DataFrame:
    return build.synthesis_mart(_student_models(spark, sf), SETTINGS)


# --- Checks ---------------------------------------------------------------------------------


def check_not_null(spark: SparkSession, sf: str) -> DataFrame:
    columns = [name for name in STUDENTS_RAW.names if name != "PATH_CATEGORY_NAME"]
    return checks.null_counts(derived.students_raw(spark, sf), columns)


def check_sum_100(spark: SparkSession, sf: str) -> DataFrame:
    """Both distributions, and the top bands alone, which must fail."""
    cells = land(counts.count_by(_students(spark, sf), *counts.CELL_KEYS), "cells")
    ages = indicators.distribution(cells, "age_group")
    frames = {
        "age": ages,
        "region": indicators.distribution(cells, "region"),
        "age_top5": counts.top_per_group(ages, SETTINGS.top_bands),
    }
    parts = [
        checks.sums_to_100(df).select(F.lit(name).alias("model"), "year_started", "total_pct")
        for name, df in frames.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def reconcile(spark: SparkSession, sf: str) -> DataFrame:
    years = len(SETTINGS.years)
    expected = dict(zip(BLOCKS, (years, 3 * years, 9, SETTINGS.top_bands * years, 14, years, 3), strict=True))
    lines = marts.block_counts(_block_export(spark, sf))
    actual = lines.select(F.col("source_table").alias("metric"), F.col("nb_lignes").alias("value"))
    return checks.reconcile(actual, expected)


def gate(spark: SparkSession, sf: str) -> DataFrame:
    return build.check_summary(build.with_marts(_base_models(spark, sf), SETTINGS))


def gate_failing(spark: SparkSession, sf: str) -> DataFrame:
    """The checks of damaged enrolments: each kind finds violations."""
    damaged = land(derived.damaged_students(derived.students_raw(spark, sf)), "students_damaged")
    return build.check_summary(build.student_models(damaged, SETTINGS))


# --- Contract -------------------------------------------------------------------------------

_QUERIES: dict[str, Query] = {
    "src_students": src_students,
    "src_population": src_population,
    "unpivot_population": unpivot_population,
    "filter_footnotes": filter_footnotes,
    "load_summary": load_summary,
    "load_ranges": load_ranges,
    "source_by_name": source_by_name,
    "sink_csv": sink_csv,
    "sink_table": sink_table,
    "stg_students": _students,
    "blank_recode": blank_recode,
    "stg_population": _population,
    "label_map": label_map,
    "band_map": band_map,
    "label_table": label_table,
    "filters": filters,
    "counts": lambda spark, sf: counts.count_by(_students(spark, sf), "year_started", "region", "gender"),
    "students_by_year": lambda spark, sf: indicators.students_by_year(_students(spark, sf)),
    "share_declared": share_declared,
    "gender_evolution": lambda spark, sf: indicators.category_evolution(_students(spark, sf)),
    "female_share": female_share,
    "gender_counts": lambda spark, sf: reports.gender_counts(_students(spark, sf)),
    "age_distribution": lambda spark, sf: indicators.age_distribution(_students(spark, sf)),
    "region_distribution": lambda spark, sf: indicators.region_distribution(_students(spark, sf)),
    "focus_share": focus_share,
    "share_of_total": lambda spark, sf: counts.share_of_total(_region_counts(spark, sf)),
    "rank_within": lambda spark, sf: counts.rank_within(_region_counts(spark, sf)),
    "banded_mean": lambda spark, sf: counts.banded_mean(_students(spark, sf), SETTINGS.band_midpoints),
    "top_per_group": top_per_group,
    "returning_users": lambda spark, sf: counts.returning_users(_students(spark, sf)),
    "users_by_bitmaps": lambda spark, sf: users.by_year(_user_bitmaps(spark, sf)),
    "returning_by_bitmaps": lambda spark, sf: users.returning(_user_bitmaps(spark, sf)),
    "distinct_over_years": lambda spark, sf: users.distinct_over(_user_bitmaps(spark, sf), (1996, 1998, 1999)),
    "benchmark_share": lambda spark, sf: compare.benchmark_share(_population(spark, sf), "region", _BENCHMARK),
    "global_share": lambda spark, sf: compare.global_share(_students(spark, sf), "region"),
    "compare_region": lambda spark, sf: _compare_by(spark, sf, "region"),
    "compare_age": compare_age,
    "compare_gender": lambda spark, sf: compare.compare_share(
        _students(spark, sf), _population(spark, sf), _BENCHMARK),
    "compare_all": _compare_all,
    "report_headcounts": lambda spark, sf: reports.headcounts(indicators.students_by_year(_students(spark, sf))),
    "report_gender_shares": lambda spark, sf: reports.gender_shares(
        indicators.category_evolution(_students(spark, sf))),
    "report_age_comparison": lambda spark, sf: reports.age_comparison(_compare_all(spark, sf)),
    "report_top_bands": report_top_bands,
    "report_region_comparison": lambda spark, sf: reports.region_comparison(_compare_all(spark, sf)),
    "annual_synthesis": annual_synthesis,
    "band_group_rollup": band_group_rollup,
    "block_union": _block_export,
    "block_counts": lambda spark, sf: reports.block_counts(_block_export(spark, sf)),
    "publish_marts": publish_marts,
    "export_staging": export_staging,
    "export_manifest": export_manifest,
    "export_blocks": export_blocks,
    "check_not_null": check_not_null,
    "check_accepted": lambda spark, sf: checks.accepted_values(
        derived.students_raw(spark, sf), "GENDER", ["M", "F"]),
    "check_unique": lambda spark, sf: checks.unique(
        derived.enrolments_per_order(spark, sf), ["USER_ID", "year_started"]),
    "check_range": lambda spark, sf: checks.in_range(_students(spark, sf), "year_started", 1996, 2000),
    "check_sum_100": check_sum_100,
    "reconcile": reconcile,
    "gate": gate,
    "gate_failing": gate_failing,
}


def _leave_spark(df: DataFrame) -> DataFrame:
    """Exact decimals as doubles, for readers outside Spark."""
    return df.select(*[
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType) else F.col(f.name)
        for f in df.schema
    ])


def _registered(query: Query) -> Query:
    return lambda spark, sf_dir: _leave_spark(query(spark, sf_dir))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the annual synthesis."""
    return queries()["annual_synthesis"](spark, os.environ.get("ENTRY_SF_DIR", "/root/testdata/sf0.001"))


def own_queries() -> dict[str, Query]:
    """The queries of the enrolment profiles; `queries` adds those of the training-data operators."""
    return {name: _registered(query) for name, query in _QUERIES.items()}


def queries() -> dict[str, Query]:
    if llm_queries is None:
        return own_queries()
    return own_queries() | llm_queries.QUERIES | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    if llm_queries is None:
        return oracles.oracle_sql()
    pipeline = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return oracles.oracle_sql() | llm_oracles.oracle_sql() | pipeline
