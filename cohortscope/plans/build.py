"""The full build: models, gates and mart tables from the two raw inputs.

Enrolments are scanned twice whatever the number of models: once into the cells (all label
counts, raw and staged checks), once by user (distinct users, repeated keys, returning users). The
results are small and written, so every later model and mart reads a small table. The declared checks
are counted while the tables are written; no table is read again for them.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortscope.operators import checks, compare, counts, indicators, marts, users
from cohortscope.operators.staging import clean_enrolments, harmonise_population
from cohortscope.settings import Settings
from cohortscope.sources import catalog
from cohortscope.sources.files import export_blocks, export_rows, write_table
from cohortscope.sources.shared import land, land_all, scratch_path
from cohortscope.sources.versions import Versions

EXPORT_KEYS = ("year_started", "region", "age_group", "gender")
MARTS = ("annual_synthesis", "comparison_mart", "block_export")


@dataclass(frozen=True)
class Models:
    """Every model by name; `lines` holds what the declared checks of the written models found."""

    frames: dict[str, DataFrame]
    lines: tuple[tuple, ...] = ()

    def __getitem__(self, name: str) -> DataFrame:
        return self.frames[name]

    def register_views(self, names: Mapping[str, str] | None = None) -> None:
        """Make every model a temporary view, for SQL by model name or by the name given for it."""
        for name, df in self.frames.items():
            df.createOrReplaceTempView((names or {}).get(name, name))


@dataclass(frozen=True)
class _Watched:
    """A frame to write and the models whose checks are counted meanwhile. `seen` adds what only the checks need."""

    frame: DataFrame
    models: Mapping[str, Column | None]
    seen: Mapping[str, Column] | None = None
    beside: Mapping[str, Column] | None = None


def _land_watched(
    frames: Mapping[str, _Watched], settings: Settings, folder: str | None = None
) -> tuple[dict[str, DataFrame], dict[str, checks.Watch]]:
    """Write the frames at the same time, into `folder` or the shared one, and count their checks on the way."""
    declared = checks.declared_checks(settings)
    watches = {name: checks.Watch(w.models, declared, w.beside) for name, w in frames.items()}

    def write(watched: _Watched, name: str) -> DataFrame:
        observed = watches[name].over(watched.frame.withColumns(dict(watched.seen or {})))
        path = f"{folder}/{name}" if folder else scratch_path(observed.sparkSession, name)
        return write_table(observed.select(*watched.frame.columns), path)

    return land_all(frames, write), watches


def _lines(watches: Mapping[str, checks.Watch]) -> tuple[tuple, ...]:
    return tuple(line for watch in watches.values() for line in watch.lines())


def _student_inputs(students_raw: DataFrame, settings: Settings) -> dict[str, _Watched]:
    # Trimming keeps null labels null, so the cells show the raw columns' nulls too.
    raw_names = {"USER_ID": F.when(F.col("identified"), F.lit("id")), "YEAR_PATH_STARTED": F.col("year_started")}
    staged = clean_enrolments(students_raw, settings.non_response)
    return {
        "cells": _Watched(
            counts.enrolment_cells(students_raw, settings.non_response),
            {"students_raw": None, "stg_students": F.col("identified")}, raw_names),
        "user_bitmaps": _Watched(
            users.user_bitmaps(staged, settings.years), {"repeated_keys": F.col("kind") == users.YEAR},
            beside={"unclear": F.count_if(F.col("kind") == users.UNCLEAR)}),
    }


def _user_models(
    students_raw: DataFrame, bitmaps: DataFrame, watch: checks.Watch, settings: Settings
) -> tuple[dict[str, DataFrame], tuple[tuple, ...]]:
    """Yearly, overall and returning users from the bitmaps. Where a user has rows in several unlisted years, which
    other checks report, they are counted one by one instead."""
    if not watch.value("unclear"):
        return {"users": users.by_year(bitmaps), "returning_users": users.returning(bitmaps)}, tuple(watch.lines())
    staged = clean_enrolments(students_raw, settings.non_response)
    landed, watches = _land_watched({
        "users": _Watched(indicators.users_by_year(staged), {"repeated_keys": None}),
        "returning_users": _Watched(counts.returning_users(staged), {}),
    }, settings)
    return landed, _lines(watches)


def _student_models(
    students_raw: DataFrame, landed: Mapping[str, DataFrame], watches: Mapping[str, checks.Watch], settings: Settings
) -> Models:
    cells = counts.identified_cells(landed["cells"])
    of_users, user_lines = _user_models(students_raw, landed["user_bitmaps"], watches["user_bitmaps"], settings)
    in_year = Window.partitionBy("year_started")
    # A year's total, and the one row of the year on which it is checked.
    totals = {
        "total_pct": F.round(F.sum("pct_of_year").over(in_year), 0),
        "_line": F.row_number().over(in_year.orderBy("pct_of_year")),
    }
    first = F.col("_line") == 1
    ages = indicators.age_distribution(cells, settings.band_midpoints)
    regions = indicators.region_distribution(cells, settings.focus_region)
    intermediate, watched = _land_watched({
        "students_by_year": _Watched(
            indicators.headcount_of_cells(cells, of_users["users"], settings.non_response), {"students_by_year": None}),
        "gender_evolution": _Watched(
            indicators.category_evolution(cells, non_response=settings.non_response), {"gender_evolution": None}),
        "age_distribution": _Watched(ages, {"age_distribution": None, "age_share_sums": first}, totals),
        "region_distribution": _Watched(regions, {"region_distribution": None, "region_share_sums": first}, totals),
    }, settings)
    staged = clean_enrolments(students_raw, settings.non_response)
    frames = {"students_raw": students_raw, "stg_students": staged, "cells": cells, **of_users, **intermediate}
    return Models(frames, (*watches["cells"].lines(), *user_lines, *_lines(watched)))


def student_models(students_raw: DataFrame, settings: Settings = Settings()) -> Models:
    """Staging and intermediate models of the enrolments. Runs the two scans."""
    landed, watches = _land_watched(_student_inputs(students_raw, settings), settings)
    return _student_models(students_raw, landed, watches, settings)


def base_models(
    students_raw: DataFrame, population_raw: DataFrame, settings: Settings = Settings()
) -> Models:
    """Staging and intermediate models of both inputs. Runs their scans at the same time."""
    has_benchmark = F.col("ANNEE") == settings.benchmark_year
    if isinstance(settings.band_labels, Mapping):
        has_benchmark &= F.col("AGE_GROUP").isin(*settings.band_labels)
    landed, watches = _land_watched({
        **_student_inputs(students_raw, settings),
        "population_cells": _Watched(
            counts.population_cells(population_raw), {"population_raw": None},
            beside={"benchmark": F.count_if(has_benchmark)}),
    }, settings)
    if not watches["population_cells"].value("benchmark"):
        raise ValueError(f"the population has no benchmark year {settings.benchmark_year}")
    enrolments = _student_models(students_raw, landed, watches, settings)
    population = harmonise_population(landed["population_cells"], settings)
    return Models(
        {**enrolments.frames, "population_raw": population_raw, "stg_population": population},
        (*enrolments.lines, *watches["population_cells"].lines()),
    )


def synthesis_mart(base: Models, settings: Settings = Settings()) -> DataFrame:
    return marts.annual_synthesis(
        base["students_by_year"], base["age_distribution"], base["region_distribution"], settings
    )


def comparison_mart(base: Models, settings: Settings = Settings()) -> DataFrame:
    return compare.comparison_mart(base["cells"], base["stg_population"], settings)


def block_mart(base: Models, comparison: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The block export. Four blocks read the comparison, so pass it as a table."""
    return marts.block_export(
        base["students_by_year"], base["gender_evolution"], base["age_distribution"],
        base["region_distribution"], comparison, settings,
    )


def _ordered(mart: DataFrame, name: str) -> DataFrame:
    """A mart as one ordered partition: it has a row per label and year. In the comparison a
    missing gap comes first, as a largest value would."""
    order = {
        "annual_synthesis": [F.asc_nulls_last("year_started")],
        "comparison_mart": [F.asc_nulls_last("dimension"), F.desc_nulls_first("ecart_pts")],
        "block_export": [F.asc_nulls_last("slide"), F.asc_nulls_last("rang")],
    }
    return mart.repartition(1).sortWithinPartitions(*order[name])


def with_marts(base: Models, settings: Settings = Settings(), folder: str | None = None) -> Models:
    """Add the marts as ordered tables, in `folder` or in the shared one."""

    def write(frames: Mapping[str, DataFrame]) -> tuple[dict[str, DataFrame], tuple[tuple, ...]]:
        watched = {name: _Watched(_ordered(df, name), {name: None}) for name, df in frames.items()}
        landed, watches = _land_watched(watched, settings, folder)
        return landed, _lines(watches)

    first, first_lines = write({
        "comparison_mart": comparison_mart(base, settings), "annual_synthesis": synthesis_mart(base, settings)
    })
    second, second_lines = write({"block_export": block_mart(base, first["comparison_mart"], settings)})
    return Models({**base.frames, **first, **second}, (*base.lines, *first_lines, *second_lines))


def check_summary(models: Models) -> DataFrame:
    """One line per declared check of the given models, as counted when they were written."""
    return checks.summary(models["students_raw"].sparkSession, models.lines)


def build(
    students_raw: DataFrame | str, population_raw: DataFrame | str, out: str, settings: Settings = Settings()
) -> Models:
    """Build, check and publish; the inputs are frames, or names of the catalog (see `catalog.source`). Failing checks of raw, staging and intermediate models stop the run before the
    marts are made. The marts go to a new version under `out`, where no reader looks; failing mart checks, or a
    write that fails, discard it. Then one marker makes all three current at once."""
    students_raw, population_raw = catalog.source(students_raw), catalog.source(population_raw)
    base = base_models(students_raw, population_raw, settings)
    checks.gate(check_summary(base))
    versions = Versions(students_raw.sparkSession, out)
    folder = versions.new_folder()
    try:
        models = with_marts(base, settings, folder)
        made = [line for line in models.lines if line[0] in MARTS]
        checks.gate(checks.summary(students_raw.sparkSession, made))
        versions.publish(folder, MARTS)
    except BaseException:
        versions.discard(folder)
        raise
    return models


def export(models: Models, out: str, rows: bool = False) -> None:
    """Write the block export as one CSV file, and with `rows` also the cleaned enrolments, which are
    personal records and leave only on request, as a folder of ordered parts with a manifest."""
    export_blocks(models["block_export"], f"{out}/block_export.csv")
    if rows:
        export_rows(models["stg_students"], f"{out}/stg_students_csv", EXPORT_KEYS)
