"""Data-quality checks.

Each check function returns the violating rows, so an empty frame passes. The violations of many declared checks
are counted in the pass that writes a frame (`Watch`), or by `summarise` in one aggregation per model.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cohortscope.settings import BLOCKS, DIMENSIONS, Settings

#: Columns of a summary: one line per declared check.
SUMMARY = "model string, kind string, column string, nb_failures bigint, example string, passed boolean"


class GateFailure(Exception):
    """Declared checks found violations; nothing built on the data should be trusted."""


# --- Violating rows ------------------------------------------------------------------------


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a null in any of the columns."""
    return df.where(reduce(Column.__or__, [F.col(c).isNull() for c in columns]))


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list with their row counts; null is no violation."""
    return (
        df.where(~F.col(column).isin(*values))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("nb_rows"))
    )


def unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with how often."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("nb_occurrences")).where("nb_occurrences > 1")


def in_range(df: DataFrame, column: str, low, high) -> DataFrame:
    """Rows above or below the range."""
    return df.where((F.col(column) > high) | (F.col(column) < low))


def sums_to_100(
    df: DataFrame, by: str = "year_started", pct: str = "pct_of_year", low: int = 99, high: int = 101
) -> DataFrame:
    """Groups whose rounded sum of shares is outside the tolerance."""
    return (
        df.groupBy(by).agg(F.round(F.sum(pct), 0).alias("total_pct"))
        .where((F.col("total_pct") < low) | (F.col("total_pct") > high))
    )


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls per column, all columns in one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).alias("nb_null")) for c in columns]
    return counted.select(F.inline(F.array(*pairs)))


# --- Declared checks -----------------------------------------------------------------------


@dataclass(frozen=True)
class Check:
    model: str
    kind: str
    column: str
    violation: Column
    weight: str | None = None
    shows: str | None = None

    def failures(self, rows: Column | None = None) -> Column:
        """The violations among all rows, or among those that meet `rows`."""
        found = self.violation if rows is None else rows & self.violation
        if self.weight:
            return F.coalesce(F.sum(F.when(found, F.col(self.weight))), F.lit(0)).cast("bigint")
        return F.count_if(found)

    def example(self, rows: Column | None = None) -> Column:
        """The least offending value, where a value offends."""
        shown = F.col(self.shows) if self.shows else F.lit(None)
        return F.min(F.when(self.violation if rows is None else rows & self.violation, shown.cast("string")))

    def line(self, failures: int, example: str | None) -> tuple:
        """This check's line of a summary."""
        return self.model, self.kind, self.column, failures, example, failures == 0


# Model names, columns and kinds of the declared checks.


def declared_checks(settings: Settings = Settings()) -> list[Check]:
    """The forty checks of the pipeline.

    `students_raw` and `stg_students` are checked on counted cells (weight `nb_students`), `population_raw` on
    counted population cells; `repeated_keys` and the share sums on rows that carry a year's count or total.
    """
    not_null_columns = {
        "students_raw": ("USER_ID", "AGE_GROUP", "REGION", "YEAR_PATH_STARTED"),
        "population_raw": ("REGION", "SEXE", "AGE_GROUP", "POPULATION", "ANNEE"),
        "stg_students": ("USER_ID", "gender", "year_started", "age_group", "region"),
        "students_by_year": ("year_started", "nb_students"),
        "age_distribution": ("year_started", "pct_of_year"),
        "region_distribution": ("year_started", "region"),
        "gender_evolution": ("gender",),
        "annual_synthesis": ("year_started", "nb_students"),
        "comparison_mart": ("dimension",),
        "block_export": ("slide", "source_table", "dimension", "rang"),
    }
    accepted = (
        ("stg_students", "gender", settings.genders),
        ("stg_students", "year_started", settings.years),
        ("students_by_year", "year_started", settings.years),
        ("gender_evolution", "gender", settings.genders),
        ("annual_synthesis", "year_started", settings.years),
        ("comparison_mart", "dimension", DIMENSIONS),
        ("block_export", "slide", tuple(BLOCKS.values())),
        ("block_export", "source_table", tuple(BLOCKS)),
    )
    counted = {"students_raw": "nb_students", "stg_students": "nb_students", "population_raw": "nb_rows"}
    year, total = F.col("year_started"), F.col("total_pct")
    return [
        *(
            Check(model, "not_null", column, F.col(column).isNull(), counted.get(model))
            for model, columns in not_null_columns.items()
            for column in columns
        ),
        *(
            Check(model, "accepted_values", column, ~F.col(column).isin(*values), counted.get(model), column)
            for model, column, values in accepted
        ),
        Check("stg_students", "range", "year_started",
              (year > max(settings.years)) | (year < min(settings.years)),
              "nb_students", "year_started"),
        Check("repeated_keys", "unique", "USER_ID, year_started", F.col("nb_repeated_keys") > 0,
              "nb_repeated_keys", "year_started"),
        *(
            Check(model, "sum_100", "pct_of_year", (total < 99) | (total > 101), None, "year_started")
            for model in ("age_share_sums", "region_share_sums")
        ),
    ]


class Watch:
    """Counts declared checks while a frame is written, so that the written table is not read for them.

    `models` names the models that the frame stands for and, for each, which of its rows are the model's (None: all).
    The frame has the columns that their checks name; `beside` counts further things by name. The counts are taken
    in the write's last stage, where Spark takes in each task once, also after a task or an executor is lost.
    """

    def __init__(self, models: Mapping[str, Column | None], checks: Iterable[Check],
                 beside: Mapping[str, Column] | None = None):
        self.checks = [check for check in checks if check.model in models]
        self.models, self.beside = models, dict(beside or {})
        self._observation = Observation()

    def over(self, df: DataFrame) -> DataFrame:
        """The frame to write. A watch serves one write."""
        counted = [c for i, check in enumerate(self.checks) for c in (
            check.failures(self.models[check.model]).alias(f"f{i}"),
            check.example(self.models[check.model]).alias(f"e{i}"))]
        counted += [c.alias(name) for name, c in self.beside.items()]
        return df.observe(self._observation, *counted) if counted else df

    def lines(self) -> list[tuple]:
        """After the write: a summary's line for each check."""
        if not self.checks:
            return []
        found = self._observation.get
        return [check.line(found.get(f"f{i}") or 0, found.get(f"e{i}")) for i, check in enumerate(self.checks)]

    def value(self, name: str):
        """After the write: what was counted beside the checks."""
        return self._observation.get.get(name)


def summary(spark: SparkSession, lines: Sequence[tuple]) -> DataFrame:
    """The lines of watches, one per declared check, as a frame."""
    return spark.createDataFrame(sorted(lines, key=lambda line: line[:3]), SUMMARY)


def share_sums(df: DataFrame) -> DataFrame:
    """The rounded sum of shares of each year."""
    return df.groupBy("year_started").agg(F.round(F.sum("pct_of_year"), 0).alias("total_pct"))


def summarise(models: Mapping[str, DataFrame], checks: Iterable[Check]) -> DataFrame:
    """Violations of every check whose model is given: one line per check, one pass per model."""
    lines = []
    for model, df in models.items():
        own = [check for check in checks if check.model == model]
        if not own:
            continue
        counted = df.agg(
            *[check.failures().alias(f"f{i}") for i, check in enumerate(own)],
            *[check.example().alias(f"e{i}") for i, check in enumerate(own)],
        )
        structs = [
            F.struct(
                F.lit(check.model).alias("model"),
                F.lit(check.kind).alias("kind"),
                F.lit(check.column).alias("column"),
                F.col(f"f{i}").alias("nb_failures"),
                F.col(f"e{i}").alias("example"),
            )
            for i, check in enumerate(own)
        ]
        lines.append(counted.select(F.inline(F.array(*structs))))
    return reduce(DataFrame.unionByName, lines).withColumn("passed", F.col("nb_failures") == 0)


def gate(summary: DataFrame) -> None:
    """Raise when a check has violations. The summary has one line per declared check."""
    failed = summary.where(~F.col("passed")).orderBy("model", "kind", "column").collect()
    if failed:
        raise GateFailure("; ".join(
            f"{line['kind']}({line['model']}.{line['column']}): {line['nb_failures']}"
            + (f", such as {line['example']}" if line["example"] is not None else "")
            for line in failed
        ))


def reconcile(actual: DataFrame, expected: Mapping[str, int]) -> DataFrame:
    """Named counts (`metric`, `value`) beside their expected values; either side may lack one."""
    listed = F.explode(F.map_from_arrays(
        F.array(*[F.lit(name) for name in expected]), F.array(*[F.lit(n).cast("bigint") for n in expected.values()])
    )).alias("metric", "expected")
    wanted = actual.sparkSession.range(0, 1, 1, 1).select(listed)
    return (
        actual.select("metric", F.col("value").cast("bigint").alias("actual"))
        .join(wanted, "metric", "full_outer")
        .select("metric", "actual", "expected", F.col("actual").eqNullSafe(F.col("expected")).alias("matches"))
    )
