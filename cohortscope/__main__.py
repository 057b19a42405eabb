"""Command line: reshape yearly sheets, build and check the marts, export them."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from cohortscope.operators.counts import distinct_values
from cohortscope.operators.reshape import unpivot_population
from cohortscope.plans import build
from cohortscope.plans.reports import reports
from cohortscope.settings import Settings
from cohortscope.sources import files
from cohortscope.sources.shared import scratch_folder


def _arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    defaults = Settings()
    parser = argparse.ArgumentParser(prog="cohortscope", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    reshape = commands.add_parser("reshape", help="yearly wide sheets to one long CSV")
    reshape.add_argument("--sheets", required=True, help="folder of year=YYYY/ CSV sheets")

    marts = commands.add_parser("build", help="check the inputs and write the mart tables")
    marts.add_argument("--students", required=True, help="enrolment CSV")
    marts.add_argument("--population", required=True, help="long population CSV")
    marts.add_argument("--benchmark-year", type=int, default=defaults.benchmark_year)
    marts.add_argument("--focus-region", default=defaults.focus_region)
    marts.add_argument("--drop-region", action="append", default=[], help="population label to leave out")
    marts.add_argument("--report", action="store_true", help="print the verification reports")
    marts.add_argument("--export", action="store_true", help="also write the block export as CSV")
    marts.add_argument("--export-rows", action="store_true", help="also write cleaned enrolments as CSV")

    for command in (reshape, marts):
        command.add_argument("--out", required=True)
        command.add_argument("--years", type=int, nargs="+", default=list(defaults.years))
    return parser.parse_args(argv)


def _print(df: DataFrame) -> None:
    """Every line, however many: lines come to the driver one partition at a time."""
    print(" | ".join(df.columns))
    for row in df.toLocalIterator():
        print(" | ".join("" if value is None else str(value) for value in row))


def _reshape(spark: SparkSession, args: argparse.Namespace) -> None:
    files.write_csv(unpivot_population(files.read_population_wide(spark, args.sheets, args.years), args.years), args.out)
    written = files.read_population(spark, args.out)
    _print(distinct_values(written, ["REGION", "SEXE", "ANNEE"]).orderBy("attribute", "value"))


def _build(spark: SparkSession, args: argparse.Namespace) -> None:
    settings = Settings(
        years=tuple(args.years),
        benchmark_year=args.benchmark_year,
        focus_region=args.focus_region,
        drop_regions=tuple(args.drop_region),
    )
    # Text is parsed once; the models then scan columns of the tables. The rows are personal, so they stay in a
    # scratch folder and go when the run ends, also when a check fails.
    with scratch_folder(spark) as folder:
        students = files.write_table(files.read_students(spark, args.students), f"{folder}/students_raw")
        population = files.write_table(files.read_population(spark, args.population), f"{folder}/population_raw")
        models = build.build(students, population, args.out, settings)
        if args.report:
            for name, df in reports(models, settings).items():
                print(f"\n{name}")
                _print(df)
        if args.export or args.export_rows:
            build.export(models, args.out, rows=args.export_rows)


def main(argv: Sequence[str] | None = None) -> None:
    args = _arguments(argv)
    spark = SparkSession.builder.appName(f"cohortscope-{args.command}").getOrCreate()
    {"reshape": _reshape, "build": _build}[args.command](spark, args)


if __name__ == "__main__":
    main()
