import time

import pytest
from helpers import rows
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from cohortscope.operators.reshape import filter_footnotes, unpivot_population
from cohortscope.schemas import POPULATION_WIDE, WIDE_COLUMNS
from cohortscope.settings import POPULATION_BANDS
from cohortscope.sources import derived, files


def sheet_row(region, year, cells=None, line=9):
    cells = cells or {}
    return (region, *[cells.get(c) for c in WIDE_COLUMNS], year, line)


def sheet_frame(spark, rows):
    return spark.createDataFrame(rows, StructType([*POPULATION_WIDE.fields, StructField("line", IntegerType())]))


@pytest.fixture
def wide(spark):
    numbers = {c: str(i) for i, c in enumerate(WIDE_COLUMNS, 1)}
    return sheet_frame(spark, [
        *[row for year in (2010, 2023) for row in (
            sheet_row("Estimation de population", year, line=1),
            sheet_row("", year, line=2),
            sheet_row("Titre", year, line=3),
            sheet_row("Édition", year, {"c1": "2023.5", "c2": "12"}, line=4),
            sheet_row("Régions", year, {c: "0 à 4 ans" for c in WIDE_COLUMNS}, line=5),
        )],
        sheet_row("Corse", 2023, {**numbers, "c1": "1.9", "c2": None}, line=6),
        sheet_row("DOM", 2023, {"c43": "7"}),
        sheet_row("Bretagne", 2010, numbers),
        sheet_row("France", 2023, numbers),
        sheet_row("France métropolitaine", 2023, numbers),
        sheet_row("France métropolitaine et DOM", 2023, numbers),
        sheet_row("", 2023, numbers),
        sheet_row(None, 2023, numbers),
        sheet_row("Source : estimations", 2023, numbers),
        sheet_row("Champ", 2023, numbers),
        sheet_row("Notes", 2023, numbers),
    ])


def test_only_region_rows_stay(wide):
    assert rows(filter_footnotes(wide), "region") == [("Bretagne",), ("Corse",), ("DOM",)]


def test_unpivot_skips_totals_and_empty_cells_and_truncates(wide):
    long = unpivot_population(wide, [2023])
    assert long.columns == ["REGION", "SEXE", "AGE_GROUP", "POPULATION", "ANNEE"]
    assert dict(long.dtypes)["POPULATION"] == "bigint"
    corse = {(s, a): p for _, s, a, p, _ in rows(long.where(F.col("REGION") == "Corse"))}
    expected = {}
    for sex, first in (("Ensemble", 1), ("Hommes", 22), ("Femmes", 43)):
        expected.update({(sex, band): first + i for i, band in enumerate(POPULATION_BANDS)})
    del expected["Ensemble", "5 à 9 ans"]
    assert corse == expected
    assert rows(long.where(F.col("REGION") == "DOM")) == [("DOM", "Femmes", "0 à 4 ans", 7, 2023)]
    assert set(rows(long, "ANNEE")) == {(2023,)}


def test_numeric_cells_need_no_parsing(wide):
    doubles = wide.where("line > 5").select(
        "region", *[F.col(c).cast("double").alias(c) for c in WIDE_COLUMNS], "year", "line")
    assert rows(unpivot_population(doubles, [2023])) == rows(unpivot_population(wide, [2023]))


def test_a_bad_cell_in_a_region_row_fails(spark):
    df = sheet_frame(spark, [sheet_row("Corse", 2023, {"c1": "5", "c2": "n.d."})])
    with pytest.raises(Exception, match="n.d."):
        unpivot_population(df, [2023]).collect()


def test_a_row_of_texts_is_no_heading(spark):
    df = sheet_frame(spark, [sheet_row("Corse", 2023, {c: "nd" for c in WIDE_COLUMNS})])
    with pytest.raises(Exception, match="nd"):
        unpivot_population(df, [2023]).collect()


def test_decimals_are_cut_off(spark):
    df = sheet_frame(spark, [sheet_row("Corse", 2023, {"c1": "12.9999999999", "c2": "7.5"})])
    assert set(rows(unpivot_population(df, [2023]), "POPULATION")) == {(12,), (7,)}


def test_a_missing_sheet_fails(wide):
    with pytest.raises(ValueError, match="2022, 2024"):
        unpivot_population(wide, [2022, 2023, 2024])


@pytest.mark.parametrize("fields", [41, 63, 65, 71])
def test_rows_of_another_width_fail(spark, tmp_path, fields):
    folder = tmp_path / "sheets" / "year=2023"
    folder.mkdir(parents=True)
    (folder / "sheet.csv").write_text(",".join(["Corse", *["1"] * (fields - 1)]) + "\n", encoding="utf-8")
    sheets = files.read_population_wide(spark, str(tmp_path / "sheets"))
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        unpivot_population(sheets, [2023]).collect()


def test_unread_years_are_pruned(spark, wide, tmp_path):
    path = str(tmp_path / "sheets")
    files.write_sheets(wide, path)
    sheets = files.read_population_wide(spark, path)
    assert rows(unpivot_population(sheets, [2010, 2023])) == rows(unpivot_population(wide, [2010, 2023]))
    scan = files.read_population_wide(spark, path, [2023])._jdf.queryExecution().executedPlan().toString()
    assert "2023" in scan.split("PartitionFilters: [")[1].split("]")[0]


def test_reshaping_needs_no_shuffle(wide):
    assert "Exchange" not in unpivot_population(wide, [2023])._jdf.queryExecution().executedPlan().toString()


def test_a_frame_without_lines_has_no_header(wide):
    assert rows(filter_footnotes(wide.drop("line").where("region IN ('Corse', 'France')")), "region") == [("Corse",)]


def sheet_file(folder, year, first_lines, regions):
    target = folder / f"year={year}"
    target.mkdir(parents=True)
    lines = [",".join([text, *["2023.0"] * 63]) for text in first_lines]
    lines += [",".join([region, *[f"{n}.9"] * 63]) for n, region in enumerate(regions, 1)]
    (target / "sheet.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")


def test_header_lines_go_by_their_place_in_the_file(spark, tmp_path):
    header = ["Titre", "Population", "", "Édition 2023", "Régions"]
    sheet_file(tmp_path, 2023, header, ["Corse", "Bretagne", "France"])
    sheet_file(tmp_path, 2024, header, ["Mayotte"])
    sheets = files.read_population_wide(spark, str(tmp_path))
    assert rows(sheets.where("year = 2023"), "line", "region")[3] == (4, "Édition 2023")
    long = unpivot_population(sheets, [2023, 2024])
    assert rows(long.select("REGION", "POPULATION", "ANNEE").distinct()) == [
        ("Bretagne", 2, 2023), ("Corse", 1, 2023), ("Mayotte", 1, 2024)]


def test_lines_are_counted_over_line_breaks_in_cells(spark, tmp_path):
    sheet_file(tmp_path, 2023, ['"Titre\nsur deux lignes"', "a", "b", "c", '"Régions\n\n(2023)"'], ["Corse"])
    sheets = files.read_population_wide(spark, str(tmp_path))
    assert rows(filter_footnotes(sheets), "region", "line") == [("Corse", 6)]


def test_lines_do_not_depend_on_how_files_are_dealt_to_tasks(spark, tmp_path):
    for year in range(2000, 2012):
        sheet_file(tmp_path, year, ["t"] * 5, [f"Région {i}" for i in range(year - 1990)])
    expected = [(f"Région {i}", i + 6, year) for year in range(2000, 2012) for i in range(year - 1990)]
    for size in ("1k", "64m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            sheets = filter_footnotes(files.read_population_wide(spark, str(tmp_path)))
            assert sorted(tuple(r) for r in sheets.select("region", "line", "year").collect()) == sorted(expected)
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_planning_of_a_computed_sheet_takes_seconds(spark, sf_dir):
    wide = derived.population_wide(derived.population_raw(spark, sf_dir))
    start = time.perf_counter()
    renamed = filter_footnotes(wide).select("region", *[F.col(c).cast("double").alias(f"x_{c}") for c in WIDE_COLUMNS])
    renamed._jdf.queryExecution().executedPlan()
    assert time.perf_counter() - start < 30
