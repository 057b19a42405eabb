"""From yearly wide sheets to one long population table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from cohortscope.schemas import WIDE_COLUMNS
from cohortscope.settings import HEADER_LINES, NATIONAL_TOTALS, NOTE_PREFIXES, POPULATION_BANDS, SEX_BLOCKS


def select_years(wide: DataFrame, years: Sequence[int]) -> DataFrame:
    """Only the rows of the reporting years."""
    return wide.where(F.col("year").isin(*years))


def require_years(wide: DataFrame, years: Sequence[int]) -> DataFrame:
    """The reporting years; a year without a sheet fails. Looks at the listed years only."""
    chosen = select_years(wide, years)
    missing = set(years) - {row["year"] for row in chosen.select("year").distinct().collect()}
    if missing:
        raise ValueError(f"no sheet for {', '.join(map(str, sorted(missing)))}")
    return chosen


def _text_cells(wide: DataFrame) -> bool:
    return any(f.name in WIDE_COLUMNS and isinstance(f.dataType, StringType) for f in wide.schema)


def filter_footnotes(wide: DataFrame, header_lines: int = HEADER_LINES) -> DataFrame:
    """Keep region rows: no header lines, blank regions, national totals or notes.

    Header lines are the first of a sheet, whatever stands in them; they go by the column `line`. A frame without
    that column has no header. Only the region and the line are looked at, so planning does not grow with the cells.
    """
    region = F.col("region")
    note = F.lit(False)
    for prefix in NOTE_PREFIXES:
        note = note | region.startswith(prefix)
    rows = wide.where((region != "") & ~region.isin(*NATIONAL_TOTALS) & ~note)
    return rows.where(F.col("line") > header_lines) if "line" in wide.columns else rows


def unpivot_population(wide: DataFrame, years: Sequence[int]) -> DataFrame:
    """One row per region, sex, band and year; totals columns and empty cells are left out and
    numbers truncated. A cell that is neither empty nor a number fails the run.

    A narrow operation: every input row becomes at most 60 output rows, without a shuffle.
    """
    text = _text_cells(wide)
    number = "CAST(cell AS DOUBLE)" if text else "cell"
    cells = ", ".join(
        f"'{sex}', '{band}', " + (f"CAST(c{first + i} AS STRING)" if text else f"c{first + i}")
        for sex, first in SEX_BLOCKS.items()
        for i, band in enumerate(POPULATION_BANDS)
    )
    return (
        filter_footnotes(require_years(wide, years))
        .selectExpr(
            "region",
            f"stack({len(SEX_BLOCKS) * len(POPULATION_BANDS)}, {cells}) AS (SEXE, AGE_GROUP, cell)",
            "year",
        )
        .where("cell IS NOT NULL")
        .selectExpr(
            "region AS REGION", "SEXE", "AGE_GROUP", f"CAST({number} AS BIGINT) AS POPULATION", "year AS ANNEE"
        )
    )
