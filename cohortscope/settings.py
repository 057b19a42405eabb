"""Parameters of a profile: vocabularies, reporting years, focus region, benchmark year."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

# --- Fixed values: labels and numbers that results depend on -----------------------------

# The twenty five-year bands of the reference population, youngest first.
POPULATION_BANDS = (
    "0 à 4 ans", "5 à 9 ans", "10 à 14 ans", "15 à 19 ans", "20 à 24 ans",
    "25 à 29 ans", "30 à 34 ans", "35 à 39 ans", "40 à 44 ans", "45 à 49 ans",
    "50 à 54 ans", "55 à 59 ans", "60 à 64 ans", "65 à 69 ans", "70 à 74 ans",
    "75 à 79 ans", "80 à 84 ans", "85 à 89 ans", "90 à 94 ans", "95 ans et plus",
)

# Sex blocks of the wide population extract and the position of each block's first value.
SEX_BLOCKS = {"Ensemble": 1, "Hommes": 22, "Femmes": 43}
WIDE_VALUE_COLUMNS = 63

# Lines of a sheet before its first data line: titles and column names.
HEADER_LINES = 5
NATIONAL_TOTALS = ("France métropolitaine", "France", "France métropolitaine et DOM")
NOTE_PREFIXES = ("Source", "Champ", "Note")

# Population label -> enrolment label. Regions not listed keep their label.
REGION_LABELS = {
    "Centre-Val-de-Loire": "Centre-Val de Loire",
    "Guadeloupe": "DROM",
    "Martinique": "DROM",
    "Guyane": "DROM",
    "La Réunion": "DROM",
    "Mayotte": "DROM",
    "DOM": "DROM",
}

# Sexes and bands not listed have no enrolment label (null).
SEX_LABELS = {"Hommes": "M", "Femmes": "F", "Ensemble": "Ensemble"}
BAND_LABELS = {
    "20 à 24 ans": "20-24 ans",
    "25 à 29 ans": "25-29 ans",
    "30 à 34 ans": "30-34 ans",
    "35 à 39 ans": "35-39 ans",
    "40 à 44 ans": "40-44 ans",
    "45 à 49 ans": "45-49 ans",
    "50 à 54 ans": "50-54 ans",
    "55 à 59 ans": "55-59 ans",
    "60 à 64 ans": "60 ans ou plus",
    "65 à 69 ans": "60 ans ou plus",
    "70 à 74 ans": "60 ans ou plus",
    "75 à 79 ans": "60 ans ou plus",
    "80 à 84 ans": "60 ans ou plus",
    "85 à 89 ans": "60 ans ou plus",
    "90 à 94 ans": "60 ans ou plus",
    "95 ans et plus": "60 ans ou plus",
}

# Age taken for each band when a mean age is estimated.
BAND_MIDPOINTS = {
    "20-24 ans": 22,
    "25-29 ans": 27,
    "30-34 ans": 32,
    "35-39 ans": 37,
    "40-44 ans": 42,
    "45-49 ans": 47,
    "50-54 ans": 52,
    "55-59 ans": 57,
    "60 ans ou plus": 65,
}

MALE, FEMALE, NON_RESPONSE = "M", "F", "Non renseigné"
BOTH_SEXES = "Ensemble"
WOMEN = "Femmes"

FOCUS_REGION = "Île-de-France"
FOCUS_ZONE, OTHER_ZONE = "IDF", "Province"
KEY_BANDS = ("25-29 ans", "30-34 ans", "35-39 ans")
KEY_BANDS_LABEL = "25-39 ans"

DIMENSIONS = ("region", "genre", "age")
BLOCKS = {
    "S08_effectifs_par_annee": 8,
    "S09_parite_homme_femme": 9,
    "S10_distribution_age": 10,
    "S11_evolution_age_top5": 11,
    "S12_repartition_geographique": 12,
    "S13_evolution_pct_idf": 13,
    "S14_S16_comparaison_insee_synthese": 14,
}

# -------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Settings:
    """What a run reports on. The defaults are the published study's."""

    years: tuple[int, ...] = (2022, 2023, 2024, 2025)
    benchmark_year: int = 2023
    focus_region: str = FOCUS_REGION
    key_bands: tuple[str, ...] = KEY_BANDS
    key_bands_label: str = KEY_BANDS_LABEL
    top_bands: int = 5
    non_response: str = NON_RESPONSE
    # Label maps: mappings, or tables with the columns source and target.
    region_labels: Mapping[str, str] | DataFrame = field(default_factory=lambda: dict(REGION_LABELS))
    sex_labels: Mapping[str, str] | DataFrame = field(default_factory=lambda: dict(SEX_LABELS))
    band_labels: Mapping[str, str] | DataFrame = field(default_factory=lambda: dict(BAND_LABELS))
    band_midpoints: Mapping[str, int] = field(default_factory=lambda: dict(BAND_MIDPOINTS))
    # Population labels to leave out, for a source whose 'DOM' row repeats the single territories.
    drop_regions: tuple[str, ...] = ()

    @property
    def genders(self) -> tuple[str, str, str]:
        return (MALE, FEMALE, self.non_response)
