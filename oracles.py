"""Independent SQL for every registered query, over the same Parquet tables.

Shares are computed in whole tenths with integer division, so halves round exactly:
round(100 * n / t, 1) is floor((2000 * n + t) / (2 * t)) tenths.
"""

from __future__ import annotations

YEARS = tuple(range(1995, 2002))
BENCHMARK_YEAR = 1997
SHEET_YEARS = (1996, 1997, 1998, 1999)
FOCUS = "Île-de-France"
SILENT = "Non renseigné"

_BANDS_20 = [f"{a} à {a + 4} ans" for a in range(0, 95, 5)] + ["95 ans et plus"]
_BAND_OF_CODE = (
    ["20-24 ans"] * 2 + ["25-29 ans"] * 4 + ["30-34 ans"] * 5 + ["35-39 ans"] * 3
    + ["40-44 ans"] * 2 + ["45-49 ans", "50-54 ans", "55-59 ans", "60 ans ou plus"]
)
_SOURCE_REGIONS = [
    FOCUS, "Centre-Val-de-Loire", "Corse", "Guadeloupe", "Martinique", "Guyane", "La Réunion", "Mayotte", "DOM",
]


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def tenths(part: str, whole: str) -> str:
    return f"CAST((2000 * ({part}) + ({whole})) // (2 * nullif({whole}, 0)) AS BIGINT)"


_ENROLMENT_COLUMNS = f"""
        CASE WHEN ck % 211 <> 7 THEN 'u' || ck END AS USER_ID,
        'Data' AS PATH_CATEGORY_NAME,
        ' ' || ({_list(_BAND_OF_CODE)})[ck % 20 + 1] || ' ' AS AGE_GROUP,
        CASE WHEN (ck + y) % 10 < 2001 - y THEN if(ck % 2 = 0, NULL, '  ')
             ELSE if(ck % 3 = 0, 'F ', ' M') END AS GENDER,
        CASE WHEN rk IN (0, 2) THEN '{FOCUS}' WHEN rk = 1 THEN 'Centre-Val de Loire'
             WHEN rk BETWEEN 3 AND 8 THEN 'DROM' ELSE 'NATION_' || rk END AS REGION,
        y AS YEAR_PATH_STARTED"""

_ENROLMENT_SOURCE = """
        (SELECT o_custkey AS ck, c_nationkey % 19 AS rk, CAST(year(o_orderdate) AS INTEGER) AS y
         FROM orders JOIN customer ON c_custkey = o_custkey)"""


_MIDPOINT = "if(age_group = '60 ans ou plus', 65, CAST(left(age_group, 2) AS INTEGER) + 2)"


def _yearly(label: str) -> str:
    """Count, total, share and rank of each label of each year."""
    return f"""
        SELECT *, {tenths('n', 'total')} AS pct10,
               1 + (SELECT count(*) FROM {label}_counts AS other
                    WHERE other.year_started = c.year_started AND other.n > c.n) AS rang
        FROM {label}_counts AS c
        JOIN (SELECT year_started, CAST(sum(n) AS BIGINT) AS total FROM {label}_counts GROUP BY year_started)
          USING (year_started)"""


_BLOCK_NAMES = {
    8: "S08_effectifs_par_annee",
    9: "S09_parite_homme_femme",
    10: "S10_distribution_age",
    11: "S11_evolution_age_top5",
    12: "S12_repartition_geographique",
    13: "S13_evolution_pct_idf",
    14: "S14_S16_comparaison_insee_synthese",
}


def _blocks() -> str:
    """The lines of the seven blocks, values in tenths, each block numbered in its own order."""
    return f"""
        SELECT slide, source_table, dimension, CAST(detail AS VARCHAR) AS detail, a / 10.0 AS valeur,
               b / 10.0 AS valeur_2, c / 10.0 AS ecart, CAST(line AS BIGINT) AS rang
        FROM (
            SELECT 8 AS slide, '{_BLOCK_NAMES[8]}' AS source_table, year_started::VARCHAR AS dimension,
                   NULL AS detail, nb_students * 10 AS a, NULL AS b, NULL AS c,
                   rank() OVER (ORDER BY year_started) AS line
            FROM headcount
            UNION ALL
            SELECT 9, '{_BLOCK_NAMES[9]}', year_started::VARCHAR, gender, n * 10, pct10, NULL,
                   rank() OVER (PARTITION BY year_started ORDER BY gender)
            FROM genders
            UNION ALL
            SELECT 10, '{_BLOCK_NAMES[10]}', 'global', detail, oc10, insee10, gap10, rank() OVER (ORDER BY detail)
            FROM compared WHERE dimension = 'age'
            UNION ALL
            SELECT 11, '{_BLOCK_NAMES[11]}', year_started::VARCHAR, age_group, pct10, NULL, NULL,
                   rank() OVER (ORDER BY year_started, pct10 DESC, age_group)
            FROM ages WHERE rang < 6
            UNION ALL
            SELECT 12, '{_BLOCK_NAMES[12]}', 'global', detail, oc10, insee10, gap10,
                   rank() OVER (ORDER BY oc10 IS NULL, oc10 DESC, detail)
            FROM compared WHERE dimension = 'region'
            UNION ALL
            SELECT 13, '{_BLOCK_NAMES[13]}', year_started::VARCHAR, region, pct10, NULL, NULL,
                   rank() OVER (ORDER BY year_started)
            FROM regions WHERE region = '{FOCUS}'
            UNION ALL
            SELECT 14, '{_BLOCK_NAMES[14]}', dimension, detail, oc10, insee10, gap10,
                   list_position(['genre', 'region', 'age'], dimension)
            FROM (FROM headlines UNION ALL BY NAME FROM key_bands)
        ) AS lines"""


# Named building blocks in dependency order: name -> (needs, SQL).
_PARTS: dict[str, tuple[tuple[str, ...], str]] = {
    "students_raw": ((), f"SELECT DISTINCT {_ENROLMENT_COLUMNS} FROM {_ENROLMENT_SOURCE}"),
    "stg_students": (("students_raw",), f"""
        SELECT USER_ID, PATH_CATEGORY_NAME, trim(AGE_GROUP) AS age_group,
               coalesce(nullif(trim(GENDER), ''), '{SILENT}') AS gender,
               trim(REGION) AS region, YEAR_PATH_STARTED AS year_started
        FROM students_raw WHERE USER_ID IS NOT NULL"""),
    "population_by_sex": ((), f"""
        SELECT coalesce(({_list(_SOURCE_REGIONS)})[s_nationkey % 19 + 1], 'NATION_' || s_nationkey % 19) AS REGION,
               if(l_linenumber % 2 = 0, 'Femmes', 'Hommes') AS SEXE,
               ({_list(_BANDS_20)})[l_partkey % 20 + 1] AS AGE_GROUP,
               CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS POPULATION,
               CAST(year(l_shipdate) AS INTEGER) AS ANNEE
        FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY ALL"""),
    "population_raw": (("population_by_sex",), """
        SELECT * FROM population_by_sex
        UNION ALL
        SELECT REGION, 'Ensemble', AGE_GROUP, CAST(sum(POPULATION) AS BIGINT), ANNEE
        FROM population_by_sex GROUP BY REGION, AGE_GROUP, ANNEE"""),
    "labelled": (("population_raw",), f"""
        SELECT *, if(REGION = 'Centre-Val-de-Loire', 'Centre-Val de Loire',
                     if(list_contains({_list(_SOURCE_REGIONS[3:])}, REGION), 'DROM', REGION)) AS to_region,
               map {{'Hommes': 'M', 'Femmes': 'F', 'Ensemble': 'Ensemble'}}[SEXE] AS to_sexe,
               if(list_position({_list(_BANDS_20)}, AGE_GROUP) > 12, '60 ans ou plus',
                  if(list_position({_list(_BANDS_20)}, AGE_GROUP) > 4,
                     replace(AGE_GROUP, ' à ', '-'), NULL)) AS to_band
        FROM population_raw"""),
    "stg_population": (("labelled",), """
        SELECT to_region AS region, to_sexe AS sexe, to_band AS age_group,
               CAST(sum(POPULATION) AS BIGINT) AS population, ANNEE AS annee
        FROM labelled WHERE to_band IS NOT NULL GROUP BY ALL"""),
    "headcount": (("stg_students",), f"""
        SELECT *, {tenths('nb_nr', 'nb_students')} AS silent10,
               {tenths('nb_female', '(nb_male + nb_female)')} AS female10
        FROM (SELECT year_started, count(*) AS nb_students, count(DISTINCT USER_ID) AS nb_students_distincts,
                     count(*) FILTER (gender = 'M') AS nb_male, count(*) FILTER (gender = 'F') AS nb_female,
                     count(*) FILTER (gender = '{SILENT}') AS nb_nr
              FROM stg_students GROUP BY year_started)"""),
    "gender_counts": (("stg_students",),
                      "SELECT year_started, gender, count(*) AS n FROM stg_students GROUP BY ALL"),
    "genders": (("gender_counts",), f"""
        SELECT year_started, gender, n, total, {tenths('n', 'total')} AS pct10,
               if(gender = '{SILENT}', NULL, {tenths('n', 'answered')}) AS declared10
        FROM gender_counts JOIN (
            SELECT year_started, CAST(sum(n) AS BIGINT) AS total,
                   CAST(sum(n) FILTER (gender <> '{SILENT}') AS BIGINT) AS answered
            FROM gender_counts GROUP BY year_started) USING (year_started)"""),
    "age_counts": (("stg_students",),
                   "SELECT year_started, age_group, count(*) AS n FROM stg_students GROUP BY ALL"),
    "ages": (("age_counts",), _yearly("age")),
    "means": (("stg_students",), f"""
        SELECT year_started, ((20 * s + c) // (2 * c)) / 10.0 AS age_moyen_approx
        FROM (SELECT year_started, CAST(sum({_MIDPOINT}) AS BIGINT) AS s, count(*) AS c
              FROM stg_students GROUP BY year_started)"""),
    "region_counts": (("stg_students",),
                      "SELECT year_started, region, count(*) AS n FROM stg_students GROUP BY ALL"),
    "regions": (("region_counts",), _yearly("region")),
    "observed": (("stg_students",), f"""
        SELECT dimension, detail, n AS nb_oc, {tenths('n', 'whole')} AS oc10
        FROM (SELECT 'region' AS dimension, region AS detail, count(*) AS n,
                     (SELECT count(*) FROM stg_students) AS whole FROM stg_students GROUP BY region
              UNION ALL
              SELECT 'age', age_group, count(*), (SELECT count(*) FROM stg_students)
              FROM stg_students GROUP BY age_group
              UNION ALL
              SELECT 'genre', 'Femmes', count(*) FILTER (gender = 'F'), count(*) FILTER (gender <> '{SILENT}')
              FROM stg_students)"""),
    "benchmark_rows": (("stg_population",), f"SELECT * FROM stg_population WHERE annee = {BENCHMARK_YEAR}"),
    "benchmark_shares": (("benchmark_rows",), f"""
        SELECT dimension, detail, n AS pop_insee, {tenths('n', 'whole')} AS insee10
        FROM (SELECT dimension, detail, CAST(sum(n) AS BIGINT) AS n, whole
              FROM (SELECT unnest([{{'dimension': 'region', 'detail': region}},
                                   {{'dimension': 'age', 'detail': age_group}}], recursive := true),
                           population AS n
                    FROM benchmark_rows WHERE sexe = 'Ensemble'
                    UNION ALL
                    SELECT 'genre', 'Femmes', population FROM benchmark_rows WHERE sexe = 'F')
              CROSS JOIN (SELECT CAST(sum(population) AS BIGINT) AS whole
                          FROM benchmark_rows WHERE sexe = 'Ensemble')
              GROUP BY ALL)"""),
    "compared": (("observed", "benchmark_shares"), """
        SELECT coalesce(o.dimension, b.dimension) AS dimension, coalesce(o.detail, b.detail) AS detail,
               nb_oc, oc10, pop_insee, insee10, oc10 - insee10 AS gap10,
               (200 * oc10 + insee10) // (2 * nullif(insee10, 0)) AS ratio100
        FROM observed AS o FULL JOIN benchmark_shares AS b
          ON b.dimension = o.dimension AND b.detail = o.detail"""),
    "mart": (("compared",), """
        SELECT dimension, detail, oc10 / 10.0 AS pct_oc, insee10 / 10.0 AS pct_insee,
               gap10 / 10.0 AS ecart_pts, if(dimension = 'region', ratio100 / 100.0, NULL) AS ratio
        FROM compared"""),
    "key_bands": (("compared",), """
        SELECT 'age' AS dimension, '25-39 ans' AS detail, CAST(sum(oc10) AS BIGINT) AS oc10,
               CAST(sum(insee10) AS BIGINT) AS insee10, CAST(sum(oc10) - sum(insee10) AS BIGINT) AS gap10
        FROM compared WHERE dimension = 'age' AND left(detail, 2) IN ('25', '30', '35')"""),
    "headlines": (("compared",), f"""
        SELECT dimension, detail, oc10, insee10, gap10 FROM compared
        WHERE (dimension, detail) IN (('genre', 'Femmes'), ('region', '{FOCUS}'))"""),
    "synthesis": (("headcount", "regions", "ages"), f"""
        SELECT h.year_started, nb_students, nb_students_distincts, nb_male, nb_female, nb_nr,
               silent10 / 10.0 AS taux_non_reponse, female10 / 10.0 AS pct_female_among_declared,
               lead.region AS top_region, lead.pct10 / 10.0 AS pct_top_region, f.pct10 / 10.0 AS pct_idf,
               band.age_group AS top_age_group, band.pct10 / 10.0 AS pct_top_age
        FROM headcount AS h
        LEFT JOIN (FROM regions WHERE rang = 1) AS lead USING (year_started)
        LEFT JOIN (FROM ages WHERE rang = 1) AS band USING (year_started)
        LEFT JOIN (FROM regions WHERE region = '{FOCUS}') AS f USING (year_started)"""),
    "blocks": (("headcount", "genders", "ages", "regions", "compared", "key_bands", "headlines"), _blocks()),
    "block_lines": (("blocks",),
                    "SELECT slide, source_table, count(*) AS nb_lignes FROM blocks GROUP BY ALL"),
}


def _with(main: str, *parts: str, instead: dict[str, tuple[tuple[str, ...], str]] | None = None) -> str:
    """`main` preceded by the building blocks it needs; `instead` replaces some of them."""
    wanted: dict[str, str] = {}
    known = _PARTS | (instead or {})

    def add(name: str) -> None:
        if name not in wanted:
            needs, body = known[name]
            for need in needs:
                add(need)
            wanted[name] = body

    for part in parts:
        add(part)
    ctes = ",\n".join(f"    {name} AS MATERIALIZED ({body})" for name, body in wanted.items())
    return f"WITH\n{ctes}\n{main}"


def _years(years) -> str:
    return ", ".join(str(y) for y in years)


def _check_lines(sources: tuple[str, ...]) -> str:
    """Model, kind, column and violations of each declared check of the models that come from `sources`."""
    years, genders = _years(YEARS), f"'M', 'F', '{SILENT}'"
    slides = _years(range(8, 15))
    block_names = ", ".join(f"'{name}'" for name in _BLOCK_NAMES.values())
    nulls = (
        ("students_raw", "students_raw", ("USER_ID", "AGE_GROUP", "REGION", "YEAR_PATH_STARTED")),
        ("population_raw", "population_raw", ("REGION", "SEXE", "AGE_GROUP", "POPULATION", "ANNEE")),
        ("stg_students", "stg_students", ("USER_ID", "gender", "year_started", "age_group", "region")),
        ("students_by_year", "headcount", ("year_started", "nb_students")),
        ("age_distribution", "ages", ("year_started", "pct_of_year")),
        ("region_distribution", "regions", ("year_started", "region")),
        ("gender_evolution", "genders", ("gender",)),
        ("annual_synthesis", "synthesis", ("year_started", "nb_students")),
        ("comparison_mart", "mart", ("dimension",)),
        ("block_export", "blocks", ("slide", "source_table", "dimension", "rang")),
    )
    lines = []
    for model, source, columns in nulls:
        for column in columns:
            value = "pct10" if column == "pct_of_year" else column  # shares are kept in tenths
            lines.append((model, "not_null", column, f"{value} IS NULL", source, "NULL"))
    for model, source, column, values in (
        ("stg_students", "stg_students", "gender", genders),
        ("stg_students", "stg_students", "year_started", years),
        ("students_by_year", "headcount", "year_started", years),
        ("gender_evolution", "genders", "gender", genders),
        ("annual_synthesis", "synthesis", "year_started", years),
        ("comparison_mart", "mart", "dimension", "'region', 'genre', 'age'"),
        ("block_export", "blocks", "slide", slides),
        ("block_export", "blocks", "source_table", block_names),
    ):
        lines.append((model, "accepted_values", column, f"{column} NOT IN ({values})", source, column))
    lines.append(("stg_students", "range", "year_started",
                  f"year_started NOT BETWEEN {YEARS[0]} AND {YEARS[-1]}", "stg_students", "year_started"))
    lines.append(("repeated_keys", "unique", "USER_ID, year_started", "n > 1",
                  "(SELECT year_started, count(*) AS n FROM stg_students GROUP BY USER_ID, year_started)",
                  "year_started"))
    for model, source in (("age_share_sums", "ages"), ("region_share_sums", "regions")):
        lines.append((model, "sum_100", "pct_of_year", "t < 985 OR t >= 1015",
                      f"(SELECT year_started, sum(pct10) AS t FROM {source} GROUP BY year_started)", "year_started"))
    selects = [
        f"""SELECT '{model}' AS model, '{kind}' AS kind, '{column}' AS "column",
                   count(*) FILTER ({broken}) AS nb_failures,
                   CAST(min(CAST({shown} AS VARCHAR)) FILTER ({broken}) AS VARCHAR) AS example
            FROM {source}"""
        for model, kind, column, broken, source, shown in lines
        if any(source == name or f"FROM {name} " in source for name in sources)
    ]
    return "SELECT *, nb_failures = 0 AS passed FROM (\n" + "\nUNION ALL\n".join(selects) + ")"


_DAMAGED = {
    "sound": _PARTS["students_raw"],
    "students_raw": (("sound",), """
        SELECT USER_ID, PATH_CATEGORY_NAME, AGE_GROUP, if(u % 11 = 0, 'X', GENDER) AS GENDER,
               CASE WHEN u % 7 = 0 THEN NULL WHEN YEAR_PATH_STARTED = 1998 THEN 'Zone ' || USER_ID ELSE REGION END AS REGION,
               CAST(if(u % 13 = 0, YEAR_PATH_STARTED + 100, YEAR_PATH_STARTED) AS INTEGER) AS YEAR_PATH_STARTED
        FROM (SELECT *, CAST(substr(USER_ID, 2) AS INTEGER) AS u FROM sound
              UNION ALL SELECT *, CAST(substr(USER_ID, 2) AS INTEGER) FROM sound
                        WHERE CAST(substr(USER_ID, 2) AS INTEGER) % 17 = 0)"""),
}
_STUDENT_MODELS = ("students_raw", "stg_students", "headcount", "ages", "regions", "genders")

_ALL_MODELS = ("students_raw", "population_raw", "stg_students", "headcount", "ages", "regions", "genders",
               "synthesis", "mart", "blocks")

_WIDE_CELLS = {"c1": ("Ensemble", _BANDS_20[0]), "c26": ("Hommes", _BANDS_20[4]), "c62": ("Femmes", _BANDS_20[19])}
_WIDE_TOTALS = {"c21": "Ensemble", "c42": "Hommes", "c63": "Femmes"}


def _wide_columns() -> str:
    columns = [
        f"sum(POPULATION) FILTER (SEXE = '{sex}' AND AGE_GROUP = '{band}') || '.7' AS {name}"
        for name, (sex, band) in _WIDE_CELLS.items()
    ]
    columns += [f"sum(POPULATION) FILTER (SEXE = '{sex}') || '.7' AS {name}" for name, sex in _WIDE_TOTALS.items()]
    return ", ".join(columns)


def oracle_sql() -> dict[str, str]:
    raw_students = _with("SELECT * FROM students_raw", "students_raw")
    raw_population = _with("SELECT * FROM population_raw", "population_raw")
    staged = _with("SELECT * FROM stg_students", "stg_students")
    headcount = ("year_started, nb_students, nb_students_distincts, nb_male, nb_female, nb_nr, "
                 "silent10 / 10.0 AS taux_non_reponse, female10 / 10.0 AS pct_female_among_declared")
    blocks = _with("SELECT * FROM blocks", "blocks")
    mart = _with("SELECT * FROM mart", "mart")
    return {
        "src_students": raw_students,
        "src_population": raw_population,
        "sink_csv": raw_population,
        "unpivot_population": _with(
            f"SELECT * FROM population_raw WHERE ANNEE IN ({_years(SHEET_YEARS)})", "population_raw"),
        "filter_footnotes": _with(
            f"SELECT REGION AS region, ANNEE AS year, {_wide_columns()} FROM population_raw GROUP BY REGION, ANNEE",
            "population_raw"),
        "load_summary": _with("""
            SELECT 'students_raw' AS table_name, '*' AS attribute, NULL AS value, count(*) AS nb_rows FROM students_raw
            UNION ALL SELECT 'students_raw', 'YEAR_PATH_STARTED', CAST(YEAR_PATH_STARTED AS VARCHAR), count(*)
                      FROM students_raw GROUP BY ALL
            UNION ALL SELECT 'population_raw', '*', NULL, count(*) FROM population_raw
            UNION ALL SELECT 'population_raw', 'REGION', REGION, count(*) FROM population_raw GROUP BY ALL
            UNION ALL SELECT 'population_raw', 'SEXE', SEXE, count(*) FROM population_raw GROUP BY ALL
            UNION ALL SELECT 'population_raw', 'ANNEE', CAST(ANNEE AS VARCHAR), count(*)
                      FROM population_raw GROUP BY ALL""", "students_raw", "population_raw"),
        "load_ranges": _with("\nUNION ALL\n".join(
            f"""SELECT '{table}' AS table_name, '{column}' AS attribute, count(*) AS nb_rows, count({column}) AS nb_present,
                       {f"CAST(min({column}) AS VARCHAR)" if ranged else "CAST(NULL AS VARCHAR)"} AS low,
                       {f"CAST(max({column}) AS VARCHAR)" if ranged else "CAST(NULL AS VARCHAR)"} AS high FROM {table}"""
            for table, columns in (
                ("students_raw", ("USER_ID", "PATH_CATEGORY_NAME", "AGE_GROUP", "GENDER", "REGION", "YEAR_PATH_STARTED")),
                ("population_raw", ("REGION", "SEXE", "AGE_GROUP", "POPULATION", "ANNEE")))
            for column in columns for ranged in (column in ("YEAR_PATH_STARTED", "POPULATION", "ANNEE"),)),
            "students_raw", "population_raw"),
        "source_by_name": _with(
            "SELECT year_started, count(*) AS nb_students FROM stg_students GROUP BY year_started", "stg_students"),
        "publish_marts": mart,
        "export_manifest": _with("""
            SELECT 'listed' AS metric, count(*) AS value FROM stg_students
            UNION ALL SELECT 'read', count(*) FROM stg_students UNION ALL SELECT 'problems', 0""", "stg_students"),
        "label_table": _with("SELECT * FROM stg_population", "stg_population"),
        "sink_table": mart,
        "stg_students": staged,
        "blank_recode": _with(f"""
            SELECT GENDER AS raw_gender, coalesce(nullif(trim(GENDER), ''), '{SILENT}') AS gender,
                   count(*) AS nb_students
            FROM students_raw GROUP BY ALL""", "students_raw"),
        "stg_population": _with("SELECT * FROM stg_population", "stg_population"),
        "label_map": _with("""
            SELECT REGION AS raw_region, to_region AS region, SEXE AS raw_sexe, to_sexe AS sexe,
                   CAST(sum(POPULATION) AS BIGINT) AS population
            FROM labelled GROUP BY ALL""", "labelled"),
        "band_map": _with("""
            SELECT AGE_GROUP AS raw_age_group, to_band AS age_group, CAST(sum(POPULATION) AS BIGINT) AS population
            FROM labelled WHERE to_band IS NOT NULL GROUP BY ALL""", "labelled"),
        "filters": _with(f"""
            SELECT * FROM stg_population
            WHERE age_group IN ('25-29 ans', '30-34 ans', '35-39 ans')
              AND ((sexe = 'Ensemble' AND annee = {BENCHMARK_YEAR}) OR (sexe = 'F' AND region = '{FOCUS}'))
            """, "stg_population"),
        "counts": _with("SELECT year_started, region, gender, count(*) AS nb_students FROM stg_students GROUP BY ALL",
                        "stg_students"),
        "students_by_year": _with(f"SELECT {headcount} FROM headcount", "headcount"),
        "share_declared": _with("""
            SELECT year_started, nb_female, nb_male + nb_female AS nb_declared,
                   female10 / 10.0 AS pct_female_among_declared
            FROM headcount""", "headcount"),
        "gender_evolution": _with("""
            SELECT year_started, gender, n AS nb_students, total AS total_year, pct10 / 10.0 AS pct_of_year,
                   declared10 / 10.0 AS pct_among_declared
            FROM genders""", "genders"),
        "female_share": _with(
            "SELECT year_started, declared10 / 10.0 AS pct_among_declared FROM genders WHERE gender = 'F'", "genders"),
        "gender_counts": _with("SELECT gender, count(*) AS nb FROM stg_students GROUP BY gender", "stg_students"),
        "age_distribution": _with("""
            SELECT year_started, age_group, n AS nb_students, total AS total_year, pct10 / 10.0 AS pct_of_year,
                   rang, age_moyen_approx
            FROM ages JOIN means USING (year_started)""", "ages", "means"),
        "region_distribution": _with(f"""
            SELECT year_started, region, n AS nb_students, total AS total_year, pct10 / 10.0 AS pct_of_year,
                   if(region = '{FOCUS}', 'IDF', 'Province') AS zone, rang
            FROM regions""", "regions"),
        "focus_share": _with(
            f"SELECT year_started, pct10 / 10.0 AS pct_idf FROM regions WHERE region = '{FOCUS}'", "regions"),
        "share_of_total": _with("""
            SELECT year_started, region, n AS nb_students, total AS total_year, pct10 / 10.0 AS pct_of_year
            FROM regions""", "regions"),
        "rank_within": _with("SELECT year_started, region, n AS nb_students, rang FROM regions", "regions"),
        "banded_mean": _with("SELECT * FROM means", "means"),
        "top_per_group": _with("""
            SELECT year_started, age_group, pct10 / 10.0 AS pct_of_year, rang FROM ages WHERE rang < 6""", "ages"),
        "returning_users": _with("""
            SELECT CAST(sum(n) AS BIGINT) AS total, count(*) AS nb_distincts, count(*) FILTER (n > 1) AS nb_reinscrits
            FROM (SELECT count(*) AS n FROM stg_students GROUP BY USER_ID)""", "stg_students"),
        "users_by_bitmaps": _with("""
            SELECT year_started, count(DISTINCT USER_ID) AS nb_students_distincts,
                   count(*) FILTER (n > 1) AS nb_repeated_keys
            FROM (SELECT year_started, USER_ID, count(*) AS n FROM stg_students GROUP BY ALL) GROUP BY year_started""",
            "stg_students"),
        "returning_by_bitmaps": _with("""
            SELECT CAST(sum(n) AS BIGINT) AS total, count(*) AS nb_distincts, count(*) FILTER (n > 1) AS nb_reinscrits
            FROM (SELECT count(*) AS n FROM stg_students GROUP BY USER_ID)""", "stg_students"),
        "distinct_over_years": _with("""
            SELECT count(DISTINCT USER_ID) AS nb_distincts FROM stg_students WHERE year_started IN (1996, 1998, 1999)""",
            "stg_students"),
        "benchmark_share": _with("""
            SELECT detail AS region, pop_insee, insee10 / 10.0 AS pct_insee
            FROM benchmark_shares WHERE dimension = 'region'""", "benchmark_shares"),
        "global_share": _with("""
            SELECT detail AS region, nb_oc, oc10 / 10.0 AS pct_oc FROM observed WHERE dimension = 'region'""",
            "observed"),
        "compare_region": _with("""
            SELECT detail AS region, nb_oc, oc10 / 10.0 AS pct_oc, pop_insee, insee10 / 10.0 AS pct_insee,
                   gap10 / 10.0 AS ecart_pts, ratio100 / 100.0 AS ratio
            FROM compared WHERE dimension = 'region'""", "compared"),
        "compare_age": _with("""
            SELECT detail AS age_group, pct_oc, pct_insee, ecart_pts FROM mart WHERE dimension = 'age'""", "mart"),
        "compare_gender": _with("""
            SELECT pct_oc AS pct_f_oc, pct_insee AS pct_f_insee, ecart_pts FROM mart WHERE dimension = 'genre'""",
            "mart"),
        "compare_all": mart,
        "report_headcounts": _with(
            "SELECT year_started, nb_students, nb_students_distincts FROM headcount", "headcount"),
        "report_gender_shares": _with(
            "SELECT year_started, gender, pct10 / 10.0 AS pct_of_year FROM genders", "genders"),
        "report_age_comparison": _with("""
            SELECT detail AS age_group, pct_oc, pct_insee, ecart_pts FROM mart WHERE dimension = 'age'""", "mart"),
        "report_top_bands": _with(
            "SELECT year_started, age_group, pct10 / 10.0 AS pct_of_year FROM ages WHERE rang < 6", "ages"),
        "report_region_comparison": _with("""
            SELECT detail AS region, pct_oc, pct_insee, ecart_pts, ratio FROM mart WHERE dimension = 'region'""",
            "mart"),
        "annual_synthesis": _with("SELECT * FROM synthesis", "synthesis"),
        "band_group_rollup": _with("""
            SELECT dimension, detail, oc10 / 10.0 AS pct_oc, insee10 / 10.0 AS pct_insee, gap10 / 10.0 AS ecart_pts
            FROM (FROM headlines UNION ALL BY NAME FROM key_bands)""", "headlines", "key_bands"),
        "block_union": blocks,
        "block_counts": _with("SELECT * FROM block_lines", "block_lines"),
        "export_staging": staged,
        "export_blocks": _with("""
            SELECT slide, source_table, dimension, detail,
                   if(slide < 10, CAST(CAST(valeur AS BIGINT) AS VARCHAR), printf('%.1f', valeur)) AS valeur,
                   valeur_2, ecart, rang
            FROM blocks""", "blocks"),
        "check_not_null": _with("""
            SELECT 'USER_ID' AS "column", count(*) FILTER (USER_ID IS NULL) AS nb_null FROM students_raw
            UNION ALL SELECT 'AGE_GROUP', count(*) FILTER (AGE_GROUP IS NULL) FROM students_raw
            UNION ALL SELECT 'GENDER', count(*) FILTER (GENDER IS NULL) FROM students_raw
            UNION ALL SELECT 'REGION', count(*) FILTER (REGION IS NULL) FROM students_raw
            UNION ALL SELECT 'YEAR_PATH_STARTED', count(*) FILTER (YEAR_PATH_STARTED IS NULL) FROM students_raw
            """, "students_raw"),
        "check_accepted": _with("""
            SELECT GENDER AS value, count(*) AS nb_rows FROM students_raw
            WHERE GENDER NOT IN ('M', 'F') GROUP BY GENDER""", "students_raw"),
        "check_unique": """
            SELECT 'u' || o_custkey AS USER_ID, CAST(year(o_orderdate) AS INTEGER) AS year_started,
                   count(*) AS nb_occurrences
            FROM orders WHERE o_custkey % 211 <> 7 GROUP BY ALL HAVING nb_occurrences <> 1""",
        "check_range": _with("SELECT * FROM stg_students WHERE year_started NOT BETWEEN 1996 AND 2000",
                             "stg_students"),
        "check_sum_100": _with("""
            SELECT model, year_started, CAST(t // 10 + if(t % 10 >= 5, 1, 0) AS DOUBLE) AS total_pct
            FROM (SELECT 'age' AS model, year_started, CAST(sum(pct10) AS BIGINT) AS t FROM ages GROUP BY ALL
                  UNION ALL
                  SELECT 'region', year_started, CAST(sum(pct10) AS BIGINT) FROM regions GROUP BY ALL
                  UNION ALL
                  SELECT 'age_top5', year_started, CAST(sum(pct10) AS BIGINT) FROM ages WHERE rang < 6 GROUP BY ALL)
            WHERE total_pct NOT BETWEEN 99 AND 101""", "ages", "regions"),
        "reconcile": _with("""
            SELECT source_table AS metric, nb_lignes AS actual, e AS expected, nb_lignes IS NOT DISTINCT FROM e AS matches
            FROM block_lines FULL JOIN (VALUES
                ('S08_effectifs_par_annee', 7::BIGINT), ('S09_parite_homme_femme', 21), ('S10_distribution_age', 9),
                ('S11_evolution_age_top5', 35), ('S12_repartition_geographique', 14), ('S13_evolution_pct_idf', 7),
                ('S14_S16_comparaison_insee_synthese', 3)) AS expected (metric, e) ON metric = source_table""",
            "block_lines"),
        "gate": _with(_check_lines(_ALL_MODELS), *_ALL_MODELS),
        "gate_failing": _with(_check_lines(_STUDENT_MODELS), *_STUDENT_MODELS, instead=_DAMAGED),
    }
