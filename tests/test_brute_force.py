"""The whole build on small random inputs, dirty ones included, against plain loops over lists."""

import random
from collections import Counter, defaultdict
from decimal import Decimal
from fractions import Fraction

import pytest

from cohortscope.plans import build
from cohortscope.schemas import POPULATION_RAW
from cohortscope.settings import BAND_LABELS, BAND_MIDPOINTS, POPULATION_BANDS, REGION_LABELS, SEX_LABELS, Settings

SETTINGS = Settings()
FOCUS, SILENT = SETTINGS.focus_region, SETTINGS.non_response


def rounded(value, digits=1):
    """Half away from zero, as Decimal; null stays null."""
    if value is None:
        return None
    value = Fraction(value) * 10**digits
    whole = (2 * abs(value.numerator) + value.denominator) // (2 * value.denominator)
    return (Decimal(whole if value >= 0 else -whole) / 10**digits).quantize(Decimal(1).scaleb(-digits))


def pct(part, whole):
    return rounded(Fraction(100 * part, whole)) if part is not None and whole else None


def raw_inputs(seed):
    rng = random.Random(seed)
    ages = [" 25-29 ans", "30-34 ans ", "35-39 ans", "20-24 ans", "60 ans ou plus", "40-44 ans", "??", None]
    students = [
        (
            None if rng.random() < 0.05 else f"u{rng.randrange(60)}", "Data", rng.choice(ages),
            rng.choice([" M", "M", "F ", "F", "", "  ", None, "m"]),
            rng.choice([FOCUS, f" {FOCUS}", "DROM", "DROM ", "Ailleurs", "Centre-Val de Loire", None]),
            rng.choice([2022, 2022, 2023, 2024, 2025, None]),
        )
        for _ in range(400)
    ]
    if seed == 2:  # a year in which nobody answered
        students = [(u, p, a, "" if y == 2024 else g, r, y) for u, p, a, g, r, y in students]
    population = [
        (
            rng.choice([FOCUS, "Corse", "Mayotte", "DOM", "Centre-Val-de-Loire", None]),
            rng.choice(["Hommes", "Femmes", "Ensemble", "Ensemble", "Autre"]),
            rng.choice([*POPULATION_BANDS, None]), rng.randrange(1, 5000), rng.choice([2022, 2023, 2023]),
        )
        for _ in range(300)
    ]
    return students, population


def staged(students):
    def trim(text):
        return text if text is None else text.strip(" ")

    return [(u, p, trim(a), trim(g) or SILENT, trim(r), y) for u, p, a, g, r, y in students if u is not None]


def harmonised(population):
    sums = Counter()
    for region, sex, band, n, year in population:
        if band in BAND_LABELS:
            sums[REGION_LABELS.get(region, region), SEX_LABELS.get(sex), BAND_LABELS[band], year] += n
    return sums


def headcount(rows):
    out = {}
    for year in {r[5] for r in rows}:
        of_year = [r for r in rows if r[5] == year]
        genders = Counter(r[3] for r in of_year)
        out[year] = (
            len(of_year), len({r[0] for r in of_year}), genders["M"], genders["F"], genders[SILENT],
            pct(genders[SILENT], len(of_year)), pct(genders["F"], genders["M"] + genders["F"]),
        )
    return out


def gender_evolution(rows):
    counts, totals, answered = Counter((r[5], r[3]) for r in rows), Counter(r[5] for r in rows), Counter()
    for (year, gender), n in counts.items():
        answered[year] += n * (gender != SILENT)
    return {
        (year, gender, n, totals[year], pct(n, totals[year]), None if gender == SILENT else pct(n, answered[year]))
        for (year, gender), n in counts.items()
    }


def distribution(rows, column):
    counts = Counter((r[5], r[column]) for r in rows if r[5] is not None)
    totals = Counter(r[5] for r in rows)
    return {
        (year, label): (
            n, totals[year], pct(n, totals[year]), 1 + sum(y == year and m > n for (y, _), m in counts.items()))
        for (year, label), n in counts.items()
    }


def mean_ages(rows):
    known = defaultdict(list)
    for r in rows:
        known[r[5]] += [BAND_MIDPOINTS[r[2]]] if r[2] in BAND_MIDPOINTS else []
    return {year: rounded(Fraction(sum(ages), len(ages))) if ages else None for year, ages in known.items()}


def comparison(rows, population):
    benchmark = {key: n for key, n in population.items() if key[3] == SETTINGS.benchmark_year}
    lines = []
    for dimension, ours, theirs in (("region", 4, 0), ("age", 2, 2)):
        observed, resident = Counter(r[ours] for r in rows), Counter()
        for key, n in benchmark.items():
            if key[1] == "Ensemble":
                resident[key[theirs]] += n
        shared = {label for label in set(observed) & set(resident) if label is not None}
        sides = [(label, True, label in shared) for label in observed]
        sides += [(label, False, True) for label in resident if label not in shared]
        for label, enrolled, lives in sides:
            lines.append((
                dimension, label,
                pct(observed[label], len(rows)) if enrolled else None,
                pct(resident[label], sum(resident.values())) if lives else None,
            ))
    genders = Counter(r[3] for r in rows)
    women = sum(n for key, n in benchmark.items() if key[1] == "F")
    both = sum(n for key, n in benchmark.items() if key[1] == "Ensemble")
    lines.append(("genre", "Femmes", pct(genders["F"], genders["M"] + genders["F"]), pct(women, both)))
    out = []
    for dimension, label, one, two in lines:
        matched = one is not None and two is not None
        quotient = rounded(Fraction(one) / Fraction(two), 2) if matched and two and dimension == "region" else None
        out.append((dimension, label, one, two, one - two if matched else None, quotient))
    return out


def found(df, *columns):
    return Counter(tuple(r) for r in (df.select(*columns) if columns else df).collect())


@pytest.fixture(scope="module", params=[1, 2, 3])
def case(spark, request):
    students, population = raw_inputs(request.param)
    from cohortscope.schemas import STUDENTS_RAW

    base = build.base_models(
        spark.createDataFrame(students, STUDENTS_RAW).repartition(3),
        spark.createDataFrame(population, POPULATION_RAW).repartition(3),
    )
    return build.with_marts(base), staged(students), harmonised(population)


def test_staging(case):
    models, rows, population = case
    assert found(models["stg_students"]) == Counter(rows)
    assert found(models["stg_population"]) == Counter(
        (region, sex, band, n, year) for (region, sex, band, year), n in population.items())


def test_indicators(case):
    models, rows, _ = case
    assert found(models["students_by_year"]) == Counter((year, *values) for year, values in headcount(rows).items())
    assert found(models["gender_evolution"]) == Counter(gender_evolution(rows))
    means = mean_ages(rows)
    assert found(models["age_distribution"]) == Counter(
        (year, band, *values, means[year]) for (year, band), values in distribution(rows, 2).items())
    assert found(models["region_distribution"]) == Counter(
        (year, region, n, total, share, "IDF" if region == FOCUS else "Province", rank)
        for (year, region), (n, total, share, rank) in distribution(rows, 4).items())


def test_comparison(case):
    models, rows, population = case
    assert found(models["comparison_mart"]) == Counter(comparison(rows, population))


def test_annual_synthesis(case):
    models, rows, _ = case
    regions, ages = distribution(rows, 4), distribution(rows, 2)
    expected = Counter()
    for year, values in headcount(rows).items():
        top_regions = [(r, v[2]) for (y, r), v in regions.items() if y == year and v[3] == 1] or [(None, None)]
        top_ages = [(a, v[2]) for (y, a), v in ages.items() if y == year and v[3] == 1] or [(None, None)]
        focus = regions.get((year, FOCUS), (None, None, None))[2]
        expected.update((year, *values, *region, focus, *age) for region in top_regions for age in top_ages)
    assert found(models["annual_synthesis"]) == expected


def last(value):
    return (value is None, value if value is not None else 0)


def test_block_export(case):
    models, rows, population = case
    mart = comparison(rows, population)
    years = sorted(headcount(rows).items(), key=lambda item: last(item[0]))
    ages = sorted(
        ((y, a, v[2]) for (y, a), v in distribution(rows, 2).items() if v[3] <= 5),
        key=lambda t: (t[0], -t[2], (t[1] is None, t[1] or "")))
    focus = sorted((y, v[2]) for (y, r), v in distribution(rows, 4).items() if r == FOCUS)

    def lines(dimension, key):
        return sorted((line for line in mart if line[0] == dimension), key=key)

    def label(line):
        return line[1] is None, line[1] or ""

    def text(year):
        return None if year is None else str(year)

    expected = [(8, text(y), None, v[0], None, None, i) for i, (y, v) in enumerate(years, 1)]
    genders = sorted(gender_evolution(rows), key=lambda t: (last(t[0]), t[1]))
    seen = Counter()
    for year, gender, n, _, share, _ in genders:
        seen[year] += 1
        expected.append((9, text(year), gender, n, share, None, seen[year]))
    expected += [(10, "global", line[1], *line[2:5], i) for i, line in enumerate(lines("age", label), 1)]
    expected += [(11, text(y), a, share, None, None, i) for i, (y, a, share) in enumerate(ages, 1)]
    by_share = lines("region", lambda line: (line[2] is None, -(line[2] or 0), label(line)))
    expected += [(12, "global", line[1], *line[2:5], i) for i, line in enumerate(by_share, 1)]
    expected += [(13, text(y), FOCUS, share, None, None, i) for i, (y, share) in enumerate(focus, 1)]
    heads = [line for line in mart if line[:2] in (("genre", "Femmes"), ("region", FOCUS))]
    expected += [(14, line[0], line[1], *line[2:5], i) for i, line in enumerate(sorted(heads, key=str), 1)]
    key_bands = [line for line in mart if line[0] == "age" and line[1] in SETTINGS.key_bands]
    sums = [sum(values) if (values := [line[i] for line in key_bands if line[i] is not None]) else None for i in (2, 3)]
    gap = None if None in sums else sums[0] - sums[1]
    expected.append((14, "age", SETTINGS.key_bands_label, *sums, gap, 3))
    columns = ("slide", "dimension", "detail", "valeur", "valeur_2", "ecart", "rang")
    assert found(models["block_export"], *columns) == Counter(expected)


def test_checks(case):
    models, rows, _ = case
    failures = {(r.model, r.kind, r.column): r.nb_failures for r in build.check_summary(models).collect()}
    assert failures["stg_students", "not_null", "region"] == sum(r[4] is None for r in rows)
    assert failures["stg_students", "not_null", "year_started"] == sum(r[5] is None for r in rows)
    assert failures["stg_students", "accepted_values", "gender"] == sum(r[3] == "m" for r in rows)
    assert failures["repeated_keys", "unique", "USER_ID, year_started"] == sum(
        n > 1 for n in Counter((r[0], r[5]) for r in rows).values())
    assert failures["block_export", "not_null", "dimension"] == len(
        [1 for y in headcount(rows) if y is None]) + len({g for y, g, *_ in gender_evolution(rows) if y is None})
