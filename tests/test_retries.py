"""Tasks that fail after sending rows and run again change no result."""

import pytest
from helpers import rows
from pyspark import TaskContext

from cohortscope.operators.staging import clean_enrolments
from cohortscope.plans import build
from cohortscope.sources import derived, files


@pytest.fixture(scope="module")
def steady(spark, sf_dir):
    return derived.students_raw(spark, sf_dir).where("USER_ID IS NOT NULL")


@pytest.fixture(scope="module")
def shaky(steady):
    def fail_once(batches):
        task = TaskContext.get()
        for batch in batches:
            yield batch
            if task.attemptNumber() == 0 and task.partitionId() % 2 == 0:
                raise RuntimeError("lost task")

    return steady.repartition(6, "USER_ID").mapInPandas(fail_once, steady.schema)


def test_row_export(spark, steady, shaky, tmp_path):
    path = str(tmp_path / "rows")
    files.export_rows(clean_enrolments(shaky), path, build.EXPORT_KEYS)
    expected = clean_enrolments(steady)
    assert rows(files.read_csv(spark, path, expected.schema)) == rows(expected)


def test_build(spark, sf_dir, steady, shaky, tmp_path):
    population = derived.population_raw(spark, sf_dir)
    with_failures, without = (
        build.build(students, population, str(tmp_path / name), derived.SETTINGS)
        for name, students in (("shaky", shaky), ("steady", steady))
    )
    for mart in build.MARTS:
        assert rows(with_failures[mart]) == rows(without[mart])
