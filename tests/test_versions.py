"""Published sets of tables: whole, replaced at once, and checked while they are written."""

import os

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F
from test_checks import raw_enrolments, raw_population  # noqa: F401

from cohortscope.operators import checks
from cohortscope.plans import build
from cohortscope.sources import catalog, files
from cohortscope.sources.shared import land
from cohortscope.sources.versions import Versions


@pytest.fixture
def versions(spark, tmp_path):
    return Versions(spark, str(tmp_path / "out"))


def write_set(spark, versions, n, tables=("a", "b", "c")):
    folder = versions.new_folder()
    for table in tables:
        spark.range(n).write.parquet(f"{folder}/{table}")
    return folder


def counts(versions, tables=("a", "b", "c")):
    return [versions.read(table).count() for table in tables]


def test_readers_see_one_set_at_a_time(spark, versions):
    with pytest.raises(FileNotFoundError, match="nothing is published"):
        versions.current()
    versions.publish(write_set(spark, versions, 3), ("a", "b", "c"))
    assert counts(versions) == [3, 3, 3]
    later = write_set(spark, versions, 5)
    assert counts(versions) == [3, 3, 3]
    old = versions.read("a")
    versions.publish(later, ("a", "b", "c"))
    assert counts(versions) == [5, 5, 5] and old.count() == 3


def test_a_set_that_lacks_a_table_is_not_published(spark, versions):
    versions.publish(write_set(spark, versions, 3), ("a", "b", "c"))
    with pytest.raises(FileNotFoundError, match="c is not complete"):
        versions.publish(write_set(spark, versions, 4, ("a", "b")), ("a", "b", "c"))
    assert counts(versions) == [3, 3, 3]


def test_old_sets_go_and_the_last_two_stay(spark, versions, tmp_path):
    for n in range(1, 5):
        versions.publish(write_set(spark, versions, n), ("a", "b", "c"))
    assert counts(versions) == [4, 4, 4]
    assert len(os.listdir(tmp_path / "out" / "_versions")) == 2
    assert sorted(f for f in os.listdir(tmp_path / "out" / "_published") if not f.startswith(".")) == ["0000000003", "0000000004"]


def test_a_number_that_is_taken_is_not_overwritten(spark, versions, monkeypatch):
    versions.publish(write_set(spark, versions, 3), ("a", "b", "c"))
    real, asked = versions._markers, []

    def stale():  # another run has published since the markers were listed
        asked.append(1)
        return [] if len(asked) == 1 else real()

    monkeypatch.setattr(versions, "_markers", stale)
    versions.publish(write_set(spark, versions, 7), ("a", "b", "c"))
    monkeypatch.undo()
    assert versions._markers() == [1, 2] and counts(versions) == [7, 7, 7]


def test_a_failing_second_write_leaves_the_old_set_whole(spark, raw_students, raw_population, tmp_path, monkeypatch):  # noqa: F811
    out = str(tmp_path / "out")
    build.build(raw_enrolments(raw_students), raw_population, out)
    before = {name: rows(Versions(spark, out).read(name)) for name in build.MARTS}
    written, real = [], build.write_table

    def fails_second(df, path):
        if path.rsplit("/", 1)[1] in build.MARTS:
            written.append(path)
            if len(written) == 2:
                raise OSError("disk full")
        return real(df, path)

    monkeypatch.setattr(build, "write_table", fails_second)
    changed = raw_enrolments(raw_students, ("w", "Data", "20-24 ans", "M", "DROM", 2022))
    with pytest.raises(OSError, match="disk full"):
        build.build(changed, raw_population, out)
    assert len(written) == 2
    assert {name: rows(Versions(spark, out).read(name)) for name in build.MARTS} == before
    assert len(os.listdir(f"{out}/_versions")) == 1


def test_checks_are_counted_by_the_write(spark, tmp_path):
    """The landed table is not read again, and the frame is scanned once."""
    source = land(spark.range(1000).selectExpr("id", "IF(id % 10 = 0, NULL, id) AS region"), "watched")
    check = checks.Check("m", "not_null", "region", F.col("region").isNull(), None, "id")
    watch = checks.Watch({"m": F.col("id") >= 500}, [check], {"rows": F.count(F.lit(1))})
    observed = watch.over(source)
    physical = plan(observed)[1]
    assert physical.count("FileScan") == 1 and "CollectMetrics" in physical and "Aggregate" not in physical
    files.write_table(observed, str(tmp_path / "t"))
    assert watch.lines() == [("m", "not_null", "region", 50, "500", False)] and watch.value("rows") == 1000
    summary = checks.summary(spark, watch.lines())
    assert "FileScan" not in plan(summary)[1] and rows(summary, "nb_failures") == [(50,)]


def test_an_empty_frame_passes_its_checks(spark, tmp_path):
    empty = spark.createDataFrame([], "region string, n bigint").repartition(2)
    check = checks.Check("m", "not_null", "region", F.col("region").isNull(), "n")
    watch = checks.Watch({"m": None}, [check])
    files.write_table(watch.over(empty.groupBy("region").agg(F.sum("n").alias("n"))), str(tmp_path / "t"))
    assert watch.lines() == [("m", "not_null", "region", 0, None, True)]


def test_tasks_that_run_again_are_counted_once(spark, tmp_path):
    from pyspark import TaskContext

    def fail_once(batches):
        for batch in batches:
            yield batch
        if TaskContext.get().attemptNumber() == 0:
            raise RuntimeError("lost task")

    df = spark.range(100, numPartitions=4).selectExpr("IF(id < 30, NULL, id) AS x").mapInPandas(fail_once, "x bigint")
    watch = checks.Watch({"m": None}, [checks.Check("m", "not_null", "x", F.col("x").isNull())])
    files.write_table(watch.over(df), str(tmp_path / "t"))
    assert watch.lines()[0][3] == 30


def test_a_build_by_names_equals_a_build_by_frames(spark, raw_students, raw_population, tmp_path):  # noqa: F811
    students = raw_enrolments(raw_students)
    by_frame = build.build(students, raw_population, str(tmp_path / "a"))
    catalog.save(students, "study.enrolments")
    catalog.save(raw_population, "population_by_region")
    spark.conf.set("cohortscope.source.enrolments", "study.enrolments")
    try:
        by_name = build.build("enrolments", "population_by_region", str(tmp_path / "b"))
        for name in build.MARTS:
            assert rows(by_name[name]) == rows(by_frame[name])
        found = catalog.register(Versions(spark, str(tmp_path / "b")), {"block_export": "study.blocks", "comparison_mart": "comparison"})
        assert rows(spark.table("study.blocks")) == rows(by_frame["block_export"])
        assert rows(found["comparison_mart"]) == rows(spark.sql("SELECT * FROM comparison"))
        size = spark.sql("DESCRIBE TABLE EXTENDED study.blocks").where("col_name = 'Statistics'").first()["data_type"]
        assert f"{by_frame['block_export'].count()} rows" in size
        catalog.register(Versions(spark, str(tmp_path / "a")), {"block_export": "study.blocks"})
        assert rows(spark.table("study.blocks")) == rows(by_name["block_export"])
    finally:
        spark.conf.unset("cohortscope.source.enrolments")
        for table in ("study.enrolments", "study.blocks", "population_by_region", "comparison"):
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.sql("DROP DATABASE study")
    assert os.path.isdir(Versions(spark, str(tmp_path / "a")).current())
