from helpers import rows

from cohortscope.__main__ import main
from cohortscope.schemas import POPULATION_RAW
from cohortscope.sources import derived, files
from cohortscope.sources.versions import Versions


def test_reshape_then_build(spark, sf_dir, tmp_path, capsys):
    population = derived.population_raw(spark, sf_dir)
    sheets, long, students, out = (str(tmp_path / name) for name in ("sheets", "long", "students", "out"))
    files.write_sheets(derived.population_wide(population), sheets)
    main(["reshape", "--sheets", sheets, "--out", long, "--years", *map(str, derived.SETTINGS.years)])
    assert rows(files.read_csv(spark, long, POPULATION_RAW)) == rows(population)
    assert "REGION" in capsys.readouterr().out

    files.write_csv(derived.students_raw(spark, sf_dir).where("USER_ID IS NOT NULL"), students)
    main(["build", "--students", students, "--population", long, "--out", out, "--export", "--report",
          "--benchmark-year", "1997", "--years", *map(str, derived.SETTINGS.years)])
    assert "headline_synthesis" in capsys.readouterr().out
    blocks = Versions(spark, out).read("block_export")
    assert spark.read.option("header", True).csv(f"{out}/block_export.csv").count() == blocks.count()
    assert not (tmp_path / "out" / "stg_students_csv").exists()
    assert not (tmp_path / "out" / "students_raw").exists()
