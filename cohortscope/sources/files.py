"""Readers and writers for the raw files, the tables and the exports."""

from __future__ import annotations

from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, DateType, DecimalType, FractionalType, IntegralType, StructType

from cohortscope.schemas import LABELS, POPULATION_RAW, POPULATION_WIDE, STUDENTS_RAW

# Quotes are doubled and spaces kept, so that labels survive a round trip unchanged.
_CSV = {
    "header": True,
    "encoding": "UTF-8",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


#: Stands for an unquoted empty field while reading; no text equals it.
_NO_TEXT = "\u0000"


def read_csv(spark: SparkSession, path: str, schema: StructType, line_breaks: bool = False) -> DataFrame:
    """A CSV with a header. Other columns than the schema's, or a bad value, fail the read.

    An empty field is null and a quoted empty one an empty text. Files whose values hold line breaks are read
    with `line_breaks`, one task a file; other files are split.
    """
    return (
        spark.read.schema(schema)
        .options(**_CSV, mode="FAILFAST", enforceSchema=False, nullValue=_NO_TEXT, emptyValue="", multiLine=line_breaks)
        .csv(path)
    )


def read_students(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, STUDENTS_RAW)


def read_population(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, POPULATION_RAW)


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """A label map saved as CSV with the columns source and target."""
    return read_csv(spark, path, LABELS)


def read_population_wide(spark: SparkSession, path: str, years: Sequence[int] | None = None) -> DataFrame:
    """Yearly sheets saved as headerless CSV under `path/year=YYYY/`, one file a sheet, 64 text columns each, and each
    row's `line` in its file, from 1. With `years` the other sheets are never opened.

    A row with more or fewer fields fails the read, whichever columns are used. Cells may hold line breaks. Lines are
    counted by where a row's block begins in its file and by the row's place in the block, so a file may be split
    and its blocks may be read in any order. A line without any character is no row and is not counted.
    """
    options = {**_CSV, "header": False, "mode": "FAILFAST", "columnPruning": False, "multiLine": True}
    rows = spark.read.schema(POPULATION_WIDE).options(**options).csv(path)
    if years is not None:
        rows = rows.where(F.col("year").isin(*years))
    placed = rows.select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_place"),
    )
    in_file = Window.partitionBy("_file").orderBy("_block", "_place")  # one sheet a group
    return placed.withColumn("line", F.row_number().over(in_file)).drop("_file", "_block", "_place")


def write_sheets(wide: DataFrame, path: str) -> None:
    """Save wide rows as yearly sheets in the order of `line`, in the layout that `read_population_wide` reads."""
    sheets = wide.repartition("year").sortWithinPartitions("year", "line").drop("line")
    sheets.write.mode("overwrite").partitionBy("year").options(**{**_CSV, "header": False}).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**_CSV).csv(path)


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Replace the Parquet table at `path` and return it as read back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_one_csv(df: DataFrame, path: str) -> None:
    """Write a frame of one partition as the single file `path`, which appears complete or not at all.

    Spark writes a folder beside it; its only part is renamed over an earlier file of that name.
    """
    folder = f"{path}.{uuid4().hex}"
    spark = df.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        write_csv(df, folder)
        parts = [s.getPath() for s in system.listStatus(hadoop.Path(folder)) if s.getPath().getName().startswith("part-")]
        if len(parts) != 1:
            raise ValueError(f"a single file needs a frame of one partition, not {len(parts)}")
        rename = getattr(hadoop, "Options$Rename")
        options = spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        target = system.makeQualified(target)
        context = hadoop.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
        context.rename(parts[0], target, options)
    finally:
        system.delete(hadoop.Path(folder), True)


_MANIFEST = "_manifest"
_MANIFEST_SCHEMA = "place int, file string, nb_rows bigint, checksum bigint"


def _parts(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """For each part of an export its rows and a checksum of their values, whatever the rows' order."""
    rows = read_csv(spark, path, schema)
    hashed = rows.select(F.col("_metadata.file_name").alias("file"), F.xxhash64(*schema.names).alias("h"))
    # The sum tells repeated rows apart, which an exclusive or would cancel; it is taken modulo 2**61 - 1.
    return hashed.groupBy("file").agg(
        F.count(F.lit(1)).alias("nb_rows"),
        F.sum(F.pmod(F.col("h"), F.lit((1 << 61) - 1)).cast("decimal(38,0)")).alias("total"),
    ).select("file", "nb_rows", F.pmod("total", F.lit((1 << 61) - 1).cast("decimal(38,0)")).cast("bigint").alias("checksum"))


def write_manifest(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """List the parts of an export in their order, with rows and checksums, under `path/_manifest`.

    The parts are read back, so the list tells what is stored. A reader of the export does not see it. It has a line
    per part that holds rows.
    """
    # One line a part: as many as the export had tasks.
    lines = _parts(spark, path, schema).repartition(1)
    placed = lines.withColumn("place", F.row_number().over(Window.orderBy("file")))
    placed.select("place", "file", "nb_rows", "checksum").write.mode("overwrite").json(f"{path}/{_MANIFEST}")
    return read_manifest(spark, path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The list of an export's parts."""
    return spark.read.schema(_MANIFEST_SCHEMA).json(f"{path}/{_MANIFEST}")


def verify_export(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Parts that do not match the manifest: `lost`, `changed`, or `extra` where it does not list them. Empty if
    the export is whole."""
    listed = read_manifest(spark, path)
    found = _parts(spark, path, schema).select(
        "file", F.col("nb_rows").alias("found_rows"), F.col("checksum").alias("found_checksum"))
    same = (F.col("nb_rows") == F.col("found_rows")) & (F.col("checksum") == F.col("found_checksum"))
    problem = (
        F.when(F.col("found_rows").isNull(), "lost").when(F.col("nb_rows").isNull(), "extra").when(~same, "changed")
    )
    return (
        listed.join(found, "file", "full_outer").withColumn("problem", problem).where("problem IS NOT NULL")
        .select("place", "file", "problem", "nb_rows", "found_rows")
    )


def export_rows(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Write every row to CSV files whose concatenation is sorted by `keys`, nulls last.

    A few key values can hold most rows, so the ranges also split by a salt: a hash of the row and
    of the task that holds it. Even copies of one row spread over as many ranges as tasks hold
    them, and a task that runs again computes the same salts.
    """
    salted = df.withColumn("__salt", F.xxhash64(*df.columns, F.spark_partition_id()))
    order = [F.asc_nulls_last(key) for key in keys]
    ordered = salted.repartitionByRange(*order, "__salt").sortWithinPartitions(*order).drop("__salt")
    write_csv(ordered, path)
    write_manifest(df.sparkSession, path, df.schema)


def export_blocks(df: DataFrame, path: str) -> None:
    """Write the block mart as one ordered CSV: headcounts without decimals, shares with one.

    One file with the name `path` is the deliverable; the mart has a row per block, year and label.
    """
    headcount = F.col("slide").isin(8, 9)
    formatted = df.withColumn(
        "valeur",
        F.when(headcount, F.col("valeur").cast("bigint").cast("string"))
        .otherwise(F.col("valeur").cast("decimal(20,1)").cast("string")),
    )
    write_one_csv(formatted.repartition(1).sortWithinPartitions("slide", "rang", "dimension", "detail"), path)


def footer_summary(spark: SparkSession, path: str) -> DataFrame:
    """For each column of a Parquet table its rows, its values that are not null, and for numbers and dates the least
    and greatest; taken from the files' footers, so no column is read.

    Spark answers counts and ranges from footers through the second version of its Parquet source, which a session
    has to ask for. It is asked for in a session beside the caller's, whose settings stay as they are.
    """
    own = spark.newSession()
    sources = own.conf.get("spark.sql.sources.useV1SourceList")
    own.conf.set("spark.sql.sources.useV1SourceList", ",".join(s for s in sources.split(",") if s.strip() != "parquet"))
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    table = own.read.parquet(path)
    ranged = [f.name for f in table.schema if isinstance(f.dataType, (IntegralType, FractionalType, DateType))
              and not isinstance(f.dataType, DecimalType)]
    names = [f.name for f in table.schema if isinstance(f.dataType, AtomicType)]
    counted = table.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count(n).alias(f"n_{i}") for i, n in enumerate(names)],
        *[f(n).alias(f"{k}_{i}") for i, n in enumerate(names) if n in ranged for f, k in ((F.min, "low"), (F.max, "high"))],
    )
    fractions = {f.name for f in table.schema if isinstance(f.dataType, FractionalType)}

    def shown(name: str, bound: str) -> Column:
        if name not in ranged:
            return F.lit(None).cast("string")
        found = F.col(f"{bound}_{names.index(name)}")
        # A footer's least zero is negative and its greatest positive, whichever the values are.
        return (found + F.lit(0.0) if name in fractions else found).cast("string")

    lines = [
        F.struct(
            F.lit(n).alias("attribute"), F.greatest("rows", F.lit(0)).alias("nb_rows"),  # no footer: no sum of counts
            F.greatest(F.col(f"n_{i}"), F.lit(0)).alias("nb_present"),
            shown(n, "low").alias("low"), shown(n, "high").alias("high"),
        )
        for i, n in enumerate(names)
    ]
    return counted.select(F.inline(F.array(*lines)))
