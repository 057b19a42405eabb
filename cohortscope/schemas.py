"""Explicit schemas of the raw inputs; nothing is inferred."""

from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from cohortscope.settings import WIDE_VALUE_COLUMNS

STUDENTS_RAW = StructType([
    StructField("USER_ID", StringType()),
    StructField("PATH_CATEGORY_NAME", StringType()),
    StructField("AGE_GROUP", StringType()),
    StructField("GENDER", StringType()),
    StructField("REGION", StringType()),
    StructField("YEAR_PATH_STARTED", IntegerType()),
])

POPULATION_RAW = StructType([
    StructField("REGION", StringType()),
    StructField("SEXE", StringType()),
    StructField("AGE_GROUP", StringType()),
    StructField("POPULATION", LongType()),
    StructField("ANNEE", IntegerType()),
])

LABELS = StructType([StructField("source", StringType()), StructField("target", StringType())])

WIDE_COLUMNS = [f"c{i}" for i in range(1, WIDE_VALUE_COLUMNS + 1)]

# One yearly sheet per `year=` folder; cells stay text until the header rows are gone.
POPULATION_WIDE = StructType(
    [StructField("region", StringType())]
    + [StructField(name, StringType()) for name in WIDE_COLUMNS]
    + [StructField("year", IntegerType())]
)
