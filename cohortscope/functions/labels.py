"""Cleaning and mapping of labels."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labels up to which a mapping becomes one expression; a larger one becomes a table that is joined.
MAX_EXPRESSION_LABELS = 1_000
#: Labels up to which a map table is broadcast: two texts a row, some tens of megabytes.
MAX_BROADCAST_LABELS = 200_000


def blank_to(text: Column, label: str) -> Column:
    """Trimmed text, or `label` where the text is null or only spaces."""
    trimmed = F.trim(text)
    return F.when(trimmed.isNull() | (trimmed == ""), F.lit(label)).otherwise(trimmed)


def recode(value: Column, labels: Mapping, keep_unknown: bool = False) -> Column:
    """Map values n to 1. Unlisted values become null, or pass through with `keep_unknown`."""
    sources: dict = {}
    for source, target in labels.items():
        sources.setdefault(target, []).append(source)
    branches = [F.when(value.isin(listed), F.lit(target)) for target, listed in sources.items()]
    return F.coalesce(*branches, value if keep_unknown else F.lit(None))


def checked_labels(labels: DataFrame) -> tuple[DataFrame, int]:
    """A map table (source, target) and its number of rows. A source that is listed twice is refused, also with equal
    targets; the first few are named."""
    again = labels.where("source IS NOT NULL").groupBy("source").count().where("count > 1").orderBy("source").limit(5)
    repeated = [row["source"] for row in again.collect()]
    if repeated:
        raise ValueError(f"labels are mapped more than once: {', '.join(map(str, repeated))}")
    return labels, labels.count()


def relabel(df: DataFrame, column: str, labels: Mapping | DataFrame, into: str,
            keep_unknown: bool = False, drop_unknown: bool = False) -> DataFrame:
    """Add `into`: the label of `column`, by a mapping or a table (source, target).

    Unlisted values become null, pass through with `keep_unknown`, or their rows go with `drop_unknown`; a null value
    is unlisted. A small mapping is an expression. A larger one, and a table, is joined: broadcast up to a counted
    size, beyond it by the plan that Spark picks, where the adaptive skew join splits hot labels.
    """
    if isinstance(labels, Mapping):
        if len(labels) <= MAX_EXPRESSION_LABELS:
            rows = df.where(F.col(column).isin(*labels)) if drop_unknown else df
            return rows.withColumn(into, recode(F.col(column), labels, keep_unknown))
        table = df.sparkSession.createDataFrame(list(labels.items()), "source string, target string")
        size = len(labels)
    else:
        table, size = checked_labels(labels)
    table = table.select(F.col("source").alias("__source"), F.col("target").alias("__target")).where("__source IS NOT NULL")
    if size <= MAX_BROADCAST_LABELS:
        table = F.broadcast(table)
    joined = df.join(table, F.col(column) == F.col("__source"), "inner" if drop_unknown else "left")
    known = F.col("__source").isNotNull()
    target = F.when(known, F.col("__target")).otherwise(F.col(column)) if keep_unknown else F.col("__target")
    return joined.withColumn(into, target).drop("__source", "__target")
