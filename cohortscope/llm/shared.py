"""Helpers that several operators use: landed tables, sort order as numbers, bounded broadcasts."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortscope.sources.shared import land

__all__ = ["broadcast_if_small", "components", "land", "let", "numbered", "partitions", "releasing", "small_batches"]


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once, however often `use` names it, also inside lambdas."""
    return F.transform(F.array(value), use)[0]


_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(df: DataFrame) -> None:
    """Hand a thousand rows at a time to Python where the session has Spark's default of ten thousand: rows that hold
    whole texts or sets are then some megabytes a batch, on both sides. A setting of the session's own stays."""
    conf = df.sparkSession.conf
    if conf.get(_BATCH_ROWS) == "10000":
        conf.set(_BATCH_ROWS, "1000")


def releasing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """A task function that hands back at its end the memory it has freed. Workers are used again by later tasks, and
    Arrow and the C library keep what was freed, so that idle workers would hold their peaks beside the busy ones."""

    @functools.wraps(run)
    def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            _give_back()

    return released


def _give_back() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the GNU library's
    if trim:
        trim(0)


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def numbered(df: DataFrame, order: list[str], sums: dict[str, Column], name: str) -> DataFrame:
    """Add running totals of `sums` (named columns, each including its own row) in the order of `order`.

    Ranges of the order are dealt to tasks, so equal leading keys are split as long as `order` tells rows apart.
    Each range is landed with its number; the totals of the ranges, one row a range, are the only rows that meet
    in one window, and are added to the running totals inside the ranges.
    """
    landed = land(
        df.repartitionByRange(partitions(df), *order).withColumn("_range", F.spark_partition_id()), name
    )
    totals = landed.groupBy("_range").agg(*[F.sum(c).alias(f"_t_{n}") for n, c in sums.items()])
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_range", *[F.coalesce(F.sum(f"_t_{n}").over(earlier), F.lit(0)).alias(f"_o_{n}") for n in sums]
    )
    # One row a range: as many as there are shuffle partitions, whatever the input.
    within = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    running = landed.select("*", *[F.sum(c).over(within).alias(f"_w_{n}") for n, c in sums.items()])
    return running.join(F.broadcast(offsets), "_range").select(
        *df.columns, *[(F.col(f"_w_{n}") + F.col(f"_o_{n}")).cast("bigint").alias(n) for n in sums]
    )


#: Rows up to which a landed table of a few numbers a row is broadcast.
MAX_BROADCAST_ROWS = 1_000_000


def broadcast_if_small(landed: DataFrame) -> DataFrame:
    """Hint a broadcast for a landed table of at most a million narrow rows; larger ones are joined by a shuffle."""
    return F.broadcast(landed) if landed.count() <= MAX_BROADCAST_ROWS else landed


def components(edges: DataFrame, name: str) -> DataFrame:
    """The nodes of `edges` (a, b) and the smallest node they reach, as columns node and root.

    Each round hooks every node to its smallest neighbour, follows the hooks four steps, and keeps the edges
    between different ends. Tables are landed, so neither the plan nor the driver grows, and joins on a node with
    many edges can be split.
    """
    links = land(_between(edges.select("a", "b")), f"{name}_edges")
    nodes = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    roots = land(nodes.withColumn("root", F.col("node")), f"{name}_roots")
    while not links.isEmpty():
        both = links.union(links.select("b", "a"))
        smallest = both.groupBy("a").agg(F.min("b").alias("b"))
        hooks = land(smallest.select(F.col("a").alias("x"), F.least("a", "b").alias("y")), f"{name}_hooks")
        for _ in range(2):
            further = hooks.select(F.col("x").alias("y"), F.col("y").alias("z"))
            hooks = land(hooks.join(further, "y").select("x", F.col("z").alias("y")), f"{name}_hooks")
        left = links.join(hooks.withColumnRenamed("x", "a"), "a").select(F.col("y").alias("a"), "b")
        moved = left.join(hooks.withColumnRenamed("x", "b"), "b").select("a", F.col("y").alias("b"))
        links = land(_between(moved), f"{name}_edges")
        roots = land(roots.join(hooks.withColumnRenamed("x", "root"), "root", "left").select(
            "node", F.coalesce("y", "root").alias("root")), f"{name}_roots")
    return roots


def _between(edges: DataFrame) -> DataFrame:
    return edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()
