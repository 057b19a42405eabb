"""Minimax contiguous partition: ordered groups are cut into shards so that the largest shard is smallest.

The capacity is found by binary search; a capacity is feasible if greedy filling needs no more shards than
there are. The search runs over a summary of the groups, whose size is fixed: for each cut a window of group
numbers that must hold it, divided into cells, with the end of the last group in each cell. A cell with several
groups leaves the cut uncertain, so each search gives a lower and an upper capacity, and the next summary covers
the smaller windows between them, until every cell holds a single group and the search is exact.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortscope.llm.shared import land, numbered

#: Cells of a window: the summary has at most this many pairs of numbers for each cut.
CELLS = 4096
ROW_BYTES = 16

Window = tuple[int, int]
Known = dict[Window, list[tuple[int, int]]]


@dataclass(frozen=True)
class Search:
    """Bounds of the capacity, for each cut the first and last group that it may follow, and the cuts themselves
    once all windows fit into cells of one group."""

    low: int
    high: int
    windows: tuple[Window, ...]
    cells: int = CELLS
    cuts: tuple[int, ...] = ()


def sizes(docs: DataFrame) -> DataFrame:
    """One row a document: its size, checksum and the key of its group of equal texts.

    A null text counts as empty and shares the group of the empty texts. Other columns are not read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id",
        (F.octet_length(text) + ROW_BYTES).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.sha2(text, 256).alias("group_key"),
    )


def _width(window: Window, cells: int) -> int:
    return -(-(window[1] - window[0] + 1) // cells)


def _summary(ends: DataFrame, search: Search) -> Known:
    """For each window the number and end of the last group in each cell, ascending.

    At most CELLS pairs a window come to the driver, whatever the number of groups.
    """
    number = F.col("number")
    cells = ends.select("number", "end", F.explode(F.array(*[
        F.when(number.between(*window), F.struct(
            F.lit(i).alias("window"), F.floor((number - window[0]) / _width(window, search.cells)).alias("cell")))
        for i, window in enumerate(dict.fromkeys(search.windows))
    ])).alias("at")).where("at IS NOT NULL")
    last = cells.groupBy("at").agg(F.max(F.struct("number", "end")).alias("last"))
    by_window = last.groupBy(F.col("at.window").alias("window")).agg(F.sort_array(F.collect_list("last")).alias("last"))
    rows = {row["window"]: [tuple(x) for x in row["last"]] for row in by_window.collect()}
    return {window: rows[i] for i, window in enumerate(dict.fromkeys(search.windows))}


def _cuts(capacity: int, known: Known, search: Search, optimistic: bool) -> list[tuple[int, int]]:
    """Greedy cuts for a capacity, as (group, bytes): each shard ends at the last group end it has room for.

    Pessimistic cuts are group ends that are known, so they are feasible. Optimistic cuts take all the room
    where a cell may hide an end, so no true greedy cut lies beyond them.
    """
    cuts, cut = [], 0
    for window in search.windows:
        last, room = known[window], cut + capacity
        at = bisect_right(last, room, key=lambda pair: pair[1])
        group, end = last[at - 1] if at else (window[0], cut)
        nearest = last[at - 1][0] if at else window[0] - 1
        if optimistic and at < len(last) and last[at][0] - nearest > 1:
            group, end = last[at][0] - 1, room
        cut = max(cut, end)
        cuts.append((group, cut))
    return cuts


def _smallest(known: Known, search: Search, total: int, optimistic: bool) -> int:
    """The smallest capacity between the bounds for which the cuts reach the end; the upper bound if none does."""
    low, high = search.low, search.high
    while low < high:
        middle = (low + high) // 2
        if _cuts(middle, known, search, optimistic)[-1][1] >= total:
            high = middle
        else:
            low = middle + 1
    return high


def _narrow(ends: DataFrame, search: Search, total: int) -> Search:
    known = _summary(ends, search)
    low, high = (_smallest(known, search, total, optimistic) for optimistic in (True, False))
    if all(_width(window, search.cells) == 1 for window in search.windows):
        return replace(search, low=high, high=high, cuts=tuple(cut for _, cut in _cuts(high, known, search, False)))
    earliest, latest = _cuts(low, known, search, False), _cuts(high, known, search, True)
    windows = tuple((min(a, b), max(a, b)) for (a, _), (b, _) in zip(earliest, latest, strict=True))
    found = Search(low, high, windows, search.cells)
    return replace(found, cells=2 * search.cells) if found == search else found


def greedy_cuts(ends: DataFrame, shards: int) -> list[int]:
    """The ends of the shards of the greedy filling at the smallest feasible capacity.

    `ends` has one row a group: its `number` in order from 1, `end`, the bytes up to its end, and `group_size`.
    """
    row = ends.agg(F.max("end").alias("total"), F.max("group_size").alias("largest"), F.count("*").alias("n")).first()
    if not row["n"]:
        return []
    low = max(-(-row["total"] // shards), row["largest"])
    search = Search(low, low + row["largest"], ((1, row["n"]),) * shards)
    while not search.cuts:
        search = _narrow(ends, search, row["total"])
    return list(search.cuts)


def shard(docs: DataFrame, shards: int) -> DataFrame:
    """Put every document into one of `shards` shards of nearly equal bytes; equal texts stay together.

    Groups are ordered by the hash of their text. Returns doc_id, size, text_crc32, shard and slot, the place
    within the shard without gaps. Repeated rows are rows of their own; no documents give no rows.
    """
    placed = land(
        numbered(sizes(docs), ["group_key", "doc_id"], {"end": F.col("size"), "place": F.lit(1)}, "shard_order"),
        "shard_places",
    )
    groups = placed.groupBy("group_key").agg(F.max("end").alias("end"), F.sum("size").alias("group_size"))
    ends = land(numbered(groups.drop("group_key"), ["end"], {"number": F.lit(1)}, "shard_groups"), "shard_ends")
    cuts = greedy_cuts(ends, shards)
    inside = F.filter(F.array(*map(F.lit, cuts)).cast("array<bigint>"), lambda cut: cut < F.col("end"))
    dealt = placed.withColumn("shard", F.size(inside))
    # One row a shard.
    firsts = dealt.groupBy("shard").agg(F.min("place").alias("first_place"))
    return dealt.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("place") - F.col("first_place")).alias("slot")
    )
