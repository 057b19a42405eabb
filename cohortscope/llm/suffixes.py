"""Removal of repeated byte strings by sorting suffixes with a difference cover.

Only suffixes that can matter are sorted. Every window of `length` bytes has an anchor: the leftmost of its k-grams
with the smallest hash, which depends on the window's bytes alone. Equal windows have equal anchors at equal
offsets, so consecutive windows with one anchor form a run, runs are grouped by the anchor's k-gram, and a k-gram
that occurs once, or always inside the same run of bytes, settles its windows without sorting. The different runs
that share a k-gram are dealt to tasks by it, and there their suffixes are sorted: the triples at the positions 1
and 2 modulo 3 are sorted and named, the names sorted by recursion, the remaining suffixes merged in, and windows
that are neighbours in that order are compared. A k-gram with very many different runs would fill one task, so its
windows are compared as rows of their own instead, which Spark deals to all tasks and combines before it shuffles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortscope.llm.shared import MAX_BROADCAST_ROWS, land
from cohortscope.llm.text import Block, blocks, constants, mix, span_hashes

LENGTH = 400
GRAM = 128
#: Different runs of one k-gram that a task sorts together, 2.5 MB at most; beyond it, their windows become rows.
MAX_RUNS = 3600
#: Bytes of runs after which a task sorts what it has, once a k-gram's runs are complete.
SORTED_BYTES = 1 << 19
_SHAPE = constants(3, 23)


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """The starts of all suffixes in sorted order, by a difference cover modulo 3.

    Symbols are from 1 to 2**21 - 1, and at most 3 * 2**20 of them, so that three names fit into 64 bits.
    """
    n = len(symbols)
    if n < 4:
        return np.array(sorted(range(n), key=lambda i: symbols[i:].tolist()), dtype=np.int64)
    s = np.concatenate([symbols, np.zeros(3, dtype=np.int64)])
    ones, twos = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)
    sample = np.concatenate([ones, twos])
    triples = s[sample] << 42 | s[sample + 1] << 21 | s[sample + 2]
    order = np.argsort(triples, kind="stable")
    names = np.empty(len(sample), dtype=np.int64)
    names[order] = np.concatenate([[1], 1 + np.cumsum(np.diff(triples[order]) != 0)])
    by_suffix = order if names.max() == len(sample) else suffix_array(names)
    rank = np.zeros(n + 3, dtype=np.int64)
    rank[sample[by_suffix]] = np.arange(1, len(sample) + 1)
    # The remaining suffixes, sorted by their first symbol and the rank of what follows.
    rest = np.arange(0, n, 3)
    base = len(sample) + 2
    one_key = s[rest] * base + rank[rest + 1]
    rest = rest[np.argsort(one_key, kind="stable")]
    sorted_sample = sample[by_suffix]
    sorted_sample = sorted_sample[sorted_sample < n]
    first, second = (sorted_sample[sorted_sample % 3 == r] for r in (1, 2))
    # Each of them goes behind the sampled suffixes of either kind that are smaller.
    smaller = np.searchsorted(s[first] * base + rank[first + 1], s[rest] * base + rank[rest + 1])

    def two_key(at: np.ndarray) -> np.ndarray:
        return (s[at] << 21 | s[at + 1]) * base + rank[at + 2]

    smaller += np.searchsorted(two_key(second), two_key(rest))
    result = np.empty(n, dtype=np.int64)
    places = np.arange(len(rest)) + smaller
    taken = np.zeros(n, dtype=bool)
    taken[places] = True
    result[places] = rest
    result[~taken] = sorted_sample
    return result


def _anchors(block: Block, sums: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """The starts of all windows within a text, and the position of each one's anchor."""
    ends = np.repeat(block.offsets[1:], np.diff(block.offsets))
    starts = np.flatnonzero(ends - np.arange(len(ends)) >= length)
    if not len(starts):
        return starts, starts
    width, grams = length - gram + 1, len(block.data) - gram + 1
    at = np.arange(grams)
    bits = np.uint64((width - 1).bit_length())
    keys = np.full(-(-grams // width) * width + width, np.iinfo(np.uint64).max, dtype=np.uint64)
    keys[:grams] = (span_hashes(sums, at, at + gram) >> bits << bits) | (at % width).astype(np.uint64)
    rows = keys.reshape(-1, width)
    before = np.minimum.accumulate(rows, axis=1).ravel()
    after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    left, right = after[starts], before[starts + width - 1]
    local = (np.uint64(1) << bits) - np.uint64(1)
    bases = starts // width * width
    further = (starts % width != 0) & (right >> bits < left >> bits)
    return starts, np.where(further, bases + width + (right & local).astype(np.int64),
                            bases + (left & local).astype(np.int64))


def _runs_of(block: Block, length: int, gram: int) -> dict[str, np.ndarray]:
    """Runs of windows with one anchor: the text's index in the block, the first window's start in the text, the
    number of windows, the hash of the anchor and the hash of the run's bytes and the anchor's place in it."""
    sums = block.prefix_sums()
    starts, anchors = _anchors(block, sums, length, gram)
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (np.diff(anchors) != 0) | (np.diff(starts) != 1)
    firsts = np.flatnonzero(new)
    counts = np.diff(np.append(firsts, len(starts)))
    begin, anchor = starts[firsts], anchors[firsts]
    text = np.searchsorted(block.offsets, begin, side="right") - 1
    bytes_ = span_hashes(sums, begin, begin + counts + length - 1)
    shape = (anchor - begin).astype(np.uint64) * _SHAPE[0] + counts.astype(np.uint64) * _SHAPE[1]
    return {
        "text": text, "start": begin - block.offsets[text], "windows": counts,
        "anchor": span_hashes(sums, anchor, anchor + gram).view(np.int64),
        "run": mix(bytes_ + mix(shape)).view(np.int64),
    }


def _runs(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """A row for each run of windows of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text")):
                found = _runs_of(block, length, gram)
                rows = pa.array(found["text"] + block.first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(rows), batch.column("text_key").take(rows),
                     pa.array(found["anchor"]), pa.array(found["run"]),
                     pa.array(found["start"].astype(np.int32)), pa.array(found["windows"].astype(np.int32))],
                    ["doc_id", "text_key", "anchor", "run", "start", "windows"])

    schema = "doc_id bigint, text_key bigint, anchor bigint, run bigint, start int, windows int"
    return docs.select("doc_id", "text_key", "text").mapInArrow(run, schema)


def _cut_out(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of the wanted runs, taken from the documents that hold them (doc_id, text_key)."""
    by_text = land(wanted.groupBy("doc_id", "text_key").agg(
        F.collect_list(F.struct("anchor", "run", "start", "windows")).alias("wanted")), "wanted_runs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, runs in zip(batch.column("text"), batch.column("wanted"), strict=True):
                data, rows = text.as_buffer().to_pybytes(), runs.as_py()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["anchor"] for r in rows], pa.int64()), pa.array([r["run"] for r in rows], pa.int64()),
                     pa.array([r["windows"] for r in rows], pa.int32()),
                     pa.array([data[r["start"] : r["start"] + r["windows"] + length - 1] for r in rows], pa.binary())],
                    ["anchor", "run", "windows", "data"])

    runs = by_text.agg(F.sum(F.size("wanted")).alias("n")).first()["n"] or 0
    side = F.broadcast(by_text) if runs <= MAX_BROADCAST_ROWS else by_text  # a few numbers a run
    own = docs.select(F.col("doc_id").alias("id"), F.col("text_key").alias("key"), "text")
    joined = own.join(side, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("key") == F.col("text_key")))
    return joined.select("text", "wanted").mapInArrow(run, "anchor bigint, run bigint, windows int, data binary")


def _repeated(groups: list[tuple[int, int, int, bytes]], length: int) -> list[tuple[int, int, int, int]]:
    """For runs (anchor, run, windows, bytes), the stretches (anchor, run, from, to) of windows that occur in
    several of them: neighbours in the order of suffixes with the same first `length` bytes."""
    data = np.frombuffer(b"".join([g[3] for g in groups]), dtype=np.uint8)
    bounds = np.cumsum([0, *[len(g[3]) for g in groups]])
    counts = np.array([g[2] for g in groups])
    order = suffix_array(data.astype(np.int64) + 1)
    owner = np.searchsorted(bounds, order, side="right") - 1
    inside = order - bounds[owner] < counts[owner]
    windows, owner = order[inside], owner[inside]
    sums = Block(0, data, bounds).prefix_sums()
    prefixes = span_hashes(sums, windows, windows + length)
    same = prefixes[1:] == prefixes[:-1]
    repeated = np.zeros(len(data) + 1, dtype=bool)
    repeated[windows[1:][same]] = repeated[windows[:-1][same]] = True
    result = []
    for (anchor, run, count, _), first in zip(groups, bounds[:-1].tolist(), strict=True):
        edges = np.flatnonzero(np.diff(np.concatenate([[0], repeated[first : first + count].view(np.int8), [0]])))
        result += [(anchor, run, int(a), int(b)) for a, b in edges.reshape(-1, 2)]
    return result


_STRETCHES = "anchor bigint, run bigint, first int, last int"


def _sorted_groups(runs: DataFrame, length: int) -> DataFrame:
    """Stretches of repeated windows among runs that share an anchor, found by sorting suffixes in tasks."""

    def emit(rows: list) -> pa.RecordBatch:
        columns = list(zip(*_repeated(rows, length), strict=True)) or [[], [], [], []]
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                          ["anchor", "run", "first", "last"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending, size = [], 0
        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in ("anchor", "run", "windows", "data")], strict=True):
                if size >= SORTED_BYTES and row[0] != pending[-1][0]:
                    yield emit(pending)
                    pending, size = [], 0
                pending.append(row)
                size += len(row[3])
        if pending:
            yield emit(pending)

    dealt = runs.repartition("anchor").sortWithinPartitions("anchor", "run")
    return dealt.select("anchor", "run", "windows", "data").mapInArrow(run, _STRETCHES)


def _window_rows(runs: DataFrame, length: int) -> DataFrame:
    """The same stretches for anchors with very many runs, with a row for each window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for anchor, key, count, data in zip(*[batch.column(c) for c in ("anchor", "run", "windows", "data")],
                                                strict=True):
                n = count.as_py()
                block = Block(0, np.frombuffer(data.as_buffer(), np.uint8), np.array([0, n + length - 1]))
                at = np.arange(n)
                hashes = span_hashes(block.prefix_sums(), at, at + length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, anchor.as_py())), pa.array(np.full(n, key.as_py())),
                     pa.array(at.astype(np.int32)), pa.array(hashes.view(np.int64))],
                    ["anchor", "run", "at", "window"])

    rows = land(runs.select("anchor", "run", "windows", "data").mapInArrow(
        run, "anchor bigint, run bigint, at int, window bigint"), "windows")
    # Equal windows have equal anchors, so both hashes tell windows apart.
    window = ["anchor", "window"]
    several = land(rows.groupBy(*window).agg(F.count("*").alias("n")).where("n > 1").select(*window), "repeated_windows")
    return rows.join(several, window).select("anchor", "run", F.col("at").alias("first"), (F.col("at") + 1).alias("last"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """For each document with repeated bytes: doc_id, text_key and `spans`, the (first, last) byte ranges that are
    covered by a string of `length` bytes that also starts elsewhere. Ranges may overlap; `last` is exclusive.

    Rows with the same doc_id and text count as two texts. Texts that are null or shorter have no such string.
    """
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    runs = land(_runs(keyed, length, gram), "window_runs")
    kinds = land(runs.groupBy("anchor", "run").agg(
        F.count("*").alias("copies"), F.min(F.struct(
            F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key", "start", "windows")).alias("one")
    ).select("anchor", "run", "copies", "one.doc_id", "one.text_key", "one.start", "one.windows"), "run_kinds")
    shared = land(kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1"), "shared_anchors")
    several = kinds.join(shared, "anchor")
    cut = land(_cut_out(keyed, several, length).join(shared, "anchor")
               .dropDuplicates(["anchor", "run"]), "run_bytes")
    whole = kinds.where("copies > 1").select(
        "anchor", "run", F.lit(0).alias("first"), F.col("windows").alias("last"))
    stretches = land(
        whole.union(_sorted_groups(cut.where(F.col("kinds") <= MAX_RUNS), length))
        .union(_window_rows(cut.where(F.col("kinds") > MAX_RUNS), length)), "repeated_stretches")
    spans = runs.join(stretches, ["anchor", "run"]).select("doc_id", "text_key", F.struct(
        (F.col("start") + F.col("first")).alias("first"),
        (F.col("start") + F.col("last") - 1 + length).alias("last")).alias("span"))
    # As many ranges as a text has runs.
    return spans.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_set("span")).alias("spans"))


def _merged(spans: list[dict]) -> list[tuple[int, int]]:
    merged: list[list[int]] = []
    for span in spans or ():
        if merged and span["first"] <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], span["last"])
        else:
            merged.append([span["first"], span["last"]])
    return [(a, b) for a, b in merged]


def _rest(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    kept, at = [], 0
    for first, last in spans:
        kept.append(data[at:first])
        at = last
    return b"".join([*kept, data[at:]])


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """One row a document: doc_id, n_bytes, n_removed, n_spans (maximal removed ranges) and `kept`, the bytes left.

    A null text counts as empty. The bytes left need not be UTF-8, as a range may begin inside a character.
    """
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    spans = land(repeated_spans(docs, length, gram), "repeated_spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in batch.column("text")]
            merged = [_merged(s) for s in batch.column("spans").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([sum(b - a for a, b in m) for m in merged], pa.int64()),
                 pa.array([len(m) for m in merged], pa.int64()),
                 pa.array([_rest(t, m) for t, m in zip(texts, merged, strict=True)], pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    joined = keyed.withColumnRenamed("doc_id", "id").join(
        spans.withColumnRenamed("doc_id", "of"),
        F.col("id").eqNullSafe(F.col("of")) & (keyed["text_key"] == spans["text_key"]), "left")
    return joined.select(F.col("id").alias("doc_id"), "text", "spans").mapInArrow(
        run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
