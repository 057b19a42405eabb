"""Packing of tokenised documents into fixed-length sequences by a configuration linear program.

Documents become ids of the tokenizers library, end with END, and are cut into pieces of at most CAPACITY tokens.
Only the histogram of piece lengths, at most CAPACITY numbers, goes to the driver. There the configuration program
(fewest sequences so that every length is covered) is solved by multiplicative weights: lengths that the sequences
so far cover too little become dearer, and knapsack dynamic programming finds the worthiest configurations at the
current prices. Solutions are rounded to whole sequences in several dives, the small rest is packed best fit, always
by counts of lengths. Back in Spark the pieces are numbered within their length and looked up in that plan.

A piece counts as the next of its length, whichever document it is from. Null and empty texts are the single id END;
repeated rows and rows without doc_id are documents of their own; other columns play no part. Very long texts are
encoded and cut whole. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortscope.llm.bpe import byte_characters
from cohortscope.llm.shared import land, numbered
from cohortscope.llm.text import Block, blocks, span_hashes

VOCABULARY = "byte_bpe_50k.json"
CAPACITY = 1024
END = 2
#: Rounds of weights before each rounding, step of the weights, share of the best value that a configuration must have.
ROUNDS, STEP, NEAR_BEST = 40, 0.1, 0.999
DIVES = 6


# --- Ids and pieces ---------------------------------------------------------------------------


_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E), *range(0x1C, 0x20)]] = True
#: Last bytes of the white space beyond ASCII, by the bytes before them.
_WIDE_SPACES = {
    b"\xc2": [0x85, 0xA0], b"\xe1\x9a": [0x80], b"\xe2\x80": [*range(0x80, 0x8B), 0xA8, 0xA9, 0xAF],
    b"\xe2\x81": [0x9F], b"\xe3\x80": [0x80],
}


def chunk_starts(block: Block) -> np.ndarray:
    """Where the block's chunks begin: at each text, and at each space after anything but white space."""
    data = block.data
    begins = np.zeros(len(data), dtype=bool)
    begins[1:] = (data[1:] == 0x20) & ~_IS_SPACE[data[:-1]]
    beyond = np.flatnonzero(begins[1:] & (data[:-1] >= 0x80)) + 1  # spaces after characters beyond ASCII
    for lead, last in _WIDE_SPACES.items():
        wide = np.isin(data[beyond - 1], last)
        for k, byte in enumerate(reversed(lead), 2):
            wide &= (beyond >= k) & (data[np.maximum(beyond - k, 0)] == byte)
        begins[beyond[wide]] = False
    begins[block.offsets[:-1][np.diff(block.offsets) > 0]] = True
    return np.flatnonzero(begins)


#: The public pattern of the vocabulary, where only ASCII occurs.
_ASCII_PATTERN = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^ \t\n\v\f\rA-Za-z0-9]+|[ \t\n\v\f\r]+(?![^ \t\n\v\f\r])|[ \t\n\v\f\r]+")
_SHOWN = {b: c for b, c in enumerate(byte_characters()[:128])}


class ChunkEncoder:
    """Ids of texts, remembered by chunk.

    The pre-tokenizer never joins a space to the character before it unless that is white space too, so a text may
    be cut before every other space and its chunks be encoded one by one. Equal chunks (of equal 64-bit hashes) are
    encoded once, as long as at most LIMIT are remembered, beyond those of one block. ASCII chunks are split by the
    vocabulary's pattern and their parts go to the library's merges; others go through the whole library.
    """

    LIMIT, PARTS = 1 << 21, 1 << 18

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.model = self.tokenizer.model
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, dtype=np.uint64)  # sorted hashes
        self.place = np.zeros(0, dtype=np.int64)  # where the chunk of each is found in `starts`
        self.ids = np.zeros(0, dtype=np.int32)
        self.starts = np.zeros(1, dtype=np.int64)
        self.parts: dict[str, list[int]] = {}

    def _ascii(self, chunk: str) -> list[int]:
        ids: list[int] = []
        for part in _ASCII_PATTERN.findall(chunk):
            own = self.parts.get(part)
            if own is None:
                own = self.parts[part] = [t.id for t in self.model.tokenize(part.translate(_SHOWN))]
            ids += own
        return ids

    def _ids(self, chunks: list[str]) -> list[list[int]]:
        if len(self.parts) > self.PARTS:
            self.parts = {}
        ids = [self._ascii(chunk) if chunk.isascii() else None for chunk in chunks]
        others = [chunk for chunk, own in zip(chunks, ids, strict=True) if own is None]
        encoded = iter(self.tokenizer.encode_batch_fast(others, add_special_tokens=False))
        return [next(encoded).ids if own is None else own for own in ids]

    def _learn(self, hashes: np.ndarray, chunks: list[str]) -> None:
        """Encode chunks that are not known; their hashes are sorted."""
        ids = self._ids(chunks)
        sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        flat = np.fromiter(chain.from_iterable(ids), dtype=np.int32, count=int(sizes.sum()))
        at = np.searchsorted(self.known, hashes)
        self.place = np.insert(self.place, at, len(self.known) + np.arange(len(hashes)))
        self.known = np.insert(self.known, at, hashes)
        self.ids = np.concatenate([self.ids, flat])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])

    def encode(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a block's texts in one array, and where each text's ids begin in it (one entry more)."""
        if len(self.known) > self.LIMIT or len(self.ids) > 8 * self.LIMIT:
            self._forget()
        starts = chunk_starts(block)
        ends = np.append(starts[1:], len(block.data))
        hashes, first, of = np.unique(
            span_hashes(block.prefix_sums(), starts, ends), return_index=True, return_inverse=True)
        at = np.searchsorted(self.known, hashes)
        new = np.ones(len(hashes), dtype=bool)
        new[at < len(self.known)] = self.known[at[at < len(self.known)]] != hashes[at < len(self.known)]
        if new.any():
            data = block.data.tobytes()
            spans = zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)
            self._learn(hashes[new], [data[a:b].decode("utf-8", "replace") for a, b in spans])
        places = self.place[np.searchsorted(self.known, hashes)][of]
        lengths = self.starts[places + 1] - self.starts[places]
        until = np.cumsum(lengths)
        gather = np.arange(int(lengths.sum())) + np.repeat(self.starts[places] - (until - lengths), lengths)
        bounds = np.concatenate([[0], until])[np.searchsorted(starts, block.offsets)]
        return self.ids[gather], bounds


@lru_cache(maxsize=1)
def _encoder(path: str) -> ChunkEncoder:
    """One encoder a worker process, which remembers chunks from one task to the next."""
    return ChunkEncoder(path)


def cut(n: int, capacity: int) -> list[int]:
    """Lengths of the pieces of a document of `n` ids: full ones, a shorter one first."""
    return ([n % capacity] if n % capacity else []) + [capacity] * (n // capacity)


def pieces(docs: DataFrame, capacity: int = CAPACITY, end: int = END, path: str | None = None) -> DataFrame:
    """One row a piece: doc_id, piece (from 0), start (ids of its document before it), length, and its ids as packed
    little-endian unsigned 32-bit numbers, as loaders read them."""
    path = path or public_tokenizers.path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        encoder = _encoder(path)
        for batch in batches:
            for block in blocks(batch.column("text")):
                ids, bounds = encoder.encode(block)
                rows, numbers, starts, lengths, packed = [], [], [], [], []
                for row, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
                    own = np.append(ids[a:b], end).astype("<u4")
                    start = 0
                    for number, length in enumerate(cut(len(own), capacity)):
                        rows.append(row)
                        numbers.append(number)
                        starts.append(start)
                        lengths.append(length)
                        packed.append(own[start : start + length].tobytes())
                        start += length
                of = batch.column("doc_id").slice(block.first, len(block))
                yield pa.RecordBatch.from_arrays(
                    [of.take(pa.array(rows, pa.int64())), pa.array(numbers, pa.int32()), pa.array(starts, pa.int64()),
                     pa.array(lengths, pa.int64()), pa.array(packed, pa.binary())],
                    ["doc_id", "piece", "start", "length", "ids"])

    schema = "doc_id bigint, piece int, start bigint, length bigint, ids binary"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


# --- The configuration program ------------------------------------------------------------------


def knapsack(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For every room the highest price of sizes that fit, and the index of a size to take first: the largest of
    equally good ones, or -1 where one token is better left empty."""
    best = np.zeros(capacity + 1)
    pick = np.full(capacity + 1, -1, dtype=np.int64)
    down, worth_down = sizes[::-1].copy(), prices[::-1].copy()
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        over = len(sizes) - np.searchsorted(sizes, room, side="right")
        if over < len(sizes):
            worth = worth_down[over:] + best[room - down[over:]]
            at = int((worth >= worth.max() - 1e-12).argmax())
            if worth[at] >= best[room]:
                best[room], pick[room] = worth[at], len(sizes) - 1 - over - at
    return best, pick


def _configuration(sizes: list[int], pick: list[int], first: int, capacity: int) -> tuple[int, ...]:
    """The best configuration that holds the size with index `first`, as size indices."""
    taken, room = [first], capacity - sizes[first]
    while room > 0:
        at = pick[room]
        if at >= 0:
            taken.append(at)
            room -= sizes[at]
        else:
            room -= 1
    return tuple(sorted(taken))


@dataclass
class Program:
    """A fractional solution: configurations with their amounts, and a lower bound on any number of sequences."""

    amounts: dict[tuple[int, ...], float]
    bound: float


def solve(sizes: np.ndarray, counts: np.ndarray, capacity: int, rounds: int = ROUNDS) -> Program:
    """Multiplicative weights on the covering program over the lengths `sizes` (ascending), wanted `counts` times.

    Prices start in proportion to length. In each round the lengths propose, long ones first, the worthiest
    configuration that holds them; those near the best are taken until a length in them is covered, and the prices
    of the others grow by the share that is not covered yet. Covered lengths leave. Any prices bound the number of
    sequences from below: the total price of all pieces over the worth of the best configuration.
    """
    weights = np.zeros(len(sizes))
    left = counts.astype(np.float64)
    amounts: dict[tuple[int, ...], float] = {}
    bound = float((sizes * counts).sum() / capacity)
    for turn in range(rounds):
        open_ = np.flatnonzero(left > 1e-9 * counts)
        if not len(open_):
            break
        own = sizes[open_]
        prices = own / capacity * np.exp(weights[open_])
        best, pick = knapsack(own, prices, capacity)
        worth = prices + best[capacity - own]
        if turn == 0 or len(open_) == len(sizes):
            bound = max(bound, float((prices * counts[open_]).sum() / worth.max()))
        listed, picks = own.tolist(), pick.tolist()
        near = worth >= NEAR_BEST * worth.max() if turn < rounds - 1 else np.ones(len(open_), dtype=bool)
        for first in np.flatnonzero(near)[::-1].tolist():
            if left[open_[first]] <= 0:
                continue
            configuration = tuple(open_[list(_configuration(listed, picks, first, capacity))].tolist())
            which, each = np.unique(configuration, return_counts=True)
            amount = float((left[which] / each).min())
            if amount > 0:
                left[which] -= amount * each
                amounts[configuration] = amounts.get(configuration, 0.0) + amount
        weights += STEP * np.clip(left / counts, 0, 1)
    return Program(amounts, bound)


def _commit(plan: list, left: np.ndarray, configuration: tuple[int, ...], copies: int) -> int:
    """Add as many copies, up to `copies`, as the counts that are left allow."""
    which, each = np.unique(configuration, return_counts=True)
    copies = min(copies, int((left[which] // each).min()))
    if copies > 0:
        left[which] -= copies * each
        plan.append((configuration, copies))
    return max(copies, 0)


def _best_fit(sizes: np.ndarray, left: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit by decreasing length, over groups of sequences with equal content."""
    rooms: dict[int, dict[tuple[int, ...], int]] = {capacity: {}}
    for size in range(len(sizes) - 1, -1, -1):
        length, todo = int(sizes[size]), int(left[size])
        while todo:
            room = min((r for r, groups in rooms.items() if r >= length and groups), default=None)
            if room is None:  # new sequences, each filled with as many of this length as fit
                each = min(capacity // length, todo)
                new = todo // each
                groups = rooms.setdefault(capacity - each * length, {})
                groups[(size,) * each] = groups.get((size,) * each, 0) + new
                todo -= new * each
                continue
            content, copies = next(iter(rooms[room].items()))
            use = min(copies, todo)
            rooms[room][content] -= use
            if not rooms[room][content]:
                del rooms[room][content]
            groups = rooms.setdefault(room - length, {})
            groups[content + (size,)] = groups.get(content + (size,), 0) + use
            todo -= use
    return [(content, copies) for groups in rooms.values() for content, copies in groups.items() if copies]


@dataclass
class Plan:
    """Whole sequences: (lengths, copies), and the program's lower bound on their number."""

    sequences: list[tuple[tuple[int, ...], int]]
    bound: int

    def __len__(self) -> int:
        return sum(copies for _, copies in self.sequences)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Whole sequences that hold every length as often as it is counted.

    Each dive solves the program for what is left and takes the whole parts of the amounts of full configurations,
    or single copies where all are fractions. What a dive leaves can be packed best fit or go to the next dive; the
    rounding with the fewest sequences counts.
    """
    sizes = np.array(sorted(n for n, c in counts.items() if c), dtype=np.int64)
    left = np.array([counts[n] for n in sizes.tolist()], dtype=np.int64)
    made: list[tuple[tuple[int, ...], int]] = []
    best, fewest, bound = [], None, 0
    for _ in range(DIVES):
        some = np.flatnonzero(left)
        if not len(some):
            break
        program = solve(sizes[some], left[some], capacity)
        bound = bound or int(np.ceil(program.bound - 1e-6))
        amounts = {tuple(some[list(c)].tolist()): x for c, x in program.amounts.items()}
        full = sorted((c for c in amounts if sizes[list(c)].sum() == capacity), key=lambda c: (-amounts[c], c))
        taken = sum([_commit(made, left, c, int(amounts[c])) for c in full])
        if not taken:
            taken = sum([_commit(made, left, c, 1) for c in full[: len(full) // 2 + 1]])
        rounded = made + _best_fit(sizes, left, capacity)
        number = sum(copies for _, copies in rounded)
        if fewest is None or number < fewest:
            best, fewest = rounded, number
        if not taken or fewest <= bound:
            break
    return Plan([(tuple(int(sizes[i]) for i in c), copies) for c, copies in best], bound)


# --- Placement ----------------------------------------------------------------------------------


def _lookup(sequences: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """One row for each length of a configuration: length, first number within the length, copies, first sequence,
    first offset; sorted by length and number. Numbers run over the copies before the next place in a sequence."""
    used: dict[int, int] = {}
    rows, first = [], 0
    for lengths, copies in sequences:
        offset = 0
        for length in sorted(lengths, reverse=True):
            number = used.get(length, 0)
            rows.append((length, number, copies, first, offset))
            used[length] = number + copies
            offset += length
        first += copies
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pack(cut_pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The rows of `pieces` (with their other columns, `ids` or what was made of them), and where each piece goes:
    sequence_id and offset, gapless from 0 within a sequence.

    The rows are landed, so `ids` are best left out where only places are wanted. The plan's table is broadcast; it
    holds at most CAPACITY times ROUNDS times DIVES configurations, whatever the number of pieces.
    """
    names = cut_pieces.columns
    landed = land(cut_pieces, "pieces")
    # At most `capacity` rows.
    counts = {r["length"]: r["n"] for r in landed.groupBy("length").agg(F.count("*").alias("n")).collect()}
    table = landed.sparkSession.sparkContext.broadcast(_lookup(plan(counts, capacity).sequences))
    earlier, total = {}, 0
    for length in sorted(counts):
        earlier[length], total = total, total + counts[length]
    before = landed.sparkSession.sparkContext.broadcast(earlier)
    order = ["length", "doc_id", "piece", "start"]
    ranked = numbered(landed, order, {"_number": F.lit(1)}, "numbered_pieces")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = table.value
        span = total + 1
        keys = rows[:, 0] * span + rows[:, 1]
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            first = np.array([before.value[n] for n in lengths.tolist()], dtype=np.int64)
            number = batch.column("_number").to_numpy() - 1 - first
            at = rows[np.searchsorted(keys, lengths * span + number, side="right") - 1]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], pa.array(at[:, 3] + number - at[:, 1]), pa.array(at[:, 4])],
                [*names, "sequence_id", "offset"])

    schema = landed.select(*names).schema.add("sequence_id", "long").add("offset", "long")
    return ranked.mapInArrow(run, schema)
