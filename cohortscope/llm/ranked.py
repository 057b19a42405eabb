"""Ranked lexical search: exact top documents by an integer BM25, over posting lists in geometric blocks.

A pass over the documents keeps the terms that an item asks for, with their counts (`forward`). Document counts give
every term its weight, and weight, count and length give its impact in a document. A shard is a run of rows of one
task; its index is built and used there, so that a term in every document is split like the documents are:

* Terms are numbered from the commonest to the rarest. A document is looked for under the rarest term it shares with
  an item, so a block of term t has to answer for t and commoner terms only.
* A posting list is clustered by document similarity: documents have sketches, signed sums of their impacts; every
  BLOCK-th posting is a pivot, and each document goes to the pivot with the largest inner product. A block's summary
  is the coordinatewise maximum of its documents' impacts.
* An item visits a block unless the sum of the summary over the item's terms is below the item's threshold. A list
  has a summary of its own, the greatest impact of each term in the shard, that can rule out all its blocks at once.
* Documents of visited blocks are scored in full.

Thresholds come from a pass before: in every shard the documents with the greatest impacts of each item's terms are
scored exactly, and the item's K-th best of all shards is a lower bound of its final K-th best. Bounds are exact
integer sums, so nothing is lost: a skipped block holds only documents that score below K others.

Terms are compared by 64-bit hashes. A null text has no terms; documents and items without terms take no part, as do
documents that share nothing with an item. Repeated rows are documents and items of their own, so an item_id that
occurs twice is answered twice. A null doc_id comes after others of the same score. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortscope.llm.shared import land, numbered
from cohortscope.llm.text import Block, blocks, constants, mix, span_hashes

TOP = 10
BLOCK = 32  # documents in a block, about
SKETCH = 32  # numbers in a sketch
CHAMPIONS = 2  # documents by impact of each term that thresholds are taken from
SHARD_ENTRIES = 1 << 21
#: Item terms that one pass answers; more items are answered in further passes.
PASS_TERMS = 1 << 20

_IS_TERM = np.zeros(256, dtype=bool)
for _first, _last in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    _IS_TERM[_first : _last + 1] = True


def term_hashes(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit hashes of all terms, A-Z lower-cased, and for each text the number of terms before it."""
    inside = _IS_TERM[block.data]
    before, after = np.zeros(len(inside), dtype=bool), np.zeros(len(inside), dtype=bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    bounds = block.offsets
    before[bounds[bounds < len(inside)]] = False
    after[bounds[bounds > 0] - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return span_hashes(block.prefix_sums(lower=True), starts, ends).view(np.int64), np.searchsorted(starts, bounds)


def _counted(texts: pa.Array, known: np.ndarray | None) -> Iterator[tuple[int, list]]:
    """For each block of texts its first row, and for each text its number of terms, distinct terms and counts."""
    for block in blocks(texts):
        hashes, before = term_hashes(block)
        sizes = np.diff(before)
        owner = np.repeat(np.arange(len(block)), sizes)
        if known is not None and len(known):
            at = np.searchsorted(known, hashes)
            at[at == len(known)] = 0
            asked = known[at] == hashes
            hashes, owner = hashes[asked], owner[asked]
        elif known is not None:
            hashes, owner = hashes[:0], owner[:0]
        order = np.lexsort((hashes, owner))
        hashes, owner = hashes[order], owner[order]
        new = np.ones(len(hashes), dtype=bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
        first = np.flatnonzero(new)
        counts = np.diff(np.append(first, len(hashes)))
        offsets = np.searchsorted(owner[first], np.arange(len(block) + 1))
        yield block.first, [sizes, offsets, hashes[first], counts]


def _vectors(table: DataFrame, key: str, known=None) -> DataFrame:
    """One row a text: key, n (its terms with repeats), its distinct terms and their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked = known.value if known is not None else None
            for first, (sizes, offsets, terms, counts) in _counted(batch.column("text"), asked):
                cut = pa.array(offsets.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(key).slice(first, len(sizes)), pa.array(sizes.astype(np.int64)),
                     pa.ListArray.from_arrays(cut, pa.array(terms)),
                     pa.ListArray.from_arrays(cut, pa.array(counts.astype(np.int64)))],
                    [key, "n", "terms", "counts"])

    return table.select(key, "text").mapInArrow(run, f"{key} bigint, n bigint, terms array<bigint>, counts array<bigint>")


# --- What a pass asks for ---------------------------------------------------------------------


class Queries:
    """The items of one pass over numbered terms, and what the corpus says about these terms.

    Terms are numbered from the smallest weight to the greatest. `items` are pairs of the item's row and the sorted
    numbers of its terms.
    """

    def __init__(self, items: list, n_docs: int, n_terms: int, holders: dict[int, int]):
        found = np.array(sorted(holders), dtype=np.int64)
        df = np.array([holders[t] for t in found.tolist()], dtype=np.int64)
        weights = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)
        order = np.argsort(weights, kind="stable")
        self.weights = weights[order]
        self.numbers = np.empty(len(found), dtype=np.int64)  # number of the term at a place in `found`
        self.numbers[order] = np.arange(len(found))
        self.found, self.n_docs, self.n_terms = found, n_docs, n_terms
        self.items = []
        for row, terms in items:
            at = np.searchsorted(found, terms)
            at[at == len(found)] = 0
            own = np.sort(self.numbers[at[found[at] == terms]]) if len(found) else np.zeros(0, np.int64)
            if len(own):
                self.items.append((row, own))


def impacts(weight: np.ndarray, count: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What a term adds to a score: its weight times a whole number that grows with its count and falls with length."""
    m = 100 - 90 + (90 * n * n_docs) // n_terms
    return weight * ((1_000_000_000 * count) // (1000 * count + 8 * m))


class Shard:
    """Documents as rows of (term number, impact), and the posting lists of their terms."""

    def __init__(self, queries: Queries, n: np.ndarray, sizes: np.ndarray, terms: np.ndarray, counts: np.ndarray):
        self.queries = queries
        owner = np.repeat(np.arange(len(n)), sizes)
        at = np.searchsorted(queries.found, terms)
        at[at == len(queries.found)] = 0
        known = queries.found[at] == terms
        number, owner, counts = queries.numbers[at[known]], owner[known], counts[known]
        impact = impacts(queries.weights[number], counts, n[owner], queries.n_docs, queries.n_terms)
        # By document, commonest term first.
        order = np.lexsort((number, owner))
        self.term, self.impact, self.doc = number[order], impact[order], owner[order]
        self.rows = np.searchsorted(self.doc, np.arange(len(n) + 1))
        self.place = np.arange(len(self.doc)) - self.rows[self.doc]
        # By term, the greatest impact first.
        order = np.lexsort((self.doc, -self.impact, self.term))
        self.by_term = order
        n_all = len(queries.weights)
        self.lists = np.searchsorted(self.term[order], np.arange(n_all + 1))
        self.greatest = np.zeros(n_all, dtype=np.int64)
        listed = np.flatnonzero(np.diff(self.lists))
        self.greatest[listed] = self.impact[order[self.lists[listed]]]
        self._sketches: np.ndarray | None = None

    def postings(self, term: int) -> np.ndarray:
        """The entries (indices into term, impact and doc) of a term."""
        return self.by_term[self.lists[term] : self.lists[term + 1]]

    def sketches(self) -> np.ndarray:
        """SKETCH signed sums of each document's impacts, as a vector of length 1."""
        if self._sketches is None:
            spread = mix(np.arange(len(self.queries.weights), dtype=np.uint64) + constants(1, 29)[0])
            flat = np.zeros((len(self.rows) - 1) * SKETCH, dtype=np.float32)
            for shift in (0, 16, 32):  # each term adds to three places, with a sign
                bits = (spread >> np.uint64(shift)).astype(np.int64) & 0xFFFF
                sign = np.where(bits & 1, 1.0, -1.0)
                flat += np.bincount(self.doc * SKETCH + ((bits >> 1) % SKETCH)[self.term],
                                    weights=self.impact * sign[self.term], minlength=len(flat)).astype(np.float32)
            sums = flat.reshape(-1, SKETCH)
            self._sketches = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
        return self._sketches

    def clustered(self, entries: np.ndarray) -> np.ndarray:
        """The block of each entry of a posting list."""
        if len(entries) <= BLOCK:
            return np.zeros(len(entries), dtype=np.int64)
        own = self.sketches()[self.doc[entries]]
        return (own @ own[::BLOCK].T).argmax(axis=1)

    def _gathered(self, docs: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first `sizes` entries of each document, and the place in `docs` each belongs to."""
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return np.arange(total) + np.repeat(self.rows[docs] - (ends - sizes), sizes), np.repeat(np.arange(len(docs)), sizes)

    def summaries(self, entries: np.ndarray, block: np.ndarray, columns: np.ndarray) -> np.ndarray:
        """For each block of the list the greatest impact of each term in `columns` (sorted) in its documents."""
        result = np.zeros((int(block.max()) + 1, len(columns)), dtype=np.int64)
        gathered, of = self._gathered(self.doc[entries], self.place[entries] + 1)
        at = np.searchsorted(columns, self.term[gathered])
        at[at == len(columns)] = 0
        hit = columns[at] == self.term[gathered]
        np.maximum.at(result, (block[of[hit]], at[hit]), self.impact[gathered[hit]])
        return result

    def scores(self, docs: np.ndarray, own: np.ndarray) -> np.ndarray:
        """The exact scores of the documents for an item with the terms `own`."""
        gathered, of = self._gathered(docs, self.rows[docs + 1] - self.rows[docs])
        at = np.searchsorted(own, self.term[gathered])
        at[at == len(own)] = 0
        hit = own[at] == self.term[gathered]
        totals = np.zeros(len(docs), dtype=np.int64)
        np.add.at(totals, of[hit], self.impact[gathered[hit]])
        return totals

    def champions(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each item (by index) some documents of high impact, and their scores."""
        for item, (_, own) in enumerate(self.queries.items):
            heads = [self.postings(t)[:CHAMPIONS] for t in own.tolist() if self.greatest[t]]
            if heads:
                docs = np.unique(self.doc[np.concatenate(heads)])
                yield item, docs, self.scores(docs, own)

    def candidates(self, thresholds: np.ndarray) -> dict[int, np.ndarray]:
        """For each item (by index) the documents of the blocks that it has to visit."""
        open_items: dict[int, list[int]] = {}
        for item, (_, own) in enumerate(self.queries.items):
            # What a document can reach whose rarest shared term is this one.
            reach = np.cumsum(self.greatest[own])
            for term in own[(reach >= thresholds[item]) & (self.greatest[own] > 0)].tolist():
                open_items.setdefault(term, []).append(item)
        visited: dict[int, list[np.ndarray]] = {}
        for term, items in open_items.items():
            entries = self.postings(term)
            block = self.clustered(entries)
            asked = [self.queries.items[i][1] for i in items]
            asked = [own[own <= term] for own in asked]
            columns = np.unique(np.concatenate(asked))
            summary = self.summaries(entries, block, columns)
            for item, own in zip(items, asked, strict=True):
                bound = summary[:, np.searchsorted(columns, own)].sum(axis=1)
                chosen = (bound >= thresholds[item])[block]
                if chosen.any():
                    visited.setdefault(item, []).append(self.doc[entries[chosen]])
        return {item: np.unique(np.concatenate(parts)) for item, parts in visited.items()}


def _shards(batches: Iterator[pa.RecordBatch], queries: Queries) -> Iterator[tuple[pa.Array, Shard]]:
    """Shards of a batch's rows with a bounded number of entries, one document at least, and their keys."""
    for batch in batches:
        sizes = pc.list_value_length(batch.column("terms")).to_numpy()
        begin, entries = 0, np.concatenate([[0], np.cumsum(sizes)])
        while begin < batch.num_rows:
            end = int(np.searchsorted(entries, entries[begin] + SHARD_ENTRIES, side="right")) - 1
            end = min(max(end, begin + 1), batch.num_rows)
            part = batch.slice(begin, end - begin)
            yield part, Shard(queries, part.column("n").to_numpy(), sizes[begin:end],
                              part.column("terms").flatten().to_numpy(), part.column("counts").flatten().to_numpy())
            begin = end


def _found(part: pa.RecordBatch, item_rows: list[int], docs: list[np.ndarray], scores: list[np.ndarray]) -> pa.RecordBatch:
    items = np.repeat(np.array(item_rows, dtype=np.int64), [len(d) for d in docs])
    places = np.concatenate(docs) if docs else np.zeros(0, np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(items), part.column("row").take(pa.array(places)), part.column("doc_id").take(pa.array(places)),
         pa.array(np.concatenate(scores) if scores else np.zeros(0, np.int64))],
        ["item", "row", "doc_id", "score"])


_RESULT = "item bigint, row bigint, doc_id bigint, score bigint"


def _best(found: DataFrame, top: int) -> DataFrame:
    """The `top` rows of each item by score; Spark drops lower rows in every task before the shuffle."""
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _leading(docs: np.ndarray, scores: np.ndarray, ids: np.ndarray, top: int) -> np.ndarray:
    """Places of the `top` documents by score, then doc_id."""
    return np.lexsort((ids[docs], -scores))[:top]


def _ids(part: pa.RecordBatch) -> np.ndarray:
    """The ids as numbers to sort by: null last."""
    return part.column("doc_id").fill_null(np.iinfo(np.int64).max).to_numpy()


def _thresholds(forward: DataFrame, shared, top: int) -> DataFrame:
    """Exact scores of some documents for each item; the `top` best rows of each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = shared.value
        for part, shard in _shards(batches, queries):
            ids = _ids(part)
            rows, docs, scores = [], [], []
            for item, own, score in shard.champions():
                lead = _leading(own, score, ids, top)
                rows.append(queries.items[item][0])
                docs.append(own[lead])
                scores.append(score[lead])
            yield _found(part, rows, docs, scores)

    return _best(forward.mapInArrow(run, _RESULT), top)


def _searched(forward: DataFrame, shared, thresholds, top: int) -> DataFrame:
    """For each shard and item the best documents that reach the item's threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = shared.value
        least = np.array([max(thresholds.value.get(row, 1), 1) for row, _ in queries.items], dtype=np.int64)
        for part, shard in _shards(batches, queries):
            ids = _ids(part)
            rows, docs, scores = [], [], []
            for item, own in shard.candidates(least).items():
                row, terms = queries.items[item]
                score = shard.scores(own, terms)
                good = score >= least[item]
                own, score = own[good], score[good]
                lead = _leading(own, score, ids, top)
                rows.append(row)
                docs.append(own[lead])
                scores.append(score[lead])
            yield _found(part, rows, docs, scores)

    return _best(forward.mapInArrow(run, _RESULT), top)


def _n_terms(items: DataFrame) -> int:
    return items.agg(F.sum(F.size("terms"))).first()[0] or 0


def _passes(items: DataFrame) -> Iterator[list]:
    """The items as (row, terms), in lists of at most PASS_TERMS terms unless a single item has more."""
    if _n_terms(items) <= PASS_TERMS:
        yield [(r["row"], np.array(r["terms"], dtype=np.int64)) for r in items.select("row", "terms").collect()]
        return
    placed = land(numbered(items, ["row"], {"_end": F.size("terms")}, "numbered_items").withColumn(
        "_pass", F.floor((F.col("_end") - 1) / PASS_TERMS)), "item_passes")
    last = placed.agg(F.max("_pass")).first()[0]
    for number in range(last + 1):
        rows = placed.where(F.col("_pass") == number).select("row", "terms").collect()
        if rows:
            yield [(r["row"], np.array(r["terms"], dtype=np.int64)) for r in rows]


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """One row an item and rank: item_id, rank (from 1), doc_id and score of its `top` highest-scoring documents.

    Documents without a positive score are not returned. Items are answered in passes of bounded size over the same
    landed documents; usually one pass answers all.
    """
    context = docs.sparkSession.sparkContext
    asked = land(_vectors(items, "item_id").where(F.size("terms") > 0)
                 .withColumn("row", F.monotonically_increasing_id()), "search_items")
    vocabulary = asked.select(F.explode("terms").alias("term")).distinct()
    known = None
    if _n_terms(asked) <= PASS_TERMS:
        known = context.broadcast(np.array(sorted(r["term"] for r in vocabulary.collect()), dtype=np.int64))
    forward = land(_vectors(docs, "doc_id", known).where("n > 0")
                   .withColumn("row", F.monotonically_increasing_id()), "forward")
    totals = forward.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
    forward = forward.where(F.size("terms") > 0)
    results = []
    for listed in _passes(asked):
        wanted = np.unique(np.concatenate([terms for _, terms in listed])) if listed else np.zeros(0, np.int64)
        terms = forward.select(F.explode("terms").alias("term"))
        if known is None:
            schema = "term bigint"
            own = docs.sparkSession.createDataFrame([(int(t),) for t in wanted], schema)
            terms = terms.join(F.broadcast(own), "term", "left_semi")
        holders = {r["term"]: r["n"] for r in terms.groupBy("term").agg(F.count("*").alias("n")).collect()}
        shared = context.broadcast(Queries(listed, totals["docs"], totals["terms"] or 0, holders))
        leaders = _thresholds(forward, shared, top).where(F.col("rank") == top).select("item", "score").collect()
        thresholds = context.broadcast({r["item"]: r["score"] for r in leaders})
        results.append(land(_searched(forward, shared, thresholds, top), "search_results"))
    best = results[0]
    for more in results[1:]:
        best = best.unionByName(more)
    return best.join(asked.select(F.col("row").alias("item"), "item_id"), "item").select(
        "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
