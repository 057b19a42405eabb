"""Convolutional text classifier: hashed word embeddings, filters of several widths and max pooling.

A word's embedding is the sum of the table's rows for the word and for its first bytes. Filters of one to three
words slide over a text, the largest response of each is kept, and a logistic unit on top gives the score.
The network is trained on every labelled text that is not held out. The texts are dealt to shards by the hash of
their id, and in each epoch the tasks train one copy of the network a shard, all from the same start; the changes of
the copies are averaged in Spark, a table row's over the shards that have its words. The driver holds one network,
whose size is fixed. Scoring runs in tasks over all texts, whole. Both read blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from cohortscope.llm.shared import broadcast_if_small, land, releasing, small_batches
from cohortscope.llm.text import Block, blocks, constants, mix, span_hashes, words

BUCKETS = 1 << 17
DIMENSIONS = 8
FILTERS = 8
WIDTHS = (1, 2, 3)
#: Bytes of a word's beginning that have an embedding of their own, besides the whole word.
PREFIXES = (3, 4, 6)
#: Passes over the labelled texts, texts in a step, and about how many texts one copy of the network sees in a pass.
EPOCHS, BATCH, SHARD_TEXTS = 8, 64, 4096
THRESHOLD = 0.3
#: Scores that are tried as a language's threshold.
_GRID = np.arange(0.05, 0.96, 0.05)
#: Changes are summed as whole multiples of this, so that their order does not matter.
_UNIT = 2.0**-32
_SEEDS = constants(len(PREFIXES) + 1, 31)
_PAD = max(WIDTHS) - 1
#: Bytes of texts that are worked on at once; what is derived from them takes some fifty times as much.
_BLOCK_BYTES = 1 << 19


def features(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """For each word its rows of the embedding table, and the words before each text (one entry more)."""
    starts, ends, before = words(block)
    sums = block.prefix_sums(lower=True)
    hashes = [span_hashes(sums, starts, ends)]
    hashes += [span_hashes(sums, starts, np.minimum(starts + n, ends)) for n in PREFIXES]
    rows = [(mix(h ^ seed) % np.uint64(BUCKETS)).astype(np.int32) for h, seed in zip(hashes, _SEEDS, strict=True)]
    return np.stack(rows, axis=1), before


@dataclass
class Model:
    table: np.ndarray
    filters: list[np.ndarray]
    out: np.ndarray
    bias: float | np.ndarray
    thresholds: dict[str, float] = field(default_factory=dict)

    def embedded(self, rows: np.ndarray) -> np.ndarray:
        return self.table[rows].sum(axis=1)

    def responses(self, vectors: np.ndarray, width: int) -> np.ndarray:
        """Filter responses at every position of `vectors`, which end with rows of zeros for the last words."""
        n = len(vectors) - _PAD
        filters = self.filters[WIDTHS.index(width)]
        return sum(vectors[k : k + n] @ filters[k] for k in range(width))

    def pooled(self, rows: np.ndarray, before: np.ndarray) -> np.ndarray:
        """The largest response of each filter in each text, not below zero; zeros for a text without words."""
        texts, counts = len(before) - 1, np.diff(before)
        result = np.zeros((texts, FILTERS * len(WIDTHS)), dtype=np.float32)
        if not len(rows):
            return result
        # Zeros follow each text, so that no filter sees two texts.
        places = np.arange(len(rows)) + np.repeat(np.arange(texts) * _PAD, counts)
        vectors = np.zeros((len(rows) + texts * _PAD + _PAD, DIMENSIONS), dtype=np.float32)
        vectors[places] = self.embedded(rows)
        some = counts > 0
        firsts = before[:-1][some]
        for i, width in enumerate(WIDTHS):
            at_words = self.responses(vectors, width)[places]
            result[some, i * FILTERS : (i + 1) * FILTERS] = np.maximum.reduceat(at_words, firsts, axis=0)
        return np.maximum(result, 0)

    def scores(self, block: Block) -> np.ndarray:
        return _sigmoid(self.pooled(*features(block)) @ self.out + self.bias).astype(np.float64)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


#: Rows of the network's parameters: the table, then all others in rows of the same width.
_OTHERS = sum(w * DIMENSIONS * FILTERS for w in WIDTHS) + FILTERS * len(WIDTHS) + 1
_ROWS = BUCKETS - (-_OTHERS // DIMENSIONS)


def _parts(values: np.ndarray) -> Model:
    """The network whose parameters are `values`, as views of them."""
    others = values[BUCKETS:].reshape(-1)
    ends = np.cumsum([w * DIMENSIONS * FILTERS for w in WIDTHS]).tolist()
    filters = [others[b - w * DIMENSIONS * FILTERS : b].reshape(w, DIMENSIONS, FILTERS)
               for w, b in zip(WIDTHS, ends, strict=True)]
    out = others[ends[-1] : _OTHERS - 1]
    return Model(values[:BUCKETS], filters, out, others[_OTHERS - 1 : _OTHERS])


def _start(odds: np.ndarray, share: float, seed: int = 1) -> np.ndarray:
    """Parameters to begin with: the first dimension holds log odds, the others are random."""
    random = np.random.default_rng(seed)
    values = np.zeros((_ROWS, DIMENSIONS), dtype=np.float32)
    model = _parts(values)
    model.table[:] = random.normal(0, 0.1, model.table.shape)
    model.table[:, 0] = np.clip(odds, -4, 4) / (len(PREFIXES) + 1)
    for filters in model.filters:
        filters[:] = random.normal(0, 0.2, filters.shape)
    model.filters[0][0, 0, 0] = 1
    model.out[:] = random.normal(0, 0.1, model.out.shape)
    model.out[0] = 1
    model.bias[:] = np.log(share / (1 - share)) - 1
    return values


def _descend(values: np.ndarray, squares: np.ndarray, gradient: np.ndarray, rate: float, at=slice(None)) -> None:
    squares[at] += gradient**2
    values[at] -= rate * gradient / np.sqrt(squares[at])


def _step(model: Model, squares: Model, rows: np.ndarray, before: np.ndarray, labels: np.ndarray) -> None:
    """Change the network by one step on a few texts, given as in `features`."""
    texts, counts = len(labels), np.diff(before)
    largest = np.zeros((texts, len(model.out)), dtype=np.float32)
    at = np.zeros((texts, len(model.out)), dtype=np.int64)  # the word at which each filter responds most
    owner = np.repeat(np.arange(texts), counts)
    places = np.arange(len(rows)) + owner * _PAD
    vectors = np.zeros((len(rows) + texts * _PAD + _PAD, DIMENSIONS), dtype=np.float32)
    own = [slice(i * FILTERS, (i + 1) * FILTERS) for i in range(len(WIDTHS))]
    if len(rows):
        vectors[places] = model.embedded(rows)
        some = counts > 0
        for of_width, width in zip(own, WIDTHS, strict=True):
            at_words = model.responses(vectors, width)[places]
            largest[some, of_width] = np.maximum.reduceat(at_words, before[:-1][some], axis=0)
            word, column = np.nonzero(at_words == largest[:, of_width][owner])
            _, first = np.unique(owner[word] * FILTERS + column, return_index=True)
            at[:, of_width][owner[word[first]], column[first]] = word[first]
    pooled = np.maximum(largest, 0)
    error = (_sigmoid(pooled @ model.out + model.bias) - labels) / texts
    back = (error[:, None] * model.out * (largest > 0)).astype(np.float32)
    gradients, touched, changes = [np.zeros_like(f) for f in model.filters], [], []
    if len(rows):
        for i, width in enumerate(WIDTHS):
            for k in range(width):
                word, errors = at[:, own[i]] + k, back[:, own[i]]
                gradients[i][k] = np.einsum("tfd,tf->df", vectors[places[at[:, own[i]]] + k], errors)
                text, column = np.nonzero((word < before[1:, None]) & (errors != 0))
                touched.append(rows[word[text, column]])
                changes.append(model.filters[i][k].T[column] * errors[text, column, None])
    for values, square, gradient in zip(model.filters, squares.filters, gradients, strict=True):
        _descend(values, square, gradient, 0.02)
    _descend(model.out, squares.out, pooled.T @ error + 1e-4 * model.out, 0.05)
    _descend(model.bias, squares.bias, error.sum(keepdims=True), 0.05)
    if touched:
        kinds, inverse = np.unique(np.concatenate(touched).ravel(), return_inverse=True)
        gradient = np.zeros((len(kinds), DIMENSIONS), dtype=np.float32)
        np.add.at(gradient, inverse, np.repeat(np.concatenate(changes), len(PREFIXES) + 1, axis=0))
        _descend(model.table, squares.table, gradient, 0.02, kinds)


def _best_threshold(toxic: np.ndarray, others: np.ndarray) -> float:
    """The threshold of the grid with the best F1; the middle of those that are equally good, nearest to the default.

    Given are the texts of either label by the number of thresholds that their score reaches.
    """
    found, flagged = (np.cumsum(x[::-1])[::-1][1:] for x in (toxic, toxic + others))
    values = 2 * found / (flagged + toxic.sum())
    best = _GRID[np.isclose(values, max(values))]
    return float(best[np.abs(best - THRESHOLD).argmin()])


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from: crc32 of the id's text is 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _labelled(docs: DataFrame, known: DataFrame, n: int, shard_texts: int) -> DataFrame:
    """One landed row for each labelled id: shard, text, lang, toxic, and whether it is set aside for calibration.

    The rows are in the order of the shards. Of several texts of an id the smallest is taken.
    """
    shards = -(-n // shard_texts)
    dealt = (
        docs.select("doc_id", "text", "lang").join(broadcast_if_small(known), "doc_id")
        .withColumns({"at": F.xxhash64("doc_id"), "shard": F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int")})
        .repartition(shards, "shard")
    )
    of_id = Window.partitionBy("shard", "at", "doc_id").orderBy("text", "lang")  # one row but for repeated ids
    first = dealt.withColumn("place", F.row_number().over(of_id)).where("place = 1")
    aside = F.pmod(F.xxhash64("doc_id", F.lit("aside")), F.lit(5)) == 0
    return land(first.sortWithinPartitions("shard", "at", "doc_id").select(
        "shard", "text", "lang", F.col("toxic").cast("int").alias("toxic"), aside.alias("aside")), "labelled_texts")


def _log_odds(texts: DataFrame, totals: np.ndarray) -> np.ndarray:
    """For each row of the table how much more often texts labelled 1 use it than others; 0 for rows used once or not."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, BUCKETS), dtype=np.int64)
        for batch in batches:
            for block in blocks(batch.column("text"), _BLOCK_BYTES):
                rows, before = features(block)
                owner = np.repeat(np.arange(len(block)), np.diff(before))
                used = np.unique(owner[:, None] * BUCKETS + rows)  # once a text
                toxic = batch.column("toxic").slice(block.first, len(block)).to_numpy()[used // BUCKETS]
                for label in (0, 1):
                    counts[label] += np.bincount(used[toxic == label] % BUCKETS, minlength=BUCKETS)
        places = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(places), *[pa.array(c[places]) for c in counts]],
                                         ["place", "others", "toxic"])

    rows = texts.select("text", "toxic").mapInArrow(releasing(run), "place bigint, others bigint, toxic bigint")
    table = rows.groupBy("place").agg(F.sum("others").alias("others"), F.sum("toxic").alias("toxic")).toArrow()
    counts = np.zeros((2, BUCKETS))
    counts[:, table.column("place").to_numpy()] = [table.column(c).to_numpy() for c in ("others", "toxic")]
    odds = np.log((counts + 1) / (totals[:, None] + 2))
    return np.where(counts.sum(axis=0) > 1, odds[1] - odds[0], 0)


_CHANGES = [f"{kind}_{i}" for kind in ("value", "square") for i in range(DIMENSIONS)]


def _epoch(texts: DataFrame, values: np.ndarray, squares: np.ndarray) -> None:
    """Change the parameters by the average of what one pass over each shard changes."""
    shared = texts.sparkSession.sparkContext.broadcast((values, squares))  # of fixed size, whatever the input

    def changed(own: list[np.ndarray]) -> pa.RecordBatch:
        changes = np.concatenate([new - old for new, old in zip(own, shared.value, strict=True)], axis=1)
        places = np.flatnonzero(changes.any(axis=1))
        units = np.rint(changes[places] / _UNIT).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(places), *[pa.array(c) for c in units.T.copy()]],
                                          ["place", *_CHANGES])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, own = None, []
        for batch in batches:
            for block in blocks(batch.column("text"), _BLOCK_BYTES):
                rows, before = features(block)
                shards, labels = (batch.column(c).slice(block.first, len(block)).to_numpy() for c in ("shard", "toxic"))
                bounds = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(block)]
                for a, b in zip(bounds, bounds[1:], strict=False):
                    if shards[a] != shard:
                        if own:
                            yield changed(own)
                        shard, own = shards[a], [x.copy() for x in shared.value]
                    for first in range(a, b, BATCH):
                        ends = before[first : min(first + BATCH, b) + 1]
                        _step(_parts(own[0]), _parts(own[1]), rows[ends[0] : ends[-1]], ends - ends[0],
                              labels[first : first + len(ends) - 1])
        if own:
            yield changed(own)

    rows = texts.select("shard", "text", "toxic").mapInArrow(releasing(run), ", ".join(f"{c} bigint" for c in ["place", *_CHANGES]))
    table = rows.groupBy("place").agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in _CHANGES]).toArrow()
    shared.destroy()
    places, n = (table.column(c).to_numpy() for c in ("place", "n"))
    means = np.stack([table.column(c).to_numpy() for c in _CHANGES], axis=1) * _UNIT / n[:, None]
    values[places] += means[:, :DIMENSIONS].astype(np.float32)
    squares[places] += means[:, DIMENSIONS:].astype(np.float32)


def _thresholds(aside: DataFrame, model: Model) -> dict[str, float]:
    """The best threshold of each language with at least 20 toxic texts among those set aside."""
    scored = with_scores(aside.where("lang IS NOT NULL"), model, "score", ["lang", "toxic"])
    reached = sum((F.col("score") >= float(t)).cast("int") for t in _GRID)
    bins = scored.groupBy("lang", reached.alias("reached")).agg(F.sum("toxic").alias("toxic"), F.count("*").alias("n"))
    langs = bins.groupBy("lang").agg(
        F.sum("toxic").alias("toxic"), F.collect_list(F.struct("reached", "toxic", "n")).alias("bins")).where("toxic >= 20")
    result = {}
    for row in langs.collect():  # one short row a language
        counts = np.zeros((2, len(_GRID) + 1), dtype=np.int64)
        for reached, toxic, n in row["bins"]:
            counts[:, reached] = toxic, n - toxic
        result[row["lang"]] = _best_threshold(*counts)
    return result


def train(docs: DataFrame, labels: DataFrame, shard_texts: int = SHARD_TEXTS) -> Model:
    """Fit on all labelled texts that are not held out, less a fifth on which the thresholds are calibrated.

    An id with several labels counts as toxic if one of them says so; null labels and unlabelled texts are not
    used. With labels of one class only, or none, every score is that class's share (0 without labels).
    A language with fewer than 20 toxic texts among those set aside for calibration keeps the threshold 0.3.
    """
    small_batches(docs)
    known = land(
        labels.select("doc_id", "toxic").where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where("toxic IN (0, 1)"), "known_labels")
    totals = {row["toxic"]: row["count"] for row in known.groupBy("toxic").count().collect()}
    if len(totals) < 2:
        return _constant(float(any(totals)))
    texts = _labelled(docs, known, sum(totals.values()), shard_texts)
    counts = np.zeros((2, 2), dtype=np.int64)  # by aside and toxic
    for row in texts.groupBy("aside", "toxic").count().collect():
        counts[int(row["aside"]), row["toxic"]] = row["count"]
    if not counts.sum(axis=0).all():
        return _constant(float(counts[:, 1].any()))
    aside, taken = texts.where("aside"), texts.where("NOT aside")
    if not counts[0].all():  # too few for a part of their own
        aside, taken, counts = texts.limit(0), texts, counts.sum(axis=0, keepdims=True)
    values = _start(_log_odds(taken, counts[0]), counts[0, 1] / counts[0].sum())
    squares = np.full_like(values, 1e-4)
    for _ in range(EPOCHS):
        _epoch(taken, values, squares)
    model = _parts(values)
    model.thresholds = _thresholds(aside, model)
    return model


def _constant(share: float) -> Model:
    zeros = [np.zeros((w, DIMENSIONS, FILTERS), dtype=np.float32) for w in WIDTHS]
    table = np.zeros((BUCKETS, DIMENSIONS), dtype=np.float32)
    return Model(table, zeros, np.zeros(FILTERS * len(WIDTHS), dtype=np.float32), 30.0 if share else -30.0)


def with_scores(docs: DataFrame, model: Model, name: str, keep: list[str]) -> DataFrame:
    """The columns `keep` of `docs` and the score from 0 to 1 as `name`. A null text scores as an empty one."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size, whatever the input
    texts = keep.index("text") if "text" in keep else len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(texts), _BLOCK_BYTES):
                rows = batch.slice(block.first, len(block))
                values = pa.array(np.round(shared.value.scores(block), 6), pa.float64())
                yield pa.RecordBatch.from_arrays([*rows.columns[: len(keep)], values], [*keep, name])

    schema = StructType([*docs.select(*keep).schema, StructField(name, DoubleType())])
    return docs.select(*keep, *([] if "text" in keep else ["text"])).mapInArrow(releasing(run), schema)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row a document: doc_id and its score from 0 to 1."""
    return with_scores(docs, model, "score", ["doc_id"])


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The documents, with all their columns, whose score is below the threshold of their language.

    A language without a threshold, a null one too, has 0.3. Toxic rows stay in the task that scores them.
    """
    small_batches(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size, whatever the input
    text, lang = docs.columns.index("text"), docs.columns.index("lang")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(text), _BLOCK_BYTES):
                rows = batch.slice(block.first, len(block))
                limits = [shared.value.thresholds.get(x, THRESHOLD) for x in rows.column(lang).to_pylist()]
                yield rows.filter(pa.array(np.round(shared.value.scores(block), 6) < np.array(limits)))

    return docs.mapInArrow(releasing(run), docs.schema)


