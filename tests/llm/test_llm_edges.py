"""Every operator on nulls, empty and long texts, repeated rows, clashing extra columns and empty tables."""

import pytest
from helpers import rows
from pyspark.sql import functions as F

import corpus_pipeline
from cohortscope.llm import (
    bpe,
    decontamination,
    minhash,
    pii,
    quality,
    quotations,
    sharding,
    suffixes,
    toxicity,
    wordpiece,
)

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "score double, kept string, n_words int, posts string, _range int, _toxicity int, members string")
LONG = " ".join(f"word{i % 977}x{i}" for i in range(30_000))


@pytest.fixture(scope="module")
def docs(spark):
    texts = {1: None, 2: "", 3: " \n\t ", 4: "one two", 5: LONG, 6: LONG, 7: "a b c d e f g h", 8: "a b c d e f g h",
             9: "x" * 5000, 10: "call +1 (017) 555-7713 now"}
    listed = [(i, text, "en", "s", None, 0.5, "k", 1, "p", 7, 1, "m") for i, text in texts.items()]
    listed += [listed[7], (None, "no id here", None, None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(listed, SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(7, 1), (4, 0), (8, None), (None, 1), (7, 1)], "doc_id long, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame(
        [(1, "a b c d e f g h"), (2, None), (3, "too short"), (1, "a b c d e f g h"), (None, "")],
        "item_id long, text string")


OPERATORS = {
    "pii": lambda docs, labels, benchmark: pii.replace(docs),
    "minhash": lambda docs, labels, benchmark: minhash.near_duplicates(docs),
    "bpe": lambda docs, labels, benchmark: bpe.digests(docs),
    "bpe_encode": lambda docs, labels, benchmark: bpe.decode(bpe.encode(docs)),
    "quality": lambda docs, labels, benchmark: quality.verdicts(docs),
    "wordpiece": lambda docs, labels, benchmark: wordpiece.token_counts(docs),
    "suffixes": lambda docs, labels, benchmark: suffixes.remove_repeats(docs),
    "sharding": lambda docs, labels, benchmark: sharding.shard(docs, 3),
    "toxicity": lambda docs, labels, benchmark: toxicity.score(docs, toxicity.train(docs, labels)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_a_document(docs, labels, benchmark, name):
    result = OPERATORS[name](docs, labels, benchmark)
    assert rows(result, "doc_id") == rows(docs, "doc_id")
    if name != "pii":
        assert len(result.columns) == len(set(result.columns))


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables(docs, labels, benchmark, name):
    assert OPERATORS[name](docs.limit(0), labels.limit(0), benchmark.limit(0)).count() == 0


def test_contaminated_documents(docs, benchmark):
    assert rows(decontamination.contaminated(docs, benchmark), "doc_id", "n_items") == [(7, 1), (8, 1)]
    assert decontamination.contaminated(docs.limit(0), benchmark).count() == 0
    assert decontamination.contaminated(docs, benchmark.limit(0)).count() == 0
    kept = decontamination.keep_clean(docs, benchmark)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 3


def test_near_duplicates_of_edge_cases(docs):
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in
             minhash.near_duplicates(docs, size=4).collect()}
    assert found[1] == found[2][:1] + (1, True) == (0, 1, True) and found[2] == (0, 2, True)
    assert found[4] == (1, 4, True) and found[6][1:] == (5, False) and found[8][1:] == (7, False)
    assert found[None] == (1, None, True)


def test_toxicity_without_labels(docs, labels):
    assert {r["score"] for r in toxicity.score(docs, toxicity.train(docs, labels.limit(0))).collect()} == {0.0}
    kept = toxicity.keep_clean(docs, toxicity.train(docs, labels))
    assert kept.columns == docs.columns


def test_surrogates_keep_other_columns(docs):
    replaced = pii.replace(docs)
    assert replaced.columns == docs.columns
    others = [c for c in docs.columns if c != "text"]
    assert rows(replaced, *others) == rows(docs, *others)
    texts = {r["doc_id"]: r["text"] for r in replaced.collect()}
    assert texts[1] is None and texts[5] == LONG and "555-7713" not in texts[10]


def test_quotations_of_edge_cases(spark):
    listed = [(1, 0, "u", "Hello there.\nSee you.", 1), (1, 1, "a", "> hello   THERE.\nFine.", 1), (1, 2, "u", None, 1),
              (1, 3, "a", "", 1), (2, 0, "u", "> said nowhere\n", 1), (None, 1, "u", "> Hello there.\nx", 1),
              (1, None, "u", "> Hello there.\ny", 1), (1, 1, "a", "> hello   THERE.\nFine.", 1)]
    chats = spark.createDataFrame(listed, "conv_id long, turn long, role string, text string, parent int")
    found = rows(quotations.conversations(chats), "conv_id", "turn", "parent", "thread", "depth", "reply_order", "text")
    assert found.count((1, 1, 0, 0, 1, 1, "Fine.")) == 2
    assert (1, 2, None, 2, 0, 0, None) in found and (1, 3, None, 3, 0, 0, "") in found
    assert (2, 0, None, 0, 0, 0, "") in found and (None, 1, None, 1, 0, 0, "x") in found
    assert len(found) == len(listed)
    assert quotations.conversations(chats.limit(0)).count() == 0


def test_own_lines_that_read_like_an_introduction_stay(spark):
    listed = [(1, 0, "u", "On Monday my mother wrote:\nhello dear"), (1, 1, "a", "Fine.\nOn turn 0 u wrote:\n\n> hello dear\nThanks."),
              (1, 2, "u", "On turn 1 a wrote:\n> Fine.\nAm Montag schrieb:\n"), (1, 3, "a", "On Sunday he wrote:")]
    chats = spark.createDataFrame(listed, "conv_id long, turn long, role string, text string")
    assert rows(quotations.conversations(chats), "turn", "parent", "text") == [
        (0, None, listed[0][3]), (1, 0, "Fine.\n\nThanks."), (2, 1, "Am Montag schrieb:"), (3, None, "On Sunday he wrote:")]


def test_one_message_a_turn_is_quoted(spark):
    listed = [(1, 0, "u", "b"), (1, 0, "u", "a"), (1, 1, "a", "x")]
    chats = spark.createDataFrame(listed, "conv_id long, turn long, role string, text string")
    assert rows(quotations.quoting(chats), "turn", "text") == [(0, "a"), (1, "On turn 0 u wrote:\n> a\nx")]


def test_quotes_follow_lines_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(quotations, "BLOCK", 4)
    said = spark.range(40).select(
        F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.lit("u").alias("role"),
        F.when(F.col("id") % 9 == 0, F.concat(F.lit("same\nown "), "id")).otherwise("> same").alias("text"))
    parents = {t: p for t, p in rows(quotations.conversations(said), "turn", "parent")}
    assert parents == {t: None if t % 9 == 0 else t - t % 9 for t in range(40)}


def test_pipeline_on_edge_cases(spark, docs, labels, benchmark, tmp_path):
    for name, table in (("documents", docs), ("labels", labels), ("benchmark", benchmark)):
        table.write.parquet(str(tmp_path / f"{name}.parquet"))
    frame = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, str(tmp_path))
        assert frame.columns == docs.columns
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == frame.count()


def test_repeats_shared_with_a_row_without_id(spark):
    shared = " ".join(f"w{i}" for i in range(140))[:500]
    listed = [(None, shared), (1, "begin " + shared + " one end"), (2, "other start " + shared + " two ends")]
    docs = spark.createDataFrame(listed, "doc_id long, text string")
    found = {r["doc_id"]: r["n_removed"] for r in suffixes.remove_repeats(docs).collect()}
    assert all(found[i] >= 500 for i in (None, 1, 2))
