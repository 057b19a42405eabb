"""What tasks leave behind in their Python workers."""

import re
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from cohortscope.llm import bpe, minhash, shared, toxicity

TEXTS = ["one two three four five six", "", None, "seven eight nine ten eleven"]


def _own_mb() -> int:
    return int(re.search(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) // 1024


def test_a_task_hands_back_what_it_has_freed():
    held = []

    def run(batches):
        pieces = [np.ones(10_000, dtype=np.uint8) for _ in range(12_000)]
        held.append(pieces[-1])  # the end of the heap stays in use
        del pieces
        yield from batches

    before = _own_mb()
    assert list(shared.releasing(run)(iter([1, 2]))) == [1, 2]
    assert _own_mb() - before < 60  # of 120 MB that were freed


def _model():
    return toxicity._parts(toxicity._start(np.zeros(toxicity.BUCKETS), 0.1))


@pytest.mark.parametrize("name, operator", [
    ("encode", bpe.encode),
    ("signatures", lambda docs: minhash.signatures(docs, 5)),
    ("sets", lambda docs: minhash.full_sets(docs, 5)),
    ("score", lambda docs: toxicity.score(docs, _model())),
    ("clean", lambda docs: toxicity.keep_clean(docs, _model())),
])
def test_operators_hand_back_memory_once_a_task(spark, monkeypatch, name, operator):
    functions, times = [], []
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(TEXTS)], "doc_id long, text string, lang string")
    kind = type(docs)
    plain = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda df, f, *a, **b: functions.append(f) or plain(df, f, *a, **b))
    monkeypatch.setattr(shared, "_give_back", lambda: times.append(name), raising=False)
    operator(docs)
    batch = pa.record_batch([pa.array(range(len(TEXTS))), pa.array(TEXTS), pa.array(["en"] * len(TEXTS))],
                            ["doc_id", "text", "lang"])
    batch = batch if name == "clean" else batch.select(["doc_id", "text"])
    assert sum(b.num_rows for b in functions[0](iter([batch, batch]))) == 2 * len(TEXTS)
    assert times == [name]


def test_texts_are_encoded_some_at_a_time(spark, monkeypatch):
    """The library keeps far more for a text than its ids, so a block's texts are not with it all at once."""
    sizes, encode = [], bpe.Codec.encode
    monkeypatch.setattr(bpe.Codec, "encode", lambda codec, texts: sizes.append(len(texts)) or encode(codec, texts))
    functions, docs = [], spark.createDataFrame([(0, "")], "doc_id long, text string")
    kind = type(docs)
    plain = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda df, f, *a, **b: functions.append(f) or plain(df, f, *a, **b))
    bpe.encode(docs)
    texts = [f"word {i}" for i in range(200)]
    batch = pa.record_batch([pa.array(range(200)), pa.array(texts)], ["doc_id", "text"])
    found = pa.Table.from_batches(functions[0](iter([batch])))
    codec = bpe._codec(tuple(bpe.read_ranks(bpe.public_tokenizers.path(bpe.RANKS))), bpe.PATTERN)
    assert max(sizes) <= 64 and sum(sizes) == 200
    assert found.column("ids").to_pylist() == [codec.encode([t])[0] for t in texts]


def test_block_size_changes_no_set():
    texts = pa.array([" ".join(f"w{(7 * i + k) % 50}" for k in range(i % 40)) for i in range(300)])
    found = [[s.tolist() for block in minhash.blocks(texts, limit) for s in minhash.shingles(block, 5)]
             for limit in (1 << 8, minhash._TEXT_BYTES, 1 << 21)]
    assert found[0] == found[1] == found[2]
