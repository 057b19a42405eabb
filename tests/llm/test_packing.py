"""Packing against the tokenizers library, its lower bound, and edge cases."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from cohortscope.llm import packing, queries
from cohortscope.llm.text import blocks


@pytest.fixture(scope="module")
def tokenizer():
    own = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    own.encode_special_tokens = True
    return own


def expected(tokenizer, text):
    """(piece, start, length, crc) of a document."""
    ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], dtype="<u4")
    first = len(ids) % 1024 or 1024
    bounds = [0, *range(first, len(ids) + 1, 1024)] if len(ids) > 1024 else [0, len(ids)]
    return [(i, a, b - a, zlib.crc32(ids[a:b].tobytes())) for i, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False))]


def assert_packed(rows, capacity=1024):
    """Every sequence is filled gapless from 0 and within the capacity."""
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


def test_pieces_are_the_librarys_and_sequences_few(spark, sf_dir, tokenizer):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op11_packing(spark, sf_dir).collect()
    found = Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    assert found == Counter((i, *piece) for i, text in texts.items() for piece in expected(tokenizer, text))
    bound = -(-sum(r["length"] for r in rows) // 1024)
    assert assert_packed(rows) <= 1.02 * bound + 2


def encoded(encoder, texts):
    """The ids of each text."""
    result = []
    for block in blocks(pa.array(texts), limit=200):
        ids, bounds = encoder.encode(block)
        result += [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)]
    return result


def test_chunks_give_the_librarys_ids(tokenizer):
    encoder = packing.ChunkEncoder(public_tokenizers.path(packing.VOCABULARY))
    texts = ["", " ", "  ", "a  b", " a", "a ", "a \n b", "\n\n a\tb  \n", "don't  ' s", "x  y", "x\u0085 y", "x\x1c y",
             "\x00 a", "\x00", " \x00 a b", "né 日本 語🙂 <|endoftext|> z", "<|endoftext|>", "12 3.4 5", "a  b 　c",
             "tab\t word", "a b" * 50, "", "à é í ñ", "中文\u3000 x\u2003 y\u205f z\u1680 w\u00a0 v"]
    texts += [chr(a) + chr(b) + tail for a in range(128) for b in range(128) for tail in ("", "s", "  x")]
    texts += ["'s't're've'm'll'd'S'RE'x ' s 's", "a's b're c'll", "1's 2'd", "!'s", "\t's \n'm"]
    texts += [f"a{chr(c)} b {chr(c)} c" for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    expected = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert encoded(encoder, texts) == expected
    assert encoded(encoder, texts[:30]) == expected[:30]


def test_chunks_begin_at_spaces_after_other_characters():
    (block,) = blocks(pa.array(["ab cd  e", "", " f g\u3000 h\n i\u00e0 j"]))
    assert packing.chunk_starts(block).tolist() == [0, 2, 5, 8, 10, 22]


def test_forgetting_changes_no_ids(monkeypatch):
    encoder = packing.ChunkEncoder(public_tokenizers.path(packing.VOCABULARY))
    texts = [f"some words {i} and {i * 7919}" for i in range(50)]
    whole = encoded(encoder, texts)
    monkeypatch.setattr(packing.ChunkEncoder, "LIMIT", 40)
    assert encoded(packing.ChunkEncoder(public_tokenizers.path(packing.VOCABULARY)), texts) == whole


@pytest.mark.parametrize("counts", [{1: 5}, {1024: 3}, {600: 7}, {600: 7, 424: 7}, {500: 10, 24: 10, 1000: 4},
                                    {n: 1 + n % 5 for n in range(1, 1025, 3)}, {341: 9, 342: 9, 683: 4}, {}])
def test_plans_hold_every_piece(counts):
    made = packing.plan(counts)
    held = Counter()
    for lengths, copies in made.sequences:
        assert sum(lengths) <= 1024 and copies > 0
        for length in lengths:
            held[length] += copies
    assert held == Counter(counts) and len(made) >= made.bound


def test_the_programs_bound_exceeds_the_volume_where_lengths_do_not_fit():
    sizes, counts = np.array([600]), np.array([70])
    assert packing.solve(sizes, counts, 1024).bound == pytest.approx(70)
    assert len(packing.plan({600: 7, 424: 7})) == 7


def test_knapsack_is_exact():
    rng = np.random.default_rng(5)
    for _ in range(20):
        sizes = np.unique(rng.integers(1, 30, 6))
        prices = rng.random(len(sizes))
        best, _ = packing.knapsack(sizes, prices, 40)
        slow = [0.0] * 41
        for room in range(1, 41):
            slow[room] = max([slow[room - 1]] + [slow[room - s] + p for s, p in zip(sizes, prices, strict=True) if s <= room])
        assert best.tolist() == pytest.approx(slow)


def test_edge_cases(spark, tokenizer):
    long_text = "word " * 9000
    listed = [(1, None, "a"), (2, "", "b"), (3, long_text, "c"), (3, long_text, "c"), (None, "no id", None), (4, "<|endoftext|>", "d")]
    docs = spark.createDataFrame(listed, "doc_id long, text string, length string")
    rows = packing.pack(packing.pieces(docs)).collect()
    found = Counter((r["doc_id"], r["piece"], r["start"], r["length"], zlib.crc32(r["ids"])) for r in rows)
    assert found == Counter((i, *p) for i, text, _ in listed for p in expected(tokenizer, text))
    assert_packed(rows)
    assert packing.pack(packing.pieces(docs.limit(0))).count() == 0


def test_smaller_sequences_and_other_columns(spark):
    docs = spark.createDataFrame([(i, f"w{i} " * (i % 40)) for i in range(200)], "doc_id long, text string")
    from pyspark.sql import functions as F

    cut = packing.pieces(docs, capacity=16).withColumn("sequence", F.lit("kept")).drop("ids")
    rows = packing.pack(cut, capacity=16).collect()
    assert {r["sequence"] for r in rows} == {"kept"} and max(r["length"] for r in rows) <= 16
    assert assert_packed(rows, 16) <= 1.05 * sum(r["length"] for r in rows) / 16 + 2
