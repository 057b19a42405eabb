"""Byte-level BPE: texts are encoded chunk by chunk, and a task encodes equal chunks once."""

import random

import public_tokenizers
import pyarrow as pa
import pytest

from cohortscope.llm import bpe

RANKS = bpe.read_ranks(public_tokenizers.path(bpe.RANKS))


@pytest.fixture
def codec():
    return bpe.Codec(RANKS)


class Watched:
    """The library's tokenizer, with the characters that it was given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.characters = tokenizer, 0

    def encode_batch_fast(self, texts, **options):
        self.characters += sum(map(len, texts))
        return self.tokenizer.encode_batch_fast(texts, **options)


def test_equal_chunks_are_encoded_once(codec):
    words = [f"word{i} of the été, it's" for i in range(50)]
    texts = [" ".join(words[i % 50 :] + words[: i % 50]) for i in range(200)]
    whole = [e.ids for e in codec.tokenizer.encode_batch(texts, add_special_tokens=False)]
    codec.tokenizer = Watched(codec.tokenizer)
    assert [ids for t in texts for ids in codec.encode([t])] == whole
    assert codec.tokenizer.characters < 3 * len(texts[0])  # of 200 texts of that length


def test_chunks_change_no_ids(codec):
    pieces = [*" \t\n\r\v\f'’.,!-_$ab sétldvmre19é日ßÿªº×\x00\x1c\x1f\x85\xa0\u0301\u1680\u180e\u2003\u2028\u200b\u3000🙂İ٠\ufeff",
              "'s", "'ll", "'S", "  ", "<|endoftext|>"]
    rng = random.Random(5)
    texts = ["", " ", "\n ", *["".join(rng.choices(pieces, k=rng.randrange(30))) for _ in range(20_000)]]
    texts += [f"x{c} y{c}. z{c}\n{c}'s a{c}'{c} b.{c}  {c}\t {c}" for c in map(chr, range(0x3100))]
    for first in range(0, len(texts), 64):
        part = texts[first : first + 64]
        assert codec.encode(part) == codec._whole(part)


def test_chunks_are_forgotten_beyond_a_limit(codec, monkeypatch):
    monkeypatch.setattr(bpe, "_LIMIT", 40)
    texts = [f"some words {i} and words {i // 2}, more" for i in range(50)]
    assert [ids for t in texts for ids in codec.encode([t])] == codec._whole(texts)
    assert len(codec.known) < 20


def test_other_patterns_are_not_cut():
    codec = bpe.Codec(RANKS, r"\S+ |\S+")
    texts = ["one two, one two", "it's one two"]
    assert codec.encode(texts) == [e.ids for e in codec.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert not codec.known


def test_a_task_leaves_no_chunks_behind(spark, monkeypatch):
    functions, docs = [], spark.createDataFrame([(0, "")], "doc_id long, text string")
    kind = type(docs)
    plain = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda df, f, *a, **b: functions.append(f) or plain(df, f, *a, **b))
    bpe.encode(docs)
    batch = pa.record_batch([pa.array([1, 2]), pa.array(["one two one", None])], ["doc_id", "text"])
    codec = bpe._codec(tuple(RANKS), bpe.PATTERN)
    rows = functions[0](iter([batch]))
    assert next(rows).num_rows == 2 and codec.known
    assert not list(rows) and not codec.known
