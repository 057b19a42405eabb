"""Byte-level BPE encoding and decoding over Arrow batches with the tokenizers library.

The tokenizer is built from a file of ranks: bytes are mapped to printable characters, and the merges are
recovered from the ranks (a token's merge is the last one made when its own bytes are merged by lower ranks).
Texts are cut into chunks where no match of the pattern goes on, and a task gives equal chunks to the library once.
Decoding needs the byte table only: the bytes of the ids are joined, so characters that are split between
tokens come back whole.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer, models, pre_tokenizers

from cohortscope.llm.shared import releasing, small_batches
from cohortscope.llm.text import blocks

RANKS = "byte_bpe_50k.tiktoken"
PATTERN = public_tokenizers.PATTERN
_ROWS = 64  # rows that the library encodes, and whose ids are decoded, at once
_LIMIT = 1 << 21  # characters of chunks that a task remembers, beyond those of one call
_LETTERS, _MARKS = "A-Za-zÀ-ÖØ-öø-ÿ", r"!-/:-@\[-`{-~"
#: Chunks whose ends no match of PATTERN crosses: a match never goes on from other characters to white space, nor from a
#: letter to a mark. So a text may be cut before a run of white space, and between a letter and an ASCII mark. Characters
#: that are white space to Python alone cut nothing.
_CHUNK = re.compile(
    rf" ?[{_LETTERS}]+(?=[ \t-\r{_MARKS}])|[{_MARKS}]+(?=[ \t-\r])|\s*\S+(?:[^\S \t-\r]\s*\S*)*|\s+")
_SCHEMA = "doc_id bigint, ids array<int>, starts array<int>, char_starts array<int>"


def byte_characters() -> list[str]:
    """The printable character of each byte: itself where it is printable, else the next unused from 256."""
    printable = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    spare = iter(range(256, 512))
    return [chr(b if b in printable else next(spare)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file in the order of their ids."""
    ranks = (line.split() for line in Path(path).read_bytes().splitlines() if line)
    tokens = sorted((int(rank), base64.b64decode(token)) for token, rank in ranks)
    if [rank for rank, _ in tokens] != list(range(len(tokens))):
        raise ValueError(f"{path}: the ranks have gaps")
    return [token for _, token in tokens]


def _merge(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes]:
    """The two parts that a token of several bytes is merged from."""
    parts = [token[i : i + 1] for i in range(len(token))]
    while len(parts) > 2:
        joined = [ranks.get(a + b, len(ranks)) for a, b in zip(parts, parts[1:], strict=False)]
        at = joined.index(min(joined))
        if joined[at] == len(ranks):
            raise ValueError(f"no merges lead to {token!r}")
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts[0], parts[1]


class Codec:
    """Encodes texts to ids and decodes ids to bytes."""

    def __init__(self, tokens: list[bytes], pattern: str = PATTERN):
        self.tokens = tokens
        self.lengths = np.array([len(t) for t in tokens], dtype=np.int64)
        characters = byte_characters()
        ranks = {token: rank for rank, token in enumerate(tokens)}

        def shown(token: bytes) -> str:
            return "".join(characters[b] for b in token)

        merges = [tuple(map(shown, _merge(token, ranks))) for token in tokens if len(token) > 1]
        model = models.BPE({shown(t): i for i, t in enumerate(tokens)}, merges, ignore_merges=True)
        self.tokenizer = Tokenizer(model)
        self.by_chunk = pattern == PATTERN
        self.forget()
        if self.by_chunk:  # the library's own copy of this pattern, with bytes mapped in the same pass
            self.tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        else:
            self.tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
                pre_tokenizers.Split(Regex(pattern), "isolated"),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ])

    def forget(self) -> None:
        self.known: dict[str, bytes] = {}  # ids of chunks, as packed 32-bit numbers
        self.size = 0

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, chunks: list[str]) -> None:
        """Encode chunks that are not known. Those that begin with white space and end with something else go through
        the library joined, as they may be cut apart again; tokens tell by their lengths where."""
        joined, others = [], []
        for chunk in chunks:
            (joined if chunk[0] in " \t\n\v\f\r" and not chunk[-1].isspace() else others).append(chunk)
        ids = np.array(self._whole(["".join(joined)])[0], dtype=np.int32)
        ends = np.cumsum([len(c.encode()) for c in joined])
        at = [0, *(4 * np.searchsorted(np.cumsum(self.lengths[ids]), ends, side="right")).tolist()]
        packed = ids.tobytes()
        self.known.update(zip(joined, [packed[a:b] for a, b in zip(at, at[1:], strict=False)], strict=True))
        self.known.update(zip(others, [np.array(i, dtype=np.int32).tobytes() for i in self._whole(others)], strict=True))
        self.size += sum(map(len, chunks))

    def encode(self, texts: list[str]) -> list[list[int]]:
        if not self.by_chunk:
            return self._whole(texts)
        if self.size > _LIMIT:
            self.forget()
        chunks = [_CHUNK.findall(t) for t in texts]
        self._learn(list(set().union(*chunks).difference(self.known)))
        return [np.frombuffer(b"".join(map(self.known.__getitem__, c)), dtype=np.int32).tolist() for c in chunks]

    def decode_bytes(self, ids: list[int]) -> bytes:
        return b"".join([self.tokens[i] for i in ids])

    def decode(self, ids: list[int]) -> str:
        """The text of the ids; a character that is cut off at an end becomes U+FFFD."""
        return self.decode_bytes(ids).decode("utf-8", "replace")

    def byte_starts(self, ids: list[int]) -> np.ndarray:
        """For each token the offset of its first byte."""
        lengths = self.lengths[np.asarray(ids, dtype=np.int64)]
        return np.cumsum(lengths) - lengths

    def char_starts(self, ids: list[int], data: bytes) -> np.ndarray:
        """For each token the offset of the character that its first byte belongs to."""
        leads = (np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80
        return np.cumsum(leads)[self.byte_starts(ids)] - 1 if len(ids) else np.zeros(0, np.int64)


def ranks_of(spark: SparkSession, path: str | None = None):
    """The tokens as a broadcast of fixed size: one vocabulary."""
    return spark.sparkContext.broadcast(read_ranks(path or public_tokenizers.path(RANKS)))


@lru_cache(maxsize=1)
def _codec(tokens: tuple[bytes, ...], pattern: str) -> Codec:
    return Codec(list(tokens), pattern)


def encode(docs: DataFrame, path: str | None = None, pattern: str = PATTERN) -> DataFrame:
    """One row a document: token ids, and for each token the offset of its first byte and of that byte's character.

    A null text counts as empty and gives empty lists; repeated rows are encoded each.
    """
    small_batches(docs)
    tokens = ranks_of(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        codec = _codec(tuple(tokens.value), pattern)
        try:
            for batch in batches:
                for block in blocks(batch.column("text")):
                    texts = [t.decode("utf-8", "replace") for t in block.texts()]
                    ids = [np.array(i, dtype=np.int32) for first in range(0, len(texts), _ROWS)
                           for i in codec.encode(texts[first : first + _ROWS])]
                    lists = [ids, [codec.byte_starts(i) for i in ids],
                             [codec.char_starts(i, t.encode()) for i, t in zip(ids, texts, strict=True)]]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").slice(block.first, len(block)),
                         *[pa.array([x.astype(np.int32) for x in c], pa.list_(pa.int32())) for c in lists]],
                        ["doc_id", "ids", "starts", "char_starts"])
        finally:
            codec.forget()  # the worker stays, for other work

    return docs.select("doc_id", "text").mapInArrow(releasing(run), _SCHEMA)


def _joined(ids: pa.Array, table: pa.Array) -> list[str | None]:
    """The text of each list of ids: the bytes of all lists are joined at once and cut where a list ends."""
    ends = np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False))
    flat = table.take(ids.flatten())
    sizes = pc.binary_length(flat).to_numpy(zero_copy_only=False)
    at = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], ends])].astype(np.int64).tolist()
    data = flat.buffers()[2].to_pybytes() if at[-1] else b""
    return [data[a:b].decode("utf-8", "replace") if known else None
            for a, b, known in zip(at, at[1:], ids.is_valid().to_pylist(), strict=False)]


def decode(encoded: DataFrame, path: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """The texts of `ids`: joined bytes, read as UTF-8. Null ids give a null text. Columns to `keep` go along."""
    tokens = ranks_of(encoded.sparkSession, path)
    own = encoded.select("doc_id", *[c for c in keep if c != "ids"], "ids")
    names = ["doc_id", *keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.array(tokens.value, pa.large_binary())
        for batch in batches:
            for first in range(0, batch.num_rows, _ROWS):
                part = batch.slice(first, _ROWS)
                texts = pa.array(_joined(part.column("ids"), table), pa.string())
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], texts], [*names, "text"])

    return own.mapInArrow(releasing(run), encoded.select(*names).schema.add("text", "string"))


def read_back(docs: DataFrame, path: str | None = None, pattern: str = PATTERN,
              keep: tuple[str, ...] = ("ids", "starts", "char_starts")) -> DataFrame:
    """One row a document: what `encode` gives of the columns to `keep` (`ids` at least), the text that the ids decode
    to, the number of ids, a hash of the ids and a hash of the decoded text."""
    return decode(encode(docs, path, pattern), path, keep).withColumns({
        "n_tokens": F.size("ids").cast("bigint"),
        "ids_sha256": F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256),
        "decoded_sha256": F.sha2("text", 256),
    })


def digests(docs: DataFrame, path: str | None = None, pattern: str = PATTERN) -> DataFrame:
    """One row a document: the number of ids, a hash of the ids and a hash of the text they decode to.

    Only the ids go on to the second Python worker; the offsets would treble what it reads and returns.
    """
    return read_back(docs, path, pattern, keep=("ids",)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
