"""Token counts by greedy longest match in linear time.

The vocabulary is a trie with two roots, for pieces that begin a word and for pieces that continue one. Each node
has a failure link, to the node from which matching goes on when no child fits, and the number of pieces that are
complete by then. A word is read once, character by character; following a link adds its count, so lengths come
out without a piece being built.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from cohortscope.llm.text import blocks

VOCABULARY = "piece_bpe_32k.model"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_BEGINS = "▁"
#: Words whose lengths a worker remembers; it starts anew when there are more.
KNOWN_WORDS = 300_000
_NONE = -1


def read_vocabulary(path: str) -> tuple[list[str], list[str]]:
    """The pieces of a model file that begin a word and those that continue one, without control and byte pieces."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = (i for i in range(model.get_piece_size())
           if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)))
    pieces = [model.id_to_piece(i) for i in ids]
    begin = [p[1:] for p in pieces if p.startswith(_BEGINS) and p[1:] and _BEGINS not in p[1:]]
    return begin, [p for p in pieces if _BEGINS not in p]


class Automaton:
    """The trie's children, failure links and popped-piece counts by node; node 0 begins words, node 1 goes on."""

    def __init__(self, begin: Iterable[str], go_on: Iterable[str]):
        self.children: list[dict[str, int]] = [{}, {}]
        complete = [False, False]
        for root, pieces in ((0, begin), (1, go_on)):
            for piece in pieces:
                node = root
                for c in piece:
                    if c not in self.children[node]:
                        self.children[node][c] = len(self.children)
                        self.children.append({})
                        complete.append(False)
                    node = self.children[node][c]
                complete[node] = True
        self.link = [_NONE] * len(self.children)
        self.popped = [0] * len(self.children)
        level = [0, 1]
        while level:  # links lead to nodes nearer to a root, so whole levels are ready in turn
            for node in level:
                for c, child in self.children[node].items():
                    if complete[child]:
                        self.link[child], self.popped[child] = 1, 1
                        continue
                    at, count = self.link[node], self.popped[node]
                    while at != _NONE and c not in self.children[at]:
                        count += self.popped[at]
                        at = self.link[at]
                    if at != _NONE:
                        self.link[child], self.popped[child] = self.children[at][c], count
            level = [child for node in level for child in self.children[node].values()]

    def length(self, word: str) -> int:
        """The number of pieces of a word; 0 if no pieces make it up."""
        children, link, popped = self.children, self.link, self.popped
        node, count = 0, 0
        for c in word:
            while c not in children[node]:
                count += popped[node]
                node = link[node]
                if node == _NONE:
                    return 0
            node = children[node][c]
        while node != 1:
            count += popped[node]
            node = link[node]
            if node == _NONE:
                return 0
        return count


class Counter:
    """Lengths of words, remembered while there are not too many."""

    def __init__(self, automaton: Automaton):
        self.automaton = automaton
        self.known: dict[str, int] = {}

    def count(self, text: str) -> tuple[int, int, int]:
        """Words, pieces (one for a word that no pieces make up) and such words."""
        words = _WORD.findall(text)
        new = set(words).difference(self.known)
        if len(self.known) + len(new) > KNOWN_WORDS:
            self.known.clear()
            new = set(words)
        for word in new:
            self.known[word] = self.automaton.length(word)
        lengths = [self.known[word] for word in words]
        unknown = lengths.count(0)
        return len(words), sum(lengths) + unknown, unknown


@lru_cache(maxsize=1)
def _counter(begin: tuple[str, ...], go_on: tuple[str, ...]) -> Counter:
    return Counter(Automaton(begin, go_on))


def token_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row a document: n_words, n_tokens and n_unknown, the words that the pieces cannot make up (a token each).

    Words are runs of characters other than the space and \\t \\n \\v \\f \\r, of any length. A null text has none.
    """
    # One vocabulary, whatever the input.
    vocabulary = docs.sparkSession.sparkContext.broadcast(
        tuple(map(tuple, read_vocabulary(path or public_tokenizers.path(VOCABULARY)))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(*vocabulary.value)
        for batch in batches:
            for block in blocks(batch.column("text")):
                counts = [counter.count(t.decode("utf-8", "replace")) for t in block.texts()]
                columns = [pa.array([c[i] for c in counts], pa.int64()) for i in range(3)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(block.first, len(block)), *columns],
                    ["doc_id", "n_words", "n_tokens", "n_unknown"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id bigint, n_words bigint, n_tokens bigint, n_unknown bigint")
