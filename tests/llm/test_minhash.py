"""Near-duplicates against plain set comparison, over blocks of lists and groups of copies."""

import re

import numpy as np
import pyarrow as pa
import pytest

from cohortscope.llm import minhash


def shingle_set(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", text.lower())
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if len(words) >= size else {tuple(words)} - {()}


def brute(texts, size, percent):
    """(doc_id, component) by rows of (doc_id, text)."""
    sets = [shingle_set(t or "", size) for _, t in texts]
    root = list(range(len(texts)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if shared and 100 * shared >= percent * len(sets[i] | sets[j]):
                root[max(top(i), top(j))] = min(top(i), top(j))
    smallest = {}
    for i, (doc_id, _) in enumerate(texts):
        smallest[top(i)] = min(doc_id, smallest.get(top(i), doc_id))
    return sorted((doc_id, smallest[top(i)]) for i, (doc_id, _) in enumerate(texts))


def found(spark, texts, size, percent):
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    return sorted((r["doc_id"], r["component_id"]) for r in minhash.near_duplicates(frame, size, percent).collect())


def edited(rng, words, edits):
    copy = list(words)
    for at in rng.choice(len(copy), edits, replace=False):
        copy[at] = f"e{rng.integers(1 << 40)}"
    return " ".join(copy)


@pytest.fixture(scope="module")
def groups():
    """Groups of copies with few edits, many edits (similar to 0.6 to 0.8), chains, and others."""
    rng = np.random.default_rng(8)
    texts = []
    for group in range(3):
        words = [f"g{group}w{i}" for i in range(120)]
        texts += [edited(rng, words, edits) for edits in [1] * 8 + [5] * 25 + [12] * 8]
        chain = list(words)
        for step in range(12):  # each is near the one before, the ends are far apart
            chain[step * 6 : step * 6 + 4] = [f"g{group}c{step}_{k}" for k in range(4)]
            texts.append(" ".join(chain))
    texts += [" ".join(f"r{rng.integers(1 << 40)}" for _ in range(30)) for _ in range(40)]
    return [(1000 + int(i), texts[int(i)]) for i in rng.permutation(len(texts))]


def test_components_of_edited_copies(spark, groups, monkeypatch):
    expected = brute(groups, 5, 80)
    assert found(spark, groups, 5, 80) == expected
    monkeypatch.setattr(minhash, "BLOCK", 7)
    monkeypatch.setattr(minhash, "STREAM", 3)
    assert found(spark, groups, 5, 80) == expected


def test_one_id_with_two_texts(spark):
    rng = np.random.default_rng(2)
    one, other = ([f"{k}{i}" for i in range(80)] for k in "ab")
    texts = [(5, " ".join(one)), (5, " ".join(other)), (7, edited(rng, one, 1)), (3, edited(rng, other, 1)), (5, " ".join(one))]
    assert found(spark, texts, 5, 80) == [(3, 3), (5, 3), (5, 5), (5, 5), (7, 5)]


def test_blocks_emit_a_forest_of_links(groups):
    sets = [np.unique(np.array([hash(x) & (1 << 62) - 1 for x in shingle_set(t, 5)], np.uint64)) for _, t in groups]
    numbers, n = pa.array(range(len(sets)), pa.int64()), len(sets)
    table = pa.table({
        "post": pa.array([1] * n, pa.int64()), "i": pa.array([0] * n, pa.int32()), "j": pa.array([0] * n, pa.int32()),
        "with_main": pa.array([False] * n), "second": pa.array([False] * n), "class_id": numbers, "root": numbers,
        "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
        "posts": pa.array(minhash._signatures(sets).tolist(), pa.list_(pa.int64())),
        "members": pa.array([s.tobytes() for s in sets], pa.binary()),
    })
    rest = pa.concat_tables([table.slice(3, 9), table.slice(0, 2).set_column(0, "post", pa.array([2, 2], pa.int64()))])
    batches = [b for t in (table, rest) for b in t.to_batches(max_chunksize=50)]
    assert [t.num_rows for t in minhash._groups(iter(batches), ["post", "i"])] == [n + 9, 2]
    links = minhash._links(80, table)
    touched = {i for link in links for i in link}
    assert touched <= set(minhash._colliding(table).tolist()) and len(minhash._colliding(table)) < n
    assert all(len(sets[a]) and 100 * len(np.intersect1d(sets[a], sets[b])) >= 80 * len(np.union1d(sets[a], sets[b])) for a, b in links)
    plain = dict(brute(groups, 5, 80))
    assert len(links) == len(groups) - len(set(plain.values()))
    numbered, n_members = minhash._compact(sets)
    shared = minhash._shared_counts(numbered[:9], numbered[5:30], n_members)
    assert shared.tolist() == [[len(np.intersect1d(a, b)) if a is not b else len(numbered[i + 5])
                                for i, b in enumerate(sets[5:30])] for a in sets[:9]]
