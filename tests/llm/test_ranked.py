"""Ranked search against a plain scoring of all documents, and the blocks that it leaves out."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from cohortscope.llm import queries, ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m.group().lower(), t) for t in TERM.findall(text or "")]


def brute(docs, items, top=10):
    """(item_id, rank, doc_id, score) for lists of (id, text)."""
    counted = [(i, Counter(t), len(t)) for i, t in ((i, terms(text)) for i, text in docs) if t]
    n_docs, total = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    result = []
    for item_id, text in items:
        scores = []
        for doc_id, c, n in counted:
            m = 100 - 90 + (90 * n * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if t in c)
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        result += [(item_id, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scores, key=lambda x: x[:3])[:top], 1)]
    return sorted(result, key=repr)


def found(frame):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in frame.collect()), key=repr)


def test_whole_tables(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert found(queries.op12_ranked_search(spark, sf_dir)) == brute(docs, items)


@pytest.fixture(scope="module")
def random_texts():
    rng = np.random.default_rng(3)
    words = [f"t{int(i)}" for i in range(400)]
    weights = 1 / np.arange(1, 401)
    weights /= weights.sum()
    docs = [(i, " ".join(rng.choice(words, size=rng.integers(1, 60), p=weights))) for i in range(900)]
    docs += [(1000 + i, docs[7][1]) for i in range(40)]  # copies: ties beyond the top
    items = [(i, " ".join(rng.choice(words, size=12, p=weights))) for i in range(30)] + [(99, docs[7][1])]
    return docs, items


def test_random_texts_over_small_shards(spark, random_texts, monkeypatch):
    docs, items = random_texts
    expected = brute(docs, items)
    frames = [spark.createDataFrame(rows, f"{key} long, text string") for rows, key in ((docs, "doc_id"), (items, "item_id"))]
    assert found(ranked.search(frames[0].repartition(3), frames[1])) == expected
    monkeypatch.setattr(ranked, "PASS_TERMS", 40)  # several passes, and no known vocabulary
    assert found(ranked.search(frames[0].repartition(2), frames[1])) == expected


def test_blocks_are_left_out_and_bounds_hold(random_texts):
    docs, items = random_texts
    import pyarrow as pa

    def vectors(rows):
        return [(s[0], s[1], s[2], s[3]) for _, s in ranked._counted(pa.array([t for _, t in rows]), None)]

    (sizes, offsets, hashes, counts), = vectors(docs)
    (_, cuts, asked, _), = vectors(items)
    df = Counter(hashes.tolist())
    listed = [(i, asked[a:b]) for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
    queries_ = ranked.Queries(listed, len(docs), int(sizes.sum()), {t: df[t] for t in set(asked.tolist()) if t in df})
    shard = ranked.Shard(queries_, sizes.astype(np.int64), np.diff(offsets), hashes, counts.astype(np.int64))
    everyone = np.arange(len(docs))
    tenth = np.array([np.sort(shard.scores(everyone, own))[-10] for _, own in queries_.items])
    visited = shard.candidates(np.maximum(tenth, 1))
    seen = 0
    for item, (_, own) in enumerate(queries_.items):
        scores = shard.scores(everyone, own)
        assert set(np.flatnonzero(scores >= max(tenth[item], 1))) <= set(visited.get(item, np.zeros(0)).tolist())
        seen += len(visited.get(item, ()))
    assert seen < 0.5 * sum((shard.scores(everyone, own) > 0).sum() for _, own in queries_.items)
    for term in np.argsort(-np.diff(shard.lists))[:5].tolist():
        entries = shard.postings(term)
        block = shard.clustered(entries)
        columns = np.arange(term + 1)
        summary = shard.summaries(entries, block, columns)
        assert len(summary) > 1
        for place, entry in enumerate(entries.tolist()):
            own = slice(shard.rows[shard.doc[entry]], shard.rows[shard.doc[entry]] + shard.place[entry] + 1)
            assert (summary[block[place]][shard.term[own]] >= shard.impact[own]).all()


def test_edge_cases(spark):
    docs = [(1, None), (2, ""), (3, " .,! "), (4, "Alpha beta"), (4, "alpha gamma"), (None, "alpha beta"), (5, "ÀLPHA àlpha é"),
            (6, "x" * 50_000), (7, "alpha " * 5000 + "beta")]
    items = [(1, "ALPHA"), (1, "beta"), (2, None), (3, ""), (4, "nowhere"), (None, "gamma àlpha"), (5, "É ÀLPHA")]
    frames = [spark.createDataFrame([(i, t, "x") for i, t in rows], f"{key} long, text string, terms string")
              for rows, key in ((docs, "doc_id"), (items, "item_id"))]
    assert found(ranked.search(*frames)) == brute(docs, items)
    assert ranked.search(frames[0].limit(0), frames[1]).count() == 0
    assert ranked.search(frames[0], frames[1].limit(0)).count() == 0
