"""Queries that SQL cannot express, against brute-force versions, other libraries or held-out labels."""

import base64
import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from cohortscope.llm import bpe, decontamination, minhash, pii, queries, sharding, suffixes, toxicity, wordpiece

ENTITY = re.compile(r"[\w.+-]+@[\w.-]+\.\w+|\b\d{1,3}(?:\.\d{1,3}){3}\b|\+\d+ ?\(\d{3}\) ?\d{3}-\d{4}|\b\d{16}\b")


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_bpe_is_tiktoken(spark, sf_dir, texts):
    path = public_tokenizers.path(bpe.RANKS)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for doc_id, row in by_id(queries.op4_byte_bpe(spark, sf_dir)).items():
        ids = other.encode_ordinary(texts[doc_id])
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(texts[doc_id].encode()).hexdigest()


def test_offsets_and_split_characters(spark):
    text = "né 日本🙂 <|endoftext|>"
    row = bpe.encode(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    codec = bpe.Codec(bpe.read_ranks(public_tokenizers.path(bpe.RANKS)))
    data = text.encode()
    ends = [*row["starts"][1:], len(data)]
    assert [data[a:b] for a, b in zip(row["starts"], ends, strict=True)] == [codec.tokens[i] for i in row["ids"]]
    assert all(text[c].encode().startswith(data[a : a + 1]) or data[a] & 0xC0 == 0x80
               for a, c in zip(row["starts"], row["char_starts"], strict=True))
    emoji = codec.encode(["🙂"])[0]
    assert len(emoji) > 1 and codec.decode(emoji) == "🙂" and codec.decode(emoji[:1]) == "�"


def test_digests_come_from_encode_and_decode(spark, monkeypatch):
    texts = {1: "né 日本🙂", 2: "", 3: None, 4: "plain words " * 300, None: "no id"} | {i: f"t {i}" for i in range(5, 90)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    codec = bpe.Codec(bpe.read_ranks(public_tokenizers.path(bpe.RANKS)))
    found = by_id(corpus_pipeline.encode(spark, docs, ""))
    assert found.keys() == texts.keys()
    for doc_id, row in found.items():
        text = texts[doc_id] or ""
        assert row["ids"] == codec.encode([text])[0] and row["n_tokens"] == len(row["ids"]) and row["text"] == text
        assert row["starts"] == codec.byte_starts(row["ids"]).tolist()
        assert row["char_starts"] == codec.char_starts(row["ids"], text.encode()).tolist()
        assert row["ids_sha256"] == hashlib.sha256(" ".join(map(str, row["ids"])).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    called = []
    for name in ("encode", "decode"):
        monkeypatch.setattr(bpe, name, lambda *a, own=getattr(bpe, name), name=name: called.append(name) or own(*a))
    bpe.digests(docs)
    assert called == ["encode", "decode"]


def test_digests_send_no_offsets_to_the_second_worker(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "né 日本🙂"), (2, None)], "doc_id long, text string")
    kept, decode = [], bpe.decode
    monkeypatch.setattr(bpe, "decode", lambda encoded, path, keep: kept.append(keep) or decode(encoded, path, keep))
    rows = by_id(bpe.digests(docs))
    assert kept == [("ids",)] and rows[2]["n_tokens"] == 0
    assert rows[1]["decoded_sha256"] == hashlib.sha256("né 日本🙂".encode()).hexdigest()


def test_decode_of_cut_and_null_ids(spark):
    codec = bpe.Codec(bpe.read_ranks(public_tokenizers.path(bpe.RANKS)))
    emoji = codec.encode(["🙂"])[0]
    encoded = spark.createDataFrame([(1, emoji), (2, None), (3, emoji[:1]), (4, []), (5, emoji + emoji)],
                                    "doc_id long, ids array<int>")
    assert {i: r["text"] for i, r in by_id(bpe.decode(encoded)).items()} == {
        1: "🙂", 2: None, 3: "\ufffd", 4: "", 5: "🙂🙂"}


def longest_match(word, begin, go_on):
    at = count = 0
    while at < len(word):
        pieces = begin if at == 0 else go_on
        end = next((e for e in range(len(word), at, -1) if word[at:e] in pieces), None)
        if end is None:
            return 0
        at, count = end, count + 1
    return count


def test_wordpiece_counts(spark, sf_dir, texts):
    begin, go_on = map(set, wordpiece.read_vocabulary(public_tokenizers.path(wordpiece.VOCABULARY)))
    for doc_id, row in by_id(queries.op7_wordpiece_counts(spark, sf_dir)).items():
        words = re.findall(r"[^\x20\x09-\x0D]+", texts[doc_id])
        lengths = [longest_match(w, begin, go_on) for w in words]
        unknown = lengths.count(0)
        assert tuple(row)[1:] == (len(words), sum(lengths) + unknown, unknown)


def test_longest_match_on_random_vocabularies():
    random = np.random.default_rng(3)

    def word():
        return "".join(random.choice(list("abc"), random.integers(1, 6)))

    for _ in range(500):
        begin, go_on = {word() for _ in range(5)}, {word() for _ in range(5)}
        automaton = wordpiece.Automaton(begin, go_on)
        for w in (word() for _ in range(10)):
            assert automaton.length(w) == longest_match(w, begin, go_on)


def test_suffix_array_on_random_strings():
    random = np.random.default_rng(3)
    for _ in range(500):
        s = random.integers(1, random.integers(2, 6), random.integers(0, 40)).astype(np.int64)
        assert suffixes.suffix_array(s).tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())


def removed(texts, length):
    seen = Counter(t[i : i + length] for t in texts.values() for i in range(len(t) - length + 1))
    result = {}
    for doc_id, t in texts.items():
        gone = np.zeros(len(t) + 1, dtype=np.int8)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = 1
        kept = bytes(np.frombuffer(t, np.uint8)[gone[:-1] == 0])
        result[doc_id] = (len(t), int(gone.sum()), int((np.diff(np.append([0], gone)) == 1).sum()), kept)
    return result


def test_repeats_of_400_bytes(spark, sf_dir, texts):
    expected = removed({i: t.encode() for i, t in texts.items()}, 400)
    for doc_id, row in by_id(queries.op8_suffix_dedup(spark, sf_dir)).items():
        *counts, kept = expected[doc_id]
        assert tuple(row)[1:] == (*counts, hashlib.sha256(kept).hexdigest())


@pytest.mark.parametrize("max_runs", [0, 1000])
def test_short_repeats_by_sorting_and_by_windows(spark, monkeypatch, max_runs):
    monkeypatch.setattr(suffixes, "MAX_RUNS", max_runs)
    random = np.random.default_rng(5)
    parts = ["".join(random.choice(list("abé"), 15)) for _ in range(6)]
    listed = ["".join(random.choice(parts, 4)) + "".join(random.choice(list("xyz"), 5)) for _ in range(60)]
    listed += ["a" * 60, None, "", listed[0]]
    docs = spark.createDataFrame(list(enumerate(listed)), "doc_id long, text string")
    expected = removed({i: (t or "").encode() for i, t in enumerate(listed)}, 20)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"]))
           for r in suffixes.remove_repeats(docs, length=20, gram=6).collect()}
    assert got == expected


def smallest_capacity(sizes, shards):
    def needed(capacity):
        count, room = 1, capacity
        for size in sizes:
            count, room = (count, room - size) if size <= room else (count + 1, capacity - size)
        return count

    low, high = max(sizes), sum(sizes)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if needed(middle) <= shards else (middle + 1, high)
    return low


@pytest.mark.parametrize("cells", [16, 4096])
def test_shards(spark, sf_dir, texts, monkeypatch, cells):
    monkeypatch.setattr(sharding.Search.__init__, "__defaults__", (cells, ()))
    found = by_id(queries.op9_sharding(spark, sf_dir))
    assert found.keys() == texts.keys()
    groups, shards, loads = {}, {}, Counter()
    for doc_id, row in found.items():
        data = texts[doc_id].encode()
        assert (row["size"], row["text_crc32"]) == (len(data) + 16, zlib.crc32(data))
        assert groups.setdefault(data, row["shard"]) == row["shard"] and 0 <= row["shard"] < 40
        shards.setdefault(row["shard"], []).append(row["slot"])
        loads[row["shard"]] += row["size"]
    assert all(sorted(slots) == list(range(len(slots))) for slots in shards.values())
    sizes = Counter()
    for data in map(str.encode, texts.values()):
        sizes[hashlib.sha256(data).hexdigest()] += len(data) + 16
    assert max(loads.values()) == smallest_capacity([sizes[k] for k in sorted(sizes)], 40)


def test_toxicity_on_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = [r for r in queries.op10_toxicity(spark, sf_dir).collect() if r["held_out"] and r["doc_id"] in labels]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in rows)
    pairs = Counter((labels[r["doc_id"]], r["predicted"]) for r in rows)
    assert pairs[1, 1] > pairs[1, 0] and pairs[0, 1] <= 0.02 * pairs[0, 0]


def test_toxicity_learns_from_every_labelled_text(spark):
    """A word that only texts beyond the first 2,500 by hash have is learned, in shards whose changes are averaged."""
    ids = [i for i in range(7600) if zlib.crc32(str(i).encode()) % 4 != 2]
    rows = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, toxic int")
    order = [r["doc_id"] for r in rows.where("toxic = 1").orderBy(F.xxhash64("doc_id"), "doc_id").collect()]
    assert len(order) > 2700 and len(ids) > 4096  # two shards
    texts = dict.fromkeys(ids, "good day") | dict.fromkeys(order, "bad day") | dict.fromkeys(order[2500:], "vile day")
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumn("lang", F.lit("en"))
    model = toxicity.train(docs, rows)
    asked = spark.createDataFrame([(0, "good day"), (1, "bad day"), (2, "vile day")], "doc_id long, text string")
    scores = {i: r["score"] for i, r in by_id(toxicity.score(asked, model)).items()}
    assert scores[0] < 0.05 and scores[1] > 0.95 and scores[2] > 0.95 and set(model.thresholds) == {"en"}


def test_toxicity_of_repeated_ids_does_not_follow_the_input_order(spark):
    rows = [(i % 40, f"{'bad' if i % 2 else 'good'} w{i % 7} {i // 40}", "en") for i in range(80)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    found = []
    for own in (rows, rows[::-1]):
        model = toxicity.train(spark.createDataFrame(own, "doc_id long, text string, lang string"), labels, shard_texts=8)
        found.append([*model.filters, model.out, model.table])
    assert all(np.allclose(a, b, atol=1e-5) for a, b in zip(*found, strict=True))


def test_surrogates(spark, sf_dir, texts):
    new = {i: r["text"] for i, r in by_id(queries.op2_pii(spark, sf_dir)).items()}
    given = {}
    for doc_id, text in texts.items():
        for old, got in zip(ENTITY.findall(text), ENTITY.findall(new[doc_id]), strict=True):
            assert given.setdefault(old, got) == got != old
        if not ENTITY.search(text) and "token" not in text:
            assert new[doc_id] == text
    assert given and len(set(given.values())) == len(given) and not set(given) & set(given.values())


def luhn(digits):
    doubled = [int(c) * (i % 2 + 1) for i, c in enumerate(reversed(digits))]
    return sum(x - 9 if x > 9 else x for x in doubled) % 10 == 0


def test_surrogates_keep_type_format_gender_and_identity(spark):
    docs = spark.createDataFrame([
        (1, "4111 1111 1111 1111 and 4111-1111-1111-1111, 4111111111111112; John@Host.org john@host.org x@host.org"),
        (2, "Mrs. Anna Smith, Mr Smith, Госпожа Анна Иванова; 10.0.0.255. +44 (020) 555-0100"),
    ], "doc_id long, text string")
    one, two = (r["text"] for r in pii.replace(docs).orderBy("doc_id").collect())
    spaced, dashed, invalid = re.findall(r"\d[\d -]{14,17}\d", one)
    assert spaced.replace(" ", "") == dashed.replace("-", "") and luhn(dashed.replace("-", "")) and not luhn(invalid)
    first, second, third = re.findall(r"\S+@\S+", one)
    assert first.lower() == second and first[0].isupper() and second.split("@")[1] == third.split("@")[1]
    names = re.match(r"Mrs\. (\w+na) (\w+), Mr (\w+), Госпожа ([А-я]+на) ([А-я]+);", two)
    assert names and names[2] == names[3] and "Smith" not in two


HEX = re.compile(r"(?<![0-9A-Za-z])[0-9A-Fa-f]{32,}(?![0-9A-Za-z])")


def test_no_secret_survives(spark, sf_dir, texts):
    tokens = [hashlib.sha512(str(i).encode()).hexdigest() * 20 for i in range(4)]
    upper, lower, mixed = tokens[0][:40].upper(), tokens[0][:40], tokens[0][:20] + tokens[0][20:40].upper()
    listed = [f'TOKEN = "{upper}"!!', f"{lower} and {mixed}"]
    listed += [f"key={t[:n]};" for t, n in zip(tokens, (129, 256, 257, 2500), strict=True)]
    planted = {-1 - i: text for i, text in enumerate(listed)}
    docs = spark.createDataFrame(list((texts | planted).items()), "doc_id long, text string")
    new = {i: r["text"] for i, r in by_id(pii.replace(docs)).items()}
    real = {t.lower() for text in (texts | planted).values() for t in HEX.findall(text)}
    assert len(real) >= 5
    for doc_id, text in (texts | planted).items():
        got = HEX.findall(new[doc_id])
        assert list(map(len, got)) == list(map(len, HEX.findall(text))) and not {t.lower() for t in got} & real
    (first,), (second, third) = HEX.findall(new[-1]), HEX.findall(new[-2])
    assert first.isupper() and second.islower() and first.lower() == second == third.lower()
    assert HEX.sub("", new[-1]) == 'TOKEN = ""!!'


@pytest.mark.parametrize("address", ["a" * 65 + "@host.org", "Ab.9" * 500 + "@" + "x." * 20 + "host.org"])
def test_long_addresses(spark, address):
    docs = spark.createDataFrame([(1, f"to {address}, {address.lower()}.")], "doc_id long, text string")
    first, second = re.fullmatch(r"to (\S+), (\S+)\.", pii.replace(docs).first()["text"]).groups()
    assert first.lower() == second and len(first) == len(address) and first.endswith(".org")
    assert all(a != b for a, b in zip(first.split("@"), address.split("@"), strict=True)) and "aaaaa" not in first


SIDE_BY_SIDE = {
    "ip": "190.137.223.204", "ssn": "123-45-6789", "card": "4111 1111 1111 1111", "email": "99bob@host.org",
    "secret": "1234" + "ab12" * 9, "phone": "+1 (843) 555-7672",
}


@pytest.mark.parametrize("phone", ["+1 (826) 555-4081", "+44 20 7946 0958", "+354 555 1234", "+33 01 42.68.53.12"])
def test_entities_side_by_side(spark, phone):
    listed = [phone, *(f"{phone} {other}" for other in SIDE_BY_SIDE.values()), *SIDE_BY_SIDE.values()]
    docs = spark.createDataFrame(list(enumerate(listed)), "doc_id long, text string")
    alone, *got = (r["text"] for r in pii.replace(docs).orderBy("doc_id").collect())
    both, others = got[: len(SIDE_BY_SIDE)], got[len(SIDE_BY_SIDE) :]
    assert alone != phone and re.sub(r"\d", "9", alone) == re.sub(r"\d", "9", phone)
    assert both == [f"{alone} {other}" for other in others]
    assert all(new != old for new, old in zip(others, SIDE_BY_SIDE.values(), strict=True))


def test_no_number_follows_a_phone(spark):
    listed = ["+1 (826) 555-4081", "+1 (826) 555-4081 190 people", "+44 20 7946 0958 1234 5678", "+44 20 7946 0958"]
    docs = spark.createDataFrame(list(enumerate(listed)), "doc_id long, text string")
    one, two, three, four = (r["text"] for r in pii.replace(docs).orderBy("doc_id").collect())
    assert two == f"{one} 190 people" and three == f"{four} 1234 5678"


def test_clashing_surrogates_are_drawn_again(spark):
    docs = spark.createDataFrame([(i, f"ssn {i:03d}-00-0000 and 10.0.{i}.1") for i in range(200)],
                                 "doc_id long, text string")
    original = pii._characters

    def narrow(form, drawn, first):
        return pii.F.concat(pii.F.substring(form, 1, 6), original(pii.F.substring(form, 7, 3), drawn, first))

    pii._characters = narrow  # 1000 numbers for 200 units: some clash
    try:
        assert pii.clashes(docs, "k").count() > 0
        texts = [r["text"] for r in pii.replace(docs, "k").collect()]
    finally:
        pii._characters = original
    assert len({t.split()[1] for t in texts}) == 200


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    frame = toxicity.keep_clean(docs, model)
    kept = {r["doc_id"] for r in minhash.near_duplicates(frame, 5, 80).where("kept").collect()}
    leaks = decontamination.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    expected = kept - {r["doc_id"] for r in leaks.collect()}
    found = by_id(corpus_pipeline.run(spark, sf_dir))
    assert found.keys() == expected
    texts = {r["doc_id"]: r["text"] for r in pii.replace(docs).collect()}
    same = sum(found[i]["decoded_sha256"] == hashlib.sha256(texts[i].encode()).hexdigest() for i in found)
    assert same == len(found)
