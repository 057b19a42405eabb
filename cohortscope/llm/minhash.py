"""MinHash near-dedup by an inverted join on signature coordinates.

A document is the set of its word shingles; equal sets form a class, and one member stands for it. A signature
holds one minimum for each of COORDINATES hash functions, and a class is posted under every (coordinate, minimum)
pair. Two sets of similarity 0.8 agree in fewer than MIN_MATCHES of 64 coordinates with a probability below 1e-6,
so that is the match threshold. Posts that nobody else shares are dropped, the rest are sorted by rarity, and a
class skips its MIN_MATCHES - 1 most common posts: two classes above the threshold still meet under a rarer one.

Within a list the classes are first linked to one leader, so a list of near copies costs one pair a class. What is
not connected then is compared in blocks: the list's classes go to tasks in blocks of bounded size, with their
signatures, where collisions are counted. Classes with a partner above the threshold go on with their sets to be
confirmed there, and only the links that connect something new leave the task. So a list makes as many rows as it has classes, times its blocks, and never a
row for each pair. No pair is made of classes that, by what each shares with any other, cannot be similar enough.
Every link is confirmed on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortscope.llm.shared import broadcast_if_small, components, land, releasing, small_batches
from cohortscope.llm.text import Block, blocks, constants, mix, span_hashes, words

COORDINATES = 64
MIN_MATCHES = 32
#: Partners that follow one copy of a set; classes and bytes of sets in a block of a list; rows compared at once.
STREAM, BLOCK, BLOCK_BYTES, _STRIP = 4096, 2048, 8 << 20, 256
#: Bytes of texts that are worked on at once; what is derived from them takes some sixty times as much.
_TEXT_BYTES = 1 << 18
_MULTIPLIERS = constants(COORDINATES, 11)
_POSTS = constants(COORDINATES, 13)
_SEED = np.uint64(0x5851F42D4C957F2D)


def shingles(block: Block, size: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of `size` words, A-Z lower-cased.

    A text with fewer words has its whole sequence as the only shingle; one without words has none.
    """
    starts, ends, before = words(block)
    hashes = span_hashes(block.prefix_sums(lower=True), starts, ends)
    factors = constants(size, 17)
    runs = np.zeros(max(0, len(hashes) - size + 1), dtype=np.uint64)
    for k in range(size):
        runs += hashes[k : k + len(runs)] * factors[k]
    runs = mix(runs)
    result = []
    for a, b in zip(before[:-1].tolist(), before[1:].tolist(), strict=True):
        if b - a >= size:
            result.append(np.unique(runs[a : b - size + 1]))
        elif b > a:
            whole = (hashes[a:b] * constants(b - a, 19)).sum(dtype=np.uint64, keepdims=True)
            result.append(mix(whole ^ np.uint64(b - a)))
        else:
            result.append(np.zeros(0, dtype=np.uint64))
    return result


def _signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row a set: for each coordinate the post of its minimum, a hash of coordinate and value."""
    members, firsts = np.concatenate(sets), np.cumsum([0, *map(len, sets[:-1])])
    result = np.empty((len(sets), COORDINATES), dtype=np.uint64)
    for k in range(COORDINATES):
        result[:, k] = np.minimum.reduceat(members * _MULTIPLIERS[k], firsts)
    return mix(result ^ _POSTS).view(np.int64)


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """One row a document: n_shingles, a 128-bit fingerprint of its set (key_1, key_2) and its posts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text"), _TEXT_BYTES):
                sets = shingles(block, size)
                counts = np.array([len(s) for s in sets], dtype=np.int64)
                keys = _keys(sets)
                some = [s for s in sets if len(s)]
                posts = _signatures(some) if some else np.zeros((0, COORDINATES), np.int64)
                offsets = np.concatenate([[0], np.cumsum((counts > 0) * COORDINATES)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(posts.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(block.first, len(block)), pa.array(counts),
                     pa.array(keys[:, 0].copy()), pa.array(keys[:, 1].copy()), lists],
                    ["doc_id", "n_shingles", "key_1", "key_2", "posts"])

    schema = "doc_id bigint, n_shingles bigint, key_1 bigint, key_2 bigint, posts array<bigint>"
    return docs.select("doc_id", "text").mapInArrow(releasing(run), schema)


def _keys(sets: list[np.ndarray]) -> np.ndarray:
    """A 128-bit fingerprint of each set, as two numbers."""
    keys = [(s.sum(dtype=np.uint64), mix(s ^ _SEED).sum(dtype=np.uint64)) for s in sets]
    return np.array(keys, dtype=np.uint64).reshape(-1, 2).view(np.int64)


def full_sets(docs: DataFrame, size: int) -> DataFrame:
    """The whole shingle set of each document as sorted 64-bit hashes in a binary column, and its fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text"), _TEXT_BYTES):
                sets = shingles(block, size)
                keys = _keys(sets)
                packed = pa.array([s.tobytes() for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(block.first, len(block)), pa.array(keys[:, 0].copy()),
                     pa.array(keys[:, 1].copy()), packed], ["doc_id", "key_1", "key_2", "members"])

    return docs.select("doc_id", "text").mapInArrow(releasing(run), "doc_id bigint, key_1 bigint, key_2 bigint, members binary")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets share at least `percent` of their union.

    A set of the column a is sent once for all its pairs, or once for every STREAM of them where it has more; the
    sets of its partners follow it one by one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader, one = None, np.zeros(0, np.uint64)
        for batch in batches:
            found = []
            columns = [batch.column(c).to_pylist() for c in ("a", "part", "is_b", "class_id")]
            for place, (a, part, is_b, b) in enumerate(zip(*columns, strict=True)):
                members = np.frombuffer(batch.column("members")[place].as_buffer(), np.uint64)
                if not is_b:
                    leader, one = (a, part), members.copy()
                    continue
                assert leader == (a, part)  # sorted by a, part and is_b
                shared = len(np.intersect1d(one, members, assume_unique=True))
                if 100 * shared >= percent * (len(one) + len(members) - shared):
                    found.append((a, b))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    large = land(pairs.groupBy("a").agg(F.ceil(F.count("*") / STREAM).alias("parts")).where("parts > 1"), "large_leaders")
    parts = F.coalesce("parts", F.lit(1))
    placed = land(pairs.join(broadcast_if_small(large), "a", "left").select(
        "a", "b", F.pmod(F.xxhash64("b"), parts).alias("part")), "placed_pairs")
    of_a = placed.select("a", "part").distinct().join(sets.withColumnRenamed("class_id", "a"), "a").select(
        "a", "part", F.lit(0).alias("is_b"), F.col("a").alias("class_id"), "members")
    of_b = placed.join(sets.withColumnRenamed("class_id", "b"), "b").select(
        "a", "part", F.lit(1).alias("is_b"), F.col("b").alias("class_id"), "members")
    order = ["a", "part", "is_b"]
    return of_a.unionByName(of_b).repartition("a", "part").sortWithinPartitions(*order).mapInArrow(releasing(run), "a bigint, b bigint")


def _prefixes(posts: DataFrame) -> DataFrame:
    """The posts that can lead to a pair: shared ones, without each class's most common MIN_MATCHES - 1.

    `central` is high for classes whose posts many others hold, as the original of a group of copies.
    """
    shared = land(posts.groupBy("post").agg(F.count("*").alias("holders")).where("holders > 1"), "shared_posts")
    own = Window.partitionBy("class_id")  # at most COORDINATES rows
    ranked = posts.join(shared, "post").select(
        "post", "class_id", "n_shingles",
        F.row_number().over(own.orderBy("holders", "post")).alias("place"),
        F.count("*").over(own).alias("own"), F.sum(F.log("holders")).over(own).alias("central"),
    )
    return land(ranked.where(F.col("place") <= F.col("own") - MIN_MATCHES + 1).drop("place", "own"), "prefix_posts")


def _shared_sizes(sets: DataFrame) -> DataFrame:
    """For each class how many of its shingles no other class has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for class_id, packed in zip(batch.column("class_id").to_pylist(), batch.column("members"), strict=True):
                members = np.frombuffer(packed.as_buffer(), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(members), class_id)), pa.array(members)], ["class_id", "shingle"])

    rows = sets.mapInArrow(releasing(run), "class_id bigint, shingle bigint")
    held = rows.groupBy("shingle").agg(F.count("*").alias("holders"), F.min("class_id").alias("class_id"))
    return held.where("holders = 1").groupBy("class_id").agg(F.count("*").alias("n_private"))


def _can_link(x: str, y: str, percent: int):
    """Whether two classes can be similar enough if they have all the shingles in common that each shares with any."""
    n = F.col(f"{x}.n_shingles") + F.col(f"{y}.n_shingles")
    return (100 + percent) * F.least(F.col(f"{x}.n_shared"), F.col(f"{y}.n_shared")) >= percent * n


def _matching(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """The pairs whose signatures agree in at least MIN_MATCHES coordinates."""
    sides = [members.select(F.col("class_id").alias(x), F.col("posts").alias(f"posts_{x}")) for x in "ab"]
    both = pairs.join(sides[1], "b").join(sides[0], "a")
    return both.where(F.size(F.array_intersect("posts_a", "posts_b")) >= MIN_MATCHES).select("a", "b")


def _to_leaders(lists: DataFrame, percent: int, by: str) -> DataFrame:
    """A pair of one class (a) of each list, the one that is highest in the column `by`, and each other (b)."""
    highest = F.max(F.struct(F.col(by).alias("rank"), "class_id", "n_shingles", "n_shared")).alias("leader")
    leaders = land(lists.groupBy("post").agg(highest).select("post", "leader.class_id", "leader.n_shingles", "leader.n_shared"), "leaders")
    pairs = lists.alias("x").join(leaders.alias("y"), "post").where(F.col("x.class_id") != F.col("y.class_id"))
    return pairs.where(_can_link("x", "y", percent)).select(
        F.col("y.class_id").alias("a"), F.col("x.class_id").alias("b")).distinct()


def _compact(sets: list[np.ndarray]) -> tuple[list[np.ndarray], int]:
    """The sets with their members numbered from 0, without members that only one of the sets has, and how many
    numbers there are."""
    sizes = [len(s) for s in sets]
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    several = times > 1
    keep = several[column]
    numbers = (np.cumsum(several) - 1)[column[keep]]
    bounds = np.searchsorted(owner[keep], np.arange(len(sets) + 1))
    return [numbers[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)], int(several.sum())


def _shared_counts(x: list[np.ndarray], y: list[np.ndarray], n: int) -> np.ndarray:
    """How many members each set of `x` has in common with each of `y`, whose members are numbers below `n`: products
    of 0/1 columns, some at a time."""
    width = max(1, min(n, (1 << 22) // (len(x) + len(y))))
    flat = [(np.repeat(np.arange(len(sets)), [len(s) for s in sets]), np.concatenate(sets)) for sets in (x, y)]
    result = np.zeros((len(x), len(y)), dtype=np.float32)
    for first in range(0, n, width):
        slabs = []
        for sets, (owner, column) in zip((x, y), flat, strict=True):
            slab = np.zeros((len(sets), width), dtype=np.float32)
            here = (column >= first) & (column < first + width)
            slab[owner[here], column[here] - first] = 1
            slabs.append(slab)
        result += slabs[0] @ slabs[1].T
    return result.astype(np.int64)


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each key, of batches that are sorted by `keys`; no more than one key's rows are held back."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([*held, batch]).combine_chunks()
        new = np.zeros(table.num_rows, dtype=bool)
        for key in keys:
            values = table.column(key).to_numpy()
            new[1:] |= values[1:] != values[:-1]
        firsts = np.concatenate([[0], np.flatnonzero(new)]).tolist()
        for a, b in zip(firsts, firsts[1:], strict=False):
            yield table.slice(a, b - a)
        held = table.slice(firsts[-1]).to_batches()
    if held:
        yield pa.Table.from_batches(held)


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def _sides(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The places of the rows on either side of a meeting; a block that meets itself is on both."""
    second = _column(table, "second")
    one = np.flatnonzero(~second)
    within = table.column("i")[0] == table.column("j")[0] and not table.column("with_main")[0].as_py()
    return one, one if within else np.flatnonzero(second)


def _colliding(table: pa.Table) -> np.ndarray:
    """The places of the rows that collide in MIN_MATCHES coordinates or more with a row of the other side that has
    another root."""
    root = _column(table, "root")
    result = np.zeros(len(root), dtype=bool)
    if (root == root[0]).all():
        return np.flatnonzero(result)
    posts = table.column("posts").combine_chunks().flatten().to_numpy().reshape(-1, COORDINATES)
    x, y = _sides(table)
    for first in range(0, len(x), _STRIP):
        strip = x[first : first + _STRIP]
        collisions = np.zeros((len(strip), len(y)), dtype=np.int16)
        for k in range(COORDINATES):
            collisions += posts[strip, k, None] == posts[y, k][None]
        above = (collisions >= MIN_MATCHES) & (root[strip, None] != root[y][None])
        result[strip[above.any(axis=1)]] = True
        result[y[above.any(axis=0)]] = True
    return np.flatnonzero(result)


def _links(percent: int, table: pa.Table) -> list[tuple[int, int]]:
    """Links of the two sides that connect different roots, without those that others imply."""
    sets = [np.frombuffer(m.as_buffer(), np.uint64) for m in table.column("members").combine_chunks()]
    root, n, ids = (_column(table, c) for c in ("root", "n_shingles", "class_id"))
    sets, n_members = _compact(sets)
    x, y = _sides(table)
    parent: dict[int, int] = {}

    def top(node: int) -> int:
        while parent.get(node, node) != node:
            parent[node] = node = parent.get(parent[node], parent[node])
        return node

    found = []
    for first in range(0, len(x), _STRIP):
        strip = x[first : first + _STRIP]
        shared = _shared_counts([sets[i] for i in strip], [sets[j] for j in y], n_members)
        both = n[strip][:, None] + n[y][None]
        linked = (root[strip, None] != root[y][None]) & (100 * shared >= percent * (both - shared))
        for i, j in zip(*np.nonzero(linked), strict=True):
            a, b = top(int(root[strip[i]])), top(int(root[y[j]]))
            if a != b:
                parent[a] = b
                found.append((int(ids[strip[i]]), int(ids[y[j]])))
    return found


def _across(lists: DataFrame, roots: DataFrame, members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links within lists between classes that are not connected yet.

    Lists of one component are done. In the others, the classes outside the list's largest component, and those in
    it, are dealt to blocks of about BLOCK classes and BLOCK_BYTES; every block of the former meets every block of both.
    """
    placed = land(lists.join(roots.withColumnRenamed("node", "class_id"), "class_id", "left").select(
        "post", "class_id", "n_shingles", F.coalesce("root", "class_id").alias("root")), "placed_posts")
    sizes = placed.groupBy("post", "root").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("entries"))

    def blocks_of(n, entries):
        return F.greatest(F.ceil(n / BLOCK), F.ceil(8 * entries / BLOCK_BYTES)).cast("int")

    largest = F.max(F.struct("n", "entries", "root")).alias("main")
    others = [F.sum(c).alias(f"all_{c}") for c in ("n", "entries")]
    open_lists = land(sizes.groupBy("post").agg(largest, F.count("*").alias("parts"), *others).where("parts > 1").select(
        "post", F.col("main.root").alias("main"), blocks_of(F.col("main.n"), F.col("main.entries")).alias("main_blocks"),
        blocks_of(F.col("all_n") - F.col("main.n"), F.col("all_entries") - F.col("main.entries")).alias("other_blocks"),
    ), "open_lists")
    in_main = F.col("root") == F.col("main")
    block = F.pmod(F.xxhash64("class_id"), F.when(in_main, F.col("main_blocks")).otherwise(F.col("other_blocks"))).cast("int")
    there = placed.join(open_lists, "post").withColumns({"in_main": in_main, "block": block})
    each = F.sequence(F.lit(0), F.col("other_blocks") - 1)

    def meeting(i, j, main):
        return F.struct(i.alias("i"), j.alias("j"), F.lit(main).alias("with_main"))

    own = F.col("block")
    meetings = F.when(F.col("in_main"), F.transform(each, lambda i: meeting(i, own, True))).otherwise(F.concat(
        F.transform(each, lambda i: meeting(F.least(i, own), F.greatest(i, own), False)),
        F.transform(F.sequence(F.lit(0), F.col("main_blocks") - 1), lambda j: meeting(own, j, True))))
    dealt = there.select("post", "class_id", "root", "n_shingles", "in_main", "block", F.inline(meetings))
    # Which side of its meeting a class is on: the block j, unless i and j are the same block.
    second = F.when(F.col("with_main"), F.col("in_main")).otherwise((F.col("block") == F.col("j")) & (F.col("i") != F.col("j")))
    meeting_keys = ["post", "i", "j", "with_main"]
    columns = [*meeting_keys, "second", "class_id", "root", "n_shingles"]
    schema = "post bigint, i int, j int, with_main boolean, second boolean, class_id bigint, root bigint, n_shingles bigint"

    def colliding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, meeting_keys):
            places = _colliding(table)
            if len(places):
                yield from table.select(columns).take(places).to_batches()

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, meeting_keys):
            found = _links(percent, table)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    def met(rows: DataFrame) -> DataFrame:
        return rows.repartition(*meeting_keys).sortWithinPartitions(*meeting_keys)

    signed = met(dealt.withColumn("second", second).join(members.select("class_id", "posts"), "class_id").select(*columns, "posts"))
    left = land(signed.mapInArrow(releasing(colliding), schema), "colliding")
    return met(left.join(sets, "class_id").select(*columns, "members")).mapInArrow(releasing(linked), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id (the smallest doc_id reachable over links) and kept.

    Documents are linked if their shingle sets share at least `percent` of their union. Texts that are null or
    have no words are linked with nothing. Rows with the same doc_id each count; a null doc_id is its own component.
    """
    small_batches(docs)
    signed = land(signatures(docs, size), "signatures")
    some = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    keys = ["key_1", "key_2"]
    # Classes have numbers of their own: a doc_id may stand for several texts.
    classes = land(some.groupBy(*keys).agg(F.min("doc_id").alias("doc_id")).withColumn(
        "class_id", F.monotonically_increasing_id()), "classes")
    own = [*keys, "doc_id"]
    members = some.join(classes, own).select("class_id", "n_shingles", "posts")
    prefixes = _prefixes(members.select("class_id", "n_shingles", F.explode("posts").alias("post")))

    ids = broadcast_if_small(land(prefixes.select("class_id").distinct(), "candidates"))
    members = land(members.join(ids, "class_id", "left_semi").dropDuplicates(["class_id"]), "members")
    named = land(classes.join(ids, "class_id", "left_semi"), "candidate_classes")
    texts = docs.select("doc_id", "text").join(
        broadcast_if_small(named.select("doc_id").distinct()), "doc_id", "left_semi")
    sets = land(full_sets(texts, size).join(named, own).select("class_id", "members").dropDuplicates(["class_id"]),
                "shingle_sets")

    # A class with too many shingles of its own is linked with nothing.
    n_shared = F.col("n_shingles") - F.coalesce("n_private", F.lit(0))
    lists = land(prefixes.join(land(_shared_sizes(sets), "private_shingles"), "class_id", "left").withColumn(
        "n_shared", n_shared).drop("n_private").where(100 * F.col("n_shared") >= percent * F.col("n_shingles")),
        "lists")
    links, tested = None, None
    for by in ("central", "class_id"):
        pairs = _to_leaders(lists, percent, by)
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        tested = land(pairs, "candidate_pairs")
        found = _confirmed(land(_matching(tested, members), "matching_pairs"), sets, percent)
        links = land(found if links is None else links.union(found), "links")
    roots = components(links, "near_duplicates")
    found = land(_across(lists, roots, members, sets, percent), "further_links")
    if not found.isEmpty():
        roots = components(links.union(found), "near_duplicates")
    of_class = classes.join(roots.withColumnRenamed("node", "class_id"), "class_id", "left").withColumn(
        "root", F.coalesce("root", "class_id"))
    smallest = of_class.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    component = land(of_class.join(smallest, "root").select(*keys, "component_id"), "components_of_classes")
    return signed.join(component, keys, "left").select(
        "doc_id", "n_shingles", F.coalesce(F.when(F.col("doc_id").isNotNull(), F.col("component_id")), "doc_id").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_first(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The documents, with all their columns, less those that a smaller doc_id of their component stands for."""
    dropped = land(near_duplicates(docs, size, percent).where("NOT kept").select("doc_id").distinct(), "dropped")
    return docs.join(broadcast_if_small(dropped), "doc_id", "left_anti")
