"""Quality rules: repetition and length counts, and the divergence of a text from its language.

Each text is reduced to histograms of character classes and of its language's common words. The references are
the summed histograms of all documents of a language. A text that is long enough is kept if its Jensen-Shannon
distances to the reference are small. All of it is SQL expressions: the counts are made in one pass and landed,
so the texts are read once for both the references and the verdicts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortscope.llm.shared import land, let

#: Very common words of each language.
COMMON_WORDS = {
    "de": ("der", "die", "und", "in", "den", "von", "zu", "das", "mit", "des", "nicht", "ein"),
    "en": ("the", "of", "and", "to", "in", "a", "is", "that", "it", "was", "for", "with"),
    "es": ("de", "la", "que", "el", "en", "y", "los", "del", "se", "las", "por", "un"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "dans"),
}
#: Character classes, each counted in what the earlier ones left; all other characters are the last class.
CLASSES = {
    "lower": "[a-z]+",
    "space": "[\\x20\\x09-\\x0D]+",
    "upper": "[A-Z]+",
    "symbol": "[#*$%&|<>]+",
    "digit": "[0-9]+",
    "punctuation": "[!-/:-@\\[-`{-~]+",
}
WINDOW = 5
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
#: Shorter texts are not compared with their language: their histograms say little.
MIN_COMPARED_WORDS = 100
MAX_CLASS_DISTANCE = 0.25
MAX_WORD_DISTANCE = 0.23


def words_of(text: Column) -> Column:
    """Runs of characters other than the space and \\t \\n \\v \\f \\r; none in a null text."""
    return F.coalesce(F.array_remove(F.split(text, "[\\x20\\x09-\\x0D]+"), ""), F.array().cast("array<string>"))


def repeated_words(words: Column) -> Column:
    """The number of words inside windows of five words that the text holds twice or more."""

    def windows(hashes: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(hashes) - WINDOW)
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)]))

    def covered(own: Column) -> Column:
        placed = F.array_sort(F.transform(own, lambda h, i: F.struct(h.alias("hash"), i.alias("at"))))
        return let(placed, lambda p: let(
            F.array_sort(F.transform(
                F.filter(p, lambda x, i: x["hash"].eqNullSafe(F.get(p, i - 1)["hash"])
                         | x["hash"].eqNullSafe(F.get(p, i + 1)["hash"])),
                lambda x: x["at"])),
            lambda at: F.aggregate(
                F.transform(at, lambda x, i: F.least(F.coalesce(F.get(at, i + 1) - x, F.lit(WINDOW)), F.lit(WINDOW))),
                F.lit(0), lambda total, x: total + x)))

    counted = let(F.transform(words, lambda word: F.xxhash64(word)), lambda hashes: let(
        windows(hashes),
        lambda own: F.when(F.size(F.array_distinct(own)) < F.size(own), covered(own)).otherwise(F.lit(0))))
    return F.when(F.size(words) >= WINDOW, counted).otherwise(F.lit(0)).cast("bigint")


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line of the text."""
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    return let(lines, lambda own: F.size(own) - F.size(F.array_distinct(own))).cast("bigint")


def _occurrences(vocabulary: tuple[str, ...]) -> Callable[[Column], Column]:
    def equal_to(word: str) -> Callable[[Column], Column]:
        return lambda other: other == word

    return lambda words: F.array(*[F.size(F.filter(words, equal_to(word))) for word in vocabulary])


def counts(docs: DataFrame) -> DataFrame:
    """One row a document: its base counts, and its histograms as arrays. A null text has no words and lines."""
    read = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("lang"),
                       F.coalesce("text", F.lit("")).alias("text"))
    frame = read.withColumn("words", words_of(F.col("text"))).withColumn("left_0", F.col("text"))
    for i, pattern in enumerate(CLASSES.values()):
        frame = frame.withColumn(f"left_{i + 1}", F.regexp_replace(f"left_{i}", pattern, ""))
    lengths = [F.length(f"left_{i}") for i in range(len(CLASSES) + 1)]
    classes = [a - b for a, b in zip(lengths, lengths[1:], strict=False)] + [lengths[-1]]
    common = F.filter("words", lambda w: w.isin(*sorted({x for own in COMMON_WORDS.values() for x in own})))
    own_words = F.lit(None).cast("array<int>")
    for lang, vocabulary in COMMON_WORDS.items():
        own_words = F.when(F.col("lang") == lang, let(common, _occurrences(vocabulary))).otherwise(own_words)
    symbol = list(CLASSES).index("symbol")
    return frame.select(
        "doc_id", "lang",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        classes[symbol].cast("bigint").alias("n_symbols"),
        duplicate_lines(F.col("text")).alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
        F.array(*[c.cast("bigint") for c in classes]).alias("classes"),
        F.coalesce(own_words, F.array().cast("array<int>")).cast("array<bigint>").alias("common"),
    )


def references(counted: DataFrame) -> DataFrame:
    """One row a language: the summed histograms of all its documents, the rest of the words last."""
    most = max(map(len, COMMON_WORDS.values()))
    sums = [F.sum(F.col("classes")[i]).alias(f"class_{i}") for i in range(len(CLASSES) + 1)]
    sums += [F.sum(F.get("common", F.lit(i))).alias(f"word_{i}") for i in range(most)]
    by_lang = counted.groupBy("lang").agg(F.sum("n_words").alias("all_words"), *sums)
    common = F.filter(F.array(*[F.col(f"word_{i}") for i in range(most)]), lambda n: n.isNotNull())
    return by_lang.select(
        "lang",
        F.array(*[F.col(f"class_{i}") for i in range(len(CLASSES) + 1)]).alias("lang_classes"),
        with_rest(common, F.col("all_words")).alias("lang_words"),
    )


def with_rest(common: Column, total: Column) -> Column:
    return F.concat(common, F.array(total - F.aggregate(common, F.lit(0).cast("bigint"), lambda a, x: a + x)))


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2, from 0 to 1) of two histograms; 0 if one of them is empty."""

    def total(x: Column) -> Column:
        return F.aggregate(x, F.lit(0).cast("bigint"), lambda a, n: a + n).cast("double")

    def part(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))

    def both(shares: Column) -> Column:
        a, b = shares[0], shares[1]
        return part(a, (a + b) / 2) + part(b, (a + b) / 2)

    divergence = let(F.struct(total(p).alias("p"), total(q).alias("q")), lambda n: F.aggregate(
        F.zip_with(p, q, lambda a, b: F.array(a / n["p"], b / n["q"])),
        F.lit(0.0), lambda sum_, shares: sum_ + both(shares)) / 2)
    return F.when((total(p) > 0) & (total(q) > 0), F.round(F.sqrt(F.greatest(divergence, F.lit(0.0))), 4)) \
        .otherwise(F.lit(0.0))


def verdicts(docs: DataFrame) -> DataFrame:
    """One row a document: base counts, distances to its language, base_failed and kept.

    Texts under 100 words keep the base verdict. A null language is one of its own; languages without a list of
    common words are compared by character classes only. Repeated rows count each.
    """
    counted = land(counts(docs), "quality_counts")
    compared = counted.join(land(references(counted), "quality_references"), "lang")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    near = (F.col("class_distance") <= MAX_CLASS_DISTANCE) & (F.col("word_distance") <= MAX_WORD_DISTANCE)
    return compared.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        distance(F.col("classes"), F.col("lang_classes")).alias("class_distance"),
        distance(with_rest(F.col("common"), F.col("n_words")), F.col("lang_words")).alias("word_distance"),
    ).withColumn("kept", ~F.col("base_failed") & ((F.col("n_words") < MIN_COMPARED_WORDS) | near))
