"""SQL counterparts of the queries that SQL can express; tests/llm compares the others with brute force."""

from __future__ import annotations

from cohortscope.llm import centroids, quality, ranked
from cohortscope.llm import decontamination as seeds

_WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"

_QUOTATIONS = """
WITH RECURSIVE one AS MATERIALIZED (
    SELECT conv_id, turn, role, text, turn - if(turn % 5 = 4, 2, 1) AS answered FROM conversations
), mails AS MATERIALIZED (
    SELECT m.conv_id, m.turn, m.role, m.text AS own,
           if(a.turn IS NULL, '', 'On turn ' || a.turn || ' ' || a.role || ' wrote:' || chr(10)
              || if(b.turn IS NULL, '', '> > ' || replace(b.text, chr(10), chr(10) || '> > ') || chr(10))
              || '> ' || replace(a.text, chr(10), chr(10) || '> ') || chr(10)) || m.text AS text
    FROM one AS m
    LEFT JOIN one AS a ON a.conv_id = m.conv_id AND a.turn = m.answered
    LEFT JOIN one AS b ON b.conv_id = a.conv_id AND b.turn = a.answered
), lines AS MATERIALIZED (
    SELECT DISTINCT conv_id, turn, length(regexp_replace(mark, '[^>]', '', 'g')) AS level,
           trim(regexp_replace(lower(substr(line, length(mark) + 1)), '\\s+', ' ', 'g')) AS words
    FROM (SELECT conv_id, turn, line, regexp_extract(line, '^(?:[ \\t]*>)+') AS mark
          FROM (SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line FROM mails)
          WHERE NOT regexp_matches(line, '^On .{1,200} wrote:$'))
    WHERE words <> ''
), sources AS MATERIALIZED (
    SELECT q.conv_id, q.turn, q.level, q.words, max(o.turn) AS source
    FROM lines AS q JOIN lines AS o
      ON o.conv_id = q.conv_id AND o.words = q.words AND o.level = 0 AND o.turn < q.turn
    WHERE q.level > 0 GROUP BY ALL
), parents AS MATERIALIZED (
    SELECT conv_id, turn, arg_max(source, (-level, votes, source)) AS parent
    FROM (SELECT conv_id, turn, level, source, count(*) AS votes FROM sources GROUP BY ALL) GROUP BY ALL
), walk AS (
    SELECT conv_id, turn, turn AS thread, 0 AS depth FROM one LEFT JOIN parents USING (conv_id, turn)
    WHERE parent IS NULL
    UNION ALL
    SELECT p.conv_id, p.turn, w.thread, w.depth + 1
    FROM walk AS w JOIN parents AS p ON p.conv_id = w.conv_id AND p.parent = w.turn
)
SELECT conv_id, turn, role, parent, thread, depth,
       row_number() OVER (PARTITION BY conv_id, thread ORDER BY depth, turn) - 1 AS reply_order,
       regexp_replace(own, '^\\s+|\\s+$', '', 'g') AS text
FROM mails JOIN walk USING (conv_id, turn) LEFT JOIN parents USING (conv_id, turn)
"""

_NEAR_DUPLICATES = f"""
WITH RECURSIVE words AS (
    SELECT doc_id, {_WORDS.replace("coalesce(text, '')", "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w
    FROM documents
), sets AS MATERIALIZED (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_distinct([array_to_string(w[i : i + 3], ' ') FOR i IN range(1, len(w) - 2)]) END AS shingles
    FROM words
), members AS MATERIALIZED (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets),
links AS MATERIALIZED (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM members AS a JOIN members AS b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM sets
    UNION
    SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
), roots AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN roots USING (doc_id)
"""


def _contaminated() -> str:
    tokens = "list_filter(string_split_regex(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')"

    def hits(table: str, key: str) -> str:
        picks = [[k for k, bit in enumerate(mask, 1) if bit == "1"] for mask in seeds.MASKS]
        parts = [
            f"SELECT {key}, t, i, {n} AS mask, " + " || ' ' || ".join(f"t[i + {k}]" for k in pick) + " AS seed "
            f"FROM (SELECT {key}, t, unnest(range(0, len(t) - {len(mask) - 1})) AS i FROM {table})"
            for n, (mask, pick) in enumerate(zip(seeds.MASKS, picks, strict=True))
        ]
        return "\nUNION ALL\n".join(parts)

    return f"""
WITH items AS MATERIALIZED (SELECT item_id, {tokens} AS t FROM benchmark),
texts AS MATERIALIZED (SELECT doc_id, {tokens} AS t FROM documents),
item_seeds AS MATERIALIZED ({hits('items', 'item_id')}),
hits AS MATERIALIZED (
    SELECT DISTINCT d.doc_id, s.item_id, d.i - s.i AS shift
    FROM ({hits('texts', 'doc_id')}) AS d JOIN item_seeds AS s ON s.mask = d.mask AND s.seed = d.seed
), aligned AS (
    SELECT doc_id, item_id, least(len(items.t), {seeds.OVERLAP}) AS length,
           [if(k + shift >= 1 AND texts.t[k + shift] = items.t[k], 1, 0) FOR k IN range(1, len(items.t) + 1)] AS equal
    FROM hits JOIN items USING (item_id) JOIN texts USING (doc_id)
), best AS (
    SELECT doc_id, item_id,
           max(100 * list_max([list_sum(equal[k : k + length - 1]) FOR k IN range(1, len(equal) - length + 2)])
               // length) AS percent
    FROM aligned GROUP BY ALL
)
SELECT doc_id, count(*) AS n_items, min(item_id) AS first_item, CAST(max(percent) AS INTEGER) AS equal_percent
FROM best WHERE percent >= {seeds.MIN_EQUAL_PERCENT} GROUP BY doc_id
"""


def _divergence() -> str:
    def strings(values) -> str:
        return "[" + ", ".join(f"'{v}'" for v in values) + "]"

    lists = "map {" + ", ".join(f"'{lang}': {strings(words)}" for lang, words in quality.COMMON_WORDS.items()) + "}"
    shrunk, left = [], "coalesce(text, '')"
    for name, pattern in quality.CLASSES.items():
        shrunk.append((name, left, f"regexp_replace({left}, '{pattern}', '', 'g')"))
        left = shrunk[-1][2]
    classes = ", ".join([f"length({a}) - length({b})" for _, a, b in shrunk] + [f"length({left})"])

    def distance(p: str, q: str) -> str:
        share = "if({x} > 0, {x} * log2({x} / (({a} + {b}) / 2)), 0)"
        a, b = f"({p}[k] / list_sum({p}))", f"({q}[k] / list_sum({q}))"
        both = share.format(x=a, a=a, b=b) + " + " + share.format(x=b, a=a, b=b)
        return (f"if(list_sum({p}) > 0 AND list_sum({q}) > 0, round(sqrt(greatest(0, "
                f"list_sum([{both} FOR k IN range(1, len({p}) + 1)]) / 2)), 4), 0)")

    return f"""
WITH texts AS MATERIALIZED (
    SELECT doc_id, coalesce(lang, '') AS lang, {_WORDS} AS w, coalesce(text, '') AS text,
           [{classes}] AS classes
    FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(w[i + 1 : i + 5], ' ') AS window5
    FROM (SELECT doc_id, w, unnest(range(0, len(w) - 4)) AS i FROM texts)
), covered AS (
    SELECT doc_id, count(DISTINCT i + k) AS n FROM
        (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, window5) AS times FROM windows), range(0, 5) AS r(k)
    WHERE times > 1 GROUP BY doc_id
), lines AS (
    SELECT doc_id, count(*) - count(DISTINCT line) AS n
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM texts)
    WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id
), counted AS MATERIALIZED (
    SELECT doc_id, lang, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
           coalesce(lines.n, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words, classes,
           [len(list_filter(w, lambda x: x = c)) FOR c IN coalesce({lists}[lang], [])] AS common
    FROM texts LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)
), class_sums AS (
    SELECT lang, list(n ORDER BY k) AS lang_classes FROM (
        SELECT lang, k, sum(classes[k + 1]) AS n FROM counted, range(0, {len(quality.CLASSES) + 1}) AS r(k)
        GROUP BY ALL) GROUP BY lang
), word_sums AS (
    SELECT lang, list(n ORDER BY k) AS lang_words FROM (
        SELECT lang, k, sum(if(k < len(common), common[k + 1], n_words - coalesce(list_sum(common), 0))) AS n
        FROM counted, range(0, 100) AS r(k) WHERE k <= len(common) GROUP BY ALL) GROUP BY lang
), compared AS (
    SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEATED_PERCENT} * n_words
               AS base_failed,
           {distance('classes', 'lang_classes')} AS class_distance,
           {distance('own_words', 'lang_words')} AS word_distance
    FROM (SELECT *, list_append(common, n_words - coalesce(list_sum(common), 0)) AS own_words FROM counted)
    JOIN class_sums USING (lang) JOIN word_sums USING (lang)
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       CAST(class_distance AS DOUBLE) AS class_distance, CAST(word_distance AS DOUBLE) AS word_distance,
       NOT base_failed AND (n_words < {quality.MIN_COMPARED_WORDS}
           OR (class_distance <= {quality.MAX_CLASS_DISTANCE} AND word_distance <= {quality.MAX_WORD_DISTANCE})) AS kept
FROM compared
"""


_TERMS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          "'[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')")

_RANKED = f"""
WITH texts AS MATERIALIZED (SELECT doc_id, t, CAST(len(t) AS BIGINT) AS n FROM (
    SELECT doc_id, {_TERMS} AS t FROM documents) WHERE len(t) > 0
), corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM texts),
counted AS MATERIALIZED (
    SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(t) AS term FROM texts) GROUP BY ALL
), weights AS MATERIALIZED (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
    FROM (SELECT term, count(*) AS df FROM counted GROUP BY term), corpus
), asked AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
scored AS (
    SELECT item_id, doc_id,
           CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // terms)))) AS BIGINT) AS score
    FROM asked JOIN weights USING (term) JOIN counted USING (term), corpus GROUP BY ALL
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
    FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {ranked.TOP}
"""


def _centroids() -> str:
    distance = "CAST(list_sum([(v[d] - c[d]) * (v[d] - c[d]) FOR d IN range(1, len(v) + 1)]) AS BIGINT)"
    parts = [f"""
WITH kept AS MATERIALIZED (
    SELECT vec_id, [CAST(floor({centroids.SCALE} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
    FROM embeddings
    WHERE len(list_filter(embedding, lambda x: isfinite(x))) = {centroids.DIMENSIONS}
      AND len(embedding) = {centroids.DIMENSIONS}
), c0 AS MATERIALIZED (
    SELECT CAST(row_number() OVER (ORDER BY h) - 1 AS INTEGER) AS cluster, v AS c FROM (
        SELECT v, sha256('{centroids.SEED}:' || vec_id) AS h FROM kept ORDER BY h LIMIT {centroids.CLUSTERS})
)"""]
    for turn in range(centroids.ROUNDS + 1):
        parts.append(f"""a{turn} AS MATERIALIZED (
    SELECT vec_id, any_value(v) AS v, min(struct_pack(distance := {distance}, cluster := cluster)) AS best
    FROM kept, c{turn} GROUP BY vec_id
)""")
        if turn < centroids.ROUNDS:
            parts.append(f"""c{turn + 1} AS MATERIALIZED (
    SELECT cluster, coalesce(mean, c) AS c FROM c{turn} LEFT JOIN (
        SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY d) AS mean FROM (
            SELECT best.cluster AS cluster, d, count(*) AS n, CAST(sum(v[d]) AS BIGINT) AS s
            FROM a{turn}, range(1, {centroids.DIMENSIONS + 1}) AS r(d) GROUP BY ALL) GROUP BY cluster
    ) USING (cluster)
)""")
    last = centroids.ROUNDS
    return ", ".join(parts) + f"""
SELECT vec_id, best.cluster AS cluster, best.distance AS distance,
       CAST(sum(best.distance) OVER (PARTITION BY best.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(best.distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{last} JOIN c{last} ON c{last}.cluster = best.cluster
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_quotations": _QUOTATIONS,
        "op3_minhash": _NEAR_DUPLICATES,
        "op5_decontamination": _contaminated(),
        "op6_divergence": _divergence(),
        "op12_ranked_search": _RANKED,
        "op13_centroids": _centroids(),
    }
