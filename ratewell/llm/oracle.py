"""DuckDB SQL of the queries that it can express over whole tables."""

from __future__ import annotations

from ratewell.llm import licenses

_GRAMS = ", ".join(
    f"('{text}', '{label}', {exact}, {len(words) - 1}, {place}, '{one} {two}')"
    for exact, group in (("true", licenses.PHRASES), ("false", licenses.TEMPLATES))
    for text, label in group.items()
    for words in [text.split()]
    for place, (one, two) in enumerate(zip(words, words[1:]))
)

LICENSES = rf"""
WITH grams(template, label, exact, grams, place, gram) AS (VALUES {_GRAMS}),
rows AS (SELECT row_number() OVER () AS row, doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words FROM documents),
places AS (SELECT row, words, unnest(range(0, len(words) - 1)) AS pos FROM rows WHERE len(words) > 1),
hits AS (SELECT row, template, label, exact, grams, pos, pos - place AS diagonal
  FROM places JOIN grams ON gram = words[pos + 1] || ' ' || words[pos + 2]),
diagonals AS (SELECT row, template, label, exact, grams, diagonal, count(DISTINCT pos) AS votes,
    min(pos) AS low, max(pos) AS high FROM hits GROUP BY ALL),
gaps AS (SELECT *, diagonal - lag(diagonal) OVER (PARTITION BY row, template ORDER BY diagonal) AS gap FROM diagonals),
numbered AS (SELECT *, sum(CASE WHEN exact OR gap IS NULL OR gap > {licenses.NEIGHBOURS} THEN 1 ELSE 0 END)
    OVER (PARTITION BY row, template ORDER BY diagonal) AS passage FROM gaps),
passages AS (SELECT row, template, label, exact, grams, passage, sum(votes) AS votes, min(low) AS low,
    max(high) AS high, min(diagonal) AS start,
    max(CASE WHEN high - low + 1 <= ceil(grams * {licenses.STRETCH}) THEN votes ELSE 0 END) AS alone
  FROM numbered GROUP BY ALL),
judged AS (SELECT *, exact AND votes = grams AS base, CASE WHEN exact THEN 0.0 ELSE least(1.0, greatest(alone,
    CASE WHEN high - low + 1 <= ceil(grams * {licenses.STRETCH}) THEN votes ELSE 0 END) / grams) END AS share FROM passages),
found AS (SELECT row, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word,
    max(start) FILTER (base) AS last_word,
    array_to_string(list_sort(list(DISTINCT label) FILTER (base)), ',') AS base_labels,
    array_to_string(list_sort(list(DISTINCT label) FILTER (base OR share >= {licenses.COVERAGE})), ',') AS labels,
    max(CASE WHEN base THEN 1.0 ELSE share END) AS score FROM judged GROUP BY row)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
  last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  coalesce(score, 0.0)::DOUBLE AS score
FROM rows LEFT JOIN found USING (row)
"""

#: A text's distinct word 5-grams; fewer words make one gram. A pair counts if it shares one at least.
_LINKS = r"""
WITH RECURSIVE words AS (SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words FROM documents),
sets AS (SELECT doc_id, list_distinct(CASE WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS grams
  FROM words WHERE len(words) > 0),
distinct_sets AS (SELECT min(doc_id) AS copy_id, count(*) AS copies, list_sort(grams) AS grams FROM sets GROUP BY list_sort(grams)),
copies AS (SELECT doc_id, copy_id, copies FROM sets JOIN distinct_sets d ON list_sort(sets.grams) = d.grams),
flat AS (SELECT copy_id, len(grams) AS size, unnest(grams) AS gram FROM distinct_sets),
pairs AS (SELECT a.copy_id AS a, b.copy_id AS b FROM flat a JOIN flat b ON a.gram = b.gram AND a.copy_id <> b.copy_id
    AND least(a.size, b.size) >= 0.8 * greatest(a.size, b.size)
  GROUP BY a.copy_id, b.copy_id, a.size, b.size HAVING count(*) >= 0.8 * (a.size + b.size - count(*)) - 1e-9),
reach(a, b) AS (SELECT a, b FROM pairs UNION SELECT reach.a, pairs.b FROM reach JOIN pairs ON reach.b = pairs.a),
classes AS (SELECT a, min(b) AS low FROM reach GROUP BY a),
links AS (SELECT a, sum(copies) AS n FROM pairs JOIN distinct_sets ON b = copy_id GROUP BY a)
"""

NGRAM_JOIN = (
    _LINKS
    + """
SELECT documents.doc_id, coalesce(least(copy_id, low), documents.doc_id)::BIGINT AS class_id,
  coalesce(copy_id, documents.doc_id)::BIGINT AS copy_id,
  (coalesce(copies - 1, 0) + coalesce(links.n, 0))::BIGINT AS n_links
FROM documents LEFT JOIN copies ON documents.doc_id = copies.doc_id LEFT JOIN classes ON classes.a = copy_id
LEFT JOIN links ON links.a = copy_id
"""
)

# The crc32 of an id's digits, a bit at a time: bytes are taken in, and -1 stands for a shift.
_CRC32 = """xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(conv_id::VARCHAR, ''),
    lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), lambda crc, b: CASE WHEN b >= 0 THEN xor(crc, b)
    WHEN crc % 2 = 1 THEN xor(crc // 2, 3988292384) ELSE crc // 2 END), 4294967295)"""

PREFIX_TRIE = f"""
WITH keyed AS (SELECT conv_id, turn, length(coalesce(text, '')) AS chars,
    md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS key
  FROM conversations WHERE conv_id IS NOT NULL),
turns AS (SELECT conv_id, key, chars, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, key) AS place
  FROM keyed),
convs AS (SELECT conv_id, conv_id - conv_id % 100 AS base, {_CRC32} % 6 AS head FROM (SELECT DISTINCT conv_id FROM turns)),
rebuilt AS (
  SELECT c.conv_id, 0 AS part, t.place, key, chars FROM convs c JOIN turns t ON t.conv_id = c.base AND t.place <= head
  UNION ALL
  SELECT c.conv_id, 1, t.place, key, chars FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.place > head),
prefixes AS (SELECT conv_id, chars, count(*) OVER w AS depth, string_agg(key, ',') OVER w AS prefix FROM rebuilt
  WINDOW w AS (PARTITION BY conv_id ORDER BY part, place ROWS UNBOUNDED PRECEDING)),
lengths AS (SELECT c.conv_id, count(key) AS n FROM convs c LEFT JOIN rebuilt r ON r.conv_id = c.conv_id GROUP BY 1),
members AS (SELECT conv_id, depth, md5(prefix) AS node, chars FROM prefixes
  UNION ALL SELECT conv_id, 0, '', 0 FROM convs),
up AS (SELECT a.node, any_value(b.node) AS parent FROM members a JOIN members b ON b.conv_id = a.conv_id AND b.depth = a.depth - 1
  GROUP BY 1),
nodes AS (SELECT node, depth, min(m.conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
    coalesce(string_agg(m.conv_id::VARCHAR, ',' ORDER BY m.conv_id) FILTER (n = depth), '') AS ends
  FROM members m JOIN lengths l ON l.conv_id = m.conv_id GROUP BY 1, 2),
children AS (SELECT parent AS node, count(*) AS n FROM up GROUP BY 1),
pairs AS (SELECT DISTINCT a.node AS above, b.node AS below FROM members a JOIN members b ON a.conv_id = b.conv_id
  AND a.depth <= b.depth),
sums AS (SELECT above AS node, sum((n.n_convs - 1) * n.chars) AS saved, count(*) FILTER (c.n IS NULL) AS leaves
  FROM pairs JOIN nodes n ON n.node = below LEFT JOIN children c ON c.node = below GROUP BY 1)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
  coalesce(c.n, 0)::BIGINT AS n_children, s.leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens,
  sha256(n.ends) AS ends_sha256
FROM nodes n JOIN sums s ON s.node = n.node LEFT JOIN children c ON c.node = n.node
LEFT JOIN up u ON u.node = n.node LEFT JOIN nodes p ON p.node = u.parent
"""

ORACLE: dict[str, str] = {"op2_licenses": LICENSES, "op5_ngram_join": NGRAM_JOIN, "op13_prefix_trie": PREFIX_TRIE}
