"""The results of the operators that SQL can express, in plain SQL over the same tables."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lowered(text: str) -> str:
    return f"translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}')"


_ITEM_WORDS = r"regexp_extract_all(%s, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

# Every window of every item is looked for at every position of every document.
_WINNOWING = f"""
WITH items AS (SELECT DISTINCT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, {_ITEM_WORDS % _lowered('text')} AS w FROM benchmark),
docs AS (SELECT doc_id, row_number() OVER () AS row_no, {_ITEM_WORDS % _lowered('text')} AS w FROM documents),
sized AS (SELECT item_id, w, least(len(w), 10) AS m FROM items WHERE len(w) > 0),
spans AS (SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS span
          FROM (SELECT item_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM sized)),
places AS (SELECT row_no, m, i, array_to_string(w[i:i + m - 1], ' ') AS span
           FROM (SELECT row_no, w, m, unnest(range(1, len(w) - m + 2)) AS i
                 FROM docs, (SELECT DISTINCT m FROM sized) WHERE len(w) >= m)),
found AS (SELECT row_no, i, places.m AS m, item_id FROM places JOIN spans ON places.m = spans.m AND places.span = spans.span),
hits AS (SELECT row_no, count(*) AS n_hit FROM (SELECT DISTINCT row_no, unnest(range(i, i + m)) AS at FROM found) GROUP BY row_no),
told AS (SELECT row_no, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
         FROM (SELECT DISTINCT row_no, item_id FROM found) GROUP BY row_no)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (row_no) LEFT JOIN told USING (row_no)"""

_PHRASES = rf"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_lowered('text')}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
grams AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
          FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k)),
totals AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
f AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS p, count(*) AS f FROM grams GROUP BY lang, k, phrase HAVING count(*) >= 100),
inner_ AS (SELECT DISTINCT c.lang, c.phrase FROM f AS c JOIN f AS o ON c.lang = o.lang AND o.k > c.k AND 100 * o.f >= 100 * c.f
           AND contains(' ' || o.phrase || ' ', ' ' || c.phrase || ' ') WHERE c.k > 1),
cuts AS (SELECT lang, phrase, p, f AS a, k AS size, unnest(range(1, k)) AS cut_at FROM f WHERE k > 1),
scored AS (SELECT cuts.lang, cuts.phrase, a, cut_at, h.f AS l, t.f AS r, n,
                  (CAST(1000 AS HUGEINT) * a * CAST(n AS HUGEINT)) // (CAST(h.f AS HUGEINT) * t.f) AS score
           FROM cuts JOIN f AS h ON h.lang = cuts.lang AND h.phrase = array_to_string(cuts.p[1:cut_at], ' ')
           JOIN f AS t ON t.lang = cuts.lang AND t.phrase = array_to_string(cuts.p[cut_at + 1:size], ' ')
           JOIN totals ON totals.lang = cuts.lang),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut_at) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM worst WHERE (lang, phrase) NOT IN (SELECT (lang, phrase) FROM inner_)
QUALIFY rank <= 2000"""

# crc32 of the digits of a number, bit by bit.
_BITS = "list_reduce([{c}, 0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[], lambda v, z: xor(v // 2, 3988292384::UBIGINT * (v % 2)))"
_CRC32 = (
    "xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), "
    "lambda d: CAST(ascii(d) AS UBIGINT))), lambda c, b: " + _BITS.format(c="xor(c, b)") + "), 4294967295::UBIGINT)"
)

_TRIE = f"""
WITH turns AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                      row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
               FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(struct_pack(role := role, text := text) ORDER BY pos) AS t FROM turns GROUP BY conv_id),
plan AS (SELECT conv_id, t, conv_id - conv_id % 100 AS base, CAST({_CRC32} % 6 AS BIGINT) AS h FROM own),
built AS (SELECT p.conv_id, coalesce(b.t[1:p.h], []) || p.t[p.h + 1:] AS t FROM plan AS p LEFT JOIN own AS b ON b.conv_id = p.base),
steps AS (SELECT conv_id, len(t) AS total, t, unnest(range(0, len(t) + 1)) AS depth FROM built),
keyed AS (SELECT conv_id, total, depth, sha256(CAST(t[1:depth] AS JSON)) AS node, sha256(CAST(t[1:depth - 1] AS JSON)) AS parent,
                 CASE WHEN depth > 0 THEN length(t[depth].text) ELSE 0 END AS chars FROM steps),
nodes AS (SELECT depth, node, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
                 string_agg(conv_id, ',' ORDER BY conv_id) FILTER (total = depth) AS ends FROM keyed GROUP BY depth, node),
kids AS (SELECT depth - 1 AS depth, parent AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
family AS (SELECT DISTINCT up.depth, up.node, down.depth AS low_depth, down.node AS low FROM keyed AS up JOIN keyed AS down
           ON up.conv_id = down.conv_id AND up.depth <= down.depth),
sums AS (SELECT family.depth, family.node, count(*) FILTER (n_children IS NULL) AS n_leaves, sum((n_convs - 1) * chars) AS saved_tokens
         FROM family JOIN nodes ON nodes.depth = low_depth AND nodes.node = low LEFT JOIN kids ON kids.depth = low_depth AND kids.node = low
         GROUP BY ALL)
SELECT nodes.conv_id, nodes.depth, above.conv_id AS parent_conv_id, nodes.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(nodes.ends, '')) AS ends_sha256
FROM nodes LEFT JOIN nodes AS above ON nodes.depth > 0 AND above.depth = nodes.depth - 1 AND above.node = nodes.parent
LEFT JOIN kids ON kids.depth = nodes.depth AND kids.node = nodes.node
JOIN sums ON sums.depth = nodes.depth AND sums.node = nodes.node"""


def all_sql() -> dict[str, str]:
    return {"op11_winnowing": _WINNOWING, "op12_phrases": _PHRASES, "op13_prefix_trie": _TRIE}
