"""SQL twins of the queries that SQL can express on whole tables."""

from __future__ import annotations

_TRIM = "trim({}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

LINE_DEDUP = f"""
WITH lines AS (
  SELECT doc_id, rn, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos
  FROM (SELECT doc_id, row_number() OVER () AS rn,
               string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
  SELECT *, translate({_TRIM.format('line')}, '{_UPPER}', '{_UPPER.lower()}') AS key FROM lines
), frequent AS (
  SELECT key FROM keyed WHERE length(key) >= 1
  GROUP BY key HAVING count(DISTINCT doc_id) >= 10
), flagged AS (
  SELECT k.*, f.key IS NOT NULL AS gone FROM keyed k LEFT JOIN frequent f ON k.key = f.key
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines,
       count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), ''))
         AS kept_sha256
FROM flagged GROUP BY rn
"""

CHAT_FORMAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place,
    lag(role, 1, '') OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before,
    count(*) OVER (PARTITION BY conv_id) AS n
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE role = 'assistant'), ''))
    AS loss_sha256,
  sum(24 + length(role) + length(text)
      + length(text) - length(replace(text, '\', ''))
      + (length(text) - length(replace(text, '<|', ''))) // 2)::BIGINT AS formatted_chars,
  bool_and(CASE WHEN place = 1 THEN role IN ('system', 'user')
                WHEN role = 'user' THEN before IN ('system', 'assistant')
                ELSE role = 'assistant' AND before = 'user' END)
    AND bool_or(place = n AND role = 'assistant') AS valid
FROM placed GROUP BY conv_id
"""


# The stop words once more, first letters in both cases.
_STOPS = (
    "the be to of and that have with a in is it for as on was by this from "
    "der die das und ist mit zu den von im nicht ein eine für auf sich "
    "le la les de du des et est un une dans que qui par pour sur pas au en "
    "el los las del y que es por para con se su al no una como"
).split()
_STOP_LIST = ", ".join(f"'{w}', '{w[:1].upper() + w[1:]}'" for w in _STOPS)

QUALITY_RULES = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS rn, doc_id, coalesce(text, '') AS t FROM documents
), split AS (
  SELECT rn, string_split_regex(t, '[\t\n\v\f\r ]+') AS ws FROM docs
), tokens AS (
  SELECT * FROM (SELECT rn, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM split)
  WHERE word <> ''
), counts AS (
  SELECT rn, count(*) AS n_words, sum(length(word))::BIGINT AS word_chars,
         count(*) FILTER (WHERE word IN ({_STOP_LIST})) AS stops
  FROM tokens GROUP BY rn
), windows AS (
  SELECT rn, i, word AS w1, lead(word, 1) OVER (PARTITION BY rn ORDER BY i) AS w2,
         lead(word, 2) OVER (PARTITION BY rn ORDER BY i) AS w3 FROM tokens
), repeated AS (
  SELECT rn, i, count(*) OVER (PARTITION BY rn, w1, w2, w3) AS c FROM windows
  WHERE w3 IS NOT NULL
), covered AS (
  SELECT rn, count(DISTINCT p) AS n FROM (
    SELECT rn, unnest([i, i + 1, i + 2]) AS p FROM repeated WHERE c > 1) GROUP BY rn
), lines AS (
  SELECT rn, count(*) AS n, count(*) - count(DISTINCT line) AS again FROM (
    SELECT rn, unnest(string_split(t, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\t\n\v\f\r ]') GROUP BY rn
), base AS (
  SELECT doc_id, coalesce(c.n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(l.again, 0) AS n_dup_lines, coalesce(v.n, 0) AS n_repeat_words,
         coalesce(stops, 0) AS stops, coalesce(l.n, 0) AS n_lines
  FROM docs d LEFT JOIN counts c ON d.rn = c.rn LEFT JOIN covered v ON d.rn = v.rn
              LEFT JOIN lines l ON d.rn = l.rn
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars BETWEEN 2 * n_words AND 14 * n_words
       AND n_symbols / greatest(n_words, 1) <= 0.1 AND stops / greatest(n_words, 1) >= 0.03
       AND n_dup_lines / greatest(n_lines, 1) <= 0.3 AND n_words >= n_lines AS kept
FROM judged
"""

PREFIX_TRIE = """
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k
  FROM conversations WHERE conv_id IS NOT NULL
), bytes AS (
  SELECT conv_id, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ord(c)::BIGINT) AS b
  FROM (SELECT DISTINCT conv_id FROM turns)
), numbered AS (
  SELECT conv_id, xor(list_reduce(list_concat([4294967295::BIGINT], b), lambda a, x:
    list_reduce([xor(a, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z:
      xor(y >> 1, 3988292384 * (y & 1)))), 4294967295) % 6 AS h
  FROM bytes
), rebuilt AS (
  SELECT n.conv_id, 0 AS part, t.k, t.role, t.text
  FROM numbered n JOIN turns t ON t.conv_id = n.conv_id - n.conv_id % 100 AND t.k <= n.h
  UNION ALL
  SELECT n.conv_id, 1, t.k, t.role, t.text
  FROM numbered n JOIN turns t ON t.conv_id = n.conv_id AND t.k > n.h
), paths AS (
  SELECT n.conv_id, coalesce(p.path, []) AS path
  FROM numbered n LEFT JOIN (
    SELECT conv_id, list({'role': role, 'text': text} ORDER BY part, k) AS path
    FROM rebuilt GROUP BY conv_id
  ) p ON n.conv_id = p.conv_id
), prefixes AS (
  SELECT conv_id, unnest(range(0, len(path) + 1)) AS depth, path FROM paths
), nodes AS (
  SELECT list_slice(path, 1, depth) AS prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)
      FILTER (depth = len(path)), '')) AS ends_sha256
  FROM prefixes GROUP BY ALL
), kids AS (
  SELECT list_slice(prefix, 1, depth - 1) AS prefix, count(*) AS n_children
  FROM nodes WHERE depth > 0 GROUP BY ALL
), own AS (
  SELECT n.*, coalesce(k.n_children, 0) AS n_children,
    CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * length(n.prefix[depth].text) END AS saved
  FROM nodes n LEFT JOIN kids k ON n.prefix = k.prefix
), sums AS (
  SELECT list_slice(prefix, 1, above) AS prefix, sum(saved) AS saved_tokens,
    count(*) FILTER (n_children = 0) AS n_leaves
  FROM (SELECT *, unnest(range(0, depth + 1)) AS above FROM own) GROUP BY ALL
)
SELECT o.conv_id, o.depth, p.conv_id AS parent_conv_id, o.n_convs, o.n_children, s.n_leaves,
  s.saved_tokens::BIGINT AS saved_tokens, o.ends_sha256
FROM own o JOIN sums s ON o.prefix = s.prefix
LEFT JOIN nodes p ON o.depth > 0 AND p.prefix = list_slice(o.prefix, 1, o.depth - 1)
"""

HARD_NEGATIVES = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
    list_inner_product(a.v, r.v)::BIGINT AS score
  FROM rows a JOIN rows r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
  (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INTEGER
    AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_line_dedup": LINE_DEDUP,
        "op2_quality_rules": QUALITY_RULES,
        "op9_chat_format": CHAT_FORMAT,
        "op12_hard_negatives": HARD_NEGATIVES,
        "op13_prefix_trie": PREFIX_TRIE,
    }
