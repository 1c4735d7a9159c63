"""The results of some operators as DuckDB SQL over the same tables."""

from __future__ import annotations

from stockflow.llm.pii import CONTEXT_CHARS, CONTEXT_SCORE, KINDS, THRESHOLD
from stockflow.llm.sharding import SEED, SHARDS

# CRC-32 of the UTF-8 bytes, byte by byte over its table of 256 remainders
_CRC = """
crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda c, x : CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM (SELECT unnest(range(256))::BIGINT AS i))),
"""


SHARDING_SQL = f"""
WITH {_CRC}
hexed AS (SELECT doc_id, source, coalesce(text, '') AS body, hex(encode(coalesce(text, ''))) AS h FROM documents),
bytes AS (
  SELECT doc_id, source, strlen(body) + 1 AS size,
    list_transform(range(1, strlen(body) + 1), lambda i : ('0x' || substr(h, 2 * i - 1, 2))::BIGINT)::BIGINT[] AS b
  FROM hexed),
sums AS (
  SELECT doc_id, source, size,
    xor(list_reduce(list_prepend(4294967295::BIGINT, b),
        lambda c, x : xor(c >> 8, t[xor(c & 255, x) + 1])), 4294967295) AS text_crc32
  FROM bytes, crc_table),
keyed AS (
  SELECT *, md5('{SEED}|' || coalesce(doc_id::VARCHAR, '') || '|' || text_crc32::VARCHAR) AS order_key FROM sums),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY order_key, doc_id, text_crc32, size) - 1 AS in_source,
    count(*) OVER (PARTITION BY source) AS of_source,
    ('0x' || substr(md5('source:' || coalesce(source, '')), 1, 6))::BIGINT::DOUBLE / 16777216::DOUBLE AS place
  FROM keyed),
placed AS (
  SELECT *, row_number() OVER (
      ORDER BY (in_source::DOUBLE + place) / of_source::DOUBLE, source NULLS FIRST, order_key, doc_id, text_crc32, size) - 1 AS position,
    count(*) OVER () AS total
  FROM ranked)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'rows' AS law,
  (position * {SHARDS} // total)::INTEGER AS shard,
  (position - (position * {SHARDS} // total * total + {SHARDS - 1}) // {SHARDS})::BIGINT AS slot,
  NULL::INTEGER AS grown_shard
FROM placed
"""

# START is 12 code points, END with its line feed 11; an escaped text has one backslash
# more per control string
CHAT_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
sized AS (
  SELECT *,
    12 + length(regexp_replace(replace(replace(role, '\', '\b'), chr(10), '\n'), '<(\\*)\|', '<\\\1|', 'g')) + 1
      + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) + 11 AS chars,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n
  FROM turns),
summed AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY n) AS upto, n = max(n) OVER (PARTITION BY conv_id) AS last
  FROM sized)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(upto) FILTER (role = 'assistant' OR last)::BIGINT AS formatted_chars
FROM summed GROUP BY conv_id
"""

_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
}
_DIGITS = "regexp_replace(m, '[^0-9]', '', 'g')"
_VALID = {
    "email": "true",
    "ip": "len(list_filter(string_split(m, '.'), lambda p : length(ltrim(p, '0')) > 3 OR coalesce(try_cast(p AS HUGEINT), 256) > 255)) = 0",
    "card": f"""length({_DIGITS}) BETWEEN 13 AND 19 AND list_sum(list_transform(range(1, length({_DIGITS}) + 1),
        lambda i : CASE WHEN i % 2 = 0 THEN [0, 2, 4, 6, 8, 1, 3, 5, 7, 9][substr({_DIGITS}, -i::BIGINT, 1)::INT + 1]
                 ELSE substr({_DIGITS}, -i::BIGINT, 1)::INT END)) % 10 = 0""",
    "phone": f"length({_DIGITS}) BETWEEN 9 AND 15",
    "iban": """list_reduce(list_prepend(0::BIGINT, list_transform(
        string_split(substr(replace(m, ' ', ''), 5) || substr(replace(m, ' ', ''), 1, 4), ''), lambda c : ascii(c)::BIGINT)),
        lambda r, c : (CASE WHEN c >= 65 THEN r * 100 + c - 55 ELSE r * 10 + c - 48 END) % 97) = 1""",
    "ssn": "true",
}


def _pii_sql() -> str:
    parts = []
    for no, kind in enumerate(KINDS):
        pattern = _PATTERNS[kind.name]
        stays = "" if kind.base else f" AND score >= {THRESHOLD}"
        parts.append(
            f"""
  SELECT doc_id, row_no, {no} AS no, '{kind.name}' AS kind, s, e, score FROM (
    SELECT *, s + length(m) AS e,
      {kind.score} + CASE WHEN regexp_matches(lower(substr(body, greatest(s - {CONTEXT_CHARS}, 0) + 1, s - greatest(s - {CONTEXT_CHARS}, 0))),
        '{kind.context}') THEN {CONTEXT_SCORE} ELSE 0 END AS score
    FROM (
      SELECT doc_id, row_no, body, ms[i] AS m,
        (list_sum(list_transform(ps[1:i], lambda p : length(p)))
          + coalesce(list_sum(list_transform(ms[1:i - 1], lambda p : length(p))), 0))::BIGINT AS s
      FROM (
        SELECT doc_id, row_no, body, ms, ps, unnest(range(1, len(ms) + 1)) AS i FROM (
          SELECT doc_id, row_no, body, regexp_extract_all(body, '{pattern}') AS ms,
            regexp_split_to_array(body, '{pattern}') AS ps FROM texts))))
  WHERE {_VALID[kind.name]}{stays}"""
        )
    found = "\n  UNION ALL".join(parts)
    base = ", ".join(f"'{kind.name}'" for kind in KINDS if kind.base)
    counts = ",\n  ".join(f"count(*) FILTER (kind = '{kind.name}') AS n_{kind.name}" for kind in KINDS if kind.base)
    span = "kind || ':' || s::BIGINT::VARCHAR || ':' || e::BIGINT::VARCHAR"
    return f"""
WITH texts AS (SELECT doc_id, row_number() OVER () AS row_no, coalesce(text, '') AS body FROM documents),
found AS ({found})
SELECT texts.doc_id, {counts},
  sha256(coalesce(string_agg({span}, ',' ORDER BY no, s) FILTER (kind IN ({base})), '')) AS base_sha256,
  coalesce(string_agg({span}, ',' ORDER BY no, s), '') AS spans,
  coalesce(string_agg(score::VARCHAR, ',' ORDER BY no, s), '') AS scores
FROM texts LEFT JOIN found USING (row_no) GROUP BY texts.doc_id, texts.row_no
"""


PII_SQL = _pii_sql()


def _components(nodes: str, links: str) -> str:
    """Recursive: all (node, reached) pairs; links hold both directions."""
    return f"""reach AS (
  SELECT n AS node, n AS reached FROM {nodes}
  UNION SELECT node, other FROM reach JOIN {links} ON reached = one)"""


# n-gram sets as lists of words, every pair that shares one counted exactly
NGRAM_SQL = f"""
WITH RECURSIVE
docs AS (
  SELECT doc_id, coalesce(text, '') AS body, row_number() OVER () AS n,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents),
grams AS (
  SELECT DISTINCT n, array_to_string(words[i:i + 4], ' ') AS gram
  FROM (SELECT n, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM docs WHERE len(words) > 0)),
sizes AS (SELECT n, count(*) AS size FROM grams GROUP BY n),
shared AS (
  SELECT a.n AS one, b.n AS other, count(*) AS n_both
  FROM grams AS a JOIN grams AS b ON a.gram = b.gram AND a.n <> b.n GROUP BY 1, 2),
links AS (
  SELECT one, other FROM shared JOIN sizes AS a ON a.n = one JOIN sizes AS b ON b.n = other
  WHERE 9 * n_both >= 4 * (a.size + b.size)),
{_components("docs", "links")},
groups AS (SELECT node, min(doc_id) AS class_id FROM reach JOIN docs ON reached = n GROUP BY node),
counts AS (SELECT one, count(*) AS n_links FROM links GROUP BY one)
SELECT doc_id, class_id,
  CASE WHEN len(words) > 0 THEN min(doc_id) OVER (PARTITION BY body) ELSE doc_id END AS copy_id,
  CASE WHEN len(words) > 0 THEN count(*) OVER (PARTITION BY body) ELSE 1 END AS n_copies,
  coalesce(n_links, 0) AS n_links
FROM docs JOIN groups ON node = n LEFT JOIN counts ON one = n
"""

# every pair of a label compared
EMBEDDING_SQL = f"""
WITH RECURSIVE
vectors AS (SELECT vec_id, label, embedding::DOUBLE[] AS v, row_number() OVER () AS n FROM embeddings),
usable AS (
  SELECT * FROM vectors WHERE label IS NOT NULL AND len(v) > 0
    AND len(list_filter(v, lambda x : x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(v, lambda x : x <> 0)) > 0),
links AS (
  SELECT a.n AS one, b.n AS other FROM usable AS a JOIN usable AS b ON a.label = b.label AND a.n <> b.n
  WHERE len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.98),
{_components("vectors", "links")},
groups AS (SELECT node, min(vec_id) AS component_id FROM reach JOIN vectors ON reached = n GROUP BY node),
counts AS (SELECT one, count(*) AS n_links FROM links GROUP BY one)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, coalesce(vec_id = component_id, false) AS kept
FROM vectors JOIN groups ON node = n LEFT JOIN counts ON one = n
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

RESAMPLING_SQL = f"""
WITH {_CRC}
texts AS (
  SELECT 0 AS kind, row_number() OVER () AS row_no, doc_id, text FROM documents
  UNION ALL SELECT 1, row_number() OVER (), NULL, text FROM benchmark),
words AS (
  SELECT kind, row_no, doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM texts),
features AS (
  SELECT kind, row_no, unnest(list_concat(w,
    list_transform(range(1, len(w)), lambda i : w[i] || ' ' || w[i + 1]),
    list_transform(range(1, len(w) - 1), lambda i : w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS f FROM words),
different AS (SELECT f, row_number() OVER () AS f_no FROM (SELECT DISTINCT f FROM features)),
hexed AS (SELECT f, hex(encode(f)) AS h, strlen(f) AS n FROM different),
bytes AS (
  SELECT f, list_transform(range(1, n + 1), lambda i : ('0x' || substr(h, 2 * i - 1, 2))::BIGINT)::BIGINT[] AS b FROM hexed),
hashed AS (
  SELECT f, xor(list_reduce(list_prepend(4294967295::BIGINT, b),
      lambda c, x : xor(c >> 8, t[xor(c & 255, x) + 1])), 4294967295) % 10000 AS bucket
  FROM bytes, crc_table),
counted AS (
  SELECT kind, row_no, bucket, count(*) AS n FROM features JOIN hashed USING (f) GROUP BY ALL),
buckets AS (
  SELECT bucket, coalesce(sum(n) FILTER (kind = 0), 0) AS s, coalesce(sum(n) FILTER (kind = 1), 0) AS t
  FROM counted GROUP BY bucket),
totals AS (SELECT coalesce(sum(s), 0) AS all_s, coalesce(sum(t), 0) AS all_t FROM buckets),
gained AS (
  SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (all_s + 10000)::DOUBLE) / ((s + 1)::DOUBLE * (all_t + 10000)::DOUBLE)))::BIGINT AS gain
  FROM buckets, totals),
weights AS (
  SELECT row_no, sum(n) AS n_features, sum(n * gain) AS weight FROM counted JOIN gained USING (bucket)
  WHERE kind = 0 GROUP BY row_no),
scored AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM words LEFT JOIN weights USING (row_no) WHERE kind = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS FIRST, weight, n_features) AS place,
    count(*) FILTER (n_words >= 20) OVER () * 5 // 100 AS drawn FROM scored)
SELECT doc_id, n_features, weight, score,
  CASE WHEN n_words >= 20 AND place <= drawn THEN place END AS rank FROM ranked
"""

DIVERGENCE_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS row_no, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all({_LOWER}, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms FROM documents),
seen AS (SELECT row_no, lang, source, unnest(terms) AS term FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT row_no) AS n_docs FROM seen GROUP BY ALL),
kept AS (SELECT lang, term, sum(n)::HUGEINT AS lang_n FROM counts GROUP BY lang, term HAVING sum(n_docs) >= 30),
langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(lang_n)::HUGEINT AS of_lang FROM kept GROUP BY lang),
grps AS (SELECT DISTINCT lang, source FROM docs),
level AS (
  SELECT lang, source, term, lang_n, coalesce(n, 0)::HUGEINT AS n FROM grps JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)),
sums AS (SELECT lang, source, sum(n)::HUGEINT AS of_group FROM level GROUP BY lang, source),
share AS (
  SELECT lang, source, term, n, (1 + 1000000000 * (n + 5) // (of_group + 5 * v))::BIGINT AS p,
    (1 + 1000000000 * (lang_n + 5) // (of_lang + 5 * v))::BIGINT AS q
  FROM level JOIN sums USING (lang, source) JOIN langs USING (lang)),
pair AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0)::BIGINT AS value
  FROM grps a JOIN grps b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN share x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN share y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY ALL),
above AS (SELECT lang, source, term AS item, p - q AS value FROM share WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value,
  row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER AS rank FROM pair
UNION ALL SELECT lang, source, 'term', item, value, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER AS rank FROM above) WHERE rank <= 50
"""
