"""DuckDB counterparts of the queries whose results SQL can express."""

from __future__ import annotations

from termtide.llm import centroids, jaccard, quality
from termtide.llm.preference import TRAINED_ROLE, TURN_END, TURN_START
from termtide.llm.repeats import SIZE

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BASE32 = _UPPER + "234567"
_SPACES = r" \t\n\x0B\f\r"


def _literal(text: str) -> str:
    """A text as an SQL expression; line ends are written as chr(10)."""
    return " || chr(10) || ".join(f"'{part}'" for part in text.split("\n"))


def _words(table: str, key: str) -> str:
    """Lower-cased words of the contract, one row per text."""
    return rf"""
        SELECT {key},
               regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
        FROM {table}"""


_HEAD = f"{_literal(TURN_START)} || role || chr(10)"

PREFERENCE = f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
           coalesce(CASE WHEN role = 'assistant' AND turn >= 2 * (((conv_id % 3) + 3) % 3)
                         THEN array_to_string(list_reverse(string_split(text, ' ')), ' ')
                         ELSE text END, '') AS other
    FROM conversations
), sides AS (
    SELECT 'chosen' AS side, conv_id, role, text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
    FROM turns
    UNION ALL
    SELECT 'rejected', conv_id, role, other,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, other)
    FROM turns
), prompts AS (
    SELECT a.conv_id,
           coalesce(min(a.pos) FILTER (a.role <> b.role OR a.text <> b.text) - 1, count(*)) AS n
    FROM sides a JOIN sides b ON a.conv_id IS NOT DISTINCT FROM b.conv_id AND a.pos = b.pos
    WHERE a.side = 'chosen' AND b.side = 'rejected'
    GROUP BY a.conv_id
), rendered AS (
    SELECT s.*, n, {_HEAD} || text || {_literal(TURN_END)} AS said, length({_HEAD}) AS head
    FROM sides s JOIN prompts p ON s.conv_id IS NOT DISTINCT FROM p.conv_id
), placed AS (
    SELECT *, sum(length(said)) OVER (PARTITION BY conv_id, side, pos <= n ORDER BY pos) AS stop
    FROM rendered
), masked AS (
    SELECT *, (stop - length(said) + head)::BIGINT || '-' || stop::BIGINT AS span FROM placed
)
SELECT conv_id, max(n)::BIGINT AS n_prompt_turns,
       coalesce(string_agg(said, '' ORDER BY pos) FILTER (side = 'chosen' AND pos <= n), '') AS prompt,
       {", ".join(
           f"coalesce(string_agg(said, '' ORDER BY pos) FILTER (side = '{side}' AND pos > n), '')"
           f" AS {side}, coalesce(string_agg(span, ',' ORDER BY pos) FILTER (side = '{side}'"
           f" AND pos > n AND role = '{TRAINED_ROLE}'), '') AS {side}_mask"
           for side in ("chosen", "rejected")
       )}
FROM masked GROUP BY conv_id
"""

DECONTAMINATE = f"""
WITH items AS ({_words("benchmark", "item_id")}
), patterns AS (
    SELECT DISTINCT item_id, least(10, len(words)) AS size,
           array_to_string(words[pos : pos + least(10, len(words)) - 1], ' ') AS gram
    FROM (SELECT *, unnest(range(1, greatest(1, len(words) - 9) + 1)) AS pos FROM items)
    WHERE len(words) > 0
), docs AS (
    SELECT row_number() OVER () AS r, * FROM ({_words("documents", "doc_id")})
), grams AS (
    SELECT r, pos, size, array_to_string(words[pos : pos + size - 1], ' ') AS gram
    FROM (SELECT r, words, size, unnest(range(1, len(words) - size + 2)) AS pos
          FROM docs, (SELECT DISTINCT size FROM patterns))
), found AS (
    SELECT r, pos, size, item_id FROM grams JOIN patterns USING (size, gram)
), hits AS (
    SELECT r, count(DISTINCT pos) AS n_hit
    FROM (SELECT r, unnest(range(pos, pos + size)) AS pos FROM found) GROUP BY r
), named AS (
    SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
    FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM found) GROUP BY r
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (r) LEFT JOIN named USING (r)
"""

# Bytes are written in hexadecimal. Texts are cut into overlapping pieces first, since taking a
# part of a long string costs time in proportion to its place.
_PIECE = 256
REPEATS = f"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS id,
           hex(encode(coalesce(text, ''))) AS bytes
    FROM documents
), pieces AS (
    SELECT r, id, piece, substr(bytes, 2 * piece + 1, 2 * ({_PIECE} + {SIZE} - 1)) AS part
    FROM (SELECT *, unnest(range(0, length(bytes) // 2 - {SIZE} + 1, {_PIECE})) AS piece FROM docs)
), windows AS (
    SELECT r, id, piece + pos AS pos, substr(part, 2 * pos + 1, 2 * {SIZE}) AS bytes
    FROM (SELECT *, unnest(range(0, least({_PIECE}, length(part) // 2 - {SIZE} + 1))) AS pos
          FROM pieces)
), starts AS (
    SELECT r, pos FROM windows
    JOIN (SELECT bytes, min(id) AS owner FROM windows GROUP BY bytes HAVING count(*) > 1)
    USING (bytes) WHERE owner < id
), marked AS (
    SELECT r, pos, coalesce(pos > lag(pos) OVER (PARTITION BY r ORDER BY pos) + {SIZE}, true)::INT AS new
    FROM starts
), spans AS (
    SELECT r, min(pos) AS low, max(pos) + {SIZE} AS high
    FROM (SELECT r, pos, sum(new) OVER (PARTITION BY r ORDER BY pos) AS span FROM marked)
    GROUP BY r, span
), edges AS (
    SELECT r, low, high FROM spans UNION ALL SELECT r, length(bytes) // 2, NULL FROM docs
), kept AS (
    SELECT r, coalesce(sum(high - low), 0)::BIGINT AS n_removed, count(high) AS n_spans,
           string_agg(substr(bytes, 2 * begins + 1, 2 * (low - begins)), '' ORDER BY low) AS bytes
    FROM (SELECT *, coalesce(lag(high) OVER (PARTITION BY r ORDER BY low, high NULLS LAST), 0)
                    AS begins
          FROM edges)
    JOIN (SELECT r, bytes FROM docs) USING (r) GROUP BY r
)
SELECT doc_id, length(docs.bytes) // 2 AS n_bytes, n_removed, n_spans,
       sha256(unhex(kept.bytes)) AS kept_sha256
FROM docs JOIN kept USING (r)
"""

_LEVELS = " UNION ALL ".join(
    f"SELECT r, stratum, doc_id, '{rule}' AS rule, {place} AS place, least({quality.LEVELS},"
    f" floor(coalesce({measure}, 0.0) / {quality.RULES[rule]} * {quality.LEVELS})) AS level"
    " FROM measured"
    for place, (rule, measure) in enumerate(
        {
            "symbols_per_char": "n_symbols::DOUBLE / nullif(word_chars, 0)",
            "dup_line_share": "n_dup_lines::DOUBLE / nullif(n_lines, 0)",
            "repeat_word_share": "n_repeat_words::DOUBLE / nullif(n_words, 0)",
            "chars_per_word": "word_chars::DOUBLE / nullif(n_words, 0)",
        }.items()
    )
)
_RATE = quality.MAX_REJECTED

QUALITY = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, lang AS stratum, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^{_SPACES}]+') AS words
    FROM documents
), lines AS (
    SELECT r, [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^{_SPACES}]')] AS lines
    FROM docs
), placed AS (
    SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM docs
), windows AS (
    SELECT r, pos, word AS a, lead(word, 1) OVER w AS b, lead(word, 2) OVER w AS c
    FROM placed WINDOW w AS (PARTITION BY r ORDER BY pos)
), repeated AS (
    SELECT r, count(DISTINCT pos) AS n_repeat_words
    FROM (SELECT r, unnest(range(pos, pos + {quality.WINDOW})) AS pos
          FROM (SELECT r, pos, count(*) OVER (PARTITION BY r, a, b, c) AS n
                FROM windows WHERE c IS NOT NULL)
          WHERE n > 1)
    GROUP BY r
), measured AS (
    SELECT r, doc_id, stratum, len(words)::BIGINT AS n_words,
           length(regexp_replace(text, '[{_SPACES}]+', '', 'g'))::BIGINT AS word_chars,
           (length(text) - length(translate(text, '{quality.SYMBOLS}', '')))::BIGINT AS n_symbols,
           len(lines) AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
           coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
    FROM docs JOIN lines USING (r) LEFT JOIN repeated USING (r)
), levels AS ({_LEVELS}
), highest AS (
    SELECT r, doc_id, stratum, max(level) AS level FROM levels GROUP BY ALL
), known AS (
    SELECT stratum, level, quality = 1 AS good FROM highest JOIN labels USING (doc_id)
    WHERE quality IS NOT NULL
), tried AS (
    SELECT stratum, cutoff, count(*) FILTER (good) AS n,
           count(*) FILTER (good AND level > cutoff) AS k,
           count(*) FILTER (NOT good AND level > cutoff) AS caught
    FROM known, (SELECT unnest(range({quality.LEVELS})) AS cutoff) GROUP BY ALL HAVING n > 0
), strata AS (
    SELECT count(*) AS n_strata FROM (SELECT DISTINCT stratum FROM known WHERE good)
), passed AS (
    SELECT stratum, cutoff, caught, k
    FROM (SELECT *, unnest(range(k + 1)) AS j FROM tried WHERE k < n * {_RATE}), strata
    GROUP BY stratum, cutoff, caught, k, n_strata, n
    HAVING sum(exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1)
                   + j * ln({_RATE}) + (n - j) * ln(1 - {_RATE})))
           <= {quality.ERROR} / n_strata
), chosen AS (
    SELECT stratum, cutoff FROM passed
    QUALIFY row_number() OVER (
        PARTITION BY stratum ORDER BY caught DESC, k, cutoff) = 1
), rejected AS (
    SELECT r, string_agg(rule, ',' ORDER BY place) AS rejected_by
    FROM (SELECT r, l.rule, place FROM levels l
          JOIN chosen c ON l.stratum IS NOT DISTINCT FROM c.stratum
          WHERE level > cutoff)
    GROUP BY r
), judged AS (
    SELECT *, n_words < {quality.MIN_WORDS}
              OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed,
           coalesce(rejected.rejected_by, '') AS rules
    FROM measured LEFT JOIN rejected USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND rules = '' AS kept, rules AS rejected_by
FROM judged
"""

# 20 bits are five hexadecimal digits and four characters of base 32.
_FOUR = " || ".join(
    f"substr('{_BASE32}', (('0x' || substr(digest, 5 * g + 1, 5))::BIGINT // {1 << shift}) % 32 + 1, 1)"
    for shift in (15, 10, 5, 0)
)
WARC = f"""
WITH payloads AS (
    SELECT page_id, encode(coalesce(html, '')) AS raw, sha1(encode(coalesce(html, ''))) AS digest,
           min(page_id) OVER (PARTITION BY coalesce(html, '')) AS least
    FROM pages
)
SELECT page_id, octet_length(raw)::BIGINT AS payload_bytes,
       array_to_string([{_FOUR} FOR g IN range(8)], '') AS payload_digest,
       CASE WHEN least IS NULL OR page_id = least THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM least THEN least END AS refers_to
FROM payloads
"""

_SHINGLE = jaccard.SHINGLE_WORDS
JACCARD = rf"""
WITH RECURSIVE docs AS MATERIALIZED (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                              '[^{_SPACES}]+') AS words
    FROM documents
), grams AS MATERIALIZED (
    SELECT DISTINCT r, array_to_string(words[pos : pos + {_SHINGLE - 1}], ' ') AS gram
    FROM (SELECT *, unnest(range(1, greatest(1, len(words) - {_SHINGLE - 1}) + 1)) AS pos FROM docs)
    WHERE len(words) > 0
), sizes AS MATERIALIZED (
    SELECT r, count(gram) AS n FROM docs LEFT JOIN grams USING (r) GROUP BY r
), links AS MATERIALIZED (
    SELECT a.r AS a, b.r AS b
    FROM grams x JOIN grams y USING (gram) JOIN sizes a ON x.r = a.r JOIN sizes b ON y.r = b.r
    WHERE 100 * least(a.n, b.n) >= {jaccard.PERCENT} * greatest(a.n, b.n)
    GROUP BY a.r, b.r, a.n, b.n
    HAVING 100 * count(*) >= {jaccard.PERCENT} * (a.n + b.n - count(*))
), reached AS (
    SELECT r, r AS other FROM docs
    UNION
    SELECT reached.r, links.b FROM reached JOIN links ON reached.other = links.a
)
SELECT docs.doc_id, n::BIGINT AS n_shingles, component_id
FROM docs JOIN sizes USING (r)
JOIN (SELECT reached.r, min(o.doc_id) AS component_id
      FROM reached JOIN docs o ON reached.other = o.r GROUP BY reached.r) USING (r)
"""

_GAP = "list_sum(list_transform(list_zip(k.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"


def _round(number: int) -> str:
    """Assignments under the centroids of a round, and the centroids of the next one."""
    return f"""
, a{number} AS MATERIALIZED (
    SELECT r, any_value(k.x) AS x, min([{_GAP}::BIGINT, cluster]) AS least
    FROM kept k, c{number} c GROUP BY r
), c{number + 1} AS MATERIALIZED (
    SELECT cluster, coalesce(m.x, c.x) AS x
    FROM c{number} c LEFT JOIN (
        SELECT cluster, list(((total - ((total % n) + n) % n) // n)::BIGINT ORDER BY pos) AS x
        FROM (SELECT least[2] AS cluster, pos, sum(x[pos]) AS total, count(*) AS n
              FROM a{number}, range(1, {centroids.DIMENSIONS} + 1) p(pos) GROUP BY ALL)
        GROUP BY cluster) m USING (cluster)
)"""


CENTROIDS = f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id,
           list_transform(embedding, lambda e: floor({centroids.SCALE} * e::DOUBLE)::BIGINT) AS x
    FROM embeddings
    WHERE len(embedding) = {centroids.DIMENSIONS}
      AND list_bool_and(list_transform(embedding, lambda e: coalesce(isfinite(e), false)))
), c0 AS MATERIALIZED (
    SELECT row_number() OVER (
               ORDER BY sha256('{centroids.SEED}:' || vec_id) NULLS LAST, x) - 1 AS cluster, x
    FROM kept QUALIFY cluster < {centroids.CLUSTERS}
){"".join(map(_round, range(centroids.ROUNDS + 1)))}
, assigned AS (
    SELECT vec_id, least[2] AS cluster, least[1] AS distance
    FROM a{centroids.ROUNDS} JOIN kept USING (r)
)
SELECT vec_id, a.cluster::INTEGER AS cluster, distance,
       sum(distance) OVER (PARTITION BY a.cluster)::BIGINT AS cluster_inertia,
       sum(distance) OVER ()::BIGINT AS inertia,
       sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM assigned a JOIN c{centroids.ROUNDS} c ON a.cluster = c.cluster
"""

ORACLE_SQL: dict[str, str] = {
    "op1_preference_format": PREFERENCE,
    "op2_decontaminate": DECONTAMINATE,
    "op3_repeated_substrings": REPEATS,
    "op8_quality_rules": QUALITY,
    "op9_warc": WARC,
    "op12_jaccard_join": JACCARD,
    "op13_centroids": CENTROIDS,
}
