"""SQL twins for DuckDB, where SQL can say the same. They share no code with the operators."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"

# Of records with equal payloads that of the largest id is the response. Five hex digits are
# four digits of base32.
OP1 = """
WITH records AS (
    SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS digest FROM pages
),
told AS (SELECT *, max(page_id) OVER (PARTITION BY payload) AS response FROM records)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
           (CAST('0x' || substr(digest, i // 4 * 5 + 1, 5) AS BIGINT) // CAST(32 ** (3 - i % 4) AS BIGINT)) % 32
       AS INTEGER), 1)), '') AS payload_digest,
       CASE WHEN coalesce(page_id = response, response IS NULL) THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN coalesce(page_id = response, response IS NULL) THEN NULL ELSE response END AS refers_to
FROM told
"""

OP3 = rf"""
WITH texts AS MATERIALIZED (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM documents
),
windows AS (
    SELECT doc_id, i, array_to_string(words[i:i + 19], ' ') AS passage
    FROM texts, unnest(range(1, len(words) - 18)) AS r(i)
),
repeats AS (
    SELECT doc_id, i FROM (
        SELECT doc_id, i, row_number() OVER (PARTITION BY passage ORDER BY doc_id, i) AS nth FROM windows
    ) WHERE nth > 1
),
removed AS (SELECT DISTINCT doc_id, i + k AS i FROM repeats, range(20) AS r(k)),
kept AS (
    SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS said
    FROM (SELECT doc_id, unnest(range(1, len(words) + 1)) AS i, unnest(words) AS word FROM texts)
    ANTI JOIN removed USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(said, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)
"""

OP4 = rf"""
WITH RECURSIVE texts AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS words FROM documents
),
shingles AS MATERIALIZED (
    SELECT DISTINCT doc_id, array_to_string(words[i:i + 2], ' ') AS shingle
    FROM texts, unnest(range(1, greatest(len(words) - 1, least(len(words), 1) + 1))) AS r(i)
),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS size FROM shingles GROUP BY doc_id),
links AS MATERIALIZED (
    SELECT one, two FROM (
        SELECT a.doc_id AS one, b.doc_id AS two, count(*) AS shared
        FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2
    ) JOIN sizes s ON s.doc_id = one JOIN sizes t ON t.doc_id = two
    WHERE 100 * shared >= 90 * (s.size + t.size - shared)
),
reached(doc_id, other) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT doc_id, two FROM reached JOIN links ON one = other
)
SELECT doc_id, coalesce(any_value(size), 0) AS n_shingles, min(other) AS component_id
FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""

# Texts are two hex digits a byte, cut into parts of a thousand bytes before they are cut into
# strings. Starts of repeated strings at most 50 apart make one removed run.
OP5 = """
WITH texts AS MATERIALIZED (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS digits, strlen(coalesce(text, '')) AS n_bytes FROM documents
),
parts AS (
    SELECT doc_id, n_bytes, first, substr(digits, 2 * first + 1, 2 * 1049) AS part
    FROM texts, unnest(range(0, n_bytes, 1000)) AS r(first)
),
strings AS MATERIALIZED (
    SELECT doc_id, first + i AS begin, substr(part, 2 * i + 1, 100) AS string
    FROM parts, unnest(range(0, least(1000, n_bytes - first - 49))) AS r(i)
),
firsts AS (SELECT string, min(doc_id) AS first_doc FROM strings GROUP BY string HAVING count(*) > 1),
repeats AS MATERIALIZED (
    SELECT doc_id, begin FROM strings JOIN firsts USING (string) WHERE first_doc < doc_id
),
marked AS (
    SELECT doc_id, begin,
           CASE WHEN begin - lag(begin) OVER (PARTITION BY doc_id ORDER BY begin) <= 50 THEN 0 ELSE 1 END AS opens
    FROM repeats
),
numbered AS (
    SELECT doc_id, begin, sum(opens) OVER (PARTITION BY doc_id ORDER BY begin) AS run FROM marked
),
runs AS (SELECT doc_id, run, min(begin) AS begin, max(begin) + 50 AS past FROM numbered GROUP BY doc_id, run),
placed AS (
    SELECT *, coalesce(lag(past) OVER (PARTITION BY doc_id ORDER BY begin), 0) AS before FROM runs
),
cut AS (
    SELECT doc_id, sum(past - begin) AS n_removed, count(*) AS n_spans, max(past) AS last,
           string_agg(substr(digits, 2 * before + 1, 2 * (begin - before)), '' ORDER BY begin) AS kept
    FROM placed JOIN texts USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, CAST(n_bytes AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(digits, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM texts LEFT JOIN cut USING (doc_id)
"""

# CRC-32 of a decimal number, bit by bit over its characters.
_CRC = """xor(4294967295, list_reduce(list_transform(str_split(CAST({0} AS VARCHAR), ''),
    lambda s: CAST(ord(s) AS BIGINT)), lambda crc, byte: list_reduce([0, 1, 2, 3, 4, 5, 6, 7],
    lambda x, bit: xor(x // 2, 3988292384 * (x % 2)), xor(crc, byte)), 4294967295))"""

OP11 = rf"""
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
               unhex(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || ':' || coalesce(text, '')))) AS pos
    FROM conversations WHERE conv_id IS NOT NULL
),
shares AS (
    SELECT conv_id, count(*) AS own, CAST({_CRC.format("conv_id")} % 4 AS BIGINT) AS share FROM turns GROUP BY conv_id
),
led AS (
    SELECT s.conv_id, t.pos, t.role, t.text
    FROM shares s JOIN turns t ON t.conv_id = s.conv_id - s.conv_id % 20 AND t.pos <= s.share
),
rebuilt AS (
    SELECT conv_id, pos AS depth, role, text FROM led
    UNION ALL
    SELECT t.conv_id, coalesce(n, 0) + t.pos - s.share, role, text
    FROM turns t JOIN shares s USING (conv_id)
    LEFT JOIN (SELECT conv_id, count(*) AS n FROM led GROUP BY conv_id) USING (conv_id)
    WHERE t.pos > s.share
),
whole AS (
    SELECT s.conv_id, coalesce(said, []) AS said
    FROM shares s LEFT JOIN (
        SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY depth) AS said FROM rebuilt GROUP BY conv_id
    ) USING (conv_id)
),
prefixes AS MATERIALIZED (
    SELECT conv_id, depth, len(said) = depth AS ends, said[1:depth] AS path
    FROM whole, unnest(range(len(said) + 1)) AS r(depth)
),
nodes AS MATERIALIZED (
    SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
           sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256,
           CASE WHEN depth = 0 THEN 0 ELSE len(regexp_extract_all(path[depth].text, '{WORD}')) END AS n_words
    FROM prefixes GROUP BY path, depth
),
linked AS MATERIALIZED (
    SELECT n.*, p.conv_id AS parent_conv_id, coalesce(k, 0) AS n_children
    FROM nodes n LEFT JOIN nodes p ON n.depth > 0 AND p.path = n.path[1:n.depth - 1]
    LEFT JOIN (SELECT path[1:depth - 1] AS path, count(*) AS k FROM nodes WHERE depth > 0 GROUP BY 1) c ON c.path = n.path
),
sums AS (
    SELECT p.path, sum(CAST(n.n_children = 0 AS BIGINT)) AS n_leaves, sum((n.n_convs - 1) * n.n_words) AS saved_tokens
    FROM linked n JOIN prefixes p ON p.conv_id = n.conv_id AND p.depth <= n.depth GROUP BY p.path
)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
FROM linked JOIN sums USING (path)
"""

OP12 = """
WITH rests AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
),
parts AS (
    SELECT row_number() OVER () AS n, page_id,
           translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM rests
),
rules(rule_host, rule_path, said) AS (
    VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
)
SELECT page_id, host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
       coalesce(arg_max(said, length(rule_host || rule_path)), 'allow') AS verdict
FROM parts LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
GROUP BY n, page_id, host, path
"""


def _round(n: int) -> str:
    return f"""
near_{n} AS MATERIALIZED (
    SELECT id, p, min(d * 256 + e) AS best FROM (
        SELECT id, p, e, CAST(sum((x - c) * (x - c)) AS BIGINT) AS d
        FROM numbers JOIN book_{n} USING (p, i) GROUP BY id, p, e
    ) GROUP BY id, p
)"""


def _moved(n: int) -> str:
    return f"""
book_{n + 1} AS MATERIALIZED (
    SELECT p, e, i, CASE WHEN k IS NULL THEN c ELSE (total - ((total % k) + k) % k) // k END AS c
    FROM book_{n} LEFT JOIN (
        SELECT p, best % 256 AS e, i, CAST(sum(x) AS BIGINT) AS total, count(*) AS k
        FROM near_{n} JOIN numbers USING (id, p) GROUP BY p, best % 256, i
    ) USING (p, e, i)
)"""


OP13 = (
    """
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY vec_id) - 1 AS id, vec_id, label,
           list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
numbers AS MATERIALIZED (
    SELECT id, (k * 4) // len(v) AS p, k % (len(v) // 4) AS i, v[k + 1] AS x
    FROM kept, unnest(range(len(v))) AS r(k)
),
book_0 AS MATERIALIZED (SELECT p, id AS e, i, x AS c FROM numbers WHERE id < 256),"""
    + ",".join(part for n in range(4) for part in (_round(n), _moved(n)))
    + ","
    + _round(4)
    + """,
coded AS MATERIALIZED (
    SELECT id, string_agg(printf('%02x', best % 256), '' ORDER BY p) AS code, CAST(sum(best // 256) AS BIGINT) AS error
    FROM near_4 GROUP BY id
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY p, e, i)) FROM book_4) AS codebooks_sha256
FROM coded JOIN kept USING (id)
"""
)

ORACLE_SQL = {
    "op1_warc_index": OP1,
    "op3_substring_dedup": OP3,
    "op4_ngram_jaccard_join": OP4,
    "op5_suffix_array_dedup": OP5,
    "op11_conversation_prefix_trie": OP11,
    "op12_url_filters": OP12,
    "op13_vector_code_compression": OP13,
}
