"""DuckDB SQL for the queries that SQL can express."""

from .quality import STOP_WORDS
from .secrets import RULES

_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"
_STOPS = "[" + ", ".join(f"'{w}'" for w in dict.fromkeys([*STOP_WORDS, *(w.capitalize() for w in STOP_WORDS)])) + "]"

OP2 = rf"""
WITH split AS (
  SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text, {_WORDS} AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
places AS (
  SELECT row_id, unnest(range(1, len(words) - 1)) AS i, words FROM split WHERE len(words) >= 3),
windows AS (
  SELECT row_id, i, count(*) OVER (PARTITION BY row_id, words[i], words[i + 1], words[i + 2]) AS n FROM places),
repeats AS (
  SELECT row_id, count(DISTINCT p) AS n FROM (SELECT row_id, unnest([i, i + 1, i + 2]) AS p FROM windows WHERE n > 1) GROUP BY row_id),
counted AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
         len(lines) AS n_lines, len(list_filter(words, lambda w: list_contains({_STOPS}, w))) AS n_stops,
         len(regexp_extract_all(text, '!!')) AS n_shouts
  FROM split LEFT JOIN repeats USING (row_id)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND n_words BETWEEN 50 AND 1000000
       AND word_chars / n_words BETWEEN 2 AND 12 AND n_symbols / n_words <= 0.20 AND n_stops / n_words >= 0.02
       AND coalesce(n_dup_lines / nullif(n_lines, 0), 0) <= 0.30 AND n_shouts / n_words <= 0.50 AND n_repeat_words / n_words <= 0.50 AS kept
FROM judged
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _span_sql() -> str:
    """A row for each span: places by the lengths of what lies between matches, as in the operator."""
    parts = []
    for rank, rule in enumerate(RULES):
        pattern = _quoted(rule.pattern)
        parts.append(f"""
  SELECT row_id, {rank} AS rank, '{rule.kind}' AS kind,
         list_sum(list_transform(between_[1:j], lambda b: length(b))) + coalesce(list_sum(list_transform(whole[1:j - 1], lambda b: length(b))), 0) AS s,
         length(whole[j]) AS n, length(judged[j]) AS g
  FROM (SELECT row_id, whole, judged, between_, unnest(range(1, len(whole) + 1)) AS j FROM (
    SELECT row_id, regexp_extract_all(text, {pattern}) AS whole, regexp_extract_all(text, {pattern}, {rule.group}) AS judged,
           regexp_split_to_array(text, {pattern}) AS between_ FROM docs))
  WHERE length(judged[j]) >= {rule.least}""")
    return " UNION ALL ".join(parts)


OP3 = f"""
WITH docs AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents),
spans AS ({_span_sql()}),
per_doc AS (
  SELECT row_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || s::BIGINT || ':' || (s + n)::BIGINT, ',' ORDER BY s, rank) FILTER (rank < 3) AS base,
         string_agg(kind || ':' || s::BIGINT || ':' || (s + n)::BIGINT, ',' ORDER BY s, rank) AS spans
  FROM spans GROUP BY row_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN per_doc USING (row_id)
"""

OP10 = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

OP1 = r"""
WITH docs AS (SELECT row_number() OVER () AS row_id, doc_id, source, coalesce(source, '') AS host, text, string_split(text, chr(10)) AS lines FROM documents),
pages AS (SELECT host, count(*) AS pages FROM docs GROUP BY host),
cut AS (SELECT row_id, host, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM docs WHERE text IS NOT NULL),
bare AS (SELECT *, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS key FROM cut),
often AS (
  SELECT host, key FROM (SELECT DISTINCT row_id, host, key FROM bare WHERE key <> '') JOIN pages USING (host)
  GROUP BY host, key, pages HAVING count(*) >= 5 AND count(*) > pages * 0.2),
clean AS (
  SELECT row_id, count(*) AS n_lines, count(*) FILTER (o.key IS NOT NULL) AS n_dropped, string_agg(line, chr(10) ORDER BY i) FILTER (o.key IS NULL) AS clean_text
  FROM bare b LEFT JOIN often o ON b.host = o.host AND b.key = o.key GROUP BY row_id)
SELECT doc_id, source, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dropped, 0)::BIGINT AS n_dropped, coalesce(clean_text, '') AS clean_text
FROM docs LEFT JOIN clean USING (row_id)
"""

OP6 = rf"""
WITH docs AS (SELECT row_number() OVER () AS row_id, doc_id, {_WORDS} AS words FROM documents),
places AS (SELECT row_id, words, unnest(range(1, len(words) - 33)) AS i FROM docs WHERE len(words) >= 35),
windows AS (SELECT row_id, i, count(*) OVER (PARTITION BY array_to_string(words[i:i + 34], ' ')) AS n FROM places),
gone AS (SELECT DISTINCT row_id, unnest(range(i, i + 35)) AS p FROM windows WHERE n > 1),
placed AS (SELECT row_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM docs),
kept AS (
  SELECT row_id, count(*) FILTER (gone.p IS NOT NULL) AS n_removed, string_agg(word, ' ' ORDER BY p) FILTER (gone.p IS NULL) AS text
  FROM placed LEFT JOIN gone USING (row_id, p) GROUP BY row_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256 FROM docs LEFT JOIN kept USING (row_id)
"""

OP9 = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents),
places AS (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM docs WHERE len(words) > 0),
sets AS (SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') || '/' || least(len(words), 5) AS shingle FROM places),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
met AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS both_ FROM sets a JOIN sets b USING (shingle) WHERE a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT u, v FROM met JOIN sizes a ON a.doc_id = u JOIN sizes b ON b.doc_id = v WHERE 100 * both_ >= 75 * (a.n + b.n - both_)),
ways AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach(doc_id, to_id) AS (SELECT doc_id, doc_id FROM docs UNION SELECT r.doc_id, w.v FROM reach r JOIN ways w ON r.to_id = w.u)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM docs d LEFT JOIN sizes USING (doc_id) JOIN (SELECT doc_id, min(to_id) AS component_id FROM reach GROUP BY doc_id) c ON c.doc_id = d.doc_id
"""

SQL = {"op6_substring_dedup": OP6, "op9_minhash_near_dedup": OP9, "op1_line_dedup": OP1, "op2_quality_rules": OP2, "op3_secret_scans": OP3, "op10_exact_dedup": OP10}
