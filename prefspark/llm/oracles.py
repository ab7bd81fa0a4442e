"""DuckDB SQL for the corpus queries that SQL can express.

Ids of tokenizers (3, 4, 9), offsets of patterns with checks (7, 10) and a fitted model (8)
can't be; those queries are tested against brute force, round trips and held-out rows.
"""

from __future__ import annotations

from functools import reduce

from prefspark.llm import quality_rules, warc


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), i AS (
  SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), starts AS (
  SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS k FROM i WHERE len(w) > 0
), phrases AS (
  SELECT DISTINCT item_id, n, array_to_string(w[k : k + n - 1], ' ') AS p FROM starts
), places AS (
  SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM phrases)
), found AS (
  SELECT doc_id, k, n, item_id FROM (SELECT doc_id, k, n, array_to_string(w[k : k + n - 1], ' ') AS p FROM places)
  JOIN phrases USING (n, p)
), hit AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS pos FROM found) GROUP BY doc_id
), listed AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN listed USING (doc_id)
"""

_HTML_TEXT = reduce(
    lambda text, step: f"regexp_replace({text}, {_quoted(step[0])}, {_quoted(step[1])}, 'g')", warc.TO_TEXT, "payload"
)
_UUID = "'<urn:uuid:' || m[1:8] || '-' || m[9:12] || '-' || m[13:16] || '-' || m[17:20] || '-' || m[21:32] || '>'"

OP2 = rf"""
WITH r AS (
  SELECT page_id, coalesce(url, '') AS target_uri, coalesce(html, '') AS payload,
    md5('response|' || CAST(page_id AS VARCHAR) || '|' || coalesce(url, '')) AS m FROM pages
), s AS (
  SELECT page_id, target_uri, payload, {_UUID} AS refers_to,
    'HTTP/1.1 200 OK' || chr(13) || chr(10) || 'Content-Type: text/html; charset=utf-8' || chr(13) || chr(10)
      || 'Content-Length: ' || strlen(payload) || chr(13) || chr(10) AS source_headers,
    'sha256:' || sha256(payload) AS payload_digest FROM r
), b AS (
  SELECT s.*, 'metadata' AS record_type, 'application/warc-fields' AS content_type,
    array_to_string(list_concat(
      ['title: ' || trim(regexp_replace(regexp_extract(payload, {_quoted(warc.TITLE)}, 1), '\s+', ' ', 'g'))],
      list_transform(regexp_extract_all(payload, {_quoted(warc.LINK)}, 1), lambda x: 'outlink: ' || x)), chr(13) || chr(10)) AS block FROM s
  UNION ALL
  SELECT s.*, 'conversion', 'text/plain', {_HTML_TEXT} FROM s
), n AS (
  SELECT *, md5(record_type || '|' || refers_to) AS m FROM b
)
SELECT page_id, record_type, {_UUID} AS record_id, refers_to, target_uri, source_headers, payload_digest, content_type,
  CAST(strlen(block) AS BIGINT) AS content_length, 'sha256:' || sha256(block) AS block_digest, block FROM n
"""

_SPACE = r"[ \t-\r]+"
_NORMALISED = f"trim(regexp_replace(regexp_replace(lower(x), '[0-9]+', '0', 'g'), '{_SPACE}', ' ', 'g'))"

OP5 = rf"""
WITH t AS (
  SELECT doc_id, source, text, coalesce(text, '') AS s, regexp_extract_all(coalesce(text, ''), '[^ \t-\r]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \t-\r]')) AS l FROM documents
), places AS (
  SELECT doc_id, k, array_to_string(w[k : k + 7], ' ') AS p FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS k FROM t)
), twice AS (
  SELECT doc_id, k FROM places QUALIFY count(*) OVER (PARTITION BY doc_id, p) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT pos) AS n FROM (SELECT doc_id, unnest(range(k, k + 8)) AS pos FROM twice) GROUP BY doc_id
), lines AS (
  SELECT doc_id, source, text, {_NORMALISED} AS line, len(regexp_extract_all(x, '[^ \t-\r]+')) AS words
  FROM (SELECT doc_id, source, text, unnest(l) AS x FROM t)
), frequent AS (
  SELECT source, line, min(doc_id) AS first FROM lines GROUP BY ALL HAVING count(DISTINCT text) > {quality_rules.LINE_LIMIT}
), taken AS (
  SELECT doc_id, sum(words) AS words FROM lines JOIN frequent
  ON lines.source IS NOT DISTINCT FROM frequent.source AND lines.line = frequent.line WHERE doc_id <> first GROUP BY doc_id
), counted AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(s) - length(regexp_replace(s, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
    CAST(len(w) - coalesce(taken.words, 0) AS BIGINT) AS n_left_words
  FROM t LEFT JOIN covered USING (doc_id) LEFT JOIN taken USING (doc_id)
)
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND 100 * n_left_words >= {quality_rules.LEAST_LEFT} * n_words AS kept
FROM counted
"""

OP6 = rf"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^ \t-\r]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[k : k + 3], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS k FROM t WHERE len(w) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 80 * (na.n + nb.n - count(*))
), reach AS (
  SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), least_id AS (
  SELECT a AS doc_id, least(a, min(b)) AS least_id FROM reach GROUP BY a
)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(least_id, doc_id) AS component_id,
  coalesce(least_id, doc_id) = doc_id AS kept
FROM t LEFT JOIN n USING (doc_id) LEFT JOIN least_id USING (doc_id)
"""

OP12 = rf"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, {_LOWER.format("coalesce(text, '')")} AS t FROM documents
), p AS (
  SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d
), w AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p
), totals AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang
), pos AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w WHERE len(w) > 0
), grams AS (
  SELECT lang, array_to_string(w[i : i + k - 1], ' ') AS phrase, k AS size
  FROM pos, (SELECT unnest([1, 2, 3]) AS k) WHERE i + k - 1 <= len(w)
), f AS (
  SELECT lang, phrase, size, count(*) AS f FROM grams GROUP BY lang, phrase, size HAVING count(*) >= 10
), c AS (
  SELECT lang, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size >= 2
), cuts AS (
  SELECT lang, phrase, a, k, array_to_string(w[1 : k], ' ') AS lp, array_to_string(w[k + 1 : len(w)], ' ') AS rp
  FROM c, (SELECT unnest([1, 2]) AS k) WHERE k < len(w)
), scored AS (
  SELECT cuts.lang, cuts.phrase, a, k, fl.f AS l, fr.f AS r,
    CAST((CAST(a AS HUGEINT) * a * 1000000) // (CAST(fl.f AS HUGEINT) * fr.f) AS BIGINT) AS score
  FROM cuts JOIN f fl ON fl.lang = cuts.lang AND fl.phrase = cuts.lp JOIN f fr ON fr.lang = cuts.lang AND fr.phrase = cuts.rp
), best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS o FROM scored) WHERE o = 1
), covering AS (
  SELECT lang, inner_phrase, max(a) AS fl FROM (
    SELECT lang, array_to_string(w[1 : 2], ' ') AS inner_phrase, a FROM c WHERE len(w) = 3
    UNION ALL SELECT lang, array_to_string(w[2 : 3], ' '), a FROM c WHERE len(w) = 3
  ) GROUP BY lang, inner_phrase
), kept AS (
  SELECT best.* FROM best LEFT JOIN covering ON covering.lang = best.lang AND covering.inner_phrase = best.phrase
  WHERE covering.fl IS NULL OR 100 * covering.fl < 50 * best.a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT ranked.lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
  n, score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

ORACLES = {
    "op1_decontamination": OP1,
    "op2_warc_derivatives": OP2,
    "op5_quality_rules": OP5,
    "op6_near_duplicates": OP6,
    "op12_collocations": OP12,
}
