"""Expected results of the queries as DuckDB SQL, where SQL can express them.

Fingerprints (XXH64), ids of a vocabulary, hashed n-grams and trained models have no form in SQL;
tests compare those queries with brute force, a round trip or held-out labels.
"""

from __future__ import annotations

FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NORMAL = r"trim(regexp_replace(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ')"

#: Lines, and sentences of 5 words or more, each cut into its parts on the lines.
LINE_DEDUP = rf"""
WITH units AS (
  SELECT doc_id, generate_subscripts(parts, 1) AS unit, unnest(parts) AS unit_text
  FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE text <> '')
), normal AS (
  SELECT doc_id, unit, unit_text, {NORMAL.format("unit_text")} AS line FROM units
), lines AS (
  SELECT *, line <> '' AND row_number() OVER (PARTITION BY line ORDER BY doc_id, unit) > 1 AS line_gone FROM normal
), sentences AS (
  SELECT doc_id, generate_subscripts(parts, 1) AS sentence, unnest(parts) AS sentence_text
  FROM (
    SELECT doc_id, string_split(regexp_replace(text, '([.!?][\x20\x09-\x0D]+)', '\1' || chr(1), 'g'), chr(1)) AS parts
    FROM documents WHERE text <> ''
  )
), known AS (
  SELECT doc_id, sentence, sentence_text, {NORMAL.format("sentence_text")} AS words FROM sentences
), judged AS (
  SELECT *, len(string_split(words, ' ')) >= 5 AND row_number() OVER (PARTITION BY words ORDER BY doc_id, sentence) > 1 AS sentence_gone,
    string_split(sentence_text, chr(10)) AS parts
  FROM known
), placed AS (
  SELECT *, coalesce(sum(len(parts) - 1) OVER (PARTITION BY doc_id ORDER BY sentence ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM judged
), atoms AS (
  SELECT doc_id, sentence, sentence_gone, before + generate_subscripts(parts, 1) AS unit, unnest(parts) AS atom FROM placed
), marked AS (
  SELECT a.*, line_gone, sentence_gone AND NOT line_gone AND atom <> '' AS atom_gone FROM atoms a JOIN lines USING (doc_id, unit)
), kept_lines AS (
  SELECT doc_id, unit, line_gone, sum(length(atom)) FILTER (line_gone OR atom_gone) AS chars,
    coalesce(string_agg(atom, '' ORDER BY sentence) FILTER (NOT atom_gone), '') AS rest
  FROM marked GROUP BY doc_id, unit, line_gone
), rebuilt AS (
  SELECT doc_id, count(*) AS n_units, count_if(line_gone) AS lines_removed, sum(chars) AS chars_removed,
    string_agg(rest, chr(10) ORDER BY unit) FILTER (NOT line_gone) AS kept
  FROM kept_lines GROUP BY doc_id
), sentences_removed AS (
  SELECT doc_id, count(DISTINCT sentence) AS n FROM marked WHERE atom_gone GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_units, 0)::BIGINT AS n_units, (coalesce(lines_removed, 0) + coalesce(n, 0))::BIGINT AS n_removed,
  coalesce(chars_removed, 0)::BIGINT AS chars_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN rebuilt USING (doc_id) LEFT JOIN sentences_removed USING (doc_id)
"""

#: Bytes as two hex digits each.
SUBSTRING_DEDUP = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
chunks AS (
  SELECT doc_id, 512 * b AS base, substr(h, 1024 * b + 1, 1122) AS c FROM d, unnest(range(0, len(h) // 1024 + 1)) AS t(b)
),
places AS (
  SELECT doc_id, base + i AS o, substr(c, 2 * i + 1, 100) AS s
  FROM chunks, unnest(range(0, least(512, len(c) // 2 - 49))) AS t(i) WHERE len(c) >= 100
),
firsts AS (SELECT s, min(doc_id) AS first_doc FROM places GROUP BY s),
hits AS (SELECT doc_id, o FROM places JOIN firsts USING (s) WHERE first_doc < doc_id),
marked AS (
  SELECT doc_id, o, CASE WHEN o - lag(o) OVER (PARTITION BY doc_id ORDER BY o) <= 50 THEN 0 ELSE 1 END AS new FROM hits
),
spans AS (
  SELECT doc_id, min(o) AS first, max(o) + 50 AS last
  FROM (SELECT doc_id, o, sum(new) OVER (PARTITION BY doc_id ORDER BY o) AS run FROM marked) GROUP BY doc_id, run
),
gaps AS (
  SELECT doc_id, coalesce(lag(last) OVER (PARTITION BY doc_id ORDER BY first), 0) AS start, first AS until FROM spans
  UNION ALL SELECT doc_id, max(last), NULL FROM spans GROUP BY doc_id
),
rests AS (
  SELECT doc_id, string_agg(substr(h, 2 * start + 1, 2 * (coalesce(until, len(h) // 2) - start)), '' ORDER BY start) AS rest
  FROM gaps JOIN d USING (doc_id) GROUP BY doc_id
),
totals AS (SELECT doc_id, sum(last - first) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(rest, h))) AS kept_sha256
FROM d LEFT JOIN totals USING (doc_id) LEFT JOIN rests USING (doc_id)
"""

WORDS = r"regexp_extract_all(" + FOLDED + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = rf"""
WITH items AS (SELECT item_id, {WORDS} AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + 9], ' ') AS win, least(len(w), 10) AS size
  FROM items, unnest(range(1, greatest(len(w) - 8, 2))) AS t(i) WHERE len(w) > 0
),
sizes AS (SELECT DISTINCT size FROM item_windows),
doc_words AS (SELECT doc_id, {WORDS} AS w FROM documents),
places AS (
  SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS win
  FROM doc_words, sizes, unnest(range(1, greatest(len(w) - size + 2, 1))) AS t(i)
),
hits AS (SELECT DISTINCT doc_id, i, size, item_id FROM places JOIN item_windows USING (win, size)),
hit_words AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS k FROM (SELECT DISTINCT doc_id, i, size FROM hits)) GROUP BY doc_id
),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

SOURCE_MIX = r"""
WITH RECURSIVE slim AS (
  SELECT coalesce('s' || source, 'n') AS key, source, doc_id, md5(coalesce(text, '')) AS content,
    count(*) AS copies, sum(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')))::BIGINT AS n_tokens
  FROM documents GROUP BY ALL
),
shares AS (
  SELECT key, sum(n_tokens)::BIGINT AS tokens, count(*) AS n_docs,
    sum(n_tokens) / sum(sum(n_tokens)) OVER ()::DOUBLE AS p
  FROM slim GROUP BY key
),
ends AS (
  SELECT round(0.9 * round(ln(count(*)), 9), 9) AS target, round(-sum(p * ln(p)), 9) AS plain, min(p) AS least, max(p) AS most
  FROM shares WHERE tokens > 0
),
by_entropy AS (
  SELECT 0 AS i, 0.0::DOUBLE AS low, 1.0::DOUBLE AS high
  UNION ALL
  SELECT i + 1, CASE WHEN h >= target THEN mid ELSE low END, CASE WHEN h >= target THEN high ELSE mid END
  FROM (
    SELECT i, low, high, (low + high) / 2 AS mid, target,
      (SELECT round(ln(sum(pow(p, (low + high) / 2))) - (low + high) / 2 * sum(pow(p, (low + high) / 2) * ln(p)) / sum(pow(p, (low + high) / 2)), 9)
       FROM shares WHERE tokens > 0) AS h
    FROM by_entropy, ends WHERE i < 30
  )
),
by_limit AS (
  SELECT 0 AS i, 0.0::DOUBLE AS low, 1.0::DOUBLE AS high
  UNION ALL
  SELECT i + 1, CASE WHEN r > 2.0 THEN mid ELSE low END, CASE WHEN r > 2.0 THEN high ELSE mid END
  FROM (SELECT i, low, high, (low + high) / 2 AS mid, round(pow(most / least, 1 - (low + high) / 2), 9) AS r FROM by_limit, ends WHERE i < 30)
),
exponent AS (
  SELECT greatest(
    CASE WHEN plain >= target THEN 1.0 ELSE (SELECT low FROM by_entropy WHERE i = 30) END,
    CASE WHEN round(most / least, 9) <= 2.0 THEN 0.0 ELSE (SELECT high FROM by_limit WHERE i = 30) END) AS a
  FROM ends
),
scale AS (SELECT a, sum(pow(p, a)) AS z, max(p) AS peak, (SELECT sum(tokens) FROM shares) AS n FROM shares, exponent WHERE tokens > 0 GROUP BY a),
budgets AS (
  SELECT key, tokens, n_docs,
    CASE WHEN tokens > 0 THEN greatest(floor(n * z * pow(peak, 1 - a) * (pow(p, a) / z) + 0.5)::BIGINT, tokens) ELSE 0 END AS budget
  FROM shares, scale
),
plan AS (
  SELECT key, CASE WHEN tokens > 0 THEN budget // tokens ELSE 1 END AS full_epochs,
    CASE WHEN tokens > 0 THEN budget % tokens ELSE 0 END AS rest, ceil(sqrt(n_docs))::BIGINT AS blocks
  FROM budgets
),
dealt AS (
  SELECT s.*, full_epochs, rest, ('0x' || substr(md5('17:block:' || doc_id || ':' || content), 1, 8))::BIGINT % blocks AS block, e.epoch,
    md5('17:' || e.epoch || ':' || doc_id || ':' || content) AS turn
  FROM slim s JOIN plan USING (key), unnest(range(0, full_epochs + CASE WHEN rest > 0 THEN 1 ELSE 0 END)) AS e(epoch)
),
block_starts AS (
  SELECT key, epoch, block,
    coalesce(sum(size) OVER (PARTITION BY key, epoch ORDER BY md5('17:order:' || epoch || ':' || key || ':' || block), block
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS block_start
  FROM (SELECT key, epoch, block, sum(n_tokens) AS size FROM dealt GROUP BY ALL)
),
placed AS (
  SELECT d.*, block_start + coalesce(sum(n_tokens) OVER (PARTITION BY key, epoch, block ORDER BY turn, doc_id, content
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM dealt d JOIN block_starts USING (key, epoch, block)
)
SELECT doc_id, source, copies::BIGINT AS copies, epoch::BIGINT AS epoch, start::BIGINT AS start, n_tokens::BIGINT AS n_tokens
FROM placed WHERE epoch < full_epochs OR start + n_tokens <= rest
"""

URL_PATTERN = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)(?::[0-9]*)?([^?#]*)(\?[^#]*)?"

URL_FILTER = rf"""
WITH captures AS (
  SELECT page_id, url, TIMESTAMP '2024-01-01' + to_seconds(page_id * 7919 % (366 * 86400)) AS t,
    lower(regexp_replace(regexp_extract(url, '{URL_PATTERN}', 1), '\.$', '')) AS host,
    regexp_extract(url, '{URL_PATTERN}', 2) AS path, regexp_extract(url, '{URL_PATTERN}', 3) AS query
  FROM pages
),
hosts AS (
  SELECT DISTINCT host, ('0x' || substr(md5(host), 1, 7))::BIGINT AS number FROM captures WHERE host <> ''
),
numbered AS (SELECT *, number % 300 AS day, array_to_string(string_split(host, '.')[-3:], '.') AS parent FROM hosts),
entries AS (
  SELECT list, pattern, action, TIMESTAMP '2024-01-01' + to_seconds(days * 86400 + number % 86400) AS moment FROM (
    SELECT 'spam' AS list, 'host:' || host AS pattern, 'add' AS action, day AS days, number FROM numbered WHERE number % 3 = 0
    UNION ALL SELECT 'spam', 'host:' || host, 'remove', day + 20 + number % 60, number FROM numbered WHERE number % 3 = 0
    UNION ALL SELECT 'spam', 'host:' || host, 'add', day + 90, number FROM numbered WHERE number % 6 = 0
    UNION ALL SELECT 'malware', 'prefix:' || host || '/en/', 'add', day, number FROM numbered WHERE number % 5 = 0
    UNION ALL SELECT 'trusted', 'host:' || host, 'add', day - 10, number FROM numbered WHERE number % 7 = 0
    UNION ALL SELECT 'adult', 'domain:' || parent, 'add', day, number FROM numbered WHERE number % 97 = 0
    UNION ALL SELECT 'adult', 'domain:' || parent, 'remove', day + 1, number FROM numbered WHERE number % 97 = 0
    UNION ALL SELECT 'takedown', 'url:' || c.host || path || query, 'add', page_id % 366, number
      FROM captures c JOIN hosts USING (host) WHERE page_id % 11 = 0
  )
),
changes AS (SELECT list, pattern, moment, bool_and(action = 'add') AS active FROM entries GROUP BY ALL),
intervals AS (
  SELECT *, lead(moment) OVER (PARTITION BY list, pattern ORDER BY moment) AS until FROM changes
),
offered AS (
  SELECT DISTINCT url, t, unnest(list_concat(
    ['host:' || host, 'url:' || host || path || query],
    list_transform(range(1, len(string_split(host, '.')) + 1), lambda i: 'domain:' || array_to_string(string_split(host, '.')[i:], '.')),
    list_transform(range(1, len(string_split(path, '/'))), lambda i: 'prefix:' || host || array_to_string(string_split(path, '/')[1:i], '/') || '/')
  )) AS pattern
  FROM captures WHERE host <> ''
),
verdicts AS (
  SELECT url, t, list_sort(list_distinct(list(list))) AS lists, list_sort(list_distinct(list(o.pattern))) AS patterns
  FROM offered o JOIN intervals i ON o.pattern = i.pattern AND active AND t >= moment AND (until IS NULL OR t < until)
  GROUP BY url, t
)
SELECT page_id, url, coalesce(len(lists), 0)::BIGINT AS n_lists, coalesce(array_to_string(lists, ','), '') AS lists,
  coalesce(array_to_string(patterns, ' '), '') AS patterns, coalesce(len(lists) > 0 AND NOT list_contains(lists, 'trusted'), false) AS blocked
FROM captures LEFT JOIN verdicts USING (url, t)
"""

EXPECTED: dict[str, str] = {
    "op1_line_dedup": LINE_DEDUP,
    "op2_decontamination": DECONTAMINATION,
    "op4_substring_dedup": SUBSTRING_DEDUP,
    "op9_source_mix": SOURCE_MIX,
    "op10_url_filter": URL_FILTER,
}
