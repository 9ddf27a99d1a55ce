"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations

OP1 = r"""
WITH split AS (
  SELECT row_number() OVER () AS r, doc_id, text, {'doc_id': doc_id, 'text_key': coalesce(('0x' || md5(text)[1:15])::BIGINT, -1)} AS doc,
    string_split(text, chr(10)) AS lines FROM documents
), each AS (
  SELECT r, doc, unnest(range(len(lines))) AS line_no, unnest(lines) AS line FROM split
), heads AS (
  SELECT line, length(line) AS n, min({'doc': doc, 'line_no': line_no}) AS place
  FROM each WHERE length(line) >= 20 OR regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY line
), long AS (
  SELECT *, 1 AS e FROM heads WHERE n >= 20
), met AS (
  SELECT a.line AS x, b.line AS y, a.e, a.place AS px, b.place AS py
  FROM long a JOIN (SELECT *, unnest([0, 1]) AS d FROM long) b
    ON b.n - b.d = a.n AND d <= a.e AND (d > 0 OR a.place < b.place) AND (contains(b.line, substr(a.line, 1, a.n // 2)) OR contains(b.line, substr(a.line, 1 + a.n // 2)))
), one_byte_letters AS (
  SELECT *, array_to_string(list_distinct(list_filter(string_split(x || y, ''), lambda c: ord(c) > 127)), '') AS wide,
    array_to_string(list_transform(list_concat(range(1, 9), range(14, 32)), lambda c: chr(c::INTEGER)), '') AS marks FROM met
), later AS (
  SELECT DISTINCT greatest(px, py) AS place FROM one_byte_letters
  WHERE levenshtein(translate(x, wide, left(marks, length(wide))), translate(y, wide, left(marks, length(wide)))) <= e
), kept AS (
  SELECT place FROM heads WHERE place NOT IN (SELECT place FROM later)
), marked AS (
  SELECT r, line_no, line, (length(line) < 20 AND NOT regexp_matches(line, '[^\x20\x09-\x0D]')) OR k.place IS NOT NULL AS stays
  FROM each LEFT JOIN kept k ON k.place = {'doc': each.doc, 'line_no': each.line_no}
)
SELECT any_value(doc_id) AS doc_id, count(line_no) AS n_lines, count(line_no) FILTER (NOT stays) AS n_removed,
  CASE WHEN any_value(text) IS NOT NULL THEN sha256(coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (stays), '')) END AS kept_sha256
FROM split LEFT JOIN marked USING (r) GROUP BY r
"""

OP3 = r"""
WITH split AS (
  SELECT page_id, url,
    CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages
), parts AS (
  SELECT row_number() OVER () AS r, page_id, url,
    coalesce(translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM split
), ruled AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM parts
), judged AS (
  SELECT *, CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS explicit,
    list_sort(list_distinct(list_filter(
      list_transform(string_split(host, '.'), lambda x: 'host:' || x)
      || list_transform(string_split(regexp_replace(path, '[0-9]+', '#', 'g'), '/'), lambda x: 'path:' || x)
      || list_transform(string_split(regexp_extract(coalesce(url, ''), '\?([^#]*)', 1), '&'), lambda x: 'name:' || string_split(x, '=')[1])
      || CASE WHEN instr(coalesce(url, ''), '#') > 0 THEN ['mark:#'] ELSE [] END,
      lambda x: x NOT IN ('host:', 'path:', 'name:')))) AS tokens
  FROM ruled
), texts AS (
  SELECT 'd' AS kind, row_number() OVER () AS k, doc_id, NULL AS url, text FROM documents
  UNION ALL
  SELECT 'p', row_number() OVER (), NULL, url,
    replace(replace(replace(replace(replace(replace(regexp_replace(
      CASE WHEN regexp_matches(html, '(?is)<article\b[^>]*>.*?</article>') THEN array_to_string(regexp_extract_all(html, '(?is)<article\b[^>]*>(.*?)</article>', 1), ' ') ELSE html END,
      '(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>|<[^>]*>', ' ', 'g'),
      '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&')
  FROM (SELECT DISTINCT url, html FROM pages WHERE url IS NOT NULL)
), worded AS (
  SELECT kind, k, doc_id, url, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM texts
), cuts AS (
  SELECT *, len(w) AS n, list_filter(range(1, len(w) + 1), lambda i: i = 1 OR (31 * unicode(w[i]) + length(w[i])) % 8 = 0) AS starts FROM worded
), places AS (
  SELECT *, unnest(range(1, len(starts) + 1)) AS place FROM cuts
), passages AS (
  SELECT kind, k, doc_id, url, n, place, coalesce(starts[place + 1], n + 1) - starts[place] AS size,
    array_to_string(w[starts[place]:coalesce(starts[place + 1], n + 1) + 6], ' ') AS said FROM places
), rated AS (
  SELECT doc_id, max(bad) AS bad FROM (
    SELECT doc_id, CASE WHEN quality = 0 OR toxic = 1 THEN 1 WHEN quality = 1 OR toxic = 0 THEN 0 END AS bad FROM labels)
  WHERE doc_id IS NOT NULL AND bad IS NOT NULL GROUP BY doc_id
), known AS (
  SELECT size, said, avg(bad) AS bad FROM passages JOIN rated USING (doc_id) WHERE kind = 'd' GROUP BY size, said
), evidence AS (
  SELECT p.url, avg(bad) > 0.5 AS blocked FROM passages p JOIN known USING (size, said) WHERE kind = 'p'
  GROUP BY k, p.url, n HAVING 100 * sum(size) >= 50 * n
), examples AS (
  SELECT row_number() OVER () AS id, tokens, blocked FROM evidence JOIN (SELECT DISTINCT url, tokens FROM judged) USING (url)
), each AS (SELECT id, blocked, unnest(tokens) AS token FROM examples
), least AS (SELECT greatest(1, ceil(0.01 * count(*))) AS least FROM examples
), common AS (
  SELECT token, count(*) FILTER (blocked) AS b, count(*) FILTER (blocked) / count(*) AS confidence FROM each GROUP BY token
  HAVING count(*) FILTER (blocked) >= (SELECT least FROM least)
), best AS (
  SELECT id, blocked, list(token ORDER BY confidence DESC, b DESC, token)[1:10] AS items FROM each JOIN common USING (token) WHERE confidence < 0.9 GROUP BY id, blocked
), subsets AS (
  SELECT list_sort(list_filter(items, lambda x, i: (mask >> (i - 1)) & 1 = 1)) AS part, blocked
  FROM (SELECT items, blocked, unnest(range(1, (1 << len(items))::BIGINT)) AS mask FROM best)
), confident AS (
  SELECT part FROM subsets WHERE len(part) > 1 GROUP BY part
  HAVING count(*) FILTER (blocked) >= (SELECT least FROM least) AND count(*) FILTER (blocked) / count(*) >= 0.9
), learned AS (
  SELECT part FROM confident a WHERE NOT EXISTS (SELECT 1 FROM confident b WHERE b.part <> a.part AND list_has_all(a.part, b.part))
  UNION ALL SELECT [token] FROM common WHERE confidence >= 0.9
), hits AS (
  SELECT r, count(*) AS n_learned FROM judged JOIN learned ON list_has_all(tokens, part) WHERE explicit IS NULL GROUP BY r
)
SELECT page_id, host, path, rule, coalesce(explicit, CASE WHEN n_learned > 0 THEN 'block' ELSE 'allow' END) AS verdict,
  coalesce(n_learned, 0) AS n_learned
FROM judged LEFT JOIN hits USING (r)
"""

OP5 = r"""
WITH words AS (
  SELECT 'd' AS kind, doc_id AS id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
  UNION ALL
  SELECT 'b', item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '') FROM benchmark
), own AS (
  SELECT DISTINCT kind, id, CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [len(w)::VARCHAR || ' ' || array_to_string(w, ' ')] END AS own FROM words
), docs AS (SELECT id AS doc_id, own, len(own) AS n FROM own WHERE kind = 'd' AND own IS NOT NULL
), items AS (SELECT id AS item_id, own AS asked, len(own) AS m FROM own WHERE kind = 'b' AND own IS NOT NULL
), places AS (
  SELECT doc_id, item_id, count(*) AS hits
  FROM (SELECT doc_id, unnest(own) AS h FROM docs) JOIN (SELECT DISTINCT item_id, h FROM (SELECT item_id, unnest(asked) AS h FROM items)) USING (h)
  GROUP BY doc_id, item_id
), pairs AS (
  SELECT *, least(n, m) AS w FROM places JOIN docs USING (doc_id) JOIN items USING (item_id) WHERE 175 * hits >= 75 * (m + least(n, m))
), windows AS (
  SELECT doc_id, item_id, m, w, asked, start, own[start + 1:start + w] AS part
  FROM (SELECT *, unnest(range(0, n - w + 1)) AS start FROM pairs)
), counted AS (
  SELECT doc_id, item_id, m, w, start, sum(least(x, len(list_filter(asked, lambda v: v = h))))::BIGINT AS n_shared
  FROM (SELECT doc_id, item_id, m, w, start, asked, h, count(*) AS x
        FROM (SELECT doc_id, item_id, m, w, start, asked, unnest(part) AS h FROM windows) GROUP BY ALL)
  GROUP BY ALL
), best AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n_shared DESC, start) AS r FROM counted
  WHERE 175 * n_shared >= 75 * (m + w)
)
SELECT doc_id, item_id, start AS start_shingle, n_shared, n_shared / (m + w - n_shared) AS similarity FROM best WHERE r = 1
"""

OP8 = r"""
WITH said AS (
  SELECT conv_id, turn, CASE WHEN trim(coalesce(role, '')) = '' THEN 'unknown' ELSE role END AS speaker,
    replace(coalesce(text, ''), '<|', '< |') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), seats AS (
  SELECT DISTINCT conv_id, speaker AS participant FROM said WHERE speaker <> 'system'
), lines AS (
  SELECT conv_id, participant, turn, speaker, text, speaker = participant AS own,
    CASE WHEN speaker = participant THEN '<|assistant|>' WHEN speaker = 'system' THEN '<|system|>'
      ELSE '<|user name="' || replace(replace(replace(replace(replace(replace(replace(speaker, '%', '%25'), '"', '%22'), '<', '%3C'), '|', '%7C'), '>', '%3E'),
        chr(10), '%0A'), chr(13), '%0D') || '"|>' END || chr(10) AS head, text || '<|end|>' || chr(10) AS body
  FROM said JOIN seats USING (conv_id)
)
SELECT conv_id, participant, count(*) AS n_turns,
  string_agg(head || body, '' ORDER BY turn NULLS FIRST, speaker, text) AS rendered,
  string_agg(repeat('0', length(head)) || repeat(CASE WHEN own THEN '1' ELSE '0' END, length(body)), ''
             ORDER BY turn NULLS FIRST, speaker, text) AS mask,
  coalesce(sum(length(body)) FILTER (own), 0)::BIGINT AS n_trained
FROM lines GROUP BY conv_id, participant
"""

OP11 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents
), q AS (
  SELECT row_number() OVER () AS i, item_id,
    unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), asked AS (SELECT i, item_id, term, count(*) AS repeats FROM q GROUP BY i, item_id, term
), totals AS (SELECT count(*)::BIGINT AS nn, sum(len(t))::BIGINT AS ll FROM d WHERE len(t) > 0
), tf AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM asked) GROUP BY r, term
), weights AS (
  SELECT term, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, totals GROUP BY term, nn
), scored AS (
  SELECT i, item_id, r, doc_id, sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * len(t) * nn) // ll))))::BIGINT AS score
  FROM asked JOIN tf USING (term) JOIN weights USING (term) JOIN d USING (r), totals GROUP BY ALL
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""

OP13 = r"""
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS codes
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_inner_product(a.codes, b.codes)::BIGINT AS score
  FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND a.vec_id % 50 = 0
), near AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) AS place
  FROM pairs WHERE same
), met AS (
  SELECT n.anchor_id, positive_id, other_id AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (PARTITION BY n.anchor_id, positive_id ORDER BY score DESC, other_id) AS rank
  FROM near n JOIN pairs p ON p.anchor_id = n.anchor_id AND NOT same AND place <= 5 AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM met WHERE rank <= 3
"""

ORACLE_SQL: dict[str, str] = {"op1_line_dedup": OP1, "op3_url_filter": OP3, "op5_benchmark_decontamination": OP5, "op8_chat_rotation": OP8, "op11_ranked_search": OP11, "op13_hard_negatives": OP13}
