"""DuckDB SQL for the rows of queries that SQL can express."""

OP6 = r"""
WITH RECURSIVE sized AS (
  SELECT row_number() OVER () AS n, doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         ('0x' || substr(md5('7|' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS u
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1 AS weight
  FROM sized GROUP BY source
), ordered AS (  -- from the source that is clamped first to the last
  SELECT source, source_size, weight, 3 * source_size AS most,
         sum(3 * source_size) OVER w - 3 * source_size AS clamped,
         sum(weight) OVER (ORDER BY 3.0::DOUBLE * source_size / weight DESC, weight, source) AS sharing,
         (SELECT sum(source_size) FROM sources) AS total,
         row_number() OVER w AS k
  FROM sources
  WINDOW w AS (ORDER BY 3.0::DOUBLE * source_size / weight, weight DESC, source DESC)
), level AS (
  SELECT (total - clamped)::DOUBLE / sharing::DOUBLE AS level FROM ordered
  WHERE most >= weight * ((total - clamped)::DOUBLE / sharing::DOUBLE) ORDER BY k LIMIT 1
), targets AS (
  SELECT source, source_size, least(3 * source_size::DOUBLE, weight * (SELECT level FROM level)) AS target
  FROM ordered
), plans AS (
  SELECT *, floor(target / nullif(source_size, 0))::BIGINT AS passes,
         round(target - floor(target / nullif(source_size, 0)) * source_size)::BIGINT AS rest
  FROM targets
), running AS (
  SELECT s.*, p.source_size, p.target, coalesce(p.passes, 0) AS passes, coalesce(p.rest, 0) AS rest,
         sum(size) OVER (PARTITION BY s.source ORDER BY u, s.doc_id, size, n
                         ROWS UNBOUNDED PRECEDING) AS so_far
  FROM sized s JOIN plans p ON s.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (passes * size + CASE WHEN 2 * so_far - size <= 2 * rest THEN size ELSE 0 END)::BIGINT AS taken
FROM running
"""

OP1 = r"""
WITH records AS (
  SELECT coalesce(floor(page_id / 1000), -1)::BIGINT AS file, page_id,
         (strlen('WARC/1.0' || 'WARC-Type: response' || 'WARC-Record-ID: <urn:page:'
                 || coalesce(page_id::VARCHAR, '') || '>' || 'WARC-Target-URI: ' || coalesce(url, '')
                 || 'Content-Length: ' || strlen(coalesce(html, ''))::VARCHAR)
          + 16 + strlen(coalesce(html, '')))::BIGINT AS length,
         substr(md5(page_id::VARCHAR), 1, 2) AS draw
  FROM pages
), placed AS (
  SELECT *, (sum(length) OVER (PARTITION BY file ORDER BY page_id) - length)::BIGINT AS "offset" FROM records
)
SELECT file, "offset", page_id, length, CASE draw WHEN 'a0' THEN 'changed' ELSE 'missing' END AS damage
FROM placed WHERE draw IN ('a0', 'b1')
UNION ALL
SELECT file, "offset" + 1, page_id, 1, 'extra' FROM placed WHERE draw = 'c2'
"""

OP3 = r"""
WITH captures AS (
  SELECT page_id, url, DATE '2024-01-01' + (page_id % 366)::INT AS fetched,
         nullif(lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '') AS host
  FROM pages
), hosts AS (
  SELECT DISTINCT host, string_split(host, '.') AS labels FROM captures WHERE host IS NOT NULL
), covers AS (
  SELECT DISTINCT host, array_to_string(labels[i:], '.') AS entry
  FROM (SELECT host, labels, unnest(range(1, len(labels) + 1)) AS i FROM hosts)
), drawn AS (
  SELECT DISTINCT entry, ('0x' || substr(md5(entry), 1, 2))::INT AS d1,
         ('0x' || substr(md5(entry), 3, 2))::INT AS d2, ('0x' || substr(md5(entry), 5, 2))::INT AS d3
  FROM covers
), changes AS (
  SELECT (['adult', 'malware', 'spam', 'allow'])[d1 % 4 + 1] AS list, entry,
         DATE '2024-01-01' + d AS day, bool_and(active) AS active
  FROM (SELECT *, d2 AS d, true AS active FROM drawn UNION ALL SELECT *, d2 + d3, false FROM drawn
        UNION ALL SELECT *, d2 + 183, true FROM drawn UNION ALL SELECT *, d2 + d3 + 183, false FROM drawn)
  GROUP BY ALL
), states AS (
  SELECT c.page_id, c.host, c.fetched, v.entry, s.list,
         (SELECT arg_max(x.active, x.day) FROM changes x
          WHERE x.entry = v.entry AND x.list = s.list AND x.day <= c.fetched) AS active
  FROM (SELECT DISTINCT host, fetched, NULL AS page_id FROM captures) c
  JOIN covers v ON v.host = c.host JOIN (SELECT DISTINCT list, entry FROM changes) s ON s.entry = v.entry
), found AS (
  SELECT host, fetched, count(*) AS n_active, array_to_string(list_sort(list(DISTINCT list)), ',') AS lists,
         arg_max(entry, length(entry)) AS entry,
         max(length(entry)) FILTER (list <> 'allow') AS deny, max(length(entry)) FILTER (list = 'allow') AS allow
  FROM states WHERE active GROUP BY ALL
)
SELECT c.page_id, c.url, c.fetched::VARCHAR AS fetched, c.host, coalesce(f.n_active, 0) AS n_active,
       coalesce(f.lists, '') AS lists, f.entry,
       coalesce(f.deny IS NOT NULL AND coalesce(f.allow, 0) < f.deny, false) AS blocked
FROM captures c LEFT JOIN found f ON f.host = c.host AND f.fetched = c.fetched
"""

# CRC-32 of texts, byte by byte; the table follows from the polynomial.
CRC_TABLE = """
crc_table AS (
  SELECT list(c ORDER BY i) AS steps FROM (
    SELECT i, list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) r(i))
)"""


def crc(bytes_in_hex: str, steps: str = "steps") -> str:
    octets = f"list_transform(range(len({bytes_in_hex}) // 2), lambda j: ('0x' || substr({bytes_in_hex}, 2 * j + 1, 2))::BIGINT)"
    step = f"xor(c >> 8, {steps}[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce([4294967295] || {octets}, lambda c, b: {step}), 4294967295)"


LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP11 = rf"""
WITH RECURSIVE {CRC_TABLE}, runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS doc, unnest(regexp_extract_all({LOWER}, '[a-z\x{{00C0}}-\x{{00FF}}]+')) AS run
  FROM documents
), counted AS (
  SELECT run, n, {crc("hex(encode(doc || ':' || run))")} AS h
  FROM (SELECT doc, run, count(*) AS n FROM runs GROUP BY ALL), crc_table
), vocabulary AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT n, CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
    FROM counted)
  GROUP BY word HAVING length(word) >= 5 AND sum(n) >= 3
), less AS (  -- every word without one of its letters
  SELECT word, n, length(word) AS size, i, left(word, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM vocabulary)
), pairs AS (
  SELECT a.word, b.word AS near, b.n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.size = b.size
  WHERE a.word <> b.word
  UNION SELECT a.word, v.word, v.n FROM less a JOIN vocabulary v ON v.word = a.rest
  UNION SELECT v.word, a.word, a.n FROM less a JOIN vocabulary v ON v.word = a.rest
), best AS (
  SELECT word, near, n, count(*) OVER (PARTITION BY word) AS n_near,
         row_number() OVER (PARTITION BY word ORDER BY n DESC, near) AS place
  FROM pairs
), forms AS (
  SELECT v.word, v.n, coalesce(b.n_near, 0) AS n_near,
         CASE WHEN b.n >= 2 * v.n THEN b.near END AS form, CASE WHEN b.n >= 2 * v.n THEN b.n END AS form_n
  FROM vocabulary v LEFT JOIN best b ON b.word = v.word AND b.place = 1
), chains AS (
  SELECT word, word AS at FROM forms
  UNION ALL
  SELECT c.word, f.form FROM chains c JOIN forms f ON f.word = c.at WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN chains c ON c.word = f.word JOIN forms e ON e.word = c.at AND e.form IS NULL
"""

OP12 = rf"""
WITH {CRC_TABLE}, texts AS (
  SELECT row_number() OVER () AS n, doc_id, FALSE AS is_target,
         regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
  UNION ALL
  SELECT 0, NULL, TRUE, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark
), features AS (
  SELECT n, is_target, f, count(*) AS k FROM (
    SELECT n, is_target, unnest(words) AS f FROM texts
    UNION ALL
    SELECT n, is_target, unnest(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) FROM texts)
  GROUP BY ALL
), buckets AS (
  SELECT f, {crc("hex(encode(f))")} % 10000 AS bucket FROM (SELECT DISTINCT f FROM features), crc_table
), totals AS (
  SELECT bucket, coalesce(sum(k) FILTER (NOT is_target), 0)::DOUBLE AS s, coalesce(sum(k) FILTER (is_target), 0)::DOUBLE AS t
  FROM features JOIN buckets USING (f) GROUP BY bucket
), gains AS (
  SELECT bucket, floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000) / ((s + 1) * (sum(t) OVER () + 10000))))::BIGINT AS gain
  FROM totals
), weights AS (
  SELECT n, sum(k)::BIGINT AS n_features, floor(sum(k * gain)::DOUBLE / sum(k)::DOUBLE)::BIGINT AS weight
  FROM features JOIN buckets USING (f) JOIN gains USING (bucket) WHERE NOT is_target GROUP BY n
), scored AS (
  SELECT doc_id, len(words) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT
           + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM texts LEFT JOIN weights USING (n) WHERE NOT is_target
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features) AS place,
         count(*) FILTER (n_words >= 20) OVER () * 25 // 100 AS draws
  FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= draws THEN place END AS rank FROM placed
"""

OP7 = rf"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS words FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS shingle
  FROM texts WHERE len(words) > 0
), sizes AS (
  SELECT doc_id, count(*) AS size FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS same
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * same >= 75 * (x.size + y.size - same)
), reached AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b
), components AS (
  SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a
)
SELECT doc_id, coalesce(size, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents LEFT JOIN sizes USING (doc_id) JOIN components USING (doc_id)
"""

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
DIGITS = "regexp_replace(match, '[^0-9]', '', 'g')"

OP13 = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS text FROM documents
), kinds AS (
  SELECT * FROM (VALUES (1, 'email', '{EMAIL}'), (2, 'ip', '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)'),
    (3, 'card', '[0-9]([\x20-]?[0-9])+'), (4, 'phone', '\+[0-9][\x20().0-9-]+[0-9]'), (5, 'term', '\pL{{4,}}')) k(k, kind, pattern)
), listed AS (
  SELECT n, k, kind, text, i, (list_concat(pieces, ['']))[i] AS gap, found[i] AS match FROM (
    SELECT *, unnest(range(1, len(found) + 1)) AS i FROM (
      SELECT n, k, kind, text, string_split_regex(text, pattern) AS pieces, regexp_extract_all(text, pattern) AS found
      FROM docs, kinds))
), ended AS (
  SELECT *, sum(length(gap) + length(match)) OVER (PARTITION BY n, k ORDER BY i) AS stop FROM listed
), placed AS (
  SELECT n, k, kind, text, match, stop - length(match) AS start, stop, {DIGITS} AS digits,
         coalesce(lag(stop) OVER w, 0) AS before, coalesce(lead(stop - length(match)) OVER w, length(text)) AS next
  FROM ended WHERE kind <> 'card' OR length({DIGITS}) BETWEEN 16 AND 19 WINDOW w AS (PARTITION BY n, k ORDER BY i)
), base AS (
  SELECT *, kind || ':' || CASE WHEN k > 2 THEN digits ELSE lower(match) END AS entity FROM placed
  WHERE CASE kind WHEN 'email' THEN TRUE
    WHEN 'ip' THEN list_max(list_transform(string_split(match, '.'), lambda x: coalesce(TRY_CAST(x AS BIGINT), 999))) <= 255
    WHEN 'phone' THEN length(digits) BETWEEN 8 AND 15
    WHEN 'card' THEN list_sum(list_transform(range(length(digits)), lambda j:
      (substr(reverse(digits), j + 1, 1)::INT * (1 + j % 2)) // 10 + (substr(reverse(digits), j + 1, 1)::INT * (1 + j % 2)) % 10)) % 10 = 0
    ELSE FALSE END
), sides AS (
  SELECT n, text, entity,
    regexp_extract_all(lower(regexp_replace(substr(text, before + 1, start - before), '{EMAIL}', ' ', 'g')), '\pL{{4,}}') AS l,
    regexp_extract_all(lower(regexp_replace(substr(text, stop + 1, next - stop), '{EMAIL}', ' ', 'g')), '\pL{{4,}}') AS r
  FROM (SELECT * REPLACE (before::BIGINT AS before, start::BIGINT AS start, stop::BIGINT AS stop, next::BIGINT AS next) FROM base)
), near AS (
  SELECT DISTINCT n, text, entity, unnest(list_concat(l[greatest(len(l) - 7, 1):], r[:8])) AS term FROM sides
), met AS (
  SELECT entity, term, count(DISTINCT n) AS n_both, count(DISTINCT text) AS texts
  FROM (SELECT n, text, entity, term FROM near UNION SELECT n, text, entity, left(term, 3) || '*' FROM near) GROUP BY ALL
), of_entity AS (
  SELECT entity, count(DISTINCT n) AS n_entity FROM base GROUP BY entity
), text_terms AS (
  SELECT n, lower(match) AS term FROM placed WHERE kind = 'term'
), of_term AS (
  SELECT term, count(DISTINCT n) AS n_term FROM (
    SELECT n, term FROM text_terms UNION ALL SELECT n, left(term, 3) || '*' FROM text_terms) GROUP BY term
), scored AS (
  SELECT entity, term, ln(total * n_both / (n_entity::DOUBLE * n_term)) / ln(total / n_entity) AS share
  FROM met JOIN of_entity USING (entity) JOIN of_term USING (term), (SELECT count(*)::DOUBLE AS total FROM docs)
  WHERE texts >= 3 AND n_entity < total
), spans AS (
  SELECT n, k, kind, start, stop FROM base
  UNION ALL
  SELECT n, k, kind, start, stop FROM placed p
  WHERE kind = 'term' AND lower(match) IN (SELECT term FROM scored WHERE share >= 0.9 AND NOT ends_with(term, '*'))
    AND NOT EXISTS (SELECT 1 FROM base b WHERE b.n = p.n AND b.start < p.stop AND p.start < b.stop)
), written AS (
  SELECT *, kind || ':' || start::BIGINT || ':' || stop::BIGINT AS span FROM spans
), found AS (
  SELECT n, count(*) FILTER (k = 1) AS n_email, count(*) FILTER (k = 2) AS n_ip, count(*) FILTER (k = 3) AS n_card,
    count(*) FILTER (k = 4) AS n_phone, string_agg(span, ',' ORDER BY k, start) FILTER (k < 5) AS base,
    string_agg(span, ',' ORDER BY k, start) AS spans
  FROM written GROUP BY n
)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
  coalesce(n_phone, 0) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN found USING (n)
"""

OP8 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS n, doc_id, lang, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT n, unnest(range(1, len(w) - 6)) AS i,
         unnest(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i + 7], ' '))) AS words
  FROM docs WHERE len(w) >= 8
), twice AS (
  SELECT n, i FROM windows QUALIFY count(*) OVER (PARTITION BY n, words) > 1
), repeated AS (
  SELECT n, count(DISTINCT place) AS n_repeat_words
  FROM (SELECT n, unnest(range(i, i + 8)) AS place FROM twice) GROUP BY n
), counted AS (
  SELECT n, doc_id, lang, text, len(w)::BIGINT AS n_words,
         coalesce(len(array_to_string(w, '')), 0)::BIGINT AS word_chars,
         len(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         len(lines) AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_echo_words
  FROM docs LEFT JOIN repeated USING (n)
), scored AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
         {'symbols': CASE WHEN n_words > 0 THEN n_symbols::DOUBLE / n_words ELSE 0 END,
          'dup_lines': CASE WHEN n_lines > 0 THEN n_dup_lines::DOUBLE / n_lines ELSE 0 END,
          'repeats': CASE WHEN n_words > 0 THEN n_repeat_words::DOUBLE / n_words ELSE 0 END,
          'echoes': CASE WHEN n_words > 0 THEN n_echo_words::DOUBLE / n_words ELSE 0 END} AS rate
  FROM counted
), steps(step, rule, cutoff) AS (VALUES
  (0, 'symbols', 2.0::DOUBLE), (1, 'dup_lines', 0.9), (2, 'repeats', 0.28), (3, 'echoes', 0.8),
  (4, 'symbols', 1.0), (5, 'dup_lines', 0.8), (6, 'repeats', 0.26), (7, 'echoes', 0.7),
  (8, 'symbols', 0.5), (9, 'dup_lines', 0.7), (10, 'repeats', 0.24), (11, 'echoes', 0.6),
  (12, 'symbols', 0.3), (13, 'dup_lines', 0.6), (14, 'repeats', 0.22), (15, 'echoes', 0.5),
  (16, 'symbols', 0.2), (17, 'dup_lines', 0.5), (18, 'repeats', 0.2), (19, 'echoes', 0.4),
  (20, 'symbols', 0.1), (21, 'dup_lines', 0.4), (22, 'echoes', 0.3), (23, 'echoes', 0.2)
), known AS (
  SELECT doc_id, min(quality) AS quality FROM labels WHERE quality IN (0, 1) GROUP BY doc_id
), trials AS (  -- one of a distinct text, stratum and label
  SELECT lang, text, quality, any_value(rate) AS rate
  FROM scored JOIN known USING (doc_id) WHERE NOT base_failed GROUP BY lang, text, quality
), verdicts AS (
  SELECT t.lang, t.text, quality, step, rule, cutoff,
         CASE rule WHEN 'symbols' THEN rate.symbols WHEN 'dup_lines' THEN rate.dup_lines
                   WHEN 'repeats' THEN rate.repeats ELSE rate.echoes END > cutoff AS rejects
  FROM trials t, steps
), so_far AS (
  SELECT *, bool_or(rejects) OVER (PARTITION BY lang, text, quality ORDER BY step) AS lost FROM verdicts
), sums AS (
  SELECT lang, step, rule, cutoff, count(*) FILTER (quality = 1) AS good, count(*) FILTER (quality = 0) AS bad,
         count(*) FILTER (quality = 1 AND lost) AS lost,
         count(*) FILTER (quality = 1 AND rejects) AS good_lost, count(*) FILTER (quality = 0 AND rejects) AS bad_lost
  FROM so_far GROUP BY ALL
), tested AS (
  SELECT *, CASE WHEN lost >= good * 0.02 THEN 1.0 ELSE list_sum(list_transform(range(0, lost + 1),
           lambda x: exp(lgamma(good + 1) - lgamma(x + 1) - lgamma(good - x + 1)
                    + x * ln(0.02) + (good - x) * ln(0.98)))) END
         <= 0.05 / (SELECT count(*) FROM (SELECT DISTINCT lang FROM sums)) AS passes,
         bad_lost::DOUBLE / greatest(bad, 1) - good_lost::DOUBLE / greatest(good, 1) AS gain
  FROM sums
), certified AS (
  SELECT *, bool_and(passes) OVER (PARTITION BY lang ORDER BY step) AS passed FROM tested
), chosen AS (
  SELECT lang, rule, cutoff FROM certified WHERE passed AND gain > 0
  QUALIFY row_number() OVER (PARTITION BY lang, rule ORDER BY gain DESC, step) = 1
), rejected AS (
  SELECT DISTINCT n FROM scored s JOIN chosen c ON s.lang IS NOT DISTINCT FROM c.lang
  WHERE CASE rule WHEN 'symbols' THEN rate.symbols WHEN 'dup_lines' THEN rate.dup_lines
                  WHEN 'repeats' THEN rate.repeats ELSE rate.echoes END > cutoff
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND n NOT IN (SELECT n FROM rejected) AS kept
FROM scored
"""

ORACLE = {
    "op1_fixity": OP1,
    "op3_url_lists": OP3,
    "op6_mixing": OP6,
    "op7_near_dedup": OP7,
    "op8_quality_rules": OP8,
    "op11_spelling_variants": OP11,
    "op12_importance_resampling": OP12,
    "op13_sanitisation": OP13,
}
