"""SQL counterparts of the corpus queries that SQL can express."""

OP4 = r"""
WITH parts AS (
  SELECT page_id, url, coalesce(regexp_matches(html, '(?i)(worthless|idiot|casino)'), false) AS flagged,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), split AS (
  SELECT page_id, flagged,
         coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
         coalesce(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), '') AS query
  FROM parts
), named AS (
  SELECT *, regexp_replace(regexp_replace(host, ':(80|443)$', ''), '^(www|m)\.', '') AS name,
         list_sort(list_filter(string_split(query, '&'),
                   lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref)(=|$)'))) AS kept
  FROM split
), canonical AS (
  SELECT *, CASE WHEN name <> '' THEN name || regexp_replace(path, '/+$', '') ||
            CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END END AS canon
  FROM named
), listed AS (
  SELECT DISTINCT canon FROM canonical WHERE flagged AND canon IS NOT NULL
), rules(verdict, name, start) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
         ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), fits AS (
  SELECT c.page_id, c.host, c.path, c.canon,
         (SELECT arg_max(struct_pack(rule := r.name || r.start, verdict := r.verdict), length(r.name || r.start))
          FROM rules r WHERE (c.host = r.name OR ends_with(c.host, '.' || r.name)) AND starts_with(c.path, r.start)) AS fit
  FROM canonical c
)
SELECT f.page_id, f.host, f.path, f.fit.rule AS rule,
       coalesce(f.fit.verdict, CASE WHEN l.canon IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM fits f LEFT JOIN listed l ON f.canon = l.canon
"""

#: Sizes, the water level and the extra copies, straight from the definitions.
MIXED = r"""
sized AS (
  SELECT *, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix-1:' || coalesce(doc_id::VARCHAR, '-') || ':' || coalesce(text, '')) AS digest
  FROM {docs}
), sources AS (
  SELECT source, sum(size)::BIGINT AS words FROM sized GROUP BY source
), weighed AS (
  SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight,
         2.0::DOUBLE * words AS cap
  FROM sources
), levels AS (
  SELECT *,
         (1.5::DOUBLE * sum(words) OVER () - coalesce(sum(cap) OVER before, 0.0::DOUBLE))
         / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0.0::DOUBLE)) AS level
  FROM weighed
  WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), water AS (
  SELECT (SELECT level FROM levels WHERE level * weight <= cap ORDER BY cap / weight, source LIMIT 1) AS level
), targets AS (
  SELECT l.source, l.words AS source_size, least(l.cap, coalesce(l.weight * w.level, l.cap)) AS target
  FROM levels l CROSS JOIN water w
), shares AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole FROM targets
), ordered AS (
  SELECT s.*, t.source_size, t.target, t.whole, t.target - t.whole * t.source_size AS rest,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.digest) AS stop,
         sum(s.size) OVER (PARTITION BY s.source, s.digest) AS same
  FROM sized s JOIN shares t ON s.source IS NOT DISTINCT FROM t.source
), mixed AS (
  SELECT *, whole + CASE WHEN rest > 0 AND stop - same + same / 2.0 <= rest THEN 1 ELSE 0 END AS repeats FROM ordered
)
"""

OP7 = "WITH " + MIXED.format(docs="documents") + """
SELECT doc_id, size, source_size, target, (repeats * size)::BIGINT AS taken FROM mixed
"""

#: Windows of units of at least 120 characters; the first by (id, digest of the text, number of the unit) of equal ones stays.
OP5 = r"""
WITH keyed AS (
  SELECT row_number() OVER () AS row_nr, doc_id, coalesce(text, '') AS text,
         md5(coalesce(doc_id::VARCHAR, '-') || ':' || coalesce(text, '')) AS doc_key
  FROM documents
), pieces AS (
  SELECT row_nr, generate_subscripts(p, 1) AS nth, unnest(p) AS piece
  FROM (SELECT row_nr, regexp_extract_all(text,
          '[\x09-\x0D\x20\x{A0}\x{3000}]+|[^\x09-\x0D\x20\x{A0}\x{3000}。！？，、]+[。！？，、]*|[。！？，、]+') AS p FROM keyed)
), placed AS (
  SELECT *, sum(length(piece)) OVER (PARTITION BY row_nr ORDER BY nth) - length(piece) AS start,
         regexp_matches(piece, '^[\x09-\x0D\x20\x{A0}\x{3000}]') AS gap,
         lead(piece) OVER (PARTITION BY row_nr ORDER BY nth) AS behind
  FROM pieces
), words AS (
  SELECT row_nr, nth, start, start + length(piece) AS stop, lower(piece) AS word, length(piece) + 1 AS size,
         CASE WHEN regexp_matches(behind, '^[\x09-\x0D\x20\x{A0}\x{3000}]') THEN behind ELSE '' END AS after_it
  FROM placed WHERE NOT gap
), ended AS (
  SELECT *, contains(after_it, chr(10)) AS breaks,
         contains(after_it, chr(10)) OR md5(word) < '18' OR length(word) > 24
         OR lead(nth) OVER (PARTITION BY row_nr ORDER BY nth) IS NULL AS ends
  FROM words
), numbered AS (
  SELECT *, coalesce(sum(ends::INT) OVER (PARTITION BY row_nr ORDER BY nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 1 AS unit
  FROM ended
), unit AS (
  SELECT row_nr, unit, min(start) AS start, max(stop) AS stop, max(stop + length(after_it)) AS following, bool_or(breaks) AS breaks,
         sum(size) AS size, string_agg(word, ' ' ORDER BY nth) AS norm
  FROM numbered GROUP BY row_nr, unit
), summed AS (
  SELECT *, sum(size) OVER (PARTITION BY row_nr ORDER BY unit) AS until,
         coalesce(lag(breaks) OVER (PARTITION BY row_nr ORDER BY unit), true) AS opens
  FROM unit
), listed AS (
  SELECT row_nr, list(norm ORDER BY unit) AS norms FROM unit GROUP BY row_nr
), reach AS (
  SELECT a.row_nr, a.unit AS first, min(b.unit) AS last
  FROM summed a JOIN summed b ON a.row_nr = b.row_nr AND b.unit BETWEEN a.unit AND a.unit + 60 AND b.until - a.until + a.size >= 120
  GROUP BY a.row_nr, a.unit
  UNION
  SELECT b.row_nr, max(a.unit), b.unit
  FROM summed a JOIN summed b ON a.row_nr = b.row_nr AND a.unit BETWEEN b.unit - 60 AND b.unit AND b.until - a.until + a.size >= 120
  WHERE b.breaks OR b.unit = (SELECT max(unit) FROM summed l WHERE l.row_nr = b.row_nr)
  GROUP BY b.row_nr, b.unit
), judged AS (
  SELECT r.row_nr, r.first, r.last,
         dense_rank() OVER (PARTITION BY array_to_string(list_slice(l.norms, r.first, r.last), ' ')
                            ORDER BY k.doc_id NULLS LAST, k.doc_key, r.first) > 1 AS later
  FROM reach r JOIN listed l ON r.row_nr = l.row_nr JOIN keyed k ON r.row_nr = k.row_nr
), gone AS (
  SELECT DISTINCT s.row_nr, s.unit, s.start, s.stop, s.following, s.breaks, s.opens
  FROM summed s JOIN judged j ON j.later AND s.row_nr = j.row_nr AND s.unit BETWEEN j.first AND j.last
), islands AS (
  SELECT *, unit - row_number() OVER (PARTITION BY row_nr ORDER BY unit) AS island FROM gone
), spans AS (
  SELECT row_nr, min(start)::BIGINT AS start,
         CASE WHEN arg_max(breaks, unit) AND NOT arg_min(opens, unit) THEN max(stop) ELSE max(following) END::BIGINT AS stop
  FROM islands GROUP BY row_nr, island
), cut AS (
  SELECT row_nr, count(*) AS n_removed, string_agg(start || '-' || stop, ',' ORDER BY start) AS removed,
         string_agg(substr(text, before + 1, start - before), '' ORDER BY start) || substr(any_value(text), max(stop) + 1) AS kept
  FROM (SELECT s.*, k.text, coalesce(lag(s.stop) OVER (PARTITION BY s.row_nr ORDER BY s.start), 0) AS before
        FROM spans s JOIN keyed k ON s.row_nr = k.row_nr)
  GROUP BY row_nr
)
SELECT k.doc_id, coalesce(c.n_removed, 0)::BIGINT AS n_removed, coalesce(c.removed, '') AS removed,
       sha256(coalesce(c.kept, k.text)) AS kept_sha256, coalesce(c.kept, k.text) AS text
FROM keyed k LEFT JOIN cut c ON k.row_nr = c.row_nr
"""

OP8 = """
WITH RECURSIVE good AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), heads AS (
  SELECT a, min(b) AS component_id FROM reach GROUP BY a
), counts AS (
  SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT e.vec_id, coalesce(c.n, 0)::BIGINT AS n_links, h.component_id, e.vec_id = h.component_id AS kept
FROM embeddings e JOIN heads h ON e.vec_id = h.a LEFT JOIN counts c ON e.vec_id = c.a
"""

#: Runs by comparing all words of one document that are up to a quarter of it apart.
OP11 = r"""
WITH given AS (
  SELECT row_number() OVER () AS row_nr, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS given_words,
         CASE WHEN doc_id IS NULL THEN 0::BIGINT ELSE
           xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ord(d)::BIGINT),
               lambda c, b: list_reduce([xor(c, b)] || range(8), lambda x, k: xor(x >> 1, 3988292384::BIGINT * (x & 1)))),
               4294967295::BIGINT) END AS h
  FROM documents
), shaped AS (
  SELECT *, len(given_words) AS n, h // 10 AS g,
         CASE WHEN h % 10 = 0 AND len(given_words) > 0 THEN (h // 10) % len(given_words) ELSE len(given_words) END AS a
  FROM given
), looped AS (
  SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM shaped
), words AS (
  SELECT row_nr, n, unnest(range(n)) AS i,
         unnest(list_transform(range(n), lambda i: given_words[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END])) AS word
  FROM looped
), equal AS (
  SELECT x.row_nr, x.i, y.i - x.i AS q
  FROM words x JOIN words y ON x.row_nr = y.row_nr AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
), islands AS (
  SELECT row_nr, q, min(i) AS start, count(*) + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY row_nr, q ORDER BY i) AS island FROM equal)
  GROUP BY row_nr, q, island
  HAVING count(*) + q >= greatest(6, 4 * q)
), runs AS (
  SELECT row_nr, start, length, min(q) AS period FROM islands GROUP BY row_nr, start, length
), listed AS (
  SELECT row_nr, count(*) AS n_runs,
         arg_max(struct_pack(s := start, l := length, p := period), (length, -start, -period)) AS longest,
         string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS written
  FROM runs GROUP BY row_nr
), left_over AS (
  SELECT row_nr, string_agg(word, ' ' ORDER BY i) AS collapsed
  FROM words w
  WHERE NOT EXISTS (SELECT 1 FROM runs r WHERE r.row_nr = w.row_nr AND w.i >= r.start + r.period AND w.i < r.start + r.length)
  GROUP BY row_nr
)
SELECT g.doc_id, coalesce(l.n_runs, 0)::BIGINT AS n_runs, l.longest.s::BIGINT AS start, l.longest.l::BIGINT AS length,
       l.longest.p::BIGINT AS period, (1000 * l.longest.l // l.longest.p)::BIGINT AS exponent_milli,
       sha256(coalesce(l.written, '')) AS runs_sha256, sha256(coalesce(o.collapsed, '')) AS collapsed_sha256
FROM given g LEFT JOIN listed l ON g.row_nr = l.row_nr LEFT JOIN left_over o ON g.row_nr = o.row_nr
"""

#: Every document scored for every item.
OP13 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row_nr, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), corpus AS (
  SELECT count(*) FILTER (len(terms) > 0) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM docs
), held AS (
  SELECT row_nr, doc_id, term, count(*) AS tf, any_value(n) AS n
  FROM (SELECT row_nr, doc_id, len(terms) AS n, unnest(terms) AS term FROM docs) GROUP BY ALL
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), weighed AS (
  SELECT term, floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM held, corpus WHERE term IN (SELECT term FROM asked) GROUP BY term, n_docs
), scored AS (
  SELECT a.item_id, h.row_nr, any_value(h.doc_id) AS doc_id,
         sum(w.w * ((1000000000 * h.tf) // (1000 * h.tf + 20 * (50 + (50 * h.n * c.n_docs) // c.n_terms))))::BIGINT AS score
  FROM asked a JOIN weighed w ON a.term = w.term JOIN held h ON a.term = h.term, corpus c
  GROUP BY a.item_id, h.row_nr
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
WHERE rank <= 50
"""

LLM_SQL: dict[str, str] = {
    "op4_urls": OP4,
    "op5_lines": OP5,
    "op7_mixing": OP7,
    "op8_embed_dedup": OP8,
    "op11_periodic_runs": OP11,
    "op13_lexical_search": OP13,
}
