"""DuckDB SQL for the queries that SQL can express, over the whole tables."""

ORACLES: dict[str, str] = {}

# Links by brute force, components by closing them.
ORACLES["op1_near_vectors"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS x FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE list_cosine_similarity(a.x, b.x) >= 0.9
), reach AS (
  SELECT vec_id, vec_id AS other FROM embeddings
  UNION
  SELECT r.vec_id, l.b FROM reach r JOIN links l ON l.a = r.other
)
SELECT e.vec_id,
       (SELECT count(*) FROM links WHERE a = e.vec_id) AS n_links,
       c.component_id,
       e.vec_id = c.component_id AS kept
FROM embeddings e JOIN (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id) c USING (vec_id)
"""

ORACLES["op2_ngram_jaccard"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 5
      THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
  FROM w
), shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 80 * (min(a.n) + min(b.n) - count(*))
), reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
)
SELECT s.doc_id, len(s.s) AS n_shingles, c.component_id
FROM sets s JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) c USING (doc_id)
"""

ORACLES["op3_source_mix"] = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
), per AS (
  SELECT source, sum(size)::BIGINT AS c, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
  FROM sized GROUP BY source
), level AS (
  SELECT p.*, (SELECT sum(c) FROM per)::BIGINT AS total,
    ((SELECT sum(c) FROM per)::BIGINT - 3 * coalesce(sum(c) OVER before, 0)::BIGINT)
      / ((SELECT sum(w) FROM per)::BIGINT - coalesce(sum(w) OVER before, 0)::BIGINT) AS l
  FROM per p
  WINDOW before AS (ORDER BY c / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), final AS (
  SELECT l FROM level WHERE l * w < 3 * c ORDER BY c / w, source NULLS LAST LIMIT 1
), target AS (
  SELECT source, c, CASE WHEN total > 0 THEN least(3 * c::DOUBLE, coalesce((SELECT l FROM final) * w, 3 * c::DOUBLE)) ELSE 0 END AS t
  FROM level
), placed AS (
  SELECT s.*, t.c, t.t, round(t.t)::BIGINT AS budget,
    coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY md5('20240501:' || coalesce(doc_id::VARCHAR, '')), doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS earlier
  FROM sized s JOIN target t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, c AS source_size, t AS target,
  CASE WHEN c = 0 THEN 0
    ELSE size * (budget // c) + greatest(0, least(size, budget - (budget // c) * c - earlier)) END AS taken
FROM placed
"""

ORACLES["op5_url_rules"] = r"""
WITH rules(host, path, verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), rest AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages
), urls AS (
  SELECT page_id,
         translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest
), best AS (
  SELECT u.*, r.host || r.path AS rule, r.verdict,
         row_number() OVER (PARTITION BY u.page_id ORDER BY length(r.host) + length(r.path) DESC, length(r.host) DESC) AS n
  FROM urls u LEFT JOIN rules r
    ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM best WHERE n = 1
"""

ORACLES["op7_exact_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id,
       (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank,
       vec_id, score
FROM scored QUALIFY rank <= 5
"""

ORACLES["op10_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT *, trim(line, ' ' || chr(9) || chr(13) || chr(12) || chr(11)) AS key FROM lines
), common AS (
  SELECT source, key FROM keyed WHERE key <> '' AND source IS NOT NULL GROUP BY source, key
  HAVING count(DISTINCT doc_id) >= 5
     AND count(DISTINCT doc_id) > 0.05 * (SELECT count(*) FROM documents d WHERE d.source = keyed.source)
), judged AS (
  SELECT k.*, c.key IS NOT NULL AS goes FROM keyed k LEFT JOIN common c ON k.source = c.source AND k.key = c.key
), texts AS (
  SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT goes), '') AS text,
         count(*)::INT AS n_lines, (count(*) FILTER (goes))::INT AS n_dropped
  FROM judged GROUP BY doc_id
)
SELECT d.doc_id, d.source, t.text, coalesce(t.n_lines, 0) AS n_lines, coalesce(t.n_dropped, 0) AS n_dropped
FROM documents d LEFT JOIN texts t USING (doc_id)
"""

ORACLES["op12_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.x, c.x)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
       (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY n.score DESC, n.vec_id))::INT AS rank,
       n.vec_id AS negative_id, positive_score, n.score AS negative_score
FROM positives p JOIN scored n USING (anchor_id)
WHERE NOT n.same AND 50 * positive_score <= 100 * n.score AND 100 * n.score <= 95 * positive_score
QUALIFY rank <= 3
"""

# The damage by a bitwise CRC, the repair by one step a row that keeps, for each state of the structure, the cheapest edits
# so far and of these the least in ASCII: of two ways to one state at one cost, neither audit begins with the other.
ORACLES["op13_conversation_repair"] = r"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k
  FROM conversations
), crcs AS (
  SELECT k, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(k, ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0],
      lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 20 AS d
  FROM (SELECT DISTINCT k FROM keyed)
), damaged AS (
  SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
         CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN d = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM keyed JOIN crcs USING (k) WHERE d <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(role || ':' || text)) AS pos FROM damaged
), seen AS (
  SELECT *, substr(role, 1, 1) AS i, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS i0,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'd'
              WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 't' ELSE '' END AS fault
  FROM placed
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
         count(*) FILTER (fault = 't') AS truncated,
         count(*) FILTER (i0 IS NOT NULL AND i0 || i NOT IN ('su', 'ua', 'au')) AS illegal
  FROM seen GROUP BY conv_id
), steps(a, role, b) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)),
-- Ways from state to state by up to three insertions; more never pay.
ins(a, b, n, roles) AS (
  SELECT s, s, 0, []::VARCHAR[] FROM (VALUES (0), (1), (2), (3)) t(s)
  UNION ALL
  SELECT ins.a, steps.b, ins.n + 1, list_append(ins.roles, steps.role) FROM ins JOIN steps ON ins.b = steps.a AND steps.role <> 's'
  WHERE ins.n < 3
), moves AS (
  SELECT i.a, i.n, i.roles, e.* FROM ins i JOIN (
    SELECT a AS c, 'D' AS letter, '*' AS needs, '' AS gives, a AS b FROM (VALUES (0), (1), (2), (3)) t(a)
    UNION ALL SELECT a, 'K', role, '=', b FROM steps
    UNION ALL SELECT a, 'R', '*', role, b FROM steps WHERE role <> 's') e ON i.b = e.c
), walk AS (
  SELECT conv_id, 0::BIGINT AS pos, 0 AS state, 0::BIGINT AS cost, '' AS audit, []::VARCHAR[] AS lines
  FROM (SELECT DISTINCT conv_id FROM seen)
  UNION ALL
  SELECT conv_id, pos, state, (best).cost, (best).audit, (best).lines FROM (
    SELECT w.conv_id, s.pos, m.b AS state, min(struct_pack(
      cost := w.cost + 2 * m.n + CASE m.letter WHEN 'D' THEN 3 WHEN 'R' THEN 2 ELSE 0 END
        + CASE WHEN s.fault = 't' AND m.letter <> 'D' THEN 1 ELSE 0 END,
      audit := w.audit || repeat('I', m.n) || m.letter,
      lines := w.lines || list_transform(m.roles, lambda r: CASE r WHEN 'u' THEN 'user:' ELSE 'assistant:' END)
        || CASE WHEN m.letter = 'D' THEN []::VARCHAR[] WHEN m.letter = 'K' THEN [s.role || ':' || s.text]
           ELSE [CASE m.gives WHEN 'u' THEN 'user:' ELSE 'assistant:' END || s.text] END)) AS best
    FROM walk w JOIN seen s ON s.conv_id IS NOT DISTINCT FROM w.conv_id AND s.pos = w.pos + 1
      JOIN moves m ON m.a = w.state AND (m.needs = '*' OR m.needs = s.i) AND (m.letter = 'D' OR s.fault NOT IN ('b', 'd'))
    GROUP BY w.conv_id, s.pos, m.b)
), ended AS (
  SELECT w.conv_id, min(struct_pack(cost := w.cost + 2 * i.n, audit := w.audit || repeat('I', i.n),
      lines := w.lines || list_transform(i.roles, lambda r: CASE r WHEN 'u' THEN 'user:' ELSE 'assistant:' END))) AS best
  FROM walk w JOIN (SELECT conv_id, max(pos) AS pos FROM seen GROUP BY conv_id) l
      ON l.conv_id IS NOT DISTINCT FROM w.conv_id AND l.pos = w.pos
    JOIN ins i ON i.a = w.state AND i.b IN (0, 3)
  GROUP BY w.conv_id
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce((best).cost, 0) AS cost,
       coalesce((best).audit, '') AS audit, sha256(coalesce(array_to_string((best).lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
  LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""
