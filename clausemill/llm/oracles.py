"""DuckDB SQL for the queries that SQL can express."""

ORACLES: dict[str, str] = {}

ORACLES["op1_mix_sources"] = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, md5('17:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS k,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS w, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
  FROM sized GROUP BY source
), open AS (SELECT * FROM sources WHERE w > 0
), ranked AS (
  SELECT *, sum(2.0::DOUBLE * w) OVER r - 2.0::DOUBLE * w AS full_before, sum(weight) OVER () - sum(weight) OVER r + weight AS weight_left,
         (SELECT 1.5::DOUBLE * sum(w) FROM open) AS total
  FROM open WINDOW r AS (ORDER BY 2.0::DOUBLE * w / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)
), levels AS (
  SELECT arg_min((total - full_before) / weight_left, 2.0::DOUBLE * w / weight) FILTER (WHERE (total - full_before) / weight_left * weight < 2.0::DOUBLE * w) AS unit FROM ranked
), known AS (
  SELECT *, round_even(t, 0)::BIGINT AS q FROM (SELECT s.source, s.i, s.w, CASE WHEN s.w = 0 THEN 0.0::DOUBLE ELSE least(2.0::DOUBLE * s.w, s.weight * unit) END AS t FROM sources s, levels)
), how AS (
  SELECT length, greatest(1, ceil(q / greatest(262144, 64 * length)))::BIGINT AS shards
  FROM (SELECT greatest(4096, ceil(2 * sum(w) / 262144))::BIGINT AS length, sum(q) AS q FROM known)
), placed AS (
  SELECT row_number() OVER () AS id, z.doc_id, z.size, n.w, n.t, n.q, n.i,
         coalesce(sum(z.size) OVER (PARTITION BY z.source ORDER BY z.k, z.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pos
  FROM sized z JOIN known n ON z.source IS NOT DISTINCT FROM n.source
), starts AS (
  SELECT id, size, i, pass, pos + pass * w AS spot, (pos + pass * w) // length AS block FROM placed, how, (SELECT unnest(range(2)) AS pass)
), blocks AS (
  SELECT i, block, sum(size)::BIGINT AS words, min(spot) AS first FROM starts GROUP BY ALL
), ordered AS (
  SELECT *, sum(words) OVER o - words AS before, row_number() OVER o - 1 AS j FROM blocks WINDOW o AS (PARTITION BY i ORDER BY md5('17:' || i || ':' || block) ROWS UNBOUNDED PRECEDING)
), drawn AS (
  SELECT o.i, block, first, least(words, q - before)::BIGINT AS room, j FROM ordered o JOIN known n ON o.i = n.i WHERE before < q
), tree AS (
  SELECT i, j AS place, j, 0::BIGINT AS lo, shards AS hi FROM drawn, how
  UNION ALL
  SELECT i, place, CASE WHEN j < c THEN j ELSE j - c END, CASE WHEN j < c THEN lo ELSE mid END, CASE WHEN j < c THEN mid ELSE hi END
  FROM (
    SELECT *, count(*) FILTER (WHERE k <= part) OVER (PARTITION BY lo, i) AS c
    FROM (
      SELECT *, (lo + hi) // 2 AS mid, row_number() OVER (PARTITION BY lo ORDER BY md5('17:' || lo || ':' || hi || ':' || i || ':' || j)) AS k,
             count(*) OVER (PARTITION BY lo) * ((lo + hi) // 2 - lo) // (hi - lo) AS part
      FROM tree WHERE hi - lo > 1
    )
  )
), taken AS (
  SELECT s.id, s.pass, t.lo AS shard, least(s.size, d.room - (s.spot - d.first)) AS words
  FROM starts s JOIN drawn d ON d.i = s.i AND d.block = s.block JOIN tree t ON t.i = d.i AND t.place = d.j AND t.hi - t.lo = 1
  WHERE d.room - (s.spot - d.first) > 0 OR (s.size = 0 AND d.room = s.spot - d.first)
)
SELECT doc_id, size, w AS source_size, round(t, 6) AS target, coalesce(n, 0)::BIGINT AS taken, coalesce(shards, '') AS shards
FROM placed LEFT JOIN (SELECT id, sum(words) AS n, string_agg(shard || ':' || words, ',' ORDER BY pass) AS shards FROM taken GROUP BY id) USING (id)
"""

ORACLES["op3_secret_scan"] = r"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS row_id, coalesce(text, '') AS text FROM documents
), rules(kind, rank, pattern, grp, least, base) AS (VALUES
  ('assign', 0, '(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 12, true),
  ('access', 1, 'AKIA[A-Z0-9]+', 0, 18, true),
  ('hex', 2, '[0-9a-f]{16,}', 0, 16, true),
  ('pem', 3, '-----BEGIN [A-Z ]*PRIVATE KEY-----', 0, 1, false),
  ('forge', 4, 'gh[pousr]_[A-Za-z0-9]{36,}', 0, 1, false)
), parts AS (
  SELECT row_id, kind, rank, least, base,
         regexp_extract_all(text, pattern, 0) AS m,
         CASE WHEN grp = 2 THEN regexp_extract_all(text, pattern, 2) ELSE regexp_extract_all(text, pattern, 0) END AS g,
         regexp_split_to_array(text, pattern) AS p
  FROM docs, rules
), hits AS (
  SELECT row_id, kind, rank, least, base, k, length(m[k]) AS len, length(g[k]) AS part,
         sum(length(p[k]) + length(m[k])) OVER (PARTITION BY row_id, kind ORDER BY k) AS stop
  FROM (SELECT *, unnest(range(1, len(m) + 1)) AS k FROM parts)
), spans AS (
  SELECT row_id, kind, rank, base, stop - len AS start, kind || ':' || (stop - len)::BIGINT || ':' || stop::BIGINT AS said FROM hits WHERE part >= least
), per AS (
  SELECT row_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access, count(*) FILTER (WHERE kind = 'hex') AS n_hex,
         string_agg(said, ',' ORDER BY start, rank) FILTER (WHERE base) AS base_said, string_agg(said, ',' ORDER BY start, rank) AS said
  FROM spans GROUP BY row_id
)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
       sha256(coalesce(base_said, '')) AS base_sha256, coalesce(said, '') AS spans
FROM docs LEFT JOIN per USING (row_id)
"""

ORACLES["op6_top_k"] = """
WITH vectors AS (
  SELECT row_number() OVER () AS row_id, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.row_id, q.vec_id AS query_id, r.vec_id, list_sum(list_transform(list_zip(q.v, r.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM vectors q JOIN vectors r ON q.vec_id % 50 = 0 AND q.row_id <> r.row_id
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5
"""

ORACLES["op10_near_vectors"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9
), reach AS (
  SELECT vec_id AS id, vec_id AS other FROM embeddings
  UNION
  SELECT r.id, l.b FROM reach r JOIN links l ON l.a = r.other
), least AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id
), degree AS (SELECT a AS id, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN least ON e.vec_id = least.id LEFT JOIN degree ON degree.id = e.vec_id
"""

ORACLES["op4_chat_format"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, len(regexp_extract_all(role, '<\\*(?:\|turn\|>|\|says\|>|\|end\|>|s>|/s>)|\[\\*(?:INST\]|/INST\])'))
          + len(regexp_extract_all(text, '<\\*(?:\|turn\|>|\|says\|>|\|end\|>|s>|/s>)|\[\\*(?:INST\]|/INST\])')) AS marks
  FROM turns
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(24 + length(role) + length(text) + marks)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""

ORACLES["op7_ngram_join"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents
), grams AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS gram
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM w WHERE len(words) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)
), reach AS (
  SELECT doc_id AS id, doc_id AS other FROM documents
  UNION
  SELECT r.id, l.b FROM reach r JOIN links l ON l.a = r.other
)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, c.component_id
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN (SELECT id, min(other) AS component_id FROM reach GROUP BY id) c ON c.id = d.doc_id
"""

ORACLES["op11_collocations"] = r"""
WITH pieces AS (
  SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece
  FROM (SELECT coalesce(lang, 'und') AS lang, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents WHERE text IS NOT NULL)
), worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), sizes AS (SELECT lang, sum(len(w))::BIGINT AS n FROM worded GROUP BY lang
), spots AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded
), found AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*)::BIGINT AS a
  FROM spots, (SELECT unnest(range(1, 6)) AS k) WHERE i + k - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 100
), cuts AS (
  SELECT *, array_to_string(string_split(phrase, ' ')[1:j], ' ') AS front, array_to_string(string_split(phrase, ' ')[j + 1:], ' ') AS rest
  FROM (SELECT *, unnest(range(1, k)) AS j FROM found WHERE k > 1)
), scored AS (
  SELECT c.lang, c.k, c.phrase, c.a, x.a AS l, y.a AS r, n, j, ((1000::HUGEINT * c.a * n) // (x.a::HUGEINT * y.a))::BIGINT AS score
  FROM cuts c JOIN sizes s ON s.lang = c.lang JOIN found x ON x.lang = c.lang AND x.phrase = c.front JOIN found y ON y.lang = c.lang AND y.phrase = c.rest
), least AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS place FROM scored
), kept AS (
  SELECT * FROM least c WHERE place = 1
    AND NOT EXISTS (SELECT 1 FROM found g WHERE g.lang = c.lang AND g.k > c.k AND 100 * g.a >= 100 * c.a AND contains(' ' || g.phrase || ' ', ' ' || c.phrase || ' '))
)
SELECT * FROM (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase::BLOB) AS rank, phrase, a, l, r, n, score FROM kept) WHERE rank <= 2000
"""

ORACLES["op12_warc"] = r"""
WITH rows AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
), bits AS (
  SELECT *, list_transform(range(8), lambda g: list_reduce(list_transform(range(5), lambda i: (strpos('0123456789abcdef', hex[g * 5 + i + 1]) - 1)::BIGINT), lambda a, b: a * 16 + b)) AS groups FROM rows
)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((groups[i // 4 + 1] >> (15 - 5 * (i % 4))) & 31)::INTEGER + 1, 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN row_number() OVER same = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN row_number() OVER same > 1 THEN min(page_id) OVER (PARTITION BY html) END AS refers_to
FROM bits WINDOW same AS (PARTITION BY html ORDER BY page_id)
"""
