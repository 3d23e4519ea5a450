"""SQL for the queries that SQL can express."""

OP1 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), counted AS (
  SELECT *, len(regexp_extract_all(text, '[A-Za-z0-9]+|[^A-Za-z0-9\x20\x09-\x0D]')) + 4 AS tokens,
         4 + len(regexp_replace(role, '[<\[|\\]', 'xx', 'g')) + len(regexp_replace(text, '[<\[|\\]', 'xx', 'g')) + 7 AS chars,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn) = 1 AND role = 'system' AS lead
  FROM turns
), placed AS (
  SELECT *, sum(tokens) OVER (PARTITION BY conv_id ORDER BY turn) - tokens - max(CASE WHEN lead THEN tokens ELSE 0 END) OVER (PARTITION BY conv_id) AS start,
         greatest(floor((768 - max(CASE WHEN lead THEN tokens ELSE 0 END) OVER (PARTITION BY conv_id)) / 2), 128) AS width
  FROM counted
), own AS (
  SELECT *, CASE WHEN lead THEN 0 ELSE floor(start / width) END AS win,
         CASE WHEN lead THEN 1e15 WHEN tokens <= 128 THEN floor((start + 128) / width) ELSE floor(start / width) END AS until
  FROM placed
), windows AS (SELECT DISTINCT conv_id, win FROM own
), chars AS (
  SELECT o.conv_id, sum(o.chars)::BIGINT AS formatted_chars
  FROM own o JOIN windows w ON o.conv_id = w.conv_id AND w.win BETWEEN o.win AND o.until GROUP BY o.conv_id
)
SELECT t.conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       coalesce(sum(len(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256, any_value(c.formatted_chars) AS formatted_chars
FROM turns t JOIN chars c ON t.conv_id = c.conv_id GROUP BY t.conv_id
"""

OP3 = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('17:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, [5.0, 2.0, 1.0][1 + ((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3]::DOUBLE AS w
  FROM sized GROUP BY source
), ordered AS (
  SELECT *, 3.0::DOUBLE * source_size AS cap, sum(source_size) OVER ()::DOUBLE AS total, sum(w) OVER () AS all_w,
         coalesce(sum(3.0::DOUBLE * source_size) OVER before, 0) AS cap_before, coalesce(sum(w) OVER before, 0) AS w_before
  FROM sources
  WINDOW before AS (ORDER BY 3.0::DOUBLE * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), filled AS (SELECT *, (total - cap_before) * w >= cap * (all_w - w_before) AS is_full FROM ordered
), targets AS (
  SELECT source, source_size, CASE WHEN is_full THEN cap ELSE
    w * (total - sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ()) / nullif(all_w - sum(CASE WHEN is_full THEN w ELSE 0 END) OVER (), 0) END AS target
  FROM filled
), rests AS (
  SELECT *, coalesce(floor(target / nullif(source_size, 0)), 0) AS whole FROM targets
)
SELECT s.doc_id, s.size, r.source_size, r.target,
       (s.size * (r.whole + CASE WHEN s.size > 0 AND
          coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.h, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
          + s.size / 2 <= r.target - r.whole * r.source_size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM sized s JOIN rests r ON s.source IS NOT DISTINCT FROM r.source
"""

OP4 = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
"""

OP11 = """
WITH rows AS (
  SELECT vec_id, row_number() OVER () AS rn, [floor(1024 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT q.vec_id AS query_id, q.rn, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM rows q JOIN rows c ON q.rn <> c.rn WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY rn ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM scored
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""

OP12 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), listed AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), placed AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM listed WHERE len(w) > 0
), grams AS (
  SELECT lang, k, list_slice(w, i, i + k - 1) AS p, count(*)::BIGINT AS f
  FROM placed, (SELECT unnest([1, 2, 3]) AS k) WHERE i + k - 1 <= len(w) GROUP BY ALL
), sizes AS (SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE k = 1 GROUP BY lang
), candidates AS (SELECT * FROM grams WHERE k > 1 AND f >= 10
), longer AS (
  SELECT lang, p, max(f) AS f FROM (
    SELECT lang, list_slice(p, 1, 2) AS p, f FROM candidates WHERE k = 3 UNION ALL SELECT lang, list_slice(p, 2, 3), f FROM candidates WHERE k = 3
  ) GROUP BY ALL
), kept AS (
  SELECT c.* FROM candidates c LEFT JOIN longer o ON c.k = 2 AND c.lang = o.lang AND c.p = o.p WHERE o.f IS NULL OR 100 * o.f < 50 * c.f
), cuts AS (
  SELECT c.lang, c.p, c.f AS a, x.f AS l, y.f AS r, cut, (c.f::HUGEINT * c.f * 1000000 // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM kept) c
  JOIN grams x ON x.lang = c.lang AND x.p = list_slice(c.p, 1, cut)
  JOIN grams y ON y.lang = c.lang AND y.p = list_slice(c.p, cut + 1, c.k)
), lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) AS nth FROM cuts
), ranked AS (
  SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, score,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank
  FROM lowest WHERE nth = 1
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
"""

OP13 = r"""
WITH terms AS (
  SELECT doc_id, row_number() OVER () AS rn, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents
), totals AS (SELECT count(*) FILTER (len(t) > 0)::BIGINT AS big_n, sum(len(t))::BIGINT AS big_l FROM terms
), lengths AS (SELECT doc_id, rn, t, 10 + (90 * len(t) * big_n) // big_l AS m FROM terms, totals WHERE len(t) > 0
), counts AS (SELECT doc_id, rn, m, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, rn, m, unnest(t) AS term FROM lengths) GROUP BY ALL
), held AS (SELECT term, count(*)::BIGINT AS df FROM counts GROUP BY term
), weights AS (SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM held, totals
), items AS (
  SELECT DISTINCT item_id, ri, unnest(t) AS term FROM (
    SELECT item_id, row_number() OVER () AS ri, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
    FROM benchmark)
), scored AS (
  SELECT item_id, ri, doc_id, rn, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM items JOIN weights USING (term) JOIN counts USING (term) GROUP BY ALL
), ranked AS (SELECT *, row_number() OVER (PARTITION BY ri ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""

SQL = {"op1_chat_windows": OP1, "op3_mixing": OP3, "op4_exact_dedup": OP4, "op11_topk": OP11, "op12_collocations": OP12, "op13_lexical": OP13}
