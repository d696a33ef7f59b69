"""DuckDB SQL of the queries that SQL can express."""

_MIX = r"""
mix_rows AS (
  SELECT *, md5(coalesce(text, '')) AS tie, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('mix-' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM {docs}),
mix_sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0 ELSE 1.0 END AS w
  FROM mix_rows GROUP BY source),
mix_up AS (
  SELECT *, 3 * source_size AS cap, sum(source_size) OVER () AS total,
         coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / w, source IS NULL, encode(source) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
         sum(w) OVER (ORDER BY 3 * source_size / w, source IS NULL, encode(source) ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_w
  FROM mix_sources),
mix_level AS (
  SELECT first((total - capped)::DOUBLE / open_w ORDER BY cap / w) AS level
  FROM mix_up WHERE (total - capped)::DOUBLE / open_w * w <= cap),
mix_targets AS (
  SELECT source, source_size, least(cap::DOUBLE, coalesce(level * w, cap::DOUBLE)) AS target FROM mix_up, mix_level),
mix_placed AS (
  SELECT r.*, t.source_size, t.target,
         (sum(size) OVER (PARTITION BY r.source ORDER BY h, doc_id, size, tie ROWS UNBOUNDED PRECEDING))::BIGINT AS upto
  FROM mix_rows r JOIN mix_targets t ON r.source IS NOT DISTINCT FROM t.source),
mix_passes AS (
  SELECT size, (e * source_size + upto)::DOUBLE / target AS finish
  FROM mix_placed, (VALUES (0), (1), (2)) p(e) WHERE size > 0 AND target > 0),
mix_ends AS (SELECT finish, sum(sum(size)) OVER (ORDER BY finish ROWS UNBOUNDED PRECEDING) AS ends FROM mix_passes GROUP BY finish),
mix_last AS (SELECT coalesce(max(finish), -1) AS last FROM mix_ends WHERE ends <= (SELECT sum(source_size) FROM mix_targets)),
mix AS (
  SELECT *, ((target > 0 AND upto::DOUBLE / target <= last)::INT + (target > 0 AND (source_size + upto)::DOUBLE / target <= last)::INT
          + (target > 0 AND (2 * source_size + upto)::DOUBLE / target <= last)::INT)::BIGINT AS times
  FROM mix_placed, mix_last)
"""

MIX = f"WITH {_MIX.format(docs='documents')} SELECT doc_id, size, source_size, target, (size * times)::BIGINT AS taken FROM mix"

WORD_WINDOWS = r"""
WITH doc_words AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
  SELECT r, doc_id, pos, md5(array_to_string(words[pos:pos + 49], ' ')) AS w
  FROM doc_words, unnest(range(1, len(words) - 48)) AS u(pos) WHERE len(words) >= 50),
first_doc AS (SELECT w, min(doc_id) AS least FROM windows GROUP BY w HAVING min(doc_id) < max(doc_id)),
hits AS (SELECT r, pos FROM windows JOIN first_doc USING (w) WHERE least < doc_id),
gone AS (SELECT DISTINCT r, pos + k AS pos FROM hits, range(0, 50) AS t(k)),
words AS (SELECT r, pos, words[pos] AS word FROM doc_words, unnest(range(1, len(words) + 1)) AS u(pos)),
kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY pos) AS kept, count(*) AS n FROM words ANTI JOIN gone USING (r, pos) GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM doc_words LEFT JOIN kept USING (r)
"""

JACCARD = r"""
WITH RECURSIVE doc_words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
grams AS (
  SELECT DISTINCT doc_id, md5(array_to_string(words[pos:pos + 4], ' ')) AS g
  FROM doc_words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS u(pos) WHERE len(words) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS inter
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT u, v FROM shared JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v
  WHERE inter >= 0.8 * (x.n + y.n - inter) - 1e-9),
reach AS (SELECT DISTINCT u, u AS v FROM links UNION SELECT reach.u, links.v FROM reach JOIN links ON links.u = reach.v),
classes AS (SELECT u, min(v) AS class_id FROM reach GROUP BY u),
counts AS (SELECT u, count(*) AS n FROM links GROUP BY u)
SELECT doc_id, coalesce(class_id, doc_id) AS class_id, coalesce(n, 0)::BIGINT AS n_links
FROM doc_words LEFT JOIN classes ON classes.u = doc_id LEFT JOIN counts ON counts.u = doc_id
"""

EMBEDDINGS = """
WITH RECURSIVE good AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT DISTINCT u, u AS v FROM links UNION SELECT reach.u, links.v FROM reach JOIN links ON links.u = reach.v),
components AS (SELECT u, min(v) AS c FROM reach GROUP BY u),
counts AS (SELECT u, count(*) AS n FROM links GROUP BY u)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(c, vec_id) AS component_id, coalesce(c, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN components ON components.u = vec_id LEFT JOIN counts ON counts.u = vec_id
"""
