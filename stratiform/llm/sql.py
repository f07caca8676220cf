"""SQL that checks the corpus queries which SQL can express, over whole tables."""

from __future__ import annotations

from stratiform.llm.mixing import MOST_EPOCHS, PROSE_WORD
from stratiform.llm.perspectives import NARRATORS

_NARRATOR = "speaker IN (" + ", ".join(f"'{n}'" for n in NARRATORS) + ")"

MIXING = rf"""
WITH counted AS (
  SELECT doc_id, source, coalesce(length(text), 0) AS n,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    (('0x' || substr(md5('mix|' || coalesce(doc_id::VARCHAR, '#' || md5(coalesce(text, '')))), 1, 13))::BIGINT::DOUBLE + 0.5)
      / 4503599627370496.0::DOUBLE AS u
  FROM documents),
drawn AS (
  SELECT doc_id, source, size,
    -ln(u) / CASE WHEN size > 0
      THEN 1.0::DOUBLE / (1 + abs(n::DOUBLE / size - {PROSE_WORD}::DOUBLE) / {PROSE_WORD}::DOUBLE)
      ELSE 1.0::DOUBLE END AS draw
  FROM counted),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    row_number() OVER (ORDER BY source NULLS LAST) - 1 AS nth
  FROM drawn GROUP BY source),
weighed AS (
  SELECT *, (1 + nth % 3)::DOUBLE AS w, source_size::DOUBLE * {MOST_EPOCHS} AS most,
    sum(source_size) OVER ()::DOUBLE AS total
  FROM sources),
levels AS (
  SELECT *,
    (total - coalesce(sum(most) OVER (ORDER BY most / w, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(w) OVER (ORDER BY most / w, nth ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
targets AS (
  SELECT source, source_size, least(most, max(level) OVER () * w) AS target FROM levels),
budgets AS (
  SELECT *, least(round(target), source_size * {MOST_EPOCHS})::BIGINT AS words FROM targets),
placed AS (
  SELECT d.doc_id, d.size, b.source_size, b.target,
    CASE WHEN b.source_size = 0 THEN 0 ELSE b.words // b.source_size END AS epochs, b.words,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY d.draw, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) - d.size AS before
  FROM drawn d JOIN budgets b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
  (epochs * size + greatest(0, least(size, words - epochs * source_size - before)))::BIGINT AS taken
FROM placed
"""

PERSPECTIVES = rf"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS text FROM conversations),
parties AS (
  SELECT DISTINCT conv_id, speaker AS perspective FROM said WHERE NOT {_NARRATOR}),
turns AS (
  SELECT s.*, p.perspective,
    CASE WHEN speaker = perspective THEN 'assistant' WHEN {_NARRATOR} THEN speaker ELSE 'user' END AS role,
    CASE WHEN speaker <> perspective AND NOT {_NARRATOR} THEN speaker END AS name
  FROM said s JOIN parties p ON s.conv_id IS NOT DISTINCT FROM p.conv_id),
headed AS (
  SELECT *, '<|im_start|>' || role || coalesce(' name=' || name, '') || chr(10) AS head FROM turns),
rendered AS (
  SELECT *, head || text || '<|im_end|>' || chr(10) AS rendered FROM headed),
placed AS (
  SELECT *, sum(length(rendered)) OVER (
    PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, text ROWS UNBOUNDED PRECEDING)::BIGINT AS stop
  FROM rendered),
bounded AS (SELECT *, stop - length(rendered) AS start FROM placed)
SELECT conv_id, perspective, turn, role, name, rendered, start, stop,
  CASE WHEN role = 'assistant' THEN start + length(head) END AS mask_start,
  CASE WHEN role = 'assistant' THEN stop - 1 END AS mask_stop
FROM bounded
"""

# A-Z become a-z and nothing else changes.
_LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _terms(table: str, key: str) -> str:
    return f"SELECT {key}, unnest(regexp_extract_all({_LOWERED.format('text')}, '{_TERM}')) AS term FROM {table}"


SEARCH = f"""
WITH words AS ({_terms('documents', 'doc_id')}),
lengths AS (SELECT doc_id, count(*) AS n FROM words GROUP BY 1),
sums AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM lengths),
counts AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY 1, 2),
rarity AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM counts, sums GROUP BY term, docs),
wanted AS (SELECT DISTINCT * FROM ({_terms('benchmark', 'item_id')})),
scored AS (
  SELECT item_id, doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total))))::BIGINT AS score
  FROM wanted JOIN counts USING (term) JOIN rarity USING (term) JOIN lengths USING (doc_id), sums GROUP BY 1, 2),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 10
"""

# CRC-32 by its definition: a table of 256 states, then byte by byte.
RESAMPLING = f"""
WITH states AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS t
  FROM range(256) r(i)),
words AS ({_terms('documents', 'doc_id')}),
aims AS ({_terms('benchmark', 'item_id')}),
bytes AS (
  SELECT term, hex(encode(term)) AS h FROM (SELECT DISTINCT term FROM words UNION SELECT DISTINCT term FROM aims)),
buckets AS (
  SELECT term, xor(list_reduce(
      list_transform(range(length(h) // 2), lambda k: ('0x' || substr(h, (2 * k + 1)::BIGINT, 2))::BIGINT),
      lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]), 4294967295::BIGINT), 4294967295) % 10000 AS bucket
  FROM bytes, states),
corpus AS (SELECT bucket, count(*) AS s FROM words JOIN buckets USING (term) GROUP BY 1),
aim AS (SELECT bucket, count(*) AS t FROM aims JOIN buckets USING (term) GROUP BY 1),
sums AS (SELECT (SELECT coalesce(sum(s), 0) FROM corpus)::DOUBLE AS big_s, (SELECT coalesce(sum(t), 0) FROM aim)::DOUBLE AS big_t),
gains AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (big_s + 10000)
    / ((coalesce(s, 0) + 1)::DOUBLE * (big_t + 10000))))::BIGINT AS gain
  FROM corpus FULL JOIN aim USING (bucket), sums),
weighed AS (
  SELECT doc_id, count(*) AS n, sum(gain)::BIGINT AS w FROM words JOIN buckets USING (term) JOIN gains USING (bucket) GROUP BY 1),
scored AS (
  SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce(w, 0)::BIGINT AS weight,
    coalesce(w, 0)::BIGINT + floor(-1000 * ln(-ln(
      (('0x' || substr(sha256('2024:' || d.doc_id::VARCHAR), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS score
  FROM documents d LEFT JOIN weighed USING (doc_id)),
places AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS competing
  FROM scored WHERE n_features >= 20)
SELECT s.doc_id, n_features, weight, score, CASE WHEN place <= 10 * competing // 100 THEN place END::BIGINT AS rank
FROM scored s LEFT JOIN places USING (doc_id)
"""

VECTORS = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, embedding::DOUBLE[] AS v,
    embedding IS NOT NULL AND len(list_filter(embedding::DOUBLE[], lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
      AND len(list_filter(embedding::DOUBLE[], lambda x: x <> 0)) > 0 AS valid
  FROM embeddings),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM vectors a JOIN vectors b
  ON a.vec_id <> b.vec_id AND a.valid AND b.valid AND list_cosine_similarity(a.v, b.v) >= 0.95),
reached AS (
  SELECT vec_id AS x, vec_id AS y FROM vectors
  UNION SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x),
counted AS (SELECT x, count(*) AS n FROM links GROUP BY 1)
SELECT x AS vec_id, coalesce(max(n), 0)::BIGINT AS n_links, min(y) AS component_id, x = min(y) AS kept
FROM reached LEFT JOIN counted USING (x) GROUP BY x
"""
