"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP10 = f"""
WITH d AS (SELECT doc_id, sha256({LOWER}) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
"""

OP5 = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT AS h
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY 1),
w AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight,
         source_size * 2.0::DOUBLE AS lim, sum(source_size) OVER () * 1.5::DOUBLE AS budget
  FROM s),
o AS (
  SELECT *, (budget - coalesce(sum(lim) OVER (ORDER BY lim / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY lim / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w),
l AS (SELECT min_by(level, lim / weight) AS level FROM o WHERE level * weight <= lim),
t AS (
  SELECT source, source_size, least(lim, coalesce(l.level * weight, lim)) AS target FROM w LEFT JOIN l ON true),
b AS (
  SELECT *, floor(target / greatest(source_size, 1))::BIGINT AS copies,
         floor(target + 0.5)::BIGINT - floor(target / greatest(source_size, 1))::BIGINT * source_size AS budget
  FROM t),
r AS (
  SELECT d.doc_id, d.size, b.source_size, b.target, b.copies, b.budget,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target, (copies * size + greatest(0, least(size, budget - before)))::BIGINT AS taken FROM r
"""

WORDS = f"regexp_extract_all({LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

OP1 = f"""
WITH iw AS (SELECT item_id, {WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS l, array_to_string(w[i + 1 : i + least(len(w), 10)], ' ') AS s
  FROM (SELECT *, unnest(range(greatest(len(w) - 9, 1))) AS i FROM iw WHERE len(w) > 0)),
dw AS (SELECT doc_id, {WORDS} AS w FROM documents),
dg AS (
  SELECT doc_id, l, i, array_to_string(w[i + 1 : i + l], ' ') AS s
  FROM (SELECT doc_id, w, l, unnest(range(len(w) - l + 1)) AS i FROM dw, (SELECT DISTINCT l FROM win) WHERE len(w) >= l)),
hit AS (SELECT doc_id, i, l, item_id FROM dg JOIN win USING (l, s)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + l)) AS p FROM hit) GROUP BY 1),
itm AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS names FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM hit) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN pos USING (doc_id) LEFT JOIN itm USING (doc_id)
"""

#: Lengths of the template: <s>, newline and </s>, and the marks around all but assistants.
OP9 = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
f AS (
  SELECT *, length(text) + len(regexp_extract_all(text, '\\\\|<s>|</s>|\[INST\]|\[/INST\]'))
            + length(role) + len(regexp_extract_all(role, '\\\\|<s>|</s>|\[INST\]|\[/INST\]|\n')) + 8 + CASE WHEN role = 'assistant' THEN 0 ELSE 15 END AS size
  FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(size)::BIGINT AS formatted_chars
FROM f GROUP BY conv_id
"""

ORACLES = {"op1_decontamination": OP1, "op9_chat": OP9, "op5_mixing": OP5, "op10_exact_dedup": OP10}
