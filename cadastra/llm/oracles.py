"""SQL counterparts of the queries that SQL can express."""

from __future__ import annotations

from cadastra.llm.licenses import TEMPLATES, THRESHOLD, template_bigrams
from cadastra.llm.queries import ANCHOR_EVERY, COSINE, LABELS, RELABEL_EVERY


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_TEMPLATE_ROWS = ", ".join(f"({_text(name)}, [{', '.join(map(_text, template_bigrams(body)))}])" for name, body in TEMPLATES)

ORACLES: dict[str, str] = {
    "op7_warc": r"""
WITH hashed AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex,
         min(page_id) OVER (PARTITION BY sha1(coalesce(html, ''))) AS first_id
  FROM pages
), bits AS (
  SELECT *, array_to_string(list_transform(string_split(hex, ''),
    lambda c: ['0000','0001','0010','0011','0100','0101','0110','0111','1000','1001','1010','1011','1100','1101','1110','1111']
         [instr('0123456789abcdef', c)]), '') AS b
  FROM hashed
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1
    + 16 * substr(b, 5 * i::INT + 1, 1)::INT + 8 * substr(b, 5 * i::INT + 2, 1)::INT + 4 * substr(b, 5 * i::INT + 3, 1)::INT
    + 2 * substr(b, 5 * i::INT + 4, 1)::INT + substr(b, 5 * i::INT + 5, 1)::INT, 1)), '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM bits
""",
    "op8_embedding_dups": f"""
WITH RECURSIVE vectors AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
), usable AS (
  SELECT * FROM vectors
  WHERE label IS NOT NULL AND e IS NOT NULL
    AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= {COSINE}
), reach AS (
  SELECT vec_id AS node, vec_id AS root FROM embeddings
  UNION
  SELECT pairs.b, reach.root FROM reach JOIN pairs ON pairs.a = reach.node
), roots AS (
  SELECT node AS vec_id, min(root) AS component_id FROM reach GROUP BY node
), degrees AS (
  SELECT a AS vec_id, count(*) AS n FROM pairs GROUP BY a
)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM roots LEFT JOIN degrees USING (vec_id)
""",
    "op11_hard_negatives": f"""
WITH usable AS (
  SELECT row_number() OVER () AS uid, vec_id, CASE WHEN vec_id % {RELABEL_EVERY} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.uid, a.vec_id AS anchor_id, b.vec_id AS other_id, b.uid AS other, a.label = b.label AS same,
         list_dot_product(a.q, b.q)::BIGINT AS score
  FROM usable a JOIN usable b ON a.uid <> b.uid AND len(a.q) = len(b.q) WHERE a.vec_id % {ANCHOR_EVERY} = 0
), positives AS (
  SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY uid ORDER BY score DESC, other_id, other) <= 5
), ranked AS (
  SELECT p.anchor_id, p.other_id AS positive_id, n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.uid, p.other ORDER BY n.score DESC, n.other_id, n.other)::INT AS rank
  FROM positives p JOIN scored n ON p.uid = n.uid AND NOT n.same AND 100 * n.score BETWEEN 50 * p.score AND 95 * p.score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 3
""",
    "op10_licenses": rf"""
WITH templates(license, t) AS (VALUES {_TEMPLATE_ROWS}),
passages AS (
  SELECT doc_id, unnest(list_distinct(list_concat(
    [text], regexp_split_to_array(text, '\n[ \t\r]*\n'), string_split(text, chr(10)),
    string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(10), 'g'), chr(10))))) AS p
  FROM documents WHERE text IS NOT NULL
), words AS (
  SELECT doc_id, string_split(trim(regexp_replace(lower(p), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ') AS w FROM passages
), grams AS (
  SELECT doc_id, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM words WHERE len(w) > 1
), scored AS (
  SELECT doc_id, license, 2.0::DOUBLE * len(list_intersect(g, t)) / (len(g) + len(t)) AS dice
  FROM grams JOIN templates ON len(g) BETWEEN len(t) * {THRESHOLD} / (2 - {THRESHOLD}) - 1 AND len(t) * (2 - {THRESHOLD}) / {THRESHOLD} + 1
)
SELECT doc_id, license, max(dice) AS dice, count(*)::BIGINT AS n_matches FROM scored WHERE dice >= {THRESHOLD} GROUP BY doc_id, license
""",
}
