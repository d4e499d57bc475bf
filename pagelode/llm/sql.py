"""SQL twins of the queries that SQL can express."""

from __future__ import annotations

_ALNUM = r"nullif(lower(regexp_replace({0}, '[^\p{{L}}\p{{N}}]', '', 'g')), '')"

_P1 = rf"""
WITH t AS (
  SELECT DISTINCT trace_id, document_id, coalesce({_ALNUM.format('instruction_name')}, '') AS nk, {_ALNUM.format('variation')} AS vk,
    instruction_name, opcode_raw,
    CASE WHEN confidence_score IS NOT NULL AND NOT isnan(confidence_score) AND confidence_score BETWEEN 0 AND 1 THEN confidence_score ELSE -1 END AS conf,
    extracted_at, coalesce(regexp_full_match(opcode_raw, '\s*([0-9]+|0[xX][0-9A-Fa-f]+)\s*'), false) AS readable
  FROM instruction_catalog
), r AS (
  SELECT *, count(*) OVER g AS n, min(trace_id) OVER g AS gid,
    row_number() OVER (PARTITION BY document_id, nk, vk ORDER BY conf DESC, extracted_at DESC NULLS LAST, trace_id) AS rn,
    row_number() OVER (PARTITION BY document_id, nk, vk ORDER BY readable DESC, conf DESC, extracted_at DESC NULLS LAST, trace_id) AS ro
  FROM t WINDOW g AS (PARTITION BY document_id, nk, vk)
), s AS (
  SELECT gid, document_id, max(CASE WHEN rn = 1 THEN trace_id END) AS name_id, max(CASE WHEN rn = 1 THEN coalesce(instruction_name, '') END) AS name,
    max(CASE WHEN ro = 1 THEN trace_id END) AS opcode_id, max(CASE WHEN ro = 1 AND readable THEN opcode_raw END) AS opcode
  FROM r WHERE n >= 2 GROUP BY gid, document_id, nk, vk
)"""

_CANON = r"lower(regexp_replace(coalesce({0}, ''), '[^\p{{L}}\p{{M}}\p{{N}}]', '', 'g'))"

_P6 = rf"""
WITH t AS (
  SELECT DISTINCT trace_id, document_id, variation, word_index,
    least({_CANON.format('instruction_name')}, {_CANON.format('field_name')}) AS a,
    greatest({_CANON.format('instruction_name')}, {_CANON.format('field_name')}) AS b,
    array_to_string(list_sort(regexp_extract_all(lower(regexp_replace(coalesce(bit_range, ''), '\p{{Cf}}', '', 'g')), '[\p{{L}}\p{{M}}\p{{N}}]+')), ' ') AS bits
  FROM instruction_field_map
)"""

ORACLE = {
    "p1_found": _P1 + " SELECT gid AS group_trace_id, name_id AS name_trace_id, opcode_id AS opcode_trace_id FROM s",
    "p1_survivors": _P1 + " SELECT document_id, gid AS group_id, name_id, name, opcode_id, opcode FROM s",
    "p6_found": _P6
    + """ SELECT * FROM (SELECT min(trace_id) OVER (PARTITION BY document_id, variation, word_index, a, b, bits) AS keep_trace_id,
      trace_id AS copy_trace_id FROM t) WHERE keep_trace_id <> copy_trace_id""",
    "p6_collapsed": _P6 + " SELECT min(trace_id) AS keep, count(*) AS n_copies FROM t GROUP BY document_id, variation, word_index, a, b, bits",
    "p7_roundtrip": "SELECT doc_id, length(text) AS n_chars, md5(text) AS digest, 0 AS n_misfilled FROM documents WHERE text <> ''",
    "p9_roundtrip": "SELECT doc_id, length(text) AS n_chars, md5(text) AS digest, 0 AS n_too_long FROM documents WHERE text <> ''",
    "p8_found": r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents WHERE text IS NOT NULL),
iw AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM eval_items WHERE text IS NOT NULL),
ds AS (SELECT doc_id, array_to_string(w[i:i+11], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 10)) AS i FROM dw WHERE len(w) >= 12)),
its AS (SELECT DISTINCT item_id, array_to_string(w[i:i+11], ' ') AS s FROM (SELECT item_id, w, unnest(range(1, len(w) - 10)) AS i FROM iw WHERE len(w) >= 12))
SELECT DISTINCT doc_id, item_id FROM ds JOIN its USING (s)""",
}
