"""SQL twins of the operator queries, for DuckDB over the same tables."""

from __future__ import annotations

from pagelode.plans.reference_sql import _BLOCKS, _CAT, _CONS, _DOMX, _DOTS, _DASH, _GRAPH, _MAP, _NAME, _PIECE, _SCORES, _TYPES, _VALUE, _VAR, _blank, _strip
from pagelode.plans.reference_sql import ORACLE as _REFERENCE

_R = f"r AS (SELECT *, length(t) % 8 AS n, lower(t) AS l FROM (SELECT DISTINCT upper(regexp_replace({_strip('type_id')}, '[^A-Za-z0-9_]+', '_', 'g')) AS t FROM datatype_registry) WHERE t <> '')"


def _row(kind: str, cond: str, *cols: str) -> str:
    c = [*cols, *["NULL"] * (4 - len(cols))]
    return f"SELECT '{kind}' AS kind, " + ", ".join(f"({x})::VARCHAR AS c{i}" for i, x in enumerate(c)) + f" FROM r WHERE {cond}"


def _pick(c: str) -> str:
    return f"ascii(md5({c}))"


_SPANS = """sp AS (SELECT document_id, page, block_id, x0, y0, x1, y1, i - 1 AS span_no, ls[i] AS text, floor((x1 - x0) / 16) / 2 - 5 AS size
  FROM (SELECT *, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT *, string_split(raw_text, chr(10)) AS ls FROM b WHERE raw_text IS NOT NULL)))"""


def _roles(source: str) -> str:
    return f"""ti AS (SELECT document_id, tier, ['heading1', 'heading2', 'heading3', 'body', 'caption', 'comment'][least(dense_rank() OVER (PARTITION BY document_id ORDER BY tier DESC), 6)] AS role
    FROM (SELECT DISTINCT document_id, round_even(size * 2, 0) / 2 AS tier FROM {source} WHERE size > 0)),
  sz AS (SELECT DISTINCT document_id, size FROM {source}), ro AS (SELECT sz.document_id, sz.size, coalesce(arg_min(role, (abs(tier - round_even(sz.size * 2, 0) / 2), -tier)), 'body') AS role FROM sz LEFT JOIN ti ON ti.document_id = sz.document_id GROUP BY ALL)"""


_ESC = "replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
_KEPT = f"""p AS (SELECT *, {_PIECE} AS piece FROM b), q AS (SELECT *, sum(length(piece)) OVER (PARTITION BY document_id ORDER BY coalesce(page, 0), block_id, block_type, trace_id ROWS UNBOUNDED PRECEDING)::BIGINT AS used FROM p),
kept AS (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY used) - 1 AS nth FROM q WHERE piece <> '' AND used <= 5000)"""
_HITS = """h AS (SELECT * FROM (SELECT q.vec_id AS query_id, e.vec_id, row_number() OVER (PARTITION BY q.vec_id ORDER BY list_dot_product(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) DESC, e.vec_id) AS rank
  FROM embeddings e, embeddings q WHERE q.vec_id % 100 = 0) WHERE rank <= 10)"""


def _section(name: str, pred: str, truth: str) -> str:
    return f"""SELECT '{name}' AS section, tp, fp, fn, {_SCORES} FROM (SELECT count(*) FILTER (a.k IS NOT NULL AND z.k IS NOT NULL) AS tp, count(*) FILTER (z.k IS NULL) AS fp, count(*) FILTER (a.k IS NULL) AS fn
      FROM (SELECT DISTINCT k FROM ({pred})) a FULL JOIN (SELECT DISTINCT k FROM ({truth})) z ON a.k = z.k)"""


def _number(x: str) -> str:
    return f"try_cast({x} AS BIGINT)"


ORACLE = {
    "jsonl_roundtrip": "SELECT trace_id, document_id, instruction_name, variation, field_name, bit_range, word_index, uncertain FROM instruction_field_map",
    "jsonl_missing": "SELECT 0::BIGINT AS n_rows",
    "report_roundtrip": "SELECT count(*) AS n_rows, count(DISTINCT document_id) AS n_documents, max(variation) AS last_variation FROM instruction_catalog",
    "uploaded_rows": "SELECT trace_id, type_id, category FROM datatype_registry",
    "csv_union_roundtrip": f"SELECT trace_id, {_blank('data_type_ref')} AS data_type_ref, NULL::VARCHAR AS entity_name FROM field_datatype_catalog UNION ALL SELECT trace_id, NULL, applies_to.entity_name FROM constraint_registry",
    "pages_roundtrip": f"WITH {_BLOCKS} SELECT document_id, page, block_id, md5(raw_text) AS text FROM b WHERE page BETWEEN 10 AND 60",
    "page_range": f"WITH {_BLOCKS} SELECT document_id, block_id FROM b WHERE page BETWEEN 5 AND 25",
    "index_roundtrip": "SELECT label::VARCHAR AS document_id, count(*) AS n, min(vec_id) AS first_vec, sum(count(*)) OVER ()::BIGINT AS n_vectors, max(max(len(embedding))) OVER () AS dim, 'model' AS embedding_model FROM embeddings GROUP BY label",
    "graph_sink": _GRAPH + ' SELECT e."from", rel, e."to" FROM e WHERE e."from" IN (SELECT id FROM n) AND e."to" IN (SELECT id FROM n)',
    "graph_file": f"""WITH t AS (SELECT DISTINCT {_strip('type_id')} AS t, category FROM datatype_registry WHERE {_blank('type_id')} IS NOT NULL AND category IS NOT NULL)
      SELECT t AS "from", 'IS_A' AS rel, category AS "to" FROM t UNION ALL SELECT DISTINCT t, 'node', 'DataType' FROM t""",
    "truth_files": f"WITH {_R} " + " UNION ALL ".join([
        _row("instruction", "true", "l"), _row("field", "n < 4", "t", "NULL", "'F1'", "n || ':0'"), _row("field", "n >= 4", "t", "'CW'", "'F2'", "n"), _row("name", "true", "l"),
        _row("type", "n < 3", "t", "'alias'"), _row("dtype", "n IN (3, 4)", "t", "'V'", "'F'", "t"), _row("domain", "n > 4", "'F'", "'range'", "t"),
        _row("node", "n < 3", "t"), _row("constraint", "n IN (3, 4)", "t"), _row("edge", "n > 4", "t", "'HAS'", "'x'"),
    ]),
    "override_sheet": f"WITH {_R} SELECT t AS scope, 'A' AS field_name, length(t)::VARCHAR AS bit_range, 0 AS word_index FROM r",
    "scope_columns": f"WITH {_CAT} SELECT pos AS trace_id, name AS instruction_name, var AS variation, name AS key_name, coalesce(var, '') AS key_variation FROM c",
    "truth_catalog": f"""WITH m AS (SELECT trace_id AS pos, max(instruction_name) AS instruction_name, max(variation) AS variation, max(opcode_raw) AS opcode_raw, max(execution_unit) AS execution_unit FROM instruction_catalog_mirror GROUP BY trace_id),
      k AS (SELECT {_NAME} AS name, coalesce({_VAR}, '') AS v, pos, {{'o': CASE WHEN upper({_blank('opcode_raw')}) <> 'UNKNOWN' THEN {_blank('opcode_raw')} ELSE 'UNKNOWN' END, 'u': coalesce({_blank('execution_unit')}, 'UNKNOWN_UNIT')}} AS r FROM m),
      o AS (SELECT name, v, arg_max(r, pos).o AS opcode_raw, arg_max(r, pos).u AS u FROM k WHERE name <> '' GROUP BY ALL), w AS (SELECT *, {_VALUE} AS val FROM o)
      SELECT name AS instruction_name, nullif(v, '') AS variation, opcode_raw, CASE WHEN val IS NULL THEN 'unknown' WHEN opcode_raw ILIKE '0x%' THEN 'hex' ELSE 'dec' END AS opcode_radix, val AS opcode_value, u AS execution_unit, 'macro' AS instruction_kind, 1.0::DOUBLE AS confidence_score, 'ground_truth_catalog' AS method FROM w""",
    "truth_field_map": f"WITH {_MAP} SELECT 'run:gt:' || trace_id AS trace_id, name AS instruction_name, var AS variation, upper({_strip('''coalesce(field_name, '')''')}) AS field_name, coalesce(bit_range, '') AS bit_range, 0 AS word_index, 1.0::DOUBLE AS confidence_score, false AS uncertain FROM m",
    "filled_trace_ids": "SELECT CASE WHEN right(trace_id, 1) < '5' THEN trace_id ELSE 'run:gt:' || trace_id END AS trace_id, data_type_ref FROM (SELECT DISTINCT trace_id, data_type_ref FROM field_datatype_catalog)",
    "block_references": """SELECT DISTINCT document_id, block_id, CASE WHEN len(source_refs) > 0 THEN source_refs[1].page ELSE coalesce(page, 1) END AS ref_page, CASE WHEN len(source_refs) > 0 THEN source_refs[1].method END AS ref_method,
      CASE WHEN len(source_refs) > 0 THEN NULL ELSE block_id END AS ref_block, CASE WHEN len(source_refs) > 0 THEN NULL ELSE 4 END AS n_box, concat_ws(':', 'run', page, block_id) AS made_id FROM page_blocks""",
    "field_lines": f"WITH {_MAP} SELECT document_id, name || '|' || coalesce(var, '') || '|' || {_strip('field_name')} AS line, count(*) AS n_rows FROM m WHERE name <> '' AND {_blank('field_name')} IS NOT NULL GROUP BY ALL",
    "item_constraints": f"""WITH r AS (SELECT DISTINCT ON (trace_id) *, regexp_extract(trace_id, '([0-9]+)$', 1)::BIGINT AS n, coalesce({_blank('constraint_type_level2')}, 'unknown') AS cand,
        CASE WHEN applies_to.entity_type = 'Field' THEN {_blank('applies_to.entity_name')} END AS f, CASE WHEN applies_to.entity_type = 'Instruction' THEN {_blank('applies_to.entity_name')} END AS i FROM constraint_registry)
      SELECT 'C_LLM_' || CASE WHEN n < 1000 THEN lpad(n::VARCHAR, 4, '0') ELSE n::VARCHAR END AS constraint_id, left(replace(CASE WHEN length(cand) % 2 = 0 THEN upper(cand) ELSE cand END, ' ', '_'), 64) AS constraint_type_level1,
        left(coalesce(nullif(expression, ''), verbatim_sentence, ''), 2000) AS expression, CASE WHEN f IS NOT NULL THEN 'Field' WHEN i IS NOT NULL THEN 'Instruction' ELSE 'Document' END AS entity_type, coalesce(f, i, 'GLOBAL') AS entity_name, 7 AS page FROM r""",
    "cited_blocks": f"WITH {_BLOCKS} SELECT document_id, block_id FROM b WHERE {_pick('block_id')} % 3 = 0",
    "selected_blocks": f"""WITH {_BLOCKS}, o AS (SELECT *, row_number() OVER (ORDER BY page, y0, x0, trace_id) - 1 AS read_pos FROM b WHERE document_id = 'hx9_core_trm')
      SELECT block_id, read_pos FROM o WHERE (page IN (1, 7) OR page BETWEEN 3 AND 5) AND {_blank('raw_text')} IS NOT NULL""",
    "text_outside_tables": f"""WITH {_BLOCKS}, u AS (SELECT document_id, page, block_id, block_type, x0, y0, x1, y1 FROM b UNION ALL SELECT document_id, page, 't_' || block_id, 'table', x0, y0, x1, y1 FROM b WHERE {_pick('trace_id')} % 4 = 0), t AS (SELECT * FROM u WHERE block_type = 'table')
      SELECT document_id, block_id, block_type FROM u WHERE NOT (block_type = 'text' AND EXISTS (SELECT 1 FROM t WHERE t.document_id = u.document_id AND t.page = u.page AND (u.x0 + u.x1) / 2 BETWEEN t.x0 AND t.x1 AND (u.y0 + u.y1) / 2 BETWEEN t.y0 AND t.y1
        AND greatest(0, least(u.x1, t.x1) - greatest(u.x0, t.x0)) * greatest(0, least(u.y1, t.y1) - greatest(u.y0, t.y0)) / ((u.x1 - u.x0) * (u.y1 - u.y0)) > 0.35))""",
    "numbered_blocks": f"WITH {_BLOCKS} SELECT trace_id, 'p' || page || '_b' || (row_number() OVER (PARTITION BY document_id, page ORDER BY block_type <> 'table', y0, x0, trace_id) - 1) AS block_id FROM b",
    "page_extents": f"WITH {_BLOCKS} SELECT document_id, page, min(y0) AS min_y, max(y1) AS max_y FROM b GROUP BY ALL",
    "box_relations": f"""WITH {_BLOCKS}, n AS (SELECT document_id, block_id, x0, y0, x1, y1, lead(x0) OVER w AS a0, lead(y0) OVER w AS b0, lead(x1) OVER w AS a1, lead(y1) OVER w AS b1 FROM b WINDOW w AS (PARTITION BY document_id, page ORDER BY y0, x0, trace_id)),
      m AS (SELECT *, least(x1, a1) - greatest(x0, a0) AS sw, least(y1, b1) - greatest(y0, b0) AS sh, least(x1 - x0, a1 - a0) AS nw, least(y1 - y0, b1 - b0) AS nh FROM n WHERE a0 IS NOT NULL),
      k AS (SELECT *, CASE WHEN nw <= 0 OR sw <= 0 THEN 0.0::DOUBLE ELSE sw / nw END AS wr, CASE WHEN nh <= 0 OR sh <= 0 THEN 0.0::DOUBLE ELSE sh / nh END AS hr FROM m)
      SELECT document_id, block_id, round((greatest(x1, a1) - least(x0, a0)) * (greatest(y1, b1) - least(y0, b0)), 4) AS union_area, round(greatest(0.0::DOUBLE, sw) * greatest(0.0::DOUBLE, sh), 4) AS shared, round(wr, 4) AS width_ratio, round(hr, 4) AS height_ratio,
        greatest(y0, b0) - least(y1, b1) <= 5 AND wr >= 0.5 AS stacked, greatest(x0, a0) - least(x1, a1) <= 5 AND hr >= 0.5 AS beside, y0 <= b1 AND b0 <= y1 AS meets,
        (x0 + x1) / 2 >= a0 AND (x0 + x1) / 2 <= a1 AND (y0 + y1) / 2 >= b0 AND (y0 + y1) / 2 <= b1 AS inside, round(612.0::DOUBLE * (y1 - y0), 4) AS full_width FROM k""",
    "span_roles": f"""WITH {_BLOCKS}, {_SPANS}, mv AS (SELECT * REPLACE (CASE WHEN span_no % 3 = 2 THEN size + 0.25::DOUBLE ELSE size END AS size) FROM sp), {_roles('mv')}
      SELECT mv.document_id, block_id AS block_no, span_no, role FROM mv JOIN ro ON ro.document_id = mv.document_id AND ro.size = mv.size""",
    "tagged_headings": f"""WITH {_BLOCKS}, {_SPANS}, {_roles('sp')}, tg AS (SELECT sp.*, '<' || role || '>' || {_ESC} || '</' || role || '>' AS tag FROM sp JOIN ro ON ro.document_id = sp.document_id AND ro.size = sp.size WHERE text <> ''),
      j AS (SELECT b.document_id, b.block_id, tg.block_id AS no, span_no, tag FROM b JOIN tg ON tg.document_id = b.document_id AND tg.page = b.page AND abs(tg.x0 - b.x0) <= 3 AND abs(tg.y0 - b.y0) <= 3 AND abs(tg.x1 - b.x1) <= 3 AND abs(tg.y1 - b.y1) <= 3 WHERE b.block_type IN ('text', 'equation'))
      SELECT document_id, block_id, md5(string_agg(tag, '' ORDER BY span_no)) AS tagged FROM (SELECT *, min(no) OVER (PARTITION BY document_id, block_id) AS first FROM j) WHERE no = first GROUP BY document_id, block_id""",
    "heading_texts": f"""WITH {_BLOCKS} SELECT document_id, block_id, 0 AS n, CASE WHEN page % 2 = 0 THEN 'heading1' ELSE 'body' END AS role, CASE WHEN page % 2 = 0 THEN block_id || ' <sup>' ELSE block_type END AS text FROM b
      UNION ALL SELECT document_id, block_id, 1, 'body', 'x2 & ' || block_type FROM b WHERE page % 2 = 0""",
    "merged_spans": f"WITH {_BLOCKS} SELECT document_id, block_id, md5(CASE WHEN contains(raw_text, chr(10)) THEN replace(raw_text, ' ', '') ELSE raw_text END) AS text FROM b WHERE raw_text IS NOT NULL",
    "script_marks": f"""WITH {_BLOCKS}, z AS (SELECT *, CASE WHEN {_pick('block_id')} % 2 = 0 THEN 400.0::DOUBLE ELSE 300.0::DOUBLE END AS size, (y0 + y1) / 2 AS cy FROM b), r AS (SELECT *, max(size) OVER (PARTITION BY document_id, page) AS ref FROM z),
      y AS (SELECT *, avg(cy) FILTER (size >= ref * 0.91) OVER (PARTITION BY document_id, page) AS body FROM r)
      SELECT document_id, block_id, CASE WHEN {_pick('trace_id')} % 9 = 0 THEN 'sup' WHEN size >= ref * 0.92 THEN 'normal' WHEN cy < body - 0.07 * ref THEN 'sup' WHEN cy > body + 0.05 * ref THEN 'sub' ELSE 'normal' END AS script FROM y""",
    "block_sizes": f"""WITH {_BLOCKS} SELECT a.document_id, a.block_id, round(greatest(6.0::DOUBLE, least(24.0::DOUBLE, coalesce(avg(({_pick('z.block_id')} % 40)::DOUBLE) FILTER (least(a.x1, z.x1) > greatest(a.x0, z.x0) AND least(a.y1, z.y1) > greatest(a.y0, z.y0)), 11.0::DOUBLE))), 6) AS size
      FROM b a JOIN b z ON z.document_id = a.document_id AND z.page = a.page GROUP BY a.document_id, a.block_id""",
    "supplemented": f"""WITH {_BLOCKS}, ch AS (SELECT document_id, doc_id, i, substring(text, i * 6000 + 1, 6000) AS text FROM (SELECT *, unnest(range(0, ceil(length(text) / 6000.0)::BIGINT)) AS i FROM documents WHERE document_id IS NOT NULL AND {_blank('text')} IS NOT NULL)), n AS (SELECT document_id, count(*) AS n FROM b GROUP BY ALL)
      SELECT document_id, page, block_id, extraction_method, md5(raw_text) AS text FROM b UNION ALL SELECT ch.document_id, 1, 'supp_' || (coalesce(n, 0) + row_number() OVER (PARTITION BY ch.document_id ORDER BY doc_id, i) - 1), 'supplemental_corpus', md5(text) FROM ch LEFT JOIN n ON n.document_id = ch.document_id WHERE {_blank('text')} IS NOT NULL""",
    "prompts": f"""WITH {_BLOCKS}, {_KEPT}, t AS (SELECT document_id, string_agg(piece, chr(10) ORDER BY used) AS prompt FROM kept GROUP BY document_id)
      SELECT d.document_id, md5(coalesce(prompt, '(no text blocks)')) AS prompt, length(coalesce(prompt, '(no text blocks)')) AS n_chars FROM (SELECT DISTINCT document_id FROM b) d LEFT JOIN t ON t.document_id = d.document_id""",
    "embedded_texts": """WITH t AS (SELECT doc_id, length(coalesce(text, ''))::DOUBLE AS a, (length(coalesce(text, '')) - length(replace(coalesce(text, ''), 'e', '')))::DOUBLE AS c FROM documents), n AS (SELECT *, sqrt(a * a + c * c + 1) AS r FROM t)
      SELECT doc_id, round(a / r, 6) AS v0, round(c / r, 6) AS v1, round(1 / r, 6) AS v2 FROM n""",
    "narrowed_blocks": f"WITH {_BLOCKS} SELECT document_id, block_id, 'ok' AS reason FROM b WHERE block_type = 'table' UNION ALL SELECT document_id, block_id, 'no_hits' FROM b",
    "ranked_ids": f"WITH {_HITS} SELECT 'b' || (vec_id % 50) AS block_id, min(rank) AS rank FROM h GROUP BY 1",
    "chat_contexts": f"WITH {_HITS} SELECT query_id::VARCHAR AS conv_id, string_agg('[0.5000] page=1 block_id=b' || vec_id || chr(10) || 'text', chr(10) || chr(10) ORDER BY rank) AS context FROM h WHERE rank <= 8 GROUP BY 1",
    "coverage_measure": f"SELECT page, sum(instruction_count)::DOUBLE AS value FROM ({_REFERENCE['page_coverage']}) GROUP BY page",
    "viewer_nodes": _GRAPH + ', f5 AS (SELECT * FROM e ORDER BY 1, 2, 3 LIMIT 5000), x AS (SELECT "from" AS id FROM f5 UNION SELECT "to" FROM f5) SELECT type, count(*) AS n FROM n GROUP BY type UNION ALL SELECT \'Unknown\', count(*) FROM x WHERE id NOT IN (SELECT id FROM n) HAVING count(*) > 0',
    "eval_graph": _GRAPH + " " + " UNION ALL ".join([
        _section("constraints", "SELECT cid AS k FROM k", f"SELECT cid AS k FROM k WHERE {_pick('cid')} % 2 = 0"),
        _section("nodes", "SELECT id AS k FROM n", f"SELECT id AS k FROM n WHERE type <> 'Constraint' OR {_pick('substring(id, 12)')} % 2 = 0"),
        _section("edges", 'SELECT "from" || chr(1) || rel || chr(1) || "to" AS k FROM e', f"""SELECT "from" || chr(1) || rel || chr(1) || "to" AS k FROM e WHERE rel <> 'APPLIES_TO' OR {_pick('substring("from", 12)')} % 2 = 0"""),
    ]),
    "matched_aliases": rf"""WITH a AS (SELECT DISTINCT left(type_id, 1) || 'x' || substring(type_id, 2, 99) AS name FROM datatype_registry WHERE type_id IS NOT NULL), z AS (SELECT DISTINCT upper({_strip('type_id')}) AS c FROM datatype_registry WHERE {_blank('type_id')} IS NOT NULL),
      d AS (SELECT name, levenshtein(lower(regexp_replace({_strip('name')}, '[^\p{{L}}\p{{N}}]', '', 'g')), lower(regexp_replace(c, '[^\p{{L}}\p{{N}}]', '', 'g'))) AS distance FROM a, z) SELECT name, min(distance)::INT AS distance FROM d WHERE distance <= 2 GROUP BY name""",
    "overlapping_chunks": "SELECT doc_id::VARCHAR AS document_id, i::INT AS chunk_no, md5(substring(text, i * 1800 + 1, 2000)) AS text FROM (SELECT doc_id, text, unnest(range(0, greatest(1, ceil((length(text) - 200) / 1800.0)::BIGINT))) AS i FROM documents WHERE length(text) > 0)",
    "satisfied_domains": rf"""WITH {_DOMX}, y AS (SELECT *, CASE WHEN regexp_matches(av, {_DOTS}) THEN regexp_extract(av, {_DOTS}, 1) WHEN regexp_matches(av, {_DASH}) THEN regexp_extract(av, {_DASH}, 1) END AS lo, CASE WHEN regexp_matches(av, {_DOTS}) THEN regexp_extract(av, {_DOTS}, 2) WHEN regexp_matches(av, {_DASH}) THEN regexp_extract(av, {_DASH}, 2) END AS hi FROM x)
      SELECT trace_id, CASE WHEN form = 'enum' THEN CASE WHEN av <> '' THEN list_contains(CASE WHEN len(items) > 0 THEN items ELSE [av] END, '3') END WHEN form = 'range' AND {_number('lo')} IS NOT NULL AND {_number('hi')} IS NOT NULL THEN 3 BETWEEN {_number('lo')} AND {_number('hi')} END AS satisfied FROM y""",
    "typed_fields": f"""WITH {_TYPES}, {_DOMX}, t AS (SELECT DISTINCT document_id, name, coalesce(var, '') AS var, upper(field_name) AS field, dt AS type_id FROM f WHERE field_name IS NOT NULL AND dt IS NOT NULL),
      o AS (SELECT DISTINCT x.document_id, {_NAME} AS name, coalesce({_VAR}, '') AS var, upper({_blank('x.field_name')}) AS field, form FROM x JOIN (SELECT DISTINCT trace_id, instruction_name, variation FROM field_domain_catalog) USING (trace_id) WHERE {_blank('x.field_name')} IS NOT NULL)
      SELECT t.document_id, t.name, t.var, t.field, type_id, form FROM t JOIN o ON o.document_id = t.document_id AND o.name = t.name AND o.var = t.var AND o.field = t.field""",
    "constraint_kinds": f"WITH {_CONS} SELECT upper(en) AS field, l1 AS constraint_type_level1, count(*) AS n_rows FROM k WHERE et = 'Field' GROUP BY ALL",
    "types_of_one_manual": f"WITH {_TYPES} SELECT lower(dt) AS type_id, min(document_id) AS document_id FROM f WHERE dt IS NOT NULL GROUP BY lower(dt) HAVING count(DISTINCT document_id) = 1",
    "version_changes": f"""WITH {_CAT}, s AS (SELECT DISTINCT document_id, scope FROM c), b AS (SELECT document_id, lag(document_id) OVER (PARTITION BY regexp_replace(document_id, '_[0-9]+$', '') ORDER BY document_id) AS before FROM (SELECT DISTINCT document_id FROM s)),
      j AS (SELECT b.document_id, s.scope, 1 AS n, 0 AS o FROM s JOIN b ON b.document_id = s.document_id WHERE before IS NOT NULL UNION ALL SELECT b.document_id, s.scope, 0, 1 FROM s JOIN b ON b.before = s.document_id), p AS (SELECT document_id, scope, max(n) AS n, max(o) AS o FROM j GROUP BY ALL)
      SELECT document_id, count(*) FILTER (o = 0) AS added, count(*) FILTER (n = 0) AS removed, count(*) FILTER (n = 1 AND o = 1) AS kept FROM p GROUP BY ALL""",
    "retrieved_blocks": f"""WITH {_BLOCKS}, r AS (SELECT *, row_number() OVER (PARTITION BY document_id, page ORDER BY block_id, block_type, trace_id) - 1 AS at_page FROM b WHERE {_blank('raw_text')} IS NOT NULL),
      x AS (SELECT document_id, block_id, lower('[page=' || page || ' block_id=' || block_id || ' type=' || block_type || ' index_on_page=' || at_page || ']' || chr(10) || substring({_strip('raw_text')}, 1, 12000)) AS t FROM r),
      y AS (SELECT document_id, block_id, {' + '.join(f"contains(t, '{w}')::INT" for w in ('reset', 'register', 'overflow', 'sticky'))} AS score FROM x)
      SELECT document_id, block_id, row_number() OVER (ORDER BY score DESC, document_id || chr(0) || block_id) AS rank FROM y WHERE score > 0 QUALIFY rank <= 48""",
    "neighbour_windows": f"""WITH {_BLOCKS}, o AS (SELECT document_id, block_id, trace_id, row_number() OVER (PARTITION BY document_id ORDER BY page, y0, x0, trace_id) AS at_doc FROM b), h AS (SELECT * FROM o WHERE {_pick('trace_id')} % 16 = 0)
      SELECT DISTINCT o.document_id, o.block_id FROM o JOIN h ON h.document_id = o.document_id AND o.at_doc BETWEEN h.at_doc - 1 AND h.at_doc + 1""",
    "extracted_instructions": f"""WITH {_BLOCKS}, {_KEPT}, f AS (SELECT document_id, page, arg_min(block_id, nth) AS block_id FROM kept GROUP BY ALL)
      SELECT 'run:instr:' || (row_number() OVER (PARTITION BY document_id ORDER BY 'I' || page) - 1) AS trace_id, document_id, 'I' || page AS instruction_name, block_id AS aliases, page::BIGINT AS opcode_value, 'UNKNOWN_UNIT' AS execution_unit, 0.5::DOUBLE AS confidence_score, page FROM f""",
    "extracted_domains": f"WITH {_BLOCKS}, {_KEPT} SELECT document_id, nth::INT AS pos, block_id AS field_name, 'range' AS allowed_value_form, '0..' || page AS allowed_values_or_range, page FROM kept",
    "optical_texts": f"""WITH {_BLOCKS}, t AS (SELECT document_id, block_id, substring(coalesce(raw_text, ''), 1, 300) AS t FROM b)
      SELECT document_id, block_id, md5(t) AS text, CASE WHEN length({_strip('t')}) = 0 THEN 0.0::DOUBLE ELSE round(least(0.9::DOUBLE, 0.45::DOUBLE + 0.005::DOUBLE * length({_strip('t')})), 4) END AS confidence_score FROM t""",
    "table_cells": f"WITH {_BLOCKS} SELECT document_id, block_id, md5(CASE WHEN {_pick('block_id')} % 2 = 0 THEN raw_text ELSE 'other' END) AS text FROM b WHERE block_type = 'table' AND raw_text IS NOT NULL",
}
