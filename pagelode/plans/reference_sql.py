"""SQL twins of the reference queries, for DuckDB over the same tables."""

from __future__ import annotations


def _strip(c: str) -> str:
    return rf"regexp_replace({c}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"


def _blank(c: str) -> str:
    return f"nullif({_strip(c)}, '')"


_NAME = f"upper({_strip('''coalesce(instruction_name, '')''')})"
_VAR = f"upper({_blank('variation')})"
_SCOPE = f"concat_ws('|', {_NAME}, {_VAR})"
_OPC = _strip("opcode_raw")
_VALUE = rf"""CASE WHEN regexp_full_match({_OPC}, '0[xX]0*[0-9A-Fa-f]{{1,15}}') THEN lower({_OPC})::BIGINT
  WHEN regexp_full_match({_OPC}, '-?[0-9]+') THEN try_cast({_OPC} AS BIGINT) END"""

_BLOCKS = """b AS (SELECT DISTINCT trace_id, document_id, page, block_id, block_type, bbox.x0 AS x0, bbox.y0 AS y0, bbox.x1 AS x1, bbox.y1 AS y1,
  raw_text, extraction_method, confidence_score FROM page_blocks)"""
_CAT = f"""c AS (SELECT trace_id AS pos, any_value(document_id) AS document_id, any_value({_NAME}) AS name, any_value({_VAR}) AS var, any_value({_SCOPE}) AS scope,
  any_value(opcode_raw) AS opcode_raw, any_value({_VALUE}) AS opc, any_value(opcode_value) AS opcode_value, any_value(execution_unit) AS execution_unit, any_value(confidence_score) AS conf, any_value(source_refs) AS refs FROM instruction_catalog GROUP BY trace_id)"""
_MAP = f"""m AS (SELECT trace_id, any_value(document_id) AS document_id, any_value({_NAME}) AS name, any_value({_VAR}) AS var, any_value({_SCOPE}) AS scope, any_value(field_name) AS field_name,
  any_value(bit_range) AS bit_range, any_value(confidence_score) AS conf, any_value(uncertain) AS uncertain FROM instruction_field_map GROUP BY trace_id)"""
_TYPES = f"""f AS (SELECT trace_id, any_value(document_id) AS document_id, any_value({_NAME}) AS name, any_value({_VAR}) AS var, any_value({_blank('field_name')}) AS field_name,
  any_value({_blank('data_type_ref')}) AS dt FROM field_datatype_catalog GROUP BY trace_id)"""
_CONS = f"""k AS (SELECT trace_id, any_value(document_id) AS document_id, any_value({_strip('constraint_id')}) AS cid, any_value({_strip('applies_to.entity_type')}) AS et, any_value({_blank('applies_to.entity_name')}) AS en,
  any_value(constraint_type_level1) AS l1, any_value(constraint_type_level2) AS l2, any_value(source_refs) AS refs FROM constraint_registry GROUP BY trace_id)"""
_DOM = f"""d AS (SELECT trace_id, any_value(document_id) AS document_id, any_value(coalesce({_blank('field_name')}, 'UNKNOWN')) AS fn, any_value(field_name) AS field_name,
  any_value(CASE WHEN lower({_strip('allowed_value_form')}) IN ('enum', 'range', 'mask', 'set', 'other') THEN lower({_strip('allowed_value_form')}) ELSE 'range' END) AS form,
  any_value({_strip('''coalesce(allowed_values_or_range, '')''')}) AS av FROM field_domain_catalog GROUP BY trace_id)"""

_FILL = "/* unspecified — fill allowed_values_or_range in field_domain_catalog */"
_DOTS = r"'(0x[0-9a-fA-F]+|[0-9]+)\s*\.\.\s*(0x[0-9a-fA-F]+|[0-9]+)'"
_DASH = r"'([0-9]+)\s*-\s*([0-9]+)'"
_EXPR = rf"""CASE
  WHEN av = '' AND form = 'enum' THEN fn || ' IN ({_FILL})' WHEN av = '' AND form = 'range' THEN fn || ' RANGE ({_FILL})'
  WHEN av = '' AND form = 'mask' THEN fn || ' MASK (/* unspecified */)' WHEN av = '' AND form = 'set' THEN fn || ' SET (/* unspecified */)'
  WHEN av = '' THEN fn || ' (' || form || ', values unspecified)'
  WHEN form = 'enum' THEN fn || ' IN (' || array_to_string(CASE WHEN len(items) > 0 THEN items ELSE [av] END, ', ') || ')'
  WHEN form = 'range' AND regexp_matches(av, {_DOTS}) THEN regexp_extract(av, {_DOTS}, 1) || ' <= ' || fn || ' <= ' || regexp_extract(av, {_DOTS}, 2)
  WHEN form = 'range' AND regexp_matches(av, {_DASH}) THEN regexp_extract(av, {_DASH}, 1) || ' <= ' || fn || ' <= ' || regexp_extract(av, {_DASH}, 2)
  WHEN form = 'range' THEN fn || ' RANGE ' || av ELSE fn || ' (' || form || ') ' || av END"""
_DOMX = rf"""{_DOM}, x AS (SELECT *, list_filter(list_transform(string_split_regex(av, '[|,;]+'), lambda s: {_strip('s')}), lambda s: s <> '') AS items FROM d)"""

_WIDTH = rf"""CASE WHEN regexp_full_match({_strip('bit_range')}, '[0-9]{{1,9}}\s*:\s*[0-9]{{1,9}}')
  THEN abs(regexp_extract({_strip('bit_range')}, '([0-9]+)\s*:\s*([0-9]+)', 1)::INT - regexp_extract({_strip('bit_range')}, '([0-9]+)\s*:\s*([0-9]+)', 2)::INT) + 1
  WHEN regexp_full_match({_strip('bit_range')}, '[0-9]+') THEN 1 ELSE 4 END"""
_TYPED = f"""w AS (SELECT *, {_WIDTH} AS width FROM m), t AS (SELECT *, CASE WHEN width <= 64 THEN 'uint' || width ELSE 'uint_wide' END AS type_id,
  CASE WHEN width < 63 THEN '0..' || ((1::BIGINT << width::INT) - 1) ELSE '0..2^' || width || '-1' END AS domain FROM w)"""

_NUM = r"(0x[0-9a-f]{1,15}|[0-9]{1,18})"
_IV = rf"'^[\[(]?\s*{_NUM}\s*(?:\.\.|~|-|–|:|,|\bto\b)\s*{_NUM}\s*[\])]?$'"

_KEYED_LINES = r"""lines AS (SELECT document_id, page, block_type, unnest(string_split(raw_text, chr(10))) AS line FROM b),
kl AS (SELECT document_id, page, block_type, line AS raw, regexp_replace(regexp_replace(lower(""" + _strip("line") + r"""), '[0-9]+', '#', 'g'), '\s+', ' ', 'g') AS line FROM lines),
rep AS (SELECT document_id, line, count(DISTINCT page) AS n_pages FROM kl WHERE block_type IN ('text', 'equation') AND line <> '' AND length(line) <= 120 GROUP BY ALL HAVING count(DISTINCT page) >= 3)"""

_PIECE = r"""CASE WHEN """ + _blank("raw_text") + r""" IS NULL THEN '' ELSE '--- page=' || page || ' block_id=' || block_id || ' type=' || block_type || ' ---' || chr(10) || """ + _strip("raw_text") + r""" || chr(10) END"""

_IID = "'Instr:' || concat_ws('_', coalesce(opcode_value::VARCHAR, name), var)"
_EU = f"coalesce({_blank('execution_unit')}, 'UNKNOWN_UNIT')"
_NODES = f"""n AS (SELECT 'IP:sample' AS id, 'IP' AS type UNION SELECT 'EU:' || {_EU}, 'ExecutionUnit' FROM c UNION SELECT {_IID}, 'Instruction' FROM c
  UNION SELECT 'Field:' || upper(field_name), 'Field' FROM f WHERE field_name IS NOT NULL UNION SELECT 'DT:' || {_strip('type_id')}, 'DataType' FROM datatype_registry WHERE {_blank('type_id')} IS NOT NULL
  UNION SELECT 'Constraint:' || cid, 'Constraint' FROM k WHERE cid <> '')"""
_EDGES = f"""bn AS (SELECT document_id, name, arg_min({_IID}, pos) AS iid FROM c GROUP BY ALL),
bk AS (SELECT document_id, name, coalesce(var, '') AS v, arg_min({_IID}, pos) AS iid FROM c WHERE name <> '' GROUP BY ALL),
e AS (SELECT {_IID} AS "from", 'EXECUTES_ON' AS rel, 'EU:' || {_EU} AS "to" FROM c
  UNION SELECT 'IP:sample', 'HAS_INSTRUCTION', {_IID} FROM c
  UNION SELECT 'Constraint:' || cid, 'APPLIES_TO', 'Field:' || upper(en) FROM k WHERE et = 'Field' AND en IS NOT NULL AND cid <> ''
  UNION SELECT 'Constraint:' || cid, 'APPLIES_TO', 'IP:sample' FROM k WHERE et = 'Document' AND en IS NOT NULL AND cid <> ''
  UNION SELECT 'Constraint:' || cid, 'APPLIES_TO', iid FROM k JOIN bn ON bn.document_id = k.document_id AND bn.name = upper(k.en) WHERE et = 'Instruction' AND cid <> ''
  UNION SELECT iid, 'HAS_FIELD', 'Field:' || upper(field_name) FROM f JOIN bk ON bk.document_id = f.document_id AND bk.name = f.name AND bk.v = coalesce(f.var, '') WHERE field_name IS NOT NULL
  UNION SELECT 'Field:' || upper(field_name), 'HAS_DATATYPE', 'DT:' || dt FROM f WHERE field_name IS NOT NULL AND dt IS NOT NULL)"""
_GRAPH = f"WITH {_CAT}, {_TYPES}, {_CONS}, {_NODES}, {_EDGES}"

_PAGES = "list_distinct(list_filter(list_transform(coalesce(refs, []), lambda r: r.page), lambda p: p >= 1))"

_SCORES = """round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) WHEN tp + fn = 0 THEN 1.0 ELSE 0.0 END, 6) AS "precision",
  round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 1.0 END, 6) AS recall,
  round(CASE WHEN tp = 0 AND (tp + fn > 0 OR tp + fp > 0) THEN 0.0 WHEN tp + fp + fn = 0 THEN 1.0
    ELSE 2 * (tp / (tp + fp)) * (tp / (tp + fn)) / ((tp / (tp + fp)) + (tp / (tp + fn))) END, 6) AS f1"""


def _score(pred: str, truth: str, keys: str, extra: str = "") -> str:
    on = " AND ".join(f"p.{k} IS NOT DISTINCT FROM t.{k}" for k in keys.split(", "))
    return f"""pk AS (SELECT DISTINCT {keys}, 1 AS hit FROM ({pred})), tk AS (SELECT DISTINCT {keys}, 1 AS hit FROM ({truth})),
j AS (SELECT count(*) FILTER (p.hit = 1 AND t.hit = 1) AS tp, count(*) FILTER (t.hit IS NULL) AS fp, count(*) FILTER (p.hit IS NULL) AS fn FROM pk p FULL JOIN tk t ON {on})
SELECT {extra} tp, fp, fn, {_SCORES} FROM j"""


_COVER = f"""per AS (SELECT document_id, scope, count(*) AS n_rows, bool_or(coalesce(uncertain, false) OR coalesce(conf, 0) < 0.55) AS weak FROM m GROUP BY ALL),
cs AS (SELECT DISTINCT document_id, scope FROM c),
st AS (SELECT coalesce(cs.document_id, per.document_id) AS document_id, coalesce(cs.scope, per.scope) AS scope,
  CASE WHEN per.scope IS NULL THEN 'missing' WHEN cs.scope IS NULL THEN 'extra' WHEN weak THEN 'partial_or_uncertain' ELSE 'fully_confident' END AS status, coalesce(n_rows, 0) AS n_rows
  FROM cs FULL JOIN per ON cs.document_id = per.document_id AND cs.scope = per.scope)"""

_CANON = rf"regexp_replace({_strip('''coalesce(field_name, '')''')}, '\s+', '_', 'g')"

ORACLE = {
    "opcode_parse": f"SELECT DISTINCT opcode_raw, {_VALUE} AS value, CASE WHEN {_VALUE} IS NULL THEN 'unknown' WHEN {_OPC} ILIKE '0x%' THEN 'hex' ELSE 'dec' END AS radix FROM instruction_catalog",
    "scope_labels": f"WITH {_CAT} SELECT document_id, scope, count(*) AS n_rows FROM c GROUP BY ALL",
    "bit_width_types": f"WITH {_MAP}, {_TYPED} SELECT width, type_id, domain, count(*) AS n_rows FROM t GROUP BY ALL",
    "domain_expressions": f"WITH {_DOMX} SELECT trace_id, {_EXPR} AS expression, form FROM x",
    "domain_constraints": rf"""WITH {_DOMX}, y AS (SELECT *, regexp_extract(trace_id, '([0-9]+)$', 1)::BIGINT AS n,
      regexp_replace(regexp_replace(upper(coalesce(field_name, '')), '[^A-Z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS slug FROM x)
      SELECT 'C_' || CASE WHEN slug = '' THEN 'FIELD' ELSE slug END || '_' || CASE WHEN n < 1000 THEN lpad(n::VARCHAR, 4, '0') ELSE n::VARCHAR END AS constraint_id,
      form AS constraint_type_level1, {_EXPR} AS expression, coalesce({_strip('field_name')}, 'UNKNOWN') AS entity_name FROM y""",
    "constraint_counts": f"""WITH {_CONS} SELECT 'level1' AS level, coalesce(l1, '') AS label, count(*) AS n FROM k GROUP BY ALL
      UNION ALL SELECT 'level2', coalesce(l2, ''), count(*) FROM k GROUP BY ALL""",
    "canonical_intervals": rf"""WITH {_DOM}, v AS (SELECT regexp_extract(lower(av), {_IV}, 1) AS a, regexp_extract(lower(av), {_IV}, 2) AS b,
        regexp_extract(lower(av), '^([0-9]{{1,2}})\s*-?\s*bits?(?:\s+unsigned)?$', 1) AS bits FROM d), u AS (
      SELECT CASE WHEN a <> '' THEN least(a::BIGINT, b::BIGINT) || '..' || greatest(a::BIGINT, b::BIGINT) WHEN bits <> '' AND bits::INT BETWEEN 1 AND 62 THEN '0..' || ((1::BIGINT << bits::INT) - 1) END AS domain FROM v)
      SELECT domain, count(*) AS n_rows FROM u WHERE domain IS NOT NULL GROUP BY ALL""",
    "page_metrics": f"""WITH {_BLOCKS}, m AS (SELECT document_id, page, sum(CASE WHEN block_type IN ('text', 'equation') THEN length(raw_text) ELSE 0 END)::BIGINT AS char_count,
        count(*) FILTER (block_type IN ('text', 'equation')) AS text_blocks, count(*) FILTER (block_type = 'image') AS image_blocks, count(*) FILTER (block_type = 'table') AS table_blocks FROM b GROUP BY ALL)
      SELECT *, concat_ws(',', CASE WHEN char_count < 40 THEN 'low_text_char_count' END, CASE WHEN image_blocks > 0 AND char_count < 80 THEN 'image_heavy_low_text' END,
        CASE WHEN text_blocks = 0 AND (image_blocks > 0 OR table_blocks > 0) THEN 'no_text_layer_blocks' END, CASE WHEN char_count < 8 AND image_blocks >= 1 THEN 'scanned_or_bitmap_heavy' END) AS ocr_reasons,
        char_count < 40 OR (image_blocks > 0 AND char_count < 80) OR (text_blocks = 0 AND (image_blocks > 0 OR table_blocks > 0)) OR (char_count < 8 AND image_blocks >= 1) AS needs_ocr FROM m""",
    "header_footer_position": f"""WITH {_BLOCKS} SELECT document_id, block_id FROM b
      WHERE NOT coalesce(block_type IN ('text', 'equation') AND (y1 <= 792.0 * 0.1 OR y0 >= 792.0 * (1.0 - 0.15)), false)""",
    "repeated_lines": f"WITH {_BLOCKS}, {_KEYED_LINES} SELECT document_id, line, n_pages FROM rep",
    "header_footer_repeat": f"""WITH {_BLOCKS}, {_KEYED_LINES} SELECT kl.document_id, kl.page, md5(kl.raw) AS line, count(*) AS n_lines FROM kl LEFT JOIN rep ON rep.document_id = kl.document_id AND rep.line = kl.line
      WHERE rep.line IS NULL OR kl.block_type NOT IN ('text', 'equation') GROUP BY ALL""",
    "reading_order": f"WITH {_BLOCKS} SELECT document_id, block_id, row_number() OVER (PARTITION BY document_id ORDER BY page, y0, x0, trace_id) - 1 AS read_pos FROM b",
    "prompt_budget": f"""WITH {_BLOCKS}, p AS (SELECT *, {_PIECE} AS piece FROM b),
      q AS (SELECT *, sum(length(piece)) OVER (PARTITION BY document_id ORDER BY coalesce(page, 0), block_id, block_type, trace_id ROWS UNBOUNDED PRECEDING)::BIGINT AS used_chars FROM p)
      SELECT document_id, block_id, used_chars, md5(piece) AS piece FROM q WHERE piece <> '' AND used_chars <= 100000""",
    "total_pages": "SELECT document_id, max(page) AS total_pages FROM page_blocks GROUP BY ALL",
    "block_neighbours": f"""WITH {_BLOCKS}, n AS (SELECT document_id, block_id, lag(block_id) OVER w AS above, lead(block_id) OVER w AS below FROM b WINDOW w AS (PARTITION BY document_id, page ORDER BY y0, x0, trace_id))
      SELECT document_id, block_id, 'below' AS type, above AS target FROM n WHERE above IS NOT NULL UNION ALL SELECT document_id, block_id, 'above', below FROM n WHERE below IS NOT NULL""",
    "equation_blocks": rf"""WITH {_BLOCKS}, h AS (SELECT *, block_type = 'text' AND {_strip('raw_text')} <> '' AND length({_strip('raw_text')}) <= 200 AND regexp_matches({_strip('raw_text')}, '\\\(|\\\[|\$.*\$|[∑∫≤≥±]') AS hit FROM b)
      SELECT CASE WHEN hit THEN 'equation' ELSE block_type END AS block_type, CASE WHEN hit THEN coalesce({_blank('extraction_method')}, 'text_layer') || '+heuristic_equation' ELSE extraction_method END AS extraction_method, count(*) AS n_blocks FROM h GROUP BY ALL""",
    "page_confidence": f"""WITH {_BLOCKS}, q AS (SELECT *, coalesce(length(raw_text), 0) AS n, coalesce(sum(length(raw_text)) OVER (PARTITION BY document_id, page), 0)::DOUBLE AS pc FROM b)
      SELECT document_id, block_id, CASE WHEN block_type = 'table' THEN CASE WHEN n <= 0 THEN 0.55 ELSE ((15601 + 5 * least(n, 800)) // 2) / 10000::DOUBLE END WHEN block_type = 'image' THEN 0.25::DOUBLE
        ELSE ((432030 + 52 * least(pc::BIGINT, 1500) + 225 * least(n, 400)) // 60) / 10000::DOUBLE END AS confidence FROM q""",
    "page_coverage": f"""WITH {_BLOCKS}, {_CAT}, z AS (SELECT document_id, coalesce(conf, 0) AS conf, unnest({_PAGES}) AS page FROM c),
      a AS (SELECT document_id, page, count(*) AS n, max(conf) FILTER (NOT isnan(conf)) AS mx FROM z GROUP BY ALL),
      tp AS (SELECT document_id, coalesce(max(page) FILTER (extraction_method IS DISTINCT FROM 'supplemental_corpus'), max(page), 1) AS page FROM b GROUP BY ALL),
      l AS (SELECT document_id, greatest(max(page), 1) AS last FROM (SELECT document_id, page FROM tp UNION ALL SELECT document_id, page FROM z UNION ALL SELECT document_id, 1 FROM c) GROUP BY ALL),
      sp AS (SELECT document_id, unnest(range(1, last + 1))::INT AS page FROM l)
      SELECT document_id, sp.page, CASE WHEN n > 0 THEN 1 ELSE 0 END AS "binary", coalesce(n, 0) AS instruction_count, round(coalesce(mx, 0.0), 4) AS max_confidence FROM sp LEFT JOIN a USING (document_id, page)""",
    "band_candidates": f"""WITH {_BLOCKS}, {_CAT}, pg AS (SELECT DISTINCT document_id, page FROM b), z AS (SELECT document_id, pos, unnest({_PAGES}) AS ip FROM c),
      hit AS (SELECT DISTINCT pg.document_id, pg.page, z.pos FROM pg JOIN z ON z.document_id = pg.document_id AND z.ip BETWEEN pg.page - 1 AND pg.page + 1),
      fst AS (SELECT document_id, min(pos) AS pos FROM c GROUP BY ALL)
      SELECT pg.document_id, pg.page, coalesce(hit.pos, fst.pos) AS inst_pos, count(hit.pos) OVER (PARTITION BY pg.document_id, pg.page) AS n_candidates, hit.pos IS NULL AS fallback
      FROM pg JOIN fst ON fst.document_id = pg.document_id LEFT JOIN hit ON hit.document_id = pg.document_id AND hit.page = pg.page""",
    "scope_coverage": f"WITH {_MAP}, {_CAT}, {_COVER} SELECT document_id, scope, status, n_rows FROM st",
    "coverage_summary": f"""WITH {_MAP}, {_CAT}, {_COVER} SELECT document_id, count(*) FILTER (status <> 'extra') AS scopes_total, count(*) FILTER (status = 'fully_confident') AS scopes_fully_confident,
      count(*) FILTER (status = 'partial_or_uncertain') AS scopes_partial_or_uncertain, count(*) FILTER (status = 'missing') AS scopes_missing, count(*) FILTER (status = 'extra') AS scopes_extra FROM st GROUP BY ALL""",
    "global_fields": f"WITH {_MAP} SELECT {_CANON} AS field_name, count(DISTINCT document_id || chr(1) || scope) AS n_scopes FROM m WHERE {_CANON} <> '' GROUP BY 1",
    "scope_fields": f"WITH {_MAP} SELECT document_id, scope, array_to_string(list_sort(list(DISTINCT {_CANON})), ',') AS fields FROM m WHERE {_CANON} <> '' GROUP BY ALL",
    "override_join": f"""WITH {_MAP}, {_CAT}, cs AS (SELECT DISTINCT document_id, scope, name, var FROM c), over AS (
        SELECT document_id, scope, CASE WHEN regexp_matches(scope, '^[A-M]') AND scope IN (SELECT name FROM cs) THEN scope ELSE name END AS used FROM cs WHERE regexp_matches(name, '^[A-F]')),
      kept AS (SELECT m.* FROM m LEFT JOIN over ON over.document_id = m.document_id AND over.scope = m.scope WHERE over.scope IS NULL)
      SELECT document_id, NULL::VARCHAR AS sheet_key, scope, field_name, bit_range, conf AS confidence_score, count(*) AS n_rows FROM kept GROUP BY ALL UNION ALL SELECT document_id, used, scope, 'A', '7:0', 0.95::DOUBLE, count(*) FROM over GROUP BY ALL""",
    "registry_repair": f"""WITH {_TYPES}, r AS (SELECT DISTINCT type_id FROM datatype_registry)
      SELECT coalesce(type_id, (SELECT min(type_id) FROM r)) AS data_type_ref, type_id IS NULL AS repaired, count(*) AS n_rows FROM f LEFT JOIN r ON r.type_id = f.dt GROUP BY ALL""",
    "fold_dedup": f"""WITH {_CAT}, q AS (SELECT document_id, name, coalesce(var, '') AS variation, pos, greatest(0.0::DOUBLE, least(1.0::DOUBLE, coalesce(CASE WHEN isnan(conf) THEN NULL ELSE conf END, 0.6::DOUBLE))) AS conf FROM c),
      g AS (SELECT document_id, name, variation, list({{'pos': pos, 'conf': conf}} ORDER BY pos) AS xs FROM q GROUP BY ALL),
      w AS (SELECT *, list_reduce(xs, lambda a, x: CASE WHEN x.conf > a.conf + 0.01::DOUBLE THEN x ELSE a END) AS r FROM g) SELECT document_id, name, variation, r.pos AS pos, r.conf AS conf FROM w""",
    "first_and_last": f"""WITH {_CAT} SELECT document_id, name, min(pos) AS first_pos, arg_min({{'o': opcode_raw}}, pos).o AS first_opcode, max(pos) AS last_pos, arg_max({{'o': opcode_raw}}, pos).o AS last_opcode FROM c GROUP BY ALL""",
    "type_registry": rf"""WITH n AS (SELECT trace_id AS pos, regexp_replace(regexp_replace(upper({_strip('type_id')}), '[^A-Z0-9_]+', '_', 'g'), '^_+|_+$', '', 'g') AS tid, type_name_raw, category FROM datatype_registry),
      o AS (SELECT tid, arg_min({{'t': type_name_raw, 'c': category}}, pos) AS r FROM n WHERE tid <> '' GROUP BY ALL)
      SELECT 'run:reg:' || (row_number() OVER (ORDER BY tid) - 1) AS trace_id, tid AS type_id, coalesce({_blank('r.t')}, tid) AS type_name_raw,
      CASE WHEN lower(trim(r.c)) IN ('software_primitive', 'ip_architecture', 'alias', 'unknown') THEN lower(trim(r.c)) ELSE 'unknown' END AS category FROM o""",
    "inferred_types": f"WITH {_MAP}, {_TYPED} SELECT type_id, arg_min(domain, width) AS value_constraint_summary FROM t GROUP BY ALL",
    "interval_islands": f"""WITH {_BLOCKS}, r AS (SELECT *, max(y1) OVER w AS reach FROM b WINDOW w AS (PARTITION BY document_id, page ORDER BY y0, y1, x0 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
      s AS (SELECT *, sum(CASE WHEN reach IS NULL OR y0 > reach THEN 1 ELSE 0 END) OVER (PARTITION BY document_id, page ORDER BY y0, y1, x0 ROWS UNBOUNDED PRECEDING)::INT - 1 AS cluster FROM r)
      SELECT document_id, page, cluster, count(*) AS n_boxes, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1, count(*) > 1 AS merged FROM s GROUP BY document_id, page, cluster""",
    "stitch_links": f"""WITH {_BLOCKS}, pl AS (SELECT document_id, page, block_id, CASE WHEN (y1 >= 690 OR y0 <= 70) AND page % 5 > 0 THEN 'table' ELSE block_type END AS block_type, x0, CASE WHEN y0 <= 70 THEN 20.0::DOUBLE ELSE y0 END AS y0, x1, CASE WHEN y1 >= 690 THEN 772.0::DOUBLE ELSE y1 END AS y1 FROM b),
      ends AS (SELECT document_id, page, arg_max({{'id': block_id, 'x0': x0, 'x1': x1, 'y': y1}}, (y1, block_id)) AS lo, arg_min({{'id': block_id, 'x0': x0, 'x1': x1, 'y': y0}}, (y0, block_id)) AS hi FROM pl WHERE block_type = 'table' GROUP BY ALL),
      ext AS (SELECT document_id, page, min(y0) AS mn, max(y1) AS mx FROM pl GROUP BY ALL), pg AS (SELECT * FROM ends JOIN ext USING (document_id, page)),
      lk AS (SELECT p.document_id, p.page, p.lo.id AS upper, q.hi.id AS lower, q.hi.id = q.lo.id AS through FROM pg p JOIN pg q ON q.document_id = p.document_id AND q.page = p.page + 1
        WHERE p.lo.y >= 792.0 * 0.92 AND q.hi.y <= 792.0 * 0.08 AND (least(p.lo.x1, q.hi.x1) - greatest(p.lo.x0, q.hi.x0)) / least(p.lo.x1 - p.lo.x0, q.hi.x1 - q.hi.x0) >= 0.5 AND abs(p.lo.y - p.mx) <= 2 AND abs(q.hi.y - q.mn) <= 2),
      nw AS (SELECT *, CASE WHEN lag(page) OVER w = page - 1 AND lag(through) OVER w THEN 0 ELSE 1 END AS nw FROM lk WINDOW w AS (PARTITION BY document_id ORDER BY page)),
      ch AS (SELECT *, sum(nw) OVER (PARTITION BY document_id ORDER BY page) AS chain FROM nw)
      SELECT document_id, page, upper, lower, row_number() OVER (PARTITION BY document_id, chain ORDER BY page) % 2 = 1 AS take FROM ch""",
    "heading_rank": f"""WITH {_BLOCKS}, t AS (SELECT DISTINCT document_id, round_even(size * 2, 0) / 2 AS tier FROM (SELECT document_id, floor((x1 - x0) / 16) / 2 - 5 AS size FROM b WHERE raw_text IS NOT NULL) WHERE size > 0),
      r AS (SELECT *, dense_rank() OVER (PARTITION BY document_id ORDER BY tier DESC) AS k FROM t)
      SELECT document_id, tier, ['heading1', 'heading2', 'heading3', 'body', 'caption', 'comment'][least(k, 6)] AS role FROM r""",
    "eval_names": "WITH " + _score(f"SELECT {_blank('field_name')} AS k FROM instruction_field_map WHERE {_blank('field_name')} IS NOT NULL", f"SELECT {_blank('field_name')} AS k FROM field_domain_catalog WHERE {_blank('field_name')} IS NOT NULL", "k"),
    "eval_field_map": "WITH " + _score(
        f"SELECT document_id, {_NAME} AS name, coalesce({_VAR}, '') AS var, upper({_blank('field_name')}) AS field FROM instruction_field_map WHERE {_NAME} <> '' AND {_blank('field_name')} IS NOT NULL",
        f"SELECT document_id, {_NAME} AS name, coalesce({_VAR}, '') AS var, upper({_blank('field_name')}) AS field FROM field_datatype_catalog WHERE {_NAME} <> '' AND {_blank('field_name')} IS NOT NULL", "document_id, name, var, field"),
    "eval_instructions": f"""WITH {_CAT}, p AS (SELECT document_id, name, coalesce(var, '') AS v, arg_min({{'o': opcode_value}}, pos).o AS pv FROM c WHERE name <> '' GROUP BY ALL),
      mo AS (SELECT document_id, {_NAME} AS name, coalesce({_VAR}, '') AS v, trace_id AS pos, instruction_name AS raw_n, variation AS raw_v, CASE WHEN regexp_full_match({_strip('opcode_value')}, '0[xX]0*[0-9A-Fa-f]{{1,15}}') THEN lower({_strip('opcode_value')})::BIGINT WHEN regexp_full_match({_strip('opcode_value')}, '-?[0-9]+') THEN try_cast({_strip('opcode_value')} AS BIGINT) END AS ov FROM instruction_catalog_mirror),
      mp AS (SELECT document_id, name, v, pos, max(ov) AS ov FROM mo GROUP BY document_id, name, v, pos),
      t AS (SELECT document_id, name, v, arg_max({{'o': ov}}, pos).o AS tv FROM mp WHERE name <> '' GROUP BY ALL),
      j AS (SELECT count(*) FILTER (p.name IS NOT NULL AND t.name IS NOT NULL) AS tp, count(*) FILTER (t.name IS NULL) AS fp, count(*) FILTER (p.name IS NULL) AS fn,
        count(*) FILTER (p.name IS NOT NULL AND tv IS NOT NULL) AS opcode_defined, count(*) FILTER (pv = tv) AS opcode_matches FROM p FULL JOIN t ON p.document_id = t.document_id AND p.name = t.name AND p.v = t.v)
      SELECT tp, fp, fn, {_SCORES}, opcode_defined, opcode_matches, round(CASE WHEN opcode_defined > 0 THEN opcode_matches / opcode_defined END, 6) AS opcode_recall FROM j""",
    "ontology_nodes": _GRAPH + " SELECT id, type FROM n",
    "ontology_edges": _GRAPH + ' SELECT "from", rel, "to" FROM e',
    "dangling_edges": _GRAPH + ' SELECT e."from", rel, e."to", a.id IS NULL AS from_missing, z.id IS NULL AS to_missing FROM e LEFT JOIN n a ON a.id = e."from" LEFT JOIN n z ON z.id = e."to" WHERE a.id IS NULL OR z.id IS NULL',
    "node_degrees": _GRAPH + ', u AS (SELECT "from" AS id, 1 AS o, 0 AS i FROM e UNION ALL SELECT "to", 0, 1 FROM e) SELECT id, sum(o)::BIGINT AS out_degree, sum(i)::BIGINT AS in_degree FROM u GROUP BY ALL',
    "edge_sample": _GRAPH + ' SELECT "from", rel, "to", a.type AS from_type, z.type AS to_type FROM e JOIN n a ON a.id = e."from" JOIN n z ON z.id = e."to" ORDER BY 1, 2, 3 LIMIT 100',
    "unit_instructions": f"WITH {_CAT} SELECT document_id, upper({_EU}) AS unit, count(DISTINCT scope) AS n_scopes, count(*) FILTER (opc IS NOT NULL) AS n_opcodes FROM c GROUP BY ALL",
    "evidence_lookup": f"""WITH {_BLOCKS}, {_CONS}, z AS (SELECT cid AS constraint_id, document_id, unnest({_PAGES}) AS page FROM k), p AS (SELECT document_id, page, count(*) AS n_blocks, sum(length(raw_text))::BIGINT AS n_chars FROM b GROUP BY ALL)
      SELECT constraint_id, page, n_blocks, n_chars FROM z JOIN p USING (document_id, page)""",
    "vector_topk": """WITH q AS (SELECT embedding AS q FROM embeddings WHERE vec_id = 0) SELECT vec_id, round(list_dot_product(embedding::DOUBLE[], q::DOUBLE[]), 6) AS score FROM embeddings, q ORDER BY list_dot_product(embedding::DOUBLE[], q::DOUBLE[]) DESC, vec_id LIMIT 48""",
    "vector_topk_many": """WITH s AS (SELECT q.vec_id AS query_id, e.vec_id, row_number() OVER (PARTITION BY q.vec_id ORDER BY list_dot_product(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) DESC, e.vec_id) AS rank
      FROM embeddings e, embeddings q WHERE q.vec_id % 100 = 0) SELECT query_id, vec_id, rank FROM s WHERE rank <= 10""",
    "index_rows": f"""WITH {_BLOCKS}, r AS (SELECT * FROM b WHERE {_blank('raw_text')} IS NOT NULL), w AS (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY coalesce(page, 0), block_id, block_type, trace_id) - 1 AS vec_no,
        row_number() OVER (PARTITION BY document_id, page ORDER BY block_id, block_type, trace_id) - 1 AS index_on_page, count(*) OVER (PARTITION BY document_id, page) AS blocks_on_page FROM r)
      SELECT document_id, block_id, vec_no, index_on_page, blocks_on_page, md5('[page=' || page || ' block_id=' || block_id || ' type=' || block_type || ' index_on_page=' || index_on_page || ']' || chr(10) || substring({_strip('raw_text')}, 1, 12000)) AS text, md5(substring({_strip('raw_text')}, 1, 500)) AS preview FROM w""",
    "corpus_chunks": f"""SELECT doc_id::VARCHAR AS document_id, i::INT AS chunk_no, md5(substring(text, i * 6000 + 1, 6000)) AS text FROM (SELECT doc_id, text, unnest(range(0, ceil(length(text) / 6000.0)::BIGINT)) AS i FROM documents WHERE {_blank('text')} IS NOT NULL)""",
    "glossary_terms": f"""WITH {_MAP}, t AS (SELECT lower({_strip('field_name')}) AS term_key, {_strip('field_name')} AS name, nullif({_strip('bit_range')}, '') AS d FROM m WHERE {_blank('field_name')} IS NOT NULL),
      s AS (SELECT term_key, name, count(*) AS n, min(length(d)) AS ld FROM t GROUP BY ALL) SELECT term_key, arg_max(name, (n, name)) AS name, sum(n)::BIGINT AS frequency, min(ld) AS n_definition FROM s GROUP BY ALL""",
    "size_routes": """WITH s AS (SELECT document_id, ceil(coalesce(sum(length(text)), 0) / 3.0)::BIGINT AS est_tokens FROM documents GROUP BY ALL)
      SELECT document_id, est_tokens, CASE WHEN est_tokens < 30000 THEN 'single' WHEN est_tokens <= 100000 THEN 'chunked' ELSE 'tree' END AS route FROM s""",
}
