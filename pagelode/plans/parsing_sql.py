"""SQL twins of field parsing, the field map, the chain and the exports, for DuckDB over the same tables."""

from __future__ import annotations

from pagelode.plans.reference_sql import _BLOCKS, _CAT, _DOMX, _EU, _IV, _PAGES, _SCOPE, _TYPED, _blank, _score, _strip

_BITS = r"([0-9]{1,2})\s*:\s*([0-9]{1,2})"
_LOOSE = r"\b([A-Za-z_][A-Za-z0-9_]*)\s+([0-9]{1,2}\s*:\s*[0-9]{1,2}|[0-9]{1,2})\b"


def _cells(line: str) -> str:
    s = _strip(line)
    return rf"CASE WHEN contains({s}, chr(9)) THEN list_transform(string_split({s}, chr(9)), lambda x: {_strip('x')}) ELSE list_filter(list_transform(string_split_regex({s}, '\s{{2,}}'), lambda x: {_strip('x')}), lambda x: x <> '') END"


def _find(pattern: str, extra: str = "false") -> str:
    return f"coalesce(list_position(list_transform(head, lambda x: regexp_matches(lower(x), '{pattern}') OR {extra}), true), 0)"


_PARSED = rf"""nb AS (SELECT b.*, source_refs, row_number() OVER (PARTITION BY b.document_id ORDER BY coalesce(b.page, 0), b.block_id, b.trace_id) - 1 AS block_idx FROM b JOIN (SELECT trace_id, any_value(source_refs) AS source_refs FROM page_blocks GROUP BY trace_id) USING (trace_id)),
tx AS (SELECT *, string_split_regex(raw_text, '\r\n|[\n\r]') AS lines FROM nb WHERE {_blank('raw_text')} IS NOT NULL),
t0 AS (SELECT *, list_filter(lines, lambda x: {_strip('x')} <> '') AS ls FROM tx WHERE block_type = 'table'),
t1 AS (SELECT *, {_cells('ls[1]')} AS head FROM t0),
t2 AS (SELECT *, {_find('field|name|signal')} AS f, {_find(r'bits|\bbit\b|msb|lsb|\[')} AS bt, {_find('word', "lower(x) = 'w'")} AS w FROM t1),
t3 AS (SELECT *, ls[i] AS line, i - 1 AS line_no FROM (SELECT *, unnest(range(1, len(ls) + 1)) AS i FROM t2)),
t4 AS (SELECT *, {_cells('line')} AS cells, f > 0 AND bt > 0 AS mapped FROM t3 WHERE line_no > 0 OR (f = 0 AND bt = 0)),
t5 AS (SELECT *, coalesce(CASE WHEN mapped THEN cells[f] ELSE cells[1] END, '') AS field_name, CASE WHEN mapped THEN coalesce(cells[bt], '') ELSE array_to_string(cells[2:], ' ') END AS bits_text FROM t4),
t6 AS (SELECT *, CASE WHEN regexp_matches(bits_text, '{_BITS}') THEN regexp_extract(bits_text, '{_BITS}', 1) || ':' || regexp_extract(bits_text, '{_BITS}', 2) ELSE regexp_extract(bits_text, '\b([0-9]{{1,2}})\b', 1) END AS bit_range FROM t5 WHERE regexp_full_match(field_name, '[A-Za-z_][A-Za-z0-9_]*')),
x1 AS (SELECT *, lines[i] AS line, i - 1 AS line_no FROM (SELECT *, unnest(range(1, len(lines) + 1)) AS i FROM tx WHERE block_type IN ('text', 'equation', 'image'))),
x2 AS (SELECT *, regexp_extract(line, '{_LOOSE}', 1) AS field_name, regexp_replace(regexp_extract(line, '{_LOOSE}', 2), '\s', '', 'g') AS bit_range FROM x1 WHERE regexp_matches(line, '{_LOOSE}')),
pf0 AS (SELECT document_id, page, block_id, block_type, block_idx, source_refs, line_no, field_name, bit_range, CASE WHEN mapped AND w > 0 THEN coalesce(try_cast(regexp_extract(coalesce(cells[w], ''), '([0-9]{{1,9}})', 1) AS INT), 0) ELSE 0 END AS word_index,
    CASE WHEN mapped THEN 0.78::DOUBLE WHEN contains(bit_range, ':') THEN 0.62::DOUBLE ELSE 0.48::DOUBLE END AS rc FROM t6 WHERE bit_range <> ''
  UNION ALL SELECT document_id, page, block_id, block_type, block_idx, source_refs, line_no, field_name, bit_range, 0, CASE WHEN contains(bit_range, ':') THEN 0.42::DOUBLE ELSE 0.38::DOUBLE END * 0.85::DOUBLE FROM x2),
pf AS (SELECT *, row_number() OVER (PARTITION BY document_id, page, block_id, block_idx ORDER BY line_no) - 1 AS field_idx FROM pf0)"""

_MAPPED = f"""pg AS (SELECT DISTINCT document_id, page FROM b), z AS (SELECT document_id, pos, unnest({_PAGES}) AS ip FROM c),
hit AS (SELECT DISTINCT pg.document_id, pg.page, z.pos FROM pg JOIN z ON z.document_id = pg.document_id AND z.ip BETWEEN pg.page - 1 AND pg.page + 1),
fst AS (SELECT document_id, min(pos) AS pos FROM c GROUP BY ALL),
cand AS (SELECT pg.document_id, pg.page, coalesce(hit.pos, fst.pos) AS inst_pos, count(hit.pos) OVER (PARTITION BY pg.document_id, pg.page) > 1 OR hit.pos IS NULL AS multi
  FROM pg JOIN fst ON fst.document_id = pg.document_id LEFT JOIN hit ON hit.document_id = pg.document_id AND hit.page = pg.page),
m0 AS (SELECT pf.*, cand.inst_pos, multi, multi OR block_type <> 'table' AS unsure, c.name, c.var, c.scope FROM pf JOIN cand ON cand.document_id = pf.document_id AND cand.page = pf.page JOIN c ON c.pos = cand.inst_pos),
m1 AS (SELECT *, least(0.95::DOUBLE, greatest(0.25::DOUBLE, (CASE WHEN unsure THEN 0.55::DOUBLE ELSE rc END) * CASE WHEN multi THEN 0.9::DOUBLE ELSE 1.0::DOUBLE END)) AS cf FROM m0)"""

_IID = "'Instr:' || concat_ws('_', coalesce(opcode_value::VARCHAR, name), var)"
_CHAIN = f"""WITH {_BLOCKS}, {_CAT}, k0 AS (SELECT b.* REPLACE (CASE WHEN hit THEN 'equation' ELSE block_type END AS block_type) FROM (SELECT *, block_type = 'text' AND {_strip('raw_text')} <> '' AND length({_strip('raw_text')}) <= 200
    AND regexp_matches({_strip('raw_text')}, '\\\\\\(|\\\\\\[|\\$.*\\$|[∑∫≤≥±]') AS hit FROM b) b), b2 AS (SELECT * FROM k0 WHERE NOT (block_type = 'text' AND EXISTS (SELECT 1 FROM k0 t WHERE t.document_id = k0.document_id AND t.page = k0.page AND t.block_type = 'table'
    AND (k0.x0 + k0.x1) / 2 BETWEEN t.x0 AND t.x1 AND (k0.y0 + k0.y1) / 2 BETWEEN t.y0 AND t.y1
    AND greatest(0, least(k0.x1, t.x1) - greatest(k0.x0, t.x0)) * greatest(0, least(k0.y1, t.y1) - greatest(k0.y0, t.y0)) > 0.35 * (k0.x1 - k0.x0) * (k0.y1 - k0.y0)))),
{_PARSED.replace("FROM b JOIN (SELECT trace_id", "FROM b2 AS b JOIN (SELECT trace_id")}, {_MAPPED.replace("FROM b)", "FROM b2)")},
m AS (SELECT document_id, name, var, field_name, bit_range FROM m1), {_TYPED},
bk AS (SELECT document_id, name, coalesce(var, '') AS v, arg_min({_IID}, pos) AS iid FROM c WHERE name <> '' GROUP BY ALL)"""

_RAW = _strip("coalesce(raw_text, '')")

ORACLE = {
    "parsed_fields": f"WITH {_BLOCKS}, {_PARSED} SELECT document_id, block_id, field_idx, field_name, bit_range, word_index, round(rc, 4) AS row_confidence FROM pf",
    "field_map": f"""WITH {_BLOCKS}, {_CAT}, {_PARSED}, {_MAPPED} SELECT 'run:field:' || block_idx || ':' || field_idx || ':' || scope AS trace_id, 'field_parsing' AS stage_name, document_id, block_id, inst_pos, name AS instruction_name, var AS variation,
      field_name, bit_range, word_index, round(cf, 4) AS confidence_score, unsure OR cf < 0.55 AS uncertain, CASE WHEN len(source_refs) > 0 THEN source_refs[1].page ELSE page END AS ref_page FROM m1""",
    "pipeline_nodes": f"""{_CHAIN} SELECT 'IP' AS type, 1::BIGINT AS n UNION ALL SELECT 'ExecutionUnit', count(DISTINCT {_EU}) FROM c UNION ALL SELECT 'Instruction', count(DISTINCT {_IID}) FROM c
      UNION ALL SELECT 'Field', count(DISTINCT upper(field_name)) FROM t UNION ALL SELECT 'DataType', count(DISTINCT type_id) FROM t UNION ALL SELECT 'Constraint', count(*) FROM t UNION ALL SELECT 'APPLIES_TO', count(*) FROM t
      UNION ALL SELECT 'EXECUTES_ON', count(DISTINCT ({_IID}, {_EU})) FROM c UNION ALL SELECT 'HAS_INSTRUCTION', count(DISTINCT {_IID}) FROM c UNION ALL SELECT 'HAS_DATATYPE', count(DISTINCT (upper(field_name), type_id)) FROM t
      UNION ALL SELECT 'HAS_FIELD', count(DISTINCT (iid, upper(field_name))) FROM t JOIN bk ON bk.document_id = t.document_id AND bk.name = t.name AND bk.v = coalesce(t.var, '')""",
    "eval_sections": "SELECT * FROM (WITH " + _score(f"SELECT upper({_strip('data_type_ref')}) AS k FROM field_datatype_catalog WHERE {_blank('data_type_ref')} IS NOT NULL", f"SELECT upper({_strip('type_id')}) AS k FROM datatype_registry WHERE {_blank('type_id')} IS NOT NULL", "k", "'types' AS section,")
    + ") UNION ALL SELECT * FROM (WITH " + _score(f"SELECT upper({_strip('field_name')}) AS k FROM field_datatype_catalog WHERE {_blank('field_name')} IS NOT NULL", f"SELECT upper({_strip('field_name')}) AS k FROM instruction_field_map WHERE {_blank('field_name')} IS NOT NULL", "k", "'fields' AS section,") + ")",
    "contract_violations": f"""WITH c AS (SELECT DISTINCT ON (trace_id) * FROM instruction_catalog), m AS (SELECT DISTINCT ON (trace_id) * FROM instruction_field_map), v AS (
      SELECT 'instruction_catalog' AS table_name, unnest([{', '.join(f"CASE WHEN {_blank(x)} IS NULL THEN {{'rule': 'required', 'column_name': '{x}'}} END" for x in ('trace_id', 'instruction_name', 'opcode_raw', 'execution_unit'))},
        CASE WHEN opcode_radix NOT IN ('hex', 'dec', 'unknown') THEN {{'rule': 'choice', 'column_name': 'opcode_radix'}} END, CASE WHEN instruction_kind NOT IN ('macro', 'micro', 'unknown') THEN {{'rule': 'choice', 'column_name': 'instruction_kind'}} END,
        {', '.join(f"CASE WHEN isnan({x}) OR {x} < 0 OR {x} > 1 THEN {{'rule': 'bounds', 'column_name': '{x}'}} END" for x in ('confidence_score', 'instruction_kind_confidence'))}]) AS r FROM c
      UNION ALL SELECT 'instruction_field_map', unnest([{', '.join(f"CASE WHEN {_blank(x)} IS NULL THEN {{'rule': 'required', 'column_name': '{x}'}} END" for x in ('trace_id', 'instruction_name', 'field_name', 'bit_range'))},
        CASE WHEN isnan(confidence_score) OR confidence_score < 0 OR confidence_score > 1 THEN {{'rule': 'bounds', 'column_name': 'confidence_score'}} END, CASE WHEN word_index < 0 THEN {{'rule': 'bounds', 'column_name': 'word_index'}} END]) AS r FROM m)
      SELECT table_name, r.rule AS rule, r.column_name AS column_name, count(*) AS n_rows FROM v WHERE r IS NOT NULL GROUP BY ALL""",
    "combinations": rf"""WITH {_DOMX}, s AS (SELECT DISTINCT trace_id, {_SCOPE} AS scope FROM field_domain_catalog),
      y AS (SELECT x.document_id, scope, x.field_name, form, av, items, regexp_extract(lower(av), {_IV}, 1) AS a, regexp_extract(lower(av), {_IV}, 2) AS b, try_cast(regexp_extract(lower(av), '^([0-9]{{1,2}})\s*-?\s*bits?(?:\s+unsigned)?$', 1) AS INT) AS bits FROM x JOIN s USING (trace_id)),
      z AS (SELECT *, CASE WHEN a <> '' THEN least(a::BIGINT, b::BIGINT) WHEN bits BETWEEN 1 AND 62 THEN 0 END AS lo, CASE WHEN a <> '' THEN greatest(a::BIGINT, b::BIGINT) WHEN bits BETWEEN 1 AND 62 THEN (1::BIGINT << bits) - 1 END AS hi FROM y),
      v AS (SELECT document_id, scope, field_name, unnest(CASE WHEN lo IS NOT NULL THEN [lo::VARCHAR, least(lo + 1, hi)::VARCHAR, greatest(hi - 1, lo)::VARCHAR, hi::VARCHAR] WHEN form = 'enum' AND av <> '' THEN CASE WHEN len(items) > 0 THEN items ELSE [av] END END) AS val FROM z),
      per AS (SELECT document_id, scope, field_name, list_sort(list(DISTINCT val)) AS vals FROM v GROUP BY ALL),
      sc AS (SELECT document_id, scope, list({{'f': field_name, 'v': vals}} ORDER BY field_name) AS fs, greatest(2, max(len(vals))) AS mx, list(len(vals)::BIGINT ORDER BY field_name) AS sz FROM per GROUP BY ALL),
      sq AS (SELECT *, list_filter(range(mx, 2 * mx + 1), lambda n: len(list_filter(range(2, n), lambda m: n % m = 0)) = 0)[1] AS q FROM sc),
      sr AS (SELECT *, list_filter(range(1, 32), lambda t: pow(q, t) >= len(fs))[1] * q * q AS nr, list_aggregate(sz, 'product') AS total FROM sq),
      cw AS (SELECT document_id, scope, fs, sz, unnest(range(0, total::BIGINT)) AS combo FROM sr WHERE total <= greatest(1000, nr)),
      whole AS (SELECT document_id, scope, combo, list_transform(range(1, len(fs) + 1), lambda i: {{'f': fs[i].f, 'v': fs[i].v[(combo // (CASE WHEN i = 1 THEN 1 ELSE list_aggregate(sz[1:i - 1], 'product') END)::BIGINT) % sz[i] + 1]}}) AS a FROM cw),
      cc AS (SELECT document_id, scope, fs, sz, q, unnest(range(0, nr::BIGINT)) AS combo FROM sr WHERE total > greatest(1000, nr)),
      cp AS (SELECT *, pow(q, combo // (q * q))::BIGINT AS p, combo // q % q AS ra, combo % q AS rb FROM cc),
      cv AS (SELECT document_id, scope, min(combo) AS combo, a FROM (SELECT document_id, scope, combo, list_transform(range(1, len(fs) + 1), lambda i: {{'f': fs[i].f, 'v': fs[i].v[(ra + rb * ((i - 1) // p % q)) % q % sz[i] + 1]}}) AS a FROM cp) GROUP BY document_id, scope, a),
      al AS (SELECT document_id, scope, combo, a FROM whole UNION ALL SELECT document_id, scope, combo, a FROM cv)
      SELECT document_id, scope, combo, '{{' || array_to_string(list_transform(a, lambda x: to_json(x.f) || ':' || to_json(x.v)), ',') || '}}' AS assignment FROM al""",
    "markdown_export": rf"""WITH {_BLOCKS}, o AS (SELECT *, {_RAW} AS raw, row_number() OVER w - 1 AS read_pos, coalesce(lag(page) OVER w <> page, true) AS new FROM b WINDOW w AS (PARTITION BY document_id ORDER BY page, y0, x0, trace_id)),
      r AS (SELECT *, list_transform(list_filter(string_split_regex(raw, '\r\n|[\n\r]'), lambda x: {_strip('x')} <> ''), lambda x: list_transform(string_split(x, chr(9)), lambda y: {_strip('y')})) AS rows FROM o),
      f AS (SELECT *, list_max(list_transform(rows, lambda x: len(x))) AS width FROM r), g AS (SELECT *, list_transform(rows, lambda x: '|' || array_to_string(list_resize(x, width, ''), '|') || '|') AS ful FROM f)
      SELECT document_id, page, read_pos, CASE WHEN new THEN CASE WHEN read_pos = 0 THEN '' ELSE chr(10) END || '<!-- page ' || page || ' -->' || chr(10) || chr(10) ELSE '' END ||
        CASE WHEN block_type = 'image' THEN '```' || chr(10) || '[IMAGE BLOCK]' || CASE WHEN raw <> '' THEN chr(10) || raw ELSE '' END || chr(10) || '```' || chr(10)
          WHEN block_type = 'table' THEN CASE WHEN len(rows) > 0 THEN ful[1] || chr(10) || array_to_string(list_concat(['|' || array_to_string(list_resize(['---'], width, '---'), '|') || '|'], ful[2:]), chr(10)) || chr(10) || chr(10) ELSE '' END
          WHEN block_type = 'equation' THEN '```' || chr(10) || raw || chr(10) || '```' || chr(10) WHEN raw = '' THEN '' ELSE raw || chr(10) END AS markdown FROM g""",
}
