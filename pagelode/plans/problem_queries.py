"""Queries of the general problems (p2, p3, p5) over the pipeline's tables, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelode.functions.text import blank_to_null, fold
from pagelode.operators.orphans import Reference, orphan_references, orphan_report, parent_rows, reference_rows
from pagelode.operators.packed_values import explode_packed
from pagelode.operators.table_diff import number_text, table_diff
from pagelode.session import table


def _p2(spark: SparkSession, base: str) -> DataFrame:
    types = table(spark, base, "datatype_registry")
    insts = table(spark, base, "instruction_catalog")
    fields = table(spark, base, "instruction_field_map")
    dtypes = table(spark, base, "field_datatype_catalog")
    cons = table(spark, base, "constraint_registry")
    c = F.col
    entity = fold("applies_to.entity_type")
    refs = reference_rows(
        [
            Reference(dtypes, "field_datatype_catalog", "data_type_ref", c("trace_id"), F.lit("type"), F.lit(""), c("data_type_ref"), c("loaded_at")),
            Reference(dtypes, "field_datatype_catalog", "instruction_name", c("trace_id"), F.lit("instruction"), c("document_id"), c("instruction_name"), c("loaded_at")),
            Reference(
                cons, "constraint_registry", "entity_name", c("trace_id"),
                F.when(entity == "field", "field").when(entity == "instruction", "instruction"),
                c("document_id"), c("applies_to.entity_name"), c("loaded_at"),
            ),
        ]
    )
    parents = (
        parent_rows("type", types, F.lit(""), c("type_id"), c("loaded_at"), c("deleted_at"))
        .unionByName(parent_rows("instruction", insts, c("document_id"), c("instruction_name"), c("loaded_at"), None))
        .unionByName(parent_rows("field", fields, c("document_id"), c("field_name"), None, None))
    )
    return orphan_references(refs, parents)


def p2_found(spark: SparkSession, base: str) -> DataFrame:
    return _p2(spark, base).select("table_name", "ref_field", "trace_id", "kind")


def p2_report(spark: SparkSession, base: str) -> DataFrame:
    return orphan_report(_p2(spark, base))


def p3_values(spark: SparkSession, base: str) -> DataFrame:
    """All values of all cells, cells of one value too."""
    cells = table(spark, base, "field_domain_catalog").select("trace_id", "allowed_value_form", "allowed_values_or_range")
    cells = cells.filter(blank_to_null("allowed_values_or_range").isNotNull()).dropDuplicates(["trace_id"])
    return explode_packed(cells, "allowed_values_or_range", "allowed_value_form", ["trace_id"])


def p3_found(spark: SparkSession, base: str) -> DataFrame:
    return p3_values(spark, base).filter("n_vals >= 2").select("trace_id", "pos", "val")


def p5_found(spark: SparkSession, base: str) -> DataFrame:
    left = table(spark, base, "instruction_catalog").select("trace_id", "instruction_name", "opcode_value", "execution_unit")
    right = table(spark, base, "instruction_catalog_mirror").select(
        "trace_id", "instruction_name", "opcode_value", "execution_unit", "synced_at"
    )
    return table_diff(
        left,
        right,
        "trace_id",
        {
            "instruction_name": (fold("instruction_name"), fold("instruction_name")),
            "opcode_value": (F.col("opcode_value").cast("string"), number_text(F.col("opcode_value"))),
            "execution_unit": (fold("execution_unit"), fold("execution_unit")),
        },
        "catalog",
        "mirror",
        latest=F.col("synced_at"),
    )


QUERIES = {
    "p2_found": p2_found,
    "p2_report": p2_report,
    "p3_found": p3_found,
    "p3_values": p3_values,
    "p5_found": p5_found,
}

_FOLD = r"nullif(lower(regexp_replace({0}, '^\s+|\s+$', '', 'g')), '')"


def _f(c: str) -> str:
    return _FOLD.format(c)


_P2_BASE = f"""
WITH refs AS (
  SELECT 'field_datatype_catalog' AS table_name, 'data_type_ref' AS ref_field, trace_id, 'type' AS target, '' AS scope,
         {_f('data_type_ref')} AS key, loaded_at AS ts FROM field_datatype_catalog
  UNION ALL
  SELECT 'field_datatype_catalog', 'instruction_name', trace_id, 'instruction', document_id, {_f('instruction_name')}, loaded_at FROM field_datatype_catalog
  UNION ALL
  SELECT 'constraint_registry', 'entity_name', trace_id, lower(trim(applies_to.entity_type)), document_id, {_f('applies_to.entity_name')}, loaded_at
  FROM constraint_registry WHERE lower(trim(applies_to.entity_type)) IN ('field', 'instruction')
), parents AS (
  SELECT 'type' AS target, '' AS scope, {_f('type_id')} AS key, loaded_at AS s, deleted_at AS e FROM datatype_registry
  UNION ALL SELECT DISTINCT 'instruction', document_id, {_f('instruction_name')}, loaded_at, NULL::timestamp FROM instruction_catalog
  UNION ALL SELECT DISTINCT 'field', document_id, {_f('field_name')}, timestamp '0001-01-01', NULL::timestamp FROM instruction_field_map
), judged AS (
  SELECT DISTINCT r.table_name, r.ref_field, r.trace_id, r.ts,
    count(p.key) OVER w AS n,
    coalesce(bool_or(p.s <= r.ts) OVER w, false) AS begun,
    coalesce(bool_or(p.s <= r.ts AND (p.e IS NULL OR p.e > r.ts)) OVER w, false) AS held
  FROM refs r LEFT JOIN parents p ON p.target = r.target AND p.scope = r.scope AND p.key = r.key
  WHERE r.key IS NOT NULL
  WINDOW w AS (PARTITION BY r.table_name, r.ref_field, r.trace_id)
), broken AS (
  SELECT table_name, ref_field, trace_id, ts,
    CASE WHEN n = 0 THEN 'missing' WHEN held THEN NULL WHEN NOT begun THEN 'late' ELSE 'deleted' END AS kind
  FROM judged
)"""

#: An item of a list: quoted runs, bracketed runs and anything but separators.
_ITEM = r"""(?:"(?:[^"]|"")*"|“[^”]*”|''(?:[^'']|'''')*''|„[^”]*”|‘[^’]*’|«[^»]*»|\[[^\]]*\]|\([^)]*\)|\{[^}]*\}|[^,;|/\n\r\t、；，｜])+"""
_P3_BASE = rf"""
WITH d AS (SELECT DISTINCT trace_id, lower(trim(coalesce(allowed_value_form, ''))) AS form, regexp_replace(allowed_values_or_range, '^\s+|\s+$', '', 'g') AS s FROM field_domain_catalog),
u AS (SELECT trace_id, form, regexp_replace(s, '^[\p{{L}}_]\w*(?:\s+\w+)*\s*[:=]?\s*([\[({{].*[\])}}])$', '\1', 's') AS s FROM d WHERE s <> '' AND form <> 'other'),
w AS (SELECT trace_id, form, CASE WHEN regexp_full_match(s, '[\[({{](?s:.*)[\])}}]') AND NOT (form = 'range' AND regexp_full_match(s, '[\[(]\s*[-+]?\w+\s*[,;]\s*[-+]?\w+\s*[\])]'))
    AND NOT regexp_matches(regexp_replace(substring(s, 2, length(s) - 2), '"(?:[^"]|"")*"|“[^”]*”', '', 'g'), '[\[\](){{}}]') THEN substring(s, 2, length(s) - 2) ELSE s END AS s FROM u),
l AS (SELECT trace_id, list_filter(list_transform(CASE WHEN form = 'range' AND regexp_full_match(s, '[\[(][^\[\]()]*[\])]') THEN [s] ELSE regexp_extract_all(s, '{_ITEM}') END, lambda x: trim(x, ' ' || chr(9) || chr(10) || chr(13))), lambda x: x <> '') AS items FROM w),
q AS (SELECT trace_id, list_transform(items, lambda x: CASE WHEN regexp_full_match(x, '"(?:[^"]|"")*"') THEN replace(substring(x, 2, length(x) - 2), '""', '"')
    WHEN regexp_full_match(x, '“[^”]*”|‘[^’]*’|„[^”]*”|«[^»]*»') THEN substring(x, 2, length(x) - 2)
    WHEN regexp_full_match(x, '''(?:[^'']|'''')*''') THEN replace(substring(x, 2, length(x) - 2), '''''', '''') ELSE x END) AS items FROM l),
v AS (SELECT trace_id, i AS pos, items[i] AS val, len(items) AS n_vals FROM (SELECT trace_id, items, unnest(range(1, len(items) + 1)) AS i FROM q))"""

ORACLE = {
    "p2_found": _P2_BASE + " SELECT table_name, ref_field, trace_id, kind FROM broken WHERE kind IS NOT NULL",
    "p2_report": _P2_BASE
    + " SELECT table_name, ref_field, strftime(ts, '%Y-%m') AS month, kind, count(*) AS n_refs FROM broken WHERE kind IS NOT NULL GROUP BY ALL",
    "p3_found": _P3_BASE + " SELECT trace_id, pos, val FROM v WHERE n_vals >= 2",
    "p3_values": _P3_BASE + " SELECT trace_id, pos, val, n_vals FROM v",
    "p5_found": rf"""
WITH cat AS (
  SELECT DISTINCT trace_id, {_f('instruction_name')} AS nm, opcode_value::DOUBLE AS op, {_f('execution_unit')} AS un FROM instruction_catalog
), mir0 AS (
  SELECT *, row_number() OVER (PARTITION BY trace_id ORDER BY synced_at DESC) AS rn FROM instruction_catalog_mirror
), mir AS (
  SELECT trace_id, {_f('instruction_name')} AS nm, {_f('execution_unit')} AS un,
    CASE WHEN {_f('opcode_value')} LIKE '0x%' THEN {_f('opcode_value')}::BIGINT::DOUBLE ELSE {_f('opcode_value')}::DOUBLE END AS op
  FROM mir0 WHERE rn = 1
), j AS (
  SELECT coalesce(c.trace_id, m.trace_id) AS trace_id, c.trace_id AS ct, m.trace_id AS mt,
    c.nm AS cn, m.nm AS mn, c.op AS co, m.op AS mo, c.un AS cu, m.un AS mu
  FROM cat c FULL JOIN mir m ON c.trace_id = m.trace_id
)
SELECT trace_id, 'missing_in_mirror' AS diff FROM j WHERE mt IS NULL
UNION ALL SELECT trace_id, 'missing_in_catalog' FROM j WHERE ct IS NULL
UNION ALL SELECT trace_id, 'instruction_name' FROM j WHERE ct IS NOT NULL AND mt IS NOT NULL AND cn IS DISTINCT FROM mn
UNION ALL SELECT trace_id, 'opcode_value' FROM j WHERE ct IS NOT NULL AND mt IS NOT NULL AND co IS DISTINCT FROM mo
UNION ALL SELECT trace_id, 'execution_unit' FROM j WHERE ct IS NOT NULL AND mt IS NOT NULL AND cu IS DISTINCT FROM mu""",
}
