"""Queries of the relational core over the pipeline's tables. All read whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelode.functions import geometry as G
from pagelode.functions import scalars as S
from pagelode.functions.text import blank_to_null, strip
from pagelode.operators import blocks as B
from pagelode.operators import catalog as C
from pagelode.operators import constraints as K
from pagelode.operators import evaluate as E
from pagelode.operators import fields as D
from pagelode.operators import glossary as X
from pagelode.operators import graph as R
from pagelode.operators import layout as L
from pagelode.operators import retrieval as V
from pagelode.operators.contracts import violations
from pagelode.plans import parsing_sql, reference_sql
from pagelode.session import table

ORACLE = {**reference_sql.ORACLE, **parsing_sql.ORACLE}

#: Page height of the test manuals, in points.
HEIGHT = 792.0


def page_blocks(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "page_blocks").dropDuplicates(["document_id", "block_id"])


def catalog(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "instruction_catalog").dropDuplicates(["trace_id"]).withColumn("pos", F.col("trace_id"))


def field_rows(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "instruction_field_map").dropDuplicates(["trace_id"]).withColumn("pos", F.col("trace_id"))


def once(s: SparkSession, d: str, name: str) -> DataFrame:
    return table(s, d, name).dropDuplicates(["trace_id"]).withColumn("pos", F.col("trace_id"))


def opcode_parse(s: SparkSession, d: str) -> DataFrame:
    c = table(s, d, "instruction_catalog").select("opcode_raw").distinct()
    return c.select("opcode_raw", S.opcode_value("opcode_raw").alias("value"), S.opcode_radix("opcode_raw").alias("radix"))


def scope_labels(s: SparkSession, d: str) -> DataFrame:
    return catalog(s, d).groupBy("document_id", S.scope_label("instruction_name", "variation").alias("scope")).agg(F.count("*").alias("n_rows"))


def bit_width_types(s: SparkSession, d: str) -> DataFrame:
    w = S.bit_width("bit_range")
    r = field_rows(s, d).select(w.alias("width"), S.type_id_for_width(w).alias("type_id"), S.domain_for_width(w).alias("domain"))
    return r.groupBy("width", "type_id", "domain").agg(F.count("*").alias("n_rows"))


def domain_expressions(s: SparkSession, d: str) -> DataFrame:
    r = once(s, d, "field_domain_catalog")
    return r.select("trace_id", S.domain_expression("field_name", "allowed_value_form", "allowed_values_or_range").alias("expression"), S.value_form("allowed_value_form").alias("form"))


def domain_constraints(s: SparkSession, d: str) -> DataFrame:
    r = once(s, d, "field_domain_catalog").withColumn("n", F.regexp_extract("trace_id", r"([0-9]+)$", 1).cast("bigint"))
    return K.constraints_from_domains(r, pos="n").select("constraint_id", "constraint_type_level1", "expression", "applies_to.entity_name")


def constraint_counts(s: SparkSession, d: str) -> DataFrame:
    return K.constraint_counts(once(s, d, "constraint_registry"))


def canonical_intervals(s: SparkSession, d: str) -> DataFrame:
    r = once(s, d, "field_domain_catalog").select(S.canonical_interval("allowed_values_or_range").alias("domain"))
    return r.filter("domain IS NOT NULL").groupBy("domain").agg(F.count("*").alias("n_rows"))


def page_metrics(s: SparkSession, d: str) -> DataFrame:
    m = B.page_metrics(page_blocks(s, d))
    return m.withColumn("ocr_reasons", F.array_join("ocr_reasons", ","))


def header_footer_position(s: SparkSession, d: str) -> DataFrame:
    kept = B.drop_margins(page_blocks(s, d), F.lit(HEIGHT), 0.1, 0.15)
    return kept.select("document_id", "block_id")


def repeated_lines(s: SparkSession, d: str) -> DataFrame:
    lines = page_blocks(s, d).select("document_id", "page", "block_type", F.explode(F.split("raw_text", "\n")).alias("raw_text"))
    return B.repeated_lines(lines, 3, 120)


def header_footer_repeat(s: SparkSession, d: str) -> DataFrame:
    lines = page_blocks(s, d).select("document_id", "page", "block_type", F.explode(F.split("raw_text", "\n")).alias("raw_text"))
    kept = B.drop_repeated(lines, 3, 120).select("document_id", "page", F.md5("raw_text").alias("line"))
    return kept.groupBy("document_id", "page", "line").agg(F.count("*").alias("n_lines"))


def reading_order(s: SparkSession, d: str) -> DataFrame:
    return B.reading_position(page_blocks(s, d)).select("document_id", "block_id", "read_pos")


def prompt_budget(s: SparkSession, d: str) -> DataFrame:
    return B.within_budget(page_blocks(s, d)).select("document_id", "block_id", "used_chars", F.md5("piece").alias("piece"))


def total_pages(s: SparkSession, d: str) -> DataFrame:
    return B.total_pages(page_blocks(s, d))


def block_neighbours(s: SparkSession, d: str) -> DataFrame:
    return B.neighbours(page_blocks(s, d))


def equation_blocks(s: SparkSession, d: str) -> DataFrame:
    t = B.tag_equations(page_blocks(s, d))
    return t.groupBy("block_type", "extraction_method").agg(F.count("*").alias("n_blocks"))


def page_confidence(s: SparkSession, d: str) -> DataFrame:
    b = page_blocks(s, d)
    chars = b.groupBy("document_id", "page").agg(F.sum(F.length("raw_text")).alias("page_chars"))
    n = F.coalesce(F.length("raw_text"), F.lit(0))
    conf = F.when(F.col("block_type") == "table", S.table_confidence(n)).when(F.col("block_type") == "image", S.image_confidence()).otherwise(S.text_confidence(F.coalesce("page_chars", F.lit(0)), n))
    return b.join(chars, ["document_id", "page"]).select("document_id", "block_id", conf.alias("confidence"))


def page_coverage(s: SparkSession, d: str) -> DataFrame:
    """Every page of every manual, to the last one there is or that is cited."""
    return D.whole_coverage(catalog(s, d), B.total_pages(page_blocks(s, d)))


def parsed_fields(s: SparkSession, d: str) -> DataFrame:
    p = D.parsed_fields(page_blocks(s, d))
    return p.select("document_id", "block_id", "field_idx", "field_name", "bit_range", "word_index", F.round("row_confidence", 4).alias("row_confidence"))


def band_candidates(s: SparkSession, d: str) -> DataFrame:
    return D.candidates_for_pages(page_blocks(s, d), catalog(s, d)).select("document_id", "page", "inst_pos", "n_candidates", "fallback")


def field_map(s: SparkSession, d: str) -> DataFrame:
    m = D.field_map(page_blocks(s, d), catalog(s, d))
    return m.select("trace_id", "stage_name", "document_id", "block_id", "inst_pos", "instruction_name", "variation", "field_name", "bit_range", "word_index", "confidence_score", "uncertain", F.col("source_refs")[0]["page"].alias("ref_page"))


def scope_coverage(s: SparkSession, d: str) -> DataFrame:
    return D.scope_coverage(field_rows(s, d), catalog(s, d))


def coverage_summary(s: SparkSession, d: str) -> DataFrame:
    return D.coverage_summary(scope_coverage(s, d))


def global_fields(s: SparkSession, d: str) -> DataFrame:
    return D.global_fields(field_rows(s, d))


def scope_fields(s: SparkSession, d: str) -> DataFrame:
    return D.scope_fields(field_rows(s, d)).select("document_id", "scope", F.array_join("fields", ",").alias("fields"))


def override_join(s: SparkSession, d: str) -> DataFrame:
    """Override sheet derived from the catalog: names of one kind get two fields, another none."""
    c = catalog(s, d)
    names = c.select(F.upper(strip(F.col("instruction_name"))).alias("scope")).distinct()
    two = F.expr("array(named_struct('field_name', 'A', 'bit_range', '7:0', 'word_index', 0), named_struct('field_name', 'B', 'bit_range', '', 'word_index', 1))")
    sheet = names.filter(F.col("scope").rlike("^[A-M]")).select("scope", F.when(F.col("scope").rlike("^[A-F]"), two).otherwise(F.slice(two, 1, 0)).alias("fields"))
    rows, _ = D.apply_overrides(field_rows(s, d), c, sheet)
    return rows.groupBy("document_id", "sheet_key", S.scope_label("instruction_name", "variation").alias("scope"), "field_name", "bit_range", "confidence_score").agg(F.count("*").alias("n_rows"))


def registry_repair(s: SparkSession, d: str) -> DataFrame:
    r = C.repair_types(once(s, d, "field_datatype_catalog"), table(s, d, "datatype_registry"))
    return r.groupBy("data_type_ref", "repaired").agg(F.count("*").alias("n_rows"))


def fold_dedup(s: SparkSession, d: str) -> DataFrame:
    conf = F.coalesce(F.when(F.isnan("confidence_score"), None).otherwise(F.col("confidence_score")), F.lit(0.6))
    c = catalog(s, d).select("document_id", F.upper(strip(F.col("instruction_name"))).alias("name"), F.coalesce(S.normalize_variation("variation"), F.lit("")).alias("variation"), "pos", F.greatest(F.lit(0.0), F.least(F.lit(1.0), conf)).alias("conf"))
    return C.fold_by_confidence(c, ["document_id", "name", "variation"], "pos", "conf")


def first_and_last(s: SparkSession, d: str) -> DataFrame:
    c = catalog(s, d).select("document_id", F.upper(strip(F.col("instruction_name"))).alias("name"), "pos", "opcode_raw")
    a = C.first_wins(c, ["document_id", "name"], "pos").withColumnsRenamed({"pos": "first_pos", "opcode_raw": "first_opcode"})
    b = C.last_wins(c, ["document_id", "name"], "pos").withColumnsRenamed({"pos": "last_pos", "opcode_raw": "last_opcode"})
    return a.join(b, ["document_id", "name"])


def type_registry(s: SparkSession, d: str) -> DataFrame:
    r = table(s, d, "datatype_registry").withColumn("pos", F.col("trace_id"))
    return C.datatype_registry(r).select("trace_id", "type_id", "type_name_raw", "category")


def inferred_types(s: SparkSession, d: str) -> DataFrame:
    return C.inferred_registry(field_rows(s, d)).select("type_id", "value_constraint_summary")


def interval_islands(s: SparkSession, d: str) -> DataFrame:
    """Blocks of a page that meet vertically; those of a page of several columns would."""
    b = page_blocks(s, d)
    return L.merge_boxes(b, ["document_id", "page"]).select("document_id", "page", "cluster", "n_boxes", *(F.col(f"bbox.{c}").alias(c) for c in ("x0", "y0", "x1", "y1")), "merged")


def _to_the_edges(b: DataFrame) -> DataFrame:
    """Blocks planted as tables over page breaks: stretched from margin to margin where the page or the block is of some kinds."""
    low, high = F.col("bbox.y1") >= 690, F.col("bbox.y0") <= 70
    kind = F.when((low | high) & (F.col("page") % 5 > 0), "table").otherwise(F.col("block_type"))
    box = G.box(F.col("bbox.x0"), F.when(high, 20.0).otherwise(F.col("bbox.y0")), F.col("bbox.x1"), F.when(low, HEIGHT - 20.0).otherwise(F.col("bbox.y1")))
    return b.withColumns({"block_type": kind, "bbox": box})


def stitch_links(s: SparkSession, d: str) -> DataFrame:
    b = _to_the_edges(page_blocks(s, d))
    return L.stitch_links(b, b.select("document_id", "page").distinct().withColumn("height", F.lit(HEIGHT)))


def block_spans(b: DataFrame) -> DataFrame:
    """Lines of blocks as spans; a line's share of the width stands for its size."""
    size = F.floor((F.col("bbox.x1") - F.col("bbox.x0")) / 16) / 2 - 5
    return b.select("document_id", "page", F.col("block_id").alias("block_no"), F.col("bbox").alias("block_box"), F.posexplode(F.split("raw_text", "\n")).alias("span_no", "text"), size.alias("size"))


def heading_rank(s: SparkSession, d: str) -> DataFrame:
    return L.size_tiers(block_spans(page_blocks(s, d)))


def eval_instructions(s: SparkSession, d: str) -> DataFrame:
    name, var = F.upper(strip(F.coalesce("instruction_name", F.lit("")))), S.normalize_variation("variation")
    truth = table(s, d, "instruction_catalog_mirror").groupBy("document_id", name.alias("instruction_name"), var.alias("variation"), F.col("trace_id").alias("pos")).agg(
        F.max(S.opcode_value("opcode_value")).alias("opcode_value")
    )
    return E.evaluate_instructions(catalog(s, d), truth, ["document_id"])


def eval_field_map(s: SparkSession, d: str) -> DataFrame:
    return E.evaluate_field_map(field_rows(s, d), once(s, d, "field_datatype_catalog").withColumn("bit_range", F.lit(None).cast("string")), ["document_id"])


def eval_names(s: SparkSession, d: str) -> DataFrame:
    return E.evaluate_names(field_rows(s, d), table(s, d, "field_domain_catalog"))


def eval_sections(s: SparkSession, d: str) -> DataFrame:
    low = lambda t, c: table(s, d, t).select(F.upper(strip(F.col(c))).alias("k")).filter("k <> ''")
    none = low("datatype_registry", "type_id").filter("k IS NULL")
    return E.evaluate_sections({
        "types": (low("field_datatype_catalog", "data_type_ref"), low("datatype_registry", "type_id"), ["k"]),
        "fields": (low("field_datatype_catalog", "field_name"), low("instruction_field_map", "field_name"), ["k"]),
        "empty": (low("datatype_registry", "type_id"), none, ["k"]),
    })


def _graph(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    return once(s, d, "constraint_registry"), catalog(s, d), once(s, d, "field_datatype_catalog"), table(s, d, "datatype_registry")


def ontology_nodes(s: SparkSession, d: str) -> DataFrame:
    c, i, f, r = _graph(s, d)
    return R.ontology_nodes(c, i, f, r).select("id", "type")


def ontology_edges(s: SparkSession, d: str) -> DataFrame:
    c, i, f, _ = _graph(s, d)
    return R.ontology_edges(c, i, f, scope=["document_id"])


def dangling_edges(s: SparkSession, d: str) -> DataFrame:
    return R.dangling_edges(ontology_nodes(s, d), ontology_edges(s, d))


def node_degrees(s: SparkSession, d: str) -> DataFrame:
    n = R.node_degrees(ontology_edges(s, d))
    return n.select("id", F.col("out_degree").cast("bigint").alias("out_degree"), F.col("in_degree").cast("bigint").alias("in_degree"))


def edge_sample(s: SparkSession, d: str) -> DataFrame:
    return R.sample_edges(ontology_nodes(s, d), ontology_edges(s, d), 100)


def unit_instructions(s: SparkSession, d: str) -> DataFrame:
    """Instructions per execution unit and manual, with the share that has a readable opcode."""
    c = catalog(s, d)
    unit = F.coalesce(blank_to_null("execution_unit"), F.lit("UNKNOWN_UNIT"))
    return c.groupBy("document_id", F.upper(unit).alias("unit")).agg(
        F.count_distinct(S.scope_label("instruction_name", "variation")).alias("n_scopes"), F.count_if(S.opcode_value("opcode_raw").isNotNull()).alias("n_opcodes")
    )


def evidence_lookup(s: SparkSession, d: str) -> DataFrame:
    """Text that stands behind each constraint: blocks on its cited pages."""
    c = once(s, d, "constraint_registry").select("constraint_id", "document_id", F.explode(D.evidence_pages()).alias("page"))
    b = page_blocks(s, d).groupBy("document_id", "page").agg(F.count("*").alias("n_blocks"), F.sum(F.length("raw_text")).alias("n_chars"))
    return c.join(b, ["document_id", "page"]).select("constraint_id", "page", "n_blocks", "n_chars")


def vector_topk(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "embeddings")
    q = e.filter("vec_id = 0").first()["embedding"]
    return V.top_k(e, q, 48).select("vec_id", F.round("score", 6).alias("score"))


def vector_topk_many(s: SparkSession, d: str) -> DataFrame:
    """Every vector whose id is divisible by 100 against all vectors."""
    e = table(s, d, "embeddings")
    q = e.filter("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return V.top_k_many(e, q, 10).select("query_id", "vec_id", "rank")


def index_rows(s: SparkSession, d: str) -> DataFrame:
    return V.index_rows(page_blocks(s, d)).select("document_id", "block_id", "vec_no", "index_on_page", "blocks_on_page", F.md5("text").alias("text"), F.md5("text_preview").alias("preview"))


def contract_violations(s: SparkSession, d: str) -> DataFrame:
    a = violations(catalog(s, d), "instruction_catalog").select(F.lit("instruction_catalog").alias("table_name"), "*")
    b = violations(field_rows(s, d), "instruction_field_map").select(F.lit("instruction_field_map").alias("table_name"), "*")
    return a.unionByName(b).groupBy("table_name", "rule", "column_name").agg(F.count("*").alias("n_rows"))


def corpus_chunks(s: SparkSession, d: str) -> DataFrame:
    docs = table(s, d, "documents").select(F.col("doc_id").cast("string").alias("document_id"), "text")
    return B.corpus_chunks(docs).select("document_id", "chunk_no", F.md5("text").alias("text"))


def glossary_terms(s: SparkSession, d: str) -> DataFrame:
    r = field_rows(s, d).select(F.col("field_name").alias("name"), F.col("bit_range").alias("definition"))
    return X.merge_terms(r).select("term_key", "name", "frequency", F.length("definition").alias("n_definition"))


def size_routes(s: SparkSession, d: str) -> DataFrame:
    docs = table(s, d, "documents").select(F.col("document_id"), "text").groupBy("document_id").agg(F.sum(F.length("text")).alias("n"))
    n = F.ceil(F.coalesce("n", F.lit(0)) / 3.0).cast("bigint")
    return docs.select("document_id", n.alias("est_tokens"), F.when(n < 30_000, "single").when(n <= 100_000, "chunked").otherwise("tree").alias("route"))


def markdown_export(s: SparkSession, d: str) -> DataFrame:
    from pagelode.sinks.files import markdown_blocks

    return markdown_blocks(page_blocks(s, d))


def combinations(s: SparkSession, d: str) -> DataFrame:
    """Boundary-value combinations of the fields of each scope: all, or beyond a thousand a set with all pairs of values."""
    r = once(s, d, "field_domain_catalog").withColumn("scope", S.scope_label("instruction_name", "variation"))
    m = X.combination_matrix(X.boundary_values(r))
    return m.select("document_id", "scope", "combo", F.to_json("assignment").alias("assignment"))


def pipeline_nodes(s: SparkSession, d: str) -> DataFrame:
    """The whole chain from blocks to the graph: field map, types, domains, constraints, nodes and edges."""
    from pagelode.plans.pipeline import run_chain

    out = run_chain({"page_blocks": page_blocks(s, d), "instruction_catalog": catalog(s, d)}, until="graph")
    n, e = out["nodes"], out["edges"]
    return n.groupBy("type").agg(F.count("*").alias("n")).unionByName(e.groupBy(F.col("rel").alias("type")).agg(F.count("*").alias("n")))


QUERIES = {f.__name__: f for f in (
    opcode_parse, scope_labels, bit_width_types, domain_expressions, domain_constraints, constraint_counts, canonical_intervals, page_metrics,
    header_footer_position, repeated_lines, header_footer_repeat, reading_order, prompt_budget, total_pages, block_neighbours, equation_blocks,
    page_confidence, page_coverage, parsed_fields, band_candidates, field_map, scope_coverage, coverage_summary, global_fields, scope_fields,
    override_join, registry_repair, fold_dedup, first_and_last, type_registry, inferred_types, interval_islands, stitch_links, heading_rank,
    eval_instructions, eval_field_map, eval_names, eval_sections, ontology_nodes, ontology_edges, dangling_edges, node_degrees, edge_sample,
    unit_instructions, evidence_lookup, vector_topk, vector_topk_many, index_rows, contract_violations, corpus_chunks, glossary_terms, size_routes,
    markdown_export, combinations, pipeline_nodes,
)}
