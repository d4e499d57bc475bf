"""Queries of single operators over the pipeline's tables: sources and sinks as round trips, layout, geometry, retrieval, strategies."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelode.functions import geometry as G
from pagelode.functions import scalars as S
from pagelode.functions.text import blank_to_null, strip
from pagelode.operators import blocks as B
from pagelode.operators import catalog as C
from pagelode.operators import constraints as K
from pagelode.operators import evaluate as E
from pagelode.operators import external as X
from pagelode.operators import fields as D
from pagelode.operators import glossary as Y
from pagelode.operators import graph as R
from pagelode.operators import layout as L
from pagelode.operators import retrieval as V
from pagelode.operators.selection import select_blocks
from pagelode.plans.operator_sql import ORACLE  # noqa: F401
from pagelode.plans.reference_queries import block_spans, catalog, field_rows, once, page_blocks
from pagelode.session import shared_dir, table
from pagelode.sinks import files as W
from pagelode.sources import files as I
from pagelode.sources import tables as T


def _folder(s: SparkSession, name: str) -> str:
    return f"{shared_dir(s)}/pagelode/{s.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def _text_file(df: DataFrame, path: str) -> str:
    """A hand-written list as one text file; ``df`` has few rows (``line`` in the order of ``at``)."""
    df.groupBy().agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "line"))), lambda x: x["line"]), "\n").alias("value")).write.text(path)
    return path


def _pick(c: F.Column | str) -> F.Column:
    """A number that spreads over rows and that SQL can make too."""
    return F.ascii(F.md5(c))


# --- sources and sinks ------------------------------------------------------------------------------------


def jsonl_roundtrip(s: SparkSession, d: str) -> DataFrame:
    """The field map written as JSON lines with explicit nulls and read again."""
    cols = "trace_id string, document_id string, instruction_name string, variation string, field_name string, bit_range string, word_index int, uncertain boolean"
    path = _folder(s, "jsonl")
    W.write_jsonl(table(s, d, "instruction_field_map").selectExpr(*(c.split()[0] for c in cols.split(", "))), path)
    return I.read_jsonl(s, path, cols)


def jsonl_missing(s: SparkSession, d: str) -> DataFrame:
    """A missing file is an empty table."""
    return I.read_jsonl(s, _folder(s, "none"), "trace_id string").agg(F.count("*").alias("n_rows"))


def report_roundtrip(s: SparkSession, d: str) -> DataFrame:
    """A one-row summary written as pretty JSON and read as one object."""
    path = _folder(s, "report")
    c = table(s, d, "instruction_catalog").agg(F.count("*").alias("n_rows"), F.count_distinct("document_id").alias("n_documents"), F.max("variation").alias("last_variation"))
    W.report_json(c).write.text(path)
    return I.read_json(s, path, "n_rows bigint, n_documents bigint, last_variation string")


def uploaded_rows(s: SparkSession, d: str) -> DataFrame:
    """The (fixed, small) type registry handed over as bytes of JSON lines."""
    rows = table(s, d, "datatype_registry").select("trace_id", "type_id", "category").toJSON().collect()
    return I.jsonl_from_bytes(s, ("﻿" + "\n\n".join(rows) + "\n").encode(), "trace_id string, type_id string, category string")


def csv_union_roundtrip(s: SparkSession, d: str) -> DataFrame:
    """Two tables of different columns as one CSV file with the sorted union of them."""
    path = _folder(s, "csv")
    W.write_csv([table(s, d, "field_datatype_catalog").select("trace_id", "data_type_ref"), table(s, d, "constraint_registry").select("trace_id", "applies_to")], path)
    out = T.read_table(s, path, "csv", "applies_to string, data_type_ref string, trace_id string", header="true")
    return out.select("trace_id", blank_to_null("data_type_ref").alias("data_type_ref"), F.get_json_object("applies_to", "$.entity_name").alias("entity_name"))


def pages_roundtrip(s: SparkSession, d: str) -> DataFrame:
    """Blocks written by document and read back by a range of pages (of each document, cut to what there is)."""
    path = _folder(s, "pages")
    W.write_blocks(page_blocks(s, d).select("document_id", "page", "block_id", "raw_text"), path)
    first, last = B.resolve_page_range(100_000, 10, 60)
    return T.read_pages(s, path, first=first, last=last).select(F.col("document_id").cast("string").alias("document_id"), "page", "block_id", F.md5("raw_text").alias("text"))


def page_range(s: SparkSession, d: str) -> DataFrame:
    return B.filter_pages(page_blocks(s, d), 5, 25).select("document_id", "block_id")


def index_roundtrip(s: SparkSession, d: str) -> DataFrame:
    """Vectors written as an index with its manifest, opened, and the best row for the first vector of each label."""
    path = _folder(s, "index")
    e = table(s, d, "embeddings").select(F.col("label").cast("string").alias("document_id"), "vec_id", V.normalized("embedding").alias("vec"))
    W.write_index(e, path, "model", "run")
    vectors, manifest = T.open_index(s, path)
    m = manifest.first()
    per = vectors.groupBy(F.col("document_id").cast("string").alias("document_id")).agg(F.count("*").alias("n"), F.min("vec_id").alias("first_vec"))
    return per.withColumns({"n_vectors": F.lit(m["n_vectors"]), "dim": F.lit(m["dim"]), "embedding_model": F.lit(m["embedding_model"])})


def graph_sink(s: SparkSession, d: str) -> DataFrame:
    """The graph as a database takes it: edges with both ends among the nodes."""
    path = _folder(s, "graph")
    c, i, f, r = once(s, d, "constraint_registry"), catalog(s, d), once(s, d, "field_datatype_catalog"), table(s, d, "datatype_registry")
    W.write_graph(R.ontology_nodes(c, i, f, r), R.ontology_edges(c, i, f, scope=["document_id"]), path)
    return s.read.parquet(f"{path}/edges")


def graph_file(s: SparkSession, d: str) -> DataFrame:
    """A graph file of the (fixed) types and their categories, read as nodes and edges."""
    path = _folder(s, "graph-file")
    t = table(s, d, "datatype_registry").select(strip("type_id").alias("t"), "category").filter("t <> '' AND category IS NOT NULL").distinct()
    node, edge = F.struct(F.col("t").alias("id"), F.lit("DataType").alias("type")), F.struct(F.col("t").alias("from"), F.lit("IS_A").alias("rel"), F.col("category").alias("to"))
    t.agg(F.collect_set(node).alias("nodes"), F.collect_set(edge).alias("edges")).select(F.to_json(F.struct("nodes", "edges"))).write.text(path)
    nodes, edges = I.read_graph(s, path)
    return edges.select("from", "rel", "to").unionByName(nodes.select(F.col("id").alias("from"), F.lit("node").alias("rel"), F.col("type").alias("to")))


def _registry(s: SparkSession, d: str) -> DataFrame:
    """Distinct type names as a short list: (t, at)."""
    t = table(s, d, "datatype_registry").select(F.upper(F.regexp_replace(strip("type_id"), r"[^A-Za-z0-9_]+", "_")).alias("t")).filter("t <> ''").distinct()
    return t.withColumn("at", F.concat(F.lit("1"), "t"))


def truth_files(s: SparkSession, d: str) -> DataFrame:
    """Ground-truth lists of every kind, with comments, byte order mark and blank lines, written and read."""
    r = _registry(s, d)
    head = s.createDataFrame([("0", "﻿# list"), ("00", "")], "at string, line string")
    def file(line) -> str:  # noqa: ANN001
        return _text_file(head.unionByName(r.select("at", line.alias("line"))), _folder(s, "truth"))
    lower, n = F.lower("t"), F.length("t") % 8
    none = F.lit(None).cast("string")
    inst = I.read_instruction_truth(s, file(F.concat(F.lit(" "), lower, F.lit("  "))))
    flds = I.read_field_truth(s, file(F.when(n < 4, F.concat_ws(" ", lower, F.lit("f1"), F.concat(F.lit("["), n.cast("string"), F.lit(":0]")))).otherwise(F.concat_ws("\t", lower, F.lit("cw"), F.lit("f2"), n.cast("string")))))
    names = I.read_name_truth(s, file(lower))
    typed = I.read_typed_truth(s, file(F.when(n < 3, F.concat(F.lit("TYPE| "), "t", F.lit(" |alias"))).when(n < 5, F.concat(F.lit("dtype|"), lower, F.lit("|v|f|"), "t")).otherwise(F.concat(F.lit("DOMAIN|f|"), "t"))))
    graph = I.read_graph_truth(s, file(F.when(n < 3, F.concat(F.lit("NODE|"), "t")).when(n < 5, F.concat(F.lit("CONSTRAINT|"), "t")).otherwise(F.concat(F.lit("EDGE|"), "t", F.lit("|HAS|x")))))

    def rows(kind: str, df: DataFrame, *cols) -> DataFrame:  # noqa: ANN002
        c = [x if not isinstance(x, str) else F.col(x) for x in cols]
        return df.select(F.lit(kind).alias("kind"), *(x.cast("string").alias(f"c{i}") for i, x in enumerate([*c, *[none] * (4 - len(c))])))

    parts = [
        rows("instruction", inst, "instruction_name"), rows("field", flds, "instruction_name", "variation", "field_name", "bit_range"), rows("name", names, "field_name"),
        rows("type", typed["types"], "type_id", "category"), rows("dtype", typed["dtypes"], "instruction_name", "variation", "field_name", "data_type_ref"),
        rows("domain", typed["domains"], "field_name", "allowed_value_form", "allowed_values_or_range"), rows("node", graph["nodes"], "id"),
        rows("constraint", graph["constraints"], "constraint_id"), rows("edge", graph["edges"], "from", "rel", "to"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def override_sheet(s: SparkSession, d: str) -> DataFrame:
    """An override sheet of the (fixed) types as scopes, with a comment key, written and read."""
    path = _folder(s, "sheet")
    fields = F.array(F.struct(F.lit("A").alias("field_name"), F.length("t").cast("string").alias("bit_range"), F.lit(0).alias("word_index")))
    one = _registry(s, d).agg(F.collect_list(F.struct(F.lower("t").alias("key"), F.struct(fields.alias("fields")).alias("value"))).alias("e"))
    entry = F.transform("e", lambda x: F.concat(F.lit('"'), x["key"], F.lit('":'), F.to_json(x["value"])))
    one.select(F.concat(F.lit('{"_comment":{},'), F.array_join(entry, ","), F.lit("}"))).write.text(path)
    sheet = I.read_override_sheet(s, path)
    return sheet.select("scope", F.explode("fields").alias("f")).select("scope", "f.field_name", "f.bit_range", "f.word_index")


# --- rows ---------------------------------------------------------------------------------------------------


def scope_columns(s: SparkSession, d: str) -> DataFrame:
    k = S.row_key("instruction_name", "variation")
    return C.attach_scope(catalog(s, d)).select("trace_id", "instruction_name", "variation", k["name"].alias("key_name"), k["variation"].alias("key_variation"))


def truth_catalog(s: SparkSession, d: str) -> DataFrame:
    """Catalog rows from the mirror taken as ground truth; the last row of a scope by trace id counts."""
    m = table(s, d, "instruction_catalog_mirror").groupBy(F.col("trace_id").alias("pos")).agg(*(F.max(c).alias(c) for c in ("instruction_name", "variation", "opcode_raw", "execution_unit")))
    out = C.catalog_from_truth(m.withColumns({"opcode_value": F.lit(None).cast("bigint"), "instruction_kind": F.lit("MACRO")}))
    return out.select("instruction_name", "variation", "opcode_raw", "opcode_radix", "opcode_value", "execution_unit", "instruction_kind", "confidence_score", F.col("source_refs")[0]["method"].alias("method"))


def truth_field_map(s: SparkSession, d: str) -> DataFrame:
    return C.field_map_from_truth(field_rows(s, d).select("instruction_name", "variation", "field_name", "bit_range", "pos"))


def filled_trace_ids(s: SparkSession, d: str) -> DataFrame:
    """Typed rows of ground truth without ids get them from their place."""
    t = once(s, d, "field_datatype_catalog").withColumn("trace_id", F.when(F.substring("pos", -1, 1) < "5", F.col("trace_id")))
    return C.with_trace_ids(t.select("trace_id", "pos", "data_type_ref"), "run", "gt").select("trace_id", "data_type_ref")


def block_references(s: SparkSession, d: str) -> DataFrame:
    """What rows of a block cite: its first reference, else its page, box and id; and the block's trace id."""
    b = page_blocks(s, d)
    ref = D.block_reference(b)
    return b.select("document_id", "block_id", ref["page"].alias("ref_page"), ref["method"].alias("ref_method"), ref["block_id"].alias("ref_block"), F.size(ref["bbox"]).alias("n_box"), S.trace_id("run", F.col("page"), F.col("block_id")).alias("made_id"))


def field_lines(s: SparkSession, d: str) -> DataFrame:
    return D.field_lines(field_rows(s, d)).groupBy("document_id", "line").agg(F.count("*").alias("n_rows"))


def item_constraints(s: SparkSession, d: str) -> DataFrame:
    """Constraints from items with a mapping of categories; the registry's sentences stand for a model's items."""
    r = once(s, d, "constraint_registry").withColumn("n", F.regexp_extract("trace_id", r"([0-9]+)$", 1).cast("bigint"))
    et = F.col("applies_to.entity_type")
    items = r.select(
        "n", F.col("constraint_type_level2").alias("constraint_category_candidate"), F.col("expression").alias("constraint_content"), "verbatim_sentence",
        F.when(et == "Field", F.col("applies_to.entity_name")).alias("field_name"), F.when(et == "Instruction", F.col("applies_to.entity_name")).alias("instruction_name"), F.lit("7").alias("source_page"),
    )
    labels = K.category_labels(items)
    mapping = K.complete_mapping(labels, labels.filter(F.length("label") % 2 == 0).withColumn("canonical", F.upper("label")))
    return K.constraints_from_items(items, mapping, pos="n").select("constraint_id", "constraint_type_level1", "expression", "applies_to.entity_type", "applies_to.entity_name", "page")


# --- blocks and layout --------------------------------------------------------------------------------------


def cited_blocks(s: SparkSession, d: str) -> DataFrame:
    """Blocks named by a set of ids, a third of all."""
    b = page_blocks(s, d)
    ids = b.filter(_pick("block_id") % 3 == 0).select("document_id", "block_id")
    return B.filter_block_ids(b, ids).select("document_id", "block_id")


def selected_blocks(s: SparkSession, d: str) -> DataFrame:
    """A selection of pages and of a range of blocks of one manual."""
    b = page_blocks(s, d).filter("document_id = 'hx9_core_trm'")
    return select_blocks(b, "page 1, 3-5, 7쪽", check=False).select("block_id", "read_pos")


def text_outside_tables(s: SparkSession, d: str) -> DataFrame:
    """Text blocks that no table covers; every fourth block is planted as a table of its page."""
    b = page_blocks(s, d)
    t = b.filter(_pick("trace_id") % 4 == 0).withColumns({"block_type": F.lit("table"), "block_id": F.concat(F.lit("t_"), "block_id")})
    return B.drop_text_in_tables(b.unionByName(t)).select("document_id", "block_id", "block_type")


def numbered_blocks(s: SparkSession, d: str) -> DataFrame:
    return B.number_blocks(page_blocks(s, d)).select("trace_id", "block_id")


def page_extents(s: SparkSession, d: str) -> DataFrame:
    return B.page_extent(page_blocks(s, d))


def box_relations(s: SparkSession, d: str) -> DataFrame:
    """Geometry of each block and the next on its page."""
    from pyspark.sql import Window

    w = Window.partitionBy("document_id", "page").orderBy("bbox.y0", "bbox.x0", "trace_id")
    n = page_blocks(s, d).select("document_id", "block_id", "bbox", F.lead("bbox").over(w).alias("o")).filter("o IS NOT NULL")
    a, o = F.col("bbox"), F.col("o")
    r = lambda c: F.round(c, 4)
    u = G.union(a, o)
    return n.select(
        "document_id", "block_id", r(G.area(u)).alias("union_area"), r(G.intersection_area(a, o)).alias("shared"), r(G.width_overlap(a, o)).alias("width_ratio"), r(G.height_overlap(a, o)).alias("height_ratio"),
        G.adjacent_vertically(a, o, 5.0, 0.5).alias("stacked"), G.adjacent_horizontally(a, o, 5.0, 0.5).alias("beside"), G.rows_overlap(a, o).alias("meets"), G.center_inside(a, o).alias("inside"),
        r(G.area(G.expand_to_page(a, F.lit(612.0)))).alias("full_width"),
    )


def span_roles(s: SparkSession, d: str) -> DataFrame:
    """Role of each line's size; every third size is moved between the tiers."""
    sp = block_spans(page_blocks(s, d))
    moved = sp.withColumn("size", F.when(F.col("span_no") % 3 == 2, F.col("size") + 0.25).otherwise(F.col("size")))
    return L.span_roles(moved).select("document_id", "block_no", "span_no", "role")


def tagged_headings(s: SparkSession, d: str) -> DataFrame:
    """Text of blocks as role-tagged spans, matched by box."""
    b = page_blocks(s, d)
    t = L.tag_headings(b, block_spans(b))
    return t.select("document_id", "block_id", F.md5("tagged").alias("tagged"))


def heading_texts(s: SparkSession, d: str) -> DataFrame:
    """Role-tagged text read back into roles and texts."""
    b = page_blocks(s, d)
    tagged = F.concat(F.lit("<heading1>"), F.col("block_id"), F.lit(" &lt;sup&gt;</heading1><body>x<sup>2</sup> &amp; "), F.col("block_type"), F.lit("</body>"))
    seg = b.select("document_id", "block_id", F.posexplode(S.heading_segments(F.when(F.col("page") % 2 == 0, tagged).otherwise(F.col("block_type")))).alias("n", "x"))
    return seg.select("document_id", "block_id", "n", "x.role", "x.text")


def merged_spans(s: SparkSession, d: str) -> DataFrame:
    """Spans of lines as text: several lines by newline, the words of a single one by space."""
    b = page_blocks(s, d).filter("raw_text IS NOT NULL")
    line = lambda x: F.struct(F.transform(F.split(x, " "), lambda w: F.struct(w.alias("text"))).alias("spans"))
    return b.select("document_id", "block_id", F.md5(S.merge_spans(F.transform(F.split("raw_text", "\n"), line))).alias("text"))


def script_marks(s: SparkSession, d: str) -> DataFrame:
    """Raised and lowered spans: the blocks of a page stand for the spans of a line."""
    b = page_blocks(s, d)
    size = F.when(_pick("block_id") % 2 == 0, 400.0).otherwise(300.0)
    sp = b.select("document_id", "page", "block_id", F.lit("x").alias("text"), "bbox", size.alias("size"), (_pick("trace_id") % 9 == 0).cast("int").alias("flags"))
    return L.script_roles(sp, ["document_id", "page"]).select("document_id", "block_id", "script")


def block_sizes(s: SparkSession, d: str) -> DataFrame:
    """Mean size of the spans that meet a block's box."""
    b = page_blocks(s, d)
    sp = b.select("document_id", "page", "bbox", (_pick("block_id") % 40).cast("double").alias("size"))
    return L.font_sizes(b, sp).select("document_id", "block_id", F.round("size", 6).alias("size"))


def supplemented(s: SparkSession, d: str) -> DataFrame:
    """Chunks of texts as further blocks of the manuals they belong to."""
    docs = table(s, d, "documents").filter("document_id IS NOT NULL").select("document_id", "doc_id", "text")
    chunks = B.corpus_chunks(docs.select(F.col("doc_id").cast("string").alias("document_id"), "text")).withColumnRenamed("document_id", "doc_id")
    chunks = chunks.join(docs.select(F.col("doc_id").cast("string").alias("doc_id"), "document_id"), "doc_id").withColumn("chunk_no", F.struct(F.col("doc_id").cast("bigint"), "chunk_no"))
    out = B.add_supplement(page_blocks(s, d).select("document_id", "page", "block_id", "block_type", "raw_text", "extraction_method"), chunks.select("document_id", "chunk_no", "text"))
    return out.select("document_id", "page", "block_id", "extraction_method", F.md5("raw_text").alias("text"))


def prompts(s: SparkSession, d: str) -> DataFrame:
    return B.prompt_texts(page_blocks(s, d), 5_000).select("document_id", F.md5("prompt").alias("prompt"), F.length("prompt").alias("n_chars"))


# --- retrieval and graphs -----------------------------------------------------------------------------------


def embedded_texts(s: SparkSession, d: str) -> DataFrame:
    """Texts embedded by a handed-in function (here counts of characters), as unit vectors."""
    docs = table(s, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    e = V.embed(docs, lambda texts: [[len(t), t.count("e"), 1.0] for t in texts])
    return e.select("doc_id", *(F.round(F.col("vec")[i], 6).alias(f"v{i}") for i in range(3)))


def narrowed_blocks(s: SparkSession, d: str) -> DataFrame:
    """Blocks named by retrieval; without hits all blocks stay."""
    b = page_blocks(s, d)
    some, why = V.narrow_blocks(b, lambda: b.filter("block_type = 'table'").select("document_id", "block_id"))
    every, none = V.narrow_blocks(b, lambda: b.filter("false").select("document_id", "block_id"))
    return some.select("document_id", "block_id", F.lit(why["reason"]).alias("reason")).unionByName(every.select("document_id", "block_id", F.lit(none["reason"]).alias("reason")))


def _hits(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "embeddings")
    q = e.filter("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return V.top_k_many(e, q, 10)


def ranked_ids(s: SparkSession, d: str) -> DataFrame:
    """Ids of ranked hits, each at its first rank."""
    return V.ranked_block_ids(_hits(s, d).select(F.concat(F.lit("b"), F.col("vec_id") % 50).alias("block_id"), "rank"))


def chat_contexts(s: SparkSession, d: str) -> DataFrame:
    """Previews of the best hits of each query, in order of rank."""
    h = _hits(s, d).select(F.col("query_id").cast("string").alias("conv_id"), "rank", F.lit(0.5).alias("score"), F.lit(1).alias("page"), F.concat(F.lit("b"), "vec_id").alias("block_id"), F.lit("text").alias("text_preview"))
    return V.chat_context(h, 8)


def coverage_measure(s: SparkSession, d: str) -> DataFrame:
    """One measure of page coverage over the pages of all manuals, as a chart takes it."""
    cov = D.whole_coverage(catalog(s, d), B.total_pages(page_blocks(s, d)))
    return V.coverage_metric(cov, "instruction_count").groupBy("page").agg(F.sum("value").alias("value"))


def viewer_nodes(s: SparkSession, d: str) -> DataFrame:
    """Nodes a viewer draws for the first edges, with stand-ins for missing ends."""
    c, i, f, r = once(s, d, "constraint_registry"), catalog(s, d), once(s, d, "field_datatype_catalog"), table(s, d, "datatype_registry")
    n, _ = R.viewer_graph(R.ontology_nodes(c, i, f, r), R.ontology_edges(c, i, f, scope=["document_id"]), 5_000)
    return n.groupBy("type").agg(F.count("*").alias("n"))


def eval_graph(s: SparkSession, d: str) -> DataFrame:
    """Constraints, nodes and edges of the graph against those of half of the constraints."""
    c, i, f, r = once(s, d, "constraint_registry"), catalog(s, d), once(s, d, "field_datatype_catalog"), table(s, d, "datatype_registry")
    half = c.filter(_pick(strip("constraint_id")) % 2 == 0)
    nodes, edges = (lambda k: R.ontology_nodes(k, i, f, r).select("id")), (lambda k: R.ontology_edges(k, i, f, scope=["document_id"]))
    return E.evaluate_graph((c, half), (nodes(c), nodes(half)), (edges(c), edges(half)))


def matched_aliases(s: SparkSession, d: str) -> DataFrame:
    """Names of the mirror near a name of the type registry."""
    names = table(s, d, "datatype_registry").select(F.concat(F.substring("type_id", 1, 1), F.lit("x"), F.substring("type_id", 2, 99)).alias("name")).filter("name IS NOT NULL").distinct()
    known = table(s, d, "datatype_registry").select(F.upper(strip("type_id")).alias("name")).filter("name <> ''").distinct()
    return Y.match_aliases(names, known).select("name", "distance")


def overlapping_chunks(s: SparkSession, d: str) -> DataFrame:
    docs = table(s, d, "documents").select(F.col("doc_id").cast("string").alias("document_id"), "text")
    return Y.overlapping_chunks(docs, 2_000).select("document_id", "chunk_no", F.md5("text").alias("text"))


def satisfied_domains(s: SparkSession, d: str) -> DataFrame:
    """Whether the value 3 lies in each domain; null where the domain says nothing checkable."""
    r = once(s, d, "field_domain_catalog").select("trace_id", S.structured_domain("allowed_value_form", "allowed_values_or_range").alias("structured_domain"), F.lit("3").alias("value"))
    return r.select("trace_id", K.evaluate_domain().alias("satisfied"))


def typed_fields(s: SparkSession, d: str) -> DataFrame:
    """Fields with their type and the form of their domain."""
    key = ["document_id", "name", "var", "field"]
    k = lambda t: once(s, d, t).select("*", *_field_key()).filter("field IS NOT NULL")
    types = k("field_datatype_catalog").select(*key, blank_to_null("data_type_ref").alias("type_id")).filter("type_id IS NOT NULL").distinct()
    forms = k("field_domain_catalog").select(*key, S.value_form("allowed_value_form").alias("form")).distinct()
    return types.join(forms, key)


def _field_key() -> tuple[F.Column, ...]:
    return (
        F.upper(strip(F.coalesce("instruction_name", F.lit("")))).alias("name"), F.coalesce(S.normalize_variation("variation"), F.lit("")).alias("var"), F.upper(blank_to_null("field_name")).alias("field"),
    )


def constraint_kinds(s: SparkSession, d: str) -> DataFrame:
    """How many constraints of each kind a field has."""
    c = once(s, d, "constraint_registry").filter("applies_to.entity_type = 'Field'")
    return c.groupBy(F.upper(blank_to_null("applies_to.entity_name")).alias("field"), "constraint_type_level1").agg(F.count("*").alias("n_rows"))


def types_of_one_manual(s: SparkSession, d: str) -> DataFrame:
    """Types that a single manual refers to."""
    t = once(s, d, "field_datatype_catalog").select("document_id", F.lower(blank_to_null("data_type_ref")).alias("type_id")).filter("type_id IS NOT NULL")
    return t.groupBy("type_id").agg(F.count_distinct("document_id").alias("n"), F.min("document_id").alias("document_id")).filter("n = 1").select("type_id", "document_id")


def version_changes(s: SparkSession, d: str) -> DataFrame:
    """Instructions added and removed between a manual and the one before it in its family (name without number)."""
    from pyspark.sql import Window

    scopes = catalog(s, d).select("document_id", S.scope_label("instruction_name", "variation").alias("scope")).distinct()
    docs = scopes.select("document_id").distinct().withColumn("family", F.regexp_replace("document_id", "_[0-9]+$", ""))
    before = docs.withColumn("before", F.lag("document_id").over(Window.partitionBy("family").orderBy("document_id"))).filter("before IS NOT NULL").select("document_id", "before")
    new = scopes.join(before, "document_id").select("document_id", "scope", F.lit(1).alias("n"), F.lit(0).alias("o"))
    old = scopes.withColumnRenamed("document_id", "before").join(before, "before").select("document_id", "scope", F.lit(0).alias("n"), F.lit(1).alias("o"))
    per = new.unionByName(old).groupBy("document_id", "scope").agg(F.max("n").alias("n"), F.max("o").alias("o"))
    return per.groupBy("document_id").agg(F.count_if(F.col("o") == 0).alias("added"), F.count_if(F.col("n") == 0).alias("removed"), F.count_if((F.col("n") == 1) & (F.col("o") == 1)).alias("kept"))


def retrieved_blocks(s: SparkSession, d: str) -> DataFrame:
    """Blocks that hold the words of a question, best first."""
    return V.retrieve(page_blocks(s, d), V.RetrievalConfig(True, 48, "reset register overflow sticky", "keyword"), None)


def neighbour_windows(s: SparkSession, d: str) -> DataFrame:
    """Hits with the blocks before and after them."""
    b = page_blocks(s, d)
    return V.with_neighbours(b.filter(_pick("trace_id") % 16 == 0), b)


# --- strategies around outside engines ------------------------------------------------------------------------


def _reply(system: str, user: str) -> str:
    """Stands for a model: names the pages of the prompt, fenced as models do."""
    import re

    pages = re.findall(r"--- page=(\d+) block_id=(\S+)", user)
    items = [{"instruction_name": f" i{p}", "opcode_raw": hex(int(p)), "aliases": [b, " "], "confidence_score": 0.5, "source_page": p} for p, b in pages]
    return "```json\n" + json.dumps({"instructions": items, "domains": [{"field_name": b, "allowed_values_or_range": f"0..{p}", "source_page": p} for p, b in pages]}) + "\n```"


def extracted_instructions(s: SparkSession, d: str) -> DataFrame:
    """The catalog from replies to prompts, one prompt per manual."""
    replies = X.chat_json(B.prompt_texts(page_blocks(s, d), 5_000), "instructions", _reply)
    cat = C.instruction_catalog(X.reply_items(replies, "instructions", X.INSTRUCTION_ITEMS))
    return cat.select("trace_id", "document_id", "instruction_name", F.array_join("aliases", ",").alias("aliases"), "opcode_value", "execution_unit", "confidence_score", F.col("source_refs")[0]["page"].alias("page"))


def extracted_domains(s: SparkSession, d: str) -> DataFrame:
    replies = X.chat_json(B.prompt_texts(page_blocks(s, d), 5_000), "domains", _reply)
    return X.normalized_domains(X.reply_items(replies, "domains", X.DOMAIN_ITEMS)).select("document_id", "pos", "field_name", "allowed_value_form", "allowed_values_or_range", "page")


def optical_texts(s: SparkSession, d: str) -> DataFrame:
    """Blocks read by a handed-in engine, with its confidence; the text stands for the image."""
    b = page_blocks(s, d).select("document_id", "block_id", F.encode("raw_text", "utf-8").alias("image"))
    return X.read_optically(b, lambda x: x.decode()[:300]).select("document_id", "block_id", F.md5("raw_text").alias("text"), "confidence_score")


def table_cells(s: SparkSession, d: str) -> DataFrame:
    """Cells of tables put together as text, the other engine's text where it says something."""
    b = page_blocks(s, d).filter("block_type = 'table' AND raw_text IS NOT NULL")
    rows = b.select("document_id", "block_id", F.posexplode(F.split("raw_text", "\n")).alias("row", "line"))
    cells = rows.select("document_id", "block_id", "row", F.posexplode(F.split("line", "\t")).alias("col", "text"))
    t = X.table_text(cells, ["document_id", "block_id"])
    other = F.when(_pick("block_id") % 2 == 0, F.lit(" ")).otherwise(F.lit("other"))
    return t.select("document_id", "block_id", F.md5(X.prefer_text(F.col("raw_text"), other)).alias("text"))


QUERIES = {f.__name__: f for f in (
    jsonl_roundtrip, jsonl_missing, report_roundtrip, uploaded_rows, csv_union_roundtrip, pages_roundtrip, page_range, index_roundtrip, graph_sink, graph_file, truth_files, override_sheet,
    scope_columns, truth_catalog, truth_field_map, filled_trace_ids, block_references, field_lines, item_constraints, cited_blocks, selected_blocks, text_outside_tables, numbered_blocks,
    page_extents, box_relations, span_roles, tagged_headings, heading_texts, merged_spans, script_marks, block_sizes, supplemented, prompts, embedded_texts, narrowed_blocks, ranked_ids,
    chat_contexts, coverage_measure, viewer_nodes, eval_graph, matched_aliases, overlapping_chunks, satisfied_domains, typed_fields, constraint_kinds, types_of_one_manual, version_changes, retrieved_blocks, neighbour_windows, extracted_instructions, extracted_domains, optical_texts, table_cells,
)}
