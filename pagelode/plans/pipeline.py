"""Stages as functions from tables to tables, composed in one session."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagelode.functions import scalars as S
from pagelode.operators import blocks as B
from pagelode.operators import catalog as C
from pagelode.operators import constraints as K
from pagelode.operators import evaluate as E
from pagelode.operators import external as X
from pagelode.operators import fields as D
from pagelode.operators import glossary as Y
from pagelode.operators import graph as R
from pagelode.operators import layout as L
from pagelode.operators.contracts import quality_gates
from pagelode.operators.retrieval import RetrievalConfig, narrow_blocks, retrieve
from pagelode.session import materialize

Tables = dict[str, DataFrame]


@dataclass
class Config:
    """Settings of a run: page range, margins, budget, optional clients with their replays, retrieval."""

    run_id: str = "run"
    first_page: int | None = None
    last_page: int | None = None
    top_margin: float = 0.0
    bottom_margin: float = 0.0
    page_height: float = 792.0
    repeat_pages: int = 0
    budget: int = 100_000
    client: X.ChatClient | None = None
    replays: Tables = field(default_factory=dict)
    system_prompts: dict[str, str] = field(default_factory=dict)
    retriever: Callable[[str], DataFrame] | None = None
    retrieval: RetrievalConfig = RetrievalConfig()
    embedder: Callable[[list[str]], list] | None = None
    stitch: bool = False
    lines_per_prompt: int = 500
    max_nodes: int = 80
    prune: bool = True


def stage_blocks(t: Tables, cfg: Config) -> Tables:
    """Page range, table text precedence, equations; then over documents heading tags (where ``spans`` are given), tables over
    page breaks, headers and footers, in the order that matters."""
    b = t["page_blocks"]
    if cfg.first_page is not None or cfg.last_page is not None:
        b = B.filter_pages(b, cfg.first_page or 1, cfg.last_page or (1 << 30))
    b = B.tag_equations(B.drop_text_in_tables(b))
    if "spans" in t:
        tagged = L.tag_headings(b, t["spans"])
        b = b.join(tagged, ["document_id", "block_id"], "left").withColumn("raw_text", F.coalesce("tagged", "raw_text")).drop("tagged")
    if cfg.stitch:
        b = L.stitch_tables(b, b.select("document_id", "page").distinct().withColumn("height", F.lit(cfg.page_height)))
    if cfg.top_margin or cfg.bottom_margin:
        b = B.drop_margins(b, F.lit(cfg.page_height), cfg.top_margin, cfg.bottom_margin)
    if cfg.repeat_pages:
        b = B.drop_repeated(b, cfg.repeat_pages)
    return {**t, "page_blocks": b, "page_metrics": B.page_metrics(b)}


def _asks(cfg: Config, stage: str) -> bool:
    return cfg.client is not None or stage in cfg.replays


def _excerpts(t: Tables, cfg: Config, stage: str) -> DataFrame:
    """(document_id, prompt): what a stage shows of the documents, narrowed by retrieval where it is on."""
    find = cfg.retriever
    if find is None and cfg.retrieval.enabled:
        find = lambda s: retrieve(t["page_blocks"], cfg.retrieval, cfg.embedder, cfg.system_prompts.get(s, s) if not cfg.retrieval.query else "")
    blocks, _ = narrow_blocks(t["page_blocks"], lambda: find(stage), enabled=find is not None)
    return B.prompt_texts(blocks, cfg.budget)


def _replies(prompts: DataFrame, cfg: Config, stage: str) -> DataFrame:
    return X.chat_json(prompts, cfg.system_prompts.get(stage, stage), cfg.client, cfg.replays.get(stage))


def _ask(t: Tables, cfg: Config, stage: str, array: str, items: str) -> DataFrame:
    return X.reply_items(_replies(_excerpts(t, cfg, stage), cfg, stage), array, items)


def _ask_fields(t: Tables, cfg: Config, stage: str, array: str, items: str, lead: str = "") -> DataFrame:
    """Items asked for about the fields of each manual, ``lines_per_prompt`` of them or so in a prompt, with its excerpts."""
    lines = D.field_lines(t["instruction_field_map"]).distinct()
    parts = lines.groupBy("document_id").agg(F.ceil(F.count("*") / cfg.lines_per_prompt).alias("_parts"))
    dealt = lines.join(parts, "document_id").withColumn("_part", F.pmod(F.xxhash64("line"), "_parts"))
    listed = dealt.groupBy("document_id", "_part").agg(F.array_join(F.array_sort(F.collect_list("line")), "\n").alias("_lines"))
    text = _excerpts(t, cfg, stage).withColumnRenamed("prompt", "_text")
    prompts = listed.join(text, "document_id", "left").select("document_id", F.concat_ws("\n\n", F.lit(lead), "_lines", F.coalesce("_text", F.lit("(no text blocks)"))).alias("prompt"))
    return X.reply_items(_replies(prompts, cfg, stage), array, items)


def stage_instructions(t: Tables, cfg: Config) -> Tables:
    """The instruction catalog, from replies of a language model unless it is given."""
    if "instruction_catalog" in t:
        return t
    return {**t, "instruction_catalog": C.instruction_catalog(_ask(t, cfg, "instructions", "instructions", X.INSTRUCTION_ITEMS), cfg.run_id)}


def stage_fields(t: Tables, cfg: Config) -> Tables:
    rows = D.field_map(t["page_blocks"], t["instruction_catalog"], cfg.run_id)
    if "override_sheet" in t:
        rows, warnings = D.apply_overrides(rows, t["instruction_catalog"], t["override_sheet"], cfg.run_id)
        t = {**t, "override_warnings": warnings}
    rows = materialize(rows, "field_map")  # every later stage reads it
    return {**t, "instruction_field_map": rows, "scope_coverage": D.scope_coverage(rows, t["instruction_catalog"]), "global_fields": D.global_fields(rows)}


def stage_types(t: Tables, cfg: Config) -> Tables:
    """The type registry, from replies of a language model or inferred from widths unless it is given."""
    rows = t["instruction_field_map"]
    out = dict(t)
    if _asks(cfg, "types"):
        out.setdefault("datatype_registry", C.datatype_registry(_ask(t, cfg, "types", "types", X.TYPE_ITEMS), cfg.run_id))
    out.setdefault("datatype_registry", C.inferred_registry(rows))
    return out


def stage_field_types(t: Tables, cfg: Config) -> Tables:
    """A type for each field: given, mapped by a language model to the registry's ids, or inferred; unknown ids are repaired."""
    out = dict(t)
    if "field_datatype_catalog" not in out and _asks(cfg, "mappings"):
        ids = out["datatype_registry"].agg(F.array_join(F.array_sort(F.collect_set("type_id")), "\n").alias("x")).first()["x"]  # types are few
        out["field_datatype_catalog"] = X.mapped_types(_ask_fields(out, cfg, "mappings", "mappings", X.MAPPING_ITEMS, ids or "UNKNOWN"))
    if "field_datatype_catalog" in out:
        out["field_datatype_catalog"] = materialize(C.repair_types(out["field_datatype_catalog"], out["datatype_registry"]), "field-types")
    out.setdefault("field_datatype_catalog", C.field_datatypes(out["instruction_field_map"], cfg.run_id))
    return out


def stage_field_domains(t: Tables, cfg: Config) -> Tables:
    """A value domain for each field: given, described by a language model, or inferred from widths."""
    out = dict(t)
    if "field_domain_catalog" not in out and _asks(cfg, "domains"):
        out["field_domain_catalog"] = materialize(X.normalized_domains(_ask_fields(out, cfg, "domains", "domains", X.DOMAIN_ITEMS)), "field-domains")
    out.setdefault("field_domain_catalog", C.field_domains(out["instruction_field_map"]))
    return out


def stage_constraints(t: Tables, cfg: Config) -> Tables:
    """One constraint per domain row, numbered by field, manual, scope and text, with those a language model found."""
    d = t["field_domain_catalog"]
    cols = [c for c in ("field_name", "document_id", "instruction_name", "variation", "allowed_value_form", "allowed_values_or_range") if c in d.columns]
    # Rows alike in all columns become equal constraints, so it does not matter which of them has which number.
    cons = K.constraints_from_domains(C.numbered_by(d.select(*cols), cols).withColumnRenamed("n", "pos"), cfg.run_id)
    if _asks(cfg, "constraints"):
        items = materialize(_ask(t, cfg, "constraints", "constraints", X.CONSTRAINT_ITEMS), "constraint-items")
        mapping = t["category_mapping"] if "category_mapping" in t else _categories(items, cfg)
        t = {**t, "category_mapping": mapping}
        at = F.row_number().over(Window.partitionBy("document_id").orderBy("pos")) - 1
        cons = cons.unionByName(K.constraints_from_items(items.withColumn("pos", at), mapping, cfg.run_id), allowMissingColumns=True)
    cons = materialize(cons, "constraints")
    return {**t, "constraint_registry": cons, "constraint_counts": K.constraint_counts(cons)}


def _categories(items: DataFrame, cfg: Config) -> DataFrame:
    """(label, canonical): all labels, merged by a language model where there is one; what it leaves out stays itself."""
    labels = K.category_labels(items)
    if not _asks(cfg, "categories"):
        return labels.withColumn("canonical", F.col("label"))
    # Labels are dealt to prompts by their first letter, so that like ones meet and no prompt holds all of them.
    dealt = labels.groupBy(F.lower(F.substring("label", 1, 1)).alias("_first")).agg(F.to_json(F.array_sort(F.collect_list("label"))).alias("prompt"))
    replies = _replies(dealt, cfg, "categories").select(F.explode(F.from_json("reply", "mapping map<string,string>")["mapping"]).alias("label", "canonical"))
    return materialize(K.complete_mapping(labels, replies.groupBy("label").agg(F.min("canonical").alias("canonical"))), "categories")


def stage_bindings(t: Tables, cfg: Config) -> Tables:
    """Values that a language model finds for the first ``max_nodes`` nodes of the graph, manual by manual."""
    if not _asks(cfg, "bindings"):
        return t
    nodes = t["nodes"].orderBy("pos").limit(cfg.max_nodes).select("id", "type", "props").collect()  # bounded by max_nodes
    listed = json.dumps([{"node_id": r["id"], "type": r["type"], "props": json.loads(r["props"] or "{}")} for r in nodes], ensure_ascii=False)
    prompts = _excerpts(t, cfg, "bindings").withColumn("prompt", F.concat_ws("\n\n", F.lit(listed), "prompt"))
    return {**t, "bindings": X.bound_values(X.reply_items(_replies(prompts, cfg, "bindings"), "bindings", X.BINDING_ITEMS))}


def stage_combinations(t: Tables, cfg: Config) -> Tables:
    """Test cases of each scope from boundary values, checked against the constraints, and what they were made from."""
    d = t["field_domain_catalog"]
    if not {"document_id", "instruction_name"} <= set(d.columns):
        return t
    scoped = d.withColumn("scope", S.scope_label("instruction_name", "variation"))
    cases = materialize(Y.test_cases(Y.boundary_values(scoped), t["constraint_registry"], cfg.prune), "test-cases")
    counts = t["constraint_counts"].filter("level = 'level1'").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_constraints"), F.array_sort(F.collect_set("label")).alias("canonical_categories"))
    context = counts.select(F.lit(cfg.run_id).alias("stage_run_id"), "n_constraints", "canonical_categories", t["global_fields"].agg(F.array_sort(F.collect_set("field_name"))).scalar().alias("canonical_field_names"))
    return {**t, "test_cases": cases, "combination_context": context}


def stage_reports(t: Tables, cfg: Config) -> Tables:
    """Gates over the run, what is unresolved, and scores against whatever ground truth is given (``truth_*`` tables)."""
    out = {**t, "quality_gates": quality_gates(t)}
    if "edges" in t:
        out["unresolved"] = R.dangling_edges(t["nodes"], t["edges"])
    scores = {
        "instructions": ("truth_instructions", lambda x: E.evaluate_instructions(t["instruction_catalog"], x)),
        "fields": ("truth_fields", lambda x: E.evaluate_field_map(t["instruction_field_map"], x)),
        "names": ("truth_names", lambda x: E.evaluate_names(t["global_fields"], x)),
    }
    for name, (table, score) in scores.items():
        if table in t:
            out[f"scores_{name}"] = score(t[table])
    typed = {
        "types": ("truth_types", t.get("datatype_registry"), ["type_id"]), "dtypes": ("truth_dtypes", t.get("field_datatype_catalog"), ["field_name", "data_type_ref"]),
        "domains": ("truth_domains", t.get("field_domain_catalog"), ["field_name", "allowed_value_form", "allowed_values_or_range"]),
        "constraints": ("truth_constraints", t.get("constraint_registry"), ["constraint_id"]), "nodes": ("truth_nodes", t.get("nodes"), ["id"]), "edges": ("truth_edges", t.get("edges"), ["from", "rel", "to"]),
    }
    sections = {k: (p, t[g], keys) for k, (g, p, keys) in typed.items() if g in t and p is not None}
    if sections:
        out["scores_sections"] = E.evaluate_sections(sections)
    return out


def stage_graph(t: Tables, cfg: Config) -> Tables:
    cons = t["constraint_registry"].withColumn("pos", F.col("trace_id"))
    inst, types = t["instruction_catalog"], t["field_datatype_catalog"]
    scope = ["document_id"] if all("document_id" in x.columns for x in (inst, types)) else []
    return {**t, "nodes": R.ontology_nodes(cons, inst, types, t["datatype_registry"]), "edges": R.ontology_edges(cons, inst, types, scope=scope)}


STAGES: list[tuple[str, Callable[[Tables, Config], Tables]]] = [
    ("blocks", stage_blocks), ("instructions", stage_instructions), ("fields", stage_fields), ("types", stage_types),
    ("field_types", stage_field_types), ("field_domains", stage_field_domains), ("constraints", stage_constraints), ("graph", stage_graph),
    ("bindings", stage_bindings), ("combinations", stage_combinations), ("reports", stage_reports),
]


def run_stage(name: str, tables: Tables, cfg: Config | None = None) -> Tables:
    """One stage over the tables it needs; a stage that is not there is a ValueError."""
    stage = dict(STAGES).get(name)
    if stage is None:
        raise ValueError(f"no such stage: {name}")
    return stage(dict(tables), cfg or Config())


def run_chain(tables: Tables, cfg: Config | None = None, until: str | None = None) -> Tables:
    """All stages in order (or up to ``until``), each adding its tables.

    Field map and constraints are written once to the shared folder, since several stages read them.
    """
    cfg, t = cfg or Config(), dict(tables)
    for name, stage in STAGES:
        t = stage(t, cfg)
        if name == until:
            break
    return t
