"""The whole chain with replies of a stand-in for a language model, to test cases, gates and scores; each stage alone; the command line."""

import json

import pytest
from pyspark.sql import functions as F

from pagelode.operators import external as X
from pagelode.operators import glossary as G
from pagelode.operators import layout as L
from pagelode.operators import retrieval as V
from pagelode.operators.catalog import global_schema_from_truth, graph_from_truth, typed_from_truth
from pagelode.plans.pipeline import Config, run_chain, run_stage
from tests.test_operators import blocks



def client(system, user):
    answers = {
        "instructions": {"instructions": [{"instruction_name": "add ", "aliases": ["ADDX", " "], "opcode_raw": "0x2A", "execution_unit": "EU0", "confidence_score": 0.9, "source_page": 1}]},
        "types": {"types": [{"type_id": "u4 wide", "category": "alias"}, {"type_id": "bool"}]},
        "mappings": {"mappings": [{"instruction_name": "add", "field_name": " OPCODE ", "data_type_ref": "BOOL"}, {"instruction_name": "add", "field_name": "SRC", "data_type_ref": "nope"}, {"instruction_name": " ", "field_name": "X"}]},
        "domains": {"domains": [{"instruction_name": "add", "field_name": "OPCODE", "allowed_values_or_range": "0..3"}, {"instruction_name": "add", "field_name": "SRC", "allowed_value_form": "enum", "allowed_values_or_range": "A|B"}]},
        "constraints": {"constraints": [{"constraint_category_candidate": "Range limit", "constraint_content": "OPCODE < 3", "field_name": "OPCODE"}, {"constraint_category_candidate": "range-limit", "constraint_content": "x"}]},
        "categories": {"mapping": {"Range limit": "range"}},
        "bindings": {"bindings": [{"node_id": " Field:SRC ", "property": "value", "value": 7, "source_page": "2"}, {"node_id": ""}]},
    }
    return "```json\n" + json.dumps(answers[system]) + "\n```"


def _run(spark, tmp=None, **kw):
    b = blocks(spark, [(1, "p1_b0", "text", (0, 0, 1, 1), "ADD (0x2A) runs on EU0"), (1, "p1_b1", "table", (0, 2, 1, 3), "Field\tBits\nOPCODE\t31:28\nSRC\t3:0")])
    return run_chain({"page_blocks": b, **kw.pop("tables", {})}, Config(run_id="r", client=client, **kw))


def test_from_pages_to_test_cases(spark):
    truth = {
        "truth_types": spark.createDataFrame([("BOOL",), ("U4_WIDE",), ("MORE",)], "type_id string"),
        "truth_names": spark.createDataFrame([("OPCODE",), ("SRC",)], "field_name string"),
        "truth_edges": spark.createDataFrame([("Instr:42", "HAS_FIELD", "Field:SRC")], "`from` string, rel string, `to` string"),
        "truth_instructions": spark.createDataFrame([(0, "ADD", None, 42)], "pos int, instruction_name string, variation string, opcode_value bigint"),
    }
    t = _run(spark, tables=truth)
    one = t["instruction_catalog"].first()
    assert (one["instruction_name"], one["aliases"], one["opcode_value"]) == ("ADD", ["ADDX"], 42)
    rows = t["instruction_field_map"].orderBy("field_name").collect()
    assert [(r["field_name"], r["stage_run_id"], r["source_refs"][0]["block_id"], r["source_refs"][0]["page"]) for r in rows] == [("OPCODE", "r", "p1_b1", 1), ("SRC", "r", "p1_b1", 1)]
    assert {(r["field_name"], r["data_type_ref"], r["repaired"]) for r in t["field_datatype_catalog"].collect()} == {("OPCODE", "BOOL", False), ("SRC", "BOOL", True)}
    assert {(r["field_name"], r["allowed_value_form"], r["allowed_values_or_range"]) for r in t["field_domain_catalog"].collect()} == {("OPCODE", "range", "0..3"), ("SRC", "enum", "A|B")}
    assert {(r["label"], r["canonical"]) for r in t["category_mapping"].collect()} == {("Range limit", "range"), ("range-limit", "range-limit")}
    assert {r["constraint_type_level1"] for r in t["constraint_registry"].collect()} == {"range", "enum", "range-limit"}
    assert [tuple(r) for r in t["bindings"].collect()] == [("d", "Field:SRC", "value", "7", 2)]
    cases = t["test_cases"].collect()
    assert len(cases) == 8 and {c["constraint_satisfaction_status"] for c in cases} == {"satisfied"}
    assert t["combination_context"].first()["canonical_field_names"] == ["OPCODE", "SRC"]
    gates = {r["gate"]: r["passed"] for r in t["quality_gates"].collect()}
    assert gates["fields_without_domain"] and gates["dangling_edges"] and gates["violated_cases"]
    scores = {r["section"]: (r["tp"], r["fp"], r["fn"]) for r in t["scores_sections"].collect()}
    assert scores["types"] == (2, 0, 1) and scores["edges"][0] == 1 and t["scores_names"].first()["f1"] == 1.0 and t["scores_instructions"].first()["opcode_matches"] == 1


def test_replies_replay_without_a_model(spark):
    asked = []
    def spy(system, user):
        asked.append(system)
        return client(system, user)
    b = blocks(spark, [(1, "p1_b0", "text", (0, 0, 1, 1), "ADD")])
    from pagelode.operators.blocks import prompt_texts

    kept = X.chat_json(prompt_texts(b), "instructions", client).select("reply_key", "reply")
    t = run_stage("instructions", {"page_blocks": b}, Config(run_id="r", replays={"instructions": kept}))
    assert t["instruction_catalog"].first()["instruction_name"] == "ADD" and not asked
    with pytest.raises(ValueError):
        run_stage("nothing", {})


def test_values_that_break_constraints(spark):
    d = spark.createDataFrame([("d", "S", "F", "range", "0..9"), ("d", "S", "G", "enum", "a|b"), ("d", "T", "H", "range", "1..2")], "document_id string, scope string, field_name string, allowed_value_form string, allowed_values_or_range string")
    from pagelode.operators.constraints import constraints_from_domains

    c = constraints_from_domains(spark.createDataFrame([("d", 0, "f", "range", "0..5")], "document_id string, pos int, field_name string, allowed_value_form string, allowed_values_or_range string"))
    v = G.boundary_values(d)
    kept = G.test_cases(v, c).collect()
    assert {r["assignment"].get("F") for r in kept if r["scope"] == "S"} == {"0", "1"} and {r["constraint_satisfaction_status"] for r in kept if r["scope"] == "S"} == {"satisfied"}
    assert {r["constraint_satisfaction_status"] for r in kept if r["scope"] == "T"} == {"assumed_valid"}
    marked = G.test_cases(v, c, prune=False)
    assert {(r["assignment"]["F"], r["constraint_satisfaction_status"]) for r in marked.filter("scope = 'S'").collect()} == {("0", "satisfied"), ("1", "satisfied"), ("8", "violated"), ("9", "violated")}
    wide = G.wide_cases(marked.filter("scope = 'T'"), ["F", "H"]).first()
    assert (wide["F"], wide["H"]) in {("X", "1"), ("X", "2")}


def test_document_passes_in_order(spark):
    """Tags, then tables over page breaks, then headers and footers."""
    rows = [
        (1, "a", "text", (10, 100, 90, 200), "Chapter"), (1, "t1", "table", (10, 700, 90, 780), "A\t1"), (2, "t2", "table", (10, 10, 90, 60), "B\t2"), (2, "f", "text", (10, 760, 90, 780), "foot"),
    ]
    spans = spark.createDataFrame([("d", 1, 0, (10.0, 100.0, 90.0, 200.0), 0, "Chapter", 20.0)], "document_id string, page int, block_no int, block_box struct<x0:double,y0:double,x1:double,y1:double>, span_no int, text string, size double")
    t = run_stage("blocks", {"page_blocks": blocks(spark, rows), "spans": spans}, Config(stitch=True, bottom_margin=0.08))
    got = {r["block_id"]: r["raw_text"] for r in t["page_blocks"].collect()}
    assert got == {"a": "<heading1>Chapter</heading1>", "t1": "A\t1\n\nB\t2"}


def test_stitching_goes_on_until_nothing_is_left(spark):
    rows = [(p, f"t{p}", "table", (0, 5, 10, 787), f"r{p}") for p in range(1, 14)]
    b = blocks(spark, rows)
    out = L.stitch_tables(b, b.select("document_id", "page").distinct().withColumn("height", F.lit(792.0))).collect()
    assert sum(len(r["multi_page_bboxes"] or [1]) for r in out) == 13 and {x for r in out for x in r["raw_text"].split()} == {f"r{p}" for p in range(1, 14)}
    assert {r["block_id"] for r in out} < {f"t{p}" for p in range(1, 14)}


def test_sizes_without_meaning_are_no_tiers(spark):
    sp = spark.createDataFrame([("d", 12.0), ("d", 9.9), ("d", 0.0), ("d", -3.0), ("d", 10.3), ("d", None)], "document_id string, size double")
    assert {r["tier"] for r in L.size_tiers(sp).collect()} == {12.0, 10.0, 10.5}
    got = {r["size"]: r["role"] for r in L.span_roles(sp).collect()}
    assert got[0.0] == "heading3" and got[10.3] == "heading2" and got[None] == "heading2"
    assert L.span_roles(sp.filter("size <= 0")).first()["role"] == "body"


def test_engines_of_any_kind(spark):
    assert X.recognized_text([[[0, 0], ("one", 0.9)], [[0, 1], ("two", 0.8)]]) == "one\ntwo"
    assert X.recognized_text({"rec_texts": ["a", " ", "b"]}) == "a\nb" and X.recognized_text(None) == "" and X.recognized_text(7) == ""
    im = spark.createDataFrame([(bytearray(b"x"), (0.0, 1.0, 2.0, 3.0)), (bytearray(b"!"), None)], "image binary, box struct<x0:double,y0:double,x1:double,y1:double>")
    def engine(data, box, dpi):
        if data == b"!":
            raise RuntimeError("broken")
        return [f"{box[3]:.0f}", str(dpi)]
    assert sorted(r["raw_text"] for r in X.read_optically(im, engine, region="box", dpi=300).collect()) == ["", "3\n300"]
    det = spark.createDataFrame([("d", 1, (0.0, 0.0, 9.0, 10.0), "a", None), ("d", 1, (0.0, 10.0, 9.0, 20.0), " ", "clip"), ("d", 1, (0.0, 40.0, 9.0, 50.0), None, None)], "document_id string, page int, bbox struct<x0:double,y0:double,x1:double,y1:double>, raw_text string, clip_text string")
    assert [(r["raw_text"], r["extraction_method"]) for r in L.table_blocks(det, ["document_id", "page"]).orderBy("cluster").collect()] == [("a\nclip", "table_merged"), ("", "table_detected")]


def test_modes_of_retrieval(spark):
    b = blocks(spark, [(1, f"p1_b{i}", "text", (0, i, 1, i + 1), t) for i, t in enumerate(["red fox", "blue fox", "green", " "])])
    embed = lambda texts: [[float("red" in t), float("fox" in t), 0.1] for t in texts]
    first = lambda mode, q: [r["block_id"] for r in V.retrieve(b, V.RetrievalConfig(True, 2, q, mode), embed).orderBy("rank").collect()]
    assert first("vector", "red fox") == ["p1_b0", "p1_b1"] and first("keyword", "BLUE fox") == ["p1_b1", "p1_b0"] and first("keyword", "none") == []
    assert set(first("hybrid", "red fox")) == {"p1_b0", "p1_b1"}
    with pytest.raises(ValueError):
        V.retrieve(b, V.RetrievalConfig(True, 2, "x", "other"), embed)
    t = _run(spark, retrieval=V.RetrievalConfig(True, 5, "EU0", "keyword"), embedder=embed)
    assert t["instruction_catalog"].count() == 1
    assert [r["block_id"] for r in V.with_neighbours(b.filter("block_id = 'p1_b0'"), b).orderBy("block_id").collect()] == ["p1_b0", "p1_b1"]


def test_rows_from_ground_truth(spark):
    names = spark.createDataFrame([("B",), ("A",), ("B",)], "field_name string")
    assert tuple(global_schema_from_truth(names).first()) == (["A", "B"], 2)
    typed = typed_from_truth({"types": spark.createDataFrame([(3, "U4")], "pos int, type_id string")})
    assert (typed["types"].first()["trace_id"], typed["types"].first()["source_refs"]) == ("run:reg:3", [])
    assert graph_from_truth({"constraints": spark.createDataFrame([(1, "C")], "pos int, constraint_id string")})["constraints"].first()["trace_id"] == "run:c:1"


def test_command_line(spark, tmp_path):
    from pagelode.plans.run import main

    b = blocks(spark, [(1, "p1_b1", "table", (0, 2, 1, 3), "Field\tBits\nOPCODE\t31:28\nSRC\t3:0")])
    b.write.parquet(str(tmp_path / "in" / "page_blocks.parquet"))
    cat = spark.createDataFrame([("t", "d", 0, "CONV", None, "0x2A", 42, "EU0", [(1,)])], "trace_id string, document_id string, pos bigint, instruction_name string, variation string, opcode_raw string, opcode_value bigint, execution_unit string, source_refs array<struct<page:int>>")
    cat.write.parquet(str(tmp_path / "in" / "instruction_catalog.parquet"))
    main(["--tables", str(tmp_path / "in"), "--out", str(tmp_path / "out")])
    assert spark.read.parquet(str(tmp_path / "out" / "chain" / "edges.parquet")).count() == 8
    assert spark.read.option("header", True).csv(str(tmp_path / "out" / "chain" / "test_cases.csv")).count() == 16
    main(["--tables", str(tmp_path / "in"), "--out", str(tmp_path / "out"), "--stage", "fields"])
    assert spark.read.parquet(str(tmp_path / "out" / "fields" / "instruction_field_map.parquet")).count() == 2
