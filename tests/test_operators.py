"""Relational operators on small tables, against values worked out by hand or by a plain loop."""

import random

import pytest
from pyspark.sql import functions as F

from pagelode.operators import blocks as B
from pagelode.operators import catalog as C
from pagelode.operators import constraints as K
from pagelode.operators import evaluate as E
from pagelode.operators import external as X
from pagelode.operators import fields as D
from pagelode.operators import glossary as G
from pagelode.operators import graph as R
from pagelode.operators import layout as L
from pagelode.operators import retrieval as V
from pagelode.operators.contracts import gate_report, violations
from pagelode.operators.selection import Blocks, Pages, parse_selection, select_blocks
from pagelode.plans.pipeline import Config, run_chain

BLOCK = "trace_id string, document_id string, page int, block_id string, block_type string, bbox struct<x0:double,y0:double,x1:double,y1:double>, raw_text string, extraction_method string"


def blocks(spark, rows):
    """rows: (page, block_id, type, (x0, y0, x1, y1), text)"""
    return spark.createDataFrame([(f"t{i:03d}", "d", p, b, k, tuple(map(float, box)), t, "text_layer") for i, (p, b, k, box, t) in enumerate(rows)], BLOCK)


def _cat(spark, rows):
    return spark.createDataFrame([("d", *r) for r in rows], "document_id string, pos bigint, instruction_name string, variation string, source_refs array<struct<page:int>>")


def test_page_ranges():
    assert [B.resolve_page_range(10, *a) for a in ((None, None), (3, None), (None, 4), (0, 99))] == [(1, 10), (3, 10), (1, 4), (1, 10)]
    for a in ((7, 3),):
        with pytest.raises(ValueError):
            B.resolve_page_range(10, *a)


def test_budget_is_a_prefix(spark):
    rows = [(p, f"p{p}_b{i}", "text", (0, i, 1, i + 1), "x" * n) for p, i, n in ((1, 10, 5), (1, 2, 7), (2, 0, 0), (2, 1, 400), (3, 0, 1))]
    df = blocks(spark, rows)
    order = sorted(rows, key=lambda r: (r[0], r[1]))
    for budget in (10, 60, 120, 5000):
        used, want = 0, []
        for r in order:
            piece = f"--- page={r[0]} block_id={r[1]} type=text ---\n{r[4]}" if r[4] else ""
            used += len(piece) + 1 if piece else 0
            if piece and used > budget:
                break
            want += [r[1]] if piece else []
        assert sorted(r["block_id"] for r in B.within_budget(df, budget).collect()) == sorted(want)
    assert B.prompt_texts(df, 10).first()["prompt"] == "(no text blocks)"
    text = B.prompt_texts(df, 5000).first()["prompt"]
    assert text.index("p1_b10") < text.index("p1_b2")  # ids are strings


def test_margins_repeats_and_tables(spark):
    df = blocks(spark, [(p, f"h{p}", "text", (0, 5, 9, 10), f"Page {p} of 9") for p in range(1, 4)] + [(1, "a", "text", (0, 100, 9, 120), "body"), (1, "i", "image", (0, 1, 9, 9), "")])
    assert {r["block_id"] for r in B.drop_margins(df, F.lit(800.0), 0.08, 0.08).collect()} == {"a", "i"}
    assert B.drop_margins(df, F.lit(None).cast("double")).count() == 5
    assert {r["block_id"] for r in B.drop_repeated(df, 3, 40).collect()} == {"a", "i"}
    assert B.drop_repeated(df, 4, 40).count() == 5
    t = blocks(spark, [(1, "t", "table", (0, 0, 100, 100), ""), (1, "in", "text", (10, 10, 50, 50), "x"), (1, "out", "text", (90, 90, 300, 300), "x"), (2, "other", "text", (10, 10, 50, 50), "x")])
    assert {r["block_id"] for r in B.drop_text_in_tables(t).collect()} == {"t", "out", "other"}
    assert {r["block_id"] for r in B.number_blocks(t).filter("page = 1").collect()} == {"p1_b0", "p1_b1", "p1_b2"}


def test_chunks_and_supplement(spark):
    docs = spark.createDataFrame([("d", "x" * 13), ("e", "  "), ("f", "y" * 6)], "document_id string, text string")
    got = sorted((r["document_id"], r["chunk_no"], len(r["text"])) for r in B.corpus_chunks(docs, 6).collect())
    assert got == [("d", 0, 6), ("d", 1, 6), ("d", 2, 1), ("f", 0, 6)]
    more = B.add_supplement(blocks(spark, [(1, "a", "text", (0, 0, 1, 1), "t")]), B.corpus_chunks(docs, 6))
    assert sorted(r["block_id"] for r in more.filter("document_id = 'd'").collect()) == ["a", "supp_1", "supp_2", "supp_3"]
    assert {r["document_id"]: r["total_pages"] for r in B.total_pages(more).collect()} == {"d": 1, "f": 1}


def test_selection(spark):
    assert parse_selection("p1, 2-3 ,p1_20, p1_10-p2_20") == [Pages(1, 1), Pages(2, 3), Blocks("p1_b20", "p1_b20"), Blocks("p1_b10", "p2_b20")]
    assert parse_selection("페이지 3, 4쪽") == [Pages(3, 3), Pages(4, 4)]
    for bad in ("", "x1", "p1_", ","):
        with pytest.raises(ValueError):
            parse_selection(bad)
    df = blocks(spark, [(p, f"p{p}_b{i}", "text", (0, i * 10, 1, i * 10 + 5), "" if (p, i) == (2, 0) else "t") for p in (1, 2, 3) for i in range(3)])
    got = lambda s: [r["block_id"] for r in select_blocks(df, s).orderBy("read_pos").collect()]
    assert got("p2_1-p1_2, 3") == ["p1_b2", "p2_b1", "p3_b0", "p3_b1", "p3_b2"]
    for bad in ("p9_1", "p2_0"):
        with pytest.raises(ValueError):
            select_blocks(df, bad)


def test_interval_islands_against_a_loop(spark):
    rnd = random.Random(8)
    rows = [(g, (0.0, float(a), 1.0, float(a + rnd.randrange(0, 6)))) for g in range(20) for a in (rnd.randrange(0, 60) for _ in range(rnd.randrange(1, 12)))]
    want = []
    for g in range(20):
        out = []
        for y0, y1 in sorted((b[1], b[3]) for k, b in rows if k == g):
            if out and y0 <= out[-1][1]:
                out[-1][1], out[-1][2] = max(out[-1][1], y1), out[-1][2] + 1
            else:
                out.append([y0, y1, 1])
        want += [(g, *o) for o in out]
    df = spark.createDataFrame(rows, "g int, bbox struct<x0:double,y0:double,x1:double,y1:double>")
    got = [(r["g"], r["bbox"]["y0"], r["bbox"]["y1"], r["n_boxes"]) for r in L.merge_boxes(df, ["g"]).collect()]
    assert sorted(got) == sorted(want)
    near = spark.createDataFrame([(1, "a", (0.0, 0.0, 10.0, 10.0)), (1, "b", (0.0, 14.0, 10.0, 20.0)), (1, "c", (0.0, 24.0, 10.0, 30.0)), (1, "x", (50.0, 12.0, 60.0, 18.0))], "p int, id string, bbox struct<x0:double,y0:double,x1:double,y1:double>")
    assert {r["id"]: r["cluster"] for r in L.cluster_adjacent(near, ["p"], "id").collect()} == {"a": "a", "b": "a", "c": "a", "x": "x"}


def test_stitching_pairs_up(spark):
    rows = [(p, f"t{p}", "table", (0.0, 10.0, 100.0, 790.0), f"r{p}") for p in range(1, 6)]
    df, h = blocks(spark, rows), spark.createDataFrame([("d", p, 800.0) for p in range(1, 6)], "document_id string, page int, height double")
    links = {(r["upper"], r["lower"]): r["take"] for r in L.stitch_links(df, h).collect()}
    assert links == {("t1", "t2"): True, ("t2", "t3"): False, ("t3", "t4"): True, ("t4", "t5"): False}
    out = {r["block_id"]: r for r in L.stitch_tables(df, h).collect()}
    assert set(out) == {"t1", "t3", "t5"} and out["t1"]["raw_text"] == "r1\n\nr2" and [x["page"] for x in out["t3"]["multi_page_bboxes"]] == [3, 4]
    assert out["t1"]["extraction_method"] == "text_layer+cross_page_merge"


def test_headings_and_scripts(spark):
    spans = spark.createDataFrame([("d", 1, 0, (0.0, 0.0, 9.0, 9.0), i, f"s{i}&", s) for i, s in enumerate((24.0, 12.0, 12.1, 9.0))], "document_id string, page int, block_no int, block_box struct<x0:double,y0:double,x1:double,y1:double>, span_no int, text string, size double")
    assert {r["tier"]: r["role"] for r in L.size_tiers(spans).collect()} == {24.0: "heading1", 12.0: "heading2", 9.0: "heading3"}
    b = blocks(spark, [(1, "a", "text", (1.0, 0.0, 9.0, 11.0), "")])
    assert L.tag_headings(b, spans).first()["tagged"].startswith("<heading1>s0&amp;</heading1><heading2>s1&amp;</heading2>")
    line = [("b", 0, 0, "x", 10.0, 0, (0.0, 0.0, 5.0, 10.0)), ("b", 0, 1, "2", 6.0, 0, (5.0, -3.0, 8.0, 3.0)), ("b", 0, 2, "i", 6.0, 0, (8.0, 7.0, 9.0, 13.0)), ("b", 1, 0, "f", 6.0, 1, (0.0, 20.0, 5.0, 30.0))]
    s = spark.createDataFrame(line, "block string, line_no int, span_no int, text string, size double, flags int, bbox struct<x0:double,y0:double,x1:double,y1:double>")
    assert L.script_text(s, ["block"]).first()["text"] == "x<sup>2</sup><sub>i</sub>\n<sup>f</sup>"


def test_fields_band_join_and_coverage(spark):
    b = blocks(spark, [(4, "b4", "table", (0, 0, 1, 1), "Field\tBits\tWord\nA\t31:28\t2\nB\t7\t-"), (6, "b6", "text", (0, 0, 1, 1), "SRC 3:0 of 9\nnone"), (7, "b7", "table", (0, 0, 1, 1), "Field\tDesc\nA\t7:0"), (8, "b8", "text", (0, 0, 1, 1), "")])
    got = [(r["block_id"], r["field_name"], r["bit_range"], r["word_index"], round(r["row_confidence"], 4)) for r in D.parsed_fields(b).orderBy("block_id", "field_idx").collect()]
    assert got == [("b4", "A", "31:28", 2, 0.78), ("b4", "B", "7", 0, 0.78), ("b6", "SRC", "3:0", 0, 0.357), ("b7", "A", "7:0", 0, 0.62)]
    cat = _cat(spark, [(0, "first", None, []), (1, "Add", "v", [(5,)])])
    c = {r["page"]: (r["instruction_name"], r["n_candidates"], r["fallback"]) for r in D.candidates_for_pages(b, cat).collect()}
    assert c == {4: ("Add", 1, False), 6: ("Add", 1, False), 7: ("first", 0, True), 8: ("first", 0, True)}
    m = D.field_map(b, cat)
    rows = {(r["block_id"], r["field_name"]): (r["instruction_name"], r["confidence_score"], r["uncertain"]) for r in m.collect()}
    assert rows[("b4", "A")] == ("ADD", 0.78, False) and rows[("b6", "SRC")] == ("ADD", 0.55, True) and rows[("b7", "A")] == ("FIRST", 0.495, True)
    cov = {r["scope"]: r["status"] for r in D.scope_coverage(m.filter("block_id = 'b4'"), cat).collect()}
    assert cov == {"ADD|V": "fully_confident", "FIRST": "missing"}
    pc = {r["page"]: (r["binary"], r["instruction_count"]) for r in D.page_coverage(cat.withColumn("confidence_score", F.lit(0.5)), 4, 6).collect()}
    assert pc == {4: (0, 0), 5: (1, 1), 6: (0, 0)}
    with pytest.raises(ValueError):
        D.page_coverage(cat, 3, 2)


def test_overrides(spark):
    cat = _cat(spark, [(0, "A", None, [(3,)]), (1, "A", "v", []), (2, "B", None, []), (3, "C", None, []), (4, "E", None, [])])
    rows = spark.createDataFrame([("d", n, v, "OLD", "1:0") for n, v in (("A", None), ("A", "v"), ("B", None), ("Z", None))], "document_id string, instruction_name string, variation string, field_name string, bit_range string")
    sheet = spark.createDataFrame([("A", [("N", "3:0", 1), ("bad", "", 0)]), ("B", []), ("C", None)], "scope string, fields array<struct<field_name:string,bit_range:string,word_index:int>>")
    out, warn = D.apply_overrides(rows, cat, sheet)
    got = sorted((r["instruction_name"], r["variation"] or "", r["field_name"], r["page"]) for r in out.collect())
    assert got == [("A", "", "N", 3), ("A", "V", "N", 1), ("B", "", "OLD", None), ("Z", "", "OLD", None)]
    assert {(r["scope"], r["warning"]) for r in warn.collect()} == {("A|V", "variation_fallback"), ("B", "empty_fields"), ("C", "invalid_entry"), ("C", "missing_rows"), ("E", "missing")}


def test_fold_against_a_loop(spark):
    rnd = random.Random(9)
    rows = [(k, i, rnd.choice([0.5, 0.505, 0.509, 0.511, rnd.random()])) for k in range(25) for i in range(rnd.randrange(1, 15))]
    want = {}
    for k, i, c in sorted(rows):
        if k not in want or c > want[k][1] + 0.01:
            want[k] = (i, c)
    df = spark.createDataFrame(rows, "k int, pos int, conf double")
    assert {r["k"]: (r["pos"], r["conf"]) for r in C.fold_by_confidence(df, ["k"], "pos", "conf").collect()} == want


def test_catalogs(spark):
    items = spark.createDataFrame([("d", 0, " add ", None, "0x10", "EU", "MICRO", "x", "0.5", "7"), ("d", 1, "ADD", "", "16", "EU", "", None, "0.505", "z"), ("d", 2, "x" * 65, None, None, None, None, None, None, None)], "document_id string, pos int, instruction_name string, variation string, opcode_raw string, execution_unit string, instruction_kind string, instruction_kind_confidence string, confidence_score string, source_page string")
    r = C.instruction_catalog(items).collect()
    assert len(r) == 1 and (r[0]["instruction_name"], r[0]["opcode_value"], r[0]["opcode_radix"], r[0]["instruction_kind"], r[0]["confidence_score"], r[0]["source_refs"][0]["page"]) == ("ADD", 16, "hex", "micro", 0.5, 7)
    m = spark.createDataFrame([("a",), ("X",), (None,)], "data_type_ref string")
    reg = spark.createDataFrame([("b",), ("a",)], "type_id string")
    assert sorted((r["data_type_ref"], r["repaired"]) for r in C.repair_types(m, reg).collect()) == [("a", False), ("a", True), ("a", True)]
    assert {r["data_type_ref"] for r in C.repair_types(m, reg.filter("false")).collect()} == {"UNKNOWN"}
    f = spark.createDataFrame([("A", None, "f", "3:0")], "instruction_name string, variation string, field_name string, bit_range string")
    assert [tuple(r) for r in C.inferred_registry(f).collect()] == [("uint4", "0..15", "software_primitive")] == [tuple(r) for r in C.inferred_registry(f.filter("false")).collect()]
    n = spark.createDataFrame([(f"{a}{b}",) for a in "xyz" for b in range(7)], "k string")
    assert [r["n"] for r in C.numbered_by(n, "k").orderBy("k").collect()] == list(range(21))
    truth = spark.createDataFrame([(0, "a", None, None, 42, None, None), (1, "A", " ", "UNKNOWN", 43, "EU0", "micro")], "pos int, instruction_name string, variation string, opcode_raw string, opcode_value bigint, execution_unit string, instruction_kind string")
    r = C.catalog_from_truth(truth).collect()
    assert len(r) == 1 and (r[0]["opcode_raw"], r[0]["opcode_value"], r[0]["opcode_radix"], r[0]["execution_unit"]) == ("0x2b", 43, "hex", "EU0")


def test_constraints(spark):
    d = spark.createDataFrame([("SRC", "range", "0..15", 0), ("x y", "enum", "A|B", 12345)], "field_name string, allowed_value_form string, allowed_values_or_range string, pos bigint")
    got = sorted((r["constraint_id"], r["expression"]) for r in K.constraints_from_domains(d).collect())
    assert got == [("C_SRC_0000", "0 <= SRC <= 15"), ("C_X_Y_12345", "x y IN (A, B)")]
    assert K.constraints_from_domains(d.filter("false")).first()["constraint_id"] == "C_PLACEHOLDER_001"
    it = spark.createDataFrame([(0, "a b", "c", "v", None, "I", "3"), (1, None, None, "v", "f", "I", None), (2, "m", "", "v", None, None, "x")], "pos int, constraint_category_candidate string, constraint_content string, verbatim_sentence string, field_name string, instruction_name string, source_page string")
    mp = spark.createDataFrame([("m", "canon x")], "label string, canonical string")
    got = [(r["constraint_id"], r["constraint_type_level1"], r["expression"], r["applies_to"]["entity_type"], r["page"]) for r in K.constraints_from_items(it, mp, start=5).orderBy("constraint_id").collect()]
    assert got == [("C_LLM_0005", "a_b", "c", "Instruction", 3), ("C_LLM_0006", "unknown", "v", "Field", 1), ("C_LLM_0007", "canon_x", "v", "Document", 1)]
    assert {r["label"]: r["canonical"] for r in K.complete_mapping(K.category_labels(it), mp).collect()} == {"a b": "a b", "unknown": "unknown", "m": "canon x"}


def test_evaluators(spark):
    k = lambda *v: spark.createDataFrame([(x,) for x in v], "k string")
    row = lambda p, t: tuple(E.evaluate(p, t, ["k"]).first())
    assert row(k("a", "b", None, "a"), k("b", None, "c")) == (2, 1, 1, 0.666667, 0.666667, 0.666667)
    assert row(k(), k()) == (0, 0, 0, 1.0, 1.0, 1.0) and row(k(), k("a", "b")) == (0, 0, 2, 0.0, 0.0, 0.0) and row(k("a"), k()) == (0, 1, 0, 0.0, 1.0, 0.0)
    f = "instruction_name string, variation string, field_name string, bit_range string"
    t = spark.createDataFrame([("MUL", None, "SRC1", None), ("ADD", None, "OP", "31:26")], f)
    p = spark.createDataFrame([("mul", "", "src1", ""), ("ADD", None, "OP", "31 : 26")], f)
    assert tuple(E.evaluate_field_map(p, t).first())[:3] == (2, 0, 0)
    i = "instruction_name string, variation string, opcode_value bigint, pos int"
    e = E.evaluate_instructions(spark.createDataFrame([("A", None, 1, 0), ("a", "", 2, 1)], i), spark.createDataFrame([("A", None, 2, 0), ("A", None, 1, 1), ("B", None, 3, 2)], i)).first()
    assert (e["tp"], e["fn"], e["opcode_defined"], e["opcode_matches"], e["opcode_recall"]) == (1, 1, 1, 1, 1.0)


def test_golden_chain(spark):
    """Two blocks to 8 nodes and 8 edges."""
    b = blocks(spark, [(1, "p1_b0", "text", (0, 0, 1, 1), "CONV (0x2A) runs on EU0"), (1, "p1_b1", "table", (0, 2, 1, 3), "Field\tBits\nOPCODE\t31:28\nSRC\t3:0")])
    cat = spark.createDataFrame([("d", 0, "CONV", None, "0x2A", 42, "EU0", [])], "document_id string, pos bigint, instruction_name string, variation string, opcode_raw string, opcode_value bigint, execution_unit string, source_refs array<struct<page:int>>")
    t = run_chain({"page_blocks": b, "instruction_catalog": cat}, Config(run_id="r"))
    rows = {(r["instruction_name"], r["field_name"], r["bit_range"]): (r["confidence_score"], r["uncertain"]) for r in t["instruction_field_map"].collect()}
    assert rows == {("CONV", "OPCODE", "31:28"): (0.495, True), ("CONV", "SRC", "3:0"): (0.495, True)}
    assert {r["expression"] for r in t["constraint_registry"].collect()} == {"0 <= OPCODE <= 15", "0 <= SRC <= 15"}
    nodes = {r["id"] for r in t["nodes"].collect()}
    assert nodes == {"Constraint:C_OPCODE_0000", "Constraint:C_SRC_0001", "DT:uint4", "EU:EU0", "Field:OPCODE", "Field:SRC", "IP:sample", "Instr:42"}
    edges = sorted(r["rel"] for r in t["edges"].collect())
    assert edges == ["APPLIES_TO"] * 2 + ["EXECUTES_ON"] + ["HAS_DATATYPE"] * 2 + ["HAS_FIELD"] * 2 + ["HAS_INSTRUCTION"]
    assert R.dangling_edges(t["nodes"], t["edges"]).count() == 0 and R.sound_edges(t["nodes"], t["edges"]).count() == 8


def test_graph_integrity(spark):
    n = spark.createDataFrame([("a", "X", 0), ("a", "Y", 1), ("b", "X", 2)], "id string, type string, pos int")
    e = spark.createDataFrame([("a", "r", "b"), ("a", "r", "c"), ("q", "r", "b")], "`from` string, rel string, `to` string")
    assert {tuple(r) for r in R.dangling_edges(n, e).collect()} == {("a", "r", "c", False, True), ("q", "r", "b", True, False)}
    vn, ve = R.viewer_graph(n, e, 2)
    assert {tuple(r) for r in vn.collect()} == {("a", "X"), ("b", "X"), ("c", "Unknown")} and ve.count() == 2


def test_retrieval(spark):
    rnd = random.Random(11)
    vecs = [(i, [rnd.uniform(-1, 1) for _ in range(8)]) for i in range(60)] + [(60, [0.0] * 8)]
    df = spark.createDataFrame(vecs, "vec_id bigint, embedding array<double>")
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    want = lambda q: [i for i, _ in sorted(vecs, key=lambda v: (-dot(v[1], q), v[0]))[:7]]
    assert [r["vec_id"] for r in V.top_k(df, vecs[3][1], 7).collect()] == want(vecs[3][1])
    q = df.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    got = {}
    for r in V.top_k_many(df, q, 7, query_block=2).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert got == {i: want(vecs[i][1]) for i in (0, 20, 40, 60)}
    assert df.select(V.normalized("embedding").alias("n")).filter("size(n) = 8").count() == 61
    b = blocks(spark, [(1, "a", "text", (0, 0, 1, 1), "x"), (1, "b", "text", (0, 0, 1, 1), "y")])
    hit = spark.createDataFrame([("a",)], "block_id string")
    cases = [(lambda: hit, True, 1, "ok"), (lambda: hit.filter("false"), True, 2, "no_hits"), (lambda: 1 / 0, True, 2, "error"), (lambda: hit, False, 2, "disabled"), (lambda: spark.createDataFrame([("z",)], "block_id string"), True, 2, "no_matching_blocks")]
    for hits, on, n, why in cases:
        kept, stats = V.narrow_blocks(b, hits, on)
        assert (kept.count(), stats["reason"]) == (n, why)
    e = V.embed(spark.createDataFrame([("ab",), (None,)], "text string"), lambda ts: [[len(t), 0.0] for t in ts], batch=1)
    assert sorted(r["vec"][0] for r in e.collect()) == [0.0, 1.0]


def test_chat_replay(spark):
    p = spark.createDataFrame([("d", "one"), ("e", "two")], "document_id string, prompt string")
    reply = lambda s, u: '```json\n{"items": [{"a": "%s"}, {"a": null}]}\n```' % u if u == "one" else 1 / 0
    first = X.chat_json(p, "sys", reply)
    rows = {r["document_id"]: r["reply"] for r in first.collect()}
    assert '"one"' in rows["d"] and "error" in rows["e"]
    again = X.chat_json(p, "sys", None, first.select("reply_key", "reply"))
    assert {r["document_id"]: r["reply"] for r in again.collect()} == rows
    assert [(r["pos"], r["a"]) for r in X.reply_items(again, "items", "a:string").orderBy("pos").collect()] == [(0, "one"), (1, None)]
    assert X.json_object("[1]") == "{}" and X.json_object(None) == "{}" and X.json_object("{") == "{}"


def test_contracts(spark):
    df = spark.createDataFrame([("1", "A", "0x1", "EU", "odd", 2.0), ("2", " ", "0x1", "EU", "hex", 0.5)], "trace_id string, instruction_name string, opcode_raw string, execution_unit string, opcode_radix string, confidence_score double")
    v = violations(df, "instruction_catalog")
    assert {tuple(r) for r in v.collect()} == {("1", "choice", "opcode_radix"), ("1", "bounds", "confidence_score"), ("2", "required", "instruction_name")}
    assert gate_report({"c": v}).count() == 3


def test_glossary(spark):
    t = spark.createDataFrame([("Tile", "long text"), ("tile", "short"), ("Tile", None), (" ", "x")], "name string, definition string")
    assert [tuple(r) for r in G.merge_terms(t).collect()] == [("tile", "Tile", 3, "short")]
    a = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("x", "y"), ("y", "x"), ("q", "a"), ("k", "y"), ("g", "k")], "alias string, target string")
    assert {r["alias"]: r["target"] for r in G.flatten_aliases(a).collect()} == {"a": "d", "b": "d", "c": "d", "q": "d", "x": "x", "y": "x", "k": "x", "g": "x"}
    long = spark.range(300).selectExpr("string(id) AS alias", "string(id + 1) AS target")
    assert {r["target"] for r in G.flatten_aliases(long).collect()} == {"300"}
    names, known = spark.createDataFrame([("SHIFT_AMT",), ("zzz",)], "name string"), spark.createDataFrame([("SHIFTAMT1",), ("OTHER",)], "name string")
    assert [tuple(r) for r in G.match_aliases(names, known).collect()] == [("SHIFT_AMT", "SHIFTAMT1", 1)]
    d = spark.createDataFrame([("d", "S", "F", "range", "0..15"), ("d", "S", "G", "enum", "A|B")], "document_id string, scope string, field_name string, allowed_value_form string, allowed_values_or_range string")
    m = [r["assignment"] for r in G.combination_matrix(G.boundary_values(d)).collect()]
    assert len(m) == 8 and len({tuple(sorted(x.items())) for x in m}) == 8 and {x["F"] for x in m} == {"0", "1", "14", "15"}
    c = G.overlapping_chunks(spark.createDataFrame([("d", "x" * 25)], "document_id string, text string"), 10).orderBy("chunk_no").collect()
    assert [len(r["text"]) for r in c] == [10, 10, 7]
