"""Operators that must not leave out a part of their work."""

from itertools import combinations

from pagelode.operators import fields as D
from pagelode.operators import glossary as G
from pagelode.plans.pipeline import Config, run_chain
from tests.test_operators import BLOCK


def _catalog(spark, rows):
    return spark.createDataFrame(rows, "document_id string, confidence_score double, source_refs array<struct<page:int>>")


def test_coverage_to_the_last_page(spark):
    cat = _catalog(spark, [("a", 0.5, [(50,), (50,)]), ("a", 0.7, [(50,), (2,)]), ("b", None, [(3,)]), ("n", 0.1, None)])
    pages = spark.createDataFrame([("a", 45), ("b", 60), ("c", 2)], "document_id string, total_pages int")
    got = {(r["document_id"], r["page"]): (r["binary"], r["instruction_count"], r["max_confidence"]) for r in D.whole_coverage(cat, pages).collect()}
    cited = {("a", 50): (1, 2, 0.7), ("a", 2): (1, 1, 0.7), ("b", 3): (1, 1, 0.0)}
    assert got == {(d, p): cited.get((d, p), (0, 0, 0.0)) for d, n in (("a", 50), ("b", 60), ("c", 2), ("n", 1)) for p in range(1, n + 1)}


def _two_manuals(spark, **replays):
    """One instruction name with another opcode and other fields in each of two manuals."""
    box = (0.0, 0.0, 1.0, 1.0)
    b = spark.createDataFrame([
        ("t0", "d", 1, "p1_b0", "table", box, "Field\tBits\nOPCODE\t31:28\nSRC\t3:0", "text_layer"), ("t1", "e", 1, "p1_b0", "table", box, "Field\tBits\nOPCODE\t31:28\nDST\t7:0", "text_layer"),
    ], BLOCK)
    cat = spark.createDataFrame([("d", 0, "CONV", None, "1", 1, "EU0", [(1,)]), ("e", 1, "CONV", None, "2", 2, "EU0", [(1,)])], "document_id string, pos bigint, instruction_name string, variation string, opcode_raw string, opcode_value bigint, execution_unit string, source_refs array<struct<page:int>>")
    return run_chain({"page_blocks": b, "instruction_catalog": cat}, Config(run_id="r", replays=replays))


def test_chain_keeps_the_fields_of_each_manual(spark):
    t = _two_manuals(spark)
    got = {(r["from"], r["to"]) for r in t["edges"].filter("rel = 'HAS_FIELD'").collect()}
    assert got == {("Instr:1", "Field:OPCODE"), ("Instr:1", "Field:SRC"), ("Instr:2", "Field:OPCODE"), ("Instr:2", "Field:DST")}


def test_chain_has_a_constraint_for_each_domain_row(spark):
    t = _two_manuals(spark)
    cons = t["constraint_registry"].collect()
    assert sorted((r["document_id"], r["applies_to"]["entity_name"], r["expression"]) for r in cons) == [
        ("d", "OPCODE", "0 <= OPCODE <= 15"), ("d", "SRC", "0 <= SRC <= 15"), ("e", "DST", "0 <= DST <= 255"), ("e", "OPCODE", "0 <= OPCODE <= 15"),
    ]
    assert sorted(r["constraint_id"][-4:] for r in cons) == ["0000", "0001", "0002", "0003"]
    assert t["nodes"].filter("type = 'Constraint'").count() == 4 == t["edges"].filter("rel = 'APPLIES_TO'").count()


def test_combinations_show_every_pair_of_values(spark):
    sizes = {"small": [4, 4, 4, 4, 3], "wide": [4] * 30, "mixed": [2, 9, 6, 1, 4, 7, 3], "two": [40, 30]}
    rows = [("d", s, f"F{i:02d}", "enum", "|".join(f"v{j}" for j in range(n))) for s, ns in sizes.items() for i, n in enumerate(ns)]
    d = spark.createDataFrame(rows, "document_id string, scope string, field_name string, allowed_value_form string, allowed_values_or_range string")
    got = {}
    for r in G.combination_matrix(G.boundary_values(d)).collect():
        got.setdefault(r["scope"], []).append(r["assignment"])
    assert {s: len(m) for s, m in got.items() if s in ("small", "two")} == {"small": 768, "two": 1200}
    for s, ns in sizes.items():
        m = got[s]
        assert len({tuple(sorted(x.items())) for x in m}) == len(m) and all(len(x) == len(ns) for x in m)
        for i, j in combinations(range(len(ns)), 2):
            assert len({(x[f"F{i:02d}"], x[f"F{j:02d}"]) for x in m}) == ns[i] * ns[j], (s, i, j)


def test_combinations_take_no_memory_for_repeated_values(spark):
    """The values of this scope are 4.5 MB; once for each of its 2,209 rows they would be 10 GB, more than these tests have."""
    v = spark.range(40 * 47).selectExpr("'d' AS document_id", "'S' AS scope", "format_string('F%02d', id div 47) AS field_name", "concat(id % 47, repeat('x', 2400)) AS value")
    m = G.combination_matrix(v).selectExpr("size(assignment) AS n", "xxhash64(to_json(assignment)) AS h", "assignment['F00'] AS a", "assignment['F39'] AS b")
    got = m.selectExpr("count(*)", "min(n)", "max(n)", "count(DISTINCT h)", "count(DISTINCT a, b)").first()
    assert tuple(got) == (2209, 40, 40, 2209, 2209)


def test_combinations_are_the_same_in_blocks_of_any_size(spark):
    sizes = {"all": [4, 3, 2], "one": [5], "many": [12, 9, 1], "cover": [7, 6, 4, 7, 3, 5], "digits": [2] * 12}
    rows = [("d", s, f"F{i:02d}", f"v{j}") for s, ns in sizes.items() for i, n in enumerate(ns) for j in range(n)]
    v = spark.createDataFrame(rows, "document_id string, scope string, field_name string, value string")
    got = [sorted((r["scope"], r["combo"], *sorted(r["assignment"].items())) for r in G.combination_matrix(v, 20, b).collect()) for b in (500, 5000, 1 << 24)]
    assert got[0] == got[1] == got[2]
    assert {s: sum(r[0] == s for r in got[0]) for s in ("all", "one", "many")} == {"all": 24, "one": 5, "many": 108} and len({r[0] for r in got[0]}) == 5
