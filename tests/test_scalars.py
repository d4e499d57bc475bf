"""Scalars, with the odd rows a faithful engine has to pin."""

from pyspark.sql import functions as F

from pagelode.functions import scalars as S
from pagelode.functions.text import split_lines, strip


def _eval(spark, rows, schema, **cols):
    df = spark.createDataFrame(rows, schema)
    return [tuple(r) for r in df.select(*(c.alias(n) for n, c in cols.items())).collect()]


def test_keys(spark):
    got = _eval(spark, [("conv", None), (" conv ", "  "), ("conv", " cw ")], "n string, v string", v=S.normalize_variation("v"), s=S.scope_label("n", "v"))
    assert got == [(None, "CONV"), (None, "CONV"), ("CW", "CONV|CW")]


def test_opcode(spark):
    rows = [("0x2A",), ("42",), ("-5",), ("0xZZ",), ("unknown",), ("",), (None,), (" 0X1b3 ",), ("0x" + "f" * 17,), ("0x0",)]
    got = _eval(spark, rows, "r string", v=S.opcode_value("r"), x=S.opcode_radix("r"))
    assert got == [(42, "hex"), (42, "dec"), (-5, "dec"), (None, "unknown"), (None, "unknown"), (None, "unknown"), (None, "unknown"), (435, "hex"), (None, "unknown"), (0, "hex")]


def test_widths_and_domains(spark):
    rows = [("31:28",), ("7",), ("",), ("a:b",), ("3:0",), (None,)]
    assert [r[0] for r in _eval(spark, rows, "b string", w=S.bit_width("b"))] == [4, 1, 4, 4, 4, 4]
    got = _eval(spark, [(0,), (4,), (62,), (63,), (65,)], "w int", t=S.type_id_for_width("w"), d=S.domain_for_width("w"))
    assert got == [("uint4", "0..15"), ("uint4", "0..15"), ("uint62", f"0..{2**62 - 1}"), ("uint63", "0..2^63-1"), ("uint_wide", "0..2^65-1")]


def test_domain_expressions(spark):
    rows = [("range", "0..63"), ("range", "0x0..0xF"), ("range", "1-9"), ("range", "0x0-0xF"), ("range", "[0,15]"), ("enum", "A|B;C"), ("mask", "0xF0"), ("odd", "1..2"), ("set", "")]
    got = [r[0] for r in _eval(spark, rows, "f string, v string", e=S.domain_expression(F.lit("F"), "f", "v"))]
    assert got[:8] == ["0 <= F <= 63", "0x0 <= F <= 0xF", "1 <= F <= 9", "0 <= F <= 0", "F RANGE [0,15]", "F IN (A, B, C)", "F (mask) 0xF0", "1 <= F <= 2"]
    assert got[8] == "F SET (/* unspecified */)"


def test_canonical_interval(spark):
    rows = [("0x0~0xF",), ("[0,15]",), ("15:0",), ("0 to 15",), ("4-bit unsigned",), ("A,B",), (None,)]
    assert [r[0] for r in _eval(spark, rows, "v string", e=S.canonical_interval("v"))] == ["0..15"] * 5 + [None, None]


def test_lines_and_rows(spark):
    got = _eval(spark, [("a\r\nb\nc\x0bd\n",), ("",), ("x",), ("\n",)], "t string", n=split_lines("t"))
    assert [r[0] for r in got] == ["a\r\nb\nc\x0bd\n".splitlines(), [], ["x"], [""]]
    assert _eval(spark, [("  a  ",)], "t string", n=strip("t")) == [("a",)]
    got = _eval(spark, [("a\t\tb",), ("Field  Bits   W",), ("one two",)], "t string", n=S.split_row("t"))
    assert [r[0] for r in got] == [["a", "", "b"], ["Field", "Bits", "W"], ["one two"]]


def test_loose_line(spark):
    rows = [("OPC [31:28]",), ("OPC 31 : 28",), ("Version 2.0",), ("none",)]
    got = [r[0] for r in _eval(spark, rows, "l string", f=S.loose_field("l"))]
    assert got[0] is None and tuple(got[1]) == ("OPC", "31:28", 0.42) and tuple(got[2]) == ("Version", "2", 0.38) and got[3] is None


def test_confidence_and_routing(spark):
    got = _eval(spark, [(1500, 400), (0, 0), (1, 1)], "p int, b int", c=S.text_confidence(F.col("p"), F.col("b")))
    assert [r[0] for r in got] == [1.0, 0.72, round(0.72 + 0.13 / 1500 + 0.15 / 400, 4)]
    assert [r[0] for r in _eval(spark, [(0,), (800,), (5000,)], "n int", c=S.table_confidence(F.col("n")))] == [0.55, 0.98, 0.98]
    assert _eval(spark, [("",), ("x" * 200,), (None,)], "t string", c=S.ocr_confidence("t")) == [(0.0,), (0.9,), (0.0,)]
    got = _eval(spark, [(5, 0, 1, 0), (500, 3, 0, 0)], "c int, t int, i int, b int", r=S.ocr_reasons(F.col("c"), F.col("t"), F.col("i"), F.col("b")))
    assert [len(r[0]) for r in got] == [4, 0]


def test_clamps_and_slugs(spark):
    assert _eval(spark, [("7",), ("x",), (None,), ("-1",), ("NaN",)], "v string", c=S.clamp_unit(F.col("v"), 0.6)) == [(1.0,), (0.6,), (0.6,), (0.0,), (0.6,)]
    assert _eval(spark, [("a b-c",), ("--",), (None,)], "v string", c=S.field_slug("v")) == [("A_B_C",), ("FIELD",), ("FIELD",)]
    assert _eval(spark, [("conv", "cw", 42), ("conv", None, None)], "n string, v string, o bigint", i=S.instruction_node_id("n", "v", "o")) == [("Instr:42_CW",), ("Instr:CONV",)]


def test_segments_spans_and_prompts(spark):
    got = _eval(spark, [("<heading1>A &amp; <sup>b</sup></heading1><body>c</body>",), ("plain",)], "t string", s=S.heading_segments("t"))
    assert [[tuple(x) for x in r[0]] for r in got] == [[("heading1", "A & b"), ("body", "c")], [("body", "plain")]]
    df = spark.sql("SELECT array(named_struct('spans', array(named_struct('text','a'), named_struct('text','b')))) one, array(named_struct('spans', array(named_struct('text','a'), named_struct('text','b'))), named_struct('spans', array(named_struct('text','c')))) two")
    assert tuple(df.select(S.merge_spans(F.col("one")), S.merge_spans(F.col("two"))).first()) == ("a b", "ab\nc")
    got = _eval(spark, [("x",), (" ",)], "t string", p=S.block_prompt(F.lit(3), F.lit("p3_b1"), F.lit("text"), F.col("t")))
    assert got == [("--- page=3 block_id=p3_b1 type=text ---\nx",), ("",)]
