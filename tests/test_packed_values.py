from hypothesis import given, settings
from hypothesis import strategies as st

from pagelode.operators.packed_values import explode_packed, split_packed

CASES = [
    ("0..7", "range", ["0..7"]),
    ("[0, 511]", "range", ["[0, 511]"]),
    ("(0, 7)", " RANGE", ["(0, 7)"]),
    ("[0x21, 0xC6]", "enum", ["0x21", "0xC6"]),
    ("[0,6]; [15,20]", "range", ["[0,6]", "[15,20]"]),
    ("0x0..0x4; 0xD..0x10", "range", ["0x0..0x4", "0xD..0x10"]),
    ("0 to 31", "range", ["0 to 31"]),
    ("A|B;C", "enum", ["A", "B", "C"]),
    ("HIGH|RNE\nNONE", "set", ["HIGH", "RNE", "NONE"]),
    ("A\r\nB", "set", ["A", "B"]),
    ('"BLOCKED,COL_MAJOR"', "enum", ["BLOCKED,COL_MAJOR"]),
    ("'FP16; ROW_MAJOR', X", "set", ["FP16; ROW_MAJOR", "X"]),
    ('{"HIGH"|"say ""INT16"""|"NONE"}', "enum", ["HIGH", 'say "INT16"', "NONE"]),
    ("set(8、27、34)", "enum", ["8", "27", "34"]),
    ("enum {0=OFF, 1=ON}", None, ["0=OFF", "1=ON"]),
    ("0: RDN;;1: ON;2: TILE_A", "enum", ["0: RDN", "1: ON", "2: TILE_A"]),
    ("row major / round toward zero", "enum", ["row major", "round toward zero"]),
    ("“A,B”|C", "enum", ["A,B", "C"]),
    ('["A","B"]', "set", ["A", "B"]),
    ("{ BLOCKED }", "enum", ["BLOCKED"]),
    ("RTZ, ,LINEAR,", "enum", ["RTZ", "LINEAR"]),
    ("a, b", "other", []),
    (None, "enum", []),
    ("  ", "enum", []),
    ('"unclosed, A', "enum", ['"unclosed', "A"]),
    ('"a\\"b", c', "enum", ['a"b', "c"]),
    ('0="OFF, X", 1=ON', "enum", ['0="OFF, X"', "1=ON"]),
]


def test_notations():
    for text, form, want in CASES:
        assert split_packed(text, form) == want, text


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abc,;|\"' ", min_size=1, max_size=8).filter(lambda s: s.strip() == s and s), min_size=1, max_size=6), st.sampled_from([", ", ";", "|", "\n"]))
def test_quoted_values_come_back(values, sep):
    packed = sep.join('"' + v.replace('"', '""') + '"' for v in values)
    assert split_packed(packed, "set") == values


def test_rows_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a,b", "enum", "x"), (2, None, None, "y"), (3, "q" * 20_000 + ";r", "set", "z")], "id int, v string, f string, pos string")
    rows = [tuple(r) for r in explode_packed(df, "v", "f", ["id"]).collect()]
    assert [(r[0], r[1], len(r[2]), r[3]) for r in rows] == [(1, 1, 1, 2), (1, 2, 1, 2), (3, 1, 20_000, 2), (3, 2, 1, 2)]
    assert explode_packed(df.filter("false"), "v", "f", ["id"]).count() == 0
