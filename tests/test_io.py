"""Sources, sinks and streams over temporary folders."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pagelode.sinks import files as K
from pagelode.sources import files as S
from pagelode.sources.tables import open_index, read_pages, read_table
from pagelode.streaming import blocks as T


def _write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_json_sources(spark, tmp_path):
    p = _write(tmp_path / "a.jsonl", '{"a": 1}\n\n{"a": 2, "b": "x"}\n')
    assert sorted(r["a"] for r in S.read_jsonl(spark, p, "a int, b string").collect()) == [1, 2]
    assert S.read_jsonl(spark, str(tmp_path / "none.jsonl"), "a int").count() == 0
    bad = _write(tmp_path / "bad.jsonl", '{"a": 1}\n{oops\n')
    with pytest.raises(Exception):
        S.read_jsonl(spark, bad, "a int").collect()
    assert [r["a"] for r in S.jsonl_from_bytes(spark, '{"a": 1}\n \n{"a": 2}'.encode() + b'\n', "a int").collect()] == [1, 2]
    o = _write(tmp_path / "o.json", json.dumps({"k": {"x": 1}}, indent=2))
    assert S.read_json(spark, o, "k struct<x:int>").first()["k"]["x"] == 1
    with pytest.raises(Exception):
        S.read_json(spark, str(tmp_path / "none.json"), "k int").collect()
    with pytest.raises(ValueError):
        read_table(spark, o, "csv")


def test_instruction_truth(spark, tmp_path):
    p = _write(tmp_path / "g.txt", "﻿# list\nADD\n\n MUL \n")
    assert [(r["instruction_name"]) for r in S.read_instruction_truth(spark, p).orderBy("pos").collect()] == ["ADD", "MUL"]
    p = _write(tmp_path / "g.json", json.dumps(["ADD", {"mnemonic": "SUB", "opcode_value": 7}, {"name": "X", "variation": "v"}]))
    got = [(r["instruction_name"], r["variation"], r["opcode_value"]) for r in S.read_instruction_truth(spark, p).orderBy("pos").collect()]
    assert got == [("ADD", None, None), ("SUB", None, 7), ("X", "v", None)]
    p = _write(tmp_path / "g.jsonl", '{"instruction_name": "A"}\n# c\n{"name": "B"}\n')
    assert [r["instruction_name"] for r in S.read_instruction_truth(spark, p).orderBy("pos").collect()] == ["A", "B"]


def test_tagged_truth(spark, tmp_path):
    p = _write(tmp_path / "f.txt", "ADD OPCODE 31:26\nMUL SRC1\nRESCALE CW MODE 15:8\nRESCALE CW MODE\nalone\n")
    got = [(r["instruction_name"], r["variation"], r["field_name"], r["bit_range"]) for r in S.read_field_truth(spark, p).orderBy("pos").collect()]
    assert got == [("ADD", None, "OPCODE", "31:26"), ("MUL", None, "SRC1", None), ("RESCALE", "CW", "MODE", "15:8"), ("RESCALE", "CW", "MODE", None)]
    p = _write(tmp_path / "t.txt", "TYPE|uint4|alias\nDTYPE|A|F|uint4\nDTYPE|A|v|F|uint8\nDTYPE|F|uint1\nDOMAIN|F|enum|A,B\nDOMAIN|G|0..3\n")
    t = S.read_typed_truth(spark, p)
    assert [tuple(r)[1:] for r in t["types"].collect()] == [("uint4", "alias")]
    assert [tuple(r)[1:] for r in t["dtypes"].orderBy("pos").collect()] == [("A", None, "F", "uint4"), ("A", "V", "F", "uint8"), ("", None, "F", "uint1")]
    assert [tuple(r)[1:] for r in t["domains"].orderBy("pos").collect()] == [("F", "enum", "A,B"), ("G", "range", "0..3")]
    p = _write(tmp_path / "s.txt", "CONSTRAINT|C1\nNODE|IP:x\nEDGE|a|r|b\nEDGE|short\n")
    g = S.read_graph_truth(spark, p)
    assert (g["constraints"].count(), g["nodes"].count(), [tuple(r)[1:] for r in g["edges"].collect()]) == (1, 1, [("a", "r", "b")])
    p = _write(tmp_path / "n.json", json.dumps({"canonical_field_names": ["A", "b", "A"]}))
    assert sorted(r["field_name"] for r in S.read_name_truth(spark, p).collect()) == ["A", "b"]


def test_sheet_and_graph(spark, tmp_path):
    p = _write(tmp_path / "o.json", json.dumps({"_note": "x", "add": {"fields": [{"field_name": "F", "bit_range": "3:0"}]}, "MUL|v": {}}))
    got = {r["scope"]: r["fields"] for r in S.read_override_sheet(spark, p).collect()}
    assert set(got) == {"ADD", "MUL|V"} and got["ADD"][0]["field_name"] == "F" and got["MUL|V"] is None
    p = _write(tmp_path / "g.json", json.dumps({"nodes": [{"id": "a", "type": "T"}], "edges": [{"from": "a", "rel": "r", "to": "b"}]}))
    n, e = S.read_graph(spark, p)
    assert (n.first()["id"], n.first()["type"], tuple(e.first())) == ("a", "T", ("a", "r", "b"))


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, None, [1, 2])], "a int, b string, c array<int>")
    K.write_jsonl(df, str(tmp_path / "j"))
    line = "".join(x.read_text() for x in (tmp_path / "j").glob("*.json"))
    assert json.loads(line) == {"a": 1, "b": None, "c": [1, 2]}
    assert json.loads(K.report_json(df).first()["report"]) == {"a": 1, "b": None, "c": [1, 2]}
    other = spark.createDataFrame([("x", 2)], "z string, b int")
    rows = K.union_columns([df, other])
    assert rows.columns == ["a", "b", "c", "z"] and {tuple(r) for r in rows.collect()} == {("1", None, "[1,2]", None), (None, "2", None, "x")}
    assert K.write_csv([df, other], str(tmp_path / "c")).first()["row_count"] == 2
    assert sorted(spark.read.option("header", True).csv(str(tmp_path / "c")).columns) == ["a", "b", "c", "z"]
    run = K.StageRun.create("s")
    assert run.stage_run_id.startswith("s-") and run.manifest(spark).count() == 1 and run.path("/x/", "f") == "/x/s/f"
    v = spark.createDataFrame([("d", 0, [1.0, 0.0])], "document_id string, vec_no int, vec array<double>")
    K.write_index(v, str(tmp_path / "i"), "m")
    a, m = open_index(spark, str(tmp_path / "i"))
    assert a.count() == 1 and m.first()["dim"] == 2
    nodes, edges = spark.createDataFrame([("a", "T", "x" * 13_000, 0)], "id string, type string, props string, pos int"), spark.createDataFrame([("a", "r", "a"), ("a", "r", "z")], "`from` string, rel string, `to` string")
    K.write_graph(nodes, edges, str(tmp_path / "g"))
    assert spark.read.parquet(str(tmp_path / "g/edges")).count() == 1 and len(spark.read.parquet(str(tmp_path / "g/nodes")).first()["props"]) == 12_001


def test_markdown_and_pages(spark, tmp_path):
    rows = [("t0", "d", 1, "a", "text", (0.0, 0.0, 1.0, 1.0), "<heading1>T</heading1><body>x</body>"), ("t1", "d", 1, "b", "table", (0.0, 2.0, 1.0, 3.0), "A\tB\n1"), ("t2", "d", 2, "c", "equation", (0.0, 0.0, 1.0, 1.0), "y"), ("t3", "d", 2, "e", "image", (0.0, 2.0, 1.0, 3.0), "")]
    df = spark.createDataFrame(rows, "trace_id string, document_id string, page int, block_id string, block_type string, bbox struct<x0:double,y0:double,x1:double,y1:double>, raw_text string")
    got = [r["markdown"] for r in K.markdown_blocks(df).orderBy("read_pos").collect()]
    assert got == ["<!-- page 1 -->\n\n# T\n\nx\n", "|A|B|\n|---|---|\n|1||\n\n", "\n<!-- page 2 -->\n\n```\ny\n```\n", "```\n[IMAGE BLOCK]\n```\n"]
    K.write_markdown(df, str(tmp_path / "md"))
    K.write_blocks(df, str(tmp_path / "b"))
    pages = read_pages(spark, str(tmp_path / "b"), ["d"], 2, 2)
    assert pages.count() == 2
    plan = pages._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(document_id" in plan.replace("#", "") or "PartitionFilters" in plan
    assert "GreaterThanOrEqual(page,2)" in plan


def test_streams(spark, tmp_path):
    src = str(tmp_path / "in")
    rows = [("a", "d", datetime(2025, 1, 1, 3)), ("a", "d", datetime(2025, 1, 1, 3)), ("b", "d", datetime(2025, 1, 1, 9)), ("c", "e", datetime(2025, 1, 4))]
    df = spark.createDataFrame(rows, "trace_id string, document_id string, loaded_at timestamp")
    df.coalesce(1).write.parquet(src)

    def run(stream, name, mode):
        q = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
        q.awaitTermination(120)
        return spark.table(name)

    s = T.stream_table(spark, src, df.schema)
    assert run(T.first_deliveries(s), "once", "append").count() == 3
    w = run(T.loads_per_window(T.stream_table(spark, src, df.schema)), "win", "complete")
    assert sorted(r["n_rows"] for r in w.collect()) == [1, 3]
    b = spark.createDataFrame([("text", "$x$"), ("text", "plain")], "block_type string, raw_text string")
    assert T.tag_equations_stream(b).filter(F.col("block_type") == "equation").count() == 1
