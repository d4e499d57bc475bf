"""Operators around outside engines, and small ones not covered elsewhere."""

import pytest
from pyspark.sql import functions as F

from pagelode.functions import scalars as S
from pagelode.operators import blocks as B
from pagelode.operators import catalog as C
from pagelode.operators import constraints as K
from pagelode.operators import external as X
from pagelode.operators import fields as D
from pagelode.operators import glossary as G
from pagelode.operators import layout as L
from pagelode.operators import retrieval as V
from tests.test_operators import blocks


def test_documents_and_optical_reading(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"one\ntwo")
    read = lambda data, doc: [{"page": i + 1, "block_id": f"p{i + 1}_b0", "bbox": [0.0, 1.0, 2.0, 3.0], "raw_text": t} for i, t in enumerate(data.decode().split("\n"))]
    got = [(r["document_id"], r["page"], r["raw_text"], r["bbox"]["y1"]) for r in X.read_documents(spark, str(tmp_path), read).orderBy("page").collect()]
    assert got == [("a", 1, "one", 3.0), ("a", 2, "two", 3.0)]
    im = spark.createDataFrame([(bytearray(b"xy"),), (None,)], "image binary")
    assert sorted((r["raw_text"], r["confidence_score"]) for r in X.read_optically(im, lambda b: "t" * len(b)).collect()) == [("", 0.0), ("tt", 0.46)]
    assert {r["raw_text"] for r in X.read_optically(im, None).collect()} == {""}
    cells = spark.createDataFrame([(1, 0, 1, "b"), (1, 0, 0, "a"), (1, 1, 0, None), (1, 1, 1, "d")], "t int, row int, col int, text string")
    assert X.table_text(cells, ["t"]).first()["raw_text"] == "a\tb\n\td"


def test_extracted_domains(spark):
    items = spark.createDataFrame([("d", 0, "a", None, " f ", None, " 1..2 ", "x"), ("d", 1, "a", None, " ", "enum", "A", "3")], "document_id string, pos int, instruction_name string, variation string, field_name string, allowed_value_form string, allowed_values_or_range string, source_page string")
    assert [tuple(r) for r in X.normalized_domains(items).collect()] == [("d", 0, "A", None, "f", "range", "1..2", 1)]
    dom = items.select(S.structured_domain("allowed_value_form", "allowed_values_or_range").alias("structured_domain"), F.when(F.col("pos") == 0, "2").otherwise("B").alias("value"))
    assert [r[0] for r in dom.select(K.evaluate_domain()).collect()] == [True, False]


def test_small_ones(spark):
    b = blocks(spark, [(1, "a", "text", (0, 0, 10, 10), "x"), (1, "b", "table", (0, 20, 10, 30), "y")])
    assert tuple(B.page_extent(b).first())[2:] == (0.0, 30.0)
    spans = spark.createDataFrame([("d", 1, (1.0, 1.0, 2.0, 2.0), 30.0)], "document_id string, page int, bbox struct<x0:double,y0:double,x1:double,y1:double>, size double")
    assert {r["block_id"]: r["size"] for r in L.font_sizes(b, spans).collect()} == {"a": 24.0, "b": 11.0}
    assert V.page_hierarchy(V.index_rows(b)).first()["block_ids"] == ["a", "b"]
    hits = spark.createDataFrame([("c", 2, 0.5, 1, "b2", "second"), ("c", 1, 0.9, 1, "b1", "first")], "conv_id string, rank int, score double, page int, block_id string, text_preview string")
    assert V.chat_context(hits).first()["context"].index("first") < V.chat_context(hits).first()["context"].index("second")
    assert [r["rank"] for r in V.ranked_block_ids(hits.unionByName(hits)).orderBy("rank").collect()] == [1, 2]
    cov = spark.createDataFrame([(1, 1, 3, 0.5)], "page int, binary int, instruction_count int, max_confidence double")
    assert V.coverage_metric(cov, "instruction_count").first()["value"] == 3.0
    with pytest.raises(ValueError):
        V.coverage_metric(cov, "nope")
    ev = spark.createDataFrame([("k", 1), ("k", 2)], "key string, at int")
    assert [r["seen"] for r in G.running_counts(ev, "key", "at").orderBy("at").collect()] == [1, 2]
    e = spark.createDataFrame([("a", "r", "b"), ("x", "r", "b")], "`from` string, rel string, `to` string")
    al = spark.createDataFrame([("x", "a")], "alias string, target string")
    assert [tuple(r) for r in G.rewrite_edges(e, al).collect()] == [("a", "r", "b")]
    assert {r["route"] for r in G.route_by_size(spark.createDataFrame([("d", "x" * 9)], "document_id string, text string")).collect()} == {"single"}
    t = spark.createDataFrame([(0, "a", " v ", "f", None), (1, "b", None, "g", "3:0")], "pos int, instruction_name string, variation string, field_name string, bit_range string")
    assert [(r["trace_id"], r["field_name"], r["bit_range"], r["confidence_score"]) for r in C.field_map_from_truth(t).orderBy("trace_id").collect()] == [("run:gt:0", "F", "", 1.0), ("run:gt:1", "G", "3:0", 1.0)]
    assert [r["trace_id"] for r in C.with_trace_ids(t, "r", "x").orderBy("pos").collect()] == ["r:x:0", "r:x:1"]
    assert sorted(r["line"] for r in D.field_lines(t.withColumn("document_id", F.lit("d"))).collect()) == ["A|V|f", "B||g"]
    assert G.top_terms(t.select(F.col("field_name").alias("name"), F.col("bit_range").alias("definition")), 1).count() == 1
