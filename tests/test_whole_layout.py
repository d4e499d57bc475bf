"""Clusters of any length."""

from pagelode.operators import layout as L


def test_a_long_chain_of_boxes_is_one_cluster(spark):
    rows = [(1, f"b{i:02d}", (0.0, 14.0 * i, 10.0, 14.0 * i + 10)) for i in range(60)] + [(1, "x", (0.0, 2000.0, 10.0, 2010.0))]
    df = spark.createDataFrame(rows, "p int, id string, bbox struct<x0:double,y0:double,x1:double,y1:double>")
    got = {r["id"]: r["cluster"] for r in L.cluster_adjacent(df, ["p"], "id").collect()}
    assert got == {k: "x" if k == "x" else "b00" for _, k, _ in rows}
