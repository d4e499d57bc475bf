"""Survivors by trust alone run no stage that cannot change them."""

import random
from datetime import datetime

import duckdb
import pytest
from pyspark.sql import functions as F

from pagelode.llm import consensus as C
from pagelode.llm import queries as Q
from pagelode.llm.sql import ORACLE

SCHEMA = "trace_id string, document_id string, instruction_name string, variation string, opcode_raw string, confidence_score double, extracted_at timestamp"


def _catalog(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/instruction_catalog.parquet")
    return str(path)


def test_a_record_delivered_in_two_spellings_wins_by_its_trust(spark, tmp_path):
    """The spellings of t1 made up a third one by vote, and t2, which has it, won over the more trusted t1."""
    t = datetime(2025, 1, 1)
    rows = [
        ("t1", "d", "LOAD A12", None, "0x1", 0.9, t), ("t1", "d", "LO AD A 1-2", None, "0x1", 0.9, t), ("t1", "d", "LOAD A 1/2", None, "0x1", 0.9, t),
        ("t2", "d", "LOAD A 12", None, "0x2", 0.5, t), ("t2", "d", "LOAD A 1 2", None, "0x2", 0.5, t), ("t2", "d", "LOAD A-1 2", None, "0x2", 0.5, t),
        ("u1", "d", "ST B/C 7", None, "x", 0.8, t), ("u1", "d", "ST-B C 7", None, "x", 0.8, t), ("u2", "d", "ST B C 7", None, "9", 0.1, t),
    ]
    base = _catalog(spark, tmp_path, rows)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW instruction_catalog AS SELECT * FROM read_parquet('{base}/instruction_catalog.parquet/*.parquet')")
    got = sorted(map(tuple, Q.p1_found(spark, base).collect()))
    assert got == sorted(con.execute(ORACLE["p1_found"]).fetchall()) == [("t1", "t1", "t1"), ("u1", "u1", "u2")]


@pytest.mark.parametrize("name", ["p1_found", "p1_survivors"])
def test_trust_alone_aligns_nothing(spark, tmp_path, name):
    t = datetime(2025, 1, 1)
    base = _catalog(spark, tmp_path, [("t1", "d", "A", None, "1", 0.9, t), ("t2", "d", "a", None, "2", 0.5, t)])
    plan = lambda query: query(spark, base)._jdf.queryExecution().toString()
    assert "MapInArrow" not in plan(Q.QUERIES[name]) and "MapInArrow" in plan(Q.p1_consensus)


def test_trust_alone_agrees_with_the_vote_of_falling_weights(spark):
    """The values that the aligned vote at ``fall`` 2 chooses are those of the most trusted record; at 1 they are not."""
    rnd = random.Random(5)
    rows = [(f"a{n:04d}", f"k{n % 60}", "".join(rnd.choice(["LOAD", "X", "2", "_", " "]) for _ in range(rnd.randrange(0, 7))), rnd.random()) for n in range(400)]
    df = spark.createDataFrame(rows, "id string, k string, v string, conf double")
    out = C.trusted_survivors(df, {"k": F.col("k")}, F.col("id"), [-F.col("conf")], {"v": (F.col("v"), F.lit(True)), "none": (F.col("v"), F.lit(False))})
    got = {r["k"]: r for r in out.collect()}
    assert len(got) == 60 and all(r["none_id"] is None and r["none"] is None for r in got.values())
    other = 0
    for k, r in got.items():
        at = {}
        for i, _, v, conf in sorted((x for x in rows if x[1] == k), key=lambda x: -x[3]):
            at.setdefault(v, [0.0, [-conf, i]])[0] += 1.0
        vals = [(v, w, t, 0) for v, (w, t) in at.items()]
        assert vals[C.choose(vals, 2)][::2] == (r["v"], [-max(x[3] for x in rows if x[1] == k), r["v_id"]])
        other += vals[C.choose(vals, 1)][0] != r["v"]
    assert other > 10


def test_no_rows_give_no_survivors(spark):
    df = spark.createDataFrame([], "id string, k string, v string")
    args = df, {"k": F.col("k")}, F.col("id"), [F.lit(0.0)], {"v": (F.col("v"), F.lit(True))}
    assert C.trusted_survivors(*args).collect() == [] and all(C.consensus_survivors(*args, fall=fall).collect() == [] for fall in (1.0, 2.0))
