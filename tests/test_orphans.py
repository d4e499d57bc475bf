import random
from datetime import datetime, timedelta

import numpy as np
from pyspark.sql import functions as F

from pagelode.operators.orphans import BITS, Reference, container, dictionary, orphan_references, orphan_report, parent_rows, places, reference_rows


def _brute(refs, parents):
    out = set()
    for rid, key, at in refs:
        if key is None or not key.strip():
            continue
        own = [(s, e) for k, s, e in parents if k is not None and k.strip().lower() == key.strip().lower()]
        if not own:
            out.add((rid, "missing"))
        elif at is not None and not any((s is None or s <= at) and (e is None or e > at) for s, e in own):
            out.add((rid, "late" if all(s is not None and s > at for s, _ in own) else "deleted"))
    return out


def _run(spark, refs, parents):
    r = spark.createDataFrame(refs, "id string, k string, at timestamp")
    p = spark.createDataFrame(parents, "k string, s timestamp, e timestamp")
    rr = reference_rows([Reference(r, "t", "k", F.col("id"), F.lit("x"), F.lit(None).cast("string"), F.col("k"), F.col("at"))])
    return orphan_references(rr, parent_rows("x", p, F.lit(""), F.col("k"), F.col("s"), F.col("e")))


def test_against_brute_force(spark):
    rnd = random.Random(5)
    base = datetime(2025, 1, 1)
    t = lambda: base + timedelta(hours=rnd.randrange(24 * 200))
    keys = [f"K{i}" for i in range(30)]
    parents = []
    for k in keys[:22]:
        for _ in range(rnd.randrange(1, 4)):
            s = t() if rnd.random() < 0.9 else None
            parents.append((rnd.choice([k, k.lower(), f" {k} "]), s, (s or base) + timedelta(days=rnd.randrange(1, 80)) if rnd.random() < 0.5 else None))
    refs = [(f"r{i}", rnd.choice([rnd.choice(keys), "K1", " k2", None, "  "]), t() if rnd.random() < 0.95 else None) for i in range(600)]
    refs += refs[:20]
    got = _run(spark, refs, parents)
    assert {(r["trace_id"], r["kind"]) for r in got.collect()} == _brute(refs, parents)
    assert got.count() == len(_brute(refs, parents))
    report = orphan_report(got).collect()
    assert sum(r["n_refs"] for r in report) == got.count() and all(r["month"] is None or len(r["month"]) == 7 for r in report)


def test_empty_tables(spark):
    at = datetime(2025, 5, 5)
    assert _run(spark, [], [("a", at, None)]).count() == 0
    assert [r["kind"] for r in _run(spark, [("1", "a", at)], []).collect()] == ["missing"]
    # Valid from inclusive, to exclusive.
    assert _run(spark, [("1", "a", at)], [("A", at, None)]).count() == 0
    assert [r["kind"] for r in _run(spark, [("1", "a", at)], [("A", at - timedelta(days=1), at)]).collect()] == ["deleted"]


def test_a_key_of_many_spans(spark):
    """Thousands of spans of one key, overlapping and apart, are cut into slots."""
    rnd = random.Random(9)
    base = datetime(2025, 1, 1)
    t = lambda: base + timedelta(minutes=rnd.randrange(60 * 24 * 90))
    parents = [("K", s, s + timedelta(minutes=rnd.choice([5, 30, 600]))) for s in (t() for _ in range(1500))] + [("K", None, base + timedelta(days=2))]
    refs = [(f"r{i}", "k", t() - timedelta(days=rnd.choice([0, 0, 3]))) for i in range(1500)]
    assert {(r["trace_id"], r["kind"]) for r in _run(spark, refs, parents).collect()} == _brute(refs, parents)


def test_containers_keep_every_bit():
    rnd = random.Random(7)
    runs = [x for a in rnd.sample(range(0, BITS, 256), 40) for x in range(a, a + 200)]
    for at in ([], [0], [BITS - 1], list(range(BITS)), rnd.sample(range(BITS), 900), rnd.sample(range(BITS), 20_000), runs, [*range(5000), BITS - 1]):
        bits = np.zeros(BITS, dtype=bool)
        bits[at] = True
        packed = container(np.packbits(bits, bitorder="little").tobytes())
        assert (places(packed) == bits).all() and len(packed) <= BITS // 8 + 1
    assert not places(None).any() and len(container(np.packbits(np.ones(BITS, dtype=bool)).tobytes())) == 5


def test_ranges_follow_the_number_of_keys(spark):
    keys = spark.range(100_000).selectExpr("'x' AS target", "'' AS scope", "string(id) AS key")
    codes = dictionary(keys)
    got = codes.groupBy("rng").agg(F.count("*").alias("n"), F.count_distinct("bit").alias("m"), F.max("bit").alias("b")).collect()
    assert sum(r["n"] for r in got) == 100_000 and all(r["n"] == r["m"] == r["b"] + 1 <= BITS for r in got) and len(got) <= 8
