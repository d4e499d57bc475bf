import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from pagelode.operators.table_diff import _check, _places, number_text, peel, table_diff


def test_peel_reveals_all():
    rnd = random.Random(1)
    for n in (0, 1, 20, 40):
        cells = {}
        elements = [(rnd.choice((1, -1)), rnd.getrandbits(64) - 2**63, rnd.getrandbits(63)) for _ in range(n)]
        for sign, e, k in elements:
            for p in _places(e, 96):
                v = cells.get(p, (0, 0, 0, 0))
                cells[p] = (v[0] + sign, v[1] ^ (e & (2**64 - 1)), v[2] ^ k, v[3] ^ _check(e))
        found, empty = peel(cells, 96)
        assert empty and sorted(found) == sorted(elements)


def test_check_is_the_engines_hash(spark):
    assert spark.sql("SELECT xxhash64(123456789L) h").first()["h"] % 2**64 == _check(123456789)


def _diff(spark, left, right, **kw):
    a = spark.createDataFrame(left, "id string, name string, num bigint, extra int")
    b = spark.createDataFrame(right, "id string, name string, num string, at timestamp")
    return table_diff(a, b, "id", {"name": (F.lower(F.trim("name")), F.lower(F.trim("name"))), "num": (F.col("num").cast("string"), number_text(F.col("num")))}, "left", "right", F.col("at"), **kw)


def test_against_brute_force_also_when_buckets_overflow(spark):
    rnd = random.Random(2)
    t0 = datetime(2025, 1, 1)
    left, right, want = [], [], set()
    for i in range(500):
        row = (f"id{i}", rnd.choice(["Ab", "c ", None]), rnd.choice([None, i]), 0)
        left.append(row)
        if i % 17 == 0:
            want.add((row[0], "missing_in_right"))
            continue
        name, num = row[1], row[2]
        if i % 11 == 0:
            name = "other"
            want.add((row[0], "name"))
        if i % 13 == 0:
            num = 10_000 + i
            want.add((row[0], "num"))
        text = None if num is None else rnd.choice([str(num), f" {num} ", f"{num}.0", hex(num), f"0{num}"])
        right.append((row[0], name.upper() + " " if name else None, text, t0 + timedelta(days=1)))
        if i % 7 == 0:
            right.append((row[0], "stale", "999999", t0))
    right.append(("new", "x", "1", t0))
    want.add(("new", "missing_in_left"))
    left += left[:10]
    for kw in ({"buckets": 64, "cells": 48}, {"buckets": 2, "cells": 12}):
        got = [tuple(r) for r in _diff(spark, left, right, **kw).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_empty_sides(spark):
    one = [("a", "x", 1, 0)]
    assert [tuple(r) for r in _diff(spark, one, [], buckets=4, cells=12).collect()] == [("a", "missing_in_right")]
    assert _diff(spark, [], [], buckets=4, cells=12).count() == 0
    assert _diff(spark, [(None, "x", 1, 0)], [], buckets=4, cells=12).count() == 0


def test_number_text(spark):
    vals = {"10": "10", " 010 ": "10", "10.0": "10", "0x0A": "10", "0XfF": "255", "": None, "  ": None, None: None, "abc": "abc", "1.50": "1.5", "100": "100"}
    df = spark.createDataFrame([(k,) for k in vals], "v string")
    assert {r["v"]: r["n"] for r in df.select("v", number_text(F.col("v")).alias("n")).collect()} == vals
