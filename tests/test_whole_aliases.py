"""Aliases against all pairs."""

import random

from pyspark.sql import functions as F

from pagelode.operators import glossary as G


def test_aliases_against_all_pairs(spark):
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("ab1") for _ in range(rnd.randrange(1, 12)))
    names = spark.createDataFrame([("XBCDEFGHIX",), *((word(),) for _ in range(80))], "name string")
    known = spark.createDataFrame([("abcdefghij",), *((word(),) for _ in range(40))], "name string")
    for most in (1, 2):
        pairs = names.distinct().crossJoin(known.select(F.col("name").alias("canonical"))).withColumn("d", F.levenshtein(F.lower("name"), F.lower("canonical"))).filter(F.col("d") <= most)
        want = {(r["name"], r["m"]["canonical"], r["m"]["d"]) for r in pairs.groupBy("name").agg(F.min(F.struct("d", "canonical")).alias("m")).collect()}
        got = {tuple(r) for r in G.match_aliases(names, known, most).collect()}
        assert got == want
        assert (("XBCDEFGHIX", "abcdefghij", 2) in got) == (most == 2)
