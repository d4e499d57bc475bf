"""Differences between two copies of a table by invertible Bloom lookup tables.

Every row becomes one element: a 64-bit hash of key and compared values. Keys fall into buckets; in
each bucket an element is added to three cells (count, XOR of elements, XOR of key hashes, XOR
of check hashes). Both tables go into one aggregation with opposite signs, which subtracts one from the
other: equal rows vanish, so only the differences are left to be peeled. Aggregation is partial on the map
side, and a cell has a fixed size however many rows share a bucket. A bucket with more differences than
its cells can reveal is given up whole and its rows are compared one by one, so nothing is lost.
What was revealed is kept as one row per bucket and written once, so that the tables are peeled once.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelode.session import materialize

#: Cells an element goes to, each in its own third of a bucket's cells.
HASHES = 3
_MASK = (1 << 64) - 1


def _check(element: int) -> int:
    """The check hash as ``xxhash64`` of a bigint gives it on the JVM (seed 42)."""
    return xxhash.xxh64_intdigest(struct.pack("<q", element), seed=42)


def _places(element: int, cells: int) -> list[int]:
    """The element's cells: 20 of its bits choose the place in each third."""
    third = cells // HASHES
    e = element & _MASK
    return [j * third + ((e >> (20 * j)) & 0xFFFFF) % third for j in range(HASHES)]


def peel(cells: dict[int, tuple[int, int, int, int]], size: int) -> tuple[list[tuple[int, int, int]], bool]:
    """Elements left in one bucket as (sign, element, key hash), and whether the bucket came out empty."""
    table = {c: list(v) for c, v in cells.items()}
    ready = [c for c, v in table.items() if abs(v[0]) == 1]
    found = []
    while ready:
        c = ready.pop()
        n, e, k, x = table.get(c, (0, 0, 0, 0))
        signed = e - (1 << 64) if e >> 63 else e
        if abs(n) != 1 or x != _check(signed) or c not in _places(e, size):
            continue
        found.append((n, signed, k - (1 << 64) if k >> 63 else k))
        for p in _places(e, size):
            v = table.setdefault(p, [0, 0, 0, 0])
            v[0] -= n
            v[1] ^= e
            v[2] ^= k
            v[3] ^= x
            if abs(v[0]) == 1:
                ready.append(p)
    return found, all(v == [0, 0, 0, 0] for v in table.values())


def _peeled(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """(bucket, whole, keys) of buckets with differences, from cells sorted by bucket; one bucket in memory at a time."""
    def close(bucket: int, cells: dict) -> tuple[int, bool, list[int]]:
        found, empty = peel(cells, size)
        return bucket, not empty, sorted({k for _, _, k in found}) if empty else []

    current, cells = None, {}
    for b in batches:
        done = []
        for bucket, cell, n, e, k, x in zip(*(c.to_pylist() for c in b.columns)):
            if bucket != current:
                if cells:
                    done.append(close(current, cells))
                current, cells = bucket, {}
            cells[cell] = (n, e & _MASK, k & _MASK, x & _MASK)
        yield _found(done)
    if cells:
        yield _found([close(current, cells)])


def _found(rows: list[tuple[int, bool, list[int]]]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [[], [], []]
    types = [pa.int32(), pa.bool_(), pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], names=["bucket", "whole", "keys"])


def sketch(left: DataFrame, right: DataFrame, buckets: int, cells: int) -> DataFrame:
    """Subtracted tables: one row per (bucket, cell) that is not empty. Inputs: columns key_hash, row_hash."""
    third = cells // HASHES
    both = left.select("key_hash", "row_hash", F.lit(1).alias("sign")).unionByName(
        right.select("key_hash", "row_hash", F.lit(-1).alias("sign"))
    )
    places = F.array(
        *(
            (F.lit(j * third) + F.pmod(F.shiftrightunsigned("row_hash", 20 * j).bitwiseAND(F.lit(0xFFFFF)), F.lit(third))).cast("int")
            for j in range(HASHES)
        )
    )
    return (
        both.select(
            F.pmod("key_hash", F.lit(buckets)).cast("int").alias("bucket"),
            F.explode(places).alias("cell"),
            "sign", "key_hash", "row_hash", F.xxhash64("row_hash").alias("check"),
        )
        .groupBy("bucket", "cell")
        .agg(
            F.sum("sign").alias("n"),
            F.bit_xor("row_hash").alias("e"),
            F.bit_xor("key_hash").alias("k"),
            F.bit_xor("check").alias("x"),
        )
        .filter("n <> 0 OR e <> 0 OR k <> 0 OR x <> 0")
    )


def table_diff(
    left: DataFrame,
    right: DataFrame,
    key: str,
    fields: dict[str, tuple[Column, Column]],
    left_name: str,
    right_name: str,
    latest: Column | None = None,
    buckets: int | None = None,
    cells: int = 384,
) -> DataFrame:
    """Rows missing on either side and differing fields: (``key``, ``diff``).

    ``diff`` is ``missing_in_<name>`` or a name of ``fields``, whose two expressions give the compared
    value on either side (equal nulls are no difference). Repeated rows of ``left`` count once; of
    several rows of ``right`` with one key the one with the greatest ``latest`` counts, ties by the
    compared values, null ``latest`` first. Rows with a null key are left out; empty tables make all
    rows of the other side missing. ``buckets`` (by default one for a thousand rows of the larger table) and ``cells``
    bound a bucket's table, not the result: 384 cells reveal differences in about one of seven rows.
    """
    if buckets is None:
        buckets = max(64, max(left.count(), right.count()) // 1000)
    names = list(fields)
    tag = [f"_f{i}" for i in range(len(names))]
    a = left.filter(F.col(key).isNotNull()).select(F.col(key).alias("_key"), *(fields[n][0].cast("string").alias(t) for n, t in zip(names, tag)))
    a = a.groupBy("_key").agg(F.max(F.struct(*tag)).alias("_v"))
    at = F.lit(None).cast("timestamp") if latest is None else latest
    b = right.filter(F.col(key).isNotNull()).select(F.col(key).alias("_key"), at.alias("_at"), *(fields[n][1].cast("string").alias(t) for n, t in zip(names, tag)))
    b = b.groupBy("_key").agg(F.max(F.struct("_at", *tag)).alias("_w"))
    b = b.select("_key", F.struct(*(F.col("_w")[t].alias(t) for t in tag)).alias("_v"))

    def hashed(df: DataFrame) -> DataFrame:
        parts = [F.coalesce(F.concat(F.lit("="), F.col("_v")[t]), F.lit("")) for t in tag]
        return df.select(F.xxhash64("_key").alias("key_hash"), F.xxhash64("_key", *parts).alias("row_hash"))

    cell = sketch(hashed(a), hashed(b), buckets, cells).select("bucket", "cell", "n", "e", "k", "x")
    found = cell.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(lambda it: _peeled(it, cells), "bucket int, whole boolean, keys array<bigint>")
    found = materialize(found, "differing-buckets")

    def fetched(df: DataFrame) -> DataFrame:
        h = df.withColumn("_h", F.xxhash64("_key"))
        h = h.withColumn("bucket", F.pmod("_h", F.lit(buckets)).cast("int"))
        # A bucket's list has at most as many keys as it has cells.
        return h.join(found, "bucket").filter("whole OR array_contains(keys, _h)").select("_key", "_v")

    x, y = fetched(a).withColumnRenamed("_v", "_l"), fetched(b).withColumnRenamed("_v", "_r")
    diffs = F.array(
        F.when(F.col("_r").isNull(), F.lit(f"missing_in_{right_name}")),
        F.when(F.col("_l").isNull(), F.lit(f"missing_in_{left_name}")),
        *(
            F.when(F.col("_l").isNotNull() & F.col("_r").isNotNull() & ~F.col("_l")[t].eqNullSafe(F.col("_r")[t]), F.lit(n))
            for n, t in zip(names, tag)
        ),
    )
    return (
        x.join(y, "_key", "full_outer")
        .select(F.col("_key").alias(key), F.explode(F.filter(diffs, lambda d: d.isNotNull())).alias("diff"))
    )


def number_text(c: Column) -> Column:
    """A number written as decimal, decimal with point, or 0x hexadecimal, as canonical text; blank is null.

    Text that reads as no number stays as its folded text, so that it equals itself alone.
    """
    s = F.lower(F.regexp_replace(c, r"^[\s\p{Z}]+|[\s\p{Z}]+$", ""))
    hexa = F.conv(F.regexp_extract(s, r"^[+]?0x([0-9a-f]{1,15})$", 1), 16, 10)
    dec = s.try_cast("decimal(38,10)")
    canon = F.regexp_replace(F.regexp_replace(dec.cast("string"), r"(\.\d*?)0+$", "$1"), r"\.$", "")
    return (
        F.when(s == "", None)
        .when(s.rlike(r"^[+]?0x[0-9a-f]{1,15}$"), hexa)
        .when(dec.isNotNull(), canon)
        .otherwise(s)
    )
