"""References to records that do not exist.

Keys of both sides are dictionary-encoded as integers: distinct keys are numbered where they are written, and every
32 768 of them make a key range, so that there are as many ranges as the number of keys asks for. For every key range
and period (calendar month) the references form one bitmap and the parents valid during the whole period another, both
kept as the shortest of three containers (sorted places, runs, plain bits); references AND-NOT parents leaves the bits
that are broken or undecided at the edges of a period. Those few keys are decoded and only their references are
compared with the parents' exact validity.

Nothing is collected: a key referred to by a third of all rows costs one bit after map-side aggregation.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelode.functions.text import fold
from pagelode.session import materialize

#: Bits of one bitmap of Spark's bitmap functions.
BITS = 32768


@dataclass(frozen=True)
class Reference:
    """One referring column: where it is, which kind of parent it names and in which scope."""

    rows: DataFrame
    table_name: str
    ref_field: str
    row_id: Column
    kind: Column
    scope: Column
    value: Column
    at: Column


def reference_rows(refs: list[Reference]) -> DataFrame:
    """All non-blank references: (table_name, ref_field, trace_id, kind, scope, key, at, period)."""
    parts = [
        r.rows.select(
            F.lit(r.table_name).alias("table_name"),
            F.lit(r.ref_field).alias("ref_field"),
            r.row_id.alias("trace_id"),
            r.kind.alias("target"),
            F.coalesce(r.scope, F.lit("")).alias("scope"),
            fold(r.value).alias("key"),
            r.at.alias("at"),
        )
        for r in refs
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.filter("key IS NOT NULL AND target IS NOT NULL").withColumn("period", _period(F.col("at")))


def _period(at: Column) -> Column:
    return F.coalesce(F.year(at) * 12 + F.month(at) - 1, F.lit(-1)).cast("int")


def parent_rows(target: str, df: DataFrame, scope: Column, value: Column, start: Column | None, end: Column | None) -> DataFrame:
    """Parents as (target, scope, key, start, end); a null start has always been there, a null end still is."""
    never = F.lit(None).cast("timestamp")
    return df.select(
        F.lit(target).alias("target"),
        F.coalesce(scope, F.lit("")).alias("scope"),
        fold(value).alias("key"),
        (never if start is None else start).alias("start"),
        (never if end is None else end).alias("end"),
    ).filter("key IS NOT NULL")


def dictionary(keys: DataFrame) -> DataFrame:
    """Integer codes of distinct (target, scope, key): ``rng`` (32 768 keys each) and ``bit``; to be written once.

    A key's number is its place in the partition that holds it after ``distinct``: no sort, and full ranges. Numbers
    differ from run to run, so codes are used only as written.
    """
    at = F.monotonically_increasing_id()  # partition << 33 | place
    d = keys.select("target", "scope", "key").distinct().withColumn("_at", at)
    place = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    rng = F.shiftrightunsigned("_at", 33) * (1 << 18) + F.shiftrightunsigned(place, 15)
    return d.select("target", "scope", "key", rng.alias("rng"), place.bitwiseAND(F.lit(BITS - 1)).alias("bit"))


_ARRAY, _RUNS, _PLAIN = b"\0", b"\1", b"\2"


def container(bitmap: bytes) -> bytes:
    """A bitmap as the shortest of sorted places, runs (first place and length less one) and plain bits, marked by a byte."""
    at = np.flatnonzero(np.unpackbits(np.frombuffer(bitmap, dtype=np.uint8), bitorder="little"))
    if not len(at):
        return _ARRAY
    first = np.flatnonzero(np.diff(at, prepend=-2) != 1)
    if min(2 * len(at), 4 * len(first)) >= len(bitmap):
        return _PLAIN + bytes(bitmap)
    if 2 * len(at) <= 4 * len(first):
        return _ARRAY + at.astype("<u2").tobytes()
    length = np.diff(first, append=len(at)) - 1
    return _RUNS + np.stack([at[first], length], axis=1).astype("<u2").tobytes()


def places(packed: bytes | None) -> np.ndarray:
    """Set bits of a container as a mask; nothing is set in a missing one."""
    mask = np.zeros(BITS, dtype=bool)
    if packed is None:
        return mask
    kind, body = packed[:1], packed[1:]
    if kind == _PLAIN:
        bits = np.unpackbits(np.frombuffer(body, dtype=np.uint8), bitorder="little").astype(bool)
        mask[: len(bits)] = bits
    elif kind == _ARRAY:
        mask[np.frombuffer(body, dtype="<u2")] = True
    else:
        edge = np.zeros(BITS + 1, dtype=np.int32)
        runs = np.frombuffer(body, dtype="<u2").reshape(-1, 2).astype(np.int64)
        edge[runs[:, 0]] += 1
        edge[runs.sum(axis=1) + 1] -= 1
        mask = np.cumsum(edge)[:BITS] > 0
    return mask


def and_not(left: pd.Series, right: pd.Series) -> pd.Series:
    """Set bits of ``left`` that ``right`` (or nothing, where null) lacks."""
    return pd.Series([np.flatnonzero(places(a) & ~places(b)).astype(np.int64) for a, b in zip(left, right)])


_packed = F.pandas_udf(lambda s: s.map(lambda x: container(x)), T.BinaryType())
_surviving = F.pandas_udf(and_not, T.ArrayType(T.LongType()))


def orphan_references(refs: DataFrame, parents: DataFrame) -> DataFrame:
    """Broken references of ``refs`` with their kind.

    ``refs``: :func:`reference_rows`; ``parents``: union of :func:`parent_rows`. A reference is
    ``missing`` if no parent has its key, ``late`` if every parent starts after ``at``, ``deleted``
    if some parent starts no later than ``at`` but none is valid then. Defined edge cases: rows with
    a null or blank key are not references; a null ``at`` is checked for existence only; an empty
    parent table makes every reference ``missing``; rows delivered twice come out once.
    Columns: table_name, ref_field, trace_id, kind, period.
    """
    key = ["target", "scope", "key"]
    always, ever = F.lit("0001-01-01").cast("timestamp"), F.lit("9999-12-31").cast("timestamp")
    used = materialize(refs.select(*key, "period").distinct(), "orphan-uses")
    # Of periods with one end the earliest start holds the rest, so a key keeps its deletions, not its rows.
    spans = parents.groupBy(*key, F.coalesce("end", ever).alias("end")).agg(F.min(F.coalesce("start", always)).alias("start"))
    spans = materialize(spans, "orphan-parents")
    codes = materialize(dictionary(used.select(*key).unionByName(spans.select(*key))), "orphan-codes")

    bounds = used.filter("period >= 0").agg(F.min("period"), F.max("period")).first()
    first, last = (0, -1) if bounds is None or bounds[0] is None else (bounds[0], bounds[1])
    ref_bits = used.join(codes, key).groupBy("rng", "period").agg(F.bitmap_construct_agg("bit").alias("_m"))
    ref_bits = ref_bits.select("rng", "period", _packed("_m").alias("ref_map"))
    # A parent covers a month if it holds from before its first moment to after its last. Keys meet once per pair of
    # first and last month; only the bitmaps of the pairs are repeated for the months in between.
    lo = F.greatest(F.when(F.col("start") <= always, F.lit(first)).otherwise(_period(F.col("start")) + 1), F.lit(first))
    hi = F.least(F.when(F.col("end") >= ever, F.lit(last)).otherwise(_period(F.col("end")) - 1), F.lit(last))
    covering = spans.join(codes, key).select("rng", "bit", lo.alias("lo"), hi.alias("hi")).filter("lo <= hi")
    pairs = covering.groupBy("rng", "lo", "hi").agg(F.bitmap_construct_agg("bit").alias("_m"))
    parent_bits = pairs.select("rng", F.explode(F.sequence("lo", "hi")).alias("period"), "_m").groupBy("rng", "period").agg(F.bitmap_or_agg("_m").alias("_m"))
    parent_bits = parent_bits.select("rng", "period", _packed("_m").alias("parent_map"))
    left = ref_bits.join(parent_bits, ["rng", "period"], "left")
    survivors = left.select("rng", "period", F.explode(_surviving("ref_map", "parent_map")).alias("bit")).join(codes, ["rng", "bit"]).select(*key, "period")
    survivors = materialize(survivors, "orphan-survivors")

    # Exact check of what survived, against the whole validity of its key.
    sizes, slots = _slots(spans.join(survivors.select(*key).distinct(), key), key, always)
    marked = survivors.join(sizes, key, "left")
    at = F.col("at").cast("timestamp")
    met = refs.join(marked, [*key, "period"]).withColumn("slot", _slot_of(at))
    met = met.join(slots, [*key, "slot"], "left")
    held = (F.col("before") > at) | F.exists("spans", lambda s: (s["start"] <= at) & (s["end"] > at))
    kind = (
        F.when(F.col("first_start").isNull(), "missing")
        .when(at.isNull() | F.coalesce(held, F.lit(False)), None)
        .when(F.col("first_start") > at, "late")
        .otherwise("deleted")
    )
    return met.withColumn("kind", kind).filter("kind IS NOT NULL").select("table_name", "ref_field", "trace_id", "kind", "period").distinct()


#: Spans in one slot of a key, on average.
_IN_SLOT = 16


def _slot_of(at: Column) -> Column:
    """The slot of a moment among a key's slots: its time from the first start on is cut evenly."""
    n = F.floor((F.unix_micros(at) - F.col("slot_from")) / F.col("slot_width"))
    return F.greatest(F.lit(0), F.least(n, F.col("n_slots") - 1)).cast("int")


def _slots(spans: DataFrame, key: list[str], always: Column) -> tuple[DataFrame, DataFrame]:
    """Validity of keys, cut by time so that a key with any number of spans is never one list.

    Per key: first_start, slot_from, slot_width, n_slots. Per key and slot: the spans that start in it, and
    ``before``, the latest end of those that start in earlier slots.
    """
    own = materialize(spans.groupBy(*key, "start").agg(F.max("end").alias("end")), "orphan-spans")
    dated = F.when(F.col("start") > always, F.unix_micros("start"))
    sizes = own.groupBy(*key).agg(
        F.min("start").alias("first_start"), F.coalesce(F.min(dated), F.lit(0)).alias("slot_from"), F.coalesce(F.max(dated), F.lit(0)).alias("_to"),
        F.ceil(F.count("*") / _IN_SLOT).cast("int").alias("n_slots"),
    )
    sizes = sizes.withColumn("slot_width", F.floor((F.col("_to") - F.col("slot_from")) / F.col("n_slots")) + 1).drop("_to")
    placed = own.join(sizes, key).withColumn("slot", _slot_of(F.col("start")))
    lists = placed.groupBy(*key, "slot").agg(F.max("end").alias("_last"), F.collect_list(F.struct("start", "end")).alias("spans"))
    grid = sizes.select(*key, F.explode(F.sequence(F.lit(0), F.col("n_slots") - 1)).alias("slot")).join(lists, [*key, "slot"], "left")
    earlier = Window.partitionBy(*key).orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return sizes, grid.select(*key, "slot", F.max("_last").over(earlier).alias("before"), "spans")


def orphan_report(orphans: DataFrame) -> DataFrame:
    """Counts of broken references per table, field, month (``yyyy-MM``) and kind."""
    month = F.when(F.col("period") >= 0, F.format_string("%04d-%02d", (F.col("period") / 12).cast("int"), F.col("period") % 12 + 1))
    return (
        orphans.groupBy("table_name", "ref_field", month.alias("month"), "kind")
        .agg(F.count("*").alias("n_refs"))
    )
