"""Best representative of each duplicate group by token-level consensus.

The values of a group are split into tokens and aligned progressively into columns, most trusted first. Each column is
decided by a vote of weighted tokens, and the existing value closest to the consensus is emitted with the record it
stands in. The weight of a value falls with its place in the order of trust: ``fall`` = 1 is the plain vote by weight, in
between a few lesser records that agree outvote a better one, and from 2 on the first outweighs all others together. There
nothing is left to vote on: ``trusted_survivors`` takes the first by one aggregation, without tokens or alignment.

Equal rows are combined before anything is shuffled as a group. A value belongs to one of ``chunks`` by its hash;
each chunk is aligned in the order of trust, then the chunk profiles are. Groups of up to ``direct`` different rows are
treated in one go, larger ones chunk by chunk in many tasks, with the same steps and so with the same result.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelode.session import materialize

_TOKEN = re.compile(r"[^\W\d_]+|\d+|\S")
GAP = ""
#: Places in the order of trust that are told apart; 2 ** -64 of the first vote is below the precision of a sum.
PLACES = 64
#: Votes: [weight, trusts of the best voters]; a profile: per column the votes of each token.
Votes = list
Profile = list[dict[str, Votes]]


def tokens(value: str | None) -> list[str]:
    """Runs of letters, runs of digits, and single other marks; white space separates."""
    return _TOKEN.findall(value or "")


def profile_of(value: str | None, weight: float, trust: list) -> tuple[Profile, Votes]:
    """One value as a profile, with the votes of everything in it."""
    return [{t: [weight, [trust]]} for t in tokens(value)], [weight, [trust]]


def _add(a: Votes, b: Votes) -> Votes:
    return [a[0] + b[0], sorted(a[1] + b[1])[:PLACES]]


def _both(a: dict, b: dict) -> dict:
    out = dict(a)
    for t, v in b.items():
        out[t] = _add(out[t], v) if t in out else v
    return out


def align(p: Profile, q: Profile, p_all: Votes, q_all: Votes) -> Profile:
    """Global alignment of two profiles; columns without a partner receive the other side's votes for a gap."""
    n, m = len(p), len(q)
    score = [[-j for j in range(m + 1)]]
    step = [[2] * (m + 1)]
    tokens_q = [c.keys() - {GAP} for c in q]
    for i in range(1, n + 1):
        a, above, row, way = p[i - 1].keys(), score[-1], [-i], [1]
        for j in range(1, m + 1):
            both = above[j - 1] + (-1 if a.isdisjoint(tokens_q[j - 1]) else 2)
            up, side = above[j] - 1, row[-1] - 1
            best = max(both, up, side)
            row.append(best)
            way.append(0 if best == both else 1 if best == up else 2)
        score.append(row)
        step.append(way)
    out, i, j = [], n, m
    while i or j:
        s = step[i][j] if i and j else (1 if i else 2)
        if s == 0:
            i, j = i - 1, j - 1
            out.append(_both(p[i], q[j]))
        elif s == 1:
            i -= 1
            out.append(_both(p[i], {GAP: q_all}))
        else:
            j -= 1
            out.append(_both({GAP: p_all}, q[j]))
    return out[::-1]


def merge(a: tuple[Profile, Votes], b: tuple[Profile, Votes]) -> tuple[Profile, Votes]:
    return align(a[0], b[0], a[1], b[1]), _add(a[1], b[1])


def consensus(profile: Profile, every: Votes, fall: float) -> list[str]:
    """Per column the token with the greatest sum of weights (ties: the more trusted, then the smaller), without gaps.

    At ``fall`` 1 votes weigh what they are given; above, the voter at place i of the group weighs fall ** -i.
    """
    places = {tuple(t): i for i, t in enumerate(every[1])}

    def weight(v: Votes) -> float:
        return v[0] if fall == 1 else sum(fall ** -places[k] for t in v[1] if (k := tuple(t)) in places)

    won = (min(c.items(), key=lambda x: (-weight(x[1]), x[1][1][0], x[0]))[0] for c in profile)
    return [t for t in won if t != GAP]


def distance(a: list[str], b: list[str]) -> int:
    """Token edit distance."""
    if a == b:
        return 0
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def group_profile(values: list[tuple[str, float, list, int]]) -> tuple[Profile, Votes]:
    """Profile of (value, weight, trust, chunk): chunks aligned inside in the order of trust, then with one another."""
    parts: dict[int, tuple[Profile, Votes]] = {}
    for value, weight, trust, chunk in sorted(values, key=lambda x: x[2]):
        one = profile_of(value, weight, trust)
        parts[chunk] = merge(parts[chunk], one) if chunk in parts else one
    return reduce(merge, sorted(parts.values(), key=lambda x: x[1][1][0]))


def choose(values: list[tuple[str, float, list, int]], fall: float) -> int:
    """Index of the existing value closest to the consensus of (value, weight, trust, chunk); ties by trust."""
    goal = consensus(*group_profile(values), fall)
    return min(range(len(values)), key=lambda i: (distance(tokens(values[i][0]), goal), values[i][2]))


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of rows with equal leading key columns over sorted batches, streamed."""
    current, rows = None, []
    for b in batches:
        for r in zip(*(c.to_pylist() for c in b.columns)):
            if r[:keys] != current:
                if rows:
                    yield current, rows
                current, rows = r[:keys], []
            rows.append(r[keys:])
    if rows:
        yield current, rows


def _emit(schema: pa.Schema, rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    buf: list[tuple] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*buf), schema.types)], schema=schema)

    for r in rows:
        buf.append(r)
        if len(buf) >= 4096:
            yield batch()
            buf = []
    if buf:
        yield batch()


def _group_hash(keys: dict[str, Column]) -> list[Column]:
    """128 bits of the keys as strings; nulls are equal and differ from all strings."""
    ident = [F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("")) for c in keys.values()]
    return [F.xxhash64(F.lit(i), *ident).alias(f"h{i}") for i in (1, 2)]


def trusted_survivors(
    df: DataFrame,
    keys: dict[str, Column],
    row_id: Column,
    trust: list[Column],
    fields: dict[str, tuple[Column, Column]],
    keep: list[str] | None = None,
) -> DataFrame:
    """Rows as of ``consensus_survivors``, each field from the most trusted record that may supply it, whatever the others say."""
    names, kept = list(fields), list(keys if keep is None else keep)
    one = F.struct(*(t.alias(f"t{i}") for i, t in enumerate(trust)), row_id.cast("string").alias("id"))
    rows = df.filter(row_id.isNotNull()).select(
        *_group_hash(keys), *(keys[c].cast("string").alias(f"_k{i}") for i, c in enumerate(kept)), one.alias("_rank"),
        *(F.when(ok, F.coalesce(x.cast("string"), F.lit(""))).alias(f"_v{i}") for i, (x, ok) in enumerate(fields.values())),
    )
    best = [F.min(F.when(F.col(f"_v{i}").isNotNull(), F.struct("_rank", f"_v{i}"))).alias(f"_b{i}") for i in range(len(names))]
    groups = rows.groupBy("h1", "h2").agg(F.min("_rank.id").alias("_lo"), F.max("_rank.id").alias("_hi"), *(F.min(f"_k{i}").alias(f"_k{i}") for i in range(len(kept))), *best)
    return groups.filter("_lo <> _hi").select(
        *(F.col(f"_k{i}").alias(c) for i, c in enumerate(kept)), F.col("_lo").alias("group_id"),
        *(c for i, n in enumerate(names) for c in (F.col(f"_b{i}._rank.id").alias(f"{n}_id"), F.col(f"_b{i}._v{i}").alias(n))),
    )


def consensus_survivors(
    df: DataFrame,
    keys: dict[str, Column],
    row_id: Column,
    trust: list[Column],
    fields: dict[str, tuple[Column, Column]],
    weight: Column | None = None,
    fall: float = 2.0,
    keep: list[str] | None = None,
    direct: int = 256,
    chunks: int = 64,
) -> DataFrame:
    """One row per group of at least two distinct ids: ``keep`` keys, ``group_id`` (smallest id), per field ``<field>_id``, ``<field>``.

    ``keys`` make the group, as strings (nulls are equal). ``trust`` are double columns, smaller is better, ties go to the
    smaller id. ``fields`` gives each field's value and whether the record may supply it; a record that may not has no
    vote there. ``weight`` (1 by default) is what a record's vote weighs at ``fall`` 1. A field without any eligible
    record is null. Null values are empty; rows delivered twice change nothing above ``fall`` 1 and should be removed before
    at 1; rows with a null id are left out; an empty table gives an empty result. From ``fall`` 2 on, ``trusted_survivors`` decides.
    """
    if fall >= 2:
        return trusted_survivors(df, keys, row_id, trust, fields, keep)
    names, kept = list(fields), list(keys if keep is None else keep)
    v, k, n_trust = [f"_v{i}" for i in range(len(names))], [f"_k{i}" for i in range(len(kept))], len(trust)
    base = df.filter(row_id.isNotNull()).select(
        *_group_hash(keys),
        *(keys[c].cast("string").alias(n) for c, n in zip(kept, k)),
        row_id.cast("string").alias("_id"),
        F.struct(*(t.cast("double").alias(f"t{i}") for i, t in enumerate(trust)), row_id.cast("string").alias("id")).alias("_rank"),
        (F.lit(1.0) if weight is None else weight.cast("double")).alias("_w"),
        *(F.when(ok, F.coalesce(x.cast("string"), F.lit(""))).alias(n) for n, (x, ok) in zip(v, fields.values())),
    )
    rows = materialize(base.groupBy("h1", "h2", *v).agg(
        F.min("_rank").alias("_rank"), F.min("_id").alias("_lo"), F.max("_id").alias("_hi"), F.sum("_w").alias("_w"), *(F.min(n).alias(n) for n in k)
    ), "survivor-rows")
    groups = rows.groupBy("h1", "h2").agg(F.min("_lo").alias("_glo"), F.max("_hi").alias("_ghi"), F.count("*").alias("_n"))
    groups = materialize(groups.filter("_glo <> _ghi").drop("_ghi"), "survivor-groups")
    held = rows.join(groups, ["h1", "h2"]).select(
        "h1", "h2", "_glo", "_n", *k, *v, *(F.pmod(F.xxhash64(c), F.lit(chunks)).cast("int").alias(f"_c{i}") for i, c in enumerate(v)),
        *(F.col(f"_rank.t{i}").alias(f"_t{i}") for i in range(n_trust)), F.col("_rank.id").alias("_id"), "_w",
    )
    out = _in_one_go(held.filter(F.col("_n") <= direct).drop("_n"), len(v), len(k), n_trust, fall)
    # Whether there are larger groups is known before the plan is made, so that their way costs nothing without them.
    if not groups.filter(F.col("_n") > direct).isEmpty():
        out = out.unionByName(_by_chunks(held.filter(F.col("_n") > direct), len(v), k, n_trust, fall))
    return out.select(*(F.col(n).alias(c) for c, n in zip(kept, k)), F.col("_glo").alias("group_id"), *(F.col(f"_{x}{i}").alias(f"{n}{s}") for i, n in enumerate(names) for x, s in (("i", "_id"), ("v", ""))))


def _picked(n_fields: int, n_keys: int) -> pa.Schema:
    return pa.schema([("_glo", pa.string()), *((f"_k{i}", pa.string()) for i in range(n_keys)), *((f"_{x}{i}", pa.string()) for i in range(n_fields) for x in "iv")])


def _in_one_go(held: DataFrame, n_fields: int, n_keys: int, n_trust: int, fall: float) -> DataFrame:
    """Groups of bounded size, streamed from sorted partitions, one group in memory at a time."""
    schema = _picked(n_fields, n_keys)
    src = held.repartition("h1", "h2").sortWithinPartitions("h1", "h2")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for (_, _, glo), vals in _groups(batches, 3):
                out: list[str | None] = []
                for i in range(n_fields):
                    at: dict[str, list] = {}
                    for r in vals:
                        value = r[n_keys + i]
                        if value is not None:
                            t = list(r[-2 - n_trust : -1])
                            old = at.get(value)
                            at[value] = [r[-1], t, r[n_keys + n_fields + i]] if old is None else [old[0] + r[-1], min(old[1], t), old[2]]
                    if at:
                        cand = [(value, *x) for value, x in at.items()]
                        best = cand[choose(cand, fall)]
                        out += [best[2][-1], best[0]]
                    else:
                        out += [None, None]
                yield (glo, *(min((r[i] for r in vals if r[i] is not None), default=None) for i in range(n_keys)), *out)

        yield from _emit(schema, rows())

    return src.mapInArrow(run, ", ".join(f"`{n}` string" for n in schema.names))


def _by_chunks(held: DataFrame, n_fields: int, k: list[str], n_trust: int, fall: float) -> DataFrame:
    """Larger groups: chunk profiles as streams, merged per group, then the closest value by aggregation."""
    trust = [f"_t{i}" for i in range(n_trust)]
    each = F.array(*(F.struct(F.lit(i).alias("f"), F.col(f"_v{i}").alias("v"), F.col(f"_c{i}").alias("c")) for i in range(n_fields)))
    spread = held.select("h1", "h2", F.struct(*trust, "_id").alias("_r"), "_w", F.explode(each).alias("_x")).filter("_x.v IS NOT NULL")
    values = spread.groupBy("h1", "h2", "_x.f", "_x.c", "_x.v").agg(F.min("_r").alias("_r"), F.sum("_w").alias("_w"))
    values = materialize(values.select("h1", "h2", "f", "c", *(f"_r.{t}" for t in trust), "_r._id", "v", "_w"), "survivor-values")
    keyed = ["h1", "h2", "f", "c"]
    src = values.repartition(*keyed).sortWithinPartitions(*keyed, *trust, "_id")

    def profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            current, acc = None, None
            for b in batches:
                for r in zip(*(c.to_pylist() for c in b.columns)):
                    one = profile_of(r[-2], r[-1], list(r[4:-2]))
                    if r[:4] != current:
                        if current is not None:
                            yield (*current, json.dumps(acc))
                        current, acc = r[:4], one
                    else:
                        acc = merge(acc, one)
            if current is not None:
                yield (*current, json.dumps(acc))

        yield from _emit(pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("f", pa.int32()), ("c", pa.int32()), ("_p", pa.string())]), rows())

    def goals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for key, vals in _groups(batches, 3):
                parts = sorted((json.loads(p) for _, p in vals), key=lambda x: x[1][1][0])
                yield (*key, json.dumps(consensus(*reduce(merge, parts), fall)))

        yield from _emit(pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("f", pa.int32()), ("_goal", pa.string())]), rows())

    prof = src.mapInArrow(profiles, "h1 bigint, h2 bigint, f int, c int, _p string")
    goal = prof.repartition("h1", "h2", "f").sortWithinPartitions("h1", "h2", "f").mapInArrow(goals, "h1 bigint, h2 bigint, f int, _goal string")

    @F.pandas_udf("int")
    def away(v, goal):  # noqa: ANN001, ANN202
        import pandas as pd

        return pd.Series([distance(tokens(a), json.loads(g)) for a, g in zip(v, goal)], dtype="int32")

    near = values.join(goal, ["h1", "h2", "f"]).withColumn("_d", away("v", "_goal"))
    best = near.groupBy("h1", "h2", "f").agg(F.min(F.struct("_d", *trust, "_id", "v")).alias("_b"))
    per = best.groupBy("h1", "h2").agg(*(F.max(F.when(F.col("f") == i, F.col(f"_b.{c}"))).alias(f"_{x}{i}") for i in range(n_fields) for x, c in (("i", "_id"), ("v", "v"))))
    own = held.groupBy("h1", "h2").agg(F.min("_glo").alias("_glo"), *(F.min(n).alias(n) for n in k))
    return own.join(per, ["h1", "h2"], "left").drop("h1", "h2")
