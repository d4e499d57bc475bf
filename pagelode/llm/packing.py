"""Filling containers of fixed capacity from the histogram of lengths.

Best-fit decreasing needs to know lengths only, not documents: the histogram (at most capacity + 1 rows)
is planned on the driver, class by class of containers that are filled alike. The plan is a list of
runs of slots per length, and a document takes the slot of its rank among the documents of its length. Ranks
come from salted counts and offsets, with as many salts as the count of a length asks for, so a length that a third
of all documents share is still ranked in many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagelode.llm.tokens import VOCABULARY, Encoded, cut_plain, vocabulary
from pagelode.session import materialize


@dataclass
class _Class:
    """Containers filled alike: how many, room left, and the chain of (length, items per container)."""

    count: int
    room: int
    chain: tuple | None


def plan_slots(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Runs of slots: (length, first rank, last rank, first container, items per container, fill).

    The item of rank r (from 0) goes to container ``first container + (r - first rank) // items``. Works on
    counts: longest first, into the fullest containers with room (best fit), else into new ones.
    """
    rooms: dict[int, list[_Class]] = {}
    done: list[_Class] = []

    def put(c: _Class) -> None:
        (rooms.setdefault(c.room, []) if c.room else done).append(c)

    for length in sorted((n for n in histogram if n > 0), reverse=True):
        if length > capacity:
            raise ValueError("items longer than a container must be divided first")
        left = histogram[length]
        for room in sorted(r for r in rooms if r >= length):
            if not left:
                break
            fit = room // length
            classes = rooms.pop(room)
            while classes and left:
                c = classes.pop()
                full = min(c.count, left // fit)
                if full:
                    put(_Class(full, room - fit * length, (c.chain, length, fit)))
                    left -= full * fit
                rest = c.count - full
                if rest and 0 < left < fit:
                    put(_Class(1, room - left * length, (c.chain, length, left)))
                    rest, left = rest - 1, 0
                if rest:
                    classes.append(_Class(rest, room, c.chain))
            if classes:
                rooms.setdefault(room, []).extend(classes)
        if left:
            fit = capacity // length
            if left // fit:
                put(_Class(left // fit, capacity - fit * length, (None, length, fit)))
            if left % fit:
                put(_Class(1, capacity - (left % fit) * length, (None, length, left % fit)))
    runs, rank, base = [], {}, 0
    for c in [*done, *(c for cs in rooms.values() for c in cs)]:
        chain = c.chain
        while chain is not None:
            chain, length, items = chain
            first = rank.get(length, 0)
            last = first + items * c.count - 1
            runs.append((length, first, last, base, items, capacity - c.room))
            rank[length] = last + 1
        base += c.count
    return runs


def measured_pieces(docs: DataFrame, doc_id: str, text: str, capacity: int, vocab_path: str = VOCABULARY) -> DataFrame:
    """(doc_id, piece, start, end, n_tokens): one row per text; texts above ``capacity`` tokens in several pieces.

    start and end are character offsets. Null and empty texts are one piece of no tokens.
    """
    src = docs.filter(F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    names = ["doc_id", "piece", "start", "end", "n_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(vocab_path)
        for b in batches:
            rows = []
            for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                t = t or ""
                n = 0 if not t else vocab.count(t) if len(t) <= capacity else None
                if n is None or n > capacity:
                    e = Encoded(t, vocab)
                    if e.n > capacity:
                        rows += [(d, i, e.char_at(s), e.char_at(x), x - s) for i, (s, x) in enumerate(cut_plain(e, capacity))]
                        continue
                    n = e.n
                rows.append((d, 0, 0, len(t), n))
            cols = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(list(cols[0]), pa.int64()), *(pa.array(list(c), pa.int32()) for c in cols[1:])], names=names)

    return src.mapInArrow(run, "doc_id bigint, piece int, start int, end int, n_tokens int")


def pack(items: DataFrame, capacity: int, per_salt: int = 100_000) -> DataFrame:
    """Adds ``container`` and its ``fill`` to items (doc_id, piece, n_tokens <= capacity).

    Items of no tokens need no slot: they go to container 0. An empty table gives an empty result; equal rows
    take slots of their own. ``per_salt`` is about how many items of a length one task ranks; any value gives a full plan.
    """
    spark = items.sparkSession
    hist = {r["n_tokens"]: r["n"] for r in items.filter("n_tokens > 0").groupBy("n_tokens").agg(F.count("*").alias("n")).collect()}
    runs = plan_slots(hist, capacity)
    plan = spark.createDataFrame(runs or [(0, 0, -1, 0, 1, 0)], "n_tokens int, lo bigint, hi bigint, base bigint, items int, fill int")
    fill0 = next((r[5] for r in runs if r[3] == 0), 0)

    # One row per length, at most ``capacity`` of them; likewise the plan has a few runs per length, whatever the counts.
    salts = spark.createDataFrame([(n, -(-c // per_salt)) for n, c in hist.items()], "n_tokens int, _salts bigint")
    salted = items.filter("n_tokens > 0").join(F.broadcast(salts), "n_tokens").withColumn("_s", F.pmod(F.xxhash64("doc_id", "piece"), "_salts"))
    counts = salted.groupBy("n_tokens", "_s").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("n_tokens").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("n_tokens", "_s", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o"))
    own = Window.partitionBy("n_tokens", "_s").orderBy("doc_id", "piece")
    ranked = salted.withColumn("_r", F.row_number().over(own) - 1).join(offsets, ["n_tokens", "_s"])
    ranked = ranked.withColumn("_rank", F.col("_r") + F.col("_o"))
    placed = ranked.join(F.broadcast(plan), "n_tokens").filter("_rank BETWEEN lo AND hi")
    cols = items.columns
    return placed.select(
        *cols, (F.col("base") + F.floor((F.col("_rank") - F.col("lo")) / F.col("items"))).alias("container"), "fill"
    ).unionByName(
        items.filter("n_tokens = 0 OR n_tokens IS NULL").select(*cols, F.lit(0).cast("bigint").alias("container"), F.lit(fill0).cast("int").alias("fill"))
    )


def packed_documents(docs: DataFrame, doc_id: str, text: str, capacity: int = 2048, vocab_path: str = VOCABULARY) -> DataFrame:
    """Containers of all texts or pieces: (doc_id, piece, start, end, n_tokens, container, fill)."""
    return pack(materialize(measured_pieces(docs, doc_id, text, capacity, vocab_path), "pieces"), capacity)
