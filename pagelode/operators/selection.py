"""The block selection language: ``p1``, ``1``, ``1-3``, ``p1_20``, ``p1_10-p2_20``, joined by commas."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelode.functions.text import blank_to_null
from pagelode.operators.blocks import reading_position

#: Words for a page that may stand before or after a number.
_WORDS = re.compile(r"(?i)(pages?|page|p\.|페이지|쪽)")


@dataclass(frozen=True)
class Pages:
    first: int
    last: int


@dataclass(frozen=True)
class Blocks:
    first: str
    last: str


def _token(raw: str) -> str:
    t = re.sub(r"\s+", "", _WORDS.sub("p", raw.strip())).lower().replace("–", "-").replace("~", "-")
    t = re.sub(r"(\d+)p(?!\d)", r"p\1", t)
    t = re.sub(r"(?<![\dp_])(\d+)", r"p\1", t)
    return re.sub(r"p+", "p", re.sub(r"_b(\d+)", r"_\1", t))


def parse_selection(spec: str) -> list[Pages | Blocks]:
    """Pieces of a selection; ValueError for an empty or unreadable one."""
    out: list[Pages | Blocks] = []
    for raw in (spec or "").split(","):
        if not raw.strip():
            continue
        t = _token(raw)
        if m := re.fullmatch(r"p(\d+)_(\d+)(?:-p(\d+)_(\d+))?", t):
            a = f"p{int(m[1])}_b{int(m[2])}"
            out.append(Blocks(a, f"p{int(m[3])}_b{int(m[4])}" if m[3] else a))
        elif m := re.fullmatch(r"p(\d+)(?:-p?(\d+))?", t):
            a, b = int(m[1]), int(m[2] or m[1])
            out.append(Pages(min(a, b), max(a, b)))
        else:
            raise ValueError(f"unreadable selection: {raw.strip()}")
    if not out:
        raise ValueError("the selection is empty")
    return out


def select_blocks(blocks: DataFrame, spec: str, check: bool = True) -> DataFrame:
    """Blocks of one document with text that the selection names, in ``read_pos`` order.

    Ranges of blocks run over the reading order, both ends included and in either direction. With
    ``check`` an unknown block or an empty result is a ValueError. Only the named end blocks are collected.
    """
    parts = parse_selection(spec)
    ordered = reading_position(blocks)
    ends = sorted({b for p in parts if isinstance(p, Blocks) for b in (p.first, p.last)})
    place = {}
    if ends:
        place = {r["block_id"]: r["p"] for r in ordered.filter(F.col("block_id").isin(ends)).groupBy("block_id").agg(F.max("read_pos").alias("p")).collect()}
    wanted = F.lit(False)
    for p in parts:
        if isinstance(p, Pages):
            wanted = wanted | F.col("page").between(p.first, p.last)
            continue
        for b in (p.first, p.last):
            if b not in place and check:
                raise ValueError(f"no such block: {b}")
        if p.first in place and p.last in place:
            wanted = wanted | F.col("read_pos").between(*sorted((place[p.first], place[p.last])))
    out = ordered.filter(wanted & blank_to_null("raw_text").isNotNull())
    if check and out.isEmpty():
        raise ValueError("nothing with text is selected")
    return out
