"""Evaluation passages inside a corpus: Wu-Manber multi-pattern search over words.

Every run of ``size`` consecutive words of an evaluation text is a pattern. The text is read in windows of that
size; the block of two words at the window's end is looked up in a shift table. A block in no pattern
lets the window jump ``size - 1`` words, so most of a corpus is skipped; a block that ends a pattern selects
its suffix bucket, in which a 64-bit hash of the window finds the few patterns that are compared word by word.
"""

from __future__ import annotations

import re
import unicodedata
from array import array
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_WORD = re.compile(r"[^\W_]+")
#: Words of a block.
BLOCK = 2


def words(text: str | None) -> list[str]:
    """Runs of letters and digits without regard to case."""
    if not text:
        return []
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)
    return _WORD.findall(text.casefold())


#: Multiplier of the window's hash, an odd 64-bit number.
_PRIME, _MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1


class WuManber:
    """Shift table and suffix buckets of all ``size``-word runs of some texts (item, text).

    Words of the texts are numbers; a block is one number of two words. ``table`` gives its shift or, where the shift
    is 0, the complement of its bucket, a stretch of the runs sorted by block and hash. About 150 bytes a word.
    """

    def __init__(self, texts: list[tuple[int, str]], size: int = 12):
        self.size, self.jump = size, size - BLOCK + 1
        self.known: dict[str, int] = {}
        flat, item, ends = array("i"), array("q"), array("i")
        lo: dict[int, int] = {}
        number, place = self.known, {}
        split = [(i, words(t)) for i, t in texts]
        split = [(i, ws) for i, ws in split if len(ws) >= size]
        for _, ws in split:
            for w in ws:
                number.setdefault(w, len(number))
        self.base = base = len(number) + 1
        for i, ws in split:
            start = len(flat)
            flat.extend(number[w] for w in ws)
            item.extend([i] * len(ws))
            ends.extend(range(start + size - 1, start + len(ws)))
            for q in range(1, len(ws)):
                # The block ends at word q; in the run that ends last after it, it is as near to the end as possible.
                least = 0 if q >= size - 1 else size - 1 - q
                block = flat[start + q - 1] * base + flat[start + q]
                if least < lo.get(block, self.jump):
                    lo[block] = least
        at = np.frombuffer(ends, dtype=np.int32) if ends else np.zeros(0, dtype=np.int32)
        ids = np.frombuffer(flat, dtype=np.int32).astype(np.uint64) if flat else np.zeros(0, dtype=np.uint64)
        with np.errstate(over="ignore"):
            h = np.zeros(len(at), dtype=np.uint64)
            for j in range(size - 1, -1, -1):
                h = h * np.uint64(_PRIME) + ids[at - j] + np.uint64(1)
        block = ids[at - 1] * np.uint64(base) + ids[at] if len(at) else h
        order = np.lexsort((h, block))
        self.hashes = array("Q", h[order].tobytes())
        self.ends = array("i", at[order].astype(np.int32).tobytes())
        self.flat, self.item = flat, item
        blocks, first = np.unique(block[order], return_index=True)
        self.bounds = array("q", np.append(first, len(order)).astype(np.int64).tobytes())
        for n, b in enumerate(blocks.tolist()):
            place[b] = ~n
        self.table = {b: place.get(b, s) if s == 0 else s for b, s in lo.items()}

    def search(self, ws: list[str]) -> set[int]:
        """Items with at least one run in ``ws``."""
        found: set[int] = set()
        known, table, base, jump, size, n = self.known.get, self.table.get, self.base, self.jump, self.size, len(ws)
        i = size - 1
        while i < n:
            b = known(ws[i])
            a = None if b is None else known(ws[i - 1])
            s = jump if a is None else table(a * base + b, jump)
            if s > 0:
                i += s
                continue
            run = array("i", [known(w, -1) for w in ws[i - size + 1 : i + 1]])
            if min(run) >= 0:
                h = 0
                for x in run:
                    h = (h * _PRIME + x + 1) & _MASK
                k, stop = self.bounds[~s], self.bounds[~s + 1]
                k = bisect_left(self.hashes, h, k, stop)
                while k < stop and self.hashes[k] == h:
                    end = self.ends[k]
                    if self.flat[end - size + 1 : end + 1] == run:
                        found.add(self.item[end])
                    k += 1
            i += 1
        return found


#: Searches of this worker by the number of their broadcast: built once, not once per task; the last two are kept.
_BUILT: dict[tuple[int, int], WuManber] = {}


def _built(number: int, texts: list[tuple[int, str]], size: int) -> WuManber:
    if (number, size) not in _BUILT:
        while len(_BUILT) > 1:
            del _BUILT[next(iter(_BUILT))]
        _BUILT[number, size] = WuManber(texts, size)
    return _BUILT[number, size]


def leaked_items(
    corpus: DataFrame, items: DataFrame, doc_id: str, doc_text: str, item_id: str, item_text: str,
    size: int = 12, block_chars: int = 8_000_000,
) -> DataFrame:
    """(``doc_id``, ``item_id``) of every document that shares ``size`` consecutive words with an item.

    Items are a stated query set: they are read in blocks of about ``block_chars`` characters (a million words, 150 MB in
    a worker), each block searched against all documents, so that no worker and not the driver holds more than one block
    at a time. Null and empty texts, and items shorter than ``size`` words, match nothing; equal items are reported each;
    repeated rows come out once.
    """
    sc = corpus.sparkSession.sparkContext
    plain = items.select(F.col(item_id).cast("bigint").alias("item"), F.col(item_text).alias("text")).filter("text IS NOT NULL AND item IS NOT NULL")
    docs = corpus.select(F.col(doc_id).cast("bigint").alias("doc"), F.col(doc_text).alias("text")).filter("text IS NOT NULL AND doc IS NOT NULL")
    schema = f"`{doc_id}` bigint, `{item_id}` bigint"

    def scan(texts: list[tuple[int, str]]) -> DataFrame:
        table = sc.broadcast(texts)
        number = table._jbroadcast.id() if table._jbroadcast is not None else id(table)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            search = _built(number, table.value, size)
            for batch in batches:
                docs_, items_ = [], []
                for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    ws = words(t)
                    if len(ws) >= size:
                        for it in search.search(ws):
                            docs_.append(d)
                            items_.append(it)
                yield pa.RecordBatch.from_arrays([pa.array(docs_, pa.int64()), pa.array(items_, pa.int64())], names=[doc_id, item_id])

        return docs.mapInArrow(run, schema)

    out, block, chars = None, [], 0
    for r in plain.toLocalIterator():
        block.append((r["item"], r["text"]))
        chars += len(r["text"])
        if chars >= block_chars:
            out = scan(block) if out is None else out.unionByName(scan(block))
            block, chars = [], 0
    if block or out is None:
        out = scan(block) if out is None else out.unionByName(scan(block))
    return out.distinct()
