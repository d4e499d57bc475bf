"""Splitting texts above a token limit at natural boundaries, with overlap.

A recursive hierarchy of separators (section, paragraph, sentence, word, character) turns a text into units small
enough to follow an overlap; units are packed greedily up to the limit, and the next piece starts that many
tokens before the end of the last. All offsets come from one encoding of the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelode.llm.tokens import VOCABULARY, Encoded, vocabulary

#: Where the next unit starts, from coarse to fine, over UTF-8 bytes.
_LEVELS = [
    re.compile(rb"(?m)(?=^#{1,6} )|(?<=\f)|(?=^\d+(?:\.\d+)*\.? {1,3}[A-Z])"),
    re.compile(rb"(?:\r?\n|\r)[ \t]*(?:\r?\n|\r)\s*"),
    re.compile(rb"(?<=[.!?])[\"')\]]*\s+|(?<=\xe3\x80\x82)\s*|[\r\n]+"),
]
NAMES = ["section", "paragraph", "sentence", "word", "character"]


def _boundaries(e: Encoded, level: int) -> np.ndarray:
    """Token boundaries at or next after the unit starts of a level (the start of the text excluded)."""
    if level == 3:
        return np.flatnonzero(e.word[:-1])
    if level >= 4:
        return np.flatnonzero(e.whole[:-1])
    ends = np.fromiter((m.end() for m in _LEVELS[level].finditer(e.raw)), dtype=np.int64)
    # A mark inside a token (white space is often one) moves back to the token's start.
    at = np.searchsorted(e.byte_at, ends, side="right") - 1
    at = np.unique(at[(at > 0) & (at < e.n)])
    return at[e.whole[at]]


def units(e: Encoded, limit: int) -> list[tuple[int, int, int]]:
    """(start, end, level) of consecutive units of at most ``limit`` tokens; level is where the unit begins."""
    known: dict[int, np.ndarray] = {}
    out: list[tuple[int, int, int]] = []
    todo = [(0, e.n, 0, 0)]
    while todo:
        start, end, level, began = todo.pop()
        if end - start <= limit:
            out.append((start, end, began))
            continue
        if level > 4:
            cuts = list(range(start + limit, end, limit))
        else:
            if level not in known:
                known[level] = _boundaries(e, level)
            b = known[level]
            cuts = b[np.searchsorted(b, start, "right") : np.searchsorted(b, end, "left")].tolist()
            if level >= 3:  # words and characters: only as many as the limit asks for
                cuts = _every(cuts, start, end, limit)
        edges = [start, *cuts, end]
        parts = [(a, z, level + 1, began if a == start else level) for a, z in zip(edges, edges[1:])]
        todo.extend(reversed(parts))
    return out


def _every(cuts: list[int], start: int, end: int, limit: int) -> list[int]:
    """The last of ``cuts`` within each ``limit`` tokens."""
    out, last, i = [], start, 0
    while end - last > limit and i < len(cuts):
        j = i
        while j < len(cuts) and cuts[j] - last <= limit:
            j += 1
        k = j - 1 if j > i else i
        out.append(cuts[k])
        last, i = cuts[k], k + 1
    return out


def split_tokens(e: Encoded, limit: int, overlap: int) -> list[tuple[int, int, int]]:
    """(start, end, level of the cut before) of pieces in tokens; a text within the limit is one piece."""
    if e.n <= limit:
        return [(0, e.n, 0)]
    us = units(e, limit - overlap)
    out: list[tuple[int, int, int]] = []
    i, start, level = 0, 0, 0
    while i < len(us):
        end, j = us[i][1], i + 1
        # The coarsest unit boundary in reach would waste room: pieces are packed greedily.
        while j < len(us) and us[j][1] - start <= limit:
            end, j = us[j][1], j + 1
        fit = e.fitting(start, end, limit, us[i][0])
        if fit < end:  # a cut inside a word took more tokens than its share
            while j > i + 1 and us[j - 1][0] >= fit:
                j -= 1
            us[j - 1] = (fit, us[j - 1][1], 4)
            j, end = j - 1, fit
        out.append((start, end, level))
        if j >= len(us):
            break
        i, level = j, us[j][2]
        back = max(start + 1, end - overlap)
        at = e.back(e.word, back, max(start, back - 8)) or e.back(e.whole, back, start)
        start = at if at is not None else back
    return out


def split_documents(
    docs: DataFrame, doc_id: str, text: str, limit: int = 512, overlap: int = 64, vocab_path: str = VOCABULARY, all_texts: bool = False
) -> DataFrame:
    """Pieces of texts above ``limit`` tokens: (doc_id, piece, start, end, n_tokens, cut, text).

    start and end are character offsets; ``cut`` names the boundary the piece's new text begins at. Consecutive
    pieces share ``overlap`` tokens (up to 8 more to begin at a word, or where a character would be divided). With ``all_texts``
    shorter texts come out as one piece; null and empty texts give none. No shuffle.
    """
    if not 0 <= overlap < limit:
        raise ValueError("the overlap must be smaller than the limit")
    src = docs.filter(F.col(doc_id).isNotNull() & (F.length(text) > (0 if all_texts else limit // 4))).select(
        F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(vocab_path)
        for b in batches:
            rows = []
            for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                e = Encoded(t, vocab, -1 if all_texts else limit)
                if e.n > limit or all_texts:
                    for i, (s, x, lv) in enumerate(split_tokens(e, limit, overlap)):
                        rows.append((d, i, e.char_at(s), e.char_at(x), x - s, NAMES[min(lv, 4)] if i else "start", e.text(s, x)))
            cols = list(zip(*rows)) or [[]] * 7
            types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], names=["doc_id", "piece", "start", "end", "n_tokens", "cut", "text"])

    return src.mapInArrow(run, "doc_id bigint, piece int, start int, end int, n_tokens int, cut string, text string")
