"""Several values packed in one field: one row per value, position kept.

A finite-state tokenizer walks the lexemes of a cell (quotes, brackets, separators, runs of
anything else) and keeps three things: whether it is inside quotes, which escapes were seen, and how
deep it is inside brackets. A separator ends a value only outside quotes and at depth zero.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Separators, quotation marks with their closing marks, bracket pairs.
SEPARATORS = ",;|/\n\r\t、；，｜"
QUOTES = {'"': '"', "'": "'", "“": "”", "„": "“", "‘": "’", "«": "»"}
BRACKETS = {"[": "]", "(": ")", "{": "}"}

_CLOSERS = {v: k for k, v in BRACKETS.items()}
_OPENERS = set(BRACKETS)
_LEX = re.compile(
    r"[" + re.escape(SEPARATORS) + r"]"
    r"|[" + re.escape("".join(_OPENERS) + "".join(_CLOSERS)) + r"]"
    r"|[\"'“”„‘’«»\\]"
    r"|[^" + re.escape(SEPARATORS + "".join(_OPENERS) + "".join(_CLOSERS) + "\"'“”„‘’«»\\") + r"]+"
)
_NUMBER = r"[-+]?(?:0[xX][0-9A-Fa-f]+|0[bB][01]+|\d+(?:\.\d+)?)"
_INTERVAL_INSIDE = re.compile(rf"\s*{_NUMBER}\s*[,;]\s*{_NUMBER}\s*")
#: Words before a list in brackets, as many as there are.
_LEADING_WORD = re.compile(r"[^\W\d]\w*(?:\s+\w+)*\s*[:=]?\s*(?=[\[({])")
_LABEL_END = re.compile(r"[=:]\s*$")


def _closing(lex: list[str], i: int) -> int | None:
    """Index of the lexeme that closes the quote opened at ``i``; None if it stays open."""
    close = QUOTES[lex[i]]
    j = i + 1
    while j < len(lex):
        if lex[j] == "\\" and j + 1 < len(lex) and lex[j + 1] in (close, "\\"):
            j += 2
        elif lex[j] == close:
            if j + 1 < len(lex) and lex[j + 1] == close:
                j += 2
            else:
                return j
        else:
            j += 1
    return None


def _unquoted(lex: list[str], i: int, j: int) -> str:
    """Text between the quotes at ``i`` and ``j`` with doubled and escaped marks made single."""
    close = QUOTES[lex[i]]
    out, k = [], i + 1
    while k < j:
        if k + 1 < j and ((lex[k] == close and lex[k + 1] == close) or (lex[k] == "\\" and lex[k + 1] in (close, "\\"))):
            out.append(lex[k + 1])
            k += 2
        else:
            out.append(lex[k])
            k += 1
    return "".join(out)


def _tokens(text: str) -> Iterator[str]:
    """Values of a list without its wrapper."""
    lex = _LEX.findall(text)
    n = len(lex)
    i, depth, start, whole = 0, 0, 0, None  # whole: the value, if quotes enclose all of it
    while i <= n:
        x = lex[i] if i < n else None
        if x is None or (depth == 0 and len(x) == 1 and x in SEPARATORS):
            raw = "".join(lex[start:i]).strip()
            value = whole[1] if whole and not "".join(lex[start : whole[0]]).strip() and not "".join(lex[whole[2] + 1 : i]).strip() else raw
            if value.strip():
                yield value.strip()
            start, whole = i + 1, None
        elif x in QUOTES:
            before = "".join(lex[start:i]) if whole is None else "x"
            if not before.strip() or _LABEL_END.search(before):
                j = _closing(lex, i)
                if j is not None:
                    if not before.strip():
                        whole = (i, _unquoted(lex, i, j), j)
                    i = j
        elif x in _OPENERS:
            depth += 1
        elif x in _CLOSERS and depth:
            depth -= 1
        i += 1


def _wrapped(text: str) -> str | None:
    """What a bracket pair around the whole text encloses; None without such a pair."""
    if len(text) < 2 or text[0] not in _OPENERS or text[-1] not in _CLOSERS:
        return None
    lex, depth, i = _LEX.findall(text), 0, 0
    fresh = False  # at the start of an item, where a quotation mark may open
    while i < len(lex):
        x = lex[i]
        if x in QUOTES and fresh and (j := _closing(lex, i)) is not None:
            i, fresh = j, False
        elif x in _OPENERS:
            depth, fresh = depth + 1, True
        elif x in _CLOSERS:
            depth, fresh = depth - 1, False
            if depth == 0 and i < len(lex) - 1:
                return None
        elif x.strip():
            fresh = x in SEPARATORS
        i += 1
    return text[1:-1] if depth == 0 and BRACKETS[text[0]] == text[-1] else None


def split_packed(text: str | None, form: str | None = None) -> list[str]:
    """Values of one cell in order.

    ``form`` is the cell's notation: ``other`` is prose and holds none; under ``range`` two numbers
    in one pair of brackets are one interval, otherwise a list. Null and blank cells hold none.
    An unclosed quotation mark is an ordinary character; unbalanced brackets are part of values.
    """
    kind = (form or "").strip().lower()
    if text is None or kind == "other":
        return []
    s = text.strip()
    while True:
        if m := _LEADING_WORD.match(s):
            rest = s[m.end() :].strip()
            if _wrapped(rest) is not None:
                s = rest
        inner = _wrapped(s)
        if inner is None or (kind == "range" and _INTERVAL_INSIDE.fullmatch(inner)):
            break
        s = inner.strip()
    if kind == "range" and _wrapped(s) is not None:
        return [s]
    return list(_tokens(s))


def explode_packed(df: DataFrame, value: str, form: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """One row per value of ``df[value]``: ``keep`` columns, ``pos`` (bigint from 1), ``val``, ``n_vals``.

    Cells without values give no row. Extra columns of ``df`` are dropped unless in ``keep``, so
    columns named pos, val or n_vals there do no harm. No shuffle; works batch by batch.
    """
    keep = list(keep or [])
    names = [f"_k{i}" for i in range(len(keep))]
    src = df.select(
        *(F.col(k).alias(n) for k, n in zip(keep, names)),
        F.col(value).cast("string").alias("_v"),
        (F.col(form).cast("string") if form else F.lit(None).cast("string")).alias("_f"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cells = [split_packed(v, f) for v, f in zip(b.column("_v").to_pylist(), b.column("_f").to_pylist())]
            sizes = [len(c) for c in cells]
            take = pa.array([i for i, n in enumerate(sizes) for _ in range(n)], pa.int64())
            cols = [b.column(n).take(take) for n in names]
            cols.append(pa.array([p + 1 for n in sizes for p in range(n)], pa.int64()))
            cols.append(pa.array([v for c in cells for v in c], pa.string()))
            cols.append(pa.array([n for n in sizes for _ in range(n)], pa.int64()))
            yield pa.RecordBatch.from_arrays(cols, names=[*names, "pos", "val", "n_vals"])

    schema = ", ".join([*(f"`{n}` {src.schema[n].dataType.simpleString()}" for n in names), "pos bigint, val string, n_vals bigint"])
    out = src.mapInArrow(run, schema)
    return out.select(*(F.col(n).alias(k) for n, k in zip(names, keep)), "pos", "val", "n_vals")
