"""Noise in text read from scanned pages: broken words, misread characters, running lines, page numbers.

1. One pass over all blocks counts words (pre-aggregated in each task): the lexicon.
2. Anagram hashes: a word's hash is the sum of its characters' values, so what remains after removing one or two
   neighbouring characters is a difference of hashes. Rare words meet frequent ones on (position, remainder)
   in SQL; each meeting is a confusion such as ``cl``→``d``. Confusions are ranked by how many different
   words show them, corrections by that rank and by frequency.
3. One pass over scanned blocks emits suspicious words, words broken at line ends with the readings the
   break allows, and the outermost lines; joins with the lexicon decide about each.
"""

from __future__ import annotations

import itertools
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelode.session import materialize

#: Marks that break a word at a line end; the last two never belong to a compound.
_MARKS = "-‐¬­"
_SOFT = "¬­"
_EDGE_PUNCT = ".,:;()[]{}<>|\"'“”‘’!?*•–—-‐¬­/\\"
_BREAK = re.compile(rf"[{_MARKS}][ \t\r]*\n[ \t]*(?=[^\W_])")
_HEAD = re.compile(r"\S*$")
_NEXT = re.compile(r"\S+")
_PART = re.compile(r"[-‐]")
_IDENT = re.compile(r"_|^0[xX]|^[\W\d]+$|/")
_PARTS = re.compile(r"\s{2,}|\t|\s\|\s")
#: Page number forms, arabic or roman; the number is compared with the page.
_PAGE_NO = re.compile(r"[^\w]*(?:(?:page|pg|p|seite)[^\w]*)?(?:(\d{1,9})(?:\s*(?:of|/|von)\s*\d+)?|([ivxlc]+))[^\w]*")
_ROMAN = re.compile(r"(c{0,3})(xc|xl|l?x{0,3})(ix|iv|v?i{0,3})")


@dataclass(frozen=True)
class OcrRules:
    """Thresholds; all counts are over the whole corpus."""

    common: int = 20_000  # words kept in every worker to skip what needs no look-up (no effect on results)
    min_known: int = 5  # occurrences of a word that others may be corrected to
    ratio: int = 10  # how many times more frequent it must be
    min_support: int = 3  # different words that must show a confusion of letters alone
    sound_share: float = 0.1  # of the rate of a word in scanned text that it must reach in sound text to be trusted
    edge_lines: int = 2  # outermost lines of a page looked at for themselves; deeper ones only behind noise
    near_pages: int = 64  # pages within which a running line stands again
    near_share: float = 0.5  # of its pages in a document that must have it again so near
    other_docs: int = 2  # documents with a running line that make it one in others too,
    other_share: float = 0.25  # if they are this share of the documents that have it at an edge


def _key(word: str) -> str:
    """Lower case, except where capitals stand with digits or signs: those may be identifiers of their own."""
    return word if word.isupper() and not word.isalpha() else word.lower()


def _clean(token: str) -> str:
    return _key(token.strip(_EDGE_PUNCT))


def _roman(text: str) -> int | None:
    m = _ROMAN.fullmatch(text)
    if not m or not text:
        return None
    values = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100}
    ns = [values[c] for c in text]
    return sum(-a if a < b else a for a, b in zip(ns, [*ns[1:], 0]))


def _ordinary(word: str) -> bool:
    """A word that may be misread: it has a letter, and is no identifier, opcode or number."""
    return len(word) > 1 and not _IDENT.search(word) and any(c.isalpha() for c in word)


def _breaks(text: str) -> Iterator[tuple[int, int, int, int]]:
    """(start of the left part, mark, start and end of the right part) of words broken at line ends."""
    for m in _BREAK.finditer(text):
        mark, right = m.start(), m.end()
        line = text.rfind("\n", 0, mark) + 1
        left = line + _HEAD.search(text[line:mark]).start()
        if any(c.isalpha() for c in text[left:mark]) and "\n" not in text[mark + 1 : right].replace("\n", "", 1):
            yield left, mark, right, _NEXT.match(text, right).end()


def _tokens(text: str, joined: Counter) -> list[str]:
    """Tokens of a text without the parts of broken words, which are counted joined."""
    if "\n" not in text:
        return text.split()
    kept, at = [], 0
    for left, mark, right, end in _breaks(text):
        joined[_key(_joined(text[left:mark].strip(_EDGE_PUNCT), text[right:end].strip(_EDGE_PUNCT)))] += 1
        if left > at:
            kept.append(text[at:left])
        at = max(at, end)
    return text.split() if not at else (" ".join(kept) + " " + text[at:]).split()


def _words_of(token: str) -> list[str]:
    """Words of one token: its parts, and the compound they make."""
    w = _clean(token)
    if not _ordinary(w):
        return []
    parts = _PART.split(w)
    words = [p for p in parts if _ordinary(p)]
    return [*words, "-".join(parts)] if len(parts) > 1 else words


def _joined(left: str, right: str) -> str:
    """The word that spans a break, without other parts of a compound."""
    return _PART.split(left)[-1] + _PART.split(right)[0]


def word_counts(blocks: DataFrame) -> DataFrame:
    """(word, n_sound, n_ocr, n_joined) over ``text`` of blocks (is_ocr, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, joined = (Counter(), Counter()), Counter()

        def flush() -> pa.RecordBatch:
            table: dict[str, list[int]] = {}
            for col in (0, 1):
                for token, n in raw[col].items():
                    for w in _words_of(token):
                        table.setdefault(w, [0, 0, 0])[col] += n
                raw[col].clear()
            for w, n in joined.items():
                table.setdefault(w, [0, 0, 0])[2] += n
            joined.clear()
            cols = list(zip(*table.values())) or [[], [], []]
            return pa.RecordBatch.from_arrays([pa.array(list(table), pa.string()), *(pa.array(list(c), pa.int64()) for c in cols)], names=["word", "n_sound", "n_ocr", "n_joined"])

        for b in batches:
            for ocr, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                raw[1 if ocr else 0].update(_tokens(text, joined))
            if len(raw[0]) + len(raw[1]) > 300_000:
                yield flush()
        yield flush()

    counted = blocks.filter(F.length("text") > 0).select("is_ocr", "text").mapInArrow(run, "word string, n_sound bigint, n_ocr bigint, n_joined bigint")
    return counted.groupBy("word").agg(*(F.sum(c).alias(c) for c in ("n_sound", "n_ocr", "n_joined")))


#: Confusions looked for, as characters read and meant: one for one, one for two, two for one.
_CUTS = ((1, 1), (1, 2), (2, 1))


def _remainders(words: DataFrame, name: str, side: int) -> DataFrame:
    """(meet, at, cut, word): the anagram hash of a word without 1 or 2 neighbouring characters, per position.

    ``meet`` also holds the place, what follows it and the kind of confusion, so that only words of fitting length meet:
    as many as the alphabet has characters to differ in, however many words there are.
    """
    value = "transform(split(lower(word), ''), c -> shiftright(xxhash64(c), 16))"
    v = words.withColumn("_v", F.expr(value)).withColumn("_h", F.expr("aggregate(_v, 0L, (a, x) -> a + x)"))
    each = [
        f"if(size(_v) > {c[side]}, transform(sequence(0, size(_v) - {c[side]}), i -> struct(i AS at, {c[side]} AS cut, "
        f"xxhash64(i, size(_v) - i - {c[side]}, {10 * c[0] + c[1]}, _h - aggregate(slice(_v, i + 1, {c[side]}), 0L, (a, x) -> a + x)) AS meet)), array())"
        for c in _CUTS
    ]
    out = v.select("word", "n", F.explode(F.expr(f"concat({', '.join(each)})")).alias("_x"))
    return out.select(F.col("word").alias(name), F.col("n").alias(f"n_{name}"), "_x.meet", F.col("_x.at").alias(f"at_{name}"), F.col("_x.cut").alias(f"cut_{name}"))


def trusted(lexicon: DataFrame, rules: OcrRules) -> Column:
    """Whether sound text vouches for a word: it has it twice, and not far more rarely than scanned text has it.

    A rate, since in enough sound text every misreading occurs by chance.
    """
    n = lexicon.agg(F.coalesce(F.sum("n_sound"), F.lit(0)).alias("s"), F.coalesce(F.sum("n_ocr"), F.lit(0)).alias("o")).first()
    return (F.col("n_sound") >= 2) & (F.col("n_sound") * float(n["o"]) >= F.col("n_ocr") * (rules.sound_share * n["s"]))


#: Letters without case count as lower case: a word of them may be meant too. Ligatures are never meant.
_LETTER = r"\p{Ll}\p{Lo}\p{M}"


def corrections(lexicon: DataFrame, rules: OcrRules = OcrRules()) -> DataFrame:
    """Ranked corrections, one per rare word: (word, fix, at, seg): ``seg`` characters from ``at`` (0-based) are misread.

    A trusted word is never corrected.
    """
    n = F.col("n_sound") + F.col("n_ocr")
    words = lexicon.filter(~F.col("word").contains("-"))
    known = words.filter(F.col("word").rlike(rf"^[{_LETTER}&&[^ﬀ-ﬆ]]{{2,}}$") & (n >= rules.min_known)).select("word", n.alias("n"))
    rare = words.filter(~trusted(lexicon, rules)).select("word", n.alias("n"))
    r, k = _remainders(rare, "rare", 0), _remainders(known, "known", 1)
    met = r.join(k, "meet").filter(f"n_known >= n_rare * {rules.ratio} AND rare <> known AND at_rare = at_known").withColumnRenamed("at_rare", "at").drop("at_known", "meet")
    met = met.filter(
        "left(lower(rare), at) = left(known, at) AND substring(lower(rare), at + cut_rare + 1) = substring(known, at + cut_known + 1)"
    ).withColumns({"wrong": F.expr("substring(lower(rare), at + 1, cut_rare)"), "right": F.expr("substring(known, at + 1, cut_known)")})
    # A longer confusion that only repeats a shorter one beside an equal character says nothing new.
    met = met.filter("left(wrong, 1) <> left(right, 1) AND right(wrong, 1) <> right(right, 1)")
    # Shapes are alike both ways: what is read for "cl" supports "cl" read for it.
    both_ways = met.select("wrong", "right", "rare").unionByName(met.select(F.col("right").alias("wrong"), F.col("wrong").alias("right"), "rare"))
    support = both_ways.groupBy("wrong", "right").agg(F.count_distinct("rare").alias("support"))
    ranked = met.join(support, ["wrong", "right"])
    strange = F.col("wrong").rlike(rf"[^{_LETTER}]|[ﬀ-ﬆ]")
    ranked = ranked.filter(strange | (F.col("support") >= rules.min_support))
    best = ranked.groupBy("rare").agg(
        F.max_by(F.struct("known", "at", F.col("cut_rare").alias("seg")), F.struct("support", "n_known", "known")).alias("b")
    )
    out = best.select(F.col("rare").alias("word"), F.col("b.known").alias("fix"), F.col("b.at").alias("at"), F.col("b.seg").alias("seg"))
    # A word with two misread characters leads to a frequent word with one: follow that step.
    second = out.select(F.col("word").alias("fix"), F.col("fix").alias("fix2"))
    return out.join(second, "fix", "left").select("word", F.coalesce("fix2", "fix").alias("fix"), "at", "seg")


def _may_run(line: str) -> bool:
    """A line that may be a running line or a page number: it ends like no sentence, or a part of it is a number."""
    line = line.strip()
    return line[-1] not in ".,:;" or any(_PAGE_NO.fullmatch(x.strip().lower()) for x in _PARTS.split(line))


def _scan(batches: Iterator[pa.RecordBatch], common: frozenset, edge: int) -> Iterator[pa.RecordBatch]:
    """Rows to look up: (document_id, page, block_id, line, role, side, word, cut); for edges ``word`` is the line."""
    names = ["document_id", "page", "block_id", "line", "role", "side", "word", "cut"]
    types = [pa.string(), pa.int32(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int32()]
    memo: dict[str, tuple[str, ...]] = {}

    def suspicious(token: str) -> tuple[str, ...]:
        found = memo.get(token)
        if found is None:
            if len(memo) > 500_000:
                memo.clear()
            w = _clean(token)
            found = () if w in common or not _ordinary(w) else tuple(q for q in _PART.split(w) if q not in common and _ordinary(q))
            memo[token] = found
        return found

    for b in batches:
        rows: list[tuple] = []
        for d, p, k, text in zip(*(b.column(i).to_pylist() for i in range(4))):
            line_of = None
            masked = text
            if "\n" in text:
                for left, mark, right, end in _breaks(text):
                    j = text.count("\n", 0, left) + 1
                    lw, rw = _key(text[left:mark].strip(_EDGE_PUNCT)), _key(text[right:end].strip(_EDGE_PUNCT))
                    lp, rp = _PART.split(lw), _PART.split(rw)
                    rows.append((d, p, k, j, "soft" if text[mark] in _SOFT else "piece", None, lp[-1] + rp[0], len(lp[-1])))
                    rows.append((d, p, k, j, "left", None, lp[-1], None))
                    rows.append((d, p, k, j, "right", None, rp[0], None))
                    rows.append((d, p, k, j, "whole", None, "-".join(lp + rp), None))
                    rows += [(d, p, k, j, "plain", None, w, None) for w in lp[:-1] if w not in common and _ordinary(w)]
                    rows += [(d, p, k, j + 1, "plain", None, w, None) for w in rp[1:] if w not in common and _ordinary(w)]
                    cut = masked[left:end]
                    masked = masked[:left] + "".join("\n" if c == "\n" else " " for c in cut) + masked[end:]
            odd = {t: s for t in set(masked.split()) if (s := suspicious(t))}
            if odd:
                for j, line in enumerate(masked.split("\n"), 1):
                    for t in line.split():
                        if t in odd:
                            rows += [(d, p, k, j, "plain", None, w, None) for w in odd[t]]
            line_of = text.split("\n")
            full = [j for j, line in enumerate(line_of) if line and not line.isspace()]
            sides: dict[int, str] = {}
            for i, j in enumerate(full[:edge]):
                sides[j] = f"T{i}"
            for i, j in enumerate(full[: -edge - 1 : -1]):
                sides[j] = sides.get(j, "") + f"B{i}"
            for j, side in sides.items():
                if _may_run(line_of[j]):
                    rows.append((d, p, k, j + 1, "edge", side, line_of[j].strip(), None))
            # Deeper lines of a header or footer, as one row: they count only if all before them turn out to be noise.
            for side, inward in (("T", full), ("B", full[::-1])):
                if len(full) > edge and all(_may_run(line_of[j]) for j in inward[: edge + 1]):
                    deep = list(itertools.takewhile(lambda j: _may_run(line_of[j]), inward[edge:]))
                    rows.append((d, p, k, deep[0] + 1, "deep", side, "\n".join(f"{j + 1} {line_of[j].strip()}" for j in deep), None))
        cols = list(zip(*rows)) or [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], names=names)


def _noise(blocks: DataFrame, rules: OcrRules) -> DataFrame:
    """Rows of :func:`ocr_noise`, some of them repeated."""
    spark = blocks.sparkSession
    ok = blocks.filter("document_id IS NOT NULL AND block_id IS NOT NULL AND text IS NOT NULL")
    lexicon = materialize(word_counts(ok), "lexicon")
    total = F.col("n_sound") + F.col("n_ocr")
    # The most frequent trusted words, a bounded number, spare look-ups; they are never corrected.
    top = lexicon.filter(trusted(lexicon, rules)).orderBy(total.desc(), "word").limit(rules.common)
    common = spark.sparkContext.broadcast(frozenset(r["word"] for r in top.select("word").collect()))
    fixes = materialize(corrections(lexicon, rules), "corrections")

    edge = rules.edge_lines
    scanned = ok.filter("is_ocr AND text <> ''").select("document_id", "page", "block_id", "text")
    looked = scanned.mapInArrow(
        lambda it: _scan(it, common.value, edge),
        "document_id string, page int, block_id string, line bigint, role string, side string, word string, cut int",
    )
    looked = materialize(looked, "lookups")
    key = ["document_id", "page", "block_id", "line"]

    # Words broken at line ends: evidence of each reading from the lexicon or from what it corrects to.
    dictionary = lexicon.select("word", total.alias("n")).join(fixes, "word", "left")
    dictionary = dictionary.join(lexicon.select(F.col("word").alias("fix"), total.alias("n_fix")), "fix", "left")
    parts = looked.filter("role IN ('piece', 'soft', 'left', 'right', 'whole')").join(
        dictionary.select("word", F.greatest(F.coalesce("n", F.lit(0)), F.coalesce("n_fix", F.lit(0))).alias("n"), "fix", "at", "seg"), "word", "left"
    )
    n_of = lambda *roles: F.coalesce(F.max(F.when(F.col("role").isin(*roles), F.col("n"))), F.lit(0))
    whole_of = lambda *roles: F.max(F.when(F.col("role").isin(*roles), F.struct("word", "fix", "at", "seg", "cut")))
    decided = parts.groupBy(*key).agg(
        n_of("piece", "soft").alias("n_joined"), n_of("left").alias("n_left"), n_of("right").alias("n_right"), n_of("whole").alias("n_whole"),
        F.max(F.col("role") == "soft").alias("soft"),
        whole_of("piece", "soft").alias("j"), whole_of("left").alias("l"), whole_of("right").alias("r"),
    )
    joins = (F.col("n_joined") > 0) & (F.col("n_joined") >= F.col("n_whole"))
    joins = joins | ((F.col("n_whole") == 0) & (F.col("soft") | ~((F.col("n_left") > 0) & (F.col("n_right") > 0))))
    decided = decided.withColumn("hyphen", joins)

    def row(when: Column, line: Column, noise: str, part: str) -> Column:
        return F.when(when, F.struct(line.alias("line_no"), F.lit(noise).alias("noise"), F.col(f"{part}.word").alias("word"), F.col(f"{part}.fix").alias("fix")))

    here, after, hyphen = F.col("line"), F.col("line") + 1, F.col("hyphen")
    wrong = lambda part: F.col(f"{part}.fix").isNotNull()
    each = F.array(
        row(hyphen, here, "hyphen", "j"),
        row(hyphen & wrong("j") & F.expr("j.at < j.cut"), here, "misread", "j"),
        row(hyphen & wrong("j") & F.expr("j.at + j.seg > j.cut"), after, "misread", "j"),
        row(~hyphen & wrong("l"), here, "misread", "l"),
        row(~hyphen & wrong("r"), after, "misread", "r"),
    )
    broken = decided.select("document_id", "page", "block_id", F.explode(F.filter(each, lambda x: x.isNotNull())).alias("_x")).select("document_id", "page", "block_id", "_x.*")
    plain = materialize(looked.filter("role = 'plain'").join(fixes, "word").select(
        "document_id", "page", "block_id", here.alias("line_no"), F.lit("misread").alias("noise"), "word", "fix"
    ).distinct(), "misread")
    return broken.unionByName(plain).unionByName(_edge_noise(ok, looked, plain, rules))


def noisy_lines(blocks: DataFrame, rules: OcrRules = OcrRules()) -> DataFrame:
    """(document_id, block_id, line_no, noise): the lines of :func:`ocr_noise`, once for each kind."""
    return _noise(blocks, rules).select("document_id", "block_id", "line_no", "noise").distinct()


def ocr_noise(blocks: DataFrame, rules: OcrRules = OcrRules()) -> DataFrame:
    """Noise of scanned blocks: (document_id, page, block_id, line_no, noise, word, fix).

    ``blocks``: (document_id, page, block_id, top double, is_ocr boolean, text). noise is ``hyphen`` (word: the joined
    word), ``misread`` (word, fix), ``running`` or ``page_number``; a line may have several, and several misread words.
    Null and empty texts have no lines of interest; blocks delivered twice come out once; null pages
    make pages of their own; an empty table gives an empty result. Texts of any length are read line by line.
    """
    return _noise(blocks, rules).distinct()


def _edge_parts(lines: pd.Series, repairs: pd.Series) -> pd.Series:
    """Parts of edge lines, corrected and in lower case, each with the page number it may be (or null)."""
    out = []
    for line, rep in zip(lines, repairs):
        fixes = {} if rep is None else {r["word"]: r["fix"] for r in rep}
        parts = []
        for part in _PARTS.split(line):
            ws = part.split()
            if fixes:
                ws = [w.replace(c, fixes[k]) if (k := _key(c := w.strip(_EDGE_PUNCT))) in fixes else w for w in ws]
            t = " ".join(ws).lower()
            if t:
                m = _PAGE_NO.fullmatch(t)
                parts.append({"part": t, "number": None if not m else int(m[1]) if m[1] else _roman(m[2])})
        out.append(parts)
    return pd.Series(out)


_edge_udf = F.pandas_udf(_edge_parts, T.ArrayType(T.StructType([T.StructField("part", T.StringType()), T.StructField("number", T.LongType())])))


def _edge_noise(blocks: DataFrame, looked: DataFrame, misread: DataFrame, rules: OcrRules) -> DataFrame:
    """Running lines and page numbers among the outermost lines of pages, compared in corrected form."""
    page = ["document_id", "page"]
    extent = blocks.filter(F.length(F.trim("text")) > 0).groupBy(*page).agg(
        F.min(F.struct("top", "block_id")).alias("_first"), F.max(F.struct("top", "block_id")).alias("_last")
    ).select(F.col("document_id").alias("_d"), F.col("page").alias("_p"), F.col("_first.block_id").alias("first"), F.col("_last.block_id").alias("last"))
    outer = looked.filter("role = 'edge'").join(extent, F.col("document_id").eqNullSafe(F.col("_d")) & F.col("page").eqNullSafe(F.col("_p"))).filter(
        "(side LIKE '%T%' AND block_id = first) OR (side LIKE '%B%' AND block_id = last)"
    )
    sides = F.array(*(F.when(F.contains("side", F.lit(x)) & (F.col("block_id") == F.col(c)), F.lit(x)) for x, c in (("T", "first"), ("B", "last"))))
    outer = materialize(outer.select(*page, "block_id", "line", sides.alias("sides"), F.col("word").alias("text")), "outer-lines")
    # A line holds few words, so its repairs are a short list.
    repairs = misread.groupBy("document_id", "block_id", F.col("line_no").alias("line")).agg(F.collect_list(F.struct("word", "fix")).alias("_rep"))
    parts = materialize(_line_parts(outer, repairs), "edges")
    # Printed numbers may be shifted against the page count, by the same amount all over a document.
    shifts = parts.filter("shift IS NOT NULL").groupBy("document_id", "shift").agg(F.count_distinct("page").alias("n"))
    main = materialize(shifts.groupBy("document_id").agg(F.max_by("shift", F.struct("n", -F.abs(F.col("shift")))).alias("main")), "shifts")
    found = materialize(_judged(parts, parts, main, rules), "edge-noise")

    # Where all outermost lines of a side are noise, the lines behind them are looked at, as far as noise goes on.
    at_side = outer.select(*page, "block_id", "line", F.explode("sides").alias("side")).filter("side IS NOT NULL")
    noisy = at_side.join(found.select("document_id", "block_id", F.col("line_no").alias("line")).distinct(), ["document_id", "block_id", "line"])
    behind = noisy.groupBy("document_id", "block_id", "side").agg(F.count_distinct("line").alias("n")).filter(F.col("n") >= rules.edge_lines).drop("n")
    deep = looked.filter("role = 'deep'").join(behind, ["document_id", "block_id", "side"]).select(*page, "block_id", "side", F.posexplode(F.split("word", "\n")).alias("depth", "text"))
    deep = deep.withColumn("line", F.substring_index("text", " ", 1).cast("bigint")).withColumn("text", F.expr("substring(text, instr(text, ' ') + 1)"))
    deep = materialize(deep, "deep-lines")
    more = materialize(_line_parts(deep, repairs), "deep-parts")
    alike = parts.join(more.select("part").distinct(), "part", "left_semi").select(parts.columns)
    judged = materialize(_judged(more, alike.unionByName(more), main, rules), "deep-noise")
    hit = judged.select("document_id", "block_id", F.col("line_no").alias("line"), F.lit(True).alias("_hit")).distinct()
    stop = deep.join(hit, ["document_id", "block_id", "line"], "left").groupBy("document_id", "block_id", "side").agg(F.min(F.when(F.col("_hit").isNull(), F.col("depth"))).alias("_stop"))
    going = deep.join(stop, ["document_id", "block_id", "side"]).filter("_stop IS NULL OR depth < _stop").select("document_id", "block_id", F.col("line").alias("line_no")).distinct()
    none = F.lit(None).cast("string")
    return found.unionByName(judged.join(going, ["document_id", "block_id", "line_no"], "left_semi")).withColumns({"word": none, "fix": none})


def _line_parts(lines: DataFrame, repairs: DataFrame) -> DataFrame:
    """(document_id, page, block_id, line, part, shift): parts of lines in corrected form; shift of a number against its page."""
    joined = lines.select("document_id", "page", "block_id", "line", "text").join(repairs, ["document_id", "block_id", "line"], "left")
    parts = joined.select("document_id", "page", "block_id", "line", F.explode(_edge_udf("text", "_rep")).alias("_x"))
    return parts.select("document_id", "page", "block_id", "line", "_x.part", (F.col("_x.number") - F.col("page")).alias("shift"))


def _judged(parts: DataFrame, evidence: DataFrame, main: DataFrame, rules: OcrRules) -> DataFrame:
    """Lines of ``parts`` that are page numbers or running lines: (document_id, page, block_id, line_no, noise)."""
    def sorted_out(df: DataFrame) -> tuple[DataFrame, DataFrame]:
        d = df.join(main, "document_id", "left").withColumn("is_number", F.coalesce((F.col("shift") == F.col("main")) | (F.col("shift") == 0), F.lit(False)))
        title = ~F.col("is_number") & F.col("part").rlike(r"\p{L}") & ~F.col("part").rlike(r"[.,:;]$")
        return d.filter("is_number"), d.filter(title)

    line = ["document_id", "page", "block_id", F.col("line").alias("line_no")]
    numbers, titles = sorted_out(parts)
    repeated = _running_parts(sorted_out(evidence)[1], rules)
    running = titles.join(repeated, ["document_id", "part"], "left_semi").select(*line, F.lit("running").alias("noise"))
    return numbers.select(*line, F.lit("page_number").alias("noise")).unionByName(running)


def _running_parts(titles: DataFrame, rules: OcrRules) -> DataFrame:
    """(document_id, part) of running lines: decided by how near a line stands again, whatever the size of document or corpus.

    Pages are counted in stretches of ``near_pages``: with two or more pages in one, all are near; a lone page is if one in a
    neighbouring stretch is. Other documents lend a line that stands in them too often to be chance.
    """
    w = rules.near_pages
    by = ["document_id", "part"]
    bins = titles.groupBy(*by, F.floor(F.col("page") / w).alias("_bin")).agg(F.count_distinct("page").alias("n"), F.min("page").alias("lo"), F.max("page").alias("hi"))
    order = Window.partitionBy(*by).orderBy("_bin")
    near = (F.col("lo") - F.lag("hi").over(order) <= w) | (F.lead("lo").over(order) - F.col("hi") <= w)
    bins = bins.withColumn("_near", F.when((F.col("n") > 1) | near, F.col("n")).otherwise(0))
    docs = bins.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("_near").alias("near"))
    docs = materialize(docs.select(*by, ((F.col("near") >= 2) & (F.col("near") >= F.col("n") * rules.near_share)).alias("runs")), "running-parts")
    lent = docs.groupBy("part").agg(F.count_if("runs").alias("k"), F.count("*").alias("d")).filter((F.col("k") >= rules.other_docs) & (F.col("k") >= F.col("d") * rules.other_share))
    return docs.join(lent.select("part", F.lit(True).alias("_lent")), "part", "left").filter("runs OR _lent").select(*by)


def repaired_text(text: str, drop: set[int], joined: dict[int, str], fixes: dict[tuple[int, str], str]) -> str:
    """One block as paragraphs: edge lines dropped, broken words joined, misread words corrected, lines unwrapped."""
    wrong = {n for n, _ in fixes}

    def fix(line_no: int, line: str) -> str:
        def word(m: re.Match) -> str:
            w = m[0]
            good = fixes.get((line_no, _key(w)))
            if good is None:
                return w
            return good.upper() if w.isupper() and len(w) > 1 else good.capitalize() if w[:1].isupper() else good

        return re.sub(r"[^\s\-‐.,:;()\[\]{}<>|\"“”!?*•/\\]+", word, line) if line_no in wrong else line

    paragraphs: list[str] = []
    current = ""
    carry: str | None = None
    lines = text.split("\n")
    for j, raw in enumerate(lines, 1):
        if j in drop:
            continue
        line = raw.strip()
        if carry is not None:
            head, _, rest = line.partition(" ")
            line = carry + head + (" " + rest if rest else "")
            carry = None
        if not line:
            if current:
                paragraphs.append(current)
            current = ""
            continue
        if j in joined:
            body = line.rstrip()[:-1]
            before, _, last = body.rpartition(" ")
            current = " ".join(x for x in (current, fix(j, before)) if x)
            carry = last
            if j == len(lines):
                current = " ".join(x for x in (current, last) if x)
                carry = None
            continue
        if line[-1:] in "-‐" and j < len(lines) and lines[j].strip()[:1].islower():
            before, _, last = line.rpartition(" ")
            current = " ".join(x for x in (current, fix(j, before)) if x)
            carry = last
            continue
        current = " ".join(x for x in (current, fix(j, line)) if x)
    if carry:
        current = " ".join(x for x in (current, carry) if x)
    if current:
        paragraphs.append(current)
    return "\n\n".join(paragraphs)


def repair_blocks(blocks: DataFrame, rules: OcrRules = OcrRules()) -> DataFrame:
    """Scanned blocks as readable paragraphs: (document_id, page, block_id, text, n_repairs).

    Each block meets its own few repairs in a join; a joined word that is misread is corrected as a whole.
    """
    noise = materialize(ocr_noise(blocks, rules), "noise")
    per = noise.groupBy("document_id", "block_id").agg(F.collect_list(F.struct("line_no", "noise", "word", "fix")).alias("repairs"))
    scanned = blocks.filter("is_ocr AND text IS NOT NULL AND document_id IS NOT NULL AND block_id IS NOT NULL")
    scanned = scanned.select("document_id", "page", "block_id", "text").dropDuplicates(["document_id", "block_id"])
    joined = scanned.join(per, ["document_id", "block_id"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, counts = [], []
            for t, rep in zip(b.column("text").to_pylist(), b.column("repairs").to_pylist()):
                rep = rep or []
                drop = {r["line_no"] for r in rep if r["noise"] in ("running", "page_number")}
                hy = {r["line_no"]: r["word"] for r in rep if r["noise"] == "hyphen"}
                fx = {(r["line_no"] + d, r["word"]): r["fix"] for r in rep if r["fix"] and r["noise"] in ("misread", "hyphen") for d in ((0, 1) if r["noise"] == "hyphen" else (0,))}
                texts.append(repaired_text(t, drop, hy, fx))
                counts.append(len(rep))
            yield pa.RecordBatch.from_arrays(
                [b.column("document_id"), b.column("page"), b.column("block_id"), pa.array(texts, pa.string()), pa.array(counts, pa.int32())],
                names=["document_id", "page", "block_id", "text", "n_repairs"],
            )

    return joined.select("document_id", "page", "block_id", "text", "repairs").mapInArrow(run, "document_id string, page int, block_id string, text string, n_repairs int")
