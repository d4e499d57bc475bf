"""Rules for scanned pages that must not change with the size of a line, a page, a document or the corpus."""

import random
import re

from pagelode.llm import ocr_repair as O
from tests.sqlcheck import BASE, duck  # noqa: F401

_SCHEMA = "document_id string, page int, block_id string, top double, is_ocr boolean, text string"


def _noise(spark, rows, **kw):
    got = O.ocr_noise(spark.createDataFrame(rows, _SCHEMA), O.OcrRules(**kw))
    return {(r["document_id"], r["page"], r["line_no"], r["noise"]) for r in got.collect()}


def _pages(doc, pages, header, rnd):
    words = [a + b for a in ("lo", "re", "ga", "tu", "mi", "ke") for b in ("der", "ting", "mal", "sor", "ven", "pix")]
    return [(doc, p, f"{doc}{p}", 0.0, True, "\n".join([*header(p), *(" ".join(rnd.choices(words, k=9)) for _ in range(4))])) for p in pages]


def test_a_chapter_line_of_a_few_pages_is_found_in_any_corpus(spark):
    rnd = random.Random(1)
    chapter = lambda p: ["Power Control"] if 4000 <= p < 4040 else []
    rows = _pages("big", range(3980, 4060), chapter, rnd)
    far = _pages("big", range(1, 3000, 4), lambda p: ["rarely twice"] if p in (1, 2001) else [], rnd)
    want = {("big", p, 1, "running") for p in range(4000, 4040)}
    assert _noise(spark, rows) == want
    assert _noise(spark, rows + far) == want
    lent = [(f"d{i}", 7, f"x{i}", 0.0, True, "Power Control\nlast words here") for i in range(2)]
    two = [(d, p, f"{d}{p}", 0.0, True, f"Power Control\nword {d} {p} here") for d in ("m", "n") for p in (1, 2)]
    got = _noise(spark, two + lent)
    assert {x for x in got if x[0][0] == "d"} == {("d0", 7, 1, "running"), ("d1", 7, 1, "running")}


def test_tall_headers_and_long_lines(spark):
    rnd = random.Random(2)
    long = "Company Confidential " * 60
    rows = _pages("d", range(1, 9), lambda p: ["Handbook", long, "Part Two", f"Page {p}", "Draft"], rnd)
    got = _noise(spark, rows)
    assert got == {("d", p, n, "page_number" if n == 4 else "running") for p in range(1, 9) for n in range(1, 6)}


def test_letters_without_case_and_chance_in_sound_text(spark):
    lex = spark.createDataFrame(
        [("레지스터", 900, 50, 0), ("레지스더", 0, 3, 0), ("메모리", 900, 40, 0), ("메모라", 0, 2, 0), ("the", 90_000, 900, 0), ("tbe", 3, 60, 0), ("hot", 9_000, 90, 0), ("hat", 300, 3, 0)],
        "word string, n_sound bigint, n_ocr bigint, n_joined bigint",
    )
    got = {r["word"]: r["fix"] for r in O.corrections(lex, O.OcrRules(min_support=1)).collect()}
    assert got == {"레지스더": "레지스터", "메모라": "메모리", "tbe": "the"}


#: Confusions planted by the test.
_SHAPES = {"rn": "m", "m": "rn", "d": "cl", "e": "c", "o": "0", "l": "1", "h": "b", "i": "l"}


def test_how_much_is_repaired(spark, duck):  # noqa: F811
    """Sound text, spoilt as scanned pages are: nearly all words come back, and hardly a sound one is changed."""
    rnd = random.Random(3)
    texts = [t for (t,) in duck.execute("SELECT DISTINCT raw_text FROM page_blocks WHERE lower(extraction_method) NOT LIKE '%ocr%' AND block_type = 'text' AND length(raw_text) > 200 ORDER BY raw_text").fetchall()]
    rows, truth, planted = [], {}, 0
    for i, t in enumerate(texts):
        rows.append(("sound", i + 1, f"s{i}", 0.0, False, t))
    for i, t in enumerate(rnd.sample(texts, 120)):
        ws = t.split()
        out = []
        for w in ws:
            at = [k for k in _SHAPES if k in w[1:]]
            if w.isalpha() and w.islower() and len(w) > 4 and at and rnd.random() < 0.03:
                k = rnd.choice(at)
                w = w[0] + w[1:].replace(k, _SHAPES[k], 1)
                planted += 1
            out.append(w)
        lines, line = [], ""
        for w in out:
            if len(line) + len(w) > 70 and w.isalpha() and len(w) > 6 and rnd.random() < 0.3:
                lines.append(f"{line} {w[:3]}-".strip())
                line, planted = w[3:], planted + 1
            elif len(line) + len(w) > 70:
                lines.append(line.strip())
                line = w
            else:
                line += " " + w
        rows.append(("scan", i + 1, f"b{i}", 0.0, True, "\n".join(["Field Manual", *lines, line.strip(), str(i + 1)])))
        truth[f"b{i}"] = ws
        planted += 2
    blocks = spark.createDataFrame(rows, _SCHEMA)
    good = bad = total = 0
    for r in O.repair_blocks(blocks).collect():
        ws, got = truth[r["block_id"]], re.sub(r"\s+", " ", r["text"]).split()
        total += len(ws)
        good += len(ws) - abs(len(ws) - len(got)) if len(ws) != len(got) else sum(a == b for a, b in zip(ws, got))
        bad += "Field Manual" in r["text"]
    print(f"planted {planted}, words {total}, as before {good / total:.4f}, running lines left {bad}")
    assert good / total > 0.995 and bad == 0
