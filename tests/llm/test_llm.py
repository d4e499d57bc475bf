import random
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pagelode.llm import consensus as C
from pagelode.llm import ocr_repair as O
from pagelode.llm.format_dups import canonical_name, canonical_parts, format_collapsed, format_copies, unordered
from pagelode.llm.leakage import WuManber, leaked_items, words
from pagelode.llm.packing import measured_pieces, pack, packed_documents, plan_slots
from pagelode.llm.splitting import split_documents
from pagelode.llm.tokens import VOCABULARY, Encoded, cut_plain, vocabulary
from tests.sqlcheck import BASE, duck  # noqa: F401

# --- consensus ----------------------------------------------------------------------------------------


def test_the_vote_runs_over_weights_that_fall_with_trust():
    vals = [("LOAD_X2", 1.0, [0.3, "c"], 0), ("LOAD.X2", 1.0, [0.1, "b"], 1), ("LOAD_X2 ", 1.0, [0.2, "a"], 2), ("LOAD_X9", 0.5, [0.0, "0"], 3)]
    assert vals[C.choose(vals, 1)][0] == "LOAD_X2 "  # the majority in each column, the more trusted of its two spellings
    assert vals[C.choose(vals, 2)][0] == "LOAD_X9"  # the first outweighs all others
    # In between, weights 1, .67, .44 and .3: the second and third change the last column, the mark stays the first's.
    prof, every = C.group_profile(vals)
    assert C.consensus(prof, every, 2) == ["LOAD", "_", "X", "9"] and C.consensus(prof, every, 1.5) == ["LOAD", "_", "X", "2"]
    assert vals[C.choose(vals, 1.5)][0] == "LOAD_X2 "
    p, every = C.group_profile([("a b c", 1, [0, "x"], 0), ("a c", 1, [1, "y"], 1), ("a b c", 1, [2, "z"], 2)])
    assert C.consensus(p, every, 1) == ["a", "b", "c"] and len(p) == 3
    assert C.distance(["a", "b"], ["a", "c", "b"]) == 1 and C.choose([("", 1, [0, "x"], 0)], 1) == 0


def test_no_number_of_others_outweighs_the_first():
    vals = [("A 1", 1.0, [0.0, "a"], 0), *((f"A {2 + i % 2}", 9.0, [1.0, f"b{i:04d}"], i % 64) for i in range(500))]
    assert vals[C.choose(vals, 2)][0] == "A 1" and vals[C.choose(vals, 1)][0] == "A 2"


def _survivors(spark, rows, **kw):
    df = spark.createDataFrame(rows, "id string, k string, v string, conf double, extra string")
    trust = [F.when(F.col("conf").between(0, 1) & ~F.isnan("conf"), -F.col("conf")).otherwise(1.0)]
    out = C.consensus_survivors(df, {"k": F.lower("k")}, F.col("id"), trust, {"v": (F.col("v"), F.lit(True)), "num": (F.col("v"), F.col("v").rlike("^[0-9]+$"))}, **kw)
    return {r["group_id"]: (r["v_id"], r["num_id"]) for r in out.collect()}


def test_survivors_against_brute_force_in_one_go_and_in_chunks(spark):
    rnd = random.Random(3)
    rows = [(f"i{n:04d}", rnd.choice(["A", "a", "B", None, f"s{n}"]), rnd.choice(["x_1", "X 1", "12", "7", None, "", f"v{n}"]), rnd.choice([None, float("nan"), 0.5, 0.9, 0.9, 7.0, rnd.random()]), "z") for n in range(300)]
    rows += rows[:30]
    want, groups = {}, {}
    for r in {r[0]: r for r in rows}.values():
        groups.setdefault(None if r[1] is None else r[1].lower(), []).append(r)
    rank = lambda r: (-r[3] if r[3] is not None and r[3] == r[3] and 0 <= r[3] <= 1 else 1.0, r[0])
    for g in groups.values():
        if len(g) > 1:
            nums = [r for r in g if re.fullmatch("[0-9]+", r[2] or "")]
            want[min(r[0] for r in g)] = (min(g, key=rank)[0], min(nums, key=rank)[0] if nums else None)
    assert _survivors(spark, rows) == want
    assert _survivors(spark, rows, direct=3, chunks=4) == want
    assert _survivors(spark, []) == {} and _survivors(spark, rows[:1]) == {}


def test_both_ways_give_the_same_answers(spark):
    rnd = random.Random(8)
    words = ["LOAD", "X", "2", "_", ".", "R", "17"]
    rows = [(f"a{n:04d}", rnd.choice("kkklm"), "".join(rnd.choice(words + [" "]) for _ in range(rnd.randrange(0, 7))), rnd.choice([0.5, rnd.random()]), "") for n in range(400)]
    df = spark.createDataFrame(rows, "id string, k string, v string, conf double, extra string")
    for fall in (1.0, 1.3, 2.0):
        got = []
        for kw in ({}, {"direct": 1}):
            out = C.consensus_survivors(df, {"k": F.col("k")}, F.col("id"), [-F.col("conf")], {"v": (F.col("v"), F.lit(True)), "some": (F.col("v"), F.col("v").contains("X"))}, fall=fall, chunks=8, **kw)
            got.append(sorted(map(tuple, out.collect())))
        assert got[0] == got[1] and len(got[0]) == 3
    many = [(f"a{n}", "k", v, 0.5, "") for n, v in enumerate(["LOAD_X2 R"] * 5 + ["LOAD.X2 R", "L0AD_X2 R", "LOAD_X2"])]
    df = spark.createDataFrame(many, "id string, k string, v string, conf double, extra string")
    for kw in ({}, {"direct": 1, "chunks": 2}):
        assert C.consensus_survivors(df, {"k": F.col("k")}, F.col("id"), [F.lit(0.0)], {"v": (F.col("v"), F.lit(True))}, fall=1, **kw).first()["v"] == "LOAD_X2 R"


def test_the_plain_vote_finds_majorities(spark, duck):  # noqa: F811
    """Where more than half of a group's records agree on a spelling, it is the consensus."""
    from pagelode.llm.queries import _p1

    got = {r["group_id"]: r["name"] for r in _p1(spark, BASE, [], 1.0).collect()}
    groups = {}
    sql = """SELECT DISTINCT trace_id, document_id, regexp_replace(lower(coalesce(instruction_name, '')), '[^\\p{L}\\p{N}]', '', 'g'),
      nullif(regexp_replace(lower(coalesce(variation, '')), '[^\\p{L}\\p{N}]', '', 'g'), ''), instruction_name FROM instruction_catalog"""
    for t, d, n, v, name in duck.execute(sql).fetchall():
        groups.setdefault((d, n, v), []).append((t, name or ""))
    clear = same = 0
    for g in groups.values():
        counts = {}
        for _, name in g:
            key = tuple(C.tokens(name))
            counts[key] = counts.get(key, 0) + 1
        top = max(counts.values())
        if len(g) > 1 and 2 * top > len(g):
            clear += 1
            same += counts[tuple(C.tokens(got[min(g)[0]]))] == top
    assert clear > 20 and same == clear


# --- scanned pages -------------------------------------------------------------------------------------

RULES = O.OcrRules(min_support=1, min_known=2, ratio=2)


def _pages(spark):
    sound = "the register controller throws the signed token through the register and controls memory zero-filled zero-filled "
    rows = [("d", 100 + i, f"s{i}", 0.0, False, sound * 3) for i in range(3)]
    for p in range(1, 6):
        rows.append(("d", p, f"b{p}", 0.0, True, f"Reference Manual\nID_{p} the registcr contr-\noller throws the zero-\nfilled token\nLIMIT:\n77\nPage {p}"))
    rows.append(("d", 6, "b6", 0.0, True, "Refercnce Manual  |  6\nthe t0ken con¬ \ntroller\nmemory"))
    rows.append(("d", 7, "b7", 0.0, True, "Reference Manual\nthe register\nvii"))
    rows += [("d", 8, "b8", 0.0, True, None), ("d", 9, "b9", 0.0, True, ""), ("d", 1, "b1", 0.0, True, rows[3][5])]
    return spark.createDataFrame(rows, "document_id string, page int, block_id string, top double, is_ocr boolean, text string")


def test_noise_by_kind(spark):
    got = {(r["block_id"], r["line_no"], r["noise"]) for r in O.ocr_noise(_pages(spark), RULES).collect()}
    for p in range(1, 6):
        b = f"b{p}"
        assert {x for x in got if x[0] == b} == {(b, 1, "running"), (b, 2, "misread"), (b, 2, "hyphen"), (b, 7, "page_number")}, b
    assert {x for x in got if x[0] == "b6"} == {("b6", 1, "running"), ("b6", 1, "page_number"), ("b6", 1, "misread"), ("b6", 2, "misread"), ("b6", 2, "hyphen")}
    assert {x for x in got if x[0] == "b7"} == {("b7", 1, "running"), ("b7", 3, "page_number")}
    assert not any(x[0] in ("b8", "b9") or x[0].startswith("s") for x in got)


def test_repaired_text(spark):
    got = {r["block_id"]: r["text"] for r in O.repair_blocks(_pages(spark), RULES).collect()}
    assert got["b1"] == "ID_1 the register controller throws the zero-filled token LIMIT: 77"
    assert got["b6"] == "the token controller memory"
    assert O.repaired_text("a\n\nb c\nd", set(), {}, {}) == "a\n\nb c d"


def test_no_blocks(spark):
    assert O.ocr_noise(_pages(spark).filter("false")).count() == 0
    assert O._roman("xiv") == 14 and O._roman("iiii") is None and O._roman("") is None


def test_remainders_find_confusions(spark):
    rows = [("token", 100, 0, 0), ("t0ken", 0, 3, 0), ("tokcn", 0, 2, 0), ("modern", 90, 0, 0), ("modem", 0, 1, 0), ("insicle", 0, 2, 0), ("inside", 80, 0, 0), ("unrelated", 0, 1, 0)]
    lex = spark.createDataFrame(rows, "word string, n_sound bigint, n_ocr bigint, n_joined bigint")
    got = {r["word"]: (r["fix"], r["at"], r["seg"]) for r in O.corrections(lex, RULES).collect()}
    assert got == {"t0ken": ("token", 1, 1), "tokcn": ("token", 3, 1), "modem": ("modern", 4, 1), "insicle": ("inside", 4, 2)}


# --- duplicates by formatting --------------------------------------------------------------------------


def test_canonical_forms(spark):
    rows = [("LUT_X​-F8", "[31 : 26]"), ("(lutxf8)", "26~31"), (None, " 15:13,­9 "), ("", None)]
    df = spark.createDataFrame(rows, "n string, b string")
    got = [tuple(r) for r in df.select(canonical_name(F.col("n")), canonical_parts(F.col("b"))).collect()]
    assert got == [("lutxf8", "26 31"), ("lutxf8", "26 31"), ("", "13 15 9"), ("", "")]


def test_copies_and_counts(spark):
    rows = [("c", "d", "Add", "SRC", "7:0"), ("a", "d", "src", " add ", "0-7"), ("b", "d", "ADD", "SRC", "70"), ("a", "d", "src", " add ", "0-7"), ("e", None, "x", "y", None), ("f", None, "x", "y", ""), ("g", "", "x", "y", " "), (None, "d", "Add", "SRC", "7:0")]
    df = spark.createDataFrame(rows, "id string, doc string, n string, f string, b string").withColumn("h1", F.lit(1))
    parts = ([F.col("doc")], [*unordered(canonical_name(F.col("n")), canonical_name(F.col("f"))), canonical_parts(F.col("b"))])
    assert sorted(map(tuple, format_copies(df, "id", *parts).collect())) == [("a", "c"), ("e", "f")]
    assert {r["keep"]: r["n_copies"] for r in format_collapsed(df, "id", *parts).collect()} == {"a": 2, "b": 1, "e": 2, "g": 1}
    assert format_copies(df.filter("false"), "id", *parts).count() == 0


def test_collisions_are_told_apart(spark):
    from pagelode.llm.format_dups import format_groups

    df = spark.createDataFrame([(1, 1, 5, "a"), (1, 1, 6, "b"), (1, 1, 5, "c")], "h1 bigint, h2 bigint, h3 bigint, id string")
    assert sorted((r["keep"], r["n_rows"]) for r in format_groups(df, "id").collect()) == [("a", 2), ("b", 1)]


# --- leakage --------------------------------------------------------------------------------------------


def test_search_against_brute_force(spark):
    rnd = random.Random(4)
    vocab = [f"w{i}" for i in range(9)]
    items = [(i, " ".join(rnd.choices(vocab, k=rnd.randrange(0, 40)))) for i in range(12)] + [(3, "a b"), (50, None)]
    docs = []
    for d in range(120):
        ws = rnd.choices(vocab, k=rnd.randrange(0, 60))
        if rnd.random() < 0.5:
            src = (rnd.choice(items)[1] or "").split()
            at = rnd.randrange(0, len(src) + 1)
            ws[5:5] = src[at : at + rnd.randrange(8, 20)]
        docs.append((d, rnd.choice([" ", "\n", ", ", "--"]).join(w.upper() if rnd.random() < 0.3 else w for w in ws)))
    docs += [(900, None), (901, ""), (902, "x " * 50_000)]

    def runs(text):
        ws = words(text)
        return {tuple(ws[i : i + 12]) for i in range(len(ws) - 11)}

    known = [(i, runs(q)) for i, q in items]
    want = {(d, i) for d, t in docs for r in [runs(t)] for i, q in known if r & q}
    a = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("item_id", F.lit(0))
    b = spark.createDataFrame(items, "item_id bigint, text string")
    for block in (100_000, 300):
        got = [tuple(r) for r in leaked_items(a, b, "doc_id", "text", "item_id", "text", block_chars=block).collect()]
        assert len(got) == len(set(got)) and set(got) == want and want
    assert leaked_items(a, b.filter("false"), "doc_id", "text", "item_id", "text").count() == 0


def test_shift_tables():
    s = WuManber([(1, " ".join(f"a{i}" for i in range(15)))], 12)
    shift = lambda a, b: s.table[s.known[a] * s.base + s.known[b]]
    assert shift("a0", "a1") == 10 and shift("a9", "a10") == 1 and shift("a10", "a11") < 0 and s.jump == 11
    assert s.search(["x"] * 30 + [f"a{i}" for i in range(3, 15)] + ["x"]) == {1} and s.search([f"a{i}" for i in range(3, 14)] + ["x"]) == set()
    assert WuManber([], 12).search(["x"] * 40) == set() and WuManber([(1, "too short")], 12).search(["too", "short"] * 9) == set()
    assert words("Straße STRASSE a_b") == ["strasse", "strasse", "a", "b"]


def test_a_full_block_fits_a_worker():
    import tracemalloc

    rnd = random.Random(1)
    vocab = [f"w{i}" for i in range(20_000)]
    texts = [(i, " ".join(rnd.choices(vocab, k=300))) for i in range(500)]
    tracemalloc.start()
    s = WuManber(texts, 12)
    used = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert used / 150_000 < 250 and s.search(words(texts[7][1])) == {7}


# --- packing and splitting ------------------------------------------------------------------------------


def _check_plan(hist, cap):
    fills, seen = {}, {}
    for length, lo, hi, base, items, fill in plan_slots(hist, cap):
        seen[length] = seen.get(length, 0) + hi - lo + 1
        for r in range(lo, hi + 1):
            c = base + (r - lo) // items
            fills.setdefault(c, [0, fill])[0] += length
    assert seen == {k: v for k, v in hist.items() if k and v}
    assert all(a == b <= cap for a, b in fills.values()) and sorted(fills) == list(range(len(fills)))
    return len(fills)


def _best_fit(hist, cap):
    rooms = []
    for n in sorted((k for k, v in hist.items() for _ in range(v) if k), reverse=True):
        fit = [i for i, r in enumerate(rooms) if r >= n]
        if fit:
            rooms[min(fit, key=lambda i: rooms[i])] -= n
        else:
            rooms.append(cap - n)
    return len(rooms)


def test_plan_equals_best_fit_decreasing_over_items():
    rnd = random.Random(6)
    for _ in range(60):
        cap = rnd.randrange(5, 60)
        hist = {rnd.randrange(1, cap + 1): rnd.randrange(1, 30) for _ in range(rnd.randrange(0, 12))}
        assert _check_plan(hist, cap) == _best_fit(hist, cap)


def test_containers(spark):
    rows = [(i, "word " * (i * 37 % 700)) for i in range(200)] + [(1000, "x y z " * 4000), (1001, ""), (1002, None), (1003, "a" * 9000), (1004, "한국어 문장 " * 900), (5, "word " * 185)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("container", F.lit(7))
    out = packed_documents(docs, "doc_id", "text", 512).toPandas()
    vocab = vocabulary(VOCABULARY)
    text = dict(rows)
    fills = out.groupby("container")["n_tokens"].sum()
    assert (fills <= 512).all() and len(out[out.doc_id == 5]) == 2
    assert (out.groupby("container")["fill"].first() == fills).all()
    for d, g in out[out.doc_id != 5].groupby("doc_id"):
        t = text[d] or ""
        g = g.sort_values("piece")
        assert "".join(t[a:b] for a, b in zip(g.start, g.end)) == t
        assert [vocab.count(t[a:b]) <= 512 for a, b in zip(g.start, g.end)] == [True] * len(g)
        assert len(g) == 1 or vocab.count(t) > 512
    total = out["n_tokens"].sum()
    assert fills.size <= -(-total // 512) * 1.1 + 1
    a, b = pack(measured_pieces(docs, "doc_id", "text", 512), 512, per_salt=3).toPandas(), out
    assert a["container"].nunique() == b["container"].nunique() and (a.groupby("container")["n_tokens"].sum() == a.groupby("container")["fill"].first()).all()
    assert packed_documents(docs.filter("false"), "doc_id", "text", 512).count() == 0


def test_pieces(spark):
    para = "Each stage reads one field. The next stage writes two fields! Is it done? "
    rows = [(1, "# A\n\n" + para * 30 + "\n\n## B\n" + para * 25), (2, "short"), (3, None), (4, ""), (5, "x" * 5000), (6, "가나다 라마바. " * 400), (7, "\n\n".join([para * 3] * 30))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("piece", F.lit("clash"))
    out = split_documents(docs, "doc_id", "text", 256, 32).toPandas().sort_values(["doc_id", "piece"])
    vocab, text = vocabulary(VOCABULARY), dict(rows)
    assert set(out.doc_id) == {1, 5, 6, 7} and out.duplicated(["doc_id", "piece"]).sum() == 0
    for d, g in out.groupby("doc_id"):
        t = text[d]
        assert list(g.piece) == list(range(len(g))) and g.start.iloc[0] == 0 and g.end.iloc[-1] == len(t)
        assert all(t[a:b] == x for a, b, x in zip(g.start, g.end, g.text)) and (g.n_tokens <= 256).all()
        assert all(vocab.count(x) <= 256 for x in g.text)
        e = Encoded(t, vocab)
        chars = [e.char_at(i) for i in range(e.n + 1)]
        for a, b in zip(g.end[:-1], g.start[1:]):
            assert 32 <= chars.index(a) - chars.index(b) <= 40
    one = out[out.doc_id == 7]
    assert set(one.cut[1:]) <= {"section", "paragraph"}
    assert {"section", "sentence"} & set(out[out.doc_id == 1].cut)
    assert set(out[out.doc_id == 5].cut[1:]) == {"character"}
    every = split_documents(docs, "doc_id", "text", 256, 32, all_texts=True)
    assert every.filter("doc_id = 2").count() == 1 and every.filter("doc_id IN (3, 4)").count() == 0
    with pytest.raises(ValueError):
        split_documents(docs, "doc_id", "text", 10, 10)


def test_offsets_survive_any_text():
    vocab = vocabulary(VOCABULARY)
    for t in ("", "a", "é😀 ñ" * 50, "\r\n \t x" * 70, "한" * 300):
        e = Encoded(t, vocab)
        spans = cut_plain(e, 16)
        assert "".join(e.text(a, b) for a, b in spans) == t
        assert all(0 < b - a <= 16 for a, b in spans)


def test_timestamps_of_the_catalog_rank(spark):
    """Ties of confidence go to the latest time, then to the smallest id."""
    from pagelode.llm.queries import p1_found

    import tempfile

    d = tempfile.mkdtemp()
    t = datetime(2025, 1, 1)
    rows = [
        ("t3", "d", "Add", None, "0x1", 0.9, t), ("t1", "d", " add ", " ", "zz", 0.9, datetime(2025, 2, 1)), ("t2", "d", "ADD_", "", "12", float("nan"), None),
        ("u1", "d", "Sub", "v1", "?", None, None), ("u2", "d", "sub", "V-1", "?", 2.0, None), ("w1", "e", "Add", None, "1", 1.0, t),
    ]
    spark.createDataFrame(rows, "trace_id string, document_id string, instruction_name string, variation string, opcode_raw string, confidence_score double, extracted_at timestamp").write.parquet(f"{d}/instruction_catalog.parquet")
    assert sorted(map(tuple, p1_found(spark, d).collect())) == [("t1", "t1", "t3"), ("u1", "u1", "u1")]
