"""Prompt and index text over blocks with outer blanks."""

from pagelode.operators import blocks as B
from pagelode.operators import retrieval as V
from tests.test_operators import blocks


def test_text_is_stripped_and_pieces_end_their_line(spark):
    b = blocks(spark, [(1, "p1_b1", "text", (0, 0, 1, 1), "  \n one\n two \t\n"), (1, "p1_b2", "table", (0, 2, 1, 3), " \n\t "), (2, "p2_b1", "text", (0, 0, 1, 1), " x ")])
    head = "--- page={} block_id={} type=text ---\n{}\n"
    first, second = head.format(1, "p1_b1", "one\n two"), head.format(2, "p2_b1", "x")
    assert B.prompt_texts(b).first()["prompt"] == first + "\n" + second
    got = {r["block_id"]: (r["used_chars"], r["piece"]) for r in B.within_budget(b).collect()}
    assert got == {"p1_b1": (len(first), first), "p2_b1": (len(first) + len(second), second)}
    assert B.prompt_texts(b, len(first)).first()["prompt"] == first
    assert B.prompt_texts(b, len(first) - 1).first()["prompt"] == "(no text blocks)"
    rows = {r["block_id"]: (r["text"], r["text_preview"]) for r in V.index_rows(b).collect()}
    assert rows["p1_b1"] == ("[page=1 block_id=p1_b1 type=text index_on_page=0]\none\n two", "one\n two") and set(rows) == {"p1_b1", "p2_b1"}
