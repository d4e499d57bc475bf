"""Misread words of any length."""

from pagelode.llm import ocr_repair as O


def test_short_and_long_words_are_corrected(spark):
    long = "abcdefgh" * 9
    rows = [("of", 900, 0), ("0f", 0, 1), ("me", 900, 0), ("rne", 0, 1), ("modern", 900, 0), ("rnodern", 0, 1), ("method", 900, 0), ("rnethod", 0, 1), (long, 900, 0), ("4" + long[1:], 0, 1)]
    lex = spark.createDataFrame([(w, a, b, 0) for w, a, b in rows], "word string, n_sound bigint, n_ocr bigint, n_joined bigint")
    got = {r["word"]: r["fix"] for r in O.corrections(lex).collect()}
    assert got == {"0f": "of", "rne": "me", "rnodern": "modern", "rnethod": "method", "4" + long[1:]: long}
