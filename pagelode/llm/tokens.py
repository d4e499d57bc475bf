"""Tokens of public tokenizers: counts, and cuts at token boundaries with exact character offsets."""

from __future__ import annotations

import base64
import functools

import numpy as np

#: Default vocabulary; any ``.tiktoken`` rank file will do. Every worker reads it from this path.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Fixed value: the pattern that splits text before the merges of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Vocabulary:
    """A byte-level vocabulary with per-token byte lengths."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._enc = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        top = max(ranks.values()) + 1
        self.size = np.zeros(top, dtype=np.int64)
        self.opens_word, self.starts_blank, self.ends_blank = (np.zeros(top, dtype=bool) for _ in range(3))
        for b, i in ranks.items():
            self.size[i] = len(b)
            self.opens_word[i] = len(b) > 1 and b[:1] == b" " and not b[1:2].isspace()
            self.starts_blank[i], self.ends_blank[i] = b[:1].isspace(), b[-1:].isspace()

    def encode(self, text: str) -> np.ndarray:
        return self._enc.encode_to_numpy(text, disallowed_special=())

    def count(self, text: str) -> int:
        return len(self._enc.encode_ordinary(text))


@functools.lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """One vocabulary per worker and path."""
    return Vocabulary(path)


class Encoded:
    """A text as tokens with the places where it may be cut.

    ``byte_at[i]`` is the byte at which token ``i`` starts (with a last entry for the end); ``whole[i]`` says
    whether that is the start of a character; ``word[i]`` whether a word starts there, so that the tokens on
    both sides stay the same when the text is cut. Texts of at most ``least`` tokens are only counted.
    """

    def __init__(self, text: str, vocab: Vocabulary, least: int = -1):
        self.raw = text.encode("utf-8", "replace")
        ids = vocab.encode(self.raw.decode("utf-8"))
        self.n = len(ids)
        self.vocab = vocab
        if self.n <= least:
            return
        self.byte_at = np.zeros(self.n + 1, dtype=np.int64)
        np.cumsum(vocab.size[ids], out=self.byte_at[1:])
        data = np.frombuffer(self.raw, dtype=np.uint8)
        lead = (data & 0xC0) != 0x80
        self.char_of = np.zeros(len(data) + 1, dtype=np.int64)
        np.cumsum(lead, out=self.char_of[1:])
        self.whole = np.ones(self.n + 1, dtype=bool)
        self.word = np.ones(self.n + 1, dtype=bool)
        if self.n:
            self.whole[:-1] = lead[self.byte_at[:-1]]
            self.word[1:-1] = vocab.opens_word[ids[1:]] | (vocab.ends_blank[ids[:-1]] & ~vocab.starts_blank[ids[1:]])

    def char_at(self, token: int) -> int:
        return int(self.char_of[self.byte_at[token]])

    def text(self, start: int, end: int) -> str:
        return self.raw[self.byte_at[start] : self.byte_at[end]].decode("utf-8", "replace")

    def back(self, marks: np.ndarray, token: int, least: int) -> int | None:
        """Last marked token boundary in (least, token]."""
        at = np.flatnonzero(marks[least + 1 : token + 1])
        return None if not len(at) else int(at[-1]) + least + 1

    def own_count(self, start: int, end: int) -> int:
        """Tokens the text of a span has by itself: only words cut at its ends are encoded again."""
        after = start if self.word[start] else next(iter(np.flatnonzero(self.word[start:end]) + start), end)
        before = end if self.word[end] else self.back(self.word, end, start)
        if before is None or before <= after:
            return self.vocab.count(self.text(start, end))
        n = before - after
        if after > start:
            n += self.vocab.count(self.text(start, int(after)))
        if before < end:
            n += self.vocab.count(self.text(before, end))
        return int(n)

    def fitting(self, start: int, end: int, limit: int, least: int) -> int:
        """``end`` or a boundary before it (after ``least``) such that the text in between has at most ``limit`` tokens of its own."""
        while end - start > 1 and self.own_count(start, end) > limit:
            before = self.back(self.whole, end - 1, max(least, start))
            if before is None:
                break
            end = before
        return end


def cut_plain(e: Encoded, limit: int) -> list[tuple[int, int]]:
    """Consecutive token spans of at most ``limit`` tokens, cut before a word where one starts in the last quarter."""
    out, start = [], 0
    while start < e.n:
        end = min(e.n, start + limit)
        if end < e.n:
            word = e.back(e.word, end, start + limit * 3 // 4)
            end = word if word is not None else (e.back(e.whole, end, start) or end)
        end = e.fitting(start, end, limit, start)
        out.append((start, end))
        start = end
    return out
