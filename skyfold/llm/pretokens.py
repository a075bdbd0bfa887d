"""Pre-tokens of byte-level BPE, found with array operations.

The split pattern of the public byte-level vocabularies is a list of
alternatives over four character classes (letter, number, white space,
other).  Finding its matches with a regular expression costs a quarter of a
microsecond per character; here the classes of all characters of a batch come
from one table, and the matches from comparing neighbours:

* a run of one class is a match; a space before a run of letters, numbers or
  others belongs to it;
* white space before something else gives up its last character: a space joins
  what follows, any other character stands alone;
* an apostrophe at the start of a match takes the contraction ending with it.

The class table is read off the tokenizer library itself (its pattern engine's
idea of letters, numbers and white space for every code point), so it follows
that library's Unicode version.
"""

from __future__ import annotations

import base64
import functools

import numpy as np
import pandas as pd

from skyfold.llm.words import ranges, word_hashes

OTHER, LETTER, NUMBER, SPACE = range(4)

# The split pattern this module implements, and its contractions.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


@functools.cache
def classes() -> np.ndarray:
    """Class of every code point."""
    import tiktoken
    every = "".join(map(chr, (c for c in range(0x110000) if not 0xD800 <= c < 0xE000)))
    table = np.zeros(0x110000, dtype=np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        enc = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks={bytes([i]): i for i in range(256)},
                                special_tokens={})
        table[np.frombuffer(enc.decode_bytes(enc.encode_ordinary(every)).decode().encode("utf-32-le"), "<u4")] = kind
    return table


def bounds(text: str, rows: np.ndarray) -> np.ndarray:
    """Starts of all pre-tokens of the concatenated rows (``rows``: start of
    every row, in code points), and at the end the length of the text."""
    n = len(text)
    if not n:
        return np.zeros(1, dtype=np.int64)
    code = np.frombuffer(text.encode("utf-32-le"), "<u4")
    kind = classes()[code]
    rows = rows[(rows > 0) & (rows < n)]
    row = np.zeros(n + 1, dtype=bool)
    row[0] = row[n] = True
    row[rows] = True
    start = row.copy()
    start[1:n] |= kind[1:] != kind[:-1]
    # white space followed by something else in its row
    last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~row[1:n])
    start[last] = True                        # gives up its last character,
    start[last[code[last] == 32] + 1] = False  # which joins what follows if it is a space
    # contractions: a lone apostrophe that starts a match, followed by letters
    at = np.flatnonzero((code[:-1] == 39) & (kind[1:] == LETTER) & start[:n - 1] & start[1:n] & ~row[1:n])
    for ending in CONTRACTIONS:
        end = at + 1 + len(ending)
        hit = end <= n
        for k, c in enumerate(ending):
            i = np.minimum(at + 1 + k, n - 1)
            hit &= (code[i] == ord(c)) & ((k == 0) | ~row[i])
        start[at[hit] + 1] = False
        start[end[hit]] = True
        at = at[~hit]
    return np.flatnonzero(start)


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank of a rank file."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


@functools.cache
def rank_encoder(path: str):
    """The tokenizer library's encoder of single pre-tokens, by a rank file."""
    import tiktoken
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=read_ranks(path), special_tokens={})


# Distinct pre-tokens of many rows ------------------------------------------

#: Characters that are split at a time.
CHUNK = 1 << 20


def _pieces(texts: list[str]):
    """(row number, part of the row) with parts of about ``CHUNK`` characters.
    A row is cut only before a single space between two other characters: a
    pre-token surely starts there."""
    for r, t in enumerate(texts):
        at = 0
        while len(t) - at > CHUNK:
            cut = at + CHUNK // 2
            while True:
                cut = t.find(" ", cut)
                if cut < 0 or cut + 1 >= len(t):
                    cut = len(t)
                    break
                if not t[cut - 1].isspace() and not t[cut + 1].isspace():
                    break
                cut += 1
            yield r, t[at:cut]
            at = cut
        yield r, t[at:] if at else t


def _chunks(texts: list[str]):
    rows, parts, size = [], [], 0
    for r, t in _pieces(texts):
        if parts and size + len(t) > CHUNK:
            yield rows, parts
            rows, parts, size = [], [], 0
        rows.append(r)
        parts.append(t)
        size += len(t)
    if parts:
        yield rows, parts


def distinct(texts: list[str]):
    """Per chunk of rows: (distinct pre-tokens as bytes, for every pre-token its
    number among them, row of every part, pre-tokens of every part)."""
    for rows, parts in _chunks(texts):
        text = "".join(parts)
        starts = np.r_[0, np.cumsum([len(p) for p in parts])]
        cut = bounds(text, starts)
        code = np.frombuffer(text.encode("utf-32-le"), "<u4")
        size = np.ones(len(code) + 1, dtype=np.int64)
        size[0] = 0
        for limit in (0x80, 0x800, 0x10000):
            size[1:] += code >= limit
        at = np.cumsum(size)[cut]
        s, e = at[:-1], at[1:]
        data = text.encode()
        raw = np.frombuffer(data, np.uint8)
        hashed = word_hashes(raw, s, e, 0)
        inverse, kinds = pd.factorize(hashed)  # a hash table: no sort
        first = np.empty(len(kinds), dtype=np.int64)
        first[inverse[::-1]] = np.arange(len(inverse) - 1, -1, -1)
        if not _same(raw, s, e, first[inverse]):  # two pre-tokens with one hash
            seen: dict[bytes, int] = {}
            inverse = np.array([seen.setdefault(data[i:j], len(seen)) for i, j in zip(s, e)])
            words = list(seen)
        else:
            words = [data[i:j] for i, j in zip(s[first].tolist(), e[first].tolist())]
        yield words, inverse, rows, np.diff(np.searchsorted(cut[:-1], starts))


def _same(raw: np.ndarray, s: np.ndarray, e: np.ndarray, of: np.ndarray) -> bool:
    """True if every range has the bytes of the range ``of``."""
    if not np.array_equal(e - s, (e - s)[of]):
        return False
    return not len(s) or bool(np.array_equal(raw[int(s[0]):int(e[-1])], raw[ranges(s[of], e[of])]))


def expand(flat: np.ndarray, size: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Concatenation of the ``which``-th items; items lie in ``flat``, none is empty."""
    end = np.cumsum(size)
    return flat[ranges((end - size)[which], end[which])]
