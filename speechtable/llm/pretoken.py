"""The splitting pattern of byte-level BPE, over whole chunks of texts at once.

The pattern (contractions; letters, digits or other characters with one space before; white space) only looks at the classes of
neighbouring characters, so every cut follows from arrays of classes.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import regex

LETTER, DIGIT, SPACE, OTHER = 1, 2, 3, 0
#: Characters with the White_Space property.
_WHITE = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)


@cache
def _classes() -> np.ndarray:
    out = np.zeros(0x110000, np.uint8)
    text = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    for kind, pattern in ((LETTER, r"\p{L}+"), (DIGIT, r"\p{N}+")):
        for m in regex.finditer(pattern, text):
            a, b = ord(m[0][0]), ord(m[0][-1])
            out[a : b + 1] = kind
    out[0xD800:0xE000] = OTHER
    out[list(_WHITE)] = SPACE
    return out


def split(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(byte starts of all pieces, pieces before each row and in all); pieces cover all bytes."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    cp = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), "<u4")
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    n = len(cp)
    kind = _classes()[cp]
    first = np.zeros(n + 1, bool)
    first[np.searchsorted(lead, offsets)] = True
    fresh = first[:n].copy()
    fresh[1:] |= kind[1:] != kind[:-1]
    white = kind == SPACE
    cut = fresh.copy()
    # A run after white space: the last white character is cut off, and a plain space belongs to the run.
    after = np.flatnonzero(fresh & ~white & ~first[:n])
    after = after[white[after - 1]]
    cut[after - 1] = True
    cut[after[cp[after - 1] == 0x20]] = False
    # 's 't 'm 'd 're 've 'll where the apostrophe starts a piece.
    mark = np.flatnonzero((cp[:-1] == 0x27) & (kind[1:] == LETTER) & cut[:-1] & ~first[1:n])
    if len(mark):
        one = cp[mark + 1]
        two = np.where((mark + 2 < n) & ~first[np.minimum(mark + 2, n)], cp[np.minimum(mark + 2, n - 1)], 0)
        is_one = np.isin(one, [ord(c) for c in "stmd"])
        is_two = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        hit = is_one | is_two
        mark, ends = mark[hit], (mark + np.where(is_one, 2, 3))[hit]
        cut[mark + 1] = False
        ends = ends[ends < n]
        cut[ends[(kind[ends] == LETTER) | first[ends]]] = True
    starts = lead[cut]
    return starts, np.searchsorted(starts, offsets)
