"""Code-point classes as arrays."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

import numpy as np

#: The Unicode property White_Space.
WHITE_SPACE = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, 0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2007, 0x2008, 0x2009, 0x200A, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
#: Letters and numbers that Unicode 16 added, as ranges; tokenizers know them, an older Python does not.
NEW_LETTERS = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4),
    (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3),
    (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
)
NEW_NUMBERS = ((0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA))
#: Past the last code point; stands between texts.
END = sys.maxunicode + 1
OTHER, LETTER, NUMBER, SPACE, SEPARATOR = range(5)


@lru_cache(1)
def classes() -> np.ndarray:
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((kinds.get(unicodedata.category(chr(i))[0], OTHER) for i in range(END)), np.uint8, END)
    out = np.append(out, np.uint8(SEPARATOR))
    for ranges, kind in ((NEW_LETTERS, LETTER), (NEW_NUMBERS, NUMBER)):
        for a, b in ranges:
            out[a : b + 1] = kind
    out[list(WHITE_SPACE)] = SPACE
    return out


def code_points(texts: list[str]) -> tuple[str, np.ndarray, np.ndarray]:
    """The texts joined, their code points with END after each text, and where each text's END is."""
    joined = "\n".join(texts) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.int64)
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1
    codes[ends] = END
    return joined, codes, ends
