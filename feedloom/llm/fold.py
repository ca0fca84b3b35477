"""Folding of typed names."""

from __future__ import annotations

import re
import unicodedata

#: Letters that don't decompose, and what they are written as.
PLAIN_LETTERS = str.maketrans({"ł": "l", "ø": "o", "đ": "d", "ð": "d", "þ": "th", "ß": "ss", "æ": "ae", "œ": "oe", "ı": "i", "ħ": "h", "ŧ": "t"})
_OTHER = re.compile(r"[\W_]+")


def fold(text: str | None) -> str:
    """Lower case, without marks, every run of anything but letters and digits one space; null as ''."""
    if not text:
        return ""
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text.casefold())
        text = "".join(c for c in text if not unicodedata.combining(c)).translate(PLAIN_LETTERS)
    return _OTHER.sub(" ", text.lower()).strip()


def osa(a: str, b: str, most: int) -> int:
    """Edits between a and b: insertions, deletions, substitutions and swaps of neighbours; ``most`` + 1 if more."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    before: list[int] = []
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            v = min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, before[j - 2] + 1)
            new.append(v)
        if min(new) > most:
            return most + 1
        before, row = row, new
    return min(row[-1], most + 1)
