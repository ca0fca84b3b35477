"""Noisy-channel restoration of disguised words.

A span (a word, or letters set apart) becomes a lattice: what each sign may stand for, one or two letters for a run of equal ones,
nothing or a limit of words for what separates letters. One Viterbi search under a character language model of order four finds
the cheapest path over all of it; no state is left out.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections import Counter

import numpy as np

from .fold import PLAIN_LETTERS

# What signs, digits and foreign letters may stand for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "€": "e", "£": "l", "¡": "i"}
LOOKALIKES = {"а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ј": "j", "ԁ": "d", "һ": "h", "ӏ": "l", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "г": "r", "α": "a", "ο": "o", "ε": "e", "ι": "i", "ν": "v", "ρ": "p", "τ": "t", "υ": "u", "κ": "k", "ӓ": "a", "ɑ": "a", "ı": "i"}
MASKS = "*#%_•·~"
SEPARATORS = " .-_*·•"
#: Letters are 1 to 26, 0 is the limit of a word, 27 any other sign.
_OTHER = 27
_NUMBER = {c: i for i, c in enumerate("abcdefghijklmnopqrstuvwxyz", 1)}
_INVISIBLE = re.compile("[" + "".join(re.escape(chr(c)) for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c)) == "Cf") + "]")


def visible(text: str) -> str:
    """The text without invisible signs, compatibility forms as plain ones."""
    return text if text.isascii() else _INVISIBLE.sub("", unicodedata.normalize("NFKC", text))


def plain(text: str) -> str:
    """The visible text in lower case without marks."""
    if text.isascii():
        return text.lower()
    text = unicodedata.normalize("NFKD", visible(text).lower())
    return "".join(c for c in text if not unicodedata.combining(c)).translate(PLAIN_LETTERS).replace("’", "'")


class CharModel:
    """Costs (negative logarithms) of the next letter after three, interpolated over the orders one to four, as one array."""

    DISCOUNT = (0.5, 1.0, 1.0, 0.5)

    def __init__(self, words: Counter[str]):
        """``words`` with their weights; one that ends in ``*`` is a beginning."""
        n = _OTHER + 1
        counts = np.zeros((n, n, n, n), np.float32)
        for word, weight in words.items():
            whole = not word.endswith("*")
            codes = [0, 0, 0, *(_NUMBER.get(c, _OTHER) for c in word.rstrip("*")), *([0] if whole else [])]
            for i in range(3, len(codes)):
                counts[tuple(codes[i - 3 : i + 1])] += weight
        p = np.full(n, 1 / 60, np.float32)
        for k in range(4):
            c = counts.sum(axis=tuple(range(3 - k))) if k < 3 else counts
            total = c.sum(axis=-1, keepdims=True)
            share = np.where(total > 0, total / (total + self.DISCOUNT[k]), 0)
            p = (1 - share) * p + share * c / np.maximum(total, 1e-9)
        self.cost = -np.log(np.maximum(p, 1e-9)).astype(np.float32)

    def word_cost(self, word: str) -> float:
        codes = [0, 0, 0, *(_NUMBER.get(c, _OTHER) for c in word), 0]
        return float(sum(self.cost[tuple(codes[i - 3 : i + 1])] for i in range(3, len(codes))))


class Lattice:
    """Viterbi search of a span's cheapest reading."""

    #: Cost of taking a sign for a letter, of dropping one, of dropping a mask within a word, of a masked letter, of keeping a sign, of a foreign letter, of a second
    #: letter of a long run, of one letter for two, of a limit of words between letters set apart, of joining what isn't single letters.
    SWAP, DROP, UNMASK, MASKED, KEEP, FOREIGN, DOUBLE, SINGLE, LIMIT, JOIN = 0.7, 1.2, 3.0, 0.4, 4.0, 0.2, 0.3, 1.0, 0.5, 0.8
    #: A reading must cost less than this a letter to be taken.
    LIKELY = 2.2

    def __init__(self, words: Counter[str]):
        self.model = CharModel(words)
        #: Costs by (last letter, next one), then the two letters before.
        self.following = np.ascontiguousarray(self.model.cost.transpose(2, 3, 0, 1))

    def steps(self, span: str) -> list[list[tuple[str, float]]]:
        """For each sign, or run of equal ones, the texts that it may stand for with their costs."""
        parts = re.split(r"[ .\-_*·•]{1,2}", span)
        apart = len(parts) > 2 and all(len(p) == 1 for p in parts)
        out: list[list[tuple[str, float]]] = []
        for m in re.finditer(r"(.)\1*", span, re.S):
            c, n = m[1], len(m[0])
            inner = 0 < m.start() and m.end() < len(span)
            if c in SEPARATORS and inner and (apart or c in " .-"):
                out.append([("", 0.0 if apart else self.JOIN), (" ", self.LIMIT if apart else 0.0), *([(x, self.MASKED) for x in _NUMBER] if c in MASKS and n == 1 else [])])
                continue
            if c in MASKS:
                out += [[*[(x, self.MASKED) for x in _NUMBER], ("", self.UNMASK if inner else self.DROP), (c, self.KEEP)]] * n
                continue
            options = self._options(c)
            if n > 1:
                options = [(x * k, price + (self.DOUBLE if n > 2 and k == 2 else self.SINGLE if n == 2 and k == 1 and x else 0.0)) for x, price in options for k in ((1, 2) if x else (1,))]
            out.append(options)
        return out

    def _options(self, c: str) -> list[tuple[str, float]]:
        if c in LOOKALIKES:
            return [(LOOKALIKES[c], self.FOREIGN)]
        if c in _NUMBER:
            return [(c, 0.0)]
        out = [(x, self.SWAP) for x in LEET.get(c, "")]
        if not c.isalnum():
            out.append(("", self.DROP))
        return [*out, (c, self.KEEP)]

    def search(self, span: str) -> tuple[float, str]:
        """(cost, reading) of the cheapest path over the whole lattice."""
        size = _OTHER + 1
        # the states: for each of the last letters ``codes`` the costs by the two before it; the traces say how each came to be
        codes = np.array([0])
        values = np.full((1, size, size), np.inf, np.float32)
        values[0, 0, 0] = 0.0
        back: list[dict[int, list]] = []

        def emit(codes: np.ndarray, values: np.ndarray, code: int, price: float) -> tuple[np.ndarray, np.ndarray]:
            """The costs after one more letter by (letter before last, last), and the third letter back that gives them."""
            total = values + self.following[codes, code]
            value = np.full((size, size), np.inf, np.float32)
            third = np.zeros((size, size), np.int8)
            third[:, codes] = total.argmin(axis=1).T
            value[:, codes] = total.min(axis=1).T + price
            return value, third

        for options in self.steps(span):
            new: dict[int, np.ndarray] = {}
            traces: dict[int, list] = {}

            def merge(code: int, value: np.ndarray, trace: tuple, new: dict = new, traces: dict = traces) -> None:
                old = new.get(code)
                if old is None:
                    new[code], traces[code] = value, [(trace, None)]
                else:
                    better = value < old
                    new[code] = np.where(better, value, old)
                    traces[code].append((trace, better))

            for text, price in options:
                if text == "":
                    for code, value in zip(codes.tolist(), values, strict=True):
                        merge(code, value + np.float32(price), ("", None, None))
                elif text == " ":
                    # a word ends and another begins
                    ends = values + self.following[codes, 0]
                    at, a, b = (int(x) for x in np.unravel_index(ends.argmin(), ends.shape))
                    value = np.full((size, size), np.inf, np.float32)
                    value[0, 0] = ends[at, a, b] + price
                    merge(0, value, (" ", (a, b, int(codes[at])), None))
                else:
                    code = _NUMBER.get(text[0], _OTHER)
                    value, third = emit(codes, values, code, price)
                    again = None
                    if len(text) == 2:
                        value, again = emit(np.array([code]), value[None], code, 0.0)
                    merge(code, value, (text, third, again))
            back.append(traces)
            codes, values = np.array(list(new)), np.stack(list(new.values()))
        ends = values + self.following[codes, 0]
        at, a, b = (int(x) for x in np.unravel_index(ends.argmin(), ends.shape))
        total, last = float(ends[at, a, b]), int(codes[at])
        text = ""
        for traces in reversed(back):
            # the last alternative that was better at this state made it
            piece, third, again = next(t for t, better in reversed(traces[last]) if better is None or better[a, b])
            text = piece + text
            if piece == " ":
                a, b, last = third
            elif len(piece) == 2:
                between = int(again[a, b])
                a, b, last = int(third[between, a]), between, a
            elif piece:
                a, b, last = int(third[a, b]), a, b
        return total, text

    def read(self, span: str) -> str | None:
        """The reading of a folded span if it is likely for its length, else None."""
        total, text = self.search(span)
        return text if text and total / (len(text) + 1) < self.LIKELY else None
