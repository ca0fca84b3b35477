"""Abusive, hateful and sexual content scored.

Noisy-channel deobfuscation first (``lattice``): disguised words are decoded by a Viterbi search under a character language model.
The restored sentences are then scored by a log-linear model over their words, pairs of words and classes of meaning
(``lexicon``), which starts from the prior weights of the classes and is fitted on labelled rows. It is fitted once, on the driver,
and every sentence of every text is scored by it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import lexicon
from .lattice import LEET, LOOKALIKES, MASKS, Lattice, plain, visible

CATEGORIES = ("abusive", "hateful", "sexual")
#: Most labelled rows that the models are fitted on, the ones of the smallest ids, and most names of peoples' countries.
EXAMPLE_ROWS = 20_000
#: Probability from which a category counts as present.
THRESHOLD = 0.5
#: Texts that are scored at once.
TEXTS_AT_ONCE = 500
#: Tokens that a task remembers before it begins anew.
REMEMBERED = 1_000_000

#: A shouted word within a sentence, and lines that go on.
_SHOUT = re.compile(r"\b([A-Z]{2,})!+(?=\s*[a-z]|\s+[A-Z]{2,})")
_WRAPPED = re.compile(r"[ \t]*\n(?:> ?)?(?=[ \t]*[a-zà-ÿ])|\n> ?")
SENTENCES = re.compile(r"(?<=[.!?。！？])[\"”’)]*\s+|(?<=[。！？])|\n+")
_WORDS = re.compile(r"[^\W_]+")
_PARTS = re.compile(r"[^\w@$!|+*#%~€£¡•·.’'–-]+")
_FRAMES = "!.-–—'’*_~+|#"
_APART = re.compile(r"(?:[^\W_]|[" + re.escape("".join(LEET) + MASKS) + r"])(?:[.\-_*·•]{1,2}(?:[^\W_]|[" + re.escape("".join(LEET) + MASKS) + r"])){2,}")
_PIECES = re.compile(r"[^\W\d_]{1,12}(?:[.-][^\W\d_]{1,12})+")
_SIGNS = frozenset(LEET) | frozenset(MASKS)
_TRIPLE = re.compile(r"([^\W\d_])\1\1")
#: Three tokens of one sign each.
_SINGLES = re.compile(r"(?:^|\s)\S\s\S\s\S(?:\W|$)")
_UNSPACED = re.compile(r"[぀-ヿ一-鿿]")
#: Bits besides the classes: the word is the longest of a phrase.
_ANCHOR = 1 << 60
_PERSON = lexicon.BITS["YOU"] | lexicon.BITS["HIM"] | lexicon.BITS["NAMED"] | lexicon.BITS["THAT"]
_COUNTED = tuple(sorted({c[1:] for _, cs, _ in lexicon.PRIORS for c in cs.split() if c[0].isdigit()}))


class Vocabulary:
    """The classes of words and phrases."""

    def __init__(self, groups: list[str]):
        self.words: dict[str, int] = {}
        self.stems: dict[str, int] = {}
        phrases: dict[str, int] = {}
        for name, entries in lexicon.CLASSES.items():
            bit = lexicon.BITS[name]
            for entry in filter(None, (e.strip() for e in entries.replace("\n", " ").split(","))):
                words = _WORDS.findall(plain(entry))
                if _UNSPACED.search(entry):
                    phrases[plain(entry)] = phrases.get(plain(entry), 0) | bit
                elif len(words) > 1:
                    text = " " + " ".join(words) + ("" if entry.endswith("*") else " ")
                    phrases[text] = phrases.get(text, 0) | bit
                    anchor = max(words[:-1] if entry.endswith("*") else words, key=len)
                    self.words[anchor] = self.words.get(anchor, 0) | _ANCHOR
                else:
                    held = self.stems if entry.endswith("*") else self.words
                    held[words[0]] = held.get(words[0], 0) | bit
        for g in groups:
            names = _WORDS.findall(plain(g))
            if names and len(names[0]) >= 4:
                stem = names[0][: max(5, len(names[0]) - 3)]
                self.stems[stem] = self.stems.get(stem, 0) | lexicon.NATION
        self.countries = {w for g in groups for w in _WORDS.findall(plain(g))}
        self.lengths = sorted({len(s) for s in self.stems})
        self.automaton = ahocorasick.Automaton()
        for text, mask in phrases.items():
            self.automaton.add_word(text, (mask, text))
        self.automaton.make_automaton()
        self.phrases = phrases

    def mask(self, word: str) -> int:
        got = self.words.get(word, 0)
        for n in self.lengths:
            if n > len(word):
                break
            got |= self.stems.get(word[:n], 0)
        if got & lexicon.NATION and word not in self.countries:
            got |= lexicon.NATIONALS
        if _UNSPACED.search(word):
            got |= _ANCHOR
        return got

    def found(self, words: list[str]) -> Iterator[int]:
        """The classes of the phrases in a row of words, each phrase once."""
        text = " " + " ".join(words) + " "
        yield from {t: m for _, (m, t) in self.automaton.iter(text)}.values()

    def language(self) -> Counter[str]:
        """The words of the vocabulary for the language model, those that one disguises most; stems end in ``*``."""
        hidden = sum(lexicon.BITS[c] for c in lexicon.DISGUISED)
        out = Counter({w: 30 if m & hidden else 2 for w, m in self.words.items()})
        out.update({s + "*": 30 if m & hidden else 2 for s, m in self.stems.items()})
        for p in self.phrases:
            out.update(dict.fromkeys(p.split(), 1))
        return Counter({w: n for w, n in out.items() if w.rstrip("*").isascii() and w.rstrip("*").isalpha()})


class Reader:
    """Sentences and words of texts, restored and folded."""

    def __init__(self, vocabulary: Vocabulary, words: Counter[str]):
        self.vocabulary = vocabulary
        language = vocabulary.language()
        for w, n in words.items():
            if w.isascii() and w.isalpha():
                language[w] += n
        self.known = {w for w in language if not w.endswith("*")}
        self.weight = {w.rstrip("*"): n for w, n in language.items()}
        self.by_length: dict[int, list[str]] = {}
        for w in self.weight:
            self.by_length.setdefault(len(w), []).append(w)
        self.lattice = Lattice(language)
        self.forget()

    def forget(self) -> None:
        #: The words read so far, and the numbers of the words of each token.
        self.names: list[str] = []
        self.numbers: dict[str, int] = {}
        self.memory: dict[str, tuple[int, ...]] = {}

    def is_known(self, word: str) -> bool:
        return word in self.known or bool(self.vocabulary.mask(word) & ~lexicon.NATION)

    def sentences(self, text: str) -> list[list[int]]:
        """The numbers of the words of each sentence."""
        out = []
        for s in SENTENCES.split(_WRAPPED.sub(" ", _SHOUT.sub(r"\1", text))):
            if s and (words := self.words(s)):
                out.append(words)
        return out

    def words(self, sentence: str) -> list[int]:
        memory = self.memory
        tokens = sentence.split()
        if _SINGLES.search(sentence):
            tokens = self._spans(tokens)
        out: list[int] = []
        for t in tokens:
            got = memory.get(t)
            if got is None:
                got = memory[t] = tuple(self._number(w) for w in self._token(t))
            out += got
        return out

    def _number(self, word: str) -> int:
        got = self.numbers.get(word)
        if got is None:
            got = self.numbers[word] = len(self.names)
            self.names.append(word)
        return got

    @staticmethod
    def _spans(tokens: list[str]) -> list[str]:
        """Three or more tokens of one sign each become one, with spaces."""
        out: list[str] = []
        run: list[str] = []

        def close() -> None:
            if len(run) >= 3 and any(c.isalpha() for c in run):
                out.append(" ".join(run))
            else:
                out.extend(run)
            run.clear()

        for t in tokens:
            bare = t.strip(".,;:!?\"“”()") if len(t) > 1 else t
            if len(bare) == 1 and (bare.isalnum() or bare in _SIGNS):
                run.append(bare)
                if t[-1] in ".,;:!?)":
                    close()
            else:
                close()
                out.append(t)
        close()
        return out

    def _token(self, token: str) -> list[str]:
        if " " in token:
            read = self.lattice.read(plain(token))
            return _WORDS.findall(read if read is not None else token.lower())
        out: list[str] = []
        for part in _PARTS.split(visible(token)):
            mixed = not part.isascii() and any(c.lower() in LOOKALIKES for c in part) and any(c.isascii() and c.isalpha() for c in part)
            folded = plain(part).strip(_FRAMES)
            if folded:
                read = self._restored(folded, mixed)
                out += _WORDS.findall(folded if read is None else read)
        return out

    def _restored(self, w: str, mixed: bool) -> str | None:
        """The reading of a folded part if it looks disguised and the reading is likely."""
        if not any(c.isalpha() for c in w):
            return None
        if _APART.fullmatch(w):
            return self.lattice.read(w)
        if any(not c.isascii() and c not in LOOKALIKES and c.isalpha() for c in w):
            return None
        if _PIECES.fullmatch(w):
            pieces = re.split("[.-]", w)
            joined = ("".join(pieces[i:j]) for i in range(len(pieces)) for j in range(i + 2, len(pieces) + 1))
            if not any(map(self.is_known, joined)):
                return None
            read = self.lattice.read(w)
            return read if read and all(self.is_known(x) for x in read.split()) else None
        signs = any(c in _SIGNS for c in w)
        if any(c in MASKS for c in w):
            return self._unmasked(w)
        if mixed or _TRIPLE.search(w):
            return self.lattice.read(w)
        if signs and len(w) >= 3 and "_" not in w and "-" not in w and not re.fullmatch(r"\d+[a-z]{1,2}|[a-z]{1,2}\d+", w):
            return self.lattice.read(w)
        return None


    def _unmasked(self, w: str) -> str | None:
        """The reading of a masked word; if it is no word, the likeliest known word that shows what isn't masked."""
        read = self.lattice.read(w)
        if read is None or self.is_known(read):
            return read
        shown = re.compile("".join("[a-z]" if c in MASKS else f"[{LEET.get(c, '')}{re.escape(c)}]" for c in w))
        fits = [k for k in self.by_length.get(len(w), ()) if shown.fullmatch(k)]
        return min(fits, key=lambda k: (-self.weight[k], self.lattice.model.word_cost(k), k), default=read)


class Features:
    """What the model sees of sentences: classes that hold, words and pairs of words that the fitting saw twice or more."""

    def __init__(self, reader: Reader, sentences: list[list[int]]):
        self.reader = reader
        split = [[reader.names[i] for i in s] for s in sentences]
        words = Counter(w for s in split for w in set(s))
        pairs = Counter(p for s in split for p in set(zip(s, s[1:], strict=False)))
        self.index = {w: i for i, w in enumerate(sorted(w for w, n in words.items() if n >= 2))}
        codes = sorted(self.index[a] * len(self.index) + self.index[b] for (a, b), n in pairs.items() if n >= 2)
        self.codes = np.array(codes, np.int64)
        self.conditions = list(dict.fromkeys(c for _, c, _ in lexicon.PRIORS))
        self.width = len(self.conditions) + len(self.index) + len(self.codes)
        self.forget()

    def forget(self) -> None:
        #: The classes and the number in the index of each of the reader's words.
        self.looked = np.zeros((0, 2), np.int64)

    def of(self, sentences: list[list[int]], texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sentence, feature) of each feature that holds, each once; ``texts``: the text of each sentence, in order."""
        n = len(sentences)
        sizes = np.fromiter(map(len, sentences), np.int64, n)
        names, vocabulary = self.reader.names, self.reader.vocabulary
        new = [(vocabulary.mask(w), self.index.get(w, -1)) for w in names[len(self.looked) :]]
        self.looked = np.concatenate([self.looked, np.array(new, np.int64).reshape(-1, 2)])
        looked = self.looked[np.fromiter(chain.from_iterable(sentences), np.int64, int(sizes.sum()))]
        masks, ids = looked[:, 0], looked[:, 1]
        owner = np.repeat(np.arange(n), sizes)
        held = np.bitwise_or.reduceat(masks, np.cumsum(sizes) - sizes) if n else np.zeros(0, np.int64)
        counts = {c: np.bincount(owner[(masks & lexicon.BITS[c]) != 0], minlength=n) for c in _COUNTED}
        for i in np.flatnonzero(held & _ANCHOR):
            for m in vocabulary.found([names[w] for w in sentences[i]]):
                held[i] |= m
                for c in _COUNTED:
                    counts[c][i] += (m & lexicon.BITS[c]) != 0
        group = lexicon.BITS["GROUP"]
        named = ((held & lexicon.NATIONALS) != 0) | (((held & lexicon.NATION) != 0) & ((held & lexicon.BITS["PEOPLE"]) != 0))
        held = held | np.where(named, group, 0)
        before = np.zeros(n, np.int64)
        before[1:] = np.where(texts[1:] == texts[:-1], held[:-1], 0)
        holds = {name: (held & bit) != 0 for name, bit in lexicon.BITS.items()}
        holds["PERSON"] = (held & _PERSON) != 0
        said = holds["BEAST"] | holds["EXPEL"] | holds["LESS"]
        holds["HATED"] = holds["SLUR"] | said & (holds["GROUP"] | ((before & group) != 0))
        rows, columns = [], []
        for k, condition in enumerate(self.conditions):
            good = np.ones(n, bool)
            for c in condition.split():
                if c[0].isdigit():
                    good &= counts[c[1:]] >= int(c[0])
                elif c.endswith("<"):
                    good &= (before & lexicon.BITS[c[:-1]]) != 0
                    good &= ~holds[c[:-1]]
                else:
                    good &= holds[c]
            at = np.flatnonzero(good)
            rows.append(at)
            columns.append(np.full(len(at), k))
        known = ids >= 0
        rows.append(owner[known])
        columns.append(len(self.conditions) + ids[known])
        both = known[:-1] & known[1:] & (owner[:-1] == owner[1:])
        pair = (ids[:-1] * len(self.index) + ids[1:])[both]
        place = np.searchsorted(self.codes, pair)
        hit = np.searchsorted(self.codes, pair, "right") > place
        rows.append(owner[:-1][both][hit])
        columns.append(len(self.conditions) + len(self.index) + place[hit])
        row, column = np.divmod(np.unique(np.concatenate(rows) * self.width + np.concatenate(columns)), self.width)
        return row, column


class Model:
    """A logistic model of each category, fitted by maximum posterior: the weights of classes stay near their prior, those of words
    and pairs near 0."""

    #: Inverse variances of the priors of classes, of words and pairs, and of the bias.
    NEAR, NARROW, FIRM = 1.0, 4.0, 4.0

    def __init__(self, features: Features):
        self.features = features
        self.prior = np.zeros((len(CATEGORIES), features.width + 1))
        self.prior[:, -1] = lexicon.BIAS
        for category, condition, weight in lexicon.PRIORS:
            self.prior[CATEGORIES.index(category), features.conditions.index(condition)] = weight
        self.weights = self.prior.copy()

    def logits(self, row: np.ndarray, column: np.ndarray, n: int) -> np.ndarray:
        return np.stack([np.bincount(row, w[column], n) + w[-1] for w in self.weights], axis=1)

    def fit(self, row: np.ndarray, column: np.ndarray, labels: np.ndarray, steps: int = 250, rate: float = 0.05) -> None:
        """``labels``: 0 or 1 for each sentence and category."""
        n, width = len(labels), self.features.width
        pull = np.full(width + 1, self.NARROW)
        pull[: len(self.features.conditions)], pull[-1] = self.NEAR, self.FIRM
        self.weights = self.prior.copy()
        first, second = np.zeros_like(self.weights), np.zeros_like(self.weights)
        for t in range(1, steps + 1):
            off = 1 / (1 + np.exp(-np.clip(self.logits(row, column, n), -30, 30))) - labels
            slope = np.stack([np.append(np.bincount(column, off[row, k], width), off[:, k].sum()) for k in range(len(CATEGORIES))]) + pull * (self.weights - self.prior)
            first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
            self.weights -= rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)


class Moderator:
    """Scores of texts; fitted on (text, category) rows. ``groups``: names of peoples' countries."""

    def __init__(self, examples: list[tuple[str, str]], groups: list[str], fitted: bool = True, decoded: bool = True):
        """Without ``fitted`` the weights stay at their priors, without ``decoded`` disguised words stay as they are."""
        vocabulary = Vocabulary(groups)
        words = Counter(w for t, _ in examples for w in set(_WORDS.findall(plain(t))))
        self.reader = Reader(vocabulary, words)
        if not decoded:
            self.reader.lattice.read = lambda span: None  # type: ignore[method-assign]
            self.reader._spans = lambda tokens: tokens  # type: ignore[method-assign]
        split = [self.reader.sentences(t) for t, _ in examples]
        sentences = [s for ss in split for s in ss]
        text = np.repeat(np.arange(len(split)), [len(ss) for ss in split]).astype(np.int64)
        self.model = Model(Features(self.reader, sentences))
        if fitted and sentences:
            self._fit(sentences, text, [c for _, c in examples])
        self.forget()

    def forget(self) -> None:
        self.reader.forget()
        self.model.features.forget()

    def _fit(self, sentences: list[list[str]], text: np.ndarray, categories: list[str]) -> None:
        """The label of a text belongs to its likeliest sentence, which is chosen again after each fit."""
        row, column = self.model.features.of(sentences, text)
        wanted = np.array([CATEGORIES.index(c) if c in CATEGORIES else -1 for c in categories])[text]
        for _ in range(3):
            z = self.model.logits(row, column, len(sentences))
            labels = np.zeros((len(sentences), len(CATEGORIES)))
            for k in range(len(CATEGORIES)):
                mine = np.flatnonzero(wanted == k)
                best = {int(text[i]): int(i) for i in mine[np.argsort(z[mine, k], kind="stable")]}
                labels[list(best.values()), k] = 1
            self.model.fit(row, column, labels)

    def scores_of(self, texts: list[str | None]) -> np.ndarray:
        """Of each text the highest probability of any sentence, a column for each category. Null and blank texts score 0."""
        if len(self.reader.memory) > REMEMBERED:
            self.forget()
        split = [self.reader.sentences(t) if t else [] for t in texts]
        sentences = list(chain.from_iterable(split))
        out = np.zeros((len(texts), len(CATEGORIES)))
        if sentences:
            text = np.repeat(np.arange(len(split)), [len(ss) for ss in split])
            row, column = self.model.features.of(sentences, text)
            z = self.model.logits(row, column, len(sentences))
            np.maximum.at(out, text, 1 / (1 + np.exp(-np.clip(z, -30, 30))))
        return out

    def scores(self, text: str | None) -> tuple[float, ...]:
        return tuple(self.scores_of([text])[0])


def moderate(documents: DataFrame, key: str, text: str, examples: DataFrame, groups: DataFrame, keep: tuple[str, ...] = (), example_rows: int = EXAMPLE_ROWS) -> DataFrame:
    """(key, the columns ``keep``, abusive, hateful, sexual double): every row's scores, 0 for null, empty and blank texts.

    ``examples`` (text, category) fits the models on the driver, at most ``example_rows`` of them by the order of their ids; the
    fitted models are broadcast. ``groups`` has one text column of countries or peoples, of which as many are taken. A map over
    whole texts, without a shuffle.
    """
    fitted = [(r["text"], r["category"]) for r in examples.filter("text IS NOT NULL AND category IS NOT NULL").orderBy("example_id").limit(example_rows).collect()]
    names = sorted(r[0] for r in groups.distinct().na.drop().orderBy(groups.columns[0]).limit(example_rows).collect())
    shipped = documents.sparkSession.sparkContext.broadcast(Moderator(fitted, names))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moderator = shipped.value
        for batch in batches:
            texts = batch.column(1).to_pylist()
            got = np.concatenate([moderator.scores_of(texts[at : at + TEXTS_AT_ONCE]) for at in range(0, len(texts), TEXTS_AT_ONCE)] or [np.zeros((0, len(CATEGORIES)))])
            own = [batch.column(i) for i in range(batch.num_columns) if i != 1]
            yield pa.RecordBatch.from_arrays([*own, *[pa.array(got[:, k]) for k in range(len(CATEGORIES))]], names=[key, *keep, *CATEGORIES])

    narrow = documents.select(key, text, *keep)
    schema = T.StructType([*narrow.drop(text).schema.fields, *[T.StructField(c, T.DoubleType()) for c in CATEGORIES]])
    return narrow.mapInArrow(scan, schema)


def present(scored: DataFrame, key: str, threshold: float = THRESHOLD) -> DataFrame:
    """(key, category): one row for each category whose score reaches the threshold."""
    pairs = F.array(*[F.when(F.col(c) >= threshold, F.lit(c)) for c in CATEGORIES])
    return scored.select(key, F.explode(F.filter(pairs, lambda x: x.isNotNull())).alias("category"))


def rates(scored: DataFrame, source: str, threshold: float = THRESHOLD) -> DataFrame:
    """(source, documents, and of each category the rate); documents without a source are one group of null."""
    return scored.groupBy(source).agg(F.count(F.lit(1)).alias("documents"), *[F.avg((F.col(c) >= threshold).cast("double")).alias(f"{c}_rate") for c in CATEGORIES])
