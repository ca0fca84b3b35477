"""Variant spellings of organisations linked.

Each row's organisation is read from its name column or, where that leaves it out, from the second one: tokens, the words of
kind (with their abbreviations) apart from the proper words. Distinct readings are linked through a symmetric-delete
neighbourhood index: pairs of proper tokens under all their deletions, so that readings within small edit distances share a key
whatever their order. In each key every reading is tied to the most frequent one, the tie is checked by an optimal assignment of
tokens that permits initials and abbreviations, readings that fail it are tied among themselves in the same way, and the ties,
which form trees, are resolved by pointer doubling.
"""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.hierarchy import roots
from ..operators.skew import hot_keys, salted_lookup
from ..session import cut
from .fold import fold, osa

#: Words of kind in names of transport organisations.
KIND_WORDS = (
    "agency", "authority", "board", "bus", "buses", "city", "coaches", "commission", "company", "cooperative", "corporation",
    "council", "county", "department", "district", "ferries", "ferry", "inter", "intercity", "lines", "metro", "metropolitan",
    "mobility", "municipal", "op", "public", "rail", "railway", "railways", "regional", "service", "services", "subway", "system",
    "trains", "tram", "trams", "tramways", "transit", "transport", "transportation", "trust", "university",
)
#: For abbreviations, short words first, but a company rather than a county or a council.
_BY_USE = sorted(KIND_WORDS, key=lambda w: (w in ("county", "council", "city", "coaches", "commission", "trains", "trams", "trust"), len(w)))
#: Words that say nothing about the organisation.
EMPTY_WORDS = frozenset("the of and de la du for a ltd limited gmbh ag inc llc plc sa corp ab oy bv nv srl kg operations network group".split())
#: Ends of names of legal forms written with points.
LEGAL_ENDS = re.compile(r"(?i)[\s,]+(?:s\.\s?a\.?|l\.l\.c\.?|ltd\.?|inc\.?|gmbh|plc|llc)\s*$")
#: Words for services, which aren't part of an organisation's name where they follow it.
SERVICE_WORDS = frozenset("airport shuttle night weekend weekday school express replacement paratransit trolleybus local seasonal summer winter holiday".split())
#: Where what follows a name begins.
_BREAK = re.compile(r"\s[-–—|/]+\s|[:;(\[,]")
_WORD_OPS = re.compile(r"(?i)\bco-op\b")
_TOKENS = re.compile(r"[^\W_]+\.?")
_INITIALISM = re.compile(r"^(?:[A-Z]{2,8}|(?:[A-Z]\.){2,8})$")
#: Longest token that may be an abbreviated word of kind.
ABBREVIATION = 7
#: Keys that are given out at once, beyond those of one reading.
KEYS_AT_ONCE = 500_000
#: Highest cost of an alignment that ties two readings.
MOST_COST = 4
#: Rows of an organisation from which its rows are spread over several tasks, and the rows of each.
SPREAD_ROWS = 2_000


def is_abbreviation(short: str, word: str) -> bool:
    """Same first letter and the letters of ``short`` in order within ``word``."""
    if not short or len(short) >= len(word) or short[0] != word[0]:
        return False
    rest = iter(word)
    return all(c in rest for c in short)


def deletions(token: str, most: int) -> set[str]:
    """The token and all that remains of it after at most ``most`` deletions."""
    out = layer = {token}
    for _ in range(most):
        layer = {t[:i] + t[i + 1 :] for t in layer for i in range(len(t))}
        out = out | layer
    return out


#: The longer words of kind by what remains of them after at most two deletions.
_KIND_DELETIONS: dict[str, list[str]] = {}
for _w in KIND_WORDS:
    if len(_w) >= 5:
        for _t in deletions(_w, 2):
            _KIND_DELETIONS.setdefault(_t, []).append(_w)


@lru_cache(maxsize=100_000)
def kind_of(token: str, pointed: bool) -> str | None:
    """The word of kind that a folded token stands for: itself, a misspelling, or an abbreviation."""
    if token in KIND_WORDS:
        return token
    if 2 <= len(token) <= ABBREVIATION:
        for w in _BY_USE:
            # longer ones must begin like the word
            if len(w) > 3 and is_abbreviation(token, w) and (len(token) <= 4 or w.startswith(token[:3])):
                return w
    if len(token) >= 5:
        most = 1 if len(token) < 10 else 2
        near = {w for t in deletions(token, most) for w in _KIND_DELETIONS.get(t, ())}
        best = min(((osa(token, w, most), w) for w in near), default=(9, ""))
        if best[0] <= most:
            return best[1]
    return None


@lru_cache(maxsize=200_000)
def read_name(text: str | None) -> tuple[tuple[str, ...], tuple[str, ...], tuple[str, ...]]:
    """(proper tokens, those of them that are abbreviated with a point, initialisms) of a typed name.

    Tokens are folded. Joined words are divided where a lower case letter meets a capital. Initialisms are kept apart.
    """
    if not text or not text.strip():
        return (), (), ()
    shouting = text.upper() == text
    text = _WORD_OPS.sub("coop", LEGAL_ENDS.sub(" ", text.replace("/", "")))
    proper: list[str] = []
    pointed: list[str] = []
    initials: list[str] = []
    words = text.replace("(", " ").replace(")", " ").replace(",", " ").replace("\xa0", " ").split()
    for w in words:
        bare = w.strip("-&;:")
        if is_initialism(bare, shouting, len(words) == 1):
            initials.append(fold(bare.replace(".", "")))
            continue
        for raw in _TOKENS.findall(bare):
            for part in re.sub(r"(?<=[^\W\d_A-Z])(?=[A-Z])", " ", raw).split():
                dot = part.endswith(".")
                token = fold(part).replace(" ", "")
                if not token or token in EMPTY_WORDS or kind_of(token, dot):
                    continue
                proper.append(token)
                if dot or len(token) == 1:
                    pointed.append(token)
    return tuple(proper), tuple(pointed), tuple(initials)


def is_initialism(word: str, shouting: bool, alone: bool) -> bool:
    """Capitals, or single letters with points; in a text of capitals only with points or as its only word."""
    if not _INITIALISM.match(word) or shouting and "." not in word and not alone:
        return False
    token = fold(word.replace(".", ""))
    return kind_of(token, False) != token


def read_kind(text: str | None) -> str:
    """The words of kind in order of the alphabet; '' if there are none. Initialisms say nothing here."""
    if not text:
        return ""
    found = set()
    words = _WORD_OPS.sub("coop", text.replace("/", "")).replace("(", " ").replace(")", " ").replace(",", " ").split()
    for w in words:
        if is_initialism(w.strip("-&;:"), text.upper() == text, len(words) == 1):
            continue
        for raw in _TOKENS.findall(w):
            token = fold(raw)
            word = kind_of(token, raw.endswith(".")) if token and token not in EMPTY_WORDS else None
            if word:
                found.add(word)
    return " ".join(sorted(found))


def named_part(text: str | None) -> tuple[tuple[str, ...], tuple[str, ...]]:
    """(proper tokens, those of them that are abbreviated) of the organisation that a text begins with: all up to a break, a word
    of kind or a word for a service, but at least two, if there are as many."""
    parts = _BREAK.split(text or "")
    proper: list[str] = []
    pointed: list[str] = []
    for part in parts:
        for word in part.split():
            own, short, _ = read_name(word)
            if len(proper) >= 2 and (not own and read_kind(word) or any(t in SERVICE_WORDS for t in own)):
                return tuple(proper), tuple(pointed)
            proper += own
            pointed += short
        if len(proper) >= 2:
            break
    return tuple(proper), tuple(pointed)


def leads_of(kind: str) -> frozenset[str]:
    return frozenset(w[:2] for w in kind.split())


def kinds_agree(a: str, b: str) -> bool:
    """Missing words of kind agree with all; else one's words must begin like the other's."""
    if not a or not b:
        return True
    x, y = leads_of(a), leads_of(b)
    return x <= y or y <= x or len(x & y) * 2 >= len(x | y)


def read_row(first: str | None, second: str | None) -> tuple[tuple[str, ...], tuple[str, ...], str]:
    """(proper tokens in order of the alphabet, abbreviated ones, kind) of a row.

    The first text counts if it has two proper tokens that aren't a contraction; else the second, if it fits the first: it
    begins like it, has its initials, or the first has nothing proper. A row with neither keeps what the first has.
    """
    proper, pointed, initials = read_name(first)
    contracted = len(proper) == 2 and all(len(p) <= 4 for p in proper) and not re.search(r"\s", (first or "").strip())
    if len(proper) >= 2 and not contracted:
        return tuple(sorted(proper)), tuple(sorted(pointed)), read_kind(first)
    body, body_pointed = named_part(second)
    if len(body) >= 2:
        letters = "".join(w[0] for w in body)
        fits = not proper and (not initials or any(i.startswith(letters) or letters.startswith(i) for i in initials))
        fits = fits or any(osa(p, b, 2) <= (1 if len(p) < 7 else 2) or b.startswith(p) for p in proper for b in body)
        if fits:
            return tuple(sorted(body)), tuple(sorted(body_pointed)), ""
    return tuple(sorted(proper or initials)), tuple(sorted(pointed)), read_kind(first)


def edits_allowed(length: int) -> int:
    return 0 if length <= 3 else 1 if length <= 5 else 2


@lru_cache(maxsize=500_000)
def token_cost(a: str, b: str, a_short: bool, b_short: bool) -> float:
    """Cost of aligning two tokens: edits, or half an edit where an abbreviation or initial fits; 99 if they don't."""
    if a == b:
        return 0
    most = edits_allowed(min(len(a), len(b)))
    d = osa(a, b, most)
    if d <= most:
        return d
    if (a_short and (b.startswith(a) or is_abbreviation(a, b))) or (b_short and (a.startswith(b) or is_abbreviation(b, a))):
        return 0.5
    return 99


def assignment(costs: list[list[float]]) -> float:
    """Least total cost of giving each row a column of its own, by the Hungarian method; no more rows than columns."""
    if not costs:
        return 0.0
    n, m = len(costs), len(costs[0])
    of_row, of_column = [0.0] * (n + 1), [0.0] * (m + 1)
    row_of = [0] * (m + 1)  # the row that has a column, from 1; 0 for none
    for i in range(1, n + 1):
        row_of[0], j = i, 0
        least, before, seen = [math.inf] * (m + 1), [0] * (m + 1), [False] * (m + 1)
        while row_of[j]:
            seen[j] = True
            r, step, after = row_of[j], math.inf, 0
            for k in range(1, m + 1):
                if not seen[k]:
                    c = costs[r - 1][k - 1] - of_row[r] - of_column[k]
                    if c < least[k]:
                        least[k], before[k] = c, j
                    if least[k] < step:
                        step, after = least[k], k
            for k in range(m + 1):
                if seen[k]:
                    of_row[row_of[k]] += step
                    of_column[k] -= step
                else:
                    least[k] -= step
            j = after
        while j:
            row_of[j], j = row_of[before[j]], before[j]
    return float(sum(costs[row_of[k] - 1][k - 1] for k in range(1, m + 1) if row_of[k]))


def align(a: tuple[str, ...], b: tuple[str, ...], a_short: frozenset[str], b_short: frozenset[str]) -> float:
    """Least total cost of an assignment of the tokens of the shorter list to those of the other; each token left over costs 3."""
    if len(a) > len(b):
        a, b, a_short, b_short = b, a, b_short, a_short
    left = 3 * (len(b) - len(a))
    if len(b) > 7:
        return left + assignment([[token_cost(x, y, x in a_short, y in b_short) for y in b] for x in a])
    best: dict[int, float] = {0: 0.0}
    for x in a:
        new: dict[int, float] = {}
        for used, cost in best.items():
            for j, y in enumerate(b):
                if not used >> j & 1:
                    c = cost + token_cost(x, y, x in a_short, y in b_short)
                    if c < new.get(used | 1 << j, 1e9):
                        new[used | 1 << j] = c
        best = new
    return left + min(best.values(), default=0.0)


@lru_cache(maxsize=200_000)
def _deletion_hashes(token: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of what remains of a token after at most one deletion, and of what takes two; as many as its length allows."""
    allowed = edits_allowed(len(token))
    one = deletions(token, min(1, allowed))
    two = deletions(token, 2) - one if allowed > 1 else set()
    return tuple(np.array([xxhash.xxh3_64_intdigest(t) for t in sorted(part)], np.uint64) for part in (one, two))


def neighbour_keys(tokens: tuple[str, ...], short: frozenset[str]) -> np.ndarray:
    """Keys that a reading shares with those within one edit in each of two tokens, two edits in one of them, or an abbreviated
    token in one. The hashes of two parts are added, so their order doesn't matter. A single token has keys of its own, for as many
    edits as its length allows."""
    pairs = itertools.combinations(tokens, 2)
    keys: list[np.ndarray] = []
    exact = lambda t: np.uint64(xxhash.xxh3_64_intdigest(t))
    with np.errstate(over="ignore"):
        for a, b in pairs:
            (one_a, two_a), (one_b, two_b) = _deletion_hashes(a), _deletion_hashes(b)
            keys += [np.add.outer(one_a, one_b).ravel(), two_a + exact(b), two_b + exact(a)]
            # an abbreviated token meets the other's exact form through its first letter
            if a in short or len(a) > 3:
                keys.append(np.array([exact(a[0] + ".") + exact(b)], np.uint64))
            if b in short or len(b) > 3:
                keys.append(np.array([exact(b[0] + ".") + exact(a)], np.uint64))
        if len(tokens) == 1:
            keys += [part + exact("s.") for part in _deletion_hashes(tokens[0])]
    return np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.uint64)


def _parts(reading: str) -> tuple[tuple[str, ...], frozenset[str], str]:
    tokens, short, kind = reading.split("|")
    return tuple(tokens.split()), frozenset(short.split()), kind


def readings(df: DataFrame, row_id: str, first: str, second: str) -> DataFrame:
    """(row id, text, reading): the first text and its row's reading; rows without any token are left out."""
    rows = df.select(F.col(row_id).cast("bigint").alias("row"), F.col(first).alias("text"), F.col(second).alias("other"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            clean = batch[["text", "other"]].astype(object).where(batch[["text", "other"]].notna(), None)
            got = [read_row(a, b) for a, b in zip(clean["text"], clean["other"], strict=True)]
            batch["reading"] = [f"{' '.join(t)}|{' '.join(s)}|{k}" if t else None for t, s, k in got]
            yield batch[["row", "text", "reading"]]

    return rows.filter(F.col("row").isNotNull() & F.col("text").isNotNull()).mapInPandas(read, "row bigint, text string, reading string").filter(F.col("reading").isNotNull())


def _keyed(nodes: DataFrame) -> DataFrame:
    """(node, freq, key) of readings."""

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys: list[np.ndarray] = []
            first = held = 0
            for at, r in enumerate(batch["reading"], 1):
                keys.append(neighbour_keys(*_parts(r)[:2]))
                held += len(keys[-1])
                if held >= KEYS_AT_ONCE or at == len(batch):
                    part, sizes = batch.iloc[first:at], [len(k) for k in keys]
                    yield pd.DataFrame({"node": np.repeat(part["node"].to_numpy(), sizes), "freq": np.repeat(part["freq"].to_numpy(), sizes), "key": np.concatenate(keys).view(np.int64)})
                    keys, first, held = [], at, 0

    # a row becomes dozens of keys, so the rows are spread first, however few bytes they are
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return nodes.select("reading", "freq", F.xxhash64("reading").alias("node")).repartition(parts, "node").mapInPandas(keyed, "node bigint, freq bigint, key bigint")


def tie_cost(a: str, b: str) -> float:
    """Cost of aligning two readings; infinite where the kinds differ."""
    (ta, sa, ka), (tb, sb, kb) = _parts(a), _parts(b)
    return align(ta, tb, sa, sb) if kinds_agree(ka, kb) else math.inf


def _checked(first: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, rep, a, b, rep_freq, cost): the distinct pairs of ``first`` with their readings and the cost of aligning them."""
    pairs = first.select("node", "rep").distinct()
    pairs = pairs.join(texts.select("node", F.col("reading").alias("a")), "node")
    # the most frequent readings are tied to by many
    pairs = cut(pairs)
    heads = texts.select(F.col("node").alias("head"), F.col("reading").alias("b"), F.col("freq").alias("rep_freq"))
    pairs = salted_lookup(pairs, heads, "rep", "head", "node", hot_keys(pairs, "rep", pairs.count()), "inner")

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            costs = [tie_cost(a, b) for a, b in zip(batch["a"], batch["b"], strict=True)]
            yield batch.assign(cost=pd.Series(costs, index=batch.index, dtype="float64"))

    return pairs.select("node", "rep", "a", "b", "rep_freq").mapInPandas(check, "node bigint, rep bigint, a string, b string, rep_freq bigint, cost double")


def _tied_again(left: DataFrame) -> DataFrame:
    """(a, b, rep_freq, cost) of the rows (key, node, freq, reading) that failed against the first reading of their key.

    The most frequent of them is the next that the others are compared with, those that fail against it go on with the next, until
    none is left: the rows of a key, in that order, each meet the ones before that were tied to none.
    """

    def tie(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, heads = None, []
        cost_of = lru_cache(maxsize=500_000)(tie_cost)
        for batch in batches:
            out = []
            for k, freq, reading in zip(batch["key"], batch["freq"], batch["reading"], strict=True):
                if k != key:
                    key, heads = k, []
                for head, head_freq in heads:
                    cost = cost_of(reading, head)
                    if cost <= MOST_COST:
                        out.append((reading, head, head_freq, cost))
                        break
                else:
                    heads.append((reading, freq))
            yield pd.DataFrame(list(dict.fromkeys(out)), columns=["a", "b", "rep_freq", "cost"])

    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = left.repartition(parts, "key").sortWithinPartitions("key", F.desc("freq"), "node").select("key", "freq", "reading")
    return ordered.mapInPandas(tie, "a string, b string, rep_freq bigint, cost double").distinct()


def ties(nodes: DataFrame) -> DataFrame:
    """(id, parent): each reading tied to the most frequent one that shares a key and aligns with it.

    nodes: reading, freq. Frequencies fall along no tie (readings of the same frequency go by their hash), so ties form trees.
    Readings that fail against the first of a key, by their kind or their cost, are tied among themselves.
    """
    by_key = Window.partitionBy("key").orderBy(F.desc("freq"), "node")
    first = cut(_keyed(nodes).select("node", "key", F.first("node").over(by_key).alias("rep")).filter("node <> rep"))
    texts = nodes.select(F.xxhash64("reading").alias("node"), "reading", "freq")
    checked = cut(_checked(first, texts))
    good = checked.filter(F.col("cost") <= MOST_COST).select("a", "b", "rep_freq", "cost")
    failed = checked.filter(F.col("cost") > MOST_COST).select("node", "rep")
    # a key with one failed row has none to compare it with
    left = first.join(failed, ["node", "rep"]).select("node", "key")
    left = left.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("key"))).filter("n > 1").drop("n")
    good = good.unionByName(_tied_again(left.join(texts, "node")))
    return good.groupBy(F.col("a").alias("id")).agg(F.min_by("b", F.struct(F.floor("cost"), -F.col("rep_freq"), "b")).alias("parent"))


def same_organisation(df: DataFrame, row_id: str, first: str, second: str) -> DataFrame:
    """(row, text, entity): each row's organisation, named by its most frequent reading.

    Rows with a null or blank first text, or without any token, are left out. Exact copies share their reading, so they are one
    node of the index. An empty table gives an empty result.
    """
    rows = cut(readings(df, row_id, first, second))
    nodes = rows.groupBy("reading").agg(F.count(F.lit(1)).alias("freq"))
    found = roots(ties(nodes)).select("id", F.col("root"))
    # a reading of many rows is salted
    mapped = salted_lookup(rows, found, "reading", "id", "row", hot_keys(rows, "reading", rows.count()))
    return mapped.select("row", "text", F.coalesce("root", "reading").alias("entity"))


def variant_pairs(found: DataFrame) -> DataFrame:
    """(a, b), a < b: rows of the same organisation whose texts differ.

    Organisations that hold many of the rows are spread: their rows on one side over several parts, on the other repeated in
    each.
    """
    found = cut(found)
    rows = found.count()
    large = hot_keys(found, "entity", rows, least=SPREAD_ROWS)
    right = found.select(F.col("entity").alias("e"), F.col("row").alias("b"), F.col("text").alias("other"))
    joined = salted_lookup(found.withColumnRenamed("row", "a"), right, "entity", "e", "a", large, "inner")
    return joined.filter((F.col("a") < F.col("b")) & (F.col("text") != F.col("other"))).select("a", "b")
