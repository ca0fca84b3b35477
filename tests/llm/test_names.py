import itertools
import random

from feedloom.llm import names as n


def linked(spark, rows):
    df = spark.createDataFrame(rows, "id long, provider string, name string")
    return {tuple(r) for r in n.variant_pairs(n.same_organisation(df, "id", "provider", "name")).collect()}


VARIANTS = [
    ("Jukelmer Nakelva Bus Company", None),
    ("JUKELMER NAKELVA BUS CO.", "Tram"),
    ("Nakelva Jukelmer Bus Company", None),
    ("Bus Company of Jukelmer Nakelva", None),
    ("Nakelva, Jukelmer (Bus Company)", None),
    ("Jukelmer Nakeva Bus Company", ""),
    ("Jukemler Nakelva Bus Company Ltd", None),
    ("JukelmerNakelva Bus Company", None),
    ("Jukelmer-Nakelva Bus Company", None),
    ("Jükelmér Nakelva Bus Comp.", None),
    ("Jukelm. Nakelva Bus Company", None),
    ("JNBC - Jukelmer Nakelva", "Night services"),
    ("JNBC (Jukelmer Nakelva Bus Company)", None),
    ("J.N.B.C.", "Jukelmer Nakelva Bus Company - Tram"),
    ("JukeNak", "Jukelmer Nakelva Bus Company network"),
    ("The Jukelmer", "Jukelmer Nakelva Bus Company"),
    ("Jukelmer Company", "Jukelmer Nakelva Bus Company"),
    ("Jukelmer Nakelva", "Weekend"),
]
OTHERS = [("Latirpel Laselgri Municipal Transport Department", None), ("Latirpa Fawaho Transportation District", "Tram"), ("J.N.B.C.", None), (None, "Jukelmer Nakelva Bus Company"), ("  ", None), ("Jukelmer Metro", "Ferries")]


def test_all_variants_meet(spark):
    rows = [(i, p, m) for i, (p, m) in enumerate(VARIANTS)] + [(100 + i, p, m) for i, (p, m) in enumerate(OTHERS)]
    assert linked(spark, rows) == {(a, b) for a, b in itertools.combinations(range(len(VARIANTS)), 2)}


def test_copies_give_no_pairs_and_empty_is_empty(spark):
    assert linked(spark, [(1, "Kanawa Wazori Metro", None), (2, "Kanawa Wazori Metro", "Tram")]) == set()
    assert linked(spark, [(1, None, None)]) == set()


def test_same_words_of_another_kind_stay_apart(spark):
    rows = [(1, "Kanawa Wazori Metro", None), (2, "Kanawa Wazori Metroo", None), (3, "Kanawa Wazori Ferry Services", None), (4, "Kanawa Wazzori Ferry Services", None)]
    assert linked(spark, rows) == {(1, 2), (3, 4)}


def test_readings_that_fail_against_the_first_are_compared(spark):
    # kinds that overlap, below a frequent reading of another one
    rows = [(i, "Jukelmer Nakelva Bus Company", None) for i in range(5)] + [(10, "Jukelmer Nakelva Ferry Services", None), (11, "Jukelmer Nakelvo Ferry", None)]
    # three kinds, so that the second reading of a key fails too
    rows += [(20 + 10 * k + i, f"Kanawa {w} {kind}", None) for k, kind in enumerate(("Metro", "Ferry", "Railway")) for i, w in enumerate(("Wazori", "Wazzori"))]
    assert linked(spark, rows) == {(10, 11), (20, 21), (30, 31), (40, 41)}
    # by cost: the frequent reading shares two tokens, but has two others
    nodes = spark.createDataFrame([("abelmar corvina delgoro fenwick grimald||", 9), ("abelmar corvina hostrel||", 2), ("abelmar corvino hostrel||", 1)], "reading string, freq long")
    assert {tuple(r) for r in n.ties(nodes).collect()} == {("abelmar corvino hostrel||", "abelmar corvina hostrel||")}


def test_hot_organisations_are_spread(spark, monkeypatch):
    monkeypatch.setattr(n, "SPREAD_ROWS", 5)
    rows = [(i, p, m) for i, (p, m) in enumerate(VARIANTS)]
    assert linked(spark, rows) == {(a, b) for a, b in itertools.combinations(range(len(VARIANTS)), 2)}


def test_symmetric_deletes_share_a_key_within_the_distance():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ("".join(rng.choice("abcdefgh") for _ in range(8)) for _ in range(2))
        i, j = rng.randrange(8), rng.randrange(8)
        c, d = a[:i] + a[i + 1 :], b[:j] + rng.choice("xyz") + b[j:]
        assert set(n.neighbour_keys((a, b), frozenset()).tolist()) & set(n.neighbour_keys((d, c), frozenset()).tolist())


def test_assignment():
    assert n.align(("ab12", "cdef"), ("cdef", "ab12"), frozenset(), frozenset()) == 0
    assert n.align(("jukelmer", "n"), ("jukelmer", "nakelva"), frozenset({"n"}), frozenset()) == 0.5
    assert n.align(("aaaa",), ("bbbb",), frozenset(), frozenset()) >= 99


def test_single_tokens_and_long_names_meet(spark):
    long = "Abelmar Corvina Delgoro Fenwick Grimalda Hostrel Ivendor Jukelmer Nakelva"
    rows = [(1, "Greyhound Lines", None), (2, "Grehound Lines", None), (3, "Kanawaro Lines", None), (4, long, None), (5, long.replace("Abelmar", "Zbelmar"), None), (6, long.replace("Corvina ", ""), None)]
    assert linked(spark, rows) == {(1, 2), (4, 5), (4, 6), (5, 6)}
    ends = (("abelmar", "corvina", "delgoro", "fenwick", "grimald", "hostrel"), ("abelmar", "corvinx", "dexgoro", "fenwixk", "gxrimald", "hostrel"))
    assert set(n.neighbour_keys(ends[0], frozenset()).tolist()) & set(n.neighbour_keys(ends[1], frozenset()).tolist())


def test_long_assignment_is_optimal():
    rng = random.Random(3)
    for _ in range(200):
        rows, columns = sorted((rng.randint(0, 5), rng.randint(1, 5)))
        costs = [[rng.choice((0, 0.5, 1, 2, 99)) for _ in range(columns)] for _ in range(rows)]
        assert n.assignment(costs) == min(sum(costs[i][j] for i, j in enumerate(p)) for p in itertools.permutations(range(columns), rows))
    tokens = tuple(sorted(f"{c}akelva" for c in "bcdfghjkl"))
    assert n.align(tokens, tokens[1:], frozenset(), frozenset()) == 3


def test_words_of_kind_with_any_first_letters():
    assert n.kind_of("xransit", False) == "transit"
    assert n.kind_of("xzansportation", False) == "transportation"


def test_initialisms_are_no_words_of_kind():
    assert n.read_row("SVIC - Selpelda Vinraba", None) == (("selpelda", "vinraba"), (), "")
    assert n.read_row("SELPELDA VINRABA BUS CO.", None) == (("selpelda", "vinraba"), (), "bus company")
    assert n.read_row("Nortirtho Fenriwes Transit Authority", None)[0] == ("fenriwes", "nortirtho")


def test_all_of_the_second_text_counts(spark):
    assert n.named_part("Jukelmer Nakelva Bus Company - Night services") == n.named_part("Jukelmer Nakelva: Harbour lines") == n.named_part("Jukelmer Nakelva Airport shuttle") == (("jukelmer", "nakelva"), ())
    assert n.named_part("Bus Company of Jukelmer Nakelva") == (("jukelmer", "nakelva"), ())
    assert n.named_part(None) == ((), ())
    assert linked(spark, [(1, "NV", "Northern Valley Harbour Lake"), (2, "NV Co", "Northern Valley Mountain Coach"), (3, "NVHL", "Northern Valley Harbour Laek")]) == {(1, 3)}


def misspelt(rng, name):
    """A name as typed by someone else: edits, other order, abbreviations, initials of the kind, joined words."""
    words = name.split()
    proper, kind = words[:-2], words[-2:]
    way = rng.choice(["edit", "edit", "two", "swap", "order", "short", "join", "kind", "comma", "case"])
    if way in ("edit", "two", "swap"):
        for _ in range(2 if way == "two" else 1):
            k = rng.randrange(len(proper))
            w = proper[k]
            i = rng.randrange(len(w) - 1)
            proper[k] = w[:i] + w[i + 1] + w[i] + w[i + 2 :] if way == "swap" else rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice("aeioknrst") + w[i:], w[:i] + rng.choice("aeioknrst") + w[i + 1 :]])
    elif way == "order":
        return " ".join([*kind, "of", *proper[::-1]])
    elif way == "short":
        k = rng.randrange(len(proper))
        proper[k] = proper[k][: rng.choice([1, 4])] + "."
    elif way == "join":
        return " ".join(["".join(w.capitalize() for w in proper), *kind])
    elif way == "kind":
        kind = [kind[0][:4] + ".", *kind[1:]]
    elif way == "comma":
        return f"{proper[-1]}, {' '.join(proper[:-1])} ({' '.join(kind)})"
    out = " ".join([*proper, *kind])
    return out.upper() if way == "case" else out


def test_recall_and_precision_on_generated_misspellings(spark):
    """Unseen names of two to nine proper words; each organisation's spellings must meet and no others."""
    rng = random.Random(11)
    syllables = [a + b for a in "bcdfghjklmnprstvz" for b in ("al", "er", "in", "or", "ume", "ath")]
    rows, owner = [], []
    for o in range(120):
        words = ["".join(rng.sample(syllables, rng.choice([2, 3]))).capitalize() for _ in range(rng.choice([2, 2, 2, 3, 3, 4, 6, 9]))]
        name = " ".join([*words, *rng.choice(["Bus Company", "Transit Authority", "Ferry Services", "Public Transport"]).split()])
        spellings = [name, *dict.fromkeys(misspelt(rng, name) for _ in range(6))]
        for t in dict.fromkeys(spellings):
            rows.append((len(rows), t, rng.choice([None, "Night services", t])))
            owner.append(o)
    true = {(a, b) for a, b in itertools.combinations(range(len(rows)), 2) if owner[a] == owner[b]}
    got = linked(spark, rows)
    assert len(true & got) / len(true) >= 0.9
    assert len(true & got) / len(got) >= 0.98
    print("recall", len(true & got) / len(true), "precision", len(true & got) / len(got))
