import itertools
import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from feedloom.llm import lattice as la
from feedloom.llm import moderation as m

GROUPS = ["Velmora", "Tessaly Isles", "Orrandia", "Kestrelund"]


@pytest.fixture(scope="module")
def examples(data):
    return [tuple(r) for r in pd.read_parquet(f"{data}/moderation_examples.parquet")[["text", "category"]].values]


@pytest.fixture(scope="module")
def groups(data):
    return sorted(pd.read_parquet(f"{data}/places.parquet")["country_name"].unique())


@pytest.fixture(scope="module")
def moderator(examples):
    return m.Moderator(examples, GROUPS)


def categories(moderator, text):
    return [c for c, s in zip(m.CATEGORIES, moderator.scores(text), strict=True) if s >= m.THRESHOLD]


def restored(moderator, text):
    return " ".join(moderator.reader.names[w] for s in moderator.reader.sentences(text) for w in s)


def test_viterbi_finds_the_cheapest_of_all_readings():
    lattice = la.Lattice(Counter(dict.fromkeys("idiot idiots parasite worthless moron nudes sex the a you pig bus stop".split(), 3)))
    rng = random.Random(1)
    for _ in range(150):
        span = "".join(rng.choice("idotps10*@ .$x-") for _ in range(rng.randint(2, 6)))
        if span.count("*") <= 2:
            cheapest = min(sum(p for _, p in path) + sum(lattice.model.word_cost(w) for w in "".join(x for x, _ in path).split(" ")) for path in itertools.product(*lattice.steps(span)))
            assert lattice.search(span)[0] == pytest.approx(cheapest, abs=1e-2), span


def test_disguises_are_undone(moderator):
    pairs = [("p4r451t35", "parasites"), ("i***t", "idiot"), ("1d10t", "idiot"), ("id​iots", "idiots"), ("p a r a s i t e s", "parasites"), ("bаstаrds", "bastards"), ("m.o.r.o.n", "moron"), ("paaaaarasites", "parasites"), ("w0rthl355", "worthless"), ("ｐａrasites", "parasites")]
    pairs += [("s e x", "sex"), ("you are a p i g", "you are a pig"), ("1 d 1 0 t", "idiot"), ("idi" + "o" * 60 + "t", "idiot"), ("id\U000e0061iots", "idiots"), ("w*******s", "worthless"), ("id-iots", "idiots"), ("i*d*i*o*t", "idiot"), ("n.u.d.3.s!", "nudes")]
    for disguised, plain in pairs:
        assert restored(moderator, disguised) == plain, disguised
    for text in ("fares v2 and stop times txt at stop 12b", "the tram leaves at 17 40", "platforms a b c", "stops 1 2 3", "bus stop"):
        assert restored(moderator, text) == text


def test_held_out_templates(examples, groups):
    """Each group of examples that are worded alike is left out of the fitting in turn."""
    first = m.Moderator(examples, groups, fitted=False)
    clusters: list[tuple[str, set, list]] = []
    for text, category in examples:
        if category == "none":
            continue
        k = m.CATEGORIES.index(category)
        best = max(([first.reader.names[w] for w in s] for s in first.reader.sentences(text)), key=lambda s: first.scores(" ".join(s))[k])
        for c, words, held in clusters:
            if c == category and len(words & set(best)) >= 0.4 * min(len(words), len(set(best))):
                held.append(text)
                break
        else:
            clusters.append((category, set(best), [text]))
    assert len(clusters) > 15
    hits = total = 0
    for category, _, held in clusters:
        fitted = m.Moderator([e for e in examples if e[0] not in set(held)], groups)
        hits += sum(categories(fitted, t) == [category] for t in held)
        total += len(held)
    assert hits / total >= 0.95
    none = [t for t, c in examples if c == "none"]
    wrong = 0
    for k in range(4):
        fitted = m.Moderator([e for e in examples if e[0] not in set(none[k::4])], groups)
        wrong += sum(categories(fitted, t) != [] for t in none[k::4])
    assert wrong / len(none) <= 0.05


def test_decoding_and_fitting_each_decide_rows(examples, groups, data):
    texts = pd.read_parquet(f"{data}/documents.parquet")["text"].tolist()
    texts += ["You are an 1d10t and a l.0.s.e.r", "V e r m i n, all those Velmorans!", "These zonk riders blafasel!"]
    labelled = [*examples, *[("These zonk riders blafasel!", "abusive"), ("The riders pay.", "none")] * 15]
    rows = lambda **k: {tuple(x) for x in np.argwhere(m.Moderator(labelled, groups, **k).scores_of(texts) >= m.THRESHOLD)}
    whole = rows()
    assert whole - rows(decoded=False)
    assert whole - rows(fitted=False)


def test_categories(moderator):
    assert categories(moderator, "You are a useless 1d10t, go to hell.") == ["abusive"]
    assert categories(moderator, "Tessalians are v e r m i n and should be deported.") == ["hateful"]
    assert categories(moderator, "Send me your nudeees tonight") == ["sexual"]
    assert categories(moderator, "You stupid moron, I will break your jaw. Velmorans are parasites. Watch free porn.") == ["abusive", "hateful", "sexual"]
    assert categories(moderator, "Orrandians? An infestation, and they must be exterminated.") == ["hateful"]
    assert categories(moderator, "He deserves a bullet and you will bleed, I have a knife for you.") == ["abusive"]
    assert categories(moderator, "Eres un idiota.") == categories(moderator, "Du bist ein Vollidiot.") == categories(moderator, "Ты идиот.") == ["abusive"]


def test_sentences_go_on(moderator):
    assert categories(moderator, "Couple seeks third for a FILTHY!! night, bring lube, meet at the quay.") == ["sexual"]
    assert categories(moderator, "Looking for a dirty\nhookup near the quay, no\ncondoms.") == ["sexual"]


def test_reports_and_rules_are_none(moderator):
    for text in ("Abusive language towards staff is not tolerated and will be reported.", "Vermin control closes the ferry on Monday.", "The exhibition on hatred and war travels by tram.", "To stop the importer, kill the process.", "Adult fares apply from age 21; the explicit stop list is in the annex.", "The naked-bike parade blocks the street.", "The rider survey asks for age, sex and home stop.", "Line 3 is a dead end; drivers shoot past it in fog.", "Los trenes llegan con retraso."):
        assert categories(moderator, text) == [], text


def test_every_sentence_is_scored(moderator):
    texts = ["The tram is late.", None, "You idiot!", "", " \n ", "The tram is late."]
    got = moderator.scores_of(texts)
    assert [tuple(r) for r in got] == [moderator.scores(t) for t in texts]
    assert (got[0] > 0).all() and (got[[1, 3, 4]] == 0).all()
    assert m.Moderator([], []).scores("You idiot!")[0] >= m.THRESHOLD


def test_table_nulls_and_rates(spark, data):
    df = spark.createDataFrame([(1, "Go to hell, moron.", "a"), (2, None, "a"), (3, "", None), (4, " \n ", None), (5, "All fine. " * 20_000 + "You idiot!", "a"), (5, "You idiot!", "a")], "doc_id long, text string, source string")
    ex, places = spark.read.parquet(f"{data}/moderation_examples.parquet"), spark.read.parquet(f"{data}/places.parquet").select("country_name")
    scored = m.moderate(df, "doc_id", "text", ex, places, ("source",))
    assert sorted(tuple(r) for r in m.present(scored, "doc_id").collect()) == [(1, "abusive"), (5, "abusive"), (5, "abusive")]
    got = {r["source"]: (r["documents"], r["abusive_rate"]) for r in m.rates(scored, "source").collect()}
    assert got == {"a": (4, 0.75), None: (2, 0.0)}
    assert m.moderate(df.limit(0), "doc_id", "text", ex, places).count() == 0
