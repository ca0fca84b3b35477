import random
import re

import numpy as np

from feedloom.llm import leakage as lk

ITEM = "Read the passage. The shared caption mentions 365 labourers and a seasonal signal paid for by Mazancre Transit Authority after a vote of 70 against 332."


def found(spark, docs, items=((1, ITEM),), run=lk.leaked):
    d = spark.createDataFrame(docs, "doc_id long, text string, template string")
    i = spark.createDataFrame(list(items), "item_id long, text string")
    return sorted(tuple(r) for r in run(d, "doc_id", "text", i, "item_id", "text").collect())


def test_passages(spark):
    words = ITEM.split()
    docs = [
        (1, "Before. " + ITEM.upper() + " After.", "x"),
        (2, " ".join(words[4:16]), "x"),
        (3, " ".join(words[4:15]), "x"),
        (4, "> the SHARED,\n> caption -- mentions (365) labourers;\n> and a seasonal signal paid for by", "x"),
        (5, ITEM.replace("365", "366").replace("signal", "tram").replace("70", "71").replace("after", "so"), "x"),
        (6, None, None),
        (7, "", ""),
        (1, ITEM, "copy"),
    ]
    assert found(spark, docs) == [(1, 1), (2, 1), (4, 1)]


def test_reparameterised_items(spark):
    renamed = ITEM.replace("365", "17").replace("Mazancre", "Wolfram").replace("70", "9").replace("332", "4")
    inconsistent = "x " + ITEM
    assert [r[0] for r in found(spark, [(1, renamed, ""), (2, inconsistent, ""), (3, "nothing of that kind at all", "")], run=lk.reparameterised)] == [1]


def test_all_renamed_items_of_a_document_are_given(spark):
    other = "the tram carries 5 riders and the same 5 riders come back at night"
    sibling = ITEM.replace("365", "17").replace("70", "9").replace("332", "4")
    docs = [(1, ITEM.replace("365", "18").replace("70", "8").replace("332", "3") + " So " + other.replace("5", "6"), ""), (2, other.replace("5", "7"), ""), (3, other, "")]
    got = found(spark, docs, [(5, ITEM), (7, sibling), (90, other), (91, other)], lk.reparameterised)
    assert {(d, i) for d, _, i in got} == {(1, 5), (1, 7), (1, 90), (1, 91), (2, 90), (2, 91)}
    windows = {(d, i): w for d, w, i in got}
    assert windows[1, 5] == windows[1, 7] > windows[1, 90] == windows[2, 91] == 3


def test_slots_must_agree_in_pattern(spark):
    item = "the tram carries 5 riders and the same 5 riders come back at night"
    docs = [(1, item.replace("5", "8"), ""), (2, "the tram carries 8 riders and the same 9 riders come back at night", "")]
    assert [r[0] for r in found(spark, docs, [(1, item)], lk.reparameterised)] == [1]


def test_empty_tables_and_short_items(spark):
    assert found(spark, [(1, ITEM, "")], [(1, "too short")]) == []
    assert found(spark, [(1, ITEM, "")], [(1, None)]) == []


def test_a_full_filter_and_a_shuffled_join_change_nothing(spark, monkeypatch):
    renamed = ITEM.replace("365", "17").replace("Mazancre", "Wolfram").replace("70", "9").replace("332", "4")
    docs = [(i, "Before. " + (ITEM if i % 3 else renamed), "") for i in range(12)]
    items = [(1, ITEM), (2, ITEM + " And more."), (3, "the tram carries 5 riders and the same 5 riders come back at night")]
    want = found(spark, docs, items), found(spark, docs, items, lk.reparameterised)
    assert want[0] == [(i, j) for i in range(12) if i % 3 for j in (1, 2)] and {r[0] for r in want[1]} == {0, 3, 6, 9}
    monkeypatch.setattr(lk, "BLOOM_BYTES", 16)
    monkeypatch.setattr(lk, "BROADCAST_WINDOWS", 0)
    monkeypatch.setattr("feedloom.operators.skew.HOT_ROWS", 4)
    assert found(spark, docs, items) == want[0]


def test_bloom():
    rng = np.random.default_rng(1)
    own, other = rng.integers(-(2**63), 2**63 - 1, 5000), rng.integers(-(2**63), 2**63 - 1, 20000)
    b = lk.Bloom(np.zeros(lk.Bloom.size(5000), np.uint8))
    b.add(own)
    assert b.may_hold(own).all() and b.may_hold(other).mean() < 0.01


def test_renamed_items_are_found(spark, data):
    """Recall on items of the suite whose numbers are replaced, one by one."""
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{data}/eval_items.parquet").collect()]
    rng = random.Random(4)
    docs, want = [], set()
    for i, text in items:
        slots = {n: str(rng.randint(1000, 9999)) for n in re.findall(r"\b[0-9]+\b", text)}
        words = re.findall(r"[^\W_]+", text)
        if any(w in slots for w in words[:12]) and len(words) >= 12 and len(set(slots.values())) == len(slots):
            docs.append((i, re.sub(r"\b[0-9]+\b", lambda m: slots[m[0]], text), ""))
            want.add((i, i))
    got = {(d, i) for d, _, i in found(spark, docs, items, lk.reparameterised)}
    assert len(want) > 20 and len(want & got) / len(want) >= 0.95


def test_very_long_text(spark):
    assert found(spark, [(1, "word " * 200_000 + ITEM, "")]) == [(1, 1)]
