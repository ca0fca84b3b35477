import base64

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from feedloom.llm import tokenize as k

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")

RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
REFERENCE = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
ENCODER = k.Encoder(RANKS, P.PATTERN)


def ids(text):
    return ENCODER.encode_batch([text])[0].tolist()


@settings(max_examples=500, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    assert ids(text) == REFERENCE.encode_ordinary(text)


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="abcdeinorst", max_size=30))
def test_words_that_greedy_matching_gets_wrong(text):
    assert ids(text) == REFERENCE.encode_ordinary(text)


def test_greedy_matching_is_in_fact_corrected():
    assert any(ENCODER.propose(w) != ENCODER.merge(w) for w in (b"undesirable", b"multithreading", b"antidisestablishment", b"timetables", b"fareattributes"))


def test_table(spark):
    df = spark.createDataFrame([(1, "the feed"), (2, None), (3, ""), (4, "<|endoftext|> 🚌 été"), (5, "a" * 100_000), (1, "the feed")], "doc_id long, text string")
    got = [(r["doc_id"], list(r["ids"])) for r in k.encode(df, "doc_id", "text").collect()]
    texts = [r["text"] for r in df.collect()]
    assert [g[1] for g in got] == [REFERENCE.encode_ordinary(t) if t else [] for t in texts]
    assert k.encode(df.limit(0), "doc_id", "text").count() == 0
