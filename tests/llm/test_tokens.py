import base64

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexharbor.llm.tokens import VOCABULARY, WORDS, Automaton, Encoder, decode_corpus, encode_corpus, read_vocabulary, token_count

tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def encoder():
    return Encoder(Automaton(*read_vocabulary()))


@pytest.fixture(scope="module")
def library():
    with open(VOCABULARY.replace(".json", ".tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})


SOME = st.lists(st.sampled_from(["a", "aa", "the", " the", "ing", "'s", "==", "---", " ", "  ", "\n", "\t", "\x1c", "\x85", "​", "é", "日本", "ﬁ", "𝔘", "12", "<|endoftext|>", "हिन्दी", "e\u0301", "ß"]), max_size=30).map("".join)


@settings(max_examples=1500, deadline=None)
@given(st.one_of(SOME, st.text(max_size=40), st.text("abn", max_size=60)))
def test_same_ids_as_the_library_and_back(encoder, library, text):
    ids = encoder.encode(text)
    assert ids == library.encode_ordinary(text)
    assert encoder.automaton.decode(ids) == text


def test_tiny_automaton_against_merging():
    tokens = [bytes([b]) for b in range(97, 100)]  # a b c
    merges = []
    for a, b in [(0, 0), (0, 1), (3, 1), (3, 3), (1, 2), (4, 2), (6, 0)]:
        merges.append((a, b, len(tokens)))
        tokens.append(tokens[a] + tokens[b])
    automaton = Automaton(tokens, merges)

    def merged(word):
        ids = [w - 97 for w in word]
        for u, v, w in merges:
            out, i = [], 0
            while i < len(ids):
                two = ids[i : i + 2] == [u, v]
                out.append(w if two else ids[i])
                i += 1 + two
            ids = out
        return ids

    words = [b""]
    for _ in range(8):
        words = [*{w + x for w in words for x in (b"a", b"b", b"c", b"")}]
    assert all(automaton.encode_word(w) == merged(w) for w in words)


def test_long_words(encoder, library):
    for text in ("ab" * 20_000, "=" * 30_001, " " * 30_000 + "x", "é" * 9_999):
        assert encoder.encode(text) == library.encode_ordinary(text)


def test_corpus(spark, library):
    rows = [(1, "The end."), (1, "The end."), (2, ""), (3, None), (4, " \n "), (5, "<|endoftext|>"), (6, "long " * 50_000)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, ids string")
    got = decode_corpus(encode_corpus(df)).collect()
    assert [(r.doc_id, list(r.ids)) for r in got] == [(i, library.encode_ordinary(t or "")) for i, t in rows]
    assert [r.decoded for r in got] == [t or "" for _, t in rows]
    assert [r[0] for r in df.select(token_count(df)).collect()] == [len(r.ids) for r in got]
    assert encode_corpus(df.limit(0)).count() == 0
