import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from weirflow.llm.tokens import ChunkTokenizer, text_steps, tokenizer_json

JSON = tokenizer_json()
FULL, FAST = Tokenizer.from_str(JSON), ChunkTokenizer(JSON)

PLAIN = st.text("abcDEF'stmrveld .,!09é߀Ñ÷×\t\n_", max_size=40)
ODD = st.text("aB '\x00\x0b\x1c\x85 ́İſΣσς²½中😀<|>", max_size=20)
PARTS = st.sampled_from(["<|endoftext|>", "'re", "'s's", "a'll", "''ve", "<|ENDOFTEXT|>", "x'd1", " 't"])


def expected(text):
    return FULL.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.one_of(PLAIN, ODD, PARTS), max_size=4).map("".join), max_size=6))
def test_ids_are_those_of_the_tokenizer(texts):
    found = FAST.encode(pa.array(texts, pa.string()))
    assert [np.frombuffer(f, "<u4").tolist() for f in found] == [expected(t) for t in texts]


def test_nulls_slices_and_long_texts():
    texts = pa.array(["skip", None, "", "don't " * 50_000, "end"], pa.string()).slice(1)
    found = FAST.encode(texts)
    assert [len(f) // 4 for f in found] == [0, 0, 100_000, 1]


def test_contractions_do_not_reach_into_the_next_text():
    found = FAST.encode(pa.array(["it'", "s", "they'r", "e"]))
    assert [np.frombuffer(f, "<u4").tolist() for f in found] == [expected(t) for t in ("it'", "s", "they'r", "e")]


def test_forgetting_words(monkeypatch):
    import weirflow.llm.tokens as tokens

    monkeypatch.setattr(tokens, "KNOWN_WORDS", 3)
    small = ChunkTokenizer(JSON)
    for text in ("one two three four", "five one two", "one"):
        assert np.frombuffer(small.encode(pa.array([text]))[0], "<u4").tolist() == expected(text)


def test_steps_cover_all_rows():
    texts = pa.array(["x" * 600_000, None, "y" * 600_000, "z"])
    assert list(text_steps(texts)) == [3, 1]
    assert list(text_steps(pa.array([], pa.string()))) == []
