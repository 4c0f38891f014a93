import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from curvelake.llm import tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def expected(text):
    return len(LIBRARY.encode(text, add_special_tokens=False).ids)


HARD = ["", " ", "a", "aaaa" * 50, "aaa aaa  aaa", "  \n\n\t x", "don't we'll I'VE", "été ÜBER straße", "日本語 テキスト 𝒳🙂🙂", "1234567 ½ ²",
        "<|endoftext|>", "a<|endoftext|>b<|endoftext|><|endoftext|>", "<|endoftext", "!!!!!!!!!" * 30, "\x1c\x1d x\x85y z　", "x" * 5000]


def test_ragged_merging_counts_as_the_library():
    merges = tokens.Merges(PATH)
    assert merges.counts(HARD) == [expected(t) for t in HARD]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=80), max_size=5))
def test_any_text(texts):
    assert tokens.merges(PATH).counts(texts) == [expected(t) for t in texts]


def test_random_bytes_of_letters():
    rng = random.Random(5)
    texts = ["".join(rng.choice("aabcde th in\n") for _ in range(rng.randrange(400))) for _ in range(200)]
    assert tokens.merges(PATH).counts(texts) == [expected(t) for t in texts]


def test_table(spark):
    rows = [(1, "one two", "x"), (1, "one two", "x"), (2, None, "x"), (None, "", "x"), (3, "word " * 20_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, n_tokens string")
    found = sorted(map(tuple, tokens.token_counts(docs, PATH).collect()), key=str)
    long = expected(rows[-1][1])
    assert found == sorted([(1, 7, 2, False), (1, 7, 2, False), (2, 0, 0, False), (None, 0, 0, False), (3, 100_000, long, True)], key=str)
    assert tokens.token_counts(docs.limit(0), PATH).count() == 0


@pytest.mark.parametrize("limit", [1, 2])
def test_limit(spark, limit):
    docs = spark.createDataFrame([(1, "one two")], "doc_id int, text string")
    assert tokens.token_counts(docs, PATH, limit).first().over_limit is (limit < 2)
