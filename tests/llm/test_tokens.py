import base64
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from callweave.llm.tokens import VOCABULARY, Encoder, count_tokens, encode_column

pytestmark = pytest.mark.skipif(not os.path.exists(VOCABULARY), reason="no vocabulary")
SCHEMA = "doc_id long, text string, ids string, n_tokens long"
TEXTS = [None, "", " ", "Hello  world's café\n\n\t x", "<|endoftext|> is text", "\x0b\x1f \x1c1234", "👩🏽‍🔬 é 日本語の文", "a" * 30_000, "ab " * 20_000]


@pytest.fixture(scope="module")
def encoder():
    with open(VOCABULARY, "rb") as f:
        return Encoder(f.read())


@pytest.fixture(scope="module")
def public():
    tiktoken = pytest.importorskip("tiktoken")
    pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    with open(VOCABULARY, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def test_whole_table(spark, public):
    df = spark.createDataFrame([(i, t, "x", 0) for i, t in enumerate(TEXTS)], SCHEMA)
    got = {r["doc_id"]: r["ids"] for r in encode_column(df, "doc_id", "text").collect()}
    assert got == {i: public.encode_ordinary(t) if t else [] for i, t in enumerate(TEXTS)}
    n = {r["doc_id"]: r["n_tokens"] for r in count_tokens(df, ["doc_id"], "text").collect()}
    assert n == {i: len(ids) for i, ids in got.items()}
    assert encode_column(spark.createDataFrame([], SCHEMA), "doc_id", "text").count() == 0


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=80))
def test_any_text(encoder, public, text):
    assert next(encoder.encode([text])) == public.encode_ordinary(text)


def test_round_trip_and_merges(encoder):
    ids = next(encoder.encode(["The quick brown fox — naïve façade, 12345!"]))
    assert b"".join(encoder.token[i] for i in ids).decode() == "The quick brown fox — naïve façade, 12345!"
    word = ("abcde" * 40).encode()
    assert encoder.merged(word) == encoder.merged_long(word)
