"""Token counts against encoding every text whole."""

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tidepanel.llm import queries
from tidepanel.llm.token_counts import Counter, counter, with_token_counts

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def whole():
    model = SentencePieceProcessor(model_file=PIECES)
    return lambda text: len(model.encode(text or "", num_threads=1))


@given(st.text(st.one_of(st.sampled_from(list("ab1 .\n\t▁ ́é<s>/|")), st.characters(exclude_categories=["Cs"]))),
       st.integers(1, 9))
@settings(max_examples=300, deadline=None)
def test_parts_add_up(text, size):
    for path in (PIECES, BYTES, WORDS):
        count = counter(path)
        assert count.cuts
        assert count.count(iter([text * 3]), 1, size)[0] == count.lengths([text * 3])[0]


def test_words_between_spaces_are_cut():
    parts = list(counter(PIECES).parts("aa bb  cc. dd ee", 1))
    assert parts == ["aa", "bb  cc. dd", "ee"]
    assert list(counter(BYTES).parts("aa bb", 1)) == ["aa", " bb"]
    assert list(counter(PIECES).parts("x" * 50, 5)) == ["x" * 50]


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        Counter("words.txt")


def test_json_defaults_keep_special_strings():
    tokenizer = Tokenizer.from_file(BYTES)
    text = "one <|endoftext|> two three"
    assert counter(BYTES).count(iter([text]), 1, 3)[0] == len(tokenizer.encode(text, add_special_tokens=False).ids)


def test_odd_rows(spark, whole):
    texts = [None, "", " ", "<s> a </s> <unk>", "é ü" * 50, "one two " * 40_000, "y" * 30_000, "same", "same"]
    rows = [(i if i else None, t, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, N_TOKENS string")
    with pytest.raises(ValueError):
        with_token_counts(docs, "text", PIECES, 3)
    out = with_token_counts(docs, "text", PIECES, 3, n_tokens="tokens").collect()
    assert [r["tokens"] for r in out] == [whole(t) for t in texts]
    assert [r["n_bytes"] for r in out] == [len((t or "").encode()) for t in texts]
    assert all(r["over_limit"] == (r["tokens"] > 3) and r["N_TOKENS"] == "x" for r in out)
    assert with_token_counts(docs.where("false"), "text", PIECES, 3, n_tokens="tokens").count() == 0


def test_query_against_whole_texts(spark, whole):
    folder = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    out = queries.op12_token_counts(spark, folder).collect()
    assert len(out) == len(docs)
    for r in out:
        n = whole(docs[r["doc_id"]])
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len((docs[r["doc_id"]] or "").encode()), n, n > 4096)
