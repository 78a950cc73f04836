"""Byte-level coding against the library, the definition, and the exact way back."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tokenloom.llm.byte_bpe import (
    NONE,
    ByteCodec,
    coding_digests,
    decode_ids,
    encode_texts,
    merged,
    read_ranks,
)

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "own", pat_str=PATTERN, mergeable_ranks=read_ranks(PATH), special_tokens={}
    )


@pytest.fixture(scope="module")
def codec():
    return ByteCodec(read_ranks(PATH), PATTERN)


def ids(data: bytes) -> list[int]:
    return np.frombuffer(data, np.int32).tolist()


def test_random_texts_as_the_library(codec, library):
    rng = random.Random(0)
    letters = "abcdefgh etaoin  \n\n\t\x1c  \x85​'sé中文😀١0123!?<|endoftext|>кириллица"
    for i in range(4000):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(60)))
        if i % 3 == 0:
            text = text.replace(" ", "")
        assert ids(codec.encode(text)) == library.encode_ordinary(text), text


def test_long_runs(codec, library):
    rng = random.Random(1)
    for text in ("a" * 5000, "ab" * 3000, "".join(rng.choice("abcdefgh") for _ in range(20_000))):
        assert ids(codec.encode(text)) == library.encode_ordinary(text)
    text = "".join(rng.choice("ab  c\n") for _ in range(1_100_000))
    assert ids(codec.encode(text)) == library.encode_ordinary(text)


def test_small_vocabularies_by_the_definition():
    """Random rank lists, tokens that no merge reaches included."""
    rng = random.Random(2)
    for _ in range(200):
        tokens = [bytes([b]) for b in range(256)]
        for _ in range(rng.randrange(25)):
            made = bytes(rng.choice(b"abc") for _ in range(rng.randrange(2, 6)))
            if made not in tokens:
                tokens.append(made)
        ranks = {token: i for i, token in enumerate(tokens)}
        codec = ByteCodec(ranks, r"(?s).+")
        for _ in range(30):
            text = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 14)))
            whole = ranks.get(text.encode())
            wanted = merged(text.encode(), ranks) if whole is None else [whole]
            assert codec.encode_piece(text) == wanted


def test_together_is_the_definition(codec):
    ranks = codec.ranks
    a, b = ranks[b"th"], ranks[b"e"]
    assert codec.together(NONE, a) and not codec.together(a, b)


def test_missing_byte_fails():
    with pytest.raises(ValueError, match="without a token"):
        ByteCodec({b"a": 0}, PATTERN)


def test_odd_rows(spark, odd_docs, clashing_docs, no_docs, library):
    for docs in (odd_docs, clashing_docs):
        rows = coding_digests(docs, PATH, PATTERN).collect()
        wanted = []
        for row in odd_docs.collect():
            found = library.encode_ordinary(row.text or "")
            wanted.append(
                (
                    row.doc_id,
                    len(found),
                    hashlib.sha256(",".join(map(str, found)).encode()).hexdigest(),
                    hashlib.sha256((row.text or "").encode()).hexdigest(),
                )
            )
        assert sorted(map(str, map(tuple, rows))) == sorted(map(str, wanted))
    assert coding_digests(no_docs, PATH, PATTERN).count() == 0


def test_query_as_the_library_and_back(spark, documents, library):
    coded = decode_ids(encode_texts(documents, PATH, PATTERN), PATH, PATTERN)
    texts = {row.doc_id: row.text or "" for row in documents.collect()}
    rows = coded.collect()
    assert len(rows) == len(texts)
    for row in rows:
        assert row.ids == library.encode_ordinary(texts[row.doc_id])
        assert bytes(row.decoded) == texts[row.doc_id].encode()


def test_decoded_name_must_be_free(spark):
    with pytest.raises(ValueError, match="decoded"):
        decode_ids(spark.createDataFrame([([1], 2)], "ids array<int>, decoded int"), PATH, PATTERN)
