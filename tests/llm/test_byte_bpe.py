"""Byte-level BPE against the library on whole texts."""

import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from __spark_entry__ import queries
from textrisk.llm import byte_bpe

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def whole():
    with open(byte_bpe.RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "whole", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


PARTS = [
    "the", "'s", "'", "'re", "''ll", "12", "Éa", "ß", "漢字", "😀", " ", "  ", "\n", "\t ", "\x85", "　",
    " ", "\x1c", "​", "\xa0", "!", "<|endoftext|>", "\x00", "á", "n't",
]


@pytest.mark.parametrize("seed", range(6))
def test_pieces_encode_like_whole_texts(whole, seed):
    rng = random.Random(seed)
    encodings = byte_bpe.load_ranks(byte_bpe.RANKS, public_tokenizers.PATTERN)
    for _ in range(300):
        text = "".join(rng.choices(PARTS, k=rng.randint(0, 60)))
        for size, run in ((1, 2), (3, 3), (7, 2), (20, 5), (1000, 2)):
            cut = list(byte_bpe.pieces(text, size, run))
            assert "".join(piece for piece, _ in cut) == text
            assert byte_bpe.encode(text, encodings, size, run) == whole.encode_ordinary(text)


def test_runs_beyond_the_library(whole):
    encodings = byte_bpe.load_ranks(byte_bpe.RANKS, public_tokenizers.PATTERN)
    for text in ("a" + " " * 1_200_000, "a" + "\n" * 1_200_000 + " b", "ab " * 200_000 + "z" * 400_000):
        ids = byte_bpe.encode(text, encodings)
        assert whole.decode_bytes(ids) == text.encode()
    short = "x" + " " * 300_000 + "y" + "\t" * 200_000
    assert byte_bpe.encode(short, encodings) == whole.encode_ordinary(short)


def test_rows(spark, whole):
    texts = ["", None, "Hello  world's", "Hello  world's", "é" * 70_000 + " x" * 200_000, "<|endoftext|> [INST]"]
    rows = [(i, text, i, "kept") for i, text in enumerate(texts)] + [(None, "a b", 1, None)]
    documents = spark.createDataFrame(rows, "doc_id bigint, text string, token_ids int, decoded string")
    found = byte_bpe.decode_tokens(byte_bpe.encode_texts(documents.repartition(3)))
    assert found.columns == ["doc_id", "token_ids", "decoded"]
    result = {row.doc_id: row for row in found.collect()}
    assert len(result) == len(rows)
    for doc_id, text, *_ in rows:
        assert list(result[doc_id].token_ids) == whole.encode_ordinary(text or "")
        assert bytes(result[doc_id].decoded) == (text or "").encode()
    assert byte_bpe.decode_tokens(byte_bpe.encode_texts(documents.where("false"))).count() == 0


def test_query_equals_library(spark, whole):
    found = {row.doc_id: row for row in queries()["op11_byte_bpe"](spark, FOLDER).collect()}
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    assert len(found) == len(documents)
    for row in documents:
        ids, one = whole.encode_ordinary(row.text or ""), found[row.doc_id]
        assert one.n_tokens == len(ids)
        assert one.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert one.decoded_sha256 == hashlib.sha256((row.text or "").encode()).hexdigest()
