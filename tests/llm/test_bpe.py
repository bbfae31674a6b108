import base64
import random

import public_tokenizers
import pytest
import tiktoken
from helpers import documents, table
from pyspark.sql import functions as F

from kerbstone.llm import bpe


@pytest.fixture(scope="module")
def reference():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_random_texts_as_the_other_library(reference):
    codec, rng = bpe.codec(public_tokenizers.path(bpe.VOCABULARY)), random.Random(7)
    some = [chr(c) for c in range(0x300)] + [chr(rng.randrange(0x300, 0xD7FF)) for _ in range(400)]
    some += list(" \t\n\x85 ​﻿　\x1c_") * 8 + ["日本", "👨‍👩‍👧", "'s", "'LL", "٣", "½", "²", "ⅷ", "一", "<|endoftext|>"]
    for _ in range(4000):
        text = "".join(rng.choice(some) for _ in range(rng.randint(0, 40)))
        assert codec.encode(text).tolist() == reference.encode_ordinary(text)
    for text in ("a" * 5000, " " * 3000, "-=" * 3000, "1" * 1001, "aaaa bbbb" * 500):
        assert codec.encode(text).tolist() == reference.encode_ordinary(text)


def test_a_long_text_in_parts(reference, monkeypatch):
    monkeypatch.setattr(bpe, "PART_CHARS", 50)
    codec, rng = bpe.Codec(public_tokenizers.path(bpe.VOCABULARY), remembered=20), random.Random(3)
    text = "".join(rng.choice(["word", "  ", " ", "\n\n ", "é!", "12", "'s"]) for _ in range(2000))
    assert codec.encode(text).tolist() == reference.encode_ordinary(text)


def test_given_table_and_round_trip(spark, reference):
    docs = table(spark, "documents")
    out = bpe.decode(bpe.encode(docs)).collect()
    assert len(out) == docs.count()
    for row in out:
        assert row["ids"] == reference.encode_ordinary(row["text"] or "")
        assert row["decoded_text"] == (row["text"] or "") and row["n_tokens"] == len(row["ids"])


def test_offsets_and_split_characters(spark):
    docs = documents(spark, ["a 😀é!", None, ""]).withColumn("ids", F.lit("clash"))
    rows = bpe.encode(docs, offsets=True).orderBy("doc_id").collect()
    first = rows[0]
    assert first["starts"][0] == 0 and first["ends"][-1] == 5
    assert all(a < b for a, b in zip(first["starts"], first["ends"]))
    # the emoji has several tokens, each of which covers all of it
    assert sum(a <= 2 < b for a, b in zip(first["starts"], first["ends"])) > 1
    assert [(r["n_tokens"], r["ids"]) for r in rows[1:]] == [(0, []), (0, [])]
    halves = spark.createDataFrame([(0, first["ids"][:2]), (1, None)], "doc_id int, ids array<int>")
    got = bpe.decode(halves).orderBy("doc_id").collect()
    assert "a 😀".encode().startswith(bytes(got[0]["decoded"])) and "�" in got[0]["decoded_text"]
    assert bytes(got[1]["decoded"]) == b""


def test_empty_table(spark):
    assert bpe.decode(bpe.encode(documents(spark, []).limit(0))).count() == 0
