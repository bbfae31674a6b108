import pytest
from helpers import LOWER, documents, sha, table, whole
from pyspark.sql import functions as F

from kerbstone.llm.exact import ascii_lower, chunks, exact_groups

TEXTS = [
    "Alpha beta. " * 400, "alpha BETA. " * 400, None, "", "É", "é", "x" * 20_000, "x" * 19_999 + "y",
    "a\nb", "a\r\nb", "Alpha beta. " * 400 + "!", "😀 A", "😀 a",
]


def expected(rows):
    groups = {}
    for doc, text in rows:
        groups.setdefault((text or "").translate(LOWER), []).append(doc)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep, sha(text)) for i in ids]
    return sorted(out, key=repr)


@pytest.mark.parametrize("bits", [64, 1])
def test_groups_equal_brute_force(spark, bits):
    rows = list(enumerate(TEXTS)) + [(3, ""), (None, "é"), (None, "only without id")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("keep_id", F.lit("clash"))
    assert whole(exact_groups(frame, id_bits=bits, least=16, most=64)) == expected(rows)


def test_given_table(spark):
    docs = table(spark, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert whole(exact_groups(docs)) == expected(rows)


def test_chunks_join_to_the_text_and_are_bounded(spark):
    frame = documents(spark, [t for t in TEXTS if t])
    for row in frame.select("text", chunks(F.col("text"), 16, 64).alias("c")).collect():
        assert "".join(row["c"]) == row["text"]
        assert all(len(c) <= 64 for c in row["c"]) and all(len(c) >= 16 for c in row["c"][:-1])


def test_an_insertion_changes_few_chunks(spark):
    text = "".join(f"Sentence number {i} of many others. " for i in range(400))
    row = documents(spark, [text, "New start. " + text]).select(chunks(F.col("text"), 64, 512).alias("c")).collect()
    assert len(set(row[1]["c"]) - set(row[0]["c"])) <= 3


def test_only_ascii_is_lowered(spark):
    frame = documents(spark, ["ÀB İ ẞ", "ABC"]).select(ascii_lower(F.col("text")).alias("t"))
    assert [r["t"] for r in frame.collect()] == ["Àb İ ẞ", "abc"]


def test_empty_table(spark):
    assert exact_groups(documents(spark, []).limit(0)).count() == 0
