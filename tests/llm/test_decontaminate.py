import re

import pytest
from helpers import LOWER, documents, table, whole
from pyspark.sql import functions as F

from kerbstone.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEM = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"


def expected(rows, items, size=13):
    windows = {}
    for item, text in items:
        found = WORD.findall((text or "").translate(LOWER))
        for i in range(max(1, len(found) - size + 1) if found else 0):
            windows.setdefault(tuple(found[i:i + size]), set()).add(item)
    out = []
    for doc, text in rows:
        found, hit, ids = WORD.findall((text or "").translate(LOWER)), set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(found) - n + 1):
                if got := windows.get(tuple(found[i:i + n])):
                    hit.update(range(i, i + n))
                    ids |= {str(g) for g in got if g is not None}
        out.append((doc, len(found), len(hit), len(ids), sorted(ids), 0 < len(hit) * 20 >= len(found)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [1 << 20, 40])
def test_edge_cases(spark, block):
    texts = [ITEM, ITEM.upper().replace(" ", "--\n"), "x " * 20 + ITEM, ITEM.rpartition(" ")[0], None, "", "!?",
             "ünï cödé", "a ünï cödé b", ("pad " * 300) + "ünï cödé", ITEM + " " + ITEM, "w" * 200_000]
    items = [(1, ITEM), (1, "ünï cödé"), (10, "cödé"), (2, ITEM), (None, "pad pad"), (3, None), (4, ""), (5, "?")]
    rows = list(enumerate(texts)) + [(0, ITEM)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("items", F.lit("clash"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert whole(D.decontaminate(docs, bench, block_bytes=block, keep=["doc_id"])) == expected(rows, items)


def test_given_tables(spark):
    docs, bench = table(spark, "documents"), table(spark, "benchmark")
    want = expected([(r["doc_id"], r["text"]) for r in docs.collect()], [tuple(r) for r in bench.collect()])
    assert whole(D.decontaminate(docs, bench, keep=["doc_id"])) == want
    assert any(w[-1] for w in want)


def test_windows_across_the_parts_of_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(D, "PART_BYTES", 50)
    text = "pad " * 30 + ITEM + " pad" * 30 + "z" * 130 + " " + ITEM
    filed = D.file_windows([(["1"], ITEM)], {}, 13)
    found = D.find_windows(text, filed, 13)
    assert (found[0], len(found[1]), found[2]) == (30 + 14 + 29 + 1 + 14 + 0, 28, {("1",)})


def test_empty_tables(spark):
    docs, bench = documents(spark, ["a b"]), table(spark, "benchmark")
    assert D.decontaminate(docs.limit(0), bench).count() == 0
    row = D.decontaminate(docs, bench.limit(0)).first()
    assert (row["n_words"], row["n_hit"], row["items"], row["contaminated"]) == (2, 0, [], False)


def test_many_equal_items_are_sent_once_and_many_ids_of_one_text_in_blocks(spark, monkeypatch):
    items = [(7, ITEM)] * 500 + [(i, "ünï cödé") for i in range(200)]
    rows = [(0, ITEM), (1, "a ünï cödé b"), (2, "none")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    sizes, filed = [], D.file_windows
    monkeypatch.setattr(D, "file_windows", lambda rows, *a: sizes.append(sum(len(i) for i, _ in rows)) or filed(rows, *a))
    assert whole(D.decontaminate(docs, bench, block_bytes=600, keep=["doc_id"])) == expected(rows, items)
    assert len(sizes) > 2 and max(sizes) < 70 and sum(sizes) == 201
