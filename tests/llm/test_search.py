import math
import random
import re
from collections import Counter

import numpy as np
from helpers import LOWER, documents, table, whole
from pyspark.sql import functions as F

from kerbstone.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, top=20):
    """Every document scored for every item."""
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    n_docs, n_terms = len(counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in items:
        asked, scored = Counter(terms(text)), []
        for doc, c, n in counts:
            m = 100 - 25 + (25 * n * n_docs) // n_terms
            score = sum(
                times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m))
                for t, times in asked.items() if t in c)
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=repr)


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def drawn(seed, n, words=40):
    rng = random.Random(seed)
    pool = [f"w{int(rng.paretovariate(0.7)) % words}" for _ in range(400)] + ["É", "Straße", "x1"]
    return [" ".join(rng.choice(pool) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_hits_equal_brute_force(spark):
    texts = [*drawn(1, 150), None, "", "?!", "W1 w1,W1", *["same copy w1 w2"] * 30]
    asked = list(enumerate([*drawn(2, 12, 60), "w1", "same copy", None, "?!", "unheard of", "w1 w1 W1 w2"]))
    asked += [(99, "w1"), (None, "w3 w4"), (7, "w5")]
    docs = documents(spark, texts).withColumnsRenamed({"lang": "rank", "source": "score"})
    want = brute(list(enumerate(texts)), asked)
    assert whole(search.search(docs, items(spark, asked).withColumn("key", F.lit("clash")))) == want
    assert len(want) > 100
    # more than one chunk of items, and other sizes
    assert whole(search.search(docs, items(spark, asked), chunk_bytes=100)) == want
    assert whole(search.search(docs, items(spark, asked), top=3)) == brute(list(enumerate(texts)), asked, 3)


def test_null_and_repeated_ids(spark):
    rows = [(i, t) for i, t in zip([None, None, 1, 1, 2, 3], ["a b", "a", "a", "a", "a c c", None])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = search.search(docs, items(spark, [(1, "a b c")]))
    assert whole(got) == brute(rows, [(1, "a b c")])


def test_masks_group_documents_and_bounds_stop_early():
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 80, 3000)
    terms_of = [np.sort(rng.permutation(90)[:n]) for n in sizes]
    flat = np.concatenate(terms_of)
    tfs = rng.integers(1, 5, len(flat))
    block = search.Block(np.arange(3000), sizes.astype(np.int64), sizes, flat, tfs, 3000, int(sizes.sum()))
    query = search.Query("q", np.arange(0, 90, 1), rng.integers(1, 9, 90))
    bits, starts, docs = search.masks(block.postings(query), 3000)
    assert sorted(docs) == list(range(3000))
    for mask, start, end in zip(bits, starts, [*starts[1:], 3000]):
        for doc in docs[start:end]:
            assert np.flatnonzero(mask).tolist() == terms_of[doc].tolist()
    assert len({m.tobytes() for m in bits}) == len(bits)
    rare = search.Query("q", np.array([3, 40, 77]), np.array([900, 30, 1]))
    kept = search.Kept(5)
    scored = search.evaluate(block, np.zeros(3000, bool), rare, kept)
    assert 0 < scored < 3000
    full = search.Kept(5)
    every = np.zeros(3000, np.int64)
    for worth, holders, parts, _ in block.postings(rare):
        every[holders] += worth * parts
    full.add(every, block.ids, np.zeros(3000, bool))
    assert kept.ids.tolist() == full.ids.tolist() and kept.scores.tolist() == full.scores.tolist()


def test_norms_are_exact_beyond_64_bits():
    n = np.array([10**9, 5], np.int64)
    assert search.length_norms(n, 5 * 10**10, 10**13).tolist() == [75 + 25 * 10**9 * 5 * 10**10 // 10**13, 75]


def test_query_over_the_given_table(spark, small):
    from kerbstone.llm.queries import op12_ranked_search

    docs = [tuple(r) for r in table(spark, "documents").select("doc_id", "text").collect()]
    asked = [tuple(r) for r in table(spark, "benchmark").select("item_id", "text").collect()]
    assert whole(op12_ranked_search(spark, small)) == brute(docs, asked)


def test_empty_tables(spark):
    some, none = documents(spark, ["a b"]), documents(spark, [])
    assert search.search(none, items(spark, [(1, "a")])).count() == 0
    assert search.search(some, items(spark, [])).count() == 0
    assert search.search(some, items(spark, [(1, "a")])).columns == ["item_id", "rank", "doc_id", "score"]
