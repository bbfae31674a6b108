import random

import numpy as np
from helpers import LOWER, documents, table, whole
from pyspark.sql import functions as F

from kerbstone.llm import near
from kerbstone.llm.decontaminate import words


def expected(rows, size=5, threshold=80):
    sets = []
    for _, text in rows:
        found = [w.decode() for w in words((text or "").translate(LOWER))]
        grams = {tuple(found[i:i + size]) for i in range(max(1, len(found) - size + 1))}
        sets.append(grams if found else {("", text or "")})
    label, links = list(range(len(rows))), [0] * len(rows)

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= threshold * (len(sets[i]) + len(sets[j]) - both):
                links[i] += 1
                links[j] += 1
                label[top(i)] = top(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[top(i)] = min(doc, least.get(top(i), doc))
    return sorted(((doc, least.get(top(i)), n) for i, ((doc, _), n) in enumerate(zip(rows, links))), key=repr)


def family(rng, count, length=120, changes=6):
    start = [f"w{rng.randrange(10_000)}" for _ in range(length)]
    out = []
    for _ in range(count):
        text = list(start)
        for _ in range(rng.randint(0, changes)):
            text[rng.randrange(length)] = f"x{rng.randrange(10_000)}"
        out.append(" ".join(text))
    return out


def test_families_in_small_blocks_and_cells(spark):
    rng = random.Random(11)
    texts = family(rng, 60) + family(rng, 25, changes=3) + family(rng, 5, length=7, changes=1)
    texts += ["a b c", "A, b; c!", "a b", "!!!", "!!!", "???", None, "", "word " * 40_000, "word " * 39_000]
    rng.shuffle(texts)
    rows = list(enumerate(texts)) + [(3, texts[3]), (None, texts[5]), (4, "two rows have this id"), (None, "alone")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("class_id", F.lit("clash"))
    want = expected(rows)
    assert whole(near.near_groups(frame)) == want
    assert whole(near.near_groups(frame, block=8, cell=4)) == want


def test_null_and_repeated_ids(spark):
    rng = random.Random(12)
    same, none = family(rng, 12, changes=3), family(rng, 30, changes=3)
    rows = [(None, text) for text in none + family(rng, 1)] + [(7, text) for text in same + family(rng, 3)]
    rows += [(7, same[0]), (None, none[0]), (9, none[1] + " more")]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    want = expected(rows)
    assert sum(n > 0 for _, _, n in want) > 30
    assert whole(near.near_groups(frame)) == want
    assert whole(near.near_groups(frame, block=8, cell=4)) == want


def test_given_table(spark):
    docs = table(spark, "documents")
    want = expected([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert whole(near.near_groups(docs)) == want
    assert any(n for _, _, n in want)


def test_prefixes_are_shortened_to_the_target():
    depths = [near.matched_depth(0.8, 24, 6, recall) for recall in (0.5, 0.99, 0.9999, 0.9999999)]
    assert depths == sorted(depths, reverse=True) and depths[0] == 6
    assert 1 - (1 - 0.8 ** near.matched_depth(0.8, near.TREES, near.DEPTH, near.RECALL)) ** near.TREES >= near.RECALL


def test_overlaps_equal_set_sizes():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, n).astype(np.uint64)) for n in (0, 1, 20, 40, 60)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    assert near.overlaps(sets).tolist() == want


def test_empty_table(spark):
    assert near.near_groups(documents(spark, []).limit(0)).count() == 0
