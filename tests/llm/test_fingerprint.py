import random
import re

import xxhash
from helpers import LOWER, documents, sha, table, whole
from pyspark.sql import functions as F

from kerbstone.llm import fingerprint

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = (1 << 56) - 1


def xx(data, seed=42):
    return xxhash.xxh64(data, seed=seed).intdigest()


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def shingles(text):
    words = [w.encode() for w in WORD.findall((text or "").translate(LOWER))]
    if not words:
        return {xx((text or "").encode())}
    out = set()
    for i in range(max(1, len(words) - 4)):
        h = 42
        for w in words[i:i + 5]:
            h = xx(w, h)
        out.add(h)
    return out


def brute(text):
    """The 256 digits of a text's fingerprint."""
    bins = {}
    for h in map(signed, shingles(text)):
        bins[(h >> 56) + 128] = min(bins.get((h >> 56) + 128, h), h)
    digits = []
    for i in range(256):
        start, stride = fingerprint.probe_order(i)
        at = i
        if i not in bins:
            at = next(j for a in range(256) if (j := (start + a * stride) % 256) in bins)
        value = bins[at]
        h = xx(value.to_bytes(8, "little", signed=True))
        digits.append(xx(i.to_bytes(4, "little"), h) & 15)
    return "".join("0123456789abcdef"[d] for d in digits)


def near(a, b):
    same = sum(x == y for x, y in zip(a, b)) / 256
    return max(0.0, (same - 1 / 16) / (15 / 16))


def expected(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, signed(xx((r[1] or "").encode()))))
    out = []
    for i, (key, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        taken = len(text) // 4
        edited = text[:len(text) - taken] + after[:taken]
        a, b, c = brute(text), brute(edited), brute(after)
        out.append((key, len(text), sha(edited), a, b, round(near(a, b), 9), round(near(a, c), 9)))
    return sorted(out, key=repr)


def answer(frame):
    found = fingerprint.fingerprints(frame)
    return sorted(((r[0], r[1], sha(r[2]), r[3], r[4], round(r[5], 9), round(r[6], 9)) for r in found.select(
        "doc_id", "n_chars", "edited", fingerprint.shown(F.col("fingerprint")),
        fingerprint.shown(F.col("edited_fingerprint")),
        fingerprint.likeness(F.col("fingerprint"), F.col("edited_fingerprint")),
        fingerprint.likeness(F.col("fingerprint"), F.col("next_fingerprint"))).collect()), key=repr)


def drawn(seed, n, most=300):
    rng = random.Random(seed)
    return [" ".join(rng.choice(["Wort", "b", "c", "ünd", "E"]) + str(rng.randint(0, 30))
                     for _ in range(rng.randint(0, most))) for _ in range(n)]


def test_fingerprints_equal_brute_force(spark):
    texts = [*drawn(1, 40), None, "", "?!", "??", "one", "one two three four", "one two three four five", "é😀" * 50,
             " ".join(f"w{i}" for i in range(30_000)), "twin text here", "Twin text HERE", "twin text here"]
    docs = documents(spark, texts).withColumnsRenamed({"lang": "_stretch", "source": "_fp"})
    assert answer(docs) == expected(list(enumerate(texts)))


def test_order_with_null_repeated_and_hot_ids(spark):
    rows = [(7, t) for t in drawn(2, 60, 20)] + [(None, "a b"), (None, None), (-3, "x y z"), (9, "last"), (9, "last")]
    rows += [(i, f"text {i} of many") for i in range(100, 160)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert answer(frame) == expected(rows)


def test_one_document_follows_itself_and_no_document_gives_no_rows(spark):
    frame = spark.createDataFrame([(1, "abcdefgh")], "doc_id long, text string")
    assert answer(frame) == expected([(1, "abcdefgh")])
    assert fingerprint.fingerprints(documents(spark, [])).count() == 0


def test_every_order_meets_all_bins():
    for i in range(256):
        start, stride = fingerprint.probe_order(i)
        assert {(start + a * stride) % 256 for a in range(256)} == set(range(256))
    assert len({fingerprint.probe_order(i) for i in range(256)}) > 240


def test_likeness_is_near_the_share_of_common_shingles():
    rng = random.Random(5)
    for n in (20, 100, 600):
        for kept in (0.3, 0.6, 0.9):
            errors = []
            for _ in range(12):
                a = [f"w{rng.getrandbits(40)}" for _ in range(n)]
                b = a[:int(n * kept)] + [f"w{rng.getrandbits(40)}" for _ in range(n - int(n * kept))]
                x, y = shingles(" ".join(a)), shingles(" ".join(b))
                errors.append(near(brute(" ".join(a)), brute(" ".join(b))) - len(x & y) / len(x | y))
            assert abs(sum(errors) / len(errors)) < 0.08


def test_query_over_the_given_table(spark, small):
    from kerbstone.llm.queries import op13_fingerprints

    rows = [tuple(r) for r in table(spark, "documents").select("doc_id", "text").collect()]
    got = op13_fingerprints(spark, small)
    assert got.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    assert [r[:5] for r in whole(got)] == [r[:5] for r in expected(rows)]
    assert all(0 <= r[5] <= 1 and 0 <= r[6] <= 1 for r in whole(got))
