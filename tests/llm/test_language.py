import numpy as np
from helpers import documents, table
from pyspark.sql import functions as F

from kerbstone.llm import language

TRAIN = {
    "en": "the house and the garden were quiet in the evening light",
    "de": "das haus und der garten lagen still im licht des abends",
    "fr": "la maison et le jardin étaient calmes dans la lumière du soir",
}


def test_held_out_accuracy(spark):
    docs = table(spark, "documents")
    out = language.identify(docs, language.learn(docs)).withColumn("held_out", language.held_out("doc_id"))
    rows = out.where("held_out and lang is not null").collect()
    assert len(rows) > 20
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_nothing_is_learned_from_held_out_rows(spark):
    docs = table(spark, "documents")
    changed = docs.withColumn("lang", F.when(language.held_out("doc_id"), F.lit("xx")).otherwise(F.col("lang")))
    assert language.learn(changed).langs == language.learn(docs.where(~language.held_out("doc_id"))).langs


def test_the_kernel_counts_shared_ngrams():
    a, b = language.presence("abc abd"), language.presence("abc xyz")
    model = language.Model(["x"], np.flatnonzero(b), np.zeros((0, 0)), np.zeros((0, 0)))
    model.landmarks = model.rows([b])
    value, first = 0.0, 0
    for bits in language.ORDER_BITS:
        x, y = (t[first:first + (1 << bits)] for t in (a, b))
        value += (x & y).sum() / np.sqrt(x.sum() * y.sum()) / len(language.ORDER_BITS)
        first += 1 << bits
    assert abs(model.kernel([a])[0, 0] - value) < 1e-6
    assert abs(model.kernel([b])[0, 0] - 1) < 1e-6


def test_landmarks_are_bounded_and_the_texts_still_found():
    model = language.fit(list(TRAIN.values()) * 3, list(TRAIN) * 3, most=4)
    assert len(model.landmarks) == 3
    assert model.predict(list(TRAIN.values()))[0] == list(TRAIN)
    assert len(language.fit(list(TRAIN.values()) * 3, list(TRAIN) * 3).landmarks) == 9


def alphabets(n):
    """Texts of ``n`` made-up languages, each of words of its own."""
    rng = np.random.default_rng(4)
    words = [["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(12)] for _ in range(n)]
    return lambda lang, size=30: " ".join(rng.choice(words[lang], size))


def test_every_language_is_learned_those_of_long_texts_too(spark):
    text = alphabets(150)
    rows = [(i, text(i % 150, 9000 if i % 150 == 7 else 30), f"l{i % 150:03d}", "s", 1) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert min(len(r[1]) for r in rows if r[2] == "l007") > 50_000
    model = language.learn(docs)
    assert len(model.langs) == 150
    fewer = language.learn(docs, most=10)
    assert len(fewer.langs) == 150
    got = language.identify(docs, model).where(language.held_out("doc_id")).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.98 * len(got) > 300


def test_prediction_equals_brute_force_over_sets_of_hashed_ngrams(spark):
    """The same regression with kernels by pairs of sets, and no approximation of them."""
    texts = [t + " " + w for t in TRAIN.values() for w in ("one", "zwei", "trois", "")]
    langs = [lang for lang in TRAIN for _ in range(4)]
    model = language.fit(texts, langs, per_lang=99)

    def sets(t):
        found, first, out = language.presence(t), 0, []
        for bits in language.ORDER_BITS:
            out.append(set(np.flatnonzero(found[first:first + (1 << bits)]).tolist()))
            first += 1 << bits
        return out

    def kernel(a, b):
        return sum(len(x & y) / (len(x) * len(y)) ** 0.5 for x, y in zip(sets(a), sets(b))) / 3

    marks = [t for lang in sorted(TRAIN) for t, at in zip(texts, langs) if at == lang]
    k = np.array([[kernel(a, b) for b in marks] for a in texts])
    among = np.array([[kernel(a, b) for b in marks] for a in marks])
    names = sorted(TRAIN)
    y = np.array([[1.0 if at == n else -1.0 for n in names] for at in langs])
    weights = np.linalg.solve(k.T @ k + language.RIDGE * among + 1e-6 * np.eye(len(marks)), k.T @ y)
    new = ["the quiet house", "das stille licht", "la lumière calme", "garden jardin garten"]
    docs = documents(spark, new)
    for r in language.identify(docs, model).collect():
        values = np.array([kernel(r["text"], m) for m in marks]) @ weights
        assert r["lang_pred"] == names[int(values.argmax())]
        assert abs(r["score"] - min(1, max(0, (values.max() + 1) / 2))) < 1e-3


def test_repeated_rows_and_equal_languages(spark):
    rows = [(i, TRAIN["en"], lang, "s", 1) for i in range(40) for lang in ("a", "b")] + [(99, TRAIN["de"], "c", "s", 1)] * 9
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    model = language.learn(docs)
    assert model.langs == ["a", "b", "c"]
    got = language.identify(docs, model).collect()
    assert len(got) == len(rows)
    assert {r["lang_pred"] for r in got if r["text"] == TRAIN["de"]} == {"c"}
    assert len({r["lang_pred"] for r in got if r["text"] == TRAIN["en"]}) == 1


def test_numbers_that_are_no_letters():
    assert [language.letters(t) for t in ("½", "²", "Ⅷ", "٣", "_", "ª", "é½", "漢5字")] == ["", "", "", "", "", "ª", "é", "漢 字"]


def test_edge_cases(spark):
    model = language.fit(list(TRAIN.values()) * 3, list(TRAIN) * 3)
    texts = [None, "", "12 !? 3", "der garten und das haus", "THE GARDEN AND THE HOUSE", "le jardin " * 60_000]
    docs = documents(spark, texts).withColumnRenamed("source", "score")
    got = {r["doc_id"]: r["lang_pred"] for r in language.identify(docs, model).collect()}
    assert [got[i] for i in range(6)] == ["und", "und", "und", "de", "en", "fr"]
    assert language.identify(docs.limit(0), model).count() == 0


def test_without_labels_all_is_unknown(spark):
    docs = documents(spark, ["some text"]).withColumn("lang", F.lit(None).cast("string"))
    row = language.identify(docs, language.learn(docs)).first()
    assert (row["lang_pred"], row["score"]) == ("und", 0.0)
    assert language.learn(docs.limit(0)).langs == []
