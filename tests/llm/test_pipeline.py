import tiktoken  # noqa: F401  the reference of the last stage is tested in test_bpe
from helpers import documents, sha, table
from pyspark.sql import functions as F
from test_decontaminate import expected as hits
from test_lines import expected as lines
from test_near import expected as groups

import corpus_pipeline
from kerbstone.llm import bpe
from kerbstone.llm.language import NO_LETTERS


def test_run_equals_brute_force(spark, small):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, "documents").collect()]
    rows = [(d, t) for d, t in rows if t and NO_LETTERS.sub("", t)]
    rows = [(d, t) for d, _, _, t in lines(rows)]
    kept = {d for d, c, _ in groups(rows) if d == c}
    rows = [(d, t) for d, t in rows if d in kept]
    clean = {h[0] for h in hits(rows, [tuple(r) for r in table(spark, "benchmark").collect()]) if not h[-1]}
    want = {d: t for d, t in rows if d in clean}
    got = corpus_pipeline.run(spark, small).collect()
    assert {r["doc_id"] for r in got} == want.keys() and len(got) == len(want)
    import public_tokenizers
    codec = bpe.codec(public_tokenizers.path(bpe.VOCABULARY))
    for r in got:
        assert r["restored"] and r["ids"] == codec.encode(want[r["doc_id"]]).tolist()
    assert 0 < len(got) < table(spark, "documents").count()
    assert sha("x")


def test_stages_keep_columns_and_empty_tables(spark, small):
    docs = documents(spark, ["the only text here", None]).withColumn("n_lines", F.lit(1)).withColumn("items", F.lit("x"))
    for frame in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, frame, small)
            assert out.columns == docs.columns, name
            assert out.count() <= frame.count()
        assert corpus_pipeline.STAGES[-1][1](spark, frame, small).count() == frame.count()


def test_one_row_of_each_group_stays(spark):
    import random

    from test_near import family

    rng = random.Random(13)
    near, none = family(rng, 6, changes=1), family(rng, 6, changes=1)
    rows = [(i + 3, t) for i, t in enumerate(near)] + [(3, near[0]), (3, near[0]), (None, near[1])]
    rows += [(None, t) for t in none + none[:2]] + [(3, "another text"), (None, "alone and without id"), (None, None)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_row", F.lit("clash"))
    kept = corpus_pipeline.one_of_each_group(spark, docs, "").collect()
    assert all(r["_row"] == "clash" for r in kept)
    kept = [(r["doc_id"], r["text"]) for r in kept]
    assert [d for d, t in kept if t in near] == [3]
    assert [d for d, t in kept if t in none] == [None]
    assert (3, "another text") in kept and (None, "alone and without id") in kept and (None, None) in kept
    assert len(kept) == 5


def test_clashing_columns_pass_and_missing_languages_are_filled(spark, small):
    docs = documents(spark, ["the old house by the sea", "das alte haus am meer", None, "the sea and the house"] * 4)
    lang = F.when(F.col("doc_id") % 4 == 1, "de").when(F.col("doc_id") < 12, "en")
    docs = docs.withColumns({"lang": lang, "lang_pred": F.lit("a"), "score": F.lit("b"), "n_hit": F.lit("c"), "items": F.lit("d")})
    docs = docs.withColumns({"n_lines": F.lit("e"), "kept_text": F.lit("f"), "_lettered": F.lit("g")})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, small)
        assert out.columns == docs.columns, name
        for r in out.collect():
            assert [r[c] for c in docs.columns[-7:]] == list("abcdefg"), name
    got = {r["doc_id"]: r["lang"] for r in corpus_pipeline.known_language(spark, docs, small).collect()}
    assert got.keys() == {i for i in range(16) if i % 4 != 2}
    assert got[13] == "de" and got[12] == got[15] == "en"
    bare = corpus_pipeline.encoded(spark, docs.drop("lang", "source"), small)
    assert bare.columns[0] == "doc_id" and bare.count() == 16


def test_texts_without_letters_go_without_labels_too(spark):
    docs = documents(spark, ["some words", None, "", "123 --- 45", "\u00e9"]).withColumn("lang", F.lit(None).cast("string"))
    kept = corpus_pipeline.known_language(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(r["text"] for r in kept.collect()) == ["some words", "\u00e9"]
