"""From raw documents to token ids, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns the documents it keeps,
all but the last with the columns they came with. Between stages the
documents are written, so a lost executor costs at most one stage's work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbstone.llm import bpe, language
from kerbstone.llm.batches import with_text_columns
from kerbstone.llm.decontaminate import decontaminate
from kerbstone.llm.lines import dedup_lines
from kerbstone.llm.near import near_groups
from kerbstone.plans.cut import cut

#: The language model and the benchmark's SQL are beyond what SQL expresses.
ORACLE_SQL = None


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of no language, and give those without ``lang`` the predicted one.

    No language means that the text is null, empty or has no letter, which does
    not depend on whether any document has a language to learn from; then no
    ``lang`` is filled in. Ties and very long texts are as in ``identify``;
    repeated rows stay; other columns, whatever their names, pass unchanged; an
    empty table gives an empty one.
    """
    model = language.learn(docs)
    if not model.langs:
        name = new_name(docs, "_lettered")
        found = with_text_columns(
            docs, "text", lambda texts: {name: [bool(language.letters(t)) for t in texts]}, {name: T.BooleanType()})
        return found.where(F.col(name)).select(docs.columns)
    # a column of the documents that has a name of the prediction's goes through under another
    plain = {c: new_name(docs, f"_{c}") for c in docs.columns if c in ("lang_pred", "score")}
    found = language.identify(docs.withColumnsRenamed(plain), model)
    lang = F.coalesce("lang", "lang_pred") if "lang" in docs.columns else None
    return found.where(F.col("lang_pred") != language.UNKNOWN).select(*[
        lang.alias(c) if c == "lang" else F.col(f"`{plain.get(c, c)}`").alias(c) for c in docs.columns
    ])


def new_name(docs: DataFrame, name: str) -> str:
    """``name``, longer if ``docs`` has such a column."""
    while name in docs.columns:
        name += "_"
    return name


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace each text by its lines that stay; ``n_chars`` is counted anew.

    A null text becomes an empty one. Rows that repeat an id count each, rows
    without id keep lines that only such rows have; a text may end up empty and
    stays as a document; very long texts are split whole. Other columns, whatever
    their names, pass unchanged. An empty table gives an empty one.
    """
    plain = {c: new_name(docs, f"_{c}") for c in docs.columns if c in ("n_lines", "n_dropped", "kept_text")}
    kept = dedup_lines(docs.withColumnsRenamed(plain))
    text = {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("bigint")}
    return kept.select(*[
        text[c].alias(c) if c in text else F.col(f"`{plain.get(c, c)}`").alias(c) for c in docs.columns
    ])


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of near-duplicates: one with the smallest id, nulls last.

    Rows are told apart by a stored key, so repeated rows and rows without id
    are copies like others; of rows that tie, the first stored stays. Null and
    empty texts are alone in their groups; very long texts are compared whole; other
    columns pass unchanged; an empty table gives an empty one.
    """
    row = new_name(docs, "_row")
    keyed = cut(docs.withColumn(row, F.monotonically_increasing_id()))
    others = cut(near_groups(keyed, row_col=row).where(F.col("class_row") != F.col(row)).select(row))
    return keyed.join(others, row, "left_anti").select(docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of whose words one in twenty is in a benchmark window.

    A text without words is clean; very long texts are read whole, in parts;
    repeated rows and rows without id are judged each; other columns, whatever
    their names, pass unchanged; an empty table gives an empty one.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    names = ("n_words", "n_hit", "n_items", "items", "contaminated")
    plain = {c: new_name(docs, f"_{c}") for c in docs.columns if c in names}
    found = decontaminate(docs.withColumnsRenamed(plain), benchmark)
    return found.where(~F.col("contaminated")).select(*[
        F.col(f"`{plain.get(c, c)}`").alias(c) for c in docs.columns])


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, lang, source, n_tokens, ids, restored``: token ids, and whether they decode to the text.

    One pass encodes and decodes, so a task has one Python worker, not two. A null
    text is an empty one; of the named columns those that the documents have
    are returned, and no others; repeated rows are encoded each; a very long text is
    encoded whole; an empty table gives an empty one.
    """
    return bpe.encode(docs, check=True, keep=[c for c in ("doc_id", "lang", "source") if c in docs.columns])


STAGES = [
    ("language_id", known_language),
    ("line_dedup", without_repeated_lines),
    ("near_dups", one_of_each_group),
    ("decontaminate", without_benchmark),
    ("byte_bpe", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
