"""The registered queries of the training-data operators.

Each applies its operator to the whole of its table and derives the digest
columns from what the operator returns.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbstone.llm import bpe, chat, fingerprint, html, language, pii, structure, warc
from kerbstone.llm.decontaminate import decontaminate
from kerbstone.llm.exact import exact_groups
from kerbstone.llm.lines import dedup_lines
from kerbstone.llm.near import near_groups
from kerbstone.llm.search import search
from kerbstone.plans.cut import scratch_root


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    table = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    read = chat.read_turns(chat.format_chats(table.union(more)))
    of_window = read.select(
        "conv_id",
        F.struct(
            "segment",
            "window",
            F.size("turns").alias("n"),
            F.array_join(
                F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
            ).alias("turns"),
            F.array_join("learnt", "").alias("learnt"),
            F.char_length("text").alias("chars"),
        ).alias("w"),
    )
    joined = of_window.groupBy("conv_id").agg(F.array_sort(F.collect_list("w")).alias("ws")).withColumns({
        "turns": F.array_join("ws.turns", ""), "learnt": F.array_join("ws.learnt", ""),
    })

    def total(name: str):
        return F.aggregate(F.col(f"ws.{name}"), F.lit(0).cast("bigint"), lambda s, x: s + x)

    return joined.select(
        "conv_id",
        total("n").alias("n_turns"),
        F.sha2("turns", 256).alias("turns_sha256"),
        F.char_length("learnt").cast("bigint").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        total("chars").alias("formatted_chars"),
    )


def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = dedup_lines(_table(spark, folder, "documents"), keep=["doc_id"])
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    found = language.identify(docs, language.learn(docs), keep=["doc_id"])
    return found.select("doc_id", language.held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op4_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find_personal_data(_table(spark, folder, "documents"), keep=["doc_id"])

    def of(*kinds: str):
        return F.filter("pii", lambda s: s["kind"].isin(*kinds))

    def shown(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", *[
            s[c].cast("string") for c in ("kind", "start", "end")])), ",")

    return found.select(
        "doc_id",
        *[F.size(of(kind)).cast("bigint").alias(f"n_{kind}") for kind in pii.BASE],
        F.sha2(shown(of(*pii.BASE)), 256).alias("base_sha256"),
        shown(F.col("pii")).alias("spans"),
    )


def op5_near_dups(spark: SparkSession, folder: str) -> DataFrame:
    return near_groups(_table(spark, folder, "documents"))


def op6_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate(
        _table(spark, folder, "documents"), _table(spark, folder, "benchmark"), keep=["doc_id"]
    )
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op7_html_text(spark: SparkSession, folder: str) -> DataFrame:
    found = html.extract(_table(spark, folder, "pages"), keep=["page_id", "url"])
    return found.select(
        "page_id", "url", F.col("main_text").alias("text"),
        F.char_length("main_text").cast("bigint").alias("n_chars"),
        F.col("main_slots").alias("n_slots"),
    )


def op8_warc(spark: SparkSession, folder: str) -> DataFrame:
    archives = f"{scratch_root(spark)}/warc-{uuid.uuid4().hex}"
    warc.write_archives(_table(spark, folder, "pages"), archives)
    fields = ["type", "http_headers", "payload_bytes", "payload_digest"]
    return warc.page_columns(warc.assemble(warc.read_archives(spark, archives), fields))


def op9_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    encoded = bpe.encode(_table(spark, folder, "documents"), keep=["doc_id"])
    decoded = bpe.decode(encoded, text=False)
    return decoded.select(
        "doc_id", "n_tokens",
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_groups(_table(spark, folder, "documents"))


def op11_structure_repair(spark: SparkSession, folder: str) -> DataFrame:
    source = _table(spark, folder, "conversations")
    found = structure.repair(structure.damage(source))
    ends = structure.digests(structure.transcripts(found.turns))
    every = source.select(F.col("conv_id").alias("conv")).distinct()
    rows = every.unionByName(found.conversations, allowMissingColumns=True).unionByName(
        ends, allowMissingColumns=True)
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return rows.groupBy(F.col("conv").alias("conv_id")).agg(
        *[F.coalesce(F.max(c), F.lit(0).cast("bigint")).alias(c) for c in counts],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op12_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return search(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op13_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    found = fingerprint.fingerprints(_table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint.shown(F.col("fingerprint")).alias("fingerprint"),
        fingerprint.shown(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        fingerprint.likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        fingerprint.likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: value for name, value in globals().items() if name.startswith("op") and callable(value)
}
