"""Exact duplicates by content-defined chunk recipes.

Only DataFrame functions run here. A normalised text is cut into chunks where
its content says so. Chunks are deduplicated to verified identifiers, and
documents are compared by their ordered identifier lists. Text is read once
and never shuffled: what moves of a document is forty bytes for each chunk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbstone.plans.cut import cut

#: A chunk has this many characters at least, unless its text ends.
CHUNK_MIN = 1024
#: ... and at most this many.
CHUNK_MAX = 8192
#: A chunk ends after one of these characters.
CHUNK_ENDS = r"\n.!?;"

CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(text: Column) -> Column:
    """``text`` (null: empty) with A-Z in lower case and nothing else changed.

    ``lower`` would change other letters too, but is much faster on the texts
    that have none.
    """
    text = F.coalesce(text, F.lit(""))
    only_ascii = F.octet_length(text) == F.char_length(text)
    return F.when(only_ascii, F.lower(text)).otherwise(
        F.translate(text, CAPITALS, CAPITALS.lower())
    )


def chunks(text: Column, least: int = CHUNK_MIN, most: int = CHUNK_MAX) -> Column:
    """The ordered chunks of ``text``; an empty text has none.

    A chunk ends at the first sentence or line end after ``least`` characters,
    so an insertion changes the chunks around it and the later ones fall back
    into step. Joined, the chunks are the text.
    """
    pattern = (
        f"(?s).{{{least}}}[^{CHUNK_ENDS}]{{0,{most - least - 1}}}[{CHUNK_ENDS}]?|.{{1,{most}}}"
    )
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def verified(recipes: DataFrame) -> DataFrame:
    """``recipes`` with ``_chunks`` reduced to ``_list``, of verified identifiers.

    A chunk's identifier is its 64-bit hash, verified by its SHA-256 digest:
    where one hash has several digests, all but the first get a variant number,
    which is part of the identifier. Equal chunks meet in the map side's
    partial aggregate, so one with a million copies is one row of each task.
    """
    distinct = recipes.select(F.explode("_chunks").alias("_c")).select("_c.*").distinct()
    variants = cut(
        distinct.select(
            "*",
            (F.row_number().over(Window.partitionBy("id").orderBy("digest")) - 1).alias("variant"),
        ).where("variant > 0")
    )
    if variants.isEmpty():
        return recipes.withColumn("_list", F.transform("_chunks", lambda c: c["id"]))
    # Two hashes in 2^64 are equal: a rebuilt list also holds the variants.
    places = recipes.select("_row", F.posexplode("_chunks").alias("_at", "_c")).select(
        "_row", "_at", "_c.*"
    )
    lists = (
        places.join(variants, ["id", "digest"], "left")
        .groupBy("_row")
        .agg(F.array_sort(F.collect_list(F.struct("_at", "id", "variant"))).alias("_l"))
        .select(
            "_row",
            F.flatten(
                F.transform("_l", lambda c: F.array(c["id"], F.coalesce(c["variant"], F.lit(0))))
            ).alias("_list"),
        )
    )
    return recipes.join(lists, "_row", "left").withColumn(
        "_list", F.coalesce("_list", F.array().cast("array<bigint>"))
    )


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    id_bits: int = 64,
    least: int = CHUNK_MIN,
    most: int = CHUNK_MAX,
) -> DataFrame:
    """One row per row of ``docs``: ``id_col, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z only; a null text is
    an empty one. Of equal texts the row with the largest id stays. A null id
    is smaller than any other; in a group that has only null ids ``keep_id`` is
    null and all rows are ``kept``, as are all that repeat the largest id.
    Other columns of ``docs`` are not read. An empty table gives no rows.
    ``id_bits`` shortens the hashes, for tests of what happens when they clash.
    """
    text = ascii_lower(F.col(f"`{text_col}`"))

    def marked(piece: Column) -> Column:
        number = F.xxhash64(piece)
        if id_bits < 64:
            number = F.pmod(number, F.lit(1 << id_bits))
        return F.struct(number.alias("id"), F.unhex(F.sha2(piece, 256)).alias("digest"))

    recipes = cut(
        docs.select(F.col(f"`{id_col}`").alias("_id"), text.alias("_text")).select(
            "_id",
            F.monotonically_increasing_id().alias("_row"),
            F.sha2("_text", 256).alias("text_sha256"),
            F.transform(chunks(F.col("_text"), least, most), marked).alias("_chunks"),
        )
    )
    lists = verified(recipes).select("_id", "text_sha256", "_list")
    # Groups of two and more are written before they are joined back: then both
    # sides of the join are shuffled for it alone, and adaptive execution can
    # split a partition in which one list has a third of all rows.
    groups = cut(
        lists.groupBy(F.col("_list").alias("_key"))
        .agg(F.max("_id").alias("_keep"), F.count("*").alias("_size"))
        .where("_size > 1")
    )
    keep_id = F.when(F.col("_size").isNull(), F.col("_id")).otherwise(F.col("_keep"))
    return (
        lists.join(groups, F.col("_list") == F.col("_key"), "left")
        .withColumn("keep_id", keep_id)
        .select(
            F.col("_id").alias(id_col),
            "keep_id",
            F.coalesce("_size", F.lit(1).cast("bigint")).alias("group_size"),
            F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"),
            "text_sha256",
        )
    )
