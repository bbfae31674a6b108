"""Ranked lexical search by presence masks.

Every item is a query against every document. Documents are read once and
stored as postings of the items' terms. A task then takes its documents block by
block: for each item the bitmaps of its terms are laid side by side, so that a
column is the mask of the terms that a document has, and equal masks are one
group. A group's score can't exceed what its terms give at most in the block.
Groups are evaluated from the highest bound downwards, and as soon as the next
bound is below the item's worst kept score, the rest is safely left alone.

Nothing of a document is shuffled but the hits that a task keeps. The items are
sent to the tasks, in chunks of bounded size; each further chunk is one more
pass over the documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from kerbstone.llm.batches import with_text_columns
from kerbstone.llm.decontaminate import word_parts
from kerbstone.plans.cut import cut
from kerbstone.plans.order import running_totals
from kerbstone.plans.skew import lookup_join

#: Hits kept of an item.
TOP = 20
#: Bytes of different item texts that are sent to the tasks at once.
CHUNK_BYTES = 8 << 20
#: Documents that are scored at once, at first; then twice as many each time.
STEP = 64


def term_counts(text: str | None) -> Counter:
    """How often each term occurs: runs of ASCII letters and digits and of all beyond ASCII, A-Z lowered."""
    counts: Counter = Counter()
    for _, part in word_parts(text or "", 0):
        counts.update(part)
    return counts


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_norms(lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """The integer length norm of documents of so many terms; exact beyond 64 bits too."""
    if len(lengths) and 25 * int(lengths.max()) * n_docs >= 1 << 63:
        return np.array([75 + 25 * int(n) * n_docs // n_terms for n in lengths], np.int64)
    return 75 + 25 * lengths * n_docs // n_terms


class Query(NamedTuple):
    """An item: the numbers of its terms, ascending, and what an occurrence of each is worth."""

    key: str
    terms: np.ndarray
    worth: np.ndarray


class Block:
    """Postings of some documents, by term."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, sizes: np.ndarray,
                 terms: np.ndarray, tfs: np.ndarray, n_docs: int, n_terms: int):
        self.ids = ids
        docs = np.repeat(np.arange(len(ids)), sizes)
        norms = length_norms(lengths, n_docs, n_terms)
        parts = 1_000_000_000 * tfs // (1000 * tfs + 12 * norms[docs])
        order = np.argsort(terms, kind="stable")
        self.docs, self.parts = docs[order], parts[order]
        self.known, starts = np.unique(terms[order], return_index=True)
        self.starts = np.append(starts, len(order))
        self.most = np.maximum.reduceat(self.parts, starts) if len(order) else np.zeros(0, np.int64)

    def postings(self, query: Query) -> list[tuple[int, np.ndarray, np.ndarray, int]]:
        """Of each term of the item that the block holds: worth, documents, parts of a score, their most."""
        at = np.searchsorted(self.known, query.terms)
        out = []
        for place, term, worth in zip(at.tolist(), query.terms.tolist(), query.worth.tolist()):
            if place < len(self.known) and self.known[place] == term:
                span = slice(self.starts[place], self.starts[place + 1])
                out.append((worth, self.docs[span], self.parts[span], int(self.most[place])))
        return out


def masks(postings: list, n_docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents with a term, grouped by their mask: masks as rows of bits, group starts, documents by group."""
    bits = np.zeros((-(-len(postings) // 64) * 64, n_docs), bool)
    for row, (_, docs, _, _) in zip(bits, postings):
        row[docs] = True
    some = np.flatnonzero(bits.any(axis=0))
    columns = np.ascontiguousarray(np.packbits(bits[:, some], axis=0, bitorder="little").T).view(np.uint64)
    order = np.lexsort(columns.T)
    sorted_ = columns[order]
    new = np.ones(len(order), bool)
    new[1:] = (sorted_[1:] != sorted_[:-1]).any(axis=1)
    starts = np.flatnonzero(new)
    distinct = np.unpackbits(np.ascontiguousarray(sorted_[starts]).view(np.uint8), axis=1, bitorder="little")
    return distinct[:, :len(postings)], starts, some[order]


class Kept:
    """The best hits of an item so far: highest score, then smallest id, null ids last."""

    def __init__(self, top: int):
        self.top = top
        self.scores, self.ids, self.null = (np.zeros(0, t) for t in (np.int64, np.int64, bool))

    @property
    def worst(self) -> int:
        """A document needs this score at least, and more than nothing."""
        return int(self.scores[-1]) if len(self.scores) == self.top else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        good = scores >= self.worst
        scores, ids, null = (np.concatenate(x) for x in (
            (self.scores, scores[good]), (self.ids, ids[good]), (self.null, null[good])))
        order = np.lexsort((ids, null, -scores))[: self.top]
        self.scores, self.ids, self.null = scores[order], ids[order], null[order]


def evaluate(block: Block, null: np.ndarray, query: Query, kept: Kept) -> int:
    """Add the block's hits of one item; how many documents were scored."""
    postings = block.postings(query)
    if not postings or sum(worth * most for worth, _, _, most in postings) < kept.worst:
        return 0
    bits, starts, docs = masks(postings, len(block.ids))
    bounds = bits.astype(np.int64) @ np.array([worth * most for worth, _, _, most in postings])
    order = np.argsort(-bounds, kind="stable")
    ends = np.append(starts[1:], len(docs))
    at, scored, step = 0, 0, STEP
    while at < len(order) and bounds[order[at]] >= kept.worst:
        groups, n = [], 0
        while at < len(order) and n < step and bounds[order[at]] >= kept.worst:
            group = order[at]
            groups.append(docs[starts[group]:ends[group]])
            n += len(groups[-1])
            at += 1
        found = np.concatenate(groups)
        scores = np.zeros(len(found), np.int64)
        for worth, holders, parts, _ in postings:
            place = np.minimum(np.searchsorted(holders, found), len(holders) - 1)
            scores += np.where(holders[place] == found, worth * parts[place], 0)
        kept.add(scores, block.ids[found], null[found])
        scored += n
        step *= 2
    return scored


def _postings(docs: DataFrame, id_col: str, text_col: str, numbers: dict[bytes, int]) -> DataFrame:
    """``id, n, terms, tfs`` of each document with a term, written."""
    sent = docs.sparkSession.sparkContext.broadcast(numbers)

    def counted(texts: list[str]) -> dict[str, list]:
        out = {"n": [], "terms": [], "tfs": []}
        for text in texts:
            counts = term_counts(text)
            known = sorted((sent.value[t], n) for t, n in counts.items() if t in sent.value)
            out["n"].append(sum(counts.values()))
            out["terms"].append([t for t, _ in known])
            out["tfs"].append([n for _, n in known])
        return out

    types = {"n": T.LongType(), "terms": T.ArrayType(T.IntegerType()), "tfs": T.ArrayType(T.LongType())}
    source = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("_text"))
    found = cut(with_text_columns(source, "_text", counted, types, ["id"]).where("n > 0"))
    sent.unpersist()
    return found


def _hits(postings: DataFrame, queries: list[Query], n_docs: int, n_terms: int, top: int) -> DataFrame:
    """``key, id, score``: the best hits of each item in each task."""
    schema = T.StructType([
        T.StructField("key", T.StringType()), T.StructField("id", T.LongType()), T.StructField("score", T.LongType())])
    arrow = to_arrow_schema(schema)
    sent = postings.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [Kept(top) for _ in sent.value]
        for batch in batches:
            ids = batch.column("id")
            null = np.asarray(ids.is_null())
            terms, tfs = batch.column("terms"), batch.column("tfs")
            block = Block(
                ids.fill_null(0).to_numpy(), batch.column("n").to_numpy(),
                np.diff(terms.offsets.to_numpy()), terms.flatten().to_numpy(), tfs.flatten().to_numpy(),
                n_docs, n_terms)
            for query, best in zip(sent.value, kept):
                evaluate(block, null, query, best)
        for query, best in zip(sent.value, kept):
            if len(best.scores):
                yield pa.RecordBatch.from_arrays([
                    pa.array([query.key] * len(best.scores)), pa.array(best.ids, mask=best.null),
                    pa.array(best.scores)], schema=arrow)

    return postings.mapInArrow(run, schema)


def search(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    top: int = TOP,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` best documents of each row of ``items``.

    A score sums, over the item's terms with their repeats, a term's weight
    times its saturated share, all in whole numbers; documents without a score
    above 0 are no hits. Equal scores are ranked by ascending id, null ids last;
    repeated documents are hits of their own. Ids are whole numbers. Null and
    empty texts have no terms and are no hits; an item without terms has no
    rows; repeated items have rows each, though a text is searched for once. A very
    long text is split in parts and held once as counts. No documents or no
    items give no rows; other columns are not read.
    """
    spark = docs.sparkSession
    asked = cut(items.select(
        F.col(f"`{item_id}`").alias("item"), F.coalesce(F.col(f"`{item_text}`"), F.lit("")).alias("text"),
    ).withColumn("key", F.sha2("text", 256)))
    texts = cut(asked.groupBy("key").agg(F.min("text").alias("text")).withColumn("bytes", F.octet_length("text")))
    total = texts.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    dealt = texts.withColumn("chunk", F.lit(0))
    if total > chunk_bytes:
        dealt = cut(running_totals(texts, [F.col("key")], {"before": "bytes"}).withColumn(
            "chunk", F.floor(F.col("before") / chunk_bytes)))
    hits = spark.createDataFrame([], "key string, id bigint, score bigint")
    for row in dealt.select("chunk").distinct().orderBy("chunk").toLocalIterator():
        counts = {r["key"]: term_counts(r["text"]) for r in dealt.where(F.col("chunk") == row["chunk"]).collect()}
        numbers = {t: i for i, t in enumerate(sorted({t for c in counts.values() for t in c}))}
        postings = _postings(docs, id_col, text_col, numbers)
        n_docs, n_terms = postings.agg(F.count("*"), F.sum("n")).first()
        held = dict(postings.select(F.explode("terms").alias("t")).groupBy("t").count().collect())
        queries = []
        for key, count in sorted(counts.items()):
            found = sorted((numbers[t], n) for t, n in count.items() if numbers[t] in held)
            worth = [n * term_weight(n_docs, held[t]) for t, n in found]
            queries.append(Query(key, np.array([t for t, _ in found], np.int64), np.array(worth, np.int64)))
        hits = hits.union(_hits(postings, queries, n_docs, n_terms, top))
    order = Window.partitionBy("key").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    best = cut(
        hits.select("*", F.row_number().over(order).alias("rank")).where(F.col("rank") <= top)
        .groupBy("key").agg(F.array_sort(F.collect_list(F.struct("rank", "id", "score"))).alias("hits"))
    )
    return (
        lookup_join(asked.select("item", "key"), best, "key")
        .select(F.col("item").alias(item_id), F.explode("hits").alias("h"))
        .select(item_id, "h.rank", F.col("h.id").alias(id_col), "h.score")
    )
