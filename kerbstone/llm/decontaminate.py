"""Benchmark decontamination by a prefix-filtered set join.

A benchmark item is the set of its word windows. A text that contains a window
contains its rarest word, so that word alone is the window's join prefix:
words are ordered by how many documents hold them, each window is filed under
its rarest word and that word's place in it, and a document's words are looked
up there. A hit's place must leave room for the whole window (positional and
length bounds), and then the window is compared exactly.

The benchmark, not the corpus, is sent to the tasks, in blocks of bounded
size; each further block is one more pass over the documents.
"""

from __future__ import annotations

import itertools
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbstone.llm.batches import with_text_columns
from kerbstone.plans.cut import cut
from kerbstone.plans.order import running_totals

#: Words of a window.
WINDOW = 13
#: Bytes of item text that are sent to the tasks at once.
BLOCK_BYTES = 1 << 20
#: Bytes of a text that are split into words at once.
PART_BYTES = 1 << 20

#: Lower-cases A-Z and blanks all other ASCII that is not a-z or 0-9.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32
    for c in range(256)
)


def words(text: str | None) -> list[bytes]:
    """The words of a text: runs of ASCII letters and digits and of all beyond ASCII."""
    return (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


def word_parts(text: str, overlap: int):
    """``(place of the first word, words)`` of parts of a text.

    Each part but the first begins with the last ``overlap`` words before it,
    so every run of ``overlap + 1`` words is whole in some part.
    """
    data = text.encode("utf-8", "surrogatepass").translate(WORD_BYTES)
    at, place, carried = 0, 0, []
    while True:
        to = len(data) if at + PART_BYTES >= len(data) else data.rfind(b" ", at, at + PART_BYTES) + 1
        if to <= at:  # one word is longer than a part
            to = data.find(b" ", at) + 1 or len(data)
        part = carried + data[at:to].split()
        yield place, part
        if to >= len(data):
            return
        carried = part[len(part) - min(overlap, len(part)):]
        place += len(part) - len(carried)
        at = to


def item_windows(text: str | None, size: int) -> list[list[bytes]]:
    """All windows of an item; one of fewer words, but not none, is one window."""
    found = words(text)
    if not found:
        return []
    return [found[i:i + size] for i in range(max(1, len(found) - size + 1))]


def file_windows(items: list[tuple[list[str], str]], held: dict[bytes, int], size: int) -> dict:
    """``{rarest word: [(its place, words of the window, {window: lists of item ids})]}``."""
    filed: dict[bytes, dict] = {}
    for ids, text in items:
        ids = tuple(ids)
        for window in item_windows(text, size):
            place = min(range(len(window)), key=lambda i: (held.get(window[i], 0), window[i]))
            under = filed.setdefault(window[place], {}).setdefault((place, len(window)), {})
            under.setdefault(b" ".join(window), set()).add(ids)
    return {w: [(p, n, t) for (p, n), t in sorted(x.items())] for w, x in filed.items()}


def find_windows(text: str, filed: dict, size: int) -> tuple[int, set[int], set]:
    """Number of words, places inside occurring windows, ids of their items."""
    hit, ids, n_words = set(), set(), 0
    for first, part in word_parts(text, size - 1):
        n_words = first + len(part)
        for i, word in enumerate(part):
            if word in filed:
                for place, length, windows in filed[word]:
                    start = i - place
                    if start < 0 or start + length > len(part):
                        continue
                    got = windows.get(b" ".join(part[start:start + length]))
                    if got:
                        hit.update(range(first + start, first + start + length))
                        ids |= got
    return n_words, hit, ids


def _document_counts(docs: DataFrame, text_col: str, vocabulary: set[bytes]) -> dict[bytes, int]:
    """In how many documents each word of a bounded vocabulary is."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(texts: list[str]) -> dict[str, list]:
        # one partial count of each part of a batch, on its first row
        seen = Counter(itertools.chain.from_iterable(
            sent.value.intersection(itertools.chain.from_iterable(p for _, p in word_parts(t, 0)))
            for t in texts
        ))
        rows = [[{"word": w, "n": n} for w, n in seen.items()]]
        return {"_counts": rows + [[]] * (len(texts) - 1)}

    entry = T.StructType([T.StructField("word", T.BinaryType()), T.StructField("n", T.LongType())])
    counts = (
        with_text_columns(docs, text_col, count, {"_counts": T.ArrayType(entry)}, [])
        .select(F.explode("_counts").alias("_c"))
        .groupBy("_c.word")
        .agg(F.sum("_c.n").alias("n"))
    )
    held = {bytes(r["word"]): r["n"] for r in counts.toLocalIterator()}
    sent.unpersist()
    return held


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    keep: list[str] | None = None,
) -> DataFrame:
    """Every row of ``docs``: ``keep, n_words, n_hit, n_items, items, contaminated``.

    ``items`` has the distinct ids of items with an occurring window, as
    strings in their order; ``contaminated`` is ``n_hit > 0`` and at least one
    word in twenty is hit. A null text has no words; a null item id is never
    listed, though its windows hit. Repeated documents are looked at one by one,
    repeated items once; a very long text is read in parts. With an empty benchmark nothing is hit; without documents there are no
    rows. ``keep`` are the columns passed on (all by default, but for those
    with one of the new names).
    """
    names = ("n_words", "n_hit", "n_items", "items", "contaminated")
    kept = [c for c in (docs.columns if keep is None else keep) if c not in names]
    items = cut(
        benchmark.select(
            F.col(f"`{item_id}`").cast("string").alias("id"), F.col(f"`{item_text}`").alias("text")
        )
        .where("text is not null")
        .distinct()
        .withColumns({"_text": F.sha2("text", 256), "_bytes": F.octet_length(F.coalesce("id", F.lit(""))) + 8})
    )
    # A text counts for its bytes once and for each of its ids, so a text with very
    # many ids is spread over blocks and any block is bounded.
    sized = items.groupBy("_text").agg(F.min(F.struct(F.coalesce("id", F.lit("")), "id")).alias("_f")).select("_text", "_f.id")
    sized = items.join(sized.select(F.col("_text").alias("_t"), F.col("id").alias("_i"), F.lit(1).alias("_first")),
                       (F.col("_text") == F.col("_t")) & F.col("id").eqNullSafe(F.col("_i")), "left")
    sized = cut(sized.select("id", "text", "_text", F.when(F.col("_first") == 1, F.col("_bytes") + F.octet_length("text"))
                             .otherwise(F.col("_bytes")).alias("_bytes")))
    total = sized.agg(F.coalesce(F.sum("_bytes"), F.lit(0))).first()[0]
    dealt = sized.withColumn("_block", F.lit(0))
    if total > block_bytes:
        before = running_totals(sized, [F.col("_text"), F.col("id").asc_nulls_first()], {"_before": "_bytes"})
        dealt = cut(before.withColumn("_block", F.floor(F.col("_before") / block_bytes)))
    blocks = [r["_block"] for r in dealt.select("_block").distinct().orderBy("_block").collect()] or [0]

    result = docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*kept, text_col])])
    result = result.withColumns({
        "_spans": F.array().cast("array<bigint>"), "items": F.array().cast("array<string>"),
    })
    for block in blocks:
        of_text = dealt.where(F.col("_block") == block).groupBy("_text").agg(
            F.min("text").alias("text"), F.collect_list("id").alias("ids"))
        rows = [(r["ids"], r["text"]) for r in of_text.collect()]
        held = _document_counts(docs, text_col, {w for _, t in rows for w in words(t)})
        result = _with_hits(result, text_col, file_windows(rows, held, window), window, kept)
        if block != blocks[-1]:
            result = cut(result)
    return result.select(
        *[F.col(f"`{c}`") for c in kept],
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        "items",
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def _with_hits(
    docs: DataFrame, text_col: str, filed: dict, size: int, kept: list[str]
) -> DataFrame:
    """Add one block's hits to those of the blocks before it."""
    sent = docs.sparkSession.sparkContext.broadcast(filed)

    def hits(texts: list[str], spans: list[list[int]], items: list[list[str]]) -> dict[str, list]:
        out = {"n_words": [], "n_hit": [], "_spans": [], "items": []}
        for text, before, ids in zip(texts, spans, items):
            n_words, hit, found = find_windows(text, sent.value, size)
            for start, end in zip(before[::2], before[1::2]):
                hit.update(range(start, end))
            ends = sorted(hit)
            starts = [p for i, p in enumerate(ends) if i == 0 or ends[i - 1] != p - 1]
            stops = [p + 1 for i, p in enumerate(ends) if i + 1 == len(ends) or ends[i + 1] != p + 1]
            out["n_words"].append(n_words)
            out["n_hit"].append(len(hit))
            out["_spans"].append([x for span in zip(starts, stops) for x in span])
            out["items"].append(sorted({*ids, *(i for of in found for i in of)}))
        return out

    types = {
        "n_words": T.LongType(), "n_hit": T.LongType(),
        "_spans": T.ArrayType(T.LongType()), "items": T.ArrayType(T.StringType()),
    }
    keep = [*kept, *([] if text_col in kept else [text_col])]
    return with_text_columns(docs, text_col, hits, types, keep, also=("_spans", "items"))
