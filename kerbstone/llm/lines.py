"""Line deduplication with levelled sorted runs of line hashes.

Documents come in batches, those with the largest ids first. Each batch's
lines are reduced to one row per key and anti-joined with the runs written so
far: a key that no run has is owned by this batch's largest document, because
later batches only have smaller ids. The batch then adds a run of its own, and
full levels are compacted into one run of the next level.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbstone.llm.batches import with_text_columns
from kerbstone.plans.cut import cut, scratch_root

#: A line is looked at when its key has this many code points.
MIN_CHARS = 40
#: ... and lost when so many documents hold it.
MIN_DOCS = 5
#: Batches that a table is dealt into.
BATCHES = 4
#: Runs of a level that are compacted into one of the next.
FANOUT = 3

# Fixed values of the line key: what is stripped, and A-Z lower-cased.
STRIPPED = " \t\n\x0b\x0c\r"
LOWERED = {c: c + 32 for c in range(65, 91)}


def line_key(line: str) -> str:
    return line.strip(STRIPPED).translate(LOWERED)


def long_keys(text: str, min_chars: int) -> Iterator[tuple[int, bytes]]:
    """Place and 128-bit key hash of each line whose key has ``min_chars`` code points."""
    for at, line in enumerate(text.split("\n")):
        if len(line) >= min_chars and len(key := line_key(line)) >= min_chars:
            yield at, hashlib.blake2b(key.encode(), digest_size=16).digest()


class LineRuns:
    """A levelled store of sorted runs: ``key, docs, owner``.

    Each run is a folder in the shared scratch folder, dealt and sorted by
    key, with one row per key: how many documents of its batches hold the key
    and, if it was the first run to have it, which document keeps the line.
    """

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark = spark
        self.fanout = fanout
        self.levels: list[list[DataFrame]] = []

    def _write(self, run: DataFrame) -> DataFrame:
        path = f"{scratch_root(self.spark)}/lines-{uuid.uuid4().hex}"
        run.sortWithinPartitions("key").write.parquet(path)
        return self.spark.read.schema(run.schema).parquet(path)

    def runs(self) -> DataFrame | None:
        """All rows of all runs."""
        every = [run for level in self.levels for run in level]
        whole = None
        for run in every:
            whole = run if whole is None else whole.union(run)
        return whole

    def add(self, lines: DataFrame) -> None:
        """Anti-join a batch (``id, key``; a document's keys distinct) and add its run.

        Every id must be smaller than, or null beside, those added before.
        """
        batch = lines.groupBy("key").agg(
            F.count("*").alias("docs"), F.max("id").alias("owner")
        )
        known = self.runs()
        if known is not None:
            # the anti-join; keys that are known go on as counts without owner
            known = known.groupBy(F.col("key").alias("_known")).agg(F.lit(True).alias("_seen"))
            batch = batch.join(known, F.col("key") == F.col("_known"), "left").select(
                "key", "docs", F.when(F.col("_seen").isNull(), F.col("owner")).alias("owner")
            )
        if not self.levels:
            self.levels.append([])
        self.levels[0].append(self._write(batch))
        self._compact()

    def _compact(self) -> None:
        level = 0
        while len(self.levels[level]) >= self.fanout:
            if level + 1 == len(self.levels):
                self.levels.append([])
            merged = self.levels[level][0]
            for run in self.levels[level][1:]:
                merged = merged.union(run)
            self.levels[level + 1].append(self._write(summed(merged)))
            self.levels[level] = []
            level += 1

    def frequent(self, docs: int) -> DataFrame:
        """``key, owner`` of the keys that at least ``docs`` documents hold."""
        return summed(self.runs()).where(F.col("docs") >= docs).select("key", "owner")


def summed(runs: DataFrame) -> DataFrame:
    return runs.groupBy("key").agg(F.sum("docs").alias("docs"), F.max("owner").alias("owner"))


def _id_batches(docs: DataFrame, batches: int) -> list[Column]:
    """Filters that deal documents into ranges of their id, largest first; null ids last."""
    number = F.col("id")
    cuts = docs.select(
        F.percentile_approx("id", [i / batches for i in range(1, batches)], 10_000)
    ).first()[0] if batches > 1 else None
    edges = sorted({int(c) for c in cuts or []}, reverse=True)
    if not edges:
        return [F.lit(True)]
    filters = [number > edges[0]]
    filters += [(number <= high) & (number > low) for high, low in zip(edges, edges[1:])]
    return [*filters, (number <= edges[-1]) | number.isNull()]


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    batches: int = BATCHES,
    keep: list[str] | None = None,
) -> DataFrame:
    """Every row of ``docs``: ``keep``, ``n_lines, n_dropped, kept_text``.

    ``id_col`` is a whole number. Texts are split at ``\\n``; a null or empty
    text is one empty line. Keys (stripped of ASCII white space, A-Z lowered)
    of at least ``min_chars`` code points that are in at least ``min_docs``
    rows lose all their lines except in the row with the largest id that holds
    them (all rows that repeat that id). A null id is smaller than any other;
    lines that only rows without id hold stay in all of them. Rows that repeat
    an id count each. A row may keep no line: its text is then empty. A very
    long text is split whole; what a task holds of the others is its own lines. ``keep`` are the columns passed on (all by
    default, but for those with one of the new names). An empty table gives no
    rows.
    """
    kept = [c for c in (docs.columns if keep is None else keep)
            if c not in ("n_lines", "n_dropped", "kept_text")]
    number = F.col(f"`{id_col}`").cast("bigint")
    # what rows with one id and text share: they lose the same lines
    row = F.unhex(F.md5(F.concat(
        F.coalesce(number.cast("string"), F.lit("-")), F.lit(":"), F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    ).cast("binary")))
    source = docs.select(number.alias("id"), row.alias("_row"), F.col(f"`{text_col}`").alias("_text"))

    def keyed(texts: list[str]) -> dict[str, list]:
        return {"_keys": [list(dict.fromkeys(k for _, k in long_keys(t, min_chars))) for t in texts]}

    # The distinct long lines of each row as 128-bit keys: written once.
    long_lines = cut(
        with_text_columns(source, "_text", keyed, {"_keys": T.ArrayType(T.BinaryType())}, ["id", "_row"])
        .select("id", "_row", F.explode("_keys").alias("key"))
    )
    runs = LineRuns(docs.sparkSession)
    for part in _id_batches(long_lines, batches):
        runs.add(long_lines.where(part))

    # An equi-join of single lines, whose sides are shuffled for it alone: a line
    # that a third of all rows share is a partition adaptive execution can split.
    lost = (
        long_lines.join(cut(runs.frequent(min_docs)), "key")
        .where(~F.col("id").eqNullSafe(F.col("owner")))
        .groupBy("_row")
        .agg(F.collect_set("key").alias("_lost"))
    )
    marked = docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*kept, text_col])], row.alias("_at")).join(
        lost, F.col("_at") == F.col("_row"), "left"
    )

    def applied(texts: list[str], lost: list[list[bytes] | None]) -> dict[str, list]:
        out = {"n_lines": [], "n_dropped": [], "kept_text": []}
        for text, keys in zip(texts, lost):
            n_lines, gone = text.count("\n") + 1, set()
            if keys:
                keys = set(keys)
                gone = {at for at, key in long_keys(text, min_chars) if key in keys}
                text = "\n".join(
                    line for at, line in enumerate(text.split("\n")) if at not in gone
                )
            out["n_lines"].append(n_lines)
            out["n_dropped"].append(len(gone))
            out["kept_text"].append(text)
        return out

    types = {"n_lines": T.LongType(), "n_dropped": T.LongType(), "kept_text": T.StringType()}
    return with_text_columns(marked, text_col, applied, types, kept, also=("_lost",))
