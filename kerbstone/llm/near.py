"""Near-duplicates by an exact-verified Jaccard join over a MinHash LSH forest.

A document is the set of its five-word shingles. Documents with one set are
one node. Each tree of the forest files a node under a prefix of its MinHash
values; prefixes are shortened from the full depth until a pair at the
threshold meets in some tree with the target recall. Nodes that meet are
compared by their signatures and joined to clusters of lookalikes; inside a
cluster all shingle sets are compared exactly, block by block, and only sums
per node leave a task. No pair of documents is ever a row.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbstone.llm.batches import with_text_columns
from kerbstone.llm.decontaminate import words
from kerbstone.plans.components import connected_components
from kerbstone.plans.cut import cut

#: Words of a shingle.
SHINGLE = 5
#: Two documents are alike from this Jaccard similarity on, in hundredths.
THRESHOLD = 80
#: Trees of the forest, and MinHash values of a tree.
TREES, DEPTH = 24, 6
#: A pair at the threshold must meet with this probability.
RECALL = 0.99999
#: Nodes of one tree cell that are compared with each other. Those of a larger
#: cell, which share a whole prefix, are one cluster without comparison.
CELL = 1024
#: Signatures that agree in less than this share rule a pair out (six standard
#: deviations below the threshold).
LOOKALIKE = 0.6
#: Nodes, and shingles, of one block of a cluster.
BLOCK, BLOCK_SHINGLES = 512, 2_000_000
#: Words that a worker remembers the hashes of.
REMEMBERED = 200_000

MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB,
                        0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


def matched_depth(threshold: float, trees: int, depth: int, recall: float) -> int:
    """The longest prefix with which a pair at ``threshold`` meets often enough.

    ``depth`` values match in one tree with probability ``threshold**depth``.
    The prefix is shortened value by value until the trees together reach
    ``recall``.
    """
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


@functools.cache
def word_hashes() -> _WordHashes:
    return _WordHashes()


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * MULTIPLIERS[1]
    values = (values ^ (values >> np.uint64(27))) * MULTIPLIERS[2]
    return values ^ (values >> np.uint64(31))


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """The distinct 64-bit shingle hashes of a text, sorted; fewer words are one shingle."""
    found = words(text)
    if not found:
        return np.zeros(0, dtype=np.uint64)
    hashes = np.fromiter(map(word_hashes().__getitem__, found), np.uint64, len(found))
    width = min(size, len(hashes))
    total = np.zeros(len(hashes) - width + 1, dtype=np.uint64)
    for i in range(width):
        total = mixed(total + hashes[i:len(hashes) - width + 1 + i] + MULTIPLIERS[0])
    return np.unique(total)


def node_of(text: str | None, found: np.ndarray) -> bytes:
    """What stands for a shingle set; a text without words stands for itself."""
    if len(found):
        return hashlib.blake2b(found.tobytes(), digest_size=16).digest()
    return hashlib.blake2b((text or "").encode("utf-8", "surrogatepass"), digest_size=16, key=b"no words").digest()


@functools.cache
def permutations(count: int) -> np.ndarray:
    return mixed(np.arange(1, count + 1, dtype=np.uint64) * MULTIPLIERS[0]) | np.uint64(1)


def signature(found: np.ndarray, count: int) -> np.ndarray:
    """``count`` MinHash values of 32 bits."""
    least = np.full(count, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(found), 2048):
        product = found[at:at + 2048, None] * permutations(count)[None, :]
        least = np.minimum(least, product.min(axis=0))
    return (least >> np.uint64(32)).astype(np.uint32)


def prefixes(values: np.ndarray, trees: int, depth: int) -> np.ndarray:
    """One 64-bit hash for each tree's first ``depth`` values."""
    by_tree = values.reshape(trees, -1)[:, :depth].astype(np.uint64)
    total = mixed(np.arange(1, trees + 1, dtype=np.uint64))
    for i in range(depth):
        total = mixed(total + by_tree[:, i] + MULTIPLIERS[0])
    return total.view(np.int64)


def roots(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric Boolean matrix the least row it is connected to."""
    root = np.arange(len(linked))
    seen = np.zeros(len(linked), dtype=bool)
    for start in range(len(linked)):
        if seen[start]:
            continue
        reached = np.zeros(len(linked), dtype=bool)
        reached[start] = True
        edge = reached
        while edge.any():
            edge = linked[edge].any(axis=0) & ~reached
            reached |= edge
        seen |= reached
        root[reached] = start
    return root


def cell_edges(cells) -> object:
    """Of rows sorted by cell, edges from each node to the first lookalike it is connected to."""
    held, at = [], None

    def found():
        if len(held) < 2:
            return
        names = sorted(dict(held))
        table = np.stack([np.frombuffer(dict(held)[n], dtype=np.uint8) for n in names])
        alike = np.eye(len(names), dtype=bool)
        for i in range(0, len(names), 64):
            alike[i:i + 64] |= (table[i:i + 64, None, :] == table[None, :, :]).mean(axis=2) >= LOOKALIKE
        for name, root in zip(names, roots(alike)):
            if names[root] != name:
                yield name, names[root]

    for batch in cells:
        out = []
        for prefix, node, sig in zip(*[batch.column(c).to_pylist() for c in ("prefix", "node", "sig")]):
            if prefix != at:
                out += found()
                held, at = [], prefix
            held.append((node, sig))
        yield edge_batch(out)
    yield edge_batch(found())


def edge_batch(edges) -> pa.RecordBatch:
    edges = list(edges)
    return pa.RecordBatch.from_arrays(
        [pa.array([e[i] for e in edges], pa.binary()) for i in (0, 1)], names=["a", "b"]
    )


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """How many values each two sets share."""
    sizes = [len(s) for s in sets]
    total = np.diag(np.array(sizes, dtype=np.float64))
    rows = np.repeat(np.arange(len(sets)), sizes)
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[column] > 1
    rows, column = rows[shared], column[shared]
    if not len(rows):
        return total
    _, column = np.unique(column, return_inverse=True)
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    total[:] = 0
    for at in range(0, column[-1] + 1, 4096):
        first, past = np.searchsorted(column, [at, at + 4096])
        part = np.zeros((len(sets), 4096), dtype=np.float32)
        part[rows[first:past], column[first:past] - at] = 1
        total += part @ part.T
    np.fill_diagonal(total, sizes)
    return total


def compared(rows: pd.DataFrame, threshold: int, size: int) -> pd.DataFrame:
    """The exact links of one cluster, or of two of its blocks: sums and roots per node."""
    sets = [shingles(t, size) for t in rows["text"]]
    sizes = np.array([len(s) for s in sets], dtype=np.float64)
    shared = overlaps(sets)
    linked = 100 * shared >= threshold * (sizes[:, None] + sizes[None, :] - shared)
    np.fill_diagonal(linked, False)
    block, other = rows["block"].to_numpy(), rows["j"].iloc[0]
    if rows["i"].iloc[0] != other:
        # two blocks: what is inside one of them is counted elsewhere
        linked &= block[:, None] != block[None, :]
    names = rows["node"].tolist()
    return pd.DataFrame({
        "node": names,
        "root": [names[r] for r in roots(linked)],
        "links": (linked * rows["copies"].to_numpy()[None, :]).sum(axis=1).astype(np.int64),
    })


def near_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    row_col: str | None = None,
    threshold: int = THRESHOLD,
    shingle: int = SHINGLE,
    trees: int = TREES,
    depth: int = DEPTH,
    recall: float = RECALL,
    block: int = BLOCK,
    cell: int = CELL,
) -> DataFrame:
    """One row per row of ``docs``: ``id_col, class_id, n_links``.

    Two rows are linked if the Jaccard similarity of their shingle sets is at
    least ``threshold`` hundredths; words are lower-cased runs of ASCII letters
    and digits and of all characters beyond ASCII. ``n_links`` is how many
    other rows a row is linked to, ``class_id`` the smallest id it is connected
    to by links, its own if it has none. A text of fewer words than a shingle
    is one shingle; one without words (also null or empty) is linked to
    identical texts only. A null id is larger than any other; a class of only
    such rows has a null ``class_id``. Repeated rows are copies. Other columns
    are not read; no rows give no rows.

    ``row_col`` names a column of ``docs`` that is stored and differs in every
    row. With it the result also has that column and ``class_row``, the value
    of the one row that stands for the class: of those with the smallest id,
    nulls last, the smallest.
    """
    fit = matched_depth(threshold / 100, trees, depth, recall)

    def sketched(texts: list[str]) -> dict[str, list]:
        out = {"node": [], "n": [], "prefixes": [], "sig": []}
        for text in texts:
            found = shingles(text, shingle)
            out["node"].append(node_of(text, found))
            out["n"].append(len(found))
            values = signature(found, trees * depth) if len(found) else None
            out["prefixes"].append([] if values is None else prefixes(values, trees, fit).tolist())
            out["sig"].append(b"" if values is None else values.astype(np.uint8).tobytes())
        return out

    types = {"node": T.BinaryType(), "n": T.LongType(),
             "prefixes": T.ArrayType(T.LongType()), "sig": T.BinaryType()}
    # Ids may be null or repeated, so a text is found again by a key of its row.
    row = F.monotonically_increasing_id() if row_col is None else F.col(f"`{row_col}`")
    source = docs.select(row.alias("row"), F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    if row_col is None:
        source = cut(source)
    sketches = cut(with_text_columns(source, "text", sketched, types, ["row", "id"]))

    # A node is a shingle set: its copies are counted where they are read.
    nodes = cut(
        sketches.groupBy("node").agg(
            F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("first"),
            F.count("*").alias("copies"), F.max("n").alias("n"),
            F.max("prefixes").alias("prefixes"), F.max("sig").alias("sig"),
        )
    )
    # Joins that grow with the corpus are merge joins at every size: narrow rows
    # find out who meets, and only those who do carry their signatures along.
    filed = nodes.select("node", F.explode("prefixes").alias("prefix"))
    cells = cut(
        filed.groupBy("prefix").agg(F.count("*").alias("size"), F.min("node").alias("least")).where("size > 1")
    )
    met = cut(filed.join(cells.hint("merge"), "prefix"))
    large = met.where((F.col("size") > cell) & (F.col("node") != F.col("least"))).select(
        F.col("node").alias("a"), F.col("least").alias("b"))
    small = (
        met.where(F.col("size") <= cell)
        .select("prefix", "node")
        .join(nodes.select("node", "sig").hint("merge"), "node")
        .select("prefix", "node", "sig")
        .repartition("prefix")
        .sortWithinPartitions("prefix")
        .mapInArrow(cell_edges, "a binary, b binary")
    )
    edges = cut(small.union(large).distinct())
    # written, so that the joins of the components shuffle both sides for themselves
    members = cut(edges.select(F.col("a").alias("key")).union(edges.select(F.col("b").alias("key"))).distinct())
    clusters = cut(connected_components(members, edges).join(
        nodes.select(F.col("node").alias("key"), F.col("first.row").alias("row"), "copies", "n"), "key"))

    # Blocks of bounded size: small clusters share one, large ones have several
    # and each two of them are compared.
    sizes = clusters.groupBy("component").agg(
        F.greatest(F.ceil(F.count("*") / block), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    placed = (
        clusters.join(sizes, "component")
        .withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
        .withColumn("pair", F.explode(F.transform(
            F.sequence(F.lit(0), F.col("blocks") - 1),
            lambda b: F.struct(F.least(b, F.col("block")).alias("i"), F.greatest(b, F.col("block")).alias("j")))))
        .select(F.col("key").alias("node"), F.col("row").alias("_row"), "copies", "component", "blocks", "block", "pair.*")
    )
    compare = functools.partial(compared, threshold=threshold, size=shingle)

    def of_group(rows: pd.DataFrame) -> pd.DataFrame:
        parts = [compare(part) for _, part in rows.groupby("component", sort=False)]
        return pd.concat(parts, ignore_index=True)

    bins = F.greatest(F.lit(1), F.ceil(F.lit(clusters.count()) / (4 * block)))
    group = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("component"), bins)).otherwise(F.xxhash64("component", F.lit(1)))
    links = cut(
        source.join(placed.hint("merge"), F.col("row") == F.col("_row"))
        .select("text", "node", "copies", "component", "block", "i", "j", group.alias("g"))
        .groupBy("g", "i", "j")
        .applyInPandas(of_group, "node binary, root binary, links long")
    )
    joined = links.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")).distinct()
    joined = cut(joined)
    ends = cut(joined.select(F.col("a").alias("key")).union(joined.select(F.col("b").alias("key"))).distinct())
    classes = connected_components(ends, joined)
    least = (
        classes.join(nodes.select(F.col("node").alias("key"), "first"), "key")
        .groupBy("component").agg(F.min("first").alias("least"))
    )
    counted = links.groupBy("node").agg(F.sum("links").alias("links"))
    known = cut(
        nodes.select("node", "first", "copies")
        .join(counted, "node", "left")
        .join(classes.join(least, "component").select(F.col("key").alias("node"), "least"), "node", "left")
        .select(
            F.col("node").alias("_node"),
            F.coalesce("least", "first").alias("least"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
        .where("n_links > 0")
    )
    # both sides are shuffled for this join alone, so a set that a third of all
    # rows have is a partition that adaptive execution can split
    alone = F.col("_node").isNull()
    rows = [] if row_col is None else [
        F.col("row").alias(row_col), F.when(alone, F.col("row")).otherwise(F.col("least.row")).alias("class_row"),
    ]
    return sketches.select("row", "id", "node").join(known.hint("merge"), F.col("node") == F.col("_node"), "left").select(
        F.col("id").alias(id_col),
        F.when(alone, F.col("id")).otherwise(F.col("least.id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
        *rows,
    )
