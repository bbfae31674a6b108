"""Document fingerprints by one-permutation MinHash.

Only DataFrame functions run here. Each five-word shingle of a text is hashed
once; the hash's first byte is its bin and the least hash of a bin is the bin's
value. Bins without a shingle are filled by optimal densification: each has
its own fixed order of all other bins and takes the value of the first that is
not empty. Of every bin's value only four bits are kept, mixed with the bin's
number, packed into sixteen whole numbers. Two fingerprints agree by chance in
one bin of sixteen, which the likeness takes off.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbstone.llm.exact import ascii_lower
from kerbstone.plans.cut import cut

#: Words of a shingle.
SHINGLE = 5
#: Bins, as many as a byte has values, and bits kept of each.
BINS, BITS = 256, 4
#: Bins in a packed number.
PACKED = 64 // BITS
#: Orders are followed so many bins far before what is still empty is looked up from the other side.
PROBES = 4
#: Stretches of ids in which the next document is looked for, for each shuffle
#: partition, and at most: their number bounds what the driver sees.
STRETCHES, MOST_STRETCHES = 4, 4096

# Fixed value: what words are made of, after A-Z were lower-cased: a-z, 0-9 and all beyond ASCII.
WORDS = r"[0-9a-z\x{80}-\x{10FFFF}]+"
LOW = (1 << 56) - 1  # a hash without its bin; all ones mark an empty bin
LEAST = -(1 << 63)


def probe_order(bin_: int) -> tuple[int, int]:
    """``(start, stride)``: a bin's order of all bins, ``start + a * stride`` modulo their number.

    Both come from a multiplicative hash of the bin; strides are odd, so every bin is met once.
    """
    mixed = (bin_ + 1) * 0x9E3779B97F4A7C15 % (1 << 64)
    mixed = (mixed ^ mixed >> 29) * 0xBF58476D1CE4E5B9 % (1 << 64)
    return mixed >> 56, (mixed >> 40) % BINS | 1


def _array(values: list[int], kind: str = "int") -> Column:
    return F.array(*[F.lit(v).cast(kind) for v in values])


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with ``name``: the packed fingerprint of column ``text``, sixteen whole numbers.

    A text of fewer than five words has one shingle of those, one without words
    has its whole text as a shingle, so no text is without. A null text is an
    empty one. A very long text is held once as a list of its words.
    """
    size = BINS
    order = [probe_order(i) for i in range(size)]
    starts, strides = (_array([o[at] for o in order]) for at in (0, 1))
    inverse = _array([pow(o[1], -1, size) for o in order])
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    kept = [F.col(f"`{c}`") for c in df.columns if c != name]

    def stage(df: DataFrame, column: Column) -> DataFrame:
        # An array that lambdas look into is a column of its own and is named more than
        # once where it is used: else the optimizer puts its making inside the lambda.
        return df.select(*kept, column.alias("_fp"))

    step = stage(df, F.regexp_extract_all(ascii_lower(value), F.lit(WORDS), F.lit(0)))
    words = F.col("_fp")
    shingle = lambda i: F.xxhash64(*[F.get(words, i + n) for n in range(SHINGLE)])
    step = stage(step, F.when(F.size(words) == 0, F.array(F.xxhash64(value)))
                 .when(F.size(words) < SHINGLE, F.array(F.xxhash64(words)))
                 .otherwise(F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(words) - SHINGLE)), shingle)))
    # one mark of emptiness a bin, behind all its hashes: the first of a bin is its least, or the mark
    marks = _array([(b << 56) + LOW for b in range(-size // 2, size // 2)], "bigint")
    step = stage(step, F.sort_array(F.concat("_fp", marks)))
    bin_of = lambda h: F.shiftright(h, 56)
    step = stage(step, F.filter("_fp", lambda h, i: ~bin_of(h).eqNullSafe(bin_of(F.get("_fp", i - 1)))))
    step = stage(step, F.transform("_fp", lambda h: F.when(h.bitwiseAND(F.lit(LOW)) != LOW, h)))
    kept.append(F.col("_fp").alias("_own"))
    step = stage(step, F.col("_fp"))
    own = F.col("_own")
    for a in range(PROBES):
        probes = _array([(s + a * t) % size for s, t in order])
        step = stage(step, F.transform("_fp", lambda h, i: F.coalesce(h, F.get(own, F.get(probes, i)))))
        kept[-1] = own
    # from the other side: how far along its order an empty bin meets each full one
    kept.append(F.filter(F.sequence(F.lit(0), F.lit(size - 1)), lambda j: F.get(own, j).isNotNull()).alias("_full"))
    step = stage(step, F.col("_fp"))
    kept[-1] = F.col("_full")

    def nearest(i: Column) -> Column:
        far = F.array_min(F.transform("_full", lambda j: F.pmod((j - F.get(starts, i)) * F.get(inverse, i), F.lit(size))))
        there = F.pmod(F.get(starts, i) + far * F.get(strides, i), F.lit(size))
        return F.when(F.size("_full") > 0, F.get(own, there))

    bits = F.lit((1 << BITS) - 1).cast("bigint")
    step = stage(step, F.transform("_fp", lambda h, i: F.xxhash64(F.coalesce(h, nearest(i)), i).bitwiseAND(bits)))
    packed = F.transform(F.sequence(F.lit(0), F.floor(F.size("_fp") / PACKED).cast("int") - 1), lambda n: F.aggregate(
        F.slice("_fp", n * PACKED + 1, PACKED), F.lit(0).cast("bigint"),
        lambda all_, x: F.shiftleft(all_, BITS).bitwiseOR(x)))
    return step.select(*kept[:-2], packed.alias(name))


def shown(packed: Column) -> Column:
    """A packed fingerprint as hexadecimal digits, one for each bin."""
    return F.array_join(F.transform(packed, lambda x: F.lpad(F.lower(F.hex(x)), PACKED, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """The estimated share of common shingles, 0 to 1, of two packed fingerprints."""

    def differing(x: Column, y: Column) -> Column:
        d = x.bitwiseXOR(y)
        d = d.bitwiseOR(F.shiftrightunsigned(d, 1))
        d = d.bitwiseOR(F.shiftrightunsigned(d, 2))
        return F.bit_count(d.bitwiseAND(F.lit(0x1111111111111111)))

    unequal = F.aggregate(F.zip_with(a, b, differing), F.lit(0), lambda s, x: s + x)
    chance = 1 / (1 << BITS)
    return F.greatest(F.lit(0.0), (1 - unequal / F.lit(BINS) - chance) / (1 - chance))


def _stretches(ids: DataFrame, number: int) -> tuple[Column, int]:
    """Which stretch of the order by ``_id`` and ``_tie`` a row is in, and how many there are.

    Stretches come from the ids' quantiles. An id that holds several of them has
    as many stretches of its own, which go by the tie.
    """
    cuts = ids.select(F.percentile_approx("_id", [i / number for i in range(1, number)], 10_000)).first()[0] or []
    held = {e: cuts.count(e) for e in set(cuts)}
    edges = sorted({LEAST, *held, *(e + 1 for e, n in held.items() if n > 1)})
    parts = [held[e] if held.get(e, 0) > 1 else 1 for e in edges]
    first = [sum(parts[:i]) for i in range(len(parts))]
    # found in two steps, so a row looks at few edges
    width = max(1, int(len(edges) ** 0.5))
    groups = [edges[i:i + width] for i in range(0, len(edges), width)]
    until = lambda of: F.size(F.filter(of, lambda e: e <= F.col("_id"))) - 1
    group = until(_array([g[0] for g in groups], "bigint"))
    at = group * width + until(F.get(F.array(*[_array(g, "bigint") for g in groups]), group))
    share = F.floor((F.col("_tie") / F.lit(2.0 ** 64) + 0.5) * F.get(_array(parts), at))
    return F.get(_array(first), at) + F.least(share, F.get(_array(parts), at) - 1), sum(parts)


def with_next(docs: DataFrame, prepared: Callable[[DataFrame], DataFrame], carried: list[str]) -> DataFrame:
    """``prepared(docs)`` with ``_next``: a struct of ``carried`` of the next row.

    ``docs`` has ``_id, _tie`` and more. Rows are in the order of ``_id`` and ``_tie``; after the last comes the first. They
    are shuffled once, by stretches of that order; only the first row of each
    stretch is sent to the end of the one before.
    """
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    number = min(MOST_STRETCHES, max(2, STRETCHES * partitions))
    where, _ = _stretches(docs.select("_id"), number)
    placed = docs.withColumn("_stretch", where)
    # one narrow row of each stretch: at most as many as there are stretches
    firsts = (
        placed.select("_stretch", "_id", "_tie").groupBy("_stretch", "_id").agg(F.min("_tie").alias("_tie"))
        .groupBy("_stretch").agg(F.min(F.struct("_id", "_tie")).alias("f")).select("_stretch", "f.*")
        .orderBy("_stretch").collect()
    )
    links = [(firsts[i - 1]["_stretch"], f["_id"], f["_tie"]) for i, f in enumerate(firsts)]
    asked = docs.sparkSession.createDataFrame(links, "_before int, _id bigint, _tie bigint")
    heads = cut(docs.join(F.broadcast(asked), ["_id", "_tie"]).dropDuplicates(["_before"]))
    heads = prepared(heads).select("_before", F.struct(*carried).alias("_head"))
    order = Window.partitionBy("_stretch").orderBy("_id", "_tie")
    ahead = prepared(placed).withColumn("_ahead", F.lead(F.struct(*carried)).over(order))
    return ahead.join(heads, (F.col("_stretch") == F.col("_before")) & F.col("_ahead").isNull(), "left").select(
        *[c for c in ahead.columns if c not in ("_stretch", "_ahead")], F.coalesce("_ahead", "_head").alias("_next"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its fingerprint and that of an edited text.

    ``id_col, n_chars, edited, fingerprint, edited_fingerprint, next_fingerprint``;
    the fingerprints are packed. In ``edited`` the last quarter of the code points
    (rounded down) is replaced by as many of the next document's first, or all.
    Ids are whole numbers; null ids come first, rows of one id go by a hash of
    their texts, and after the last document comes the first, which a single
    one is itself. Null texts are empty. Equal texts have equal
    fingerprints. Other columns are not read; an empty table gives no rows.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    source = docs.select(
        F.col(f"`{id_col}`").alias("_key"), text.alias("_text"),
        F.coalesce(F.col(f"`{id_col}`").cast("bigint"), F.lit(LEAST)).alias("_id"), F.xxhash64(text).alias("_tie"))
    found = with_next(source, lambda df: with_fingerprint(df, "_text", "_print"), ["_text", "_print"])
    n_chars = F.char_length("_text")
    taken = F.floor(n_chars / 4).cast("int")
    edited = found.select(
        "_key", n_chars.cast("bigint").alias("n_chars"), "_print", F.col("_next._print").alias("_follows"),
        F.concat(F.substring("_text", F.lit(1), n_chars - taken), F.substring("_next._text", F.lit(1), taken)).alias("edited"))
    return with_fingerprint(edited, "edited", "_edited").select(
        F.col("_key").alias(id_col), "n_chars", "edited", F.col("_print").alias("fingerprint"),
        F.col("_edited").alias("edited_fingerprint"), F.col("_follows").alias("next_fingerprint"))
