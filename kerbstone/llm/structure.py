"""Repair of the order of roles in conversations, by a grammar-compressed dynamic program.

A turn is a symbol: the initial of its role and its first fault. The sequences
of symbols are compressed by Re-Pair: the most frequent adjacent pair becomes a
symbol of its own, again and again, counted over all conversations at once. A
min-plus matrix tells for a symbol what it costs at least to come from one
state of the wanted order to another, and how. The matrix of a rule is the
product of its two symbols' matrices, so each rule is worked out once, bottom-up,
for all conversations that hold it. Which way is cheapest is kept as a rope: a
product notes the state in the middle, and its parts know the rest.

Two ways through the same turns never have one audit string as the beginning of
the other, because an insertion belongs to the turn after it and each turn
writes one letter last. So it is enough to keep the rank of a string among the
sixteen of its matrix, and a product's ranks follow from those of its parts.

A long conversation is cut into pieces of ``SEGMENT`` turns. Their matrices are
multiplied in a tree, and the chosen states are handed down the same tree, so
no task and no row ever holds a whole conversation.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from kerbstone.llm.batches import send_less
from kerbstone.plans.cut import cut
from kerbstone.plans.order import grouped_index
from kerbstone.plans.skew import lookup_join, spread
from kerbstone.session import ship

#: Turns of a piece.
SEGMENT = 1024
#: Pieces, or products of pieces, that are multiplied at once.
FANOUT = 64
#: Passes over the distinct sequences in which pairs are counted, and pairs that
#: become symbols in one pass, at most. What is left uncompressed is multiplied
#: symbol by symbol: these bound the work spent on sharing, not the result.
ROUNDS, PAIRS = 12, 64
#: Characters of a transcript's chunk, about.
CHUNK_CHARS = 1 << 18

# What counts as white in a text, the edits' letters and costs.
WHITE = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COSTS = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
TRUNCATED_COST = 5
# The symbols of turns: role s, u, a or another, by fault.
ROLES = "suao"
CLEAN, TRUNCATED, BLANK, DUPLICATE = "suao", "SUAO", "1234", "5678"
#: Blank and duplicate turns must go, whatever their role: one symbol.
GONE = "d"

# States of the wanted order (s?(ua)+)?: nothing yet, after s, after u, after a.
STATES = 4
EMITS = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
NAMES = {"u": "user", "a": "assistant"}
#: Insertions after the last turn, by the state it leaves.
TAILS = ("", INSERT * 2, INSERT, "")
NEVER = 1 << 60


class Transfer(NamedTuple):
    """Sixteen ways, from state ``i`` to ``j`` at ``4 * i + j``: least cost, rank, and how.

    ``parts`` are the two factors, with the states between them in ``via``; a
    turn has none, but the letters themselves.
    """

    cost: tuple[int, ...]
    rank: tuple[int, ...]
    via: tuple[int, ...] = ()
    parts: tuple = ()
    letters: tuple[str, ...] = ()


def ranked(keys: list) -> tuple[int, ...]:
    places = {key: at for at, key in enumerate(sorted({k for k in keys if k is not None}))}
    return tuple(-1 if k is None else places[k] for k in keys)


@functools.lru_cache(maxsize=64)
def turn_transfer(symbol: str) -> Transfer:
    """The matrix of one turn, insertions before it included."""
    gone = symbol == GONE
    role, base = symbol.lower(), TRUNCATED_COST if symbol in TRUNCATED else 0

    def moves(state: int) -> Iterator[tuple[int, int, str]]:
        yield state, COSTS[DELETE], DELETE
        if gone:
            return
        for emitted, step in EMITS.items():
            if state in step and emitted == role:
                yield step[state], base + COSTS[KEEP], KEEP
            elif state in step and emitted in NAMES:
                yield step[state], base + COSTS[REROLE], REROLE

    best = {}
    for start in range(STATES):
        # at most two insertions: a third comes back to a state met before
        ways = [(start, 0, "")]
        for state, cost, letters in ways:
            for to, more, letter in moves(state):
                way = (cost + more, letters + letter)
                best[start, to] = min(best.get((start, to), way), way)
            if len(letters) < 2:
                ways += [(EMITS[r][state], cost + COSTS[INSERT], letters + INSERT)
                         for r in NAMES if state in EMITS[r]]
    every = [best.get((i, j)) for i in range(STATES) for j in range(STATES)]
    return Transfer(
        cost=tuple(NEVER if w is None else w[0] for w in every),
        rank=ranked([None if w is None else w[1] for w in every]),
        letters=tuple("" if w is None else w[1] for w in every),
    )


def product(left: Transfer, right: Transfer) -> Transfer:
    """The min-plus product; of equal costs the way with the least letters."""
    cost, keys, via = [], [], []
    for i in range(STATES):
        for j in range(STATES):
            ways = [
                (left.cost[4 * i + k] + right.cost[4 * k + j], left.rank[4 * i + k], right.rank[4 * k + j], k)
                for k in range(STATES)
                if left.cost[4 * i + k] < NEVER and right.cost[4 * k + j] < NEVER
            ]
            best = min(ways, default=None)
            cost.append(best[0] if best else NEVER)
            keys.append(best[1:3] if best else None)
            via.append(best[3] if best else -1)
    return Transfer(tuple(cost), ranked(keys), tuple(via), (left, right))


def letters(node: Transfer, i: int, j: int) -> str:
    """The rope from state ``i`` to ``j``, written out."""
    out, stack = [], [(node, i, j)]
    while stack:
        node, i, j = stack.pop()
        if node.parts:
            k = node.via[4 * i + j]
            stack += [(node.parts[1], k, j), (node.parts[0], i, k)]
        else:
            out.append(node.letters[4 * i + j])
    return "".join(out)


def last_state(whole: Transfer) -> int:
    """Where the cheapest way through a whole conversation ends before its tail."""
    return min(
        (whole.cost[j] + COSTS[INSERT] * len(TAILS[j]), whole.rank[j], TAILS[j], j)
        for j in range(STATES) if whole.cost[j] < NEVER
    )[3]


class Grammar:
    """Re-Pair rules ``(symbol, pair)`` in the order they were made, and their matrices."""

    def __init__(self, rules: list[tuple[str, str]]):
        self.rules = rules
        self._made: dict[str, Transfer] = {}
        self._known: dict[str, Transfer] = {}

    def __reduce__(self):
        return Grammar, (self.rules,)

    def of_symbol(self, symbol: str) -> Transfer:
        if not self._made:
            for made, pair in self.rules:  # bottom-up: a pair's symbols come before it
                parts = [self._made.get(s) or turn_transfer(s) for s in pair]
                self._made[made] = product(*parts)
        return self._made.get(symbol) or turn_transfer(symbol)

    def transfer(self, raw: str) -> Transfer:
        """The matrix of a piece; the last few thousand different pieces are remembered."""
        plain = raw.translate(PLAIN)
        if plain not in self._known:
            if len(self._known) >= 4096:
                self._known.clear()
            short = plain
            for made, pair in self.rules:
                short = short.replace(pair, made)
            self._known[plain] = functools.reduce(product, map(self.of_symbol, short))
        return self._known[plain]


PLAIN = str.maketrans(BLANK + DUPLICATE, GONE * 8)


def learn_grammar(pieces: DataFrame, rounds: int = ROUNDS, pairs: int = PAIRS) -> Grammar:
    """Re-Pair over all distinct values of ``raw``.

    A pass counts every adjacent pair and takes the most frequent ones that
    share no symbol, as replacing one then does not change the others' counts.
    """
    plain = F.translate("raw", BLANK + DUPLICATE, GONE * 8).alias("plain")
    distinct = cut(pieces.select(plain).distinct())
    rules: list[tuple[str, str]] = []
    for _ in range(rounds):
        short = F.col("plain")
        for made, pair in rules:
            short = F.replace(short, F.lit(pair), F.lit(made))
        found = (
            distinct.select(F.explode(F.regexp_extract_all(short, F.lit("(?s)(?=(..))"), F.lit(1))).alias("pair"))
            .groupBy("pair").count().where("count >= 2")
            .orderBy(F.desc("count"), "pair").limit(pairs).collect()
        )
        if not found:
            break
        used: set[str] = set()
        for row in found:
            if not used & set(row["pair"]):
                used |= set(row["pair"])
                rules.append((chr(0x4E00 + len(rules)), row["pair"]))
    return Grammar(rules)


def damage(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
           role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv, turn, role, text`` with faults planted by a checksum of conversation and turn.

    A null counts as one space: in the checksum's text as well as role and text.
    """
    conv, turn = F.col(f"`{conv_col}`"), F.col(f"`{turn_col}`")
    blank = lambda c: F.coalesce(c.cast("string"), F.lit(" "))
    case = F.crc32(F.concat(blank(conv), F.lit(":"), blank(turn))) % 20
    role, text = blank(F.col(f"`{role_col}`")), blank(F.col(f"`{text_col}`"))
    return turns.select(
        conv.alias("conv"), turn.alias("turn"), case.alias("case"), role.alias("role"), text.alias("text")
    ).where("case <> 0").select(
        "conv", "turn",
        F.when(F.col("case") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("case") == 1, "").when(F.col("case") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("case") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    ).drop("_copy")


def numbered_turns(turns: DataFrame) -> DataFrame:
    """``conv, turn, role, text, kind, fault, same, pos``: the rows in order, from 1 in a conversation.

    The order is by turn, nulls first, then role and the text's MD5.
    """
    trimmed = F.rtrim("text", F.lit(WHITE))
    initial = F.substring("role", 1, 1)
    rows = turns.select(
        "conv", "turn", "role", "text",
        F.md5(F.col("text").cast("binary")).alias("_md5"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("kind"),
        F.when(trimmed == "", "blank").when(~F.substring(trimmed, -1, 1).isin(".", "!", "?"), "truncated")
        .otherwise("").alias("fault"),
        # a turn and all that repeat it
        F.unhex(F.sha2(F.concat(
            F.coalesce(F.concat(F.lit("="), F.col("conv").cast("string")), F.lit("-")), F.lit(":"),
            F.char_length("role").cast("string"), F.lit(":"), "role", "text"), 256)).alias("same"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("_md5")]
    return grouped_index(rows, "conv", order, "pos")


def pieces_of(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """``conv, seg, raw, before, blank, duplicate, truncated, illegal`` of each piece of a conversation.

    ``raw`` has a symbol per turn, ``before`` that of the turn before the piece.
    """
    again = cut(
        rows.where("fault <> 'blank'").groupBy("same").agg(F.min("pos").alias("first"), F.count("*").alias("n"))
        .where("n > 1").select("same", "first")
    )
    narrow = rows.select("conv", "pos", "kind", "fault", "same")
    found = lookup_join(narrow, again, "same").select(
        "conv", "pos", "kind",
        F.when((F.col("fault") != "blank") & (F.col("pos") > F.col("first")), "duplicate")
        .otherwise(F.col("fault")).alias("fault"),
    )
    symbol = F.lit(None).cast("string")
    for fault, names in (("", CLEAN), ("truncated", TRUNCATED), ("blank", BLANK), ("duplicate", DUPLICATE)):
        symbol = F.when(F.col("fault") == fault, F.translate("kind", ROLES, names)).otherwise(symbol)
    one = found.select("conv", "pos", symbol.alias("symbol"), F.floor((F.col("pos") - 1) / segment).alias("seg"))
    both = one.select("conv", "seg", "pos", "symbol", F.lit(1).alias("own")).union(
        one.where(F.col("pos") % segment == 0).select("conv", F.col("seg") + 1, "pos", "symbol", F.lit(0)))
    grouped = both.groupBy("conv", "seg").agg(
        F.array_sort(F.collect_list(F.struct("pos", "symbol", "own"))).alias("all"), F.sum("own").alias("n")
    ).where("n > 0")

    def joined(own: int) -> Column:
        return F.array_join(F.filter("all", lambda s: s["own"] == own)["symbol"], "")

    kinds = F.translate(F.concat("before", "raw"), TRUNCATED + BLANK + DUPLICATE, ROLES * 3)
    met = F.regexp_extract_all(kinds, F.lit("(?s)(?=(..))"), F.lit(1))
    count = lambda names: F.regexp_count("raw", F.lit(f"[{names}]")).cast("bigint")
    return grouped.select("conv", "seg", joined(1).alias("raw"), joined(0).alias("before")).select(
        "conv", "seg", "raw",
        count(BLANK).alias("blank"), count(DUPLICATE).alias("duplicate"), count(TRUNCATED).alias("truncated"),
        F.size(F.filter(met, lambda p: ~p.isin("su", "ua", "au"))).cast("bigint").alias("illegal"),
    )


def _matrix_schema(keys: list[T.StructField]) -> T.StructType:
    numbers = T.ArrayType(T.LongType())
    return T.StructType([*keys, T.StructField("cost", numbers), T.StructField("rank", numbers)])


def _in_order(table: pa.Table) -> list[dict]:
    return sorted(table.to_pylist(), key=lambda row: row["seg"])


def states_of_pieces(pieces: DataFrame, grammar: Grammar, fanout: int = FANOUT) -> DataFrame:
    """``conv, seg, i, j``: the states that each piece of a long conversation goes between.

    Matrices are multiplied up a tree of ``fanout`` and the states are handed
    down it, so a group has ``fanout`` small rows at most.
    """
    keys = [pieces.schema["conv"], T.StructField("seg", T.LongType())]
    matrices = _matrix_schema(keys)
    arrow = to_arrow_schema(matrices)

    def of_piece(batches):
        for batch in batches:
            found = [grammar.transfer(raw) for raw in batch.column("raw").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), batch.column("seg"),
                 pa.array([f.cost for f in found], arrow.field("cost").type),
                 pa.array([f.rank for f in found], arrow.field("rank").type)], schema=arrow)

    def multiplied(table: pa.Table) -> pa.Table:
        rows = _in_order(table)
        whole = functools.reduce(product, [Transfer(tuple(r["cost"]), tuple(r["rank"])) for r in rows])
        return pa.Table.from_pylist(
            [{"conv": rows[0]["conv"], "seg": rows[0]["seg"] // fanout, "cost": whole.cost, "rank": whole.rank}], arrow)

    chosen = T.StructType([*keys, T.StructField("i", T.LongType()), T.StructField("j", T.LongType())])
    chosen_arrow = to_arrow_schema(chosen)

    def handed_down(table: pa.Table) -> pa.Table:
        rows = _in_order(table)
        products = [Transfer(tuple(rows[0]["cost"]), tuple(rows[0]["rank"]))]
        for r in rows[1:]:
            products.append(product(products[-1], Transfer(tuple(r["cost"]), tuple(r["rank"]))))
        start, state = rows[0]["i"], rows[0]["j"]
        if start is None:
            start, state = 0, last_state(products[-1])
        out = []
        for at in range(len(rows) - 1, -1, -1):
            before = products[at].via[4 * start + state] if at else start
            out.append({"conv": rows[at]["conv"], "seg": rows[at]["seg"], "i": before, "j": state})
            state = before
        return pa.Table.from_pylist(out, chosen_arrow)

    bare = pieces.select("conv", F.col("seg").cast("bigint").alias("seg"), "raw")
    levels = [cut(bare.mapInArrow(of_piece, matrices))]
    group = F.floor(F.col("seg") / fanout).alias("group")
    while levels[-1].agg(F.max("seg")).first()[0] >= fanout:
        levels.append(cut(
            levels[-1].groupBy("conv", group).applyInArrow(lambda t: multiplied(t), matrices)))
    states = None
    for level in reversed(levels):
        rows = level.select("*", group)
        if states is None:
            rows = rows.select("*", F.lit(None).cast("bigint").alias("i"), F.lit(None).cast("bigint").alias("j"))
        else:
            above = states.select(F.col("conv").alias("_conv"), F.col("seg").alias("_seg"), "i", "j")
            rows = rows.join(above, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("group") == F.col("_seg"))).drop(
                "_conv", "_seg")
        states = cut(rows.groupBy("conv", "group").applyInArrow(lambda t: handed_down(t), chosen))
    return states


def edited_turns(rows: DataFrame, pieces: DataFrame, states: DataFrame | None, grammar: Grammar,
                 segment: int = SEGMENT) -> DataFrame:
    """``conv, pos, sub, edit, cost, role, text``: every turn with its edit, and those put in.

    A deleted turn stays as a row with edit ``D``. The pieces of a conversation
    are dealt out; each is in order in its task, which reads it as a stream and
    holds one piece's symbols, and texts batch by batch.
    """
    ship(rows.sparkSession)
    send_less(rows.sparkSession)
    last = pieces.groupBy("conv").agg(F.max("seg").alias("_last")).select(F.col("conv").alias("_conv"), "_last")
    plans = pieces.join(last, F.col("conv").eqNullSafe(F.col("_conv"))).drop("_conv")
    if states is None:
        plans = plans.withColumns({"i": F.lit(None).cast("bigint"), "j": F.lit(None).cast("bigint")})
    else:
        known = states.select(F.col("conv").alias("_conv"), F.col("seg").alias("_seg"), "i", "j")
        plans = plans.join(
            known, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("seg") == F.col("_seg")), "left")
    nothing = F.lit(None).cast("string")
    plans = plans.select(
        "conv", F.col("seg").cast("bigint").alias("seg"), F.lit(0).cast("bigint").alias("pos"), "raw", "i", "j",
        (F.col("seg") == F.col("_last")).alias("ends"), nothing.alias("role"), nothing.alias("text"))
    number = F.lit(None).cast("bigint")
    turns = rows.select(
        "conv", F.floor((F.col("pos") - 1) / segment).cast("bigint").alias("seg"), "pos", nothing.alias("raw"),
        number.alias("i"), number.alias("j"), F.lit(None).cast("boolean").alias("ends"), "role", "text")
    sent = spread(plans.union(turns), "conv", "seg").sortWithinPartitions("conv", "seg", "pos")
    schema = T.StructType([
        rows.schema["conv"], T.StructField("pos", T.LongType()), T.StructField("sub", T.IntegerType()),
        T.StructField("edit", T.StringType()), T.StructField("cost", T.LongType()),
        T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
    ])
    arrow = to_arrow_schema(schema)

    def edits(raw: str, i: int | None, j: int | None, ends: bool) -> Iterator[tuple[str, str, str, int]]:
        """Of each turn: roles put in before it, its edit, the role a rerole gives, its cost; then the tail."""
        node = grammar.transfer(raw)
        i, j = (0, last_state(node)) if i is None else (i, j)
        state, put, at = i, "", 0
        odd = {0: "u", 1: "u", 2: "a", 3: "u"}
        for letter in letters(node, i, j) + (TAILS[j] if ends else ""):
            if letter == INSERT:
                put += odd[state]
                state = EMITS[odd[state]][state]
                continue
            symbol, at = raw[at], at + 1
            role = symbol.lower() if letter == KEEP else odd[state] if letter == REROLE else ""
            if role:
                state = EMITS[role][state]
            spoilt = TRUNCATED_COST if letter != DELETE and symbol in TRUNCATED else 0
            yield put, letter, role, COSTS[letter] + spoilt
            put = ""
        if put:
            yield put, "", "", 0

    def run(batches):
        plan, left = None, None
        for batch in batches:
            out = []
            for conv, pos, raw, i, j, ends, role, text in zip(*[
                batch.column(c).to_pylist() for c in ("conv", "pos", "raw", "i", "j", "ends", "role", "text")
            ]):
                if raw is not None:
                    plan, left = edits(raw, i, j, ends), len(raw)
                    continue
                put, edit, new, cost = next(plan)
                sub = 0
                for sub, r in enumerate(put, 1):
                    out.append((conv, pos, sub - 1, INSERT, COSTS[INSERT], NAMES[r], ""))
                out.append((conv, pos, sub, edit, cost, NAMES[new] if edit == REROLE else role, text))
                left -= 1
                if left == 0:
                    for more, r in enumerate(next(plan, ("",))[0], sub + 1):
                        out.append((conv, pos, more, INSERT, COSTS[INSERT], NAMES[r], ""))
            columns = zip(*out) if out else [[] for _ in arrow]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return sent.mapInArrow(run, schema)


class Repair(NamedTuple):
    """What :func:`repair` finds: one row per conversation, and every turn with its edit."""

    conversations: DataFrame
    turns: DataFrame


def repair(turns: DataFrame, segment: int = SEGMENT, fanout: int = FANOUT) -> Repair:
    """Faults and cheapest repair of ``conv, turn, role, text``, with no nulls in role and text.

    ``conversations`` has ``conv, gaps, blank, duplicate, truncated, illegal``;
    ``turns`` is :func:`edited_turns`. Rows are taken by turn (nulls first),
    then role and the text's MD5; a turn that repeats role and text of one
    before is a duplicate unless it is blank. A null conversation is one of its
    own. Roles other than system, user and assistant can't be kept; what counts
    is their first letter, and an empty role has none. Very long texts only
    pass through; other columns are not read; an empty table gives no rows.
    """
    rows = numbered_turns(turns.select("conv", "turn", "role", "text"))
    pieces = cut(pieces_of(rows, segment))
    grammar = learn_grammar(pieces)
    long = pieces.where("seg > 0").select(F.col("conv").alias("_conv")).distinct()
    states = None
    if not long.isEmpty():
        of_long = pieces.join(long, F.col("conv").eqNullSafe(F.col("_conv")), "left_semi")
        states = states_of_pieces(of_long, grammar, fanout)
    gaps = rows.groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"))
    counts = pieces.groupBy("conv").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")])
    found = gaps.unionByName(counts, allowMissingColumns=True).groupBy("conv").agg(
        *[F.max(c).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal")])
    return Repair(found, edited_turns(rows, pieces, states, grammar, segment))


def transcripts(turns: DataFrame, most: int = CHUNK_CHARS) -> DataFrame:
    """``conv, pos, sub, cost, edits, lines, chunk``: edited turns as ``role:text`` lines, joined by newlines.

    A chunk holds lines that follow each other, and about ``most`` characters
    unless one line has more; ``lines`` is how many. In the order of ``pos``
    and ``sub`` the chunks are the conversation. Nothing is shuffled.
    """
    schema = T.StructType([
        turns.schema["conv"], T.StructField("pos", T.LongType()), T.StructField("sub", T.IntegerType()),
        T.StructField("cost", T.LongType()), T.StructField("edits", T.StringType()),
        T.StructField("lines", T.LongType()), T.StructField("chunk", T.StringType()),
    ])
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            out, at, size = [], None, 0
            for conv, pos, sub, edit, cost, role, text in zip(*[
                batch.column(c).to_pylist() for c in ("conv", "pos", "sub", "edit", "cost", "role", "text")
            ]):
                if at is None or conv != at[0] or pos - at[1] not in (0, 1) or size > most:
                    out.append([conv, pos, sub, 0, [], []])
                    size = 0
                at, chunk = (conv, pos), out[-1]
                chunk[3] += cost
                chunk[4].append(edit)
                if edit != DELETE:
                    chunk[5].append(f"{role}:{text}")
                    size += len(chunk[5][-1])
            rows = [(*c[:4], "".join(c[4]), len(c[5]), "\n".join(c[5])) for c in out]
            columns = zip(*rows) if rows else [[] for _ in arrow]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return turns.mapInArrow(run, schema)


def digests(chunks: DataFrame) -> DataFrame:
    """``conv, cost, audit, repaired_sha256`` of each conversation's transcript.

    A digest of a whole text is made from its beginning to its end, so the
    chunks of a conversation pass one task, as a stream: it holds a batch of
    them and the letters of the edits.
    """
    ship(chunks.sparkSession)
    schema = T.StructType([
        chunks.schema["conv"], T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType()),
        T.StructField("repaired_sha256", T.StringType()),
    ])
    arrow = to_arrow_schema(schema)

    def run(batches):
        conv, open_, cost, audit, digest, begun = None, False, 0, [], None, False

        def closed() -> pa.RecordBatch:
            row = {"conv": conv, "cost": cost, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}
            return pa.RecordBatch.from_pylist([row], arrow)

        for batch in batches:
            for at, *more, edits, lines, chunk in zip(*[
                batch.column(c).to_pylist() for c in ("conv", "cost", "edits", "lines", "chunk")
            ]):
                if not open_ or at != conv:
                    if open_:
                        yield closed()
                    conv, open_, cost, audit, digest, begun = at, True, 0, [], hashlib.sha256(), False
                cost += more[0]
                audit.append(edits)
                if lines:
                    digest.update(("\n" if begun else "").encode() + chunk.encode())
                    begun = True
        if open_:
            yield closed()

    return spread(chunks, "conv").sortWithinPartitions("conv", "pos", "sub").mapInArrow(run, schema)
