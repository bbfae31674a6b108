r"""Chat formatting in budgeted windows.

Only DataFrame functions run here. The turns of a conversation are packed into
windows of a token budget: running sums of the turns' tokens choose spans that
begin and end with a turn. Each window repeats the system turn and a limited
piece of the history, and only its own assistant turns are trained on.

Where a window ends depends on the turn that opens it and on few turns around that,
never on earlier windows. So a long conversation is cut into pieces of turns,
each with a margin of its neighbours' turns. A piece is then a table: entered at this
turn, it is left at that turn of the next piece. Tables are composed up a tree and
the entered turns handed down it, and each piece makes its own windows. The
windows are those of the whole conversation, wherever pieces begin.

A turn is written ``<s>role<|>text</s>``. Control strings inside a text get a
backslash after their first character; those that have backslashes there get
one more, and unescaping takes one away.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbstone.plans.cut import cut
from kerbstone.plans.order import grouped_index

#: Tokens of a window, at most, unless a single turn needs more.
BUDGET = 512
#: Tokens of repeated history in a window, at most.
HISTORY = 128
#: Characters that count as one token, and tokens that a turn's frame counts as.
CHARS_PER_TOKEN, FRAME_TOKENS = 4, 3
#: Turns of a piece, at least; no row ever holds more of a conversation, and a margin.
SEGMENT = 1024
#: Pieces, or tables of pieces, that are composed at once.
FANOUT = 64

SYSTEM, ASSISTANT = "system", "assistant"
# The template's control strings, and what follows the first
# character of these and of other strings that models read as control.
OPEN, MIDDLE, CLOSE = "<s>", "<|>", "</s>"
BODIES = r"(?:/?s>|\|>|/?INST\]|/?SYS\])"


def escape(text: Column) -> Column:
    """``text`` without control strings; :func:`unescape` gives it back."""
    return F.regexp_replace(text, rf"(?<=[<\[])(?=\\*{BODIES})", r"\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?<=[<\[])\\(?=\\*{BODIES})", "")


def tokens(text: Column) -> Column:
    """A turn's tokens, estimated from its characters."""
    return (F.ceil(F.char_length(text) / CHARS_PER_TOKEN) + FRAME_TOKENS).cast("bigint")


def _reach(turns: Column, turn: Column, fixed: Column, budget: int, history: int) -> Column:
    """The turns before ``turn`` that a window beginning with it repeats, in order."""
    before = turn["past"] - turn["tokens"]
    room = F.greatest(
        F.lit(0), F.least(F.lit(history), F.lit(budget) - fixed - turn["tokens"])
    )
    margin = _margins(budget, history)[0]
    near = F.slice(turns, F.greatest(F.lit(1), turn["at"] - margin), F.least(F.lit(margin), turn["at"] - 1))
    return F.filter(near, lambda t: ~t["is_system"] & (before - t["past"] + t["tokens"] <= room))


def _margins(budget: int, history: int) -> tuple[int, int]:
    """How many turns back a window repeats, and how many on it reaches, at most."""
    return history // FRAME_TOKENS + 1, budget // FRAME_TOKENS + 2


def _pieces(rows: DataFrame, size: int, before: int, after: int) -> DataFrame:
    """``conv, segment, turns, first, n``: each piece's turns with its margins; ``first`` is its own first one's place."""
    at = F.col("pos") - 1
    home = F.floor(at / size)
    offset = at - home * size
    homes = F.array_compact(F.array(
        home, F.when((offset < after) & (home > 0), home - 1), F.when(offset >= size - before, home + 1)))
    dealt = rows.withColumns({"home": home, "segment": F.explode(homes)})
    order = Window.partitionBy("conv", "segment").orderBy("pos")
    return (
        dealt.select(
            "*",
            F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("past"),
            F.row_number().over(order).alias("at"),
        )
        .groupBy("conv", "segment")
        .agg(
            F.array_sort(F.collect_list(F.struct("at", "past", "pos", "role", "head", "text", "tokens"))).alias("turns"),
            F.min(F.when(F.col("home") == F.col("segment"), F.col("at"))).alias("first"),
            F.count_if(F.col("home") == F.col("segment")).cast("int").alias("n"),
        )
        .where("n > 0")
    )


def _entries(pieces: DataFrame, limit, after: int, fanout: int) -> DataFrame:
    """``conv, segment, entry``: which of its turns, from 0, opens each piece's first window."""
    limits = F.transform(F.slice("turns", F.col("first"), F.col("n")), limit)
    with_limits = pieces.withColumn("limits", limits)

    def following(most: Column, i: Column) -> Column:
        ahead = F.slice("turns", F.col("first") + i + 1, after)
        return i + 1 + F.size(F.filter(ahead, lambda t: t["past"] <= most))

    with_next = with_limits.select("conv", "segment", "n", F.transform("limits", following).alias("next"))
    # from the last turn backwards: where the next piece is entered from here
    left = F.aggregate(
        F.reverse(F.sequence(F.lit(0), F.col("n") - 1)), F.array().cast("array<int>"),
        lambda later, i: F.concat(F.array(
            F.when(F.get("next", i) >= F.col("n"), F.get("next", i) - F.col("n"))
            .otherwise(F.get(later, F.get("next", i) - i - 1))), later))
    levels = [cut(with_next.select("conv", "segment", F.slice(left, 1, after).alias("table")))]

    def grouped(level: DataFrame) -> DataFrame:
        group = F.floor(F.col("segment") / fanout)
        return level.groupBy("conv", group.alias("group")).agg(
            F.array_sort(F.collect_list(F.struct("segment", "table"))).alias("all"))

    start = F.sequence(F.lit(0), F.lit(after - 1))
    while levels[-1].agg(F.max("segment")).first()[0] >= fanout:
        composed = F.aggregate("all", start, lambda whole, p: F.transform(whole, lambda x: F.get(p["table"], x)))
        levels.append(cut(grouped(levels[-1]).select("conv", F.col("group").alias("segment"), composed.alias("table"))))
    known = None
    for level in reversed(levels):
        groups = grouped(level)
        if known is None:
            groups = groups.withColumn("entry", F.lit(0))
        else:
            above = known.select(F.col("conv").alias("_conv"), F.col("segment").alias("_group"), "entry")
            groups = groups.join(
                above, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("group") == F.col("_group")))
        walked = F.aggregate(
            "all", F.array("entry"), lambda seen, p: F.concat(seen, F.array(F.get(p["table"], F.element_at(seen, -1)))))
        known = cut(
            groups.select("conv", F.posexplode("all").alias("i", "p"), walked.alias("walked"))
            .select("conv", F.col("p.segment").alias("segment"), F.get("walked", F.col("i")).alias("entry")))
    return known


def format_chats(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    budget: int = BUDGET,
    history: int = HISTORY,
    segment: int = SEGMENT,
    fanout: int = FANOUT,
) -> DataFrame:
    """One row per window: ``conv, segment, window, text, n_context, spans, n_tokens``.

    ``text`` is the formatted window, ``n_context`` how many turns at its
    front repeat earlier ones (the system turn, then history), ``spans`` the
    ``start, end`` in code points of the texts that are trained on: the window's
    own assistant turns. Every turn is some window's own exactly once. Windows
    are in the order of ``segment`` and ``window``; they do not depend on ``segment``.

    A conversation's rows are ordered by turn, then role, the text's first 256
    characters and its MD5; a null turn comes first. Null roles and texts are
    empty. The first turn is the system turn if its role says so. A turn larger
    than the budget, however long, has a window with no history. A null
    conversation is one conversation; other columns are not read; repeated rows
    are turns of their own; no rows give no windows.
    """
    before, after = _margins(budget, history)
    size = max(segment, before, after)
    role = F.coalesce(F.col(f"`{role_col}`"), F.lit(""))
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = grouped_index(
        turns.select(
            F.col(f"`{conv_col}`").alias("conv"),
            F.col(f"`{turn_col}`").alias("turn"),
            role.alias("role"),
            F.substring(text, 1, 256).alias("begins"),
            F.md5(text.cast("binary")).alias("md5"),
            F.concat(F.lit(OPEN), escape(role), F.lit(MIDDLE)).alias("head"),
            escape(text).alias("text"),
            tokens(escape(text)).alias("tokens"),
        ),
        "conv", [F.col("turn").asc_nulls_first(), F.col("role"), F.col("begins"), F.col("md5")], "pos",
    ).select("conv", "pos", "role", "head", "text", "tokens")
    # what every later window of a conversation repeats, if it is a system turn
    system = rows.where((F.col("pos") == 1) & (F.col("role") == SYSTEM)).select(
        F.col("conv").alias("_conv"), F.struct("role", "head", "text", "tokens").alias("system"))
    pieces = (
        _pieces(rows, size, before, after)
        .join(system, F.col("conv").eqNullSafe(F.col("_conv")), "left")
        .withColumn("turns", F.transform("turns", lambda t: t.withField(
            "is_system", (t["pos"] == 1) & F.col("system").isNotNull())))
        .withColumn("fixed", F.coalesce("system.tokens", F.lit(0).cast("bigint")))
        .drop("_conv")
    )

    def limit(turn: Column) -> Column:
        """The running sum up to which turns belong to a window that this turn opens."""
        repeated = F.aggregate(
            _reach(F.col("turns"), turn, F.col("fixed"), budget, history),
            F.lit(0).cast("bigint"), lambda s, t: s + t["tokens"],
        )
        own = F.when(turn["pos"] == 1, F.lit(budget)).otherwise(F.lit(budget) - F.col("fixed") - repeated)
        return F.greatest(turn["past"], turn["past"] - turn["tokens"] + own).cast("bigint")

    long = rows.where(F.col("pos") == size + 1).select(F.col("conv").alias("_conv"))
    if long.isEmpty():
        entered = pieces.withColumn("entry", F.lit(0))
    else:
        of_long = pieces.join(long, F.col("conv").eqNullSafe(F.col("_conv")), "left_semi")
        known = _entries(of_long, limit, after, fanout).select(
            F.col("conv").alias("_conv"), F.col("segment").alias("_segment"), F.col("entry").alias("_entry"))
        entered = pieces.join(
            known, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("segment") == F.col("_segment")), "left",
        ).withColumn("entry", F.when(F.col("_segment").isNull(), F.lit(0)).otherwise(F.col("_entry")))

    def opened(state: Column, turn: Column) -> Column:
        # running sums decide: a turn that ends beyond the window's limit opens the next
        opens = turn["past"] > state["limit"]
        window = F.struct(turn["at"].alias("first"), limit(turn).alias("limit"))
        return F.struct(
            F.when(opens, F.concat(state["windows"], F.array(window))).otherwise(state["windows"]).alias("windows"),
            F.when(opens, limit(turn)).otherwise(state["limit"]).alias("limit"),
        )

    entry = F.get(F.slice("turns", F.col("first"), F.col("n")), F.col("entry"))
    start = F.struct(
        F.array().cast("array<struct<first:int,limit:bigint>>").alias("windows"),
        # a piece that earlier windows cover opens none
        F.coalesce(entry["past"] - entry["tokens"], F.lit((1 << 63) - 1)).alias("limit"))
    placed = entered.withColumn(
        "windows", F.aggregate(F.slice("turns", F.col("first"), F.col("n")), start, opened)["windows"]
    ).select(
        "conv", "segment", "turns", "system", "fixed", F.posexplode("windows").alias("window", "w"),
    )
    own = F.filter(F.slice("turns", F.col("w.first"), after), lambda t: t["past"] <= F.col("w.limit"))
    plain = lambda t, is_own: F.struct(
        t["role"].alias("role"), t["head"].alias("head"), t["text"].alias("text"),
        t["tokens"].alias("tokens"), F.lit(is_own).alias("own"))
    opening_turn = F.element_at("turns", F.col("w.first"))
    nothing = F.expr("slice(array(struct('' AS role, '' AS head, '' AS text, 0L AS tokens, false AS own)), 1, 0)")
    repeats = F.when(opening_turn["pos"] == 1, nothing).otherwise(F.concat(
        F.when(F.col("system").isNull(), nothing).otherwise(F.array(plain(F.col("system"), False))),
        F.transform(_reach(F.col("turns"), opening_turn, F.col("fixed"), budget, history), lambda t: plain(t, False)),
    ))
    length = lambda t: F.char_length(t["head"]) + F.char_length(t["text"]) + len(CLOSE)
    filled = (
        placed.withColumn("repeats", repeats)
        .withColumn("items", F.concat("repeats", F.transform(own, lambda t: plain(t, True))))
    )

    def spanned(state: Column, t: Column) -> Column:
        begins = state["at"] + F.char_length(t["head"])
        span = F.struct(begins.alias("start"), (begins + F.char_length(t["text"])).alias("end"))
        learnt = t["own"] & (t["role"] == ASSISTANT)
        return F.struct(
            F.when(learnt, F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"),
            (state["at"] + length(t)).alias("at"),
        )

    nowhere = F.struct(
        F.array().cast("array<struct<start:int,end:int>>").alias("spans"), F.lit(0).alias("at")
    )
    return filled.select(
        F.col("conv").alias(conv_col),
        "segment",
        "window",
        F.array_join(F.transform("items", lambda t: F.concat(t["head"], t["text"], F.lit(CLOSE))), "").alias("text"),
        F.size("repeats").alias("n_context"),
        F.aggregate("items", nowhere, spanned)["spans"].alias("spans"),
        F.aggregate("items", F.lit(0).cast("bigint"), lambda s, t: s + t["tokens"]).alias("n_tokens"),
    )


def read_turns(windows: DataFrame) -> DataFrame:
    """``windows`` with ``turns``, their own turns read back as ``role, text``, and ``learnt``.

    ``learnt`` has the texts under the loss mask, unescaped, in order.
    """
    written = F.split("text", CLOSE)
    own = F.slice(written, F.col("n_context") + 1, F.size(written) - 1 - F.col("n_context"))

    def parsed(turn: Column) -> Column:
        middle = F.locate(MIDDLE, turn)
        return F.struct(
            unescape(F.substring(turn, F.lit(len(OPEN) + 1), middle - len(OPEN) - 1)).alias("role"),
            unescape(F.substring(turn, middle + len(MIDDLE), F.char_length(turn))).alias("text"),
        )

    return windows.withColumns({
        "turns": F.transform(own, parsed),
        "learnt": F.transform("spans", lambda s: unescape(
            F.substring(F.col("text"), s["start"] + 1, s["end"] - s["start"]))),
    })
