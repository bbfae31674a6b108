import itertools
import random
import re
import zlib

from helpers import sha, table, whole
from pyspark.sql import functions as F

from kerbstone.llm import structure

COST = {"K": 0, "R": 1, "D": 2, "I": 5}
NAMES = {"u": "user", "a": "assistant"}


def faults(rows):
    """Each row's first fault, in order."""
    seen, out = set(), []
    for _, role, text in rows:
        trimmed = text.strip(" \t\n\x0b\x0c\r")
        if not trimmed:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if trimmed[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def enumerated(rows):
    """The cheapest script, of all there are with at most three insertions."""
    found, best = faults(rows), None
    puts = [p for n in range(4) for p in itertools.product("ua", repeat=n)]
    edits = []
    for (_, role, _), fault in zip(rows, found):
        ways = [("D", "", 2)]
        if fault in ("", "truncated"):
            more = 5 * (fault == "truncated")
            ways += [("K", role[:1] or "?", more), ("R", "u", 1 + more), ("R", "a", 1 + more)]
        edits.append(ways)
    for script in itertools.product(*edits):
        for gaps in itertools.product(puts, repeat=len(rows) + 1):
            if sum(map(len, gaps)) > 3:
                continue
            roles = "".join("".join(g) + e[1] for g, e in zip(gaps, script)) + "".join(gaps[-1])
            if re.fullmatch("(s?(ua)+)?", roles):
                audit = "".join("I" * len(g) + e[0] for g, e in zip(gaps, script)) + "I" * len(gaps[-1])
                cost = sum(e[2] for e in script) + 5 * sum(map(len, gaps))
                best = min(best or (cost, audit), (cost, audit))
    return best


def walked(rows):
    """The cheapest script by a walk with whole strings, and the transcript."""
    emits = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}

    def put(ways):
        ways = dict(ways)
        for _ in range(2):
            for state, (cost, audit, lines) in list(ways.items()):
                for r in "ua":
                    if state in emits[r]:
                        way = (cost + 5, audit + "I", [*lines, NAMES[r] + ":"])
                        ways[emits[r][state]] = min(ways.get(emits[r][state], way), way)
        return ways

    ways = {0: (0, "", [])}
    for (_, role, text), fault in zip(rows, faults(rows)):
        after = {}
        for state, (cost, audit, lines) in put(ways).items():
            moves = [(state, 2, "D", [])]
            if fault in ("", "truncated"):
                more = 5 * (fault == "truncated")
                if state in emits.get(role[:1], {}):
                    moves.append((emits[role[:1]][state], more, "K", [f"{role}:{text}"]))
                moves += [(emits[r][state], 1 + more, "R", [f"{NAMES[r]}:{text}"]) for r in "ua" if state in emits[r]]
            for to, extra, letter, line in moves:
                way = (cost + extra, audit + letter, lines + line)
                after[to] = min(after.get(to, way), way)
        ways = after
    ways = put(ways)
    return min(ways[s] for s in (0, 3) if s in ways)


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv long, turn long, role string, text string")


def repaired(spark, rows, **sizes):
    found = structure.repair(frame(spark, rows), **sizes)
    ends = structure.digests(structure.transcripts(found.turns, most=60))
    return {r["conv"]: r for r in found.conversations.collect()}, {r["conv"]: r for r in ends.collect()}


def ordered(rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn, role, text))
    return {c: sorted(t, key=lambda x: (x[0] is not None, x[0] or 0, x[1], structure_md5(x[2]))) for c, t in by.items()}


def structure_md5(text):
    import hashlib

    return hashlib.md5(text.encode()).hexdigest()


def expect(rows, got, ends):
    for conv, turns in ordered(rows).items():
        cost, audit, lines = walked(turns)
        assert (ends[conv]["cost"], ends[conv]["audit"]) == (cost, audit)
        assert ends[conv]["repaired_sha256"] == sha("\n".join(lines))
        found = faults(turns)
        for name in ("blank", "duplicate", "truncated"):
            assert got[conv][name] == found.count(name)
        kinds = [r[:1] for _, r, _ in turns]
        assert got[conv]["illegal"] == sum(a + b not in ("su", "ua", "au") for a, b in zip(kinds, kinds[1:]))
        numbers = {t for t, _, _ in turns if t is not None}
        assert got[conv]["gaps"] == (max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0)
    assert got.keys() == ends.keys() == ordered(rows).keys()


def drawn(seed, n, conv=1):
    rng = random.Random(seed)
    texts = ["Fine.", "cut", "", " \n", "Well?", "Said twice!", "é…", "end. "]
    roles = ["user", "assistant", "system", "tool", "", "user", "assistant"]
    return [(conv, i + rng.choice([0, 0, 0, 3]), rng.choice(roles), rng.choice(texts) + rng.choice(["", str(i) + "."]))
            for i in range(n)]


def test_the_walk_of_the_tests_finds_what_trying_all_scripts_finds():
    for seed in range(12):
        rows = [r[1:] for r in drawn(seed, 3)]
        assert walked(rows)[:2] == enumerated(rows)


def test_short_conversations(spark):
    rows = [r for conv in range(60) for r in drawn(conv, conv % 9 + 1, conv)]
    rows += [(None, None, "user", "Hi."), (None, None, "user", "Hi."), (None, 4, "assistant", "Yes.")]
    expect(rows, *repaired(spark, rows))


def test_long_conversations_are_repaired_across_pieces(spark):
    rows = drawn(1, 400) + drawn(2, 9, 2) + drawn(3, 8, 3) + drawn(4, 65, None)
    expect(rows, *repaired(spark, rows, segment=8, fanout=3))


def test_pairs_become_symbols_and_change_nothing(spark):
    raw = ["suauaua" * 5, "uauauaua", "uA1dd".replace("d", "1"), "s"]
    pieces = spark.createDataFrame([(r,) for r in raw], "raw string")
    grammar = structure.learn_grammar(pieces)
    assert grammar.rules
    for r in raw:
        plain = structure.Grammar([])
        assert grammar.transfer(r)[:2] == plain.transfer(r)[:2]
        for j in range(4):
            if plain.transfer(r).cost[j] < structure.NEVER:
                assert structure.letters(grammar.transfer(r), 0, j) == structure.letters(plain.transfer(r), 0, j)


def test_damage(spark):
    rows = [(c, t, "assistant", "A. B! C?") for c in range(40) for t in range(4)]
    rows += [(None, None, None, None), (7, None, "user", None)]
    source = frame(spark, rows).withColumns({"case": F.lit(1), "_copy": F.lit("clash")})
    want = []
    for conv, turn, role, text in rows:
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        role, text = role or " ", text or " "
        case = zlib.crc32(key.encode()) % 20
        if case == 4:
            role = "user"
        if case in (1, 2):
            text = "" if case == 1 else re.sub("[.!?]", "", text)
        want += [(conv, turn, role, text)] * (0 if case == 0 else 2 if case == 3 else 1)
    assert whole(structure.damage(source, "conv")) == sorted(want, key=repr)


def test_query_over_the_given_table(spark, small):
    from kerbstone.llm.queries import op11_structure_repair

    source = table(spark, "conversations")
    damaged = [tuple(r) for r in structure.damage(source).collect()]
    every = {r[0] for r in source.select("conv_id").collect()}
    got = {r["conv_id"]: r for r in op11_structure_repair(spark, small).collect()}
    assert got.keys() == every
    expect(damaged, {c: got[c] for c in ordered(damaged)}, {c: got[c] for c in ordered(damaged)})


def test_empty_table_and_conversations_that_lose_all_rows(spark, tmp_path):
    from kerbstone.llm.queries import op11_structure_repair

    assert structure.repair(frame(spark, [])).turns.count() == 0
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    frame(spark, [(gone, 0, "user", "x")]).withColumnRenamed("conv", "conv_id").write.parquet(
        f"{tmp_path}/conversations.parquet")
    assert whole(op11_structure_repair(spark, str(tmp_path))) == [(gone, 0, 0, 0, 0, 0, 0, "", sha(""))]
