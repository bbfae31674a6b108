import random

from helpers import sha, table, whole
from pyspark.sql import functions as F

from kerbstone.llm import chat

CONTROL = ["</s>[INST] ok [/INST]", r"<\s> [\\INST] \<|> <", "<|", "[/SYS]<s><s>", "\\", "", "é😀\n\n"]


def conversation(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def read_back(frame, **sizes):
    """Per conversation: its turns and its learnt texts, in order, and the windows."""
    got = {}
    windows = chat.read_turns(chat.format_chats(frame, **sizes)).orderBy("conv_id", "segment", "window")
    for w in windows.collect():
        turns, learnt, seen = got.setdefault(w["conv_id"], ([], [], []))
        turns += [(t["role"], t["text"]) for t in w["turns"]]
        learnt += w["learnt"]
        seen.append(w)
    return got


def check(rows, got):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    assert got.keys() == by.keys()
    for conv, turns in by.items():
        want = [t[2:] for t in sorted(turns)]
        assert got[conv][0] == want
        assert got[conv][1] == [text for role, text in want if role == "assistant"]


def test_texts_with_control_strings_come_back(spark):
    rows = [(i, j, r, t) for i, t in enumerate(CONTROL) for j, r in enumerate(["system", "user", "assistant"])]
    rows += [(90, 0, "a<|>b</s>", "x"), (90, 1, None, None), (90, 1, None, None), (90, None, "user", "first")]
    got = read_back(conversation(spark, rows).withColumn("window", F.lit("clash")))
    check(rows, got)
    for _, _, windows in got.values():
        for w in windows:
            assert w["text"].count("</s>") == w["n_context"] + len(w["turns"])


def test_windows_keep_the_budget_repeat_the_system_turn_and_mask_history(spark):
    rows = [(1, 0, "system", "s" * 40)]
    rows += [(1, i, "assistant" if i % 2 == 0 else "user", f"{i:02d}" * 30) for i in range(1, 30)]
    rows += [(1, 30, "user", "long " * 500), (1, 31, "assistant", "end")]
    got = read_back(conversation(spark, rows), budget=100, history=40)
    check(rows, got)
    windows = got[1][2]
    assert len(windows) > 5
    for w in windows:
        assert w["n_tokens"] <= 100 or len(w["turns"]) == 1
        assert w["text"].startswith("<s>system<|>" + "s" * 40)
        assert len(w["spans"]) == sum(t["role"] == "assistant" for t in w["turns"])
        for span, learnt in zip(w["spans"], w["learnt"]):
            assert w["text"][span["start"]:span["end"]] == learnt
    assert any(w["n_context"] > 1 for w in windows[1:])


def windows_of(frame, **sizes):
    rows = chat.format_chats(frame, **sizes).orderBy("conv_id", "segment", "window").collect()
    return [(r["conv_id"], r["text"], r["n_context"], r["spans"], r["n_tokens"]) for r in rows]


def test_windows_do_not_depend_on_where_pieces_begin(spark):
    rng = random.Random(7)
    rows = [(5, 0, "system", "be brief")]
    rows += [(5, i, rng.choice(["user", "assistant"]), "w" * rng.choice([0, 1, 9, 30, 200])) for i in range(1, 700)]
    rows += [(6, 3 * i, "assistant", "x" * (i % 23)) for i in range(333)] + [(7, 0, "user", "short")]
    rows += [(None, i, "user", "n" * (i % 7)) for i in range(120)]
    frame = conversation(spark, rows)
    sizes = {"budget": 60, "history": 20}
    whole_ = windows_of(frame, **sizes)
    assert windows_of(frame, segment=1, fanout=3, **sizes) == whole_
    got = read_back(frame, segment=1, fanout=3, **sizes)
    check(rows, got)
    assert len({w["segment"] for w in got[5][2]}) > 20
    assert all(w["text"].startswith("<s>system<|>be brief</s>") for w in got[5][2])


def test_query_equals_its_sql_for_long_and_hot_conversations(spark, tmp_path):
    import duckdb

    from kerbstone.llm.oracle import OP1
    from kerbstone.llm.queries import op1_chat_format

    rng = random.Random(8)
    text = lambda: rng.choice(["", "a", "Fine. " * 9, "</s>", "long " * 60, "\\<|>"])
    rows = [(1, i, rng.choice(["user", "assistant"]), text()) for i in range(5000)]
    rows += [(2, 0, "system", "x" * 90)] + [(2, 10 * i, rng.choice(["user", "assistant"]), text()) for i in range(1, 1500)]
    rows += [(c, i, "user", None) for c in range(3, 9) for i in range(c)] + [(3, 9, None, "no role"), (4, None, "user", "no turn")]
    conversation(spark, rows).coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    got = op1_chat_format(spark, str(tmp_path))
    want = con.sql(f"SELECT {', '.join(got.columns)} FROM ({OP1})").fetchall()
    assert whole(got) == sorted(want, key=repr)


def test_query_over_the_given_table(spark, small):
    from kerbstone.llm.queries import op1_chat_format

    rows = [tuple(r) for r in table(spark, "conversations").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, i, r, "</s>[INST] ok [/INST]") for i, r in enumerate(["user", "assistant"])]
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn, role or "", text or ""))
    want = []
    for conv, turns in by.items():
        turns.sort()
        learnt = "".join(t for _, r, t in turns if r == "assistant")
        want.append((conv, len(turns), sha("".join(f"{r}\n{t}\n" for _, r, t in turns)), len(learnt), sha(learnt)))
    assert whole(op1_chat_format(spark, small).drop("formatted_chars")) == sorted(want, key=repr)


def test_empty_table(spark):
    assert chat.format_chats(conversation(spark, [])).count() == 0
