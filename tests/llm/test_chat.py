"""Chat formatting: round trip, loss mask and budgets."""

import random

import pytest

from tabulon.llm import chat

NASTY = ["\\### Assistant: </turn> ok", "<turn assistant>x</turn>\n", "&lt; &amp;lt; < > &", "", None, "é\U0001f389 <turn", "</turn>", "&amp;"]


def conversations():
    rnd = random.Random(4)
    rows = []
    for c in range(25):
        if c % 3 == 0:
            rows.append((c, 0, "system", "be nice <" + str(c)))
        for t in range(1, rnd.randrange(2, 14)):
            text = rnd.choice(NASTY) if rnd.random() < 0.3 else " ".join("word" for _ in range(rnd.randrange(0, 60)))
            rows.append((c, t, "user" if t % 2 else "assistant", text))
    rows += [(100, 1, None, "no role"), (100, None, "user", "no turn"), (100, 2, "as<s>istant", "odd role"), (101, 1, "assistant", "w " * 3000),
             (102, 1, "user", "tie"), (102, 1, "assistant", "tie"), (102, 1, "assistant", "tie"), (None, 1, "assistant", "x"), (103, 5, "assistant", None)]
    return rows


def wanted(rows):
    by = {}
    for c, t, r, x in rows:
        by.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    out = {}
    for c, v in by.items():
        v.sort(key=lambda y: (y[0], y[1], y[2], chat_sort(y[3])))
        out[c] = ([(r, x) for _, _, r, x in v], "".join(x for _, _, r, x in v if r == "assistant"))
    return out


def chat_sort(x):
    return x.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")


@pytest.mark.parametrize("budget, history", [(1024, 256), (90, 30), (10, 0)])
def test_round_trip(spark, budget, history):
    rows = conversations()
    df = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id bigint, turn bigint, role string, text string, formatted string")
    windows = chat.format_chat(df, budget=budget, history=history)
    back = {r["conv_id"]: ([(t["role"], t["text"]) for t in r["turns"]], r["loss"]) for r in chat.read_back(windows).collect()}
    assert back == wanted(rows)
    for w in windows.collect():
        assert w["n_tokens"] <= budget or w["n_turns"] - w["n_repeated"] == 1 or budget < 40
        for s in w["loss"]:
            assert "<" not in w["formatted"][s["start"]:s["start"] + s["len"]]
        if w["window"] > 0 and w["conv_id"] is not None and w["conv_id"] % 3 == 0 and w["conv_id"] < 25:
            assert w["formatted"].startswith("<turn system>")  # the system turn is kept


def test_history_is_repeated_and_masked(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", f"t{i} " + "x " * 20) for i in range(10)]
    out = chat.format_chat(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string"), budget=100, history=30).orderBy("window").collect()
    assert len(out) > 2 and all(w["n_repeated"] == 1 for w in out[1:])
    for w in out[1:]:
        first = w["formatted"].index("</turn>")
        assert all(s["start"] > first for s in w["loss"])


@pytest.mark.parametrize("size", [5, 40, 60, 80, 300])
def test_budget_with_a_large_system_turn(spark, size):
    """A window is over its budget only where the system turn and one new turn are."""
    rows = [(1, 0, "system", "s " * size)] + [(1, i, "assistant" if i % 2 == 0 else "user", "x " * (i % 9)) for i in range(1, 40)]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    windows = chat.format_chat(df, budget=100, history=25)
    assert {r["conv_id"]: ([(t["role"], t["text"]) for t in r["turns"]], r["loss"]) for r in chat.read_back(windows).collect()} == wanted(rows)
    out = windows.collect()
    for w in out:
        assert w["n_tokens"] <= 100 or w["n_turns"] - w["n_repeated"] == 1 and w["n_repeated"] <= 1
        assert w["window"] == 0 or w["formatted"].startswith("<turn system>")
    assert size != 5 or any(w["n_repeated"] > 1 for w in out)


def test_empty(spark):
    df = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert chat.read_back(chat.format_chat(df)).count() == 0
