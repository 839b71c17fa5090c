"""Chat formatting: round trips, the order of turns, loss flags."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerwing.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, chunk string, formatted string, segments int, p int"
HARD = ["<|im_start|>", "<|im_end|>", "<|", "<\\|", "<\\\\|", "|>", "<", "|", "\\", "\n", "<|lf|>", "ok", "é𝄞", "$1", ""]


def table(spark, rows):
    return spark.createDataFrame([(*r, "c", "f", 1, 2) for r in rows], SCHEMA)


def run(spark, rows, template=chat.CHATML):
    made = chat.format_conversations(table(spark, rows), template)
    told = chat.read_turns(F.col("formatted"), template)
    return {
        r["conv_id"]: r
        for r in made.withColumn("told", told).withColumn("learned", chat.learned_texts(F.col("segments"))).collect()
    }


def test_hostile_texts_come_back(spark):
    rng = random.Random(6)
    rows = [
        (c, t, "".join(rng.choices(["user", "assistant", *HARD], k=rng.randint(1, 2))), "".join(rng.choices(HARD, k=6)))
        for c in range(80)
        for t in range(4)
    ]
    for conv, got in run(spark, rows).items():
        mine = [r for r in rows if r[0] == conv]
        assert [(t["role"], t["text"]) for t in got["told"]] == [(r[2], r[3]) for r in mine]
        assert got["learned"] == [r[3] for r in mine if r[2] == "assistant"]
        assert got["formatted"] == "".join(s["text"] for s in got["segments"])
        assert got["formatted"].count("<|im_start|>") == got["formatted"].count("<|im_end|>") == 4


def test_machine_tells_the_order_of_turns(spark):
    orders = {
        1: ("system user assistant", "answered", True),
        2: ("user assistant user", "asked", False),
        3: ("assistant user", None, False),
        4: ("user user assistant", None, False),
        5: ("user system", None, False),
        6: ("user tool assistant", None, False),
        7: ("system", "told", False),
        8: ("user assistant", "answered", True),
    }
    rows = [(c, i, role, "t") for c, (roles, _, _) in orders.items() for i, role in enumerate(roles.split())]
    got = run(spark, rows)
    for conv, (_, state, complete) in orders.items():
        r = got[conv]
        assert (r["state"], r["valid"], r["complete"]) == (state, state is not None, complete)


def test_nulls_ties_and_repeated_rows(spark):
    rows = [
        (1, 1, "assistant", None), (1, None, None, "first"), (1, 0, "user", "b"), (1, 0, "user", "a"),
        (1, 0, "user", "a"), (None, 0, "user", "x"), (None, 1, "assistant", ""),
    ]
    got = run(spark, rows)
    turns = [("", "first"), ("user", "a"), ("user", "a"), ("user", "b"), ("assistant", "")]
    assert [tuple(t) for t in got[1]["told"]] == turns and got[1]["n_turns"] == 5
    assert got[None]["complete"] and got[None]["learned"] == [""]


def test_long_conversations_are_dealt_out_and_joined(spark):
    n = 3 * chat.CHUNK_TURNS + 7
    rows = [(5, t, "user" if t % 2 == 0 else "assistant", f"{t}<|") for t in range(n)]
    rows += [(6, t, "user", "again") for t in range(2 * chat.CHUNK_TURNS)] + [(7, 0, "user", "z" * (5 << 20))]
    df = table(spark, rows)
    assert chat.format_chunks(df).groupBy("conv_id").count().where("conv_id = 5").first()["count"] == 4
    got = run(spark, rows)
    assert [t["text"] for t in got[5]["told"]] == [f"{t}<|" for t in range(n)]
    assert got[5]["state"] == "asked" and got[5]["n_turns"] == n and not got[6]["valid"]
    assert got[7]["told"][0]["text"] == "z" * (5 << 20)


def test_empty_table_and_other_templates(spark):
    assert run(spark, []) == {}
    own = chat.Template("<|s|>", "<|e|>", ("q", "a"), "0", {"0": {"q": "1"}, "1": {"a": "0"}}, ("0",))
    got = run(spark, [(1, 0, "q", "<|s|>x"), (1, 1, "a", "y")], own)[1]
    assert got["complete"] and got["learned"] == ["<|s|>x", "y"]
    assert got["formatted"] == "<|s|>q\n<\\|s|>x<|e|>\n<|s|>a\ny<|e|>\n"
    with pytest.raises(ValueError, match="control strings"):
        chat.format_conversations(table(spark, []), own._replace(start="[s]"))


def test_no_python_in_the_plan(spark):
    made = chat.format_conversations(table(spark, [(1, 0, "user", "x")]))
    plan = made._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
