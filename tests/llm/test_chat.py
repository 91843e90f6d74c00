import random

import duckdb
import pytest
from compare import compare

from patronage.llm import chat
from patronage.llm.queries import op7

SCHEMA = "conv_id long, turn long, role string, text string"


def against_sql(spark, df):
    con = duckdb.connect()
    con.register("conversations", df.select(*[c.split()[0] for c in SCHEMA.split(", ")]).toArrow())
    assert compare(chat.conversations(df), con, op7.SQL) == []


def made(seed):
    """Conversations whose messages quote earlier ones, whole or in part, in levels."""
    rng, rows = random.Random(seed), []
    said = ["hello there", "I agree", "what about\nthe other", "x", "yes", "no  way", "Long Line here to quote", ""]
    for conv in range(25):
        texts = []
        for turn in range(rng.randint(1, 9)):
            parts = []
            if texts and rng.random() < 0.7:
                lines = rng.choice(texts).split("\n")
                lines = lines if rng.random() < 0.6 else lines[:1]
                if rng.random() < 0.3:
                    parts.append("On Monday, A wrote:")
                parts += [("> " if rng.random() < 0.8 else " >  ") + x.upper() for x in lines]
            parts.append(f"{rng.choice(said)} {rng.choice(said)}")
            if rng.random() < 0.3:
                parts += ["", rng.choice(said)]
            texts.append("\n".join(parts))
            rows.append((conv, turn, rng.choice(["user", "assistant", None]), texts[-1]))
    odd = [(1, 0, "user", "again")] * 2 + [(None, 0, "u", "> q"), (None, 1, "u", None), (2, None, "u", "> q\nz")]
    return rows + odd + [(3, 50, "u", ""), (3, 51, "u", None), (4, 60, "u", "> " * 50 + "deep")]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_sql(spark, clashing, seed, monkeypatch):
    monkeypatch.setattr(chat, "CHUNK", 3)
    against_sql(spark, clashing(spark.createDataFrame(made(seed), SCHEMA)).drop("thread", "position"))


def test_no_quotes_and_no_rows(spark):
    against_sql(spark, spark.createDataFrame([(1, 1, "user", "b"), (1, 0, "user", "a"), (2, 0, None, None)], SCHEMA))
    against_sql(spark, spark.createDataFrame([], SCHEMA))


def test_one_thread(spark):
    rows = [
        (1, 0, "user", "First question\nwith two lines"),
        (1, 1, "user", "Another matter"),
        (1, 2, "assistant", "On Monday, A wrote:\n> first   QUESTION with two lines\n\nAn answer"),
        (1, 3, "assistant", "> another matter\nYes"),
        (1, 4, "user", "> > with two lines\n> An answer\n\nThanks"),
        (1, 5, "user", "> nobody said this\nOdd"),
    ]
    out = {r["turn"]: r for r in chat.conversations(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [out[t]["reply_to"] for t in range(6)] == [None, None, 0, 1, 2, None]
    assert [out[t]["thread"] for t in range(6)] == [0, 1, 0, 1, 0, 5]
    assert sorted(out, key=lambda t: out[t]["position"]) == [0, 2, 4, 1, 3, 5]
    assert out[2]["body"] == "An answer" and out[4]["formatted"] == "<|im_start|>user\nThanks<|im_end|>\n"
    assert (out[5]["n_quotes"], out[5]["n_linked"]) == (1, 0)


def test_a_large_conversation_lies_in_many_tasks(spark):
    text = "case when id % 7 = 3 then concat('> message ', id div 2, '\nmore') else concat('message ', id) end"
    df = spark.range(5000).selectExpr("1L as conv_id", "id as turn", "'user' as role", f"{text} as text")
    out = chat.conversations(df)
    against_sql(spark, df)
    assert out.select("position").distinct().count() == 5000


def test_no_python_in_the_plan(spark, sf_dir):
    plan = op7.query(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
