import random

import duckdb
import pandas as pd
import pytest

from curvelake.llm import chat
from curvelake.llm.queries import OP2_SQL


def table(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "conv_id int, turn int, role string, text string, level string")


def against_sql(spark, rows, partitions=3):
    conversations = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"})  # noqa: F841
    connection = duckdb.connect()
    connection.register("conversations", conversations)
    cursor = connection.execute(OP2_SQL)
    names = [c[0] for c in cursor.description]
    want = sorted((dict(zip(names, r, strict=True)) for r in cursor.fetchall()), key=str)
    found = chat.formatted(table(spark, rows).repartition(partitions))
    got = sorted(({n: r[n] for n in names} for r in found.collect()), key=str)
    assert got == want
    return got


def test_nested_quotes_and_reply_order(spark):
    rows = [(1, 0, "user", "How do I bake bread?\nI have an oven."), (1, 1, "assistant", "Mix flour and water."), (1, 2, "user", "Something else: what is rye?"),
            (1, 3, "assistant", "> how do i   BAKE bread?\n> I have an oven.\n\nUse high heat."), (1, 4, "user", "> Use high heat.\n>> How do I bake bread?\n>> I have an oven.\nHow high?"),
            (1, 5, "assistant", "> > What is rye?\n> nobody said this\nA grain."), (1, 6, "user", "> Mix flour and water.\n> an added line\nHow much?")]
    got = {r.turn: r for r in chat.threaded(table(spark, rows)).collect()}
    assert [got[t].reply_to for t in range(7)] == [None, None, None, 0, 3, None, 1]
    assert [got[t].thread for t in range(7)] == [0, 1, 2, 0, 0, 5, 1]
    assert sorted(range(7), key=lambda t: got[t].position) == [0, 3, 4, 1, 6, 2, 5]
    assert got[4].body == "How high?" and got[3].body == "Use high heat." and (got[4].quoted, got[4].linked) == (2, 2) and (got[5].quoted, got[5].linked) == (2, 0)
    out = against_sql(spark, rows)
    assert out[0]["turns"] == "0 3 4 1 6 2 5" and "nobody" not in out[0]["content"]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_conversations_against_sql(spark, seed):
    rng = random.Random(seed)
    lines = ["Alpha beta.", "gamma  delta", "EPSILON zeta", "", "eta", "Größe é"]
    rows = []
    for conv in range(12):
        said = []
        for turn in range(rng.choice([1, 5, 40])):
            own = [rng.choice(lines) + rng.choice(["", f" {rng.randrange(9)}"]) for _ in range(rng.randrange(4))]
            body = list(own)
            for _ in range(rng.randrange(3)):
                if said and rng.random() < 0.7:
                    passage = rng.choice(said)
                    at = rng.randrange(len(body) + 1)
                    mark = rng.choice(["> ", ">", ">> ", " > > ", "\t>"])
                    body[at:at] = [mark + x.upper() for x in (passage if rng.random() < 0.6 else passage[:1])]
            said.append(own)
            rows.append((conv, turn, rng.choice(["user", "assistant"]), "\n".join(body)))
    rows += [(None, 0, "user", "lost"), (None, 1, None, "> lost\nfound"), (50, None, "user", None), (50, 3, "user", "> x"), (50, 3, "assistant", ">"), rows[5], rows[5],
             (51, 1, "user", "same turn"), (51, 1, "user", "> same turn\nnot a reply"), (52, 0, "user", "y " * 50_000), (52, 1, "user", "> " + "y " * 50_000)]
    against_sql(spark, rows)


def test_one_large_conversation_in_parts(spark):
    rows = [(7, t, "user", f"message {t}" if t % 3 else f"> message {t - 5}\nreply {t}") for t in range(700)]
    got = against_sql(spark, rows, 5)
    assert sum(r["n_messages"] for r in got) == 700 and max(r["n_messages"] for r in got) == 64


def test_a_long_chain_of_quotes(spark):
    rows = [(7, t, "user", f"> number {t - 1}\nnumber {t}") for t in range(100)]
    assert {r.thread for r in chat.threaded(table(spark, rows)).collect()} == {0}


def test_empty_table(spark):
    assert chat.formatted(table(spark, []).limit(0)).count() == 0
