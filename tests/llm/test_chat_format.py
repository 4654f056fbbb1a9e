import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from martloom.llm import chat_format as chat


@pytest.fixture(scope="module")
def trained(spark):
    turns = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    return chat.train(chat.transcripts(turns))


def brute_force(model, lines):
    emitted = model.emit(lines)
    best = (-np.inf, None)
    for path in itertools.product(range(chat.STATES), repeat=len(lines)):
        score = model.first[path[0]] + sum(model.steps[a, b] for a, b in zip(path, path[1:])) + sum(
            emitted[i, s] for i, s in enumerate(path))
        if score > best[0]:
            best = (score, list(path))
    return best[1]


LINES = ["User: what is it?", "", "It is a long answer with several words in it.", "### AI:", "More of this"]


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5])
def test_viterbi_is_the_best_path(trained, n):
    zero = np.zeros(chat.STATES)
    assert chat.viterbi(trained, LINES[:n], zero, zero, True) == brute_force(trained, LINES[:n])


@pytest.mark.parametrize("cuts", [(2,), (1, 3), (1, 2, 3, 4)])
def test_parts_give_the_path_of_the_whole(spark, trained, cuts):
    bounds = [0, *cuts, len(LINES)]
    rows = [("c", i, "\n".join(LINES[a:b])) for i, (a, b) in enumerate(zip(bounds, bounds[1:]))]
    got = chat.format_chats(spark.createDataFrame(rows, "conv_id string, part int, text string"), trained).orderBy("part").collect()
    assert [int(s) for r in got for s in r["states"]] == brute_force(trained, LINES)


def test_held_out_roles(spark):
    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    true = {r["conv_id"]: r["states"] for r in chat.transcripts(turns).collect()}
    good = total = 0
    for r in chat.formatted(turns).filter(chat.is_held_out("conv_id")).collect():
        good += sum(int(a) // 2 == int(b) // 2 for a, b in zip(r["states"], true[r["conv_id"]]))
        total += r["n_lines"]
        assert len(r["states"]) == r["n_lines"] == len(true[r["conv_id"]])
    assert good >= 0.95 * total


def test_marked_turns_and_rendering(spark, trained):
    text = "System: Be brief.\nUser: Hello there\nsecond line\nAssistant: Hi.\n\n<|user|>\nBye"
    r = chat.format_chats(spark.createDataFrame([(1, 0, text)], "conv_id int, part int, text string"), trained).first()
    assert r["chat"] == ("<|system|>\nBe brief.\n<|end|>\n<|user|>\nHello there\nsecond line\n<|end|>\n<|assistant|>\nHi.\n<|end|>\n"
                         "<|user|>\nBye\n<|end|>\n")
    assert (r["n_turns"], r["n_lines"], r["roles"]) == (4, 7, "system,user,assistant,user")


def test_odd_rows(spark, trained):
    schema = "conv_id long, turn long, role string, text string, part string"
    rows = [(1, 0, "user", "a", "x"), (1, 0, "user", "a", "y"), (1, 1, "assistant", None, "x"), (None, 0, None, "b", "x"),
            (2, None, "tool", "", None), (3, 5, "user", "l\n" * 3000, "x"), (4, 0, "user", "z", "x"), (4, 600, "assistant", "z", "x")]
    turns = spark.createDataFrame(rows, schema)
    got = {(r["conv_id"], r["part"]): r for r in chat.formatted(turns).collect()}
    assert set(got) == {(1, 0), (None, 0), (2, 0), (3, 0), (4, 0), (4, 2)}
    assert got[3, 0]["n_lines"] >= 3000 and got[1, 0]["n_lines"] == len(got[1, 0]["states"])
    assert chat.formatted(turns.limit(0)).count() == 0
    nulls = spark.createDataFrame([(1, 0, None), (None, 0, ""), (1, 0, None)], "conv_id long, part int, text string")
    assert chat.format_chats(nulls, trained).agg(F.sum("n_lines")).first()[0] == 3


def test_a_large_conversation_is_cut_by_rank(spark):
    rows = [(None, i % 8 if i % 3 else None, ("user", "assistant")[i % 2], f"line {i}") for i in range(1500)]
    rows += [(5, 0, "user", f"x{i}") for i in range(600)] + [(5, 300, "user", "y"), (5, 600, "user", "z"), (6, 0, "user", "x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = {r["conv_id"]: r for r in chat.transcripts(turns.filter("conv_id IS NULL OR turn < 256"), part=10000).collect()}
    got = {}
    for r in sorted(chat.transcripts(turns).collect(), key=lambda r: r["part"]):
        assert sum(int(x) % 2 == 0 for x in r["states"]) <= chat.PART
        got.setdefault(r["conv_id"], []).append(r)
    for key, n in ((None, 6), (5, 3), (6, 1)):
        own = got[key][:n]
        assert "\n".join(r["text"] for r in own) == want[key]["text"] and "".join(r["states"] for r in own) == want[key]["states"]
    assert {k: [r["part"] for r in v] for k, v in got.items()} == {None: [0, 1, 2, 3, 4, 5], 5: [0, 1, 2, 3, 4], 6: [0]}
    assert sum(r["n_lines"] for r in chat.formatted(turns).collect()) == sum(len(r["states"]) for v in got.values() for r in v)
