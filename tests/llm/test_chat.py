from __future__ import annotations

import itertools
import random

import pytest

from eddyline.llm import chat

SMALL = "/root/testdata/sf0.001"


def cheapest(roles):
    """The least cost over all labellings, by trying all of them."""
    costs = chat.label_costs(roles)
    best = float("inf")
    for labels in itertools.product(range(3), repeat=len(roles)):
        state, total = chat.START, 0.0
        for own, label in zip(costs, labels, strict=True):
            total += chat.STEP[state, label] + own[label]
            state = label
        best = min(best, total + chat.END[state])
    return best


def legal(text):
    """Roles of a rendered conversation, checked against the rules."""
    assert text.endswith(chat.CLOSING)
    turns = text.split(chat.CLOSING)[:-1]
    roles = [t[2 : t.index("|>")] for t in turns]
    if roles[0] == "system":
        roles = roles[1:]
    assert len(roles) % 2 == 0 and roles == ["user", "assistant"] * (len(roles) // 2)


POOL = ["user", "assistant", "system", "Human", " GPT ", "narrator", "", None]


@pytest.mark.parametrize("run_turns", [1, 2, 1024])
def test_repairs_are_cheapest_and_legal(spark, run_turns):
    rng = random.Random(run_turns)
    talks = {k: [rng.choice(POOL) for _ in range(rng.randint(1, 6))] for k in range(60)}
    talks[60] = ["user", "assistant"] * 40
    rows = [(k, t, role, f"t{t}", "x") for k, roles in talks.items() for t, role in enumerate(roles)]
    rng.shuffle(rows)
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, run string")
    pieces = chat.repair(turns, run_turns)
    out = {r.conv_id: r for r in chat.render(pieces).collect()}
    assert out.keys() == talks.keys()
    for k, roles in talks.items():
        assert out[k].cost == pytest.approx(cheapest(roles) if k < 60 else 0.0)
        legal(out[k].text)
        places = [out[k].text.index(f"t{t}") for t in range(len(roles))]
        assert places == sorted(places)


def test_rendering(spark):
    rows = [(1, 0, "user", "hi <|end|>"), (1, 1, "user", None), (1, 2, "bot", "yes"), (None, 0, "assistant", "")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r.conv_id: r.text for r in chat.render(chat.repair(turns)).collect()}
    assert found[1] == "<|user|>\nhi < |end|>\n\n<|end|>\n<|assistant|>\nyes<|end|>\n"
    assert found[None] == "<|user|>\n<|end|>\n<|assistant|>\n<|end|>\n"


def test_odd_rows(spark):
    rows = [(1, None, "user", "a"), (1, 0, "assistant", "b"), (1, 0, "assistant", "b"), (1, -5, None, "c" * 50_000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    pieces = chat.repair(turns).collect()
    assert len(pieces) == 4
    assert chat.repair(turns.limit(0)).count() == 0


def test_query_keeps_every_turn(spark):
    from eddyline.llm.queries import op2_chat

    rows = op2_chat(spark, SMALL)
    source = spark.read.parquet(f"{SMALL}/conversations.parquet")
    assert rows.count() == source.count()
    for r in chat.render(rows).collect():
        legal(r.text)
