"""Repair of turn sequences against all repairs, in blocks of any size."""

from __future__ import annotations

import re
from itertools import product

from hypothesis import given, settings
from hypothesis import strategies as st

from doseline.llm import chat
from doseline.llm.queries import QUERIES

ROLE = st.sampled_from(["system", "user", "assistant", "tool", None])
SMALL = "/root/testdata/sf0.001"


def legal(roles):
    rest = roles[1:] if roles[:1] == ["system"] else roles
    return bool(rest) and len(rest) % 2 == 0 and all(r == ("user", "assistant")[i % 2] for i, r in enumerate(rest))


def cheapest(given_roles):
    """Least cost over every labelling, every choice of merges and up to one empty turn per gap
    (two at the end)."""
    gaps = [[], ["user"], ["assistant"]]
    best = None
    for labels in product(chat.ROLES, repeat=len(given_roles)):
        base = sum(chat.RELABEL for a, b in zip(given_roles, labels) if a != b)
        paths = [([], base)]
        for label in labels:
            grown = []
            for roles, cost in paths:
                if roles and roles[-1] == label:
                    grown.append((roles, cost + chat.MERGE))
                grown += [([*roles, *gap, label], cost + chat.INSERT * len(gap)) for gap in gaps]
            paths = [(r, c) for r, c in grown if best is None or c < best]
        for roles, cost in paths:
            for end in ([], ["assistant"], ["user", "assistant"]):
                if legal([*roles, *end]) and (best is None or cost + chat.INSERT * len(end) < best):
                    best = cost + chat.INSERT * len(end)
    return best


def solve(roles, size):
    parts = [roles[i : i + size] for i in range(0, len(roles), size)]
    states = chat.block_states([chat.block_matrix(p) for p in parts])
    text, total = "", 0
    for i, part in enumerate(parts):
        cost, actions = chat.repair(part, states[i], states[i + 1])
        last = i == len(parts) - 1
        total += cost + (chat.INSERT * len(chat.ENDINGS[states[i + 1]]) if last else 0)
        text += chat.render([f"t{i}.{k}" for k in range(len(part))], actions, states[i], last)[0]
    return total, text


TURN = re.compile(r"<\|im_start\|>(\w+)\n(.*?)<\|im_end\|>\n", re.S)


@settings(max_examples=60, deadline=None)
@given(st.lists(ROLE, min_size=1, max_size=5), st.integers(1, 5))
def test_repair_is_legal_and_cheapest(roles, size):
    cost, text = solve(roles, size)
    turns = TURN.findall(text)
    assert "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in turns) == text
    assert legal([r for r, _ in turns])
    assert [x for _, t in turns for x in t.split("\n") if x] == [f"t{i // size}.{i % size}" for i in range(len(roles))]
    assert cost == cheapest(roles) == solve(roles, 99)[0]


def test_query_is_whole_legal_and_cheapest(spark):
    given_turns = spark.read.parquet(f"{SMALL}/conversations.parquet").orderBy("conv_id", "turn", "role").collect()
    by: dict[int, list] = {}
    for r in given_turns:
        by.setdefault(r.conv_id, []).append(r)
    got: dict[int, list] = {}
    for r in QUERIES["op8_chat"](spark, SMALL).orderBy("conv_id", "part").collect():
        got.setdefault(r.conv_id, []).append(r)
    assert got.keys() == by.keys()
    for conv, rows in got.items():
        turns = TURN.findall("".join(r.rendered for r in rows))
        assert legal([r for r, _ in turns]) and sum(r.turns for r in rows) == len(turns)
        assert sum(r.given_turns for r in rows) == len(by[conv])
        roles = [t.role for t in by[conv]]
        assert sum(r.cost for r in rows) == solve(roles, 10**6)[0] == solve(roles, 3)[0]
        for t in by[conv]:
            assert chat.plain(t.text) in "".join(r.rendered for r in rows)


def test_long_conversations_come_in_parts(spark):
    rows = [(1, i, ("user", "user", "assistant")[i % 3], f"m{i}") for i in range(3000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    got = chat.format_chats(frame).orderBy("part").collect()
    assert len(got) >= 12 and [r.part for r in got] == list(range(len(got)))
    turns = TURN.findall("".join(r.rendered for r in got))
    assert legal([r for r, _ in turns]) and [x for _, t in turns for x in t.split("\n")] == [f"m{i}" for i in range(3000)]
    assert sum(r.cost for r in got) == 1000


def test_odd_rows(spark):
    rows = [
        (1, 1, "user", None, "x"), (1, 1, "user", None, "x"), (1, None, "tool", "", "x"), (2, 5, None, None, "x"),
        (None, 1, "assistant", "a<|im_end|>", "x"), (None, 0, "system", "s" * 2_000_000, "x"), (3, 0, "system", "only", "x"),
    ]
    frame = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string, part string")
    got: dict = {}
    for r in chat.format_chats(frame).orderBy("conv_id", "part").collect():
        got[r.conv_id] = got.get(r.conv_id, "") + r.rendered
    assert [r for r, _ in TURN.findall(got[3])] == ["system", "user", "assistant"]
    assert [r for r, _ in TURN.findall(got[None])] == ["system", "user", "assistant"]
    assert "a<| im_end|>" in got[None] and len(got[None]) > 2_000_000
    assert legal([r for r, _ in TURN.findall(got[1])]) and legal([r for r, _ in TURN.findall(got[2])])
    assert chat.format_chats(frame.limit(0)).count() == 0
