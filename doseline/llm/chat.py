"""Chat formatting: minimum-cost repair of turn sequences, and their rendering.

A legal conversation is an optional system turn, then user and assistant turns in turn, the
last from the assistant. Each given turn is emitted under a role, or merged into the turn
before it; empty turns may be inserted. The cheapest repair is a shortest path over the last
emitted role. Costs of a block of turns combine like matrices, so that a very long
conversation is solved in blocks: their matrices fix the roles between them, and each block
is then repaired by itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from doseline.llm.common import keep, struct

ROLES = ("system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)  # states: the role emitted last
MERGE, INSERT, RELABEL = 1, 2, 3  # costs
NEVER = 1 << 40
BLOCK_TURNS = 256
BLOCK_CHARACTERS = 1 << 20
SEPARATOR = "\n"

# What may follow what without a turn in between, and what an empty turn in between is.
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
BETWEEN = {(START, ASSISTANT): USER, (SYSTEM, ASSISTANT): USER, (USER, USER): ASSISTANT, (ASSISTANT, ASSISTANT): USER}
# Empty turns that end a conversation.
ENDINGS = {START: (), SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,), ASSISTANT: ()}


def moves(role: str | None) -> dict[tuple[int, int], tuple[int, str]]:
    """Cost and action of a turn from state to state, the cheapest and of equals the first."""
    found: dict[tuple[int, int], tuple[int, str]] = {}
    for state in range(4):
        for emitted in (SYSTEM, USER, ASSISTANT):
            named = 0 if role == ROLES[emitted - 1] else RELABEL
            ways = []
            if emitted in NEXT[state]:
                ways.append((named, "emit"))
            if emitted == state:
                ways.append((named + MERGE, "merge"))
            if (state, emitted) in BETWEEN:
                ways.append((named + INSERT, "insert"))
            if ways:
                found[state, emitted] = min(ways, key=lambda w: w[0])
    return found


MOVES = {role: moves(role) for role in (*ROLES, None)}


def known(role: str | None) -> str | None:
    return role if role in ROLES else None


def step_matrix(role: str | None) -> np.ndarray:
    out = np.full((4, 4), NEVER, np.int64)
    for (a, b), (cost, _) in MOVES[known(role)].items():
        out[a, b] = cost
    return out


STEPS = {role: step_matrix(role) for role in MOVES}
END = np.array([INSERT * len(ENDINGS[s]) for s in range(4)], np.int64)


def joined(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Cheapest cost through two parts of a conversation."""
    return np.minimum((first[:, :, None] + second[None, :, :]).min(axis=1), NEVER)


def block_matrix(roles: list[str | None]) -> np.ndarray:
    total = np.full((4, 4), NEVER, np.int64)
    np.fill_diagonal(total, 0)
    for role in roles:
        total = joined(total, STEPS[known(role)])
    return total


def block_states(matrices: list[np.ndarray]) -> list[int]:
    """States before, between and after the blocks of a conversation on its cheapest path."""
    onward = [END]
    for matrix in reversed(matrices):
        onward.append((matrix + onward[-1]).min(axis=1))
    onward.reverse()
    states = [START]
    for matrix, rest in zip(matrices, onward[1:], strict=True):
        states.append(int((matrix[states[-1]] + rest).argmin()))
    return states


def repair(roles: list[str | None], entry: int, leave: int) -> tuple[int, list[tuple[str, int]]]:
    """Cost and (action, emitted state) of each turn, from one state to another."""
    cost = np.full(4, NEVER, np.int64)
    cost[entry] = 0
    back = []
    for role in roles:
        through = cost[:, None] + STEPS[known(role)]
        back.append(through.argmin(axis=0))
        cost = np.minimum(through.min(axis=0), NEVER)
    total, state, actions = int(cost[leave]), leave, []
    for role, came in zip(reversed(roles), reversed(back), strict=True):
        before = int(came[state])
        actions.append((MOVES[known(role)][before, state][1], state))
        state = before
    return total, actions[::-1]


def opened(state: int) -> str:
    return f"<|im_start|>{ROLES[state - 1]}\n"


CLOSED = "<|im_end|>\n"


def plain(text: str | None) -> str:
    """A turn's text; it cannot open or close turns."""
    return (text or "").replace("<|im_", "<| im_")


def render(texts: list[str | None], actions: list[tuple[str, int]], entry: int, last: bool) -> tuple[str, int]:
    """Rendered turns of a block and how many begin in it. The turn open at its start is left
    open by the block before; the last block closes its own."""
    out, state, turns = [], entry, 0

    def turn(to: int) -> None:
        nonlocal state, turns
        if state != START:
            out.append(CLOSED)
        out.append(opened(to))
        state, turns = to, turns + 1

    for text, (action, to) in zip(texts, actions, strict=True):
        if action == "merge":
            out.append(SEPARATOR)
        else:
            if action == "insert":
                turn(BETWEEN[state, to])
            turn(to)
        out.append(plain(text))
    if last:
        for to in ENDINGS[state]:
            turn(to)
        out.append(CLOSED)
    return "".join(out), turns


def block_batches(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Sorted turns (conversation, role, text) to blocks, numbered in order of the sort."""
    number = TaskContext.get().partitionId() << 33
    conv, roles, texts, size = None, [], [], 0

    def block() -> pa.RecordBatch:
        matrix = block_matrix(roles).ravel().tolist()
        row = [conv, number, roles, texts, matrix]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

    for batch in batches:
        for own, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if roles and (own != conv or len(roles) >= BLOCK_TURNS or size >= BLOCK_CHARACTERS):
                yield block()
                number, roles, texts, size = number + 1, [], [], 0
            conv = own
            roles.append(role)
            texts.append(text)
            size += len(text or "")
    if roles:
        yield block()


def state_batches(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Matrices (conversation, block, matrix), sorted, to the states around each block."""
    conv, blocks, matrices = None, [], []

    def solved() -> pa.RecordBatch:
        states, many = block_states(matrices), len(blocks)
        rows = [[conv] * many, blocks, list(range(many)), states[:-1], states[1:], [i == many - 1 for i in range(many)]]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, schema, strict=True)], schema=schema)

    for batch in batches:
        for own, block, matrix in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if blocks and own != conv:
                yield solved()
                blocks, matrices = [], []
            conv = own
            blocks.append(block)
            matrices.append(np.array(matrix, np.int64).reshape(4, 4))
    if blocks:
        yield solved()


def render_batches(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            cost, actions = repair(r["roles"], r["entry"], r["leave"])
            text, turns = render(r["texts"], actions, r["entry"], r["last"])
            kinds = [a for a, _ in actions]
            ending = len(ENDINGS[r["leave"]]) if r["last"] else 0
            relabelled = sum(ROLES[s - 1] != role for role, (_, s) in zip(r["roles"], actions, strict=True))
            rows.append((
                r["conv"], r["part"], len(kinds), turns, cost + INSERT * ending, kinds.count("merge"),
                relabelled, kinds.count("insert") + ending, text,
            ))
        columns = list(zip(*rows, strict=True)) if rows else [[]] * len(schema)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def format_chats(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """The rendered conversations: id, `part`, `given_turns`, `turns`, `cost`, `merged`,
    `relabelled`, `inserted`, `rendered`.

    A conversation of up to 256 turns (and about a million characters) is one row; a longer one is several,
    whose `rendered` texts joined in order of `part` are the conversation, and whose costs
    add up to the least. Turns are dealt by ranges of conversation and turn, so a very long
    conversation spreads over tasks; only one matrix of 16 numbers per block meets in one.

    Merging costs 1, an empty turn 2, a relabel 3; of equally cheap repairs one is chosen by
    fixed order. Roles other than system, user and assistant, null too, need a relabel. Null
    texts are empty; texts cannot open or close turns. Turns are ordered by turn, null
    first, ties by role and text; repeated rows are turns of their own. Rows with a null
    conversation are one conversation. Other columns are not read; an empty table gives an
    empty result.
    """
    kind = turns.schema[conv_col].dataType
    rows = turns.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("_turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text")
    )
    order = ["conv", "_turn", "role", F.xxhash64("text"), "text"]
    # Whole texts would be sampled as keys; their hash deals them out as well.
    dealt = rows.repartitionByRange(*order[:-1]).sortWithinPartitions(*order).select("conv", "role", "text")
    block = struct(
        conv=kind, block=T.LongType(), roles=T.ArrayType(T.StringType()), texts=T.ArrayType(T.StringType()),
        matrix=T.ArrayType(T.LongType()),
    )
    blocks = keep(dealt.mapInArrow(partial(block_batches, schema=to_arrow_schema(block)), block), "turns")
    state = struct(
        _conv=kind, _block=T.LongType(), part=T.LongType(), entry=T.LongType(), leave=T.LongType(), last=T.BooleanType()
    )
    matrices = blocks.select("conv", "block", "matrix").repartition("conv").sortWithinPartitions("conv", "block")
    states = matrices.mapInArrow(partial(state_batches, schema=to_arrow_schema(state)), state)
    placed = blocks.drop("matrix").join(states.drop("_conv"), F.col("block") == F.col("_block")).drop("block", "_block")
    result = struct(
        **{conv_col: kind}, part=T.LongType(), given_turns=T.LongType(), turns=T.LongType(), cost=T.LongType(),
        merged=T.LongType(), relabelled=T.LongType(), inserted=T.LongType(), rendered=T.StringType(),
    )
    return placed.mapInArrow(partial(render_batches, schema=to_arrow_schema(result)), result)
