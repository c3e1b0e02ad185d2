"""Chat formatting with the cheapest repair of the order of roles.

A legal conversation is an optional system turn, then user and assistant turns in alternation, the
last by the assistant.  Each turn is kept, relabelled or merged into the turn before it, and empty
turns may be inserted; dynamic programming over the automaton of the last role finds the labels of
the smallest total cost.  Ties go to the label that comes first in ``LABELS``, from the last turn
backwards.

A turn's effect on the costs is a small matrix from state to state, and a run of turns is the
min-plus product of theirs.  So a conversation is cut into runs of ``RUN_TURNS`` turn numbers: runs
are summed up side by side, the summaries of a conversation are solved in order, and each run is then
labelled between its known ends.  No task holds more of a long conversation than one run or one
summary per run.

``repair`` returns one row per source turn with its piece of the rendered text; pieces in order of
``run, place`` (turn, then role, then text) make up the conversation.  ``render`` joins them, for conversations that fit into
a cell.

Roles are compared without case and outer blanks, with the usual aliases; other and null roles cost
less to relabel.  Null and empty texts render as nothing.  The opening of a control mark inside a text
gets a blank, so that no text can close its turn.  Rows of a null conv_id are one conversation; null
turn numbers come first; repeated rows are turns of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LABELS = ["system", "user", "assistant"]
START = 3  # the state before any turn; states are places in LABELS otherwise

# Names of roles in common data sets.
ALIASES = {
    "human": "user", "prompter": "user", "customer": "user",
    "bot": "assistant", "ai": "assistant", "model": "assistant", "gpt": "assistant",
    "developer": "system",
}

MERGE, RELABEL, NAME, INSERT = 1.0, 3.0, 1.5, 2.0
RUN_TURNS = 1024

_NEVER = np.inf
# Fewest empty turns to insert between a state and the next turn's label; START and the labels.
_INSERTED = {
    (START, 0): 0, (START, 1): 0, (START, 2): 1, (0, 1): 0, (0, 2): 1,
    (1, 1): 1, (1, 2): 0, (2, 1): 0, (2, 2): 1,
}
# What stands in those gaps, and what ends a conversation in each state.
_GAPS = {(START, 2): [1], (0, 2): [1], (1, 1): [2], (2, 2): [1]}
_ENDS = {0: [1, 2], 1: [2], 2: []}


def step_costs() -> np.ndarray:
    """Cost of a turn of a label after a state, relabelling aside: 4 states x 3 labels."""
    cost = np.full((4, 3), _NEVER)
    for (state, label), n in _INSERTED.items():
        cost[state, label] = n * INSERT
    for label in range(3):
        cost[label, label] = min(cost[label, label], MERGE)
    return cost


STEP = step_costs()
END = np.array([len(_ENDS[s]) * INSERT for s in range(3)])


def label_costs(roles: list[str | None]) -> np.ndarray:
    """Cost of each label for each turn."""
    out = np.full((len(roles), 3), NAME)
    for k, role in enumerate(roles):
        name = (role or "").strip().lower()
        name = ALIASES.get(name, name)
        if name in LABELS:
            out[k] = RELABEL
            out[k, LABELS.index(name)] = 0.0
    return out


def run_matrix(costs: np.ndarray) -> np.ndarray:
    """Cheapest way through a run, from each of 4 states to each of 3 labels."""
    through = np.full((4, 4), _NEVER)
    np.fill_diagonal(through, 0.0)
    for own in costs:
        after = (through[:, :, None] + STEP[None, :, :]).min(axis=1) + own[None, :]
        through = np.concatenate([after, np.full((4, 1), _NEVER)], axis=1)
    return through[:, :3]


def best_labels(costs: np.ndarray, entry: int, exit: int) -> list[int]:
    """The labels of a run between a known state and a known last label."""
    before = np.full(4, _NEVER)
    before[entry] = 0.0
    choices = []
    for own in costs:
        ways = before[:, None] + STEP
        choices.append(ways.argmin(axis=0))
        before = np.append(ways.min(axis=0) + own, _NEVER)
    labels, label = [], exit
    for chosen in reversed(choices):
        labels.append(label)
        label = int(chosen[label])
    return labels[::-1]


def ends_of_runs(matrices: list[np.ndarray]) -> tuple[list[int], float]:
    """The last label of each run in order, and the cost of the whole conversation."""
    before = np.full(4, _NEVER)
    before[START] = 0.0
    choices = []
    for matrix in matrices:
        ways = before[:, None] + matrix
        choices.append(ways.argmin(axis=0))
        before = np.append(ways.min(axis=0), _NEVER)
    total = before[:3] + END
    label, ends = int(total.argmin()), []
    for chosen in reversed(choices):
        ends.append(label)
        label = int(chosen[label])
    return ends[::-1], float(total.min())


def _opening(label: int) -> str:
    return f"<|{LABELS[label]}|>\n"


CLOSING = "<|end|>\n"


def groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[tuple]]:
    """Rows of a sorted partition that share their first columns; one group is held at a time."""
    group: list[tuple] = []
    for batch in batches:
        for row in zip(*[column.to_pylist() for column in batch.columns], strict=True):
            if group and row[:keys] != group[0][:keys]:
                yield group
                group = []
            group.append(row)
    if group:
        yield group


def batched(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    while some := list(islice(rows, 2000)):
        columns = zip(*some, strict=True)
        arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, schema=schema)


def per_group(df: DataFrame, keys: list[str], order: list[str], work, schema: pa.Schema, ddl: str):
    """``work(rows of a group)`` for every group, many groups in a task without a call for each."""
    sorted_rows = df.repartition(*keys).sortWithinPartitions(*keys, *order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return batched((row for g in groups(batches, len(keys)) for row in work(g)), schema)

    return sorted_rows.mapInArrow(run, ddl)


def _summary(run: list[tuple]) -> Iterator[tuple]:
    matrix = run_matrix(label_costs([role for _, _, _, role in run]))
    yield *run[0][:2], matrix.ravel().tolist()


def _solved(runs: list[tuple]) -> Iterator[tuple]:
    matrices = [np.array(matrix, float).reshape(4, 3) for _, _, matrix in runs]
    ends, _ = ends_of_runs(matrices)
    for k, (conv_id, run, _) in enumerate(runs):
        yield conv_id, run, START if k == 0 else ends[k - 1], ends[k], k == len(runs) - 1


def _labelled(run: list[tuple]) -> Iterator[tuple]:
    _, _, _, _, _, entry, exit, last = run[0]
    costs = label_costs([role for _, _, _, role, *_ in run])
    labels = best_labels(costs, entry, exit)
    state = entry
    for k, (label, row) in enumerate(zip(labels, run, strict=True)):
        conv_id, number, turn, role, text = row[:5]
        text = (text or "").replace("<|", "< |")
        # A merge is cheaper than the insertion that would allow a second turn of the label.
        merged = bool(state == label and STEP[state, label] == MERGE)
        gap = [] if merged else _GAPS.get((state, label), [])
        cost = STEP[state, label] + costs[k, label]
        piece = "\n\n" + text if merged else ""
        for part in () if merged else (*gap, label):
            piece += (CLOSING if state != START else "") + _opening(part)
            state = part
        piece += "" if merged else text
        if last and k == len(labels) - 1:
            piece += "".join(CLOSING + _opening(part) for part in _ENDS[label]) + CLOSING
            gap, cost = [*gap, *_ENDS[label]], cost + END[label]
        actions = ["relabel"] * bool(costs[k, label]) + ["merge"] * merged
        action = " and ".join(actions) or "keep"
        yield conv_id, number, turn, role, k, LABELS[label], action, len(gap), float(cost), piece


_SUMMARY = pa.schema(
    [("conv_id", pa.int64()), ("run", pa.int64()), ("matrix", pa.list_(pa.float64()))]
)
_SOLVED = pa.schema(
    [
        ("conv_id", pa.int64()), ("run", pa.int64()), ("entry", pa.int32()), ("exit", pa.int32()),
        ("last", pa.bool_()),
    ]
)
_LABELLED = pa.schema(
    [
        ("conv_id", pa.int64()), ("run", pa.int64()), ("turn", pa.int64()), ("role", pa.string()),
        ("place", pa.int32()), ("label", pa.string()), ("action", pa.string()),
        ("inserted", pa.int32()), ("cost", pa.float64()), ("piece", pa.string()),
    ]
)


def repair(turns: DataFrame, run_turns: int = RUN_TURNS) -> DataFrame:
    """``conv_id, run, place, turn, role, label, action, inserted, cost, piece`` for each row of ``turns``.

    ``turns`` has ``conv_id, turn, role, text``; ``inserted`` counts the empty turns that the piece
    contains besides its own, ``cost`` is the turn's part of the conversation's cost.
    """
    turns = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.coalesce(F.floor(F.col("turn") / run_turns), F.lit(-(1 << 60))).cast("long").alias("run"),
        F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"),
    )
    runs = ["conv_id", "run"]
    summaries = per_group(
        turns.select(*runs, "turn", "role"), runs, ["turn", "role"], _summary, _SUMMARY,
        "conv_id long, run long, matrix array<double>",
    )
    solved = per_group(
        summaries, ["conv_id"], ["run"], _solved, _SOLVED,
        "conv_id long, run long, entry int, exit int, last boolean",
    )
    ends = solved.select(F.col("conv_id").alias("c"), F.col("run").alias("r"), "entry", "exit", "last")
    placed = turns.join(ends, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("run") == F.col("r")))
    return per_group(
        placed.drop("c", "r"), runs, ["turn", "role", "text"], _labelled, _LABELLED,
        "conv_id long, run long, turn long, role string, place int, label string, action string, "
        "inserted int, cost double, piece string",
    )


def render(pieces: DataFrame) -> DataFrame:
    """``conv_id, cost, text``: one cell per conversation, so for conversations that fit into one."""
    order = F.sort_array(F.collect_list(F.struct("run", "place", "piece")))
    return pieces.groupBy("conv_id").agg(
        F.sum("cost").alias("cost"), F.array_join(order["piece"], "").alias("text")
    )
