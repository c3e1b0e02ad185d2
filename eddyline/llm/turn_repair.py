"""Conversation structure repair by a dynamic program with square-root checkpoints.

A sound conversation is empty, or an optional system turn and then pairs of a user and an assistant
turn.  Each turn is kept (0), given the role user or assistant (2) or deleted (3), and empty turns of
either role are inserted (2) anywhere; blank turns and repeats of an earlier role and text must be
deleted, and a turn that stays although it ends without ``. ! ?`` costs 1 more.  Of the cheapest edits
those whose initials (D, I, K, R) come first as ASCII text are taken.

1. One range exchange brings the turns into order, so that a conversation lies in as many partitions
   as it fills; its part in one partition is a piece.  A piece's turns are one byte each.
2. A piece is a linear map of cost vectors (four states) from its end to its start.  Pieces of one
   conversation, at most one for each partition, are chained backwards by these maps.
3. Inside a piece the backward vectors are kept only at about sqrt(n) checkpoints; walking forward,
   each block is computed again from the checkpoint behind it, and the first letter whose step is
   tight is taken.  Pieces behind the first are walked from all four states; a chain of the exits
   tells which walk counts.
4. The letters of a piece meet its turns again, side by side in one sorted stream.

``repair`` gives one row per turn and inserted turn, ``digests`` one per conversation.  No step holds
more than the bytes of one piece; only the hash of a whole conversation, which is sequential by nature,
reads its rows in one task, as a stream.

Turns are in order of their number, nulls first, then role, the first 64 characters of the text, and a
hash of it.  Rows of a null conv_id are one conversation.  A null role or text is one blank.  The
initial of a role is its first character; an empty role has none and is never kept.  Other columns are
left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import pairwise
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddyline.llm.chat import per_group
from eddyline.llm.tables import written

DELETE, INSERT, REROLE, TRUNCATION = 3, 2, 2, 1
NO_FAULT, BLANK, DUPLICATE, TRUNCATED = range(4)
FAULTS = [None, "blank", "duplicate", "truncated"]

# States: before any turn, after the system turn, after a user's, after an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state that a turn of a new role leads to, and what an own role leads to where it may stand.
TURNED = (USER, USER, ASSISTANT, USER)
KEPT = {
    SYSTEM: {START: SYSTEM},
    USER: {START: USER, SYSTEM: USER, ASSISTANT: USER},
    ASSISTANT: {USER: ASSISTANT},
}
ROLES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}

_FAR = 1 << 50
Costs = tuple[int, int, int, int]


def _with_inserts(costs: list[int]) -> Costs:
    user = min(costs[USER], INSERT + costs[ASSISTANT])
    assistant = min(costs[ASSISTANT], INSERT + costs[USER])
    return min(costs[START], INSERT + user), min(costs[SYSTEM], INSERT + user), user, assistant


#: Costs behind the last turn.
END = _with_inserts([0, _FAR, _FAR, 0])


def _stays(tag: int) -> bool:
    return tag >> 2 not in (BLANK, DUPLICATE)


@lru_cache(1 << 14)
def _before(tag: int, after: Costs) -> Costs:
    """Least costs from each state ahead of a turn, given those behind it."""
    costs = [DELETE + c for c in after]
    if _stays(tag):
        extra = TRUNCATION * (tag >> 2 == TRUNCATED)
        for state in range(4):
            costs[state] = min(costs[state], REROLE + extra + after[TURNED[state]])
        for state, to in KEPT.get(tag & 3, {}).items():
            costs[state] = min(costs[state], extra + after[to])
    return _with_inserts(costs)


def before(tag: int, after: Costs) -> Costs:
    # Vectors less their least number are few, so nearly all steps are looked up.
    least = min(after)
    costs = _before(tag, tuple(_FAR if c >= _FAR else c - least for c in after))
    return tuple(_FAR if c >= _FAR else c + least for c in costs)


def backward(tags: bytes, costs: Costs) -> Costs:
    for tag in reversed(tags):
        costs = before(tag, costs)
    return costs


def matrix_of(tags: bytes) -> list[int]:
    """Costs from each state at the start to each state at the end of a piece, ends first."""
    found: list[int] = []
    for end in range(4):
        found += backward(tags, tuple(_FAR * (state != end) for state in range(4)))
    return found


def through(matrix: list[int], end: Costs) -> Costs:
    return tuple(min(matrix[4 * to + q] + end[to] for to in range(4)) for q in range(4))


class Walk:
    """The least tight edits of a piece, from checkpoints of its backward costs."""

    def __init__(self, tags: bytes, end: Costs, last: bool):
        self.tags, self.last, self.every = tags, last, isqrt(len(tags)) + 1
        self.marks = [end]
        for start in reversed(range(0, len(tags), self.every)):
            self.marks.append(backward(tags[start : start + self.every], self.marks[-1]))
        self.marks.reverse()

    def start_cost(self) -> int:
        return self.marks[0][START]

    def edits(self, state: int) -> tuple[str, int]:
        """The initials of the edits from a state, and the state they end in."""
        letters: list[str] = []
        for mark, start in enumerate(range(0, len(self.tags), self.every)):
            block = self.tags[start : start + self.every]
            costs = [self.marks[mark + 1]]
            for tag in reversed(block):
                costs.append(before(tag, costs[-1]))
            costs.reverse()
            for at, tag in enumerate(block):
                letter = ""
                while letter in ("", "I"):
                    letter, state = self._step(tag, costs[at], costs[at + 1], state)
                    letters.append(letter)
        if self.last:
            while self.marks[-1][state]:
                letters.append("I")
                state = TURNED[state]
        return "".join(letters), state

    @staticmethod
    def _step(tag: int, now: Costs, after: Costs, state: int) -> tuple[str, int]:
        cost, turned = now[state], TURNED[state]
        if DELETE + after[state] == cost:
            return "D", state
        if INSERT + now[turned] == cost:
            return "I", turned
        extra = TRUNCATION * (tag >> 2 == TRUNCATED)
        kept = KEPT.get(tag & 3, {}).get(state)
        if kept is not None and _stays(tag) and extra + after[kept] == cost:
            return "K", kept
        return "R", turned


# -- turns in order -------------------------------------------------------------------------------


def _text_of(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def damaged(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with faults that the crc32 of ``conv_id:turn`` chooses."""
    draw = F.crc32(F.concat(_text_of("conv_id"), F.lit(":"), _text_of("turn"))) % 20
    rows = turns.select(
        "conv_id", "turn", _text_of("role").alias("role"), _text_of("text").alias("text"), draw.alias("draw")
    )
    text = F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.regexp_replace("text", "[.!?]", ""))
    copies = F.when(F.col("draw") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.where("draw != 0").select(
        "conv_id", "turn",
        F.when(F.col("draw") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.otherwise(F.col("text")).alias("text"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


_WHITE = r"\x20\x09-\x0D"


def _in_order(turns: DataFrame) -> DataFrame:
    """The turns with ``place``, which counts through all of them in order, and ``part`` of it."""
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        _text_of("role").alias("role"),
        _text_of("text").alias("text"),
    ).select(
        "*",
        F.substring("text", 1, 64).alias("head"),
        F.md5("text").alias("key"),
        (~F.col("text").rlike(f"[^{_WHITE}]")).alias("blank"),
        (~F.col("text").rlike(rf"[.!?][{_WHITE}]*\z")).alias("open_end"),
        # Equal rows are told apart, so that very many of them share no partition.
        F.monotonically_increasing_id().alias("row"),
    )
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "head", "key", "row"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = rows.withColumn("place", F.monotonically_increasing_id()).drop("head", "row")
    return written(rows.withColumn("part", F.shiftright("place", 33)), "ordered-turns")


def _tags(rows: DataFrame) -> DataFrame:
    """``part, place, conv_id, tag``: initial and fault of every turn in one number."""
    firsts = rows.where("NOT blank").groupBy("conv_id", "role", "key").agg(
        F.min("place").alias("first"), F.count("*").alias("n")
    )
    firsts = firsts.where("n > 1").select(
        F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("key").alias("k"), "first"
    )
    own = rows.select("part", "place", "conv_id", "role", "key", "blank", "open_end")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("key") == F.col("k"))
    fault = (
        F.when(F.col("blank"), BLANK)
        .when(F.col("first") < F.col("place"), DUPLICATE)
        .when(F.col("open_end"), TRUNCATED)
        .otherwise(NO_FAULT)
    )
    letter = F.substring("role", 1, 1)
    initial = F.when(letter == "s", SYSTEM).when(letter == "u", USER).when(letter == "a", ASSISTANT)
    initial = initial.otherwise(0)
    return own.join(firsts, same, "left").select(
        "part", "place", "conv_id", (initial + 4 * fault).cast("int").alias("tag")
    )


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, int | None, bytes]]:
    """Part, conversation and tags of each piece of a sorted partition."""
    key, parts = None, []
    for batch in batches:
        keys = list(zip(batch.column("part").to_pylist(), batch.column("conv_id").to_pylist(), strict=True))
        tags = bytes(batch.column("tag").to_pylist())
        cuts = [k for k in range(1, len(keys)) if keys[k] != keys[k - 1]]
        for a, b in pairwise([0, *cuts, len(keys)] if keys else []):
            if parts and keys[a] != key:
                yield *key, b"".join(parts)
                parts = []
            key = keys[a]
            parts.append(tags[a:b])
    if parts:
        yield *key, b"".join(parts)


_PIECE = pa.schema(
    [
        ("conv_id", pa.int64()), ("part", pa.int64()), ("tags", pa.binary()),
        ("matrix", pa.list_(pa.int64())),
    ]
)
_BATCH_ROWS, _BATCH_BYTES = 2_000, 8 << 20


def _in_batches(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Batches bounded in rows and in the bytes of their texts."""
    some, size = [], 0

    def batch() -> pa.RecordBatch:
        arrays = [pa.array(c, f.type) for c, f in zip(zip(*some, strict=True), schema, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    for row in rows:
        some.append(row)
        size += sum(len(cell) for cell in row if isinstance(cell, str | bytes))
        if len(some) >= _BATCH_ROWS or size >= _BATCH_BYTES:
            yield batch()
            some, size = [], 0
    if some:
        yield batch()


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def found() -> Iterator[tuple]:
        # Only the first and the last piece of a partition may have a neighbour in another one.
        held, first = None, True
        for piece in _runs(batches):
            if held:
                yield piece_row(held, first or piece[0] != held[0])
                first = piece[0] != held[0]
            held = piece
        if held:
            yield piece_row(held, True)

    def piece_row(piece: tuple, edge: bool) -> tuple:
        part, conv_id, tags = piece
        return conv_id, part, tags, matrix_of(tags) if edge else None

    return _in_batches(found(), _PIECE)


def _ends(pieces: list[tuple]) -> Iterator[tuple]:
    """The costs behind each piece of one conversation."""
    end, found = END, []
    for conv_id, part, matrix in reversed(pieces):
        found.append((conv_id, part, list(end)))
        end = through(matrix, end)
    for k, row in enumerate(reversed(found)):
        yield *row, k == 0, k == len(found) - 1


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edits of each piece from every state that it may start in."""

    def found() -> Iterator[tuple]:
        for batch in batches:
            for row in batch.to_pylist():
                alone = row["end"] is None
                first, last = alone or row["first"], alone or row["last"]
                walk = Walk(row["tags"], END if alone else tuple(row["end"]), last)
                ways = [walk.edits(state) for state in ((START,) if first else range(4))]
                cost = walk.start_cost() if first else 0
                yield (
                    row["conv_id"], row["part"], row["tags"], [edits for edits, _ in ways],
                    [state for _, state in ways], cost, first and last,
                )

    return _in_batches(found(), _WALKED)


_WALKED = pa.schema(
    [
        ("conv_id", pa.int64()), ("part", pa.int64()), ("tags", pa.binary()),
        ("ways", pa.list_(pa.string())), ("exits", pa.list_(pa.int32())), ("cost", pa.int64()),
        ("alone", pa.bool_()),
    ]
)
_ENDS = pa.schema(
    [
        ("conv_id", pa.int64()), ("part", pa.int64()), ("end", pa.list_(pa.int64())),
        ("first", pa.bool_()), ("last", pa.bool_()),
    ]
)
_ENTRIES = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("entry", pa.int32())])


def _entries(pieces: list[tuple]) -> Iterator[tuple]:
    state = START
    for conv_id, part, exits in pieces:
        yield conv_id, part, state
        state = exits[state if len(exits) > 1 else START]


def _same_piece(left: DataFrame, right: DataFrame) -> DataFrame:
    right = right.withColumnsRenamed({"conv_id": "c", "part": "p"})
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p"))
    return left.join(right, same, "left").drop("c", "p")


def _plans(rows: DataFrame) -> DataFrame:
    """``conv_id, part, tags, entry, edits, cost`` of every piece."""
    tags = _tags(rows).repartition("part").sortWithinPartitions("part", "place").drop("place")
    pieces = tags.mapInArrow(_pieces, "conv_id long, part long, tags binary, matrix array<long>")
    pieces = written(pieces, "pieces")
    edges = pieces.where("matrix IS NOT NULL").select("conv_id", "part", "matrix")
    ends = per_group(
        edges, ["conv_id"], ["part"], _ends, _ENDS,
        "conv_id long, part long, end array<long>, first boolean, last boolean",
    )
    walked = _same_piece(pieces.drop("matrix"), ends).mapInArrow(
        _walked,
        "conv_id long, part long, tags binary, ways array<string>, exits array<int>, cost long, alone boolean",
    )
    walked = written(walked, "walks")
    entries = per_group(
        walked.where("NOT alone").select("conv_id", "part", "exits"), ["conv_id"], ["part"],
        _entries, _ENTRIES, "conv_id long, part long, entry int",
    )
    entry = F.coalesce("entry", F.lit(START))
    way = F.when(F.size("ways") > 1, entry).otherwise(0)
    return _same_piece(walked, entries).select(
        "conv_id", "part", "tags", entry.alias("entry"), F.col("ways")[way].alias("edits"), "cost"
    )


# -- edits and turns side by side -----------------------------------------------------------------

_EDIT_DDL = (
    "conv_id long, part long, step long, turn long, source_role string, fault string, edit string, "
    "cost int, role string, text string"
)
_EDIT = pa.schema(
    [
        ("conv_id", pa.int64()), ("part", pa.int64()), ("step", pa.int64()), ("turn", pa.int64()),
        ("source_role", pa.string()), ("fault", pa.string()), ("edit", pa.string()),
        ("cost", pa.int32()), ("role", pa.string()), ("text", pa.string()),
    ]
)


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*[column.to_pylist() for column in batch.columns], strict=True)

    def found() -> Iterator[tuple]:
        tags, edits, at, step, state = b"", "", 0, 0, START

        def inserts(conv_id: int | None, part: int) -> Iterator[tuple]:
            nonlocal step, state
            while step < len(edits) and edits[step] == "I":
                state = TURNED[state]
                yield conv_id, part, step, None, None, None, "I", INSERT, ROLES[state], ""
                step += 1

        for conv_id, part, place, turn, role, text, *plan in rows():
            if place < 0:
                (tags, edits, state), at, step = plan, 0, 0
                continue
            yield from inserts(conv_id, part)
            letter, tag, kept = edits[step], tags[at], (None, None)
            cost = DELETE
            if letter != "D":
                if letter == "K":
                    state, kept, cost = KEPT[tag & 3][state], (role, text), 0
                else:
                    state = TURNED[state]
                    kept, cost = (ROLES[state], text), REROLE
                cost += TRUNCATION * (tag >> 2 == TRUNCATED)
            yield conv_id, part, step, turn, role, FAULTS[tag >> 2], letter, cost, *kept
            at, step = at + 1, step + 1
            if at == len(tags):
                yield from inserts(conv_id, part)

    return _in_batches(found(), _EDIT)


def repair(turns: DataFrame) -> DataFrame:
    """One row for each turn of ``turns`` (``conv_id, turn, role, text``) and each inserted turn.

    ``conv_id, part, step, turn, source_role, fault, edit, cost, role, text``: in order of ``part, step``
    within a conversation; ``role`` and ``text`` are those of the repaired conversation, null for deleted
    turns.  ``fault`` is blank, duplicate, truncated or null, ``edit`` D, I, K or R.
    """
    rows = _in_order(turns)
    plans = _plans(rows).select("conv_id", "part", "tags", "edits", "entry")
    none = [F.lit(None).cast(t).alias(c) for c, t in (("tags", "binary"), ("edits", "string"), ("entry", "int"))]
    first = plans.withColumn("place", F.lit(-1).cast("long"))
    both = rows.select("conv_id", "part", "place", "turn", "role", "text", *none).unionByName(
        first, allowMissingColumns=True
    )
    both = both.repartition("conv_id", "part").sortWithinPartitions("conv_id", "part", "place")
    return both.mapInArrow(_edited, _EDIT_DDL)


_DIGEST = pa.schema(
    [
        ("conv_id", pa.int64()), ("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()),
        ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()),
        ("audit", pa.string()), ("repaired_sha256", pa.string()),
    ]
)
_DIGEST_DDL = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string"
)


class _Digest:
    """What is told of one conversation, row by row."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.audit, self.hash, self.any = conv_id, [], hashlib.sha256(), False
        self.faults, self.illegal, self.cost = dict.fromkeys(FAULTS, 0), 0, 0
        self.initial, self.low, self.high, self.turns = None, None, None, 0

    def add(self, turn, source_role, fault, edit, cost, role, text) -> None:
        self.audit.append(edit)
        self.cost += cost
        if edit != "D":
            self.hash.update(f"{'\n' if self.any else ''}{role}:{text}".encode())
            self.any = True
        if edit == "I":
            return
        self.faults[fault] += 1
        initial = source_role[:1]
        self.illegal += self.initial is not None and self.initial + initial not in LEGAL
        self.initial = initial
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        faults = (self.faults[f] for f in FAULTS[1:])
        audit = "".join(self.audit)
        return self.conv_id, gaps, *faults, self.illegal, self.cost, audit, self.hash.hexdigest()


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def found() -> Iterator[tuple]:
        now = None
        for batch in batches:
            for conv_id, *row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if now is None or conv_id != now.conv_id:
                    if now is not None:
                        yield now.row()
                    now = _Digest(conv_id)
                now.add(*row)
        if now is not None:
            yield now.row()

    return _in_batches(found(), _DIGEST)


def digests(edits: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row for each conv_id of ``conversations`` about its rows of ``edits``, as ``repair`` gives them.

    ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.  Conversations
    without a row of edits have zeros, no audit, and the hash of nothing.
    """
    ordered = edits.repartition("conv_id").sortWithinPartitions("conv_id", "part", "step").select(
        "conv_id", "turn", "source_role", "fault", "edit", "cost", "role", "text"
    )
    told = ordered.mapInArrow(_digested, _DIGEST_DDL).withColumnRenamed("conv_id", "c")
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    both = ids.join(told, F.col("conv_id").eqNullSafe(F.col("c")), "left").drop("c")
    nothing = hashlib.sha256().hexdigest()
    return both.fillna("", ["audit"]).fillna(nothing, ["repaired_sha256"]).fillna(
        0, ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    )
