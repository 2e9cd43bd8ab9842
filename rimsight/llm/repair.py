"""Conversation structure repair: the cheapest edits to alternating turns, by an integer-minimum dynamic programme."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rimsight.llm.columns import BLANKS
from rimsight.llm.shared import held, ship_package

# Costs of the edits, and their audit letters in ASCII order as digits from 1.
LETTERS = "DIKR"
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
BITS = 3
_D, _I, _K, _R = (LETTERS.index(c) + 1 for c in "DIKR")

# States of the role grammar (s?(ua)+)?: nothing yet, after s, after u, after a. Whole conversations end in the first or last.
START, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
FILLED = (USER, USER, ASSISTANT, USER)  # the state after an inserted or renamed message
ROLE = {USER: "user", ASSISTANT: "assistant"}
ENDS = (START, ASSISTANT)
LEGAL = {"su", "ua", "au"}

# A conversation is worked on in blocks of so many rows and characters (a longer text is a block of its own).
BLOCK_ROWS = 128
BLOCK_CHARS = 1 << 20

_BLOCK_SCHEMA = (
    "conv_id {id}, part int, seq long, width long, weights array<binary>, items array<struct<role:string,text:string>>, "
    "first string, last string, illegal long, blank long, duplicate long, truncated long, turns long, low long, high long"
)


def weights(steps: list[tuple[str, bool, bool]]) -> tuple[int, list[int | None]]:
    """Width in letters, and for each entry and exit state (4 x 4) the least weight of a run of rows.

    A step is a row's role initial, whether it must be deleted and whether it is truncated. A
    weight is one whole number: the cost in the high digits, below them the audit letters
    from the left with zeros after the last, so the least number is the cheapest edit script,
    and of equal ones the least in ASCII order. The programme runs backwards over (row,
    state): an edit adds its cost, and its letter moves those after it one digit on. Between
    two rows at most two messages are inserted; more never pay.

    Two scripts over the same rows that cost the same are never one the beginning of the
    other, since the longer would end in insertions that cost more. So weights of
    neighbouring runs can be put together (``joined``) whatever comes after.
    """
    width = 3 * len(steps) + 2
    low = BITS * width
    mask, top = (1 << low) - 1, low - BITS

    def edit(cost: int, letter: int, rest: int) -> int:
        after = rest & mask
        return rest - after + (after >> BITS) + (cost << low) + (letter << top)

    def least(a: int | None, b: int | None) -> int | None:
        return b if a is None else a if b is None else min(a, b)

    def filled(value: list[int | None]) -> list[int | None]:
        for _ in range(2):
            value = [least(v, None if value[to] is None else edit(INSERT, _I, value[to])) for v, to in zip(value, FILLED)]
        return value

    out: list[int | None] = [None] * 16
    for leave in range(4):
        value = filled([0 if q == leave else None for q in range(4)])
        for initial, must, cut in reversed(steps):
            moved: list[int | None] = []
            for q in range(4):
                best = None if value[q] is None else edit(DELETE, _D, value[q])
                if not must:
                    more = TRUNCATED if cut else 0
                    to = FOLLOWS.get((q, initial))
                    if to is not None and value[to] is not None:
                        best = least(best, edit(more, _K, value[to]))
                    if value[FILLED[q]] is not None:
                        best = least(best, edit(REROLE + more, _R, value[FILLED[q]]))
                moved.append(best)
            value = filled(moved)
        for enter in range(4):
            out[4 * enter + leave] = value[enter]
    return width, out


def _split(weight: int, width: int) -> tuple[int, int, int]:
    """Cost, digits and number of letters of a weight."""
    digits = weight & ((1 << BITS * width) - 1)
    empty = ((digits & -digits).bit_length() - 1) // BITS if digits else width
    return weight >> BITS * width, digits, width - empty


def _followed(a: int | None, wa: int, b: int | None, wb: int) -> int | None:
    if a is None or b is None:
        return None
    cost, digits, n = _split(a, wa)
    more, after, _ = _split(b, wb)
    return (cost + more) << BITS * (wa + wb) | digits << BITS * wb | after << BITS * (wa - n)


def joined(wa: int, a: list[int | None], wb: int, b: list[int | None]) -> tuple[int, list[int | None]]:
    """Weights of one run of rows after another."""
    out: list[int | None] = []
    for enter in range(4):
        for leave in range(4):
            ways = [_followed(a[4 * enter + j], wa, b[4 * j + leave], wb) for j in range(4)]
            out.append(min((w for w in ways if w is not None), default=None))
    return wa + wb, out


def letters(weight: int, width: int) -> str:
    _, digits, n = _split(weight, width)
    return "".join(LETTERS[(digits >> BITS * (width - 1 - k) & 7) - 1] for k in range(n))


def paths(runs: list[tuple[int, list[int | None]]]) -> tuple[int, list[tuple[int, str]]]:
    """Cost of a whole conversation, and each run's entry state and letters.

    Runs are put together two by two, so long conversations cost their length times the
    logarithm of their runs; the choice is then read from the top down.
    """
    levels = [runs]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([joined(*below[k], *below[k + 1]) if k + 1 < len(below) else below[k] for k in range(0, len(below), 2)])
    width, whole = levels[-1][0]
    weight, leave = min((whole[e], e) for e in ENDS if whole[e] is not None)
    chosen = [(START, leave)]
    for below in reversed(levels[:-1]):
        finer = []
        for k, (enter, leave) in enumerate(chosen):
            if 2 * k + 1 == len(below):
                finer.append((enter, leave))
                continue
            (wa, a), (wb, b) = below[2 * k], below[2 * k + 1]
            ways = [(_followed(a[4 * enter + j], wa, b[4 * j + leave], wb), j) for j in range(4)]
            middle = min((w, j) for w, j in ways if w is not None)[1]
            finer += [(enter, middle), (middle, leave)]
        chosen = finer
    return weight >> BITS * width, [(enter, letters(w[4 * enter + leave], n)) for (n, w), (enter, leave) in zip(runs, chosen)]


def messages(items: list[dict], enter: int, audit: str) -> list[tuple[str, str]]:
    """The repaired messages of a run: its rows, the state it is entered in, and its letters."""
    out, at, state = [], 0, enter
    for letter in audit:
        item = None
        if letter != "I":
            item = items[at]
            at += 1
        if letter == "D":
            continue
        if letter == "K":
            state = FOLLOWS[state, item["role"][:1]]
            out.append((item["role"], item["text"]))
        else:
            state = FILLED[state]
            out.append((ROLE[state], item["text"] if item else ""))
    return out


@dataclass
class _Run:
    """A block being filled."""

    steps: list[tuple[str, bool, bool]] = field(default_factory=list)
    items: list[dict | None] = field(default_factory=list)
    chars: int = 0
    illegal: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    turns: int = 0
    low: int | None = None
    high: int | None = None

    def add(self, turn: int | None, role: str, text: str | None, blank: bool) -> None:
        initial = role[:1]
        cut = text is not None and not blank and text.rstrip(BLANKS)[-1] not in ".!?"
        must = blank or text is None
        self.blank += blank
        self.duplicate += text is None and not blank
        self.truncated += cut
        if self.steps:
            self.illegal += self.steps[-1][0] + initial not in LEGAL
        if turn is not None:
            self.turns += turn != self.high
            self.low = turn if self.low is None else self.low
            self.high = turn
        self.steps.append((initial, must, cut))
        self.items.append(None if must else {"role": role, "text": text})
        self.chars += 0 if must else len(text)

    def row(self, conv_id, part: int, seq: int) -> tuple:
        width, found = weights(self.steps)
        packed = [None if w is None else w.to_bytes((w.bit_length() + 7) // 8, "big") for w in found]
        return (
            conv_id, part, seq, width, packed, self.items, self.steps[0][0], self.steps[-1][0],
            self.illegal, self.blank, self.duplicate, self.truncated, self.turns, self.low, self.high,
        )


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows in conversation order, range-partitioned: a text only where its message occurs first, repeats as counts.

    Both groupings are combined before their shuffle, so a message repeated very often is one
    row a task.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    tidy = rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), text.alias("text")
    )
    firsts = tidy.groupBy("conv_id", "role", "text").agg(F.max(F.col("turn").isNull()).alias("untimed"), F.min("turn").alias("turn"))
    mark = F.md5(F.col("text").cast("binary"))
    is_blank = F.btrim("text", F.lit(BLANKS)) == ""
    first = firsts.select(
        "conv_id", F.when(~F.col("untimed"), F.col("turn")).alias("turn"), "role", mark.alias("mark"), "text", is_blank.alias("blank"), F.lit(1).cast("long").alias("copies")
    )
    marked = tidy.select("conv_id", "turn", "role", mark.alias("mark"), is_blank.alias("blank"))
    all_ = marked.groupBy("conv_id", "turn", "role", "mark", "blank").agg(F.count(F.lit(1)).alias("copies"))
    both = first.unionByName(all_.withColumn("text", F.lit(None).cast("string")))
    keys = ["conv_id", "turn", "role", "mark"]
    return both.repartitionByRange(*keys).sortWithinPartitions(*keys, F.col("text").isNull())


def _blocks(rows: DataFrame, block_rows: int) -> DataFrame:
    kind = rows.schema["conv_id"].dataType.simpleString()
    names = _BLOCK_SCHEMA.format(id=kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        current, conv, before, schema = _Run(), None, None, None
        done: list[tuple] = []

        def packed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)

        for batch in batches:
            if schema is None:
                schema = _arrow_blocks(batch.schema.field("conv_id").type)
            for row in batch.to_pylist():
                if current.steps and row["conv_id"] != conv:
                    done.append(current.row(conv, part, seq))
                    current, seq = _Run(), seq + 1
                conv = row["conv_id"]
                key = (conv, row["turn"], row["role"], row["mark"])
                copies = row["copies"] - (row["text"] is None and key == before)  # its first copy came just before, with the text
                before = key if row["text"] is not None else None
                for _ in range(copies):
                    current.add(row["turn"], row["role"], row["text"], row["blank"])
                    if len(current.steps) >= block_rows or current.chars >= BLOCK_CHARS:
                        done.append(current.row(conv, part, seq))
                        current, seq = _Run(), seq + 1
                if len(done) >= 256:
                    yield packed()
                    done.clear()
        if current.steps:
            done.append(current.row(conv, part, seq))
        if done:
            yield packed()

    return _ordered(rows).mapInArrow(run, names)


def _arrow_blocks(kind: pa.DataType) -> pa.Schema:
    item = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
    texts = {"first", "last"}
    special = {"conv_id": kind, "part": pa.int32(), "weights": pa.list_(pa.binary()), "items": item}
    names = [f.split(" ")[0] for f in _BLOCK_SCHEMA.format(id="x").replace("struct<role:string,text:string>", "s").split(", ")]
    return pa.schema([(n, special.get(n, pa.string() if n in texts else pa.int64())) for n in names])


def _decided(blocks: DataFrame) -> DataFrame:
    """conv_id, part, seq with the block's entry state and letters, and on each block the conversation's cost."""
    kind = blocks.schema["conv_id"].dataType.simpleString()
    narrow = blocks.select("conv_id", "part", "seq", "width", "weights").repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[dict] = []

        def solve(kind: pa.DataType) -> pa.RecordBatch:
            runs = [(r["width"], [None if w is None else int.from_bytes(w, "big") for w in r["weights"]]) for r in waiting]
            cost, found = paths(runs)
            n = len(waiting)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([waiting[0]["conv_id"]] * n, kind), pa.array([r["part"] for r in waiting], pa.int32()), pa.array([r["seq"] for r in waiting], pa.int64()),
                    pa.array([e for e, _ in found], pa.int32()), pa.array([a for _, a in found], pa.string()), pa.array([cost] * n, pa.int64()),
                ],
                ["conv_id", "part", "seq", "enter", "audit", "cost"],
            )

        id_type, solved = None, []
        for batch in batches:
            id_type = batch.schema.field("conv_id").type
            for row in batch.to_pylist():
                if waiting and waiting[0]["conv_id"] != row["conv_id"]:
                    solved.append(solve(id_type))
                    waiting = []
                waiting.append(row)
            if solved:
                yield pa.Table.from_batches(solved).combine_chunks().to_batches()[0]
                solved = []
        if waiting:
            yield solve(id_type)

    return narrow.mapInArrow(run, f"conv_id {kind}, part int, seq long, enter int, audit string, cost long")


def _solved(conversations: DataFrame, block_rows: int) -> DataFrame:
    """Blocks in conversation order, each after its decision, all blocks of a conversation in one task's stream."""
    ship_package(conversations.sparkSession)
    blocks = held(_blocks(conversations, block_rows), "conversation-blocks")
    decided = held(_decided(blocks), "conversation-edits")
    both = blocks.drop("width", "weights").unionByName(decided, allowMissingColumns=True)
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq", F.col("enter").isNull())


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, dict, list[tuple[str, str]], pa.DataType]]:
    decision = None
    for batch in batches:
        for at in range(0, len(batch), 512):
            for row in batch.slice(at, 512).to_pylist():
                if row["enter"] is not None:
                    decision = row
                else:
                    yield row, decision, messages(row["items"], decision["enter"], decision["audit"]), batch.schema.field("conv_id").type


def repaired(conversations: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """conv_id, n (from 0), role and text of every message of the repaired conversations."""
    kind = conversations.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, n, fresh = None, 0, True
        for row, _, found, id_type in _pieces(batches):
            if fresh or row["conv_id"] != conv:
                conv, n, fresh = row["conv_id"], 0, False
            size = len(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array([conv] * size, id_type), pa.array(range(n, n + size), pa.int64()), *(pa.array([m[k] for m in found], pa.string()) for k in range(2))],
                ["conv_id", "n", "role", "text"],
            )
            n += size

    return _solved(conversations, block_rows).mapInArrow(run, f"conv_id {kind}, n long, role string, text string")


def reports(conversations: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row for each conversation: faults, cost, audit and digest of the repaired messages.

    Reads conv_id, turn, role and text. Rows are taken by turn (nulls first), those of one
    turn by role and a digest of the text, so equal rows are neighbours. Null roles and texts
    are one space; a null conv_id is a conversation of its own; a role without a first
    letter, or with one other than s, u and a, can only be renamed or deleted. Faults: blank,
    else duplicate (role and text occurred before), else truncated. ``gaps`` are the turn
    numbers that lack between the least and the largest, ``illegal`` the neighbours whose
    roles do not follow each other.

    Any length: a conversation is cut into blocks in range-partitioned order, a block's
    weights hold its cheapest edits for every state before and after it, blocks are put
    together from these, and the texts then pass once more in order for the digest, which is
    sequential by nature but only a stream to its task. A text that occurs in different
    conversations or turns is told apart by MD5 only for its place among equal turns.
    An empty table gives no rows; columns of other names are not read.
    """
    kind = conversations.schema["conv_id"].dataType.simpleString()
    sums = ["blank", "duplicate", "truncated"]
    out = ["conv_id", "gaps", *sums, "illegal", "cost", "audit", "repaired_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict | None = None
        done: list[list] = []

        def finish() -> list:
            gaps = total["high"] - total["low"] + 1 - total["turns"] if total["low"] is not None else 0
            return [total["conv_id"], gaps, *(total[s] for s in sums), total["illegal"], total["cost"], "".join(total["audit"]), total["digest"].hexdigest()]

        def packed(id_type: pa.DataType) -> pa.RecordBatch:
            types = [id_type, *[pa.int64()] * 6, pa.string(), pa.string()]
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], out)
            done.clear()
            return batch

        for row, decision, found, id_type in _pieces(batches):
            if total is None or row["conv_id"] != total["conv_id"]:
                if total is not None:
                    done.append(finish())
                    if len(done) >= 512:
                        yield packed(id_type)
                total = {"conv_id": row["conv_id"], "cost": decision["cost"], "audit": [], "digest": hashlib.sha256(), "some": False, "last": None}
                total |= dict.fromkeys([*sums, "illegal", "turns"], 0) | {"low": None, "high": None}
            for name in sums:
                total[name] += row[name]
            total["illegal"] += row["illegal"] + (total["last"] is not None and total["last"] + row["first"] not in LEGAL)
            total["last"] = row["last"]
            if row["low"] is not None:
                total["turns"] += row["turns"] - (row["low"] == total["high"])
                total["low"] = row["low"] if total["low"] is None else total["low"]
                total["high"] = row["high"]
            total["audit"].append(decision["audit"])
            for role, text in found:
                total["digest"].update((("\n" if total["some"] else "") + f"{role}:{text}").encode())
                total["some"] = True
        if total is not None:
            done.append(finish())
            yield packed(id_type)

    types = {"conv_id": kind, "audit": "string", "repaired_sha256": "string"}
    return _solved(conversations, block_rows).mapInArrow(run, ", ".join(f"{c} {types.get(c, 'long')}" for c in out))
