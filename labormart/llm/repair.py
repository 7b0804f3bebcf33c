"""Repair of conversation structure, and the damage that it is tested with.

Rows are classed by Spark (initial of the role; blank, duplicate, truncated),
and the classes of a conversation are cut into blocks. Each block becomes one
move between the four states of :mod:`hirschberg`, the few blocks of a
conversation are solved first, then the rows of every block between the states
found. At the end the texts, in order and each block's edits before them, stream
through one hash a conversation; no conversation's texts are ever held whole.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labormart.llm.common import settle
from labormart.llm.hirschberg import CLASSES, CLOSING, INSERT, START, Solver, due, emit, ending, unit
from labormart.llm.turns import block_of, digest, in_order, part_of, part_starts, position

_SPACES = " \t\n\x0b\f\r"
_FULL = {"u": "user", "a": "assistant"}
#: Texts that go through the hash in one Arrow batch, at most so many rows.
_STOPS = (".", "!", "?")


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` with faults put in, by the CRC-32 of ``conv_id:turn``, modulo 20.

    0 drops a row, 1 empties its text, 2 takes ``.!?`` out of it, 3 repeats it,
    4 makes its role ``user``. A null role, text or turn counts as one space. Rows
    without ``conv_id`` are left out.
    """
    space = F.lit(" ")
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce(F.col("role").cast("string"), space).alias("role"), F.coalesce(F.col("text").cast("string"), space).alias("text")
    )
    rows = rows.withColumn("_fault", F.crc32(F.concat_ws(":", F.col("conv_id").cast("string"), F.coalesce(F.col("turn").cast("string"), space))) % 20).where("_fault <> 0")
    fault = F.col("_fault")
    rows = rows.withColumns(
        {
            "text": F.when(fault == 1, "").when(fault == 2, F.translate("text", "".join(_STOPS), "")).otherwise(F.col("text")),
            "role": F.when(fault == 4, "user").otherwise(F.col("role")),
        }
    )
    return rows.select("conv_id", "turn", "role", "text", F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy")).drop("_copy")


def _initial() -> Column:
    first = F.substring("role", 1, 1)
    return F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)


def _classed(ordered: DataFrame) -> DataFrame:
    """``(conv_id, block, place, classes)``: the rows of every block as one letter each.

    The first fault counts: blank, seen earlier, truncated. What was seen earlier
    is found by the first place of each role and text, a partial aggregate, so a
    turn that stands in a conversation a million times is no hot key.
    """
    firsts = ordered.groupBy("conv_id", "d1", "d2").agg(F.min("place").alias("place")).select("conv_id", "place", F.lit(True).alias("first_seen"))
    starts = part_starts(ordered).withColumnRenamed("part", "_part").withColumnRenamed("conv_id", "_conv")
    rows = ordered.select("conv_id", "place", "initial", "blank", "cut").join(firsts, ["conv_id", "place"], "left")
    kind = F.when(F.col("blank"), 2).when(F.col("first_seen").isNull(), 3).when(F.col("cut"), 1).otherwise(0)
    rows = rows.withColumn("class", F.substring(F.lit(CLASSES), F.col("initial") * 4 + kind + 1, F.lit(1)))
    rows = rows.join(starts, (F.col("conv_id") == F.col("_conv")) & (part_of() == F.col("_part")))
    blocks = rows.groupBy("conv_id", block_of(position()).alias("block")).agg(F.sort_array(F.collect_list(F.struct("place", "class"))).alias("rows"))
    return blocks.select("conv_id", "block", F.element_at("rows", 1)["place"].alias("place"), F.array_join("rows.class", "").alias("classes"))


def _roles_clash(left: str, right: str) -> bool:
    """Whether the initials of two neighbours, given by their classes, may not follow each other."""
    return (CLASSES.index(left) // 4, CLASSES.index(right) // 4) not in ((0, 1), (1, 2), (2, 1))


_COUNTS = ["blank", "duplicate", "truncated", "illegal"]


def _as_moves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    solver = Solver()
    for batch in batches:
        made = []
        for block, classes in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            kinds = [sum(classes.count(CLASSES[i * 4 + k]) for i in range(4)) for k in range(4)]
            clashes = sum(n * _roles_clash(*pair) for pair, n in _pairs(classes).items())
            moves = solver.block_moves(classes, [START] if block == 0 else range(4))
            made.append((classes[0], classes[-1], json.dumps([[s, t, *m] for (s, t), m in moves.items()]), kinds[2], kinds[3], kinds[1], clashes))
        kinds_ = [pa.string(), pa.string(), pa.string(), *[pa.int64()] * 4]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array([m[i] for m in made], k) for i, k in enumerate(kinds_)]], ["conv_id", "block", "head", "tail", "moves", *_COUNTS])


def _pairs(classes: str) -> dict[tuple[str, str], int]:
    out: dict[tuple[str, str], int] = {}
    for pair in zip(classes, classes[1:], strict=False):
        out[pair] = out.get(pair, 0) + 1
    return out


def _crossed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For every conversation the states between its blocks, its cost and its counts."""
    solver = Solver()
    for batch in batches:
        out = []
        for conv_id, blocks in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            moves = [{(s, t): (cost, rank) for s, t, cost, rank in json.loads(b["moves"])} for b in blocks]
            vector, cost = solver.forward(moves, unit(START))
            last = ending(vector)
            cost += vector[last][0] + INSERT * len(CLOSING[last])
            counts = [sum(b[c] for b in blocks) for c in _COUNTS]
            counts[3] += sum(_roles_clash(a["tail"], b["head"]) for a, b in zip(blocks, blocks[1:], strict=False))
            states = [START, *solver.states(moves, START, last)]
            for i, b in enumerate(blocks):
                out.append((conv_id, b["block"], states[i], states[i + 1], i == len(blocks) - 1, cost, *counts))
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), *[pa.int64()] * 5]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], ["conv_id", "block", "enter", "leave", "last", "cost", *_COUNTS])


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Letters of each block between its two states."""
    solver = Solver()
    for batch in batches:
        rows = batch.to_pylist()
        letters = [solver.letters(r["classes"], r["enter"], r["leave"]) + (CLOSING[r["leave"]] if r["last"] else "") for r in rows]
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("place"), pa.array(letters, pa.string()), batch.column("enter"), *[batch.column(c) for c in ("cost", *_COUNTS)]], ["conv_id", "place", "edits", "enter", "cost", *_COUNTS])


class _Rebuilt:
    """A conversation as it streams by: its audit, and the hash of what it becomes."""

    def __init__(self, conv_id: int, row: dict) -> None:
        self.result = [conv_id, *[row[c] for c in (*_COUNTS, "cost")]]
        self.hash, self.empty, self.state = hashlib.sha256(), True, START
        self.audit: list[str] = []
        self.edits, self.at = "", 0

    def begin(self, edits: str) -> None:
        self._insert()
        self.audit.append(edits)
        self.edits, self.at = edits, 0

    def _turn(self, role: str, text: str) -> None:
        self.hash.update(f"{'' if self.empty else chr(10)}{role}:{text}".encode())
        self.empty = False

    def _insert(self) -> None:
        while self.at < len(self.edits) and self.edits[self.at] == "I":
            role = due(self.state)
            self._turn(_FULL[role], "")
            self.state, self.at = emit(self.state, role), self.at + 1

    def row(self, role: str, text: str) -> None:
        self._insert()
        letter, self.at = self.edits[self.at], self.at + 1
        if letter == "D":
            return
        initial = due(self.state) if letter == "R" else role[0]
        self._turn(_FULL[initial] if letter == "R" else role, text)
        self.state = emit(self.state, initial)

    def end(self) -> list:
        self._insert()
        return [*self.result, "".join(self.audit), self.hash.hexdigest()]


_RESULT = "conv_id long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [*[pa.int64()] * 6, pa.string(), pa.string()]
    names = [p.split(" ")[0] for p in _RESULT.split(", ")]
    pack = lambda rows: pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)
    now, conv = None, None
    for batch in batches:
        done = []
        for row in batch.to_pylist():
            if now is None or conv != row["conv_id"]:
                if now is not None:
                    done.append(now.end())
                conv = row["conv_id"]
                now = _Rebuilt(conv, row)
            if row["edits"] is not None:
                now.begin(row["edits"])
            else:
                now.row(row["role"], row["text"])
        yield pack(done)
    if now is not None:
        yield pack([now.end()])


def repaired(rows: DataFrame, conv_ids: DataFrame) -> DataFrame:
    """The cheapest repair of each conversation of ``rows(conv_id, turn, role, text)``.

    Returns ``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256)`` for every id of ``conv_ids(conv_id)``; those without rows
    have zeros, an empty audit and the hash of nothing. Null turns come first,
    equal turns go by a hash of role and text; a role whose first letter is not
    ``s``, ``u`` or ``a``, or which is empty, is never kept as it is.
    """
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    trimmed = F.rtrim(F.col("text"), F.lit(_SPACES))
    stopped = trimmed.endswith(_STOPS[0]) | trimmed.endswith(_STOPS[1]) | trimmed.endswith(_STOPS[2])
    rows = rows.where("conv_id IS NOT NULL").select("conv_id", "turn", role.alias("role"), text.alias("text"))
    rows = rows.withColumns({"d1": digest(1, F.col("role"), F.col("text")), "d2": digest(2, F.col("role"), F.col("text")), "initial": _initial(), "blank": trimmed == "", "cut": ~stopped})
    ordered = in_order(rows, "damaged")
    blocks = settle(_classed(ordered), "blocks")
    moves = blocks.select("conv_id", "block", "classes").mapInArrow(_as_moves, "conv_id long, block int, head string, tail string, moves string, " + ", ".join(f"{c} long" for c in _COUNTS))
    each = moves.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("block", "head", "tail", "moves", *_COUNTS))).alias("blocks"))
    crossed = each.mapInArrow(_crossed, "conv_id long, block int, enter int, leave int, last boolean, cost long, " + ", ".join(f"{c} long" for c in _COUNTS))
    edits = blocks.join(crossed, ["conv_id", "block"]).mapInArrow(_edited, "conv_id long, place long, edits string, enter int, cost long, " + ", ".join(f"{c} long" for c in _COUNTS))
    # a block's edits stand before its rows, in one stream a conversation
    stream = edits.withColumn("is_row", F.lit(False)).unionByName(ordered.select("conv_id", "place", "role", "text", F.lit(True).alias("is_row")), allowMissingColumns=True)
    stream = stream.repartition("conv_id").sortWithinPartitions("conv_id", "place", "is_row")
    found = stream.select("conv_id", "edits", "role", "text", "cost", *_COUNTS).mapInArrow(_streamed, _RESULT)
    turns = ordered.where("turn IS NOT NULL").groupBy("conv_id", "turn").agg(F.lit(1).alias("one"))
    gaps = turns.groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1 - F.count("*")).alias("gaps"))
    every = conv_ids.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long")).distinct()
    out = every.join(found, "conv_id", "left").join(gaps, "conv_id", "left")
    zero = F.lit(0).cast("long")
    return out.select(
        "conv_id", *[F.coalesce(c, zero).alias(c) for c in ("gaps", *_COUNTS, "cost")], F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256")
    )


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """Damage ``conversations`` and repair them; see :func:`damaged` and :func:`repaired`."""
    return repaired(damaged(conversations), conversations)
