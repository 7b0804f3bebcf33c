"""Cheapest edits of a role sequence in linear space.

A conversation's rows are read by a machine of four states: nothing yet, after
a system turn, after a user turn, after an assistant turn. A row can be kept,
given another role or deleted, and turns can be inserted before it. Forward and
backward cost vectors over the four states meet in the middle; the crossing is
chosen there, and both halves are solved the same way, so only the vectors are
held, never the whole table of costs.

Of equally cheap edits those with the smallest letters win (D < I < K < R). A
forward vector therefore also ranks its states by the letters that lead to them.
Letters up to a row end with that row's own letter, and there are as many such
letters as rows; so no state's letters begin with those of another state, and
the rank at a crossing decides whatever follows.
"""

from __future__ import annotations

from collections.abc import Sequence

START, SYSTEM, USER, ASSISTANT = range(4)
#: Cost of keeping, giving another role, deleting, inserting; of a truncated row that stays.
RENAME, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
INITIALS = "sua"
#: Kinds of rows: nothing wrong, truncated, blank, duplicate.
FINE, CUT, BLANK, AGAIN = range(4)
#: What is left to insert, once all rows are read, for the sequence to be whole.
CLOSING = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}

Move = tuple[int, object]
Moves = dict[tuple[int, int], Move]
Vector = tuple[tuple[int, int] | None, ...]


def emit(state: int, role: str) -> int | None:
    """State after a turn of this initial, or None if it can't stand here."""
    if role == "s":
        return SYSTEM if state == START else None
    if role == "u":
        return None if state == USER else USER
    return ASSISTANT if role == "a" and state == USER else None


def due(state: int) -> str:
    """The only role, of user and assistant, that can come next."""
    return "a" if state == USER else "u"


def row_moves(initial: int, kind: int) -> Moves:
    """Cheapest way over a row from each state to each state: cost and letters, inserts first."""
    out: Moves = {}
    for s in range(4):
        at, inserted = s, 0
        while inserted < 3:
            ways = [(DELETE, "D", at)]
            if kind in (FINE, CUT):
                extra = TRUNCATED * (kind == CUT)
                kept = emit(at, INITIALS[initial]) if initial < 3 else None
                if kept is not None:
                    ways.append((extra, "K", kept))
                ways.append((RENAME + extra, "R", emit(at, due(at))))
            for cost, letter, t in ways:
                way = (INSERT * inserted + cost, "I" * inserted + letter)
                out[s, t] = min(out.get((s, t), way), way)
            at, inserted = emit(at, due(at)), inserted + 1
    return out


#: Letter of a row's class: four initials (the last stands for all others) by four kinds.
CLASSES = "ABCDEFGHIJKLMNOP"
ROW_MOVES = {c: row_moves(i // 4, i % 4) for i, c in enumerate(CLASSES)}


def unit(state: int) -> Vector:
    return tuple((0, 0) if s == state else None for s in range(4))


def _forward_step(vector: Vector, moves: Moves) -> tuple[Vector, int]:
    """One row or block further; costs are returned less their least, which comes along."""
    best: dict[int, tuple] = {}
    for (s, t), (cost, letters) in moves.items():
        if vector[s] is not None:
            way = (vector[s][0] + cost, vector[s][1], letters)
            if t not in best or way < best[t]:
                best[t] = way
    least = min(w[0] for w in best.values())
    order = {t: i for i, t in enumerate(sorted(best, key=lambda t: best[t][1:]))}
    return tuple((best[t][0] - least, order[t]) if t in best else None for t in range(4)), least


def _backward_step(vector: tuple, moves: Moves) -> tuple[tuple, int]:
    best: dict[int, int] = {}
    for (s, t), (cost, _) in moves.items():
        if vector[t] is not None:
            best[s] = min(best.get(s, cost + vector[t]), cost + vector[t])
    least = min(best.values())
    return tuple(best[s] - least if s in best else None for s in range(4)), least


class Solver:
    """Solves sequences of rows, given by class letters, or of blocks, given by their moves.

    Vectors less their least cost are few, so the steps over rows are remembered.
    """

    def __init__(self) -> None:
        self._forward: dict = {}
        self._backward: dict = {}

    def forward(self, rows: Sequence, vector: Vector) -> tuple[Vector, int]:
        total = 0
        if isinstance(rows, str):
            known = self._forward
            for c in rows:
                got = known.get((vector, c))
                if got is None:
                    got = known[vector, c] = _forward_step(vector, ROW_MOVES[c])
                vector, least = got
                total += least
        else:
            for moves in rows:
                vector, least = _forward_step(vector, moves)
                total += least
        return vector, total

    def backward(self, rows: Sequence, state: int) -> tuple:
        vector: tuple = tuple(0 if s == state else None for s in range(4))
        if isinstance(rows, str):
            known = self._backward
            for c in reversed(rows):
                got = known.get((vector, c))
                if got is None:
                    got = known[vector, c] = _backward_step(vector, ROW_MOVES[c])
                vector = got[0]
        else:
            for moves in reversed(rows):
                vector, _ = _backward_step(vector, moves)
        return vector

    def states(self, rows: Sequence, start: int, end: int) -> list[int]:
        """States after each row (or block) on the best way from ``start`` to ``end``."""
        out: list[int] = []
        todo = [(0, len(rows), start, end)]
        while todo:
            low, high, s, t = todo.pop()
            if high - low == 1:
                out.append(t)
                continue
            middle = (low + high) // 2
            ahead, _ = self.forward(rows[low:middle], unit(s))
            behind = self.backward(rows[middle:high], t)
            crossing = min((ahead[x][0] + behind[x], ahead[x][1], x) for x in range(4) if ahead[x] is not None and behind[x] is not None)[2]
            todo += [(middle, high, crossing, t), (low, middle, s, crossing)]
        return out

    def letters(self, rows: str, start: int, end: int) -> str:
        """The edits of ``rows`` on the best way from ``start`` to ``end``."""
        out, s = [], start
        for c, t in zip(rows, self.states(rows, start, end), strict=True):
            out.append(ROW_MOVES[c][s, t][1])
            s = t
        return "".join(out)

    def block_moves(self, rows: str, starts: Sequence[int] = range(4)) -> Moves:
        """A block of rows as one move from each state to each state: cost, and rank instead of letters."""
        out: Moves = {}
        for s in starts:
            vector, total = self.forward(rows, unit(s))
            for t, reached in enumerate(vector):
                if reached is not None:
                    out[s, t] = (reached[0] + total, reached[1])
        return out


def ending(vector: Vector) -> int:
    """The state to end in: cheapest with its closing inserts, then by rank."""
    return min((v[0] + INSERT * len(CLOSING[s]), v[1], s) for s, v in enumerate(vector) if v is not None)[2]
