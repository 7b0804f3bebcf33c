"""Token counts of fields and sections by offset-mapped attribution.

A row's fields are rendered as one text and encoded once, as a model would see
it. Token character spans are then joined to the sections they fall in.

The rule for a token across a boundary: it counts for the section that holds
most of its characters, the earlier one if equal. Characters between sections
(separators, line ends) count for none; a token made of them alone counts for
the section before it, and for the first one at the start.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labormart.llm.tokens import encoder

SEPARATOR = " "


def sections_of(values: Sequence[str | None], by_line: Sequence[bool], separator: str = SEPARATOR) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
    """The rendered text, and field number, start and stop of every section.

    A field is one section, or one for each of its lines; a null field is
    empty, and an empty field or line is a section without characters.
    """
    field, start, stop = [], [], []
    at = 0
    for k, value in enumerate(values):
        at += len(separator) if k else 0
        for line in (value or "").split("\n") if by_line[k] else [value or ""]:
            field.append(k)
            start.append(at)
            stop.append(at + len(line))
            at += len(line) + 1
        at -= 1
    text = separator.join(v or "" for v in values)
    return text, np.array(field, np.int32), np.array(start, np.int64), np.array(stop, np.int64)


def attribute(token_start: np.ndarray, token_stop: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Section of every token, and whether it touches more than that section's characters.

    Sections are in order and do not overlap; so are the tokens, but for those
    that share a character.
    """
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, bool)
    last = len(start) - 1
    first = np.searchsorted(stop, token_start, side="right")  # the first section that ends after the token's start
    best = np.full(len(token_start), -1)
    most = np.zeros(len(token_start), np.int64)
    at, live = first.copy(), np.flatnonzero(first <= last)
    while len(live):
        k = at[live]
        shared = np.minimum(token_stop[live], stop[k]) - np.maximum(token_start[live], start[k])
        better = shared > most[live]
        best[live[better]], most[live[better]] = k[better], shared[better]
        at[live] += 1
        live = live[(k < last) & (start[np.minimum(k + 1, last)] < token_stop[live])]
    crossing = (best >= 0) & (most < token_stop - token_start)
    # between sections: the last one that starts no later
    before = np.maximum(np.searchsorted(start, token_start, side="right") - 1, 0)
    return np.where(best >= 0, best, before), crossing


def token_counts(rows: DataFrame, tokenizer_path: str, id_column: str, fields: Sequence[str], line_fields: Sequence[str] = (), separator: str = SEPARATOR) -> DataFrame:
    """``(id, field, section, start, stop, n_tokens, n_crossing)`` for every section of every row.

    ``section`` numbers a field's sections from 0; ``start`` and ``stop`` are
    characters of the rendered text; ``n_crossing`` is how many of the tokens
    also hold characters outside the section. The counts of a row sum to the
    tokens of its rendered text. Rows that repeat are counted each.
    """
    names, by_line = list(fields), [f in line_fields for f in fields]
    schema = "id long, field string, section int, start long, stop long, n_tokens long, n_crossing long"
    out_names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans = encoder(tokenizer_path).spans
        labels = np.array(names, object)
        for batch in batches:
            ids, columns = batch.column(0).to_pylist(), [batch.column(k + 1) for k in range(len(names))]
            for low in range(0, batch.num_rows, 500):
                made: list[list[np.ndarray]] = [[] for _ in range(6)]
                owner: list[int | None] = []
                for i in range(low, min(low + 500, batch.num_rows)):
                    text, field, start, stop = sections_of([c[i].as_py() for c in columns], by_line, separator)
                    token_start, token_stop = spans(text)
                    where, crossing = attribute(token_start, token_stop, start, stop)
                    number = np.arange(len(field)) - np.searchsorted(field, field)
                    counted = np.bincount(where, minlength=len(field)), np.bincount(where[crossing], minlength=len(field))
                    for into, value in zip(made, (field, number, start, stop, *counted), strict=True):
                        into.append(value)
                    owner += [ids[i]] * len(field)
                flat = [np.concatenate(m) for m in made]
                arrays = [pa.array(owner, pa.int64()), pa.array(labels[flat[0]], pa.string()), pa.array(flat[1].astype(np.int32)), *[pa.array(f.astype(np.int64)) for f in flat[2:]]]
                yield pa.RecordBatch.from_arrays(arrays, out_names)

    picked = rows.select(F.col(id_column).cast("long").alias("_id"), *[F.col(f).cast("string").alias(f"_f{k}") for k, f in enumerate(names)])
    return picked.mapInArrow(run, schema)
