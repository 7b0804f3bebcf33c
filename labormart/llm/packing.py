"""Best-fit packing of token sequences, repacked until lower bounds certify it.

Every partition packs its pieces by best-fit decreasing and computes a lower
bound on its number of sequences from dual feasible functions. A partition
whose count equals the bound is certified and stays. The others exchange: the
pieces of their unfilled sequences are dealt anew over fewer, mixed partitions
and packed again, until all are certified or a round saves nothing.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labormart.llm.common import parts_for, settle
from labormart.llm.tokens import encoder

CAPACITY = 2048
#: Pieces that one task packs.
PIECES_PER_PART = 60_000


def lower_bound(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    """Fewest bins that any packing needs, by three families of dual feasible functions.

    A dual feasible function maps sizes so that what fits into one bin sums to
    at most one; the mapped sum of all pieces therefore bounds the bins.
    """
    if not len(lengths):
        return 0
    sizes, counts = np.unique(np.asarray(lengths, np.int64), return_counts=True)
    best = -(-int((sizes * counts).sum()) // capacity)
    # pieces above capacity - e count as a whole bin, pieces under e as nothing
    for e in sizes[sizes <= capacity // 2]:
        value = np.where(sizes > capacity - e, capacity, np.where(sizes < e, 0, sizes))
        best = max(best, -(-int((value * counts).sum()) // capacity))
    # rounding down to multiples of 1/k, exact multiples of 1/(k + 1) kept
    for k in range(1, 33):
        scaled = sizes * (k + 1)
        exact = scaled % capacity == 0
        value = np.where(exact, sizes * k, scaled // capacity * capacity)
        best = max(best, -(-int((value * counts).sum()) // (k * capacity)))
    # pieces above one half count by what they leave free
    for e in sizes[sizes <= capacity // 2]:
        unit = capacity // int(e)
        value = np.where(sizes > capacity // 2, 2 * unit - 2 * ((capacity - sizes) // int(e)), np.where(2 * sizes == capacity, unit, 2 * (sizes // int(e))))
        best = max(best, -(-int((value * counts).sum()) // (2 * unit)))
    return int(best)


def best_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of every piece (in the given order), and the bins' fill.

    Bins are kept by free space; a bit set of the free spaces in use gives the
    tightest bin that fits in constant time.
    """
    order = np.argsort(-lengths, kind="stable")
    bins = np.empty(len(lengths), np.int64)
    offsets = np.empty(len(lengths), np.int64)
    fill: list[int] = []
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    in_use = 0
    for i, size in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fits = in_use >> size
        if fits:
            free = (fits & -fits).bit_length() - 1 + size
            stack = by_free[free]
            b = stack.pop()
            if not stack:
                in_use &= ~(1 << free)
        else:
            b, free = len(fill), capacity
            fill.append(0)
        bins[i], offsets[i] = b, fill[b]
        fill[b] += size
        if free > size:
            by_free[free - size].append(b)
            in_use |= 1 << (free - size)
    return bins, offsets, np.array(fill, np.int64)


def tokenized_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """Every document as its ids and ``end_id``, cut into pieces of at most ``capacity``.

    Only documents above the capacity are cut; their first piece takes the
    remainder. A null text is empty. ``item`` numbers the rows of the result, so
    that repeated rows of a document stay apart.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path).ids
        end = np.array([end_id], "<u4").tobytes()
        item = TaskContext.get().partitionId() << 40
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(text.as_py() or "") + end
                n = len(ids) // 4
                cuts = [0, *range((n - 1) % capacity + 1, n + 1, capacity)]
                for k in range(len(cuts) - 1):
                    rows.append((doc_id, k, cuts[k], cuts[k + 1] - cuts[k], zlib.crc32(ids[4 * cuts[k] : 4 * cuts[k + 1]]), item))
                    item += 1
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _PIECE_TYPES, strict=True)], _PIECE_NAMES)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, item long"
    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(pieces, schema)


_PIECE_NAMES = ["doc_id", "piece", "start", "length", "ids_crc32", "item"]
_PIECE_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]


def _packed(items: DataFrame, parts: int, seed: int, capacity: int) -> DataFrame:
    """One round: every part packs its pieces and certifies them or marks what it would exchange."""

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "piece", "item"], ascending=[False, True, True, True])
        bins, offsets, fill = best_fit_decreasing(pdf.length.to_numpy(), capacity)
        gap = len(fill) - lower_bound(pdf.length.to_numpy(), capacity)
        return pd.DataFrame({
            "item": pdf.item, "doc_id": pdf.doc_id, "piece": pdf.piece, "length": pdf.length,
            "bin": bins, "offset": offsets, "movable": (fill[bins] < capacity) & (gap > 0), "first": offsets == 0, "seed": seed,
        })

    schema = "item long, doc_id long, piece int, length long, bin long, offset long, movable boolean, first boolean, seed int, part int"

    def with_part(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return pack(pdf).assign(part=key[0])

    dealt = items.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "item", F.lit(seed)), F.lit(parts)).cast("int"))
    return dealt.groupBy("part").applyInPandas(with_part, schema)


def best_fit_pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pack ``pieces(item, doc_id, piece, length, ...)`` into sequences of at most ``capacity``.

    Returns the pieces with ``sequence_id`` and ``offset``. Full pieces are
    sequences of their own. A round's result replaces the one before only when
    it needs fewer sequences, and the first that saves none is the last; an empty input gives an empty result.
    """
    spark = pieces.sparkSession
    whole = pieces.where(F.col("length") >= capacity).select("item", F.col("item").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    # sequence numbers of packed bins are negative, so they never meet those above
    number = lambda d: d.withColumn("sequence_id", -(F.col("seed").cast("long") * (1 << 48) + F.col("part").cast("long") * (1 << 20) + F.col("bin") + 1))
    items = pieces.where(F.col("length") < capacity).select("item", "doc_id", "piece", "length")
    count = items.count()
    done = [whole]
    if count:
        current = settle(_packed(items, parts_for(count, PIECES_PER_PART), 0, capacity), "packed")
        for seed in itertools.count(1):
            movable = current.where("movable")
            n, bins = movable.agg(F.count("*"), F.coalesce(F.sum(F.col("first").cast("long")), F.lit(0))).first()
            if not n:
                break
            again = settle(_packed(movable.select("item", "doc_id", "piece", "length"), parts_for(n, PIECES_PER_PART), seed, capacity), "packed")
            if again.agg(F.sum(F.col("first").cast("long"))).first()[0] >= bins:
                break
            done.append(number(current.where("NOT movable")).select("item", "sequence_id", "offset"))
            current = again
        done.append(number(current).select("item", "sequence_id", "offset"))
    placed = done[0]
    for more in done[1:]:
        placed = placed.unionByName(more)
    return pieces.join(placed, "item")


def bound_of(pieces: DataFrame, capacity: int = CAPACITY) -> int:
    """Lower bound for all pieces together; gathers one count for each length, at most ``capacity`` rows."""
    rows = pieces.groupBy("length").count().collect()
    lengths = np.repeat([r[0] for r in rows], [r[1] for r in rows]) if rows else np.zeros(0, np.int64)
    return lower_bound(lengths, capacity)
