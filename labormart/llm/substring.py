"""Removal of repeated passages by fixed-block anchors.

Any run of ``window`` words holds a whole block of ``block`` words that starts
at a multiple of ``block`` in its document, if ``2 * block - 1 <= window``.
Step one indexes those non-overlapping blocks and probes them with every
rolling run of ``block`` words. Step two extends the hits: each window around
a hit is compared as a whole, and all but its earliest place is covered. Runs
of covered words are the maximal exact repeats.

Both steps send packed hashes, dealt by hash over buckets. A block of documents
settles its own repeats first, so a passage that many documents share reaches a
bucket once for each such block. Probes carry 40 bits within a bucket (a false
hit only costs a comparison); windows are compared by 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labormart.llm.common import n_words, parts_for
from labormart.llm.words import hash_windows, hash_words, text_buffers, text_slices

WINDOW = 20
BLOCK = 10
#: Words of the documents that settle their repeats together.
BLOCK_WORDS = 1_000_000
#: Entries of one bucket.
BUCKET_ENTRIES = 3_000_000
_LAST = (1 << 63) - 1


class _Gathered:
    """Word hashes of documents, gathered up to a number of words."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.words: list[np.ndarray] = []
        self.sizes: list[int] = []
        self.ids: list[int] = []
        self.tags: list[int] = []
        self.hits: list[np.ndarray] = []
        self.total = 0

    def add(self, words: np.ndarray, doc_id: int, tag: int, hits: np.ndarray | None = None) -> None:
        self.words.append(words)
        self.sizes.append(len(words))
        self.ids.append(doc_id)
        self.tags.append(tag)
        if hits is not None:
            self.hits.append(hits + self.total)
        self.total += len(words)

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All words; each word's place in its document; and how many words follow in it, itself included."""
        sizes = np.array(self.sizes, np.int64)
        starts = np.cumsum(sizes) - sizes
        place = np.arange(self.total) - np.repeat(starts, sizes)
        return np.concatenate(self.words), place, np.repeat(sizes, sizes) - place


def _per_document(at: np.ndarray, gathered: _Gathered) -> Iterator[tuple[int, int, bytes]]:
    """Sorted places among the gathered words, as packed places in each document."""
    stops = np.cumsum(gathered.sizes)
    cuts = np.searchsorted(at, np.r_[0, stops])
    for d in np.flatnonzero(np.diff(cuts)).tolist():
        start = int(stops[d]) - gathered.sizes[d]
        yield gathered.ids[d], gathered.tags[d], (at[cuts[d] : cuts[d + 1]] - start).astype("<u4").tobytes()


def _by_bucket(at: np.ndarray, hashes: np.ndarray, n_buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Places in each bucket, ascending; the bucket is taken from the high hash bits."""
    bucket = ((hashes[at] >> np.uint64(40)) % np.uint64(n_buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
    for b in np.flatnonzero(np.diff(cuts)).tolist():
        yield b, at[order[cuts[b] : cuts[b + 1]]]


def _planes(values: np.ndarray, n: int) -> bytes:
    """The lowest ``n`` bytes of each value, all first bytes first (high bytes compress well)."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n].T).tobytes()


def _from_planes(raw: bytes, n: int, size: int) -> np.ndarray:
    out = np.zeros((size, 8), np.uint8)
    out[:, :n] = np.frombuffer(raw, np.uint8, n * size).reshape(n, size).T
    return out.view("<u8").ravel()


def _groups(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order that brings equal hashes together (stable), where groups start, and their sizes."""
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(ordered) else np.zeros(0, np.int64)
    return order, first, np.diff(np.r_[first, len(ordered)])


_HIT = "kind int, bucket int, part long, n_docs long, n long, packed binary"
_HIT_TYPES = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
_HIT_NAMES = [x.split()[0] for x in _HIT.split(", ")]


def _table(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(_HIT_TYPES)], _HIT_NAMES)


def _block_rows(gathered: _Gathered, own: np.ndarray, number: int, n_buckets: int) -> list[tuple]:
    """A block's documents (kind 1) and its own places (2); they pass through a bucket, so that one exchange carries all."""
    via = number % n_buckets
    table = np.array(gathered.ids, "<i8").tobytes() + np.array(gathered.tags, "<i8").tobytes() + np.array(gathered.sizes, "<u4").tobytes()
    return [
        (1, via, number, None, len(gathered.ids), table),
        (2, via, number, None, len(own), _planes(np.diff(np.r_[0, own]), 4)),
    ]


def _probe_rows(texts: DataFrame, n_buckets: int, window: int, block: int) -> DataFrame:
    """Per block of documents: its probes for every bucket (kind 0), its documents (1), its own hits (2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        gathered, number = _Gathered(), TaskContext.get().partitionId() << 32

        def probed() -> pa.RecordBatch:
            nonlocal number
            words, place, rest = gathered.arrays()
            hashes = hash_windows(words, block)
            at = np.flatnonzero(rest[: len(hashes)] >= block)
            aligned = place % block == 0
            order, first, sizes = _groups(hashes[at])
            rows: list[tuple] = []
            if len(at):
                ordered = at[order]
                anchored = np.maximum.reduceat(aligned[ordered], first)
                several = sizes > 1
                own = np.sort(ordered[np.repeat(several & anchored, sizes)])
                # of a group that holds an anchor one anchor stands for all; of others each place is asked for
                chosen = np.maximum.reduceat(np.where(aligned[ordered], ordered, -1), first)[several & anchored]
                send = np.sort(np.r_[chosen, ordered[np.repeat(~(several & anchored), sizes)]])
                for b, e in _by_bucket(send, hashes, n_buckets):
                    gaps = np.diff(np.r_[0, e])
                    rows.append((0, b, number, None, len(e), _planes(hashes[e], 5) + _planes(gaps, 4) + np.packbits(aligned[e]).tobytes()))
                rows.extend(_block_rows(gathered, own, number, n_buckets))
            number += 1
            gathered.clear()
            return _table(rows)

        for batch in batches:
            text, offsets = text_buffers(batch.column(2))
            ids, tags = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for start, stop in text_slices(batch.column(2)):
                words, bounds = hash_words(text, offsets[start : stop + 1])
                for i, (lo, hi) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
                    if hi - lo >= window:
                        gathered.add(words[lo:hi], ids[start + i], tags[start + i])
                if gathered.total >= BLOCK_WORDS:
                    yield probed()
        if gathered.total:
            yield probed()

    return texts.mapInArrow(run, _HIT)


_MET = pa.schema([("part", pa.int64()), ("n", pa.int64()), ("packed", pa.binary()), ("kind", pa.int32())])


def _chosen_rows(parts: list[int], places: list[np.ndarray], chosen: np.ndarray) -> pa.Table:
    """The chosen places of each block of documents as one row (kind 2)."""
    out = []
    for part, place, keep in zip(parts, places, np.split(chosen, np.cumsum([len(p) for p in places])[:-1]), strict=True):
        if keep.any():
            at = place[keep]
            out.append({"part": part, "n": len(at), "packed": _planes(np.diff(np.r_[0, at]), 4), "kind": 2})
    return pa.Table.from_pylist(out, _MET)


def _bucket_hits(rows: pa.Table) -> pa.Table:
    """Of each block's probes, those that meet an anchor at another place; other rows pass."""
    passing = rows.filter(pc.greater(rows.column("kind"), 0)).select(["part", "n", "packed", "kind"])
    rows = rows.filter(pc.equal(rows.column("kind"), 0))
    if not rows.num_rows:
        return passing
    parts, sizes = rows.column("part").to_pylist(), rows.column("n").to_pylist()
    hashes, aligned, places = [], [], []
    for blob, n in zip(rows.column("packed"), sizes, strict=True):
        raw = blob.as_buffer().to_pybytes()
        hashes.append(_from_planes(raw, 5, n))
        places.append(np.cumsum(_from_planes(raw[5 * n :], 4, n).astype(np.int64)))
        aligned.append(np.unpackbits(np.frombuffer(raw, np.uint8, offset=9 * n), count=n).astype(bool))
    order, first, count = _groups(np.concatenate(hashes))
    hit = np.zeros(len(order), bool)
    if len(order):
        anchored = np.maximum.reduceat(np.concatenate(aligned)[order], first)
        hit[order[np.repeat((count > 1) & anchored, count)]] = True
    return pa.concat_tables([passing.cast(_MET), _chosen_rows(parts, places, hit)])


def _document_places(rows: pa.Table) -> pa.Table:
    """A block's places from all buckets, dealt to its documents."""
    out: list[tuple[int, int, bytes]] = []
    found: list[np.ndarray] = []
    gathered = _Gathered()
    for kind, n, blob in zip(rows.column("kind").to_pylist(), rows.column("n").to_pylist(), rows.column("packed"), strict=True):
        raw = blob.as_buffer().to_pybytes()
        if kind == 1:
            gathered.ids, gathered.tags = np.frombuffer(raw, "<i8", n).tolist(), np.frombuffer(raw, "<i8", n, 8 * n).tolist()
            gathered.sizes = np.frombuffer(raw, "<u4", n, 16 * n).astype(np.int64).tolist()
        else:
            found.append(np.cumsum(_from_planes(raw, 4, n).astype(np.int64)))
    out.extend(_per_document(np.unique(np.concatenate(found)), gathered))
    return pa.table({"doc_id": pa.array([o[0] for o in out], pa.int64()), "tag": pa.array([o[1] for o in out], pa.int64()), "places": pa.array([o[2] for o in out], pa.binary())})


def _window_rows(texts: DataFrame, n_buckets: int, window: int, block: int) -> DataFrame:
    """Per block of documents: its earliest place of each window around hits (kind 0), its documents (1), its own repeats (2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        gathered, number = _Gathered(), TaskContext.get().partitionId() << 32

        def compared() -> pa.RecordBatch:
            nonlocal number
            words, place, rest = gathered.arrays()
            hashes = hash_windows(words, window, salt=1)
            # a window qualifies if a hit starts at most (window - block) words after it
            mark = np.zeros(gathered.total + 1, np.int64)
            hits = np.concatenate(gathered.hits)
            np.add.at(mark, np.maximum(hits - (window - block), hits - place[hits]), 1)
            np.add.at(mark, hits + 1, -1)
            at = np.flatnonzero((np.cumsum(mark)[: len(hashes)] > 0) & (rest[: len(hashes)] >= window))
            owner = np.repeat(np.arange(len(gathered.sizes)), gathered.sizes)
            ids = np.array(gathered.ids, np.int64)
            rows: list[tuple] = []
            if len(at):
                at = at[np.lexsort((place[at], ids[owner[at]]))]
                order, first, sizes = _groups(hashes[at])
                ordered = at[order]  # by hash, then document, then place
                lead = np.repeat(ordered[first], sizes)
                later = (ids[owner[ordered]] != ids[owner[lead]]) | (place[ordered] != place[lead])
                for b, e in _by_bucket(np.sort(ordered[~later]), hashes, n_buckets):
                    docs, local = np.unique(owner[e], return_inverse=True)
                    stops = np.cumsum(np.bincount(local)).astype("<u4")
                    starts = (e - place[e])[np.r_[0, stops[:-1]]]
                    table = ids[docs].astype("<i8").tobytes() + starts.astype("<u4").tobytes() + stops.tobytes()
                    rows.append((0, b, number, len(docs), len(e), table + _planes(hashes[e], 8) + _planes(np.diff(np.r_[0, e]), 4)))
                own = np.sort(ordered[later])
                rows.extend(_block_rows(gathered, own, number, n_buckets))
            number += 1
            gathered.clear()
            return _table(rows)

        for batch in batches:
            text, offsets = text_buffers(batch.column(2))
            ids, tags, hits = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3)
            for start, stop in text_slices(batch.column(2)):
                words, bounds = hash_words(text, offsets[start : stop + 1])
                for i, (lo, hi) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
                    at = np.unique(np.concatenate([np.frombuffer(h.as_buffer(), "<u4") for h in hits[start + i].values])).astype(np.int64)
                    gathered.add(words[lo:hi], ids[start + i], tags[start + i], at)
                if gathered.total >= BLOCK_WORDS:
                    yield compared()
        if gathered.total:
            yield compared()

    return texts.mapInArrow(run, _HIT)


def _bucket_repeats(rows: pa.Table) -> pa.Table:
    """Of each block's windows, those of which the same words start earlier in another document; other rows pass."""
    passing = rows.filter(pc.greater(rows.column("kind"), 0)).select(["part", "n", "packed", "kind"])
    rows = rows.filter(pc.equal(rows.column("kind"), 0))
    if not rows.num_rows:
        return passing
    parts = rows.column("part").to_pylist()
    ids, starts, hashes, at = [], [], [], []
    for n_docs, n, blob in zip(rows.column("n_docs").to_pylist(), rows.column("n").to_pylist(), rows.column("packed"), strict=True):
        raw = blob.as_buffer().to_pybytes()
        count = np.diff(np.frombuffer(raw, "<u4", n_docs, 12 * n_docs), prepend=np.uint32(0))
        ids.append(np.repeat(np.frombuffer(raw, "<i8", n_docs), count))
        starts.append(np.repeat(np.frombuffer(raw, "<u4", n_docs, 8 * n_docs), count))
        hashes.append(_from_planes(raw[16 * n_docs :], 8, n))
        at.append(np.cumsum(_from_planes(raw[16 * n_docs + 8 * n :], 4, n).astype(np.int64)))
    ids, hashes = np.concatenate(ids), np.concatenate(hashes)
    places = np.concatenate(at) - np.concatenate(starts)
    order = np.lexsort((places, ids, hashes))
    ordered = hashes[order]
    first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    lead = order[np.repeat(first, np.diff(np.r_[first, len(order)]))]
    later = np.zeros(len(order), bool)
    later[order] = (ids[order] != ids[lead]) | (places[order] != places[lead])
    return pa.concat_tables([passing.cast(_MET), _chosen_rows(parts, at, later)])


def _cleaned(texts: DataFrame, window: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, digest, kept, spans = [], [], [], [], []
            for text, found in zip(batch.column(2), batch.column(3), strict=True):
                words = (text.as_py() or "").encode().split()
                runs: list[dict] = []
                gone = 0
                if found.is_valid:
                    starts = np.concatenate([np.frombuffer(f.as_buffer(), "<u4") for f in found.values]).astype(np.int64)
                    cover = np.zeros(len(words) + 1, np.int64)
                    np.add.at(cover, starts, 1)
                    np.add.at(cover, starts + window, -1)
                    covered = np.cumsum(cover)[:-1] > 0
                    gone = int(covered.sum())
                    edge = np.flatnonzero(np.diff(np.r_[False, covered, False]))
                    runs = [{"start": int(a), "stop": int(b)} for a, b in zip(edge[::2], edge[1::2], strict=True)]
                    words = [w for w, c in zip(words, covered.tolist(), strict=True) if not c]
                body = b" ".join(words)
                total.append(len(words) + gone)
                removed.append(gone)
                digest.append(hashlib.sha256(body).hexdigest())
                spans.append(runs)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))], ["doc_id", "n_words", "n_removed", "kept_sha256", "spans"])

    return texts.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string, spans array<struct<start:long,stop:long>>")


def repeated_starts(docs: DataFrame, window: int = WINDOW, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """The keyed texts, and for each the packed starts of windows that also start earlier.

    Rows are known by ``doc_id`` (null counts as the last) and a hash of their
    text, so rows that repeat are the same place and do not cover one another.
    """
    if 2 * block - 1 > window:
        raise ValueError("a window must hold a whole block")
    key: Column = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST))
    texts = docs.select(key.alias("doc_id"), F.xxhash64("text").alias("tag"), F.col("text").cast("string").alias("text"))
    words = int(docs.agg(F.sum(n_words(F.col("text")))).first()[0] or 0)
    n_buckets = parts_for(words, BUCKET_ENTRIES)
    probes = _probe_rows(texts, n_buckets, window, block)
    met = probes.groupBy("bucket").applyInArrow(lambda t: _bucket_hits(t), "part long, n long, packed binary, kind int")
    hits = met.groupBy("part").applyInArrow(lambda t: _document_places(t), "doc_id long, tag long, places binary")
    hits = hits.groupBy("doc_id", "tag").agg(F.collect_list("places").alias("hits"))
    around = texts.join(hits.hint("merge"), ["doc_id", "tag"], "left").where("hits IS NOT NULL")
    windows = _window_rows(around, n_buckets, window, block)
    met = windows.groupBy("bucket").applyInArrow(lambda t: _bucket_repeats(t), "part long, n long, packed binary, kind int")
    starts = met.groupBy("part").applyInArrow(lambda t: _document_places(t), "doc_id long, tag long, places binary")
    starts = starts.groupBy("doc_id", "tag").agg(F.collect_list("places").alias("starts"))
    return texts, starts


def remove_repeats(docs: DataFrame, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256, spans)`` for every row of ``docs``.

    A word goes if a window of ``window`` words that covers it also starts
    earlier: in a document with a smaller ``doc_id``, or further up in the same
    one. ``spans`` are the maximal runs of such words, ``start`` included and
    ``stop`` not. Windows are judged on the input. A null text has no words.
    """
    texts, starts = repeated_starts(docs, window, block)
    out = _cleaned(texts.join(starts.hint("merge"), ["doc_id", "tag"], "left").select("doc_id", "tag", "text", "starts"), window)
    return out.withColumn("doc_id", F.when(F.col("doc_id") != _LAST, F.col("doc_id")))
