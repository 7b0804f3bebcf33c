"""Exact n-gram Jaccard join with set-relation skipping.

Documents with the same shingles form one set. Sets are joined in three steps:

* Candidates. The rarest shingles of every set, those of the rarest words first,
  go into index lists, dealt into buckets by shingle. Lists are sorted by set
  size; the position of the shingle in a set bounds how large a partner can be,
  so each entry sees one block of its list and skips the others. What remains
  are pairs, and chains through lists with many sets of similar size, which
  only say that these sets belong to one candidate group.
* Refinement. Each set has a bitmap with a bit for each of its shingles, set or
  cleared in turn. Two bitmaps differ in at most as many bits as the sets differ
  in shingles, so pairs that differ in too many are not similar. Each pair is
  put to this test, and every two sets of a group. Groups are formed anew from
  what passes; no text moves for this.
* Answers. A group's texts come together once. Its sets are walked from one to
  the most similar one next: overlaps with all others are carried along and only
  the lists of the shingles that differ are added or taken off.

Groups with many sets are cut into blocks by set size. A block is answered
within itself first and then packed into one row, its sets as differences from
the shingles that most of them have. Blocks whose sizes allow a link meet in
tasks of one block and a strip of later ones, which read those packed rows.

No pair of sets is ever a row (pairs travel packed), no text goes to more than one task, and rows do
not follow the square of a group; all links are found and counted all the same.
Shingles are known by 64-bit hashes and sets by 128-bit digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labormart.llm.common import components, fresh, parts_for, settle
from labormart.llm.words import hash_windows, hash_words, text_buffers, text_slices

WIDTH = 5
#: Two sets link when PERCENT is at most 100 times their Jaccard similarity.
PERCENT = 75
#: Shingles of the sets that are counted together for the order, and indexed together.
BLOCK_SHINGLES = 1_000_000
#: Shingles put last in the order, at most; the order decides speed, never results.
ORDERED_LAST = 1 << 17
LOCAL_COUNT = 4
#: Words whose frequency places shingles in the order, at most; and how often a slice of texts must have one.
COMMON_WORDS = 1 << 16
LOCAL_WORDS = 8
#: Bytes of text whose words are hashed at once.
SLICE_BYTES = 1 << 20
#: Index entries of one bucket; entries of a list that are compared one by one.
BUCKET_ENTRIES = 1_000_000
LONG_RANGE = 128
#: Sets, and shingles, of one shard in the test of pairs; bytes of bitmaps that are packed or compared at once.
SHARD_SETS = 16_384
SHARD_SHINGLES = 32_000_000
MAP_BYTES = 4_000_000
#: A shingle in more sets than this joins them to one group without a list.
HOT_LIST = 1_000_000
#: Sets, and shingles, of one block of a group.
GROUP_SETS = 2_000
GROUP_SHINGLES = 2_000_000
#: The same for the step that compares bitmaps only.
REFINED_SETS = 4_000
REFINED_SHINGLES = 8_000_000
#: Later blocks of a group that meet one block in a task.
STRIP = 8
CANDIDATES = "a binary, b binary, shard long, pairs binary"
PACKED = "component binary, block long, low long, high long, keys binary, sizes binary, roots binary, lengths binary, common binary, body binary"


def shingle_sets(text: np.ndarray, offsets: np.ndarray, width: int = WIDTH) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every document; short texts are one shingle."""
    return sets_of(*hash_words(text, offsets, lower=True), width)[0]


def sets_of(words: np.ndarray, bounds: np.ndarray, width: int, weight: np.ndarray | None = None) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """``shingle_sets`` of hashed words; with weights of the words, also the sum of a shingle's for each shingle of each set."""
    windows = hash_windows(words, width)
    total = None if weight is None else np.r_[0, np.cumsum(weight)]
    out, weights = [], []
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if hi - lo >= width and total is not None:
            shingles, at = np.unique(windows[lo : hi - width + 1], return_index=True)
            out.append(shingles)
            weights.append((total[lo + at + width] - total[lo + at]).astype(np.int32))
            continue
        if hi - lo >= width:
            out.append(np.unique(windows[lo : hi - width + 1]))
        elif hi > lo:  # the whole sequence, told apart from longer ones by its own salt
            out.append(hash_windows(words[lo:hi], hi - lo, salt=hi - lo))
        else:
            out.append(np.zeros(0, np.uint64))
        weights.append(np.zeros(len(out[-1]), np.int32))
    return out, weights


def word_weights(words: np.ndarray, common: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weight of every word: that of the same word in ``common``, in order, or nothing."""
    if not len(common):
        return np.zeros(len(words), np.int64)
    found = np.searchsorted(common, words)
    found[found == len(common)] = 0
    return np.where(common[found] == words, weight[found], 0)


def set_key(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def set_bits(shingles: np.ndarray) -> bytes:
    """Parity bitmap with at least one bit for each shingle, a power of two and 64 at least."""
    size = 1 << max(6, int(len(shingles) - 1).bit_length())
    odd = np.bincount((shingles & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _blocks(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, int, int, np.ndarray, np.ndarray]]:
    """Hashed words of the texts, slice by slice, and where each text's begin."""
    for batch in batches:
        text, offsets = text_buffers(batch.column(column))
        for start, stop in text_slices(batch.column(column), SLICE_BYTES):
            yield batch, start, stop, *hash_words(text, offsets[start : stop + 1], lower=True)


def _distinct(sets: dict[bytes, np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray]:
    shingles, counts = np.unique(np.concatenate(list(sets.values())), return_counts=True)
    return shingles[counts >= least], counts[counts >= least]


def fingerprints(docs: DataFrame, width: int) -> DataFrame:
    """For each row its set's size and digest; and shingles that repeat within a block of sets, words within a slice of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, np.ndarray] = {}
        common: list[tuple[np.ndarray, np.ndarray]] = []
        none_found = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        held = 0

        def rows(ids, tags, sizes, keys, bits, shingles, words, counts) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([ids, tags, pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(bits, pa.binary()), pa.array(shingles, pa.int64()), pa.array(words, pa.int64()), pa.array(counts, pa.int64())], ["doc_id", "tag", "n", "key", "bits", "shingle", "word", "count"])

        def counted() -> Iterator[pa.RecordBatch]:
            shingles, counts = _distinct(seen, LOCAL_COUNT) if seen else none_found
            found, part = np.unique(np.concatenate([f for f, _ in common]), return_inverse=True)
            often = np.bincount(part, weights=np.concatenate([n for _, n in common]), minlength=len(found)).astype(np.int64)
            none, nowhere = [None] * len(shingles), [None] * len(found)
            yield rows(pa.array(none, pa.int64()), pa.array(none, pa.int64()), none, none, none, shingles.view(np.int64), none, counts)
            yield rows(pa.array(nowhere, pa.int64()), pa.array(nowhere, pa.int64()), nowhere, nowhere, nowhere, nowhere, found.view(np.int64), often)

        for batch, start, stop, words, bounds in _blocks(batches, 2):
            sets, _ = sets_of(words, bounds, width)
            keys = [set_key(s) if len(s) else None for s in sets]
            none = [None] * len(sets)
            yield rows(batch.column(0).slice(start, stop - start), batch.column(1).slice(start, stop - start), [len(s) for s in sets], keys, [set_bits(s) if len(s) else None for s in sets], none, none, none)
            found, counts = np.unique(words, return_counts=True)
            common.append((found[counts >= LOCAL_WORDS], counts[counts >= LOCAL_WORDS]))
            for k, s in zip(keys, sets, strict=True):
                if k is not None and k not in seen:
                    seen[k] = s
                    held += len(s)
            if held >= BLOCK_SHINGLES:
                yield from counted()
                seen.clear()
                common.clear()
                held = 0
        if common:
            yield from counted()

    return docs.mapInArrow(run, "doc_id long, tag long, n long, key binary, bits binary, shingle long, word long, count long")


def _prefix_length(size: np.ndarray | int, percent: int):
    return size - -(-percent * size // 100) + 1


def _index_rows(docs: DataFrame, last, n_buckets: int, width: int, percent: int) -> DataFrame:
    """Index entries, packed for each block of sets and bucket; and group edges of hot shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ordered, rank, hot, common, weight = last.value
        seen: dict[bytes, tuple[np.ndarray, np.ndarray]] = {}
        held = 0

        def packed() -> pa.RecordBatch:
            keys, sets = list(seen), [s for s, _ in seen.values()]
            sizes = np.array([len(s) for s in sets], np.int64)
            shingles, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
            starts = np.cumsum(sizes) - sizes
            # shingles that are not ordered last come first, by weight and hash; the others by rank
            found = np.searchsorted(ordered, shingles)
            found[found == len(ordered)] = 0
            late = ordered[found] == shingles if len(ordered) else np.zeros(len(shingles), bool)
            value = np.concatenate([w for _, w in seen.values()])
            at = np.flatnonzero(late)
            if len(at):
                value[at] = int(value.max()) + 1 + rank[found[at]]
            del found, late
            by = np.argsort(owner * (int(value.max()) + 1) + value, kind="stable")
            del value
            place = np.empty(len(shingles), np.int64)
            place[by] = np.arange(len(shingles)) - np.repeat(starts, sizes)
            keep = place < _prefix_length(sizes, percent)[owner]
            is_hot = np.zeros(len(shingles), bool)
            if len(hot):
                is_hot[at] = np.isin(shingles[at], hot)
            entry = np.flatnonzero(keep & ~is_hot)
            bucket = (shingles[entry] & np.uint64(0xFFFFFF)).astype(np.int64) % n_buckets
            entry = entry[np.argsort(bucket, kind="stable")]
            ahead = np.where(place[entry] > 0, shingles[by[starts[owner[entry]] + place[entry] - 1]], 0)
            del by
            cuts = np.searchsorted(np.sort(bucket), np.arange(n_buckets + 1))
            key_bytes = np.frombuffer(b"".join(keys), np.uint8).reshape(-1, 16)
            rows: list[tuple] = []
            for b in np.flatnonzero(np.diff(cuts)).tolist():
                e = entry[cuts[b] : cuts[b + 1]]
                own, local = np.unique(owner[e], return_inverse=True)
                rows.append((b, len(own), key_bytes[own].tobytes() + sizes[own].astype("<u4").tobytes() + shingles[e].tobytes() + local.astype("<u4").tobytes() + place[e].astype("<u4").tobytes() + ahead[cuts[b] : cuts[b + 1]].tobytes()))
            e = np.flatnonzero(keep & is_hot)
            if len(e):  # bare edges, in a bucket of their own
                nodes = np.concatenate([np.frombuffer(b"hot-word", np.uint8)[None].repeat(len(e), 0), shingles[e].view(np.uint8).reshape(-1, 8)], axis=1)
                rows.append((-1 - int(shingles[e[0]] & np.uint64(0xFFFF)), len(e), np.concatenate([key_bytes[owner[e]], nodes], axis=1).tobytes()))
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.binary()))], ["bucket", "sets", "packed"])

        for _, _, _, words, bounds in _blocks(batches, 0):
            for s, w in zip(*sets_of(words, bounds, width, word_weights(words, common, weight)), strict=True):
                if len(s) and (k := set_key(s)) not in seen:
                    seen[k] = s, w
                    held += len(s)
            if held >= BLOCK_SHINGLES:
                yield packed()
                seen.clear()
                held = 0
        if seen:
            yield packed()

    return docs.select("text").mapInArrow(run, "bucket int, sets int, packed binary")


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node of each node's component, for edges between 0..n-1."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def list_candidates(shingle: np.ndarray, owner: np.ndarray, size: np.ndarray, place: np.ndarray, ahead: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Owner pairs of index entries that can reach the similarity, list by list; and chains through long ranges.

    An entry's shingles from this position on bound every overlap that starts
    here, which bounds the partner's size: entries beyond it are skipped as a
    block. Ranges longer than ``LONG_RANGE`` are chained, which joins at least
    the owners that pairs would have joined. Entries with the same shingle
    right ahead have met in the list of that one, where the bounds are wider.
    """
    order = np.lexsort((size, shingle))
    shingle, owner, size, place, ahead = shingle[order], owner[order], size[order], place[order], ahead[order]
    new = np.r_[True, shingle[1:] != shingle[:-1]]
    number = np.cumsum(new) - 1
    rest = size - place
    # overlap >= percent / (100 + percent) * (both sizes); so the partner has at most this size
    most = np.minimum(100 * size // percent, (100 + percent) * rest // percent - size)
    step = int(size.max(initial=0)) + 2
    where = number * step + size
    stop = np.searchsorted(where, number * step + np.minimum(most, step - 1), side="right")
    span = np.maximum(stop - np.arange(len(size)) - 1, 0)
    long = span > LONG_RANGE
    short = np.flatnonzero((span > 0) & ~long)
    pairs = [np.zeros(0, np.int64)]
    for part in np.array_split(short, max(1, int(span[short].sum()) // 2_000_000 + 1)):
        n = span[part]
        i = np.repeat(part, n)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
        fits = ((100 + percent) * rest[j] >= percent * (size[i] + size[j])) & ((ahead[i] != ahead[j]) | (ahead[i] == 0))
        # the smaller set first
        i, j = i[fits], j[fits]
        flip = (size[i] == size[j]) & (owner[i] > owner[j])
        i, j = np.where(flip, owner[j], owner[i]), np.where(flip, owner[i], owner[j])
        pairs.append(np.unique(i.astype(np.int64) << 32 | j))
    pair = np.unique(np.concatenate(pairs))
    cover = np.zeros(len(size) + 1, np.int64)
    np.add.at(cover, np.flatnonzero(long), 1)
    np.add.at(cover, stop[long] - 1, -1)
    link = np.flatnonzero(np.cumsum(cover)[:-1] > 0)
    return pair >> 32, pair & 0xFFFFFFFF, owner[link], owner[link + 1]


def _shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each key, given as rows of its bytes; by its first four."""
    return np.ascontiguousarray(keys[:, :4]).view(">u4").ravel().astype(np.int64) % shards


def _bucket_groups(rows: pa.Table, percent: int, shards: int) -> pa.Table:
    """Edges of candidate groups; and candidate pairs, packed for each shard of the first set."""
    if rows.num_rows and rows.column("bucket")[0].as_py() < 0:
        edges = [blob.as_py()[32 * i : 32 * i + 32] for n, blob in zip(rows.column("sets").to_pylist(), rows.column("packed"), strict=True) for i in range(n)]
        return _arrow([(x[:16], x[16:], None, None) for x in edges], CANDIDATES)
    keys, sizes, shingle, owner, place, ahead = [], [], [], [], [], []
    base = 0
    for n, blob in zip(rows.column("sets").to_pylist(), rows.column("packed"), strict=True):
        raw = np.frombuffer(blob.as_buffer(), np.uint8)
        m = (len(raw) - 20 * n) // 24
        cut = np.cumsum([0, 16 * n, 4 * n, 8 * m, 4 * m, 4 * m, 8 * m])
        part = [raw[x:y] for x, y in zip(cut[:-1], cut[1:], strict=True)]
        keys.append(part[0])
        sizes.append(part[1].copy().view("<u4"))
        shingle.append(part[2].copy().view(np.uint64))
        owner.append(part[3].copy().view("<u4").astype(np.int64) + base)
        place.append(part[4].copy().view("<u4").astype(np.int64))
        ahead.append(part[5].copy().view(np.uint64))
        base += n
    shingle, owner, place, ahead = np.concatenate(shingle), np.concatenate(owner), np.concatenate(place), np.concatenate(ahead)
    order = np.argsort(shingle, kind="stable")
    same = np.r_[False, shingle[order][1:] == shingle[order][:-1], False]
    order = order[same[1:] | same[:-1]]
    shingle, owner, place, ahead = shingle[order], owner[order], place[order], ahead[order]
    if not len(shingle):
        return _arrow([], CANDIDATES)
    used, owner = np.unique(owner, return_inverse=True)
    # the same set can come from several blocks
    key = np.ascontiguousarray(np.concatenate(keys).reshape(-1, 16)[used]).view("V16").ravel()
    size = np.concatenate(sizes).astype(np.int64)[used]
    distinct, first, one = np.unique(key, return_index=True, return_inverse=True)
    size, owner = size[first], one[owner]
    order = np.lexsort((owner, shingle))
    shingle, owner, place, ahead = shingle[order], owner[order], place[order], ahead[order]
    keep = np.r_[True, (shingle[1:] != shingle[:-1]) | (owner[1:] != owner[:-1])]
    shingle, owner, place, ahead = shingle[keep], owner[keep], place[keep], ahead[keep]
    left, right, a, b = list_candidates(shingle, owner, size[owner], place, ahead, percent)
    label = local_components(len(distinct), a, b)
    out: list[tuple] = [(distinct[label[i]].tobytes(), distinct[i].tobytes(), None, None) for i in np.flatnonzero(label != np.arange(len(label))).tolist()]
    apart = label[left] != label[right]  # the others meet in their group
    raw = distinct.view(np.uint8).reshape(-1, 16)
    left, right = raw[left[apart]], raw[right[apart]]
    shard = _shard_of(left, shards)
    order = np.argsort(shard, kind="stable")
    packed, cuts = np.concatenate([left, right], axis=1)[order], np.searchsorted(shard[order], np.arange(shards + 1))
    out += [(None, None, k, packed[cuts[k] : cuts[k + 1]].tobytes()) for k in np.flatnonzero(np.diff(cuts)).tolist()]
    return _arrow(out, CANDIDATES)


def _sets_of_shard(rows: pa.Table) -> tuple[dict[bytes, int], np.ndarray, np.ndarray, np.ndarray]:
    """Row of each key, sizes, and the bitmaps with their offsets, of the sets among ``rows``."""
    rows = rows.filter(rows.column("key").is_valid()).combine_chunks()
    bits = rows.column("bits").cast(pa.large_binary()).combine_chunks()
    offsets = np.frombuffer(bits.buffers()[1], np.int64)[bits.offset : bits.offset + len(bits) + 1] if len(bits) else np.zeros(1, np.int64)
    return {k: i for i, k in enumerate(rows.column("key").to_pylist())}, rows.column("n").to_numpy().astype(np.int64), np.frombuffer(bits.buffers()[2], np.uint8) if len(bits) else np.zeros(0, np.uint8), offsets


def _halves(rows: pa.Table, shards: int) -> pa.Table:
    """Different pairs of a shard with size and bitmap of their first set, packed for each shard of the second and width."""
    blobs = [blob for blob in rows.column("pairs").to_pylist() if blob is not None]
    out: list[tuple] = []
    if blobs:
        at, sizes, data, offsets = _sets_of_shard(rows)
        pairs = np.frombuffer(b"".join(blobs), np.uint8).reshape(-1, 32)
        parts = pairs.view(np.uint64)
        order = np.lexsort(parts.T)
        new = np.r_[True, (parts[order][1:] != parts[order][:-1]).any(axis=1)]
        pairs = pairs[order[new]]
        raw = pairs.tobytes()
        first = np.array([at[raw[i : i + 16]] for i in range(0, len(raw), 32)], np.int64)
        shard, widths = _shard_of(pairs[:, 16:], shards), np.diff(offsets)[first]
        for width in np.unique(widths).tolist():
            mine = np.flatnonzero(widths == width)
            mine = mine[np.argsort(shard[mine], kind="stable")]
            cuts = np.searchsorted(shard[mine], np.arange(shards + 1))
            for k in np.flatnonzero(np.diff(cuts)).tolist():
                for low in range(cuts[k], cuts[k + 1], chunk := max(1, MAP_BYTES // width)):
                    e = mine[low : min(low + chunk, cuts[k + 1])]
                    maps = data[offsets[first[e]][:, None] + np.arange(width)]
                    out.append((k, width, np.concatenate([pairs[e, 16:], pairs[e, :16], sizes[first[e]].astype("<i8").view(np.uint8).reshape(-1, 8), maps], axis=1).tobytes()))
    return _arrow(out, "shard long, width long, packed binary")


def _tested(rows: pa.Table, percent: int) -> pa.Table:
    """Edges between the sets of pairs whose sizes and bitmaps allow the similarity."""
    at, sizes, data, offsets = _sets_of_shard(rows)
    widths = np.diff(offsets)
    node: dict[bytes, int] = {}
    left, right = [], []
    for width, blob in zip(rows.column("width").to_pylist(), rows.column("packed").to_pylist(), strict=True):
        if blob is None:
            continue
        step = 40 + width
        pairs = np.frombuffer(blob, np.uint8).reshape(-1, step)
        second = np.array([at[blob[i : i + 16]] for i in range(0, len(blob), step)], np.int64)
        n = np.ascontiguousarray(pairs[:, 32:40]).view("<i8").ravel()
        for other in {width, 2 * width, width // 2} & set(np.unique(widths[second]).tolist()):  # no others have sizes so near
            mine = np.flatnonzero(widths[second] == other)
            for low in range(0, len(mine), chunk := max(1, MAP_BYTES // max(width, other))):
                e = mine[low : low + chunk]
                x, y = pairs[e, 40:], data[offsets[second[e]][:, None] + np.arange(other)]
                if other > width:
                    y = y[:, :width] ^ y[:, width:]
                elif other < width:
                    x = x[:, :other] ^ x[:, other:]
                differ = np.bitwise_count(np.ascontiguousarray(x ^ y).view(np.uint64)).sum(1, dtype=np.int64)
                both = n[e], sizes[second[e]]
                for i in e[(100 + percent) * np.maximum(differ, np.abs(both[0] - both[1])) <= (100 - percent) * (both[0] + both[1])].tolist():
                    left.append(node.setdefault(blob[step * i : step * i + 16], len(node)))
                    right.append(node.setdefault(blob[step * i + 16 : step * i + 32], len(node)))
    return _arrow(_moved(list(node), local_components(len(node), np.array(left, np.int64), np.array(right, np.int64))), "a binary, b binary")


def _near_pairs(pairs: DataFrame, classes: DataFrame, shards: int, percent: int) -> DataFrame:
    """Edges that hold sets of ``pairs`` together, where bitmaps allow; each pair meets the bitmaps of its two sets in turn."""
    shard = F.conv(F.hex(F.substring("key", 1, 4)), 16, 10).cast("long") % shards
    sets = classes.select(shard.alias("shard"), "key", "n", "bits")
    both = lambda d: d.unionByName(sets, allowMissingColumns=True).groupBy("shard")
    halves = both(pairs).applyInArrow(lambda t: _halves(t, shards), "shard long, width long, packed binary")
    return both(halves).applyInArrow(lambda t: _tested(t, percent), "a binary, b binary")


def similar_sets(sets: list[np.ndarray], side: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Links of every set and its component, both within these sets.

    With two sides only pairs across them count. Overlaps of a set with all
    others are derived from those of the set before, by the lists of the
    shingles in which the two differ, whenever that is less work.
    """
    m = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    across = side.any() and not side.all()
    links, label = np.zeros(m, np.int64), np.arange(m)
    if m == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        if 100 * both >= percent * (sizes.sum() - both):
            links[:], label[:] = 1, 0
        return links, label
    shingles, word = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(m), sizes)
    shared = np.bincount(word, minlength=len(shingles)) > 1
    dense = np.cumsum(shared) - 1
    keep = shared[word]
    word, owner = dense[word[keep]], owner[keep]
    by_set = np.searchsorted(owner, np.arange(m + 1))
    order = np.argsort(word, kind="stable")
    lists, at = owner[order], np.searchsorted(word[order], np.arange(int(shared.sum()) + 1))
    cost = np.diff(at)

    def overlaps(words: np.ndarray) -> np.ndarray:
        n = cost[words]
        pick = np.repeat(at[words] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return np.bincount(lists[pick], minlength=m)

    todo = np.ones(m, bool)
    before = np.zeros(0, np.int64)
    count = np.zeros(m, np.int64)
    x = 0
    for _ in range(m):
        todo[x] = False
        words = word[by_set[x] : by_set[x + 1]]
        gone, come = np.setdiff1d(before, words, assume_unique=True), np.setdiff1d(words, before, assume_unique=True)
        if cost[gone].sum() + cost[come].sum() < cost[words].sum():
            count = count - overlaps(gone) + overlaps(come)
        else:
            count = overlaps(words)
        before = words
        answer = 100 * count >= percent * (sizes[x] + sizes - count)
        answer &= side != side[x] if across else True
        answer[x] = False
        found = np.flatnonzero(answer)
        links[x] = len(found)
        if len(found):
            roots = np.unique(np.r_[label[found], label[x]])
            if len(roots) > 1:
                label[np.isin(label, roots)] = roots[0]
        left = np.where(todo, count, -1)
        x = int(left.argmax())
    return links, label


def bitmap_pairs(bits: list[bytes], sizes: np.ndarray, side: np.ndarray, percent: int = PERCENT, roots: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs whose sizes and bitmaps allow the similarity; with two sides only pairs across, with ``roots`` theirs."""
    across = side.any() and not side.all()
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    length = np.array([len(b) for b in bits])
    for width in np.unique(length).tolist():
        # bitmaps of this width, and those twice as wide folded onto it: no others have sizes so near
        rows = np.flatnonzero((length == width) | (length == 2 * width))
        maps = np.zeros((len(rows), width), np.uint8)
        for i, r in enumerate(rows.tolist()):
            raw = np.frombuffer(bits[r], np.uint8)
            maps[i] = raw if len(raw) == width else raw[:width] ^ raw[width:]
        words = maps.view(np.uint64)
        n, own = sizes[rows], np.flatnonzero(length[rows] == width)
        step = max(1, 4_000_000 // max(1, len(rows) * words.shape[1]))
        for low in range(0, len(own), step):
            part = own[low : low + step]
            differ = np.bitwise_count(words[part][:, None] ^ words[None]).sum(2, dtype=np.int64)
            total = n[part][:, None] + n[None]
            # |x - y| + |y - x| <= (100 - percent) / (100 + percent) * (|x| + |y|)
            fits = (100 + percent) * np.maximum(differ, np.abs(n[part][:, None] - n[None])) <= (100 - percent) * total
            if across:
                fits &= side[rows][part][:, None] != side[rows][None]
            i, j = np.nonzero(fits)
            a, b = rows[part[i]], rows[j]
            pick = (a < b) | (length[b] != width)
            a, b = a[pick], b[pick]
            if roots is not None:
                pair = np.unique(roots[a].astype(np.int64) << 32 | roots[b])
                a, b = pair >> 32, pair & 0xFFFFFFFF
            left.append(a)
            right.append(b)
    return np.concatenate(left), np.concatenate(right)


def _cells(rows: pa.Table) -> dict[tuple, list[int]]:
    """Rows of each block of a group, in a bundle of such blocks."""
    out: dict[tuple, list[int]] = {}
    for i, cell in enumerate(zip(rows.column("component").to_pylist(), rows.column("block").to_pylist(), strict=True)):
        out.setdefault(cell, []).append(i)
    return out


def _arrow(rows: list[tuple], schema: str) -> pa.Table:
    types = {"binary": pa.binary(), "long": pa.int64()}
    names = [field.split() for field in schema.split(", ")]
    return pa.table({name: pa.array([r[i] for r in rows], types[kind]) for i, (name, kind) in enumerate(names)})


def pack_sets(sets: list[np.ndarray]) -> tuple[bytes, bytes, bytes]:
    """Lengths, common shingles and bodies: each set as its difference from the shingles that over half of them have."""
    shingles, counts = np.unique(np.concatenate(sets), return_counts=True)
    common = shingles[2 * counts > len(sets)]
    other = [np.setxor1d(s, common, assume_unique=True) for s in sets]
    return np.array([len(o) for o in other], "<u4").tobytes(), common.tobytes(), np.concatenate(other).tobytes()


def unpack_sets(lengths: bytes, common: bytes, body: bytes) -> list[np.ndarray]:
    base, other = np.frombuffer(common, np.uint64), np.frombuffer(body, np.uint64)
    cuts = np.r_[0, np.cumsum(np.frombuffer(lengths, "<u4").astype(np.int64))]
    return [np.setxor1d(other[lo:hi], base, assume_unique=True) for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


def _packed(cell: tuple, keys: list[bytes], sizes: np.ndarray, roots: np.ndarray, coded: tuple[bytes, bytes, bytes]) -> tuple:
    return (*cell, int(sizes.min()), int(sizes.max()), b"".join(keys), sizes.astype("<u4").tobytes(), roots.astype("<u4").tobytes(), *coded)


def _moved(names: list[bytes], label: np.ndarray) -> list[tuple[bytes, bytes]]:
    """Edges from the nodes that are not their own label."""
    return [(names[label[i]], names[i]) for i in np.flatnonzero(label != np.arange(len(label))).tolist()]


def _refined(rows: pa.Table, percent: int) -> pa.Table:
    """Edges that still hold a candidate group together, within blocks; and the blocks of groups that have several."""
    keys, bits = rows.column("key").to_pylist(), rows.column("bits").to_pylist()
    blocks, sizes = rows.column("blocks").to_numpy(), rows.column("n").to_numpy()
    out: list[tuple] = []
    for cell, members in _cells(rows).items():
        names, maps, n = [keys[i] for i in members], [bits[i] for i in members], sizes[members]
        label = local_components(len(n), *bitmap_pairs(maps, n, np.zeros(len(n), bool), percent))
        out += [(*edge, *[None] * 10) for edge in _moved(names, label)]
        if blocks[members[0]] > 1:
            out.append((None, None, *_packed(cell, names, n, label, (np.array([len(b) for b in maps], "<u4").tobytes(), b"", b"".join(maps)))))
    return _arrow(out, f"a binary, b binary, {PACKED}")


def _strip(rows: pa.Table) -> Iterator[tuple[dict, dict]]:
    """The block of a task with each later one."""
    table = rows.to_pylist()
    first = next((r for r in table if r["block"] == r["lo"]), None)
    for row in table:
        if first is not None and row is not first:
            yield first, row


def _both(first: dict, row: dict) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """Keys, sizes, sides and roots of the sets of two blocks."""
    joined = first["keys"] + row["keys"]
    sizes = np.frombuffer(first["sizes"] + row["sizes"], "<u4").astype(np.int64)
    m = len(first["sizes"]) // 4
    roots = np.frombuffer(first["roots"] + row["roots"], "<u4").astype(np.int64)
    side = np.arange(len(sizes)) >= m
    return [joined[i : i + 16] for i in range(0, len(joined), 16)], sizes, side, roots + m * side


def _refined_across(rows: pa.Table, percent: int) -> pa.Table:
    """Edges between the components of blocks."""
    out: list[tuple] = []
    for first, row in _strip(rows):
        names, sizes, side, roots = _both(first, row)
        body, cuts = first["body"] + row["body"], np.r_[0, np.cumsum(np.frombuffer(first["lengths"] + row["lengths"], "<u4").astype(np.int64))].tolist()
        maps = [body[lo:hi] for lo, hi in zip(cuts[:-1], cuts[1:], strict=True)]
        out += _moved(names, local_components(len(names), *bitmap_pairs(maps, sizes, side, percent, roots)))
    return _arrow(out, "a binary, b binary")


def _linked_across(rows: pa.Table, percent: int) -> pa.Table:
    """Links of every set to the sets of the other blocks of a task, packed by block; edges between components of blocks."""
    out: list[tuple] = []
    total, task = None, None
    for first, row in _strip(rows):
        names, sizes, side, roots = _both(first, row)
        links, label = similar_sets([s for r in (first, row) for s in unpack_sets(r["lengths"], r["common"], r["body"])], side, percent)
        found = np.flatnonzero(label != np.arange(len(label)))
        out += [(*edge, None, None, None) for edge in _moved(names, local_components(len(names), roots[found], roots[label[found]]))]
        total, task = links[~side] if total is None else total + links[~side], first
        out.append((None, None, row["component"], row["block"], links[side].astype("<i8").tobytes()))
    if task is not None:
        out.append((None, None, task["component"], task["block"], total.astype("<i8").tobytes()))
    return _arrow(out, "a binary, b binary, component binary, block long, links binary")


def _summed(rows: pa.Table) -> pa.Table:
    """Links of every set of a block, added up over the tasks that the block was in."""
    keys = next(k for k in rows.column("keys").to_pylist() if k is not None)
    total = np.zeros(len(keys) // 16, np.int64)
    for part in rows.column("links"):
        if part.is_valid:
            total += np.frombuffer(part.as_buffer(), "<i8")
    return pa.table({"key": pa.array([keys[i : i + 16] for i in range(0, len(keys), 16)], pa.binary()), "links": total})


def _across(packed: DataFrame, percent: int) -> DataFrame:
    """Packed blocks dealt to tasks of one block (``lo``) and a strip of later ones, where sizes allow a link."""
    later = packed.select("component", "block", "low", "high").where("block > 0").withColumn("lo", F.explode(F.sequence(F.lit(0).cast("long"), F.col("block") - 1)))
    earlier = packed.select("component", F.col("block").alias("lo"), F.col("low").alias("least"), F.col("high").alias("most"))
    pairs = later.join(earlier, ["component", "lo"]).where((100 * F.col("most") >= percent * F.col("low")) & (100 * F.col("high") >= percent * F.col("least")))
    pairs = pairs.select("component", "lo", "block", F.floor(F.col("block") / STRIP).alias("strip"))
    first = pairs.select("component", "lo", F.col("lo").alias("block"), "strip").distinct()
    return pairs.unionByName(first).join(packed.hint("merge"), ["component", "block"]).groupBy("component", "lo", "strip")


def _dealt(classes: DataFrame, groups: DataFrame, sets: int, weight: int, label: str) -> DataFrame:
    """Members of groups of two and more, each once, with their block.

    A group above either limit is cut into blocks in the order of set sizes; sets
    of one size go by hash. Only the counts of a group's sizes are put in order,
    never its sets. Blocks of small groups share a bundle.
    """
    grouped = classes.join(groups.withColumnRenamed("node", "key"), "key")
    share = F.greatest(F.lit(1.0 / sets), F.col("n") / F.lit(float(weight)))
    whole = Window.partitionBy("component")
    upto = whole.orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    sizes = grouped.groupBy("component", "n").agg(F.count("*").alias("same")).withColumn("share", share)
    part = F.col("same") * F.col("share")
    sizes = sizes.select("*", F.coalesce(F.sum(part).over(upto), F.lit(0.0)).alias("before"), F.sum(part).over(whole).alias("total"), F.sum("same").over(whole).alias("sets")).where("sets > 1")
    # a sum of fractions may come out a little above the limit that it meets
    blocks = F.greatest(F.lit(1), F.ceil(F.col("total") - 1e-6))
    place = F.floor(F.col("before") + F.pmod(F.xxhash64("key"), F.col("same")) * F.col("share"))
    members = grouped.join(sizes, ["component", "n"]).withColumn("blocks", blocks).withColumn("block", F.least(place, F.col("blocks") - 1))
    members = settle(members.drop("same", "share", "before", "total", "sets"), label)
    bundles = F.lit(parts_for(members.count(), sets))
    return members.withColumn("bundle", F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("component"), bundles)).otherwise(F.xxhash64("component", "block")))


def _group_rows(rows: pa.Table, width: int, percent: int) -> pa.Table:
    """Answers within blocks; and the blocks of groups that have several."""
    rows = rows.combine_chunks()
    keys, blocks = rows.column("key").to_pylist(), rows.column("blocks").to_pylist()
    column = rows.column("text").chunk(0) if rows.num_rows else pa.array([], pa.string())
    text, offsets = text_buffers(column)
    cell = {i: c for c, members in _cells(rows).items() for i in members}
    groups: dict[tuple, dict[bytes, np.ndarray]] = {}
    several = set()
    row = 0
    for start, stop in text_slices(column, SLICE_BYTES):
        for s in shingle_sets(text, offsets[start : stop + 1], width):
            if set_key(s) == keys[row]:
                groups.setdefault(cell[row], {})[keys[row]] = s
                if blocks[row] > 1:
                    several.add(cell[row])
            row += 1
    out: list[tuple] = []
    for at, members in groups.items():
        names, sets = list(members), list(members.values())
        links, label = similar_sets(sets, np.zeros(len(sets), bool), percent) if len(sets) > 1 else (np.zeros(1, np.int64), np.zeros(1, np.int64))
        out += [(k, names[r], int(n), *[None] * 10) for k, r, n in zip(names, label.tolist(), links.tolist(), strict=True)]
        if at in several:
            out.append((None, None, None, *_packed(at, names, np.array([len(s) for s in sets]), label, pack_sets(sets))))
    return _arrow(out, f"key binary, root binary, links long, {PACKED}")


def jaccard_components(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``(doc_id, n_shingles, key, links, component_id)`` for every row of ``docs``.

    Words are lower-cased (A-Z); a text of fewer than ``width`` words is one
    shingle, a null text or one without words has none and links with nothing.
    ``links`` is the number of different sets that a row's set links to.
    ``component_id`` is the smallest ``doc_id`` reachable by links. Rows that
    repeat are members of the same set. Other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("tag"), F.col("text").cast("string").alias("text"))
    prints = settle(fingerprints(rows, width), "fingerprints")
    members = prints.where("n IS NOT NULL").select("doc_id", "tag", "n", "key", "bits")
    rep = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tag"))
    classes = members.where("key IS NOT NULL").groupBy("key").agg(rep.alias("rep"), F.first("n").alias("n"), F.first("bits").alias("bits"))
    classes = settle(classes.select("key", F.col("rep.doc_id").alias("rep"), F.col("rep.tag").alias("tag"), "n", "bits"), "sets")

    frequent = prints.where("shingle IS NOT NULL").groupBy("shingle").agg(F.sum("count").alias("count")).orderBy(F.desc("count"), "shingle").limit(ORDERED_LAST).collect()
    late = np.array([r[0] for r in frequent], np.int64).view(np.uint64)
    order = np.argsort(late)
    rank = np.arange(len(late))[::-1][order].astype(np.int64)
    hot = np.array([r[0] for r in frequent if r[1] > HOT_LIST], np.int64).view(np.uint64)
    words = prints.where("word IS NOT NULL").groupBy("word").agg(F.sum("count").alias("count")).orderBy(F.desc("count"), "word").limit(COMMON_WORDS).collect()
    common = np.array([r[0] for r in words], np.int64).view(np.uint64)
    weight = np.round(4 * np.log2(np.array([r[1] for r in words], np.float64) / (words[-1][1] if words else 1) + 1)).astype(np.int64)
    by_hash = np.argsort(common)
    last = spark.sparkContext.broadcast((late[order], rank, hot, common[by_hash], weight[by_hash]))

    entries, n_sets, n_shingles = classes.agg(F.sum(F.floor(F.col("n") * (100 - percent) / 100) + 1), F.count("*"), F.sum("n")).first()
    shards = max(parts_for(n_sets, SHARD_SETS), parts_for(n_shingles or 0, SHARD_SHINGLES))
    index = _index_rows(rows, last, parts_for(entries or 0, BUCKET_ENTRIES), width, percent)
    candidates = settle(index.groupBy("bucket").applyInArrow(lambda t: _bucket_groups(t, percent, shards), CANDIDATES), "candidates")
    chained = components(candidates.where("a IS NOT NULL").select("a", "b"), "groups")
    rough = _dealt(classes.select("key", "n", "bits"), chained, REFINED_SETS, REFINED_SHINGLES, "rough")
    refined = rough.groupBy("bundle").applyInArrow(lambda t: _refined(t, percent), f"a binary, b binary, {PACKED}")
    if not rough.where("blocks > 1").isEmpty():
        refined = settle(refined, "refined-blocks")
        across = _across(refined.where("component IS NOT NULL").drop("a", "b"), percent).applyInArrow(lambda t: _refined_across(t, percent), "a binary, b binary")
        refined = refined.where("a IS NOT NULL").select("a", "b").unionByName(across)
    refined = refined.where("a IS NOT NULL").select("a", "b").unionByName(_near_pairs(candidates.where("pairs IS NOT NULL").select("shard", "pairs"), classes, shards, percent))
    cells = _dealt(classes.select("key", "rep", "tag", "n"), components(refined, "refined"), GROUP_SETS, GROUP_SHINGLES, "cells")
    texts = rows.select(F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("doc_key"), "tag", "text")
    dealt = cells.withColumn("doc_key", F.coalesce("rep", F.lit((1 << 63) - 1))).drop("rep")
    # texts meet their sets in the same way at every size: both sides sorted, neither broadcast
    dealt = texts.join(dealt.hint("merge"), ["doc_key", "tag"]).select("key", "text", "component", "block", "blocks", "bundle")
    inner = settle(dealt.groupBy("bundle").applyInArrow(lambda t: _group_rows(t, width, percent), f"key binary, root binary, links long, {PACKED}"), "links")
    found = inner.where("key IS NOT NULL").select("key", "root", "links")
    if not cells.where("blocks > 1").isEmpty():
        packed = inner.where("component IS NOT NULL").drop("key", "root", "links")
        across = settle(_across(packed, percent).applyInArrow(lambda t: _linked_across(t, percent), "a binary, b binary, component binary, block long, links binary"), "across")
        edges = found.where("key <> root").select(F.col("key").alias("a"), F.col("root").alias("b")).unionByName(across.where("a IS NOT NULL").select("a", "b"))
        linked = components(edges, "linked")
        parts = packed.select("component", "block", "keys", F.lit(None).cast("binary").alias("links")).unionByName(across.where("links IS NOT NULL").select("component", "block", F.lit(None).cast("binary").alias("keys"), "links"))
        links = found.select("key", "links").unionByName(parts.groupBy("component", "block").applyInArrow(_summed, "key binary, links long")).groupBy("key").agg(F.sum("links").alias("links"))
    else:
        linked = found.where("key <> root OR links > 0").select(F.col("key").alias("node"), F.col("root").alias("component"))
        links = found.select("key", "links")
    answers = classes.join(linked.withColumnRenamed("node", "key"), "key", "left").withColumn("component", F.coalesce("component", "key"))
    lowest = answers.groupBy("component").agg(F.min("rep").alias("component_id"))
    answers = answers.select("key", "component").join(lowest, "component").join(links, "key", "left").select("key", "component_id", "links")
    return members.join(answers, "key", "left").select("doc_id", F.col("n").alias("n_shingles"), "key", F.coalesce("links", F.lit(0)).alias("links"), F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def keep_one(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest ``doc_id``.

    Rows without words stay. Rows that repeat with the same ``doc_id`` and text
    are one document. Rows without a ``doc_id`` stay together, and only where
    one of them is without words or in a component with no ``doc_id`` at all.
    """
    found = jaccard_components(docs, width, percent)
    whole = F.coalesce("doc_id", F.lit((1 << 63) - 1))
    first = found.where("key IS NOT NULL").select(F.col("component_id").alias("doc_id")).unionByName(found.where("key IS NULL").select("doc_id"))
    wanted = settle(first.select(whole.alias("_kept")).distinct(), "kept")
    kept, tag = fresh("_kept", docs.columns), fresh("_tag", docs.columns)
    marked = docs.withColumn(kept, F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)))
    one = marked.join(wanted.withColumnRenamed("_kept", kept).hint("merge"), kept, "left_semi").withColumn(tag, F.xxhash64("text"))
    return one.dropDuplicates([kept, tag]).select(*docs.columns)
