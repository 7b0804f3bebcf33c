"""Quality classifier: nearest-neighbour voting in latent-semantic space.

A text is the bag of its words and of their shapes (letters, capitals and
digits each count as one sign, runs of a sign once), both hashed into buckets.
Bucket weights are tf-idf, with document counts over all texts. A truncated
singular value decomposition of a bounded sample of labelled texts gives the
latent space; the sample's vectors are broadcast, every text's cosine with all
of them is computed block by block, and the labels of its nearest ones vote,
weighted by similarity and by how rare their label is in the sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labormart.llm.common import settle
from labormart.llm.words import hash_words, text_buffers, text_slices

WORD_BUCKETS = 3072
SHAPE_BUCKETS = 1024
BUCKETS = WORD_BUCKETS + SHAPE_BUCKETS
#: Labelled texts of each label that the space is fitted on and that vote, at most.
SAMPLE_PER_LABEL = 3000
#: Dimensions of the latent space.
DIMENSIONS = 64
#: Nearest labelled texts that vote, and the power of their similarity.
NEIGHBOURS = 24
SHARPNESS = 8
#: Vote of the share of each label over all labelled rows.
PRIOR_WEIGHT = 1e-3
#: Texts whose cosines with all labelled vectors are computed at once.
BLOCK_TEXTS = 512

_SIGN = np.arange(256, dtype=np.uint8)
_SIGN[97:123] = _SIGN[128:] = ord("a")
_SIGN[65:91] = ord("A")
_SIGN[48:58] = ord("0")


def _shapes(text: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with every sign of a run but the first left out, and their offsets."""
    signs = _SIGN[text[offsets[0] : offsets[-1]]]
    stays = np.ones(len(signs), bool)
    stays[1:] = signs[1:] != signs[:-1]
    starts = offsets - offsets[0]
    stays[starts[:-1][starts[:-1] < len(signs)]] = True
    return signs[stays], np.concatenate([[0], np.cumsum(stays)])[starts]


def bags(text: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(text, bucket, count)`` of all texts, by text and bucket."""
    keys = []
    for words, bounds, first, buckets in ((*hash_words(text, offsets, lower=True), 0, WORD_BUCKETS), (*hash_words(*_shapes(text, offsets)), WORD_BUCKETS, SHAPE_BUCKETS)):
        owner = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
        keys.append(owner * BUCKETS + first + (words % np.uint64(buckets)).astype(np.int64))
    key, count = np.unique(np.concatenate(keys), return_counts=True)
    return key // BUCKETS, key % BUCKETS, count


def weighted(owner: np.ndarray, bucket: np.ndarray, count: np.ndarray, idf: np.ndarray, n: int) -> np.ndarray:
    """tf-idf of each entry; a text's words, and its shapes, have length one each."""
    weight = (1.0 + np.log(count)) * idf[bucket]
    group = owner * 2 + (bucket >= WORD_BUCKETS)
    length = np.sqrt(np.bincount(group, weight**2, minlength=2 * n))
    return weight / np.maximum(length[group], 1e-12)


def _latent(owner: np.ndarray, bucket: np.ndarray, weight: np.ndarray, space: np.ndarray, n: int) -> np.ndarray:
    """Unit vectors of the texts in the latent space; a text without words is zero."""
    out = np.zeros((n, space.shape[1]))
    for low in range(0, len(owner), 1 << 18):  # entries are by text: sums of runs
        part = slice(low, low + (1 << 18))
        rows, first = np.unique(owner[part], return_index=True)
        if len(rows):
            out[rows] += np.add.reduceat(space[bucket[part]] * weight[part, None], first, axis=0)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


@dataclass
class Model:
    idf: np.ndarray
    space: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    votes: np.ndarray
    prior: float

    def scores(self, column: pa.Array) -> np.ndarray:
        """Score of every text; one without any similar labelled text has the prior."""
        out = np.full(len(column), self.prior)
        text, all_offsets = text_buffers(column)
        for start, stop in text_slices(column):
            n, offsets = stop - start, all_offsets[start : stop + 1]
            if not len(self.vectors):
                continue
            owner, bucket, count = bags(text, offsets)
            latent = _latent(owner, bucket, weighted(owner, bucket, count, self.idf, n), self.space, n)
            for low in range(0, n, BLOCK_TEXTS):
                cosines = latent[low : low + BLOCK_TEXTS] @ self.vectors.T
                k = min(NEIGHBOURS, cosines.shape[1])
                limit = -np.partition(-cosines, k - 1, axis=1)[:, k - 1 : k]
                near = np.where(cosines >= limit - 1e-9, np.maximum(cosines, 0), 0) ** SHARPNESS * self.votes
                whole = near.sum(1)
                out[start + low : start + low + len(near)] = (near @ self.labels + PRIOR_WEIGHT * self.prior) / (whole + PRIOR_WEIGHT)
        return np.clip(np.round(out, 9), 0, 1)


def document_counts(docs: DataFrame, text_column: str) -> tuple[np.ndarray, int]:
    """In how many of all texts each bucket stands, and how many texts there are."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            text, offsets = text_buffers(batch.column(0))
            for start, stop in text_slices(batch.column(0)):
                total += np.bincount(bags(text, offsets[start : stop + 1])[1], minlength=BUCKETS)
                n += stop - start
        yield pa.RecordBatch.from_arrays([pa.array([*np.flatnonzero(total), BUCKETS]), pa.array([*total[total > 0], n])], ["bucket", "n"])

    # one row a bucket comes to the driver, whatever the input
    rows = docs.select(text_column).mapInArrow(counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    found = np.zeros(BUCKETS + 1, np.int64)
    for r in rows:
        found[r["bucket"]] = r["n"]
    return found[:BUCKETS], int(found[BUCKETS])


def latent_space(rows: np.ndarray, dimensions: int, seed: int = 11) -> np.ndarray:
    """Right singular vectors of ``rows``, by random projection and two power steps."""
    rng = np.random.default_rng(seed)
    width = min(dimensions + 16, *rows.shape)
    basis = rng.standard_normal((rows.shape[1], width)).astype(rows.dtype)
    for _ in range(3):
        image, _ = np.linalg.qr(rows @ basis)
        basis = rows.T @ image
    _, _, right = np.linalg.svd(basis.T, full_matrices=False)
    return right[:dimensions].T.astype(float)


def fit(docs: DataFrame, labels: DataFrame, trains: Column, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality") -> Model:
    """Document counts over all ``docs``; space and votes from a bounded sample of labels.

    ``labels(id, label)`` holds 0 or 1, other values and nulls are left out; ``trains``
    is a condition on its id. At most ``SAMPLE_PER_LABEL`` rows of each label
    are taken, by a hash of the id; how often each label stands in all training
    rows sets the weight of its votes. With no usable label the score is 0.5.
    """
    known = labels.where(trains).select(F.col(id_column).alias("_id"), F.col(label_column).cast("int").alias("_label")).where("_id IS NOT NULL AND _label IN (0, 1)")
    totals = {r["_label"]: r["n"] for r in known.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    rows = sum(totals.values())
    prior = totals.get(1, 0) / rows if rows else 0.5
    counts, n_texts = document_counts(docs, text_column)
    idf = np.log((1.0 + n_texts) / (1.0 + counts)) + 1.0
    picked = None
    for label in sorted(totals):
        part = known.where(F.col("_label") == label).dropDuplicates(["_id"]).orderBy(F.xxhash64("_id"), "_id").limit(SAMPLE_PER_LABEL)
        picked = part if picked is None else picked.unionByName(part)
    if picked is None:
        return Model(idf, np.zeros((BUCKETS, 1)), np.zeros((0, 1)), np.zeros(0), np.zeros(0), prior)
    picked = settle(picked, "labelled")  # at most SAMPLE_PER_LABEL rows a label: small enough to broadcast
    sample = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text")).join(F.broadcast(picked), "_id").dropDuplicates(["_id"])

    def bagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, offsets = text_buffers(batch.column(1))
            for start, stop in text_slices(batch.column(1)):
                n = stop - start
                owner, bucket, count = bags(text, offsets[start : stop + 1])
                weight, ends = weighted(owner, bucket, count, idf, n), np.searchsorted(owner, np.arange(n + 1))
                cut = lambda x, kind, ends=ends, n=n: pa.array([x[ends[i] : ends[i + 1]].astype(kind).tobytes() for i in range(n)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, n), cut(bucket, "<u2"), cut(weight, "<f4")], ["label", "bucket", "weight"])

    found = sample.select("_label", "_text").mapInArrow(bagged, "label int, bucket binary, weight binary").collect()
    found.sort(key=lambda r: (r["label"], bytes(r["bucket"]), bytes(r["weight"])))
    matrix, label = np.zeros((len(found), BUCKETS), np.float32), np.array([r["label"] for r in found], float)
    for i, r in enumerate(found):
        matrix[i, np.frombuffer(r["bucket"], "<u2")] = np.frombuffer(r["weight"], "<f4")
    matrix, label = matrix[(filled := matrix.any(1))], label[filled]
    if not len(matrix):
        return Model(idf, np.zeros((BUCKETS, 1)), np.zeros((0, 1)), np.zeros(0), np.zeros(0), prior)
    space = latent_space(matrix, DIMENSIONS)
    vectors = matrix @ space
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    shown = {c: max(1, int((label == c).sum())) for c in (0, 1)}
    votes = np.array([totals[int(c)] / shown[int(c)] for c in label])
    return Model(idf, space, vectors, label, votes / votes.mean(), prior)


def scored(docs: DataFrame, model: Model, text_column: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with a column ``score`` between 0 and 1 added, replacing one of that name.

    Null and empty texts score as texts without any word do: the share of label 1.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c != name]
    schema = docs.select(*kept).schema.add(name, "double")
    place = kept.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = shared.value.scores(batch.column(place))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score, pa.float64())], [*kept, name])

    return docs.select(*kept).mapInArrow(run, schema)


def held_out(id_column: str = "doc_id") -> Column:
    """Every third id by its CRC-32, never trained on; a null id is none of them."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 3 == 1, F.lit(False))


def score_quality(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every row; empty tables give no rows."""
    model = fit(docs, labels, ~held_out(id_column), id_column, text_column)
    rows = scored(docs.select(id_column, text_column), model, text_column)
    return rows.select(id_column, held_out(id_column).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def evaluated(rows: DataFrame, labels: DataFrame, id_column: str = "doc_id", label_column: str = "quality") -> DataFrame:
    """Held-out accuracy, both labels' recall and the area under the curve, in one row.

    The area counts pairs of unlike labels by rank over the distinct scores, a
    partial aggregate, so no list of scores is ever gathered.
    """
    from pyspark.sql.window import Window

    known = labels.select(F.col(id_column), F.col(label_column).cast("int").alias("label")).where("label IN (0, 1)").dropDuplicates([id_column])
    both = rows.where("held_out").join(known, id_column)
    by_score = both.groupBy(F.round("score", 4).alias("score")).agg(
        F.sum("label").alias("ones"), F.sum(1 - F.col("label")).alias("zeros"), F.sum(F.col("label") * F.col("predicted")).alias("hit1"), F.sum((1 - F.col("label")) * (1 - F.col("predicted"))).alias("hit0")
    )
    # at most 10,001 distinct scores
    below = F.coalesce(F.sum("zeros").over(Window.orderBy("score").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = by_score.withColumn("won", F.col("ones") * (below + F.col("zeros") / 2))
    ones, zeros = F.sum("ones"), F.sum("zeros")
    return ranked.agg(
        (ones + zeros).alias("n"), ((F.sum("hit1") + F.sum("hit0")) / (ones + zeros)).alias("accuracy"), (F.sum("hit1") / ones).alias("recall_1"), (F.sum("hit0") / zeros).alias("recall_0"), (F.sum("won") / (ones * zeros)).alias("auc")
    )
