"""Quality classifier: features and votes against plain versions, odd inputs, held-out accuracy."""

import collections
import math
import zlib

import brute
import numpy as np
import pyarrow as pa
import pytest
from labormart.llm import classifier
from labormart.llm.words import text_buffers
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int, score double, _id long"


def signs(text):
    out = []
    for b in text.encode():
        sign = ord("a") if b >= 128 or 97 <= b < 123 else ord("A") if 65 <= b < 91 else ord("0") if 48 <= b < 58 else b
        if not out or out[-1] != sign:
            out.append(sign)
    return bytes(out).decode()


def test_bags_count_words_and_shapes():
    texts = ["One two, two!! | 123 Ärger", "", None, "  \t", "AAA aaa AAA", "x" * 5000 + " " + "y!" * 4000]
    text, offsets = text_buffers(pa.array(texts))
    owner, bucket, count = classifier.bags(text, offsets)
    lone = {}
    for word in {w for t in texts for w in (*brute.words(brute.lower(t)), *(s for s in brute.words(signs(t or ""))))}:
        one = classifier.hash_words(*text_buffers(pa.array([word])))[0]
        lone[word] = int(one[0])
    want = collections.Counter()
    for i, t in enumerate(texts):
        want.update((i, lone[w] % classifier.WORD_BUCKETS) for w in brute.words(brute.lower(t)))
        want.update((i, classifier.WORD_BUCKETS + lone[s] % classifier.SHAPE_BUCKETS) for s in brute.words(signs(t or "")))
    assert dict(zip(zip(owner.tolist(), bucket.tolist(), strict=True), count.tolist(), strict=True)) == dict(want)


def test_votes_are_exact_cosines(llm, monkeypatch):
    """Scores equal those of a plain loop over all labelled vectors, in blocks of any size."""
    docs, labels = (llm.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = classifier.fit(docs, labels, ~classifier.held_out())
    texts = [r.text for r in docs.orderBy("doc_id").select("text").limit(60).collect()]
    monkeypatch.setattr(classifier, "BLOCK_TEXTS", 7)
    got = model.scores(pa.array(texts))
    for t, score in zip(texts, got, strict=True):
        text, offsets = text_buffers(pa.array([t]))
        owner, bucket, count = classifier.bags(text, offsets)
        weight = [(1 + math.log(c)) * model.idf[b] for b, c in zip(bucket, count, strict=True)]
        lengths = [math.sqrt(sum(w * w for w, b in zip(weight, bucket, strict=True) if (b >= classifier.WORD_BUCKETS) == side)) for side in (False, True)]
        point = sum((w / lengths[int(b >= classifier.WORD_BUCKETS)] * model.space[b] for w, b in zip(weight, bucket, strict=True)), np.zeros(model.space.shape[1]))
        cosines = model.vectors @ (point / np.linalg.norm(point))
        limit = sorted(cosines)[-classifier.NEIGHBOURS]
        votes = [max(c, 0) ** classifier.SHARPNESS * v if c >= limit - 1e-9 else 0 for c, v in zip(cosines, model.votes, strict=True)]
        want = (np.dot(votes, model.labels) + classifier.PRIOR_WEIGHT * model.prior) / (sum(votes) + classifier.PRIOR_WEIGHT)
        assert abs(want - score) < 1e-6


def test_document_counts_cover_all_texts(llm):
    docs = llm.read.parquet("/root/testdata/sf0.001/documents.parquet")
    counts, n = classifier.document_counts(docs.repartition(5), "text")
    want = collections.Counter()
    rows = [r.text for r in docs.select("text").collect()]
    for t in rows:
        want.update(set(classifier.bags(*text_buffers(pa.array([t])))[1].tolist()))
    assert n == len(rows) and {b: c for b, c in enumerate(counts.tolist()) if c} == dict(want)


def test_held_out_accuracy(llm):
    docs, labels = (llm.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = classifier.score_quality(docs, labels)
    found = classifier.evaluated(rows, labels).first()
    known = {r.doc_id: r.quality for r in labels.collect()}
    both = [(known[r.doc_id], r.score, r.predicted) for r in rows.collect() if zlib.crc32(str(r.doc_id).encode()) % 3 == 1 and r.doc_id in known]
    assert found.n == len(both) and abs(found.accuracy - np.mean([q == p for q, _, p in both])) < 1e-9
    pairs = [(a > b) + (a == b) / 2 for q, a, _ in both for z, b, _ in both if q == 1 and z == 0]
    assert abs(found.auc - np.mean(pairs)) < 1e-3
    assert found.accuracy > 0.95 and found.auc > 0.97


def test_held_out_labels_change_nothing(llm):
    docs, labels = (llm.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.withColumn("quality", F.when(classifier.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    blind = docs.withColumns({"lang": F.lit("xx"), "source": F.lit(None).cast("string")})
    rows = lambda d, q: sorted(map(tuple, classifier.score_quality(d, q).collect()))
    assert rows(docs, labels) == rows(blind, flipped)


@pytest.mark.parametrize("labelled", [[], [(1, 1, 0, 0.0, 1)], [(1, 1, 0, 0.0, 1), (4, 0, 1, 0.0, 1), (5, 0, 1, 0.0, 1), (9, 0, 0, 0.0, 2), (9, 0, 0, 0.0, 2), (None, 1, 0, 0.0, 3), (13, None, 0, 0.0, 3), (12, 7, 0, 0.0, 3)]])
def test_odd_documents_and_labels(llm, odd, empty, labelled):
    labels = llm.createDataFrame(labelled, LABELS)
    rows = classifier.score_quality(odd.withColumn("score", F.lit(9)), labels).collect()
    assert len(rows) == odd.count()
    by_id = collections.defaultdict(set)
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        by_id[r.doc_id].add(r.score)
    assert by_id[4] == by_id[5] == by_id[6] and by_id[1] == by_id[2] and len(by_id[11]) == 1
    assert classifier.score_quality(empty, labels).count() == 0
    assert {r.score for r in classifier.score_quality(odd, labels.where("false")).collect()} == {0.5}
