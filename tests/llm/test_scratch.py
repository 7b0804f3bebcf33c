"""Intermediate tables go with their scope; the whole pipeline run leaves only what its result reads."""

import os

import pytest

from labormart.llm import common


def entries(spark) -> set[str]:
    root = common.scratch_root(spark).removeprefix("file:")
    return set(os.listdir(root)) if os.path.isdir(root) else set()


def test_tables_go_with_their_scope(llm, tmp_path):
    before = entries(llm)
    df = llm.range(10)
    with common.scratch_scope(llm) as path:
        inner = common.settle(df, "inner")
        kept = common.write_table(inner.where("id > 4"), str(tmp_path / "kept"))
        assert inner.count() == 10 and os.path.isdir(path.removeprefix("file:"))
    assert entries(llm) == before and kept.count() == 5
    with pytest.raises(ValueError), common.scratch_scope(llm):
        common.settle(df, "inner")
        raise ValueError
    assert entries(llm) == before
    assert common.settle(df, "outer").count() == 10 and len(entries(llm) - before) == 1


def test_run_equals_its_stages_and_clears_up(llm, tmp_path):
    import corpus_pipeline

    words = lambda k, n: " ".join(f"{k}{i}" for i in range(n))
    texts = [words("a", 80), words("a", 80), words("b", 120) + " mail x.y@example.com", words("c", 20), None, words("d", 3000), words("e", 60)]
    docs = llm.createDataFrame([(i, t, "en", "s" if i % 2 else None, len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    before = entries(llm)
    found = sorted(tuple(r) for r in corpus_pipeline.run(llm, str(tmp_path)).select("doc_id", "piece", "start", "length", "ids_crc32").collect())
    left = {x.split("-")[1] for x in entries(llm) - before}
    # the last filtering stage's result, and the tables of the packing that the caller computes
    assert left == {"stage", "pieces", "packed"} and sum(x.startswith("llm-stage") for x in entries(llm) - before) == 1
    made = docs
    for _, stage in corpus_pipeline.STAGES:
        made = common.settle(stage(llm, made, str(tmp_path)), "plain")
    assert found == sorted(tuple(r) for r in made.select("doc_id", "piece", "start", "length", "ids_crc32").collect()) and found
    assert {r[0] for r in found} <= {0, 2, 5, 6}
