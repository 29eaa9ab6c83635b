"""The pipeline on the smallest tables: each stage against its operator's brute-force rule."""

import hashlib

import public_tokenizers
import pytest

import corpus_pipeline
from tessera.llm import decontaminate, line_dedup, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Rows after each stage, written and reread as the driver does."""
    base, docs, out = tmp_path_factory.mktemp("pipe"), spark.read.parquet(f"{SF}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{base}/{k}")
        out.append((docs, docs := spark.read.parquet(f"{base}/{k}")))
    return out


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "line dedup", "simhash near-dedup", "benchmark decontamination", "byte bpe"]


def test_all_but_the_last_keep_the_columns(steps):
    assert all(a.columns == b.columns for a, b in steps[:-1])


def test_quality_stage_keeps_what_the_query_predicts(spark, steps):
    good = {r["doc_id"] for r in queries.QUERIES["op8_quality_classifier"](spark, SF).where("predicted = 1").collect()}
    assert {r["doc_id"] for r in steps[0][1].collect()} == good


def test_line_stage_leaves_no_repeated_line(steps):
    lines = [line_dedup.normalise(x) for r in steps[1][1].collect() for x in (r["text"] or "").split("\n")]
    lines = [x for x in lines if x]
    assert len(lines) == len(set(lines))
    before = {line_dedup.normalise(x) for r in steps[1][0].collect() for x in (r["text"] or "").split("\n")} - {""}
    assert len(set(lines)) >= 0.9 * len(before) and steps[1][0].count() == steps[1][1].count()


def test_near_copy_stage_keeps_one_of_each(spark, steps):
    from tessera.llm import simhash_near
    near = simhash_near.near_duplicates(steps[2][0]).collect()
    assert sorted(r["doc_id"] for r in steps[2][1].collect()) == sorted({r["component_id"] for r in near})


def test_benchmark_stage_drops_exactly_the_contained(spark, steps):
    def shingles(text):
        w = "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()
        return {" ".join(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    items = [shingles(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = set()
    for r in steps[3][0].collect():
        s = shingles(r["text"])
        if not any(q and len(q & s) >= 0.8 * len(q) - 1e-9 for q in items):
            want.add(r["doc_id"])
    assert {r["doc_id"] for r in steps[3][1].collect()} == want
    assert decontaminate.find_contained(steps[3][1], spark.read.parquet(f"{SF}/benchmark.parquet")).count() == 0


def test_last_stage_encodes_what_is_left(steps):
    import numpy as np
    import tiktoken
    from tessera.llm.byte_bpe import load_ranks
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={}, mergeable_ranks=load_ranks(
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))
    texts = {r["doc_id"]: r["text"] or "" for r in steps[4][0].collect()}
    got = {r["doc_id"]: r for r in steps[4][1].collect()}
    assert got.keys() == texts.keys()
    for i, t in texts.items():
        ids = np.array(enc.encode_ordinary(t), "<u4")
        assert got[i]["ids_sha256"] == hashlib.sha256(ids.tobytes()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(t.encode()).hexdigest()


def test_run_equals_the_stages(spark, steps):
    a = sorted(tuple(r) for r in corpus_pipeline.run(spark, SF).collect())
    assert a == sorted(tuple(r) for r in steps[-1][1].collect())
