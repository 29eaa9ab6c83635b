"""Contract queries against brute-force versions on the smallest tables."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash

from tessera.llm import queries, quality_mil

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return sorted((r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect())


def _rows(spark, name):
    return {r["doc_id"]: r for r in queries.QUERIES[name](spark, SF).collect()}


def test_op2_equals_tiktoken(spark, texts):
    import tiktoken
    from tessera.llm.byte_bpe import load_ranks
    ranks = load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = _rows(spark, "op2_byte_bpe")
    for i, t in texts:
        ids = np.array(enc.encode_ordinary(t), "<u4")
        assert tuple(got[i]) == (i, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(),
                                 hashlib.sha256(t.encode()).hexdigest())


def _fingerprint(text):
    words = text.encode().lower().split()
    shingles = [b" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_op4_equals_all_pairs(spark, texts):
    fp = {i: _fingerprint(t) for i, t in texts}
    root = {i: i for i in fp}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(fp)
    for a in ids:
        for b in ids:
            if a < b and (fp[a] ^ fp[b]).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    got = _rows(spark, "op4_simhash_near_dedup")
    assert {i: (r["fingerprint"], r["component_id"]) for i, r in got.items()} == {
        i: (f"{fp[i]:016x}", find(i)) for i in ids}


def test_op6_edited_texts(spark, texts):
    got = _rows(spark, "op6_document_fingerprints")
    near = []
    for k, (i, t) in enumerate(texts):
        following = texts[(k + 1) % len(texts)][1]
        n = len(t) // 4
        edited = t[:len(t) - n] + following[:n]
        assert (got[i]["n_chars"], got[i]["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        if t == following:
            assert got[i]["near_next"] == 1
        else:
            near.append((got[i]["near_edited"], got[i]["near_next"]))
    a, b = map(np.array, zip(*near, strict=True))
    assert np.median(a) > 0.65 and np.median(b) < 0.1 and (a > b).mean() > 0.95


def test_op8_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.QUERIES["op8_quality_classifier"](spark, sf)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = got.collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    judged = [(labels[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert sum(a == b for a, b in judged) / len(judged) > 0.95


def test_quality_gradients():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(23, quality_mil.WIDTH)).astype(np.float32)
    count, y = np.array([3, 1, 9, 10]), np.array([1, 0, 1, 0], np.float32)
    w = quality_mil.train(x, count, y, np.ones(4, np.float32), epochs=60, batch=4)
    score = quality_mil.Model(0.5, w).scores(x, count)
    assert (score[[0, 2]] > 0.9).all() and (score[[1, 3]] < 0.1).all()
    att = quality_mil._forward(w, x, count)["att"]
    assert np.allclose(np.add.reduceat(att, [0, 3, 4, 13]), 1, atol=1e-5)


def test_op9_base_scores_and_gain(spark, texts):
    tokens = {i: [*t.encode().lower().split(), None] for i, t in texts}
    held = {i for i, _ in texts if zlib.crc32(str(i).encode()) % 7 == 2}
    c = Counter(w for i, ws in tokens.items() if i not in held for w in ws)
    n, v = sum(c.values()), len(c)
    got = _rows(spark, "op9_lm_scoring")
    for i, ws in tokens.items():
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (
            i in held, len(ws), sum(c[w] > 0 for w in ws), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), rel=1e-9)
    assert sum(got[i]["score"] for i in held) > sum(got[i]["base_score"] for i in held)


def test_op10_equals_tokenizers(spark, texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got, start = _rows(spark, "op10_token_files"), 0
    for (i, _), e in zip(texts, t.encode_batch([x for _, x in texts], add_special_tokens=False), strict=True):
        ids = np.array([*e.ids, 1], "<u4")
        assert tuple(got[i]) == (i, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
