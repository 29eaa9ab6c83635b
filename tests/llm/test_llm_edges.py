"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns:
every operator and every pipeline stage gives a defined result."""

import random

import public_tokenizers
import pytest

import corpus_pipeline
from tessera.llm import (byte_bpe, decontaminate, license_scan, line_dedup, lm_score, quality_mil, secret_scan,
                         simhash_near, syncmers, token_files)

MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, pos int, key string, fp long, "
          "ids string, score double, dropped string, `range` int, h long, th long, `a b` string")


def _text(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 9))) for _ in range(n))


ROWS = [(1, _text(1, 80) + "\n" + _text(2, 60)), (2, None), (3, ""), (1, _text(1, 80) + "\n" + _text(2, 60)),
        (None, _text(3, 70)), (None, None), (4, _text(4, 30_000)), (5, _text(1, 80) + "\n" + _text(2, 60)),
        (6, " \n\t\n "), (7, _text(1, 80).replace("a", "A")), (1, _text(9, 40)), (8, "Ǘ 漢字 \U0001F600 '\n|"),
        (-3, _text(5, 50))]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, None, "s", None, 1, "k", 2, "x", 0.5, "d", 3, 4, 5, "c") for i, t in ROWS],
                                 SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (3, 0, 0), (4, 1, None), (None, 1, 0), (9, None, 1), (-3, 0, 0)],
                                 "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, _text(2, 60), "x"), (None, None, "y"), (2, "", "z"), (2, _text(2, 60), "x"),
                                  (3, "zz yy", "x")], "item_id long, text string, th string")


ONE_PER_ROW = {
    "lines": lambda s, d, la, b: line_dedup.dedup_lines(d),
    "bpe": lambda s, d, la, b: byte_bpe.round_trip(d, MULTI),
    "licences": lambda s, d, la, b: license_scan.scan(d),
    "simhash": lambda s, d, la, b: simhash_near.near_duplicates(d),
    "syncmers": lambda s, d, la, b: syncmers.against_next(d),
    "quality": lambda s, d, la, b: quality_mil.classify(d, la),
    "lm": lambda s, d, la, b: lm_score.score(d, max_bytes=1 << 20),
    "files": lambda s, d, la, b: token_files.round_trip(d, WORDS),
}


@pytest.mark.parametrize("name", sorted(ONE_PER_ROW))
def test_each_row_comes_back_once(spark, docs, empty, labels, bench, name):
    rows = ONE_PER_ROW[name](spark, docs, labels, bench).collect()
    ids = [r["doc_id"] for r in rows]
    assert sorted(ids, key=str) == sorted([i for i, _ in ROWS], key=str)
    assert ONE_PER_ROW[name](spark, empty, labels.limit(0), bench.limit(0)).collect() == []


def test_line_dedup_defined_results(docs):
    rows = line_dedup.dedup_lines(docs, dropped="gone").collect()
    assert rows[0].asDict().keys() == {*docs.columns, "gone"}
    got = [(r["doc_id"], r["text"]) for r in rows]
    assert (2, None) in got and (None, None) in got and (6, " \n\t\n ") in got
    assert got.count((1, ROWS[0][1])) == 2  # rows of equal id and text are one document
    assert (5, "") in got and (7, "") in got  # all lines repeat those of document 1


def test_quality_needs_both_classes(docs, labels):
    one = quality_mil.classify(docs, labels.where("quality = 1")).select("score", "predicted").distinct().collect()
    assert [(r[0], r[1]) for r in one] == [(1.0, 1)]
    none = quality_mil.classify(docs, labels.limit(0)).select("score").distinct().collect()
    assert [r[0] for r in none] == [0.5]


def test_decontamination_of_edges(docs, empty, bench):
    got = decontaminate.find_contained(docs, bench).select("doc_id", "item_id", "containment").collect()
    assert sorted((r[0], r[1], r[2]) for r in got) == [(1, 1, 1.0), (1, 2, 1.0), (5, 1, 1.0), (5, 2, 1.0)]
    kept = decontaminate.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted((str(r["doc_id"]), r["text"] or "") for r in kept.collect()) == sorted(
        (str(i), t or "") for i, t in ROWS if t != ROWS[0][1])
    assert decontaminate.find_contained(empty, bench).count() == 0
    assert decontaminate.find_contained(docs, bench.limit(0)).count() == 0


def test_secret_scan_of_edges(spark, docs, empty):
    assert secret_scan.scan(empty).count() == 0
    assert secret_scan.scan(docs).count() == 0
    key = "AKIA" + "7QRXK2PLM4TVZ9WN"
    more = spark.createDataFrame([(9, f"look {key} here {key}"), (9, f"look {key} here {key}"), (None, key), (10, None)],
                                 "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["secret"], r["first_pos"], r["n_found"]) for r in secret_scan.scan(more).collect())
    assert got == [("9", key, 6, 2), ("9", key, 6, 2), ("None", key, 1, 1)]


def test_near_copies_keep_one(docs, empty):
    kept = simhash_near.keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted((str(r["doc_id"]), r["text"] or "") for r in kept.collect())
    near = {(r["doc_id"], r["component_id"]) for r in simhash_near.near_duplicates(docs).collect()}
    assert (5, 1) in near and (3, 2) in near and (6, 2) in near
    assert [g for g in got if g[0] in ("5", "3", "6")] == [] and got.count(("1", ROWS[0][1])) == 1
    assert ("1", _text(9, 40)) in got and ("None", _text(3, 70)) in got
    assert simhash_near.keep_one(empty).count() == 0


@pytest.mark.parametrize("k", range(len(corpus_pipeline.STAGES)))
def test_stages_on_edges(spark, docs, empty, labels, bench, tmp_path, k):
    sf = str(tmp_path)
    labels.write.parquet(f"{sf}/labels.parquet")
    bench.write.parquet(f"{sf}/benchmark.parquet")
    stage, last = corpus_pipeline.STAGES[k][1], k + 1 == len(corpus_pipeline.STAGES)
    for d in (docs, empty):
        out = stage(spark, d, sf)
        assert last or out.columns == d.columns
        assert out.count() <= d.count()
