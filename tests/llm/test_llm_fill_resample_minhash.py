"""Fill-in-the-middle, importance resampling and MinHash near-dedup against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.llm import fill_middle, minhash_near, queries, target_resample

SF = "/root/testdata/sf0.001"
CLASHING = ("doc_id long, text string, n long, form string, cut string, h1 long, output string, row long, score long, "
            "rank long, part long, place long, start long, bucket long, n_words long, node long, pivot long, k1 long, "
            "sig binary, many long, component long, kept boolean, deal long, least long")


@pytest.fixture(scope="module")
def texts(spark):
    return sorted((r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect())


def _frame(spark, rows):
    """Rows (doc_id, text) among columns that have the operators' own names."""
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for column in CLASHING.split(", ")[2:]:
        name, kind = column.split()
        df = df.withColumn(name, F.lit(None).cast(kind))
    return df


def _words(seed, n, letters="abcdefghij"):
    r = random.Random(seed)
    return " ".join("".join(r.choice(letters) for _ in range(r.randint(2, 9))) for _ in range(n))


EDGES = [(1, None), (2, ""), (3, " \n\t "), (4, "x"), (4, "x"), (None, "x y"), (None, None), (5, " lead and trail \n"),
         (6, "漢字 Ǘ \U0001F600\U0001F600 é"), (7, "a <P> b"), (8, "<M>"), (-9, "<S <P < S> <"), (10, _words(1, 60_000)),
         (11, "no\xa0break\x0bvertical\x0cfeed\x1cfs"), (12, "AbC 12"), (12, _words(2, 50))]


# ---- fill in the middle -----------------------------------------------------------

@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 300_000), max_size=300), st.lists(st.integers(0, 250_000), max_size=4), st.integers(1, 9000),
       st.integers(1, 5))
def test_boundary_set_selects_what_a_list_holds(singles, runs, length, step):
    want = sorted({*singles, *(x for r in runs for x in range(r, r + length, step))})
    found = fill_middle.BoundarySet(np.array(want, np.int64))
    assert len(found) == len(want) and found.values().tolist() == want
    for rank in {0, len(want) // 3, len(want) // 2, len(want) - 1} if want else ():
        assert found.select(rank) == want[rank]


def test_containers_take_their_smallest_form():
    kind = lambda values: type(fill_middle.container(np.array(values))).__name__
    assert kind(range(0, 8000, 2)) == "ArrayContainer"
    assert kind(range(0, 60_000, 2)) == "BitmapContainer"
    assert kind(range(100, 50_000)) == "RunContainer"
    far = fill_middle.BoundarySet(np.array([3, 70_000, 70_001, 2 ** 33]))
    assert [far.select(k) for k in range(4)] == [3, 70_000, 70_001, 2 ** 33]


UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab é漢\U0001F600 \n\t\x0b\x1c\xa0", max_size=20), max_size=6))
def test_boundaries(some):
    got = [x.tolist() for x in fill_middle.boundaries([t.encode() for t in some])]
    assert got == [[m.end() for m in UNIT.finditer(t)] for t in some]


def _fim(i, text):
    units = UNIT.findall(text)
    digits = hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()
    h = [int(digits[8 * k:8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, None)))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 80:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_op11_equals_plain_version(spark, texts):
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    got = {r["doc_id"]: tuple(r) for r in queries.QUERIES["op11_fill_in_middle"](spark, SF).collect()}
    for i, t in texts:
        *head, output = _fim(i, t)
        assert got[i] == (i, *head, sha(output), sha(t))
    assert {r[2] for r in got.values()} == {"plain", "psm", "spm"}


def test_fill_in_middle_of_edges(spark):
    made = fill_middle.fill_in_middle(_frame(spark, EDGES)).withColumn(
        "again", fill_middle.restore(F.col("output"), F.col("form")))
    got = sorted((tuple(r) for r in made.collect()), key=str)
    assert got == sorted(((i, *_fim(i, t or ""), t or "") for i, t in EDGES), key=str)
    assert fill_middle.fill_in_middle(_frame(spark, EDGES[:1]).limit(0)).count() == 0


@pytest.mark.parametrize("rate, spm", [(100, 100), (100, 0), (0, 50)])
def test_forms_and_other_sentinels(spark, rate, spm):
    marks = ("|a|", "(b)", "[c]")
    rows = [(i, _words(i, 30) + "<P>") for i in range(20)] + [(99, "x |a| y")]
    made = fill_middle.fill_in_middle(_frame(spark, rows), rate=rate, spm_rate=spm, sentinels=marks).withColumn(
        "again", fill_middle.restore(F.col("output"), F.col("form"), marks)).collect()
    assert {r["doc_id"]: r["again"] for r in made} == dict(rows)
    assert {r["form"] for r in made if r["doc_id"] != 99} == {"plain" if not rate else "spm" if spm else "psm"}
    assert [r["output"] for r in made if r["doc_id"] == 99] == ["x |a| y"]


# ---- importance resampling -----------------------------------------------------------

def _resample(docs, target, longest, buckets, percent, least):
    def features(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        runs = [" ".join(words[k:k + n]) for n in range(1, longest + 1) for k in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(r.encode()) % buckets for r in runs]

    of = [(i, *features(t)) for i, t in docs]
    s, t = Counter(b for *_, f in of for b in f), Counter(b for x in target for b in features(x)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets))))
            for b in range(buckets)]
    rows = []
    for i, n, f in of:
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32))), None, n])
    order = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(order[:percent * len(order) // 100]):
        r[4] = k + 1
    return [tuple(r[:5]) for r in rows]


def test_op12_equals_plain_version(spark, texts):
    target = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = sorted(map(tuple, queries.QUERIES["op12_target_resampling"](spark, SF).collect()))
    assert got == sorted(_resample(texts, target, 1, 10_000, 10, 20))
    assert sum(r[4] is not None for r in got) > 10


@pytest.mark.parametrize("longest, percent, least", [(1, 50, 1), (2, 100, 0), (3, 10, 3), (1, 0, 1)])
def test_resampling_of_edges(spark, longest, percent, least):
    docs = EDGES + [(k % 7, "same words here") for k in range(40)] + [(i, _words(i, i)) for i in range(60)]
    target = [None, "", "here same", _words(7, 80)]
    of_target = spark.createDataFrame([(t, 1) for t in target], "text string, n_words long")
    got = target_resample.resample(_frame(spark, docs), of_target, longest, 97, percent=percent, min_words=least).collect()
    want = _resample(docs, target, longest, 97, percent, least)
    key = lambda r: tuple((x is None, x or 0) for x in r)
    # rows that tie in score and id share their ranks among them
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_resampling_of_empty_tables(spark):
    docs, target = _frame(spark, EDGES), spark.createDataFrame([], "text string")
    assert target_resample.resample(docs.limit(0), target).collect() == []
    rows = target_resample.resample(docs, target, min_words=1, percent=100).collect()
    assert len(rows) == len(EDGES) and {r["rank"] for r in rows} >= {1, 2}


# ---- MinHash near-dedup ----------------------------------------------------------------

def _sets(docs, words):
    out = []
    for _, t in docs:
        parts = (t or "").encode().lower().split()
        out.append({b" ".join(parts[k:k + words]) for k in range(max(1, len(parts) - words + 1))} if parts else set())
    return out


def _components(docs, words, percent):
    sets, root = _sets(docs, words), list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    ids = {}
    for k, (i, _) in enumerate(docs):
        if i is not None and sets[k]:
            ids[find(k)] = min(ids.get(find(k), i), i)
    names = [ids.get(find(k)) if sets[k] else docs[k][0] for k in range(len(docs))]
    return [(i, len(s), c, i == c) for (i, _), s, c in zip(docs, sets, names, strict=True)]


def _family(seed, n, size, spread):
    """Texts around one another whose pairwise similarity lies on both sides of 0.8."""
    r = random.Random(seed)
    base = _words(seed, size).split()
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(r.randrange(spread)):
            own[r.randrange(len(own))] = "".join(r.choice("klmnop") for _ in range(6))
        out.append(" ".join(own))
    return out


def test_op13_equals_all_pairs(spark, texts):
    got = sorted(map(tuple, queries.QUERIES["op13_minhash_near_dedup"](spark, SF).collect()))
    assert got == sorted(_components(texts, 2, 80)) and any(not r[3] for r in got)


@pytest.mark.parametrize("rounds, block_bytes", [(4, 1 << 20), (2, 1500), (0, 1500)])
def test_links_near_the_threshold(spark, rounds, block_bytes):
    many = [t for seed in range(6) for t in _family(seed, 40, 30 + 15 * seed, 12 + 2 * seed)]
    many += [_words(3, 60) + " " + t for t in _family(77, 15, 25, 9)]  # a shared passage
    docs = list(enumerate(random.Random(1).sample(many, len(many)), start=100))
    got = minhash_near.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), rounds=rounds,
                                       block_bytes=block_bytes)
    want = sorted(_components(docs, 2, 80))
    assert sorted(map(tuple, got.collect())) == want
    assert 20 < len({c for *_, c, _ in want}) < len(docs) - 60


def test_hot_pivots_and_copies_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(minhash_near, "HOT_ROWS", 7)
    docs = list(enumerate(_family(5, 120, 80, 6) + ["the same text of nine words here again x"] * 60 + [""] * 9))
    got = minhash_near.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == sorted(_components(docs, 2, 80))


def test_near_duplicates_of_edges(spark):
    docs = EDGES + [(20, _words(1, 60_000) + " end"), (None, "x y"), (21, "X  Y"), (22, "x y\nz"), (None, "only null ids"),
                    (None, "only null ids"), (12, _words(2, 50) + " more"), (3, "a b")]
    got = minhash_near.near_duplicates(_frame(spark, docs)).collect()
    want = [(i, n, c, i == c) for i, n, c, _ in _components(docs, 2, 80)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert minhash_near.near_duplicates(_frame(spark, docs[:1]).limit(0)).collect() == []


def test_star_components(spark):
    r = random.Random(4)
    edges = [(r.randrange(400), r.randrange(400)) for _ in range(330)] + [(1000 + k, 1001 + k) for k in range(50)]
    edges += [(5000, 5001 + k) for k in range(300)] + [(7, 7)]
    got = {x["node"]: x["component"] for x in minhash_near.star_components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {x: x for e in edges for x in e}
    for _ in range(60):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert got == {x: c for x, c in root.items() if x != 7 or any(7 in e and e != (7, 7) for e in edges)}


def test_minima_agree_as_often_as_sets_do():
    minima, rng = minhash_near.Minima(400), np.random.default_rng(1)
    h = np.unique(rng.integers(0, 2 ** 63, 3000).astype(np.uint64))
    a, b = h[:2400], h[600:]
    share = (minima.of(a) == minima.of(b)).mean()
    assert abs(share - 1800 / len(h)) < 0.08 and (minima.of(h[::-1]) == minima.of(h)).all()
    low, near = minhash_near.signature_bounds(80, 200)
    assert 0.6 < low < 0.65 and 0.38 < near < 0.4


# ---- helper names of operators and stages -------------------------------------------------

def test_stages_keep_columns_of_their_helpers_names(spark, tmp_path):
    import corpus_pipeline
    from tessera.llm import line_dedup
    helpers = ["__doc", "__th", "__dropped", "__DOC", "__score", "__predicted", "__id", "dropped", "th", "fp", "rank", "n_shared"]
    line, other = _words(1, 30), _words(2, 30)
    rows = [(1, f"{line}\n{other}"), (2, f"{line}\n{_words(3, 40)}"), (3, None), (None, _words(4, 60))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for k, name in enumerate(n for n in helpers if n != "__DOC"):
        docs = docs.withColumn(name, F.lit(k))
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, 0)], "doc_id long, quality int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, _words(4, 60))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        assert all(tuple(r)[2:] == tuple(range(len(docs.columns) - 2)) for r in out.collect())
    cut = line_dedup.dedup_lines(docs, dropped="dropped").collect()
    assert {r["doc_id"]: r["dropped"] for r in cut} == {1: [], 2: [0], 3: [], None: []}


def test_fingerprints_hold_what_the_likeness_uses(spark):
    from tessera.llm import syncmers
    texts = [_words(k, 900 * k) for k in (1, 2)] + [_words(9, 40) + " " + _words(2, 1800)[4000:7000] + " " + _words(8, 60), "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in syncmers.against_next(df).collect()}
    of = lambda hex_digits: {hex_digits[k:k + 8] for k in range(0, len(hex_digits), 8)}
    for i in range(5):
        a, b, c = of(rows[i]["fingerprint"]), of(rows[(i + 1) % 5]["fingerprint"]), of(rows[i]["edited_fingerprint"])
        like = lambda x, y: 2 * len(x & y) / (len(x) + len(y)) if x and y else float(len(x) == len(y))
        assert (rows[i]["near_next"], rows[i]["near_edited"]) == (like(a, b), like(a, c))
        assert len(a) == len(set(syncmers.closed_syncmers(texts[i] or "")[1].tolist()))  # none left out
    assert 2900 < rows[1]["copied_next"] <= 3000 and rows[0]["copied_next"] < 40 and rows[3]["copied_next"] == 0
    n = len(texts[1])
    assert n - n // 4 - 60 < rows[1]["copied_edited"] <= n - n // 4 + 20
    kept = list(syncmers.EDITED.split(", "))
    assert [c.split()[0] for c in kept[:7]] == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                                                "near_edited", "near_next"]
