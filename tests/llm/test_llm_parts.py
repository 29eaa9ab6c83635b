"""The operators' parts against plain versions of the same definitions."""

import heapq
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import byte_bpe, license_scan, line_dedup, lm_score, simhash_near, syncmers, token_files
from tessera.llm.common import connected_components, union_labels


def _levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.text("abc ", max_size=25), st.text("abc ", max_size=25), st.integers(0, 12))
def test_within_edits(a, b, limit):
    assert line_dedup.within_edits(a, b, limit) == (_levenshtein(a, b) <= limit)


def test_line_simhash():
    import xxhash
    lines = [["a"], ["a", "b", "a"], [f"w{i % 700}" for i in range(1500)]]
    for words, got in zip(lines, line_dedup.simhashes(lines).tolist(), strict=True):
        h = [xxhash.xxh64_intdigest(w) for w in words]
        assert got == sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _near_values(n, seed=3):
    r = random.Random(seed)
    base = [r.getrandbits(64) for _ in range(n // 10)]
    return sorted({b ^ sum(1 << r.randrange(64) for _ in range(r.randrange(4))) & (2 ** 64 - 1)
                   for b in base for _ in range(10)})


def _components(values, bits):
    parent = np.arange(len(values))
    v = np.array(values, np.uint64)
    for i in range(len(v)):
        near = np.flatnonzero(np.bitwise_count(v ^ v[i]) <= bits)
        union_labels(parent, np.full(len(near), i), near)
    return parent


def _from_edges(values, src, dst):
    at = {v: i for i, v in enumerate(values)}
    parent = np.arange(len(values))
    union_labels(parent, np.array([at[x] for x in src], np.int64), np.array([at[x] for x in dst], np.int64))
    return parent


def test_gray_index_links_what_all_pairs_link(spark):
    values = _near_values(3000)
    want = _components(values, 2)
    v = np.array(values, np.uint64)
    src, dst = simhash_near.link_within(v, v[:0], 2)
    assert (_from_edges(values, src.tolist(), dst.tolist()) == want).all()
    df = spark.createDataFrame([(int(x), int(y)) for x, y in zip(
        v.view(np.int64), (simhash_near.gray_rank(v) ^ simhash_near.TOP).view(np.int64), strict=True)], "fp long, rank long")
    rows = simhash_near.similar_links(df, 2, blocks=9).collect()
    unsigned = lambda x: x % 2 ** 64
    got = _from_edges(values, [unsigned(r["src"]) for r in rows], [unsigned(r["dst"]) for r in rows])
    assert (got == want).all()


def test_pigeonhole_blocks_link_what_all_pairs_link(spark):
    values = _near_values(1500, seed=5) + list(range(2 ** 40, 2 ** 40 + 1500))  # a crowded block too
    values = sorted(set(values))
    df = spark.createDataFrame([(int(x),) for x in np.array(values, np.uint64).view(np.int64)], "sim long")
    rows = line_dedup.block_links(df, 3).collect()
    got = _from_edges(values, [r["src"] % 2 ** 64 for r in rows], [r["dst"] % 2 ** 64 for r in rows])
    assert (got == _components(values, 3)).all()


def test_line_dedup_equals_all_pairs(spark):
    r = random.Random(2)
    base = [" ".join(r.choice(["alpha", "beta", "gamma", "delta", "omega", "kappa", "sigma"]) + str(r.randrange(60))
                     for _ in range(r.randrange(2, 60))) for _ in range(60)]
    docs = []
    for i in range(40):
        lines = []
        for _ in range(r.randrange(0, 6)):
            x = r.choice(base)
            if r.random() < 0.4:
                k = r.randrange(len(x))
                x = x[:k] + r.choice("xyz") + x[k + 1:]
            lines.append(x.upper() if r.random() < 0.2 else x)
        docs.append((i, "\n".join(lines)))
    places = [(i, k, line_dedup.normalise(x)) for i, t in docs for k, x in enumerate(t.split("\n"))]
    places = [p for p in places if p[2]]
    sim = line_dedup.simhashes([line_dedup.features(p[2]) for p in places])
    parent = np.arange(len(places))
    for a in range(len(places)):
        for b in range(a):
            x, y = places[a][2], places[b][2]
            if int(sim[a] ^ sim[b]).bit_count() <= 5 and _levenshtein(x, y) <= 0.2 * max(len(x), len(y)) + 1e-9:
                union_labels(parent, np.array([a]), np.array([b]))
    import xxhash
    th = {i: np.array([xxhash.xxh64_intdigest(t.encode(), 42)], np.uint64).view(np.int64)[0] for i, t in docs}
    first = {}
    for j, (i, k, _) in enumerate(places):
        g = parent[j]
        first[g] = min(first.get(g, (i, th[i], k)), (i, th[i], k))
    want = {i: sorted(k for j, (d, k, _) in enumerate(places) if d == i and first[parent[j]] != (i, th[i], k))
            for i, _ in docs}
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {x["doc_id"]: x["dropped"] for x in line_dedup.dedup_lines(df, dropped="dropped").collect()}
    assert got == want and any(want.values())


def test_large_candidate_groups_are_checked_in_parts(spark):
    rows = [(1, bytes([i // 256, i % 256]), 7, "the same long line of words number " + "x" * (i % 9)) for i in range(300)]
    df = spark.createDataFrame(rows, "comp long, key binary, sim long, norm string")
    edges = line_dedup.edit_links(df, 3, 0.8, part_lines=40)
    assert edges.select("src").distinct().count() >= 1
    assert connected_components(edges).select("component").distinct().count() == 1


def test_components_of_a_long_chain(spark):
    chain = [(i, i + 1) for i in range(200)] + [(1000, 1001), (5000, 5000), (None, 3)]
    got = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(chain, "src long, dst long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, 1000: 1000, 1001: 1000}


@settings(max_examples=60, deadline=None)
@given(st.text(st.sampled_from(list("abst're v lmd''  \n\t\r.,!?12٣½漢字é \u0085​😀Ⅷ\x1c")), max_size=400))
def test_bpe_equals_tiktoken(text):
    coder, enc = _bpe()
    ids = coder.encode(text)
    assert ids == enc.encode_ordinary(text) and coder.decode(ids) == text.encode()


_CACHE = []


def _bpe():
    if not _CACHE:
        import tiktoken
        ranks = byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
        _CACHE.extend([byte_bpe.TreeBPE(ranks), tiktoken.Encoding(
            "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})])
    return _CACHE


def test_bpe_long_matches_and_cut_texts(monkeypatch):
    coder, enc = _bpe()
    r = random.Random(4)
    long = ["a" * 5000, "ab" * 3000, "".join(r.choice("abcdeé漢") for _ in range(4000))]
    text = " ".join("".join(r.choice("abthe'sé1.") for _ in range(r.randrange(1, 12))) for _ in range(500)) + "  \n x"
    assert [coder.encode(t) for t in long] == [enc.encode_ordinary(t) for t in long]
    monkeypatch.setattr(byte_bpe, "CHUNK", 40)
    assert coder.encode(text) == enc.encode_ordinary(text)
    some = coder.trees([b"internationalisation"])[0]
    assert coder.join([], some) == some == coder.join(some, [])
    whole = b"internationalisations of the unprecedented"
    for k in range(1, len(whole)):
        a, b = coder.trees([whole[:k], whole[k:]])
        assert coder.join(a, b) == coder.trees([whole])[0]  # the monoid's law at every cut


def test_huffman_lengths_are_optimal_and_limited():
    r = random.Random(5)
    counts = np.array([r.randrange(1, 1000) for _ in range(300)])
    heap = [(int(c), k, [k]) for k, c in enumerate(counts)]
    depth = [0] * len(counts)
    heapq.heapify(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        for k in a[2] + b[2]:
            depth[k] += 1
        heapq.heappush(heap, (a[0] + b[0], a[1], a[2] + b[2]))
    best = token_files.code_lengths(counts, 40)
    assert (best * counts).sum() == (np.array(depth) * counts).sum()
    tight = token_files.code_lengths(np.array([1 << k for k in range(30)]), 6)
    assert tight.max() <= 6 and np.sum(2.0 ** -tight) <= 1


def test_huffman_round_trip_by_stretches():
    r = np.random.default_rng(6)
    flat = np.minimum(r.geometric(0.02, 5000) - 1, 400)
    ids, n = np.unique(flat, return_counts=True)
    code = token_files.Code(ids, token_files.code_lengths(n, 16))
    count = np.array([0, 1, 3000, 0, 1999])
    payload, n_bytes, inside = code.encode(flat, count)
    number = np.arange(len(flat)) - np.repeat(np.cumsum(count) - count, count)
    marks = number % 256 == 0
    place = inside[marks] + np.repeat(8 * (np.cumsum(n_bytes) - n_bytes), count)[marks]
    size = np.minimum(256, np.repeat(count, count)[marks] - number[marks])
    assert (code.decode(payload, place, size) == flat).all()
    one = token_files.Code(np.array([9]), np.array([1]))
    payload, _, _ = one.encode(np.array([9, 9, 9]), np.array([3]))
    assert one.decode(payload, np.array([0]), np.array([3])).tolist() == [9, 9, 9]


def test_filter_counts_never_fall_short():
    r = np.random.default_rng(7)
    key = r.integers(0, 2 ** 64, 4000, np.uint64)
    count = np.minimum(r.zipf(1.6, 4000), 10 ** 6)
    segment = (key >> np.uint64(54)).astype(int)
    rows = [{"segment": int(s), "bits": lm_score.build_segment(key[segment == s], count[segment == s], 1 << 20)}
            for s in np.unique(segment)]
    f = lm_score.Filter.of(pa.Table.from_pylist(rows))
    true, read = lm_score.levels_of(count), f.levels(key)
    assert (read >= true).all() and (read > true).mean() < 0.1
    assert (f.levels(r.integers(0, 2 ** 64, 4000, np.uint64)) > 0).mean() < 0.1
    assert (lm_score.ESTIMATE[lm_score.levels_of(np.array([1, 2, 3]))] == [1, 2, 3]).all()


@settings(max_examples=60, deadline=None)
@given(st.text("ab ", min_size=0, max_size=80), st.integers(2, 12), st.integers(1, 12))
def test_closed_syncmers(text, k, s):
    s = min(s, k)
    at, h = syncmers.closed_syncmers(text, k, s)
    if len(text) < k:
        assert len(at) == min(1, len(text))
        return
    code = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
    g = syncmers._grams(code, s).tolist()
    inner = k - s + 1
    assert at.tolist() == [i for i in range(len(text) - k + 1) if min(g[i:i + inner]) in (g[i], g[i + inner - 1])]
    assert len({text[i:i + k] for i in at.tolist()}) == len(set(h.tolist()))


def test_anchors_are_context_free():
    r = random.Random(8)
    shared = "".join(r.choice("abcdefgh ") for _ in range(500))
    a, ha = syncmers.closed_syncmers("start of one text " + shared)
    b, hb = syncmers.closed_syncmers("another beginning, longer than the first: " + shared)
    inside = {(i - 18, int(h)) for i, h in zip(a, ha, strict=True) if i >= 18}
    assert inside == {(i - 42, int(h)) for i, h in zip(b, hb, strict=True) if i >= 42}
    x = syncmers.fingerprint(shared)
    assert syncmers.likeness(x, x) == 1 and syncmers.likeness(x, x[:0]) == 0 and syncmers.likeness(x[:0], x[:0]) == 1


def test_licence_rules():
    mit = ("Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software, to deal in it.\n\n"
           "The above copyright notice and this permission notice shall be included in all copies.\n\n"
           "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND.")
    names = [n for _, n in license_scan.known_sentences(mit)]
    assert names == ["MITgrant", "MITnotice", "ASIS"] and license_scan.apply_rules(names) == (["MIT"], [])
    bsd = ["BSDgrant", "BSDsource", "BSDbinary"]
    assert license_scan.apply_rules([*bsd, "BSDendorse", "ASIS"]) == (["BSD-3-Clause"], ["ASIS"])
    assert license_scan.apply_rules([*bsd, "ASIS"])[0] == ["BSD-2-Clause"]
    assert license_scan.apply_rules(["BSDbinary", "BSDgrant", "BSDsource"])[0] == []  # order counts
    assert license_scan.apply_rules(["MITref", "MITref"]) == (["MIT"], [])
    assert [n for _, n in license_scan.known_sentences("A. Licensed under the Apache License, Version 2.0. B.")] == ["APACHEref"]
    assert license_scan.known_sentences("The driving licence of my aunt expired. No permission was given.") == []


def test_word_encoder_equals_the_library_on_whole_texts():
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    path, r = public_tokenizers.path("word_bpe_49k.json"), random.Random(1)
    library, coder = Tokenizer.from_file(path), token_files.WordEncoder(path, memory=2000)
    signs = "abcTHE's .,!\n\t\r\x0b\x0c\x00\u0301é漢İß1²\xa0-\u2028 \x1c'\u0958क\u0307"
    for _ in range(20):
        texts = ["".join(r.choice(signs) for _ in range(r.randint(0, 60))) for _ in range(100)]
        ids, n = coder.encode([t.encode() for t in texts], 1)
        got = [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])]
        assert got == [[*e.ids, 1] for e in library.encode_batch(texts, add_special_tokens=False)]


def test_ascii_lines_are_normalised_as_by_the_expression():
    r = np.random.default_rng(5)
    lines = ["".join(map(chr, r.integers(0, 128, 40))) for _ in range(500)] + ["", "_", " A_b ", "Straße É", "x\x1cy"]
    for line in lines:
        assert line_dedup.normalise(line) == line_dedup._OTHER.sub(" ", line.lower()).strip()
        assert all(line_dedup._ASCII[ord(c)] == " " for c in line if c.isascii() and not c.isalnum())


def test_lines_of_many_texts_are_normalised_and_hashed_as_one_by_one():
    r = random.Random(4)
    signs = list("aB Σσς_\n\n\r\t\x0b\x1c\x85 İıßǅⅧ²٣é漢😀​नि-' ")
    for k in range(300):
        texts = ["".join(r.choice(signs[:r.choice([6, len(signs)])]) for _ in range(r.randrange(40))).encode()
                 for _ in range(r.randrange(5))]
        texts = [t[:len(t) // 2] if r.random() < 0.2 else t for t in texts]  # cut inside a character too
        if k == 0:
            texts = [b"", " ".join(f"w{i % 700}" for i in range(1500)).encode() + b"\n\nE e"]
        want = [(i, j, norm) for i, t in enumerate(texts) for j, x in enumerate(t.decode("utf-8", "replace").split("\n"))
                if (norm := line_dedup._OTHER.sub(" ", x.lower()).strip())]
        row, pos, norms, sims = line_dedup.normal_lines(texts)
        assert list(zip(row.tolist(), pos.tolist(), [x.decode() for x in norms], strict=True)) == want
        for (_, _, norm), got in zip(want, sims.tolist(), strict=True):
            h = [line_dedup.xxhash.xxh64_intdigest(w) for w in set(norm.split(" "))]
            assert got == sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@settings(max_examples=200, deadline=None)
@given(*[st.lists(st.sampled_from(["a", "of", "the", "x", "word"]), min_size=1, max_size=12).map(" ".join)] * 2)
def test_upper_bound_of_the_distance(a, b):
    assert line_dedup.at_most(a, b) >= _levenshtein(a, b)


def test_upper_bound_decides_lines_of_repeated_words():
    a = "of the " * 40 + "end " + "and so on " * 20
    b = "of the " * 20 + "new " + "of the " * 20 + "end " + "and so on " * 9 + "but " + "and so on " * 11
    assert line_dedup.at_most(a.strip(), b.strip()) == _levenshtein(a.strip(), b.strip()) == 8


def test_candidate_groups_may_span_arrow_batches(spark):
    rows = [(c, bytes([c, i]), 7, f"group {c} has a long line of words, {'y' * (i % 3)}" if i % 4 else chr(97 + i) * 40)
            for c in range(9) for i in range(1 + c * 2)]
    df = spark.createDataFrame(rows, "comp long, key binary, sim long, norm string")
    want = {(bytes(r["src"]), bytes(r["dst"])) for r in line_dedup.edit_links(df, 3, 0.8).collect()}
    conf = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "4")
    try:
        got = {(bytes(r["src"]), bytes(r["dst"])) for r in line_dedup.edit_links(df, 3, 0.8).collect()}
    finally:
        spark.conf.set(conf, before)
    found = connected_components(spark.createDataFrame(sorted(got), "src binary, dst binary")).groupBy("component").count()
    sizes = sorted(r["count"] for r in found.collect())
    assert len(got) == len(want) and sizes == sorted(
        n for c in range(9) if (n := sum(i % 4 > 0 for i in range(1 + c * 2))) > 1)
