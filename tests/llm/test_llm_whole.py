"""Places where an operator once did less than its whole job."""

import random

import numpy as np

from tessera.llm import license_scan, secret_scan, syncmers


def _words(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 9))) for _ in range(n))


def test_long_texts_keep_all_anchors_with_places(spark):
    long = _words(1, 20_000)
    passage = long[90_000:90_400]
    texts = [long, long[:60_000] + "Q" * 40 + long[60_040:], "another beginning " + passage]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    rows = {r["doc_id"]: r for r in syncmers.against_next(df).collect()}
    for i, t in enumerate(texts):
        at, h = syncmers.unpack(rows[i]["anchors"])
        want_at, want = syncmers.closed_syncmers(t)
        assert at.tolist() == want_at.tolist() and h.tolist() == want.tolist()
    sets = [set(syncmers.closed_syncmers(t)[1].tolist()) for t in texts]
    for i in range(3):  # exact, however long: the change far inside is seen
        a, b = sets[i], sets[(i + 1) % 3]
        assert rows[i]["near_next"] == 2 * len(a & b) / (len(a) + len(b))
    assert rows[0]["near_next"] < 1
    both = syncmers.common_places(*(syncmers.unpack(rows[i]["anchors"]) for i in (0, 2)))
    inside = both[both[:, 1] >= 18]
    assert len(inside) > 40 and (np.diff(inside, axis=1) == 18 - 90_000).mean() > 0.9
    assert syncmers.fingerprints(df).where("length(anchors) > 12 * 512").count() == 2


def test_licences_over_line_ends_and_spdx_tags(spark):
    apache = "Licensed under the Apache\nLicense, Version 2.0 (the thing);\nyou may not use this file except in\nCompliance with the License."
    texts = [
        ("SPDX-License-Identifier: MIT", ["MIT"]), ("// SPDX-License-Identifier:Apache-2.0\nint main;", ["Apache-2.0"]),
        ("# SPDX-License-Identifier: (GPL-2.0-or-later WITH Classpath-exception-2.0 OR MIT)\nX = 1", ["GPL-2.0+", "MIT"]),
        ("/* SPDX-License-Identifier: LGPL-2.1-only */", ["LGPL-2.1"]),
        ("SPDX-License-Identifier: BSD-3-Clause\nThis is released under the MIT License.", ["MIT", "BSD-3-Clause"]),
        ("SPDX-License-Identifier: CC-BY-SA-4.0.\nMore.", ["CC-BY-SA"]),
        (apache, ["Apache-2.0"]), ("It is released under the\nMIT License. It is good.", ["MIT"]),
        ("under the GNU General Public License version 3 of the\nLicense, or any later\nVersion.", ["GPL-3.0+"]),
        ("Released under the MIT License\nRedistributions of source code must retain the above\nCopyright notice", ["MIT"]),
        ("Released under the\n\nMIT License", []), ("Plain text\nWithout any\nPermission", [])]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r["licenses"] for r in license_scan.scan(df).collect()}
    assert [got[i] for i in range(len(texts))] == [want for _, want in texts]
    assert [n for _, n in license_scan.known_sentences(apache)] == ["APACHEref", "APACHEcompliance"]
    assert [n for _, n in license_scan.known_sentences(texts[9][0])] == ["MITref", "BSDsource"]


def test_assigned_values_of_any_name_are_candidates(spark):
    jwt = "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0In0.dBjftJeZ4CVP"
    texts = [("SPRING_DATASOURCE_PRODUCTION_PASSWORD=s3cr#t!99", "s3cr#t!99"), ("run --password=hunter2!x9 now", "hunter2!x9"),
             ("//registry/:_authToken=ab!12cd#9", "ab!12cd#9"), ("env: DB_PASSWORD=ab3!kd9x", "ab3!kd9x"),
             ("x: y: PASSWORD=ab=3!kd9x", "ab=3!kd9x"), ("p=ab3!kd9x", "ab3!kd9x"), ("Authorization: Bearer " + jwt, jwt)]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string")
    got = {(r["doc_id"], r["candidate"]): r for r in secret_scan.candidates(df).collect()}
    for i, (t, want) in enumerate(texts):
        assert got[i, want]["first_pos"] == t.index(want) + 1 and got[i, want]["n_found"] == 1


def test_strongest_context_of_all_occurrences(spark):
    value, odd = "Zk3!q9TxB7wLm2Rv", "a\\E$1.b[2"
    text = f"seen {value} and, much further on after many other words of no interest, password={value} end {value}"
    rows = secret_scan.candidates(spark.createDataFrame(
        [(1, text), (2, f"key={odd} x key={odd}")], "doc_id long, text string")).collect()
    r = next(r for r in rows if r["candidate"] == value)
    assert (r["first_pos"], r["n_found"], r["before"][-9:], r["after"]) == (6, 3, "password=", f" end {value}")
    r = next(r for r in rows if r["candidate"] == odd)
    assert (r["first_pos"], r["n_found"], r["before"], r["after"]) == (5, 2, "key=", f" x key={odd}")
