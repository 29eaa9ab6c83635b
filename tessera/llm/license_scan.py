"""Licence recognition by sentence rules.

A text is cut into sentences; each is normalised and mapped to the identifier of a known
licence sentence, if it is one. The sequence of identifiers, unknown sentences left out, is
then matched against licence rules in their order: a rule that matches takes its
identifiers out of the sequence, so that more specific rules come first. A known sentence
may run over the ends of lines; an SPDX tag gives the licences that it names.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces

#: Wording of well-known licences, as patterns over normalised sentences
#: (lower case; letters, digits, dots and plus signs, one blank between words). The first
#: pattern found in a sentence names it.
SENTENCES = [
    ("SPDX", r"spdx license identifier [a-z0-9.+]"),
    ("AGPLver", r"gnu affero general public license.* version 3"),
    ("LGPLver3", r"gnu lesser general public license.* version 3"),
    ("LGPLver21", r"gnu (lesser|library) general public license.* version 2"),
    ("GPLver3plus", r"gnu general public license.* version 3.* any later version"),
    ("GPLver2plus", r"gnu general public license.* version 2.* any later version"),
    ("GPLver3", r"gnu general public license.* version 3"),
    ("GPLver2", r"gnu general public license.* version 2"),
    ("GPLcopy", r"you should have received a copy of the gnu (lesser |affero |library )?general public license"),
    ("GPLuseful", r"this (program|library) is distributed in the hope that it will be useful"),
    ("GPLsee", r"see the gnu (lesser |affero |library )?general public license"),
    ("APACHEref", r"licensed under the apache license version 2(\.0)?( |$|\.)"),
    ("APACHEcompliance", r"you may not use this file except in compliance with the license"),
    ("APACHEobtain", r"you may obtain a copy of the license at"),
    ("APACHElaw", r"unless required by applicable law or agreed to in writing"),
    ("APACHEsee", r"see the license for the specific language governing permissions"),
    ("MITgrant", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("MITnotice", r"(above copyright notice and this permission notice|copyright notice.* permission notice) shall be included"),
    ("MITref", r"(released|licensed|distributed|available) under the (terms of the )?(mit|expat) license"),
    ("ISCgrant", r"permission to use copy modify and or distribute this software for any purpose"),
    ("BSDgrant", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("BSDsource", r"redistributions of source code must retain the above copyright notice"),
    ("BSDbinary", r"redistributions in binary form must reproduce the above copyright notice"),
    ("BSDendorse", r"neither the name.* may be used to endorse or promote products"),
    ("BSDref", r"(released|licensed|distributed) under the (new |modified |simplified |2 clause |3 clause )?bsd( style)? license"),
    ("ASIS", r"(software|work) is provided .*as is"),
    ("MPL2", r"subject to the terms of the mozilla public license v(ersion)?\.? ?2\.0"),
    ("MPL2obtain", r"if a copy of the mpl was not distributed with this file"),
    ("EPL2", r"eclipse public license.* (v|version )?2\.0"),
    ("UNLICENSE", r"free and unencumbered software released into the public domain"),
    ("CC0", r"(cc0 1\.0|creative commons zero)"),
    ("CCBYNCND", r"(cc by nc nd|creative commons attribution noncommercial noderiv)"),
    ("CCBYNCSA", r"(cc by nc sa|creative commons attribution noncommercial sharealike)"),
    ("CCBYNC", r"(cc by nc|creative commons attribution noncommercial)"),
    ("CCBYSA", r"(cc by sa|creative commons attribution sharealike)"),
    ("CCBYND", r"(cc by nd|creative commons attribution noderiv)"),
    ("CCBY", r"(cc by [0-9]|creative commons attribution [0-9])"),
]

#: Licence rules in order, each the identifiers that must follow each other.
RULES = [
    ("AGPL-3.0", ["AGPLver", "GPLuseful", "GPLsee", "GPLcopy"]), ("AGPL-3.0", ["AGPLver"]),
    ("LGPL-3.0", ["LGPLver3", "GPLuseful", "GPLsee", "GPLcopy"]), ("LGPL-3.0", ["LGPLver3"]),
    ("LGPL-2.1", ["LGPLver21", "GPLuseful", "GPLsee", "GPLcopy"]), ("LGPL-2.1", ["LGPLver21"]),
    ("GPL-3.0+", ["GPLver3plus", "GPLuseful", "GPLsee", "GPLcopy"]), ("GPL-3.0+", ["GPLver3plus"]),
    ("GPL-2.0+", ["GPLver2plus", "GPLuseful", "GPLsee", "GPLcopy"]), ("GPL-2.0+", ["GPLver2plus"]),
    ("GPL-3.0", ["GPLver3"]), ("GPL-2.0", ["GPLver2"]),
    ("Apache-2.0", ["APACHEref", "APACHEcompliance", "APACHEobtain", "APACHElaw", "APACHEsee"]),
    ("Apache-2.0", ["APACHEref", "APACHEcompliance", "APACHEobtain", "APACHElaw"]), ("Apache-2.0", ["APACHEref"]),
    ("MIT", ["MITgrant", "MITnotice", "ASIS"]), ("MIT", ["MITgrant", "MITnotice"]), ("MIT", ["MITref"]),
    ("ISC", ["ISCgrant", "ASIS"]), ("ISC", ["ISCgrant"]),
    ("BSD-3-Clause", ["BSDgrant", "BSDsource", "BSDbinary", "BSDendorse"]),
    ("BSD-2-Clause", ["BSDgrant", "BSDsource", "BSDbinary"]), ("BSD", ["BSDref"]),
    ("MPL-2.0", ["MPL2", "MPL2obtain"]), ("MPL-2.0", ["MPL2"]), ("EPL-2.0", ["EPL2"]),
    ("Unlicense", ["UNLICENSE"]), ("CC0-1.0", ["CC0"]),
    ("CC-BY-NC-ND", ["CCBYNCND"]), ("CC-BY-NC-SA", ["CCBYNCSA"]), ("CC-BY-NC", ["CCBYNC"]),
    ("CC-BY-SA", ["CCBYSA"]), ("CC-BY-ND", ["CCBYND"]), ("CC-BY", ["CCBY"]), ("SPDX", ["SPDX"]),
]

#: Sentences end after a mark before white space, at an empty line, or where a line ends
#: and the next starts upper case.
_SPLIT = re.compile(r"(?<=[.!?;:])[ \t\n]+|\n[ \t]*\n+|\n(?=[A-Z])")
_PLAIN = re.compile(r"[^a-z0-9.+]+")
_DOTS = re.compile(r"\.+( |$)")
_KNOWN = [(name, re.compile(pattern)) for name, pattern in SENTENCES]
#: Every known sentence has one of these words.
_WORDS = re.compile(r"licen|permission|redistribut|notice|copyright|warrant|provided|domain|spdx|public|cc0|cc by|"
                    r"creative|useful|endorse|applicable|mpl|governing")
#: An SPDX tag with its licence expression.
_ID = r"\(*[A-Za-z0-9][A-Za-z0-9.+-]*(?::[A-Za-z0-9.-]+)?\)*"
_TAG = re.compile(rf"(?i:SPDX-License-Identifier):[ \t]*({_ID}(?:[ \t]+(?:AND|OR|WITH)[ \t]+{_ID})*)")
_EXCEPTION = re.compile(r"[ \t]WITH[ \t]+[^ \t]+")
#: As ``_KNOWN``, but each match as short as it can be.
_SHORT = [(name, re.compile(pattern.replace(".*", ".*?"))) for name, pattern in SENTENCES]
_ORDER = {name: k for k, (name, _) in enumerate(SENTENCES)}


def normalise(sentence: str) -> str:
    return _DOTS.sub(r"\1", _PLAIN.sub(" ", sentence.lower())).strip()


def spdx_licences(text: str) -> list[str]:
    """Licences (by their names in ``RULES`` where they have one) of the SPDX tags of a text,
    each once, in order; exceptions after WITH are no licences."""
    out = []
    for expression in _TAG.findall(text):
        for name in re.split(r"[ \t]+(?:AND|OR)[ \t]+", _EXCEPTION.sub("", expression)):
            name = name.strip("()").rstrip(".")
            name = re.sub(r"-only$", "", re.sub(r"-or-later$", "+", name))
            name = re.sub(r"^([AL]GPL-[0-9.]+)\+$", r"\1", name)
            name = re.sub(r"^(CC-BY(?:-NC|-ND|-SA)*)-[0-9.]+$", r"\1", name)
            if name not in out:
                out.append(name)
    return out


def _over_lines(parts: list[tuple[int, str]], names: list[tuple[int, str]]) -> list[tuple[int, str]]:
    """``names`` of the lines ``parts`` (number, normalised) of one stretch without an end mark,
    with the known sentences that run over line ends. Of two that overlap, the first of
    ``SENTENCES`` counts."""
    start, size = [], 0
    for _, plain in parts:
        start.append(size)
        size += len(plain) + 1
    joined = " ".join(plain for _, plain in parts)
    line = {k: (at, plain) for at, (k, plain) in zip(start, parts, strict=True)}
    spans = []  # (from, to, number, name)
    for k, name in names:
        m = dict(_SHORT)[name].search(line[k][1])
        spans.append((line[k][0] + m.start(), line[k][0] + m.end(), k, name))
    for name, pattern in _SHORT:
        at = 0
        while m := pattern.search(joined, at):
            low, high = m.span()
            while later := pattern.search(joined, low + 1, high):  # the shortest that ends here
                low = later.start()
            i, j = bisect_right(start, low) - 1, bisect_right(start, high - 1) - 1
            over = [x for x in spans if x[0] < high and low < x[1]]
            if i < j and all(_ORDER[x[3]] > _ORDER[name] for x in over):
                spans = [x for x in spans if x not in over] + [(low, high, parts[i][0], name)]
            at = max(high, at + 1)
    return [(k, name) for _, _, k, name in sorted(spans)]


def known_sentences(text: str) -> list[tuple[int, str]]:
    """Numbers (from 0) and identifiers of the known sentences of a text, in order."""
    text = _TAG.sub(r"\n\nSPDX-License-Identifier:\1\n\n", text)  # a sentence of its own
    out, parts, names, at = [], [], [], 0

    def end() -> None:
        plain = " ".join(p for _, p in parts)
        out.extend(_over_lines(parts, names) if len(parts) > 1 and _WORDS.search(plain) else names)
        parts.clear()
        names.clear()

    for k, cut in enumerate([*_SPLIT.finditer(text), None]):
        plain = normalise(text[at:cut.start() if cut else len(text)])
        if plain:
            parts.append((k, plain))
        if _WORDS.search(plain):
            name = next((n for n, p in _KNOWN if p.search(plain)), None)
            if name:
                names.append((k, name))
        if cut is None or cut[0] != "\n" or text[cut.start() - 1:cut.start()] in tuple(".!?;:"):
            end()
        at = cut.end() if cut else at
    return out


def apply_rules(names: list[str]) -> tuple[list[str], list[str]]:
    """Licences (each once, in rule order) and the identifiers that no rule took."""
    rest, found = " " + "  ".join(names) + " ", []
    for licence, needed in RULES:
        want = " " + "  ".join(needed) + " "
        if want in rest:
            rest = rest.replace(want, " | ")
            if licence not in found:
                found.append(licence)
    return found, rest.replace("|", " ").split()


def _named(found: list[str], text: str) -> list[str]:
    """``found`` with the licences that the text's SPDX tags name for the rule's "SPDX"."""
    named = spdx_licences(text) if "SPDX" in found else []
    return list(dict.fromkeys([*(x for x in found if x != "SPDX"), *named])) if named else found


def scan(docs: DataFrame) -> DataFrame:
    """``docs`` (needs ``doc_id`` and ``text``) -> one row per input row: ``(doc_id, licenses,
    n_known, sentence_ids, sentence_numbers, unmatched)``.

    A null text counts as empty; texts without known sentences get empty lists. Repeated
    rows and null ids come back as they came; other columns are ignored. Empty input:
    empty result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strings = pa.list_(pa.string())
        for b in pieces(batches):
            texts = [(t or b"").decode("utf-8", "replace") for t in b.column(1).to_pylist()]
            known = [known_sentences(t) for t in texts]
            rules = [apply_rules([n for _, n in k]) for k in known]
            rules = [(_named(r[0], t), r[1]) for r, t in zip(rules, texts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([r[0] for r in rules], strings), pa.array([len(k) for k in known], pa.int64()),
                 pa.array([[n for _, n in k] for k in known], strings),
                 pa.array([[i for i, _ in k] for k in known], pa.list_(pa.int32())),
                 pa.array([r[1] for r in rules], strings)],
                ["doc_id", "licenses", "n_known", "sentence_ids", "sentence_numbers", "unmatched"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(
        run, "doc_id long, licenses array<string>, n_known long, sentence_ids array<string>, "
             "sentence_numbers array<int>, unmatched array<string>")


def oracle_sql() -> str:
    """DuckDB SQL of ``(doc_id, licenses, n_known)``: the same two tables, applied by SQL to
    every sentence of every document. It knows neither sentences over line ends nor what
    an SPDX tag names: equal on texts without those."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    case = " ".join(f"WHEN regexp_matches(s, {quote(p)}) THEN {quote(n)}" for n, p in SENTENCES)
    steps, last = [], "seq"
    for k, (licence, needed) in enumerate(RULES):
        want = quote(" " + "  ".join(needed) + " ")
        steps.append(f"r{k} AS (SELECT doc_id, n_known, CASE WHEN contains(rest, {want}) AND NOT list_contains(found, "
                     f"{quote(licence)}) THEN list_append(found, {quote(licence)}) ELSE found END AS found, "
                     f"replace(rest, {want}, ' | ') AS rest FROM {last})")
        last = f"r{k}"
    # RE2 has no lookaround: mark the ends of sentences with a character that texts lack
    cut = ("regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), '([.!?;:])[ \\t\\n]+', '\\1' || chr(1), 'g'), "
           "'\\n[ \\t]*\\n+', chr(1), 'g'), '\\n([A-Z])', chr(1) || '\\1', 'g')")
    return f"""
    WITH parts AS (SELECT doc_id, string_split({cut}, chr(1)) AS p FROM documents),
    one AS (SELECT doc_id, unnest(p) AS raw, generate_subscripts(p, 1) AS k FROM parts),
    plain AS (SELECT doc_id, k, trim(regexp_replace(regexp_replace(lower(raw), '[^a-z0-9.+]+', ' ', 'g'),
      '\\.+( |$)', '\\1', 'g')) AS s FROM one),
    named AS (SELECT doc_id, k, CASE {case} END AS name FROM plain),
    seq AS (SELECT doc_id, count(name) AS n_known, CAST([] AS VARCHAR[]) AS found,
      ' ' || coalesce(string_agg(name, '  ' ORDER BY k), '') || ' ' AS rest FROM named GROUP BY doc_id),
    {', '.join(steps)}
    SELECT doc_id, found AS licenses, n_known FROM {last}"""
