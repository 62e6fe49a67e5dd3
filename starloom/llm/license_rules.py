"""License scans by sentence rules.

A text is cut into sentences, each is normalised (lower case, runs of
everything but letters and digits become one blank, British spelling of
"licence") and looked up among known license sentences.  The sequence of their
identifiers is matched against ordered rules: at each place the first rule
whose identifiers follow one another there names the license, and the search
goes on behind it.  Unknown sentences between known ones end a sequence,
copyright lines, blank ones and list markers ("1.", "(a)") don't.

Sentences end at ``.``, ``;``, ``:``, ``!`` or ``?`` before white space, and at
the end of the text.  A line break ends one too in a first reading; where that
finds nothing, a second reading takes single line breaks as blanks, so
sentences may be wrapped.  Known sentences that hold such an end themselves
("Foundation; either version 2") are found as pieces in a row, and where a license
names an organisation any name will do.  Offsets count code points of the text, ends are exclusive.  NULL
and empty texts have no licenses; repeated rows are read one by one.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Known sentences by identifier, as they stand in the public texts of the licenses.
SENTENCES = {
    "apache-ref": ["Licensed under the Apache License, Version 2.0",
                   "Licensed under the Apache License 2.0",
                   'Licensed under the Apache License, Version 2.0 (the "License")'],
    "apache-comply": ["you may not use this file except in compliance with the License"],
    "apache-obtain": ["You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
                      "You may obtain a copy of the License at https://www.apache.org/licenses/LICENSE-2.0",
                   "You may obtain a copy of the License at"],
    "apache-asis": ['Unless required by applicable law or agreed to in writing, software distributed under the License is '
                    'distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied'],
    "apache-see": ["See the License for the specific language governing permissions and limitations under the License"],
    "mit-ref": ["Released under the MIT License", "Licensed under the MIT License", "Distributed under the MIT License",
                "This project is licensed under the MIT License"],
    "mit-grant": ['Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated '
                  'documentation files (the "Software"), to deal in the Software without restriction, including without '
                  'limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of '
                  'the Software, and to permit persons to whom the Software is furnished to do so, subject to the following '
                  'conditions'],
    "mit-notice": ["The above copyright notice and this permission notice shall be included in all copies or substantial "
                   "portions of the Software"],
    "mit-asis": ['THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED '
                 'TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT'],
    "isc-grant": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
                  "hereby granted, provided that the above copyright notice and this permission notice appear in all copies"],
    "bsd-grant": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                  "that the following conditions are met"],
    "bsd-source": ["Redistributions of source code must retain the above copyright notice, this list of conditions and the "
                   "following disclaimer"],
    "bsd-binary": ["Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
                   "following disclaimer in the documentation and/or other materials provided with the distribution"],
    "bsd-endorse": ["Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
                    "promote products derived from this software without specific prior written permission"],
    "gpl3-ref": ["This work is licensed under the GNU General Public License, version 3",
                 "Licensed under the GNU General Public License, version 3", "Licensed under the GPLv3"],
    "gpl2-ref": ["This work is licensed under the GNU General Public License, version 2",
                 "Licensed under the GNU General Public License, version 2", "Licensed under the GPLv2"],
    "gpl-free": ["This program is free software"],
    "gpl3-later": ["you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
                   "the Free Software Foundation, either version 3 of the License, or (at your option) any later version"],
    "gpl2-later": ["you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
                   "the Free Software Foundation; either version 2 of the License, or (at your option) any later version"],
    "mpl2-ref": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"],
    "cc-by-ref": ["Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "cc-by-sa-ref": ["Licensed under CC BY-SA 4.0",
                     "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "cc-by-nc-ref": ["Licensed under CC BY-NC 4.0",
                     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "cc0-ref": ["Released under CC0 1.0", "Licensed under CC0 1.0"],
    "unlicense-ref": ["This is free and unencumbered software released into the public domain"],
    "all-rights": ["All rights reserved"],
}
# Known sentences with a name in them, as normalised, and how they begin.
NAMED = {"bsd-endorse": (("neither the name", "the name"), re.compile(
    r"(?:neither the names? of .+ nor the names? of .+ may|the names? of .+ may not) be used to endorse or promote products "
    r"derived from this software without (?:specific )?prior written permission"))}
#: Pieces that a sentence with a name may come in ("Neither the name of Some Co. Inc. nor ...").
PIECES = 6
# Rules in the order in which they are tried; longer sequences come before what they begin with.
RULES = [
    ("Apache-2.0", ["apache-ref", "apache-comply", "apache-obtain", "apache-asis", "apache-see"]),
    ("Apache-2.0", ["apache-ref", "apache-comply"]),
    ("Apache-2.0", ["apache-ref"]),
    ("MIT", ["mit-grant", "mit-notice", "mit-asis"]),
    ("MIT", ["mit-grant", "mit-notice"]),
    ("MIT", ["mit-ref"]),
    ("ISC", ["isc-grant"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl3-later"]),
    ("GPL-2.0-or-later", ["gpl-free", "gpl2-later"]),
    ("GPL-3.0-only", ["gpl3-ref"]),
    ("GPL-2.0-only", ["gpl2-ref"]),
    ("MPL-2.0", ["mpl2-ref"]),
    ("CC-BY-4.0", ["cc-by-ref"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-ref"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-ref"]),
    ("CC0-1.0", ["cc0-ref"]),
    ("Unlicense", ["unlicense-ref"]),
]
#: Each known sentence holds one of these words; texts without any are not cut.
HINTS = ("license", "licence", "permission", "redistribut", "warrant", "copyright", "rights", "free software", "released")

_PARTS = {True: re.compile(r"[^\n]*?(?:[.;:!?]+(?=\s|$)|\n|$)", re.S), False: re.compile(r".*?(?:[.;:!?]+(?=\s|\Z)|\n[^\S\n]*\n|\Z)", re.S)}
_WORDS = re.compile(r"[^\W_]+")
#: A list marker alone, or before a sentence.
_MARKER = re.compile(r"[\W_]*(?:\d{1,3}|[a-z]|[ivx]{1,4})[.)\]:]+(?:\s+|\Z)", re.I)
_IGNORED = re.compile(r"\s*(copyright|\(c\)|©)", re.I)


def normalise(sentence: str) -> str:
    return " ".join(_WORDS.findall(sentence.lower())).replace("licence", "license")


KNOWN = {normalise(s): k for k, forms in SENTENCES.items() for s in forms}
#: How known sentences begin, up to every word: a piece that is such a beginning may go on in the next one.
BEGINNINGS = {s[:i] for s in KNOWN for i, c in enumerate(s) if c == " "}
LONGEST = max(len(r) for _, r in RULES)


def _identify(pieces: list[tuple[str, int, int]], i: int) -> tuple[str | None, int]:
    """The identifier of the longest known sentence that begins with piece i,
    and the piece behind it."""
    found, words = (None, i + 1), ""
    named = [(k, full) for k, (starts, full) in NAMED.items() if pieces[i][0].startswith(starts)]
    for j in range(i, len(pieces)):
        words = f"{words} {pieces[j][0]}" if words else pieces[j][0]
        key = KNOWN.get(words) or next((k for k, full in named if full.fullmatch(words)), None)
        if key:
            found = key, j + 1
        if words not in BEGINNINGS and (not named or found[0] or j - i + 1 >= PIECES):
            break
    return found


def _reading(text: str, breaks: bool) -> list[tuple[str | None, int, int]]:
    """(identifier or None, start, end) of each sentence that counts."""
    pieces = []
    for m in _PARTS[breaks].finditer(text):
        piece = m[0].rstrip()
        marker = _MARKER.match(piece)
        words = _WORDS.search(piece, marker.end() if marker else 0)
        if not words:
            continue
        named = normalise(piece[words.start():])
        if _IGNORED.match(piece) and named not in KNOWN:
            continue
        pieces.append((named, m.start() + words.start(), m.start() + len(piece)))
    out, i = [], 0
    while i < len(pieces):
        key, behind = _identify(pieces, i)
        out.append((key, pieces[i][1], pieces[behind - 1][2]))
        i = behind
    return out


def known_sentences(text: str | None) -> list[tuple[str | None, int, int]]:
    """Known sentences in order; one None stands for unknown ones between."""
    low = (text or "").lower()
    if not any(h in low for h in HINTS):
        return []
    lines = _reading(text, True)
    taken = [(s, e) for k, s, e in lines if k]
    wrapped = [x for x in _reading(text, False) if x[0] and not any(s < x[2] and x[1] < e for s, e in taken)]
    inside = [(s, e) for _, s, e in wrapped]
    rest = [x for x in lines if x[0] or not any(s <= x[1] and x[2] <= e for s, e in inside)]
    out: list[tuple[str | None, int, int]] = []
    for x in sorted([*rest, *wrapped], key=lambda x: x[1]):
        if x[0] or (out and out[-1][0]):
            out.append(x)
    return out


def match_rules(seq: list[tuple[str | None, int, int]]) -> list[dict]:
    """Licenses named by a sequence of sentences."""
    out, i = [], 0
    while i < len(seq):
        ids = [k for k, _, _ in seq[i:i + LONGEST]]
        for name, rule in RULES:
            if ids[:len(rule)] == rule:
                out.append({"license": name, "start": seq[i][1], "end": seq[i + len(rule) - 1][2]})
                i += len(rule)
                break
        else:
            i += 1
    return out


FOUND_TYPE = T.StructType([
    T.StructField("sentences", T.ArrayType(T.StringType())),
    T.StructField("licenses", T.ArrayType(T.StructType([
        T.StructField("license", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])))])


@F.pandas_udf(FOUND_TYPE)
def _found(text: pd.Series) -> pd.DataFrame:
    rows = []
    for t in text:
        seq = known_sentences(t)
        rows.append(([k for k, _, _ in seq if k], match_rules(seq)))
    return pd.DataFrame(rows, columns=["sentences", "licenses"])


def scan_licenses(docs: DataFrame, text_col: str = "text", out_col: str = "found") -> DataFrame:
    """``docs`` with a struct: sentences (identifiers in order) and licenses
    (name, start, end).  Other columns pass; ``out_col`` replaces a column of
    that name."""
    return docs.withColumn(out_col, _found(F.col(text_col).cast("string")))


def digest(docs: DataFrame) -> DataFrame:
    """The query's columns."""
    out = scan_licenses(docs.select("doc_id", "text"))
    spans = F.array_join(F.transform("found.licenses", lambda x: F.concat_ws(
        ":", x["license"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    return out.select("doc_id", F.size("found.sentences").cast("long").alias("n_sentences"),
                      F.array_join("found.sentences", ",").alias("sentences"), spans.alias("licenses"))
