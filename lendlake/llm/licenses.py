"""Licence recognition by sentence rules (op7).

Texts are cut into sentences and lines, normalised (lower case, words of letters and
digits, a point only inside a number) and searched once by an automaton over all
known licence sentences, longest first. A sentence may run over lines. What it finds
is an identifier for each sentence; SPDX lines give one for each licence of their
expression. The identifiers, in text order, are matched against ordered rules, longest
first; a rule consumes its sentences. What is left over counts as unmatched.

A known sentence that stands inside another is counted unless one of the three
words before it, on its line and in its sentence, denies it ("is not licensed under
..."); at the start of a line only the word before the line break can. Those count as denied.

Only texts with one of the TRIGGERS, words that between them are in every known
sentence, are cut.

Cases: a null or empty text has no sentences; a sentence that occurs twice
counts twice; a row without doc_id is scanned like any other; repeated
documents are scanned each; an empty table gives no rows; other columns are
ignored; long texts take time in proportion to their length.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import ahocorasick
from pyspark.sql import DataFrame

from lendlake.llm.tables import id_text, map_rows

# Names of licences by SPDX identifier, as statements use them.
NAMES = {
    "MIT": ["MIT License", "MIT licence", "MIT"],
    "Apache-2.0": [
        "Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License",
        "Apache License, Version 2.0 (the \"License\")", "Apache-2.0",
    ],
    "BSD-2-Clause": ["BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License"],
    "BSD-4-Clause": ["BSD 4-Clause License", "4-Clause BSD License"],
    "ISC": ["ISC License"],
    "Zlib": ["zlib License"],
    "Unlicense": ["Unlicense"],
    "BSL-1.0": ["Boost Software License, Version 1.0", "Boost Software License 1.0"],
    "MPL-2.0": ["Mozilla Public License, v. 2.0", "Mozilla Public License 2.0", "Mozilla Public License, version 2.0"],
    "EPL-1.0": ["Eclipse Public License 1.0", "Eclipse Public License v1.0"],
    "EPL-2.0": ["Eclipse Public License 2.0", "Eclipse Public License v2.0", "Eclipse Public License v. 2.0"],
    "CC0-1.0": ["CC0", "CC0 1.0", "CC0 1.0 Universal", "Creative Commons Zero v1.0 Universal"],
}
# Creative Commons licences, by short name: the parts of the long name.
CREATIVE_COMMONS = {
    "BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-ND": "Attribution-NoDerivatives",
    "BY-NC": "Attribution-NonCommercial", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
# GNU licences with their versions.
GNU = {
    "GPL": ("General Public License", ["2.0", "3.0"]),
    "LGPL": ("Lesser General Public License", ["2.1", "3.0"]),
    "AGPL": ("Affero General Public License", ["3.0"]),
}
# Sentences of licence texts.
TEXTS = {
    "ApacheNoUse": ["you may not use this file except in compliance with the License"],
    "ApacheCopy": ["You may obtain a copy of the License at"],
    "ApacheAsIs": [
        "Unless required by applicable law or agreed to in writing, software distributed under the License is"
        " distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    ],
    "GPLHope": [
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
        "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
    ],
    "MITGrant": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the \"Software\"), to deal in the Software without restriction, including without"
        " limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of"
        " the Software, and to permit persons to whom the Software is furnished to do so, subject to the following"
        " conditions",
    ],
    "MITNotice": [
        "The above copyright notice and this permission notice shall be included in all copies or substantial"
        " portions of the Software",
    ],
    "MITAsIs": [
        "The software is provided \"as is\", without warranty of any kind, express or implied, including but not"
        " limited to the warranties of merchantability, fitness for a particular purpose and noninfringement",
    ],
    "BSDGrant": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
        " that the following conditions are met",
    ],
    "BSDSource": [
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the"
        " following disclaimer",
    ],
    "BSDBinary": [
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the"
        " following disclaimer in the documentation and/or other materials provided with the distribution",
    ],
    "BSDAds": [
        "All advertising materials mentioning features or use of this software must display the following"
        " acknowledgement",
    ],
    "BSDName": [
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote"
        " products derived from this software without specific prior written permission",
    ],
    "BSDAsIs": [
        "This software is provided by the copyright holders and contributors \"as is\" and any express or implied"
        " warranties, including, but not limited to, the implied warranties of merchantability and fitness for a"
        " particular purpose are disclaimed",
    ],
    "ISCGrant": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is"
        " hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
        "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is"
        " hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    ],
    "ISCAsIs": [
        "The software is provided \"as is\" and the author disclaims all warranties with regard to this software"
        " including all implied warranties of merchantability and fitness",
    ],
    "ZlibAsIs": ["This software is provided 'as-is', without any express or implied warranty"],
    "ZlibGrant": [
        "Permission is granted to anyone to use this software for any purpose, including commercial applications,"
        " and to alter it and redistribute it freely, subject to the following restrictions",
    ],
    "PublicDomain": ["This is free and unencumbered software released into the public domain"],
    "UnlicenseGrant": [
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source"
        " code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means",
    ],
    "BoostGrant": [
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software"
        " and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display,"
        " distribute, execute, and transmit the Software",
    ],
    "IsMPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"],
    "IsCC0-1.0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to"
        " this work",
    ],
    "Reserved": ["All rights reserved under copyright law"],
}
# Rules over sequences of the texts' sentences.
TEXT_RULES = [
    ("BSD-4-Clause", ["BSDGrant", "BSDSource", "BSDBinary", "BSDAds", "BSDName"]),
    ("BSD-3-Clause", ["BSDGrant", "BSDSource", "BSDBinary", "BSDName"]),
    ("BSD-2-Clause", ["BSDGrant", "BSDSource", "BSDBinary"]),
    ("Apache-2.0", ["IsApache-2.0", "ApacheNoUse", "ApacheCopy", "ApacheAsIs"]),
    ("MIT", ["MITGrant", "MITNotice"]),
    ("ISC", ["ISCGrant"]),
    ("Zlib", ["ZlibAsIs", "ZlibGrant"]),
    ("Unlicense", ["PublicDomain", "UnlicenseGrant"]),
    ("Unlicense", ["PublicDomain"]),
    ("BSL-1.0", ["BoostGrant"]),
]
# The disclaimer that may close a licence's text.
CLOSING = {"BSD": "BSDAsIs", "MIT": "MITAsIs", "ISC": "ISCAsIs", "BSL": "MITAsIs", "Unl": "MITAsIs"}
# How a statement begins, and words that deny it.
VERBS = ("licensed", "released", "distributed", "available", "published", "provided")
LINKS = ("under", "under the terms of")
ARTICLES = ("the", "a", "an", "")
DENIALS = {"not", "never", "neither", "nor", "longer", "isn", "aren", "wasn"}
LATER = ("or later", "or any later version", "or (at your option) any later version")

_END = re.compile(r"(?<=[.!?:;])\s+")
_OTHER = re.compile(r"(?<![0-9])\.|\.(?![0-9])|[^a-z0-9.]+")
_SPDX = re.compile(r"[^A-Za-z0-9]{0,16}SPDX-License-Identifier:(.*)", re.IGNORECASE)
_SPDX_WORD = re.compile(r"[A-Za-z0-9.+-]+")
_BACK = 3


def normalised(sentence: str) -> str:
    return " ".join(_OTHER.sub(" ", sentence.lower()).split())


def _all_names() -> dict[str, list[str]]:
    names = {k: list(v) for k, v in NAMES.items()}
    for short, long in CREATIVE_COMMONS.items():
        for v in ("3.0", "4.0"):
            kind = "International" if v == "4.0" else "Unported"
            full = f"Creative Commons {long} {v}"
            names[f"CC-{short}-{v}"] = [f"CC {short} {v}", full, f"{full} License", f"{full} {kind} License"]
    for short, (long, versions) in GNU.items():
        for v in versions:
            numbers = [v, v[:-2]] if v.endswith(".0") else [v]
            said = [
                name
                for n in numbers
                for name in (
                    f"GNU {long}, version {n}", f"GNU {long} v{n}", f"GNU {short}, version {n}", f"GNU {short} v{n}",
                    f"GNU {short}v{n}", f"{short}v{n}", f"{short} v{n}", f"{short}-{n}", f"{short} version {n}",
                )
            ]
            names[f"{short}-{v}-only"] = [*said, f"{short}-{v}-only"]
            names[f"{short}-{v}-or-later"] = [f"{s} {x}" for s in said for x in LATER] + [f"{short}-{v}-or-later"]
    return names


def _sentences() -> dict[str, list[str]]:
    """All sentences by identifier: the texts', statements made of verb, link, article
    and name, and the GNU grants."""
    out = {k: list(v) for k, v in TEXTS.items()}
    for spdx, names in _all_names().items():
        begin = [" ".join(filter(None, (v, u, a))) for v in VERBS for u in LINKS for a in ARTICLES]
        out.setdefault(f"Is{spdx}", []).extend(f"{b} {n}" for b in begin for n in names)
    for short, (long, versions) in GNU.items():
        for v in versions:
            number = v.removesuffix(".0")
            for thing in ("program", "library"):
                grant = (
                    f"This {thing} is free software: you can redistribute it and/or modify it under the terms of the"
                    f" GNU {long} as published by the Free Software Foundation"
                )
                out[f"Is{short}-{v}-only"] += [f"{grant}, version {number}", f"{grant}; version {number}"]
                out[f"Is{short}-{v}-or-later"] += [
                    f"{grant}, either version {number} of the License, or (at your option) any later version"
                ]
    return out


def _rules() -> list[tuple[str, list[str]]]:
    rules = list(TEXT_RULES)
    rules += [(n, [*seq, CLOSING[n[:3]]]) for n, seq in TEXT_RULES if n[:3] in CLOSING]
    for spdx in _all_names():
        rules.append((spdx, [f"Is{spdx}"]))
        if "GPL" in spdx:
            rules.append((spdx, [f"Is{spdx}", "GPLHope"]))
    return sorted(rules, key=lambda r: -len(r[1]))


def _triggers(sentences: list[str]) -> tuple[str, ...]:
    """Long words of which each sentence has one: the most frequent first."""
    left = [{w for w in s.split() if len(w) > 5} or set(s.split()) for s in sentences]
    out = []
    while left:
        counts = Counter(w for words in left for w in words)
        best = min(counts, key=lambda w: (-counts[w], w))
        out.append(best)
        left = [words for words in left if best not in words]
    return (*out, "spdx")


SENTENCES = _sentences()
RULES = _rules()
_KNOWN = {normalised(s): name for name, all_of in SENTENCES.items() for s in all_of}
_BY_SPDX = {name.lower(): f"Is{name}" for name in _all_names()}
TRIGGERS = _triggers(sorted(_KNOWN))
_STARTS: dict[str, list[tuple[str, list[str]]]] = {}
for _name, _rule in RULES:
    _STARTS.setdefault(_rule[0], []).append((_name, _rule))


def _wrapped(normal: str) -> str:
    """Each word in brackets, so that whatever is found begins and ends with words."""
    return f"<{normal.replace(' ', '><')}>"


_FIND = ahocorasick.Automaton()
for _sentence, _name in _KNOWN.items():
    _FIND.add_word(_wrapped(_sentence), (_name, len(_wrapped(_sentence))))
_FIND.make_automaton()


def _spdx(expression: str) -> list[str]:
    """Identifiers of an SPDX expression's licences; exceptions are passed over."""
    out, exception = [], False
    for word in _SPDX_WORD.findall(expression):
        if exception or word.upper() in ("AND", "OR", "WITH"):
            exception = word.upper() == "WITH"
            continue
        name = word.lower()
        later = f"{name[:-1]}-or-later" if name.endswith("+") else f"{name}-only"
        out.append(_BY_SPDX.get(name) or _BY_SPDX.get(later) or "SpdxOther")
    return out


def identifiers(text: str | None) -> tuple[list[str], int]:
    """(identifiers of the known sentences in text order, how many were denied)."""
    low = (text or "").lower()
    if not any(t in low for t in TRIGGERS):
        return [], 0
    wrapped, starts, in_line, at, found = [], [], [], 0, []
    for line in text.split("\n"):
        if m := _SPDX.match(line):
            found += [(at, name) for name in _spdx(m.group(1))]
            wrapped.append("|")  # no sentence runs across
            starts.append(at)
            in_line.append(False)
            at += 1
            continue
        for k, part in enumerate(_END.split(line)):
            if normal := normalised(part):
                starts.append(at)
                in_line.append(k == 0)
                wrapped.append(_wrapped(normal))
                at += len(wrapped[-1])
    joined, denied = "".join(wrapped), 0
    for end, (name, size) in _FIND.iter_long(joined):
        start = end + 1 - size
        k = bisect_right(starts, start) - 1
        if starts[k] < start:
            before = joined[starts[k] : start][1:-1].split("><")[-_BACK:]
        else:  # a sentence's own start can't be denied, a line's by the word before it
            before = joined[max(0, start - 10) : start].strip("<>").split("><")[-1:] if in_line[k] and k else []
        if DENIALS.intersection(before):
            denied += 1
        else:
            found.append((start, name))
    return [name for _, name in sorted(found, key=lambda f: f[0])], denied


def recognised(found: list[str]) -> tuple[list[str], int]:
    """(licences in order, sentences that no rule consumed)."""
    out, left, at = [], 0, 0
    while at < len(found):
        for name, rule in _STARTS.get(found[at], ()):
            if found[at : at + len(rule)] == rule:
                out.append(name)
                at += len(rule)
                break
        else:
            left += 1
            at += 1
    return out, left


def scan(docs: DataFrame) -> DataFrame:
    """One row for each document: doc_id, sentence_ids (in order, joined by
    commas), licences (distinct, sorted, joined), n_licences (rules matched),
    n_unmatched (known sentences outside rules), n_denied (statements denied)."""

    def scanned(batches: Iterator[list]) -> Iterator[list]:
        for ids, texts in batches:
            rows = []
            for i, text in zip(ids, texts):
                found, denied = identifiers(text)
                names, left = recognised(found)
                rows.append((i, ",".join(found), ",".join(sorted(set(names))), len(names), left, denied))
            yield rows

    return map_rows(
        id_text(docs),
        scanned,
        "doc_id long, sentence_ids string, licences string, n_licences long, n_unmatched long, n_denied long",
    )
