"""Licence recognition: known sentences become identifiers, ordered rules over these name the licence."""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import with_columns

# Sentences of public licences and notices. ``<>`` stands for one word that may vary.
SENTENCES: dict[str, list[str]] = {
    "copyright": ["Copyright <> <>", "Copyright (c) <> <>", "Copyright <> <> <>"],
    "all-rights": ["All rights reserved"],
    "mit-notice": [
        "Released under the MIT License", "Licensed under the MIT License", "This project is licensed under the MIT License",
        "Distributed under the MIT License", "This software is released under the MIT License",
    ],
    "mit-grant": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions",
    ],
    "mit-condition": [
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    ],
    "mit-warranty": [
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
        "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    ],
    "mit-liability": [
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN "
        "ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE",
    ],
    "apache2-notice": [
        "Licensed under the Apache License, Version 2.0", "Licensed under the Apache License, Version 2.0 (the \"License\")",
        "This work is licensed under the Apache License, Version 2.0", "Released under the Apache License, Version 2.0",
    ],
    "apache-compliance": ["you may not use this file except in compliance with the License"],
    "apache-copy": ["You may obtain a copy of the License at"],
    "apache-basis": [
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on "
        "an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    ],
    "gpl2-notice": [
        "This work is licensed under the GNU General Public License, version 2", "Licensed under the GNU General Public License, version 2",
    ],
    "gpl3-notice": [
        "This work is licensed under the GNU General Public License, version 3", "Licensed under the GNU General Public License, version 3",
        "Released under the GNU General Public License, version 3",
    ],
    "gpl-terms": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation",
    ],
    "gpl2-or-later": ["either version 2 of the License, or (at your option) any later version"],
    "gpl3-or-later": ["either version 3 of the License, or (at your option) any later version"],
    "gpl-warranty": [
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
    ],
    "cc-by-nc4-notice": ["Licensed under CC BY-NC 4.0", "This work is licensed under CC BY-NC 4.0"],
    "cc-by4-notice": ["Licensed under CC BY 4.0", "This work is licensed under CC BY 4.0"],
    "cc-by-sa4-notice": ["Licensed under CC BY-SA 4.0", "This work is licensed under CC BY-SA 4.0"],
    "cc0-notice": ["Released under CC0 1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work"],
    "bsd-grant": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
    ],
    "bsd-source": [
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    ],
    "bsd-binary": [
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution",
    ],
    "bsd-names": [
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission",
    ],
    "isc-grant": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies",
    ],
    "mpl2-notice": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"],
    "unlicense": ["This is free and unencumbered software released into the public domain"],
}

# A licence and the sentences that make it, in order. Longer rules come first; other known
# sentences of a notice (copyright, all rights reserved) may stand before and between.
RULES: list[tuple[str, list[str]]] = [
    ("MIT", ["mit-grant", "mit-condition", "mit-warranty", "mit-liability"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names"]),
    ("Apache-2.0", ["apache2-notice", "apache-compliance", "apache-copy", "apache-basis"]),
    ("GPL-3.0-or-later", ["gpl-terms", "gpl3-or-later", "gpl-warranty"]),
    ("GPL-2.0-or-later", ["gpl-terms", "gpl2-or-later", "gpl-warranty"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("GPL-3.0-or-later", ["gpl-terms", "gpl3-or-later"]),
    ("GPL-2.0-or-later", ["gpl-terms", "gpl2-or-later"]),
    ("MIT", ["mit-notice"]),
    ("Apache-2.0", ["apache2-notice"]),
    ("GPL-2.0", ["gpl2-notice"]),
    ("GPL-3.0", ["gpl3-notice"]),
    ("CC-BY-NC-4.0", ["cc-by-nc4-notice"]),
    ("CC-BY-SA-4.0", ["cc-by-sa4-notice"]),
    ("CC-BY-4.0", ["cc-by4-notice"]),
    ("CC0-1.0", ["cc0-notice"]),
    ("ISC", ["isc-grant"]),
    ("MPL-2.0", ["mpl2-notice"]),
    ("Unlicense", ["unlicense"]),
]
PASSED_OVER = frozenset(["copyright", "all-rights"])
# What known licence sentences that complete no rule are called.
UNKNOWN = "unknown"

_WORD = re.compile(r"\S+")
_EDGES = re.compile(r"^[^a-z0-9<]+|[^a-z0-9>]+$")
_ENDS = re.compile(r"[.;:!?][\"')\]]*$")


def normal_word(word: str) -> str:
    """A word in lower case without marks at its ends; one spelling of licence."""
    return _EDGES.sub("", word.lower()).replace("licence", "license")


class Recognizer:
    """Known sentences by their first word, and the rules."""

    def __init__(self, sentences: dict[str, list[str]] = SENTENCES, rules: list[tuple[str, list[str]]] = RULES):
        self.by_first: dict[str, list[tuple[str, list[str]]]] = {}
        for name, variants in sentences.items():
            for text in variants:
                words = [w for w in map(normal_word, text.split()) if w]
                self.by_first.setdefault(words[0], []).append((name, words))
        for found in self.by_first.values():
            found.sort(key=lambda s: -len(s[1]))  # the longest reading wins
        self.rules = rules

    def sentences(self, text: str) -> list[tuple[str, int, int]]:
        """``(identifier, start, end)`` of the known sentences, by character offsets.

        A sentence begins where a line or the sentence before ends, after comment marks; it may run over line ends,
        and ends where a sentence or line does.
        """
        words = [(normal_word(m[0]), m.start(), m.end()) for m in _WORD.finditer(text)]
        words = [w for w in words if w[0]]
        out, i = [], 0
        while i < len(words):
            known = self.by_first.get(words[i][0]) if self._begins(text, words, i) else None
            for name, spelled in known or ():
                last = i + len(spelled) - 1
                if last < len(words) and self._ends(text, words, last) and all(
                    s == "<>" or s == w[0] for s, w in zip(spelled, words[i: last + 1])
                ):
                    out.append((name, words[i][1], words[last][2]))
                    i = last
                    break
            i += 1
        return out

    @staticmethod
    def _begins(text: str, words: list, i: int) -> bool:
        if not i:
            return True
        before = text[words[i - 1][1]: words[i][1]]
        return "\n" in before or bool(_ENDS.search(before.rstrip(" \t*#/-"))) or before.rstrip().endswith(",")

    @staticmethod
    def _ends(text: str, words: list, i: int) -> bool:
        after = text[words[i][1]: words[i + 1][1]] if i + 1 < len(words) else "\n"
        return "\n" in after or bool(_ENDS.search(after.rstrip())) or after.rstrip().endswith(",")

    def licences(self, found: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
        """Licences by the rules over a sequence of known sentences; what is left over is unknown."""
        telling = [f for f in found if f[0] not in PASSED_OVER]
        out, i = [], 0
        while i < len(telling):
            for name, wanted in self.rules:
                if [f[0] for f in telling[i: i + len(wanted)]] == wanted:
                    out.append((name, telling[i][1], telling[i + len(wanted) - 1][2]))
                    i += len(wanted)
                    break
            else:
                out.append((UNKNOWN, telling[i][1], telling[i][2]))
                i += 1
        return out

    def __call__(self, text: str) -> tuple[list[tuple[str, int, int]], list[str]]:
        """Licences with their places, and the identifiers of all known sentences in order."""
        if not self._may_have(text):
            return [], []
        found = self.sentences(text)
        return self.licences(found), [f[0] for f in found]

    def _may_have(self, text: str) -> bool:
        lowered = text.lower()
        return any(w in lowered for w in _TELLING)


# Every known sentence holds one of these.
_TELLING = (
    "license", "licence", "copyright", "rights reserved", "licensed", "permission", "warranty", "liable", "redistribut",
    "cc0", "endorse", "version", "public domain", "software",
)


def with_licences(docs: DataFrame, text: str = "text") -> DataFrame:
    """All rows with ``licences`` (name, first and end character of each, in order) and ``sentences`` (known identifiers).

    Whole texts are read. A NULL or empty text has neither; repeated rows get the same answer; columns of these
    names are replaced.
    """

    def make() -> Callable:
        recognize = Recognizer()

        def work(batch: pa.RecordBatch) -> list:
            found = [recognize(t or "") for t in batch.column("__in_0").to_pylist()]
            named = [[{"licence": n, "start": a, "end": b} for n, a, b in x] for x, _ in found]
            return [named, [s for _, s in found]]

        return work

    return with_columns(
        docs, [text], "licences array<struct<licence: string, start: int, end: int>>, sentences array<string>", make
    )
