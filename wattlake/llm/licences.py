"""Licence scans: Dice coefficient over word bigrams between passages of a text and licence templates."""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST = 0.8
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
_BSD_THIRD = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. "
_BSD_END = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_NOTICE = ", provided that the above copyright notice and this permission notice appear in all copies."
_ISC_END = " THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
_MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"
_MIT_END = ", including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
_UNLICENSE = "This is free and unencumbered software released into the public domain."
_UNLICENSE_USE = " Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."
_UNLICENSE_END = " In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. For more information, please refer to https://unlicense.org"
_BOOST = "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
_WTFPL = "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE TERMS AND CONDITIONS FOR COPYING, DISTRIBUTION AND MODIFICATION\n0. You just DO WHAT THE FUCK YOU WANT TO."
_ZLIB = "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."


def _gnu(name: str, version: str, subject: str = "program") -> str:
    return f"This {subject} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version."


def _gnu_only(name: str, version: str, subject: str = "program") -> str:
    return f"This {subject} is free software; you can redistribute it and/or modify it under the terms of the GNU {name} version {version} as published by the Free Software Foundation."


def _commons(short: str, long: str, version: str) -> list[str]:
    where = {"4.0": "International", "3.0": "Unported"}.get(version, "Generic")
    works = [f"This work is licensed under a Creative Commons {long} {version} {w}License." for w in ("", f"{where} ")]
    return [f"Licensed under CC {short} {version}.", *works, _spdx(f"CC-{short.replace(' ', '-')}-{version}")]


def _spdx(name: str) -> str:
    return f"SPDX-License-Identifier: {name}"


def _gnu_spdx(name: str) -> list[str]:
    return [_spdx(name + end) for end in ("", "-only", "-or-later")]


# Licence texts, and the notices by which works are licensed.
TEMPLATES = {
    "0BSD": [f"{_ISC}.{_ISC_END}", _spdx("0BSD")],
    "AGPL-3.0": ["This work is licensed under the GNU Affero General Public License, version 3.", _gnu("Affero General Public License", "3"), _gnu_only("Affero General Public License", "3"), *_gnu_spdx("AGPL-3.0")],
    "Apache-1.1": ["Licensed under the Apache License, Version 1.1.", _spdx("Apache-1.1")],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", _spdx("Apache-2.0")],
    "BSD-2-Clause": ["Released under the BSD 2-Clause License.", _BSD + _BSD_END, _spdx("BSD-2-Clause")],
    "BSD-3-Clause": ["Released under the BSD 3-Clause License.", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", _BSD + _BSD_THIRD + _BSD_END, _spdx("BSD-3-Clause")],
    "BSL-1.0": ["Distributed under the Boost Software License, Version 1.0.", _BOOST, _spdx("BSL-1.0")],
    **{f"CC-{short.replace(' ', '-')}-{version}": _commons(short, long, version) for short, long in (("BY", "Attribution"), ("BY-NC", "Attribution-NonCommercial"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"), ("BY-ND", "Attribution-NoDerivatives"), ("BY-SA", "Attribution-ShareAlike")) for version in ("2.0", "2.5", "3.0", "4.0")},
    "CC0-1.0": ["Released into the public domain under CC0 1.0.", _spdx("CC0-1.0")],
    "EPL-1.0": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0.", _spdx("EPL-1.0")],
    "EPL-2.0": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0.", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0", _spdx("EPL-2.0")],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2.", _gnu("General Public License", "2"), _gnu_only("General Public License", "2"), *_gnu_spdx("GPL-2.0")],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", _gnu("General Public License", "3"), _gnu_only("General Public License", "3"), *_gnu_spdx("GPL-3.0")],
    "ISC": ["Released under the ISC License.", _ISC + _ISC_NOTICE, _ISC + _ISC_NOTICE + _ISC_END, _spdx("ISC")],
    "LGPL-2.1": ["This work is licensed under the GNU Lesser General Public License, version 2.1.", _gnu("Lesser General Public License", "2.1", "library"), _gnu_only("Lesser General Public License", "2.1", "library"), *_gnu_spdx("LGPL-2.1")],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3.", _gnu("Lesser General Public License", "3", "library"), _gnu_only("Lesser General Public License", "3", "library"), *_gnu_spdx("LGPL-3.0")],
    "MIT": ["Released under the MIT License.", _MIT, _MIT + _MIT_END, _spdx("MIT")],
    "MPL-1.1": ["The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.mozilla.org/MPL/", _spdx("MPL-1.1")],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.", _spdx("MPL-2.0")],
    "Unlicense": [_UNLICENSE, _UNLICENSE + _UNLICENSE_USE, _UNLICENSE + _UNLICENSE_USE + _UNLICENSE_END, _spdx("Unlicense")],
    "WTFPL": [_WTFPL, _spdx("WTFPL")],
    "Zlib": [_ZLIB, _spdx("Zlib")],
}
#: Words that tell licences of one family apart: a passage has all the template's bigrams that have one.
_VERSION = re.compile(r"v?\d+(\.\d+)*|\d-clause|affero|lesser|by(-[a-z]{2})+|cc0")
#: The number of a list's item: after the end of a sentence, clause or line, before a full stop or bracket.  It tells no versions apart.
_ITEM = re.compile(r"(?:^|[.:;]\s|\n)\s*\(?(\d+)[.)]\s")
_WORD = re.compile(r"[^\W_]+(?:[.'/:-]+[^\W_]+)*")


def _bigrams(words: list[str]) -> list[tuple[str, str]]:
    return list(zip(words, words[1:], strict=False))


def normalised(text: str) -> list[tuple[str, int, int]]:
    """Words of *text* in lower case, British spelling made American, with where they begin and end."""
    low = text.lower()
    if len(low) != len(text):  # so that places stay those of the text
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    return [(m[0].replace("licence", "license"), m.start(), m.end()) for m in _WORD.finditer(low)]


def _needs(template: str) -> frozenset[tuple[str, str]]:
    """The bigrams of *template* with a version, a number of clauses or the like: those that its passages must have."""
    items = {m.start(1) for m in _ITEM.finditer(template)}
    words = normalised(template)
    marks = [bool(_VERSION.fullmatch(w)) and at not in items for w, at, _ in words]
    return frozenset(g for g, a, b in zip(_bigrams([w for w, _, _ in words]), marks, marks[1:], strict=False) if a or b)


class Scanner:
    """Finds in each text the passages that are like a template."""

    def __init__(self, templates: dict[str, list[str]] = TEMPLATES, least: float = LEAST):
        self.least = least
        self.templates = [(name, frozenset(_bigrams([w for w, _, _ in normalised(t)]))) for name, texts in sorted(templates.items()) for t in texts]
        self.needs = [_needs(t) for _, texts in sorted(templates.items()) for t in texts]
        self.of: dict[tuple[str, str], list[int]] = {}
        for i, (_, grams) in enumerate(self.templates):
            for g in grams:
                self.of.setdefault(g, []).append(i)

    def passages(self, text: str | None) -> list[tuple[str, float, int, int]]:
        """(licence, Dice coefficient, first character, character after) of the best passages.

        A passage is any run of words that has the template's bigrams with a version, a number of
        clauses or the like; its coefficient is that of its set of word bigrams and the
        template's.  Bounds on size prune: at *least* or more a passage has from
        least / (2 - least) to (2 - least) / least times the template's bigrams, so a template is
        looked at only if the text has that many of its bigrams, and a run is ended when it has
        too many.  Of runs with a coefficient the best begin and end with bigrams of the template
        that they have just once, since without another the set stays the same or loses what is
        none of the template; only those are tried, whatever their length.  So a run ends where
        its first bigram comes again, and all runs together take at most a step for each word and
        bigram of the template.  Of passages that overlap the better stays, then the longer.
        """
        if not text:
            return []
        words = normalised(text)
        grams = _bigrams([w for w, _, _ in words])
        hits: dict[int, list[int]] = {}
        for at, g in enumerate(grams):
            for i in self.of.get(g, ()):
                hits.setdefault(i, []).append(at)
        found: list[tuple[float, int, str, int, int]] = []
        for i, places in sorted(hits.items()):
            self._runs(i, places, grams, found)
        out: list[tuple[str, float, int, int]] = []
        begins: list[int] = []  # of the passages taken, in order, and their ends
        ends: list[int] = []
        for dice, _, name, begin, end in sorted(found):
            n = bisect.bisect_right(begins, end + 1)
            if not n or ends[n - 1] + 1 < begin:
                begins.insert(n, begin)
                ends.insert(n, end)
                out.append((name, -dice, words[begin][1], words[end + 1][2]))
        return sorted(out, key=lambda p: p[2])

    def _runs(self, i: int, places: list[int], grams: list[tuple[str, str]], found: list) -> None:
        """Adds to *found* the runs that are like template *i*, whose bigrams stand at *places*."""
        name, want = self.templates[i]
        needs = self.needs[i]
        here = {grams[p] for p in places}
        if len(here) < self.least / (2 - self.least) * len(want) - 1e-9 or not needs <= here:
            return
        most = (2 - self.least) / self.least * len(want) + 1e-9
        for n, begin in enumerate(places):
            first, seen, both, done = grams[begin], set(), 0, begin
            for end in places[n:]:
                last = grams[end]
                if end > begin and last == first:
                    break
                seen.update(grams[done:end])
                done = end
                if last in seen:
                    continue
                seen.add(last)
                both += 1
                if len(seen) > most:
                    break
                dice = 2 * both / (len(seen) + len(want))
                if dice >= self.least - 1e-12 and needs <= seen:
                    found.append((-dice, begin - end, name, begin, end))


def scan(documents: DataFrame, templates: dict[str, list[str]] = TEMPLATES, least: float = LEAST, text_col: str = "text", out_col: str = "licences") -> DataFrame:
    """Adds *out_col*: array of struct(licence, score, first, after) of every whole text; none for null and empty texts."""

    @F.pandas_udf("array<struct<licence: string, score: double, first: int, after: int>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = Scanner(templates, least)
        for batch in batches:
            yield pd.Series([[{"licence": n, "score": s, "first": a, "after": b} for n, s, a, b in scanner.passages(t)] for t in batch], index=batch.index, dtype=object)

    return documents.withColumn(out_col, run(F.col(text_col)))
