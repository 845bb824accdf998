"""Licence notices by conditional compression.

A candidate block is the stretch of a text, over line breaks, round words that only licence notices use.  Each block is
compressed with zstandard on its own and with every template as a raw dictionary; templates are ranked by
the bytes they save.  In that order they are held against the block by word differences, and the first that fits
is the winner; of those that save as much within MARGIN bytes (versions of one notice), the wording decides.  What the
winners leave of the block is compressed and ranked anew, until no template fits, so every notice of a block is found.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from starloom.llm.common import WORD, id_text, slices
from starloom.llm.text_stats import words_in

#: Notices as they are commonly printed, and the paragraphs of short licences.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "MIT": "Released under the MIT License.",
    "MIT-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "Apache-2.0-body": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "Apache-2.0-title": "Apache License Version 2.0, January 2004",
    "MIT-licensed": "Licensed under the MIT License.",
    "MIT-title": "The MIT License (MIT)",
    "MIT-body": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "MIT-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "MIT-warranty": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "MIT-SPDX": "SPDX-License-Identifier: MIT",
    "MIT-or-Apache-2.0": "MIT/Apache-2.0",
    "MIT-or-Apache-2.0-SPDX": "MIT OR Apache-2.0",
    "Apache-2.0-SPDX": "SPDX-License-Identifier: Apache-2.0",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "GPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-2.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version.",
    "LGPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "AGPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "GPL-copy": "You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
    "GPL-3.0-title": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "GPL-2.0-title": "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    "GPL-verbatim": "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed.",
    "BSD-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "BSD-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "BSD-3-Clause-names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "BSD-warranty": "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "MPL-2.0-copy": "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "CC-BY-4.0-work": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0-work": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0-work": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "all-rights-reserved": "All rights reserved.",
    "MIT-Licensed": "MIT Licensed",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "BSL-1.0-title": "Boost Software License - Version 1.0 - August 17th, 2003",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
    "EPL-2.0-title": "Eclipse Public License - v 2.0",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "Apache-2.0-de": "Lizenziert unter der Apache-Lizenz, Version 2.0",
    "CC-BY-4.0-de": "Dieses Werk ist lizenziert unter einer Creative Commons Namensnennung 4.0 International Lizenz",
}
#: Identifiers of the public list, which stand behind a fixed tag; and short forms of GNU licences.
SPDX = "AGPL-3.0-only AGPL-3.0-or-later BSD-2-Clause BSD-3-Clause BSL-1.0 CC-BY-4.0 CC0-1.0 EPL-2.0 GPL-2.0 GPL-2.0-only GPL-2.0-or-later GPL-3.0 GPL-3.0-only GPL-3.0-or-later ISC LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only LGPL-3.0-or-later MPL-2.0 Unlicense Zlib".split()
GNU_FORMS = ("{g}v{n} or later", "GNU {g} v{n}", "GNU {g}v{n}", "GNU {g} version {n}", "licensed under the {g}v{n}", "licensed under {g}v{n}")
TEMPLATES |= {f"{k}-SPDX": f"SPDX-License-Identifier: {k}" for k in SPDX}
TEMPLATES |= {f"{g}-{n}.0-short-{i}": form.format(g=g, n=n) for g, n in (("GPL", 2), ("GPL", 3), ("LGPL", 3), ("AGPL", 3)) for i, form in enumerate(GNU_FORMS)}
#: Templates that save as many bytes as the best that fits, less these at most, are judged by their wording.
MARGIN = 16
CUES = re.compile(r"licen[sc]e|copyright|rights\W+reserved|permission\W+is\W+hereby|redistribution\W+and\W+use|creative\W+commons|\bCC\W+BY|(?-i:\bMIT\b)|\b[AL]?GPL|\bapache\b|\bmozilla\b|waived\W+all|unencumbered", re.I)
#: Each match of CUES holds one of these, or _cc, in lower case, or MIT in upper case, which are far quicker to look for.
HINTS = ("licen", "copyright", "rights", "permission", "redistribution", "commons", "gpl", "apache", "mozilla", "waived", "unencumbered")
_cc = re.compile(r"cc\W+by")
REACH = 24
MAX_EDIT_SHARE = 0.15

_edge = re.compile(r"^\W+|\W+$")
_letter = re.compile(r"\w").search


def normal(words: list[str]) -> list[str]:
    return [w for w in (_edge.sub("", x).lower() for x in words) if w]


def spots_of(text: str) -> list[tuple[int, int]]:
    """Where the words that normal() keeps stand in a text."""
    return [(m.start(), m.end()) for m in re.finditer(WORD, text) if _letter(m[0])]


def blocks_of(text: str, reach: int = REACH) -> list[tuple[str, list[int]]]:
    """(block, place of each of its words) of stretches within reach of a cue; cues close together share one.

    Only words that normal() keeps are counted, so the marks of comments at line starts take no reach.
    """
    marks = [(m.start(), m.end()) for m in CUES.finditer(text)]
    if not marks:
        return []
    spots = spots_of(text)
    runs: list[list[int]] = []
    k = 0
    for a, b in marks:
        while k < len(spots) and spots[k][1] <= a:
            k += 1
        e = k
        while e + 1 < len(spots) and spots[e + 1][0] < b:
            e += 1
        lo, hi = max(0, k - reach), min(len(spots) - 1, e + reach)
        if runs and lo <= runs[-1][1]:
            runs[-1][1] = max(hi, runs[-1][1])
        else:
            runs.append([lo, hi])
    return [(text[spots[lo][0] : spots[hi][1]], [x for x, _ in spots[lo : hi + 1]]) for lo, hi in runs]


def fits(template: list[str], block: list[str]) -> np.ndarray:
    """For each end in the block, 0 to its length: least word edits to a stretch that ends there << 32 | its first word."""
    number: dict[str, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in block], dtype=np.int64)
    at = np.arange(len(block) + 1, dtype=np.int64)
    row, step = at, at << 32
    for t in template:
        new = row + (1 << 32)
        np.minimum(new[1:], row[:-1] + ((ids != number.get(t, -1)).astype(np.int64) << 32), out=new[1:])
        row = np.minimum.accumulate(new - step) + step
    return row


def best_fit(template: list[str], block: list[str]) -> tuple[int, int, int]:
    """Least word edits between the template and any stretch of the block, and that stretch."""
    row = fits(template, block).tolist()
    return min(((x >> 32, x & 0xFFFFFFFF, j) for j, x in enumerate(row)), key=lambda x: (x[0], x[2] - x[1]))


class Scanner:
    """Compressors primed with each template, and the templates' words."""

    def __init__(self, templates: dict[str, str], level: int = 9):
        import zstandard as z

        own = z.ZstdCompressionParameters.from_level(level, write_checksum=0, write_content_size=0, write_dict_id=0)
        self.bare = z.ZstdCompressor(compression_params=own)
        self.primed = {k: z.ZstdCompressor(dict_data=z.ZstdCompressionDict(t.encode(), dict_type=z.DICT_TYPE_RAWCONTENT), compression_params=own) for k, t in templates.items()}
        self.words = {k: normal(words_in(t)) for k, t in templates.items()}
        # a template with its edits lies in the block whichever of its words is the cue
        self.reach = max(REACH, *(len(ws) + int(MAX_EDIT_SHARE * len(ws)) for ws in self.words.values()))
        self.counts = {k: Counter(ws) for k, ws in self.words.items()}
        self.most = {k: int(MAX_EDIT_SHARE * len(ws)) for k, ws in self.words.items()}

    def rank(self, block: str) -> list[tuple[int, str]]:
        """(bytes saved, template), most first; equal savings in order of name."""
        raw = block.encode()
        alone = len(self.bare.compress(raw))
        return sorted(((alone - len(c.compress(raw)), k) for k, c in self.primed.items()), key=lambda x: (-x[0], x[1]))

    def within(self, k: str, part: list[str], have: Counter) -> list[tuple[int, int, int]]:
        """(word edits, first word, end) of all stretches of a part that a template fits."""
        most = self.most[k]
        if sum((self.counts[k] - have).values()) > most:  # each word that the part lacks is an edit
            return []
        row = fits(self.words[k], part)
        return [(int(row[b]) >> 32, int(row[b]) & 0xFFFFFFFF, b) for b in np.flatnonzero(row >> 32 <= most).tolist()]

    def confirmed(self, block: str, spots: list[tuple[int, int]], words: list[str]) -> list[tuple[int, int, str, int, int]]:
        """(first word, end, template, word edits, bytes saved) of notices that do not overlap, in order.

        Of a stretch, the templates are tried in order of bytes saved until one fits; with it compete those that save as much within
        MARGIN, and go by the words they keep, then by fewer edits, then by bytes saved.  All that they fit is taken at once.
        """
        found, gaps = [], [(0, len(words))]
        while gaps:
            lo, hi = gaps.pop()
            part = words[lo:hi]
            have, tried, floor = Counter(part), [], None
            if not any(sum((own - have).values()) <= self.most[k] for k, own in self.counts.items()):
                continue  # each template lacks more words here than there may be edits
            for saved, k in self.rank(block[spots[lo][0] : spots[hi - 1][1]]):
                if floor is not None and saved < floor:
                    break
                for edits, a, b in self.within(k, part, have):
                    floor = saved - MARGIN if floor is None else floor
                    tried.append((edits - len(self.words[k]), edits, -saved, k, b - a, lo + a, lo + b))
            taken: list[tuple[int, int]] = []
            for _, edits, saved, k, _, a, b in sorted(tried):
                if all(b <= x or a >= y for x, y in taken):
                    taken.append((a, b))
                    found.append((a, b, k, edits, -saved))
            if taken:
                taken.sort()
                gaps += [(x, y) for x, y in zip([lo, *(b for _, b in taken)], [*(a for a, _ in taken), hi], strict=True) if x < y]
        return sorted(found)

    def judge(self, block: str) -> list[tuple[int, str, int, int, list[str], bool]]:
        """(first word, template, bytes saved, word edits, differing words, confirmed) for each notice of a block, and for each stretch that they leave and that holds a cue."""
        spots = spots_of(block)
        words = normal([block[a:b] for a, b in spots])
        found = [(a, a, b, k, edits, saved, True) for a, b, k, edits, saved in self.confirmed(block, spots, words)]
        for lo, hi in zip([0, *(x[2] for x in found)], [*(x[1] for x in found), len(words)], strict=True):
            rest = block[spots[lo][0] : spots[hi - 1][1]] if lo < hi else ""
            cue = CUES.search(rest)
            if cue:
                gain, k = self.rank(rest)[0]
                edits, a, b = best_fit(self.words[k], words[lo:hi])
                first = next(i for i in range(lo, hi) if spots[i][1] > spots[lo][0] + cue.start())
                found.append((first, lo + a, lo + b, k, edits, gain, False))
        found.sort()
        out = []
        for first, a, b, k, edits, gain, good in found:
            differ = [f"-{w}" for w in self.words[k] if w not in words[a:b]] + [f"+{w}" for w in words[a:b] if w not in self.words[k]]
            out.append((first, k, gain, edits, differ, good))
        return out


def scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """doc_id, line, block, license, bytes_saved, n_edits, differences, confirmed: one row for each notice.

    block counts the blocks of a text from 0; a block has a row for each template that is confirmed, and one for each
    stretch before, between and after those that holds a cue, whose license is the one that saves most bytes.  line is that of
    the notice's first word, or of the stretch's first cue, among the text's \\n-split lines from 0.  Null, empty and licence-free texts give no rows;
    repeated rows repeat theirs.  Ties of savings go by template name.  Texts are read whole whatever their length.
    """
    own_templates = TEMPLATES if templates is None else templates

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Scanner(own_templates)
        judged: dict[str, list[tuple]] = {}
        for batch in slices(batches):
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                low = text.lower()
                if not any(h in low for h in HINTS) and "MIT" not in text and not _cc.search(low):
                    continue
                for j, (block, places) in enumerate(blocks_of(text, own.reach)):
                    if block not in judged:
                        if len(judged) > 50_000:
                            judged.clear()
                        judged[block] = own.judge(block)
                    rows.extend((doc, text.count("\n", 0, places[first]), j, *found) for first, *found in judged[block])
            if rows:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.bool_()), strict=True)], names=["doc_id", "line", "block", "license", "bytes_saved", "n_edits", "differences", "confirmed"])

    return id_text(docs).mapInArrow(run, "doc_id long, line int, block int, license string, bytes_saved long, n_edits long, differences array<string>, confirmed boolean")
