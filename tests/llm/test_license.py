import random

from starloom.llm import license_scan as scan

SCHEMA = "doc_id long, text string, license string"


def test_notices_are_found_and_confirmed(spark):
    rows = [(i, "some words here\n" + t + "\nmore of them", "x") for i, t in enumerate(scan.TEMPLATES.values())]
    rows += [(100, "no cue at all", "x"), (101, None, "x"), (102, "", "x"), (103, "a licence to fish in any of these rivers", "x"), (104, "zz " * 5000 + "All rights reserved. " + "yy " * 5000, "x")]
    rows += [(105, "This work is licensed under the GNU General Public Licence, version 3.", "x")] * 2
    got = {(r.doc_id, r.line): r for r in scan.scan(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    for i, k in enumerate(scan.TEMPLATES):
        assert got[i, 1].license == k and got[i, 1].confirmed and got[i, 1].n_edits == 0, k
    assert not got[103, 0].confirmed
    assert got[104, 0].license == "all-rights-reserved" and got[104, 0].confirmed
    assert got[105, 0].license == "GPL-3.0" and got[105, 0].differences == ["-license", "+licence"]
    assert {d for d, _ in got} & {100, 101, 102} == set()
    assert scan.scan(spark.createDataFrame([], SCHEMA)).count() == 0


def test_ranking_is_by_bytes_saved_over_all_templates():
    own = scan.Scanner(scan.TEMPLATES)
    ranked = own.rank("Licensed under CC BY-NC 4.0.")
    assert len(ranked) == len(scan.TEMPLATES) and ranked == sorted(ranked, key=lambda x: (-x[0], x[1]))
    assert scan.best_fit(["a", "b", "c"], ["x", "a", "q", "c", "y"]) == (1, 1, 4)


def found(spark, texts, templates=None):
    rows = scan.scan(spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], SCHEMA).repartition(2), templates).collect()
    return [sorted((r.line, r.license) for r in rows if r.doc_id == i and r.confirmed) for i in range(len(texts))]


def test_each_notice_of_a_block_is_returned(spark):
    texts = [
        "Licensed under the Apache License, Version 2.0. All rights reserved.",
        "Dual: Released under the MIT License. or Licensed under the Apache License, Version 2.0. and again Released under the MIT Licence.. Licensed under CC BY 4.0. All rights reserved.",
    ]
    assert found(spark, texts) == [
        [(0, "Apache-2.0"), (0, "all-rights-reserved")],
        [(0, "Apache-2.0"), (0, "CC-BY-4.0"), (0, "MIT"), (0, "all-rights-reserved")],
    ]
    # six templates that save more than the right one, none of which fits
    long = {f"bad-{i}": "the copyright of each of these works by many hands stays for ever with those who made it " + f"z{i} y{i} x{i} w{i}" for i in range(6)}
    text = "Copyright stays. the copyright of each of these works by many hands stays for ever with those who made it"
    assert found(spark, [text], {**long, "right": "Copyright stays."}) == [[(0, "right")]]


def test_wrapped_notices_are_found_at_their_first_line(spark):
    import textwrap

    names = ["MIT-permission", "BSD-3-Clause", "Apache-2.0-header", "CC0-1.0"]
    texts, want = [], []
    for k in names:
        for width, mark in ((70, ""), (40, "# "), (24, " * ")):
            lines = [mark + x for x in textwrap.wrap(scan.TEMPLATES[k], width)]
            assert len(lines) > 1
            texts.append("\n".join(["some prose before it", "", *lines, "", "and after", "All rights reserved."]))
            want.append([(2, k), (2 + len(lines) + 2, "all-rights-reserved")])
    texts += ["a\nAll rights\n# reserved.\nb", "a\nunder CC\n# BY 4.0 Licensed\nunder CC\n# BY 4.0."]
    assert found(spark, texts) == [*want, [(1, "all-rights-reserved")], [(2, "CC-BY-4.0")]]
    # one that is not confirmed stands at its cue
    rows = scan.scan(spark.createDataFrame([(0, "one\ntwo\nthree licence four\nfive", "x")], SCHEMA)).collect()
    assert [(r.line, r.block, r.confirmed) for r in rows] == [(2, 0, False)]
    rows = scan.scan(spark.createDataFrame([(0, "one licence two\nAll rights reserved.\n\nthree copyright four", "x")], SCHEMA)).collect()
    assert [(r.line, r.confirmed) for r in rows] == [(0, False), (1, True), (3, False)]


def test_apache_mozilla_and_upper_case_mit_are_cues_and_bodies_are_known(spark):
    texts = [
        "Ours is dual MIT/Apache-2.0 as is usual",
        "This Source Code Form is subject to the terms of the Mozilla Public Lisence, v. 2.0.",
        "wir gehen mit ihr und Mit ihm",
        "\n".join(scan.TEMPLATES[k] for k in ("MIT-body", "MIT-notice", "MIT-warranty")),
        "\n".join(scan.TEMPLATES[k] for k in ("GPL-2.0-notice", "GPL-warranty", "GPL-copy")),
    ]
    assert found(spark, texts) == [
        [(0, "MIT-or-Apache-2.0")], [(0, "MPL-2.0")], [],
        [(0, "MIT-body"), (1, "MIT-notice"), (2, "MIT-warranty")], [(0, "GPL-2.0-notice"), (1, "GPL-warranty"), (2, "GPL-copy")],
    ]
    assert scan.blocks_of(texts[2]) == []


def test_nothing_that_fits_is_left_over():
    """Brute force over all templates: what a scan leaves of a block has no template within its edits, and each notice has the template of fewest edits."""
    own, rnd = scan.Scanner(scan.TEMPLATES), random.Random(7)
    names = list(scan.TEMPLATES)
    for _ in range(60):
        parts = []
        for k in rnd.sample(names, rnd.randint(1, 4)):
            ws = scan.TEMPLATES[k].split()
            if len(ws) > 12:
                ws[rnd.randrange(len(ws))] = "altered"
            parts += [" ".join(ws), " ".join(rnd.choice(["licence", "lorem", "ipsum", "version", "the"]) for _ in range(rnd.randint(0, 6)))]
        block = "\n".join(parts)
        spots = scan.spots_of(block)
        words = scan.normal([block[a:b] for a, b in spots])
        found = own.confirmed(block, spots, words)
        ends = [0, *(b for _, b, *_ in found)], [*(a for a, *_ in found), len(words)]
        for lo, hi in zip(*ends, strict=True):
            assert lo <= hi
            for k, ws in own.words.items():
                assert scan.best_fit(ws, words[lo:hi])[0] > own.most[k], (k, words[lo:hi])
        for a, b, k, edits, _ in found:
            assert scan.best_fit(own.words[k], words[a:b])[0] == edits <= own.most[k]
            same = [o for o, ws in own.words.items() if len(ws) == len(own.words[k]) and scan.best_fit(ws, words[a:b])[0] < edits]
            assert not same, (k, same)


def test_usual_wordings_are_named():
    own = scan.Scanner(scan.TEMPLATES)
    texts = {
        "This code is licensed under GPLv3 or later": "GPL-3.0", "SPDX-License-Identifier: BSD-3-Clause": "BSD-3-Clause", "Distributed under the Boost Software License, Version 1.0": "BSL-1.0", "MIT Licensed": "MIT", "under GNU GPL v2 by its author": "GPL-2.0",
        "made available under the terms of the Eclipse Public License 2.0 This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0": "EPL-2.0", "This is free and unencumbered software released into the public domain.": "Unlicense", "Lizenziert unter der Apache-Lizenz, Version 2.0": "Apache-2.0",
        "SPDX-License-Identifier: GPL-2.0-or-later": "GPL-2.0", "the GNU Affero licence: GNU AGPLv3": "AGPL-3.0",
    }
    for text, name in texts.items():
        got = [k for j, (block, _) in enumerate(scan.blocks_of(text, own.reach)) for _, k, _, _, _, good in own.judge(block) if good]
        assert got and all(k.startswith(name) for k in got), (text, got)
