"""License scans: canonical forms, whole texts, notices in lines, odd rows."""

import hashlib

from strata.llm import licenses as L

from .helpers import frame


def _digests(spark, *texts):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    return [r.digest for r in L.with_digest(df, "t").orderBy("k").collect()]


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_canonical_forms(spark):
    a, b, c, d = _digests(spark, "Copyright (c) 2020 Me\nLicence: see https://x.org, v2.0!",
                        "# Copyright 1999 You and others.\nLICENSE\n see  x org 'version 2.0'",
                        "Licensed under the Apache License, v2.0", "(C) 2020, nobody")
    assert a == b == _sha("license see x org version 2 0")
    assert c == _sha("licensed under the apache license version 2 0")
    assert d == _sha("")


def test_every_spelling_has_a_sign(spark):
    """Texts that a rule changes are never taken for texts without a sign."""
    samples = {"Licenced": "licensed", "sub-licence": "sublicense", "sub license": "sublicense",
               "Non-Commercial": "noncommercial", "non-infringement": "noninfringement",
               "merchantibility": "merchantability", "of copyright owners": "of copyright holder",
               "http://www.a.b": "a b", "https://c": "c", "organisations": "organizations",
               "favourable": "favorable", "acknowledgement": "acknowledgment",
               "5 per cent": "5 percent", "x (c) y": "x copyright y", "x © y": "x copyright y",
               "this project is it": "it", "THE FILE IS here": "here", "V2 of v3": "version 2 of version 3",
               "a\n * all rights reserved\nb": "a b", "Plain; text!": "plain text"}
    assert _digests(spark, *samples) == [_sha(x) for x in samples.values()]


def test_texts_and_lines(spark):
    mit = "Copyright (c) 2024 Somebody\n\n" + L.MIT_GRANT.upper().replace("\n", " \n  ")
    rows = [(1, mit), (2, "some prose\nReleased under the MIT Licence!\nmore"), (3, None), (4, ""),
            (5, "Licensed under CC BY-NC 4.0."), (5, "Licensed under CC BY-NC 4.0."),
            (None, "SPDX-License-Identifier: ISC"), (6, "MIT License\n\n" + L.MIT_GRANT + " maybe"),
            (7, "prose " * 50_000 + "\nThis work is licensed under the GNU General Public License,"
                                    " version 3.")]
    df = frame(spark, rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.line_no, r.license) for r in L.scan(df, "doc_id", "text").collect()),
                 key=str)
    assert got == sorted([(1, 0, "MIT"), (2, 0, None), (2, 2, "MIT"), (3, 0, None), (4, 0, None),
                          (5, 0, "CC-BY-NC-4.0"), (5, 0, "CC-BY-NC-4.0"), (5, 1, "CC-BY-NC-4.0"),
                          (5, 1, "CC-BY-NC-4.0"), (None, 0, "ISC"), (None, 1, "ISC"), (6, 0, None),
                          (7, 0, None), (7, 2, "GPL-3.0")], key=str)
    assert L.scan(df.where("doc_id < 0"), "doc_id", "text").count() == 0


def test_whole_licenses_and_headers(spark):
    rows = [(k, name, L.FOLDER.joinpath(f"{name}.txt").read_text()) for k, name in enumerate(
        ("Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-3.0", "MPL-2.0", "CC0-1.0"))]
    gpl = rows[2][2]
    header = gpl[gpl.index("    This program is free"):gpl.index("Also add information on how")]
    rows += [(10, "GPL-3.0", header), (11, "GPL-3.0", gpl.partition("How to Apply")[0]),
             (12, "AGPL-3.0", header.replace("GNU General", "GNU Affero General")),
             (13, "Apache-2.0", rows[0][2].partition("owner]")[2]), (14, "Unlicense", L.UNLICENSE),
             (15, None, gpl + " and more")]
    df = frame(spark, [(k, t) for k, _, t in rows], "doc_id long, text string")
    got = {r.doc_id: r.license for r in L.scan(df, "doc_id", "text").where("line_no = 0").collect()}
    assert got == {k: name for k, name, _ in rows}


def test_known_digests_are_few_and_unique(spark):
    known = L.known_digests(spark)
    assert known.count() == known.select("digest").distinct().count() < 400


def test_no_row_is_shuffled(spark):
    df = frame(spark, [(1, "a")], "doc_id long, text string")
    plan = L.scan(df, "doc_id", "text")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def _wrapped(text, width, mark=""):
    import textwrap

    parts = [" ".join(p.split()) for p in text.split("\n\n")]
    lines = "\n\n".join(textwrap.fill(p, width, break_long_words=False) for p in parts)
    return "\n".join(mark + x for x in lines.split("\n"))


def test_line_breaks_do_not_matter(spark):
    """Every known text at many widths, with comment marks and copyright lines above it."""
    heads = ["", "Copyright (c) 2020 Somebody\n\n", "Portions Copyright 2019, 2021 X and Y.\n"
             "Copyright (C) 2020 Z <z@z.org>. All rights reserved.\n\n", "© 2020 Some GmbH\n\n",
             "Copyright Somebody Else\n\n"]
    rows, want = [], {}
    for n, (license, text) in enumerate(L.known_texts()):
        long = len(text) > 5000
        for width in (range(40, 121, 20) if long else range(40, 121, 7)):
            for mark in ("", "# ", " * "):
                head = heads[(n + width) % len(heads)]
                if head and not (license in ("MIT", "ISC", "0BSD") or license.startswith("BSD")):
                    head = heads[1]
                lines = head + _wrapped(text, width)
                rows.append((len(rows), "\n".join(mark + x for x in lines.split("\n"))))
                want[len(rows) - 1] = license, width, mark, head, text[:40]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    known = L.known_digests(spark)
    got = {r.doc_id: r.license for r in L.with_digest(df, "text").join(known, "digest", "left").collect()}
    wrong = [want[k] for k in want if got[k] != want[k][0]]
    assert not wrong, (len(wrong), len(want), wrong[:6])
