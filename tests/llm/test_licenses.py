import textwrap

from helpers import docs, odd_rows

from storyweave.llm import licenses
from storyweave.llm.licenses import _MIT


def test_whole_texts_and_lines(spark):
    spelt = "Copyright (c) 2020 Some One\n\n" + _MIT.upper().replace("SUBLICENSE", "sublicence").replace(",", " ;").replace(" ", "  ")
    rows = [
        (1, _MIT), (2, spelt), (3, _MIT + " but not for you"), (4, "Some words\nReleased under the MIT licence!\nlicensed under CC-BY-NC 4.0"), (5, "(C) a\n# Copyright b\nMIT License\n" + _MIT),
        (6, "Released under the MIT License. And so on"), (7, "Copyright only"), (8, "Licensed under the Apache Licence, version 2.0"), (9, "licence licence licence"),
    ]
    got = {r.doc_id: (r.licence, r.notices) for r in licenses.scan(docs(spark, rows)).collect()}
    assert got == {1: ("MIT", []), 2: ("MIT", []), 3: (None, []), 4: (None, ["CC-BY-NC-4.0", "MIT"]), 5: ("MIT", []), 6: (None, []), 7: (None, []),
                   8: ("Apache-2.0", ["Apache-2.0"]), 9: (None, [])}
    same = docs(spark, [(1, "licence licence licence"), (2, "License, license. LICENSE")])
    assert licenses.scan(same).select("digest").distinct().count() == 1


def test_odd_rows(spark):
    got = licenses.scan(docs(spark, odd_rows()))
    assert got.count() == len(odd_rows())
    by = {r.doc_id: r for r in got.collect()}
    assert by[3].digest is None and by[4].digest == by[5].digest and by[4].licence is None and by[4].notices == []
    assert licenses.scan(docs(spark, [])).count() == 0


def test_each_known_text_in_its_wrappings(spark):
    """Short texts wrapped at any width below statements of copyright, long ones as published; newlines of either kind."""
    heads = ["", "Copyright (c) 2020, Some One\nAll rights reserved.\n\n", "Copyright The Foo Authors\nCopyright Bar Inc.\n(c) 2019 Baz\n© Qux\n\n"]
    rows, want = [], {}
    for name, text in licenses.TEXTS:
        if len(text) < 5000:
            bodies = ["\n\n".join(textwrap.fill(part, width, break_on_hyphens=False) for part in text.split("\n\n")) for width in range(50, 100)]
        else:
            bodies = [text, textwrap.indent(text, "  "), textwrap.indent(text, " * ")]
        for i, body in enumerate(bodies):
            full = heads[i % 3] + body + "\n"
            rows.append((len(rows), full.replace("\n", "\r\n") if i % 2 else full))
            want[rows[-1][0]] = name
    got = {r.doc_id: r.licence for r in licenses.scan(docs(spark, rows)).collect()}
    assert got == want and {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "ISC", "BSD-3-Clause"} <= set(want.values())


def test_only_statements_are_copyright_lines(spark):
    stated = ["Copyright 2020", "copyright: 2020 x", "COPYRIGHT (C) ACME", "Copyright(c) b", " * Copyright © b", "# Copyright b", "Copyright by Notus", "Copyright Noticeable Things", "Copyright <year> <owner>",
              "(c) 2020", "(c) Jane van Doe", "(C) a", "© a", "All rights reserved.", "// ALL RIGHTS RESERVED", "Copyright The Foo Authors", "Copyright, 2020 x", "Copyright [yyyy] [name]"]
    prose = ["copyright notice and this permission notice appear in all copies.", "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM", "copyright holder's name", "copyright", "copyright, patent, and trademark", "copyrighted by them",
             "copyright the software, and", "COPYRIGHT OWNER OR CONTRIBUTORS", "(c) You must retain, in the Source form", "(c) under Patent Claims infringed", "all rights reserved to them", "copyright-like laws"]
    got = {r.doc_id: r.text for r in docs(spark, list(enumerate(stated + prose))).select("doc_id", licenses.canonical(licenses.F.col("text")).alias("text")).collect()}
    assert [x for i, x in enumerate(stated) if got[i]] == [] and [x for i, x in enumerate(prose, len(stated)) if not got[i]] == []
