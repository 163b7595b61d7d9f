import duckdb
import pytest
from pyspark.sql import functions as F

from typeferry.llm import licenses
from typeferry.llm.queries import op6_licenses

MIT = [licenses.SENTENCES[s] for s in ("mit-grant", "mit-notice", "mit-warranty")]
BSD = [licenses.SENTENCES[s] for s in ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorsement")]


def wrapped(text, width=60):
    lines, line = [], ""
    for word in text.split():
        if len(line) + len(word) > width:
            lines.append(line)
            line = ""
        line = f"{line} {word}".strip()
    return "\n".join([*lines, line])


TEXTS = [
    (1, None),
    (2, ""),
    (3, "Some prose. Released under the MIT License. More prose."),
    (4, "Licensed under CC BY-NC 4.0."),
    (5, wrapped("Copyright (c) someone.") + "\n\n" + "\n\n".join(map(wrapped, MIT))),
    (6, " ".join(reversed(MIT))),
    (7, BSD[0] + "\n\n1. " + wrapped(BSD[1]) + "\n\n2. " + wrapped(BSD[2])),
    (8, BSD[0] + "\n\n1. " + BSD[1] + "\n\n2. " + BSD[2] + "\n\n3. " + BSD[3]),
    (9, "The license of this book is not known. We warrant nothing."),
    (None, "All rights reserved.\nSPDX-License-Identifier: Apache-2.0\n"),
    (11, "x\nThis work is licensed under the GNU General Public License, version 3.\ny " * 9000),
    (12, "a table | b\nReleased under the MIT License\nc | d"),
    (12, "a table | b\nReleased under the MIT License\nc | d"),
]
EXPECTED = [
    (3, "MIT"), (4, "CC-BY-NC-4.0"), (5, "MIT"), (7, "BSD-2-Clause"), (8, "BSD-3-Clause"),
    (None, "Apache-2.0"), (None, "LicenseRef-all-rights-reserved"), (11, "GPL-3.0-only"),
    (12, "MIT"), (12, "MIT"),
]


@pytest.fixture
def odd(spark):
    frame = spark.createDataFrame(TEXTS, "doc_id long, text string")
    return frame.select("*", F.lit("x").alias("lines"), F.lit(1).alias("n_known"))


def test_rules(spark, odd):
    found = sorted((str(r.doc_id), r.license) for r in licenses.scan(odd).collect())
    assert found == sorted((str(i), name) for i, name in EXPECTED)
    assert licenses.scan(odd.limit(0)).count() == 0


def test_sql_says_the_same(spark, odd, tmp_path):
    odd.select("doc_id", "text").write.parquet(str(tmp_path / "d"))
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    got = sorted(map(str, map(tuple, licenses.scan(odd).collect())))
    assert got == sorted(map(str, duck.execute(licenses.oracle()).fetchall()))


def test_each_rule_has_a_sentence_with_a_cue():
    ids = {}
    for sentence, name in licenses.known_sentences().items():
        ids.setdefault(name, []).append(sentence)
    patterns = set(licenses.PATTERNS)
    assert all(s in patterns or s in ids for r in licenses.rules() for s in r.sentences + r.unless)
    for rule in licenses.rules():
        assert any(
            all(any(cue in x for cue in licenses.CUES) for x in ids.get(name, [licenses.PATTERNS.get(name, "")]))
            for name in rule.sentences
        )


def test_no_python_in_the_plan(spark):
    frame = op6_licenses(spark, "/root/testdata/sf0.001")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_each_rule_finds_its_own_text(spark):
    """The texts as the table has them, in order: one after another, and wrapped."""
    rows, expected = [], set()
    own = licenses.SENTENCES
    by_table = [r for r in licenses.TEXT_RULES if all(x in own for x in r.sentences)]
    tables = [(r.name, [own[x] for x in r.sentences]) for r in by_table]
    for spdx, names in licenses.NAMES.items():
        tables += [(f"notice-{spdx}".lower(), [f"{licenses.OPENINGS[0]} under the {n}."]) for n in names]
        tables.append((f"tag-{spdx}".lower(), [f"SPDX-License-Identifier: {spdx}"]))
    for rule, texts in tables:
        forms = ["\n".join(texts), " ".join(texts), "\n\n".join(map(wrapped, texts))]
        forms += ["Before this.\n\n" + wrapped(" ".join(texts), 40) + "\n\nAfter this."]
        for form in forms:
            expected.add((len(rows), rule))
            rows.append((len(rows), form))
    for spdx, written in licenses.TAGS.items():
        tables += [(f"tag-{spdx}".lower(), [f"SPDX-License-Identifier: {x}"]) for x in written]
    by_pattern = {r.name for r in licenses.TEXT_RULES} - {r.name for r in by_table}
    assert {r.name for r in licenses.rules()} == {rule for rule, _ in tables} | by_pattern
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {(r.doc_id, r.rule) for r in licenses.scan(docs).collect()} >= expected


# Headers as they stand in files, and what they are: written by hand, not from the table.
MIT_TEXT = """Copyright (c) 2020 Jo Doe
Copyright (c) 2021-2022 The Widget Authors

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS BE LIABLE."""
BSD_TEXT = """Copyright 2019 Acme, Inc.
Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
{third}
THIS SOFTWARE IS PROVIDED."""
ACME = """3. Neither the name of Acme, Inc. nor the names of its contributors may be used
   to endorse or promote products derived from this software without specific
   prior written permission.
"""
AUTHOR = """3. The name of the author may not be used to endorse or promote products derived
   from this software without specific prior written permission.
"""
GNU = """{name} is free software{mark} you can redistribute it and/or modify
it under the terms of the GNU {kind}General Public License as published by
the Free Software Foundation{comma} either version {version} of the License, or
(at your option) any later version.

{name} is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""


def gnu(name, kind, version, mark=":"):
    return GNU.format(name=name, kind=kind, version=version, mark=mark, comma=";" if mark == ";" else ",")


HEADERS = [
    (MIT_TEXT, {"MIT"}),
    (BSD_TEXT.format(third=""), {"BSD-2-Clause"}),
    (BSD_TEXT.format(third=ACME), {"BSD-3-Clause"}),
    (BSD_TEXT.format(third=AUTHOR), {"BSD-3-Clause"}),
    (gnu("This program", "", "2", ";"), {"GPL-2.0-or-later"}),
    (gnu("This program", "", "3"), {"GPL-3.0-or-later"}),
    (gnu("Widget", "", "3"), {"GPL-3.0-or-later"}),
    (gnu("This library", "Lesser ", "2.1", ";"), {"LGPL-2.1-or-later"}),
    (gnu("This library", "Lesser ", "3"), {"LGPL-3.0-or-later"}),
    (gnu("This program", "Affero ", "3"), {"AGPL-3.0-or-later"}),
    ("This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy",
     {"MPL-2.0"}),
    ("SPDX-License-Identifier: GPL-3.0-or-later", {"GPL-3.0-or-later"}),
    ("SPDX-License-Identifier: GPL-2.0+", {"GPL-2.0-or-later"}),
    ("SPDX-License-Identifier: GPL-2.0 WITH Linux-syscall-note", {"GPL-2.0-only"}),
    ("SPDX-License-Identifier: MIT OR Apache-2.0", {"MIT", "Apache-2.0"}),
    ("SPDX-License-Identifier: (MIT AND BSD-3-Clause) OR ISC", {"MIT", "BSD-3-Clause", "ISC"}),
]
COMMENTS = {
    "plain": str,
    "block": lambda t: "/*\n" + "".join(f" * {x}".rstrip() + "\n" for x in t.split("\n")) + " */\nint x;",
    "hash": lambda t: "#!/bin/sh\n" + "".join(f"# {x}".rstrip() + "\n" for x in t.split("\n")) + "exit",
    "slashes": lambda t: "".join(f"// {x}".rstrip() + "\n" for x in t.split("\n")) + "\nvar x",
    "dashes": lambda t: "".join(f"-- {x}".rstrip() + "\n" for x in t.split("\n")) + "\nselect 1",
    "html": lambda t: f"<!--\n{t}\n-->\n<p>",
}


def test_headers_in_comments(spark, tmp_path):
    cases = [(text, style, found) for text, found in HEADERS for style in COMMENTS]
    rows = [(i, COMMENTS[style](text)) for i, (text, style, _) in enumerate(cases)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = licenses.scan(docs).collect()
    for i, (text, style, expected) in enumerate(cases):
        assert {r.license for r in got if r.doc_id == i} == expected, (style, text)
    docs.write.parquet(str(tmp_path / "d"))
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, duck.execute(licenses.oracle()).fetchall()))


def test_gpl_3_and_mpl_in_sql_too(spark, tmp_path):
    names = ("gpl3-later", "gpl-warranty", "mpl-header")
    texts = [" ".join(licenses.SENTENCES[n] for n in names), licenses.SENTENCES["mpl-header"]]
    docs = spark.createDataFrame(
        [(i, form(t)) for i, t in enumerate(texts) for form in (str, wrapped)],
        "doc_id long, text string",
    )
    docs.write.parquet(str(tmp_path / "d"))
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    got = sorted(map(str, map(tuple, licenses.scan(docs).collect())))
    assert got == sorted(map(str, duck.execute(licenses.oracle()).fetchall()))
    assert [r.count("GPL-3.0-or-later") for r in got].count(1) == 2
