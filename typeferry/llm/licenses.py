"""License scans by sentence rules, in column expressions alone.

A text is cut into sentences, each is normalised to lower-case ASCII words, and those that are
known become identifiers. The identifiers of a text, in order, are then matched with rules:
a license is found where all identifiers of one of its rules come in the rule's order, other
sentences between them or not, and none of those that would make it another license.

First what stands around a license is put aside: the marks of comments before lines (so that
a line with nothing else is empty), copyright lines, which end where they end, and SPDX
expressions, of which each identifier gets a tag of its own. Sentences that name a holder or a
program are known by a pattern with room for the name.

Texts are read twice: by lines, each line a sentence or several; and as running text, where a
single line break is a space, for licenses that are wrapped. Texts without any of the ``CUES``
are passed over: every rule has a sentence with one (a test holds the table to that).

All work is a projection of each row: nothing is shuffled, so neither sources nor copies can
be heavy, and a row costs what its text costs.

Nulls and the like: null and empty texts have no license and give no rows; each row of the
table gives its own rows, rows with a null ``doc_id`` with a null id; an empty table gives
none; other columns are not looked at.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# SPDX identifiers, names that notices use, and sentences of the licenses.
NAMES = {
    "MIT": ("MIT License", "MIT license terms", "terms of the MIT License"),
    "Apache-2.0": (
        "Apache License, Version 2.0",
        "Apache License 2.0",
        "Apache 2.0 License",
        "terms of the Apache License, Version 2.0",
    ),
    "GPL-2.0-only": (
        "GNU General Public License, version 2",
        "GNU General Public License v2.0",
        "terms of the GNU General Public License, version 2",
        "GPLv2 License",
    ),
    "GPL-3.0-only": (
        "GNU General Public License, version 3",
        "GNU General Public License v3.0",
        "terms of the GNU General Public License, version 3",
        "GPLv3 License",
    ),
    "LGPL-3.0-only": ("GNU Lesser General Public License, version 3", "LGPLv3 License"),
    "AGPL-3.0-only": ("GNU Affero General Public License, version 3", "AGPLv3 License"),
    "BSD-2-Clause": ("BSD 2-Clause License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "New BSD License", "Modified BSD License"),
    "MPL-2.0": ("Mozilla Public License, version 2.0", "Mozilla Public License 2.0"),
    "ISC": ("ISC License",),
    "Unlicense": ("Unlicense",),
    "CC0-1.0": ("CC0 1.0", "CC0 1.0 Universal license"),
    "CC-BY-4.0": (
        "CC BY 4.0",
        "Creative Commons Attribution 4.0 International License",
    ),
    "CC-BY-SA-4.0": (
        "CC BY-SA 4.0",
        "Creative Commons Attribution-ShareAlike 4.0 International License",
    ),
    "CC-BY-NC-4.0": (
        "CC BY-NC 4.0",
        "Creative Commons Attribution-NonCommercial 4.0 International License",
    ),
    "CC-BY-ND-4.0": (
        "CC BY-ND 4.0",
        "Creative Commons Attribution-NoDerivatives 4.0 International License",
    ),
}
# Identifiers that stand in tags alone, by what they are written as.
TAGS = {
    "GPL-2.0-only": ("GPL-2.0",),
    "GPL-3.0-only": ("GPL-3.0",),
    "LGPL-3.0-only": ("LGPL-3.0",),
    "AGPL-3.0-only": ("AGPL-3.0",),
    "GPL-2.0-or-later": ("GPL-2.0-or-later", "GPL-2.0+"),
    "GPL-3.0-or-later": ("GPL-3.0-or-later", "GPL-3.0+"),
    "LGPL-2.1-only": ("LGPL-2.1-only", "LGPL-2.1"),
    "LGPL-2.1-or-later": ("LGPL-2.1-or-later", "LGPL-2.1+"),
    "LGPL-3.0-or-later": ("LGPL-3.0-or-later", "LGPL-3.0+"),
    "AGPL-3.0-or-later": ("AGPL-3.0-or-later", "AGPL-3.0+"),
}
OPENINGS = (
    "Licensed", "Released", "Distributed", "Published", "This work is licensed",
    "This work is released", "This project is licensed", "This software is licensed",
    "This software is released", "This software is distributed", "This program is licensed",
    "This file is licensed", "This document is licensed", "This code is licensed",
    "The source code is licensed",
)
SENTENCES = {
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions:"
    ),
    "mit-notice": (
        "The above copyright notice and this permission notice shall be included in all copies "
        "or substantial portions of the Software."
    ),
    "mit-warranty": (
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, "
        "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
        "PARTICULAR PURPOSE AND NONINFRINGEMENT."
    ),
    "apache-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License."
    ),
    "apache-warranty": (
        "Unless required by applicable law or agreed to in writing, software distributed under "
        "the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF "
        "ANY KIND, either express or implied."
    ),
    "apache-details": (
        "See the License for the specific language governing permissions and limitations under "
        "the License."
    ),
    "bsd-grant": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met:"
    ),
    "bsd-source": (
        "Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer."
    ),
    "bsd-binary": (
        "Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials "
        "provided with the distribution."
    ),
    "bsd-endorsement": (
        "Neither the name of the copyright holder nor the names of its contributors may be used "
        "to endorse or promote products derived from this software without specific prior "
        "written permission."
    ),
    "isc-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with "
        "or without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies."
    ),
    "isc-warranty": (
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD "
        "TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."
    ),
    "gpl2-later": (
        "This program is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation; either "
        "version 2 of the License, or (at your option) any later version."
    ),
    "gpl3-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version."
    ),
    "gpl-warranty": (
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        "PARTICULAR PURPOSE."
    ),
    "gpl-details": "See the GNU General Public License for more details.",
    "mpl-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."
    ),
    "unlicense-domain": (
        "This is free and unencumbered software released into the public domain."
    ),
    "unlicense-grant": (
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this "
        "software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means."
    ),
    "reserved": "All rights reserved.",
}


# Normalised sentences with a name in them, as patterns; room for one is ``[a-z0-9 ]{1,120}``.
_FREE = ("^([a-z0-9 ]{1,120} is free software )?you can redistribute it and or modify it under the "
         "terms of the gnu %sgeneral public license as published by the free software foundation "
         "either version %s of the license or at your option any later version$")  # fmt: skip
PATTERNS = {
    "bsd-endorsement": (
        "^neither the names? of [a-z0-9 ]{1,120} n?or the names of (its|their|any|the) contributors "
        "may be used to endorse or promote products derived from this software without "
        "(specific )?(prior )?written permission$"
    ),
    "bsd-endorsement-not": (
        "^the names? of [a-z0-9 ]{1,120} may not be used to endorse or promote products derived "
        "from this software without (specific )?(prior )?written permission$"
    ),
    "gpl-warranty": (
        "^[a-z0-9 ]{1,120} is distributed in the hope that it will be useful but without any "
        "warranty without even the implied warranty of merchantability or fitness for a "
        "particular purpose$"
    ),
    "gpl2-free": _FREE % ("", "2"),
    "gpl3-free": _FREE % ("", "3"),
    "lgpl21-free": _FREE % ("lesser ", "2 1"),
    "lgpl3-free": _FREE % ("lesser ", "3"),
    "agpl3-free": _FREE % ("affero ", "3"),
}


@dataclass(frozen=True)
class Rule:
    """``license`` where the sentences come in this order, and none of ``unless`` at all."""

    name: str
    license: str
    sentences: tuple[str, ...]
    unless: tuple[str, ...] = ()


TEXT_RULES = (
    Rule("mit-text", "MIT", ("mit-grant", "mit-notice", "mit-warranty")),
    Rule("apache-header", "Apache-2.0", ("apache-header", "apache-warranty")),
    Rule("apache-opening", "Apache-2.0", ("apache-header",), ("apache-warranty",)),
    Rule("bsd-2-text", "BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary"),
         ("bsd-endorsement", "bsd-endorsement-not")),
    Rule("bsd-3-author", "BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorsement-not")),
    Rule("bsd-3-text", "BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorsement")),
    Rule("isc-text", "ISC", ("isc-grant", "isc-warranty")),
    Rule("gpl-2-header", "GPL-2.0-or-later", ("gpl2-later", "gpl-warranty")),
    Rule("gpl-3-header", "GPL-3.0-or-later", ("gpl3-later", "gpl-warranty")),
    Rule("gpl-2-program", "GPL-2.0-or-later", ("gpl2-free", "gpl-warranty")),
    Rule("gpl-3-program", "GPL-3.0-or-later", ("gpl3-free", "gpl-warranty")),
    Rule("gpl-3-named", "GPL-3.0-or-later", ("gpl3-later-2", "gpl-warranty"), ("gpl3-later-1",)),
    Rule("lgpl-2-1-header", "LGPL-2.1-or-later", ("lgpl21-free", "gpl-warranty")),
    Rule("lgpl-3-header", "LGPL-3.0-or-later", ("lgpl3-free", "gpl-warranty")),
    Rule("agpl-3-header", "AGPL-3.0-or-later", ("agpl3-free", "gpl-warranty")),
    Rule("mpl-header", "MPL-2.0", ("mpl-header",)),
    Rule("unlicense-text", "Unlicense", ("unlicense-domain", "unlicense-grant")),
    Rule("reserved", "LicenseRef-all-rights-reserved", ("reserved",)),
)
CUES = ("licen", "permission", "warrant", "redistribut", "endorse", "free", "reserved",
        "released", "distributed", "published")


# The same patterns in Spark and in the SQL of the oracle; white space is spelt out.
SPACE = "[ \\t\\r\\n\\f]"
SENTENCE_END = f"([.!?:]){SPACE}+"
BLANK_LINE = f"\\n{SPACE}*\\n"

# What is put aside first, in this order: pattern and what takes its place. \\1 is the first group.
COMMENT_MARK = "(^|\\n)[ \\t]*(/\\*+|\\*+/|\\*+|#+|//+|--+|;+|<!--+|-->)[ \\t]*"
COPYRIGHT = ("(^|\\n)([ \\t]*([Cc]opyright|COPYRIGHT)[ \\t]+([(][Cc][)]|©|[0-9]{4}|by[ \\t])[^\\n]*"
             "|[ \\t]*([(][Cc][)][ \\t]|©)[^\\n]*)\\n")  # fmt: skip
TAG = "SPDX-License-Identifier:"
PREPARED = (
    ("^#![^\\n]*", ""),
    (COMMENT_MARK, "\\1"),
    (COPYRIGHT, "\\1\\2\n\n"),  # twice: of two such lines the first takes the line break
    (COPYRIGHT, "\\1\\2\n\n"),
    (f"({TAG}[^\\n]*)[ \\t]+WITH[ \\t]+[A-Za-z0-9.-]+", "\\1"),
    *[(f"({TAG}[^\\n]*)[ \\t]+(OR|AND)[ \\t]+", f"\\1\n\n{TAG} ")] * 3,
    ("([0-9])[+]", "\\1 or later"),
    # A point that ends no sentence.
    ("([ ,](Inc|Ltd|Co|Corp|Jr|Dr))[.]", "\\1"),
)


def normal(sentence: str) -> str:
    return re.sub("[^a-z0-9]+", " ", sentence.lower()).strip()


def parts(name: str) -> dict[str, str]:
    """A text of ``SENTENCES`` as the readings cut it: each part, normalised, by identifier."""
    cut = re.sub(SENTENCE_END, r"\1\n", SENTENCES[name]).split("\n")
    if len(cut) == 1:
        return {name: normal(cut[0])}
    return {f"{name}-{i}": normal(part) for i, part in enumerate(cut, 1)}


def identifiers(name: str) -> list[str]:
    """What a sentence of a rule is known as: its parts, or its pattern."""
    return list(parts(name)) if name in SENTENCES else [name]


def known_sentences() -> dict[str, str]:
    """Identifiers by normalised sentence: of texts, notices, and of tags and what follows them."""
    out = {text: part for name in SENTENCES for part, text in parts(name).items()}
    for spdx, names in NAMES.items():
        for name in names:
            for opening in OPENINGS:
                for article in (" the", ""):
                    out.setdefault(normal(f"{opening} under{article} {name}"), f"notice-{spdx}")
        out.setdefault(normal(spdx), f"spdx-{spdx}")
    for spdx, written in TAGS.items():
        for form in written:
            out.setdefault(normal(form.replace("+", " or later")), f"spdx-{spdx}")
    out[normal("SPDX-License-Identifier")] = "spdx"
    return out


def rules() -> tuple[Rule, ...]:
    """The rules for texts, and those for the notice and the tag of each license.

    A sentence that the readings cut stands in a rule as its parts, in order.
    """
    texts = (
        replace(
            rule,
            sentences=tuple(part for name in rule.sentences for part in identifiers(name)),
            unless=tuple(part for name in rule.unless for part in identifiers(name)),
        )
        for rule in TEXT_RULES
    )
    notices = (Rule(f"notice-{spdx}".lower(), spdx, (f"notice-{spdx}",)) for spdx in NAMES)
    tagged = dict.fromkeys((*NAMES, *TAGS))
    tags = (Rule(f"tag-{spdx}".lower(), spdx, ("spdx", f"spdx-{spdx}")) for spdx in tagged)
    return (*texts, *notices, *tags)


def prepared(text: Column) -> Column:
    """A text without what stands around its licenses."""
    for pattern, instead in PREPARED:
        text = F.regexp_replace(text, pattern, instead.replace("\\", "$"))
    return text


def readings(text: Column) -> tuple[Column, Column]:
    """The sentences by lines, and those of the running text."""
    lines = F.regexp_replace(text, SENTENCE_END, "$1\n")
    flow = F.regexp_replace(F.regexp_replace(text, BLANK_LINE, "\u0001"), "\n", " ")
    flow = F.regexp_replace(flow, SENTENCE_END, "$1\u0001")
    return F.split(lines, "\n"), F.split(flow, "\u0001")


def identified(sentences: Column) -> Column:
    """Known sentences in order, as structs of their place and identifier."""
    table = F.create_map(*(F.lit(x) for pair in known_sentences().items() for x in pair))

    def look(sentence: Column, place: Column) -> Column:
        words = F.trim(F.regexp_replace(F.lower(sentence), "[^a-z0-9]+", " "))
        by_pattern = F.lit(None).cast("string")
        for name, pattern in reversed(PATTERNS.items()):
            by_pattern = F.when(words.rlike(pattern), name).otherwise(by_pattern)
        long = F.contains(words, F.lit("software")) | F.contains(words, F.lit("distributed"))
        known = F.coalesce(F.try_element_at(table, words), F.when(long, by_pattern))
        return F.struct(place.alias("place"), known.alias("id"))

    return F.filter(F.transform(sentences, look), lambda x: x["id"].isNotNull())


def sequence(found: Column) -> Column:
    """The identifiers, each in angle brackets, as one string to match rules with."""
    marked = F.transform(found, lambda x: F.concat(F.lit("<"), x["id"], F.lit(">")))
    return F.concat_ws("", marked)


def pattern(rule: Rule) -> str:
    return "%" + "".join(f"<{name}>%" for name in rule.sentences)


def matched(ids: Column, rule: Rule) -> Column:
    out = ids.like(pattern(rule))
    for name in rule.unless:
        out = out & ~F.contains(ids, F.lit(f"<{name}>"))
    return out


def scan(docs: DataFrame) -> DataFrame:
    """A row for each rule that a text matches: ``doc_id``, ``license``, ``rule``,
    ``reading`` (``lines``, ``flow`` or ``both``) and ``n_known``, the known sentences of the
    text in the reading that has more of them."""
    text = F.col("text").cast("string")
    lower = F.lower(text)
    cue = F.contains(lower, F.lit(CUES[0]))
    for word in CUES[1:]:
        cue = cue | F.contains(lower, F.lit(word))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).where(cue)
    rows = rows.select("doc_id", prepared(F.col("text")).alias("text"))
    lines, flow = readings(F.col("text"))
    rows = rows.select("doc_id", identified(lines).alias("lines"), identified(flow).alias("flow"))
    rows = rows.where((F.size("lines") > 0) | (F.size("flow") > 0)).select(
        "doc_id",
        F.greatest(F.size("lines"), F.size("flow")).alias("n_known"),
        sequence(F.col("lines")).alias("lines"),
        sequence(F.col("flow")).alias("flow"),
    )
    found = F.array(
        *(
            F.struct(
                F.lit(rule.license).alias("license"),
                F.lit(rule.name).alias("rule"),
                matched(F.col("lines"), rule).alias("by_lines"),
                matched(F.col("flow"), rule).alias("by_flow"),
            )
            for rule in rules()
        )
    )
    some = F.filter(found, lambda x: x["by_lines"] | x["by_flow"])
    reading = (
        F.when(F.col("hit.by_lines") & F.col("hit.by_flow"), "both")
        .when(F.col("hit.by_lines"), "lines")
        .otherwise("flow")
    )
    return rows.select("doc_id", "n_known", F.explode(some).alias("hit")).select(
        "doc_id", "hit.license", "hit.rule", reading.alias("reading"), "n_known"
    )


def oracle() -> str:
    """The scan of ``documents`` in DuckDB's SQL."""
    quoted = {text: f"'{text}'" for text in known_sentences()}
    known = ", ".join(f"({quoted[t]}, '{n}')" for t, n in known_sentences().items())
    checks = []
    for rule in rules():
        absent = [f"{{ids}} NOT LIKE '%<{name}>%'" for name in rule.unless]
        test = " AND ".join([f"{{ids}} LIKE '{pattern(rule)}'", *absent])
        checks.append(
            f"SELECT doc, doc_id, n_known, '{rule.license}' AS license, '{rule.name}' AS rule, "
            f"({test.format(ids='lines')}) AS by_lines, ({test.format(ids='flow')}) AS by_flow "
            "FROM sequences"
        )
    cues = " OR ".join(f"contains(lower(text), '{cue}')" for cue in CUES)
    end, blank = SENTENCE_END, BLANK_LINE
    text = "text"
    for pattern_, instead in PREPARED:
        instead = " || ".join(f"'{x}'" for x in instead.split("\n")).replace("||", "|| chr(10) ||")
        text = f"regexp_replace({text}, '{pattern_}', {instead}, 'g')"
    by_pattern = " ".join(f"WHEN regexp_matches(words, '{p}') THEN '{n}'" for n, p in PATTERNS.items())
    return f"""
    WITH known(sentence, id) AS (VALUES {known}),
    cued AS (SELECT row_number() OVER () AS doc, doc_id, {text} AS text FROM documents WHERE {cues}),
    cut AS (
        SELECT doc, 'lines' AS reading,
            string_split(regexp_replace(text, '{end}', '\\1' || chr(10), 'g'), chr(10)) AS parts
        FROM cued
        UNION ALL
        SELECT doc, 'flow', string_split(regexp_replace(replace(
            regexp_replace(text, '{blank}', chr(1), 'g'), chr(10), ' '
        ), '{end}', '\\1' || chr(1), 'g'), chr(1)) FROM cued
    ),
    sentences AS (
        SELECT doc, reading, unnest(parts) AS part, generate_subscripts(parts, 1) AS place FROM cut
    ),
    worded AS (
        SELECT doc, reading, place, trim(regexp_replace(lower(part), '[^a-z0-9]+', ' ', 'g')) AS words
        FROM sentences
    ),
    named AS (
        SELECT doc, reading, place, coalesce(id, CASE {by_pattern} END) AS id
        FROM worded LEFT JOIN known ON sentence = words
    ),
    found AS (
        SELECT doc, reading, count(*) AS n,
            string_agg('<' || id || '>', '' ORDER BY place) AS ids
        FROM named WHERE id IS NOT NULL GROUP BY doc, reading
    ),
    sequences AS (
        SELECT doc, doc_id,
            coalesce(max(ids) FILTER (reading = 'lines'), '') AS lines,
            coalesce(max(ids) FILTER (reading = 'flow'), '') AS flow,
            CAST(max(n) AS INTEGER) AS n_known
        FROM found JOIN cued USING (doc) GROUP BY doc, doc_id
    ),
    checked AS ({" UNION ALL ".join(checks)})
    SELECT doc_id, license, rule,
        CASE WHEN by_lines AND by_flow THEN 'both' WHEN by_lines THEN 'lines' ELSE 'flow' END
            AS reading,
        n_known
    FROM checked WHERE by_lines OR by_flow
    """
