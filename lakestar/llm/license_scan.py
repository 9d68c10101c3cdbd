"""Licence scanning by sentence rules, in DataFrame operations only.

A text is cut into sentences (at line ends and after ``. ! ? : ;``) and
normalised.  Sentences that are known, also when wrapped over any number of
lines, become identifiers.  Ordered rules are matched against a document's sequence
of identifiers; what a rule matched is used up, so a long licence is not also
reported as the shorter one it contains.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licences and of common references to them.
SENTENCES = {
    "mit-ref": "Released under the MIT License.",
    "mit-ref-2": "Licensed under the MIT License.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                 "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
                 "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
                 "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
                 "furnished to do so, subject to the following conditions:",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or "
                  "substantial portions of the Software.",
    "apache-2-ref": "Licensed under the Apache License, Version 2.0.",
    "apache-2-header": "Licensed under the Apache License, Version 2.0 (the \"License\");",
    "apache-2-comply": "You may not use this file except in compliance with the License.",
    "apache-2-copy": "You may obtain a copy of the License at",
    "gpl-3-ref": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-2-ref": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-2-only": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
                  "General Public License version 2 as published by the Free Software Foundation.",
    "gpl-2-free": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
                  "General Public License as published by the Free Software Foundation; either version 2 of the "
                  "License, or (at your option) any later version.",
    "lgpl-2.1-free": "This library is free software; you can redistribute it and/or modify it under the terms of the "
                     "GNU Lesser General Public License as published by the Free Software Foundation; either version "
                     "2.1 of the License, or (at your option) any later version.",
    "lgpl-3-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                   "Lesser General Public License as published by the Free Software Foundation, either version 3 of "
                   "the License, or (at your option) any later version.",
    "agpl-3-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                   "Affero General Public License as published by the Free Software Foundation, either version 3 of "
                   "the License, or (at your option) any later version.",
    "mpl-2-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "epl-2-header": "This program and the accompanying materials are made available under the terms of the Eclipse "
                    "Public License 2.0 which is available at",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
                 "is hereby granted, provided that the above copyright notice and this permission notice appear in all "
                 "copies.",
    "0bsd-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
                  "is hereby granted.",
    "unlicense-domain": "This is free and unencumbered software released into the public domain.",
    "cc0-dedication": "To the extent possible under law, the author(s) have dedicated all copyright and related and "
                      "neighboring rights to this software to the public domain worldwide.",
    "cc0-ref": "Licensed under CC0 1.0.",
    "boost-grant": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the "
                   "software and accompanying documentation covered by this license (the \"Software\") to use, "
                   "reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works "
                   "of the Software, and to permit third-parties to whom the Software is furnished to do so, all "
                   "subject to the following:",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial "
                  "applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the "
                "License, or (at your option) any later version.",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
                "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "bsd-redistribution": "Redistribution and use in source and binary forms, with or without modification, are "
                          "permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions "
                  "and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions "
                  "and the following disclaimer in the documentation and/or other materials provided with the "
                  "distribution.",
    "bsd-endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
                   "or promote products derived from this software without specific prior written permission.",
    "bsd-advertising": "All advertising materials mentioning features or use of this software must display the following "
                       "acknowledgement:",
    "cc-by-nc-4-ref": "Licensed under CC BY-NC 4.0.",
    "cc-by-4-ref": "Licensed under CC BY 4.0.",
    "cc-by-sa-4-ref": "Licensed under CC BY-SA 4.0.",
    "all-rights": "All rights reserved.",
}
# Identifiers that a line "SPDX-License-Identifier: ..." may name.
SPDX = ["MIT", "MIT-0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause", "0BSD", "ISC", "Zlib", "BSL-1.0", "GPL-2.0-only",
        "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only",
        "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later", "MPL-2.0", "EPL-2.0", "Unlicense", "CC0-1.0", "CC-BY-4.0",
        "CC-BY-SA-4.0", "CC-BY-NC-4.0"]
SENTENCES |= {f"spdx-{name}": f"SPDX-License-Identifier: {name}" for name in SPDX}
# Licences by the sequences that tell them, in order of
# precedence.
RULES = [
    ("Apache-2.0", ["apache-2-header", "apache-2-comply", "apache-2-copy"]),
    ("MIT", ["mit-grant", "mit-notice"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl-hope"]),
    ("LGPL-2.1-or-later", ["lgpl-2.1-free"]),
    ("LGPL-3.0-or-later", ["lgpl-3-free", "gpl-hope"]),
    ("LGPL-3.0-or-later", ["lgpl-3-free"]),
    ("AGPL-3.0-or-later", ["agpl-3-free", "gpl-hope"]),
    ("AGPL-3.0-or-later", ["agpl-3-free"]),
    ("GPL-2.0-or-later", ["gpl-2-free", "gpl-hope"]),
    ("GPL-2.0-or-later", ["gpl-2-free"]),
    ("GPL-2.0-only", ["gpl-2-only", "gpl-hope"]),
    ("GPL-2.0-only", ["gpl-2-only"]),
    ("BSD-4-Clause", ["bsd-redistribution", "bsd-source", "bsd-binary", "bsd-advertising", "bsd-endorse"]),
    ("BSD-3-Clause", ["bsd-redistribution", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("BSD-2-Clause", ["bsd-redistribution", "bsd-source", "bsd-binary"]),
    ("GPL-3.0-or-later", ["gpl-free"]),
    ("Apache-2.0", ["apache-2-header"]),
    ("Apache-2.0", ["apache-2-ref"]),
    ("MIT", ["mit-grant"]),
    ("MIT", ["mit-ref"]),
    ("MIT", ["mit-ref-2"]),
    ("GPL-3.0-only", ["gpl-3-ref"]),
    ("GPL-2.0-only", ["gpl-2-ref"]),
    ("MPL-2.0", ["mpl-2-header"]),
    ("EPL-2.0", ["epl-2-header"]),
    ("ISC", ["isc-grant"]),
    ("0BSD", ["0bsd-grant"]),
    ("Zlib", ["zlib-grant"]),
    ("BSL-1.0", ["boost-grant"]),
    ("Unlicense", ["unlicense-domain"]),
    ("CC0-1.0", ["cc0-dedication"]),
    ("CC0-1.0", ["cc0-ref"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4-ref"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4-ref"]),
    ("CC-BY-4.0", ["cc-by-4-ref"]),
    *[(name, [f"spdx-{name}"]) for name in SPDX],
    ("LicenseRef-all-rights-reserved", ["all-rights"]),
]
SENTENCE_END = r"[.!?:;]+[ \t\r\n]+|[\r\n]+"
NOT_WORD = r"[^\p{L}\p{N}]+"


def normalise_text(sentence: str) -> str:
    return " ".join(re.findall(r"[^\W_]+", sentence.lower()))


def _known(sentences: dict[str, str]) -> dict[str, str]:
    return {normalise_text(s): k for k, s in sentences.items()}


def _marks(known: dict[str, str]) -> str:
    """A pattern that every known sentence contains: its longest words."""
    return "|".join(sorted({max(s.split(), key=lambda w: (len(w), w)) for s in known}))


def sentence_ids(text: Column, sentences: dict[str, str] = SENTENCES) -> Column:
    """Identifiers of the known sentences of a text, in order."""
    known = _known(sentences)
    table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    first_words = F.array(*[F.lit(w) for w in sorted({s.split()[0] for s in known})])
    low = F.lower(F.coalesce(text, F.lit("")))
    parts = F.filter(F.transform(F.split(low, SENTENCE_END), lambda s: F.trim(F.regexp_replace(s, NOT_WORD, " "))),
                     lambda s: s != "")

    # a segment has a word at least, so no sentence takes more than its words
    most = max(len(s.split()) for s in known)
    # shorter sentences first: of those that begin here, the first to end
    patterns = [("^" + "[ \n]".join(s.split()) + "\n", k) for s, k in sorted(known.items(), key=lambda x: len(x[0].split()))]

    def wrapped(lines: Column) -> Column:
        # a pattern is only tried if the sentence begins with its first word
        by_first = {}
        for p, k in patterns:
            by_first.setdefault(re.split(r"\[|\n", p[1:])[0], []).append(F.when(lines.rlike(p), F.lit(k)))
        return F.coalesce(*[F.when(lines.startswith(w), F.coalesce(*tries)) for w, tries in by_first.items()])

    def at(segments: Column, i: Column) -> Column:
        head = F.element_at(segments, i)
        # a line end after each segment; bound once, by a transform over one element
        lines = F.array(F.concat(F.array_join(F.slice(segments, i, most), "\n"), F.lit("\n")))
        return F.when(F.array_contains(first_words, F.substring_index(head, " ", 1)),
                      F.coalesce(F.element_at(table, head), F.element_at(F.transform(lines, wrapped), 1)))

    def scan(segments: Column) -> Column:
        return F.filter(F.transform(F.sequence(F.lit(1), F.size(segments)), lambda i: at(segments, i)),
                        lambda s: s.isNotNull())

    none = F.array().cast("array<string>")
    # the segments are bound once, by a transform over one element
    found = F.flatten(F.transform(F.array(parts), lambda p: F.when(F.size(p) == 0, none).otherwise(scan(p))))
    return F.when(low.rlike(_marks(known)), found).otherwise(none)


def scan(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", sentences: dict[str, str] = SENTENCES,
         rules: list[tuple[str, list[str]]] = RULES) -> DataFrame:
    """Per document: ``doc_id, sentences`` (identifiers in order) and
    ``licenses`` (rules matched, in order of precedence, each licence once).

    Null and empty texts have neither.  Every row is reported, repeated ones
    too, whatever their other columns.  An empty table gives an empty one.
    """
    found = documents.select(F.col(doc_id).alias("doc_id"), sentence_ids(F.col(text), sentences).alias("sentences"))
    # every identifier between its own commas, so neighbours do not share one
    left = F.concat_ws("", F.transform("sentences", lambda s: F.concat(F.lit(","), s, F.lit(","))))
    names = []
    for k, (name, sequence) in enumerate(rules):
        pattern = "".join(f",{s}," for s in sequence)
        found = found.withColumn(f"_left{k}", left)
        names.append(F.when(F.col(f"_left{k}").contains(pattern), F.lit(name)))
        left = F.replace(F.col(f"_left{k}"), F.lit(pattern), F.lit("|"))
    return found.select("doc_id", "sentences", F.array_distinct(F.array_compact(F.array(*names))).alias("licenses"))


def oracle(sentences: dict[str, str] = SENTENCES, rules: list[tuple[str, list[str]]] = RULES) -> str:
    """The same report as DuckDB SQL.  A segment has a word at least, so a
    sentence is tried over as many segments as the longest one has words."""
    most = max(len(x.split()) for x in _known(sentences))
    first = ", ".join(f"'{w}'" for w in sorted({x.split()[0] for x in _known(sentences)}))
    known = ", ".join(f"'{s}': '{k}'" for s, k in _known(sentences).items())
    tries = ", ".join(f"known[array_to_string(segs[i:i + {k}], ' ')]" for k in range(most))
    steps, names = [], []
    before = "seq"
    for k, (name, sequence) in enumerate(rules):
        pattern = "".join(f",{s}," for s in sequence)
        names.append(f"CASE WHEN contains(l{k}, '{pattern}') THEN '{name}' END")
        steps.append(f"r{k} AS (SELECT *, {before} AS l{k} FROM {'s' if k == 0 else f'r{k - 1}'})")
        before = f"replace(l{k}, '{pattern}', '|')"
    unique = "list_filter([" + ", ".join(names) + "], lambda x: x IS NOT NULL)"
    return f"""
WITH k AS (SELECT MAP {{{known}}} AS known),
d AS (SELECT doc_id, known, list_filter(list_transform(string_split_regex(lower(coalesce(text, '')), '{SENTENCE_END}'),
        lambda s: trim(regexp_replace(s, '{NOT_WORD}', ' ', 'g'))), lambda s: s <> '') AS segs FROM documents, k),
f AS (SELECT doc_id, list_filter(list_transform(range(1, len(segs) + 1), lambda i:
        CASE WHEN list_contains([{first}], split_part(segs[i], ' ', 1)) THEN coalesce({tries}) END),
        lambda x: x IS NOT NULL) AS ids FROM d),
s AS (SELECT doc_id, ids, array_to_string(list_transform(ids, lambda x: ',' || x || ','), '') AS seq FROM f),
{', '.join(steps)},
n AS (SELECT doc_id, ids, {unique} AS names FROM r{len(rules) - 1})
SELECT doc_id, len(ids)::BIGINT AS n_sentences, array_to_string(ids, ',') AS sentence_ids,
       array_to_string(list_transform(list_filter(range(1, len(names) + 1),
           lambda i: NOT list_contains(names[1:i - 1], names[i])), lambda i: names[i]), ',') AS licenses FROM n"""
