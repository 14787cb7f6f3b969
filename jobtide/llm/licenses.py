"""Licence scans by sentence rules, with DataFrame functions only.

A text is cut into sentences at their ends, at blank lines, at a colon that ends a line, before numbers in brackets and behind a line that names
a holder of copyright; each is normalised (ASCII lower case,
every run of other characters than letters and digits one space, so that line breaks of wrapped texts and the signs of comment blocks
vanish) and looked up among the known licence sentences. A sentence that is not known is looked up line by line, as
references often stand on a line of their own; a line that is unknown but speaks of a
licence is UNKNOWN, other lines have no identifier. The identifiers in text order form a sequence such as
`,MIT-GRANT,MIT-NOTICE,`; ordered rules are matched against it, and what a rule matches is taken out, so that a full
licence text is not reported again as its parts, and several licences in one text are all found.

Texts without a trigger word are never cut. Null and empty texts have no licence, very long texts are read whole. Repeated rows are rows of their
own, other columns are ignored, an empty table gives no rows. Everything is a projection: no shuffle, no Python on executors.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRIGGER = r"(?i)licen[cs]|copyright|permission|redistribut|warrant|public domain|spdx|neither the name|free software|under (?:a )?cc by|rights reserved|in no event shall|either version|subject to the terms"
#: Sentence ends, colons at a line's end, lines that are blank but for the signs of a comment block, and numbers in brackets that begin a line.
_NUMBER = r"[ \t]*(?:[#*/;%-]+[ \t]*)?\([0-9a-z]{1,3}\)[ \t]+"
CUT = rf"(?:[.!?;]+[^0-9A-Za-z\s]*(?:\s+|$)|:[ \t]*\n|\n[ \t]*(?:[#*/;%-]+[ \t]*)?\n)(?:{_NUMBER})?|\n{_NUMBER}"
#: A line that names the holder of a copyright; it ends a sentence, whatever follows.
HOLDER = r"(?im)^([ \t]*(?:[#*/;%-]+[ \t]*)?copyright[ \t]+(?:\(c\)|\x{A9}|[0-9]{4})[^\n]*)\n"
UNKNOWN = "UNKNOWN"

# Identifiers and wordings of licence sentences, as the public licence texts have them.
SENTENCES: list[tuple[str, str]] = [
    ("MIT-GRANT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MIT-NOTICE", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("AS-IS-MIT", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."),
    ("LIABILITY-MIT", "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("MIT-TITLE", "MIT License"),
    ("MIT-TITLE", "The MIT License"),
    ("MIT-TITLE", "The MIT License (MIT)"),
    ("ISC-TITLE", "ISC License"),
    ("BSD3-TITLE", "BSD 3-Clause License"),
    ("BSD2-TITLE", "BSD 2-Clause License"),
    ("ISC-GRANT", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("BSD-REDIST", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD-SOURCE", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("BSD-BINARY", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSD-ENDORSE", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("APACHE-HEAD", "Licensed under the Apache License, Version 2.0 (the \"License\")"),
    ("APACHE-COMPLY", "you may not use this file except in compliance with the License."),
    ("APACHE-COPY", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("APACHE-COPY", "You may obtain a copy of the License at"),
    ("APACHE-URL", "http://www.apache.org/licenses/LICENSE-2.0"),
    ("APACHE-URL", "https://www.apache.org/licenses/LICENSE-2.0"),
    ("APACHE-TITLE", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("APACHE-TITLE", "Apache License, Version 2.0"),
    ("APACHE-DEFINITION", "\"License\" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document."),
    ("APACHE-ASIS", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("APACHE-REF", "Licensed under the Apache License, Version 2.0."),
    ("APACHE-REF", "Licensed under the Apache License 2.0"),
    ("APACHE-REF", "Released under the Apache License, Version 2.0."),
    ("MIT-REF", "Released under the MIT License."),
    ("MIT-REF", "Licensed under the MIT License."),
    ("MIT-REF", "This project is licensed under the MIT License."),
    ("MIT-REF", "This work is licensed under the MIT License."),
    ("BSD3-REF", "Licensed under the BSD 3-Clause License."),
    ("BSD3-REF", "Released under the BSD 3-Clause License."),
    ("BSD2-REF", "Licensed under the BSD 2-Clause License."),
    ("GPL3-REF", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL3-REF", "Licensed under the GNU General Public License, version 3."),
    ("GPL3-REF", "Released under the GNU General Public License, version 3."),
    ("GPL2-REF", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL2-REF", "Licensed under the GNU General Public License, version 2."),
    ("LGPL3-REF", "Licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL21-REF", "Licensed under the GNU Lesser General Public License, version 2.1."),
    ("AGPL3-REF", "Licensed under the GNU Affero General Public License, version 3."),
    ("GPL-FREE-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-FREE-2", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("GPL-ANY-2", "either version 2 of the License, or (at your option) any later version."),
    ("GPL-HOPE", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY"),
    ("GPL-DETAILS", "See the GNU General Public License for more details."),
    ("GPL3-TITLE", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL2-TITLE", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("LGPL3-TITLE", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL21-TITLE", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("AGPL3-TITLE", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("MPL2-TITLE", "Mozilla Public License Version 2.0"),
    ("MPL2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL2", "Licensed under the Mozilla Public License, version 2.0."),
    ("UNLICENSE", "This is free and unencumbered software released into the public domain."),
    ("PUBLIC-DOMAIN", "This work is in the public domain."),
    ("PUBLIC-DOMAIN", "Released into the public domain."),
    ("RESERVED", "All rights reserved."),
]
#: Short names that the SPDX tag and the usual reference sentences take.
SPDX = "MIT Apache-2.0 BSD-2-Clause BSD-3-Clause ISC GPL-2.0-only GPL-2.0-or-later GPL-3.0-only GPL-3.0-or-later LGPL-2.1-only LGPL-3.0-only AGPL-3.0-only MPL-2.0 Unlicense CC0-1.0".split()
CC_KINDS, CC_VERSIONS = ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"), ("2.0", "3.0", "4.0")
CC_LEADS = ("Licensed under", "Released under", "This work is licensed under", "Available under")

# Ordered rules, licence and identifier sequence.
RULES: list[tuple[str, str]] = [
    ("Apache-2.0", ",APACHE-TITLE(?:,UNKNOWN|,APACHE-DEFINITION|,APACHE-HEAD|,APACHE-COMPLY|,APACHE-COPY|,APACHE-URL|,APACHE-ASIS)*"),
    ("GPL-3.0-only", ",GPL3-TITLE(?:,UNKNOWN|,GPL-FREE-3|,GPL-HOPE|,GPL-DETAILS)*"),
    ("GPL-2.0-only", ",GPL2-TITLE(?:,UNKNOWN|,GPL-FREE-2|,GPL-ANY-2|,GPL-HOPE|,GPL-DETAILS)*"),
    ("LGPL-3.0-only", ",LGPL3-TITLE(?:,UNKNOWN)*"),
    ("LGPL-2.1-only", ",LGPL21-TITLE(?:,UNKNOWN)*"),
    ("AGPL-3.0-only", ",AGPL3-TITLE(?:,UNKNOWN)*"),
    ("MPL-2.0", ",MPL2-TITLE(?:,UNKNOWN|,MPL2)*"),
    ("MIT", "(?:,MIT-TITLE)?(?:,RESERVED)?,MIT-GRANT,MIT-NOTICE(?:,AS-IS-MIT)?(?:,LIABILITY-MIT)?"),
    ("ISC", "(?:,ISC-TITLE)?,ISC-GRANT|,ISC-TITLE"),
    ("BSD-3-Clause", "(?:,BSD3-TITLE)?(?:,RESERVED)?,BSD-REDIST,BSD-SOURCE,BSD-BINARY,BSD-ENDORSE"),
    ("BSD-2-Clause", "(?:,BSD2-TITLE)?(?:,RESERVED)?,BSD-REDIST,BSD-SOURCE,BSD-BINARY"),
    ("Apache-2.0", ",APACHE-HEAD,APACHE-COMPLY(?:,APACHE-COPY)?(?:,APACHE-URL)?(?:,APACHE-ASIS)?"),
    ("Apache-2.0", ",APACHE-(?:REF|HEAD|URL)"),
    ("GPL-3.0-or-later", ",GPL-FREE-3(?:,GPL-HOPE)?(?:,GPL-DETAILS)?"),
    ("GPL-2.0-or-later", ",GPL-FREE-2,GPL-ANY-2(?:,GPL-HOPE)?(?:,GPL-DETAILS)?"),
    ("GPL-2.0-only", ",GPL-FREE-2(?:,GPL-HOPE)?(?:,GPL-DETAILS)?|,GPL2-REF"),
    ("GPL-3.0-only", ",GPL3-REF"),
    ("LGPL-3.0-only", ",LGPL3-REF"),
    ("LGPL-2.1-only", ",LGPL21-REF"),
    ("AGPL-3.0-only", ",AGPL3-REF"),
    ("MIT", ",MIT-REF|,MIT-TITLE|,MIT-GRANT|,AS-IS-MIT,LIABILITY-MIT"),
    ("BSD-3-Clause", ",BSD3-REF|,BSD3-TITLE"),
    ("BSD-2-Clause", ",BSD2-REF|,BSD2-TITLE"),
    ("MPL-2.0", ",MPL2"),
    ("Unlicense", ",UNLICENSE"),
    ("public-domain", ",PUBLIC-DOMAIN"),
    ("all-rights-reserved", ",RESERVED"),
]


def normal(sentence: str) -> str:
    return re.sub("[^a-z0-9]+", " ", sentence.lower()).strip()


def known_sentences() -> dict[str, str]:
    """Normalised sentence to identifier: the fixed ones, and the reference sentences that follow from names."""
    found = {f"spdx license identifier {normal(s)}": f"SPDX-{s}" for s in SPDX}
    for kind in CC_KINDS:
        for version in CC_VERSIONS:
            for lead in CC_LEADS:
                found[normal(f"{lead} CC {kind} {version}")] = f"CC-{kind}-{version}"
                found[normal(f"{lead} a CC {kind} {version} license")] = f"CC-{kind}-{version}"
    # a sentence that the cut ends early ("v", "version 3") is known by what is left of it
    for name, sentence in SENTENCES:
        found[normal(re.split(CUT, sentence)[0] or sentence)] = name
    return found


def all_rules() -> list[tuple[str, str]]:
    named = [(s, f",SPDX-{re.escape(s)}(?=,)") for s in SPDX]
    cc = [(f"CC-{k}-{v}", f",CC-{re.escape(k)}-{re.escape(v)}(?=,)") for k in CC_KINDS for v in CC_VERSIONS]
    fixed = [(name, f"(?:{pattern})(?=,)") for name, pattern in RULES]
    return [*fixed, *named, *cc, ("unknown-reference", f",{UNKNOWN}(?=,)")]


def _sentence_ids(text: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in known_sentences().items() for x in pair])
    normalised = lambda s: F.trim(F.regexp_replace(F.lower(s), "[^a-z0-9]+", " "))
    of_line = lambda s: F.coalesce(F.element_at(known, s), F.when(s.rlike("licen[cs]e"), F.lit(UNKNOWN)))

    def of_sentence(sentence: Column) -> Column:
        whole = F.element_at(known, normalised(sentence))
        lines = F.transform(F.split(sentence, "\n"), lambda line: of_line(normalised(line)))
        return F.when(whole.isNotNull(), F.array(whole)).otherwise(lines)

    sentences = F.split(F.regexp_replace(F.regexp_replace(text, "\r\n?", "\n"), HOLDER, "$1\n\n"), CUT)
    return F.filter(F.flatten(F.transform(sentences, of_sentence)), lambda x: x.isNotNull())


def scan_licenses(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_sentences (with an identifier), sentence_ids and licenses, joined by commas in text and rule order."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    ids = F.when(text.rlike(TRIGGER), _sentence_ids(text)).otherwise(F.array().cast("array<string>"))
    rows = docs.select(F.col(id_col).alias("doc_id"), ids.alias("ids"))
    rules = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(p).alias("pattern")) for n, p in all_rules()])
    start = F.struct(F.concat(F.lit(","), F.array_join("ids", ","), F.lit(",")).alias("rest"), F.array().cast("array<string>").alias("found"))

    def step(state: Column, rule: Column) -> Column:
        hit = F.regexp_like(state["rest"], rule["pattern"])
        return F.struct(
            F.when(hit, F.regexp_replace(state["rest"], rule["pattern"], F.lit(""))).otherwise(state["rest"]).alias("rest"),
            F.when(hit & ~F.array_contains(state["found"], rule["name"]), F.concat(state["found"], F.array(rule["name"]))).otherwise(state["found"]).alias("found"),
        )

    matched = F.when(F.size("ids") > 0, F.array_join(F.aggregate(rules, start, step)["found"], ",")).otherwise(F.lit(""))
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_sentences"), F.array_join("ids", ",").alias("sentence_ids"), matched.alias("licenses"))


def oracle_sql() -> str:
    """The same in DuckDB: sentences by a join, rules by a recursion over their order. RE2 has no lookahead, so a match keeps its closing comma."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    known = ", ".join(f"({quote(s)}, {quote(i)})" for s, i in known_sentences().items())
    rules = ", ".join(f"({k}, {quote(n)}, {quote('(?:' + p.replace('(?=,)', '') + '),')})" for k, (n, p) in enumerate(all_rules(), 1))
    return f"""
        WITH RECURSIVE known(s, id) AS (VALUES {known}),
        rules(k, name, pattern) AS (VALUES {rules}),
        cut AS (SELECT doc_id, string_split_regex(regexp_replace(regexp_replace(coalesce(text, ''), '\\r\\n?', chr(10), 'g'), '{HOLDER}', '\\1' || chr(10) || chr(10), 'g'), '{CUT}') AS parts FROM documents WHERE regexp_matches(coalesce(text, ''), '{TRIGGER}')),
        sentences AS (SELECT doc_id, i, parts[i] AS part, trim(regexp_replace(lower(parts[i]), '[^a-z0-9]+', ' ', 'g')) AS s FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM cut)),
        whole AS (SELECT sentences.*, known.id FROM sentences LEFT JOIN known ON sentences.s = known.s),
        lines AS (SELECT doc_id, i, j, trim(regexp_replace(lower(parts[j]), '[^a-z0-9]+', ' ', 'g')) AS s FROM (SELECT doc_id, i, parts, unnest(range(1, len(parts) + 1)) AS j FROM (SELECT doc_id, i, string_split(part, chr(10)) AS parts FROM whole WHERE id IS NULL))),
        named AS (
            SELECT doc_id, i, 0 AS j, id FROM whole WHERE id IS NOT NULL
            UNION ALL
            SELECT doc_id, i, j, coalesce(known.id, CASE WHEN regexp_matches(lines.s, 'licen[cs]e') THEN '{UNKNOWN}' END) AS id FROM lines LEFT JOIN known ON lines.s = known.s),
        ids AS (SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY i, j) AS ids FROM named WHERE id IS NOT NULL GROUP BY doc_id),
        steps(doc_id, k, rest, found) AS (
            SELECT doc_id, 0, ',' || ids || ',', CAST([] AS VARCHAR[]) FROM ids
            UNION ALL
            SELECT doc_id, rules.k, CASE WHEN regexp_matches(rest, pattern) THEN regexp_replace(regexp_replace(rest, pattern, ',', 'g'), pattern, ',', 'g') ELSE rest END,
                   CASE WHEN regexp_matches(rest, pattern) AND NOT list_contains(found, name) THEN list_append(found, name) ELSE found END
            FROM steps JOIN rules ON rules.k = steps.k + 1)
        SELECT d.doc_id, CAST(coalesce(ids.n, 0) AS BIGINT) AS n_sentences, coalesce(ids.ids, '') AS sentence_ids,
               coalesce(array_to_string(steps.found, ','), '') AS licenses
        FROM documents d LEFT JOIN ids ON d.doc_id = ids.doc_id LEFT JOIN steps ON d.doc_id = steps.doc_id AND steps.k = (SELECT max(k) FROM rules)"""
