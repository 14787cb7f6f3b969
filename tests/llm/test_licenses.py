from jobtide.llm import licenses as L

TEXT = {i: s for i, s in reversed(L.SENTENCES)}


def scan(docs_frame, texts):
    rows = L.scan_licenses(docs_frame(list(enumerate(texts)))).orderBy("doc_id").collect()
    return [r.licenses for r in rows], [r.sentence_ids for r in rows]


def test_rules(docs_frame):
    mit = "\n".join(TEXT[k] for k in ("MIT-GRANT", "MIT-NOTICE", "AS-IS-MIT", "LIABILITY-MIT"))
    bsd2 = "\n".join(TEXT[k] for k in ("BSD-REDIST", "BSD-SOURCE", "BSD-BINARY"))
    texts = [
        None, "", "No word of it.", "Prose here. Released under the MIT License. More prose.", "LICENSED under the\tApache license, version 2.0!\nLicensed under CC BY-NC 4.0.",
        mit, bsd2, bsd2 + "\n" + TEXT["BSD-ENDORSE"], "SPDX-License-Identifier: GPL-3.0-or-later\ncode", "You may like this driving licence. All rights reserved.",
        mit + "\n" + "Licensed under the MIT License.\n" + "This work is licensed under the GNU General Public License, version 3.", "word " * 30000 + ". Released under the MIT License.",
        "Permission to land was refused.", "Licensed under CC BY-NC 4.0.\nLicensed under CC BY-NC 4.0.",
    ]
    found, ids = scan(docs_frame, texts)
    assert found == [
        "", "", "", "MIT", "Apache-2.0,CC-BY-NC-4.0", "MIT", "BSD-2-Clause", "BSD-3-Clause", "GPL-3.0-or-later", "all-rights-reserved,unknown-reference", "MIT,GPL-3.0-only", "MIT", "", "CC-BY-NC-4.0",
    ]
    assert ids[5] == "MIT-GRANT,MIT-NOTICE,AS-IS-MIT,LIABILITY-MIT" and ids[9] == "UNKNOWN,RESERVED"


def test_every_known_sentence_is_found_by_a_rule(docs_frame):
    texts = list(L.known_sentences())
    _, ids = scan(docs_frame, texts)
    trigger = [i for i, t in zip(ids, texts) if i]
    assert all(i == L.known_sentences()[t] for i, t in zip(ids, texts) if i) and len(trigger) > 0.9 * len(texts)


def test_no_python_in_the_plan(docs_frame):
    plan = L.scan_licenses(docs_frame([(1, "x")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def wrapped(*sentences, prefix="", width=76, between="\n\n"):
    import textwrap

    parts = [textwrap.fill(s, width, initial_indent=prefix, subsequent_indent=prefix) for s in sentences]
    return between.replace("\n\n", f"\n{prefix.rstrip()}\n").join(parts)


def sentence(name):
    return next(s for n, s in L.SENTENCES if n == name)


def test_texts_as_they_ship(docs_frame):
    mit = ("MIT License", "Copyright (c) 2020 A. Person", sentence("MIT-GRANT"), sentence("MIT-NOTICE"), sentence("AS-IS-MIT") + "  " + sentence("LIABILITY-MIT"))
    bsd = ("Copyright (c) 2001, B Corp\nAll rights reserved.", sentence("BSD-REDIST") + "\n1. " + sentence("BSD-SOURCE"), "2. " + sentence("BSD-BINARY"), "3. " + sentence("BSD-ENDORSE"))
    apache = ('Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at', "http://www.apache.org/licenses/LICENSE-2.0", sentence("APACHE-ASIS"))
    bsd_text = "\n\n".join(wrapped(p, between="\n") if "\n" not in p else "\n".join(wrapped(q) for q in p.split("\n")) for p in bsd)
    gpl = "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Everyone may copy this license document.\n"
    rows = [
        (1, wrapped(*mit)), (2, "/*\n" + wrapped(*mit, prefix=" * ") + "\n */"), (3, wrapped(*mit).replace("\n", "\r\n")), (4, bsd_text), (5, wrapped(*apache, prefix="# ")), (6, wrapped(*apache, prefix="// ", width=60)),
        (7, wrapped(sentence("GPL-FREE-3"), sentence("GPL-HOPE") + "; without even the implied warranty. See the GNU General Public License for more details.", width=50)), (8, gpl),
        (9, "Some words\nSPDX-License-Identifier: MIT\nmore words"), (10, "All we have\nLicensed under the MIT License\nand a line"), (11, "a license\nthat nobody knows"),
    ]
    got = {r.doc_id: r.licenses for r in L.scan_licenses(docs_frame(rows)).collect()}
    assert got == {1: "MIT", 2: "MIT", 3: "MIT", 4: "BSD-3-Clause", 5: "Apache-2.0", 6: "Apache-2.0", 7: "GPL-3.0-or-later", 8: "GPL-3.0-only", 9: "MIT", 10: "MIT", 11: "unknown-reference"}
    import duckdb

    documents = docs_frame(rows).select("doc_id", "text").toArrow()
    assert documents.num_rows == len(rows)
    con = duckdb.connect()
    con.register("documents", documents)
    assert {r[0]: r[3] for r in con.sql(L.oracle_sql()).fetchall()} == got


def test_holders_and_numbers_in_brackets_cut(docs_frame):
    grant = wrapped(TEXT["MIT-GRANT"], TEXT["MIT-NOTICE"], TEXT["AS-IS-MIT"], TEXT["LIABILITY-MIT"])
    for holder in ("Copyright (c) 2020 Some One", "Copyright 2019-2024, A B", "# Copyright © 2001 X"):
        prefix = "# " if holder.startswith("#") else ""
        body = "\n".join(prefix + line if line else line for line in grant.split("\n"))
        found, ids = scan(docs_frame, [f"{holder}\n{body}", f"Intro\n{holder}\n{holder}\n{body}"])
        assert found == ["MIT", "MIT"] and all("MIT-GRANT,MIT-NOTICE" in i for i in ids), holder
    numbered = TEXT["BSD-REDIST"] + "\n" + "\n".join(f"  ({k}) {TEXT[n]}" for k, n in zip("123", ("BSD-SOURCE", "BSD-BINARY", "BSD-ENDORSE")))
    assert scan(docs_frame, [numbered])[0] == ["BSD-3-Clause"]
    # words of a notice that begin a line name nobody
    assert scan(docs_frame, [wrapped(TEXT["BSD-REDIST"], TEXT["BSD-SOURCE"], TEXT["BSD-BINARY"], width=40)])[0] == ["BSD-2-Clause"]
