"""License scan: all lines with license words are found, and wordings decide."""

import re
import textwrap

from eventlode.llm.licenses import TEMPLATES, Matcher, blocks_of, op3_license_scan, scan_licenses

# The license lines of the given documents.
LINES = {"Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Released under the MIT License.": "MIT",
         "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
         "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0"}


def test_query_finds_every_line(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    want = sorted((i, m.start(), LINES[x]) for i, t in texts.items() for x in LINES for m in re.finditer("(?m)^" + re.escape(x), t))
    found = sorted((r.doc_id, r.block_start, r.license) for r in op3_license_scan(spark, sf_dir).collect() if r.confirmed)
    assert found == want and want


def test_wordings():
    matcher = Matcher(TEMPLATES)
    for name, text in TEMPLATES.items():
        found = matcher.judge(text)
        assert (found["license"], found["missing"], found["extra"], found["confirmed"]) == (name, [], [], True)
        assert matcher.judge("\n".join(text.split(". ")))["license"] == name
    other = matcher.judge("This work is licensed under the GNU General Public License, version 7.")
    assert not other["confirmed"]
    changed = matcher.judge(TEMPLATES["MIT-text"].replace("free of charge", "gratis"))
    assert changed["license"] == "MIT-text" and changed["confirmed"] and changed["missing"] == ["free", "of", "charge"] and changed["extra"] == ["gratis"]
    assert matcher.judge("copyright")["license"] is None or not matcher.judge("copyright")["confirmed"]


def test_odd_rows(spark):
    long = "word " * 40_000 + "end. Released under the MIT License. " + "more " * 40_000
    rows = [(1, None), (2, ""), (3, "nothing here"), (4, long), (5, "é😀\nReleased under the MIT License.\nx"), (5, "é😀\nReleased under the MIT License.\nx"), (None, "a licensed thing")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, license string")
    found = sorted((r.doc_id or 0, r.block_start, r.license, r.confirmed) for r in scan_licenses(docs).collect())
    assert [x for x in found if x[0] == 5] == [(5, 3, "MIT", True)] * 2
    assert [(x[0], x[2], x[3]) for x in found if x[0] == 4] == [(4, "MIT", True)]
    assert len(found) == 4 and not found[0][3]
    assert scan_licenses(docs.where("false")).count() == 0
    assert list(blocks_of("a\nb\n")) == []


def test_wrapped_templates(spark):
    rows, want = [], []
    for name, text in TEMPLATES.items():
        for width, mark in ((72, ""), (80, ""), (72, " * "), (80, "# ")):
            lines = "\n".join(mark + x for x in textwrap.wrap(text, width))
            rows.append((len(rows), f"Some words before.\n\n{mark}Copyright (c) 2020 Someone\n{lines}\n\nSome words after it."))
            want.append((len(rows) - 1, name, [], []))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((r.doc_id, r.license, r.missing, r.extra) for r in scan_licenses(docs).collect() if r.confirmed)
    assert found == want


def test_several_notices(spark):
    mit, apache, gpl = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", TEMPLATES["GPL-3.0"]
    bsd = TEMPLATES["BSD-2-Clause"]
    cases = [
        (f"{mit}\n{apache}", ["MIT", "Apache-2.0"]),
        (f"{mit} {apache}", ["MIT", "Apache-2.0"]),
        (f"{mit} {apache} {'word ' * 400}", ["MIT", "Apache-2.0"]),
        ("Licensed under the MIT License or the Apache License, Version 2.0, at your option.", ["Apache-2.0", "MIT"]),
        (f"{gpl} {mit} {apache}\n{bsd} {mit}\n{mit}", ["GPL-3.0", "MIT", "Apache-2.0", "BSD-2-Clause", "MIT", "MIT"]),
        ("\n".join(TEMPLATES.values()), list(TEMPLATES)),
        (f"{mit}\nLicensed under terms of our own.", ["MIT"]),
        (TEMPLATES["LGPL-3.0"], ["LGPL-3.0"]),
        ("Released under the Apache License, Version 2.0.", ["Apache-2.0"]),
    ]
    docs = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(cases)], "doc_id long, text string")
    found = sorted(scan_licenses(docs).collect(), key=lambda r: (r.doc_id, r.block_start))
    for k, (text, want) in enumerate(cases):
        rows = [r for r in found if r.doc_id == k and r.confirmed]
        assert sorted(r.license for r in rows) == sorted(want), text
    # What is left of a block stays a candidate of its own.
    assert [(r.confirmed, cases[6][0][r.block_start : r.block_end].strip()) for r in found if r.doc_id == 6][1:] == [(False, ".\nLicensed under terms of our own.")]


def test_compression_ranks_and_selects(monkeypatch):
    # A template that saves nothing is never compared; the order of trials is that of the bytes saved.
    matcher, tried = Matcher(TEMPLATES), []
    plain = Matcher.occurrences
    monkeypatch.setattr(Matcher, "occurrences", lambda self, words, name: (tried.append(name), plain(self, words, name))[1])
    text = "Some words. " + TEMPLATES["LGPL-3.0"] + " Other words."
    assert [r["license"] for r in matcher.licenses(text)] == ["LGPL-3.0"]
    assert tried[0] == "LGPL-3.0" == matcher.reductions(text)[0][1]
    # With its notice cut out, nothing of the words left is like a template.
    assert len(tried) < len(TEMPLATES)
    # An unconfirmed block names the template that saves most.
    block = "You may redistribute and/or modify it under the terms of the GNU General Public License as published, says the licence."
    found = matcher.judge(block)
    assert (found["saved_bytes"], found["license"]) == matcher.reductions(block)[0] and not found["confirmed"]


def test_many_notices_in_one_text():
    import time

    matcher = Matcher(TEMPLATES)
    one = "Released under the MIT License. Licensed under the Apache License, Version 2.0.\n"
    spent = []
    for n in (500, 2_000):
        start = time.perf_counter()
        assert [r["license"] for r in matcher.licenses(one * n)] == ["MIT", "Apache-2.0"] * n
        spent.append(time.perf_counter() - start)
    # Four times the text takes about four times as long, not sixteen times.
    assert spent[1] < 10 * spent[0] + 1
