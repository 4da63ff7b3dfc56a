from candlewick.llm import licenses, queries
from tests.llm.helpers import empty_docs, odd_docs

SF01 = "/root/testdata/sf0.01"
LINES = {"Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Released under the MIT License.": "MIT", "Licensed under CC BY-NC 4.0.": "CC-BY-NC",
         "This work is licensed under the GNU General Public License, version 3.": "GPL"}


def test_query_finds_every_notice(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").collect()
    want = {(r.doc_id, k): LINES[p] for r in docs for k, p in enumerate(r.text.split("\n")) if p in LINES}
    got = {(r.doc_id, r.paragraph): r for r in queries.op7_licenses(spark, SF01).collect()}
    assert want and set(want) <= set(got)
    assert all(got[k].family == f and got[k].confirmed and got[k].similarity == 1.0 for k, f in want.items())
    assert len(got) - len(want) <= 2 and not any(got[k].confirmed for k in set(got) - set(want) if "licen" not in dict(docs)[k[0]].lower())


def test_no_python_in_the_plan(spark):
    plan = queries.op7_licenses(spark, SF01)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_odd_rows_and_held_out_wording(spark):
    d = odd_docs(spark)
    model = licenses.fit(d)
    assert licenses.scan(d, model).count() == 0
    new = [(1, "some text\n\nthis file is licensed under the Apache License version 2.0\nmore of it"), (2, "released under the terms of the MIT license"), (2, None), (3, "LICENSED UNDER CC BY-NC 4.0"),
           (4, "the license of the work is under the version of the terms"), (None, "Licensed under the GNU General Public License, version 3, or later"), (5, "x " * 300_000 + "\nReleased under the MIT License.")]
    out = licenses.scan(spark.createDataFrame(new, "doc_id long, text string"), model).collect()
    got = {(r.doc_id, r.paragraph): (r.family, r.confirmed) for r in out}
    want = {(1, 2): ("Apache-2.0", True), (2, 0): ("MIT", True), (3, 0): ("CC-BY-NC", True), (None, 0): ("GPL", True), (5, 1): ("MIT", True)}
    assert {k: got.get(k) for k in want} == want
    assert not got.get((4, 0), ("", False))[1]


HEADERS = {
    "GPL": """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.""",
    "MIT": """Permission is hereby granted, free of charge, to any person
obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction""",
    "Apache-2.0": """ * Licensed under the Apache License, Version 2.0
 * (the "License"); you may not use
 * this file except in
 * compliance with the License.""",
    "BSD": """Redistribution and use in source and
binary forms, with or without
modification, are permitted provided
that the following conditions are met:"""}


def test_notices_wrapped_over_lines(spark):
    prose = "\n".join(f"line {k} of some plain text about the weather and the harbour" for k in range(30))
    docs = [(k, f"{prose}\n\n{h}\n \t\n{prose}") for k, h in enumerate(HEADERS.values())] + [(10, prose), (11, "one\nReleased under the MIT License.\ntwo"), (11, "one\nReleased under the MIT License.\ntwo")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    out = licenses.scan(d, licenses.fit(d)).where("confirmed").collect()
    for k, (family, text) in enumerate(HEADERS.items()):
        mine = [r for r in out if r.doc_id == k]
        assert {r.family for r in mine} == {family} and all(31 <= r.paragraph < 31 + r.lines + 4 for r in mine)
        whole = [r for r in mine if r.lines > 1]
        assert [(r.paragraph, r.lines) for r in whole] == [(31, text.count("\n") + 1)] or not whole and any(r.lines == 1 for r in mine)
    assert any(r.lines > 1 and r.doc_id == 0 for r in out)
    assert [(r.paragraph, r.lines) for r in out if r.doc_id >= 10] == [(1, 1)] * 2      # the line is found, so its block is not named again


def test_paragraphs_are_lines_and_blocks(spark):
    texts = ["a\nb\n\nc", "", " \n\t", "x", "\n\na\n \nb\nc\n", None, "a\r\nb"]
    got = {}
    for r in licenses.paragraphs(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect():
        got.setdefault(r.doc_id, []).append((r.block, r.paragraph, r.lines, r.text))

    def brute(text):
        lines, out, run = (text or "").split("\n"), [], []
        for i, x in enumerate([*lines, ""]):
            if x.strip():
                run.append(i)
            elif run:
                out += [(run[0], j, 1, lines[j]) for j in run]
                out += [(run[0], run[0], len(run), "\n".join(lines[j] for j in run))] if len(run) > 1 else []
                run = []
        return out
    assert {k: sorted(v) for k, v in got.items()} == {i: sorted(brute(t)) for i, t in enumerate(texts) if brute(t)}


def test_empty_table(spark):
    e = empty_docs(spark)
    assert licenses.scan(e, licenses.fit(e)).count() == 0


def test_every_line_counts(spark):
    """More lines than ``max_negatives``, most of them near a notice: the threshold is that of all, not of a few."""
    line = "released under the rules of the harbour"
    lines = [f"{line} {k}" if k % 50 == 0 else f"plain words {k}" for k in range(6000)]
    docs = spark.createDataFrame([(k, "\n\n".join(lines[k * 60:k * 60 + 60])) for k in range(100)], "doc_id long, text string")
    seen = []
    judge = licenses.LicenseModel.judge

    def spy(self, df):
        if "held" in df.columns:
            seen.append(df.agg({"held": "sum", "trained": "sum"}).first())
        return judge(self, df)
    licenses.LicenseModel.judge = spy
    try:
        licenses.fit(docs, max_negatives=40)
    finally:
        licenses.LicenseModel.judge = judge
    assert seen and seen[0]["sum(held)"] > 1200
