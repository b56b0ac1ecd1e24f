import textwrap

import pytest

from orderstar.llm import licenses
from orderstar.llm.queries import QUERIES

PLANTED = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "CC-BY-NC": "Licensed under CC BY-NC 4.0.",
}


@pytest.fixture(scope="module")
def model(docs):
    return licenses.fit(docs)


def test_query_finds_the_licence_lines_and_no_other(spark, sf_dir, texts):
    wanted = {k: ",".join(sorted(f for f, line in PLANTED.items() if line in t)) for k, t in texts}
    rows = QUERIES["op7_license_scan"](spark, sf_dir).collect()
    assert {r["doc_id"]: r["licences"] for r in rows} == wanted
    assert {r["doc_id"]: r["n_paragraphs"] for r in rows} == {k: t.count("\n") + 1 for k, t in texts}
    assert any(wanted.values())


def test_variants_of_templates_and_unknown_lines(make, model):
    rows = make(
        (1, "some text\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal with it freely."),
        (2, "THIS PROGRAM IS FREE SOFTWARE: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
        (3, "The version of the story is under discussion, and we may not use this in public."),
        (4, "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n* x"),
        (5, "His licence to drive was taken away in general."),
        (6, "Released under the MIT License.\nLicensed under CC BY-NC 4.0."),
    )
    found = {r["doc_id"]: r["licences"] for r in licenses.report(rows, model).collect()}
    assert found == {1: ["MIT"], 2: ["GPL"], 3: [], 4: ["BSD"], 5: [], 6: ["CC-BY-NC", "MIT"]}


def test_all_templates_are_recognised(make, model):
    rows = [(f, s) for f, sentences in licenses.TEMPLATES.items() for s in sentences]
    found = {r["doc_id"]: r["licences"] for r in licenses.report(make(*((i, s) for i, (_, s) in enumerate(rows))), model).collect()}
    assert sum(found[i] == [family] for i, (family, _) in enumerate(rows)) >= 0.9 * len(rows)


def test_odd_rows(odd, odd_rows, empty, model, make):
    rows = licenses.report(odd, model).collect()
    assert len(rows) == len(odd_rows) and not any(r["licences"] for r in rows)
    assert licenses.report(empty, model).count() == 0
    copies = make(*((5, PLANTED["MIT"]) for _ in range(50)))
    assert {(r["n_licensed"], r["licences"][0]) for r in licenses.report(copies, model).collect()} == {(1, "MIT")}


def test_fit_without_documents(empty, make):
    found = licenses.report(make((1, PLANTED["MIT"])), licenses.fit(empty))
    assert found.first()["licences"] == ["MIT"]


WRAPPED = {
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "LGPL": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "GPL": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "AGPL": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
}


def test_wrapped_licence_texts(make, model):
    wanted, rows = {}, []
    for family, text in WRAPPED.items():
        for width in (30, 50, 66, 72, 80):
            for mark in ("", "# ", " * "):
                lines = textwrap.wrap(text, width, initial_indent=mark, subsequent_indent=mark)
                wanted[len(rows)] = [family]
                rows.append((len(rows), "\n".join(["Some title", "", *lines, "", "def f(): pass"])))
    found = {r["doc_id"]: r for r in licenses.report(make(*rows), model).collect()}
    assert {k: r["licences"] for k, r in found.items()} == wanted
    assert all(1 <= r["n_licensed"] <= 3 for r in found.values())
    one = licenses.report(make((1, "\n".join(textwrap.wrap(WRAPPED["ISC"], 70)))), model).first()
    assert one["n_licensed"] == 1 and one["n_paragraphs"] == 4


def test_several_licences_in_one_line(make, model):
    rows = make(
        (1, "Dual licensed under the MIT License and the Apache License, Version 2.0"),
        (2, "Licensed under CC BY 4.0. Licensed under CC BY-SA 4.0."),
        (3, "Licensed under the GNU Lesser General Public License. This work is licensed under the GNU General Public License, version 3"),
        (4, " ".join(PLANTED.values())),
    )
    found = {r["doc_id"]: r["licences"] for r in licenses.report(rows, model).collect()}
    assert found == {1: ["Apache-2.0", "MIT"], 2: ["CC-BY", "CC-BY-SA"], 3: ["GPL", "LGPL"], 4: sorted(PLANTED)}


def test_licences_in_long_texts_without_line_breaks(make, model, texts):
    plain = [t for _, t in texts if not any(line in t for line in PLANTED.values())]
    real = " ".join(" ".join(plain).split()[:3000])
    usual = "at the end of the day, as published by the press in the summer of the year, a copy of the story and the rest of it " * 40
    ask = [(p, f, s) for p in (real, usual) for f, own in licenses.TEMPLATES.items() for s in own]
    rows = [(i, f"{prose} {sentence} {prose}") for i, (prose, _, sentence) in enumerate(ask)]
    rows += [(len(ask), real + real), (len(ask) + 1, usual + usual)]
    every = f" {usual} ".join(own[0] for own in licenses.TEMPLATES.values())
    rows.append((len(ask) + 2, every))
    found = {r["doc_id"]: r["licences"] for r in licenses.report(make(*rows), model).collect()}
    assert {i: found[i] for i in range(len(ask))} == {i: [f] for i, (_, f, _) in enumerate(ask)}
    assert found[len(ask)] == found[len(ask) + 1] == []
    assert found[len(ask) + 2] == sorted(licenses.TEMPLATES)


@pytest.mark.parametrize("before", ["", "word " * 600])
def test_every_line_counts_for_the_threshold(make, before):
    """One line among thousands sets it, whatever its hash, and whatever stands before it."""
    plain = [(i, f"line number {i}\nother {i}") for i in range(4000)]
    templates = {"MIT": ["Released under the MIT License"], "BSD": ["Released under the BSD License"]}
    near = " ".join(["x the MIT y MIT license z released under no terms"] * 6)
    close = [f"{before}case {i} {near}" for i in range(400)]
    lines = make(*enumerate(close)).withColumn("hash", licenses.F.xxhash64("text"))
    last = lines.filter("pmod(hash, 2) = 1").orderBy(licenses.F.desc("hash")).first()["text"]
    quiet = licenses.fit(make(*plain), templates=templates).believed
    assert licenses.fit(make(*plain, (9000, last)), templates=templates).believed > quiet


def test_windows_of_all_lines_are_counted(make):
    rows = [(i, f"line {i % 700}\n\nof the {i % 600}") for i in range(5000)] + [(None, None), (7, "w " * 100)]
    columns = {c: licenses.F.lit(v) for c, v in (("size", 2), ("tells", False))}
    words = licenses.F.xxhash64(licenses.F.lit("of"), licenses.F.lit("the")).alias("gram")
    known = make((1, "")).select(words).withColumns(columns)
    plain, others = licenses._plain_lines(make(*rows), "text", known, 32)
    halves = licenses.F.pmod(licenses.F.xxhash64("text"), licenses.F.lit(2)) == 0
    lines = [f"line {i}" for i in range(700)] + [f"of the {i}" for i in range(600)] + ["w " * 100]
    wanted = sum(2 if r["text"][0] == "w" else 1 for r in make(*enumerate(lines)).filter(halves).collect())
    found = {tuple(r["grams"]): r["n"] for r in licenses._unlike(plain, others, 32).collect()}
    assert plain.count() == 600 and sum(found.values()) == wanted + 1 and len(found) == 2
