from __future__ import annotations

import random

import pytest

from tests.llm.cases import by_id, corpus, documents, empty
from usagemart.llm import licences


def prose(spark):
    dice = random.Random(8)
    words = ["the", "of", "and", "in", "a", "to", "is", "work", "version", "see"] + [f"w{i}" for i in range(400)]
    texts = ["\n".join(" ".join(dice.choices(words, k=12)) for _ in range(6)) for _ in range(80)]
    return texts


@pytest.fixture(scope="module")
def model(spark):
    return licences.learn(documents(spark, prose(spark)))


def test_families_in_prose(spark, model):
    texts, wanted = prose(spark), {}
    for i, (family, listed) in enumerate(licences.TEMPLATES.items()):
        texts[i] += "\n" + listed[0]
        wanted[10_000_000 + i] = family if family != "unknown" else ""
    got = by_id(licences.by_document(documents(spark, texts), model).collect())
    found = {i: r.families for i, r in got.items()}
    right = sum(found[i] == family for i, family in wanted.items())
    assert right >= len(wanted) - 1
    others = [r for i, r in got.items() if i not in wanted]
    assert sum(r.n_paragraphs for r in others) <= 1


@pytest.mark.parametrize("text, families, unknown", [
    ("Licensed under the Apache License, Version 2.0", "apache", 0),
    ("first line\nReleased under the MIT License.\nAll rights reserved.", "mit,reserved", 0),
    ("This software is licensed under the terms of a separate agreement.", "", 1),
    ("This work is licensed under a separate agreement.", "", 1),
    ("no such thing here", "", 0), ("", "", 0), (None, "", 0)])
def test_confirmed_and_unknown(spark, model, text, families, unknown):
    row = licences.by_document(documents(spark, [text]), model).first()
    assert (row.families, row.n_unknown) == (families, unknown)


def test_expressions_equal_a_plain_version(spark, model):
    """Scores of all paragraphs, worked out in Python from the same weights."""
    rows = corpus(spark).persist()
    got = {(r.doc_id, r.at): r.guess for r in licences.scan(rows, model).selectExpr(
        "doc_id", "at", "if(confirmed, family, 'unknown') AS guess").collect()}
    import regex
    split = regex.compile(r"[^\p{L}\p{N}]+")
    for row in rows.dropDuplicates(["doc_id"]).collect():
        for at, line in enumerate((row.text or "").split("\n")):
            words = [w for w in split.split(line.lower()) if w]
            grams = {*words, *(f"{a} {b}" for a, b in zip(words, words[1:]))} & model.weights.keys()
            scores = [b + sum(model.weights[g][c] for g in grams) for c, b in enumerate(model.intercepts)]
            plain = not grams or licences.LABELS[scores.index(max(scores))] == licences.NONE
            assert ((row.doc_id, at) in got) == (not plain)


def test_empty_table(spark, model):
    assert licences.by_document(empty(spark), licences.learn(empty(spark))).collect() == []
    assert licences.by_document(corpus(spark), model).count() == corpus(spark).count()


def test_main_path_stays_in_the_jvm(spark, model):
    plan = licences.scan(corpus(spark), model)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))


def test_a_copied_paragraph_counts_once(spark):
    rows = documents(spark, ["the same line in every text here"] * 300 + [f"line number w{i} of its own" for i in range(300)])
    listed = [tuple(r.words) for r in licences.training_rows(rows, 200).where("label = 13").collect()]
    assert len(listed) == len(set(listed)) == 200


# Headers as they stand in files; families by the licence they name.
HEADERS = {
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software""",
    "bsd": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: redistributions of source code must retain the above copyright notice""",
    "gpl": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
version.""",
    "lgpl": """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General
Public License as published by the Free Software Foundation; either version 2.1 of the License""",
    "apache": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0""",
    "mpl": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
}
STYLES = {"plain": ("", "", "", ""), "hash": ("", "# ", "", ""), "slashes": ("", "// ", "", ""),
          "stars": ("/*", " * ", "", " */"), "box": ("/****", " ** ", " **", " ****/")}


def wrapped(text, width, style):
    import textwrap
    first, before, _, last = STYLES[style]
    lines = textwrap.wrap(" ".join(text.split()), width)
    return "\n".join(filter(None, [first, *(before + line for line in lines), last]))


@pytest.mark.parametrize("width", [50, 72])
def test_wrapped_headers_are_found(spark, model, width):
    texts, wanted = [], []
    for family, text in HEADERS.items():
        for style in STYLES:
            texts.append("w1 w2 w3 w4 w5 w6\nw7 w8 the of\n\n" + wrapped(text, width, style) + "\n\nw9 w10 in the w11")
            wanted.append(family)
    got = by_id(licences.by_document(documents(spark, texts), model).collect())
    found = [got[10_000_000 + i].families.split(",") for i in range(len(texts))]
    assert [(w, f) for w, f in zip(wanted, found) if w not in f] == []
    assert sum(len(f) > 1 for f in found) <= 0.1 * len(found)


def test_paraphrases_and_prose(spark, model):
    texts = ["You may use all of this code\nunder the MIT\nLicense, as its authors wish.",
             "This book and its figures: this work is\nlicensed under a Creative Commons\nAttribution-ShareAlike 4.0 "
             "International\nlicence by its author.",
             "The committee gave permission for\nthe new building, and nobody\nreserved any rights to object."]
    got = by_id(licences.by_document(documents(spark, texts), model).collect())
    assert [got[10_000_000 + i].families for i in range(3)] == ["mit", "cc-by-sa", ""]


def test_blocks_of_odd_texts(spark):
    rows = documents(spark, ["license one\ntwo\n\n\nthree\r\n copyright four \n", "license alone", "# license\n#\n# x\n# y",
                             "copyright\n" + "word " * 20_000 + "\nend"])
    found = sorted((r.doc_id - 10_000_000, r.at, r.last, " ".join(r.words)[:25]) for r in licences.blocks(rows).collect())
    assert found == [(0, 0, 1, "license one two"), (0, 4, 5, "three copyright four"),
                     (3, 0, 2, "copyright word word word ")]
