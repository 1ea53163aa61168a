import pytest

import __spark_entry__ as entry
from fleetlens.llm import licenses
from fleetlens.llm.common import ready
from fleetlens.llm.license_texts import FAMILIES


@pytest.fixture(scope="module")
def model():
    return licenses.train(["the cat sat on the mat and looked at the river for a while", "this is free text about software",
                           "you may read the list of things in the house", "all of the work is done here"] * 20)


def test_notices_are_recognised(model):
    for family, notices in FAMILIES.items():
        for n in notices:
            got = list(licenses.spans(model, n.format(year="2020", holder="Somebody"), 0.75))
            assert [(g[2], g[5]) for g in got] == [(family, True)], n


@pytest.mark.parametrize("text", ["the license of the house is under the bed", "of the and to in this work", "", "\n\n",
                                  "He is licensed to drive under the new law of the land."])
def test_other_text_is_not_confirmed(model, text):
    assert not any(g[5] for g in licenses.spans(model, text, 0.75))


def test_notice_within_a_long_line(model):
    line = "word " * 400 + "Licensed under the Apache License, Version 2.0. " + "word " * 400
    got = [g for g in licenses.spans(model, line, 0.75) if g[5]]
    assert [g[2] for g in got] == ["Apache-2.0"] and "Apache License" in line[got[0][0]:got[0][1]]


def test_no_word_is_skipped(model):
    """Brute force: every paragraph classified, without the shortcut for those that hold no notice bigram."""
    text = "\n".join([*("plain line %d of the text" % k for k in range(30)), *(n.format(year="1", holder="x") for v in FAMILIES.values() for n in v)])
    want = []
    for a, z in licenses.paragraphs(text):
        w = licenses.words_of(text[a:z])
        k, _ = model.classify(w)
        if model.classes[k] != licenses.UNKNOWN and model.similarity(k, w) >= 0.75:
            want.append((a, z, model.classes[k]))
    assert [g[:3] for g in licenses.spans(model, text, 0.75) if g[5]] == want


def test_odd_rows(spark, messy, nothing):
    out = licenses.scan(messy)
    assert out.count() == messy.count() and out.where("notices is null").count() == 0
    assert licenses.scan(nothing).count() == 0
    df = ready(spark).createDataFrame([(1, "Prose.\nReleased under the MIT License.\nMore prose."), (1, None)], "doc_id long, text string")
    rows = licenses.scan(df).collect()
    assert sorted(len([n for n in r["notices"] if n["confirmed"]]) for r in rows) == [0, 1]


MIT = ["Copyright (c) 2020 Somebody", "", "Permission is hereby granted, free of charge, to any person obtaining a copy",
       'of this software and associated documentation files (the "Software"), to deal', "in the Software without restriction, including without limitation the rights"]
GPL = ["This program is free software: you can redistribute it and/or modify", "it under the terms of the GNU General Public License as published by",
       "the Free Software Foundation, either version 3 of the License, or", "(at your option) any later version."]
BSD = ["Copyright (c) 2020, Somebody", "All rights reserved.", "", "Redistribution and use in source and binary forms, with or without",
       "modification, are permitted provided that the following conditions are met:"]


@pytest.mark.parametrize("mark", ["", "# ", " * ", "// ", "dnl ", "REM "])
@pytest.mark.parametrize("family, lines", [("MIT", MIT), ("GPL", GPL), ("BSD", BSD)])
def test_notices_wrapped_over_lines(model, mark, family, lines):
    text = "\n".join(["int main() {}", "", *(mark + x for x in lines), "", "more of the code"])
    got = [g for g in licenses.spans(model, text, 0.75) if g[5]]
    assert [g[2] for g in got] == ["proprietary"] * (family == "BSD") + [family]
    a, z = got[-1][:2]
    assert text[a:z].count("\n") == sum(bool(x) for x in lines) - (3 if family == "BSD" else 2 if family == "MIT" else 1)


def test_two_licences_in_one_line(model):
    a, b = "Licensed under the Apache License, Version 2.0.", "Released under the MIT License."
    for gap in (0, 2, 20, 38, 60, 200):
        for before in (0, 100):
            line = "word " * before + a + " " + "word " * gap + b + " word" * before
            got = [(line[g[0]:g[1]], g[2]) for g in licenses.spans(model, line, 0.75) if g[5]]
            assert [f for _, f in got] == ["Apache-2.0", "MIT"] or (not gap and sorted(f for _, f in got) == ["Apache-2.0", "MIT"]), (gap, before)
            assert "Apache License" in dict((f, t) for t, f in got)["Apache-2.0"]
            assert "the MIT License" in dict((f, t) for t, f in got)["MIT"]


def test_many_notices_in_one_block(model):
    """Every one is found, in time linear in their number."""
    text = "\n".join(f"line {k}\n" + "\n".join(GPL if k % 2 else MIT[2:]) for k in range(1500))
    got = [g[2] for g in licenses.spans(model, text, 0.75) if g[5]]
    assert got == ["MIT", "GPL"] * 750


def test_a_licence_goes_before_a_reservation(spark, tmp_path):
    rows = [(1, "\n".join(BSD)), (2, "Prose.\nAll rights reserved."), (3, "Prose."), (4, "\n".join("# " + x for x in MIT))]
    ready(spark).createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r["family"] for r in entry.queries()["op4_licenses"](spark, str(tmp_path)).collect()}
    assert got == {1: "BSD", 2: "proprietary", 3: "none", 4: "MIT"}
