"""License scan against brute-force phrase places and known notices."""

from __future__ import annotations

import pkgutil
import random
import re
import time

import pytest

from tidewater.llm import licenses, queries

SF = "/root/testdata/sf0.001"
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def brute(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    hits = [(i, label) for p, label in PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    starts = [i for i, _ in hits]
    return len(words), len(hits), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in hits}))


NOTICES = {
    "apache-2.0": "x Licensed under the Apache License, Version 2.0.", "cc-by-nc": "Licensed under CC BY-NC 4.0.",
    "mit": "Released under the MIT License.", "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
}


def query(spark, rows, monkeypatch):
    docs = spark.createDataFrame([(*r, 3, [1.0]) for r in rows], "doc_id long, text string, n_words int, places array<double>")
    monkeypatch.setattr(queries, "documents", lambda *_: docs.repartition(3))
    return queries.op2_license_scan(spark, "").collect()


def test_places_match_brute_force(spark, monkeypatch):
    rng = random.Random(2)
    pool = ["cc", "by", "CC-BY", "all", "rights", "Reserved", "general", "public", "license", "ALL rights reserved", "été", "x1", "\x00"]
    texts = [None, "", "  ", "cc by", "cc by cc by", "ccby", "all rights, reserved;all RIGHTS reserved", "cc " * 20_000 + "by"]
    texts += ["".join(rng.choice(pool) + rng.choice([" ", "-", "\n", ". "]) for _ in range(rng.randint(0, 60))) for _ in range(150)]
    rows = [*enumerate(texts), (3, "cc by"), (None, "all rights reserved")]
    got = query(spark, rows, monkeypatch)
    cols = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert sorted((tuple(r[c] for c in cols) for r in got), key=str) == sorted(((d, *brute(t)) for d, t in rows), key=str)
    assert all(set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1 for r in got)


def test_notices_are_found_and_scattered_words_are_not(spark, monkeypatch):
    rows = [(k, "some words before. " + t + " and after") for k, t in enumerate(NOTICES.values())]
    rows += [(10, "the license of the public version under mit apache gnu released licensed"), (11, "Licenced under Apache License, Version 2.0")]
    rows += [(12, "Released, under the old MIT License"), (13, "version 3 of the work, licensed under the GNU General Private License")]
    got = {r["doc_id"]: (r["labels"].split(","), r["score"]) for r in query(spark, rows, monkeypatch)}
    for k, label in enumerate(NOTICES):
        assert label in got[k][0] and got[k][1] == 1.0
    assert got[10] == ([""], 0.0) and got[13] == ([""], 0.0)
    assert got[11][0] == ["apache-2.0"] and 0 < got[11][1] < 1


def test_empty_table(spark, monkeypatch):
    assert query(spark, [], monkeypatch) == []


def test_query_on_the_tables(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    cols = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    got = queries.op2_license_scan(spark, SF).collect()
    assert {tuple(r[c] for c in cols) for r in got} == {(r["doc_id"], *brute(r["text"])) for r in rows}
    assert any(r["n_base"] for r in got)
    notices = [r["doc_id"] for r in rows if "Apache License, Version 2.0" in r["text"]]
    assert all("apache-2.0" in r["labels"] for r in got if r["doc_id"] in notices)


BASE = {"cc-by", "gpl", "reserved"}


def named(texts):
    """Labels of each text beside the base phrases', over an index of plain frequencies."""
    vocabulary = {w for t in licenses.PHRASES + licenses.NOTICES for x in (t.text, *t.headings) for w in licenses.split(x)}
    vocabulary |= {w for b in licenses.BODIES for w in licenses.body_words(b.file)}
    index = licenses.Index(licenses.PHRASES + licenses.NOTICES, dict.fromkeys(vocabulary, 1.0), licenses.BODIES)
    return [(index.scan(licenses.split(t))[1] - (BASE - {"cc-by"}), index.scan(licenses.split(t))[2]) for t in texts]


def body(file):
    return pkgutil.get_data("tidewater.llm", f"license_texts/{file}.txt").decode()


def test_whole_licences_are_found_and_those_they_cite_are_not():
    rng = random.Random(4)
    words = ["alpha", "beta", "license", "the", "of", "software", "copy", "and"]
    noise = lambda n: " ".join(rng.choice(words) for _ in range(n))
    files = sorted({b.file for b in licenses.BODIES})
    for file, (labels, score) in zip(files, named(f"{noise(300)}\n{body(f)}\n{noise(300)}" for f in files), strict=True):
        want = {"cc-by-sa-4.0": {"cc-by-sa"}, "bsd-2-clause": {"bsd", "bsd-2-clause"}, "bsd-3-clause": {"bsd", "bsd-3-clause"}}
        assert labels == want.get(file, {file}) and score > 0.9, file
    # names put in, and a line lost
    mit = body("mit").replace("<year> <copyright holders>", "2020 A. Person and others").replace("AUTHORS OR COPYRIGHT HOLDERS", "AUTHORS OF THIS PROGRAM")
    bsd = body("bsd-3-clause").replace("University", "Example Company of Somewhere, Inc.")
    agpl = body("gpl-3.0").replace("GNU GENERAL PUBLIC LICENSE", "GNU AFFERO GENERAL PUBLIC LICENSE", 1).replace("29 June", "19 November")
    agpl = agpl.replace("13. Use with the GNU Affero", "13. Remote Network Interaction; Use with the GNU")
    nc = body("cc-by-sa-4.0").replace("Attribution-ShareAlike", "Attribution-NonCommercial")
    got = [labels for labels, _ in named([mit.split("\n", 2)[2], bsd, agpl, nc, " ".join(body("apache-2.0").split()[400:700])])]
    assert got == [{"mit"}, {"bsd", "bsd-3-clause"}, {"agpl-3.0"}, {"cc-by-nc"}, set()]


GNU = "under the terms of the GNU {} as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
SHORT = {
    "MIT License": {"mit"}, "# The MIT License (MIT)": {"mit"}, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software": {"mit"},
    "ISC License": {"isc"}, "BSD 3-Clause License": {"bsd-3-clause"}, "GNU GENERAL PUBLIC LICENSE Version 2": {"gpl-2.0"}, "GNU Lesser General Public License v2.1": {"lgpl-2.1"},
    "you can redistribute it " + GNU.format("General Public License", "3"): {"gpl-3.0"}, "you can redistribute it " + GNU.format("General Public License", "2"): {"gpl-2.0"},
    "modify it " + GNU.format("Lesser General Public License", "2.1"): {"lgpl-2.1"}, "modify it " + GNU.format("Affero General Public License", "3"): {"agpl-3.0"},
    "Mozilla Public License Version 2.0": {"mpl-2.0"}, "CC0 1.0 Universal": {"cc0-1.0"}, "under CC BY-NC-SA 4.0": {"cc-by", "cc-by-nc-sa"}, "CC BY-NC": {"cc-by", "cc-by-nc"},
    "a Creative Commons Attribution-ShareAlike 4.0 International License": {"cc-by-sa"}, "Creative Commons Attribution 4.0 International": {"cc-by"},
    "the license of MIT": set(), "version 3 of some public license": set(), "fahrt mit license": {"mit"}, "permission is granted": set(),
}


def test_headings_and_standard_headers():
    for (text, want), (labels, score) in zip(SHORT.items(), named(f"x y {t}, and z" for t in SHORT), strict=True):
        assert labels == want and (score > 0) == bool(want), text


def test_whole_licences_in_the_query(spark, monkeypatch):
    got = query(spark, [(1, body("mpl-2.0")), (2, "MIT License"), (3, "plain words"), (4, body("mit"))], monkeypatch)
    assert {r["doc_id"]: r["labels"] for r in got} == {1: "gpl,mpl-2.0", 2: "mit", 3: "", 4: "mit"}


@pytest.mark.parametrize("word", ["any", "license", "software", "copyright", "the", "gpl", "general public", "permission is hereby"])
def test_a_megabyte_of_licence_words_is_scanned_in_linear_time(word):
    vocabulary = {w for t in licenses.PHRASES + licenses.NOTICES for s in (t.text, *t.headings) for w in licenses.split(s)}
    vocabulary |= {w for b in licenses.BODIES for w in licenses.body_words(b.file)}
    index = licenses.Index(licenses.PHRASES + licenses.NOTICES, dict.fromkeys(vocabulary, 5.0), licenses.BODIES)
    took = []
    for size in (250_000, 1_000_000):
        words = licenses.split((word + " ") * (size // (len(word) + 1)))
        start = time.process_time()
        index.scan(words)
        took.append(time.process_time() - start)
    assert took[1] < 15 and took[1] < 8 * max(took[0], 0.2)


def test_words_of_equal_frequency_are_told_apart_by_templates():
    templates = tuple(licenses.Template(f"t{k}", f"any thing of kind{k} here", ()) for k in range(40))
    words = {w for t in templates for w in licenses.split(t.text)}
    index = licenses.Index(templates, dict.fromkeys(words, 3.0), ())
    assert all(len(index.postings[b"kind%d" % k]) == 1 for k in range(40))
    assert licenses.split("any")[0] in index.postings  # there are but few words to choose from
    found = index.scan(licenses.split("so any thing of kind7 here, and any thing of kind9 there"))
    assert {"t7", "t9"} <= found[1]
