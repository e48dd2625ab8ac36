"""License scan with a positional index of rare words.

Templates of notices, and bare phrases, are indexed by the places of their rarest
words; how rare a word is comes from its document frequency over the whole corpus
(inverse document frequency, IDF), and among words of one frequency, of which most
are in no document, from the number of templates that have it. A file's words that the index lists are looked
up, rarest first; every posting proposes an alignment of a template (place in the
file less place in the template), and alignments that enough of the template's
rare words agree on are candidates. A candidate counts if enough of the
template's words stand in their relative places and its mandatory key phrases
stand whole within it.

A phrase is a template that consists of one key phrase, and any of its places
holds its rarest word, so no place is lost. A heading ("MIT License") is such a
phrase too: it gives its template's label by itself, with the share of the
template's words that it has as its score.

Whole licences are cut into pieces of a few lines, which are indexed like notices,
so inserted names or lost lines cost one piece only. A licence counts if its pieces
that were found hold enough of its words and its key phrases stand whole between
the first and the last of them. Notices and headings of other licences within that
stretch are citations and do not count.

The index has a few words per template or piece and is broadcast; its size is that
of the templates, which are a parameter.

Defined results: null and empty texts have no words, no labels and score zero;
repeated rows each get a row; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import math
import pkgutil
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words are 0-9, a-z (capitals lower-cased first) and everything outside ASCII.
TABLE = bytes(
    x + 32 if 65 <= x <= 90 else x if 48 <= x <= 57 or 97 <= x <= 122 or x >= 128 else 32 for x in range(256)
)
RARE_WORDS = 3
AGREE = 2
SHARE = 0.6
SLACK = 2
PIECE = 32  # words of a licence that are placed together
STRETCH = 1 << 16  # places of a text whose alignments are counted at a time


def split(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(TABLE).split()


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    phrases: tuple[str, ...]  # all must stand whole within a candidate
    base: bool = False  # a bare phrase: its places are counted and spanned
    headings: tuple[str, ...] = ()  # any of them counts by itself
    unless: tuple[str, ...] = ()  # none may stand within a candidate


@dataclass(frozen=True)
class Body:
    """A whole licence; ``file`` may hold a sister licence that shares most words."""

    label: str
    file: str
    phrases: tuple[str, ...]
    unless: tuple[str, ...] = ()


# The contract's phrases and labels.
PHRASES = (
    Template("cc-by", "cc by", ("cc by",), base=True),
    Template("gpl", "general public license", ("general public license",), base=True),
    Template("reserved", "all rights reserved", ("all rights reserved",), base=True),
)
HEADER = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0} as published by the Free Software Foundation, either version {1} of the License, or (at your option) any later version."
FAMILY = "This work is licensed under a Creative Commons Attribution-{0} 4.0 International License"


def _gnu(label: str, name: str, version: str) -> tuple[Template, ...]:
    """The standard header of a GNU licence, its one-version form, and its headings."""
    n, v = f"gnu {name.lower()}", " ".join(version.split("."))
    only = HEADER.split(" as published")[0].format(name) + f" version {version} as published by the Free Software Foundation."
    return (
        Template(label, HEADER.format(name, version), (f"{n} as published by the free software foundation", f"version {v} of the license")),
        Template(label, only, (f"{n} version {v} as published by the free software foundation",)),
        Template(label, f"This work is licensed under the GNU {name}, version {version}", (n, f"version {v}"), headings=(f"{n} version {v}", f"{n} v{v}")),
    )


def _family(label: str, name: str, short: str, unless: tuple[str, ...] = ()) -> tuple[Template, ...]:
    """The usual notices of a Creative Commons licence, and its names as headings."""
    long = " ".join(w.decode() for w in split(f"creative commons attribution {name}"))
    brief = " ".join(w.decode() for w in split(short))
    longer = tuple(f"{long} {u}" for u in ("sharealike", "noderivatives", "noderivs", "noncommercial") if u not in name.lower())
    return (
        Template(label, f"Licensed under {short} 4.0", (brief,), headings=(brief,), unless=tuple(f"{brief} {u}" for u in unless)),
        Template(label, FAMILY.format(name), (long,), headings=(long,), unless=longer),
    )


#: Short notices, in the usual wording of each licence, and standard headers.
NOTICES = (
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0", ("apache license version 2 0",), headings=("apache license version 2 0",)),
    Template("apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0', ("apache license version 2 0", "in compliance with the license")),
    *_family("cc-by-nc", "NonCommercial", "CC BY-NC", ("sa", "nd")),
    *_family("cc-by-sa", "ShareAlike", "CC BY-SA"),
    *_family("cc-by-nd", "NoDerivatives", "CC BY-ND"),
    *_family("cc-by-nc-sa", "NonCommercial-ShareAlike", "CC BY-NC-SA"),
    *_family("cc-by-nc-nd", "NonCommercial-NoDerivatives", "CC BY-NC-ND"),
    Template("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License", ("creative commons attribution 4 0",), headings=("creative commons attribution 4 0",)),
    Template("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work. CC0 1.0 Universal", ("waived all copyright and related or neighboring rights",), headings=("cc0 1 0",)),
    *_gnu("gpl-3.0", "General Public License", "3"),
    *_gnu("gpl-2.0", "General Public License", "2"),
    *_gnu("lgpl-3.0", "Lesser General Public License", "3"),
    *_gnu("lgpl-2.1", "Lesser General Public License", "2.1"),
    *_gnu("agpl-3.0", "Affero General Public License", "3"),
    Template("mit", "Released under the MIT License", ("mit license",), headings=("mit license",)),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", ("permission is hereby granted free of charge",), headings=("permission is hereby granted free of charge to any person obtaining a copy of this software",)),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", ("for any purpose with or without fee is hereby granted",), headings=("isc license",)),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted", ("redistribution and use in source and binary forms",), headings=("bsd license",)),
    Template("bsd-2-clause", "Released under the BSD 2-Clause License", ("bsd 2 clause",), headings=("bsd 2 clause", "2 clause bsd license")),
    Template("bsd-3-clause", "Released under the BSD 3-Clause License", ("bsd 3 clause",), headings=("bsd 3 clause", "3 clause bsd license")),
    Template("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License", ("mozilla public license",), headings=("mozilla public license version 2 0", "mozilla public license v 2 0", "mozilla public license 2 0")),
)

BSD = ("redistribution and use in source and binary forms", "redistributions in binary form must reproduce")
GNU = ("everyone is permitted to copy and distribute verbatim copies", "terms and conditions")
CREATIVE = "creative commons attribution {0}4 0 international public license"
#: Whole licences. AGPL-3.0 is looked for with the text of GPL-3.0, and the Creative
#: Commons family with that of CC BY-SA 4.0; the key phrases tell them apart.
BODIES = (
    Body("apache-2.0", "apache-2.0", ("apache license version 2 0", "grant of patent license", "submission of contributions")),
    Body("mit", "mit", ("permission is hereby granted free of charge", "the software is provided as is")),
    Body("isc", "isc", ("for any purpose with or without fee is hereby granted", "the software is provided as is")),
    Body("bsd-2-clause", "bsd-2-clause", BSD, ("neither the name", "all advertising materials")),
    Body("bsd-3-clause", "bsd-3-clause", (*BSD, "neither the name"), ("all advertising materials",)),
    Body("gpl-2.0", "gpl-2.0", (*GNU, "version 2 june 1991", "gnu general public license")),
    Body("gpl-3.0", "gpl-3.0", (*GNU, "version 3 29 june 2007", "gnu general public license")),
    Body("agpl-3.0", "gpl-3.0", (*GNU, "version 3 19 november 2007", "remote network interaction", "gnu affero general public license")),
    Body("lgpl-2.1", "lgpl-2.1", (*GNU, "version 2 1 february 1999", "gnu lesser general public license")),
    Body("lgpl-3.0", "lgpl-3.0", (GNU[0], "version 3 29 june 2007", "gnu lesser general public license", "combined works")),
    Body("mpl-2.0", "mpl-2.0", ("covered software", "secondary licenses", "source code form")),
    Body("cc0-1.0", "cc0-1.0", ("copyright and related rights", "public license fallback", "affirmer")),
    Body("cc-by", "cc-by-sa-4.0", (CREATIVE.format(""), "licensed material")),
    Body("cc-by-sa", "cc-by-sa-4.0", (CREATIVE.format("sharealike "), "licensed material")),
    Body("cc-by-nc", "cc-by-sa-4.0", (CREATIVE.format("noncommercial "), "licensed material")),
    Body("cc-by-nd", "cc-by-sa-4.0", (CREATIVE.format("noderivatives "), "licensed material")),
    Body("cc-by-nc-sa", "cc-by-sa-4.0", (CREATIVE.format("noncommercial sharealike "), "licensed material")),
    Body("cc-by-nc-nd", "cc-by-sa-4.0", (CREATIVE.format("noncommercial noderivatives "), "licensed material")),
)


@functools.cache
def body_words(file: str) -> tuple[bytes, ...]:
    """The words of a licence text that lies beside this module, also in an archive."""
    data = pkgutil.get_data("tidewater.llm", f"license_texts/{file}.txt")
    return tuple(split(data.decode()))


def _stands(phrase: list[bytes], words: list[bytes]) -> bool:
    """Whether ``phrase`` stands whole in ``words``."""
    return any(words[i : i + len(phrase)] == phrase for i in range(len(words) - len(phrase) + 1))


class Index:
    """Postings of the rarest words of each template, heading and piece."""

    def __init__(self, templates: tuple[Template, ...], idf: dict[bytes, float], bodies: tuple[Body, ...] = ()):
        self.templates = templates
        self.idf = idf
        self.bodies = bodies
        self.words: list[list[bytes]] = []
        self.exact: list[bool] = []  # found at places of the whole text only
        self.owner: list[int] = []  # template, or -1 for a piece
        self.need: list[int] = []
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        files = {file: list(body_words(file)) for file in dict.fromkeys(b.file for b in bodies)}
        units = [(split(t.text), t.base, k) for k, t in enumerate(templates)]
        units += [(split(heading), True, k) for k, t in enumerate(templates) for heading in t.headings]
        self.pieces: dict[str, list[int]] = {}
        for file, words in files.items():
            parts = [words[i : i + PIECE] for i in range(0, len(words), PIECE)]
            self.pieces[file] = list(range(len(units), len(units) + len(parts)))
            units += [(part, False, -1) for part in parts]
        # of words that the corpus has equally often, those that fewer units have tell more
        self.held = Counter(w for words, _, _ in units for w in set(words))
        for words, exact, owner in units:
            self._add(words, exact, owner)
        self.length = [len(split(t.text)) for t in templates]
        self.phrases = [[split(p) for p in t.phrases] for t in templates]
        self.unless = [[split(p) for p in t.unless] for t in templates]
        self.body_phrases = [[split(p) for p in b.phrases] for b in bodies]
        self.body_unless = [[split(p) for p in b.unless] for b in bodies]

    def _add(self, words: list[bytes], exact: bool, owner: int) -> None:
        unit = len(self.words)
        rare = sorted(set(words), key=self._rarity)[: 1 if exact else RARE_WORDS]
        self.words.append(words)
        self.exact.append(exact)
        self.owner.append(owner)
        self.need.append(min(AGREE, len(rare)))
        for q, w in enumerate(words):
            if w in rare:
                self.postings[w].append((unit, q))

    def _rarity(self, word: bytes) -> tuple[float, int, bytes]:
        return -self.idf[word], self.held[word], word

    def _alignments(self, words: list[bytes]) -> Iterator[tuple[int, int]]:
        """(unit, place) of the alignments that enough of the unit's rare words agree
        on, for a stretch of ``STRETCH`` places after another: what is held at a time
        is bounded, however often a text repeats a word of the index."""
        places: dict[bytes, list[int]] = defaultdict(list)
        for p, w in enumerate(words):
            if w in self.postings:
                places[w].append(p)
        if not places:
            return
        found = [(np.array(places[w]), self.postings[w]) for w in sorted(places, key=self._rarity)]
        need = np.array(self.need)
        longest = max(q for _, postings in found for _, q in postings)
        for low in range(-longest, len(words), STRETCH):
            votes = []
            for at, postings in found:
                mine = []
                for unit, q in postings:
                    a, z = np.searchsorted(at, (low + q, low + q + STRETCH))
                    if a < z:
                        mine.append((at[a:z] - (q + low)) + unit * STRETCH)
                if mine:
                    votes.append(np.unique(np.concatenate(mine)))
            if votes:
                codes, n = np.unique(np.concatenate(votes), return_counts=True)
                codes = codes[n >= need[codes // STRETCH]]
                yield from zip((codes // STRETCH).tolist(), (codes % STRETCH + low).tolist(), strict=True)

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str], float]:
        """((template, place) of every phrase, labels of all that was found, best
        share of a template's or licence's words)."""
        found, named, parts = [], [], defaultdict(list)
        for unit, at in sorted(self._alignments(words)):
            k, size = self.owner[unit], len(self.words[unit])
            same = self._same(unit, at, words)
            if not same:
                continue
            if k < 0:
                parts[unit].append((at, same))
            elif self.templates[k].base:
                found.append((k, at))
                named.append((at, at + size, self.templates[k].label, 1.0, True))
            elif self._holds(words[max(0, at - SLACK) : at + size + SLACK], [] if self.exact[unit] else self.phrases[k], self.unless[k]):
                named.append((at, at + size, self.templates[k].label, min(1.0, same / self.length[k]), False))
        whole = self._licences(parts, words) if parts else []
        labels, score = {label for _, _, label, _ in whole}, max((share for *_, share in whole), default=0.0)
        for a, z, label, share, base in named:  # "bsd" names bsd-3-clause too
            if base or not any(low <= a and z <= high and not other.startswith(label) for low, high, other, _ in whole):
                labels.add(label)
                score = max(score, share)
        return found, labels, score

    def _same(self, unit: int, at: int, words: list[bytes]) -> int:
        """How many words of the unit stand in their places, zero if too few."""
        mine = self.words[unit]
        if self.exact[unit]:
            return len(mine) if at >= 0 and words[at : at + len(mine)] == mine else 0
        same = sum(0 <= at + q < len(words) and words[at + q] == w for q, w in enumerate(mine))
        return same if same >= SHARE * len(mine) else 0

    @staticmethod
    def _holds(window: list[bytes], phrases: list[list[bytes]], unless: list[list[bytes]]) -> bool:
        return all(_stands(p, window) for p in phrases) and not any(_stands(p, window) for p in unless)

    def _licences(self, parts: dict[int, list[tuple[int, int]]], words: list[bytes]) -> list[tuple[int, int, str, float]]:
        """(start, end, label, share) of each whole licence. Its copies in one file
        make one stretch."""
        out = []
        for k, body in enumerate(self.bodies):
            pieces = [u for u in self.pieces[body.file] if u in parts]
            share = sum(max(same for _, same in parts[u]) for u in pieces) / len(body_words(body.file)) if pieces else 0.0
            if share < SHARE:
                continue
            # the first and the last piece may differ from the text, titles most of all
            low = max(0, min(at for u in pieces for at, _ in parts[u]) - PIECE)
            high = max(at for u in pieces for at, _ in parts[u]) + 2 * PIECE
            if self._holds(words[low:high], self.body_phrases[k], self.body_unless[k]):
                out.append((low, high, body.label, share))
        return out


def _frequencies(docs: DataFrame, vocabulary: frozenset[bytes]) -> dict[bytes, float]:
    """IDF of the templates' words over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n: Counter[bytes] = Counter()
            for t in b.column("text"):
                n.update(vocabulary.intersection(split(t.as_py())))
            n[b""] = b.num_rows
            yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.binary()), pa.array(list(n.values()), pa.int64())], ["word", "n"])

    counts = docs.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    n = {bytes(r["word"]): r["n"] for r in counts.collect()}  # one row per word of the templates
    return {w: math.log((1 + n.get(b"", 0)) / (1 + n.get(w, 0))) for w in vocabulary}


def scan_licenses(
    docs: DataFrame, templates: tuple[Template, ...] = PHRASES + NOTICES, bodies: tuple[Body, ...] = BODIES
) -> DataFrame:
    """doc_id, n_words, places (label, start of every phrase), labels, score."""
    vocabulary = frozenset(w for t in templates for s in (t.text, *t.headings) for w in split(s))
    vocabulary |= {w for b in bodies for w in body_words(b.file)}
    index = Index(templates, _frequencies(docs, vocabulary), bodies)
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        kind = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64())]))
        for b in batches:
            n, places, labels, scores = [], [], [], []
            for t in b.column("text"):
                words = split(t.as_py())
                found, named, score = index.scan(words)
                n.append(len(words))
                places.append([{"label": index.templates[k].label, "start": at} for k, at in found])
                labels.append(sorted(named))
                scores.append(score)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(places, kind), pa.array(labels, pa.list_(pa.string())), pa.array(scores, pa.float64())],
                ["doc_id", "n_words", "places", "labels", "score"],
            )

    schema = "doc_id long, n_words long, places array<struct<label:string,start:long>>, labels array<string>, score double"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)
