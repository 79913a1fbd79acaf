"""License scan: a positional index of rare licence words.

The templates (short licence notices below) are split into words; a word's inverse
document frequency counts the templates that hold it. A template is posted under its
highest-IDF words only, just so many that a file without any of them lacks more weight
than an accepted template may lack. A file's words look up these postings; each names a
relative position (place in the file minus place in the template), and the weights of
all template words that agree on it are added up, so a template that stands in the file
gathers nearly its whole weight at one offset. Offsets within ``SLIP`` words of each other support each other (a word put in
or left out). A template is accepted if the share of its weight that is found reaches
``SHARE`` and all its mandatory key phrases stand there word for word.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased. The
fixed base phrases are found beside that, all places of them, and keep their labels.

Defined results: a null or empty text has no words, no labels, score 0 and null
places; equal rows give equal results; texts are taken whole; extra columns are ignored.
The template index is a fixed table of this module, so nothing grows with the data.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import docs_of, map_rows, table

# The given base phrases and their labels.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

#: Parameters: label, notice, mandatory key phrases (all must stand in the found place).
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0", ("apache license", "version 2 0")),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at "
     "http www apache org licenses license 2 0", ("apache org licenses license 2 0",)),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    ("gpl-2.0", "this work is licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by "
     "the free software foundation", ("gnu general public license", "free software foundation")),
    ("lgpl", "you can redistribute it and or modify it under the terms of the gnu lesser general public license as "
     "published by the free software foundation", ("gnu lesser general public license",)),
    ("agpl", "licensed under the gnu affero general public license", ("gnu affero general public license",)),
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files to deal in the software without restriction",
     ("permission is hereby granted free of charge", "without restriction")),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
     "the following conditions are met", ("redistribution and use in source and binary forms",)),
    ("bsd", "licensed under the bsd license", ("bsd license",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
     ("for any purpose with or without fee is hereby granted",)),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    ("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    ("cc-by", "licensed under a creative commons attribution license", ("creative commons attribution",)),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     ("free and unencumbered software released into the public domain",)),
)
#: Least share of a template's weight at one place, and words by which places may slip.
SHARE, SLIP = 0.75, 2

SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
          "labels string, score double")

#: Bytes outside words become spaces, A-Z become a-z; what is left between spaces are the words.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split(b" ")


def words(text: str | None) -> list[bytes]:
    return [w for w in words_of(text) if w]


class Index:
    """Postings of the templates' words and their weights."""

    def __init__(self, templates=TEMPLATES):
        self.templates = [(label, words(text), [words(k) for k in keys]) for label, text, keys in templates]
        df = defaultdict(set)
        for i, (_, ws, _) in enumerate(self.templates):
            for w in ws:
                df[w].add(i)
        n = len(self.templates)
        self.idf = {w: math.log((n + 1) / (len(x) + 0.5)) for w, x in df.items()}
        self.weight = [sum(self.idf[w] for w in ws) for _, ws, _ in self.templates]
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for i, (_, ws, _) in enumerate(self.templates):
            held = 0.0
            for w in sorted(set(ws), key=lambda w: (-self.idf[w], -len(w), w)):
                if held > (1 - SHARE) * self.weight[i] + 1e-9:
                    break
                held += self.idf[w] * ws.count(w)
                self.postings[w] += [(i, p) for p, v in enumerate(ws) if v == w]
        self.rare_words = frozenset(self.postings)

    def find(self, ws: list[bytes]) -> list[tuple[str, float, int]]:
        """(label, share, place) of every accepted template."""
        if self.rare_words.isdisjoint(ws):
            return []
        places = defaultdict(set)  # template -> relative positions that a rare word proposes
        for at, w in enumerate(ws):
            for i, p in self.postings.get(w, ()):
                places[i].add(at - p)
        out = []
        for i, offsets in places.items():
            label, tws, keys = self.templates[i]
            best: tuple[float, int] | None = None
            for o in sorted(offsets):
                share = self.share(ws, o, tws) / self.weight[i]
                if share >= SHARE and (best is None or share > best[0]) and all(near(ws, k, o, len(tws)) for k in keys):
                    best = (share, o)
            if best:
                out.append((label, min(1.0, best[0]), max(0, best[1])))
        return out

    def share(self, ws: list[bytes], offset: int, tws: list[bytes]) -> float:
        """Weight of the template words that stand within SLIP words of their place."""
        total = 0.0
        for p, w in enumerate(tws):
            at = offset + p
            if 0 <= at < len(ws) and ws[at] == w or w in ws[max(0, at - SLIP):max(0, at + SLIP + 1)]:
                total += self.idf[w]
        return total


def near(ws: list[bytes], phrase: list[bytes], offset: int, length: int) -> bool:
    """The phrase stands word for word in the template's place."""
    lo, hi = max(0, offset - SLIP), min(len(ws), offset + length + SLIP)
    return any(ws[a:a + len(phrase)] == phrase for a in range(lo, hi - len(phrase) + 1))


def base_places(ws: list[bytes], line: bytes, phrases=BASE) -> list[tuple[int, str]]:
    """(word number, label) of all places of the base phrases; ``line`` is the
    words joined by single spaces with a space at either end."""
    out = []
    for phrase, label in phrases:
        needle = b" " + phrase.encode() + b" "
        at, word, seen = line.find(needle), 0, 0
        while at >= 0:
            word += line.count(b" ", seen, at)
            seen = at
            out.append((word, label))
            at = line.find(needle, at + 1)
    return out


def scan_licenses(docs: DataFrame, templates=TEMPLATES, phrases=BASE) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text)."""

    def make():
        index = Index(templates)

        def scan(cols):
            out = [[] for _ in range(8)]
            for key, text in zip(*cols, strict=True):
                ws = words(text)
                base = base_places(ws, b" " + b" ".join(ws) + b" ", phrases) if ws else []
                found = index.find(ws)
                labels = {x for _, x in base}
                starts = [a for a, _ in base]
                row = (key, len(ws), len(base), min(starts, default=None), max(starts, default=None),
                       ",".join(sorted(labels)), ",".join(sorted(labels | {x[0] for x in found})),
                       max([x[1] for x in found] + [1.0] * bool(base), default=0.0))
                for c, v in zip(out, row, strict=True):
                    c.append(v)
            return out

        return scan

    rows = docs_of(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return map_rows(rows, SCHEMA, make)


def op1_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents``."""
    return scan_licenses(table(spark, sf_dir, "documents"))
