"""Licence scan by a positional index of rare tokens.

The index maps each word of the licence templates to its postings (template,
position). A word's rarity (IDF) is counted over the whole corpus. For each
file, all its rare licence words are looked up, and their postings vote for
a template and a relative position; where votes meet, the template is compared
in full and its mandatory key phrases are verified there.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from statistics import median

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import add_struct, release, slices, utf8

#: A-Z in lower case, 0-9 and bytes of other scripts as they are, the rest of ASCII to spaces.
_FOLD = bytes(i + 32 if 65 <= i <= 90 else i if 48 <= i <= 57 or 97 <= i <= 122 or i >= 128 else 32 for i in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


@dataclass(frozen=True)
class Template:
    """``phrases`` must all stand where the template was found."""
    label: str
    text: str
    phrases: tuple[str, ...]


# Phrases and their labels, and the notices that licences ask for.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
TEMPLATES = (
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
             "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
             "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
             "persons to whom the Software is furnished to do so", ("permission is hereby granted free of charge", "without restriction")),
    Template("mit", "Released under the MIT License", ("mit license",)),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
             "granted, provided that the above copyright notice and this permission notice appear in all copies",
             ("permission to use copy modify", "with or without fee")),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
             "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
             "conditions and the following disclaimer", ("redistribution and use in source and binary forms", "are permitted provided")),
    Template("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
             "with the License. You may obtain a copy of the License at", ("apache license", "in compliance with the license")),
    Template("apache", "Licensed under the Apache License, Version 2.0", ("apache license version 2 0",)),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
             "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
             "version", ("free software", "gnu general public license")),
    Template("gpl", "This work is licensed under the GNU General Public License, version 3", ("gnu general public license",)),
    Template("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
             "Public License as published by the Free Software Foundation", ("gnu lesser general public license",)),
    Template("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
             "distributed with this file, You can obtain one at", ("mozilla public license",)),
    Template("cc-by", "Licensed under CC BY 4.0", ("cc by",)),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0", ("cc by nc",)),
    Template("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License",
             ("creative commons attribution 4 0",)),
    Template("unlicense", "This is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
)
SCAN = T.StructType([T.StructField(n, T.LongType()) for n in ("n_words", "n_base", "first_word", "last_word")]
                    + [T.StructField(n, T.StringType()) for n in ("base_labels", "labels")] + [T.StructField("score", T.DoubleType())])


class Index:
    """Postings of the templates' words, with the corpus' IDF."""

    def __init__(self, templates: tuple[Template, ...], idf: dict[bytes, float], min_idf: float, slack: int, least: float):
        self.templates, self.idf, self.min_idf, self.slack, self.least = templates, idf, min_idf, slack, least
        self.words = [words_of(t.text.encode()) for t in templates]
        self.phrases = [[words_of(p.encode()) for p in t.phrases] for t in templates]
        least_idf = [min(min_idf, median(idf[w] for w in ws)) for ws in self.words]
        self.rare = [[(q, w) for q, w in enumerate(ws) if idf[w] >= cut] for ws, cut in zip(self.words, least_idf)]
        self.total = [sum(idf[w] for _, w in r) or 1.0 for r in self.rare]
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for t, r in enumerate(self.rare):
            for q, w in r:
                self.postings[w].append((t, q))

    def scan(self, words: list[bytes]) -> tuple[set[str], float]:
        """Labels of the verified templates of one file, and the best score of any template."""
        if self.postings.keys().isdisjoint(words):
            return set(), 0.0
        votes: dict[int, Counter] = defaultdict(Counter)
        at: dict[bytes, list[int]] = defaultdict(list)
        for p, w in enumerate(words):
            if w in self.postings:
                at[w].append(p)
                for t, q in self.postings[w]:
                    votes[t][p - q] += self.idf[w]
        labels, best = set(), 0.0
        for t, offsets in votes.items():
            most = max(offsets.values())
            for o in sorted(o for o, v in offsets.items() if v >= 0.5 * most):
                got = sum(self.idf[w] for q, w in self.rare[t] if _within(at.get(w, ()), q + o, self.slack))
                score = min(1.0, got / self.total[t])
                best = max(best, score)
                if score >= self.least and self.templates[t].label not in labels:
                    near = words[max(0, o - self.slack):o + len(self.words[t]) + self.slack]
                    if all(_has(near, ph) for ph in self.phrases[t]):
                        labels.add(self.templates[t].label)
        return labels, best


def _within(places: Sequence[int], at: int, slack: int) -> bool:
    """One of the places, which are in order, is ``slack`` from ``at`` at most."""
    i = bisect_left(places, at - slack)
    return i < len(places) and places[i] <= at + slack


def _has(words: list[bytes], phrase: list[bytes]) -> bool:
    return any(words[i:i + len(phrase)] == phrase for i in range(len(words) - len(phrase) + 1))


def base_places(words: list[bytes], phrases: dict[str, str] = PHRASES) -> list[tuple[int, str]]:
    """(first word, label) of every place where a phrase's words stand one after the other."""
    text = b" " + b" ".join(words) + b" "
    found = []
    for phrase, label in phrases.items():
        key = b" " + b" ".join(words_of(phrase.encode())) + b" "
        o, done, n = text.find(key), 0, 0
        while o >= 0:
            n += text.count(b" ", done, o)
            done = o
            found.append((n, label))
            o = text.find(key, o + 1)
    return sorted(found)


def corpus_idf(df: DataFrame, text_col: str, vocabulary: set[bytes]) -> dict[bytes, float]:
    """ln((N + 1) / (n + 1)) of each vocabulary word over all rows; what comes to the driver is one row a word."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        n, found = 0, Counter()
        for whole in batches:
            for b in slices(whole, "text"):
                for t in utf8(b.column("text")):
                    n += 1
                    found.update(vocabulary & set(words_of(t)))
        yield pa.RecordBatch.from_arrays([pa.array([*found.keys(), None], pa.binary()), pa.array([*found.values(), n], pa.int64())], names=["w", "n"])

    got = (df.select(F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(count, "w binary, n long")
           .groupBy("w").agg(F.sum("n").alias("n")).collect())
    n = {None if r["w"] is None else bytes(r["w"]): r["n"] for r in got}
    return {w: math.log((n.get(None, 0) + 1) / (n.get(w, 0) + 1)) for w in vocabulary}


def scan_licenses(df: DataFrame, text_col: str = "text", templates: tuple[Template, ...] = TEMPLATES, out: str = "license",
                  min_idf: float = 1.5, slack: int = 2, least: float = 0.7) -> DataFrame:
    """``df`` and a struct ``out``: word and phrase counts, base labels, all labels, score.

    ``min_idf``: licence words more common than that do not enter the index
    (where a licence is very common, the rarer half of its words still does);
    ``slack``: words by which positions
    may shift; ``least``: share of a template's rare weight that must match.
    Null and empty texts have no words, no labels and score 0.
    """
    vocabulary = {w for t in templates for w in words_of(t.text.encode())}
    idf = corpus_idf(df, text_col, vocabulary)
    index = Index(templates, idf, min_idf, slack, least)

    def make(texts: list) -> dict[str, list]:
        rows = []
        for t in texts:
            words = words_of(t)
            places = base_places(words)
            labels, score = index.scan(words)
            base = {label for _, label in places}
            at = [p for p, _ in places]
            rows.append((len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)), ",".join(sorted(base | labels)), score))
        return {n: [r[i] for r in rows] for i, n in enumerate(SCAN.names)}

    return add_struct(df, text_col, out, SCAN, make)
