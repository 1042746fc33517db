"""License scans: a positional index of rare licence words, aligned by relative position and verified by key phrases."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.llm.text import ALNUM, text_bytes, word_hashes

# The base phrases with their labels.
BASE_PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
# Sentences of public licences and usual notices, each with its label and the phrases it can't lack.
TEMPLATES = (
    (
        "MIT",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction",
        ("permission is hereby granted free of charge", "without restriction"),
    ),
    (
        "Apache-2.0",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0",
        ("in compliance with the license", "apache org licenses license 2 0"),
    ),
    ("Apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    (
        "Apache-2.0",
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
        ("distributed on an as is basis", "without warranties or conditions of any kind"),
    ),
    (
        "BSD-2-Clause",
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
        ("redistributions in binary form must reproduce the above copyright notice",),
    ),
    (
        "BSD-3-Clause",
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
        ("may be used to endorse or promote products derived from this software",),
    ),
    (
        "ISC",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
        ("for any purpose with or without fee is hereby granted",),
    ),
    (
        "MPL-2.0",
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0",
        ("subject to the terms of the mozilla public license v 2 0",),
    ),
    (
        "EPL-2.0",
        "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0",
        ("eclipse public license 2 0",),
    ),
    (
        "LGPL",
        "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version",
        ("gnu lesser general public license", "free software foundation"),
    ),
    (
        "AGPL",
        "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version",
        ("gnu affero general public license", "free software foundation"),
    ),
    (
        "Unlicense",
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software",
        ("free and unencumbered software released into the public domain",),
    ),
    (
        "Zlib",
        "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software",
        ("in no event will the authors be held liable for any damages",),
    ),
    (
        "BSL-1.0",
        "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license",
        ("any person or organization obtaining a copy of the software",),
    ),
    (
        "GPL",
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version",
        ("gnu general public license", "free software foundation"),
    ),
    ("GPL-3.0", "licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    ("GPL-2.0", "licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    ("CC-BY-NC-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    ("CC-BY-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    ("CC-BY-SA-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    ("CC-BY-NC-4.0", "creative commons attribution noncommercial 4 0 international license", ("creative commons attribution noncommercial 4 0",)),
    ("CC-BY-4.0", "creative commons attribution 4 0 international license", ("creative commons attribution 4 0",)),
    ("all-rights-reserved", "all rights reserved", ("all rights reserved",)),
)

#: A licence that another one holds whole is named only where that one isn't.
HELD_BY = {"BSD-2-Clause": "BSD-3-Clause"}

#: So many of a template's rarest words are in the index; this share of them, by IDF, must stand in place.
INDEXED = 8
MIN_SHARE = 0.6
#: Places a word may be off from where the template has it.
DRIFT = 3


@dataclass
class Template:
    label: str
    words: list[bytes]
    phrases: list[list[bytes]]
    base: bool


@dataclass
class Index:
    """Postings of the templates' rarest words: for each word, template, offset in it, and IDF."""

    templates: list[Template]
    hashes: list[np.ndarray]
    phrases: list[list[np.ndarray]]
    words: np.ndarray
    postings: dict[int, list[tuple[int, int, float]]] = field(default_factory=dict)
    mass: list[float] = field(default_factory=list)


def _hashed(words: list[bytes]) -> np.ndarray:
    return next(word_hashes([b" ".join(words)], ALNUM))[1]


def templates(base: dict[str, str] = BASE_PHRASES, more: tuple = TEMPLATES) -> list[Template]:
    """Base phrases are templates whose whole text is their key phrase."""
    found = [Template(label, p.encode().split(), [p.encode().split()], True) for p, label in base.items()]
    return found + [Template(label, t.encode().split(), [p.encode().split() for p in ps], False) for label, t, ps in more]


def build_index(known: list[Template], frequency: dict[bytes, int], documents: int) -> Index:
    """Of each template the words with the highest IDF over all documents; of a base phrase the highest alone.

    A base phrase stands just where its words do, so its rarest word leads to all its places. Of other templates no
    index word is taken that more documents have than not.
    """
    idf = {w: float(np.log((documents + 1) / (frequency.get(w, 0) + 1))) for t in known for w in t.words}
    index = Index(known, [_hashed(t.words) for t in known], [[_hashed(p) for p in t.phrases] for t in known], np.zeros(0, dtype=np.uint64))
    for number, template in enumerate(known):
        ranked = sorted(set(template.words), key=lambda w: (-idf[w], w))[: 1 if template.base else INDEXED]
        ranked = ranked[:1] + [w for w in ranked[1:] if idf[w] > np.log(2)]
        index.mass.append(sum(idf[w] for w in ranked))
        for word in ranked:
            for offset, other in enumerate(template.words):
                if other == word:
                    index.postings.setdefault(int(_hashed([word])[0]), []).append((number, offset, idf[word]))
    index.words = np.array(sorted(index.postings), dtype=np.uint64)
    return index


def _stands_at(words: np.ndarray, phrase: np.ndarray, starts: np.ndarray) -> np.ndarray:
    starts = starts[(starts >= 0) & (starts + len(phrase) <= len(words))]
    for k, word in enumerate(phrase):
        starts = starts[words[starts + k] == word]
    return starts


def scan(words: np.ndarray, index: Index, at: np.ndarray) -> tuple[np.ndarray, int, set[str], set[str], float]:
    """Base places with the number of words at the last, base labels, all labels and score, of one text's word hashes.

    ``at``: the places of index words. The score is the highest share of a template's indexed IDF that was in place.
    """
    by_template: dict[int, list[tuple[int, int, float]]] = {}
    for pos in at.tolist():
        for number, offset, weight in index.postings[int(words[pos])]:
            by_template.setdefault(number, []).append((pos - offset, offset, weight))
    base, after, base_labels, labels, score = [], -1, set(), set(), 0.0
    for number, seen in by_template.items():
        template = index.templates[number]
        if template.base:
            starts = _stands_at(words, index.hashes[number], np.unique([s for s, _, _ in seen]))
            if len(starts):
                base.append(starts)
                after = max(after, int(starts[-1]))
                base_labels.add(template.label)
                score = 1.0
            continue
        share = _best_share(words, number, index, sorted(seen))
        if share:
            labels.add(template.label)
            score = max(score, share)
    labels -= {held for held, holder in HELD_BY.items() if holder in labels}
    places = np.sort(np.concatenate(base)) if base else np.zeros(0, dtype=np.int64)
    return places, after, base_labels, labels | base_labels, min(1.0, score)


def _best_share(words: np.ndarray, number: int, index: Index, seen: list[tuple[int, int, float]]) -> float:
    """Of the stretches where index words agree on the template's start, the best that has all key phrases; or 0."""
    best, first = 0.0, 0
    size, mass = len(index.hashes[number]), index.mass[number]
    present: dict[int, int] = {}
    total = 0.0
    last_checked = -(DRIFT + 1)
    for start, offset, weight in seen:
        present[offset] = present.get(offset, 0) + 1
        total += weight if present[offset] == 1 else 0
        while start - seen[first][0] > 2 * DRIFT:
            gone = seen[first][1]
            present[gone] -= 1
            total -= seen[first][2] if not present[gone] else 0
            first += 1
        # A word that the template has twice may stand in place twice.
        share = min(1.0, total / mass) if mass else 1.0
        if share >= MIN_SHARE and share > best and (start - last_checked > DRIFT or best == 0 or share > best):
            low, high = max(0, start - 3 * DRIFT), min(len(words), start + size + 3 * DRIFT)
            part = words[low:high]
            if all(len(_stands_at(part, p, np.flatnonzero(part == p[0]))) for p in index.phrases[number]):
                best = share
            last_checked = start
    return best


def _index_places(words: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(0, dtype=np.int64)
    place = np.minimum(np.searchsorted(known, words), len(known) - 1)
    return np.flatnonzero(known[place] == words)


def word_frequencies(docs: DataFrame, words: list[bytes]) -> tuple[dict[bytes, int], int]:
    """In how many of all documents each of some words stands, and the number of documents."""
    hashes = np.array([_hashed([w])[0] for w in words], dtype=np.uint64)
    order = np.argsort(hashes)
    known = hashes[order]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, times = 0, np.zeros(len(words), dtype=np.int64)
        for batch in batches:
            total += batch.num_rows
            for _, found, starts in word_hashes(batch.column(0).to_pylist(), ALNUM):
                at = _index_places(found, known)
                word, text = np.searchsorted(known, found[at]), np.searchsorted(starts, at, side="right")
                times += np.bincount(np.unique(text * len(words) + word) % len(words), minlength=len(words))
        numbers = np.append(np.arange(len(words)), -1)
        yield pa.RecordBatch.from_arrays([pa.array(numbers), pa.array(np.append(times, total))], names=["word", "times"])

    sums = docs.select(text_bytes(F.col("text"))).mapInArrow(count, "word long, times long").groupBy("word").agg(F.sum("times").alias("times"))
    found = {r.word: r.times for r in sums.collect()}
    return {words[order[i]]: found.get(i, 0) for i in range(len(words))}, found.get(-1, 0)


RESULT = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def scan_licences(docs: DataFrame, known: list[Template] | None = None) -> DataFrame:
    """A row for each row of ``docs``: words, base places, labels and score (see ``RESULT``).

    One pass counts how many documents hold each licence word, a second looks up each text's index words. Only the
    counts of the licence words, a few hundred, leave the tasks. Null and blank texts have no words and no labels;
    ``first_word`` and ``last_word`` are null without a base place; repeated rows give equal results.
    """
    known = templates() if known is None else known
    vocabulary = sorted({w for t in known for w in t.words})
    shared = docs.sparkSession.sparkContext.broadcast(build_index(known, *word_frequencies(docs, vocabulary)))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            rows = []
            for _, words, starts in word_hashes(batch.column(1).to_pylist(), ALNUM):
                at = _index_places(words, index.words)
                bounds = np.searchsorted(at, starts)
                for k in range(len(starts) - 1):
                    size, part = int(starts[k + 1] - starts[k]), at[bounds[k] : bounds[k + 1]]
                    if not len(part):
                        rows.append((size, 0, None, None, "", "", 0.0))
                        continue
                    places, after, base, labels, score = scan(words[starts[k] : starts[k + 1]], index, part - starts[k])
                    ends = (int(places[0]), after) if len(places) else (None, None)
                    rows.append((size, len(places), *ends, ",".join(sorted(base)), ",".join(sorted(labels)), score))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            columns = list(zip(*rows, strict=True)) if rows else [()] * 7
            arrays = [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    return docs.select(F.col("doc_id").cast("long"), text_bytes(F.col("text"))).mapInArrow(look, RESULT)
