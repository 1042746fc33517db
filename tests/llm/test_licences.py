import random
import re

from sheaf.llm import licences
from tests.llm.corpora import SCHEMA, no_docs, odd_docs, with_clashes

MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction"


def slow(value):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), value or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    places, labels = [], set()
    for phrase, label in licences.BASE_PHRASES.items():
        phrase = phrase.split()
        for i in range(len(words)):
            if words[i : i + len(phrase)] == phrase:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def scanned(spark, texts):
    docs = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in enumerate(texts)], SCHEMA)
    return {r.doc_id: r for r in licences.scan_licences(docs).collect()}


def test_base_places_against_brute_force(spark):
    rng = random.Random(2)
    pieces = ["MIT", "license", "License", "apache", "general", "public", "GENERAL PUBLIC LICENSE", "mit licence", "é", "mit-license", "x1", "the", "\n", "mit\x00license", "ß"]
    texts = [" ".join(rng.choice(pieces) for _ in range(rng.randrange(30))) for _ in range(300)]
    got = scanned(spark, texts)
    for i, value in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == slow(value)
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) or not r.base_labels


def test_templates_tolerate_changes_but_not_a_missing_phrase(spark):
    filler = " ".join(f"word{i}" for i in range(200))
    changed = MIT.replace("obtaining a copy", "getting some copy")
    broken = MIT.replace("free of charge", "for a fee")
    texts = [filler, f"{filler} {MIT} {filler}", f"{filler} {changed}", f"{filler} {broken}", "Licensed under CC BY-NC 4.0.", "All rights reserved.", "all other rights are reserved"]
    got = scanned(spark, texts + [filler] * 10)
    assert [got[i].labels for i in range(7)] == ["", "MIT", "MIT", "", "CC-BY-NC-4.0", "all-rights-reserved", ""]
    assert all(0 <= r.score <= 1 for r in got.values())
    assert got[1].score == 1 and 0.6 <= got[2].score < 1 and got[0].score == 0


def test_odd_rows(spark):
    docs = with_clashes(odd_docs(spark))
    got = licences.scan_licences(docs).collect()
    assert len(got) == docs.count()
    by_id = {r.doc_id: r for r in got}
    assert (by_id[1].n_words, by_id[2].n_words, by_id[3].n_words, by_id[7].n_words) == (0, 0, 0, 300_000)
    assert by_id[1].first_word is None and by_id[1].labels == "" and by_id[1].score == 0
    assert licences.scan_licences(no_docs(spark)).collect() == []


# Texts and notices of public licences.
BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""
BSD_TAIL = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.
"""
GNU_NOTICE = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.
"""
WHOLE_TEXTS = {
    "MIT": MIT + ', including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND.',
    "BSD-2-Clause": BSD_HEAD + BSD_TAIL,
    "BSD-3-Clause": BSD_HEAD + BSD_THIRD + BSD_TAIL,
    "Apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "GPL": GNU_NOTICE.format("General Public License"),
    "LGPL": GNU_NOTICE.format("Lesser General Public License"),
    "AGPL": GNU_NOTICE.format("Affero General Public License"),
    "Unlicense": "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose.",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.\n\nPermission is granted to anyone to use this software for any purpose",
    "BSL-1.0": 'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software',
}


def test_whole_texts_of_licences(spark):
    rows = [(i, f"Copyright (c) 2020 A. Nonym\n\n{text}\n", "en", "a", 0) for i, text in enumerate(WHOLE_TEXTS.values())]
    rows += [(100 + i, "plain words about software, its use and its source " * 9, "en", "a", 0) for i in range(30)]
    found = {r.doc_id: r for r in licences.scan_licences(spark.createDataFrame(rows, SCHEMA)).collect()}
    for i, name in enumerate(WHOLE_TEXTS):
        own = set(found[i].labels.split(",")) - set(licences.BASE_PHRASES.values())
        assert own == {name}, name
    assert all(found[100 + i].labels == "" for i in range(30))
