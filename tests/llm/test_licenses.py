"""License scans against plain containment."""

import random
import re

import pytest

from hearthline.llm import licenses as L


def shingles(words):
    return {tuple(words[i : i + 3]) for i in range(len(words) - 2)}


def plain(text):
    """Templates that some stretch of the text's words holds to four fifths."""
    words = [w for w in re.split(r"[^\w]+|_+", text.lower()) if w]
    out = []
    for name, t in L.TEMPLATES:
        want = shingles([w for w in re.split(r"[^\w]+|_+", t.lower()) if w])
        width = len(want) + 30
        if any(len(want & shingles(words[a : a + width])) >= 0.8 * len(want) for a in range(max(1, len(words)))):
            out.append(name)
    return out


def test_scan(spark):
    rng = random.Random(2)
    noise = lambda n: " ".join(rng.choices(["alpha", "the", "license", "under", "licensed", "version", "software"], k=n))
    texts = [None, "", "one two", noise(500)]
    for _, t in L.TEMPLATES:
        for before in (0, 3, 5, 8, 50, 700):
            texts.append(f"{noise(before)} zz {t.upper() if before % 2 else t} zz {noise(rng.randint(0, 40))}")
    broken = L.TEMPLATES[2][1].split()
    texts += [" ".join(broken[: len(broken) // 2]), " ".join(["odd", *broken[:15], "odd", *broken[15:]]), noise(40_000) + " " + L.TEMPLATES[0][1]]
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(4, texts[4], None)]
    got = L.scan(spark.createDataFrame(rows, "doc_id long, text string, licenses string")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert [x.license for x in r.licenses] == plain(texts[r.doc_id] or ""), texts[r.doc_id][:300]
    assert L.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    with pytest.raises(ValueError):
        L.scan(spark.createDataFrame(rows, "doc_id long, text string, licenses string"), templates=(("x", "too short"),))


def test_bands_bound_the_chance_to_miss():
    for shared, width in ((1, 14), (3, 14), (6, 14)):
        b = L.bands_needed(shared, width)
        assert (1 - shared / width) ** b <= L.MISS < (1 - shared / width) ** (b - 1)


REAL = {
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
    "published by\nthe Free Software Foundation, either version 3 of the License, or (at your option) any later version.": "FSF-version-3,GPL-notice",
    "under the terms of the GNU General Public License as published by # the Free Software Foundation; either version 2 of the "
    "License, or any later version": "FSF-version-2,GPL-notice",
    "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of "
    "the License": "FSF-version-2.1,LGPL-notice",
    "under the terms of the GNU Affero General Public License as published by the Free Software Foundation": "AGPL-notice",
    "This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not": "MPL-2.0",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
    "provided that the above copyright notice and this permission notice appear in all copies.": "ISC",
    "made available under the terms of the Eclipse Public License 2.0 which is available at": "EPL-2.0",
    "This is free and unencumbered software released into the public domain.": "Unlicense",
    "a Creative Commons Attribution 4.0 International License": "CC-BY-4.0-name",
    "a Creative Commons Attribution-ShareAlike 4.0 International License": "CC-BY-SA-4.0-name",
    "a Creative Commons Attribution-NoDerivatives 4.0 International License": "CC-BY-ND-4.0-name",
    "licensed under CC BY-SA 4.0": "CC-BY-SA-4.0", "CC0 1.0 Universal": "CC0-1.0",
    "// SPDX-License-Identifier: MIT": "SPDX-MIT", "# SPDX-License-Identifier: GPL-2.0-or-later": "SPDX-GPL-2.0",
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
    "Released under the MIT License.": "MIT", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "the license of this software is free": "",
}


def test_notices_as_they_are_written(spark):
    texts = list(REAL)
    rows = [(i, f"some words before {t} and some after") for i, t in enumerate(texts)]
    got = L.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {texts[r.doc_id]: ",".join(x.license for x in r.licenses) for r in got} == REAL
