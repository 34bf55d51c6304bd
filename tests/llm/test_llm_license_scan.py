import collections
import math
import re

import pytest

from tarmac.llm import license_scan as ls

APACHE = "Licensed under the Apache License, Version 2.0."
MIT = "Released under the MIT License."


def test_nearest_directory_gives_its_licence(spark):
    rows = [
        (1, "a/LICENSE", "x\n" + APACHE), (2, "a/b/c/code.py", "plain"), (3, "a/b/LICENSE.txt", MIT), (4, "a/b/c/own.py", "# All rights reserved.\ncode"),
        (5, "a/x.py", None), (6, "other/y.py", "plain"), (7, None, APACHE), (8, None, "plain"), (9, "a/b/c/d/e.py", ""), (10, "COPYING", "This is not a licence text."),
        (2, "a/b/c/code.py", "plain"), (None, "a/z", "plain"), (11, "a/licensed.py", MIT), (12, "top.py", "x"),
    ]
    files = spark.createDataFrame(rows, "id int, path string, text string").selectExpr("*", "'r' as row", "1 as dir", "2 as own")
    found = sorted((str(r["id"]), r["license"], r["origin"], r["from_dir"]) for r in ls.scan(files, "id").collect())
    want = [
        ("1", "Apache-2.0", "own", None), ("2", "MIT", "inherited", "a/b"), ("2", "MIT", "inherited", "a/b"), ("3", "MIT", "own", None),
        ("4", "proprietary", "own", None), ("5", "Apache-2.0", "inherited", "a"), ("6", None, None, None), ("7", "Apache-2.0", "own", None),
        ("8", None, None, None), ("9", "MIT", "inherited", "a/b"), ("10", None, None, None), ("None", "Apache-2.0", "inherited", "a"),
        ("11", "MIT", "own", None), ("12", None, None, None),
    ]
    assert found == sorted(want)


def test_root_licence(spark):
    files = spark.createDataFrame([(1, "LICENSE", MIT), (2, "a/b.py", "x"), (3, "c.py", "x")], "id int, path string, text string")
    assert {r["id"]: (r["license"], r["from_dir"]) for r in ls.scan(files, "id").collect()} == {1: ("MIT", None), 2: ("MIT", ""), 3: ("MIT", "")}


def plain_scores(header):
    def words(t):
        return collections.Counter(re.findall("[a-z0-9]+", t.lower()))

    docs = [words(t) for _, t in ls.TEMPLATES]
    n = len(docs)
    idf = lambda w: math.log((1 + n) / (1 + sum(w in d for d in docs))) + 1
    vector = lambda c: {w: k * idf(w) for w, k in c.items()}
    h = vector(words(header))
    best = {}
    for (name, _), d in zip(ls.TEMPLATES, docs):
        t = vector(d)
        dot = sum(v * t.get(w, 0) for w, v in h.items())
        if dot:
            best[name] = max(best.get(name, 0), dot / math.sqrt(sum(v * v for v in h.values()) * sum(v * v for v in t.values())))
    return best


@pytest.mark.parametrize("header", [APACHE, MIT, "Licensed under CC BY-NC 4.0.", "Some copyright words about the house", "zzz license qqq"])
def test_cosine_equals_plain_python(spark, header):
    row = ls.score_headers(spark.createDataFrame([(header,)], "header string")).first()
    best = plain_scores(header)
    assert row["score"] == pytest.approx(max(best.values()), abs=2e-6)
    assert best[row["license"]] == pytest.approx(max(best.values()), abs=2e-6)


def test_empty_table(spark):
    assert ls.scan(spark.createDataFrame([], "id int, path string, text string"), "id").count() == 0


MPL = """// This Source Code Form is subject to the terms of the Mozilla Public
// License, v. 2.0. If a copy of the MPL was not distributed with this
// file, You can obtain one at http://mozilla.org/MPL/2.0/."""
BSD = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:\n"
AGPL = "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU Affero General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version."


@pytest.mark.parametrize("path,text,license", [
    ("a.c", MPL, "MPL-2.0"),
    ("a.c", "Copyright 2014 The Authors. All rights reserved.\n\n" + BSD, "BSD"),
    ("a.txt", "word " * 20 + "ends here. Released under the MIT License. And " + "more " * 15 + "follows.", "MIT"),
    ("a.py", AGPL, "AGPL-3.0"),
    ("LICENSE", "Copyright (c) 2020, Some One\nAll rights reserved.\n\n" + dict(ls.FULL_TEXTS)["BSD-2-Clause"], "BSD-2-Clause"),
    ("LICENSE", "Copyright (c) 2020, Some One\nAll rights reserved.\n\n" + dict(ls.FULL_TEXTS)["BSD-3-Clause"].replace(". ", ".\n\n"), "BSD-3-Clause"),
    ("x/COPYING", "Copyright (c) 2020 Some One\n\n" + dict(ls.FULL_TEXTS)["ISC"], "ISC"),
    ("a.py", "Copyright 2020 Some One. All rights reserved.", "proprietary"),
])
def test_headers_of_many_lines_and_whole_texts(spark, path, text, license):
    row = ls.scan(spark.createDataFrame([(1, path, text)], "id int, path string, text string"), "id").first()
    assert row["license"].startswith(license) and row["origin"] == "own"


GPL2 = "This program is free software; you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation; either version 2 of the License, or\n(at your option) any later version."
WORDS_THAT_DECIDE = [
    (GPL2, "GPL-2.0"),
    (GPL2.replace("version 2", "version 3"), "GPL-3.0"),
    (GPL2.replace("either version 2 of the License, or\n(at your option) any later version.", "see the License."), "GPL"),
    ("# SPDX-License-Identifier: GPL-2.0-only", "GPL-2.0"),
    ("# SPDX-License-Identifier: GPL-3.0-or-later", "GPL-3.0"),
    ("// SPDX-License-Identifier: LGPL-2.1-or-later", "LGPL-2.1"),
    ("GNU GENERAL PUBLIC LICENSE\nVersion 2, June 1991", "GPL-2.0"),
    ("GNU LESSER GENERAL PUBLIC LICENSE\nVersion 2.1, February 1999", "LGPL-2.1"),
    ("Licensed under the GNU GPLv2 license", "GPL-2.0"),
    ("Licensed under the GNU GPLv3 license", "GPL-3.0"),
    ("Licensed under the EUPL, Version 1.2 or later (the \"Licence\"); you may not use this work except in compliance with the Licence.", "EUPL-1.2"),
    ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0\nwhich is available at https://www.eclipse.org/legal/epl-2.0/", "EPL-2.0"),
    ("Distributed under the Boost Software License, Version 1.0.\n(See accompanying file LICENSE_1_0.txt or copy at https://www.boost.org/LICENSE_1_0.txt)", "BSL-1.0"),
    ("This file is not released under the MIT License.", None),
    ("Licensed under the Apache License, Version 1.1.", None),
    ("Licensed under the Apache License, Version 2.0.", "Apache-2.0"),
    ("Mozilla Public License Version 1.1", "MPL-1.1"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "CC-BY-SA-4.0"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "CC-BY-4.0"),
    ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"),
]


def test_words_that_decide(spark):
    rows = [(i, f"d{i}/a.c", text) for i, (text, _) in enumerate(WORDS_THAT_DECIDE)]
    found = {r["id"]: r["license"] for r in ls.scan(spark.createDataFrame(rows, "id int, path string, text string"), "id").collect()}
    assert {t: found[i] for i, (t, want) in enumerate(WORDS_THAT_DECIDE) if found[i] != want} == {}
