"""Licence scans: sparse TF-IDF cosine to templates, then inheritance from the nearest directory with a licence file.

A header is a line, a run of neighbouring lines (up to one without letters and digits) or a sentence of such a run, with a word that licences use (``CUE``).
Its words' TF-IDF vector, with document frequencies over the
templates, is compared with every template that shares a word with it; the best template of a file's headers is the file's
own licence if the cosine reaches ``LEAST_COSINE``. Words that decide go before the cosine (``NAMES``, ``VERSION``, ``DENIED``): a header must hold the licence's name, where the licence has one; if it names versions,
the licence's must be among them; if it names none and the licence exists in several, the result is the name without a version, after any with one; a header that denies a
licence ("is not released under") gives none. A reservation of all rights counts only where no licence is named, and a whole
text that reaches ``LEAST_FULL`` beside the full text of a short licence (``FULL_TEXTS``) counts most. Whole texts are those of licence files, and in other files
the runs from the first to the last one with a cue, if they hold a grant (``GRANT``). Long licences are known by their titles and headers. Files called LICENSE, LICENCE, COPYING or UNLICENSE (with any
ending) pass theirs to the files of their directory and below that have none: the nearest directory
above counts, in it the file with the best cosine.

Only DataFrame functions are used. The templates are the one small table; headers are few beside the text.
Equal headers are scored once, wherever they occur. Directories, not files, are joined with their ancestors, so a directory of any
size costs as many rows as it has levels.

Rows: a null text has no header, a null path no directory (such files can only have licences of their own). Ties between
templates or files go to the first by name. Repeated rows, also of one path with different texts, are scanned apart; empty tables
give empty tables. Other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.session import stored

LEAST_COSINE, LEAST_FULL = 0.5, 0.8
#: fixed values: words that make a line a header, names of licence files
CUE = "(licen[sc]e|copyright|copying|permission is|permitted|warrant|spdx|rights reserved|public domain)"
GRANT = "(permission (is|to)|redistribution|public domain|free software)"
LICENSE_FILE = "^(licen[sc]e|copying|unlicen[sc]e)([^a-z].*)?$"

#: fixed values: licence names and the words of their usual headers
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License, version 3."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-3.0", "GNU General Public License, Version 3, 29 June 2007"),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "GNU Affero General Public License, Version 3, 19 November 2007"),
    ("LGPL-3.0", "GNU Lesser General Public License, Version 3, 29 June 2007"),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License, CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has dedicated this work to the public domain under CC0 1.0."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License, version 2."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("GPL-2.0", "GNU General Public License, Version 2, June 1991"),
    ("GPL-2.0", "Licensed under the GNU GPLv2 license."),
    ("GPL-3.0", "Licensed under the GNU GPLv3 license."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License, version 2.1."),
    ("LGPL-2.1", "SPDX-License-Identifier: LGPL-2.1-only"),
    ("LGPL-2.1", "GNU Lesser General Public License, Version 2.1, February 1999"),
    ("LGPL-3.0", "SPDX-License-Identifier: LGPL-3.0-only"),
    ("AGPL-3.0", "SPDX-License-Identifier: AGPL-3.0-only"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, "
     "You can obtain one at mozilla.org/MPL/2.0/."),
    ("MPL-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1 (the License); you may not use this file except in compliance with the License."),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("MPL-1.1", "Mozilla Public License Version 1.1"),
    ("EPL-1.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0."),
    ("EPL-2.0", "SPDX-License-Identifier: EPL-2.0"),
    ("EUPL-1.2", "Licensed under the European Union Public Licence, EUPL, Version 1.2."),
    ("EUPL-1.2", "Licensed under the EUPL, Version 1.2 or later (the Licence); you may not use this work except in compliance with the Licence."),
    ("EUPL-1.2", "SPDX-License-Identifier: EUPL-1.2"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0. See accompanying file LICENSE_1_0.txt or copy at boost.org/LICENSE_1_0.txt"),
    ("BSL-1.0", "SPDX-License-Identifier: BSL-1.0"),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("ISC", "Released under the ISC License."),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License, CC BY SA 4.0."),
    ("CC-BY-SA-3.0", "This work is licensed under a Creative Commons Attribution ShareAlike 3.0 Unported License, CC BY SA 3.0."),
    ("CC-BY-3.0", "This work is licensed under a Creative Commons Attribution 3.0 Unported License, CC BY 3.0."),
    ("proprietary", "All rights reserved."),
    ("proprietary", "Copyright. All rights reserved."),
]

#: fixed values: words that a licence's header has, and those that it has not, by the licence's name without version
NAMES = [
    ("Apache", "apache", None), ("GPL", "\\bgpl|general public", "affero|lesser|\\b[al]gpl|library general"), ("LGPL", "lgpl|lesser|library general", None),
    ("AGPL", "agpl|affero", None), ("MPL", "mozilla|\\bmpl", None), ("EPL", "eclipse|\\bepl", None), ("EUPL", "european union|eupl", None), ("BSL", "boost|\\bbsl", None),
    ("ISC", "\\bisc\\b", None), ("CC-BY", "creative commons|cc[ -]by", "share ?-?alike|non ?-?commercial|by[ -](sa|nc|nd)\\b"), ("CC-BY-SA", "share ?-?alike|by[ -]sa\\b", "non ?-?commercial|by[ -]nc"),
    ("CC-BY-NC", "non ?-?commercial|by[ -]nc\\b", "share ?-?alike|by[ -]nc[ -](sa|nd)\\b"),
]
#: fixed values: how a header names a version, how it denies a licence
VERSION = r"(?:\bversion|\bv\.?|licen[sc]e|apache|gpl(?:-?v)?|\bmpl|eupl|\bepl|\bbsl|attribution|alike|commercial|cc0|\bby(?:[ -][a-z]{2})*)[ ,.:-]*([0-9]{1,2}(?:\.[0-9]+)?)(?![0-9])"
DENIED = r"\b(not|never|no longer|neither) (being |been |yet |be )?(released|licen[sc]ed|distributed|available|made available|covered|placed|provided) (under|by|in|with|as)\b"

_BSD = (
        'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are '
        'met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. '
        'Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the '
        'documentation and/or other materials provided with the distribution. '
)
_BSD_NAMES = (
        '3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this '
        'software without specific prior written permission. '
)
_BSD_AS_IS = (
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT '
        'LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT '
        'HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT '
        'LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY '
        'THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF '
        'THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE. '
)
#: fixed values: short licences in full
FULL_TEXTS = [
    ("BSD-2-Clause", _BSD + _BSD_AS_IS),
    ("BSD-3-Clause", _BSD + _BSD_NAMES + _BSD_AS_IS),
    ("MIT", (
        'MIT License. Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation '
        'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
        'publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, '
        'subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial '
        'portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO '
        'THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS '
        'BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN '
        'CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. '
    )),
    ("ISC", (
        'ISC License. Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, '
        'provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR '
        'DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE '
        'AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR '
        'PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE '
        'OF THIS SOFTWARE. '
    )),
    ("Unlicense", (
        'This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or '
        'distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any '
        'means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the '
        'software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and '
        'successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software '
        'under copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
        'WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, '
        'DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR '
        'THE USE OR OTHER DEALINGS IN THE SOFTWARE. For more information, please refer to unlicense.org '
    )),
]


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit("([a-z0-9]+)"), 1)


def templates(spark: SparkSession, known: list[tuple[str, str]]) -> DataFrame:
    """Rows of ``template`` (number), ``license``, ``word``, ``weight``: unit vectors; and each word's ``idf``."""
    rows = [(i, name, text) for i, (name, text) in enumerate(known)]
    words = spark.createDataFrame(rows, "template int, license string, text string").select("template", "license", F.explode(_words(F.col("text"))).alias("word"))
    tf = words.groupBy("template", "license", "word").agg(F.count("*").alias("tf"))
    idf = tf.groupBy("word").agg((F.log((1.0 + len(known)) / (1.0 + F.count("*"))) + 1.0).alias("idf"))
    raw = tf.join(idf, "word").withColumn("w", F.col("tf") * F.col("idf"))
    norms = raw.groupBy("template").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return raw.join(norms, "template").select("template", "license", "word", (F.col("w") / F.col("norm")).alias("weight"), "idf")


def cosines(texts: DataFrame, known: list[tuple[str, str]]) -> DataFrame:
    """``key``, ``license``, ``score`` (cosine, 6 digits) of every distinct ``key`` (with its ``text``) and licence that share a word."""
    vectors = stored(templates(texts.sparkSession, known), "license-templates")
    rare = 1.0 + math.log(1.0 + len(known))
    idf = vectors.select("word", "idf").distinct()
    tf = texts.select("key", F.explode(_words(F.col("text"))).alias("word")).groupBy("key", "word").agg(F.count("*").alias("tf"))
    weighed = tf.join(idf, "word", "left").withColumn("w", F.col("tf") * F.coalesce("idf", F.lit(rare)))
    norms = weighed.groupBy("key").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = weighed.where("idf is not null").join(vectors.select("word", "template", "license", "weight"), "word").groupBy("key", "template", "license").agg(
        F.sum(F.col("w") * F.col("weight")).alias("dot")
    )
    cosine = dots.join(norms, "key").select("key", "license", F.round(F.col("dot") / F.col("norm"), 6).alias("score"))
    return cosine.groupBy("key", "license").agg(F.max("score").alias("score"))


def score_headers(headers: DataFrame) -> DataFrame:
    """The best template of every distinct ``header``: ``header``, ``license``, ``score`` (cosine, 6 digits)."""
    best = cosines(headers.select(F.col("header").alias("key"), F.col("header").alias("text")).distinct(), TEMPLATES).withColumnRenamed("key", "header")
    return best.groupBy("header").agg(F.min(F.struct((-F.col("score")).alias("minus"), "license")).alias("b")).select(
        "header", F.col("b.license").alias("license"), (-F.col("b.minus")).alias("score")
    )


def _family(license: Column) -> Column:
    return F.regexp_replace(license, r"-[0-9.]+$", "")


def decided(named: DataFrame, headers: DataFrame) -> DataFrame:
    """``key``, ``level``, ``license``, ``score`` of the scored headers (``key``, ``license``, ``score``) whose words allow the licence.

    ``headers`` has their distinct ``key`` and ``text``. Levels: 1 a licence, 2 a licence of unknown version, 3 a reservation of all rights.
    """
    families = [n.rpartition("-")[0] for n in sorted({n for n, _ in TEMPLATES}) if n.rpartition("-")[2].replace(".", "").isdigit()]
    several = sorted({f for f in families if families.count(f) > 1})
    low, family, plain = F.lower("text"), _family(F.col("license")), r"(\.0)+$"
    versions = F.transform(F.regexp_extract_all(low, F.lit(VERSION), 1), lambda v: F.regexp_replace(v, plain, ""))
    version = F.regexp_replace(F.regexp_extract("license", r"-([0-9.]+)$", 1), plain, "")
    is_named = F.lit(True)
    for name, needed, barred in NAMES:
        has = low.rlike(needed) & ~low.rlike(barred) if barred else low.rlike(needed)
        is_named = is_named & ((family != name) | has)
    unversioned = (F.size("versions") == 0) & family.isin(several)
    both = named.join(headers, "key").where(~low.rlike(DENIED) & is_named).select("key", "license", "score", versions.alias("versions"))
    both = both.where((version == "") | (F.size("versions") == 0) | F.array_contains("versions", version))
    return both.select(
        "key", F.when(F.col("license") == "proprietary", 3).when(unversioned, 2).otherwise(1).alias("level"),
        F.when(unversioned, family).otherwise(F.col("license")).alias("license"), "score",
    )


def scan(files: DataFrame, id_col: str, path_col: str = "path", text_col: str = "text", least_cosine: float = LEAST_COSINE) -> DataFrame:
    """Per file ``id_col``, ``license``, ``score``, ``origin`` (own, inherited or null), ``from_dir`` (of an inherited licence)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # rows get a number of their own, written down, as neither ids nor paths need be distinct
    has_cue = lambda t: F.lower(t).rlike(CUE)
    lines = F.filter(F.split(text, "\n", -1), has_cue)
    runs = F.transform(F.split(text, r"\n[^a-zA-Z0-9]*\n", -1), lambda t: F.regexp_replace(F.regexp_replace(t, r"\n[^a-zA-Z0-9\n]*", " "), "[ \\t\\r]+", " "))
    row, path = F.monotonically_increasing_id().alias("row"), F.col(path_col).cast("string").alias("path")
    slim = files.select(row, F.col(id_col).alias("id"), path, text.alias("text"), lines.alias("lines"), runs.alias("runs"))
    # the row number in the projection under it keeps Catalyst from computing the arrays anew for each use
    slim = slim.withColumn("cued", F.filter("runs", has_cue)).where("row >= 0")
    sentences = F.filter(F.flatten(F.transform("cued", lambda t: F.split(t, r"(?<=[.!?])(?<!\b[vV]\.) (?=[^a-z])", -1))), has_cue)
    at = F.filter(F.transform("runs", lambda t, i: F.when(has_cue(t), i + 1)), lambda i: i.isNotNull())
    region = F.array_join(F.slice("runs", F.array_min(at), F.array_max(at) - F.array_min(at) + 1), " ")
    is_license = F.lower(F.substring_index("path", "/", -1)).rlike(LICENSE_FILE)
    whole = F.when(F.coalesce(is_license, F.lit(False)), F.col("text")).when((F.size("cued") > 0) & F.lower(region).rlike(GRANT), region)
    headers = F.array_distinct(F.concat("lines", "cued", sentences))
    slim = stored(slim.select("row", "id", "path", headers.alias("headers"), whole.alias("whole")), "license-headers")
    # texts meet the templates by their digests, once each
    lines = slim.where("size(headers) > 0").select("row", F.explode("headers").alias("text")).withColumn("key", F.md5("text"))
    distinct = lines.select("key", "text").dropDuplicates(["key"])
    named = decided(cosines(distinct, TEMPLATES).where(F.col("score") >= least_cosine), distinct)
    named = lines.select("row", "key").join(named, "key").select("row", "level", "license", "score")
    full = slim.where("whole is not null").select("row", F.col("whole").alias("text")).withColumn("key", F.md5("text"))
    like = cosines(full.select("key", "text").dropDuplicates(["key"]), FULL_TEXTS).where(F.col("score") >= LEAST_FULL)
    like = full.select("row", "key").join(like, "key").select("row", F.lit(0).alias("level"), "license", "score")
    own = named.union(like).groupBy("row").agg(F.min(F.struct("level", (-F.col("score")).alias("minus"), "license")).alias("b")).select(
        "row", F.col("b.level").alias("level"), F.col("b.license").alias("own"), (-F.col("b.minus")).alias("own_score")
    )
    base, directory = F.substring_index("path", "/", -1), F.regexp_replace("path", "/?[^/]*$", "")
    known = stored(slim.select("row", "id", base.alias("base"), directory.alias("dir")).join(own, "row", "left"), "license-own")
    givers = known.where(F.col("own").isNotNull() & F.lower("base").rlike(LICENSE_FILE)).groupBy("dir").agg(
        F.min(F.struct("level", (-F.col("own_score")).alias("minus"), F.col("base"), F.col("own"))).alias("g")
    ).select(F.col("dir").alias("above"), F.col("g.own").alias("given"), (-F.col("g.minus")).alias("given_score"))
    parts = F.split("dir", "/", -1)
    ancestors = F.concat(F.array(F.lit("")), F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/")))
    levels = known.where("dir is not null").select("dir").distinct().select("dir", F.explode(F.array_distinct(ancestors)).alias("above"))
    nearest = levels.join(givers, "above").groupBy("dir").agg(F.max(F.struct(F.length("above").alias("n"), "above", "given", "given_score")).alias("x")).select(
        "dir", F.col("x.above").alias("from_dir"), F.col("x.given").alias("given"), F.col("x.given_score").alias("given_score")
    )
    inherits = F.col("own").isNull() & F.col("given").isNotNull()
    return known.join(nearest, "dir", "left").select(
        F.col("id").alias(id_col), F.coalesce("own", "given").alias("license"), F.coalesce("own_score", "given_score").alias("score"),
        F.when(F.col("own").isNotNull(), "own").when(inherits, "inherited").alias("origin"), F.when(inherits, F.col("from_dir")).alias("from_dir"),
    )
