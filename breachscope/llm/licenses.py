"""Licences by canonical digest. DataFrame functions only.

A text is brought to one canonical form (case, punctuation, copyright lines, equivalent
spellings), and digests of it are joined to those of known licence texts. Looked up are
the document as a whole, each of its lines, and runs of lines: where the first characters
after the start of a line are those of a known text, the digest of as many characters as
that text has decides. So a licence is found as a document, under another title, as a
notice on a line of its own, and inside a longer file however its lines are broken.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from breachscope.session import settle

# Known texts, and documents that may hold one, are broadcast up to this many (some 60
# bytes each).
BROADCAST_TEXTS = 500_000

# Canonical characters by which the start of a known text is recognised, and the lines
# that hold as many; shorter texts are looked up as whole lines only.
ANCHOR = 48
_ANCHOR_LINES = 16

# Equivalent spellings, applied in this order to lower-cased text.
SPELLINGS = [
    ("licence", "license"),
    ("sub-license", "sublicense"),
    ("sub license", "sublicense"),
    ("non-commercial", "noncommercial"),
    ("non commercial", "noncommercial"),
    ("organisation", "organization"),
    ("&", " and "),
    ("http://", "https://"),
]
# An enumerator "(c)" or a word at the start of a broken line is no copyright line.
COPYRIGHT_LINE = r"(?m)^[ \t#*/;%-]*(?:©|\(c\)[ \t]*(?:copyright|[0-9<\[{])|copyright[ \t]*(?:\(c\)|©|[0-9<\[{]))[^\n]*$"
# Applied when nothing but letters, digits, blanks and line ends is left.
VERSION = r"\bv ?([0-9])"

# Names of licences, and the sentences that notices are made of.
NAMES = {
    "MIT": ["MIT License"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0"],
    "GPL-2.0": ["GNU General Public License, version 2"],
    "GPL-3.0": ["GNU General Public License, version 3"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3"],
    "AGPL-3.0": ["GNU Affero General Public License, version 3"],
    "MPL-2.0": ["Mozilla Public License, version 2.0"],
    "BSD-2-Clause": ["BSD 2-Clause License"],
    "BSD-3-Clause": ["BSD 3-Clause License"],
    "ISC": ["ISC License"],
    "CC0-1.0": ["CC0 1.0"],
    "CC-BY-4.0": ["CC BY 4.0"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0"],
    "CC-BY-NC-SA-4.0": ["CC BY-NC-SA 4.0"],
}
SENTENCES = [
    "{}",
    "License: {}",
    "Licensed under {}",
    "Licensed under the {}",
    "Released under {}",
    "Released under the {}",
    "Distributed under the {}",
    "This work is licensed under {}",
    "This work is licensed under the {}",
    "This software is licensed under the {}",
]
# Whole texts of short licences, without a title.
WHOLE = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
}
# The notices that source files carry at their head.
HEADERS = {
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
}
# The head of files under the licences of one family, by the licence's name,
# its word for the work, the version, and whether later versions are allowed.
FAMILY_HEADER = (
    "This {work} is free software{mark} you can redistribute it and/or modify it under the terms of the "
    "GNU {name} as published by the Free Software Foundation{which}."
)
FAMILY = {
    "GPL-2.0": ("General Public License", "2"),
    "GPL-3.0": ("General Public License", "3"),
    "LGPL-2.1": ("Lesser General Public License", "2.1"),
    "LGPL-3.0": ("Lesser General Public License", "3"),
    "AGPL-3.0": ("Affero General Public License", "3"),
}
# Titles under which texts of ``WHOLE`` stand.
TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The 2-Clause BSD License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The 3-Clause BSD License", "New BSD License", "Modified BSD License"],
}
# Whole texts as published, one file each, named by licence. Fixed values.
TEXTS = Path(__file__).with_name("license_texts")


def family_headers() -> list[tuple[str, str]]:
    """The head of files under each licence of ``FAMILY``, in its usual variants."""
    found = []
    for license, (name, version) in FAMILY.items():
        for work in ("program", "library", "file"):
            for mark in (":", ";"):
                for which in (
                    f", either version {version} of the License, or (at your option) any later version",
                    f"; either version {version} of the License, or (at your option) any later version",
                    f", version {version}",
                    f"; version {version}",
                ):
                    found.append((license, FAMILY_HEADER.format(work=work, mark=mark, name=name, which=which)))
    return found


def known_texts() -> list[tuple[str, str]]:
    """(licence, text) of whole texts, of heads of files and of notices."""
    notices = [
        (name, sentence.format(full))
        for name, fulls in NAMES.items()
        for full in fulls
        for sentence in SENTENCES
    ]
    titled = [(name, f"{title}\n\n{WHOLE[name]}") for name, titles in TITLES.items() for title in titles]
    published = [(path.stem, path.read_text(encoding="utf-8")) for path in sorted(TEXTS.glob("*.txt"))]
    return [*WHOLE.items(), *titled, *published, *HEADERS.items(), *family_headers(), *notices]


def canonical_lines(text: Column) -> Column:
    """The lines of the form in which texts are compared, without empty ones."""
    out = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, "")
    for spelling, into in SPELLINGS:
        out = F.replace(out, F.lit(spelling), F.lit(into))
    out = F.regexp_replace(F.regexp_replace(out, "[^a-z0-9\n]+", " "), VERSION, "version $1")
    return F.array_remove(F.transform(F.split(out, "\n"), lambda x: F.trim(x)), "")


def canonical(text: Column) -> Column:
    """All canonical lines as one; empty if nothing is left."""
    return F.array_join(canonical_lines(text), " ")


def _anchor(form: Column) -> Column:
    return F.hex(F.xxhash64(F.substring(form, 1, ANCHOR)))


def known_digests(known: DataFrame) -> DataFrame:
    """``key, license, size, digest``: for each canonical text its digest as a key, and the hash
    of its first characters as another if it has as many. Of equal texts the first licence
    by name counts."""
    form = known.select("license", canonical(F.col("text")).alias("form")).where("form <> ''")
    single = form.groupBy("form").agg(F.min("license").alias("license"))
    digest, size = F.md5("form").alias("digest"), F.length("form").alias("size")
    long = single.where(F.length("form") >= ANCHOR)
    return single.select(digest.alias("key"), "license", F.lit(None).cast("int").alias("size"), digest).union(
        long.select(_anchor(F.col("form")), "license", size, digest)
    )


def scan(
    docs: DataFrame,
    known: DataFrame | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, whole, licenses, n_notices``, one row per input row.

    ``whole`` is the licence that the entire text is, ``licenses`` the names found in it,
    its lines or runs of lines, sorted and joined by a comma, ``n_notices`` the number of
    lines that are a known text by themselves. A run starts at the start of a line and may
    end inside one, after a word. Null, empty and unknown texts have null, an empty string
    and 0. ``known`` is a table ``(license, text)``; by default the texts of this module.
    Rows alike in id and text are looked up once. Extra columns are ignored.
    """
    spark: SparkSession = docs.sparkSession
    if known is None:
        known = spark.createDataFrame(known_texts(), "license string, text string")
    digests = settle(known_digests(known))
    if digests.count() <= BROADCAST_TEXTS:
        digests = F.broadcast(digests)
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).withColumn(
        "body", F.xxhash64("text")
    )
    lines = F.col("lines")

    def unit(kind: str, pos: Column, key: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), pos.cast("int").alias("pos"), key.alias("key"))

    def run(pos: Column, count: Column | int) -> Column:
        return F.array_join(F.slice(lines, pos + 1, F.lit(count) if isinstance(count, int) else count), " ")

    units = F.concat(
        F.array(unit("whole", F.lit(0), F.md5(F.array_join(lines, " ")))),
        F.transform(lines, lambda x, i: unit("line", i, F.md5(x))),
        F.transform(lines, lambda x, i: unit("run", i, _anchor(run(i, _ANCHOR_LINES)))),
    )
    with_lines = source.where("text IS NOT NULL").select("doc_id", "body", canonical_lines(F.col("text")).alias("lines"))
    hits = settle(
        with_lines.select("doc_id", "body", F.inline(units))
        .join(digests, "key")
        .where((F.col("kind") == "run") == F.col("size").isNotNull())
        .select("doc_id", "body", "kind", "pos", "license", "size", "digest")
    )
    # The few documents in which a known text may start are read again.
    starts = hits.where("kind = 'run'").select(F.col("doc_id").alias("_id"), F.col("body").alias("_body"), "pos", "license", "size", "digest").distinct()
    starts = settle(starts)
    if starts.count() <= BROADCAST_TEXTS:
        starts = F.broadcast(starts)
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("body") == F.col("_body"))
    rest = run(F.col("pos"), F.size(lines))
    runs = (
        source.join(starts, same)
        .select("doc_id", "body", canonical_lines(F.col("text")).alias("lines"), "pos", "license", "size", "digest")
        .withColumn("rest", rest)
        .where((F.md5(F.expr("substring(rest, 1, size)")) == F.col("digest")) & F.expr("substring(rest, size + 1, 1) IN ('', ' ')"))
        .select("doc_id", "body", F.lit("run").alias("kind"), "license")
    )
    found = (
        hits.where("kind <> 'run'")
        .select("doc_id", "body", "kind", "license")
        .unionByName(runs)
        .groupBy(F.col("doc_id").alias("_id"), F.col("body").alias("_body"))
        .agg(
            F.max(F.when(F.col("kind") == "whole", F.col("license"))).alias("whole"),
            F.array_join(F.array_sort(F.collect_set("license")), ",").alias("licenses"),
            F.count_if(F.col("kind") == "line").alias("n_notices"),
        )
    )
    return (
        source.select("doc_id", "body")
        .join(found, same, "left")
        .select(
            "doc_id",
            "whole",
            F.coalesce("licenses", F.lit("")).alias("licenses"),
            F.coalesce("n_notices", F.lit(0)).cast("bigint").alias("n_notices"),
        )
    )
