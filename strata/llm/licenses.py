"""License scans by canonical digests.

A text is brought to a canonical form (lower case, copyright lines left out,
punctuation and white space to single spaces, equivalent spellings made one)
and digested; the digest is hash-joined with those of known license texts and
notices. Whole documents are looked up, and each of their lines as a text of
its own, since notices stand as single lines in documents.

All steps are SQL expressions; the known digests are a fixed table of a few
hundred rows, broadcast by that bound.

Edge cases: null text is empty; a text whose canonical form is empty matches
nothing; rows that repeat are reported as often as they are there; a null id is
reported as null; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Spellings that count as one, as (pattern, replacement), applied in this
# order to the lower-case words of a text, which single blanks separate.
SPELLINGS = (
    ("licence", "license"),
    ("\\bsub license", "sublicense"),
    ("\\bnon commercial", "noncommercial"),
    ("\\bnon infringement", "noninfringement"),
    ("merchantibility", "merchantability"),
    ("copyright (owners?|holders?)\\b", "copyright holder"),
    ("organisation", "organization"),
    ("favour", "favor"),
    ("acknowledgement", "acknowledgment"),
    ("\\bper cent\\b", "percent"),
    ("\\b(the|this) (software|program|work|file|project|package) is ", ""),
)
#: A folded text that holds none of these is not changed by ``SPELLINGS``.
SIGNS = ("licence", "sub license", "non commercial", "non infringement", "merchantibility",
         "copyright owner", "copyright holder", "organisation", "favour", "acknowledgement",
         "per cent", "software is ", "program is ", "work is ", "file is ", "project is ",
         "package is ")
#: Short forms of version numbers, in every text.
VERSION = ("\\bv ?([0-9])", "version $1")
#: A lower-case text without one of these has no copyright line, mark or address.
COPYRIGHT_SIGNS = ("copyright", "(c)", "©", "all rights reserved", "://")
# Words that follow "copyright" in license texts, where no name does.
NO_NAMES = ("also and are disclaimer doctrine doctrines holder holders if in interest interests is "
            "law laws license licenses licence like line notice notices of on or owner owners "
            "ownership patent permission protection statement statements the this those to treaty "
            "under").split()
# How what stands below a copyright line begins.
BELOW = ("permission is hereby granted", "permission to use", "redistribution and use",
         "everyone is permitted", "this program is free", "this library is free",
         "this is free and unencumbered", "this source code form", "this work is licensed",
         "licensed under", "released under", "distributed under", "spdx-license-identifier")
_HEAD = ("(?m)^[ \\t/*#;%<!-]*(?:portions )?(?:copyright\\b[ \\t,:]*(?:(?:(?:[(]c[)]|©|copyright)"
         "[ \\t,:]*)+|(?=[0-9]{4})|by |(?!(?:" + "|".join(NO_NAMES) + ")\\b)(?=\\p{L}))"
         "|(?:[(]c[)]|©)[ \\t,:]*(?=[0-9]{4}))")
#: What is no part of a license's text, as (pattern, replacement), in this order: places
#: for a name to be filled in, copyright lines with the rest of their paragraph up to what
#: stands below them, and copyright lines alone.
COPYRIGHTS = (
    ("copyright\\W+(?:c\\W+)?(?:yyyy|year)\\W+name\\W+of\\W+(?:copyright\\W+owner|author)", " "),
    (_HEAD + "[^\\n]{0,200}?(?:\\n(?![ \\t/*#;%-]*\\n)[^\\n]{0,200}?){0,4}"
     "(?:\\n[ \\t/*#;%-]*){0,4}(" + "|".join(
        b.replace(" ", "[\\s/*#;%-]+") for b in BELOW) + ")", "$1"),
    (_HEAD + "[^\\n]*$", " "),
    ("all\\W+rights\\W+reserved", " "),
    ("https?://(www[.])?", " "),
    ("[(]c[)]|©", " copyright "),
)
#: Everything that is no letter or digit separates words.
NO_WORD = "[^\\p{L}\\p{N}]+"

# License names and how notices call them.
NAMES = {
    "MIT": ("MIT License", "the MIT License"),
    "Apache-2.0": ("the Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0"),
    "GPL-2.0": ("the GNU General Public License, version 2", "GPL-2.0"),
    "GPL-3.0": ("the GNU General Public License, version 3", "GPL-3.0"),
    "LGPL-3.0": ("the GNU Lesser General Public License, version 3", "LGPL-3.0"),
    "AGPL-3.0": ("the GNU Affero General Public License, version 3", "AGPL-3.0"),
    "MPL-2.0": ("the Mozilla Public License, version 2.0", "MPL-2.0"),
    "BSD-2-Clause": ("the 2-Clause BSD License", "the BSD 2-Clause License", "BSD-2-Clause"),
    "BSD-3-Clause": ("the 3-Clause BSD License", "the BSD 3-Clause License", "BSD-3-Clause"),
    "ISC": ("the ISC License", "ISC"),
    "Unlicense": ("the Unlicense", "Unlicense"),
    "CC0-1.0": ("CC0 1.0", "CC0-1.0"),
    "CC-BY-4.0": ("CC BY 4.0", "CC-BY-4.0"),
    "CC-BY-SA-4.0": ("CC BY-SA 4.0", "CC-BY-SA-4.0"),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0", "CC-BY-NC-4.0"),
    "CC-BY-ND-4.0": ("CC BY-ND 4.0", "CC-BY-ND-4.0"),
}
# Notices around a name.
NOTICES = ("Licensed under {}.", "Released under {}.", "Distributed under {}.",
           "This work is licensed under {}.", "SPDX-License-Identifier: {}")

# Short license texts, without their copyright lines.
MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this
software and associated documentation files (the "Software"), to deal in the Software without
restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or
substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with
or without fee is hereby granted, provided that the above copyright notice and this permission
notice appear in all copies."""
ISC_DISCLAIMER = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO
EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY
DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""
BSD_GRANT = """Redistribution and use in source and binary forms, with or without modification, are
permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions
and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of
conditions and the following disclaimer in the documentation and/or other materials provided with
the distribution."""
BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be
used to endorse or promote products derived from this software without specific prior written
permission."""
BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY
EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT
HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE)
ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH
DAMAGE."""
UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in
source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any
means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any
and all copyright interest in the software to the public domain. We make this dedication for the
benefit of the public at large and to the detriment of our heirs and successors. We intend this
dedication to be an overt act of relinquishment in perpetuity of all present and future rights to
this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,
WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
UNLICENSE_LINK = "For more information, please refer to <https://unlicense.org/>"
APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this
file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is
distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or
implied. See the License for the specific language governing permissions and limitations under the
License."""
MPL_HEADER = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a
copy of the MPL was not distributed with this file, You can obtain one at
https://mozilla.org/MPL/2.0/."""
GNU_HEADER = """This {what} is free software: you can redistribute it and/or modify it under the terms
of the GNU {name} as published by the Free Software Foundation, either version {version} of the
License, or (at your option) any later version.

This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even
the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for
more details.

You should have received a copy of the GNU {name} along with this {what}. If not, {ask}"""
ASK_WEB = "see <https://www.gnu.org/licenses/>."
ASK_MAIL = ("write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA "
            "02110-1301 USA.")
TEXTS = {
    "Unlicense": (UNLICENSE, UNLICENSE + "\n\n" + UNLICENSE_LINK),
    "Apache-2.0": (APACHE_HEADER,),
    "MPL-2.0": (MPL_HEADER,),
    "MIT": (MIT_GRANT, "MIT License\n\n" + MIT_GRANT, "The MIT License (MIT)\n\n" + MIT_GRANT),
    "ISC": (ISC_GRANT + "\n\n" + ISC_DISCLAIMER,
            "ISC License\n\n" + ISC_GRANT + "\n\n" + ISC_DISCLAIMER),
    "0BSD": ("Permission to use, copy, modify, and/or distribute this software for any purpose "
             "with or without fee is hereby granted.\n\n" + ISC_DISCLAIMER,),
    "BSD-2-Clause": (BSD_GRANT + "\n\n" + BSD_DISCLAIMER,
                     "BSD 2-Clause License\n\n" + BSD_GRANT + "\n\n" + BSD_DISCLAIMER),
    "BSD-3-Clause": ("\n\n".join((BSD_GRANT, BSD_THIRD, BSD_DISCLAIMER)),
                     "\n\n".join(("BSD 3-Clause License", BSD_GRANT, BSD_THIRD, BSD_DISCLAIMER))),
}


# GNU licenses and what their headers call them.
GNU = {"GPL-2.0": "General Public License", "GPL-3.0": "General Public License",
       "LGPL-3.0": "Lesser General Public License", "AGPL-3.0": "Affero General Public License"}
for _key, _name in GNU.items():
    TEXTS[_key] = tuple(GNU_HEADER.format(what=what, name=_name, version=_key[-3], ask=ask)
                        for what in ("program", "library") for ask in (ASK_WEB, ASK_MAIL))
#: Whole texts, one file per license; what follows the terms may be left out.
FOLDER = Path(__file__).with_name("license_texts")
END_OF_TERMS = "END OF TERMS AND CONDITIONS"


def whole_texts() -> list[tuple[str, str]]:
    """(license, text) of the license texts in ``FOLDER``, with and without an appendix."""
    out = []
    for path in sorted(FOLDER.glob("*.txt")):
        text = path.read_text(encoding="utf-8")
        terms, end, _ = text.partition(END_OF_TERMS)
        out += [(path.stem, x) for x in dict.fromkeys((text, terms + end, terms))]
    return out


def known_texts() -> list[tuple[str, str]]:
    """(license, text) of every known license text and notice."""
    notices = [(key, notice.format(name)) for key, names in NAMES.items() for name in names
               for notice in NOTICES]
    return notices + whole_texts() + [(key, text) for key, texts in TEXTS.items()
                                      for text in texts]


def _has_one(text: Column, signs: Iterable[str]) -> Column:
    return reduce(Column.__or__, [F.contains(text, F.lit(sign)) for sign in signs])


def _after(text: Column, rules: Iterable[tuple[str, str]]) -> Column:
    for pattern, new in rules:
        text = F.regexp_replace(text, pattern, new)
    return text


def with_digest(df: DataFrame, text_col: str) -> DataFrame:
    """``df`` with the digest of a text column's canonical form in its place.

    Copyright lines go first, while there are lines; then white space and marks
    become single blanks, and spellings and versions are made one on the words, so
    that it does not matter where lines break. Most texts hold no sign of either
    and take the passes for words and versions only.
    """
    low = F.col("low")
    stages = df.withColumn("low", F.lower(text_col)).drop(text_col)
    stages = stages.withColumn("low", F.when(
        _has_one(low, COPYRIGHT_SIGNS), _after(low, COPYRIGHTS)).otherwise(low))
    stages = stages.withColumn("low", F.trim(F.regexp_replace("low", NO_WORD, " ")))
    stages = stages.withColumn("low", F.when(
        _has_one(low, SIGNS), _after(low, SPELLINGS)).otherwise(low))
    # never null, so that the join does not compute it a second time to filter nulls
    return stages.withColumn("digest", F.coalesce(F.sha2(F.trim(F.regexp_replace(
        "low", *VERSION)), 256), F.lit(""))).drop("low")


def known_digests(spark: SparkSession,
                  texts: Iterable[tuple[str, str]] | None = None) -> DataFrame:
    """digest, license: one row per digest (of two licenses the first by name)."""
    rows = spark.createDataFrame(list(known_texts() if texts is None else texts),
                                 "license string, text string").coalesce(1)
    return (with_digest(rows, "text").groupBy("digest")
            .agg(F.min("license").alias("license")))


def scan(df: DataFrame, id_col: str, text_col: str,
         texts: Iterable[tuple[str, str]] | None = None) -> DataFrame:
    """License of every document and of its lines.

    Returns doc_id, line_no, digest, license: per document one row with
    line_no 0 for the whole text (license null when unknown), and one for each
    line, from 1, that is a known license or notice.
    """
    known = F.broadcast(known_digests(df.sparkSession, texts))
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    whole = with_digest(rows.withColumn("line_no", F.lit(0)), "text")
    lines = rows.select("doc_id", F.posexplode(F.split("text", "\n")).alias("at", "line"))
    lines = with_digest(lines.withColumn("line_no", F.col("at") + 1).drop("at"), "line")
    columns = ["doc_id", "line_no", "digest", "license"]
    return (whole.join(known, "digest", "left").select(*columns)
            .unionByName(lines.join(known, "digest").select(*columns)))
