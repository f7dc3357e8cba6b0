"""Licence scans by canonical digests.

A text is brought to a canonical form (case, copyright notices, punctuation, equivalent spellings), and
the digest of the whole canonical text is joined to the digests of known licence texts. Documents are
looked up as a whole and line by line, so notices inside other text are found too. DataFrame functions
only; the known texts are a small fixed table and the files of ``licence_texts``.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: A copyright notice on any line: the word or (c) with a sign, a year or a field to fill in, a line that opens with
#: the sign, and "all rights reserved" by itself. Lines of prose that a wrap lets begin with the word are none.
COPYRIGHT = (r"(?dm)^[ \t\r\f]*(?:copyright[ \t:]*+(?:\(c\)|©|\d{4}|[\[{<])[^\n]*|"
             r"\(c\)[ \t]*+(?:copyright|©|\d{4}|[\[{<])[^\n]*|©[^\n]*|all rights reserved[^\p{L}\p{N}\n]*+)$")
OTHER = r"[^\p{L}\p{N}\n]+"

#: Spellings that licence matching treats as equal, first the variant, then the form kept.
SPELLINGS = [
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sublicence", "sublicense"),
    ("analogue", "analog"), ("authorisation", "authorization"), ("authorised", "authorized"), ("behaviour", "behavior"),
    ("centre", "center"), ("colour", "color"), ("cancelled", "canceled"), ("defence", "defense"), ("favour", "favor"),
    ("favourite", "favorite"), ("fulfil", "fulfill"), ("fulfilment", "fulfillment"), ("honour", "honor"),
    ("initialise", "initialize"), ("judgement", "judgment"), ("labour", "labor"), ("merchantibility", "merchantability"),
    ("organisation", "organization"), ("organise", "organize"), ("practise", "practice"), ("programme", "program"),
    ("realise", "realize"), ("recognise", "recognize"), ("signalling", "signaling"), ("utilisation", "utilization"),
    ("whilst", "while"), ("wilful", "willful"), ("https", "http"),
]

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""

_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_NAME = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission."""
_BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,
INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE
GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF
THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

#: Public licence texts and the usual one-line notices, by licence id.
KNOWN = [
    ("MIT", _MIT), ("MIT", "Released under the MIT License."), ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"), ("ISC", _ISC), ("ISC", "SPDX-License-Identifier: ISC"),
    ("BSD-2-Clause", f"{_BSD_HEAD}\n{_BSD_TAIL}"), ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-3-Clause", f"{_BSD_HEAD}\n{_BSD_NAME}\n{_BSD_TAIL}"), ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."), ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License."""),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"), ("GPL-3.0-or-later", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL-2.0-only", "SPDX-License-Identifier: GPL-2.0-only"),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."), ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."), ("CC-BY-4.0", "This work is licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."), ("CC-BY-SA-4.0", "This work is licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"), ("CC0-1.0", "Released under CC0 1.0."),
]


#: Lines that open the files of a licence whose known text is without them.
TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "Expat License", "MIT"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)", "ISC"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The BSD 2-Clause License", 'BSD 2-Clause "Simplified" License',
                     "Simplified BSD License", "FreeBSD License", "BSD License", "The BSD License", "BSD-2-Clause"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License',
                     "New BSD License", "Revised BSD License", "Modified BSD License", "BSD License", "The BSD License",
                     "BSD-3-Clause"],
}
_TITLE = "|".join(sorted({r"[^\p{L}\p{N}\n]+".join(re.findall(r"\w+", t.lower())) for own in TITLES.values() for t in own},
                         key=len, reverse=True))
#: In the head of a text, after a title at most, any line that opens like a notice is one, as it may hold a name alone;
#: but not where a word of licence prose follows.
HEAD = (rf"(?d)\A([ \t\r\f\n]*+(?:[^\p{{L}}\p{{N}}\n]*+(?:{_TITLE})[^\p{{L}}\p{{N}}\n]*+\n[^\p{{L}}\p{{N}}(©]*+)?+)"
        r"(?:(?!copyright[ \t]+(?:holders?|owners?|notices?|laws?|licen[cs]es?|treat(?:y|ies)|is|are|and|or|in|on|of)\b)"
        r"(?:copyright|\(c\)|©|all rights reserved)[^\n]*+[ \t\r\f\n]*+){1,40}")


def _texts() -> list[tuple[str, str]]:
    """(licence, text) of the files of ``licence_texts``, whole and up to the end of the terms, where that is marked."""
    out = []
    for file in sorted((Path(__file__).parent / "licence_texts").glob("*.txt")):
        text = file.read_text("utf-8")
        terms, end, _ = text.partition("END OF TERMS AND CONDITIONS")
        out += [(file.stem, text), *[(file.stem, terms), (file.stem, terms + end)] * bool(end)]
    return out


def known_texts() -> list[tuple[str, str]]:
    """All known (licence, text): KNOWN, its whole licences under their titles and with other marks of the clauses,
    and the files of ``licence_texts``."""
    licences = [(i, t) for i, t in KNOWN if t.count("\n") > 5 and i in TITLES]
    licences += [(i, re.sub(r"(?m)^\d\. ", "* ", t)) for i, t in licences if re.search(r"(?m)^\d\. ", t)]
    return KNOWN + licences + [(i, f"{title}\n{t}") for i, t in licences for title in TITLES[i]] + _texts()


def canonical_lines(text: Column) -> Column:
    """Canonical lines of a text: lower case, without copyright notices, words of letters and digits parted by one
    blank, equivalent spellings made one. Lines stay apart; empty ones are kept."""
    out = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower(text), HEAD, "$1"), COPYRIGHT, ""), OTHER, " ")
    variants = "|".join(v for v, _ in SPELLINGS)
    fixed = out
    for variant, kept in SPELLINGS:
        fixed = F.regexp_replace(fixed, rf"(?<![^ \n]){variant}(?![^ \n])", kept)
    return F.when(out.rlike(rf"(?<![^ \n])(?:{variants})(?![^ \n])"), fixed).otherwise(out)


def whole(lines: Column) -> Column:
    return F.trim(F.regexp_replace(lines, r"[ \n]+", " "))


def known_digests(spark: SparkSession, known: list[tuple[str, str]] | DataFrame | None = None) -> DataFrame:
    """(digest, licence) of known texts (licence, text); texts that share a digest keep the first licence id. A text
    counts on its lines and on a single line, where notices inside it are no lines of their own and stay."""
    table = known if isinstance(known, DataFrame) else spark.createDataFrame(known_texts() if known is None else known,
                                                                             "licence string, text string")
    table = table.select("licence", "text").union(table.select("licence", F.regexp_replace("text", r"\s+", " ")))
    return (table.select("licence", F.md5(whole(canonical_lines(F.col("text"))).cast("binary")).alias("digest"))
            .groupBy("digest").agg(F.min("licence").alias("licence")))


def scan(docs: DataFrame, known: list[tuple[str, str]] | DataFrame | None = None, key: str = "doc_id",
         text: str = "text") -> DataFrame:
    """Every row: doc_id, canonical_md5 of its whole canonical text, text_licence (the licence whose entire text
    it is, else null), n_notices (lines that are an entire known text) and line_licences (their ids, distinct,
    sorted, comma-joined; null if none).

    Null texts have a null digest and no licence; texts without letters and digits have the digest of the
    empty text, which matches nothing. Rows that repeat are reported alike. An empty table gives no rows;
    other columns are not read.
    """
    table = known_digests(docs.sparkSession, known)
    rows = docs.select(F.col(key).alias("doc_id"), F.xxhash64(text).alias("_text"), canonical_lines(F.col(text)).alias("_lines"))
    flat = rows.select("doc_id", "_text", F.md5(whole(F.col("_lines")).cast("binary")).alias("canonical_md5"),
                       F.filter(F.transform(F.split("_lines", "\n"), lambda x: F.trim(x)), lambda x: x != "").alias("_each"))
    notices = (flat.select("doc_id", "_text", F.posexplode("_each").alias("at", "line"))
               .select("doc_id", "_text", "at", F.md5(F.col("line").cast("binary")).alias("digest"))
               .join(table, "digest").select("doc_id", "_text", "at", "licence").distinct()
               .groupBy("doc_id", "_text").agg(
                   F.count(F.lit(1)).alias("n"),
                   F.array_join(F.array_sort(F.collect_set("licence")), ",").alias("line_licences")))
    left, right = flat.drop("_each").alias("l"), notices.alias("r")
    same = F.col("l.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("l._text") == F.col("r._text"))
    return (left.join(right, same, "left").join(table.withColumnRenamed("licence", "text_licence"),
                                                 F.col("canonical_md5") == F.col("digest"), "left")
            .select("l.doc_id", "canonical_md5", "text_licence", F.coalesce("n", F.lit(0)).alias("n_notices"), "line_licences"))
