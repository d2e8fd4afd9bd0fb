"""License scans by canonical digest, in DataFrame functions only.

A text is canonical once its ASCII case, punctuation, copyright lines and equivalent spellings are normalised. The digest
of the whole canonical text is hash-joined to the digests of the known licences: the texts in this module and, whole,
those in license_texts. Lines whose canonical form is a known notice are reported beside it. The known table is fixed
here, so its broadcast has a proven bound.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, table

# The texts of public licences, as published.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""
_BSD_TAIL = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
_GPL3 = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.

You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."""
_BSL = """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:

The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
# One-line notices.
NOTICES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
]
#: Entire texts of longer licences, as published, named by their files.
WHOLE = [(f.stem, f.read_text("utf-8")) for f in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))]
_END = "END OF TERMS AND CONDITIONS"
LICENSES = [
    ("MIT", "MIT License\n\n" + _MIT), ("MIT", "The MIT License (MIT)\n\n" + _MIT), ("MIT", _MIT), ("ISC", "ISC License\n\n" + _ISC), ("ISC", _ISC),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TAIL), ("BSD-2-Clause", "BSD 2-Clause License\n\n" + _BSD_HEAD + _BSD_TAIL), ("BSD-3-Clause", _BSD_HEAD + _BSD_THIRD + _BSD_TAIL), ("BSD-3-Clause", "BSD 3-Clause License\n\n" + _BSD_HEAD + _BSD_THIRD + _BSD_TAIL),
    ("Zlib", _ZLIB), ("Zlib", "zlib License\n\n" + _ZLIB), ("Apache-2.0", _APACHE), ("GPL-3.0", _GPL3), ("BSL-1.0", _BSL), ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003\n\n" + _BSL),
    *WHOLE, *((name, text[: text.index(_END) + len(_END)]) for name, text in WHOLE if _END in text),  # also without the appendix on how to apply them
    *NOTICES,
]
# Equivalent spellings, in canonical (lower-case, unpunctuated) form.
SPELLINGS = [
    ("licence", "license"), ("sub license", "sublicense"), ("acknowledgement", "acknowledgment"), ("copyright owner", "copyright holder"), ("organisation", "organization"), ("favour", "favor"),
    ("fulfil ", "fulfill "), ("whilst", "while"), ("wilful", "willful"), ("per cent", "percent"), ("non infringement", "noninfringement"), ("non commercial", "noncommercial"), ("http ", "https "),
]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ\u2018\u2019\u201c\u201d\u2013\u2014", "abcdefghijklmnopqrstuvwxyz''\"\"--"
# a line that names a holder or a year; not one of running text that begins with the word, or an item (c)
_COPYRIGHT = "(^|\\n)[ \\t*#/>-]*(copyright[ \\t:]*(\\(c\\)|\u00a9|[0-9<{\\[]|by )|\\(c\\)[ \\t]*[0-9<{\\[]|\u00a9|all rights reserved)[^\\n]*"
_PUNCTUATION = "[\\x00-\\x2f\\x3a-\\x60\\x7b-\\x7f\u00a0]+"


def _lines(text: Column) -> Column:
    """Folded case, without copyright lines."""
    return F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), _COPYRIGHT, "\n")


def _plain(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, _PUNCTUATION, " "))


def _spelled(text: Column) -> Column:
    out = _plain(text)
    for a, b in SPELLINGS:
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def canonical(text: Column) -> Column:
    return _spelled(_lines(text))


def _known(spark: SparkSession, rows: list[tuple[str, str]]) -> DataFrame:
    return spark.createDataFrame(rows, "license string, body string")


def license_scan(docs: DataFrame, known: list[tuple[str, str]] | None = None) -> DataFrame:
    """Per document: doc_id, digest (of the canonical whole text), license (of that digest, null if none is known),
    n_notices (lines that are known notices) and notices (their licences, distinct, sorted, comma-joined).

    Null and empty texts have the digest of an empty text, which is no licence's. Repeated rows give repeated results.
    known: (licence, text) pairs to match, a short list that is broadcast; by default LICENSES."""
    spark = docs.sparkSession
    bodies = _known(spark, known or LICENSES)
    digests = bodies.select(F.sha2(canonical(F.col("body")), 256).alias("known_digest"), F.col("license")).where(F.col("known_digest") != F.sha2(F.lit(""), 256)).groupBy("known_digest").agg(F.min("license").alias("license"))
    by_line = {r.line: r.license for r in _known(spark, NOTICES[::-1]).select(canonical(F.col("body")).alias("line"), "license").collect()}
    notices = F.create_map(*[F.lit(x) for pair in by_line.items() for x in pair])
    rows = documents(docs, "doc_id", "text")
    found = F.filter(F.transform(F.filter(F.split(_lines(F.col("text")), "\n"), lambda line: line.contains("licen")), lambda line: F.element_at(notices, _spelled(line))), lambda x: x.isNotNull())
    scanned = rows.select("doc_id", F.sha2(canonical(F.col("text")), 256).alias("digest"), found.alias("found"))
    joined = scanned.join(F.broadcast(digests), F.col("digest") == F.col("known_digest"), "left")
    return joined.select("doc_id", "digest", "license", F.size("found").cast("long").alias("n_notices"), F.array_join(F.array_sort(F.array_distinct("found")), ",").alias("notices"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


def _oracle() -> str:
    q = lambda s: "'" + s.replace("'", "''") + "'"
    lines = lambda x: f"regexp_replace(translate(coalesce({x}, ''), {q(_UPPER)}, {q(_LOWER)}), {q(_COPYRIGHT)}, chr(10), 'g')"
    plain = lambda x: f"trim(regexp_replace({x}, {q(_PUNCTUATION)}, ' ', 'g'))"

    def spelled(x: str) -> str:
        x = plain(x)
        for a, b in SPELLINGS:
            x = f"replace({x}, {q(a)}, {q(b)})"
        return x

    values = lambda rows: ", ".join(f"({q(k)}, {q(v)})" for k, v in rows)
    return f"""
WITH known AS (SELECT sha256({spelled(lines("body"))}) AS digest, min(license) AS license FROM (VALUES {values(LICENSES)}) v(license, body) GROUP BY 1),
notice AS (SELECT {spelled(lines("body"))} AS line, min(license) AS license FROM (VALUES {values(NOTICES)}) v(license, body) GROUP BY 1),
d AS (SELECT row_number() OVER () AS rid, doc_id, {lines("text")} AS kept FROM documents),
w AS (SELECT rid, doc_id, sha256({spelled("kept")}) AS digest FROM d),
l AS (SELECT rid, {spelled("line")} AS line FROM (SELECT rid, unnest(string_split(kept, chr(10))) AS line FROM d) WHERE contains(line, 'licen')),
n AS (SELECT rid, count(*) AS n, string_agg(DISTINCT license, ',' ORDER BY license) AS notices FROM l JOIN notice USING (line) GROUP BY rid)
SELECT doc_id, digest, known.license, coalesce(n.n, 0) AS n_notices, coalesce(n.notices, '') AS notices
FROM w LEFT JOIN known USING (digest) LEFT JOIN n USING (rid)"""


QUERIES = {"op6_license_scan": op6_license_scan}
ORACLES = {"op6_license_scan": _oracle()}
