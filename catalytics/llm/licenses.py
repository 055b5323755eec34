"""License scans by canonical digest lookup (operator 2), DataFrame
operations only.

Texts are brought to a canonical form (A-Z lower-cased, copyright lines
removed, punctuation and white space folded, equivalent spellings unified)
and hashed; the digests are hash-joined to the digests of known licences.
Entire texts are matched, never parts of them: the units are the whole
document, each line, and each run of consecutive blocks between blank lines
(a single block, and as many as a known text has), so that a licence or
notice that stands inside a document is found as well. A full text is known
with each of its customary titles and without one.

Defined results: null and empty texts have the digest of the empty text and
match nothing; a known text that occurs twice in a document counts twice, but
once with and without its title;
two known entries with one canonical form are both named; repeated rows are
reported each; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalytics.llm.common import ascii_lower, persisted

_BSD_START = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

# Texts of public licences and of customary notices.
KNOWN = {
    "MIT": """MIT License

Copyright (c) <year> <copyright holders>

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """ISC License

Copyright (c) <year> <owner>

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "0BSD": """Copyright (c) <year> <owner>

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "Zlib": """zlib License

Copyright (c) <year> <copyright holders>

This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution.""",
    "Apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    "BSD-2-Clause": """BSD 2-Clause License

Copyright (c) <year>, <owner>

""" + _BSD_START + """

""" + _BSD_END,
    "BSD-3-Clause": """BSD 3-Clause License

Copyright (c) <year>, <owner>

""" + _BSD_START + """

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.

""" + _BSD_END,
    "Unlicense": """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <http://unlicense.org/>""",
    "GPL-3.0-or-later-header": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU General Public License for more details.

You should have received a copy of the GNU General Public License along with this program.  If not, see <https://www.gnu.org/licenses/>.""",
    "MPL-2.0-header": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "MIT-notice": "Released under the MIT License.",
    "MIT-notice-licensed": "Licensed under the MIT License.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "SPDX-Apache-2.0": "SPDX-License-Identifier: Apache-2.0",
    "SPDX-MIT": "SPDX-License-Identifier: MIT",
    **{f"SPDX-{k}": f"SPDX-License-Identifier: {k}" for k in (
        "0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC0-1.0", "GPL-2.0-only",
        "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "ISC", "LGPL-2.1-or-later", "LGPL-3.0-or-later", "MPL-2.0",
        "Unlicense", "Zlib")},
    "GPL-2.0-notice": "This work is licensed under the GNU General Public License, version 2.",
    "CC-BY-SA-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
}

# Titles that full texts go by; each also goes without one.
TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)", "The ISC License (ISC)"],
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD", "BSD Zero Clause License (0BSD)"],
    "Zlib": ["zlib License", "The zlib License", "zlib/libpng License", "The zlib/libpng License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The BSD 2-Clause License", 'BSD 2-Clause "Simplified" License'],
    "BSD-3-Clause": ["BSD 3-Clause License", "The BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License'],
    "Unlicense": ["The Unlicense", "Unlicense"],
}

# Spellings that count as equal.
SPELLINGS = [("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sublicence", "sublicense"),
             ("organisation", "organization"), ("favour", "favor"), ("acknowledgement", "acknowledgment"),
             ("merchantibility", "merchantability"), ("non infringement", "noninfringement"), ("https", "http")]

#: A line that only states a copyright: sign, year or placeholder follow.
COPYRIGHT_LINE = (r"(^|\n)[^a-z0-9\n]*(copyright[ \t]*(\(c\)|©|<|\[|[0-9]{4})|\(c\)[ \t]*[0-9]{4}|©|"
                  r"all rights reserved)[^\n]*")
#: Everything but digits, lower-case letters, line feeds and non-ASCII.
FOLDED = r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+"
TYPOGRAPHIC = "“”‘’«»–—­ "


def canonical_lines(text: Column) -> Column:
    """Canonical text with its line feeds."""
    t = F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), COPYRIGHT_LINE, "")
    t = F.translate(t, TYPOGRAPHIC, " " * len(TYPOGRAPHIC))
    t = F.regexp_replace(t, FOLDED, " ")
    t = F.concat(F.lit(" "), F.replace(t, F.lit("\n"), F.lit(" \n ")), F.lit(" "))
    for a, b in SPELLINGS:
        t = F.replace(t, F.lit(f" {a} "), F.lit(f" {b} "))
    return F.trim(F.regexp_replace(t, " +", " "))


def flat(t: Column) -> Column:
    return F.trim(F.regexp_replace(t, "[ \n]+", " "))


def block_texts(t: Column) -> Column:
    """The blocks between blank lines, with their line feeds."""
    return F.filter(F.split(t, "\n *\n[ \n]*"), lambda x: flat(x) != "")


def variants(license: str, text: str) -> list[str]:
    """A full text with each of its titles and without one."""
    titles = TITLES.get(license, [])
    body = next((text[len(x):].lstrip() for x in titles if text.startswith(x + "\n")), text)
    return [text, body, *[f"{x}\n\n{body}" for x in titles]] if titles else [text]


def known_digests(spark: SparkSession, known: dict[str, str] | None = None) -> DataFrame:
    """(license, digest, n_chars, n_blocks) of each form of the known texts."""
    rows = [(k, x) for k, v in (known or KNOWN).items() for x in variants(k, v)]
    t = spark.createDataFrame(rows, "license string, text string").select("license", canonical_lines(F.col("text")).alias("t"))
    return t.select("license", F.sha2(flat(F.col("t")), 256).alias("digest"), F.length(flat(F.col("t"))).alias("n_chars"),
                    F.size(block_texts(F.col("t"))).alias("n_blocks"))


def scan_licenses(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the id, ``canonical_sha256`` of the whole text,
    ``license`` (whole-text matches, sorted, comma-joined; null if none),
    ``n_notices`` (matching lines and runs of blocks) and ``notices`` (their
    ids, sorted, comma-joined). ``known`` is as ``known_digests`` gives it."""
    shapes = known.select("n_chars", "n_blocks").distinct().collect()  # a few of each known text
    sizes = sorted({r["n_chars"] for r in shapes if r["n_chars"]})
    counts = sorted({1} | {r["n_blocks"] for r in shapes if r["n_blocks"]})
    part = "array<struct<digest: string, last: int, run: int>>"
    units = docs.select(F.col(id_col).alias("id"), canonical_lines(F.col(text_col)).alias("t"))
    units = units.select("id", flat(F.col("t")).alias("whole"), F.transform(block_texts(F.col("t")), lambda x: F.filter(
        F.transform(F.split(x, "\n"), lambda y: F.trim(y)), lambda y: y != "")).alias("lines"))
    units = units.select("id", "whole", "lines", F.transform("lines", lambda x: F.array_join(x, " ")).alias("blocks"))
    units = units.select("*", F.transform("blocks", lambda x: F.length(x)).alias("chars"))

    def digest_of(text: Column, last: Column, run: int) -> Column:
        return F.struct(F.sha2(text, 256).alias("digest"), last.alias("last"), F.lit(run).alias("run"))

    # only what is as long as a known text is hashed; a line that is a block has the block's number
    def lines_of(x: Column, i: Column) -> Column:
        last = F.when(F.size(x) == 1, i + 1).otherwise(F.lit(0))
        return F.transform(F.filter(x, lambda y: F.length(y).isin(sizes)), lambda y: digest_of(y, last, 0))

    def runs_of(k: int) -> Column:
        long = F.filter(F.sequence(F.lit(1), F.size("blocks") - k + 1), lambda i: (F.aggregate(
            F.slice("chars", i, k), F.lit(k - 1), lambda n, m: n + m)).isin(sizes))
        return F.when(F.size("blocks") > k, F.transform(long, lambda i: digest_of(
            F.array_join(F.slice("blocks", i, k), " "), i + (k - 1), 1))).otherwise(F.array().cast(part))

    lines = F.when((F.size("lines") > 1) | (F.size(F.get("lines", F.lit(0))) > 1), F.flatten(F.transform("lines", lines_of))) \
        .otherwise(F.array().cast(part))
    whole = F.when(F.length("whole").isin(sizes), F.array(digest_of(F.col("whole"), F.size("blocks"), 2))).otherwise(F.array().cast(part))
    some = units.select("id", F.sha2("whole", 256).alias("whole"),
                        F.concat(lines, whole, *[runs_of(k) for k in counts]).alias("parts"))
    rows = persisted(some.withColumn("row", F.monotonically_increasing_id()), "license-units")
    empty = F.sha2(F.lit(""), 256)
    known = known.select("license", "digest").where(F.col("digest") != empty).distinct()
    whole = rows.select("row", F.col("whole").alias("digest")).join(known, "digest").groupBy("row") \
        .agg(F.array_join(F.sort_array(F.collect_set("license")), ",").alias("license"))
    # a text with and without its title, or a line that is a block, ends in the same block: one
    # occurrence, and none besides the whole document
    once = rows.select("row", F.inline("parts")).join(known, "digest").groupBy("row", "license", "last") \
        .agg(F.greatest(F.count_if(F.col("run") == 0), F.max(F.col("run") % 2) * F.min(F.when(F.col("run") == 2, 0).otherwise(1))).alias("n")) \
        .where("n > 0")
    parts = once.groupBy("row").agg(F.sum("n").alias("n_notices"),
                                    F.array_join(F.sort_array(F.collect_set("license")), ",").alias("notices"))
    return rows.join(whole, "row", "left").join(parts, "row", "left").select(
        F.col("id").alias(id_col), F.col("whole").alias("canonical_sha256"), "license",
        F.coalesce("n_notices", F.lit(0)).alias("n_notices"), F.coalesce("notices", F.lit("")).alias("notices"))
