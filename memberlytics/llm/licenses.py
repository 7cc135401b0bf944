"""Licence scans: whole texts and single lines are brought to a canonical form and joined with known digests.

The canonical form drops case, punctuation (comment marks among it), copyright lines and differences of spelling.  All of it is
DataFrame code.  A copyright line names a sign or a year after the word, so a wrapped "copyright holders be liable" stays.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from memberlytics.llm.registry import query, table
from memberlytics.llm.secrets import let
from memberlytics.llm.text import WORD_BREAK, lower_ascii
from memberlytics.session import stage

# Spellings that count as the same, as beginnings of words.
SPELLINGS = (
    ("licence", "license"), ("sub license", "sublicense"), ("organisation", "organization"), ("authoris", "authoriz"),
    ("recognis", "recogniz"), ("favour", "favor"), ("behaviour", "behavior"), ("acknowledgement", "acknowledgment"),
    ("merchantibility", "merchantability"), ("non commercial", "noncommercial"), ("copyright holder", "copyright owner"),
)
COPYRIGHT = (
    r"^[ \t/*#;%!>-]*((copyright[ \t:]*(\(c\)|©|(19|20)[0-9][0-9])|\(c\)[ \t]*(19|20)[0-9][0-9]|©)[^\n]*"
    r"|all rights reserved[.]?[ \t\r]*)$"
)

# Notices and short licences.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to
use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall
be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND,
EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER
IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS
IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE
AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO
EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING
FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN
CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution. {}THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT
HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF
SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE,
EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission. """
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for
any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including
commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this
software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product,
an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly
marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any
source distribution."""
_UNLICENSE = """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,
compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or
non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any
and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to
the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present
and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO
EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. For more information, please
refer to <https://unlicense.org>"""
FULL_TEXTS = (
    ("MIT", _MIT, ("", "MIT License", "The MIT License", "The MIT License (MIT)")),
    ("ISC", _ISC, ("", "ISC License", "The ISC License")),
    ("BSD-2-Clause", _BSD.format(""), ("", "BSD 2-Clause License", "The BSD 2-Clause License")),
    ("BSD-3-Clause", _BSD.format(_BSD_NAMES), ("", "BSD 3-Clause License", "The BSD 3-Clause License")),
    ("Zlib", _ZLIB, ("", "zlib License", "The zlib License")),
    ("Unlicense", _UNLICENSE, ("", "The Unlicense")),
)
KNOWN = (
    *((i, f"{title}\n{text}") for i, text, titles in FULL_TEXTS for title in titles),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("ISC", "Released under the ISC License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
)


def canonical(text: Column) -> Column:
    """Canonical words joined by single blanks; empty if nothing is left."""

    def holds(t: Column, parts: list[str]) -> Column:
        return reduce(lambda x, y: x | y, [F.contains(t, F.lit(p)) for p in parts])

    def without_copyright(t: Column) -> Column:
        kept = F.regexp_replace(t, f"(?md){COPYRIGHT}", " ")  # the line feed alone ends a line
        marked = holds(t, ["copyright", "(c)", "©", "all rights reserved"])
        return F.trim(F.regexp_replace(F.when(marked, kept).otherwise(t), WORD_BREAK, " "))

    def same_spelling(t: Column) -> Column:
        same = reduce(lambda x, p: F.regexp_replace(x, rf"\b{p[0]}", p[1]), SPELLINGS, t)
        return F.when(holds(t, [a for a, _ in SPELLINGS]), same).otherwise(t)

    # Plain searches decide whether a pattern has to run; most texts need neither.
    return let(let(lower_ascii(text), without_copyright), same_spelling)


def digests(licences: DataFrame) -> DataFrame:
    """(digest, licence_id) of a (licence_id, text) table; texts with the same canonical form share a digest."""
    c = licences.select("licence_id", canonical(F.col("text")).alias("c")).filter("c <> '' AND licence_id IS NOT NULL")
    return c.select(F.sha2("c", 256).alias("digest"), "licence_id").distinct()


def known_licences(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(KNOWN), "licence_id string, text string")


def find_licences(docs: DataFrame, licences: DataFrame) -> DataFrame:
    """(doc_id, unit, licence_id, n): licences that are the entire ``text`` of a document or entire ``line``s of it.

    ``n`` counts the lines, or rows of that id.  A text of one line counts as both.  Null and blank texts match nothing; rows
    without doc_id are counted together under a null id.
    """
    d = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("text IS NOT NULL")
    known = stage(digests(licences), "digests")  # its size is known to the planner: broadcast if small, else a shuffled join
    whole = d.select("doc_id", F.lit("text").alias("unit"), canonical(F.col("text")).alias("c"))
    line = d.select("doc_id", F.lit("line").alias("unit"), F.explode(F.split("text", "\n", -1)).alias("one"))
    line = line.select("doc_id", "unit", canonical(F.col("one")).alias("c"))
    units = whole.union(line).filter("c <> ''").select("doc_id", "unit", F.sha2("c", 256).alias("digest"))
    return units.join(known, "digest").groupBy("doc_id", "unit", "licence_id").agg(F.count(F.lit(1)).alias("n"))


def _canonical_sql(x: str) -> str:
    lower = f"translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    t = rf"trim(regexp_replace(regexp_replace({lower}, '(?m){COPYRIGHT}', ' ', 'g'), '{WORD_BREAK}', ' ', 'g'))"
    for a, b in SPELLINGS:
        t = rf"regexp_replace({t}, '\b{a}', '{b}', 'g')"
    return t


_VALUES = ", ".join("('{}', '{}')".format(i, t.replace("'", "''")) for i, t in KNOWN)
ORACLE = f"""WITH k AS (SELECT DISTINCT l, {_canonical_sql("t")} AS c FROM (VALUES {_VALUES}) v(l, t)),
u AS (SELECT doc_id, 'text' AS unit, {_canonical_sql("text")} AS c FROM documents
  UNION ALL SELECT doc_id, 'line', {_canonical_sql("one")} FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS one FROM documents))
SELECT doc_id, unit, l AS licence_id, count(*) AS n FROM u JOIN k ON u.c = k.c WHERE u.c <> '' GROUP BY 1, 2, 3"""


@query("op6_licences", ORACLE)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_licences(table(spark, sf_dir, "documents"), known_licences(spark))
