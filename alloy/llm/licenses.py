"""Licence scan by canonical digest lookup, in DataFrame functions only.

Whole texts, and each line as a text of its own, are brought to a canonical
form (case, punctuation, copyright lines, titles, equivalent spellings) and hashed; the
digests are joined with those of the known licences. The known table has a
fixed number of rows (the lists below), so it is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Public licence texts and notices, by SPDX identifier.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT License"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "Licensed under the GNU General Public License v3.0"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC0-1.0", "Released under CC0 1.0"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License"),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
)
BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
TEXTS = (
    ("MIT", """MIT License
Copyright (c) year holder
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """ISC License
Copyright (c) year holder
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("0BSD", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("Zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""),
    ("BSD-2-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
""" + BSD_DISCLAIMER),
    ("BSD-3-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
""" + BSD_DISCLAIMER),
)
# Spellings that licence matching treats alike, first to second.
SPELLINGS = (
    ("licence", "license"), ("sub license", "sublicense"), ("non commercial", "noncommercial"), ("non infringement", "noninfringement"),
    ("acknowledgement", "acknowledgment"), ("authorisation", "authorization"), ("organisation", "organization"),
    ("favour", "favor"), ("whilst", "while"), ("copyright owner", "copyright holder"), ("merchantibility", "merchantability"),
)
MARKS = r"^[^\p{L}\p{N}(©]*"  # indents and comment marks
COPYRIGHT_LINE = MARKS + r"(copyright\b|\(c\)|©|all rights reserved)"
# a wrapped line of a licence may begin with the word, too
RUNNING_LINE = MARKS + r"copyright (notice|holder|owner|law|interest|license)"
TITLE_LINE = MARKS + r"(the )?(mit|isc|zlib|bsd [023][ -]clause) licen[cs]e( \(?(mit|isc|zlib)\)?)?[^\p{L}\p{N}]*$"




def _cleaned(text: Column) -> Column:
    """Each line in lower case with its words parted by single blanks; copyright lines and bare titles are empty."""
    mine = lambda x: F.rlike(x, F.lit(COPYRIGHT_LINE)) & ~F.rlike(x, F.lit(RUNNING_LINE))
    clean = lambda x: F.when(mine(x) | F.rlike(x, F.lit(TITLE_LINE)), F.lit("")).otherwise(
        F.trim(F.regexp_replace(x, r"[^\p{L}\p{N}]+", " "))
    )
    return F.transform(F.split(F.lower(text), "\n"), clean)


def _digest(words: Column) -> Column:
    """Digest of cleaned words in one spelling."""
    plain = F.concat(F.lit(" "), words, F.lit(" "))
    for old, new in SPELLINGS:
        plain = F.replace(plain, F.lit(old), F.lit(new))
    return F.sha2(plain, 256)


def _whole(lines: Column) -> Column:
    return _digest(F.array_join(F.filter(lines, lambda x: x != ""), " "))


def known_licenses(spark) -> DataFrame:
    """(license_id, digest) of the fixed lists, canonicalised like any text."""
    listed = spark.createDataFrame(list(NOTICES + TEXTS), "license_id string, body string")
    return listed.select("license_id", _whole(_cleaned(F.col("body"))).alias("digest")).dropDuplicates(["digest"])


def scan_licenses(documents: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, scope, line_no, license_id)`` for every whole text or line that is a known licence text.

    ``scope`` is ``document`` (line_no 0) or ``line`` (counted from 1). A text
    of one line can match in both scopes. Null, empty and wordless texts match
    nothing; repeated rows and null ids are reported like any other; other
    columns are ignored; an empty table gives an empty result. ``known`` must
    be a fixed list with one row per digest: it is broadcast.
    """
    unit = lambda scope, no, name: F.struct(F.lit(scope).alias("scope"), no.cast("long").alias("line_no"), name.alias("digest"))
    named = F.transform(
        F.array(_cleaned(F.col("body"))),  # bound to a variable, so that each line is cleaned once
        lambda c: F.concat(F.array(unit("document", F.lit(0), _whole(c))), F.transform(c, lambda x, i: unit("line", i + 1, _digest(x)))),
    )[0]
    units = documents.select(F.col(id_col).alias("doc"), F.col(text_col).alias("body")).where("body IS NOT NULL")
    units = units.select("doc", F.explode(named).alias("u")).select("doc", "u.*")
    return units.join(F.broadcast(known), "digest").select(F.col("doc").alias(id_col), "scope", "line_no", "license_id")


def licenses_sql() -> str:
    def words(x: str) -> str:
        return f"trim(regexp_replace({x}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"

    def spelled(x: str) -> str:
        x = f"' ' || {x} || ' '"
        for old, new in SPELLINGS:
            x = f"replace({x}, '{old}', '{new}')"
        return x

    def canon(x: str) -> str:
        gone = f"(regexp_matches(y, '{COPYRIGHT_LINE}') AND NOT regexp_matches(y, '{RUNNING_LINE}')) OR regexp_matches(y, '{TITLE_LINE}')"
        lines = f"list_filter(string_split(lower({x}), chr(10)), lambda y: NOT ({gone}))"
        return spelled(words(f"array_to_string({lines}, ' ')"))

    quote = lambda s: s.replace("'", "''")
    rows = ", ".join(f"('{i}', '{quote(b)}')" for i, b in NOTICES + TEXTS)
    return f"""
WITH listed(license_id, body) AS (VALUES {rows}),
known AS (SELECT sha256({canon('body')}) AS digest, min(license_id) AS license_id FROM listed GROUP BY 1),
units AS (
  SELECT doc_id, 'document' AS scope, 0::BIGINT AS line_no, text AS body FROM documents
  UNION ALL
  SELECT doc_id, 'line', i::BIGINT, string_split(text, chr(10))[i]
  FROM (SELECT doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents) t)
SELECT doc_id, scope, line_no, license_id FROM units JOIN known ON sha256({canon('units.body')}) = digest"""
