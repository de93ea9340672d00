"""Licence scan by canonical digests.

A text is brought into a canonical form (lower case; no copyright lines;
hyphens dropped and other punctuation as space; equivalent spellings as
one) and its digest is joined with the digests of known licence texts.  Two
kinds of entire texts are looked up: the document, and each of its lines,
since licence notices are often one line among others.

The canonical form of a document is that of its lines, joined, so each text
is read once.  Only texts with as many words as a known licence get a
digest: others cannot match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabletrust.llm.common import group_key

#: Spellings that licences use alike (fixed values): each goes to the last.
SPELLINGS = """
acknowledgment acknowledgement; analog analogue; analyse analyze; artefact artifact; authorisation authorization;
authorised authorized; calibre caliber; cancelled canceled; catalogue catalog; categorise categorize; centre center;
emphasised emphasized; favour favor; favourite favorite; fulfil fulfill; fulfilment fulfillment; https http;
initialise initialize; judgment judgement; labelling labeling; labour labor; licence license; licences licenses;
licenced licensed; maximise maximize; modelled modeled; modelling modeling; offence offense; optimise optimize;
organisation organization; organise organize; practise practice; programme program; realise realize;
recognise recognize; signalling signaling; sublicence sublicense; sublicences sublicenses; utilisation utilization; whilst while; wilful willful
"""
SAME = {word: entry.split()[-1] for entry in SPELLINGS.split(";") for word in entry.split()[:-1]}

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
_BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

_BSD_3 = _BSD_2.replace("\n\nTHIS SOFTWARE", """

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission.

THIS SOFTWARE""")
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it
and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you
use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""
_UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as
a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright
interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the
detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all
present and future rights to this software under copyright law.

""" + _MIT[_MIT.index("THE SOFTWARE IS"):].replace("AUTHORS OR\nCOPYRIGHT HOLDERS", "AUTHORS") + """

For more information, please refer to <https://unlicense.org>"""

#: Identifiers, and the names that sentences use.
NAMES = {
    "MIT": ["MIT License"], "ISC": ["ISC License"], "BSD-2-Clause": ["BSD 2-Clause License"], "BSD-3-Clause": ["BSD 3-Clause License"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0"], "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0"],
    "GPL-2.0": ["GNU General Public License, version 2"], "GPL-3.0": ["GNU General Public License, version 3"],
    "LGPL-2.1": ["GNU Lesser General Public License, version 2.1"], "LGPL-3.0": ["GNU Lesser General Public License, version 3"],
    "AGPL-3.0": ["GNU Affero General Public License, version 3"], "Zlib": ["zlib License"], "Unlicense": ["Unlicense"],
    "CC0-1.0": ["CC0 1.0"], "CC-BY-4.0": ["CC BY 4.0"], "CC-BY-SA-4.0": ["CC BY-SA 4.0"], "CC-BY-NC-4.0": ["CC BY-NC 4.0"],
}

#: Known texts (fixed values): short licences whole, and usual one-line
#: notices.  A larger table comes as the ``known`` argument.
KNOWN = [
    ("MIT", _MIT), ("MIT", "MIT License\n\n" + _MIT), ("MIT", "The MIT License (MIT)\n\n" + _MIT),
    ("ISC", _ISC), ("ISC", "ISC License\n\n" + _ISC),
    ("BSD-2-Clause", _BSD_2), ("BSD-2-Clause", "BSD 2-Clause License\n\n" + _BSD_2),
    ("MIT", "Released under the MIT License."), ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."), ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."), ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"), ("GPL-3.0-or-later", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL-2.0-only", "SPDX-License-Identifier: GPL-2.0-only"), ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."), ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."), ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("BSD-3-Clause", _BSD_3), ("BSD-3-Clause", "BSD 3-Clause License\n\n" + _BSD_3),
    ("Zlib", _ZLIB), ("Zlib", "zlib License\n\n" + _ZLIB), ("Unlicense", _UNLICENSE),
]
for _id, _names in NAMES.items():
    for _spdx in [f"{_id}-only", f"{_id}-or-later"] if "GPL" in _id else [_id]:
        KNOWN.append((_spdx, f"SPDX-License-Identifier: {_spdx}"))
    for _name in _names:
        for _start in ("Licensed", "Released", "This project is licensed", "This work is licensed"):
            KNOWN += [(_id, f"{_start} under {_the}{_name}.") for _the in (["the "] if not _id.startswith("CC") else ["", "the "])]
KNOWN = list(dict.fromkeys(KNOWN))

#: A line that names a holder: "Copyright (c) ...", "Copyright 2020 ...",
#: "(c) 2020 ..." or a line that starts with the sign itself.
COPYRIGHT_LINE = r"^[^\p{L}\p{Nd}(©]*(copyright\W*(\(c\)|©|(19|20)[0-9][0-9])|\(c\)\W*(19|20)[0-9][0-9]|©)"


def known_licenses(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(KNOWN, "license string, text string")


def canonical_line(line: Column) -> Column:
    """Lower case words with single spaces; empty for a copyright line."""
    low = F.translate(F.lower(line), "-‐‑", "")
    words = F.trim(F.regexp_replace(F.replace(low, F.lit("&"), F.lit(" and ")), r"[^\p{L}\p{Nd}]+", " "))
    return F.when(F.lower(line).rlike(COPYRIGHT_LINE), F.lit("")).otherwise(words)


def canonical_lines(text: Column) -> Column:
    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n", -1), canonical_line)


def canonical(lines: Column) -> Column:
    """The canonical text of canonical lines, before its spellings."""
    return F.array_join(F.filter(lines, lambda line: line != ""), " ")


def words_in(text: Column) -> Column:
    return F.when(text == "", F.lit(0)).otherwise(F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1)


def digest(text: Column) -> Column:
    same = F.create_map(*[F.lit(x) for pair in SAME.items() for x in pair])
    return F.md5(F.array_join(F.transform(F.split(text, " "), lambda w: F.coalesce(same[w], w)), " ").cast("binary"))


def license_matches(docs: DataFrame, known: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``license`` (of the whole
    text; NULL if it is no known licence), ``n_notices`` (lines that are a
    known text) and ``notices`` (their distinct licences, sorted; empty if
    none).  Where equal texts are known by several names, the smallest.

    NULL and empty texts match nothing.  Rows that repeat both doc_id and
    text get equal answers.  No rows give no rows; other columns are
    ignored.  ``known`` has (``license``, ``text``); its rows with NULL are
    ignored.
    """
    listed = known.where(F.col("license").isNotNull() & F.col("text").isNotNull()).select(
        "license", canonical(canonical_lines(F.col("text"))).alias("c")).where("c <> ''")
    table = listed.groupBy(digest(F.col("c")).alias("digest")).agg(F.min("license").alias("license"))
    # The word counts of the known texts: at most one number per text.
    sizes = [r["n"] for r in listed.select(words_in(F.col("c")).alias("n")).distinct().collect()] or [-1]
    lines = docs.select(group_key(F.col(doc_id)).alias("_id"), F.col(doc_id).alias("doc_id"), F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("_key"),
                        canonical_lines(F.col(text)).alias("_lines"))
    of_line = F.filter(F.transform("_lines", lambda line, i: F.struct(i.alias("at"), line.alias("c"))), lambda u: words_in(u["c"]).isin(sizes))
    whole = F.array(F.struct(F.lit(-1).alias("at"), canonical(F.col("_lines")).alias("c")))
    units = lines.select("_id", "doc_id", "_key", F.concat(F.filter(whole, lambda u: words_in(u["c"]).isin(sizes)), of_line).alias("_units"))
    found = (
        units.select("_id", "_key", F.explode("_units").alias("u")).select("_id", "_key", "u.at", digest(F.col("u.c")).alias("digest"))
        .join(table, "digest").groupBy("_id", "_key", "at").agg(F.min("license").alias("license"))
        .groupBy("_id", "_key").agg(
            F.max(F.when(F.col("at") < 0, F.col("license"))).alias("license"),
            F.sum((F.col("at") >= 0).cast("bigint")).alias("n_notices"),
            F.sort_array(F.collect_set(F.when(F.col("at") >= 0, F.col("license")))).alias("notices"))
    )
    keys = docs.select(group_key(F.col(doc_id)).alias("_id"), F.col(doc_id).alias("doc_id"), F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("_key"))
    return keys.join(found, ["_id", "_key"], "left").select(
        "doc_id", "license", F.coalesce("n_notices", F.lit(0)).cast("bigint").alias("n_notices"),
        F.coalesce("notices", F.array().cast("array<string>")).alias("notices"))
