"""Licence scans: sparse TF-IDF cosine to templates, then inheritance from the nearest ancestor directory.

Every text is cut into passages (lines and sentences). A passage that shares a telling term with a
template is compared with all templates by the cosine of sparse TF-IDF vectors; document frequencies
are counted over all texts. A file's own licence is its best passage of at least ``LEAST`` cosine. A
file is a licence file of its directory if its base name says so, or if the found passage makes up at
least half of its terms. Files without a licence of their own get the one of the nearest directory
above them that has a licence file: an equality join of ancestor paths.

Passages don't find licences that wrap over lines or state their name only once for many lines. Of every
text with a telling term, so are compared as well: whole paragraphs and their sentences with line ends
and comment marks folded into blanks, comment blocks, and the whole text, all with a telling term, and compared
with the headers and licence texts of ``WHOLE`` too. What is found so counts
where the passages give no licence, or where a text of ``WHOLE`` names another one. An SPDX identifier
goes before all of these, with a score of 1.

All work is done by DataFrame functions. Directories are joined by path with their licence, one row
each, after the licence files of a directory have been aggregated; hot directories only repeat a row
of one side.

Null text counts as empty, a null path has no directory. Ties go to the greater cosine, then the
licence first by name; of several licence files in a directory the licence most of them have counts,
then the first by name. "All rights reserved." gives a licence only to a text that names no other, and none where
other words on licences stand in its paragraph. A part that gives numbers has to give those of the licence's
version. Rows that repeat a name, or have none, are files of their own: a table gives as many rows as it has. A text of
any length is looked at as a whole. Other columns do not matter, whatever their names. An empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from liftwork.llm import staging
from liftwork.llm.components import Spread

# Wordings by which public licences are usually named in headers and notices.
TEMPLATES = (
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("0BSD", "Released under the Zero-Clause BSD License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "This project is licensed under the Apache License 2.0 - see the LICENSE.md file for details."),
    ("Apache-2.0 OR MIT", "Licensed under either of Apache License, Version 2.0 or MIT license at your option."),
    ("Apache-2.0 OR MIT", "either of Apache License, Version 2.0 or MIT"),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "This project is licensed under the BSD 3-Clause License - see the LICENSE.md file for details."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("CC-BY-3.0", "Licensed under CC BY 3.0."),
    ("CC-BY-3.0", "This work is licensed under a Creative Commons Attribution 3.0 Unported License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-3.0", "Licensed under CC BY-SA 3.0."),
    ("CC-BY-SA-3.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright under CC0 1.0."),
    ("EPL-1.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0."),
    ("GPL-1.0", "This work is licensed under the GNU General Public License, version 1."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License, either version 3 of the License, or any later version."),
    ("ISC", "Released under the ISC License."),
    ("LGPL-2.0", "This work is licensed under the GNU Library General Public License, version 2."),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License - see the LICENSE.md file for details."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Proprietary", "All rights reserved."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions"),
)

_GNU_VERSION = "This program is free software; you can redistribute it and/or modify it under the terms of the GNU {0} as published by the Free Software Foundation; either version {1} of the License, or (at your option) any later version."
_GNU_ONLY = "This program is free software; you can redistribute it and/or modify it under the terms of the GNU {0}, version {1}, as published by the Free Software Foundation."
_GNU_REST = " This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0} for more details."
_GNU = (("GPL-1.0", "General Public License", "1"), ("LGPL-2.0", "Library General Public License", "2"), ("LGPL-2.1", "Lesser General Public License", "2.1"), ("GPL-2.0", "General Public License", "2"), ("GPL-3.0", "General Public License", "3"), ("LGPL-3.0", "Lesser General Public License", "3"), ("AGPL-3.0", "Affero General Public License", "3"))
_APACHE = "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
_BSD_NAMES = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. "
_BSD_REST = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
_MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
_MIT_REST = " The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
_ISC_REST = "THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
_ZLIB = "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."
# Whole headers and licence texts; of the long licences their headers and titles.
WHOLE = (
    *((name, _GNU_VERSION.format(kind, version) + rest) for name, kind, version in _GNU for rest in ("", _GNU_REST.format(kind))),
    *((name, _GNU_ONLY.format(kind, version)) for name, kind, version in _GNU),
    ("GPL-1.0", "GNU GENERAL PUBLIC LICENSE Version 1, February 1989"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("LGPL-2.0", "GNU LIBRARY GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("Apache-2.0", _APACHE),
    ("Apache-2.0", _APACHE + " Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("BSD-2-Clause", _BSD + _BSD_REST),
    ("BSD-3-Clause", _BSD + _BSD_NAMES + _BSD_REST),
    ("0BSD", _ISC.split(", provided")[0] + ". " + _ISC_REST),
    ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)"),
    ("Zlib", _ZLIB),
    ("ISC", _ISC),
    ("ISC", _ISC + " " + _ISC_REST),
    ("MIT", _MIT),
    ("MIT", _MIT + _MIT_REST),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
)

#: A passage without any of these terms is not compared: they carry the templates' weight.
TELLING = ("license", "licensed", "licence", "licenced", "copyright", "reserved", "permission", "redistribution", "unencumbered", "redistribute", "cc0")
LEAST = 0.6
#: The licence of texts that say only this; it counts nowhere where other words on licences stand beside it.
RESERVED = "Proprietary"
_OTHER_WORDS = r"(?i)\b(licen[cs]e[ds]?|permission|redistribut(e|ion)|unencumbered|cc0|terms of)\b"
#: Terms that give the number of a version.
_NUMBER = r"^v?([0-9]{1,2})$"
#: Ways to compare: lines and sentences with TEMPLATES, folded parts with WHOLE as well.
LINE, BLOCK = 0, 1
#: Tasks that the files of one part are dealt over.
SALTS = 32
FILE_NAMES = r"(?i)^(licen[cs]e|copying|notice|unlicense)(\..*)?$"

_PASSAGES = r"\n|(?<=[.!?:;]) +"
_WORDS = r"[^a-z0-9]+"
#: Line ends with the comment marks beside them; those that part paragraphs; those that part comment blocks and other lines.
_MARK = r"(?:(?://|/\*|<!--|--(?!>)|[#*;%>!])[/*#;%!]*+)"
_FOLD = rf"(?<![ \t\r])[ \t\r]*+(?:\*/|-->)?+[ \t\r]*+\n[ \t]*+{_MARK}?+[ \t]*+"
_PARAGRAPHS = rf"\n[ \t]*+{_MARK}?+[ \t]*+(?:/|-->)?+[ \t\r]*+(?=\n)"
_BLOCKS = rf"\n(?![ \t]*+{_MARK})"
_C_BLOCKS = r"/\*[^*]*+(?:\*(?!/)[^*]*+)*+(?:\*/|\z)"
_SENTENCES = r"(?<=[.!?]) +"
_SPDX = r"SPDX-License-Identifier:[ \t]*\(*([A-Za-z0-9.+-]*[A-Za-z0-9+])"
_HINT = r"(?i)\b(" + "|".join(TELLING) + r")\b"


def terms(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), _WORDS), lambda w: w != "")


def _weighed(counted: DataFrame, weights: DataFrame, total: int) -> DataFrame:
    """``counted`` (mode, term, tf, ...) with df (NULL for terms of no template) and w; terms of no template weigh like rare ones."""
    idf = F.log((F.lit(total) + 1) / (F.coalesce(F.col("df"), F.lit(0)) + 1)) + 1
    return counted.join(F.broadcast(weights), ["mode", "term"], "left").withColumn("w", F.col("tf") * idf)  # terms of the templates only


def own_licences(files: DataFrame) -> DataFrame:
    """(file, licence, score, whole) of the files (file, text) with a licence of their own; files with equal keys have equal texts and are one row."""
    spark = files.sparkSession
    rows = [(mode, i, name, text) for mode, known in ((LINE, TEMPLATES), (BLOCK, (*TEMPLATES, *WHOLE))) for i, (name, text) in enumerate(known)]
    templates = spark.createDataFrame(rows, "mode int, template int, licence string, text string")
    of_template = templates.select("mode", "template", F.explode(terms(F.col("text"))).alias("term"))
    words = of_template.select("mode", "term").distinct()
    vocabulary = sorted({r["term"] for r in words.collect()})  # the templates' own words
    text = F.coalesce(F.col("text"), F.lit(""))
    present = F.array_intersect(terms(text), F.array(*(F.lit(t) for t in vocabulary)))
    frequencies = files.select(F.explode(present).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weights = words.join(staging.stored(frequencies, "licence-frequencies"), "term", "left").select("mode", "term", F.coalesce("df", F.lit(0)).alias("df"))
    total = files.count()
    parts = staging.stored(_parts(files), "licence-parts")
    best = _best(parts, of_template, templates, weights, total)
    a, b = F.col("line"), F.col("block")
    found = best.groupBy("file").agg(*(F.max(F.when(F.col("mode") == m, F.col("b"))).alias(n) for m, n in ((LINE, "line"), (BLOCK, "block"))))
    other = a["licence"].isNull() | ((b["template"] >= len(TEMPLATES)) & (a["licence"] != b["licence"])) | ((a["licence"] == RESERVED) & (b["licence"] != RESERVED))
    identifier = F.regexp_replace(F.regexp_extract(text, _SPDX, 1), r"(-only|-or-later|\+)$", "")
    spdx = files.where(text.contains("SPDX-")).select("file", identifier.alias("spdx"), F.size(F.filter(F.split(text, r"\n"), lambda x: F.trim(x) != "")).alias("lines")).where("spdx <> ''").dropDuplicates(["file"])
    chosen = F.when(b.isNotNull() & other, b).otherwise(a)
    return found.join(spdx, "file", "full").select(
        "file", F.coalesce("spdx", chosen["licence"]).alias("licence"), F.when(F.col("spdx").isNotNull(), 1.0).otherwise(-chosen["s"]).alias("score"),
        F.when(F.col("spdx").isNotNull(), F.coalesce(chosen["whole"], F.lit(False)) | (F.col("lines") == 1)).otherwise(chosen["whole"]).alias("whole"),
    )


def _parts(files: DataFrame) -> DataFrame:
    """(file, of_file, beside, mode, at, part, key): the parts with a telling term of each text; key: a digest of mode and part.

    beside: whether other words on licences stand in one paragraph with "All rights reserved".

    LINE: lines and sentences of them. BLOCK: the whole text, its paragraphs, comment blocks and sentences,
    all with line ends and comment marks folded.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    fold = lambda c: F.trim(F.regexp_replace(F.concat(F.lit("\n"), c), _FOLD, " "))
    telling = lambda c: F.filter(c, lambda x: x.rlike(_HINT))
    # a paragraph or block is folded only if it has a telling term
    paragraphs = F.transform(telling(F.split(F.concat(F.lit("\n"), text, F.lit("\n")), _PARAGRAPHS)), fold)
    sentences = telling(F.flatten(F.transform(paragraphs, lambda p: F.split(p, _SENTENCES))))
    blocks = F.transform(telling(F.concat(F.split(text, _BLOCKS), F.regexp_extract_all(text, F.lit(_C_BLOCKS), F.lit(0)))), fold)
    folded = F.array_distinct(F.concat(F.array(fold(text)), paragraphs, blocks, sentences))
    each = lambda mode, c: F.transform(c, lambda x, at: F.struct(F.lit(mode).alias("mode"), at.alias("at"), x.alias("part")))
    lines = each(LINE, F.split(text, _PASSAGES))
    every = F.concat(F.filter(lines, lambda x: x["part"].rlike(_HINT)), each(BLOCK, folded))
    beside = F.exists(F.split(F.concat(F.lit("\n"), text, F.lit("\n")), _PARAGRAPHS), lambda p: p.rlike(r"(?i)all rights reserved") & p.rlike(_OTHER_WORDS))
    hinted = files.where(text.rlike(_HINT)).select("file", F.size(terms(text)).alias("of_file"), beside.alias("beside"), F.explode(every).alias("p"))
    return hinted.select("file", "of_file", "beside", "p.mode", "p.at", "p.part", F.md5(F.concat(F.col("p.mode").cast("string"), F.col("p.part"))).alias("key"))


def _best(parts: DataFrame, of_template: DataFrame, templates: DataFrame, weights: DataFrame, total: int) -> DataFrame:
    """(file, mode, b) of the files with a part of at least ``LEAST``; b: its struct (s, licence, at, whole, template), s the score below zero.

    Equal parts are compared once. Their terms stay in the partition of their part, so they are never
    shuffled. The share of a vector that lies on terms of templates bounds its cosine to all of them: parts
    with too small a share go no further.
    """
    counts = of_template.groupBy("mode", "template", "term").agg(F.count(F.lit(1)).alias("tf"))
    right = _weighed(counts, weights, total)
    norms = right.groupBy("mode", "template").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    right = right.join(norms, ["mode", "template"]).select("mode", "template", "term", (F.col("w") / F.col("norm")).alias("tw"))
    distinct = parts.select("mode", "key", "part").dropDuplicates(["mode", "key"])
    left = _weighed(distinct.select("mode", "key", F.explode(terms(F.col("part"))).alias("term")).groupBy("mode", "key", "term").agg(F.count(F.lit(1)).alias("tf")), weights, total)
    square, known = F.col("w") * F.col("w"), F.col("df").isNotNull()
    vectors = left.groupBy("mode", "key").agg(
        F.sqrt(F.sum(square)).alias("norm"), F.sqrt(F.sum(F.when(known, square))).alias("there"), F.sum("tf").alias("n_terms"), F.collect_list(F.when(known, F.struct("term", "w"))).alias("v"),
        F.collect_set(F.nullif(F.regexp_extract("term", _NUMBER, 1), F.lit(""))).alias("numbers"),
    )
    likely = vectors.where(F.col("there") >= F.col("norm") * (LEAST - 1e-3))
    flat = likely.select("mode", "key", "norm", "n_terms", "numbers", F.explode("v").alias("v")).select("mode", "key", "norm", "n_terms", "numbers", "v.term", "v.w")
    cosine = flat.join(F.broadcast(right), ["mode", "term"]).groupBy("mode", "key", "n_terms", "numbers", "template").agg(F.round(F.sum(F.col("w") / F.col("norm") * F.col("tw")), 6).alias("score"))
    named = cosine.where(F.col("score") >= LEAST).join(F.broadcast(templates.select("mode", "template", "licence")), ["mode", "template"])
    # a text that gives numbers has to give those of the licence's version
    asked = F.filter(F.split(F.regexp_replace("licence", "^0", ""), "[^0-9]+"), lambda x: ~x.isin("", "0"))
    named = named.where((F.size("numbers") == 0) | (F.size(F.array_except(asked, "numbers")) == 0))
    of_part = named.groupBy("mode", "key").agg(F.min(F.struct((-F.col("score")).alias("s"), "licence", "template", "n_terms")).alias("m"))
    # a part that very many files have is spread over tasks: only parts with a licence are copied
    of_part = of_part.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    found = parts.select("file", "of_file", "beside", "mode", "at", "key", F.pmod(F.xxhash64("file"), F.lit(SALTS)).cast("int").alias("salt")).join(of_part, ["mode", "key", "salt"])
    found = found.where((F.col("m.licence") != RESERVED) | ~F.col("beside"))
    whole = (F.col("m.n_terms") * 2 >= F.col("of_file")).alias("whole")
    return found.groupBy("file", "mode").agg(F.min(F.struct("m.s", "m.licence", "at", whole, "m.template")).alias("b"))


def scan(files: DataFrame) -> DataFrame:
    """(file, path, licence, score, origin, found_in) of every row of (file, path, text); file may be null or repeat.

    origin: own, inherited or none; found_in: the directory that a licence is inherited from. Rows are known by a digest
    of their text, so a row's licence is that of its own text whatever other rows have its name.
    """
    files = files.select("path", F.col("file").alias("_name"), F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("file"), F.col("text").cast("string").alias("text"))
    own = staging.stored(own_licences(files), "licence-own")
    base = F.regexp_extract("path", r"([^/]*)$", 1)
    above = F.when(F.instr("path", "/") > 0, F.regexp_replace("path", r"/[^/]*$", "")).otherwise(F.when(F.col("path").isNotNull(), F.lit("")))
    spread = Spread(staging.stored(files.groupBy("file").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "licence-copies"), "file", "n")
    table = spread.dealt(files.select("file", "_name", "path", above.alias("directory"), base.rlike(FILE_NAMES).alias("named")), "file", F.struct("_name", "path")).drop("spread").join(spread.copied(own, "file"), ["file", "salt"], "left").drop("salt")
    votes = table.where("licence is not null and directory is not null and (named or whole)").groupBy("directory", "licence").agg(F.count(F.lit(1)).alias("votes"))
    given = votes.groupBy("directory").agg(F.min(F.struct((-F.col("votes")).alias("v"), "licence")).alias("b")).select("directory", F.col("b.licence").alias("given"))
    # every directory in use with all its ancestors, nearest first
    steps = F.split("directory", "/")
    ancestors = table.select("directory").where("directory is not null").distinct()
    ancestors = ancestors.select("directory", F.explode(F.sequence(F.lit(0), F.size(steps))).alias("up"))
    ancestors = ancestors.withColumn("ancestor", F.array_join(F.slice(steps, F.lit(1), F.size(steps) - F.col("up")), "/"))
    nearest = ancestors.join(given.withColumnRenamed("directory", "ancestor"), "ancestor")
    nearest = nearest.groupBy("directory").agg(F.min(F.struct("up", "ancestor", "given")).alias("b"))
    inherited = staging.stored(nearest.select("directory", F.col("b.given").alias("given"), F.col("b.ancestor").alias("found_in")), "licence-directories")
    whole = table.join(inherited, "directory", "left")
    origin = F.when(F.col("licence").isNotNull(), "own").when(F.col("given").isNotNull(), "inherited").otherwise("none")
    return whole.select(
        F.col("_name").alias("file"), "path", F.coalesce("licence", "given").alias("licence"), "score", origin.alias("origin"), F.when(F.col("licence").isNull(), F.col("found_in")).alias("found_in")
    )


def document_path() -> Column:
    """Documents have no paths of their own: source, language and thousand make their directories."""
    thousand = F.floor(F.col("doc_id") / 1000).cast("string")
    return F.concat_ws("/", F.col("source"), F.col("lang"), thousand, F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = staging.documents(spark, sf_dir)
    found = scan(docs.select(F.col("doc_id").alias("file"), document_path().alias("path"), "text"))
    return found.select(F.col("file").alias("doc_id"), "path", "licence", "score", "origin", "found_in")


_RE_WORDS = "list_filter(string_split_regex(lower({0}), '[^a-z0-9]+'), lambda w: w <> '')"
ORACLE_SQL = f"""
with templates(template, licence, text) as (values {", ".join(f"({i}, '{n}', '{t.replace(chr(39), chr(39) * 2)}')" for i, (n, t) in enumerate(TEMPLATES))}),
asked as (select template, list_filter(string_split_regex(regexp_replace(licence, '^0', ''), '[^0-9]+'), lambda x: x not in ('', '0')) as numbers from templates),
docs as (select row_number() over () as file, * from documents),
files as (select file, doc_id, concat_ws('/', source, lang, floor(doc_id / 1000)::bigint::varchar, doc_id || '.txt') as path, coalesce(text, '') as text from docs),
tterms as (select template, unnest({_RE_WORDS.format("text")}) as term from templates),
fterms as (select file, {_RE_WORDS.format("text")} as words from files),
freq as (select term, count(*) as df from (select distinct file, unnest(words) as term from fterms) where term in (select term from tterms) group by term),
total as (select count(*) as n from files),
beside as (select file, len(list_filter(string_split_regex(text, '\\n[ \\t]*\\n'), lambda p: regexp_matches(p, '(?i)all rights reserved') and regexp_matches(p, '{_OTHER_WORDS}'))) > 0 as beside from files where regexp_matches(text, '(?i)all rights reserved')),
hinted as (select file, text, len({_RE_WORDS.format("text")}) as of_file from files where regexp_matches(text, '{_HINT}')),
passages as (select file, of_file, unnest(string_split_regex(regexp_replace(text, '([.!?:;]) +', '\\1' || chr(10), 'g'), '\\n')) as passage, generate_subscripts(string_split_regex(regexp_replace(text, '([.!?:;]) +', '\\1' || chr(10), 'g'), '\\n'), 1) as pos from hinted),
pterms as (select file, pos, of_file, unnest({_RE_WORDS.format("passage")}) as term from passages where regexp_matches(passage, '{_HINT}')),
pw as (select file, pos, of_file, term, tf, tf * (ln((n + 1) / (coalesce(df, 0) + 1)) + 1) as w from (select file, pos, of_file, term, count(*) as tf from pterms group by all) left join freq using (term), total),
tw as (select template, term, tf * (ln((n + 1) / (coalesce(df, 0) + 1)) + 1) as w from (select template, term, count(*) as tf from tterms group by all) left join freq using (term), total),
pn as (select file, pos, sqrt(sum(w * w)) as norm, sum(tf) as n_terms, list(regexp_extract(term, '{_NUMBER}', 1)) filter (where regexp_matches(term, '{_NUMBER}')) as numbers from pw group by file, pos),
tn as (select template, sqrt(sum(w * w)) as norm from tw group by all),
cosine as (select file, pos, of_file, n_terms, coalesce(pn.numbers, []) as numbers, template, round(sum(pw.w / pn.norm * (tw.w / tn.norm)), 6) as score from pw join pn using (file, pos) join tw using (term) join tn using (template) group by all),
fit as (select c.*, licence from cosine c join templates using (template) join asked a using (template) left join beside using (file)
  where score >= {LEAST} and (len(c.numbers) = 0 or list_has_all(c.numbers, a.numbers)) and (licence <> '{RESERVED}' or not coalesce(beside, false))),
firsts as (select file, pos, arg_min(licence, row(-score, licence, template)) as licence, max(score) as score, any_value(n_terms) as n_terms, any_value(of_file) as of_file from fit group by file, pos),
found as (select file, arg_min(licence, row(-score, licence, pos)) as licence, max(score) as score, arg_min(n_terms * 2 >= of_file, row(-score, licence, pos)) as whole from firsts group by file),
spdx as (select file, regexp_replace(regexp_extract(text, 'SPDX-License-Identifier:[ \\t]*\\(*([A-Za-z0-9.+-]*[A-Za-z0-9+])', 1), '(-only|-or-later|\\+)$', '') as licence, len(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '')) = 1 as alone
  from files where contains(text, 'SPDX-') and regexp_matches(text, 'SPDX-License-Identifier:[ \\t]*\\(*[A-Za-z0-9]')),
own as (select coalesce(s.file, f.file) as file, coalesce(s.licence, f.licence) as licence, case when s.file is not null then 1.0 else f.score end as score,
  coalesce(f.whole, false) or coalesce(alone, false) as whole from found f full join spdx s on f.file = s.file),
tab as (select files.file, doc_id, path, regexp_matches(path, '(?i)(^|/)(licen[cs]e|copying|notice|unlicense)(\\.[^/]*)?$') as named, regexp_replace(path, '/[^/]*$', '') as directory, licence, score, whole from files left join own using (file)),
given as (select directory, arg_min(licence, row(-votes, licence)) as given from (select directory, licence, count(*) as votes from tab where licence is not null and (named or whole) group by all) group by directory),
steps as (select distinct directory, string_split(directory, '/') as parts from tab),
ancestors as (select directory, up, array_to_string(parts[1:len(parts) - up], '/') as ancestor from steps, unnest(range(0, len(parts) + 1)) as u(up)),
nearest as (select a.directory, arg_min(given, up) as given, arg_min(ancestor, up) as found_in from ancestors a join given g on a.ancestor = g.directory group by a.directory)
select doc_id, path, coalesce(licence, given) as licence, score, case when licence is not null then 'own' when given is not null then 'inherited' else 'none' end as origin,
  case when licence is null then found_in end as found_in
from tab left join nearest using (directory)
"""
