"""Licence scans: TF-IDF cosine of licence statements to templates, inherited down directories.

Statements are the parts of a text that have a cue word: sentences, paragraphs joined over line breaks and
comment marks, the comment block at its head, and the whole text. Equal ones are scored once. A tag names its
licence itself. Vectors
are sparse rows (statement, word, weight), with document frequencies counted over all statements of all
files. The best template above the threshold is a file's own licence. The licence of a licence file is
its directory's, and a file without one has that of the nearest directory above it, found by joining
each directory's ancestors with the directories that have a licence.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .rows import cells, column, field, freeze, row_key

#: Least cosine of a statement and a template.
THRESHOLD = 0.75

#: Characteristic statements of published licences, by SPDX identifier.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions:",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("ISC", "Licensed under the ISC License."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("Zlib", "Licensed under the zlib License."),
    (
        "EPL-2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    ),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "Released into the public domain under CC0 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    (
        "CC-BY-NC-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("proprietary", "All rights reserved."),
)

#: What stands after the permission in the MIT licence, and after the terms in others.
_MIT_END = (
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
    'the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT '
    "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
    "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN "
    "ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR "
    "OTHER DEALINGS IN THE SOFTWARE."
)
#: What the two licences of redistribution share, and the clause that only the longer one has.
_BSD_TERMS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution."
)
_BSD_NAMES = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission."
)
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED "
    "WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT "
    "HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
    "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR "
    "BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR "
    "TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
    "POSSIBILITY OF SUCH DAMAGE."
)
_ISC_GRANT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
)
_ISC_NOTICE = "provided that the above copyright notice and this permission notice appear in all copies."
_ISC_END = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN "
    "AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
    "PERFORMANCE OF THIS SOFTWARE."
)
_BOOST_GRANT = (
    "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
    'accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, '
    "and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the "
    "Software is furnished to do so, all subject to the following:"
)
_BOOST_END = (
    "The copyright notices in the Software and this entire statement, including the above license grant, this restriction "
    "and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative "
    "works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code "
    'generated by a source language processor. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR '
    "IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND "
    "NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES "
    "OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR "
    "THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ZLIB = (
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable "
    "for any damages arising from the use of this software. Permission is granted to anyone to use this software for any "
    "purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following "
    "restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original "
    "software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated "
    "but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being "
    "the original software. 3. This notice may not be removed or altered from any source distribution."
)


def _template(name: str, beginning: str) -> str:
    return next(text for n, text in TEMPLATES if n == name and text.startswith(beginning))


def _gnu(name: str, version: str) -> tuple[str, str]:
    """The first paragraph of a file's notice under a GNU licence, and the whole notice."""
    first = (
        f"This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as "
        f"published by the Free Software Foundation, either version {version} of the License, or (at your option) any "
        "later version."
    )
    return first, (
        f"{first} This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
        f"the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more "
        f"details. You should have received a copy of the GNU {name} along with this program. If not, see "
        "<https://www.gnu.org/licenses/>."
    )


_GNU = (
    ("GPL-3.0", "General Public License", "3", "29 June 2007"),
    ("GPL-2.0", "General Public License", "2", "June 1991"),
    ("LGPL-3.0", "Lesser General Public License", "3", "29 June 2007"),
    ("LGPL-2.1", "Lesser General Public License", "2.1", "February 1999"),
    ("AGPL-3.0", "Affero General Public License", "3", "19 November 2007"),
)

#: Whole licences and notices, and the headings of licences that are longer than a page.
TEMPLATES += (
    ("MIT", f"MIT License {_template('MIT', 'Permission')} {_MIT_END}"),
    ("BSD-3-Clause", f"BSD 3-Clause License {_BSD_TERMS} {_BSD_NAMES} {_BSD_END}"),
    ("BSD-2-Clause", f"BSD 2-Clause License {_BSD_TERMS} {_BSD_END}"),
    ("ISC", f"ISC License {_ISC_GRANT}, {_ISC_NOTICE} {_ISC_END}"),
    ("0BSD", f"BSD Zero Clause License {_ISC_GRANT}. {_ISC_END}"),
    ("BSL-1.0", _BOOST_GRANT),
    ("BSL-1.0", f"Boost Software License - Version 1.0 - August 17th, 2003 {_BOOST_GRANT} {_BOOST_END}"),
    ("Zlib", f"zlib License {_ZLIB}"),
    ("EPL-2.0", "Eclipse Public License - v 2.0"),
    (
        "Apache-2.0",
        f"{_template('Apache-2.0', 'Licensed under the Apache License, Version 2.0 (')} You may obtain a copy of the "
        "License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF '
        "ANY KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License.",
    ),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    *((spdx, text) for spdx, name, version, _ in _GNU for text in _gnu(name, version)),
    *((spdx, f"GNU {name} Version {version}, {date}") for spdx, name, version, date in _GNU),
)

#: Words that mark a statement, and names of licence files.
CUE = re.compile(
    r"licen[sc]|rights\W+reserved|spdx|public\W+domain|permission\W+is\W+hereby\W+granted|redistribution\W+and\W+use"
    r"|permission\W+to\W+use|permission\W+is\W+granted"
    r"|free\W+software|source\W+code\W+form|creative\W+commons|\bcc[ -]?(?:by|0)\b",
    re.IGNORECASE,
)
#: A tag that names a licence, or several joined by operators.
TAG = re.compile(
    r"SPDX-License-Identifier:[ \t]*\(?([A-Za-z0-9][A-Za-z0-9.+-]*(?:[ \t]+(?:AND|OR|WITH)[ \t]+[A-Za-z0-9][A-Za-z0-9.+-]*)*)"
)
#: What a file is only where nothing else is found.
RESERVED = "proprietary"
LICENSE_FILE = r"(?i)^(un)?(licen[sc]e|copying|copyright|notice)([-_.].*)?$"
SENTENCE_END = re.compile(r"[.!?](?=\s)|\n")
WORDS = re.compile(r"[a-z0-9]+(?:[.-][a-z0-9]+)*")
#: The comments at the head of a file, and lines without a letter or digit, which may hold comment marks.
HEADER = re.compile(
    r"(?:#![^\n]*\n)?\s*+(?:/\*.*?\*/|<!--.*?-->|(?:[ \t]*+(?://|\#|--|;|%)[^\n]*+(?:\n|$)|[ \t]*+\n)+)", re.DOTALL
)
#: Lines that name a holder, which are no part of a licence's text.
HOLDER = re.compile(r"^\W*(?:copyright\b|\(c\)|©)[^\n]*$", re.IGNORECASE | re.MULTILINE)
GAP = re.compile(r"\n(?:[^\w\n]*+\n)+")


def words_of(statement: str) -> str:
    return " ".join(WORDS.findall(statement.lower()))


def _sentences(text: str, found: dict[str, None]) -> None:
    place = 0
    while cue := CUE.search(text, place):
        start = place
        for end in SENTENCE_END.finditer(text, place, cue.start()):
            start = end.end()
        stop = SENTENCE_END.search(text, cue.end())
        place = stop.end() if stop else len(text)
        if words := words_of(text[start:place]):
            found[words] = None


def statements(text: str) -> list[str]:
    """The distinct parts of a text with a cue word, as their words: the sentences of its lines, its paragraphs and
    their sentences, the comments at its head, and the text as a whole, these without the lines of holders.
    Comment marks are no words."""
    found: dict[str, None] = {}
    if not CUE.search(text):
        return []
    text = text.replace("\r\n", "\n")
    _sentences(text, found)
    header = HEADER.match(text)
    for part in (*GAP.split(text), header[0] if header else "", text):
        part = HOLDER.sub("", part)
        if CUE.search(part):
            _sentences(part.replace("\n", " "), found)
            found[words_of(part)] = None
    return [words for words in found if words]


def tags(text: str) -> list[str]:
    """The distinct licences that tags name, as they are written."""
    return list(dict.fromkeys(" ".join(m[1].split()) for m in TAG.finditer(text)))


def _words(statement: Column) -> Column:
    return F.explode(F.split(statement, " "))


def scored_statements(distinct: DataFrame, threshold: float) -> DataFrame:
    """(key, license, score) of the statements that are like a template.

    `distinct` has key, statement and n, the number of files that have it; only the key goes with each word, as a
    statement may be a whole text. A statement that is as close to
    several templates has the license that comes first in the alphabet.
    """
    spark: SparkSession = distinct.sparkSession
    rows = [(i, name, words_of(text)) for i, (name, text) in enumerate(TEMPLATES)]
    templates = spark.createDataFrame(rows, "template int, license string, statement string")
    words = distinct.select("key", "n", _words(F.col("statement")).alias("word")).groupBy("key", "word")
    words = freeze(words.agg(F.count("*").alias("tf"), F.first("n").alias("n")))
    of_templates = templates.withColumn("word", _words(F.col("statement")))
    of_templates = of_templates.groupBy("template", "license", "word").agg(F.count("*").alias("tf"))
    # The frequencies that are needed are those of the templates' words and, for lengths, of all words.
    total = distinct.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    idf = words.groupBy("word").agg(F.sum("n").alias("df")).select(
        "word", (F.log((1.0 + total) / (1.0 + F.col("df"))) + 1).alias("idf")
    )
    rare = F.lit(1.0 + total)
    weights = words.join(idf, "word").select("key", "word", (F.col("tf") * F.col("idf")).alias("weight"))
    sizes = weights.groupBy("key").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("size"))
    t_weights = of_templates.join(idf, "word", "left").withColumn(
        "t_weight", F.col("tf") * F.coalesce("idf", F.log(rare) + 1)
    )
    t_sizes = t_weights.groupBy("template").agg(F.sqrt(F.sum(F.col("t_weight") * F.col("t_weight"))).alias("t_size"))
    # A row for each word of each template: a table of fixed size.
    t_side = F.broadcast(t_weights.join(t_sizes, "template").select("template", "license", "word", "t_weight", "t_size"))
    dots = weights.join(t_side, "word").groupBy("key", "template", "license", "t_size").agg(
        F.sum(F.col("weight") * F.col("t_weight")).alias("dot")
    )
    cosine = F.round(F.col("dot") / (F.col("size") * F.col("t_size")), 9)
    scored = dots.join(sizes, "key").withColumn("score", cosine).where(F.col("score") >= threshold)
    best = F.min(F.struct((-F.col("score")).alias("order"), "license")).alias("best")
    return scored.groupBy("key").agg(best).select(
        "key", F.col("best.license").alias("license"), (-F.col("best.order")).alias("score")
    )


def own_licenses(files: DataFrame, threshold: float) -> DataFrame:
    """row_key, license and score of the files that have a licence statement. `files` has row_key and body."""

    def rows(batches):
        import pyarrow as pa

        for batch in batches:
            row, found, tagged = [], [], []
            for i, body in enumerate(cells(batch, "body")):
                text = body.decode("utf-8", "replace")
                here, named = statements(text), tags(text)
                row += [i] * (len(here) + len(named))
                found += here + named
                tagged += [False] * len(here) + [True] * len(named)
            yield pa.RecordBatch.from_pydict(
                {
                    "row_key": field(batch, "row_key").take(pa.array(row, pa.int64())),
                    "statement": pa.array(found, pa.string()),
                    "tagged": pa.array(tagged, pa.bool_()),
                }
            )

    said = files.select("row_key", "body").mapInArrow(rows, "row_key string, statement string, tagged boolean")
    said = freeze(said.withColumn("key", F.md5("statement")))
    texts = said.where("not tagged")
    # A statement that a third of all files have is one row from here on.
    scored = scored_statements(texts.groupBy("key", "statement").agg(F.count("*").alias("n")), threshold)
    named = said.where("tagged").select(
        "row_key", F.col("statement").alias("license"), F.lit(1.0).alias("score"), F.lit(False).alias("untagged")
    )
    alike = texts.select("row_key", "key").join(scored, "key")
    alike = alike.select("row_key", "license", "score", F.lit(True).alias("untagged"))
    # A tag comes first; reserved rights count only where nothing else is found.
    best = F.min(F.struct(_reserved("license"), "untagged", (-F.col("score")).alias("order"), "license")).alias("best")
    return alike.unionByName(named).groupBy("row_key").agg(best).select(
        "row_key", F.col("best.license").alias("own_license"), (-F.col("best.order")).alias("score")
    )


def _reserved(license: str) -> Column:
    return (F.col(license) == RESERVED).alias("reserved")


def _parent(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


def license_scan(
    files: DataFrame, path_col: str, text_col: str, keep: tuple[str, ...] = (), threshold: float = THRESHOLD
) -> DataFrame:
    """One row per row of `files`: row_key, path, the columns in `keep`, own_license, score, license,
    license_dir and inherited.

    `license` is the own one, or that of the nearest directory above with a licensed licence file;
    license_dir is that directory ('' is the root). A file that only reserves its rights has the licence
    of such a directory too, if it is one. Of several licence files in a directory the best
    score counts, then the first in the alphabet. A missing text is empty; a file without a path has
    no directory and inherits nothing. Paths may be repeated. An empty table gives no rows.
    """
    body = F.coalesce(column(text_col).cast("string"), F.lit("")).cast("binary").alias("body")
    path = F.regexp_replace(column(path_col).cast("string"), "^/+|/+$", "").alias("path")
    rows = files.select(row_key(files).alias("row_key"), path, *map(column, keep), body)
    own = freeze(own_licenses(rows, threshold))
    skinny = rows.drop("body").withColumn("dir", _parent(F.col("path")))
    found = freeze(skinny.join(own, "row_key", "left"))
    named = F.regexp_extract("path", "[^/]*$", 0).rlike(LICENSE_FILE)
    best = F.min(F.struct(_reserved("own_license"), (-F.col("score")).alias("order"), "own_license")).alias("best")
    licensed = found.where(named & F.col("own_license").isNotNull()).groupBy("dir").agg(best)
    licensed = licensed.select(F.col("dir").alias("license_dir"), F.col("best.own_license").alias("dir_license"))
    # Each directory once, with all directories above it and itself.
    parts = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    dirs = found.select("dir").where("dir is not null").distinct()
    nearest = (
        dirs.withColumn("license_dir", F.explode(F.array_distinct(above)))
        .join(licensed, "license_dir")
        .groupBy("dir")
        .agg(F.max(F.struct(F.length("license_dir").alias("depth"), "license_dir", "dir_license")).alias("near"))
    )
    only_reserved = F.coalesce(F.col("own_license") == RESERVED, F.lit(True))
    grants = F.col("own_license").isNull() | (F.col("near.dir_license") != RESERVED)
    inherited = only_reserved & F.col("near").isNotNull() & grants
    return found.join(nearest, "dir", "left").select(
        "row_key",
        "path",
        *map(column, keep),
        "own_license",
        "score",
        F.when(inherited, F.col("near.dir_license")).otherwise(F.col("own_license")).alias("license"),
        F.when(inherited, F.col("near.license_dir")).alias("license_dir"),
        inherited.alias("inherited"),
    )
