"""Licence scan of a file tree, in DataFrame functions alone.

Units of text that may state a licence are the lines that hold a keyword (in any file, wherever they
stand), the whole text of files named like a licence file, and headers: paragraphs, comment blocks and runs
of lines in the templates' words, all without comment marks, found over the whole text.  They are compared
with the templates and with longer notices (``HEADERS``), which all weigh the words.  Equal
units are compared once: sparse TF-IDF vectors, an equi-join on terms with the notices' vectors, cosine, and
the best notice at or above the threshold (ties: the smaller name).  A copyright line alone counts as proprietary
only where nothing else in the file states a licence.  An SPDX tag states its expression with score 1.  A file without a
licence of its own inherits that of the nearest directory above it that holds a licence file, by joins on
directory paths.

Defined results: null and empty texts state nothing; a null path is kept and neither gives nor inherits;
repeated rows get equal results; without templates only SPDX tags state a licence.  Of licence files in one
directory the best score gives, then the smaller path, then the smaller name.  Texts of any length are read whole; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.llm.scratch import stored, tidy

THRESHOLD = 0.6
#: Characters of all notices together up to which their vectors are broadcast.
FEW = 1 << 20
KEYWORDS = ("licen", "copyright", "spdx", "all rights reserved", "public domain", "permission is hereby granted")
NAMED = r"(?i)(^|/)(license|licence|copying|notice)[^/]*$"

#: Notices by which works declare well-known licences (fixed values).
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Proprietary", "Copyright. All rights reserved."),
]

#: Words of which every template or header holds one; being single words, they are whole in wrapped texts too.
HINTS = ("licen", "copyright", "spdx", "redistribut", "reserved", "domain", "permission")
_AS_IS = "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
_MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD3 = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_AS_IS = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
_GPL = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0} as published by the Free Software Foundation, either version {1} of the License, or (at your option) any later version."
_GPL_REST = " This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0} for more details. You should have received a copy of the GNU {0} along with this program. If not, see <https://www.gnu.org/licenses/>."
_APACHE = "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
_APACHE_REST = " Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."
_GNU = [("AGPL-3.0", "Affero General Public License", "3"), ("GPL-2.0", "General Public License", "2"), ("GPL-3.0", "General Public License", "3"), ("LGPL-2.1", "Lesser General Public License", "2.1"), ("LGPL-3.0", "Lesser General Public License", "3")]
#: Longer notices, full texts and titles (fixed values).
HEADERS = [
    ("Apache-2.0", _APACHE),
    ("Apache-2.0", _APACHE + _APACHE_REST),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("BSD-2-Clause", f"{_BSD} {_BSD_AS_IS}"),
    ("BSD-3-Clause", "Copyright. All rights reserved. Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", f"{_BSD} {_BSD3}"),
    ("BSD-3-Clause", f"{_BSD} {_BSD3} {_BSD_AS_IS}"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under Creative Commons Attribution-ShareAlike 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("EPL-2.0", "Eclipse Public License - v 2.0"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MIT", _MIT),
    ("MIT", f"MIT License. {_MIT} The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. {_AS_IS}"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    *[(n, _GPL.format(t, v) + rest.format(t)) for n, t, v in _GNU for rest in ("", _GPL_REST)],
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
]
#: Comment marks before and after a line's text.
MARK = r"^[ \t]*(?:/[*/]+!?|\*+/?|#+|;+|--+|<!--|%+|\"{3}|'{3}|(?i:rem|dnl)\b)"
MARK_END = r"[ \t]*(?:\*+/|-->|\"{3}|'{3})?[ \t\r]*$"
#: Share of a line's distinct words that the notices hold, from which it may belong to one.
NOTICE_SHARE = 0.6
_ID = r"[A-Za-z0-9][A-Za-z0-9.+:-]*"
SPDX = rf"(?i)SPDX-License-Identifier:[ \t]*(\(?{_ID}(?:[ \t]+(?:OR|AND|WITH)[ \t]+\(?{_ID}\)?)*)"


def ranked() -> Column:
    """The least of these counts: any licence before a bare copyright, the best score, the smaller name."""
    return F.struct((F.col("license") == "Proprietary").alias("bare"), (-F.col("score")).alias("minus"), "license")


def templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([*TEMPLATES, *HEADERS], "license string, notice string")


def terms(units: DataFrame, key: str, text: str) -> DataFrame:
    """(key, term, tf): the words of each text in lower case and how often they occur."""
    words = units.select(key, F.explode(F.split(F.lower(text), r"[^\p{L}\p{N}]+")).alias("term")).where("term <> ''")
    return words.groupBy(key, "term").agg(F.count("*").cast("double").alias("tf"))


def small(df: DataFrame, is_small: bool) -> DataFrame:
    return F.broadcast(df) if is_small else df


def matched(units: DataFrame, notices: DataFrame, threshold: float, few: bool = False) -> DataFrame:
    """(unit, license, score): the best notice of each distinct unit (unit, notice) that reaches the threshold. few: whether the notices are known to be short together."""
    known = notices.select(F.xxhash64("license", "notice").alias("notice_id"), "license", "notice").dropDuplicates(["notice_id"])
    tf = terms(known, "notice_id", "notice")
    count = known.agg(F.count("*").cast("double").alias("n"))
    idf = tf.groupBy("term").agg(F.count("*").cast("double").alias("df")).crossJoin(F.broadcast(count)).select("term", (F.log((F.col("n") + 1) / (F.col("df") + 1)) + 1).alias("idf"))
    weight = tf.join(idf, "term").select("notice_id", "term", (F.col("tf") * F.col("idf")).alias("wt"))
    norm = weight.groupBy("notice_id").agg(F.sqrt(F.sum(F.col("wt") * F.col("wt"))).alias("norm_t"))
    vectors = weight.join(norm, "notice_id").join(known.select("notice_id", "license"), "notice_id")
    # a word of no template has the weight of one that is in none
    seen = terms(units, "unit", "notice").join(small(idf, few), "term", "left").crossJoin(F.broadcast(count))
    seen = seen.select("unit", "term", (F.col("tf") * F.coalesce("idf", F.log(F.col("n") + 1) + 1)).alias("wu"))
    length = seen.groupBy("unit").agg(F.sqrt(F.sum(F.col("wu") * F.col("wu"))).alias("norm_u"))
    dots = seen.join(small(vectors, few), "term").groupBy("unit", "notice_id", "license", "norm_t").agg(F.sum(F.col("wu") * F.col("wt")).alias("dot"))
    cosine = dots.join(length, "unit").select("unit", "license", F.round(F.col("dot") / (F.col("norm_u") * F.col("norm_t")), 6).alias("score"))
    best = cosine.where(F.col("score") >= threshold).groupBy("unit").agg(F.min(ranked()).alias("b"))
    return best.select("unit", F.col("b.license").alias("license"), (-F.col("b.minus")).alias("score"))


def any_of(text: Column, words: tuple[str, ...]) -> Column:
    return F.greatest(*[F.contains(text, F.lit(k)) for k in words])


def headers(files: DataFrame, notices: DataFrame) -> DataFrame:
    """(row, unit): paragraphs, comment blocks and runs of lines in the notices' words that hold a hint, without comment marks."""
    words = lambda c: F.array_distinct(F.split(F.lower(c), r"[^\p{L}\p{N}]+"))
    vocabulary = notices.select(F.explode(words(F.col("notice"))).alias("term")).agg(F.collect_set("term").alias("vocabulary"))
    bare = lambda c: F.regexp_replace(F.regexp_replace(c, rf"{MARK}?[ \t]*", ""), MARK_END, "")
    known = lambda c: F.size(F.array_intersect(words(c), "vocabulary")) >= NOTICE_SHARE * F.size(words(c))
    lines = F.split("text", r"\r\n|\r|\n")
    some = files.where(any_of(F.lower("text"), HINTS)).select("row", lines.alias("lines")).withColumn("bare", F.transform("lines", bare))
    block = F.transform("lines", lambda x: F.when(x.rlike(MARK), F.concat(F.lit(" "), bare(x))).otherwise(""))
    run = F.transform("bare", lambda x: F.when(any_of(F.lower(x), HINTS) | known(x), x).otherwise(""))
    parts = F.flatten(F.array(*[F.split(F.array_join(x, "\n"), "\n{2,}") for x in ("bare", block, run)]))
    return some.crossJoin(F.broadcast(vocabulary)).select("row", F.explode(F.array_distinct(parts)).alias("unit")).where(any_of(F.lower("unit"), HINTS))


def tagged(files: DataFrame) -> DataFrame:
    """(row, license, score) of each SPDX tag; how later versions may be used isn't told apart, as in the templates."""
    tags = files.where(F.contains(F.lower("text"), F.lit("spdx-license-identifier"))).select("row", F.explode(F.regexp_extract_all("text", F.lit(SPDX), 1)).alias("tag"))
    plain = F.regexp_replace(F.regexp_replace("tag", r"(?i)(-only|-or-later|\+)(?=[ \t)]|$)", ""), r"[ \t]+", " ")
    return tags.select("row", F.when(plain.contains(" "), plain).otherwise(F.translate(plain, "()", "")).alias("license"), F.lit(1.0).alias("score"))


def stated(files: DataFrame, notices: DataFrame, threshold: float, few: bool = False) -> DataFrame:
    """(row, own_license, own_score) of the files (row, path, text) that state a licence."""
    lines = files.where(any_of(F.lower("text"), KEYWORDS)).select("row", F.explode(F.split("text", "\n")).alias("unit")).where(any_of(F.lower("unit"), KEYWORDS))
    whole = files.where(F.col("path").rlike(NAMED) & (F.trim("text") != "")).select("row", F.col("text").alias("unit"))
    # a text's digest stands for it wherever its terms travel
    units = stored(lines.union(whole).union(headers(files, notices)).select("row", F.unhex(F.md5(F.col("unit").cast("binary"))).alias("unit"), F.col("unit").alias("notice")))
    found = units.select("row", "unit").join(matched(units.select("unit", "notice").dropDuplicates(["unit"]), notices, threshold, few), "unit")
    best = found.select("row", "license", "score").union(tagged(files)).groupBy("row").agg(F.min(ranked()).alias("b"))
    return best.select("row", F.col("b.license").alias("own_license"), (-F.col("b.minus")).alias("own_score"))


def directory(path: Column) -> Column:
    """All of the path before its last slash; the empty path is the root."""
    return F.regexp_replace(path, "(^|/)[^/]*$", "")


def inherited(files: DataFrame) -> DataFrame:
    """(dir, license, license_path) of each directory, from the nearest one at or above it with a licence file.

    files: path, own_license, own_score.
    """
    named = files.where(F.col("path").rlike(NAMED) & F.col("own_license").isNotNull())
    first = F.min(F.struct((-F.col("own_score")).alias("minus"), "path", "own_license"))
    givers = named.groupBy(directory(F.col("path")).alias("above")).agg(first.alias("g"))
    dirs = files.where(F.col("path").isNotNull()).select(directory(F.col("path")).alias("dir")).distinct()
    parts = F.split("dir", "/")
    steps = F.when(F.col("dir") == "", F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.size(parts)))
    up = dirs.select("dir", F.explode(steps).alias("depth")).withColumn("above", F.array_join(F.slice(parts, F.lit(1), F.col("depth")), "/"))
    near = up.join(givers, "above").groupBy("dir").agg(F.max_by("g", "depth").alias("g"))
    return near.select("dir", F.col("g.own_license").alias("license"), F.col("g.path").alias("license_path"))


@tidy
def scan(files: DataFrame, row: str, path: str = "path", text: str = "text", notices: DataFrame | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """(row, path, own_license, own_score, license, license_path) of each file; row names a unique column."""
    few = notices is None or (notices.agg(F.sum(F.length("notice"))).first()[0] or 0) <= FEW
    notices = templates(files.sparkSession) if notices is None else notices
    slim = files.select(F.col(f"`{row}`").alias("row"), F.col(f"`{path}`").alias("path"), F.col(f"`{text}`").alias("text"))
    own = stored(slim.select("row", "path").join(stated(slim, notices, threshold, few), "row", "left"))
    full = own.withColumn("dir", directory(F.col("path"))).join(inherited(own), "dir", "left")
    mine = F.col("own_license").isNotNull()
    return full.select(F.col("row").alias(row), "path", "own_license", "own_score", F.coalesce("own_license", "license").alias("license"), F.when(mine, F.col("path")).otherwise(F.col("license_path")).alias("license_path"))
