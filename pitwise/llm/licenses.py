"""Licence scan: text units compared with licence templates by the Dice coefficient of word bigrams.

Units are the lines of a text, its blocks of several lines (between blank lines), the whole text if it has several
blocks, and spans: stretches of words anywhere in a text that hold a template's bigrams close together, so a licence
is found inside a longer line, over several paragraphs, or before code. A unit is normalised to its words of a-z and
0-9. Dice is 2 * shared / (unit's bigrams + template's bigrams) over distinct bigrams, so a template can only reach
the threshold t with units of t / (2 - t) to (2 - t) / t times its own number of bigrams. These size
bounds drop most units before any bigram is made. The bigrams of the others join the templates'
bigrams by hash; the shared ones are counted per unit and template.

Pruning by rare words: a unit that reaches t shares t / (2 - t) of the template's bigrams at least. So it holds one of any
set of words that are in more than the remaining bigrams. `anchors` are such sets, of the longest words that aren't everyday ones; a text with no
anchor of any template is dropped before it is cut into units.

Spans: of the texts left, every bigram that a template has is placed. Places of one template that follow each other
by at most max(2, an eighth of its bigrams) are a span; its own distinct bigrams are then counted and Dice is
taken. Of spans within each other the outer one stays, of equal ones the best.

Native: DataFrame functions only. Nothing but matching bigrams is exchanged, and those are summed
before it. The templates are a fixed small list (a literal table).
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitwise.llm.common import key_column, materialize

THRESHOLD = 0.8
BLANK = "\n[ \t\r]*\n"

# Short notices and texts of common licences.
TEMPLATES = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file
        except in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software
        distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,
        either express or implied. See the License for the specific language governing permissions and limitations
        under the License.""",
    "MIT notice": "Released under the MIT License.",
    "MIT notice (licensed)": "Licensed under the MIT License.",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation
        the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and
        to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above
        copyright notice and this permission notice shall be included in all copies or substantial portions of the
        Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
        LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT
        SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION
        OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
        DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE
        IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
        WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
        INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,
        WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE
        USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 header": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation, either version 3 of the License, or (at
        your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY
        WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU
        General Public License for more details. You should have received a copy of the GNU General Public License along
        with this program. If not, see https://www.gnu.org/licenses/.""",
    "GPL-2.0 notice": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-3.0 notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0 notice": "This work is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0 notice": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the
        MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "BSD notice": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0 notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0 notice": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0 sentence": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0 sentence": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0 sentence": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
        the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this
        list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above
        copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
        materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its
        contributors may be used to endorse or promote products derived from this software without specific prior
        written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS
        OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR
        A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY
        DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO,
        PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
        CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR
        OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH
        DAMAGE.""",
    "BSL-1.0": """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and
        accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute,
        execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties
        to whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software
        and this entire statement, including the above license grant, this restriction and the following disclaimer,
        must be included in all copies of the Software, in whole or in part, and all derivative works of the Software,
        unless such copies or derivative works are solely in the form of machine-executable object code generated by a
        source language processor.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
        liable for any damages arising from the use of this software. Permission is granted to anyone to use this
        software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject
        to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim
        that you wrote the original software. If you use this software in a product, an acknowledgment in the product
        documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as
        such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered
        from any source distribution.""",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "All rights reserved": "All rights reserved.",
}

LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# Words of everyday texts, anchors only if there is no other.
COMMON = frozenset("""a all an and any are as at be but by can for from has have if in into is it its no not of on one or other so
    such than that the their there these they this to was were which will with you your""".split())


def bigrams(text: str) -> set[str]:
    """Distinct word bigrams of a normalised text."""
    words = re.findall("[0-9a-z]+", text.translate(str.maketrans(*LOWER)))
    return {f"{a} {b}" for a, b in zip(words, words[1:], strict=False)}


def anchors(text: str, threshold: float = THRESHOLD) -> set[str]:
    """Words of a template of which every unit that reaches the threshold holds one."""
    own = bigrams(text)
    spare = len(own) - math.ceil(threshold / (2 - threshold) * len(own) - 1e-9)  # bigrams that may be missing
    found, covered = set(), 0
    for word in sorted({w for b in own for w in b.split()}, key=lambda w: (w in COMMON, -len(w), w)):
        if covered > spare:
            break
        found.add(word)
        covered = sum(bool(found.intersection(b.split())) for b in own)
    return found


def gap(template_bigrams):
    """Most words between neighbouring places of a span."""
    return F.greatest(F.lit(2), F.floor(template_bigrams / 8))


def template_table(spark: SparkSession, templates: dict[str, str] | None = None) -> DataFrame:
    """(license, bigram, template_bigrams): one row per distinct bigram (hash of its words) of a template."""
    templates = TEMPLATES if templates is None else templates
    rows = [(name, *b.split(), len(own)) for name, text in templates.items() for own in [bigrams(text)] for b in sorted(own)]
    return spark.createDataFrame(rows, "license string, a string, b string, template_bigrams long").select(
        "license", F.xxhash64("a", "b").alias("bigram"), "template_bigrams")


def scan(docs: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text",
         threshold: float = THRESHOLD) -> DataFrame:
    """One row per unit that matches: doc_id, unit (line, block, text or span), unit_no (from 0), license, dice.

    A span's number is that of its first word. The best template of a unit is returned, ties by name. Units of fewer than two words have no
    bigram and match nothing, and so do null and blank texts. Rows are judged one by one, so
    repeated rows and rows with equal or null ids each give their own. A template without a bigram
    never matches. An empty table gives no rows; other columns are not read.
    """
    spark, known = docs.sparkSession, TEMPLATES if templates is None else templates
    low, high = threshold / (2 - threshold), (2 - threshold) / threshold
    sizes = sorted({len(bigrams(t)) for t in known.values()} - {0})
    words = sorted({w for t in known.values() for w in anchors(t, threshold)})
    whole = f"(?i)(?<![0-9a-z])(?:{'|'.join(words)})(?![0-9a-z])" if words else r"[^\s\S]"  # (?i) holds for ASCII letters only
    # The texts are read once; the few that are left are written for the two searches below.
    left = docs.select(key_column(id_col).alias("doc_id"), key_column(text_col).alias("text")).where(F.col("text").rlike(whole))
    src = materialize(left.withColumn("text", F.translate("text", *LOWER)), "license-candidates")
    blocks = F.split("text", BLANK, -1)
    units = F.concat(
        F.transform(F.split("text", "\n", -1), lambda t, i: F.struct(F.lit("line").alias("unit"), i.alias("unit_no"), t.alias("part"))),
        F.filter(F.transform(blocks, lambda t, i: F.struct(F.lit("block").alias("unit"), i.alias("unit_no"), t.alias("part"))),
                 lambda u: F.contains(u["part"], F.lit("\n"))),
        F.when(F.size(blocks) > 1, F.array(F.struct(F.lit("text").alias("unit"), F.lit(0).alias("unit_no"), F.col("text").alias("part"))))
        .otherwise(F.array().cast("array<struct<unit:string,unit_no:int,part:string>>")))
    each = src.select("doc_id", F.explode(units).alias("u")).select("doc_id", "u.unit", "u.unit_no", F.col("u.part").alias("part"))
    # Words bound distinct bigrams from above: too few words can be dropped unseen.
    each = each.where(F.regexp_count("part", F.lit("[0-9a-z]+")) > max(1.0, low * min(sizes, default=1)))
    words = each.select("doc_id", "unit", "unit_no", F.regexp_extract_all("part", F.lit("[0-9a-z]+"), 0).alias("w"))
    last = F.greatest(F.size("w") - 1, F.lit(0))
    pairs = F.array_distinct(F.zip_with(F.slice("w", 1, last), F.slice("w", 2, last), lambda a, b: F.xxhash64(a, b)))
    sized = words.select("doc_id", "unit", "unit_no", pairs.alias("pairs")).withColumn("unit_bigrams", F.size("pairs").cast("long"))
    fits = F.lit(False)
    for n in sizes:
        fits = fits | F.col("unit_bigrams").between(low * n, high * n)
    # A number for every unit keeps rows with equal ids apart.
    one = sized.where(fits).withColumn("row", F.monotonically_increasing_id()).select("doc_id", "unit", "unit_no", "row", "unit_bigrams", F.explode("pairs").alias("bigram"))
    shared = (one.join(F.broadcast(template_table(spark, known)), "bigram")
              .where(F.col("unit_bigrams").between(low * F.col("template_bigrams"), high * F.col("template_bigrams")))
              .groupBy("row", "doc_id", "unit", "unit_no", "license", "unit_bigrams", "template_bigrams").agg(F.count("*").alias("shared")))
    dice = 2 * F.col("shared") / (F.col("unit_bigrams") + F.col("template_bigrams"))
    best = Window.partitionBy("row").orderBy(F.desc("dice"), "license")
    units = (shared.withColumn("dice", dice).where(F.col("dice") >= threshold).withColumn("n", F.row_number().over(best))
            .where("n = 1").select("doc_id", "unit", F.col("unit_no").cast("int").alias("unit_no"), "license", "dice"))
    return units.unionByName(_spans(src, known, threshold))


def _spans(src: DataFrame, known: dict[str, str], threshold: float) -> DataFrame:
    """Rows for the spans of (doc_id, text), texts in lower case."""
    low, high = threshold / (2 - threshold), (2 - threshold) / threshold
    words = src.select("doc_id", F.regexp_extract_all("text", F.lit("[0-9a-z]+"), 0).alias("w"))
    last = F.greatest(F.size("w") - 1, F.lit(0))
    pairs = F.zip_with(F.slice("w", 1, last), F.slice("w", 2, last), lambda a, b: F.xxhash64(a, b))
    # Written with a number for every row: the spans are cut from the same rows again.
    rows = materialize(words.select("doc_id", pairs.alias("pairs"), F.monotonically_increasing_id().alias("row")), "license-words")
    at = rows.select("row", F.posexplode("pairs").alias("at", "bigram")).join(
        F.broadcast(template_table(src.sparkSession, known)), "bigram")
    near = Window.partitionBy("row", "license").orderBy("at")
    broken = F.coalesce(F.col("at") - F.lag("at").over(near) > gap(F.col("template_bigrams")), F.lit(True))
    runs = at.withColumn("new", broken.cast("int")).withColumn("run", F.sum("new").over(near))
    spans = (runs.groupBy("row", "license", "template_bigrams", "run").agg(
        F.min("at").alias("start"), F.max("at").alias("stop"), F.count_distinct("bigram").alias("shared"))
        .where(F.col("shared") >= low * F.col("template_bigrams")))
    own = F.size(F.array_distinct(F.slice("pairs", F.col("start") + 1, F.col("stop") - F.col("start") + 1)))
    sized = rows.join(spans, "row").withColumn("own", own.cast("long")).where(
        F.col("own").between(low * F.col("template_bigrams"), high * F.col("template_bigrams")))
    found = sized.withColumn("dice", 2 * F.col("shared") / (F.col("own") + F.col("template_bigrams"))).where(F.col("dice") >= threshold)
    order = Window.partitionBy("row").orderBy("start", F.desc("stop"), F.desc("dice"), "license").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.max("stop").over(order)
    return found.withColumn("reached", reached).where(F.col("reached").isNull() | (F.col("stop") > F.col("reached"))).select(
        "doc_id", F.lit("span").alias("unit"), F.col("start").cast("int").alias("unit_no"), "license", "dice")
