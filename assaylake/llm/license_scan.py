"""Licence notices and texts, found by Dice's coefficient over word bigrams.

Every line, paragraph and whole text is a unit. A unit of ``n`` different bigrams can only reach the threshold with
templates of about the same size; templates are therefore listed under every size they admit, and a join on size is
all that brings units and templates together. The list of templates is fixed, so it is broadcast.

With ``layouts``, runs of consecutive sentences are units as well (a line end ends a sentence too), so notices are found
inside longer lines and licences of several paragraphs inside longer documents. A document is only cut into runs for
templates of which it holds as many bigrams as the threshold asks of any unit.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaylake.llm.common import let

THRESHOLD = 0.8

_MIT = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated '
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
    "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
    "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
    "Software."
)
_BSD2 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this "
    "list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above "
    "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
    "materials provided with the distribution."
)
_BSD3 = _BSD2 + (
    " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission."
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies."
)
_APACHE = (
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
    "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
    "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
    '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
    "specific language governing permissions and limitations under the License."
)
_GPL3 = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
    "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
    "option) any later version."
)
_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS "
    "OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD_AS_IS = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_ISC_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN "
    "AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
    "PERFORMANCE OF THIS SOFTWARE."
)
# Public licence texts and the notices in common use.
TEMPLATES: list[tuple[str, str]] = [
    ("MIT", _MIT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("BSD-2-Clause", _BSD2),
    ("BSD-3-Clause", _BSD3),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("ISC", _ISC),
    ("ISC", "Licensed under the ISC License."),
    ("Apache-2.0", _APACHE),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", _GPL3),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
]

# The same with whole licence texts.
FULL_TEMPLATES: list[tuple[str, str]] = TEMPLATES + [
    ("MIT", f"{_MIT} {_AS_IS}"),
    ("BSD-2-Clause", f"{_BSD2} {_BSD_AS_IS}"),
    ("BSD-3-Clause", f"{_BSD3} {_BSD_AS_IS}"),
    ("ISC", f"{_ISC} {_ISC_AS_IS}"),
]


def normalised_words(text: str) -> list[str]:
    """The words of a template, as the expressions below find them in a unit."""
    return re.sub(r"[\W_]+", " ", text.lower()).split()


def bigrams(text: str) -> list[str]:
    found = normalised_words(text)
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(found, found[1:])))


def size_bounds(n: int, threshold: float) -> tuple[int, int]:
    """Sizes m with 2 min(n, m) / (n + m) >= threshold."""
    return math.ceil(n * threshold / (2 - threshold) - 1e-9), math.floor(n * (2 - threshold) / threshold + 1e-9)


def least_shared(n: int, threshold: float) -> int:
    """Bigrams that any unit shares with a template of ``n`` if Dice reaches the threshold."""
    return max(1, math.ceil(threshold * (n + size_bounds(n, threshold)[0]) / 2 - 1e-9))


def needed_words(grams: list[str], threshold: float) -> set[str]:
    """Words of which a unit holds at least one: without them too few bigrams are left. Long words are rarer."""
    chosen, left = set(), grams
    for word in sorted({w for g in grams for w in g.split()}, key=lambda w: (-len(w), w)):
        if len(left) < least_shared(len(grams), threshold):
            break
        chosen.add(word)
        left = [g for g in left if word not in g.split()]
    return chosen


def _pairs(words):
    """Neighbouring words in order, equal pairs as often as they occur."""
    def all_pairs(w):
        return F.transform(F.sequence(F.lit(1), F.size(w) - 1), lambda i: F.concat_ws(" ", F.get(w, i - 1), F.get(w, i)))

    return let(words, lambda w: F.when(F.size(w) > 1, all_pairs(w)).otherwise(F.array().cast("array<string>")))


def license_runs(docs: DataFrame, threshold: float, templates: list[tuple[str, str]]) -> DataFrame:
    """(doc_id, unit, license_id, dice): runs of sentences that reach the threshold.

    A run has as many pairs of words as a template admits, and shares one in its first and in its last sentence. Of runs
    that overlap, those count that share most pairs with their template (then by Dice), so no part of a licence is
    taken for a shorter one.
    """
    spark = docs.sparkSession
    listed = []
    for name, text in templates:
        grams = bigrams(text)
        if grams:
            listed.append((name, grams, *size_bounds(len(grams), threshold), least_shared(len(grams), threshold)))
    if not listed:
        return spark.createDataFrame([], f"doc_id {dict(docs.dtypes)['doc_id']}, unit string, license_id string, dice double")
    known = spark.createDataFrame(listed, "license_id string, template array<string>, low int, high int, least int")
    needed = sorted(set().union(*[needed_words(grams, threshold) for _, grams, *_ in listed]))
    rows = docs.select("doc_id", F.lower("text").alias("text"), F.xxhash64("text").alias("version"))
    rows = rows.filter(F.col("text").rlike(r"(?<![\p{L}\p{N}])(?:" + "|".join(needed) + r")(?![\p{L}\p{N}])")).dropDuplicates(["doc_id", "version"])
    clean = F.transform(F.split("text", r"\n|(?<=[.!?;:])\s"), lambda x: F.btrim(F.regexp_replace(x, r"[^\p{L}\p{N}]+", " ")))
    cut = F.transform(F.filter(clean, lambda x: x != ""), lambda x: F.split(x, " "))
    rows = rows.select("doc_id", "version", cut.alias("sentences")).withColumn("words", F.flatten("sentences"))
    # ends[i]: words up to the end of sentence i, by way of the places of the last words
    last = F.flatten(F.transform("sentences", lambda x: F.transform(x, lambda _, i: i == F.size(x) - 1)))
    ends = F.filter(F.transform(last, lambda is_last, i: F.when(is_last, i + 1)), lambda x: x.isNotNull())
    rows = rows.select("doc_id", "version", "words", ends.alias("ends"), _pairs(F.col("words")).alias("pairs"))
    held = rows.join(F.broadcast(known)).filter(F.size(F.array_intersect("pairs", "template")) >= F.col("least"))
    begin = F.when(F.col("i") == 0, 0).otherwise(F.get("ends", F.col("i") - 1))
    held = held.select("*", F.posexplode("ends").alias("i", "first_end")).withColumn("begin", begin)

    def shares(at, n):
        return F.arrays_overlap(F.slice("pairs", at + 1, F.greatest(F.lit(0), n)), F.col("template"))

    held = held.filter(shares(F.col("begin"), F.col("first_end") - F.col("begin")))
    # A sentence has a word at least, so no run has more than high + 1 of them.
    near = F.slice("ends", F.col("i") + 1, F.col("high") + 1)
    fits = F.filter(near, lambda e: (e - F.col("begin") - 1).between(F.col("low"), F.col("high")))
    runs = held.withColumn("end", F.explode(fits))
    own = F.array_distinct(F.slice("pairs", F.col("begin") + 1, F.col("end") - F.col("begin") - 1))
    runs = runs.withColumn("own", own).withColumn("shared", F.size(F.array_intersect("own", "template")))
    runs = runs.withColumn("dice", F.lit(2.0) * F.col("shared") / (F.size("own") + F.size("template")))
    runs = runs.filter(F.col("dice") >= threshold)
    before_last = F.coalesce(F.array_max(F.filter("ends", lambda e: e < F.col("end"))), F.lit(0))
    # the pair that leads into the last sentence belongs to it
    lead = F.greatest(before_last - 1, F.col("begin"))
    runs = runs.filter(shares(lead, F.col("end") - 1 - lead))
    unit = F.array_join(F.slice("words", F.col("begin") + 1, F.col("end") - F.col("begin")), " ")
    places = runs.select("doc_id", "version", F.struct("shared", "dice", "begin", "end", "license_id", unit.alias("unit")).alias("run"))
    found = places.groupBy("doc_id", "version").agg(F.collect_list("run").alias("runs"))

    def beaten(x):
        def beats(y):
            more = (y["shared"] > x["shared"]) | ((y["shared"] == x["shared"]) & (y["dice"] > x["dice"]))
            return more & (y["begin"] < x["end"]) & (x["begin"] < y["end"])

        return F.exists("runs", beats)

    best = found.select("doc_id", F.explode(F.filter("runs", lambda x: ~beaten(x))).alias("run"))
    return best.select("doc_id", "run.unit", "run.license_id", "run.dice")


def license_scan(
    docs: DataFrame, threshold: float = THRESHOLD, templates: list[tuple[str, str]] | None = None, layouts: bool = False
) -> DataFrame:
    """(doc_id, license_id, dice, n_units): licences found in a document, with the best likeness and number of units.

    A unit counts for the template it is most like (of equals, the first id), if Dice reaches ``threshold``. Equal
    units of a document count once. Null, empty and wordless texts give nothing; documents without a licence have no
    row. With ``layouts``, runs of sentences are units too, see ``license_runs``, and the templates are whole texts.
    Repeated rows with one doc_id are one document; all documents without an id share the null id.
    """
    spark = docs.sparkSession
    templates = templates if templates is not None else FULL_TEMPLATES if layouts else TEMPLATES
    listed = [
        (size, name, grams)
        for name, text in templates
        for grams in [bigrams(text)]
        for low, high in [size_bounds(len(grams), threshold)]
        for size in range(max(1, low), high + 1)
    ]
    sizes = [size for size, _, _ in listed] or [0]
    known = spark.createDataFrame(listed, "size int, license_id string, template array<string>")
    # Line ends stay, everything else that is no letter or digit becomes a space.
    clean = F.regexp_replace(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}\p{N}\n]+", " ")
    rows = docs.select("doc_id", clean.alias("clean"))
    flat = lambda column: F.translate(column, "\n", " ")
    units = F.concat(
        F.split("clean", "\n"),
        F.transform(F.split("clean", r"\n *\n"), lambda x: F.btrim(flat(x))),
        F.array(F.btrim(flat(F.col("clean")))),
    )
    units = F.array_distinct(F.transform(units, lambda x: F.btrim(x)))
    found = rows.select("doc_id", F.explode(units).alias("unit"))
    found = found.withColumn("words", F.split("unit", " +"))
    # A unit has at most one bigram less than words, and at least one less than different words.
    found = found.filter(F.size("words") > min(sizes)).filter(F.size(F.array_distinct("words")) <= max(sizes) + 1)
    pairs = let(
        F.col("words"),
        lambda w: F.transform(F.sequence(F.lit(1), F.size(w) - 1), lambda i: F.concat_ws(" ", F.get(w, i - 1), F.get(w, i))),
    )
    found = found.withColumn("grams", F.array_distinct(pairs)).withColumn("size", F.size("grams"))
    shared = F.size(F.array_intersect("grams", "template"))
    scored = found.join(F.broadcast(known), "size").withColumn(
        "dice", F.lit(2.0) * shared / (F.col("size") + F.size("template"))
    )
    scored = scored.filter(F.col("dice") >= threshold)
    if layouts:
        scored = scored.select("doc_id", F.array_join("words", " ").alias("unit"), "license_id", "dice")
        scored = scored.unionByName(license_runs(docs, threshold, templates))
    best = scored.groupBy("doc_id", "unit").agg(
        F.min(F.struct((-F.col("dice")).alias("minus"), "license_id")).alias("best")
    )
    return best.groupBy("doc_id", F.col("best.license_id").alias("license_id")).agg(
        F.max(-F.col("best.minus")).alias("dice"), F.count("*").alias("n_units")
    )
