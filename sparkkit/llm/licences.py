"""Licence scans: TF-IDF cosine to templates and inheritance from ancestor directories (operator 3), in DataFrame functions only."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import store

_NO_WARRANTY_MIT = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY "
    "CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
    "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_NO_WARRANTY_BSD = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED '
    "TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
    "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
    "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD_CONDITIONS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution. "
)
_NO_WARRANTY_ISC = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF '
    "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
    "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR "
    "IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)


def _gnu(name: str) -> str:
    """The notice that the GNU licences ask for."""
    return (
        f"This program is free software: you can redistribute it and/or modify it under the terms of the {name} as published by the Free Software "
        "Foundation, either version 3 of the License, or (at your option) any later version."
    )


# fixed values: notices, headings and full texts of common licences; the long licences (Apache, GNU, MPL) hold their own notice or heading
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain '
        "a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
        'distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See '
        "the License for the specific language governing permissions and limitations under the License.",
    ],
    "MIT": [
        "Released under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, "
        "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        + _NO_WARRANTY_MIT,
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        _gnu("GNU General Public License"),
    ],
    "LGPL-3.0": [
        "This library is licensed under the GNU Lesser General Public License, version 3.",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        _gnu("GNU Lesser General Public License"),
    ],
    "AGPL-3.0": ["GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007", _gnu("GNU Affero General Public License")],
    "BSD-2-Clause": [_BSD_CONDITIONS + _NO_WARRANTY_BSD],
    "BSD-3-Clause": [
        _BSD_CONDITIONS + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission. " + _NO_WARRANTY_BSD
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Mozilla Public License Version 2.0",
    ],
    "CC-BY-4.0": ["This work is licensed under CC BY 4.0."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
        "copyright notice and this permission notice appear in all copies. " + _NO_WARRANTY_ISC
    ],
    "0BSD": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. " + _NO_WARRANTY_ISC
    ],
}
LICENCE_FILES = ("license", "license.txt", "license.md", "licence", "licence.txt", "copying", "copying.txt", "unlicense")
LEAST_COSINE = 0.8
TERM = r"[\p{L}\p{N}]+(?:[.\-][\p{L}\p{N}]+)*"
UNIT = r"[\r\n]+|(?<=[.!?;:])\s+"  # borders of lines and of the sentences in them
SALTS = 32  # a frequent term's rows are spread over so many keys
CELL = 16  # terms in a cell, by which places of a text meet its terms


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def _template_terms(spark, templates: Mapping[str, Sequence[str]]) -> list[tuple[str, Counter]]:
    """(licence, its terms) of every template, licences in order of their names."""
    listed = [(i, name, text) for i, (name, text) in enumerate((n, t) for n in sorted(templates) for t in templates[n])]
    rows = spark.createDataFrame(listed, "i int, licence string, text string").select("i", "licence", terms(F.col("text")).alias("t")).collect()
    found = [(r["licence"], Counter(r["t"])) for r in sorted(rows, key=lambda r: r["i"]) if r["t"]]
    if not found:
        raise ValueError("no template has a term")
    return found


def frequencies(files: DataFrame) -> tuple[DataFrame, int]:
    """(term, files) of all terms of all files, as a stored table, and the number of files."""
    distinct = files.select(F.explode(F.array_distinct(terms(F.col("text")))).alias("term"))
    return store(distinct.groupBy("term").agg(F.count(F.lit(1)).alias("files"))), files.count()


def _weight(n: int, files: Column) -> Column:
    return F.log(F.lit(1.0 + n) / (1.0 + F.coalesce(files, F.lit(0)))) + 1.0


def signature(vector: Mapping[str, float], least: float) -> set[str]:
    """Terms of which a text has at least one if its cosine to the unit vector is `least` or more.

    The heaviest terms, until what is left of the vector is shorter than `least`: a text of other terms only cannot come closer.
    """
    out, rest = set(), 1.0
    for term, weight in sorted(vector.items(), key=lambda x: (-x[1], x[0])):
        if math.sqrt(max(rest, 0.0)) < least - 1e-9:
            break
        out.add(term)
        rest -= weight * weight
    return out


def _weighted(rows: DataFrame, frequency: DataFrame, n: int, *keys: str) -> DataFrame:
    """`rows` with the weight `w` of their `term`; terms meet their frequency once per salt, so a frequent one is no hot key."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(*keys), F.lit(SALTS)))
    known = salted.select("salt", "term").distinct().join(frequency, "term", "left").select("salt", "term", _weight(n, F.col("files")).alias("w"))
    return salted.join(known, ["salt", "term"]).drop("salt")


def _spans(tokens: DataFrame, known: DataFrame, marks: DataFrame, frequency: DataFrame, n: int, least: float) -> DataFrame:
    """(key, k, cosine) of every span of every text that can be close to template k.

    A mark of the template opens the two stretches of `width` terms around it.  A stretch and the next one (at most 2 x width terms of a text)
    are kept if the template's terms in them can make up the cosine; only then are the spans that start in the first one tried.
    """
    # stretches p and p + 1 hold every span of `width` terms that starts in p
    at = F.floor(F.col("pos") / F.col("width"))
    seeds = tokens.join(F.broadcast(marks), "term").select("key", "k", "width", F.explode(F.array(at - 1, at)).alias("p")).filter("p >= 0").distinct()
    first, end = F.col("p") * F.col("width"), (F.col("p") + 2) * F.col("width")
    cells = seeds.withColumn("cell", F.explode(F.sequence(F.floor(first / CELL), F.floor((end - 1) / CELL))))
    inside = cells.join(tokens.withColumn("cell", F.floor(F.col("pos") / CELL)), ["key", "cell"]).filter((F.col("pos") >= first) & (F.col("pos") < end))
    inside = inside.join(F.broadcast(known), ["k", "term"], "left")
    token = F.struct("pos", "first", "last", "term", "v")
    items = inside.groupBy("key", "k", "p", "width").agg(F.array_sort(F.collect_list(token)).alias("tokens"))
    shared = F.array_distinct(F.transform(F.filter("tokens", lambda x: x["v"].isNotNull()), lambda x: F.struct(x["term"], x["v"])))
    mass = F.aggregate(shared, F.lit(0.0), lambda a, x: a + x["v"] * x["v"])
    items = items.filter(mass >= least * least - 1e-9)
    begun = F.filter("tokens", lambda x: x["first"] & (x["pos"] < (F.col("p") + 1) * F.col("width")))
    starts = items.select("key", "k", "width", "tokens", F.explode(begun).alias("b")).withColumn("s", F.col("b.pos"))
    reached = F.filter("tokens", lambda x: (x["pos"] >= F.col("s")) & (x["pos"] < F.col("s") + F.col("width")))
    rows = starts.select("key", "k", "s", F.inline(reached))
    rows = _weighted(rows, frequency, n, "key", "k", "s").repartition("key", "k", "s")
    seen = F.row_number().over(Window.partitionBy("key", "k", "s", "term").orderBy("pos")) - 1
    so_far = Window.partitionBy("key", "k", "s").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # the (c + 1)th occurrence of a term lifts the square of its count by 2c + 1
    rows = rows.withColumn("c", seen).withColumn("square", F.col("w") * F.col("w") * (2 * F.col("c") + 1))
    rows = rows.select("key", "k", "last", F.sum("square").over(so_far).alias("norm"), F.sum(F.col("w") * F.coalesce("v", F.lit(0.0))).over(so_far).alias("dot"))
    return rows.filter("last").select("key", "k", (F.col("dot") / F.sqrt("norm")).alias("cosine"))


def _whole(tokens: DataFrame, known: DataFrame, frequency: DataFrame, n: int) -> DataFrame:
    """(key, k, cosine) of whole texts and the templates that share a term with them."""
    tf = _weighted(tokens.groupBy("key", "term").agg(F.count(F.lit(1)).alias("tf")), frequency, n, "key")
    norms = tf.groupBy("key").agg(F.sqrt(F.sum(F.pow(F.col("tf") * F.col("w"), F.lit(2.0)))).alias("norm"))
    dots = tf.join(F.broadcast(known), "term").groupBy("key", "k").agg(F.sum(F.col("tf") * F.col("w") * F.col("v")).alias("dot"))
    return dots.join(norms, "key").select("key", "k", (F.col("dot") / F.col("norm")).alias("cosine"))


def scores(files: DataFrame, templates: Mapping[str, Sequence[str]], least: float = LEAST_COSINE) -> DataFrame:
    """(key, licence, cosine) of the closest template of every text of `files` (name, text) that has one at `least` or more.

    `key` is `text_key(name, text)`: equal texts are scored once.  The weight of a term is log((1 + files) / (1 + files with it)) + 1, counted over
    all files for every term.  Units are lines, cut after sentences; those without a term do not count.  A header is any run of units that
    together hold at most twice as many terms as the template it is compared with.  A licence file is compared as a whole as well.
    Ties go to the first licence by name.
    """
    spark = files.sparkSession
    counts = _template_terms(spark, templates)
    frequency, n = frequencies(files)
    vocabulary = sorted({t for _, c in counts for t in c})
    # as many rows as the templates have terms
    listed = spark.createDataFrame([(t,) for t in vocabulary], "term string")
    weight = {r["term"]: r["w"] for r in frequency.join(F.broadcast(listed), "term").select("term", _weight(n, F.col("files")).alias("w")).collect()}
    unseen = math.log(1.0 + n) + 1.0
    vectors = []
    for _, c in counts:
        raw = {t: m * weight.get(t, unseen) for t, m in c.items()}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        vectors.append({t: x / norm for t, x in raw.items()})
    signs = [signature(v, least) for v in vectors]
    known = spark.createDataFrame([(k, t, x) for k, v in enumerate(vectors) for t, x in sorted(v.items())], "k int, term string, v double")
    marks = spark.createDataFrame([(k, t, 2 * sum(counts[k][1].values())) for k, s in enumerate(signs) for t in sorted(s)], "k int, term string, width int")
    # terms are letters, digits, dots and dashes
    either = "|".join(t.replace(".", r"\.").replace("-", r"\-") for t in sorted(set().union(*signs)))
    near = files.filter(F.col("text").rlike(rf"(?iu)(?<![\p{{L}}\p{{N}}])(?:{either})(?![\p{{L}}\p{{N}}])"))
    texts = near.select(text_key(F.col("name"), F.col("text")).alias("key"), is_licence_file(F.col("name")).alias("whole"), "text").dropDuplicates(["key"])
    units = F.filter(F.transform(F.split("text", UNIT), terms), lambda u: F.size(u) > 0)
    flat = F.flatten(F.transform(units, lambda u: F.transform(u, lambda t, j: F.struct((j == 0).alias("first"), (j == F.size(u) - 1).alias("last"), t.alias("term")))))
    tokens = store(texts.select("key", "whole", F.posexplode(flat).alias("pos", "token")).select("key", "whole", "pos", "token.*"))
    spans = _spans(tokens.drop("whole"), known, marks, frequency, n, least)
    found = spans.unionByName(_whole(tokens.filter("whole"), known, frequency, n)).filter(F.col("cosine") >= least - 1e-9)
    # rounding must not decide between templates
    best = found.groupBy("key").agg(F.max(F.struct(F.round("cosine", 12).alias("cosine"), (-F.col("k")).alias("order"))).alias("best"))
    names = F.array(*[F.lit(licence) for licence, _ in counts])
    return best.select("key", F.element_at(names, 1 - F.col("best.order")).alias("licence"), F.least("best.cosine", F.lit(1.0)).alias("cosine"))


def is_licence_file(name: Column) -> Column:
    return F.coalesce(F.lower(name).isin(*LICENCE_FILES), F.lit(False))


def text_key(name: Column, text: Column) -> Column:
    """A text's MD5, marked if it is a licence file's; null for a null text."""
    return F.concat(F.when(is_licence_file(name), F.lit("w")).otherwise(F.lit("h")), F.md5(text))


def _parent(path: Column) -> Column:
    return F.regexp_replace(path, r"/?[^/]*$", "")


def ancestors(directory: Column) -> Column:
    """A directory and all above it, the root (empty) last, each with its depth."""
    parts = F.split(directory, "/")
    depth = F.when(directory == "", F.lit(0)).otherwise(F.size(parts))
    return F.transform(F.sequence(depth, F.lit(0), F.lit(-1)), lambda d: F.struct(F.when(d == 0, F.lit("")).otherwise(F.array_join(F.slice(parts, 1, d), "/")).alias("above"), d.alias("depth")))


def scan(files: DataFrame, templates: Mapping[str, Sequence[str]] = TEMPLATES, least: float = LEAST_COSINE) -> DataFrame:
    """(id, path, licence, cosine, origin, directory) of every file (id, path, text).

    `origin` is `file` for a licence file that is close to a template, `header` for another file with such a header, and `inherited` for a
    file that takes the licence of the nearest directory at or above its own that holds a licence file with a licence; `directory` says which.
    Otherwise the four are null.  Of several licence files in a directory the closest decides, then the licence's name.  Null texts
    have no licence of their own, a null path has no directory; every row is judged by its own text, repeated rows stay.
    """
    path = F.coalesce("path", F.lit(""))
    name = F.regexp_extract(path, r"[^/]*$", 0)
    files = files.select("id", "path", "text", name.alias("name"))
    own = scores(files.select("name", "text"), templates, least).select("key", F.col("licence").alias("own"), "cosine")
    listed = files.select("id", "path", text_key(F.col("name"), F.col("text")).alias("key"), _parent(path).alias("__dir"), is_licence_file(F.col("name")).alias("__file"))
    # copies of a text share its key, so the key is salted
    own = own.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    rows = store(listed.withColumn("salt", F.pmod(F.xxhash64("id", "path"), F.lit(SALTS))).join(own, ["key", "salt"], "left").drop("key", "salt"))
    held = rows.filter(F.col("__file") & F.col("own").isNotNull() & F.col("path").isNotNull()).groupBy(F.col("__dir").alias("directory"))
    held = held.agg(F.max_by("own", F.struct("cosine", "own")).alias("theirs"))
    # directories, not files, look for their ancestors
    dirs = rows.select("__dir").distinct().select("__dir", F.inline(ancestors(F.col("__dir"))))
    nearest = dirs.join(held, F.col("above") == F.col("directory")).groupBy(F.col("__dir").alias("__in"))
    nearest = nearest.agg(F.max(F.struct("depth", "theirs", "directory")).alias("near"))
    full = rows.join(nearest, (F.col("__dir") == F.col("__in")) & F.col("path").isNotNull(), "left")
    origin = F.when(F.col("own").isNotNull(), F.when(F.col("__file"), "file").otherwise("header")).when(F.col("near").isNotNull(), "inherited")
    return full.select("id", "path", F.coalesce("own", "near.theirs").alias("licence"), "cosine", origin.alias("origin"), F.when(F.col("own").isNull(), F.col("near.directory")).alias("directory"))


def document_files(docs: DataFrame) -> DataFrame:
    """Documents as files (id, path, text): directories by source, thousand and hundred of doc_id.

    The first twenty ids of a thousand are licence files of its directory, those of every other hundred of that one.
    """
    thousand, hundred = F.floor(F.col("doc_id") / 1000), F.floor(F.col("doc_id") % 1000 / 100)
    place = F.when(F.col("doc_id") % 1000 < 20, F.concat_ws("/", "source", thousand)).otherwise(F.concat_ws("/", "source", thousand, hundred))
    name = F.when(F.col("doc_id") % 100 < 20, F.lit("LICENSE")).otherwise(F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    return docs.select(F.col("doc_id").alias("id"), F.concat_ws("/", place, name).alias("path"), "text")
