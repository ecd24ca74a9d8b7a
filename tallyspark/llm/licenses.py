"""License scans: MinHash bands over overlapping text windows retrieve templates, exact containment verifies them.

All of it is DataFrame functions. A text becomes words, then hashes of five-word shingles. Templates of like length form
a class with a window length and a stride, so that each place where a template can stand lies whole in a window. A
window's smallest shingle hash under each of several hash functions is its band key; windows that share a key with a
template are compared with it on all shingles. A shared key means that the window holds the very shingle that is the
template's smallest, so a text without any such shingle shares none, and its windows needn't be keyed.

A window that holds a template at the required containment has a similarity of at least J with it, so `b` bands of one
row miss it with probability (1 - J) ** b at most. The number of bands follows from J and the accepted miss.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE_WORDS = 5
PERCENT = 80
#: Accepted chance that no band of a window with a template agrees.
MISS = 1e-4
#: Words of a text handled together; longer texts go in overlapping segments. A multiple of all strides below 17.
SEGMENT_WORDS = 5040
#: Everything in ASCII but digits and letters separates words.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Templates searched for in one pass over the texts.
TEMPLATES_AT_ONCE = 256

#: Texts of whole licenses, without copyright lines and appendices on how to apply them, one file each.
TEXTS = Path(__file__).parent / "license_texts"

GNU = "under the terms of the GNU {} as published by the Free Software Foundation, either version {} of the License, or"
CC = "This work is licensed under a Creative Commons {} International License."
CC_TO = "This work is licensed under {}. To view a copy of this license, visit https://creativecommons.org/licenses/{}/4.0/"
CC_NAMES = {
    "by": "Attribution", "by-sa": "Attribution-ShareAlike", "by-nc": "Attribution-NonCommercial", "by-nd": "Attribution-NoDerivatives",
    "by-nc-sa": "Attribution-NonCommercial-ShareAlike", "by-nc-nd": "Attribution-NonCommercial-NoDerivatives",
}

#: Headers the licenses give for use in files. GNU headers are cut to the sentence that tells license and version apart.
HEADERS = (
    ("agpl-3.0", GNU.format("Affero General Public License", "3")),
    ("gpl-2.0", GNU.format("General Public License", "2")),
    ("gpl-2.0", "under the terms of the GNU General Public License version 2 as published by the Free Software Foundation"),
    ("gpl-3.0", GNU.format("General Public License", "3")),
    ("lgpl-2.0", GNU.format("Library General Public License", "2")),
    ("lgpl-2.1", GNU.format("Lesser General Public License", "2.1")),
    ("lgpl-3.0", GNU.format("Lesser General Public License", "3")),
    ("apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
     "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law "
     "or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
     "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
     "limitations under the License."),
    ("mpl-1.1", 'The contents of this file are subject to the Mozilla Public License Version 1.1 (the "License"); you may not use this '
     "file except in compliance with the License."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
     "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("bsl-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("epl-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    ("bsd-3-clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("mit", "Use of this source code is governed by an MIT-style license that can be found in the LICENSE file"),
    *((f"cc-{k}-4.0", CC.format(f"{v} 4.0")) for k, v in CC_NAMES.items()),
    *((f"cc-{k}-4.0", CC_TO.format(f"CC {k.upper()} 4.0", k)) for k in CC_NAMES),
)

#: Short notices people write. None for LGPL and AGPL: MPL 2.0's own text holds what such a notice would say.
NOTICES = (
    ("apache-2.0", "Released under the Apache License, Version 2.0."),
    ("bsd-2-clause", "Licensed under the BSD 2-Clause License."),
    ("bsd-3-clause", "Licensed under the BSD 3-Clause License."),
    ("gpl-2.0", "under the GNU General Public License, version 2"),
    ("gpl-3.0", "under the GNU General Public License, version 3"),
    ("isc", "Licensed under the ISC License."),
    ("mit", "Licensed under the MIT License."),
    ("mit", "Distributed under the MIT License."),
    ("mit", "Available under the MIT License."),
    *((f"cc-{k}-4.0", f"Licensed under CC {k.upper()} 4.0.") for k in CC_NAMES),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("mit", "Released under the MIT License."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)

#: Pairs of license and wording; a license may have several wordings.
TEMPLATES = (*((f.stem, f.read_text(encoding="utf-8")) for f in sorted(TEXTS.glob("*.txt"))), *HEADERS, *NOTICES)


@dataclass(frozen=True)
class Class:
    """Templates of like length: the number of distinct shingles of each, by its place among the templates."""

    sizes: dict[int, int]

    @property
    def longest(self) -> int:
        return max(self.sizes.values())

    @property
    def stride(self) -> int:
        return max(1, self.longest // 2)

    @property
    def window(self) -> int:
        return self.longest + self.stride - 1

    @property
    def bands(self) -> int:
        def least(n: int) -> float:
            needed = -(-n * PERCENT // 100)
            return needed / (self.window + n - needed)

        j = min(map(least, self.sizes.values()))
        return 1 if j >= 1 else math.ceil(math.log(MISS) / math.log(1 - j))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), SEPARATORS), "")


def shingles_of(words: Column) -> Column:
    """Hashes of five words in turn; all words as one where there are fewer; none without words."""
    last = F.greatest(F.size(words) - SHINGLE_WORDS, F.lit(0))
    hashes = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(SHINGLE_WORDS)]))
    return F.when(F.size(words) > 0, hashes).otherwise(F.array().cast("array<bigint>"))


def keyed(hashes: Column, band: int) -> Column:
    return F.transform(hashes, lambda h: F.xxhash64(h, F.lit(band)))


def table(spark: SparkSession, rows: Sequence[tuple], *names: str) -> DataFrame:
    """Rows from the driver as literals."""
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row, strict=True)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def shingle_sets(rows: DataFrame) -> DataFrame:
    """Column `template`, the distinct shingles of `text`, in its place. One step each, so that words are split once."""
    rows = rows.withColumn("words", words_of(F.col("text"))).withColumn("template", shingles_of(F.col("words")))
    return rows.withColumn("template", F.array_sort(F.array_distinct("template"))).drop("text", "words")


def classes_of(spark: SparkSession, templates: Sequence[tuple[str, str]]) -> list[Class]:
    """Templates by length, doubling. A template without words can't be found and is left out."""
    named = table(spark, [(i, text) for i, (_, text) in enumerate(templates)], "number", "text")
    by_size: dict[int, dict[int, int]] = {}
    for row in shingle_sets(named).select("number", F.size("template").alias("n")).collect():  # the given templates
        if row["n"]:
            by_size.setdefault((row["n"] - 1).bit_length(), {})[row["number"]] = row["n"]
    return [Class(by_size[k]) for k in sorted(by_size)]


def licensed(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """doc_id, license, containment (the largest of the text's windows) of each template a text holds to 80 percent.

    Null and empty texts hold none. Rows that repeat a doc_id count as one document. A license may have several
    templates; the best counts. Licenses that share most of their wording (BSD 2 and 3, a GNU license's neighbours) may
    both be found; containment tells which fits better.
    """
    blocks = [templates[i : i + TEMPLATES_AT_ONCE] for i in range(0, len(templates), TEMPLATES_AT_ONCE)]
    found = [_scan(docs, block) for block in blocks]
    if not found:
        return docs.select("doc_id", F.lit("").alias("license"), F.lit(0.0).alias("containment")).limit(0)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out if len(found) == 1 else out.groupBy("doc_id", "license").agg(F.max("containment").alias("containment"))


def _scan(docs: DataFrame, templates: Sequence[tuple[str, str]]) -> DataFrame:
    spark = docs.sparkSession
    classes = classes_of(spark, templates)
    reach = max((c.window for c in classes), default=1)
    bands = max((c.bands for c in classes), default=1)

    # The band keys of the templates: a window can only be a candidate through one of them.
    named = table(
        spark,
        [(number, t, *templates[t]) for number, c in enumerate(classes) for t in c.sizes],
        "class", "number", "license", "text",
    )
    shingles = shingle_sets(named)
    own_bands = F.element_at(F.array(*[F.lit(c.bands) for c in classes]), F.col("class") + 1)
    lowest = F.array(*[F.array_min(keyed(F.col("template"), b)) for b in range(bands)])
    keys = shingles.select("class", "number", F.posexplode(F.slice(lowest, F.lit(1), own_bands)).alias("band", "low"))
    wanted: dict[tuple[int, int], list[int]] = {}
    smallest: set[int] = set()
    lowest_of = [F.element_at(F.array_sort(F.transform("template", lambda t: F.struct(F.xxhash64(t, F.lit(b)), t.alias("t")))), 1)["t"] for b in range(bands)]
    for row in shingles.select(F.slice(F.array(*lowest_of), F.lit(1), own_bands).alias("shingles")).collect():
        smallest.update(row["shingles"])
    for row in keys.select("class", "band", "low").collect():  # bands x templates of this block
        wanted.setdefault((row["class"], row["band"]), []).append(row["low"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), words_of(F.col("text")).alias("words"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - 1, F.lit(0)), F.lit(SEGMENT_WORDS))
    parts = rows.where(F.size("words") > 0).select("doc_id", "words", F.explode(starts).alias("at"))
    size = SEGMENT_WORDS + reach + SHINGLE_WORDS - 1
    parts = parts.select("doc_id", F.explode(F.array(F.slice("words", F.col("at") + 1, F.lit(size)))).alias("part"))
    hashed = parts.select("doc_id", F.explode(F.array(shingles_of(F.col("part")))).alias("h"))
    hashed = hashed.where(F.arrays_overlap("h", F.array(*[F.lit(x) for x in sorted(smallest)]).cast("array<bigint>")))

    def candidates(all_keys: Column, number: int, c: Class) -> Column:
        """Windows of the segment that share a band key with a template of the class."""
        last = F.least(F.size(all_keys["b0"]), F.lit(SEGMENT_WORDS)) - 1
        places = F.sequence(F.lit(0), last, F.lit(c.stride))

        def meets(at: Column) -> Column:
            out = F.lit(False)
            for band in range(c.bands):
                out = out | F.array_min(F.slice(all_keys[f"b{band}"], at + 1, F.lit(c.window))).isin(*wanted[number, band])
            return out

        return F.transform(F.filter(places, meets), lambda at: F.struct(F.lit(number).alias("class"), at.alias("at"), F.lit(c.window).alias("size")))

    # A one-element transform binds the keyed hashes once for all windows.
    all_keys = F.array(F.struct(*[keyed(F.col("h"), b).alias(f"b{b}") for b in range(bands)]))
    hits = F.flatten(F.transform(all_keys, lambda k: F.concat(*[candidates(k, n, c) for n, c in enumerate(classes)])))
    windows = hashed.select("doc_id", "h", F.explode(hits).alias("w"))
    windows = windows.select("doc_id", F.col("w.class").alias("class"), F.array_distinct(F.slice("h", F.col("w.at") + 1, F.col("w.size"))).alias("own"))
    windows = windows.where(F.size("own") > 0)
    lows = F.array(*[F.array_min(keyed(F.col("own"), b)) for b in range(bands)])
    retrieved = windows.select("doc_id", "class", "own", F.posexplode(lows).alias("band", "low"))
    retrieved = retrieved.join(F.broadcast(keys), ["class", "band", "low"])  # as many rows as bands x templates
    retrieved = retrieved.join(F.broadcast(shingles.drop("class")), "number")
    shared = F.size(F.array_intersect("own", "template"))
    verified = retrieved.where(shared * 100 >= F.size("template") * PERCENT)
    return verified.groupBy("doc_id", "license").agg(F.max(shared / F.size("template")).alias("containment"))
