"""License scans: lines of documents compared to license texts by the Dice coefficient over word bigrams.

DataFrame functions only. Normalised lines and templates are sets of word bigrams; Dice of at least t needs
sizes within t / (2 - t) of each other, so each template is entered once for every size that a partner may have, and lines
join on their size. Only the pairs that are left are compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from folioline.session import settle, small_frame

THRESHOLD = 0.8
#: More template entries than this are not broadcast but joined by a shuffle of the lines' bigrams.
MAX_ENTRIES = 20_000

#: Short notices by which works name their license.
NOTICES = [
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]


def templates(spark: SparkSession) -> DataFrame:
    """(license, template) of :data:`NOTICES`."""
    return small_frame(spark, NOTICES, ["license", "template"])


def word_list(text: Column) -> Column:
    """Words of a text in lower case: runs of a-z and 0-9."""
    return F.array_remove(F.split(F.lower(text), "[^0-9a-z]+"), "")


def bigrams(words: Column) -> Column:
    """The set of bigrams of a column of word lists. One word alone is a bigram by itself; no words give an empty set."""
    n = F.greatest(F.size(words) - 1, F.lit(0))
    pairs = F.zip_with(F.slice(words, 1, n), F.slice(words, 2, n), lambda a, b: F.concat_ws(" ", a, b))
    return F.array_distinct(F.when(F.size(words) == 1, words).otherwise(pairs))


def line_matches(docs: DataFrame, license_texts: DataFrame, text: str = "text", keep: list[str] | None = None,
                 threshold: float = THRESHOLD) -> DataFrame:
    """``keep`` (default ``doc_id``), ``line`` (from 0), ``license`` and ``dice`` of each line and template that match."""
    keep = keep or ["doc_id"]
    ratio = threshold / (2 - threshold)
    known = license_texts.select("license", word_list(F.coalesce(F.col("template"), F.lit(""))).alias("_w")).select(
        "license", bigrams(F.col("_w")).alias("_template")).distinct()
    n = F.size("_template")
    # one more size at either end: the comparison itself decides
    sizes = F.sequence(F.greatest(F.floor(n * ratio) - 1, F.lit(1)).cast("int"), (F.ceil(n / ratio) + 1).cast("int"))
    entries = settle(known.where(n > 0).select("license", "_template", F.explode(sizes).alias("_size")), "templates")
    largest = entries.agg(F.max("_size").alias("m"), F.count("*").alias("n")).first()
    # generators keep each list from being worked out again for each use
    word_lists = F.transform(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), word_list)
    lines = docs.select(*keep, F.posexplode(word_lists).alias("line", "_w")).where(F.size("_w") > 0)
    sets = lines.select(*keep, "line", F.explode(F.array(bigrams(F.col("_w")))).alias("_own"))
    sets = sets.withColumn("_size", F.size("_own")).where(F.col("_size") <= F.lit(largest["m"] or 0))
    pairs = sets.join(F.broadcast(entries) if largest["n"] <= MAX_ENTRIES else entries, "_size")
    common = F.size(F.array_intersect("_own", "_template"))
    dice = 2.0 * common / (F.size("_own") + F.size("_template"))
    return pairs.select(*keep, "line", "license", dice.alias("dice")).where(F.col("dice") >= threshold)


def scan(docs: DataFrame, license_texts: DataFrame, doc_id: str = "doc_id", text: str = "text",
         threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, ``license`` of the best line (ties: the first name), its ``dice`` and ``n_lines`` that match any.

    Documents without a match, with null or with empty text have a null license and no lines. Rows of one id and text count
    as one document each; their results are alike.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"),
                       F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("_key"))
    found = line_matches(rows, license_texts, "_text", ["doc_id", "_key"], threshold)
    best = settle(found.groupBy(F.col("doc_id").alias("_d"), F.col("_key").alias("_k")).agg(
        F.min(F.struct((-F.col("dice")).alias("d"), F.col("license").alias("l"))).alias("_b"),
        F.count_distinct("line").alias("_n")), "licensed")
    joined = rows.drop("_text").join(best, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_key") == F.col("_k")), "left")
    return joined.select("doc_id", F.col("_b.l").alias("license"), (-F.col("_b.d")).alias("dice"),
                         F.coalesce("_n", F.lit(0).cast("long")).alias("n_lines"))
