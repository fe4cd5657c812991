"""Recognising licences by digests of their canonical text.

Texts are made canonical: lower case, equivalent spellings made one, copyright lines dropped,
and everything but letters and digits a blank. Equal canonical texts have equal digests, so
known licences are found by a hash join, however many texts and licences there are. The texts
joined are whole documents, and each of their lines by itself, for notices inside others.
Built-in functions do all of it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.llm.batches import quoted

# Spellings held to be equivalent, after lower-casing; the first becomes the second.
SPELLINGS = (
    ("licence", "license"),
    ("https", "http"),
    ("acknowledgement", "acknowledgment"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("favour", "favor"),
    ("merchantibility", "merchantability"),
    ("non-commercial", "noncommercial"),
    ("organisation", "organization"),
    ("sub-license", "sublicense"),
)
# Fixed value: a line that begins so names an owner and does not belong to a licence's text.
COPYRIGHT_LINE = r"^[^a-z0-9]*(copyright\b|\(c\)|©|all rights reserved\b)"
NOT_A_WORD = r"[^\p{L}\p{N}]+"

_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this
software and associated documentation files (the "Software"), to deal in the Software without
restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or
substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with
or without fee is hereby granted, provided that the above copyright notice and this permission
notice appear in all copies."""
_ISC_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD
TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL
THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""

# Fixed values: (identifier, text) of licences and of the notices that stand for them.
KNOWN = (
    ("MIT", f"MIT License\n{_MIT_GRANT}"),
    ("MIT", f"The MIT License (MIT)\n{_MIT_GRANT}"),
    ("MIT", _MIT_GRANT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("ISC", f"ISC License\n{_ISC_GRANT}\n{_ISC_WARRANTY}"),
    ("ISC", f"{_ISC_GRANT}\n{_ISC_WARRANTY}"),
    ("0BSD", "SPDX-License-Identifier: 0BSD"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License");'),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
)


def canonical(text: Column) -> Column:
    """The canonical form of a line; empty for a copyright line, null for null."""
    lowered = F.lower(text)
    one = reduce(lambda t, pair: F.replace(t, F.lit(pair[0]), F.lit(pair[1])), SPELLINGS, lowered)
    words = F.trim(F.regexp_replace(one, NOT_A_WORD, " "))
    return F.when(F.rlike(lowered, F.lit(COPYRIGHT_LINE)), F.lit("")).otherwise(words)


def canonical_lines(text: Column) -> Column:
    """The canonical lines of a text, without those that are left empty."""
    lines = F.transform(F.split(text, "\n", -1), canonical)
    return F.filter(lines, lambda line: line != "")


def digest(lines: Column) -> Column:
    return F.sha2(F.array_join(lines, " ").cast("binary"), 256)


def known_licenses(spark: SparkSession) -> DataFrame:
    """(license, text) of the licences in KNOWN."""
    return spark.createDataFrame(list(KNOWN), "license string, text string")


def license_scan(
    docs: DataFrame, licenses: DataFrame, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """doc_id, whole, in_lines: the licences that the whole text is, and that its lines are.

    `licenses` has the columns license and text. One row per document with any; both are
    sorted lists of identifiers without repetition. Rows that share a key are one document, as
    are those with a null key. Null texts, and those without letters or digits, match nothing.
    Very long texts are compared whole; an empty table gives no rows.
    """
    known = licenses.select(
        F.col("license"), digest(canonical_lines(F.col("text"))).alias("digest")
    )
    known = known.filter("license IS NOT NULL AND digest IS NOT NULL").distinct()
    # Made by `explode`, below which neither the filter nor what follows can copy it.
    lines = docs.select(
        F.col(quoted(key)).alias("key"),
        F.explode(F.array(canonical_lines(F.col(quoted(text))))).alias("lines"),
    ).filter(F.size("lines") > 0)
    whole = F.struct(digest(F.col("lines")).alias("digest"), F.lit(True).alias("is_whole"))
    own = F.transform(
        F.array_distinct("lines"),
        lambda line: F.struct(digest(F.array(line)).alias("digest"), F.lit(False).alias("is_whole")),
    )
    units = lines.select("key", F.inline(F.concat(F.array(whole), own)))
    found = units.join(known, "digest").groupBy("key")

    def listed(condition: Column) -> Column:
        return F.sort_array(F.collect_set(F.when(condition, F.col("license"))))

    return found.agg(
        listed(F.col("is_whole")).alias("whole"), listed(~F.col("is_whole")).alias("in_lines")
    ).withColumnRenamed("key", key)
