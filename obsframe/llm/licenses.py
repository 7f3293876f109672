"""Licence scans by canonical digests.

A text is normalised (case, equivalent spellings, punctuation, copyright lines), digested,
and looked up in the digests of known licence texts by a hash join. The units looked up are
the entire text and each of its lines, so a one-line notice is found as well as a document
that is nothing but a licence.

All column expressions and one join. The known digests are counted and, as long as they are
few, broadcast; then what is shuffled are found (doc_id, licence) pairs and document ids.

Defined cases: NULL and empty texts and texts of only punctuation or copyright lines have no
licence; rows that share a doc_id share findings; other columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsframe.llm.common import written

# Spellings that count as equal, after lower-casing.
SPELLINGS = (
    ("licence", "license"), ("licencing", "licensing"), ("sub-license", "sublicense"),
    ("authorisation", "authorization"), ("authorised", "authorized"), ("favour", "favor"),
    ("honour", "honor"), ("organisation", "organization"), ("noncommercial", "non-commercial"),
    ("merchantibility", "merchantability"), ("acknowledgement", "acknowledgment"), ("https:", "http:"),
    ("©", " copyright "), ("(c)", " copyright "),
)
# Fixed value: what a normalised copyright line starts with.
COPYRIGHT_LINE = "^(copyright )+([0-9]{4}|year|by |holder$|holders$)|^(copyright )+c [0-9]{4}|^all rights reserved$"

# Public licence texts and the usual one-line notices.
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
    "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
    "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
    "following conditions:\n\nThe above copyright notice and this permission notice shall be included in all "
    "copies or substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF "
    "ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
    "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY "
    "CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF "
    "OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
    "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n"
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
    "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
    "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, "
    "DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
    "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
KNOWN = (
    ("MIT", "MIT License\n\n" + _MIT),
    ("MIT", _MIT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("ISC", "ISC License\n\n" + _ISC),
    ("ISC", _ISC),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\");"),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"),
)


#: Digests that are broadcast at most: a hundred bytes each, so 25 MB.
BROADCAST_ROWS = 1 << 18


def canonical_lines(text: Column) -> Column:
    """The normalised lines of a text; copyright lines and lines without a letter or digit go."""
    spelled = F.lower(F.coalesce(text, F.lit("")))
    for variant, usual in SPELLINGS:
        spelled = F.replace(spelled, F.lit(variant), F.lit(usual))
    plain = F.regexp_replace(spelled, r"[^\p{L}\p{N}\n]+", " ")
    return F.filter(
        F.transform(F.split(plain, "\n"), lambda line: F.trim(line)),
        lambda line: (line != "") & ~(
            (line.startswith("copyright") | line.startswith("all rights")) & line.rlike(COPYRIGHT_LINE)),
    )


def whole_digest(lines: Column) -> Column:
    return F.md5(F.array_join(lines, " ").cast("binary"))


def known_digests(spark: SparkSession, known=KNOWN) -> DataFrame:
    """license and digest of every known text; different spellings of one text give one row."""
    texts = spark.createDataFrame(list(known), "license string, known_text string")
    return texts.select("license", whole_digest(canonical_lines(F.col("known_text"))).alias("digest")).distinct()


def scan(docs: DataFrame, known: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, licenses (names, sorted, comma-joined; empty if none), n_notices, whole_text.

    ``n_notices`` counts the lines that are a known text; ``whole_text`` says that the entire
    document is one. ``known`` is written once and counted: up to ``BROADCAST_ROWS`` digests
    are broadcast, so that lines are neither shuffled nor kept; more are met by a shuffle.
    """
    known = written(known.select("license", "digest").distinct(), "licences")
    if known.count() <= BROADCAST_ROWS:
        known = F.broadcast(known)
    lines = docs.select("doc_id", canonical_lines(F.col(text)).alias("lines"))
    units = lines.select("doc_id", F.explode(F.concat(
        F.array(F.struct(F.lit(True).alias("whole"), whole_digest(F.col("lines")).alias("digest"))),
        F.transform("lines", lambda x: F.struct(F.lit(False).alias("whole"), F.md5(x.cast("binary")).alias("digest"))),
    )).alias("unit")).select("doc_id", "unit.whole", "unit.digest")
    found = units.join(known, "digest").groupBy("doc_id").agg(
        F.array_join(F.array_sort(F.collect_set("license")), ",").alias("licenses"),
        F.sum(F.when(F.col("whole"), 0).otherwise(1)).cast("bigint").alias("n_notices"),
        F.max("whole").alias("whole_text"),
    ).withColumnRenamed("doc_id", "found_id")
    return docs.select("doc_id").join(found, F.col("doc_id").eqNullSafe(F.col("found_id")), "left").select(
        "doc_id", F.coalesce("licenses", F.lit("")).alias("licenses"),
        F.coalesce("n_notices", F.lit(0)).cast("bigint").alias("n_notices"),
        F.coalesce("whole_text", F.lit(False)).alias("whole_text"),
    )
