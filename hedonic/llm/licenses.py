"""License notices in documents, retrieved by MinHash bands and verified by containment.

Texts and templates are normalized (lower case, letters and digits only) and cut into
word shingles of five.  A window is a stretch of ``WINDOW`` shingles; document windows
start every ``STRIDE`` shingles and overlap by four words, template windows start at every
shingle.  A window's signature is ``BANDS`` minimum hashes, each a band of its own, and a
document window retrieves every template that has a window agreeing with it in a band.

The settings guarantee retrieval: a notice copied exactly lies in windows equal to windows
of the template, and even a notice of a single shingle has a Jaccard similarity of at least
1 / WINDOW with the window it falls in, so it is missed with a chance of at most
``(1 - 1 / WINDOW) ** BANDS``, 0.1 per cent.  Retrieved spots are verified exactly: the
share of the template's shingles (as text) inside the spot's surroundings must be at least
``CONTAINED``.  Surroundings reach a template's length to both sides.

A template of fewer than five words is one shingle of all its words.  Every stretch of so
many words inside a document window is compared with it by hash, so none is missed.

Template windows are few and known beforehand: their minimum hashes stand as literals in
the plan, and a document window that agrees in no band goes no further.  Only retrieved
spots are joined to their documents again.  A document with thousands of notices yields a
row per spot before the spots are merged by a partial aggregate.

Missing and empty texts match nothing, texts under five words only templates as short.  Repeated rows count once per
id; rows without an id are reported under a null id.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hedonic.llm.common import let, query, rows_near, table
from hedonic.session import settle

#: Public license notices, as they are to be quoted in files.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "all-rights-reserved": "All rights reserved.",
    "CC0-1.0-notice": "CC0 1.0 Universal",
    "CC-BY-SA-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "LGPL-notice": "GNU Lesser General Public License",
    "AGPL-notice": "GNU Affero General Public License",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
    "MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "Apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except '
    "in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
    "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on "
    'an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
    "specific language governing permissions and limitations under the License.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
    "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
    "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
    "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
    "License for more details.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
    "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice "
    "and this permission notice shall be included in all copies or substantial portions of the Software.",
    "MIT-warranty": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED '
    "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS "
    "OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies.",
}

SHINGLE = 5
WINDOW = 4
STRIDE = 4
BANDS = 24
CONTAINED = 0.8


def words_of(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    parts = F.split(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "), " ")
    return F.filter(parts, lambda w: w != "")


def shingles_of(words: Column, size: Column) -> Column:
    """All stretches of ``size`` words, joined by blanks, in order."""
    n = F.greatest(F.size(words) - (size - 1), F.lit(0))
    starts = F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: i <= n)
    return F.transform(starts, lambda i: F.array_join(F.slice(words, i, size), " "))


def signature(window: Column) -> list[Column]:
    """The shingles' hashes of a window of ``WINDOW + SHINGLE - 1`` words; a short window repeats its first."""
    words = [F.get(window, F.lit(i)) for i in range(WINDOW + SHINGLE - 1)]
    first = F.xxhash64(*words[:SHINGLE])
    rest = [F.when(words[k + SHINGLE - 1].isNotNull(), F.xxhash64(*words[k : k + SHINGLE])).otherwise(first) for k in range(1, WINDOW)]
    return [first, *rest]


def bands_of(shingles: list[Column]) -> list[Column]:
    """One minimum per band over the hashes of a window's shingles."""
    return [F.least(*[F.xxhash64(h, F.lit(band)) for h in shingles]) for band in range(BANDS)]


def _windows(rows: DataFrame, key: str, stride: int, short: list[int] | None = None) -> DataFrame:
    """``key, at, h0, ...``: the windows of ``words`` by their first word (from 0), with their shingles' hashes.

    With ``short`` also ``grams``, the hashes of all stretches of so many words, and a window for texts under five words.
    """
    n = F.greatest(F.size("words") - (SHINGLE - 1), F.least(F.size("words"), F.lit(1)) if short else F.lit(0))
    starts = F.filter(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(stride)), lambda i: i < n)
    size = WINDOW + SHINGLE - 1
    cut = let(F.col("words"), lambda all_: F.transform(starts, lambda i: F.struct(i.alias("at"), F.slice(all_, i + 1, size).alias("words"))))
    spread = rows.select(key, F.explode(cut).alias("w"))
    hashes = [h.alias(f"h{k}") for k, h in enumerate(signature(F.col("w.words")))]
    words = [F.get(F.col("w.words"), F.lit(i)) for i in range(size)]
    grams = [F.xxhash64(*words[k : k + n]) for n in short or [] for k in range(size - n + 1)]
    return spread.select(key, "w.at", *hashes, *([F.array(*grams).alias("grams")] if grams else []))


def license_matches(
    docs: DataFrame, templates: Mapping[str, str] | None = None, *, id_col: str = "doc_id", text_col: str = "text",
    contained: float = CONTAINED,
) -> DataFrame:
    """``doc_id, template, containment, first_word, spots`` for every document and template that match.

    ``containment`` is the best share of the template's shingles in one spot, ``first_word``
    the place (in normalized words) of the window that found it, ``spots`` counts windows.
    """
    spark = docs.sparkSession
    known = list((templates or TEMPLATES).items())
    listed = spark.createDataFrame(known, "template string, text string").withColumn("words", words_of(F.col("text")))
    hashes = [F.col(f"h{k}") for k in range(WINDOW)]
    banded = [b.alias(f"b{i}") for i, b in enumerate(bands_of(hashes))]
    # As many rows as the templates have words.
    lines = _windows(listed.select("template", "words"), "template", 1).select("template", *banded).collect()
    values = [sorted({r[f"b{i}"] for r in lines}) for i in range(BANDS)]
    # Templates without a shingle of full length, by the hash of all their words; words that are not there add nothing to it.
    whole = F.xxhash64(*[F.get(F.col("words"), F.lit(i)) for i in range(SHINGLE - 1)]).alias("value")
    brief = listed.where(F.size("words").between(1, SHINGLE - 1)).select("template", F.size("words").alias("n"), whole).collect()
    short = sorted({r.n for r in brief})

    rows = docs.select(F.col(id_col).alias("doc_id"), words_of(F.col(text_col)).alias("words"))
    found = _windows(rows, "doc_id", STRIDE, short).select("doc_id", "at", *banded, *(["grams"] if short else []))
    hits = [F.when(F.col(f"b{i}").isin(values[i]), F.struct(F.lit(i).alias("band"), F.col(f"b{i}").alias("value"))) for i in range(BANDS)]
    hits = F.array_compact(F.array(*hits))
    if short:
        equal = F.array_intersect("grams", F.array(*[F.lit(v) for v in sorted({r.value for r in brief})]))
        hits = F.concat(hits, F.transform(equal, lambda v: F.struct(F.lit(BANDS).alias("band"), v.alias("value"))))
    found = found.select("doc_id", "at", F.explode(hits).alias("hit"))

    # The templates' bands: a literal table, as small as the caller's templates are.
    keys = sorted({(i, r[f"b{i}"], r["template"]) for r in lines for i in range(BANDS)} | {(BANDS, r.value, r.template) for r in brief})
    bands = F.broadcast(spark.createDataFrame(keys, "band int, value long, template string"))
    retrieved = found.select("doc_id", "at", "hit.*").join(bands, ["band", "value"])
    retrieved = settle(retrieved.select("doc_id", "template", "at").distinct())

    wanted = F.array_distinct(shingles_of(F.col("words"), F.least(F.size("words"), F.lit(SHINGLE)))).alias("wanted")
    texts = listed.select("template", wanted, F.size("words").alias("long"))
    spots = retrieved.join(F.broadcast(texts), "template")
    near = rows_near(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), retrieved, "doc_id")
    spots = spots.withColumnRenamed("doc_id", "_id").join(near, F.col("_id").eqNullSafe(F.col("doc_id"))).drop("_id")
    first = F.greatest(F.col("at") - F.col("long"), F.lit(0))
    around = F.slice(words_of(F.col("text")), first + 1, 2 * F.col("long") + WINDOW + SHINGLE)
    held = let(around, lambda words: let(shingles_of(words, F.least("long", F.lit(SHINGLE))), lambda have: F.size(F.array_intersect(F.col("wanted"), have))))
    share = held / F.size("wanted")
    spots = spots.select("doc_id", "template", "at", share.alias("share")).distinct()
    good = spots.where(F.col("share") >= contained)
    return good.groupBy("doc_id", "template").agg(
        F.max("share").alias("containment"), F.min_by("at", F.struct(-F.col("share"), F.col("at"))).cast("long").alias("first_word"),
        F.count(F.lit(1)).alias("spots"),
    )


@query("op8_licenses")
def op8_licenses(spark, sf_dir):
    """License notices in all documents."""
    return license_matches(table(spark, sf_dir, "documents"))
