"""License scans: MinHash bands over overlapping text windows, then exact shingle containment."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yardstar.llm.common import materialize

# Short notices and standard headers of common licenses.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("mit", "Released under the MIT License."),
    (
        "apache-2.0-header",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS "
        "OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License.",
    ),
    (
        "mit-permission",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
    ),
    (
        "gpl-3.0-header",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        "GNU General Public License for more details.",
    ),
    (
        "bsd-redistribution",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer.",
    ),
)

SHINGLE = 5
WINDOW, STRIDE, HASHES = 16, 8, 6
MOST_TEMPLATE_WORDS = 200_000


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value computed once; written out, Catalyst would repeat it at each use."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _words(text: Column) -> Column:
    """Words in lower case without the marks around them, so that a notice is found in any punctuation."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+", -1)
    words = F.transform(words, lambda w: F.btrim(w, F.lit("\"'`*_#()[]{}<>.,;:!?-/|")))
    return F.filter(words, lambda w: w != "")


def _shingles(words: Column) -> Column:
    """A 64-bit hash of each run of ``SHINGLE`` words; none for shorter texts."""

    def runs(hashes: Column) -> Column:
        n = F.greatest(F.size(hashes) - (SHINGLE - 1), F.lit(0))
        ahead = (F.slice(hashes, i + 1, n) for i in range(SHINGLE))
        return F.transform(F.arrays_zip(*ahead), lambda s: F.xxhash64(s))

    # Each word is hashed once; a shingle is the hash of its words' hashes.
    return _let(F.transform(words, lambda w: F.xxhash64(w)), runs)


def _bands(window: Column) -> Column:
    """``HASHES`` MinHash values of a window, each a band of its own.

    The hashes are random already, so the smallest after an exclusive or with a
    constant is the minimum under a random order. A window that shares half of
    its shingles with a template's window meets it with probability
    ``1 - 0.5 ** HASHES``, over 98 %; an equal one for certain.
    """
    return F.array(
        *(
            F.array_min(F.transform(window, lambda x: x.bitwiseXOR(F.xxhash64(F.lit(i), F.lit("minhash")))))
            for i in range(HASHES)
        )
    )


def _windows(shingles: Column, width: int, stride: int) -> Column:
    """``(at, w)`` of each window; none of a text shorter than one."""

    def cut(s: Column) -> Column:
        # The last window ends with the text, so none of it stays uncovered.
        starts = F.array_union(
            F.sequence(F.lit(0), F.size(s) - width, F.lit(stride)), F.array(F.size(s) - width)
        )
        windows = F.transform(starts, lambda at: F.struct(at.alias("at"), F.slice(s, at + 1, width).alias("w")))
        return F.when(F.size(s) >= width, windows)

    return _let(shingles, cut)


def _text_bands(shingles: Column) -> Column:
    """``(at, bands)`` of each window of a text, half overlapping the one before.

    The minima of a window are the lower ones of its two halves, and each half
    belongs to two windows, so minima are found once for each half.
    """

    def cut(s: Column) -> Column:
        last = F.size(s) - WINDOW
        halves = F.transform(
            F.sequence(F.lit(0), F.size(s) - STRIDE, F.lit(STRIDE)), lambda at: _bands(F.slice(s, at + 1, STRIDE))
        )

        def joined(h: Column) -> Column:
            windows = F.transform(
                F.sequence(F.lit(0), F.size(h) - 2),
                lambda k: F.struct(
                    (k * STRIDE).alias("at"), F.zip_with(F.get(h, k), F.get(h, k + 1), lambda a, b: F.least(a, b)).alias("bands")
                ),
            )
            # The last window ends with the text, so none of it stays uncovered.
            tail = F.array(F.struct(last.alias("at"), _bands(F.slice(s, last + 1, WINDOW)).alias("bands")))
            return F.when(last % STRIDE == 0, windows).otherwise(F.concat(windows, tail))

        return F.when(F.size(s) >= WINDOW, _let(halves, joined))

    return _let(shingles, cut)


def template_table(spark, templates: Sequence[tuple[str, str]]) -> DataFrame:
    """``(license, shingles, n)`` of the templates with at least one shingle. Their total size is bounded."""
    if sum(len(text.split()) for _, text in templates) > MOST_TEMPLATE_WORDS:
        raise ValueError(f"templates of more than {MOST_TEMPLATE_WORDS} words in all")
    rows = spark.createDataFrame(list(templates), "license string, text string")
    rows = rows.select("license", _shingles(_words(F.col("text"))).alias("shingles"))
    return rows.select("license", F.array_distinct("shingles").alias("distinct"), "shingles").where(
        F.size("shingles") > 0
    )


def scan(
    docs: DataFrame,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    id_col: str = "doc_id",
    text_col: str = "text",
    containment: float = 0.8,
) -> DataFrame:
    """``(id, license, start, end, containment)``: every place of every text that holds a template.

    Retrieval: a text's shingles are cut into windows of ``WINDOW`` with half
    overlap, and a window and a template meet if they agree in one of
    ``HASHES`` MinHash bands. Templates are cut at every offset, so a verbatim
    copy has at least one equal window. Templates shorter than two windows are
    retrieved by windows of one shingle, whose MinHash is the shingle itself.
    The templates' bands are a bounded table and are broadcast.

    Verification: at each place where a retrieved template would begin, the
    exact share of its distinct shingles within the span of its length, half a
    window wider on both sides, must reach ``containment``. Of places of one
    template whose spans overlap the best is the match: the one with the highest
    share, then the highest share within the span alone, then the first.
    ``start`` and ``end`` count words (the span of the template's length).

    The candidates are written to the shared folder first, so Spark knows their
    size when it joins them to the texts. NULL, empty and short texts hold
    nothing; rows that repeat an id are scanned one by one, and equal rows give
    equal matches, which are given once; NULL ids are allowed. Templates without a
    shingle never match. Other columns are left out.
    """
    spark = docs.sparkSession
    known = template_table(spark, templates)
    short = F.size("shingles") < 2 * WINDOW
    ones = known.where(short).select(
        "license", F.posexplode("shingles").alias("offset", "value"), F.lit(-1).alias("band")
    )
    wide = known.where(~short).select("license", F.explode(_windows(F.col("shingles"), WINDOW, 1)).alias("window"))
    wide = wide.select(
        "license", F.col("window.at").alias("offset"), F.posexplode(_bands(F.col("window.w"))).alias("band", "value")
    )
    index = materialize(
        ones.unionByName(wide.select("license", "offset", "value", "band")).distinct(), "license-bands"
    )

    # Rows are told apart by id and text: rows that share an id, NULL included, don't see each other's places.
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).withColumn("key", F.xxhash64("_id", "_text"))
    texts = rows.select("key", _shingles(_words(F.col("_text"))).alias("shingles"))
    singles = texts.select("key", F.posexplode("shingles").alias("at", "value"), F.lit(-1).alias("band"))
    windows = (
        texts.select("key", F.explode(_text_bands(F.col("shingles"))).alias("window"))
        .select("key", F.col("window.at").alias("at"), F.posexplode("window.bands").alias("band", "value"))
    )
    met = singles.unionByName(windows.select("key", "at", "value", "band")).join(
        F.broadcast(index), ["band", "value"]  # bounded by MOST_TEMPLATE_WORDS
    )
    candidates = met.select("key", "license", (F.col("at") - F.col("offset")).alias("begin")).distinct()
    candidates = materialize(
        candidates.groupBy("key").agg(F.collect_list(F.struct("license", "begin")).alias("found")), "license-candidates"
    )

    slack = WINDOW // 2
    placed = rows.join(candidates, "key").select(
        "key", "_id", _shingles(_words(F.col("_text"))).alias("_shingles"), F.explode("found").alias("found")
    ).select("key", "_id", "_shingles", "found.license", "found.begin")
    checked = placed.join(F.broadcast(known.withColumnRenamed("shingles", "_template")), "license").select(
        "key",
        "_id",
        "license",
        "begin",
        F.size("_template").alias("n"),
        F.greatest(F.col("begin") - slack, F.lit(0)).alias("_from"),
        "_shingles",
        "_template",
        "distinct",
    )
    span = F.slice("_shingles", F.col("_from") + 1, F.col("begin") + F.col("n") + slack - F.col("_from"))
    share = F.size(F.array_intersect("distinct", span)) / F.size("distinct")
    own_from = F.greatest("begin", F.lit(0))
    own = F.slice("_shingles", own_from + 1, F.greatest(F.col("begin") + F.col("n") - own_from, F.lit(0)))
    checked = (
        checked.where(F.col("begin") + F.col("n") + slack > F.col("_from"))
        .select("*", share.alias("containment"))
        .where(F.col("containment") >= containment)
        .select("key", "_id", "license", "begin", "n", "containment", F.size(F.array_intersect("distinct", own)).alias("own"))
    )
    place = F.struct(
        (-F.col("containment")).alias("missing"), (-F.col("own")).alias("away"), "begin", F.col("n").cast("long").alias("n")
    )
    hits = checked.groupBy("key", "license").agg(F.first("_id").alias("_id"), F.sort_array(F.collect_set(place)).alias("places"))
    # From the best place on, each that overlaps no place taken before.
    chosen = F.aggregate(
        "places",
        F.slice("places", 1, 0),
        lambda taken, p: F.when(
            F.exists(taken, lambda t: F.abs(t["begin"] - p["begin"]) < p["n"]), taken
        ).otherwise(F.concat(taken, F.array(p))),
    )
    return hits.select("_id", "license", F.explode(chosen).alias("p")).select(
        F.col("_id").alias(id_col),
        "license",
        F.greatest(F.col("p.begin"), F.lit(0)).alias("start"),
        (F.col("p.begin") + F.col("p.n") + (SHINGLE - 1)).cast("int").alias("end"),
        (-F.col("p.missing")).alias("containment"),
    )
