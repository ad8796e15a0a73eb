"""Operator 9: license scans by MinHash bands over overlapping windows, in DataFrame
operations alone.

Words are runs of letters and digits, lower-cased; shingles are runs of five words (of a
shorter template, the whole). A template is found where at least 80 % of its shingles
are in one window.

1. Texts without a mark word can't hold 80 % of any template's shingles: mark words are
   chosen so that in every template fewer than 80 % of the shingles are without one.
2. Windows of 2 * size words begin at every size-th word, for each class of template
   sizes (doubling), so that a template of the class lies whole in some window. Only windows
   with a mark word are signed.
3. A signature has BANDS bands of one MinHash each. A template with c of its t shingles
   in a window of w shingles is retrieved with probability 1 - (1 - J)**BANDS, where
   J = c / (t + w - c): for the longest window of a class and c / t = 0.8, at least
   0.9999 (collision_bound states it for any template). Of a template with one shingle,
   which bands would miss in one window of a hundred, the shingle itself is looked up.
4. Retrieved pairs are verified by exact shingle containment.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import keep, small
from .decontaminate import words_of

BANDS = 64
SHINGLE, PERCENT = 5, 80

# Notices by which texts state their license.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("lgpl-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("agpl-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("all-rights-reserved", "All rights reserved."),
    ("proprietary", "All rights reserved. No part of this publication may be reproduced without permission."),
)


def plain_words(text: str) -> list[str]:
    return [w for w in re.split(r"[\W_]+", text.lower()) if w]


def template_shingles(words: list[str]) -> list[tuple[str, ...]]:
    k = min(SHINGLE, len(words))
    return list(dict.fromkeys(tuple(words[i : i + k]) for i in range(len(words) - k + 1)))


def mark_words(templates: list[list[str]]) -> list[str]:
    """Words such that of every template fewer than PERCENT of the shingles have none.
    Long words come first, as they are rare in other texts."""
    chosen: set[str] = set()
    for words in sorted(templates):
        own = template_shingles(words)
        for word in sorted(set(words), key=lambda w: (w not in chosen, -len(w), w)):
            if 100 * sum(not chosen & set(s) for s in own) < PERCENT * len(own):
                break
            chosen.add(word)
    return sorted(chosen)


def size_class(n: int) -> int:
    return max(8, 1 << (n - 1).bit_length())


def collision_bound(words: int) -> float:
    """Least probability with which a template of so many words is retrieved."""
    t = max(1, words - SHINGLE + 1)
    if t == 1:
        return 1.0
    c = -(-PERCENT * t // 100)
    j = c / (t + 2 * size_class(words) - SHINGLE + 1 - c)
    return 1 - (1 - j) ** BANDS


def license_matches(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES) -> DataFrame:
    """(doc_id, license, containment, start_word) of every document and license that
    it states: the highest share of the template's shingles found in one window, and
    the first word (from 0) of the first window with that share.

    Null, empty and wordless texts state none; null ids pass through. Repeated rows
    give one result, and several texts under one id are all searched. Other columns
    are not read. `templates` are (name, text) pairs, a list that fits in the code;
    those without words are left out and two under one name are both searched for.
    Whole texts are searched.
    """
    spark: SparkSession = docs.sparkSession
    worded = [(name, plain_words(text)) for name, text in templates]
    worded = [(name, words) for name, words in worded if words]
    schema = "doc_id long, license string, containment double, start_word int"
    if not worded:
        return spark.createDataFrame([], schema)
    marks = mark_words([w for _, w in worded])
    known = spark.createDataFrame([(i, name, words, min(SHINGLE, len(words)), size_class(len(words)), len(template_shingles(words)) == 1) for i, (name, words) in enumerate(worded)], "template int, license string, words array<string>, k int, class int, single boolean")
    known = known.withColumn("h", F.expr("array_distinct(transform(sequence(1, size(words) - k + 1), i -> xxhash64(slice(words, i, k))))"))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.where(F.col("text").rlike("(?iu)" + "|".join(marks)))
    rows = rows.select("doc_id", words_of(F.col("text")).alias("words"))
    marked = F.array(*[F.lit(m) for m in marks])
    # Windows, by their first words: of each class, those that hold a mark word.
    kinds = F.explode(F.array(*[F.struct(F.lit(c).alias("class"), F.lit(k).alias("k")) for c, k in sorted({(size_class(len(w)), min(SHINGLE, len(w))) for _, w in worded})])).alias("kind")
    at = F.explode(F.transform(F.sequence(F.lit(0), F.floor((F.size("words") - 1) / F.col("kind.class")).cast("int")), lambda i: i * F.col("kind.class"))).alias("start")
    windows = rows.where(F.arrays_overlap("words", marked)).select("doc_id", "words", kinds).select("doc_id", "words", "kind.class", "kind.k", at)
    windows = windows.select("doc_id", "class", "k", "start", F.slice("words", F.col("start") + 1, 2 * F.col("class")).alias("words"))
    windows = windows.where(F.arrays_overlap("words", marked) & (F.size("words") >= F.col("k")))
    windows = keep(windows.select("doc_id", "class", "k", "start", F.expr("array_distinct(transform(sequence(1, size(words) - k + 1), i -> xxhash64(slice(words, i, k))))").alias("h")), "windows")

    bands = F.transform(F.sequence(F.lit(1), F.lit(BANDS)), lambda b: F.xxhash64(b, F.array_min(F.transform("h", lambda h: F.xxhash64(h, b)))))
    banded = F.lit(False)
    for c, k in sorted({(size_class(len(w)), min(SHINGLE, len(w))) for _, w in worded if len(template_shingles(w)) > 1}):
        banded |= (F.col("class") == c) & (F.col("k") == k)
    signed = windows.where(banded).select("doc_id", "class", "k", "start", "h", F.explode(bands).alias("band"))
    wanted = known.where("not single").select("template", "license", "class", "k", F.col("h").alias("own"), F.explode(bands).alias("band"))
    pairs = signed.join(small(wanted), ["class", "k", "band"]).dropDuplicates(["doc_id", "class", "k", "start", "h", "template"])
    alone = F.broadcast(known.where("single").select("license", "class", "k", F.expr("xxhash64(slice(words, 1, k))").alias("one")))
    held = windows.join(alone, ["class", "k"]).where(F.array_contains("h", F.col("one"))).withColumn("own", F.array("one"))
    columns = ["doc_id", "start", "license", "own", "h"]
    pairs = pairs.select(*columns).union(held.select(*columns))
    share = F.size(F.array_intersect("own", "h")) / F.size("own")
    good = pairs.withColumn("containment", share).where(100 * F.size(F.array_intersect("own", "h")) >= PERCENT * F.size("own"))
    best = F.min_by(F.struct("containment", "start"), F.struct(-F.col("containment"), F.col("start"))).alias("best")
    return good.groupBy("doc_id", "license").agg(best).select("doc_id", "license", "best.containment", F.col("best.start").alias("start_word"))
