"""License scans by diagonal voting, with DataFrame and SQL functions only.

A template is a label and a text: a phrase, whose every place counts, or a notice, which may
be quoted with changes.  All k-grams of words of every text, PHRASE words for phrases and
NOTICE for notices, are joined by hash to the templates' k-grams, and compared word by word
where hashes meet.  A hit says that text position i fits template position j; hits of a
text and a template are summed by their diagonal i - j, one row for each.  A phrase stands
where one diagonal has all of its k-grams.  For a notice, words put in or left out shift
what follows to a neighbouring diagonal, so the diagonals up to SLACK on either side are
merged; what they cover of the template, over the length of the template or of the span,
whichever is longer, is the span's similarity, and spans below SHARE are given up.  Of
spans that lie over one another the most similar stays, so that one license's notice isn't
taken for that of another, which differs in a word or two.

Templates are broadcast while they have at most BROADCAST words, a bound of the arguments;
beyond it Spark joins by shuffling.  Texts aren't shuffled: what meets again are hits, and at
the end an id, a hash and a number for each row.

Null texts count as empty.  Rows with equal doc_id and text get equal results, and repeated
rows are repeated in the result; a null doc_id is an id like any other.  Of equally similar
spans all stay.  A text without any label has null places, empty labels and score 0.  The
words of a text, however long, are one array in a task.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut
from .quality_rules import bound

#: What a word is, and what lower-casing touches.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PHRASE, NOTICE = 2, 3
SLACK = 8
SHARE = 0.6
#: Templates of at most so many words, and results of at most so many texts, are broadcast.
BROADCAST = 100_000


class Template(NamedTuple):
    label: str
    text: str
    phrase: bool = False


# The phrases, and the licenses' public notices.
PHRASES = (
    Template("gpl", "gnu general public license", True),
    Template("apache", "apache license", True),
    Template("cc-by", "cc by", True),
    Template("mit", "mit license", True),
)
NOTICES = (
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies "
        "or substantial portions of the Software.",
    ),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies.",
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code "
        "must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this "
        "list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ),
    Template(
        "apache",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    Template(
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
    ),
    Template(
        "lgpl",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; "
        "either version 2.1 of the License, or (at your option) any later version.",
    ),
    Template(
        "agpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version.",
    ),
    Template(
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at "
        "https://mozilla.org/MPL/2.0/.",
    ),
    Template(
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in "
        "source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
)
TEMPLATES = PHRASES + NOTICES


def lowered(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def grams(words: Column, size: int) -> Column:
    """All runs of `size` words, as texts; words is a lambda's variable, else it would be computed anew for each."""
    last = F.size(words) - size
    each = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.concat_ws(" ", *[F.get(words, i + j) for j in range(size)]))
    return F.when(last < 0, F.array().cast("array<string>")).otherwise(each)


def exploded(rows: DataFrame, *keep: str) -> DataFrame:
    """(keep, size, i, gram): every k-gram of either size of each row's text."""
    both = lambda w: F.struct(F.greatest(F.size(w) - PHRASE + 1, F.lit(0)).alias("first"), F.concat(grams(w, PHRASE), grams(w, NOTICE)).alias("all"))
    found = rows.select(*keep, bound(F.regexp_extract_all(lowered(F.col("text")), F.lit(WORD), 0), both).alias("g"))
    each = found.select(*keep, F.col("g.first").alias("first"), F.posexplode("g.all").alias("p", "gram"))
    short = F.col("p") < F.col("first")
    return each.select(*keep, F.when(short, PHRASE).otherwise(NOTICE).alias("size"), F.when(short, F.col("p")).otherwise(F.col("p") - F.col("first")).alias("i"), "gram")


def positions(spark: SparkSession, templates: Sequence[Template]) -> DataFrame:
    """(template, label, phrase, width, j, mark, shape): each template's k-grams of its kind; width: its words."""
    rows = [F.struct(F.lit(k).alias("template"), F.lit(t.label).alias("label"), F.lit(t.phrase).alias("phrase"), F.lit(t.text).alias("text")) for k, t in enumerate(templates)]
    table = spark.range(1).select(F.explode(F.array(*rows)).alias("t")).select("t.*")
    table = table.withColumn("width", F.regexp_count(lowered(F.col("text")), F.lit(WORD)))
    own = exploded(table, "template", "label", "phrase", "width").filter((F.col("size") == PHRASE) == F.col("phrase"))
    return own.select("template", "label", "phrase", "width", F.col("i").alias("j"), F.xxhash64("gram").alias("mark"), F.col("gram").alias("shape"))


def diagonals(docs: DataFrame, templates: Sequence[Template]) -> DataFrame:
    """(doc_id, th, template, label, phrase, width, d, js): for each diagonal with a hit the template positions hit."""
    table = positions(docs.sparkSession, templates)
    if sum(len(t.text.split()) for t in templates) <= BROADCAST:
        table = F.broadcast(table)
    texts = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"), "text")
    hits = exploded(texts, "doc_id", "th").join(table, (F.xxhash64("gram") == F.col("mark")) & (F.col("gram") == F.col("shape")))
    key = ["doc_id", "th", "template", "label", "phrase", "width", (F.col("i") - F.col("j")).alias("d")]
    return hits.groupBy(*key).agg(F.array_sort(F.collect_set("j")).alias("js"))


def phrases(lines: DataFrame) -> DataFrame:
    """(doc_id, th, label, base, start, end, similarity): places where all of a phrase's words stand."""
    whole = lines.filter(F.col("phrase") & (F.size("js") == F.col("width") - PHRASE + 1))
    return whole.select("doc_id", "th", "label", F.lit(True).alias("base"), F.col("d").alias("start"), (F.col("d") + F.col("width")).alias("end"), F.lit(1.0).alias("similarity"))


def notices(lines: DataFrame, share: float = SHARE, slack: int = SLACK) -> DataFrame:
    """The same columns for notices, from neighbouring diagonals merged and spans verified."""
    around = Window.partitionBy("doc_id", "th", "template").orderBy("d").rangeBetween(-slack, slack)
    merged = lines.filter(~F.col("phrase")).select(
        "doc_id", "th", "template", "label", "width", "d",
        F.flatten(F.collect_list("js").over(around)).alias("js"),
        F.min(F.col("d") + F.array_min("js")).over(around).alias("start"),
        F.max(F.col("d") + F.array_max("js") + NOTICE).over(around).alias("end"),
    )
    fits = merged.filter(F.size("js") * NOTICE >= F.col("width") * share)  # too few hits for any span
    covered = F.size(F.array_distinct(F.flatten(F.transform("js", lambda j: F.sequence(j, j + (NOTICE - 1))))))
    spans = fits.select("doc_id", "th", "template", "label", "start", "end", (covered / F.greatest("width", F.col("end") - F.col("start"))).alias("similarity"))
    spans = spans.filter(F.col("similarity") >= share)
    # spans whose middle halves touch lie over one another
    quarter = F.floor((F.col("end") - F.col("start")) / 4)
    spans = spans.withColumns({"low": F.col("start") + quarter, "high": F.col("end") - quarter})
    order = Window.partitionBy("doc_id", "th").orderBy("low", "high", "template")
    before = F.max("high").over(order.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("apart", F.coalesce(F.col("low") >= before, F.lit(True)).cast("int"))
    spans = spans.withColumn("group", F.sum("apart").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    best = F.max("similarity").over(Window.partitionBy("doc_id", "th", "group"))
    stay = spans.withColumn("best", best).filter("similarity = best")
    return stay.select("doc_id", "th", "label", F.lit(False).alias("base"), "start", "end", "similarity").distinct()


def spans(docs: DataFrame, templates: Sequence[Template] = TEMPLATES, share: float = SHARE) -> DataFrame:
    """(doc_id, th, label, base, start, end, similarity): what the templates find; words from `start` up to `end`, th: the text's hash."""
    lines = cut(diagonals(docs, templates))
    return phrases(lines).unionByName(notices(lines, share))


def scanned(docs: DataFrame, templates: Sequence[Template] = TEMPLATES, share: float = SHARE) -> DataFrame:
    """One row for each of docs: its words, the phrases' places, the labels and the best similarity."""
    base = F.col("base")
    names = lambda of: F.array_join(F.array_sort(F.collect_set(of)), ",")
    found = spans(docs, templates, share).groupBy("doc_id", "th").agg(
        F.sum(base.cast("long")).alias("n_base"),
        F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
        names(F.when(base, F.col("label"))).alias("base_labels"),
        names(F.col("label")).alias("labels"),
        F.max("similarity").alias("score"),
    )
    found = cut(found.withColumnsRenamed({"doc_id": "found_id", "th": "found_th"}))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.xxhash64(text).alias("th"), F.regexp_count(lowered(F.col("text")), F.lit(WORD)).cast("long").alias("n_words"))
    if found.count() <= BROADCAST:
        found = F.broadcast(found)
    out = rows.join(found, F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("th") == F.col("found_th")), "left")
    filled = [F.coalesce(c, F.lit(v)).alias(c) for c, v in (("n_base", 0), ("base_labels", ""), ("labels", ""), ("score", 0.0))]
    return out.select("doc_id", "n_words", filled[0], "first_word", "last_word", *filled[1:])


def query(docs: DataFrame) -> DataFrame:
    return scanned(docs)
