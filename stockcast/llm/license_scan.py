"""License scan by diagonal voting, in DataFrame operations only.

Templates (phrases and standard notices) are cut into rolling word k-grams.
The rolling word-pair hashes of every text join the template positions, whose
whole k-grams are compared at once; a hit of text position i on template
position j votes for the diagonal i - j. Votes are gathered by diagonal, and
neighbouring diagonals of a notice are merged (an inserted or dropped word
shifts the rest): diagonals fall into cells ``SHIFT`` + 1 wide and each pair of adjoining
cells is a group, so an occurrence that shifts by up to ``SHIFT`` words lies wholly
in one. A diagonal has at most one hit a template position, so a group is
a bounded list whatever the text.

Spans are verified in order: of a group's hits, whose words were compared, the longest chain in
which text and template positions both rise makes the span. Its ``cover`` is the
share of the notice's k-grams in that chain: a template position counts once, however
often the text repeats it.

Base labels come from the short phrases: a place is a diagonal on which every
k-gram of the phrase was hit, with its words compared. Labels of the method's
own come from notices whose cover reaches ``COVER``.

Edge cases: null text counts as empty (no words, no labels, score 0). Repeated
rows are scanned each for itself. An empty table gives an empty result. Extra
columns are ignored. A place never runs past the text's end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockcast.llm.common import ascii_lower

WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # what stands between words
COVER = 0.6  # share of a notice's k-grams that makes its label
SHIFT = 3  # diagonals this near belong to one occurrence
GRAM = 3  # words in a notice's k-gram

# The phrases and their labels, and wording of public licence notices.
PHRASES = [("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license")]
NOTICES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("mit", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl", "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("gpl", "you should have received a copy of the gnu general public license along with this program if not see"),
    ("lgpl", "gnu lesser general public license"),
    ("agpl", "gnu affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software"),
    ("boost", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("cc0", "the person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law"),
    ("cc-by", "this work is licensed under a creative commons attribution"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
]


def templates(spark: SparkSession) -> DataFrame:
    """(h, j, k, expected, template, label, base, grams): one row a template
    position, joined by the hash of two words and verified over k; a fixed
    number of rows (under 600)."""
    rows = []
    for t, (label, text, base) in enumerate([(*p, True) for p in PHRASES] + [(*p, False) for p in NOTICES]):
        words = text.split()
        k = min(GRAM, len(words))
        rows += [(words[j], words[j + 1], j, k, words[j : j + k], t, label, base, len(words) - k + 1) for j in range(len(words) - k + 1)]
    frame = spark.createDataFrame(rows, "one string, two string, j int, k int, expected array<string>, template int, label string, base boolean, grams int")
    return frame.withColumn("h", F.xxhash64("one", "two")).drop("one", "two")


def _chain(hits: Column) -> Column:
    """Of (i, j) hits sorted by i, a longest chain in which i and j rise: (n, start, last); of
    equally long ones the latest. The hits are at most two cells of diagonals."""
    kind = "array<struct<n:int,start:int,i:int,j:int>>"

    def step(ends: Column, hit: Column) -> Column:
        below = F.filter(ends, lambda e: (e["i"] < hit["i"]) & (e["j"] < hit["j"]))
        best = F.array_max(F.transform(below, lambda e: F.named_struct(F.lit("n"), e["n"], F.lit("start"), e["start"])))
        n, start = F.coalesce(best["n"], F.lit(0)) + 1, F.coalesce(best["start"], hit["i"])
        own = F.named_struct(F.lit("n"), n, F.lit("start"), start, F.lit("i"), hit["i"], F.lit("j"), hit["j"])
        return F.concat(ends, F.array(own)).cast(kind)

    def longest(ends: Column) -> Column:
        return F.array_max(F.transform(ends, lambda e: F.named_struct(F.lit("n"), e["n"], F.lit("start"), e["start"], F.lit("last"), e["i"])))

    return F.aggregate(hits, F.array().cast(kind), step, longest)


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a voted group of diagonals, plus one row (template null) a document:
    row, doc_id, n_words, template, label, base, start, end, cover. An occurrence that
    shifts may be seen, in part, by a second pair of cells."""
    spark = docs.sparkSession
    words = F.array_remove(F.split(ascii_lower(F.coalesce(F.col(text_col), F.lit(""))), WORDS), "")
    # an empty word closes each text: every document so meets the row of no template
    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.concat(words, F.array(F.lit(""))).alias("words"))
    hits = texts.select("row", "doc_id", "words", F.posexplode("words").alias("i", "word")).withColumn("h", F.xxhash64("word", F.get("words", F.col("i") + 1)))
    known = templates(spark)
    none = spark.range(1).select(F.xxhash64(F.lit(""), F.lit(None).cast("string")).alias("h"))
    known = F.broadcast(known.unionByName(none, allowMissingColumns=True))
    hits = hits.join(known, "h")
    same = F.col("expected").isNull() | (F.slice("words", F.col("i") + 1, F.coalesce("k", F.lit(1))) == F.col("expected"))
    hits = hits.where(same).select("row", "doc_id", (F.size("words") - 1).cast("long").alias("n_words"), "template", "label", "base", "grams", "j", "k", "i")
    diagonal = (F.col("i") - F.col("j")).cast("long")
    cell = F.floor(diagonal / F.lit(SHIFT + 1))
    groups = F.when(F.col("base"), F.array(diagonal)).when(~F.col("base"), F.array(cell - 1, cell)).otherwise(F.array(F.lit(0).cast("long")))
    grouped = hits.withColumn("group", F.explode(groups)).groupBy("row", "doc_id", "n_words", "template", "label", "base", "grams", "k", "group")
    chained = grouped.agg(F.sort_array(F.collect_list(F.struct("i", "j"))).alias("hits")).withColumn("chain", F.when(F.col("template").isNotNull(), _chain(F.col("hits"))))
    return chained.select(
        "row", "doc_id", "n_words", "template", "label", "base",
        F.col("chain.start").cast("long").alias("start"),
        (F.col("chain.last") + F.col("k")).cast("long").alias("end"),
        (F.col("chain.n") / F.col("grams")).alias("cover"),
    )


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) a row."""
    found = spans(docs, id_col, text_col)
    base = F.col("base") & (F.col("cover") >= 1.0)
    named = base | (~F.col("base") & (F.col("cover") >= COVER))
    names = lambda cond: F.concat_ws(",", F.sort_array(F.collect_set(F.when(cond, F.col("label")))))  # noqa: E731  at most one a label
    return (
        found.groupBy("row", "doc_id", "n_words")
        .agg(
            F.sum(F.when(base, 1).otherwise(0)).cast("long").alias("n_base"),
            F.min(F.when(base, F.col("start"))).alias("first_word"),
            F.max(F.when(base, F.col("start"))).alias("last_word"),
            names(base).alias("base_labels"),
            names(named).alias("labels"),
            F.coalesce(F.max(F.when(F.col("template").isNotNull(), F.col("cover"))), F.lit(0.0)).alias("score"),
        )
        .drop("row")
    )


_PLACES = " UNION ALL ".join(
    f"SELECT d, i, '{label}' AS label FROM w WHERE {' AND '.join(f'words[i + {k + 1}] = {chr(39)}{x}{chr(39)}' for k, x in enumerate(text.split()))}" for label, text in PHRASES
)
#: The base columns alone can be said in SQL; labels and score are the method's.
BASE_SQL = f"""
WITH t AS (SELECT doc_id, row_number() OVER () AS d, list_filter(string_split_regex(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORDS}'), lambda x: x <> '') AS words FROM documents),
w AS (SELECT d, words, unnest(range(0, len(words))) AS i FROM t),
p AS ({_PLACES})
SELECT doc_id, len(words)::BIGINT AS n_words, count(label)::BIGINT AS n_base, min(i)::BIGINT AS first_word, max(i)::BIGINT AS last_word,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS base_labels
FROM t LEFT JOIN p USING (d) GROUP BY d, doc_id, words
"""
