"""License scans (7): diagonal voting of word k-grams against license templates.

All rolling k-grams of a text are joined with the k-grams of the templates. A
hit votes for its diagonal, text position minus template position; a whole
phrase is a diagonal with all of its k-grams. Neighbouring diagonals are merged,
so that inserted or left-out words do not part a span. A span is verified by the
longest sequence of its hits that goes forward in the text and in the template,
so words in another order do not count. Its share of the template's k-grams
decides, or its share of the template's words: a replaced word costs two k-grams,
but one word. For words to decide, the word that names the license must be hit.

DataFrame functions only. The templates are paragraphs in code, so the joined side
has some hundred rows at any size of the input, and a span's work is its hits times
the words of a paragraph.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smogline.llm.common import lower_ascii, texts
from smogline.session import small_table

#: Phrases that count exactly, with their labels (fixed values).
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Notices and paragraphs of licenses that may be altered, with labels of the method's own (fixed values).
TEMPLATES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit-text",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-text",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "mit-text",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd-text",
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed": "bsd-text",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc-text",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions": "zlib-text",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation": "gpl-text",
    "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at": "mpl-2.0",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "apache-2.0",
    "licensed under the apache license version 2 0": "apache-2.0",
    "this work is licensed under the gnu general public license version 3": "gpl-3.0",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "released under the mit license": "mit-notice",
}
#: Words that name a license; where a template has one, its words decide only with it.
NAMES = ("apache", "mit", "gnu", "nc", "mozilla")
K = 2
#: Diagonals at most this far apart belong to one span.
DRIFT = 3
#: Share of a template's k-grams that a span must cover, or share of its words that it must exceed.
COVER = 0.8
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _template_rows() -> tuple[list[tuple], list[tuple]]:
    grams, sizes = [], []
    for number, (phrase, label) in enumerate([*PHRASES.items(), *TEMPLATES.items()]):
        words = phrase.split()
        name = next((j for j, w in enumerate(words) if w in NAMES), None)
        sizes.append((number, label, len(words), name))
        grams += [(number, j, words[j], words[j + 1]) for j in range(len(words) - K + 1)]
    return grams, sizes


def _longest(hits: Column, size: Column, before) -> Column:
    """Greatest value of hits (``at``, ``back`` = - j) that follow each other in text and template.

    hits are sorted by ``at``. The best value that ends at each template place
    is carried along, so the work is hits times template size; ``before`` gives
    the value of a hit from those that end before its place.
    """

    def with_hit(best: Column, hit: Column) -> Column:
        return F.transform(best, lambda n, j: F.when(j == -hit["back"], F.greatest(n, before(best, j))).otherwise(n))

    return F.array_max(F.aggregate(hits, F.array_repeat(F.lit(0), size), with_hit))


def _in_order(hits: Column, size: Column) -> Column:
    """Most hits that follow each other."""
    return _longest(hits, size, lambda best, j: F.coalesce(F.array_max(F.slice(best, 1, j)), F.lit(0)) + 1)


def _words_in_order(hits: Column, size: Column) -> Column:
    """Most template words in hits that follow each other: a hit right after the previous place adds one, others two."""

    def before(best: Column, j: Column) -> Column:
        apart = F.coalesce(F.array_max(F.slice(best, 1, F.greatest(j - 1, F.lit(0)))), F.lit(0)) + 2
        return F.when(j > 0, F.greatest(apart, F.when(F.get(best, j - 1) > 0, F.get(best, j - 1) + 1).otherwise(0))).otherwise(apart)

    return _longest(hits, size, before)


def license_scan(docs: DataFrame) -> DataFrame:
    """Words, phrase places, labels and score per document.

    A missing or empty text has no words, empty labels and score 0. Repeated
    rows stay rows; nothing but ``doc_id`` and ``text`` is read. The score is the
    greatest share of a template's k-grams, also where words gave the label.
    """
    grams, sizes = _template_rows()
    spark = docs.sparkSession
    words = F.array_remove(F.split(lower_ascii(F.col("text")), SEPARATORS), "")
    split = texts(docs).select(F.monotonically_increasing_id().alias("row"), "doc_id", words.alias("words"))
    # the first element stands for the document itself, so that one scan gives hits and counts
    itself = F.array(F.struct(F.lit("").alias("0"), F.size("words").cast("string").alias("1")))
    rolling = F.arrays_zip(F.slice("words", 1, F.greatest(F.size("words") - 1, F.lit(0))), F.slice("words", 2, F.greatest(F.size("words") - 1, F.lit(0))))
    rolled = split.select("row", "doc_id", F.posexplode(F.concat(itself, rolling.cast("array<struct<`0`:string,`1`:string>>"))).alias("at", "gram"))
    hashed = rolled.select("row", "doc_id", (F.col("at") - 1).alias("at"), F.col("gram.0").alias("w1"), F.col("gram.1").alias("w2"))
    hashed = hashed.withColumn("h", F.when(F.col("w1") == "", F.lit(0)).otherwise(F.xxhash64("w1", "w2")))
    known = small_table(spark, [(-1, 0, "", "")] + grams, {"template": "int", "j": "int", "t1": "string", "t2": "string"})
    known = known.withColumn("h", F.when(F.col("t1") == "", F.lit(0)).otherwise(F.xxhash64("t1", "t2")))
    hits = hashed.join(F.broadcast(known), "h").where("template < 0 or (w1 = t1 and w2 = t2)")
    hits = hits.select("row", "doc_id", "at", "template", "j", F.when(F.col("template") < 0, F.col("w2").cast("long")).alias("n_words"))

    # votes: every k-gram of a template at most once per diagonal
    votes = hits.groupBy("row", "doc_id", "template", (F.col("at") - F.col("j")).alias("diagonal")).agg(
        F.count("*").alias("n"), F.max("n_words").alias("n_words"), F.sort_array(F.collect_set("j")).alias("js")
    )
    info = small_table(spark, sizes, {"template": "int", "label": "string", "size": "int", "name": "int"})
    info = info.withColumn("base", F.col("template") < len(PHRASES))
    votes = votes.join(F.broadcast(info), "template", "left")
    by_template = Window.partitionBy("row", "template").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(by_template)
    votes = votes.withColumn("span", F.sum(F.when(gap <= DRIFT, 0).otherwise(1)).over(by_template))
    spans = votes.groupBy("row", "doc_id", "template", "label", "base", "size", "name", "span").agg(
        F.max("n_words").alias("n_words"),
        F.sum(F.when(F.col("base") & (F.col("n") == F.col("size") - K + 1), 1).otherwise(0)).alias("places"),
        F.min(F.when(F.col("base") & (F.col("n") == F.col("size") - K + 1), F.col("diagonal"))).alias("first"),
        F.max(F.when(F.col("base") & (F.col("n") == F.col("size") - K + 1), F.col("diagonal"))).alias("last"),
        F.sort_array(F.flatten(F.collect_list(F.transform("js", lambda j: F.struct((F.col("diagonal") + j).alias("at"), (-j).alias("back")))))).alias("hits"),
    )
    spans = spans.withColumn("covered", F.when(F.col("template") >= len(PHRASES), _in_order(F.col("hits"), F.col("size"))))
    cover = F.when(F.col("template") >= 0, F.col("covered") / (F.col("size") - K + 1))
    spans = spans.withColumn("cover", F.when(F.col("base"), F.when(F.col("places") > 0, 1.0).otherwise(0.0)).otherwise(cover))
    named = F.col("name").isNull() | F.exists("hits", lambda h: (-h["back"]).between(F.col("name") - 1, F.col("name")))
    enough = ~F.col("base") & (F.col("cover") < COVER) & (2 * F.col("covered") > COVER * F.col("size")) & named
    in_words = F.when(enough, _words_in_order(F.col("hits"), F.col("size")) > COVER * F.col("size"))
    found = F.when((F.col("cover") >= COVER) | F.coalesce(in_words, F.lit(False)), F.col("label"))
    joined = lambda c: F.array_join(F.sort_array(F.collect_set(c)), ",")
    return (
        spans.groupBy("row", "doc_id")
        .agg(
            F.max("n_words").alias("n_words"),
            F.sum("places").cast("long").alias("n_base"),
            F.min("first").cast("long").alias("first_word"),
            F.max("last").cast("long").alias("last_word"),
            joined(F.when(F.col("base"), found)).alias("base_labels"),
            joined(found).alias("labels"),
            F.coalesce(F.max("cover"), F.lit(0.0)).alias("score"),
        )
        .drop("row")
    )
