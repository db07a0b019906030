"""License notices by an exact set-similarity join, in column expressions alone.

Known notices are templates, sets of words. Blocks are windows of words over the
whole text, whatever its lines: a template of m words has windows of twice ``span``
words, a power of two from 1.25 m on, one every ``span`` words, so that a notice with
up to a quarter more words than its template lies whole in one of them, and words that
are farther apart than a window don't add up. A block holds a template if it has at
least ``THRESHOLD`` of the template's words.

A text whose words together don't reach a template's threshold has no block that does
and is not cut. Words outside all templates can't add to an overlap and are
left out of the blocks. Words are ordered by their frequency over all blocks,
rarest first. A pair that shares ``o`` words must share one among the first
|T| - o + 1 of the template and the first |B| - o + 1 of the block (prefix
filter), the block must have ``o`` words (length filter), and the place of the
shared word in both orders must leave room for ``o`` (positional filter). Pairs
that pass are verified by their full sets.

Beside it, fixed phrases are counted wherever their words stand consecutively.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableloom.functions.scalar import bind
from tableloom.llm.common import stored

#: Base phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Sentences by which licenses are commonly named or granted, and their labels.
TEMPLATES = (
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("mit", "this software is released under the mit license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by", "licensed under cc by 4 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
)
THRESHOLD = 0.8
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _sets() -> list[tuple[int, str, list[str], int]]:
    """Number, label, distinct words and least overlap of each template."""
    out = []
    for i, (label, text) in enumerate(TEMPLATES):
        words = sorted(set(text.split()))
        out.append((i, label, words, ceil(THRESHOLD * len(words) - 1e-9)))
    return out


def span(template: str) -> int:
    """Words from one window of a template to the next, half of a window."""
    return 1 << ceil(1.25 * len(template.split()) - 1).bit_length()


SPANS = [span(text) for _, text in TEMPLATES]


def _strings(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def _by_span(value) -> Column:
    """``value`` of the templates (their numbers) that have the row's span."""
    out = F.lit(None)
    for s in sorted(set(SPANS)):
        out = F.when(F.col("span") == s, value([t for t in _sets() if SPANS[t[0]] == s])).otherwise(out)
    return out


def held_templates(blocks: DataFrame) -> DataFrame:
    """(block, label, share) for every template that a block holds. ``blocks``: block, span, words (distinct, of the templates' words)."""
    sets = _sets()
    frequency = {r["w"]: r["n"] for r in blocks.select(F.explode("words").alias("w")).groupBy("w").agg(F.count("*").alias("n")).collect()}
    vocabulary = sorted({w for _, _, words, _ in sets for w in words}, key=lambda w: (frequency.get(w, 0), w))
    rank = {w: i for i, w in enumerate(vocabulary)}
    # Blocks as sorted ranks; their prefix must serve the smallest overlap.
    least = _by_span(lambda own: F.lit(min(o for *_, o in own)))
    ranked = blocks.withColumn("ranks", F.array_sort(F.transform("words", lambda w: F.array_position(_strings(vocabulary), w) - 1))).drop("words")
    prefix = ranked.select("block", "span", "ranks", F.posexplode(F.slice("ranks", F.lit(1), F.size("ranks") - least + 1)).alias("at", "rank"))
    index = []
    for i, label, words, o in sets:
        order = sorted(rank[w] for w in words)
        index += [(i, SPANS[i], label, order, o, j, order[j]) for j in range(len(order) - o + 1)]
    spark = blocks.sparkSession
    templates = spark.createDataFrame(index, "template int, span int, label string, whole array<bigint>, least int, place int, rank bigint")
    # The index has as many rows as the templates' prefixes have words.
    near = prefix.join(F.broadcast(templates), ["span", "rank"]).filter(
        (F.size("ranks") >= F.col("least"))
        & (F.least(F.col("at"), F.col("place")) + 1 + F.least(F.size("ranks") - F.col("at"), F.size("whole") - F.col("place")) - 1 >= F.col("least")))
    shared = F.size(F.array_intersect("ranks", "whole"))
    return near.withColumn("shared", shared).filter(F.col("shared") >= F.col("least")).groupBy("block", "label").agg(
        F.max(F.col("shared") / F.size("whole")).alias("share"))


def _windows(words: Column) -> Column:
    """Array of (span, words of the templates with that span) of every window that has enough of them."""
    out = []
    for s in sorted(set(SPANS)):
        own = [t for t in _sets() if SPANS[t[0]] == s]
        known, least = _strings(sorted({w for _, _, ws, _ in own for w in ws})), min(o for *_, o in own)
        last = F.greatest(F.ceil((F.size(words) - 2 * s) / s).cast("int"), F.lit(0))
        cut = F.transform(F.sequence(F.lit(0), last), lambda k: F.array_intersect(F.slice(words, k * s + 1, 2 * s), known))
        out.append(F.transform(F.filter(cut, lambda b: F.size(b) >= least), lambda b: F.struct(F.lit(s).alias("span"), b.alias("words"))))
    return F.concat(*out)


def labelled(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Per row: key, n_words, n_base, first_word, last_word, base_labels, labels (arrays, sorted), score.

    ``score`` is the largest share of a template that a window of words holds, 1 with a
    base label and 0 without any. A null text is an empty one: no words, places or
    labels. Repeated rows give equal rows, a null key is a key like others; no rows
    give none, a very long text is cut like any other, other columns are not read.
    """
    vocabulary = sorted({w for _, _, words, _ in _sets() for w in words})
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    lower = F.translate("text", _UPPER, _LOWER)
    words = F.regexp_extract_all(lower, F.lit(_WORD), 0)
    total = lambda sizes: F.aggregate(sizes, F.lit(0).cast("long"), lambda a, n: a + n)

    def hopeful(own: Column) -> Column:
        """Whether the whole text has enough words of some template."""
        out = F.lit(False)
        for _, _, whole, o in _sets():
            out = out | (F.size(F.array_intersect(own, _strings(whole))) >= o)
        return out

    def measured(words: Column) -> Column:
        # Each word stands between two blanks of its own, so that places next to each other both count.
        joined = F.concat(F.lit(" "), F.array_join(words, "  "), F.lit(" "))
        cut = F.when(bind(F.array_intersect(words, _strings(vocabulary)), hopeful), words)
        return F.struct(F.size(words).cast("long").alias("n_words"), cut.alias("words"), joined.alias("joined"))

    row = rows.select("key", F.xxhash64("text").alias("print"), bind(words, measured).alias("m"))

    def places(joined: Column, n_words: Column) -> Column:
        each = []
        for phrase, label in PHRASES.items():
            shown = " " + "  ".join(phrase.split()) + " "
            size = len(phrase.split())
            # A blank on either side of each word: the words of a part are half its blanks.
            words = lambda part: ((F.length(part) - F.length(F.replace(part, F.lit(" "), F.lit("")))) / 2).cast("long")
            n = ((F.length(joined) - F.length(F.replace(joined, F.lit(shown), F.lit("")))) / len(shown)).cast("long")
            first = words(F.substring_index(joined, shown, 1))
            last = n_words - words(F.substring_index(joined, shown, -1)) - size
            each.append(F.when(F.contains(joined, F.lit(shown)), F.struct(
                F.lit(label).alias("label"), n.alias("n"), first.alias("first"), last.alias("last"))))
        return F.array_compact(F.array(*each))

    found = row.select("key", "print", "m.n_words", "m.words", places(F.col("m.joined"), F.col("m.n_words")).alias("places"))
    narrow = stored(found, "licenses")
    hopes = narrow.filter(F.col("words").isNotNull()).dropDuplicates(["key", "print"])
    blocks = hopes.select(F.struct("key", "print").alias("block"), F.explode(_windows(F.col("words"))).alias("w")).select("block", "w.span", "w.words")
    held = held_templates(blocks).groupBy("block").agg(
        F.collect_set("label").alias("more"), F.max("share").alias("share")).select("block.key", "block.print", "more", "share")
    rows_ = narrow.alias("n").join(held.alias("h"), F.col("n.key").eqNullSafe(F.col("h.key")) & (F.col("n.print") == F.col("h.print")), "left")
    base = F.array_sort(F.array_distinct(F.transform("places", lambda p: p["label"])))
    more = F.coalesce("more", F.array().cast("array<string>"))
    return rows_.select(
        F.col("n.key").alias(key), "n_words", total(F.transform("places", lambda p: p["n"])).alias("n_base"),
        F.array_min(F.transform("places", lambda p: p["first"])).alias("first_word"),
        F.array_max(F.transform("places", lambda p: p["last"])).alias("last_word"),
        base.alias("base_labels"), F.array_sort(F.array_distinct(F.concat(base, more))).alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"))
