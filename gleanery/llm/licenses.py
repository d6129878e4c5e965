"""License scan: exact set-similarity join of text blocks with license templates.

A template is the word set of a known notice. By default a block is a line of a document (split at
\\n), as the set of its words. With ``lines=False``, as in the query, line ends do not matter: a template of m
words (with repeats) is sought in every run of ``span`` = m / threshold (rounded up) words of the document. Blocks then are runs of
twice the longest span, one from each multiple of it, so that each run is whole in one of them; what the
filters leave of them is decided in the runs themselves, where a template also needs the words that tell it from
templates of other labels (``distinguished``). A block matches if it contains at least ``threshold`` of the template's words. With o
the least overlap a template of m words allows, all words are ordered by the number of blocks that
have them, rarest first, and

* prefix: a match contains one of the template's first m - o + 1 words, so only those are joined on,
* length: a block with fewer than o template words cannot match,
* position: after the first common word at places i and j at most min(m - i, n - j) words can follow,

then the overlap of what is left is counted in full. Only DataFrame functions run here.

The templates are a parameter; their index (a row per template word) is broadcast if it is as small
as ``fits`` proves, else the join shuffles. Blocks are cut down to template words before they are exploded.

Defined results: null text is empty; words are compared with A-Z lower-cased; repeated rows each get
the same result; other columns are ignored; an empty table gives no rows; without templates only the
phrases count.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanery.llm.prefix import row_key
from gleanery.session import fits

THRESHOLD = 0.85
#: Templates of fewer words are names: their words must stand consecutively and in order.
SHORT_WORDS = 10
#: Template words up to which the index is broadcast.
BROADCAST_WORDS = 100_000

#: Phrases (their words must stand consecutively) and labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Label and text of the licences' own notices: the grant or the header that each licence (MIT, BSD, ISC, MPL, Unlicense,
#: CC0), its appendix (Apache, GNU) or its publisher (Creative Commons: full and short names) gives for use in files. Versions
#: are left out where the wording is the same.
TEMPLATES = [
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction',
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies",
    ),
    (
        "apache",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    ),
    (
        "gpl",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation",
    ),
    (
        "lgpl",
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by "
        "the Free Software Foundation",
    ),
    (
        "agpl",
        "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by "
        "the Free Software Foundation",
    ),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("cc0", "CC0 1.0 Universal"),
    ("cc-by", "Creative Commons Attribution 4.0 International"),
    ("cc-by-sa", "Creative Commons Attribution-ShareAlike 4.0 International"),
    ("cc-by-nc", "Creative Commons Attribution-NonCommercial 4.0 International"),
    ("cc-by-nd", "Creative Commons Attribution-NoDerivatives 4.0 International"),
    ("cc-by-nc-sa", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International"),
    ("cc-by-nc-nd", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International"),
    ("cc-by", "CC BY 4.0"),
    ("cc-by-sa", "CC BY-SA 4.0"),
    ("cc-by-nc", "CC BY-NC 4.0"),
    ("cc-by-nd", "CC BY-ND 4.0"),
    ("cc-by-nc-sa", "CC BY-NC-SA 4.0"),
    ("cc-by-nc-nd", "CC BY-NC-ND 4.0"),
]

_GAP = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
#: Words of texts in their own case: the same runs as after lower-casing A-Z.
_WORD = rf"[^{_GAP}]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: str) -> list[str]:
    lowered = text.translate(str.maketrans(_UPPER, _LOWER))
    return re.findall(_WORD, lowered)


def split_words(text: Column) -> Column:
    """The words of a text; splitting at the gaps costs half of extracting the words."""
    return F.array_remove(F.split(text, f"[{_GAP}]+"), "")


def word_total(text: Column) -> Column:
    return F.size(split_words(text)).cast("long")


def phrase_places(text: Column, phrases: dict[str, str] = PHRASES) -> Column:
    """For each phrase places (all), first and last start word, and label if it is there; null
    for texts without any phrase's longest word, which one cheap search tells."""
    found = []
    rare = "|".join(sorted({re.escape(max(words_of(p), key=len)) for p in phrases}))
    for phrase, label in phrases.items():
        body = rf"(?<![^{_GAP}])" + rf"[{_GAP}]+".join(re.escape(w) for w in words_of(phrase)) + rf"(?![^{_GAP}])"
        pattern = F.lit(f"(?i){body}")
        # Words before the first place, and before the last one (the greedy head stops there). No places of
        # characters: regexp_instr counts UTF-16 units, substring code points.
        head = F.regexp_extract(text, f"(?is)^(.*?){body}", 1)
        long_head = F.regexp_extract(text, f"(?is)^(.*){body}", 1)
        has = text.rlike(f"(?i){body}")
        found.append(
            F.struct(
                F.when(has, F.regexp_count(text, pattern)).otherwise(0).cast("long").alias("places"),
                F.when(has, word_total(head)).alias("first"),
                F.when(has, word_total(long_head)).alias("last"),
                F.when(has, F.lit(label)).alias("label"),
            )
        )
    return F.when(text.rlike(f"(?i){rare}"), F.array(*found))


def need_of(text: str, threshold: float) -> int:
    """The distinct words of a template that a match must have: all of a short one."""
    words = words_of(text)
    return len(set(words)) if len(words) < SHORT_WORDS else max(1, math.ceil(threshold * len(set(words)) - 1e-9))


def span_of(text: str, threshold: float) -> int:
    """The length of the runs in which a template is sought: its own, for a short one."""
    words = words_of(text)
    return len(words) if len(words) < SHORT_WORDS else math.ceil(len(words) / threshold - 1e-9)


def template_rows(templates: list[tuple[str, str]], threshold: float) -> list[tuple]:
    """(template, label, words (distinct), need, span, exact (the word sequence of a short one), and what
    ``distinguished`` says) of each template with words."""
    rows = []
    for i, (label, text) in enumerate(templates):
        sequence = words_of(text)
        if sequence:
            words, need = sorted(set(sequence)), need_of(text, threshold)
            short = len(sequence) < SHORT_WORDS
            told = ([], []) if short else distinguished(label, sequence, need, templates)
            rows.append((i, label, words, need, span_of(text, threshold), sequence if short else [], *told))
    return rows


def template_table(spark: SparkSession, templates: list[tuple[str, str]], threshold: float) -> DataFrame:
    schema = (
        "template int, label string, words array<string>, need int, span int, exact array<string>, "
        "own array<array<string>>, wider array<array<string>>"
    )
    return spark.createDataFrame(template_rows(templates, threshold), schema)


def distinguished(
    label: str, sequence: list[str], need: int, templates: list[tuple[str, str]]
) -> tuple[list[list[str]], list[list[str]]]:
    """Among templates of other labels whose whole text would match: for each word that one of them lacks the pairs of
    neighbours that it makes in the template, one of which a match must have; and for those that have all words, what they
    have besides, which no match may have as a whole."""
    own, wider, words = set(), set(), set(sequence)
    for other, text in templates:
        theirs = set(words_of(text))
        if other != label and len(theirs & words) >= need:
            own |= words - theirs
            if theirs > words:
                wider.add(tuple(sorted(theirs - words)))
    pairs = list(zip(sequence, sequence[1:]))
    return [sorted({f"{x} {y}" for x, y in pairs if w in (x, y)}) for w in sorted(own)], sorted(map(list, wider))


def runs(docs: DataFrame, vocabulary: list[str], least: int, width: int) -> DataFrame:
    """_key, ``tokens`` (the distinct template words, at least ``least``) and all words (``run``) of the blocks of 2 ``width`` words."""
    words = docs.select(row_key(docs), split_words(F.translate("text", _UPPER, _LOWER)).alias("words"))
    last = F.greatest(F.size("words") - width, F.lit(0))
    # Outer: else Spark adds a filter that splits the text twice.
    placed = words.select("_key", "words", F.explode_outer(F.sequence(F.lit(0), last, F.lit(width))).alias("at"))
    run = F.slice("words", F.col("at") + 1, 2 * width)
    tokens = F.array_intersect(run, F.array(*map(F.lit, vocabulary)))
    return placed.select("_key", tokens.alias("tokens"), run.alias("run")).where(F.size("tokens") >= least)


def best_overlap() -> Column:
    """Most words of the template in one run of its span that is not better told as another template."""
    starts = F.sequence(F.lit(1), F.greatest(F.size("run") - F.col("span") + 1, F.lit(1)))

    def overlap(start):
        words = F.slice("run", start, F.col("span"))
        pairs = F.zip_with(words, F.slice("run", start + 1, F.col("span") - 1), lambda x, y: F.concat(x, F.lit(" "), y))
        own = F.forall("own", lambda near: F.arrays_overlap(near, F.array_compact(pairs)))
        told = own & ~F.exists("wider", lambda more: F.size(F.array_except(more, words)) == 0)
        right = F.when(F.size("exact") > 0, words == F.col("exact")).otherwise(told)
        return F.when(right, F.size(F.array_intersect(words, F.col("words")))).otherwise(0)

    return F.array_max(F.transform(starts, overlap))


def document_tokens(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    tokens = F.array_intersect(split_words(F.translate("text", _UPPER, _LOWER)), F.array(*map(F.lit, vocabulary)))
    return docs.select(F.explode_outer(tokens).alias("token")).where("token IS NOT NULL")


def similar_blocks(
    docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD
) -> DataFrame:
    """_key, label, containment of every (block, template) at or above the threshold."""
    spark = docs.sparkSession
    table = template_table(spark, templates, threshold)
    texts = [t for _, t in templates if words_of(t)]
    vocabulary = sorted(set().union(*(words_of(t) for t in texts))) or [""]
    least = min((need_of(t, threshold) for t in texts), default=1)
    width = max((span_of(t, threshold) for t in texts), default=1)

    # The order decides nothing but the speed: documents count.
    counted = document_tokens(docs, vocabulary).groupBy("token").count()
    known = spark.createDataFrame([(w,) for w in vocabulary], "token string")
    # One row per word of the templates.
    order = (
        known.join(counted, "token", "left")
        .select("token", F.row_number().over(Window.orderBy(F.coalesce("count", F.lit(0)), "token")).alias("place"))
        .agg(F.array_sort(F.collect_list(F.struct("place", "token"))).alias("o"))
        .first()["o"]
    )
    ordered = F.array(*[F.lit(row["token"]) for row in order])
    in_order = lambda words: F.array_intersect(ordered, words)  # noqa: E731  rarest first

    index = table.withColumn("words", in_order(F.col("words"))).select("*", F.posexplode("words").alias("i", "token"))
    index = index.where(F.col("i") <= F.size("words") - F.col("need"))
    if fits(index, BROADCAST_WORDS):
        index = F.broadcast(index)
    place = {row["token"]: i for i, row in enumerate(order)}
    rarest = set()
    for text in texts:
        words = set(words_of(text))
        rarest.update(sorted(words, key=place.get)[: len(words) - need_of(text, threshold) + 1])
    found = runs(docs, vocabulary, least, width)
    # Before blocks are exploded with their words: those without a word of any prefix join with nothing.
    found = found.where(F.arrays_overlap("tokens", F.array(*map(F.lit, sorted(rarest) or [""]))))
    probes = found.withColumn("tokens", in_order(F.col("tokens"))).select("*", F.posexplode("tokens").alias("j", "token"))
    bound = F.least(F.size("words") - F.col("i"), F.size("tokens") - F.col("j"))
    overlap = F.size(F.array_intersect("tokens", "words"))
    similar = (
        probes.join(index, "token")
        .where((F.size("tokens") >= F.col("need")) & (bound + F.col("i") >= F.col("need")))
        .where(overlap >= F.col("need"))
    )
    # A pair meets once for each common word of the prefix.
    pairs = similar.select("_key", "label", "words", "need", "span", "exact", "own", "wider", "run").distinct()
    best = pairs.select("_key", "label", "words", "need", best_overlap().alias("most")).where("most >= need")
    return best.select("_key", "label", (F.col("most") / F.size("words")).alias("containment"))


def scan(
    docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD
) -> DataFrame:
    """doc_id, n_words, the places of the phrases, base_labels, labels and score: 1 with a phrase,
    else the best containment of a matching block, else 0."""
    plain = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = similar_blocks(plain, templates, threshold)
    by_doc = found.groupBy("_key").agg(
        F.collect_set("label").alias("similar"), F.max("containment").alias("containment")
    )
    base = plain.select(
        "doc_id", row_key(plain), word_total(F.col("text")).alias("n_words"), phrase_places(F.col("text")).alias("p")
    )
    none = F.array().cast("array<string>")
    labels = F.coalesce(F.array_sort(F.array_distinct(F.array_compact(F.col("p")["label"]))), none)
    places = F.coalesce(F.aggregate(F.col("p")["places"], F.lit(0).cast("long"), lambda s, x: s + x), F.lit(0))
    return base.join(by_doc, "_key", "left").select(
        "doc_id",
        "n_words",
        places.cast("long").alias("n_base"),
        F.array_min(F.col("p")["first"]).alias("first_word"),
        F.array_max(F.col("p")["last"]).alias("last_word"),
        F.array_join(labels, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(labels, F.coalesce("similar", none))), ",").alias("labels"),
        F.when(places > 0, 1.0).otherwise(F.coalesce("containment", F.lit(0.0))).alias("score"),
    )
