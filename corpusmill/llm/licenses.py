"""Operator 2, license scans: an exact set-similarity join of text blocks and license templates.

A block is a line, or a window of as many consecutive words as the template has,
at every word of the text and across line ends, so a hard-wrapped notice is one
block.  It matches a template when it holds at least the threshold share of the
template's distinct words (containment).  Template words are ranked by their
frequency over all documents, rarest first.  With |T| words and an overlap of at
least o = ceil(threshold * |T|), one of the template's first |T| - o + 1 words
must be in the block; only documents with such a word are cut into blocks, and
only blocks with one become candidates.  A block with fewer than o words is
dropped (length filter), as is a candidate whose words from the matched one on,
in either order of rank, cannot reach o (positional filter).  What remains is
counted exactly.

Base places, phrases found word by word, are counted beside the join.

Defined cases: a null or empty text has no words, no places, empty labels and
score 0; repeated rows are reported one by one; columns beside (doc_id, text)
are not read.  The templates are a constant of the library, so broadcasting
them has a fixed bound.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.text import NON_WORD, ascii_lower, join_rows, once, row_key, split_words, whole
from corpusmill.session import cut_lineage

#: share of a template's distinct words that a line must hold
THRESHOLD = 0.8
# --- fixed values: phrases and labels of the base counts ---
BASE_PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
# --- license notices as their publishers word them ---
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-2", "This work is licensed under the GNU General Public License, version 2"),
    ("lgpl", "licensed under the GNU Lesser General Public License"),
    ("agpl-3", "licensed under the GNU Affero General Public License, version 3"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
)


def notice_words(text: str) -> list[str]:
    """The words of a notice in order; those of NON_WORD on ASCII notices."""
    return "".join(c if c.isalnum() else " " for c in text.lower()).split()


def template_words(templates=TEMPLATES) -> list[tuple[int, str, list[str]]]:
    """(number, label, distinct words)."""
    return [(number, label, sorted(set(notice_words(text)))) for number, (label, text) in enumerate(templates)]


def word_frequencies(docs: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """How often each of the few given words occurs in all documents."""
    words = docs.select(F.explode(split_words(ascii_lower(whole(F.col("text"))), NON_WORD)).alias("word"))
    counted = words.where(F.col("word").isin(vocabulary)).groupBy("word").agg(F.count("*").alias("n"))
    return {row["word"]: row["n"] for row in counted.collect()}


def prefix_table(
    spark: SparkSession, frequencies: dict[str, int], threshold: float = THRESHOLD, templates=TEMPLATES
) -> tuple[DataFrame, list[str], list[str]]:
    """Rows (word, template, label, at, need, span, words) of the necessary prefixes, their words, and all words by rank."""
    known = template_words(templates)
    order = sorted({w for _, _, words in known for w in words}, key=lambda w: (frequencies.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}
    rows = []
    for number, label, words in known:
        words = sorted(words, key=rank.__getitem__)
        need = math.ceil(threshold * len(words) - 1e-9)
        span = len(notice_words(templates[number][1]))
        rows += [(word, number, label, at, need, span, words) for at, word in enumerate(words[: len(words) - need + 1])]
    schema = "word string, template int, label string, at int, need int, span int, words array<string>"
    return spark.createDataFrame(rows, schema), sorted({row[0] for row in rows}), order


def _candidates(met: DataFrame, prefixes: DataFrame, order: list[str], block: Column) -> DataFrame:
    """Rows (word, ...) of places with a prefix word, by template, whose block passes the filters.

    ``block`` is the words around the place; no part of it that holds the word can pass where it does not.
    """
    found = met.join(F.broadcast(prefixes), "word").withColumn("block", block).where(F.size("block") >= F.col("need"))
    # the block's template words from the matched one on, by rank, bound the overlap
    found = found.withColumn("have", F.array_intersect(F.array(*[F.lit(w) for w in order]), "block")).withColumn(
        "j", F.array_position("have", F.col("word")).cast("int") - 1
    ).where(
        F.least(F.size("words") - F.col("at"), F.size("have") - F.col("j")) + F.least("at", "j") >= F.col("need")
    )
    return found.withColumn("overlap", F.size(F.array_intersect("words", "have"))).where(F.col("overlap") >= F.col("need"))


def match_blocks(docs: DataFrame, prefixes: DataFrame, starts: list[str], order: list[str]) -> DataFrame:
    """Rows (doc_id, text_md5, template, label, containment) of the blocks that meet the threshold."""
    texts = docs.select(*row_key(), ascii_lower(whole(F.col("text"))).alias("_text"))
    texts = texts.select("*", split_words(F.col("_text"), NON_WORD).alias("w"))
    # prefix words of a text: none of them, no candidate
    starting = F.array(*[F.lit(w) for w in starts])
    texts = texts.where(F.arrays_overlap("w", starting))

    lines = texts.select("doc_id", "text_md5", F.explode(F.split("_text", "\n")).alias("_line"))
    lines = lines.select("doc_id", "text_md5", split_words(F.col("_line"), NON_WORD).alias("w"))
    lines = lines.select("*", F.explode(F.array_intersect(starting, "w")).alias("word"))
    of_lines = _candidates(lines, prefixes, order, F.col("w"))

    # all windows that hold the word at a place, within the words less than a window away
    places = texts.select("doc_id", "text_md5", "w", F.posexplode("w").alias("p", "word")).where(F.col("word").isin(starts))
    before = F.least(F.col("p"), F.col("span") - 1)
    around = F.slice("w", F.col("p") - before + 1, before + F.col("span"))
    near = _candidates(places, prefixes, order, around)
    # windows start up to the place, the last one where the text ends
    last = F.greatest(F.lit(0), F.least(before, F.size("block") - F.col("span")))
    in_window = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.size(F.array_intersect("words", F.slice("block", i + 1, F.col("span"))))
    )
    of_windows = near.withColumn("overlap", F.array_max(in_window)).where(F.col("overlap") >= F.col("need"))

    keep = ["doc_id", "text_md5", "template", "label", (F.col("overlap") / F.size("words")).alias("containment")]
    return of_lines.select(*keep).unionByName(of_windows.select(*keep)).distinct()


def phrase_starts(words: Column, phrases=BASE_PHRASES) -> Column:
    """Array of (start, label) of all places of the phrases among the words."""
    parts = [(phrase.split(), label) for phrase, label in phrases]

    def at(i: Column) -> Column:
        case = F
        for part, label in parts:
            here = F.get(words, i) == F.lit(part[0])
            for k, word in enumerate(part[1:], 1):
                here = here & F.coalesce(F.get(words, i + k) == F.lit(word), F.lit(False))
            case = case.when(here, F.lit(label))
        return F.struct(i.cast("bigint").alias("start"), case.otherwise(F.lit(None).cast("string")).alias("label"))

    # two phrases never start at the same word, their first words differ
    return F.filter(F.transform(F.sequence(F.lit(0), F.size(words) - 1), at), lambda p: p["label"].isNotNull())


def base_places(text: Column, phrases=BASE_PHRASES) -> Column:
    """Struct (n_words, places) of a text; word-by-word search only where a phrase's words are at hand."""
    lower = ascii_lower(whole(text))

    def scan(t: Column) -> Column:
        hint = F.lit(False)
        for phrase, _ in phrases:
            near = F.lit(True)
            for word in sorted(phrase.split(), key=len, reverse=True):
                near = near & F.contains(t, F.lit(word))
            hint = hint | near
        none = F.array().cast("array<struct<start:bigint,label:string>>")
        return once(split_words(t, NON_WORD), lambda w: F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.when(hint & (F.size(w) > 0), phrase_starts(w, phrases)).otherwise(none).alias("places"),
        ))

    return once(lower, scan)


def license_scan(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: counts and labels of the phrases, labels and best containment of the join."""
    docs = docs.select("doc_id", "text")
    vocabulary = sorted({w for _, _, words in template_words() for w in words})
    prefixes, starts, order = prefix_table(docs.sparkSession, word_frequencies(docs, vocabulary), threshold)
    matched = match_blocks(docs, prefixes, starts, order).groupBy("doc_id", "text_md5").agg(
        F.collect_set("label").alias("found"), F.max("containment").alias("best")
    )
    matched = cut_lineage(matched)
    base = docs.select(*row_key(), base_places(F.col("text")).alias("b"))
    labels = F.transform(F.col("b.places"), lambda p: p["label"])
    starts = F.transform(F.col("b.places"), lambda p: p["start"])
    joined = lambda names: F.array_join(F.array_sort(F.array_distinct(names)), ",")
    return join_rows(base, matched, "left").select(
        "doc_id",
        F.col("b.n_words").alias("n_words"),
        F.size("b.places").cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(labels).alias("base_labels"),
        joined(F.concat(labels, F.coalesce("found", F.array().cast("array<string>")))).alias("labels"),
        F.coalesce("best", F.lit(0.0)).alias("score"),
    )
