"""License scan by diagonal voting, with DataFrame functions only.

The hashes of all runs of ``GRAM`` words of every document are joined with those of the templates. A
match at word d of the document and t of the template votes for the diagonal d - t. A diagonal with
every run of a template is a place where its words stand consecutively. Diagonals at most ``BAND``
apart, as words left out or put in make them, are merged; merged spans are verified: they must hold
``COVERAGE`` of the template's runs within ``STRETCH`` times its length.

Words are runs of characters other than ASCII ones that are no letter or digit, A-Z in lower case.
Defined cases: a null or empty text has no words, no labels and score 0; rows that repeat doc_id and
text count as one document and get the same result. An empty table gives an empty result; further columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import ascii_lower

GRAM = 3
BAND = 3
COVERAGE = 0.7
STRETCH = 1.5
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
MAX_BROADCAST = 20_000  # runs of words in all templates; beyond that the join shuffles

# Phrases whose places are counted, and their labels.
BASE = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)
# Wordings of public licences, found also where a few words differ.
MORE = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("gpl", "licensed under the gnu general public license"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", "under the terms of the gnu lesser general public license"),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("reserved", "all rights reserved"),
)


def template_grams(spark: SparkSession, base: Sequence, more: Sequence) -> tuple[DataFrame, int]:
    """``(template, label, is_base, n_words, t, gram)`` of all runs of the templates, and their number."""
    rows = []
    for n, (label, text) in enumerate((*base, *more)):
        words = text.split()
        if len(words) < GRAM:
            raise ValueError(f"a template needs {GRAM} words: {text}")
        rows += [(n, label, n < len(base), len(words), t, words[t : t + GRAM]) for t in range(len(words) - GRAM + 1)]
    grams = spark.createDataFrame(rows, "template int, label string, is_base boolean, n_words int, t int, words array<string>")
    return grams.select("template", "label", "is_base", "n_words", "t", _gram("words", F.lit(0)).alias("gram")), len(rows)


def _gram(words: str, at: Column) -> Column:
    return F.xxhash64(*(F.col(words)[at + n] for n in range(GRAM)))


def words_of(text: Column) -> Column:
    """The words of a text, A-Z in lower case."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def license_spans(docs: DataFrame, base: Sequence = BASE, more: Sequence = MORE) -> DataFrame:
    """``(doc_id, text_hash, template, label, is_base, diagonal, coverage, first_word, last_word, places)``.

    One row a verified span: where it starts and ends (words from 0), the share of the template's runs
    that it holds, and the starts of its exact places.
    """
    grams, n_grams = template_grams(docs.sparkSession, base, more)
    grams = F.broadcast(grams) if n_grams <= MAX_BROADCAST else grams
    texts = docs.where("text IS NOT NULL").select("doc_id", F.xxhash64("text").alias("text_hash"), words_of(F.col("text")).alias("words"))
    starts = F.when(F.size("words") >= GRAM, F.sequence(F.lit(0), F.size("words") - GRAM)).otherwise(F.array().cast("array<int>"))
    rolled = texts.select("doc_id", "text_hash", F.posexplode(F.transform(starts, lambda i: _gram("words", i))).alias("d", "gram"))
    votes = rolled.join(grams, "gram").withColumn("diagonal", F.col("d") - F.col("t"))
    document, named = ["doc_id", "text_hash"], ["template", "label", "is_base", "n_words"]
    diagonals = votes.groupBy(*document, *named, "diagonal").agg(
        F.collect_set("t").alias("found"), F.min("d").alias("low"), F.max("d").alias("high")
    )
    runs = F.col("n_words") - (GRAM - 1)
    by_template = Window.partitionBy(*document, "template").orderBy("diagonal")
    # a further diagonal starts a new span, and so does one that starts after the template would end
    far = F.col("diagonal") - F.lag("diagonal").over(by_template) > F.least(F.lit(BAND), runs)
    numbered = diagonals.withColumn("exact", F.size("found") == runs).withColumn(
        "span", F.sum(F.coalesce(far, F.lit(True)).cast("int")).over(by_template)
    )
    spans = numbered.groupBy(*document, *named, "span").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("found")))).alias("n_found"),
        F.min("low").alias("first_word"),
        (F.max("high") + GRAM - 1).alias("last_word"),
        F.min("diagonal").alias("diagonal"),
        F.sort_array(F.collect_list(F.when(F.col("exact"), F.col("diagonal")))).alias("places"),
    )
    spans = spans.withColumn("coverage", F.col("n_found") / runs)
    length = F.col("last_word") - F.col("first_word") + 1
    kept = (F.size("places") > 0) | ((F.col("coverage") >= COVERAGE) & (length <= F.col("n_words") * STRETCH))
    return spans.where(kept).select(
        *document, "template", "label", "is_base", "diagonal", "coverage", "first_word", "last_word", "places"
    )


def scan(docs: DataFrame, base: Sequence = BASE, more: Sequence = MORE) -> DataFrame:
    """One row a document: number of words, exact places of base phrases, labels and a score."""
    spans = license_spans(docs, base, more)
    exact = F.when(F.col("is_base") & (F.size("places") > 0), F.col("label"))
    first = F.when(F.col("is_base"), F.array_min("places"))
    last = F.when(F.col("is_base"), F.array_max("places"))

    def listed(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(labels)), ",")

    found = spans.groupBy("doc_id", "text_hash").agg(
        F.sum(F.when(F.col("is_base"), F.size("places")).otherwise(0)).alias("n_base"),
        F.min(first).cast("bigint").alias("first_word"),
        F.max(last).cast("bigint").alias("last_word"),
        listed(exact).alias("base_labels"),
        listed(F.col("label")).alias("labels"),
        F.max("coverage").alias("score"),
    )
    found = found.select(F.struct("doc_id", "text_hash").alias("key"), "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    every = docs.select(
        F.struct("doc_id", F.xxhash64("text").alias("text_hash")).alias("key"),
        F.size(words_of(F.col("text"))).cast("bigint").alias("n_words"),
    )
    return every.join(found, "key", "left").select(
        "key.doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("bigint").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def op8(docs: DataFrame) -> DataFrame:
    """The licence scan of every document."""
    return scan(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"))
