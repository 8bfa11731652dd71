"""License scan by diagonal voting, with DataFrame operations only.

Every rolling k-gram of a text's words is joined with the k-gram positions of the license templates. A match votes for
the diagonal (place in the text minus place in the template): an unbroken copy puts all its votes on one diagonal, an
inserted or lost word moves the rest to a neighbouring one. A diagonal with the most votes among those within MAX_SHIFT
of it (ties: the smallest) takes them into its span. A span counts when the share of the template's k-grams that are
matched in it, each once, is at least MIN_COVERAGE (words are compared, not only hashes): a phrase that repeats matches
the same few k-grams again and again, and adds nothing.

Templates are fixed texts of this module, so the joined side is of constant size and can be broadcast. The short
phrases are templates that must match in full; the longer ones add labels of their own.

Defined results: a null or empty text has no words, no places, empty labels and score 0; a null doc_id is carried;
repeated rows get a row each; a very long text is scanned whole; extra columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

K = 2
MAX_SHIFT = 3
MIN_COVERAGE = 0.6
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # words are what stands between gaps

# The phrases and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Opening passages of well-known licenses, matched with gaps; the label is the method's own.
PASSAGES = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction", "mit-text"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met", "bsd-text"),
    ("licensed under the apache license version 2 0 the license you may not use this file except in compliance with "
     "the license", "apache-text"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
     "license as published by the free software foundation", "gpl-text"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
     "granted", "isc-text"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-text"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by-text"),
    ("released under the mit license", "mit-notice"),
    ("distributed under the boost software license version 1 0", "boost-text"),
    ("this is free and unencumbered software released into the public domain", "unlicense-text"),
)


KELVIN, ANGSTROM = "\u212a", "\u212b"
WHOLE = -1  # the template number under which every text reports itself


def lowered(text):
    """A-Z in lower case. lower() also changes other letters, none of which can become or stop being part of a word;
    only the Kelvin sign would turn into an ASCII letter, so it is replaced by another letter first."""
    return F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit(KELVIN), F.lit(ANGSTROM)))


def templates(spark: SparkSession, phrases=PHRASES, passages=PASSAGES) -> DataFrame:
    """gram (hash), words w0..w(K-1), template, tpos, n_grams, label, phrase: one row per template k-gram, and one
    row with gram 0 that meets the end of every text."""
    rows = [(WHOLE, 0, 1, None, False, *[None] * K)]
    for number, (text, label, phrase) in enumerate([(t, x, True) for t, x in phrases] + [(t, x, False) for t, x in passages]):
        words = text.split()
        grams = [words[i:i + K] for i in range(len(words) - K + 1)]
        rows += [(number, i, len(grams), label, phrase, *gram) for i, gram in enumerate(grams)]
    schema = "template int, tpos int, n_grams int, label string, phrase boolean, " + ", ".join(f"w{i} string" for i in range(K))
    gram = F.when(F.col("template") == WHOLE, F.lit(0)).otherwise(F.xxhash64(*[f"w{i}" for i in range(K)]))
    return spark.createDataFrame(rows, schema).withColumn("gram", gram)


def matches(docs: DataFrame, grams: DataFrame) -> DataFrame:
    """Template k-grams found in the texts: doc_id, row (hash of the text), template, tpos, place, n_grams, label,
    phrase and copies (input rows of this id and text). Every text has a WHOLE match, whose place is its word count."""
    words = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("row"),
                        F.array_remove(F.split(lowered(F.col("text")), GAP), "").alias("words"))
    rolled = F.arrays_zip(*[(F.col("words") if j == 0 else F.slice("words", j + 1, F.size("words"))).alias(f"d{j}") for j in range(K)])
    places = words.select("doc_id", "row", F.posexplode_outer(rolled).alias("place", "at"))
    # the last word starts no k-gram: its row stands for the end of the text (an empty text has a row of nulls)
    places = places.select("doc_id", "row", "place", *[F.col("at")[f"d{j}"].alias(f"d{j}") for j in range(K)])
    whole = F.col("d1").isNull()
    places = places.withColumn("key", F.when(whole, F.lit(0)).otherwise(F.xxhash64(*[f"d{j}" for j in range(K)])))
    same = (F.col("template") == WHOLE) & whole
    equal = F.lit(True)
    for j in range(K):
        equal = equal & (F.col(f"d{j}") == F.col(f"w{j}"))
    # the templates are constants of this module: a side of fixed size
    found = places.join(F.broadcast(grams), (F.col("key") == F.col("gram")) & (same | equal))
    place = F.when(whole, F.coalesce(F.col("place") + 1, F.lit(0))).otherwise(F.col("place"))
    keys = ["doc_id", "row", "template", "tpos", "place", "n_grams", "label", "phrase"]
    # equal rows are one from here on, put together before they are dealt; the groupings and windows that follow stay on
    # the second deal
    return (found.withColumn("place", place).select(*keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
            .repartition("doc_id", "row"))


def diagonals(found: DataFrame) -> DataFrame:
    """Votes per text, template and diagonal: the template positions matched on it (at most n_grams, each once), and
    those matched within MAX_SHIFT of it."""
    at = F.col("place") - F.col("tpos")
    votes = (found.groupBy("doc_id", "row", "template", "n_grams", "label", "phrase", at.alias("diagonal"))
             .agg(F.collect_set("tpos").alias("met"), F.min("place").alias("first"), F.max("place").alias("last"), F.max("copies").alias("copies"))
             .withColumn("votes", F.size("met")))
    near = Window.partitionBy("doc_id", "row", "template").orderBy("diagonal").rangeBetween(-MAX_SHIFT, MAX_SHIFT)
    strongest = F.max(F.struct("votes", -F.col("diagonal"))).over(near) == F.struct("votes", -F.col("diagonal"))
    return (votes.withColumn("strongest", strongest).withColumn("around", F.size(F.array_distinct(F.flatten(F.collect_list("met").over(near)))))
            .withColumn("begin", F.min("first").over(near)).withColumn("end", F.max("last").over(near)))


def spans(found: DataFrame) -> DataFrame:
    """Verified spans: doc_id, row, template, label, phrase, first, last (words), coverage, copies; WHOLE rows stay."""
    alone = (F.col("template") == WHOLE) | F.col("phrase")  # phrases allow no gap: all of their k-grams on one diagonal
    coverage = F.when(alone, F.col("votes")).otherwise(F.col("around")) / F.col("n_grams")
    sound = F.when(F.col("template") == WHOLE, True).when(F.col("phrase"), F.col("votes") == F.col("n_grams")).otherwise(
        F.col("strongest") & (coverage >= MIN_COVERAGE))
    return diagonals(found).where(sound).select(
        "doc_id", "row", "template", "label", "phrase", F.when(alone, F.col("first")).otherwise(F.col("begin")).alias("first"),
        (F.when(alone, F.col("last")).otherwise(F.col("end")) + K - 1).alias("last"), coverage.alias("coverage"), "copies")


def scan(docs: DataFrame, phrases=PHRASES, passages=PASSAGES) -> DataFrame:
    """One row per input row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Rows equal in doc_id and text are scanned as one and given out as often as they came.
    """
    found = spans(matches(docs, templates(docs.sparkSession, phrases, passages)))
    whole, base = F.col("template") == WHOLE, F.col("phrase")
    labels = lambda of: F.array_join(F.array_sort(F.collect_set(F.when(of, F.col("label")))), ",")
    per_doc = found.groupBy("doc_id", "row").agg(
        F.max(F.when(whole, F.col("first"))).cast("long").alias("n_words"),
        F.sum(base.cast("long")).alias("n_base"),
        F.min(F.when(base, F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("first"))).cast("long").alias("last_word"),
        labels(base).alias("base_labels"), labels(~whole).alias("labels"),
        F.coalesce(F.max(F.when(~whole, F.col("coverage"))), F.lit(0.0)).alias("score"),
        F.max("copies").alias("copies"))
    return (per_doc.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .drop("row", "copies", "copy"))


def op9_license_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(common.documents(spark, sf_dir))
