"""Licence phrases and notices in whole texts, found by diagonal voting.

1. Templates, phrases and longer notices, are cut into rolling word grams: a phrase is one gram, a
   notice has a gram of five words at each of its places.
2. The rolling hashes at every word of all documents are joined with the grams' hashes, and hits whose
   words differ are left out. A hit pairs a place in the document with a place in a template.
3. Hits are summed by document, template and diagonal (document place less template place). A text
   that follows a template without change votes for one diagonal.
4. Neighbouring diagonals, at most ``MAX_DRIFT`` words apart and overlapping in the document, are
   merged: these are the same notice with words put in or left out.
5. A merged span counts if it covers at least half of the template's grams.

The templates are parameters with a few hundred words, so their grams are broadcast; their number is
checked. Hits are grouped by document and template, never by template alone.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import Workspace, alnum_words
from ledgerloom.llm.grams import find_grams

# Phrases and their labels (fixed values).
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Notices as their licences ask to write them (fixed values), under labels of their own.
NOTICES = {
    "apache-notice": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in"
    " compliance with the License. You may obtain a copy of the License at",
    "apache-2.0": "licensed under the Apache License, Version 2.0",
    "bsd-conditions": "Redistribution and use in source and binary forms, with or without modification, are permitted"
    " provided that the following conditions are met",
    "cc-by-nc-4.0": "licensed under CC BY-NC 4.0",
    "cc-by-sa-4.0": "licensed under CC BY-SA 4.0",
    "gpl-3.0": "licensed under the GNU General Public License, version 3",
    "gpl-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
    " General Public License as published by the Free Software Foundation",
    "mit-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
    " associated documentation files (the Software), to deal in the Software without restriction",
    "mit-release": "released under the MIT License",
    "mpl-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "reserved": "all rights reserved",
}

GRAM = 5
MAX_DRIFT = 4
LEAST_COVERED = 0.5
MOST_GRAMS = 100_000


def template_grams(spark: SparkSession, phrases: dict[str, str], notices: dict[str, str]) -> DataFrame:
    """gram and where it stands: template, label, is_phrase, n_grams, place; one row for each gram of each template."""
    rows = [(text, label, True) for text, label in phrases.items()] + [(text, label, False) for label, text in notices.items()]
    table = spark.createDataFrame([(k, *row) for k, row in enumerate(rows)], "template int, text string, label string, is_phrase boolean")
    words = table.withColumn("words", alnum_words(F.col("text"))).where(F.size("words") > 0)
    length = F.when(F.col("is_phrase"), F.size("words")).otherwise(F.least(F.size("words"), F.lit(GRAM)))
    words = words.withColumn("length", length).withColumn("n_grams", F.size("words") - F.col("length") + 1)
    grams = F.transform(F.sequence(F.lit(1), F.col("n_grams")), lambda i: F.slice("words", i, F.col("length")))
    return words.select("template", "label", "is_phrase", "n_grams", F.posexplode(grams).alias("place", "gram"))


def _count(text: str) -> int:
    return len(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text))


def _lengths(phrases: dict[str, str], notices: dict[str, str]) -> list[int]:
    own = {_count(text) for text in phrases} | {min(GRAM, _count(text)) for text in notices.values()}
    return sorted(own - {0})


def places(docs: DataFrame, phrases: dict[str, str], notices: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Stored rows of ``find_grams`` for the templates' grams, and the grams' table."""
    n_grams = sum(_count(text) for text in [*phrases, *notices.values()])
    if n_grams > MOST_GRAMS:
        raise ValueError(f"templates of {n_grams} words are more than the {MOST_GRAMS} that are broadcast")
    space = Workspace(docs.sparkSession, "licences")
    grams = space.store(template_grams(docs.sparkSession, phrases, notices).coalesce(1), "grams")
    return space.store(find_grams(docs, grams.select("gram").distinct(), _lengths(phrases, notices)), "places"), grams


def spans(found: DataFrame, grams: DataFrame) -> DataFrame:
    """doc_id, text_hash, label, is_phrase, first, last (words, from 0), covered (0 to 1) of each verified span.

    Overlapping places of one phrase are spans of their own.
    """
    hits = found.select("doc_id", "text_hash", F.explode("hits").alias("hit")).select("doc_id", "text_hash", "hit.at", "hit.gram").distinct()
    hits = hits.join(F.broadcast(grams), "gram")
    one = ["doc_id", "text_hash", "template", "label", "is_phrase", "n_grams"]
    diagonals = hits.groupBy(*one, (F.col("at") - F.col("place")).alias("diagonal")).agg(
        F.collect_set("place").alias("places"),
        F.min("at").alias("first"),
        F.max(F.col("at") + F.size("gram") - 1).alias("last"),
    )
    along = Window.partitionBy("doc_id", "text_hash", "template").orderBy("diagonal")
    near = (F.col("diagonal") - F.lag("diagonal").over(along) <= MAX_DRIFT) & (
        F.col("first") <= F.max("last").over(along.rowsBetween(Window.unboundedPreceding, -1)) + MAX_DRIFT + 1
    )
    begins = F.when(F.col("is_phrase") | ~F.coalesce(near, F.lit(False)), 1).otherwise(0)
    groups = diagonals.withColumn("begins", begins).withColumn("cluster", F.sum("begins").over(along))
    merged = groups.groupBy(*one, "cluster").agg(
        F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
    )
    covered = F.size("places") / F.col("n_grams")
    return merged.where(covered >= LEAST_COVERED).select(
        "doc_id", "text_hash", "label", "is_phrase", F.col("first").cast("long"), F.col("last").cast("long"), covered.alias("covered")
    )


def scan(docs: DataFrame, phrases: dict[str, str] | None = None, notices: dict[str, str] | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    n_base counts the places of all phrases, first_word and last_word are their smallest and largest
    start; both label lists are distinct, sorted and comma-joined, empty if there are none. The score
    is the largest covered share of any template, 0 without one. Rows of equal id and text have equal
    results.
    """
    found, grams = places(docs, PHRASES if phrases is None else phrases, NOTICES if notices is None else notices)
    base = F.col("is_phrase")
    result = spans(found, grams).groupBy("doc_id", "text_hash").agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("first"))).alias("first_word"),
        F.max(F.when(base, F.col("first"))).alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set("label")), ",").alias("labels"),
        F.max("covered").alias("score"),
    )
    result = result.withColumnsRenamed({"doc_id": "__id", "text_hash": "__hash"})
    rows = found.where("first").select("doc_id", "text_hash", "n_words")  # one for each row of docs
    both = rows.join(result, rows.doc_id.eqNullSafe(F.col("__id")) & (rows.text_hash == F.col("__hash")), "left")
    return both.select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
