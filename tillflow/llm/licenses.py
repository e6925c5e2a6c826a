"""License notices: an exact set-similarity join of text blocks and templates, with DataFrame functions only."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.session import written

_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Words before A-Z become a-z.
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Most different words of all templates together; the index of their prefixes is broadcast.
VOCABULARY = 20_000


@dataclass(frozen=True)
class Template:
    """A notice; a block has it if it holds ``share`` of its different words.

    A ``phrase`` is held whole, with its words one after the other. ``base`` marks the phrases that every scan looks for.
    """

    label: str
    text: str
    share: float = 0.8
    phrase: bool = False
    base: bool = False

    @property
    def words(self) -> list[str]:
        return [w.lower() for w in re.findall("[A-Za-z0-9]+", self.text)]

    @property
    def least(self) -> int:
        """Different words that a block must share."""
        n = len(set(self.words))
        return n if self.phrase else math.ceil(round(self.share * n, 6))


# The phrases looked for by every scan, names of versions, and the first sentences of public notices.
TEMPLATES = [
    Template("mit", "mit license", phrase=True, base=True),
    Template("apache", "apache license", phrase=True, base=True),
    Template("gpl", "general public license", phrase=True, base=True),
    Template("agpl", "affero general public license", phrase=True),
    Template("apache-2.0", "apache license version 2 0", phrase=True),
    Template("bsd", "bsd license", phrase=True),
    Template("cc-by-4.0", "cc by 4 0", phrase=True),
    Template("cc-by-nc-4.0", "cc by nc 4 0", phrase=True),
    Template("cc-by-nc-sa-4.0", "cc by nc sa 4 0", phrase=True),
    Template("cc-by-sa-4.0", "cc by sa 4 0", phrase=True),
    Template("gpl-2.0", "general public license version 2", phrase=True),
    Template("gpl-3.0", "general public license version 3", phrase=True),
    Template("lgpl", "lesser general public license", phrase=True),
    Template("mpl-2.0", "mozilla public license v 2 0", phrase=True),
    Template("apache-notice", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    Template("bsd-notice", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    Template("gpl-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    Template("isc-notice", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    Template("mit-notice", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    Template("unlicense-notice", "This is free and unencumbered software released into the public domain"),
]


def stride(templates: Sequence[Template]) -> int:
    """Words from one block to the next; a block has twice as many, so that it holds every run of that length whole."""
    return max(len(t.words) for t in templates)


def _lower(word: Column) -> Column:
    return F.translate(word, _LETTERS, _LETTERS.lower())


def _known(words: Column, of: list[str]) -> Column:
    """Those of the words, still in both cases, that are in a list; a hash look-up for each."""
    # lower() is fast but takes some letters outside of ASCII into it, so what it finds is looked at again.
    return F.filter(words, lambda w: F.lower(w).isin(of) & _lower(w).isin(of))


def frequency_order(words: DataFrame, vocabulary: list[str]) -> list[str]:
    """The vocabulary from its rarest word in the whole corpus to its most frequent one.

    ``words`` has the array column ``raw``. At most one row for each word of the vocabulary reaches the driver.
    """
    met = words.select(F.explode(_known(F.col("raw"), vocabulary)).alias("word")).select(_lower(F.col("word")).alias("word"))
    counts = {r["word"]: r["count"] for r in met.groupBy("word").count().collect()}
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def _table(df: DataFrame, rows: list[dict], schema: str) -> DataFrame:
    """A small table of constants, as an expression."""
    return df.sparkSession.range(0, 1, 1, 1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")))


def _prefix(template: Template, rank: dict[str, int]) -> tuple[list[int], int]:
    """The ranks of a template's words, rarest first, and how many of them a similar block must share one of."""
    ranks = sorted({rank[w] for w in template.words})
    return ranks, len(ranks) - template.least + 1


def find_notices(docs: DataFrame, templates: Sequence[Template] = TEMPLATES) -> tuple[DataFrame, DataFrame]:
    """All pairs of a text block and a template that it holds, and the documents they lie in.

    Words are runs of letters and digits, A-Z lower-cased. A block is a run of twice :func:`stride` words; one begins at
    every multiple of it (a text's last ones are shorter). Blocks and templates are sets of words, ordered by how rare a
    word is in the whole corpus. A block that shares ``least`` of a template's ``n`` words shares one of its ``n - least
    + 1`` rarest, the prefix, so only blocks with a word of a prefix are written out and joined to the index of prefixes
    on these words. A pair is taken at its first common word alone, if what follows that word on both sides (the
    positional filter) and the sizes allow for ``least`` common words, which are then counted. For a phrase the places
    where its words follow each other are looked up; those that start in a block's first half are the block's own.

    Returns the pairs, ``row, label, base, first_word, n_common, n, places`` (words from 0), and the documents, ``row,
    doc_id, n_words``. A null text is empty and has no blocks. Repeated rows are documents of their own; other columns are
    ignored; an empty table gives none. Texts are read twice and don't move; what moves is bounded by the blocks with a
    prefix word. Templates are parameters: their words, at most ``VOCABULARY``, and the index of prefixes are broadcast.
    """
    step = stride(templates)
    vocabulary = sorted({w for t in templates for w in t.words})
    if len(vocabulary) > VOCABULARY:
        raise ValueError(f"the templates have {len(vocabulary)} words, more than {VOCABULARY}")
    raw = F.regexp_extract_all(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(_WORD), F.lit(0))
    words = docs.select("doc_id", raw.alias("raw"))
    order = frequency_order(words, vocabulary)
    rank = {w: i for i, w in enumerate(order)}

    index = []
    for number, t in enumerate(templates):
        ranks, n = _prefix(t, rank)
        for i, r in enumerate(ranks[:n]):
            entry = {"rank": r, "template": number, "label": t.label, "base": t.base, "place": i, "of": ranks, "least": t.least}
            index.append(entry | {"phrase": t.words if t.phrase else None})
    first = [order[r] for r in sorted({e["rank"] for e in index})]

    rare = F.transform("raw", lambda w, i: F.when(F.lower(w).isin(first) & _lower(w).isin(first), i.cast("long")))
    near = F.flatten(F.transform(F.filter(rare, lambda i: i.isNotNull()), lambda i: F.array(F.floor(i / step), F.greatest(F.floor(i / step) - 1, F.lit(0)))))
    block = lambda b: F.struct((b * step).alias("first_word"), F.transform(F.slice("raw", (b * step + 1).cast("int"), 2 * step), _lower).alias("words"))
    rows = words.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.size("raw").cast("long").alias("n_words"),
        F.transform(F.array_distinct(near), block).alias("blocks"),
    )
    rows = written(rows)

    blocks = rows.select("row", F.explode("blocks").alias("block")).select("row", "block.*")
    all_words = F.array(*map(F.lit, order))
    ranks = F.transform(F.array_distinct(F.filter("words", lambda w: w.isin(vocabulary))), lambda w: F.array_position(all_words, w).cast("int") - 1)
    blocks = blocks.withColumn("ranks", F.array_sort(ranks))
    met = blocks.select("row", "first_word", "words", "ranks", F.posexplode("ranks").alias("at", "rank"))
    known = _table(docs, index, "rank int, template int, label string, base boolean, place int, of array<int>, least int, phrase array<string>")
    pairs = met.join(F.broadcast(known), "rank").where(
        (F.size("ranks") >= F.col("least"))
        & (F.size("ranks") - F.col("at") >= F.col("least"))
        & (F.size("of") - F.col("place") >= F.col("least"))
        # The first word in common; with a later one the pair comes again.
        & ~F.arrays_overlap(F.slice("of", F.lit(1), F.col("place")), F.slice("ranks", F.lit(1), F.col("at")))
    )
    common = F.size(F.array_intersect("of", "ranks")).alias("n_common")
    follows = lambda p: F.slice("words", p + 1, F.size("phrase")) == F.col("phrase")
    own = F.filter(F.sequence(F.lit(0), F.least(F.size("words"), F.lit(step)) - 1), follows)
    places = F.when(F.col("phrase").isNotNull(), F.transform(own, lambda p: p + F.col("first_word"))).alias("places")
    pairs = pairs.select("row", "label", "base", "first_word", common, F.size("of").alias("n"), "least", places).where(
        (F.col("n_common") >= F.col("least")) & (F.col("places").isNull() | (F.size("places") > 0))
    )
    return pairs.drop("least"), rows.select("row", "doc_id", "n_words")


def scan(docs: DataFrame, templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """What :func:`find_notices` finds, for every row of ``docs``.

    Returns ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``: the places of base phrases,
    the smallest and the largest start among them (else null), the labels of base phrases and all labels (distinct,
    sorted, joined by commas), and the largest share of a template's words that a block holds, 0 without any.
    """
    pairs, rows = find_notices(docs, templates)
    of_base = F.when(F.col("base"), F.col("places"))
    found = pairs.groupBy("row").agg(
        F.sum(F.size(F.coalesce(of_base, F.array().cast("array<bigint>"))).cast("long")).alias("n_base"),
        F.min(F.array_min(of_base)).alias("first_word"),
        F.max(F.array_max(of_base)).alias("last_word"),
        # Bounded by the templates.
        F.collect_set(F.when(F.col("base"), F.col("label"))).alias("base_labels"),
        F.collect_set("label").alias("labels"),
        F.max(F.col("n_common") / F.col("n")).alias("score"),
    )
    joined = lambda c: F.coalesce(F.array_join(F.array_sort(c), ","), F.lit("")).alias(c)
    return rows.join(found, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        joined("base_labels"), joined("labels"), F.coalesce("score", F.lit(0.0)).alias("score"),
    )
