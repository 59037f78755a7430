"""License scan as an exact set-similarity join of text blocks with license templates.

Blocks are the lines of a text and all its windows of as many words as the longest
template has, across line breaks; templates are short license notices; both are sets of
words. A template is found in a block that holds at least a share ``containment`` of
its words. Words are ordered by their number of lines, rarest first, counted over
the whole table, and

* prefix filter: a block with ``need`` of a template's ``n`` words has one of its
  ``n - need + 1`` rarest; only blocks with such a word are looked at;
* length filter: a block needs at least ``need`` of the templates' words;
* positional filter: where a shared word stands at place ``i`` of the template and
  ``j`` of the block's ``m`` template words, ``min(i, j) + min(n - i, m - j)`` words
  are shared at most.

What passes is compared exactly. Blocks travel as lists of template words only. Windows
slide over the words near those of the prefixes, and of each text only one travels for
each template: the first that shares most with it.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.storage import materialise

CONTAINMENT = 0.8
# Templates are sent with the tasks; a larger set has to be scanned for in parts.
TEMPLATE_BYTES = 4 << 20

# The phrases and labels that are looked for word by word.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Opening words of the licenses' own notices.
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction"),
    ("mit", "Released under the MIT License"),
    ("apache-2", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance "
                 "with the License"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("gpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
              "General Public License as published by the Free Software Foundation, either version 3"),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
)

# Words: lower-cased ASCII letters, digits and everything beyond ASCII.
_SPACED = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)
_LINES = bytes(0x0A if b == 0x0A else _SPACED[b] for b in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(_SPACED).split()


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, phrases=PHRASES,
    containment: float = CONTAINMENT,
) -> DataFrame:
    """One row per row of ``docs``: places of the phrases and labels of phrases and templates.

    ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``;
    ``score`` is the largest share of a template found in a block, 1 where a phrase
    stands. NULL and empty texts have no words, no labels and score 0; rows that
    repeat are scanned alike.
    """
    sets = sorted({(label, tuple(sorted(set(words(text.encode()))))) for label, text in templates})
    sets = [s for s in sets if s[1]]
    if sum(len(w) for _, s in sets for w in s) > TEMPLATE_BYTES:
        raise ValueError("more templates than one scan holds; scan for parts of them and unite the labels")
    vocabulary = sorted({w for _, s in sets for w in s})
    needs = [_need(len(s), containment) for _, s in sets]
    text = F.col(f"`{text_col}`").cast("string")
    source = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.cast("binary").alias("bytes")
    )
    counted = (
        source.select("bytes").mapInArrow(_frequencies(vocabulary), "word int, n bigint")
        .groupBy("word").agg(F.sum("n").alias("n")).collect()
    )
    frequency = {r.word: r.n for r in counted}
    order = sorted(range(len(vocabulary)), key=lambda w: (frequency.get(w, 0), vocabulary[w]))
    # Words are numbered by rarity from here on, so sorted lists are in the global order.
    rank = {vocabulary[w]: i for i, w in enumerate(order)}
    ordered = [sorted(rank[w] for w in s) for _, s in sets]
    prefix = {s[i] for s, need in zip(ordered, needs) for i in range(len(s) - need + 1)}
    width = max((len(words(text.encode())) for _, text in templates), default=1)

    id_type = source.schema["doc_id"].dataType.simpleString()
    scanned = materialise(
        source.mapInArrow(
            _blocks(rank, prefix, list(zip(ordered, needs)), width, dict(phrases)),
            f"doc_id {id_type}, text_hash bigint, n_words bigint, n_base bigint, first_word bigint, "
            "last_word bigint, base_labels array<string>, blocks array<array<int>>",
        ),
        "license-blocks",
    )
    spark = docs.sparkSession
    table = spark.createDataFrame(
        [(i, label, s, len(s), need) for i, ((label, _), s, need) in enumerate(zip(sets, ordered, needs))],
        "template int, label string, words array<int>, size int, need int",
    )
    starts = table.select("*", F.posexplode("words").alias("i", "word")).filter("i <= size - need")
    blocks = scanned.filter(F.size("blocks") > 0).select(
        "doc_id", "text_hash", F.explode(F.array_distinct("blocks")).alias("block")
    )
    candidates = (
        blocks.select("*", F.posexplode("block").alias("j", "word"))
        .join(F.broadcast(starts), "word")
        .filter(F.expr("size(block) >= need AND least(i, j) + least(size - i, size(block) - j) >= need"))
    )
    found = (
        candidates.select("doc_id", "text_hash", "label", "block", "words", "size", "need").distinct()
        .withColumn("shared", F.size(F.array_intersect("block", "words")))
        .filter("shared >= need")
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set("label").alias("found"), F.max(F.col("shared") / F.col("size")).alias("best"))
        .withColumnsRenamed({"doc_id": "__doc", "text_hash": "__hash"})
    )
    joined = scanned.drop("blocks").join(
        found, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("text_hash") == F.col("__hash")), "left"
    )
    none = F.array().cast("array<string>")
    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("base_labels"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base_labels", F.coalesce("found", none))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )


def _need(size: int, containment: float) -> int:
    return max(1, -int(-(containment * size - 1e-9) // 1))


def _frequencies(vocabulary: list[bytes]):
    """Lines that hold each template word."""
    number = {w: i for i, w in enumerate(vocabulary)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for text in batch.column("bytes"):
                if text.is_valid:
                    for line in text.as_py().translate(_LINES).split(b"\n"):
                        total.update(number.keys() & line.split())
        yield pa.RecordBatch.from_arrays(
            [pa.array([number[w] for w in total], pa.int32()), pa.array(list(total.values()), pa.int64())],
            names=["word", "n"],
        )

    return run


def _windows(own: list[bytes], rank: dict[bytes, int], prefix: set[int], ordered: list, width: int) -> list[list[int]]:
    """For each template (words, need) that a window of ``width`` words holds, the first of those that share most."""
    templates_of: dict[int, list[int]] = {}
    for t, (held, _) in enumerate(ordered):
        for w in held:
            templates_of.setdefault(w, []).append(t)
    needs = [need for _, need in ordered]
    places = [(i, rank[w]) for i, w in enumerate(own) if w in rank]
    marks = [i for i, w in places if w in prefix]
    # Only words within a window's reach of a prefix word.
    after = [bisect_left(marks, i) for i, _ in places]
    places = [
        (i, w) for (i, w), k in zip(places, after)
        if (k < len(marks) and marks[k] - i < width) or (k and i - marks[k - 1] < width)
    ]
    best: dict[int, int] = {}
    blocks: dict[int, list[int]] = {}
    count: Counter = Counter()
    shared, first = [0] * len(ordered), 0
    for i, word in places:
        count[word] += 1
        if count[word] == 1:
            for t in templates_of[word]:
                shared[t] += 1
        while places[first][0] <= i - width:
            gone = places[first][1]
            count[gone] -= 1
            if not count[gone]:
                del count[gone]
                for t in templates_of[gone]:
                    shared[t] -= 1
            first += 1
        for t in templates_of[word]:
            if shared[t] >= needs[t] and shared[t] > best.get(t, 0):
                best[t], blocks[t] = shared[t], sorted(count)
    return [blocks[t] for t in sorted(blocks)]


def _blocks(rank: dict[bytes, int], prefix: set[int], ordered: list, width: int, phrases: dict[str, str]):
    names = ["doc_id", "text_hash", "n_words", "n_base", "first_word", "last_word", "base_labels", "blocks"]
    patterns = [(re.compile(b"(?= %s )" % p.encode()), label) for p, label in phrases.items()]
    rare = {w for w, i in rank.items() if i in prefix}
    least = min((need for _, need in ordered), default=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column("bytes"):
                text = value.as_py().translate(_LINES) if value.is_valid else b""
                own = text.split()
                joined = b" %s " % b" ".join(own)
                places, labels = [], set()
                for pattern, label in patterns:
                    found = [joined.count(b" ", 0, m.start()) for m in pattern.finditer(joined)]
                    if found:
                        places += found
                        labels.add(label)
                blocks = []
                for line in text.split(b"\n") if not rare.isdisjoint(own) else ():
                    held = rank.keys() & line.split()
                    if len(held) >= least and not rare.isdisjoint(held):
                        blocks.append(sorted(rank[w] for w in held))
                if not rare.isdisjoint(own):
                    blocks += _windows(own, rank, prefix, ordered, width)
                rows.append((
                    len(own), len(places), min(places, default=None), max(places, default=None),
                    sorted(labels), blocks,
                ))
            kinds = [*[pa.int64()] * 4, pa.list_(pa.string()), pa.list_(pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash")]
                + [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)],
                names=names,
            )

    return run
