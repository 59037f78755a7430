"""Benchmark decontamination with a distributed positional inverted index.

The index is partitioned by documents: each row holds the postings of a block of
texts, every term with the sorted places where it stands. Blocks never depend on
one another, so building and searching the index shuffle no postings.

A phrase is looked up from its rarest term: its postings, moved back by the term's
offset in the phrase, are the places where the phrase may begin; they are
intersected with the moved postings of the other terms, rarest first. All windows
of all items are looked up in a block together. Rarity is counted over the whole
index.

Items are a stated query set. They are read in slices of bounded size, each of
which is searched in all blocks, so neither side is ever held whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.windows import binary_slices
from tidemark.llm.words import words_of
from tidemark.sources.storage import materialise, scratch_path

WINDOW = 13
# Text of the items that one search holds; more items take further passes over the index.
SLICE_BYTES = 8 << 20
# Text of a block, and index bytes that a reader or writer of the index holds at a time.
_BLOCK_BYTES, _ROW_GROUP_BYTES = 512 << 10, 16 << 20
# Candidate places that a search compares at a time.
_CANDIDATES = 1 << 19


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The positional index of all texts, written to the shared folder.

    One row per block: ``docs`` (id, text hash, number of words and first place of
    every text; NULL has no words), ``terms`` (sorted fingerprints), ``bounds`` and
    ``places`` (the postings, back to back). Places of two texts are never adjacent.
    """
    text = F.col(f"`{text_col}`").cast("string")
    source = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(text).alias("text_hash"),
        text.cast("binary").alias("bytes"),
    )
    id_type = source.schema["doc_id"].dataType.simpleString()
    index = source.mapInArrow(
        _index_batches,
        f"doc_id array<{id_type}>, text_hash array<bigint>, n_words array<int>, base array<int>, "
        "terms binary, bounds binary, places binary",
    )
    path = scratch_path(docs.sparkSession, "positional-index")
    # Rows are long: row groups are closed by bytes, looked at after every row.
    index.write.option("parquet.block.size", _ROW_GROUP_BYTES).option("parquet.page.size.row.check.min", 1).parquet(path)
    return docs.sparkSession.read.schema(index.schema).parquet(path)


def contamination(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, text_hash, n_words, n_hit, item_ids``.

    ``n_hit`` counts the words that lie inside an occurrence of ``window`` consecutive
    words of an item (all words of a shorter item); ``item_ids`` are the items with
    such occurrences, as sorted strings. Items without words match nothing; texts
    without words (NULL, empty) have 0 hits. Items that repeat an id are one item.
    """
    index = build_index(docs, id_col, text_col)
    runs = phrase_matches(index, items, item_id, item_text, window)
    text = ["doc_id", "text_hash"]
    before = Window.partitionBy(*text).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    hits = (
        runs.withColumn("from", F.greatest("start", F.coalesce(F.max("end").over(before), F.lit(0))))
        .groupBy(*text)
        .agg(
            F.sum(F.greatest(F.col("end") - F.col("from"), F.lit(0))).alias("n_hit"),
            F.array_sort(F.collect_set("item_id")).alias("item_ids"),
        )
        .withColumnsRenamed({"doc_id": "__doc", "text_hash": "__hash"})
    )
    rows = index.select(F.explode(F.arrays_zip("doc_id", "text_hash", "n_words")).alias("d")).select("d.*")
    return rows.join(
        hits, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("text_hash") == F.col("__hash")), "left"
    ).select(
        *text, F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
    )


def is_contaminated() -> F.Column:
    """At least one word in twenty is hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def phrase_matches(
    index: DataFrame, items: DataFrame, item_id: str = "item_id", item_text: str = "text", window: int = WINDOW
) -> DataFrame:
    """``(doc_id, text_hash, item_id, start, end)``: runs of words (from 0, end excluded)
    made of consecutive or overlapping occurrences of an item's windows, in step with it."""
    return _search(index, items, item_id, item_text, lambda words, counts: _phrase_search(words, counts, window))


def proximity_matches(
    index: DataFrame, items: DataFrame, item_id: str = "item_id", item_text: str = "text", slack: int = 5
) -> DataFrame:
    """Places where all distinct words of an item stand, in any order, within as many
    words plus ``slack``: ``(doc_id, text_hash, item_id, start, end)``, the shortest
    stretch from each word of the item that begins one."""
    return _search(index, items, item_id, item_text, lambda words, counts: _proximity_search(words, counts, slack))


def _search(index: DataFrame, items: DataFrame, item_id: str, item_text: str, searcher) -> DataFrame:
    spark = index.sparkSession
    stated = items.select(
        F.col(f"`{item_id}`").cast("string").alias("item_id"),
        F.col(f"`{item_text}`").cast("string").cast("binary").alias("bytes"),
    )
    total = stated.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    slices = -(-total // SLICE_BYTES) or 1
    id_type = index.schema["doc_id"].dataType.elementType.simpleString()
    schema = f"doc_id {id_type}, text_hash bigint, item_id string, start int, end int"
    found = spark.createDataFrame([], schema)
    for part in range(slices):
        rows = stated.filter(F.pmod(F.xxhash64("item_id", "bytes"), F.lit(slices)) == part).collect()
        if not rows:
            continue
        column = pa.array([r.bytes for r in rows], pa.binary())
        words = [
            marks[a:b]
            for _, _, data, offsets in binary_slices(column, whole=True)
            for marks, _, _, bounds in [words_of(data, offsets)]
            for a, b in zip(bounds[:-1], bounds[1:])
        ]
        terms = np.unique(np.concatenate(words)) if words else np.empty(0, np.uint64)
        counts = dict(
            index.select("terms", "bounds").mapInArrow(_term_counter(terms), "term bigint, n bigint")
            .groupBy("term").agg(F.sum("n")).collect()
        )
        frequency = np.array([counts.get(int(t), 0) for t in terms.view(np.int64)], np.int64)
        numbered = [np.searchsorted(terms, w) for w in words]
        search = searcher(numbered, frequency)
        names = [r.item_id for r in rows]
        found = found.unionByName(index.mapInArrow(_searching(search, terms, names), schema))
    return materialise(found, "phrase-matches")


def _index_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "text_hash", "n_words", "base", "terms", "bounds", "places"]
    for batch in batches:
        for row, _, data, offsets in binary_slices(batch.column("bytes"), _BLOCK_BYTES, whole=True):
            marks, _, _, words = words_of(data, offsets)
            n_words, rows = np.diff(words), len(offsets) - 1
            base = words[:-1] + np.arange(rows)
            places = np.arange(len(marks)) + np.repeat(np.arange(rows), n_words)
            order = np.argsort(marks, kind="stable")
            ordered = marks[order]
            first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(ordered) else order
            lists = [
                batch.column("doc_id").slice(row, rows), batch.column("text_hash").slice(row, rows),
                pa.array(n_words.astype(np.int32)), pa.array(base.astype(np.int32)),
            ]
            blobs = [
                ordered[first].tobytes(), np.append(first, len(ordered)).astype(np.int32).tobytes(),
                places[order].astype(np.int32).tobytes(),
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array([0, rows], pa.int32()), x) for x in lists]
                + [pa.array([x], pa.binary()) for x in blobs],
                names=names,
            )


def _term_counter(terms: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(terms), np.int64)
        for batch in batches:
            for own, bounds in zip(batch.column("terms"), batch.column("bounds")):
                own = np.frombuffer(own.as_buffer(), np.uint64)
                sizes = np.diff(np.frombuffer(bounds.as_buffer(), np.int32))
                _, at, to = np.intersect1d(own, terms, assume_unique=True, return_indices=True)
                total[to] += sizes[at]
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(terms[seen].view(np.int64)), pa.array(total[seen])], names=["term", "n"]
        )

    return run


class _Postings:
    """The postings of one block for the terms asked for, numbered as asked."""

    def __init__(self, terms: np.ndarray, own: np.ndarray, bounds: np.ndarray, places: np.ndarray):
        at = np.minimum(np.searchsorted(own, terms), max(0, len(own) - 1))
        known = own[at] == terms if len(own) else np.zeros(len(terms), bool)
        self.first = np.where(known, bounds[at] if len(own) else 0, 0)
        self.size = np.where(known, bounds[np.minimum(at + 1, len(bounds) - 1)] - self.first, 0)
        pick = np.repeat(self.first, self.size) + _ramp(self.size)
        self.start = np.cumsum(self.size) - self.size
        self.places = places[pick].astype(np.int64)
        # Sorted by term, then place: membership of any (term, place) is one search.
        self.keys = (np.repeat(np.arange(len(terms)), self.size) << 32) | self.places

    def holds(self, term: np.ndarray, place: np.ndarray) -> np.ndarray:
        wanted = (term << 32) | np.maximum(place, 0)
        at = np.searchsorted(self.keys, wanted)
        inside = (at < len(self.keys)) & (place >= 0)
        return inside & (self.keys[np.minimum(at, len(self.keys) - 1)] == wanted) if len(self.keys) else inside

    def of(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the given terms, with the number of the term's entry."""
        sizes = self.size[terms]
        return self.places[np.repeat(self.start[terms], sizes) + _ramp(sizes)], np.repeat(np.arange(len(terms)), sizes)


def _ramp(sizes: np.ndarray) -> np.ndarray:
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _searching(search, terms: np.ndarray, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                own, bounds, places = (
                    np.frombuffer(batch.column(c)[i].as_buffer(), kind)
                    for c, kind in (("terms", np.uint64), ("bounds", np.int32), ("places", np.int32))
                )
                item, start, end = search(_Postings(terms, own, bounds, places))
                base = batch.column("base")[i].values.to_numpy()
                doc = np.searchsorted(base, start, "right") - 1
                inside = np.searchsorted(base, end - 1, "right") - 1 == doc
                item, start, end, doc = item[inside], start[inside], end[inside], doc[inside]
                if not len(item):
                    continue
                source = pa.array(doc)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id")[i].values.take(source),
                        batch.column("text_hash")[i].values.take(source),
                        pa.array([names[j] for j in item], pa.string()),
                        pa.array((start - base[doc]).astype(np.int32)),
                        pa.array((end - base[doc]).astype(np.int32)),
                    ],
                    names=["doc_id", "text_hash", "item_id", "start", "end"],
                )

    return run


def _phrase_search(items: list[np.ndarray], frequency: np.ndarray, window: int):
    """All windows of all items, grouped by the rarest term they share."""
    item, offset, low, high, length = [], [], [], [], []
    for i, words in enumerate(items):
        if not len(words):
            continue
        size = min(window, len(words))
        rarity = frequency[words]
        views = np.lib.stride_tricks.sliding_window_view(rarity, size)
        if (views.min(axis=1) == 0).all():
            continue  # every window has a term that stands nowhere
        rarest = views.argmin(axis=1) + np.arange(len(views))
        head = np.flatnonzero(np.append(True, rarest[1:] != rarest[:-1]))
        tail = np.append(head[1:], len(views)) - 1
        item += [i] * len(head)
        offset += rarest[head].tolist()
        low += head.tolist()
        high += tail.tolist()
        length += [size] * len(head)
    item, offset, low, high, length = (np.array(x, np.int64) for x in (item, offset, low, high, length))
    flat = np.concatenate(items) if items else np.empty(0, np.int64)
    begin = np.cumsum([0] + [len(w) for w in items])[:-1][item] if len(item) else item
    # Offsets common to all windows of an entry, rarest first, without the anchor itself.
    steps = []
    for b, o, lo, hi, size in zip(begin, offset, low, high, length):
        shared = np.arange(hi, lo + size)
        shared = shared[shared != o]
        steps.append(shared[np.argsort(frequency[flat[b + shared]], kind="stable")])
    deepest = max(map(len, steps), default=0)
    order = np.full((len(steps), deepest), -1, np.int64)
    for i, s in enumerate(steps):
        order[i, : len(s)] = s

    def search(postings: _Postings):
        if not len(item):
            return item, item, item
        # Entries are taken in parts of a bounded number of candidates; a run cut
        # between two parts comes out as two.
        sizes = postings.size[flat[begin + offset]]
        entries = np.flatnonzero(sizes)
        part = (np.cumsum(sizes[entries]) - 1) // _CANDIDATES
        cuts = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else []
        found = [compare(postings, e) for e in np.split(entries, cuts[1:])] if len(part) else [(item[:0],) * 3]
        return tuple(np.concatenate(x) for x in zip(*found))

    def compare(postings: _Postings, entries: np.ndarray):
        place, entry = postings.of(flat[begin[entries] + offset[entries]])
        entry = entries[entry]
        align = place - offset[entry]
        for step in range(deepest):
            at = order[entry, step]
            keep = (at < 0) | postings.holds(flat[begin[entry] + np.maximum(at, 0)], align + at)
            align, entry = align[keep], entry[keep]
            if not len(entry):
                break
        # What is left is compared word by word over all windows of its entry.
        widths = high[entry] - low[entry] + length[entry]
        column = _ramp(widths)
        row = np.repeat(np.arange(len(entry)), widths)
        word = low[entry][row] + column
        equal = postings.holds(flat[begin[entry][row] + word], align[row] + word)
        sums = np.append(0, np.cumsum(equal))
        first = np.cumsum(widths) - widths
        n_windows = high[entry] - low[entry] + 1
        row = np.repeat(np.arange(len(entry)), n_windows)
        at = first[row] + _ramp(n_windows)
        full = sums[at + length[entry][row]] - sums[at] == length[entry][row]
        start = (align[row] + low[entry][row] + _ramp(n_windows))[full]
        row = row[full]
        size = length[entry][row]
        who, step_in = item[entry][row], align[row]
        # Windows that follow one another in the same alignment become one run.
        sort = np.lexsort((start, step_in, who))
        who, step_in, start, size = who[sort], step_in[sort], start[sort], size[sort]
        new = np.append(
            True, (who[1:] != who[:-1]) | (step_in[1:] != step_in[:-1]) | (start[1:] > start[:-1] + size[:-1])
        )[: len(who)]
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(who))[: len(head)] - 1
        return who[head], start[head], start[tail] + size[tail]

    return search


def _proximity_search(items: list[np.ndarray], frequency: np.ndarray, slack: int):
    distinct = [np.unique(words) for words in items]

    def search(postings: _Postings):
        found = []
        for i, words in enumerate(distinct):
            if not len(words) or (frequency[words] == 0).any():
                continue
            reach = len(words) + slack
            words = words[np.argsort(postings.size[words], kind="stable")]
            anchor, _ = postings.of(words[:1])
            if not len(anchor):
                continue
            lists = []
            for word in words:
                places, _ = postings.of(np.array([word]))
                at = np.searchsorted(anchor, places)
                gap = np.minimum(
                    np.abs(places - anchor[np.minimum(at, len(anchor) - 1)]),
                    np.abs(places - anchor[np.maximum(at - 1, 0)]),
                )
                lists.append(places[gap < reach])
            starts = np.unique(np.concatenate(lists))
            end = starts.copy()
            for places in lists:
                at = np.searchsorted(places, starts)
                end = np.maximum(end, np.append(places, 2**40)[at])
            near = end - starts < reach
            found.append((np.full(near.sum(), i), starts[near], end[near] + 1))
        if not found:
            none = np.empty(0, np.int64)
            return none, none, none
        return tuple(np.concatenate(x) for x in zip(*found))

    return search


ORACLE = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents
), b AS (
  SELECT item_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark
), win AS (
  SELECT DISTINCT item_id, n, list_aggregate(w[i : i + n - 1], 'string_agg', ' ') AS g
  FROM (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i
        FROM b WHERE len(w) > 0)
), sizes AS (
  SELECT DISTINCT n FROM win
), dw AS (
  SELECT doc_id, n, i, list_aggregate(w[i : i + n - 1], 'string_agg', ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)
), m AS (
  SELECT dw.doc_id, dw.i, dw.n, win.item_id FROM dw JOIN win USING (n, g)
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM m) GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""
