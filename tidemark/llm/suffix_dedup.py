"""Repeated substrings across a corpus, by previous and next smaller positions.

Let all suffixes of all texts be ordered so that suffixes with the same first
``min_bytes`` bytes stand side by side, and by position among themselves. Within
such a run the previous smaller position of a suffix is the place just before it
and the next smaller ones follow it, so

* its longest previous factor reaches ``min_bytes`` exactly when the run holds an
  earlier position: a later copy, removed when ``keep_first`` is set;
* it is repeated at all exactly when the run holds any other position.

Only these runs matter, so suffixes are compared at ``min_bytes`` bytes through
fingerprints instead of being sorted to their ends, and most are never compared:

1. Every window of ``min_bytes`` bytes is assigned to its *anchor*, the gram with
   the smallest fingerprint inside it. Equal windows have equal anchors at the
   same place, so only texts sharing an anchor can share a window. An anchor with
   the span of its windows is one row per ~``min_bytes / 2`` bytes of text.
2. Spans are counted per anchor gram (with partial sums). A gram met once has no
   repeated window. A span met twice with all its bytes is repeated as a whole,
   which settles exact copies and the inside of shared passages, however often
   they occur.
3. Where a gram has several different spans, the bytes of one span of each kind
   are gathered by gram, ordered, and their windows compared one by one. A gram
   with very many kinds is dealt over several tasks by the windows' fingerprints;
   each task reads the group's rows as a stream and keeps its share only.

Shorter passages can be reported beside the cut. They are looked for first; a longer
repeated string lies inside one of them, so the rest of the texts need not be looked at
for it.

No step holds a group of copies together, and no text meets another one directly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.windows import binary_slices, fingerprints, minimizers
from tidemark.sources.storage import materialise, owned_scratch, scratch_path

# Kinds of span of one gram that one task compares; more are dealt over several.
KINDS_PER_TASK = 20_000
# Windows gathered before a task compares the complete grams it holds.
_FLUSH = 1_000_000


def repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    min_bytes: int = 400, keep_first: bool = True,
) -> DataFrame:
    """Byte ranges of each text that repeat elsewhere.

    One row ``(doc_id, text_hash, spans)`` per text with any, ``spans`` being an
    unordered list of ``(start, end)`` that may overlap. With ``keep_first`` the
    windows at the smallest (doc_id, position) are left out; rows equal in both
    id and text cannot be told apart and are then all first. NULL and texts
    shorter than ``min_bytes`` have no span. Matches never cross texts.
    """
    return _repeated(_keyed(docs, id_col, text_col), min_bytes, keep_first)


def nested_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_bytes: int = 400, passage_bytes: int = 240,
) -> DataFrame:
    """:func:`repeated_spans` without ``keep_first`` by two lengths, of which ``passage_bytes`` is the smaller.

    One row ``(doc_id, text_hash, spans, passages)`` per text with any passage; ``spans`` is NULL where none
    reaches ``min_bytes``.
    """
    if passage_bytes > min_bytes:
        raise ValueError("passages must not be longer than min_bytes")
    keyed = _keyed(docs, id_col, text_col)
    # What a phase has written goes with it; only its result stays for the next one.
    passages = _kept(lambda: _repeated(keyed, passage_bytes, False), docs.sparkSession, "dedup-passages")
    return _kept(lambda: _nested(keyed, passages, min_bytes), docs.sparkSession, "dedup-nested")


def _kept(made: Callable[[], DataFrame], spark: SparkSession, purpose: str) -> DataFrame:
    path = scratch_path(spark, purpose)
    with owned_scratch(spark):
        rows = made()
        rows.write.mode("errorifexists").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _nested(keyed: DataFrame, passages: DataFrame, min_bytes: int) -> DataFrame:
    """Ranges that repeat at ``min_bytes``, looked for inside ``passages`` alone, beside these."""
    wanted = passages.select(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash"), "spans")
    pieces = materialise(
        keyed.join(
            wanted.hint("merge"), F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("text_hash") == F.col("__hash"))
        ).select("doc_id", "text_hash", "bytes", "spans").mapInArrow(
            _piece_batches(min_bytes),
            T.StructType([
                T.StructField("doc_id", keyed.schema["doc_id"].dataType), T.StructField("whole", T.LongType()),
                T.StructField("at", T.IntegerType()), T.StructField("bytes", T.BinaryType()),
            ]),
        ).withColumn("text_hash", F.xxhash64("whole", "at")),
        "dedup-pieces",
    )
    found = _repeated(pieces.select("doc_id", "text_hash", "bytes"), min_bytes, False)
    places = pieces.select(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash"), "whole", "at").distinct()
    spans = found.join(
        places.hint("merge"), F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("text_hash") == F.col("__hash"))
    ).select(
        "doc_id", F.col("whole").alias("text_hash"),
        F.transform(
            "spans", lambda x: F.struct((x.start + F.col("at")).alias("start"), (x.end + F.col("at")).alias("end"))
        ).alias("spans"),
    )
    none = F.lit(None).cast(passages.schema["spans"].dataType)
    return (
        spans.withColumn("passages", none)
        .unionByName(passages.select("doc_id", "text_hash", none.alias("spans"), F.col("spans").alias("passages")))
        .groupBy("doc_id", "text_hash").agg(
            F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("passages")).alias("passages")
        )
        .withColumn("spans", F.when(F.size("spans") > 0, F.col("spans")))
    )


def _repeated(keyed: DataFrame, min_bytes: int, keep_first: bool) -> DataFrame:
    id_type = keyed.schema["doc_id"].dataType
    anchors = materialise(
        keyed.mapInArrow(
            _anchor_batches(min_bytes),
            T.StructType([
                T.StructField("doc_id", id_type), T.StructField("text_hash", T.LongType()),
                T.StructField("gram", T.LongType()), T.StructField("span", T.LongType()),
                T.StructField("anchor", T.IntegerType()), T.StructField("first", T.IntegerType()),
                T.StructField("last", T.IntegerType()),
            ]),
        ),
        "dedup-anchors",
    )
    place = F.struct("doc_id", "text_hash", "anchor")
    kinds = anchors.groupBy("gram", "span").agg(F.count("*").alias("n"), F.min(place).alias("earliest"))
    grams = (
        kinds.groupBy("gram").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
        .filter("total > 1").drop("total")
    )
    is_first = F.col("earliest").eqNullSafe(place)
    marked = materialise(
        anchors.join(kinds.join(grams, "gram"), ["gram", "span"])
        .withColumn("compared", (F.col("kinds") > 1) & ((F.col("n") == 1) | is_first))
        .withColumn("whole", (F.col("n") > 1) & (F.lit(not keep_first) | ~is_first))
        .filter("compared OR whole")
        .select("doc_id", "text_hash", "gram", "kinds", "anchor", "first", "last", "compared", "whole"),
        "dedup-marked",
    )
    wholes = marked.filter("whole").select(
        "doc_id", "text_hash", F.col("first").alias("start"), (F.col("last") + min_bytes).alias("end")
    )
    found = wholes.unionByName(_compared(keyed, marked.filter("compared"), min_bytes, keep_first))
    return found.groupBy("doc_id", "text_hash").agg(
        F.collect_list(F.struct("start", "end")).alias("spans")
    )


def without_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    min_bytes: int = 400, keep_first: bool = True, passage_bytes: int | None = None,
) -> DataFrame:
    """All rows of ``docs``, with what is left of their texts.

    Columns of ``docs`` stay, with ``text_col`` shortened; ``dedup_bytes``,
    ``dedup_removed``, ``dedup_spans`` and ``dedup_sha256`` (of the remaining
    bytes) are added and replace columns of these names. A cut inside a character
    also drops the rest of that character from the text, not from the digest.
    NULL stays NULL, and counts as empty in the figures.

    With ``passage_bytes``, a smaller length that goes without ``keep_first`` only, ``dedup_passages`` follows:
    how many bytes of the text lie in passages of at least that length which stand anywhere else. These are
    not removed unless they reach ``min_bytes``.
    """
    if passage_bytes is not None and keep_first:
        raise ValueError("passages are reported at all their places, so keep_first must be unset")
    added = ["dedup_bytes", "dedup_removed", "dedup_spans", "dedup_sha256", "dedup_passages"]
    docs = docs.drop(*added, "__doc", "__hash", "__spans", "__passages")
    if passage_bytes is None:
        found = materialise(repeated_spans(docs, id_col, text_col, min_bytes, keep_first), "dedup-spans")
        found = found.withColumn("passages", F.lit(None).cast(found.schema["spans"].dataType))
    else:
        found = nested_spans(docs, id_col, text_col, min_bytes, passage_bytes)
    found = found.select(
        F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash"), F.col("spans").alias("__spans"),
        F.col("passages").alias("__passages"),
    )
    # Both sides grow with the texts: joined the same way at every size.
    joined = docs.join(
        found.hint("merge"),
        F.col(f"`{id_col}`").eqNullSafe(F.col("__doc"))
        & (F.xxhash64(F.col(f"`{text_col}`").cast("string")) == F.col("__hash")),
        "left",
    ).drop("__doc", "__hash")
    schema = T.StructType([
        *docs.schema.fields, T.StructField("dedup_bytes", T.LongType()),
        T.StructField("dedup_removed", T.LongType()), T.StructField("dedup_spans", T.LongType()),
        T.StructField("dedup_sha256", T.StringType()), T.StructField("dedup_passages", T.LongType()),
    ])
    cut = joined.mapInArrow(_cutter(docs.columns.index(text_col)), schema)
    return cut.drop("dedup_passages") if passage_bytes is None else cut


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(f"`{text_col}`").cast("string")
    return docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(text).alias("text_hash"),
        text.cast("binary").alias("bytes"),
    )


def _gram_length(min_bytes: int) -> int:
    return max(1, min(64, min_bytes // 2))


def _anchor_batches(min_bytes: int):
    gram = _gram_length(min_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, at, data, offsets in binary_slices(batch.column("bytes"), overlap=min_bytes - 1):
                windows = fingerprints(data, min_bytes)
                owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
                starts = np.arange(len(windows))
                starts = starts[starts + min_bytes <= offsets[1:][owner[: len(windows)]]]
                if not len(starts):
                    continue
                grams = fingerprints(data, gram, seed=1)
                chosen = minimizers(grams, min_bytes - gram + 1)[starts]
                new = np.empty(len(starts), bool)
                new[0] = True
                new[1:] = (chosen[1:] != chosen[:-1]) | (owner[starts[1:]] != owner[starts[:-1]])
                head = np.flatnonzero(new)
                tail = np.append(head[1:], len(starts)) - 1
                first, last, anchor = starts[head], starts[tail], chosen[head]
                span = windows[first] * np.uint64(3) + windows[last]
                span ^= (anchor - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                span ^= (last - first).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
                rows = owner[first]
                shift = at - offsets[rows]
                source = pa.array(rows + row)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(source), batch.column("text_hash").take(source),
                        pa.array(grams[anchor].view(np.int64)), pa.array(span.view(np.int64)),
                        *(pa.array((x + shift).astype(np.int32)) for x in (anchor, first, last)),
                    ],
                    names=["doc_id", "text_hash", "gram", "span", "anchor", "first", "last"],
                )

    return run


def _compared(keyed: DataFrame, spans: DataFrame, min_bytes: int, keep_first: bool) -> DataFrame:
    """Repeated windows of grams with several kinds of span."""
    per_text = materialise(
        spans.groupBy("doc_id", "text_hash").agg(
            F.collect_list(F.struct("gram", "kinds", "first", "last")).alias("spans")
        ),
        "dedup-compared",
    )
    wanted = per_text.select(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash"), "spans")
    id_field = T.StructField("doc_id", keyed.schema["doc_id"].dataType)
    contexts = keyed.join(
        wanted.hint("merge"),
        F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("text_hash") == F.col("__hash")),
    ).select("doc_id", "text_hash", "bytes", "spans").mapInArrow(
        _context_batches(min_bytes),
        T.StructType([
            id_field, T.StructField("text_hash", T.LongType()), T.StructField("gram", T.LongType()),
            T.StructField("parts", T.IntegerType()), T.StructField("first", T.IntegerType()),
            T.StructField("context", T.BinaryType()),
        ]),
    )
    dealt = contexts.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return (
        dealt.repartition("gram", "part").sortWithinPartitions("gram", "part")
        .mapInArrow(
            _run_batches(min_bytes, keep_first),
            T.StructType([
                id_field, T.StructField("text_hash", T.LongType()),
                T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
            ]),
        )
    )


def _context_batches(min_bytes: int):
    names = ["doc_id", "text_hash", "gram", "parts", "first", "context"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(batch.column("bytes")):
                text, spans = text.as_buffer(), batch.column("spans")[i].values
                fields = {f.name: spans.field(f.name) for f in spans.type}
                first, last = (fields[k].to_numpy(zero_copy_only=False) for k in ("first", "last"))
                kinds = fields["kinds"].to_numpy(zero_copy_only=False)
                view = memoryview(text)
                source = pa.array(np.full(len(first), i))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(source), batch.column("text_hash").take(source),
                        fields["gram"], pa.array((-(-kinds // KINDS_PER_TASK)).astype(np.int32)),
                        fields["first"],
                        pa.array(
                            [bytes(view[a : b + min_bytes]) for a, b in zip(first, last)], pa.binary()
                        ),
                    ],
                    names=names,
                )

    return run


def _piece_batches(min_bytes: int, budget: int = 1 << 22):
    """The spans of each text, joined where they meet, as texts of their own; shorter ones hold no window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            source, at, pieces, size = [], [], [], 0
            for i, text in enumerate(batch.column("bytes")):
                view = memoryview(text.as_buffer())
                for start, end in _merged(batch.column("spans")[i].values):
                    if end - start >= min_bytes:
                        source.append(i)
                        at.append(start)
                        pieces.append(bytes(view[start:end]))
                        size += end - start
                if source and (size >= budget or i == batch.num_rows - 1):
                    rows = pa.array(source)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("doc_id").take(rows), batch.column("text_hash").take(rows),
                            pa.array(at, pa.int32()), pa.array(pieces, pa.binary()),
                        ],
                        names=["doc_id", "whole", "at", "bytes"],
                    )
                    source, at, pieces, size = [], [], [], 0

    return run


def _run_batches(min_bytes: int, keep_first: bool):
    """Compares the windows of the contexts of a partition, which come gram by gram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict[str, np.ndarray]] = []
        tables: list[pa.RecordBatch] = []
        rows = size = 0
        for batch in batches:
            group = batch.column("gram").to_numpy(zero_copy_only=False)
            part = batch.column("part").to_numpy(zero_copy_only=False)
            parts = batch.column("parts").to_numpy(zero_copy_only=False)
            first = batch.column("first").to_numpy(zero_copy_only=False)
            tables.append(batch.select(["doc_id", "text_hash"]))
            for row, _, data, offsets in binary_slices(batch.column("context"), 1 << 19):
                windows = fingerprints(data, min_bytes)
                owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(windows)]
                at = np.arange(len(windows))
                keep = at + min_bytes <= offsets[1:][owner]
                source = owner + row
                many = parts[source] > 1
                keep &= ~many | (windows % parts[source].astype(np.uint64) == part[source].astype(np.uint64))
                keep = np.flatnonzero(keep)
                source = source[keep]
                held.append({
                    "window": windows[keep], "gram": group[source], "part": part[source],
                    "row": source + rows, "start": first[source] + at[keep] - offsets[owner[keep]],
                })
                size += len(keep)
            rows += batch.num_rows
            # The last gram of the batch may go on in the next one.
            if size >= _FLUSH and (group[0] != group[-1] or part[0] != part[-1]):
                joined = {k: np.concatenate([h[k] for h in held]) for k in held[0]}
                table = pa.Table.from_batches(tables)
                open_ = (joined["gram"] == group[-1]) & (joined["part"] == part[-1])
                yield from _found(table, {k: v[~open_] for k, v in joined.items()}, min_bytes, keep_first)
                left = {k: v[open_] for k, v in joined.items()}
                used, left["row"] = np.unique(left["row"], return_inverse=True)
                tables = table.take(pa.array(used)).combine_chunks().to_batches()
                held, size, rows = [left], len(left["row"]), len(used)
        if held:
            joined = {k: np.concatenate([h[k] for h in held]) for k in held[0]}
            yield from _found(pa.Table.from_batches(tables), joined, min_bytes, keep_first)

    return run


def _found(table: pa.Table, w: dict[str, np.ndarray], min_bytes: int, keep_first: bool):
    """The windows with another (earlier) place in their run, as ranges of their rows."""
    rank = _place_ranks(table)
    order = np.lexsort((w["start"], rank[w["row"]], w["gram"], w["window"]))
    window, gram, row, start = (w[k][order] for k in ("window", "gram", "row", "start"))
    same = (window[1:] == window[:-1]) & (gram[1:] == gram[:-1])
    has_previous = np.append(False, same)
    repeated = has_previous if keep_first else has_previous | np.append(same, False)
    row, start = row[repeated], start[repeated]
    if not len(row):
        return
    order = np.lexsort((start, row))
    row, start = row[order], start[order]
    new = np.append(True, (row[1:] != row[:-1]) | (start[1:] > start[:-1] + min_bytes))
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(row)) - 1
    picked = table.take(pa.array(row[head]))
    yield pa.RecordBatch.from_arrays(
        [
            *(c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in picked.columns),
            pa.array(start[head].astype(np.int32)),
            pa.array((start[tail] + min_bytes).astype(np.int32)),
        ],
        names=["doc_id", "text_hash", "start", "end"],
    )


def _place_ranks(table: pa.Table) -> np.ndarray:
    """Rank of each row's text by (doc_id, text_hash), NULL ids first as in Spark; rows of one text share it."""
    order = pc.sort_indices(
        table, [("doc_id", "ascending"), ("text_hash", "ascending")], null_placement="at_start"
    ).to_numpy()
    ids = table.column("doc_id").combine_chunks().dictionary_encode(null_encoding="encode")
    same_id = ids.indices.to_numpy(zero_copy_only=False)[order]
    text = table.column("text_hash").to_numpy()[order]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(np.append(False, (same_id[1:] != same_id[:-1]) | (text[1:] != text[:-1])))
    return rank


def _cutter(text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, sizes, removed, runs, digests, repeated = [], [], [], [], [], []
            lists = (batch.column(batch.num_columns + k) for k in (-2, -1))
            for value, spans, passages in zip(batch.column(text_at), *lists):
                text = value.as_py()
                data = (text or "").encode("utf-8", "surrogatepass")
                kept, cut = data, []
                if spans.is_valid:
                    cut = _merged(spans.values)
                    ends = np.append([0], [e for _, e in cut])
                    begins = np.append([s for s, _ in cut], len(data))
                    pieces = [data[a:b] for a, b in zip(ends, begins)]
                    kept = b"".join(pieces)
                    text = "".join(p.decode("utf-8", "ignore") for p in pieces)
                texts.append(text)
                sizes.append(len(data))
                removed.append(len(data) - len(kept))
                runs.append(len(cut))
                digests.append(hashlib.sha256(kept).hexdigest())
                repeated.append(sum(b - a for a, b in _merged(passages.values)) if passages.is_valid else 0)
            columns = list(batch.columns[:-2])
            columns[text_at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sizes), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()),
                 pa.array(digests, pa.string()), pa.array(repeated, pa.int64())],
                names=[
                    *batch.schema.names[:-2], "dedup_bytes", "dedup_removed", "dedup_spans", "dedup_sha256",
                    "dedup_passages",
                ],
            )

    return run


def _merged(spans: pa.StructArray) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(zip(spans.field("start").to_pylist(), spans.field("end").to_pylist())):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out
