"""Near-duplicate join on word shingles: a forest of minhash tries, then exact counts.

Each text is the set of its word shingles. A tree of the forest is a trie over a
sequence of minhashes; two texts meet in a tree down to a depth ``d`` when their
first ``d`` minhashes are equal, which happens with probability ``s ** d`` at
similarity ``s``. Starting from the full depth, the prefixes that have to match
are shortened until a pair at the threshold meets in at least one tree with the
target recall (:func:`matched_prefix`).

1. One pass over the texts writes, per text, a digest of its shingle set and one
   key per tree (the prefix). Texts with equal sets become one node.
2. Every node is linked with the smallest node under the same key: a minimum per
   key with partial sums. Connected nodes form a candidate group, which holds every
   pair that meets anywhere.
3. Texts of candidate groups travel once, to the task of their group, where exact
   similarities are counted from the incidence of texts and shared shingles. A
   group beyond one task's budget is dealt into blocks, one task per pair of
   blocks. Tasks return a row per text: its number of links and its local class.
4. Local classes are joined to classes.

A group of copies costs nothing after step 1. Pairs are never rows of a table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.groups import components
from tidemark.llm.windows import binary_slices
from tidemark.llm.words import mixed, shingles, words_of
from tidemark.sources.storage import materialise

TREES, DEPTH, RECALL = 32, 8, 0.9999
# Texts and shingles of one side of a comparing task.
BLOCK_TEXTS, BLOCK_SHINGLES = 1024, 1_000_000


def matched_prefix(trees: int, depth: int, threshold: float, recall: float) -> int:
    """Longest prefix at which a pair at the threshold meets with the target recall.

    Raises when even a prefix of one minhash falls short: then more trees are needed.
    """
    for length in range(depth, 0, -1):
        if 1 - (1 - threshold**length) ** trees >= recall:
            return length
    raise ValueError("too few trees for this recall")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8,
    shingle: int = 5, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL,
) -> DataFrame:
    """One row ``(doc_id, text_hash, class_id, class_key, n_links)`` per row of ``docs``.

    Two rows are linked when the Jaccard similarity of their shingle sets is at
    least ``threshold``; ``n_links`` counts the other rows linked to a row, copies
    included. ``class_id`` is the smallest id among the rows connected by links,
    ``class_key`` names the class. Texts of fewer words than a shingle have one
    shingle of all their words. NULL, empty and wordless texts link to nothing and
    are classes of their own, with a NULL key. Repeated rows are copies.
    """
    length = matched_prefix(trees, depth, threshold, recall)
    text = F.col(f"`{text_col}`").cast("string")
    source = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(text).alias("text_hash"),
        text.cast("binary").alias("bytes"),
    )
    id_type = source.schema["doc_id"].dataType.simpleString()
    profile = materialise(
        source.mapInArrow(
            _profiles(shingle, trees, length),
            f"doc_id {id_type}, text_hash bigint, node binary, size int, keys array<bigint>",
        ),
        "near-profiles",
    )
    nodes = materialise(
        profile.filter("node IS NOT NULL").groupBy("node").agg(
            F.min("doc_id").alias("first_id"), F.min(F.struct("doc_id", "text_hash")).alias("example"),
            F.count("*").alias("copies"), F.first("size").alias("size"), F.first("keys").alias("keys"),
        ),
        "near-nodes",
    )
    keyed = nodes.select("node", F.explode("keys").alias("key"))
    shared = materialise(
        keyed.groupBy("key").agg(F.min("node").alias("root"), F.count("*").alias("n")).filter("n > 1")
        .select("key", "root"),
        "near-buckets",
    )
    met = keyed.join(shared.hint("merge"), "key").filter("node <> root").select("node", "root").distinct()
    verified = materialise(
        _verified(source, nodes, components(met, "node", "root"), shingle, threshold), "near-verified"
    )
    classes = components(verified, "node", "root")
    totals = verified.groupBy("node").agg(F.sum("links").alias("links"))
    table = materialise(
        nodes.select("node", "first_id", "copies")
        .join(classes, "node", "left").join(totals, "node", "left")
        .select(
            "node", F.coalesce("root", "node").alias("class_key"), "first_id",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        ),
        "near-classes",
    )
    smallest = table.groupBy("class_key").agg(F.min("first_id").alias("class_id"))
    table = table.join(smallest, "class_key").select("node", "class_key", "class_id", "n_links")
    return profile.select("doc_id", "text_hash", "node").join(table, "node", "left").select(
        "doc_id", "text_hash",
        F.when(F.col("class_key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        "class_key", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def one_per_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The row with the smallest id of each class, with the columns of ``docs``.

    A NULL id comes first. Of rows that repeat an id, the text with the smaller
    hash stays, and of rows that repeat id and text, one.
    """
    result = materialise(near_duplicates(docs, id_col, text_col, **options), "near-result")
    member = F.struct("doc_id", "text_hash")
    grouped = result.filter("class_key IS NOT NULL")
    best = grouped.groupBy("class_key").agg(F.min(member).alias("best"), F.count("*").alias("n")).filter("n > 1")
    marked = grouped.join(best, "class_key").select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), (member != F.col("best")).alias("gone")
    )
    gone = materialise(marked.filter("gone").select("__id", "__hash").distinct(), "near-gone")
    repeated = materialise(
        marked.filter("NOT gone").groupBy("__id", "__hash").agg(F.count("*").alias("n")).filter("n > 1").drop("n"),
        "near-repeated",
    )
    matches = F.col(f"`{id_col}`").eqNullSafe(F.col("__id")) & (
        F.xxhash64(F.col(f"`{text_col}`").cast("string")) == F.col("__hash")
    )
    kept = docs.join(gone.hint("merge"), matches, "left_anti")
    if repeated.isEmpty():
        return kept
    return kept.join(repeated, matches, "left_anti").unionByName(
        kept.join(repeated, matches, "left_semi").dropDuplicates([id_col, text_col])
    )


def _profiles(shingle: int, trees: int, length: int):
    rng = np.random.default_rng(8_161_977)
    odd = rng.integers(0, 2**32, trees * length, dtype=np.uint32) | np.uint32(1)
    plus = rng.integers(0, 2**32, trees * length, dtype=np.uint32)
    names = ["doc_id", "text_hash", "node", "size", "keys"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(_shingle_sets(batch.column("bytes"), shingle))
            prefixes = np.empty((len(sets), trees, length), np.uint32)
            for i, values in enumerate(sets):
                lowest = np.full(trees * length, 2**32 - 1, np.uint32)
                for at in range(0, len(values), 1024):
                    part = (values[at : at + 1024] >> np.uint64(32)).astype(np.uint32)
                    np.minimum(lowest, (part[:, None] * odd + plus).min(axis=0), out=lowest)
                prefixes[i] = lowest.reshape(trees, length)
            keys = np.broadcast_to(np.arange(1, trees + 1, dtype=np.uint64), prefixes.shape[:2])
            for j in range(length):
                keys = mixed(keys) + prefixes[:, :, j]
            keys = mixed(keys).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("text_hash"),
                    pa.array([_digest(s) for s in sets], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int32()),
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(0, keys.size + 1, trees, dtype=np.int32)), pa.array(keys.ravel())
                    ),
                ],
                names=names,
            )

    return run


def _shingle_sets(column: pa.Array, shingle: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingles of each text, in the order of the column."""
    for _, _, data, offsets in binary_slices(column, budget=1 << 19, whole=True):
        marks, _, _, words = words_of(data, offsets)
        values, bounds = shingles(marks, words, shingle)
        for a, b in zip(bounds[:-1], bounds[1:]):
            yield np.unique(values[a:b])


def _digest(values: np.ndarray) -> bytes | None:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest() if len(values) else None


def _verified(
    source: DataFrame, nodes: DataFrame, groups: DataFrame, shingle: int, threshold: float
) -> DataFrame:
    """``(node, root, links)`` of the texts of candidate groups, one row per compared pair of blocks."""
    members = materialise(
        groups.join(nodes.select("node", "example", "copies", "size"), "node")
        .select("node", F.col("root").alias("grp"), "example", "copies", "size"),
        "near-members",
    )
    blocks = members.groupBy("grp").agg(
        F.greatest(
            F.ceil(F.count("*") / BLOCK_TEXTS), F.ceil(F.sum("size") / BLOCK_SHINGLES)
        ).cast("int").alias("blocks")
    )
    dealt = members.join(blocks, "grp").withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    )
    dealt = materialise(
        dealt.select(
            "node", "grp", "block", "blocks", "copies",
            F.col("example.doc_id").alias("__id"), F.col("example.text_hash").alias("__hash"),
        ),
        "near-dealt",
    )
    # Both sides grow with the texts: joined the same way at every size.
    texts = source.join(
        dealt.hint("merge"), F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_hash") == F.col("__hash"))
    )
    paired = texts.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "grp", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        "node", "block", "copies", "bytes",
    )
    return paired.groupBy("grp", "low", "high").applyInPandas(
        _comparer(shingle, threshold), "node binary, root binary, links bigint"
    )


def _comparer(shingle: int, threshold: float):
    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        # Rows that repeat id and text arrive more than once; copies already counts them.
        rows = rows[~rows["node"].duplicated()]
        sets = list(_shingle_sets(pa.array(rows["bytes"], pa.binary()), shingle))
        common = _intersections(sets)
        sizes = np.array([len(s) for s in sets])
        linked = common >= threshold * (sizes[:, None] + sizes[None, :] - common) - 1e-6
        np.fill_diagonal(linked, False)
        if rows["low"].iloc[0] != rows["high"].iloc[0]:
            block = rows["block"].to_numpy()
            linked &= block[:, None] != block[None, :]
        root = np.arange(len(rows))
        while True:
            near = np.where(linked, root[None, :], len(rows)).min(axis=1, initial=len(rows))
            lower = np.minimum(root, near)
            lower = np.minimum(lower, lower[lower])
            if (lower == root).all():
                break
            root = lower
        node = rows["node"].to_numpy()
        return pd.DataFrame({"node": node, "root": node[root], "links": linked @ rows["copies"].to_numpy()})

    return compare


def _intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Shared shingles of every two sets, from their incidence in slices of columns."""
    n = len(sets)
    common = np.zeros((n, n), np.float32)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, column, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts > 1
    number = np.cumsum(shared) - 1
    keep = shared[column]
    column, owner = number[column[keep]], owner[keep]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    total = int(shared.sum())
    width = 4096
    for low in range(0, total, width):
        a, b = np.searchsorted(column, [low, low + width])
        incidence = np.zeros((n, min(width, total - low)), np.float32)
        incidence[owner[a:b], column[a:b] - low] = 1
        common += incidence @ incidence.T
    np.fill_diagonal(common, 0)
    return common
