"""Quality classifier by compression.

Two zstandard dictionaries are built, one from good and one from bad labelled text.
Text resembling one side compresses better with its dictionary; the difference of
the compressed sizes, normalised by the text's size, is turned into a probability by
a logistic fit on labelled texts that no dictionary has seen.

Texts are compressed whole, in pieces, since a dictionary serves the beginning of
what it compresses. Scoring is one pass without a shuffle; the dictionaries have a
fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.sizing import fits

PIECE = 1024
# Bounds of what is fitted on: pieces of text per label for the dictionaries, and
# texts for the calibration, chosen by a hash of the id.
DICTIONARY_PIECES, CALIBRATION_TEXTS = 4000, 20_000
DICTIONARY_BYTES, LEVEL = 64 << 10, 3


@dataclass(frozen=True)
class Model:
    """Dictionaries and the logistic fit; small and of fixed size, so it is sent with the tasks."""

    good: bytes
    bad: bytes
    slope: float
    intercept: float


def fold(id_column, folds: int):
    """Remainder of the CRC-32 of the id as text; NULL ids are in fold 0."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % folds, F.lit(0))


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", pieces: int = DICTIONARY_PIECES, texts: int = CALIBRATION_TEXTS,
) -> Model:
    """Learns from the labelled rows given; leave held-out rows out of ``labels``.

    Two thirds of the ids give pieces for the dictionaries, the rest calibrates: the first
    ``pieces`` ids and pieces per label, and ``texts`` ids and texts, in the order of a hash. Texts are cut or
    measured where they are; only pieces and numbers are ordered and gathered. NULL
    labels and texts are left out; an id with several labels counts with each.
    Without texts of both labels the model answers with the share of label 1.
    """
    known = labels.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{label_col}`").cast("int").alias("y"))
    known = known.filter("y IN (0, 1) AND __id IS NOT NULL").withColumn("order", F.xxhash64(F.lit("fit"), "__id"))
    source = docs.select(
        F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").cast("string").cast("binary").alias("bytes")
    )

    def some(part: DataFrame, n: int) -> DataFrame:
        # Ids first, so that no more texts than those of the sample are looked at.
        ids = part.orderBy("order").limit(n)
        return source.join(F.broadcast(ids) if fits(ids) else ids, "__id")

    first, rest = F.pmod("order", F.lit(3)) < 2, F.pmod("order", F.lit(3)) == 2
    sides = []
    for y in (0, 1):
        cut = some(known.filter(first & (F.col("y") == y)), pieces).withColumn(
            "at", F.explode(F.sequence(F.lit(0), F.floor((F.octet_length("bytes") - 1) / PIECE).cast("int")))
        ).select(F.substring("bytes", F.col("at") * PIECE + 1, F.lit(PIECE)).alias("piece"), "order", "at")
        rows = cut.filter(F.octet_length("piece") > 0).orderBy(
            F.xxhash64("order", "at"), "order", "at", "piece"
        ).limit(pieces)
        sides.append([bytes(r.piece) for r in rows.collect()])
    if not all(sides):
        share = known.agg(F.avg("y")).first()[0]
        share = 0.5 if share is None else min(max(share, 0.01), 0.99)
        return Model(b"", b"", 0.0, float(np.log(share / (1 - share))))
    bad, good = (_dictionary(s) for s in sides)
    sample = some(known.filter(rest), texts).filter("bytes IS NOT NULL").select("bytes", "y", "order")
    measured = sample.mapInArrow(
        _differences(good, bad, ["y", "order"]), "y int, order bigint, difference double"
    ).orderBy("order", "y", "difference").limit(texts).collect()
    x = np.array([r.difference for r in measured])
    y = np.array([r.y for r in measured], float)
    return Model(good, bad, *_logistic(x, y))


def _dictionary(pieces: list[bytes]) -> bytes:
    """A trained dictionary, or the pieces themselves where there are too few to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, pieces).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[-DICTIONARY_BYTES:]


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Ridge-penalised logistic regression of one variable, by Newton steps."""
    if not len(x):
        return 0.0, 0.0
    scale = x.std() or 1.0
    design = np.stack([x / scale, np.ones(len(x))], axis=1)
    beta, ridge = np.zeros(2), np.diag([1e-2, 1e-2])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        hessian = design.T @ (design * (p * (1 - p))[:, None]) + ridge
        step = np.linalg.solve(hessian, design.T @ (y - p) - ridge @ beta)
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0] / scale), float(beta[1])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, difference, score)`` per row: the probability of label 1 from the text alone.

    NULL and empty texts have difference 0. Repeated rows score alike.
    """
    source = docs.select(
        F.col(f"`{text_col}`").cast("string").cast("binary").alias("bytes"), F.col(f"`{id_col}`").alias("doc_id")
    )
    id_type = source.schema["doc_id"].dataType.simpleString()
    measured = source.mapInArrow(
        _differences(model.good, model.bad, ["doc_id"]), f"doc_id {id_type}, difference double"
    )
    logit = F.lit(model.slope) * F.col("difference") + F.lit(model.intercept)
    return measured.withColumn("score", 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), logit)))))


def _differences(good: bytes, bad: bytes, carried: list[str]):
    """Compressed size with the bad dictionary less that with the good one, per byte."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders = [
            zstandard.ZstdCompressor(
                level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d) if d else None,
                write_content_size=False, write_checksum=False, write_dict_id=False,
            )
            for d in (bad, good)
        ]
        for batch in batches:
            values = np.zeros(batch.num_rows)
            for i, text in enumerate(batch.column("bytes")):
                data = memoryview(text.as_buffer()) if text.is_valid else b""
                if not len(data):
                    continue
                sizes = [
                    sum(len(c.compress(data[a : a + PIECE])) for a in range(0, len(data), PIECE)) for c in coders
                ]
                values[i] = (sizes[0] - sizes[1]) / len(data)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in carried), pa.array(values)], names=[*carried, "difference"]
            )

    return run
