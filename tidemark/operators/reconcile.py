"""Which rows two keyed tables differ in, found by digests of key ranges.

Both tables are digested by ranges of their key: the number of rows, and the sum and the XOR of
their hashes. Ranges with equal digests hold the same rows and are never looked at again; the
others are divided and digested anew, with their bounds as filters that reach the scan, until
few rows are left, which are then compared key by key. Tables that hardly differ are read once,
in two or three columns' worth of hashes, and nothing of them is shuffled but digests.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

from tidemark.operators.audit import digest, row_hash

MISSING, CHANGED, DELETED = "missing", "changed", "deleted"
# Ranges of the first look, parts of a range that differs, rows of a range that need not be divided.
RANGES, PARTS, ROWS_PER_RANGE = 1024, 64, 100_000
# More ranges than this are not worth a look of their own: their rows are compared at once.
MAX_RANGES = 512
_DIGEST = ("rows", "hash_sum", "hash_xor")


class Range(NamedTuple):
    """Keys from ``low`` to ``high``, both included."""

    low: int
    high: int


def differences(
    source: DataFrame, target: DataFrame, key: str, columns: Sequence[str] | None = None,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """``key`` and ``difference`` of every key whose rows in the two tables are not the same.

    A key only ``source`` has is ``missing``, one only ``target`` has is ``deleted``, any other is
    ``changed``: one of ``columns`` (all of the source's, unless given) differs, or the number of
    equal rows. NULL is a key like others. Keys other than whole numbers are ranged by their
    hash, so that ranges still spare comparisons, but not reading. Rows are told apart by 64-bit hashes.
    """
    columns = list(columns or source.columns)
    ranges = differing_ranges(source, target, key, columns, rows_per_range)
    sides = [
        df.filter(within(_place(df, key), ranges)).select(F.col(f"`{key}`").alias("key"), row_hash(columns).alias("row"))
        for df in (source, target)
    ]
    both = sides[0].withColumn("side", F.lit(0)).unionByName(sides[1].withColumn("side", F.lit(1)))

    def of(side: int) -> list[Column]:
        mine = F.when(F.col("side") == side, F.col("row"))
        return [
            F.count(mine).alias(f"n{side}"), F.sum(mine.cast("decimal(20,0)")).alias(f"sum{side}"),
            F.bit_xor(mine).alias(f"xor{side}"),
        ]

    found = both.groupBy("key").agg(*of(0), *of(1))
    same = (F.col("n0") == F.col("n1")) & (F.col("sum0") == F.col("sum1")) & (F.col("xor0") == F.col("xor1"))
    difference = F.when(F.col("n1") == 0, MISSING).when(F.col("n0") == 0, DELETED).when(~same, CHANGED)
    return found.select(F.col("key").alias(key), difference.alias("difference")).filter("difference IS NOT NULL")


def differing_ranges(
    source: DataFrame, target: DataFrame, key: str, columns: Sequence[str], rows_per_range: int = ROWS_PER_RANGE
) -> list[Range | None]:
    """Ranges of the key in which the tables differ, None standing for rows without a key.

    Some hundred digests per look reach the driver, however large the tables are.
    """
    places = _place(source, key), _place(target, key)
    bounds = [
        df.agg(F.min(place), F.max(place), F.count_if(place.isNull())).first() for df, place in zip((source, target), places)
    ]
    known = [b for b in bounds if b[0] is not None]
    out: list[Range | None] = [None] if any(b[2] for b in bounds) and _differ(
        *[df.filter(place.isNull()).agg(*digest(columns)).first() for df, place in zip((source, target), places)]
    ) else []
    if not known:
        return out
    looked = [Range(min(b[0] for b in known), max(b[1] for b in known))]
    parts = RANGES
    while looked:
        divided = [part for r in looked for part in _divided(r, parts)]
        found = [_digests(df, place, divided, columns) for df, place in zip((source, target), places)]
        looked = []
        for i, part in enumerate(divided):
            a, b = found[0].get(i), found[1].get(i)
            if _differ(a, b):
                rows = max(x["rows"] if x else 0 for x in (a, b))
                (out if rows <= rows_per_range or part.low == part.high else looked).append(part)
        parts = PARTS
        if len(looked) * parts > MAX_RANGES * PARTS or len(out) + len(looked) > MAX_RANGES:
            out += looked
            break
    return _joined(out)


def within(place: Column, ranges: Sequence[Range | None]) -> Column:
    """True for keys in one of the ranges, as a filter that scans can use."""
    if not ranges:
        return F.lit(False)
    return reduce(or_, [place.isNull() if r is None else place.between(r.low, r.high) for r in ranges])


def _place(df: DataFrame, key: str) -> Column:
    column = F.col(f"`{key}`")
    if isinstance(df.schema[key].dataType, (ByteType, ShortType, IntegerType, LongType)):
        return column
    return F.when(column.isNotNull(), F.xxhash64(column))


def _divided(r: Range, parts: int) -> list[Range]:
    width = -(-(r.high - r.low + 1) // parts)
    return [Range(low, min(low + width - 1, r.high)) for low in range(r.low, r.high + 1, width)]


def _digests(df: DataFrame, place: Column, ranges: list[Range], columns: Sequence[str]) -> dict:
    """The digest of each range that has rows, by its number."""
    joined = _joined(list(ranges))
    # Ranges that follow each other are as wide as each other but for the last: their number is a quotient.
    number = F.lit(None).cast("long")
    for group in _even(ranges):
        first, r = group[0]
        width = r.high - r.low + 1
        inside = place.between(r.low, group[-1][1].high)
        offset = (place.cast("decimal(20,0)") - F.lit(r.low).cast("decimal(20,0)")) / F.lit(width).cast("decimal(20,0)")
        number = F.when(inside, F.floor(offset).cast("long") + F.lit(first)).otherwise(number)
    digested = (
        df.filter(within(place, joined)).groupBy(number.alias("range")).agg(*digest(columns))
    )
    return {r["range"]: r for r in digested.collect()}


def _even(ranges: list[Range]) -> list[list[tuple[int, Range]]]:
    groups: list[list[tuple[int, Range]]] = []
    for i, r in enumerate(ranges):
        last = groups[-1][-1][1] if groups else None
        whole = groups and groups[-1][0][1].high - groups[-1][0][1].low
        if last is not None and r.low == last.high + 1 and last.high - last.low == whole and r.high - r.low <= whole:
            groups[-1].append((i, r))
        else:
            groups.append([(i, r)])
    return groups


def _joined(ranges: list[Range | None]) -> list[Range | None]:
    """Ranges in order, those that follow each other as one."""
    out: list[Range | None] = [None] if None in ranges else []
    for r in sorted(r for r in ranges if r is not None):
        if out and out[-1] is not None and r.low <= out[-1].high + 1:
            out[-1] = Range(out[-1].low, max(r.high, out[-1].high))
        else:
            out.append(r)
    return out


def _differ(a, b) -> bool:
    if a is None or b is None:
        return (a or b) is not None and (a or b)["rows"] > 0
    return any(a[c] != b[c] for c in _DIGEST)
