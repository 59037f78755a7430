from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import extract, numbering
from tidemark.operators.ordering import in_order
from tidemark.sources import bronze

SCHEMA = "id int, name string, ts timestamp"


def at(second):
    return None if second is None else datetime.datetime(2026, 1, 1, 0, 0, second)


def frame(spark, *rows):
    return spark.createDataFrame([(i, n, at(s)) for i, n, s in rows], SCHEMA)


def us(spark, second):
    return frame(spark, (1, "x", second)).agg(extract.micros(F.max("ts"))).first()[0]


def test_window_excludes_low_and_includes_high(spark):
    df = frame(spark, (1, "a", 1), (2, "b", 2), (3, "c", 3), (4, "d", None))
    got = extract.extract_window(df, "ts", us(spark, 1), us(spark, 3))
    assert sorted(r.id for r in got.collect()) == [2, 3]
    assert [r.id for r in extract.late_rows(df, "ts", us(spark, 1)).collect()] == [1]


def test_successive_windows_cover_the_source_once(spark):
    df = frame(spark, *[(i, "x", i % 20) for i in range(100)])
    marks = [extract.EPOCH, *(us(spark, s) for s in (4, 4, 11, 19))]
    seen = [
        r.id
        for low, high in zip(marks, marks[1:])
        for r in extract.extract_window(df, "ts", low, high).collect()
    ]
    assert sorted(seen) == list(range(100))


@pytest.mark.parametrize("dtype", ["timestamp", "timestamp_ntz"])
def test_window_reaches_the_scan(spark, root, dtype):
    frame(spark, (1, "a", 1)).withColumn("ts", F.col("ts").cast(dtype)).write.parquet(root + "/t")
    df = extract.extract_window(spark.read.parquet(root + "/t"), "ts", 0, us(spark, 5))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ts" in plan and "LessThanOrEqual(ts" in plan
    assert df.count() == 1


def test_maximum_and_default(spark):
    df = frame(spark, (3, "a", 1), (9, "b", 2))
    assert extract.high_watermark(df, "ts") == us(spark, 2)
    assert extract.high_watermark(df.limit(0), "ts") is None
    assert extract.max_or_default(df, "id", 0, "m").first().m == 9
    assert extract.max_or_default(df.limit(0), "id", 0, "m").first().m == 0
    early = extract.max_or_default(df.limit(0), "ts", "1970-01-01", "m").first().m
    assert early == datetime.datetime(1970, 1, 1)
    assert extract.is_populated(df) and not extract.is_populated(df.limit(0))


def test_numbers_are_dense_and_ordered(spark):
    df = spark.range(997).select((F.col("id") * 37 % 997).alias("k"), F.lit("x").alias("v"))
    got = numbering.number_rows(df.repartition(7), ["k"], "n", start=5)
    assert all(r.n == r.k + 5 for r in got.collect()) and got.count() == 997


@pytest.fixture
def no_coalescing(spark):
    """Small test partitions stay apart as large ones would."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_a_shared_timestamp_is_still_spread(spark, no_coalescing):
    df = spark.range(5000).select(F.lit(1).alias("ts"), F.col("id"))
    ordered = in_order(df, ["ts", "id"])
    sizes = [r["count"] for r in ordered.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 2500
    placed = ordered.withColumn("p", F.spark_partition_id()).groupBy("p").agg(
        F.min("id").alias("low"), F.max("id").alias("high")
    )
    bounds = sorted((r.low, r.high) for r in placed.collect())
    assert all(a[1] < b[0] for a, b in zip(bounds, bounds[1:]))


def test_exact_copies_are_spread_and_still_numbered(spark, no_coalescing):
    df = spark.range(4000, numPartitions=16).select(F.lit(1).alias("k"), F.lit("x").alias("v"))
    sizes = [
        r["count"] for r in in_order(df, ["k"]).groupBy(F.spark_partition_id()).count().collect()
    ]
    assert sum(sizes) == 4000 and max(sizes) < 2000
    numbers = [r.n for r in numbering.number_rows(df, ["k"], "n").collect()]
    assert sorted(numbers) == list(range(1, 4001))


def test_chunks(spark):
    df = spark.range(25).withColumnRenamed("id", "k")
    chunks = numbering.assign_chunks(df, ["k"], 10)
    assert {r.k: r.chunk for r in chunks.collect()} == {k: k // 10 + 1 for k in range(25)}
    assert numbering.assign_chunks(df.limit(0), ["k"], 10).count() == 0


def test_next_keys(spark):
    existing = spark.createDataFrame([(4,), (9,)], "id long")
    incoming = spark.createDataFrame([("b",), ("a",)], "name string")
    got = numbering.allocate_keys(existing, incoming, "id", ["name"])
    assert sorted(map(tuple, got.collect())) == [(10, "a"), (11, "b")]
    first = numbering.allocate_keys(existing.limit(0), incoming, "id", ["name"])
    assert sorted(r.id for r in first.collect()) == [1, 2]


def test_samples(spark):
    df = spark.range(100)
    assert numbering.sample_rows(df, 10, seed=1).distinct().count() == 10
    once = numbering.sample_by_hash(df, "id", 10).collect()
    assert once == numbering.sample_by_hash(df.repartition(5), "id", 10).collect()
    assert once != numbering.sample_by_hash(df, "id", 10, seed="other").collect()


AWKWARD = [
    (1, 'say "hi", twice', 1),
    (2, "two\nlines", 2),
    (3, None, 3),
    (4, " padded ", None),
    (5, "back\\slash", 5),
    (6, "back\\\"quote", 6),
    (7, "käse €", 7),
]


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_raw_batches_come_back_unchanged(spark, root, fmt):
    df = frame(spark, *AWKWARD)
    path = bronze.run_path(root, "t", "r1")
    assert bronze.write_run(df, path, fmt, order_by=["ts", "id"]) == len(AWKWARD)
    raw = bronze.read_run(spark, path, fmt)
    back = raw.select(
        F.col("id").cast("int"), "name", F.col("ts").cast("timestamp")
    )
    assert raw.columns == df.columns
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    if fmt == "csv":
        assert {f.dataType.typeName() for f in raw.schema.fields} == {"string"}


def test_empty_text_is_null_in_csv(spark, root):
    bronze.write_run(frame(spark, (1, "", 1)), root + "/c", "csv")
    assert bronze.read_run(spark, root + "/c", "csv").first().name is None


def test_files_are_chunked_and_runs_isolated(spark, root):
    df = spark.range(95).coalesce(1).selectExpr("id", "id AS ts")
    bronze.write_run(df, bronze.run_path(root, "t", "a"), "csv", rows_per_file=10)
    assert bronze.write_run(df.limit(3), bronze.run_path(root, "t", "b"), "csv") == 3
    assert bronze.write_run(df.limit(0), bronze.run_path(root, "t", "none")) == 0
    a = bronze.read_run(spark, bronze.run_path(root, "t", "a"), "csv")
    assert len(a.inputFiles()) == 10 and a.count() == 95
    assert bronze.read_run(spark, bronze.run_path(root, "t", "b"), "csv").count() == 3
    assert bronze.read_run(spark, bronze.run_path(root, "t", "c"), "csv") is None
    assert bronze.preview(a).count() == 5
    with pytest.raises(ValueError):
        bronze.write_run(df, root + "/x", "xml")
