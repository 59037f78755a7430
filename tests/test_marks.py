"""Extraction in parts and the stream by watermarks."""

from __future__ import annotations

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tidemark.contracts import TableContract
from tidemark.operators import extract
from tidemark.operators.latest import latest_per_key
from tidemark.plans.extract import RawFormat, extract_tables
from tidemark.plans.layout import Warehouse
from tidemark.sources import bronze, snapshots, storage
from tidemark.streaming import marks

START = datetime.datetime(2026, 1, 1)


def events(spark, first, count, minutes=1, seed=1):
    rng = random.Random(seed)
    rows = [
        (i, rng.randint(0, 9), None if i % 50 == 49 else START + datetime.timedelta(minutes=i * minutes))
        for i in range(first, first + count)
    ]
    return spark.createDataFrame(rows, "id long, key int, ts timestamp_ntz")


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def micros(minute):
    return int((START - datetime.datetime(1970, 1, 1)).total_seconds() + minute * 60) * 1_000_000


def test_parts_follow_each_other_and_are_pushed_down(spark, root):
    events(spark, 0, 400).write.parquet(root + "/source")
    source = spark.read.parquet(root + "/source")
    low, high = micros(10), micros(390)
    bounds = extract.window_bounds(source, "ts", low, high, 5)
    parts = extract.window_parts(source, "ts", bounds)
    sizes = [p.count() for p in parts]
    assert len(parts) == 5 and sum(sizes) == extract.extract_window(source, "ts", low, high).count()
    assert max(sizes) < 2 * min(sizes)
    plan = parts[2]._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts," in plan and "LessThanOrEqual(ts," in plan
    assert bronze.write_parts(parts, root + "/raw") == sum(sizes)
    assert sorted(storage.child_folders(spark, root + "/raw")) == [f"part={i}" for i in range(5)]
    assert rows(bronze.read_run(spark, root + "/raw")) == rows(extract.extract_window(source, "ts", low, high))
    # All rows of one time stamp, and none at all, are one part.
    same = source.withColumn("ts", F.lit(START).cast("timestamp_ntz"))
    assert extract.window_bounds(same, "ts", 0, high, 4) == [0, micros(0), high]
    assert extract.window_bounds(source.limit(0), "ts", 0, high, 4) == [0, high]


def test_predicates_say_the_same_in_sql(spark):
    source = events(spark, 0, 300)
    bounds = extract.window_bounds(source, "ts", micros(5) + 1, micros(250), 3)
    found = [source.filter(F.expr(p)) for p in extract.window_predicates("ts", bounds)]
    assert [rows(f) for f in found] == [rows(p) for p in extract.window_parts(source, "ts", bounds)]


def test_extraction_in_parts_equals_extraction(spark, root):
    source = events(spark, 0, 200)
    contract = TableContract("events", source.schema, key="id", watermark="ts")
    found = []
    for name, raw in (("a", RawFormat()), ("b", RawFormat(parts=4))):
        warehouse = Warehouse(f"{root}/{name}")
        done = extract_tables(spark, {"events": source}, [contract], warehouse, "r1", raw)[0]
        path = bronze.run_path(warehouse.root, "events", "r1")
        found.append((done.rows, done.high, rows(bronze.read_run(spark, path))))
    assert found[0] == found[1]


def test_stream_by_watermark_equals_batch(spark, root, monkeypatch):
    contract = TableContract("events", events(spark, 0, 1).schema, key="key", watermark="ts")
    source, table, log = root + "/source", root + "/table", root + "/log"

    def run():
        marks.merge_new(spark, source, table, contract, log, keep_versions=1).awaitTermination()

    everything = events(spark, 0, 120)
    everything.repartition(3).write.parquet(source)
    run()
    assert rows(snapshots.read_current(spark, table)) == rows(
        latest_per_key(everything.filter("ts IS NOT NULL"), ["key"], "ts")
    )
    # A trigger that fails half-way is repeated with the same window when the stream starts again.
    later = events(spark, 120, 80, seed=2)
    later.write.mode("append").parquet(source)
    real = marks.merge_batch

    def failing(*args):
        def merge(batch, number):
            batch.count()
            raise RuntimeError("half-way")

        return merge

    monkeypatch.setattr(marks, "merge_batch", failing)
    with pytest.raises(Exception, match="half-way"):
        run()
    monkeypatch.setattr(marks, "merge_batch", real)
    run()
    whole = everything.unionByName(later).filter("ts IS NOT NULL")
    assert rows(snapshots.read_current(spark, table)) == rows(latest_per_key(whole, ["key"], "ts"))
    # Nothing new: no row is read, and no version published. What comes late is not taken in.
    before = snapshots.current_version(spark, table)
    events(spark, 0, 5, seed=9).withColumn("key", F.lit(77)).write.mode("append").parquet(source)
    run()
    assert snapshots.current_version(spark, table) == before


def test_windows_read_their_row_groups_only(spark, root):
    for first in (0, 100, 200):
        events(spark, first, 100).coalesce(1).write.mode("append").parquet(root + "/source")
    reader = marks._MarkReader(root + "/source", "ts", events(spark, 0, 1).schema)
    assert reader.latestOffset() == {"mark": micros(298)}
    wanted = reader.partitions({"mark": micros(150)}, {"mark": micros(250)})
    assert len(wanted) == 2 and len(reader.partitions({"mark": 0}, reader.latestOffset())) == 3
    found = [row for part in wanted for batch in reader.read(part) for row in batch.column(0).to_pylist()]
    assert sorted(found) == [i for i in range(151, 251) if i % 50 != 49]
    assert reader.partitions(reader.latestOffset(), reader.latestOffset()) == []
