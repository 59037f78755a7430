"""Current-state tables to the star schema.

A build writes only what its inputs' changes touch: a dimension whose table has a new version,
and the days of the fact that gain, lose or reprice an order. Everything else stays in the files
of the build that wrote it. A version of the star schema is a small folder that names the build
of each dimension and of each day, next to the daily sales; publishing it makes all parts
visible at once, and a build that fails leaves nothing but files nobody refers to.
"""

from __future__ import annotations

import json
import time
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tidemark.contracts import CUSTOMERS, ORDERS, PRODUCTS
from tidemark.operators import star
from tidemark.operators.audit import added_up, digest, digest_audit, require_balance, require_content, require_keys, taken_away
from tidemark.operators.sizing import BROADCAST_LIMIT
from tidemark.plans.concurrent import side_by_side
from tidemark.plans.layout import Warehouse
from tidemark.plans.versions import changes_between, forget_changes
from tidemark.sources import ledger, snapshots, storage

SKIPPED = "skipped: a current-state table is missing"
UNCHANGED = "skipped: no current-state table has changed"
PUBLISHED = "published"
FACT = "fact_orders"
DIM_PRODUCTS, DIM_CUSTOMERS = "dim_products", "dim_customers"
DAILY_SALES = "aggregations/daily_category_sales"
INPUTS = "built_from"
DAYS = "fact_days"
_RESERVED = "_reserved"
# Fixed value: how Spark names the folder of rows without a day.
_NO_DAY = "__HIVE_DEFAULT_PARTITION__"
# Share of the orders on touched days from which on the orders' table is read for them.
_MOST = 0.5
# Threads that remove folders.
_REMOVERS = 8
_DIMENSIONS = {DIM_PRODUCTS: (0, star.product_dimension, star.PRODUCT_COLUMNS, "product_id"),
               DIM_CUSTOMERS: (1, star.customer_dimension, star.CUSTOMER_COLUMNS, "customer_id")}


@dataclass(frozen=True)
class GoldBuild:
    status: str
    rows: int = 0
    version: int | None = None
    # Days of the fact that were written, None for all there are.
    days: tuple[date | None, ...] | None = None


@dataclass(frozen=True)
class _Part:
    """What a version says of an input or a part: the table's version, the build that wrote it, its columns."""

    version: int | None = None
    build: int | None = None
    schema: str | None = None


def build_gold(
    spark: SparkSession,
    warehouse: Warehouse,
    run_id: str,
    broadcast_limit: int = BROADCAST_LIMIT,
    names: tuple[str, str, str] = (PRODUCTS.name, CUSTOMERS.name, ORDERS.name),
    check_keys: bool = False,
    keep_versions: int | None = None,
) -> GoldBuild:
    """Builds dimensions, fact and daily sales, published together or not at all.

    With the changes of all inputs since the published version at hand, only the days
    they touch are joined and written; otherwise all are. The written rows are checked
    against the orders they come from by count and content before the version is published.
    Nothing is built again while the tables it was built from have the same versions.

    ``check_keys`` also looks for missing and repeated order keys in the whole fact, which
    shuffles every key. ``keep_versions`` removes older versions and what only they refer to.
    """
    started = time.monotonic()
    inputs = {name: snapshots.current_version(spark, warehouse.silver(name)) for name in names}
    if None in inputs.values():
        return GoldBuild(SKIPPED)
    base = snapshots.current_version(spark, warehouse.gold) or 0
    known = _parts(spark, warehouse, base)
    if inputs == {name: known[name].version for name in names if name in known}:
        return GoldBuild(UNCHANGED)
    version = _reserve(spark, warehouse.gold)
    with storage.owned_scratch(spark):
        built = _Build(spark, warehouse, names, inputs, known, base, version, broadcast_limit)
        rows, days = built.run(check_keys)
    snapshots.publish(spark, warehouse.gold, version, base)
    for name in names:
        forget_changes(spark, warehouse.silver(name), inputs[name])
    if keep_versions is not None:
        retire_gold(spark, warehouse, keep_versions)
    seconds = time.monotonic() - started
    ledger.append(spark, warehouse.ledger, run_id, ledger.GOLD, [(FACT, rows, seconds)])
    return GoldBuild(PUBLISHED, rows, version, days)


class _Build:
    """One build of a new version from a published one."""

    def __init__(
        self, spark: SparkSession, warehouse: Warehouse, names: tuple[str, str, str], inputs: dict[str, int],
        known: dict[str, _Part], base: int, version: int, broadcast_limit: int,
    ):
        self.spark, self.warehouse, self.names, self.inputs = spark, warehouse, names, inputs
        self.known, self.base, self.version, self.limit = known, base, version, broadcast_limit

    def run(self, check_keys: bool) -> tuple[int, tuple[date | None, ...] | None]:
        changes = self._changes()
        written = side_by_side(self._dimension, _DIMENSIONS)
        dims = [df for df, _ in written]
        parts = {name: part for name, (_, part) in zip(_DIMENSIONS, written)}
        orders = self._silver(self.names[2])
        if changes is None:
            days = None
            fact = star.order_fact(orders, *dims, self.limit, stored=orders)
            self._write_days(fact)
            fact = self._written_days(fact.schema)
            sales, counted = self._measured(fact, orders.columns)
            require_content(digest_audit(orders.agg(*digest(orders.columns)), counted.agg(*added_up())))
        else:
            fact, days, sales, counted = self._changed(changes, orders.columns, dims)
        counted = self._draft(counted, DAYS)
        rows = counted.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
        require_balance(orders.count(), rows)
        schema = json.dumps(fact.schema.jsonValue())
        parts |= {name: _Part(version) for name, version in self.inputs.items()} | {FACT: _Part(schema=schema)}
        self._draft(sales, DAILY_SALES)
        self._draft(_parts_frame(self.spark, parts), INPUTS)
        if check_keys:
            require_keys(_read_fact(self.spark, self.warehouse, self.version), ["order_id"], FACT)
        return rows, days

    def _silver(self, name: str) -> DataFrame:
        return snapshots.read_version(self.spark, self.warehouse.silver(name), self.inputs[name])

    def _changes(self) -> list[DataFrame] | None:
        """What changed in products, customers and orders since the base, None if that is not known."""
        if not self.base or not all(name in self.known for name in (*self.names, FACT, *_DIMENSIONS)):
            return None
        # Digests and files of the base hold for the types they were made of.
        types = {f.name: f.dataType for f in StructType.fromJson(json.loads(self.known[FACT].schema)).fields}
        if any(types.get(f.name) != f.dataType for f in self._silver(self.names[2]).schema.fields):
            return None
        found = []
        for name, key in zip(self.names, ("product_id", "customer_id", "order_id")):
            change = changes_between(
                self.spark, self.warehouse.silver(name), [key], self.known[name].version, self.inputs[name]
            )
            if change is None:
                return None
            found.append(change)
        return found

    def _dimension(self, name: str) -> tuple[DataFrame, _Part]:
        """The dimension and where it is: the base's, as long as its table has the same version."""
        at, project, _, _ = _DIMENSIONS[name]
        table = self.names[at]
        if name in self.known and self.known[table].version == self.inputs[table]:
            return _read_dimension(self.spark, self.warehouse, name, self.known[name].build), self.known[name]
        project(self._silver(table)).write.mode("errorifexists").parquet(
            _build_path(self.warehouse, name, self.version)
        )
        return _read_dimension(self.spark, self.warehouse, name, self.version), _Part(build=self.version)

    def _write_days(self, fact: DataFrame) -> None:
        star.by_day(fact).write.mode("errorifexists").partitionBy("order_date").parquet(
            _build_path(self.warehouse, FACT, self.version)
        )

    def _written_days(self, schema: StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(_build_path(self.warehouse, FACT, self.version))

    def _measured(self, fact: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
        """Sales of the written days, and rows and content of each with the build it is of, in one pass over them."""
        groups = storage.materialise(
            fact.groupBy(*star.SALES_KEYS).agg(*star.sales_figures(), *digest(columns)), "written-days"
        )
        counted = groups.groupBy("order_date").agg(*added_up()).withColumn("build", F.lit(self.version))
        return groups.drop("rows", "hash_sum", "hash_xor"), counted

    def _changed(
        self, changes: list[DataFrame], columns: list[str], dims: list[DataFrame]
    ) -> tuple[DataFrame, tuple[date | None, ...], DataFrame, DataFrame]:
        """Writes the days the changes touch.

        The orders' table is not read for a few days: a day's orders are those it had, less
        the changed ones, plus the changed ones that now fall on it. Where the days hold most of the orders,
        reading the table costs less than shuffling what they had. Days are written whole, so
        their sales are those of the written rows. What they have to hold is known from the base's
        digests and the changes.
        """
        spark, warehouse = self.spark, self.warehouse
        orders = changes[2]
        products, customers = [
            _changed_keys(changes[at], list(chosen), key) for at, _, chosen, key in _DIMENSIONS.values()
        ]
        order_keys = orders.select(F.col("after.order_id").alias("order_id"))
        touched = [
            orders.filter("before IS NOT NULL").select(F.to_date("before.updated_at").alias("order_date")),
            orders.select(F.to_date("after.updated_at").alias("order_date")),
        ]
        searched = [
            (keys, key)
            for keys, name, key in ((products, self.names[0], "product_id"), (customers, self.names[1], "customer_id"))
            if self.known[name].version != self.inputs[name]
        ]
        # Its folders are listed once, here or for the touched days alone.
        before = _read_fact(spark, warehouse, self.base) if searched else None
        for keys, key in searched:
            touched.append(before.select(key, "order_date").join(keys, key, "left_semi").select("order_date"))
        # As many rows as there are days in the calendar of the orders at most.
        found = {row[0] for row in reduce(DataFrame.unionAll, touched).distinct().collect()}
        days = tuple(sorted(found, key=lambda d: (d is not None, d or date.min)))
        folder = snapshots.version_path(warehouse.gold, self.base)
        stored = spark.read.parquet(f"{folder}/{DAYS}")
        mine = star.on_days(days)
        share = stored.agg(F.sum(F.when(mine, F.col("rows"))) / F.sum("rows")).first()[0] or 0
        if share > _MOST:
            dated = self._silver(self.names[2]).withColumn("order_date", F.to_date("updated_at"))
            rows = dated.filter(mine).select(*columns)
        else:
            old = before.filter(mine) if searched else _read_fact(spark, warehouse, self.base, days)
            kept = old.select(*columns).join(order_keys, "order_id", "left_anti").select(*columns)
            rows = kept.unionByName(orders.select(*_side("after", columns)))
        fact = star.order_fact(rows, *dims, self.limit)
        self._write_days(fact)
        fact = self._written_days(fact.schema)
        sales, counted = self._measured(fact, columns)
        gone = orders.filter("before IS NOT NULL").select(*_side("before", columns)).agg(*digest(columns))
        come = orders.select(*_side("after", columns)).agg(*digest(columns))
        due = stored.filter(mine).select(*gone.columns).unionByName(taken_away(gone)).unionByName(come)
        require_content(digest_audit(due.agg(*added_up()), counted.agg(*added_up())))
        others = spark.read.parquet(f"{folder}/{DAILY_SALES}").filter(~mine)
        return fact, days, others.unionByName(sales), stored.filter(~mine).unionByName(counted)

    def _draft(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{snapshots.version_path(self.warehouse.gold, self.version)}/{name}"
        # One row per day, or per day and category: few files are the right size.
        df.coalesce(1).write.mode("errorifexists").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def _changed_keys(changes: DataFrame, columns: list[str], key: str) -> DataFrame:
    """Keys whose columns in the dimension are new or different."""
    differs = F.lit(False)
    for c in columns:
        differs = differs | ~F.col(f"before.`{c}`").eqNullSafe(F.col(f"after.`{c}`"))
    return changes.filter(F.col("before").isNull() | differs).select(F.col(f"after.`{key}`").alias(key))


def _side(side: str, columns: Sequence[str]) -> list[Column]:
    """Columns of one side of changes."""
    return [F.col(f"{side}.`{c}`").alias(c) for c in columns]


def _reserve(spark: SparkSession, root: str) -> int:
    """A version number no other build has, its folder created.

    File systems that can't create a file exclusively are refused here, before anything is written.
    """
    while True:
        version = snapshots.next_version(spark, root)
        if storage.claim(spark, f"{snapshots.version_path(root, version)}/{_RESERVED}"):
            return version


def _build_path(warehouse: Warehouse, name: str, build: int) -> str:
    return f"{warehouse.gold_part(name)}/build={build}"


def _parts(spark: SparkSession, warehouse: Warehouse, version: int) -> dict[str, _Part]:
    """What the star schema of a version was built from and is put together of; a few rows."""
    if not version:
        return {}
    path = f"{snapshots.version_path(warehouse.gold, version)}/{INPUTS}"
    return {r["name"]: _Part(r["version"], r["build"], r["schema"]) for r in spark.read.parquet(path).collect()}


def _parts_frame(spark: SparkSession, parts: dict[str, _Part]) -> DataFrame:
    rows = [
        F.struct(
            F.lit(name).alias("name"), F.lit(p.version).cast("int").alias("version"),
            F.lit(p.build).cast("int").alias("build"), F.lit(p.schema).cast("string").alias("schema"),
        )
        for name, p in parts.items()
    ]
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*rows)))


def _read_dimension(spark: SparkSession, warehouse: Warehouse, name: str, build: int) -> DataFrame:
    return spark.read.parquet(_build_path(warehouse, name, build))


def _read_fact(
    spark: SparkSession, warehouse: Warehouse, version: int, days: Sequence[date | None] | None = None
) -> DataFrame:
    """The fact of a version, or some days of it: each day from the build that wrote it last.

    Which build that is, is a filter on the partitions, so other builds' files are not read. Of
    given days, only the folders are listed.
    """
    folder = snapshots.version_path(warehouse.gold, version)
    schema = StructType.fromJson(json.loads(_parts(spark, warehouse, version)[FACT].schema))
    table = spark.read.parquet(f"{folder}/{DAYS}").select("order_date", "build")
    builds: dict[int, list[date | None]] = {}
    for row in (table if days is None else table.filter(star.on_days(days))).collect():
        builds.setdefault(row["build"], []).append(row["order_date"])
    if not builds:
        return spark.createDataFrame([], schema)
    whole = StructType([*schema.fields, StructField("build", IntegerType())])
    reader = spark.read.schema(whole).option("basePath", warehouse.gold_part(FACT))
    if days is not None:
        return reader.parquet(*[
            f"{_build_path(warehouse, FACT, build)}/order_date={_NO_DAY if day is None else day.isoformat()}"
            for build, mine in builds.items() for day in mine
        ]).select(*schema.fieldNames())
    newest = max(builds)
    current = F.lit(False)
    for build, mine in builds.items():
        # The last of the builds has nothing that was written again.
        own = F.col("build") == build
        current = current | (own if build == newest else own & star.on_days(mine))
    fact = reader.parquet(*[_build_path(warehouse, FACT, build) for build in builds])
    return fact.filter(current if len(builds) > 1 else F.lit(True)).select(*schema.fieldNames())


def read_gold(spark: SparkSession, warehouse: Warehouse, name: str) -> DataFrame | None:
    """A table of the published star schema, or None when there is none yet."""
    version = snapshots.current_version(spark, warehouse.gold)
    if version is None:
        return None
    if name == FACT:
        return _read_fact(spark, warehouse, version)
    if name in _DIMENSIONS:
        return _read_dimension(spark, warehouse, name, _parts(spark, warehouse, version)[name].build)
    table = spark.read.parquet(f"{snapshots.version_path(warehouse.gold, version)}/{name}")
    return star.sales_of(table) if name == DAILY_SALES else table


def retire_gold(spark: SparkSession, warehouse: Warehouse, keep: int = 2) -> None:
    """Removes versions older than the last ``keep`` and all parts that only they refer to.

    Parts of builds after the published one are left alone; they may be in the making.
    """
    current = snapshots.current_version(spark, warehouse.gold)
    if current is None:
        return
    snapshots.retire(spark, warehouse.gold, keep)
    wanted: dict[str, set[int]] = {name: set() for name in _DIMENSIONS}
    days: set[tuple[int, str]] = set()
    for child in storage.child_folders(spark, warehouse.gold):
        version = int(child.removeprefix("v="))
        if version > current or not storage.exists(spark, f"{warehouse.gold}/{child}/{INPUTS}/_SUCCESS"):
            continue
        parts = _parts(spark, warehouse, version)
        for name in _DIMENSIONS:
            wanted[name].add(parts[name].build)
        day = F.coalesce(F.col("order_date").cast("string"), F.lit(_NO_DAY))
        table = spark.read.parquet(f"{warehouse.gold}/{child}/{DAYS}")
        days |= {(r["build"], r["day"]) for r in table.select("build", day.alias("day")).collect()}
    builds = {build for build, _ in days}
    for name, kept in (*wanted.items(), (FACT, builds)):
        for child in storage.child_folders(spark, warehouse.gold_part(name)):
            build = int(child.removeprefix("build="))
            if build <= current and build not in kept:
                storage.remove(spark, f"{warehouse.gold_part(name)}/{child}")
    old = [
        f"{_build_path(warehouse, FACT, build)}/{child}"
        for build in builds if build <= current
        for child in storage.child_folders(spark, _build_path(warehouse, FACT, build))
        if (build, child.removeprefix("order_date=")) not in days
    ]
    side_by_side(lambda paths: [storage.remove(spark, p) for p in paths], [old[i::_REMOVERS] for i in range(_REMOVERS)])
