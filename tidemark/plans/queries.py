"""Every operator as a query over the TPC-H-like tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegerType, StructField, StructType, TimestampNTZType

from tidemark.contracts import CUSTOMERS, ECOMMERCE, ORDERS, PRODUCTS, TableContract
from tidemark.functions.casting import CAST_FAILED, cast_to_schema
from tidemark.functions.rules import (
    ERRORS,
    VALID,
    missing,
    missing_or_not_positive,
    outside,
    tag_failures,
)
from tidemark.operators import audit, extract, merge, numbering, quality, star
from tidemark.operators.joins import hot_keys, salted_left_join
from tidemark.operators.latest import latest_per_key
from tidemark.plans import scenarios, shop
from tidemark.plans.shop import table
from tidemark.plans.versions import merge_and_publish
from tidemark.sources import bronze, snapshots, state
from tidemark.sources.storage import materialise, scratch_path
from tidemark.streaming.ingest import merge_available, read_files
from tidemark.streaming.marks import merge_new

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# The stored watermarks the queries start from, as text and, for
# operators that take it, as microseconds since 1970.
EVENTS_MARK = "2024-01-12 00:00:00"
EVENTS_MARK_MICROS = 1_705_017_600_000_000
SHIP_MARK = "1998-06-30 00:00:00"

LINE_KEYS = ["l_orderkey", "l_linenumber"]

CUSTOMER_RULES = {
    "null_primary_key": missing("c_custkey"),
    "no_credit": missing_or_not_positive("c_acctbal"),
    "unknown_segment": outside(
        "c_mktsegment", ("BUILDING", "AUTOMOBILE", "MACHINERY", "HOUSEHOLD")
    ),
}
PART_RULES = {
    "null_primary_key": missing("p_partkey"),
    "no_price": missing_or_not_positive("p_retailprice"),
    "unknown_type": outside("p_type", ("ECONOMY", "LARGE", "MEDIUM", "SMALL", "STANDARD")),
    "oversized": "p_size > 45",
}
LINE_RULES = {
    "no_quantity": missing_or_not_positive("l_quantity"),
    "untaxed_return": "l_returnflag = 'R' AND l_tax = 0",
}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def _ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _micros(column: str):
    return extract.micros(F.col(column)).alias(f"{column}_us")


def _event_columns() -> list:
    return ["event_id", _micros("ts"), "user_id", "event_type", "value", "props"]


# --- extraction ------------------------------------------------------------


@query
def incremental_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    high = extract.high_watermark(events, "ts")
    return extract.extract_window(events, "ts", EVENTS_MARK_MICROS, high).select(*_event_columns())


@query
def chunked_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as parts between quantiles of the watermark, each a scan and files of its own, read back."""
    events = table(spark, sf_dir, "events")
    bounds = extract.window_bounds(events, "ts", EVENTS_MARK_MICROS, extract.high_watermark(events, "ts"), 8)
    path = bronze.run_path(scratch_path(spark, "bronze"), "events", "r1")
    bronze.write_parts(extract.window_parts(events, "ts", bounds), path)
    return bronze.read_run(spark, path).select(*_event_columns())


@query
def bronze_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered CSV batch files, read back as text and cast to the contract."""
    events = table(spark, sf_dir, "events")
    path = bronze.run_path(scratch_path(spark, "bronze"), "events", "r1")
    bronze.write_run(events, path, fmt="csv", rows_per_file=100_000, order_by=["ts", "event_id"])
    raw = bronze.read_run(spark, path, fmt="csv")
    return cast_to_schema(raw, events.schema).select(*_event_columns())


@query
def source_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return bronze.preview(events.orderBy("ts", "event_id")).select(*_event_columns())


@query
def watermark_high(spark: SparkSession, sf_dir: str) -> DataFrame:
    high = extract.max_watermark(table(spark, sf_dir, "events"), "ts")
    return high.select(_micros("high_watermark"))


@query
def watermark_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Largest id, and the default for a column that is NULL throughout."""
    orders = table(spark, sf_dir, "orders").withColumn(
        "archived_key", F.when(F.col("o_orderkey") < 0, F.col("o_orderkey"))
    )
    known = extract.max_or_default(orders, "o_orderkey", 0, "value")
    unknown = extract.max_or_default(orders, "archived_key", 0, "value")
    return known.select(F.lit("known").alias("kind"), "value").unionAll(
        unknown.select(F.lit("unknown").alias("kind"), "value")
    )


@query
def watermark_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored marks by key, with the 1970 default for a table without one."""
    marks = (
        table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("source_table"))
        .agg(F.max("ts").cast("timestamp").alias("last_success_watermark"))
        .withColumn("pipeline_name", F.lit("shop"))
    )
    found = [
        state.find_watermark(marks, "shop", name).select(
            F.lit(name).alias("source_table"), _micros("low_watermark")
        )
        for name in ("click", "purchase", "refund")
    ]
    return reduce(DataFrame.unionAll, found)


@query
def extract_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    late = extract.late_rows(table(spark, sf_dir, "events"), "ts", EVENTS_MARK_MICROS)
    return late.groupBy("event_type").agg(F.count("*").alias("late_rows"))


@query
def chunk_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    chunks = numbering.assign_chunks(events, ["ts", "event_id"], 1000)
    return chunks.select("event_id", "chunk")


@query
def watermark_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later marks replace stored ones whatever their order."""
    events = table(spark, sf_dir, "events")
    keys = ["event_type", "user_id"]
    late = F.coalesce(F.col("ts") > _ntz(EVENTS_MARK), F.lit(False))
    stored = events.filter(~late).groupBy(*keys)
    coming = events.filter(late).groupBy(*keys)
    merged = merge.upsert_by_key(
        stored.agg(F.max("ts").alias("mark"), F.lit("stored").alias("status")),
        coming.agg(F.min("ts").alias("mark"), F.lit("incoming").alias("status")),
        keys,
    )
    return merged.select(*keys, _micros("mark"), "status")


@query
def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = (
        "region nation customer supplier part orders lineitem events documents "
        "embeddings pages benchmark labels conversations"
    ).split()
    counts = [
        extract.row_count(table(spark, sf_dir, name)).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name in names
    ]
    return reduce(DataFrame.unionAll, counts)


# --- contract and quality --------------------------------------------------


@query
def schema_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text columns to their contract types; error events carry malformed codes."""
    props = F.col("props")
    code = F.when(F.col("event_type") == "error", props).otherwise(
        F.substring(props, F.lit(7), F.length(props) - 7)
    )
    raw = table(spark, sf_dir, "events").select(
        F.concat(F.lit(" "), F.col("event_id").cast("string"), F.lit("  ")).alias("event_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"),
        F.col("value").cast("string").alias("value"),
        code.alias("code"),
        "event_type",
    )
    contract = StructType(
        [
            StructField("event_id", IntegerType()),
            StructField("ts", TimestampNTZType()),
            StructField("value", DecimalType(10, 2)),
            StructField("code", IntegerType()),
        ]
    )
    typed = cast_to_schema(raw, contract, trim=True, report_failures=True)
    return typed.select(
        "event_id",
        _micros("ts"),
        F.col("value").cast("double").alias("value"),
        "code",
        "event_type",
        F.array_join(CAST_FAILED, ",").alias(CAST_FAILED),
    )


@query
def rule_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = tag_failures(table(spark, sf_dir, "customer"), CUSTOMER_RULES)
    return tagged.select(
        "c_custkey",
        "err_null_primary_key",
        "err_no_credit",
        "err_unknown_segment",
        F.array_join(ERRORS, ",").alias(ERRORS),
        F.col(VALID).cast("int").alias(VALID),
    )


@query
def quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = quality.split_by_rules(table(spark, sf_dir, "part"), PART_RULES).quarantined
    return rejected.withColumn(ERRORS, F.array_join(ERRORS, ","))


@query
def clean_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.split_by_rules(table(spark, sf_dir, "part"), PART_RULES).clean


def _contract_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The given tables in the columns of the e-commerce contracts, with rows that break every rule."""
    category = F.create_map(*[F.lit(x) for x in (
        "ECONOMY", "Electronics", "LARGE", "Apparel", "MEDIUM", "Home & Kitchen", "SMALL", "Books", "STANDARD", "Beauty",
    )])
    stamp, size, balance = _ntz(EVENTS_MARK).cast("timestamp"), F.col("p_size"), F.col("c_acctbal")
    email = F.when(balance < 0, F.lit(None)).when(balance < 500, "nobody").otherwise(F.concat("c_name", F.lit("@example.com")))
    amount = F.col("l_extendedprice") * F.when((F.col("l_returnflag") == "R") & (F.col("l_tax") == 0), -1).otherwise(1)
    return {
        PRODUCTS.name: table(spark, sf_dir, "part").select(
            F.when(size != 7, F.col("p_partkey")).alias("product_id"), F.col("p_name").alias("product_name"),
            F.when(size == 1, 0).otherwise(F.col("p_retailprice")).alias("price"),
            F.when(size != 5, F.coalesce(category[F.col("p_type")], "p_type")).alias("category"),
            size.alias("stock_quantity"), stamp.alias("updated_at"),
        ),
        CUSTOMERS.name: table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("first_name"),
            F.col("c_name").alias("last_name"), email.alias("email"), F.col("c_mktsegment").alias("city"),
            stamp.alias("created_at"),
        ),
        ORDERS.name: table(spark, sf_dir, "lineitem").select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_id"), F.lit(1).alias("customer_id"),
            F.col("l_partkey").alias("product_id"),
            F.when(F.col("l_linenumber") != 7, F.col("l_quantity")).alias("quantity"),
            amount.alias("total_amount"), stamp.alias("updated_at"),
        ),
    }


@query
def contract_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that the rules of the e-commerce contracts reject, after the casts to their columns."""
    frames = _contract_frames(spark, sf_dir)
    found = []
    for contract in ECOMMERCE:
        typed = cast_to_schema(frames[contract.name].select(*contract.required_columns), contract.schema)
        rejected = quality.split_by_rules(typed, contract.rules).quarantined
        found.append(rejected.select(
            F.lit(contract.name).alias("table_name"), F.col(contract.key).cast("long").alias("row_key"),
            F.array_join(ERRORS, ",").alias(ERRORS),
        ))
    return reduce(DataFrame.unionAll, found)


@query
def rule_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    def breakdown(name: str, rules: dict[str, str]) -> DataFrame:
        rejected = quality.split_by_rules(table(spark, sf_dir, name), rules).quarantined
        return quality.failures_by_rule(rejected, rules).select(
            F.lit(name).alias("table_name"), "rule", "failures"
        )

    return breakdown("customer", CUSTOMER_RULES).unionAll(breakdown("part", PART_RULES))


def _metrics(spark: SparkSession, sf_dir: str, name: str, rules: dict, keys: list) -> DataFrame:
    tagged = tag_failures(table(spark, sf_dir, name), rules)
    return quality.quality_metrics(quality.tag_counts(tagged, rules, keys), name, "r1")


@query
def quality_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metrics(spark, sf_dir, "lineitem", LINE_RULES, LINE_KEYS).select(
        "pipeline_run_id",
        "table_name",
        "metrics.input_records_extracted",
        "metrics.clean_records_promoted",
        "metrics.quarantined_records_isolated",
        "metrics.duplicate_records_purged",
        F.col("metrics.data_health_yield_percentage")
        .cast("double")
        .alias("data_health_yield_percentage"),
        F.col("failures_by_rule_breakdown")["no_quantity"].alias("no_quantity"),
        F.col("failures_by_rule_breakdown")["untaxed_return"].alias("untaxed_return"),
        "execution_status",
    )


@query
def yield_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    gates = [
        _metrics(spark, sf_dir, "lineitem", LINE_RULES, LINE_KEYS),
        _metrics(spark, sf_dir, "customer", {"in_debt": "c_acctbal < -500"}, ["c_custkey"]),
        _metrics(spark, sf_dir, "part", PART_RULES, ["p_partkey"]),
    ]
    return reduce(DataFrame.unionAll, gates).select(
        "table_name",
        F.col("metrics.data_health_yield_percentage").cast("double").alias("yield_pct"),
        "execution_status",
    )


@query
def metrics_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.as_json(_metrics(spark, sf_dir, "customer", CUSTOMER_RULES, ["c_custkey"]))


# --- deduplication and merge -----------------------------------------------


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem")


def _dated(lines: DataFrame) -> DataFrame:
    return lines.withColumn("l_shipdate", F.to_date("l_shipdate"))


@query
def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dated(latest_per_key(_lines(spark, sf_dir), LINE_KEYS, "l_shipdate"))


@query
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of two frames whose columns come in different orders."""
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name")
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_suppkey").alias("id")
    )
    return customers.unionByName(suppliers)


@query
def silver_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State up to a mark and the batch after it, neither of them unique."""
    lines = _lines(spark, sf_dir)
    late = F.coalesce(F.col("l_shipdate") > _ntz(SHIP_MARK), F.lit(False))
    before, after = lines.filter(~late), lines.filter(late)
    return _dated(merge.merge_latest(before, after, LINE_KEYS, "l_shipdate"))


def _returned(lines: DataFrame) -> DataFrame:
    """Corrected rows of the returned lines, at their old timestamps."""
    returned = lines.filter(F.col("l_returnflag") == "R").withColumn("l_tax", F.lit(0.0))
    return latest_per_key(returned, LINE_KEYS, "l_shipdate")


@query
def silver_merge_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corrections merged into a published state without shuffling it, as long
    as their keys were measured to be small."""
    lines = _lines(spark, sf_dir)
    current = materialise(latest_per_key(lines, LINE_KEYS, "l_shipdate"), "state")
    batch = materialise(_returned(lines), "batch")
    return _dated(merge.merge_into_state(current, batch, LINE_KEYS, "l_shipdate"))


@query
def silver_merge_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for a batch too large to broadcast, without anything known of how the state is stored."""
    lines = _lines(spark, sf_dir)
    current = materialise(latest_per_key(lines, LINE_KEYS, "l_shipdate"), "state")
    batch = materialise(_returned(lines), "batch")
    return _dated(merge.merge_into_state(current, batch, LINE_KEYS, "l_shipdate", broadcast_limit=0))


@query
def silver_merge_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the state stored in buckets of its key, of which only the batch is shuffled."""
    lines = _lines(spark, sf_dir)
    root = scratch_path(spark, "state")
    merge_and_publish(latest_per_key(lines, LINE_KEYS, "l_shipdate"), root, LINE_KEYS, "l_shipdate")
    batch = materialise(_returned(lines), "batch")
    merge_and_publish(batch, root, LINE_KEYS, "l_shipdate")
    return _dated(snapshots.read_current(spark, root))


@query
def insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    existing = customers.filter(F.col("c_acctbal") >= 0)
    batch = customers.withColumn("c_mktsegment", F.lit("NEW"))
    return merge.insert_if_absent(existing, batch, ["c_custkey"], [F.col("c_name")])


@query
def append_new_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    stored = F.coalesce(F.col("o_orderstatus") == "F", F.lit(False))
    return merge.append_new(orders.filter(stored), orders.filter(~stored), ["o_orderkey"])


@query
def update_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts that were sold in lots of fifty get a new price and size."""
    lots = _lines(spark, sf_dir).filter(F.col("l_quantity") == 50)
    patches = lots.groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        F.max("l_extendedprice").alias("p_retailprice"), F.count("*").alias("p_size")
    )
    parts = table(spark, sf_dir, "part")
    return merge.update_by_key(parts, patches, ["p_partkey"], ["p_retailprice", "p_size"])


@query
def next_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers become customers under the keys after the last customer's."""
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return numbering.allocate_keys(
        table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "new_key"),
        suppliers,
        "new_key",
        ["s_suppkey"],
    )


@query
def sample_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey")
    return numbering.sample_by_hash(parts, "p_partkey", 25)


@query
def streaming_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest event per user, merged by a stream that stops when caught up."""
    schema = table(spark, sf_dir, "events").schema
    contract = TableContract("events", schema, key="user_id", watermark="ts")
    work = scratch_path(spark, "stream")
    # A pattern, because a stream takes a folder or a pattern but not one file.
    stream = read_files(spark, f"{sf_dir}/events.parque[t]", schema)
    merge_available(stream, f"{work}/table", contract, f"{work}/log").awaitTermination()
    return snapshots.read_current(spark, f"{work}/table", schema).select(*_event_columns())


@query
def streaming_by_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table from a stream whose offsets are watermarks, stopped and started again after
    the source has grown."""
    events = table(spark, sf_dir, "events")
    contract = TableContract("events", events.schema, key="user_id", watermark="ts")
    work = scratch_path(spark, "stream")
    late = F.coalesce(F.col("ts") > _ntz(EVENTS_MARK), F.lit(False))
    for grown in (events.filter(~late), events.filter(late)):
        grown.write.mode("append").parquet(f"{work}/source")
        merge_new(spark, f"{work}/source", f"{work}/table", contract, f"{work}/log").awaitTermination()
    return snapshots.read_current(spark, f"{work}/table", events.schema).select(*_event_columns())


# --- star schema -----------------------------------------------------------


def _clean_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products that pass validation; lines of the others stay unmatched."""
    rules = {
        "no_price": missing_or_not_positive("price"),
        "unknown_category": outside(
            "category", ("ECONOMY", "LARGE", "MEDIUM", "SMALL", "STANDARD")
        ),
    }
    return quality.split_by_rules(shop.products(spark, sf_dir), rules).clean


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.order_fact(
        shop.order_lines(spark, sf_dir),
        star.product_dimension(_clean_products(spark, sf_dir)),
        star.customer_dimension(shop.customers(spark, sf_dir)),
    )


def _fact_columns() -> list:
    return [
        "customer_id",
        "product_id",
        "order_id",
        "quantity",
        F.col("total_amount").cast("double").alias("total_amount"),
        "product_name",
        F.col("unit_price").cast("double").alias("unit_price"),
        "product_category",
        "customer_first_name",
        "customer_last_name",
        "customer_email",
        "customer_city",
        F.col("net_sales").cast("double").alias("net_sales"),
        "order_date",
    ]


def _revenue(df: DataFrame) -> DataFrame:
    return df.withColumn("total_revenue", F.col("total_revenue").cast("double"))


@query
def dim_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = star.product_dimension(shop.products(spark, sf_dir))
    return dim.withColumn("unit_price", F.col("unit_price").cast("double"))


@query
def dim_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.customer_dimension(shop.customers(spark, sf_dir))


@query
def fact_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fact(spark, sf_dir).select(*_fact_columns())


@query
def fact_orders_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact by shuffle joins, with keys of more than a 2,000th of the rows
    divided over several tasks."""
    lines = shop.order_lines(spark, sf_dir)
    fact = lines
    dims = {
        "product_id": star.product_dimension(_clean_products(spark, sf_dir)),
        "customer_id": star.customer_dimension(shop.customers(spark, sf_dir)),
    }
    share = max(1, _lines(spark, sf_dir).count() // 2000)
    for key, dim in dims.items():
        hot = hot_keys(lines, key, share)
        fact = salted_left_join(fact, dim.hint("merge"), key, ["order_id", "total_amount"], hot)
    return star.with_measures(fact).select(*_fact_columns())


@query
def daily_category_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _revenue(star.daily_category_sales(_fact(spark, sf_dir)))


@query
def daily_category_sales_presummed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same figures with the orders summed before a shuffle join."""
    sales = star.daily_category_sales_from_orders(
        shop.order_lines(spark, sf_dir),
        star.product_dimension(_clean_products(spark, sf_dir)),
        broadcast_limit=0,
    )
    return _revenue(sales)


@query
def revenue_total_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = shop.order_lines(spark, sf_dir).withColumn("order_date", F.to_date("updated_at"))
    return _revenue(star.revenue_by_amount(lines))


@query
def distinct_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.distinct_orders(_fact(spark, sf_dir))


@query
def fact_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range of days of the fact, from its date-partitioned table."""
    root = scratch_path(spark, "fact")
    fact = star.by_day(_fact(spark, sf_dir))
    snapshots.replace(fact, root, ["order_date"])
    stored = snapshots.read_current(spark, root, fact.schema)
    return star.sales_between(stored, "1997-01-01", "1997-03-31").select(*_fact_columns())


# --- audits and ledger -----------------------------------------------------


@query
def reconciliation_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and content of the order lines against the stored fact, which is not joined again."""
    fact = materialise(_fact(spark, sf_dir), "fact")
    lines = shop.line_columns(table(spark, sf_dir, "lineitem")).drop("o_orderkey")
    audited = audit.content_audit(lines, fact, lines.columns)
    return audited.withColumn("same_content", F.col("same_content").cast("int"))


@query
def pk_null_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULL keys of the fact, among them those of lines without a product."""
    return audit.null_keys(_fact(spark, sf_dir), ["order_id", "product_id", "product_name"])


@query
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.duplicate_keys(_lines(spark, sf_dir), LINE_KEYS)


QUERIES.update(scenarios.QUERIES)
