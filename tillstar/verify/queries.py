"""The registered queries, each over whole given tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.functions import AsOf, standardise
from tillstar.operators import (
    add_dense_key,
    add_group_size,
    clean,
    count_flags,
    dedupe,
    flag_unique,
    look_up,
    require,
    summarise,
    transform,
    validate,
)
from tillstar.operators.sizes import BROADCAST_BYTES
from tillstar.plans.pipeline import run_pipeline
from tillstar.plans.star import DIMENSIONS, FACTS, build_dimension, build_fact, key_table
from tillstar.plans.tables import TABLES
from tillstar.session import is_local, new_path, scratch, side_by_side, write_shared
from tillstar.sinks import jdbc, parquet
from tillstar.sources.calendar import build_dim_date
from tillstar.sources.csv import BAD_RECORD, extract_all, file_inventory, read_csv
from tillstar.sources.schemas import SCHEMAS
from tillstar.verify.bindings import given, source_table

CSV_ROWS = 1_000_000  # of a compressed file, which one task reads

AS_OF = AsOf(dt.date(2001, 1, 1), dt.datetime(2001, 1, 1))

Query = Callable[[SparkSession, str], DataFrame]


def wide_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return transform(source_table(spark, sf_dir, name), TABLES[name], AS_OF)


def cleaned(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return clean(source_table(spark, sf_dir, name), TABLES[name])


def quality(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return summarise(source_table(spark, sf_dir, name), TABLES[name], AS_OF)


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days from the first order to a month before the last, so some dates miss."""
    first, last = F.min("o_orderdate").cast("date"), F.max("o_orderdate").cast("date")
    bounds = given(spark, sf_dir, "orders").agg(
        first.alias("first"), F.date_sub(last, 31).alias("last")
    )
    limits = bounds.first()
    return build_dim_date(spark, str(limits["first"]), str(limits["last"]))


def dimension(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name == "dim_date":
        return calendar(spark, sf_dir)
    table = DIMENSIONS[name].table
    return build_dimension(name, write_shared(wide_table(spark, sf_dir, table), table))


def lookup_table(spark: SparkSession, sf_dir: str, name: str, *also: str) -> DataFrame:
    """What a fact needs of a dimension: ids and keys."""
    if name == "dim_date":
        return calendar(spark, sf_dir)
    layout = DIMENSIONS.get(name) or FACTS[name]
    ids = cleaned(spark, sf_dir, layout.table).select(layout.natural, *also)
    return key_table(name, write_shared(ids, name) if also else ids, *also)


def fact(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    layout = FACTS[name]
    also = {
        lookup.dimension: [c for c in lookup.take if not c.endswith("_key")]
        for lookup in layout.lookups
    }

    def build(table: str) -> DataFrame:
        if table in also:
            return lookup_table(spark, sf_dir, table, *also[table])
        return write_shared(wide_table(spark, sf_dir, table), table)

    tables = side_by_side(build, [layout.table, *also])
    return build_fact(name, tables[layout.table], tables)


def write_csv(df: DataFrame, path: str, **options: str | int) -> None:
    """Keep padding, quotes and line breaks as they are."""
    blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.options(header=True, escape='"', **blanks, **options).csv(path)


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "customers.csv")
    write_csv(source_table(spark, sf_dir, "customers"), path)
    return read_csv(spark, path, SCHEMAS["customers"])


def csv_folder(spark: SparkSession, sf_dir: str) -> str:
    """The twelve tables as CSV, in compressed files that hold no more rows than one task reads well."""
    folder, small = new_path(spark, "csv"), {"compression": "snappy", "maxRecordsPerFile": CSV_ROWS}
    side_by_side(
        lambda name: write_csv(source_table(spark, sf_dir, name), f"{folder}/{name}.csv", **small), TABLES
    )
    return folder


def csv_bad_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that are no numbers or dates stay as bad records; ``12.0`` is 12."""
    path = new_path(spark, "dirty.csv")
    id_, day = F.col("customer_id"), F.col("registration_date")
    dirty = source_table(spark, sf_dir, "customers").select(
        F.when(id_ % 10 == 3, F.concat(id_.cast("string"), F.lit(".0"))).otherwise(id_.cast("string")).alias("customer_id"),
        F.when(id_ % 31 == 5, F.date_format(day, "dd/MM/yyyy")).otherwise(day.cast("string")).alias("registration_date"),
        F.when(id_ % 29 == 4, F.lit("n/a")).otherwise(F.col("loyalty_points").cast("string")).alias("loyalty_points"),
    )
    write_csv(dirty, path)
    schema = "customer_id BIGINT, registration_date DATE, loyalty_points INT"
    rows = read_csv(spark, path, schema, multi_line=False, keep_bad=True)
    return rows.withColumnRenamed(BAD_RECORD, "bad_record")


def csv_line_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file whose fields hold line breaks and quotes, cut into its records by the quotes before them."""
    id_ = F.col("customer_id")
    note = (
        F.when(id_ % 7 == 1, F.concat(F.lit('said "so"\nand "went"\n'), F.col("address")))
        .when(id_ % 7 == 3, F.concat_ws("\n", F.array_repeat(F.col("city"), (id_ % 50).cast("int"))))
        .otherwise(F.col("address"))
    )
    rows = source_table(spark, sf_dir, "customers").filter("customer_id IS NOT NULL").select("customer_id", note.alias("note"), "age")
    path = new_path(spark, "breaks.csv")
    write_csv(rows, path)
    return read_csv(spark, path, "customer_id BIGINT, note STRING, age INT", by_quotes=True)


def csv_corrupt_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder with a file that is no gzip file, though its name says so: what was read, and what was left out."""
    path = new_path(spark, "products.csv")
    products = source_table(spark, sf_dir, "products")
    write_csv(products, path)
    write_csv(products, f"{path}-plain")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for file in files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}-plain/part-*")):
        files.rename(file.getPath(), spark._jvm.org.apache.hadoop.fs.Path(f"{path}/broken.csv.gz"))
        break
    read = read_csv(spark, path, SCHEMAS["products"], multi_line=False, skip_corrupt=True)
    rows = read.agg(F.lit("rows").alias("what"), F.lit("").alias("name"), F.count(F.lit(1)).alias("n"))
    left_out = file_inventory(spark, path).filter("state <> 'read'")
    return rows.unionByName(
        left_out.select(F.col("state").alias("what"), F.element_at(F.split("file", "/"), -1).alias("name"), F.lit(1).cast("long").alias("n"))
    )


def plain_value(df: DataFrame, column: str) -> Column:
    """A value as text or whole number, alike in every engine."""
    kind, value = df.schema[column].dataType.simpleString(), F.col(column)
    if kind == "string":
        return value
    if kind == "date":
        value = F.datediff(value, F.lit("1970-01-01"))
    elif kind == "timestamp":
        value = F.unix_timestamp(value)
    elif kind == "double":
        value = F.round(value * 100)
    return value.cast("bigint")


def column_total(df: DataFrame, column: str) -> Column:
    """A whole number that every value of the column has a part in."""
    value = plain_value(df, column)
    if df.schema[column].dataType.simpleString() == "string":
        value = F.length(value).cast("bigint")
    return F.coalesce(F.sum(value), F.lit(0))


def checksum(values: list[Column]) -> Column:
    """A sum of 32 bits of every row's hash: the same for the same rows in any order, and for no others."""
    row = F.concat_ws("|", *(F.coalesce(value.cast("string"), F.lit("-")) for value in values))
    return F.coalesce(F.sum(F.conv(F.left(F.md5(row), F.lit(8)), 16, 10).cast("bigint")), F.lit(0))


def one_scan(df: DataFrame) -> DataFrame:
    """Present values and total of every column, and the checksum, as one row; plain values are made once for both."""
    plain = {c: f"plain {c}" for c in df.columns}
    valued = df.select("*", *(plain_value(df, c).alias(label) for c, label in plain.items()))
    measures = {f"present {c}": F.count(c) for c in df.columns}
    for c, label in plain.items():
        measures[f"total {c}"] = column_total(valued, label)
    measures["checksum *"] = checksum([F.col(f"`{label}`") for label in plain.values()])
    return valued.agg(*(value.alias(label) for label, value in measures.items()))


def different_values(df: DataFrame) -> list[DataFrame]:
    """Different values of every column, counted for all columns of a kind at once, as one row a kind.

    A value goes through the shuffle with the number of its column alone, not
    beside a NULL for every other column.
    """
    kinds: dict[str, list[str]] = {}
    for field in df.schema.fields:
        kind = field.dataType.simpleString()
        kinds.setdefault("bigint" if kind in ("int", "boolean") else kind, []).append(field.name)
    counted = []
    for kind, columns in kinds.items():
        values = df.select(*(F.col(c).cast(kind).alias(f"{i}") for i, c in enumerate(columns)))
        different = values.unpivot([], values.columns, "of", "value").filter("value IS NOT NULL").distinct()
        counted.append(different.agg(*(F.count_if(F.col("of") == f"{i}").alias(f"different {c}") for i, c in enumerate(columns))))
    return counted


def extract_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twelve tables read from CSV: present and distinct values and total per column, and a checksum of their rows."""
    read = extract_all(spark, csv_folder(spark, sf_dir), multi_line=False)
    stored = side_by_side(lambda name: write_shared(read[name], f"read-{name}"), read)  # parsed once
    counts = []
    for name, df in stored.items():
        for one_row in (one_scan(df), *different_values(df)):
            long = one_row.unpivot([], [F.col(f"`{c}`") for c in one_row.columns], "label", "value")
            label = F.split("label", " ")
            counts.append(long.select(label[1].alias("column"), "value", F.lit(name).alias("table_name"), label[0].alias("measure")))
    return reduce(DataFrame.unionByName, counts)


def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "products")
    parquet.write_parquet(source_table(spark, sf_dir, "products"), path)
    return spark.read.parquet(path)


def parquet_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "orders")
    wide = wide_table(spark, sf_dir, "orders")
    parquet.write_parquet(wide, path, parquet.PARTITIONED_BY["orders"])
    return spark.read.schema(wide.schema).parquet(path)


def database(spark: SparkSession) -> jdbc.Database:
    """The one in ``tillstar.jdbc.url``; a local session may do with one in its own memory.

    ``tillstar.jdbc.driver`` names its driver class; without it Spark finds the driver by the URL.
    """
    url = spark.conf.get("tillstar.jdbc.url", None)
    driver = spark.conf.get("tillstar.jdbc.driver", None)
    if url is None:
        if not is_local(spark):
            raise ValueError("set tillstar.jdbc.url to a database that all executors can reach")
        url, driver = "jdbc:derby:memory:tillstar;create=true", "org.apache.derby.jdbc.EmbeddedDriver"
    return jdbc.Database(url, {"driver": driver} if driver else {}, connections=4)


def jdbc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = database(spark)
    jdbc.write_table(given(spark, sf_dir, "supplier"), target, "tillstar_supplier")
    stored = jdbc.read_table(spark, target, "tillstar_supplier", spread_by="s_suppkey")
    return stored.select(*(F.col(c).alias(c.lower()) for c in stored.columns))


def dedupe_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe(given(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def dedupe_counted_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per key as in a large table: only rows whose key repeats are ordered."""
    orders = require(source_table(spark, sf_dir, "orders"), ["order_id"])
    return dedupe(orders, ["order_id"], small_bytes=0)


def required_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = TABLES["shipments"]
    return require(source_table(spark, sf_dir, rules.name), [rules.key, *rules.required])


def failed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = validate(cleaned(spark, sf_dir, "orders"), TABLES["orders"], AS_OF)
    return checked.filter(~F.col("is_valid_discount")).select("order_id", "subtotal", "discount")


def text_standardise(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = TABLES["customers"].text
    columns = [c for group in text.values() for c in group]
    return standardise(source_table(spark, sf_dir, "customers"), text).select(
        "customer_id", *columns
    )


def project_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {"p_partkey": "product_id", "p_name": "product_name", "p_retailprice": "price"}
    part = given(spark, sf_dir, "part")
    return part.drop("p_brand", "p_type", "p_size").withColumnsRenamed(names)


def unique_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = {"is_unique_user": "user_id", "is_unique_ts": "ts"}
    return flag_unique(given(spark, sf_dir, "events"), "event_id", flags).select(
        "event_id", *flags
    )


def unique_flag_counted_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same flags as in a large table: rows stay in place, repeated values come to them."""
    flags = {"is_unique_user": "user_id", "is_unique_ts": "ts"}
    return flag_unique(given(spark, sf_dir, "events"), "event_id", flags, small_bytes=0).select(
        "event_id", *flags
    )


def group_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = (
        given(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey", "l_linenumber")
        .agg(F.min("l_partkey").alias("l_partkey"))
        .withColumn("line", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    )
    sized = add_group_size(lines, "line", "l_partkey", "part_count")
    return sized.select("l_orderkey", "l_linenumber", "part_count")


def surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = given(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return add_dense_key(orders, "o_orderkey", "order_key")


def key_lookup(
    spark: SparkSession, sf_dir: str, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    return look_up(
        given(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"),
        given(spark, sf_dir, "customer"),
        F.col("o_custkey"),
        "c_custkey",
        {"c_name": "c_name"},
        "o_orderkey",
        broadcast_bytes,
    )


def key_lookup_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lookup as if the dimension were too large to broadcast."""
    return key_lookup(spark, sf_dir, broadcast_bytes=0)


def date_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return look_up(
        given(spark, sf_dir, "events").select("event_id", "ts"),
        calendar(spark, sf_dir),
        F.to_date("ts"),
        "date",
        {"date_key": "date_key"},
        "event_id",
    ).drop("ts")


def role_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = calendar(spark, sf_dir)
    rows = cleaned(spark, sf_dir, "shipments").select(
        "shipment_id", "shipment_date", "delivery_date"
    )
    for role in ("shipment_date", "delivery_date"):
        rows = look_up(
            rows, dates, F.to_date(role), "date", {"date_key": f"{role}_key"}, "shipment_id"
        )
    return rows.drop("shipment_date", "delivery_date")


def snowflake_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cleaned(spark, sf_dir, "inventory").select("inventory_id", "product_id")
    take = {"product_key": "product_key", "supplier_id": "supplier_id"}
    products = lookup_table(spark, sf_dir, "dim_product", "supplier_id")
    rows = look_up(rows, products, F.col("product_id"), "product_id", take, "inventory_id")
    take = {"supplier_key": "supplier_key"}
    suppliers = lookup_table(spark, sf_dir, "dim_supplier")
    rows = look_up(rows, suppliers, F.col("supplier_id"), "supplier_id", take, "inventory_id")
    return rows.select("inventory_id", "product_key", "supplier_key")


def flag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = TABLES["orders"]
    return count_flags(
        validate(cleaned(spark, sf_dir, "orders"), rules, AS_OF), rules.flag_names()
    )


def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source and cleaned rows of a table, as one row."""
    n = F.count(F.lit(1))
    none = F.lit(0).cast("bigint")
    before = source_table(spark, sf_dir, "order_items").agg(n.alias("a")).select("a", none)
    after = cleaned(spark, sf_dir, "order_items").agg(n.alias("b")).select(none, "b")
    return (
        before.toDF("initial", "cleaned")
        .union(after)
        .agg(F.sum("initial").alias("rows_initial"), F.sum("cleaned").alias("rows_cleaned"))
    )


def whole_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From a folder of CSV files to every wide table, dimension and fact."""
    root, dates = new_path(spark, "run"), calendar(spark, sf_dir)
    with scratch(spark):  # each CSV file goes when its table is built
        return run_pipeline(spark, csv_folder(spark, sf_dir), root, AS_OF, dim_date=dates, use_up=True)


_runs: dict[tuple[str, str], str] = {}


def run_folder(spark: SparkSession, sf_dir: str) -> str:
    """Where a whole run over these tables has been written, once per application."""
    known = (spark.sparkContext.applicationId, sf_dir)
    if known not in _runs:
        root = new_path(spark, "run")
        layout = {"fact_orders": ["order_year", "order_month"]}
        with scratch(spark):  # each CSV file goes when its table is built
            run_pipeline(
                spark, csv_folder(spark, sf_dir), root, AS_OF, calendar(spark, sf_dir),
                facts_partitioned_by=layout, use_up=True,
            )
        _runs[known] = root
    return _runs[known]


def written(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A dimension or fact as the whole run has written it."""
    root = run_folder(spark, sf_dir)
    path = parquet.fact_path(root, name) if name in FACTS else parquet.dimension_path(root, name)
    return spark.read.parquet(path).drop("order_year", "order_month")


def warehouse_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension and a fact through the warehouse sink, counted from its files."""
    root = new_path(spark, "warehouse")
    dims = {"dim_store": dimension(spark, sf_dir, "dim_store")}
    facts = {"fact_returns": fact(spark, sf_dir, "fact_returns")}
    parquet.load_warehouse(dims, facts, root)
    stores = spark.read.parquet(parquet.dimension_path(root, "dim_store"))
    returns = spark.read.parquet(parquet.fact_path(root, "fact_returns"))
    one = lambda df, name, key: df.agg(F.count("*").alias("n"), F.sum(key).alias("keys")).select(
        F.lit(name).alias("table_name"), "n", "keys"
    )
    return one(stores, "dim_store", "store_key").unionByName(one(returns, "fact_returns", "return_key"))


def _per(names, build: Callable[[SparkSession, str, str], DataFrame], prefix: str = ""):
    return {
        prefix + name: lambda spark, sf_dir, name=name: build(spark, sf_dir, name)
        for name in names
    }


def queries() -> dict[str, Query]:
    return {
        "csv_roundtrip": csv_roundtrip,
        "csv_bad_records": csv_bad_records,
        "csv_line_breaks": csv_line_breaks,
        "csv_corrupt_files": csv_corrupt_files,
        "extract_all": extract_tables,
        "parquet_roundtrip": parquet_roundtrip,
        "parquet_partitioned": parquet_partitioned,
        "jdbc_roundtrip": jdbc_roundtrip,
        "dedupe_by_key": dedupe_by_key,
        "dedupe_counted_first": dedupe_counted_first,
        "required_keys": required_keys,
        "failed_rows": failed_rows,
        "text_standardise": text_standardise,
        "project_rename": project_rename,
        "unique_flag": unique_flag,
        "unique_flag_counted_first": unique_flag_counted_first,
        "group_size": group_size,
        "surrogate_key": surrogate_key,
        "key_lookup": key_lookup,
        "key_lookup_shuffled": key_lookup_shuffled,
        "date_lookup": date_lookup,
        "role_dates": role_dates,
        "snowflake_lookup": snowflake_lookup,
        "row_counts": row_counts,
        "flag_counts": flag_counts,
        **_per(TABLES, wide_table, "wide_"),
        **_per(TABLES, quality, "quality_"),
        **_per(["dim_date", *DIMENSIONS], dimension),
        **_per(FACTS, fact),
        "whole_run": whole_run,
        "warehouse_files": warehouse_files,
        **_per(["dim_customer", "fact_orders", "fact_inventory"], written, "written_"),
    }
