"""Surrogate keys, lookups and uniqueness, with hot keys and large dimensions."""

from __future__ import annotations

import contextlib
import io
import random

import pytest
from pyspark.sql import functions as F

from oracle import DATA
from tillstar.operators import add_dense_key, add_group_size, dedupe, flag_unique, look_up, require
from tillstar.operators.clean import first_per_key
from tillstar.operators.keys import number_sorted, store_sorted
from tillstar.operators.lookup import heavy_hitters, hot_keys
from tillstar.operators.sizes import known_size, measure, stored_with_size
from tillstar.plans.star import build_fact
from tillstar.verify import queries as registered

SF = str(DATA / "sf0.001")


def plan(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


@pytest.fixture(scope="module")
def skewed(spark):
    """30,000 rows: a third on key 7, a sixth on NULL, the rest spread over 1,000 keys."""
    key = (
        F.when(F.col("id") % 3 == 0, F.lit(7))
        .when(F.col("id") % 6 == 1, F.lit(None))
        .otherwise(F.col("id") % 1000)
    )
    return spark.range(30_000).select(F.col("id").alias("row"), key.cast("bigint").alias("k"))


@pytest.fixture(scope="module")
def dimension(spark):
    """Keys 0 to 899, so some rows find nothing."""
    return spark.range(900).select(F.col("id").alias("n"), F.concat(F.lit("v"), "id").alias("v"))


def test_keys_are_dense_and_ordered(spark):
    ids = spark.range(0, 50_000, 7).select(F.concat(F.lit("x"), F.col("id")).alias("id"))
    rows = add_dense_key(ids.repartition(13), "id", "key").orderBy("id").collect()
    assert [r.key for r in rows] == list(range(1, len(rows) + 1))


def test_keys_of_an_empty_table(spark):
    assert add_dense_key(spark.range(0), "id", "key").collect() == []


def test_keys_do_not_change_when_computed_again(spark):
    rows = registered.surrogate_key(spark, SF)
    assert sorted(rows.collect()) == sorted(registered.surrogate_key(spark, SF).collect())


def test_no_task_sees_the_whole_table(spark):
    for name in ("surrogate_key", "dedupe_by_key", "unique_flag", "wide_payments", "wide_employees"):
        assert "SinglePartition" not in plan(registered.queries()[name](spark, SF)), name


def test_copies_shrink_before_the_shuffle(spark):
    text = plan(first_per_key(spark.range(9).select((F.col("id") % 2).alias("k"), "id"), ["k"], ["id"]))
    steps = [line for line in text.splitlines() if "WindowGroupLimit" in line or "Exchange" in line]
    assert "WindowGroupLimit" in steps[0] and "WindowGroupLimit" in steps[2]
    assert "Exchange" in steps[1]


def test_filter_and_columns_reach_the_scan(spark):
    text = plan(registered.project_rename(spark, SF))
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string,p_retailprice:double>" in text
    # The bindings compute their keys, so a stored column shows that the filter goes first.
    text = plan(dedupe(require(registered.given(spark, SF, "orders"), ["o_orderkey"]), ["o_orderkey"]))
    assert "PushedFilters: [IsNotNull(o_orderkey)]" in text


def test_small_dimensions_are_broadcast_and_large_ones_shuffled(spark):
    assert "BroadcastHashJoin" in plan(registered.key_lookup(spark, SF))
    text = plan(registered.key_lookup_shuffled(spark, SF))
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text


def test_measure_counts_rows_and_text(spark, dimension):
    assert measure([spark.range(10), dimension]) == [160, 900 * 32 + sum(len(f"v{i}") for i in range(900))]


def test_sizes_of_numbers_need_no_count(spark, dimension):
    assert known_size(spark.range(10), 10) == measure([spark.range(10)])[0]
    assert known_size(dimension, 900) is None and known_size(spark.range(10), None) is None
    stored, size = stored_with_size(dimension, "test")
    assert size == measure([dimension])[0] and stored.count() == 900


def test_hot_keys_are_found(skewed):
    assert hot_keys(skewed, F.col("k"), 8) == {4: [7]}  # 10,015 rows, 3,750 on average


@pytest.mark.parametrize("limit", [0, 1 << 30])
def test_lookup_is_whole_under_skew(spark, skewed, dimension, limit):
    found = look_up(skewed, dimension, F.col("k"), "n", {"v": "v"}, "row", broadcast_bytes=limit)
    rows = found.collect()
    assert len(rows) == 30_000
    assert all(r.v == (None if r.k is None or r.k >= 900 else f"v{r.k}") for r in rows)


def test_hot_rows_are_spread(spark, skewed, dimension):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = look_up(skewed, dimension, F.col("k"), "n", {"v": "v"}, "row", broadcast_bytes=0)
        sizes = found.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(r["count"] for r in sizes) < 3 * 30_000 / 8


@pytest.mark.parametrize("sizes", [(1 << 26, 0), (0, 0), (0, 1 << 26)])
def test_uniqueness_under_skew(skewed, sizes):
    rows = flag_unique(skewed, "row", {"u": "k"}, *sizes).collect()
    values = [r.k for r in rows]
    assert len(rows) == 30_000
    once = {k for k in set(values) if values.count(k) == 1}
    assert all(r.u == (r.k in once) for r in rows)


@pytest.mark.parametrize("sizes", [(1 << 26, 0), (0, 0), (0, 1 << 26)])
def test_group_sizes_under_skew(skewed, sizes):
    rows = add_group_size(skewed, "row", "k", "n", *sizes).collect()
    sizes: dict = {}
    for r in rows:
        sizes[r.k] = sizes.get(r.k, 0) + 1
    assert len(rows) == 30_000
    assert all(r.n == sizes[r.k] for r in rows)


@pytest.mark.parametrize("name", ["fact_orders", "fact_order_items", "fact_inventory"])
def test_facts_do_not_depend_on_the_join_strategy(spark, name):
    layout = registered.FACTS[name]
    also = {"dim_product": ["supplier_id"]} if name == "fact_inventory" else {}
    tables = {
        k.dimension: registered.lookup_table(spark, SF, k.dimension, *also.get(k.dimension, []))
        for k in layout.lookups
    }
    wide = registered.wide_table(spark, SF, layout.table)
    shuffled = build_fact(name, wide, tables, broadcast_bytes=0)
    assert sorted(map(str, shuffled.collect())) == sorted(
        map(str, registered.fact(spark, SF, name).collect())
    )


def test_facts_keep_every_row_and_resolve_every_key(spark):
    wide = registered.wide_table(spark, SF, "order_items")
    fact = registered.fact(spark, SF, "fact_order_items")
    assert fact.count() == wide.count()
    products = registered.dimension(spark, SF, "dim_product")
    keys = fact.filter("product_key IS NOT NULL")
    assert keys.join(products, "product_key", "left_anti").count() == 0


def test_days_outside_the_calendar_have_no_key(spark):
    fact = registered.fact(spark, SF, "fact_orders")
    last = registered.calendar(spark, SF).agg(F.max("date")).first()[0]
    late = fact.filter(F.to_date("order_date") > F.lit(last))
    assert late.count() > 0
    assert late.filter("date_key IS NOT NULL").count() == 0
    assert fact.filter("order_date IS NULL AND date_key IS NOT NULL").count() == 0


@pytest.mark.parametrize("sizes", [(1 << 26, 0), (0, 0), (0, 1 << 26)])
def test_dedupe_agrees_with_plain_python(spark, sizes):
    draw = random.Random(5)
    rows = [
        (
            7 if draw.random() < 0.33 else draw.randrange(300),
            draw.choice([None, "a", "b", "c"]),
            draw.choice([None, -1.5, 0.0, 2.5]),
            draw.choice([None, True, False]),
        )
        for _ in range(4_000)
    ]
    first: dict = {}
    for row in rows:
        rank = [(v is None, v if v is not None else 0) for v in row[1:]]
        if row[0] not in first or rank < first[row[0]][0]:
            first[row[0]] = (rank, row)
    df = spark.createDataFrame(rows, "k int, a string, b double, c boolean").repartition(11)
    kept = {r.k: tuple(r) for r in dedupe(df, ["k"], None, *sizes).collect()}
    assert kept == {k: row for k, (_, row) in first.items()}


def test_even_keys_are_not_hot_however_many_partitions(spark):
    even = spark.range(30_000).select((F.col("id") % 10_000).alias("k"))
    assert hot_keys(even, F.col("k"), 20_000) == {}


@pytest.mark.parametrize("sizes", [(1 << 26, 0), (0, 0), (0, 1 << 26)])
def test_uniqueness_of_two_columns(spark, sizes):
    rows = [(1, "a", 1.0), (2, "a", None), (3, None, 2.0), (4, "1.0", 2.0), (5, "z", 0.0), (6, "y", -0.0)]
    flags = {"u": "a", "v": "b"}
    found = flag_unique(spark.createDataFrame(rows, "id int, a string, b double"), "id", flags, *sizes).collect()
    assert {r.id: (r.u, r.v) for r in found} == {
        1: (False, True), 2: (False, True), 3: (True, False), 4: (True, False), 5: (True, False), 6: (True, False),
    }


def exchanges(df) -> int:
    return plan(df).split("\n\n")[0].count(" Exchange (")


def test_flags_cost_one_exchange_by_value_and_one_by_key(spark):
    """Beyond what may be broadcast, however many flags there are: values, keys, and the rows' own."""
    rows = spark.range(40).select("id", (F.col("id") % 7).alias("a"), (F.col("id") % 9).alias("b"), (F.col("id") % 3).alias("c"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert exchanges(flag_unique(rows, "id", {"u": "a"}, 0, 0)) == 3
        assert exchanges(flag_unique(rows, "id", {"u": "a", "v": "b", "w": "c"}, 0, 0)) == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert exchanges(flag_unique(rows, "id", {"u": "a", "v": "b", "w": "c"}, 0)) == 0


def test_rows_of_single_keys_are_neither_sorted_nor_shuffled(spark):
    rows = spark.range(1000).select(F.when(F.col("id") > 995, 5).otherwise(F.col("id")).alias("k"), F.lit("x").alias("v"))
    kept = dedupe(rows, ["k"], small_bytes=0)
    assert kept.count() == 996 and "LeftAnti" in plan(kept) and "LeftSemi" in plan(kept)
    assert exchanges(kept) == 1  # of the few rows that share a key
    assert exchanges(dedupe(spark.range(9), ["id"], small_bytes=0)) == 0


def test_keys_of_columns_that_may_be_null(spark):
    rows = [(None, 1, "b"), (None, 1, "a"), (2, None, "c"), (2, None, None), (2, 3, "d")]
    df = spark.createDataFrame(rows, "a int, b int, v string")
    for sizes in ((1 << 26, 0), (0, 0), (0, 1 << 26)):
        assert sorted(map(str, dedupe(df, ["a", "b"], None, *sizes).collect())) == sorted(
            ["Row(a=None, b=1, v='a')", "Row(a=2, b=None, v='c')", "Row(a=2, b=3, v='d')"]
        )


def test_numbers_come_from_files_and_places(spark):
    rows = spark.range(5_000).select(F.concat(F.lit("k"), F.col("id")).alias("k"), F.lit("wide").alias("w")).repartition(7)
    path = store_sorted(rows, "k", "test")
    numbered = number_sorted(spark, path, rows.schema, "k", "n")
    text = plan(numbered)
    assert "SortMergeJoin" not in text and exchanges(numbered) == 0
    order = sorted(f"k{i}" for i in range(5_000))
    assert {r.k: r.n for r in numbered.collect()} == {k: i + 1 for i, k in enumerate(order)}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")  # files are cut, rows keep their places
    try:
        assert sorted(numbered.collect()) == sorted(number_sorted(spark, path, rows.schema, "k", "n").collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_one_pass_finds_the_hot_keys_of_all_columns(spark, skewed):
    rows = skewed.withColumn("t", F.when(F.col("row") % 4 == 0, "hot").otherwise(F.col("row").cast("string")))
    found = heavy_hitters(rows, {"k": F.col("k"), "t": F.col("t"), "row": F.col("row")}, 8)
    assert found == {"k": {4: [7]}, "t": {2: ["hot"]}, "row": {}}


def test_counts_of_the_sketch_stay_within_its_error(spark):
    """Every key with a third more rows than an average partition is found, none with a third less."""
    skewed = spark.range(400_000).select(F.pow(F.rand(3) * 60_000, F.lit(1.0)).cast("long").alias("k"), F.rand(4).alias("r"))
    rows = skewed.select(F.when(F.col("r") < 0.3, (F.col("k") % 40) * (F.col("k") % 3)).otherwise(F.col("k") + 100).alias("k"))
    rows = rows.repartition(6)
    exact = {r.k: r["count"] for r in rows.groupBy("k").count().collect()}
    for partitions in (20, 200):
        hot = {k for keys in hot_keys(rows, F.col("k"), partitions).values() for k in keys}
        average = 400_000 / partitions
        assert {k for k, n in exact.items() if n > max(50, average * 4 / 3)} <= hot
        assert all(exact[k] > average * 2 / 3 for k in hot)


def test_parts_are_bounded(spark, skewed):
    hot = hot_keys(skewed, F.col("k"), 500)
    assert sum(n * len(keys) for n, keys in hot.items()) < 2 * 500
