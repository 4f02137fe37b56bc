"""NULL rules, bands and flags on tiny literal frames."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillstar.functions import AsOf, band
from tillstar.operators import clean, count_flags, dedupe, flag_unique, require, transform, validate
from tillstar.operators.rules import derive
from tillstar.plans.tables import TABLES
from tillstar.sources.schemas import SCHEMAS

AS_OF = AsOf(dt.date(2001, 1, 1), dt.datetime(2001, 1, 1))


def rows_of(spark, table: str, *rows: dict):
    """A frame of the table's schema; columns left out are NULL."""
    empty = spark.createDataFrame([], SCHEMAS[table])
    values = [tuple(row.get(c) for c in empty.columns) for row in rows]
    return spark.createDataFrame(values, empty.schema)


def wide(spark, table: str, *rows: dict):
    return transform(rows_of(spark, table, *rows), TABLES[table], AS_OF)


def column(df, key: str, name: str) -> dict:
    return {r[key]: r[name] for r in df.collect()}


def test_missing_keys_are_dropped_and_copies_collapse(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (None, "c"), (None, "d")], "k int, v string")
    assert [tuple(r) for r in dedupe(require(df, ["k"]), ["k"]).collect()] == [(1, "a")]


def test_survivor_has_nulls_last(spark):
    df = spark.createDataFrame([(1, None, 1), (1, "z", 2)], "k int, v string, w int")
    assert [tuple(r) for r in dedupe(df, ["k"]).collect()] == [(1, "z", 2)]


def test_survivor_by_given_order(spark):
    df = spark.createDataFrame([(1, "a", 9), (1, "b", 3)], "k int, v string, w int")
    assert [r.v for r in dedupe(df, ["k"], ["w"]).collect()] == ["b"]


def test_required_reference_is_tested_on_the_survivor(spark):
    df = rows_of(
        spark,
        "payments",
        {"payment_id": 1, "order_id": None, "amount_paid": 5.0},
        {"payment_id": 1, "order_id": 7, "amount_paid": 9.0},
        {"payment_id": 2, "order_id": None},
    )
    assert [r.order_id for r in clean(df, TABLES["payments"]).collect()] == [7]


def test_unknown_flags_are_not_failures(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "f boolean")
    counts = {r.metric: r.value for r in count_flags(df, ["f"]).collect()}
    assert counts == {"f.passed": 1, "f.failed": 1, "f.unknown": 1}


def test_nulls_count_as_one_group(spark):
    df = spark.createDataFrame([(1, "x"), (2, None), (3, None)], "k int, t string")
    assert column(flag_unique(df, "k", {"u": "t"}), "k", "u") == {1: True, 2: False, 3: False}
    lone = spark.createDataFrame([(1, "x"), (2, None)], "k int, t string")
    assert column(flag_unique(lone, "k", {"u": "t"}), "k", "u") == {1: True, 2: True}


def test_age_bands_send_null_to_the_last(spark):
    ages = [25, 26, 39, 40, 59, 60, None]
    df = wide(spark, "customers", *({"customer_id": i, "age": a} for i, a in enumerate(ages)))
    assert [v for _, v in sorted(column(df, "customer_id", "age_group").items())] == [
        "Young Adult",
        "Adult",
        "Adult",
        "Middle Age",
        "Middle Age",
        "Senior Citizen",
        "Senior Citizen",
    ]
    assert set(column(df, "customer_id", "income_group").values()) == {"High Income"}
    assert set(column(df, "customer_id", "loyalty_tier").values()) == {"Platinum"}


def test_customer_status_is_case_sensitive_and_never_null(spark):
    states = ["Active", " Active ", "active", None]
    df = wide(spark, "customers", *({"customer_id": i, "status": s} for i, s in enumerate(states)))
    assert column(df, "customer_id", "is_active") == {0: True, 1: True, 2: False, 3: False}


def test_other_statuses_are_upper_cased_and_may_be_null(spark):
    states = ["active ", "Inactive", None]
    df = wide(spark, "stores", *({"store_id": i, "status": s} for i, s in enumerate(states)))
    assert column(df, "store_id", "is_active_store") == {0: True, 1: False, 2: None}


def test_four_kinds_of_age(spark):
    day = dt.date(2000, 1, 2)  # 365 days before
    customer = wide(spark, "customers", {"customer_id": 1, "registration_date": day})
    employee = wide(spark, "employees", {"employee_id": 1, "hire_date": dt.date(1999, 1, 1)})
    store = wide(spark, "stores", {"store_id": 1, "opening_date": dt.date(2000, 7, 2)})
    supplier = wide(spark, "suppliers", {"supplier_id": "a", "contract_start_date": day})
    types = {f.name: f.dataType.simpleString() for df in (customer, employee, store, supplier) for f in df.schema}
    assert types["customer_tenure_years"] == "bigint"
    assert types["employee_tenure_years"] == "int"
    assert types["store_age_years"] == types["contract_age_years"] == "double"
    assert customer.first().customer_tenure_years == 1
    assert employee.first().employee_tenure_years == 2
    assert store.first().store_age_years == pytest.approx(183 / 365)


def test_future_registration_has_no_tenure(spark):
    df = wide(spark, "customers", {"customer_id": 1, "registration_date": dt.date(2001, 1, 2)})
    assert df.first().is_valid_registration_date is False
    assert df.first().customer_tenure_years is None


def test_quantity_bands_overlap_bulk(spark):
    quantities = [1, 5, 6, 10, 11, None]
    df = wide(
        spark,
        "order_items",
        *({"order_item_id": i, "quantity": q} for i, q in enumerate(quantities)),
    )
    bands = column(df, "order_item_id", "quantity_category")
    bulk = column(df, "order_item_id", "is_bulk_order")
    assert bands == {
        0: "Single Item",
        1: "Small Order",
        2: "Bulk Order",
        3: "Bulk Order",
        4: "Large Bulk Order",
        5: "Large Bulk Order",
    }
    assert bulk == {0: False, 1: True, 2: True, 3: True, 4: True, 5: None}


def test_terms_with_30_win_over_60(spark):
    terms = ["Net 30", "Net 60", "Net 3060", None]
    df = wide(
        spark, "suppliers", *({"supplier_id": f"s{i}", "payment_terms": t} for i, t in enumerate(terms))
    )
    assert [v for _, v in sorted(column(df, "supplier_id", "payment_term_category").items())] == [
        "SHORT TERM",
        "MEDIUM TERM",
        "SHORT TERM",
        "LONG TERM",
    ]


def test_margin_needs_cost_and_price(spark):
    prices = [(10.0, 0.0), (0.0, 10.0), (8.0, 10.0)]
    df = wide(
        spark,
        "products",
        *({"product_id": i, "cost_price": c, "selling_price": s} for i, (c, s) in enumerate(prices)),
    )
    assert column(df, "product_id", "calculated_profit_margin") == {0: None, 1: None, 2: 20.0}


def test_reorder_looks_at_the_level_only(spark):
    df = wide(spark, "products", *({"product_id": i, "reorder_level": r} for i, r in enumerate([0, 1, None])))
    assert column(df, "product_id", "needs_reorder") == {0: False, 1: True, 2: None}


def test_odd_flag_names_stay(spark):
    assert "isvalid_subtotal" in wide(spark, "orders", {"order_id": 1}).columns
    assert "is_valid_Quantity" in wide(spark, "order_items", {"order_item_id": 1}).columns


def test_email_count_stays_and_helpers_go(spark):
    df = wide(
        spark,
        "employees",
        {"employee_id": 1, "email": "A@b.cd"},
        {"employee_id": 2, "email": " a@B.cd "},
        {"employee_id": 3},
    )
    assert column(df, "employee_id", "email_count") == {1: 2, 2: 2, 3: 1}
    assert column(df, "employee_id", "is_unique_email") == {1: False, 2: False, 3: True}
    for table, rules in TABLES.items():
        helpers = [c for c in wide(spark, table, {rules.key: 1}).columns if c.startswith("_")]
        assert helpers == []


def test_today_at_ten_is_in_the_future(spark):
    times = [dt.datetime(2001, 1, 1), dt.datetime(2001, 1, 1, 10)]
    df = wide(spark, "orders", *({"order_id": i, "order_date": t} for i, t in enumerate(times)))
    assert column(df, "order_id", "is_valid_order_date") == {0: True, 1: False}
    assert column(df, "order_id", "order_age_days") == {0: 0, 1: None}


def test_couriers_are_compared_as_written(spark):
    names = [" EKART ", "Ekart", None]
    df = wide(
        spark,
        "shipments",
        *(
            {"shipment_id": i, "order_id": 1, "store_id": 1, "courier_name": n}
            for i, n in enumerate(names)
        ),
    )
    assert column(df, "shipment_id", "is_valid_courier") == {0: True, 1: False, 2: None}
    assert set(column(df, "shipment_id", "delivery_speed").values()) == {"ECONOMY"}


def test_extra_source_columns_pass_through(spark):
    df = rows_of(spark, "stores", {"store_id": 1}).withColumn("region", F.lit("north"))
    assert transform(df, TABLES["stores"], AS_OF).first().region == "north"


def test_flags_drop_no_row(spark):
    bad = rows_of(spark, "orders", {"order_id": 1, "subtotal": -1.0}, {"order_id": 2})
    assert validate(clean(bad, TABLES["orders"]), TABLES["orders"], AS_OF).count() == 2


def test_clock_defaults_to_today(spark):
    today = dt.date.today()
    df = rows_of(spark, "returns", {"return_id": 1, "order_id": 1, "product_id": 1, "return_date": today})
    assert transform(df, TABLES["returns"]).first().return_age_days in (0, 1)


def test_band_takes_the_first_cut(spark):
    df = spark.range(3).select(band(F.col("id"), [("<", 1, "a"), ("<=", 1, "b")], "c").alias("x"))
    assert [r.x for r in df.collect()] == ["a", "b", "c"]


def test_added_columns_stand_in_their_order(spark):
    for rules in TABLES.values():
        if not rules.added:
            continue
        source = spark.createDataFrame([], SCHEMAS[rules.name])
        wide = transform(source, rules, AS_OF).columns
        loose = derive(validate(clean(source, rules), rules, AS_OF), rules, AS_OF).columns
        assert wide == [*source.columns, *rules.added]
        assert sorted(wide) == sorted(loose)
