"""The star schema: layouts of dimensions and facts, and how they are built."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.operators.keys import add_dense_key, number_keys
from tillstar.operators.lookup import heavy_hitters, look_up, narrowed
from tillstar.operators.sizes import BROADCAST_BYTES, known_size, measure
from tillstar.session import write_shared


@dataclass(frozen=True)
class Dimension:
    table: str  # wide table it is taken from
    key: str
    natural: str
    columns: Sequence[str]  # after the key, in order
    renamed: Mapping[str, str] = field(default_factory=dict)  # column -> its wide name


@dataclass(frozen=True)
class Lookup:
    dimension: str
    on: str  # column of the fact, or of an earlier lookup
    match: str  # column of the dimension
    take: Mapping[str, str]  # dimension column -> name in the fact
    value: Callable[[Column], Column] = lambda column: column


@dataclass(frozen=True)
class Fact:
    table: str
    key: str
    natural: str
    lookups: Sequence[Lookup]
    columns: Sequence[str]  # after the key, in order
    renamed: Mapping[str, str] = field(default_factory=dict)


def _by_id(dimension: str, on: str, key: str, **also: str) -> Lookup:
    return Lookup(dimension, on, on, {key: key, **also})


def _by_day(on: str, name: str = "date_key") -> Lookup:
    return Lookup("dim_date", on, "date", {"date_key": name}, F.to_date)


# The columns of every dimension and fact.
DIMENSIONS = {
    "dim_customer": Dimension(
        "customers",
        "customer_key",
        "customer_id",
        """customer_id first_name last_name full_name gender date_of_birth age_group email
        phone_number city state country postal_code registration_date customer_tenure_years
        income income_group loyalty_points loyalty_tier is_active""".split(),
        {"phone_number": "phone", "postal_code": "pincode", "income": "annual_income"},
    ),
    "dim_product": Dimension(
        "products",
        "product_key",
        "product_id",
        """product_id product_name category subcategory brand supplier_id sku barcode
        stock_unit cost_price selling_price gst_percentage calculated_profit_margin
        price_category gst_category reorder_level needs_reorder status is_available
        is_expired""".split(),
        {"subcategory": "sub_category"},
    ),
    "dim_store": Dimension(
        "stores",
        "store_key",
        "store_id",
        """store_id store_name store_type store_type_group status is_active_store address
        city state pincode phone_number email manager_name opening_date store_age_years
        store_size_sqft store_size_category""".split(),
    ),
    "dim_supplier": Dimension(
        "suppliers",
        "supplier_key",
        "supplier_id",
        """supplier_id supplier_name contact_person email phone address city state country
        gst_number business_category rating payment_terms payment_term_category
        lead_time_days lead_time_category contract_start_date contract_age_years status
        is_active_supplier""".split(),
    ),
    "dim_employee": Dimension(
        "employees",
        "employee_key",
        "employee_id",
        """employee_id first_name last_name gender date_of_birth employee_age phone_number
        email department department_group designation salary salary_band store_id
        hire_date employee_tenure_years experience_level status is_active_employee
        is_management""".split(),
    ),
    "dim_promotion": Dimension(
        "promotions",
        "promotion_key",
        "promotion_id",
        """promotion_id promotion_name promotion_type discount_value discount_category
        start_date end_date promotion_duration_days applicable_category
        minimum_order_amount coupon_code status promotion_lifecycle is_percentage_offer
        is_flat_offer is_bogo_offer""".split(),
    ),
}

FACTS = {
    "fact_orders": Fact(
        "orders",
        "order_key",
        "order_id",
        [
            _by_id("dim_customer", "customer_id", "customer_key"),
            _by_id("dim_store", "store_id", "store_key"),
            _by_id("dim_employee", "employee_id", "employee_key"),
            _by_id("dim_promotion", "promotion_id", "promotion_key"),
            _by_day("order_date"),
        ],
        """order_id date_key customer_key store_key employee_key promotion_key order_date
        subtotal discount tax total_amount discount_percentage net_revenue
        order_value_category order_status is_discount_applied""".split(),
    ),
    "fact_order_items": Fact(
        "order_items",
        "order_item_key",
        "order_item_id",
        [
            _by_id("fact_orders", "order_id", "order_key"),
            _by_id("dim_product", "product_id", "product_key"),
        ],
        """order_item_id order_key product_key quantity unit_price discount line_total
        gross_amount net_amount discount_percentage quantity_category line_value_category
        is_bulk_order is_discount_applied""".split(),
    ),
    "fact_payments": Fact(
        "payments",
        "payment_key",
        "payment_id",
        [_by_id("fact_orders", "order_id", "order_key"), _by_day("payment_date")],
        """payment_id order_key date_key payment_date payment_method payment_status
        amount_paid transaction_id payment_amount_category is_successful_payment
        is_failed_payment is_pending_payment is_refunded_payment
        is_digital_payment""".split(),
    ),
    "fact_shipments": Fact(
        "shipments",
        "shipment_key",
        "shipment_id",
        [
            _by_id("fact_orders", "order_id", "order_key"),
            _by_id("dim_store", "store_id", "store_key"),
            _by_day("shipment_date", "shipment_date_key"),
            _by_day("delivery_date", "delivery_date_key"),
        ],
        """shipment_id order_key store_key shipment_date_key delivery_date_key
        shipment_date delivery_date shipping_status courier_name tracking_number
        delivery_days delivery_speed shipment_age_days is_delivered is_in_transit
        is_pending is_returned is_cancelled""".split(),
    ),
    "fact_returns": Fact(
        "returns",
        "return_key",
        "return_id",
        [
            _by_id("fact_orders", "order_id", "order_key"),
            _by_id("dim_product", "product_id", "product_key"),
            _by_day("return_date", "return_date_key"),
        ],
        """return_id order_key product_key return_date_key return_date return_reason
        return_status refund_amount return_age_days refund_category requires_refund
        is_approved is_completed is_rejected""".split(),
        {
            "is_approved": "is_approved_return",
            "is_completed": "is_completed_return",
            "is_rejected": "is_rejected_return",
        },
    ),
    "fact_inventory": Fact(
        "inventory",
        "inventory_key",
        "inventory_id",
        [
            _by_id("dim_product", "product_id", "product_key", supplier_id="supplier_id"),
            _by_id("dim_store", "store_id", "store_key"),
            _by_id("dim_supplier", "supplier_id", "supplier_key"),
            _by_day("last_updated", "inventory_date_key"),
        ],
        """inventory_id product_key store_key supplier_key inventory_date_key
        last_stock_update current_stock reorder_level stock_difference inventory_age_days
        stock_category inventory_health needs_restock""".split(),
        {"last_stock_update": "last_updated", "current_stock": "quantity_on_hand"},
    ),
}


def build_dimension(name: str, wide: DataFrame) -> DataFrame:
    """The dimension's columns of a wide table, with a surrogate key in front."""
    layout = DIMENSIONS[name]
    columns = wide.select(
        *(F.col(layout.renamed.get(c, c)).alias(c) for c in layout.columns)
    )
    return add_dense_key(columns, layout.natural, layout.key)


def key_table(name: str, wide: DataFrame, *also: str) -> DataFrame:
    """Only the natural id and the key of a dimension or of ``fact_orders``.

    Enough to look keys up, from any table that holds the id; ``also`` names
    further columns of ``wide`` to carry along.
    """
    layout = DIMENSIONS[name] if name in DIMENSIONS else FACTS[name]
    if not also:
        return number_keys(wide, layout.natural, layout.key)
    return add_dense_key(wide.select(layout.natural, *also), layout.natural, layout.key)


def build_fact(
    name: str,
    wide: DataFrame,
    tables: Mapping[str, DataFrame],
    broadcast_bytes: int = BROADCAST_BYTES,
    rows_of: Mapping[str, int] = {},
) -> DataFrame:
    """The fact: surrogate key, keys looked up in ``tables``, measures.

    Lookups never add or drop a row; an id or day that the dimension does not
    hold gives a NULL key.  Where some dimension is too large to broadcast, all
    keys are found for the ids alone and meet the measures in one last join, so
    the wide rows are shuffled once, however many such dimensions there are.
    ``wide`` and ``tables`` should be stored: parts of them are read on their own.
    ``rows_of`` tells the rows of tables whose count is known; others are counted.
    """
    layout = FACTS[name]
    found = {column for lookup in layout.lookups for column in lookup.take.values()}
    source = {c: layout.renamed.get(c, c) for c in layout.columns if c not in found}
    ids = {layout.natural, *(lookup.on for lookup in layout.lookups)} - found
    measures = sorted(set(source.values()) - ids)

    narrow = [narrowed(tables[k.dimension], k.match, k.take) for k in layout.lookups]
    told = [known_size(table, rows_of.get(k.dimension)) for table, k in zip(narrow, layout.lookups)]
    counted = iter(measure([table for table, size in zip(narrow, told) if size is None]))
    sizes = [next(counted) if size is None else size for size in told]
    apart = max(sizes) > broadcast_bytes
    first = sorted(ids) if apart else [*sorted(ids), *measures]
    # All ids of the fact that meet a large dimension, in one pass; chained ones are not known yet.
    large = {k.on: k.value(F.col(k.on)) for k, size in zip(layout.lookups, sizes) if size > broadcast_bytes}
    known = {on: key for on, key in large.items() if on in wide.columns}
    partitions = int(wide.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = heavy_hitters(wide, known, partitions) if known else {}
    rows = add_dense_key(wide.select(*first), layout.natural, layout.key)
    for lookup, size in zip(layout.lookups, sizes):
        if size > broadcast_bytes and lookup.on not in wide.columns:
            rows = write_shared(rows, name)  # a chained lookup counts these ids before it joins them
        rows = look_up(
            rows,
            tables[lookup.dimension],
            lookup.value(F.col(lookup.on)),
            lookup.match,
            lookup.take,
            spread_by=layout.natural,
            broadcast_bytes=broadcast_bytes,
            size=size,
            hot=hot.get(lookup.on),
        )
    if apart:
        rows = wide.select(layout.natural, *measures).join(rows, layout.natural, "left")
    return rows.select(
        layout.key, *(F.col(source.get(c, c)).alias(c) for c in layout.columns)
    )
