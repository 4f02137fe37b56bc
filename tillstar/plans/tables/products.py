from pyspark.sql import functions as F

from tillstar.functions import AsOf, band, days_between, is_present, matches, percent_of
from tillstar.operators.rules import TableRules

# Pattern, limits and labels.
SUPPLIER_ID = r"^SUP\d{5}$"
PERCENT = (0, 100)
ACTIVE = "ACTIVE"
PRICES = [("<", 500, "Budget"), ("<", 2000, "Standard")]
DEAREST = "Premium"
GST = [
    ("=", 0, "GST Exempt"),
    ("<=", 5, "Low GST"),
    ("<=", 12, "Standard GST"),
    ("<=", 18, "High GST"),
]
HIGHEST_GST = "Luxury GST"


def flags(as_of: AsOf):
    active = F.col("status") == ACTIVE
    expired = F.col("expiry_date") < as_of.today
    return {
        "is_valid_product_name": is_present("product_name"),
        "is_valid_supplier_id": matches("supplier_id", SUPPLIER_ID),
        "is_valid_cost_price": F.col("cost_price") > 0,
        "is_valid_selling_price": F.col("selling_price") >= F.col("cost_price"),
        "is_valid_gst": F.col("gst_percentage").between(*PERCENT),
        "is_valid_reorder_level": F.col("reorder_level") >= 0,
        "is_valid_manufacture_date": F.col("manufacture_date") <= as_of.today,
        "is_valid_expiry_date": F.col("expiry_date") > F.col("manufacture_date"),
        "is_valid_product_status": ~(active & expired),
    }


def derived(as_of: AsOf):
    cost, price = F.col("cost_price"), F.col("selling_price")
    yield {
        # In percent of the price, though it is the cost that must be positive.
        "calculated_profit_margin": F.when(cost > 0, percent_of(price - cost, price)),
        "price_category": band(price, PRICES, DEAREST),
        "gst_category": band(F.col("gst_percentage"), GST, HIGHEST_GST),
        "is_available": F.col("status") == ACTIVE,
        "is_expired": F.col("expiry_date") < as_of.today,
        "days_to_expiry": days_between(as_of.today, F.col("expiry_date")),
        # Stock at hand is not known in this table.
        "needs_reorder": F.col("reorder_level") > 0,
    }


# The columns that are added, in the order of the wide table.
ADDED = [
    "is_valid_product_name",
    "is_unique_sku",
    "is_unique_barcode",
    "is_valid_supplier_id",
    "is_valid_cost_price",
    "is_valid_selling_price",
    "is_valid_gst",
    "is_valid_reorder_level",
    "is_valid_manufacture_date",
    "is_valid_expiry_date",
    "is_valid_product_status",
    "calculated_profit_margin",
    "price_category",
    "gst_category",
    "is_available",
    "is_expired",
    "days_to_expiry",
    "needs_reorder",
]

RULES = TableRules(
    name="products",
    key="product_id",
    text={
        "title": ["product_name", "category", "sub_category", "brand"],
        "upper": ["stock_unit", "status"],
        "trim": ["sku", "barcode"],
    },
    unique={"is_unique_sku": "sku", "is_unique_barcode": "barcode"},
    flags=flags,
    derived=derived,
    added=ADDED,
)
