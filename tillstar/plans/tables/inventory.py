from pyspark.sql import functions as F

from tillstar.functions import AsOf, days_between, is_one_of, is_positive_id
from tillstar.operators.rules import TableRules

# Word list and labels.
STATUSES = ["IN STOCK", "LOW STOCK", "OUT OF STOCK"]
STOCK = {"none": "OUT OF STOCK", "low": "LOW STOCK", "medium": "MEDIUM STOCK", "high": "HIGH STOCK"}
HEALTH = {"none": "CRITICAL", "low": "ATTENTION", "fine": "HEALTHY"}


def flags(as_of: AsOf):
    return {
        "is_valid_store_id": is_positive_id("store_id"),
        "is_valid_product_id": is_positive_id("product_id"),
        "is_valid_quantity": F.col("quantity_on_hand") >= 0,
        "is_valid_reorder_level": F.col("reorder_level") >= 0,
        "is_valid_stock_status": is_one_of("stock_status", STATUSES),
        "is_valid_restock_date": F.col("last_restock_date") <= as_of.today,
        "is_valid_last_updated": F.col("last_updated") >= F.col("last_restock_date"),
    }


def derived(as_of: AsOf):
    stock, level = F.col("quantity_on_hand"), F.col("reorder_level")
    none, low = stock == 0, stock <= level
    medium = stock <= level.cast("long") * 2
    yield {
        "needs_restock": low,
        "inventory_age_days": days_between(F.col("last_restock_date"), as_of.today),
        "stock_difference": stock - level,
        "stock_category": F.when(none, STOCK["none"])
        .when(low, STOCK["low"])
        .when(medium, STOCK["medium"])
        .otherwise(STOCK["high"]),
        "inventory_health": F.when(none, HEALTH["none"])
        .when(low, HEALTH["low"])
        .otherwise(HEALTH["fine"]),
    }


# The columns that are added, in the order of the wide table.
ADDED = [
    "is_valid_store_id",
    "is_valid_product_id",
    "is_valid_quantity",
    "is_valid_reorder_level",
    "is_valid_stock_status",
    "is_valid_restock_date",
    "is_valid_last_updated",
    "needs_restock",
    "inventory_age_days",
    "stock_category",
    "stock_difference",
    "inventory_health",
]

RULES = TableRules(
    name="inventory",
    key="inventory_id",
    required=["store_id", "product_id"],
    text={"upper": ["stock_status"]},
    flags=flags,
    derived=derived,
    added=ADDED,
)
