from pyspark.sql import functions as F

from tillstar.functions import AsOf, band, is_positive_id, percent_of, rounds_to
from tillstar.operators.rules import TableRules

# Limits and labels.  Five pieces are a small order and bulk.
QUANTITIES = [("=", 1, "Single Item"), ("<=", 5, "Small Order"), ("<=", 10, "Bulk Order")]
LARGEST = "Large Bulk Order"
BULK_FROM = 5
VALUES = [("<", 1000, "Low Value"), ("<", 5000, "Medium Value")]
HIGHEST = "High Value"


def gross():
    return F.col("quantity") * F.col("unit_price")


def flags(as_of: AsOf):
    discount = F.col("discount")
    return {
        "is_valid_order_id": is_positive_id("order_id"),
        "is_valid_product_id": is_positive_id("product_id"),
        "is_valid_Quantity": F.col("quantity") > 0,
        "is_valid_unit_price": F.col("unit_price") > 0,
        "is_valid_discount": (discount >= 0) & (discount <= gross()),
        "is_valid_line_total": rounds_to(F.col("line_total"), gross() - discount),
    }


def derived(as_of: AsOf):
    quantity, discount = F.col("quantity"), F.col("discount")
    yield {
        "gross_amount": gross(),
        "discount_percentage": F.when(gross() > 0, percent_of(discount, gross())),
        "net_amount": gross() - discount,
        "quantity_category": band(quantity, QUANTITIES, LARGEST),
        "is_bulk_order": quantity >= BULK_FROM,
        "line_value_category": band(F.col("line_total"), VALUES, HIGHEST),
        "is_discount_applied": discount > 0,
    }


RULES = TableRules(name="order_items", key="order_item_id", flags=flags, derived=derived)
