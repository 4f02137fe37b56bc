from pyspark.sql import functions as F

from tillstar.functions import AsOf, band, days_between, is_one_of, is_positive_id, percent_of, rounds_to
from tillstar.operators.rules import TableRules

# Word list, limits and labels.
PENDING, COMPLETED, CANCELLED = STATUSES = ["PENDING", "COMPLETED", "CANCELLED"]
VALUES = [("<", 1000, "Low Value"), ("<", 5000, "Medium Value")]
HIGHEST = "High Value"


def net():
    return (F.col("subtotal") - F.col("discount")) + F.col("tax")


def flags(as_of: AsOf):
    subtotal, discount, tax = F.col("subtotal"), F.col("discount"), F.col("tax")
    return {
        "is_valid_customer_id": is_positive_id("customer_id"),
        "is_valid_store_id": is_positive_id("store_id"),
        "is_valid_employee_id": is_positive_id("employee_id"),
        "is_valid_promotion_id": F.col("promotion_id").isNull() | (F.col("promotion_id") > 0),
        # A timestamp against a date: any later hour of today lies in the future.
        "is_valid_order_date": F.col("order_date") <= as_of.today,
        "isvalid_subtotal": subtotal > 0,
        "is_valid_discount": (discount >= 0) & (discount <= subtotal),
        "is_valid_tax": (tax >= 0) & (tax <= subtotal),
        "is_valid_total_amount": rounds_to(F.col("total_amount"), net()),
        "is_valid_order_status": is_one_of("order_status", STATUSES),
    }


def derived(as_of: AsOf):
    date, subtotal, status = F.col("order_date"), F.col("subtotal"), F.col("order_status")
    yield {
        "order_age_days": F.when(F.col("is_valid_order_date"), days_between(date, as_of.today)),
        "order_month": F.date_format(date, "MMMM"),
        "order_year": F.year(date),
        "order_quarter": F.concat(F.lit("Q"), F.quarter(date)),
        "discount_percentage": F.when(subtotal > 0, percent_of(F.col("discount"), subtotal)),
        "net_revenue": net(),
        "order_value_category": band(F.col("total_amount"), VALUES, HIGHEST),
        "is_completed_order": status == COMPLETED,
        "is_pending_order": status == PENDING,
        "is_cancelled_order": status == CANCELLED,
        "is_discount_applied": F.col("discount") > 0,
    }


RULES = TableRules(
    name="orders",
    key="order_id",
    text={"upper": ["order_status"]},
    flags=flags,
    derived=derived,
)
