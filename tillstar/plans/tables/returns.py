from pyspark.sql import functions as F

from tillstar.functions import AsOf, band, days_between, is_one_of, is_positive_id
from tillstar.operators.rules import TableRules

# Word lists, limits and labels.
REASONS = [
    "Damaged",
    "Wrong Item",
    "Defective",
    "Quality Issue",
    "Changed Mind",
    "Expired Product",
    "Other",
]
REQUESTED, APPROVED, REJECTED, COMPLETED = STATUSES = [
    "REQUESTED",
    "APPROVED",
    "REJECTED",
    "COMPLETED",
]
REFUNDS = [("<", 1000, "LOW"), ("<", 5000, "MEDIUM"), ("<", 10000, "HIGH")]
HIGHEST = "PREMIUM"


def flags(as_of: AsOf):
    return {
        "is_valid_order_id": is_positive_id("order_id"),
        "is_valid_product_id": is_positive_id("product_id"),
        "is_valid_return_date": F.col("return_date") <= as_of.today,
        "is_valid_return_reason": is_one_of("return_reason", REASONS),
        "is_valid_refund_amount": F.col("refund_amount") >= 0,
        "is_valid_return_status": is_one_of("return_status", STATUSES),
    }


def derived(as_of: AsOf):
    status = F.col("return_status")
    yield {
        "return_age_days": days_between(F.col("return_date"), as_of.today),
        "refund_category": band(F.col("refund_amount"), REFUNDS, HIGHEST),
        "is_approved_return": status == APPROVED,
        "is_completed_return": status == COMPLETED,
        "is_rejected_return": status == REJECTED,
        "requires_refund": is_one_of("return_status", [APPROVED, COMPLETED]),
    }


RULES = TableRules(
    name="returns",
    key="return_id",
    required=["order_id", "product_id"],
    text={"title": ["return_reason"], "upper": ["return_status"]},
    flags=flags,
    derived=derived,
)
