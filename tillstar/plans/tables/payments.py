from pyspark.sql import functions as F

from tillstar.functions import AsOf, band, is_one_of, is_positive_id, is_present
from tillstar.operators.rules import TableRules

# Word lists, limits and labels.
METHODS = ["CASH", "CARD", "UPI", "NET BANKING", "WALLET"]
DIGITAL = ["UPI", "CARD", "NET BANKING", "WALLET"]
SUCCESS, FAILED, PENDING, REFUNDED = STATUSES = ["SUCCESS", "FAILED", "PENDING", "REFUNDED"]
AMOUNTS = [("<", 1000, "LOW"), ("<", 5000, "MEDIUM"), ("<", 10000, "HIGH")]
HIGHEST = "PREMIUM"


def flags(as_of: AsOf):
    return {
        "is_valid_order_id": is_positive_id("order_id"),
        "is_valid_amount_paid": F.col("amount_paid") >= 0,
        "is_valid_transaction_id": is_present("transaction_id"),
        "is_valid_payment_method": is_one_of("payment_method", METHODS),
        "is_valid_payment_status": is_one_of("payment_status", STATUSES),
        "is_valid_payment_date": F.col("payment_date") <= as_of.now,
    }


def derived(as_of: AsOf):
    status = F.col("payment_status")
    yield {
        "is_successful_payment": status == SUCCESS,
        "is_failed_payment": status == FAILED,
        "is_pending_payment": status == PENDING,
        "is_refunded_payment": status == REFUNDED,
        "payment_amount_category": band(F.col("amount_paid"), AMOUNTS, HIGHEST),
        "is_digital_payment": is_one_of("payment_method", DIGITAL),
    }


# The columns that are added, in the order of the wide table.
ADDED = [
    "is_valid_order_id",
    "is_valid_amount_paid",
    "is_valid_transaction_id",
    "is_unique_transaction_id",
    "is_valid_payment_method",
    "is_valid_payment_status",
    "is_valid_payment_date",
    "is_successful_payment",
    "is_failed_payment",
    "is_pending_payment",
    "is_refunded_payment",
    "payment_amount_category",
    "is_digital_payment",
]

RULES = TableRules(
    name="payments",
    key="payment_id",
    required=["order_id"],
    text={"upper": ["payment_method", "payment_status"], "trim": ["transaction_id"]},
    unique={"is_unique_transaction_id": "transaction_id"},
    flags=flags,
    derived=derived,
    added=ADDED,
)
