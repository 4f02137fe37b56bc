from pyspark.sql import functions as F

from tillstar.functions import AsOf, band, days_between, is_one_of, is_present
from tillstar.operators.rules import TableRules

# Word lists, limits and labels.
PERCENTAGE, FLAT, BOGO = TYPES = ["Percentage", "Flat", "Buy One Get One"]
PERCENT = (0, 100)
UPCOMING, ACTIVE, EXPIRED = STATUSES = ["UPCOMING", "ACTIVE", "EXPIRED"]
DISCOUNTS = [("<", 10, "LOW"), ("<", 30, "MEDIUM"), ("<", 50, "HIGH")]
DEEPEST = "MEGA"
LIFECYCLE = [("=", UPCOMING, "PLANNED"), ("=", ACTIVE, "RUNNING")]
OVER = "COMPLETED"


def flags(as_of: AsOf):
    kind, value = F.col("promotion_type"), F.col("discount_value")
    started = F.col("start_date") <= as_of.today
    return {
        "is_valid_promotion_name": is_present("promotion_name"),
        "is_valid_promotion_type": is_one_of("promotion_type", TYPES),
        "is_valid_discount_value": F.when(kind == PERCENTAGE, value.between(*PERCENT)).otherwise(
            value >= 0
        ),
        "is_valid_date_range": F.col("end_date") >= F.col("start_date"),
        "is_valid_coupon_code": is_present("coupon_code") & (F.length("coupon_code") > 0),
        "is_valid_minimum_order_amount": F.col("minimum_order_amount") >= 0,
        "is_valid_status": is_one_of("status", STATUSES),
        "is_valid_active_dates": F.when(F.col("status") == ACTIVE, started).otherwise(True),
    }


def derived(as_of: AsOf):
    kind = F.col("promotion_type")
    yield {
        "promotion_duration_days": days_between(F.col("start_date"), F.col("end_date")),
        "discount_category": band(F.col("discount_value"), DISCOUNTS, DEEPEST),
        "is_percentage_offer": kind == PERCENTAGE,
        "is_flat_offer": kind == FLAT,
        "is_bogo_offer": kind == BOGO,
        "promotion_lifecycle": band(F.col("status"), LIFECYCLE, OVER),
    }


RULES = TableRules(
    name="promotions",
    key="promotion_id",
    text={
        "title": ["promotion_type", "applicable_category"],
        "upper": ["coupon_code", "status"],
        "trim": ["promotion_name"],
    },
    flags=flags,
    derived=derived,
)
