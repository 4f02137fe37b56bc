from pyspark.sql import functions as F

from tillstar.functions import AsOf, band, days_between, is_one_of, is_positive_id, is_present
from tillstar.operators.rules import TableRules

# Word lists, limits and labels.  Couriers are compared as
# written, in upper case, while their names are only trimmed.
STATUSES = [
    "PENDING",
    "SHIPPED",
    "IN TRANSIT",
    "OUT FOR DELIVERY",
    "DELIVERED",
    "RETURNED",
    "CANCELLED",
]
COURIERS = [
    "DTDC",
    "BLUE DART",
    "DELHIVERY",
    "EKART",
    "XPRESSBEES",
    "INDIA POST",
    "ECOM EXPRESS",
]
SPEEDS = [("<=", 2, "EXPRESS"), ("<=", 5, "STANDARD")]
SLOWEST = "ECONOMY"


def flags(as_of: AsOf):
    return {
        "is_valid_order_id": is_positive_id("order_id"),
        "is_valid_store_id": is_positive_id("store_id"),
        "is_valid_tracking_number": is_present("tracking_number"),
        "is_valid_shipment_date": F.col("shipment_date") <= as_of.today,
        "is_valid_delivery_date": F.col("delivery_date") >= F.col("shipment_date"),
        "is_valid_shipping_status": is_one_of("shipping_status", STATUSES),
        "is_valid_courier": is_one_of("courier_name", COURIERS),
    }


def derived(as_of: AsOf):
    shipped, status = F.col("shipment_date"), F.col("shipping_status")
    yield {
        "delivery_days": days_between(shipped, F.col("delivery_date")),
        "is_delivered": status == "DELIVERED",
        "is_in_transit": status == "IN TRANSIT",
        "is_pending": status == "PENDING",
        "is_returned": status == "RETURNED",
        "is_cancelled": status == "CANCELLED",
        "shipment_age_days": days_between(shipped, as_of.today),
    }
    yield {"delivery_speed": band(F.col("delivery_days"), SPEEDS, SLOWEST)}


# The columns that are added, in the order of the wide table.
ADDED = [
    "is_valid_order_id",
    "is_valid_store_id",
    "is_valid_tracking_number",
    "is_unique_tracking_number",
    "is_valid_shipment_date",
    "is_valid_delivery_date",
    "is_valid_shipping_status",
    "is_valid_courier",
    "delivery_days",
    "delivery_speed",
    "is_delivered",
    "is_in_transit",
    "is_pending",
    "is_returned",
    "is_cancelled",
    "shipment_age_days",
]

RULES = TableRules(
    name="shipments",
    key="shipment_id",
    required=["order_id", "store_id"],
    text={"upper": ["shipping_status"], "trim": ["courier_name", "tracking_number"]},
    unique={"is_unique_tracking_number": "tracking_number"},
    flags=flags,
    derived=derived,
    added=ADDED,
)
