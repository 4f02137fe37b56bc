from pyspark.sql import functions as F

from tillstar.functions import AsOf, band, is_one_of, is_present, matches, matches_whole, years_between
from tillstar.operators.rules import TableRules

# Patterns, word lists, limits and labels.
EMAIL = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
PHONE = r"^\+91\d{10}$"
PINCODE_LENGTH = 6
TYPES = ["EXPRESS STORE", "SUPERMARKET", "HYPERMARKET", "WHOLESALE", "FLAGSHIP STORE"]
STATUSES = ["ACTIVE", "INACTIVE", "UNDER MAINTENANCE"]
ACTIVE = "ACTIVE"
SIZES = [("<", 10000, "SMALL"), ("<", 30000, "MEDIUM"), ("<", 60000, "LARGE")]
LARGEST = "MEGA"
TYPE_GROUPS = [
    ("has", "EXPRESS", "SMALL FORMAT"),
    ("has", "SUPER", "RETAIL"),
    ("has", "HYPER", "LARGE FORMAT"),
]
OTHER_TYPE = "OTHER"


def flags(as_of: AsOf):
    return {
        "is_valid_store_name": is_present("store_name"),
        "is_valid_store_type": F.upper("store_type").isin(*TYPES),
        "is_valid_status": is_one_of("status", STATUSES),
        "is_valid_phone": matches_whole("phone_number", PHONE),
        "is_valid_email": matches("email", EMAIL),
        "is_valid_pincode": F.length(F.col("pincode").cast("string")) == PINCODE_LENGTH,
        "is_valid_opening_date": F.col("opening_date") <= as_of.today,
        "is_valid_store_size": F.col("store_size_sqft") > 0,
    }


def derived(as_of: AsOf):
    yield {
        "store_age_years": years_between(F.col("opening_date"), as_of.today),
        "store_size_category": band(F.col("store_size_sqft"), SIZES, LARGEST),
        "is_active_store": F.col("status") == ACTIVE,
        "store_type_group": band(F.upper("store_type"), TYPE_GROUPS, OTHER_TYPE),
    }


RULES = TableRules(
    name="stores",
    key="store_id",
    text={
        "title": ["city", "state", "manager_name"],
        "upper": ["status"],
        "lower": ["email"],
        "trim": ["store_name", "store_type", "address"],
    },
    flags=flags,
    derived=derived,
)
