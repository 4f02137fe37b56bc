from pyspark.sql import functions as F

from tillstar.functions import AsOf, band, is_one_of, is_present, matches, matches_whole, years_between
from tillstar.operators.rules import TableRules

# Patterns, word lists, limits and labels.
EMAIL = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
PHONE = r"^\d{10}$"
GST_NUMBER = r"^[0-9]{2}[A-Z]{5}[0-9]{4}[A-Z][1-9A-Z]Z[0-9A-Z]$"
RATING = (1, 5)
STATUSES = ["ACTIVE", "INACTIVE"]
ACTIVE = "ACTIVE"
RATINGS = [(">=", 5, "EXCELLENT"), (">=", 4, "GOOD"), (">=", 3, "AVERAGE")]
WORST = "POOR"
LEAD_TIMES = [("<=", 7, "FAST"), ("<=", 15, "NORMAL")]
SLOWEST = "SLOW"
TERMS = [("has", "30", "SHORT TERM"), ("has", "60", "MEDIUM TERM")]
OTHER_TERM = "LONG TERM"


def flags(as_of: AsOf):
    return {
        "is_valid_supplier_name": is_present("supplier_name"),
        "is_valid_contact_person": is_present("contact_person"),
        "is_valid_email": matches("email", EMAIL),
        "is_valid_phone": matches_whole("phone", PHONE),
        "is_valid_gst": matches("gst_number", GST_NUMBER),
        "is_valid_rating": F.col("rating").between(*RATING),
        "is_valid_lead_time": F.col("lead_time_days") > 0,
        "is_valid_contract_date": F.col("contract_start_date") <= as_of.today,
        "is_valid_status": is_one_of("status", STATUSES),
    }


def derived(as_of: AsOf):
    yield {
        "contract_age_years": years_between(F.col("contract_start_date"), as_of.today),
        "supplier_rating_category": band(F.col("rating"), RATINGS, WORST),
        "lead_time_category": band(F.col("lead_time_days"), LEAD_TIMES, SLOWEST),
        "is_active_supplier": F.col("status") == ACTIVE,
        "payment_term_category": band(F.col("payment_terms"), TERMS, OTHER_TERM),
    }


# The columns that are added, in the order of the wide table.
ADDED = [
    "is_valid_supplier_name",
    "is_valid_contact_person",
    "is_valid_email",
    "is_valid_phone",
    "is_unique_gst",
    "is_valid_gst",
    "is_valid_rating",
    "is_valid_lead_time",
    "is_valid_contract_date",
    "is_valid_status",
    "contract_age_years",
    "supplier_rating_category",
    "lead_time_category",
    "is_active_supplier",
    "payment_term_category",
]

RULES = TableRules(
    name="suppliers",
    key="supplier_id",
    text={
        "title": ["contact_person", "city", "state", "country", "business_category"],
        "upper": ["gst_number", "status"],
        "lower": ["email"],
        "trim": ["supplier_name", "address", "payment_terms"],
    },
    unique={"is_unique_gst": "gst_number"},
    flags=flags,
    derived=derived,
    added=ADDED,
)
