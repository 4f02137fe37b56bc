from pyspark.sql import functions as F

from tillstar.functions import AsOf, band, days_between, matches
from tillstar.operators.rules import TableRules

# Patterns, limits and labels.
EMAIL = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
PHONE = r"^\+?\d{10,15}$"
PINCODE = r"^[0-9]{6}$"
AGES = (18, 100)
AGE_GROUPS = [("<=", 25, "Young Adult"), ("<", 40, "Adult"), ("<", 60, "Middle Age")]
OLDEST = "Senior Citizen"
INCOME_GROUPS = [("<", 300000, "Low Income"), ("<", 700000, "Middle Income")]
RICHEST = "High Income"
LOYALTY_TIERS = [("<", 1000, "Bronze"), ("<", 5000, "Silver"), ("<", 10000, "Gold")]
MOST_LOYAL = "Platinum"
ACTIVE = "Active"


def flags(as_of: AsOf):
    return {
        "is_valid_email": matches("email", EMAIL),
        "is_valid_phone": matches("phone", PHONE),
        "is_valid_age": F.col("age").between(*AGES),
        "is_valid_income": F.col("annual_income") >= 0,
        "is_valid_pincode": matches("pincode", PINCODE),
        "is_valid_registration_date": F.col("registration_date") <= as_of.today,
    }


def derived(as_of: AsOf):
    tenure = F.floor(days_between(F.col("registration_date"), as_of.today) / 365)
    yield {
        "full_name": F.concat_ws(" ", "first_name", "last_name"),
        "customer_tenure_years": F.when(F.col("is_valid_registration_date"), tenure),
        "age_group": band(F.col("age"), AGE_GROUPS, OLDEST),
        "income_group": band(F.col("annual_income"), INCOME_GROUPS, RICHEST),
        "loyalty_tier": band(F.col("loyalty_points"), LOYALTY_TIERS, MOST_LOYAL),
        "is_verified_customer": F.col("email_verified") & F.col("phone_verified"),
        # Case matters here and a missing status means inactive, unlike elsewhere.
        "is_active": F.coalesce(F.col("status") == ACTIVE, F.lit(False)),
    }


RULES = TableRules(
    name="customers",
    key="customer_id",
    text={
        "title": ["first_name", "last_name", "city"],
        "upper": ["state", "country"],
        "lower": ["email"],
        "trim": [
            "gender",
            "phone",
            "address",
            "segment",
            "preferred_payment",
            "occupation",
            "marital_status",
            "status",
        ],
    },
    flags=flags,
    derived=derived,
)
