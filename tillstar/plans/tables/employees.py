from pyspark.sql import functions as F

from tillstar.functions import AsOf, band, is_one_of, is_positive_id, is_present, matches, years_between
from tillstar.operators.rules import TableRules

# Patterns, word lists, limits and labels.
EMAIL = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
PHONE = r"^\+91\d{10}$"
YOUNGEST = 18
GENDERS = ["Male", "Female", "Other"]
STATUSES = ["ACTIVE", "INACTIVE", "RESIGNED", "TERMINATED"]
ACTIVE = "ACTIVE"
MANAGER = "MANAGER"
SALARIES = [("<", 30000, "ENTRY"), ("<", 60000, "MID"), ("<", 100000, "SENIOR")]
BEST_PAID = "EXECUTIVE"
TENURES = [("<", 2, "JUNIOR"), ("<", 5, "MID"), ("<", 10, "SENIOR")]
LONGEST = "EXPERT"
DEPARTMENTS = [
    ("in", ["MANAGEMENT", "ADMINISTRATION"], "ADMIN"),
    ("in", ["SALES", "MARKETING"], "BUSINESS"),
]
OTHER_DEPARTMENT = "OPERATIONS"


def measured(as_of: AsOf):
    return {"employee_age": years_between(F.col("date_of_birth"), as_of.today).cast("int")}


def flags(as_of: AsOf):
    return {
        "is_valid_first_name": is_present("first_name"),
        "is_valid_phone": matches("phone_number", PHONE),
        "is_valid_email": matches("email", EMAIL),
        "is_unique_email": F.col("email_count") == 1,
        "is_valid_salary": F.col("salary") > 0,
        "is_valid_store_id": is_positive_id("store_id"),
        "is_valid_hire_date": F.col("hire_date") <= as_of.today,
        "is_valid_age": F.col("employee_age") >= YOUNGEST,
        "is_valid_gender": is_one_of("gender", GENDERS),
        "is_valid_status": is_one_of("status", STATUSES),
    }


def derived(as_of: AsOf):
    yield {
        "employee_tenure_years": years_between(F.col("hire_date"), as_of.today).cast("int"),
        "salary_band": band(F.col("salary"), SALARIES, BEST_PAID),
        "is_active_employee": F.col("status") == ACTIVE,
        "is_management": F.upper("designation").contains(MANAGER),
        "department_group": band(F.upper("department"), DEPARTMENTS, OTHER_DEPARTMENT),
    }
    yield {"experience_level": band(F.col("employee_tenure_years"), TENURES, LONGEST)}


# The columns that are added, in the order of the wide table.
ADDED = [
    "email_count",
    "is_valid_first_name",
    "is_valid_phone",
    "is_valid_email",
    "is_unique_email",
    "is_valid_salary",
    "is_valid_store_id",
    "is_valid_hire_date",
    "employee_age",
    "is_valid_age",
    "is_valid_gender",
    "is_valid_status",
    "employee_tenure_years",
    "salary_band",
    "experience_level",
    "is_active_employee",
    "is_management",
    "department_group",
]

RULES = TableRules(
    name="employees",
    key="employee_id",
    text={
        "title": ["first_name", "last_name", "gender", "department", "designation"],
        "upper": ["status"],
        "lower": ["email"],
        "trim": ["phone_number"],
    },
    group_sizes={"email_count": "email"},  # stays in the wide table
    measured=measured,
    flags=flags,
    derived=derived,
    added=ADDED,
)
