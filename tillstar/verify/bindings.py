"""The given tables seen as the twelve source tables.

One SELECT per source table, over whole tables, in SQL that Spark and DuckDB
read alike.  They plant what real extracts hold: padding, mixed case, NULLs,
repeated keys, numbers out of range, broken e-mails and phones, future dates,
references to nothing.  ``{table}`` stands for a given table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

SOURCES = {
    "customers": """
        SELECT
            CAST(CASE WHEN c_custkey % 97 = 96 THEN NULL WHEN c_custkey % 50 = 49 THEN c_custkey - 1 ELSE c_custkey END AS BIGINT) AS customer_id,
            CAST('  ' || lower(c_mktsegment) || ' ' AS STRING) AS first_name,
            CAST(upper(c_name) AS STRING) AS last_name,
            CAST(CASE c_custkey % 3 WHEN 0 THEN 'Male ' WHEN 1 THEN 'Female' WHEN 2 THEN NULL END AS STRING) AS gender,
            CAST(DATE '1940-01-01' + CAST(c_custkey * 37 % 21000 AS INT) AS DATE) AS date_of_birth,
            CAST(c_custkey * 7 % 110 AS INT) AS age,
            CAST(CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN 'bad mail' ELSE ' User' || CAST(c_custkey AS STRING) || '@Shop.COM ' END AS STRING) AS email,
            CAST(CASE WHEN c_custkey % 13 = 0 THEN '12345' ELSE '+91' || CAST(9000000000 + c_custkey AS STRING) END AS STRING) AS phone,
            CAST(' ' || c_name AS STRING) AS address,
            CAST('new CITY ' || CAST(c_nationkey AS STRING) AS STRING) AS city,
            CAST(' st' || CAST(c_nationkey AS STRING) AS STRING) AS state,
            CAST('india' AS STRING) AS country,
            CAST(CASE WHEN c_custkey % 17 = 0 THEN 999 ELSE 100000 + c_custkey % 900000 END AS INT) AS pincode,
            CAST(c_mktsegment AS STRING) AS segment,
            CAST(CASE c_custkey % 2 WHEN 0 THEN 'UPI' WHEN 1 THEN ' CARD' END AS STRING) AS preferred_payment,
            CAST(CASE c_custkey % 3 WHEN 0 THEN 'Engineer' WHEN 1 THEN 'Teacher ' WHEN 2 THEN NULL END AS STRING) AS occupation,
            CAST(CASE c_custkey % 2 WHEN 0 THEN 'Single' WHEN 1 THEN 'Married' END AS STRING) AS marital_status,
            CAST(CASE c_custkey % 4 WHEN 0 THEN 'Active' WHEN 1 THEN ' Active ' WHEN 2 THEN 'Inactive' WHEN 3 THEN NULL END AS STRING) AS status,
            CAST(DATE '1994-01-01' + CAST(c_custkey * 13 % 3000 AS INT) AS DATE) AS registration_date,
            CAST(CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE c_acctbal * 100 END AS DOUBLE) AS annual_income,
            CAST(c_custkey * 31 % 12000 AS INT) AS loyalty_points,
            CAST(c_custkey % 2 = 0 AS BOOLEAN) AS email_verified,
            CAST(CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE c_custkey % 3 = 0 END AS BOOLEAN) AS phone_verified
        FROM {customer}
    """,
    "employees": """
        SELECT
            CAST(CASE WHEN s_suppkey % 97 = 96 THEN NULL WHEN s_suppkey % 50 = 49 THEN s_suppkey - 1 ELSE s_suppkey END AS BIGINT) AS employee_id,
            CAST(CASE WHEN s_suppkey % 15 = 0 THEN NULL ELSE lower(s_name) END AS STRING) AS first_name,
            CAST(' last ' || CAST(s_suppkey AS STRING) AS STRING) AS last_name,
            CAST(CASE s_suppkey % 4 WHEN 0 THEN 'male ' WHEN 1 THEN 'FEMALE' WHEN 2 THEN 'other' WHEN 3 THEN 'x' END AS STRING) AS gender,
            CAST(DATE '1950-01-01' + CAST(s_suppkey * 190 % 14000 AS INT) AS DATE) AS date_of_birth,
            CAST(CASE WHEN s_suppkey % 10 = 4 THEN CAST(6000000000 + s_suppkey AS STRING) ELSE '+91' || CAST(6000000000 + s_suppkey AS STRING) END AS STRING) AS phone_number,
            CAST(CASE WHEN s_suppkey % 12 = 0 THEN NULL WHEN s_suppkey % 12 = 5 THEN 'e.corp.com' ELSE 'E' || CAST(s_suppkey % 90 AS STRING) || '@Corp.com' END AS STRING) AS email,
            CAST(CASE s_suppkey % 6 WHEN 0 THEN 'sales' WHEN 1 THEN 'MARKETING ' WHEN 2 THEN 'management' WHEN 3 THEN 'Administration' WHEN 4 THEN 'warehouse' WHEN 5 THEN NULL END AS STRING) AS department,
            CAST(CASE s_suppkey % 4 WHEN 0 THEN 'store manager' WHEN 1 THEN 'clerk' WHEN 2 THEN 'Area MANAGER' WHEN 3 THEN NULL END AS STRING) AS designation,
            CAST(s_acctbal * 12 AS DOUBLE) AS salary,
            CAST(CASE WHEN s_suppkey % 14 = 0 THEN NULL ELSE s_suppkey % 25 END AS BIGINT) AS store_id,
            CAST(DATE '1988-01-01' + CAST(s_suppkey * 55 % 5000 AS INT) AS DATE) AS hire_date,
            CAST(CASE s_suppkey % 4 WHEN 0 THEN 'active' WHEN 1 THEN 'resigned' WHEN 2 THEN 'TERMINATED ' WHEN 3 THEN 'on leave' END AS STRING) AS status
        FROM {supplier}
    """,
    "inventory": """
        SELECT
            CAST(CASE WHEN p_partkey % 97 = 96 THEN NULL WHEN p_partkey % 50 = 49 THEN p_partkey - 1 ELSE p_partkey END AS BIGINT) AS inventory_id,
            CAST(CASE WHEN p_partkey % 27 > 24 THEN -1 ELSE p_partkey % 130 END AS BIGINT) AS store_id,
            CAST(CASE WHEN p_partkey % 79 = 1 THEN NULL ELSE p_partkey END AS BIGINT) AS product_id,
            CAST(CASE WHEN p_partkey % 20 = 0 THEN 0 WHEN p_partkey % 83 = 0 THEN -1 ELSE p_partkey * 3 % 150 END AS INT) AS quantity_on_hand,
            CAST(p_size - 2 AS INT) AS reorder_level,
            CAST(CASE p_partkey % 4 WHEN 0 THEN 'in stock' WHEN 1 THEN ' Low Stock' WHEN 2 THEN 'OUT OF STOCK' WHEN 3 THEN 'backorder' END AS STRING) AS stock_status,
            CAST(DATE '1999-01-01' + CAST(p_partkey % 900 AS INT) AS DATE) AS last_restock_date,
            CAST(CAST(DATE '1999-01-03' + CAST(p_partkey * 5 % 950 AS INT) AS TIMESTAMP) AS TIMESTAMP) AS last_updated
        FROM {part}
    """,
    "order_items": """
        SELECT
            CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS order_item_id,
            CAST(CASE WHEN l_partkey % 113 = 0 THEN -1 ELSE l_orderkey END AS BIGINT) AS order_id,
            CAST(l_partkey AS BIGINT) AS product_id,
            CAST(CASE WHEN l_partkey % 71 = 0 THEN 0 ELSE CAST(l_quantity AS INT) % 14 END AS INT) AS quantity,
            CAST(CASE WHEN l_partkey % 97 = 0 THEN 0 ELSE l_partkey % 800 + 0.5 END AS DOUBLE) AS unit_price,
            CAST(l_suppkey % 4 * 10.25 AS DOUBLE) AS discount,
            CAST((CASE WHEN l_partkey % 71 = 0 THEN 0 ELSE CAST(l_quantity AS INT) % 14 END) * (l_partkey % 800 + 0.5) - (CASE WHEN l_suppkey % 9 = 0 THEN 0 ELSE l_suppkey % 4 * 10.25 END) AS DOUBLE) AS line_total
        FROM {lineitem}
    """,
    "orders": """
        SELECT
            CAST(CASE WHEN o_orderkey % 97 = 96 THEN NULL WHEN o_orderkey % 50 = 49 THEN o_orderkey - 1 ELSE o_orderkey END AS BIGINT) AS order_id,
            CAST(CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE o_custkey END AS BIGINT) AS customer_id,
            CAST(CASE WHEN o_orderkey % 27 > 24 THEN -1 ELSE o_orderkey % 130 END AS BIGINT) AS store_id,
            CAST(o_orderkey % 103 AS BIGINT) AS employee_id,
            CAST(CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 60 END AS BIGINT) AS promotion_id,
            CAST(CASE WHEN o_orderkey % 211 = 0 THEN NULL ELSE o_orderdate END AS TIMESTAMP) AS order_date,
            CAST(CASE WHEN o_orderkey % 53 = 0 THEN 0 WHEN o_orderkey % 4 = 0 THEN o_orderkey % 900 + 10 ELSE o_totalprice END AS DOUBLE) AS subtotal,
            CAST(o_orderkey % 5 * 2.5 AS DOUBLE) AS discount,
            CAST(o_orderkey % 8 * 1.25 AS DOUBLE) AS tax,
            CAST(CASE WHEN o_orderkey % 53 = 0 THEN 0 WHEN o_orderkey % 4 = 0 THEN o_orderkey % 900 + 10 ELSE o_totalprice END - o_orderkey % 5 * 2.5 + CASE WHEN o_orderkey % 6 = 0 THEN 1 ELSE o_orderkey % 8 * 1.25 END AS DOUBLE) AS total_amount,
            CAST(CASE o_orderstatus WHEN 'F' THEN ' completed' WHEN 'O' THEN 'Pending ' ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'cancelled' ELSE 'unknown' END END AS STRING) AS order_status
        FROM {orders}
    """,
    "payments": """
        SELECT
            CAST(CASE WHEN o_orderkey % 97 = 96 THEN NULL WHEN o_orderkey % 50 = 49 THEN o_orderkey - 1 ELSE o_orderkey END AS BIGINT) AS payment_id,
            CAST(CASE WHEN o_orderkey % 61 = 1 THEN NULL ELSE o_orderkey + o_orderkey % 2 END AS BIGINT) AS order_id,
            CAST(o_orderdate AS TIMESTAMP) AS payment_date,
            CAST(CASE o_orderpriority WHEN '1-URGENT' THEN ' upi' WHEN '2-HIGH' THEN 'Card' WHEN '3-MEDIUM' THEN 'cash ' WHEN '4-NOT SPECIFIED' THEN 'net banking' ELSE 'cheque' END AS STRING) AS payment_method,
            CAST(CASE o_orderkey % 5 WHEN 0 THEN 'success' WHEN 1 THEN 'Failed' WHEN 2 THEN 'PENDING ' WHEN 3 THEN 'refunded' WHEN 4 THEN 'lost' END AS STRING) AS payment_status,
            CAST(CASE WHEN o_orderkey % 67 = 0 THEN -5 ELSE o_orderkey % 13 * 999.5 END AS DOUBLE) AS amount_paid,
            CAST(CASE WHEN o_orderkey % 59 = 0 THEN NULL ELSE ' TX' || CAST(CASE WHEN o_orderkey % 30 = 1 THEN o_orderkey - 1 ELSE o_orderkey END AS STRING) END AS STRING) AS transaction_id
        FROM {orders}
    """,
    "products": """
        SELECT
            CAST(CASE WHEN p_partkey % 89 = 88 THEN NULL WHEN p_partkey % 50 = 49 THEN p_partkey - 1 ELSE p_partkey END AS BIGINT) AS product_id,
            CAST(CASE WHEN p_partkey % 41 = 0 THEN NULL ELSE ' ' || upper(p_name) END AS STRING) AS product_name,
            CAST('SKU' || CAST(CASE WHEN p_partkey % 30 = 1 THEN p_partkey - 1 ELSE p_partkey END AS STRING) AS STRING) AS sku,
            CAST(CASE WHEN p_partkey % 43 = 0 THEN NULL ELSE '00' || CAST(890000000000 + p_partkey AS STRING) END AS STRING) AS barcode,
            CAST(lower(p_type) || ' ' AS STRING) AS category,
            CAST(p_name AS STRING) AS sub_category,
            CAST(p_brand AS STRING) AS brand,
            CAST(CASE WHEN p_partkey % 29 = 0 THEN 'BAD1' ELSE 'SUP' || lpad(CAST(p_partkey % 110 AS STRING), 5, '0') END AS STRING) AS supplier_id,
            CAST(CASE p_partkey % 3 WHEN 0 THEN 'pcs' WHEN 1 THEN ' kg' WHEN 2 THEN 'ltr' END AS STRING) AS stock_unit,
            CAST(CASE p_partkey % 4 WHEN 0 THEN 'active' WHEN 1 THEN ' Active' WHEN 2 THEN 'discontinued' WHEN 3 THEN NULL END AS STRING) AS status,
            CAST(CASE WHEN p_partkey % 31 = 0 THEN 0 ELSE p_retailprice * 0.75 END AS DOUBLE) AS cost_price,
            CAST(CASE WHEN p_partkey % 37 = 0 THEN 0 ELSE p_retailprice * (1 + p_partkey % 4) * 0.5 END AS DOUBLE) AS selling_price,
            CAST(p_partkey % 28 * 5 AS DOUBLE) AS gst_percentage,
            CAST(p_size - 2 AS INT) AS reorder_level,
            CAST(DATE '1999-01-01' + CAST(p_partkey * 3 % 1000 AS INT) AS DATE) AS manufacture_date,
            CAST(CASE WHEN p_partkey % 47 = 0 THEN NULL ELSE DATE '1998-12-01' + CAST(p_partkey * 7 % 1500 AS INT) END AS DATE) AS expiry_date
        FROM {part}
    """,
    "promotions": """
        SELECT
            CAST(CASE WHEN p_partkey % 97 = 96 THEN NULL WHEN p_partkey % 50 = 49 THEN p_partkey - 1 ELSE p_partkey END AS BIGINT) AS promotion_id,
            CAST(CASE WHEN p_partkey % 25 = 3 THEN NULL ELSE ' Promo ' || p_name END AS STRING) AS promotion_name,
            CAST(CASE p_partkey % 4 WHEN 0 THEN 'percentage' WHEN 1 THEN ' FLAT' WHEN 2 THEN 'buy one get one' WHEN 3 THEN 'mystery' END AS STRING) AS promotion_type,
            CAST(CASE WHEN p_partkey % 16 = 0 THEN 120 ELSE p_size END AS DOUBLE) AS discount_value,
            CAST(DATE '2000-06-01' + CAST(p_partkey * 9 % 540 AS INT) AS DATE) AS start_date,
            CAST(DATE '2000-06-05' + CAST(p_partkey * 9 % 540 + p_partkey % 20 - 8 AS INT) AS DATE) AS end_date,
            CAST(upper(p_type) AS STRING) AS applicable_category,
            CAST(p_partkey * 25 - 50 AS DOUBLE) AS minimum_order_amount,
            CAST(CASE WHEN p_partkey % 10 = 0 THEN NULL WHEN p_partkey % 10 = 1 THEN '  ' ELSE ' save' || CAST(p_size AS STRING) END AS STRING) AS coupon_code,
            CAST(CASE p_partkey % 5 WHEN 0 THEN 'upcoming' WHEN 1 THEN 'active' WHEN 2 THEN 'Expired ' WHEN 3 THEN 'paused' WHEN 4 THEN NULL END AS STRING) AS status
        FROM {part}
    """,
    "returns": """
        SELECT
            CAST(CASE WHEN o_orderkey % 97 = 96 THEN NULL WHEN o_orderkey % 50 = 49 THEN o_orderkey - 1 ELSE o_orderkey END AS BIGINT) AS return_id,
            CAST(CASE WHEN o_orderkey % 190 = 0 THEN -1 ELSE o_orderkey END AS BIGINT) AS order_id,
            CAST(CASE WHEN o_orderkey % 170 = 10 THEN NULL ELSE o_orderkey % 2000 END AS BIGINT) AS product_id,
            CAST(CAST(o_orderdate AS DATE) + 20 AS DATE) AS return_date,
            CAST(CASE CAST(floor(o_orderkey / 10) AS BIGINT) % 5 WHEN 0 THEN 'damaged' WHEN 1 THEN ' WRONG item' WHEN 2 THEN 'changed MIND' WHEN 3 THEN 'no reason' ELSE NULL END AS STRING) AS return_reason,
            CAST(CASE CAST(floor(o_orderkey / 10) AS BIGINT) % 6 WHEN 0 THEN 'requested' WHEN 1 THEN 'Approved ' WHEN 2 THEN 'rejected' WHEN 3 THEN 'COMPLETED' WHEN 4 THEN 'limbo' ELSE NULL END AS STRING) AS return_status,
            CAST(CASE WHEN o_orderkey % 130 = 0 THEN -1 ELSE o_orderkey % 1200 * 10 END AS DOUBLE) AS refund_amount
        FROM {orders}
    """,
    "shipments": """
        SELECT
            CAST(CASE WHEN o_orderkey % 97 = 96 THEN NULL WHEN o_orderkey % 50 = 49 THEN o_orderkey - 1 ELSE o_orderkey END AS BIGINT) AS shipment_id,
            CAST(CASE WHEN o_orderkey % 91 = 2 THEN -1 ELSE o_orderkey END AS BIGINT) AS order_id,
            CAST(CASE WHEN o_orderkey % 83 = 1 THEN NULL WHEN o_orderkey % 27 > 24 THEN -1 ELSE o_orderkey % 130 END AS BIGINT) AS store_id,
            CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 4 AS INT) AS DATE) AS shipment_date,
            CAST(CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 12 - 1 AS INT) END AS DATE) AS delivery_date,
            CAST(CASE o_orderkey % 8 WHEN 0 THEN 'delivered' WHEN 1 THEN ' In Transit' WHEN 2 THEN 'pending' WHEN 3 THEN 'RETURNED' WHEN 4 THEN 'cancelled' WHEN 5 THEN 'shipped' WHEN 6 THEN 'out for delivery' WHEN 7 THEN 'held' END AS STRING) AS shipping_status,
            CAST(CASE o_orderkey % 5 WHEN 0 THEN 'DTDC' WHEN 1 THEN ' BLUE DART' WHEN 2 THEN 'Ekart' WHEN 3 THEN 'INDIA POST' WHEN 4 THEN NULL END AS STRING) AS courier_name,
            CAST(CASE WHEN o_orderkey % 73 = 0 THEN NULL ELSE 'TRK' || CAST(CASE WHEN o_orderkey % 30 = 1 THEN o_orderkey - 1 ELSE o_orderkey END AS STRING) END AS STRING) AS tracking_number
        FROM {orders}
    """,
    "stores": """
        SELECT
            CAST(CASE WHEN s_suppkey % 97 = 96 THEN NULL WHEN s_suppkey % 50 = 49 THEN s_suppkey - 1 ELSE s_suppkey END AS BIGINT) AS store_id,
            CAST(CASE WHEN s_suppkey % 25 = 7 THEN NULL ELSE ' Store ' || n_name END AS STRING) AS store_name,
            CAST(CASE s_suppkey % 6 WHEN 0 THEN 'Express Store' WHEN 1 THEN 'supermarket ' WHEN 2 THEN 'HYPERMARKET' WHEN 3 THEN 'Wholesale' WHEN 4 THEN 'Kiosk' WHEN 5 THEN NULL END AS STRING) AS store_type,
            CAST(CASE s_suppkey % 4 WHEN 0 THEN 'active' WHEN 1 THEN 'Inactive ' WHEN 2 THEN 'under maintenance' WHEN 3 THEN 'closed' END AS STRING) AS status,
            CAST(' Road ' || n_name AS STRING) AS address,
            CAST(lower(n_name) AS STRING) AS city,
            CAST(upper(n_name) AS STRING) AS state,
            CAST(CASE WHEN s_suppkey % 5 = 0 THEN 12345 ELSE 560001 + s_suppkey % 400000 END AS INT) AS pincode,
            CAST(CASE WHEN s_suppkey % 6 = 0 THEN '98' WHEN s_suppkey % 6 = 1 THEN NULL ELSE '+91' || CAST(8000000000 + s_suppkey AS STRING) END AS STRING) AS phone_number,
            CAST(CASE WHEN s_suppkey % 8 = 3 THEN 'store at shop' ELSE ' Store' || CAST(s_suppkey AS STRING) || '@Shop.com' END AS STRING) AS email,
            CAST('mgr ' || n_name AS STRING) AS manager_name,
            CAST(DATE '1990-01-01' + CAST(s_suppkey % 25 * 180 AS INT) AS DATE) AS opening_date,
            CAST(s_suppkey % 25 * 3000 AS INT) AS store_size_sqft
        FROM {supplier} JOIN {nation} ON n_nationkey = s_nationkey
    """,
    "suppliers": """
        SELECT
            CAST(CASE WHEN s_suppkey % 97 = 96 THEN NULL ELSE 'SUP' || lpad(CAST(CASE WHEN s_suppkey % 50 = 49 THEN s_suppkey - 1 ELSE s_suppkey END AS STRING), 5, '0') END AS STRING) AS supplier_id,
            CAST(CASE WHEN s_suppkey % 33 = 5 THEN NULL ELSE ' ' || s_name END AS STRING) AS supplier_name,
            CAST(CASE WHEN s_suppkey % 9 = 0 THEN NULL ELSE 'mr ' || s_name END AS STRING) AS contact_person,
            CAST(CASE WHEN s_suppkey % 8 = 0 THEN 'nope' ELSE 'S' || CAST(s_suppkey AS STRING) || '@Sup.io' END AS STRING) AS email,
            CAST(CASE WHEN s_suppkey % 7 = 0 THEN '99' ELSE CAST(7000000000 + s_suppkey AS STRING) END AS STRING) AS phone,
            CAST(s_name AS STRING) AS address,
            CAST('CITY ' || CAST(s_nationkey AS STRING) AS STRING) AS city,
            CAST('state ' || CAST(s_nationkey AS STRING) AS STRING) AS state,
            CAST(' INDIA' AS STRING) AS country,
            CAST(CASE WHEN s_suppkey % 10 = 0 THEN NULL WHEN s_suppkey % 10 = 1 THEN '29abcde1234f1z5' WHEN s_suppkey % 10 = 2 THEN 'GST' || CAST(s_suppkey AS STRING) ELSE '29ABCDE' || lpad(CAST(s_suppkey AS STRING), 4, '0') || 'F1Z5' END AS STRING) AS gst_number,
            CAST(CASE s_suppkey % 3 WHEN 0 THEN 'food items' WHEN 1 THEN 'HOME' WHEN 2 THEN NULL END AS STRING) AS business_category,
            CAST(s_suppkey % 7 AS DOUBLE) AS rating,
            CAST(CASE s_suppkey % 4 WHEN 0 THEN 'Net 30' WHEN 1 THEN ' Net 60 ' WHEN 2 THEN 'Net 90' WHEN 3 THEN NULL END AS STRING) AS payment_terms,
            CAST(s_suppkey % 21 AS INT) AS lead_time_days,
            CAST(DATE '1993-06-01' + CAST(s_suppkey * 31 % 4000 AS INT) AS DATE) AS contract_start_date,
            CAST(CASE s_suppkey % 3 WHEN 0 THEN 'Active' WHEN 1 THEN 'inactive ' WHEN 2 THEN 'blocked' END AS STRING) AS status
        FROM {supplier}
    """,
}


def tables_of(sql: str) -> list[str]:
    return sorted(set(re.findall(r"{(\w+)}", sql)))


def given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def source_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One source table, bound to the given tables in ``sf_dir``."""
    sql = SOURCES[name]
    return spark.sql(sql, **{t: given(spark, sf_dir, t) for t in tables_of(sql)})


def source_sql(name: str) -> str:
    """The same for DuckDB, where the given tables are views."""
    sql = SOURCES[name]
    return sql.format(**{t: t for t in tables_of(sql)})
