"""Declared schemas of the twelve source tables.

Phones, codes and numbers that may start with a plus sign or a zero are text:
inference would read them as integers and lose those characters.
"""

SCHEMAS = {
    "customers": """
        customer_id BIGINT, first_name STRING, last_name STRING, gender STRING,
        date_of_birth DATE, age INT, email STRING, phone STRING, address STRING,
        city STRING, state STRING, country STRING, pincode INT, segment STRING,
        preferred_payment STRING, occupation STRING, marital_status STRING,
        status STRING, registration_date DATE, annual_income DOUBLE,
        loyalty_points INT, email_verified BOOLEAN, phone_verified BOOLEAN
    """,
    "employees": """
        employee_id BIGINT, first_name STRING, last_name STRING, gender STRING,
        date_of_birth DATE, phone_number STRING, email STRING, department STRING,
        designation STRING, salary DOUBLE, store_id BIGINT, hire_date DATE,
        status STRING
    """,
    "inventory": """
        inventory_id BIGINT, store_id BIGINT, product_id BIGINT,
        quantity_on_hand INT, reorder_level INT, stock_status STRING,
        last_restock_date DATE, last_updated TIMESTAMP
    """,
    "order_items": """
        order_item_id BIGINT, order_id BIGINT, product_id BIGINT, quantity INT,
        unit_price DOUBLE, discount DOUBLE, line_total DOUBLE
    """,
    "orders": """
        order_id BIGINT, customer_id BIGINT, store_id BIGINT, employee_id BIGINT,
        promotion_id BIGINT, order_date TIMESTAMP, subtotal DOUBLE,
        discount DOUBLE, tax DOUBLE, total_amount DOUBLE, order_status STRING
    """,
    "payments": """
        payment_id BIGINT, order_id BIGINT, payment_date TIMESTAMP,
        payment_method STRING, payment_status STRING, amount_paid DOUBLE,
        transaction_id STRING
    """,
    "products": """
        product_id BIGINT, product_name STRING, sku STRING, barcode STRING,
        category STRING, sub_category STRING, brand STRING, supplier_id STRING,
        stock_unit STRING, status STRING, cost_price DOUBLE, selling_price DOUBLE,
        gst_percentage DOUBLE, reorder_level INT, manufacture_date DATE,
        expiry_date DATE
    """,
    "promotions": """
        promotion_id BIGINT, promotion_name STRING, promotion_type STRING,
        discount_value DOUBLE, start_date DATE, end_date DATE,
        applicable_category STRING, minimum_order_amount DOUBLE,
        coupon_code STRING, status STRING
    """,
    "returns": """
        return_id BIGINT, order_id BIGINT, product_id BIGINT, return_date DATE,
        return_reason STRING, return_status STRING, refund_amount DOUBLE
    """,
    "shipments": """
        shipment_id BIGINT, order_id BIGINT, store_id BIGINT, shipment_date DATE,
        delivery_date DATE, shipping_status STRING, courier_name STRING,
        tracking_number STRING
    """,
    "stores": """
        store_id BIGINT, store_name STRING, store_type STRING, status STRING,
        address STRING, city STRING, state STRING, pincode INT,
        phone_number STRING, email STRING, manager_name STRING,
        opening_date DATE, store_size_sqft INT
    """,
    "suppliers": """
        supplier_id STRING, supplier_name STRING, contact_person STRING,
        email STRING, phone STRING, address STRING, city STRING, state STRING,
        country STRING, gst_number STRING, business_category STRING,
        rating DOUBLE, payment_terms STRING, lead_time_days INT,
        contract_start_date DATE, status STRING
    """,
}
