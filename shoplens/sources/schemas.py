"""Column lists of the shop's tables."""

# Names, order and types of the input files.
CUSTOMERS = """
    customer_id STRING, first_name STRING, last_name STRING, username STRING, email STRING,
    gender STRING, birthdate STRING, device_type STRING, device_id STRING, device_version STRING,
    home_location_lat DOUBLE, home_location_long DOUBLE, home_location STRING, home_country STRING,
    first_join_date STRING
"""

PRODUCTS = """
    id INT, gender STRING, masterCategory STRING, subCategory STRING, articleType STRING,
    baseColour STRING, season STRING, year INT, usage STRING, productDisplayName STRING
"""

TRANSACTIONS = """
    created_at STRING, customer_id STRING, booking_id STRING, session_id STRING,
    product_metadata STRING, payment_method STRING, payment_status STRING, promo_amount DOUBLE,
    promo_code STRING, shipment_fee DOUBLE, shipment_date_limit STRING,
    shipment_location_lat DOUBLE, shipment_location_long DOUBLE, total_amount DOUBLE
"""

CLICKSTREAM = """
    session_id STRING, event_name STRING, event_time STRING, event_id STRING,
    traffic_source STRING, event_metadata STRING
"""

# Streamed events carry the clickstream columns, in the same order, all as text.
STREAM_EVENTS = CLICKSTREAM

ORDER_ITEMS_JSON = "items ARRAY<STRUCT<product_id: INT, quantity: INT, price: DOUBLE>>"

EVENT_META_JSON = "page STRING, duration_sec INT, product_id INT, query STRING, promo_code STRING"
