"""Explicit schemas of the raw shop tables; nothing is inferred."""

from __future__ import annotations

ORDERS = (
    "order_id string, customer_id string, order_status string, "
    "order_purchase_timestamp timestamp, order_approved_at timestamp, "
    "order_delivered_carrier_date timestamp, order_delivered_customer_date timestamp, "
    "order_estimated_delivery_date timestamp"
)
REVIEWS = (
    "review_id string, order_id string, review_score int, review_comment_title string, "
    "review_comment_message string, review_creation_date timestamp, review_answer_timestamp timestamp"
)
PAYMENTS = (
    "order_id string, payment_sequential int, payment_type string, "
    "payment_installments int, payment_value double"
)
ITEMS = (
    "order_id string, order_item_id int, product_id string, seller_id string, "
    "shipping_limit_date timestamp, price double, freight_value double"
)
CUSTOMERS = (
    "customer_id string, customer_unique_id string, customer_zip_code_prefix int, "
    "customer_city string, customer_state string"
)
PRODUCTS = "product_id string, product_category_name string"
CATEGORIES = "product_category_name string, product_category_name_english string"
SELLERS = "seller_id string, seller_zip_code_prefix int, seller_city string, seller_state string"
GEOLOCATION = (
    "geolocation_zip_code_prefix int, geolocation_lat double, geolocation_lng double, "
    "geolocation_city string, geolocation_state string"
)

RAW_TABLES = {
    "orders": ORDERS,
    "reviews": REVIEWS,
    "payments": PAYMENTS,
    "items": ITEMS,
    "customers": CUSTOMERS,
    "products": PRODUCTS,
    "categories": CATEGORIES,
    "sellers": SELLERS,
    "geolocation": GEOLOCATION,
}
