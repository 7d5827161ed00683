"""Explicit schemas: nested landing objects and the flat analytics tables."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _D, _B = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()
_TS, _DT, _I = T.TimestampType(), T.DateType(), T.IntegerType()


def _table(*columns: tuple) -> T.StructType:
    """``(name, type)`` is optional, ``(name, type, True)`` is required."""
    return T.StructType([T.StructField(c[0], c[1], nullable=len(c) < 3) for c in columns])


CUSTOMERS = _table(
    ("customer_id", _S, True), ("email", _S), ("name", _S), ("description", _S),
    ("created", _TS, True), ("currency", _S), ("delinquent", _B), ("test_clock_id", _S),
    ("default_payment_method", _S), ("extracted_at", _TS, True),
)

SUBSCRIPTIONS = _table(
    ("subscription_id", _S, True), ("customer_id", _S, True), ("status", _S, True),
    ("current_period_start", _TS), ("current_period_end", _TS), ("start_date", _TS),
    ("ended_at", _TS), ("canceled_at", _TS), ("cancel_at_period_end", _B),
    ("collection_method", _S), ("created", _TS, True), ("currency", _S), ("price_id", _S),
    ("product_id", _S), ("unit_amount", _L), ("quantity", _L), ("mrr_amount", _D, True),
    ("extracted_at", _TS, True),
)

INVOICES = _table(
    ("invoice_id", _S, True), ("invoice_number", _S), ("customer_id", _S, True),
    ("subscription_id", _S), ("status", _S, True), ("amount_due", _L), ("amount_paid", _L),
    ("amount_remaining", _L), ("subtotal", _L), ("total", _L), ("currency", _S),
    ("created", _TS, True), ("due_date", _TS), ("period_start", _TS), ("period_end", _TS),
    ("paid_at", _TS), ("collection_method", _S), ("hosted_invoice_url", _S),
    ("invoice_pdf", _S), ("extracted_at", _TS, True),
)

PRICES = _table(
    ("price_id", _S, True), ("product_id", _S, True), ("active", _B), ("currency", _S),
    ("unit_amount", _L), ("recurring_interval", _S), ("recurring_interval_count", _L),
    ("nickname", _S), ("created", _TS, True), ("extracted_at", _TS, True),
)

PRODUCTS = _table(
    ("product_id", _S, True), ("name", _S, True), ("description", _S), ("active", _B),
    ("created", _TS, True), ("updated", _TS), ("extracted_at", _TS, True),
)

MONTHLY_SUMMARY = _table(
    ("month_year", _S, True), ("month_start_date", _DT, True), ("total_mrr", _D, True),
    ("new_mrr", _D), ("expansion_mrr", _D), ("contraction_mrr", _D), ("churned_mrr", _D),
    ("net_new_mrr", _D), ("active_customers", _L), ("new_customers", _L),
    ("churned_customers", _L), ("average_revenue_per_user", _D), ("churn_rate", _D),
    ("growth_rate", _D), ("calculated_at", _TS, True),
)

CUSTOMER_COHORTS = _table(
    ("cohort_month", _S, True), ("cohort_start_date", _DT, True), ("period_number", _I, True),
    ("customers_in_cohort", _L, True), ("active_customers", _L, True),
    ("retention_rate", _D, True), ("cohort_revenue", _D), ("revenue_per_customer", _D),
    ("calculated_at", _TS, True),
)

# Physical table name -> schema.
TABLES = {
    "customers": CUSTOMERS,
    "subscriptions": SUBSCRIPTIONS,
    "invoices": INVOICES,
    "prices": PRICES,
    "products": PRODUCTS,
    "mrr_monthly_summary": MONTHLY_SUMMARY,
    "customer_cohorts": CUSTOMER_COHORTS,
}

# Month partitioning follows the load stamp; clustering keys lead with the
# columns that reports filter on.
PARTITION_STAMP = {
    "invoices": "extracted_at",
    "mrr_monthly_summary": "calculated_at",
    "customer_cohorts": "calculated_at",
}
CLUSTER_KEYS = {
    "subscriptions": ("status", "customer_id"),
    "invoices": ("status", "customer_id"),
}
UNIQUE_KEYS = {"subscriptions": "subscription_id", "invoices": "invoice_id"}


# Landing objects, one JSON document per line.  All times are epoch seconds.
# A field that may hold text or an object is declared as text: the reader then
# keeps an object's own JSON.
_RECURRING = T.StructType([T.StructField("interval", _S), T.StructField("interval_count", _L)])
_ITEM_PRICE = T.StructType([
    T.StructField("id", _S), T.StructField("product", _S), T.StructField("unit_amount", _L),
    T.StructField("recurring", _S),  # the object's own JSON: an explicit null differs from a missing key
])
_ITEM = T.StructType([
    T.StructField("quantity", _L), T.StructField("current_period_start", _L),
    T.StructField("current_period_end", _L), T.StructField("price", _ITEM_PRICE),
])

RAW_CUSTOMERS = T.StructType([
    T.StructField("id", _S), T.StructField("email", _S), T.StructField("name", _S),
    T.StructField("description", _S), T.StructField("created", _L), T.StructField("currency", _S),
    T.StructField("delinquent", _B), T.StructField("test_clock", _S),
    T.StructField("invoice_settings", T.StructType([T.StructField("default_payment_method", _S)])),
])
RAW_PRODUCTS = T.StructType([
    T.StructField("id", _S), T.StructField("name", _S), T.StructField("description", _S),
    T.StructField("active", _B), T.StructField("created", _L), T.StructField("updated", _L),
])
RAW_PRICES = T.StructType([
    T.StructField("id", _S), T.StructField("product", _S), T.StructField("active", _B),
    T.StructField("currency", _S), T.StructField("unit_amount", _L),
    T.StructField("recurring", _RECURRING), T.StructField("nickname", _S),
    T.StructField("created", _L),
])
RAW_SUBSCRIPTIONS = T.StructType([
    T.StructField("id", _S), T.StructField("customer", _S), T.StructField("status", _S),
    T.StructField("start_date", _L), T.StructField("created", _L), T.StructField("ended_at", _L),
    T.StructField("canceled_at", _L), T.StructField("cancel_at_period_end", _B),
    T.StructField("collection_method", _S), T.StructField("currency", _S),
    T.StructField("billing_cycle_anchor", _L),
    T.StructField("items", T.StructType([T.StructField("data", T.ArrayType(_ITEM))])),
])
RAW_INVOICES = T.StructType([
    T.StructField("id", _S), T.StructField("number", _S), T.StructField("customer", _S),
    T.StructField("subscription", _S), T.StructField("status", _S),
    T.StructField("amount_due", _L), T.StructField("amount_paid", _L),
    T.StructField("amount_remaining", _L), T.StructField("subtotal", _L),
    T.StructField("total", _L), T.StructField("currency", _S), T.StructField("created", _L),
    T.StructField("due_date", _L), T.StructField("period_start", _L),
    T.StructField("period_end", _L),
    T.StructField("status_transitions", T.StructType([T.StructField("paid_at", _L)])),
    T.StructField("collection_method", _S), T.StructField("hosted_invoice_url", _S),
    T.StructField("invoice_pdf", _S),
])

LANDING = {
    "customers": RAW_CUSTOMERS,
    "products": RAW_PRODUCTS,
    "prices": RAW_PRICES,
    "subscriptions": RAW_SUBSCRIPTIONS,
    "invoices": RAW_INVOICES,
}
