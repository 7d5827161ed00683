"""Every report and operator of the library, bound to the sample tables."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revtide import schemas, session
from revtide import testbed as tb
from revtide.functions.billing import monthly_amount
from revtide.functions.months import utc
from revtide.operators import checks, ledger
from revtide.operators.dedup import keep_first
from revtide.plans import cohorts, dashboard, monthly, refresh, reports
from revtide.sinks import tables
from revtide.sources import landing, selection

AS_OF, EXTRACTED_AT = tb.AS_OF, tb.EXTRACTED_AT


def _plain_times(rows: DataFrame) -> DataFrame:
    """Timestamps without zone, as the sample tables have them."""
    return rows.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name)
            for f in rows.schema.fields
        ]
    )


# Reports

def status_summary(spark, sf):
    return reports.subscription_status_summary(tb.subscriptions(spark, sf))


def api_subscriptions(spark, sf):
    return dashboard.api_subscriptions(tb.subscriptions(spark, sf))


def pie_series(spark, sf):
    return dashboard.pie_series(tb.subscriptions(spark, sf))


def mrr_by_plan(spark, sf):
    return reports.mrr_by_plan(tb.subscriptions(spark, sf), tb.prices(spark, sf), tb.products(spark, sf))


def mrr_by_plan_no_amount(spark, sf):
    return reports.mrr_by_plan_no_amount(
        tb.subscriptions(spark, sf), tb.prices(spark, sf), tb.products(spark, sf)
    )


def customer_churn_analysis(spark, sf):
    return reports.customer_churn_analysis(tb.subscriptions(spark, sf))


def revenue_by_collection_method(spark, sf):
    # Keep-first has run on both tables.
    return reports.revenue_by_collection_method(
        tb.subscriptions(spark, sf), tb.invoices(spark, sf), unique_keys=True
    )


def revenue_by_collection_method_any_keys(spark, sf):
    # Straight from the delivery, where invoice ids repeat.
    return reports.revenue_by_collection_method(tb.subscriptions(spark, sf), tb.raw_invoices(spark, sf))


def revenue_by_collection_method_unfanned(spark, sf):
    return reports.revenue_by_collection_method_unfanned(
        tb.subscriptions(spark, sf), tb.invoices(spark, sf), unique_keys=True
    )


def month_series(spark, sf):
    return monthly.month_series(tb.subscriptions(spark, sf), AS_OF)


def monthly_metrics(spark, sf):
    return monthly.monthly_metrics(tb.subscriptions(spark, sf), AS_OF).drop("calculated_at")


def _summary(spark, sf):
    return monthly.monthly_summary(tb.subscriptions(spark, sf), AS_OF, EXTRACTED_AT)


def monthly_summary(spark, sf):
    return _plain_times(_summary(spark, sf))


def mrr_growth_trend(spark, sf):
    return reports.mrr_growth_trend(_summary(spark, sf))


def mrr_trend_analysis(spark, sf):
    return reports.mrr_trend_analysis(_summary(spark, sf))


def growth_trend_inline(spark, sf):
    return reports.growth_trend_inline(_summary(spark, sf))


def api_mrr_trend(spark, sf):
    return dashboard.api_mrr_trend(_summary(spark, sf))


def monthly_table(spark, sf):
    return dashboard.monthly_table(dashboard.api_mrr_trend(_summary(spark, sf)))


def chart_series(spark, sf):
    return dashboard.chart_series(dashboard.api_mrr_trend(_summary(spark, sf)))


def _api_summary(spark, sf):
    return dashboard.api_summary(_summary(spark, sf), tb.subscriptions(spark, sf))


def latest_summary(spark, sf):
    return _api_summary(spark, sf).selectExpr(
        "currentMrr", "activeCustomers", "arpu", "churnRate", "growthRate",
        "subscriptions.active AS active", "subscriptions.canceled AS canceled",
        "subscriptions.pastDue AS pastDue",
    )


def kpi_cards(spark, sf):
    return dashboard.kpi_cards(_api_summary(spark, sf))


def cohort_assignment(spark, sf):
    return cohorts.cohort_assignment(tb.subscriptions(spark, sf))


def cohort_retention(spark, sf):
    return cohorts.cohort_retention(tb.subscriptions(spark, sf), AS_OF).drop("calculated_at")


def cohort_table(spark, sf):
    return _plain_times(cohorts.cohort_table(tb.subscriptions(spark, sf), AS_OF, EXTRACTED_AT))


# Sources

def _flat(spark, sf, entity):
    raw = landing.parse_landing(tb.LINES[entity](spark, sf), entity)
    return landing.FLATTEN[entity](raw, EXTRACTED_AT)


def flatten_customers(spark, sf):
    return _plain_times(_flat(spark, sf, "customers"))


def flatten_products(spark, sf):
    return _plain_times(_flat(spark, sf, "products"))


def flatten_prices(spark, sf):
    return _plain_times(_flat(spark, sf, "prices"))


def flatten_subscriptions(spark, sf):
    return _plain_times(_flat(spark, sf, "subscriptions"))


def flatten_invoices(spark, sf):
    return _plain_times(_flat(spark, sf, "invoices"))


def mrr_normalization(spark, sf):
    amount = monthly_amount(F.col("unit_amount"), F.lit(3).cast("bigint"), F.col("recurring_interval"))
    return tb.prices(spark, sf).select(
        "price_id", "recurring_interval", "unit_amount", amount.alias("mrr_amount")
    )


def dedup_invoices(spark, sf):
    kept = keep_first(tb.raw_invoices(spark, sf), "invoice_id", tb.INVOICE_ORDER)
    return _plain_times(kept.drop("_orderkey", "_linenumber", "_partkey", "_suppkey"))


def dedup_subscriptions(spark, sf):
    """Every third subscription is delivered again, later and as closed."""
    first = tb.subscriptions(spark, sf).select(
        "subscription_id", "customer_id", "status", F.lit(1).alias("arrival")
    )
    again = first.filter(F.substring("subscription_id", 5, 20).cast("bigint") % 3 == 0).select(
        "subscription_id", "customer_id", F.lit("closed").alias("status"), F.lit(2).alias("arrival")
    )
    return keep_first(again.unionByName(first), "subscription_id", ["arrival"])


def first_nonempty_source(spark, sf):
    everyone = tb.customers(spark, sf).select("customer_id", "email", "description")
    return selection.first_nonempty(
        everyone.filter(F.col("description") == "NO SUCH SEGMENT"),
        everyone.filter(F.col("description") == "BUILDING"),
        everyone,
    )


def entities_from_references(spark, sf):
    everyone = tb.customers(spark, sf).select("customer_id", "email")
    open_invoices = tb.with_customer(
        spark, sf, tb.raw_invoices(spark, sf).filter(F.col("status") == "open")
    )
    return selection.referenced_entities(everyone, "customer_id", open_invoices, "customer_id")


def children_of_known_parents(spark, sf):
    parents = tb.customers(spark, sf).filter(F.col("description") == "BUILDING")
    children = tb.subscriptions(spark, sf).select("subscription_id", "customer_id", "status")
    return selection.children_of(children, parents, "customer_id")


def union_sources(spark, sf):
    everyone = tb.customers(spark, sf).select("customer_id", "description", "delinquent")
    late = everyone.filter("delinquent")
    current = everyone.filter("NOT coalesce(delinquent, false)")  # an unknown flag is not late
    return selection.union_sources(late, current.select("delinquent", "description", "customer_id"))


def created_since(spark, sf):
    recent = selection.created_since(tb.raw_invoices(spark, sf), dt.datetime(2000, 1, 1))
    return _plain_times(recent.select("invoice_id", "status", "total", "created"))


def required_violations(spark, sf):
    gaps = tb.subscriptions(spark, sf).withColumn("mrr_amount", F.nullif("mrr_amount", F.lit(0.0)))
    rows = gaps.withColumn("customer_id", F.when(F.col("price_id").isNotNull(), F.col("customer_id")))
    stamped = rows.withColumn("extracted_at", utc(EXTRACTED_AT))
    return checks.required_violations(stamped, schemas.SUBSCRIPTIONS, "subscriptions")


def table_counts(spark, sf):
    return checks.table_counts(
        {
            "customers": tb.customers(spark, sf),
            "products": tb.products(spark, sf),
            "prices": tb.prices(spark, sf),
            "subscriptions": tb.subscriptions(spark, sf),
            "invoices": tb.invoices(spark, sf),
        }
    )


# Sinks

def roundtrip_overwrite(spark, sf):
    path = session.scratch_dir(spark, "overwrite")
    rows = tb.prices(spark, sf).select("price_id", "product_id", "unit_amount", "recurring_interval")
    tables.replace_table(rows, path)
    tables.replace_table(rows.filter("recurring_interval = 'month'"), path)
    return spark.read.parquet(path)


def skip_empty_write(spark, sf):
    path = session.scratch_dir(spark, "skip-empty")
    rows = tb.prices(spark, sf).select("price_id", "product_id", "unit_amount", "nickname")
    tables.replace_table(rows, path)
    tables.replace_table(rows.filter("unit_amount < 0"), path)
    return spark.read.parquet(path)


def roundtrip_ndjson(spark, sf):
    path = session.scratch_dir(spark, "ndjson")
    rows = tb.subscriptions(spark, sf).select(
        "subscription_id", "status", "start_date", "canceled_at", "price_id", "quantity"
    )
    tables.export_ndjson(rows, path)
    back = spark.read.schema(
        "subscription_id string, status string, start_date string, canceled_at string, "
        "price_id string, quantity bigint"
    ).json(path)
    return back


def roundtrip_partitioned_clustered(spark, sf):
    path = session.scratch_dir(spark, "clustered")
    rows = tb.with_customer(spark, sf, tb.invoices(spark, sf)).select(
        "invoice_id", "customer_id", "status", "total", "created"
    )
    tables.replace_table(
        rows,
        path,
        partition_stamp="created",
        cluster_by=schemas.CLUSTER_KEYS["invoices"],
        tie_break=schemas.UNIQUE_KEYS["invoices"],
    )
    stored = spark.read.parquet(path)
    return _plain_times(stored.withColumn("load_month", F.col("load_month").cast("string")))


def _refreshed(spark, sf):
    folder = session.scratch_dir(spark, "refresh")
    sources = tb.write_landing(spark, sf, f"{folder}/landing")
    counts = refresh.full_refresh(spark, sources, f"{folder}/tables", AS_OF, EXTRACTED_AT)
    tables.delete_folder(spark, f"{folder}/landing")
    return f"{folder}/tables", counts


def full_refresh(spark, sf):
    return _refreshed(spark, sf)[1]


def stored_monthly_summary(spark, sf):
    warehouse, _ = _refreshed(spark, sf)
    return _plain_times(tables.read_table(spark, warehouse, "mrr_monthly_summary"))


def stored_subscriptions(spark, sf):
    warehouse, _ = _refreshed(spark, sf)
    return _plain_times(tables.read_table(spark, warehouse, "subscriptions"))


def stored_invoices(spark, sf):
    warehouse, _ = _refreshed(spark, sf)
    return _plain_times(tables.read_table(spark, warehouse, "invoices"))


def stored_customer_cohorts(spark, sf):
    warehouse, _ = _refreshed(spark, sf)
    return _plain_times(tables.read_table(spark, warehouse, "customer_cohorts"))


def failed_refresh_keeps_table(spark, sf):
    """A second load in which some required values are missing stops; what the first stored is still there."""
    warehouse = session.scratch_dir(spark, "failing")
    rows = tb.prices(spark, sf).withColumn("extracted_at", utc(EXTRACTED_AT)).withColumns(
        {"recurring_interval_count": F.lit(1).cast("bigint"), "created": utc(EXTRACTED_AT)}
    )
    tables.replace_named_table(checks.conform(rows, schemas.PRICES, "prices"), warehouse, "prices")
    broken = rows.withColumn("product_id", F.when(F.col("recurring_interval") != "day", F.col("product_id")))
    try:
        tables.replace_named_table(checks.conform(broken, schemas.PRICES, "prices"), warehouse, "prices")
    except PySparkException:
        outcome = "failed"
    else:
        outcome = "stored"
    kept = tables.read_table(spark, warehouse, "prices")
    return kept.select("price_id", "product_id", "unit_amount", "recurring_interval", F.lit(outcome).alias("outcome"))


def landing_rejects(spark, sf):
    """Subscription lines of which some, by key, are broken in one way or another."""
    lines = tb.subscription_lines(spark, sf).withColumn(
        "key", F.regexp_extract("value", '"id":"sub_([0-9]+)"', 1).cast("bigint")
    )

    def put(old, new):
        return F.regexp_replace("value", old, new)

    key = F.col("key") % 40
    broken = (
        F.when(key == 1, put('"unit_amount":([0-9]+)', '"unit_amount":"$1"'))
        .when(key == 2, put('"quantity":([0-9]+)', '"quantity":$1.5'))
        .when(key == 3, put('"created":[0-9]+', '"created":"1999-01-01"'))
        .when(key == 4, F.expr("substring(value, 1, length(value) - 1)"))
        .when(key == 5, put('"customer":"[^"]*",', ""))
        .when(key == 6, put('"status":"[^"]*"', '"status":null'))
        .otherwise(F.col("value"))
    )
    found = landing.rejects(lines.select(broken.alias("value"), "key"), "subscriptions")
    return found.select(
        F.regexp_extract("line", '"id":"(sub_[0-9]+)"', 1).alias("subscription_id"), "entity", "reason"
    )


def catalog_roundtrip(spark, sf):
    """Rows of every table by name from the catalog, after two refreshes in different load months."""
    folder = session.scratch_dir(spark, "catalog")
    database = f"revtide_{folder.rsplit('-', 1)[1]}"
    sources = tb.write_landing(spark, sf, f"{folder}/landing")
    for stamp in (EXTRACTED_AT - dt.timedelta(days=40), EXTRACTED_AT):
        refresh.full_refresh(spark, sources, f"{folder}/tables", AS_OF, stamp, database=database)
    tables.delete_folder(spark, f"{folder}/landing")
    counts = checks.table_counts({name: spark.table(f"{database}.{name}") for name in schemas.TABLES})
    stored = session.scratch_dir(spark, "catalog-counts")
    counts.write.parquet(stored)
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return spark.read.parquet(stored)


def subscriptions_from_references(spark, sf):
    """No subscriptions delivered: those that invoices name are stored, known owner or not."""
    folder = session.scratch_dir(spark, "references")
    sources = tb.write_landing(spark, sf, f"{folder}/landing")
    known = spark.read.text(sources["customers"]).filter(
        F.get_json_object("value", "$.description") == "BUILDING"
    )
    known.write.option("compression", "gzip").text(f"{folder}/known")
    spark.createDataFrame([], "value string").write.text(f"{folder}/none")
    landed = sources | {
        "customers": f"{folder}/known", "subscriptions": f"{folder}/none", "subscriptions_lookup": sources["subscriptions"],
    }
    refresh.full_refresh(spark, landed, f"{folder}/tables", AS_OF, EXTRACTED_AT)
    for name in ("landing", "known", "none"):
        tables.delete_folder(spark, f"{folder}/{name}")
    return tables.read_table(spark, f"{folder}/tables", "subscriptions").select("subscription_id", "customer_id", "status")


def _in_two_extracts(spark, sf):
    """A full refresh of a part of the landing files, then an increment with the rest.

    By key: every fourth customer comes late, a third of the invoices and
    subscriptions too, and another third is delivered again, as void.
    """
    folder = session.scratch_dir(spark, "increment")
    key = F.regexp_extract("value", '"id":"[a-z]+_([0-9]+)', 1).cast("bigint")

    def early(name, lines):
        if name in ("products", "prices"):
            return lines
        return lines.filter(key % 4 != 0 if name == "customers" else key % 3 != 0)

    def late(name, lines):
        if name in ("products", "prices"):
            return None
        if name == "customers":
            return lines.filter(key % 4 == 0)
        void = F.regexp_replace("value", '"status":"[^"]*"', '"status":"void"')
        return lines.filter(key % 3 != 2).withColumn("value", F.when(key % 3 == 1, void).otherwise(F.col("value")))

    first = tb.write_landing(spark, sf, f"{folder}/first", early, "key % 3 <> 0")
    later = tb.write_landing(spark, sf, f"{folder}/later", late, "key % 3 <> 2")
    warehouse = f"{folder}/tables"
    refresh.full_refresh(spark, first, warehouse, AS_OF, EXTRACTED_AT, buckets=16)
    refresh.incremental_refresh(spark, later, warehouse, AS_OF, EXTRACTED_AT, buckets=16)
    for name in ("first", "later"):
        tables.delete_folder(spark, f"{folder}/{name}")
    return warehouse


def incremental_invoices(spark, sf):
    return _plain_times(tables.read_table(spark, _in_two_extracts(spark, sf), "invoices"))


def incremental_monthly_summary(spark, sf):
    return _plain_times(tables.read_table(spark, _in_two_extracts(spark, sf), "mrr_monthly_summary"))


def failed_refresh_keeps_all_tables(spark, sf):
    """A second load breaks at its last base table; base and derived tables are those of the first."""
    folder = session.scratch_dir(spark, "broken")
    sources = tb.write_landing(spark, sf, f"{folder}/landing")
    refresh.full_refresh(spark, sources, f"{folder}/tables", AS_OF, EXTRACTED_AT)
    undated = F.regexp_replace("value", '"created":[0-9]+,', "").alias("value")
    tb.write_lines(spark.read.text(sources["invoices"]).select(undated), f"{folder}/undated")
    tb.write_lines(spark.read.text(sources["customers"]).filter(F.length("value") % 2 == 0), f"{folder}/fewer")
    for name in ("invoices", "customers"):
        tables.delete_folder(spark, sources[name])
    broken = sources | {"invoices": f"{folder}/undated", "customers": f"{folder}/fewer"}
    try:
        refresh.full_refresh(spark, broken, f"{folder}/tables", AS_OF, EXTRACTED_AT)
    except PySparkException:
        outcome = "failed"
    else:
        outcome = "stored"
    for name in ("landing", "undated", "fewer"):
        tables.delete_folder(spark, f"{folder}/{name}")
    stored = {name: tables.read_table(spark, f"{folder}/tables", name) for name in schemas.TABLES}
    return checks.table_counts(stored).withColumn("outcome", F.lit(outcome))


# Ledgers

def billing_periods(spark, sf):
    return ledger.billing_periods(tb.subscriptions(spark, sf), AS_OF)


def running_net_mrr(spark, sf):
    return ledger.running_net_mrr(monthly_metrics(spark, sf))


def acquisition_pivot(spark, sf):
    return ledger.acquisition_pivot(tb.subscriptions(spark, sf))


def status_share(spark, sf):
    return ledger.status_share(tb.subscriptions(spark, sf))


def plan_distribution(spark, sf):
    return ledger.plan_distribution(tb.subscriptions(spark, sf), tb.products(spark, sf))


def invoices_per_acquisition_month(spark, sf):
    invoices = tb.with_customer(spark, sf, tb.invoices(spark, sf))
    return ledger.invoices_per_acquisition_month(tb.subscriptions(spark, sf), invoices)


QUERIES = {
    fn.__name__: fn
    for fn in (
        status_summary, api_subscriptions, pie_series, mrr_by_plan, mrr_by_plan_no_amount,
        customer_churn_analysis, revenue_by_collection_method,
        revenue_by_collection_method_any_keys, revenue_by_collection_method_unfanned,
        month_series, monthly_metrics, monthly_summary, mrr_growth_trend, mrr_trend_analysis,
        growth_trend_inline, api_mrr_trend, monthly_table, chart_series, latest_summary,
        kpi_cards, cohort_assignment, cohort_retention, cohort_table, flatten_customers,
        flatten_products, flatten_prices, flatten_subscriptions, flatten_invoices,
        mrr_normalization, dedup_invoices, dedup_subscriptions, first_nonempty_source,
        entities_from_references, children_of_known_parents, union_sources, created_since,
        required_violations, table_counts, roundtrip_overwrite, skip_empty_write,
        roundtrip_ndjson, roundtrip_partitioned_clustered, full_refresh, stored_monthly_summary,
        stored_subscriptions, stored_invoices, stored_customer_cohorts,
        failed_refresh_keeps_table, landing_rejects, catalog_roundtrip,
        subscriptions_from_references, incremental_invoices, incremental_monthly_summary,
        failed_refresh_keeps_all_tables, billing_periods, running_net_mrr, acquisition_pivot,
        status_share, plan_distribution, invoices_per_acquisition_month,
    )
}


def configured(query):
    """The query on a session with the library's settings."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(session.configure(spark), sf_dir)

    return run
