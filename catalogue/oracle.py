"""Plain SQL for the named queries, written without the library's rewrites.

The monthly metrics cross-join months with subscriptions and the cohorts probe
every customer and month, so the Spark plans are checked against the literal
definitions.
"""

from __future__ import annotations

AS_OF = "DATE '2001-12-31'"
STAMP = "TIMESTAMP '2002-01-01 00:00:00'"

# The sample tables as billing tables.  Each entry may use the earlier ones.
BASE = {
    "b_customers": """
        SELECT concat('cus_', CAST(c_custkey AS VARCHAR)) AS customer_id,
               concat('billing@', lower(replace(c_name, '#', '')), '.com') AS email,
               c_name AS name, c_mktsegment AS description, c_acctbal < 1000 AS delinquent, c_custkey
        FROM customer""",
    "b_products": """
        SELECT DISTINCT concat('prod_', lower(p_type)) AS product_id, p_type AS name FROM part""",
    "b_prices": """
        SELECT p_partkey, concat('price_', CAST(p_partkey AS VARCHAR)) AS price_id,
               concat('prod_', lower(p_type)) AS product_id,
               CAST(round(p_retailprice * 100) AS BIGINT) AS unit_amount,
               CASE WHEN p_size <= 2 THEN NULL
                    WHEN p_partkey % 5 <= 1 THEN 'month' WHEN p_partkey % 5 = 2 THEN 'year'
                    WHEN p_partkey % 5 = 3 THEN 'week' ELSE 'day' END AS recurring_interval,
               p_brand AS nickname
        FROM part""",
    "b_first_items": """
        SELECT l_orderkey, l_partkey, CAST(l_quantity AS BIGINT) AS quantity
        FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey,
                     l_suppkey, l_shipdate, l_extendedprice) AS item_no FROM lineitem)
        WHERE item_no = 1""",
    "b_order_facts": """
        SELECT o_orderkey, concat('sub_', CAST(o_orderkey AS VARCHAR)) AS subscription_id,
               concat('cus_', CAST(o_custkey AS VARCHAR)) AS customer_id,
               CASE o_orderstatus WHEN 'F' THEN 'canceled' WHEN 'O' THEN 'active'
                    WHEN 'P' THEN 'past_due' END AS status,
               CAST(o_orderdate AS DATE) AS start_date,
               CASE WHEN o_orderstatus = 'F'
                    THEN CAST(o_orderdate AS DATE) + CAST(1 + o_orderkey % 400 AS INTEGER)
                    WHEN o_orderstatus = 'O' AND o_orderkey % 50 = 0
                    THEN CAST(o_orderdate AS DATE) + 30 END AS canceled_at,
               o_orderstatus = 'O' AND o_orderkey % 50 = 0 AS cancel_at_period_end,
               CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'send_invoice'
                    ELSE 'charge_automatically' END AS collection_method
        FROM orders""",
    "b_subscriptions": """
        SELECT o.*, p.price_id, p.product_id, p.unit_amount, coalesce(i.quantity, 1) AS quantity,
               CASE p.recurring_interval
                    WHEN 'month' THEN CAST(p.unit_amount * coalesce(i.quantity, 1) AS DOUBLE) / 100
                    WHEN 'year' THEN CAST(p.unit_amount * coalesce(i.quantity, 1) AS DOUBLE) / 12 / 100
                    WHEN 'week' THEN CAST(p.unit_amount * coalesce(i.quantity, 1) AS DOUBLE)
                                     * CAST(4.33 AS DOUBLE) / 100
                    ELSE CAST(0 AS DOUBLE) END AS mrr_amount
        FROM b_order_facts o LEFT JOIN b_first_items i ON o.o_orderkey = i.l_orderkey
             LEFT JOIN b_prices p ON i.l_partkey = p.p_partkey""",
    "b_raw_invoices": """
        SELECT concat('in_', CAST(l_orderkey AS VARCHAR), '_', CAST(l_linenumber AS VARCHAR)) AS invoice_id,
               CASE WHEN l_linenumber <> 7 THEN concat('sub_', CAST(l_orderkey AS VARCHAR)) END AS subscription_id,
               concat('cus_', CAST(o_custkey AS VARCHAR)) AS customer_id,
               CASE WHEN l_linestatus = 'F' THEN 'paid' WHEN l_returnflag = 'R' THEN 'uncollectible'
                    WHEN l_returnflag = 'A' THEN 'open' WHEN l_returnflag = 'N' THEN 'void' END AS status,
               CAST(round(l_extendedprice * 100) AS BIGINT) AS total,
               CASE WHEN l_linestatus = 'F' THEN CAST(round(l_extendedprice * 100) AS BIGINT) ELSE 0 END AS amount_paid,
               CASE WHEN l_linestatus = 'F' THEN 0 ELSE CAST(round(l_extendedprice * 100) AS BIGINT) END AS amount_remaining,
               l_shipdate AS created, CASE WHEN l_linestatus = 'F' THEN l_shipdate END AS paid_at,
               l_partkey, l_suppkey, l_orderkey
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "b_invoices": """
        SELECT * EXCLUDE (copy_no) FROM (
          SELECT *, row_number() OVER (PARTITION BY invoice_id
                 ORDER BY created, l_partkey, l_suppkey, total, status) AS copy_no FROM b_raw_invoices)
        WHERE copy_no = 1""",
}


def with_base(body: str, extra: dict[str, str] | None = None) -> str:
    parts = {**BASE, **(extra or {})}
    # Only the definitions the query reaches.
    used, text = [], body
    for name in reversed(parts):
        if name in text:
            used.insert(0, f"{name} AS ({parts[name]})")
            text += parts[name]
    return f"WITH {', '.join(used)} {body}" if used else body


def money(amount: str) -> str:
    return f"CAST(sum(CAST({amount} AS DECIMAL(18,6))) AS DOUBLE)"


def months_of(subscriptions: str) -> dict[str, str]:
    return {
        "m_months": f"""
            SELECT CAST(unnest(generate_series(
                     CAST(date_trunc('month', (SELECT min(CAST(start_date AS DATE)) FROM {subscriptions})) AS DATE),
                     CAST(date_trunc('month', {AS_OF}) AS DATE), INTERVAL 1 MONTH)) AS DATE) AS month_start"""
    }


def metrics_of(subscriptions: str) -> dict[str, str]:
    """Literal month-by-subscription metrics."""
    next_month = "CAST(m.month_start + INTERVAL 1 MONTH AS DATE)"
    start, cancel = "CAST(s.start_date AS DATE)", "CAST(s.canceled_at AS DATE)"
    active = f"{start} <= {next_month} AND (s.canceled_at IS NULL OR {cancel} >= {next_month})"
    new = f"{start} >= m.month_start AND {start} < {next_month}"
    churned = f"s.canceled_at IS NOT NULL AND {cancel} >= m.month_start AND {cancel} < {next_month}"

    def amount(condition: str) -> str:
        return (
            f"CAST(sum(CASE WHEN {condition} THEN CAST(s.mrr_amount AS DECIMAL(18,6)) "
            "ELSE CAST(0 AS DECIMAL(18,6)) END) AS DOUBLE)"
        )

    def customers(condition: str) -> str:
        return f"count(DISTINCT CASE WHEN {condition} THEN s.customer_id END)"

    return {
        **months_of(subscriptions),
        "m_grid": f"""
            SELECT strftime(m.month_start, '%Y-%m') AS month_year, m.month_start AS month_start_date,
                   {amount(active)} AS total_mrr, {amount(new)} AS new_mrr, {amount(churned)} AS churned_mrr,
                   {customers(active)} AS active_customers, {customers(new)} AS new_customers,
                   {customers(churned)} AS churned_customers
            FROM m_months m CROSS JOIN {subscriptions} s GROUP BY m.month_start""",
        "m_metrics": """
            SELECT month_year, month_start_date, total_mrr, new_mrr, CAST(0 AS DOUBLE) AS expansion_mrr,
                   CAST(0 AS DOUBLE) AS contraction_mrr, churned_mrr, new_mrr - churned_mrr AS net_new_mrr,
                   active_customers, new_customers, churned_customers,
                   CASE WHEN active_customers <> 0 THEN total_mrr / active_customers END AS average_revenue_per_user,
                   CASE WHEN active_customers <> 0
                        THEN CAST(churned_customers AS DOUBLE) / active_customers END AS churn_rate,
                   lag(total_mrr) OVER (ORDER BY month_start_date) AS prev_month_mrr
            FROM m_grid WHERE active_customers > 0 OR new_customers > 0 OR churned_customers > 0""",
        "m_summary": f"""
            SELECT month_year, month_start_date, total_mrr, new_mrr, expansion_mrr, contraction_mrr,
                   churned_mrr, net_new_mrr, active_customers, new_customers, churned_customers,
                   coalesce(average_revenue_per_user, 0) AS average_revenue_per_user,
                   coalesce(churn_rate, 0) AS churn_rate,
                   CASE WHEN prev_month_mrr > 0 THEN (total_mrr - prev_month_mrr) / prev_month_mrr * 100
                        ELSE CAST(0 AS DOUBLE) END AS growth_rate,
                   {STAMP} AS calculated_at
            FROM m_metrics""",
    }


def cohorts_of(subscriptions: str) -> dict[str, str]:
    """Literal cohort, customer and month probing."""
    return {
        **months_of(subscriptions),
        "c_customers": f"""
            SELECT customer_id, CAST(date_trunc('month', min(CAST(start_date AS DATE))) AS DATE) AS cohort_start_date,
                   strftime(min(CAST(start_date AS DATE)), '%Y-%m') AS cohort_month
            FROM {subscriptions} GROUP BY customer_id""",
        "c_sizes": """
            SELECT cohort_month, count(DISTINCT customer_id) AS customers_in_cohort
            FROM c_customers GROUP BY cohort_month""",
        "c_activity": f"""
            SELECT c.cohort_month, c.cohort_start_date, c.customer_id,
                   CAST(date_diff('month', c.cohort_start_date, m.month_start) AS INTEGER) AS period_number,
                   CASE WHEN EXISTS (SELECT 1 FROM {subscriptions} s WHERE s.customer_id = c.customer_id
                          AND CAST(s.start_date AS DATE) <= CAST(m.month_start + INTERVAL 1 MONTH AS DATE)
                          AND (s.canceled_at IS NULL OR CAST(s.canceled_at AS DATE) >= m.month_start))
                        THEN 1 ELSE 0 END AS is_active
            FROM c_customers c JOIN m_months m ON m.month_start >= c.cohort_start_date""",
        "c_retention": """
            SELECT cohort_month, cohort_start_date, period_number, customers_in_cohort,
                   CAST(sum(is_active) AS BIGINT) AS active_customers,
                   CAST(sum(is_active) AS DOUBLE) / customers_in_cohort AS retention_rate,
                   CAST(0 AS DOUBLE) AS cohort_revenue, CAST(0 AS DOUBLE) AS revenue_per_customer
            FROM c_activity JOIN c_sizes USING (cohort_month) WHERE period_number <= 12
            GROUP BY cohort_month, cohort_start_date, period_number, customers_in_cohort""",
    }


METRICS, COHORTS = metrics_of("b_subscriptions"), cohorts_of("b_subscriptions")

STATUS = f"SELECT status, count(*) AS count, {money('mrr_amount')} AS mrr FROM b_subscriptions GROUP BY status"


def by_plan(keys: str, average: bool) -> str:
    extra = f", {money('s.mrr_amount')} / count(s.mrr_amount) AS avg_mrr_per_customer" if average else ""
    return f"""
        SELECT p.name AS plan_name, pr.nickname AS price_nickname,
               count(DISTINCT s.customer_id) AS customers, {money('s.mrr_amount')} AS total_mrr{extra}
        FROM b_subscriptions s JOIN b_prices pr ON s.price_id = pr.price_id
             JOIN b_products p ON s.product_id = p.product_id
        WHERE s.status = 'active' GROUP BY {keys}"""


def by_method(invoices: str, repeated: bool = True) -> str:
    paid = "count(DISTINCT CASE WHEN i.status = 'paid' THEN i.invoice_id END)"
    total = (
        money("s.mrr_amount")
        if repeated
        else f"""(SELECT {money('u.mrr_amount')} FROM b_subscriptions u
                  WHERE u.status IN ('active', 'past_due') AND u.collection_method = s.collection_method)"""
    )
    return f"""
        SELECT s.collection_method, count(DISTINCT s.customer_id) AS customers, {total} AS total_mrr,
               count(DISTINCT i.invoice_id) AS total_invoices, {paid} AS paid_invoices,
               CASE WHEN count(DISTINCT i.invoice_id) <> 0
                    THEN CAST({paid} AS DOUBLE) / count(DISTINCT i.invoice_id) * 100 END AS payment_success_rate
        FROM b_subscriptions s LEFT JOIN {invoices} i ON s.subscription_id = i.subscription_id
        WHERE s.status IN ('active', 'past_due') GROUP BY s.collection_method"""


# Display strings

def dollars(value: str) -> str:
    return (
        f"concat(CASE WHEN {value} < 0 THEN '-' ELSE '' END, '$', "
        f"format('{{:,}}', CAST(round(abs({value})) AS BIGINT)))"
    )


def one_decimal(value: str) -> str:
    # printf rounds the exact value but sends exact halves to the even digit.
    half = f"abs({value}) * 4 = floor(abs({value}) * 4) AND CAST(abs({value}) * 4 AS BIGINT) % 2 = 1"
    text = f"printf('%.1f', CASE WHEN {half} THEN abs({value}) + 0.05 ELSE abs({value}) END)"
    return f"concat(CASE WHEN {value} < 0 THEN '-' ELSE '' END, {text})"


TREND = {
    **METRICS,
    "t_trend": """
        SELECT month_year AS month, strftime(month_start_date, '%b %Y') AS "monthLabel",
               total_mrr AS "totalMrr", new_mrr AS "newMrr", churned_mrr AS "churnedMrr",
               net_new_mrr AS "netNewMrr", active_customers AS "activeCustomers",
               churned_customers AS "churnedCustomers", growth_rate AS "growthRate",
               churn_rate * 100 AS "churnRate", average_revenue_per_user AS arpu
        FROM m_summary""",
}

LATEST = {
    **METRICS,
    "t_latest": """
        SELECT l.total_mrr AS "currentMrr", l.active_customers AS "activeCustomers",
               l.average_revenue_per_user AS arpu, l.churn_rate * 100 AS "churnRate",
               l.growth_rate AS "growthRate", n.active, n.canceled, n."pastDue"
        FROM (SELECT * FROM m_summary ORDER BY month_start_date DESC LIMIT 1) l
        CROSS JOIN (SELECT count(*) FILTER (status = 'active') AS active,
                           count(*) FILTER (status = 'canceled') AS canceled,
                           count(*) FILTER (status = 'past_due') AS "pastDue" FROM b_subscriptions) n""",
}

KPI = f"""
    SELECT 1 AS position, 'Current MRR' AS title, {dollars('"currentMrr"')} AS value,
           CAST(NULL AS VARCHAR) AS subtitle,
           concat(CASE WHEN "growthRate" >= 0 THEN '↑' ELSE '↓' END, ' ',
                  {one_decimal('abs("growthRate")')}, '% from last month') AS trend FROM t_latest
    UNION ALL SELECT 2, 'Active Customers', CAST("activeCustomers" AS VARCHAR),
           concat(CAST("pastDue" AS VARCHAR), ' past due'), NULL FROM t_latest
    UNION ALL SELECT 3, 'ARPU', {dollars('arpu')}, 'Average Revenue Per User', NULL FROM t_latest
    UNION ALL SELECT 4, 'Churn Rate', concat({one_decimal('"churnRate"')}, '%'),
           concat(CAST(canceled AS VARCHAR), ' canceled'), NULL FROM t_latest"""

CHARTS = """
    SELECT month, 'mrr_trend' AS chart, 'MRR' AS series, "totalMrr" AS value,
           concat('$', regexp_replace(CAST("totalMrr" / 1000 AS VARCHAR), '\\.0$', ''), 'k') AS tick FROM t_trend
    UNION ALL SELECT month, 'mrr_trend', 'Active Subscriptions', CAST("activeCustomers" AS DOUBLE), NULL FROM t_trend
    UNION ALL SELECT month, 'new_vs_churned', 'New MRR', "newMrr", NULL FROM t_trend
    UNION ALL SELECT month, 'new_vs_churned', 'Churned MRR', "churnedMrr", NULL FROM t_trend
    UNION ALL SELECT month, 'customer_growth', 'Active Customers', CAST("activeCustomers" AS DOUBLE), NULL FROM t_trend"""


# Landing objects, computed directly as table rows

def at(seconds: str) -> str:
    return f"make_timestamp(({seconds}) * 1000000)"


DAY0 = "9131 * 86400"
_START = "CAST(epoch(CAST(start_date AS TIMESTAMP)) AS BIGINT)"
_CANCEL = "CAST(epoch(CAST(canceled_at AS TIMESTAMP)) AS BIGINT)"

LANDED = {
    "f_subscriptions": f"""
        SELECT subscription_id, customer_id, status,
               {at('period_start')} AS current_period_start,
               {at('coalesce(item_end, period_start)')} AS current_period_end,
               coalesce({at('started')}, {STAMP}) AS start_date,
               CASE WHEN status = 'canceled' THEN {at('canceled')} END AS ended_at,
               {at('canceled')} AS canceled_at,
               CASE WHEN k % 2 = 1 THEN at_end ELSE FALSE END AS cancel_at_period_end,
               collection_method, coalesce({at('created_s')}, {STAMP}) AS created,
               CASE WHEN k % 9 = 1 THEN 'eur' ELSE 'usd' END AS currency,
               CASE WHEN has_item THEN price_id END AS price_id,
               CASE WHEN has_item THEN product_id END AS product_id,
               ua AS unit_amount, q AS quantity,
               CASE WHEN NOT has_item OR billed IS NULL THEN CAST(0 AS DOUBLE)
                    WHEN billed = 'month' THEN CAST(ua * q AS DOUBLE) / 100
                    WHEN billed = 'year' THEN CAST(ua * q AS DOUBLE) / 12 / 100
                    WHEN billed = 'week' THEN CAST(ua * q AS DOUBLE) * CAST(4.33 AS DOUBLE) / 100
                    ELSE CAST(0 AS DOUBLE) END AS mrr_amount,
               {STAMP} AS extracted_at
        FROM (
          SELECT *, CASE WHEN has_item THEN CASE WHEN k % 13 = 0 THEN 0 ELSE unit_amount END END AS ua,
                 CASE WHEN has_item AND k % 11 <> 0 THEN quantity ELSE 1 END AS q,
                 CASE WHEN k % 17 = 0 AND recurring_interval IS NOT NULL THEN 'month'
                      ELSE recurring_interval END AS billed,
                 coalesce(CASE WHEN has_item AND k % 7 > 1 THEN start_s + 86400 END,
                          CASE WHEN k % 3 <> 0 THEN start_s + 3600 END, started, created_s,
                          CAST(epoch({STAMP}) AS BIGINT)) AS period_start,
                 CASE WHEN has_item AND k % 5 <> 0 THEN start_s + 31 * 86400 END AS item_end
          FROM (
            SELECT o.o_orderkey AS k, o.subscription_id, o.customer_id, o.status, o.collection_method,
                   o.cancel_at_period_end AS at_end, i.quantity, p.price_id, p.product_id, p.unit_amount,
                   p.recurring_interval, p.price_id IS NOT NULL AND o.o_orderkey % 29 <> 0 AS has_item,
                   {_START} AS start_s, {_CANCEL} AS canceled,
                   CASE WHEN o.o_orderkey % 19 > 1 THEN {_START} END AS started,
                   CASE WHEN o.o_orderkey % 23 <> 0 THEN {_START} END AS created_s
            FROM b_order_facts o LEFT JOIN b_first_items i ON o.o_orderkey = i.l_orderkey
                 LEFT JOIN b_prices p ON i.l_partkey = p.p_partkey))
        WHERE NOT (has_item AND k % 31 = 0)""",
}


def invoices_flat(source: str) -> str:
    return f"""
        SELECT invoice_id, concat('N-', substr(invoice_id, 4)) AS invoice_number, customer_id,
               subscription_id, status, total AS amount_due, amount_paid, amount_remaining,
               total AS subtotal, total, 'usd' AS currency, created,
               CASE WHEN l_partkey % 3 = 1 THEN created + INTERVAL 7 DAY END AS due_date,
               created AS period_start,
               CASE WHEN l_partkey % 2 = 0 THEN created + INTERVAL 30 DAY END AS period_end,
               CASE WHEN l_partkey % 5 <> 0 THEN paid_at END AS paid_at,
               'charge_automatically' AS collection_method,
               concat('https://pay.invalid/', invoice_id) AS hosted_invoice_url,
               concat('https://pay.invalid/', invoice_id, '.pdf') AS invoice_pdf, {STAMP} AS extracted_at
        FROM {source}"""


REFRESHED_METRICS = {**LANDED, **metrics_of("f_subscriptions")}
REFRESHED = {**LANDED, **metrics_of("f_subscriptions"), **cohorts_of("f_subscriptions")}


_ELAPSED = f"date_diff('day', start_date, least(coalesce(canceled_at, {AS_OF}), {AS_OF}))"


_ACQUISITIONS = """
    SELECT customer_id, strftime(min(start_date), '%Y-%m') AS acquisition_month,
           CASE WHEN bool_or(status = 'active') THEN 'active' WHEN bool_or(status = 'past_due') THEN 'past_due'
                ELSE 'canceled' END AS status
    FROM b_subscriptions GROUP BY customer_id"""

_REFRESHED_COUNTS = """
    SELECT 'customers' AS table_name, count(*) AS row_count FROM b_customers
    UNION ALL SELECT 'products', count(*) FROM b_products
    UNION ALL SELECT 'prices', count(*) FROM b_prices
    UNION ALL SELECT 'subscriptions', count(*) FROM f_subscriptions
    UNION ALL SELECT 'invoices', count(*) FROM b_invoices
    UNION ALL SELECT 'mrr_monthly_summary', count(*) FROM m_metrics
    UNION ALL SELECT 'customer_cohorts', count(*) FROM c_retention"""

_SUMMARY_ROWS = "SELECT {} FROM m_summary"
_TREND_COLUMNS = {
    "mrr_growth_trend": "month_year, total_mrr, new_mrr, churned_mrr, net_new_mrr, growth_rate, active_customers, churn_rate",
    "mrr_trend_analysis": "month_year, month_start_date, total_mrr, new_mrr, churned_mrr, net_new_mrr, "
    "active_customers, churned_customers, growth_rate, churn_rate, average_revenue_per_user",
    "growth_trend_inline": "month_year, total_mrr, new_mrr, churned_mrr, growth_rate",
}

ORACLE = {
    "status_summary": with_base(STATUS),
    "api_subscriptions": with_base(f"SELECT status, count, coalesce(mrr, 0) AS mrr FROM ({STATUS})"),
    "pie_series": with_base(
        f"""SELECT concat(upper(substr(status, 1, 1)),
                          regexp_replace(substr(status, 2), '_', ' ')) AS name, count AS value FROM ({STATUS})"""
    ),
    "mrr_by_plan": with_base(by_plan("p.name, pr.nickname, pr.unit_amount", True)),
    "mrr_by_plan_no_amount": with_base(by_plan("p.name, pr.nickname", False)),
    "customer_churn_analysis": with_base(
        f"""SELECT CAST(date_trunc('month', canceled_at) AS DATE) AS churn_month,
                   count(*) AS churned_customers, {money('mrr_amount')} AS churned_mrr,
                   CAST(sum(date_diff('day', start_date, canceled_at)) AS DOUBLE) / count(*) AS avg_lifetime_days
            FROM b_subscriptions WHERE status = 'canceled' AND canceled_at IS NOT NULL GROUP BY 1"""
    ),
    "revenue_by_collection_method": with_base(by_method("b_invoices")),
    "revenue_by_collection_method_any_keys": with_base(by_method("b_raw_invoices")),
    "revenue_by_collection_method_unfanned": with_base(by_method("b_invoices", repeated=False)),
    "month_series": with_base(
        "SELECT strftime(month_start, '%Y-%m') AS month_year, month_start AS month_start_date FROM m_months",
        METRICS,
    ),
    "monthly_metrics": with_base("SELECT * FROM m_metrics", METRICS),
    "monthly_summary": with_base("SELECT * FROM m_summary", METRICS),
    **{k: with_base(_SUMMARY_ROWS.format(v), METRICS) for k, v in _TREND_COLUMNS.items()},
    "api_mrr_trend": with_base("SELECT * FROM t_trend", TREND),
    "monthly_table": with_base(
        f"""SELECT month, {dollars('"totalMrr"')} AS total_mrr, concat('+', {dollars('"newMrr"')}) AS new_mrr,
                   concat('-', {dollars('"churnedMrr"')}) AS churned_mrr, {dollars('"netNewMrr"')} AS net_new,
                   "activeCustomers" AS customers,
                   CASE WHEN "growthRate" = 0 THEN '-'
                        ELSE concat(CASE WHEN "growthRate" >= 0 THEN '+' ELSE '' END,
                                    {one_decimal('"growthRate"')}, '%') END AS growth FROM t_trend""",
        TREND,
    ),
    "chart_series": with_base(CHARTS, TREND),
    "latest_summary": with_base("SELECT * FROM t_latest", LATEST),
    "kpi_cards": with_base(KPI, LATEST),
    "cohort_assignment": with_base("SELECT * FROM c_customers", COHORTS),
    "cohort_retention": with_base("SELECT * FROM c_retention", COHORTS),
    "cohort_table": with_base(f"SELECT *, {STAMP} AS calculated_at FROM c_retention", COHORTS),
    "flatten_customers": with_base(
        f"""SELECT customer_id, email, name, description, {at(f'{DAY0} + c_custkey * 60')} AS created,
                   'usd' AS currency, delinquent,
                   CASE WHEN c_custkey % 3 <= 1 THEN concat('clock_', CAST(c_custkey % 7 AS VARCHAR)) END AS test_clock_id,
                   CASE WHEN c_custkey % 4 <> 0 AND c_custkey % 5 <> 0
                        THEN concat('pm_', CAST(c_custkey AS VARCHAR)) END AS default_payment_method,
                   {STAMP} AS extracted_at FROM b_customers"""
    ),
    "flatten_products": with_base(
        f"""SELECT product_id, name, concat('Plan ', lower(name)) AS description, TRUE AS active,
                   {at(f'{DAY0} + length(name) * 86400')} AS created,
                   {at(f'{DAY0} + length(name) * 2 * 86400')} AS updated, {STAMP} AS extracted_at FROM b_products"""
    ),
    "flatten_prices": with_base(
        f"""SELECT price_id, product_id, TRUE AS active, 'usd' AS currency, unit_amount, recurring_interval,
                   CASE WHEN recurring_interval IS NOT NULL THEN p_partkey % 3 + 1 END AS recurring_interval_count,
                   nickname, {at(f'{DAY0} + p_partkey')} AS created, {STAMP} AS extracted_at FROM b_prices"""
    ),
    "flatten_subscriptions": with_base("SELECT * FROM f_subscriptions", LANDED),
    "flatten_invoices": with_base(invoices_flat("b_raw_invoices")),
    "mrr_normalization": with_base(
        """SELECT price_id, recurring_interval, unit_amount,
                  CASE recurring_interval WHEN 'month' THEN CAST(unit_amount * 3 AS DOUBLE) / 100
                       WHEN 'year' THEN CAST(unit_amount * 3 AS DOUBLE) / 12 / 100
                       WHEN 'week' THEN CAST(unit_amount * 3 AS DOUBLE) * CAST(4.33 AS DOUBLE) / 100
                       ELSE CAST(0 AS DOUBLE) END AS mrr_amount FROM b_prices"""
    ),
    "dedup_invoices": with_base(
        """SELECT invoice_id, subscription_id, status, total, amount_paid, amount_remaining, created, paid_at
           FROM b_invoices"""
    ),
    "dedup_subscriptions": with_base(
        "SELECT subscription_id, customer_id, status, 1 AS arrival FROM b_order_facts"
    ),
    "first_nonempty_source": with_base(
        "SELECT customer_id, email, description FROM b_customers WHERE description = 'BUILDING'"
    ),
    "entities_from_references": with_base(
        """SELECT customer_id, email FROM b_customers c WHERE EXISTS (
             SELECT 1 FROM b_raw_invoices i WHERE i.customer_id = c.customer_id AND i.status = 'open')"""
    ),
    "children_of_known_parents": with_base(
        """SELECT subscription_id, customer_id, status FROM b_order_facts WHERE customer_id IN (
             SELECT customer_id FROM b_customers WHERE description = 'BUILDING')"""
    ),
    "union_sources": with_base("SELECT customer_id, description, delinquent FROM b_customers"),
    "created_since": with_base(
        """SELECT invoice_id, status, total, created FROM b_raw_invoices
           WHERE created >= TIMESTAMP '2000-01-01 00:00:00'"""
    ),
    "required_violations": with_base(
        """SELECT 'subscriptions' AS table_name, column_name, CASE column_name
                    WHEN 'customer_id' THEN (SELECT count(*) FROM b_subscriptions WHERE price_id IS NULL)
                    WHEN 'mrr_amount' THEN (SELECT count(*) FROM b_subscriptions WHERE mrr_amount = 0)
                    ELSE 0 END AS violations
           FROM (VALUES ('subscription_id'), ('customer_id'), ('status'), ('created'), ('mrr_amount'),
                        ('extracted_at')) AS t(column_name)"""
    ),
    "table_counts": with_base(
        """SELECT 'customers' AS table_name, count(*) AS row_count FROM b_customers
           UNION ALL SELECT 'products', count(*) FROM b_products
           UNION ALL SELECT 'prices', count(*) FROM b_prices
           UNION ALL SELECT 'subscriptions', count(*) FROM b_subscriptions
           UNION ALL SELECT 'invoices', count(*) FROM b_invoices"""
    ),
    "roundtrip_overwrite": with_base(
        "SELECT price_id, product_id, unit_amount, recurring_interval FROM b_prices WHERE recurring_interval = 'month'"
    ),
    "skip_empty_write": with_base("SELECT price_id, product_id, unit_amount, nickname FROM b_prices"),
    "roundtrip_ndjson": with_base(
        """SELECT subscription_id, status, strftime(start_date, '%Y-%m-%dT00:00:00') AS start_date,
                  strftime(canceled_at, '%Y-%m-%dT00:00:00') AS canceled_at, price_id, quantity FROM b_subscriptions"""
    ),
    "roundtrip_partitioned_clustered": with_base(
        """SELECT invoice_id, customer_id, status, total, created,
                  strftime(created, '%Y-%m') AS load_month FROM b_invoices"""
    ),
    "full_refresh": with_base(_REFRESHED_COUNTS, REFRESHED),
    "stored_monthly_summary": with_base("SELECT * FROM m_summary", REFRESHED_METRICS),
    "stored_subscriptions": with_base("SELECT * FROM f_subscriptions", LANDED),
    "stored_invoices": with_base(invoices_flat("b_invoices")),
    "stored_customer_cohorts": with_base(f"SELECT *, {STAMP} AS calculated_at FROM c_retention", REFRESHED),
    "failed_refresh_keeps_table": with_base(
        "SELECT price_id, product_id, unit_amount, recurring_interval, 'failed' AS outcome FROM b_prices"
    ),
    "landing_rejects": with_base(
        """SELECT subscription_id, 'subscriptions' AS entity, reason FROM (
             SELECT s.subscription_id,
                    CASE WHEN s.o_orderkey % 40 = 1 AND price_there AND s.o_orderkey % 13 <> 0 THEN 'malformed'
                         WHEN s.o_orderkey % 40 = 2 AND item_there THEN 'malformed'
                         WHEN s.o_orderkey % 40 = 3 AND s.o_orderkey % 23 <> 0 THEN 'malformed'
                         WHEN s.o_orderkey % 40 = 4 THEN 'malformed'
                         WHEN s.o_orderkey % 40 = 5 THEN 'no customer'
                         WHEN s.o_orderkey % 40 = 6 THEN 'no status'
                         WHEN item_there AND NOT price_there THEN 'no price' END AS reason
             FROM (SELECT *, price_id IS NOT NULL AND o_orderkey % 29 <> 0 AS item_there,
                          price_id IS NOT NULL AND o_orderkey % 29 <> 0 AND o_orderkey % 31 <> 0 AS price_there
                   FROM b_subscriptions) s)
           WHERE reason IS NOT NULL"""
    ),
    "catalog_roundtrip": with_base(_REFRESHED_COUNTS, REFRESHED),
    "subscriptions_from_references": with_base(
        """SELECT subscription_id, customer_id, status FROM f_subscriptions f WHERE EXISTS (
             SELECT 1 FROM b_raw_invoices i WHERE i.subscription_id = f.subscription_id)""",
        LANDED,
    ),
    "incremental_invoices": with_base(invoices_flat("b_invoices")),
    "incremental_monthly_summary": with_base("SELECT * FROM m_summary", REFRESHED_METRICS),
    "failed_refresh_keeps_all_tables": with_base(
        f"SELECT table_name, row_count, 'failed' AS outcome FROM ({_REFRESHED_COUNTS})", REFRESHED
    ),
    "billing_periods": with_base(
        f"""SELECT subscription_id, CAST(period_number AS INTEGER) AS period_number,
                   start_date + CAST(30 * period_number AS INTEGER) AS period_start
            FROM (SELECT subscription_id, start_date, unnest(range(0, {_ELAPSED} // 30 + 1)) AS period_number
                  FROM b_order_facts WHERE {_ELAPSED} >= 0)"""
    ),
    "running_net_mrr": with_base(
        """SELECT month_year, new_mrr, churned_mrr,
                  CAST(sum(CAST(new_mrr - churned_mrr AS DECIMAL(24,6))) OVER (ORDER BY month_year) AS DOUBLE) AS net_mrr
           FROM m_metrics""",
        METRICS,
    ),
    "acquisition_pivot": with_base(
        f"""SELECT acquisition_month, count(*) AS customers, count(*) FILTER (status = 'active') AS active,
                   count(*) FILTER (status = 'canceled') AS canceled,
                   count(*) FILTER (status = 'past_due') AS past_due
            FROM ({_ACQUISITIONS}) GROUP BY acquisition_month"""
    ),
    "status_share": with_base(
        """SELECT status, count(*) AS subscriptions,
                  CAST(100 * count(*) AS DOUBLE) / (SELECT count(*) FROM b_subscriptions) AS share_percent
           FROM b_subscriptions GROUP BY status"""
    ),
    "plan_distribution": with_base(
        """SELECT p.name AS plan, count(s.subscription_id) AS subscriptions,
                  CAST(100 * count(s.subscription_id) AS DOUBLE)
                  / (SELECT count(*) FROM b_subscriptions JOIN b_products USING (product_id) WHERE status = 'active')
                  AS share_percent
           FROM b_products p LEFT JOIN b_subscriptions s ON s.product_id = p.product_id AND s.status = 'active'
           GROUP BY p.name"""
    ),
    "invoices_per_acquisition_month": with_base(
        f"""SELECT acquisition_month, count(*) AS customers, CAST(coalesce(sum(n), 0) AS BIGINT) AS invoices
            FROM ({_ACQUISITIONS}) LEFT JOIN (
              SELECT customer_id, count(*) AS n FROM b_invoices GROUP BY customer_id) USING (customer_id)
            GROUP BY acquisition_month"""
    ),
}
