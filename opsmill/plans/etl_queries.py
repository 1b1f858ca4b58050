"""Queries for sources, cleaning, features and summaries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from opsmill import config
from opsmill.functions.columns import elapsed_days
from opsmill.operators import clean, features, summaries
from opsmill.plans.fixtures import AS_OF
from opsmill.plans.registry import Tables, query, step
from opsmill.session import scratch_path
from opsmill.sources import tables

AT = f"TIMESTAMP '{AS_OF}'"


def strip_sql(c: str) -> str:
    return rf"regexp_replace({c}, '^\s+|\s+$', '', 'g')"


def business_hours_sql(end: str, start: str) -> str:
    """Whole hours on Monday to Friday between two times, not below zero."""
    def seconds(t):
        s = f"(epoch(({t})::TIMESTAMP) - 345600)"
        return f"(floor({s} / 604800) * 432000 + least({s} - floor({s} / 604800) * 604800, 432000))"
    return f"CAST(greatest(floor(({seconds(end)} - {seconds(start)}) / 3600), 0) AS BIGINT)"


def age_sql(c: str) -> str:
    return f"CAST(floor((epoch_us({AT}) - epoch_us({c})) / 86400000000.0) AS BIGINT)"


STATE_SQL = ("CASE lower(state) WHEN 'new york' THEN 'NY' WHEN 'california' THEN 'CA' "
             "WHEN 'texas' THEN 'TX' ELSE state END")
DATE_SQL = ("coalesce(try_strptime(order_date, '%Y-%m-%d'), try_strptime(order_date, '%m/%d/%Y'), "
            "try_strptime(order_date, '%Y-%m-%dT%H:%M:%S'))")

step("products_c", f"""
SELECT product_id, {strip_sql('name')} AS name,
       upper(substr({strip_sql('category')}, 1, 1)) || lower(substr({strip_sql('category')}, 2)) AS category,
       price, cost, stock_level, restock_threshold, discontinued,
       round_even((price - cost) / price * 100, 2) AS margin_pct
FROM raw_products""")
step("customers_c", f"""
SELECT customer_id, customer_ref, email, city, {STATE_SQL} AS state,
       coalesce(acquisition_channel, 'unknown') AS acquisition_channel,
       CAST(created_at AS TIMESTAMP) AS created_at, {age_sql('CAST(created_at AS TIMESTAMP)')} AS tenure_days
FROM (SELECT customer_id, customer_ref, lower({strip_sql('email')}) AS email, city, state,
             acquisition_channel, created_at FROM raw_customers)
QUALIFY row_number() OVER (PARTITION BY email ORDER BY customer_id) = 1""")
step("orders_d", "SELECT DISTINCT * FROM raw_orders")
step("orders_p", f"SELECT * REPLACE ({DATE_SQL} AS order_date) FROM orders_d")
step("orders_c", f"""
SELECT order_id, coalesce(customer_id, -1) AS customer_id,
       coalesce(customer_email, 'guest@unknown.com') AS customer_email, order_date, product_id, quantity, price,
       discount_applied = 1 AS discount_applied, is_subscription = 1 AS is_subscription,
       CASE WHEN order_status IS NOT NULL THEN order_status
            WHEN {age_sql('order_date')} > 30 THEN 'delivered' WHEN {age_sql('order_date')} > 7 THEN 'shipped'
            WHEN {age_sql('order_date')} > 0 THEN 'processing' END AS order_status,
       returned = 1 AS returned, return_reason
FROM orders_p WHERE order_date IS NOT NULL""")
step("orders_f", """
SELECT *, isodow(order_date) - 1 AS day_of_week, isodow(order_date) >= 6 AS is_weekend,
       month(order_date) AS month,
       CASE WHEN month(order_date) IN (12, 1, 2) THEN 'winter' WHEN month(order_date) <= 5 THEN 'spring'
            WHEN month(order_date) <= 8 THEN 'summer' ELSE 'fall' END AS season,
       CASE WHEN discount_applied THEN price * quantity * 0.9 ELSE price * quantity END AS order_value
FROM orders_c""")
step("history", f"""
SELECT customer_id, count(DISTINCT order_id) AS total_orders, min(order_date) AS first_order_date,
       max(order_date) AS last_order_date, sum(price) AS total_revenue,
       count(DISTINCT order_id) > 1 AS is_repeat_customer, {age_sql('max(order_date)')} AS days_since_last_order
FROM orders_c WHERE customer_id > 0 GROUP BY customer_id""")
step("customers_f", """
SELECT c.*, coalesce(total_orders, 0) AS total_orders, first_order_date, last_order_date,
       coalesce(total_revenue, 0) AS total_revenue, coalesce(is_repeat_customer, false) AS is_repeat_customer,
       days_since_last_order
FROM customers_c c LEFT JOIN history h USING (customer_id)""")
step("sales", """
SELECT product_id, count(DISTINCT order_id) AS num_orders, CAST(sum(quantity) AS BIGINT) AS units_sold,
       sum(order_value) AS total_revenue
FROM orders_f WHERE quantity > 0 GROUP BY product_id""")
step("products_f", """
SELECT p.*, coalesce(num_orders, 0) AS num_orders, coalesce(units_sold, 0) AS units_sold,
       coalesce(total_revenue, 0) AS total_revenue, stock_level < restock_threshold AS needs_restock
FROM products_c p LEFT JOIN sales s USING (product_id)""")

ORDER_COLUMNS = ("order_id, customer_id, customer_email, {d}, product_id, CAST(quantity AS BIGINT) AS quantity, "
                 "price, discount_applied, is_subscription, order_status, returned, return_reason")
RAW_ORDER_SQL = ORDER_COLUMNS.format(d="order_date")
DAY = "CAST(CAST(order_date AS DATE) AS VARCHAR) AS order_date"
CLEAN_ORDER_SQL = ORDER_COLUMNS.format(d=DAY)


# --- sources ----------------------------------------------------------------

@query("src_1_scan_tables", """
SELECT 'products' AS table_name, count(*) AS n FROM raw_products
UNION ALL SELECT 'customers', count(*) FROM raw_customers
UNION ALL SELECT 'orders', count(*) FROM raw_orders""")
def scan_tables(t: Tables):
    """The raw tables are written under their schemas and loaded again."""
    root = scratch_path(t.spark, "raw")
    for name, df, schema in (("products", t.raw_products, tables.PRODUCT_SCHEMA), ("customers", t.raw_customers, tables.CUSTOMER_SCHEMA),
                             ("orders", t.raw_orders, tables.ORDER_SCHEMA)):
        fields = StructType.fromDDL(schema)
        df.select(*[F.col(f.name).cast(f.dataType) for f in fields]).write.parquet(f"{root}/{name}")
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
             for name, df in zip(("products", "customers", "orders"), tables.load_raw(t.spark, root))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("src_1_corrupt_rows", """
SELECT 'orders' AS table_name, count(*) AS rows_read, count(*) FILTER (WHERE order_id % 97 = 5) AS corrupt_rows,
       CAST(sum(quantity) FILTER (WHERE order_id % 97 <> 5) AS BIGINT) AS units FROM raw_orders""")
def corrupt_rows(t: Tables):
    """Order lines as JSON, some with a word for their quantity."""
    path = scratch_path(t.spark, "lines")
    line = F.to_json(F.struct(*t.raw_orders.columns))
    bad = F.regexp_replace(line, '"quantity":-?[0-9]+', '"quantity":"two"')
    t.raw_orders.select(F.when(F.col("order_id") % 97 == 5, bad).otherwise(line).alias("value")).write.text(path)
    rows = tables.load_rows(t.spark, path, tables.ORDER_SCHEMA)
    return tables.corrupt_report(rows, "orders", units="quantity").drop("example")


# --- cleaning ---------------------------------------------------------------

@query("cln_1_strip_whitespace", f"""
SELECT product_id, {strip_sql('name')} AS name, {strip_sql('category')} AS category FROM raw_products""")
def strip_whitespace(t: Tables):
    return clean.strip_columns(t.raw_products.select("product_id", "name", "category"), "name", "category")


@query("cln_2_normalise_case", """
SELECT product_id, upper(substr(category, 1, 1)) || lower(substr(category, 2)) AS category FROM raw_products""")
def normalise_case(t: Tables):
    return clean.title_case(t.raw_products.select("product_id", "category"), "category")


@query("cln_3_enforce_types", """
SELECT order_id, customer_id, CAST(quantity AS BIGINT) AS quantity, price,
       discount_applied = 1 AS discount_applied, is_subscription = 1 AS is_subscription, returned = 1 AS returned
FROM raw_orders""", exact=("price",))
def types(t: Tables):
    df = t.raw_orders.select("order_id", "customer_id", "quantity", "price", "discount_applied",
                             "is_subscription", "returned")
    return clean.enforce_types(df, {"quantity": "int", "price": "double", "discount_applied": "boolean",
                                    "is_subscription": "boolean", "returned": "boolean"})


@query("cln_4_margin_pct", """
SELECT product_id, round_even((price - cost) / price * 100, 2) AS margin_pct FROM raw_products""")
def margin(t: Tables):
    return t.raw_products.select("product_id", clean.margin_pct(F.col("price"), F.col("cost")).alias("margin_pct"))


@query("cln_5_dedupe_emails", f"""
SELECT customer_id, email FROM (SELECT customer_id, lower({strip_sql('email')}) AS email FROM raw_customers)
QUALIFY row_number() OVER (PARTITION BY email ORDER BY customer_id) = 1""")
def dedupe_emails(t: Tables):
    df = clean.lower_case(clean.strip_columns(t.raw_customers.select("customer_id", "email"), "email"), "email")
    return clean.dedupe_by_key(df, ["email"], ["customer_id"])


@query("cln_6_drop_copies", f"SELECT {RAW_ORDER_SQL} FROM orders_d", exact=("price",))
def drop_copies(t: Tables):
    return clean.drop_exact_duplicates(t.raw_orders)


@query("cln_7_state_abbreviations", f"SELECT customer_id, {STATE_SQL} AS state FROM raw_customers")
def states(t: Tables):
    return clean.map_values(t.raw_customers.select("customer_id", "state"), "state", config.STATE_ABBREVIATIONS)


@query("cln_8_fill_channel", """
SELECT customer_id, coalesce(acquisition_channel, 'unknown') AS acquisition_channel FROM raw_customers""")
def fill_channel(t: Tables):
    return clean.fill_constant(t.raw_customers.select("customer_id", "acquisition_channel"),
                               "acquisition_channel", config.UNKNOWN_CHANNEL)


@query("cln_9_parse_dates", f"""
SELECT order_id, product_id, order_date AS raw_date, CAST(CAST({DATE_SQL} AS DATE) AS VARCHAR) AS order_date
FROM raw_orders""")
def dates(t: Tables):
    df = t.raw_orders.select("order_id", "product_id", F.col("order_date").alias("raw_date"), "order_date")
    return clean.parse_dates(df, "order_date")


@query("cln_10_drop_unparsed", f"""
SELECT order_id, product_id, {DAY} FROM orders_p WHERE order_date IS NOT NULL""")
def unparsed(t: Tables):
    df = clean.parse_dates(clean.drop_exact_duplicates(t.raw_orders), "order_date")
    return clean.drop_unparsed_dates(df, "order_date").select("order_id", "product_id", "order_date")


@query("cln_11_mark_guests", """
SELECT order_id, product_id, coalesce(customer_id, -1) AS customer_id,
       coalesce(customer_email, 'guest@unknown.com') AS customer_email FROM raw_orders""")
def guests(t: Tables):
    return clean.mark_guests(t.raw_orders.select("order_id", "product_id", "customer_id", "customer_email"))


@query("cln_12_impute_status", "SELECT order_id, product_id, order_status FROM orders_c")
def status(t: Tables):
    return t.lines.select("order_id", "product_id", "order_status")


@query("cln_13_orphan_keys", """
SELECT 'product' AS kind, product_id AS missing_key, count(*) AS n_lines FROM orders_c
WHERE product_id NOT IN (SELECT product_id FROM products_c) GROUP BY product_id
UNION ALL
SELECT 'customer', customer_id, count(*) FROM orders_c
WHERE customer_id > 0 AND customer_id NOT IN (SELECT customer_id FROM customers_c) GROUP BY customer_id""")
def orphans(t: Tables):
    return clean.referential_report(t.lines, t.products, t.customers)


@query("cln_14_audit_orders", r"""
SELECT count(*) AS rows_total,
       round((count(*) - (SELECT count(*) FROM orders_d)) * 1.0 / count(*), 6) AS duplicate_rate,
       round(avg(CASE WHEN customer_id IS NULL THEN 1.0 ELSE 0 END), 6) AS missing_customer_rate,
       round(avg(CASE WHEN order_status IS NULL THEN 1.0 ELSE 0 END), 6) AS null_status_rate,
       round(avg(CASE WHEN quantity < 0 THEN 1.0 ELSE 0 END), 6) AS negative_quantity_rate,
       round(avg(CASE WHEN regexp_matches(order_date, '^\d{4}-\d{1,2}-\d{1,2}$') THEN 1.0 ELSE 0 END), 6) AS iso_date_rate,
       round(avg(CASE WHEN regexp_matches(order_date, '^\d{1,2}/\d{1,2}/\d{4}$') THEN 1.0 ELSE 0 END), 6) AS us_date_rate,
       round(avg(CASE WHEN regexp_matches(order_date, '^\d{4}-\d{1,2}-\d{1,2}T') THEN 1.0 ELSE 0 END), 6) AS timestamp_date_rate
FROM raw_orders""")
def audit_orders(t: Tables):
    return clean.audit_orders(t.raw_orders)


@query("cln_14_audit_customers", r"""
SELECT count(*) AS rows_total,
       round(avg(CASE WHEN regexp_matches(email, '^\s|\s$') THEN 1.0 ELSE 0 END), 6) AS untrimmed_email_rate,
       round(avg(CASE WHEN email <> lower(email) THEN 1.0 ELSE 0 END), 6) AS upper_email_rate,
       round(avg(CASE WHEN length(state) > 2 THEN 1.0 ELSE 0 END), 6) AS long_state_rate,
       round(avg(CASE WHEN acquisition_channel IS NULL THEN 1.0 ELSE 0 END), 6) AS missing_channel_rate
FROM raw_customers""")
def audit_customers(t: Tables):
    return clean.audit_customers(t.raw_customers)


@query("cln_clean_customers", """
SELECT customer_id, customer_ref, email, city, state, acquisition_channel,
       CAST(CAST(created_at AS DATE) AS VARCHAR) AS created_at, tenure_days FROM customers_c""")
def customers(t: Tables):
    return t.customers


@query("cln_clean_orders", f"SELECT {CLEAN_ORDER_SQL} FROM orders_c", exact=("price",))
def orders(t: Tables):
    return t.lines


# --- features ---------------------------------------------------------------

@query("fea_1_tenure", f"""
SELECT customer_id, {age_sql('CAST(created_at AS TIMESTAMP)')} AS tenure_days FROM raw_customers""")
def tenure(t: Tables):
    df = clean.parse_dates(t.raw_customers.select("customer_id", "created_at"), "created_at")
    return df.select("customer_id", elapsed_days(AS_OF, F.col("created_at")).alias("tenure_days"))


HISTORY_SQL = """customer_id, total_orders, CAST(CAST(first_order_date AS DATE) AS VARCHAR) AS first_order_date,
       CAST(CAST(last_order_date AS DATE) AS VARCHAR) AS last_order_date, round(total_revenue, 4) AS total_revenue"""


@query("fea_2_customer_history", f"SELECT {HISTORY_SQL} FROM history")
def history(t: Tables):
    return features.customer_history(t.lines, AS_OF).drop("is_repeat_customer", "days_since_last_order")


@query("fea_3_repeat_flag", "SELECT customer_id, is_repeat_customer FROM history")
def repeat(t: Tables):
    return features.customer_history(t.lines, AS_OF).select("customer_id", "is_repeat_customer")


@query("fea_4_recency", "SELECT customer_id, days_since_last_order FROM history")
def recency(t: Tables):
    return features.customer_history(t.lines, AS_OF).select("customer_id", "days_since_last_order")


@query("fea_5_customer_features", f"""
SELECT {HISTORY_SQL}, customer_ref, is_repeat_customer, days_since_last_order FROM customers_f""")
def customer_features(t: Tables):
    df = features.add_customer_history(t.customers, features.customer_history(t.lines, AS_OF))
    return df.select("customer_id", "total_orders", "first_order_date", "last_order_date", "total_revenue",
                     "customer_ref", "is_repeat_customer", "days_since_last_order")


@query("fea_6_weekend", "SELECT order_id, product_id, day_of_week, is_weekend FROM orders_f")
def weekend(t: Tables):
    return features.calendar_features(t.lines).select("order_id", "product_id", "day_of_week", "is_weekend")


@query("fea_7_season", "SELECT order_id, product_id, month, season FROM orders_f")
def seasons(t: Tables):
    return features.calendar_features(t.lines).select("order_id", "product_id", "month", "season")


@query("fea_8_order_value", "SELECT order_id, product_id, round(order_value, 6) AS order_value FROM orders_f")
def value(t: Tables):
    return features.order_value(t.lines).select("order_id", "product_id", "order_value")


@query("fea_9_product_sales", """
SELECT product_id, num_orders, units_sold, round(total_revenue, 4) AS total_revenue FROM sales""")
def sales(t: Tables):
    return features.product_sales(features.order_value(t.lines))


PRODUCT_SQL = """product_id, name, category, margin_pct, num_orders, units_sold, round(total_revenue, 4) AS total_revenue"""


@query("fea_10_product_features", f"SELECT {PRODUCT_SQL} FROM products_f")
def product_features(t: Tables):
    df = features.add_product_sales(t.products, features.product_sales(features.order_value(t.lines)))
    return df.select("product_id", "name", "category", "margin_pct", "num_orders", "units_sold", "total_revenue")


@query("fea_11_restock_flag", f"SELECT {PRODUCT_SQL}, needs_restock FROM products_f")
def restock(t: Tables):
    df = features.restock_flag(
        features.add_product_sales(t.products, features.product_sales(features.order_value(t.lines))))
    return df.select("product_id", "name", "category", "margin_pct", "num_orders", "units_sold",
                     "total_revenue", "needs_restock")


# --- summaries --------------------------------------------------------------

@query("sum_1_products", """
SELECT count(*) AS total_products, count(*) FILTER (WHERE stock_level < restock_threshold) AS needing_restock
FROM products_c""")
def sum_products(t: Tables):
    return summaries.product_summary(features.restock_flag(t.products))


@query("sum_2_customers", """
SELECT count(*) AS total_customers, count(*) FILTER (WHERE is_repeat_customer) AS repeat_customers,
       round(avg(total_orders), 6) AS avg_orders FROM customers_f""")
def sum_customers(t: Tables):
    return summaries.customer_summary(
        features.add_customer_history(t.customers, features.customer_history(t.lines, AS_OF)))


@query("sum_3_channels", "SELECT acquisition_channel, count(*) AS n_customers FROM customers_c GROUP BY 1")
def sum_channels(t: Tables):
    return summaries.channel_counts(t.customers)


@query("sum_4_orders", """
SELECT count(*) AS line_items, count(DISTINCT order_id) AS unique_orders,
       CAST(CAST(min(order_date) AS DATE) AS VARCHAR) AS first_date,
       CAST(CAST(max(order_date) AS DATE) AS VARCHAR) AS last_date,
       count(*) FILTER (WHERE customer_id = -1) AS guest_lines,
       count(*) FILTER (WHERE is_subscription) AS subscription_lines,
       count(*) FILTER (WHERE returned) AS returned_lines, count(*) FILTER (WHERE is_weekend) AS weekend_lines
FROM orders_f""")
def sum_orders(t: Tables):
    return summaries.order_summary(features.calendar_features(t.lines))


@query("sum_5_cleaning_report", f"""
SELECT 'orders' AS table_name, 'rows_in' AS figure, count(*) AS n FROM raw_orders
UNION ALL SELECT 'orders', 'duplicates_removed', (SELECT count(*) FROM raw_orders) - count(*) FROM orders_d
UNION ALL SELECT 'orders', 'unparsed_dates_removed', count(*) FROM orders_p WHERE order_date IS NULL
UNION ALL SELECT 'orders', 'rows_out', count(*) FROM orders_c
UNION ALL SELECT 'orders', 'guests_marked', count(*) FROM orders_p WHERE order_date IS NOT NULL AND customer_id IS NULL
UNION ALL SELECT 'orders', 'statuses_imputed', count(*) FROM orders_p
          WHERE order_status IS NULL AND {age_sql('order_date')} > 0
UNION ALL SELECT 'customers', 'rows_in', count(*) FROM raw_customers
UNION ALL SELECT 'customers', 'duplicates_removed', (SELECT count(*) FROM raw_customers) - count(*) FROM customers_c
UNION ALL SELECT 'customers', 'rows_out', count(*) FROM customers_c
UNION ALL SELECT 'products', 'rows_in', count(*) FROM raw_products
UNION ALL SELECT 'products', 'rows_out', count(*) FROM raw_products""")
def report(t: Tables):
    root = scratch_path(t.spark, "cleaned")

    def save(products, customers, lines):
        for name, df in (("products", products), ("customers", customers), ("orders", lines)):
            tables.replace_table(df, f"{root}/{name}")

    return clean.cleaning_report(t.raw_orders, t.raw_customers, t.raw_products, AS_OF, save)
