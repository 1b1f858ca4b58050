"""Queries for the operational table questions."""

from __future__ import annotations

from opsmill.operators import lookups
from opsmill.plans.etl_queries import AT, age_sql, business_hours_sql
from opsmill.plans.fixtures import AS_OF
from opsmill.plans.registry import Tables, query, step

step("rates", """
SELECT product_id, count(DISTINCT order_id) AS total_orders,
       count(DISTINCT CASE WHEN returned THEN order_id END) AS returned_orders,
       count(DISTINCT CASE WHEN returned THEN order_id END) * 1.0 / count(DISTINCT order_id) AS return_rate
FROM orders_c GROUP BY product_id""")
step("velocity", f"""
SELECT product_id, name, stock_level, restock_threshold, coalesce(u, 0) AS recent_units,
       coalesce(u, 0) * 7.0 / 30 AS weekly_units,
       stock_level / nullif(coalesce(u, 0) * 7.0 / 30, 0) AS weeks_to_stockout
FROM products_c LEFT JOIN (
  SELECT product_id, CAST(sum(quantity) AS BIGINT) AS u FROM orders_c
  WHERE quantity > 0 AND {age_sql('order_date')} BETWEEN 0 AND 29 GROUP BY product_id) USING (product_id)""")


@query("qry_1_stock_position", """
SELECT product_id, name, stock_level, restock_threshold, stock_level - restock_threshold AS above_threshold,
       stock_level < restock_threshold AS needs_restock FROM products_c""")
def stock(t: Tables):
    return lookups.stock_position(t.products)


@query("qry_2_customer_orders", """
SELECT customer_id, count(DISTINCT order_id) AS total_orders, count(DISTINCT order_id) >= 5 AS is_vip
FROM orders_c WHERE customer_id > 0 GROUP BY customer_id""")
def customer_orders(t: Tables):
    return lookups.customer_orders(t.lines)


@query("qry_3_restock_queue", """
SELECT product_id, name, stock_level, restock_threshold FROM products_c WHERE stock_level < restock_threshold""")
def queue(t: Tables):
    return lookups.restock_queue(t.products)


@query("qry_4_order_status", """
SELECT order_id, max(order_status) AS order_status, bool_or(returned) AS returned,
       CAST(CAST(max(order_date) AS DATE) AS VARCHAR) AS order_date, count(*) AS n_lines
FROM orders_c GROUP BY order_id""")
def order_status(t: Tables):
    return lookups.order_status(t.lines)


@query("qry_5_return_rates", """
SELECT product_id, total_orders, returned_orders, round(return_rate, 6) AS return_rate,
       return_rate > 0.1 AS above_baseline FROM rates""")
def return_rates(t: Tables):
    return lookups.return_rates(t.lines)


@query("qry_6_channel_customers", """
SELECT acquisition_channel, count(*) AS n_customers FROM customers_c GROUP BY acquisition_channel""")
def channels(t: Tables):
    return lookups.channel_customers(t.customers)


@query("qry_7_last_order", f"""
WITH last AS (
  SELECT customer_id, order_id, max(order_date) AS order_date FROM orders_c WHERE customer_id > 0
  GROUP BY customer_id, order_id
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY max(order_date) DESC, order_id DESC) = 1)
SELECT customer_ref, l.order_id, CAST(CAST(l.order_date AS DATE) AS VARCHAR) AS order_date, o.product_id, p.name,
       CAST(sum(o.quantity) AS BIGINT) AS units
FROM last l JOIN orders_c o ON o.customer_id = l.customer_id AND o.order_id = l.order_id
JOIN customers_c c ON c.customer_id = l.customer_id JOIN products_c p ON p.product_id = o.product_id
GROUP BY ALL""")
def last_order(t: Tables):
    return lookups.last_order_contents(t.lines, t.customers, t.products)


@query("qry_8_recent_subscriptions", f"""
SELECT count(DISTINCT order_id) AS all_orders,
       count(DISTINCT CASE WHEN is_subscription THEN order_id END) AS subscription_orders,
       round(count(DISTINCT CASE WHEN is_subscription THEN order_id END) * 1.0 / nullif(count(DISTINCT order_id), 0), 6)
         AS subscription_share
FROM orders_c WHERE {age_sql('order_date')} BETWEEN 0 AND 29""")
def subscriptions(t: Tables):
    return lookups.recent_subscriptions(t.lines, AS_OF)


@query("qry_9_never_returned", """
SELECT customer_id, customer_ref FROM customers_c
WHERE customer_id IN (SELECT customer_id FROM orders_c)
  AND customer_id NOT IN (SELECT customer_id FROM orders_c WHERE returned)""")
def never_returned(t: Tables):
    return lookups.never_returned(t.lines, t.customers)


@query("qry_10_value_by_tier", """
WITH o AS (SELECT customer_id, order_id, sum(order_value) AS v FROM orders_f WHERE customer_id > 0 GROUP BY 1, 2),
     c AS (SELECT customer_id, count(*) >= 5 AS vip FROM o GROUP BY 1),
     a AS (SELECT avg(v) FILTER (WHERE vip) AS x, avg(v) FILTER (WHERE NOT vip) AS y FROM o JOIN c USING (customer_id))
SELECT round(x, 6) AS vip_avg_order_value, round(y, 6) AS non_vip_avg_order_value,
       round((x / y - 1) * 100, 6) AS lift_pct FROM a""")
def tiers(t: Tables):
    return lookups.order_value_by_tier(t.lines)


@query("qry_11_sales_velocity", """
SELECT product_id, name, stock_level, restock_threshold, recent_units, round(weekly_units, 6) AS weekly_units,
       round(weeks_to_stockout, 6) AS weeks_to_stockout,
       CASE WHEN stock_level < restock_threshold AND weeks_to_stockout < 4 THEN 'high'
            WHEN stock_level < restock_threshold THEN 'medium'
            WHEN weeks_to_stockout < 4 THEN 'watch' ELSE 'none' END AS priority
FROM velocity""")
def velocity(t: Tables):
    return lookups.sales_velocity(t.products, t.lines, AS_OF)


@query("qry_12_restock_plan", """
WITH p AS (
  SELECT v.product_id, name, stock_level, restock_threshold, coalesce(return_rate, 0) AS return_rate,
         weekly_units * (1 - coalesce(return_rate, 0)) AS net FROM velocity v LEFT JOIN rates USING (product_id))
SELECT product_id, name, stock_level, round(return_rate, 6) AS return_rate, round(net, 6) AS net_weekly_units,
       round(stock_level / nullif(net, 0), 6) AS net_weeks_to_stockout,
       round(greatest(restock_threshold + 8 * net - stock_level, 0), 6) AS restock_units
FROM p""")
def plan(t: Tables):
    return lookups.restock_plan(t.products, t.lines, AS_OF)


@query("qry_13_late_processing", f"""
SELECT order_id, customer_ref, city, state, CAST(CAST(d AS DATE) AS VARCHAR) AS order_date,
       {business_hours_sql(AT, 'd')} AS hours_open
FROM (SELECT order_id, customer_id, max(order_date) AS d FROM orders_c
      WHERE order_status IN ('pending', 'processing') GROUP BY 1, 2) o
LEFT JOIN customers_c USING (customer_id)
WHERE {business_hours_sql(AT, 'd')} > 24""")
def late(t: Tables):
    return lookups.late_processing(t.lines, t.customers, AS_OF)
