"""Queries for the return, damage and shipping rules and the catalogue."""

from __future__ import annotations

from pyspark.sql import functions as F

from opsmill.operators import damage, lookups, products, returns, shipping
from opsmill.plans.etl_queries import business_hours_sql
from opsmill.plans.fixtures import AS_OF
from opsmill.plans.registry import Tables, query, step

DAY = "DATE '2001-08-02'"


def holiday_sql(day: str, last: int) -> str:
    return f"(month({day}) * 100 + day({day}) >= 1115 OR month({day}) * 100 + day({day}) <= {last})"


def flags_sql(*named: tuple[str, str]) -> str:
    return "concat_ws(',', " + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for c, n in named) + ")"


step("request_vip", """
SELECT r.customer_id, r.requested_on, count(s.order_id) >= 5 AS is_vip
FROM (SELECT DISTINCT customer_id, requested_on FROM return_requests) r
LEFT JOIN shipments s ON s.customer_id = r.customer_id AND s.ordered_at <= r.requested_on
                     AND s.ordered_at >= CAST(r.requested_on - INTERVAL 12 MONTH AS DATE)
GROUP BY 1, 2""")
step("windowed", f"""
SELECT *, CASE WHEN window_rule = 'standard' THEN 30 ELSE 45 END - days_used AS days_left,
       CASE WHEN window_rule = 'standard' THEN 30 ELSE 45 END - days_used >= 0 AS eligible
FROM (SELECT r.*, is_vip, r.requested_on - r.delivered_on AS days_used,
             CASE WHEN {holiday_sql('ordered_at', 115)} THEN 'holiday' WHEN is_vip THEN 'vip' ELSE 'standard' END AS window_rule
      FROM return_requests r JOIN request_vip v ON r.customer_id = v.customer_id AND r.requested_on = v.requested_on)""")
step("graded", """
SELECT *, order_damaged_items > 1 AS multiple, CASE WHEN order_damaged_items > 1 THEN 'C' ELSE grade END AS final_grade
FROM (SELECT *, sum(damaged_items) OVER (PARTITION BY order_id) AS order_damaged_items FROM damage_claims)""")
step("vips", """
SELECT customer_id, count(DISTINCT order_id) >= 5 AS is_vip FROM orders_c WHERE customer_id > 0 GROUP BY customer_id""")
step("rates_card", """
SELECT * FROM (VALUES
 ('US','standard',5.95,50,5,7),('US','expedited',12.95,NULL,2,3),('US','express',24.95,NULL,1,2),
 ('APO','standard',5.95,50,10,20),('APO','expedited',12.95,NULL,10,20),('APO','express',24.95,NULL,10,20),
 ('CA','standard',15.95,100,7,10),('CA','expedited',15.95,100,7,10),('CA','express',15.95,100,7,10),
 ('UK_EU','standard',24.95,100,10,15),('UK_EU','expedited',24.95,100,10,15),('UK_EU','express',24.95,100,10,15),
 ('AU','standard',29.95,100,12,18),('AU','expedited',29.95,100,12,18),('AU','express',29.95,100,12,18)
) AS r(zone, method, rate, free_from, min_days, max_days)""")
step("lost", f"""
SELECT order_id, carrier, zone, {DAY} - expected_on AS days_overdue FROM shipments
WHERE delivered_on IS NULL AND {DAY} - expected_on > CASE WHEN zone IN ('US', 'APO') THEN 10 ELSE 25 END""")


def vip_windows(t: Tables):
    return returns.return_window(returns.with_vip(t.return_requests, t.shipments, "requested_on"))


# --- returns ----------------------------------------------------------------

@query("pol_1_customer_tiers", f"""
SELECT customer_id, count(*) AS total_orders, n AS orders_12m,
       CASE WHEN n >= 5 THEN 'VIP' WHEN count(*) = 1 THEN 'NEW' ELSE 'STANDARD' END AS tier
FROM (SELECT *, count(CASE WHEN ordered_at >= CAST({DAY} - INTERVAL 12 MONTH AS DATE) THEN 1 END)
                OVER (PARTITION BY customer_id) AS n FROM shipments WHERE ordered_at <= {DAY})
GROUP BY customer_id, n""")
def tiers(t: Tables):
    return returns.customer_tiers(t.shipments, AS_OF)


@query("pol_1_running_tiers", """
SELECT DISTINCT customer_id, CAST(ordered_at AS VARCHAR) AS day, n AS orders_12m, n >= 5 AS is_vip
FROM (SELECT customer_id, ordered_at, count(*) OVER (PARTITION BY customer_id ORDER BY ordered_at
             RANGE BETWEEN INTERVAL 12 MONTH PRECEDING AND CURRENT ROW) AS n FROM shipments)""")
def running(t: Tables):
    return returns.running_tiers(t.shipments)


@query("pol_2_high_return_customers", """
SELECT customer_id, o AS total_orders, r AS returned_orders, round(r * 1.0 / o, 6) AS return_rate, r * 1.0 / o > 0.3 AS review
FROM (SELECT customer_id, count(DISTINCT order_id) AS o, count(DISTINCT CASE WHEN returned THEN order_id END) AS r
      FROM orders_c WHERE customer_id > 0 GROUP BY customer_id)""")
def high_return(t: Tables):
    return returns.high_return_customers(t.lines)


@query("pol_3_return_window", """
SELECT order_id, line_no, product_id, is_vip, window_rule, days_used, days_left, eligible FROM windowed""")
def window(t: Tables):
    return vip_windows(t).select("order_id", "line_no", "product_id", "is_vip", "window_rule", "days_used",
                                 "days_left", "eligible")


FORM_SQL = """CASE item_condition WHEN 'adverse_reaction' THEN 'full_refund_expedited'
  WHEN 'damaged' THEN 'refund_or_replacement_plus_10pct' WHEN 'unopened' THEN 'full_refund'
  ELSE CASE WHEN is_vip THEN 'full_refund_manager_discretion' ELSE 'store_credit' END END"""
TIER_SQL = "CASE WHEN amount < 50 THEN 'auto' WHEN amount <= 200 THEN 'manager' ELSE 'director' END"


@query("pol_4_refund_form", f"SELECT order_id, line_no, product_id, {FORM_SQL} AS refund_form FROM windowed")
def form(t: Tables):
    df = returns.with_vip(t.return_requests, t.shipments, "requested_on")
    return df.select("order_id", "line_no", "product_id",
                     returns.refund_form(F.col("item_condition"), F.col("is_vip")).alias("refund_form"))


@query("pol_5_approval_tier", f"""
SELECT order_id, line_no, product_id, {TIER_SQL} AS approval,
       CASE WHEN amount < 50 THEN NULL WHEN amount <= 200 THEN 4 ELSE 24 END AS response_hours FROM return_requests""")
def approval(t: Tables):
    return t.return_requests.select("order_id", "line_no", "product_id",
                                    returns.approval_tier(F.col("amount")).alias("approval"),
                                    returns.response_hours(F.col("amount")).alias("response_hours"))


@query("pol_6_return_abuse", f"""
WITH c AS (SELECT customer_id, max(n) AS max_returns_6m FROM (
       SELECT customer_id, count(*) OVER (PARTITION BY customer_id ORDER BY requested_on
              RANGE BETWEEN INTERVAL 6 MONTH PRECEDING AND CURRENT ROW) AS n FROM return_requests) GROUP BY 1),
     p AS (SELECT customer_id, count(*) FILTER (WHERE n > 1) AS repeated_products FROM (
       SELECT customer_id, product_id, count(*) AS n FROM return_requests GROUP BY 1, 2) GROUP BY 1)
SELECT customer_id, max_returns_6m, repeated_products,
       {flags_sql(('max_returns_6m > 3', 'many_returns'), ('repeated_products > 0', 'repeated_product'))} AS red_flags
FROM c JOIN p USING (customer_id)""")
def abuse(t: Tables):
    return returns.return_abuse(t.return_requests)


step("unit_events", """
WITH own AS (SELECT customer_id, product_id, ordered_at AS day, order_id, sum(units) AS units FROM purchases GROUP BY ALL),
 buy AS (SELECT customer_id, product_id, day, 0 AS kind, order_id, NULL::BIGINT AS set_id, NULL::BIGINT AS line_no, units FROM own
         UNION ALL SELECT customer_id, c.product_id, day, 1, order_id, c.set_id, NULL, units FROM own o JOIN set_components c ON c.set_id = o.product_id),
 e AS (SELECT * FROM buy UNION ALL SELECT customer_id, product_id, requested_on, 2, order_id, NULL, line_no, units FROM returned_units),
 r AS (SELECT *, coalesce(sum(units) FILTER (kind < 2) OVER w, 0) AS had, coalesce(sum(units) FILTER (kind = 2) OVER w, 0) AS asked FROM e
       WINDOW w AS (PARTITION BY customer_id, product_id ORDER BY day, kind, order_id, set_id NULLS FIRST, line_no ROWS UNBOUNDED PRECEDING)),
 u AS (SELECT *, CASE WHEN kind = 2 THEN asked + least(0, min(had - asked) FILTER (kind = 2) OVER w) END AS used FROM r
       WINDOW w AS (PARTITION BY customer_id, product_id ORDER BY day, kind, order_id, set_id NULLS FIRST, line_no ROWS UNBOUNDED PRECEDING))
SELECT *, CASE WHEN kind = 2 THEN coalesce(max(used) OVER (PARTITION BY customer_id, product_id ORDER BY day, kind, order_id, set_id NULLS FIRST, line_no
                                                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) ELSE had - units END AS first,
       CASE WHEN kind = 2 THEN used ELSE had END AS past FROM u""")
step("unit_sources", """
SELECT b.customer_id, b.product_id, b.order_id, b.line_no, s.order_id AS source_order, s.set_id AS source_set,
       CAST(sum(least(b.past, s.past) - greatest(b.first, s.first)) AS BIGINT) AS units
FROM unit_events b JOIN unit_events s ON b.customer_id = s.customer_id AND b.product_id = s.product_id AND b.first < s.past AND s.first < b.past
WHERE b.kind = 2 AND s.kind < 2 GROUP BY ALL
UNION ALL SELECT customer_id, product_id, order_id, line_no, NULL, NULL, CAST(units - (past - first) AS BIGINT) FROM unit_events
WHERE kind = 2 AND past - first < units""")


@query("pol_7_return_sources", "SELECT * FROM unit_sources")
def return_sources(t: Tables):
    return returns.allocate_returns(t.returned_units, t.purchases, t.set_components)


@query("pol_7_bundle_returns", """
WITH g AS (SELECT customer_id, source_order AS order_id, source_set AS set_id, product_id, sum(units) AS units
           FROM unit_sources WHERE source_set IS NOT NULL GROUP BY ALL),
 n AS (SELECT set_id, count(*) AS n_components FROM set_components GROUP BY 1),
 f AS (SELECT g.customer_id, g.order_id, g.set_id, n_components, count(*) AS n_returned, CASE WHEN count(*) = n_components THEN min(units) ELSE 0 END AS full_sets
       FROM g JOIN n USING (set_id) GROUP BY g.customer_id, g.order_id, g.set_id, n_components),
 b AS (SELECT customer_id, order_id, product_id AS set_id, sum(units) AS sets_bought FROM purchases GROUP BY ALL)
SELECT f.customer_id, f.order_id, f.set_id, CAST(any_value(sets_bought) AS BIGINT) AS sets_bought, n_components, n_returned, CAST(full_sets AS BIGINT) AS full_sets,
       CAST(sum(g.units) AS BIGINT) AS returned_units, CAST(coalesce(sum(g.units - full_sets) FILTER (sold_separately), 0) AS BIGINT) AS single_units,
       CAST(coalesce(sum(g.units - full_sets) FILTER (NOT sold_separately), 0) AS BIGINT) AS refused_units,
       round(full_sets * any_value(s.price) + coalesce(sum((g.units - full_sets) * p.price) FILTER (sold_separately), 0), 6) AS refund_value
FROM f JOIN g USING (customer_id, order_id, set_id) JOIN b USING (customer_id, order_id, set_id)
JOIN set_components c ON c.set_id = f.set_id AND c.product_id = g.product_id
JOIN raw_products p ON p.product_id = g.product_id JOIN raw_products s ON s.product_id = f.set_id
GROUP BY f.customer_id, f.order_id, f.set_id, n_components, n_returned, full_sets""")
def bundles(t: Tables):
    return returns.bundle_returns(t.returned_units, t.purchases, t.set_components, t.raw_products)


@query("pol_8_discontinued", """
SELECT order_id, line_no, product_id, round(amount, 6) AS amount,
       CASE WHEN p.pid IS NULL THEN 'check_product' WHEN discontinued THEN 'refund_only' ELSE 'refund_or_replacement' END AS resolution,
       round(CASE WHEN discontinued THEN amount * 0.2 ELSE 0 END, 6) AS keep_credit, p.pid IS NULL AS unknown_product
FROM return_requests r LEFT JOIN (SELECT product_id AS pid, discontinued FROM raw_products) p ON p.pid = r.product_id""")
def discontinued(t: Tables):
    return returns.discontinued_resolution(t.return_requests, t.raw_products)


@query("pol_9_disposition", """
SELECT CASE item_condition WHEN 'unopened' THEN 'restock' WHEN 'damaged' THEN 'carrier_flag' ELSE 'write_off' END AS disposition,
       count(*) AS n_items, round(sum(amount), 6) AS total_amount FROM return_requests GROUP BY 1""")
def disposition(t: Tables):
    return returns.inventory_disposition(t.return_requests)


@query("pol_10_return_cost", """
SELECT order_id, line_no, product_id, round(amount * 0.15, 6) AS return_cost, coalesce(margin_pct > 50, false) AS prefer_replacement,
       p.pid IS NULL AS unknown_product
FROM return_requests r LEFT JOIN (SELECT product_id AS pid, margin_pct FROM products_c) p ON p.pid = r.product_id""")
def cost(t: Tables):
    return returns.return_costs(t.return_requests, t.products)


@query("pol_11_monthly_return_rate", """
SELECT CAST(month AS VARCHAR) AS month, product_id, orders, returned_orders, round(returned_orders * 1.0 / orders, 6) AS return_rate,
       returned_orders * 1.0 / orders >= 0.08 AS over_target
FROM (SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, product_id, count(DISTINCT order_id) AS orders,
             count(DISTINCT CASE WHEN returned THEN order_id END) AS returned_orders FROM orders_c GROUP BY 1, 2)""")
def monthly(t: Tables):
    return returns.monthly_return_rates(t.lines)


# --- damage -----------------------------------------------------------------

@query("pol_12_claim_red_flags", f"""
SELECT claim_id, claims_6m, {flags_sql(('claims_6m > 2', 'many_claims'), ('order_value > 100', 'high_value'),
                                       ('claimed_on - delivered_on > 7', 'late_claim'))} AS red_flags,
       claims_6m > 2 OR order_value > 100 OR claimed_on - delivered_on > 7 AS escalate
FROM (SELECT *, count(*) OVER (PARTITION BY customer_id ORDER BY claimed_on
             RANGE BETWEEN INTERVAL 6 MONTH PRECEDING AND CURRENT ROW) AS claims_6m FROM damage_claims)""")
def red_flags(t: Tables):
    return damage.red_flags(t.damage_claims).select("claim_id", "claims_6m", "red_flags", "escalate")


@query("pol_13_photo_requirement", """
SELECT claim_id, prior_claims, CASE WHEN order_value > 100 THEN 'mandatory'
       WHEN n >= 5 AND prior_claims = 0 THEN 'waived' ELSE 'required' END AS photos
FROM (SELECT *, rank() OVER (PARTITION BY customer_id ORDER BY claimed_on) - 1 AS prior_claims FROM damage_claims)
JOIN (SELECT c.claim_id, count(DISTINCT s.order_id) AS n FROM damage_claims c LEFT JOIN shipments s
      ON s.customer_id = c.customer_id AND s.ordered_at <= c.claimed_on GROUP BY 1) USING (claim_id)""")
def photos(t: Tables):
    return damage.photo_requirement(t.damage_claims, t.shipments).select("claim_id", "prior_claims", "photos")


@query("pol_14_final_grade", "SELECT claim_id, grade, multiple, final_grade FROM graded")
def grade(t: Tables):
    return damage.final_grade(t.damage_claims).select("claim_id", "grade", "multiple", "final_grade")


@query("pol_15_availability", """
SELECT order_id, line_no, product_id, stock, CASE WHEN p.pid IS NULL THEN 'check_product' WHEN discontinued THEN 'refund_only_plus_credit'
       WHEN stock > 10 THEN 'replacement_or_refund' WHEN stock >= 1 THEN 'replacement_or_refund_restock'
       ELSE 'refund_or_wait' END AS offer, p.pid IS NULL AS unknown_product
FROM return_requests r LEFT JOIN (SELECT product_id AS pid, stock, discontinued FROM product_stock) p ON p.pid = r.product_id WHERE item_condition = 'damaged'""")
def available(t: Tables):
    return damage.replacement_availability(t.return_requests, t.product_stock)


@query("pol_16_compensation", """
SELECT *, CASE WHEN discount_pct >= 15 THEN 'manager' ELSE 'auto' END AS approval FROM (
SELECT claim_id, final_grade,
       greatest(CASE WHEN multiple THEN 20 WHEN final_grade = 'C' THEN 15 WHEN final_grade = 'B' THEN 10 ELSE 0 END,
                CASE WHEN order_value > 100 THEN 15 ELSE 0 END) AS discount_pct,
       CASE WHEN final_grade = 'A' THEN 10.0::DOUBLE ELSE 0.0::DOUBLE END AS store_credit, order_value > 200 AS notify_manager FROM graded)""")
def compensation(t: Tables):
    df = damage.compensation(damage.final_grade(t.damage_claims))
    return df.select("claim_id", "final_grade", "discount_pct", "store_credit", "approval", "notify_manager")


@query("pol_17_carrier_filing", """
SELECT carrier, count(*) AS claims, count(*) FILTER (WHERE f) AS filed, round(coalesce(sum(order_value) FILTER (WHERE f), 0), 6) AS recoverable
FROM (SELECT *, order_value > 50 AND final_grade IN ('B', 'C') AND has_photos AS f FROM graded) GROUP BY carrier""")
def filing(t: Tables):
    return damage.carrier_filings(damage.final_grade(t.damage_claims))


@query("pol_18_carrier_monitor", f"""
SELECT CAST(month AS VARCHAR) AS month, carrier, damages, month_damages, shipments, round(damages * 1.0 / shipments, 6) AS damage_rate,
       {flags_sql(('damages >= 3', 'three_same_carrier'), ('month_damages >= 5', 'five_any_carrier'),
                  ('damages * 1.0 / shipments > 0.01', 'rate_over_1pct'))} AS triggers
FROM (SELECT *, CAST(sum(damages) OVER (PARTITION BY month) AS BIGINT) AS month_damages FROM (
      SELECT CAST(date_trunc('month', claimed_on) AS DATE) AS month, carrier, count(*) AS damages FROM damage_claims GROUP BY 1, 2))
LEFT JOIN (SELECT CAST(date_trunc('month', shipped_on) AS DATE) AS month, carrier, count(*) AS shipments FROM shipments GROUP BY 1, 2)
  USING (month, carrier)""")
def monitor(t: Tables):
    return damage.carrier_monitor(t.damage_claims, t.shipments)


@query("pol_19_damage_cost", """
WITH r AS (
  SELECT CAST(date_trunc('month', claimed_on) AS DATE) AS month, carrier, 1 AS claims, order_value AS cost,
         CASE WHEN carrier_paid THEN order_value ELSE 0 END AS recovered, 0 AS shipments FROM damage_claims
  UNION ALL SELECT CAST(date_trunc('month', shipped_on) AS DATE), carrier, 0, 0, 0, 1 FROM shipments),
 a AS (SELECT month, carrier, CAST(sum(claims) AS BIGINT) AS claims, sum(cost) AS cost, sum(recovered) AS recovered,
              CAST(sum(shipments) AS BIGINT) AS shipments FROM r GROUP BY ROLLUP (month, carrier))
SELECT CAST(month AS VARCHAR) AS month, carrier, claims, round(cost, 6) AS cost, round(recovered, 6) AS recovered, shipments,
       round(recovered / nullif(cost, 0), 6) AS recovery_rate, round(cost / nullif(claims, 0), 6) AS mean_cost,
       round(claims * 1.0 / nullif(shipments, 0), 6) AS damage_rate, recovered / nullif(cost, 0) > 0.6 AS recovery_ok,
       claims * 1.0 / nullif(shipments, 0) < 0.005 AS damage_ok FROM a""")
def damage_cost(t: Tables):
    return damage.damage_cost_report(t.damage_claims, t.shipments)


@query("pol_20_contents_check", """
SELECT order_id, product_id, 'wrong_item' AS issue, 15 AS discount_pct
FROM (SELECT * FROM received_items EXCEPT SELECT * FROM ordered_items)
UNION ALL SELECT order_id, product_id, 'missing_item', 10
FROM (SELECT * FROM ordered_items EXCEPT SELECT * FROM received_items)""")
def contents(t: Tables):
    return damage.contents_check(t.ordered_items, t.received_items)


@query("pol_21_photo_follow_up", """
SELECT claim_id, hours_since_request, CASE WHEN hours_since_request > 72 THEN 'close'
       WHEN hours_since_request > 48 THEN 'remind' ELSE 'wait' END AS action
FROM damage_claims WHERE NOT has_photos""")
def follow_up(t: Tables):
    return damage.photo_follow_up(t.damage_claims)


# --- shipping ---------------------------------------------------------------

@query("pol_22_shipping_quote", """
SELECT order_id, zone, method, CASE WHEN order_value >= free_from THEN 0 ELSE rate END::DOUBLE AS charge, rate IS NULL AS unknown_rate
FROM shipments LEFT JOIN rates_card USING (zone, method)""")
def quotes(t: Tables):
    return shipping.quote(t.shipments).select("order_id", "zone", "method", "charge", "unknown_rate")


@query("pol_23_shipping_holds", f"""
SELECT order_id, {flags_sql(("method = 'express' AND po_box", 'express_to_po_box'),
                            ("method = 'express' AND zone = 'APO'", 'express_to_military'),
                            ('missing_unit', 'missing_unit'))} AS hold_reasons,
       (method = 'express' AND (po_box OR zone = 'APO')) OR missing_unit AS hold FROM shipments""")
def holds(t: Tables):
    return shipping.holds(t.shipments).select("order_id", "hold_reasons", "hold")


@query("pol_24_promised_range", """
WITH cal AS (
  SELECT d, isodow(d) <= 5 AS open, sum(CASE WHEN isodow(d) <= 5 THEN 1 ELSE 0 END) OVER (ORDER BY d) AS k
  FROM (SELECT CAST(g AS DATE) AS d FROM (SELECT unnest(generate_series(DATE '1994-12-01', DATE '2002-12-31', INTERVAL 1 DAY)) AS g)))
SELECT order_id, CAST(a.d AS VARCHAR) AS promised_from, CAST(b.d AS VARCHAR) AS promised_to, rate IS NULL AS unknown_rate
FROM shipments LEFT JOIN rates_card USING (zone, method) JOIN cal c ON c.d = ordered_at
LEFT JOIN cal a ON a.open AND a.k = c.k + min_days LEFT JOIN cal b ON b.open AND b.k = c.k + max_days""")
def promised(t: Tables):
    return shipping.promised_range(t.shipments).select("order_id", "promised_from", "promised_to", "unknown_rate")


@query("pol_25_lost_packages", "SELECT * FROM lost")
def lost(t: Tables):
    return shipping.lost_packages(t.shipments, AS_OF)


@query("pol_26_delay_credit", f"""
SELECT order_id, zone, n AS days_late, CASE WHEN dom AND n > 20 THEN 20 WHEN dom AND n > 15 THEN 10 ELSE 0 END::DOUBLE AS credit,
       dom AND n > 20 AS consider_reship, n > CASE WHEN dom THEN 10 ELSE 7 END AS contact_carrier
FROM (SELECT *, zone IN ('US', 'APO') AS dom, coalesce(delivered_on, {DAY})
      - CASE WHEN zone IN ('US', 'APO') THEN ordered_at ELSE expected_on END AS n FROM shipments)""")
def delays(t: Tables):
    return shipping.delay_credits(t.shipments, AS_OF)


@query("pol_27_carrier_scorecard", """
WITH m AS (
  SELECT CAST(date_trunc('month', shipped_on) AS DATE) AS month, s.carrier, count(*) AS shipments, count(delivered_on) AS delivered,
         avg(delivered_on - shipped_on) AS avg_days, avg(expected_on - shipped_on) AS avg_promised_days, count(l.order_id) AS lost
  FROM shipments s LEFT JOIN lost l ON l.order_id = s.order_id GROUP BY 1, 2),
 d AS (SELECT CAST(date_trunc('month', claimed_on) AS DATE) AS month, carrier, count(*) AS damages FROM damage_claims GROUP BY 1, 2),
 j AS (SELECT month, carrier, coalesce(shipments, 0) AS shipments, coalesce(delivered, 0) AS delivered, avg_days, avg_promised_days,
              coalesce(lost, 0) AS lost, coalesce(damages, 0) AS damages FROM m FULL JOIN d USING (month, carrier)),
 r AS (SELECT *, delivered * 1.0 / nullif(shipments, 0) AS success_rate, damages * 1.0 / nullif(shipments, 0) AS damage_rate,
              lost * 1.0 / nullif(shipments, 0) AS loss_rate FROM j),
 f AS (SELECT *, coalesce(success_rate <= 0.98, false) OR coalesce(damage_rate >= 0.005, false) OR coalesce(loss_rate >= 0.002, false)
              OR coalesce(avg_days > avg_promised_days, false) AS failing,
              (year(month) * 12 + month(month)) AS mi FROM r),
 g AS (SELECT *, mi - row_number() OVER (PARTITION BY carrier, failing ORDER BY mi) AS grp FROM f),
 h AS (SELECT *, CASE WHEN failing THEN row_number() OVER (PARTITION BY carrier, failing, grp ORDER BY mi) ELSE 0 END AS failing_months FROM g)
SELECT CAST(month AS VARCHAR) AS month, carrier, shipments, delivered, round(avg_days, 6) AS avg_days,
       round(avg_promised_days, 6) AS avg_promised_days, lost, damages, round(success_rate, 6) AS success_rate,
       round(damage_rate, 6) AS damage_rate, round(loss_rate, 6) AS loss_rate, failing, failing_months,
       failing_months >= 2 OR damages > 3 AS switch_carrier FROM h""")
def scorecard(t: Tables):
    return shipping.carrier_scorecard(t.shipments, t.damage_claims, AS_OF)


@query("pol_28_shipping_margin", """
SELECT method, count(*) AS n_orders, round(sum(c), 6) AS charged, round(sum(k), 6) AS cost, round(sum(c - k), 6) AS margin
FROM (SELECT method, CASE WHEN order_value >= free_from THEN 0 ELSE rate END::DOUBLE AS c,
             CASE method WHEN 'standard' THEN 3.5 WHEN 'expedited' THEN 8.5 ELSE 18 END::DOUBLE AS k
      FROM shipments LEFT JOIN rates_card USING (zone, method) WHERE zone IN ('US', 'APO')) GROUP BY method""")
def shipping_margin(t: Tables):
    return shipping.shipping_margin(t.shipments)


@query("pol_29_stock_check", """
WITH o AS (SELECT order_id, customer_id, min(stock) AS min_stock, max(CASE WHEN stock > 0 THEN price END) AS a,
                  max(CASE WHEN stock <= 0 THEN price END) AS b, bool_or(stock IS NULL) AS unknown
           FROM orders_c LEFT JOIN product_stock USING (product_id) GROUP BY 1, 2),
 x AS (SELECT order_id, min_stock, CASE WHEN unknown THEN 'check_product' WHEN min_stock >= 10 THEN 'ship' WHEN min_stock > 0 THEN 'qa_hold'
              WHEN coalesce(is_vip, false) AND a > b THEN 'partial_shipment' ELSE 'wait_substitute_or_refund' END AS action
       FROM o LEFT JOIN vips USING (customer_id))
SELECT *, action = 'partial_shipment' AS manager_approval FROM x""")
def stock_check(t: Tables):
    return shipping.stock_check(t.lines, t.product_stock, lookups.customer_orders(t.lines))


@query("pol_30_processing_sla", f"""
WITH d AS (SELECT ordered_at, count(*) AS n FROM shipments GROUP BY 1),
 x AS (SELECT s.order_id, {business_hours_sql('shipped_on', 's.ordered_at')} AS hours, CASE WHEN {holiday_sql('s.ordered_at', 105)} THEN 72
         WHEN n > 1.5 * (SELECT avg(n) FROM d) THEN 48 ELSE 24 END AS allowed_hours FROM shipments s JOIN d ON d.ordered_at = s.ordered_at)
SELECT *, hours > allowed_hours AS breach FROM x""")
def sla(t: Tables):
    return shipping.processing_sla(t.shipments).select("order_id", "hours", "allowed_hours", "breach")


@query("pol_31_free_upgrade", f"""
SELECT order_id, reason, reason IS NOT NULL AS free_upgrade FROM (
SELECT s.order_id, CASE WHEN address_error THEN NULL WHEN our_error THEN 'our_error'
       WHEN coalesce(is_vip, false) AND complaint THEN 'vip_complaint' WHEN s.order_value > 200 THEN 'high_value'
       WHEN d.order_id IS NOT NULL THEN 'damage_reship'
       WHEN coalesce(s.delivered_on, {DAY}) - s.expected_on > 15 THEN 'long_delay' END AS reason
FROM shipments s LEFT JOIN vips USING (customer_id) LEFT JOIN damage_claims d ON d.order_id = s.order_id)""")
def upgrade(t: Tables):
    return shipping.free_upgrade(t.shipments, lookups.customer_orders(t.lines), t.damage_claims, AS_OF)


@query("pol_32_failed_subscription", """
SELECT account_id, attempt_id, reason, CAST(CAST(attempted_at AS DATE) + 7 AS VARCHAR) AS next_attempt
FROM (SELECT * FROM attempts QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY attempted_at DESC, attempt_id DESC) = 1)
WHERE failed""")
def failed(t: Tables):
    return shipping.failed_subscriptions(t.attempts)


step("decided", f"""
WITH x AS (SELECT w.*, item_condition = 'adverse_reaction' AS adv, item_condition = 'adverse_reaction' OR eligible AS ok,
                  item_condition <> 'adverse_reaction' AND eligible AS plain, item_condition = 'opened' AS opened,
                  item_condition = 'damaged' AS dam, item_condition = 'damaged' AND coalesce(discontinued, false) AS gone, pid IS NULL AS unknown
           FROM windowed w LEFT JOIN (SELECT product_id AS pid, discontinued FROM raw_products) p ON p.pid = w.product_id),
 y AS (SELECT *, plain AND is_vip AND (opened OR (window_rule = 'vip' AND days_used > 30)) AS discretion FROM x),
 z AS (SELECT *, CASE WHEN NOT ok THEN NULL WHEN adv THEN 'auto' WHEN discretion AND amount < 50 THEN 'manager' ELSE {TIER_SQL} END AS approval,
              CASE WHEN NOT ok THEN NULL WHEN gone THEN 'refund_only' ELSE {FORM_SQL} END AS refund_form FROM y)
SELECT order_id, line_no, product_id, customer_id, CASE WHEN ok THEN 'approve' ELSE 'deny' END AS decision,
       refund_form, approval, {flags_sql(
    ('adv', 'adverse_override'), ('plain', 'inside_window'), ('NOT ok', 'outside_window'),
    ("NOT adv AND window_rule = 'holiday'", 'holiday_window'), ("NOT adv AND window_rule = 'vip'", 'vip_window'),
    ('plain AND opened AND is_vip', 'vip_opened_refund'), ('plain AND opened AND NOT is_vip', 'opened_store_credit'),
    ('plain AND dam AND NOT gone', 'damage_sop'), ('plain AND gone', 'discontinued_refund_only'), ('discretion', 'manager_discretion'),
    ("approval = 'manager'", 'manager_approval'), ("approval = 'director'", 'director_approval'), ('unknown', 'unknown_product'))} AS rules,
       '{{"days_used":' || days_used || ',"item_condition":"' || item_condition || '","is_vip":' || is_vip
       || ',"window_rule":"' || window_rule || '"}}' AS inputs
FROM z""")


@query("pol_33_decision_trace", "SELECT * FROM decided")
def trace(t: Tables):
    return returns.decide(vip_windows(t), t.raw_products)


# --- catalogue --------------------------------------------------------------

step("ingredients", """
SELECT product_id, i.ingredient AS ingredient, max(i.concentration)::DOUBLE AS concentration
FROM (SELECT product_id, unnest(ingredients) AS i FROM product_facts) GROUP BY ALL""")
step("sold", """
SELECT product_id, sum(greatest(quantity, 0)) AS units, count(*) AS n, count(*) FILTER (returned) AS r FROM orders_c GROUP BY 1""")
step("conflict_pairs", "SELECT * FROM (VALUES (0, 6, 'forbidden'), (1, 7, 'caution')) AS p(first, second, severity)")


def pairs(t: Tables):
    return t.spark.sql("SELECT * FROM VALUES (0, 6, 'forbidden'), (1, 7, 'caution') AS p(first, second, severity)")


@query("cat_1_ingredients", """
SELECT ingredient, count(*) AS n_products, CAST(coalesce(sum(units), 0) AS BIGINT) AS units_sold, round(sum(r) / sum(n), 6) AS return_rate,
       min(concentration) AS min_concentration, max(concentration) AS max_concentration
FROM ingredients LEFT JOIN sold USING (product_id) GROUP BY ingredient""")
def ingredients(t: Tables):
    return products.ingredient_report(t.product_facts, t.lines)


@query("cat_1_ingredient_products", """
SELECT ingredient, product_id, concentration, rank() OVER (PARTITION BY ingredient ORDER BY concentration DESC) AS strength_rank,
       CAST(coalesce(units, 0) AS BIGINT) AS units_sold, round(r / n, 6) AS return_rate
FROM ingredients LEFT JOIN sold USING (product_id)""")
def ingredient_products(t: Tables):
    return products.ingredient_products(t.product_facts, t.lines)


@query("cat_2_order_conflicts", """
WITH u AS MATERIALIZED (
  SELECT order_id, ingredient, count(DISTINCT product_id) AS n FROM orders_c JOIN ingredients USING (product_id)
  WHERE ingredient IN (SELECT first FROM conflict_pairs UNION SELECT second FROM conflict_pairs) GROUP BY 1, 2)
SELECT a.order_id, first, second, severity, a.n AS n_first, b.n AS n_second
FROM u a JOIN conflict_pairs ON a.ingredient = first JOIN u b ON b.order_id = a.order_id AND b.ingredient = second""")
def order_conflicts(t: Tables):
    return products.order_conflicts(t.lines, t.product_facts, pairs(t))


@query("cat_2_customer_conflicts", """
WITH u AS (SELECT DISTINCT customer_id, ingredient, CAST(order_date AS DATE) AS day FROM orders_c
           JOIN ingredients USING (product_id) WHERE customer_id > 0),
 s AS (SELECT customer_id, day, first, second, severity, ingredient = first AS f FROM u JOIN conflict_pairs ON ingredient IN (first, second)),
 g AS (SELECT x.customer_id, x.first, x.second, x.severity, x.day, x.f, min(x.day - y.day) AS gap FROM s x
       JOIN s y ON x.customer_id = y.customer_id AND x.first = y.first AND x.f <> y.f AND y.day <= x.day AND x.day - y.day <= 30
       GROUP BY ALL)
SELECT customer_id, first, second, severity, count(*) AS n_days, min(gap) AS min_gap FROM g GROUP BY ALL""")
def customer_conflicts(t: Tables):
    return products.customer_conflicts(t.lines, t.product_facts, pairs(t))


SENSITIVE = ("fragrance_free", "pregnancy_safe")


def lacking_sql(*required: str) -> str:
    """Products with the names of the ``required`` attributes they lack, as a common table ``i``."""
    has = ", ".join(f"bool_or(attribute = '{a}') AS {a}" for a in required)
    missing = "concat_ws(',', " + ", ".join(f"CASE WHEN NOT coalesce({a}, false) THEN '{a}' END" for a in required) + ")"
    return f"""i AS (SELECT product_id, category, stock_level, {missing} AS missing FROM products_c
      LEFT JOIN (SELECT product_id, {has} FROM product_attributes GROUP BY 1) a USING (product_id))"""


def lacking_lines_sql(*required: str) -> str:
    return f"""
WITH {lacking_sql(*required)},
 o AS (SELECT category, count(*) AS n_substitutes, max_by(product_id, CAST(stock_level AS BIGINT) * 1000000000 - product_id) AS best_substitute
       FROM i WHERE missing = '' AND stock_level > 0 GROUP BY 1)
SELECT order_id, product_id, category, missing, coalesce(n_substitutes, 0) AS n_substitutes, best_substitute
FROM orders_c JOIN i USING (product_id) LEFT JOIN o USING (category) WHERE missing <> ''"""


@query("cat_3_unsafe_lines", lacking_lines_sql("pregnancy_safe"))
def unsafe(t: Tables):
    return products.lacking_lines(t.lines, t.products, t.product_attributes, ["pregnancy_safe"])


@query("cat_3_sensitive_lines", lacking_lines_sql(*SENSITIVE))
def sensitive(t: Tables):
    return products.lacking_lines(t.lines, t.products, t.product_attributes, SENSITIVE)


@query("cat_3_products", f"WITH {lacking_sql(*SENSITIVE, 'vegan')} SELECT product_id, category, missing, missing = '' AS has_all FROM i")
def with_attributes(t: Tables):
    return products.attribute_products(t.products.select("product_id", "category"), t.product_attributes, [*SENSITIVE, "vegan"])


@query("cat_4_sets", f"""
WITH {lacking_sql("pregnancy_safe")}
SELECT set_id, count(*) AS n_components, round(max(s.price), 6) AS set_price, round(sum(p.price), 6) AS items_price,
       round(sum(p.price) - max(s.price), 6) AS saving, bool_or(missing <> '') AS any_lacking
FROM set_components c JOIN raw_products p USING (product_id) JOIN i USING (product_id)
JOIN raw_products s ON s.product_id = c.set_id GROUP BY set_id""")
def sets(t: Tables):
    return products.set_report(t.set_components, t.raw_products, t.product_attributes, ["pregnancy_safe"])


@query("cat_5_routine_gaps", """
WITH st AS (SELECT product_id, step_group // 4 AS routine, step_group % 4 AS step FROM product_facts),
 ow AS (SELECT DISTINCT customer_id, routine, step FROM orders_c JOIN st USING (product_id) WHERE customer_id > 0),
 offer AS (SELECT routine, step, max_by(product_id, CAST(stock_level AS BIGINT) * 1000000000 - product_id) AS product_id
       FROM st JOIN products_c USING (product_id) WHERE stock_level > 0 GROUP BY 1, 2)
SELECT c.customer_id, c.routine, f.step, f.product_id
FROM (SELECT DISTINCT customer_id, routine FROM ow) c JOIN offer f USING (routine)
LEFT JOIN ow ON ow.customer_id = c.customer_id AND ow.routine = c.routine AND ow.step = f.step
WHERE ow.step IS NULL""")
def routines(t: Tables):
    steps = t.product_facts.select("product_id", F.expr("step_group div 4").alias("routine"),
                                   F.expr("step_group % 4").alias("step"))
    return products.routine_gaps(t.lines, steps, t.products)
