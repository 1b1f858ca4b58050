"""Binding of the supplied test tables to the engine's inputs.

The supplied tables are clean, so each view derives its dirt and its extra
columns by arithmetic on ids. One SQL text serves Spark and the oracle; only
the names below differ. Every view keeps all rows of its table.
"""

from __future__ import annotations

AS_OF = "2001-08-02 00:00:00"

SPARK = {"explode": "explode", "series": "sequence", "text": "STRING", "each": "transform", "of": "i ->", "none": "array()",
         "ingredient": "named_struct('ingredient', ", "concentration": ", 'concentration', "}
DUCKDB = {"explode": "unnest", "series": "generate_series", "text": "VARCHAR", "each": "list_transform", "of": "lambda i:", "none": "[]",
          "ingredient": "struct_pack(ingredient := ", "concentration": ", concentration := "}

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

VIEWS = {
    "raw_products": """
SELECT p_partkey AS product_id,
       CASE WHEN p_partkey % 10 = 0 THEN p_name || '  ' ELSE p_name END AS name,
       CASE WHEN p_partkey % 7 = 0 THEN lower(p_type) ELSE p_type END AS category,
       p_retailprice AS price,
       round(p_retailprice * (0.25 + (p_partkey % 10) * 0.05), 2) AS cost,
       CAST(50 + (p_partkey * 37) % 451 AS INT) AS stock_level,
       100 AS restock_threshold,
       p_partkey % 50 = 9 AS discontinued
FROM {part}""",
    "raw_customers": """
SELECT c_custkey + 1 AS customer_id,
       'CUST_' || lpad(CAST(c_custkey + 1 AS {text}), 6, '0') AS customer_ref,
       CASE WHEN c_custkey % 5 = 1 THEN upper('customer_' || CAST(c_custkey + 1 AS {text}) || '@example.com')
            WHEN c_custkey % 10 = 2 THEN ' customer_' || CAST(c_custkey + 1 AS {text}) || '@example.com '
            WHEN c_custkey % 50 = 49 THEN 'customer_' || CAST(c_custkey AS {text}) || '@example.com'
            ELSE 'customer_' || CAST(c_custkey + 1 AS {text}) || '@example.com' END AS email,
       n_name AS city,
       CASE c_custkey % 6 WHEN 0 THEN 'NY' WHEN 1 THEN 'CA' WHEN 2 THEN 'TX'
            WHEN 3 THEN 'New York' WHEN 4 THEN 'California' ELSE 'Texas' END AS state,
       CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE lower(c_mktsegment) END AS acquisition_channel,
       CAST(DATE '1993-01-01' + CAST(c_custkey % 700 AS INT) AS {text}) AS created_at
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey""",
    # A copied line appears twice: the copies are exploded, not joined.
    "raw_orders": """
SELECT order_id, customer_id, customer_email, order_date, product_id, quantity, price,
       discount_applied, is_subscription, order_status, returned, return_reason
FROM (
SELECT l_orderkey AS order_id,
       CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_custkey + 1 END AS customer_id,
       CASE WHEN o_orderkey % 10 = 0 THEN NULL
            ELSE 'customer_' || CAST(o_custkey + 1 AS {text}) || '@example.com' END AS customer_email,
       CASE WHEN o_orderkey % 101 = 5 THEN 'unknown'
            WHEN o_orderkey % 3 = 0 THEN d
            WHEN o_orderkey % 3 = 1 THEN substr(d, 6, 2) || '/' || substr(d, 9, 2) || '/' || substr(d, 1, 4)
            ELSE d || 'T00:00:00' END AS order_date,
       l_partkey AS product_id,
       CAST(CASE WHEN l_returnflag = 'R' AND l_partkey % 50 = 3 THEN -1 ELSE l_quantity END AS INT) AS quantity,
       l_extendedprice / l_quantity AS price,
       CASE WHEN l_discount > 0.07 THEN 1 ELSE 0 END AS discount_applied,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS is_subscription,
       CASE WHEN o_orderkey % 20 = 7 THEN NULL WHEN o_orderstatus = 'F' THEN 'delivered'
            WHEN o_orderstatus = 'O' THEN 'shipped' ELSE 'processing' END AS order_status,
       CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS returned,
       CASE WHEN l_returnflag <> 'R' THEN NULL WHEN l_partkey % 3 = 0 THEN 'skin_reaction'
            WHEN l_partkey % 3 = 1 THEN 'damaged' ELSE 'changed_mind' END AS return_reason,
       {explode}({series}(1, CASE WHEN l_orderkey % 25 = 3 AND l_linenumber = 1 THEN 2 ELSE 1 END)) AS copy
FROM (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
             CAST(CAST(o_orderdate AS DATE) AS {text}) AS d FROM {orders}) o
JOIN {lineitem} ON o_orderkey = l_orderkey) lines""",
    "shipments": """
SELECT o_orderkey AS order_id, o_custkey + 1 AS customer_id, o_totalprice / 1000 AS order_value,
       CAST(o_orderdate AS DATE) AS ordered_at, o_orderstatus AS order_state,
       CASE o_orderkey % 3 WHEN 0 THEN 'UPS' WHEN 1 THEN 'USPS' ELSE 'UPS Express' END AS carrier,
       CASE WHEN o_orderkey % 101 = 7 THEN 'XX' ELSE
         CASE o_orderkey % 7 WHEN 0 THEN 'CA' WHEN 1 THEN 'UK_EU' WHEN 2 THEN 'AU' WHEN 3 THEN 'APO' ELSE 'US' END END AS zone,
       CASE o_orderkey % 4 WHEN 0 THEN 'express' WHEN 1 THEN 'expedited' ELSE 'standard' END AS method,
       o_orderkey % 11 = 0 AS po_box,
       o_orderkey % 13 = 0 AS missing_unit,
       o_orderkey % 17 = 0 AS our_error,
       o_orderkey % 19 = 0 AS complaint,
       o_orderkey % 29 = 0 AS address_error,
       o_orderpriority = '1-URGENT' AS is_subscription,
       CAST(o_orderdate AS DATE) + CAST(1 + o_orderkey % 4 AS INT) AS shipped_on,
       CAST(o_orderdate AS DATE) + CAST(8 + o_orderkey % 5 AS INT) AS expected_on,
       CASE WHEN o_orderkey % 97 = 13 THEN NULL
            ELSE CAST(o_orderdate AS DATE) + CAST(4 + (o_orderkey * 7) % 24 AS INT) END AS delivered_on
FROM {orders}""",
    # One claim per delivered order of final status.
    "damage_claims": """
SELECT order_id AS claim_id, order_id, customer_id, order_value, carrier, ordered_at, delivered_on,
       delivered_on + CAST(order_id % 12 AS INT) AS claimed_on,
       CASE order_id % 6 WHEN 0 THEN 'C' WHEN 2 THEN 'B' ELSE 'A' END AS grade,
       CAST(1 + order_id % 3 AS INT) AS damaged_items,
       order_id % 8 <> 0 AS has_photos, order_id % 10 = 4 AS carrier_paid,
       CAST(order_id % 100 AS INT) AS hours_since_request
FROM {shipments} WHERE delivered_on IS NOT NULL AND order_state = 'F'""",
    "return_requests": """
SELECT l_orderkey AS order_id, l_linenumber AS line_no, CASE WHEN l_partkey % 41 = 5 THEN -l_partkey ELSE l_partkey END AS product_id,
       customer_id, l_extendedprice / 500 AS amount, ordered_at, delivered_on,
       delivered_on + CAST((l_orderkey * 7 + l_linenumber) % 60 AS INT) AS requested_on,
       CASE l_partkey % 5 WHEN 0 THEN 'adverse_reaction' WHEN 1 THEN 'damaged'
            WHEN 2 THEN 'opened' ELSE 'unopened' END AS item_condition
FROM {lineitem} JOIN {shipments} s ON s.order_id = l_orderkey
WHERE l_returnflag = 'R' AND delivered_on IS NOT NULL""",
    "product_stock": """
SELECT p_partkey AS product_id, CAST(p_partkey * 13 % 25 AS INT) AS stock, p_partkey % 50 = 9 AS discontinued
FROM {part} WHERE p_partkey % 37 <> 3""",
    # Every fifth product is a set of the three products after it.
    "set_components": """
SELECT set_id, c.p_partkey AS product_id, c.p_partkey % 4 <> 2 AS sold_separately
FROM (SELECT p_partkey AS set_id, {explode}({series}(1, 3)) AS k FROM {part} WHERE p_partkey % 5 = 0) s
JOIN {part} c ON c.p_partkey = set_id + k""",
    # What customers got, sets under their own ids, and the units they bring back: single
    # products as bought, and of a set two or three of its parts, some units each.
    "purchases": """
SELECT l_orderkey AS order_id, customer_id, l_partkey AS product_id, CAST(l_quantity AS INT) AS units, ordered_at
FROM {lineitem} JOIN {shipments} s ON s.order_id = l_orderkey""",
    "returned_units": """
SELECT order_id, line_no, customer_id, CASE WHEN part = 0 THEN product_id ELSE product_id + part END AS product_id,
       CASE WHEN part = 0 THEN bought ELSE 1 + CAST((order_id * 3 + part * 7) % bought AS INT) END AS units,
       requested_on + CAST(part * 3 AS INT) AS requested_on
FROM (SELECT l_orderkey AS order_id, l_linenumber AS line_no, customer_id, l_partkey AS product_id, CAST(l_quantity AS INT) AS bought,
             delivered_on + CAST((l_orderkey * 7 + l_linenumber) % 60 AS INT) AS requested_on,
             {explode}({series}(CASE WHEN l_partkey % 5 = 0 THEN 1 ELSE 0 END, CASE WHEN l_partkey % 5 = 0 THEN 3 ELSE 0 END)) AS part
      FROM {lineitem} JOIN {shipments} s ON s.order_id = l_orderkey
      WHERE l_returnflag = 'R' AND delivered_on IS NOT NULL AND l_partkey % 5 <> 4) r
WHERE part = 0 OR (order_id + part) % 4 <> 1""",
    "received_items": """
SELECT l_orderkey AS order_id, l_partkey + CASE WHEN l_orderkey % 9 = 4 THEN 1 ELSE 0 END AS product_id
FROM {lineitem}""",
    "ordered_items": "SELECT l_orderkey AS order_id, l_partkey AS product_id FROM {lineitem}",
    "attempts": """
SELECT event_id AS attempt_id, user_id AS account_id, ts AS attempted_at, event_type = 'error' AS failed,
       CASE WHEN value < 10 THEN 'payment' WHEN value < 50 THEN 'address' ELSE 'out_of_stock' END AS reason
FROM {events}""",
    # None to seven ingredients a product, each with a concentration in percent.
    "product_facts": """
SELECT p_partkey AS product_id, CAST(p_partkey % 12 AS INT) AS step_group,
       CASE WHEN p_partkey % 8 = 0 THEN {none} ELSE
         {each}({series}(1, CAST(p_partkey % 8 AS INT)), {of} {ingredient}CAST((p_partkey * 3 + i * 5) % 23 AS INT){concentration}0.5 * CAST((p_partkey + i * 3) % 40 AS INT)))
       END AS ingredients
FROM {part}""",
    "product_attributes": """
SELECT p_partkey AS product_id, 'pregnancy_safe' AS attribute FROM {part} WHERE p_partkey % 5 <> 0
UNION ALL SELECT p_partkey, 'fragrance_free' FROM {part} WHERE p_partkey % 3 <> 1
UNION ALL SELECT p_partkey, 'vegan' FROM {part} WHERE p_partkey % 2 = 0
UNION ALL SELECT p_partkey, 'non_comedogenic' FROM {part} WHERE p_partkey % 7 < 3""",
}
