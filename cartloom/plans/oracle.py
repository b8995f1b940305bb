"""SQL text of the entities, for the oracle side only.

The engine never runs these; they let an independent SQL engine answer the same
question over the stored tables.
"""

from __future__ import annotations

import re

ENTITIES = {
    "cust": """SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS segment,
  n_name AS country, r_name AS region, c_acctbal AS balance, c_acctbal >= 0 AS is_active,
  lower(replace(c_name, '#', '.')) || CASE WHEN c_acctbal >= 0 THEN '@' ELSE ' at ' END
    || upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2)) || '.example.com' AS email,
  substr(c_name, 10, 3) || '-' || substr(c_name, 13, 3) || '-0' || substr(c_name, 16, 3) AS phone
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "ord": """SELECT o_orderkey AS order_id, o_custkey AS customer_id,
  CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' WHEN 'P' THEN 'placed' END AS order_status,
  o_totalprice AS order_total, o_orderdate AS created_at, o_orderpriority AS shipping_method FROM orders""",
    "item": """SELECT l_orderkey AS order_id, l_partkey AS product_id, l_suppkey AS supplier_id,
  l_linenumber AS line_no, l_quantity AS quantity, l_extendedprice AS gross, l_discount AS discount, l_tax AS tax,
  l_extendedprice * (1 - l_discount) AS line_total, l_returnflag AS return_flag, l_linestatus AS line_status,
  l_shipdate AS shipped_at FROM lineitem""",
    "ret": """SELECT l_orderkey AS order_id, l_partkey AS product_id, l_suppkey AS supplier_id,
  l_linenumber AS line_no, l_extendedprice * (1 - l_discount) AS line_total,
  CAST(0.9 AS DOUBLE) * (l_extendedprice * (1 - l_discount)) AS refund, l_shipdate AS shipped_at
  FROM lineitem WHERE l_returnflag = 'R'""",
    "prod": """SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_brand AS subcategory,
  CAST(p_size AS BIGINT) AS size, p_retailprice AS unit_price,
  p_retailprice * CAST(3500 + 30 * (p_partkey % 100) AS DOUBLE) / 1e4 AS cost_price,
  p_partkey % (SELECT count(*) FROM supplier) AS supplier_id FROM part""",
    "supp": """SELECT s_suppkey AS supplier_id, s_name AS supplier_name, n_name AS country, r_name AS region,
  s_acctbal AS balance FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "rev": """SELECT doc_id AS review_id, doc_id % (SELECT count(*) FROM part) AS product_id, 1 + doc_id % 5 AS rating,
  text AS review_text, lang, source, n_chars AS helpful_votes FROM documents""",
    "click": """SELECT event_id, CASE WHEN event_id % 6 <> 0 THEN user_id END AS customer_id,
  CAST(user_id AS VARCHAR) || '/' || strftime(ts, '%Y-%m-%d') AS session_id, event_type,
  CASE event_id % 3 WHEN 0 THEN 'desktop' WHEN 1 THEN 'mobile' ELSE 'tablet' END AS device,
  value, props, ts AS created_at FROM events""",
    "meter": """SELECT event_id AS query_id, ts AS start_time, event_type AS resource, value AS credits,
  'team-' || CAST(user_id AS VARCHAR) AS query_tag, user_id, props FROM events""",
}


def with_entities(body: str) -> str:
    """Put the entities that ``body`` names in front of it as common tables."""
    used = [n for n in ENTITIES if re.search(rf"\b(FROM|JOIN)\s+{n}\b", body)]
    text = ",\n".join(f"{n} AS ({ENTITIES[n]})" for n in used)
    body = body.strip()
    if not used:
        return body
    if body[:14].upper() == "WITH RECURSIVE":
        return f"WITH RECURSIVE {text},\n{body[14:].lstrip()}"
    if body[:5].upper() == "WITH ":
        return f"WITH {text},\n{body[5:]}"
    return f"WITH {text}\n{body}"


def money(x: str) -> str:
    return f"CAST(round(CAST(round(sum({x}), 4) AS DECIMAL(38,4)), 2) AS DOUBLE)"


def mean(x: str) -> str:
    return f"CAST(round(CAST(round(sum({x}), 4) / count({x}) AS DECIMAL(38,6)), 2) AS DOUBLE)"


def r2(x: str) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38,6)), 2) AS DOUBLE)"


def month(x: str) -> str:
    return f"CAST(date_trunc('month', {x}) AS TIMESTAMP)"


REFUNDED = r2("CAST(0.9 AS DOUBLE) * round(sum(line_total), 4)")
