"""Semi-structured data."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartloom.functions.scalar import mean, rows
from cartloom.operators.groups import Order, best_per_group
from cartloom.plans import oracle as q
from cartloom.plans.registry import query


def path(column: str, where: str, kind: str):
    return F.variant_get(F.col(column), where, kind)


def documents(m):
    """One JSON document per click event, kept as one VARIANT per row: who did what,
    the event's own JSON, and the list of tags."""
    c = m.clicks(deal=True)
    text = F.to_json(
        F.struct(
            F.struct("customer_id", "device").alias("who"),
            F.struct("event_type", "value").alias("what"),
            F.array("event_type", "device", F.concat(F.lit("day_"), F.day("created_at").cast("string"))).alias("tags"),
            F.col("props").alias("raw"),
        )
    )
    return c.select("event_id", F.parse_json(text).alias("doc"), F.parse_json("props").alias("props"))


@query("json_paths", """SELECT event_id, device, event_type, value, 'day_' || CAST(day(created_at) AS VARCHAR) AS third_tag,
  CAST(json_extract(props, '$.k') AS BIGINT) AS k, customer_id FROM click""")
def json_paths(m):
    return documents(m).select(
        "event_id",
        path("doc", "$.who.device", "string").alias("device"),
        path("doc", "$.what.event_type", "string").alias("event_type"),
        path("doc", "$.what.value", "double").alias("value"),
        path("doc", "$.tags[2]", "string").alias("third_tag"),
        path("props", "$.k", "bigint").alias("k"),
        path("doc", "$.who.customer_id", "bigint").alias("customer_id"),
    )


def exploded_tags(m):
    """One row per tag with its index; every document has tags, and the outer form
    keeps the planner from reading each document twice to check that."""
    tags = path("doc", "$.tags", "array<string>")
    return documents(m).select(
        "event_id", path("doc", "$.what.value", "double").alias("value"), F.posexplode_outer(tags).alias("pos", "tag")
    )


TAGS = """(SELECT event_id, value, 0 AS pos, event_type AS tag FROM click UNION ALL SELECT event_id, value, 1, device
  FROM click UNION ALL SELECT event_id, value, 2, 'day_' || CAST(day(created_at) AS VARCHAR) FROM click)"""


@query("json_flatten", f"SELECT event_id, pos, tag FROM {TAGS}")
def json_flatten(m):
    return exploded_tags(m).select("event_id", "pos", "tag")


@query("json_flatten_agg", f"SELECT tag, count(*) AS events, max(value) AS max_value, {q.mean('value')} AS avg_value FROM {TAGS} GROUP BY tag")
def json_flatten_agg(m):
    return exploded_tags(m).groupBy("tag").agg(
        rows().alias("events"), F.max("value").alias("max_value"), mean("value").alias("avg_value")
    )


@query("json_group", f"""SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS events,
  {q.mean('value')} AS avg_value FROM click GROUP BY 1""")
def json_group(m):
    c = m.clicks().select(F.variant_get(F.parse_json("props"), "$.k", "bigint").alias("k"), "value")
    return c.groupBy("k").agg(rows().alias("events"), mean("value").alias("avg_value"))


@query("json_mixed_types", r"""SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS as_number,
  CASE WHEN event_type = 'error' THEN 'unknown' ELSE regexp_replace(CAST(value AS VARCHAR), '\.0$', '') END AS as_text FROM click""")
def json_mixed_types(m):
    """A field that is a number in most documents and text in some.  As text, a stored
    number has no trailing zeros; the oracle's number format, which has, is cut to that."""
    c = m.clicks()
    field = F.when(F.col("event_type") == "error", F.lit('"unknown"')).otherwise(F.col("value").cast("string"))
    doc = F.parse_json(F.concat(F.lit('{"amount": '), field, F.lit("}")))
    d = c.select("event_id", doc.alias("doc"))
    return d.select(
        "event_id",
        F.try_variant_get("doc", "$.amount", "double").alias("as_number"),
        F.variant_get("doc", "$.amount", "string").alias("as_text"),
    )


@query("json_build", """SELECT category, '{"category":"' || category || '","products":' || CAST(count(*) AS VARCHAR) || '}'
  AS doc, '["' || string_agg(DISTINCT subcategory, '","' ORDER BY subcategory) || '"]' AS brands FROM prod GROUP BY category""")
def json_build(m):
    """Objects and arrays from rows.  An array is built from distinct members, so its
    length is the number of brands and not the number of products."""
    pairs = m.products().groupBy("category", "subcategory").agg(rows().alias("n"))
    g = pairs.groupBy("category").agg(
        F.sum("n").alias("products"), F.sort_array(F.collect_list("subcategory")).alias("list")
    )
    return g.select(
        "category", F.to_json(F.struct("category", "products")).alias("doc"), F.to_json("list").alias("brands")
    )


@query("top_helpful", """SELECT rating, review_id, helpful_votes, place FROM (SELECT *, row_number() OVER (PARTITION BY
  rating ORDER BY helpful_votes DESC, review_id) AS place FROM rev) WHERE place <= 3""")
def top_helpful(m):
    r = m.reviews().select("rating", "review_id", "helpful_votes")
    return best_per_group(r, ["rating"], [Order("helpful_votes", True), Order("review_id")], 3, "place")
