"""Text analysis of reviews.

The stored prose is invented; the vocabularies below name words that occur in it
beside the words of the plain rule, so that scores differ between reviews.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cartloom.functions import text
from cartloom.functions.scalar import mean, rows
from cartloom.operators.groups import Order, best_per_group
from cartloom.plans import oracle as q
from cartloom.plans.registry import query
from cartloom.session import durable

POSITIVE = text.POSITIVE
NEGATIVE = [*text.NEGATIVE, "worthless", "pathetic"]
LABELS = {
    "product_quality": ["broken", "worthless", "quality"],
    "shipping_delivery": ["shipping", "delivery"],
    "customer_service": ["service", "call", "email"],
    "value_for_money": ["price", "value"],
}
RIGHTS = ["license", "copyright"]
OTHERWISE = "general_positive"
STOP = ["the", "and", "of", "der", "die", "das", "que", "des", "les", "los", "und", "was", "for", "that", "with"]


def sql_list(words):
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


TOKENS = r"(SELECT *, list_filter(string_split_regex(lower(review_text), '[^\p{L}]+'), lambda w: w <> '') AS tokens FROM rev)"


def sql_hits(words):
    return f"len(list_filter(tokens, lambda w: list_contains({sql_list(words)}, w)))"


SENTIMENT = f"""coalesce(CAST(({sql_hits(POSITIVE)} - {sql_hits(NEGATIVE)}) AS DOUBLE)
  / nullif({sql_hits(POSITIVE)} + {sql_hits(NEGATIVE)}, 0), 0)"""
SCORES = ", ".join(f"{sql_hits(v)} AS h{i}" for i, v in enumerate(LABELS.values()))
SCORED = f"(SELECT *, {SENTIMENT} AS sentiment, {SCORES} FROM {TOKENS})"
LABEL = "CASE " + " ".join(
    f"WHEN h{i} > 0 AND h{i} = greatest(h0, h1, h2, h3) THEN '{name}'" for i, name in enumerate(LABELS)
) + f" ELSE '{OTHERWISE}' END"
ENRICHED = f"(SELECT review_id, product_id, rating, helpful_votes, sentiment, {LABEL} AS label FROM {SCORED})"
R4 = "CAST(round(CAST({} AS DECIMAL(38,8)), 4) AS DOUBLE)"


def r4(x):
    return F.round(x.cast("decimal(38,8)"), 4).cast("double")


def tokenised(m, *columns):
    """Reviews with the words of their whole text; split once, scored many times."""
    return m.reviews().select(*columns, text.words(F.col("review_text")).alias("tokens"))


@query("sentiment_score", f"""SELECT rating, count(*) AS reviews, {R4.format('round(sum(sentiment), 8) / count(*)')} AS avg_sentiment,
  {R4.format('min(sentiment)')} AS min_sentiment, {R4.format('max(sentiment)')} AS max_sentiment FROM {SCORED} GROUP BY rating""")
def sentiment_score(m):
    score = text.sentiment(F.col("tokens"), POSITIVE, NEGATIVE)
    s = tokenised(m, "rating").select("rating", score.alias("s"))
    return s.groupBy("rating").agg(
        rows().alias("reviews"),
        r4(F.round(F.sum("s"), 8) / rows()).alias("avg_sentiment"),
        r4(F.min("s")).alias("min_sentiment"),
        r4(F.max("s")).alias("max_sentiment"),
    )


@query("sentiment_simple", """SELECT review_id, rating, CASE WHEN list_has_any(tokens, {}) THEN 1e0 WHEN list_has_any(tokens, {})
  THEN -1e0 ELSE 0e0 END AS score FROM {}""".format(sql_list(POSITIVE), sql_list(NEGATIVE), TOKENS))
def sentiment_simple(m):
    """1 with any positive word, else -1 with any negative word, else 0."""
    t = F.col("tokens")
    score = F.when(text.mentions(t, POSITIVE), 1.0).when(text.mentions(t, NEGATIVE), -1.0).otherwise(0.0)
    return tokenised(m, "review_id", "rating").select("review_id", "rating", score.alias("score"))


@query("classify_text", f"""SELECT label, count(*) AS reviews, {q.mean('rating')} AS avg_rating FROM {ENRICHED} GROUP BY label""")
def classify_text(m):
    label = text.classify(F.col("tokens"), LABELS, OTHERWISE)
    c = tokenised(m, "rating").select(label.alias("label"), "rating")
    return c.groupBy("label").agg(rows().alias("reviews"), mean("rating").alias("avg_rating"))


@query("filter_text", f"""SELECT review_id, rating FROM {TOKENS} WHERE rating <= 2
  AND list_has_any(tokens, {sql_list(RIGHTS)})""")
def filter_text(m):
    """The rating filter is applied before any text is split."""
    r = m.reviews().filter(F.col("rating") <= 2)
    tokens = text.words(F.col("review_text"))
    return r.filter(text.mentions(tokens, RIGHTS)).select("review_id", "rating")


@query("top_terms_per_group", f"""WITH t AS (SELECT DISTINCT category, review_id, unnest(tokens) AS term FROM {TOKENS}
  JOIN prod USING (product_id) WHERE rating = 1), f AS (SELECT category, term, count(*) AS reviews FROM t
  WHERE length(term) > 2 AND NOT list_contains({sql_list(STOP)}, term) GROUP BY ALL)
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY reviews DESC, term) AS place FROM f) WHERE place <= 3""")
def top_terms_per_group(m):
    """Terms by the number of one-star reviews that hold them, three per category.

    A review becomes the list of its distinct words before it meets its product, so
    no text is shuffled; words are counted on the map side, and the last step keeps
    three rows per task and category.
    """
    kept = F.filter(
        F.array_distinct(text.words(F.col("review_text"))), lambda w: (F.length(w) > 2) & ~w.isin(STOP)
    )
    r = m.reviews().filter(F.col("rating") == 1).select("product_id", kept.alias("terms"))
    r = r.join(m.products().select("product_id", "category"), "product_id")
    # An inner explode would have the planner split every text a second time, to
    # drop reviews without words before the join.
    terms = r.select("category", F.explode_outer("terms").alias("term")).filter(F.col("term").isNotNull())
    n = terms.groupBy("category", "term").agg(rows().alias("reviews"))
    return best_per_group(n, ["category"], [Order("reviews", True), Order("term")], 3, "place")


def enriched(m):
    """Scored reviews, stored once for the reports over them."""
    t = tokenised(m, "review_id", "product_id", "rating", "helpful_votes")
    tokens = F.col("tokens")
    e = t.withColumns(
        {"sentiment": text.sentiment(tokens, POSITIVE, NEGATIVE), "label": text.classify(tokens, LABELS, OTHERWISE)}
    )
    return durable(e.drop("tokens"))


@query("enrich_reviews", f"""SELECT label, count(*) AS reviews, {q.mean('rating')} AS avg_rating,
  {R4.format('round(sum(sentiment), 8) / count(*)')} AS avg_sentiment FROM {ENRICHED} GROUP BY label""")
def enrich_reviews(m):
    return enriched(m).groupBy("label").agg(
        rows().alias("reviews"),
        mean("rating").alias("avg_rating"),
        r4(F.round(F.sum("sentiment"), 8) / rows()).alias("avg_sentiment"),
    )


@query("stars_against_text", f"""SELECT review_id, rating, label, {R4.format('sentiment')} AS sentiment FROM {ENRICHED}
  WHERE rating >= 4 AND sentiment < -0.2""")
def stars_against_text(m):
    """Many stars, yet negative words."""
    odd = enriched(m).filter((F.col("rating") >= 4) & (F.col("sentiment") < -0.2))
    return odd.select("review_id", "rating", "label", r4(F.col("sentiment")).alias("sentiment"))


@query("category_sentiment", f"""SELECT category, {q.mean('rating')} AS avg_rating,
  {R4.format('round(sum(sentiment), 8) / count(*)')} AS avg_sentiment, count(*) AS reviews FROM {SCORED}
  JOIN prod USING (product_id) GROUP BY category""")
def category_sentiment(m):
    """Scores are computed before the join, so texts are not shuffled."""
    score = text.sentiment(F.col("tokens"), POSITIVE, NEGATIVE)
    s = tokenised(m, "product_id", "rating").select("product_id", "rating", score.alias("s"))
    s = s.join(m.products().select("product_id", "category"), "product_id")
    return s.groupBy("category").agg(
        mean("rating").alias("avg_rating"),
        r4(F.round(F.sum("s"), 8) / rows()).alias("avg_sentiment"),
        rows().alias("reviews"),
    )
