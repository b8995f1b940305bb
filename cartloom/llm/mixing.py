"""Mixing sources to target weights: budgets flow down a tree, leaves give token prefixes of seeded epochs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartloom.llm.common import attach, durable, fresh, once, query, table
from cartloom.llm.simhash import text_mark

TOKEN = r"[^\x20\x09-\x0D]+"
LEVELS = ["domain", "lang", "source"]
#: Integer weights among siblings by level and name; a name without an entry weighs 1.
WEIGHTS = {"domain": {"domain0": 4, "domain1": 3, "domain2": 2}, "lang": {"en": 5, "de": 2, "fr": 2}}
#: Tokens to select as a share of all tokens, most epochs of one document, and the seed.
SHARE, EPOCHS, SEED = 0.75, 2, 7
#: Hex digits of a document's place in its epoch that name its bucket: 4,096 buckets a leaf.
BUCKET_DIGITS = 3


def domain_of(source: Column) -> Column:
    """Domain of a source, by the number its name ends in."""
    number = F.regexp_extract(source, "([0-9]{1,9})$", 1)
    return F.concat(F.lit("domain"), F.when(number != "", number.cast("long") % 4).otherwise(0).cast("string"))


def _weight(level: str, weights: dict[str, dict[str, int]]) -> Column:
    out = F.lit(1)
    for name, value in sorted(weights.get(level, {}).items()):
        out = F.when(F.col(level) == name, F.lit(value)).otherwise(out)
    return out.cast("long")


def allocate(leaves: DataFrame, levels: list[str], weights: dict[str, dict[str, int]], budget: int, epochs: int) -> DataFrame:
    """``levels, tokens, budget`` for stored ``leaves`` (``levels, tokens``).

    A node's budget is shared among its children by weight. A child that holds less
    than its share gives everything it has (its tokens times ``epochs``), and what it
    lacks goes to its siblings by weight; only what the whole family lacks had gone to
    the parent's siblings before. Filled in the order of what a child holds per weight,
    children saturate first, so running sums decide each family at once.
    """
    above, parents = None, []
    for depth in range(1, len(levels) + 1):
        path = levels[:depth]
        nodes = leaves.groupBy(*path).agg((F.sum("tokens") * epochs).alias("cap")).withColumn("w", _weight(path[-1], weights))
        if above is None:
            nodes = nodes.withColumn("b", F.lit(budget).cast("long"))
        else:
            named = above.select(*[F.col(p).alias(f"_{p}") for p in parents], F.col("budget").alias("b"))
            on = F.lit(True)
            for p in parents:
                on = on & F.col(p).eqNullSafe(F.col(f"_{p}"))
            nodes = nodes.join(named, on).drop(*[f"_{p}" for p in parents])
        family = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
        fill = family.orderBy(F.try_divide(F.col("cap").cast("double"), F.col("w").cast("double")).asc_nulls_last(), path[-1])
        before = fill.rowsBetween(Window.unboundedPreceding, -1)
        zero = F.lit(0).cast("long")
        taken, weighed = F.coalesce(F.sum("cap").over(before), zero), F.coalesce(F.sum("w").over(before), zero)
        full = F.col("cap") * (F.sum("w").over(family) - weighed) <= F.col("w") * (F.col("b") - taken)
        nodes = nodes.withColumn("full", full)
        left = F.col("b") - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(zero)).over(family)
        open_weight = F.sum(F.when(F.col("full"), zero).otherwise(F.col("w"))).over(family)
        nodes = nodes.withColumn("left", left).withColumn("open", open_weight)
        share = F.when(F.col("full"), F.col("cap")).when(F.col("open") > 0, F.expr("(w * left) div open")).otherwise(zero)
        above, parents = nodes.select(*path, (F.expr(f"cap div {epochs}")).alias("tokens"), share.alias("budget")), path
    return above


def select(units: DataFrame, levels: list[str], weights: dict[str, dict[str, int]], share: float, epochs: int, seed: int) -> DataFrame:
    """``doc_id, mark, levels, tokens, copies, n_epochs`` of the documents a mix takes at least once.

    ``units`` is stored and has one row per document. A leaf's budget pays for whole
    epochs and a last, partial one: of the documents in the order of a hash of seed,
    epoch and id, those whose running token count stays within the rest. The running
    count is taken per bucket of the hash and the buckets are summed, so no leaf is
    ever sorted in one task.
    """
    leaves = durable(units.groupBy(*levels).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n")))
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    paid = allocate(leaves, levels, weights, int(total * share), epochs)
    joined = leaves.select(*levels, "n").alias("l").join(paid.alias("p"), same_by_name(levels), "inner").select(*[F.col(f"l.{x}") for x in levels], "n", "tokens", "budget")
    facts = joined.select(*levels, "n", F.coalesce(F.expr("try_divide(budget - pmod(budget, nullif(tokens, 0)), tokens)").cast("long"), F.lit(0).cast("long")).alias("whole"), F.col("budget"), F.col("tokens").alias("leaf_tokens"))
    facts = durable(facts.select(*levels, "n", "whole", (F.col("budget") - F.col("whole") * F.col("leaf_tokens")).alias("rest")))
    rows = attach(units, facts, levels, "n")
    place = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("whole").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), F.col("mark").cast("string")))).cast("binary"))
    rows = rows.withColumn("place", place).withColumn("bucket", F.substring("place", 1, BUCKET_DIGITS))
    sums = rows.groupBy(*levels, "bucket").agg(F.sum("tokens").alias("held"))
    order = Window.partitionBy(*levels).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*[F.col(x).alias(f"_{x}") for x in [*levels, "bucket"]], F.coalesce(F.sum("held").over(order), F.lit(0).cast("long")).alias("before"))
    on = F.lit(True)
    for x in [*levels, "bucket"]:
        on = on & F.col(x).eqNullSafe(F.col(f"_{x}"))
    inner = Window.partitionBy(*levels, "bucket").orderBy("place", "mark").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("running", F.sum("tokens").over(inner)).join(sums, on)
    n = F.col("whole") + (F.col("before") + F.col("running") <= F.col("rest")).cast("long")
    return rows.select("doc_id", "mark", *levels, "tokens", "copies", n.alias("n_epochs")).where("n_epochs > 0")


def same_by_name(levels: list[str]) -> Column:
    on = F.lit(True)
    for x in levels:
        on = on & F.col(f"l.{x}").eqNullSafe(F.col(f"p.{x}"))
    return on


def units_of(docs: DataFrame, levels: dict[str, Column], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, mark, levels, tokens, copies``: one row per document, tokens are words, copies its rows."""
    tokens = F.coalesce(F.regexp_count(text, F.lit(TOKEN)).cast("long"), F.lit(0).cast("long"))
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_mark(docs, text).alias("mark"), *[c.alias(n) for n, c in levels.items()], tokens.alias("tokens"))
    return rows.groupBy("doc_id", "mark", *levels).agg(F.max("tokens").alias("tokens"), F.count("*").alias("copies"))


def default_levels(docs: DataFrame) -> dict[str, Column]:
    lang, source = F.coalesce(docs["lang"], F.lit("")), F.coalesce(docs["source"], F.lit(""))
    return {"domain": domain_of(source), "lang": lang, "source": source}


def selection(docs: DataFrame, levels: dict[str, Column] | None = None, weights: dict[str, dict[str, int]] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS, seed: int = SEED, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents of the mix with the number of epochs each is seen: see ``select``.

    ``levels`` names the tree from the root down. NULL languages and sources are the
    empty name; NULL texts have no tokens; documents without tokens cost nothing and
    are taken where their place is within the prefix; rows of equal id, text and levels
    are one document, other rows of equal id are several; rows without doc_id have the
    place of their text; an empty table gives no rows.
    """
    levels = levels or default_levels(docs)
    return select(durable(units_of(docs, levels, doc_id, text)), list(levels), weights, share, epochs, seed)


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents of ``selection`` with their columns and ``n_epochs`` (which replaces a column of that name).

    Of a document's equal rows (id, text and levels) one stays.
    """
    levels = options.pop("levels", None) or default_levels(docs)
    row_id, mark, copies, n = fresh(docs, "_row_id", "_mark", "_copies", "_n")
    names = dict(zip(levels, fresh(docs, *[f"_{x}" for x in levels])))
    taken = selection(docs, levels, doc_id=doc_id, text=text, **options)
    taken = taken.select(F.col("doc_id").alias(row_id), F.col("mark").alias(mark), *[F.col(x).alias(y) for x, y in names.items()], F.col("copies").alias(copies), F.col("n_epochs").alias(n))
    on = docs[doc_id].eqNullSafe(F.col(row_id)) & (text_mark(docs, text) == F.col(mark))
    for x, column in levels.items():
        on = on & column.eqNullSafe(F.col(names[x]))
    met = docs.join(taken, on)
    kept = [c for c in docs.columns if c != "n_epochs"]
    single = met.where(F.col(copies) == 1).select(*[docs[c] for c in kept], F.col(n).alias("n_epochs"))
    if taken.where(F.col(copies) > 1).isEmpty():
        return single
    several = once(met.where(F.col(copies) > 1), [row_id, mark, *names.values()])
    return single.unionByName(several.select(*[F.col(f"`{c}`") for c in kept], F.col(n).alias("n_epochs")))


def _case(column: str, level: str) -> str:
    return "CASE " + column + " " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in WEIGHTS.get(level, {}).items()) + " ELSE 1 END" if WEIGHTS.get(level) else "1"


def _level_sql(path: list[str], parents: list[str], above: str) -> str:
    cols, fam = ", ".join(path), ("PARTITION BY " + ", ".join(parents)) if parents else ""
    budget = f"FROM n JOIN {above} USING ({', '.join(parents)})" if parents else f"FROM n, (SELECT (sum(tokens)::DOUBLE * {SHARE})::DECIMAL(38, 6) AS d FROM leaves) x"
    b = "budget" if parents else "floor(d)::BIGINT"
    return f"""
a{len(path)} AS (
  WITH n AS (SELECT {cols}, (sum(tokens) * {EPOCHS})::BIGINT AS cap, {_case(path[-1], path[-1])} AS w FROM leaves GROUP BY {cols}),
  j AS (SELECT n.*, {b} AS b {budget}),
  s AS (SELECT *, coalesce(sum(cap) OVER f, 0) AS taken, sum(w) OVER ({fam}) - coalesce(sum(w) OVER f, 0) AS open_w
    FROM j WINDOW f AS ({fam} ORDER BY cap::DOUBLE / w::DOUBLE, {path[-1]} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
  t AS (SELECT *, cap * open_w <= w * (b - taken) AS is_full FROM s),
  u AS (SELECT *, b - sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ({fam}) AS remaining, sum(CASE WHEN is_full THEN 0 ELSE w END) OVER ({fam}) AS o FROM t)
  SELECT {cols}, cap // {EPOCHS} AS tokens, (CASE WHEN is_full THEN cap ELSE (w * remaining) // o END)::BIGINT AS budget FROM u),"""


SQL = rf"""
WITH units AS (
  SELECT doc_id, 'domain' || (coalesce(try_cast(nullif(regexp_extract(coalesce(source, ''), '([0-9]{{1,9}})$', 1), '') AS BIGINT), 0) % 4)::VARCHAR AS domain,
    coalesce(lang, '') AS lang, coalesce(source, '') AS source, len(regexp_extract_all(coalesce(text, ''), '{TOKEN}')) AS tokens FROM documents),
leaves AS (SELECT domain, lang, source, sum(tokens)::BIGINT AS tokens FROM units GROUP BY ALL),
{_level_sql(LEVELS[:1], [], "")}{_level_sql(LEVELS[:2], LEVELS[:1], "a1")}{_level_sql(LEVELS, LEVELS[:2], "a2")}
placed AS (
  SELECT u.*, coalesce(a3.budget // nullif(a3.tokens, 0), 0) AS whole, a3.budget - coalesce(a3.budget // nullif(a3.tokens, 0), 0) * a3.tokens AS rest
  FROM units u JOIN a3 USING (domain, lang, source)),
run AS (
  SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY md5('{SEED}:' || whole || ':' || doc_id) ROWS UNBOUNDED PRECEDING) AS running FROM placed)
SELECT doc_id, domain, lang, source, tokens::BIGINT AS n_tokens, (whole + CASE WHEN running <= rest THEN 1 ELSE 0 END)::BIGINT AS n_epochs
FROM run WHERE whole + CASE WHEN running <= rest THEN 1 ELSE 0 END > 0
"""


@query("op4_source_mix", SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents, with the epochs of each."""
    out = selection(table(spark, sf_dir, "documents"))
    return out.select("doc_id", *LEVELS, F.col("tokens").alias("n_tokens"), "n_epochs")
