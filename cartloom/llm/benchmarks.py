"""Benchmark decontamination: winnowed fingerprints meet, and hits are extended to whole windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.llm.common import LOWER, UPPER, durable, fresh, lower_ascii, query, table
from cartloom.llm.simhash import text_mark

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A window, the words of one hash, and the hashes of which the smallest is kept: any
#: span of WINDOW words holds WINDOW - GRAM + 1 hashes, so one of its own is kept.
WINDOW, GRAM = 10, 5
KEPT_OF = WINDOW - GRAM + 1


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(lower_ascii(text), F.lit(WORDS), 0), F.array().cast("array<string>"))


def _padded(words: Column, blank: str) -> Column:
    """WINDOW - 1 blanks on both sides, so that every context has its full length."""
    edge = F.array_repeat(F.lit(blank), WINDOW - 1)
    return F.concat(edge, words, edge)


def fingerprints(rows: DataFrame, keys: list[str], blank: str) -> DataFrame:
    """Winnowed fingerprints of ``words``: ``keys, print, at, context``.

    Of every KEPT_OF neighbouring hashes of GRAM words the smallest is kept, the last of
    equal ones. The low three bits of a hash carry its distance from the window's end, so
    the choice depends on the window's words alone, wherever it stands, and a kept
    position follows from its value. ``context`` are the words of all windows that hold
    the gram at position ``at``; beyond the text they are ``blank``.
    """
    padded = rows.select(*keys, _padded(F.col("words"), blank).alias("p"))
    side = WINDOW - 1
    n = F.size("p") - 2 * side
    gram = lambda i: F.xxhash64(*[F.get("p", i + side + k) for k in range(GRAM)])
    cleared = lambda i: gram(i).bitwiseAND(F.lit(~7))
    hashed = padded.select(*keys, "p", F.when(n >= WINDOW, F.transform(F.sequence(F.lit(0), n - GRAM), cleared)).alias("h"))
    marked = lambda i: [F.get("h", i + k).bitwiseOR(F.lit(KEPT_OF - 1 - k).cast("long")) for k in range(KEPT_OF)]
    lows = F.when(F.col("h").isNotNull(), F.transform(F.sequence(F.lit(0), F.size("h") - KEPT_OF), lambda i: F.least(*marked(i))))
    low = hashed.select(*keys, "p", lows.alias("m"))
    # the outer form, because for the plain one the planner infers a filter that repeats all work above
    each = low.select(*keys, "p", "m", F.posexplode_outer("m").alias("i", "low")).where("i IS NOT NULL")
    # a gram kept by the window before as well is one further from the end there
    first = each.where((F.col("i") == 0) | (F.col("low") != F.get("m", F.col("i") - 1) + 1))
    at = F.col("i") + (KEPT_OF - 1) - F.col("low").bitwiseAND(F.lit(7)).cast("int")
    reach = WINDOW - GRAM
    context = F.slice("p", at + side - reach + 1, GRAM + 2 * reach)
    return first.select(*keys, F.shiftright("low", 3).alias("print"), at.alias("at"), context.alias("context"))


def short_grams(rows: DataFrame, keys: list[str], sizes: list[int]) -> DataFrame:
    """All runs of as many words as a short item has: ``keys, print, at, size, context``."""
    places = F.when(F.size("words") > 0, F.sequence(F.lit(0), F.size("words") - 1))
    at = rows.select(*keys, "words", F.explode_outer(places).alias("at")).where("at IS NOT NULL")
    runs = F.array(*[F.struct(F.lit(s).alias("size"), F.slice("words", F.col("at") + 1, s).alias("context")) for s in sizes])
    out = at.select(*keys, "at", F.inline(runs)).where("size(context) = size")
    return out.select(*keys, F.xxhash64("context").alias("print"), "at", "size", "context")


def occurrences(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, mark, item_id, start, size``: item windows found in documents.

    Both inputs have ``words``. Item fingerprints are stored, and Spark broadcasts them
    where their size on disk is below its threshold, else joins by shuffle. A pair of
    equal fingerprints is extended word by word to the windows that hold it.
    """
    ours = durable(fingerprints(items, ["item_id"], "\x01").select("item_id", "print", F.col("context").alias("item_context")).distinct())
    met = fingerprints(docs, ["doc_id", "mark"], "").join(ours, "print")
    starts = F.filter(
        F.sequence(F.lit(0), F.lit(WINDOW - GRAM)),
        lambda d: F.slice("context", d + 1, WINDOW) == F.slice("item_context", d + 1, WINDOW),
    )
    found = met.select("doc_id", "mark", "item_id", F.explode(starts).alias("d"), "at")
    found = found.select("doc_id", "mark", "item_id", (F.col("at") - (WINDOW - GRAM) + F.col("d")).alias("start"), F.lit(WINDOW).alias("size"))
    few = items.where(F.size("words").between(1, WINDOW - 1))
    sizes = [r[0] for r in few.select(F.size("words")).distinct().collect()]  # at most nine numbers
    if not sizes:
        return found
    short = durable(few.select("item_id", F.xxhash64("words").alias("print"), F.col("words").alias("item_words")).distinct())
    grams = short_grams(docs, ["doc_id", "mark"], sorted(sizes)).join(short, "print").where("context = item_words")
    return found.unionByName(grams.select("doc_id", "mark", "item_id", F.col("at").alias("start"), "size"))


def contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``doc_id, mark, n_hit, items`` for every document that holds a window of an item.

    A window is WINDOW consecutive words of an item, or all words of a shorter one;
    ``n_hit`` counts the document's words inside any occurrence, ``items`` are the
    sorted item ids as text. ``mark`` is a hash of the text, so that rows that share a
    doc_id (or have none) are told apart; equal rows share one result.

    NULL and empty texts have no words and match nothing; items without id count for
    hits and are not listed; repeated items are one; empty tables give no rows.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_mark(docs, text).alias("mark"), words_of(F.col(text)).alias("words"))
    items = benchmark.select(F.col(item_id).cast("string").alias("item_id"), words_of(F.col(item_text)).alias("words"))
    met = occurrences(rows, items)
    spans = met.groupBy("doc_id", "mark").agg(F.collect_set(F.struct("start", "size")).alias("spans"), F.sort_array(F.collect_set("item_id")).alias("items"))
    covered = F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["size"] - 1))))
    return spans.select("doc_id", "mark", F.size(covered).cast("long").alias("n_hit"), "items")


def decontaminate(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the documents that hold a benchmark window; other rows stay as they are."""
    row_id, mark = fresh(docs, "_row_id", "_mark")
    bad = contamination(docs, benchmark, doc_id, text).select(F.col("doc_id").alias(row_id), F.col("mark").alias(mark))
    return docs.join(bad, docs[doc_id].eqNullSafe(F.col(row_id)) & (text_mark(docs, text) == F.col(mark)), "left_anti")


SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORDS}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORDS}') AS w FROM benchmark),
sized AS (SELECT item_id, w, least(len(w), {WINDOW}) AS size FROM b WHERE len(w) > 0),
bw AS (
  SELECT DISTINCT item_id, size, unnest(list_transform(range(1, len(w) - size + 2), lambda s: array_to_string(list_slice(w, s, s + size - 1), ' '))) AS gram FROM sized),
dw AS (
  SELECT doc_id, size, unnest(range(1, len(w) - size + 2)) AS s,
    unnest(list_transform(range(1, len(w) - size + 2), lambda s: array_to_string(list_slice(w, s, s + size - 1), ' '))) AS gram
  FROM d, (SELECT DISTINCT size FROM sized) WHERE len(w) >= size),
hit AS (SELECT dw.doc_id, dw.s, dw.size, bw.item_id FROM dw JOIN bw ON dw.size = bw.size AND dw.gram = bw.gram),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + size)) AS p FROM hit) GROUP BY 1),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY 1)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op7_decontaminate", SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and items hit in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination(docs, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), "n_hit", "items")
    n_words = F.coalesce(F.regexp_count("text", F.lit(WORDS.replace(r"\x3A-\x60", r"\x3A-\x40\x5B-\x60"))).cast("long"), F.lit(0).cast("long"))
    rows = docs.select("doc_id", text_mark(docs).alias("mark"), n_words.alias("n_words"))
    out = rows.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")).cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
