"""Chat formatting in budgeted, turn-aligned windows with a loss mask, in SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartloom.llm.common import query, table

START, SEP, END = "<|turn_start|>", "<|turn_sep|>", "<|turn_end|>"
#: Strings that may not stand inside a role or text as they are.
CONTROL = [START, SEP, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]

MAX_TOKENS = 2048
HISTORY_TOKENS = 256
HISTORY_TURNS = 2
#: A token is a run of letters, digits and characters beyond ASCII, or one ASCII mark.
TOKEN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]"
TURN_OVERHEAD = 4


def escape(text: Column) -> Column:
    """Double every backslash, then break each control string by one after its first character."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for s in CONTROL:
        out = F.replace(out, F.lit(s), F.lit(s[0] + "\\" + s[1:]))
    return out


def unescape(text: Column) -> Column:
    """Inverse of ``escape``: a backslash goes, what follows it stays."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def count_tokens(text: Column) -> Column:
    return F.regexp_count(text, F.lit(TOKEN)).cast("long") + TURN_OVERHEAD


def format_windows(
    turns: DataFrame,
    max_tokens: int = MAX_TOKENS,
    history_turns: int = HISTORY_TURNS,
    history_tokens: int = HISTORY_TOKENS,
    tokens=count_tokens,
) -> DataFrame:
    """One row per window: ``conv_id, window, formatted, loss, n_context, n_new, n_tokens``.

    ``turns`` has ``conv_id, turn, role, text``. Prefix sums of turn tokens, laid on a
    grid of the free budget, cut a conversation into spans of whole turns: the turns
    inside one grid cell form a window, a turn across a grid line is a window alone.
    A leading system turn is kept in every window. A window repeats up to
    ``history_turns`` turns before it, together at most ``history_tokens``; repeated
    turns are context without loss, so each assistant text is a target once. A window
    exceeds ``max_tokens`` only where its system turn and one new turn do. ``loss``
    lists (start, size) in code points, ``n_context`` the leading turns that other
    windows hold as new.

    NULL roles and texts are empty; a NULL turn sorts first; rows of equal turn are
    ordered by role and text and all kept; a NULL conv_id is one conversation; no rows
    give no windows; further columns are ignored.
    """
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumns({"role_out": escape(F.col("role")), "text_out": escape(F.col("text")), "cost": tokens(F.col("text"))})
    conv = Window.partitionBy("conv_id")
    seq = conv.orderBy("turn", "role", "text")
    rows = rows.withColumn("pos", F.row_number().over(seq))
    system = (F.col("pos") == 1) & (F.col("role") == "system")
    rows = rows.withColumn("system", system)
    rows = rows.withColumn("held", F.first(F.when(F.col("system"), F.col("cost")).otherwise(F.lit(0))).over(seq))
    paid = F.when(F.col("system"), F.lit(0)).otherwise(F.col("cost"))
    rows = rows.withColumn("after", F.sum(paid).over(seq)).withColumn("before", F.col("after") - paid)
    room = F.greatest(F.lit(1), F.lit(max_tokens - history_tokens) - F.col("held"))
    last = F.greatest("before", F.col("after") - 1)
    cell = F.struct(F.floor(F.col("before") / room).alias("a"), F.floor(last / room).alias("b"))
    rows = rows.withColumn("cell", F.when(~F.col("system"), cell))
    opens = ~F.col("system") & F.coalesce(F.lag("cell").over(seq) != F.col("cell"), F.lit(False))
    rows = rows.withColumn("opens", opens).withColumn("window", 1 + F.sum(F.col("opens").cast("int")).over(seq))
    rows = rows.withColumn("windows", F.max("window").over(conv))
    ahead = F.collect_list(F.when(F.col("opens"), F.struct("window", "before"))).over(seq.rowsBetween(1, history_turns)) if history_turns else F.array()
    rows = rows.withColumn("ahead", ahead)
    near = F.transform(F.filter("ahead", lambda x: x["before"] - F.col("before") <= history_tokens), lambda x: x["window"])
    later = F.when(F.col("system"), F.sequence(F.lit(1), F.col("windows"))).otherwise(F.concat(F.array("window"), near))
    placed = rows.select("*", F.explode(later).alias("at"))
    head = F.concat(F.lit(START), F.col("role_out"), F.lit(SEP))
    member = F.struct(
        "pos",
        (F.col("at") == F.col("window")).alias("new"),
        F.concat(head, F.col("text_out"), F.lit(END + "\n")).alias("piece"),
        F.length(head).alias("lead"),
        F.length("text_out").alias("size"),
        (F.col("role") == "assistant").alias("target"),
        "cost",
    )
    packed = placed.groupBy("conv_id", F.col("at").alias("window")).agg(F.sort_array(F.collect_list(member)).alias("m"))
    zero = F.struct(F.lit(1).alias("at"), F.array().cast("array<struct<start:int,size:int>>").alias("spans"))

    def step(s, x):
        span = F.struct((s["at"] + x["lead"]).alias("start"), x["size"].alias("size"))
        spans = F.when(x["new"] & x["target"], F.concat(s["spans"], F.array(span))).otherwise(s["spans"])
        return F.struct((s["at"] + F.length(x["piece"])).alias("at"), spans.alias("spans"))

    return packed.select(
        "conv_id",
        "window",
        F.array_join(F.transform("m", lambda x: x["piece"]), "").alias("formatted"),
        F.aggregate("m", zero, step)["spans"].alias("loss"),
        F.size(F.filter("m", lambda x: ~x["new"])).alias("n_context"),
        F.size(F.filter("m", lambda x: x["new"])).alias("n_new"),
        F.aggregate("m", F.lit(0).cast("long"), lambda s, x: s + x["cost"]).alias("n_tokens"),
    )


def read_back(windows: DataFrame) -> DataFrame:
    """Parse formatted windows: ``conv_id, window, turns`` (new turns, unescaped) and ``loss_text``."""
    pieces = F.slice(F.split("formatted", r"<\|turn_end\|>\n"), F.col("n_context") + 1, F.col("n_new"))

    def parse(p):
        body = F.substring(p, len(START) + 1, 2**31 - 1)
        text = F.substr(body, F.locate(SEP, body) + F.lit(len(SEP)), F.length(body))
        return F.struct(unescape(F.substring_index(body, SEP, 1)).alias("role"), unescape(text).alias("text"))

    masked = F.transform("loss", lambda s: unescape(F.substr("formatted", s["start"], s["size"])))
    return windows.select(
        "conv_id", "window", F.transform(pieces, parse).alias("turns"), F.array_join(masked, "").alias("loss_text"), "formatted"
    )


def digests(windows: DataFrame) -> DataFrame:
    """Digest columns per conversation, from the formatted windows alone."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    part = F.struct("window", said.alias("said"), "loss_text", F.size("turns").alias("n"), F.length("formatted").alias("chars"))
    whole = read_back(windows).groupBy("conv_id").agg(F.sort_array(F.collect_list(part)).alias("w"), F.sum(F.length("formatted")).alias("chars"), F.sum(F.size("turns")).alias("n"))
    said, loss = F.array_join("w.said", ""), F.array_join("w.loss_text", "")
    return whole.select(
        "conv_id",
        F.col("n").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.col("chars").cast("long").alias("formatted_chars"),
    )


PROBE = "</s>[INST] ok [/INST]"


def _esc_sql(c: str) -> str:
    out = rf"replace({c}, '\', '\\')"
    for s in CONTROL:
        out = f"replace({out}, '{s}', '{s[0]}\\{s[1:]}')"
    return out


SQL = rf"""
WITH src AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{PROBE}' UNION ALL SELECT -7, 1, 'assistant', '{PROBE}'),
t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
    len(regexp_extract_all(coalesce(text, ''), '{TOKEN}')) + {TURN_OVERHEAD} AS cost FROM src),
p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM t),
s AS (SELECT *, pos = 1 AND role = 'system' AS sys,
    {len(START) + len(SEP) + len(END) + 1} + length({_esc_sql('role')}) + length({_esc_sql('text')}) AS chars FROM p),
b AS (
  SELECT *, sum(CASE WHEN sys THEN 0 ELSE cost END) OVER w AS after,
    first_value(CASE WHEN sys THEN cost ELSE 0 END) OVER w AS held
  FROM s WINDOW w AS (PARTITION BY conv_id ORDER BY pos)),
c AS (
  SELECT *, after - CASE WHEN sys THEN 0 ELSE cost END AS before, greatest(1, {MAX_TOKENS - HISTORY_TOKENS} - held) AS room FROM b),
d AS (
  SELECT *, CASE WHEN sys THEN NULL ELSE before // room END AS a, CASE WHEN sys THEN NULL ELSE greatest(before, after - 1) // room END AS z FROM c),
e AS (
  SELECT *, coalesce((lag(a) OVER w, lag(z) OVER w) <> (a, z) AND lag(a) OVER w IS NOT NULL, false) AND NOT sys AS opens
  FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY pos)),
f AS (SELECT *, count(*) FILTER (WHERE opens) OVER (PARTITION BY conv_id) AS extra FROM e),
ctx AS (
  SELECT o.conv_id, sum(h.chars) AS chars FROM e o JOIN e h ON h.conv_id IS NOT DISTINCT FROM o.conv_id
  WHERE o.opens AND NOT h.sys AND h.pos < o.pos AND h.pos >= o.pos - {HISTORY_TURNS} AND o.before - h.before <= {HISTORY_TOKENS} GROUP BY 1),
g AS (
  SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    sum(chars * CASE WHEN sys THEN 1 + extra ELSE 1 END) AS chars
  FROM f GROUP BY conv_id)
SELECT g.conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, (g.chars + coalesce(ctx.chars, 0))::BIGINT AS formatted_chars
FROM g LEFT JOIN ctx ON g.conv_id IS NOT DISTINCT FROM ctx.conv_id
"""


@query("op3_chat_format", SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all conversations and one with control strings, read back from the windows."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = [F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(k).cast("long").alias("turn"), F.lit(r).alias("role"), F.lit(PROBE).alias("text")) for k, r in enumerate(("user", "assistant"))]
    return digests(format_windows(turns.unionByName(spark.range(1).select(F.inline(F.array(*rows))))))
