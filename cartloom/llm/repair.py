"""Conversation structure repair: weighted CYK parsing of turns with a grammar of edits."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartloom.llm.common import attach, durable, query, same, table
from cartloom.operators.groups import Neighbour, Order, Position, in_order

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
BLANK = r"[\x20\x09-\x0D]"
#: Turns of one conversation that one step combines; longer ones are combined level by level.
SPAN = 64

# States of the wanted order of roles, (s?(ua)+)?: nothing said yet, a system turn, a user turn, an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
#: Which turn may follow: role initial -> (state before, state after).
MOVES = {"s": [(START, SYSTEM)], "u": [(START, USER), (SYSTEM, USER), (ASSISTANT, USER)], "a": [(USER, ASSISTANT)]}

#: A cell: by (state before, state after) the cheapest edits of a span as (cost, audit).
Cell = dict[tuple[int, int], tuple[int, str]]


def combine(left: Cell, right: Cell) -> Cell:
    """The binary rules ``(p, q) -> (p, r) (r, q)``: the cell of two spans that meet.

    Two different audits of one span, pair of states and cost are never one the
    beginning of the other (it would lack insertions, which cost), so the least
    audit of a whole is made of least audits of its parts.
    """
    out: Cell = {}
    for (p, r), (cost, audit) in left.items():
        for q in STATES:
            if (r, q) in right:
                more, rest = right[r, q]
                found = (cost + more, audit + rest)
                if (p, q) not in out or found < out[p, q]:
                    out[p, q] = found
    return out


def _insertions() -> Cell:
    """Closure of the empty rules: the cheapest insertions from state to state."""
    out: Cell = {(p, p): (0, "") for p in STATES}
    step: Cell = out | {move: (INSERT, "I") for r in ("u", "a") for move in MOVES[r]}
    while (more := combine(out, step)) != out:
        out = more
    return out


CLOSURE = _insertions()


@lru_cache(maxsize=None)
def turn_cell(initial: str, fault: int) -> Cell:
    """The lexical rules: one turn, kept, reroled or deleted, between any insertions.

    ``initial`` is s, u, a or anything else; ``fault`` is 0 for none, 1 for a turn that
    must go, 2 for one that may stay at a price.
    """
    edits: Cell = {(p, p): (DELETE, "D") for p in STATES}
    if fault != 1:
        price = TRUNCATED if fault == 2 else 0
        for role, moves in MOVES.items():
            for move in moves:
                # keep is cheaper than rerole
                if role == initial:
                    edits[move] = (KEEP + price, "K")
                elif role != "s":
                    edits[move] = (REROLE + price, "R")
    return combine(combine(CLOSURE, edits), CLOSURE)


def parse(cells: list[Cell]) -> Cell:
    """The cell of a whole span, from those of its parts, by growing span length.

    The nonterminals are pairs of states, so a derivation of a span can be cut at every
    place inside it, and each cut gives the same minimum. One cut a span is therefore
    enough, and spans of 1, 2, 4, ... parts suffice.
    """
    while len(cells) > 1:
        cells = [combine(*cells[k : k + 2]) if k + 1 < len(cells) else cells[k] for k in range(0, len(cells), 2)]
    return cells[0]


@lru_cache(maxsize=1 << 14)
def _parse_codes(codes: bytes) -> Cell:
    return parse([turn_cell("sua?"[c >> 2], c & 3) for c in codes])


def _list_of(**fields: T.DataType) -> T.ArrayType:
    return T.ArrayType(T.StructType([T.StructField(n, t) for n, t in fields.items()]))


CELLS = _list_of(p=T.IntegerType(), q=T.IntegerType(), cost=T.LongType(), audit=T.StringType())


def _pack(cell: Cell) -> list[dict]:
    return [{"p": p, "q": q, "cost": cost, "audit": audit} for (p, q), (cost, audit) in cell.items()]


def _unpack(rows: list[dict]) -> Cell:
    return {(r["p"], r["q"]): (r["cost"], r["audit"]) for r in rows}


ARROW_CELLS = pa.list_(pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))


@F.arrow_udf(CELLS)
def _cells_of_turns(spans: pa.Array) -> pa.Array:
    return pa.array([_pack(_parse_codes(bytes(codes))) for codes in spans.to_pylist()], ARROW_CELLS)


@F.arrow_udf(CELLS)
def _cells_of_spans(spans: pa.Array) -> pa.Array:
    return pa.array([_pack(parse([_unpack(c) for c in cells])) for cells in spans.to_pylist()], ARROW_CELLS)


def damage(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` of ``turns`` with the faults that a hash of id and turn calls for.

    Of twenty: 0 drops the turn, 1 empties its text, 2 takes its sentence ends, 3 says it
    twice, 4 gives it to the user. NULL roles and texts, and NULLs in the hash, are one space.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    rows = turns.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("copy")).drop("copy")


def ordered(turns: DataFrame) -> DataFrame:
    """Stored turns in order: ``conv_id, pos, turn, role, text``, a digest, and what stands before each.

    A conversation is ordered by turn, NULL first; equal turns by role, then text. Very
    long conversations are ordered in pieces (``groups.in_order``).
    """
    said = F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text").cast("binary"), 256)
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    rows = rows.select("*", F.substring("role", 1, 1).alias("initial"), F.unhex(said).alias("said"), F.col("turn").isNotNull().alias("timed"), F.monotonically_increasing_id().alias("each"))
    order = [Order("timed"), Order("turn"), Order("role"), Order("text"), Order("each")]
    found = [Position("pos"), Neighbour("turn_before", "turn"), Neighbour("initial_before", "initial")]
    return durable(in_order(rows, ["conv_id"], order, found).drop("timed", "each"))


def faults(rows: DataFrame) -> DataFrame:
    """``conv_id, pos, turn, code`` and 0/1 columns for the faults of stored ``ordered`` turns.

    The first that holds counts: blank (no character but white space), duplicate (role
    and text said before in the conversation), truncated (no sentence end at the end).
    Only digests of turns that occur twice are joined back, however often.
    """
    first = rows.groupBy("conv_id", "said").agg(F.min("pos").alias("first"), F.count("*").alias("n")).where("n > 1")
    empty = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    open_end = ~F.col("text").rlike(rf"[.!?]{BLANK}*\z")
    pair = F.concat("initial_before", "initial")
    narrow = rows.select(
        "conv_id",
        "pos",
        "turn",
        "said",
        "initial",
        empty.alias("blank"),
        open_end.alias("open_end"),
        F.coalesce(~pair.isin("su", "ua", "au"), F.lit(False)).alias("illegal"),
        (F.col("turn").isNotNull() & ~F.col("turn").eqNullSafe(F.col("turn_before"))).alias("new_turn"),
    )
    marked = attach(narrow, durable(first), ["conv_id", "said"], "n", how="left")
    duplicate = ~F.col("blank") & F.coalesce(F.col("pos") > F.col("first"), F.lit(False))
    marked = marked.withColumn("duplicate", duplicate)
    marked = marked.withColumn("truncated", F.col("open_end") & ~F.col("blank") & ~F.col("duplicate"))
    fault = F.when(F.col("blank") | F.col("duplicate"), 1).when(F.col("truncated"), 2).otherwise(0)
    role = F.when(F.col("initial") == "s", 0).when(F.col("initial") == "u", 1).when(F.col("initial") == "a", 2).otherwise(3)
    flags = [F.col(c).cast("long").alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "new_turn")]
    return marked.select("conv_id", "pos", "turn", (role * 4 + fault).cast("int").alias("code"), *flags)


def cheapest(found: DataFrame, span: int = SPAN) -> DataFrame:
    """One row per conversation of ``faults``: fault counts, ``gaps``, ``cost`` and ``audit``.

    Spans of ``span`` turns are parsed where they meet, then spans of spans, until one
    is left; no step holds more than ``span`` parts, so a conversation of any length is
    spread over many tasks until its last, short level.
    """
    sums = ["blank", "duplicate", "truncated", "illegal", "new_turn"]
    place = F.floor((F.col("pos") - 1) / span)
    codes = F.transform(F.sort_array(F.collect_list(F.struct("pos", "code"))), lambda x: x["code"])
    stats = [*[F.sum(c).alias(c) for c in sums], F.min("turn").alias("low"), F.max("turn").alias("high")]
    level = found.groupBy("conv_id", place.alias("at")).agg(codes.alias("codes"), *stats)
    level = level.select("conv_id", "at", _cells_of_turns("codes").alias("cells"), *sums, "low", "high")
    stats = [*stats[:-2], F.min("low").alias("low"), F.max("high").alias("high")]
    longest = found.agg(F.max("pos")).first()[0] or 0
    while longest > span:
        longest = -(-longest // span)
        parts = F.transform(F.sort_array(F.collect_list(F.struct("at", "cells"))), lambda x: x["cells"])
        level = level.groupBy("conv_id", F.floor(F.col("at") / span).alias("at")).agg(parts.alias("parts"), *stats)
        level = level.select("conv_id", "at", _cells_of_spans("parts").alias("cells"), *sums, "low", "high")
    done = F.filter("cells", lambda c: (c["p"] == START) & c["q"].isin(START, ASSISTANT))
    best = F.array_min(F.transform(done, lambda c: F.struct(c["cost"], c["audit"])))
    gaps = F.coalesce((F.col("high") - F.col("low") + 1).cast("long") - F.col("new_turn"), F.lit(0).cast("long"))
    return level.select("conv_id", gaps.alias("gaps"), *sums[:-1], best["cost"].alias("cost"), best["audit"].alias("audit"))


@F.arrow_udf(_list_of(at=T.IntegerType(), pos=T.LongType(), role=T.StringType()))
def _script(audits: pa.Array) -> pa.Array:
    """What each audit leaves: place, the turn it comes from (none if inserted), its new role (none if kept)."""
    out = []
    for audit in audits.to_pylist():
        letters = np.frombuffer(audit.encode("ascii"), np.uint8)
        stays = letters != ord("D")
        source = np.cumsum(letters != ord("I"))
        turns = int(stays.sum())
        made = []
        for at, (letter, pos) in enumerate(zip(letters[stays].tolist(), source[stays].tolist())):
            # an odd number of turns begins with a system turn, the others alternate
            role = "user" if (at + turns) % 2 == 0 else "assistant"
            made.append({"at": at, "pos": None if letter == ord("I") else pos, "role": None if letter == ord("K") else role})
        out.append(made)
    return pa.array(out, pa.list_(pa.struct([("at", pa.int32()), ("pos", pa.int64()), ("role", pa.string())])))


def apply_audits(rows: DataFrame, parsed: DataFrame) -> DataFrame:
    """``conv_id, at, role, text``: the repaired turns, from ``ordered`` turns and their audits."""
    script = parsed.select("conv_id", F.inline(_script("audit"))).select(F.col("conv_id").alias("conv_id"), "at", F.col("pos").alias("from"), F.col("role").alias("new"))
    kept = script.where(F.col("from").isNotNull()).alias("k").join(rows.select("conv_id", "pos", "role", "text").alias("r"), F.col("k.conv_id").eqNullSafe(F.col("r.conv_id")) & (F.col("from") == F.col("pos")))
    kept = kept.select("k.conv_id", "at", F.coalesce("new", "role").alias("role"), "text")
    return kept.unionByName(script.where(F.col("from").isNull()).select("conv_id", "at", F.col("new").alias("role"), F.lit("").alias("text")))


def repair(turns: DataFrame, span: int = SPAN) -> tuple[DataFrame, DataFrame]:
    """Repair conversations: (one row per conversation, the repaired turns).

    ``turns`` has ``conv_id, turn, role, text``; further columns are ignored. Edits: keep
    (0), rerole to user or assistant (1), delete (2, the only choice for blank and
    duplicate turns), insert an empty user or assistant turn anywhere (5); a truncated
    turn that is not deleted costs 5 more. The cheapest edits whose role initials read
    ``(s?(ua)+)?`` win, of equal ones the least audit (their initials in order).

    The first result has ``conv_id, gaps, blank, duplicate, truncated, illegal, cost,
    audit``, the second ``conv_id, at, role, text``. NULL roles and texts are one space; a
    NULL turn comes first and makes no gap; a NULL conv_id is one conversation; repeated
    rows are duplicates; conversations of any length are parsed whole; no rows give no
    rows.
    """
    rows = ordered(turns)
    parsed = durable(cheapest(faults(rows), span))
    return parsed, apply_audits(rows, parsed)


def digests(ids: DataFrame, parsed: DataFrame, turns: DataFrame) -> DataFrame:
    """``parsed`` for all ``ids`` with a digest of the repaired turns; an id without turns has zeros."""
    line = F.struct("at", F.concat_ws(":", "role", "text").alias("line"))
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(line)).alias("lines"))
    hashed = whole.select("conv_id", F.sha2(F.array_join("lines.line", "\n").cast("binary"), 256).alias("sha"))
    known = parsed.join(hashed, same(parsed, hashed, ["conv_id"]), "left").select(*[parsed[c] for c in parsed.columns], "sha")
    out = ids.join(known, same(ids, known, ["conv_id"]), "left")
    zero = F.lit(0).cast("long")
    counts = [F.coalesce(known[c], zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return out.select(ids["conv_id"], *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha", nothing).alias("repaired_sha256"))


@query("op13_repair")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and repaired digest of every damaged conversation."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    parsed, repaired = repair(damage(turns))
    return digests(turns.select("conv_id").distinct(), parsed, repaired)
