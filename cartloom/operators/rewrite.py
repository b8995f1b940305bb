"""Row changes as new table versions.

Each function returns the next version of a table; the caller writes it to a new
place and switches readers over, never onto the files being read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from cartloom.operators.groups import attach
from cartloom.session import durable


def insert_rows(target: DataFrame, new: DataFrame) -> DataFrame:
    """Append by column name; columns the new rows lack become NULL."""
    extra = [c for c in new.columns if c not in target.columns]
    if extra:
        raise ValueError(f"target has no columns {extra}")
    return target.unionByName(new, allowMissingColumns=True).select(*target.columns)


def update_where(
    df: DataFrame, test: Column, sets: dict[str, Column], touched: Observation | None = None
) -> DataFrame:
    """Set columns where ``test`` holds; a NULL test is not a match.

    ``touched`` receives the number of changed rows while the result is computed.
    """
    hit = F.coalesce(test, F.lit(False))
    changed = df.withColumn("_hit", hit)
    if touched is not None:
        changed = changed.observe(touched, F.count_if("_hit").alias("rows_updated"))
    new = {c: F.when(F.col("_hit"), v).otherwise(F.col(c)) for c, v in sets.items()}
    return changed.withColumns(new).drop("_hit")


def update_matching(
    df: DataFrame, members: DataFrame, key: str, row_id: str, sets: dict[str, Column], hot_rows: int | None = None
) -> DataFrame:
    """Set columns of rows whose ``key`` is among ``members``."""
    wanted = members.select(key).distinct().withColumn("_hit", F.lit(True))
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).join(wanted, key)
    marked = attach(df, sizes, [key], "_n", [row_id], hot_rows, how="left").drop("_n")
    return update_where(marked, F.col("_hit"), sets).select(*df.columns)


def delete_where(df: DataFrame, test: Column) -> DataFrame:
    """Rows for which ``test`` is not true, NULL included."""
    return df.filter(~F.coalesce(test, F.lit(False)))


@dataclass(frozen=True)
class Clause:
    """One WHEN branch of a merge; columns are written ``t.x`` and ``s.x``."""

    action: str  # insert, update, delete
    when: Column | None = None
    sets: dict[str, Column] = field(default_factory=dict)


def once_per_key(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``source`` unchanged, failing when a key occurs twice.

    The check rides on the grouping by key that the merge needs anyway.
    """
    rest = [c for c in source.columns if c not in keys]
    g = source.groupBy(*keys).agg(
        F.any_value(F.struct(*rest) if rest else F.lit(1)).alias("_row"), F.count(F.lit(1)).alias("_n")
    )
    g = g.filter(F.assert_true(F.col("_n") == 1, F.lit("merge source holds a key more than once")).isNull())
    return g.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*source.columns)


def merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    matched: Sequence[Clause] = (),
    not_matched: Sequence[Clause] = (),
    not_matched_by_source: Sequence[Clause] = (),
    keep_action: bool = False,
    unique: bool = False,
) -> DataFrame:
    """The target after a merge; the first clause that applies to a row wins.

    Keys are unique on both sides, so the full join deals every key to one place.
    ``unique`` says that the source's keys are so by construction and need no check.
    With ``keep_action`` deleted rows stay, and ``_action`` tells what happened.
    """
    t = target.withColumn("_in_t", F.lit(True)).alias("t")
    s = (source if unique else once_per_key(source, keys)).withColumn("_in_s", F.lit(True)).alias("s")
    on = F.lit(True)
    for k in keys:
        on = on & (F.col(f"t.{k}") == F.col(f"s.{k}"))
    both = t.join(s, on, "full")

    in_t, in_s = F.col("t._in_t").isNotNull(), F.col("s._in_s").isNotNull()
    branches: list[tuple[Column, Clause]] = []
    for place, clauses in ((in_t & in_s, matched), (~in_t, not_matched), (~in_s, not_matched_by_source)):
        for c in clauses:
            test = place if c.when is None else place & F.coalesce(c.when, F.lit(False))
            branches.append((test, c))

    def choose(pick, default: Column) -> Column:
        out = default
        for test, clause in reversed(branches):
            out = F.when(test, pick(clause)).otherwise(out)
        return out

    action = choose(lambda c: F.lit(c.action), F.when(in_t, "keep").otherwise("skip"))
    columns = [
        choose(
            lambda c, name=name: c.sets.get(name, F.col(f"s.{name}") if name in keys and c.action == "insert" else
                                            (F.lit(None) if c.action == "insert" else F.col(f"t.{name}"))),
            F.col(f"t.{name}"),
        ).cast(target.schema[name].dataType).alias(name)
        for name in target.columns
    ]
    result = both.select(*columns, action.alias("_action")).filter(F.col("_action") != "skip")
    if keep_action:
        return result
    return result.filter(F.col("_action") != "delete").drop("_action")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], keep_action: bool = False) -> DataFrame:
    """Update the columns the source brings, insert keys the target lacks."""
    values = {c: F.col(f"s.{c}") for c in source.columns if c not in keys}
    return merge(
        target, source, keys, [Clause("update", sets=values)], [Clause("insert", sets=values)], keep_action=keep_action
    )


def audited_publish(new: DataFrame, touched: Column, low: int, high: int, path: str) -> tuple[bool, int]:
    """Write, audit, publish: ``new`` reaches ``path`` only when the number of rows
    for which ``touched`` holds lies within bounds.  Returns (published, touched)."""
    staged = durable(new.withColumn("_touched", F.coalesce(touched, F.lit(False))))
    n = staged.filter("_touched").count()
    if not low <= n <= high:
        return False, n
    staged.drop("_touched").write.mode("errorifexists").parquet(path)
    return True, n
