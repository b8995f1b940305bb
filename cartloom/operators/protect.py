"""Column masks, row filters and protected results.

Who looks is known before the query is planned, so a mask is an ordinary column
expression and a row filter an ordinary join; nothing is decided per row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HIDDEN = "***MASKED***"


def full(c: Column) -> Column:
    return F.when(c.isNotNull(), F.lit(HIDDEN))


def last_four(c: Column) -> Column:
    return F.concat(F.lit("***-***-"), F.right(c, F.lit(4)))


def first_letter(c: Column) -> Column:
    """First letter, a star for each further one."""
    return F.concat(F.left(c, F.lit(1)), F.repeat(F.lit("*"), F.greatest(F.length(c) - 1, F.lit(0))))


def short_email(c: Column) -> Column:
    """Two letters of the local part and the domain; without an ``@``, all hidden."""
    return F.when(c.contains("@"), F.concat(F.left(c, F.lit(2)), F.lit("***@"), F.substring_index(c, "@", -1))).otherwise(
        full(c)
    )


MASKS: Mapping[str, Callable[[Column], Column]] = {
    "full": full,
    "last_four": last_four,
    "first_letter": first_letter,
    "short_email": short_email,
}


def held_roles(role: str, inherits: Mapping[str, Iterable[str]]) -> set[str]:
    """A role and all roles it inherits, directly or not."""
    held, todo = set(), [role]
    while todo:
        r = todo.pop()
        if r not in held:
            held.add(r)
            todo.extend(inherits.get(r, ()))
    return held


def mask_columns(df: DataFrame, rules: Mapping[str, str], roles: set[str], cleared: set[str]) -> DataFrame:
    """Mask ``rules`` (column -> mask) unless one of ``roles`` is cleared."""
    if roles & cleared:
        return df
    return df.withColumns({c: MASKS[mask](F.col(c)) for c, mask in rules.items() if c in df.columns})


def mask_by_tag(
    df: DataFrame, tags: Mapping[str, str], policies: Mapping[tuple[str, str], str], roles: set[str], cleared: set[str]
) -> DataFrame:
    """Mask by tag: ``tags`` names the tag of a column, ``policies`` the mask for a
    (tag, type).  A tagged column of a type without a policy is removed."""
    if roles & cleared:
        return df
    masks = {c: policies.get((tags[c], kind)) for c, kind in df.dtypes if c in tags}
    rules = {c: mask for c, mask in masks.items() if mask}
    return mask_columns(df, rules, roles, cleared).drop(*[c for c in masks if c not in rules])


def row_filter(df: DataFrame, access: DataFrame, column: str, roles: set[str], sees_all: set[str]) -> DataFrame:
    """Rows whose ``column`` the access map (role, value) opens to one of ``roles``."""
    if roles & sees_all:
        return df
    open_to = access.filter(F.col("role").isin(sorted(roles))).select(F.col("value").alias(column)).distinct()
    return df.join(open_to, column, "left_semi").select(*df.columns)


def overlap_counts(a: DataFrame, b: DataFrame, key: str, group: str, least: int) -> DataFrame:
    """Members both parties know, per group; groups below ``least`` are withheld.

    Only digests of keys meet; each side is reduced to distinct digests first.
    """
    digest = F.sha2(F.col(key).cast("string"), 256).alias("_digest")
    left = a.select(digest, group).distinct()
    right = b.select(digest).distinct()
    return left.join(right, "_digest").groupBy(group).agg(F.count(F.lit(1)).alias("members")).filter(
        F.col("members") >= least
    )


def noisy_counts(df: DataFrame, group: str, epsilon: float, seed: int) -> DataFrame:
    """Group counts with Laplace noise of scale 1 / epsilon."""
    u = F.rand(seed) - 0.5
    counts = df.groupBy(group).agg(F.count(F.lit(1)).alias("_n")).withColumn("_u", u)
    noise = -F.signum("_u") * F.log(1 - 2 * F.abs("_u")) / epsilon
    return counts.select(group, (F.col("_n") + noise).alias("noisy_count"))
