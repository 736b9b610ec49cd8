"""A stored table with some rows changed or left out: a new table, for the next commit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def updated(table: DataFrame, where: Column, values: dict[str, Column]) -> DataFrame:
    """The rows that fit have new values, of the types that the columns have; a condition that is null fits none."""
    fits = F.coalesce(where, F.lit(False))
    return table.select(*[F.when(fits, values[f.name].cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name) if f.name in values else F.col(f.name) for f in table.schema])


def deleted(table: DataFrame, where: Column) -> DataFrame:
    """The rows that don't fit; a condition that is null fits none."""
    return table.where(~F.coalesce(where, F.lit(False)))


def resolve_others(errors: DataFrame, but: Column, run_ts: Column) -> DataFrame:
    """All open errors but some are resolved; a time of resolution that is there stays."""
    hit = (F.col("status") == "OPEN") & ~F.coalesce(but, F.lit(False))
    return updated(errors, hit, {"status": F.lit("RESOLVED"), "resolved_at": F.coalesce("resolved_at", run_ts)})


def row_changes(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that two states of a table don't share, by change: INSERTED and UPDATED as they are after, DELETED as they were before.

    keys name one row in each state (a null key is a key); the states have the same columns. Rows that are equal in all
    columns, nulls included, are left out.
    """
    rest = [c for c in after.columns if c not in keys]
    own = lambda df, name: df.select(*keys, F.struct(F.lit(True).alias("there"), *rest).alias(name))
    a, b = own(before, "was"), own(after, "now")
    same_key = F.lit(True)
    for k in keys:
        same_key &= a[k].eqNullSafe(b[k])
    both = a.join(b, same_key, "full_outer")
    change = F.when(F.col("was").isNull(), "INSERTED").when(F.col("now").isNull(), "DELETED").otherwise("UPDATED")
    pick = lambda c: F.when(F.col("now").isNull(), F.col("was")[c]).otherwise(F.col("now")[c]).alias(c)
    key = lambda k: F.when(F.col("now").isNull(), a[k]).otherwise(b[k]).alias(k)
    return both.where(~F.col("was").eqNullSafe(F.col("now"))).select(*(key(k) for k in keys), change.alias("change"), *(pick(c) for c in rest))
