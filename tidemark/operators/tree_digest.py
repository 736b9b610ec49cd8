"""Order-sensitive digests of whole tables as trees over fixed ranges of a key.

A leaf is the digest of the rows whose keys fall into one range of `width` keys, in the order of keys; a node above it is the
digest of up to `fan` nodes below, in order; the root is the digest of all that is left on the last level. Ranges don't
move when rows come or go, so equal leaves are equal ranges, and no task holds more than a range or a node's children.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDTH, FAN = 1024, 64


def row_text(columns: Sequence[str]) -> Column:
    """A row's values as text, each with its length; a null differs from any text, wherever it stands."""
    value = lambda c: F.col(c).cast("string")
    return F.concat(*[F.coalesce(F.concat(F.length(value(c)).cast("string"), F.lit(":"), value(c)), F.lit("-")) for c in columns])


def _joined(nodes: DataFrame, node: Column, order: list[str], text: Column) -> DataFrame:
    items = F.array_sort(F.collect_list(F.struct(*order, text.alias("t"), "n")))
    whole = F.sha2(F.array_join(F.transform(items, lambda x: x["t"]), ","), 256)
    return nodes.groupBy(node.alias("node")).agg(F.aggregate(items, F.lit(0).cast("bigint"), lambda s, x: s + x["n"]).alias("n"), whole.alias("digest"))


def leaves(rows: DataFrame, key: str, columns: Sequence[str], width: int = WIDTH) -> DataFrame:
    """node, n and digest of each range of keys that holds rows. Rows that are equal in key and columns count as one with a number; a null key is an error."""
    own = rows.select(F.col(key).cast("bigint").alias("k"), F.sha2(row_text(columns), 256).alias("h"))
    counted = own.withColumn("k", F.when(F.col("k").isNotNull(), F.col("k")).otherwise(F.raise_error(F.lit("a row without a key")).cast("bigint"))).groupBy("k", "h").agg(F.count("*").alias("n"))
    return _joined(counted, F.floor(F.col("k") / width).cast("bigint"), ["k", "h"], F.concat("h", F.lit("x"), F.col("n").cast("string")))


def tree(rows: DataFrame, key: str, columns: Sequence[str], width: int = WIDTH, fan: int = FAN, levels: int | None = None) -> DataFrame:
    """level, node, n and digest of every node; leaves are level 0, and the root stands alone on the level above the last.

    levels is how many there are below the root; as many as leave it `fan` children, unless told otherwise. An empty
    table has no node.
    """
    now = leaves(rows, key, columns, width)
    if levels is None:
        least, most = now.agg(F.min("node"), F.max("node")).first()
        levels, spread = 1, 0 if least is None else most - least + 1
        while spread > fan:
            levels, spread = levels + 1, spread // fan + 1
    out = now.select(F.lit(0).alias("level"), "*")
    for level in range(1, levels + 1):
        up = F.lit(0).cast("bigint") if level == levels else F.floor(F.col("node") / fan).cast("bigint")
        now = _joined(now, up, ["node"], F.col("digest"))
        out = out.unionByName(now.select(F.lit(level).alias("level"), "*"))
    return out


def differing_ranges(before: DataFrame, after: DataFrame, key: str, columns: Sequence[str], width: int = WIDTH) -> DataFrame:
    """first_key, last_key and numbers of rows of each range whose rows aren't the same in both tables."""
    a = leaves(before, key, columns, width).select("node", F.col("n").alias("n_before"), F.col("digest").alias("was"))
    b = leaves(after, key, columns, width).select("node", F.col("n").alias("n_after"), F.col("digest").alias("now"))
    both = a.join(b, "node", "full_outer").where(~F.col("was").eqNullSafe(F.col("now")))
    count = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return both.select((F.col("node") * width).alias("first_key"), (F.col("node") * width + width - 1).alias("last_key"), count("n_before"), count("n_after"))
