"""Joins on keys that may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of one key that a task may join, and keys that may have more.
HOT_ROWS = 20_000
MAX_HOT = 100_000


def join_counted(rows: DataFrame, counts: DataFrame, keys: list[str], number: str, n_rows: int, spread: Column) -> DataFrame:
    """``rows`` joined with ``counts``, which has one row per key and the
    ``number`` of its rows.

    Keys of many rows are salted, ``spread`` (a hash of the rows' columns) says
    how. Of such keys, at most ``MAX_HOT``, the 64-bit hash and the number of
    salts are broadcast, and both sides look there.
    """
    bound = max(HOT_ROWS, n_rows // MAX_HOT)
    key = F.xxhash64(*keys)
    hot = (counts.where(F.col(number) > bound).groupBy(key.alias("_key")).agg(F.max(F.ceil(F.col(number) / bound)).cast("int").alias("_salts")))
    # a row that meets nothing: the plan is the same whether there are hot keys or not
    hot = hot.unionByName(rows.sparkSession.range(1).select(F.lit(None).cast("long").alias("_key"), F.lit(1).alias("_salts")))

    def salted(df: DataFrame) -> DataFrame:
        return df.withColumn("_key", key).join(F.broadcast(hot), "_key", "left").withColumn("_salts", F.coalesce("_salts", F.lit(1)))

    mine = salted(rows).withColumn("_salt", F.pmod(spread, F.col("_salts")).cast("int")).drop("_key", "_salts")
    theirs = salted(counts).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))).drop("_key", "_salts")
    return mine.join(theirs, [*keys, "_salt"]).drop("_salt")
