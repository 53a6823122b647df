"""Joins and choices by key that shuffle no more than they must."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandmill.functions.lineage import checkpointed

#: A side of up to so many narrow rows is broadcast; a larger one is shuffled.
BROADCAST_ROWS = 500_000


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` written once, and marked for broadcast if it has at most ``rows`` rows."""
    held = checkpointed(df)
    return F.broadcast(held) if held.count() <= rows else held


def same_keys(pairs: list[tuple[str, str]]) -> Column:
    """Equal keys, null being equal to null."""
    return reduce(lambda a, b: a & b, (F.col(x).eqNullSafe(F.col(y)) for x, y in pairs))


def split_repeated(df: DataFrame, *keys: str, rows: int = BROADCAST_ROWS) -> tuple[DataFrame, DataFrame]:
    """``df`` as the rows whose key stands in one row only, and the rows whose key stands in several.

    Only the keys are shuffled to tell them apart; wide rows of the first part are not moved while the list of repeated
    keys has at most ``rows`` rows. Null keys are equal.
    """
    several = df.groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n > 1")
    marks = small_side(several.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), F.lit(True).alias("_several")), rows)
    both = df.join(marks, same_keys([(k, f"_k{i}") for i, k in enumerate(keys)]), "left").drop(*(f"_k{i}" for i in range(len(keys))))
    return both.filter("_several is null").drop("_several"), both.filter("_several").drop("_several")


def attach(rows: DataFrame, small: DataFrame, key: str, weight: str, total: int, how: str = "inner") -> DataFrame:
    """``rows`` joined to one row per ``key``; keys that hold over 1/1000 of all ``total`` rows are broadcast, there are at most 1000."""
    hot = (F.col(weight) > total / 1000) if total else F.lit(False)
    listed = small.filter(hot)
    marked = rows.join(F.broadcast(listed.select(key, F.lit(True).alias("_hot"))), key, "left")
    usual = marked.filter("_hot is null").drop("_hot").join(small.filter(~hot), key, how)
    return usual.unionByName(rows.join(F.broadcast(listed), key))
