"""Set-similarity join with prefix, length and positional filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Sets per task that one token may hold; a token of more sets is spread over so many more tasks.
PER_SALT = 50_000


def _ordered(sets: DataFrame, weights: DataFrame) -> DataFrame:
    """``id``, ``n`` and ``tokens`` (``df``, ``token``) ordered from the globally rarest to the most frequent."""
    each = sets.select("id", F.explode(F.array_distinct("tokens")).alias("token")).filter(F.col("token").isNotNull())
    ranked = each.join(weights, "token")
    packed = ranked.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("t"))
    return packed.select("id", F.size("t").alias("n"), F.col("t").alias("tokens"))


def _prefix(sets: DataFrame, side: str, threshold: float) -> DataFrame:
    keep = F.col("n") - F.ceil(F.lit(threshold) * F.col("n") - 1e-9).cast("int") + 1
    return sets.select(
        F.col("id").alias(f"{side}_id"), F.col("n").alias(f"{side}_n"), F.posexplode(F.slice("tokens", F.lit(1), keep)).alias(f"{side}_at", "t")
    ).select(f"{side}_id", f"{side}_n", f"{side}_at", "t.token", F.floor(F.col("t.df") / PER_SALT).alias("salts"))


def similar_pairs(left: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    """All pairs of sets with Jaccard similarity of ``threshold`` or more: ``left_id``, ``right_id``, ``similarity``.

    Both sides have ``id`` and ``tokens`` (an array, read as a set). Tokens are ordered by rarity over both sides and two
    sets can only be that similar if they share a token in their short rare prefixes; the lengths and the places of that
    token bound the overlap before the sets themselves are compared. No pair is lost by the filters.

    Defined cases: null and empty sets have no pairs; a repeated token counts once; ids are taken as unique per side; an
    empty side gives no pairs. The right sets of a token are copied once per ``PER_SALT`` sets that hold it, over which the
    left sets are spread, so that a token in a third of ``left`` is no single task; other tokens are not copied.
    """
    tokens = left.select(F.explode(F.array_distinct("tokens")).alias("token")).unionAll(right.select(F.explode(F.array_distinct("tokens")).alias("token")))
    weights = tokens.filter("token is not null").groupBy("token").agg(F.count("*").alias("df"))
    x, y = _ordered(left, weights), _ordered(right, weights)
    salted_x = _prefix(x, "left", threshold).withColumn("salt", F.pmod(F.xxhash64("left_id"), F.col("salts") + 1)).drop("salts")
    salted_y = _prefix(y, "right", threshold).withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("salts")))).drop("salts")
    sizes = (F.col("right_n") >= F.col("left_n") * threshold - 1e-9) & (F.col("left_n") >= F.col("right_n") * threshold - 1e-9)
    needed = F.ceil(F.lit(threshold / (1 + threshold)) * (F.col("left_n") + F.col("right_n")) - 1e-9)
    possible = 1 + F.least(F.col("left_n") - F.col("left_at") - 1, F.col("right_n") - F.col("right_at") - 1)
    candidates = salted_x.join(salted_y, ["token", "salt"]).filter(sizes & (possible >= needed)).select("left_id", "right_id").distinct()
    held = candidates.join(left.select(F.col("id").alias("left_id"), F.col("tokens").alias("a")), "left_id")
    held = held.join(right.select(F.col("id").alias("right_id"), F.col("tokens").alias("b")), "right_id")
    return held.select("left_id", "right_id", jaccard(F.array_compact("a"), F.array_compact("b")).alias("similarity")).filter(F.col("similarity") >= threshold - 1e-9)


def jaccard(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b))
    return both / (F.size(F.array_distinct(a)) + F.size(F.array_distinct(b)) - both)


def best_match(pairs: DataFrame) -> DataFrame:
    """The most similar right side of each left side, ties to the smaller id."""
    order = Window.partitionBy("left_id").orderBy(F.desc("similarity"), "right_id")
    return pairs.withColumn("_r", F.row_number().over(order)).filter("_r = 1").drop("_r")
