"""Choice of scaffolds and agreement of length statements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandmill.operators.lengths import packed_lengths


def read_concentration(hist: DataFrame) -> DataFrame:
    """Share of a sample's reads on its two busiest lengths."""
    ranked = hist.withColumn("r", F.row_number().over(Window.partitionBy("sample_id").orderBy(F.desc("n"), "copies")))
    return ranked.groupBy("sample_id").agg(F.sum("n").alias("n_reads"), F.sum(F.when(F.col("r") <= 2, F.col("n"))).alias("n_top2")).withColumn("share", F.round(F.col("n_top2") / F.col("n_reads"), 4))


def scaffolds_for_lengths(hist: DataFrame, lengths: DataFrame, *, window: int = 5) -> DataFrame:
    """Per stated length the busiest length of the sample within ``window``, else the busiest of all; the second never takes the first's.

    ``lengths`` has ``row_id``, ``sample_id``, ``a1``, ``a2``. Equal counts go to the nearer, then to the smaller length.
    The second pick follows the first within the row.
    """

    held = lengths.select("row_id", "sample_id", "a1", "a2").join(packed_lengths(hist), "sample_id", "left")

    def pick(want: str, taken: Column) -> Column:
        pool = F.filter("lengths", lambda x: taken.isNull() | (x["copies"] != taken))
        off = lambda x: F.abs(x["copies"] - F.col(want))
        order = lambda x: F.struct((off(x) > window).cast("int").alias("far"), (-x["n"]).alias("n"), off(x).alias("off"), x["copies"].alias("copies"))
        return F.when(F.col(want).isNotNull(), F.array_min(F.transform(pool, order))["copies"])

    first = held.withColumn("scaffold1", pick("a1", F.lit(None).cast("int")))
    return first.withColumn("scaffold2", pick("a2", F.col("scaffold1"))).drop("lengths")


def length_congruence(calls: DataFrame, stated: DataFrame) -> DataFrame:
    """Agreement of called and stated lengths, both sorted: by the largest difference of the pairs.

    CONCORDANT up to 1, OFFSET_SUSPECT at 4, SPREAD up to 3, DIVERGENT above, INSUFFICIENT where one side is empty.
    """
    lists = stated.join(calls.select("sample_id", "allele1", "allele2"), "sample_id", "left")
    x = F.array_sort(F.array_compact(F.array("a1", "a2")))
    y = F.array_sort(F.array_compact(F.array("allele1", "allele2")))
    held = lists.withColumn("x", x).withColumn("y", y)
    pairs = F.least(F.size("x"), F.size("y"))
    off = F.when(pairs >= 1, F.abs(F.get("x", F.lit(0)) - F.get("y", F.lit(0))))
    off = F.when(pairs >= 2, F.greatest(off, F.abs(F.get("x", F.lit(1)) - F.get("y", F.lit(1))))).otherwise(off)
    held = held.withColumn("max_delta", off)
    d = F.col("max_delta")
    status = F.when(d.isNull(), "INSUFFICIENT").when(d <= 1, "CONCORDANT").when(d == 4, "OFFSET_SUSPECT").when(d <= 3, "SPREAD").otherwise("DIVERGENT")
    return held.select("row_id", "sample_id", "max_delta", status.alias("status"))


def length_comparison(calls: DataFrame, stated: DataFrame, *, missing: float = 4.5, offset: tuple[float, float] = (3.5, 4.5)) -> DataFrame:
    """Stated lengths against called ones, with the reasons in order: a common offset, then a stated length without any call, then the largest difference.

    ``OFFSET_SUSPECT`` if all pairs (sorted, from the shortest) differ by ``offset`` to the same side; ``ALLELE_MISSING`` if a stated length has no call
    within ``missing``, these are listed in ``missing``; else CONCORDANT up to 1, SPREAD up to 3, DIVERGENT; INSUFFICIENT where one side is empty.
    """
    lists = stated.join(calls.select("sample_id", "allele1", "allele2"), "sample_id", "left")
    held = lists.withColumn("x", F.array_sort(F.array_compact(F.array("a1", "a2")))).withColumn("y", F.array_sort(F.array_compact(F.array("allele1", "allele2"))))
    pairs = F.least(F.size("x"), F.size("y"))
    signed = F.zip_with(F.slice("x", F.lit(1), pairs), F.slice("y", F.lit(1), pairs), lambda a, b: a - b)
    held = held.withColumn("d", signed).withColumn("missing", F.filter("x", lambda a: ~F.exists("y", lambda b: F.abs(a - b) <= missing)))
    within = lambda v: v.between(*offset)
    shifted = F.forall("d", within) | F.forall("d", lambda v: within(-v))
    most = F.array_max(F.transform("d", F.abs))
    status = (
        F.when(F.size("d") == 0, "INSUFFICIENT").when(shifted, "OFFSET_SUSPECT").when(F.size("missing") > 0, "ALLELE_MISSING")
        .when(most <= 1, "CONCORDANT").when(most <= 3, "SPREAD").otherwise("DIVERGENT")
    )
    return held.select("row_id", "sample_id", F.when(F.size("d") > 0, F.array_join(F.transform("missing", lambda v: v.cast("string")), ",")).alias("missing"), status.alias("status"))


def min_variance_cut(df: DataFrame, by: str, value: str, *, digits: int = 4) -> DataFrame:
    """Cut of a group's values into two parts with the least squares, from counts of rounded values; the first of equals.

    Rows are reduced to at most 10 ** ``digits`` values per unit range first, so a large group is no large sort.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(by, F.round(value, digits).alias("v")).agg(F.count("*").alias("n"))
    own = Window.partitionBy(by).orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(by)
    scale = 10**digits
    x = F.round(F.col("v") * scale).cast("bigint")
    sums = counts.withColumn("i", F.sum("n").over(own)).withColumn("s", F.sum(F.col("n") * x).over(own))
    sums = sums.withColumn("all_n", F.sum("n").over(whole)).withColumn("all_s", F.sum(F.col("n") * x).over(whole)).filter("i < all_n")
    left, right = F.col("s").cast("double"), (F.col("all_s") - F.col("s")).cast("double")
    gain = F.round(left * left / F.col("i") + right * right / (F.col("all_n") - F.col("i")), 3)
    best = sums.groupBy(by).agg(F.max_by(F.struct("v", "i", "all_n"), F.struct(gain, -F.col("v"))).alias("b"))
    return best.select(by, F.col("b.v").alias("cut"), F.col("b.i").alias("n_low"), (F.col("b.all_n") - F.col("b.i")).alias("n_high"))


def genotypes(counts: DataFrame, *by: str, min_depth: int = 5, low: float = 0.2, high: float = 0.8) -> DataFrame:
    """Genotype of each place of a group from its base counts (``by``, ``place``, ``base``, ``n``): the two most frequent bases, share of the second, and hom, het or low_depth."""
    order = Window.partitionBy(*by, "place").orderBy(F.desc("n"), "base")
    ranked = counts.withColumn("r", F.row_number().over(order))
    pick = lambda k, c: F.max(F.when(F.col("r") == k, F.col(c)))
    per = ranked.groupBy(*by, "place").agg(F.sum("n").alias("depth"), pick(1, "base").alias("major"), pick(2, "base").alias("minor"), pick(2, "n").alias("n2"))
    share = F.coalesce(F.col("n2"), F.lit(0)) / F.col("depth")
    call = F.when(F.col("depth") < min_depth, "low_depth").when(share.between(low, high), "het").otherwise("hom")
    return per.select(*by, "place", "depth", "major", "minor", F.round(share, 4).alias("minor_share"), call.alias("genotype"))
