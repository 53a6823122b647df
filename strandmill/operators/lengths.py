"""Allele lengths from repeat counts per read: histograms and the four length callers.

Reads are reduced to a histogram (one row per sample and count) with map-side partial aggregation; all callers then work on
histograms, whose size per sample is bounded by the range of repeat counts, so a sample with a tenth of all reads is no
larger than any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Recurrent by-product lengths and their weight.
BY_PRODUCTS, BY_PRODUCT_WEIGHT = (44, 70), 0.9


def first_deliveries(reads: DataFrame) -> DataFrame:
    """Each read once, as first loaded; ``sample_id``, ``read_id``, ``copies``, ``hp``, ``run``, ``read_at``.

    Reads without a sample or name stay apart from each other only by their values. The grouping key is the read, never the
    sample alone, so no sample is one task.
    """
    first = F.struct("loaded_at", F.coalesce("copies", F.lit(-1)), F.coalesce("hp", F.lit("")))
    kept = reads.groupBy("sample_id", "read_id").agg(F.min_by(F.struct("copies", "hp", "run", "read_at"), first).alias("r"))
    return kept.select("sample_id", "read_id", "r.*")


def length_histogram(reads: DataFrame, *by: str) -> DataFrame:
    """``sample_id``, further keys, ``copies``, ``n``; reads without a count are left out."""
    return reads.filter("copies is not null").groupBy("sample_id", *by, "copies").agg(F.count("*").alias("n"))


def call_peaks(hist: DataFrame, *, sep: int = 8, min_frac: float = 0.006, min_reads: int = 6, smooth: int = 2) -> DataFrame:
    """Peak caller on smoothed counts: the tallest peak and the tallest one at least ``sep`` above it.

    Of equal peaks the longer counts. As a peak at least ``sep`` above the tallest can't be suppressed by a kept one, the
    second allele is a plain maximum and no iteration is needed. ``count1`` and ``count2`` are smoothed counts.
    """
    wide = max(2, sep // 2)
    totals = hist.groupBy("sample_id").agg(F.sum("n").alias("n_reads"), F.min("copies").alias("low"), F.max("copies").alias("high"))
    # every count feeds its neighbours: centres without reads of their own are there as well
    spread = hist.select("sample_id", F.explode(F.transform(F.sequence(F.lit(-smooth), F.lit(smooth)), lambda d: F.col("copies") + d)).alias("c"), "n")
    smoothed = spread.groupBy("sample_id", "c").agg(F.sum("n").alias("s"))
    around = Window.partitionBy("sample_id").orderBy("c").rangeBetween(-wide, wide)
    tops = smoothed.withColumn("top", F.max("s").over(around)).join(totals, "sample_id")
    floor = F.greatest(F.lit(min_reads), F.bround(F.lit(min_frac) * F.col("n_reads")))
    peaks = tops.filter(F.col("c").between(F.col("low"), F.col("high")) & (F.col("s") >= floor) & (F.col("s") >= F.col("top")))
    main = peaks.groupBy("sample_id").agg(F.max(F.struct("s", "c")).alias("main"))
    longer = peaks.join(main, "sample_id").filter(F.col("c") >= F.col("main.c") + sep).groupBy("sample_id").agg(F.max(F.struct("s", "c")).alias("longer"))
    low_conf = F.col("longer").isNotNull() & (F.col("longer.s") < F.greatest(0.02 * F.col("n_reads"), F.lit(15)))
    return (
        totals.join(main, "sample_id", "left").join(longer, "sample_id", "left")
        .select(
            "sample_id", "n_reads", F.col("main.c").alias("allele1"), F.col("main.s").alias("count1"),
            F.col("longer.c").alias("allele2"), F.col("longer.s").alias("count2"), low_conf.alias("long_low_conf"),
        )
    )


def pick_two(hist: DataFrame, *, min_reads: int = 5, share: float = 0.4, min_contrast: float = 3.0) -> DataFrame:
    """Scored picker: peaks by count, contrast to their neighbourhood and length; the two best, or one if either is flat."""
    own = Window.partitionBy("sample_id").orderBy("copies")
    at = lambda d: F.coalesce(F.sum("n").over(own.rangeBetween(d, d)), F.lit(0))
    near = hist.withColumn("left", at(-1)).withColumn("right", at(1)).withColumn("around", F.sum("n").over(own.rangeBetween(-3, 3)) - F.col("n"))
    beside = lambda c: (F.col(c) > F.col("n")) & (F.col("n") >= share * F.col(c))
    peaks = near.filter((F.col("n") >= min_reads) & ((F.col("n") >= F.greatest("left", "right")) | beside("left") | beside("right")))
    main = F.first("copies").over(Window.partitionBy("sample_id").orderBy(F.desc("n"), "copies"))
    contrast = F.col("n") / (F.col("around") / 6.0 + 1.0)
    weight = F.when(F.col("copies").isin(*BY_PRODUCTS), BY_PRODUCT_WEIGHT).otherwise(1.0)
    scored = peaks.withColumn("main", main).withColumn("contrast", contrast)
    scored = scored.withColumn("score", F.floor(F.col("contrast") * F.col("n") * F.pow(F.lit(10.0), F.col("copies") / F.col("main") - 1.0) * weight * 10 + 0.5) / 10)
    order = Window.partitionBy("sample_id").orderBy(F.desc("score"), "copies")
    ranked = scored.withColumn("place", F.row_number().over(order)).withColumn("n_peaks", F.count("*").over(Window.partitionBy("sample_id"))).filter("place <= 2")
    best = ranked.groupBy("sample_id").agg(
        F.max("n_peaks").alias("n_peaks"), F.min(F.round("contrast", 2)).alias("least"),
        *(F.max(F.when(F.col("place") == k, F.col(c))).alias(f"{c}{k}") for k in (1, 2) for c in ("copies", "n", "score")),
    )
    both = (F.col("n_peaks") > 1) & (F.col("least") >= min_contrast)
    return best.select(
        "sample_id", "n_peaks", F.col("copies1").alias("allele1"), F.col("n1").alias("count1"), F.col("score1"),
        F.when(both, F.col("copies2")).alias("allele2"), F.when(both, F.col("n2")).alias("count2"), F.when(both, F.col("score2")).alias("score2"),
    )


def low_count_clusters(hist: DataFrame, *, tolerance: int = 3, min_reads: int = 2, sep: int = 8, near: float = 0.5, far: float = 0.25) -> DataFrame:
    """Clusters of counts without gaps above ``tolerance``; the two best supported at least ``sep`` apart, the second folded if weak."""
    own = Window.partitionBy("sample_id").orderBy("copies")
    new = F.when(F.col("copies") - F.lag("copies").over(own) <= tolerance, 0).otherwise(1)
    grouped = hist.withColumn("new", new).withColumn("cluster", F.sum("new").over(own))
    clusters = grouped.groupBy("sample_id", "cluster").agg(F.sum("n").alias("support"), F.bround(F.percentile("copies", 0.5, F.col("n"))).cast("int").alias("center"))
    clusters = clusters.filter(F.col("support") >= min_reads)
    best = clusters.groupBy("sample_id").agg(F.min_by(F.struct("center", "support"), F.struct(-F.col("support"), "center")).alias("a"))
    apart = clusters.join(best, "sample_id").filter(F.abs(F.col("center") - F.col("a.center")) >= sep)
    second = apart.groupBy("sample_id").agg(F.min_by(F.struct("center", "support"), F.struct(-F.col("support"), "center")).alias("b"))
    weak = F.col("b.support") / F.col("a.support") < F.when(F.abs(F.col("a.center") - F.col("b.center")) < 8, near).otherwise(far)
    keep = F.col("b").isNotNull() & ~weak
    return best.join(second, "sample_id", "left").select(
        "sample_id", F.col("a.center").alias("allele1"), F.col("a.support").alias("count1"),
        F.when(keep, F.col("b.center")).alias("allele2"), F.when(keep, F.col("b.support")).alias("count2"),
    )


def split_two_means(hist: DataFrame, *, min_sep: int = 5, min_reads: int = 6) -> DataFrame:
    """Best cut of the sorted counts into two groups (least squares, two reads or more each); two alleles if the medians are ``min_sep`` apart.

    Within a run of equal counts the squares are least at one end, so only ends of runs are tried and reads need no sorting.
    """
    own = Window.partitionBy("sample_id").orderBy("copies").rowsBetween(Window.unboundedPreceding, 0)
    n, x = F.col("n"), F.col("copies").cast("bigint")
    run = hist.select("sample_id", "copies", "n", F.sum(n).over(own).alias("upto"), F.sum(n * x).over(own).alias("sx"))
    total = hist.groupBy("sample_id").agg(F.sum("n").alias("all"), F.sum(n * x).alias("all_x"))
    run = run.join(total, "sample_id").withColumn("before", F.col("upto") - n)
    first, last = F.greatest(F.col("before"), F.lit(2)), F.least(F.col("upto"), F.col("all") - 2)
    cuts = run.filter((F.col("all") >= min_reads) & (first <= last)).withColumn("cut", F.explode(F.array_distinct(F.array(first, last))))
    left = (F.col("sx") - x * (F.col("upto") - F.col("cut"))).cast("double")
    right = F.col("all_x") - left
    gain = left * left / F.col("cut") + right * right / (F.col("all") - F.col("cut"))
    best = cuts.groupBy("sample_id").agg(F.max(F.struct(F.round(gain, 6).alias("gain"), (-F.col("cut")).alias("neg"))).alias("b")).select("sample_id", (-F.col("b.neg")).alias("cut"))
    held = run.select("sample_id", "copies", "before", "upto", "all").join(best, "sample_id", "left")
    cut, whole = F.col("cut"), F.col("all")
    value_at = lambda i: F.max(F.when((F.col("before") <= i) & (i < F.col("upto")), F.col("copies")))
    middles = held.groupBy("sample_id").agg(
        F.max("all").alias("n_reads"), F.max("cut").alias("cut"),
        value_at(F.floor((cut - 1) / 2)).alias("s1"), value_at(F.floor(cut / 2)).alias("s2"),
        value_at(cut + F.floor((whole - cut - 1) / 2)).alias("l1"), value_at(cut + F.floor((whole - cut) / 2)).alias("l2"),
        value_at(F.floor(whole / 2)).alias("mid"),
    )
    short, long = F.floor((F.col("s1") + F.col("s2")) / 2).cast("int"), F.floor((F.col("l1") + F.col("l2")) / 2).cast("int")
    het = F.coalesce(long - short >= min_sep, F.lit(False))
    return middles.select(
        "sample_id", "n_reads", het.alias("is_het"), F.when(het, short).otherwise(F.col("mid")).alias("allele1"), F.when(het, long).alias("allele2"),
        F.when(het, (short + long) / 2).alias("threshold"),
    )


def alleles_by_haplotype(hist: DataFrame, *, sep: int = 8, min_reads: int = 2) -> DataFrame:
    """Median count per haplotype tag; ``hist`` has ``hp``. Two tags with ``min_reads`` reads are needed; medians nearer than ``sep`` are one allele."""
    tagged = hist.filter(F.col("hp").isin("1", "2"))
    medians = tagged.groupBy("sample_id", "hp").agg(F.sum("n").alias("n"), F.floor(F.percentile("copies", 0.5, F.col("n"))).cast("int").alias("median")).filter(F.col("n") >= min_reads)
    wide = medians.groupBy("sample_id").agg(
        F.count("*").alias("tags"), F.min("median").alias("low"), F.max("median").alias("high"),
        *(F.max(F.when(F.col("hp") == h, F.col(c))).alias(f"{c}_hp{h}") for h in ("1", "2") for c in ("median", "n")),
    )
    return wide.filter("tags = 2").select("sample_id", "median_hp1", "n_hp1", "median_hp2", "n_hp2", (F.col("high") - F.col("low") >= sep).alias("is_het"))


def length_bias(peaks: DataFrame) -> DataFrame:
    """Loss of the longer allele per repeat of two-allele samples: (count2 / count1) ** (1 / delta), at most 1."""
    delta = F.col("allele2") - F.col("allele1")
    pairs = peaks.filter(F.col("allele2").isNotNull() & (F.col("count1") > 0) & (F.col("count2") > 0))
    ratio = F.pow(F.col("count2") / F.col("count1"), 1.0 / delta)
    return pairs.select("sample_id", delta.alias("delta"), "count1", "count2", F.round(F.least(ratio, F.lit(1.0)), 4).alias("bias"))


def detectable_delta(bias: DataFrame, reads: DataFrame, *, least: int = 3) -> DataFrame:
    """How much longer a second allele can be and still leave ``least`` reads; ``reads`` has ``sample_id`` and ``n_reads``."""
    known = bias.filter("bias < 1 and bias > 0").join(reads.select("sample_id", "n_reads"), "sample_id").filter("n_reads > 0")
    reach = F.log(F.lit(float(least)) / F.col("n_reads")) / F.log("bias")
    return known.select("sample_id", "n_reads", "bias", F.when(F.col("n_reads") <= least, 0).otherwise(F.greatest(F.lit(0), F.floor(F.round(reach, 9)).cast("int"))).alias("detectable_delta"))


def length_accuracy(calls: DataFrame, truth: DataFrame, *, tolerance: int = 1) -> DataFrame:
    """Called against stated lengths per sheet row: exact, within ``tolerance``, and the difference of the longer allele.

    ``truth`` has ``row_id``, ``sample_id``, ``a1``, ``a2``; rows without a stated length are not compared.
    """
    stated = truth.filter("a1 is not null or a2 is not null")
    pair = lambda a, b: (F.least(a, b), F.greatest(a, b))  # noqa: E731  (nulls are passed over: one value is both)
    joined = stated.join(calls.select("sample_id", "allele1", "allele2").filter("allele1 is not null"), "sample_id")
    (t1, t2), (c1, c2) = pair(F.col("a1"), F.col("a2")), pair(F.col("allele1"), F.col("allele2"))
    off = F.greatest(F.abs(t1 - c1), F.abs(t2 - c2))
    return joined.select("row_id", "sample_id", (off == 0).alias("is_exact"), (off <= tolerance).alias("is_within"), (c2 - t2).alias("long_delta"))


def run_platforms(reads: DataFrame) -> DataFrame:
    """Per run the platform most of its read names speak for, ties by name."""
    name = F.col("read_id")
    kind = F.when(name.rlike("^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"), "ONT").when(name.rlike("/ccs$"), "PacBio HiFi").otherwise("unknown")
    votes = reads.withColumn("platform", kind).groupBy("run", "platform").agg(F.count("*").alias("n"))
    return votes.groupBy("run").agg(F.sum("n").alias("n_reads"), F.min_by("platform", F.struct(-F.col("n"), "platform")).alias("platform"), F.max("n").alias("votes"))


def packed_lengths(hist: DataFrame) -> DataFrame:
    """One row per sample with its histogram as ``lengths``, an array of ``copies`` and ``n``; it is no longer than the range of counts."""
    return hist.groupBy("sample_id").agg(F.array_sort(F.collect_list(F.struct("copies", "n"))).alias("lengths"))


def modal_lengths(hist: DataFrame) -> DataFrame:
    """Most frequent length of each sample (the longer of equals), its reads, and whether the next is too rare for a second allele.

    ``is_single``: the most frequent has 5 reads or more, and the second fewer than a quarter of them.
    """
    order = Window.partitionBy("sample_id").orderBy(F.desc("n"), F.desc("copies"))
    top = hist.withColumn("r", F.row_number().over(order)).filter("r <= 2").groupBy("sample_id").agg(
        F.max(F.when(F.col("r") == 1, F.col("copies"))).alias("mode"), F.max(F.when(F.col("r") == 1, F.col("n"))).alias("n_mode"), F.max(F.when(F.col("r") == 2, F.col("n"))).alias("n2")
    )
    single = (F.col("n_mode") >= 5) & (F.coalesce("n2", F.lit(0)) / F.col("n_mode") < 0.25)
    return top.select("sample_id", "mode", "n_mode", single.alias("is_single"))


def best_windows(hist: DataFrame, *, reach: int = 2) -> DataFrame:
    """The length around which most reads lie (within ``reach``), the shortest of equals, and the most frequent length in that window."""
    around = Window.partitionBy("sample_id").orderBy("copies").rangeBetween(-reach, reach)
    sums = hist.withColumn("s", F.sum("n").over(around)).withColumn("mode", F.min(F.struct((-F.col("n")).alias("n"), "copies")).over(around))
    best = sums.groupBy("sample_id").agg(F.min(F.struct((-F.col("s")).alias("s"), "copies", F.col("mode.copies").alias("mode"))).alias("b"))
    return best.select("sample_id", F.col("b.copies").alias("center"), (-F.col("b.s")).alias("n_window"), "b.mode")


def longest_peaks(hist: DataFrame, *, sep: int = 12, frac: float = 0.05, min_reads: int = 6, smooth: int = 2) -> DataFrame:
    """The longest length that is a substantial peak: smoothed counts of ``frac`` of the reads or more, and none greater within half of ``sep``."""
    totals = hist.groupBy("sample_id").agg(F.sum("n").alias("n_reads"))
    order = Window.partitionBy("sample_id").orderBy("copies")
    smoothed = hist.withColumn("s", F.sum("n").over(order.rangeBetween(-smooth, smooth)))
    tops = smoothed.withColumn("top", F.max("s").over(order.rangeBetween(-(sep // 2), sep // 2))).join(totals, "sample_id")
    peaks = tops.filter((F.col("s") >= F.col("top")) & (F.col("s") >= F.greatest(F.lit(min_reads), frac * F.col("n_reads"))))
    return peaks.groupBy("sample_id").agg(F.max("copies").alias("longest"), F.count("*").alias("n_peaks"))


def reads_near(hist: DataFrame, stated: DataFrame, *, tolerance: int = 4) -> DataFrame:
    """Reads of a sample within ``tolerance`` of a stated ``length``: ``row_id``, ``n_near``, ``n_reads``."""
    held = stated.filter("length is not null").join(packed_lengths(hist), "sample_id")
    total = lambda keep: F.aggregate(F.filter("lengths", keep), F.lit(0).cast("bigint"), lambda a, x: a + x["n"])
    near = total(lambda x: F.abs(x["copies"] - F.col("length")) <= tolerance)
    return held.select("row_id", near.alias("n_near"), total(lambda x: F.lit(True)).alias("n_reads"))
