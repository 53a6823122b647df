"""Cohort evaluation: subjects, sheet checks, confusion by substrate, pairs, pooled nulls and scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandmill.functions import tails

#: Spellings of a carrier's and a negative's status.
CARRIER, NEGATIVE = ("pos", "positive", "positif", "carrier"), ("neg", "negative", "negatif", "négatif")
#: Mean and deviation of the tail length, and the percentiles between its classes.
TAIL_MEAN, TAIL_SD, CLASSES = 36.9394, 14.0733, ((0.10, "very mild"), (0.50, "mild"), (0.90, "severe"))


def subject_key(sample: Column) -> Column:
    """A sample without the name of the alignment that was made of it."""
    return F.regexp_replace(F.coalesce(sample, F.lit("")), "_minimap2.*$", "")


def substrate_of(file: Column) -> Column:
    return F.when(file.rlike("(?i)T2T-clean"), "t2t_clean").otherwise("raw_fastq")


def row_checks(sheet: DataFrame) -> DataFrame:
    """What can't be true of a carrier's row: ``row_id``, ``violation``, one row each.

    ``no_variant``: no usable family; ``no_mut_len``; ``mut_len_far``: more than 3 from both stated alleles.
    """
    variant = F.lower(F.trim(F.coalesce("variant", F.lit(""))))
    apart = F.least(F.abs(F.col("mut_len") - F.col("a1")), F.abs(F.col("mut_len") - F.col("a2")))
    found = F.array_compact(
        F.array(
            F.when(variant.isin("", "false", "true", "nan", "none"), "no_variant"),
            F.when(F.col("mut_len").isNull(), "no_mut_len"),
            F.when(apart > 3, "mut_len_far"),
        )
    )
    return sheet.filter(F.lower("status").isin(*CARRIER)).select("row_id", F.explode(found).alias("violation"))


def outcome(predicted: Column, status: Column) -> Column:
    """TP, FN, FP, TN; null where the status is neither carrier nor negative or nothing was predicted."""
    carrier, negative = F.lower(status).isin(*CARRIER), F.lower(status).isin(*NEGATIVE)
    return F.when(carrier & predicted, "TP").when(carrier & ~predicted, "FN").when(negative & predicted, "FP").when(negative & ~predicted, "TN")


def confusion(scored: DataFrame, *by: str) -> DataFrame:
    """Outcomes per group and over all (``rollup``), with sensitivity and specificity; ``is_total`` marks the rows over all of a level."""
    counted = scored.rollup(*by).agg(F.grouping_id().alias("level"), *(F.count(F.when(F.col("outcome") == o, 1)).alias(o.lower()) for o in ("TP", "FN", "FP", "TN")))
    share = lambda a, b: F.round(F.col(a) / F.greatest(F.col(a) + F.col(b), F.lit(1)), 4)
    return counted.withColumn("sens", share("tp", "fn")).withColumn("spec", share("tn", "fp"))


def paired_subjects(sheet: DataFrame) -> DataFrame:
    """Subjects stated on both substrates: their rows on each and whether the states agree (null if one side has none)."""
    keyed = sheet.select(subject_key(F.col("sample")).alias("subject"), F.col("substrate"), F.lower("status").isin(*CARRIER).alias("carrier"), F.lower("status").isin(*CARRIER, *NEGATIVE).alias("known"))
    keyed = keyed.filter("subject != ''")
    side = lambda s: F.count(F.when(F.col("substrate") == s, 1)).alias(f"n_{s}")
    state = lambda s: F.max(F.when((F.col("substrate") == s) & F.col("known"), F.col("carrier").cast("int"))).alias(f"carrier_{s}")
    sides = ("raw_fastq", "t2t_clean")
    both = keyed.groupBy("subject").agg(*(f(s) for f in (side, state) for s in sides)).filter("n_raw_fastq > 0 and n_t2t_clean > 0")
    return both.withColumn("agree", F.col("carrier_raw_fastq") == F.col("carrier_t2t_clean"))


def pooled_panel(features: DataFrame, *by: str) -> DataFrame:
    """Null panel of records without the change: pooled share, mean, deviation and maximum over records, per group."""
    clean = features.filter("has_mut = false and tot > 0 and n8c is not null").withColumn("f", F.col("n8c") / F.col("tot"))
    return clean.groupBy(*by).agg(
        F.count("*").alias("n_records"), F.sum("tot").alias("n_tracts"), F.round(F.sum("n8c") / F.sum("tot"), 6).alias("f_pooled"),
        F.round(F.avg("f"), 6).alias("f_mean"), F.round(F.stddev_pop("f"), 6).alias("f_sd"), F.round(F.max("f"), 6).alias("f_max"),
    )


def with_panel(features: DataFrame, panel: DataFrame, *by: str, default: float = 0.02, least: int = 30) -> DataFrame:
    """Records with the pooled null of their group, or ``default`` if it is missing or rests on fewer than ``least`` tracts."""
    f = F.when(F.col("n_tracts") >= least, F.col("f_pooled"))
    return features.join(panel.select(*by, "n_tracts", "f_pooled"), list(by), "left").withColumn("f_panel", F.coalesce(f, F.lit(default))).drop("n_tracts", "f_pooled")


def tail_scores(scores: DataFrame) -> DataFrame:
    """Length behind the change, ratio and index of score rows, and the tail's z, percentile and class.

    Null where a length or the place is; the class follows the unrounded percentile.
    """
    tail = F.col("mut_len") - F.col("position")
    z = (tail - TAIL_MEAN) / TAIL_SD
    # class borders as z, so that no percentile is rounded before
    percentile = tails.percentile_of(z)
    kind = F.when(percentile < CLASSES[0][0], CLASSES[0][1]).when(percentile < CLASSES[1][0], CLASSES[1][1]).when(percentile <= CLASSES[2][0], CLASSES[2][1]).otherwise("very severe")
    return scores.select(
        "file_id", "row_no", "sample", tail.alias("tail"), F.round(F.col("mut_len") / F.when(F.col("healthy_len") != 0, F.col("healthy_len")), 3).alias("ratio"),
        F.round(tail / F.when(F.col("mut_len") != 0, F.col("mut_len")), 4).alias("tail_index"), F.round(z, 3).alias("z"), F.round(percentile, 4).alias("percentile"),
        F.when(percentile.isNotNull(), kind).alias("class"),
    )


def variant_family(text: Column, families: list[str]) -> Column:
    """The longest family name contained in a label, compared without anything but letters, digits and underscores."""
    plain = F.lower(F.regexp_replace(text, "[^0-9A-Za-z_]", ""))
    listed = F.array(*(F.struct(F.lit(f.lower()).alias("key"), F.lit(f).alias("name")) for f in sorted(families, key=lambda f: (-len(f), f))))
    return F.get(F.filter(listed, lambda r: F.contains(plain, r["key"])), F.lit(0))["name"]


def depth_capped(reads: DataFrame, cap: int, *, key: str = "sample_id", id: str = "read_id") -> DataFrame:
    """At most ``cap`` reads per sample, those of the smallest hash; a sampling operator. Spark limits each sample before the shuffle."""
    order = Window.partitionBy(key).orderBy(F.md5(id), id)
    return reads.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= cap).drop("_r")


def carrier_allele(calls: DataFrame, shares: DataFrame, *, factor: float = 2.5) -> DataFrame:
    """Which of two alleles a share of carrier reads speaks for: the one whose abundance is nearest by ratio.

    ``calls`` as of ``call_peaks``, ``shares`` has ``sample_id`` and ``share``. Confident if the nearest ratio is at most
    ``factor`` and more than 1.5 times nearer than the other.
    """
    total = F.col("count1") + F.col("count2")
    far = lambda c: F.greatest(F.col("share") / (F.col(c) / total), (F.col(c) / total) / F.col("share"))
    held = calls.filter("allele2 is not null").join(shares.filter("share > 0"), "sample_id").withColumn("d1", far("count1")).withColumn("d2", far("count2"))
    near, other = F.least("d1", "d2"), F.greatest("d1", "d2")
    return held.select(
        "sample_id", "share", F.when(F.col("d1") <= F.col("d2"), F.col("allele1")).otherwise(F.col("allele2")).alias("carrier_allele"),
        ((near <= factor) & (other > 1.5 * near)).alias("is_confident"),
    )
