"""Smaller evidence operators: power, trimmed nulls, allele assignment, guardrails, strand gates and document checks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandmill.functions.tails import binomial_tail
from strandmill.operators.lengths import packed_lengths
from strandmill.operators.nested_records import nested_tables


def critical_counts(depths: DataFrame, *, depth: str = "n", f: float = 0.02, alpha: float = 0.05, d: float = 0.3) -> DataFrame:
    """Per distinct depth the smallest count that is significant against ``f`` and the power to reach it at ``d``; depth + 1 and 0 if none is.

    Depths are few; each is worked out once.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            ks = []
            for n in part[depth]:
                k = np.arange(0, n + 2, dtype=float)
                tail = binomial_tail(k, np.full(len(k), float(n)), np.full(len(k), f))
                ks.append(int(np.argmax(tail < alpha)))
            power = binomial_tail(np.array(ks, float), part[depth].to_numpy(float), np.full(len(ks), d))
            yield pd.DataFrame({depth: part[depth], "crit_k": ks, "power": np.round(power, 6)})

    return depths.filter(F.col(depth) >= 0).select(F.col(depth).cast("int")).distinct().mapInPandas(run, f"{depth} int, crit_k int, power double")


def trimmed_null(profile: DataFrame, *by: str, trim: float = 0.1, least: int = 3, default: float = 0.02) -> DataFrame:
    """Background share of a profile without its top part, and the overdispersion between units.

    The units of least share are kept (at least ``least``); share (k + 0.5) / (n + 1); ``rho`` is the moment estimator
    within 0 and 0.5, and 0 below three units.
    """
    order = Window.partitionBy(*by).orderBy("frac", "unit")
    ranked = profile.withColumn("r", F.row_number().over(order)).withColumn("m", F.count("*").over(Window.partitionBy(*by)))
    kept = ranked.filter(F.col("r") <= F.greatest(F.lit(least), F.bround(F.col("m") * (1 - trim))))
    sums = kept.groupBy(*by).agg(F.count("*").alias("units"), F.sum("tot").alias("n"), F.sum("n_mut").alias("k"))
    sums = sums.withColumn("f", F.when(F.col("n") > 0, (F.col("k") + 0.5) / (F.col("n") + 1.0)).otherwise(default))
    off = F.pow(F.col("n_mut") - F.col("tot") * F.col("f"), F.lit(2.0)) / (F.col("tot") * F.col("f") * (1 - F.col("f")))
    chi = kept.join(sums.select(*by, "f"), list(by)).filter("tot > 0").groupBy(*by).agg(F.sum(off).alias("chi2"))
    mean = F.col("n") / F.col("units")
    rho = F.when((F.col("units") >= 3) & (mean > 1), F.least(F.greatest((F.col("chi2") / F.col("units") - 1) / (mean - 1), F.lit(0.0)), F.lit(0.5))).otherwise(0.0)
    return sums.join(chi, list(by), "left").select(*by, "units", F.round("f", 6).alias("f_null"), F.round(F.coalesce(rho, F.lit(0.0)), 6).alias("rho"))


def allele_assignment(hist: DataFrame, stated: DataFrame, *, min_gap: int = 5) -> DataFrame:
    """Reads of a sample by the nearer of two stated lengths (``mut_len``, else the other allele): n_mut, n_other, n_ambiguous.

    ``stated`` has ``row_id``, ``sample_id``, ``mut_len``, ``other_len``. Lengths nearer than ``min_gap`` are ambiguous;
    equal distances go to the first.
    """
    both = stated.filter("mut_len is not null and other_len is not null").join(packed_lengths(hist), "sample_id")
    off = lambda x, c: F.abs(x["copies"] - F.col(c))
    close = F.abs(F.col("mut_len") - F.col("other_len")) < min_gap
    total = lambda keep: F.aggregate(F.filter("lengths", keep), F.lit(0).cast("bigint"), lambda a, x: a + x["n"])
    return both.select(
        "row_id", total(lambda x: ~close & (off(x, "mut_len") <= off(x, "other_len"))).alias("n_mut"), total(lambda x: ~close & (off(x, "mut_len") > off(x, "other_len"))).alias("n_other"),
        total(lambda x: close).alias("n_ambiguous"),
    )


def length_guardrail(hist: DataFrame, *, least: int = 20, flat: float = 1.5) -> DataFrame:
    """Whether a sample's lengths can be trusted: the top length's reads, the tenth's, and ``is_reliable``.

    Unreliable with fewer than ``least`` reads on top, or if five lengths or more are there and the top is below ``flat``
    times the tenth (the last, if fewer).
    """
    ranked = hist.withColumn("r", F.row_number().over(Window.partitionBy("sample_id").orderBy(F.desc("n"), "copies"))).filter("r <= 10")
    per = ranked.groupBy("sample_id").agg(F.max("n").alias("top"), F.min("n").alias("tenth"), F.count("*").alias("lengths"))
    flat_top = (F.col("lengths") >= 5) & (F.col("top") < flat * F.col("tenth"))
    return per.withColumn("is_reliable", (F.col("top") >= least) & ~flat_top)


def minor_fraction(hist: DataFrame) -> DataFrame:
    """Second most frequent length's share of a sample's reads; null with one length."""
    ranked = hist.withColumn("r", F.row_number().over(Window.partitionBy("sample_id").orderBy(F.desc("n"), "copies")))
    return ranked.groupBy("sample_id").agg(F.round(F.max(F.when(F.col("r") == 2, F.col("n"))) / F.sum("n"), 6).alias("minor_fraction"))


def nearest_lengths(wanted: DataFrame, hist: DataFrame) -> DataFrame:
    """As-of join by distance: for each ``row_id``, ``sample_id``, ``length`` the nearest length with reads, the smaller of equals."""
    held = wanted.filter("length is not null").join(packed_lengths(hist), "sample_id")
    near = F.array_min(F.transform("lengths", lambda x: F.struct(F.abs(x["copies"] - F.col("length")).alias("off"), x["copies"].alias("copies"))))
    return held.withColumn("m", near).select("row_id", F.col("m.copies").alias("nearest"), F.col("m.off").alias("distance"))


def bias_calibration(bias: DataFrame) -> DataFrame:
    """Cohort estimate of the length bias: least squares through the origin on the log ratios, and the median of the samples."""
    y, x = F.log(F.col("count2") / F.col("count1")), F.col("delta").cast("double")
    # biases have four digits: samples are counted by value first, so that no task holds all of them
    part = F.when(F.col("delta") <= 20, "small").when(F.col("delta") >= 33, "large").otherwise("between")
    counts = bias.groupBy("bias", part.alias("part")).agg(F.count("*").alias("n"), F.sum(x * y).alias("xy"), F.sum(x * x).alias("xx"))
    median = lambda keep: F.round(F.percentile(F.when(keep, F.col("bias")), 0.5, F.col("n")), 4)
    return counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_samples"), F.round(F.exp(F.sum("xy") / F.sum("xx")), 4).alias("pooled"), median(F.lit(True)).alias("median"),
        median(F.col("part") == "small").alias("median_small"), median(F.col("part") == "large").alias("median_large"),
    )


def strand_gates(raw: DataFrame, *, min_reads: int = 5, min_strand: int = 2) -> DataFrame:
    """Strand balance of each haplotype's reads and whether they suffice; null where coverage isn't stated."""
    haps = nested_tables(raw).haplotypes.filter("n_fwd is not null and n_rev is not null")
    total = F.col("n_fwd") + F.col("n_rev")
    balance = F.when(total > 0, F.round(F.least("n_fwd", "n_rev") / total, 3))
    passed = (F.col("n_reads") >= min_reads) & (F.least("n_fwd", "n_rev") >= min_strand)
    return haps.select("file_id", "hap_no", "n_reads", "n_fwd", "n_rev", balance.alias("balance"), passed.alias("is_covered"))


def contig_repeats(contig: Column) -> Column:
    """The number of repeats in a contig's name; null if it has none."""
    return F.regexp_extract(contig, "_([0-9]+)repeats", 1).try_cast("int")


def contig_checks(raw: DataFrame) -> DataFrame:
    """Haplotypes whose contig, stated count or stored units disagree in the number of units."""
    haps = nested_tables(raw).haplotypes.withColumn("contig_units", contig_repeats(F.col("contig")))
    odd = (F.col("contig_units") != F.col("n_motifs")) | (F.col("n_motifs") != F.col("motif_rows"))
    return haps.filter(odd).select("file_id", "hap_no", "contig_units", "n_motifs", "motif_rows")


def unknown_keys(raw: DataFrame, allowed: Sequence[str], *, key: str = "file_id", body: str = "body") -> DataFrame:
    """Top-level keys of JSON documents that aren't allowed: ``file_id``, ``field``, one row each; invalid documents have none."""
    keys = F.array_except(F.json_object_keys(F.when(F.try_parse_json(body).isNotNull(), F.col(body))), F.array(*map(F.lit, allowed)))
    return raw.select(F.col(key).alias("file_id"), F.explode(keys).alias("field")).distinct()
