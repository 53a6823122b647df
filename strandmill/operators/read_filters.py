"""Predicates on aligned reads.

Reads have ``flag``, ``mapq``, ``contig``, ``ref_start`` and ``cigar`` (array of ``op`` and ``len``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandmill.functions.cigar import end_clips, overlap, reference_length

#: Bits of a read's flag.
UNMAPPED, REVERSE, SECONDARY, FAILED, DUPLICATE, SUPPLEMENTARY = 4, 16, 256, 512, 1024, 2048


def has(bit: int) -> Column:
    return F.col("flag").bitwiseAND(F.lit(bit)) != 0


def rejection_reason(
    contig: str, start: int, end: int, *, min_mapq: int = 0, min_span: int = 5_000, max_clip: int = 10_000, keep_supplementary: bool = False
) -> Column:
    """Why a read is dropped, the first reason that holds; null if it is kept."""
    reach = F.col("ref_start") + reference_length(F.col("cigar"))
    return (
        F.when(has(UNMAPPED), "unmapped")
        .when(has(SECONDARY), "secondary")
        .when(has(SUPPLEMENTARY) & F.lit(not keep_supplementary), "supplementary")
        .when(has(DUPLICATE), "duplicate")
        .when(F.col("mapq") < min_mapq, "low_mapq")
        .when(F.col("contig") != contig, "wrong_contig")
        .when(overlap(F.col("ref_start"), reach, start, end) < min_span, "low_span")
        .when(end_clips(F.col("cigar")) > max_clip, "high_clip")
    )


def split_by_reason(reads: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """Kept reads, and the number of dropped reads per reason."""
    marked = reads.withColumn("reason", reason)
    return marked.filter("reason is null").drop("reason"), marked.filter("reason is not null").groupBy("reason").agg(F.count("*").alias("n"))


def primary(min_mapq: int = 20) -> Column:
    """Mapped primary reads that are no duplicates."""
    return ~has(UNMAPPED) & ~has(SECONDARY) & ~has(SUPPLEMENTARY) & ~has(DUPLICATE) & (F.col("mapq") >= min_mapq)


def in_region(contig: str, start: int, end: int) -> Column:
    """Reads that touch a half-open region."""
    return (F.col("contig") == contig) & (F.col("ref_start") < end) & (F.col("ref_start") + reference_length(F.col("cigar")) > start)


def strand_balance(reads: DataFrame, *by: str) -> DataFrame:
    """Reads per strand and the smaller strand's share."""
    counts = reads.groupBy(*by).agg(F.count("*").alias("n_reads"), F.count(F.when(has(REVERSE), 1)).alias("n_rev"))
    forward = F.col("n_reads") - F.col("n_rev")
    return counts.withColumn("n_fwd", forward).withColumn("balance", F.round(F.least(forward, F.col("n_rev")) / F.col("n_reads"), 3))
