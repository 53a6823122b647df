"""Reads against a reference: alignments of one gap, bases at reference places, pileups, consensus and phasing.

Aligned reads have ``seq``, ``ref_start`` and ``cigar`` (array of ``op`` and ``len``); keys are whatever names a read and its contig.
Only counts per place are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandmill.functions.cigar import blocks
from strandmill.operators.scaffolds import min_variance_cut

GAP = "-"


def _common(a: Column, b: Column) -> Column:
    """Length of the common start of two texts."""
    equal = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.coalesce(x == y, F.lit(False)))
    first = F.array_position(equal, False)
    return F.when((a == "") | (b == ""), 0).when(first > 0, first - 1).otherwise(F.least(F.length(a), F.length(b))).cast("int")


def one_gap_cigar(seq: Column, ref: Column) -> Column:
    """Alignment of a whole read to a whole reference with one gap at most: as far left as the common start reaches, the rest of the common end after it."""
    short = F.least(F.length(seq), F.length(ref))
    start = _common(seq, ref)
    end = F.least(_common(F.reverse(seq), F.reverse(ref)), short - start)
    off = F.length(seq) - F.length(ref)
    op = lambda o, n: F.struct(F.lit(o).alias("op"), n.cast("int").alias("len"))
    parts = F.array(op(0, short - end), op(1, F.greatest(off, F.lit(0))), op(2, F.greatest(-off, F.lit(0))), op(0, end))
    whole = F.array(op(0, short))
    return F.when(off == 0, whole).otherwise(F.filter(parts, lambda c: c["len"] > 0))


def query_index_at(cigar: Column, start: Column, target: Column, *, in_gap: bool = False) -> Column:
    """Place in the read (from 0) of the base aligned to reference place ``target``; in a deletion null, or with ``in_gap`` the place behind it."""
    held = F.filter(blocks(cigar, start), lambda b: b["op"].isin(0, 7, 8, 2, 3) & (b["ref_at"] <= target) & (target < b["ref_at"] + b["len"]))
    b = F.get(held, F.lit(0))
    gap = b["query_at"] if in_gap else F.lit(None).cast("bigint")
    return F.when(b["op"].isin(0, 7, 8), b["query_at"] + target - b["ref_at"]).when(b["op"] == 2, gap)


def window_bases(seq: Column, cigar: Column, start: Column, low: int, high: int) -> Column:
    """The read's bases over the reference window [``low``, ``high``), with what is inserted before one of its places."""

    def part(b: Column) -> Column:
        first, last = F.greatest(b["ref_at"], F.lit(low)), F.least(b["ref_at"] + b["len"], F.lit(high))
        matched = F.substring(seq, (b["query_at"] + first - b["ref_at"] + 1).cast("int"), F.greatest(last - first, F.lit(0)).cast("int"))
        inserted = F.substring(seq, (b["query_at"] + 1).cast("int"), b["len"])
        return F.when(b["op"].isin(0, 7, 8), matched).when((b["op"] == 1) & (b["ref_at"] >= low) & (b["ref_at"] < high), inserted).otherwise("")

    return F.array_join(F.transform(blocks(cigar, start), part), "")


def placed_bases(reads: DataFrame, *keys: str) -> DataFrame:
    """One row per reference place a read covers: ``keys``, ``pos`` (from 0), ``base`` (``-`` in a deletion), ``inserted`` (what follows the place, or '').

    An insertion belongs to the place before it; one before the first place, clipped and skipped parts give nothing.
    """
    each = reads.select(*keys, "seq", F.inline(blocks(F.col("cigar"), F.col("ref_start"))))
    bases = F.split(F.substring("seq", (F.col("query_at") + 1).cast("int"), F.col("len")), "")
    letters = F.when(F.col("op").isin(0, 7, 8), F.filter(bases, lambda x: x != "")).when(F.col("op") == 2, F.array_repeat(F.lit(GAP), F.col("len")))
    on = each.filter(F.col("op").isin(0, 2, 7, 8)).select(*keys, "ref_at", F.lit(None).cast("string").alias("i"), F.posexplode(letters).alias("k", "base"))
    placed = on.select(*keys, (F.col("ref_at") + F.col("k")).cast("int").alias("pos"), "base", F.lit("").alias("inserted"))
    added = each.filter("op = 1 and ref_at > 0").select(
        *keys, (F.col("ref_at") - 1).cast("int").alias("pos"), F.lit(None).cast("string").alias("base"), F.substring("seq", (F.col("query_at") + 1).cast("int"), F.col("len")).alias("inserted")
    )
    return placed.unionByName(added)


def pileup(bases: DataFrame, *by: str) -> DataFrame:
    """Counts at each place: ``by``, ``pos``, ``base`` or ``inserted``, ``n``."""
    return bases.groupBy(*by, "pos", "base", "inserted").agg(F.count("*").alias("n"))


def consensus(
    counts: DataFrame, reference: DataFrame, *by: str, contig: str, min_depth: int = 3, gap_share: float = 0.6, short: int = 3, short_share: float = 0.5, long_share: float = 0.25
) -> DataFrame:
    """Consensus of each group of reads over its reference: ``by``, ``consensus``, ``covered`` (places of ``min_depth`` or more).

    A place of less depth has the reference's base. A gap that wins with ``gap_share`` leaves the place out, else the most
    frequent base stands (ties in the order of letters). The most frequent insertion behind a place is taken from ``short_share``
    of the depth on, one of more than ``short`` bases from ``long_share`` on. ``reference`` has ``contig`` and ``seq``.
    """
    is_base = F.col("base").isNotNull()
    per = counts.groupBy(*by, "pos").agg(
        F.sum(F.when(is_base, F.col("n"))).alias("depth"),
        F.coalesce(F.max(F.when(F.col("base") == GAP, F.col("n"))), F.lit(0)).alias("gaps"),
        F.min(F.when(is_base & (F.col("base") != GAP), F.struct((-F.col("n")).alias("n"), "base"))).alias("top"),
        F.min(F.when(~is_base, F.struct((-F.col("n")).alias("n"), "inserted"))).alias("ins"),
    )
    share = -F.col("ins.n") / F.col("depth")
    long = F.length("ins.inserted") > short
    added = F.when(F.when(long, share >= long_share).otherwise(share >= short_share), F.col("ins.inserted")).otherwise("")
    dropped = (F.col("gaps") > F.coalesce(-F.col("top.n"), F.lit(0))) & (F.col("gaps") >= gap_share * F.col("depth"))
    own = F.concat(F.when(dropped, "").otherwise(F.coalesce("top.base", F.lit(""))), F.coalesce(added, F.lit("")))
    called = per.filter(F.col("depth") >= min_depth).select(*by, "pos", own.alias("own"))
    packed = called.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("pos", "own"))).alias("called"))
    groups = counts.select(*by).distinct().join(packed, list(by), "left").join(F.broadcast(reference.select(F.col("contig").alias(contig), F.col("seq").alias("_ref"))), contig)
    letters = F.filter(F.split("_ref", ""), lambda x: x != "")
    text = F.array_join(F.transform(letters, lambda b, k: F.coalesce(F.try_element_at("called", k), b)), "")
    return groups.select(*by, text.alias("consensus"), F.coalesce(F.size("called"), F.lit(0)).alias("covered"))


def phase_reads(units: DataFrame, places: DataFrame, *by: str, read: str = "unit") -> DataFrame:
    """Reads of each group in two phases: ``by``, ``read``, ``score``, ``phase``.

    ``score`` is a read's share of minor bases over the group's ``places`` (bases that are neither are passed over); the cut
    of least variance parts the reads into ``A`` (low) and ``B``; where all scores are equal all are ``A``.
    """
    at = units.join(places.select(*by, "place", "major_base", "minor_base"), list(by)).withColumn("_b", F.substring("sequence", F.col("place"), F.lit(1)))
    minor = F.when(F.col("_b") == F.col("minor_base"), 1.0).when(F.col("_b") == F.col("major_base"), 0.0)
    scored = at.withColumn("_x", minor).groupBy(*by, read).agg(F.round(F.avg("_x"), 4).alias("score")).filter("score is not null")
    cuts = min_variance_cut(scored.withColumn("_g", F.struct(*by)), "_g", "score").select(*(F.col(f"_g.{c}").alias(c) for c in by), "cut")
    held = scored.join(cuts, list(by), "left")
    return held.select(*by, read, "score", F.when(F.col("score") > F.col("cut"), "B").otherwise("A").alias("phase"))


def phase_concordance(units: DataFrame, places: DataFrame, phased: DataFrame, *by: str, read: str = "unit", least: int = 5, share: float = 0.8) -> DataFrame:
    """Per group the places tested and those at which the two phases have different majorities, each of ``least`` reads or more and ``share`` of its phase."""
    at = units.join(places.select(*by, "place"), list(by)).join(phased.select(*by, read, "phase"), [*by, read]).withColumn("base", F.substring("sequence", F.col("place"), F.lit(1)))
    counts = at.groupBy(*by, "place", "phase", "base").agg(F.count("*").alias("n"))
    major = counts.groupBy(*by, "place", "phase").agg(F.sum("n").alias("depth"), F.min(F.struct((-F.col("n")).alias("n"), "base")).alias("m"))
    sure = (F.col("depth") >= least) & (-F.col("m.n") >= share * F.col("depth"))
    pick = lambda p: F.max(F.when((F.col("phase") == p) & sure, F.col("m.base")))
    per = major.groupBy(*by, "place").agg(pick("A").alias("a"), pick("B").alias("b"))
    return per.groupBy(*by).agg(F.count("*").alias("n_places"), F.count(F.when(F.col("a") != F.col("b"), 1)).alias("n_concordant"))
