"""Repeat units of decoded haplotypes: profiles by unit, blocks, nulls, length changes, novel units and base consensus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandmill.functions.keyed import small_side
from strandmill.functions.tails import binom_tail
from strandmill.operators.nested_records import in_order, parse_records

UNIT = 60


def decoded_units(raw: DataFrame) -> DataFrame:
    """Units of every haplotype in order of place: ``file_id``, ``run``, ``hap_no``, ``hap_rank``, ``unit`` (from 1), ``name``, ``pos``, ``length``, ``net``, ``sequence``.

    A unit stored twice at one place counts once, as first stored; units without a place or length are left out. ``net`` is
    the length over a whole unit.
    """
    haps = parse_records(raw, run="run").select("file_id", "run", F.explode("haps").alias("h"))
    placed = in_order(F.filter(F.col("h.motifs"), lambda m: m["length"].isNotNull()))
    each = haps.select("file_id", "run", F.col("h.hap_no").alias("hap_no"), F.col("h.hap_rank").alias("hap_rank"), F.posexplode(placed).alias("at", "m"))
    return each.select(
        "file_id", "run", "hap_no", "hap_rank", (F.col("at") + 1).alias("unit"), F.trim("m.name").alias("name"), "m.pos", "m.length",
        (F.col("m.length") - UNIT).alias("net"), F.upper(F.trim("m.sequence")).alias("sequence"),
    )


def unit_profile(units: DataFrame, *by: str) -> DataFrame:
    """Per group and unit number: haplotypes seen, those with another length, and their share."""
    seen = units.groupBy(*by, "unit").agg(F.count("*").alias("tot"), F.count(F.when(F.col("net") != 0, 1)).alias("n_mut"))
    return seen.withColumn("frac", F.round(F.col("n_mut") / F.col("tot"), 4))


def longest_blocks(profile: DataFrame, *by: str, level: float = 0.035, min_tot: int = 1) -> DataFrame:
    """Longest run of consecutive units at or above ``level`` per group, the first of equals; units left out break a run."""
    kept = profile.filter((F.col("tot") >= min_tot) & (F.col("frac") >= level))
    island = kept.withColumn("island", F.col("unit") - F.row_number().over(Window.partitionBy(*by).orderBy("unit")))
    blocks = island.groupBy(*by, "island").agg(F.count("*").alias("len"), F.min("unit").alias("start"), F.max("unit").alias("end"), F.max("frac").alias("max"))
    best = blocks.groupBy(*by).agg(F.min_by(F.struct("len", "start", "end", "max"), F.struct(-F.col("len"), "start")).alias("b"))
    return best.select(*by, F.col("b.len").alias("block_len"), F.col("b.start").alias("block_start"), F.col("b.end").alias("block_end"), F.col("b.max").alias("block_max"))


def focality(profile: DataFrame, *by: str) -> DataFrame:
    """Peak against the median of a profile, and how many units reach half the peak."""
    base = profile.groupBy(*by).agg(
        F.max("frac").alias("peak_frac"), F.min_by("unit", F.struct(-F.col("frac"), "unit")).alias("peak_unit"), F.percentile("frac", 0.5).alias("median_frac")
    )
    half = profile.join(base.select(*by, "peak_frac"), list(by)).groupBy(*by).agg(F.count(F.when(F.col("frac") >= F.col("peak_frac") / 2, 1)).alias("n_above_half"))
    ratio = F.when(F.col("median_frac") > 0, F.round(F.col("peak_frac") / F.col("median_frac"), 3))
    return base.join(half, list(by)).select(*by, "peak_unit", "peak_frac", F.round("median_frac", 4).alias("median_frac"), ratio.alias("ratio"), "n_above_half")


def leave_one_out(profile: DataFrame, *by: str, floor: float = 1e-4) -> DataFrame:
    """Each unit's null share from all other units of its group, (k + 0.5) / (n + 1) and at least ``floor``."""
    group = Window.partitionBy(*by)
    others, hits = F.sum("tot").over(group) - F.col("tot"), F.sum("n_mut").over(group) - F.col("n_mut")
    return profile.withColumn("f_null", F.greatest(F.lit(floor), (hits + 0.5) / (others + 1.0))).withColumn("null_obs", others)


def positional_test(profile: DataFrame, *by: str, min_tot: int = 15, alpha: float = 0.001, min_frac: float = 0.10, min_mut: int = 4) -> DataFrame:
    """Best unit per group against its leave-one-out null, Bonferroni over the units tested, with gates on share and count."""
    tested = leave_one_out(profile, *by).filter(F.col("tot") >= min_tot)
    tests = F.count("*").over(Window.partitionBy(*by))
    scored = tested.withColumn("n_tests", tests).withColumn("p", binom_tail(F.col("n_mut"), F.col("tot"), F.col("f_null")))
    scored = scored.withColumn("p_bonf", F.round(F.least(F.lit(1.0), F.col("p") * F.col("n_tests")), 6))
    best = scored.groupBy(*by).agg(F.min_by(F.struct("unit", "tot", "n_mut", "frac", "p_bonf", "n_tests"), F.struct("p_bonf", -F.col("frac"), "unit")).alias("b"))
    called = (F.col("b.p_bonf") <= alpha) & (F.col("b.frac") >= min_frac) & (F.col("b.n_mut") >= min_mut)
    return best.select(*by, "b.unit", "b.tot", "b.n_mut", "b.frac", "b.n_tests", "b.p_bonf", called.alias("called"))


def length_changes(units: DataFrame, *, frame_only: bool = False) -> DataFrame:
    """Units of another length; with ``frame_only`` those whose change is no multiple of three."""
    changed = units.filter("net != 0")
    changed = changed.filter("net % 3 != 0") if frame_only else changed
    return changed.select("file_id", "hap_no", "hap_rank", "unit", "name", "net")


def focal_calls(units: DataFrame, *, least: int = 3, share: float = 0.15) -> DataFrame:
    """Frame-changing units per haplotype; an array-wide pattern (``least`` or more, over ``share`` of all units) calls none."""
    per = units.groupBy("file_id", "hap_no").agg(
        F.count("*").alias("n_units"), F.count(F.when(F.col("net") % 3 != 0, 1)).alias("n_shifted"),
        F.min(F.when(F.col("net") % 3 != 0, F.col("unit"))).alias("first_unit"), F.sum(F.abs("net")).alias("burden"),
    )
    wide = (F.col("n_shifted") >= least) & (F.col("n_shifted") > share * F.col("n_units"))
    return per.select("file_id", "hap_no", "n_units", "n_shifted", "burden", wide.alias("is_array_wide"), F.when(~wide, F.col("first_unit")).alias("unit"))


def hamming(a: Column, b: Column) -> Column:
    """Places in which two texts of equal length differ; null if the lengths differ."""
    count = F.aggregate(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: (x != y).cast("int")), F.lit(0), lambda n, x: n + x)
    return F.when(F.length(a) == F.length(b), F.when(a == b, 0).otherwise(count))


def novel_units(units: DataFrame, reference: DataFrame) -> DataFrame:
    """Sequences of unit length (60 bases) that no reference unit has: how often, in how many haplotypes, and the nearest reference unit.

    Each distinct sequence is compared with the whole reference, a list of units that Spark broadcasts if it is small enough.
    """
    known = reference.filter(F.length("seq") == UNIT).select(F.col("seq").alias("ref"), "motif_name").distinct()
    seen = units.filter(F.length("sequence") == UNIT).groupBy("sequence").agg(F.count("*").alias("occurrences"), F.countDistinct("file_id", "hap_no").alias("haplotypes"))
    novel = seen.join(reference.select(F.col("seq").alias("sequence")).distinct(), "sequence", "left_anti")
    # a stated list against all distinct sequences
    pairs = novel.join(small_side(known), F.length("sequence") == F.length("ref"))
    near = F.min(F.struct(hamming(F.col("sequence"), F.col("ref")).alias("d"), F.col("motif_name").alias("name")))
    best = pairs.groupBy("sequence", "occurrences", "haplotypes").agg(near.alias("near"))
    return best.select("sequence", "occurrences", "haplotypes", F.col("near.name").alias("closest"), F.col("near.d").alias("distance"))


def base_counts(units: DataFrame, *by: str) -> DataFrame:
    """Counts of the bases at each place of a group's units of 60 bases; equal sequences are counted before they are taken apart."""
    distinct = units.filter((F.length("sequence") == UNIT) & F.col("name").isNotNull()).groupBy(*by, "sequence").agg(F.count("*").alias("w"))
    each = distinct.select(*by, "w", F.posexplode(F.split("sequence", "")).alias("at", "base")).filter("base != ''")
    return each.groupBy(*by, (F.col("at") + 1).alias("place"), "base").agg(F.sum("w").alias("n"))


def plurality_consensus(counts: DataFrame, *by: str, min_depth: int = 3) -> DataFrame:
    """Most frequent base per place (ties in the order of the letters), its share and the depth."""
    best = counts.groupBy(*by, "place").agg(F.sum("n").alias("depth"), F.min_by(F.struct("base", "n"), F.struct(-F.col("n"), "base")).alias("b"))
    return best.filter(F.col("depth") >= min_depth).select(*by, "place", F.col("b.base").alias("base"), "depth", F.round(F.col("b.n") / F.col("depth"), 4).alias("share"))


def phasing_places(counts: DataFrame, *by: str, min_depth: int = 5, low: float = 0.15, high: float = 0.85) -> DataFrame:
    """Places whose second base has a share from ``low`` to ``high``, with both bases."""
    order = Window.partitionBy(*by, "place").orderBy(F.desc("n"), "base")
    ranked = counts.withColumn("r", F.row_number().over(order))
    pick = lambda k, c: F.max(F.when(F.col("r") == k, F.col(c)))
    per = ranked.groupBy(*by, "place").agg(F.sum("n").alias("depth"), pick(1, "base").alias("major_base"), pick(2, "base").alias("minor_base"), pick(2, "n").alias("n2"))
    minor = F.col("n2") / F.col("depth")
    return per.filter((F.col("depth") >= min_depth) & minor.between(low, high)).select(*by, "place", "major_base", "minor_base", "depth", F.round(minor, 4).alias("minor_share"))


def homopolymers(units: DataFrame, *, min_len: int = 3) -> DataFrame:
    """Runs of one base of ``min_len`` or more in each distinct unit sequence: ``sequence``, ``start``, ``base``, ``len``."""
    distinct = units.filter("sequence is not null and sequence != ''").select("sequence").distinct()
    tiles = F.regexp_extract_all("sequence", F.lit(r"((.)\2*)"), 1)
    starts = F.transform(tiles, lambda t, i: F.struct(F.aggregate(F.slice(tiles, F.lit(1), i), F.lit(1), lambda s, x: s + F.length(x)).alias("start"), F.substring(t, 1, 1).alias("base"), F.length(t).alias("len")))
    return distinct.select("sequence", F.inline(starts)).filter(F.col("len") >= min_len)
