"""Tracts and units of reads by their place in the array: profiles from either end, contexts, nulls and candidates.

Reads are rows with ``seq`` (read on the strand of the array); what is measured on a read is a short array, which is taken apart
with its place and counted per group and place. Only counts are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandmill.functions import tails
from strandmill.operators.nested_records import in_order, parse_records


def haplotype_reads(raw: DataFrame) -> DataFrame:
    """Each decoded haplotype of analyzer files written out as one sequence: ``file_id``, ``run``, ``hap_no``, ``hap_rank``, ``names``, ``units``, ``seq``.

    Units stand in order of place, each place once; units without a sequence are left out. Haplotypes without units give no row.
    """
    haps = parse_records(raw, run="run").select("file_id", "run", F.explode("haps").alias("h"))
    placed = F.filter(in_order(F.filter(F.col("h.motifs"), lambda m: m["length"].isNotNull())), lambda m: F.trim(m["sequence"]) != "")
    held = haps.select("file_id", "run", F.col("h.hap_no").alias("hap_no"), F.col("h.hap_rank").alias("hap_rank"), placed.alias("m")).filter(F.size("m") > 0)
    units = F.transform("m", lambda m: F.upper(F.trim(m["sequence"])))
    return held.select("file_id", "run", "hap_no", "hap_rank", F.transform("m", lambda m: F.trim(m["name"])).alias("names"), units.alias("units"), F.array_join(units, "").alias("seq"))


def by_place(reads: DataFrame, values: Column, *by: str, reverse: bool = False) -> DataFrame:
    """Counts of each value at each place: ``by``, ``place`` (from 1, or from the end with ``reverse``), ``value``, ``n``."""
    each = reads.select(*by, F.posexplode(F.reverse(values) if reverse else values).alias("at", "value"))
    return each.groupBy(*by, (F.col("at") + 1).alias("place"), "value").agg(F.count("*").alias("n"))


def place_profile(counts: DataFrame, changed: Column, *by: str, min_reads: int = 8) -> DataFrame:
    """Per place the values seen, those that ``changed`` and their share; places of fewer than ``min_reads`` are left out."""
    seen = counts.groupBy(*by, "place").agg(F.sum("n").alias("tot"), F.coalesce(F.sum(F.when(changed, F.col("n"))), F.lit(0)).alias("n_mut")).filter(F.col("tot") >= min_reads)
    return seen.withColumn("frac", F.round(F.col("n_mut") / F.col("tot"), 3))


def best_place(profile: DataFrame, *by: str, min_tot: int = 20) -> DataFrame:
    """The place of the greatest share among those with ``min_tot`` values or more, the first of equals."""
    best = profile.filter(F.col("tot") >= min_tot).groupBy(*by).agg(F.min_by(F.struct("place", "tot", "n_mut", "frac"), F.struct(-F.col("frac"), "place")).alias("b"))
    return best.select(*by, "b.place", "b.tot", "b.n_mut", "b.frac")


def shifted(counts: DataFrame, *by: str, usual: int, lengths: tuple[int, ...], min_support: int = 4, min_tot: int = 8) -> DataFrame:
    """Test of run lengths: for each place and each length other than ``usual``, reads at or beyond it (longer ones for an expansion, shorter ones for a contraction).

    The null of a place is the share at all other places of its group, (k + 0.5) / (n + 1); Bonferroni over the places and
    lengths tested in the group, those with ``min_support`` reads or more at the length itself.
    """
    wanted = F.explode(F.array(*(F.lit(x) for x in lengths if x != usual))).alias("length")
    each = counts.select(*by, "place", "value", "n", wanted)
    beyond = F.when(F.col("length") > usual, F.col("value") >= F.col("length")).otherwise(F.col("value") <= F.col("length"))
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
    seen = each.groupBy(*by, "place", "length").agg(F.sum("n").alias("tot"), total(beyond).alias("k"), total(F.col("value") == F.col("length")).alias("support"))
    group = Window.partitionBy(*by, "length")
    others, hits = F.sum("tot").over(group) - F.col("tot"), F.sum("k").over(group) - F.col("k")
    tested = seen.withColumn("f_null", (hits + 0.5) / (others + 1.0)).filter((F.col("support") >= min_support) & (F.col("tot") >= min_tot))
    scored = tested.withColumn("p", tails.binom_tail(F.col("k"), F.col("tot"), F.col("f_null"))).withColumn("n_tests", F.count("*").over(Window.partitionBy(*by)))
    return scored.select(*by, "place", "length", "tot", "k", F.round("f_null", 6).alias("f_null"), F.round(F.least(F.lit(1.0), F.col("p") * F.col("n_tests")), 6).alias("p_bonf"))


def context_counts(reads: DataFrame, tract: Column, *by: str, units: int = 3) -> DataFrame:
    """Tract lengths by context, the names of the ``units`` units up to and with the one that holds the tract: ``by``, ``context``, ``len``, ``n``.

    ``tract`` gives the tract's length from a unit's sequence in the column ``unit`` (null: none). The first units of an array have
    shorter contexts and are left out.
    """
    each = reads.select(*by, "names", F.posexplode("units").alias("at", "unit")).filter(F.col("at") >= units - 1)
    context = F.array_join(F.slice("names", F.col("at") - (units - 2), F.lit(units)), "-")
    return each.select(*by, context.alias("context"), tract.alias("len")).filter("len is not null").groupBy(*by, "context", "len").agg(F.count("*").alias("n"))


def context_panel(counts: DataFrame, subject: str, *, changed: Column) -> DataFrame:
    """Null panel by context: subjects, tracts, pooled share of ``changed`` lengths, its mean, deviation and maximum over subjects."""
    share = counts.groupBy("context", subject).agg(F.sum("n").alias("tot"), F.coalesce(F.sum(F.when(changed, F.col("n"))), F.lit(0)).alias("k")).withColumn("f", F.col("k") / F.col("tot"))
    return share.groupBy("context").agg(
        F.count("*").alias("n_subjects"), F.sum("tot").alias("n_tracts"), F.round(F.sum("k") / F.sum("tot"), 6).alias("f_pooled"), F.round(F.avg("f"), 6).alias("f_mean"),
        F.round(F.stddev_pop("f"), 6).alias("f_sd"), F.round(F.max("f"), 6).alias("f_max"),
    )


def context_candidates(
    counts: DataFrame, panel: DataFrame, subject: str, *, changed: Column, min_count: int = 4, default: float = 0.02, least: int = 30, alpha: float = 0.05, prior: float = 0.3, d: float = 0.3, borderline: float = 0.9
) -> DataFrame:
    """Contexts of a subject against the panel: binomial tail, Bonferroni over its contexts of ``min_count`` changed tracts or more, and a tier.

    ``called`` below ``alpha``, ``borderline`` if the posterior of a share ``d`` reaches ``borderline``, else ``none``. Contexts missing from
    the panel, or of fewer than ``least`` tracts there, have the null ``default``.
    """
    own = counts.groupBy(subject, "context").agg(F.sum("n").alias("tot"), F.coalesce(F.sum(F.when(changed, F.col("n"))), F.lit(0)).alias("k")).filter(F.col("k") >= min_count)
    f = F.coalesce(F.when(F.col("n_tracts") >= least, F.col("f_pooled")), F.lit(default))
    held = own.join(panel.select("context", "n_tracts", "f_pooled"), "context", "left").withColumn("f_null", F.least(F.greatest(f, F.lit(1e-4)), F.lit(0.9999))).drop("n_tracts", "f_pooled")
    held = held.withColumn("p", tails.binom_tail(F.col("k"), F.col("tot"), F.col("f_null"))).withColumn("n_tests", F.count("*").over(Window.partitionBy(subject)))
    held = held.withColumn("p_bonf", F.round(F.least(F.lit(1.0), F.col("p") * F.col("n_tests")), 6)).withColumn("posterior", F.round(tails.posterior(F.col("k"), F.col("tot"), prior, d, F.col("f_null")), 6))
    tier = F.when(F.col("p_bonf") <= alpha, "called").when(F.col("posterior") >= borderline, "borderline").otherwise("none")
    return held.select(subject, "context", "tot", "k", F.round("f_null", 6).alias("f_null"), "p_bonf", "posterior", tier.alias("tier"))
