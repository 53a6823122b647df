"""Evaluation of records against the truth sheet: rank tests, variant and place scores, consistency, misses by length and changes by name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandmill.functions import tails
from strandmill.operators.cohort import CARRIER

#: Changes whose names are attested, as patterns.
ATTESTED = r"59dupC(?!C)|58_59delCC|52dupG|58_59insG|8_27del"
#: Lower ends of the length classes.
LENGTH_CLASSES = (50, 70)


def average_ranks(counts: DataFrame, value: str, *by: str) -> DataFrame:
    """Mean rank of each distinct ``value`` of a table of counts (``value``, ``n``), ties sharing theirs; one row per value."""
    per = counts.groupBy(*by, value).agg(F.sum("n").alias("m"))
    below = Window.partitionBy(*by).orderBy(value).rowsBetween(Window.unboundedPreceding, -1) if by else Window.partitionBy(F.lit(1)).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    return per.select(*by, value, "m", (F.coalesce(F.sum("m").over(below), F.lit(0)) + (F.col("m") + 1) / 2).alias("rank"))


def rank_sum(df: DataFrame, group: Column, value: Column, *, digits: int = 4) -> DataFrame:
    """One-sided rank-sum test that values are greater where ``group`` holds: ``n1``, ``n2``, ``u``, ``z``, ``p``.

    Values are rounded to ``digits`` and counted first, so ranks are taken over distinct values; normal approximation with the
    correction for ties, without that for continuity. Rows without group or value are left out; z is null where it has no spread.
    """
    counts = df.select(group.alias("g"), F.round(value, digits).alias("v")).filter("g is not null and v is not null").groupBy("g", "v").agg(F.count("*").alias("n"))
    ranked = counts.join(average_ranks(counts, "v"), "v")
    first, m = F.col("g"), F.col("m").cast("double")
    sums = ranked.agg(
        F.coalesce(F.sum(F.when(first, F.col("n"))), F.lit(0)).alias("n1"), F.coalesce(F.sum(F.when(~first, F.col("n"))), F.lit(0)).alias("n2"),
        F.coalesce(F.sum(F.when(first, F.col("n") * F.col("rank"))), F.lit(0.0)).alias("r1"),
        # m cubed less m for each distinct value, over the rows of both groups
        F.coalesce(F.sum(F.col("n") * (m * m - 1)), F.lit(0.0)).alias("ties"),
    )
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    whole = n1 + n2
    u = F.col("r1") - n1 * (n1 + 1) / 2
    spread = n1 * n2 / 12 * (whole + 1 - F.col("ties") / F.when(whole > 1, whole * (whole - 1)))
    z = F.when(spread > 0, (u - n1 * n2 / 2) / F.sqrt(spread))
    held = sums.select("n1", "n2", u.alias("u"), z.alias("z"))
    return held.select("n1", "n2", "u", F.round("z", 4).alias("z"), F.round(1 - tails.percentile_of(F.col("z")), 6).alias("p"))


def rank_correlation(df: DataFrame, x: Column, y: Column, *by: str, digits: int = 4) -> DataFrame:
    """Rank correlation of two values per group, over counts of distinct pairs: ``by``, ``n``, ``rho`` (null without spread)."""
    counts = df.select(*by, F.round(x, digits).alias("x"), F.round(y, digits).alias("y")).filter("x is not null and y is not null").groupBy(*by, "x", "y").agg(F.count("*").alias("n"))
    rx = average_ranks(counts, "x", *by).select(*by, "x", F.col("rank").alias("rx"))
    ry = average_ranks(counts, "y", *by).select(*by, "y", F.col("rank").alias("ry"))
    held = counts.join(rx, [*by, "x"]).join(ry, [*by, "y"])
    n, total = F.sum("n"), lambda c: F.sum(F.col("n") * c)
    a, b = F.col("rx"), F.col("ry")
    sums = held.groupBy(*by).agg(n.alias("n"), total(a).alias("sx"), total(b).alias("sy"), total(a * a).alias("xx"), total(b * b).alias("yy"), total(a * b).alias("xy"))
    m = F.col("n")
    vx, vy = F.col("xx") - F.col("sx") * F.col("sx") / m, F.col("yy") - F.col("sy") * F.col("sy") / m
    rho = F.when((vx > 1e-9) & (vy > 1e-9), (F.col("xy") - F.col("sx") * F.col("sy") / m) / F.sqrt(vx * vy))
    return sums.select(*by, "n", F.round(rho, 6).alias("rho"))


def best_records(features: DataFrame, subject: Column) -> DataFrame:
    """The record of each subject with the greatest share of changed tracts among those with a change: ``subject``, ``variant``, ``repeat_index``, ``frac``."""
    held = features.filter("has_mut and variant is not null").select(subject.alias("subject"), "variant", "repeat_index", F.col("frac_8c").alias("frac"), "feature_id")
    best = held.filter("subject != ''").groupBy("subject").agg(F.min_by(F.struct("variant", "repeat_index", "frac"), F.struct(-F.coalesce("frac", F.lit(0.0)), "feature_id")).alias("b"))
    return best.select("subject", "b.*")


def score_calls(sheet: DataFrame, best: DataFrame, subject: Column, *, tolerance: int = 2) -> DataFrame:
    """Each carrier's row against its subject's best record: ``row_id``, ``variant_score`` (match, wrong_family, missed), ``place_delta``, ``is_near``.

    Rows without a stated variant have no score; the place is scored only where both state one.
    """
    carriers = sheet.filter(F.lower("status").isin(*CARRIER)).select("row_id", subject.alias("subject"), F.trim("variant").alias("stated"), "variant_pos")
    held = carriers.join(best.select("subject", "variant", "repeat_index"), "subject", "left")
    score = F.when(F.coalesce("stated", F.lit("")) == "", None).when(F.col("variant").isNull(), "missed").when(F.col("variant") == F.col("stated"), "match").otherwise("wrong_family")
    delta = F.col("repeat_index") - F.col("variant_pos")
    return held.select("row_id", score.alias("variant_score"), delta.alias("place_delta"), (F.abs(delta) <= tolerance).alias("is_near"))


def miss_table(sheet: DataFrame, features: DataFrame, subject: Column) -> DataFrame:
    """One row per carrier's row, those without any record kept: its length, records, best evidence and outcome.

    The best evidence is the record of most changed tracts, the last of equals by id; ``n_tested`` counts records with tracts,
    ``n_powered`` those with 20 or more.
    """
    carriers = sheet.filter(F.lower("status").isin(*CARRIER)).select("row_id", subject.alias("subject"), "mut_len")
    tracts = F.coalesce("tot", F.lit(0))
    per = features.select(subject.alias("subject"), "feature_id", "tot", "n8c", "frac_8c", "has_mut").groupBy("subject").agg(
        F.count(F.when(tracts > 0, 1)).alias("n_tested"), F.count(F.when(tracts >= 20, 1)).alias("n_powered"), F.max("tot").alias("max_cover"),
        F.max_by(F.struct("n8c", "frac_8c"), F.struct(F.coalesce("n8c", F.lit(-1)), "feature_id")).alias("b"), F.max(F.col("has_mut").cast("int")).alias("called"),
    )
    held = carriers.join(per, "subject", "left")
    outcome = F.when(F.col("called").isNull(), "NO_OUTPUT").when(F.col("called") == 1, "CALLED").otherwise("MISSED")
    length = F.when(F.col("mut_len") < LENGTH_CLASSES[0], f"<{LENGTH_CLASSES[0]}").when(F.col("mut_len") < LENGTH_CLASSES[1], f"{LENGTH_CLASSES[0]}-{LENGTH_CLASSES[1] - 1}").when(F.col("mut_len").isNotNull(), f">={LENGTH_CLASSES[1]}")
    return held.select(
        "row_id", "subject", "mut_len", length.alias("length_class"), *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n_tested", "n_powered")), "max_cover",
        F.col("b.n8c").alias("best_count"), F.col("b.frac_8c").alias("best_frac"), outcome.alias("outcome"),
    )


def misses_by_length(misses: DataFrame) -> DataFrame:
    """Per class of length: rows, rate called, and the range of the best share by outcome."""
    called = F.col("outcome") == "CALLED"
    frac = lambda c: F.when(c, F.col("best_frac"))
    return misses.groupBy("length_class").agg(
        F.count("*").alias("n_rows"), F.count(F.when(called, 1)).alias("n_called"), F.round(F.avg(called.cast("int")), 4).alias("rate"),
        F.min(frac(called)).alias("least_called"), F.max(frac(called)).alias("most_called"), F.max(frac(~called)).alias("most_missed"),
    )


def motif_consistency(features: DataFrame, *, min_records: int = 5, share: float = 0.5) -> DataFrame:
    """Per change: records, the place most of them have (the smaller of equals) with its share, haplotypes, and the upper median length; confident from ``share`` on."""
    held = features.filter("has_mut and variant is not null")
    places = held.filter("repeat_index is not null").groupBy("variant", "repeat_index").agg(F.count("*").alias("n"))
    mode = places.groupBy("variant").agg(F.min_by(F.struct("repeat_index", "n"), F.struct(-F.col("n"), "repeat_index")).alias("m"), F.sum("n").alias("placed"))
    lengths = held.filter("vntr_len is not null").groupBy("variant", "vntr_len").agg(F.count("*").alias("n"))
    below = Window.partitionBy("variant").orderBy("vntr_len")
    middle = lengths.withColumn("c", F.sum("n").over(below)).withColumn("t", F.sum("n").over(Window.partitionBy("variant"))).filter(F.col("c") > F.floor(F.col("t") / 2))
    middle = middle.groupBy("variant").agg(F.min("vntr_len").alias("median_len"))
    per = held.groupBy("variant").agg(F.count("*").alias("n_records"), F.countDistinct("hp").alias("n_haplotypes")).filter(F.col("n_records") >= min_records)
    out = per.join(mode, "variant", "left").join(middle, "variant", "left")
    concentration = F.col("m.n") / F.col("placed")
    return out.select("variant", "n_records", "n_haplotypes", F.col("m.repeat_index").alias("place"), F.round(concentration, 4).alias("concentration"), "median_len", (concentration >= share).alias("is_confident"))


def change_parts(name: Column) -> Column:
    """Struct of ``motif``, ``first``, ``last``, ``kind``, ``bases``, ``size`` of a change's name such as ``X-58_59insG``, ``dup14_29`` or ``ins12``; null if it is none."""
    plain = F.trim(name)
    kind = "(delins|indel|dup|del|ins)"
    at = lambda p, k: F.when(F.regexp_extract(plain, p, k) != "", F.regexp_extract(plain, p, k))
    placed, spanned = f"^(?:([A-Za-z0-9]+)[-:])?([0-9]+)(?:_([0-9]+))?{kind}([ACGT]*)$", f"^(?:([A-Za-z0-9]+)[-:])?{kind}([0-9]+)(?:_([0-9]+))?$"
    one = F.struct(
        at(placed, 1).alias("motif"), at(placed, 2).try_cast("int").alias("first"), F.coalesce(at(placed, 3), at(placed, 2)).try_cast("int").alias("last"), at(placed, 4).alias("kind"),
        at(placed, 5).alias("bases"), F.lit(None).cast("int").alias("size"),
    )
    span = F.regexp_extract(plain, spanned, 4) != ""
    two = F.struct(
        at(spanned, 1).alias("motif"), F.when(span, at(spanned, 3).try_cast("int")).alias("first"), F.when(span, at(spanned, 4).try_cast("int")).alias("last"), at(spanned, 2).alias("kind"),
        F.lit(None).cast("string").alias("bases"), F.when(~span, at(spanned, 3).try_cast("int")).alias("size"),
    )
    return F.when(plain.rlike(placed), one).when(plain.rlike(spanned), two)


def without_motif(name: Column) -> Column:
    """A change's name without the motif before it."""
    return F.regexp_replace(F.trim(name), "^[A-Za-z]+[0-9]*[-:](?=[0-9]|d|i)", "")
