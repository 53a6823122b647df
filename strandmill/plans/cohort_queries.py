"""Queries of the evaluation, statistics and score operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandmill.functions import tails
from strandmill.functions.bounded import collect_bounded
from strandmill.operators import cohort, lengths
from strandmill.plans.data_quality import SCORE_SQL, score_table
from strandmill.plans.length_queries import _PEAKS
from strandmill.sources import load_table


def subject_ids(spark: SparkSession, folder: str) -> DataFrame:
    sheet = load_table(spark, folder, "cohort_sheet")
    return sheet.select("row_id", cohort.subject_key(F.col("sample")).alias("subject"), cohort.substrate_of(F.col("file")).alias("substrate_by_name"))


def truth_row_checks(spark: SparkSession, folder: str) -> DataFrame:
    return cohort.row_checks(load_table(spark, folder, "cohort_sheet"))


def truth_confusion_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Records' calls against the sheet's status, by substrate and over all."""
    found = load_table(spark, folder, "review_features").select(cohort.subject_key(F.col("sample")).alias("subject"), F.col("has_mut").cast("int").alias("m"))
    called = found.groupBy("subject").agg((F.max("m") == 1).alias("predicted"))
    sheet = load_table(spark, folder, "cohort_sheet").select("row_id", "substrate", "status", cohort.subject_key(F.col("sample")).alias("subject"))
    return cohort.confusion(sheet.join(called, "subject").withColumn("outcome", cohort.outcome(F.col("predicted"), F.col("status"))), "substrate")


def paired_2x2(spark: SparkSession, folder: str) -> DataFrame:
    return cohort.paired_subjects(load_table(spark, folder, "cohort_sheet"))


def pon_aggregate(spark: SparkSession, folder: str) -> DataFrame:
    return cohort.pooled_panel(load_table(spark, folder, "review_features"), "substrate")


def pon_lookup(spark: SparkSession, folder: str) -> DataFrame:
    features = load_table(spark, folder, "review_features").select("feature_id", "substrate", "n8c", "tot", "has_mut")
    return cohort.with_panel(features, cohort.pooled_panel(features, "substrate"), "substrate").select("feature_id", "substrate", "f_panel")


def _counts(spark: SparkSession, folder: str) -> DataFrame:
    return load_table(spark, folder, "review_features").filter("tot >= 0 and n8c >= 0 and n8c <= tot").select("feature_id", F.col("n8c").alias("k"), F.col("tot").alias("n"), F.col("f_null").alias("f"))


def binom_tail(spark: SparkSession, folder: str) -> DataFrame:
    return _counts(spark, folder).select("feature_id", F.round(tails.binom_tail(F.col("k"), F.col("n"), F.col("f")), 6).alias("p"))


def betabinom_tail(spark: SparkSession, folder: str, rho: float = 0.01) -> DataFrame:
    held = _counts(spark, folder).filter("f > 0 and f < 1")
    a, b = F.col("f") * (1 - rho) / rho, (1 - F.col("f")) * (1 - rho) / rho
    return held.select("feature_id", F.round(tails.betabinom_tail(F.col("k"), F.col("n"), a, b), 6).alias("p"))


def wilson_ci(spark: SparkSession, folder: str) -> DataFrame:
    low, high = tails.wilson(F.col("k"), F.col("n"))
    return _counts(spark, folder).select("feature_id", F.round(low, 6).alias("low"), F.round(high, 6).alias("high"))


def posterior_hotspot(spark: SparkSession, folder: str) -> DataFrame:
    held = _counts(spark, folder).filter("f > 0 and f < 1")
    return held.select("feature_id", F.round(tails.posterior(F.col("k"), F.col("n"), 0.3, 0.3, F.col("f")), 6).alias("posterior"))


def fisher_right(spark: SparkSession, folder: str) -> DataFrame:
    """Per subject and repeat the changed tracts of one haplotype against the other's."""
    rows = load_table(spark, folder, "review_features").filter("tot >= n8c and n8c >= 0 and hp in ('1', '2') and repeat_index is not null")
    side = lambda h, x: F.coalesce(F.sum(F.when(F.col("hp") == h, x)), F.lit(0))
    table = rows.groupBy(cohort.subject_key(F.col("sample")).alias("subject"), "repeat_index").agg(
        side("1", F.col("n8c")).alias("a"), side("1", F.col("tot") - F.col("n8c")).alias("b"), side("2", F.col("n8c")).alias("c"), side("2", F.col("tot") - F.col("n8c")).alias("d")
    )
    return table.withColumn("p", F.round(tails.fisher_right(*(F.col(x) for x in "abcd")), 6))


def fs_tail_score(spark: SparkSession, folder: str) -> DataFrame:
    return cohort.tail_scores(score_table(spark, folder))


def variant_family(spark: SparkSession, folder: str) -> DataFrame:
    families = [r[0] for r in collect_bounded(load_table(spark, folder, "variant_ref").select("variant").filter("variant is not null"), 1_000)]
    sheet = load_table(spark, folder, "cohort_sheet").filter("variant_raw is not null")
    return sheet.select("row_id", cohort.variant_family(F.col("variant_raw"), families).alias("family"))


def depth_capped_reads(spark: SparkSession, folder: str) -> DataFrame:
    return cohort.depth_capped(lengths.first_deliveries(load_table(spark, folder, "read_copies")), 200).select("sample_id", "read_id", "copies")


def carrier_inference(spark: SparkSession, folder: str) -> DataFrame:
    calls = lengths.call_peaks(lengths.length_histogram(lengths.first_deliveries(load_table(spark, folder, "read_copies"))))
    rows = load_table(spark, folder, "review_features").filter("tot > 0 and has_mut")
    shares = rows.groupBy(cohort.subject_key(F.col("sample")).alias("sample_id")).agg((F.sum("n8c") / F.sum("tot")).alias("share"))
    return cohort.carrier_allele(calls, shares).withColumn("share", F.round("share", 6))


QUERIES = {
    f.__name__: f
    for f in (
        subject_ids, truth_row_checks, truth_confusion_rollup, paired_2x2, pon_aggregate, pon_lookup, binom_tail, betabinom_tail, wilson_ci,
        posterior_hotspot, fisher_right, fs_tail_score, variant_family, depth_capped_reads, carrier_inference,
    )
}

_C = "lower(status) IN ('pos', 'positive', 'positif', 'carrier')"
_N = "lower(status) IN ('neg', 'negative', 'negatif', 'négatif')"
_SUBJECT = "regexp_replace(coalesce(sample, ''), '_minimap2.*$', '')"
_K = "counts AS (SELECT feature_id, n8c AS k, tot AS n, f_null AS f FROM review_features WHERE tot >= 0 AND n8c >= 0 AND n8c <= tot)"

ORACLE = {
    "subject_ids": f"SELECT row_id, {_SUBJECT} AS subject, CASE WHEN regexp_matches(file, 'T2T-clean', 'i') THEN 't2t_clean' ELSE 'raw_fastq' END AS substrate_by_name FROM cohort_sheet",
    "truth_row_checks": f"""WITH c AS (SELECT * FROM cohort_sheet WHERE {_C})
SELECT row_id, 'no_variant' AS violation FROM c WHERE lower(trim(coalesce(variant, ''))) IN ('', 'false', 'true', 'nan', 'none')
UNION ALL SELECT row_id, 'no_mut_len' FROM c WHERE mut_len IS NULL
UNION ALL SELECT row_id, 'mut_len_far' FROM c WHERE least(abs(mut_len - a1), abs(mut_len - a2)) > 3""",
    "truth_confusion_rollup": f"""WITH called AS (SELECT {_SUBJECT} AS subject, max(has_mut::INT) = 1 AS predicted FROM review_features GROUP BY 1),
scored AS (SELECT substrate, CASE WHEN {_C} AND predicted THEN 'TP' WHEN {_C} AND NOT predicted THEN 'FN' WHEN {_N} AND predicted THEN 'FP'
  WHEN {_N} AND NOT predicted THEN 'TN' END AS o FROM cohort_sheet s JOIN called c ON c.subject = regexp_replace(coalesce(s.sample, ''), '_minimap2.*$', '')),
counted AS (SELECT substrate, grouping(substrate)::BIGINT AS level, count(*) FILTER (o = 'TP') AS tp, count(*) FILTER (o = 'FN') AS fn, count(*) FILTER (o = 'FP') AS fp, count(*) FILTER (o = 'TN') AS tn
  FROM scored GROUP BY ROLLUP (substrate))
SELECT *, round(tp / greatest(tp + fn, 1), 4) AS sens, round(tn / greatest(tn + fp, 1), 4) AS spec FROM counted""",
    "paired_2x2": f"""WITH keyed AS (SELECT {_SUBJECT} AS subject, substrate, ({_C}) AS carrier, ({_C} OR {_N}) AS known FROM cohort_sheet)
SELECT *, carrier_raw_fastq = carrier_t2t_clean AS agree FROM (SELECT subject, count(*) FILTER (substrate = 'raw_fastq') AS n_raw_fastq, count(*) FILTER (substrate = 't2t_clean') AS n_t2t_clean,
  max(carrier::INT) FILTER (substrate = 'raw_fastq' AND known) AS carrier_raw_fastq, max(carrier::INT) FILTER (substrate = 't2t_clean' AND known) AS carrier_t2t_clean
  FROM keyed WHERE subject <> '' GROUP BY subject) WHERE n_raw_fastq > 0 AND n_t2t_clean > 0""",
    "pon_aggregate": """SELECT substrate, count(*) AS n_records, sum(tot)::BIGINT AS n_tracts, round(sum(n8c) / sum(tot), 6) AS f_pooled, round(avg(n8c / tot), 6) AS f_mean,
  round(stddev_pop(n8c / tot), 6) AS f_sd, round(max(n8c / tot), 6) AS f_max FROM review_features WHERE NOT has_mut AND tot > 0 AND n8c IS NOT NULL GROUP BY substrate""",
    "pon_lookup": """WITH panel AS (SELECT substrate, sum(tot) AS n_tracts, round(sum(n8c) / sum(tot), 6) AS f_pooled FROM review_features
  WHERE NOT has_mut AND tot > 0 AND n8c IS NOT NULL GROUP BY substrate)
SELECT feature_id, r.substrate, coalesce(CASE WHEN n_tracts >= 30 THEN f_pooled END, 0.02) AS f_panel FROM review_features r LEFT JOIN panel p ON p.substrate = r.substrate""",
    "binom_tail": f"""WITH {_K} SELECT feature_id, CASE WHEN k IS NULL OR n IS NULL OR f IS NULL THEN NULL WHEN k <= 0 THEN 1.0 WHEN f <= 0 THEN 0.0 WHEN f >= 1 THEN 1.0 ELSE
  round(least(1.0, (SELECT sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(f) + (n - i) * ln(1 - f))) FROM (SELECT unnest(range(k, n + 1)) AS i))), 6) END AS p FROM counts""",
    "betabinom_tail": f"""WITH {_K}, ab AS (SELECT *, f * 0.99 / 0.01 AS a, (1 - f) * 0.99 / 0.01 AS b FROM counts WHERE f > 0 AND f < 1)
SELECT feature_id, CASE WHEN k <= 0 THEN 1.0 ELSE round(least(1.0, (SELECT sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + lgamma(i + a) + lgamma(n - i + b) - lgamma(n + a + b)
  + lgamma(a + b) - lgamma(a) - lgamma(b))) FROM (SELECT unnest(range(k, n + 1)) AS i))), 6) END AS p FROM ab""",
    "wilson_ci": f"""WITH {_K}, parts AS (SELECT *, k / nullif(n, 0)::DOUBLE AS q FROM counts)
SELECT feature_id, CASE WHEN n = 0 THEN 0.0 ELSE round(greatest((q + 3.8416 / (2.0 * n) - 1.96 * sqrt(q * (1 - q) / n + 3.8416 / (4.0 * n * n))) / (1 + 3.8416 / n), 0.0), 6) END AS low,
  CASE WHEN n = 0 THEN 1.0 ELSE round(least((q + 3.8416 / (2.0 * n) + 1.96 * sqrt(q * (1 - q) / n + 3.8416 / (4.0 * n * n))) / (1 + 3.8416 / n), 1.0), 6) END AS high FROM parts""",
    "posterior_hotspot": f"""WITH {_K} SELECT feature_id, round(1 / (1 + exp(-least(greatest(k * ln(0.3 / f) + (n - k) * ln(0.7 / (1 - f)) + ln(0.3 / 0.7), -700), 700))), 6) AS posterior
FROM counts WHERE f > 0 AND f < 1""",
    "fisher_right": f"""WITH t AS (SELECT {_SUBJECT} AS subject, repeat_index, coalesce(sum(n8c) FILTER (hp = '1'), 0)::BIGINT AS a, coalesce(sum(tot - n8c) FILTER (hp = '1'), 0)::BIGINT AS b,
  coalesce(sum(n8c) FILTER (hp = '2'), 0)::BIGINT AS c, coalesce(sum(tot - n8c) FILTER (hp = '2'), 0)::BIGINT AS d
  FROM review_features WHERE tot >= n8c AND n8c >= 0 AND hp IN ('1', '2') AND repeat_index IS NOT NULL GROUP BY 1, 2),
m AS (SELECT *, a + b AS r, a + c AS col, a + b + c + d AS n FROM t)
SELECT subject, repeat_index, a, b, c, d, CASE WHEN r = 0 OR c + d = 0 OR col = 0 OR b + d = 0 THEN 1.0 ELSE round(least(1.0, (SELECT sum(exp(lgamma(r + 1) - lgamma(i + 1) - lgamma(r - i + 1)
  + lgamma(n - r + 1) - lgamma(col - i + 1) - lgamma(n - r - col + i + 1) - lgamma(n + 1) + lgamma(col + 1) + lgamma(n - col + 1))) FROM (SELECT unnest(range(a, least(r, col) + 1)) AS i))), 6) END AS p FROM m""",
    # the normal distribution by its series
    "fs_tail_score": f"""WITH {SCORE_SQL},
t AS (SELECT file_id, row_no, sample, mut_len, healthy_len, mut_len - position AS tail, (mut_len - position - {cohort.TAIL_MEAN}) / {cohort.TAIL_SD} AS z FROM score),
e AS (SELECT *, CASE WHEN abs(z) > 8 THEN (z > 0)::INT::DOUBLE ELSE 0.5 + (SELECT sum((CASE WHEN k % 2 = 0 THEN 1 ELSE -1 END) * pow(z, 2 * k + 1) * exp(-k * ln(2.0) - lgamma(k + 1)) / (2 * k + 1)) FROM (SELECT unnest(range(0, 130)) AS k)) / sqrt(2 * pi()) END AS p FROM t)
SELECT file_id, row_no, sample, tail, round(mut_len / nullif(healthy_len, 0), 3) AS ratio, round(tail / nullif(mut_len, 0), 4) AS tail_index, round(z, 3) AS z, round(p, 4) AS percentile,
  CASE WHEN p < 0.1 THEN 'very mild' WHEN p < 0.5 THEN 'mild' WHEN p <= 0.9 THEN 'severe' WHEN p > 0.9 THEN 'very severe' END AS class FROM e""",
    "variant_family": """WITH ref AS (SELECT list({'k': lower(variant), 'v': variant} ORDER BY length(variant) DESC, variant) AS l FROM variant_ref WHERE variant IS NOT NULL),
plain AS (SELECT row_id, lower(regexp_replace(variant_raw, '[^0-9A-Za-z_]', '', 'g')) AS p FROM cohort_sheet WHERE variant_raw IS NOT NULL)
SELECT row_id, list_filter(l, lambda r: contains(p, r.k))[1].v AS family FROM plain, ref""",
    "depth_capped_reads": """WITH reads AS (SELECT sample_id, read_id, any_value(copies) AS copies FROM read_copies GROUP BY 1, 2)
SELECT sample_id, read_id, copies FROM (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY md5(read_id), read_id) AS r FROM reads) WHERE r <= 200""",
    "carrier_inference": f"""WITH {_PEAKS},
shares AS (SELECT {_SUBJECT} AS sample_id, sum(n8c) / sum(tot) AS share FROM review_features WHERE tot > 0 AND has_mut GROUP BY 1),
far AS (SELECT c.*, share, greatest(share / (count1 / (count1 + count2)), count1 / (count1 + count2) / share) AS d1, greatest(share / (count2 / (count1 + count2)), count2 / (count1 + count2) / share) AS d2
  FROM called c JOIN shares USING (sample_id) WHERE allele2 IS NOT NULL AND share > 0)
SELECT sample_id, round(share, 6) AS share, CASE WHEN d1 <= d2 THEN allele1 ELSE allele2 END AS carrier_allele, least(d1, d2) <= 2.5 AND greatest(d1, d2) > 1.5 * least(d1, d2) AS is_confident FROM far""",
}
