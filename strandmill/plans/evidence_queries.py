"""Queries of the evidence operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandmill.operators import cohort, evidence, lengths, unit_profiles
from strandmill.plans.length_queries import _BIAS, _READS
from strandmill.plans.unit_queries import _PROFILE
from strandmill.sources import load_table

#: Keys an analyzer document may have at its top.
DOCUMENT_KEYS = ("sample", "haplotypes", "arbiter_length", "scaffold")


def _hist(spark: SparkSession, folder: str) -> DataFrame:
    return lengths.length_histogram(lengths.first_deliveries(load_table(spark, folder, "read_copies")))


def _stated(spark: SparkSession, folder: str) -> DataFrame:
    sheet = load_table(spark, folder, "cohort_sheet")
    other = F.when(F.abs(F.col("a1") - F.col("mut_len")) <= F.abs(F.col("a2") - F.col("mut_len")), F.col("a2")).otherwise(F.col("a1"))
    return sheet.select("row_id", cohort.subject_key(F.col("sample")).alias("sample_id"), "mut_len", other.alias("other_len"))


def critical_counts(spark: SparkSession, folder: str) -> DataFrame:
    return evidence.critical_counts(load_table(spark, folder, "review_features").select(F.col("tot").alias("n")))


def empirical_null(spark: SparkSession, folder: str) -> DataFrame:
    return evidence.trimmed_null(unit_profiles.unit_profile(unit_profiles.decoded_units(load_table(spark, folder, "analyzer_json")), "run"), "run")


def allele_assignment(spark: SparkSession, folder: str) -> DataFrame:
    return evidence.allele_assignment(_hist(spark, folder), _stated(spark, folder))


def length_guardrail(spark: SparkSession, folder: str) -> DataFrame:
    return evidence.length_guardrail(_hist(spark, folder))


def minor_fraction(spark: SparkSession, folder: str) -> DataFrame:
    return evidence.minor_fraction(_hist(spark, folder))


def nearest_length(spark: SparkSession, folder: str) -> DataFrame:
    return evidence.nearest_lengths(_stated(spark, folder).withColumnRenamed("mut_len", "length"), _hist(spark, folder))


def length_bias_calibration(spark: SparkSession, folder: str) -> DataFrame:
    return evidence.bias_calibration(lengths.length_bias(lengths.call_peaks(_hist(spark, folder))))


def strand_gates(spark: SparkSession, folder: str) -> DataFrame:
    return evidence.strand_gates(load_table(spark, folder, "analyzer_json"))


def contig_checks(spark: SparkSession, folder: str) -> DataFrame:
    return evidence.contig_checks(load_table(spark, folder, "analyzer_json"))


def json_unknown_keys(spark: SparkSession, folder: str) -> DataFrame:
    return evidence.unknown_keys(load_table(spark, folder, "analyzer_json"), DOCUMENT_KEYS)


QUERIES = {
    f.__name__: f
    for f in (
        critical_counts, empirical_null, allele_assignment, length_guardrail, minor_fraction, nearest_length, length_bias_calibration, strand_gates, contig_checks,
        json_unknown_keys,
    )
}

_STATED = """stated AS (SELECT row_id, regexp_replace(coalesce(sample, ''), '_minimap2.*$', '') AS sample_id, mut_len, CASE WHEN abs(a1 - mut_len) <= abs(a2 - mut_len) THEN a2 ELSE a1 END AS other_len FROM cohort_sheet)"""
_HAPS = """valid AS (SELECT file_id, any_value(body::JSON) AS j FROM analyzer_json WHERE json_valid(body) GROUP BY file_id),
h AS (SELECT file_id, coalesce(nullif(j->'$.haplotypes', 'null'), j->'$.result.haplotypes') AS h FROM valid),
lists AS (SELECT file_id, CASE WHEN json_type(h) = 'ARRAY' THEN from_json(h, '["JSON"]') WHEN json_extract(h, '$.motifs') IS NOT NULL OR json_extract(h, '$.rank') IS NOT NULL THEN [h]
    WHEN json_type(h) = 'OBJECT' THEN json_extract(h, '$.*') END AS l FROM h),
haps AS (SELECT file_id, unnest(range(1, len(l) + 1))::INT AS hap_no, unnest(l) AS x FROM lists)"""

ORACLE = {
    "critical_counts": """WITH n AS (SELECT DISTINCT tot AS n FROM review_features WHERE tot >= 0),
t AS (SELECT n, unnest(range(0, n + 1)) AS i FROM n),
p AS (SELECT n, i, exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.02) + (n - i) * ln(0.98)) AS a, exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.3) + (n - i) * ln(0.7)) AS b FROM t),
s AS (SELECT n, i, sum(a) OVER w AS ta, sum(b) OVER w AS tb FROM p WINDOW w AS (PARTITION BY n ORDER BY i DESC)),
k AS (SELECT n, coalesce(min(i) FILTER (ta < 0.05), n + 1)::INT AS crit_k FROM s GROUP BY n)
SELECT k.n, crit_k, coalesce(round(least(tb, 1.0), 6), 0.0) AS power FROM k LEFT JOIN s ON s.n = k.n AND s.i = k.crit_k""",
    "empirical_null": f"""WITH {_PROFILE},
ranked AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY frac, unit) AS r, count(*) OVER (PARTITION BY run) AS m FROM profile),
kept AS (SELECT * FROM ranked WHERE r <= greatest(3, round_even(m * 0.9, 0))),
sums AS (SELECT run, count(*) AS units, sum(tot) AS n, (sum(n_mut) + 0.5) / (sum(tot) + 1.0) AS f FROM kept GROUP BY run),
chi AS (SELECT run, sum(pow(n_mut - tot * f, 2) / (tot * f * (1 - f))) AS chi2 FROM kept JOIN sums USING (run) GROUP BY run)
SELECT run, units, round(f, 6) AS f_null, round(coalesce(CASE WHEN units >= 3 AND n / units > 1 THEN least(greatest((chi2 / units - 1) / (n / units - 1), 0), 0.5) ELSE 0 END, 0), 6) AS rho FROM sums JOIN chi USING (run)""",
    "allele_assignment": f"""WITH {_READS}, {_STATED}
SELECT row_id, coalesce(sum(n) FILTER (abs(mut_len - other_len) >= 5 AND abs(copies - mut_len) <= abs(copies - other_len)), 0)::BIGINT AS n_mut,
  coalesce(sum(n) FILTER (abs(mut_len - other_len) >= 5 AND abs(copies - mut_len) > abs(copies - other_len)), 0)::BIGINT AS n_other,
  coalesce(sum(n) FILTER (abs(mut_len - other_len) < 5), 0)::BIGINT AS n_ambiguous
FROM stated JOIN hist USING (sample_id) WHERE mut_len IS NOT NULL AND other_len IS NOT NULL GROUP BY row_id""",
    "length_guardrail": f"""WITH {_READS}, ranked AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY n DESC, copies) AS r FROM hist)
SELECT sample_id, max(n) AS top, min(n) AS tenth, count(*) AS lengths, max(n) >= 20 AND NOT (count(*) >= 5 AND max(n) < 1.5 * min(n)) AS is_reliable FROM ranked WHERE r <= 10 GROUP BY sample_id""",
    "minor_fraction": f"""WITH {_READS}, ranked AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY n DESC, copies) AS r FROM hist)
SELECT sample_id, round(max(n) FILTER (r = 2) / sum(n), 6) AS minor_fraction FROM ranked GROUP BY sample_id""",
    "nearest_length": f"""WITH {_READS}, {_STATED} SELECT row_id, arg_min(copies, (abs(copies - mut_len), copies)) AS nearest, min(abs(copies - mut_len)) AS distance
FROM stated JOIN hist USING (sample_id) WHERE mut_len IS NOT NULL GROUP BY row_id""",
    "length_bias_calibration": f"""WITH {_BIAS} SELECT count(*) AS n_samples, round(exp(sum(delta * ln(count2 / count1)) / sum(delta * delta)), 4) AS pooled, round(median(bias), 4) AS median,
  round(median(bias) FILTER (delta <= 20), 4) AS median_small, round(median(bias) FILTER (delta >= 33), 4) AS median_large FROM bias""",
    "strand_gates": f"""WITH {_HAPS}, c AS (SELECT file_id, hap_no, (x->>'$.coverage.n_reads')::INT AS n_reads, (x->>'$.coverage.n_fwd')::INT AS n_fwd, (x->>'$.coverage.n_rev')::INT AS n_rev FROM haps)
SELECT *, CASE WHEN n_fwd + n_rev > 0 THEN round(least(n_fwd, n_rev) / (n_fwd + n_rev), 3) END AS balance, n_reads >= 5 AND least(n_fwd, n_rev) >= 2 AS is_covered FROM c WHERE n_fwd IS NOT NULL AND n_rev IS NOT NULL""",
    "contig_checks": f"""WITH {_HAPS}, c AS (SELECT file_id, hap_no, TRY_CAST(regexp_extract(x->>'$.contig', '_([0-9]+)repeats', 1) AS INT) AS contig_units, (x->>'$.n_motifs')::INT AS n_motifs,
  CASE WHEN json_type(x->'$.motifs') = 'VARCHAR' THEN (x->>'$.motifs')::JSON ELSE x->'$.motifs' END AS m FROM haps),
r AS (SELECT file_id, hap_no, contig_units, n_motifs, coalesce(len(list_filter(from_json(CASE WHEN json_type(m) = 'ARRAY' THEN m END, '["JSON"]'), lambda e: json_type(e) <> 'NULL')), 0)::INT AS motif_rows FROM c)
SELECT * FROM r WHERE contig_units <> n_motifs OR n_motifs <> motif_rows""",
    "json_unknown_keys": """WITH k AS (SELECT DISTINCT file_id, unnest(json_keys(body)) AS field FROM analyzer_json WHERE json_valid(body))
SELECT * FROM k WHERE field NOT IN ('sample', 'haplotypes', 'arbiter_length', 'scaffold')""",
}
