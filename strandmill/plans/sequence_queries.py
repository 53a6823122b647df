"""Queries of the sequence, alignment, decoding, scaffold and streaming operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandmill.operators import cohort, decoding, lengths, nested_records, scaffolds, unit_profiles
from strandmill.plans.data_quality import _TABLES
from strandmill.plans.length_queries import _PEAKS, _READS
from strandmill.plans.unit_queries import _COUNTS, COPIES
from strandmill.sources import load_table
from strandmill.streaming import read_counts


def motif_decode(spark: SparkSession, folder: str) -> DataFrame:
    return decoding.decode(nested_records.nested_tables(load_table(spark, folder, "analyzer_json")).haplotypes, load_table(spark, folder, "motif_ref"))


def _hist(spark: SparkSession, folder: str) -> DataFrame:
    return lengths.length_histogram(lengths.first_deliveries(load_table(spark, folder, "read_copies")))


def _stated(spark: SparkSession, folder: str) -> DataFrame:
    return load_table(spark, folder, "cohort_sheet").select("row_id", cohort.subject_key(F.col("sample")).alias("sample_id"), "a1", "a2")


def read_concentration(spark: SparkSession, folder: str) -> DataFrame:
    return scaffolds.read_concentration(_hist(spark, folder))


def scaffold_for_lengths(spark: SparkSession, folder: str) -> DataFrame:
    return scaffolds.scaffolds_for_lengths(_hist(spark, folder), _stated(spark, folder))


def length_congruence(spark: SparkSession, folder: str) -> DataFrame:
    return scaffolds.length_congruence(lengths.call_peaks(_hist(spark, folder)), _stated(spark, folder))


def length_comparison(spark: SparkSession, folder: str) -> DataFrame:
    return scaffolds.length_comparison(lengths.call_peaks(_hist(spark, folder)), _stated(spark, folder))


def minvar_split(spark: SparkSession, folder: str) -> DataFrame:
    rows = load_table(spark, folder, "review_features").filter("repeat_index is not null")
    return scaffolds.min_variance_cut(rows, "repeat_index", "frac_8c")


def snp_genotype(spark: SparkSession, folder: str) -> DataFrame:
    """Places of the copies of a unit within a haplotype."""
    return scaffolds.genotypes(unit_profiles.base_counts(unit_profiles.decoded_units(load_table(spark, folder, "analyzer_json")), *COPIES), *COPIES)


def streaming_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return read_counts.run_counts(read_counts.read_stream(spark, folder), read_counts.new_folder(spark))


QUERIES = {
    f.__name__: f
    for f in (
        motif_decode, read_concentration, scaffold_for_lengths, length_congruence, length_comparison, minvar_split,
        snp_genotype, streaming_histogram,
    )
}

_STATED = "stated AS (SELECT row_id, regexp_replace(coalesce(sample, ''), '_minimap2.*$', '') AS sample_id, a1, a2 FROM cohort_sheet)"

ORACLE = {
    # one unit or one base further with each step; all units of the list have 60 bases
    "motif_decode": f"""WITH RECURSIVE {_TABLES},
texts AS (SELECT file_id, hap_no, upper(x->>'$.consensus') AS t FROM haps WHERE x->>'$.consensus' <> ''),
known AS (SELECT list({{'n': motif_name, 's': upper(seq)}} ORDER BY motif_name) AS k FROM motif_ref WHERE seq <> ''),
steps AS (SELECT file_id, hap_no, t, 0 AS place, 0 AS unit, NULL::VARCHAR AS name, NULL::INT AS pos, NULL::INT AS d FROM texts
  UNION ALL
  SELECT file_id, hap_no, t, CASE WHEN b.d <= 3 THEN place + 60 ELSE place + 1 END, CASE WHEN b.d <= 3 THEN unit + 1 ELSE unit END, CASE WHEN b.d <= 3 THEN b.n END, CASE WHEN b.d <= 3 THEN place END, b.d
  FROM (SELECT file_id, hap_no, t, place, unit, list_sort(list_transform(k, lambda r: {{'d': CASE WHEN length(t) >= place + 60 THEN hamming(substr(t, place + 1, 60), r.s) ELSE 99 END, 'n': r.n}}))[1] AS b
    FROM steps, known WHERE place < length(t)))
SELECT file_id, hap_no, unit, name, pos, 60 AS length, d::INT AS mismatches FROM steps WHERE name IS NOT NULL""",
    "read_concentration": f"""WITH {_READS}, ranked AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY n DESC, copies) AS r FROM hist)
SELECT sample_id, sum(n)::BIGINT AS n_reads, sum(n) FILTER (r <= 2)::BIGINT AS n_top2, round(sum(n) FILTER (r <= 2) / sum(n), 4) AS share FROM ranked GROUP BY sample_id""",
    "scaffold_for_lengths": f"""WITH {_READS}, {_STATED},
one AS (SELECT row_id, arg_min(copies, (abs(copies - a1) > 5, -n, abs(copies - a1), copies)) AS scaffold1 FROM stated JOIN hist USING (sample_id) WHERE a1 IS NOT NULL GROUP BY row_id),
first AS (SELECT s.*, scaffold1 FROM stated s LEFT JOIN one USING (row_id)),
two AS (SELECT row_id, arg_min(copies, (abs(copies - a2) > 5, -n, abs(copies - a2), copies)) AS scaffold2 FROM first JOIN hist USING (sample_id)
  WHERE a2 IS NOT NULL AND (scaffold1 IS NULL OR copies <> scaffold1) GROUP BY row_id)
SELECT f.*, scaffold2 FROM first f LEFT JOIN two USING (row_id)""",
    "length_congruence": f"""WITH {_PEAKS}, {_STATED},
l AS (SELECT row_id, s.sample_id, list_sort(list_filter([a1, a2], lambda v: v IS NOT NULL)) AS x, list_sort(list_filter([allele1, allele2], lambda v: v IS NOT NULL)) AS y FROM stated s LEFT JOIN called c USING (sample_id)),
d AS (SELECT row_id, sample_id, CASE WHEN least(len(x), len(y)) >= 2 THEN greatest(abs(x[1] - y[1]), abs(x[2] - y[2])) WHEN least(len(x), len(y)) = 1 THEN abs(x[1] - y[1]) END AS max_delta FROM l)
SELECT *, CASE WHEN max_delta IS NULL THEN 'INSUFFICIENT' WHEN max_delta <= 1 THEN 'CONCORDANT' WHEN max_delta = 4 THEN 'OFFSET_SUSPECT' WHEN max_delta <= 3 THEN 'SPREAD' ELSE 'DIVERGENT' END AS status FROM d""",
    "length_comparison": f"""WITH {_PEAKS}, {_STATED},
l AS (SELECT row_id, s.sample_id, list_sort(list_filter([a1, a2], lambda v: v IS NOT NULL)) AS x, list_sort(list_filter([allele1, allele2], lambda v: v IS NOT NULL)) AS y FROM stated s LEFT JOIN called c USING (sample_id)),
d AS (SELECT *, list_transform(range(1, least(len(x), len(y)) + 1), lambda k: x[k] - y[k]) AS d, list_filter(x, lambda a: len(list_filter(y, lambda b: abs(a - b) <= 4.5)) = 0) AS m FROM l)
SELECT row_id, sample_id, CASE WHEN len(d) > 0 THEN array_to_string(m, ',') END AS missing, CASE WHEN len(d) = 0 THEN 'INSUFFICIENT' WHEN list_min(d) >= 3.5 AND list_max(d) <= 4.5 OR list_max(d) <= -3.5 AND list_min(d) >= -4.5 THEN 'OFFSET_SUSPECT'
  WHEN len(m) > 0 THEN 'ALLELE_MISSING' WHEN greatest(list_max(d), -list_min(d)) <= 1 THEN 'CONCORDANT' WHEN greatest(list_max(d), -list_min(d)) <= 3 THEN 'SPREAD' ELSE 'DIVERGENT' END AS status FROM d""",
    "minvar_split": """WITH c AS (SELECT repeat_index, round(frac_8c, 4) AS v, count(*) AS n FROM review_features WHERE repeat_index IS NOT NULL AND frac_8c IS NOT NULL GROUP BY 1, 2),
s AS (SELECT *, sum(n) OVER w AS i, sum(n * round(v * 10000)::BIGINT) OVER w AS s, sum(n) OVER (PARTITION BY repeat_index) AS tn, sum(n * round(v * 10000)::BIGINT) OVER (PARTITION BY repeat_index) AS ts
  FROM c WINDOW w AS (PARTITION BY repeat_index ORDER BY v)),
g AS (SELECT *, round(s::DOUBLE * s::DOUBLE / i + (ts - s)::DOUBLE * (ts - s)::DOUBLE / (tn - i), 3) AS gain FROM s WHERE i < tn)
SELECT repeat_index, v AS cut, i::BIGINT AS n_low, (tn - i)::BIGINT AS n_high FROM (SELECT *, row_number() OVER (PARTITION BY repeat_index ORDER BY gain DESC, v) AS r FROM g) WHERE r = 1""",
    "snp_genotype": f"""WITH {_COUNTS}, p AS (SELECT file_id, hap_no, name, place, any_value(depth)::BIGINT AS depth, max(base) FILTER (r = 1) AS major, max(base) FILTER (r = 2) AS minor,
  coalesce(max(n) FILTER (r = 2), 0) AS n2 FROM ranked GROUP BY ALL)
SELECT file_id, hap_no, name, place, depth, major, minor, round(n2 / depth, 4) AS minor_share, CASE WHEN depth < 5 THEN 'low_depth' WHEN n2 / depth BETWEEN 0.2 AND 0.8 THEN 'het' ELSE 'hom' END AS genotype FROM p""",
    "streaming_histogram": f"WITH {_READS} SELECT * FROM hist",
}
