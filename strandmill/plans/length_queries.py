"""Queries of the length operators over ``read_copies`` and ``cohort_sheet``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandmill.operators import lengths
from strandmill.sources import load_table


def _reads(spark: SparkSession, folder: str) -> DataFrame:
    return lengths.first_deliveries(load_table(spark, folder, "read_copies"))


def _hist(spark: SparkSession, folder: str, *by: str) -> DataFrame:
    return lengths.length_histogram(_reads(spark, folder), *by)


def read_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return _reads(spark, folder)


def length_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return _hist(spark, folder)


def call_alleles_peaks(spark: SparkSession, folder: str) -> DataFrame:
    return lengths.call_peaks(_hist(spark, folder))


def pick_two_scored(spark: SparkSession, folder: str) -> DataFrame:
    return lengths.pick_two(_hist(spark, folder))


def alleles_lowcount_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return lengths.low_count_clusters(_hist(spark, folder))


def split_two_means(spark: SparkSession, folder: str) -> DataFrame:
    return lengths.split_two_means(_hist(spark, folder))


def alleles_by_hp(spark: SparkSession, folder: str) -> DataFrame:
    return lengths.alleles_by_haplotype(_hist(spark, folder, "hp"))


def length_bias_fit(spark: SparkSession, folder: str) -> DataFrame:
    return lengths.length_bias(lengths.call_peaks(_hist(spark, folder)))


def detectable_delta(spark: SparkSession, folder: str) -> DataFrame:
    calls = lengths.call_peaks(_hist(spark, folder))
    return lengths.detectable_delta(lengths.length_bias(calls), calls)


def platform_vote(spark: SparkSession, folder: str) -> DataFrame:
    return lengths.run_platforms(load_table(spark, folder, "read_copies"))


def length_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    sheet = load_table(spark, folder, "cohort_sheet").select("row_id", F.regexp_replace("sample", "_minimap2.*$", "").alias("sample_id"), "a1", "a2")
    return lengths.length_accuracy(lengths.call_peaks(_hist(spark, folder)), sheet)


QUERIES = {
    f.__name__: f
    for f in (
        read_dedup, length_histogram, call_alleles_peaks, pick_two_scored, alleles_lowcount_clusters, split_two_means, alleles_by_hp,
        length_bias_fit, detectable_delta, platform_vote, length_accuracy,
    )
}

_READS = """reads AS (SELECT sample_id, read_id, copies, hp, run, read_at FROM (SELECT *, row_number() OVER (PARTITION BY sample_id, read_id
  ORDER BY loaded_at, coalesce(copies, -1), coalesce(hp, '')) AS r FROM read_copies) WHERE r = 1),
hist AS (SELECT sample_id, copies, count(*) AS n FROM reads WHERE copies IS NOT NULL GROUP BY ALL)"""
_PEAKS = f"""{_READS},
totals AS (SELECT sample_id, sum(n) AS n_reads, min(copies) AS low, max(copies) AS high FROM hist GROUP BY 1),
axis AS (SELECT sample_id, unnest(range(low - 4, high + 5)) AS c FROM totals),
smoothed AS (SELECT a.sample_id, a.c, coalesce(sum(h.n), 0) AS s FROM axis a LEFT JOIN hist h
  ON h.sample_id = a.sample_id AND h.copies BETWEEN a.c - 2 AND a.c + 2 GROUP BY ALL),
tops AS (SELECT *, max(s) OVER (PARTITION BY sample_id ORDER BY c RANGE BETWEEN 4 PRECEDING AND 4 FOLLOWING) AS top FROM smoothed),
peaks AS (SELECT t.sample_id, c, s FROM tops t JOIN totals USING (sample_id)
  WHERE c BETWEEN low AND high AND s >= greatest(6, round_even(0.006 * n_reads, 0)) AND s >= top),
main AS (SELECT sample_id, c, s FROM (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY s DESC, c DESC) AS r FROM peaks) WHERE r = 1),
longer AS (SELECT sample_id, c, s FROM (SELECT p.*, row_number() OVER (PARTITION BY p.sample_id ORDER BY p.s DESC, p.c DESC) AS r
  FROM peaks p JOIN main m ON p.sample_id = m.sample_id AND p.c >= m.c + 8) WHERE r = 1),
called AS (SELECT t.sample_id, t.n_reads::BIGINT AS n_reads, m.c::INT AS allele1, m.s::BIGINT AS count1, l.c::INT AS allele2, l.s::BIGINT AS count2,
  l.c IS NOT NULL AND l.s < greatest(0.02 * n_reads, 15) AS long_low_conf
  FROM totals t LEFT JOIN main m USING (sample_id) LEFT JOIN longer l USING (sample_id))"""
_BIAS = f"""{_PEAKS},
bias AS (SELECT sample_id, allele2 - allele1 AS delta, count1, count2,
  round(least(pow(count2 / count1::DOUBLE, 1.0 / (allele2 - allele1)), 1.0), 4) AS bias FROM called WHERE allele2 IS NOT NULL AND count1 > 0 AND count2 > 0)"""

ORACLE = {
    "read_dedup": f"WITH {_READS} SELECT * FROM reads",
    "length_histogram": f"WITH {_READS} SELECT * FROM hist",
    "call_alleles_peaks": f"WITH {_PEAKS} SELECT * FROM called",
    "pick_two_scored": f"""WITH {_READS},
near AS (SELECT h.sample_id, h.copies, h.n, coalesce(max(CASE WHEN o.copies = h.copies - 1 THEN o.n END), 0) AS l,
  coalesce(max(CASE WHEN o.copies = h.copies + 1 THEN o.n END), 0) AS r, (sum(o.n) - any_value(h.n)) AS around
  FROM hist h JOIN hist o ON o.sample_id = h.sample_id AND o.copies BETWEEN h.copies - 3 AND h.copies + 3 GROUP BY h.sample_id, h.copies, h.n),
peaks AS (SELECT *, n / (around / 6.0 + 1.0) AS contrast FROM near
  WHERE n >= 5 AND (n >= greatest(l, r) OR (l > n AND n >= 0.4 * l) OR (r > n AND n >= 0.4 * r))),
mains AS (SELECT *, first_value(copies) OVER (PARTITION BY sample_id ORDER BY n DESC, copies) AS main FROM peaks),
scored AS (SELECT *, floor(contrast * n * pow(10.0, copies / main::DOUBLE - 1.0) * CASE WHEN copies IN (44, 70) THEN 0.9 ELSE 1.0 END * 10 + 0.5) / 10 AS score FROM mains),
ranked AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY score DESC, copies) AS place, count(*) OVER (PARTITION BY sample_id) AS n_peaks FROM scored),
best AS (SELECT sample_id, max(n_peaks) AS n_peaks, min(round(contrast, 2)) AS least, max(copies) FILTER (place = 1) AS a1, max(n) FILTER (place = 1) AS c1,
  max(score) FILTER (place = 1) AS s1, max(copies) FILTER (place = 2) AS a2, max(n) FILTER (place = 2) AS c2, max(score) FILTER (place = 2) AS s2
  FROM ranked WHERE place <= 2 GROUP BY sample_id)
SELECT sample_id, n_peaks, a1 AS allele1, c1 AS count1, s1 AS score1, CASE WHEN n_peaks > 1 AND least >= 3 THEN a2 END AS allele2,
  CASE WHEN n_peaks > 1 AND least >= 3 THEN c2 END AS count2, CASE WHEN n_peaks > 1 AND least >= 3 THEN s2 END AS score2 FROM best""",
    "alleles_lowcount_clusters": f"""WITH {_READS},
ordered AS (SELECT sample_id, copies, CASE WHEN copies - lag(copies) OVER (PARTITION BY sample_id ORDER BY copies, read_id) <= 3 THEN 0 ELSE 1 END AS new, read_id
  FROM reads WHERE copies IS NOT NULL),
marked AS (SELECT *, sum(new) OVER (PARTITION BY sample_id ORDER BY copies, read_id ROWS UNBOUNDED PRECEDING) AS cluster FROM ordered),
clusters AS (SELECT sample_id, cluster, count(*) AS support, round_even(median(copies), 0)::INT AS center FROM marked GROUP BY 1, 2 HAVING count(*) >= 2),
a AS (SELECT sample_id, center, support FROM (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY support DESC, center) AS r FROM clusters) WHERE r = 1),
b AS (SELECT sample_id, center, support FROM (SELECT c.*, row_number() OVER (PARTITION BY c.sample_id ORDER BY c.support DESC, c.center) AS r
  FROM clusters c JOIN a ON a.sample_id = c.sample_id AND abs(c.center - a.center) >= 8) WHERE r = 1)
SELECT a.sample_id, a.center AS allele1, a.support AS count1, CASE WHEN b.support >= 0.25 * a.support THEN b.center END AS allele2,
  CASE WHEN b.support >= 0.25 * a.support THEN b.support END AS count2 FROM a LEFT JOIN b USING (sample_id)""",
    "split_two_means": f"""WITH {_READS},
sorted AS (SELECT sample_id, copies, row_number() OVER w AS i, sum(copies::BIGINT) OVER w AS sx, count(*) OVER (PARTITION BY sample_id) AS n,
  sum(copies::BIGINT) OVER (PARTITION BY sample_id) AS tx FROM reads WHERE copies IS NOT NULL WINDOW w AS (PARTITION BY sample_id ORDER BY copies, read_id)),
cuts AS (SELECT sample_id, i, n, round(sx::DOUBLE * sx::DOUBLE / i + (tx - sx)::DOUBLE * (tx - sx)::DOUBLE / (n - i), 6) AS gain FROM sorted WHERE n >= 6 AND i BETWEEN 2 AND n - 2),
best AS (SELECT sample_id, i AS cut FROM (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY gain DESC, i) AS r FROM cuts) WHERE r = 1),
sides AS (SELECT s.sample_id, any_value(n) AS n_reads, floor(median(copies) FILTER (i <= cut))::INT AS short, floor(median(copies) FILTER (i > cut))::INT AS long,
  max(copies) FILTER (i = n // 2 + 1) AS mid FROM sorted s LEFT JOIN best USING (sample_id) GROUP BY s.sample_id)
SELECT sample_id, n_reads, coalesce(long - short >= 5, false) AS is_het, CASE WHEN coalesce(long - short >= 5, false) THEN short ELSE mid END AS allele1,
  CASE WHEN long - short >= 5 THEN long END AS allele2, CASE WHEN long - short >= 5 THEN (short + long) / 2 END AS threshold FROM sides""",
    "alleles_by_hp": f"""WITH {_READS},
medians AS (SELECT sample_id, hp, count(*) AS n, floor(median(copies))::INT AS m FROM reads WHERE copies IS NOT NULL AND hp IN ('1', '2') GROUP BY 1, 2 HAVING count(*) >= 2)
SELECT sample_id, max(m) FILTER (hp = '1') AS median_hp1, max(n) FILTER (hp = '1') AS n_hp1, max(m) FILTER (hp = '2') AS median_hp2,
  max(n) FILTER (hp = '2') AS n_hp2, max(m) - min(m) >= 8 AS is_het FROM medians GROUP BY sample_id HAVING count(*) = 2""",
    "length_bias_fit": f"WITH {_BIAS} SELECT * FROM bias",
    "detectable_delta": f"""WITH {_BIAS} SELECT sample_id, n_reads, bias, CASE WHEN n_reads <= 3 THEN 0
  ELSE greatest(0, floor(round(ln(3.0 / n_reads) / ln(bias), 9))::INT) END AS detectable_delta FROM bias JOIN called USING (sample_id) WHERE bias < 1 AND bias > 0""",
    "platform_vote": """WITH votes AS (SELECT run, CASE WHEN regexp_matches(read_id, '^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}') THEN 'ONT'
    WHEN read_id LIKE '%/ccs' THEN 'PacBio HiFi' ELSE 'unknown' END AS platform, count(*) AS n FROM read_copies GROUP BY ALL)
SELECT run, sum(n)::BIGINT AS n_reads, arg_min(platform, (-n, platform)) AS platform, max(n) AS votes FROM votes GROUP BY run""",
    "length_accuracy": f"""WITH {_PEAKS},
j AS (SELECT row_id, c.sample_id, least(a1, a2) AS t1, greatest(a1, a2) AS t2, least(allele1, allele2) AS c1, greatest(allele1, allele2) AS c2
  FROM cohort_sheet s JOIN called c ON c.sample_id = regexp_replace(s.sample, '_minimap2.*$', '') WHERE (a1 IS NOT NULL OR a2 IS NOT NULL) AND allele1 IS NOT NULL)
SELECT row_id, sample_id, greatest(abs(t1 - c1), abs(t2 - c2)) = 0 AS is_exact, greatest(abs(t1 - c1), abs(t2 - c2)) <= 1 AS is_within, c2 - t2 AS long_delta FROM j""",
}
