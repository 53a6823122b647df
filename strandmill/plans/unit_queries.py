"""Queries of the unit operators over ``analyzer_json`` and ``motif_ref``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strandmill.operators import alignments
from strandmill.operators import unit_profiles as u
from strandmill.sources import load_table


def _units(spark: SparkSession, folder: str) -> DataFrame:
    return u.decoded_units(load_table(spark, folder, "analyzer_json"))


def decoded_units(spark: SparkSession, folder: str) -> DataFrame:
    return _units(spark, folder)


def unit_profile(spark: SparkSession, folder: str) -> DataFrame:
    return u.unit_profile(_units(spark, folder), "run")


def longest_block(spark: SparkSession, folder: str) -> DataFrame:
    return u.longest_blocks(u.unit_profile(_units(spark, folder), "run"), "run")


def focality(spark: SparkSession, folder: str) -> DataFrame:
    return u.focality(u.unit_profile(_units(spark, folder), "run"), "run")


def loo_null_fraction(spark: SparkSession, folder: str) -> DataFrame:
    return u.leave_one_out(u.unit_profile(_units(spark, folder), "run"), "run")


def positional_decision(spark: SparkSession, folder: str) -> DataFrame:
    """Per run and haplotype rank, over the units of all haplotypes of that run."""
    return u.positional_test(u.unit_profile(_units(spark, folder), "run", "hap_rank"), "run", "hap_rank")


def net_indel_per_unit(spark: SparkSession, folder: str) -> DataFrame:
    return u.length_changes(_units(spark, folder))


def frameshift_variants(spark: SparkSession, folder: str) -> DataFrame:
    return u.length_changes(_units(spark, folder), frame_only=True)


def frameshift_focal(spark: SparkSession, folder: str) -> DataFrame:
    return u.focal_calls(_units(spark, folder))


def novel_motifs(spark: SparkSession, folder: str) -> DataFrame:
    return u.novel_units(_units(spark, folder), load_table(spark, folder, "motif_ref"))


#: Copies of one unit within one haplotype.
COPIES = ("file_id", "hap_no", "name")


def consensus_plurality(spark: SparkSession, folder: str) -> DataFrame:
    return u.plurality_consensus(u.base_counts(_units(spark, folder), *COPIES), *COPIES)


def phasing_snps(spark: SparkSession, folder: str) -> DataFrame:
    return u.phasing_places(u.base_counts(_units(spark, folder), *COPIES), *COPIES)


def _phased(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    units = _units(spark, folder).filter("length(sequence) = 60 and name is not null")
    places = u.phasing_places(u.base_counts(units, *COPIES), *COPIES)
    return units, places, alignments.phase_reads(units, places, *COPIES)


def phased_copies(spark: SparkSession, folder: str) -> DataFrame:
    """The copies of a unit in a haplotype, in two phases by the places at which they differ."""
    return _phased(spark, folder)[2]


def phasing_concordance(spark: SparkSession, folder: str) -> DataFrame:
    units, places, phased = _phased(spark, folder)
    return alignments.phase_concordance(units, places, phased, *COPIES, least=2)


def homopolymer_runs(spark: SparkSession, folder: str) -> DataFrame:
    return u.homopolymers(_units(spark, folder))


QUERIES = {
    f.__name__: f
    for f in (
        decoded_units, unit_profile, longest_block, focality, loo_null_fraction, positional_decision, net_indel_per_unit, frameshift_variants,
        frameshift_focal, novel_motifs, consensus_plurality, phasing_snps, phased_copies, phasing_concordance, homopolymer_runs,
    )
}

_UNITS = """valid AS (SELECT file_id, any_value(body::JSON) AS j FROM analyzer_json WHERE json_valid(body) GROUP BY file_id),
h AS (SELECT file_id, coalesce(nullif(j->'$.haplotypes', 'null'), j->'$.result.haplotypes') AS h FROM valid),
lists AS (SELECT file_id, CASE WHEN json_type(h) = 'ARRAY' THEN from_json(h, '["JSON"]')
    WHEN json_extract(h, '$.motifs') IS NOT NULL OR json_extract(h, '$.rank') IS NOT NULL THEN [h]
    WHEN json_type(h) = 'OBJECT' THEN json_extract(h, '$.*') END AS l FROM h),
haps AS (SELECT file_id, unnest(range(1, len(l) + 1)) AS hap_no, unnest(l) AS x FROM lists),
texts AS (SELECT file_id, hap_no, (x->>'$.rank')::INT AS hap_rank, CASE WHEN json_type(x->'$.motifs') = 'VARCHAR' THEN (x->>'$.motifs')::JSON ELSE x->'$.motifs' END AS m FROM haps),
stored AS (SELECT file_id, hap_no, hap_rank, list_filter(from_json(CASE WHEN json_type(m) = 'ARRAY' THEN m END, '["JSON"]'), lambda e: json_type(e) <> 'NULL') AS l FROM texts),
motifs AS (SELECT file_id, hap_no, hap_rank, unnest(range(1, len(l) + 1)) AS motif_no, unnest(l) AS e FROM stored),
placed AS (SELECT file_id, hap_no, hap_rank, motif_no, trim(e->>'$.name') AS name, (e->>'$.pos')::INT AS pos, (e->>'$.length')::INT AS length, upper(trim(e->>'$.sequence')) AS sequence,
  row_number() OVER (PARTITION BY file_id, hap_no, (e->>'$.pos')::INT ORDER BY motif_no) AS r FROM motifs),
runs AS (SELECT file_id, min(run) AS run FROM analyzer_json GROUP BY file_id),
units AS (SELECT p.file_id, run, hap_no, hap_rank, row_number() OVER (PARTITION BY p.file_id, hap_no ORDER BY pos) AS unit, name, pos, length, length - 60 AS net, sequence
  FROM placed p JOIN runs USING (file_id) WHERE r = 1 AND pos IS NOT NULL AND length IS NOT NULL)"""
_PROFILE = f"""{_UNITS},
profile AS (SELECT run, unit, count(*) AS tot, count(*) FILTER (net <> 0) AS n_mut, round(count(*) FILTER (net <> 0) / count(*), 4) AS frac FROM units GROUP BY run, unit)"""
_COUNTS = f"""{_UNITS},
letters AS (SELECT file_id, hap_no, name, unnest(range(1, 61)) AS place, unnest(string_split(sequence, '')) AS base FROM units WHERE length(sequence) = 60 AND name IS NOT NULL),
counts AS (SELECT file_id, hap_no, name, place, base, count(*) AS n FROM letters GROUP BY ALL),
ranked AS (SELECT *, sum(n) OVER (PARTITION BY file_id, hap_no, name, place) AS depth, row_number() OVER (PARTITION BY file_id, hap_no, name, place ORDER BY n DESC, base) AS r FROM counts)"""
_PHASED = f"""{_COUNTS},
places AS (SELECT file_id, hap_no, name, place, max(base) FILTER (r = 1) AS major, max(base) FILTER (r = 2) AS minor FROM ranked WHERE depth >= 5 GROUP BY ALL
  HAVING max(n) FILTER (r = 2) / any_value(depth) BETWEEN 0.15 AND 0.85),
bases AS (SELECT file_id, hap_no, name, unit, place, substr(sequence, place, 1) AS base, major, minor FROM units JOIN places USING (file_id, hap_no, name) WHERE length(sequence) = 60),
scores AS (SELECT file_id, hap_no, name, unit, round(avg(CASE WHEN base = minor THEN 1.0 WHEN base = major THEN 0.0 END), 4) AS score FROM bases GROUP BY ALL HAVING score IS NOT NULL),
levels AS (SELECT file_id, hap_no, name, score, count(*) AS n, round(score * 10000)::BIGINT AS x FROM scores GROUP BY ALL),
sums AS (SELECT *, sum(n) OVER w AS i, sum(n * x) OVER w AS s, sum(n) OVER g AS tn, sum(n * x) OVER g AS ts FROM levels
  WINDOW w AS (PARTITION BY file_id, hap_no, name ORDER BY score), g AS (PARTITION BY file_id, hap_no, name)),
cuts AS (SELECT file_id, hap_no, name, arg_min(score, (-round(s::DOUBLE * s::DOUBLE / i + (ts - s)::DOUBLE * (ts - s)::DOUBLE / (tn - i), 3), score)) AS cut FROM sums WHERE i < tn GROUP BY ALL),
phased AS (SELECT s.*, CASE WHEN score > cut THEN 'B' ELSE 'A' END AS phase FROM scores s LEFT JOIN cuts USING (file_id, hap_no, name))"""

ORACLE = {
    "decoded_units": f"WITH {_UNITS} SELECT * FROM units",
    "unit_profile": f"WITH {_PROFILE} SELECT * FROM profile",
    "longest_block": f"""WITH {_PROFILE},
islands AS (SELECT *, unit - row_number() OVER (PARTITION BY run ORDER BY unit) AS island FROM profile WHERE frac >= 0.035),
blocks AS (SELECT run, count(*) AS block_len, min(unit) AS block_start, max(unit) AS block_end, max(frac) AS block_max FROM islands GROUP BY run, island)
SELECT run, block_len, block_start, block_end, block_max FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY block_len DESC, block_start) AS r FROM blocks) WHERE r = 1""",
    "focality": f"""WITH {_PROFILE},
base AS (SELECT run, max(frac) AS peak, arg_min(unit, (-frac, unit)) AS peak_unit, median(frac) AS med FROM profile GROUP BY run)
SELECT run, any_value(peak_unit) AS peak_unit, any_value(peak) AS peak_frac, round(any_value(med), 4) AS median_frac,
  CASE WHEN any_value(med) > 0 THEN round(any_value(peak) / any_value(med), 3) END AS ratio, count(*) FILTER (frac >= peak / 2) AS n_above_half
FROM profile JOIN base USING (run) GROUP BY run""",
    "loo_null_fraction": f"""WITH {_PROFILE} SELECT run, unit, tot, n_mut, frac,
  greatest(0.0001, (sum(n_mut) OVER w - n_mut + 0.5) / (sum(tot) OVER w - tot + 1.0)) AS f_null, (sum(tot) OVER w - tot)::BIGINT AS null_obs FROM profile WINDOW w AS (PARTITION BY run)""",
    "positional_decision": f"""WITH {_UNITS},
profile AS (SELECT run, hap_rank, unit, count(*) AS tot, count(*) FILTER (net <> 0) AS n_mut, round(count(*) FILTER (net <> 0) / count(*), 4) AS frac FROM units GROUP BY ALL),
nulls AS (SELECT *, greatest(0.0001, (sum(n_mut) OVER w - n_mut + 0.5) / (sum(tot) OVER w - tot + 1.0)) AS f FROM profile WINDOW w AS (PARTITION BY run, hap_rank)),
tested AS (SELECT *, count(*) OVER (PARTITION BY run, hap_rank) AS n_tests FROM nulls WHERE tot >= 15),
tails AS (SELECT run, hap_rank, unit, tot, n_mut, frac, n_tests, CASE WHEN n_mut <= 0 THEN 1.0 ELSE
  (SELECT sum(exp(lgamma(tot + 1) - lgamma(i + 1) - lgamma(tot - i + 1) + i * ln(f) + (tot - i) * ln(1 - f))) FROM (SELECT unnest(range(n_mut, tot + 1)) AS i)) END AS p FROM tested),
scored AS (SELECT *, round(least(1.0, p * n_tests), 6) AS p_bonf FROM tails)
SELECT run, hap_rank, unit, tot, n_mut, frac, n_tests, p_bonf, p_bonf <= 0.001 AND frac >= 0.1 AND n_mut >= 4 AS called
FROM (SELECT *, row_number() OVER (PARTITION BY run, hap_rank ORDER BY p_bonf, frac DESC, unit) AS r FROM scored) WHERE r = 1""",
    "net_indel_per_unit": f"WITH {_UNITS} SELECT file_id, hap_no, hap_rank, unit, name, net FROM units WHERE net <> 0",
    "frameshift_variants": f"WITH {_UNITS} SELECT file_id, hap_no, hap_rank, unit, name, net FROM units WHERE net % 3 <> 0",
    "frameshift_focal": f"""WITH {_UNITS},
per AS (SELECT file_id, hap_no, count(*) AS n_units, count(*) FILTER (net % 3 <> 0) AS n_shifted, min(unit) FILTER (net % 3 <> 0) AS first_unit, sum(abs(net)) AS burden FROM units GROUP BY 1, 2)
SELECT file_id, hap_no, n_units, n_shifted, burden::BIGINT AS burden, n_shifted >= 3 AND n_shifted > 0.15 * n_units AS is_array_wide,
  CASE WHEN NOT (n_shifted >= 3 AND n_shifted > 0.15 * n_units) THEN first_unit END AS unit FROM per""",
    "novel_motifs": f"""WITH {_UNITS},
seen AS (SELECT sequence, count(*) AS occurrences, count(DISTINCT (file_id, hap_no)) AS haplotypes FROM units
  WHERE length(sequence) = 60 AND sequence NOT IN (SELECT seq FROM motif_ref) GROUP BY sequence),
near AS (SELECT s.*, motif_name, hamming(sequence, seq) AS d FROM seen s, motif_ref WHERE length(seq) = 60)
SELECT sequence, occurrences, haplotypes, motif_name AS closest, d AS distance FROM (SELECT *, row_number() OVER (PARTITION BY sequence ORDER BY d, motif_name) AS r FROM near) WHERE r = 1""",
    "consensus_plurality": f"WITH {_COUNTS} SELECT file_id, hap_no, name, place, base, depth::BIGINT AS depth, round(n / depth, 4) AS share FROM ranked WHERE r = 1 AND depth >= 3",
    "phasing_snps": f"""WITH {_COUNTS} SELECT file_id, hap_no, name, place, max(base) FILTER (r = 1) AS major_base, max(base) FILTER (r = 2) AS minor_base, any_value(depth)::BIGINT AS depth,
  round(max(n) FILTER (r = 2) / any_value(depth), 4) AS minor_share FROM ranked WHERE depth >= 5 GROUP BY ALL HAVING max(n) FILTER (r = 2) / any_value(depth) BETWEEN 0.15 AND 0.85""",
    "phased_copies": f"WITH {_PHASED} SELECT * FROM phased",
    "phasing_concordance": f"""WITH {_PHASED},
c AS (SELECT file_id, hap_no, name, place, phase, base, count(*) AS n FROM bases JOIN phased USING (file_id, hap_no, name, unit) GROUP BY ALL),
m AS (SELECT file_id, hap_no, name, place, phase, sum(n) AS depth, arg_min(base, (-n, base)) AS base, max(n) AS top FROM c GROUP BY ALL),
p AS (SELECT file_id, hap_no, name, place, max(base) FILTER (phase = 'A' AND depth >= 2 AND top >= 0.8 * depth) AS a, max(base) FILTER (phase = 'B' AND depth >= 2 AND top >= 0.8 * depth) AS b FROM m GROUP BY ALL)
SELECT file_id, hap_no, name, count(*) AS n_places, count(*) FILTER (a <> b) AS n_concordant FROM p GROUP BY ALL""",
    "homopolymer_runs": f"""WITH {_UNITS},
distincts AS (SELECT DISTINCT sequence FROM units WHERE sequence <> ''),
letters AS (SELECT sequence, unnest(range(1, length(sequence) + 1)) AS i, unnest(string_split(sequence, '')) AS base FROM distincts),
islands AS (SELECT *, i - row_number() OVER (PARTITION BY sequence, base ORDER BY i) AS island FROM letters)
SELECT sequence, min(i) AS start, base, count(*) AS len FROM islands GROUP BY sequence, base, island HAVING count(*) >= 3""",
}
