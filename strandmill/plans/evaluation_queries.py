"""Queries of the evaluation operators over ``cohort_sheet``, ``review_features``, ``score_rows``, ``read_copies`` and ``analyzer_json``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandmill.operators import cohort, evaluation, lengths, unit_profiles
from strandmill.operators.nested_records import in_order, nested_tables, parse_records
from strandmill.plans.evidence_queries import _HAPS
from strandmill.plans.length_queries import _READS
from strandmill.plans.unit_queries import _UNITS
from strandmill.sources import load_table


def _sheet(spark: SparkSession, folder: str) -> DataFrame:
    return load_table(spark, folder, "cohort_sheet")


def _features(spark: SparkSession, folder: str) -> DataFrame:
    return load_table(spark, folder, "review_features")


def _subject() -> Column:
    return cohort.subject_key(F.col("sample"))


def share_rank_sum(spark: SparkSession, folder: str) -> DataFrame:
    """Whether records with a change have greater shares than those without."""
    return evaluation.rank_sum(_features(spark, folder), F.col("has_mut"), F.col("frac_8c"))


def length_rank_correlation(spark: SparkSession, folder: str) -> DataFrame:
    """Rank correlation of a record's length and its share, by substrate."""
    return evaluation.rank_correlation(_features(spark, folder), F.col("vntr_len").cast("double"), F.col("frac_8c"), "substrate")


def variant_scores(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.score_calls(_sheet(spark, folder), evaluation.best_records(_features(spark, folder), _subject()), _subject())


def miss_table(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.miss_table(_sheet(spark, folder), _features(spark, folder), _subject())


def misses_by_length(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.misses_by_length(miss_table(spark, folder))


def motif_consistency(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.motif_consistency(_features(spark, folder))


def change_parts(spark: SparkSession, folder: str) -> DataFrame:
    """The parts of every name in the sheet's ``variant``, and whether it is an attested one."""
    named = _sheet(spark, folder).filter("variant is not null")
    return named.withColumn("c", evaluation.change_parts(F.col("variant"))).select(
        "row_id", *(F.col(f"c.{x}").alias(x) for x in ("motif", "first", "last", "kind", "bases", "size")), F.col("variant").rlike(evaluation.ATTESTED).alias("is_attested")
    )


def _hist(spark: SparkSession, folder: str) -> DataFrame:
    return lengths.length_histogram(lengths.first_deliveries(load_table(spark, folder, "read_copies")))


def modal_lengths(spark: SparkSession, folder: str) -> DataFrame:
    return lengths.modal_lengths(_hist(spark, folder))


def best_windows(spark: SparkSession, folder: str) -> DataFrame:
    return lengths.best_windows(_hist(spark, folder))


def longest_peaks(spark: SparkSession, folder: str) -> DataFrame:
    return lengths.longest_peaks(_hist(spark, folder))


def reads_near_allele(spark: SparkSession, folder: str) -> DataFrame:
    stated = _sheet(spark, folder).select("row_id", _subject().alias("sample_id"), F.col("a1").alias("length"))
    return lengths.reads_near(_hist(spark, folder), stated)


def haplotype_strings(spark: SparkSession, folder: str) -> DataFrame:
    """Each haplotype's unit names in order, and its changes of length with their units: those that shift the frame, and the others."""
    haps = parse_records(load_table(spark, folder, "analyzer_json")).select("file_id", F.explode("haps").alias("h"))
    held = haps.select("file_id", F.col("h.hap_no").alias("hap_no"), in_order(F.filter("h.motifs", lambda m: m["length"].isNotNull())).alias("m")).filter(F.size("m") > 0)
    net = lambda m: m["length"] - unit_profiles.UNIT
    listed = lambda keep: F.array_join(F.filter(F.transform("m", lambda m, i: F.when(keep(net(m)), F.concat(F.trim(m["name"]), F.lit(" ~ repeat "), (i + 1).cast("string")))), lambda x: x.isNotNull()), " ; ")
    return held.select(
        "file_id", "hap_no", F.array_join(F.transform("m", lambda m: F.trim(m["name"])), "-").alias("units"), listed(lambda n: n % 3 != 0).alias("shifts"), listed(lambda n: (n != 0) & (n % 3 == 0)).alias("in_frame"),
    )


def unit_at_place(spark: SparkSession, folder: str, place: int = 1_000) -> DataFrame:
    """The unit of each haplotype that spans one place of its contig."""
    units = unit_profiles.decoded_units(load_table(spark, folder, "analyzer_json"))
    return units.filter((F.col("pos") <= place) & (F.lit(place) < F.col("pos") + F.col("length"))).select("file_id", "hap_no", "unit", "name")


def top_haplotypes(spark: SparkSession, folder: str) -> DataFrame:
    """The haplotype of most reads of each file, and that of most exact units among those at least half exact; the first of equals."""
    haps = nested_tables(load_table(spark, folder, "analyzer_json")).haplotypes
    exact = F.when((F.col("motif_rows") > 0) & (F.col("n_exact") >= 0.5 * F.col("motif_rows")), F.col("n_exact"))
    return haps.groupBy("file_id").agg(
        F.min_by("hap_no", F.struct(-F.coalesce("read_count", F.lit(-1)), "hap_no")).alias("most_reads"), F.min_by(F.when(exact.isNotNull(), F.col("hap_no")), F.struct(-F.coalesce(exact, F.lit(-1)), "hap_no")).alias("most_exact")
    )


QUERIES = {
    f.__name__: f
    for f in (
        share_rank_sum, length_rank_correlation, variant_scores, miss_table, misses_by_length, motif_consistency, change_parts, modal_lengths, best_windows, longest_peaks,
        reads_near_allele, haplotype_strings, unit_at_place, top_haplotypes,
    )
}

_C = "lower(status) IN ('pos', 'positive', 'positif', 'carrier')"
_SUBJECT = "regexp_replace(coalesce(sample, ''), '_minimap2.*$', '')"
_MISSES = f"""per AS (SELECT {_SUBJECT} AS subject, count(*) FILTER (tot > 0) AS n_tested, count(*) FILTER (tot >= 20) AS n_powered, max(tot) AS max_cover,
  arg_max({{'n': n8c, 'f': frac_8c}}, (coalesce(n8c, -1), feature_id)) AS b, max(has_mut::INT) AS called FROM review_features GROUP BY 1),
misses AS (SELECT row_id, {_SUBJECT} AS subject, mut_len, CASE WHEN mut_len < 50 THEN '<50' WHEN mut_len < 70 THEN '50-69' WHEN mut_len IS NOT NULL THEN '>=70' END AS length_class,
  coalesce(n_tested, 0) AS n_tested, coalesce(n_powered, 0) AS n_powered, max_cover, b.n AS best_count, b.f AS best_frac,
  CASE WHEN called IS NULL THEN 'NO_OUTPUT' WHEN called = 1 THEN 'CALLED' ELSE 'MISSED' END AS outcome
  FROM cohort_sheet s LEFT JOIN per ON per.subject = regexp_replace(coalesce(s.sample, ''), '_minimap2.*$', '') WHERE {_C})"""
_PLACED_NAME, _SPAN_NAME = "^(?:([A-Za-z0-9]+)[-:])?([0-9]+)(?:_([0-9]+))?(delins|indel|dup|del|ins)([ACGT]*)$", "^(?:([A-Za-z0-9]+)[-:])?(delins|indel|dup|del|ins)([0-9]+)(?:_([0-9]+))?$"

ORACLE = {
    "share_rank_sum": """WITH c AS (SELECT has_mut AS g, round(frac_8c, 4) AS v FROM review_features WHERE has_mut IS NOT NULL AND frac_8c IS NOT NULL),
m AS (SELECT v, count(*) AS m FROM c GROUP BY v), r AS (SELECT v, m, coalesce(sum(m) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + (m + 1) / 2.0 AS rank FROM m),
s AS (SELECT count(*) FILTER (g) AS n1, count(*) FILTER (NOT g) AS n2, sum(rank) FILTER (g)::DOUBLE AS r1, (SELECT sum(m * m * m - m)::DOUBLE FROM r) AS ties FROM c JOIN r USING (v)),
z AS (SELECT n1, n2, r1 - n1 * (n1 + 1) / 2 AS u, (r1 - n1 * (n1 + 1) / 2 - n1 * n2 / 2) / sqrt(n1 * n2 / 12.0 * (n1 + n2 + 1 - ties / ((n1 + n2)::DOUBLE * (n1 + n2 - 1)))) AS z FROM s),
tail AS (SELECT *, abs(z) / sqrt(2) AS x FROM z)
SELECT n1, n2, u, round(z, 4) AS z, CASE WHEN abs(z) > 6 THEN CASE WHEN z > 0 THEN 0.0 ELSE 1.0 END ELSE round(CASE WHEN z > 0 THEN e / 2 ELSE 1 - e / 2 END, 6) END AS p
FROM (SELECT *, 1 - 2 / sqrt(pi()) * (SELECT sum((CASE WHEN k % 2 = 0 THEN 1 ELSE -1 END) * exp((2 * k + 1) * ln(greatest(x, 1e-12)) - lgamma(k + 1)) / (2 * k + 1)) FROM (SELECT unnest(range(0, 90)) AS k)) AS e FROM tail)""",
    "length_rank_correlation": """WITH c AS (SELECT substrate, vntr_len AS x, round(frac_8c, 4) AS y FROM review_features WHERE vntr_len IS NOT NULL AND frac_8c IS NOT NULL AND substrate IS NOT NULL),
r AS (SELECT substrate, rank() OVER (PARTITION BY substrate ORDER BY x) + (count(*) OVER (PARTITION BY substrate, x) - 1) / 2.0 AS rx, rank() OVER (PARTITION BY substrate ORDER BY y) + (count(*) OVER (PARTITION BY substrate, y) - 1) / 2.0 AS ry FROM c)
SELECT substrate, count(*) AS n, round(CASE WHEN var_pop(rx) > 0 AND var_pop(ry) > 0 THEN corr(rx, ry) END, 6) AS rho FROM r GROUP BY substrate""",
    "variant_scores": f"""WITH held AS (SELECT {_SUBJECT} AS subject, variant, repeat_index, frac_8c, feature_id FROM review_features WHERE has_mut AND variant IS NOT NULL),
best AS (SELECT subject, variant, repeat_index FROM (SELECT *, row_number() OVER (PARTITION BY subject ORDER BY coalesce(frac_8c, 0) DESC, feature_id) AS r FROM held WHERE subject <> '') WHERE r = 1),
carriers AS (SELECT row_id, {_SUBJECT} AS subject, trim(variant) AS stated, variant_pos FROM cohort_sheet WHERE {_C})
SELECT row_id, CASE WHEN coalesce(stated, '') = '' THEN NULL WHEN b.variant IS NULL THEN 'missed' WHEN b.variant = stated THEN 'match' ELSE 'wrong_family' END AS variant_score,
  repeat_index - variant_pos AS place_delta, abs(repeat_index - variant_pos) <= 2 AS is_near FROM carriers c LEFT JOIN best b USING (subject)""",
    "miss_table": f"WITH {_MISSES} SELECT * FROM misses",
    "misses_by_length": f"""WITH {_MISSES} SELECT length_class, count(*) AS n_rows, count(*) FILTER (outcome = 'CALLED') AS n_called, round(avg((outcome = 'CALLED')::INT), 4) AS rate,
  min(best_frac) FILTER (outcome = 'CALLED') AS least_called, max(best_frac) FILTER (outcome = 'CALLED') AS most_called, max(best_frac) FILTER (outcome <> 'CALLED') AS most_missed FROM misses GROUP BY 1""",
    "motif_consistency": """WITH held AS (SELECT * FROM review_features WHERE has_mut AND variant IS NOT NULL),
places AS (SELECT variant, repeat_index, count(*) AS n FROM held WHERE repeat_index IS NOT NULL GROUP BY ALL),
mode AS (SELECT variant, arg_min(repeat_index, (-n, repeat_index)) AS place, max(n) / sum(n) AS c FROM places GROUP BY variant),
middle AS (SELECT variant, list_sort(list(vntr_len)) AS l FROM held WHERE vntr_len IS NOT NULL GROUP BY variant)
SELECT h.variant, count(*) AS n_records, count(DISTINCT hp) AS n_haplotypes, any_value(place) AS place, round(any_value(c), 4) AS concentration, any_value(l[len(l) // 2 + 1]) AS median_len, any_value(c) >= 0.5 AS is_confident
FROM held h LEFT JOIN mode USING (variant) LEFT JOIN middle USING (variant) GROUP BY h.variant HAVING count(*) >= 5""",
    "change_parts": f"""WITH n AS (SELECT row_id, trim(variant) AS v FROM cohort_sheet WHERE variant IS NOT NULL),
p AS (SELECT row_id, v, regexp_extract(v, '{_PLACED_NAME}', ['motif', 'a', 'b', 'kind', 'bases']) AS x, regexp_extract(v, '{_SPAN_NAME}', ['motif', 'kind', 'a', 'b']) AS y FROM n)
SELECT row_id, nullif(CASE WHEN x.kind <> '' THEN x.motif ELSE y.motif END, '') AS motif, CASE WHEN x.kind <> '' THEN TRY_CAST(x.a AS INT) WHEN y.b <> '' THEN TRY_CAST(y.a AS INT) END AS first,
  CASE WHEN x.kind <> '' THEN TRY_CAST(coalesce(nullif(x.b, ''), x.a) AS INT) WHEN y.b <> '' THEN TRY_CAST(y.b AS INT) END AS last, nullif(CASE WHEN x.kind <> '' THEN x.kind ELSE y.kind END, '') AS kind,
  nullif(x.bases, '') AS bases, CASE WHEN x.kind = '' AND y.kind <> '' AND y.b = '' THEN TRY_CAST(y.a AS INT) END AS size,
  regexp_matches(v, '59dupC([^C]|$)|58_59delCC|52dupG|58_59insG|8_27del') AS is_attested FROM p""",
    "modal_lengths": f"""WITH {_READS}, r AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY n DESC, copies DESC) AS r FROM hist),
t AS (SELECT sample_id, max(copies) FILTER (r = 1) AS mode, max(n) FILTER (r = 1) AS n_mode, coalesce(max(n) FILTER (r = 2), 0) AS n2 FROM r GROUP BY sample_id)
SELECT sample_id, mode, n_mode, n_mode >= 5 AND n2 / n_mode < 0.25 AS is_single FROM t""",
    "best_windows": f"""WITH {_READS}, w AS (SELECT a.sample_id, a.copies, sum(b.n) AS s, arg_min(b.copies, (-b.n, b.copies)) AS mode FROM hist a JOIN hist b ON a.sample_id = b.sample_id AND b.copies BETWEEN a.copies - 2 AND a.copies + 2 GROUP BY ALL)
SELECT sample_id, copies AS center, s::BIGINT AS n_window, mode FROM (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY s DESC, copies) AS r FROM w) WHERE r = 1""",
    "longest_peaks": f"""WITH {_READS}, t AS (SELECT sample_id, sum(n) AS n_reads FROM hist GROUP BY 1),
s AS (SELECT a.sample_id, a.copies, sum(b.n) AS s FROM hist a JOIN hist b ON a.sample_id = b.sample_id AND abs(b.copies - a.copies) <= 2 GROUP BY ALL),
p AS (SELECT a.sample_id, a.copies, a.s, max(b.s) AS top FROM s a JOIN s b ON a.sample_id = b.sample_id AND abs(b.copies - a.copies) <= 6 GROUP BY ALL)
SELECT sample_id, max(copies) AS longest, count(*) AS n_peaks FROM p JOIN t USING (sample_id) WHERE s >= top AND s >= greatest(6, 0.05 * n_reads) GROUP BY sample_id""",
    "reads_near_allele": f"""WITH {_READS}, stated AS (SELECT row_id, {_SUBJECT} AS sample_id, a1 AS length FROM cohort_sheet WHERE a1 IS NOT NULL)
SELECT row_id, coalesce(sum(n) FILTER (abs(copies - length) <= 4), 0)::BIGINT AS n_near, sum(n)::BIGINT AS n_reads FROM stated JOIN hist USING (sample_id) GROUP BY row_id""",
    "haplotype_strings": f"""WITH {_UNITS} SELECT file_id, hap_no, string_agg(name, '-' ORDER BY unit) AS units, coalesce(string_agg(name || ' ~ repeat ' || unit, ' ; ' ORDER BY unit) FILTER (net % 3 <> 0), '') AS shifts,
  coalesce(string_agg(name || ' ~ repeat ' || unit, ' ; ' ORDER BY unit) FILTER (net <> 0 AND net % 3 = 0), '') AS in_frame FROM units GROUP BY file_id, hap_no""",
    "unit_at_place": f"WITH {_UNITS} SELECT file_id, hap_no, unit, name FROM units WHERE pos <= 1000 AND 1000 < pos + length",
    "top_haplotypes": f"""WITH {_HAPS}, c AS (SELECT file_id, hap_no, TRY_CAST(x->>'$.read_count' AS INT) AS reads, TRY_CAST(x->>'$.n_exact' AS INT) AS n_exact,
  CASE WHEN json_type(x->'$.motifs') = 'VARCHAR' THEN (x->>'$.motifs')::JSON ELSE x->'$.motifs' END AS m FROM haps),
r AS (SELECT *, coalesce(len(list_filter(from_json(CASE WHEN json_type(m) = 'ARRAY' THEN m END, '["JSON"]'), lambda e: json_type(e) <> 'NULL')), 0) AS n FROM c)
SELECT file_id, arg_min(hap_no, (-coalesce(reads, -1), hap_no)) AS most_reads, arg_min(hap_no, (-n_exact, hap_no)) FILTER (n > 0 AND n_exact >= 0.5 * n) AS most_exact FROM r GROUP BY file_id""",
}
