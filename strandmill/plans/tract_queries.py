"""Queries of measures, tracts, contexts and alignments over the decoded haplotypes of ``analyzer_json`` and the units of ``motif_ref``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandmill.functions import cigar, sequences
from strandmill.functions.bounded import collect_bounded
from strandmill.operators import alignments, tracts, unit_profiles
from strandmill.plans.unit_queries import _UNITS
from strandmill.sources import load_table

#: The tract that is followed: bases between two contexts of the units, and its usual length.
LEFT, BASE, RIGHT, USUAL = "TAA", "G", "C", 3
#: What starts most units' second third; the distance between two is a unit's length.
CONTEXT = "GGGTAAG"


def _anchor(spark: SparkSession, folder: str, name: str) -> str:
    (seq,) = (r[0] for r in collect_bounded(load_table(spark, folder, "motif_ref").filter(F.col("motif_name") == name).select("seq"), 1))
    return seq


def _reads(spark: SparkSession, folder: str) -> DataFrame:
    return tracts.haplotype_reads(load_table(spark, folder, "analyzer_json"))


def _measured(spark: SparkSession, folder: str, left: str, right: str, measure: str | sequences.Measure) -> DataFrame:
    # the second haplotype is read from the other strand
    reads = _reads(spark, folder)
    seq = F.when(F.col("hap_rank") == 2, sequences.reverse_complement(F.col("seq"))).otherwise(F.col("seq"))
    found = reads.select("file_id", "hap_no", "hap_rank", sequences.measured_copies(seq, _anchor(spark, folder, left), _anchor(spark, folder, right), measure).alias("m"))
    return found.select("file_id", "hap_no", "m.copies", "m.before", "m.after", "m.is_reverse")


def copies_by_flank(spark: SparkSession, folder: str) -> DataFrame:
    """Units between the last unit before the array and the first behind it."""
    return _measured(spark, folder, "p5", "s6", sequences.Measure(with_anchors=False))


def copies_by_cassette(spark: SparkSession, folder: str) -> DataFrame:
    """Units from the first to the last unit."""
    return _measured(spark, folder, "p1", "s9", "cassette")


def read_signature(spark: SparkSession, folder: str) -> DataFrame:
    """By run: sequences, those with both anchors, the medians of the bases outside them (cut to whole numbers), and the share near these."""
    found = copies_by_cassette(spark, folder).join(_reads(spark, folder).select("file_id", "hap_no", "run"), ["file_id", "hap_no"])
    ends = found.groupBy("run", "before", "after").agg(F.count("*").alias("n"))
    middle = lambda c: F.floor(F.percentile(c, 0.5, F.col("n"))).cast("int")
    medians = ends.groupBy("run").agg(F.sum("n").alias("n_reads"), F.coalesce(F.sum(F.when(F.col("before").isNotNull(), F.col("n"))), F.lit(0)).alias("n_anchored"), middle("before").alias("median_before"), middle("after").alias("median_after"))
    near = lambda c: F.coalesce(F.sum(F.when(F.abs(F.col(c) - F.col(f"median_{c}")) <= 200, F.col("n"))), F.lit(0))
    tight = ends.join(medians, "run").groupBy("run").agg(near("before").alias("b"), near("after").alias("a"))
    held = medians.join(tight, "run")
    share = lambda c: F.round(F.col(c) / F.when(F.col("n_anchored") > 0, F.col("n_anchored")), 4)
    return held.select("run", "n_reads", "n_anchored", "median_before", "median_after", share("b").alias("tight_before"), share("a").alias("tight_after"))


def tandem_stretches(spark: SparkSession, folder: str) -> DataFrame:
    """The longest stretch of one unit after another in each sequence, for the unit that stands first behind the left anchor."""
    reads = _reads(spark, folder).withColumn("unit", F.substring(sequences.after_anchor(F.col("seq"), _anchor(spark, folder, "p5")), 1, 60)).filter("length(unit) = 60")
    return reads.withColumn("t", sequences.tandem_stretch(F.col("seq"), F.col("unit"))).select("file_id", "hap_no", "t.units", "t.start")


def _tracts(seq: Column) -> Column:
    return sequences.tract_lengths(seq, LEFT, BASE, RIGHT)


def _from_start(spark: SparkSession, folder: str) -> DataFrame:
    values = _tracts(sequences.after_anchor(F.col("seq"), _anchor(spark, folder, "p5")))
    return tracts.by_place(_reads(spark, folder), values, "run")


def tract_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Share of tracts of another length at each place behind the left anchor."""
    return tracts.place_profile(_from_start(spark, folder), F.col("value") != USUAL, "run")


def tract_profile_from_end(spark: SparkSession, folder: str) -> DataFrame:
    values = _tracts(sequences.before_anchor(F.col("seq"), _anchor(spark, folder, "s6")))
    return tracts.place_profile(tracts.by_place(_reads(spark, folder), values, "run", reverse=True), F.col("value") != USUAL, "run")


def tract_histogram(spark: SparkSession, folder: str) -> DataFrame:
    """How often each tract length stands at each place."""
    return _from_start(spark, folder)


def tract_by_haplotype(spark: SparkSession, folder: str) -> DataFrame:
    """Tract lengths of both strands, by run and haplotype."""
    values = sequences.tract_lengths_both(F.col("seq"), LEFT, BASE, RIGHT)
    each = _reads(spark, folder).select("run", "hap_rank", F.explode(values).alias("len"))
    return each.groupBy("run", "hap_rank", "len").agg(F.count("*").alias("n"))


def best_tract_place(spark: SparkSession, folder: str) -> DataFrame:
    return tracts.best_place(tract_profile(spark, folder), "run")


def run_length_test(spark: SparkSession, folder: str) -> DataFrame:
    return tracts.shifted(_from_start(spark, folder), "run", usual=USUAL, lengths=(1, 2, 4, 5, 6))


def unit_gap_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Share of short units (at most 50 bases between two contexts) at each place."""
    gaps = tracts.by_place(_reads(spark, folder), sequences.context_gaps(F.col("seq"), CONTEXT), "run")
    return tracts.place_profile(gaps, F.col("value") <= 50, "run")


def segment_tally(spark: SparkSession, folder: str) -> DataFrame:
    """Types of the segments of G and C between two contexts, on both strands."""
    pattern = F.lit(f"{LEFT}([GC]{{2,20}})[AT]")
    both = F.concat(F.regexp_extract_all("seq", pattern, 1), F.regexp_extract_all(sequences.reverse_complement(F.col("seq")), pattern, 1))
    each = _reads(spark, folder).select("run", F.explode(both).alias("segment"))
    return each.groupBy("run", sequences.segment_type(F.col("segment"), BASE, RIGHT, USUAL).alias("type")).agg(F.count("*").alias("n"))


def _contexts(spark: SparkSession, folder: str) -> DataFrame:
    tract = F.get(_tracts(F.col("unit")), F.lit(0))
    return tracts.context_counts(_reads(spark, folder), tract, "run")


def context_profile(spark: SparkSession, folder: str) -> DataFrame:
    return _contexts(spark, folder)


def context_panel(spark: SparkSession, folder: str) -> DataFrame:
    return tracts.context_panel(_contexts(spark, folder), "run", changed=F.col("len") != USUAL)


def context_candidates(spark: SparkSession, folder: str) -> DataFrame:
    counts, changed = _contexts(spark, folder), F.col("len") != USUAL
    return tracts.context_candidates(counts, tracts.context_panel(counts, "run", changed=changed), "run", changed=changed)


def _aligned(spark: SparkSession, folder: str) -> DataFrame:
    """Each unit with a sequence against the reference unit of its name."""
    units = unit_profiles.decoded_units(load_table(spark, folder, "analyzer_json")).filter("sequence != ''").withColumnRenamed("sequence", "seq")
    reference = load_table(spark, folder, "motif_ref").select(F.col("motif_name").alias("name"), F.upper("seq").alias("ref"))
    held = units.join(reference, "name")
    return held.select("file_id", "run", "hap_no", "unit", "name", "seq", "ref", F.lit(0).alias("ref_start"), alignments.one_gap_cigar(F.col("seq"), F.col("ref")).alias("cigar"))


def unit_alignments(spark: SparkSession, folder: str) -> DataFrame:
    """Bases matched, inserted and deleted of each unit against its reference."""
    c = F.col("cigar")
    return _aligned(spark, folder).select(
        "file_id", "hap_no", "unit", "name", cigar.reference_length(c).alias("ref_len"), cigar.query_length(c).alias("query_len"), cigar.inserted(c).alias("inserted"), cigar.deleted(c).alias("deleted")
    )


def unit_indels(spark: SparkSession, folder: str) -> DataFrame:
    """Insertions and deletions with the reference place at which they lie."""
    each = _aligned(spark, folder).select("file_id", "hap_no", "unit", "name", F.inline(cigar.blocks(F.col("cigar"), F.col("ref_start"))))
    return each.filter("op in (1, 2)").select("file_id", "hap_no", "unit", "name", "ref_at", F.when(F.col("op") == 1, F.col("len")).otherwise(-F.col("len")).alias("net"))


def aligned_base(spark: SparkSession, folder: str, place: int = 30) -> DataFrame:
    """The base of each unit at one place of its reference, and its place in the unit with and without deletions."""
    at = alignments.query_index_at(F.col("cigar"), F.col("ref_start"), F.lit(place))
    held = _aligned(spark, folder).withColumn("at", at).withColumn("next_at", alignments.query_index_at(F.col("cigar"), F.col("ref_start"), F.lit(place), in_gap=True))
    base = F.when(F.col("at").isNotNull(), F.substring("seq", (F.col("at") + 1).cast("int"), F.lit(1)))
    return held.select("file_id", "hap_no", "unit", "name", "at", "next_at", base.alias("base"))


def window_bases(spark: SparkSession, folder: str, low: int = 20, high: int = 40) -> DataFrame:
    found = alignments.window_bases(F.col("seq"), F.col("cigar"), F.col("ref_start"), low, high)
    return _aligned(spark, folder).select("file_id", "hap_no", "unit", "name", found.alias("bases"))


def base_pileup(spark: SparkSession, folder: str) -> DataFrame:
    """Bases, gaps and insertions at each place of each reference unit, by run."""
    return alignments.pileup(alignments.placed_bases(_aligned(spark, folder), "run", "name"), "run", "name")


def unit_consensus(spark: SparkSession, folder: str) -> DataFrame:
    """Consensus of the copies of each unit within a haplotype; places of low depth have the reference's base."""
    keys = ("file_id", "hap_no", "name")
    reference = load_table(spark, folder, "motif_ref").select(F.col("motif_name").alias("contig"), F.upper("seq").alias("seq"))
    return alignments.consensus(alignments.pileup(alignments.placed_bases(_aligned(spark, folder), *keys), *keys), reference, *keys, contig="name")


QUERIES = {
    f.__name__: f
    for f in (
        copies_by_flank, copies_by_cassette, read_signature, tandem_stretches, tract_profile, tract_profile_from_end, tract_histogram, tract_by_haplotype, best_tract_place, run_length_test, unit_gap_profile,
        segment_tally, context_profile, context_panel, context_candidates, unit_alignments, unit_indels, aligned_base, window_bases, base_pileup, unit_consensus,
    )
}

_SEQS = f"""{_UNITS},
held AS (SELECT * FROM units WHERE sequence <> ''),
reads AS (SELECT file_id, any_value(run) AS run, hap_no, any_value(hap_rank) AS hap_rank, list(name ORDER BY unit) AS names, list(sequence ORDER BY unit) AS parts, string_agg(sequence, '' ORDER BY unit) AS seq
  FROM held GROUP BY file_id, hap_no),
rc AS (SELECT *, translate(reverse(seq), 'ACGTN', 'TGCAN') AS other FROM reads)"""


def _copies(left: str, right: str, low: str, high: str) -> str:
    """Every place of the sequences is compared with both anchors."""
    seeds = lambda a: " OR ".join(f"substr(w, {k}, 11) = substr({a}, {k}, 11)" for k in (1, 12, 23, 34, 45))
    return f"""WITH {_SEQS}, anchors AS (SELECT max(seq) FILTER (motif_name = '{left}') AS a, max(seq) FILTER (motif_name = '{right}') AS b FROM motif_ref),
places AS (SELECT file_id, hap_no, i, substr(seq, i + 1, 60) AS w FROM (SELECT file_id, hap_no, seq, unnest(range(0, length(seq) - 59)) AS i FROM reads)),
near AS (SELECT file_id, hap_no, i, CASE WHEN {seeds("a")} THEN hamming(w, a) ELSE 99 END AS da, CASE WHEN {seeds("b")} THEN hamming(w, b) ELSE 99 END AS db FROM places, anchors),
best AS (SELECT file_id, hap_no, arg_min(i, (da, i)) FILTER (da <= 9) AS x, arg_min(i, (db, i)) FILTER (db <= 9) AS y FROM near GROUP BY ALL),
m AS (SELECT file_id, hap_no, CASE WHEN y >= x + 60 THEN {low} END AS lo, {high} AS hi, length(seq) AS n, hap_rank FROM reads LEFT JOIN best USING (file_id, hap_no))
SELECT file_id, hap_no, CASE WHEN lo IS NOT NULL THEN round_even((hi - lo) / 60.0, 0)::INT END AS copies, lo::INT AS before, CASE WHEN lo IS NOT NULL THEN (n - hi)::INT END AS after,
  CASE WHEN lo IS NOT NULL THEN coalesce(hap_rank = 2, false) END AS is_reverse FROM m"""


_PLACED = f"""{_SEQS}, anchor AS (SELECT max(seq) FILTER (motif_name = 'p5') AS p, max(seq) FILTER (motif_name = 's6') AS s FROM motif_ref),
tract_lists AS (SELECT run, regexp_extract_all(CASE WHEN contains(seq, p) THEN substr(seq, strpos(seq, p) + 60) END, 'TAA(G+)C', 1) AS l FROM reads, anchor),
tract_places AS (SELECT run, unnest(range(1, len(l) + 1)) AS place, length(unnest(l)) AS value FROM tract_lists)"""
_TRACTS = f"""{_PLACED}, seen AS (SELECT run, place, count(*) AS tot, count(*) FILTER (value <> 3) AS n_mut FROM tract_places GROUP BY ALL HAVING count(*) >= 8)"""
_TESTED = "sum(exp(lgamma(tot + 1) - lgamma(i + 1) - lgamma(tot - i + 1) + i * ln(f) + (tot - i) * ln(1 - f)))"
_CONTEXT = f"""{_SEQS}, each AS (SELECT run, names, unnest(range(1, len(parts) + 1)) AS i, unnest(parts) AS part FROM reads),
contexts AS (SELECT run, array_to_string(names[i - 2 : i], '-') AS context, length(regexp_extract(part, 'TAA(G+)C', 1)) AS len, count(*) AS n FROM each WHERE i >= 3 AND regexp_matches(part, 'TAAG+C') GROUP BY ALL)"""
_PANEL = f"""{_CONTEXT}, shares AS (SELECT context, run, sum(n) AS tot, coalesce(sum(n) FILTER (len <> 3), 0) AS k FROM contexts GROUP BY ALL),
panel AS (SELECT context, count(*) AS n_subjects, sum(tot)::BIGINT AS n_tracts, round(sum(k) / sum(tot), 6) AS f_pooled, round(avg(k / tot), 6) AS f_mean, round(stddev_pop(k / tot), 6) AS f_sd, round(max(k / tot), 6) AS f_max
  FROM shares GROUP BY context)"""
# start: bases in common from the start, cut to what the common end leaves; the gap lies behind the first ``m`` bases
_ALIGNED = f"""{_UNITS},
pairs AS (SELECT u.*, upper(r.seq) AS ref, least(length(u.sequence), length(r.seq)) AS short, length(u.sequence) - length(r.seq) AS off FROM units u JOIN motif_ref r ON u.name = r.motif_name WHERE u.sequence <> ''),
ends AS (SELECT *, coalesce(list_position(list_transform(range(1, short + 1), lambda k: sequence[k] = ref[k]), false) - 1, short) AS head,
  coalesce(list_position(list_transform(range(1, short + 1), lambda k: reverse(sequence)[k] = reverse(ref)[k]), false) - 1, short) AS tail FROM pairs),
aligned AS (SELECT *, CASE WHEN off = 0 THEN short ELSE short - least(tail, short - head) END AS m, greatest(off, 0) AS ins, greatest(-off, 0) AS del FROM ends)"""
_PILE = f"""{_ALIGNED},
steps AS (SELECT *, unnest(range(0, length(ref))) AS k FROM aligned),
on_place AS (SELECT file_id, run, hap_no, name, k::INT AS pos, CASE WHEN k < m THEN sequence[k + 1] WHEN k < m + del THEN '-' ELSE sequence[k + ins - del + 1] END AS base, '' AS inserted FROM steps),
added AS (SELECT file_id, run, hap_no, name, (m - 1)::INT AS pos, NULL AS base, substr(sequence, m + 1, ins) AS inserted FROM aligned WHERE ins > 0 AND m > 0),
based AS (SELECT * FROM on_place UNION ALL SELECT * FROM added)"""

ORACLE = {
    "copies_by_flank": _copies("p5", "s6", "x + 60", "y"),
    "copies_by_cassette": _copies("p1", "s9", "x", "y + 60"),
    "read_signature": f"""WITH copies AS ({_copies("p1", "s9", "x", "y + 60")}), runs AS (SELECT file_id, min(run) AS run FROM analyzer_json GROUP BY file_id),
m AS (SELECT run, count(*) AS n_reads, count(before) AS n_anchored, floor(median(before))::INT AS median_before, floor(median(after))::INT AS median_after FROM copies JOIN runs USING (file_id) GROUP BY run)
SELECT m.run, any_value(n_reads) AS n_reads, any_value(n_anchored) AS n_anchored, any_value(median_before) AS median_before, any_value(median_after) AS median_after,
  round(count(*) FILTER (abs(before - median_before) <= 200) / nullif(any_value(n_anchored), 0), 4) AS tight_before, round(count(*) FILTER (abs(after - median_after) <= 200) / nullif(any_value(n_anchored), 0), 4) AS tight_after
FROM copies JOIN runs USING (file_id) JOIN m USING (run) GROUP BY m.run""",
    "tandem_stretches": f"""WITH {_SEQS}, anchor AS (SELECT max(seq) AS p FROM motif_ref WHERE motif_name = 'p5'),
first AS (SELECT file_id, hap_no, seq, substr(seq, strpos(seq, p) + 60, 60) AS unit FROM reads, anchor WHERE contains(seq, p) AND length(seq) >= strpos(seq, p) + 119),
places AS (SELECT file_id, hap_no, i FROM (SELECT *, unnest(range(0, length(seq) - 59)) AS i FROM first) WHERE hamming(substr(seq, i + 1, 60), unit) <= 6),
islands AS (SELECT *, i // 60 - row_number() OVER (PARTITION BY file_id, hap_no, i % 60 ORDER BY i) AS island FROM places),
stretches AS (SELECT file_id, hap_no, i % 60 AS phase, island, count(*) AS n, min(i) AS start FROM islands GROUP BY ALL)
SELECT file_id, hap_no, n::INT AS units, start::INT AS start FROM (SELECT *, row_number() OVER (PARTITION BY file_id, hap_no ORDER BY n DESC, start) AS r FROM stretches) WHERE r = 1""",
    "tract_histogram": f"WITH {_PLACED} SELECT run, place, value, count(*) AS n FROM tract_places GROUP BY ALL",
    "tract_profile": f"WITH {_TRACTS} SELECT *, round(n_mut / tot, 3) AS frac FROM seen",
    "tract_profile_from_end": f"""WITH {_SEQS}, anchor AS (SELECT max(seq) FILTER (motif_name = 's6') AS s FROM motif_ref),
end_lists AS (SELECT run, list_reverse(regexp_extract_all(CASE WHEN contains(seq, s) THEN substr(seq, 1, length(seq) - strpos(reverse(seq), reverse(s)) - 59) END, 'TAA(G+)C', 1)) AS l FROM reads, anchor),
end_places AS (SELECT run, unnest(range(1, len(l) + 1)) AS place, length(unnest(l)) AS value FROM end_lists),
seen AS (SELECT run, place, count(*) AS tot, count(*) FILTER (value <> 3) AS n_mut FROM end_places GROUP BY ALL HAVING count(*) >= 8)
SELECT *, round(n_mut / tot, 3) AS frac FROM seen""",
    "tract_by_haplotype": f"""WITH {_SEQS}, each AS (SELECT run, hap_rank, length(unnest(list_concat(regexp_extract_all(seq, 'TAA(G+)C', 1), regexp_extract_all(other, 'TAA(G+)C', 1)))) AS len FROM rc)
SELECT *, count(*) AS n FROM each GROUP BY ALL""",
    "best_tract_place": f"""WITH {_TRACTS} SELECT run, place, tot, n_mut, frac FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY frac DESC, place) AS r
  FROM (SELECT *, round(n_mut / tot, 3) AS frac FROM seen WHERE tot >= 20)) WHERE r = 1""",
    "run_length_test": f"""WITH {_PLACED}, lengths AS (SELECT unnest([1, 2, 4, 5, 6]) AS length),
seen AS (SELECT run, place, length, count(*) AS tot, count(*) FILTER (CASE WHEN length > 3 THEN value >= length ELSE value <= length END) AS k, count(*) FILTER (value = length) AS support FROM tract_places, lengths GROUP BY ALL),
nulls AS (SELECT *, (sum(k) OVER w - k + 0.5) / (sum(tot) OVER w - tot + 1.0) AS f FROM seen WINDOW w AS (PARTITION BY run, length)),
tested AS (SELECT *, count(*) OVER (PARTITION BY run) AS n_tests FROM nulls WHERE support >= 4 AND tot >= 8)
SELECT run, place, length, tot, k, round(f, 6) AS f_null, round(least(1.0, n_tests * (SELECT {_TESTED} FROM (SELECT unnest(range(k, tot + 1)) AS i))), 6) AS p_bonf FROM tested""",
    "unit_gap_profile": f"""WITH {_SEQS}, parts AS (SELECT run, string_split(seq, '{CONTEXT}') AS p FROM reads),
gap_lists AS (SELECT run, p[2 : len(p) - 1] AS l FROM parts WHERE len(p) > 2),
gap_places AS (SELECT run, unnest(range(1, len(l) + 1)) AS place, length(unnest(l)) + {len(CONTEXT)} AS value FROM gap_lists),
seen AS (SELECT run, place, count(*) AS tot, count(*) FILTER (value <= 50) AS n_mut FROM gap_places GROUP BY ALL HAVING count(*) >= 8)
SELECT *, round(n_mut / tot, 3) AS frac FROM seen""",
    "segment_tally": f"""WITH {_SEQS}, each AS (SELECT run, unnest(list_concat(regexp_extract_all(seq, 'TAA([GC]{{2,20}})[AT]', 1), regexp_extract_all(other, 'TAA([GC]{{2,20}})[AT]', 1))) AS s FROM rc),
typed AS (SELECT run, CASE WHEN NOT contains(s, 'C') THEN CASE length(s) WHEN 3 THEN 'WT' WHEN 2 THEN 'delG' WHEN 4 THEN 'dupG' WHEN 5 THEN 'dupGG' WHEN 6 THEN 'dupGGG' WHEN 7 THEN 'dupGGGG' ELSE 'gIns' || (length(s) - 3) END
  WHEN length(s) = 4 AND replace(s, 'C', '') = 'GGG' THEN CASE WHEN s LIKE 'C%' THEN 'dupC' ELSE 'insC' END ELSE 'other' END AS type FROM each)
SELECT run, type, count(*) AS n FROM typed GROUP BY ALL""",
    "context_profile": f"WITH {_CONTEXT} SELECT * FROM contexts",
    "context_panel": f"WITH {_PANEL} SELECT * FROM panel",
    "context_candidates": f"""WITH {_PANEL},
own AS (SELECT run, context, tot, k, least(greatest(coalesce(CASE WHEN n_tracts >= 30 THEN f_pooled END, 0.02), 0.0001), 0.9999) AS f FROM shares LEFT JOIN panel USING (context) WHERE k >= 4),
tested AS (SELECT *, count(*) OVER (PARTITION BY run) AS n_tests FROM own),
scored AS (SELECT run, context, tot::BIGINT AS tot, k::BIGINT AS k, round(f, 6) AS f_null, round(least(1.0, n_tests * (SELECT {_TESTED} FROM (SELECT unnest(range(k::BIGINT, tot::BIGINT + 1)) AS i))), 6) AS p_bonf,
  round(1 / (1 + exp(-least(greatest(k * ln(0.3 / f) + (tot - k) * ln(0.7 / (1 - f)) + ln(0.3 / 0.7), -700), 700))), 6) AS posterior FROM tested)
SELECT *, CASE WHEN p_bonf <= 0.05 THEN 'called' WHEN posterior >= 0.9 THEN 'borderline' ELSE 'none' END AS tier FROM scored""",
    "unit_alignments": f"WITH {_ALIGNED} SELECT file_id, hap_no, unit, name, length(ref) AS ref_len, length(sequence) AS query_len, ins AS inserted, del AS deleted FROM aligned",
    "unit_indels": f"WITH {_ALIGNED} SELECT file_id, hap_no, unit, name, m AS ref_at, off AS net FROM aligned WHERE off <> 0",
    "aligned_base": f"""WITH {_ALIGNED}, found AS (SELECT file_id, hap_no, unit, name, sequence, CASE WHEN 30 < m THEN 30 WHEN 30 < m + del THEN NULL ELSE 30 + ins - del END AS a, CASE WHEN 30 < m THEN 30 WHEN 30 < m + del THEN m ELSE 30 + ins - del END AS b FROM aligned)
SELECT file_id, hap_no, unit, name, a::BIGINT AS "at", b::BIGINT AS next_at, CASE WHEN a IS NOT NULL THEN substr(sequence, a + 1, 1) END AS base FROM found""",
    "window_bases": f"""WITH {_ALIGNED}, w AS (SELECT *, least(m, 40) AS x, greatest(m + del, 20) AS y FROM aligned)
SELECT file_id, hap_no, unit, name, (CASE WHEN x > 20 THEN substr(sequence, 21, x - 20) ELSE '' END) || (CASE WHEN m >= 20 AND m < 40 THEN substr(sequence, m + 1, ins) ELSE '' END)
  || (CASE WHEN least(40, length(ref)) > y THEN substr(sequence, y + ins - del + 1, least(40, length(ref)) - y) ELSE '' END) AS bases FROM w""",
    "base_pileup": f"WITH {_PILE} SELECT run, name, pos, base, inserted, count(*) AS n FROM based GROUP BY ALL",
    "unit_consensus": f"""WITH {_PILE}, counts AS (SELECT file_id, hap_no, name, pos, base, inserted, count(*) AS n FROM based GROUP BY ALL),
per AS (SELECT file_id, hap_no, name, pos, sum(n) FILTER (base IS NOT NULL) AS depth, coalesce(max(n) FILTER (base = '-'), 0) AS gaps, coalesce(max(n) FILTER (base <> '-'), 0) AS top,
  arg_min(base, (-n, base)) FILTER (base <> '-') AS own, arg_min(inserted, (-n, inserted)) FILTER (base IS NULL) AS ins, max(n) FILTER (base IS NULL) AS n_ins FROM counts GROUP BY ALL),
called AS (SELECT file_id, hap_no, name, pos, (CASE WHEN gaps > top AND gaps >= 0.6 * depth THEN '' ELSE coalesce(own, '') END)
  || coalesce(CASE WHEN n_ins >= (CASE WHEN length(ins) > 3 THEN 0.25 ELSE 0.5 END) * depth THEN ins END, '') AS own FROM per WHERE depth >= 3),
grid AS (SELECT g.*, pos, substr(upper(seq), pos + 1, 1) AS ref FROM (SELECT DISTINCT file_id, hap_no, name FROM counts) g JOIN (SELECT motif_name AS name, seq, unnest(range(0, length(seq))) AS pos FROM motif_ref) USING (name))
SELECT file_id, hap_no, name, string_agg(coalesce(own, ref), '' ORDER BY pos) AS consensus, count(own)::INT AS covered FROM grid LEFT JOIN called USING (file_id, hap_no, name, pos) GROUP BY ALL""",
}
