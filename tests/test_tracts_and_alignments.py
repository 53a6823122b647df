import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandmill.functions import sequences as q
from strandmill.operators import alignments as a
from strandmill.operators import tracts as t

LEFT = "ACGTTGCATGCCATTGACCAGTTAGCATCGGATTACCGATTGACGTTAGCCATGCAATCG"
RIGHT = "TTGACCATCGGATCCATTGCAGGCTTAACGCTAGGATTCCGATACGGTTACGATCCATGA"
UNIT = "GGTAAGGGCCCAGCTCTAGCCTTCTGACTCATAGTAAATCGTACCCGCGGCATGACTGAA"


def rc(s):
    return s[::-1].translate(str.maketrans("ACGTN", "TGCAN"))


def substituted(s, places):
    return "".join(("A" if c != "A" else "C") if k in places else c for k, c in enumerate(s))


def slow_place(seq, probe, most):
    found = []
    for k in range(len(seq) - len(probe) + 1):
        w = seq[k : k + len(probe)]
        d = sum(x != y for x, y in zip(w, probe, strict=True))
        if d <= most and any(w[j : j + 11] == probe[j : j + 11] for j in range(0, len(probe) - 10, 11)):
            found.append((d, k))
    return min(found)[1] if found else -1


def test_best_place_equals_brute_force():
    rng = random.Random(8)
    for _ in range(200):
        probe = "".join(rng.choice("ACGT") for _ in range(rng.choice((11, 25, 60))))
        seq = "".join(rng.choice("ACGT") for _ in range(rng.randint(0, 300)))
        for _ in range(3):
            at = rng.randint(0, len(seq))
            seq = seq[:at] + substituted(probe, rng.sample(range(len(probe)), rng.randint(0, 11))) + seq[at:]
        assert q.best_place(seq.encode(), probe.encode(), 9) == slow_place(seq, probe, 9)
    assert q.best_place(b"", b"ACGTACGTACG", 3) == -1


def test_measures_on_reads_with_errors(spark):
    noisy = substituted(LEFT, (3, 17, 40)) + UNIT * 6 + substituted(RIGHT, (0, 30, 44, 59))
    seqs = ["GATTACA" + noisy + "CC", rc("GATTACA" + noisy + "CC"), noisy[:-61], substituted(LEFT, range(0, 60, 5)) + UNIT + RIGHT, RIGHT + UNIT + LEFT, noisy.lower(), None, ""]
    df = spark.createDataFrame([(k, s) for k, s in enumerate(seqs)], "i int, s string")
    get = lambda m, **kw: {r.i: r.m and tuple(r.m) for r in df.select("i", q.measured_copies(F.col("s"), LEFT, RIGHT, m, **kw).alias("m")).collect()}
    assert get("cassette") == {0: (8, 7, 2, False), 1: (8, 7, 2, True), 2: None, 3: None, 4: None, 5: (8, 0, 0, False), 6: None, 7: None}
    # the fixed 44 bases beside the array are taken off: 316 / 60 is nearer to 5
    assert get("flank", offset=4)[0] == (9, 67, 62, False)
    halves = spark.createDataFrame([(LEFT + "A" * n + RIGHT,) for n in (74, 134)], "s string")
    assert [r.m.copies for r in halves.select(q.measured_copies(F.col("s"), LEFT, RIGHT).alias("m")).collect()] == [0, 2]


def test_tracts(spark):
    s = "AATAAGGGCTTTAAGGCTAAGCCGTTA"
    one = spark.range(1).select(
        q.tract_lengths(F.lit(s), "TAA", "G", "C"), q.tract_lengths_both(F.lit(rc(s)), "TAA", "G", "C"), q.oriented(F.lit(rc(s)), "TAAG+C"), q.oriented(F.lit(s), "TAAG+C"),
        q.after_anchor(F.lit(s), "GGGC"), q.before_anchor(F.lit(s), "TAAG"), q.context_gaps(F.lit(s), "TAAG"), q.after_anchor(F.lit(s), "AAAAA"), q.before_anchor(F.lit(s), "AAAAA"), q.context_gaps(F.lit(""), "TAAG"),
    ).first()
    assert list(one) == [[3, 2, 1], [3, 2, 1], s, s, s[9:], s[:17], [9, 6], None, None, []]


@pytest.mark.parametrize(
    "segment, kind",
    [("CCCCCCC", "WT"), ("CCCCCCCC", "dupC"), ("CCCCC", "delCC"), ("C" * 11, "dupCCCC"), ("C" * 13, "cIns6"), ("CC", "cDel5"), ("GCCCCCCC", "dupG"), ("CCCGCCCC", "insG"), ("CGGC", "other"), (None, None)],
)
def test_segment_types(spark, segment, kind):
    assert spark.range(1).select(q.segment_type(F.lit(segment).cast("string"))).first()[0] == kind


def test_profiles_by_place(spark):
    reads = spark.createDataFrame([("a", [3, 3, 4])] * 9 + [("a", [3, 4])] + [("b", [3])] * 7 + [("b", None), ("b", [])], "g string, v array<int>")
    counts = t.by_place(reads, F.col("v"), "g")
    profile = t.place_profile(counts, F.col("value") != 3, "g")
    assert sorted(tuple(r) for r in profile.collect()) == [("a", 1, 10, 0, 0.0), ("a", 2, 10, 1, 0.1), ("a", 3, 9, 9, 1.0)]
    assert [tuple(r) for r in t.best_place(profile, "g", min_tot=10).collect()] == [("a", 2, 10, 1, 0.1)]
    last = t.place_profile(t.by_place(reads, F.col("v"), "g", reverse=True), F.col("value") != 3, "g")
    assert {tuple(r)[1:4] for r in last.collect()} == {(1, 10, 10), (2, 10, 0), (3, 9, 0)}
    tested = {(r.place, r.length): (r.k, r.tot, r.p_bonf) for r in t.shifted(counts, "g", usual=3, lengths=(2, 3, 4, 5)).collect()}
    assert set(tested) == {(3, 4)} and tested[3, 4][:2] == (9, 9) and tested[3, 4][2] < 0.001
    assert t.shifted(counts.limit(0), "g", usual=3, lengths=(4,)).count() == 0


def test_contexts(spark):
    rows = [("s1", list("xyzw"), ["TAAGGGC", "TAAGGC", "TAAGGGC", "none"])] * 40 + [("s2", list("xyzw"), ["TAAGGGC"] * 2 + ["TAAGGGGC"] + ["TAAGGGC"])] * 5
    reads = spark.createDataFrame(rows, "run string, names array<string>, units array<string>")
    tract = F.get(q.tract_lengths(F.col("unit"), "TAA", "G", "C"), F.lit(0))
    counts = t.context_counts(reads, tract, "run")
    assert {tuple(r) for r in counts.collect()} == {("s1", "x-y-z", 3, 40), ("s2", "x-y-z", 4, 5), ("s2", "y-z-w", 3, 5)}
    panel = t.context_panel(counts, "run", changed=F.col("len") != 3)
    assert {r.context: (r.n_subjects, r.n_tracts, r.f_pooled, r.f_mean, r.f_sd) for r in panel.collect()} == {"x-y-z": (2, 45, 0.111111, 0.5, 0.5), "y-z-w": (1, 5, 0.0, 0.0, 0.0)}
    (found,) = t.context_candidates(counts, panel, "run", changed=F.col("len") != 3).collect()
    assert found.run == "s2" and found.k == 5 and found.f_null == 0.111111 and found.tier == "called"


def reads_of(spark, rows):
    return spark.createDataFrame(
        [(c, r, s, start, [{"op": o, "len": n} for o, n in ops]) for c, r, s, start, ops in rows], "contig string, read int, seq string, ref_start int, cigar array<struct<op:int,len:int>>"
    )


def test_one_gap_alignment(spark):
    pairs = [("ACGTACGT", "ACGTACGT"), ("ACGGTACGT", "ACGTACGT"), ("ACACGT", "ACGTACGT"), ("TTTT", "GGGGGG"), ("A", ""), ("", "AC"), ("AAA", "AAAAA")]
    df = spark.createDataFrame(pairs, "s string, r string")
    got = [[(c["op"], c["len"]) for c in r[0]] for r in df.select(a.one_gap_cigar(F.col("s"), F.col("r"))).collect()]
    # what is equal at both ends stands to the left first
    assert got == [[(0, 8)], [(0, 3), (1, 1), (0, 5)], [(0, 2), (2, 2), (0, 4)], [(0, 4), (2, 2)], [(1, 1)], [(2, 2)], [(0, 3), (2, 2)]]


def test_places_and_windows(spark):
    # 3 clipped, 4 matched at 10-13, 2 inserted, 2 deleted (14, 15), 3 matched at 16-18
    df = reads_of(spark, [("c", 1, "NNNACGTGGTCA", 10, [(4, 3), (0, 4), (1, 2), (2, 2), (0, 3)])])
    c, s = F.col("cigar"), F.col("ref_start")
    at = lambda k, **kw: a.query_index_at(c, s, F.lit(k), **kw)
    assert list(df.select(at(9), at(10), at(13), at(14), at(15), at(16), at(18), at(19), at(14, in_gap=True)).first()) == [None, 3, 6, None, None, 9, 11, None, 9]
    assert list(df.select(a.window_bases(F.col("seq"), c, s, 12, 17), a.window_bases(F.col("seq"), c, s, 0, 14), a.window_bases(F.col("seq"), c, s, 15, 99)).first()) == ["GTGGT", "ACGT", "TCA"]
    placed = sorted(((r.pos, r.base or "", r.inserted) for r in a.placed_bases(df, "contig", "read").collect()))
    assert placed == [(10, "A", ""), (11, "C", ""), (12, "G", ""), (13, "", "GG"), (13, "T", ""), (14, "-", ""), (15, "-", ""), (16, "T", ""), (17, "C", ""), (18, "A", "")]


def test_consensus(spark):
    ref = spark.createDataFrame([("c", "ACGTACGTAA"), ("d", "TTTT")], "contig string, seq string")
    whole = [("c", k, "ACCTACGTAA", 0, [(0, 10)]) for k in range(2)]
    # three of five lack the fifth base; two of five have two bases more behind the second; one base differs in four of five
    gapped = [("c", 2 + k, "ACCTCGTAA", 0, [(0, 4), (2, 1), (0, 5)]) for k in range(2)] + [("c", 4, "ACGGGTCGTAA", 0, [(0, 2), (1, 2), (0, 2), (2, 1), (0, 5)])]
    few = [("d", 9, "GGGG", 0, [(0, 4)])] * 2
    counts = a.pileup(a.placed_bases(reads_of(spark, whole + gapped + few), "contig"), "contig")
    got = {r.contig: (r.consensus, r.covered) for r in a.consensus(counts, ref, "contig", contig="contig").collect()}
    assert got == {"c": ("ACCTCGTAA", 10), "d": ("TTTT", 0)}
    eager = {r.contig: r.consensus for r in a.consensus(counts, ref, "contig", contig="contig", short_share=0.2, gap_share=0.7).collect()}
    assert eager["c"] == "ACGGCTACGTAA"
    assert a.consensus(counts.limit(0), ref, "contig", contig="contig").count() == 0


def test_phasing(spark):
    seqs = ["AAAA"] * 6 + ["CAAC"] * 5 + ["CAAG"]
    units = spark.createDataFrame([("g", k, s) for k, s in enumerate(seqs)] + [("h", 0, "AAAA"), ("h", 1, "AAAA")], "g string, unit int, sequence string")
    places = spark.createDataFrame([("g", 1, "A", "C"), ("g", 4, "A", "C"), ("h", 1, "A", "C")], "g string, place int, major_base string, minor_base string")
    phased = a.phase_reads(units, places, "g").cache()
    assert {(r.g, r.unit): r.phase for r in phased.collect()} == {("g", k): "A" if k < 6 else "B" for k in range(12)} | {("h", 0): "A", ("h", 1): "A"}
    assert {tuple(r) for r in a.phase_concordance(units, places, phased, "g").collect()} == {("g", 2, 2), ("h", 1, 0)}
    assert {tuple(r) for r in a.phase_concordance(units, places, phased, "g", share=0.9).collect()} == {("g", 2, 1), ("h", 1, 0)}


def test_haplotype_reads(spark):
    m = lambda pos, seq, n="A": {"name": n, "pos": pos, "length": 4, "sequence": seq}
    body = json.dumps({"haplotypes": [{"motifs": [m(4, "ccgg", "B "), m(0, "AATT"), m(0, "GGGG"), m(8, None), {"pos": 12, "sequence": "A"}]}, {"motifs": []}]})
    df = spark.createDataFrame([(1, "r", body), (1, "q", body), (2, "r", "{")], "file_id bigint, run string, body string")
    (row,) = t.haplotype_reads(df).collect()
    assert (row.file_id, row.run, row.hap_no, row.names, row.seq) == (1, "q", 1, ["A", "B"], "AATTCCGG")
    assert np.array(row.units).tolist() == ["AATT", "CCGG"]


def test_longest_tandem():
    unit = b"ACGTACGTAA"
    near = b"ACGTACGTTT"
    assert q.longest_tandem(b"GG" + unit + near + unit + b"CCC" + unit * 2, unit, 2) == (3, 2)
    assert q.longest_tandem(b"GG" + unit + near + unit + b"CCC" + unit * 2, unit, 0) == (2, 35)
    assert q.longest_tandem(b"G" * 40, unit, 1) == (0, -1) and q.longest_tandem(b"", unit, 1) == (0, -1)
