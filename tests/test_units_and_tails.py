import json
import math
from fractions import Fraction
from math import comb

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandmill.functions import cigar, sequences, tails
from strandmill.operators import unit_profiles as u
from strandmill.operators.decoding import Units, decode, greedy_units

A = "ACGT" * 15
B = "TTGCA" * 12


def test_tails_against_exact_sums():
    cases = [(0, 5, 0.3), (3, 5, 0.3), (5, 5, 0.3), (6, 5, 0.3), (1, 5, 0.0), (1, 5, 1.0), (40, 400, 0.05), (2, 400, 0.05), (390, 400, 0.5), (9, 900, 0.02)]
    k, n, p = (np.array(x, float) for x in zip(*cases, strict=True))
    q = [Fraction(str(c)) for _, _, c in cases]
    exact = [float(sum(comb(b, i) * c**i * (1 - c) ** (b - i) for i in range(a, b + 1))) for (a, b, _), c in zip(cases, q, strict=True)]
    assert np.allclose(tails.binomial_tail(k, n, p), exact, rtol=1e-9, atol=1e-14)
    assert np.isnan(tails.binomial_tail(np.array([np.nan]), np.array([1.0]), np.array([0.5])))[0]
    # a beta-binomial with large parameters is nearly binomial; sums over all k are 1
    assert abs(tails.beta_binomial_tail(*(np.array([x], float) for x in (40, 400, 5e6, 9.5e7)))[0] - exact[6]) < 1e-5
    assert abs(tails.beta_binomial_tail(*(np.array([x], float) for x in (1, 3, 1, 1)))[0] - 0.75) < 1e-12
    assert abs(tails.fisher_tail(*(np.array([x], float) for x in (3, 1, 1, 3)))[0] - 17 / 70) < 1e-12
    assert tails.fisher_tail(*(np.array([x], float) for x in (0, 0, 1, 3)))[0] == 1.0


def test_columns(spark):
    df = spark.createDataFrame([(3, 5, 0.3), (None, 5, 0.3), (0, 0, 0.3)], "k int, n int, f double")
    low, high = tails.wilson(F.col("k"), F.col("n"))
    got = df.select(tails.binom_tail(F.col("k"), F.col("n"), F.col("f")).alias("p"), low.alias("low"), high.alias("high"), tails.posterior(F.col("k"), F.col("n"), 0.5, 0.6, F.col("f")).alias("post"), tails.percentile_of(F.col("f")).alias("z")).collect()
    assert abs(got[0].p - 0.16308) < 1e-9 and got[1].p is None and got[2].p == 1.0
    assert (got[2].low, got[2].high) == (0.0, 1.0) and 0.23 < got[0].low < 0.24
    assert abs(got[0].post - 1 / (1 + (0.5**3) * (0.7 / 0.4) ** 2)) < 1e-9 and abs(got[0].z - 0.5 * (1 + math.erf(0.3 / math.sqrt(2)))) < 1e-12


def body(*haps):
    return json.dumps({"haplotypes": [{"rank": k, "consensus": "".join(m.get("sequence", "") for m in h), "motifs": h} for k, h in enumerate(haps, 1)]})


def units_of(*lengths, seq=A):
    pos, out = 0, []
    for n in lengths:
        out.append({"name": "A ", "pos": pos, "length": n, "sequence": (seq + "C" * 20)[:n]})
        pos += n
    return out


@pytest.fixture(scope="module")
def units(spark):
    rows = [(1, "R1", body(units_of(60, 61, 60), units_of(60, 60))), (2, "R1", body(units_of(61, 59, 62, 60))), (3, "R2", body(units_of(60, seq=B))), (4, None, None), (5, "R2", "{")]
    return u.decoded_units(spark.createDataFrame(rows, "file_id bigint, run string, body string")).cache()


def test_profiles(units):
    profile = u.unit_profile(units, "run").cache()
    got = {(r.run, r.unit): (r.tot, r.n_mut) for r in profile.collect()}
    assert got == {("R1", 1): (3, 1), ("R1", 2): (3, 2), ("R1", 3): (2, 1), ("R1", 4): (1, 0), ("R2", 1): (1, 0)}
    (block,) = u.longest_blocks(profile, "run").collect()
    assert tuple(block) == ("R1", 3, 1, 3, 0.6667)
    focal = {r.run: r for r in u.focality(profile, "run").collect()}
    assert focal["R1"].peak_unit == 2 and focal["R1"].n_above_half == 2 and focal["R2"].ratio is None
    null = {(r.run, r.unit): r.f_null for r in u.leave_one_out(profile, "run").collect()}
    assert null["R1", 2] == (2 + 0.5) / (6 + 1) and null["R2", 1] == 0.5
    assert u.positional_test(profile, "run", min_tot=1).count() == 2 and u.positional_test(profile, "run").count() == 0


def test_changes(units, spark):
    assert {(r.file_id, r.unit, r.net) for r in u.length_changes(units).collect()} == {(1, 2, 1), (2, 1, 1), (2, 2, -1), (2, 3, 2)}
    focal = {(r.file_id, r.hap_no): (r.is_array_wide, r.unit) for r in u.focal_calls(units).collect()}
    assert focal[2, 1] == (True, None) and focal[1, 1] == (False, 2) and focal[1, 2] == (False, None)
    ref = spark.createDataFrame([("A", A)], "motif_name string, seq string")
    (novel,) = u.novel_units(units, ref).collect()
    assert novel.sequence == B and novel.closest == "A" and novel.distance == sum(x != y for x, y in zip(A, B, strict=True))
    counts = u.base_counts(units, "name")
    consensus = {r.place: r.base for r in u.plurality_consensus(counts, "name").collect()}
    assert "".join(consensus[k] for k in range(1, 61)) == A
    assert u.phasing_places(counts, "name", low=0.1).count() == sum(x != y for x, y in zip(A, B, strict=True))
    runs = [tuple(r) for r in u.homopolymers(spark.createDataFrame([("CCCAATTTT",), ("CCCAATTTT",), (None,), ("",)], "sequence string")).collect()]
    assert sorted(runs) == [("CCCAATTTT", 1, "C", 3), ("CCCAATTTT", 6, "T", 4)]


def test_decoding(spark):
    ref = [(A, "A"), (B, "B"), (A + "C", "A+1")]
    text = A + "GG" + B[:30] + "G" + B[31:] + A + "C" + "T" * 7
    assert list(greedy_units(text, Units(ref))) == [("A", 0, 60, 0), ("B", 62, 60, sum(x != y for x, y in zip(B[30], "G", strict=True))), ("A+1", 122, 61, 0)]
    haps = spark.createDataFrame([(1, 1, text), (1, 2, None), (2, 1, "")], "file_id bigint, hap_no int, consensus string")
    got = decode(haps, spark.createDataFrame([(n, s) for s, n in ref], "motif_name string, seq string"))
    assert [r.name for r in got.orderBy("unit").collect()] == ["A", "B", "A+1"]


def test_sequences_and_alignments(spark):
    left, right, unit = A[::-1], B[::-1], "GATTACAGATTACA" * 4 + "GATT"
    noisy = left[:20] + "T" + left[21:40] + "AA" + left[42:]
    rc = lambda s: s[::-1].translate(str.maketrans("ACGTN", "TGCAN"))
    seqs = [left + unit * 7 + right, rc(left + unit * 3 + right), noisy + unit * 5 + "ACGT" + right, left + unit, None, ""]
    df = spark.createDataFrame([(k, s) for k, s in enumerate(seqs)], "i int, s string")
    none = sequences.Measure(with_anchors=False)
    got = {r.i: r.m and tuple(r.m) for r in df.select("i", sequences.measured_copies(F.col("s"), left, right, none).alias("m")).collect()}
    assert got == {0: (7, 60, 60, False), 1: (3, 60, 60, True), 2: (5, 60, 60, False), 3: None, 4: None, 5: None}
    assert df.select(sequences.reverse_complement(F.lit("ACGTNa"))).first()[0] == "tNACGT"
    assert df.select(sequences.tract_lengths(F.lit("GACCCAGTGACCAGT"), "GA", "C", "AG")).first()[0] == [3, 2]
    c = F.expr("array(named_struct('op', 4, 'len', 5), named_struct('op', 0, 'len', 10), named_struct('op', 1, 'len', 2), named_struct('op', 2, 'len', 3), named_struct('op', 7, 'len', 4))")
    one = df.select(cigar.reference_length(c), cigar.query_length(c), cigar.end_clips(c), cigar.inserted(c), cigar.deleted(c), cigar.overlap(F.lit(5), F.lit(9), 7, 30), cigar.overlap(F.lit(5), F.lit(9), 9, 30)).first()
    assert tuple(one) == (17, 21, 5, 2, 3, 2, 0)
    assert [(b["ref_at"], b["query_at"]) for b in df.select(cigar.blocks(c, F.lit(100))).first()[0]] == [(100, 0), (100, 5), (110, 15), (110, 17), (113, 17)]
