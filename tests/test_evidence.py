import json
from math import comb

from pyspark.sql import functions as F

from strandmill.operators import evidence


def test_critical_counts(spark):
    df = spark.createDataFrame([(0,), (3,), (3,), (12,), (60,), (None,)], "n int")
    got = {r.n: (r.crit_k, r.power) for r in evidence.critical_counts(df).collect()}
    tail = lambda k, n, p: sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k, n + 1))
    for n in (3, 12, 60):
        k = next(k for k in range(n + 2) if tail(k, n, 0.02) < 0.05)
        assert got[n][0] == k and abs(got[n][1] - tail(k, n, 0.3)) < 1e-6
    assert got[0] == (1, 0.0) and set(got) == {0, 3, 12, 60}


def test_trimmed_null(spark):
    rows = [("a", u, 100, 2, 0.02) for u in range(1, 10)] + [("a", 10, 100, 60, 0.6)] + [("b", 1, 10, 1, 0.1), ("b", 2, 0, 0, 0.0)]
    out = {r.run: r for r in evidence.trimmed_null(spark.createDataFrame(rows, "run string, unit int, tot bigint, n_mut bigint, frac double"), "run").collect()}
    assert out["a"].units == 9 and abs(out["a"].f_null - 18.5 / 901) < 1e-6 and out["a"].rho == 0.0
    assert out["b"].units == 2 and out["b"].rho == 0.0


def test_histogram_operators(spark):
    hist = spark.createDataFrame([("s", 40, 30), ("s", 41, 10), ("s", 60, 20), ("t", 5, 3)] + [("u", c, 25) for c in range(8)], "sample_id string, copies int, n bigint")
    guard = {r.sample_id: r.is_reliable for r in evidence.length_guardrail(hist).collect()}
    assert guard == {"s": True, "t": False, "u": False}
    minor = {r.sample_id: r.minor_fraction for r in evidence.minor_fraction(hist).collect()}
    assert minor["s"] == round(20 / 60, 6) and minor["t"] is None
    stated = spark.createDataFrame([(1, "s", 60, 40), (2, "s", 40, 42), (3, "s", 50, 41), (4, "x", 1, 2), (5, "s", None, 2)], "row_id int, sample_id string, mut_len int, other_len int")
    got = {r.row_id: (r.n_mut, r.n_other, r.n_ambiguous) for r in evidence.allele_assignment(hist, stated).collect()}
    assert got == {1: (20, 40, 0), 2: (0, 0, 60), 3: (20, 40, 0)}
    near = {r.row_id: (r.nearest, r.distance) for r in evidence.nearest_lengths(stated.select("row_id", "sample_id", F.col("mut_len").alias("length")), hist).collect()}
    assert near == {1: (60, 0), 2: (40, 0), 3: (41, 9)}
    bias = spark.createDataFrame([("s", 10, 100, 50, 0.933), ("t", 40, 100, 10, 0.9441)], "sample_id string, delta int, count1 bigint, count2 bigint, bias double")
    one = evidence.bias_calibration(bias).first()
    assert one.n_samples == 2 and one.median_small == 0.933 and one.median_large == 0.9441 and 0.93 < one.pooled < 0.95


def test_document_checks(spark):
    hap = {"rank": 1, "contig": "V_3repeats", "n_motifs": 2, "motifs": [{"name": "a", "pos": 0, "length": 60}] * 2, "coverage": {"n_reads": 6, "n_fwd": 4, "n_rev": 2}}
    bodies = [{"haplotypes": [hap, {"rank": 2, "contig": "none", "n_motifs": 0}], "extra": 1, "sample": "x"}, "{", None, [1]]
    raw = spark.createDataFrame([(k, b if b is None or isinstance(b, str) else json.dumps(b)) for k, b in enumerate(bodies)], "file_id bigint, body string")
    assert [tuple(r) for r in evidence.strand_gates(raw).collect()] == [(0, 1, 6, 4, 2, 0.333, True)]
    assert [tuple(r) for r in evidence.contig_checks(raw).collect()] == [(0, 1, 3, 2, 2)]
    assert [tuple(r) for r in evidence.unknown_keys(raw, ("sample", "haplotypes")).collect()] == [(0, "extra")]
