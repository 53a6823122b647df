import math
import random

from pyspark.sql import functions as F

from strandmill.operators import evaluation as e
from strandmill.operators import evidence, lengths


def slow_ranks(values):
    return [sum(w < v for w in values) + (sum(w == v for w in values) + 1) / 2 for v in values]


def test_rank_sum_and_correlation_equal_brute_force(spark):
    rng = random.Random(2)
    rows = [(rng.random() < 0.4, rng.randint(0, 12) / 10, rng.randint(0, 5) / 10) for _ in range(60)] + [(None, 1.0, 0.1), (True, None, 0.2), (False, 0.3, None)]
    df = spark.createDataFrame(rows, "g boolean, v double, w double")
    got = e.rank_sum(df, F.col("g"), F.col("v")).first()
    held = [(g, v) for g, v, _ in rows if g is not None and v is not None]
    u = sum((v > w) + (v == w) / 2 for g, v in held if g for h, w in held if not h)
    n1, n2 = sum(g for g, _ in held), sum(not g for g, _ in held)
    n = n1 + n2
    ties = sum(c**3 - c for c in (sum(v == x for _, v in held) for x in {v for _, v in held}))
    z = (u - n1 * n2 / 2) / math.sqrt(n1 * n2 / 12 * (n + 1 - ties / (n * (n - 1))))
    assert (got.n1, got.n2, got.u, got.z, got.p) == (n1, n2, u, round(z, 4), round(0.5 * math.erfc(z / math.sqrt(2)), 6))
    both = [(v, w) for _, v, w in rows if v is not None and w is not None]
    a, b = slow_ranks([v for v, _ in both]), slow_ranks([w for _, w in both])
    ma, mb = sum(a) / len(a), sum(b) / len(b)
    rho = sum((x - ma) * (y - mb) for x, y in zip(a, b, strict=True)) / math.sqrt(sum((x - ma) ** 2 for x in a) * sum((y - mb) ** 2 for y in b))
    assert e.rank_correlation(df, F.col("v"), F.col("w")).first().rho == round(rho, 6)
    assert e.rank_sum(df.limit(0), F.col("g"), F.col("v")).first().z is None and e.rank_sum(df.filter("v = 1"), F.col("g"), F.col("v")).first().z is None


def test_change_names(spark):
    names = ["13dupA", "X-58_59insG", "del11_24", "ins12", "33_34delinsA", "kA:17_18delAC", "59dupCC", "see report", "", None]
    df = spark.createDataFrame([(k, n) for k, n in enumerate(names)], "i int, n string")
    got = {r.i: r.c and tuple(r.c) for r in df.select("i", e.change_parts(F.col("n")).alias("c")).collect()}
    assert got == {
        0: (None, 13, 13, "dup", "A", None), 1: ("X", 58, 59, "ins", "G", None), 2: (None, 11, 24, "del", None, None), 3: (None, None, None, "ins", None, 12),
        4: (None, 33, 34, "delins", "A", None), 5: ("kA", 17, 18, "del", "AC", None), 6: (None, 59, 59, "dup", "CC", None), 7: None, 8: None, 9: None,
    }
    assert [r[0] for r in df.select(e.without_motif(F.col("n"))).collect()] == ["13dupA", "58_59insG", "del11_24", "ins12", "33_34delinsA", "17_18delAC", "59dupCC", "see report", "", None]


def test_scores_and_misses(spark):
    sheet = spark.createDataFrame(
        [(1, "a", "pos", 45, "dupA", 10), (2, "b_minimap2_x", "Carrier", 60, "dupA", None), (3, "c", "pos", None, "dupA", 5), (4, "a", "pos", 80, None, 3), (5, "a", "neg", 45, "dupA", 10), (6, None, None, None, None, None)],
        "row_id int, sample string, status string, mut_len int, variant string, variant_pos int",
    )
    features = spark.createDataFrame(
        [(1, "a", True, "dupA", 12, 0.4, 100, 40), (2, "a", True, "delC", 3, 0.2, 10, 2), (3, "b", False, None, None, 0.1, 0, 0), (4, "b", None, None, None, None, None, None), (5, "d", True, "dupA", 1, 0.5, 30, 15)],
        "feature_id int, sample string, has_mut boolean, variant string, repeat_index int, frac_8c double, tot int, n8c int",
    )
    subject = F.regexp_replace(F.coalesce("sample", F.lit("")), "_minimap2.*$", "")
    scored = {r.row_id: tuple(r)[1:] for r in e.score_calls(sheet, e.best_records(features, subject), subject).collect()}
    assert scored == {1: ("match", 2, True), 2: ("missed", None, None), 3: ("missed", None, None), 4: (None, 9, False)}
    misses = e.miss_table(sheet, features, subject).cache()
    got = {r.row_id: (r.length_class, r.n_tested, r.n_powered, r.best_count, r.outcome) for r in misses.collect()}
    assert got == {1: ("<50", 2, 1, 40, "CALLED"), 2: ("50-69", 0, 0, 0, "MISSED"), 3: (None, 0, 0, None, "NO_OUTPUT"), 4: (">=70", 2, 1, 40, "CALLED")}
    assert {r.length_class: (r.n_rows, r.rate) for r in e.misses_by_length(misses).collect()} == {"<50": (1, 1.0), "50-69": (1, 0.0), None: (1, 0.0), ">=70": (1, 1.0)}
    assert e.miss_table(sheet, features.limit(0), subject).filter("outcome = 'NO_OUTPUT'").count() == 4


def test_histogram_operators(spark):
    hist = spark.createDataFrame([("s", 40, 50), ("s", 41, 50), ("s", 42, 5), ("s", 80, 8), ("t", 30, 4), ("u", 10, 100), ("u", 90, 20)], "sample_id string, copies int, n bigint")
    assert {tuple(r) for r in lengths.modal_lengths(hist).collect()} == {("s", 41, 50, False), ("t", 30, 4, False), ("u", 10, 100, True)}
    assert {tuple(r) for r in lengths.best_windows(hist).collect()} == {("s", 40, 105, 40), ("t", 30, 4, 30), ("u", 10, 100, 10)}
    assert {tuple(r) for r in lengths.longest_peaks(hist).collect()} == {("s", 80, 4), ("u", 90, 2)}
    stated = spark.createDataFrame([(1, "s", 44), (2, "s", 60), (3, "x", 40), (4, "t", None)], "row_id int, sample_id string, length int")
    assert {tuple(r) for r in lengths.reads_near(hist, stated).collect()} == {(1, 105, 113), (2, 0, 113)}
    assert {tuple(r) for r in evidence.nearest_lengths(stated, hist).collect()} == {(1, 42, 2), (2, 42, 18)}
